"""Extraction of XML-wrapped JSON API responses landed as a table
(T15, T16, T17, J7, J8, R16, R17).

A landed response is one row per API call: ``(call_id, header, body)``
where ``body`` is the XML envelope whose text content is a JSON document
``{"<header>": [ ... ], "Status": {"Code": n, "Message": "..."}}``.
Everything is row-local (XML text extraction and JSON parsing run inside
the JVM per row) except the joins of the entity hierarchy.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's behaviour
# ---------------------------------------------------------------------------
STATUS_SUCCESS = 2
STATUS_QUOTA_EXCEEDED = 11
RETRY_AFTER_SECONDS = 30
PAGE_SIZE = 1000
# Pages that one block of the request plan expands to.
PAGES_PER_BLOCK = 10_000
MAX_RANGE_MONTHS = 3
# Response list names of the six entity calls.
BUSINESS_UNITS = "BusinessUnitInformation"
PROJECTS = "ProjectInformation"
TASKS = "ProjectTasksListInformation"
PACKAGE_TRADES = "PackageTradeInformation"
FORMS = "ProjectFormsListInformation"
FORM_RESULTS = "FormInformation"
ENTITY_LISTS = [BUSINESS_UNITS, PROJECTS, TASKS, PACKAGE_TRADES, FORMS, FORM_RESULTS]
# Fields of one task in the task list response.
_S, _L, _D, _B, _TS = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), \
    T.TimestampNTZType()
TASK_ELEMENT = T.StructType([T.StructField(n, t) for n, t in [
    ("TaskID", _S), ("TaskTypeLinkID", _L), ("Location", _S), ("Description", _S),
    ("Status", _S), ("StatusColour", _S), ("StatusDate", _TS), ("IssuedDate", _TS),
    ("TaskType", _S), ("IssuedToPackageID", _L), ("IssuedToPackage", _S),
    ("IssuedToOrganisation", _S), ("TargetDate", _TS), ("IssuedByUser", _S),
    ("IssuedByOrganisation", _S), ("IssuedByOrganisationType", _S), ("Priority", _S),
    ("Cause", _S), ("CausedByOrganisation", _S), ("ActualFinishDate", _TS), ("Cost", _D),
    ("OverDue", _B), ("Complete", _B), ("Closed", _B), ("Resolution", _S),
    ("LastModified", _TS)]])

ROUTE_DATA, ROUTE_RETRY, ROUTE_ERROR = "data", "retry", "error"

STATUS_SCHEMA = T.StructType([
    T.StructField("Code", T.IntegerType()),
    T.StructField("Message", T.StringType()),
])


# A tag, with quoted attribute values that may hold '>'.
_TAG = r"""<(?:[^>"']|"[^"]*"|'[^']*')*>"""
_DECLARATION = r"^\s*<\?xml(?:[^>\"']|\"[^\"]*\"|'[^']*')*\?>\s*"
# Markup the fast path does not handle: comments, CDATA, DOCTYPE,
# processing instructions and numeric character references.
_NOT_PLAIN = r"<!|<\?|&#"


def envelope_text(body: Column | str) -> Column:
    """All text nodes of the XML document concatenated (entities decoded).

    Plain envelopes (elements, attributes, text and the five predefined
    entities) take a regex path: drop the XML declaration and the blanks
    around the root element, remove tags, decode entities ('&amp;' last).
    Anything else goes through ``xpath_string(body, '/')``, which builds a
    DOM per row and is several times slower.  Both give the document's
    string value for well-formed input."""
    b = F.col(body) if isinstance(body, str) else body
    core = F.regexp_replace(F.regexp_replace(b, _DECLARATION, ""), r">\s+$", ">")
    text = F.regexp_replace(core, _TAG, "")
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"),
                    ("&amp;", "&")):
        text = F.replace(text, F.lit(ent), F.lit(ch))
    return F.when(core.rlike(_NOT_PLAIN), F.xpath_string(b, F.lit("/"))).otherwise(text)


def parse_payload(text: Column, header: str, element: T.StructType) -> Column:
    """JSON payload as a struct with the named list and the Status."""
    schema = T.StructType([
        T.StructField(header, T.ArrayType(element)),
        T.StructField("Status", STATUS_SCHEMA),
    ])
    return F.from_json(text, schema)


def route(code: Column) -> Column:
    """2 -> data, 11 -> retry (after a wait), anything else -> error."""
    return (F.when(code == STATUS_SUCCESS, F.lit(ROUTE_DATA))
            .when(code == STATUS_QUOTA_EXCEEDED, F.lit(ROUTE_RETRY))
            .otherwise(F.lit(ROUTE_ERROR)))


def parse_responses(responses: DataFrame, header: str, element: T.StructType) -> DataFrame:
    """Parse landed responses once: ``(call_id, route, error, payload)``."""
    p = responses.select(
        "call_id", parse_payload(envelope_text("body"), header, element).alias("payload"))
    code = F.col("payload.Status.Code")
    return p.select(
        "call_id", route(code).alias("route"),
        F.when(route(code) == ROUTE_ERROR,
               F.concat_ws(" - ", F.coalesce(code.cast("string"), F.lit("NULL")),
                           F.coalesce(F.col("payload.Status.Message"), F.lit(""))))
         .alias("error"),
        "payload")


def extract(parsed: DataFrame, header: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three outputs of one call type: entity rows of successful
    calls (one row per list element), the calls to retry (quota exceeded,
    with the earliest retry time) and the failed calls with their error
    text.  ``parsed`` may be cached by the caller; each output is a filter."""
    # inline of a conditional list instead of filter + inline: a filter on
    # the route would be pushed below the parse and parse every row twice
    data = parsed.select("call_id", F.inline(
        F.when(F.col("route") == ROUTE_DATA, F.col(f"payload.`{header}`"))))
    retry = (parsed.filter(F.col("route") == ROUTE_RETRY)
             .select("call_id", (F.localtimestamp() + F.make_interval(
                 secs=F.lit(RETRY_AFTER_SECONDS))).alias("retry_after")))
    errors = parsed.filter(F.col("route") == ROUTE_ERROR).select("call_id", "error")
    return data, retry, errors


def extract_all(responses: DataFrame, elements: dict[str, T.StructType]
                ) -> dict[str, tuple[DataFrame, DataFrame, DataFrame]]:
    """R16 over a table of mixed calls ``(call_id, header, body)``: per list
    name, its (data, retry, errors).  Each is a filter of the one landed
    table on ``header`` followed by the parse with that list's schema."""
    return {h: extract(parse_responses(responses.filter(F.col("header") == h), h, el), h)
            for h, el in elements.items()}


# Types that a schema of variants names, and those the entity rows get: texts
# for what is never set or not always of one type, doubles for decimals.
_ELEMENT_TYPES = {"OBJECT<": "STRUCT<", "VARIANT": "STRING", "VOID": "STRING"}
_TYPE_WORD = re.compile(r"`(?:[^`]|``)*`|OBJECT<|DECIMAL\(\d+, ?\d+\)|VARIANT|VOID")


def _element_type(schema: str) -> T.StructType | None:
    """The element type of a list from its variant schema (``ARRAY<OBJECT<...>>``)."""
    ddl = _TYPE_WORD.sub(lambda m: m[0] if m[0][0] == "`" else _ELEMENT_TYPES.get(m[0], "DOUBLE"),
                         schema)
    # names that the schema leaves unquoted are quoted for the parser
    ddl = re.sub(r"(?<=[<,\s])([^\s`<>,:]+):", r"`\1`:", ddl)
    kind = T.DataType.fromDDL(ddl)
    element = kind.elementType if isinstance(kind, T.ArrayType) else None
    return element if isinstance(element, T.StructType) and element.fields else None


def infer_elements(responses: DataFrame, headers: list[str] | None = None
                   ) -> dict[str, T.StructType]:
    """The element type of each list, from all landed responses.

    Every payload is parsed to a variant, and one aggregate per list merges the
    schemas of its successful calls: fields that only some responses have are
    part of it, numbers of any kind widen, and a field that is a number here and
    a text there becomes a text.  A list without elements has no entry."""
    headers = headers or ENTITY_LISTS
    payload = F.try_parse_json(envelope_text("body"))
    rows = responses.filter(F.col("header").isin(headers)).select("header", payload.alias("v"))
    ok = F.try_variant_get("v", "$.Status.Code", "int") == STATUS_SUCCESS
    items = F.coalesce(*[F.when(ok & (F.col("header") == h),
                                F.try_variant_get("v", f"$.{h}", "variant")) for h in headers])
    found = rows.groupBy("header").agg(F.schema_of_variant_agg(items).alias("s")).collect()
    types = {r["header"]: _element_type(r["s"]) for r in found if r["s"]}
    return {h: types[h] for h in headers if types.get(h)}


def extract_entities(responses: DataFrame, headers: list[str] | None = None
                     ) -> dict[str, tuple[DataFrame, DataFrame, DataFrame]]:
    """R16 for lists whose fields nobody has written down: (data, retry, errors)
    per list, typed by ``infer_elements``."""
    return extract_all(responses, infer_elements(responses, headers))


def package_trade_lookup(tasks: DataFrame, trades: DataFrame) -> DataFrame:
    """Each task with the trade (division) of the package it was issued to."""
    t = trades.select(F.col("package_id").alias("IssuedToPackageID"), "division")
    return tasks.join(t, "IssuedToPackageID", "left")


def hierarchy_expand(units: DataFrame, projects: DataFrame, children: DataFrame,
                     child_key: str = "ProjectID") -> DataFrame:
    """Business unit -> project -> child rows (tasks or forms), each
    level keyed by its parent's id.  Inner joins: a child of an unknown
    project is not in the hierarchy."""
    u = units.select("BusinessUnitID", F.col("Name").alias("business_unit"))
    p = projects.select(F.col("ProjectID").alias(child_key), "BusinessUnitID",
                        F.col("Name").alias("project"))
    return children.join(p, child_key).join(u, "BusinessUnitID")


def request_windows(ranges: DataFrame, start: str = "date_from", end: str = "date_to",
                    months: int = MAX_RANGE_MONTHS) -> DataFrame:
    """Split every requested date range into calls of at most
    ``months`` months: ``(..., window_from, window_to)``, inclusive days.

    Each window starts where the previous one ends (its start plus
    ``months`` months, month ends clamped) and ends the day before the next
    start, so the windows cover the range without gaps even from a
    month-end start.  The starts are built per row with a higher-order
    function over a bounded index sequence (no self-join, no driver loop)."""
    # a reversed or incomplete range asks for nothing
    ranges = ranges.filter(F.col(end) >= F.col(start))
    s, e = F.col(start), F.col(end)
    n = (F.floor(F.months_between(e, s) / months) + 2).cast("int")

    def step(d):
        return F.add_months(d, months)

    starts = F.aggregate(
        F.sequence(F.lit(1), n), F.array(s),
        lambda acc, _: F.when(step(F.element_at(acc, -1)) <= e,
                              F.concat(acc, F.array(step(F.element_at(acc, -1)))))
        .otherwise(acc))
    return (ranges.withColumn("window_from", F.explode(starts))
            .withColumn("window_to", F.least(e, F.date_add(step(F.col("window_from")), -1))))


def request_pages(totals: DataFrame, total: str = "n_rows",
                  page_size: int = PAGE_SIZE) -> DataFrame:
    """Page start rows 0, page_size, ... below the row total (one call each).

    Blocks of pages first, then the pages of a block, so that no row holds
    an array of all pages; the blocks are dealt out before they are expanded."""
    pages = F.ceil(F.col(total) / F.lit(page_size)).cast("long")
    block = F.lit(PAGES_PER_BLOCK).cast("long")
    one = F.lit(1).cast("long")
    last = F.least(F.col("_block") + block, F.col("_pages")) - one
    return (totals.filter(F.col(total) > 0).withColumn("_pages", pages)
            .withColumn("_block", F.explode(F.sequence(
                F.lit(0).cast("long"), F.col("_pages") - one, block)))
            .repartition("_block")
            .withColumn("_page", F.explode(F.sequence(F.col("_block"), last, one)))
            .withColumn("start_row", F.col("_page") * F.lit(page_size))
            .withColumn("page_size", F.lit(page_size)).drop("_pages", "_block", "_page"))
