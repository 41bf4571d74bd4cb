"""Form-entry sheet processing: pivot, new-entry filter, notification
rendering, comments, cell updates and notification classification
(J10, R4, P10, P11, T21, T22, T23, X4).

A sheet is two DataFrames: ``cells(row_id, column_id, value,
display_value)`` (long form) and ``columns(column_id, title)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's behaviour
# ---------------------------------------------------------------------------
RECORD_SOURCE = "Record Source"
NEW_ENTRY = "Form - New Entry"
PROCESSED = "Form"
PROJECT_NAME = "Project Name"
COMMENTS = "Comments"
DISPLAY_VALUE_TITLE = "Value"       # the one field shown by its display value
NONE_TEXT = "None"                  # the service's text for a missing value
SUBJECT_PREFIX = "Project Opportunity: "
CHALLENGE_PREFIX = "Smartsheet-Hook-Challenge"
SERVICE_PREFIX = "Smartsheet"
KIND_CHALLENGE, KIND_CHANGE, KIND_IGNORED = "challenge", "change", "ignored"
# Notification rows in order: (sheet column title, label, alternate background).
NOTIFICATION_ROWS = [
    ("Owner", "Submitted By", False),
    ("Project Name", "Project Name", True),
    ("Client", "Client", False),
    ("Comments", "Comments", True),
    ("Address", "Address", False),
    ("Market", "Market", True),
    ("Value", "Value", False),
    ("Precon Start Date", "Precon Start Date", True),
    ("Construction Start Date", "Construction Start Date", False),
    ("Const Completion Date", "Completion Date", True),
    ("Client Contact", "Client Contact", False),
    ("Designer", "Designer", True),
]
FORM_TITLES = [RECORD_SOURCE] + [t for t, _, _ in NOTIFICATION_ROWS]
ROW_BACKGROUND, ALT_BACKGROUND = "ffffff", "f2f2f2"
ROW_HTML_START = '\n<tr style="background-color:#{bg};"><td width="50" style="border: 1px solid #ddd;padding: 8;"><div style="font-size: 110%;">'  # noqa: E501
ROW_HTML_MIDDLE = '</div></td><td width="250" style="border: 1px solid #ddd;padding: 8;"><div style="font-size: 110%;">'  # noqa: E501
ROW_HTML_END = "</div></td></tr>"
# The page around the rows.
HTML_HEADER = '<html><body style="font-family: sans-serif"><table style="width: 85%">'
HTML_FOOTER = "</table></body></html>"


def read_sheet(spark, cells_path: str, columns_path: str) -> tuple[DataFrame, DataFrame]:
    """A landed sheet (parquet): cells and the column title list."""
    cells = spark.read.parquet(cells_path).select("row_id", "column_id", "value",
                                                  "display_value")
    return cells, spark.read.parquet(columns_path).select("column_id", "title")


def cells_with_titles(cells: DataFrame, columns: DataFrame) -> DataFrame:
    """Resolve every cell's column title.  The column list, one row per
    column of the sheet (the pivot makes two columns of each), is broadcast: a
    shuffle by the few column ids would put a whole column into one task."""
    return cells.join(F.broadcast(columns.select("column_id", "title")), "column_id")


def pivot_sheet(cells: DataFrame, columns: DataFrame, titles: list[str] | None = None
                ) -> DataFrame:
    """One wide row per sheet row; for title ``t`` the columns ``t``
    (value) and ``t__display`` (display value).  Titles are passed
    explicitly (no extra job to find them)."""
    titled = cells_with_titles(cells, columns)
    if titles is None:
        titles = [r.title for r in columns.select("title").distinct().collect()]
    return (titled.groupBy("row_id").pivot("title", titles)
            .agg(F.first("value", ignorenulls=True).alias("v"),
                 F.first("display_value", ignorenulls=True).alias("d"))
            .select("row_id", *[F.col(f"`{t}_v`").alias(t) for t in titles],
                    *[F.col(f"`{t}_d`").alias(f"{t}__display") for t in titles]))


def new_entry_cells(cells: DataFrame, columns: DataFrame) -> DataFrame:
    """P10 before the pivot: only the cells of rows whose Record Source cell
    is a new entry (a semi-join on the row ids found in that one column), so
    the pivot shuffles new rows only.  A filter on the pivoted column could
    not be pushed below the pivot by the optimizer."""
    rs_id = _record_source_column(columns)
    new_ids = cells.filter((F.col("column_id") == rs_id)
                           & (F.col("value") == NEW_ENTRY)).select("row_id")
    return cells.join(new_ids, "row_id", "left_semi")


def _record_source_column(columns: DataFrame):
    """Id of the Record Source column (one row of the column list)."""
    rs = columns.filter(F.col("title") == RECORD_SOURCE).select("column_id").first()
    if rs is None:
        raise ValueError(f"sheet has no {RECORD_SOURCE!r} column")
    return rs["column_id"]


def new_entries(wide: DataFrame) -> DataFrame:
    """P10: rows whose Record Source is exactly 'Form - New Entry'."""
    return wide.filter(F.col(f"`{RECORD_SOURCE}`") == NEW_ENTRY)


def _shown(title: str) -> Column:
    """Text shown for a field: display value for 'Value', else the value;
    a missing value shows as empty."""
    c = F.col(f"`{title}__display`") if title == DISPLAY_VALUE_TITLE else F.col(f"`{title}`")
    return F.when(c.isNull() | (c == NONE_TEXT), F.lit("")).otherwise(c)


def render_row(title: str, label: str, alternate: bool) -> Column:
    """One label/value table row."""
    bg = ALT_BACKGROUND if alternate else ROW_BACKGROUND
    return F.concat(F.lit(ROW_HTML_START.format(bg=bg) + label + ROW_HTML_MIDDLE),
                    _shown(title), F.lit(ROW_HTML_END))


def render_notification(wide: DataFrame) -> DataFrame:
    """``(row_id, subject, html)`` per row."""
    body = F.concat(F.lit(HTML_HEADER), *[render_row(*r) for r in NOTIFICATION_ROWS],
                    F.lit(HTML_FOOTER))
    subject = F.concat(F.lit(SUBJECT_PREFIX),
                       F.coalesce(F.col(f"`{PROJECT_NAME}`"), F.lit(NONE_TEXT)))
    return wide.select("row_id", subject.alias("subject"), body.alias("html"))


def comments(wide: DataFrame) -> DataFrame:
    """The comment to post per row, when one was entered."""
    c = F.col(f"`{COMMENTS}__display`")
    return wide.filter(c.isNotNull() & (c != NONE_TEXT)).select(
        "row_id", c.alias("comment_text"))


def status_updates(wide: DataFrame, columns: DataFrame) -> DataFrame:
    """The cell updates marking rows processed:
    ``(row_id, column_id, new_value, updated_at)``."""
    return wide.select("row_id", F.lit(_record_source_column(columns)).alias("column_id"),
                       F.lit(PROCESSED).alias("new_value"),
                       F.localtimestamp().alias("updated_at"))


def apply_updates(cells: DataFrame, updates: DataFrame, order_col: str) -> DataFrame:
    """Set cells from ``(row_id, column_id, new_value, order_col)``.

    Of several updates of a cell the latest by ``order_col`` wins (equal ones:
    the larger value).  A NULL value clears the cell, and an update of a
    cell that the sparse form does not hold adds it."""
    latest = updates.groupBy("row_id", "column_id").agg(
        F.max(F.struct(order_col, "new_value"))["new_value"].alias("new_value"))
    latest = latest.withColumn("_set", F.lit(True))

    def pick(old: str) -> Column:
        return F.when(F.col("_set"), F.col("new_value")).otherwise(F.col(old)).alias(old)

    return (cells.join(latest, ["row_id", "column_id"], "full")
            .select("row_id", "column_id", pick("value"), pick("display_value")))


def classify_notification(header: Column | str) -> Column:
    """Challenge / change / ignored from the request header text."""
    h = F.col(header) if isinstance(header, str) else header
    return (F.when(h.startswith(CHALLENGE_PREFIX), F.lit(KIND_CHALLENGE))
            .when(h.startswith(SERVICE_PREFIX), F.lit(KIND_CHANGE))
            .otherwise(F.lit(KIND_IGNORED)))
