"""Delimited-file sources (S1 lenient, S2 rejects, S3 strict, S4 headerless)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import normalize_header

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's behaviour
# ---------------------------------------------------------------------------
# File format name -> field delimiter.  Any other name is an error.
FORMAT_DELIMITERS = {"CSV": ",", "CSV_SEMICOLON_DELIMITER": ";", "TSV": "\t"}
SOURCE_ENCODING = "ISO-8859-1"

CORRUPT_COL = "_corrupt_record"
FILE_COL = "_source_file"
BLOCK_COL = "_block_start"
ROW_COL = "_row_in_part"
# Line on which a record starts, where the parse itself knows it.
LINE_COL = "_line"
# Part of a split, and the lines in it at most.
PIECE_COL, PIECE_LINES = "_piece", 1 << 14
POS_COLS = [BLOCK_COL, "_part", ROW_COL, LINE_COL]
# A line that the CSV reader skips: empty after Java trim().
BLANK = r"^[\x00-\x20]*$"


def delimiter_for(file_format: str) -> str:
    try:
        return FORMAT_DELIMITERS[file_format]
    except KeyError:
        raise ValueError(f"unknown file format {file_format!r}; "
                         f"expected one of {sorted(FORMAT_DELIMITERS)}") from None


def _reader(spark: SparkSession, sep: str, header: bool, encoding: str = SOURCE_ENCODING):
    return (spark.read.option("sep", sep).option("header", header).option("quote", '"')
            .option("escape", '"').option("nullValue", "").option("encoding", encoding))


def header_names(spark: SparkSession, path: str, file_format: str = "CSV") -> list[str]:
    """Header line of the (first) file, cleaned up by P1.  Reads one line."""
    raw = _reader(spark, delimiter_for(file_format), True).csv(path).columns
    return [normalize_header(n) for n in raw]


def read_delimited(spark: SparkSession, path: str, file_format: str = "CSV",
                   names: list[str] | None = None) -> DataFrame:
    """S1 + S2: every column as text, malformed rows kept aside.

    Returns the raw parse: the data columns (all ``string``), the raw text
    of a malformed row in ``_corrupt_record`` (NULL for a good row) and the
    file name.  Select all columns before filtering on ``_corrupt_record``
    (or write the frame, as the loader does): with CSV column pruning a
    narrower projection would not see the malformed rows.
    """
    names = names or header_names(spark, path, file_format)
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names]
                          + [T.StructField(CORRUPT_COL, T.StringType(), True)])
    df = (_reader(spark, delimiter_for(file_format), True)
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COL)
          # a pruned parse does not see extra or missing fields (rows would pass
          # as good): whole lines are parsed where malformed rows are tracked
          .option("columnPruning", False)
          .schema(schema).csv(path))
    return (df.withColumn(FILE_COL, F.col("_metadata.file_path"))
            .withColumn(BLOCK_COL, F.col("_metadata.file_block_start"))
            .withColumn("_part", F.spark_partition_id())
            .withColumn(ROW_COL, F.monotonically_increasing_id())
            .withColumn(LINE_COL, F.lit(None).cast("long")))


def _ends_open(sep: str) -> tuple[str, str]:
    """Patterns of the lines that end inside a quoted field, for lines that
    begin outside and inside of one.  As in the parser, a quote opens only as
    the first character of a field, a doubled quote stays inside, and what
    follows a closing quote belongs to the field up to the delimiter.  All
    repeats are possessive: one pass, no recursion on long lines."""
    d = "\\t" if sep == "\t" else sep
    body = '[^"]*+(?:""[^"]*+)*+'
    rest = f"[^{d}]*+"
    fields = f'(?:(?:"{body}"{rest}|[^"{d}]{rest}|){d})*+'
    opens = f'{fields}"{body}\\z'
    return f"\\A{opens}", f'\\A{body}(?:\\z|"{rest}{d}{opens})'


def _lines(spark: SparkSession, path: str, sep: str, encoding: str = SOURCE_ENCODING) -> DataFrame:
    """Physical lines of the files, in split order, with the line end that
    follows them (``_end``: LF, CR or both), and whether they end inside a quoted
    field if they begin outside (``_o``) or inside (``_i``) of one."""
    # splits at LF only; what CR parts is taken apart here, to know each line's end
    raw = spark.read.option("lineSep", "\n").text(path)
    text = F.decode(F.col("value").cast("binary"), encoding)
    whole = F.when(text.endswith("\r"), F.substr(text, F.lit(1), F.length(text) - 1)).otherwise(text)
    last = F.when(text.endswith("\r"), F.lit("\r\n")).otherwise(F.lit("\n"))
    pieces = F.when(whole.contains("\r"), F.split(whole, "\r")).otherwise(F.array(whole))
    outside, inside = _ends_open(sep)
    quoted = F.col("value").contains('"')
    return (raw.select(F.col("_metadata.file_path").alias(FILE_COL),
                       F.col("_metadata.file_block_start").alias(BLOCK_COL),
                       last.alias("_last"), F.posexplode(pieces).alias("_piece", "value"),
                       F.size(pieces).alias("_pieces"))
            .withColumn("_end", F.when(F.col("_piece") == F.col("_pieces") - 1, F.col("_last"))
                        .otherwise(F.lit("\r")))
            .drop("_piece", "_pieces", "_last")
            .withColumn("_part", F.spark_partition_id())
            .withColumn(ROW_COL, F.monotonically_increasing_id())
            .withColumn("_o", F.when(quoted, F.col("value").rlike(outside)).otherwise(False))
            .withColumn("_i", F.when(quoted, F.col("value").rlike(inside)).otherwise(True)))


def has_quoted_breaks(spark: SparkSession, path: str, file_format: str = "CSV") -> bool:
    """Whether some line leaves a quoted field open (the scan ends at the first).
    Quotes inside an unquoted field open nothing."""
    return _lines(spark, path, delimiter_for(file_format)).filter("_o").limit(1).count() > 0


def quoted_records(spark: SparkSession, path: str, sep: str, header: bool = True,
                   encoding: str = SOURCE_ENCODING) -> DataFrame:
    """Records of files whose quoted fields may hold line breaks: the file, the
    record's first line, its text, and whether it is ``_unclosed``.

    A record ends on a line after which no quoted field is open.  A line maps
    the state before it (0 outside, 1 inside of a quoted field) to the state
    after it: it keeps the state, turns it or sets it.  After a setting line
    with ``turns`` turning lines before it, the state is ``_base`` (the state
    set less ``turns``) plus the turns so far, modulo 2, so two running values
    compose the lines of a piece (``PIECE_LINES`` lines of a split at most) and,
    with one row per piece, the pieces of a file.  Windows inside a piece give each
    line its record.  A record's lines are put together: those of a record inside a
    piece where the windows have left them, those at a piece's edges across pieces,
    so the texts of the lines move once.  No task reads a whole file, and pieces,
    unlike splits, are many enough to spread evenly.

    A quoted field that no line closes makes no record: each line from its
    first one to the end of the file is an unclosed record of its own.  Line
    ends inside of quotes stay as they are in the file."""
    keys = [FILE_COL, BLOCK_COL, "_part", PIECE_COL]
    earlier = Window.partitionBy(FILE_COL).orderBy(BLOCK_COL, PIECE_COL).rowsBetween(
        Window.unboundedPreceding, -1)
    file = Window.partitionBy(FILE_COL)
    zero = F.lit(0).cast("long")
    inside = Window.partitionBy(*keys).orderBy(ROW_COL)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = (_lines(spark, path, sep, encoding)
             # the low bits of a row's id are its place in the task
             .withColumn(PIECE_COL, F.floor(F.col(ROW_COL).bitwiseAND((1 << 33) - 1) / PIECE_LINES))
             .withColumn("_blank", F.col("value").rlike(BLANK))
             .withColumn("_turn", (F.col("_o") & ~F.col("_i")).cast("long"))
             .withColumn("_turns", F.sum("_turn").over(so_far))
             .withColumn("_base", F.when(F.col("_o") == F.col("_i"),
                                         F.col("_o").cast("long") - F.col("_turns"))))

    def state(base, turns):
        return F.pmod(base + turns, F.lit(2))

    splits = (lines.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_turn").alias("_t"),
        F.max(F.when(F.col("_base").isNotNull(), F.struct(ROW_COL, "_base")))["_base"].alias("_b"),
        # the piece's first line that is not blank, from 1
        (F.min(F.when(~F.col("_blank"), F.col(ROW_COL))) - F.min(ROW_COL) + 1)
        .alias("_head"))
        .withColumn("_n_before", F.coalesce(F.sum("_n").over(earlier), zero))
        .withColumn("_t_before", F.coalesce(F.sum("_t").over(earlier), zero))
        # the piece's base with the turns of the earlier pieces taken off
        .withColumn("_b", F.when(F.col("_b").isNotNull(),
                                 state(F.col("_b"), F.col("_t")) - F.col("_t_before") - F.col("_t")))
        .withColumn("_b_before", F.coalesce(F.last("_b", ignorenulls=True).over(earlier), zero))
        .withColumn("_after", state(F.coalesce("_b", "_b_before"),
                                    F.col("_t_before") + F.col("_t")))
        .select(*keys, state(F.col("_b_before"), F.col("_t_before")).alias("_begin"),
                "_n_before", F.min(F.col("_n_before") + F.col("_head")).over(file).alias("_header"),
                (F.max(F.struct(BLOCK_COL, PIECE_COL, "_after")).over(file)["_after"] == 1).alias("_open")))
    opened = state(F.coalesce(F.last("_base", ignorenulls=True).over(before), F.col("_begin")),
                   F.col("_turns") - F.col("_turn")) == 1
    numbered = (lines.join(splits, keys)
                .withColumn("_at", F.col("_n_before") + F.row_number().over(inside))
                .withColumn("_first", F.when(~opened, F.col("_at")))
                .withColumn("_first", F.last("_first", ignorenulls=True).over(inside)))
    # a piece may begin inside a record: the last start of an earlier piece
    carried = numbered.groupBy(*keys).agg(F.max("_first").alias("l")).select(
        *keys, F.last("l", ignorenulls=True).over(earlier).alias("_carried"),
        F.max("l").over(file).alias("_last"), F.col("l").alias("_tail"))
    start = F.coalesce("_first", "_carried")
    whole = (numbered.join(carried, keys)
             .withColumn("_unclosed", F.col("_open") & (start == F.col("_last")))
             .withColumn(LINE_COL, F.when(F.col("_unclosed"), F.col("_at")).otherwise(start))
             # begun in an earlier piece, or the piece's last one
             .withColumn("_edge", F.coalesce(~F.col("_unclosed") & (
                 F.col("_first").isNull() | (F.col("_first") == F.col("_tail"))), F.lit(True))))

    def records(some: DataFrame, by: list[str]) -> DataFrame:
        return (some.groupBy(*by, LINE_COL, "_unclosed", "_header")
                .agg(F.array_sort(F.collect_list(F.struct("_at", "value", "_end"))).alias("l"))
                .select(FILE_COL, LINE_COL, "_unclosed", "_header", F.array_join(F.transform(
                    "l", lambda x, i: F.when(i == F.size("l") - 1, x["value"])
                    .otherwise(F.concat(x["value"], x["_end"]))), "").alias("_text"))
                .filter(~F.col("_text").rlike(BLANK)))

    whole = records(whole.filter(~F.col("_edge")), keys).unionByName(
        records(whole.filter("_edge"), [FILE_COL]))
    return (whole.filter(F.col(LINE_COL) != F.col("_header")) if header else whole).drop("_header")


def read_quoted_records(spark: SparkSession, path: str, file_format: str = "CSV",
                        names: list[str] | None = None) -> DataFrame:
    """S1 + S2 for files whose quoted fields hold line breaks; the shape is
    that of ``read_delimited``, and ``_line`` is the record's first line.
    Unclosed records (``quoted_records``) are malformed rows."""
    sep = delimiter_for(file_format)
    names = names or header_names(spark, path, file_format)
    schema = ", ".join(f"`{n}` string" for n in [*names, CORRUPT_COL])
    parsed = F.from_csv("_text", schema, {
        "sep": sep, "quote": '"', "escape": '"', "nullValue": "",
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL})
    unclosed = F.struct(*[F.lit(None).cast("string").alias(n) for n in names],
                        F.col("_text").alias(CORRUPT_COL))
    return (quoted_records(spark, path, sep)
            .withColumn("_p", F.when(F.col("_unclosed"), unclosed).otherwise(parsed))
            .select("_p.*", FILE_COL, F.lit(None).cast("long").alias(BLOCK_COL),
                    F.lit(None).cast("int").alias("_part"),
                    F.lit(None).cast("long").alias(ROW_COL), LINE_COL))


def number_rejects(spark: SparkSession, path: str, raw: DataFrame) -> DataFrame:
    """Malformed rows of a landed parse with their physical line numbers.

    A parsed record is the k-th non-blank line of its file split (the
    header, first non-blank line of a file, is not a record).  A text read
    of the same files gives, per split, its line count and first row id
    (partial aggregates, one row per split) and the positions of its blank
    lines (rare; collected per split).  A reject's position in its split is
    k moved past every blank line at or before it; its line number adds the
    lines of the file's earlier splits.  No step shuffles all lines, and
    only the malformed rows are joined."""
    known = raw.filter(F.col(CORRUPT_COL).isNotNull() & F.col(LINE_COL).isNotNull())
    if known.limit(1).count():  # the parse numbered its records
        return known.select(FILE_COL, CORRUPT_COL,
                            F.col(LINE_COL).cast("decimal(38,0)").alias("line"))
    keys = [FILE_COL, BLOCK_COL, "_part"]
    first = raw.groupBy(*keys).agg(F.min(ROW_COL).alias("_first"))
    bad = (raw.filter(F.col(CORRUPT_COL).isNotNull()).select(*keys, ROW_COL, CORRUPT_COL)
           .join(first, keys)
           .withColumn("_k", F.col(ROW_COL) - F.col("_first")
                       + F.when(F.col(BLOCK_COL) == 0, 1).otherwise(0)))
    t = (spark.read.text(path)
         .select(F.col("_metadata.file_path").alias(FILE_COL),
                 F.col("_metadata.file_block_start").alias(BLOCK_COL),
                 F.spark_partition_id().alias("_part"),
                 F.monotonically_increasing_id().alias(ROW_COL),
                 # the CSV reader skips lines that are empty after Java trim()
                 F.col("value").rlike(BLANK).alias("_blank")))
    splits = t.groupBy(*keys).agg(F.min(ROW_COL).alias("_first"),
                                  F.count(F.lit(1)).alias("_n"))
    before = splits.select(FILE_COL, BLOCK_COL, F.coalesce(F.sum("_n").over(
        Window.partitionBy(FILE_COL).orderBy(BLOCK_COL)
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    blanks = (t.filter("_blank").join(splits, keys)
              .groupBy(FILE_COL, BLOCK_COL)
              .agg(F.array_sort(F.collect_list(F.col(ROW_COL) - F.col("_first"))).alias("_bl")))
    # a split that the second read does not have (other split sizes) leaves
    # the line open instead of losing the row
    located = (bad.join(before, [FILE_COL, BLOCK_COL], "left")
               .join(blanks, [FILE_COL, BLOCK_COL], "left")
               .withColumn("_p", F.aggregate(
                   F.coalesce(F.col("_bl"), F.array().cast("array<bigint>")), F.col("_k"),
                   lambda p, b: F.when(b <= p, p + 1).otherwise(p))))
    return located.select(FILE_COL, CORRUPT_COL,
                          (F.col("_before") + F.col("_p") + 1).cast("decimal(38,0)")
                          .alias("line"))


def land_delimited(spark: SparkSession, path: str, out_path: str, file_format: str = "CSV",
                   names: list[str] | None = None) -> DataFrame:
    """Parse once and write the raw parse (stage rows and malformed rows) as
    parquet; return it read back.  Reading malformed rows from the landed
    copy avoids a second parse and the corrupt-column-only restriction.
    Files with quoted line breaks are parsed record by record, others by line."""
    broken = has_quoted_breaks(spark, path, file_format)
    read = read_quoted_records if broken else read_delimited
    read(spark, path, file_format, names).write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)


def good_rows(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col(CORRUPT_COL).isNull()).drop(CORRUPT_COL, FILE_COL, *POS_COLS)


TOO_MANY, TOO_FEW, UNCLOSED = "too many fields", "too few fields", "quoted field is not closed"
AFTER_UNCLOSED = "line after a quoted field that is not closed"


def record_error(record: Column, names: list[str], sep: str) -> Column:
    """Which rule a malformed record breaks first, and where:
    ``struct(error, field, character, column_name)``.

    The record's fields are walked with the parser's quote rules (see
    ``_ends_open``).  ``field`` and ``character`` count from 1, characters from
    the record's first one, line ends included.  Too many fields: the first
    character of the first field too many, and the column after which the record
    should have ended.  Too few: the place after the last character, and the
    first column without a field.  An unclosed quoted field: its quote and its
    column.  A line that an earlier unclosed field has swallowed may break no
    rule of its own: character 1, no column."""
    d = "\\t" if sep == "\t" else sep
    body = '[^"]*+(?:""[^"]*+)*+'
    field = f'(?:"{body}"[^{d}]*+|[^"{d}][^{d}]*+|)'
    # a delimiter is put after the record, so every closed field ends with one
    fields = F.regexp_extract_all(F.concat(record, F.lit(sep)),
                                  F.lit(f'\\G(?:{field}{d}|"{body}\\z)'), F.lit(0))
    wanted, known = len(names), F.array(*[F.lit(x) for x in names])

    def judged(f: Column) -> Column:
        n = F.size(f)
        unclosed = F.element_at(f, -1).rlike(f'\\A"{body}\\z')

        def start(k: Column) -> Column:
            return F.aggregate(F.slice(f, F.lit(1), k), F.lit(1), lambda at, x: at + F.length(x))

        def found(error: Column, number: Column, character: Column, column: Column) -> Column:
            return F.struct(error.alias("error"), number.cast("decimal(38,0)").alias("field"),
                            character.cast("decimal(38,0)").alias("character"),
                            column.alias("column_name"))

        def count(text: str) -> Column:
            return F.concat(F.lit(f"{text}: "), n.cast("string"), F.lit(f" instead of {wanted}"))

        return (F.when(n > wanted, found(count(TOO_MANY), F.lit(wanted + 1), start(F.lit(wanted)),
                                         F.lit(names[-1])))
                .when(unclosed, found(F.lit(UNCLOSED), n, start(n - 1), F.get(known, n - 1)))
                .when(n < wanted, found(count(TOO_FEW), n + 1, F.length(record) + 1,
                                        F.get(known, n)))
                .otherwise(found(F.lit(AFTER_UNCLOSED), F.lit(None).cast("int"), F.lit(1),
                                 F.lit(None).cast("string"))))

    # a record's fields are cut once
    return F.get(F.transform(F.array(fields), judged), F.lit(0))


def reject_rows(raw: DataFrame, table_name: str, numbered: DataFrame | None = None,
                file_format: str = "CSV") -> DataFrame:
    """Rejected records in the shape of the load-error table: what is wrong,
    where in the record and in which column (``record_error``); ``numbered``
    (from ``number_rejects``) fills the line column."""
    names = [c for c in raw.columns if c not in (CORRUPT_COL, FILE_COL, *POS_COLS)]
    src = raw.filter(F.col(CORRUPT_COL).isNotNull())
    line = F.lit(None).cast("decimal(38,0)")
    if numbered is not None:
        src, line = numbered, F.col("line")
    return (src.select(FILE_COL, line.alias("line"), CORRUPT_COL)
            .withColumn("_e", record_error(F.col(CORRUPT_COL), names, delimiter_for(file_format)))
            .select("_e.error", F.col(FILE_COL).alias("file"), "line", "_e.character",
                    F.lit("parsing").alias("category"), F.lit(table_name).alias("table_name"),
                    "_e.column_name", F.col(CORRUPT_COL).alias("rejected_record"),
                    F.localtimestamp().alias("md_insert_date")))


def read_strict(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
                header: bool = True) -> DataFrame:
    """S3: any malformed row fails the job (ON_ERROR = ABORT).

    Files with quoted line breaks are cut into records by ``quoted_records``, so
    many tasks read one file; an unclosed quote fails the job, too."""
    if not _lines(spark, path, sep, "UTF-8").filter("_o").limit(1).count():
        return (_reader(spark, sep, header, "UTF-8").option("mode", "FAILFAST")
                .option("columnPruning", False).schema(schema).csv(path))
    options = {"sep": sep, "quote": '"', "escape": '"', "nullValue": "", "mode": "FAILFAST"}
    text = F.when(F.col("_unclosed"), F.raise_error(F.concat(
        F.lit(f"{UNCLOSED}: "), F.col(FILE_COL), F.lit(" line "), F.col(LINE_COL).cast("string"))))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return (quoted_records(spark, path, sep, header, "UTF-8")
            .select(F.from_csv(F.coalesce(text.cast("string"), F.col("_text")), columns,
                               options).alias("r")).select("r.*"))


def read_headerless(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Headerless, quoted CSV bound by position to the target's columns."""
    return (_reader(spark, ",", False, "UTF-8").option("mode", "FAILFAST")
            .schema(schema).csv(path))
