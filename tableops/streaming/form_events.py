"""Once-only processing of new form entries with Structured Streaming
(S13, X1, X2, X3, X4).

Input: a folder (or any streaming source) receiving change notifications;
each notification carries sheet rows ``(row_id, record_source, <form
fields>...)``.  A row announced by several notifications is handled once:

* X1 ``notification_stream`` reads the stream and classifies each
  notification (T23);
* X2 ``new_form_entries`` keeps rows whose Record Source is
  'Form - New Entry', and a row id is handled once.  By default the stream
  keeps no state: a batch drops its own repeats and the row ids that the
  committed status table has, so a repeat is found however late it comes, also
  after a restart or with a new checkpoint.  With ``keep_state`` the streaming
  state store drops repeats (one row per row id for ever), or those within an
  event-time watermark (late rows are then dropped, too);
* X3 ``process_batch`` runs per micro-batch in the reference's order:
  status updates first, then notifications, then comments.  Outputs are
  partitioned by stream id and batch id.  After the status step a marker is
  written; a replayed batch with a marker is read (its state has to move on)
  but sends nothing, so no notification is sent twice ("better no
  notification than two").  A replay without a marker overwrites its own
  half-written status rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import forms
from ..sinks.writers import path_exists

STATUS_DIR, NOTIFY_DIR, COMMENT_DIR = "status_updates", "notifications", "comments"
DONE_DIR = "done_batches"


def form_row_schema(titles: list[str] = forms.FORM_TITLES) -> T.StructType:
    """Notification rows: ``row_id``, ``header`` and one text field per title
    (plus ``<title>__display`` for the display value of 'Value' and 'Comments')."""
    fields = [T.StructField("row_id", T.LongType()), T.StructField("header", T.StringType()),
              T.StructField("event_time", T.TimestampType())]
    fields += [T.StructField(t, T.StringType()) for t in titles]
    fields += [T.StructField(f"{t}__display", T.StringType())
               for t in (forms.DISPLAY_VALUE_TITLE, forms.COMMENTS)]
    return T.StructType(fields)


def notification_stream(spark: SparkSession, source_dir: str,
                        schema: T.StructType | None = None,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """S13 + X1: JSON notifications from a folder, classified."""
    reader = spark.readStream.schema(schema or form_row_schema())
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(source_dir).withColumn("kind", forms.classify_notification("header"))


def new_form_entries(stream: DataFrame, watermark: str | None = None,
                     keep_state: bool = True) -> DataFrame:
    """Change notifications only, new entries only; with ``keep_state`` each
    row id once (without it, ``process_batch`` has to drop repeats)."""
    rows = forms.new_entries(stream.filter(F.col("kind") == forms.KIND_CHANGE))
    if not keep_state:
        return rows
    if watermark:
        return (rows.withWatermark("event_time", watermark)
                .dropDuplicatesWithinWatermark(["row_id"]))
    return rows.dropDuplicates(["row_id"])


def _marker(spark: SparkSession, out_dir: str, stream_id: str, batch_id: int):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{out_dir}/{DONE_DIR}/{stream_id}/{batch_id}")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


STATUS_KEYS = "row_id long, stream_id string, batch_id long"


def not_handled(rows: DataFrame, out_dir: str, stream_id: str, batch_id: int) -> DataFrame:
    """X2 without state: the rows of a batch, one per row id, whose id no other
    batch has put into the status table (its ids alone are read)."""
    spark = rows.sparkSession
    fresh = rows.dropDuplicates(["row_id"])
    status = f"{out_dir}/{STATUS_DIR}"
    if not path_exists(spark, status):
        return fresh
    own = (F.col("stream_id") == stream_id) & (F.col("batch_id") == batch_id)
    seen = spark.read.schema(STATUS_KEYS).parquet(status).filter(~own).select("row_id")
    return fresh.join(seen, "row_id", "left_anti")


def process_batch(out_dir: str, record_source_column_id: int, stream_id: str = "stream",
                  drop_handled: bool = False) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function writing the three outputs in order;
    with ``drop_handled`` for rows that no batch has handled before.

    ``stream_id`` names the stream whose batch ids count: a new checkpoint is a
    new stream, whose batch 0 is no replay of another stream's."""
    def _run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fs, done = _marker(spark, out_dir, stream_id, batch_id)
        if fs.exists(done):
            # acted on before: only the stateful operators must see the input
            batch.write.format("noop").mode("overwrite").save()
            return
        rows = batch.select(*[c for c in batch.columns if c != "kind"])
        if drop_handled:
            rows = not_handled(rows, out_dir, stream_id, batch_id)
        rows.persist()
        try:
            tags = [F.lit(stream_id).alias("stream_id"),
                    F.lit(batch_id).cast("long").alias("batch_id")]

            def put(df: DataFrame, name: str) -> None:
                (df.select("*", *tags).write.mode("overwrite")
                 .option("partitionOverwriteMode", "dynamic")
                 .partitionBy("stream_id", "batch_id").parquet(f"{out_dir}/{name}"))

            # 1. status updates first
            put(rows.select("row_id", F.lit(record_source_column_id).cast("long")
                            .alias("column_id"), F.lit(forms.PROCESSED).alias("new_value")),
                STATUS_DIR)
            fs.create(done, True).close()
            # 2. notifications
            put(forms.render_notification(rows), NOTIFY_DIR)
            # 3. comments
            put(forms.comments(rows), COMMENT_DIR)
        finally:
            rows.unpersist()
    return _run


def run_available(spark: SparkSession, source_dir: str, out_dir: str, checkpoint_dir: str,
                  record_source_column_id: int = 1, max_files_per_trigger: int | None = None,
                  watermark: str | None = None, keep_state: bool = False) -> None:
    """Process everything present in ``source_dir`` now (``availableNow``)
    and stop; rerunning later picks up only new files.  The checkpoint folder
    names the stream.  With a ``watermark`` state is kept, too."""
    keep_state = keep_state or watermark is not None
    stream_id = hashlib.sha256(checkpoint_dir.encode()).hexdigest()[:16]
    stream = notification_stream(spark, source_dir, max_files_per_trigger=max_files_per_trigger)
    q = (new_form_entries(stream, watermark, keep_state).writeStream
         .foreachBatch(process_batch(out_dir, record_source_column_id, stream_id, not keep_state))
         .option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True).start())
    q.awaitTermination()
