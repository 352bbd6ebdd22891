"""Incremental ingest of raw CSV drops with Structured Streaming.

The cleaning and tag operators are stateless column expressions, so they run
unchanged on a streaming DataFrame. Each micro-batch is cleaned once (its
wide rows are persisted), checked by the load rules, and written as titles,
tags and their rejects into folders named by the batch id with overwrite, so
a batch replayed after a failure replaces its own output (exactly-once
files); the stream's checkpoint records which input files were processed.
Readers that need a batch whole wait for its ``movie_genres`` folder, the
last one written. ``available_now``
processes whatever has arrived and stops, matching a scheduled batch run.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from marquee.functions.tags import GENRE_CORRECTIONS
from marquee.functions.text import PANDAS_NULL_TOKENS, nullify_tokens
from marquee.operators import audit, clean


def read_raw_stream(spark: SparkSession, source_dir: str, columns: Sequence[str],
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming all-string CSV source over a folder of headered files."""
    schema = StructType([StructField(c, StringType(), True) for c in columns])
    r = (spark.readStream.schema(schema).option("header", True).option("escape", '"')
         .option("multiLine", True))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return nullify_tokens(r.csv(source_dir), PANDAS_NULL_TOKENS)


def stream_clean(spark: SparkSession, source_dir: str, columns: Sequence[str], out_dir: str,
                 checkpoint_dir: str, mapping: Mapping[str, str] = GENRE_CORRECTIONS,
                 available_now: bool = True, keep: Sequence[str] = ()) -> StreamingQuery:
    """Start the ingest; returns the running query (``awaitTermination`` it)."""
    raw = read_raw_stream(spark, source_dir, columns)

    t_rules = {**audit.title_rules(), "roi_out_of_range": audit.roi_out_of_range()}

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        wide = clean.clean_wide(batch, mapping, keep=keep, audit=True).withColumn("_reason", audit.first_reason(t_rules)).persist()
        titles, tags = clean.split_wide(wide, keep=keep)
        good, bad = audit.split_valid(tags, audit.tag_rules())
        out = {"movies_rejects": titles.filter("_reason IS NOT NULL").withColumnRenamed("_reason", "reason"),
               "movie_genres_rejects": bad, "movies": titles.filter("_reason IS NULL").select(*keep, *clean.TITLE_COLUMNS), "movie_genres": good}
        for name, df in out.items():
            df.write.mode("overwrite").parquet(f"{out_dir}/{name}/batch={batch_id}")
        wide.unpersist()

    w = raw.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
