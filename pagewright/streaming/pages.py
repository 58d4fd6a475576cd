"""Pages that come in over time: late and repeated lines, running reports, and what an earlier run left to do."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.lines import is_low_confidence


def stage_key(stage: Column, content: Column) -> Column:
    """Sixteen hexadecimal digits that stand for a stage and what it worked on."""
    return F.substring(F.sha1(F.concat(stage, F.lit("\x1f"), F.coalesce(content, F.lit("")))), 1, 16)


def page_keys(lines: DataFrame) -> DataFrame:
    """(book, page, key): a key of each page's lines, whatever order they come in."""
    ordered = F.sort_array(F.collect_list(F.struct("line_id", "text")))
    return lines.groupBy("book", "page").agg(ordered.alias("_l")).select("book", "page", stage_key(F.lit("page"), F.to_json("_l")).alias("key"))


def stale(now: DataFrame, done: DataFrame) -> DataFrame:
    """(book, page) whose key an earlier run did not see: only these are done again."""
    return now.join(done.select("book", "page", "key"), ["book", "page", "key"], "left_anti").select("book", "page")


def line_stream(spark: SparkSession, path: str, schema_of: DataFrame, per_trigger: int = 1) -> DataFrame:
    """Lines from parquet files that are added to a folder."""
    return spark.readStream.schema(schema_of.schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def first_deliveries(lines: DataFrame, late_by: str = "60 days") -> DataFrame:
    """Lines without those that were delivered before under the same line_id; the state of a line is kept for
    `late_by` of event time, and lines later than that are left out."""
    return lines.where("read_at is not null and line_id is not null").withWatermark("read_at", late_by).dropDuplicatesWithinWatermark(["line_id"])


def daily_counts(lines: DataFrame, late_by: str = "60 days") -> DataFrame:
    """(day, book, lines, low_conf_lines) over tumbling days, each once the watermark has passed it."""
    day = F.window("read_at", "1 day")
    counted = lines.withWatermark("read_at", late_by).groupBy(day.alias("w"), "book").agg(F.count("*").alias("lines"), F.sum(is_low_confidence(F.col("conf")).cast("long")).alias("low_conf_lines"))
    return counted.select(F.col("w.start").alias("day"), "book", "lines", "low_conf_lines")


def run_to_end(frame: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Work off all that has come, batch by batch, and stop; a later call goes on from the checkpoint."""
    started = frame.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink).start()
    started.awaitTermination()
    return started
