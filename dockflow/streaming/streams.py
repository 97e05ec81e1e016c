"""Snapshot and forecast streams (ST-01..09); each has a batch twin that defines the result."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.pit import window_rows
from ..operators.weather import whole_issues
from ..sources.readers import SNAPSHOT_SCHEMA, snapshot_rows
from ..sources.sinks import insert_ignore, kept, load_forecasts, load_snapshots, read_or_empty, recover_days, upsert_partition

LATE = "7 days"


def snapshot_stream(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """New payload files below the day folders, typed (ST-01)."""
    raw = spark.readStream.schema(SNAPSHOT_SCHEMA).option("multiLine", "true").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files).json(path)
    return load_snapshots(snapshot_rows(raw))


def typed_stream(spark: SparkSession, path: str, schema: str, max_files: int = 100) -> DataFrame:
    """Snapshots already typed, from Parquet files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def dedupe_stream(stream: DataFrame, late: str = LATE) -> DataFrame:
    """One row for each station and time; rows later than the watermark go to the batch loader (ST-03, ST-04)."""
    return stream.withWatermark("fetched_at", late).dropDuplicatesWithinWatermark(["station_id", "fetched_at"])


def write_once(stream: DataFrame, path: str, checkpoint: str, keys: list[str], partition: str | None = "day", available_now: bool = True) -> StreamingQuery:
    """Exactly-once sink: a batch adds only unseen keys, so a replay adds none (ST-02). The collection time, which is one of the keys, decides
    the day, whose folder alone is read and written (ST-05)."""
    def sink(batch: DataFrame, _: int) -> None:
        insert_ignore(path, batch.withColumn(partition, F.to_date("fetched_at")) if partition else batch, keys, partition)

    w = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 minutes")).start()


def write_splitting_late(stream: DataFrame, path: str, late_path: str, marks_path: str, checkpoint: str, keys: list[str], days: int = 7) -> StreamingQuery:
    """Like ``write_once``, but rows more than ``days`` behind the newest time of the batches before go to ``late_path`` (by day), from where
    ``load_late`` takes them, instead of being dropped by a watermark (ST-04).

    The newest time of each batch is a row of ``marks_path``; a batch looks at the marks of lower batch numbers alone, so a replayed one splits its rows in the
    same way, and both sinks add unseen keys only."""
    def sink(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        marks = read_or_empty(spark, marks_path, spark.createDataFrame([], "batch long, high timestamp"))
        high = marks.where(F.col("batch") < number).agg(F.max("high")).first()[0]
        routed = batch.withColumn("day", F.to_date("fetched_at"))
        behind = F.lit(False) if high is None else F.col("fetched_at") < F.lit(high) - F.expr(f"interval {days} days")
        insert_ignore(late_path, routed.where(behind), keys, "day")
        insert_ignore(path, routed.where(~behind), keys, "day")
        insert_ignore(marks_path, batch.agg(F.max("fetched_at").alias("high")).where("high is not null").select(F.lit(number).cast("long").alias("batch"), "high"), ["batch"])

    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def load_late(spark: SparkSession, late_path: str, path: str, manifest_path: str, like: DataFrame, keys: list[str], today: str, back: int = 3650) -> tuple[list, list]:
    """Days with late rows go through the batch loader, each file once (ST-04, SR-24): their rows are added to the day folders of ``path``."""
    late = read_or_empty(spark, late_path, like.withColumn("day", F.to_date("fetched_at")))
    landed = late.select("day", F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file")).distinct()
    return recover_days(landed, manifest_path, today, lambda day: insert_ignore(path, late.where(F.col("day") == F.lit(day)), keys, "day"), back)


def slot_coverage(stream: DataFrame, late: str = LATE) -> DataFrame:
    """Rows and stations of ten-minute windows that are over, exactly (ST-06): the first state holds a row for each window and station, the second one for
    each window. Repeated rows count as rows; rows behind the watermark are left out."""
    each = stream.withWatermark("fetched_at", late).groupBy(F.window("fetched_at", "10 minutes"), "station_id").agg(F.count("*").alias("rows"))
    return each.groupBy("window").agg(F.sum("rows").alias("rows"), F.count("*").alias("stations")).select(F.col("window.start").alias("slot_start"), "rows", "stations")


def slot_coverage_batch(snapshots: DataFrame) -> DataFrame:
    return snapshots.groupBy(F.window(F.col("fetched_at").cast("timestamp"), "10 minutes").alias("w")).agg(F.count("*").alias("rows"), F.countDistinct("station_id").alias("stations")).select(F.col("w.start").cast("timestamp_ntz").alias("slot_start"), "rows", "stations")


class NewestCount(StatefulProcessor):
    """The newest count of a station, as long as it isn't older than the watermark; a timer then removes it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", "fetched_at timestamp, bike_count int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.newest.get() if self.newest.exists() else None
        best = held
        for part in rows:
            top = part.sort_values(["fetched_at", "bike_count"]).iloc[-1]
            got = (pd.Timestamp(top["fetched_at"]).to_pydatetime(), int(top["bike_count"]))
            best = got if best is None else max(tuple(best), got)
        if best is not None and best != held:
            for timer in self.handle.listTimers():
                self.handle.deleteTimer(timer)
            self.newest.update(best)
            self.handle.registerTimer(int(pd.Timestamp(best[0]).tz_localize(None).timestamp() * 1000) + 1)
            yield pd.DataFrame({"station_id": [key[0]], "fetched_at": [best[0]], "bike_count": [best[1]], "live": [True]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.newest.exists():
            at, count = self.newest.get()
            self.newest.clear()
            yield pd.DataFrame({"station_id": [key[0]], "fetched_at": [at], "bike_count": [count], "live": [False]})

    def close(self) -> None:
        pass


LATEST = "station_id string, fetched_at timestamp, bike_count int, live boolean"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def latest_stream(stream: DataFrame, age: str = "6 hours") -> DataFrame:
    """Changes of the newest count of each station (ST-07): a row when it changes, and one with live = false when it is older than ``age`` before the newest
    time of all; then its state is gone. Needs the RocksDB state store (session time zone UTC)."""
    typed = stream.select("station_id", "fetched_at", "bike_count").withWatermark("fetched_at", age)
    return typed.groupBy("station_id").transformWithStateInPandas(NewestCount(), outputStructType=LATEST, outputMode="Update", timeMode="EventTime")


def keep_latest(stream: DataFrame, path: str, checkpoint: str, age: str = "6 hours", buckets: int = 32) -> StreamingQuery:
    """Run ``latest_stream`` into a table keyed by station, of which a batch rewrites the buckets it touches. A replay writes the same."""
    spark = stream.sparkSession

    def sink(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            upsert_partition(path, batch.withColumns({"updated_at": F.col("fetched_at"), "bucket": F.pmod(F.xxhash64("station_id"), F.lit(buckets)).cast("int")}), ["station_id"], "bucket")

    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    try:
        return latest_stream(stream, age).writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def latest_table(spark: SparkSession, path: str, age: str = "6 hours") -> DataFrame:
    """Stations of the table whose count is at most ``age`` older than the newest one: ``latest_state`` of all that has come, after each batch."""
    t = spark.read.parquet(path).where("live")
    high = F.broadcast(t.agg((F.max("fetched_at") - F.expr(f"interval {age}")).alias("__from")))  # one row
    return t.join(high, F.col("fetched_at") >= F.col("__from")).select("station_id", "fetched_at", "bike_count")


def score_issues(forecasts: DataFrame, forecast_path: str, predictions_path: str, refused_path: str, checkpoint: str, score: Callable[[DataFrame, datetime], DataFrame], hours: int = 48) -> StreamingQuery:
    """Each whole forecast issue makes one version of predictions (ST-08, SR-23, SR-27).

    A micro-batch's rows are kept by key. Issues that it completes are scored by ``score`` (kept forecast rows of the issue, its time), a function
    such as ``learn.predict_issue`` with its other inputs filled in, and written by version, so a replayed batch adds no row. An issue that is refused (stale or
    missing input) is a row of ``refused_path`` with the reason; the stream goes on."""
    from ..sources.sinks import write_predictions

    def sink(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        load_forecasts(forecast_path, batch)
        kept = read_or_empty(spark, forecast_path, batch)
        mine = batch.select("base_at").distinct()
        for (base,) in whole_issues(kept.join(F.broadcast(mine), "base_at", "left_semi"), hours).orderBy("base_at").collect():  # issues of one trigger: a few
            try:
                write_predictions(predictions_path, score(kept.where(F.col("base_at") == F.lit(base)), base))
            except RuntimeError as e:
                insert_ignore(refused_path, spark.createDataFrame([(base, str(e))], "base_at timestamp_ntz, reason string"), ["base_at"])

    return forecasts.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def zero_alerts(rows: DataFrame, snapshots: DataFrame, hours: int = 3, late: str = "1 hour") -> DataFrame:
    """First zero of each issue and station within its horizon, null where there is none (ST-09), from streams of issue rows (as_of, station_id) and of
    snapshots: a left outer stream-stream join on the station with both watermarks, whose matches are folded by issue. A row comes out when its horizon is over."""
    i = rows.select("as_of", "station_id").withWatermark("as_of", late)
    z = snapshots.where("bike_count = 0").select(F.col("station_id").alias("zero_station"), F.col("fetched_at").alias("zero_at")).withWatermark("zero_at", late)
    met = i.join(z, F.expr(f"station_id = zero_station and zero_at > as_of and zero_at <= as_of + interval {hours} hours"), "left_outer")
    return met.groupBy("as_of", "station_id").agg(F.min("zero_at").alias("first_zero"))


def zero_alerts_batch(rows: DataFrame, snapshots: DataFrame, hours: int = 3) -> DataFrame:
    """The batch twin: the same join by station and hour."""
    zeros = snapshots.where("bike_count = 0").select("station_id", F.col("fetched_at").alias("zero_at"))
    issues = kept(rows.select("as_of", "station_id").distinct())
    met = window_rows(issues, zeros, hours, time="zero_at", by=["station_id"])
    return issues.join(met.groupBy("as_of", "station_id").agg(F.min("zero_at").alias("first_zero")), ["as_of", "station_id"], "left")
