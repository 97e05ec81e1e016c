"""Streams against their batch twins."""

import os
import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from dockflow.functions.time import version_of
from dockflow.operators import pit
from dockflow.sources import adapters
from dockflow.streaming import streams

D = "/root/testdata/sf0.001"
SCHEMA = "station_id string, fetched_at timestamp, bike_count int"


def typed(spark):
    return adapters.snapshots(spark, D).where("fetched_at >= timestamp_ntz'2024-01-10' and fetched_at < timestamp_ntz'2024-01-10 06:00:00'").withColumn("fetched_at", F.col("fetched_at").cast("timestamp"))


def test_sink_is_exactly_once_and_routes_by_collection_day(spark, tmp_path):
    batch = typed(spark)
    batch.union(batch.limit(50)).repartition(3).write.parquet(f"file://{tmp_path}/in")
    for run in ("a", "b"):  # a second reader replays everything
        q = streams.write_once(streams.dedupe_stream(streams.typed_stream(spark, f"file://{tmp_path}/in", SCHEMA)), f"file://{tmp_path}/out", f"file://{tmp_path}/cp-{run}", ["station_id", "fetched_at"])
        q.awaitTermination(120)
    out = spark.read.parquet(f"file://{tmp_path}/out")
    assert out.count() == batch.count()
    assert [str(r.day) for r in out.select("day").distinct().collect()] == ["2024-01-10"]


def files(spark, tmp_path, batches, name="in"):
    """Each batch is a file, older ones first, and the stream takes one at a time."""
    import time

    for i, rows in enumerate(batches):
        spark.createDataFrame([(st, at(t), n) for st, t, n in rows], SCHEMA).coalesce(1).write.parquet(f"file://{tmp_path}/{name}-{i}")
        (tmp_path / name).mkdir(exist_ok=True)
        for f in (tmp_path / f"{name}-{i}").glob("*.parquet"):
            f.rename(tmp_path / name / f"{i}.parquet")
            os.utime(tmp_path / name / f"{i}.parquet", (time.time() - 1000 + i, time.time() - 1000 + i))
    return streams.typed_stream(spark, f"file://{tmp_path}/{name}", SCHEMA, max_files=1)


def at(minutes):
    return datetime(2024, 1, 10, tzinfo=timezone.utc) + timedelta(minutes=minutes)


def test_slot_coverage_is_exact_with_late_and_repeated_rows(spark, tmp_path):
    r = random.Random(1)
    rows = [(f"ST-{r.randrange(300)}", r.randrange(0, 55), 1) for _ in range(4000)]
    rows += rows[:700]
    end = [("end", 60 * 48, 1)]
    stream = files(spark, tmp_path, [rows[0::3], rows[1::3], rows[2::3], end])
    q = streams.slot_coverage(stream, "2 hours").writeStream.outputMode("append").format("memory").queryName("slots").trigger(availableNow=True).option("checkpointLocation", f"file://{tmp_path}/cp").start()
    q.awaitTermination(180)
    want = streams.slot_coverage_batch(spark.createDataFrame([(st, at(t), n) for st, t, n in rows], SCHEMA).withColumn("fetched_at", F.col("fetched_at").cast("timestamp_ntz")))
    assert {(str(x.slot_start), x.rows, x.stations) for x in spark.table("slots").collect()} == {(str(x.slot_start), x.rows, x.stations) for x in want.collect()} != set()


def test_latest_state_equals_batch_after_every_batch(spark, tmp_path):
    """Stations that fall silent leave the result and the state; a restart goes on where the last run ended."""
    batches = [
        [("A", 0, 5), ("B", 3, 6), ("C", 0, 1), ("A", 0, 4)], [("A", 200, 7), ("C", 30, 2)], [("A", 400, 8), ("B", 380, 3), ("B", 370, 9)], [("D", 900, 1), ("C", 10, 9)], [("A", 905, 2), ("D", 890, 7)],
    ]
    table, cp = f"file://{tmp_path}/table", f"file://{tmp_path}/cp"
    so_far = []
    for i, rows in enumerate(batches):  # a run, that is a restart, for each batch
        stream = files(spark, tmp_path, [rows], f"part{i}")
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / f"part{i}" / "0.parquet").rename(tmp_path / "in" / f"{i}.parquet")
        stream = streams.typed_stream(spark, f"file://{tmp_path}/in", SCHEMA, max_files=1)
        q = streams.keep_latest(stream, table, cp, "6 hours", buckets=3)
        q.awaitTermination(180)
        assert q.exception() is None
        so_far += rows
        every = spark.createDataFrame([(st, at(t), n) for st, t, n in so_far], SCHEMA)
        cutoff = at(max(t for _, t, _ in so_far)) - timedelta(hours=6)
        want = pit.latest_state(every, after=F.lit(cutoff))
        key = lambda df: sorted((x.station_id, str(x.fetched_at), x.bike_count) for x in df.collect())
        assert key(streams.latest_table(spark, table)) == key(want)
    gone = spark.read.parquet(table).where("not live")
    assert {x.station_id for x in gone.collect()} == {"B", "C"}  # their state was removed by timers


def test_late_rows_land_once_through_the_loader(spark, tmp_path):
    day = 24 * 60
    batches = [[("A", 10 * day, 1)], [("A", 10 * day + 10, 2), ("B", 2 * day, 7), ("B", 2 * day, 7), ("C", 4 * day, 5)], [("A", 11 * day, 3)]]
    table, late, manifest = (f"file://{tmp_path}/{x}" for x in ("table", "late", "manifest"))
    keys = ["station_id", "fetched_at"]
    stream = files(spark, tmp_path, batches)
    for run in "ab":  # a second reader replays everything
        q = streams.write_splitting_late(stream, table, late, f"file://{tmp_path}/marks", f"file://{tmp_path}/cp-{run}", keys)
        q.awaitTermination(180)
        assert q.exception() is None
    assert {x.station_id for x in spark.read.parquet(late).collect()} == {"B"}
    assert {x.station_id for x in spark.read.parquet(table).collect()} == {"A", "C"}
    like = spark.createDataFrame([], SCHEMA)
    for again in (False, True):
        done, failed = streams.load_late(spark, late, table, manifest, like, keys, "2024-01-21")
        assert not failed and [str(x) for x in done] == ([] if again else ["2024-01-12"])
        got = spark.read.parquet(table)
        assert got.count() == 5 and [str(x.day) for x in got.where("station_id = 'B'").collect()] == ["2024-01-12"]


def test_each_whole_issue_is_scored_once(spark, tmp_path):
    base = datetime(2024, 1, 10, 5)
    cells = lambda b, hours: [(b, b + timedelta(hours=h), c, "1.0", 60, 127) for h in hours for c in ("TMP", "PCP", "WSD", "REH", "SNO", "POP")]
    schema = "base_at timestamp_ntz, target_at timestamp_ntz, category string, value string, nx int, ny int"
    later, stale = base + timedelta(hours=3), base + timedelta(hours=6)
    parts = [cells(base, range(1, 30)), cells(base, range(20, 49)) + cells(later, range(1, 20)), cells(stale, range(1, 49)) + cells(base, range(1, 9))]
    (tmp_path / "in").mkdir()
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"file://{tmp_path}/p{i}")
        for f in (tmp_path / f"p{i}").glob("*.parquet"):
            f.rename(tmp_path / "in" / f"{i}.parquet")
            os.utime(tmp_path / "in" / f"{i}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    asked = []

    def score(forecast, base_at):
        asked.append(base_at)
        if base_at == stale:
            raise RuntimeError("no recent snapshot")
        return forecast.select("target_at").distinct().select(F.lit("ST-1").alias("station_id"), F.col("target_at").alias("hour_start"), version_of("v1", F.lit(base_at)).alias("model_version"), F.lit(1.5).alias("predicted_rentals"), F.lit(base_at).alias("created_at"))

    kept, out, refused = (f"file://{tmp_path}/{x}" for x in ("kept", "out", "refused"))
    for run in "ab":
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/in")
        q = streams.score_issues(stream, kept, out, refused, f"file://{tmp_path}/cp-{run}", score)
        q.awaitTermination(240)
        assert q.exception() is None
        got = spark.read.parquet(out).collect()
        assert len(got) == 48 and {x.model_version for x in got} == {"v1-fcst202401100500"}
        assert [(x.base_at, x.reason) for x in spark.read.parquet(refused).collect()] == [(stale, "no recent snapshot")]
    assert later not in asked


def test_zero_alerts_equal_batch(spark, tmp_path):
    """Alerts of issues whose horizon is over by the watermark are those of the batch twin."""
    snaps = typed(spark)
    issues = snaps.where("fetched_at in (timestamp'2024-01-10 00:20:00', timestamp'2024-01-10 01:40:00')").select(F.col("fetched_at").alias("as_of"), "station_id")
    none = [r.station_id for r in snaps.groupBy("station_id").agg(F.min("bike_count").alias("low")).where("low > 0").limit(2).collect()]
    silent = spark.createDataFrame([(s,) for s in [*none, "ST-none"]], "station_id string").select(F.lit("2024-01-10 00:20:00").cast("timestamp").alias("as_of"), "station_id")
    issues = issues.union(silent.join(issues, ["as_of", "station_id"], "left_anti").select("as_of", "station_id"))
    late = spark.createDataFrame([("end", 9)], "station_id string, bike_count int").withColumn("fetched_at", F.lit("2024-01-11 12:00:00").cast("timestamp"))
    snaps.union(late.select("station_id", "fetched_at", F.lit(0).alias("bike_count"))).repartition(2).write.parquet(f"file://{tmp_path}/snaps")
    issues.union(late.select("fetched_at", "station_id")).repartition(2).write.parquet(f"file://{tmp_path}/issues")
    stream = streams.zero_alerts(streams.typed_stream(spark, f"file://{tmp_path}/issues", "as_of timestamp, station_id string"), streams.typed_stream(spark, f"file://{tmp_path}/snaps", SCHEMA))
    q = stream.writeStream.outputMode("append").format("memory").queryName("alerts").trigger(availableNow=True).option("checkpointLocation", f"file://{tmp_path}/cp").start()
    q.awaitTermination(180)
    ntz = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    want = streams.zero_alerts_batch(issues.select(ntz("as_of"), "station_id"), snaps.select("station_id", ntz("fetched_at"), "bike_count"))
    got = {tuple(r) for r in spark.table("alerts").collect()}
    assert got == {tuple(r) for r in want.collect()}
    assert {r[2] is None for r in got} == {True, False}  # issues without a zero come out too
