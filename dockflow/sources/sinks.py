"""Keyed and partitioned writers (SR-06, SR-19..29). A table is a folder of Parquet; Spark's commit protocol keeps half-written
results out of sight."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, TimestampNTZType, TimestampType


def write_month_partition(df: DataFrame, path: str, partition: str = "month") -> None:
    """Replace the months that ``df`` holds, and no others (SR-06). Adaptive execution cuts a month that is larger than a shuffle partition should be into
    several tasks and files, and puts small ones together."""
    df.hint("rebalance", F.col(partition)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(partition).parquet(path)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder in ``spark.checkpoint.dir``, or beside the warehouse where that isn't set. A cluster whose warehouse is on the machines' own disks is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        root, conf = spark.conf.get("spark.sql.warehouse.dir"), spark.sparkContext.getConf()
        if spark.sparkContext.master.split("[")[0] != "local" and not conf.contains("spark.sql.warehouse.dir"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the cluster shares")
    return f"{root.rstrip('/')}/scratch-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """Write a frame to a scratch folder and read it back: lineage ends, and its size is known to what reads it."""
    path = scratch_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows that ``checked`` lets be broadcast.
BROADCAST_ROWS = 400_000


def checked(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A small side of a join, written and counted: broadcast if it has at most ``limit`` rows, else both sides are sorted. The estimates of
    Catalyst don't see what an explode multiplies, so without this it may broadcast the large side."""
    side = kept(df)
    return F.broadcast(side) if side.count() <= limit else side.hint("merge")


def write_csv_file(df: DataFrame, path: str, header: bool = True) -> None:
    """One CSV part of a file that is small by nature (a month's export)."""
    df.coalesce(1).write.mode("overwrite").option("header", header).option("emptyValue", "").csv(path)


def read_or_empty(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    try:
        return spark.read.schema(like.schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], like.schema)


#: Rows that one task of a keyed write holds in memory.
ROWS_A_TASK = 3_000_000


def unseen(target: DataFrame, rows: DataFrame, keys: list[str], decided: tuple[str, ...] = (), tasks: int | None = None, dealt: tuple[str, ...] = ()) -> DataFrame:
    """Of each key of ``rows`` that ``target`` lacks, one row: the lowest by its other columns (SR-19), NULL first. ``decided``: columns that the keys decide;
    ``tasks``: how many share the keys (adaptive execution judges by compressed bytes, of which a few are a row here). ``dealt``: keys, or columns that
    they decide, by which ``rows`` come dealt to ``tasks`` partitions; then only ``target`` is shuffled, in the same way. Rows that come otherwise are shuffled and give the same result.

    Keys of both sides are one hash aggregate: nothing is sorted or joined. A struct can't be in such an aggregate, so a single column is
    compared as it is. NULL keys are equal."""
    rest = [c for c in rows.columns if c not in keys and c not in decided]
    one = rows.schema[rest[0]].dataType if len(rest) == 1 else None
    if one is not None and isinstance(one, (NumericType, DateType, TimestampType, TimestampNTZType, BooleanType)):
        mine = rows.select(*keys, *decided, F.col(rest[0]).alias("__v"), F.col(rest[0]).isNull().alias("__none"), F.lit(False).alias("__old"))
        lowest = [F.when(~F.max("__none"), F.min("__v")).alias(rest[0])]
    else:
        mine = rows.select(*keys, *decided, F.struct(*(rest or keys)).alias("__v"), F.lit(False).alias("__old"))
        lowest = [F.min("__v").alias("__r")]
    held = target.select(*keys, *decided, *(F.lit(None).cast(mine.schema[c].dataType).alias(c) for c in mine.columns if c in ("__v", "__none")), F.lit(True).alias("__old"))
    if tasks:
        both = mine.unionByName(held.repartition(tasks, *dealt)) if dealt else mine.unionByName(held).repartition(tasks, *keys)
    else:
        both = mine.unionByName(held)
    found = both.groupBy(*keys, *decided).agg(*lowest, F.max("__old").alias("__old")).where("not __old")
    return found.select(*(F.col(c) if c not in rest or c in found.columns else F.col(f"__r.{c}").alias(c) for c in rows.columns))


def insert_ignore(path: str, rows: DataFrame, keys: list[str], partition: str | None = None, dealt: tuple[str, ...] = (), tasks: int | None = None) -> int:
    """Append unseen keys; the number of rows added. Running it again adds none. With ``partition``, a column that the keys decide, only the
    folders of the partitions that ``rows`` holds are read and written (a batch holds few), and a task holds ROWS_A_TASK rows. New rows are counted as they are
    written, not kept. ``dealt`` and ``tasks``: ``rows`` come from ``repartition(tasks, *dealt)``, by some of the keys or ``partition``, and stay where they are (``unseen``)."""
    target = read_or_empty(rows.sparkSession, path, rows)
    if partition and dealt:
        if not target.isEmpty():
            target = target.where(F.col(partition).isin([r[0] for r in rows.select(partition).distinct().collect()]))
    elif partition:
        sizes = rows.groupBy(partition).agg(F.count("*").alias("n")).collect()
        target = target.where(F.col(partition).isin([r[0] for r in sizes]))
        tasks = -(-(sum(r["n"] for r in sizes) + target.count()) // ROWS_A_TASK) or 1
    count = Observation()
    new = unseen(target, rows, keys, (partition,) if partition and partition not in keys else (), tasks, dealt).observe(count, F.count("*").alias("n"))
    out = new.write.mode("append")
    (out.partitionBy(partition) if partition else out).parquet(path)
    return count.get["n"]


def merged(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` with the rows of ``rows`` in place of those of the same key; within ``rows`` the last ``updated_at`` counts (SR-20)."""
    both = target.withColumn("__p", F.lit(0)).unionByName(rows.withColumn("__p", F.lit(1)))
    w = Window.partitionBy(*keys).orderBy(F.desc("__p"), F.desc("updated_at"))
    return both.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n", "__p")


#: Rows of a partition that one task of an upsert sorts and writes.
UPSERT_ROWS = 1_000_000


def _by_partition(df: DataFrame, keys: list[str], partition: str, total: int, largest: int) -> DataFrame:
    """Rows dealt by partition, and by shares of the keys where a partition is large, so that a partition is a file or a few of them instead of one in every
    task. Rows of one key stay together."""
    share = F.pmod(F.xxhash64(*keys), F.lit(-(-largest // UPSERT_ROWS) or 1)).cast("int")
    return df.withColumn("__share", share).repartition(-(-total // UPSERT_ROWS) or 1, partition, "__share")


def upsert_partition(path: str, rows: DataFrame, keys: list[str], partition: str) -> None:
    """Merge into the partitions that ``rows`` touches and overwrite only those. What is read is cut off from what is written
    by a table in between, if anything of the target is read. The touched partitions are counted; where the partition is one of the keys, merging
    and writing share one shuffle and one order."""
    spark = rows.sparkSession
    target = read_or_empty(spark, path, rows)
    new = {r[0]: r["n"] for r in rows.groupBy(partition).agg(F.count("*").alias("n")).collect()}
    touched = target.where(F.col(partition).isin([k for k in new if k is not None])).select(*rows.columns)
    held = {r[0]: r["n"] for r in touched.groupBy(partition).agg(F.count("*").alias("n")).collect()}
    old = touched if held else rows.where("false")
    if partition in keys:
        sizes = [n + held.get(k, 0) for k, n in new.items()]
        deal = lambda df: _by_partition(df, keys, partition, sum(sizes), max(sizes, default=0))
        order = [partition, "__share", *(k for k in keys if k != partition)]
        both = deal(old.withColumn("__p", F.lit(0)).unionByName(rows.withColumn("__p", F.lit(1))))
        w = Window.partitionBy(*order).orderBy(F.desc("__p"), F.desc("updated_at"))
        out = both.withColumn("__n", F.row_number().over(w)).where("__n = 1").select(*rows.columns)
    else:
        out = merged(old, rows, keys)
    if held:
        between = scratch_folder(spark)
        out.write.option("compression", "zstd").parquet(between)
        out = spark.read.schema(out.schema).parquet(between)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def load_snapshots(rows: DataFrame) -> DataFrame:
    """Text snapshots to typed rows; no station or no count drops a row; counts go through a float text (SR-21)."""
    def number(c: str):
        return F.nullif(F.col(c), F.lit("")).try_cast("double").try_cast("int")

    t = rows.select(F.nullif(F.trim("station_id"), F.lit("")).alias("station_id"), F.try_to_timestamp("fetched_at").alias("fetched_at"), number("bike_count").alias("bike_count"), number("rack_count").alias("rack_count"))
    return t.where("station_id is not null and bike_count is not null")


def discover_stations(snapshots: DataFrame, known: DataFrame) -> DataFrame:
    """Stations that only snapshots know, as their last row says, with source 'realtime' (SR-22)."""
    rest = [c for c in snapshots.columns if c not in ("station_id", "fetched_at")]
    last = snapshots.groupBy("station_id").agg(F.max(F.struct("fetched_at", *rest)).alias("r")).select("station_id", *(F.col(f"r.{c}").alias(c) for c in rest))
    return last.join(known.select("station_id"), "station_id", "left_anti").withColumn("source", F.lit("realtime"))


def load_forecasts(path: str, rows: DataFrame) -> int:
    """Five-key insert-ignore, values as text (SR-23)."""
    return insert_ignore(path, rows, ["base_at", "target_at", "category", "nx", "ny"])


def pending_days(landed: DataFrame, manifest: DataFrame, today: str, back: int = 7) -> DataFrame:
    """Days of the last ``back`` whose landed files differ from the loaded list (SR-24, SO-03)."""
    recent = lambda df: df.where((F.col("day") > F.date_sub(F.lit(today).cast("date"), back)) & (F.col("day") <= F.lit(today).cast("date")))
    a = recent(landed).groupBy("day").agg(F.array_sort(F.collect_set("file")).alias("landed"))
    b = recent(manifest).groupBy("day").agg(F.array_sort(F.collect_set("file")).alias("loaded"))
    return a.join(b, "day", "left").where(~F.col("landed").eqNullSafe(F.col("loaded"))).select("day", "landed")


def recover_days(landed: DataFrame, manifest_path: str, today: str, load, back: int = 7) -> tuple[list, list]:
    """Reload the pending days, one after another; a day that fails doesn't stop the others and is recorded only once it is
    loaded. At most ``back`` days come to the driver. Returns days loaded and (day, error) of those that weren't."""
    spark = landed.sparkSession
    manifest = read_or_empty(spark, manifest_path, landed.select("day", "file"))
    done, failed = [], []
    for row in pending_days(landed, manifest, today, back).orderBy("day").collect():
        try:
            load(row["day"])
        except Exception as e:  # noqa: BLE001  the report carries it
            failed.append((row["day"], str(e)))
            continue
        files = spark.createDataFrame([(row["day"], f) for f in row["landed"]], "day date, file string")
        insert_ignore(manifest_path, files, ["day", "file"])
        done.append(row["day"])
    return done, failed


def write_artifacts(frames: dict[str, DataFrame], path: str) -> None:
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def read_artifacts(spark: SparkSession, path: str, names: list[str], optional: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Frozen tables; an optional one (name to schema) that isn't there is empty, so its features are NULL (SR-25, SR-26)."""
    out = {n: spark.read.parquet(f"{path}/{n}") for n in names}
    for n, schema in (optional or {}).items():
        out[n] = read_or_empty(spark, f"{path}/{n}", spark.createDataFrame([], schema))
    return out


def write_predictions(path: str, rows: DataFrame) -> None:
    """Keyed by station, hour and version; a version written again replaces its values (SR-27)."""
    upsert_partition(path, rows.withColumn("updated_at", F.col("created_at")), ["station_id", "hour_start", "model_version"], "model_version")


def publish_generation(frames: dict[str, DataFrame], path: str, generation: str) -> None:
    """All tables of a generation first, the pointer last (SR-28)."""
    spark = next(iter(frames.values())).sparkSession
    write_artifacts(frames, f"{path}/generation={generation}")
    spark.createDataFrame([(generation,)], "generation string").withColumn("published_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{path}/pointer")


def current_generation(spark: SparkSession, path: str) -> str:
    return spark.read.parquet(f"{path}/pointer").agg(F.max_by("generation", "published_at")).first()[0]


def write_report(rows: DataFrame, path: str) -> None:
    """Long report rows (metric, group, value) as JSON lines (SR-29)."""
    rows.select("metric", "group", "value").write.mode("overwrite").json(path)
