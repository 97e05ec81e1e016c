"""Readers of landed files (SR-01..18). Schemas are declared; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.parse import month_of_file
from ..functions.time import plus_hours, plus_minutes

#: Columns of the trip files in order, and those that may be missing.
TRIP_COLUMNS = ["bike_no", "rented_at", "rent_station_no", "rent_station_name", "rent_dock", "returned_at", "return_station_no", "return_station_name", "return_dock", "duration_min", "distance_m", "birth_year", "sex", "user_type", "rent_station_id", "return_station_id", "bike_type"]
OPTIONAL_COLUMNS = {"bike_type"}
STATION_COLUMNS = ["station_no", "station_name", "district", "address", "lat", "lon", "opened_at", "lcd_docks", "qr_docks", "operation"]
OBSERVATION_COLUMNS = ["observed_at", "station", "temp_c", "rain_mm", "wind_ms", "wind_dir", "humidity_pct", "vapour_hpa", "dew_c", "pressure_hpa", "sea_hpa", "sunshine_h", "radiation", "snow_cm", "new_snow_3h_cm"]
ISSUE_HOURS = (2, 5, 8, 11, 14, 17, 20, 23)
PAGE_ROWS = 1000


def blank_to_null(c: str) -> Column:
    return F.nullif(F.col(c), F.lit(""))


def check_headers(found: list[str], known: dict[str, str], optional: set[str] = OPTIONAL_COLUMNS) -> list[str]:
    """English names of the header, in its order; an unknown or missing one is an error (SR-02)."""
    unknown = [h for h in found if h not in known]
    missing = [e for e in known.values() if e not in optional and e not in [known.get(h) for h in found]]
    if unknown or missing:
        raise ValueError(f"unknown headers {unknown}, missing columns {missing}")
    return [known[h] for h in found]


def read_trip_csv(spark: SparkSession, paths: list[str], headers: dict[str, str], encoding: str = "MS949", named: str | None = None) -> DataFrame:
    r"""Trip files as strings in a fixed column order; ``\N`` and empty values are NULL, also when quoted (SR-01..03). ``headers``
    maps the files' header names to ours; ``named``: the name that counts where a file is a folder of parts. Only header lines come to the driver. Korean charsets need
    ``spark.sql.legacy.javaCharsets``."""
    parts = []
    for path in paths:
        header = spark.read.option("encoding", encoding).option("header", "false").csv(path).limit(1).first()
        names = check_headers([h for h in header if h is not None], headers)
        schema = ", ".join(f"`{n}` string" for n in names)
        df = spark.read.schema(schema).option("header", "true").option("encoding", encoding).option("nullValue", "\\N").option("emptyValue", "").option("enforceSchema", "true").csv(path)
        df = df.withColumn("source_file", F.lit(named) if named else F.col("_metadata.file_name"))
        parts.append(df.select(*((F.nullif(blank_to_null(c), F.lit("\\N")) if c in names else F.lit(None).cast("string")).alias(c) for c in TRIP_COLUMNS), "source_file"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("month", F.coalesce(month_of_file(F.col("source_file")), F.raise_error(F.concat(F.lit("no month in "), F.col("source_file"))).cast("string")))


def duplicate_periods(files: DataFrame, period: str = "month", source: str = "source_file") -> DataFrame:
    """Periods that more than one source claims (SR-05)."""
    return files.groupBy(period).agg(F.countDistinct(source).alias("sources")).where("sources > 1")


def reject_duplicate_periods(files: DataFrame, period: str = "month", source: str = "source_file") -> None:
    twice = duplicate_periods(files, period, source).limit(5).collect()
    if twice:
        raise ValueError(f"more than one source for {[r[0] for r in twice]}")


def latest_period(files: DataFrame, period: str = "month") -> DataFrame:
    """The newest month and its last day (SR-07)."""
    return files.agg(F.max(period).alias("month")).select("month", F.last_day(F.to_date(F.concat("month", F.lit("-01")))).alias("last_day"))


def read_station_snapshots(spark: SparkSession, path: str, header: str = "station_no") -> DataFrame:
    """Exported station sheets: the five header rows are dropped after their column was checked, ten columns by position, trimmed, blank
    to NULL, no row without a number; the snapshot is in the file name (SR-08)."""
    raw = spark.read.schema(", ".join(f"{c} string" for c in STATION_COLUMNS)).option("header", "false").csv(path).withColumn("source_file", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]*[0-9]{4}-[0-9]{2}[^/]*)", 1))
    headed = raw.groupBy("source_file").agg(F.max((F.trim("station_no") == header).cast("int")).alias("ok")).where("ok is null or ok = 0").limit(1).collect()
    if headed:
        raise ValueError(f"no header row in {headed[0][0]}")
    rows = raw.where(F.trim("station_no").rlike(r"^[0-9]+$"))
    return rows.select(*(F.nullif(F.trim(c), F.lit("")).alias(c) for c in STATION_COLUMNS), F.regexp_extract("source_file", r"([0-9]{4}-[0-9]{2})", 1).alias("snapshot"), "source_file")


def read_observations_json(spark: SparkSession, path: str, names: dict[str, str]) -> DataFrame:
    """Monthly JSON arrays to string columns under our names, '' to NULL (SR-09)."""
    raw = spark.read.schema(", ".join(f"`{n}` string" for n in names)).option("multiLine", "true").json(path)
    return raw.select(*(blank_to_null(n).alias(e) for n, e in names.items()))


def month_range(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Months between two, both included (SR-10)."""
    return spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(f"{first}-01")), F.to_date(F.lit(f"{last}-01")), F.expr("interval 1 month"))).alias("m")).select(F.date_format("m", "yyyy-MM").alias("month"))


def pending_months(months: DataFrame, landed: DataFrame, today: str) -> DataFrame:
    """Months not landed whose last day is over (SR-10)."""
    return months.join(landed.select("month").distinct(), "month", "left_anti").where(F.last_day(F.to_date(F.concat("month", F.lit("-01")))) < F.lit(today).cast("date"))


SNAPSHOT_SCHEMA = "fetched_at string, rentBikeStatus struct<row: array<struct<rackTotCnt:string,stationName:string,parkingBikeTotCnt:string,shared:string,stationLatitude:string,stationLongitude:string,stationId:string>>>, pages array<struct<total:int,rows:int>>"
SNAPSHOT_FIELDS = {"rackTotCnt": "rack_count", "stationName": "station_name", "parkingBikeTotCnt": "bike_count", "shared": "shared", "stationLatitude": "lat", "stationLongitude": "lon", "stationId": "station_id"}


def snapshot_rows(payload: DataFrame) -> DataFrame:
    """One row a station of landed payloads, seven string fields, '' to NULL (SR-11)."""
    r = payload.select("fetched_at", F.explode("rentBikeStatus.row").alias("r"))
    return r.select("fetched_at", *(F.nullif(F.col(f"r.{a}"), F.lit("")).alias(b) for a, b in SNAPSHOT_FIELDS.items()))


def read_snapshot_json(spark: SparkSession, path: str) -> DataFrame:
    return snapshot_rows(spark.read.schema(SNAPSHOT_SCHEMA).option("multiLine", "true").json(path))


def snapshot_page_faults(payload: DataFrame) -> DataFrame:
    """Payloads that aren't whole (SR-12): a page over the limit, a short page before the last, or stations missing or twice."""
    p = payload.select("fetched_at", F.posexplode("pages").alias("i", "p"), F.size("pages").alias("n"))
    pages = p.groupBy("fetched_at").agg(
        F.max((F.col("p.rows") > PAGE_ROWS).cast("int")).alias("over"), F.max(((F.col("i") < F.col("n") - 1) & (F.col("p.rows") < F.least(F.lit(PAGE_ROWS), F.col("p.total") - F.col("i") * PAGE_ROWS))).cast("int")).alias("short"))
    rows = snapshot_rows(payload).groupBy("fetched_at").agg((F.count("*") - F.countDistinct("station_id")).alias("twice_or_null"))
    return pages.join(rows, "fetched_at", "full").where("over > 0 or short > 0 or twice_or_null > 0")


FORECAST_SCHEMA = "base_at string, nx int, ny int, fetched_at string, pages array<struct<total:int,items:array<struct<baseDate:string,baseTime:string,fcstDate:string,fcstTime:string,category:string,fcstValue:string,nx:int,ny:int>>>>"


def forecast_rows(payload: DataFrame) -> DataFrame:
    """Landed issue files to long form; an item of another issue or cell is an error (SR-13)."""
    i = payload.select("base_at", "nx", "ny", "fetched_at", F.explode("pages").alias("p")).select("base_at", "nx", "ny", "fetched_at", F.explode("p.items").alias("i"))
    base = F.to_timestamp_ntz(F.concat("i.baseDate", "i.baseTime"), F.lit("yyyyMMddHHmm"))
    own = (base == F.to_timestamp_ntz("base_at", F.lit("yyyy-MM-dd HH:mm"))) & (F.col("i.nx") == F.col("nx")) & (F.col("i.ny") == F.col("ny"))
    checked = F.when(own, F.col("i.category")).otherwise(F.raise_error(F.lit("an item doesn't belong to its issue")).cast("string"))
    return i.select(base.alias("base_at"), F.to_timestamp_ntz(F.concat("i.fcstDate", "i.fcstTime"), F.lit("yyyyMMddHHmm")).alias("target_at"), checked.alias("category"), F.col("i.fcstValue").alias("value"), "nx", "ny", "fetched_at")


def read_forecast_json(spark: SparkSession, path: str) -> DataFrame:
    return forecast_rows(spark.read.schema(FORECAST_SCHEMA).option("multiLine", "true").json(path))


def forecast_page_faults(payload: DataFrame) -> DataFrame:
    """Issues whose totals differ between pages, whose items aren't as many, or repeat a target and category (SR-14)."""
    pages = payload.select("base_at", F.explode("pages").alias("p"))
    totals = pages.groupBy("base_at").agg(F.min("p.total").alias("low"), F.max("p.total").alias("high"), F.sum(F.size("p.items")).alias("items"))
    kinds = pages.select("base_at", F.explode("p.items").alias("i")).groupBy("base_at").agg(F.countDistinct("i.fcstDate", "i.fcstTime", "i.category").alias("kinds"))
    return totals.join(kinds, "base_at", "left").where("low <> high or items <> low or kinds is null or kinds <> items")


def issue_calendar(now: DataFrame, hours: int = 24) -> DataFrame:
    """Issues of the last ``hours`` that are out at ``now`` (one row, column now): eight a day, ten minutes after their hour (SR-15)."""
    days = now.withColumn("day", F.explode(F.sequence(F.date_trunc("day", F.col("now")) - F.expr("interval 2 day"), F.date_trunc("day", F.col("now")), F.expr("interval 1 day"))))
    base = plus_hours(F.col("day").cast("timestamp_ntz"), F.col("h"))
    issues = days.withColumn("h", F.explode(F.array(*(F.lit(h) for h in ISSUE_HOURS)))).select("now", base.alias("base_at"))
    return issues.where((plus_minutes(F.col("base_at"), 10) <= F.col("now")) & (F.col("base_at") > plus_hours(F.col("now"), -hours))).select("base_at")


def missing_issues(calendar: DataFrame, landed: DataFrame) -> DataFrame:
    return calendar.join(landed.select("base_at").distinct(), "base_at", "left_anti")


def read_holidays(spark: SparkSession, path: str) -> DataFrame:
    """Two-column seed, one row a day (SR-18)."""
    h = spark.read.schema("holiday_date string, holiday_name string").option("header", "true").csv(path)
    w = Window.partitionBy("holiday_date").orderBy("holiday_name")
    return h.withColumn("holiday_date", F.to_date("holiday_date")).withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def scan_months(spark: SparkSession, path: str, months: list[str]) -> DataFrame:
    """Partition-pruned scan of the months' folders (SR-17)."""
    return spark.read.parquet(path).where(F.col("month").isin(*months))
