"""Forecast tables and forecast-against-observation reports (FW-01..14)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parse import parse_amount, parse_number
from ..functions.time import epoch, plus_hours, plus_minutes
from ..sources.sinks import checked
from .staging import stage_observations

#: Lead times in hours, closed, and their names.
LEAD_BUCKETS = ((1, 6, "1-6h"), (7, 24, "7-24h"), (25, 48, "25-48h"))
MIN_RAIN_HOURS = 10


def pivot_forecast(forecast: DataFrame) -> DataFrame:
    """One row for each issue and hour (target minus one hour); categories not named are ignored, absent ones NULL (FW-01)."""
    def pick(category: str, value: Column) -> Column:
        return F.max(F.when(F.col("category") == category, value))

    v = F.col("value")
    return forecast.groupBy("base_at", plus_hours(F.col("target_at"), -1).alias("hour_start")).agg(
        pick("TMP", parse_number(v)).alias("temp_c"), pick("PCP", parse_amount(v)).alias("rain_mm"), pick("WSD", parse_number(v)).alias("wind_ms"),
        pick("REH", parse_number(v)).alias("humidity_pct"), pick("SNO", (parse_amount(v) > 0).cast("int")).alias("is_snow"),
    )


#: Categories that an issue has for each of its hours.
CATEGORIES = ("TMP", "PCP", "WSD", "REH", "SNO", "POP")


def whole_issues(forecast: DataFrame, hours: int = 48, categories: tuple[str, ...] = CATEGORIES) -> DataFrame:
    """base_at of the issues that have every category for ``hours`` hours (ST-08)."""
    cells = forecast.where(F.col("category").isin(*categories)).groupBy("base_at", "target_at").agg(F.count_distinct("category").alias("n")).where(F.col("n") == len(categories))
    return cells.groupBy("base_at").agg(F.count("*").alias("n")).where(F.col("n") >= hours).select("base_at")


def latest_issue(forecast: DataFrame, upto: Column | None = None) -> DataFrame:
    """Rows of the newest issue (at most ``upto``); none if there is none (FW-02)."""
    live = forecast if upto is None else forecast.where(F.col("base_at") <= upto)
    return live.join(F.broadcast(live.agg(F.max("base_at").alias("base_at"))), "base_at", "left_semi")


def lead_bucket(hour_start: Column, base: Column) -> Column:
    lead = (epoch(hour_start) + 3600 - epoch(base)) / 3600.0
    out = F.lit(None).cast("string")
    for low, high, name in reversed(LEAD_BUCKETS):
        out = F.when(lead.between(low, high), name).otherwise(out)
    return out


def observed_hourly(items: DataFrame) -> DataFrame:
    """Observation items as text (observed_at and values, '' or NULL where there is none) to weather by hour, by the rules of the staged
    observations (FW-03)."""
    values = ("temp_c", "wind_ms", "humidity_pct", "rain_mm", "new_snow_3h_cm")
    typed = items.select(F.try_to_timestamp("observed_at").cast("timestamp_ntz").alias("observed_at"), *(F.nullif(F.col(c), F.lit("")).try_cast("double").alias(c) for c in values))
    staged = stage_observations(typed)
    return staged.select("hour_start", "temp_c", "rain_mm", "wind_ms", "humidity_pct", F.col("is_new_snow").cast("int").alias("is_snow"))


def forecast_pairs(pivoted: DataFrame, observed: DataFrame) -> DataFrame:
    """Forecast and observation of each issue and hour with a lead bucket."""
    o = observed.select("hour_start", *(F.col(c).alias(f"o_{c}") for c in ("temp_c", "rain_mm", "wind_ms", "humidity_pct")), F.col("is_new_snow").cast("int").alias("o_is_snow"))
    return pivoted.withColumn("bucket", lead_bucket(F.col("hour_start"), F.col("base_at"))).where("bucket is not null").join(o, "hour_start")


def continuous_errors(pairs: DataFrame, name: str) -> list[Column]:
    gap = F.col(name) - F.col(f"o_{name}")
    return [F.count(gap).alias(f"{name}_n"), F.avg(F.abs(gap)).alias(f"{name}_mae"), F.avg(gap).alias(f"{name}_bias")]


def event_agreement(name: str) -> list[Column]:
    """Counts of a yes/no event (above zero) over pairs with both values; a share over nothing is NULL (FW-06)."""
    f, o = F.col(name) > 0, F.col(f"o_{name}") > 0
    both = F.col(name).isNotNull() & F.col(f"o_{name}").isNotNull()

    def share(top: Column, bottom: Column) -> Column:
        return F.try_divide(F.count_if(both & top).cast("double"), F.count_if(both & bottom))

    return [
        F.count_if(both).alias(f"{name}_n"), F.count_if(both & o).alias(f"{name}_observed"), F.count_if(both & f).alias(f"{name}_forecast"), F.countDistinct(F.when(both & o, F.col("hour_start"))).alias(f"{name}_hours"),
        share(f == o, F.lit(True)).alias(f"{name}_agreement"), share(f & o, o).alias(f"{name}_recall"), share(f & o, f).alias(f"{name}_precision"),
    ]


def weather_errors(pivoted: DataFrame, observed: DataFrame) -> DataFrame:
    """One row for each lead bucket, one shuffle for all measures (FW-04..08)."""
    pairs = forecast_pairs(pivoted, observed)
    columns = [c for n in ("temp_c", "wind_ms", "humidity_pct") for c in continuous_errors(pairs, n)] + event_agreement("rain_mm") + event_agreement("is_snow")
    wet = F.avg(F.when(F.col("o_rain_mm") > 0, F.abs(F.col("rain_mm") - F.col("o_rain_mm")))).alias("rain_amount_mae")
    out = pairs.groupBy("bucket").agg(F.count("*").alias("pairs"), F.countDistinct("hour_start").alias("unique_hours"), *columns, wet)
    return out.withColumns({"rain_reference_only": F.col("rain_mm_hours") < MIN_RAIN_HOURS, "snow_measurable": F.col("is_snow_hours") > 0})


def rain_state(rows: DataFrame, by: list[str], rain: str = "rain_mm") -> DataFrame:
    """wet if any hour is wet, else unknown if any is missing, else dry (FW-09); RB-07's flag is wet 1, unknown -1, dry 0."""
    code = F.max(F.when(F.col(rain) > 0, 2).when(F.col(rain).isNull(), 1).otherwise(0))
    return rows.groupBy(*by).agg(code.alias("__c")).select(*by, F.when(F.col("__c") == 2, "wet").when(F.col("__c") == 1, "unknown").otherwise("dry").alias("rain_state"))


def prediction_shift(pairs: DataFrame) -> DataFrame:
    """How predictions change with the weather source, for all rows and by rain state (FW-11). ``pairs``: issue, station, rain_state,
    from_forecast, from_observed."""
    spread = pairs.withColumn("grp", F.explode(F.array(F.lit("all"), F.col("rain_state"))))
    return spread.groupBy("grp").agg(
        F.count("*").alias("rows"), F.countDistinct("issue").alias("issues"), F.avg(F.abs(F.col("from_forecast") - F.col("from_observed"))).alias("mean_abs_shift"),
        F.try_divide(F.sum("from_forecast"), F.sum("from_observed")).alias("ratio"))


def top_lists(df: DataFrame, issue: str, score: str, key: str, k: int) -> DataFrame:
    """The first k of each issue by falling score, then key (WN-08)."""
    return df.where(F.col(score).isNotNull()).withColumn("__n", F.row_number().over(Window.partitionBy(issue).orderBy(F.desc(score), F.asc(key)))).where(F.col("__n") <= k)


def list_overlap(pairs: DataFrame, k: int = 50) -> DataFrame:
    """Share of each issue's forecast list that the observed list holds; issues with an empty list are skipped (FW-12, SO-02)."""
    f = top_lists(pairs.where("from_forecast > 0"), "issue", "from_forecast", "station_id", k).select("issue", "station_id")
    o = top_lists(pairs.where("from_observed > 0"), "issue", "from_observed", "station_id", k).select("issue", "station_id", F.lit(1).alias("both"))
    return f.join(o, ["issue", "station_id"], "left").groupBy("issue").agg(F.count("*").alias("listed"), (F.count("both") / F.count("*")).alias("overlap"))


def snapshot_for_issue(issues: DataFrame, snapshots: DataFrame, station_hours: int = 6, count_minutes: int = 30) -> DataFrame:
    """Stations of the last snapshot up to six hours old; their counts only if it is at most 30 minutes old (FW-13). The issues with their references are
    counted and broadcast if they are few; the snapshots never are."""
    from .pit import reference_snapshot

    at = checked(reference_snapshot(issues, snapshots.select("fetched_at"), 60 * station_hours).where("reference_at is not null"))
    joined = at.join(snapshots.withColumnRenamed("fetched_at", "reference_at"), "reference_at")
    fresh = F.col("reference_at") >= plus_minutes(F.col("as_of"), -count_minutes)
    return joined.select("as_of", "reference_at", "station_id", F.when(fresh, F.col("bike_count")).alias("bike_count"))


def observed_range(forecast: DataFrame, today: str) -> DataFrame:
    """The last date whose observation is needed, 48 hours after the last issue, and whether it is over by today (FW-14)."""
    last = F.to_date(plus_hours(F.max("base_at"), 48))
    return forecast.agg(last.alias("observed_end"), (last < F.lit(today).cast("date")).alias("fetchable"))
