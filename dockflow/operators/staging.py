"""Typing, deduplication and cleaning of landed tables (PF-01..08, PF-12..16)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import covering_report, plus_hours

TRIP_KEY = ["bike_no", "rented_at", "rent_station_id", "returned_at", "return_station_id"]
THREE_HOURLY_MONTHS = (11, 12, 1, 2, 3)


def type_trips(bronze: DataFrame, fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Text trips to typed ones; empty texts are NULL, leading zeros go with the cast (PF-01)."""
    text = {c: F.nullif(F.col(c), F.lit("")) for c in bronze.columns}
    return bronze.select(
        text["bike_no"].alias("bike_no"),
        *(F.to_timestamp_ntz(text[c], F.lit(fmt)).alias(c) for c in ("rented_at", "returned_at")),
        *(text[c].try_cast("int").alias(c) for c in ("rent_station_no", "return_station_no", "duration_min")),
        text["distance_m"].try_cast("double").alias("distance_m"), text["rent_station_id"].alias("rent_station_id"), text["return_station_id"].alias("return_station_id"),
    )


def dedupe_trips(trips: DataFrame) -> DataFrame:
    """One row for each natural key; NULL return stations are equal (PF-02). The other columns depend on the key."""
    return trips.dropDuplicates(TRIP_KEY)


def flag_cancelled(trips: DataFrame) -> DataFrame:
    """Zero minutes and back at the same station; unknown is false (PF-03)."""
    return trips.withColumn("is_cancelled", F.coalesce((F.col("duration_min") == 0) & (F.col("rent_station_id") == F.col("return_station_id")), F.lit(False)))


def stage_trips(trips: DataFrame) -> DataFrame:
    return flag_cancelled(dedupe_trips(trips))


def type_stations(bronze: DataFrame) -> DataFrame:
    """Docks are the sum of both dock kinds, each 0 where missing (PF-04)."""
    def number(c: str, kind: str) -> Column:
        return F.nullif(F.trim(F.col(c).cast("string")), F.lit("")).try_cast(kind)

    return bronze.select(
        number("station_no", "int").alias("station_no"), F.nullif(F.trim("district"), F.lit("")).alias("district"),
        number("lat", "double").alias("lat"), number("lon", "double").alias("lon"),
        (F.coalesce(number("lcd_docks", "int"), F.lit(0)) + F.coalesce(number("qr_docks", "int"), F.lit(0))).alias("docks"), "snapshot",
    )


def stage_observations(obs: DataFrame) -> DataFrame:
    """Hourly weather of the hour that ends at the observation (PF-05..08): in the months of three-hourly reports rain is a third of
    the covering report, new snow in a report marks its three hours; the reported amount is kept."""
    o = obs.withColumns({"rain_mm": F.coalesce("rain_mm", F.lit(0.0)), "new_snow_3h_cm": F.coalesce("new_snow_3h_cm", F.lit(0.0))})
    cover = o.select(F.col("observed_at").alias("report_at"), F.col("rain_mm").alias("report_mm"), F.col("new_snow_3h_cm").alias("report_snow"))
    h = o.withColumn("report_at", covering_report(F.col("observed_at"))).join(cover, "report_at", "left")
    return h.select(
        plus_hours(F.col("observed_at"), -1).alias("hour_start"), "observed_at", "temp_c", "wind_ms", "humidity_pct",
        F.when(F.month("observed_at").isin(*THREE_HOURLY_MONTHS), F.coalesce("report_mm", F.lit(0.0)) / 3).otherwise(F.col("rain_mm")).alias("rain_mm"),
        F.col("rain_mm").alias("rain_mm_reported"), (F.coalesce("report_snow", F.lit(0.0)) > 0).alias("is_new_snow"),
    )


def period_filter(df: DataFrame, start: str, end: str, column: str = "hour_start") -> DataFrame:
    """Half-open [start, end) (PF-12)."""
    return df.where((F.col(column) >= F.lit(start).cast("timestamp_ntz")) & (F.col(column) < F.lit(end).cast("timestamp_ntz")))


def grid_filter(forecast: DataFrame, nx: int, ny: int) -> DataFrame:
    return forecast.where((F.col("nx") == nx) & (F.col("ny") == ny))


def version_filter(predictions: DataFrame, prefix: str, upto: str, first: str, last: str) -> DataFrame:
    """Versions of a prefix whose issue is at most ``upto``, hours in the closed range (PF-14)."""
    v = F.col("model_version")
    return predictions.where(v.startswith(f"{prefix}-fcst") & (F.substring_index(v, "-fcst", -1) <= upto) & F.col("hour_start").between(F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz")))


def drop_holidays(df: DataFrame, holidays: DataFrame, column: str = "hour_start") -> DataFrame:
    days = holidays.select(F.col("holiday_date").alias("__day"))
    return df.join(F.broadcast(days), F.to_date(column) == F.col("__day"), "left_anti")


def round_for_output(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Rounding comes last, after comparing and sorting (PF-16)."""
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})
