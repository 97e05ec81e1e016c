"""Serving queries as DataFrame functions (SV-01..10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import plus_hours, plus_minutes
from .pit import latest_state
from .shortage import horizon_sum


def latest_version(predictions: DataFrame, where: Column | None = None) -> DataFrame:
    """The one version of an answer: highest created_at, then version (SV-01)."""
    p = predictions if where is None else predictions.where(where)
    return p.agg(F.max(F.struct("created_at", "model_version")).alias("v")).select("v.model_version").where("model_version is not null")


def of_version(predictions: DataFrame, version: DataFrame) -> DataFrame:
    return predictions.join(F.broadcast(version), "model_version", "left_semi")


def freshness(snapshots: DataFrame, predictions: DataFrame) -> DataFrame:
    """Time of the newest snapshot and last hour of the chosen version (SV-02)."""
    return snapshots.agg(F.max("fetched_at").alias("latest_snapshot")).crossJoin(of_version(predictions, latest_version(predictions)).agg(F.max("hour_start").alias("last_hour")))


def list_stations(stations: DataFrame, district: str | None = None) -> DataFrame:
    return (stations if district is None else stations.where(F.col("district") == district)).orderBy("station_id")


def station_detail(stations: DataFrame, snapshots: DataFrame, predictions: DataFrame, station: str, now: str) -> DataFrame:
    """A station, its latest snapshot and the next six hours of the chosen version, one row an hour (SV-04). Filters go to the
    scans."""
    t = F.lit(now).cast("timestamp_ntz")
    s = stations.where(F.col("station_id") == station)
    state = latest_state(snapshots.where(F.col("station_id") == station))
    ahead = of_version(predictions, latest_version(predictions)).where((F.col("station_id") == station) & (F.col("hour_start") >= F.date_trunc("hour", t).cast("timestamp_ntz")) & (F.col("hour_start") < plus_hours(F.date_trunc("hour", t).cast("timestamp_ntz"), 6)))
    return s.join(state.select("station_id", "fetched_at", "bike_count"), "station_id", "left").join(ahead.select("station_id", "hour_start", "predicted_rentals"), "station_id", "left").orderBy("hour_start")


def check_bounds(hours: int, limit: int, max_age: int) -> None:
    """Parameter bounds (SV-08)."""
    for name, value, low, high in (("hours", hours, 1, 6), ("limit", limit, 1, 500), ("max_age", max_age, 1, 180)):
        if not low <= value <= high:
            raise ValueError(f"{name} must be {low} to {high}, not {value}")


def shortage_risk(stations: DataFrame, snapshots: DataFrame, predictions: DataFrame, now: str, hours: int = 3, limit: int = 50, district: str | None = None, max_age: int = 30) -> DataFrame:
    """Stations whose expected rentals exceed their bikes, most first (SV-05): the latest fresh snapshot of each, hours prorated from its
    own time, one version, and NULL (so no row) where an hour is missing."""
    check_bounds(hours, limit, max_age)
    t = F.lit(now).cast("timestamp_ntz")
    fresh = latest_state(snapshots.where(F.col("fetched_at") <= t), after=plus_minutes(t, -max_age)).withColumnRenamed("fetched_at", "as_of")
    known = fresh.join(list_stations(stations, district).select("station_id", "district"), "station_id")
    p = of_version(predictions, latest_version(predictions)).select("station_id", "hour_start", "predicted_rentals")
    need = horizon_sum(known.select("station_id", "as_of"), p, hours, ["station_id"], "predicted_rentals", "expected")
    gap = F.col("expected") - F.col("bike_count")
    return known.join(need, "station_id").withColumn("shortfall", gap).where("shortfall > 0").orderBy(F.desc("shortfall"), "station_id").limit(limit).select("station_id", "district", "as_of", "bike_count", F.round("expected", 1).alias("expected"), F.round("shortfall", 1).alias("shortfall"))


def daily_predictions(predictions: DataFrame, station: str, day: str) -> DataFrame:
    """The 24 hours of a day from one version among those that have rows that day (SV-06)."""
    inside = (F.col("hour_start") >= F.lit(day).cast("timestamp_ntz")) & (F.col("hour_start") < plus_hours(F.lit(day).cast("timestamp_ntz"), 24))
    return of_version(predictions.where(inside & (F.col("station_id") == station)), latest_version(predictions, inside & (F.col("station_id") == station))).select("hour_start", F.round("predicted_rentals", 2).alias("predicted_rentals")).orderBy("hour_start")


def fresh_stations(snapshots: DataFrame, now: str, max_age_minutes: int) -> DataFrame:
    """Stations of the newest snapshot, none if it is stale (SV-07)."""
    t = F.lit(now).cast("timestamp_ntz")
    newest = snapshots.where(F.col("fetched_at") <= t).agg(F.max("fetched_at").alias("fetched_at")).where(F.col("fetched_at") >= plus_minutes(t, -max_age_minutes))
    return snapshots.join(F.broadcast(newest), "fetched_at", "left_semi").select("station_id").distinct()


def distinct_districts(stations: DataFrame) -> DataFrame:
    return stations.where("district is not null and trim(district) <> ''").select("district").distinct().orderBy("district")


def shortage_tier(shortfall: Column) -> Column:
    return F.when(shortfall >= 10, "high").when(shortfall >= 5, "medium").otherwise("low")


def valid_place(lat: Column, lon: Column) -> Column:
    return F.coalesce(lat.between(-90, 90) & lon.between(-180, 180) & ~((lat == 0) & (lon == 0)), F.lit(False))
