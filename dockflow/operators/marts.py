"""Calendar, station dimension, hourly facts and the zero-filled grid (DM-01..12, AG-01..04)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import day_of, hour_of, iso_weekday, plus_hours, yearly_cycle


def hour_series(span: DataFrame) -> DataFrame:
    """One row for each hour from ``first_day`` 00:00 to ``last_day`` 23:00 of the one-row frame ``span`` (DM-01)."""
    return span.select(F.explode(F.sequence(F.col("first_day").cast("timestamp_ntz"), plus_hours(F.col("last_day").cast("timestamp_ntz"), 23), F.expr("interval 1 hour"))).alias("hour_start"))


def calendar(hours: DataFrame, holidays: DataFrame) -> DataFrame:
    """Attributes of each hour; off days are weekends and holidays (DM-02, DM-03). Holidays are a broadcast dimension of a few days a year."""
    h = F.col("hour_start")
    days = holidays.select("holiday_date").distinct().withColumn("is_holiday", F.lit(True))
    flagged = hours.withColumn("holiday_date", F.to_date(h)).join(F.broadcast(days), "holiday_date", "left").withColumn("is_holiday", F.coalesce("is_holiday", F.lit(False)))
    return flagged.select(
        h, F.col("holiday_date").alias("date"), F.hour(h).alias("hour_of_day"), iso_weekday(h).alias("day_of_week"), F.month(h).alias("month"),
        F.dayofyear(h).alias("day_of_year"), "is_holiday", (F.col("is_holiday") | (iso_weekday(h) >= 6)).alias("is_offday"),
    )


def attach_weather(hours: DataFrame, weather: DataFrame) -> DataFrame:
    """Hours without weather stay (DM-04)."""
    return hours.join(weather.select("hour_start", "temp_c", "wind_ms", "humidity_pct", "rain_mm", "is_new_snow"), "hour_start", "left")


def calendar_features(hours: DataFrame, holidays: DataFrame) -> DataFrame:
    """The calendar of future hours with the yearly cycle, once an hour (DM-05)."""
    sin, cos = yearly_cycle(F.col("day_of_year"))
    return calendar(hours, holidays).withColumns({"doy_sin": sin, "doy_cos": cos})


def rent_side(trips: DataFrame) -> DataFrame:
    return trips.where("rent_station_id is not null").groupBy(F.col("rent_station_id").alias("station_id")).agg(
        F.min("rent_station_no").alias("rent_no"), F.min("rented_at").alias("first_rented_at"), F.max("rented_at").alias("last_rented_at"), F.count_if(~F.col("is_cancelled")).alias("total_rentals"))


def return_side(trips: DataFrame) -> DataFrame:
    return trips.where("return_station_id is not null").groupBy(F.col("return_station_id").alias("station_id")).agg(
        F.min("return_station_no").alias("return_no"), F.count_if(~F.col("is_cancelled")).alias("total_returns"))


def trip_stations(trips: DataFrame) -> DataFrame:
    """Stations seen on either side; counts default to 0, the number comes from the rent side first (DM-06..08)."""
    both = rent_side(trips).join(return_side(trips), "station_id", "full")
    zero = F.lit(0).cast("long")
    return both.select("station_id", F.coalesce("rent_no", "return_no").alias("station_no"), "first_rented_at", "last_rented_at", F.coalesce("total_rentals", zero).alias("total_rentals"), F.coalesce("total_returns", zero).alias("total_returns"))


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key under ``order`` (DM-09, WN-02)."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def dim_stations(trips: DataFrame, snapshots: DataFrame) -> DataFrame:
    newest = latest_per_key(snapshots, ["station_no"], [F.desc("snapshot")]).select("station_no", "district", "docks", "lat", "lon")
    return trip_stations(trips).join(newest, "station_no", "left").select("station_id", "station_no", "district", "docks", "lat", "lon", "first_rented_at", "last_rented_at", "total_rentals", "total_returns")


def assign_codes(df: DataFrame, column: str, code: str) -> DataFrame:
    """Distinct non-null values and 0-based codes in their order (DM-11); for dimensions, which one task can sort."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().withColumn(code, (F.row_number().over(Window.orderBy(column)) - 1).cast("int"))


def unseen_codes(known: DataFrame, seen: DataFrame, column: str, code: str) -> DataFrame:
    """``known`` with codes above its highest for values that only ``seen`` has (DM-12)."""
    top = known.agg(F.coalesce(F.max(code), F.lit(-1)).alias("__top"))
    new = seen.select(column).where(F.col(column).isNotNull()).distinct().join(known, column, "left_anti")
    coded = new.withColumn("__n", F.row_number().over(Window.orderBy(column))).crossJoin(F.broadcast(top)).select(column, (F.col("__top") + F.col("__n")).cast("int").alias(code))
    return known.select(column, code).unionByName(coded)


def hourly_counts(trips: DataFrame) -> DataFrame:
    """Rentals and returns by station and hour; cancelled trips don't count, trips without return station count as rentals only
    (AG-01, JN-03)."""
    live = trips.where(~F.col("is_cancelled"))
    out = live.groupBy(F.col("rent_station_id").alias("station_id"), hour_of(F.col("rented_at")).alias("hour_start")).agg(F.count("*").alias("rentals"))
    back = live.where("return_station_id is not null").groupBy(F.col("return_station_id").alias("station_id"), hour_of(F.col("returned_at")).alias("hour_start")).agg(F.count("*").alias("returns"))
    zero = F.lit(0).cast("long")
    return out.join(back, ["station_id", "hour_start"], "full").select("station_id", "hour_start", F.coalesce("rentals", zero).alias("rentals"), F.coalesce("returns", zero).alias("returns"))


def active_span(hourly: DataFrame, stations: DataFrame, calendar_end: str) -> DataFrame:
    """First and last active day of stations with rentals; rows after the calendar's end don't count (AG-02)."""
    end = plus_hours(F.lit(calendar_end).cast("timestamp_ntz"), 24)
    used = stations.where("total_rentals > 0").select("station_id")
    return hourly.where(F.col("hour_start") < end).join(used, "station_id", "left_semi").groupBy("station_id").agg(day_of(F.min("hour_start")).alias("first_day"), day_of(F.max("hour_start")).alias("last_day"))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows that are few before an explode and many after it, dealt to as many tasks as shuffles have: adaptive execution would put a shuffle of so
    few bytes into one task, which then makes all rows."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def densify(hourly: DataFrame, spans: DataFrame) -> DataFrame:
    """Every hour of each span, rentals 0 where there is no row (AG-03). Spans are one row a station, so the shuffle of the join
    is on the facts' own key."""
    every = spread(spans, "station_id").select("station_id", F.explode(F.sequence("first_day", plus_hours(F.col("last_day"), 23), F.expr("interval 1 hour"))).alias("hour_start"))
    return every.join(hourly.select("station_id", "hour_start", "rentals"), ["station_id", "hour_start"], "left").select("station_id", "hour_start", F.coalesce("rentals", F.lit(0)).cast("int").alias("rentals"))


def station_hour_grid(trips: DataFrame, snapshots: DataFrame, calendar_end: str) -> DataFrame:
    hourly = hourly_counts(trips)
    return densify(hourly, active_span(hourly, dim_stations(trips, snapshots), calendar_end))
