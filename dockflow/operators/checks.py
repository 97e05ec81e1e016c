"""Data tests; each returns the offending rows or counts (DQ-01..07)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULL counts of all columns in one pass, one row a column."""
    one = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return one.select(F.explode(F.map_from_arrays(F.array(*(F.lit(c) for c in columns)), F.array(*columns))).alias("column_name", "nulls"))


def unique(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def relationships(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return child.where(F.col(key).isNotNull()).join(parent.select(key).distinct(), key, "left_anti")


def outside_calendar(facts: DataFrame, calendar: DataFrame, where: Column | None = None) -> DataFrame:
    """Facts whose hour the calendar lacks (DQ-04, DQ-05)."""
    return (facts if where is None else facts.where(where)).join(calendar.select("hour_start"), "hour_start", "left_anti")


def totals_reconcile(hourly: DataFrame, trips: DataFrame) -> DataFrame:
    """Fact totals against trips counted for themselves; a NULL is a mismatch (DQ-06)."""
    a = hourly.agg(F.sum("rentals").alias("fact_rentals"), F.sum("returns").alias("fact_returns"))
    b = trips.where("not is_cancelled").agg(F.count("*").alias("trip_rentals"), F.count("return_station_id").alias("trip_returns"))
    same = F.col("fact_rentals").eqNullSafe(F.col("trip_rentals")) & F.col("fact_returns").eqNullSafe(F.col("trip_returns")) & F.col("fact_rentals").isNotNull() & F.col("fact_returns").isNotNull()
    return a.crossJoin(b).withColumn("matches", same)


def row_profile(trips: DataFrame, key: list[str]) -> DataFrame:
    """Rows, exact duplicates, missing return stations, zero-minute and same-station trips by year (AG-18, DQ-07)."""
    return trips.groupBy(F.year("rented_at").alias("year")).agg(
        F.count("*").alias("rows"), (F.count("*") - F.countDistinct(F.struct(*(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key)))).alias("duplicates"), F.count_if(F.col("return_station_id").isNull()).alias("no_return"),
        F.count_if(F.col("duration_min") == 0).alias("zero_minutes"), F.count_if((F.col("duration_min") == 0) & (F.col("rent_station_id") == F.col("return_station_id"))).alias("same_station"))
