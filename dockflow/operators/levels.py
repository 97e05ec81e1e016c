"""Level diagnosis: means of cells and periods that predictions are held against (AG-15..17, AG-19)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import iso_weekday


def cell_means(rows: DataFrame, value: str) -> DataFrame:
    """Mean and number of an hourly value by station, weekend and hour of day (AG-15)."""
    weekend = (iso_weekday(F.col("hour_start")) >= 6).alias("weekend")
    return rows.groupBy("station_id", weekend, F.hour("hour_start").alias("hour")).agg(F.avg(value).alias("mean"), F.count("*").alias("n"))


def actual_cells(grid: DataFrame, calendar: DataFrame, first: str, last: str) -> DataFrame:
    """The same cells of what happened: dry hours that aren't on holidays, between two days of the year (MM-dd), of any year (AG-16)."""
    dry = calendar.where("rain_mm = 0 and not is_holiday").where(F.date_format("hour_start", "MM-dd").between(first, last))
    return cell_means(grid.join(F.broadcast(dry.select("hour_start")), "hour_start"), "rentals")


def first_half_means(grid: DataFrame) -> DataFrame:
    """Mean rentals of January to June of each year (AG-17)."""
    return grid.where(F.month("hour_start") <= 6).groupBy(F.year("hour_start").alias("year")).agg(F.avg("rentals").alias("mean"))


def hour_share(trips: DataFrame) -> DataFrame:
    """Rentals by hour of day and their share of all; cancelled trips don't count (AG-19). The window is over 24 rows."""
    hours = trips.where("not is_cancelled").groupBy(F.hour("rented_at").alias("hour")).agg(F.count("*").alias("n"))
    return hours.select("hour", "n", (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("share"))
