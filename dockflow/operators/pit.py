"""Point-in-time joins (JN-05..10, JN-15, JN-16)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import epoch, hour_of, plus_minutes
from ..sources.sinks import checked


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_time: str, right_time: str, values: list[str], strict: bool = True, stretch: int = 86400) -> DataFrame:
    """Each left row with the last right row before it (``strict``) or not after it, by key; NULLs where there is none (JN-05).

    Both sides go into one window, no pair is made. On equal times left rows come first if strict, else right ones. Among right rows of one time the one
    of the highest values counts. Where times are timestamps, a window holds ``stretch`` seconds of a key, and starts with the last right row of the
    stretches before, which is found from one row for each key and stretch: a key with most of the rows is dealt to as many tasks as it has stretches."""
    rank = F.lit(1 if strict else 0)
    lefts = left.select(*(F.col(c) for c in by), F.col(left_time).alias("__at"), F.lit(0 if strict else 1).alias("__side"), F.struct(*left.columns).alias("__row"), F.lit(None).cast(right.select(F.struct(right_time, *values).alias("v")).schema["v"].dataType).alias("__found"))
    rights = right.where(F.col(right_time).isNotNull()).select(*(F.col(c) for c in by), F.col(right_time).alias("__at"), rank.alias("__side"), F.lit(None).cast(lefts.schema["__row"].dataType).alias("__row"), F.struct(right_time, *values).alias("__found"))
    both, group = lefts.unionByName(rights), list(by)
    if left.schema[left_time].dataType.typeName().startswith("timestamp"):
        both, group = both.withColumn("__stretch", F.floor(epoch(F.col("__at")) / stretch)), [*by, "__stretch"]
        last = F.max(F.when(F.col("__found").isNotNull(), F.struct("__at", "__found")))
        before = F.last("__last", ignorenulls=True).over(Window.partitionBy(*by).orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1))
        carried = both.groupBy(*group).agg(last.alias("__last")).select(*group, before.alias("__carried")).where("__carried is not null and __stretch is not null")
        both = both.unionByName(carried.select(*group, F.col("__carried.__found").alias("__found"), F.lit(-1).alias("__side")), allowMissingColumns=True)  # no time: first of its window
    w = Window.partitionBy(*group).orderBy("__at", "__side", "__found").rowsBetween(Window.unboundedPreceding, -1)
    joined = both.withColumn("__hit", F.last("__found", ignorenulls=True).over(w)).where("__row is not null")
    return joined.select("__row.*", *(F.col(f"__hit.{v}").alias(v if v not in left.columns else f"asof_{v}") for v in values), F.col(f"__hit.{right_time}").alias(f"asof_{right_time}"))


def reference_snapshot(issues: DataFrame, times: DataFrame, max_minutes: int = 30, as_of: str = "as_of", time: str = "fetched_at") -> DataFrame:
    """The last snapshot time at or before each issue, at most ``max_minutes`` old (JN-07). Candidates meet on the hour, so
    the join is an equi-join; both sides are one row a time, not a station."""
    t = times.select(F.col(time).alias("__t")).distinct()
    span = -(-max_minutes // 60)
    i = issues.withColumn("__hour", F.explode(F.sequence(hour_of(F.col(as_of)) - F.expr(f"interval {span} hour"), hour_of(F.col(as_of)), F.expr("interval 1 hour"))))
    near = i.join(t.withColumn("__hour", hour_of(F.col("__t"))), "__hour").where((F.col("__t") <= F.col(as_of)) & (F.col("__t") >= plus_minutes(F.col(as_of), -max_minutes)))
    best = near.groupBy(as_of).agg(F.max("__t").alias("reference_at"))
    return issues.join(best, as_of, "left")


def nearest_snapshot(targets: DataFrame, times: DataFrame, minutes: int = 5, target: str = "target_at", time: str = "fetched_at") -> DataFrame:
    """The snapshot time nearest to each target within ``minutes``, the earlier one on ties (JN-08)."""
    t = times.select(F.col(time).alias("__t")).distinct().withColumn("__slot", F.floor(epoch(F.col("__t")) / (60 * minutes)))
    want = targets.select(target).distinct().withColumn("__slot", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda k: F.floor(epoch(F.col(target)) / (60 * minutes)) + k)))
    gap = F.abs(epoch(F.col("__t")) - epoch(F.col(target)))
    best = want.join(t, "__slot").where(gap <= 60 * minutes).groupBy(target).agg(F.min(F.struct(gap.alias("gap"), F.col("__t").alias("at"))).alias("b")).select(target, F.col("b.at").alias("nearest_at"))
    return targets.join(best, target, "left")


def window_rows(issues: DataFrame, snapshots: DataFrame, hours: int, as_of: str = "as_of", time: str = "fetched_at", by: list[str] | None = None) -> DataFrame:
    """Snapshot rows in (as_of, as_of + hours] of each issue (and key ``by``), by an equi-join on the hour (JN-09). Issues that aren't a stream are
    broadcast if they are few when counted; the snapshots never are."""
    number = lambda c: F.floor(epoch(F.col(c)) / 3600)  # noqa: E731  as a key it costs a third of a wall-clock hour
    keys = issues.withColumn("__hour", F.explode(F.sequence(number(as_of), number(as_of) + hours)))
    if not (issues.isStreaming or snapshots.isStreaming):
        keys = checked(keys)
    met = keys.join(snapshots.withColumn("__hour", number(time)), [*(by or []), "__hour"])
    return met.where((F.col(time) > F.col(as_of)) & (F.col(time) <= plus_minutes(F.col(as_of), 60 * hours))).drop("__hour")


def overlapping_hours(df: DataFrame, hours: int, as_of: str = "as_of") -> DataFrame:
    """One row for each hour that [as_of, as_of + hours) touches, with k (0 for the first) and the share of it inside (JN-10)."""
    from ..functions.time import overlap_weight, plus_hours

    first = hour_of(F.col(as_of))
    frac = (epoch(F.col(as_of)) - epoch(first)) / 3600.0
    out = df.withColumn("__k", F.explode(F.sequence(F.lit(0), F.lit(hours)))).withColumn("weight", overlap_weight(F.col("__k"), frac, hours))
    return out.where("weight > 0").withColumn("hour_start", plus_hours(first, F.col("__k"))).withColumnRenamed("__k", "k")


def latest_state(snapshots: DataFrame, key: str = "station_id", time: str = "fetched_at", after: Column | None = None) -> DataFrame:
    """The newest row of each key, at or after a cutoff if one is given (JN-15)."""
    live = snapshots if after is None else snapshots.where(F.col(time) >= after)
    rest = [c for c in snapshots.columns if c not in (key, time)]
    return live.groupBy(key).agg(F.max(F.struct(time, *rest)).alias("__s")).select(key, "__s.*")


def with_year_before(halves: DataFrame, by: list[str], value: str) -> DataFrame:
    """Each half-year with the value two halves before it (JN-16)."""
    before = halves.select(*by, (F.col("half") + 2).alias("half"), F.col(value).alias(f"{value}_before"))
    return halves.join(before, [*by, "half"], "left")
