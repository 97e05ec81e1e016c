"""Regression and ranking metrics, tie-exact and by weights (MT-01..17, WN-06)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PEAK_HOURS = (7, 8, 9, 17, 18, 19)


def regression_metrics(df: DataFrame, actual: str = "actual", predicted: str = "predicted", hour: str = "hour") -> DataFrame:
    e = F.abs(F.col(predicted) - F.col(actual))
    return df.agg(F.count("*").alias("rows"), F.avg(e).alias("mae"), F.avg(F.when(F.col(hour).isin(*PEAK_HOURS), e)).alias("peak_mae"), F.try_divide(F.sum(e), F.sum(actual)).alias("wape"), F.avg(actual).alias("mean_actual"), F.avg(predicted).alias("mean_predicted"))


def block_mae(df: DataFrame, by: list[str], hour: str = "hour", actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Mean error of sums over three-hour blocks (MT-02)."""
    blocks = df.groupBy(*by, F.floor(F.col(hour) / 3).alias("__b")).agg(F.sum(actual).alias("a"), F.sum(predicted).alias("p"))
    return blocks.agg(F.avg(F.abs(F.col("p") - F.col("a"))).alias("block_mae"))


def score_groups(df: DataFrame, score: str, y: str, by: list[str], weight: Column | None = None) -> DataFrame:
    """Positives and negatives of each distinct score: everything a rank metric needs, aggregated before any window."""
    w = F.lit(1.0) if weight is None else weight
    return df.groupBy(*by, F.col(score).alias("score")).agg(F.sum(w * F.col(y)).alias("pos"), F.sum(w * (1 - F.col(y))).alias("neg"))


def prefix_sums(groups: DataFrame, by: list[str], buckets: int = 64) -> DataFrame:
    """Sums of pos and neg over all higher scores of a group (WN-06). Scores are cut into value ranges by quantiles of all rows, so the part of a group that
    lies in one range has about 1 / ``buckets`` of all rows at most, however large the group. A window holds one such part, and starts with a row for
    the totals of the group's higher ranges, which come from one row for each group and range."""
    cuts = F.percentile_approx("score", F.lit([i / buckets for i in range(1, buckets)]), 1000)
    edge = F.broadcast(groups.agg(cuts.alias("__cuts")))  # one row
    ranged = groups.crossJoin(edge).withColumn("__range", F.size(F.filter("__cuts", lambda c: c < F.col("score")))).drop("__cuts")
    totals = ranged.groupBy(*by, "__range").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    up = Window.partitionBy(*by).orderBy(F.desc("__range")).rowsBetween(Window.unboundedPreceding, -1)
    higher = totals.select(*by, "__range", F.sum("pos").over(up).alias("pos"), F.sum("neg").over(up).alias("neg")).where("pos is not null")
    parts = ranged.withColumn("__own", F.lit(1)).unionByName(higher.withColumn("__own", F.lit(0)), allowMissingColumns=True)
    w = Window.partitionBy(*by, "__range").orderBy("__own", F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0.0)
    summed = parts.withColumns({"pos_above": F.coalesce(F.sum("pos").over(w), zero), "neg_above": F.coalesce(F.sum("neg").over(w), zero)})
    return summed.where("__own = 1").drop("__range", "__own")


def rank_metrics(groups: DataFrame, by: list[str]) -> DataFrame:
    """auc and average_precision of score groups; ties count as one step, one class only gives NULL (MT-03, MT-04)."""
    s = prefix_sums(groups, by)
    hit = F.col("pos") * F.try_divide(F.col("pos_above") + F.col("pos"), F.col("pos_above") + F.col("neg_above") + F.col("pos") + F.col("neg"))
    return s.groupBy(*by).agg(
        F.try_divide(F.sum(F.col("neg") * (F.col("pos_above") + 0.5 * F.col("pos"))), F.sum("pos") * F.sum("neg")).alias("auc"),
        F.try_divide(F.sum(hit), F.sum("pos")).alias("average_precision"))


def probability_losses(df: DataFrame, p: str, y: str, by: list[str], weight: Column | None = None) -> DataFrame:
    """Brier score and log loss (probabilities clipped at 1e-12), by weights (MT-05)."""
    w = F.lit(1.0) if weight is None else weight
    q = F.greatest(F.lit(1e-12), F.least(F.lit(1 - 1e-12), F.col(p)))
    yy = F.col(y)
    return df.groupBy(*by).agg((F.sum(w * (F.col(p) - yy) * (F.col(p) - yy)) / F.sum(w)).alias("brier"), (-F.sum(w * (yy * F.ln(q) + (1 - yy) * F.ln(1 - q))) / F.sum(w)).alias("log_loss"))


def reliability(df: DataFrame, p: str, y: str, bins: int = 10) -> DataFrame:
    """Rows, mean prediction and observed rate of every bin; 1.0 is in the last, empty bins are there (MT-06)."""
    binned = df.groupBy(F.least(F.floor(F.col(p) * bins), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("rows"), F.avg(p).alias("mean_predicted"), F.avg(y).alias("observed"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(binned, "bin", "left").withColumn("rows", F.coalesce("rows", F.lit(0).cast("long")))


def precision_at_k(df: DataFrame, issue: str, score: str, y: str, key: str, ks: tuple[int, ...] = (10, 20, 50, 100)) -> DataFrame:
    """Positive share of the first k of an issue (falling score, then key), averaged over issues (MT-07)."""
    n = F.row_number().over(Window.partitionBy(issue).orderBy(F.desc(score), F.asc(key)))
    ranked = df.withColumn("__n", n).where(F.col("__n") <= max(ks)).withColumn("k", F.explode(F.array(*(F.lit(k) for k in ks)))).where("__n <= k")
    return ranked.groupBy("k", issue).agg(F.avg(y).alias("p")).groupBy("k").agg(F.avg("p").alias("precision"), F.count("*").alias("issues"))


def day_counts(days: DataFrame, day: str, replicates: int) -> DataFrame:
    """How often each day is drawn in each replicate, as many draws as days (MT-10). Draws are the first 32 bits of an md5, so
    that any engine repeats them. Days and replicates are small dimensions."""
    d = days.select(day).distinct()
    numbered = d.withColumn("__i", F.row_number().over(Window.orderBy(day)) - 1)
    total = F.broadcast(d.agg(F.count("*").alias("__total")))
    draws = d.sparkSession.range(replicates).select(F.col("id").cast("int").alias("replicate")).crossJoin(total).withColumn("__draw", F.explode(F.sequence(F.lit(0), F.col("__total").cast("int") - 1)))
    drawn = draws.withColumn("__i", (F.conv(F.substring(F.md5(F.concat_ws("-", F.col("replicate").cast("string"), F.col("__draw").cast("string")).cast("binary")), 1, 8), 16, 10).cast("long") % F.col("__total")).cast("int"))
    return drawn.join(F.broadcast(numbered), "__i").groupBy("replicate", day).agg(F.count("*").alias("times"))


def bootstrap_rank_metrics(df: DataFrame, score: str, y: str, day: str, replicates: int, by: list[str] | None = None) -> DataFrame:
    """auc and average_precision of every day-block replicate (MT-11): scores are aggregated by day once, and replicates weigh
    the aggregates by (replicate, day, times), whose size the planner judges."""
    by = by or []
    daily = df.groupBy(*by, day, F.col(score).alias("score")).agg(F.sum(y).cast("double").alias("pos"), F.sum(1 - F.col(y)).cast("double").alias("neg"))
    weighed = daily.join(day_counts(df, day, replicates), day)
    groups = weighed.groupBy(*by, "replicate", "score").agg(F.sum(F.col("pos") * F.col("times")).alias("pos"), F.sum(F.col("neg") * F.col("times")).alias("neg"))
    return rank_metrics(groups, [*by, "replicate"])


def paired_interval(replicates: DataFrame, name: str, a: str, b: str, metric: str = "auc") -> DataFrame:
    """2.5 and 97.5 percentiles of the differences of two candidates' replicates (MT-12)."""
    x = replicates.where(F.col(name) == a).select("replicate", F.col(metric).alias("x"))
    z = replicates.where(F.col(name) == b).select("replicate", F.col(metric).alias("z"))
    q = F.percentile(F.col("x") - F.col("z"), F.array(F.lit(0.025), F.lit(0.975)))
    return x.join(z, "replicate").agg(q.alias("q")).select(F.lit(a).alias("candidate"), F.lit(b).alias("baseline"), F.col("q")[0].alias("low"), F.col("q")[1].alias("high"))


def decide(auc_low: Column, s0_high: Column, challenger: str, baseline: str = "S1b", keep: str = "S0") -> Column:
    """The ranking rule on interval ends: the challenger if surely better than the baseline, else the baseline if S0 is surely
    worse, else S0 (MT-14, first step)."""
    return F.when(auc_low > 0, challenger).when(s0_high < 0, baseline).otherwise(keep)


def decide_final(first: Column, checks: list[Column], brier: Column, brier_reference: Column, auc: Column, auc_first: Column, valid_days: Column, challenger: str = "N") -> Column:
    """The second step: the classifier if every interval's low end is above 0 and neither Brier score nor AUC is worse; NULL
    under ten valid days."""
    ok = (brier <= brier_reference) & (auc >= auc_first)
    for c in checks:
        ok = ok & (c > 0)
    return F.when(valid_days >= 10, F.when(ok, challenger).otherwise(first))


def metric_table(points: DataFrame, intervals: DataFrame) -> DataFrame:
    """Candidates' metrics with their intervals against a baseline (MT-13)."""
    return points.join(intervals, "candidate", "left")


def level_ratio(predicted: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """Means of both sides over their common cells, weighted by the predicted side's rows (MT-16, SO-04)."""
    both = predicted.select(*keys, F.col("mean").alias("p"), "n").join(actual.select(*keys, F.col("mean").alias("a")), keys)
    p, a = F.sum(F.col("p") * F.col("n")) / F.sum("n"), F.sum(F.col("a") * F.col("n")) / F.sum("n")
    return both.agg(F.count("*").alias("cells"), p.alias("mean_predicted"), a.alias("mean_actual"), F.try_divide(p, a).alias("ratio"))


def list_precision(lists: DataFrame, issue: str = "as_of", y: str = "y", counts: str = "ok", empty: Column | None = None) -> DataFrame:
    """Precision of the issues' lists over the entries that count, averaged over issues that have some; the share of entries that were empty
    already, and the mean length (MT-08)."""
    gone = F.col("b0") == 0 if empty is None else empty
    each = lists.groupBy(issue).agg(F.avg(F.when(F.col(counts), F.col(y))).alias("p"), F.avg(F.when(F.col(counts), gone.cast("int"))).alias("e"), F.count("*").alias("n"))
    return each.agg(F.count("p").alias("issues"), F.avg("p").alias("precision"), F.avg("e").alias("already_empty_share"), F.avg("n").alias("mean_list_length"))


def horizon_report(rows: DataFrame, score: str, y: str, horizon: str = "horizon", by: list[str] | None = None) -> DataFrame:
    """Rows, positives and rank metrics of each horizon (and group), from one aggregation of scores (MT-15)."""
    keys = [horizon, *(by or [])]
    groups = score_groups(rows, score, y, keys)
    counts = groups.groupBy(*keys).agg(F.sum(F.col("pos") + F.col("neg")).cast("long").alias("rows"), F.sum("pos").cast("long").alias("positives"))
    return counts.join(rank_metrics(groups, keys), keys)


def candidate_report(scores: DataFrame, day: str, baseline: str, replicates: int, score: str = "score", y: str = "y", name: str = "candidate") -> DataFrame:
    """Every candidate's rank metrics with the interval of its AUC against the baseline's, from replicates over days that all candidates
    share (MT-12, MT-13). The baseline has no interval."""
    points = rank_metrics(score_groups(scores, score, y, [name]), [name])
    draws = bootstrap_rank_metrics(scores, score, y, day, replicates, [name]).select(name, "replicate", "auc")
    base = draws.where(F.col(name) == baseline).select("replicate", F.col("auc").alias("__base"))
    q = F.percentile(F.col("auc") - F.col("__base"), F.array(F.lit(0.025), F.lit(0.975)))
    intervals = draws.where(F.col(name) != baseline).join(base, "replicate").groupBy(name).agg(q.alias("q")).select(F.col(name).alias("candidate"), F.col("q")[0].alias("low"), F.col("q")[1].alias("high"))
    return metric_table(points.withColumnRenamed(name, "candidate"), intervals)


def full_report(rows: DataFrame, score: Column | None = None) -> DataFrame:
    """Long report (metric, grp, value) over main rows: counts, positive rate, rows by stratum of b0, and the rank metrics of a score,
    expected shortfall unless another is given (MT-09, MT-17). Strata are exploded, so all of them come from one aggregation."""
    main = rows.where("reason = 'main'").withColumn("score", F.coalesce(score if score is not None else F.col("e") - F.col("b0"), F.lit(0.0)))
    counts = main.agg(F.count("*").cast("double").alias("rows"), F.countDistinct("as_of").cast("double").alias("issues"), F.avg("y").alias("positive_rate"))
    totals = counts.select(F.explode(F.map_from_arrays(F.array(F.lit("rows"), F.lit("issues"), F.lit("positive_rate")), F.array("rows", "issues", "positive_rate"))).alias("metric", "value")).select("metric", F.lit("all").alias("grp"), "value")
    strata = main.withColumn("grp", F.explode(F.filter(F.array(F.lit("all"), F.when(F.col("b0") >= 2, "b0>=2"), F.when(F.col("b0") >= 3, "b0>=3")), lambda x: x.isNotNull())))
    sizes = strata.where("grp <> 'all'").groupBy("grp").agg(F.count("*").cast("double").alias("value")).select(F.lit("rows").alias("metric"), "grp", "value")
    ranks = rank_metrics(score_groups(strata, "score", "y", ["grp"]), ["grp"])
    long = ranks.select("grp", F.explode(F.map_from_arrays(F.array(F.lit("auc"), F.lit("average_precision")), F.array("auc", "average_precision"))).alias("metric", "value"))
    return totals.unionByName(sizes).unionByName(long)
