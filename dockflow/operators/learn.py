"""Count regression and classification as Spark ML jobs (ML-01..18, FE-10)."""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.sinks import kept
from .features import Periods, feature_frame, shift_months

CS = (0.01, 0.1, 1.0, 10.0)
PHIS = (1.0, 1.5, 2.0, 3.0)
ROUNDS_KEPT = 8
#: Trees that one plan holds; a larger model writes its running scores in between.
TREES_A_PLAN = 32
#: Most rounds of a count model, and rounds without a better error after which it stops.
MAX_ROUNDS, PATIENCE = 2000, 50


def assemble(features: list[str], impute: bool = False) -> Pipeline:
    """Ordered features to a vector; missing values stay NaN for trees or take the mean for linear models (FE-10)."""
    if impute:
        filled = [f"__{f}" for f in features]
        return Pipeline(stages=[Imputer(inputCols=features, outputCols=filled), VectorAssembler(inputCols=filled, outputCol="features", handleInvalid="keep")])
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")])


def filled(df: DataFrame, features: list[str], value: float = -999.0) -> DataFrame:
    """Trees take missing values as one far value."""
    return df.withColumns({f: F.coalesce(F.col(f).cast("double"), F.lit(value)) for f in features})


@dataclass
class CountTrees:
    """Boosted trees of a count's log mean: the log of the mean, and a learning rate times each tree's answer."""

    base: float
    rate: float
    trees: list[DecisionTreeRegressionModel]

    @property
    def importances(self) -> np.ndarray:
        """Gains of the features over all trees, each tree normalised."""
        return sum((t.featureImportances.toArray() for t in self.trees), np.zeros(self.trees[0].numFeatures if self.trees else 0))

    def transform(self, prepared: DataFrame) -> DataFrame:
        out = prepared.withColumn("__f", F.lit(self.base))
        for i, t in enumerate(self.trees):
            out = _grown(out if i == 0 or i % TREES_A_PLAN else kept(out), t, self.rate)
        return out.withColumn("prediction", F.exp("__f")).drop("__f")


def _grown(df: DataFrame, tree: DecisionTreeRegressionModel, rate: float) -> DataFrame:
    return tree.transform(df).withColumn("__f", F.greatest(F.lit(-20.0), F.least(F.lit(20.0), F.col("__f") + rate * F.col("__t")))).drop("__t")


def boost_counts(train: DataFrame, rounds: int, depth: int, rate: float, check: DataFrame | None = None, patience: int | None = None) -> tuple[CountTrees, list[float]]:
    """Newton boosting of the Poisson deviance with a log link: a round's tree fits y / mu - 1 by weights mu, so a leaf answers
    sum(y - mu) / sum(mu). ``check``: rows whose mean absolute error is told after every round; with ``patience`` the
    rounds end when it hasn't fallen for that many. Both hold features and label; they and running scores are written first and every
    ROUNDS_KEPT rounds, where lineage ends."""
    train = kept(train.select("features", "label"))
    mean = train.agg(F.avg("label")).first()[0] or 0.0
    model = CountTrees(math.log(max(mean, 1e-9)), rate, [])
    held = None if check is None else kept(check.select("features", "label"))
    now, held = (None if df is None else df.withColumn("__f", F.lit(model.base)) for df in (train, held))
    errors = []
    for i in range(rounds):
        mu = F.exp("__f")
        tree = DecisionTreeRegressor(labelCol="__z", weightCol="__w", predictionCol="__t", maxDepth=depth, seed=7).fit(now.withColumns({"__z": F.col("label") / mu - 1.0, "__w": mu}))
        model.trees.append(tree)
        now, held = (None if df is None else _grown(df, tree, rate) for df in (now, held))
        if (i + 1) % ROUNDS_KEPT == 0 and i + 1 < rounds:
            now, held = (None if df is None else kept(df) for df in (now, held))
        if held is not None:
            errors.append(held.agg(F.avg(F.abs(F.exp("__f") - F.col("label")))).first()[0])
            if patience is not None and i - errors.index(min(errors)) >= patience:
                break
    return model, errors


def fit_counts(frame: DataFrame, features: list[str], stop_from: str, max_rounds: int = MAX_ROUNDS, depth: int = 5, target: str = "rentals", refit_frame: DataFrame | None = None, rate: float = 0.3, patience: int | None = PATIENCE) -> tuple[CountTrees, int, list[float]]:
    """Boosted trees with the Poisson objective: the number of rounds is the best by absolute error on rows from ``stop_from`` on, where rounds
    end after ``patience`` of them without a better one; then all rows are fitted with it (ML-01). ``refit_frame``: other features of the same rows for the second
    phase (``fit_counts_leak_free``). A stop period without rows is a ValueError."""
    def prepared(df: DataFrame) -> DataFrame:
        return assemble(features).fit(df).transform(filled(df, features)).withColumn("label", F.col(target).cast("double"))

    cut = F.col("hour_start") >= F.lit(stop_from).cast("timestamp_ntz")
    _, errors = boost_counts(prepared(frame.where(~cut)), max_rounds, depth, rate, prepared(frame.where(cut)), patience)
    if errors[0] is None:
        raise ValueError(f"no rows from {stop_from} on")
    rounds = 1 + min(range(len(errors)), key=lambda i: errors[i])
    return boost_counts(prepared(frame if refit_frame is None else refit_frame), rounds, depth, rate)[0], rounds, errors


def leak_free_frames(grid: DataFrame, calendar: DataFrame, stations: DataFrame, start: str, end: str, stop_from: str, **options) -> tuple[DataFrame, DataFrame]:
    """Feature frames of the same rows, [start, end), for the two phases of a fit (ML-02): the first's statistics end at ``stop_from``, so that no rental of the stop
    period is in what stops the rounds; the second's end with the rows. ``options``: those of ``feature_frame``."""
    first, second = (feature_frame(grid, calendar, stations, Periods((start, end), (start, until)), **options) for until in (stop_from, end))
    return first, second


def fit_counts_leak_free(grid: DataFrame, calendar: DataFrame, stations: DataFrame, features: list[str], start: str, end: str, stop_from: str, options: dict | None = None, **fit) -> tuple[CountTrees, int, list[float]]:
    """The count model, with rounds chosen on features that know nothing of the stop period, and fitted on those that know it all (ML-02). ``fit``: arguments of
    ``fit_counts``."""
    first, second = leak_free_frames(grid, calendar, stations, start, end, stop_from, **(options or {}))
    return fit_counts(first, features, stop_from, refit_frame=second, **fit)


def predict_counts(model, frame: DataFrame, features: list[str]) -> DataFrame:
    """Batch scores, at least 0 (ML-03)."""
    out = model.transform(assemble(features).fit(frame).transform(filled(frame, features)))
    return out.withColumn("prediction", F.greatest(F.lit(0.0), F.col("prediction"))).drop("features")


def gain_share(model, features: list[str], spark) -> DataFrame:
    """Normalised importances, falling (ML-04)."""
    v = model.importances
    return spark.createDataFrame([(f, float(x / (v.sum() or 1.0))) for f, x in zip(features, v, strict=True)], "feature string, share double").orderBy(F.desc("share"))


def choose_model(mae: Column, peak: Column, base_mae: Column, base_peak: Column, factor: float = 0.97) -> Column:
    """A candidate is taken if its error is at most ``factor`` of the baseline's and its peak error is lower (ML-05)."""
    return F.when((mae <= factor * base_mae) & (peak < base_peak), "candidate").otherwise("baseline")


def compare_same_rows(a: DataFrame, b: DataFrame, keys: list[str]) -> None:
    """Two candidates' rows must have the same keys, each as often (ML-06)."""
    sides = a.select(*keys, F.lit(1).alias("__s")).unionByName(b.select(*keys, F.lit(-1).alias("__s")))
    if sides.groupBy(*keys).agg(F.sum("__s").alias("gap")).where("gap <> 0").limit(1).count():
        raise ValueError("the candidates were evaluated on different rows")


def training_window(grid: DataFrame, start: str, end: str | None = None) -> tuple[str, str]:
    """History up to the first of the month after the last full month, or up to an earlier month's first (ML-07)."""
    last = grid.agg(F.max("hour_start")).first()[0]
    full = shift_months(f"{last:%Y-%m}-01", 1 if (last.replace(hour=0) .strftime("%Y-%m-%d") == _month_end(last) and last.hour == 23) else 0)
    use = end or full
    if use > full or use[8:] != "01" or use < shift_months(start, 3):
        raise ValueError(f"the history {start} to {use} isn't whole months, ends after {full}, or is under three months")
    return start, use


def _month_end(day) -> str:
    import calendar

    return f"{day:%Y-%m}-{calendar.monthrange(day.year, day.month)[1]:02d}"


def nowcast_features(rows: DataFrame, horizons: str = "3") -> DataFrame:
    """Columns of the shortage classifier for rows with a bike: logs, inverse, changes and their missing flags, the net-outflow z, off day and
    hour dummies (ML-09)."""
    e, r, q = (F.col(c) for c in ("e", "r", "q"))
    z = (e - q - F.col("b0")) / F.sqrt(F.greatest(e + q, F.lit(1e-12)))
    hours = {f"hour_{h}": (F.floor(F.hour("as_of") / 3) == h).cast("double") for h in range(1, 8)}
    return rows.where("b0 >= 1").withColumns({"log_b0": F.log1p("b0"), "inverse_b0": 1.0 / F.col("b0"), "log_e": F.log1p(e), "log_r": F.log1p(r), "log_q": F.log1p(q), "z": z, **hours})


def nowcast_tree_features(rows: DataFrame) -> DataFrame:
    """Raw values; a missing change is NULL (ML-10)."""
    return rows.where("b0 >= 1").withColumns({f"d{m}": F.when(~F.col(f"miss{m}"), F.col(f"d{m}")) for m in (30, 60)})


def standardize(rows: DataFrame, columns: list[str], train: Column) -> DataFrame:
    """Centred and scaled by the training rows' population moments; a constant column is only centred (ML-12)."""
    stats = rows.where(train).agg(*(f(F.col(c).cast("double")).alias(f"__{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))))
    out = rows.crossJoin(F.broadcast(stats))
    out = out.withColumns({c: (F.col(c) - F.col(f"__m_{c}")) / F.when(F.col(f"__s_{c}") > 0, F.col(f"__s_{c}")).otherwise(1.0) for c in columns})
    return out.select(*rows.columns)


def fit_logistic(rows: DataFrame, columns: list[str], c: float, label: str = "y"):
    """L2 logistic regression whose penalty is ||w||^2 / (2 C n), the intercept free (ML-11)."""
    n = rows.count()
    vec = VectorAssembler(inputCols=columns, outputCol="features").transform(rows).withColumn("label", F.col(label).cast("double"))
    return LogisticRegression(regParam=1.0 / (c * max(1, n)), elasticNetParam=0.0, standardization=True, maxIter=200).fit(vec)


def probabilities(model, rows: DataFrame, columns: list[str]) -> DataFrame:
    out = model.transform(VectorAssembler(inputCols=columns, outputCol="features").transform(rows))
    return out.withColumn("p", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def logistic_gradient(model, rows: DataFrame, columns: list[str], c: float, label: str = "y") -> DataFrame:
    """The gradient of the penalised mean loss at a fitted model (``fit_logistic``), which is 0 at its optimum: feature, rows and gradient, one row for each
    scaled column and one for the intercept. A constant column has no scale and its gradient is 0. One aggregate over the scored rows."""
    p = probabilities(model, rows, columns)
    miss = F.col("p") - F.col(label)
    sums = p.agg(F.count("*").alias("rows"), F.avg(miss).alias("intercept"), *(a.alias(f"{n}_{f}") for f in columns for n, a in (("g", F.avg(miss * F.col(f))), ("s", F.stddev_samp(F.col(f).cast("double"))))))
    scaled = [F.struct(F.lit(f).alias("feature"), F.when(F.col(f"s_{f}") > 0, F.col(f"g_{f}") / F.col(f"s_{f}") + F.lit(float(w)) * F.col(f"s_{f}") / (c * F.col("rows"))).otherwise(0.0).alias("gradient")) for f, w in zip(columns, model.coefficients, strict=True)]
    first = F.struct(F.lit("intercept").alias("feature"), F.col("intercept").alias("gradient"))
    return sums.select("rows", F.inline(F.array(first, *scaled))).select("feature", "rows", "gradient")


def forward_folds(rows: DataFrame, day: str, first: int = 4) -> DataFrame:
    """Every row's fold number: day k is validated on the days before it, from the fourth day on (ML-13). Days are few."""
    days = rows.select(day).distinct().withColumn("fold", F.dense_rank().over(Window.orderBy(day)))
    return rows.join(F.broadcast(days), day).withColumn("validates", F.col("fold") >= first)


def select_c(rows: DataFrame, columns: list[str], day: str = "day", cs: tuple[float, ...] = CS) -> tuple[float, DataFrame]:
    """The C of the lowest mean fold loss, the smaller on ties, and every candidate's losses (ML-14). One fit for each fold and C."""
    from .metrics import probability_losses

    folds = forward_folds(rows, day).persist()
    try:
        numbers = [r[0] for r in folds.where("validates").select("fold").distinct().orderBy("fold").collect()]
        parts = []
        for k in numbers:
            train, check = folds.where(F.col("fold") < k), folds.where(F.col("fold") == k)
            for c in cs:
                p = probabilities(fit_logistic(train, columns, c), check.withColumn("y", F.col("y").cast("double")), columns)
                parts.append(probability_losses(p, "p", "y", []).select(F.lit(k).alias("fold"), F.lit(c).alias("c"), "log_loss"))
        losses = reduce(DataFrame.unionByName, parts)
        mean = losses.groupBy("c").agg(F.avg("log_loss").alias("log_loss"))
        return mean.orderBy("log_loss", "c").first()["c"], mean
    finally:
        folds.unpersist()


def select_tree(rows: DataFrame, columns: list[str], day: str = "day", depths: tuple[int, ...] = (3, 4), rounds: int = 20) -> tuple[int, int]:
    """Depth and rounds of the lowest mean fold curve (ML-15)."""
    folds = forward_folds(rows, day).persist()
    try:
        numbers = [r[0] for r in folds.where("validates").select("fold").distinct().orderBy("fold").collect()]
        curves = {}
        for depth in depths:
            each = []
            for k in numbers:
                prep = lambda df: VectorAssembler(inputCols=columns, outputCol="features").transform(filled(df, columns)).withColumn("label", F.col("y").cast("double"))
                each.append(GBTClassifier(maxDepth=depth, maxIter=rounds, seed=7).fit(prep(folds.where(F.col("fold") < k))).evaluateEachIteration(prep(folds.where(F.col("fold") == k))))
            curves[depth] = [sum(x) / len(each) for x in zip(*each, strict=True)]
        depth, best = min(((d, i) for d, c in curves.items() for i in range(len(c))), key=lambda t: (curves[t[0]][t[1]], t[0], t[1]))
        return depth, best + 1
    finally:
        folds.unpersist()


def pick_lowest(table: DataFrame, key: str, value: str) -> DataFrame:
    """The key of the lowest value, the smaller key on ties (ML-16)."""
    return table.orderBy(value, key).limit(1).select(key)


def pick_challenger(table: DataFrame) -> DataFrame:
    """The highest AUC, the earlier name on ties (ML-17)."""
    return table.orderBy(F.desc("auc"), "candidate").limit(1)


def selected_model(reports: DataFrame) -> DataFrame:
    """The newest measurement that was adopted, else the first (ML-18)."""
    return reports.orderBy(F.desc("adopted"), F.when(F.col("adopted"), F.col("version")).desc_nulls_last(), "version").limit(1)


@dataclass
class Baseline:
    """A profile column as the model, for when no candidate is adopted (ML-05)."""

    column: str = "b0"

    def transform(self, frame: DataFrame) -> DataFrame:
        return frame.withColumn("prediction", F.coalesce(F.col(self.column).cast("double"), F.lit(0.0)))


def fresh_stations(snapshots: DataFrame, stations: DataFrame, now: datetime, max_age: timedelta) -> DataFrame:
    """Known stations of the newest snapshot; an error where that is missing or older than ``max_age``."""
    newest = snapshots.agg(F.max("fetched_at")).first()[0]
    if newest is None or now - newest > max_age:
        raise RuntimeError(f"no recent snapshot: the newest is of {newest}")
    return stations.join(snapshots.where(F.col("fetched_at") == F.lit(newest)).select("station_id").distinct(), "station_id", "left_semi")


def predict_issue(model, features: list[str], model_name: str, forecast: DataFrame, snapshots: DataFrame, stations: DataFrame, holidays: DataFrame, stats: dict[str, DataFrame], now: datetime, hours: int = 48, max_age: timedelta = timedelta(hours=6), grid: tuple[int, int] = (60, 127), created_at: Column | None = None) -> DataFrame:
    """Predictions of the newest forecast issue of one grid cell for the stations of the newest snapshot and those of the next ``hours`` hours (from the current one)
    that the issue covers, as one version (ML-08). ``stats``: frozen statistics (SR-26).

    A RuntimeError where there is no forecast, no snapshot within ``max_age``, or no hour to predict. Three single values come to the driver."""
    from ..functions.time import version_of
    from .features import scoring_rows
    from .staging import grid_filter
    from .weather import pivot_forecast

    own = grid_filter(forecast, *grid)
    base = own.agg(F.max("base_at")).first()[0]
    if base is None:
        raise RuntimeError("no forecast")
    live = fresh_stations(snapshots, stations, now, max_age)
    first = now.replace(minute=0, second=0, microsecond=0)
    weather = pivot_forecast(own.where(F.col("base_at") == F.lit(base))).where((F.col("hour_start") >= F.lit(first)) & (F.col("hour_start") < F.lit(first + timedelta(hours=hours))))
    weather = weather.withColumn("is_new_snow", F.col("is_snow").cast("boolean")).drop("is_snow", "base_at")
    if weather.isEmpty():
        raise RuntimeError(f"the forecast of {base} covers none of the hours from {first}")
    rows = scoring_rows(live, weather.select("hour_start"), weather, holidays, stats)
    made = F.current_timestamp().cast("timestamp_ntz") if created_at is None else created_at
    return predict_counts(model, rows, features).select("station_id", "hour_start", version_of(model_name, F.lit(base)).alias("model_version"), F.col("prediction").alias("predicted_rentals"), made.alias("created_at"))


def predict_both(model, frame: DataFrame, features: list[str], other_weather: DataFrame, weather: list[str]) -> DataFrame:
    """The same rows scored twice with only the weather swapped (FW-10): from_forecast and from_observed by station and hour. All other columns
    are carried over from one frame, so they can't differ."""
    keys = ["station_id", "hour_start"]
    swapped = frame.drop(*weather).join(other_weather.select("hour_start", *weather), "hour_start")
    a = predict_counts(model, frame, features).select(*keys, F.col("prediction").alias("from_forecast"))
    return a.join(predict_counts(model, swapped, features).select(*keys, F.col("prediction").alias("from_observed")), keys)


def recompute_predictions(model, features: list[str], stations: DataFrame, forecast: DataFrame, base: str, holidays: DataFrame, stats: dict[str, DataFrame]) -> DataFrame:
    """Scores of an old issue's stations with its own forecast (RB-26)."""
    from .features import scoring_rows
    from .weather import pivot_forecast

    weather = pivot_forecast(forecast.where(F.col("base_at") == F.lit(base).cast("timestamp_ntz"))).withColumn("is_new_snow", F.col("is_snow").cast("boolean")).drop("is_snow", "base_at")
    rows = scoring_rows(stations, weather.select("hour_start"), weather, holidays, stats)
    return predict_counts(model, rows, features).select("station_id", "hour_start", F.col("prediction").alias("predicted_rentals"))
