"""Hand-counted cases of the operators."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockflow.functions import parse
from dockflow.operators import checks, features, learn, marts, metrics, pit, serving, shortage, staging, weather
from dockflow.plans import registry_loads
from dockflow.sources import adapters as A
from dockflow.sources import readers, sinks
from dockflow.streaming import streams

T = dt.datetime


def test_trips_are_deduplicated_and_cancelled(spark):
    r = [("b", T(2024, 1, 1, 8), "A", T(2024, 1, 1, 8), "A", 0), ("b", T(2024, 1, 1, 8), "A", T(2024, 1, 1, 8), "A", 0), ("b", T(2024, 1, 1, 9), "A", T(2024, 1, 1, 9), "B", 0), ("b", T(2024, 1, 1, 9, 5), "A", T(2024, 1, 1, 9, 9), None, 4), ("b", T(2024, 1, 1, 9, 5), "A", T(2024, 1, 1, 9, 9), None, 4)]
    t = spark.createDataFrame(r, "bike_no string, rented_at timestamp_ntz, rent_station_id string, returned_at timestamp_ntz, return_station_id string, duration_min int")
    out = {(x.rented_at, x.return_station_id): x.is_cancelled for x in staging.stage_trips(t).collect()}
    assert out == {(T(2024, 1, 1, 8), "A"): True, (T(2024, 1, 1, 9), "B"): False, (T(2024, 1, 1, 9, 5), None): False}


def test_rain_is_spread_in_winter_only(spark):
    o = spark.createDataFrame([(T(2024, 1, 1, h), 0.0, 0.0, 0.0, 0.9 if h == 3 else None, 0.3 if h == 3 else None) for h in (1, 2, 3)] + [(T(2024, 7, 1, 3), 0.0, 0.0, 0.0, 2.0, None)], "observed_at timestamp_ntz, temp_c double, wind_ms double, humidity_pct double, rain_mm double, new_snow_3h_cm double")
    out = {x.hour_start: (round(x.rain_mm, 6), x.is_new_snow) for x in staging.stage_observations(o).collect()}
    assert out == {T(2024, 1, 1, 0): (0.3, True), T(2024, 1, 1, 1): (0.3, True), T(2024, 1, 1, 2): (0.3, True), T(2024, 7, 1, 2): (2.0, False)}


@pytest.mark.parametrize(("text", "value"), [("none", 0.0), ("rain none", 0.0), ("under 1mm", 0.5), ("30mm~50mm", 40.0), ("50mm or more", 50.0), ("1.5mm", 1.5), ("3", 3.0), ("fog", None), ("", None), (None, None)])
def test_amounts(spark, text, value):
    assert spark.createDataFrame([(text,)], "v string").select(parse.parse_amount(F.col("v"))).first()[0] == value


def test_station_names(spark):
    d = spark.createDataFrame([("102. Main St",), ("  Main St ",), ("",), (None,)], "v string")
    no, name = parse.split_station_name(F.col("v"))
    assert [tuple(r) for r in d.select(no, name).collect()] == [(102, "Main St"), (None, "Main St"), (None, None), (None, None)]


def test_grid_fills_hours_and_drops_return_only_stations(spark):
    h = spark.createDataFrame([("A", T(2024, 1, 1, 5), 2, 0), ("A", T(2024, 1, 2, 7), 0, 1), ("A", T(2024, 1, 3, 0), 0, 1), ("B", T(2024, 1, 1, 5), 0, 1)], "station_id string, hour_start timestamp_ntz, rentals long, returns long")
    st = spark.createDataFrame([("A", 2), ("B", 0)], "station_id string, total_rentals long")
    g = marts.densify(h, marts.active_span(h, st, "2024-01-02"))
    assert g.count() == 48 and g.agg(F.sum("rentals")).first()[0] == 2 and g.select("station_id").distinct().count() == 1


def test_asof_is_strict_and_by_key(spark):
    left = spark.createDataFrame([("a", 5), ("a", 1), ("b", 5), (None, 5)], "k string, t int")
    right = spark.createDataFrame([("a", 5, "same"), ("a", 3, "old"), ("b", 9, "late")], "k string, t int, v string")
    got = {(r.k, r.t): r.v for r in pit.asof_join(left, right, ["k"], "t", "t", ["v"]).collect()}
    assert got == {("a", 5): "old", ("a", 1): None, ("b", 5): None, (None, 5): None}
    got = {(r.k, r.t): r.v for r in pit.asof_join(left, right, ["k"], "t", "t", ["v"], strict=False).collect()}
    assert got[("a", 5)] == "same"


def test_nearest_takes_the_earlier_on_ties(spark):
    times = spark.createDataFrame([(T(2024, 1, 1, 0, 57),), (T(2024, 1, 1, 1, 3),), (T(2024, 1, 1, 2, 6),)], "fetched_at timestamp_ntz")
    want = spark.createDataFrame([(T(2024, 1, 1, 1, 0),), (T(2024, 1, 1, 2, 0),)], "target_at timestamp_ntz")
    assert {r.target_at: r.nearest_at for r in pit.nearest_snapshot(want, times).collect()} == {T(2024, 1, 1, 1, 0): T(2024, 1, 1, 0, 57), T(2024, 1, 1, 2, 0): None}


def test_horizon_sum_is_null_if_an_hour_is_missing(spark):
    rows = spark.createDataFrame([("A", T(2024, 1, 1, 8, 20)), ("B", T(2024, 1, 1, 8, 20))], "station_id string, as_of timestamp_ntz")
    v = spark.createDataFrame([("A", T(2024, 1, 1, h), float(h)) for h in (8, 9, 10, 11)] + [("B", T(2024, 1, 1, 8), 1.0)], "station_id string, hour_start timestamp_ntz, p double")
    got = {r.station_id: r.e for r in shortage.horizon_sum(rows, v, 3, ["station_id"], "p", "e").collect()}
    assert got["A"] == pytest.approx(8 * 2 / 3 + 9 + 10 + 11 / 3) and got["B"] is None


def test_auc_and_average_precision_against_pairs(spark):
    rnd = random.Random(3)
    data = [(rnd.randint(0, 6) / 2, rnd.randint(0, 1)) for _ in range(120)]
    d = spark.createDataFrame(data, "s double, y int")
    pos, neg = [s for s, y in data if y], [s for s, y in data if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)
    ap = 0.0
    for s in sorted({s for s, _ in data}, reverse=True):
        above = [y for t, y in data if t >= s]
        ap += sum(1 for t, y in data if t == s and y) / len(pos) * sum(above) / len(above)
    for by in ([], ["g"]):
        got = metrics.rank_metrics(metrics.score_groups(d.withColumn("g", F.lit(1)), "s", "y", by), by).first()
        assert got.auc == pytest.approx(auc) and got.average_precision == pytest.approx(ap)


def test_one_class_has_no_auc(spark):
    d = spark.createDataFrame([(1.0, 1), (2.0, 1)], "s double, y int")
    assert metrics.rank_metrics(metrics.score_groups(d, "s", "y", []), []).first().auc is None


def test_reliability_has_every_bin(spark):
    out = metrics.reliability(spark.createDataFrame([(1.0, 1), (0.05, 0)], "p double, y int"), "p", "y").orderBy("bin").collect()
    assert len(out) == 10 and out[9].rows == 1 and out[0].rows == 1 and out[5].mean_predicted is None


@pytest.mark.parametrize("phi", [1.0, 2.0])
def test_net_outflow_against_sums(spark, phi):
    cases = [(1, 2, 3.0, 1.5), (2, 1, 0.5, 2.0), (3, 4, 6.0, 0.0), (4, 0, 2.0, 2.0), (5, 9, 4.0, 4.0)]

    def pmf(k, m):
        m = max(m, 1e-12)
        if phi == 1.0:
            return math.exp(k * math.log(m) - m - math.lgamma(k + 1))
        n = m / (phi - 1)
        return math.exp(math.lgamma(n + k) - math.lgamma(n) - math.lgamma(k + 1) + n * math.log(1 / phi) + k * math.log(1 - 1 / phi))

    d = spark.createDataFrame(cases, "id int, b0 int, e double, q double")
    for r in shortage.net_outflow(d, "b0", "e", "q", phi).collect():
        want = sum(pmf(o, r.e) * pmf(i, r.q) for o in range(120) for i in range(120) if o - i >= r.b0)
        assert r.S3 == pytest.approx(want, abs=1e-8)


def test_absorption_against_fine_steps(spark):
    b0, rent, back = 2, [1.5, 3.0], [1.0, 0.5]
    d = spark.createDataFrame([(b0, rent, back, [1.0, 1.0])], "b0 int, r array<double>, q array<double>, t array<double>")
    got = d.select(shortage.absorption(F.col("b0"), F.col("r"), F.col("q"), F.col("t"))).first()[0]
    p, steps = [0.0] * (b0 + 31), 4000
    p[b0] = 1.0
    for lam, mu in zip(rent, back, strict=True):
        for _ in range(steps):
            h, new = 1 / steps, p[:]
            for k in range(1, len(p)):
                up = mu * h * p[k] if k < len(p) - 1 else 0.0
                new[k] -= lam * h * p[k] + up
                new[k - 1] += lam * h * p[k]
                if up:
                    new[k + 1] += up
            p = new
    assert got == pytest.approx(p[0], abs=2e-3)


def test_absorption_of_many_events(spark):
    """Rates far over those that one exponential can weigh: the count is gone in the first case, and a tail of a Poisson count in the second."""
    d = spark.createDataFrame([(3, [900.0], [800.0], [1.0]), (60, [90.0], [0.0], [1.0])], "b0 int, r array<double>, q array<double>, t array<double>")
    busy, drained = (r[0] for r in d.select(shortage.absorption(F.col("b0"), F.col("r"), F.col("q"), F.col("t"))).collect())
    assert busy > 0.9
    assert drained == pytest.approx(1 - sum(math.exp(k * math.log(90) - 90 - math.lgamma(k + 1)) for k in range(60)), abs=1e-9)


def test_absorption_with_births_against_a_matrix(spark):
    cases = [(1, 0.7, 1.2), (4, 3.0, 2.0), (0, 1.0, 1.0), (2, 0.0, 3.0)]
    d = spark.createDataFrame([(b, [x / 3] * 3, [y / 3] * 3, [1.0] * 3) for b, x, y in cases], "b0 int, r array<double>, q array<double>, t array<double>")
    got = [r[0] for r in d.select(shortage.absorption(F.col("b0"), F.col("r"), F.col("q"), F.col("t"))).collect()]
    for value, (b, x, y) in zip(got, cases, strict=True):
        n, out, back = b + 31, x / 3, y / 3
        move = np.zeros((n, n))  # rates of change of the state's probabilities
        for k in range(1, n):
            move[k - 1, k] += out
            move[k, k] -= out
            if k < n - 1:
                move[k + 1, k] += back
                move[k, k] -= back
        p, term = np.zeros(n), np.zeros(n)
        p[b] = 1.0
        for _ in range(3):
            term, total = p, p
            for i in range(1, 60):
                term = move @ term / i
                total = total + term
            p = total
        assert value == pytest.approx(p[0], abs=1e-9)


def test_relocation_events(spark):
    snaps = spark.createDataFrame([("A", T(2024, 1, 1, 8, 10), 7), ("A", T(2024, 1, 1, 8, 20), 2), ("A", T(2024, 1, 1, 8, 30), 0), ("A", T(2024, 1, 1, 8, 40), 6), ("B", T(2024, 1, 1, 8, 10), 1), ("B", T(2024, 1, 1, 8, 30), 9)], "station_id string, fetched_at timestamp_ntz, bike_count int")
    rows = spark.createDataFrame([(T(2024, 1, 1, 8, 15), T(2024, 1, 1, 8, 10), s) for s in "AB"], "as_of timestamp_ntz, reference_at timestamp_ntz, station_id string")
    got = {r.station_id: (r.recovery, r.recovery_after_zero, r.pickup_before_zero) for r in shortage.relocation_events(rows, snaps).collect()}
    assert got == {"A": (True, True, True), "B": (False, False, False)}  # B is absent at 8:20, so its change isn't counted


def test_exclusions_in_order(spark):
    d = spark.createDataFrame([(0, False, None), (1, False, None), (1, True, None), (1, True, 1.0)], "b0 int, ok boolean, e double")
    got = [r[0] for r in d.select(shortage.exclusion_reason(F.col("b0"), F.col("ok"), F.col("e"), F.lit(1.0), F.lit(1.0))).collect()]
    assert got == ["already_empty", "station_sparse", "no_prediction", "main"]


def test_parameter_bounds():
    serving.check_bounds(3, 50, 30)
    for bad in ((0, 1, 1), (7, 1, 1), (1, 0, 1), (1, 501, 1), (1, 1, 181)):
        with pytest.raises(ValueError):
            serving.check_bounds(*bad)


def test_labels_truncate_no_wall_clock_time_of_a_snapshot(spark):
    issues = spark.sql("select timestamp_ntz'2024-01-10 02:15:00' as as_of")
    snaps = spark.sql("select 'S' as station_id, timestamp_ntz'2024-01-10 02:00:00' + make_dt_interval(0, 0, 10 * id, 0) as fetched_at, cast(19 - id as int) as bike_count from range(20)")
    got = shortage.labels(issues, snaps)
    assert "trunc" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.b0, r.y, r.ok) for r in got.collect()] == [(18, 1, True)]


def test_upsert_deals_by_partition_and_writes_new_ones_once(spark, tmp_path, monkeypatch):
    between, p = [], f"file://{tmp_path}/t"
    monkeypatch.setattr(sinks, "scratch_folder", lambda _: between.append(f"file://{tmp_path}/b{len(between)}") or between[-1])
    monkeypatch.setattr(sinks, "UPSERT_ROWS", 10)
    rows = spark.range(0, 100, 1, 8).selectExpr("id as k", "concat('v', id % 5) as version", "id * 1.0D as x", "0 as updated_at")
    sinks.upsert_partition(p, rows, ["k", "version"], "version")
    assert not between and all(len(list(d.glob("*.parquet"))) <= 2 for d in (tmp_path / "t").glob("version=*"))
    sinks.upsert_partition(p, rows.where("k < 3").unionByName(rows.where("k < 3").selectExpr("k", "version", "-1.0D as x", "1 as updated_at")), ["k", "version"], "version")
    got = {r.k: r.x for r in spark.read.parquet(p).collect()}
    assert len(between) == 1 and got == {k: -1.0 if k < 3 else float(k) for k in range(100)}


def test_relocation_events_take_one_window(spark):
    rows = spark.sql("select timestamp_ntz'2024-01-10 02:15:00' as as_of, timestamp_ntz'2024-01-10 02:10:00' as reference_at, 'S' as station_id")
    counts = [9, 3, 0, 6, 6, 0]
    snaps = spark.createDataFrame([(n, c) for n, c in enumerate(counts)], "n int, c int").selectExpr("'S' as station_id", "timestamp_ntz'2024-01-10 02:10:00' + make_dt_interval(0, 0, 10 * n, 0) as fetched_at", "c as bike_count")
    got = shortage.relocation_events(rows, snaps)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1
    assert [(r.recovery, r.recovery_after_zero, r.pickup_before_zero) for r in got.collect()] == [(True, True, True)]


def test_zero_alerts_truncate_no_time(spark):
    rows = spark.sql("select timestamp_ntz'2024-01-10 02:15:00' as as_of, 'S' as station_id")
    snaps = spark.sql("select 'S' as station_id, timestamp_ntz'2024-01-10 05:15:00' + make_dt_interval(0, 0, cast(id as int), 0) as fetched_at, 0 as bike_count from range(2)")
    got = streams.zero_alerts_batch(rows, snaps)
    assert "trunc" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert [str(r.first_zero) for r in got.collect()] == ["2024-01-10 05:15:00"]


def test_feature_rows_meet_their_station_once(spark):
    d = "/root/testdata/sf0.001"
    _, st, g = A.built(spark, d)
    f = features.feature_frame(g, A.full_calendar(spark, d), st, features.Periods(("2024-01-22", "2024-01-29"), ("2024-01-01", "2024-01-22")))
    plan = f.drop("hour_of_day")._jdf.queryExecution().optimizedPlan().toString()
    keys = [line for line in plan.splitlines() if "Join " in line and "station_id" in line and "hour_of_day" in line]
    assert not keys and f.count() > 0  # no statistic is joined by station and hour


def test_queries_that_read_the_grid_twice_write_it_once(spark, monkeypatch):
    from dockflow.plans import registry, registry_loads  # noqa: F401

    monkeypatch.setattr(A, "grid", lambda *_: pytest.fail("the grid is built anew"))
    for name in ("ml02_leak_free_frames", "ag05_07_profiles"):
        assert registry.QUERIES[name](spark, "/root/testdata/sf0.001").columns


def test_parity_of_changed_columns_is_the_same_pass(spark):
    a = spark.createDataFrame([(1, 1.0), (2, None), (3, 5.0)], "k int, x double")
    got = features.parity_check(a, a, ["k"], ["x"], {"x": F.when(F.col("k") == 2, F.lit(0.0)).otherwise(F.col("x"))}).first()
    assert (got.shared, got.different, got.different_after_change) == (3, 0, 1)


def test_insert_ignore_is_idempotent(spark, tmp_path):
    d = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k int, v string")
    p = f"file://{tmp_path}/t"
    assert sinks.insert_ignore(p, d, ["k"]) == 2 and sinks.insert_ignore(p, d, ["k"]) == 0
    assert sorted((r.k, r.v) for r in spark.read.parquet(p).collect()) == [(1, "a"), (2, "c")]


def test_insert_ignore_sorts_and_joins_nothing(spark, tmp_path):
    rows = spark.createDataFrame([("a", "x", 3), ("a", "x", 2), ("b", "x", None), ("b", "x", 1), (None, "y", 5)], "k string, day string, n int")
    p = f"file://{tmp_path}/t"
    assert sinks.insert_ignore(p, rows, ["k"], "day") == 3 and sinks.insert_ignore(p, rows, ["k"], "day") == 0  # NULL keys are equal
    assert {(r.k, r.day, r.n) for r in spark.read.parquet(p).collect()} == {("a", "x", 2), ("b", "x", None), (None, "y", 5)}
    plan = sinks.unseen(spark.read.schema(rows.schema).parquet(p), rows, ["k"], ("day",), 2)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Sort" not in plan and "Join" not in plan


def test_insert_ignore_of_dealt_rows(spark, tmp_path):
    p, dealt = f"file://{tmp_path}/t", spark.createDataFrame([("a",), ("b",), (None,)], "k string").repartition(3, "k")
    rows = dealt.select("k", F.explode(F.array(F.lit(1), F.lit(2), F.lit(2))).alias("t")).select("k", "t", F.concat(F.lit("d"), "t").alias("day"), F.when(F.col("t") == 1, 7).alias("n"))
    put = lambda df, by=("k",): sinks.insert_ignore(p, df, ["k", "t"], "day", by, 3)
    assert [put(rows), put(rows)] == [6, 0]  # NULL keys are equal
    other = spark.createDataFrame([("a", 2, "d2", 9), ("a", 3, "d3", 9), ("a", 3, "d3", 8), (None, 3, "d3", 5)], rows.schema)  # not dealt as it says
    assert [put(other), put(other, ("k", "day"))] == [2, 0]
    assert {tuple(r) for r in spark.read.parquet(p).select("k", "t", "day", "n").collect()} == {(k, t, f"d{t}", n) for k in ("a", "b", None) for t, n in ((1, 7), (2, None))} | {("a", 3, "d3", 8), (None, 3, "d3", 5)}


def test_day_routing_shuffles_no_snapshots(spark, monkeypatch):
    plans, unseen, d = [], sinks.unseen, "/root/testdata/sf0.001"

    def seen(*a):
        plans.append((found := unseen(*a))._jdf.queryExecution().executedPlan().toString())
        return found

    monkeypatch.setattr(sinks, "unseen", seen)
    assert registry_loads.st05(spark, d).agg(F.sum("n")).first()[0] == A.snapshots(spark, d).count()
    rows, tasks = A.snapshots_by_day(spark, d, 1000)
    assert rows.exceptAll(A.snapshots(spark, d).withColumn("day", F.to_date("fetched_at"))).isEmpty() and rows.count() == A.snapshots(spark, d).count() and tasks > 4
    assert len(plans) == 2 and all("HashAggregate" in (above := p.split("Generate explode")[0]) and "Exchange" not in above for p in plans)  # shuffled before they are multiplied


def test_insert_ignore_reads_the_partitions_of_the_batch_alone(spark, tmp_path):
    p = f"file://{tmp_path}/t"
    first = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, part string")
    assert sinks.insert_ignore(p, first, ["k", "part"], "part") == 2
    (next((tmp_path / "t" / "part=y").glob("*.parquet"))).write_bytes(b"not a table")
    again = spark.createDataFrame([(1, "z", "x"), (3, "c", "x")], "k int, v string, part string")
    assert sinks.insert_ignore(p, again, ["k", "part"], "part") == 1  # the broken folder isn't opened
    assert sorted((r.k, r.v) for r in spark.read.parquet(f"{p}/part=x").collect()) == [(1, "a"), (3, "c")]


def test_candidates_must_have_the_same_rows(spark):
    a = spark.createDataFrame([(1, 0.1), (2, 0.2)], "k int, p double")
    learn.compare_same_rows(a, a.withColumn("p", F.lit(0.0)), ["k"])
    for b in (a.where("k = 1"), a.withColumn("k", F.col("k") + 1), a.union(a.limit(1))):
        with pytest.raises(ValueError):
            learn.compare_same_rows(a, b, ["k"])


def test_decision_of_two_steps(spark):
    d = spark.createDataFrame([(0.1, 0.2, 12, 0.1), (-0.1, 0.2, 12, 0.1), (0.1, 0.2, 9, 0.1), (0.1, 0.2, 12, 0.3)], "low double, high double, days int, brier double")
    first = metrics.decide(F.col("low"), F.col("high"), "S3")
    final = metrics.decide_final(first, [F.col("low")], F.col("brier"), F.lit(0.2), F.lit(0.9), F.lit(0.8), F.col("days"))
    assert [tuple(r) for r in d.select(first, final).collect()] == [("S3", "N"), ("S0", "S0"), ("S3", None), ("S3", "S3")]


def test_upsert_replaces_in_touched_partitions(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(f"file://{tmp_path}/cp")
    p, schema = f"file://{tmp_path}/t", "k int, v string, updated_at int, part string"
    sinks.upsert_partition(p, spark.createDataFrame([(1, "a", 0, "x"), (2, "b", 0, "y")], schema), ["k"], "part")
    sinks.upsert_partition(p, spark.createDataFrame([(1, "z", 1, "x"), (3, "c", 1, "x")], schema), ["k"], "part")
    assert sorted((r.k, r.v) for r in spark.read.parquet(p).collect()) == [(1, "z"), (2, "b"), (3, "c")]


def test_month_partitions_are_replaced_alone(spark, tmp_path):
    p = f"file://{tmp_path}/m"
    sinks.write_month_partition(spark.createDataFrame([(1, "2024-01"), (2, "2024-02")], "v int, month string"), p)
    sinks.write_month_partition(spark.createDataFrame([(3, "2024-02")], "v int, month string"), p)
    assert sorted(r.v for r in spark.read.parquet(p).collect()) == [1, 3]
    assert [r.v for r in readers.scan_months(spark, p, ["2024-02"]).collect()] == [3]


def test_generations_switch_last(spark, tmp_path):
    p = f"file://{tmp_path}/g"
    for g in ("g1", "g2"):
        sinks.publish_generation({"t": spark.createDataFrame([(g,)], "v string")}, p, g)
    assert sinks.current_generation(spark, p) == "g2"
    got = sinks.read_artifacts(spark, f"{p}/generation=g2", ["t"], {"absent": "a int"})
    assert got["t"].first().v == "g2" and got["absent"].count() == 0


def test_a_failing_day_does_not_stop_the_others(spark, tmp_path):
    landed = spark.createDataFrame([(dt.date(2024, 1, d), f"f{d}") for d in (1, 2, 3)], "day date, file string")

    def load(day):
        if day.day == 2:
            raise RuntimeError("no")

    done, failed = sinks.recover_days(landed, f"file://{tmp_path}/manifest", "2024-01-03", load)
    assert [d.day for d in done] == [1, 3] and [d.day for d, _ in failed] == [2]
    assert [d.day for d in sinks.recover_days(landed, f"file://{tmp_path}/manifest", "2024-01-03", lambda d: None)[0]] == [2]


def test_trip_csv(spark, tmp_path):
    f = tmp_path / "trips_2401.csv"
    english = {f"헤더{i}": c for i, c in enumerate(readers.TRIP_COLUMNS[:-1])}
    f.write_bytes((",".join(english) + "\n" + ",".join(["B1", "2024-01-01 08:00:00", "00102", "\\N", '""', *["x"] * 11]) + "\n").encode("cp949"))
    r = readers.read_trip_csv(spark, [f"file://{f}"], english).first()
    assert (r.bike_no, r.rent_station_no, r.rent_station_name, r.rent_dock, r.bike_type, r.month) == ("B1", "00102", None, None, None, "2024-01")
    with pytest.raises(ValueError):
        readers.check_headers(["other"], english)


def test_snapshot_pages(spark):
    row = lambda i: (str(i), "n", "1", "0", "", "127", f"S{i}")
    d = spark.createDataFrame([("t1", ([row(1), row(2)],), [(2, 2)]), ("t2", ([row(1), row(1)],), [(2, 2)])], readers.SNAPSHOT_SCHEMA)
    assert [r.fetched_at for r in readers.snapshot_page_faults(d).collect()] == ["t2"]
    assert readers.snapshot_rows(d).where("fetched_at = 't1'").first().lat is None


def test_station_sheet(spark, tmp_path):
    f = tmp_path / "stations_2023-06.csv"
    f.write_text("title,,,,,,,,,\n,,,,,,,,,\nstation_no,name,d,a,lat,lon,o,l,q,op\n,,,,,,,,,\n,,,,,,,,,\n102, Main , ,x,37.1,127.0,,5,,y\n,no,,,,,,,,\n")
    rows = readers.read_station_snapshots(spark, f"file://{f}").collect()
    assert [(r.station_no, r.station_name, r.district, r.snapshot) for r in rows] == [("102", "Main", None, "2023-06")]


def test_data_tests(spark):
    d = spark.createDataFrame([(1, None), (1, "a"), (2, "b")], "k int, v string")
    assert {r.column_name: r.nulls for r in checks.not_null(d, ["k", "v"]).collect()} == {"k": 0, "v": 1}
    assert [r.k for r in checks.unique(d, ["k"]).collect()] == [1]
    assert [r.v for r in checks.relationships(d, spark.createDataFrame([("a",)], "v string"), "v").collect()] == ["b"]


def test_logistic_and_folds(spark):
    rnd = random.Random(1)
    rows = [(d, x := rnd.gauss(0, 1), int(rnd.random() < 1 / (1 + math.exp(-2 * x)))) for d in range(6) for _ in range(60)]
    d = spark.createDataFrame(rows, "day int, x double, y int")
    best, table = learn.select_c(d, ["x"], cs=(0.1, 1.0))
    assert best in (0.1, 1.0) and table.count() == 2
    z = learn.standardize(d.withColumn("one", F.lit(1.0)), ["x", "one"], F.lit(True)).agg(F.avg("x"), F.stddev_pop("x"), F.max("one")).first()
    assert z[0] == pytest.approx(0, abs=1e-9) and z[1] == pytest.approx(1) and z[2] == 0


def test_training_window(spark):
    g = spark.createDataFrame([(T(2024, 6, 30, 23),)], "hour_start timestamp_ntz")
    assert learn.training_window(g, "2024-01-01") == ("2024-01-01", "2024-07-01")
    assert learn.training_window(spark.createDataFrame([(T(2024, 6, 29, 23),)], "hour_start timestamp_ntz"), "2024-01-01") == ("2024-01-01", "2024-06-01")
    with pytest.raises(ValueError):
        learn.training_window(g, "2024-01-01", "2024-02-01")


def test_boosted_counts(spark):
    """A leaf is a Newton step of the Poisson deviance; more rounds find the rates of two groups and the best round."""
    rnd = np.random.RandomState(2)
    x = rnd.randint(0, 2, 400)
    y = rnd.poisson(np.where(x == 1, 6.0, 0.5))
    d = spark.createDataFrame([(T(2024, 1, 1 + i // 100), float(a), int(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))], "hour_start timestamp_ntz, x double, rentals int")
    prepared = learn.assemble(["x"]).fit(d).transform(d).withColumn("label", F.col("rentals").cast("double"))
    one, _ = learn.boost_counts(prepared, 1, 1, 1.0)
    mu = y.mean()
    got = {r.x: r.prediction for r in one.transform(prepared).select("x", "prediction").distinct().collect()}
    assert got == pytest.approx({g: mu * math.exp((y[x == g] - mu).sum() / (mu * (x == g).sum())) for g in (0, 1)})
    model, rounds, errors = learn.fit_counts(d, ["x"], "2024-01-04", max_rounds=12, depth=2)
    assert len(errors) == 12 and rounds == 1 + int(np.argmin(errors))
    many, _ = learn.boost_counts(prepared, 20, 1, 0.3)
    got = {r.x: r.prediction for r in many.transform(prepared).select("x", "prediction").distinct().collect()}
    assert got == pytest.approx({g: y[x == g].mean() for g in (0, 1)}, rel=0.05)
    assert [tuple(r) for r in learn.gain_share(model, ["x"], spark).collect()] == [("x", 1.0)]
    assert learn.predict_counts(model, d, ["x"]).where("prediction < 0").count() == 0


def test_counts_stop_when_errors_no_longer_fall(spark, monkeypatch):
    """A stop period that says nothing of x: errors rise once the groups are told apart, so the best round is early and patience ends the fit; a model of
    more trees than a plan holds answers the same."""
    rnd = np.random.RandomState(5)
    rows = [(T(2024, 1, 1 + i // 100), float(x), int(rnd.poisson(8.0 if x and i < 300 else 1.0))) for i, x in enumerate(rnd.randint(0, 2, 400))]
    d = spark.createDataFrame(rows, "hour_start timestamp_ntz, x double, rentals int")
    model, rounds, errors = learn.fit_counts(d, ["x"], "2024-01-04", depth=1, patience=3)
    assert rounds == 1 + int(np.argmin(errors)) and len(errors) == rounds + 3 < learn.MAX_ROUNDS
    model.trees *= 4
    whole = [r.prediction for r in learn.predict_counts(model, d, ["x"]).orderBy("x").collect()]
    monkeypatch.setattr(learn, "TREES_A_PLAN", 1)
    assert [r.prediction for r in learn.predict_counts(model, d, ["x"]).orderBy("x").collect()] == pytest.approx(whole)
    with pytest.raises(ValueError, match="no rows"):
        learn.fit_counts(d, ["x"], "2025-01-01", depth=1, max_rounds=1)


def test_stop_phase_knows_nothing_of_the_stop_period(spark):
    """Rentals of the stop period are changed: the first frame's features stay as they were, the second's don't, and the rows are the same."""
    from dockflow.sources import adapters as A

    D = "/root/testdata/sf0.001"
    grid, cal, st = A.grid(spark, D), A.full_calendar(spark, D), A.stations(spark, D)
    later = grid.withColumn("rentals", F.when(F.col("hour_start") >= F.lit("2024-01-22").cast("timestamp_ntz"), F.col("rentals") + 5).otherwise(F.col("rentals")))
    a, b = (learn.leak_free_frames(g, cal, st, "2024-01-08", "2024-01-29", "2024-01-22") for g in (grid, later))
    plain = lambda f: sorted(map(tuple, f.drop("rentals").fillna(-1.0).collect()), key=repr)
    assert plain(a[0]) == plain(b[0]) and plain(a[1]) != plain(b[1])
    assert a[0].select("station_id", "hour_start").exceptAll(a[1].select("station_id", "hour_start")).isEmpty()
    model, rounds, errors = learn.fit_counts_leak_free(grid, cal, st, ["b0", "hour_of_day"], "2024-01-08", "2024-01-29", "2024-01-22", max_rounds=2, depth=2)
    assert len(model.trees) == rounds <= len(errors) == 2


def test_the_first_measurement_is_used_where_none_was_adopted(spark):
    one = lambda *rows: learn.selected_model(spark.createDataFrame(rows, "version string, adopted boolean")).first()["version"]
    assert one(("v1", False), ("v2", True), ("v3", False)) == "v2" and one(("v1", True), ("v3", True)) == "v3" and one(("v2", False), ("v1", False)) == "v1"


def test_asof_join_of_a_hot_key_is_dealt_by_stretches(spark):
    """One key has nearly all rows; any stretch gives the same rows, and a window holds one stretch of a key."""
    import random
    from datetime import datetime, timedelta

    r, start = random.Random(2), datetime(2024, 1, 1)
    keys = lambda: "hot" if r.random() < 0.9 else r.choice(["a", "b", None])
    left = [(i, keys(), start + timedelta(minutes=r.randrange(30 * 1440))) for i in range(600)] + [(900, "hot", None), (901, None, start)]
    right = [(keys(), start + timedelta(minutes=30 * r.randrange(10 * 48)), r.randrange(5)) for _ in range(80)] + [("hot", None, 9)]
    a = spark.createDataFrame(left, "id int, k string, t timestamp_ntz")
    b = spark.createDataFrame(right, "k string, u timestamp_ntz, v int")
    for strict in (True, False):
        want = {}
        for i, k, t in left:
            before = [(u, v) for q, u, v in right if q == k and u is not None and t is not None and (u < t or u == t and not strict)]
            want[i] = max(before) if before else (None, None)
        for stretch in (3600, 86400, 10**9):
            out = pit.asof_join(a, b, ["k"], "t", "u", ["v"], strict, stretch)
            assert {x.id: (x.asof_u, x.v) for x in out.collect()} == want
    plan = pit.asof_join(a, b, ["k"], "t", "u", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "__stretch" in plan.split("Window", 1)[1].splitlines()[0]


def test_rank_metrics_of_large_groups_are_dealt_by_ranges(spark):
    """Continuous scores, one group with most of the rows, a null group: sums as in one window by group, and no window has more than a range's share."""
    import random

    from pyspark.sql import Window

    r = random.Random(3)
    rows = [("big" if r.random() < 0.8 else r.choice(["x", None]), r.gauss(0, 1), float(r.random() < 0.4), 1.0) for _ in range(4000)]
    g = spark.createDataFrame(rows, "g string, score double, pos double, neg double")
    got = metrics.prefix_sums(g, ["g"])
    w = Window.partitionBy("g").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    want = g.withColumns({"pos_above": F.coalesce(F.sum("pos").over(w), F.lit(0.0)), "neg_above": F.coalesce(F.sum("neg").over(w), F.lit(0.0))})
    assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))
    windows = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(g" in windows and "__range" in windows
    cuts = g.selectExpr(f"percentile_approx(score, array({', '.join(str(i / 64) for i in range(1, 64))}), 1000) as c")
    largest = g.crossJoin(cuts).groupBy("g", F.size(F.filter("c", lambda c: c < F.col("score")))).count().agg(F.max("count")).first()[0]
    assert largest <= 2 * 4000 / 64


def _frozen(spark):
    row = lambda values, schema: spark.createDataFrame(values, schema)
    hours = [(off, h) for off in (False, True) for h in range(24)]
    return {
        "codes": row([("ST-1", 1)], "station_id string, station_code int"), "district_codes": row([("D1", 1)], "district string, district_code int"),
        "profile": row([("ST-1", off, h, float(h)) for off, h in hours], "station_id string, is_offday boolean, hour_of_day int, profile_mean double"), "hour_profile": row([("ST-1", h, 1.0) for h in range(24)], "station_id string, hour_of_day int, hour_mean double"),
        "trend": row([("ST-1", 1.0)], "station_id string, station_trend double"), "global_profile": row([(off, h, 100.0 + h) for off, h in hours], "is_offday boolean, hour_of_day int, global_profile_mean double"),
        "global_hour": row([(h, 2.0) for h in range(24)], "hour_of_day int, global_hour_mean double"), "global_trend": row([(1.0,)], "global_trend double"),
    }


def _issue(spark, base, hours, now, snapshot_at, others=()):
    from datetime import timedelta

    cells = [(base, base + timedelta(hours=h), c, v, 60, 127) for h in hours for c, v in (("TMP", "20"), ("PCP", "none"))] + list(others)
    forecast = spark.createDataFrame(cells, "base_at timestamp_ntz, target_at timestamp_ntz, category string, value string, nx int, ny int")
    snaps = spark.createDataFrame([(s, snapshot_at, 3) for s in ("ST-1", "ST-9", "ST-unknown")] + [("ST-2", snapshot_at - timedelta(minutes=10), 3)], "station_id string, fetched_at timestamp_ntz, bike_count int")
    stations = spark.createDataFrame([(s, "D1", 10, 37.0, 127.0) for s in ("ST-1", "ST-2", "ST-9")], "station_id string, district string, docks int, lat double, lon double")
    holidays = spark.createDataFrame([], "holiday_date date, holiday_name string")
    return learn.predict_issue(learn.Baseline("b0"), ["b0"], "v1-test", forecast, snaps, stations, holidays, _frozen(spark), now)


def test_predict_issue_writes_and_overwrites(spark, tmp_path):
    """Hours that the issue covers from the current one on, known stations of the newest snapshot, a version named by the issue; again: as many rows."""
    from datetime import datetime, timedelta

    base, now = datetime(2024, 3, 5, 5), datetime(2024, 3, 5, 8, 20)
    other = [(base + timedelta(hours=3), base + timedelta(hours=4), "TMP", "35", 61, 128)]  # another cell's later issue
    for _ in range(2):
        made = _issue(spark, base, range(2, 8), now, now - timedelta(minutes=10), other)
        sinks.write_predictions(f"file://{tmp_path}/p", made)
    rows = spark.read.parquet(f"file://{tmp_path}/p").collect()
    assert {r.model_version for r in rows} == {"v1-test-fcst202403050500"}
    assert sorted((r.station_id, r.hour_start.hour, r.predicted_rentals) for r in rows) == sorted([("ST-1", h, float(h)) for h in range(8, 12)] + [("ST-9", h, 100.0 + h) for h in range(8, 12)])


def test_predict_issue_refuses_stale_or_missing_input(spark):
    from datetime import datetime, timedelta

    import pytest

    base, now = datetime(2024, 3, 5, 5), datetime(2024, 3, 5, 8)
    assert _issue(spark, base, range(1, 9), now, now - timedelta(hours=6)).count() > 0
    with pytest.raises(RuntimeError, match="snapshot"):
        _issue(spark, base, range(1, 9), now, now - timedelta(hours=6, minutes=1))
    with pytest.raises(RuntimeError, match="no forecast"):
        _issue(spark, base, [], now, now)
    with pytest.raises(RuntimeError, match="covers none"):
        _issue(spark, base, range(1, 3), now, now)


def test_labels_of_long_windows_and_stations_outside_the_reference(spark):
    """Slots beyond the first word of bits count; a station that the reference snapshot lacks has no row; repeated rows count once; no snapshots, no rows."""
    from datetime import timedelta

    start, as_of = T(2024, 1, 1, 8, 10), T(2024, 1, 1, 8, 15)
    seen = [("A", start, 3)] * 2 + [("A", start + timedelta(minutes=10 * i), 0 if i == 70 else 2) for i in range(1, 80)] + [("B", start + timedelta(minutes=10), 1), ("C", start, 0)]
    snaps = spark.createDataFrame(seen, "station_id string, fetched_at timestamp_ntz, bike_count int")
    issues = spark.createDataFrame([(as_of,), (T(2024, 1, 2),)], "as_of timestamp_ntz")
    got = {r.station_id: (r.b0, r.y, r.recovered, r.ok) for r in shortage.labels(issues, snaps, 12).collect()}
    assert got == {"A": (3, 1, True, True), "C": (0, 0, False, False)}
    status = {r.as_of: (r.slots, r.status) for r in shortage.issue_status(issues, snaps, None, 12).collect()}
    assert status == {as_of: (72, "ok"), T(2024, 1, 2): (0, "no_reference")}
    assert shortage.labels(issues, snaps.limit(0)).count() == 0


def test_a_join_side_over_the_limit_is_not_broadcast(spark):
    from dockflow.sources.sinks import checked

    small, facts = spark.range(10), spark.range(1000)
    plan = lambda limit: facts.join(checked(small, limit), "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(10) and "SortMergeJoin" in plan(9)
    assert facts.join(checked(small, 9), "id").count() == 10


def test_a_hot_month_is_written_by_several_tasks(spark, tmp_path):
    from dockflow.sources.sinks import write_month_partition

    d = spark.range(0, 400000, 1, 8).select("id", F.rand(1).alias("v"), F.when(F.col("id") % 10 == 0, "2024-02").otherwise("2024-01").alias("month"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        write_month_partition(d, f"{tmp_path}/t")
        write_month_partition(d.where("month = '2024-02'"), f"{tmp_path}/t")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    got = {r["month"]: r["count"] for r in spark.read.parquet(f"{tmp_path}/t").groupBy("month").count().collect()}
    assert {str(k)[:7]: n for k, n in got.items()} == {"2024-01": 360000, "2024-02": 40000}
    assert len(list((tmp_path / "t" / "month=2024-01").glob("*.parquet"))) > 3


def _joins(frame):
    """The join operators of a physical plan, adaptive execution aside."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return [line.split("(")[0].strip(" :+-*") for line in plan.split("\n") if "Join" in line], plan


def _many(spark, n=40):
    """Snapshots that Catalyst takes for a few rows: they come out of an explode."""
    days = spark.createDataFrame([(f"S{i}", T(2024, 1, 1)) for i in range(n)], "station_id string, day timestamp_ntz")
    return days.select("station_id", F.explode(F.expr("sequence(day, day + interval 1430 minute, interval 10 minute)")).alias("fetched_at")).withColumn("bike_count", F.minute("fetched_at"))


def test_snapshots_are_not_broadcast_for_deltas(spark):
    """The counts before the references are as many as the rows; both changes are one pass."""
    rows = spark.createDataFrame([("S1", T(2024, 1, 1, 8, 10), 30), ("S1", T(2024, 1, 1, 0, 0), 3), ("X", T(2024, 1, 1, 8, 10), 1)], "station_id string, reference_at timestamp_ntz, b0 int")
    out = shortage.deltas(rows, _many(spark), 30, 60)
    names, plan = _joins(out)
    assert names[0].startswith("SortMergeJoin") and plan.count("BroadcastHashJoin") <= 1
    got = {(r.station_id, r.reference_at.hour): (r.d30, r.miss30, r.d60, r.miss60) for r in out.collect()}
    assert got == {("S1", 8): (-10.0, False, 20.0, False), ("S1", 0): (0.0, True, 0.0, True), ("X", 8): (0.0, True, 0.0, True)}


def test_hours_of_horizons_are_not_joined(spark):
    """Values of an issue's hours are one row before the join, which sorts; an hour without a value, or with a NULL among two, has no sum."""
    rows = spark.createDataFrame([(s, T(2024, 1, 1, 8, 15)) for s in "ABC"], "station_id string, as_of timestamp_ntz")
    v = spark.createDataFrame([("A", h, 1.0 * h) for h in (8, 9, 10)] + [("B", 8, 4.0), ("B", 10, 4.0), ("C", 8, 4.0), ("C", 8, None), ("A", 7, 9.0)], "station_id string, h int, p double")
    v = v.select("station_id", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, h)").cast("timestamp_ntz").alias("hour_start"), F.lit(T(2024, 1, 1, 8, 15)).cast("timestamp_ntz").alias("as_of"), "p")
    out = shortage.horizon_inputs(rows, v, "p", (1, 2))
    assert "Broadcast" not in _joins(out)[1]
    assert {(r.station_id, r.horizon): r.p for r in out.collect()} == {("A", 1): 8 * 0.75 + 9 * 0.25, ("A", 2): 8 * 0.75 + 9 + 10 * 0.25, ("B", 1): None, ("B", 2): None, ("C", 1): None, ("C", 2): None}
    same = shortage.horizon_inputs(rows, v.drop("as_of"), "p", (1, 2))
    assert sorted(map(tuple, same.collect()), key=repr) == sorted(map(tuple, out.collect()), key=repr)


def test_snapshots_are_not_broadcast_for_issues(spark):
    """Few issues are broadcast, and the snapshots on the other side never; nor are predictions against others."""
    issues = spark.createDataFrame([(T(2024, 1, 1, 8, 15),)], "as_of timestamp_ntz")
    out = weather.snapshot_for_issue(issues, _many(spark, 3))
    assert "BroadcastHashJoin" in _joins(out)[0][0] and "BuildLeft" in _joins(out)[1]
    assert {(r.station_id, r.bike_count) for r in out.collect()} == {(f"S{i}", 10) for i in range(3)}
    p = _many(spark)
    pairs = shortage.stored_vs_recomputed(p, p, ["station_id", "fetched_at"], "station_id", "bike_count")
    assert "Broadcast" not in _joins(pairs)[1] and pairs.where("rows = 144 and max_difference = 0").count() == 40


def test_main_rows_are_not_multiplied_by_their_hours(spark):
    """Each issue and station is one row all the way: no hour of a row is shuffled, an hour without a prediction or a calendar has no sum."""
    snaps = _many(spark, 3).where("minute(fetched_at) <> 50").withColumn("bike_count", F.lit(2))
    issues = spark.createDataFrame([(T(2024, 1, 1, 8, 15),), (T(2024, 1, 1, 20, 15),)], "as_of timestamp_ntz")
    hours = lambda names, days=(1,): [(n, T(2024, 1, day, h)) for n in names for day in days for h in range(24)]
    cal = spark.createDataFrame([(t, False, t.hour) for _, t in hours("c")], "hour_start timestamp_ntz, is_offday boolean, hour_of_day int").where("hour_of_day <> 22")
    pred = spark.createDataFrame(hours(["S0", "S1"]), "station_id string, hour_start timestamp_ntz").crossJoin(issues).where("station_id = 'S0' or hour(hour_start) <> 9").withColumn("predicted_rentals", F.hour("hour_start").cast("double"))
    profile = spark.createDataFrame([(f"S{i}", False, h, float(h), 1.0) for i in range(2) for h in range(24)], "station_id string, is_offday boolean, hour_of_day int, rent_mean double, return_mean double")
    out = shortage.build_rows(issues, snaps, pred, profile, cal)
    plan = _joins(out)[1]
    assert "explode" not in plan.lower() or plan.lower().count("generate explode") == 1  # the snapshots' own
    got = {(r.station_id, r.as_of.hour): (r.e, r.r, r.q, r.reason) for r in out.collect()}
    whole = 8 * 0.75 + 9 + 10 + 11 * 0.25
    assert got[("S0", 8)] == (whole, whole, 3.0, "main") and got[("S1", 8)] == (None, whole, 3.0, "no_prediction") and got[("S2", 8)] == (None, None, None, "no_prediction")
    assert got[("S0", 20)] == (20 * 0.75 + 21 + 22 + 23 * 0.25, None, None, "no_profile") and len(got) == 6


def test_profile_of_spans_is_that_of_the_grid(spark):
    h = spark.createDataFrame([("A", T(2024, 1, 1, 5), 2, 1), ("A", T(2024, 1, 3, 7), 1, 0), ("B", T(2024, 1, 2, 5), 4, 0), ("C", T(2024, 1, 2, 5), 0, 3)], "station_id string, hour_start timestamp_ntz, rentals long, returns long")
    spans = marts.active_span(h, spark.createDataFrame([("A", 3), ("B", 4), ("C", 0)], "station_id string, total_rentals long"), "2024-01-30")
    cal = spark.createDataFrame([(T(2024, 1, d, x), d == 1, x) for d in range(1, 5) for x in range(24)], "hour_start timestamp_ntz, is_offday boolean, hour_of_day int")
    args = cal, "2024-01-01", "2024-01-03"
    want = features.season_profile(h, marts.densify(h, spans), *args)
    got = features.season_profile_of_spans(h, spans, *args)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect())) and got.count() == 72


def test_rows_for_a_fit_are_written_once(spark, monkeypatch):
    """Counting, fitting and scoring read a table, not the plan of the main rows."""
    from dockflow.plans import registry_loads

    rows = spark.createDataFrame([(T(2024, 1, 1, 8), "A", 2, 1, 1.0, 1.0, 1.0, "main", 0), (T(2024, 1, 1, 8), "B", 0, 1, 1.0, 1.0, 1.0, "already_empty", 0)], "as_of timestamp_ntz, station_id string, b0 int, y int, e double, r double, q double, reason string, other int")
    monkeypatch.setattr(registry_loads, "main_rows", lambda s, d: rows)
    out = registry_loads._fitted_rows(spark, "")
    assert "scratch-" in out.inputFiles()[0] and out.count() == 1 and "other" not in out.columns


def test_absorption_of_many_cases_at_once(spark):
    """Cases of different counts, terms and hours in one batch, nulls among them, answer as each does alone; equal ones are solved once."""
    rnd = np.random.RandomState(4)
    b0, lam, mu = rnd.randint(0, 9, 300), rnd.randint(0, 30, (300, 3)) / 4, rnd.randint(0, 9, (300, 3)) / 4
    together = shortage.absorbed(b0, lam, mu, np.ones((300, 3)))
    assert together == pytest.approx([shortage.absorbed(b0[i : i + 1], lam[i : i + 1], mu[i : i + 1], np.ones((1, 3)))[0] for i in range(300)], abs=1e-12)
    rows = [(i, int(b0[i % 300]), lam[i % 300].tolist(), mu[i % 300].tolist(), [1.0] * 3) for i in range(900)] + [(900, None, [1.0], [1.0], [1.0]), (901, 2, [None], [1.0], [1.0]), (902, 0, [1.0], [1.0], [1.0])]
    d = spark.createDataFrame(rows, "i int, b0 int, r array<double>, q array<double>, t array<double>").repartition(1)
    out = d.select("i", shortage.absorption(F.col("b0"), F.col("r"), F.col("q"), F.col("t")).alias("p"))
    got = dict(map(tuple, out.collect()))
    assert [got[i] for i in range(900)] == pytest.approx(list(together) * 3, abs=1e-12) and (got[900], got[901], got[902]) == (None, None, 1.0)


def test_equal_sums_of_tenths_are_ties(spark, monkeypatch):
    """The eleventh station's tenths come in another order, whose sum is larger in its last bit; it is still the last of eleven equal ones."""
    from dockflow.plans import registry

    parts = [(f"S{i:02d}", x) for i in range(11) for x in ((0.1, 0.2, 0.3) if i == 10 else (0.3, 0.2, 0.1))]
    pairs = spark.createDataFrame([("v", s, 1.0, x) for s, x in parts], "issue string, station_id string, from_forecast double, from_observed double").coalesce(1)
    monkeypatch.setattr(registry, "_shift_pairs", lambda s, d: pairs)
    assert [tuple(r) for r in registry.QUERIES["fw12_list_overlap"](spark, "").collect()] == [("v", 10, 1.0)]


def test_leak_check_reads_each_side_once(spark):
    """The rows that either side has more often, NULLs being equal, from one read of each side."""
    a = spark.createDataFrame([(1, None), (1, None), (2, 0.5), (3, 1.0)], "k int, v double")
    b = spark.createDataFrame([(1, None), (2, 0.5), (3, 2.0), (3, 2.0)], "k int, v double")
    out = features.leak_check(a, b)
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([(1, None), (3, 1.0), (3, 2.0), (3, 2.0)], key=repr)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 2 and features.leak_check(a, a).count() == 0
