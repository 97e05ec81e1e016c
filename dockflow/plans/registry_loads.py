"""Registered queries of loading, learning and the batch twins of the streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parse
from ..functions import time as T
from ..operators import features, learn, marts, metrics, pit, shortage, weather
from ..sources import adapters as A
from ..sources import readers, sinks
from ..streaming import streams
from .oracle import over
from .registry import _AUC, _DRAWS, _RANK, ORACLE, main_rows, query, r6

_MAIN = "b0 >= 1 and ok and e is not null and r is not null and q is not null"

#: Orders are moved eight years on, as file names have two digits for years from 2000 on.
_FILES = "(select o_orderkey, 'trips_' || strftime(o_orderdate + interval 8 year, '%y%m') || '.csv' as source_file, strftime(o_orderdate + interval 8 year, '%Y-%m') as month from orders)"


def files(s: SparkSession, d: str) -> DataFrame:
    """A landed file name for each order's month, eight years on (the century is added by rule)."""
    o = A.table(s, d, "orders").withColumn("day", F.add_months("o_orderdate", 96))
    return o.select("o_orderkey", F.concat(F.lit("trips_"), F.date_format("day", "yyMM"), F.lit(".csv")).alias("source_file")).withColumn("month", parse.month_of_file(F.col("source_file")))


@query("sr04_month_of_file", f"select month, count(*) as n from {_FILES} group by 1")
def sr04(s, d):
    return files(s, d).groupBy("month").agg(F.count("*").alias("n"))


@query("sr05_duplicate_periods", f"select month, count(distinct source_file || (o_orderkey % 2)) as sources from {_FILES} group by 1 having count(distinct source_file || (o_orderkey % 2)) > 1")
def sr05(s, d):
    return readers.duplicate_periods(files(s, d).withColumn("source_file", F.concat("source_file", F.col("o_orderkey") % 2)))


@query("sr07_latest_period", f"select max(month) as month, last_day((max(month) || '-01')::date)::varchar as last_day from {_FILES}")
def sr07(s, d):
    return readers.latest_period(files(s, d)).withColumn("last_day", F.col("last_day").cast("string"))


@query("sr10_pending_months", f"select strftime(m, '%Y-%m') as month from (select unnest(generate_series(date '2002-06-01', date '2010-03-01', interval 1 month)) as m) where strftime(m, '%Y-%m') not in (select month from {_FILES}) and last_day(m) < date '2010-02-28'")
def sr10(s, d):
    return readers.pending_months(readers.month_range(s, "2002-06", "2010-03"), files(s, d), "2010-02-28")


@query("sr15_issue_calendar", "with n as (select date_trunc('second', max(ts)) as now from events) select day + to_hours(h) as base_at from n, (select unnest(range(-2, 1)) as k), (select unnest([2, 5, 8, 11, 14, 17, 20, 23]) as h), lateral (select date_trunc('day', now) + to_days(k::int) as day) where day + to_hours(h) + interval 10 minute <= now and day + to_hours(h) > now - interval 24 hour")
def sr15(s, d):
    return readers.issue_calendar(A.table(s, d, "events").agg(F.date_trunc("second", F.max("ts")).cast("timestamp_ntz").alias("now")))


@query("sr16_missing_issues", over("issues", "select base_at from issues where base_at not in (select date_trunc('hour', ts) from events where event_type = 'signup')"))
def sr16(s, d):
    landed = A.table(s, d, "events").where("event_type = 'signup'").select(T.hour_of(F.col("ts")).alias("base_at"))
    return readers.missing_issues(A.issues(s, d).select("base_at"), landed)


@query("sr18_holidays", "select ts::date::varchar as holiday_date, min(event_type) as holiday_name from events where event_type in ('click', 'error') group by 1")
def sr18(s, d):
    """A seed of days and names, written as CSV and read back; a day named twice is one row."""
    path = sinks.scratch_folder(s)
    A.table(s, d, "events").where("event_type in ('click', 'error')").select(F.to_date("ts").cast("string").alias("holiday_date"), F.col("event_type").alias("holiday_name")).write.option("header", "true").csv(path)
    return readers.read_holidays(s, path).select(F.col("holiday_date").cast("string").alias("holiday_date"), "holiday_name")


@query("sr19_insert_ignore", "select user_id, event_type, count(*) as n from (select distinct user_id, event_type, ts::date as day from events) e where not exists (select 1 from events t where t.event_id % 3 = 0 and t.user_id = e.user_id and t.event_type = e.event_type and t.ts::date = e.day) group by all")
def sr19(s, d):
    e = A.table(s, d, "events").withColumn("day", F.to_date("ts"))
    return sinks.unseen(e.where("event_id % 3 = 0"), e, ["user_id", "event_type", "day"]).groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


@query("sr20_upsert", over("dim", "select station_id, case when station_no % 3 = 0 then docks + 1 else docks end as docks, case when station_no % 3 = 0 then 'history' else 'realtime' end as source from dim"))
def sr20(s, d):
    st = A.stations(s, d).select("station_id", "station_no", "docks", F.lit("realtime").alias("source"), F.lit(0).alias("updated_at"))
    new = st.where("station_no % 3 = 0").withColumns({"docks": F.col("docks") + 1, "source": F.lit("history"), "updated_at": F.lit(1)})
    return sinks.merged(st, new, ["station_id"]).select("station_id", "docks", "source")


@query("sr21_load_snapshots", over("snap", "select station_id, count(*) as n, sum(bike_count)::bigint as bikes from snap where bike_count <> 4 and station_id <> 'ST-5' group by 1"))
def sr21(s, d):
    raw = A.snapshots(s, d).select(F.when(F.col("station_id") == "ST-5", " ").otherwise(F.col("station_id")).alias("station_id"), F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss+00:00").alias("fetched_at"), F.when(F.col("bike_count") == 4, "").otherwise(F.concat(F.col("bike_count"), F.lit(".0"))).alias("bike_count"), F.lit("10").alias("rack_count"))
    return sinks.load_snapshots(raw).groupBy("station_id").agg(F.count("*").alias("n"), F.sum("bike_count").alias("bikes"))


@query("sr22_discover_stations", over("snap", "select station_id, arg_max(bike_count, fetched_at) as bike_count, 'realtime' as source from snap where station_id not in (select 'ST-' || (s_suppkey % 30) from supplier) group by 1"))
def sr22(s, d):
    known = A.table(s, d, "supplier").select(F.concat(F.lit("ST-"), F.col("s_suppkey") % 30).alias("station_id")).distinct()
    return sinks.discover_stations(A.snapshots(s, d), known)


@query("sr24_pending_days", over("snap", "select fetched_at::date::varchar as day, count(distinct fetched_at) as files from snap where fetched_at::date > date '2024-01-23' and day(fetched_at) % 2 = 0 group by 1"))
def sr24(s, d):
    landed = A.snapshots(s, d).select(F.to_date("fetched_at").alias("day"), F.date_format("fetched_at", "HHmm").alias("file")).distinct()
    manifest = landed.where((F.dayofmonth("day") % 2 != 0) | (F.col("file") != "0500"))
    return sinks.pending_days(landed, manifest, "2024-01-30").select(F.col("day").cast("string").alias("day"), F.size("landed").cast("long").alias("files"))


@query("sr27_predictions_upsert", over("pred", "select model_version, count(*) as n, round(sum(case when hour(hour_start) = 12 then predicted_rentals + 1 else predicted_rentals end), 6) as total from pred group by 1"))
def sr27(s, d):
    """Predictions written, and the noon hours written again with other values."""
    path, p = sinks.scratch_folder(s), A.predictions(s, d)
    sinks.write_predictions(path, p)
    again = p.where(F.hour("hour_start") == 12).withColumns({"predicted_rentals": F.col("predicted_rentals") + 1, "created_at": T.plus_hours(F.col("created_at"), 1)})
    sinks.write_predictions(path, again)
    return r6(s.read.parquet(path).groupBy("model_version").agg(F.count("*").alias("n"), F.sum("predicted_rentals").alias("total")), "total")


@query("fe14_level_coverage", over("halves", "select round(avg((p.half_mean is not null)::int), 6) as coverage from halves h left join halves p on p.station_id = h.station_id and p.half = h.half - 2"))
def fe14(s, d):
    return r6(features.published_levels(A.levels_grid(s, d))[0].agg(F.avg(F.col("station_recent_ratio").isNotNull().cast("int")).alias("coverage")), "coverage")


@query("ml05_choose_model", over("scored", "select stratum, case when avg(abs(p - y)) <= 0.97 * avg(abs(0.5 - y)) and max(abs(p - y)) < 0.9 then 'candidate' else 'baseline' end as choice from scored group by 1"))
def ml05(s, d):
    t = A.scored(s, d).groupBy("stratum").agg(F.avg(F.abs(F.col("p") - F.col("y"))).alias("mae"), F.avg(F.abs(0.5 - F.col("y"))).alias("base"), F.max(F.abs(F.col("p") - F.col("y"))).alias("peak"))
    return t.select("stratum", learn.choose_model(F.col("mae"), F.col("peak"), F.col("base"), F.lit(0.9)).alias("choice"))


@query("ml09_nowcast_features", over("rows3", "select as_of, station_id, round(ln(1 + b0), 6) as log_b0, round(1.0 / b0, 6) as inverse_b0, round(ln(1 + e), 6) as log_e, round((e - q - b0) / sqrt(greatest(e + q, 1e-12)), 6) as z, (hour(as_of) // 3 = 4)::int::double as hour_4 from rows3 where b0 >= 1"))
def ml09(s, d):
    return r6(learn.nowcast_features(main_rows(s, d)).select("as_of", "station_id", "log_b0", "inverse_b0", "log_e", "z", "hour_4"), "log_b0", "inverse_b0", "log_e", "z")


@query("ml12_standardize", over("scored", "select doc_id, round((score - m) / sd, 5) as score from scored cross join (select avg(score) as m, stddev_pop(score) as sd from scored where doc_id % 2 = 0)"))
def ml12(s, d):
    return learn.standardize(A.scored(s, d), ["score"], F.col("doc_id") % 2 == 0).select("doc_id", F.round("score", 5).alias("score"))


@query("ml13_forward_folds", over("issues", "select base_at, dense_rank() over (order by base_at::date)::int as fold, dense_rank() over (order by base_at::date) >= 4 as validates from issues"))
def ml13(s, d):
    i = A.issues(s, d).withColumn("day", F.to_date("base_at"))
    return learn.forward_folds(i, "day").select("base_at", "fold", "validates")


@query("ml16_ml17_picks", over("scored", "select (select stratum from scored group by 1 order by round(avg((p - y) * (p - y)), 9), stratum limit 1) as lowest_brier, (select stratum from scored group by 1 order by round(avg(p), 9) desc, stratum limit 1) as highest"))
def ml16(s, d):
    t = A.scored(s, d).groupBy("stratum").agg(F.round(F.avg((F.col("p") - F.col("y")) * (F.col("p") - F.col("y"))), 9).alias("brier"), F.round(F.avg("p"), 9).alias("auc"))
    return learn.pick_lowest(t, "stratum", "brier").withColumnRenamed("stratum", "lowest_brier").crossJoin(F.broadcast(learn.pick_challenger(t.withColumnRenamed("stratum", "candidate")).select(F.col("candidate").alias("highest"))))


@query("ml01_boosted_counts")
def ml01(s, d):
    """Boosted trees on the grid's features; rows only, as a model's numbers are its library's."""
    _, st, g = A.built(s, d)
    columns = ["hour_of_day", "day_of_week", "is_offday", "docks", "temp_c", "rain_mm", "profile_mean", "b0"]
    f = features.feature_frame(g, A.full_calendar(s, d), st, features.Periods(("2024-01-15", "2024-01-30"), ("2024-01-01", "2024-01-15")))
    f = sinks.kept(f.select("station_id", "hour_start", "rentals", *columns))  # both phases and the scores read it
    model, _, _ = learn.fit_counts(f.where("hour_start < timestamp_ntz'2024-01-25'"), columns, "2024-01-22", max_rounds=5, depth=4)
    out = learn.predict_counts(model, f.where("hour_start >= timestamp_ntz'2024-01-25'"), columns)
    return out.select("station_id", "hour_start", "rentals", F.round("prediction", 4).alias("prediction"))


@query("ml08_predict_issue", over("grid cal dim snap issues", """select station_id, hour_start, model_version, round(coalesce(p.m, q.m)::float::double, 3) as predicted_rentals from (select station_id from snap where fetched_at = (select max(fetched_at) from snap)) join dim using (station_id)
    cross join (select h as hour_start, 'v1-fcst' || strftime(b, '%Y%m%d%H%M') as model_version, hour(h)::int as hour_of_day, (h::date in (date '2024-01-01', date '2024-01-15') or isodow(h) >= 6) as is_offday from (select b, unnest(generate_series(b, b + interval 47 hour, interval 1 hour)) as h from (select max(base_at) as b from issues)))
    left join (select station_id, is_offday, hour_of_day, avg(rentals) as m from grid join cal using (hour_start) where hour_start < '2024-01-22' group by all) p using (station_id, is_offday, hour_of_day)
    left join (select is_offday, hour_of_day, avg(rentals) as m from grid join cal using (hour_start) where hour_start < '2024-01-22' group by all) q using (is_offday, hour_of_day)"""))
def ml08(s, d):
    """The newest issue at the time of the newest snapshot, by the profile baseline; stored twice, so the second run replaces the first."""
    snaps, stations = A.snapshots(s, d), A.stations(s, d)
    stats = features.history_stats(A.grid(s, d), A.full_calendar(s, d), stations, ("2024-01-01", "2024-01-22"))
    now = snaps.agg(F.max("fetched_at")).first()[0]
    made = learn.predict_issue(learn.Baseline("b0"), ["b0"], "v1", A.forecast(s, d), snaps, stations, A.holidays(s, d), stats, now, created_at=F.lit(now))
    path = sinks.scratch_folder(s)
    for _ in range(2):
        sinks.write_predictions(path, made)
    return s.read.parquet(path).select("station_id", "hour_start", "model_version", F.round("predicted_rentals", 3).alias("predicted_rentals"))


def _fitted_rows(s: SparkSession, d: str) -> DataFrame:
    """Main rows for a fit, written once: counting, fitting and scoring all read them, and no shuffle of theirs stays on disk three times."""
    return learn.nowcast_features(sinks.kept(main_rows(s, d).where("reason = 'main'").select("as_of", "station_id", "b0", "y", "e", "r", "q")))


@query("ml11_logistic")
def ml11(s, d):
    rows = _fitted_rows(s, d)
    columns = ["log_b0", "inverse_b0", "log_e", "log_r", "log_q", "z"]
    return learn.probabilities(learn.fit_logistic(rows, columns, 1.0), rows, columns).select("as_of", "station_id", "y", F.round("p", 4).alias("p"))


@query("ml11_optimality", over("rows3", f"select feature, n as rows, true as optimal from (select count(*) as n from rows3 where {_MAIN}) cross join (select unnest(['intercept', 'log_b0', 'inverse_b0', 'log_e', 'log_r', 'log_q', 'z']) as feature)"))
def ml11_optimality(s, d):
    """A fit that SQL can't repeat, held against the condition that defines it: the penalised gradient vanishes in every column."""
    rows = _fitted_rows(s, d)
    columns = ["log_b0", "inverse_b0", "log_e", "log_r", "log_q", "z"]
    return learn.logistic_gradient(learn.fit_logistic(rows, columns, 1.0), rows, columns, 1.0).select("feature", "rows", (F.abs("gradient") < 1e-3).alias("optimal"))


@query("ml02_leak_free_frames", over("grid cal", """with h as (select * from grid join cal using (hour_start) where hour_start < '2024-01-29')
    select station_id, hour_start, round(coalesce(a.m, b.m)::float::double, 3) as stop_b0, round(coalesce(c.m, e.m)::float::double, 3) as full_b0 from h
    left join (select station_id, is_offday, hour_of_day, avg(rentals) as m from h where hour_start < '2024-01-22' group by all) a using (station_id, is_offday, hour_of_day)
    left join (select is_offday, hour_of_day, avg(rentals) as m from h where hour_start < '2024-01-22' group by all) b using (is_offday, hour_of_day)
    left join (select station_id, is_offday, hour_of_day, avg(rentals) as m from h group by all) c using (station_id, is_offday, hour_of_day)
    left join (select is_offday, hour_of_day, avg(rentals) as m from h group by all) e using (is_offday, hour_of_day)""").replace("\nwith h as", ",\nh as"))
def ml02(s, d):
    """The same rows for both phases; what stops the rounds has seen no rental from 22 January on."""
    _, st, g = A.built(s, d)
    first, second = learn.leak_free_frames(g, A.full_calendar(s, d), st, "2024-01-01", "2024-01-29", "2024-01-22")
    b0 = lambda f, name: f.select("station_id", "hour_start", F.round(F.col("b0").cast("double"), 3).alias(name))
    return b0(first, "stop_b0").join(b0(second, "full_b0"), ["station_id", "hour_start"])


_DELTAS = ", ".join(f"(b0 - s{m}.bike_count)::double as d{m}, s{m}.bike_count is null as miss{m}" for m in (30, 60))
_BEFORE = " ".join(f"left join snap s{m} on s{m}.station_id = l.station_id and s{m}.fetched_at = l.reference_at - interval {m} minute" for m in (30, 60))


@query("ml10_tree_features", over("labels3 snap", f"select l.as_of, l.station_id, b0, {_DELTAS} from labels3 l {_BEFORE} where b0 >= 1"))
def ml10(s, d):
    snaps = A.snapshots(s, d)
    rows = shortage.deltas(shortage.labels(A.issues(s, d).select("as_of"), snaps), snaps, 30, 60)
    return learn.nowcast_tree_features(rows).select("as_of", "station_id", "b0", "d30", "miss30", "d60", "miss60")


@query("ml18_selected_model", over("scored", """with r as (select stratum as version, avg(abs(p - y)) as mae, avg(abs(0.5 - y)) as base from scored group by 1)
    select 'measured' as reports, coalesce(max(version) filter (where mae <= 0.97 * base), min(version)) as version from r union all select 'none adopted', min(version) from r""").replace("\nwith r as", ",\nr as"))
def ml18(s, d):
    """Measurements by stratum, as they are and with none adopted."""
    e = F.abs(F.col("p") - F.col("y"))
    r = A.scored(s, d).groupBy(F.col("stratum").alias("version")).agg((F.avg(e) <= 0.97 * F.avg(F.abs(0.5 - F.col("y")))).alias("adopted"))
    one = lambda name, reports: learn.selected_model(reports).select(F.lit(name).alias("reports"), "version")
    return one("measured", r).unionByName(one("none adopted", r.withColumn("adopted", F.lit(False))))


_KEPT = features.without(features.BASE_FEATURES, features.WEATHER_FEATURES)


@query("fe09_without_weather", over("grid cal dim", f"""with g as (select d.district, d.docks, known from grid join cal using (hour_start) join dim d using (station_id)
    left join (select distinct station_id, is_offday, hour_of_day, true as known from grid join cal using (hour_start) where hour_start < '2024-01-22') k using (station_id, is_offday, hour_of_day) where hour_start >= '2024-01-22' and hour_start < '2024-01-30')
    select feature, case when feature = 'district_code' then count(district) when feature in ('docks', 'lat', 'lon') then count(docks) when feature = 'profile_mean' then count(known) when feature like '%trend' then 0 else count(*) end as n from g cross join (select unnest({_KEPT}) as feature) group by feature""").replace("\nwith g as", ",\ng as"))
def fe09(s, d):
    """The frame of the candidate without weather: how many rows have each of its features."""
    f = features.feature_frame(A.grid(s, d), A.full_calendar(s, d), A.stations(s, d), features.Periods(("2024-01-22", "2024-01-30"), ("2024-01-01", "2024-01-22")))
    counts = f.agg(*(F.count(c).alias(c) for c in _KEPT))
    return counts.select(F.inline(F.array(*(F.struct(F.lit(c).alias("feature"), F.col(c).alias("n")) for c in _KEPT))))


@query("fw10_predict_both", over("grid pivoted weather", """select station_id, hour_start, round(greatest(0, coalesce(p.temp_c, 0)), 6) as from_forecast, round(greatest(0, coalesce(w.temp_c, 0)), 6) as from_observed
    from grid join (select * from pivoted qualify row_number() over (partition by hour_start order by base_at desc) = 1) p using (hour_start) join weather w using (hour_start)"""))
def fw10(s, d):
    """Every hour's newest forecast swapped for the observed weather, under a model that answers with the temperature."""
    newest = marts.latest_per_key(weather.pivot_forecast(A.forecast(s, d)), ["hour_start"], [F.desc("base_at")])
    frame = A.grid(s, d).join(F.broadcast(newest.select("hour_start", "temp_c")), "hour_start")
    return r6(learn.predict_both(learn.Baseline("temp_c"), frame, ["temp_c"], A.weather(s, d), ["temp_c"]), "from_forecast", "from_observed")


@query("rb26_recomputed", over("grid cal dim", """select station_id, hour_start, round(coalesce(p.m, q.m)::float::double, 3) as predicted_rentals from dim
    cross join (select h as hour_start, hour(h)::int as hour_of_day, (h::date in (date '2024-01-01', date '2024-01-15') or isodow(h) >= 6) as is_offday from (select unnest(generate_series(timestamp '2024-01-25 11:00:00', timestamp '2024-01-27 10:00:00', interval 1 hour)) as h))
    left join (select station_id, is_offday, hour_of_day, avg(rentals) as m from grid join cal using (hour_start) where hour_start < '2024-01-22' group by all) p using (station_id, is_offday, hour_of_day)
    left join (select is_offday, hour_of_day, avg(rentals) as m from grid join cal using (hour_start) where hour_start < '2024-01-22' group by all) q using (is_offday, hour_of_day)"""))
def rb26(s, d):
    stations = A.stations(s, d)
    stats = features.history_stats(A.grid(s, d), A.full_calendar(s, d), stations, ("2024-01-01", "2024-01-22"))
    made = learn.recompute_predictions(learn.Baseline("b0"), ["b0"], stations, A.forecast(s, d), "2024-01-25 11:00:00", A.holidays(s, d), stats)
    return made.select("station_id", "hour_start", F.round("predicted_rentals", 3).alias("predicted_rentals"))


@query("mt08_list_precision", over("rows3", "select count(p) as issues, round(avg(p), 6) as precision, round(avg(empty), 6) as already_empty_share, round(avg(n), 6) as mean_list_length from (select as_of, avg(y) filter (where ok) as p, avg((b0 = 0)::int) filter (where ok) as empty, count(*) as n from (select * from rows3 where e - b0 > 0 qualify row_number() over (partition by as_of order by e - b0 desc, station_id) <= 10) group by 1)"))
def mt08(s, d):
    from ..operators.weather import top_lists

    m = main_rows(s, d).withColumn("gap", F.col("e") - F.col("b0"))
    return r6(metrics.list_precision(top_lists(m.where("gap > 0"), "as_of", "gap", "station_id", 10)), "precision", "already_empty_share", "mean_list_length")


@query("mt13_mt14_decision", over("scored", f"""with {_DRAWS},
    g as (select replicate, score, sum(y * times)::double as pos, sum((1 - y) * times)::double as neg from scored join times using (day) group by all),
    {_RANK.format(part='partition by replicate ')},
    ends as (select quantile_cont(2 * auc - 1, 0.025) as low, quantile_cont(2 * auc - 1, 0.975) as high from (select replicate, sum(neg * (pa + 0.5 * pos)) / (sum(pos) * sum(neg)) as auc from s group by 1)),
    pairs as (select sum((a.score > b.score)::int + 0.5 * (a.score = b.score)::int) / count(*) as auc from scored a join scored b on a.y = 1 and b.y = 0),
    first as (select *, case when low > 0 then 'length' when high < 0 then 'S1b' else 'S0' end as decision from ends cross join pairs)
    select decision, case when low > 0 and auc >= 1 - auc then 'N' else decision end as final, round(low, 6) as low, round(high, 6) as high, round(auc, 6) as auc from first""").replace("\nwith days as", ",\ndays as"))
def mt13(s, d):
    t = A.scored(s, d)
    both = t.withColumn("candidate", F.lit("length")).unionByName(t.withColumn("score", -F.col("score")).withColumn("candidate", F.lit("inverse")))
    table = metrics.candidate_report(both, "day", "inverse", 50).where("candidate = 'length'")
    first = metrics.decide(F.col("low"), F.col("high"), "length")
    final = metrics.decide_final(first, [F.col("low")], F.lit(0.1), F.lit(0.2), F.col("auc"), 1 - F.col("auc"), F.lit(12))
    return r6(table.select(first.alias("decision"), final.alias("final"), "low", "high", "auc"), "low", "high", "auc")


@query("mt15_horizon_report", over("scored", f"""with g as (select h, score, sum(y)::double as pos, sum(1 - y)::double as neg from scored cross join (select unnest(range(1, 7)) as h) where doc_id % 7 <> h group by all),
    {_RANK.format(part='partition by h ')}
    select h::int as horizon, sum(pos + neg)::bigint as rows, sum(pos)::bigint as positives, {_AUC} from s group by 1""").replace("\nwith g as", ",\ng as"))
def mt15(s, d):
    t = A.scored(s, d).withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(6)))).where("doc_id % 7 <> horizon")
    return r6(metrics.horizon_report(t, "score", "y"), "auc", "average_precision")


_REPORTED = ", ".join(f"round(avg({c}::int), 6) as {c}, round(avg({c}::int) filter (where y = 1), 6) as {c}_positives" for c in ("recovery", "recovery_after_zero", "pickup_before_zero"))


@query("rb10_relocation_report", f"select count(*) as rows, {_REPORTED} from ({ORACLE['rb09_relocation_events']}) ev join ({over('labels3', 'select as_of, station_id, y from labels3')}) l using (as_of, station_id)")
def rb10(s, d):
    snaps = A.snapshots(s, d)
    rows = sinks.kept(shortage.labels(A.issues(s, d).select("as_of"), snaps).select("as_of", "reference_at", "station_id", "y"))  # events and report read them
    return r6(shortage.relocation_report(shortage.relocation_events(rows, snaps), rows), *(f"{c}{p}" for c in ("recovery", "recovery_after_zero", "pickup_before_zero") for p in ("", "_positives")))


@query("st05_day_routing", over("snap", "select fetched_at::date::varchar as day, count(*) as n from snap group by 1"))
def st05(s, d):
    """The sink's writer, twice on the same rows: each lands once, in the folder of its day."""
    path = sinks.scratch_folder(s)
    rows, tasks = A.snapshots_by_day(s, d, sinks.ROWS_A_TASK // 2)  # a task holds its rows and the table's
    for _ in range(2):
        sinks.insert_ignore(path, rows, ["station_id", "fetched_at"], "day", ("station_id", "day"), tasks)
    return s.read.parquet(path).groupBy("day").agg(F.count("*").alias("n")).withColumn("day", F.col("day").cast("string"))


@query("st06_slot_coverage", over("snap", "select time_bucket(interval 10 minute, fetched_at) as slot_start, count(*) as rows, count(distinct station_id) as stations from snap group by 1"))
def st06(s, d):
    return streams.slot_coverage_batch(A.snapshots(s, d))


@query("st07_latest_state", over("snap", "select station_id, max(fetched_at) as fetched_at, arg_max(bike_count, fetched_at) as bike_count from snap where fetched_at >= timestamp '2024-01-30 23:00:00' group by 1"))
def st07(s, d):
    return pit.latest_state(A.snapshots(s, d), after=F.lit("2024-01-30 23:00:00").cast("timestamp_ntz"))


@query("st09_zero_alerts", over("win pred", "select p.as_of, p.station_id, min(fetched_at) as first_zero from (select distinct station_id, created_at as as_of from pred) p left join win w on p.as_of = w.as_of and p.station_id = w.station_id and w.bike_count = 0 group by all"))
def st09(s, d):
    rows = A.predictions(s, d).select(F.col("created_at").alias("as_of"), "station_id").distinct()
    return streams.zero_alerts_batch(rows, A.snapshots(s, d))


@query("so01_union_months", over("lgrid", "select month(hour_start)::int as month, sum(rentals)::bigint as rentals from lgrid where month(hour_start) in (1, 2) group by 1"))
def so01(s, d):
    g = A.levels_grid(s, d)
    jan, feb = g.where(F.month("hour_start") == 1), g.where(F.month("hour_start") == 2).select("rentals", "hour_start", "station_id")
    return jan.unionByName(feb).groupBy(F.month("hour_start").alias("month")).agg(F.sum("rentals").alias("rentals"))


@query("fe07_active_only", over("grid cal", "select station_id, count(*) as n from grid join cal using (hour_start) where hour_start >= '2024-01-29' and hour_start < '2024-01-30' and station_id in (select station_id from grid where hour_start >= '2024-01-29' and hour_start < '2024-01-30' group by 1 having sum(rentals) > 0) group by 1"))
def fe07(s, d):
    f = features.feature_frame(A.grid(s, d), A.full_calendar(s, d), A.stations(s, d), features.Periods(("2024-01-29", "2024-01-30"), ("2024-01-01", "2024-01-22")), active_only=True, levels=True, snapshots=A.snapshots_of_stations(s, d))
    return f.groupBy("station_id").agg(F.count("*").alias("n"))


@query("ml07_training_window", over("lgrid", "select strftime(date_trunc('month', max(hour_start)), '%Y-%m-01') as history_end from lgrid"))
def ml07(s, d):
    g = A.levels_grid(s, d)
    return s.createDataFrame([(learn.training_window(g, "1992-01-01")[1],)], "history_end string")


@query("dm09_latest_snapshot", over("snaps_st", "select station_no, max(snapshot) as snapshot from snaps_st group by 1"))
def dm09(s, d):
    return marts.latest_per_key(A.snapshots_of_stations(s, d), ["station_no"], [F.desc("snapshot")]).select("station_no", "snapshot")


@query("rb11_horizons", over("labels3 pred", """select l.as_of, l.station_id, h::int as horizon, case when count(p.predicted_rentals) = count(*) then round(sum(p.predicted_rentals * w), 6) end as predicted_rentals from labels3 l
    join (select as_of, h, k, date_trunc('hour', as_of)::timestamp + to_hours(k) as hour_start, greatest(0, least(1, least(k + 1, f + h) - greatest(k, f)))::double as w from (select as_of, minute(as_of) / 60.0::double as f from issues) cross join (select unnest(range(1, 7))::int as h) cross join (select unnest(range(0, 7))::int as k)) x using (as_of)
    left join pred p on p.station_id = l.station_id and p.hour_start = x.hour_start and p.created_at = l.as_of where w > 0 group by all"""))
def rb11(s, d):
    p = A.predictions(s, d).select("station_id", "hour_start", F.col("created_at").alias("as_of"), "predicted_rentals")
    return r6(shortage.horizon_inputs(shortage.labels(A.issues(s, d).select("as_of"), A.snapshots(s, d)), p, "predicted_rentals"), "predicted_rentals")


@query("rb21_issue_log", over("rows3 status", "select s.as_of, s.reference_at, s.slots, s.status, coalesce(n, 0) as rows, coalesce(m, 0) as main_rows from status s left join (select as_of, count(*) as n, count(*) filter (where b0 >= 1 and ok and e is not null and r is not null and q is not null) as m from rows3 group by 1) using (as_of)"))
def rb21(s, d):
    return shortage.issue_log(main_rows(s, d), shortage.issue_status(A.issues(s, d).select("as_of"), A.snapshots(s, d)))


@query("mt17_full_report", over("rows3", f"""with m as (select *, e - b0 as score from rows3 where {_MAIN}), strata as (select *, unnest(case when b0 >= 3 then ['all', 'b0>=2', 'b0>=3'] when b0 >= 2 then ['all', 'b0>=2'] else ['all'] end) as grp from m),
    g as (select grp, score, sum(y)::double as pos, sum(1 - y)::double as neg from strata group by all),
    {_RANK.format(part='partition by grp ')}, ranks as (select grp, {_AUC} from s group by 1)
    select 'rows' as metric, 'all' as grp, count(*)::double as value from m union all select 'issues', 'all', count(distinct as_of) from m union all select 'positive_rate', 'all', round(avg(y), 6) from m
    union all select 'rows', grp, count(*) from strata where grp <> 'all' group by 2 union all select 'auc', grp, auc from ranks union all select 'average_precision', grp, average_precision from ranks""").replace("\nwith m as", ",\nm as"))
def mt17(s, d):
    return metrics.full_report(main_rows(s, d)).withColumn("value", F.round("value", 6))


# --- files that are written and read back -----------------------------------------------------------------------------------


_HEADERS = {f"column {i}": c for i, c in enumerate(readers.TRIP_COLUMNS)}


@query("sr01_03_trip_csv", "select 'trips_24' || right('0' || (1 + event_id % 3), 2) || '.csv' as source_file, '2024-' || right('0' || (1 + event_id % 3), 2) as month, count(*) as n, count(*) filter (where event_type <> 'error') as returned, count(distinct user_id) as bikes from events group by all")
def sr01(s, d):
    """Trips of three months as CSV files with other header names, one column missing, and the reader over them. A file is a folder here, as Spark
    writes them, so its own name stands in for the file's."""
    path, t = sinks.scratch_folder(s), A.table(s, d, "events")
    out = []
    for m in ("01", "02", "03"):
        rows = t.where(1 + F.col("event_id") % 3 == int(m))
        columns = {"bike_no": F.concat(F.lit("B"), "user_id"), "rented_at": F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), "return_station_no": F.when(F.col("event_type") == "error", "\\N").otherwise(F.col("event_id").cast("string"))}
        file = rows.select(*(columns.get(c, F.lit("")).alias(h) for h, c in _HEADERS.items() if c not in readers.OPTIONAL_COLUMNS))
        sinks.write_csv_file(file, f"{path}/trips_24{m}.csv")
        out.append(readers.read_trip_csv(s, [f"{path}/trips_24{m}.csv"], _HEADERS, encoding="UTF-8", named=f"trips_24{m}.csv"))
    return out[0].unionByName(out[1]).unionByName(out[2]).groupBy("source_file", "month").agg(F.count("*").alias("n"), F.count("return_station_no").alias("returned"), F.countDistinct("bike_no").alias("bikes"))


@query("sr06_sr17_month_partitions", f"select month, count(*) as n, sum(case when month = '2005-03' then -1 else o_orderkey end)::bigint as keys from {_FILES} where month in ('2005-02', '2005-03', '2005-04') group by 1")
def sr06(s, d):
    """Partitions by month; one of them is written again, and three are scanned."""
    path, f = sinks.scratch_folder(s), files(s, d)
    sinks.write_month_partition(f.select("o_orderkey", "month"), path)
    sinks.write_month_partition(f.where("month = '2005-03'").select(F.lit(-1).cast("long").alias("o_orderkey"), "month"), path)
    return readers.scan_months(s, path, ["2005-02", "2005-03", "2005-04"]).groupBy("month").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


@query("sr08_station_sheets", over("snaps_st", "select snapshot, count(*) as n, count(district) as districts, sum(docks)::bigint as docks from snaps_st where snapshot < '2020' group by 1"))
def sr08(s, d):
    """A sheet for each half-year with its header rows; files are named by half-year."""
    path, st = sinks.scratch_folder(s), A.snapshots_of_stations(s, d)
    blank = [F.lit("").alias(c) for c in readers.STATION_COLUMNS]
    head = s.range(3).select("id", *(F.when(F.col("id") == 1, c).otherwise("title" if c == "station_no" else "").alias(c) for c in readers.STATION_COLUMNS)).drop("id")
    values = {"station_no": F.concat(F.lit(" "), "station_no"), "district": F.coalesce("district", F.lit(" ")), "lcd_docks": F.col("docks").cast("string")}
    for r in st.select("snapshot").distinct().where("snapshot < '2020'").collect():  # half-years are few
        rows = st.where(F.col("snapshot") == r[0]).select(*(values.get(c, b).alias(c) for c, b in zip(readers.STATION_COLUMNS, blank, strict=True)))
        sinks.write_csv_file(head.union(rows), f"{path}/stations_{r[0]}.csv", header=False)
    got = readers.read_station_snapshots(s, f"{path}/*.csv")
    return got.groupBy("snapshot").agg(F.count("*").alias("n"), F.count("district").alias("districts"), F.sum(F.col("lcd_docks").cast("int")).alias("docks"))


_OBSERVATIONS = {"tm": "observed_at", "ta": "temp_c", "rn": "rain_mm"}


@query("sr09_observations_json", over("obs0", "select count(*) as n, count(rain_mm) as rainy, sum(floor(temp_c))::bigint as temp_c from obs0"))
def sr09(s, d):
    path, o = sinks.scratch_folder(s), A.observations(s, d).where("observed_at < timestamp_ntz'2024-02-01'")
    text = {"tm": F.col("observed_at").cast("string"), "ta": F.floor("temp_c").cast("string"), "rn": F.coalesce(F.col("rain_mm").cast("string"), F.lit(""))}
    month = F.to_json(F.collect_list(F.struct(*(c.alias(n) for n, c in text.items()))))  # a month's file is one array of hours
    o.groupBy(F.date_trunc("month", "observed_at")).agg(month.alias("value")).select("value").write.text(path)
    got = readers.read_observations_json(s, path, _OBSERVATIONS)
    return got.agg(F.count("*").alias("n"), F.count("rain_mm").alias("rainy"), F.sum(F.col("temp_c").cast("long")).alias("temp_c"))


def _payloads(s: SparkSession, d: str) -> DataFrame:
    """A landed payload for each time of two hours a day: its stations, and two pages with their totals; one time an hour repeats a station, one has a short page."""
    snap = A.snapshots(s, d).where("hour(fetched_at) in (3, 9)")
    fields = {"rackTotCnt": F.lit("10"), "stationName": F.col("station_id"), "parkingBikeTotCnt": F.col("bike_count").cast("string"), "shared": F.lit(""), "stationLatitude": F.lit("37"), "stationLongitude": F.lit("127"), "stationId": F.col("station_id")}
    rows = snap.groupBy("fetched_at").agg(F.collect_list(F.struct(*(c.alias(n) for n, c in fields.items()))).alias("r"))
    rows = rows.withColumn("r", F.when(F.minute("fetched_at") == 50, F.concat("r", F.slice("r", 1, 1))).otherwise(F.col("r")))
    n = F.size("r")
    return rows.select(F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss").alias("fetched_at"), F.struct(F.col("r").alias("row")).alias("rentBikeStatus"), F.array(F.struct(n.alias("total"), F.when(F.minute("fetched_at") == 20, n - 1).otherwise(n).alias("rows")), F.struct(n.alias("total"), F.lit(0).alias("rows"))).alias("pages"))


@query("sr11_snapshot_json", over("snap", "select strftime(fetched_at, '%Y-%m-%d %H:%M:%S') as fetched_at, count(*) + (minute(fetched_at) = 50)::int as n, count(distinct station_id) as stations, 0::bigint as shared from snap where hour(fetched_at) in (3, 9) group by 1, fetched_at"))
def sr11(s, d):
    path = sinks.scratch_folder(s)
    _payloads(s, d).write.json(path)
    return readers.snapshot_rows(s.read.schema(readers.SNAPSHOT_SCHEMA).json(path)).groupBy("fetched_at").agg(F.count("*").alias("n"), F.countDistinct("station_id").alias("stations"), F.count("shared").alias("shared"))


@query("sr12_snapshot_pages", over("snap", """select strftime(fetched_at, '%Y-%m-%d %H:%M:%S') as fetched_at from (select fetched_at, count(*) + (minute(fetched_at) = 50)::int as n, minute(fetched_at) as m from snap where hour(fetched_at) in (3, 9) group by fetched_at)
    where n - (m = 20)::int > 1000 or n - (m = 20)::int < least(1000, n) or m = 50"""))
def sr12(s, d):
    return readers.snapshot_page_faults(_payloads(s, d)).select("fetched_at")


def _issue_files(s: SparkSession, d: str) -> DataFrame:
    """A landed file for each issue: two pages of items; one in five says another total on its second page."""
    text = lambda c: F.date_format(c, "yyyyMMdd"), lambda c: F.date_format(c, "HHmm")
    item = {"baseDate": text[0]("base_at"), "baseTime": text[1]("base_at"), "fcstDate": text[0]("target_at"), "fcstTime": text[1]("target_at"), "category": F.col("category"), "fcstValue": F.col("value"), "nx": F.lit(60), "ny": F.lit(127)}
    f = A.forecast(s, d).groupBy("base_at", (F.unix_seconds(F.col("target_at").cast("timestamp")) % 2).alias("odd"), (F.hour("target_at") % 2).alias("page")).agg(F.collect_list(F.struct(*(c.alias(n) for n, c in item.items()))).alias("items"))
    total = F.lit(288) + F.when((F.hour("base_at") == 11) & (F.col("page") == 1), 1).otherwise(0)
    pages = f.groupBy("base_at").agg(F.collect_list(F.struct(total.alias("total"), "items")).alias("pages"))
    return pages.select(F.date_format("base_at", "yyyy-MM-dd HH:mm").alias("base_at"), F.lit(60).alias("nx"), F.lit(127).alias("ny"), F.date_format("base_at", "yyyy-MM-dd HH:mm").alias("fetched_at"), "pages")


@query("sr13_sr23_forecasts", over("forecast", "select base_at, category, count(*) as n, min(target_at) as first_target, max(value) as top from forecast group by all"))
def sr13(s, d):
    """Issue files read, and loaded twice: the second load adds nothing."""
    path, target = sinks.scratch_folder(s), sinks.scratch_folder(s)
    _issue_files(s, d).write.json(path)
    for _ in range(2):
        sinks.load_forecasts(target, readers.forecast_rows(s.read.schema(readers.FORECAST_SCHEMA).json(path)))
    return s.read.parquet(target).groupBy("base_at", "category").agg(F.count("*").alias("n"), F.min("target_at").alias("first_target"), F.max("value").alias("top"))


@query("sr14_forecast_pages", over("issues", "select strftime(base_at, '%Y-%m-%d %H:%M') as base_at from issues where hour(base_at) = 11"))
def sr14(s, d):
    return readers.forecast_page_faults(_issue_files(s, d)).select("base_at")


@query("sr25_sr26_artifacts", over("rq", "select count(*) as n, round(sum(rent_mean), 6) as rent_mean, 0::bigint as optional from rq"))
def sr25(s, d):
    path = sinks.scratch_folder(s)
    sinks.write_artifacts({"profile": features.season_profile(A.hourly(s, d), A.grid(s, d), A.calendar(s, d), "2024-01-01", "2024-02-01")}, path)
    got = sinks.read_artifacts(s, path, ["profile"], {"levels": "station_id string, level double"})
    return r6(got["profile"].agg(F.count("*").alias("n"), F.sum("rent_mean").alias("rent_mean"), F.lit(got["levels"].count()).cast("long").alias("optional")), "rent_mean")


@query("sr28_generations", "select 'second' as generation, count(*) as n from events where event_type = 'click'")
def sr28(s, d):
    """Two generations of a table; readers see the one that was published last."""
    path, e = sinks.scratch_folder(s), A.table(s, d, "events")
    sinks.publish_generation({"events": e}, path, "first")
    sinks.publish_generation({"events": e.where("event_type = 'click'")}, path, "second")
    now = sinks.current_generation(s, path)
    return s.read.parquet(f"{path}/generation={now}/events").agg(F.lit(now).alias("generation"), F.count("*").alias("n"))


@query("sr29_report_rows", over("rows3", f"select 'rows' as metric, 'b0=' || b0 as grp, count(*)::double as value from rows3 where {_MAIN} group by 2"))
def sr29(s, d):
    path = sinks.scratch_folder(s)
    rows = main_rows(s, d).where("reason = 'main'").groupBy("b0").agg(F.count("*").cast("double").alias("value"))
    sinks.write_report(rows.select(F.lit("rows").alias("metric"), F.concat(F.lit("b0="), "b0").alias("group"), "value"), path)
    return s.read.schema("metric string, `group` string, value double").json(path).withColumnRenamed("group", "grp")
