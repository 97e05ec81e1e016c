"""DuckDB SQL of the adapter views, written independently of the DataFrame code, and a helper that puts a query on top."""

from __future__ import annotations

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "trips0": ((), """select event_id, 'B' || user_id as bike_no, ts as rented_at, ts + to_minutes(floor(value)::int) as returned_at, user_id::int as rent_station_no,
        case when event_type = 'error' then null when event_id % 5 = 0 then user_id::int else (user_id + event_id % 7)::int end as return_station_no,
        floor(value / 10)::int as duration_min, value * 10 as distance_m from events"""),
    "trips": (("trips0",), """select * exclude (event_id), 'ST-' || rent_station_no as rent_station_id, 'ST-' || return_station_no as return_station_id from (select * from trips0 union all select * from trips0 where event_id % 97 = 0)"""),
    "staged": (("trips",), """select *, coalesce(duration_min = 0 and rent_station_id = return_station_id, false) as is_cancelled from (select distinct on (bike_no, rented_at, rent_station_id, returned_at, return_station_id) * from trips)"""),
    "cal": ((), """select h as hour_start, h::date as date, hour(h)::int as hour_of_day, isodow(h)::int as day_of_week, month(h)::int as month, dayofyear(h)::int as day_of_year,
        h::date in (date '2024-01-01', date '2024-01-15') as is_holiday, (h::date in (date '2024-01-01', date '2024-01-15') or isodow(h) >= 6) as is_offday
        from (select unnest(generate_series((select date_trunc('day', min(ts)) from events), timestamp '2024-01-30 23:00:00', interval 1 hour)) as h)"""),
    "obs0": ((), """select date_trunc('hour', ts) as observed_at, avg(value) as temp_c, max(value) / 10 as wind_ms, min(value) as humidity_pct,
        case when hour(date_trunc('hour', ts)) % 3 = 0 then sum(value) filter (where event_type = 'error') / 100 end as rain_mm,
        case when hour(date_trunc('hour', ts)) % 3 = 0 and count(*) filter (where event_type = 'signup') > 4 then 0.3::double end as new_snow_3h_cm from events group by 1"""),
    "obs": (("obs0",), "select * from obs0 union all select observed_at + to_hours(170 * 24), temp_c, wind_ms, humidity_pct, rain_mm, new_snow_3h_cm from obs0"),
    "weather": (("obs",), """select h.observed_at - interval 1 hour as hour_start, h.observed_at, h.temp_c, h.wind_ms, h.humidity_pct,
        case when month(h.observed_at) in (11, 12, 1, 2, 3) then coalesce(c.rain_mm, 0) / 3 else coalesce(h.rain_mm, 0) end as rain_mm, coalesce(h.rain_mm, 0) as rain_mm_reported, coalesce(c.new_snow_3h_cm, 0) > 0 as is_new_snow
        from obs h left join obs c on c.observed_at = h.observed_at + to_hours(((3 - hour(h.observed_at) % 3) % 3)::int)"""),
    "fullcal": (("cal", "weather"), "select c.*, w.temp_c, w.wind_ms, w.humidity_pct, w.rain_mm, w.is_new_snow from cal c left join weather w using (hour_start)"),
    "snaps_st": ((), """select station_no, printf('%04d-%02d', y, m) as snapshot, (10 + (station_no * 7 + k) % 11)::int as docks, case when station_no % 11 <> 0 then 'D' || ((station_no + k) % 6) end as district, 37 + station_no / 100 as lat, 127 - station_no / 100 as lon
        from (select distinct user_id::int as station_no from events) cross join (select y, m, y * 12 + m - 1 as k from (select distinct year(o_orderdate) as y from orders) cross join (values (6), (12)) t(m) union all select 2023, 6, 2023 * 12 + 5 union all select 2023, 12, 2023 * 12 + 11)
        where (station_no + k) % 5 <> 0"""),
    "moves": (("staged",), """select rent_station_id as station_id, rent_station_no as station_no, rented_at as t, 1 as leaves, 0 as arrives, is_cancelled from staged
        union all select return_station_id, return_station_no, returned_at, 0, 1, is_cancelled from staged where return_station_id is not null"""),
    "dim": (("moves", "snaps_st"), """select station_id, station_no, district, docks, lat, lon, first_rented_at, last_rented_at, total_rentals, total_returns from (
          select station_id, any_value(station_no) as station_no, min(if(leaves = 1, t, null)) as first_rented_at, max(if(leaves = 1, t, null)) as last_rented_at, sum(if(is_cancelled, 0, leaves))::bigint as total_rentals, sum(if(is_cancelled, 0, arrives))::bigint as total_returns from moves group by station_id)
        left join (select station_no, max(snapshot) as snapshot from snaps_st group by station_no) using (station_no) left join snaps_st using (station_no, snapshot)"""),
    "hourly": (("moves",), "select station_id, time_bucket(interval 1 hour, t) as hour_start, sum(leaves)::bigint as rentals, sum(arrives)::bigint as returns from moves where not is_cancelled group by all"),
    "spans": (("hourly", "dim"), """select station_id, date_trunc('day', min(hour_start))::timestamp as first_day, date_trunc('day', max(hour_start))::timestamp as last_day from hourly where station_id in (select station_id from dim where total_rentals > 0) and hour_start < timestamp '2024-01-31' group by 1"""),
    "grid": (("hourly", "spans"), """select g.station_id, g.hour_start, coalesce(h.rentals, 0)::int as rentals from (select station_id, unnest(generate_series(first_day, last_day + interval 23 hour, interval 1 hour)) as hour_start from spans) g left join hourly h using (station_id, hour_start)"""),
    "lgrid": ((), "select 'ST-' || (o_custkey % 20) as station_id, o_orderdate::timestamp as hour_start, count(*)::int as rentals from orders group by all"),
    "halves": (("lgrid",), "select station_id, ((year(hour_start) * 12 + month(hour_start) - 1) // 6)::int as half, avg(rentals) as half_mean, sum(rentals)::bigint as half_sum from lgrid group by all"),
    "issues": ((), """select day + to_hours(h) as base_at, day + to_hours(h) + interval 15 minute as as_of from (select distinct date_trunc('day', ts)::timestamp as day from events) cross join (select unnest([2, 5, 8, 11, 14, 17, 20, 23]) as h)"""),
    "forecast0": (("issues",), "select base_at, k, base_at + to_hours(k) as target_at, c, ['TMP', 'PCP', 'WSD', 'REH', 'SNO', 'POP'][c + 1] as category, (k * 7 + hour(base_at + to_hours(k)) + c) % 6 as n, (k * 5 + hour(base_at + to_hours(k))) % 23 as num from issues cross join (select unnest(range(1, 49))::int as k) cross join (select unnest(range(0, 6))::int as c)"),
    "forecast": (("forecast0",), """select base_at, target_at, category, case when category in ('PCP', 'SNO') then case n when 0 then 'none' when 1 then 'under 1mm' when 2 then num || 'mm~' || (num + 4) || 'mm' when 3 then num || 'mm or more' when 4 then num || 'mm' else 'unknown word' end
        else case when n = 5 then '?' else (num - 5) || '.5' end end as value from forecast0"""),
    "pivoted": (("forecast0",), """select base_at, target_at - interval 1 hour as hour_start, max(case when category = 'TMP' then num_v end) as temp_c, max(case when category = 'PCP' then amt end) as rain_mm, max(case when category = 'WSD' then num_v end) as wind_ms, max(case when category = 'REH' then num_v end) as humidity_pct, max(case when category = 'SNO' then (amt > 0)::int end) as is_snow
        from (select *, case when n = 5 then null else ((num - 5) || '.5')::double end as num_v, case n when 0 then 0.0 when 1 then 0.5 when 2 then num + 2.0 when 3 then num::double when 4 then num::double end::double as amt from forecast0) group by all"""),
    "sdays": ((), "select distinct user_id::int as s, date_trunc('day', ts)::timestamp as day from events"),
    "snap": (("sdays",), """select 'ST-' || s as station_id, t as fetched_at, ((s * 7 + (epoch(t)::bigint // 600) * 3 + (epoch(t)::bigint // 7200) * s) % 9)::int as bike_count from (select s, unnest(generate_series(day, day + interval 1430 minute, interval 10 minute)) as t from sdays) where (s * 31 + epoch(t)::bigint // 600) % 53 <> 0"""),
    "pred": (("issues", "sdays"), """select 'ST-' || s as station_id, base_at + to_hours(k) as hour_start, 'm1-fcst' || strftime(base_at, '%Y%m%d%H%M') as model_version, ((s * 5 + hour(base_at + to_hours(k)) * 3 + epoch(base_at)::bigint // 10800) % 17) / 4.0::double as predicted_rentals, as_of as created_at
        from (select s, base_at, as_of from issues join sdays on sdays.day = date_trunc('day', base_at)) cross join (select unnest(range(0, 8))::int as k) where (s + hour(base_at + to_hours(k))) % 41 <> 0"""),
    "scored": ((), "select doc_id, quality as y, floor(n_chars / 100)::double as score, source as day, lang as stratum, least(n_chars / 8000.0::double, 1.0::double) as p from labels join documents using (doc_id)"),
    "ref": (("issues", "snap"), "select as_of, (select max(fetched_at) from snap where fetched_at <= as_of and fetched_at >= as_of - interval 30 minute) as reference_at from issues"),
    "win": (("issues", "snap"), "select as_of, s.* from issues join snap s on fetched_at > as_of and fetched_at <= as_of + interval 3 hour"),
    "status": (("ref", "win"), "select r.as_of, r.reference_at, coalesce(n, 0) as slots, case when reference_at is null then 'no_reference' when coalesce(n, 0) < 15 then 'sparse' else 'ok' end as status from ref r left join (select as_of, count(distinct epoch(fetched_at)::bigint // 600) as n from win group by 1) w using (as_of)"),
    "labels3": (("status", "win", "snap"), """select t.as_of, t.reference_at, s.station_id, s.bike_count as b0, coalesce(hit, 0) as y, coalesce(back, 0) > 0 as recovered, coalesce(n, 0) >= 15 and t.slots >= 15 as ok
        from status t join snap s on s.fetched_at = t.reference_at left join (select as_of, station_id, count(distinct epoch(fetched_at)::bigint // 600) as n, max((bike_count = 0)::int) as hit, max((bike_count >= 1)::int) as back from win group by all) w on w.as_of = t.as_of and w.station_id = s.station_id where t.reference_at is not null"""),
    "hours3": (("issues",), """select as_of, k, date_trunc('hour', as_of)::timestamp + to_hours(k) as hour_start, greatest(0, least(1, least(k + 1, f + 3) - greatest(k, f)))::double as weight from (select as_of, minute(as_of) / 60.0::double as f from issues) cross join (select unnest(range(0, 4))::int as k) where greatest(0, least(1, least(k + 1, f + 3) - greatest(k, f))) > 0"""),
    "best": (("pred",), "select * from pred qualify row_number() over (partition by station_id, hour_start order by model_version desc) = 1"),
    "e3": (("labels3", "hours3", "pred"), """select l.*, e from labels3 l join (select l.as_of, l.station_id, case when count(predicted_rentals) = count(*) then sum(predicted_rentals * weight) end as e from labels3 l join hours3 h using (as_of) left join pred p on p.station_id = l.station_id and p.hour_start = h.hour_start and p.created_at = l.as_of group by all) using (as_of, station_id)"""),
    "rq": (("hourly", "grid", "cal"), "select g.station_id, c.is_offday, c.hour_of_day, sum(g.rentals) / count(*) as rent_mean, sum(coalesce(h.returns, 0)) / count(*) as return_mean from grid g join cal c using (hour_start) left join hourly h using (station_id, hour_start) group by all"),
    "rows3": (("e3", "hours3", "rq", "cal"), """select e.*, r, q from e3 e join (select e.as_of, e.station_id, case when count(rent_mean) = count(*) then sum(rent_mean * weight) end as r, case when count(return_mean) = count(*) then sum(return_mean * weight) end as q from e3 e join hours3 h using (as_of) left join cal c using (hour_start) left join rq p on p.station_id = e.station_id and p.is_offday = c.is_offday and p.hour_of_day = c.hour_of_day group by all) using (as_of, station_id)"""),
}


def over(names: str, body: str) -> str:
    """``body`` with the named views (and what they need) in front."""
    order: list[str] = []

    def need(n: str) -> None:
        for m in CTES[n][0]:
            need(m)
        if n not in order:
            order.append(n)

    for n in names.split():
        need(n)
    return ("with " + ",\n".join(f"{n} as materialized ({CTES[n][1]})" for n in order) + "\n" if order else "") + body
