"""The checked queries in SQL, for DuckDB over the driver's tables."""

from __future__ import annotations

from registry.tables import PARTS, QUAKES_SQL

_CLEAN = """
select epoch_ms(date_trunc('milliseconds', date)) as time, place, event_type as status, tsunami,
  significance, magnitude, state, longitude, latitude, depth, date
from quakes
"""


def _running_window() -> str:
    return "over (partition by state order by depth nulls first range unbounded preceding)"


def _shocks(kind: str, largest: bool) -> str:
    """Pairs of a main event and a weaker one within five hours, after or before it."""
    gap = "epoch(o.date)" if kind == "aftershock" else "epoch(m.date)"
    base = "epoch(m.date)" if kind == "aftershock" else "epoch(o.date)"
    elapsed = f"cast(floor({gap}) as bigint) - cast(floor({base}) as bigint)"
    keep = "where other_magnitude = top" if largest else ""
    return f"""
    , pairs as (
      select m.place as place_main, o.place as place_other, m.date as date_main,
        o.date as date_other, m.magnitude as main_magnitude, o.magnitude as other_magnitude,
        max(o.magnitude) over (partition by m.date, m.magnitude, m.place) as top
      from quakes m join quakes o
        on m.latitude - o.latitude between -0.1 and 0.1
        and m.longitude - o.longitude between -0.1 and 0.1
        and {elapsed} > 0 and {elapsed} <= 18000
      where m.magnitude >= 8 and o.magnitude < 8
    )
    select distinct place_main, place_other as place_{kind}, date_main,
      date_other as date_{kind}, main_magnitude, other_magnitude as {kind}_magnitude
    from pairs {keep}
    """


def _window(minutes: int, aggregate: str, condition: str = "true") -> str:
    start = f"time_bucket(interval '{minutes} minutes', time, timestamp '1970-01-01')"
    return f"""
    select {start} as start, {start} + interval '{minutes} minutes' as "end", {aggregate}
    from messages where time is not null and {condition} group by 1, 2
    """


def _slices(minutes: int) -> str:
    return f"""
    select event_id, cast(floor((floor(epoch(date)) - epoch(timestamp '2024-01-01'))
      / ({minutes} * 60)) as bigint) as slice_id
    from quakes where date >= timestamp '2024-01-01'
    """


_FLATTENED = """
select longitude, latitude, d.depth, place as location, magnitude, epoch_ms(date_trunc('milliseconds', ts)) as time,
  cast(tsunami as varchar) as tsunami, event_type as status
from (select *, unnest([depth, null]) as other_depth from quakes) q,
  lateral (select q.other_depth as depth) d
"""


_AFTER_CTE: dict[str, str] = {
    "preprocess_quakes": _CLEAN,
    "tsunami_by_significance": """
    select date, place, state, tsunami, significance, magnitude, latitude, longitude, depth,
      event_id
    from quakes where tsunami <> 0 order by significance desc
    """,
    "average_magnitude": "select avg(magnitude) as average_magnitude from quakes",
    "state_frequency": """
    select state, count(*) as total_occurrences,
      count(*) / nullif(date_diff('day', min(date), max(date)), 0) as frequency_per_day,
      avg(magnitude) as average_magnitude
    from quakes where state is not null
    group by state order by total_occurrences desc, state limit 50
    """,
    "depth_running": f"""
    select state, total_occurrences, average_depth, min_depth, round(max_depth) as max_depth
    from (select distinct state,
        count(*) {_running_window()} as total_occurrences,
        avg(depth) {_running_window()} as average_depth,
        min(depth) {_running_window()} as min_depth,
        max(depth) {_running_window()} as max_depth
      from quakes) t
    """,
    "depth_per_state": """
    select state, count(*) as total_occurrences, avg(depth) as average_depth,
      min(depth) as min_depth, round(max(depth)) as max_depth
    from quakes group by state
    """,
    "ratio_gt3_per_state": """
    select state, count(*) as total_quakes,
      cast(sum(case when magnitude > 3 then 1 else 0 end) as bigint) as quakes_gt_3,
      sum(case when magnitude > 3 then 1 else 0 end) / count(*) as ratio_gt_3
    from quakes group by state
    """,
    "yearly_tsunami_share": """
    select cast(year(date) as int) as year, count(*) as total_quakes,
      cast(sum(case when tsunami = 1 then 1 else 0 end) as bigint) as quakes_with_tsunami,
      sum(case when tsunami = 1 then 1 else 0 end) / count(*) * 100 as percentage_with_tsunami
    from quakes group by 1
    """,
    "hemisphere_monthly": """
    select cast(month(date) as int) as month,
      case when latitude >= 0 then 'North' else 'South' end as hemisphere,
      avg(magnitude) as average_magnitude, max(magnitude) as max_magnitude,
      cast(sum(case when magnitude > 6 then 1 else 0 end) as bigint) as count_gt_6_magnitude
    from quakes group by 1, 2
    """,
    "event_pairs": """
    select distinct
      case when a.date < b.date then a.place else b.place end as place1,
      case when a.date < b.date then b.place else a.place end as place2,
      least(a.date, b.date) as date1, greatest(a.date, b.date) as date2,
      case when a.date < b.date then a.magnitude else b.magnitude end as magnitude1,
      case when a.date < b.date then b.magnitude else a.magnitude end as magnitude2
    from quakes a join quakes b
      on a.latitude - b.latitude between -0.1 and 0.1
      and a.longitude - b.longitude between -0.1 and 0.1
      and a.date <> b.date
      and abs(cast(floor(epoch(a.date)) as bigint) - cast(floor(epoch(b.date)) as bigint)) <= 900
    where year(a.date) = 2024 and month(a.date) = 1
    """,
    "event_pairs_stored_date": """
    select distinct
      case when a.ts < b.ts then a.place else b.place end as place1,
      case when a.ts < b.ts then b.place else a.place end as place2,
      least(a.ts, b.ts) as date1, greatest(a.ts, b.ts) as date2,
      case when a.ts < b.ts then a.magnitude else b.magnitude end as magnitude1,
      case when a.ts < b.ts then b.magnitude else a.magnitude end as magnitude2
    from quakes a join quakes b
      on a.latitude - b.latitude between -0.1 and 0.1
      and a.longitude - b.longitude between -0.1 and 0.1
      and a.ts <> b.ts
      and abs(cast(floor(epoch(a.ts)) as bigint) - cast(floor(epoch(b.ts)) as bigint)) <= 900
    where year(a.ts) = 2024 and month(a.ts) = 1
    """,
    "equator_monthly_average": """
    select state, cast(sum(n) as bigint) as total_occurrences,
      sum(n) / 12 as average_occurrences_per_month
    from (select month(date) as month, state, count(*) as n from quakes
      where latitude >= -5 and latitude <= 5 group by 1, 2) t
    group by state
    """,
    "events_on_day": """
    select latitude, longitude, depth, magnitude from quakes
    where year(date) = 2024 and month(date) = 1 and day(date) = 2
    """,
    "events_on_stored_day": """
    select latitude, longitude, depth, magnitude from quakes
    where year(ts) = 2024 and month(ts) = 1 and day(ts) = 2
    """,
    "largest_aftershock": _shocks("aftershock", largest=True),
    "foreshock_pairs": _shocks("foreshock", largest=False),
    "largest_foreshock": _shocks("foreshock", largest=True),
    "proximity_join": """
    select a.event_id as event_id_left, b.event_id as event_id_right
    from quakes a join quakes b
      on a.latitude - b.latitude between -0.1 and 0.1
      and a.longitude - b.longitude between -0.1 and 0.1
      and a.date <> b.date
      and abs(cast(floor(epoch(a.date)) as bigint) - cast(floor(epoch(b.date)) as bigint)) <= 900
    """,
    "proximity_join_float": """
    select a.event_id as event_id_left, b.event_id as event_id_right
    from float_quakes a join float_quakes b
      on cast(a.latitude - b.latitude as double) between -0.1::double and 0.1::double
      and cast(a.longitude - b.longitude as double) between -0.1::double and 0.1::double
      and a.date <> b.date
      and abs(cast(floor(epoch(a.date)) as bigint) - cast(floor(epoch(b.date)) as bigint)) <= 900
    """,
    "read_quakes_csv": """
    select epoch_ms(date_trunc('milliseconds', date)) as time, place, event_type as status, cast(tsunami as float) as tsunami,
      significance, cast(magnitude as float) as magnitude, state,
      cast(longitude as float) as longitude, cast(latitude as float) as latitude,
      cast(depth as float) as depth, date
    from quakes
    """,
    "read_table": _CLEAN,
    "sql_over_table": """
    select state, count(*) as total_occurrences, avg(magnitude) as average_magnitude
    from quakes where tsunami <> 0 and state is not null group by state
    """,
    "flatten_geojson": _FLATTENED,
    "read_geojson_features": _FLATTENED,
    "replay_slices_15": _slices(15),
    "replay_slices_300": _slices(300),
    "parse_quakes": "select * from messages",
    "stream_all": "select * from messages",
    "stream_avg_magnitude": _window(30, "avg(magnitude) as avg_magnitude"),
    "stream_count_gt3": _window(60, "count(*) as num_quakes_mag_gt3", "magnitude > 3.0"),
    "stream_count_gt3_in_order": _window(
        60, "count(*) as num_quakes_mag_gt3", "magnitude > 3.0"
    ),
    "stream_count_gt3_compacted": _window(
        60, "count(*) as num_quakes_mag_gt3", "magnitude > 3.0"
    ),
    "stream_count_gt3_late_merged": _window(
        60, "count(*) as num_quakes_mag_gt3", "magnitude > 3.0"
    ),
    "stream_count_gt3_closed": f"""
    select * from ({_window(60, "count(*) as num_quakes_mag_gt3", "magnitude > 3.0")}) w
    where "end" <= (select max(time) from messages) - interval '10 hours'
    """,
    "stream_count_gt3_late": f"""
    , span as (select epoch_ms(min(ts)) as low, epoch_ms(max(ts)) as high from events)
    select time_bucket(interval '60 minutes', date_trunc('milliseconds', ts), timestamp '1970-01-01') as start,
      time_bucket(interval '60 minutes', date_trunc('milliseconds', ts), timestamp '1970-01-01')
        + interval '60 minutes' as "end", count(*) as num_quakes_mag_gt3
    from quakes, span
    where magnitude > 3.0
      and not ((epoch_ms(ts) - low) * {PARTS} < high - low + 1 and event_id % 10 = 0)
    group by 1, 2
    """,
    "stream_published_slices": _window(
        300, "max(magnitude) as max_magnitude", "latitude >= -5 and latitude <= 5"
    ),
    "stream_equator_max": _window(
        300, "max(magnitude) as max_magnitude", "latitude >= -5 and latitude <= 5"
    ),
    "stream_replayed_slices": _window(
        300, "max(magnitude) as max_magnitude", "latitude >= -5 and latitude <= 5"
    ),
    "stream_equator_count_gt4": _window(
        300,
        "count(*) as count_gt4",
        "latitude >= -5 and latitude <= 5 and magnitude > 4.0",
    ),
    "stream_location_join": """
    select a.location, a.magnitude as magnitude1, a.time as time1,
      b.magnitude as magnitude2, b.time as time2
    from messages a join messages b on a.location = b.location
      and b.time >= a.time - interval '15 minutes' and b.time <= a.time + interval '15 minutes'
    """,
    "stream_location_join_unbounded": """
    select a.location, a.magnitude as magnitude1, a.time as time1,
      b.magnitude as magnitude2, b.time as time2
    from near_messages a join near_messages b on a.location = b.location
    """,
}

ORACLE_SQL: dict[str, str] = {
    name: f"with {QUAKES_SQL} {body}" for name, body in _AFTER_CTE.items()
}
