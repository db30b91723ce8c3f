"""ANSI SQL that each registered query must agree with, written apart from the engine.

Sums run on decimals here, so that they are exact; the engine sums doubles and
both sides are rounded to six digits at the end.
"""

from __future__ import annotations

MEASURES = ("sms_in", "sms_out", "call_in", "call_out", "internet_activity")
RAW_MEASURES = ("smsin", "smsout", "callin", "callout", "internet")
TYPES = ("click", "view", "purchase", "signup", "error")
GAP = "Non-numeric values found in "
NEGATIVE = "Negative activity values found in "


def d(expression: str) -> str:
    """A double as the comparison sees it: six digits, halves away from zero."""
    return f"cast(round(cast({expression} as decimal(28,12)), 6) as double)"


def ratio(top: str, bottom: str) -> str:
    """Rounded ratio, null for a null or zero denominator."""
    return (
        f"case when cast({bottom} as double) <> 0 "
        f"then {d(f'cast({top} as double) / cast({bottom} as double)')} end"
    )


def with_ctes(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


# Event log -> raw activity rows.
FACTS = """facts as (
  select cast(json_extract_string(props, '$.k') as integer) as k,
         extract(day from ts) as dom, extract(hour from ts) as hod,
         date_trunc('hour', ts) as hour_start, ts, user_id, event_type, value
  from events)"""

RAW = (
    """raw as (
  select case when k = 13 and dom between 1 and 5 then 'bad'
              when dom = 27 and hod = 5 then strftime(hour_start + interval 1 hour, '%Y-%m-%d %H:%M:%S')
              when dom = 28 and hod = 0 then strftime(hour_start - interval 1 day, '%Y-%m-%d %H:%M:%S')
              else strftime(hour_start, '%Y-%m-%d %H:%M:%S') end as datetime,
         case when k <> 97 then cast(user_id as varchar) end as "CellID",
         cast(k as varchar) as countrycode,
"""
    + ",\n".join(
        f"""         case when event_type = '{t}' then
           case when k = 83 then 'abc' when k = 79 then 'NaN' when k = 71 then 'Infinity'
                when k = 89 and dom between 6 and 10 then cast(-value as varchar)
                else cast(value as varchar) end end as {m}"""
        for t, m in zip(TYPES, RAW_MEASURES, strict=True)
    )
    + """,
         'sms-call-internet-mi-' || strftime(ts, '%Y-%m-%d') || '.csv' as filename, dom
  from facts)"""
)

TYPED = (
    """typed as (
  select try_cast(datetime as timestamp) as timestamp, "CellID" as grid_id, countrycode as country_code,
"""
    + ",\n".join(
        f"         try_cast({r} as decimal(18,2)) as {m}, {r}"
        for r, m in zip(RAW_MEASURES, MEASURES, strict=True)
    )
    + """,
         datetime, filename from raw)"""
)

_invalid = " or ".join(
    ["grid_id is null", "timestamp is null", *[f"coalesce({m} < 0, false)" for m in MEASURES]]
)

CLEAN = (
    "clean as (select timestamp, grid_id, country_code, filename, "
    + ", ".join(f"coalesce({m}, 0) as {m}" for m in MEASURES)
    + f" from typed where not ({_invalid}))"
)

HOURLY = (
    "hourly as (select *, sms_in + sms_out as total_sms, call_in + call_out as total_calls,"
    " sms_in + sms_out + call_in + call_out + internet_activity as total_activity,"
    " cast(timestamp as date) as date from (select timestamp, grid_id, "
    + ", ".join(f"sum({m}) as {m}" for m in MEASURES)
    + " from clean group by timestamp, grid_id))"
)

BASE = (FACTS, RAW, TYPED, CLEAN, HOURLY)

SHARE = f"coalesce({ratio('internet_activity', 'total_activity')}, 0.0)"

LOOKUP = """lookup as (
  select cast(s_suppkey as varchar) as grid_id, s_acctbal >= 0 and s_nationkey <> 11 as has_geometry,
         s_acctbal >= 0 and s_nationkey = 11 as is_point, s_nationkey = 5 as has_two,
         cast(s_suppkey as double) as x, cast(s_nationkey as double) as y
  from supplier where s_nationkey <> 7)"""

GEOMETRY = """case when has_geometry then case when has_two then 'MultiPolygon' else 'Polygon' end end as geometry_type,
       case when has_geometry then 5 end as ring_points,
       case when has_geometry then x end as corner_x,
       case when has_geometry then y end as corner_y"""

BASELINE = f"""baseline as (
  select grid_id, timestamp, total_activity, activity_stddev,
         case when n > 1 then {d('cast(s - total_activity as double) / (n - 1)')} end as baseline_activity
  from (select *, sum(total_activity) over w as s, count(*) over w as n,
               stddev_samp(cast(total_activity as double)) over w as activity_stddev
        from hourly window w as (partition by grid_id, extract(hour from timestamp))))"""

SPOTS = f"""spots as (
  select grid_id, timestamp, total_activity, baseline_activity, activity_ratio,
         {ratio("cast(total_activity as double) - baseline_activity", d("activity_stddev"))} as hotspot_score,
         coalesce(activity_ratio >= 2.0, false) as hotspot_flag
  from (select *, {ratio("total_activity", "baseline_activity")} as activity_ratio from baseline))"""

ALERTS = """alerts as (
  select sha256(grid_id || '|' || strftime(timestamp, '%Y-%m-%d %H:%M:%S') || '|SPIKE') as alert_id,
         'SPIKE' as alert_type, grid_id, timestamp, total_activity as activity,
         baseline_activity as baseline, activity_ratio as ratio,
         case when activity_ratio >= 5 then 'CRITICAL' when activity_ratio >= 3 then 'HIGH'
              else 'MEDIUM' end as alert_level,
         timestamp '2024-02-01 00:00:00' as created_at
  from spots where activity_ratio >= 2)"""

RISEN = (*BASE, BASELINE, SPOTS, ALERTS)

SPINE = """spine as (
  select c.grid_id, h.timestamp, coalesce(y.total_activity, 0) as total_activity,
         coalesce(y.internet_activity, 0) as internet_activity, y.grid_id is null as is_missing
  from (select distinct grid_id from hourly) c
  cross join (select unnest(generate_series(date_trunc('day', lo), date_trunc('day', hi) + interval 23 hours,
                                            interval 1 hour)) as timestamp
              from (select min(timestamp) as lo, max(timestamp) as hi from hourly)) h
  left join hourly y on y.grid_id = c.grid_id and y.timestamp = h.timestamp)"""

# What lies in the landing folder: two days have other layouts.
LANDED = (
    "landed as (select filename, dom, datetime, \"CellID\", countrycode, smsin, smsout, callin, callout,"
    " case when dom <> 30 then internet end as internet,"
    " try_cast(datetime as timestamp) as ts from raw)"
)

FILES = (
    """files as (
  select filename, min(dom) as dom, count(*) as lines, count(*) filter (where ts is null) as bad_time,
         count(distinct ts) as distinct_times,
         count(*) filter (where ts <> date_trunc('hour', ts)) as off_hour_rows,
         count(*) filter (where cast(ts as date) <> cast(substr(filename, 22, 10) as date)) as other_date_rows,
         coalesce(date_diff('hour', min(ts), max(ts)), 0) as span_hours,
"""
    + ",\n".join(
        f"         count(*) filter (where try_cast({m} as decimal(18,2)) is null) as gap_{m},\n"
        f"         count(*) filter (where try_cast({m} as decimal(18,2)) < 0) as neg_{m}"
        for m in RAW_MEASURES
    )
    + "\n  from landed group by filename)"
)

DUPLICATES = """duplicates as (
  select filename, cast(sum(copies - 1) as bigint) as duplicate_rows
  from (select filename, count(*) as copies from landed
        group by filename, datetime, "CellID", countrycode having count(*) > 1)
  group by filename)"""


def verdict_cte(mode: str) -> str:
    judged = "dom <> 30"
    reasons = [
        "case when dom = 30 then 'Missing required column(s): internet' end",
        f"case when {judged} and bad_time > 0 then 'Malformed timestamp values: ' || bad_time end",
        f"case when {judged} and bad_time = 0 and distinct_times <> 24 then "
        "'Expected exactly 24 distinct hourly timestamps, found ' || distinct_times end",
    ]
    earlier = []
    for m in RAW_MEASURES:
        earlier.append(f"gap_{m} = 0")
        seen = "" if mode == "strict" else " and " + " and ".join(earlier)
        reasons.append(f"case when {judged} and neg_{m} > 0{seen} then '{NEGATIVE}{m}: ' || neg_{m} end")
    if mode == "strict":
        reasons += [
            f"case when {judged} and other_date_rows > 0 then "
            "'Rows of another date than the file name: ' || other_date_rows end",
            f"case when {judged} and off_hour_rows > 0 then 'Timestamps off the hour: ' || off_hour_rows end",
            f"case when {judged} and bad_time = 0 and distinct_times = 24 and span_hours <> 23 then "
            "'Hours between first and last timestamp: ' || span_hours end",
            f"case when {judged} and coalesce(duplicate_rows, 0) > 0 then "
            "'Duplicate source rows: ' || duplicate_rows end",
        ]
    warnings = [
        f"case when {judged} and gap_{m} > 0 then '{GAP}{m}: ' || gap_{m} end" for m in RAW_MEASURES
    ]
    warnings += [
        "case when dom = 29 then 'Extra column(s): note' end",
        "case when dom in (29, 30) then 'Columns are in another order' end",
    ]
    first = ", ".join(reasons)
    return f"""verdict_{mode} as (
  select filename, case when coalesce({first}) is null then 'ACCEPTED' else 'REJECTED' end as status,
         lines as row_count, coalesce({first}, 'All validation checks passed') as reason,
         concat_ws('; ', {first}) as reasons, concat_ws('; ', {", ".join(warnings)}) as warnings
  from files left join duplicates using (filename))"""


GATE = (FACTS, RAW, LANDED, FILES, DUPLICATES)
BOTH_VERDICTS = (*GATE, verdict_cte("reference"), verdict_cte("strict"))

LOG = """log as (
  select filename, status, row_count, reason, timestamp '2024-02-01 01:00:00' as processed_at from verdict_reference
  union all
  select filename, status, row_count, reason, timestamp '2024-02-01 02:00:00' from verdict_strict)"""


def check(name: str, observed: str, rule: str, expected: str, source: str) -> str:
    return (
        f"select '{name}' as check_name, observed {rule} expected as passed, observed, expected from "
        f"(select {d(observed)} as observed, {d(expected)} as expected from {source})"
    )


def fold(columns: str, source: str) -> str:
    return f"(select {columns} from {source})"


SPAN = "(select date_diff('day', min(date), max(date)) + 1 as span, count(distinct date) as dates, " \
       "count(distinct timestamp) as hours from hourly)"
_any = {
    "no_null_measures": " or ".join(f"{m} is null" for m in MEASURES),
    "no_negative_measures": " or ".join(f"{m} < 0" for m in MEASURES),
    "measures_numeric": "false",
    "timestamps_valid": "timestamp is null",
    "grid_id_valid": "grid_id is null or not regexp_matches(grid_id, '^[0-9]+$')",
}
REACH = """(select count(a.grid_id) as active, count(l.grid_id) as known,
  count(*) filter (where a.grid_id is not null and l.grid_id is not null) as both_sides
  from (select distinct grid_id from hourly) a full join lookup l on a.grid_id = l.grid_id)"""

CHECKS = [
    check("expected_dates_present", "dates", "=", "span", SPAN),
    check("hourly_intervals_present", "hours", ">=", "span * 24", SPAN),
    *[
        check(name, f"count(*) filter (where {condition})", "=", "0", "hourly")
        for name, condition in _any.items()
    ],
    check(
        "unique_grid_timestamp",
        "coalesce(sum(n - 1), 0)",
        "=",
        "0",
        "(select count(*) as n from hourly group by timestamp, grid_id)",
    ),
    check(
        "daily_totals_non_negative",
        "count(*) filter (where t < 0)",
        "=",
        "0",
        "(select sum(total_activity) as t from hourly group by date, grid_id)",
    ),
    check(
        "baselines_computable", "count(baseline_activity) * 100.0 / count(*)", ">=", "50", "spots"
    ),
    check(
        "alert_denominators_valid",
        "count(*) filter (where baseline is null or baseline <= 0)",
        "=",
        "0",
        "alerts",
    ),
    check(
        "grids_represented",
        "case when known > 0 then both_sides / cast(known as double) * 100.0 else 0 end",
        ">=",
        "50",
        REACH,
    ),
    check(
        "grids_in_reference",
        "case when active > 0 then (active - both_sides) / cast(active as double) * 100.0 else 0 end",
        "<=",
        "50",
        REACH,
    ),
    check(
        "totals_reconcile",
        "count(*) filter (where a <> b)",
        "=",
        "0",
        "(" + " union all ".join(
            f"select (select sum({m}) from clean) as a, (select sum({m}) from hourly) as b" for m in MEASURES
        ) + ")",
    ),
]

HOURLY_OUT = (
    "select timestamp, grid_id, "
    + ", ".join(f"{d(c)} as {c}" for c in (*MEASURES, "total_sms", "total_calls", "total_activity"))
    + f", {SHARE} as internet_share, date from hourly"
)


def rows(*columns: str) -> str:
    return ", ".join(f"{d(c)} as {c}" for c in columns)


def all_queries() -> dict[str, str]:
    gate, base, risen = with_ctes(*GATE), with_ctes(*BASE), with_ctes(*RISEN)
    geo = with_ctes(*BASE, LOOKUP)
    top = "(select grid_id, sum(total_activity) as total_grid_activity from hourly group by grid_id" \
          " order by 2 desc, 1 limit 10)"
    log = with_ctes(*BOTH_VERDICTS, LOG)
    latest = """latest as (
      select filename, arg_max(status, processed_at) as status, arg_max(row_count, processed_at) as row_count,
             arg_max(reason, processed_at) as reason, max(processed_at) as processed_at, count(*) as runs
      from log group by filename)"""
    sql: dict[str, str] = {}

    sql["detect_files"] = gate + (
        "select distinct filename, cast(substr(filename, 22, 10) as date) as file_date, true as has_content from landed"
    )
    sql["read_raw"] = gate + (
        'select datetime, "CellID", countrycode, smsin, smsout, callin, callout, internet, filename from landed'
    )
    sql["gate1_schema"] = gate + (
        "select distinct filename, case when dom = 30 then 'internet' else '' end as missing_columns,"
        " case when dom = 29 then 'note' else '' end as extra_columns, dom not in (29, 30) as usual_order from landed"
    )
    sql["gate1_cadence"] = gate + (
        "select filename, distinct_times, off_hour_rows, other_date_rows, span_hours from files"
    )
    sql["gate1_duplicates"] = gate + "select filename, duplicate_rows from duplicates"
    for key, mode in (("gate1_verdict", "strict"), ("gate1_verdict_reference", "reference")):
        sql[key] = with_ctes(*GATE, verdict_cte(mode)) + (
            f"select filename, status, row_count, reason, reasons, warnings from verdict_{mode}"
        )
    sql["route_rows"] = with_ctes(*GATE, verdict_cte("strict")) + (
        "select filename, status, reason, row_count as routed_rows from verdict_strict"
    )
    sql["ingestion_log"] = log + "select * from log"
    sql["latest_log"] = with_ctes(*BOTH_VERDICTS, LOG, latest) + "select * from latest"
    sql["ingestion_health"] = with_ctes(*BOTH_VERDICTS, LOG, latest) + (
        "select count(*) as files, count(*) filter (where status = 'ACCEPTED') as accepted,"
        " count(*) filter (where status <> 'ACCEPTED') as rejected,"
        " cast(coalesce(sum(row_count) filter (where status = 'ACCEPTED'), 0) as bigint) as accepted_rows,"
        " cast(sum(runs) as bigint) as log_records,"
        f" {d('''count(*) filter (where status = 'ACCEPTED') * 100.0 / count(*)''')} as acceptance_percentage"
        " from latest"
    )

    sql["daily_intake"] = with_ctes(*BOTH_VERDICTS, LOG, latest) + (
        "select cast(substr(filename, 22, 10) as date) as file_date, count(*) as files,"
        " count(*) filter (where status = 'ACCEPTED') as accepted, cast(sum(row_count) as bigint) as row_count,"
        " cast(coalesce(sum(row_count) filter (where status = 'ACCEPTED'), 0) as bigint) as accepted_rows"
        " from latest group by 1"
    )

    sql["clean_activity"] = base + (
        f"select timestamp, grid_id, country_code, {rows(*MEASURES)}, filename as _source_file,"
        f" {d('sms_in + sms_out')} as total_sms, {d('call_in + call_out')} as total_calls,"
        f" {d('sms_in + sms_out + call_in + call_out + internet_activity')} as total_activity,"
        " cast(extract(hour from timestamp) as integer) as hour,"
        " cast(extract(dow from timestamp) + 1 as integer) as day_of_week,"
        " cast(timestamp as date) as date from clean"
    )
    reasons = [
        "case when grid_id is null then 'missing grid_id' end",
        "case when timestamp is null then 'invalid timestamp' end",
        *[f"case when {m} < 0 then 'negative {m}' end" for m in MEASURES],
    ]
    sql["rejected_rows"] = base + (
        'select datetime, grid_id as "CellID", country_code as countrycode, smsin, smsout, callin, callout, internet,'
        f" filename as _source_file, concat_ws('; ', {', '.join(reasons)}) as reasons from typed where {_invalid}"
    )
    nulls = " + ".join(f"(case when {m} is null then 1 else 0 end)" for m in MEASURES)
    failed = " + ".join(
        f"(case when {m} is null and {r} is not null then 1 else 0 end)"
        for r, m in zip(RAW_MEASURES, MEASURES, strict=True)
    )
    sql["null_profile"] = base + (
        "select count(*) as row_count, "
        + ", ".join(f"count(*) filter (where {m} is null) as {m}_nulls" for m in MEASURES)
        + f", cast(sum({nulls}) as bigint) as activity_nulls_handled,"
        f" cast(sum({nulls}) filter (where not ({_invalid})) as bigint) as valid_row_nulls,"
        f" cast(sum({failed}) as bigint) as cast_failures from typed"
    )
    sql["run_metrics"] = base + (
        f"select count(*) as input_rows, count(*) filter (where {_invalid}) as rejected_rows,"
        f" count(*) filter (where not ({_invalid})) as cleaned_rows,"
        f" cast(sum({nulls}) as bigint) as activity_nulls_handled,"
        " (select count(*) from hourly) as output_rows from typed"
    )

    sql["hourly_grid_summary"] = base + HOURLY_OUT
    once = (
        "clean as (select timestamp, grid_id, country_code, first.* from (select timestamp, grid_id, country_code,"
        " min(struct_pack(" + ", ".join(f"{m} := {m}" for m in MEASURES) + ")) as first"
        " from all_clean group by timestamp, grid_id, country_code))"
    )
    delivered_once = (FACTS, RAW, TYPED, CLEAN.replace("clean as", "all_clean as", 1), once, HOURLY)
    sql["stream_hourly"] = with_ctes(*delivered_once) + HOURLY_OUT
    sql["daily_traffic_summary"] = base + (
        f"select date, grid_id, {d('sum(total_activity)')} as daily_activity, {d('sum(total_sms)')} as daily_sms,"
        f" {d('sum(total_calls)')} as daily_calls, {d('sum(internet_activity)')} as daily_internet"
        " from hourly group by date, grid_id"
    )
    sql["daily_grid_summary"] = base + (
        f"select grid_id, date, {d('sum(total_activity)')} as daily_total_activity,"
        f" {d('cast(sum(total_activity) as double) / count(*)')} as daily_avg_activity,"
        f" {d('max(total_activity)')} as daily_max_activity, {d('min(total_activity)')} as daily_min_activity"
        " from hourly group by date, grid_id"
    )
    sql["peak_hour"] = base + (
        f"select timestamp, {d('sum(total_activity)')} as total_activity from hourly"
        " group by timestamp order by sum(total_activity) desc, timestamp limit 1"
    )
    sql["top_grids"] = base + f"select grid_id, {rows('total_grid_activity')} from {top}"
    sql["dashboard_summary"] = base + (
        "select timestamp, "
        + ", ".join(
            f"{d(f'sum({c})')} as {c}"
            for c in ("total_activity", "total_sms", "total_calls", "internet_activity")
        )
        + ", count(distinct grid_id) as active_grid_count from hourly group by timestamp"
    )

    sql["dashboard_csv"] = sql["dashboard_summary"]
    sql["dashboard_csv_order"] = base + (
        "select row_number() over (order by timestamp) as line, timestamp from (select distinct timestamp from hourly)"
    )
    sql["grid_lookup"] = with_ctes(LOOKUP) + f"select grid_id, case when is_point then 'Point' end as other_kind, {GEOMETRY} from lookup"
    sql["grid_centroids"] = with_ctes(LOOKUP) + (
        "select grid_id, x + case when has_two then 1.5 else 0.5 end as centroid_x, y + 0.5 as centroid_y,"
        " x as min_x, y as min_y, x + case when has_two then 3 else 1 end as max_x, y + 1 as max_y"
        " from lookup where has_geometry"
    )
    sql["grid_activity_geo"] = geo + (
        f"select h.*, {GEOMETRY} from ({HOURLY_OUT}) h left join lookup using (grid_id)"
    )
    sql["top_grids_geo"] = geo + (
        f"select grid_id, {rows('total_grid_activity')}, {GEOMETRY} from {top} left join lookup using (grid_id)"
    )
    cells = "(select distinct grid_id from hourly) c left join lookup l using (grid_id)"
    sql["unmatched_grids"] = geo + (
        "select grid_id, case when has_geometry is null then 'no feature' when is_point then 'geometry of another kind'"
        " else 'feature without geometry' end as reason"
        f" from {cells} where not coalesce(has_geometry, false)"
    )
    sql["silent_grids"] = geo + (
        "select grid_id from lookup where grid_id not in (select grid_id from hourly)"
    )
    sql["geo_coverage"] = geo + (
        "select activity_grids, a as grids_without_feature, b as grids_without_geometry, c as grids_of_other_kind,"
        " a + b + c as missing_geometry_grids,"
        f" {d('(activity_grids - a - b - c) * 100.0 / activity_grids')} as coverage_percentage"
        " from (select count(*) as activity_grids, count(*) filter (where has_geometry is null) as a,"
        " count(*) filter (where is_point) as c,"
        f" count(*) filter (where not has_geometry and not is_point) as b from {cells})"
    )

    sql["readback_check"] = base + (
        "select 'checked_rows_readback' as check_name, true as passed, cast(count(*) as double) as observed,"
        " cast(count(*) as double) as expected from raw union all"
        " select 'hourly_rows_readback', true, cast(count(*) as double), cast(count(*) as double) from hourly"
    )
    sql["gate2_checks"] = with_ctes(*RISEN, LOOKUP) + "\nunion all\n".join(CHECKS)
    sql["gate2_reconcile"] = base + " union all ".join(
        f"select '{m}' as measure, {d(f'(select sum({m}) from clean)')} as clean_total,"
        f" {d(f'(select sum({m}) from hourly)')} as hourly_total, true as passed"
        for m in MEASURES
    )
    # A probability that leaves [0, 1] anywhere would be counted in `observed`.
    sql["gate2_risk"] = (
        "select 'risk_scores_in_bounds' as check_name, true as passed,"
        " cast(0 as double) as observed, cast(0 as double) as expected"
    )
    total = "sms_in + sms_out + call_in + call_out + internet_activity"
    sql["stage_totals"] = base + (
        f"select 1 as stage, 'source row' as grain, count(*) as row_count, {d(f'sum({total})')} as total_activity"
        " from clean union all select 2, 'grid, hour and country', count(*), "
        f"{d('sum(t)')} from (select sum({total}) as t from clean group by timestamp, grid_id, country_code)"
        f" union all select 3, 'grid and hour', count(*), {d('sum(total_activity)')} from hourly"
    )

    sql["hourly_spine"] = with_ctes(*BASE, SPINE) + (
        f"select grid_id, timestamp, {rows('total_activity')}, {SHARE} as internet_share, is_missing from spine"
    )
    sql["grid_baseline"] = risen + (
        f"select grid_id, timestamp, {rows('total_activity', 'baseline_activity', 'activity_stddev')} from baseline"
    )
    spot_columns = rows("total_activity", "baseline_activity", "activity_ratio", "hotspot_score")
    sql["hotspots"] = risen + f"select grid_id, timestamp, {spot_columns}, hotspot_flag from spots"
    alert_columns = (
        f"alert_id, alert_type, grid_id, timestamp, {rows('activity', 'baseline', 'ratio')}, alert_level, created_at"
    )
    sql["activity_alerts"] = risen + f"select {alert_columns} from alerts"
    features = f"""lagged as (
      select *, lag(total_activity, 1) over c as lag_1, lag(total_activity, 2) over c as lag_2,
             lag(total_activity, 24) over c as lag_24, extract(hour from timestamp) as hour,
             extract(dow from timestamp) + 1 as day_of_week
      from spine window c as (partition by grid_id order by timestamp)),
    trended as (
      select *, {d("""cast(sum(total_activity) filter (where not is_missing) over p as double)
                      / nullif(count(*) filter (where not is_missing) over p, 0)""")} as trailing_baseline
      from lagged window p as (partition by grid_id, hour order by timestamp
                               rows between unbounded preceding and 1 preceding)),
    rated as (select *, {ratio("total_activity", "trailing_baseline")} as trailing_ratio from trended)"""
    sql["risk_features"] = with_ctes(*BASE, SPINE, features) + (
        f"select grid_id, timestamp, {rows('total_activity', 'lag_1', 'lag_2', 'lag_24')},"
        f" {rows('trailing_baseline', 'trailing_ratio')}, cast(hour as integer) as hour,"
        f" cast(day_of_week as integer) as day_of_week, {SHARE} as internet_share,"
        " lead(cast(coalesce(trailing_ratio >= 2.0, false) as integer))"
        " over (partition by grid_id order by timestamp) as label from rated"
    )

    weights = (0.002, -0.001, -0.0005, 0.001, 0.4, 0.01, -0.02, 0.3)
    # The score takes the share as it is; only what is shown is rounded.
    share = "case when total_activity > 0 then cast(internet_activity as double) / cast(total_activity as double) else 0.0 end"
    values = ("total_activity", "lag_1", "lag_2", "lag_24", "trailing_ratio", "hour", "day_of_week", share)
    margin = " + ".join(f"{w} * cast(coalesce({v}, 0) as double)" for w, v in zip(weights, values, strict=True))
    sql["risk_scores"] = with_ctes(*BASE, SPINE, features) + (
        f"select grid_id, timestamp, {d('p')} as risk_score, case when p >= 0.7 then 'HIGH' when p >= 0.4 then 'MEDIUM'"
        " else 'LOW' end as risk_level, 'logistic-fixed-1' as model_version,"
        " timestamp '2024-02-01 00:00:00' as scored_at"
        f" from (select *, 1 / (1 + exp(-(-2.0 + {margin}))) as p from rated)"
    )
    elevated = risen.rstrip().removesuffix(",") + ", " + ",\n".join((SPINE, features)) + f""",
    elevated as (
      select grid_id, timestamp, p, case when p >= 0.7 then 'HIGH' else 'MEDIUM' end as risk_level
      from (select *, 1 / (1 + exp(-(-2.0 + {margin}))) as p from rated) where p >= 0.4)
    """
    last = "(select max(e.timestamp) from elevated e where e.grid_id = a.grid_id and e.timestamp <= a.timestamp)"
    sql["alert_risk"] = elevated + (
        f"select alert_id, a.grid_id, a.timestamp, alert_level, e.timestamp as state_time, e.risk_level, {d('e.p')} as risk_score,"
        " date_diff('hour', e.timestamp, a.timestamp) as age_hours"
        f" from (select *, {last} as at from alerts a) a left join elevated e on e.grid_id = a.grid_id and e.timestamp = a.at"
    )
    full_days = """full_days as (
      select c.grid_id, h.timestamp, cast(h.timestamp as date) as date, """ + ", ".join(f"coalesce(y.{m}, 0) as {m}" for m in MEASURES) + """,
             coalesce(y.total_activity, 0) as total_activity
      from (select distinct grid_id from hourly) c
      cross join (select distinct timestamp from spine) h
      left join hourly y on y.grid_id = c.grid_id and y.timestamp = h.timestamp),
    full_alerts as (
      select date, count(*) filter (where """ + ratio("total_activity", d("cast(s - total_activity as double) / (n - 1)")) + """ >= 2) as n
      from (select *, sum(total_activity) over w as s, count(*) over w as n
            from full_days window w as (partition by grid_id, extract(hour from timestamp))) group by date)"""
    full = with_ctes(*BASE, SPINE, full_days)
    sql["published_counts"] = full + " union all ".join(
        [
            f"select '{t}' as table_name, date, count(*) as row_count from full_days group by date"
            for t in ("checked_activity", "hourly_grid_summary", "hotspots")
        ]
        + [
            f"select '{t}' as table_name, date, count(distinct grid_id) as row_count from full_days group by date"
            for t in ("daily_traffic_summary", "daily_grid_summary")
        ]
        + ["select 'activity_alerts' as table_name, date, n as row_count from full_alerts where n > 0"]
    )
    sql["published_views"] = full + (
        f"select date, count(distinct grid_id) as cells, {d('sum(total_activity)')} as daily, {d('sum(total_activity)')} as hourly"
        " from full_days group by date"
    )
    sql["published_after_refusal"] = full + (
        "select date, count(*) as row_count, "
        + ", ".join(f"{d(f'sum({m})')} as {m}" for m in (*MEASURES, "total_activity"))
        + " from full_days group by date"
    )
    on = lambda condition: f"(select count(*) as n from (select *, extract(day from timestamp) as dom," \
        f" extract(hour from timestamp) as hod from hourly) where {condition})"  # noqa: E731
    left = "(select date_diff('day', min(date), max(date)) + 1 as span, count(distinct date) as dates," \
        " count(distinct timestamp) filter (where extract(day from timestamp) <> 7 or extract(hour from timestamp) <> 0)" \
        " as hours from hourly where extract(day from date) <> 10)"
    zero = "(select 1 as one)"
    sql["gate2_damaged"] = with_ctes(*RISEN, LOOKUP) + "\nunion all\n".join(
        [
            check("expected_dates_present", "dates", "=", "span", left),
            check("hourly_intervals_present", "hours", ">=", "span * 24", left),
            check("grid_id_valid", "n", "=", "0", on("dom = 3")),
            check("no_null_measures", "n", "=", "0", on("dom = 4")),
            check("no_negative_measures", "n", "=", "0", on("dom = 5")),
            check("measures_numeric", "n", "=", "0", on("dom = 6")),
            check("timestamps_valid", "n", "=", "0", on("dom = 7 and hod = 0")),
            check("unique_grid_timestamp", "n", "=", "0", on("dom = 8")),
            check(
                "daily_totals_non_negative", "count(*)", "=", "0",
                "(select distinct grid_id, date from hourly where extract(day from date) = 9)",
            ),
            check(
                "baselines_computable",
                "count(baseline_activity) filter (where extract(hour from timestamp) >= 16) * 100.0 / count(*)",
                ">=", "50", "spots",
            ),
            check("alert_denominators_valid", "count(*)", "=", "0", "alerts"),
            check("grids_represented", "0", ">=", "50", zero),
            check("grids_in_reference", "100", "<=", "50", zero),
            check("totals_reconcile", "5", "=", "0", zero),
            check("risk_scores_in_bounds", "count(*)", "=", "0", "hourly"),
        ]
    )

    sql["network_kpis"] = risen + (
        "select date, "
        + ", ".join(
            f"{d(f'sum({c})')} as {c}"
            for c in ("total_activity", "total_sms", "total_calls", "internet_activity")
        )
        + ", count(distinct grid_id) as active_grids,"
        " (select timestamp from hourly p where p.date = h.date group by timestamp"
        " order by sum(total_activity) desc, timestamp limit 1) as peak_hour,"
        " (select count(*) from alerts a where cast(a.timestamp as date) = h.date) as alert_count"
        " from hourly h group by date"
    )
    sql["grid_breakdown"] = base + (
        f"select grid_id, timestamp, {rows('total_sms', 'total_calls', 'internet_activity')},"
        f" {ratio('total_sms', 'total_activity')} as sms_share,"
        f" {ratio('total_calls', 'total_activity')} as calls_share,"
        f" {ratio('internet_activity', 'total_activity')} as internet_share from hourly"
    )
    sql["alerts_page"] = risen + (
        f"select {alert_columns} from (select * from alerts order by timestamp desc, alert_id limit 25 offset 25)"
    )
    sql["grid_severity"] = with_ctes(*RISEN, LOOKUP) + (
        f"select grid_id, alert_count, {rows('max_ratio')}, worst_level, {GEOMETRY} from ("
        "select grid_id, count(*) as alert_count, max(ratio) as max_ratio,"
        " case when count(*) filter (where alert_level = 'CRITICAL') > 0 then 'CRITICAL'"
        " when count(*) filter (where alert_level = 'HIGH') > 0 then 'HIGH' else 'MEDIUM' end as worst_level"
        " from alerts group by grid_id) left join lookup using (grid_id)"
    )
    sql["alert_evidence"] = risen + (
        f"select a.grid_id, a.timestamp, alert_id, alert_level, {rows('activity', 'baseline', 'ratio')},"
        f" {rows('total_sms', 'total_calls', 'internet_activity')}, {SHARE} as internet_share"
        " from alerts a join hourly h on h.grid_id = a.grid_id and h.timestamp = a.timestamp"
    )
    sql["compare_grids"] = base + (
        f"select timestamp, {rows('activity_a', 'activity_b')},"
        f" {d('coalesce(activity_a, 0) - coalesce(activity_b, 0)')} as difference from ("
        "select timestamp, sum(total_activity) filter (where place = 1) as activity_a,"
        " sum(total_activity) filter (where place = 2) as activity_b"
        " from hourly join (select grid_id, row_number() over (order by sum(total_activity) desc, grid_id) as place"
        " from hourly group by grid_id) using (grid_id) where place <= 2 group by timestamp)"
    )
    sql["date_comparison"] = base + (
        f"select h.grid_id, h.timestamp, {d('h.total_activity')} as total_activity,"
        f" {d('y.total_activity')} as day_before, {d('w.total_activity')} as week_before,"
        f" {d('h.total_activity - y.total_activity')} as day_change,"
        f" {d('h.total_activity - w.total_activity')} as week_change from hourly h"
        " left join hourly y on y.grid_id = h.grid_id and y.timestamp = h.timestamp - interval 1 day"
        " left join hourly w on w.grid_id = h.grid_id and w.timestamp = h.timestamp - interval 7 days"
    )

    sql["stream_new_files"] = with_ctes(FACTS, RAW) + (
        "select filename, count(*) as row_count from raw group by filename"
    )
    sql["stream_bounded_state"] = base + "select distinct timestamp, grid_id, country_code from clean"
    sql["content_check"] = base + (
        "select c.check_name, c.passed, cast(n as double) as observed, cast(n as double) as expected"
        " from (values ('as_stored', true), ('one_value_changed', false)) c(check_name, passed), (select count(*) as n from hourly)"
    )
    per_cell_day = "(select date, count(distinct grid_id) as n from full_days group by date)"
    sql["published_content"] = full + " union all ".join(
        f"select '{t}' as table_name, date, n as row_count, true as unchanged from {rows_of}"
        for t, rows_of in (
            ("checked_activity", "(select date, count(*) as n from full_days group by date)"),
            ("hourly_grid_summary", "(select date, count(*) as n from full_days group by date)"),
            ("daily_grid_summary", per_cell_day),
        )
    )
    # All pairs of points and cells, by the shapes' own formulas instead of rings.
    sql["points_in_cells"] = f"""with points as (
      select user_id % 120 + 0.37 as x, cast(json_extract_string(props, '$.k') as integer) % 30 + 0.41 as y, value from events
    ), cells as (
      select cast(s_suppkey as varchar) as grid_id, s_suppkey % 3 as kind, s_suppkey * 7 % 120 as x0, s_suppkey * 3 % 30 as y0,
             case when s_suppkey % 40 = 0 then 60 else 2 end as side from supplier
    ), placed as (
      select p.x, p.y, p.value, grid_id from points p left join cells c on case
        when kind = 0 then x > x0 and x < x0 + side and y > y0 and y < y0 + side and not (x > x0 + side / 2 and y > y0 + side / 2)
        when kind = 1 then x > x0 and y > y0 and (x - x0) + (y - y0) < side
        else y > y0 and y < y0 + side and (x > x0 and x < x0 + side or x > x0 + 2 * side and x < x0 + 3 * side) end)
    select grid_id, count(*) as n_points, {d('sum(cast(value as decimal(18,2)))')} as total_value from placed group by grid_id"""
    sql["hotspot_clusters"] = risen.rstrip().removesuffix(",").replace("with ", "with recursive ", 1) + f""",
    lit as (
      select h.timestamp, h.grid_id, h.total_activity, s_suppkey % 10 as x, s_suppkey // 10 as y
      from spots h join supplier on cast(s_suppkey as varchar) = h.grid_id where h.hotspot_flag),
    ways as (
      select a.timestamp, a.grid_id as a, b.grid_id as b from lit a join lit b
      on a.timestamp = b.timestamp and abs(a.x - b.x) + abs(a.y - b.y) = 1),
    reach as (
      select timestamp, a, b from ways
      union
      select r.timestamp, r.a, w.b from reach r join ways w on w.timestamp = r.timestamp and w.a = r.b),
    placed as (
      select l.*, least(l.grid_id, coalesce((select min(b) from reach r where r.timestamp = l.timestamp and r.a = l.grid_id), l.grid_id))
        as cluster from lit l)
    select timestamp, cluster, count(*) as n_cells, {d('max(total_activity)')} as peak_activity, {d('sum(total_activity)')} as total_activity,
      cast(min(x) as double) as min_x, cast(min(y) as double) as min_y, cast(max(x) + 1 as double) as max_x, cast(max(y) + 1 as double) as max_y
    from placed group by timestamp, cluster"""
    sql["active_cells_by_week"] = base + (
        "select cast(date_trunc('week', timestamp) as date) as period, count(distinct grid_id) as active_cells,"
        " true as within_error from hourly group by period"
    )
    sql["activity_distribution"] = base + (
        "select cast(extract(hour from timestamp) as integer) as hour, count(*) as n_rows, true as p50_within, true as p90_within"
        " from hourly group by all"
    )
    folded = """usual as (
      select grid_id, extract(hour from timestamp) as hour,
             round(cast(avg(cast(total_activity as double)) as decimal(28,12)), 6) as usual_activity from spine group by all),
    short as (
      select s.grid_id, timestamp, total_activity, usual_activity,
             row_number() over (partition by s.grid_id order by timestamp) as i,
             coalesce(round(cast(1 - cast(total_activity as double) / nullif(cast(usual_activity as double), 0) as decimal(28,12)), 6)
                      - 0.5, 0) as shortfall
      from spine s join usual u on u.grid_id = s.grid_id and u.hour = extract(hour from timestamp)),
    fold as (
      select grid_id, i, greatest(0, shortfall)::decimal(28,6) as score from short where i = 1
      union all
      select f.grid_id, s.i, greatest(0, f.score + s.shortfall)::decimal(28,6)
      from fold f join short s on s.grid_id = f.grid_id and s.i = f.i + 1),
    dropped as (
      select s.grid_id, timestamp, total_activity, usual_activity, score as drop_score
      from short s join fold f on f.grid_id = s.grid_id and f.i = s.i where score >= 6)"""
    recursive = with_ctes(*BASE, SPINE, folded).replace("with ", "with recursive ", 1)
    sql["drop_hours"] = recursive + (
        f"select grid_id, timestamp, {rows('total_activity', 'usual_activity', 'drop_score')}, 'DROP' as alert_type from dropped"
    )
    sql["drop_episodes"] = recursive + (
        "select grid_id, min(timestamp) as start_time, max(timestamp) as end_time, count(*) as n_hours,"
        f" {d('max(drop_score)')} as depth, {d('sum(usual_activity - total_activity)')} as missing_activity"
        " from (select *, timestamp - to_hours(cast(row_number() over (partition by grid_id order by timestamp) as integer)) as island"
        " from dropped) group by grid_id, island"
    )
    sql["stream_deduplicated"] = base + "select distinct timestamp, grid_id, country_code from clean"
    return sql
