"""The DuckDB statement each registered query must agree with.

The statements follow the plain definitions (literal OR join, calendar join, row-by-row islands), not
the way the Spark operators compute them.
"""

from __future__ import annotations

import re

# Named building blocks, each a select; a statement pulls in the ones it mentions.
BLOCKS: dict[str, str] = {}
ORACLE: dict[str, str] = {}

MACHINE = """case when user_id % 10 = 0 then 'PRESS-' || chr((65 + (user_id // 10) % 26)::int)
                  else 'M-' || lpad(user_id::varchar, 4, '0') end"""
KEY = "regexp_replace(upper({0}), '[^A-Z0-9]', '', 'g')"
NUM = "try_cast(nullif(regexp_extract(upper({0}), '[0-9]+'), '') as decimal(38,0))"
K = "json_extract_string(props, '$.k')::int"


def r6(value: str) -> str:
    """Six decimals, decided as in the Spark registry."""
    return f"floor((({value})::double + 1e-9::double) * 1e6::double + 0.5::double)::bigint / 1e6::double"


def rounded(*columns: str) -> str:
    return ", ".join(f"{r6(c)} as {c}" for c in columns)


def statement(select: str) -> str:
    """The select behind a WITH clause that holds every block it needs, in definition order."""
    needed: set[str] = set()
    todo = [select]
    while todo:
        words = set(re.findall(r"[a-z_0-9]+", todo.pop()))
        for name in BLOCKS:
            if name in words and name not in needed:
                needed.add(name)
                todo.append(BLOCKS[name])
    parts = [f"{name} as (\n{sql.strip()}\n)" for name, sql in BLOCKS.items() if name in needed]
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + select.strip()


# ---- raw tables -------------------------------------------------------------------------------

BLOCKS["b_sensor_raw"] = f"""
select ts as timestamp, {MACHINE} as machine_id, 70 + value / 4 as temperature,
       0.2::double + {K} / 40.0::double as vibration, event_id as arrival
from events"""
BLOCKS["b_dense_raw"] = f"""
select ts as timestamp, 'D-' || lpad((user_id % 5)::varchar, 3, '0') as machine_id, 70 + value / 8 as temperature,
       0.2::double + {K} / 55.0::double as vibration
from events"""
BLOCKS["b_status_raw"] = """
select case when user_id % 10 = 0 then ' press ' || chr((97 + (user_id // 10) % 26)::int)
            when user_id % 3 = 0 then ' m' || user_id::varchar
            else 'M-' || lpad(user_id::varchar, 4, '0') end as machine_id,
       case event_type when 'error' then ' maintenance' when 'view' then 'Idle' else 'RUNNING' end as status,
       ts as last_updated
from events where user_id % 7 <> 0"""
BLOCKS["b_orders_raw"] = """
select 'WO-' || l_orderkey::varchar as order_id, 'M-' || lpad(l_suppkey::varchar, 4, '0') as machine_id,
       p_name as product_name, l_quantity::bigint as target_quantity,
       case l_linestatus when 'O' then 'OPEN' else 'IN_PROGRESS' end as order_status,
       case when l_linenumber = 7 then null else l_shipdate end as created_at
from lineitem left join part on l_partkey = p_partkey"""

# ---- staging and marts ------------------------------------------------------------------------

SENSOR_CLEAN = """
select * from (
  select timestamp as event_ts, nullif(regexp_replace(upper(trim(machine_id)), '[^A-Z0-9-]', '', 'g'), '') as machine_id,
         temperature, vibration
  from {0}) where event_ts is not null and machine_id is not null"""
BLOCKS["b_sensor"] = SENSOR_CLEAN.format("b_sensor_raw")
BLOCKS["b_dense"] = SENSOR_CLEAN.format("b_dense_raw")
BLOCKS["b_status"] = """
select * from (
  select nullif(regexp_replace(upper(trim(machine_id)), '[^A-Z0-9-]', '', 'g'), '') as machine_id,
         nullif(regexp_replace(upper(trim(status)), '[^A-Z_]', '', 'g'), '') as status, last_updated as status_ts
  from b_status_raw) where machine_id is not null and status is not null"""
BLOCKS["b_orders"] = """
select * from (
  select nullif(trim(order_id), '') as order_id, nullif(trim(machine_id), '') as machine_id,
         product_name, target_quantity, order_status, created_at
  from b_orders_raw) where order_id is not null and machine_id is not null
qualify row_number() over (partition by order_id order by created_at desc nulls last, machine_id,
    product_name nulls last, target_quantity nulls last, order_status nulls last) = 1"""
LATEST_STATUS = f"""
select machine_key, machine_num, status from (
  select {KEY.format('machine_id')} as machine_key, {NUM.format('machine_id')} as machine_num, status,
         row_number() over (partition by {KEY.format('machine_id')}
                            order by status_ts desc nulls first, status, machine_id) as rn
  from b_status {{0}}) where rn = 1"""
BLOCKS["b_latest"] = LATEST_STATUS.format("")
HOURLY = """
select date_trunc('hour', event_ts)::timestamp as hour_ts, machine_id, avg(temperature) as avg_temperature,
       avg(vibration) as avg_vibration,
       sum(case when temperature > 90 or vibration > 2.0 then 1 else 0 end)::bigint as anomaly_events,
       count(*) as total_events
from {0} group by all"""
BLOCKS["b_hourly"] = HOURLY.format("b_sensor")
BLOCKS["b_dense_hourly"] = HOURLY.format("b_dense")
HEALTH = f"""
select h.*, coalesce(l.status, 'UNKNOWN') as current_status
from (select *, {KEY.format('machine_id')} as k, {NUM.format('machine_id')} as n from {{0}}) h
left join b_latest l
  on (h.n is not null and l.machine_num is not null and h.n = l.machine_num)
  or ((h.n is null or l.machine_num is null) and h.k = l.machine_key)"""
HEALTH = "select * exclude (k, n) from (" + HEALTH + ")"
BLOCKS["b_health"] = HEALTH.format("b_hourly")
BLOCKS["b_dense_health"] = HEALTH.format("b_dense_hourly")
ROLLING = """
select *,
  avg(avg_temperature) over w3 as rolling_mean_temp_3h,
  coalesce(stddev_pop(avg_temperature) over w3, 0) as rolling_std_temp_3h,
  avg(avg_vibration) over w3 as rolling_mean_vibration_3h,
  coalesce(stddev_pop(avg_vibration) over w3, 0) as rolling_std_vibration_3h,
  coalesce(avg_temperature - lag(avg_temperature) over w, 0) as temp_rate_of_change,
  coalesce(avg_vibration - lag(avg_vibration) over w, 0) as vibration_rate_of_change,
  coalesce((sum(anomaly_events) over w3)::double / nullif((sum(total_events) over w3)::double, 0), 0) as anomaly_rate_3h
from {0}
window w as (partition by machine_id order by hour_ts, current_status),
       w3 as (partition by machine_id order by hour_ts, current_status rows between 2 preceding and current row)"""
BLOCKS["b_rolling"] = ROLLING.format("b_health")
BLOCKS["b_dense_rolling"] = ROLLING.format("b_dense_health")
BASELINE = """
select machine_id, quantile_cont(avg_temperature, 0.95) as machine_temp_p95,
       quantile_cont(avg_vibration, 0.95) as machine_vibration_p95
from {0} group by machine_id"""
BLOCKS["b_baseline"] = BASELINE.format("b_health")
BLOCKS["b_dense_baseline"] = BASELINE.format("b_dense_health")
RISK = """
select *, case when machine_risk_score >= 70 then 'HIGH' when machine_risk_score >= 40 then 'MEDIUM' else 'LOW' end
       as machine_risk_level
from (
  select *, least(100, greatest(0, 35 * temp_threshold_breach + 25 * vibration_threshold_breach
      + case when temp_rate_of_change >= 1.5::double then 15 else 0 end
      + case when vibration_rate_of_change >= 0.25::double then 10 else 0 end
      + case when anomaly_rate_3h >= 0.20::double then 15 when anomaly_rate_3h >= 0.10::double then 8 else 0 end))
      as machine_risk_score
  from (
    select *, case when avg_temperature > temp_threshold_baseline then 1 else 0 end as temp_threshold_breach,
           case when avg_vibration > vibration_threshold_baseline then 1 else 0 end as vibration_threshold_breach
    from (
      select r.*, b.machine_temp_p95, b.machine_vibration_p95,
             case when machine_temp_p95 is not null then greatest(85.0::double, machine_temp_p95) end as temp_threshold_baseline,
             case when machine_vibration_p95 is not null then greatest(2.0::double, machine_vibration_p95) end
               as vibration_threshold_baseline
      from {0} r join {1} b using (machine_id))))"""
BLOCKS["b_risk"] = RISK.format("b_rolling", "b_baseline")
BLOCKS["b_dense_risk"] = RISK.format("b_dense_rolling", "b_dense_baseline")
BLOCKS["b_work_orders"] = """
select date_trunc('day', coalesce(created_at, timestamp '1970-01-01'))::timestamp as order_day, machine_id,
       coalesce(order_status, 'UNKNOWN') as order_status, count(*) as order_count,
       sum(coalesce(target_quantity, 0))::bigint as target_quantity_sum
from b_orders where machine_id is not null group by all"""

# Statuses of several lines that share machine numbers.
BLOCKS["b_fan_raw"] = """
select 'L' || chr((65 + event_id % 4)::int) || '-' || user_id::varchar as machine_id,
       case event_type when 'error' then ' maintenance' when 'view' then 'Idle' else 'RUNNING' end as status,
       ts as last_updated
from events"""
BLOCKS["b_fan_status"] = BLOCKS["b_status"].replace("b_status_raw", "b_fan_raw")
BLOCKS["b_fan_latest"] = BLOCKS["b_latest"].replace("b_status", "b_fan_status")
BLOCKS["b_fan_health"] = BLOCKS["b_health"].replace("b_latest", "b_fan_latest")
BLOCKS["b_fan_rolling"] = ROLLING.format("b_fan_health")
BLOCKS["b_fan_baseline"] = BASELINE.format("b_fan_health")
BLOCKS["b_fan_risk"] = RISK.format("b_fan_rolling", "b_fan_baseline")

FEATURES = ("rolling_mean_temp_3h", "rolling_std_temp_3h", "rolling_mean_vibration_3h", "rolling_std_vibration_3h",
            "temp_rate_of_change", "vibration_rate_of_change", "anomaly_rate_3h")
THRESHOLDS = ("machine_temp_p95", "machine_vibration_p95", "temp_threshold_baseline", "vibration_threshold_baseline")
HEALTH_HEAD = f"hour_ts, machine_id, {rounded('avg_temperature', 'avg_vibration')}, anomaly_events, total_events, current_status"
RISK_LIST = (
    f"{HEALTH_HEAD}, {rounded(*FEATURES, *THRESHOLDS)}, temp_threshold_breach, vibration_threshold_breach, "
    "machine_risk_score, machine_risk_level"
)

ORACLE["stg_sensor_data"] = statement(f"select event_ts, machine_id, {rounded('temperature', 'vibration')} from b_sensor")
ORACLE["stg_machine_status"] = statement("select * from b_status")
ORACLE["stg_work_orders"] = statement("select * from b_orders")
ORACLE["latest_status"] = statement("select machine_key, machine_num::bigint as machine_num, status from b_latest")
ORACLE["machine_health_hourly"] = statement(f"select {HEALTH_HEAD} from b_health")
ORACLE["machine_health_hourly_fanout"] = statement(f"select {HEALTH_HEAD} from b_fan_health")
ORACLE["machine_risk_hourly_fanout"] = statement(f"select {RISK_LIST} from b_fan_risk")
ORACLE["machine_baselines"] = statement(
    f"select machine_id, {rounded('machine_temp_p95', 'machine_vibration_p95')} from b_baseline"
)
ORACLE["rolling_features"] = statement(f"select {HEALTH_HEAD}, {rounded(*FEATURES)} from b_rolling")
ORACLE["machine_risk_hourly"] = statement(f"select {RISK_LIST} from b_risk")
ORACLE["machine_risk_hourly_dense"] = statement(f"select {RISK_LIST} from b_dense_risk")
ORACLE["work_orders_status"] = statement("select * from b_work_orders")

MATCHED = f"""
select distinct m.machine_id from (select distinct machine_id from b_sensor) m join b_latest l
  on {NUM.format('m.machine_id')} = l.machine_num
  or (({NUM.format('m.machine_id')} is null or l.machine_num is null) and {KEY.format('m.machine_id')} = l.machine_key)"""
BLOCKS["b_matched"] = MATCHED
ORACLE["key_coverage"] = statement("""
select (select count(distinct machine_id) from b_sensor) as sensor_keys,
       (select count(*) from b_matched) as matched_keys,
       (select count(distinct machine_id) from b_sensor) - (select count(*) from b_matched) as unmatched_keys""")
ORACLE["backfill_status"] = statement("""
select machine_id, status, status_ts from b_status
union all
select distinct machine_id, 'IDLE', timestamp '2024-02-01' from b_sensor
where machine_id not in (select machine_id from b_matched)""")

# ---- exploratory tables -----------------------------------------------------------------------

ENRICHED = """
select timestamp as event_ts, upper(trim(machine_id)) as machine_id, temperature, vibration,
       case when temperature > 85.0::double or vibration > 2.0::double then 1 else 0 end as anomaly_flag
from {0}"""
BLOCKS["b_enriched"] = ENRICHED.format("b_sensor_raw")
BLOCKS["b_dense_enriched"] = ENRICHED.format("b_dense_raw")
FILLED = """
select g.hour_ts, g.machine_id, o.avg_temperature, o.avg_vibration, coalesce(o.anomaly_events, 0)::bigint as anomaly_events,
       coalesce(o.total_events, 0) as total_events, coalesce(o.anomaly_events / o.total_events, 0)::double as anomaly_flag_rate
from (select machine_id, unnest(generate_series(min(date_trunc('hour', event_ts)::timestamp),
             max(date_trunc('hour', event_ts)::timestamp), interval 1 hour)) as hour_ts
      from {0} group by machine_id) g
left join (select date_trunc('hour', event_ts)::timestamp as hour_ts, machine_id, avg(temperature) as avg_temperature,
                  avg(vibration) as avg_vibration, sum(anomaly_flag)::bigint as anomaly_events, count(*) as total_events
           from {0} group by all) o using (machine_id, hour_ts)"""
BLOCKS["b_filled"] = FILLED.format("b_enriched")
BLOCKS["b_dense_filled"] = FILLED.format("b_dense_enriched")
BLOCKS["b_eda"] = """
select *,
  avg(avg_temperature) over w3 as rolling_mean_temp_3h,
  coalesce(stddev_samp(avg_temperature) over w3, 0) as rolling_std_temp_3h,
  avg(avg_vibration) over w3 as rolling_mean_vib_3h,
  coalesce(stddev_samp(avg_vibration) over w3, 0) as rolling_std_vib_3h,
  coalesce(avg_temperature - lag(avg_temperature) over w, 0) as temp_rate_of_change,
  coalesce(avg_vibration - lag(avg_vibration) over w, 0) as vib_rate_of_change
from b_filled
window w as (partition by machine_id order by hour_ts),
       w3 as (partition by machine_id order by hour_ts rows between 2 preceding and current row)"""
EDA_BASELINE = """
select *, case when machine_temp_p95 is not null then greatest(85.0::double, machine_temp_p95) end as temp_threshold_baseline,
          case when machine_vib_p95 is not null then greatest(2.0::double, machine_vib_p95) end as vib_threshold_baseline
from (select machine_id, quantile_cont(avg_temperature, 0.95) as machine_temp_p95,
             quantile_cont(avg_vibration, 0.95) as machine_vib_p95 from {0} group by machine_id)"""
BLOCKS["b_eda_baseline"] = EDA_BASELINE.format("b_filled")
BLOCKS["b_dense_eda_baseline"] = EDA_BASELINE.format("b_dense_filled")
RUNS = """
select machine_id, breach_start, breach_end, breach_points, max_temp,
       date_diff('microsecond', breach_start, breach_end) / 60000000.0::double as breach_duration_minutes,
       temp_threshold_baseline,
       date_diff('microsecond', breach_start, breach_end) / 60000000.0::double >= 15 as sustained_breach
from (
  select machine_id, seg, min(event_ts) as breach_start, max(event_ts) as breach_end, count(*) as breach_points,
         max(temperature) as max_temp, max(threshold) as temp_threshold_baseline
  from (
    select *, sum(changed) over (partition by machine_id order by event_ts, breach rows unbounded preceding) as seg
    from (
      select *, case when breach <> lag(breach, 1, false) over (partition by machine_id order by event_ts, breach)
                     then 1 else 0 end as changed
      from (
        select e.*, case when b.machine_id is null then 85.0::double else b.temp_threshold_baseline end as threshold,
               coalesce(temperature > threshold, false) as breach
        from {0} e left join {1} b using (machine_id))))
  where breach group by machine_id, seg)"""
BLOCKS["b_runs"] = RUNS.format("b_enriched", "b_eda_baseline")
BLOCKS["b_dense_runs"] = RUNS.format("b_dense_enriched", "b_dense_eda_baseline")
BLOCKS["b_ranking"] = """
select *, case when machine_risk_score >= 70 then 'HIGH' when machine_risk_score >= 40 then 'MEDIUM' else 'LOW' end
       as machine_risk_level
from (
  select *, least(100, greatest(0, 35 * temp_threshold_breach + 25 * vib_threshold_breach
      + case when temp_rate_of_change >= 1.5::double then 15 else 0 end
      + case when vib_rate_of_change >= 0.25::double then 10 else 0 end
      + case when anomaly_flag_rate >= 0.20::double then 15 when anomaly_flag_rate >= 0.10::double then 8 else 0 end))
      as machine_risk_score
  from (
    select e.*, b.* exclude (machine_id),
           case when avg_temperature > temp_threshold_baseline then 1 else 0 end as temp_threshold_breach,
           case when avg_vibration > vib_threshold_baseline then 1 else 0 end as vib_threshold_breach
    from b_eda e left join b_eda_baseline b using (machine_id)
    qualify row_number() over (partition by machine_id order by hour_ts desc) = 1))"""

FILLED_LIST = f"hour_ts, machine_id, {rounded('avg_temperature', 'avg_vibration')}, anomaly_events, total_events, {rounded('anomaly_flag_rate')}"
EDA_FEATURES = ("rolling_mean_temp_3h", "rolling_std_temp_3h", "rolling_mean_vib_3h", "rolling_std_vib_3h",
                "temp_rate_of_change", "vib_rate_of_change")
EDA_THRESHOLDS = ("machine_temp_p95", "machine_vib_p95", "temp_threshold_baseline", "vib_threshold_baseline")
RUN_LIST = (
    "machine_id, breach_start, breach_end, breach_points, "
    f"{rounded('max_temp', 'breach_duration_minutes', 'temp_threshold_baseline')}, sustained_breach"
)

ORACLE["recent_sensor"] = statement(f"""
select timestamp, machine_id, {rounded('temperature', 'vibration')} from b_sensor_raw
where timestamp >= timestamp '2024-01-31' - interval 7 days""")
ORACLE["enrich_sensor"] = statement(
    f"select event_ts, machine_id, {rounded('temperature', 'vibration')}, anomaly_flag from b_enriched"
)
ORACLE["hourly_features_filled"] = statement(f"select {FILLED_LIST} from b_filled")
ORACLE["eda_rolling_features"] = statement(f"select {FILLED_LIST}, {rounded(*EDA_FEATURES)} from b_eda")
ORACLE["eda_baselines"] = statement(f"select machine_id, {rounded(*EDA_THRESHOLDS)} from b_eda_baseline")
ORACLE["sustained_breaches"] = statement(f"select {RUN_LIST} from b_runs")
ORACLE["sustained_breaches_dense"] = statement(f"select {RUN_LIST} from b_dense_runs")
ORACLE["risk_ranking"] = statement(f"""
select {FILLED_LIST}, {rounded(*EDA_FEATURES, *EDA_THRESHOLDS)}, temp_threshold_breach, vib_threshold_breach,
       machine_risk_score, machine_risk_level from b_ranking""")
ORACLE["stored_exploration"] = ORACLE["risk_ranking"].replace(
    "from b_sensor_raw\n)", "from b_sensor_raw where timestamp >= timestamp '2024-01-31' - interval 7 days\n)", 1
)
ORACLE["top_machine"] = statement("""
select machine_id, machine_risk_score, machine_risk_level from b_ranking
order by machine_risk_score desc, avg_temperature desc nulls last, machine_id limit 1""")
MEASURES = ("avg_temperature", "avg_vibration", "anomaly_flag_rate")
ORACLE["correlation_matrix"] = statement(" union all ".join(
    f"select '{a}' as measure_x, '{b}' as measure_y, "
    + r6(f"case when isnan(corr({a}, {b})) then null else corr({a}, {b}) end" if a != b else f"case when stddev_pop({a}) > 0 then 1 end")
    + " as correlation from b_filled"
    for a in MEASURES for b in MEASURES
))
ORACLE["scatter_data"] = statement(f"select machine_id, hour_ts, {rounded(*MEASURES)} from b_filled")
ORACLE["threshold_trend"] = statement(f"""
select hour_ts, machine_id, {rounded('avg_temperature')},
       {r6("coalesce((select temp_threshold_baseline from b_dense_eda_baseline where machine_id = 'D-001'), 85)")} as temp_threshold
from b_dense_filled where machine_id = 'D-001'""")
ORACLE["eda_summary"] = statement(f"""
select (select count(*) from b_enriched) as total_rows, (select sum(anomaly_flag)::bigint from b_enriched) as anomaly_rows,
       {r6("select avg(anomaly_flag) * 100 from b_enriched")} as anomaly_pct,
       (select count(*) from b_runs where sustained_breach) as sustained_count,
       {r6("select corr(avg_temperature, avg_vibration) from b_filled")} as temp_vib_correlation""")
ORACLE["anomalies_by_machine"] = statement("""
select machine_id, sum(case when temperature > 90 or vibration > 2.0 then 1 else 0 end)::bigint as anomaly_events,
       count(*) as total_events from b_sensor group by machine_id""")

# ---- load validation and upserts --------------------------------------------------------------

ORACLE["row_counts"] = statement("""
select 'sensor_data_raw' as table_name, count(*) as row_count from b_sensor_raw
union all select 'machine_status_raw', count(*) from b_status_raw
union all select 'work_orders_raw', count(*) from b_orders_raw""")
ORACLE["freshness"] = statement("""
select 'sensor_data_raw' as table_name, max(timestamp) as latest_event_ts from b_sensor_raw
union all select 'work_orders_raw', max(created_at) from b_orders_raw
union all select 'machine_status_raw', max(last_updated) from b_status_raw""")
ORACLE["latest_sensor_rows"] = statement(f"""
select timestamp, machine_id, {rounded('temperature', 'vibration')} from (
  select * from b_sensor_raw order by timestamp desc nulls first, machine_id, temperature, vibration limit 10)""")
ORACLE["latest_status_rows"] = statement(
    "select * from b_status_raw order by last_updated desc nulls first, machine_id, status limit 10"
)
ORACLE["latest_work_order_rows"] = statement("""
select * from b_orders_raw order by created_at desc nulls first, order_id nulls last, machine_id nulls last,
  product_name nulls last, target_quantity nulls last, order_status nulls last limit 10""")
ORACLE["load_work_orders_raw"] = statement("select * from b_orders_raw")
ORACLE["load_machine_status_raw"] = statement("select * from b_status_raw")
ORACLE["stored_marts"] = ORACLE["machine_risk_hourly"]
BLOCKS["b_before"] = LATEST_STATUS.format("where status_ts < timestamp '2024-01-15'")
BLOCKS["b_after"] = LATEST_STATUS.format("where status_ts >= timestamp '2024-01-15'")
ORACLE["upsert_by_key"] = statement("""
select machine_key, machine_num::bigint as machine_num, status from (
  select * from b_before where machine_key not in (select machine_key from b_after) union all select * from b_after)""")

# ---- dashboard measures -----------------------------------------------------------------------

ORACLE["kpi_availability"] = statement(
    f"select {r6("avg(case when current_status = 'RUNNING' then 1 else 0 end) * 100")} as availability_pct from b_health"
)
ORACLE["kpi_status_coverage"] = statement(
    f"select {r6("avg(case when current_status <> 'UNKNOWN' then 1 else 0 end) * 100")} as status_coverage_pct from b_health"
)
ORACLE["kpi_high_risk_machines"] = statement(
    "select count(distinct machine_id) as high_risk_machines from b_risk where machine_risk_level = 'HIGH'"
)
ORACLE["kpi_avg_risk"] = statement(f"select {r6('avg(machine_risk_score)')} as avg_machine_risk_score from b_risk")
ORACLE["kpi_rows_in_range"] = statement("""
select count(*) as rows_in_range, count(*) filter (machine_risk_level = 'HIGH') as high_rows_in_range from b_risk
where hour_ts >= timestamp '2024-01-10' and hour_ts < timestamp '2024-01-20'""")
ORACLE["kpi_latest"] = statement(f"""
select hour_ts, {r6('avg(avg_temperature)')} as latest_avg_temperature, sum(anomaly_events)::bigint as latest_anomaly_events
from b_health where hour_ts = (select max(hour_ts) from b_health) group by hour_ts""")
ORACLE["status_distribution"] = statement(f"""
select current_status, count(*) as status_rows, {r6('count(*) * 100.0::double / (select count(*) from b_health)')} as share_pct
from b_health group by current_status""")
ORACLE["orders_by_machine_status"] = statement(
    "select machine_id, order_status, sum(order_count)::bigint as order_count from b_work_orders group by all"
)
ORACLE["hourly_trend"] = statement(f"""
select hour_ts, {r6('avg(avg_temperature)')} as avg_temperature, {r6('avg(avg_vibration)')} as avg_vibration
from b_health group by hour_ts""")
ORACLE["risk_by_machine"] = statement(
    "select machine_id, max(machine_risk_score) as machine_risk_score from b_risk group by machine_id"
)
ORACLE["risk_table"] = statement(
    "select machine_id, machine_risk_level, temp_threshold_breach, vibration_threshold_breach from b_risk"
)
BLOCKS["b_hours"] = """
select hour_ts, hour_ts::date as hour_date, year(hour_ts)::int as year, month(hour_ts)::int as month,
       day(hour_ts)::int as day, hour(hour_ts)::int as hour_of_day, isodow(hour_ts)::int as iso_weekday
from (select unnest(generate_series(min(hour_ts), max(hour_ts), interval 1 hour)) as hour_ts from b_hourly)"""
ORACLE["dim_hour"] = statement("select * from b_hours")
ORACLE["with_dim_hour"] = statement(f"""
select hour_ts, machine_id, {rounded('avg_temperature', 'avg_vibration')}, anomaly_events, total_events,
       hour_date, year, month, day, hour_of_day, iso_weekday from b_hourly join b_hours using (hour_ts)""")

# ---- data quality -----------------------------------------------------------------------------

ORACLE["dq_not_null"] = statement("select * from b_orders_raw where created_at is null")
ORACLE["dq_unique"] = statement(
    "select order_id, count(*) as n_records from b_orders_raw where order_id is not null group by order_id having count(*) > 1"
)
ORACLE["dq_unique_health"] = statement(
    "select hour_ts, machine_id, count(*) as n_records from b_health group by all having count(*) > 1"
)
ORACLE["dq_unique_health_fanout"] = statement(
    "select hour_ts, machine_id, count(*) as n_records from b_fan_health group by all having count(*) > 1"
)
ORACLE["dq_accepted_values"] = statement("""
select status as value_field, count(*) as n_records from b_status_raw
where status not in ('RUNNING', 'IDLE', 'MAINTENANCE') group by status""")
ORACLE["dq_score_range"] = statement(f"select {RISK_LIST} from b_risk where machine_risk_score < 0 or machine_risk_score > 100")
ORACLE["dq_not_all_unknown"] = statement("""
select * from (select count(*) as total_rows, count(*) filter (current_status <> 'UNKNOWN') as known_rows from b_health)
where total_rows > 0 and known_rows = 0""")


def _check(check: str, table: str, column: str, failing: str) -> str:
    return f"select '{check}' as check_name, '{table}' as table_name, '{column}' as column_name, ({failing})::bigint as failures"


def _nulls(table: str, block: str, *columns: str) -> list[str]:
    return [_check("not_null", table, c, f"select count(*) from {block} where {c} is null") for c in columns]


ORACLE["run_checks"] = statement(" union all ".join([
    *_nulls("stg_sensor_data", "b_sensor", "event_ts", "machine_id"),
    *_nulls("stg_machine_status", "b_status", "machine_id", "status"),
    *_nulls("stg_work_orders", "b_orders", "order_id", "machine_id"),
    _check("unique", "stg_work_orders", "order_id",
           "select count(*) from (select order_id from b_orders group by order_id having count(*) > 1)"),
    *_nulls("machine_health_hourly", "b_health", "hour_ts", "machine_id"),
    _check("not_all", "machine_health_hourly", "current_status",
           "select case when count(*) > 0 and count(*) filter (current_status <> 'UNKNOWN') = 0 then 1 else 0 end from b_health"),
    *_nulls("work_orders_status", "b_work_orders", "order_day", "machine_id"),
    *_nulls("machine_risk_hourly", "b_risk", "hour_ts", "machine_id", "machine_risk_score", "machine_risk_level"),
    _check("range", "machine_risk_hourly", "machine_risk_score",
           "select count(*) from b_risk where machine_risk_score < 0 or machine_risk_score > 100"),
    _check("accepted_values", "machine_risk_hourly", "machine_risk_level",
           "select count(*) from b_risk where machine_risk_level not in ('LOW', 'MEDIUM', 'HIGH')"),
]))

# ---- messages and live view -------------------------------------------------------------------

STAMP = "strftime({0}, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"
QUOTED = f"""('"' || {MACHINE} || '"')"""
TEMPERATURE, VIBRATION = "(70 + value / 4)::varchar", f"(0.2::double + {K} / 40.0::double)::varchar"
FULL = f"""', "timestamp": "' || {STAMP.format('ts')} || '", "temperature": ' || {TEMPERATURE} || ', "vibration": ' || {VIBRATION}
    || case when ts >= '2024-01-15' then ', "alarm": "a' || {K} || '"' else '' end || '}}'"""
BLOCKS["b_messages"] = f"""
select event_id as arrival, ts as received_at,
  case event_type
    when 'error' then case when {K} < 40 then '{{"machine_id": ' || {QUOTED}
                           when {K} < 70 then '[' || {K} || ']'
                           else '{{"machine_id": ' || {QUOTED} || ', "temperature": "hot"}}' end
    when 'signup' then '{{"machine_id": ' || case when {K} < 50 then '"  "' else {QUOTED} end || {FULL}
    when 'view' then '{{"machine_id": ' || {QUOTED} || ', "temperature": " ' || {TEMPERATURE} || ' ", "vibration": true}}'
    when 'purchase' then '{{"machine_id": ' || {QUOTED} || ', "timestamp": "not a time", "temperature": ' || {TEMPERATURE}
                         || ', "vibration": null}}'
    else '{{"machine_id": ' || {QUOTED} || {FULL} end as body
from events"""
BLOCKS["b_parsed"] = """
select *, case when not json_valid(body) then 'invalid_json' when json_type(body) <> 'OBJECT' then 'non_object_json' end as parse_error,
       case when json_valid(body) then body::json end as j
from b_messages"""


def _number(field: str) -> str:
    return f"""case json_type(j, '$.{field}') when 'NULL' then 0.0::double
        when 'BOOLEAN' then case when json_extract_string(j, '$.{field}') = 'true' then 1.0::double else 0.0::double end
        when 'VARCHAR' then case when trim(json_extract_string(j, '$.{field}')) = '' then 0.0::double
                                 else try_cast(trim(json_extract_string(j, '$.{field}')) as double) end
        when 'OBJECT' then null when 'ARRAY' then null
        else try_cast(json_extract_string(j, '$.{field}') as double) end"""


BLOCKS["b_validated"] = f"""
select *, machine_id is not null and temperature is not null and vibration is not null as is_valid
from (
  select arrival, nullif(trim(json_extract_string(j, '$.machine_id')), '') as machine_id,
         case when try_cast(json_extract_string(j, '$.timestamp') as timestamptz) is not null
              then json_extract_string(j, '$.timestamp') else {STAMP.format('received_at')} end as timestamp,
         {_number('temperature')} as temperature, {_number('vibration')} as vibration
  from b_parsed)"""
BLOCKS["b_live"] = """
select arrival, machine_id, timestamp, temperature, vibration from b_validated where is_valid
qualify row_number() over (partition by machine_id order by arrival desc) = 1"""
PAYLOAD_LIST = f"arrival, machine_id, timestamp, {rounded('temperature', 'vibration')}"

ORACLE["parse_messages"] = statement("""
select arrival, parse_error, case when parse_error is not null then body end as raw_message, parse_error is null as is_object
from b_parsed""")
ORACLE["validate_payload"] = statement(f"select {PAYLOAD_LIST}, is_valid from b_validated")
ORACLE["rejected_payloads"] = statement(f"""
select v.arrival, machine_id, {rounded('temperature', 'vibration')}, parse_error
from b_validated v join b_parsed p on v.arrival = p.arrival where not is_valid""")
ORACLE["latest_per_machine"] = statement(f"select {PAYLOAD_LIST} from b_live")
ORACLE["recent_messages"] = statement(
    f"select {PAYLOAD_LIST} from b_validated where is_valid order by arrival desc limit 100"
)


def _fixed2(value: str) -> str:
    """Two decimals of the exact binary value, halves up."""
    return f"round(printf('%.20f', {value})::decimal(38, 20), 2)::decimal(18, 2)::varchar"


ORACLE["dashboard_rows"] = statement(f"""
select machine_id, case when temperature >= 90 then 'hot' else 'ok' end as temperature_class,
       {_fixed2('temperature')} as temperature_text, {_fixed2('vibration')} as vibration_text, timestamp
from b_live""")

# ---- streams ----------------------------------------------------------------------------------

ORACLE["land_stream"] = statement(f"""
select timestamp, machine_id, {rounded('temperature', 'vibration')}
from (
  select try_cast(json_extract_string(o, '$.timestamp') as timestamp) as timestamp, json_extract_string(o, '$.machine_id') as machine_id,
         try_cast(trim(json_extract_string(o, '$.temperature')) as double) as temperature,
         case when json_type(o, '$.vibration') <> 'BOOLEAN' then try_cast(json_extract_string(o, '$.vibration') as double) end as vibration
  from (select case when parse_error is null then j end as o from b_parsed))""")
ORACLE["land_stream_csv"] = statement(f"""
select parse_error, case when parse_error is not null then body end as raw_message, json_extract_string(o, '$.machine_id') as machine_id,
       json_extract_string(o, '$.timestamp') as timestamp, json_extract_string(o, '$.alarm') as alarm,
       {r6("try_cast(trim(json_extract_string(o, '$.temperature')) as double)")} as temperature,
       case json_extract_string(o, '$.vibration') when 'true' then 'True' else json_extract_string(o, '$.vibration') end as vibration_text
from (select *, case when parse_error is null then j end as o from b_parsed)""")
ORACLE["landed_records"] = statement("""
select year(received_at)::int as year, month(received_at)::int as month, day(received_at)::int as day,
       json_extract_string(o, '$.machine_id') as machine_id, json_extract_string(o, '$.alarm') as alarm, parse_error,
       case when parse_error is not null then body end as raw_message
from (select *, case when parse_error is null then j end as o from b_parsed)""")
ORACLE["incremental_load"] = statement(f"""
select timestamp, machine_id, {rounded('temperature', 'vibration')} from b_sensor_raw""")
ORACLE["stream_latest_per_machine"] = ORACLE["latest_per_machine"]
ORACLE["stream_counters"] = statement("""
select count(*) filter (is_valid) as total_received, count(*) filter (not is_valid) as total_rejected,
       count(*) filter (is_valid) as total_published, count(distinct machine_id) filter (is_valid) as machine_count
from b_validated""")
ORACLE["stream_health_hourly"] = statement(f"""
select hour_ts, machine_id, {rounded('avg_temperature', 'avg_vibration')}, anomaly_events, total_events from b_hourly
where hour_ts + interval 1 hour <= (select max(event_ts) from b_sensor) - interval 2 hours""")
ORACLE["ingest_cycles"] = statement("""
select 'sensor_data_raw' as table_name, count(*) as row_count, count(distinct machine_id) as machines, max(timestamp) as newest from b_sensor_raw
union all
select 'work_orders_raw', 2 * count(*), count(distinct machine_id), max(created_at) from b_orders_raw
union all
select 'machine_status_raw', 2 * count(*), count(distinct machine_id), max(last_updated) from b_status_raw""")
ORACLE["models_through_views"] = statement("""
select machine_id, machine_risk_level, count(*) as risk_rows, sum(h.anomaly_events)::bigint as anomaly_events
from b_risk r join b_health h using (hour_ts, machine_id) group by machine_id, machine_risk_level""")
ORACLE["written_artifacts"] = ORACLE["stored_exploration"]
ORACLE["refresh_marts"] = ORACLE["machine_risk_hourly"]

# ---- kept tables and summaries ----------------------------------------------------------------

BATCH_DAYS = (4, 5, 12, 20, 31)


def _batch(late: bool) -> str:
    on_time = " + ".join(f"(day(ts) > {d})::int" for d in BATCH_DAYS[:-1])
    return f"least({len(BATCH_DAYS) - 1}, {on_time} + (event_id % 16 = 0)::int)" if late else on_time


ORACLE["load_split_csv"] = statement("""
select order_id, machine_id, case when target_quantity % 5 = 0 then product_name || chr(10) || '"and", ' || machine_id || chr(10)
                                  else product_name end as product_name, target_quantity, order_status, created_at
from b_orders_raw""")
ORACLE["upsert_table"] = ORACLE["upsert_by_key"]
ORACLE["default_now"] = statement("""
select order_status, count(*) as order_rows, count(*) as timed_rows, count(*) filter (created_at is null) as defaulted_rows
from b_orders_raw group by order_status""")
ORACLE["sketch_quantiles"] = statement("""
select machine_id, count(temperature) as temperature_n, count(vibration) as vibration_n, true as temperature_within, true as vibration_within
from b_dense group by machine_id""")
ORACLE["sketch_machines"] = statement("""
select day(event_ts) > 15 as second_half, count(distinct machine_id) as exact_machines, true as within from b_sensor group by 1""")
ORACLE["machine_baselines_approx"] = statement(f"""
select machine_id, {r6("quantile_disc(avg_temperature, 0.95)")} as machine_temp_p95, {r6("quantile_disc(avg_vibration, 0.95)")} as machine_vibration_p95
from b_hourly group by machine_id""")
ORACLE["kpi_high_risk_machines_approx"] = statement("""
select count(distinct machine_id) filter (machine_risk_level = 'HIGH') as high_risk_machines, true as within from b_risk""")
ORACLE["orders_pivot"] = statement("""
select machine_id, coalesce(sum(order_count) filter (order_status = 'OPEN'), 0)::bigint as "OPEN",
       coalesce(sum(order_count) filter (order_status = 'IN_PROGRESS'), 0)::bigint as "IN_PROGRESS"
from b_work_orders group by machine_id""")
ORACLE["read_messages"] = statement("""
select case when parse_error is not null then body end as raw_message, parse_error, count(*) as messages from b_parsed group by all""")
ORACLE["land_csv_retried"] = statement("""
select json_extract_string(o, '$.machine_id') as machine_id, json_extract_string(o, '$.timestamp') as timestamp, parse_error, count(*) as messages
from (select *, case when parse_error is null then j end as o from b_parsed) group by all""")
ORACLE["load_ledger"] = statement("""
select day(received_at)::int as day, count(*) filter (parse_error is null) as rows_loaded,
       count(*) filter (parse_error is not null) as rows_rejected,
       arg_min(left(body, 200), arrival) filter (parse_error is not null) as first_error
from b_parsed group by 1""")
ORACLE["stream_recent_messages"] = ORACLE["recent_messages"]
ORACLE["stream_latest_expiring"] = statement(f"""
select {PAYLOAD_LIST} from b_live join (select event_id, ts from events) on event_id = arrival
where ts >= (select max(ts) from events join b_validated on event_id = arrival where is_valid) - interval 3 days""")
BLOCKS["b_placed"] = f"""
select e.event_id, e.ts, {_batch(late=True)} as batch, date_trunc('hour', e.ts)::timestamp as hour_ts, temperature, vibration,
       nullif(regexp_replace(upper(trim(r.machine_id)), '[^A-Z0-9-]', '', 'g'), '') as machine_id
from events e join b_sensor_raw r on r.arrival = e.event_id"""
BLOCKS["b_marks"] = """
select b.batch, max(p.ts) - interval 36 hours as watermark
from (select distinct batch from b_placed) b join b_placed p on p.batch < b.batch group by b.batch"""
ORACLE["stream_late_readings"] = statement(f"""
select hour_ts, machine_id, kind, {rounded('avg_temperature', 'avg_vibration')}, anomaly_events, total_events
from (
  select hour_ts, machine_id, case when hour_ts + interval 1 hour <= m.watermark then 'late'
                                   when hour_ts + interval 1 hour <= (select max(ts) from events) - interval 36 hours then 'closed' else 'open' end as kind,
         avg(temperature) as avg_temperature, avg(vibration) as avg_vibration,
         sum(case when temperature > 90 or vibration > 2.0 then 1 else 0 end)::bigint as anomaly_events, count(*) as total_events
  from b_placed left join b_marks m using (batch) where machine_id is not null and ts is not null group by all)""")


def _admitted(records: int = 400, hours: int = 12) -> str:
    """Batch by batch: how many rows have been flushed, then what the batch flushes."""
    steps = [f"""
ordered as (
    select event_id, ts, row_number() over (order by ts, event_id) as n, {_batch(late=False)} as batch from events
), s0 as (select 0::bigint as done, 0::bigint as flushes, 0::bigint as full_to, false as aged)"""]
    for n in range(len(BATCH_DAYS)):
        steps.append(f"""
t{n} as (select count(*) as upto, max(ts) as now from ordered where batch <= {n}
), u{n} as (select done, flushes, upto, now, done + (upto - done) // {records} * {records} as full_to from s{n}, t{n}
), s{n + 1} as (
    select case when aged then upto else full_to end as done, flushes + (full_to - done) // {records} + aged::int as flushes, full_to, aged,
           done as was, flushes as first_flush
    from (select *, upto > full_to and now - (select ts from ordered where n = full_to + 1) >= interval {hours} hours as aged from u{n})
)""")
    out = " union all ".join(f"""
select first_flush + least((n - was - 1) // {records}, (full_to - was) // {records}) as flush,
       case when n > full_to then 'age' else 'records' end as reason, ts, event_id
from ordered, s{n + 1} where n > was and n <= done""" for n in range(len(BATCH_DAYS)))
    return "with " + ",".join(steps) + f"""
select flush::bigint as flush, reason, count(*) as records, min(ts) as first_ts, max(ts) as last_ts, sum(event_id)::bigint as event_ids
from ({out}) group by flush, reason"""


ORACLE["admitted_batches"] = _admitted()
