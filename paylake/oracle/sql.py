"""DuckDB SQL per registered query.

Every statement starts from the same text that derives the raw transactions from
``events``; all after that is written independently of the Spark plans. Decimals are
shown as double, dates and lists as text, as in the registered queries.
"""

from __future__ import annotations

from paylake.adapter import LANDING_FROM_RAW, RAW_FROM_EVENTS

RAW = f"raw_upi_transactions as ({RAW_FROM_EVENTS})"
LANDING = f"landing as ({LANDING_FROM_RAW})"


def staging(name: str = "stg", source: str = "raw_upi_transactions", where: str = "true") -> str:
    return f"""
{name} as (
  select trim(txn_id) as txn_id, trim(upi_ref) as upi_ref,
    lower(trim(sender_vpa)) as sender_vpa, lower(trim(receiver_vpa)) as receiver_vpa,
    ifnull(amount, 0)::decimal(15,2) as amount_inr,
    ifnull(upper(trim(currency)), 'INR') as currency,
    case when upper(trim(status)) in ('SUCCESS', 'COMPLETED') then 'SUCCESS'
         when upper(trim(status)) in ('FAILED', 'FAILURE', 'ERROR') then 'FAILED'
         when upper(trim(status)) = 'PENDING' then 'PENDING'
         when upper(trim(status)) in ('REVERSED', 'REFUNDED') then 'REVERSED'
         else 'UNKNOWN' end as status,
    txn_timestamp, txn_timestamp::date as txn_date,
    date_part('hour', txn_timestamp)::bigint as txn_hour,
    date_part('dow', txn_timestamp)::bigint as txn_dow,
    date_part('dow', txn_timestamp) in (0, 6) as is_weekend,
    upi_ref is not null as is_upi,
    ifnull(amount > 50000, false) as is_high_value,
    date_part('hour', txn_timestamp) < 6 as is_off_hours,
    nullif(lower(trim(regexp_extract(sender_vpa, '[^@]+$'))), '') as sender_bank,
    nullif(lower(trim(regexp_extract(receiver_vpa, '[^@]+$'))), '') as receiver_bank,
    upper(trim(device_type)) as device_type, trim(device_id) as device_id, trim(ip_address) as ip_address,
    array_to_string(list_transform(regexp_extract_all(lower(trim(city)), '[a-z0-9]+|[^a-z0-9]+'),
                                   lambda w: upper(w[1]) || w[2:]), '') as city,
    trim(remarks) as remarks, ingested_at, _source
  from (
    select * from {source} where {where} and txn_id is not null
    qualify row_number() over (
      partition by trim(txn_id)
      order by txn_timestamp desc nulls first, upi_ref nulls last, sender_vpa nulls last, receiver_vpa nulls last,
        amount nulls last, currency nulls last, status nulls last, device_type nulls last, device_id nulls last,
        ip_address nulls last, city nulls last, remarks nulls last, ingested_at nulls last, _source_date, _source, txn_id) = 1
  ) where txn_timestamp is not null
)"""


ENRICHED = """
enriched as (
  select s.*,
    case when amount_inr < 100 then 'MICRO' when amount_inr < 1000 then 'SMALL' when amount_inr < 10000 then 'MEDIUM'
         when amount_inr < 50000 then 'LARGE' else 'HIGH_VALUE' end as txn_size_bucket,
    sender_bank <> receiver_bank as is_cross_bank,
    sender_bank = receiver_bank and substr(sender_vpa, 1, 3) = substr(receiver_vpa, 1, 3) as is_self_transfer,
    ['NIGHT', 'MORNING', 'AFTERNOON', 'EVENING'][txn_hour // 6 + 1] as day_part,
    is_high_value and is_off_hours as is_suspicious,
    month(txn_date)::bigint as txn_month, weekofyear(txn_date)::bigint as txn_week, year(txn_date)::bigint as txn_year,
    row_number() over (partition by sender_vpa order by txn_timestamp, txn_id)::bigint as sender_lifetime_rank,
    row_number() over (partition by sender_vpa, txn_date order by txn_timestamp, txn_id)::bigint as sender_daily_rank
  from stg s
)"""

# Rules two and three as joins against grouped counts, one branch per rule.
SIGNALS = """
flagged as (
  select txn_id, 'HIGH_VALUE_OFF_HOURS' as signal_type, 0.85 as signal_score, 'amount > 50K AND hour 0-5' as signal_reason
  from enriched where is_suspicious
  union all
  select e.txn_id, 'RAPID_REPEAT_SENDER', 0.75, 'sender sent ' || n || ' txns in 1 hour'
  from enriched e join (select sender_vpa, txn_date, txn_hour, count(*) as n from enriched group by all) h
    using (sender_vpa, txn_date, txn_hour) where n >= 3
  union all
  select e.txn_id, 'ALWAYS_FAILED_SENDER', 0.70, '100% failure rate sender (≥5 daily txns)'
  from enriched e join (select sender_vpa, txn_date from enriched group by all
                        having count(*) >= 5 and bool_and(status = 'FAILED')) d using (sender_vpa, txn_date)
  union all
  select txn_id, 'HIGH_VALUE_REVERSAL', 0.65, 'Reversed transaction with amount > 50K'
  from enriched where is_high_value and status = 'REVERSED'
  union all
  select txn_id, 'CROSS_BANK_HIGH_VALUE', 0.60, 'High-value cross-bank transfer'
  from enriched where is_high_value and status = 'SUCCESS' and is_cross_bank
),
signals as (
  select e.txn_id, sender_vpa, txn_date, amount_inr, txn_timestamp, signal_type, signal_score::decimal(3,2) as signal_score,
    signal_reason, least(signal_score, 1.0)::decimal(3,2) as capped_score
  from flagged join enriched e using (txn_id)
)"""

SCORES = """
scores as (
  select *, least(total_raw_score, 1.0)::decimal(3,2) as fraud_score,
    case when total_raw_score >= 0.8 then 'CRITICAL' when total_raw_score >= 0.5 then 'HIGH'
         when total_raw_score >= 0.2 then 'MEDIUM' else 'LOW' end as fraud_risk_tier
  from (select txn_id, sender_vpa, txn_timestamp, sum(signal_score) as total_raw_score,
          count(*)::bigint as signals_triggered, array_to_string(list_sort(list(signal_type)), ',') as triggered_rules
        from signals group by all)
)"""

SUMMARY = """
fraud_summary as (
  select txn_date, signal_type, count(*)::bigint as flagged_txn_count,
    count(distinct sender_vpa)::bigint as unique_flagged_senders,
    sum(amount_inr) as total_flagged_amount_inr, sum(amount_inr)::double / count(*) as avg_flagged_amount_inr,
    max(amount_inr) as max_flagged_amount_inr, sum(signal_score)::double / count(*) as avg_signal_score,
    max(signal_score) as max_signal_score, min(txn_timestamp) as earliest_flag_ts, max(txn_timestamp) as latest_flag_ts,
    any_value(day_total_txns)::bigint as day_total_txns, count(*)::double / any_value(day_total_txns) as signal_rate
  from signals join (select txn_date, count(*) as day_total_txns from stg group by all) using (txn_date)
  group by all
)"""

DAILY = """
daily as (
  select txn_date, sender_bank, receiver_bank, status, device_type, day_part, is_weekend,
    count(*)::bigint as txn_count, sum(amount_inr) as total_amount_inr,
    sum(amount_inr)::double / count(*) as avg_amount_inr,
    quantile_cont(amount_inr::double, 0.5)::decimal(18,3) as median_amount_inr,
    max(amount_inr) as max_amount_inr, min(amount_inr) as min_amount_inr,
    (count(*) filter (status = 'SUCCESS'))::bigint as success_count, (count(*) filter (status = 'FAILED'))::bigint as failed_count,
    (count(*) filter (status = 'PENDING'))::bigint as pending_count, (count(*) filter (status = 'REVERSED'))::bigint as reversed_count,
    (count(*) filter (is_high_value))::bigint as high_value_count, (count(*) filter (is_off_hours))::bigint as off_hours_count,
    (count(*) filter (is_suspicious))::bigint as suspicious_count, (count(*) filter (is_cross_bank))::bigint as cross_bank_count,
    count(distinct sender_vpa)::bigint as unique_senders, count(distinct receiver_vpa)::bigint as unique_receivers,
    count(distinct city)::bigint as cities_active,
    (count(*) filter (txn_size_bucket = 'MICRO'))::bigint as micro_count, (count(*) filter (txn_size_bucket = 'SMALL'))::bigint as small_count,
    (count(*) filter (txn_size_bucket = 'MEDIUM'))::bigint as medium_count, (count(*) filter (txn_size_bucket = 'LARGE'))::bigint as large_count,
    (count(*) filter (txn_size_bucket = 'HIGH_VALUE'))::bigint as high_value_bucket_count,
    success_count::double / txn_count as success_rate, failed_count::double / txn_count as failure_rate,
    suspicious_count::double / txn_count as risk_rate
  from enriched group by 1, 2, 3, 4, 5, 6, 7
)"""

ACTIVITY = """
activity as (
  select sender_vpa, txn_date, sender_bank,
    count(*)::bigint as daily_txn_count, sum(amount_inr) as daily_total_inr,
    sum(amount_inr)::double / count(*) as daily_avg_inr, max(amount_inr) as daily_max_inr,
    count(distinct receiver_vpa)::bigint as daily_unique_payees, count(distinct device_type)::bigint as device_types_used,
    count(distinct city)::bigint as cities_used,
    (count(*) filter (status = 'SUCCESS'))::bigint as success_count, (count(*) filter (status = 'FAILED'))::bigint as failed_count,
    (count(*) filter (status = 'REVERSED'))::bigint as reversed_count,
    (count(*) filter (is_high_value))::bigint as high_value_count, (count(*) filter (is_off_hours))::bigint as off_hours_count,
    (count(*) filter (is_suspicious))::bigint as suspicious_count, (count(*) filter (is_cross_bank))::bigint as cross_bank_count,
    min(txn_timestamp) as first_txn_ts, max(txn_timestamp) as last_txn_ts,
    date_diff('minute', min(txn_timestamp), max(txn_timestamp))::bigint as activity_span_minutes,
    success_count::double / daily_txn_count as daily_success_rate, failed_count::double / daily_txn_count as daily_failure_rate,
    suspicious_count::double / daily_txn_count as daily_risk_score
  from enriched group by 1, 2, 3
)"""

HOME_CITY = """
home_city as (
  select sender_vpa, city as home_city from (select sender_vpa, city, count(*) as n from {source} where city is not null and {where} group by all)
  qualify row_number() over (partition by sender_vpa order by n desc, city) = 1
)"""

DEVICE = """
primary_device as (
  select sender_vpa, device_type as primary_device_type
  from (select sender_vpa, device_type, count(*) as n from {source} where {where} group by all)
  qualify row_number() over (partition by sender_vpa order by n desc, device_type nulls last) = 1
)"""


def customers(name: str = "customers", source: str = "enriched", where: str = "true") -> str:
    home, device = HOME_CITY.format(source=source, where=where), DEVICE.format(source=source, where=where)
    return f"""
{name} as (
  with {home}, {device},
  profile as (
    select sender_vpa, sender_bank as primary_bank,
      min(txn_date) as first_txn_date, max(txn_date) as last_txn_date, count(distinct txn_date)::bigint as active_days,
      count(*)::bigint as total_txns, sum(amount_inr) as total_spend_inr,
      sum(amount_inr)::double / count(*) as avg_txn_amount_inr, max(amount_inr) as max_single_txn_inr,
      count(distinct receiver_vpa)::bigint as unique_payees, count(distinct city)::bigint as cities_transacted,
      (count(*) filter (status = 'SUCCESS'))::bigint as success_count, (count(*) filter (status = 'FAILED'))::bigint as failed_count,
      (count(*) filter (status = 'REVERSED'))::bigint as reversed_count,
      (count(*) filter (is_high_value))::bigint as high_value_count, (count(*) filter (is_off_hours))::bigint as off_hours_count,
      (count(*) filter (is_suspicious))::bigint as suspicious_txn_count
    from {source} where {where} group by 1, 2
  )
  select p.*,
    case when total_spend_inr >= 1000000 then 'PLATINUM' when total_spend_inr >= 100000 then 'GOLD'
         when total_spend_inr >= 10000 then 'SILVER' else 'BRONZE' end as customer_tier,
    success_count::double / total_txns as success_rate, failed_count::double / total_txns as failure_rate,
    home_city, primary_device_type
  from profile p left join home_city using (sender_vpa) left join primary_device using (sender_vpa)
)"""


# Versions as islands of equal tracked attributes over the three snapshot days.
VERSIONS = f"""
{customers("c1", where="txn_date <= date '2024-01-10'")},
{customers("c2", where="txn_date <= date '2024-01-20'")},
{customers("c3", where="txn_date <= date '2024-01-31'")},
snapshots as (
  select *, timestamp '2024-01-10 00:00:00' as snap_ts from c1 union all by name
  select *, timestamp '2024-01-20 00:00:00' as snap_ts from c2 union all by name
  select *, timestamp '2024-01-31 00:00:00' as snap_ts from c3
),
opened as (
  select * from snapshots
  window w as (partition by sender_vpa order by snap_ts)
  qualify row_number() over w = 1
    or lag(primary_bank) over w is distinct from primary_bank or lag(customer_tier) over w is distinct from customer_tier
    or lag(home_city) over w is distinct from home_city
    or lag(primary_device_type) over w is distinct from primary_device_type
),
versions as (
  select * exclude (snap_ts), md5(sender_vpa || '|' || strftime(snap_ts, '%Y-%m-%d %H:%M:%S')) as dbt_scd_id,
    snap_ts as dbt_updated_at, snap_ts as dbt_valid_from, lead(snap_ts) over (partition by sender_vpa order by snap_ts) as dbt_valid_to
  from opened
),
dim as (
  select sender_vpa as customer_vpa, primary_bank, first_txn_date, last_txn_date, total_txns, total_spend_inr,
    customer_tier, home_city, primary_device_type, success_rate, failure_rate,
    dbt_valid_from as valid_from, dbt_valid_to as valid_to, dbt_valid_to is null as is_current
  from versions
)"""


def fact(where: str) -> str:
    return f"""
fact as (
  select e.*, d.customer_tier, d.total_txns as customer_lifetime_txns, d.total_spend_inr as customer_lifetime_spend
  from enriched e left join (select * from dim where {where}) d on d.customer_vpa = e.sender_vpa
)"""


# Versions over a snapshot on each of thirty days: each day's profiles from the transactions up to it.
RANGE_VERSIONS = """
days as (select unnest(generate_series(date '2024-01-01', date '2024-01-30', interval 1 day))::date as day),
upto as (select day, e.* from days join enriched e on e.txn_date <= day),
cities as (
  select day, sender_vpa, city as home_city from (select day, sender_vpa, city, count(*) as n from upto where city is not null group by all)
  qualify row_number() over (partition by day, sender_vpa order by n desc, city) = 1),
devices as (
  select day, sender_vpa, device_type as primary_device_type
  from (select day, sender_vpa, device_type, count(*) as n from upto group by all)
  qualify row_number() over (partition by day, sender_vpa order by n desc, device_type nulls last) = 1),
daily_profiles as (
  select day, sender_vpa, sender_bank as primary_bank,
    min(txn_date) as first_txn_date, max(txn_date) as last_txn_date, count(distinct txn_date)::bigint as active_days,
    count(*)::bigint as total_txns, sum(amount_inr) as total_spend_inr,
    sum(amount_inr)::double / count(*) as avg_txn_amount_inr, max(amount_inr) as max_single_txn_inr,
    count(distinct receiver_vpa)::bigint as unique_payees, count(distinct city)::bigint as cities_transacted,
    (count(*) filter (status = 'SUCCESS'))::bigint as success_count, (count(*) filter (status = 'FAILED'))::bigint as failed_count,
    (count(*) filter (status = 'REVERSED'))::bigint as reversed_count,
    (count(*) filter (is_high_value))::bigint as high_value_count, (count(*) filter (is_off_hours))::bigint as off_hours_count,
    (count(*) filter (is_suspicious))::bigint as suspicious_txn_count
  from upto group by 1, 2, 3),
states as (
  select p.*, case when total_spend_inr >= 1000000 then 'PLATINUM' when total_spend_inr >= 100000 then 'GOLD'
         when total_spend_inr >= 10000 then 'SILVER' else 'BRONZE' end as customer_tier,
    success_count::double / total_txns as success_rate, failed_count::double / total_txns as failure_rate,
    home_city, primary_device_type
  from daily_profiles p left join cities using (day, sender_vpa) left join devices using (day, sender_vpa)),
changed as (
  select * from states window w as (partition by sender_vpa order by day)
  qualify row_number() over w = 1
    or lag(primary_bank) over w is distinct from primary_bank or lag(customer_tier) over w is distinct from customer_tier
    or lag(home_city) over w is distinct from home_city or lag(primary_device_type) over w is distinct from primary_device_type),
range_versions as (
  select * exclude (day), md5(sender_vpa || '|' || strftime(day, '%Y-%m-%d %H:%M:%S')) as dbt_scd_id,
    day::timestamp as dbt_updated_at, day::timestamp as dbt_valid_from,
    (lead(day) over (partition by sender_vpa order by day))::timestamp as dbt_valid_to
  from changed)"""

AS_OF = """
select txn_id, e.sender_vpa, txn_date, txn_timestamp, amount_inr, status, dbt_valid_from as version_from, customer_tier,
  total_txns as customer_lifetime_txns, total_spend_inr as customer_lifetime_spend
from enriched e left join (select sender_vpa, dbt_valid_from, dbt_valid_to, customer_tier, total_txns, total_spend_inr from range_versions) v
  on v.sender_vpa = e.sender_vpa and dbt_valid_from <= txn_timestamp and (dbt_valid_to is null or txn_timestamp < dbt_valid_to)"""

# Seconds as whole numbers; a transaction sees those of its own second and the 300 before.
VELOCITY = """
timed as (select *, epoch(date_trunc('second', txn_timestamp))::bigint as second from enriched),
velocity as (
  select txn_id, sender_vpa, txn_date, txn_timestamp, amount_inr, is_high_value,
    (select count(*) from timed o where o.sender_vpa = t.sender_vpa and o.second between t.second - 300 and t.second)::bigint as sender_5min_txns,
    (select sum(amount_inr) from timed o where o.sender_vpa = t.sender_vpa and o.second between t.second - 300 and t.second) as sender_5min_amount_inr,
    receiver_vpa is not null and not exists (
      select 1 from timed o where o.sender_vpa = t.sender_vpa and o.receiver_vpa = t.receiver_vpa and (o.txn_timestamp, o.txn_id) < (t.txn_timestamp, t.txn_id)) as is_new_payee,
    city is not null and not exists (
      select 1 from timed o where o.sender_vpa = t.sender_vpa and o.city = t.city and (o.txn_timestamp, o.txn_id) < (t.txn_timestamp, t.txn_id)) as is_new_city
  from timed t)"""


def statement(*ctes: str, select: str, double: tuple[str, ...] = (), text: tuple[str, ...] = ()) -> str:
    """Put the parts together; ``double`` and ``text`` name the columns shown as such."""
    shown = [f"{c}::double as {c}" for c in double] + [f"{c}::varchar as {c}" for c in text]
    outer = f"select * replace ({', '.join(shown)})" if shown else "select *"
    return f"with {', '.join(ctes)}\n{outer} from ({select})"


CHECKS = {
    "not_null": "count(*) filter ({c} is null)",
    "accepted_values": "count(*) filter ({c} not in ({values}))",
    "assert_positive": "count(*) filter ({c} < 0)",
    "no_negative": "count(*) filter ({c} < 0)",
    "no_future": "count(*) filter ({c} > timestamp '2024-02-01 00:00:00')",
    "unique": "(select count(*) from (select {c} from {t} where {c} is not null group by 1 having count(*) > 1))",
}


# The declared checks, written down apart from the engine's list: relation, severity, check, columns, values.
DECLARED = (
    ("raw_upi_transactions", "error", "not_null", "txn_id txn_timestamp", ""),
    ("raw_upi_transactions", "error", "unique", "txn_id", ""),
    ("raw_upi_transactions", "warn", "accepted_values", "status", "SUCCESS FAILED PENDING REVERSED"),
    ("stg_upi_transactions", "error", "not_null", "txn_id amount_inr status sender_vpa receiver_vpa txn_date sender_bank receiver_bank", ""),
    ("stg_upi_transactions", "error", "unique", "txn_id", ""),
    ("stg_upi_transactions", "error", "accepted_values", "status", "SUCCESS FAILED PENDING REVERSED UNKNOWN"),
    ("stg_upi_transactions", "error", "no_negative", "amount_inr", ""),
    ("stg_upi_transactions", "error", "no_future", "txn_timestamp", ""),
    ("fct_transactions", "error", "not_null", "txn_id sender_vpa receiver_vpa txn_date", ""),
    ("fct_transactions", "error", "unique", "txn_id", ""),
    ("fct_transactions", "error", "assert_positive", "amount_inr", ""),
    ("fct_transactions", "error", "accepted_values", "status", "SUCCESS FAILED PENDING REVERSED UNKNOWN"),
    ("fct_transactions", "error", "accepted_values", "txn_size_bucket", "MICRO SMALL MEDIUM LARGE HIGH_VALUE"),
    ("fct_daily_summary", "error", "not_null", "txn_date", ""),
    ("fct_daily_summary", "error", "assert_positive", "txn_count", ""),
    ("dim_customers", "error", "not_null", "customer_vpa primary_bank first_txn_date last_txn_date", ""),
    ("dim_customers", "error", "unique", "customer_vpa", ""),
    ("dim_customers", "error", "assert_positive", "total_txns", ""),
    ("dim_customers", "error", "accepted_values", "customer_tier", "BRONZE SILVER GOLD PLATINUM"),
    ("fct_customer_activity", "error", "not_null", "sender_vpa txn_date", ""),
    ("fct_customer_activity", "error", "assert_positive", "daily_txn_count", ""),
    ("fct_fraud_signals", "error", "not_null", "txn_id signal_type signal_reason sender_vpa txn_date", ""),
    ("fct_fraud_signals", "error", "accepted_values", "signal_type",
     "HIGH_VALUE_OFF_HOURS RAPID_REPEAT_SENDER ALWAYS_FAILED_SENDER HIGH_VALUE_REVERSAL CROSS_BANK_HIGH_VALUE"),
    ("fct_fraud_summary", "error", "not_null", "txn_date signal_type", ""),
    ("fct_fraud_summary", "error", "assert_positive", "flagged_txn_count", ""),
)


def rule_counts(tables: dict[str, str]) -> str:
    rows = []
    for relation, severity, check, columns, values in DECLARED:
        for column in columns.split():
            listed = ", ".join(f"'{v}'" for v in values.split())
            count = CHECKS[check].format(c=column, t=tables[relation], values=listed)
            rows.append(f"select '{relation}' as relation, '{column}' as column_name, '{check}' as check_name, "
                        f"'{severity}' as severity, {'any_value' if check == 'unique' else ''}({count})::bigint as failures "
                        f"from {tables[relation]}")
    return "\nunion all ".join(rows)


STG = staging()
TO_ENRICHED = (RAW, STG, ENRICHED)
TO_SIGNALS = (*TO_ENRICHED, SIGNALS)
SIGNAL_DOUBLES = ("amount_inr", "signal_score", "capped_score")
CUSTOMER_DOUBLES = ("total_spend_inr", "max_single_txn_inr")
CUSTOMER_DATES = ("first_txn_date", "last_txn_date")
FACT_DOUBLES = ("amount_inr", "customer_lifetime_spend")
FACT = """select txn_id, upi_ref, sender_vpa, receiver_vpa, sender_bank, receiver_bank, amount_inr, currency, txn_size_bucket,
  status, txn_timestamp, txn_date, txn_hour, txn_dow, txn_month, txn_week, txn_year, day_part, is_weekend, device_type, device_id,
  ip_address, city, remarks, is_upi, is_high_value, is_off_hours, is_cross_bank, is_self_transfer, is_suspicious, customer_tier,
  customer_lifetime_txns, customer_lifetime_spend, sender_daily_rank, sender_lifetime_rank, ingested_at, _source from fact"""

# What is wrong with a landing row, in the order the loader reports it.
FAULTS = """
judged as (
  select *, array_to_string(list_filter([
    case when txn_id is null then 'txn_id is null' end,
    case when length(txn_id) > 36 then 'txn_id over 36' end,
    case when length(upi_ref) > 50 then 'upi_ref over 50' end,
    case when length(sender_vpa) > 100 then 'sender_vpa over 100' end,
    case when length(receiver_vpa) > 100 then 'receiver_vpa over 100' end,
    case when length(currency) > 3 then 'currency over 3' end,
    case when length(status) > 20 then 'status over 20' end,
    case when length(device_type) > 20 then 'device_type over 20' end,
    case when length(device_id) > 50 then 'device_id over 50' end,
    case when length(ip_address) > 45 then 'ip_address over 45' end,
    case when length(city) > 50 then 'city over 50' end,
    case when length(remarks) > 200 then 'remarks over 200' end,
    case when amount is not null and try_cast(amount as decimal(15,2)) is null then 'amount not decimal' end,
    case when txn_timestamp is not null and try_cast(txn_timestamp as timestamp) is null then 'txn_timestamp not timestamp_ntz' end,
    case when ingested_at is not null and try_cast(ingested_at as timestamp) is null then 'ingested_at not timestamp_ntz' end
  ], lambda f: f is not null), '; ') as reject_reason
  from landing
)"""


def signal_queries() -> dict[str, str]:
    names = next(values for relation, _, check, columns, values in DECLARED if columns == "signal_type")
    return {
        f"signal_{name.lower()}": statement(*TO_SIGNALS, select=f"select * from signals where signal_type = '{name}'",
                                            double=SIGNAL_DOUBLES, text=("txn_date",))
        for name in names.split()
    }


def oracle() -> dict[str, str]:
    twins = _twins()
    return twins | {
        "int_transactions_enriched_hot": twins["int_transactions_enriched"],
        "fct_daily_summary_hot": twins["fct_daily_summary"],
        "fct_transactions_as_of_hot": twins["fct_transactions_as_of"],
        "paged_text_amounts": twins["paged_source_read"],
        "statements_accounted": """
          with lines as (
            select *, event_id % 37 = 5 as long, event_id % 41 = 3 as odd, event_id % 50 = 7 as late,
              case when event_id % 41 = 3 then 'x' else (event_id % 1000)::varchar end as said,
              case when event_id % 50 = 7 then 'soon' when event_id % 3 = 0 then strftime(ts, '%d/%m/%Y %H:%M:%S')
                   else strftime(ts, '%Y-%m-%d %H:%M:%S') end as seen from events)
          select 'T' || event_id as txn_id, said as amount, case when long or odd or late then seen else strftime(ts, '%Y-%m-%d %H:%M:%S') end as txn_timestamp,
            case when long then 'more than 5 fields' else nullif(concat_ws('; ', case when odd then 'amount cannot be read: x' end,
              case when late then 'txn_timestamp cannot be read: soon' end), '') end as reject_reason
          from lines""",
    }


def _twins() -> dict[str, str]:
    cut = "substr({c}::varchar, 1, 19)"
    landed = ("txn_id, upi_ref, sender_vpa, receiver_vpa, amount::double as amount, currency, status, "
              f"{cut.format(c='txn_timestamp')} as txn_timestamp, device_type, device_id, ip_address, city, remarks")
    two_slices = (
        RAW, staging("s1", where="_source_date <= date '2024-01-15'"),
        staging("s2", where="_source_date >= (select max(txn_date) from s1)"),
    )
    return {
        "raw_adapter": statement(RAW, select="select * from raw_upi_transactions", double=("amount",), text=("_source_date",)),
        "raw_load_accepted": statement(
            RAW, LANDING, FAULTS,
            select="""select txn_id, upi_ref, sender_vpa, receiver_vpa, amount::decimal(15,2)::double as amount,
              ifnull(currency, 'INR') as currency, status, txn_timestamp::timestamp as txn_timestamp, device_type, device_id,
              ip_address, city, remarks, ingested_at::timestamp as ingested_at, date::varchar as _source_date, source as _source
              from judged where reject_reason = ''"""),
        "raw_load_rejects": statement(
            RAW, LANDING, FAULTS,
            select="""select * exclude (source, date), date::varchar as _source_date, source as _source
              from judged where reject_reason <> ''"""),
        "raw_reload_counts": statement(
            RAW, LANDING, FAULTS,
            select="""select date::varchar as _source_date, source as _source, count(*)::bigint as loaded_rows
              from judged where reject_reason = '' group by all"""),
        "stg_upi_transactions": statement(RAW, STG, select="select * from stg", double=("amount_inr",), text=("txn_date",)),
        "stg_incremental_upsert": statement(
            *two_slices, select="select * from s1 anti join s2 using (txn_id) union all by name select * from s2",
            double=("amount_inr",), text=("txn_date",)),
        "int_transactions_enriched": statement(*TO_ENRICHED, select="select * from enriched", double=("amount_inr",), text=("txn_date",)),
        "home_city_mode": statement(*TO_ENRICHED, HOME_CITY.format(source="enriched", where="true"), select="select * from home_city"),
        "primary_device_mode": statement(*TO_ENRICHED, DEVICE.format(source="enriched", where="true"), select="select * from primary_device"),
        "int_customers_current": statement(*TO_ENRICHED, customers(), select="select * from customers",
                                           double=CUSTOMER_DOUBLES, text=CUSTOMER_DATES),
        "snp_customers": statement(*TO_ENRICHED, VERSIONS, select="select * from versions", double=CUSTOMER_DOUBLES, text=CUSTOMER_DATES),
        "dim_customers": statement(*TO_ENRICHED, VERSIONS, select="select * from dim", double=("total_spend_inr",), text=CUSTOMER_DATES),
        "fct_transactions": statement(*TO_ENRICHED, VERSIONS, fact("is_current"), select=FACT, double=FACT_DOUBLES, text=("txn_date",)),
        "fct_transactions_all_versions": statement(*TO_ENRICHED, VERSIONS, fact("true"), select=FACT, double=FACT_DOUBLES, text=("txn_date",)),
        "fct_daily_summary": statement(
            *TO_ENRICHED, DAILY, select="select * from daily", text=("txn_date",),
            double=("total_amount_inr", "median_amount_inr", "max_amount_inr", "min_amount_inr")),
        "fct_customer_activity": statement(*TO_ENRICHED, ACTIVITY, select="select * from activity",
                                           double=("daily_total_inr", "daily_max_inr"), text=("txn_date",)),
        "fct_fraud_signals": statement(*TO_SIGNALS, select="select * from signals", double=SIGNAL_DOUBLES, text=("txn_date",)),
        **signal_queries(),
        "fct_fraud_scores": statement(*TO_SIGNALS, SCORES, select="select * from scores", double=("total_raw_score", "fraud_score")),
        "fct_fraud_summary": statement(
            *TO_SIGNALS, SUMMARY, select="select * from fraud_summary", text=("txn_date",),
            double=("total_flagged_amount_inr", "max_flagged_amount_inr", "max_signal_score")),
        "csv_alias_union_dedup": statement(
            RAW, select=f"""select {landed}, '2024-02-01 00:00:00' as ingested_at from (
              select * replace (ifnull(currency, 'INR') as currency) from raw_upi_transactions
              qualify row_number() over (partition by txn_id
                order by _source = 'api', txn_timestamp nulls last, txn_id nulls last, remarks nulls last) = 1)"""),
        "paged_source_read": statement(
            RAW, select=f"""select {landed}, {cut.format(c='ingested_at')} as ingested_at
              from raw_upi_transactions where _source = 'api' and txn_timestamp::date between date '2024-01-05' and date '2024-01-25'"""),
        "txn_lookup": statement(RAW, select="select * from raw_upi_transactions where txn_id = 'TXN100'",
                                double=("amount",), text=("_source_date",)),
        **{name: statement(RAW, STG, select=f"select * from stg {where} order by txn_timestamp, txn_id limit {n}", double=("amount_inr",), text=("txn_date",))
           for name, where, n in (("txn_page", "", "200 offset 400"), ("txn_page_far", "", "500 offset 700"),
                                  ("txn_page_after", "where txn_timestamp >= timestamp '2024-01-15 00:00:00'", "200"))},
        "snp_customers_range": statement(*TO_ENRICHED, RANGE_VERSIONS, select="select * from range_versions", double=CUSTOMER_DOUBLES, text=CUSTOMER_DATES),
        "fct_transactions_as_of": statement(*TO_ENRICHED, RANGE_VERSIONS, select=AS_OF, double=("amount_inr", "customer_lifetime_spend"), text=("txn_date",)),
        "sender_velocity": statement(*TO_ENRICHED, VELOCITY, select="""
          select txn_id, sender_vpa, txn_timestamp, sender_5min_txns, sender_5min_amount_inr, is_new_payee, is_new_city from velocity""", double=("sender_5min_amount_inr",)),
        "velocity_signals": statement(*TO_ENRICHED, VELOCITY, select="""
          select txn_id, sender_vpa, txn_date, amount_inr, txn_timestamp, sender_5min_txns, sender_5min_amount_inr, signal_type from velocity,
            lateral (select unnest([case when sender_5min_txns >= 2 then 'BURST_SENDER' end, case when is_new_payee and is_high_value then 'NEW_PAYEE_HIGH_VALUE' end,
              case when is_new_city and is_high_value then 'NEW_CITY_HIGH_VALUE' end]) as signal_type) where signal_type is not null""",
          double=("amount_inr", "sender_5min_amount_inr"), text=("txn_date",)),
        "origin_from_path": statement(RAW, select="""select _source as origin, count(*)::bigint as row_count
          from raw_upi_transactions group by all"""),
        # On the 13th statements call the amount by an unknown name, on the 20th pages have one more name.
        "landing_manifest": statement(RAW, select="""
          select date::varchar as date, csv_rows, api_rows, csv_rows + api_rows as total_rows, rejected_rows,
            case day(date) when 13 then 'csv:+amount_inr,csv:-amount' when 20 then 'api:+channel' else '' end as schema_drift,
            csv_rows > 0 and api_rows > 0 and day(date) <> 13 as ready
          from (select _source_date as date,
                  (count(distinct coalesce(txn_id, '')) filter (_source = 'csv'))::bigint as csv_rows,
                  (count(*) filter (_source = 'api' and txn_timestamp::date = _source_date and ifnull(status, '') <> 'REVERSED'))::bigint as api_rows,
                  (count(*) filter (_source = 'api' and txn_timestamp::date = _source_date and status = 'REVERSED'))::bigint as rejected_rows
                from raw_upi_transactions group by all)"""),
        "arrival_ledger": statement(RAW, select="""
          select distinct _source_date::varchar as date, _source as source,
            case when _source = 'csv' and day(_source_date) = 13 then 'amount' else '' end as missing,
            case when _source = 'csv' and day(_source_date) = 13 then 'amount_inr' when _source = 'api' and day(_source_date) = 20 then 'channel' else '' end as extra
          from raw_upi_transactions"""),
        "dq_results": statement(
            *TO_SIGNALS, customers(), SUMMARY, DAILY, ACTIVITY,
            "dim as (select sender_vpa as customer_vpa, * from customers)", fact("true"),
            select=rule_counts({
                "raw_upi_transactions": "raw_upi_transactions", "stg_upi_transactions": "stg", "fct_transactions": "fact",
                "fct_daily_summary": "daily", "dim_customers": "dim", "fct_customer_activity": "activity",
                "fct_fraud_signals": "signals", "fct_fraud_summary": "fraud_summary"})),
        "source_freshness": statement(RAW, select="""
          select max(ingested_at) as newest_ingested_at,
            case when date_diff('microsecond', max(ingested_at), timestamp '2024-02-01 00:00:00') <= 12 * 3600000000 then 'pass'
                 when date_diff('microsecond', max(ingested_at), timestamp '2024-02-01 00:00:00') <= 24 * 3600000000 then 'warn'
                 else 'error' end as freshness
          from raw_upi_transactions"""),
        "paisa_to_inr": """select event_id, (value::decimal(12,2) * 100)::bigint as paisa,
          round((value::decimal(12,2) * 100)::bigint / 100, 2)::double as amount_inr from events""",
        "vpa_validity_by_bank": statement(RAW, select="""
          select nullif(lower(trim(regexp_extract(sender_vpa, '[^@]+$'))), '') as bank,
            (count(*) filter (regexp_full_match(sender_vpa, '[\\w.-]+@[a-zA-Z]+')))::bigint as valid_vpas,
            (count(*) filter (not regexp_full_match(sender_vpa, '[\\w.-]+@[a-zA-Z]+')))::bigint as invalid_vpas
          from raw_upi_transactions group by 1"""),
    }
