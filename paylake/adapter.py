"""Payment transactions derived from the ``events`` table: the engine's test bed.

The rows are dirty on purpose: null ids, late and null-timestamp copies, mixed case,
padded text, ten status spellings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_FROM_EVENTS = """
with keyed as (
  select event_id, ts, event_type, value,
         user_id - user_id % 5 as sender_no,
         (event_id * 7 + user_id * 3) % 40 as receiver_no
  from events
),
rows0 as (
  select
    case when event_id % 333 = 0 then null else concat('TXN', cast(event_id as string)) end as txn_id,
    case when event_id % 17 = 0 then null else concat('UPI', cast(100000000000 + event_id as string)) end as upi_ref,
    concat(case when event_id % 5 = 0 then ' User' else 'user' end, cast(sender_no as string),
           case sender_no % 3 when 0 then '@okaxis' when 1 then '@OKSBI' else '@paytm ' end) as sender_vpa,
    concat(case when receiver_no % 3 = 0 then 'shop' else 'user' end, cast(receiver_no as string),
           case receiver_no % 4 when 0 then '@okaxis' when 1 then '@oksbi' when 2 then '@paytm' else '@ybl' end) as receiver_vpa,
    case when event_id % 101 = 0 then null
         when event_id % 211 = 0 then cast(50000 as decimal(15,2))
         else cast(cast(value as decimal(10,2)) *
              case sender_no % 25 when 5 then 0.50 when 15 then 3.00 when 20 then 20.00 else 300.00 end as decimal(15,2)) end as amount,
    case event_id % 6 when 0 then null when 1 then ' inr ' else 'INR' end as currency,
    case when sender_no % 15 = 10 and extract(day from ts) % 2 = 0 then 'error'
         when event_id % 97 = 0 then 'weird'
         when event_id % 103 = 0 then null
         when event_id % 23 = 0 then 'refunded'
         when event_id % 29 = 0 then 'REVERSED'
         when event_type = 'purchase' then 'SUCCESS'
         when event_type = 'click' then ' completed '
         when event_type = 'view' then 'success'
         when event_type = 'signup' then 'Pending'
         when event_id % 2 = 0 then 'FAILED'
         else 'failure' end as status,
    ts as txn_timestamp,
    case event_id % 4 when 0 then 'Android' when 1 then 'iOS' when 2 then ' web ' else null end as device_type,
    concat('dev', cast(event_id % 500 as string)) as device_id,
    concat('10.0.', cast(event_id % 255 as string), '.', cast(event_id % 251 as string)) as ip_address,
    case event_id % 6 when 0 then 'mumbai' when 1 then ' DELHI ' when 2 then 'new-delhi' when 3 then 'navi mumbai' when 4 then 'Pune' else null end as city,
    case event_id % 3 when 0 then 'Food' when 1 then ' Rent' else null end as remarks,
    ts + interval 1 day as ingested_at,
    cast(ts as date) as _source_date,
    case event_id % 8 when 0 then 'api' when 3 then 'api' when 6 then 'api' else 'csv' end as _source,
    event_id
  from keyed
)
select txn_id, upi_ref, sender_vpa, receiver_vpa, amount, currency, status, txn_timestamp, device_type, device_id, ip_address, city, remarks, ingested_at, _source_date, _source from rows0
union all
select case event_id % 150 when 0 then ' ' || txn_id when 50 then txn_id || '  ' else txn_id end, upi_ref, sender_vpa, receiver_vpa, amount, currency, 'SUCCESS', txn_timestamp + interval 1 hour, device_type, device_id, ip_address, city, 'late copy', ingested_at, _source_date, 'api' from rows0 where event_id % 50 = 0
union all
select txn_id, upi_ref, sender_vpa, receiver_vpa, amount, currency, status, nullif(txn_timestamp, txn_timestamp), device_type, device_id, ip_address, city, 'null ts copy', ingested_at, _source_date, _source from rows0 where event_id % 251 = 0
"""

# Landing rows as text, as a feed delivers them; some break each limit and type of the raw table.
LANDING_FROM_RAW = """
select
  case when amount is null and _source = 'csv' then txn_id || '-' || txn_id || '-' || txn_id || '-0123456789012345678901234567890' else txn_id end as txn_id,
  case device_id when 'dev7' then repeat('U', 51) when 'dev8' then repeat('U', 50) else upi_ref end as upi_ref,
  case device_id when 'dev11' then repeat('s', 101) else sender_vpa end as sender_vpa,
  case device_id when 'dev13' then repeat('r', 101) else receiver_vpa end as receiver_vpa,
  case when amount = 50000 then '123456789012345.50'
       when remarks = 'late copy' then 'INR ' || cast(amount as string)
       else cast(amount as string) end as amount,
  case when status = 'weird' then 'RUPEE' else currency end as currency,
  case device_id when 'dev17' then repeat('S', 21) else status end as status,
  case when status = 'refunded' then 'not a time' else substring(cast(txn_timestamp as string), 1, 19) end as txn_timestamp,
  case device_id when 'dev19' then repeat('d', 21) else device_type end as device_type,
  case device_id when 'dev23' then repeat('i', 51) when 'dev13' then repeat('i', 51) else device_id end as device_id,
  case device_id when 'dev29' then repeat('1', 46) else ip_address end as ip_address,
  case device_id when 'dev31' then repeat('c', 51) else city end as city,
  case device_id when 'dev37' then repeat('m', 201) else remarks end as remarks,
  case device_id when 'dev41' then 'later' else substring(cast(ingested_at as string), 1, 19) end as ingested_at,
  _source as source, _source_date as date
from raw_upi_transactions
"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW_FROM_EVENTS.replace("from events", "from {events}"), events=events(spark, sf_dir))


def landing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_transactions(spark, sf_dir)
    return spark.sql(LANDING_FROM_RAW.replace("from raw_upi_transactions", "from {raw}"), raw=raw)
