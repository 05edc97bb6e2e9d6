"""The catalogue's queries once more, in SQL for another engine."""

from __future__ import annotations

from txflow.operators.features import FEATURE_NAMES

_TX = """
tx as (
  select l_orderkey*10 + l_linenumber as transaction_id, o_custkey as user_id, p_type as product_category,
         case when l_suppkey = 7 then null else r_name end as region,
         case when l_partkey % 97 = 0 then null else uc/100::double end as amount,
         case when l_partkey % 89 = 1 then 0 else cast(l_quantity as int) end as quantity,
         uc*cast(l_quantity as bigint)/100::double as total,
         o_orderpriority as payment_method, isodow(l_shipdate) - 1 as day_of_week,
         case when l_suppkey = 13 then 24
              else cast((l_orderkey*7 + l_linenumber*5 + l_partkey) % 24 as int) end as hour_of_day,
         case when l_partkey % 83 = 2 then null
              when (l_orderkey*31 + l_partkey) % 50 = 0 then 'True' else 'False' end as is_fraud
  from (select *, cast(floor(l_extendedprice*5/l_quantity) as bigint) as uc from lineitem) l
  join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
  join part on l_partkey = p_partkey
)"""

_VALID = (
    "transaction_id is not null and user_id is not null and amount > 0 and total > 0 and quantity > 0 "
    "and hour_of_day between 0 and 23 and day_of_week between 0 and 6"
)

_FT = f"""{_TX},
clean as (select * replace (is_fraud = 'True' as is_fraud) from tx where {_VALID}),
ft as (
  select *, day_of_week in (5, 6) as is_weekend, hour_of_day between 10 and 20 as is_peak_hour,
         case when hour_of_day < 6 then 'Night' when hour_of_day < 12 then 'Morning'
              when hour_of_day < 18 then 'Afternoon' else 'Evening' end as time_of_day,
         case when amount < 25 then 'Budget' when amount < 100 then 'Mid-Range'
              when amount < 500 then 'Premium' else 'Luxury' end as price_tier,
         total > 500 as is_high_value, quantity >= 10 as bulk_purchase,
         round(total / quantity, 2) as amount_per_item, round(ln(total + 1), 6) as log_total,
         hour_of_day < 5 as is_late_night, hour_of_day < 5 and total > 500 as high_risk_flag,
         cast(round(total * 100) as bigint) as cents
  from clean
)"""

_SUM = "sum(cents)::bigint / 100::double"
_AVG = "((2*sum(cents) + count(*)) // (2*count(*)))::bigint / 100::double"
_AVG_QUANTITY = "((200*sum(quantity) + count(*)) // (2*count(*)))::bigint / 100::double as avg_quantity"
_FRAUD = "sum(is_fraud::int)::bigint as fraud_count"

_SUMMARIES = {
    "region_stats": f"""select region, count(*) as transaction_count, {_AVG} as avg_transaction_value,
        {_SUM} as total_revenue, {_AVG_QUANTITY}, {_FRAUD},
        round(avg(is_fraud::int)*100, 4) as fraud_rate_pct from ft group by region""",
    "category_stats": f"""select product_category, count(*) as transaction_count, {_AVG} as avg_transaction_value,
        {_SUM} as total_revenue, {_AVG_QUANTITY}, count(distinct user_id) as unique_buyers
        from ft group by product_category""",
    "time_stats": f"""select time_of_day, count(*) as transaction_count, {_AVG} as avg_transaction_value,
        {_SUM} as total_revenue from ft group by time_of_day""",
    "user_stats": f"""select user_id, count(*) as total_transactions, {_SUM} as total_spent,
        {_AVG} as avg_transaction, {_FRAUD} from ft group by user_id having count(*) > 1""",
}

_EV = """
ev as (
  select event_id, user_id, event_type as product_category,
         case when event_id % 41 = 3 then null else 'R' || (user_id % 5)::varchar end as region,
         cents0/100::double as amount, cast(event_id % 20 + 1 as int) as quantity,
         cents0*(event_id % 20 + 1)/100::double as total, 'M' || (event_id % 3)::varchar as payment_method,
         event_id % 50 = 0 as is_fraud, us as event_us,
         us + (case when event_id % 20 = 0 then 5400 else event_id % 7 end)*1000000 + event_id % 1000 as arrival_us,
         cents0*(event_id % 20 + 1) as cents
  from (select *, epoch_us(ts) as us, cast(round(value*100) as bigint) as cents0 from events)
)"""
_EVENT_COLUMNS = (
    "event_id, user_id, product_category, region, amount, quantity, total, payment_method, is_fraud, "
    "event_us, arrival_us"
)

_BLANK = (
    "not (event_id % 31 = 1 or event_id % 37 = 2 or event_id % 43 = 3 or event_id % 47 = 4) and event_id % 53 = 5"
)
_DAMAGED = (
    "event_id % 31 = 1 or event_id % 37 = 2 or event_id % 43 = 3 or event_id % 47 = 4 "
    "or event_id % 53 = 5 or event_id % 59 = 6 or event_id % 61 = 7 or event_id % 67 = 8"
)


def _stamped(size: int, replay: bool = True, valid_only: bool = False) -> str:
    """``st``: events with latency in 10 microseconds, both windows and lateness."""
    us = size * 1_000_000
    window = (
        f"case when event_id = first.event_id then first.event_us // {us} "
        f"else greatest(first.event_us // {us}, arrival_us // {us}) end"
        if replay
        else f"arrival_us // {us}"
    )
    where = f"where not ({_DAMAGED})" if valid_only else ""
    return f"""{_EV},
st as (
  select *, event_window_id < window_id as is_late from (
    select ev.*, (arrival_us - ev.event_us + 5) // 10 as lat, ev.event_us // {us} as event_window_id,
           {window} as window_id
    from ev, (select min_by(struct_pack(event_id, event_us), (arrival_us, event_id)) as first from ev) {where})
)"""


def _bounds(size: int) -> str:
    return (
        f"(window_id*{size})::double as window_start, ((window_id + 1)*{size})::double as window_end, "
        f"{size}::double as duration_seconds"
    )


def _totals(size: int) -> str:
    return f"""count(*) as event_count, count(*)/{size}::double as throughput_per_second,
       sum(cents)::bigint/100::double as total_revenue, count_if(is_fraud)::bigint as fraud_count,
       round(count_if(is_fraud)/count(*)*100, 4) as fraud_rate_pct"""


def _ranks(prefix: str) -> str:
    picks = [
        f"min(lat) filter (where i = least(floor({p}::double*n)::bigint, n - 1))/100::double as {prefix}_{name}_ms"
        for name, p in (("p50", 0.50), ("p95", 0.95), ("p99", 0.99))
    ]
    return ", ".join([*picks, f"max(lat)/100::double as {prefix}_max_ms"])


_RANKED = """ranked as (
  select window_id, lat, row_number() over (partition by window_id order by lat) - 1 as i,
         count(*) over (partition by window_id) as n from st)"""


def _top(column: str, alias: str) -> str:
    return f"""select window_id, label as {alias} from (
  select window_id, label, row_number() over (partition by window_id order by n desc, a) as r from (
    select window_id, coalesce({column}, 'Unknown') as label, count(*) as n,
           min((arrival_us, event_id)) as a from st group by all)) where r = 1"""


def _window_stats(size: int, **stamp: bool) -> str:
    return f"""with {_stamped(size, **stamp)},
{_RANKED},
p as (select window_id, {_ranks("latency")} from ranked group by window_id),
t as (select window_id, {_bounds(size)}, {_totals(size)}, count_if(is_late)::bigint as late_events
      from st group by window_id),
r as ({_top("region", "top_region")}),
c as ({_top("product_category", "top_category")})
select * from t join p using (window_id) join r using (window_id) join c using (window_id)"""


_OVERALL = f"""with {_stamped(5)},
ranked as (select lat, row_number() over (order by lat) - 1 as i, count(*) over () as n from st),
w as (select count(*) as n from st group by window_id)
select sum(w.n)::bigint as total_events, count(*) as total_windows, round(avg(w.n/5::double), 2) as avg_throughput_per_second,
       any_value(overall_latency_p50_ms) as overall_latency_p50_ms, any_value(overall_latency_p95_ms) as overall_latency_p95_ms,
       any_value(overall_latency_p99_ms) as overall_latency_p99_ms, any_value(overall_latency_max_ms) as overall_latency_max_ms
from w, (select {_ranks("overall_latency")} from ranked)"""


_FIRST_RULES = {
    "clean_dropna": "transaction_id is not null and user_id is not null and amount is not null and total is not null",
    "clean_amount": "amount > 0",
    "clean_quantity": "quantity > 0",
    "clean_total": "total > 0",
    "clean_hour": "hour_of_day between 0 and 23",
    "clean_day": "day_of_week between 0 and 6",
}

_QUALITY = f"""select count(*) as lines, count_if({_DAMAGED})::bigint as corrupt_lines from ev where not ({_BLANK})"""


def oracles() -> dict[str, str]:
    tx = f"with {_TX} select * from tx"
    featured = f"with {_FT} select * exclude (cents) from ft"
    events = f"with {_EV} select {_EVENT_COLUMNS} from ev"
    totals = f"{_bounds(3600)}, {_totals(3600)}"
    closed = "where window_end <= (select max(arrival_us) from st) / 1e6"
    sql = {
        "csv_scan": tx,
        "repartition_scan": tx,
        "load_row_count": f"with {_TX} select count(*) as row_count from tx",
        "jsonl_scan": events,
        "stream_jsonl": f"{events} where not ({_DAMAGED})",
        "tail_jsonl": f"{events} where not ({_DAMAGED})",
        "corrupt_split": f"""with {_EV} select c as is_corrupt, case when not c then event_id end as event_id,
            case when not c then region end as region, case when not c then total end as total
            from (select *, {_DAMAGED} as c from ev where not ({_BLANK}))""",
        "corrupt_count": f"with {_EV} {_QUALITY}",
        "error_rate": f"with {_EV} select *, corrupt_lines/lines as error_rate from ({_QUALITY})",
        "clean_fraud_flag": f"with {_TX} select * replace (is_fraud = 'True' as is_fraud) from tx",
        "clean_transactions": f"with {_FT} select * from clean",
        "clean_report": f"""with {_TX} select count(*) as rows_before, count_if({_VALID})::bigint as rows_after,
            (count(*) - count_if({_VALID}))::bigint as rows_removed,
            count_if(not ({_FIRST_RULES["clean_dropna"]}))::bigint as failed_critical_fields,
            count_if((amount > 0) is not true)::bigint as failed_amount,
            count_if((quantity > 0) is not true)::bigint as failed_quantity,
            count_if((total > 0) is not true)::bigint as failed_total,
            count_if((hour_of_day between 0 and 23) is not true)::bigint as failed_hour_of_day,
            count_if((day_of_week between 0 and 6) is not true)::bigint as failed_day_of_week from tx""",
        "featured_transactions": featured,
        "featured_parquet_roundtrip": featured,
        "run_metrics": f"""with {_TX} select count(*) as row_count, count_if({_VALID})::bigint as clean_row_count,
            (count(*) - count_if({_VALID}))::bigint as removed_row_count from tx""",
        "window_assign": f"""with {_EV} select event_id, window_id, (window_id*3600)::double as window_start,
            ((window_id + 1)*3600)::double as window_end from (select *, event_us // 3600000000 as window_id from ev)""",
        "arrival_window_assign": f"with {_stamped(3600)} select event_id, window_id from st",
        "late_events": f"""with {_stamped(3600)} select window_id, count_if(is_late)::bigint as late_events
            from st group by window_id""",
        "event_latency": f"with {_EV} select event_id, (arrival_us - event_us)/1e6::double as latency_seconds from ev",
        "window_totals": f"with {_stamped(3600)} select window_id, {totals} from st group by window_id",
        "window_latency_percentiles": f"""with {_stamped(3600)}, {_RANKED}
            select window_id, {_ranks("latency")} from ranked group by window_id""",
        "window_top_region": f"with {_stamped(3600)} {_top('region', 'top_region')}",
        "window_top_category": f"with {_stamped(3600)} {_top('product_category', 'top_category')}",
        "window_stats": _window_stats(3600),
        "overall_stats": _OVERALL,
        "consumer_metrics": _OVERALL,
        "stream_window_sink": f"{_window_stats(3600, replay=False, valid_only=True)} {closed}",
        "stream_final_flush": _window_stats(3600, replay=False, valid_only=True),
        "resume_after": f"{events} where event_id > 499",
        "resume_after_limit": f"{events} where event_id > 499 order by event_id limit 200",
        "arrival_rate": f"""with {_EV} select (i*5)::double as interval_start, count(*) as events,
            count(*)/5::double as rate_per_second from (select event_us // 5000000 as i from ev) group by i""",
        "arrival_rate_overall": f"""with {_EV} select n as events_produced, s as total_time, n/s as avg_rate
            from (select count(*) as n, (max(event_us) - min(event_us))/1e6::double as s from ev)""",
        "event_time_windows": f"""with {_EV} select window_id, {totals} from (
            select *, event_us // 3600000000 as window_id from ev)
            where arrival_us < (window_id + 1)*3600000000 + 2000000 group by window_id""",
        "stream_event_time_windows": f"""with {_EV} select window_id, count(*) as event_count,
            sum(cents)::bigint/100::double as total_revenue, count_if(is_fraud)::bigint as fraud_count from (
              select *, event_us // 3600000000 as window_id,
                max(event_us) filter (where arrival_us < (event_us // 3600000000 + 1)*3600000000 + 2000000) over () as latest
              from ev where not ({_DAMAGED}))
            where (window_id + 1)*3600000000 <= (latest // 1000 - 2000)*1000
              and arrival_us < (window_id + 1)*3600000000 + 2000000 group by window_id""",
        "late_side_output": f"with {_stamped(3600)} select event_id, event_window_id, window_id from st where is_late",
        "dedup_events": events,
        "backlog_depth": f"""with {_EV}, c as (
              select event_us // 5000000 as i, 1 as c from ev union all select arrival_us // 5000000, -1 from ev),
            d as (select i, sum(c) as c from c group by i)
            select ((i + 1)*5)::double as interval_end, depth, depth > 3 as alert
            from (select i, (sum(c) over (order by i))::bigint as depth from d)""",
        "fraud_spikes": f"""with {_stamped(3600)}, t as (select window_id, {_totals(3600)} from st group by window_id),
            h as (select *, count(*) over b as windows_before, avg(fraud_rate_pct) over b as m,
                         stddev_pop(fraud_rate_pct) over b as s
                  from t window b as (order by window_id range between 12 preceding and 1 preceding))
            select window_id, event_count, fraud_rate_pct, windows_before, round(m, 6) as mean_before,
                   round(s, 6) as deviation_before,
                   coalesce(windows_before >= 5 and round(fraud_rate_pct - m - 3*s, 9) > 0, false) as is_spike from h""",
        "partitioned_write": f"""with {_EV} select {_EVENT_COLUMNS}, year(d)::int as year, month(d)::int as month,
            day(d)::int as day from (select *, make_timestamp(event_us) as d from ev)""",
    }
    for key, rule in _FIRST_RULES.items():
        sql[key] = f"{tx} where {rule}"
    for name in FEATURE_NAMES:
        sql[f"feature_{name}"] = f"with {_FT} select transaction_id, user_id, {name} from ft"
    for name, select in _SUMMARIES.items():
        sql[name] = f"with {_FT} {select}"
        sql[f"{name.removesuffix('_stats')}_csv_roundtrip"] = sql[name]
    return sql
