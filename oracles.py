"""DuckDB SQL for every registered query, over the same parquet tables."""

from __future__ import annotations

PRODUCT = """
product as (
  select 'PROD-' || lpad(cast(p_partkey as varchar), 6, '0') as product_id,
    case when p_partkey % 29 = 0 then null
         else '  ' || p_name || '  ' || lower(p_brand) || ' ' end as product_name,
    case when p_partkey % 23 = 0 then null else lower(p_type) end as category,
    case when p_partkey % 17 = 0 then null
         else cast(p_retailprice - 900 + (p_partkey % 7) * 100 as decimal(10,2)) end as price,
    date '2024-01-01' + cast(p_partkey % 365 as int) as created_date
  from part)"""


def _tidy(column: str) -> str:
    words = f"string_split(trim(regexp_replace({column}, '\\s+', ' ', 'g')), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || lower(w[2:])), ' ')"


def _clean(product: str) -> str:
    return f"""{product},
clean as (
  select product_id, {_tidy('product_name')} as product_name,
    upper({_tidy('category')}) as category, price, created_date
  from product)"""


def _imputed(product: str) -> str:
    return f"""{_clean(product)},
median as (select quantile_disc(price, 0.5) as m from clean),
imputed as (
  select product_id, product_name, coalesce(category, 'UNCATEGORIZED') as category,
    cast(coalesce(price, m) as decimal(10,2)) as price, created_date,
    category is null or price is null as _has_imputed_values
  from clean, median)"""


CLEAN, IMPUTED = _clean(PRODUCT), _imputed(PRODUCT)

TIER = """case when price < 50 then 'Budget' when price < 100 then 'Standard'
  when price < 500 then 'Premium' else 'Luxury' end"""
SEASON = """case when month(created_date) in (12, 1, 2) then 'Winter'
  when month(created_date) in (3, 4, 5) then 'Spring'
  when month(created_date) in (6, 7, 8) then 'Summer' else 'Fall' end"""
SCORE = """case when std = 0 or std is null then 50.0 when price is not null then
  least(greatest(round(50 + (cast(price as double) - mean) / std * 10, 2), 0), 100) end"""
VALID = "coalesce(price > 0 and product_name is not null and length(product_name) > 2, false)"

def _flagged(product: str) -> str:
    return f"""{_imputed(product)},
stats as (select avg(cast(price as double)) as mean, stddev_pop(cast(price as double)) as std from imputed),
flagged as (
  select product_id, product_name, category, price, cast(created_date as timestamp) as created_date,
    _has_imputed_values, {TIER} as price_tier, date '2024-12-31' - created_date as product_age_days,
    {SEASON} as season, {SCORE} as price_competitiveness_score,
    cast(null as float[]) as product_embedding, {VALID} as _is_valid
  from imputed, stats)"""


FLAGGED = _flagged(PRODUCT)


def _loaded(batch: str, condition: str, price: str) -> str:
    """The flagged rows of one batch of the products; median and score are the batch's own."""
    product = PRODUCT.replace("product as", "every_product as") + f""",
product as (select * replace (cast({price} as decimal(10,2)) as price) from every_product where {condition})"""
    return f"select *, '{batch}' as _batch_id from (with {_flagged(product)} select * from flagged)"


NUMBER = "cast(right(product_id, 6) as integer)"
TWO_LOADS = f"""
first_load as ({_loaded("load0", f"{NUMBER} % 3 <> 0", "price")}),
second_load as ({_loaded("load1", f"{NUMBER} % 3 = 0 or {NUMBER} % 5 = 0", "price + 1")})"""

TEXT_PRODUCT = """
text_product as (
  select p_partkey as product_id, p_name as product_name,
    case when p_partkey % 13 = 0 then 'n/a' else cast(cast(p_retailprice as decimal(10,2)) as varchar) end as price,
    case when p_partkey % 19 = 0 then '2024-13-45'
         else cast(date '2024-01-01' + cast(p_partkey % 365 as int) as varchar) end as created_date,
    p_brand as brand
  from part)"""


def _column_check(name: str, column: str, holds: str) -> str:
    judged = "count(*)" if name == "not_null" else f"count({column})"
    missing = f"count(*) filter (where {column} is null)"
    unexpected = f"count(*) filter (where not ({holds}))"
    return f"""select '{name}' as expectation, '{column}' as column_name, count(*) as element_count,
      {missing} as missing_count, {unexpected} as unexpected_count,
      case when {judged} > 0 then 100.0::double * {unexpected} / {judged} else 0.0 end as unexpected_percent,
      {unexpected} = 0 as success
    from clean"""


def _row_check(table: str) -> str:
    return f"""select 'row_count' as expectation, cast(null as varchar) as column_name, count(*) as element_count,
      0 as missing_count, 0 as unexpected_count, 0.0::double as unexpected_percent,
      count(*) between 1 and 10000000 as success
    from {table}"""


NOT_NULL_ID = _column_check("not_null", "product_id", "product_id is not null")
NOT_NULL_NAME = _column_check("not_null", "product_name", "product_name is not null")
ID_PATTERN = _column_check("regex", "product_id", "regexp_matches(product_id, '^PROD-[0-9]{6}$')")
TYPES = "'ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL'"
SUITE = " union all ".join(
    [
        NOT_NULL_ID,
        NOT_NULL_NAME,
        _column_check("between", "price", "price between 0 and 100000"),
        _column_check("in_set", "category", f"category in ({TYPES}, 'UNCATEGORIZED')"),
        ID_PATTERN,
        _row_check("clean"),
    ]
)

LATEST_LINES = """
latest_lines as (
  select * exclude (rn) from (
    select *, row_number() over (partition by l_orderkey, l_linenumber
      order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_extendedprice desc) as rn
    from lineitem) where rn = 1)"""

ORDER_BATCH = """
order_batch as (
  select o_orderkey, o_custkey, 'X' as o_orderstatus, o_totalprice + 1 as o_totalprice, o_orderdate, o_orderpriority
  from orders where o_orderdate >= timestamp '1999-01-01'),
merged as (
  select * from orders where o_orderdate < timestamp '2000-01-01'
    and o_orderkey not in (select o_orderkey from order_batch)
  union all select * from order_batch)"""

AS_OF = """
  select event_id, ts, user_id, event_type, value, props from (
    select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn
    from events where ts <= timestamp '{at}') where rn = 1"""

def _scd2(events: str) -> str:
    return f"""
with changes as (
  select user_id, ts, event_type, event_id from (
    select *, lag(event_type) over w as previous, row_number() over w as rn
    from {events} window w as (partition by user_id order by ts, event_id))
  where rn = 1 or event_type is distinct from previous)
select user_id, event_type, ts as valid_from, lead(ts) over w as valid_to, lead(ts) over w is null as is_current
from changes window w as (partition by user_id order by ts, event_id)"""


SCD2 = _scd2("events")
BURST = """(select * replace (case when event_id % 3 = 0 then 0 else user_id end as user_id,
    case when event_id % 3 = 0 and event_id % 4 <> 0 then timestamp '2024-01-10' else ts end as ts) from events)"""


def _with_key(history: str) -> str:
    return f"""select *, md5(concat(length(cast(user_id as varchar)), ':', user_id,
        length(cast(epoch_us(valid_from) as varchar)), ':', epoch_us(valid_from))) as version_sk
    from ({history})"""


# The load, the first merge and the second one, by day.
FEED = f"""
feed as (
  select *, 0 as day from orders where o_orderdate < timestamp '2000-01-01'
  union all select o_orderkey, o_custkey, 'X', o_totalprice + 1, o_orderdate, o_orderpriority, 1
    from orders where o_orderdate >= timestamp '1999-01-01'
  union all select * replace ('NONE' as o_orderpriority), 2 from orders where o_orderdate < timestamp '1996-01-01'),
changes as (
  select * exclude (day), 'load' || day as _change_batch,
    strftime(timestamp '2024-12-31 12:00:00' + to_days(cast(day as integer)), '%Y-%m-%d %H:%M:%S') as _changed_at,
    case when day = 0 then 'load' when row_number() over (partition by o_orderkey order by day) = 1 then 'insert' else 'update' end as _change_type
  from feed)"""

NET = "cast(l_extendedprice as decimal(15,2)) * (1 - cast(l_discount as decimal(4,2)))"
DAILY_REVENUE = f"""
select cast(l_shipdate as date) as ship_date, count(*) as line_count,
  sum(cast(l_quantity as decimal(12,2))) as quantity, sum({NET}) as net_revenue
from lineitem group by 1"""

CUSTOMER_REVENUE = """
revenue as (
  select o_custkey, count(*) as order_count, sum(cast(o_totalprice as decimal(15,2))) as order_value
  from orders group by 1)"""


def _spread(column: str, place: int) -> str:
    return " | ".join(f"((({column} >> {i}) & 1) << {i * 3 + place})" for i in range(16))


def _bucket(column: str) -> str:
    return f"(({column} - min({column}) over ()) // (((max({column}) over () - min({column}) over ()) >> 16) + 1))"


ZORDER = f"""
with longs as (select *, epoch_us(l_shipdate) as ship_micro from lineitem),
scaled as (select *, {_bucket('l_partkey')} as a, {_bucket('l_suppkey')} as b, {_bucket('ship_micro')} as c from longs)
select * exclude (ship_micro, a, b, c),
  {_spread('a', 0)} | {_spread('b', 1)} | {_spread('c', 2)} as z_value
from scaled"""

ORACLES: dict[str, str] = {
    "standardize_names": """select p_partkey as product_id, p_name as product_name, p_brand as brandname,
        p_retailprice as retail_price_usd, p_type as type, p_size as size_ from part""",
    "standardize_types": f"""with {TEXT_PRODUCT}
        select cast(product_id as varchar) as product_id, product_name, try_cast(price as decimal(10,2)) as price,
          try_cast(created_date as timestamp) as created_date, brand from text_product""",
    "schema_enforce": f"""with {TEXT_PRODUCT}
        select cast(product_id as varchar) as product_id, product_name, cast(null as varchar) as description,
          try_cast(price as decimal(10,2)) as price, try_cast(created_date as date) as created_date,
          nullif(concat_ws(',', case when try_cast(price as decimal(10,2)) is null then 'price' end,
            case when try_cast(created_date as date) is null then 'created_date' end), '') as _cast_failures
        from text_product""",
    "schema_rescue": f"""with {TEXT_PRODUCT}
        select cast(product_id as varchar) as product_id, product_name, try_cast(price as decimal(10,2)) as price,
          try_cast(created_date as date) as created_date,
          nullif(concat_ws(',', case when try_cast(price as decimal(10,2)) is null then 'price' end,
            case when try_cast(created_date as date) is null then 'created_date' end), '') as _cast_failures,
          '{{' || concat_ws(',', case when try_cast(price as decimal(10,2)) is null then '"price":"' || price || '"' end,
            case when try_cast(created_date as date) is null then '"created_date":"' || created_date || '"' end,
            '"brand":"' || brand || '"') || '}}' as _rescued
        from text_product""",
    "clean_text": f"with {CLEAN} select product_id, product_name, category from clean",
    "median_price": f"with {PRODUCT} select quantile_disc(price, 0.5) as median_price from product",
    "median_sketch": "select count(*) as rows, true as within_one_percent from part",
    "impute_products": f"with {IMPUTED} select product_id, category, price, _has_imputed_values from imputed",
    "impute_flag_value_match": f"""with {IMPUTED}
        select product_id, category, price, coalesce(category = 'UNCATEGORIZED' or price = m, false)
          as _has_imputed_values
        from imputed, median""",
    "price_tier": f"with {PRODUCT} select product_id, price, {TIER} as price_tier from product",
    "product_age": f"""with {PRODUCT}
        select product_id, date '2024-12-31' - created_date as product_age_days from product""",
    "season": f"with {PRODUCT} select product_id, {SEASON} as season from product",
    "price_stats": f"""with {PRODUCT}
        select round(avg(cast(price as double)), 6) as mean_price,
          round(stddev_pop(cast(price as double)), 6) as std_price from product""",
    "price_score": f"""with {PRODUCT},
        stats as (select avg(cast(price as double)) as mean, stddev_pop(cast(price as double)) as std from product)
        select product_id, price, {SCORE} as price_competitiveness_score from product, stats""",
    "embedding_column": """select p_partkey, array_to_string(
          list_transform(embedding, lambda x: cast(cast(cast(x as double) as decimal(12,6)) as varchar)), ',')
          as product_embedding
        from part left join embeddings on vec_id = p_partkey""",
    "validate_flag": f"with {CLEAN} select product_id, {VALID} as _is_valid from clean",
    "valid_products": f"with {FLAGGED} select product_id, product_name, price, _is_valid from flagged where _is_valid",
    "quarantine_rows": f"""with {CLEAN}
        select product_id, product_name, price, false as _is_valid,
          concat_ws(',', case when not coalesce(price > 0, false) then 'price_not_positive' end,
            case when product_name is null then 'name_missing' end,
            case when not coalesce(length(product_name) > 2, false) then 'name_too_short' end) as _reject_reason
        from clean where not {VALID}""",
    "product_transform": f"with {FLAGGED} select * from flagged where _is_valid",
    "product_load_two_batches": f"""with {TWO_LOADS}
        select * from second_load
        union all select * from first_load where product_id not in (select product_id from second_load)""",
    "quarantine_malformed": f"""with {PRODUCT.replace("product as", "every_product as")},
        product as (select * replace (case when {NUMBER} % 13 = 0 then null else price end as price) from every_product),
        {_imputed("")[2:]},
        judged as (select product_id, product_name, category, {NUMBER} % 13 = 0 as malformed,
          case when {NUMBER} % 13 <> 0 then price end as price from imputed)
        select product_id, product_name, price,
          concat_ws(',', case when malformed then 'price_malformed' end,
            case when not coalesce(price > 0, false) then 'price_not_positive' end,
            case when product_name is null then 'name_missing' end,
            case when not coalesce(length(product_name) > 2, false) then 'name_too_short' end) as _reject_reason,
          case when malformed then '{{"price":"n/a"}}' end as _rescued_data
        from judged where not {VALID}""",
    "dq_not_null": f"with {CLEAN} {NOT_NULL_ID} union all {NOT_NULL_NAME}",
    "dq_between": f"with {CLEAN} {_column_check('between', 'price', 'price between 0 and 600')}",
    "dq_in_set": f"with {CLEAN} {_column_check('in_set', 'category', f'category in ({TYPES})')}",
    "dq_regex": f"""with {CLEAN} {ID_PATTERN} union all
        {_column_check('regex', 'product_name', "regexp_matches(product_name, '^[A-Z][a-z]+ R')")}""",
    "dq_row_count": _row_check("lineitem"),
    "dq_suite": f"with {CLEAN} {SUITE}",
    "dq_report": f"""with {CLEAN}, results as ({SUITE})
        select count(*) as evaluated_expectations, count(*) filter (where success) as successful_expectations,
          count(*) filter (where not success) as unsuccessful_expectations,
          100.0::double * count(*) filter (where success) / count(*) as success_percent, bool_and(success) as success
        from results""",
    "dq_gate": f"""with {CLEAN}, results as ({SUITE})
        select 100.0::double * count(*) filter (where success) / count(*) as success_percent,
          100.0::double * count(*) filter (where success) / count(*) >= 95 as gate_passed
        from results""",
    "dedup_latest": f"with {LATEST_LINES} select * from latest_lines",
    "merge_upsert_single": f"with {ORDER_BATCH} select * from merged",
    "merge_upsert_composite": f"""with {LATEST_LINES},
        batch as (select * replace ('X' as l_returnflag) from latest_lines
          where l_shipdate >= timestamp '1999-01-01')
        select * from latest_lines t where l_shipdate < timestamp '2000-01-01' and not exists (
          select 1 from batch s where s.l_orderkey = t.l_orderkey and s.l_linenumber = t.l_linenumber)
        union all select * from batch""",
    "merge_newest_wins": """select user_id, ts, event_id, event_type, value, props from (
          select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn
          from events) where rn = 1""",
    "as_of_state": AS_OF.format(at="2024-01-15 00:00:00"),
    "batch_history": """select strftime(o_orderdate, '%Y%m') as _batch_id, count(*) as row_count,
          min(o_orderdate) as first_ts, max(o_orderdate) as last_ts,
          row_number() over (order by min(o_orderdate), strftime(o_orderdate, '%Y%m')) - 1 as version
        from orders group by 1""",
    "retention_prune": f"""select event_id, ts, user_id, event_type, value, props from events
          where ts > timestamp '2024-01-23 00:00:00'
        union all {AS_OF.format(at="2024-01-23 00:00:00")}""",
    "scd2_history": SCD2,
    "scd2_history_hot_keys": SCD2,
    "scd2_merge": SCD2,
    "scd2_merge_late": SCD2,
    "scd2_stored_merge": SCD2,
    "scd2_burst_key": _scd2(BURST),
    "silver_change_feed": f"with {FEED} select * from changes",
    "silver_as_of": f"with {ORDER_BATCH} select * from merged",
    "silver_history": f"""with {FEED}
        select cast(right(_change_batch, 1) as integer) as version, _change_batch as batch_id, _changed_at as changed_at,
          case when _change_batch = 'load0' then 'load' else 'merge' end as operation,
          count(*) filter (where _change_type <> 'update') as rows_inserted, count(*) filter (where _change_type = 'update') as rows_updated
        from changes group by 1, 2, 3, 4""",
    "entity_scan": "select * from customer",
    "incremental_orders": """select o_orderkey, o_orderdate, o_totalprice from orders
        where o_orderdate > timestamp '1998-06-30 00:00:00'""",
    "next_watermark": "select max(ts) as next_watermark from events",
    "json_flatten": """select event_id, cast(json_extract_string(props, '$.k') as bigint) as props_k from events""",
    "json_flatten_rescue": """select event_id,
          case when event_id % 11 <> 0 and event_id % 13 <> 0 then cast(json_extract_string(props, '$.k') as bigint) end as props_k,
          case when event_id % 11 = 0 then '{"k": ' when event_id % 13 = 0 then '{"k": "x"}' end as _rescued from events""",
    "incremental_two_runs": """select *, case when o_orderdate < timestamp '1998-06-30'
          or (o_orderdate = timestamp '1998-06-30' and o_orderkey % 2 = 0) then '0' else '1' end as _batch_id from orders""",
    "paged_orders": """select o_orderkey, o_totalprice as detail_o_totalprice,
          o_orderpriority as detail_o_orderpriority from orders""",
    "bronze_metadata": """select *, '2024-12-31 12:00:00' as _ingestion_timestamp, 'erp' as _source_system,
          '20241231120000' as _batch_id from orders""",
    "bronze_rerun": f"""with {ORDER_BATCH}
        select *, '0' as _batch_id from orders union all select *, '01' from order_batch""",
    "schema_evolve_union": """select p_partkey, p_name, null as p_brand, null as p_size, 'load0' as _batch_id from part
        union all select p_partkey, null, p_brand, p_size, 'load1' from part""",
    "table_as_of": f"""with {ORDER_BATCH}
        select *, 'load0' as _batch_id from orders where o_orderdate < timestamp '1999-01-01'
        union all select *, 'load1' from order_batch""",
    "table_history": f"""with {ORDER_BATCH}
        select 'load0' as _batch_id, count(*) as row_count, 0 as version from orders
        union all select 'load1', count(*), 1 from order_batch""",
    "partition_roundtrip": "select * from orders",
    "silver_merge": f"with {ORDER_BATCH} select * from merged",
    "silver_merge_bucketed": f"with {ORDER_BATCH} select * from merged",
    "silver_merge_partitioned": f"""with {ORDER_BATCH}
        select *, year(o_orderdate) as order_year from merged""",
    **{
        name: "select *, strftime(o_orderdate, '%m') as order_month from orders"
        for name in ("partition_text_roundtrip", "optimize_partitioned", "zorder_partitioned")
    },
    "silver_merge_keeps_layout": f"""with {ORDER_BATCH}
        select *, strftime(o_orderdate, '%m') as order_month from merged""",
    "layer_row_counts": f"""with {CLEAN}
        select count(*) as total_rows, count(*) filter (where {VALID}) as valid_rows,
          count(*) filter (where not {VALID}) as quarantined_rows from clean""",
    "gold_daily_revenue": DAILY_REVENUE,
    "gold_roundtrip": DAILY_REVENUE,
    "gold_incremental_revenue": DAILY_REVENUE,
    "gold_category_summary": f"""with {FLAGGED}
        select category, count(*) as product_count, sum(price) as total_price, min(price) as min_price,
          max(price) as max_price, count(*) filter (where _has_imputed_values) as imputed_count
        from flagged where _is_valid group by 1""",
    "gold_distinct_customers": """select strftime(o_orderdate, '%Y-%m') as month, count(distinct o_custkey) as customers
        from orders group by 1""",
    "gold_hash_distribution": f"""with {CUSTOMER_REVENUE}
        select c_mktsegment, cast(sum(order_count) as bigint) as order_count, sum(order_value) as order_value
        from revenue join customer on c_custkey = o_custkey group by 1""",
    "gold_broadcast_dim": f"""with {CUSTOMER_REVENUE}
        select r_name, n_name, cast(sum(order_count) as bigint) as order_count, sum(order_value) as order_value
        from revenue join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey
          join region on r_regionkey = n_regionkey
        group by 1, 2""",
    "dim_customer": """select md5(cast(c_custkey as varchar)) as customer_sk, c_custkey as customer_id,
          c_name as customer_name, c_mktsegment as market_segment, n_name as nation, r_name as region
        from customer join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey""",
    "dim_supplier": """select md5(cast(s_suppkey as varchar)) as supplier_sk, s_suppkey as supplier_id,
          s_name as supplier_name, coalesce(n_name, 'Unknown') as nation, coalesce(r_name, 'Unknown') as region
        from supplier left join nation on n_nationkey = s_nationkey left join region on r_regionkey = n_regionkey""",
    "dim_date": """select d as date, cast(year(d) as integer) as year, cast(quarter(d) as integer) as quarter,
          cast(month(d) as integer) as month, cast(day(d) as integer) as day, cast(isodow(d) as integer) as weekday
        from (select cast(o_orderdate as date) as d from orders union select cast(l_shipdate as date) from lineitem)
        where d is not null""",
    "dim_part": """select md5(cast(p_partkey as varchar)) as part_sk, p_partkey as part_id, p_name as part_name,
          p_brand as brand, p_type as part_type, p_size as part_size from part""",
    "dim_user_versions": _with_key(SCD2),
    "fact_event_versions": f"""with versions as ({_with_key(_scd2("(select * from events where ts >= timestamp '2024-01-10')"))})
        select e.*, coalesce(version_sk, 'unknown') as version_sk
        from events e left join versions v on v.user_id = e.user_id and valid_from <= e.ts and (valid_to is null or e.ts < valid_to)""",
    "fact_sales": f"""select l_orderkey as order_id, l_linenumber as line_number,
          md5(cast(o_custkey as varchar)) as customer_sk, md5(cast(l_partkey as varchar)) as part_sk,
          md5(cast(l_suppkey as varchar)) as supplier_sk, cast(o_orderdate as date) as order_date,
          cast(l_shipdate as date) as ship_date, cast(l_quantity as decimal(12,2)) as quantity,
          cast(l_extendedprice as decimal(15,2)) as gross_amount, {NET} as net_amount
        from lineitem join orders on o_orderkey = l_orderkey""",
    "zorder_key": ZORDER,
    "zorder_table": "select * from lineitem",
    "compact_table": "select * from orders",
    "stream_bronze_events": """select *, 'hub' as _source_system, '20241231120000' as _batch_id from events""",
    **dict.fromkeys(("stream_upsert_events", "stream_upsert_pruned"), """select event_id, ts, user_id, event_type, value, props from (
          select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn
          from events) where rn = 1"""),
}
