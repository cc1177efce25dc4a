"""DuckDB SQL for each registered query.

Written from the published meaning of each table and view, not from the Spark code:
distinct counts, windows and quantiles appear in their plain form. Money is kept in
whole cents and every rounding is done on integers, so results are exact.
"""

from __future__ import annotations

import re

FIRST, LAST, SEED_AT = "date '2001-06-01'", "date '2001-08-01'", "timestamp '2001-05-31 00:00:00'"
STAMP = "'%Y-%m-%d %H:%M:%S'"
ISO = r"'\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}'"
SIGNED, UNSIGNED = r"'-?\d+(\.\d+)?'", r"'\d+(\.\d+)?'"
INT, UINT = r"'-?\d+'", r"'\d+'"


def rnd(num: str, den: str, digits: int = 2) -> str:
    """num / den rounded half away from zero on integers, as double; null for a zero den."""
    n, d, scale = f"cast({num} as hugeint)", f"cast({den} as hugeint)", 10**digits
    whole = f"((abs({n}) * {2 * scale} + abs({d})) // nullif(2 * abs({d}), 0))"
    return f"(cast(sign({n}) * sign({d}) * {whole} as double) / {scale})"


def money(cents: str) -> str:
    return f"(cast({cents} as double) / 100)"


def day(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def when(expr: str) -> str:
    return f"strftime({expr}, {STAMP})"


def big(expr: str) -> str:
    return f"cast({expr} as bigint)"


CTES: dict[str, str] = {}

# -- the test tables as raw inputs ---------------------------------------------------
CTES["src_status"] = """
select *, case o_orderstatus when 'F' then 'delivered'
  when 'O' then case when o_orderkey % 2 = 0 then 'delivered' else 'shipped' end
  else case o_orderkey % 10 when 0 then 'canceled' when 1 then 'unavailable' else 'processing' end end as st
from orders"""
CTES["src_orders"] = f"""
select 'o' || o_orderkey as order_id, 'c' || o_orderkey as customer_id, st as order_status,
  strftime(o_orderdate + to_seconds(o_orderkey % 86400), {STAMP}) as order_purchase_timestamp,
  case when o_orderkey % 50 <> 3 then strftime(o_orderdate + interval 1 day, {STAMP}) end as order_approved_at,
  case when st in ('delivered', 'shipped') then strftime(o_orderdate + interval 2 day, {STAMP}) end
    as order_delivered_carrier_date,
  case when st = 'delivered' then strftime(o_orderdate + to_days(cast((o_orderkey * 7) % 41 as integer))
    + to_seconds(86399), {STAMP}) end as order_delivered_customer_date,
  strftime(o_orderdate + interval 20 day, {STAMP}) as order_estimated_delivery_date,
  cast(o_orderdate as date) as order_day
from src_status"""
CTES["src_lines"] = """
select *, cast(round(l_extendedprice * 100) as bigint) // 400 as pc,
  (cast(round(l_extendedprice * 100) as bigint) // 400) * cast(round(l_tax * 100) as bigint) // 100 as fc
from lineitem"""
CTES["src_items"] = f"""
select 'o' || l_orderkey as order_id, cast(l_linenumber as varchar) as order_item_id,
  'p' || l_partkey as product_id, 's' || (l_suppkey * 20 + l_partkey % 20) as seller_id,
  strftime(l_shipdate, {STAMP}) as shipping_limit_date,
  (pc // 100) || '.' || lpad(cast(pc % 100 as varchar), 2, '0') as price,
  (fc // 100) || '.' || lpad(cast(fc % 100 as varchar), 2, '0') as freight_value
from src_lines"""
CTES["src_paid"] = """
select *, cast(round(o_totalprice * 100) as bigint) * (case when seq = 1 then 60 else 40 end) // 100 as vc
from (select *, unnest(range(1, 2 + o_orderkey % 2)) as seq from orders)"""
CTES["src_payments"] = """
select 'o' || o_orderkey as order_id, cast(seq as varchar) as payment_sequential,
  ['credit_card', 'boleto', 'voucher', 'debit_card'][1 + (o_orderkey + seq) % 4] as payment_type,
  cast(1 + o_orderkey % 10 as varchar) as payment_installments,
  (vc // 100) || '.' || lpad(cast(vc % 100 as varchar), 2, '0') as payment_value
from src_paid"""
CTES["src_reviews"] = f"""
select 'r' || o_orderkey || (case when nth = 2 then 'b' else '' end) as review_id, 'o' || o_orderkey as order_id,
  cast(1 + (o_orderkey * 3 + (nth - 1) * 2) % 5 as varchar) as review_score,
  case when o_orderkey % 4 = 0 then 'title ' || o_orderkey end as review_comment_title,
  'fine, "as told"' || chr(10) || 'order ' || o_orderkey as review_comment_message,
  case when not (nth = 2 and o_orderkey % 100 = 51)
    then strftime(o_orderdate + to_days(cast(42 + (nth - 1) * 8 as integer)), {STAMP}) end as review_creation_date,
  strftime(o_orderdate + interval 55 day, {STAMP}) as review_answer_timestamp
from (select *, unnest(range(1, case when o_orderkey % 50 = 1 then 3 else 2 end)) as nth
      from orders where o_orderkey % 20 <> 0)"""
CTES["src_products"] = """
select 'p' || p_partkey as product_id,
  case when p_partkey % 50 = 0 then ' ' else lower(p_brand) || '_pt' end as product_category_name,
  p_size || (case when p_partkey % 13 = 0 then '.5' else '.0' end) as product_name_lenght,
  length(p_name) || '.0' as product_description_lenght, (p_partkey % 7) || '.0' as product_photos_qty,
  (p_size * 100) || '.0' as product_weight_g, p_size || '.0' as product_length_cm,
  (p_size + 1) || '.0' as product_height_cm,
  case when p_partkey % 41 = 0 then 'n/a' else (p_size + 2) || '.0' end as product_width_cm
from part"""
CTES["src_customers"] = """
select 'c' || o_orderkey as customer_id,
  case when o_orderkey % 3 = 0 then 'u' || o_custkey else 'x' || o_orderkey end as customer_unique_id,
  lpad(cast(o_orderkey % 100000 as varchar), 5, '0') as customer_zip_code_prefix, n_name as customer_city,
  case when o_orderkey % 97 = 5 then 'SPX' else lpad(cast(c_nationkey as varchar), 2, '0') end as customer_state
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey"""
CTES["src_sellers"] = """
select 's' || (case when nth = 20 then s_suppkey || 'z' else cast(s_suppkey * 20 + nth as varchar) end) as seller_id,
  lpad(cast(s_suppkey % 100000 as varchar), 5, '0') as seller_zip_code_prefix, ' ' || n_name || ' ' as seller_city,
  case when nth = 20 and s_suppkey % 5 = 0 then 'SPX' else lpad(cast(s_nationkey as varchar), 2, '0') end as seller_state
from (select *, unnest(range(0, 21)) as nth from supplier) join nation on s_nationkey = n_nationkey"""
CTES["src_translation"] = """
select distinct lower(p_brand) || '_pt' as product_category_name, p_brand || '_EN' as product_category_name_english
from part where p_brand not in ('Brand#1', 'Brand#2')"""

# -- generated batches ---------------------------------------------------------------


def drawn(salt: str, rate: str, *keys: str) -> str:
    digest = f"md5(concat_ws('|', cast(batch_day as varchar), '{salt}', {', '.join(keys)}))"
    return (
        f"rank() over (partition by batch_day order by {digest}) "
        f"<= greatest(1, floor(count(*) over (partition by batch_day) * {rate}::double))"
    )


NTH = f"(date_diff('day', {FIRST}, batch_day) + 1)"
ITEM_KEY = ("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value")


def pick(salt: str, options: int, *keys: str) -> str:
    return f"cast('0x' || substr(md5(concat_ws('|', '{salt}', cast(batch_day as varchar), {', '.join(keys)})), 1, 8) as bigint) % {options}"


CTES["gen_today"] = f"""
select *, order_day as batch_day from src_orders where order_day between {FIRST} and {LAST}"""
CTES["gen_resent"] = f"""
select * exclude (batch_day, again), batch_day + 1 as batch_day
from (select *, {drawn('resend', '0.15', 'order_id')} as again from gen_today)
where again and batch_day + 1 <= {LAST}
  and (date_diff('day', {FIRST}, batch_day + 1) + 1 = 2 or date_diff('day', {FIRST}, batch_day + 1) + 1 >= 4)"""
CTES["gen_parents"] = "select * from gen_today union all by name select * from gen_resent"
CTES["gen_orders"] = f"""
select order_id, customer_id,
  case when {NTH} >= 3 and hit_status then '  ' || upper(order_status) || ' ' else order_status end as order_status,
  case when {NTH} >= 3 and hit_time
    then strftime(cast(order_purchase_timestamp as timestamp), '%m/%d/%Y %H:%M')
    else order_purchase_timestamp end as order_purchase_timestamp,
  order_approved_at, order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date,
  batch_day
from (select *, {drawn('status', '0.03', 'order_id')} as hit_status,
        {drawn('timestamp', '0.05', 'order_id')} as hit_time from gen_parents)"""
CTES["gen_items"] = f"""
select order_id, order_item_id, product_id, seller_id, shipping_limit_date,
  case when kind = 0 then '-' || price when kind = 2 then 'N/A' else price end as price,
  case when kind = 1 then null else freight_value end as freight_value, batch_day
from (select *, case when {NTH} >= 3 and hit then {pick('price_kind', 3, *ITEM_KEY)} end as kind
  from (select *, {drawn('price', '0.04', *ITEM_KEY)} as hit
    from src_items join (select distinct order_id, batch_day from gen_parents) using (order_id)))"""
CTES["gen_payments"] = f"""
select order_id, payment_sequential,
  case when {NTH} >= 3 and hit then upper(payment_type) || ' ' else payment_type end as payment_type,
  payment_installments, payment_value, batch_day
from (select *, {drawn('payment', '0.03', 'order_id', 'payment_sequential')} as hit
  from src_payments join (select distinct order_id, batch_day from gen_parents) using (order_id))"""
CTES["gen_reviews"] = f"""
select review_id, order_id,
  case when {NTH} >= 3 and hit then ['0', '7', '-1', null][1 + {pick('review_kind', 4, 'review_id', 'order_id')}]
    else review_score end as review_score,
  review_comment_title, review_comment_message, review_creation_date, review_answer_timestamp, batch_day
from (select *, {drawn('review', '0.04', 'review_id', 'order_id')} as hit
  from src_reviews join (select distinct order_id, batch_day from gen_parents) using (order_id))"""
CTES["gen_products"] = """
select * exclude (product_category_name, hit),
  case when hit and product_category_name <> '' then ' ' || upper(product_category_name) || '  '
    else product_category_name end as product_category_name
from (select *, rank() over (order by md5(concat_ws('|', 'seed', 'category', product_id)))
    <= greatest(1, floor(count(*) over () * 0.02::double)) as hit from src_products)"""

BATCH_ID = "'batch_' || strftime(batch_day, '%Y%m%d')"
for _name, _seed in (
    ("orders", f"select * exclude (order_day) from src_orders where order_day < {FIRST}"),
    *[
        (n, f"select * from src_{n} where order_id in (select order_id from src_orders where order_day < {FIRST})")
        for n in ("items", "payments", "reviews")
    ],
):
    CTES[f"raw_{_name}"] = f"""
select *, 'seed' as batch_id, {SEED_AT} as ingested_at from ({_seed})
union all by name
select * exclude (batch_day), {BATCH_ID} as batch_id, cast(batch_day as timestamp) as ingested_at from gen_{_name}"""
CTES["batch_list"] = f"""
select 'seed' as batch_id, {SEED_AT} as run_time
union all select {BATCH_ID}, cast(batch_day as timestamp)
from (select cast(unnest(generate_series({FIRST}, {LAST}, interval 1 day)) as date) as batch_day)"""

# -- staging -------------------------------------------------------------------------


def ts(column: str) -> str:
    return f"case when regexp_full_match({column}, {ISO}) then try_cast({column} as timestamp) end as {column}"


def cents(column: str) -> str:
    return f"cast(cast({column} as decimal(12,2)) * 100 as bigint)"


CTES["orders_judged"] = f"""
select *, case when order_id is null or trim(order_id) = '' then 'missing_order_id'
  when customer_id is null or trim(customer_id) = '' then 'missing_customer_id'
  when not regexp_full_match(order_purchase_timestamp, {ISO})
    or try_cast(order_purchase_timestamp as timestamp) is null then 'invalid_timestamp' end as reason
from raw_orders"""
CTES["stg_orders"] = f"""
select * exclude (place) from (
  select trim(order_id) as order_id, trim(customer_id) as customer_id, lower(trim(order_status)) as order_status,
    {ts('order_purchase_timestamp')}, {ts('order_approved_at')}, {ts('order_delivered_carrier_date')},
    {ts('order_delivered_customer_date')}, {ts('order_estimated_delivery_date')}, batch_id, ingested_at,
    row_number() over (partition by trim(order_id) order by ingested_at, batch_id) as place
  from orders_judged where reason is null and order_purchase_timestamp is not null)
where place = 1"""


def judged(raw: str, reason: str) -> str:
    return f"""
select r.*, o.order_id is not null as has_parent, {reason} as reason
from {raw} r left join stg_orders o on o.order_id = trim(r.order_id) and o.ingested_at <= r.ingested_at"""


CTES["items_judged"] = judged(
    "raw_items",
    f"""case when not regexp_full_match(price, {SIGNED}) then 'price_not_numeric'
  when try_cast(price as double) < 0 then 'negative_price'
  when freight_value is null or trim(freight_value) = '' then 'missing_freight'
  when not regexp_full_match(freight_value, {SIGNED}) then 'freight_not_numeric'
  when try_cast(freight_value as double) < 0 then 'negative_freight'
  when price is null or o.order_id is null then 'orphan_row' end""",
)
CTES["payments_judged"] = judged(
    "raw_payments",
    f"""case when not regexp_full_match(payment_value, {SIGNED}) then 'payment_not_numeric'
  when try_cast(payment_value as double) < 0 then 'negative_payment'
  when payment_value is null or o.order_id is null then 'orphan_row' end""",
)
CTES["reviews_judged"] = judged(
    "raw_reviews",
    f"""case when not regexp_full_match(review_score, {INT}) then 'review_not_numeric'
  when try_cast(review_score as integer) not between 1 and 5 then 'review_out_of_range'
  when review_score is null or o.order_id is null then 'orphan_row' end""",
)
CTES["stg_items"] = f"""
select * exclude (place) from (
  select trim(order_id) as order_id, cast(order_item_id as integer) as order_item_id, trim(product_id) as product_id,
    trim(seller_id) as seller_id, {ts('shipping_limit_date')}, {cents('price')} as pc,
    {cents('freight_value')} as fc, batch_id, ingested_at,
    row_number() over (partition by trim(order_id), cast(order_item_id as integer) order by ingested_at, batch_id,
      order_id, order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value) as place
  from items_judged where reason is null and regexp_full_match(order_item_id, {UINT})
    and regexp_full_match(price, {UNSIGNED}) and regexp_full_match(freight_value, {UNSIGNED}))
where place = 1"""
CTES["stg_payments"] = f"""
select * exclude (place) from (
  select trim(order_id) as order_id, cast(payment_sequential as integer) as payment_sequential,
    lower(trim(payment_type)) as payment_type,
    case when regexp_full_match(payment_installments, {UINT}) then cast(payment_installments as integer) else 0 end
      as payment_installments, {cents('payment_value')} as vc, batch_id, ingested_at,
    row_number() over (partition by trim(order_id), cast(payment_sequential as integer)
      order by ingested_at, batch_id) as place
  from payments_judged where reason is null and regexp_full_match(payment_sequential, {UINT})
    and regexp_full_match(payment_value, {UNSIGNED}))
where place = 1"""
CTES["stg_reviews"] = f"""
select * exclude (place) from (
  select trim(review_id) as review_id, trim(order_id) as order_id, cast(review_score as integer) as review_score,
    nullif(trim(review_comment_title), '') as review_comment_title,
    nullif(trim(review_comment_message), '') as review_comment_message, {ts('review_creation_date')},
    {ts('review_answer_timestamp')}, batch_id, ingested_at,
    row_number() over (partition by trim(review_id), trim(order_id) order by ingested_at, batch_id) as place
  from reviews_judged where reason is null and trim(review_id) <> '' and regexp_full_match(review_score, {UINT}))
where place = 1"""
CTES["rejects"] = """
select batch_id, 'raw.raw_orders' as source_table, reason as reject_reason, order_id, cast(null as varchar) as part
  from orders_judged where reason is not null
union all select batch_id, 'raw.raw_order_items', reason, order_id, price from items_judged where reason is not null
union all select batch_id, 'raw.raw_order_payments', reason, order_id, payment_value
  from payments_judged where reason is not null
union all select batch_id, 'raw.raw_order_reviews', reason, order_id, review_score
  from reviews_judged where reason is not null"""


def whole(column: str) -> str:
    return (
        f"case when regexp_full_match({column}, {UNSIGNED}) "
        f"then cast(round(cast({column} as decimal(18,6))) as integer) end as {column}"
    )


CTES["stg_products"] = f"""
select trim(product_id) as product_id,
  coalesce(nullif(lower(trim(product_category_name)), ''), 'sem_categoria') as product_category_name,
  {', '.join(whole(c) for c in ('product_name_lenght', 'product_description_lenght', 'product_photos_qty',
    'product_weight_g', 'product_length_cm', 'product_height_cm', 'product_width_cm'))}
from gen_products"""
CTES["stg_customers"] = """
select trim(customer_id) as customer_id, trim(customer_unique_id) as customer_unique_id,
  trim(customer_zip_code_prefix) as customer_zip_code_prefix, lower(trim(customer_city)) as customer_city,
  case when length(trim(customer_state)) = 2 then upper(trim(customer_state)) end as customer_state
from src_customers"""
CTES["stg_sellers"] = """
select trim(seller_id) as seller_id, trim(seller_zip_code_prefix) as seller_zip_code_prefix,
  lower(trim(seller_city)) as seller_city,
  case when length(trim(seller_state)) = 2 then upper(trim(seller_state)) end as seller_state
from src_sellers"""
CTES["stg_translation"] = """
select lower(trim(product_category_name)) as product_category_name,
  lower(trim(product_category_name_english)) as product_category_name_english from src_translation"""

# -- audit ---------------------------------------------------------------------------
_TABLES = (("orders", "raw_orders"), ("items", "raw_order_items"), ("payments", "raw_order_payments"),
           ("reviews", "raw_order_reviews"))
CTES["audit_counts"] = " union all ".join(
    f"""select b.batch_id, '{name}' as table_name, b.run_time,
  (select count(*) from raw_{short} r where r.batch_id = b.batch_id) as rows_in,
  (select count(*) from rejects x where x.batch_id = b.batch_id and x.source_table = 'raw.{name}') as rows_rejected,
  (select count(*) from stg_{short} s where s.batch_id = b.batch_id) as rows_loaded
from batch_list b""" for short, name in _TABLES)
CTES["load_audit"] = "select *, rows_in - rows_rejected - rows_loaded as rows_dup from audit_counts"

# -- mart ----------------------------------------------------------------------------
CTES["dim_product"] = """
select product_id, p.product_category_name as category_pt,
  coalesce(t.product_category_name_english, p.product_category_name) as category_en, product_weight_g,
  product_length_cm * product_height_cm * product_width_cm as product_volume_cm3, product_photos_qty as photos_qty
from stg_products p left join stg_translation t using (product_category_name)"""
CTES["dim_seller"] = "select seller_id, seller_city, seller_state from stg_sellers"
CTES["dim_customer"] = """
select customer_unique_id, min(customer_city) filter (where ingested_at = first_at) as customer_city,
  min(customer_state) filter (where ingested_at = first_at) as customer_state,
  cast(min(order_purchase_timestamp) as date) as first_order_date, count(distinct order_id) as total_orders,
  coalesce(sum(spent), 0) as spent
from (select c.customer_unique_id, c.customer_city, c.customer_state, o.order_purchase_timestamp, o.order_id,
    o.ingested_at, min(o.ingested_at) over (partition by c.customer_unique_id) as first_at, i.pc + i.fc as spent
  from stg_customers c join stg_orders o using (customer_id) left join stg_items i on i.order_id = o.order_id)
group by customer_unique_id"""
CTES["fi"] = f"""
select i.order_id, i.order_item_id, i.product_id, i.seller_id, o.customer_id, c.customer_unique_id,
  o.order_purchase_timestamp, cast(o.order_purchase_timestamp as date) as order_purchase_date, i.pc, i.fc,
  i.pc + i.fc as rc, o.order_status, coalesce(p.category_pt, 'sem_categoria') as category_pt,
  coalesce(p.category_en, 'no_category') as category_en, c.customer_state, c.customer_city, s.seller_state,
  s.seller_city, case when i.pc < 5000 then 'Budget' when i.pc < 15000 then 'Mid-range' else 'Premium' end
    as price_segment, c.customer_state is distinct from s.seller_state as is_cross_state,
  case when i.pc + i.fc > 0 then {rnd('i.fc', 'i.pc + i.fc', 4)} end as freight_ratio, i.batch_id
from stg_items i join stg_orders o on o.order_id = i.order_id
  join stg_customers c on c.customer_id = o.customer_id
  left join dim_product p on p.product_id = i.product_id left join dim_seller s on s.seller_id = i.seller_id
where o.order_status not in ('canceled', 'unavailable')"""
CTES["pay_ranked"] = """
select *, row_number() over (partition by order_id, batch_id order by vc desc, payment_sequential) as place
from stg_payments"""
CTES["rev_ranked"] = """
select *, row_number() over (partition by order_id order by review_creation_date desc nulls last, review_id desc)
  as place from stg_reviews"""
CTES["fo"] = """
select o.order_id, o.customer_id, c.customer_unique_id, o.order_status, o.order_purchase_timestamp,
  cast(o.order_purchase_timestamp as date) as order_purchase_date, o.order_delivered_customer_date,
  o.order_estimated_delivery_date,
  case when arrived then date_diff('day', cast(o.order_purchase_timestamp as date),
    cast(o.order_delivered_customer_date as date)) end as delivery_days,
  case when arrived then date_diff('day', cast(o.order_estimated_delivery_date as date),
    cast(o.order_delivered_customer_date as date)) end as delay_days,
  case when arrived then o.order_delivered_customer_date > o.order_estimated_delivery_date end as is_late,
  coalesce(i.n, 0) as item_count, coalesce(i.rc, 0) as rc, y.vc, y.main as payment_type_main, y.parts as max_installments,
  r.review_score, d.total_orders > 1 as is_repeat_customer, o.batch_id
from (select *, order_status = 'delivered' and order_delivered_customer_date is not null as arrived from stg_orders) o
  join stg_customers c using (customer_id)
  left join (select order_id, batch_id, count(*) as n, sum(pc + fc) as rc from stg_items group by all) i
    on i.order_id = o.order_id and i.batch_id = o.batch_id
  left join (select order_id, batch_id, sum(vc) as vc, max(payment_installments) as parts,
      max(payment_type) filter (where place = 1) as main from pay_ranked group by order_id, batch_id) y
    on y.order_id = o.order_id and y.batch_id = o.batch_id
  left join rev_ranked r on r.order_id = o.order_id and r.place = 1
  left join dim_customer d on d.customer_unique_id = c.customer_unique_id
where o.order_status not in ('canceled', 'unavailable')"""

ON_TIME = "count(*) filter (where order_status = 'delivered' and is_late = false)"
JUDGED = "count(*) filter (where order_status = 'delivered' and is_late is not null)"
DAYS = "sum(delivery_days) filter (where order_status = 'delivered')"
DAYS_N = "count(delivery_days) filter (where order_status = 'delivered')"
SERVICE = f"""{rnd('sum(review_score)', 'count(review_score)')} as avg_review_score,
  {rnd(f'100 * {ON_TIME}', JUDGED)} as on_time_rate, {rnd(DAYS, DAYS_N)} as avg_delivery_days"""


def order_side(dims: str) -> str:
    status = "" if "order_status" in dims else "order_status, "
    return f"""select {dims}, {SERVICE},
  sum(review_score) as review_sum, count(review_score) as review_n, {ON_TIME} as on_time, {JUDGED} as judged
from (select distinct {dims}, order_id from det) m
  join (select order_id, {status}review_score, is_late, delivery_days from fo) using (order_id) group by {dims}"""


CTES["det"] = """
select fi.*, date_trunc('month', fi.order_purchase_date) as order_month, fo.payment_type_main, fo.review_score, fo.is_late,
  fo.delivery_days from fi left join fo using (order_id)"""
CTES["conc"] = f"""
select seller_id, revenue, rank() over (order by revenue desc) as rank_revenue,
  {rnd('100 * (row_number() over (order by revenue desc, seller_id))', 'count(*) over ()', 4)} as pct_sellers,
  {rnd('''100 * (sum(revenue) over (order by revenue desc, seller_id rows between unbounded preceding and current row))''',
       'sum(revenue) over ()', 4)} as pct_revenue
from (select s.seller_id, coalesce(sum(rc), 0) as revenue from dim_seller s left join fi using (seller_id) group by all)"""
CTES["contrib"] = f"""
select *, rank() over (order by rc desc) as rank_revenue, {rnd('100 * rc', 'sum(rc) over ()')} as pct_of_total,
  {rnd('100 * (sum(rc) over (order by rc desc, category_en rows between unbounded preceding and current row))',
       'sum(rc) over ()')} as pct_cumulative
from (select category_en, min(category_pt) as category_pt, sum(rc) as rc, count(distinct order_id) as orders,
  count(*) as items_sold from fi group by category_en)"""
CTES["custsum"] = f"""
select case when is_repeat_customer then 'Repeat' else 'One-time' end as customer_type,
  count(distinct customer_unique_id) as customers, count(*) as orders, {money('sum(rc)')} as revenue,
  {rnd('sum(rc)', '100 * count(*)')} as aov, {rnd('sum(review_score)', 'count(review_score)')} as avg_review_score,
  {rnd(f'100 * {ON_TIME}', JUDGED)} as on_time_rate,
  {rnd('count(*)', 'count(distinct customer_unique_id)', 4)} as avg_orders_per_customer
from fo group by is_repeat_customer"""

SQL: dict[str, str] = {}


def _item_columns(src: str) -> str:
    return f"""select order_id, order_item_id, product_id, seller_id, customer_id, customer_unique_id,
  {when('order_purchase_timestamp')} as order_purchase_timestamp, {day('order_purchase_date')} as order_purchase_date,
  {money('pc')} as price, {money('fc')} as freight_value, {money('rc')} as item_revenue, order_status, category_pt,
  category_en, customer_state, customer_city, seller_state, seller_city, price_segment,
  cast(is_cross_state as varchar) as is_cross_state, freight_ratio"""


# generated and raw
for _n, _t in (("orders", "orders"), ("order_items", "items"), ("order_payments", "payments"),
               ("order_reviews", "reviews")):
    SQL[f"generated_{_n}"] = f"select * exclude (ingested_at), {when('ingested_at')} as ingested_at from raw_{_t}"
SQL["generated_products"] = "select * from gen_products"
SQL["csv_batch_scan"] = f"select *, 'seed' as batch_id from src_reviews"
SQL["batch_status"] = f"""
select batch_id, cast(batch_id <> 'seed' as varchar) as is_available,
  'true' as is_loaded from batch_list"""

# staging
SQL["stage_orders"] = f"""
select order_id, customer_id, order_status, {when('order_purchase_timestamp')} as order_purchase_timestamp,
  {when('order_approved_at')} as order_approved_at,
  {when('order_delivered_carrier_date')} as order_delivered_carrier_date,
  {when('order_delivered_customer_date')} as order_delivered_customer_date,
  {when('order_estimated_delivery_date')} as order_estimated_delivery_date, batch_id,
  {when('ingested_at')} as ingested_at from stg_orders"""
SQL["stage_order_items"] = f"""
select order_id, {big('order_item_id')} as order_item_id, product_id, seller_id,
  {when('shipping_limit_date')} as shipping_limit_date, {money('pc')} as price, {money('fc')} as freight_value, batch_id,
  {when('ingested_at')} as ingested_at from stg_items"""
SQL["stage_order_payments"] = f"""
select order_id, {big('payment_sequential')} as payment_sequential, payment_type,
  {big('payment_installments')} as payment_installments, {money('vc')} as payment_value, batch_id,
  {when('ingested_at')} as ingested_at from stg_payments"""
SQL["stage_order_reviews"] = f"""
select review_id, order_id, {big('review_score')} as review_score, review_comment_title, review_comment_message,
  {when('review_creation_date')} as review_creation_date, {when('review_answer_timestamp')} as review_answer_timestamp,
  batch_id, {when('ingested_at')} as ingested_at from stg_reviews"""
_SIZES = ("product_name_lenght", "product_description_lenght", "product_photos_qty", "product_weight_g",
          "product_length_cm", "product_height_cm", "product_width_cm")
SQL["stage_products"] = f"""
select product_id, product_category_name, {', '.join(f'{big(c)} as {c}' for c in _SIZES)}, 'seed' as batch_id,
  {when(SEED_AT)} as ingested_at from stg_products"""
SQL["stage_customers"] = f"select *, 'seed' as batch_id, {when(SEED_AT)} as ingested_at from stg_customers"
SQL["stage_sellers"] = f"select *, 'seed' as batch_id, {when(SEED_AT)} as ingested_at from stg_sellers"
SQL["stage_category_translation"] = "select * from stg_translation"
SQL["rejected_rows"] = """
select batch_id, source_table, reject_reason, order_id as payload_order_id, part as payload_value from rejects"""
SQL["load_audit"] = f"""
select batch_id, table_name, {when('run_time')} as run_time, rows_in, rows_dup, rows_rejected, rows_loaded
from load_audit"""

# mart
SQL["dim_product"] = f"""
select product_id, category_pt, category_en, {big('product_weight_g')} as product_weight_g,
  {big('product_volume_cm3')} as product_volume_cm3, {big('photos_qty')} as photos_qty from dim_product"""
SQL["dim_seller"] = "select * from dim_seller"
SQL["dim_customer"] = f"""
select customer_unique_id, customer_city, customer_state, {day('first_order_date')} as first_order_date, total_orders,
  {money('spent')} as total_spent from dim_customer"""
SQL["fct_order_items"] = f"{_item_columns('fi')}, batch_id from (select * replace ({big('order_item_id')} as order_item_id) from fi)"
SQL["run_seed"] = SQL["fct_order_items"] + " where batch_id = 'seed'"
SQL["run_next_batch"] = SQL["fct_order_items"] + " where batch_id in ('seed', 'batch_20010601')"
# after a clean, a duplicate, a dirty and a mixed day
RUN_DAYS = ("seed", "batch_20010601", "batch_20010602", "batch_20010603", "batch_20010604")
DAYS_OF = {
    **dict.fromkeys(("rerun_audit", "audit_export", "registered_view"), RUN_DAYS),
    "rollback_batch": RUN_DAYS[:-1],
    "stream_batches": (*RUN_DAYS, "batch_20010605"),
}
SQL["fct_orders"] = f"""
select order_id, customer_id, customer_unique_id, order_status, {when('order_purchase_timestamp')} as
  order_purchase_timestamp, {day('order_purchase_date')} as order_purchase_date,
  {when('order_delivered_customer_date')} as order_delivered_customer_date,
  {when('order_estimated_delivery_date')} as order_estimated_delivery_date, {big('delivery_days')} as delivery_days,
  {big('delay_days')} as delay_days, cast(is_late as varchar) as is_late, {big('item_count')} as item_count,
  {money('rc')} as order_revenue, {money('vc')} as payment_value, payment_type_main,
  {big('max_installments')} as max_installments, {big('review_score')} as review_score,
  cast(is_repeat_customer as varchar) as is_repeat_customer, batch_id from fo"""

# keyed merges: the customers known after the seed, then the whole history on top
CTES["seed_customer"] = """
select c.customer_unique_id, min(c.customer_city) as customer_city, min(c.customer_state) as customer_state
from stg_customers c join stg_orders o using (customer_id) where o.batch_id = 'seed' group by c.customer_unique_id"""
SQL["upsert_dim_customer"] = f"""
select d.customer_unique_id,
  case when s.customer_unique_id is null then d.customer_city else s.customer_city end as customer_city,
  case when s.customer_unique_id is null then d.customer_state else s.customer_state end as customer_state,
  {day('first_order_date')} as first_order_date, total_orders, {money('spent')} as total_spent
from dim_customer d left join seed_customer s using (customer_unique_id)"""
ODD_DAY = "cast(right(batch_id, 1) as integer) % 2 = 1"
SQL["insert_if_absent"] = f"""
select distinct order_id, customer_id, batch_id from raw_orders where batch_id <> 'seed' and not {ODD_DAY.replace("cast", "try_cast")}
  and order_id not in (select order_id from stg_orders where batch_id <> 'seed' and {ODD_DAY.replace("cast", "try_cast")})"""

# checks
SQL["column_checks"] = """
select 'order_id_nulls' as check_name, count(*) filter (where order_id is null) as breaches,
  cast(count(*) filter (where order_id is null) = 0 as varchar) as passed from fi
union all select 'order_item_id_nulls', count(*) filter (where order_item_id is null),
  cast(count(*) filter (where order_item_id is null) = 0 as varchar) from fi
union all select 'prices_below_zero', count(*) filter (where pc < 0),
  cast(count(*) filter (where pc < 0) = 0 as varchar) from fi"""
SQL["repeated_item_keys"] = """
select order_id, order_item_id, count(*) as n from src_items group by all having count(*) > 1"""
SQL["orphan_items"] = """
select count(*) as orphans from raw_items r where not exists (select 1 from stg_orders o where o.order_id = r.order_id)"""
_LAYERS = {"raw_orders": "raw_orders", "raw_order_items": "raw_items", "stg_orders": "stg_orders",
           "stg_order_items": "stg_items", "fct_order_items": "fi", "dim_product": "dim_product",
           "dim_customer": "dim_customer", "dim_seller": "dim_seller", "rejected_rows": "rejects"}
SQL["layer_counts"] = " union all ".join(
    f"select '{n}' as table_name, count(*) as row_count from {t}" for n, t in _LAYERS.items())
SQL["snapshot_delta"] = f"""
select m as measure, {big('b')} as before, {big('a')} as after, {big('a - b')} as delta from (
  select 'batches' as m, 0 as b, count(*) - 1 as a from batch_list
  union all select 'item_rows', count(*) filter (where batch_id = 'seed'), count(*) from fi
  union all select 'revenue', (sum(rc) filter (where batch_id = 'seed') + 50) // 100, (sum(rc) + 50) // 100 from fi
  union all select 'rejected_rows', count(*) filter (where batch_id = 'seed'), count(*) from rejects)"""

# views
SQL["vw_daily_kpi"] = f"""
select coalesce({day('i.d')}, {day('o.d')}) as order_purchase_date, coalesce({money('rc')}, 0) as revenue,
  coalesce({money('pc')}, 0) as product_revenue, coalesce({money('fc')}, 0) as freight_revenue,
  coalesce(orders, 0) as orders, coalesce(customers, 0) as customers, {rnd('rc', '100 * orders')} as aov,
  coalesce(items_sold, 0) as items_sold, avg_review_score, on_time_rate
from (select order_purchase_date as d, sum(rc) as rc, sum(pc) as pc, sum(fc) as fc, count(distinct order_id) as orders,
    count(distinct customer_unique_id) as customers, count(*) as items_sold from fi group by 1) i
  full join (select order_purchase_date as d, {SERVICE} from fo group by 1) o on o.d = i.d"""
SQL["vw_category_contribution"] = f"""
select category_en, category_pt, case when rank_revenue <= 15 then category_en else 'Others' end as category_display,
  {money('rc')} as revenue, orders, items_sold, {rnd('rc', '100 * orders')} as aov, pct_of_total, pct_cumulative,
  rank_revenue, case when rank_revenue <= 15 then lpad(cast(rank_revenue as varchar), 2, '0') || '. ' || category_en
    else '99. Others' end as category_sorted from contrib"""
SQL["vw_state_revenue"] = f"""
select coalesce(i.s, o.s) as customer_state, coalesce({money('rc')}, 0) as revenue, coalesce(orders, 0) as orders,
  coalesce(customers, 0) as customers, {rnd('rc', '100 * orders')} as aov,
  {rnd('100 * rc', 'sum(rc) over ()')} as pct_of_total, avg_delivery_days, on_time_rate
from (select customer_state as s, sum(rc) as rc, count(distinct order_id) as orders,
    count(distinct customer_unique_id) as customers from fi group by 1) i
  full join (select d.customer_state as s, {SERVICE} from fo join dim_customer d using (customer_unique_id)
    group by 1) o on o.s = i.s"""
SQL["vw_detail_items"] = f"""{_item_columns('det')}, {day('order_month')} as order_month, payment_type_main,
  {big('review_score')} as review_score, cast(is_late as varchar) as is_late, {big('delivery_days')} as delivery_days
from (select * replace ({big('order_item_id')} as order_item_id) from det)"""
SQL["vw_category_segment"] = f"""
select category_en, price_segment, {money('rc')} as revenue, items_sold, orders, avg_price,
  {rnd('100 * rc', 'sum(rc) over (partition by category_en)')} as pct_within_category
from (select category_en, price_segment, sum(rc) as rc, count(*) as items_sold, count(distinct order_id) as orders,
  {rnd('sum(pc)', '100 * count(*)')} as avg_price from fi group by 1, 2)"""
CTES["catperf"] = f"""
select category_en, count(*) as items_sold, sum(rc) as rc, {rnd('sum(pc)', '100 * count(*)')} as avg_price,
  count(distinct order_id) as orders, sum(fc) as fc from fi group by 1"""
SQL["vw_category_perf"] = f"""
select category_en, items_sold, {money('rc')} as revenue, avg_price, orders, {rnd('100 * fc', 'rc')} as freight_share,
  case when items_sold >= mi and avg_price >= mp then 'Core' when items_sold >= mi then 'Mass'
    when avg_price >= mp then 'Premium' else 'Underperform' end as quadrant
from catperf, (select quantile_cont(items_sold, 0.5) as mi, quantile_cont(avg_price, 0.5) as mp from catperf)"""
SQL["vw_category_growth"] = f"""
select category_en, {day('m')} as order_month, {money('rc')} as revenue, orders, {money('prev')} as revenue_prev_month,
  {rnd('100 * (rc - prev)', 'prev')} as mom_growth_pct
from (select *, lag(rc) over (partition by category_en order by m) as prev from (
  select category_en, date_trunc('month', order_purchase_date) as m, sum(rc) as rc, count(distinct order_id) as orders
  from fi where order_purchase_date >= date '1995-01-01' group by 1, 2 having count(distinct order_id) >= 20))"""
CTES["sellers20"] = """
select seller_id, sum(rc) as rc, count(distinct order_id) as orders, count(*) as items_sold from fi
group by 1 having count(distinct order_id) >= 20"""
CTES["seller_service"] = order_side("seller_id")
SQL["vw_seller_scorecard"] = f"""
select g.seller_id, seller_state, seller_city, {money('rc')} as revenue, orders, items_sold,
  {rnd('rc', '100 * orders')} as aov, {rnd('100 * rc', '(select sum(rc) from fi)')} as pct_of_total, avg_review_score,
  on_time_rate, avg_delivery_days,
  case when rc > mid and coalesce(review_sum >= 4 * review_n and review_n > 0, false)
      and coalesce(10 * on_time >= 9 * judged and judged > 0, false) then 'Star'
    when rc > mid then 'Risky'
    when coalesce(review_sum >= 4 * review_n and review_n > 0, false) then 'Emerging' else 'Underperform' end as segment
from sellers20 g left join dim_seller using (seller_id) left join seller_service using (seller_id),
  (select quantile_cont(cast(rc as double), 0.5) as mid from sellers20)"""
SQL["vw_seller_concentration"] = f"""
select seller_id, {money('revenue')} as revenue, rank_revenue, pct_sellers as pct_sellers_cumulative,
  pct_revenue as pct_revenue_cumulative from conc"""
_SD = "seller_id, category_en, price_segment, order_purchase_date"
CTES["detail_service"] = order_side(_SD)
SQL["vw_seller_detail"] = f"""
select g.seller_id, seller_state, seller_city, g.category_en, g.price_segment,
  {day('g.order_purchase_date')} as order_purchase_date, {money('rc')} as revenue, orders, items_sold,
  {rnd('rc', '100 * orders')} as aov, avg_review_score, on_time_rate, avg_delivery_days
from (select {_SD}, sum(rc) as rc, count(distinct order_id) as orders, count(*) as items_sold from fi group by all) g
  left join dim_seller using (seller_id) left join detail_service using ({_SD})"""
SQL["vw_delivery_perf"] = f"""
select {day("date_trunc('month', order_purchase_date)")} as order_month, count(*) as orders,
  {rnd('100 * count(*) filter (where is_late = false)', 'count(is_late)')} as on_time_rate,
  {rnd('100 * count(*) filter (where is_late)', 'count(is_late)')} as late_rate,
  {rnd('sum(delivery_days)', 'count(delivery_days)')} as avg_delivery_days,
  {rnd('sum(delay_days)', 'count(delay_days)')} as avg_delay_days
from fo where order_status = 'delivered' group by date_trunc('month', order_purchase_date)"""
SQL["vw_delivery_distribution"] = f"""
select bucket, {big('sort_order')} as sort_order, count(*) as orders,
  {rnd('100 * count(*)', 'sum(count(*)) over ()')} as pct_of_total
from (select case when delivery_days <= 7 then '1. 0-7d' when delivery_days <= 14 then '2. 8-14d'
    when delivery_days <= 21 then '3. 15-21d' when delivery_days <= 30 then '4. 22-30d' else '5. 30d+' end as bucket,
  case when delivery_days <= 7 then 1 when delivery_days <= 14 then 2 when delivery_days <= 21 then 3
    when delivery_days <= 30 then 4 else 5 end as sort_order
  from fo where order_status = 'delivered' and delivery_days is not null) group by bucket, sort_order"""
CTES["route_service"] = order_side("customer_state, seller_state")
SQL["vw_delivery_route"] = """
select g.customer_state, g.seller_state, orders, avg_delivery_days, on_time_rate,
  cast(g.customer_state is distinct from g.seller_state as varchar) as is_cross_state,
  case when g.customer_state is distinct from g.seller_state then 'Cross-state' else 'Same-state' end as route_type
from (select customer_state, seller_state, count(distinct order_id) as orders from fi group by 1, 2
    having count(distinct order_id) >= 30) g
  join route_service r on r.customer_state = g.customer_state and r.seller_state = g.seller_state"""
SQL["vw_review_delay"] = f"""
select delay_bucket, {big('sort_order')} as sort_order, count(*) as orders,
  {rnd('sum(review_score)', 'count(review_score)')} as avg_review_score,
  {rnd('100 * count(*) filter (where review_score in (1, 2))', 'count(*)')} as pct_score_1_2
from (select review_score, case when delay_days < -7 then '1. Early >7d' when delay_days between -7 and -1
    then '2. Early 1-7d' when delay_days = 0 then '3. On time' when delay_days between 1 and 7 then '4. Late 1-7d'
    when delay_days between 8 and 15 then '5. Late 8-15d' else '6. Late >15d' end as delay_bucket,
  case when delay_days < -7 then 1 when delay_days between -7 and -1 then 2 when delay_days = 0 then 3
    when delay_days between 1 and 7 then 4 when delay_days between 8 and 15 then 5 else 6 end as sort_order
  from fo where order_status = 'delivered' and delay_days is not null) group by delay_bucket, sort_order"""
SQL["vw_customer_summary"] = "select * from custsum"
SQL["vw_batch_summary"] = f"""
select batch_id, {when('max(run_time)')} as run_time, {big('sum(rows_in)')} as rows_in, {big('sum(rows_dup)')} as rows_dup,
  {big('sum(rows_rejected)')} as rows_rejected, {big('sum(rows_loaded)')} as rows_loaded,
  {rnd('100 * sum(rows_loaded)', 'sum(rows_in)')} as quality_score from load_audit group by batch_id"""
SQL["vw_reject_summary"] = """
select batch_id, source_table, reject_reason, count(*) as so_dong from rejects group by all"""
SQL["vw_pipeline_health"] = f"""
select count(distinct batch_id) as so_batch_da_chay, {big('sum(rows_loaded)')} as tong_dong_da_nap,
  {big('sum(rows_rejected)')} as tong_dong_bi_loai, {rnd('100 * sum(rows_rejected)', 'sum(rows_in)')} as reject_rate_tong,
  (select batch_id from load_audit order by run_time desc limit 1) as batch_gan_nhat,
  {when('max(run_time)')} as thoi_diem_cap_nhat from load_audit"""

# analyses
CTES["cuts"] = """
select cast(round(max(pct_revenue) filter (where pct_sellers <= 10) * 10000) as bigint) as a,
  cast(round(max(pct_revenue) filter (where pct_sellers <= 20) * 10000) as bigint) as b,
  1000000 - cast(round(max(pct_revenue) filter (where pct_sellers <= 50) * 10000) as bigint) as c from conc"""
SQL["concentration_cuts"] = f"""
select {rnd('a', '10000')} as top_10_pct, {rnd('b', '10000')} as top_20_pct, {rnd('c', '10000')} as bottom_50_pct
from cuts"""
SQL["totals"] = f"""
select {money('sum(rc)')} as revenue, count(distinct order_id) as orders, count(*) as item_rows from fi"""
SQL["entity_counts"] = """
select count(distinct customer_unique_id) as customers, (select count(*) from dim_product) as products,
  (select count(*) from dim_seller) as sellers from fi"""
SQL["top_categories"] = f"""
select category_en, {money('rc')} as revenue, pct_of_total from contrib order by rc desc, category_en limit 5"""
SQL["segment_share"] = f"""
select price_segment, count(*) as items_sold, {money('sum(rc)')} as revenue,
  {rnd('100 * sum(rc)', 'sum(sum(rc)) over ()')} as pct_revenue from fi group by price_segment"""
SQL["on_time_overall"] = f"""
select count(*) filter (where order_status = 'delivered') as delivered_orders,
  {rnd(f'100 * {ON_TIME}', JUDGED)} as on_time_rate from fo"""
SQL["route_type_delivery"] = f"""
select case when x then 'Cross-state' else 'Same-state' end as route_type, count(distinct order_id) as orders,
  {rnd(DAYS, DAYS_N)} as avg_delivery_days
from (select distinct customer_state, seller_state, order_id, is_cross_state as x from fi) m join fo using (order_id)
group by x"""
SQL["customer_share"] = f"""
select customer_type, customers, {rnd('100 * customers', 'sum(customers) over ()')} as pct_customers from custsum"""
SQL["reject_reasons"] = "select reject_reason, count(*) as so_dong from rejects group by 1"
SQL["review_weight_bias"] = f"""
select {rnd('s', 'n', 4)} as avg_by_item, {rnd('so', 'no', 4)} as avg_by_order,
  {rnd('100 * (s * no - so * n)', 'so * n')} as bias_pct
from (select sum(review_score) as s, count(review_score) as n from det),
  (select sum(review_score) as so, count(review_score) as no from fo)"""
SQL["filtered_contribution"] = f"""
select category_en, {money('rc')} as revenue, orders, items_sold, {rnd('100 * rc', 'sum(rc) over ()')} as pct_of_total,
  {rnd('100 * (sum(rc) over (order by rc desc, category_en rows between unbounded preceding and current row))',
       'sum(rc) over ()')} as pct_cumulative, rank() over (order by rc desc) as rank_revenue
from (select category_en, sum(rc) as rc, count(distinct order_id) as orders, count(*) as items_sold from fi
  where price_segment = 'Premium' and order_purchase_date between date '1996-01-01' and date '1999-12-31'
    and seller_state in ('03', '07', '11', '19') group by 1)"""
CTES["weighted_service"] = order_side("price_segment, payment_type_main, order_status")
SQL["order_weighted"] = f"""
select g.price_segment, g.payment_type_main, g.order_status, {money('rc')} as revenue, orders, items_sold,
  {rnd('rc', '100 * orders')} as aov, avg_review_score, on_time_rate, avg_delivery_days
from (select price_segment, payment_type_main, order_status, sum(rc) as rc, count(distinct order_id) as orders,
    count(*) as items_sold from det group by 1, 2, 3) g
  left join weighted_service r on r.price_segment = g.price_segment and r.order_status = g.order_status
    and r.payment_type_main is not distinct from g.payment_type_main"""

# profiler
SQL["profile_repeat_buyers"] = f"""
select count(*) as people, count(*) filter (where n > 1) as repeat_people,
  (select count(distinct customer_id) from src_customers) as customer_ids,
  {rnd('100 * count(*) filter (where n > 1)', 'count(*)')} as repeat_pct
from (select customer_unique_id, count(distinct order_id) as n from src_orders join src_customers using (customer_id)
  group by 1)"""
SQL["profile_status"] = f"""
select order_status, count(*) as orders, {rnd('100 * count(*)', 'sum(count(*)) over ()')} as pct_of_total
from src_orders group by 1"""
SQL["profile_categories"] = """
select (select count(distinct product_category_name) from src_products) as categories,
  (select count(distinct product_category_name) from src_translation) as translated_categories,
  (select count(*) from (select product_category_name from src_products except
     select product_category_name from src_translation)) as missing_translation,
  (select count(*) from src_products where product_category_name is null) as products_without_category"""
SQL["profile_untranslated"] = """
select product_category_name from src_products except select product_category_name from src_translation"""
SQL["profile_days"] = f"""
select {day('min(order_day)')} as first_day, {day('max(order_day)')} as last_day, count(*) as days,
  {rnd('sum(n)', 'count(*)')} as mean_orders, cast(quantile_cont(n, 0.5) as double) as median_orders,
  min(n) as min_orders, max(n) as max_orders, count(*) filter (where n < 50) as thin_days
from (select order_day, count(*) as n from src_orders group by 1)"""
SQL["profile_keys"] = f"""
select count(*) as item_rows, count(*) - count(distinct order_id || '/' || order_item_id) as repeated_keys,
  count(*) filter (where order_id not in (select order_id from src_orders)) as orphan_items,
  {rnd('count(*)', 'count(distinct order_id)')} as items_per_order from src_items"""
SQL["profile_months"] = f"""
select {day("date_trunc('month', order_day)")} as order_month, count(*) as orders from src_orders
group by date_trunc('month', order_day)"""


def _profile(table: str, source: str, columns: tuple[str, ...]) -> str:
    return " union all ".join(
        f"""select '{table}' as table_name, '{c}' as column_name,
  case when count(*) filter (where regexp_full_match({c}, {INT})) = count(*) and count({c}) > 0 then 'int64'
    when count(*) filter (where regexp_full_match({c}, {SIGNED})) = count({c}) then 'float64' else 'str' end as data_type,
  {rnd(f'100 * (count(*) - count({c}))', 'count(*)', 1)} as null_pct, substr(min({c}), 1, 35) as sample_value
from {source}""" for c in columns)


SQL["profile_columns"] = " union all ".join((
    _profile("orders", "src_orders", ("order_id", "customer_id", "order_status", "order_purchase_timestamp",
      "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
      "order_estimated_delivery_date")),
    _profile("order_items", "src_items", ("order_id", "order_item_id", "product_id", "seller_id",
      "shipping_limit_date", "price", "freight_value")),
    _profile("customers", "src_customers", ("customer_id", "customer_unique_id", "customer_zip_code_prefix",
      "customer_city", "customer_state")),
    _profile("products", "src_products", ("product_id", "product_category_name", *_SIZES)),
))


for _n in ("order_items", "order_payments", "order_reviews"):
    SQL[f"stream_stage_{_n.removeprefix('order_')}"] = SQL[f"stage_{_n}"]
SQL["stream_stage_orders"] = SQL["stage_orders"]
SQL["stream_rejects"] = SQL["rejected_rows"]
SQL["run_days_orders"] = SQL["fct_orders"]
SQL["run_days_customers"] = SQL["dim_customer"]
SQL["run_days_items"] = SQL["fct_order_items"]
SQL["run_days_rejects"] = """
select batch_id, source_table, reject_reason, order_id as payload_order_id, part as payload_value from rejects"""
SQL["run_days_audit"] = "select batch_id, table_name, rows_in, rows_dup, rows_rejected, rows_loaded from load_audit"


SQL["rerun_audit"] = SQL["audit_export"] = SQL["run_days_audit"]
SQL["rollback_batch"] = SQL["fct_orders"]
SQL["stream_batches"] = SQL["fct_order_items"] + " where batch_id = 'batch_20010605'"
SQL["registered_view"] = SQL["vw_customer_summary"]
SQL["audit_history"] = SQL["load_audit"]
SQL["seed_status"] = " union all ".join(
    f"select '{n}' as table_name, cast(count(*) > 0 as varchar) as has_rows from {n}" for n in ("dim_product", "dim_customer", "dim_seller")
)
SQL["first_repeated_keys"] = f"{SQL['repeated_item_keys']} order by n desc, order_id, order_item_id limit 10"
SQL["capped_view"] = f"""
select least(count(*), 50000) as shown, least(count(*), 50000) as with_seller from ({SQL['vw_seller_detail']})"""
SQL["csv_split_scan"] = SQL["csv_batch_scan"]
SQL["absent_input"] = """
select 'raw_order_reviews' as table_name, count(*) as row_count from src_reviews
union all select unnest(['raw_orders', 'raw_order_items', 'raw_order_payments']), 0"""
SQL["keyword_scan"] = """
select cast(review_score as bigint) as review_score, count(*) as reviews, cast(sum(cast(review_score as bigint)) as bigint) as score_sum
from src_reviews group by 1"""
SQL["file_listing"] = " union all ".join(
    f"select '{name}.csv' as file_name, count(*) as rows, cast({columns} as bigint) as columns from {source}"
    for name, source, columns in (
        ("order_reviews", "src_reviews", 7), ("customers", "src_customers", 5), ("products", "src_products", 9),
        ("category_translation", "src_translation", 2),
    )
)


def _payload(table: str, judged: str, columns: str) -> str:
    names = [*columns.split(), "batch_id", "ingested_at"]
    values = [*names[:-1], "strftime(ingested_at, '%Y-%m-%dT%H:%M:%S.000Z')"]
    return f"""select batch_id, 'raw.raw_{table}' as source_table, reason as reject_reason,
  unnest([{', '.join(f"'{n}'" for n in names)}]) as field, unnest([{', '.join(values)}]) as value from {judged} where reason is not null"""


SQL["reject_payloads"] = " union all ".join((
    _payload("orders", "orders_judged", "order_id customer_id order_status order_purchase_timestamp order_approved_at "
      "order_delivered_carrier_date order_delivered_customer_date order_estimated_delivery_date"),
    _payload("order_items", "items_judged", "order_id order_item_id product_id seller_id shipping_limit_date price freight_value"),
    _payload("order_payments", "payments_judged", "order_id payment_sequential payment_type payment_installments payment_value"),
    _payload("order_reviews", "reviews_judged", "review_id order_id review_score review_comment_title review_comment_message "
      "review_creation_date review_answer_timestamp"),
))


def _needed(text: str) -> list[str]:
    """Names of the common table expressions a text builds on, in order of definition."""
    found: set[str] = set()

    def visit(sql: str) -> None:
        for name in CTES:
            if name not in found and re.search(rf"\b{name}\b", sql):
                found.add(name)
                visit(CTES[name])

    visit(text)
    # Some short names are defined late but used early: order by who needs whom.
    ordered: list[str] = []

    def place(name: str) -> None:
        if name in ordered:
            return
        for other in found:
            if other != name and re.search(rf"\b{other}\b", CTES[name]):
                place(other)
        ordered.append(name)

    for name in CTES:
        if name in found:
            place(name)
    return ordered


def statement(name: str) -> str:
    body = SQL[name].strip()
    only = ""
    if name in DAYS_OF or name.startswith("run_days_"):  # the same tables over the batches of these days
        only = f" where batch_id in {DAYS_OF.get(name, RUN_DAYS)}"
    cut = ("raw_orders", "raw_items", "raw_payments", "raw_reviews", "batch_list")
    parts = ",\n".join(
        f"{n} as (select * from ({CTES[n].strip()}){only if n in cut else ''})" for n in _needed(body)
    )
    return f"with {parts}\n{body}" if parts else body


def all_statements() -> dict[str, str]:
    return {name: statement(name) for name in SQL}
