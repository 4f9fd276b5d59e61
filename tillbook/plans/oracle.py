"""DuckDB statements of what each registered query must return, written on the given tables.

Every statement starts from the same chain of named steps; DuckDB drops the ones a statement does not use.
Vietnam has kept UTC+7 without daylight saving over all report days, so local time is + 7 hours here.
"""

from __future__ import annotations

from tillbook import schemas

AS_OF = "date '2026-08-02'"
FIRST_DAY = "date '2020-01-01'"


def key(*cols: str) -> str:
    """63-bit key of the text of some columns."""
    digest = f"md5(concat_ws('|', {', '.join(f'cast({c} as varchar)' for c in cols)}))"
    return f"(((cast('0x' || substr({digest}, 1, 8) as bigint) & 2147483647) << 32) | cast('0x' || substr({digest}, 9, 8) as bigint))"


STAMPS = "timestamp '2020-01-01' as created_at, timestamp '2020-01-01' as updated_at"
PROMO = "nullif(cast(round(l_discount * 100) as bigint), 0)"

SOURCES = f"""
src_store as (
  select cast(n_nationkey as bigint) as id, n_name as store_name, r_name as address,
         '028-' || lpad(cast(n_nationkey as varchar), 4, '0') as phone_number, {STAMPS}
  from nation join region on n_regionkey = r_regionkey),
src_category as (
  select distinct cast('0x' || substr(md5(p_type), 1, 7) as bigint) as id, p_type as category_name, {STAMPS} from part),
src_brand as (
  select distinct cast(substr(p_brand, 7) as bigint) as id, p_brand as brand_name, {STAMPS} from part),
src_payment_method as (
  select distinct cast(o_orderpriority[1] as bigint) as id,
         case o_orderpriority[1] when '1' then 'cash' when '2' then 'card' when '3' then 'e_wallet'
           else 'bank_transfer' end as method, {STAMPS}
  from orders where o_orderpriority[1] in ('1', '2', '3', '4')),
src_promotion as (
  select distinct {PROMO} as id, case when {PROMO} % 2 = 0 then 'percentage' else 'fixed_amount' end as type,
         cast(case {PROMO} when 9 then 1250 when 8 then 12.5
           else case when {PROMO} % 2 = 0 then {PROMO} else {PROMO} * 10 end end as decimal(12,2)) as amount,
         {FIRST_DAY} + cast({PROMO} * 100 as integer) as start_date,
         {FIRST_DAY} + cast({PROMO} * 100 + 59 as integer) as end_date, {STAMPS}
  from lineitem where {PROMO} between 1 and 9),
src_promotion_product as (
  select distinct l_partkey as product_id, {PROMO} as promotion_id, {STAMPS}
  from lineitem where {PROMO} <= 9 and (l_partkey + {PROMO}) % 50 <> 0),
one_tx as (
  select o_orderkey as transaction_id, cast(c_nationkey as bigint) as store_id,
         case when o_orderkey % 20 = 0 then o_custkey + 10000000 else o_custkey % 200 end as employee_id,
         cast(o_orderpriority[1] as bigint) as payment_method_id,
         o_orderdate + interval 25 year + to_seconds(o_orderkey * 7919 % 86400) as transaction_ts,
         case when o_orderstatus <> 'P' then 'completed' when o_orderkey % 2 = 0 then 'returned'
           else 'cancelled' end as status
  from orders join customer on o_custkey = c_custkey),
one_item as (
  select l_orderkey as transaction_id,
         cast(row_number() over (partition by l_orderkey
           order by l_partkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity, l_shipdate) as integer) as line_number,
         l_partkey as product_id, {PROMO} as promotion_id, cast(l_quantity as integer) as quantity,
         cast(l_extendedprice as decimal(12,2)) as regular_price,
         cast(case when {PROMO} % 2 = 1 then 0 else round(l_tax * 100) end as decimal(12,2)) as coupon_amount,
         l_shipdate + interval 25 year as created_at, l_shipdate + interval 25 year as updated_at
  from lineitem),
one_product as (
  select l_partkey as id, 'SKU-' || lpad(cast(l_partkey as varchar), 8, '0') as product_sku,
         cast('0x' || substr(md5(any_value(p_type)), 1, 7) as bigint) as category_id,
         cast(substr(any_value(p_brand), 7) as bigint) as brand_id,
         any_value(p_name) || ' ' || cast(year(l_shipdate) + 25 as varchar) as product_name,
         cast(cast(any_value(p_retailprice) as decimal(12,2)) * 2 as decimal(12,2)) as unit_price,
         cast(cast(any_value(p_retailprice) as decimal(12,2)) * (1 + cast(max(l_tax) as decimal(12,2)))
           as decimal(12,2)) as unit_cost,
         timestamp '2020-01-01' as created_at, l_shipdate + interval 25 year as updated_at
  from lineitem join part on p_partkey = l_partkey
  group by l_partkey, l_shipdate + interval 25 year, year(l_shipdate)),
one_employee as (
  select user_id as id,
         cast(case event_type when 'click' then 0 when 'view' then 1 when 'purchase' then 2 when 'signup' then 3
           when 'error' then 4 end as bigint) as store_id,
         'First' || cast(user_id as varchar) as first_name, 'Last' || event_type as last_name,
         date '1980-01-01' + cast(user_id % 9000 as integer) as date_of_birth, props as address,
         '09' || lpad(cast(user_id as varchar), 8, '0') as phone_number,
         date '2023-12-25' + cast(user_id % 40 as integer) as start_date,
         case when user_id % 3 = 0
           then date '2023-12-25' + cast(user_id % 40 + user_id % 17 + 3 as integer) end as end_date,
         abs(cast(value as decimal(12,2))) as salary, ts as created_at, ts as updated_at
  from events),
loads as (select unnest([1, 2])::bigint as _load_id),
src_sales_transaction as (
  select t.*, transaction_ts as created_at, transaction_ts + to_hours(transaction_id % 48) as updated_at, _load_id
  from one_tx t join loads on _load_id = 1 or transaction_id % 10 = 0),
src_sales_transaction_item as (
  select t.*, _load_id from one_item t join loads on _load_id = 1 or transaction_id % 10 = 0),
src_product as (select t.*, _load_id from one_product t join loads on _load_id = 1 or id % 10 = 0),
src_employee as (select t.*, _load_id from one_employee t join loads on _load_id = 1 or id % 10 = 0)"""

STAGING = """
s_tx as (
  select distinct * exclude (_load_id, status) from src_sales_transaction where status = 'completed'),
s_item as (
  select distinct i.* exclude (_load_id) from src_sales_transaction_item i
  where exists (select 1 from s_tx where s_tx.transaction_id = i.transaction_id)),
s_product as (select distinct * exclude (_load_id) from src_product),
s_employee as (select distinct * exclude (_load_id) from src_employee)"""


def history(name: str, source: str, natural: str, tracked: str, type1: list[str]) -> str:
    latest = ", ".join(f"last(v.{c} order by v.updated_at) as {c}" for c in type1)
    kept = ", ".join(f"l.{c}" for c in type1)
    return f"""
{name}_latest as (select {natural}, {latest} from {source} v group by 1),
{name}_start as (
  select * from (
    select {natural}, {tracked}, updated_at,
           row_number() over w as nth,
           row({tracked}) is distinct from lag(row({tracked})) over w as differs
    from {source} window w as (partition by {natural} order by updated_at))
  where nth = 1 or differs),
{name} as (
  select p.{natural}, {kept}, {", ".join("p." + c.strip() for c in tracked.split(","))},
         case nth when 1 then timestamp '1900-01-01' else p.updated_at end as valid_from,
         ifnull(lead(p.updated_at) over w, timestamp '9999-12-31') as valid_to,
         lead(p.updated_at) over w is null as is_current
  from {name}_start p join {name}_latest l on l.{natural} = p.{natural}
  window w as (partition by p.{natural} order by p.updated_at))"""


HISTORY = (
    "n_product as (select id as product_id, * exclude (id) from s_product),"
    + "n_employee as (select id as employee_id, first_name || ' ' || last_name as employee_name, * exclude (id) from s_employee),"
    + history("h_product", "n_product", "product_id", "category_id, brand_id, unit_price, unit_cost", ["product_sku", "product_name"])
    + ","
    + history("h_employee", "n_employee", "employee_id", "store_id", ["employee_name", "salary", "address", "start_date", "end_date"])
)

OPEN = "timestamp '1900-01-01' as valid_from, timestamp '9999-12-31' as valid_to, true as is_current"
DIMS = f"""
dim_store as (
  select {key("id")} as store_key, id as store_id, store_name, address, phone_number from src_store
  union all select -2, -2, 'Unknown', 'Unknown', 'Unknown'),
dim_payment_method as (
  select {key("id")} as payment_method_key, id as payment_method_id, method as payment_method_name from src_payment_method
  union all select -2, -2, 'Unknown'),
dim_promotion as (
  select {key("id")} as promotion_key, id as promotion_id,
         case when type = 'fixed_amount' then format('{{:,}}', cast(round(amount) as bigint)) || ' VND off'
              when amount = floor(amount) then cast(cast(amount as bigint) as varchar) || '% off'
              else cast(amount as varchar) || '% off' end as promotion_label,
         type as promotion_type, amount as promotion_amount, start_date, end_date
  from src_promotion
  union all select -1, -1, 'No promotion', null, null, null, null
  union all select -2, -2, 'Unknown', null, null, null, null),
dim_product as (
  select {key("h.product_id", "h.valid_from")} as product_key, product_id, product_sku, product_name, category_id,
         category_name, brand_id, brand_name, unit_price, unit_cost, valid_from, valid_to, is_current
  from h_product h left join src_category c on c.id = category_id left join src_brand b on b.id = brand_id
  union all
  select -2, -2, 'Unknown', 'Unknown', null, 'Unknown', null, 'Unknown', null, null, {OPEN}),
dim_employee as (
  select {key("employee_id", "valid_from")} as employee_key, employee_id, store_id, employee_name, salary, address,
         start_date, end_date, valid_from, valid_to, is_current
  from h_employee
  union all select -2, -2, -2, 'Unknown', null, null, null, null, {OPEN}),
dim_date as (
  select cast(strftime(d, '%Y%m%d') as bigint) as date_key, cast(d as date) as full_date, year(d) as year,
         quarter(d) as quarter, month(d) as month, monthname(d) as month_name, day(d) as day_of_month,
         isodow(d) as day_of_week, dayname(d) as day_name, weekofyear(d) as week_of_year, isodow(d) > 5 as is_weekend
  from (select {FIRST_DAY} + cast(i as integer) as d from range(4018) r(i))
  union all select -2, null, null, null, null, 'Unknown', null, null, 'Unknown', null, null),
dim_time as (
  select h * 100 + m as time_key, format('{{:02d}}:{{:02d}}:00', h, m) as time_of_day, h as hour_24, m as minute,
         case when h % 12 = 0 then 12 else h % 12 end as hour_12, case when h < 12 then 'AM' else 'PM' end as am_pm,
         case when h < 6 or h >= 22 then 'Night' when h < 12 then 'Morning' when h < 18 then 'Afternoon'
              else 'Evening' end as day_part
  from (select i // 60 as h, i % 60 as m from range(1440) r(i))
  union all select -2, null, null, null, null, 'Unknown', 'Unknown')"""

FACTS = """
line as (
  select i.* exclude (created_at, updated_at), t.store_id, t.employee_id, t.payment_method_id, t.transaction_ts,
         greatest(i.updated_at, t.updated_at) as source_updated_at,
         t.transaction_ts + interval 7 hour as local_ts
  from s_item i join s_tx t on t.transaction_id = i.transaction_id),
priced as (
  select l.*, ifnull(dp.product_key, -2) as product_key, dp.unit_cost, ifnull(de.employee_key, -2) as employee_key,
         ifnull(ds.store_key, -2) as store_key, ifnull(dm.payment_method_key, -2) as payment_method_key,
         if(l.promotion_id is null, -1, ifnull(pr.promotion_key, -2)) as promotion_key,
         ifnull(dd.date_key, -2) as date_key, ifnull(dt.time_key, -2) as time_key,
         cast(quantity * regular_price as decimal(18,2)) as gross_amount,
         cast(case pr.promotion_type
           when 'percentage' then cast(quantity * regular_price as decimal(18,2)) * pr.promotion_amount * 0.01
           when 'fixed_amount' then quantity * least(pr.promotion_amount, regular_price)
           else 0 end as decimal(20,6)) as discount_amount
  from line l
  left join dim_product dp on dp.product_id = l.product_id and l.transaction_ts >= dp.valid_from and l.transaction_ts < dp.valid_to
  left join dim_employee de on de.employee_id = l.employee_id and l.transaction_ts >= de.valid_from and l.transaction_ts < de.valid_to
  left join dim_store ds on ds.store_id = l.store_id
  left join dim_payment_method dm on dm.payment_method_id = l.payment_method_id
  left join dim_promotion pr on pr.promotion_id = l.promotion_id
  left join dim_date dd on dd.full_date = cast(l.local_ts as date)
  left join dim_time dt on dt.hour_24 = hour(l.local_ts) and dt.minute = minute(l.local_ts)),
fct as (
  select date_key, time_key, product_key, store_key, employee_key, payment_method_key, promotion_key,
         transaction_id, line_number, transaction_ts, quantity, regular_price, unit_cost, gross_amount, discount_amount,
         coupon_amount, cast(gross_amount - discount_amount - coupon_amount as decimal(20,6)) as net_amount,
         cast(quantity * unit_cost as decimal(18,2)) as cost_amount,
         cast(gross_amount - discount_amount - coupon_amount - quantity * unit_cost as decimal(20,6)) as gross_profit,
         source_updated_at
  from priced),
wide as (
  select f.transaction_id, f.line_number, f.transaction_ts, d.full_date, d.year, d.month, d.month_name, d.day_name,
         d.is_weekend, s.store_name, p.product_name, p.category_name, p.brand_name, pr.promotion_label,
         pr.promotion_type, m.payment_method_name, f.quantity, f.gross_amount, f.discount_amount, f.coupon_amount,
         f.net_amount, f.cost_amount, f.gross_profit
  from fct f, dim_date d, dim_store s, dim_product p, dim_promotion pr, dim_payment_method m
  where f.date_key = d.date_key and f.store_key = s.store_key and f.product_key = p.product_key
    and f.promotion_key = pr.promotion_key and f.payment_method_key = m.payment_method_key)"""

HEADS = f"""
report_day as (select {FIRST_DAY} - 1 + cast(i as integer) as day from range({AS_OF} - {FIRST_DAY} + 2) r(i)),
daily_now as (
  select h.employee_id, day as calendar_date, h.store_id,
         ifnull(h.start_date <= day and (h.end_date is null or h.end_date > day), false) as is_employed
  from h_employee h join report_day
    on day + interval 1 day - interval 7 hour >= h.valid_from and day + interval 1 day - interval 7 hour < h.valid_to),
daily as (
  select *, lag(is_employed) over w as prev_is_employed, lag(store_id) over w as prev_store_id
  from daily_now window w as (partition by employee_id order by calendar_date)),
step as (
  -- Yesterday and today of every employee, with the store that counts on each side.
  select employee_id, calendar_date, if(prev_is_employed, prev_store_id, null) as was_at, if(is_employed, store_id, null) as is_at
  from daily where prev_is_employed is not null),
move as (
  select employee_id, calendar_date, unnest(case
      when was_at is null then [{{'store_id': is_at, 'movement': 'joiner'}}]
      when is_at is null then [{{'store_id': was_at, 'movement': 'leaver'}}]
      else [{{'store_id': is_at, 'movement': 'transfer_in'}}, {{'store_id': was_at, 'movement': 'transfer_out'}}] end,
    recursive := true)
  from step where was_at is distinct from is_at),
move_count as (
  select store_id, cast(date_trunc('month', calendar_date) as date) as month_start,
         count(*) filter (movement = 'joiner') as joiners, count(*) filter (movement = 'leaver') as leavers,
         count(*) filter (movement = 'transfer_in') as transfers_in, count(*) filter (movement = 'transfer_out') as transfers_out
  from move group by all),
store_sales as (
  select store_id, cast(date_trunc('month', full_date) as date) as month_start, sum(net_amount) as net_revenue
  from fct join dim_store using (store_key) join dim_date using (date_key) group by all),
grid as (
  select store_key, store_id, store_name, cast(m as date) as month_start, least(last_day(m), {AS_OF}) as closing_day
  from dim_store, (select unnest(generate_series(timestamp '2020-01-01', timestamp '2026-08-01', interval 1 month)) as m)
  where store_key <> -2),
counted as (
  select g.*,
         (select count(*) from daily d where d.is_employed and d.store_id = g.store_id and d.calendar_date = g.month_start - 1) as opening_headcount,
         (select count(*) from daily d where d.is_employed and d.store_id = g.store_id and d.calendar_date = g.closing_day) as closing_headcount
  from grid g),
snapshot as (
  select g.store_key, g.store_id, g.store_name, g.month_start,
         cast(strftime(g.month_start, '%Y%m%d') as bigint) as month_start_date_key,
         opening_headcount, closing_headcount,
         ifnull(joiners, 0) as joiners, ifnull(leavers, 0) as leavers,
         ifnull(transfers_in, 0) as transfers_in, ifnull(transfers_out, 0) as transfers_out,
         (opening_headcount + closing_headcount) / 2 as average_headcount,
         ifnull(net_revenue, 0) as net_revenue, last_day(g.month_start) < {AS_OF} as is_month_closed, {AS_OF} as as_of_date
  from counted g
  left join move_count mc on mc.store_id = g.store_id and mc.month_start = g.month_start
  left join store_sales ss on ss.store_id = g.store_id and ss.month_start = g.month_start)"""

CHAIN = ",".join([SOURCES, STAGING, HISTORY, DIMS, FACTS, HEADS])

# ------------------------------------------------------------------ column types of a result
_TEXT_DATES = ["date_of_birth", "start_date", "end_date", "full_date", "month_start", "as_of_date", "calendar_date", "period", "sale_day"]
_TEXT_TIMES = ["created_at", "updated_at", "transaction_ts", "valid_from", "valid_to", "source_updated_at", "newest", "open_from", "open_to"]
_NUMBERS = ["salary", "unit_price", "unit_cost", "amount", "regular_price", "coupon_amount", "promotion_amount"]
_LINE_MONEY = ["gross_amount", "discount_amount", "net_amount", "cost_amount", "gross_profit"]
_WHOLE = ["line_number", "quantity", "year", "quarter", "month", "day_of_month", "day_of_week", "week_of_year", "hour_24", "minute", "hour_12"]


def shown(body: str, columns: str, *, sums: str = "", ratios: str = "", whole: str = "") -> str:
    """A statement whose named columns are cast the way the registered query prints them."""
    names = columns.split()
    totals, rates, ints = sums.split(), ratios.split(), whole.split()
    out = []
    for c in names:
        if c in totals:
            out.append(f"cast(round({c}, 2) as double) as {c}")
        elif c in rates:
            out.append(f"cast({c} as double) as {c}")
        elif c in ints or c in _WHOLE:
            out.append(f"cast({c} as bigint) as {c}")
        elif c in _TEXT_DATES:
            out.append(f"strftime({c}, '%Y-%m-%d') as {c}")
        elif c in _TEXT_TIMES:
            out.append(f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') as {c}")
        elif c in _NUMBERS or c in _LINE_MONEY:
            out.append(f"cast({c} as double) as {c}")
        else:
            out.append(c)
    return f"with {CHAIN}, result as ({body}) select {', '.join(out)} from result"


def _raw(name: str) -> str:
    return " ".join(schemas.RAW[name].names)


def _mart(name: str) -> str:
    return " ".join(schemas.MART[name].names)


PRODUCT = "id product_sku category_id brand_id product_name unit_price unit_cost created_at updated_at"
EMPLOYEE = _raw("employee").replace(" _load_id", "")
CUT = "timestamp '2025-01-01'"


def _rules(*rows: tuple[str, str, str], severity: str = "error") -> str:
    """One (table, rule, severity, bad_rows) row per rule from its counting statement."""
    return " union all ".join(
        f"select '{t}' as \"table\", '{r}' as rule, '{severity}' as severity, cast(({n}) as bigint) as bad_rows" for t, r, n in rows
    )


def _nulls(table: str, cte: str, cols: list[str]) -> list[tuple[str, str, str]]:
    return [(table, f"not_null {c}", f"select count(*) from {cte} where {c} is null") for c in cols]


def _where(table: str, cte: str, rule: str, bad: str) -> tuple[str, str, str]:
    return table, rule, f"select count(*) from {cte} where {bad}"


def _repeats(table: str, cte: str, rule: str, cols: str) -> tuple[str, str, str]:
    return table, rule, f"select count(*) from (select {cols} from {cte} group by {cols} having count(*) > 1)"


def _missing(table: str, child: str, col: str, parent: str, pcol: str, rule: str | None = None) -> tuple[str, str, str]:
    bad = f"select count(*) from {child} where {col} is not null and {col} not in (select {pcol} from {parent})"
    return table, rule or f"relationships {col}", bad


def _history_rules(table: str, cte: str, natural: str, tracked: list[str], type1: list[str]) -> list[tuple[str, str, str]]:
    same = " and ".join(f"a.{c} is not distinct from b.{c}" for c in tracked)
    ranked = f"select *, row_number() over (partition by {natural} order by valid_from) as nth from {cte}"
    tuples = ", ".join(type1)
    return [
        (table, "no identical adjacent", f"select count(*) from ({ranked}) a join ({ranked}) b on a.{natural} = b.{natural} and b.nth = a.nth + 1 and {same}"),
        (table, "no overlap", f"select count(*) from ({ranked}) a join ({ranked}) b on a.{natural} = b.{natural} and b.nth = a.nth + 1 and b.valid_from < a.valid_to"),
        _where(table, cte, "valid range", "valid_to <= valid_from"),
        _where(table, cte, "open end means current", "(valid_to = timestamp '9999-12-31') <> is_current"),
        (table, "first version from 1900", f"select count(*) from (select min(valid_from) as v from {cte} group by {natural}) where v <> timestamp '1900-01-01'"),
        (table, "single current", f"select count(*) from (select sum(is_current::int) as n from {cte} group by {natural}) where n <> 1"),
        (table, "type 1 consistent", f"select count(*) from (select {natural} from (select distinct {natural}, {tuples} from {cte}) group by 1 having count(*) > 1)"),
        _repeats(table, cte, "unique version", f"{natural}, valid_from"),
    ]


# Metrics as statements of their own: (kind, expression shown in the catalog, aggregate).
_REVENUE, _RECEIPTS = "cast(sum(net_amount) as double)", "count(distinct transaction_id)"
SALES_METRICS = {
    "net_revenue": ("simple", "SUM(net_amount)", "sum(net_amount)"),
    "gross_revenue": ("simple", "SUM(gross_amount)", "sum(gross_amount)"),
    "discount_amount": ("simple", "SUM(discount_amount)", "sum(discount_amount)"),
    "gross_profit": ("simple", "SUM(gross_profit)", "sum(gross_profit)"),
    "quantity_sold": ("simple", "SUM(quantity)", "sum(quantity)"),
    "transaction_count": ("simple", "COUNT(DISTINCT transaction_id)", _RECEIPTS),
    "gross_margin": (
        "ratio",
        "CAST(SUM(gross_profit) AS DOUBLE) / CAST(NULLIF(SUM(net_amount), 0) AS DOUBLE)",
        f"cast(sum(gross_profit) as double) / nullif({_REVENUE}, 0)",
    ),
    "average_basket_value": (
        "derived",
        "SUM(net_amount) / NULLIF(COUNT(DISTINCT transaction_id), 0)",
        f"{_REVENUE} / nullif({_RECEIPTS}, 0)",
    ),
}
# Levels count in the edge month of the period: the first for an opening, the last for a closing.
STAFF_METRICS = {
    "closing_headcount": ("simple", "SUM(closing_headcount)", "sum(closing_headcount) filter (month_start = last_month)"),
    "opening_headcount": ("simple", "SUM(opening_headcount)", "sum(opening_headcount) filter (month_start = first_month)"),
    "employee_months": ("simple", "SUM(average_headcount)", "sum(average_headcount)"),
    "store_net_revenue": ("simple", "SUM(net_revenue)", "sum(net_revenue)"),
    "joiners": ("simple", "SUM(joiners)", "sum(joiners)"),
    "leavers": ("simple", "SUM(leavers)", "sum(leavers)"),
    "revenue_per_employee": (
        "ratio",
        "CAST(SUM(net_revenue) AS DOUBLE) / CAST(NULLIF(SUM(average_headcount), 0) AS DOUBLE)",
        "cast(sum(net_revenue) as double) / nullif(cast(sum(average_headcount) as double), 0)",
    ),
}


def _metric_sql(name: str, grain: str | None, by: list[str]) -> str:
    sales = name in SALES_METRICS
    day = "full_date" if sales else "month_start"
    period = f"cast(date_trunc('{grain}', {day}) as date)" if grain else "null"
    if sales:
        rows, aggregate = f"select *, {period} as period from wide", SALES_METRICS[name][2]
    else:
        rows = (
            "select *, min(month_start) over (partition by period) as first_month, max(month_start) over (partition by period) as last_month "
            f"from (select *, {period} as period from snapshot)"
        )
        aggregate = STAFF_METRICS[name][2]
    keys = [*(["period"] if grain else []), *by]
    group = f" group by {', '.join(keys)}" if keys else ""
    return f"select {', '.join([*keys, f'{aggregate} as {name}'])} from ({rows}){group}"


_COUNTED = {"quantity_sold", "transaction_count", "closing_headcount", "opening_headcount", "joiners", "leavers"}
_RATES = {"gross_margin", "average_basket_value", "revenue_per_employee", "employee_months"}


def _metric(name: str, grain: str | None, by: list[str]) -> str:
    kind = {"whole": name} if name in _COUNTED else {"ratios": name} if name in _RATES else {"sums": name}
    cols = " ".join([*(["period"] if grain else []), *by, name])
    return shown(_metric_sql(name, grain, by), cols, **kind)


def statements() -> dict[str, str]:
    q: dict[str, str] = {}

    # scans and loads
    for name in schemas.RAW:
        q[f"scan_{name}"] = shown(f"select * from src_{name}", _raw(name))
    q["extract_incremental"] = shown(f"select * from one_product where updated_at >= {CUT}", PRODUCT)
    q["drop_boundary"] = shown(
        f"select * from one_product where updated_at > {CUT} or (updated_at = {CUT} and brand_id > 12)", PRODUCT
    )
    q["append_loads"] = shown(
        "select *, case when updated_at <= timestamp '2024-01-15' then 1 else 2 end as _load_id from one_employee",
        _raw("employee"),
        whole="_load_id",
    )
    q["replace_table"] = shown("select * from src_promotion_product", _raw("promotion_product"))
    newest = "select * from one_product qualify row_number() over (partition by id order by updated_at desc) = 1"
    q["latest_product"] = shown(newest, PRODUCT)
    q["guarded_changes"] = shown(
        f"select id, unit_cost + if(unit_cost < 950, 100, 0) as unit_cost, unit_price from ({newest})", "id unit_cost unit_price"
    )
    q["explode_lines"] = shown(
        "select transaction_id, i as line_number, store_id + i as product_id, i * 2 as quantity "
        "from s_tx, range(1, 6) r(i) where i <= payment_method_id",
        "transaction_id line_number product_id quantity",
        whole="product_id",
    )
    q["upsert_snapshot"] = shown(
        "select transaction_id, employee_id, transaction_ts, store_id + if(transaction_ts >= timestamp '2024-06-01' "
        "and employee_id < 100, 1, 0) as store_id from s_tx",
        "transaction_id employee_id transaction_ts store_id",
    )

    # staging, history, dimensions
    q["stg_store"] = shown("select id as store_id, * exclude (id) from src_store", "store_id store_name address phone_number created_at updated_at")
    q["stg_category"] = shown("select id as category_id, category_name from src_category", "category_id category_name")
    q["stg_brand"] = shown("select id as brand_id, brand_name from src_brand", "brand_id brand_name")
    q["stg_payment_method"] = shown("select id as payment_method_id, method from src_payment_method", "payment_method_id method")
    q["stg_promotion"] = shown("select id as promotion_id, * exclude (id) from src_promotion", "promotion_id type amount start_date end_date")
    q["stg_promotion_product"] = shown("from src_promotion_product", "product_id promotion_id")
    for name in ["stg_product", "materialized_table"]:
        q[name] = shown("from n_product", PRODUCT.replace("id ", "product_id ", 1))
    q["stg_employee"] = shown("from n_employee", EMPLOYEE.replace("id ", "employee_id ", 1))
    q["stg_sales_transaction"] = shown("from s_tx", "transaction_id store_id employee_id payment_method_id transaction_ts created_at updated_at")
    q["stg_completed_items"] = shown("from s_item", _raw("sales_transaction_item").replace(" _load_id", ""))
    for name in ["scd2_product", "scd2_maintained"]:
        q[name] = shown("from h_product", "product_id product_sku product_name category_id brand_id unit_price unit_cost valid_from valid_to is_current")
    q["scd2_employee"] = shown("from h_employee", "employee_id employee_name salary address start_date end_date store_id valid_from valid_to is_current")
    for name in ["dim_store", "dim_payment_method", "dim_promotion", "dim_product", "dim_employee"]:
        q[name] = shown(f"from {name}", _mart(name))
    q["dim_date"] = shown("select d.*, (select count(*) from fct f where f.date_key = d.date_key) as lines from dim_date d", _mart("dim_date") + " lines")
    q["dim_time"] = shown("select d.*, (select count(*) from fct f where f.time_key = d.time_key) as lines from dim_time d", _mart("dim_time") + " lines")
    q["employees_without_pii"] = shown("from dim_employee", "employee_key employee_id store_id employee_name start_date end_date valid_from valid_to is_current")
    for name in ["pit_product", "pit_product_merged"]:
        q[name] = shown(
            "select transaction_id, line_number, l.product_id, valid_from, unit_cost from line l left join h_product h "
            "on h.product_id = l.product_id and transaction_ts >= valid_from and transaction_ts < valid_to",
            "transaction_id line_number product_id valid_from unit_cost",
        )

    # facts
    for name in ["fct_sales", "fct_sales_bucketed", "fct_sales_incremental", "full_refresh", "late_rows_repaired", "stream_upsert_fact"]:
        q[name] = shown("from fct", _mart("fct_sales"))
    q["night_committed"] = shown(f"from fct where source_updated_at < {CUT}", _mart("fct_sales"))
    q["fct_sales_enriched"] = shown("from wide", _mart("fct_sales_enriched"))
    q["employee_daily_store"] = shown("from daily", "employee_id calendar_date is_employed store_id prev_is_employed prev_store_id")
    q["headcount_movements"] = shown("from move", "employee_id calendar_date store_id movement")
    q["movement_counts"] = shown("from move_count", "store_id month_start joiners leavers transfers_in transfers_out")
    for name in ["headcount_monthly", "headcount_incremental"]:
        q[name] = shown("from snapshot", _mart("fct_store_headcount_monthly"), sums="net_revenue")
    q["employed_by_day"] = shown(
        "select cast(calendar_date as date) as calendar_date, count(*) filter (start_date <= calendar_date and (end_date is null or end_date > calendar_date)) as employed_at_end, "
        "count(*) as can_sell from h_employee join (select day as calendar_date from report_day where day >= date '2020-01-01') "
        "on start_date <= calendar_date and (end_date is null or end_date >= calendar_date) where is_current group by 1",
        "calendar_date employed_at_end can_sell",
    ).replace("as calendar_date, employed_at_end, can_sell from result", "as day, employed_at_end, can_sell from result")
    q["promotion_use"] = shown(
        "select l.promotion_id, cast(l.local_ts as date) between p.start_date and p.end_date as running, count(*) as lines "
        "from line l join src_promotion p on p.id = l.promotion_id group by 1, 2",
        "promotion_id running lines",
    )
    q["closing_recount"] = shown(
        "select store_id, month_start, closing_headcount as headcount from ("
        "select d.store_id, m.month_start, count(*) as closing_headcount from daily d join "
        "(select distinct month_start, closing_day from grid) m on d.calendar_date = m.closing_day where d.is_employed group by all)",
        "store_id month_start headcount",
    )
    q["receipt_facts"] = shown(
        "select transaction_id, store_key, date_key, time_key, count(*) as line_count, sum(quantity) as quantity, "
        "sum(net_amount) as basket_value, sum(gross_profit) as gross_profit from fct group by all",
        "transaction_id store_key date_key time_key line_count quantity basket_value gross_profit",
        sums="basket_value gross_profit",
    )
    dims = ["date", "time", "product", "store", "employee", "payment_method", "promotion"]
    flags = ", ".join(f"count(*) filter ({d}_key = -2) as {d}_unknown" for d in dims)
    anywhere = " or ".join(f"{d}_key = -2" for d in dims)
    q["unknown_key_rows"] = shown(f'select count(*) as "rows", {flags} from fct where {anywhere}', '"rows" ' + " ".join(f"{d}_unknown" for d in dims))
    q["pinned_cost"] = shown("select count(*) as bad_rows from fct f join dim_product p using (product_key) where f.unit_cost is distinct from p.unit_cost", "bad_rows")
    q["what_if_cost"] = shown(
        "select store_name, sum(gross_profit) as gross_profit, "
        "sum(cast(net_amount - cast(cost_amount * 1.05 as decimal(20,6)) as decimal(20,6))) as new_gross_profit, "
        "round(cast(sum(gross_profit) as double) / cast(sum(net_amount) as double), 6) as gross_margin, "
        "round(cast(new_gross_profit as double) / cast(sum(net_amount) as double), 6) as new_gross_margin "
        "from fct join dim_store using (store_key) group by store_name",
        "store_name gross_profit new_gross_profit gross_margin new_gross_margin",
        sums="gross_profit new_gross_profit",
        ratios="gross_margin new_gross_margin",
    )
    q["promotion_coverage"] = shown(
        "select p.id as promotion_id, cast(d.full_date as date) as full_date, count(*) as products_without_sale "
        "from src_promotion_product b join src_promotion p on p.id = b.promotion_id "
        "join dim_date d on d.full_date between p.start_date and p.end_date "
        "where not exists (select 1 from line l where l.product_id = b.product_id and l.promotion_id = b.promotion_id "
        "and cast(l.local_ts as date) = d.full_date) group by all",
        "promotion_id full_date products_without_sale",
    )

    # metrics and reports
    for name in SALES_METRICS:
        q[f"metric_{name}"] = _metric(name, "month", ["store_name"])
    for name in STAFF_METRICS:
        q[f"metric_{name}"] = _metric(name, "quarter", ["store_name"])
    edges = "select cast(date_trunc('quarter', month_start) as date) as period, min(month_start) as lo, max(month_start) as hi from snapshot group by 1"
    q["metric_closing_headcount_by_quarter"] = shown(
        "select e.period, sum(opening_headcount) filter (month_start = lo) as opening_headcount, "
        "sum(closing_headcount) filter (month_start = hi) as closing_headcount from snapshot "
        f"join ({edges}) e on e.period = date_trunc('quarter', month_start) group by 1",
        "period opening_headcount closing_headcount",
        whole="opening_headcount closing_headcount",
    )
    counts = "count(distinct transaction_id) as transaction_count, sum(quantity) as quantity_sold from wide group by all"
    asked = [("null", g) for g in ("day", "month", "quarter", "year")] + [("store_name", "month"), ("category_name", "quarter")]
    q["metric_transaction_count_rollup"] = shown(
        " union all ".join(f"select '{g}' as grain, cast(date_trunc('{g}', full_date) as date) as period, {m} as member, {counts}" for m, g in asked),
        "grain period member transaction_count quantity_sold",
        whole="quantity_sold",
    )
    q["metric_headcount_total"] = shown(
        "select store_name, sum(opening_headcount) filter (month_start = date '2020-01-01') as opening_headcount, "
        "sum(closing_headcount) filter (month_start = date '2026-08-01') as closing_headcount, sum(joiners) as joiners "
        "from snapshot group by 1",
        "store_name opening_headcount closing_headcount joiners",
        whole="opening_headcount closing_headcount joiners",
    )
    q["metrics_side_by_side"] = shown(
        f"select period, store_name, net_revenue, closing_headcount from ({_metric_sql('net_revenue', 'year', ['store_name'])}) "
        f"full join ({_metric_sql('closing_headcount', 'year', ['store_name'])}) using (period, store_name)",
        "period store_name net_revenue closing_headcount",
        sums="net_revenue",
        whole="closing_headcount",
    )
    cat = " union all ".join(
        f"select '{n}' as metric, '{t}' as type, '{tab}' as \"table\", '{e}' as expression, "
        f"round(cast(v as double), 3) as value "
        f"from (select {n} as v from ({_metric_sql(n, None, [])}))"
        for tab, held in (("fct_sales_enriched", SALES_METRICS), ("fct_store_headcount_monthly", STAFF_METRICS))
        for n, (t, e, _) in held.items()
    )
    q["metric_catalog"] = shown(cat, 'metric type "table" expression value')
    q["report_revenue_by_month"] = _metric("net_revenue", "month", [])
    q["report_profit_by_month"] = _metric("gross_profit", "month", [])
    q["report_revenue_by_category"] = _metric("net_revenue", None, ["category_name"])
    q["report_revenue_by_store"] = _metric("net_revenue", None, ["store_name"])
    q["report_revenue_per_employee"] = _metric("revenue_per_employee", "month", ["store_name"])
    q["report_promotion_impact_top20"] = shown(
        "select promotion_label, sum(net_amount) as net_revenue, sum(discount_amount) as discount_amount from wide "
        "where promotion_label <> 'No promotion' group by 1 order by 2 desc, 1 limit 20",
        "promotion_label net_revenue discount_amount",
        sums="net_revenue discount_amount",
    )
    q["report_filtered"] = shown(
        "select cast(date_trunc('year', full_date) as date) as period, category_name, sum(net_amount) as net_revenue, "
        "count(distinct transaction_id) as transaction_count from wide where store_name = 'NATION_3' "
        "and full_date >= date '2022-01-01' and full_date < date '2024-01-01' group by 1, 2",
        "period category_name net_revenue transaction_count",
        sums="net_revenue",
    )
    q["report_profit_by_cashier"] = shown(
        "select employee_id, employee_name, count(distinct transaction_id) as transaction_count, sum(net_amount) as net_revenue, "
        "sum(gross_profit) as gross_profit from fct join dim_employee using (employee_key) group by 1, 2",
        "employee_id employee_name transaction_count net_revenue gross_profit",
        sums="net_revenue gross_profit",
    )
    q["report_receipts_by_day_part"] = shown(
        "select day_part, count(distinct transaction_id) as transaction_count, sum(net_amount) as net_revenue "
        "from fct join dim_time using (time_key) group by 1",
        "day_part transaction_count net_revenue",
        sums="net_revenue",
    )
    q["reconcile_totals"] = shown(
        "select unnest(['fact', 'category', 'store', 'month']) as breakdown, (select sum(net_amount) from fct) as net_revenue",
        "breakdown net_revenue",
        sums="net_revenue",
    )
    q["gross_profit_by_store"] = shown(
        "select store_name, count(*) as lines, sum(net_amount) as net_revenue, sum(gross_profit) as profit "
        "from fct join dim_store using (store_key) group by 1",
        "store_name lines net_revenue profit",
        sums="net_revenue profit",
    )

    # quality
    rule_cols = '"table" rule severity bad_rows'
    statuses = "('completed', 'cancelled', 'returned')"
    tx, item = "sales_transaction", "sales_transaction_item"
    positive = lambda t, cols: [_where(t, f"src_{t}", f"accepted_range {c}", f"{c} < 0") for c in cols]
    empty = lambda t: (t, "row_count >= 1", f"select if(count(*) >= 1, 0, 1) from src_{t}")
    q["raw_expectations"] = shown(
        _rules(
            *_nulls(tx, f"src_{tx}", ["transaction_id", "store_id", "employee_id", "payment_method_id", "transaction_ts", "updated_at"]),
            _where(tx, f"src_{tx}", "accepted_values status", f"status not in {statuses}"),
            empty(tx),
            *_nulls(item, f"src_{item}", ["transaction_id", "line_number", "product_id", "quantity", "regular_price"]),
            _where(item, f"src_{item}", "accepted_range quantity", "quantity < 1"),
            *positive(item, ["regular_price", "coupon_amount"]),
            empty(item),
            *_nulls("product", "src_product", ["id", "product_sku", "unit_price", "unit_cost", "updated_at"]),
            *positive("product", ["unit_price", "unit_cost"]),
            empty("product"),
            *_nulls("employee", "src_employee", ["id", "store_id", "updated_at"]),
            *positive("employee", ["salary"]),
            empty("employee"),
        ),
        rule_cols,
    )
    q["source_rules"] = shown(
        _rules(
            *positive("employee", ["salary"]),
            _where("employee", "src_employee", "expression end_date >= start_date", "end_date < start_date"),
            *positive("product", ["unit_price", "unit_cost"]),
            _where("promotion", "src_promotion", "accepted_values type", "type not in ('percentage', 'fixed_amount')"),
            _where("promotion", "src_promotion", "accepted_range amount", "amount <= 0"),
            _where("promotion", "src_promotion", "percentage <= 100", "type = 'percentage' and amount > 100"),
            _where("promotion", "src_promotion", "expression end_date >= start_date", "end_date < start_date"),
            _where(tx, f"src_{tx}", "accepted_values status", f"status not in {statuses}"),
            _where(item, f"src_{item}", "accepted_range line_number", "line_number <= 0"),
            _where(item, f"src_{item}", "accepted_range quantity", "quantity <= 0"),
            *positive(item, ["regular_price", "coupon_amount"]),
            _repeats("store", "src_store", "unique store_name", "store_name"),
            _repeats("category", "src_category", "unique category_name", "category_name"),
            _repeats("brand", "src_brand", "unique brand_name", "brand_name"),
            _repeats("payment_method", "src_payment_method", "unique method", "method"),
            _repeats("product", "(select distinct id, product_sku from src_product)", "unique product_sku", "product_sku"),
            (item, "promotion pair exists", f"select count(*) from src_{item} i where promotion_id is not null and not exists "
             "(select 1 from src_promotion_product b where b.product_id = i.product_id and b.promotion_id = i.promotion_id)"),
        ),
        rule_cols,
    )
    newest_of = " union all ".join(f"select '{t}' as \"table\", max(updated_at) as newest from src_{t}" for t in schemas.APPENDED)
    age = "date_diff('second', newest, timestamp '2026-08-02 12:00:00')"
    q["freshness"] = shown(
        f"select \"table\", newest, round({age} / 3600.0, 1) as hours, case when newest is null then 'missing' "
        f"when {age} > 3 * 86400 then 'error' when {age} > 26 * 3600 then 'warn' else 'pass' end as status from ({newest_of})",
        '"table" newest hours status',
        ratios="hours",
    )
    q["relationships_orphans"] = shown(
        _rules(*[_missing("fct_sales", "fct", f"{d}_key", f"dim_{d}", f"{d}_key") for d in dims]), rule_cols
    )
    q["staging_relationships"] = shown(
        _rules(
            _missing("stg_sales_transaction", "s_tx", "store_id", "src_store", "id"),
            _missing("stg_sales_transaction", "s_tx", "payment_method_id", "src_payment_method", "id"),
            _missing("stg_sales_transaction_item", "s_item", "transaction_id", "s_tx", "transaction_id"),
            _missing("stg_sales_transaction_item", "s_item", "promotion_id", "src_promotion", "id"),
        ),
        rule_cols,
    )
    stg_keys = {
        "store": ("(select id as store_id from src_store)", ["store_id"]),
        "category": ("(select id as category_id from src_category)", ["category_id"]),
        "brand": ("(select id as brand_id from src_brand)", ["brand_id"]),
        "promotion": ("(select id as promotion_id from src_promotion)", ["promotion_id"]),
        "payment_method": ("(select id as payment_method_id from src_payment_method)", ["payment_method_id"]),
        "promotion_product": ("src_promotion_product", ["promotion_id", "product_id"]),
        "product": ("n_product", ["product_id", "updated_at"]),
        "employee": ("n_employee", ["employee_id", "updated_at"]),
        tx: ("s_tx", ["transaction_id"]),
        item: ("s_item", ["transaction_id", "line_number"]),
    }
    q["staging_keys"] = shown(
        _rules(
            *[r for t, (cte, cols) in stg_keys.items() for r in _nulls(f"stg_{t}", cte, cols)],
            *[_repeats(f"stg_{t}", cte, "unique " + " ".join(cols), ", ".join(cols)) for t, (cte, cols) in stg_keys.items()],
        ),
        rule_cols,
    )
    q["scd2_checks_product"] = shown(
        _rules(
            *_history_rules("product_history", "h_product", "product_id", ["category_id", "brand_id", "unit_price", "unit_cost"], ["product_sku", "product_name"]),
            ("product_history", "complete", "select count(distinct product_id) from n_product where product_id not in (select product_id from h_product)"),
        ),
        rule_cols,
    )
    ranked = "select *, lead(valid_from) over (partition by employee_id order by valid_from) as n from h_employee"
    q["scd2_checks_employee"] = shown(
        _rules(
            *_history_rules("employee_history", "h_employee", "employee_id", ["store_id"], ["employee_name", "salary", "address", "start_date", "end_date"]),
            ("employee_history", "no gap", f"select count(*) from ({ranked}) where n <> valid_to"),
        ),
        rule_cols,
    )
    truths = ["net_amount >= 0", "discount_amount <= gross_amount", "quantity > 0", "gross_amount >= 0", "coupon_amount >= 0"]
    q["fact_rules"] = shown(
        _rules(
            *[_where("fct_sales", "fct", f"expression {t}", f"not ({t})") for t in truths],
            _repeats("fct_sales", "fct", "unique line", "transaction_id, line_number"),
        )
        + " union all "
        + _rules(_where("fct_sales", "fct", "not_null unit_cost", "unit_cost is null"), severity="warn"),
        rule_cols,
    )
    methods = "('cash', 'card', 'e_wallet', 'bank_transfer', 'Unknown')"
    q["dim_rules"] = shown(
        _rules(
            _where("dim_payment_method", "dim_payment_method", "accepted_values payment_method_name", f"payment_method_name not in {methods}"),
            _where("dim_promotion", "dim_promotion", "accepted_values promotion_type", "promotion_type not in ('fixed_amount', 'percentage')"),
            _where("dim_promotion", "dim_promotion", "accepted_range promotion_amount", "promotion_amount <= 0"),
            _where("dim_date", "dim_date", "not_null full_date", "full_date is null and date_key <> -2"),
            _where("dim_time", "dim_time", "accepted_range hour_24", "hour_24 not between 0 and 23"),
            _where("dim_time", "dim_time", "accepted_range minute", "minute not between 0 and 59"),
            ("dim_date", "contiguous", "select count(*) from (select count(*) as n, max(full_date) - min(full_date) + 1 as s from dim_date where date_key <> -2) where n <> 4018 or s <> n"),
            ("dim_time", "1440 minutes", "select if(count(*) = 1440, 0, 1) from dim_time where time_key <> -2"),
            *[_repeats(f"dim_{d}", f"dim_{d}", f"unique {d}_key", f"{d}_key") for d in ["product", "store", "employee", "payment_method", "promotion"]],
        ),
        rule_cols,
    )
    mart_ctes = {"fct_sales": "fct", "fct_sales_enriched": "wide", "fct_store_headcount_monthly": "snapshot"}
    q["contract_nulls"] = shown(
        _rules(
            *[r for n, st in schemas.MART.items() for r in _nulls(n, mart_ctes.get(n, n), [f.name for f in st.fields if not f.nullable])]
        ),
        rule_cols,
    )
    q["row_count_matches"] = shown(
        _rules(("fct_sales vs source", "same totals", "select if((select count(*) from line) = (select count(*) from fct), 0, 1)")), rule_cols
    )
    compared = ["count(*)", "sum(net_amount)", "sum(gross_profit)"]
    q["enriched_matches"] = shown(
        _rules(("fct_sales_enriched vs fct_sales", "same totals", "select " + " + ".join(
            f"if((select {c} from fct) is distinct from (select {c} from wide), 1, 0)" for c in compared))),
        rule_cols,
    )
    models = {
        "fct_sales_enriched": ("wide", ["transaction_id", "line_number"], ["full_date", "store_name", "product_name", "category_name", "brand_name", "promotion_label", "payment_method_name"]),
        "fct_store_headcount_monthly": ("snapshot", ["store_id", "month_start"], ["month_start", "store_name", "is_month_closed"]),
    }
    q["metric_models_valid"] = shown(
        _rules(
            *[r for t, (cte, entity, others) in models.items() for r in _nulls(t, cte, [*entity, *others])],
            *[_repeats(t, cte, "unique entity", ", ".join(entity)) for t, (cte, entity, _) in models.items()],
        ),
        rule_cols,
    )
    snap = "fct_store_headcount_monthly"
    per_store = f"select store_id from grid group by store_id having count(*) <> 80"
    q["headcount_checks"] = shown(
        _rules(
            (snap, "complete", f"select count(*) from ({per_store})"),
            _where(snap, "snapshot", "one as-of day", f"as_of_date <> {AS_OF}"),
            _where(snap, "snapshot", "closed flag", "is_month_closed = (month_start = date_trunc('month', as_of_date))"),
            _where(snap, "snapshot", "closing = opening + flows", "closing_headcount <> opening_headcount + joiners + transfers_in - leavers - transfers_out"),
            _where(snap, "snapshot", "expression opening_headcount >= 0 and closing_headcount >= 0", "opening_headcount < 0 or closing_headcount < 0"),
            (snap, "opening = previous closing", "select count(*) from snapshot a join snapshot b on a.store_id = b.store_id and b.month_start = a.month_start + interval 1 month where b.opening_headcount <> a.closing_headcount"),
            (snap, "closing = history", "select count(*) from (select s.closing_headcount, (select count(distinct employee_id) from h_employee h where h.store_id = s.store_id "
             f"and h.start_date <= least(last_day(s.month_start), {AS_OF}) and (h.end_date is null or h.end_date > least(last_day(s.month_start), {AS_OF})) "
             f"and h.valid_from <= least(last_day(s.month_start), {AS_OF}) + interval 17 hour and h.valid_to > least(last_day(s.month_start), {AS_OF}) + interval 17 hour) as n from snapshot s) where n <> closing_headcount"),
            (snap, "revenue = fct_sales", "select count(*) from snapshot s left join store_sales x on x.store_id = s.store_id and x.month_start = s.month_start where s.net_revenue <> ifnull(x.net_revenue, 0)"),
        ),
        rule_cols,
    )
    q["revenue_differences"] = shown(
        _rules(
            (snap, "revenue by store and month", "select count(*) from store_sales x full join snapshot s using (store_id, month_start) where ifnull(s.net_revenue, 0) <> ifnull(x.net_revenue, 0)"),
            (snap, "revenue in total", "select if((select sum(net_revenue) from snapshot) = (select sum(net_revenue) from store_sales), 0, 1)"),
        ),
        rule_cols,
    )
    q["status_changes"] = shown(
        _rules((tx, "status never changes", f"select count(*) from (select transaction_id from src_{tx} group by 1 having count(distinct status) > 1)")), rule_cols
    )
    q["status_distribution"] = shown('select status, count(*) as "rows" from one_tx group by 1', 'status "rows"')
    q["distinct_tuples"] = shown(
        "select product_id, count(*) as tuples from (select distinct product_id, unit_price, unit_cost from h_product) group by 1", "product_id tuples"
    )
    q["unique_copies"] = shown(
        f'select transaction_id, line_number, count(*) as "rows" from src_{item} group by 1, 2 having count(*) > 1', 'transaction_id line_number "rows"'
    )
    h = key("transaction_id", "store_id", "employee_id", "payment_method_id")
    q["fingerprint"] = shown(
        f'select count(*) as "rows", cast(sum(cast(h as hugeint)) as varchar) as hash_sum, bit_xor(h) as hash_xor from (select {h} as h from s_tx)',
        '"rows" hash_sum hash_xor',
    )
    q["invalid_promo_pairs"] = shown(
        'select product_id, promotion_id, count(*) as "rows" from s_item i where promotion_id is not null and not exists '
        "(select 1 from src_promotion_product b where b.product_id = i.product_id and b.promotion_id = i.promotion_id) group by all",
        'product_id promotion_id "rows"',
    )
    seller = (
        "select t.transaction_id, t.store_id, t.employee_id, e.store_id as home, cast(t.transaction_ts + interval 7 hour as date) as sale_day "
        "from s_tx t join h_employee e on e.employee_id = t.employee_id and e.is_current "
        "where e.store_id <> t.store_id or sale_day < e.start_date or sale_day > e.end_date"
    )
    q["bad_sellers"] = shown(seller, "transaction_id store_id employee_id home sale_day")
    q["sales_integrity"] = shown(
        _rules(
            ("sales", "seller belongs and is employed", f"select count(*) from ({seller})"),
            ("sales", "lines contiguous", "select count(*) from s_tx t left join (select transaction_id, count(*) as n, min(line_number) as lo, max(line_number) as hi from s_item group by 1) i "
             "on i.transaction_id = t.transaction_id where n is null or lo <> 1 or hi <> n"),
            ("sales", "price list and running promotion", "select count(*) from line l join h_product p on p.product_id = l.product_id and p.is_current left join src_promotion r on r.id = l.promotion_id "
             "where l.regular_price <> p.unit_price or cast(l.local_ts as date) not between r.start_date and r.end_date"),
            _missing("sales", "s_tx", "store_id", "src_store", "id", "store exists"),
            _missing("sales", "s_tx", "payment_method_id", "src_payment_method", "id", "payment method exists"),
            _where("sales", "s_tx", "opening hours", "hour(transaction_ts + interval 7 hour) not between 7 and 21"),
            _where("sales", "s_tx", "updated after sale", "updated_at < transaction_ts"),
        ),
        rule_cols,
    )

    # analyses
    q["rolling_median_threshold"] = shown(
        "select *, if(median_before is null, null, greatest(2 * median_before, 100000)) as threshold, "
        "ifnull(cast(net_revenue as double) > threshold, false) as is_above from ("
        "select store_name, full_date, net_revenue, if(count(*) over w = 14, quantile_cont(cast(net_revenue as double), 0.5) over w, null) as median_before "
        "from (select d.store_name, d.full_date, ifnull(net_revenue, 0) as net_revenue from ("
        "select store_name, cast(unnest(generate_series(min(full_date), max(full_date), interval 1 day)) as date) as full_date from wide group by 1) d "
        "left join (select store_name, full_date, sum(net_amount) as net_revenue from wide group by 1, 2) s "
        "on s.store_name = d.store_name and s.full_date = d.full_date) "
        "window w as (partition by store_name order by full_date rows between 14 preceding and 1 preceding))",
        "store_name full_date net_revenue median_before threshold is_above",
        sums="net_revenue",
        ratios="median_before threshold",
    )
    q["business_hours"] = shown(
        "select transaction_id, greatest(a, day + interval 7 hour) as open_from, least(b, day + interval 22 hour) as open_to from ("
        "select transaction_id, transaction_ts + interval 7 hour as a, transaction_ts + interval 7 hour + to_hours(store_id * 3) as b from s_tx) "
        "join (select unnest(generate_series(timestamp '2019-12-31', timestamp '2026-09-01', interval 1 day)) as day) "
        "on day >= date_trunc('day', a) and day <= date_trunc('day', b) "
        "where greatest(a, day + interval 7 hour) < least(b, day + interval 22 hour)",
        "transaction_id open_from open_to",
    )

    def grid(x: str, step: int) -> str:
        return f"(round_even(cast({x} as double) / {step}, 0) * {step})"

    def shifted(x: str, pct: str, step: int) -> str:
        new, old = grid(f"{x} * (1 + {pct})", step), grid(x, step)
        return f"greatest(0, if({new} = {old}, {new} + if({pct} > 0, {step}, -{step}), {new}))"

    pct = "(brand_id - 13) * 0.01"
    ppct = "(brand_id - 9) * 0.01"
    q["price_revision"] = shown(
        "select id, unit_cost, unit_price, least(new_cost, new_unit_price) as new_unit_cost, new_unit_price from ("
        f"select id, unit_cost, unit_price, if(brand_id % 7 = 0, cast(unit_cost as double), {shifted('unit_cost', pct, 100)}) as new_cost, "
        f"if(unit_cost > 1000, greatest({shifted('unit_price', ppct, 1000)}, ceil(cast(unit_cost as double) / 1000) * 1000), cast(unit_price as double)) as new_unit_price "
        f"from ({newest}))",
        "id unit_cost unit_price new_unit_cost new_unit_price",
        ratios="new_unit_cost new_unit_price",
    )
    q["latest_transactions"] = shown("select transaction_id, store_id, transaction_ts from s_tx order by transaction_id desc limit 50", "transaction_id store_id transaction_ts")
    q["pick_products"] = shown(
        "select product_id, unit_cost from h_product where is_current order by md5('7:' || cast(product_id as varchar)), product_id limit 5", "product_id unit_cost"
    )

    # streams
    q["stream_ingest"] = shown("from src_employee", _raw("employee"))
    q["stream_dedupe"] = shown("from one_employee", EMPLOYEE)
    q["table_differences"] = shown(
        "select coalesce(a.transaction_id, b.transaction_id) as transaction_id, case when b.transaction_id is null then 'only first' "
        "when a.transaction_id is null then 'only second' else 'changed' end as difference "
        "from (from s_tx where transaction_id % 997 <> 5) a full join "
        "(select *, store_id + if(transaction_id between 3000 and 3100, 1, 0) as new_store from s_tx where transaction_id % 1009 <> 7) b "
        "on a.transaction_id = b.transaction_id where a.transaction_id is null or b.transaction_id is null or a.store_id <> b.new_store",
        "transaction_id difference",
    )
    q["sql_surface"] = shown(
        "select s.store_name, s.store_key, f.promotion_key, case when f.promotion_key > 0 then p.promotion_label end as promotion_label, "
        "min(year(l.local_ts) * 10000 + month(l.local_ts) * 100 + day(l.local_ts)) as first_date_key, sum(f.quantity) as quantity, "
        "count(*) filter (e.start_date <= cast(l.local_ts as date) and (e.end_date is null or e.end_date >= cast(l.local_ts as date))) as staff_lines, "
        "sum(f.gross_amount) as gross_amount, sum(f.discount_amount) as discount_amount "
        "from fct f join line l using (transaction_id, line_number) join dim_store s on s.store_key = f.store_key "
        "join dim_promotion p on p.promotion_key = f.promotion_key "
        "left join (select * from h_employee where is_current) e on e.employee_id = l.employee_id group by 1, 2, 3, 4",
        "store_name store_key promotion_key promotion_label first_date_key quantity staff_lines gross_amount discount_amount",
        sums="gross_amount discount_amount",
        whole="first_date_key",
    )
    q["stream_headers_lines"] = shown(
        "select i.transaction_id, i.line_number, i.product_id, i.promotion_id, i.quantity, i.regular_price, i.coupon_amount, "
        "case when known then h.store_id else -2 end as store_id, case when known then h.employee_id else -2 end as employee_id, "
        "case when known then h.payment_method_id else -2 end as payment_method_id, case when known then h.transaction_ts end as transaction_ts "
        "from (select distinct * exclude (_load_id) from src_sales_transaction_item) i "
        "join (select distinct * exclude (_load_id), transaction_id % 10 <> 0 as known "
        "from src_sales_transaction) h using (transaction_id) where not known or status = 'completed'",
        "transaction_id line_number product_id promotion_id quantity regular_price coupon_amount store_id employee_id payment_method_id transaction_ts",
    )
    q["stream_pit_join"] = shown(
        "select transaction_id, t.employee_id, transaction_ts, ifnull(employee_key, -2) as employee_key from s_tx t left join dim_employee e "
        "on e.employee_id = t.employee_id and transaction_ts >= valid_from and transaction_ts < valid_to",
        "transaction_id employee_id transaction_ts employee_key",
    )
    q["raw_expectations_observed"] = q["raw_expectations"]
    stale = [
        (t, "fresh", f"select count(*) from (select max(updated_at) as newest from src_{t}) where newest is null "
         "or date_diff('second', newest, timestamp '2026-08-02 23:59:59') > 26 * 3600")
        for t in schemas.APPENDED
    ]
    night = ["contract_nulls", "fact_rules", "dim_rules", "relationships_orphans", "enriched_matches", "scd2_checks_product", "scd2_checks_employee"]
    night += ["headcount_checks", "row_count_matches", "staging_relationships", "source_rules", "status_changes"]
    q["nightly_checks"] = " union all ".join(f"select * from ({q[n]})" for n in night) + f" union all select * from ({shown(_rules(*stale, severity='warn'), rule_cols)})"
    return q
