"""DuckDB SQL for every query in ``catalog``, over the same given tables.

Written independently of the Spark code: windows instead of aggregations for the
deduplication, integer cents instead of decimals, COUNT(DISTINCT) as in the
definition of the metrics. Half-up rounding to two places is integer division, so
that both engines round alike.
"""

from __future__ import annotations

import re


def _hundredths(numerator: str, denominator: str) -> str:
    """round(numerator / denominator, 2), half up, for a non-negative numerator; NULL on zero."""
    n, d = f"cast({numerator} as hugeint)", f"cast({denominator} as hugeint)"
    return (
        f"case when {denominator} > 0"
        f" then cast((200 * {n} + {d}) // (2 * {d}) as double) / 100 end"
    )


def _pct(part: str, whole: str) -> str:
    return _hundredths(f"(100 * {part})", whole)


def _money(cents: str) -> str:
    return f"cast({cents} as double) / 100"


_PICKED_REASON = (
    "case h % 5 when 0 then 'Defective' when 1 then 'Wrong item' when 2 then 'No longer needed'"
    " when 3 then 'Better price found' else 'Other' end"
)
_REVENUE = "(quantity * cents * (1000 - coalesce(disc, 0)) + 500) // 1000"


def _date_text(day: str) -> str:
    return (
        f"case when order_id % 8 = 0 then strftime({day}, '%d/%m/%Y')"
        f" else strftime({day}, '%Y-%m-%d') end"
    )


_BLANK = "' ' || chr(9)"


def _parsed(text: str) -> str:
    t = f"trim({text}, {_BLANK})"
    return (
        f"case when regexp_full_match({t}, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}')"
        f" then cast(try_strptime({t}, '%Y-%m-%d') as date)"
        f" when regexp_full_match({t}, '\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}')"
        f" then cast(try_strptime({t}, '%d/%m/%Y') as date) end"
    )


def _key(day: str) -> str:
    return f"cast(year({day}) * 10000 + month({day}) * 100 + day({day}) as bigint)"


def _calendar(days: str) -> str:
    return f"""select {_key('date')} as date_id, date, cast(year(date) as bigint) as year,
        cast(month(date) as bigint) as month, cast(day(date) as bigint) as day,
        cast(isodow(date) - 1 as bigint) as day_of_week, dayname(date) as day_name,
        cast(weekofyear(date) as bigint) as week_of_year, isodow(date) >= 6 as is_weekend
        from ({days})"""


def _series(first: str, last: str, source: str) -> str:
    return (
        f"select cast(unnest(generate_series(cast({first} as timestamp),"
        f" cast({last} as timestamp), interval 1 day)) as date) as date from {source}"
    )


def _first_rows(source: str, key: str, batch: str) -> str:
    part = f"partition by {batch}, {key}"
    return f"""select * exclude (rn) from (
        select *, {batch} as batch, row_number() over ({part} order by raw_id) as rn,
            count(*) over ({part}) as copies from {source}) where rn = 1"""


_SALES_KEY = "order_id, order_date, customer_email, product_name, quantity, cents, disc"


def _labelled_sales(batch: str) -> str:
    return f"""select f.*, p.product_id as found_product, coalesce(c.customer_id, -1) as customer_id,
        case when {_parsed('order_date')} is null then 'unparseable_date'
             when coalesce(quantity, 0) <= 0 then 'invalid_quantity'
             when coalesce(cents, 0) <= 0 then 'invalid_price'
             when v.v is null then 'unmatched_category'
             when p.product_id is null then 'unmatched_product' end as reject_reason,
        {_parsed('order_date')} as order_day
        from ({_first_rows('raw_sales', _SALES_KEY, batch)}) f
        left join kinds v on lower(v.v) = lower(trim(f.category, {_BLANK}))
        left join product_ids p on p.category = v.v and p.product_name = f.product_name
        left join customer_ids c on c.email = nullif(f.customer_email, '')"""


def _labelled_marketing(batch: str) -> str:
    return f"""select f.raw_id, batch, copies, v.v as channel, cents, {_parsed('spend_date')} as day,
        case when {_parsed('spend_date')} is null then 'unparseable_date'
             when v.v is null then 'unmatched_channel'
             when cents is null then 'null_amount' end as reject_reason
        from ({_first_rows('raw_marketing', 'spend_date, channel, cents', batch)}) f
        left join channels v on lower(v.v) = lower(trim(f.channel, {_BLANK}))"""


def _labelled_returns(source: str, batch: str) -> str:
    return f"""select *, {_parsed('return_date')} as day,
        case when {_parsed('return_date')} is null then 'unparseable_date'
             when cents is null then 'null_amount' end as reject_reason
        from ({_first_rows(source, 'order_line_id, return_date, reason', batch)})"""


_SEED_DAY = "(select max(order_day) - 14 from hdr)"
_LAST_DAY = "(select max(order_day) from hdr)"
_BATCH = f"greatest(exported_on, {_SEED_DAY})"

# Named building blocks; each may use the ones before it.
CTES = {
    "hdr": """select o_orderkey as order_id, o_custkey as account_id,
        cast(o_orderdate as date) as order_day, o_totalprice from orders""",
    "li": """select *, h * 2 as line_id from (
        select *,
            ((999983 * order_id + 700001 * l_linenumber + 610639 * product_id + 523777 * l_suppkey
                + 411001 * cents + 304729 * disc) % 1073741789) * 1073741824
            + (882377 * order_id + 762121 * l_linenumber + 655357 * product_id + 444443 * l_suppkey
                + 333331 * cents + 222199 * disc) % 1073741783 as h
        from (select l_orderkey as order_id, l_partkey as product_id,
                cast(l_linenumber as bigint) as l_linenumber, l_suppkey,
                cast(round(l_quantity) as bigint) as quantity,
                cast(floor(l_extendedprice * 100 / l_quantity) as bigint) as cents,
                cast(round(l_discount * 1000) as bigint) as disc,
                l_returnflag = 'R' as returned
            from lineitem))""",
    "lo": f"""select li.*, account_id, order_day, {_REVENUE} as rev
        from li join hdr using (order_id)""",
    "cust": """select -1 as customer_id, 'Guest account' as full_name,
            'guest@checkout.invalid' as email, 'Unknown' as region,
            'Unknown' as acquisition_channel, date '1995-01-01' as signup_date, 0 as activity_score
        union all
        select a.id, a.name, a.email, r_name, a.channel,
            date '1995-01-01' + cast((a.k * 37) % 2400 as integer), 1
        from (select c_custkey as id, c_custkey as k, c_name as name, c_nationkey as nation,
                  'customer.' || c_custkey || '@example.com' as email, c_mktsegment as channel
              from customer
              union all
              select -2 - s_suppkey, s_suppkey, s_name, s_nationkey,
                  'supplier.' || s_suppkey || '@example.com', 'PARTNER' from supplier) a
        join nation on n_nationkey = a.nation join region on r_regionkey = n_regionkey""",
    "prod": """select p_partkey as product_id, p_name as product_name, p_type as category,
        cast(round(p_retailprice * 100) as bigint) as cents from part""",
    "span": "select min(order_day) as first, max(order_day) as last from hdr",
    "cal": _calendar(_series("first", "last + 25", "span")),
    "fo": f"""select line_id as order_line_id, order_id,
        case when order_id % 100 = 0 then -1 else account_id end as customer_id, product_id,
        {_key('order_day')} as date_id, quantity, cents, disc, rev from lo""",
    "ret": f"""select line_id as return_id, line_id as order_line_id,
        {_key('(order_day + 5 + cast(h % 21 as integer))')} as date_id,
        {_PICKED_REASON} as reason, rev as cents from lo where returned""",
    "paid": """select order_id, order_day, c_mktsegment as channel,
        cast(floor(o_totalprice) as bigint) as cents
        from hdr join customer on c_custkey = account_id""",
    "spend": f"""select min(order_id) as spend_id, {_key('order_day')} as date_id, channel,
        sum(cents) as cents from paid group by order_day, channel""",
    # --- exports
    "raw_sales": f"""select line_id + copy as raw_id, order_id,
        case when order_id % 211 = 0 then 'not-a-date' when order_id % 223 = 0 then null
             else {_date_text('order_day')} end as order_date,
        case when order_id % 100 = 0 then null when order_id % 101 = 0 then ''
             when order_id % 103 = 0 then 'nobody@unknown.example'
             else 'customer.' || account_id || '@example.com' end as customer_email,
        case when h % 157 = 0 then 'no such product' else p_name end as product_name,
        case when copy = 1 or h % 151 = 0 then 'Bogus' when h % 163 = 0 then null
             when h % 16 = 1 then lower(p_type) when h % 16 = 2 then '  ' || p_type || '  '
             when h % 16 = 3 then chr(9) || p_type || chr(9) else p_type end as category,
        case when h % 67 = 0 then 0 when h % 71 = 0 then -quantity
             when h % 73 = 0 then null else quantity end as quantity,
        case when h % 113 = 0 then 0 when h % 127 = 0 then null else cents end as cents,
        case when h % 13 = 0 then null else disc end as disc,
        account_id, order_day as exported_on
        from lo join part on p_partkey = product_id
        join (values (0), (1)) c(copy) on copy = 0 or h % 101 = 0""",
    "raw_marketing": f"""select order_id * 2 + copy as raw_id,
        case when order_id % 211 = 0 then 'not-a-date'
             else {_date_text('order_day')} end as spend_date,
        case when order_id % 131 = 0 then 'Bogus Channel'
             when order_id % 12 = 1 then lower(channel)
             when order_id % 12 = 2 then '  ' || channel || '  ' else channel end as channel,
        case when order_id % 137 = 0 then null else cents end as cents, order_day as exported_on
        from paid join (values (0), (1)) c(copy) on copy = 0 or order_id % 50 = 0""",
    "raw_returns": f"""select line_id + copy as raw_id, line_id as order_line_id,
        lower(p_type) as category,
        case when h % 199 = 0 then '31/02/2001'
             else {_date_text('(order_day + 5 + cast(h % 21 as integer))')} end as return_date,
        case when h % 23 = 0 then null when h % 19 = 0 then ''
             else {_PICKED_REASON} end as reason,
        case when copy = 1 then 1 when h % 97 = 0 then -rev else rev end as cents,
        order_day + 25 as exported_on
        from lo join part on p_partkey = product_id
        join (values (0), (1)) c(copy) on copy = 0 or h % 101 = 0 where returned""",
    # --- cleaning
    "kinds": "select distinct p_type as v from part",
    "channels": "select distinct c_mktsegment as v from customer",
    "product_ids": """select category, product_name, max(product_id) as product_id from prod
        group by all""",
    "customer_ids": "select email, max(customer_id) as customer_id from cust group by all",
    "sales": _labelled_sales("0"),
    "clean_fo": f"""select raw_id as order_line_id, order_id, customer_id,
        found_product as product_id, {_key('order_day')} as date_id, quantity, cents,
        coalesce(disc, 0) as disc, {_REVENUE} as rev from sales where reject_reason is null""",
    "marketing": _labelled_marketing("0"),
    "clean_spend": f"""select min(raw_id) as spend_id, {_key('day')} as date_id, channel,
        sum(cents) as cents from marketing where reject_reason is null group by day, channel""",
    "returns": _labelled_returns("raw_returns", "0"),
    "clean_ret": f"""select raw_id as return_id, order_line_id, {_key('day')} as date_id,
        coalesce(nullif(reason, ''), 'Unknown') as reason, abs(cents) as cents
        from returns where reject_reason is null""",
    # --- views: totals per order, day or line first, unions in place of outer joins
    "order_totals": """select customer_id, date_id, order_id, sum(quantity) as units, sum(rev) as rev
        from fo group by all""",
    "daily_refunds": "select date_id, sum(cents) as refunds from ret group by date_id",
    "ledger": """select date_id, 1 as placed, units, rev, 0 as refund from order_totals
        union all select date_id, 0, 0, 0, cents from ret""",
    "daily": """select c.date, c.day_name, c.is_weekend, t.* from cal c join (
            select date_id, cast(sum(placed) as bigint) as orders, sum(units) as units,
                sum(rev) as gross, sum(refund) as refunds
            from ledger group by date_id) t on t.date_id = c.date_id and t.orders > 0""",
    "sold": """select date_id, category, sum(rev) as rev
        from prod join fo on fo.product_id = prod.product_id group by all""",
    "weekly": """select k // 100 as year, k % 100 as week_of_year, category, sum(rev) as rev,
            min(make_date(date_id // 10000, date_id // 100 % 100, date_id % 100)) as week_start
        from (select sold.*, year * 100 + week_of_year as k from sold, cal
            where cal.date_id = sold.date_id)
        group by k, category""",
    "week_totals": """select year, week_of_year, sum(rev) as whole, min(week_start) as week
        from weekly group by all""",
    "shares": f"""select weekly.*, whole, week, {_pct('rev', 'whole')} as pct_of_week
        from weekly join week_totals using (year, week_of_year)""",
    "customer_totals": """select customer_id, count(*) as n_orders, sum(rev) as rev
        from order_totals group by customer_id""",
    "placed": "select * from cust where region <> 'Unknown'",
    "regions": """select region, count(*) as customers, cast(sum(n_orders) as bigint) as orders,
            sum(rev) as rev
        from placed join customer_totals using (customer_id) group by region""",
    "counts": """select customer_id, signup_date - cast(day(signup_date) - 1 as integer) as cohort_month,
            coalesce((select n_orders from customer_totals t
                where t.customer_id = placed.customer_id), 0) as n_orders from placed""",
    "channel_months": """select month, channel, sum(cents) as cents, cast(sum(n) as bigint) as n from (
            select make_date(date_id // 10000, date_id // 100 % 100, 1) as month, channel, cents,
                0 as n from spend
            union all
            select signup_date - cast(day(signup_date) - 1 as integer), acquisition_channel, null, 1
            from cust where acquisition_channel <> 'Unknown')
        group by all""",
    "month_spend": "select month, channel, cents from channel_months where cents is not null",
    "month_new": "select month, channel, n from channel_months where n > 0",
    "costs": f"""select month, channel, cents, n,
            {_hundredths('cents', 'n').replace('200 *', '2 *')} as cac
        from channel_months where cents is not null""",
    "first_days": """select year, week_of_year, min(date) as week_start from cal
        where date_id in (select date_id from fo) group by all""",
    "weeks": """select order_line_id, category, week_start
        from first_days join cal using (year, week_of_year) join fo using (date_id), prod
        where prod.product_id = fo.product_id""",
    "ret_weekly": """select week_start, category, count(*) as lines,
            count(*) filter (order_line_id in (select order_line_id from ret)) as back
        from (select distinct * from weeks) group by all""",
    "line_refunds": "select order_line_id, sum(cents) as refund from ret group by order_line_id",
    "ret_summary": """select category, cast(sum(lines) as bigint) as lines,
            cast(sum(back) as bigint) as back, sum(refund) as cents from (
            select product_id, count(distinct order_line_id) as lines, 0 as back, 0 as refund
            from fo group by product_id
            union all
            select product_id, 0, count(distinct order_line_id), sum(refund)
            from line_refunds join fo using (order_line_id) group by product_id)
        join prod using (product_id) group by category""",
    # --- daily append: history is one batch, then one batch per day
    "i_sales": _labelled_sales(_BATCH),
    "i_orders": f"""select raw_id as order_line_id, batch, order_id, customer_id,
        found_product as product_id, {_key('order_day')} as date_id, quantity, cents,
        coalesce(disc, 0) as disc, {_REVENUE} as rev from i_sales where reject_reason is null""",
    "i_marketing": _labelled_marketing(_BATCH),
    "i_spend": f"""select batch, channel, min(raw_id) as spend_id, {_key('day')} as date_id,
        sum(cents) as cents from i_marketing where reject_reason is null
        group by batch, day, channel""",
    "booked": f"""select * from raw_returns where exported_on <= {_LAST_DAY}
        and order_line_id in (select order_line_id from i_orders)""",
    "i_returns": _labelled_returns("booked", _BATCH),
    "i_back": f"""select batch, raw_id as return_id, order_line_id, {_key('day')} as date_id,
        coalesce(nullif(reason, ''), 'Unknown') as reason, abs(cents) as cents
        from i_returns where reject_reason is null""",
}

_CSV_RELATIONS = {
    "dim_customers": "cust",
    "dim_products": "prod",
    "dim_date": "cal",
    "fact_orders": "fo",
    "fact_marketing_spend": "spend",
    "fact_returns": "ret",
    "raw_sales_export": "raw_sales",
    "raw_marketing_spend": "raw_marketing",
    "raw_returns": "raw_returns",
    "vw_daily_revenue": "daily",
    "vw_category_weekly": "weekly",
    "vw_region_summary": "regions",
    "vw_customer_repeat_rate": "(select distinct cohort_month from counts)",
    "vw_marketing_cac_monthly": "costs",
    "vw_return_summary": "ret_summary",
    "vw_return_weekly": "ret_weekly",
}


def _with(body: str) -> str:
    """The statement with the building blocks it uses, directly or through others."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        text = todo.pop()
        for name in CTES:
            if name not in needed and re.search(rf"(?:from|join|,)\s+{name}\b", text):
                needed.add(name)
                todo.append(CTES[name])
    ctes = [f"{name} as ({sql})" for name, sql in CTES.items() if name in needed]
    return f"with {', '.join(ctes)} {body}" if ctes else body


def _counts(relations: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{name}' as relation, count(*) as rows from {source}"
        for name, source in relations.items()
    )


def _checksums(relation: str, source: str, columns: str) -> str:
    """Columns as text, numbers as their digits; see row_text for what stands between them."""
    cells = ", ".join(f"coalesce('=' || cast({c} as varchar), '~')" for c in columns.split(", "))
    part = "cast(sum(cast('0x' || substr(d, {0}, 15) as bigint)) as varchar)"
    return f"""select '{relation}' as relation, count(*) as rows,
        {part.format(1)} as hash_a, {part.format(17)} as hash_b
        from (select md5(concat_ws(chr(31), {cells})) as d from {source})"""


_DIMENSION_CONTENTS = {
    "dim_customers": (
        "cust",
        "customer_id, full_name, email, region, acquisition_channel, signup_date, activity_score * 1000",
    ),
    "dim_products": ("prod", "product_id, product_name, category, (cents * 55 + 50) // 100, cents"),
}
_DATE_COLUMNS = "date_id, date, year, month, day, day_of_week, day_name, week_of_year, is_weekend"
_ORDER_COLUMNS = "order_line_id, order_id, customer_id, product_id, date_id, quantity, cents, disc, rev"
_SPEND_COLUMNS = "spend_id, date_id, channel, cents"
_RETURN_COLUMNS = "return_id, order_line_id, date_id, reason, cents"


def _contents(dates: str, orders: str, spend: str, returns: str) -> str:
    """Checksums of the star, of these sources."""
    found = {
        **_DIMENSION_CONTENTS,
        "dim_date": (dates, _DATE_COLUMNS),
        "fact_orders": (orders, _ORDER_COLUMNS),
        "fact_marketing_spend": (spend, _SPEND_COLUMNS),
        "fact_returns": (returns, _RETURN_COLUMNS),
    }
    return " union all ".join(_checksums(name, *parts) for name, parts in found.items())


def _planted(source: str, key: str, faults: dict[str, tuple[int, str]]) -> str:
    puts = ", ".join(
        f"case when {key} % {divisor} = 0 then {value} else {column} end as {column}"
        for column, (divisor, value) in faults.items()
    )
    return f"(select * replace ({puts}) from {source})"


_FAULTY_ORDERS = _planted(
    "fo",
    "order_line_id",
    {"quantity": (97, "0"), "cents": (89, "-100"), "rev": (83, "-100"), "customer_id": (79, "null"), "disc": (73, "null")},
)
_FAULTY_RETURNS = _planted(
    "ret", "return_id", {"cents": (71, "-100"), "reason": (67, "null"), "date_id": (61, "null")}
)


def _dropped(labelled: str, *reasons: str) -> str:
    return ", ".join(
        f"cast(count(*) filter (reject_reason = '{r}') as bigint) as {r}_dropped" for r in reasons
    )


def _violations(relation: str, key: str, source: str) -> str:
    columns = key.split(",")
    return (
        f"select '{relation}' as relation, '{key}' as key, count(*) as violations from"
        f" (select {', '.join(columns)} from {source} group by all having count(*) > 1)"
    )


def _orphans(relation: str, column: str, child: str, parent: str) -> str:
    return (
        f"select '{relation}' as relation, '{column}' as key, count(*) as violations"
        f" from {child} where {column} not in (select {column} from {parent})"
    )


def _nulls(relation: str, source: str, columns: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{relation}' as relation, '{name}' as \"column\","
        f" count(*) filter ({expression} is null) as nulls from {source}"
        for name, expression in columns.items()
    )


def _same(*names: str) -> dict[str, str]:
    return {name: name for name in names}


def _ids(relation: str, column: str, source: str) -> str:
    return (
        f"select '{relation}' as relation, count(*) as rows, count(distinct {column})"
        f" as distinct_ids, cast(min({column}) as bigint) as first_id,"
        f" cast(max({column}) as bigint) as last_id from {source}"
    )


_FACT = """order_line_id, order_id, customer_id, product_id, date_id, quantity,
    cast(cents as double) / 100 as unit_price, cast(disc as double) / 1000 as discount,
    cast(rev as double) / 100 as line_revenue"""
_AFTER = f"""from (
    select 'dim_customers' as relation, count(*) as b, count(*) as a from cust
    union all select 'dim_products', count(*), count(*) from prod
    union all select 'dim_date', max(last - first) + 1 - 14, max(last - first) + 1 from span
    union all select 'fact_orders', count(*) filter (batch <= {_SEED_DAY}), count(*) from i_orders
    union all select 'fact_marketing_spend', count(*) filter (batch <= {_SEED_DAY}), count(*)
        from i_spend
    union all select 'fact_returns', count(*) filter (batch <= {_SEED_DAY}), count(*)
        from i_back)"""
_LOADED = f"cal where date <= {_LAST_DAY}"
_BOOKED = f"""clean_ret join (select raw_id from raw_returns
    where exported_on <= {_LAST_DAY}) on raw_id = return_id
    where order_line_id in (select order_line_id from clean_fo)"""
_APPENDED = _contents(_LOADED, "i_orders", "i_spend", "i_back")
_AOV = "cast((2 * cast({0} as hugeint) + {1}) // (2 * {1}) as double) / 100"

_BODIES = {
    "scan_raw_sales": f"""select raw_id, order_id, order_date, customer_email,
        case when customer_email is not null then full_name end as customer_name, region,
        acquisition_channel, product_name, category, quantity, {_money('cents')} as unit_price,
        cast(disc as double) / 1000 as discount
        from raw_sales join cust on customer_id = account_id""",
    "stamped_ids": """select count(*) as rows, count(*) as ids, cast(0 as bigint) as first_place,
        count(*) - 1 as last_place from raw_marketing""",
    "land_two_deliveries": f"""select
        case when (raw_id // 2) % 2 = 1 then 'late' else 'early' end as delivery,
        count(*) as rows, count(*) as ids, {_money('sum(cents)')} as spend
        from raw_marketing group by 1""",
    "scan_raw_marketing": f"""select raw_id, spend_date, channel, {_money('cents')} as spend
        from raw_marketing""",
    "scan_raw_returns": f"""select raw_id, order_line_id, category, return_date, reason,
        {_money('cents')} as refund_amount from raw_returns""",
    "dim_customers": """select customer_id, full_name, email, region, acquisition_channel,
        signup_date, cast(activity_score as double) as activity_score from cust""",
    "dim_products": f"""select product_id, product_name, category,
        cast((cents * 55 + 50) // 100 as double) / 100 as unit_cost, {_money('cents')} as list_price
        from prod""",
    "dim_date": "select * from cal",
    "relation_row_counts": _counts(_CSV_RELATIONS),
    "export_csv_roundtrip": f"select *, true as same from ({_counts(_CSV_RELATIONS)})",
    "relation_checksums": _contents("cal", "fo", "spend", "ret"),
    "csv_unreadable_records": """select count(*) + count(*) filter (broken) as records,
            2 * count(*) filter (broken) + count(*) filter (odd and not broken) as unreadable,
            cast(sum(disc) filter (not broken and not odd) as double) / 1000 as discounts,
            cast(sum(cents) filter (not broken and not odd) as double) / 100 as prices
        from (select *, raw_id % 37 = 0 as broken, raw_id % 31 = 0 and disc is not null as odd
            from raw_sales)""",
    "standardize_dates": f"""select raw_id, order_date, {_parsed('order_date')} as order_day
        from raw_sales""",
    "normalize_category": f"""select raw_id, category, v as normalized from raw_sales
        left join kinds on lower(v) = lower(trim(category, {_BLANK}))""",
    "normalize_channel": f"""select raw_id, channel, v as normalized from raw_marketing
        left join channels on lower(v) = lower(trim(channel, {_BLANK}))""",
    "line_revenue": f"select line_id, {_money(_REVENUE)} as line_revenue from li",
    "fix_negative_refunds": f"""select raw_id, {_money('abs(cents)')} as refund_amount,
        cents < 0 as fixed from raw_returns""",
    "fill_reason": """select raw_id, coalesce(nullif(reason, ''), 'Unknown') as reason
        from raw_returns""",
    "reject_unparseable_date": f"""select 'sales' as source, raw_id, order_date as date_text
            from raw_sales where {_parsed('order_date')} is null
        union all select 'marketing', raw_id, spend_date
            from raw_marketing where {_parsed('spend_date')} is null
        union all select 'returns', raw_id, return_date
            from raw_returns where {_parsed('return_date')} is null""",
    "reject_invalid_quantity": """select raw_id, quantity from raw_sales
        where quantity is null or quantity <= 0""",
    "reject_invalid_price": f"""select raw_id, {_money('cents')} as unit_price from raw_sales
        where cents is null or cents <= 0""",
    "reject_unmatched_vocab": f"""select 'sales' as source, raw_id, category as value
            from raw_sales left join kinds on lower(v) = lower(trim(category, {_BLANK}))
            where v is null
        union all select 'marketing', raw_id, channel
            from raw_marketing left join channels on lower(v) = lower(trim(channel, {_BLANK}))
            where v is null""",
    "reject_unmatched_product": f"""select raw_id, v as category, r.product_name
        from raw_sales r join kinds on lower(v) = lower(trim(r.category, {_BLANK}))
        left join product_ids p on p.category = v and p.product_name = r.product_name
        where p.product_id is null""",
    "sales_reject_reason": "select raw_id, reject_reason from sales",
    "dedupe_sales": f"""select raw_id, order_id, order_date, customer_email, product_name, quantity,
        {_money('cents')} as unit_price, cast(disc as double) / 1000 as discount, category, copies
        from ({_first_rows('raw_sales', _SALES_KEY, '0')})""",
    "dedupe_marketing": f"""select raw_id, spend_date, channel, {_money('cents')} as spend, copies
        from ({_first_rows('raw_marketing', 'spend_date, channel, cents', '0')})""",
    "dedupe_returns": f"""select raw_id, order_line_id, return_date, reason,
        {_money('cents')} as refund_amount, copies
        from ({_first_rows('raw_returns', 'order_line_id, return_date, reason', '0')})""",
    "lookup_product": f"""select raw_id, v as category, r.product_name, p.product_id
        from raw_sales r left join kinds on lower(v) = lower(trim(r.category, {_BLANK}))
        left join product_ids p on p.category = v and p.product_name = r.product_name""",
    "lookup_customer_guest": """select raw_id, customer_email,
        coalesce(c.customer_id, -1) as customer_id
        from raw_sales left join customer_ids c on c.email = nullif(customer_email, '')""",
    "clean_sales": f"select {_FACT} from clean_fo",
    "clean_marketing": f"""select spend_id, date_id, channel, {_money('cents')} as spend
        from clean_spend""",
    "clean_returns": f"""select return_id, order_line_id, date_id, reason,
        {_money('cents')} as refund_amount from clean_ret""",
    "sales_report": f"""select cast(sum(copies) as bigint) as raw_rows,
        cast(sum(copies - 1) as bigint) as duplicates_dropped,
        {_dropped('sales', 'unparseable_date', 'invalid_quantity', 'invalid_price',
                  'unmatched_category', 'unmatched_product', 'unreadable')},
        count(*) filter (reject_reason is null) as clean_rows from sales""",
    "marketing_report": f"""select cast(sum(copies) as bigint) as raw_rows,
        cast(sum(copies - 1) as bigint) as duplicates_dropped,
        {_dropped('marketing', 'unparseable_date', 'unmatched_channel', 'null_amount')},
        count(*) filter (reject_reason is null) - (select count(*) from clean_spend)
            as rows_aggregated,
        (select count(*) from clean_spend) as clean_rows from marketing""",
    "returns_report": f"""select cast(sum(copies) as bigint) as raw_rows,
        cast(sum(copies - 1) as bigint) as duplicates_dropped,
        {_dropped('returns', 'unparseable_date', 'null_amount')},
        count(*) filter (reject_reason is null and cents < 0) as negative_refund_fixed,
        count(*) filter (reject_reason is null) as clean_rows from returns""",
    "daily_revenue": f"""select date, day_name, is_weekend, orders, cast(units as bigint) as units,
        {_money('gross')} as gross_revenue, {_money('refunds')} as refunds,
        {_money('(gross - refunds)')} as net_revenue, {_AOV.format('gross', 'orders')} as aov
        from daily""",
    "daily_refunds": f"select date_id, {_money('refunds')} as refunds from daily_refunds",
    "category_week_revenue": f"""select year, week_of_year, category, week_start,
        {_money('rev')} as revenue from weekly""",
    "category_weekly": f"""select week_start, category, {_money('rev')} as revenue, pct_of_week
        from shares""",
    "region_summary": f"""select region, customers, orders, {_money('rev')} as revenue,
        {_AOV.format('rev', 'orders')} as aov from regions""",
    "customer_order_counts": "select customer_id, cohort_month, n_orders from counts",
    "customer_repeat_rate": f"""select *, {_pct('repeat_customers', 'customers')} as repeat_rate_pct
        from (select cohort_month, count(*) as customers,
            count(*) filter (n_orders >= 2) as repeat_customers from counts group by cohort_month)""",
    "monthly_spend": f"select month, channel, {_money('cents')} as spend from month_spend",
    "monthly_new_customers": "select month, channel, n as new_customers from month_new",
    "marketing_cac_monthly": f"""select month, channel, {_money('cents')} as spend,
        n as new_customers, cac from costs""",
    "order_line_detail": f"""select order_line_id, category, date, {_money('rev')} as line_revenue
        from fo join prod using (product_id) join cal using (date_id)""",
    "order_weeks": "select order_line_id, category, week_start from weeks",
    "return_summary": f"""select category, lines as order_lines, back as returned_lines,
        {_pct('back', 'lines')} as return_rate_pct, {_money('cents')} as refund_amount
        from ret_summary""",
    "return_weekly": f"""select week_start, category, lines as order_lines, back as returned_lines,
        {_pct('back', 'lines')} as return_rate_pct from ret_weekly""",
    "latest_30_days": f"""select date, {_money('gross')} as gross_revenue,
        {_money('refunds')} as refunds, {_money('(gross - refunds)')} as net_revenue
        from daily order by date desc limit 30""",
    "cac_last_5_months": """select month, cac from costs
        where channel = 'MACHINERY' and cac is not null order by month desc limit 5""",
    "missing_dates": _series("last + 1", "last + 25", "span"),
    "dim_date_append": "select * from cal",
    "high_water_marks": """select (select max(date) from cal) as last_date,
        max(order_id) as last_order_id, max(order_line_id) as last_order_line_id from fo""",
    "surrogate_ids": " union all ".join(
        [
            _ids("fact_orders", "order_line_id", "clean_fo"),
            _ids("fact_marketing_spend", "spend_id", "clean_spend"),
            _ids("fact_returns", "return_id", "clean_ret"),
        ]
    ),
    "eligible_customers_on_day": """select customer_id, full_name, email, region,
        acquisition_channel, signup_date, cast(activity_score as double) as activity_score
        from cust where signup_date <= date '1998-06-30' and email <> 'guest@checkout.invalid'""",
    "eligible_customers_daily": """select date, (select count(*) from cust
        where signup_date <= date and email <> 'guest@checkout.invalid') as eligible from cal""",
    "return_decision_cohort": f"""select order_line_id, category, date,
        {_money('rev')} as line_revenue, date + 25 as decided_on
        from fo join prod using (product_id) join cal using (date_id)
        where date + 25 <= {_LAST_DAY}""",
    "full_refresh_counts": f"""{_contents(_LOADED, "clean_fo", "clean_spend", _BOOKED)}
        union all select *, null, null from ({_counts({
            "raw_sales_export": "raw_sales",
            "raw_marketing_spend": "raw_marketing",
            "raw_returns": f"raw_returns where exported_on <= {_LAST_DAY} "
            "and order_line_id in (select order_line_id from clean_fo)",
        })})""",
    "incremental_append_counts": f"""select relation, cast(b as bigint) as rows_before,
        cast(a as bigint) as rows_after, relation in ('dim_customers', 'dim_products') as same,
        hash_a, hash_b {_AFTER} join ({_APPENDED}) using (relation)""",
    "incremental_idempotent": f"""select relation, cast(a as bigint) as rows_before,
        cast(a as bigint) as rows_after, true as same, hash_a, hash_b,
        cast(0 as bigint) as days_again {_AFTER} join ({_APPENDED}) using (relation)""",
    "dq_bad_facts": """select 'fact_orders' as relation,
            count(*) filter (quantity <= 0 or cents <= 0 or rev < 0) as bad_rows from fo
        union all select 'fact_returns', count(*) filter (cents < 0) from ret""",
    "dq_bad_facts_planted": f"""select 'fact_orders' as relation,
            count(*) filter (quantity <= 0 or cents <= 0 or rev < 0) as bad_rows
            from {_FAULTY_ORDERS}
        union all select 'fact_returns', count(*) filter (cents < 0) from {_FAULTY_RETURNS}""",
    "null_violations_planted": " union all ".join(
        [
            _nulls(
                "fact_orders",
                _FAULTY_ORDERS,
                {
                    **_same(*_ORDER_COLUMNS.split(", ")[:6]),
                    "unit_price": "cents",
                    "discount": "disc",
                    "line_revenue": "rev",
                },
            ),
            _nulls(
                "fact_returns",
                _FAULTY_RETURNS,
                {**_same(*_RETURN_COLUMNS.split(", ")[:4]), "refund_amount": "cents"},
            ),
        ]
    ),
    "dq_missing_calendar": """select count(*) as missing_days from (select distinct order_day
        from hdr where order_day not in (select date from cal))""",
    "pk_violations": " union all ".join(
        [
            _violations("dim_customers", "customer_id", "cust"),
            _violations("dim_products", "product_id", "prod"),
            _violations("dim_date", "date_id", "cal"),
            _violations("fact_orders", "order_line_id", "fo"),
            _violations("fact_marketing_spend", "spend_id", "spend"),
            _violations("fact_returns", "return_id", "ret"),
            _violations("dim_date", "date", "cal"),
        ]
    ),
    "fk_violations": " union all ".join(
        [
            _orphans("fact_orders", "customer_id", "clean_fo", "cust"),
            _orphans("fact_orders", "product_id", "clean_fo", "prod"),
            _orphans("fact_orders", "date_id", "clean_fo", "cal"),
            _orphans("fact_marketing_spend", "date_id", "spend", "cal"),
            _orphans("fact_returns", "order_line_id", "clean_ret", "clean_fo"),
            _orphans("fact_returns", "date_id", "clean_ret", "cal"),
        ]
    ),
    "null_violations": " union all ".join(
        [
            _nulls(
                "dim_customers",
                "cust",
                _same(
                    "customer_id",
                    "full_name",
                    "email",
                    "region",
                    "acquisition_channel",
                    "signup_date",
                    "activity_score",
                ),
            ),
            _nulls(
                "dim_products",
                "prod",
                {
                    **_same("product_id", "product_name", "category"),
                    "unit_cost": "cents",
                    "list_price": "cents",
                },
            ),
            _nulls(
                "dim_date",
                "cal",
                _same(
                    "date_id",
                    "date",
                    "year",
                    "month",
                    "day",
                    "day_of_week",
                    "day_name",
                    "week_of_year",
                    "is_weekend",
                ),
            ),
            _nulls(
                "fact_orders",
                "fo",
                {
                    **_same(
                        "order_line_id", "order_id", "customer_id", "product_id", "date_id",
                        "quantity",
                    ),
                    "unit_price": "cents",
                    "discount": "disc",
                    "line_revenue": "rev",
                },
            ),
            _nulls(
                "fact_marketing_spend",
                "spend",
                {**_same("spend_id", "date_id", "channel"), "spend": "cents"},
            ),
            _nulls(
                "fact_returns",
                "ret",
                {
                    **_same("return_id", "order_line_id", "date_id", "reason"),
                    "refund_amount": "cents",
                },
            ),
        ]
    ),
    "check_net_revenue": f"""select count(*) as days, count(*) filter (abs(
            {_money('(gross - refunds)')} - ({_money('gross')} - {_money('refunds')})) > 0.01)
        as mismatches from daily""",
    "check_week_pct_sum": """select count(*) as weeks,
        count(*) filter (abs(pct - 100) > 0.5) as mismatches
        from (select sum(pct_of_week) as pct from shares group by year, week_of_year)""",
    "check_return_rate_bounds": f"""select count(*) as categories,
        count(*) filter (rate < 0 or rate > 100) as out_of_bounds
        from (select {_pct('back', 'lines')} as rate from ret_summary)""",
    "check_no_unknown_region": """select count(*) as regions,
        count(*) filter (region = 'Unknown') as unknown_regions from regions""",
    "finding_category_decline": f"""select category, first_week, last_week,
        {_money('fr')} as first_revenue, {_money('lr')} as last_revenue,
        {_pct('fr', 'tf')} as first_share, {_pct('lr', 'tl')} as last_share,
        {_money('tf')} as total_first, {_money('tl')} as total_last
        from (select category, first_week, last_week,
                coalesce(max(rev) filter (week = first_week), 0) as fr,
                coalesce(max(rev) filter (week = last_week), 0) as lr
            from shares join (select min(week) as first_week, max(week) as last_week
                from shares where week between {_LAST_DAY} - 70 and {_LAST_DAY}) on true
            where week between first_week and last_week
            group by category, first_week, last_week)
        join (select max(whole) filter (week = (select min(week) from shares
                    where week between {_LAST_DAY} - 70 and {_LAST_DAY})) as tf,
                max(whole) filter (week = (select max(week) from shares
                    where week between {_LAST_DAY} - 70 and {_LAST_DAY})) as tl
            from shares) on true""",
    "finding_cac_rise": """select channel, first_month, first_cac, last_full_month, last_cac,
        last_cac > first_cac as rises
        from (select channel, count(*) as months, min(month) as first_month,
                arg_min(cac, month) as first_cac, max(month) filter (rk = 2) as last_full_month,
                max(cac) filter (rk = 2) as last_cac
            from (select *, row_number() over (partition by channel order by month desc) as rk
                from costs where cac is not null)
            where rk <= 5 group by channel)
        where months >= 4""",
    "finding_return_peak": f"""select category, max(rate) as peak_rate_pct,
        max(rate) > 10 as above_threshold
        from (select category, {_pct('back', 'lines')} as rate from ret_weekly)
        group by category""",
    "finding_return_window": f"""select category, lines as order_lines, back as returned_lines,
        {_pct('back', 'lines')} as return_rate_pct,
        {_pct('(sum(back) over () - back)', '(sum(lines) over () - lines)')} as others_rate_pct
        from (select category, count(*) as lines,
                count(*) filter (order_line_id in (select order_line_id from ret)) as back
            from (select distinct order_line_id, category, date_id from fo, prod
                where prod.product_id = fo.product_id)
            where date_id in (select date_id from cal
                where date between {_LAST_DAY} - 70 and {_LAST_DAY} - 15)
            group by category)""",
    "finding_calendar_effect": f"""select effect, applies, count(*) as days,
        {_hundredths('sum(n)', 'count(*)')} as avg_orders
        from (select c.*, (select count(distinct order_id) from fo f
                where f.date_id = c.date_id) as n from cal c
            where date <= {_LAST_DAY}) d,
            lateral (values ('weekend', is_weekend),
                ('holiday', month * 100 + day between 1120 and 1231)) e(effect, applies)
        group by effect, applies""",
}

ORACLES = {name: _with(body) for name, body in _BODIES.items()}
