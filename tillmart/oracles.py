"""DuckDB SQL giving the expected rows of each registered query, from the driver's tables.

Written apart from the Spark code, in other terms where there is a choice: regular
expressions for the SKU, integer cents for sums and rounding.
"""

from __future__ import annotations

INPUTS = r"""
seller as (
    select c_custkey as store_id, c_name as store_name,
           'Street ' || (c_custkey % 97) as store_address, 'City ' || (c_custkey % 13) as store_city,
           n_name as store_country, c_mktsegment as store_typology, c_custkey as customer_id,
           timestamp '2023-12-25' + to_days(cast(c_custkey % 20 as integer))
               + to_hours(c_custkey * 7 % 24) as created_at
    from customer left join nation on n_nationkey = c_nationkey
), terminal as (
    select c_custkey * 2 + k as device_id, (c_custkey * 2 + k) % 5 + 1 as device_type,
           c_custkey as store_id
    from customer, unnest([0, 1]) as pair(k)
), sent as (
    select event_id as id, if(event_id % 97 = 0, -1, user_id * 2 + event_id % 2) as device_id,
           case event_id % 3 when 0 then 'v' || regexp_extract(props, '[0-9]+')
                             when 1 then regexp_extract(props, '[0-9]+') || '.0'
                             else regexp_extract(props, '[0-9]+') end as sku,
           value as amount,
           case event_type when 'error' then 'refused' when 'signup' then 'cancelled'
                           else 'accepted' end as status,
           ts as happened_at,
           ts + to_hours(event_id % 7) + to_minutes(5) as created_at
    from events
), payment as (
    select id as transaction_id, device_id, sku as product_sku_raw,
           regexp_replace(regexp_replace(sku, '^v+', ''), '\.0$', '') as product_sku,
           cast(amount as decimal(18,2)) as amount_eur,
           case status when 'accepted' then 'completed' when 'refused' then 'failed'
                       else status end as transaction_status,
           happened_at as transaction_at, created_at as record_created_at
    from sent
), sale as (
    select p.transaction_id, p.device_id, t.store_id, p.product_sku, p.amount_eur,
           p.transaction_status, p.transaction_at, p.record_created_at,
           cast(p.amount_eur * 100 as bigint) as cents,
           p.transaction_status = 'completed' as done
    from payment p left join terminal t using (device_id)
)"""


def _sql(body: str, *steps: str) -> str:
    return "with " + ", ".join([INPUTS, *steps]) + "\n" + body


def _half_up(units: str, count: str, per_unit: int = 100) -> str:
    """`units / count`, rounded half-up to a whole unit, in units of 1/per_unit."""
    rounded = f"(2 * ({units}) + ({count})) // (2 * nullif({count}, 0))"
    return f"cast({rounded} as double) / {per_unit}"


FACT = (
    "transaction_id, device_id, store_id, product_sku, cast(amount_eur as double) as amount_eur, "
    "transaction_status, transaction_at, record_created_at"
)
PAYMENT = FACT.replace("store_id", "product_sku_raw")


def _top(keys: str, n: int, body: str) -> str:
    return _sql(
        body,
        f"""totals as (
            select {keys}, count(*) as sold, sum(cents) as cents, count(cents) as priced
            from sale where done group by all
        )""",
        f"""places as (
            select cents, sold, row_number() over (order by cents desc, sold desc) as place
            from (select distinct cents, sold from totals) order by place limit {n}
        )""",
    )


def _top_stores(n: int) -> str:
    return _top(
        "store_id",
        n,
        f"""select seller.store_id, store_name, store_country, store_typology,
            sold as transaction_count, cents / 100 as total_amount_eur,
            {_half_up("cents", "priced")} as avg_transaction_amount_eur, place as "rank"
        from totals join places using (cents, sold) left join seller using (store_id)""",
    )


def _top_products(n: int) -> str:
    return _top(
        "store_id, product_sku",
        n,
        f"""select store_id, product_sku, sold as times_sold, cents / 100 as total_revenue_eur,
            {_half_up("cents", "priced")} as avg_amount_eur, place as "rank"
        from totals join places using (cents, sold)""",
    )


DEVICE_EFFICIENCY = _sql(
    f"""select device_type, stores as stores_using, devices as unique_devices,
        tx as total_transactions, ok as successful_transactions,
        {_half_up("ok * 10000", "tx")} as success_rate_pct,
        cents / 100 as total_revenue_eur,
        {_half_up("cents", "priced")} as avg_transaction_value_eur,
        {_half_up("tx * 10", "devices", 10)} as avg_transactions_per_device,
        {_half_up("cents", "devices")} as avg_revenue_per_device_eur,
        {_half_up("tx * 10", "stores", 10)} as avg_transactions_per_store,
        {_half_up("cents", "stores")} as avg_revenue_per_store_eur
    from per_type""",
    """per_type as (
        select t.device_type, count(distinct s.store_id) as stores,
               count(distinct s.device_id) as devices, count(distinct transaction_id) as tx,
               count(distinct transaction_id) filter (where done) as ok,
               sum(if(done, cents, 0)) as cents, count(cents) filter (where done) as priced
        from sale s left join terminal t using (device_id) group by t.device_type
    )""",
)

STORE_ADOPTION = _sql(
    f"""select d as milestone_day, count(distinct store_id) as stores_in_sample,
        {_half_up("sum(tx) * 10", "count(*)", 10)} as avg_transactions,
        cast(min(tx) as bigint) as min_transactions, cast(max(tx) as bigint) as max_transactions,
        {_half_up("sum(cents)", "count(cents)")} as avg_revenue_eur,
        {_half_up("sum(days) * 10", "count(*)", 10)} as avg_active_days
    from so_far group by d""",
    """daily as (
        select store_id, created_at, date_diff('day', created_at::date, transaction_at::date) as d,
               count(distinct transaction_id) as tx, sum(if(done, cents, 0)) as cents
        from sale join seller using (store_id) group by all
    )""",
    """so_far as (
        select a.store_id, a.d, sum(b.tx) as tx, sum(b.cents) as cents, count(*) as days
        from daily a join daily b on a.store_id = b.store_id and b.d between 0 and a.d
        where a.d between 0 and 90 group by all
    )""",
)

# Checks ---------------------------------------------------------------------------

_MOMENT = "timestamp '2024-01-25'"
_TABLES = {
    "stg_stores": "seller",
    "stg_devices": "terminal",
    "stg_transactions": "payment",
    "int_transactions_joined": "sale",
    "dim_stores": "seller",
    "dim_devices": "terminal",
    "fact_transactions": "sale",
}
_AUDITED = {"dbt_loaded_at", "dbt_updated_at"}
# Columns that must not be NULL, the key first.
_REQUIRED = {
    "stg_stores": "store_id store_name store_country customer_id created_at dbt_loaded_at",
    "stg_devices": "device_id device_type store_id dbt_loaded_at",
    "stg_transactions": "transaction_id device_id amount_eur transaction_status transaction_at "
    "record_created_at dbt_loaded_at",
    "int_transactions_joined": "transaction_id",
    "dim_stores": "store_id store_name store_country customer_id dbt_updated_at",
    "dim_devices": "device_id device_type store_id dbt_updated_at",
    "fact_transactions": "transaction_id device_id store_id product_sku amount_eur "
    "record_created_at",
}
_KEYS = {name: required.split()[0] for name, required in _REQUIRED.items()}


def _row(kind: str, table: str, column: str, failures: str, severity: str = "error") -> str:
    return (
        f"""select '{kind}' as "check", '{table}' as "table", '{column}' as "column", """
        f"'{severity}' as severity, cast(({failures}) as bigint) as failures"
    )


def _count_where(table: str, condition: str) -> str:
    return f"select count(*) from {_TABLES[table]} where {condition}"


def _not_null_rows() -> list[str]:
    return [
        _row(
            "not_null",
            table,
            column,
            "0" if column in _AUDITED else _count_where(table, f"{column} is null"),
        )
        for table, columns in _REQUIRED.items()
        for column in columns.split()
    ]


def _unique_rows() -> list[str]:
    return [
        _row(
            "unique",
            table,
            key,
            f"select count(*) from (select {key} from {_TABLES[table]} where {key} is not null "
            f"group by {key} having count(*) > 1)",
        )
        for table, key in _KEYS.items()
    ]


def _accepted_values_rows() -> list[str]:
    statuses = "transaction_status not in ('completed', 'failed', 'cancelled')"
    return [
        _row(
            "accepted_values",
            "stg_devices",
            "device_type",
            _count_where("stg_devices", "device_type not in (1, 2, 3, 4, 5)"),
        ),
        *[
            _row("accepted_values", t, "transaction_status", _count_where(t, statuses))
            for t in ("stg_transactions", "fact_transactions")
        ],
    ]


def _accepted_range_rows() -> list[str]:
    outside = "amount_eur not between 0.01 and 100000"
    failures = _count_where("fact_transactions", outside)
    return [_row("accepted_range", "fact_transactions", "amount_eur", failures)]


def _relationships_rows() -> list[str]:
    links = [
        ("dim_devices", "store_id", "seller"),
        ("fact_transactions", "device_id", "terminal"),
        ("fact_transactions", "store_id", "seller"),
    ]
    return [
        _row(
            "relationships",
            child,
            column,
            _count_where(child, f"{column} not in (select {column} from {parent})"),
            "warn",
        )
        for child, column, parent in links
    ]


_EARLY = """early as (
    select store_id, store_name, store_country, store_typology, created_at, first_transaction_at
    from seller join (
        select store_id, min(transaction_at) as first_transaction_at from sale group by all
    ) using (store_id)
    where first_transaction_at < created_at
)"""


def _all_rows(moment: str) -> list[str]:
    return [
        *_not_null_rows(),
        *_unique_rows(),
        *_accepted_values_rows(),
        *_accepted_range_rows(),
        *_relationships_rows(),
        _row(
            "created_after_first_transaction",
            "dim_stores",
            "created_at",
            "select count(*) from early",
            "warn",
        ),
        _row(
            "in_the_future",
            "fact_transactions",
            "transaction_at",
            _count_where("fact_transactions", f"transaction_at > {moment}"),
            "warn",
        ),
    ]


def _checks(rows: list[str], *steps: str) -> str:
    return _sql("\nunion all ".join(rows), *steps)


ORACLES = {
    "stg_stores": _sql("from seller"),
    "stg_devices": _sql("from terminal"),
    "stg_transactions": _sql(f"select {PAYMENT} from payment"),
    "int_transactions_joined": _sql(f"select {FACT} from sale"),
    "fact_transactions": _sql(f"select {FACT} from sale"),
    "dim_stores": _sql("from seller"),
    "dim_devices": _sql("from terminal"),
    "top_10_stores": _top_stores(10),
    "top_5_stores": _top_stores(5),
    "top_10_products": _top_products(10),
    "top_5_products": _top_products(5),
    "percentage_transactions_by_device": _sql(
        f"""select device_type, n as device_count,
            {_half_up("n * 10000", "(select count(*) from sale)")} as percentage
        from (
            select device_type, count(*) as n
            from sale left join terminal using (device_id) group by all
        )"""
    ),
    "avg_amount_by_typology_country": _sql(
        f"""select store_country, store_typology, count(*) as transaction_count,
            sum(cents) / 100 as total_amount_eur,
            {_half_up("sum(cents)", "count(cents)")} as avg_amount_eur,
            min(cents) / 100 as min_amount_eur, max(cents) / 100 as max_amount_eur
        from sale left join seller using (store_id) group by all"""
    ),
    "avg_time_to_5_transactions": _sql(
        f"""select {_half_up("sum(d) * 100", "count(*)")} as avg_days_to_5th_tx,
            min(d) as min_days_to_5th_tx, max(d) as max_days_to_5th_tx,
            count(*) as stores_with_5_tx
        from (
            select epoch_us(reached - created_at) // 86400000000 as d
            from seller join (
                select store_id, list_sort(list(transaction_at))[5] as reached
                from sale group by all
            ) using (store_id)
            where reached >= created_at
        )"""
    ),
    "device_efficiency": DEVICE_EFFICIENCY,
    "store_adoption": STORE_ADOPTION,
    "build_device_efficiency": DEVICE_EFFICIENCY,
    "build_store_adoption": STORE_ADOPTION,
    "check_not_null": _checks(_not_null_rows()),
    "check_unique": _checks(_unique_rows()),
    "check_accepted_values": _checks(_accepted_values_rows()),
    "check_accepted_range": _checks(_accepted_range_rows()),
    "check_relationships": _checks(_relationships_rows()),
    "check_store_created_after_first_tx": _sql("from early", _EARLY),
    "check_future_transactions": _sql(
        f"""select n as future_transactions
        from (select count(*) as n from sale where transaction_at > {_MOMENT}) where n > 0"""
    ),
    "check_summary": _checks(_all_rows(_MOMENT), _EARLY),
    "build_check_results": _checks(_all_rows("now()::timestamp"), _EARLY),
    "failing_not_null": _sql(f"select {FACT} from sale where store_id is null"),
    "failing_unique": """
        select l_orderkey, count(*) as n_records from lineitem
        group by l_orderkey having count(*) > 1""",
    "failing_accepted_values": _sql(
        "select id, status from sent where status not in ('accepted', 'refused')"
    ),
    "failing_accepted_range": _sql(f"select {FACT} from sale where cents not between 100 and 9999"),
    "failing_relationships": _sql(
        """select device_id, count(*) as n_records from sale
        where device_id not in (select device_id from terminal) group by all"""
    ),
    "ingest_blank_row_drop": """
        select event_id as id, if(event_type = 'error', null, user_id) as device_id,
               if(event_type = 'error', '', props) as product_sku,
               if(event_type = 'error', 0, value) as amount
        from events
        where event_type <> 'signup' and (event_type <> 'error' or event_id <> 0)""",
}

_CHANGED = """resent as (
    select * from sent union all
    select id, device_id, sku, amount + 1, 'accepted', happened_at, created_at + to_days(30)
    from sent where status = 'refused' and created_at <= timestamp '2024-01-20'
), held as (
    select * from payment where record_created_at <= timestamp '2024-01-20'
), arriving as (
    select id as transaction_id, device_id, sku as product_sku_raw,
           regexp_replace(regexp_replace(sku, '^v+', ''), '\\.0$', '') as product_sku,
           cast(amount as decimal(18,2)) as amount_eur,
           case status when 'accepted' then 'completed' when 'refused' then 'failed'
                       else status end as transaction_status,
           happened_at as transaction_at, created_at as record_created_at
    from resent where created_at > (select max(record_created_at) from held)
)"""
ORACLES["upsert_transactions"] = _sql(
    f"""select {PAYMENT} from (
        select * from held where transaction_id not in (select transaction_id from arriving)
        union all select * from arriving
    )""",
    _CHANGED,
)
ORACLES["incremental_load"] = ORACLES["upsert_transactions"]
ORACLES["ingest_csv_stores"] = ORACLES["stg_stores"]
ORACLES["ingest_csv_transactions"] = ORACLES["stg_transactions"]
ORACLES["ingest_inferred"] = _sql(
    """select store_id as id,
        'Floor ' || (store_id % 3) || chr(10) || chr(10) || '"Door", ' || (store_id % 5) as address,
        store_id * 1000003 as staff,
        if(store_id % 7 = 0, null, cast(store_id % 1000 as double)
            + cast(store_id % 10 as double) / 10) as rent,
        created_at as opened, printf('%09d', store_id) as code,
        'long' as staff_type, 'decimal' as rent_type, 'timestamp_ntz' as opened_type,
        'string' as code_type
    from seller"""
)
ORACLES["top_10_products_positions"] = f"""select store_id, product_sku, "rank",
    row_number() over (order by "rank", store_id nulls first, product_sku) as position
from ({ORACLES["top_10_products"]})"""
ORACLES["fact_positions"] = _sql(
    """select transaction_id, store_id, cast(amount_eur as double) as amount_eur, transaction_at,
        row_number() over (
            order by amount_eur desc nulls last, transaction_at nulls first, transaction_id
        ) as position
    from sale"""
)
# Of the rows sent again, only those dated a day later count.
ORACLES["file_fed_load"] = _sql(
    f"""select {PAYMENT} from (
        select * replace (
            if(transaction_id % 10 = 0, 'failed', transaction_status) as transaction_status,
            if(transaction_id % 10 = 0, record_created_at + to_days(1), record_created_at)
                as record_created_at)
        from payment
    )"""
)


# Whole numbers that can be NULL, by query. Both sides give them as doubles, since pandas
# would hold one side's as floating point and the other's as nullable integers.
MAYBE_NULL = {
    "int_transactions_joined": ["store_id"],
    "fact_transactions": ["store_id"],
    "top_10_stores": ["store_id"],
    "top_5_stores": ["store_id"],
    "top_10_products": ["store_id"],
    "top_10_products_positions": ["store_id"],
    "fact_positions": ["store_id"],
    "top_5_products": ["store_id"],
    "percentage_transactions_by_device": ["device_type"],
    "device_efficiency": ["device_type"],
    "build_device_efficiency": ["device_type"],
    "failing_not_null": ["store_id"],
    "failing_accepted_range": ["store_id"],
    "ingest_blank_row_drop": ["device_id"],
}
for _name, _columns in MAYBE_NULL.items():
    _casts = ", ".join(f"cast({column} as double) as {column}" for column in _columns)
    ORACLES[_name] = f"select * replace ({_casts}) from ({ORACLES[_name]})"
