"""The query catalogue: each operator over the test tables, with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layerkit.functions import (
    audited,
    bool_text,
    change_hash,
    coded,
    date_key,
    date_text,
    earliest_allowed,
    key_year,
    stamped,
)
from layerkit.layout import Layout
from layerkit.operators import checks
from layerkit.operators.lookup import dimension_lookup, lookup_guard
from layerkit.operators.ordered import rank_in_group, sliced_number, surrogate_key
from layerkit.operators.quarantine import reason_counts, reasons_by_id, route
from layerkit.operators.reports import (
    duplicate_groups,
    enforce,
    none_of,
    same_count,
    union,
    unique,
)
from layerkit.operators.rules import FirstCopyRule, KnownKeyRule, RowRule, Rule, evaluate, not_in
from layerkit.operators.scd2 import build_versions, overlapping, version_as_of, version_on
from layerkit.operators.star import DIM_ACCOUNT, DIM_BRANCH, DIM_CUSTOMER, DIM_DATE, DIMENSIONS, build_dimension, build_fact, resolve_transactions
from layerkit.plans import medallion
from layerkit.plans.views import LINE_CURRENCIES, LINE_ORDER, PROCESSED_AT, RUN_ID, SYSTEM, Views, oracle
from layerkit.schemas import (
    AUDIT_COLUMNS,
    BRONZE_COLUMNS,
    DUPLICATE,
    FOREIGN_KEYS,
    GOLD_STAMP,
    INVALID_CURRENCY,
    NEGATIVE_AMOUNT,
    NULL_AMOUNT,
    ORPHAN_ACCOUNT,
    PRIMARY_KEYS,
    QUARANTINE_STAMP,
    REASON_COLUMN,
    SILVER_STAMP,
    TABLES,
    YEAR_COLUMN,
    business_columns,
    declared_types,
    required_values,
)
from layerkit.session import concurrently, scratch_path
from layerkit.sources.readers import read_csv, read_layer, source_ready
from layerkit.sources.scratch import settle
from layerkit.sources.writers import write_csv, write_layer

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

RUN = medallion.Run(at=PROCESSED_AT, tie_break=("transaction_ref", "amount", "currency", "transaction_type"))
LINE_COLUMNS = ("transaction_id", "account_id", "transaction_timestamp", "amount", "currency", "part_id")
LINE_LIST = ", ".join(LINE_COLUMNS)
SALE_COLUMNS = ("transaction_id", "transaction_ref", "account_id", "date_key", "amount", "currency", "transaction_type", "channel")
SALE_LIST = ", ".join(SALE_COLUMNS)
FACT_LIST = "transaction_id, transaction_ref, account_sk, customer_sk, branch_sk, date_sk, transaction_timestamp, amount, currency, transaction_type, channel"


def query(name: str, sql: str) -> Callable[[Callable[[Views], DataFrame]], Callable[[Views], DataFrame]]:
    """Register a query over the views together with its oracle."""

    def register(build: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        QUERIES[name] = lambda spark, folder: build(Views(spark, folder))
        ORACLES[name] = oracle(sql)
        return build

    return register


def report_sql(*rows: tuple[str, str, str, str]) -> str:
    """Oracle of a report: (check, subject, expected, actual) as SQL expressions."""
    parts = [
        f"SELECT '{check}' AS \"check\", '{subject}' AS subject, CAST({expected} AS BIGINT) AS expected, "
        f"CAST({actual} AS BIGINT) AS actual"
        for check, subject, expected, actual in rows
    ]
    return (
        "SELECT \"check\", subject, expected, actual, abs(actual - expected) AS bad_rows, actual = expected AS ok "
        f"FROM ({' UNION ALL '.join(parts)}) AS r"
    )


def total(table: str, where: str = "TRUE") -> str:
    return f"(SELECT count(*) FROM {table} WHERE {where})"


def distinct(table: str, keys: str) -> str:
    return f"(SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {table}) AS k)"


def orphans(child: str, column: str, parent: str, parent_column: str) -> str:
    return (
        f"(SELECT count(*) FROM {child} AS c LEFT JOIN (SELECT DISTINCT {parent_column} AS pk FROM {parent}) AS p "
        f"ON c.{column} = p.pk WHERE p.pk IS NULL)"
    )


# Sources and sinks


@query(
    "scan_required_columns",
    "SELECT 'orders' AS subject, 3 AS found, count(*) AS \"rows\" FROM orders UNION ALL "
    "SELECT 'lineitem', 4, count(*) FROM lineitem UNION ALL SELECT 'customer', 2, count(*) FROM customer",
)
def scan_required_columns(v: Views) -> DataFrame:
    required = {
        "orders": ["o_orderkey", "o_custkey", "o_orderdate"],
        "lineitem": ["l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate"],
        "customer": ["c_custkey", "c_nationkey"],
    }
    parts = []
    for table, columns in required.items():
        df = read_layer(v.spark, f"{v.folder}/{table}.parquet", columns)
        parts.append(df.agg(F.lit(table).alias("subject"), F.lit(len(columns)).alias("found"), F.count(F.lit(1)).alias("rows")))
    return union(parts)


CSV_SQL = """SELECT o_orderkey AS id, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS note,
    CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS closed,
    o_orderdate AS moment, o_totalprice > 200000 AS large, CAST(o_totalprice AS DECIMAL(12,2)) AS price,
    CASE WHEN o_totalprice > 200000 THEN 'true' ELSE 'false' END AS large_text,
    CASE WHEN o_orderstatus = 'P' THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS closed_text FROM orders"""


@query("csv_roundtrip", CSV_SQL)
def csv_roundtrip(v: Views) -> DataFrame:
    day = F.to_date("o_orderdate")
    extract = v.table("orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("note"),
        day.alias("day"),
        F.when(F.col("o_orderstatus") != "P", day).alias("closed"),
        F.col("o_orderdate").cast("timestamp").alias("moment"),
        (F.col("o_totalprice") > 200000).alias("large"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
    )
    path = scratch_path(v.spark, "csv")
    write_csv(extract, path)
    schema = StructType.fromDDL("id BIGINT, note STRING, day DATE, closed DATE, moment TIMESTAMP, large BOOLEAN, price DECIMAL(12,2)")
    loaded = read_csv(v.spark, path, schema)
    return loaded.select(
        "id", "note", "day", "closed", F.col("moment").cast("timestamp_ntz").alias("moment"), "large", "price",
        bool_text(F.col("large")).alias("large_text"), date_text(F.col("closed")).alias("closed_text"),
    )


@query("layer_write_readback", f"SELECT {LINE_LIST} FROM lines")
def layer_write_readback(v: Views) -> DataFrame:
    path = Layout(scratch_path(v.spark, "layer")).bronze("lines")
    write_layer(v.lines.select(*LINE_COLUMNS), path)
    return read_layer(v.spark, path, LINE_COLUMNS)


@query(
    "partitioned_write_readback",
    "SELECT CAST(date_key // 10000 AS INTEGER) AS transaction_year, count(*) AS \"rows\", "
    "CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS amount FROM lines WHERE date_key // 10000 <= 1998 GROUP BY 1",
)
def partitioned_write_readback(v: Views) -> DataFrame:
    """A full refresh with fewer years drops the old ones; an incremental one adds its own."""
    path = scratch_path(v.spark, "years")
    lines = v.lines.withColumn(YEAR_COLUMN, key_year(F.col("date_key")))
    write_layer(lines, path, [YEAR_COLUMN])
    write_layer(lines.filter(F.col(YEAR_COLUMN) < 1998), path, [YEAR_COLUMN])
    write_layer(lines.filter(F.col(YEAR_COLUMN) == 1998), path, [YEAR_COLUMN], incremental=True)
    return v.spark.read.parquet(path).groupBy(YEAR_COLUMN).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("amount").cast("decimal(18,2)")).alias("amount")
    )


@query(
    "reload_idempotent",
    "SELECT 'customer' AS subject, count(*) AS \"rows\" FROM customer UNION ALL SELECT 'orders', count(*) FROM orders "
    "UNION ALL SELECT 'supplier', count(*) FROM supplier",
)
def reload_idempotent(v: Views) -> DataFrame:
    layout = Layout(scratch_path(v.spark, "reload"))
    parts = []
    for table in ("customer", "orders", "supplier"):
        for _ in range(2):
            write_layer(v.table(table), layout.bronze(table))
        stored = v.spark.read.parquet(layout.bronze(table))
        parts.append(stored.agg(F.lit(table).alias("subject"), F.count(F.lit(1)).alias("rows")))
    return union(parts)


def _not_null_sql(table: str) -> list[tuple[str, str, str, str]]:
    return [(f"not_null_{name}", table, "0", total(table, f"{name} IS NULL")) for name in required_values(table)]


def _audit_sql(check: str) -> list[tuple[str, str, str, str]]:
    """Audit columns are made by the loader, so none is ever NULL."""
    return [(f"{check}_{name}", table, "0", "0") for table in TABLES for name in AUDIT_COLUMNS]


NOT_NULL_SQL = [*[row for t in TABLES for row in _not_null_sql(t)], *_audit_sql("not_null")]
PRIMARY_KEY_SQL = [("primary_key", t, total(t), distinct(t, ", ".join(keys))) for t, keys in PRIMARY_KEYS.items()]
SOURCE_SQL = [
    *_audit_sql("filled"),
    *NOT_NULL_SQL,
    *PRIMARY_KEY_SQL,
    *[("orphans", e.label, "0", orphans(e.child, e.column, e.parent, e.parent_column)) for e in FOREIGN_KEYS if e.child != "transactions"],
    ("weights_sum_to_one", "account_customer_bridge", "0",
     "(SELECT count(*) FROM (SELECT account_id FROM account_customer_bridge GROUP BY 1 HAVING abs(round(sum(allocation_weight), 2) - 1) >= 0.01) AS w)"),
    ("one_current", "customer_history", "0",
     "(SELECT count(*) FROM (SELECT customer_id FROM customer_history GROUP BY 1 HAVING sum(CAST(is_current AS INTEGER)) <> 1) AS o)"),
    ("no_overlap_strict", "customer_history", "0",
     "(SELECT count(*) FROM (SELECT effective_from, lag(coalesce(effective_to, DATE '9999-12-31')) OVER "
     "(PARTITION BY customer_id ORDER BY effective_from) AS p FROM customer_history) AS o WHERE effective_from <= p)"),
]


# Declared types under their names in SQL. Order dates are stored without a time zone, so one row is not ok.
SQL_TYPES = {"int": "INTEGER", "string": "VARCHAR", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def _type_sql(table: str) -> list[tuple[str, str, str, str]]:
    return [
        (f"type_{kind}", f"{table}.{name}", "1",
         f"(SELECT CAST(typeof(any_value({name})) = '{SQL_TYPES.get(kind, kind.upper())}' AS INTEGER) FROM {table})")
        for name, kind in declared_types(table)
    ]


AUDIT_TYPES = {"load_run_id": "string", "source_system": "string", "processed_at": "timestamp"}
AUDIT_TYPE_SQL = [(f"type_{kind}", f"{t}.{name}", "1", "1") for t in TABLES for name, kind in AUDIT_TYPES.items()]


@query("schema_conformance", report_sql(*[row for t in TABLES for row in _type_sql(t)], *AUDIT_TYPE_SQL, *NOT_NULL_SQL))
def schema_conformance(v: Views) -> DataFrame:
    """Declared types, and no NULL where none may be, in all source tables."""
    sources = {t: v.source(t) for t in TABLES}
    return union([check(df, t) for t, df in sources.items() for check in (checks.schema_conformance, checks.not_null)])


@query("primary_keys", report_sql(*PRIMARY_KEY_SQL))
def primary_keys(v: Views) -> DataFrame:
    return checks.primary_keys({t: getattr(v, t) for t in PRIMARY_KEYS})


# Expected defects, as an operator of the source would name them; everything else that is wrong shows.
KNOWN = "coalesce(amount IS NULL OR amount < 0 OR currency = 'XXX', FALSE)"
UNKNOWN_SQL = [
    ("amount", "transactions", "0", total("transactions", f"NOT {KNOWN} AND (amount IS NULL OR amount <= 0)")),
    ("currency", "transactions", "0", total("transactions", f"NOT {KNOWN} AND (currency IS NULL OR currency NOT IN ('AZN', 'USD', 'EUR'))")),
    ("unique_transaction_id", "transactions", total("transactions", f"NOT {KNOWN}"),
     f"(SELECT count(DISTINCT transaction_id) FROM transactions WHERE NOT {KNOWN})"),
    ("known_account", "transactions", "0", total("transactions", f"NOT {KNOWN} AND account_id NOT IN (SELECT account_id FROM accounts)")),
    ("before_open", "transactions", "0",
     "(SELECT count(*) FROM transactions AS t JOIN accounts AS a ON t.account_id = a.account_id "
     f"WHERE NOT {KNOWN.replace('currency', 't.currency')} AND CAST(transaction_timestamp AS DATE) < open_date)"),
    ("before_customer", "transactions", "0",
     "(SELECT count(*) FROM transactions AS t JOIN accounts AS a ON t.account_id = a.account_id "
     "JOIN (SELECT customer_id AS k, min(effective_from) AS since FROM customer_history GROUP BY 1) AS h ON a.customer_id = k "
     f"WHERE NOT {KNOWN.replace('currency', 't.currency')} AND CAST(transaction_timestamp AS DATE) < since)"),
]


@query("source_validation", report_sql(*SOURCE_SQL, *UNKNOWN_SQL))
def source_validation(v: Views) -> DataFrame:
    """All source checks; transactions other than the expected defects must have none and keep to their days."""
    return medallion.validate(v.spark, _read(v), F.expr(KNOWN))


@query(
    "source_ready",
    report_sql(*[("source_ready", t, "1", f"(SELECT least(count(*), 1) FROM {t})") for t in ("customer", "orders", "lineitem", "events")]),
)
def ready(v: Views) -> DataFrame:
    return source_ready(v.spark, ("customer", "orders", "lineitem", "events"), lambda _, t: v.table(t))


# Derived columns


@query(
    "bronze_metadata",
    "SELECT transaction_id, part_id, account_id, 'transactions' AS bronze_source_table, TRUE AS ingested, "
    "CAST(date_key // 10000 AS INTEGER) AS transaction_year FROM lines",
)
def bronze_metadata(v: Views) -> DataFrame:
    landed = medallion.bronze_columns(v.lines, "transactions")
    return landed.select(
        "transaction_id", "part_id", "account_id", "bronze_source_table", F.col("bronze_ingested_at").isNotNull().alias("ingested"), YEAR_COLUMN
    )


@query(
    "audit_columns",
    f"SELECT o_orderkey, '{RUN_ID}' AS load_run_id, '{SYSTEM}' AS source_system, TRUE AS dated FROM orders",
)
def audit_columns(v: Views) -> DataFrame:
    marked = audited(v.table("orders"), RUN_ID, SYSTEM, PROCESSED_AT)
    return marked.select("o_orderkey", "load_run_id", "source_system", F.col("processed_at").isNotNull().alias("dated"))


DAY_KEY = "CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER)"


@query("partition_year", f"SELECT o_orderkey, CAST({DAY_KEY} // 10000 AS INTEGER) AS order_year FROM orders")
def partition_year(v: Views) -> DataFrame:
    return v.table("orders").select("o_orderkey", key_year(date_key(F.col("o_orderdate"))).alias("order_year"))


@query("date_key", f"SELECT o_orderkey, {DAY_KEY} AS date_key FROM orders")
def day_keys(v: Views) -> DataFrame:
    return v.table("orders").select("o_orderkey", date_key(F.col("o_orderdate")).alias("date_key"))


@query("calendar_dim", "SELECT * FROM dim_date")
def calendar_dim(v: Views) -> DataFrame:
    return v.dim_date


@query(
    "change_hash",
    "SELECT c_custkey, substr(sha256(concat_ws('|', c_mktsegment, coalesce(CASE WHEN c_acctbal >= 0 THEN c_name END, ''), "
    "CAST(c_nationkey AS VARCHAR))), 1, 16) AS change_hash FROM customer",
)
def change_hashes(v: Views) -> DataFrame:
    name = F.when(F.col("c_acctbal") >= 0, F.col("c_name"))
    return v.table("customer").select("c_custkey", change_hash(F.col("c_mktsegment"), name, F.col("c_nationkey")).alias("change_hash"))


@query("code_format", "SELECT o_orderkey, printf('TXN-%06d', o_orderkey) AS code FROM orders")
def code_format(v: Views) -> DataFrame:
    return v.table("orders").select("o_orderkey", coded("TXN-", 6, F.col("o_orderkey")).alias("code"))


@query(
    "earliest_allowed",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, greatest(CAST(l_shipdate AS DATE), CAST(o_orderdate AS DATE), "
    "DATE '1996-01-01') AS earliest FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
)
def earliest(v: Views) -> DataFrame:
    lines, orders = v.table("lineitem"), v.table("orders")
    joined = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
    bound = earliest_allowed(F.to_date("l_shipdate"), F.to_date("o_orderdate"), F.lit("1996-01-01").cast("date"))
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", bound.alias("earliest"))


@query(
    "date_arith",
    "SELECT o_orderkey, date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS span_days, "
    "CAST(o_orderdate AS DATE) + 30 AS due, o_orderdate + INTERVAL 5 SECOND AS shifted FROM orders",
)
def date_arith(v: Views) -> DataFrame:
    day = F.to_date("o_orderdate")
    return v.table("orders").select(
        "o_orderkey",
        F.date_diff(day, F.lit("1995-01-01").cast("date")).cast("long").alias("span_days"),
        F.date_add(day, 30).alias("due"),
        (F.col("o_orderdate") + F.expr("INTERVAL 5 SECONDS")).alias("shifted"),
    )


@query("snapshot_schedule", "SELECT account_id, snapshot_date_key, closing_balance, currency FROM account_balance_snapshot")
def snapshot_schedule(v: Views) -> DataFrame:
    return v.account_balance_snapshot


# Rules and routing


def line_rules(v: Views) -> list[Rule]:
    return [
        FirstCopyRule(DUPLICATE, ("transaction_id",), LINE_ORDER),
        RowRule(NULL_AMOUNT, F.col("amount").isNull()),
        KnownKeyRule(ORPHAN_ACCOUNT, "account_id", v.known_accounts, "account_id"),
        RowRule(NEGATIVE_AMOUNT, F.col("amount") < 0),
        RowRule(INVALID_CURRENCY, not_in("currency", LINE_CURRENCIES)),
    ]


def judged(v: Views, *positions: int) -> DataFrame:
    rules = line_rules(v)
    chosen = [rules[p] for p in positions] if positions else rules
    return evaluate(v.lines, chosen, from_files=True)


def one_rule(name: str, position: int, where: str, source: str = "lines") -> None:
    """Rows breaking a single rule."""
    reason = (DUPLICATE, NULL_AMOUNT, ORPHAN_ACCOUNT, NEGATIVE_AMOUNT, INVALID_CURRENCY)[position]
    sql = f"SELECT transaction_id, part_id, account_id, '{reason}' AS data_quality_reason FROM {source} WHERE {where}"

    @query(name, sql)
    def build(v: Views) -> DataFrame:
        broken = judged(v, position).filter(F.col(REASON_COLUMN) != "")
        return broken.select("transaction_id", "part_id", "account_id", REASON_COLUMN)


one_rule("rule_duplicate", 0, "dup_rank > 1", "ranked")
one_rule("rule_null_amount", 1, "amount IS NULL")
one_rule("rule_orphan", 2, "account_id NOT IN (SELECT account_id FROM known_accounts)")
one_rule("rule_negative_amount", 3, "amount < 0")
one_rule("rule_allowed_values", 4, "currency NOT IN ('A', 'N')")


@query("quality_reason", f"SELECT {LINE_LIST}, data_quality_reason FROM judged")
def quality_reason(v: Views) -> DataFrame:
    return judged(v).select(*LINE_COLUMNS, REASON_COLUMN)


@query(
    "quality_reason_array",
    "SELECT transaction_id, part_id, account_id, CAST(CASE WHEN amount IS NULL THEN 1 ELSE 0 END + CASE WHEN amount < 0 THEN 1 "
    "ELSE 0 END + CASE WHEN currency NOT IN ('A', 'N') THEN 1 ELSE 0 END AS INTEGER) AS n_reasons, concat_ws('|', CASE WHEN "
    "amount IS NULL THEN 'NULL_AMOUNT' END, CASE WHEN amount < 0 THEN 'NEGATIVE_AMOUNT' END, CASE WHEN currency NOT IN "
    "('A', 'N') THEN 'INVALID_CURRENCY' END) AS reasons FROM lines",
)
def quality_reason_array(v: Views) -> DataFrame:
    flags = [F.when(r.bad, F.lit(r.reason)) for r in line_rules(v) if isinstance(r, RowRule)]
    broken = F.filter(F.array(*flags), lambda reason: reason.isNotNull())
    return v.lines.select(
        "transaction_id", "part_id", "account_id", F.size(broken).alias("n_reasons"), F.concat_ws("|", broken).alias("reasons")
    )


@query("silver_valid", f"SELECT {LINE_LIST}, TRUE AS stamped FROM judged WHERE data_quality_reason = ''")
def silver_valid(v: Views) -> DataFrame:
    valid, _ = route(judged(v))
    return valid.select(*LINE_COLUMNS, F.col(SILVER_STAMP).isNotNull().alias("stamped"))


@query("quarantine", f"SELECT {LINE_LIST}, data_quality_reason, TRUE AS stamped FROM judged WHERE data_quality_reason <> ''")
def quarantine(v: Views) -> DataFrame:
    _, aside = route(judged(v))
    return aside.select(*LINE_COLUMNS, REASON_COLUMN, F.col(QUARANTINE_STAMP).isNotNull().alias("stamped"))


@query("row_balance", report_sql(("row_balance", "lines", total("lines"), total("judged"))))
def row_balance(v: Views) -> DataFrame:
    return same_count("lines", v.lines, *route(judged(v)), check="row_balance")


@query("reason_counts", "SELECT reason, count(*) AS \"rows\" FROM (SELECT unnest(string_split(data_quality_reason, '|')) AS reason "
       "FROM judged WHERE data_quality_reason <> '') AS r GROUP BY 1")
def reasons(v: Views) -> DataFrame:
    return reason_counts(route(judged(v))[1])


@query("reasons_by_id", "SELECT transaction_id, string_agg(r, ',' ORDER BY r) AS reasons, sum(n)::BIGINT AS \"rows\", "
       "string_agg(r || '=' || n, ',' ORDER BY r || '=' || n) AS copies FROM (SELECT transaction_id, data_quality_reason AS r, count(*) AS n "
       "FROM judged WHERE data_quality_reason <> '' GROUP BY 1, 2) AS t GROUP BY 1")
def reasons_per_id(v: Views) -> DataFrame:
    return reasons_by_id(route(judged(v))[1], "transaction_id")


# Ids with reasons to look for; some of them are held for others, or not at all.
KNOWN_REASONS = {11: (NULL_AMOUNT, ORPHAN_ACCOUNT), 12: (NEGATIVE_AMOUNT,), 31: (INVALID_CURRENCY, DUPLICATE), 32: (INVALID_CURRENCY,), 33: (INVALID_CURRENCY,)}


@query(
    "expected_reasons",
    report_sql(
        *[
            (f"{identity} {name}", "quarantine", "1",
             "(SELECT coalesce(max(CAST(list_contains(string_split(data_quality_reason, '|'), "
             f"'{name}') AS INTEGER)), 0) FROM judged WHERE transaction_id = {identity} AND data_quality_reason <> '')")
            for identity, names in KNOWN_REASONS.items()
            for name in names
        ]
    ),
)
def expected_reasons(v: Views) -> DataFrame:
    return checks.expected_reasons(route(judged(v))[1], "transaction_id", KNOWN_REASONS)


@query(
    "silver_clean",
    report_sql(
        ("null_amount", "silver.lines", "0", total("judged", "data_quality_reason = '' AND amount IS NULL")),
        ("negative_amount", "silver.lines", "0", total("judged", "data_quality_reason = '' AND amount < 0")),
        ("currency", "silver.lines", "0", total("judged", "data_quality_reason = '' AND currency NOT IN ('A', 'N')")),
        ("unique_transaction_id", "silver.lines", total("judged", "data_quality_reason = ''"),
         "(SELECT count(DISTINCT transaction_id) FROM judged WHERE data_quality_reason = '')"),
        ("known_account", "silver.lines", "0",
         total("judged", "data_quality_reason = '' AND account_id NOT IN (SELECT account_id FROM known_accounts)")),
    ),
)
def silver_clean(v: Views) -> DataFrame:
    valid, _ = route(judged(v))
    return checks.clean_transactions(valid, v.known_accounts, "silver.lines", LINE_CURRENCIES)


def _plain_sql(table: str) -> str:
    """Rows of a table as one text each, the way both engines write its columns."""
    texts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in business_columns(table))
    return f"SELECT '{table}' AS subject, concat_ws('|', {texts}) AS content, TRUE AS stamped FROM {table}"


@query("silver_standard", " UNION ALL ".join(_plain_sql(t) for t in medallion.PLAIN))
def silver_standard(v: Views) -> DataFrame:
    """All eight tables that silver passes on with a stamp."""
    parts = []
    for table in medallion.PLAIN:
        passed = stamped(v.source(table), SILVER_STAMP, PROCESSED_AT)
        texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in business_columns(table)]
        parts.append(passed.select(F.lit(table).alias("subject"), F.concat_ws("|", *texts).alias("content"), F.col(SILVER_STAMP).isNotNull().alias("stamped")))
    return union(parts)


# Aggregates, windows and keys


@query(
    "unique_keys",
    report_sql(
        ("unique_o_orderkey", "orders", total("orders"), distinct("orders", "o_orderkey")),
        ("unique_c_custkey", "customer", total("customer"), distinct("customer", "c_custkey")),
        ("unique_l_orderkey_l_linenumber", "lineitem", total("lineitem"), distinct("lineitem", "l_orderkey, l_linenumber")),
    ),
)
def unique_keys(v: Views) -> DataFrame:
    return union(
        [
            unique(v.table("orders"), "orders", ["o_orderkey"]),
            unique(v.table("customer"), "customer", ["c_custkey"]),
            unique(v.table("lineitem"), "lineitem", ["l_orderkey", "l_linenumber"]),
        ]
    )


@query("duplicate_groups", "SELECT transaction_id, count(*) AS \"rows\" FROM lines GROUP BY 1 HAVING count(*) > 1")
def repeated(v: Views) -> DataFrame:
    return duplicate_groups(v.lines, ["transaction_id"])


@query("dup_rank", "SELECT transaction_id, part_id, account_id, CAST(dup_rank AS BIGINT) AS dup_rank FROM ranked")
def dup_rank(v: Views) -> DataFrame:
    ranked = rank_in_group(v.lines, ["transaction_id"], LINE_ORDER, "dup_rank", from_files=True)
    return ranked.select("transaction_id", "part_id", "account_id", "dup_rank")


ORDER_KEY_SQL = "SELECT row_number() OVER (ORDER BY o_orderdate NULLS FIRST, o_orderkey NULLS FIRST) AS order_sk, o_orderkey, o_custkey FROM orders"


@query("surrogate_key", ORDER_KEY_SQL)
def order_key(v: Views) -> DataFrame:
    keyed = surrogate_key(v.table("orders"), ["o_orderdate", "o_orderkey"], "order_sk", from_files=True)
    return keyed.select("order_sk", "o_orderkey", "o_custkey")


@query("surrogate_key_bucketed", ORDER_KEY_SQL)
def order_key_sliced(v: Views) -> DataFrame:
    orders = v.table("orders").select("o_orderdate", "o_orderkey", "o_custkey")
    return sliced_number(orders, ["o_orderdate", "o_orderkey"], "order_sk", from_files=True).drop("o_orderdate")


@query("one_current", "SELECT customer_id, CAST(sum(CAST(is_current AS INTEGER)) AS BIGINT) AS current_versions FROM flawed_history "
       "GROUP BY 1 HAVING sum(CAST(is_current AS INTEGER)) <> 1")
def one_current(v: Views) -> DataFrame:
    return checks.current_counts(v.flawed_history, "customer_id")


@query("customer_since", "SELECT customer_id, min(effective_from) AS customer_since FROM history GROUP BY 1")
def customer_since(v: Views) -> DataFrame:
    return checks.customer_since(v.history)


@query("weights_sum_to_one", "SELECT account_id, CAST(sum(cents) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS total FROM bridge_shares "
       "GROUP BY 1 HAVING abs(sum(cents) - 100) >= 1")
def weights(v: Views) -> DataFrame:
    off = checks.weights_sum_to_one(v.bridge_shares)
    return off.select("account_id", F.col("total").cast("decimal(18,2)").alias("total"))


@query(
    "quality_profile",
    report_sql(
        ("negative_balance", "customer", "0", total("customer", "c_acctbal < 0")),
        ("null_or_zero_balance", "customer", "0", total("customer", "c_acctbal IS NULL OR c_acctbal = 0")),
        ("unknown_segment", "customer", "0", total("customer", "c_mktsegment NOT IN ('BUILDING', 'MACHINERY')")),
        ("null_amount", "lines", "0", total("lines", "amount IS NULL")),
        ("any_null", "lines", "0", total("lines", "amount IS NULL OR currency IS NULL OR account_id IS NULL")),
        ("refund", "lines", "0", total("lines", "amount < 0 AND NOT currency = 'R'")),
        ("large", "lines", "0", total("lines", "amount >= 50000 AND amount <= 60000")),
    ),
)
def quality_profile(v: Views) -> DataFrame:
    balance, amount, currency = F.col("c_acctbal"), F.col("amount"), F.col("currency")
    return none_of(
        v.table("customer"),
        "customer",
        {
            "negative_balance": balance < 0,
            "null_or_zero_balance": balance.isNull() | (balance == 0),
            "unknown_segment": not_in("c_mktsegment", ["BUILDING", "MACHINERY"]),
        },
    ).unionByName(
        none_of(
            v.lines,
            "lines",
            {
                "null_amount": amount.isNull(),
                "any_null": amount.isNull() | currency.isNull() | F.col("account_id").isNull(),
                "refund": (amount < 0) & ~(currency == "R"),
                "large": (amount >= 50000) & (amount <= 60000),
            },
        )
    )


# Versions and lookups

VERSION_COLUMNS = ("customer_id", "effective_from", "effective_to", "is_current", "customer_segment")
VERSION_LIST = ", ".join(VERSION_COLUMNS)


def versions(v: Views) -> DataFrame:
    return build_versions(v.history, "customer_id")


@query("scd2_build", f"SELECT {VERSION_LIST} FROM versions")
def scd2_build(v: Views) -> DataFrame:
    return versions(v).select(*VERSION_COLUMNS)


LATE_SQL = f"""SELECT {VERSION_LIST} FROM (SELECT *, lag({{end}}) OVER (PARTITION BY customer_id ORDER BY effective_from)
    AS previous_end FROM flawed_history) AS p WHERE effective_from <= previous_end"""


@query("scd2_overlap", LATE_SQL.format(end="effective_to"))
def scd2_overlap(v: Views) -> DataFrame:
    return overlapping(v.flawed_history, "customer_id").select(*VERSION_COLUMNS)


@query("scd2_overlap_strict", LATE_SQL.format(end="coalesce(effective_to, DATE '9999-12-31')"))
def scd2_overlap_strict(v: Views) -> DataFrame:
    return overlapping(v.flawed_history, "customer_id", open_blocks=True).select(*VERSION_COLUMNS)


@query(
    "scd2_interval_check",
    report_sql(
        ("current_is_open", "history", "0", total("flawed_history", "is_current AND effective_to IS NOT NULL")),
        ("history_is_closed", "history", "0",
         total("flawed_history", "NOT is_current AND (effective_to IS NULL OR effective_to < effective_from)")),
    ),
)
def scd2_interval_check(v: Views) -> DataFrame:
    return none_of(v.flawed_history, "history", checks.interval_tests())


SHIPPED = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "ship_day", "customer_segment")
SHIPPED_SQL = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ship_day, customer_segment FROM shipments s
    JOIN versions v ON s.customer_id = v.customer_id AND ship_day >= effective_from
    AND (effective_to IS NULL OR ship_day <= effective_to)"""


@query("scd2_lookup", SHIPPED_SQL)
def scd2_lookup(v: Views) -> DataFrame:
    return version_on(v.shipments, versions(v), "customer_id", "ship_day", ["customer_segment"]).select(*SHIPPED)


@query("scd2_lookup_bucketed", SHIPPED_SQL)
def scd2_lookup_bucketed(v: Views) -> DataFrame:
    found = version_on(v.shipments, versions(v), "customer_id", "ship_day", ["customer_segment"], bucket_days=365)
    return found.select(*SHIPPED)


@query("scd2_lookup_asof", SHIPPED_SQL)
def scd2_lookup_asof(v: Views) -> DataFrame:
    return version_as_of(v.shipments, v.history, "customer_id", "ship_day", ["customer_segment"]).select(*SHIPPED)


def dimension(v: Views, spec) -> DataFrame:
    return build_dimension(spec, v.source(spec.source), PROCESSED_AT)


def dimensions(v: Views) -> dict[str, DataFrame]:
    built = concurrently(lambda d: dimension(v, d), DIMENSIONS)
    return {d.name: df for d, df in zip(DIMENSIONS, built)}


@query("dim_customer", "SELECT customer_sk, customer_id, effective_from, effective_to, is_current, customer_segment FROM dim_customer")
def dim_customer(v: Views) -> DataFrame:
    return dimension(v, DIM_CUSTOMER).select("customer_sk", *VERSION_COLUMNS)


@query("dim_account", "SELECT account_sk, account_id, customer_id, branch_id, account_type, account_status, currency, open_date FROM dim_account")
def dim_account(v: Views) -> DataFrame:
    return dimension(v, DIM_ACCOUNT).drop(GOLD_STAMP)


@query("dim_branch", "SELECT branch_sk, branch_id, branch_name, branch_code, city, region, country, opening_date FROM dim_branch")
def dim_branch(v: Views) -> DataFrame:
    return dimension(v, DIM_BRANCH).drop(GOLD_STAMP)


@query("dim_date", "SELECT * FROM keyed_date")
def dim_date(v: Views) -> DataFrame:
    return dimension(v, DIM_DATE).drop(GOLD_STAMP)


@query("lookup_account", f"SELECT {SALE_LIST}, account_sk, branch_id FROM transactions t LEFT JOIN (SELECT account_sk, account_id AS k, "
       "branch_id FROM dim_account) AS a ON t.account_id = a.k")
def lookup_account(v: Views) -> DataFrame:
    found = dimension_lookup(v.transactions, dimension(v, DIM_ACCOUNT), "account_id", ["account_sk", "branch_id"])
    return found.select(*SALE_COLUMNS, "account_sk", "branch_id")


@query("lookup_date", "SELECT transaction_id, part_id, account_id, date_sk, full_date FROM lines l LEFT JOIN keyed_date d "
       "ON l.date_key = d.date_key")
def lookup_date(v: Views) -> DataFrame:
    found = dimension_lookup(v.lines, dimension(v, DIM_DATE), "date_key", ["date_sk", "full_date"])
    return found.select("transaction_id", "part_id", "account_id", "date_sk", "full_date")


@query("lookup_branch", "SELECT a.account_id, branch_sk FROM accounts a LEFT JOIN dim_branch b ON a.branch_id = b.branch_id")
def lookup_branch(v: Views) -> DataFrame:
    return dimension_lookup(v.accounts, dimension(v, DIM_BRANCH), "branch_id", ["branch_sk"]).select("account_id", "branch_sk")


@query(
    "lookup_guard",
    report_sql(
        ("unresolved", "transactions", "0", total("transactions", "account_id NOT IN (SELECT account_id FROM accounts)")),
        ("row_count", "transactions", total("transactions"), total("transactions")),
        ("distinct_rows", "transactions", total("transactions"), distinct("transactions", "transaction_id")),
    ),
)
def guard(v: Views) -> DataFrame:
    found = dimension_lookup(v.transactions, dimension(v, DIM_ACCOUNT), "account_id", ["account_sk"])
    return lookup_guard(found, v.table("lineitem").count(), "transactions", "account_sk", "transaction_id")


@query("orphans_anti", "SELECT transaction_id, part_id, account_id FROM lines WHERE account_id IS NULL OR account_id NOT IN "
       "(SELECT account_id FROM known_accounts)")
def orphans_anti(v: Views) -> DataFrame:
    return v.lines.select("transaction_id", "part_id", "account_id").join(v.known_accounts, "account_id", "left_anti").select(
        "transaction_id", "part_id", "account_id"
    )


def judged_and_dimensions(v: Views) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Judged transactions and the stored dimensions, which do not need each other."""
    judge = lambda: evaluate(v.named_transactions, medallion.transaction_rules(v.accounts, RUN))
    store = lambda: {name: settle(df)[0] for name, df in dimensions(v).items()}
    judged_rows, dims = concurrently(lambda work: work(), [judge, store])
    return judged_rows, dims


def fact(v: Views) -> DataFrame:
    """Valid order lines with the surrogate keys of their day."""
    evaluated, dims = judged_and_dimensions(v)
    valid, _ = route(evaluated, RUN.at)
    resolved = resolve_transactions(valid, dims["dim_account"], dims["dim_date"], dims["dim_branch"], dims["dim_customer"])
    return build_fact(resolved, RUN.at).drop(GOLD_STAMP)


QUERIES["fact_transaction"] = lambda spark, folder: fact(Views(spark, folder))
ORACLES["fact_transaction"] = oracle(f"SELECT {FACT_LIST} FROM fact")


# Check suites


@query(
    "audit_nulls",
    report_sql(
        ("filled_o_clerk", "orders", "0", total("orders")),
        ("filled_o_orderdate", "orders", "0", total("orders", "o_orderdate IS NULL")),
        ("filled_amount", "lines", "0", total("lines", "amount IS NULL")),
        ("filled_currency", "lines", "0", total("lines", "currency IS NULL")),
    ),
)
def audit_nulls(v: Views) -> DataFrame:
    return checks.audit_nulls({"orders": v.table("orders")}, ["o_clerk", "o_orderdate"]).unionByName(
        checks.audit_nulls({"lines": v.lines}, ["amount", "currency"])
    )


@query(
    "expectations",
    report_sql(
        ("null_amount", "lines", "1202", total("lines", "amount IS NULL")),
        ("negative_in_r", "lines", "10", total("lines", "amount < 0 AND currency = 'R'")),
        ("first_order", "lines", "2", total("lines", "transaction_id >= 10 AND transaction_id < 20")),
    ),
)
def expectations(v: Views) -> DataFrame:
    amount, identity = F.col("amount"), F.col("transaction_id")
    return checks.expectations(
        v.lines,
        "lines",
        {
            "null_amount": (amount.isNull(), 1202),
            "negative_in_r": ((amount < 0) & (F.col("currency") == "R"), 10),
            "first_order": ((identity >= 10) & (identity < 20), 2),
        },
    )


@query(
    "unintended_defects",
    report_sql(
        ("amount", "lines", "0", total("lines", "currency <> 'R' AND (amount IS NULL OR amount <= 0)")),
        ("currency", "lines", "0", total("lines", "currency <> 'R' AND (currency IS NULL OR currency NOT IN ('A', 'N'))")),
        ("unique_transaction_id", "lines", total("lines", "currency <> 'R'"),
         "(SELECT count(DISTINCT transaction_id) FROM lines WHERE currency <> 'R')"),
        ("known_account", "lines", "0", total("lines", "currency <> 'R' AND account_id NOT IN (SELECT account_id FROM known_accounts)")),
    ),
)
def unintended_defects(v: Views) -> DataFrame:
    return checks.no_other_defects(v.lines, F.col("currency") == "R", v.known_accounts, "lines", LINE_CURRENCIES)


@query(
    "referential_integrity",
    report_sql(*[("orphans", e.label, "0", orphans(e.child, e.column, e.parent, e.parent_column)) for e in FOREIGN_KEYS]),
)
def referential_integrity(v: Views) -> DataFrame:
    return checks.referential_integrity({t: getattr(v, t) for t in TABLES})


def _plain_dimension_sql(name: str, twin: str, source: str, key: str, surrogate: str) -> list[tuple[str, str, str, str]]:
    return [
        ("row_count", name, total(source), total(twin)),
        *[(f"null_{k}", name, "0", total(twin, f"{k} IS NULL")) for k in (key, surrogate)],
        *[(f"unique_{k}", name, total(twin), distinct(twin, k)) for k in (key, surrogate)],
        ("required_column", f"{name}.{GOLD_STAMP}", "1", "1"),
    ]


PLAIN_DIMENSIONS = [
    *_plain_dimension_sql("dim_account", "dim_account", "accounts", "account_id", "account_sk"),
    *_plain_dimension_sql("dim_branch", "dim_branch", "branches", "branch_id", "branch_sk"),
    *_plain_dimension_sql("dim_date", "keyed_date", "dim_date", "date_key", "date_sk"),
]


@query("dimension_check", report_sql(*PLAIN_DIMENSIONS))
def dimension_check(v: Views) -> DataFrame:
    """The suite of each of the three plain dimensions."""
    sources = {DIM_ACCOUNT: v.accounts, DIM_BRANCH: v.branches, DIM_DATE: v.dim_date}
    return union([checks.dimension_suite(dimension(v, d), d, source) for d, source in sources.items()])


VERSION_SUITE = [
    ("row_count", "dim_customer", total("history"), total("dim_customer")),
    ("unique_customer_sk", "dim_customer", total("dim_customer"), distinct("dim_customer", "customer_sk")),
    ("unique_customer_id_effective_from", "dim_customer", total("dim_customer"), distinct("dim_customer", "customer_id, effective_from")),
    ("current_is_open", "dim_customer", "0", total("dim_customer", "is_current AND effective_to IS NOT NULL")),
    ("history_is_closed", "dim_customer", "0",
     total("dim_customer", "NOT is_current AND (effective_to IS NULL OR effective_to < effective_from)")),
    ("one_current", "dim_customer", "0",
     "(SELECT count(*) FROM (SELECT customer_id FROM dim_customer GROUP BY 1 HAVING sum(CAST(is_current AS INTEGER)) <> 1) AS o)"),
    ("no_overlap", "dim_customer", "0",
     "(SELECT count(*) FROM (SELECT effective_from, lag(effective_to) OVER (PARTITION BY customer_id ORDER BY effective_from) AS p "
     "FROM dim_customer) AS o WHERE effective_from <= p)"),
]


@query("scd2_suite", report_sql(*VERSION_SUITE))
def scd2_suite(v: Views) -> DataFrame:
    return checks.version_suite(dimension(v, DIM_CUSTOMER), DIM_CUSTOMER, v.history)


def stored_gold(v: Views) -> tuple[DataFrame, DataFrame, dict[str, DataFrame]]:
    """Fact, its source and the dimensions, written and read back."""
    layout = Layout(scratch_path(v.spark, "gold"))
    evaluated, dims = judged_and_dimensions(v)
    write_layer(route(evaluated, RUN.at)[0], layout.silver("transactions"))
    source = v.spark.read.parquet(layout.silver("transactions"))
    resolved = resolve_transactions(source, dims["dim_account"], dims["dim_date"], dims["dim_branch"], dims["dim_customer"])
    write_layer(build_fact(resolved, RUN.at), layout.fact("fact_transaction"))
    return v.spark.read.parquet(layout.fact("fact_transaction")), source, dims


NAMED_DIMS = (("account_sk", "dim_account"), ("branch_sk", "dim_branch"), ("customer_sk", "dim_customer"), ("date_sk", "keyed_date"))
NULL_KEYS = [(f"null_{k}", "fact_transaction", "0", total("fact", f"{k} IS NULL")) for k, _ in NAMED_DIMS]
FACT_HEAD = [
    ("row_count", "fact_transaction", total("booked_valid"), total("fact")),
    ("unique_transaction_id", "fact_transaction", total("fact"), distinct("fact", "transaction_id")),
    *NULL_KEYS,
]
IN_VERSION = (
    "(SELECT count(*) FROM fact f JOIN keyed_date d ON f.date_sk = d.date_sk JOIN dim_customer c ON f.customer_sk = c.customer_sk "
    "WHERE NOT (full_date >= effective_from AND (effective_to IS NULL OR full_date <= effective_to)))"
)


FACT_SUITE = [
    *FACT_HEAD,
    ("null_amount", "fact_transaction", "0", total("fact", "amount IS NULL")),
    ("negative_amount", "fact_transaction", "0", total("fact", "amount < 0")),
    ("currency", "fact_transaction", "0", total("fact", "currency NOT IN ('AZN', 'USD', 'EUR')")),
    ("stamped", "fact_transaction", "0", "0"),
    *[
        ("orphans", f"fact_transaction.{k} -> {'dim_date' if d == 'keyed_date' else d}", "0", orphans("fact", k, d, k))
        for k, d in NAMED_DIMS
    ],
    ("version_holds", "fact_transaction", "0", IN_VERSION),
]


@query("fact_suite", report_sql(*FACT_SUITE))
def fact_suite(v: Views) -> DataFrame:
    stored, source, dims = stored_gold(v)
    return checks.fact_suite(stored, source, dims)


RECHECK = [
    *FACT_HEAD,
    ("unresolved", "fact_transaction", total("fact"), distinct("fact", "transaction_id")),
    ("ambiguous", "fact_transaction", "0", "0"),
    ("different_version", "fact_transaction", "0", IN_VERSION),
]


@query("fact_recheck", report_sql(*RECHECK))
def fact_recheck(v: Views) -> DataFrame:
    stored, source, dims = stored_gold(v)
    return checks.fact_recheck(stored, source, dims)


@query(
    "temporal_consistency",
    report_sql(
        ("before_open", "transactions", "0",
         "(SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN accounts ON o_custkey = account_id "
         "WHERE CAST(l_shipdate AS DATE) < open_date + 400)"),
        ("before_customer", "transactions", "0",
         "(SELECT count(*) FROM shipments s JOIN (SELECT customer_id AS k, min(effective_from) AS since FROM history GROUP BY 1) AS h "
         "ON s.customer_id = k WHERE ship_day < since)"),
    ),
)
def temporal_consistency(v: Views) -> DataFrame:
    """Ship days against opening days moved 400 days later."""
    shipped = v.shipments.select(F.col("customer_id").alias("account_id"), F.col("ship_day").alias("transaction_timestamp"))
    late = v.accounts.withColumn("open_date", F.date_add("open_date", 400))
    return checks.temporal_consistency(shipped, late, v.history)


# Whole jobs: source to each layer


def _read(v: Views) -> medallion.Reader:
    return lambda _, table: v.source(table)


@query(
    "medallion_bronze",
    f"SELECT {SALE_LIST}, CAST(date_key // 10000 AS INTEGER) AS transaction_year, 'transactions' AS bronze_source_table FROM transactions",
)
def medallion_bronze(v: Views) -> DataFrame:
    layout = Layout(scratch_path(v.spark, "lake"))
    enforce(medallion.bronze(v.spark, layout, _read(v), RUN))
    stored = v.spark.read.parquet(layout.bronze("transactions"))
    return stored.select(*SALE_COLUMNS, YEAR_COLUMN, "bronze_source_table")


def _silver(v: Views) -> Layout:
    layout = Layout(scratch_path(v.spark, "lake"))
    enforce(medallion.bronze(v.spark, layout, _read(v), RUN))
    enforce(medallion.silver(v.spark, layout, RUN))
    return layout


@query("medallion_silver", f"SELECT {SALE_LIST}, data_quality_reason FROM booked_judged")
def medallion_silver(v: Views) -> DataFrame:
    layout = _silver(v)
    valid = v.spark.read.parquet(layout.silver("transactions")).withColumn(REASON_COLUMN, F.lit(""))
    aside = v.spark.read.parquet(layout.quarantine("transactions"))
    return valid.select(*SALE_COLUMNS, REASON_COLUMN).unionByName(aside.select(*SALE_COLUMNS, REASON_COLUMN))


@query("medallion_gold", f"SELECT {FACT_LIST} FROM fact")
def medallion_gold(v: Views) -> DataFrame:
    layout = _silver(v)
    enforce(medallion.gold_dimensions(v.spark, layout, RUN))
    enforce(medallion.gold_fact(v.spark, layout, RUN))
    return v.spark.read.parquet(layout.fact("fact_transaction")).drop(GOLD_STAMP)


def _columns_sql(layer: str, table: str, extra: Iterable[str]) -> list[tuple[str, str, str, str]]:
    return [("required_column", f"{layer}.{table}.{c}", "1", "1") for c in (*business_columns(table), *AUDIT_COLUMNS, *extra)]


STAGE_SQL = {
    "ready": [("source_ready", t, "1", f"(SELECT least(count(*), 1) FROM {t})") for t in TABLES],
    "validate": SOURCE_SQL,
    "bronze": [row for t in TABLES for row in (("row_count", f"bronze.{t}", total(t), total(t)), *_columns_sql("bronze", t, ()))],
    "silver": [
        *[row for t in medallion.PLAIN for row in (("row_count", f"silver.{t}", total(t), total(t)), *_columns_sql("silver", t, BRONZE_COLUMNS))],
        ("routed_rows", "transactions", total("transactions"), total("booked_judged")),
        ("row_balance", "transactions", total("transactions"), total("booked_judged")),
        ("null_amount", "silver.transactions", "0", total("booked_valid", "amount IS NULL")),
        ("negative_amount", "silver.transactions", "0", total("booked_valid", "amount < 0")),
        ("currency", "silver.transactions", "0", total("booked_valid", "currency NOT IN ('AZN', 'USD', 'EUR')")),
        ("unique_transaction_id", "silver.transactions", total("booked_valid"), distinct("booked_valid", "transaction_id")),
        ("known_account", "silver.transactions", "0", total("booked_valid", "account_id NOT IN (SELECT account_id FROM accounts)")),
    ],
    "dimensions": [
        *VERSION_SUITE,
        *PLAIN_DIMENSIONS,
        ("orphans", "dim_account.branch_id -> dim_branch", "0", orphans("dim_account", "branch_id", "dim_branch", "branch_id")),
        ("orphans", "dim_account.customer_id -> dim_customer", "0", orphans("dim_account", "customer_id", "dim_customer", "customer_id")),
    ],
    "fact": [
        *[
            row
            for k, _ in NAMED_DIMS
            for row in (
                ("unresolved", f"fact_transaction.{k}", "0", total("fact", f"{k} IS NULL")),
                ("row_count", f"fact_transaction.{k}", total("booked_valid"), total("fact")),
            )
        ],
        *FACT_SUITE,
    ],
    "validation": RECHECK,
}


@query("medallion_report", " UNION ALL ".join(f"SELECT *, '{stage}' AS stage FROM ({report_sql(*rows)}) AS s" for stage, rows in STAGE_SQL.items()))
def medallion_report(v: Views) -> DataFrame:
    """The report of every stage of a complete run, which stops at the first failing one."""
    return medallion.run_all(v.spark, Layout(scratch_path(v.spark, "lake")), _read(v), RUN)
