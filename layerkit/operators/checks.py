"""Check suites over layer tables; each returns report rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from layerkit.functions import day_of
from layerkit.operators.lookup import dimension_lookup
from layerkit.operators.reports import (
    has_columns,
    missing_columns,
    missing_keys,
    none_of,
    one_pass,
    same_count,
    static_report,
    union,
    unique,
)
from layerkit.operators.rules import not_in
from layerkit.operators.scd2 import BUCKET_DAYS, holds_on, overlapping, version_on
from layerkit.operators.star import DIMENSIONS, FACT, Dimension
from layerkit.schemas import ALLOWED_CURRENCIES, AUDIT_COLUMNS, FOREIGN_KEYS, GOLD_STAMP, PRIMARY_KEYS, REASON_COLUMN, REASON_SEPARATOR, ForeignKey, contract
from layerkit.session import concurrently
from layerkit.sources.scratch import settle
from layerkit.sources.writers import observed


def _except(df: DataFrame, known: Column) -> DataFrame:
    """Rows outside ``known``; where it is NULL the row stays."""
    return df.filter(~F.coalesce(known, F.lit(False)))


def audit_nulls(tables: Mapping[str, DataFrame], columns: Sequence[str] = AUDIT_COLUMNS) -> DataFrame:
    """Audit columns exist and are filled; a missing one counts as all rows."""
    parts = []
    for name, df in tables.items():
        absent = missing_columns(df, columns)
        tests = {f"filled_{c}": F.lit(True) if c in absent else F.col(c).isNull() for c in columns}
        parts.append(none_of(df, name, tests))
    return union(parts)


def schema_conformance(df: DataFrame, table: str) -> DataFrame:
    """Declared names and types; metadata only."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    rows = [
        (f"type_{f.dataType.simpleString()}", f"{table}.{f.name}", 1, int(actual.get(f.name) == f.dataType.simpleString()))
        for f in contract(table)
    ]
    return static_report(df.sparkSession, rows)


def not_null(df: DataFrame, table: str) -> DataFrame:
    """Columns declared NOT NULL hold no NULL; one pass."""
    return none_of(df, table, {f"not_null_{f.name}": F.col(f.name).isNull() for f in contract(table) if not f.nullable})


def expectations(df: DataFrame, subject: str, expected: Mapping[str, tuple[Column, int]]) -> DataFrame:
    """Exact number of rows for each predicate; one pass for all of them."""
    return one_pass(df, subject, {name: (F.lit(n), F.count_if(test)) for name, (test, n) in expected.items()})


def _defects(allowed: Sequence[str], zero_allowed: bool = False) -> dict[str, Column]:
    low = F.col("amount") < 0 if zero_allowed else F.col("amount") <= 0
    return {"amount": F.col("amount").isNull() | low, "currency": F.col("currency").isNull() | not_in("currency", allowed)}


def no_other_defects(
    df: DataFrame,
    known: Column,
    accounts: DataFrame,
    subject: str = "transactions",
    allowed: Sequence[str] = ALLOWED_CURRENCIES,
    key: str = "transaction_id",
    account: str = "account_id",
    zero_allowed: bool = False,
) -> DataFrame:
    """Rows outside the ``known`` defects have none: unique, positive, resolvable, allowed."""
    clean = _except(df, known)
    return union(
        [
            none_of(clean, subject, _defects(allowed, zero_allowed)),
            unique(clean, subject, [key]),
            missing_keys(clean, account, accounts, account, subject, "known_account"),
        ]
    )


def clean_transactions(
    df: DataFrame,
    accounts: DataFrame,
    subject: str = "silver.transactions",
    allowed: Sequence[str] = ALLOWED_CURRENCIES,
    key: str = "transaction_id",
    account: str = "account_id",
) -> DataFrame:
    """What routing promises: unique keys and no broken rule. NULLs break only the amount rule."""
    tests = {
        "null_amount": F.col("amount").isNull(),
        "negative_amount": F.col("amount") < 0,
        "currency": not_in("currency", allowed),
    }
    present = df.filter(F.col(account).isNotNull())
    return union(
        [
            none_of(df, subject, tests),
            unique(df, subject, [key]),
            missing_keys(present, account, accounts, account, subject, "known_account"),
        ]
    )


def expected_reasons(
    quarantined: DataFrame, key: str, wanted: Mapping[object, Sequence[str]], subject: str = "quarantine", reason: str = REASON_COLUMN
) -> DataFrame:
    """Each listed id is held for each of its reasons; one pass for all of them."""
    parts = F.split(F.col(reason), f"\\{REASON_SEPARATOR}")
    held = {
        f"{identity} {name}": (F.lit(1), F.max(((F.col(key) == identity) & F.array_contains(parts, name)).cast("int")))
        for identity, names in wanted.items()
        for name in names
    }
    return one_pass(quarantined, subject, held)


def referential_integrity(
    tables: Mapping[str, DataFrame],
    edges: Iterable[ForeignKey] = FOREIGN_KEYS,
    excused: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Orphan rows of each foreign key; ``excused`` rows of a child are left out.

    Each table is read once: all its keys are counted together and every edge reads the counts.
    """
    excused, edges = excused or {}, list(edges)
    keys: dict[str, list[str]] = {}
    for edge in edges:
        keys.setdefault(edge.child, []).append(edge.column)
        keys.setdefault(edge.parent, []).append(edge.parent_column)

    def count(name: str) -> DataFrame:
        df, columns = tables[name], list(dict.fromkeys(keys[name]))
        if name in excused:
            df, columns = df.withColumn("__excused", F.coalesce(excused[name], F.lit(False))), [*columns, "__excused"]
        return one_scan(df, name, {}, columns).keys

    counted = dict(zip(keys, concurrently(count, keys)))
    parts = []
    for edge in edges:
        child = counted[edge.child]
        child = child.filter("NOT __excused") if edge.child in excused else child
        parts.append(missing_keys(child, edge.column, counted[edge.parent], edge.parent_column, edge.label, weight="n"))
    return union(parts)


def primary_keys(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]] = PRIMARY_KEYS) -> DataFrame:
    """Declared keys are unique; copies of a key combine before the shuffle."""
    return union([unique(tables[name], name, columns, "primary_key") for name, columns in keys.items()])


@dataclass(frozen=True)
class Pass:
    """What one pass over a table yields: counts of broken predicates, and its key columns as a stored table.

    Keys are counted, ``n``, unless single rows are needed; either way every
    check on keys reads the narrow table and not the source.
    """

    rows: list[tuple[str, str, int, int]]
    keys: DataFrame


def one_scan(
    df: DataFrame, subject: str, tests: Mapping[str, Column], keys: Sequence[str], sums: Mapping[str, Column] | None = None, counted: bool = True
) -> Pass:
    """Evaluate all predicates and gather all keys of a table in a single pass."""
    seen = Observation()
    watched = df.observe(seen, *[F.count_if(test).alias(f"p{i}") for i, test in enumerate(tests.values())]) if tests else df
    totals = [F.sum(c).alias(name) for name, c in (sums or {}).items()]
    narrow = watched.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *totals) if counted else watched.select(*keys)
    stored, _ = settle(narrow)
    broken = observed(seen) if tests else {}
    return Pass([(name, subject, 0, broken.get(f"p{i}", 0)) for i, name in enumerate(tests)], stored)


def source_validation(
    tables: Mapping[str, DataFrame], routed: str = "transactions", known: Column | None = None, allowed: Sequence[str] = ALLOWED_CURRENCIES
) -> DataFrame:
    """What must hold at the source before anything is copied; each table is scanned once.

    Audit columns, NOT NULL columns, primary and foreign keys, owners' weights
    and version history. Rows of ``routed`` answer to the quality rules later, so
    their foreign keys are not checked here. ``known`` marks its rows with
    defects that are expected: then all others must have none, and none may lie
    before its account or its owner.
    """
    edges = [edge for edge in FOREIGN_KEYS if edge.child != routed]
    keys: dict[str, list[str]] = {name: list(PRIMARY_KEYS.get(name, ())) for name in tables}
    for edge in edges:
        keys[edge.child].append(edge.column)
        keys[edge.parent].append(edge.parent_column)
    # Single rows of the history are put in order; days are compared for known defects only.
    keys["customer_history"] += ["effective_to", "is_current"]
    if known is not None:
        keys[routed] += ["transaction_id", "account_id", "transaction_timestamp"]
        keys["accounts"] += ["open_date"]

    def scan(name: str) -> Pass:
        df = tables[name]
        absent = missing_columns(df, AUDIT_COLUMNS)
        tests = {f"filled_{c}": F.lit(True) if c in absent else F.col(c).isNull() for c in AUDIT_COLUMNS}
        tests |= {f"not_null_{f.name}": F.col(f.name).isNull() for f in contract(name) if not f.nullable and f.name not in absent}
        if name == routed and known is not None:
            other = ~F.coalesce(known, F.lit(False))
            tests |= {check: other & F.coalesce(bad, F.lit(False)) for check, bad in _defects(allowed).items()}
            df = df.withColumn("__known", ~other)
        columns = list(dict.fromkeys(keys[name])) + (["__known"] if "__known" in df.columns else [])
        sums = {"__weight": F.col("allocation_weight").cast("decimal(18,6)")} if name == "account_customer_bridge" else None
        return one_scan(df, name, tests, columns, sums, counted=name != "customer_history")

    names = list(tables)
    done = dict(zip(names, concurrently(scan, names)))
    counted = {name: p.keys for name, p in done.items()}
    bridge, history = counted["account_customer_bridge"], counted["customer_history"]
    weight = {name: None if name == "customer_history" else "n" for name in names}
    parts = [
        static_report(bridge.sparkSession, [row for p in done.values() for row in p.rows]),
        *[unique(counted[name], name, columns, "primary_key", weight[name]) for name, columns in PRIMARY_KEYS.items()],
        *[missing_keys(counted[e.child], e.column, counted[e.parent], e.parent_column, e.label, weight=weight[e.child]) for e in edges],
        _count(weights_sum_to_one(bridge, weight="__weight"), "account_customer_bridge", "weights_sum_to_one"),
        version_history(history, "customer_id", "customer_history"),
    ]
    if known is not None:
        clean = counted[routed].filter(~F.col("__known"))
        parts += [
            unique(clean, routed, ["transaction_id"], weight="n"),
            missing_keys(clean, "account_id", counted["accounts"], "account_id", routed, "known_account", weight="n"),
            temporal_consistency(clean, counted["accounts"], history, weight="n"),
        ]
    return union(parts)


def weights_sum_to_one(
    bridge: DataFrame, key: str = "account_id", weight: str = "allocation_weight", tolerance: float = 0.01
) -> DataFrame:
    """Keys whose rounded weights do not add up to one; NULL weights add nothing."""
    added = F.coalesce(F.sum(F.col(weight).cast("decimal(18,6)")), F.lit(0).cast("decimal(18,6)"))
    total = F.round(added, 2)
    return bridge.groupBy(key).agg(total.alias("total")).filter(F.abs(F.col("total") - 1) >= F.lit(tolerance).cast("decimal(4,2)"))


def current_counts(versions: DataFrame, key: str, current: str = "is_current") -> DataFrame:
    """Keys without exactly one current version."""
    counted = versions.groupBy(key).agg(F.sum(F.col(current).cast("int")).alias("current_versions"))
    return counted.filter(F.coalesce("current_versions", F.lit(0)) != 1)


def interval_tests(start: str = "effective_from", end: str = "effective_to", current: str = "is_current") -> dict[str, Column]:
    """A current version is open; an earlier one has a closed, forward range."""
    backward = F.col(end).isNull() | (F.col(end) < F.col(start))
    return {
        "current_is_open": F.col(current) & F.col(end).isNotNull(),
        "history_is_closed": ~F.col(current) & backward,
    }


def _count(df: DataFrame, subject: str, check: str) -> DataFrame:
    return one_pass(df, subject, {check: (F.lit(0), F.count(F.lit(1)))})


def version_history(history: DataFrame, key: str, subject: str) -> DataFrame:
    """Source history: one current row per key, no overlaps, nothing after an open end."""
    return union(
        [
            _count(current_counts(history, key), subject, "one_current"),
            _count(overlapping(history, key, open_blocks=True), subject, "no_overlap_strict"),
        ]
    )


def version_suite(versions: DataFrame, dimension: Dimension, source: DataFrame) -> DataFrame:
    """Type-2 dimension: complete, uniquely keyed, one open version, no overlaps."""
    name = dimension.name
    return union(
        [
            same_count(name, source, versions),
            unique(versions, name, [dimension.surrogate]),
            unique(versions, name, dimension.grain),
            none_of(versions, name, interval_tests(start=dimension.version_start)),
            _count(current_counts(versions, dimension.key), name, "one_current"),
            _count(overlapping(versions, dimension.key, dimension.version_start), name, "no_overlap"),
        ]
    )


def dimension_suite(table: DataFrame, dimension: Dimension, source: DataFrame) -> DataFrame:
    """Plain dimension: complete, both keys filled and unique, stamped."""
    name = dimension.name
    keys = (dimension.key, dimension.surrogate)
    return union(
        [
            same_count(name, source, table),
            none_of(table, name, {f"null_{k}": F.col(k).isNull() for k in keys}),
            *[unique(table, name, [k]) for k in keys],
            has_columns(table, name, [GOLD_STAMP]),
        ]
    )


def dimension_links(dim_account: DataFrame, dim_branch: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Accounts point to known branches and customers."""
    return union(
        [
            missing_keys(dim_account, "branch_id", dim_branch, "branch_id", "dim_account.branch_id -> dim_branch"),
            missing_keys(dim_account, "customer_id", dim_customer, "customer_id", "dim_account.customer_id -> dim_customer"),
        ]
    )


def counted_keys(fact: DataFrame) -> DataFrame:
    """Rows ``n`` of the fact for each combination of its keys, written once.

    Every check on keys reads this narrow table, so a busy account or customer
    is counted before it is joined.
    """
    return settle(fact.groupBy(*[d.surrogate for d in DIMENSIONS]).agg(F.count(F.lit(1)).alias("n")))[0]


def _null_keys(counted: DataFrame) -> DataFrame:
    tests = {f"null_{d.surrogate}": (F.lit(0), F.sum(F.when(F.col(d.surrogate).isNull(), F.col("n")))) for d in DIMENSIONS}
    return one_pass(counted, FACT, tests)


def fact_suite(
    fact: DataFrame,
    source: DataFrame,
    dims: Mapping[str, DataFrame],
    allowed: Sequence[str] = ALLOWED_CURRENCIES,
    key: str = "transaction_id",
) -> DataFrame:
    """Complete, unique, fully keyed, valid on its day, and clean.

    The fact is read three times: for its ids, its keys and its values.
    """
    counted = counted_keys(fact)
    tests = {
        "null_amount": F.col("amount").isNull(),
        "negative_amount": F.col("amount") < 0,
        "currency": not_in("currency", allowed),
        "stamped": F.col(GOLD_STAMP).isNull(),
    }
    links = [
        missing_keys(counted, d.surrogate, dims[d.name], d.surrogate, f"{FACT}.{d.surrogate} -> {d.name}", weight="n")
        for d in DIMENSIONS
    ]
    pairs = counted.groupBy("date_sk", "customer_sk").agg(F.sum("n").alias("n"))
    on_day = pairs.join(dims["dim_date"].select("date_sk", "full_date"), "date_sk")
    versions = dims["dim_customer"].select("customer_sk", "effective_from", "effective_to")
    outside = ~holds_on(F.col("full_date"), F.col("effective_from"), F.col("effective_to"))
    return union(
        [
            same_count(FACT, source, counted, weight="n"),
            unique(fact, FACT, [key]),
            _null_keys(counted),
            none_of(fact, FACT, tests),
            *links,
            one_pass(
                on_day.join(versions, "customer_sk"), FACT, {"version_holds": (F.lit(0), F.sum(F.when(outside, F.col("n"))))}
            ),
        ]
    )


def rederived_versions(counted: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Versions found again from natural keys for each owner, day and stored key.

    ``n`` is the number of fact rows, ``found`` the versions that hold, and
    ``different`` those among them that the fact does not name. Owners and days
    are counted first; both they and the versions spread over periods of time.
    """
    accounts = dims["dim_account"].select("account_sk", "customer_id")
    days = dims["dim_date"].select("date_sk", "full_date")
    narrow = counted.select("account_sk", "date_sk", F.col("customer_sk").alias("stored_sk"), "n")
    owned = narrow.join(days, "date_sk", "left").join(accounts, "account_sk", "left")
    asked, _ = settle(owned.groupBy("customer_id", "full_date", "stored_sk").agg(F.sum("n").alias("n")))
    matched = version_on(
        asked, dims["dim_customer"], "customer_id", "full_date", ["customer_sk"], how="left", bucket_days=BUCKET_DAYS, period_as="period"
    )
    return matched.groupBy("customer_id", "period", "full_date", "stored_sk", "n").agg(
        F.count("customer_sk").alias("found"), F.count_if(F.col("customer_sk") != F.col("stored_sk")).alias("different")
    )


def fact_recheck(
    fact: DataFrame, source: DataFrame, dims: Mapping[str, DataFrame], key: str = "transaction_id"
) -> DataFrame:
    """Independent recomputation: nothing unresolved, ambiguous or different.

    The fact is read twice: for its ids and for its keys.
    """
    counted = counted_keys(fact)
    n = F.col("n")
    return union(
        [
            same_count(FACT, source, counted, weight="n"),
            unique(fact, FACT, [key]),
            _null_keys(counted),
            one_pass(
                rederived_versions(counted, dims),
                FACT,
                {
                    "unresolved": (F.sum("n"), F.sum(F.when(F.col("found") > 0, n))),
                    "ambiguous": (F.lit(0), F.sum(F.when(F.col("found") > 1, n))),
                    "different_version": (F.lit(0), F.sum(n * F.col("different"))),
                },
            ),
        ]
    )


def premature(
    transactions: DataFrame,
    accounts: DataFrame,
    history: DataFrame,
    moment: str = "transaction_timestamp",
) -> DataFrame:
    """Transactions next to the first day their account and their owner allow."""
    first = customer_since(history)
    owners = dimension_lookup(accounts.select("account_id", "customer_id", "open_date"), first, "customer_id", ["customer_since"])
    dated = transactions.withColumn("transaction_date", day_of(F.col(moment)))
    joined = dimension_lookup(dated, owners, "account_id", ["open_date", "customer_since"])
    return joined.withColumns(
        {
            "before_open": F.col("transaction_date") < F.col("open_date"),
            "before_customer": F.col("transaction_date") < F.col("customer_since"),
        }
    )


def customer_since(history: DataFrame, key: str = "customer_id", start: str = "effective_from") -> DataFrame:
    """First day of each customer."""
    return history.groupBy(key).agg(F.min(start).alias("customer_since"))


def temporal_consistency(
    transactions: DataFrame, accounts: DataFrame, history: DataFrame, known: Column | None = None, weight: str | None = None
) -> DataFrame:
    """No transaction precedes its account's opening or its owner's first version.

    ``weight`` names a column with the rows that each transaction stands for.
    """
    clean = transactions if known is None else _except(transactions, known)
    found = premature(clean, accounts, history)
    rows = F.lit(1) if weight is None else F.col(weight)
    return one_pass(found, "transactions", {name: (F.lit(0), F.sum(F.when(F.col(name), rows))) for name in ("before_open", "before_customer")})
