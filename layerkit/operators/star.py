"""Dimensions and the fact table of the star schema."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerkit.functions import stamped
from layerkit.operators.lookup import dimension_lookup
from layerkit.operators.ordered import named_rows, surrogate_key
from layerkit.operators.scd2 import build_versions, version_as_of
from layerkit.schemas import GOLD_STAMP, business_columns
from layerkit.sources.scratch import BROADCAST_BYTES, settle


@dataclass(frozen=True)
class Dimension:
    """Recipe of a dimension: source table, natural key and surrogate key.

    ``version_start`` marks a type-2 dimension with one row per validity period.
    """

    name: str
    source: str
    key: str
    surrogate: str
    version_start: str | None = None

    @property
    def grain(self) -> tuple[str, ...]:
        return (self.key,) if self.version_start is None else (self.key, self.version_start)


# Names of the published tables and their keys.
DIM_CUSTOMER = Dimension("dim_customer", "customer_history", "customer_id", "customer_sk", "effective_from")
DIM_ACCOUNT = Dimension("dim_account", "accounts", "account_id", "account_sk")
DIM_BRANCH = Dimension("dim_branch", "branches", "branch_id", "branch_sk")
DIM_DATE = Dimension("dim_date", "dim_date", "date_key", "date_sk")
DIMENSIONS = (DIM_CUSTOMER, DIM_ACCOUNT, DIM_BRANCH, DIM_DATE)
FACT = "fact_transaction"
FACT_COLUMNS = (
    "transaction_id", "transaction_ref", "account_sk", "customer_sk", "branch_sk", "date_sk",
    "transaction_timestamp", "amount", "currency", "transaction_type", "channel",
)


def build_dimension(
    dimension: Dimension,
    source: DataFrame,
    at: datetime | None = None,
    columns: Sequence[str] | None = None,
    from_files: bool = False,
) -> DataFrame:
    """Surrogate key, business columns and stamp.

    Keys are dealt anew on each build, so dimensions and fact are built together.
    """
    # Named and counted once; the new key then orders versions without ties.
    named, rows = named_rows(source, from_files)
    keyed = surrogate_key(named, dimension.grain, dimension.surrogate, rows=rows)
    if dimension.version_start is not None:
        keyed = build_versions(keyed, dimension.key, dimension.version_start, rows=rows, number=dimension.surrogate)
    shown = business_columns(dimension.source) if columns is None else columns
    return stamped(keyed.select(dimension.surrogate, *shown), GOLD_STAMP, at)


def resolve_transactions(
    transactions: DataFrame,
    dim_account: DataFrame,
    dim_date: DataFrame,
    dim_branch: DataFrame,
    dim_customer: DataFrame,
    on_unresolved: str = "keep",
) -> DataFrame:
    """Surrogate keys for each transaction, the owner's as of its calendar day.

    Distinct (account, day) pairs meet the owner's versions in order of time, so
    neither many versions nor many accounts of an owner multiply anything. The
    wide rows then join their pair by equality: a busy account spreads over its
    days. Versions must not overlap, as the dimension's own suite checks.

    ``keep`` leaves unresolved keys NULL for the guard to report, ``drop``
    leaves such rows out.
    """
    if on_unresolved not in ("keep", "drop"):
        raise ValueError(f"on_unresolved must be keep or drop, not {on_unresolved}")
    # Everything depends on the account and the day alone, so pairs are resolved once.
    pairs = transactions.select("account_id", "date_key").distinct()
    dated = dimension_lookup(pairs, dim_date, "date_key", ["date_sk", "full_date"], BROADCAST_BYTES)
    accounts = dim_account.select("account_sk", "account_id", "customer_id", "branch_id")
    with_branch = dimension_lookup(accounts, dim_branch, "branch_id", ["branch_sk"], BROADCAST_BYTES)
    # Written, since finding versions reads the pairs twice and pairs come from a scan of all transactions.
    owned, _ = settle(dated.join(with_branch.drop("branch_id"), "account_id", "left"))
    found = version_as_of(owned, dim_customer, "customer_id", "full_date", ["customer_sk", "effective_to"], how="left")
    holds = F.col("customer_sk").isNotNull() & (F.col("effective_to").isNull() | (F.col("full_date") <= F.col("effective_to")))
    keys = [F.when(holds, F.col(c)).alias(c) for c in ("account_sk", "branch_sk", "customer_sk")]
    found = found.select(F.col("account_id").alias("__account"), F.col("date_key").alias("__date"), "date_sk", "full_date", *keys)
    same = F.col("account_id").eqNullSafe(F.col("__account")) & F.col("date_key").eqNullSafe(F.col("__date"))
    resolved = transactions.join(found, same, "left").drop("__account", "__date")
    return resolved if on_unresolved == "keep" else resolved.filter(F.col("customer_sk").isNotNull())


def build_fact(resolved: DataFrame, at: datetime | None = None) -> DataFrame:
    return stamped(resolved.select(*FACT_COLUMNS), GOLD_STAMP, at)
