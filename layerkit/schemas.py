"""Table contracts: columns, keys, foreign keys and coded values."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql.types import StructType

# Names, types, codes and formats that stored data depends on.
AUDIT_DDL = "load_run_id STRING NOT NULL, source_system STRING NOT NULL, processed_at TIMESTAMP NOT NULL"
TABLE_DDL = {
    "branches": """branch_id INT NOT NULL, branch_name STRING NOT NULL, branch_code STRING NOT NULL,
        city STRING NOT NULL, region STRING NOT NULL, country STRING NOT NULL, opening_date DATE NOT NULL""",
    "dim_date": """date_key INT NOT NULL, full_date DATE NOT NULL, day SMALLINT NOT NULL,
        month SMALLINT NOT NULL, month_name STRING NOT NULL, quarter SMALLINT NOT NULL,
        year SMALLINT NOT NULL, day_of_week SMALLINT NOT NULL, day_name STRING NOT NULL,
        is_weekend BOOLEAN NOT NULL""",
    "customers": """customer_id INT NOT NULL, first_name STRING NOT NULL, last_name STRING NOT NULL,
        date_of_birth DATE NOT NULL, email STRING NOT NULL, phone_number STRING NOT NULL,
        address_country STRING NOT NULL, customer_segment STRING NOT NULL,
        credit_rating_current SMALLINT NOT NULL, credit_rating_previous SMALLINT NOT NULL,
        change_hash STRING NOT NULL""",
    "customer_history": """customer_id INT NOT NULL, effective_from DATE NOT NULL, effective_to DATE,
        is_current BOOLEAN NOT NULL, first_name STRING NOT NULL, last_name STRING NOT NULL,
        email STRING NOT NULL, phone_number STRING NOT NULL, customer_segment STRING NOT NULL,
        credit_rating SMALLINT NOT NULL, address_country STRING NOT NULL""",
    "accounts": """account_id INT NOT NULL, customer_id INT NOT NULL, branch_id INT NOT NULL,
        account_type STRING NOT NULL, account_status STRING NOT NULL, currency STRING NOT NULL,
        open_date DATE NOT NULL""",
    "account_customer_bridge": """account_id INT NOT NULL, customer_id INT NOT NULL,
        allocation_weight DECIMAL(4,2) NOT NULL, is_primary_owner BOOLEAN NOT NULL""",
    "transactions": """transaction_id INT NOT NULL, transaction_ref STRING NOT NULL,
        account_id INT NOT NULL, date_key INT NOT NULL, transaction_timestamp TIMESTAMP NOT NULL,
        amount DECIMAL(12,2), currency STRING NOT NULL, transaction_type STRING NOT NULL,
        channel STRING NOT NULL""",
    "account_balance_snapshot": """account_id INT NOT NULL, snapshot_date_key INT NOT NULL,
        closing_balance DECIMAL(14,2) NOT NULL, currency STRING NOT NULL""",
    "loan_lifecycle": """loan_id INT NOT NULL, account_id INT NOT NULL, loan_amount DECIMAL(14,2) NOT NULL,
        loan_status STRING NOT NULL, application_date DATE NOT NULL, approval_date DATE,
        disbursement_date DATE, closure_date DATE""",
}
PRIMARY_KEYS = {
    "branches": ("branch_id",),
    "dim_date": ("date_key",),
    "customers": ("customer_id",),
    "customer_history": ("customer_id", "effective_from"),
    "accounts": ("account_id",),
    "account_customer_bridge": ("account_id", "customer_id"),
    "account_balance_snapshot": ("account_id", "snapshot_date_key"),
    "loan_lifecycle": ("loan_id",),
}
ALLOWED_CURRENCIES = ("AZN", "USD", "EUR")
DUPLICATE = "DUPLICATE_TRANSACTION_ID"
NULL_AMOUNT = "NULL_AMOUNT"
ORPHAN_ACCOUNT = "ORPHAN_ACCOUNT"
NEGATIVE_AMOUNT = "NEGATIVE_AMOUNT"
INVALID_CURRENCY = "INVALID_CURRENCY"
REASON_SEPARATOR = "|"
REASON_COLUMN = "data_quality_reason"
AUDIT_COLUMNS = ("load_run_id", "source_system", "processed_at")
BRONZE_COLUMNS = ("bronze_ingested_at", "bronze_source_table")
SILVER_STAMP = "silver_processed_at"
QUARANTINE_STAMP = "quarantined_at"
GOLD_STAMP = "gold_processed_at"
YEAR_COLUMN = "transaction_year"
OPEN_END = "9999-12-31"
DATE_FORMAT = "yyyy-MM-dd"
SECOND_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
TIMESTAMP_FORMAT = f"{SECOND_FORMAT}[.SSSSSS][.SSS]'Z'"


@dataclass(frozen=True)
class ForeignKey:
    """``child.column`` must exist in ``parent.parent_column``."""

    child: str
    column: str
    parent: str
    parent_column: str

    @property
    def label(self) -> str:
        return f"{self.child}.{self.column} -> {self.parent}.{self.parent_column}"


FOREIGN_KEYS = (
    ForeignKey("accounts", "customer_id", "customers", "customer_id"),
    ForeignKey("accounts", "branch_id", "branches", "branch_id"),
    ForeignKey("customer_history", "customer_id", "customers", "customer_id"),
    ForeignKey("account_customer_bridge", "account_id", "accounts", "account_id"),
    ForeignKey("account_customer_bridge", "customer_id", "customers", "customer_id"),
    ForeignKey("transactions", "account_id", "accounts", "account_id"),
    ForeignKey("transactions", "date_key", "dim_date", "date_key"),
    ForeignKey("account_balance_snapshot", "account_id", "accounts", "account_id"),
    ForeignKey("account_balance_snapshot", "snapshot_date_key", "dim_date", "date_key"),
    ForeignKey("loan_lifecycle", "account_id", "accounts", "account_id"),
)

TABLES = tuple(TABLE_DDL)


def contract(table: str, audit: bool = True) -> StructType:
    """Declared schema of a source table, with or without its audit columns."""
    ddl = TABLE_DDL[table]
    return StructType.fromDDL(f"{ddl}, {AUDIT_DDL}" if audit else ddl)


def _columns(table: str) -> list[list[str]]:
    return [column.split() for column in re.split(r",\s+", TABLE_DDL[table])]


def business_columns(table: str) -> list[str]:
    """Declared column names without the audit columns."""
    return [column[0] for column in _columns(table)]


def declared_types(table: str) -> list[tuple[str, str]]:
    """Business columns with the names of their types, in lower case."""
    return [(column[0], column[1].lower()) for column in _columns(table)]


def required_values(table: str) -> list[str]:
    """Business columns declared NOT NULL."""
    return [column[0] for column in _columns(table) if column[-2:] == ["NOT", "NULL"]]
