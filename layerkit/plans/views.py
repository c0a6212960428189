"""Banking-shaped views over the TPC-H-like test tables, in Spark and in SQL.

The test tables are clean, so defects are derived from their values. Each view
has a SQL twin with the same columns; the twins are the inputs of the oracle.
"""

from __future__ import annotations

import re
from datetime import datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerkit.functions import audited, change_hash, coded, date_key
from layerkit.operators.calendar import calendar, even_schedule
from layerkit.operators.rowid import ROW_ID, spread, with_row_id

LINE_ORDER = ("transaction_timestamp", "part_id", "account_id", "amount", "currency")
LINE_CURRENCIES = ("A", "N")
SNAPSHOTS = 4
RUN_ID = "run-1"
SYSTEM = "core"
PROCESSED_AT = datetime(2002, 1, 1)


def money(value: Column, digits: int = 12) -> Column:
    return value.cast(f"decimal({digits},2)")


def shifted(day: str, days: Column) -> Column:
    return F.date_add(F.lit(day).cast("date"), days.cast("int"))


def _email(key: Column) -> Column:
    return F.concat(F.lit("c"), key.cast("string"), F.lit("@example.com"))


def _rating(key: Column) -> Column:
    return (key % 551 + 300).cast("short")


class Views:
    """Lazily built views of one data directory."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def lines(self) -> DataFrame:
        """Dirty transactions: repeated ids, NULL and negative amounts, odd currencies."""
        identity = F.col("l_orderkey") * 10 + F.col("l_linenumber")
        amount = (
            F.when(F.col("l_quantity") == 13, F.lit(None))
            .when(F.col("l_discount") == 0.0, -F.col("l_extendedprice"))
            .otherwise(F.col("l_extendedprice"))
        )
        return self.table("lineitem").select(
            identity.alias("transaction_id"),
            F.col("l_suppkey").alias("account_id"),
            date_key(F.col("l_shipdate")).alias("date_key"),
            F.col("l_shipdate").alias("transaction_timestamp"),
            amount.alias("amount"),
            F.col("l_returnflag").alias("currency"),
            F.col("l_partkey").alias("part_id"),
        )

    @cached_property
    def known_accounts(self) -> DataFrame:
        return self.table("supplier").filter("s_acctbal >= 0").select(F.col("s_suppkey").alias("account_id"))

    @cached_property
    def history(self) -> DataFrame:
        """One version per customer and order day."""
        return self.table("orders").groupBy(
            F.col("o_custkey").alias("customer_id"), F.to_date("o_orderdate").alias("effective_from")
        ).agg(F.max("o_orderpriority").alias("customer_segment"))

    @cached_property
    def flawed_history(self) -> DataFrame:
        """The same versions with source ends and flags that contradict each other."""
        low = F.col("customer_segment") == "5-LOW"
        return self.history.withColumns(
            {
                "effective_to": F.when(low, F.lit(None).cast("date")).otherwise(F.date_add("effective_from", 200)),
                "is_current": F.col("customer_segment") == "1-URGENT",
            }
        )

    @cached_property
    def shipments(self) -> DataFrame:
        """Lines with the customer of their order."""
        orders = self.table("orders").select("o_orderkey", F.col("o_custkey").alias("customer_id"))
        lines = spread(self.table("lineitem")).select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.to_date("l_shipdate").alias("ship_day")
        )
        return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).drop("o_orderkey")

    @cached_property
    def bridge_shares(self) -> DataFrame:
        """Each supplier's share of its order's quantity in whole hundredths."""
        quantity = F.col("l_quantity").cast("long")
        lines = self.table("lineitem").select(
            F.col("l_orderkey").alias("account_id"), F.col("l_suppkey").alias("customer_id"), quantity.alias("quantity")
        )
        totals = lines.groupBy("account_id").agg(F.sum("quantity").alias("total"))
        cents = F.call_function("div", F.col("quantity") * 200 + F.col("total"), F.col("total") * 2)
        return lines.join(totals, "account_id").select(
            "account_id", "customer_id", (cents.cast("decimal(10,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(4,2)").alias("allocation_weight")
        )

    # The nine source tables.

    @cached_property
    def span(self) -> DataFrame:
        days = self.table("orders").select(F.to_date("o_orderdate").alias("day")).unionByName(
            self.table("lineitem").select(F.to_date("l_shipdate").alias("day"))
        )
        return days.agg(F.min("day").alias("first"), F.max("day").alias("last"))

    @cached_property
    def dim_date(self) -> DataFrame:
        return calendar(self.span, F.col("first"), F.col("last"))

    @cached_property
    def branches(self) -> DataFrame:
        region = self.table("region").withColumnRenamed("r_regionkey", "n_regionkey")
        key = F.col("n_nationkey")
        return self.table("nation").join(region, "n_regionkey").select(
            key.alias("branch_id"),
            F.concat("n_name", F.lit(" Branch")).alias("branch_name"),
            coded("BR", 3, key).alias("branch_code"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("region"),
            F.col("n_name").alias("country"),
            shifted("1994-01-01", key).alias("opening_date"),
        )

    @cached_property
    def customers(self) -> DataFrame:
        key = F.col("c_custkey")
        rating = _rating(key)
        phone = coded("", 10, key)
        return self.table("customer").select(
            key.alias("customer_id"),
            F.lit("Customer").alias("first_name"),
            F.col("c_name").alias("last_name"),
            shifted("1950-01-01", key % 15000).alias("date_of_birth"),
            _email(key).alias("email"),
            phone.alias("phone_number"),
            coded("N", 2, F.col("c_nationkey")).alias("address_country"),
            F.col("c_mktsegment").alias("customer_segment"),
            rating.alias("credit_rating_current"),
            F.greatest(rating - F.lit(20).cast("short"), F.lit(300).cast("short")).cast("short").alias("credit_rating_previous"),
            change_hash(F.col("c_mktsegment"), _email(key), phone, rating).alias("change_hash"),
        )

    @cached_property
    def customer_history(self) -> DataFrame:
        """Contiguous periods; the last one of a customer is open and current."""
        key = F.col("customer_id")
        following = F.lead("effective_from").over(Window.partitionBy("customer_id").orderBy("effective_from"))
        return self.history.select(
            key,
            "effective_from",
            F.date_sub(following, 1).alias("effective_to"),
            following.isNull().alias("is_current"),
            F.lit("Customer").alias("first_name"),
            coded("Customer#", 9, key).alias("last_name"),
            _email(key).alias("email"),
            coded("", 10, key).alias("phone_number"),
            "customer_segment",
            _rating(key).alias("credit_rating"),
            F.lit("N").alias("address_country"),
        )

    @cached_property
    def accounts(self) -> DataFrame:
        """One account for each customer that has ordered."""
        key = F.col("c_custkey")
        ordered = self.table("orders").select(F.col("o_custkey").alias("c_custkey"))
        kind = F.when(key % 4 == 0, "CHECKING").when(key % 4 == 1, "SAVINGS").when(key % 4 == 2, "BUSINESS")
        currency = F.when(key % 3 == 0, "AZN").when(key % 3 == 1, "USD")
        return self.table("customer").join(ordered, "c_custkey", "left_semi").select(
            key.alias("account_id"),
            key.alias("customer_id"),
            F.col("c_nationkey").alias("branch_id"),
            kind.otherwise("LOAN").alias("account_type"),
            F.lit("ACTIVE").alias("account_status"),
            currency.otherwise("EUR").alias("currency"),
            shifted("1994-06-01", key % 200).alias("open_date"),
        )

    @cached_property
    def account_customer_bridge(self) -> DataFrame:
        """Every eighth account is shared with the next customer, the others have one owner."""
        part = lambda owner, weight, primary: F.struct(
            owner.alias("customer_id"), money(F.lit(weight), 4).alias("allocation_weight"), F.lit(primary).alias("is_primary_owner")
        )
        owner = F.col("account_id")
        both = F.array(part(owner, "0.60", True), part(owner + 1, "0.40", False))
        owners = F.when(owner % 8 == 0, both).otherwise(F.array(part(owner, "1.00", True)))
        return self.accounts.select("account_id", F.inline(owners))

    @cached_property
    def transactions(self) -> DataFrame:
        """Order lines booked on the customer's account, with defects."""
        return self._booked(spread(self.table("lineitem")))

    @cached_property
    def named_transactions(self) -> DataFrame:
        """The same with audit columns and the stored position of each line.

        A line meets one order, so its position still names one row.
        """
        lines = spread(with_row_id(self.table("lineitem"), from_files=True))
        return audited(self._booked(lines, ROW_ID), RUN_ID, SYSTEM, PROCESSED_AT)

    def _booked(self, lines: DataFrame, *keep: str) -> DataFrame:
        amount = (
            F.when(F.col("l_quantity") == 13, F.lit(None))
            .when(F.col("l_discount") == 0.0, -F.col("l_extendedprice"))
            .otherwise(F.col("l_extendedprice"))
        )
        currency = (
            F.when(F.col("l_quantity") == 50, "XXX").when(F.col("l_returnflag") == "A", "AZN").when(F.col("l_returnflag") == "N", "USD")
        )
        # What depends on the line alone is settled before the join, so fewer and smaller values are shuffled.
        booked = lines.select(
            "l_orderkey",
            "l_linenumber",
            (F.col("l_partkey") * 10_000_000 + F.col("l_suppkey")).alias("reference"),
            ((F.col("l_tax") == 0.08) & (F.col("l_linenumber") == 7)).alias("lost"),
            money(amount).alias("amount"),
            currency.otherwise("EUR").alias("currency"),
            (F.col("l_linestatus") == "F").alias("paid"),
            *keep,
        )
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        joined = booked.join(orders, booked["l_orderkey"] == orders["o_orderkey"])
        return joined.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
            coded("TXN-", 6, F.col("reference")).alias("transaction_ref"),
            F.when(F.col("lost"), -1 - F.col("o_custkey")).otherwise(F.col("o_custkey")).alias("account_id"),
            date_key(F.col("o_orderdate")).alias("date_key"),
            F.col("o_orderdate").alias("transaction_timestamp"),
            "amount",
            "currency",
            F.when(F.col("paid"), "PAYMENT").otherwise("TRANSFER").alias("transaction_type"),
            F.when(F.col("l_linenumber") < 4, "ONLINE").otherwise("BRANCH").alias("channel"),
            *keep,
        )

    @cached_property
    def account_balance_snapshot(self) -> DataFrame:
        # The span is one row, so every account meets the same bounds.
        first, last = self.span.first()
        dated = even_schedule(self.accounts, "open_date", F.lit(first), F.lit(last), SNAPSHOTS, "snapshot_day")
        return dated.select(
            "account_id",
            date_key(F.col("snapshot_day")).alias("snapshot_date_key"),
            money(F.col("account_id") * 10, 14).alias("closing_balance"),
            "currency",
        )

    @cached_property
    def loan_lifecycle(self) -> DataFrame:
        opened = F.to_date("o_orderdate")
        status = F.col("o_orderstatus")
        return self.table("orders").select(
            F.col("o_orderkey").alias("loan_id"),
            F.col("o_custkey").alias("account_id"),
            money(F.col("o_totalprice"), 14).alias("loan_amount"),
            F.when(status == "F", "DISBURSED").when(status == "O", "APPROVED").otherwise("APPLIED").alias("loan_status"),
            opened.alias("application_date"),
            F.when(status.isin("F", "O"), F.date_add(opened, 3)).alias("approval_date"),
            F.when(status == "F", F.date_add(opened, 8)).alias("disbursement_date"),
            F.lit(None).cast("date").alias("closure_date"),
        )

    def source(self, name: str) -> DataFrame:
        """A source table with its audit columns."""
        return audited(getattr(self, name), RUN_ID, SYSTEM, PROCESSED_AT)


_AMOUNT = """CASE WHEN l_quantity = 13 THEN NULL WHEN l_discount = 0.0 THEN -l_extendedprice
    ELSE l_extendedprice END"""

TWINS = {
    "lines": f"""SELECT l_orderkey * 10 + l_linenumber AS transaction_id, l_suppkey AS account_id,
        CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INTEGER) AS date_key,
        l_shipdate AS transaction_timestamp, {_AMOUNT} AS amount, l_returnflag AS currency,
        l_partkey AS part_id FROM lineitem""",
    "known_accounts": "SELECT s_suppkey AS account_id FROM supplier WHERE s_acctbal >= 0",
    "ranked": """SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY transaction_timestamp
        NULLS FIRST, part_id NULLS FIRST, account_id NULLS FIRST, amount NULLS FIRST, currency NULLS FIRST)
        AS dup_rank FROM lines""",
    "judged": """SELECT transaction_id, account_id, date_key, transaction_timestamp, amount, currency, part_id,
        concat_ws('|', CASE WHEN dup_rank > 1 THEN 'DUPLICATE_TRANSACTION_ID' END,
        CASE WHEN amount IS NULL THEN 'NULL_AMOUNT' END,
        CASE WHEN account_id NOT IN (SELECT account_id FROM known_accounts) THEN 'ORPHAN_ACCOUNT' END,
        CASE WHEN amount < 0 THEN 'NEGATIVE_AMOUNT' END,
        CASE WHEN currency NOT IN ('A', 'N') THEN 'INVALID_CURRENCY' END) AS data_quality_reason FROM ranked""",
    "history": """SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS effective_from,
        max(o_orderpriority) AS customer_segment FROM orders GROUP BY 1, 2""",
    "flawed_history": """SELECT *, CASE WHEN customer_segment = '5-LOW' THEN NULL ELSE effective_from + 200 END
        AS effective_to, customer_segment = '1-URGENT' AS is_current FROM history""",
    "versions": """SELECT customer_id, effective_from, customer_segment,
        lead(effective_from) OVER (PARTITION BY customer_id ORDER BY effective_from) - 1 AS effective_to,
        lead(effective_from) OVER (PARTITION BY customer_id ORDER BY effective_from) IS NULL AS is_current
        FROM history""",
    "shipments": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS ship_day,
        o_custkey AS customer_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "span": """SELECT min(d) AS first_day, max(d) AS last_day FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders
        UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem) AS all_days""",
    "days": """SELECT CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS d FROM span""",
    "dim_date": """SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, d AS full_date,
        CAST(day(d) AS SMALLINT) AS day, CAST(month(d) AS SMALLINT) AS month, monthname(d) AS month_name,
        CAST(quarter(d) AS SMALLINT) AS quarter, CAST(year(d) AS SMALLINT) AS year,
        CAST(isodow(d) AS SMALLINT) AS day_of_week, dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend FROM days""",
    "branches": """SELECT n_nationkey AS branch_id, n_name || ' Branch' AS branch_name,
        printf('BR%03d', n_nationkey) AS branch_code, n_name AS city, r_name AS region, n_name AS country,
        DATE '1994-01-01' + CAST(n_nationkey AS INTEGER) AS opening_date
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "customers": """SELECT c_custkey AS customer_id, 'Customer' AS first_name, c_name AS last_name,
        DATE '1950-01-01' + CAST(c_custkey % 15000 AS INTEGER) AS date_of_birth,
        'c' || c_custkey || '@example.com' AS email, printf('%010d', c_custkey) AS phone_number,
        printf('N%02d', c_nationkey) AS address_country, c_mktsegment AS customer_segment,
        CAST(c_custkey % 551 + 300 AS SMALLINT) AS credit_rating_current,
        CAST(greatest(c_custkey % 551 + 280, 300) AS SMALLINT) AS credit_rating_previous,
        substr(sha256(concat_ws('|', c_mktsegment, 'c' || c_custkey || '@example.com',
            printf('%010d', c_custkey), CAST(c_custkey % 551 + 300 AS VARCHAR))), 1, 16) AS change_hash FROM customer""",
    "customer_history": """SELECT customer_id, effective_from, effective_to, is_current,
        'Customer' AS first_name, printf('Customer#%09d', customer_id) AS last_name,
        'c' || customer_id || '@example.com' AS email, printf('%010d', customer_id) AS phone_number,
        customer_segment, CAST(customer_id % 551 + 300 AS SMALLINT) AS credit_rating,
        'N' AS address_country FROM versions""",
    "accounts": """SELECT c_custkey AS account_id, c_custkey AS customer_id, c_nationkey AS branch_id,
        CASE c_custkey % 4 WHEN 0 THEN 'CHECKING' WHEN 1 THEN 'SAVINGS' WHEN 2 THEN 'BUSINESS' ELSE 'LOAN' END
        AS account_type, 'ACTIVE' AS account_status,
        CASE c_custkey % 3 WHEN 0 THEN 'AZN' WHEN 1 THEN 'USD' ELSE 'EUR' END AS currency,
        DATE '1994-06-01' + CAST(c_custkey % 200 AS INTEGER) AS open_date
        FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)""",
    "account_customer_bridge": """SELECT account_id, account_id AS customer_id,
        CAST(0.60 AS DECIMAL(4,2)) AS allocation_weight, TRUE AS is_primary_owner FROM accounts WHERE account_id % 8 = 0
        UNION ALL SELECT account_id, account_id + 1, CAST(0.40 AS DECIMAL(4,2)), FALSE FROM accounts
        WHERE account_id % 8 = 0 UNION ALL SELECT account_id, account_id, CAST(1.00 AS DECIMAL(4,2)), TRUE FROM accounts
        WHERE account_id % 8 <> 0""",
    "transactions": f"""SELECT l_orderkey * 10 + l_linenumber AS transaction_id,
        printf('TXN-%06d', l_partkey * 10000000 + l_suppkey) AS transaction_ref,
        CASE WHEN l_tax = 0.08 AND l_linenumber = 7 THEN -1 - o_custkey ELSE o_custkey END AS account_id,
        CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER) AS date_key,
        o_orderdate AS transaction_timestamp, CAST({_AMOUNT} AS DECIMAL(12,2)) AS amount,
        CASE WHEN l_quantity = 50 THEN 'XXX' WHEN l_returnflag = 'A' THEN 'AZN' WHEN l_returnflag = 'N' THEN 'USD'
            ELSE 'EUR' END AS currency,
        CASE WHEN l_linestatus = 'F' THEN 'PAYMENT' ELSE 'TRANSFER' END AS transaction_type,
        CASE WHEN l_linenumber < 4 THEN 'ONLINE' ELSE 'BRANCH' END AS channel
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "schedule": f"""SELECT account_id, currency, greatest(open_date, first_day) AS start_day,
        date_diff('day', greatest(open_date, first_day), last_day) + 1 AS n_days, step
        FROM accounts, span, (SELECT unnest(generate_series(0, {SNAPSHOTS - 1})) AS step) AS steps""",
    "snapshot_days": f"""SELECT account_id, currency,
        start_day + CAST((step * (n_days - 1)) // {SNAPSHOTS - 1} AS INTEGER) AS snapshot_day
        FROM schedule WHERE n_days >= {SNAPSHOTS}""",
    "account_balance_snapshot": """SELECT account_id, CAST(year(snapshot_day) * 10000 + month(snapshot_day) * 100
        + day(snapshot_day) AS INTEGER) AS snapshot_date_key, CAST(account_id * 10 AS DECIMAL(14,2)) AS closing_balance,
        currency FROM snapshot_days""",
    "loan_lifecycle": """SELECT o_orderkey AS loan_id, o_custkey AS account_id,
        CAST(o_totalprice AS DECIMAL(14,2)) AS loan_amount,
        CASE o_orderstatus WHEN 'F' THEN 'DISBURSED' WHEN 'O' THEN 'APPROVED' ELSE 'APPLIED' END AS loan_status,
        CAST(o_orderdate AS DATE) AS application_date,
        CASE WHEN o_orderstatus IN ('F', 'O') THEN CAST(o_orderdate AS DATE) + 3 END AS approval_date,
        CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 8 END AS disbursement_date,
        CAST(NULL AS DATE) AS closure_date FROM orders""",
    "booked": """SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY transaction_timestamp NULLS FIRST,
        transaction_ref NULLS FIRST, amount NULLS FIRST, currency NULLS FIRST, transaction_type NULLS FIRST)
        AS dup_rank FROM transactions""",
    "booked_judged": """SELECT *, concat_ws('|', CASE WHEN dup_rank > 1 THEN 'DUPLICATE_TRANSACTION_ID' END,
        CASE WHEN amount IS NULL THEN 'NULL_AMOUNT' END,
        CASE WHEN account_id NOT IN (SELECT account_id FROM accounts) THEN 'ORPHAN_ACCOUNT' END,
        CASE WHEN amount < 0 THEN 'NEGATIVE_AMOUNT' END,
        CASE WHEN currency NOT IN ('AZN', 'USD', 'EUR') THEN 'INVALID_CURRENCY' END) AS data_quality_reason FROM booked""",
    "booked_valid": "SELECT * FROM booked_judged WHERE data_quality_reason = ''",
    "dim_customer": """SELECT row_number() OVER (ORDER BY customer_id, effective_from) AS customer_sk, customer_id,
        effective_from, effective_to, is_current, customer_segment FROM versions""",
    "dim_account": "SELECT row_number() OVER (ORDER BY account_id) AS account_sk, * FROM accounts",
    "dim_branch": "SELECT row_number() OVER (ORDER BY branch_id) AS branch_sk, * FROM branches",
    "keyed_date": "SELECT row_number() OVER (ORDER BY date_key) AS date_sk, * FROM dim_date",
    "fact": """SELECT t.transaction_id, t.transaction_ref, a.account_sk, c.customer_sk, b.branch_sk, d.date_sk,
        t.transaction_timestamp, t.amount, t.currency, t.transaction_type, t.channel
        FROM booked_valid t JOIN dim_account a ON t.account_id = a.account_id
        JOIN keyed_date d ON t.date_key = d.date_key JOIN dim_branch b ON a.branch_id = b.branch_id
        JOIN dim_customer c ON a.customer_id = c.customer_id AND d.full_date >= c.effective_from
            AND (c.effective_to IS NULL OR d.full_date <= c.effective_to)""",
    "bridge_shares": """SELECT l_orderkey AS account_id, CAST((CAST(l_quantity AS BIGINT) * 200 + total) // (total * 2)
        AS BIGINT) AS cents FROM lineitem JOIN (SELECT l_orderkey AS k, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT)
        AS total FROM lineitem GROUP BY 1) AS totals ON l_orderkey = k""",
}


def oracle(body: str) -> str:
    """The body preceded by every twin it needs, directly or through others."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in set(re.findall(r"\b(?:FROM|JOIN)\s+(\w+)|,\s(span)\b", text)):
            twin = name[0] or name[1]
            if twin in TWINS and twin not in needed:
                needed.add(twin)
                visit(TWINS[twin])

    visit(body)
    clauses = [f"{name} AS ({text})" for name, text in TWINS.items() if name in needed]
    return f"WITH {', '.join(clauses)} {body}" if clauses else body
