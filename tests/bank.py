"""A small bank with one row for every kind of defect."""

from datetime import date, datetime
from decimal import Decimal

from layerkit.functions import audited
from layerkit.schemas import contract

AT = datetime(2025, 6, 1)


def transactions():
    def row(number, account, on, amount, currency="USD", second=0):
        d = date.fromisoformat(on)
        ts = datetime(d.year, d.month, d.day, 10, 0, second)
        value = None if amount is None else Decimal(amount)
        return (number, f"TXN-{number:06d}", account, d.year * 10000 + d.month * 100 + d.day, ts, value, currency, "FEE", "ATM")

    return [
        row(1, 10, "2025-01-05", "10.00"),
        row(2, 11, "2025-02-01", "0.00", "AZN"),  # zero is valid; first day of a version
        row(3, 10, "2025-03-01", "12.50", "EUR"),
        row(4, 10, "2025-03-01", "7.00"),
        row(4, 10, "2025-03-01", "7.00", second=5),
        row(5, 12, "2025-01-31", "99.99"),  # last day of a version
        row(6, 10, "2025-04-01", None),
        row(7, 999, "2025-04-01", "5.00"),
        row(8, 11, "2025-04-01", "-50.00", "XXX"),
    ]


ROWS = {
    "branches": [(1, "A Branch", "BR001", "A", "R", "Azerbaijan", date(2023, 1, 1))],
    "dim_date": [
        (d.year * 10000 + d.month * 100 + d.day, d, d.day, d.month, d.strftime("%B"), (d.month - 1) // 3 + 1, d.year,
         d.isoweekday(), d.strftime("%A"), d.isoweekday() > 5)
        for d in (date.fromordinal(o) for o in range(date(2025, 1, 1).toordinal(), date(2025, 6, 1).toordinal()))
    ],
    "customers": [
        (c, "F", "L", date(1990, 1, 1), f"c{c}@x", "1", "AZ", "RETAIL", 500, 480, "0" * 16) for c in (1, 2)
    ],
    # Customer 2: a gap, wrong flags and a wrong end, all recomputed.
    "customer_history": [
        (1, date(2024, 1, 1), None, True, "F", "L", "c1@x", "1", "RETAIL", 500, "AZ"),
        (2, date(2024, 1, 1), date(2024, 12, 31), True, "F", "L", "c2@x", "1", "RETAIL", 500, "AZ"),
        (2, date(2025, 2, 1), date(2025, 2, 2), False, "F", "L", "c2@x", "1", "PRIVATE", 700, "AZ"),
    ],
    "accounts": [
        (10, 1, 1, "CHECKING", "ACTIVE", "USD", date(2024, 1, 1)),
        (11, 2, 1, "SAVINGS", "ACTIVE", "AZN", date(2024, 1, 1)),
        (12, 2, 1, "LOAN", "CLOSED", "EUR", date(2024, 1, 1)),
    ],
    "account_customer_bridge": [(10, 1, Decimal("0.60"), True), (10, 2, Decimal("0.40"), False)],
    "transactions": transactions(),
    "account_balance_snapshot": [(10, 20250105, Decimal("100.00"), "USD")],
    "loan_lifecycle": [(1, 12, Decimal("5000.00"), "APPLIED", date(2025, 1, 1), None, None, None)],
}


def table(spark, name, rows=None):
    schema = contract(name, audit=False)
    df = spark.createDataFrame(ROWS[name] if rows is None else rows, schema)
    return audited(df, "run-1", "core", AT)


def reader(spark_, name):
    return table(spark_, name)
