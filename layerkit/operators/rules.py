"""Data-quality rules as data, and their one-pass evaluation.

Rules that look beyond their own row work by exception. The offending keys are
found from the key columns alone, with map-side combining so a hot key
collapses before it is shuffled. The wide rows are then marked by joining that
normally small set, which is broadcast when it measures small. Of a larger set a
filter is broadcast: only the keys and numbers of rows that may offend are
shuffled, and what they find comes back to the wide rows as one broadcast bit a
row. Copies are shuffled once, to find the first of each key that the filter
lets pass: the firsts are marked, and all others that pass are copies. Where
even the bits are too many, rows that may offend are shuffled whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerkit.functions import join_reasons
from layerkit.operators.marks import Marks
from layerkit.operators.membership import Filter
from layerkit.operators.rowid import ROW_ID, in_place, spread, with_row_id
from layerkit.schemas import REASON_COLUMN, REASON_SEPARATOR
from layerkit.session import concurrently
from layerkit.sources.scratch import Side, settle, sized


@dataclass(frozen=True)
class Offenders:
    """The keys that break a rule, under names of their own, and the columns that are compared with them."""

    side: Side
    pairs: tuple[tuple[str, str], ...]  # (column of the rows, column of the keys)
    filter: Filter | None = None  # of the keys, where finding them made one
    first: str | None = None  # the first row of each key; with a filter, of each key that it lets pass
    filled: bool = False  # no key is NULL

    def join(self, df: DataFrame) -> DataFrame:
        """Every row, next to its offending key if it has one; NULL equals NULL.

        Where no key is NULL plain equality says the same, and the table of a key
        that is a number takes half the memory.
        """
        same = F.lit(True)
        for mine, theirs in self.pairs:
            key = self.side.df[theirs]
            same = same & (df[mine] == key if self.filled else df[mine].eqNullSafe(key))
        return df.join(self.side.df, same, "left")

    def flag(self, df: DataFrame, name: str) -> DataFrame:
        """Whether a row may have an offending key, by a broadcast filter over the keys."""
        made = self.filter or Filter.of(self.side.df, [theirs for _, theirs in self.pairs], self.side.rows)
        return made.flag(df, [mine for mine, _ in self.pairs], name)

    def marks(self, df: DataFrame, rule: Rule, tag: str) -> Marks | Copies | None:
        """Exactly the rows that break the rule, by number; only key columns and numbers are shuffled."""
        if self.first is not None and self.filter is not None:
            firsts = Marks.of(self.side.df.select(F.col(self.first).alias(ROW_ID)))
            return None if firsts is None else Copies(self, firsts)
        narrow = df.select(*dict.fromkeys(mine for mine, _ in self.pairs), ROW_ID)
        suspects = self.flag(narrow, f"{tag}_maybe").filter(f"{tag}_maybe")
        return Marks.of(self.join(suspects).filter(rule.broken(tag)).select(ROW_ID))


@dataclass(frozen=True)
class Copies:
    """All rows that the filter of repeated keys lets pass, but the first of each key.

    A key that comes once and passes all the same is its own first row, so this
    is exact, and no row meets its key again.
    """

    offenders: Offenders
    firsts: Marks

    def flag(self, df: DataFrame, name: str) -> DataFrame:
        """``df``, which has row ids, with a boolean: whether a row is such a copy."""
        maybe, kept = f"{name}_maybe", f"{name}_kept"
        told = self.firsts.flag(self.offenders.flag(df, maybe), kept)
        return told.select(*df.columns, (F.col(maybe) & ~F.col(kept)).alias(name))


@dataclass(frozen=True)
class RowRule:
    """Breaks when ``bad`` is true; a NULL result does not break it."""

    reason: str
    bad: Column

    def find(self, df: DataFrame, tag: str) -> Offenders | None:
        return None

    def broken(self, tag: str) -> Column:
        return self.bad


@dataclass(frozen=True)
class FirstCopyRule:
    """Every row of a key but the first in ``order_by`` breaks it.

    NULL keys form one group. Rows that tie on the whole order keep exactly one
    of them, chosen by storage position.
    """

    reason: str
    keys: tuple[str, ...]
    order_by: tuple[str, ...]

    def find(self, df: DataFrame, tag: str) -> Offenders | None:
        """Repeated keys, each with its first row.

        Keys alone are counted first, which hashes them; only rows of repeated
        keys are put in order.
        """
        names = [f"{tag}_{k}" for k in self.keys]
        keys = [F.col(k).alias(n) for k, n in zip(self.keys, names)]
        counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        again = [f"{n}_again" for n in names]
        repeated = sized(counted.select(*[F.col(n).alias(a) for n, a in zip(names, again)]))
        rows = df.select(*keys, F.struct(*self.order_by, F.col(ROW_ID).alias("row")).alias("at"))
        made = None if repeated.small else Filter.of(repeated.df, again, repeated.rows)
        if made is None:
            same = F.lit(True)
            for n, a in zip(names, again):
                same = same & F.col(n).eqNullSafe(F.col(a))
            rows = rows.join(repeated.df, same, "left_semi")
        else:
            # A key that comes once and passes all the same is its own first row, which breaks nothing.
            rows = made.flag(rows, names, "maybe").filter("maybe")
        at = f"{tag}_row"
        first = rows.groupBy(*names).agg(F.min("at").alias("first")).select(*names, F.col("first.row").alias(at))
        return Offenders(sized(first), tuple(zip(self.keys, names)), made, at)

    def broken(self, tag: str) -> Column:
        return F.col(f"{tag}_row") != F.col(ROW_ID)


@dataclass(frozen=True)
class KnownKeyRule:
    """A non-NULL ``column`` must occur in ``reference_column``."""

    reason: str
    column: str
    reference: DataFrame
    reference_column: str

    def find(self, df: DataFrame, tag: str) -> Offenders | None:
        """Keys in use that the reference lacks."""
        known = self.reference.select(F.col(self.reference_column).alias(f"{tag}_key"))
        present = df.select(F.col(self.column).alias(f"{tag}_key")).filter(F.col(f"{tag}_key").isNotNull())
        missing = sized(present.distinct().join(known, f"{tag}_key", "left_anti"))
        return Offenders(missing, ((self.column, f"{tag}_key"),), filled=True)

    def broken(self, tag: str) -> Column:
        return F.col(f"{tag}_key").isNotNull()


Rule = RowRule | FirstCopyRule | KnownKeyRule


def judged(
    df: DataFrame,
    rules: Sequence[Rule],
    found: Sequence[Offenders | None],
    into: str,
    separator: str,
    marks: Mapping[int, Marks | Copies] | None = None,
) -> tuple[DataFrame, bool]:
    """Rows with the reasons of their broken rules, and whether any row is shuffled for it.

    Small sets of offending keys are broadcast, and so are ``marks``, the rows
    that break a rule by its position. Of larger sets without marks a filter is:
    rows that it clears of all of them are judged as they stand, the others meet
    the sets by shuffle.
    """
    marks = marks or {}
    tags = [f"__rule{position}" for position in range(len(rules))]
    kept = [c for c in df.columns if c != ROW_ID]
    large = [position for position, offenders in enumerate(found) if offenders is not None and not offenders.side.small and position not in marks]
    work = df
    for position, offenders in enumerate(found):
        if position in marks:
            work = marks[position].flag(work, f"{tags[position]}_marked")
        elif offenders is not None and offenders.side.small:
            work = offenders.join(work)

    def broken(position: int) -> Column:
        return F.col(f"{tags[position]}_marked") if position in marks else rules[position].broken(tags[position])

    def with_reasons(rows: DataFrame, cleared: Sequence[int]) -> DataFrame:
        flags = [
            F.when(F.lit(False) if position in cleared else broken(position), F.lit(rule.reason))
            for position, rule in enumerate(rules)
        ]
        return rows.select(*kept, join_reasons(flags, separator).alias(into))

    if not large:
        return with_reasons(work, ()), False
    for position in large:
        work = found[position].flag(work, f"{tags[position]}_maybe")
    suspect = F.greatest(*[F.col(f"{tags[p]}_maybe") for p in large], F.lit(False))
    suspects = work.filter(suspect)
    for position in large:
        suspects = found[position].join(suspects)
    return with_reasons(work.filter(~suspect), large).unionByName(with_reasons(suspects, ())), True


def evaluate(
    df: DataFrame,
    rules: Sequence[Rule],
    into: str = REASON_COLUMN,
    separator: str = REASON_SEPARATOR,
    from_files: bool = False,
) -> DataFrame:
    """Add the broken rules' reasons in rule order; empty text means clean.

    All rules see the same rows: the first copy of a key is chosen before the
    other rules apply, so a key whose first copy is invalid keeps no valid row.
    A row id that ``df`` already carries is used and left out of the result;
    ``df`` is then written first unless it is a scan, since every rule reads it.
    Where a set of offending keys was too large to be broadcast, and the rows that
    break its rule too many to be marked, the result is written, so that valid and
    quarantined rows do not each repeat the joins.
    """
    return evaluated(df, rules, into, separator, from_files)[0]


def evaluated(
    df: DataFrame, rules: Sequence[Rule], into: str = REASON_COLUMN, separator: str = REASON_SEPARATOR, from_files: bool = False
) -> tuple[DataFrame, bool]:
    """The same, and whether rows were moved: if not, each is judged in the task that scans it."""
    work = df
    if ROW_ID in df.columns:
        work = in_place(df)
    elif any(isinstance(r, FirstCopyRule) for r in rules):
        work = spread(with_row_id(df, from_files))
    source = work
    found = concurrently(lambda item: item[1].find(source, f"__rule{item[0]}"), list(enumerate(rules)))
    large = [p for p, offenders in enumerate(found) if offenders is not None and not offenders.side.small and ROW_ID in work.columns]
    made = concurrently(lambda p: found[p].marks(source, rules[p], f"__rule{p}"), large)
    marks = {p: rows for p, rows in zip(large, made) if rows is not None}
    result, shuffled = judged(work, rules, found, into, separator, marks)
    return (settle(result)[0] if shuffled else result), shuffled or work is not df


def not_in(column: str, allowed: Sequence[object]) -> Column:
    """Outside a short list of allowed values; NULL stays unknown."""
    return ~F.col(column).isin(list(allowed))
