"""Mixing sources to target weights over a curriculum that varies with time.

Each source has a weight schedule, linear between knots over training time 0 to
1. Its integral is the source's weight. Weights share out the tokens; a target
that exceeds ``CAP`` times its source is held there and the excess goes to the
others by weight. A source's demand up to a time is its target times the share
of its integral up to then. Inverting that demand gives each document the time
at which the stream of its source reaches it, once for each time it is taken,
and documents are range-sorted by that time.

Within a source, documents stand in the order of a hash of their id, the same in
every run. Whole epochs take every document; the last, partial one takes the
first words of that order and cuts the document in which the target ends.

Running sums use blocks of the whole order, cut by range: sums of blocks first,
then sums inside each, so a source, or an id, with a third of all rows spreads
over many blocks. Only DataFrame functions are used, over one narrow table written once. One row
per source is gathered in one task.

Defined cases: a null text has no words. A null source is a source of its own,
last in order. Documents without words are taken zero times, and so is a table
without any words. Rows may repeat: ties in the order are broken by size, and
what still ties is the same row. A null doc_id is ordered by an empty id. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerkit.llm.common import ROW_ID, SPACE, WORD, numbered, table
from layerkit.operators.rowid import in_place, with_row_id
from layerkit.sources.scratch import settle

CAP = 3
BLOCK_ROWS = 1_000_000
Schedule = Sequence[tuple[float, float]]
# Knots (time, weight). The integrals are 5, 2 and 1: the heaviest sources lead
# and fade, the lightest come up towards the end.
SCHEDULES: tuple[Schedule, ...] = (
    ((0.0, 7.0), (0.5, 5.0), (1.0, 3.0)),
    ((0.0, 2.0), (1.0, 2.0)),
    ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)),
)


def integral(schedule: Schedule) -> float:
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]))


def _long(value: Column) -> Column:
    return value.cast("long")


def source_targets(sizes: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, cap: int = CAP) -> DataFrame:
    """``(source, source_size, schedule, target)`` from ``(source, size)`` rows.

    Sources take the schedules in turn, by code point with null last. Capped
    targets are the sources with the smallest ratio of size to weight, up to
    the first at which the rest of the tokens, shared by weight, fits.
    """
    found = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    found = found.withColumn("schedule", (turn % len(schedules)).cast("int"))
    weights = F.array(*[F.lit(integral(s)) for s in schedules])
    found = found.withColumns({"weight": F.element_at(weights, F.col("schedule") + 1), "most": F.col("source_size") * cap})
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    rest = F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(before), F.lit(0))
    found = found.withColumn("level", rest.cast("double") / F.sum("weight").over(after))
    fits = F.col("level") * F.col("weight") <= F.col("most")
    # In this order the first level that fits is the one that all later sources share.
    shared = F.first(F.when(fits, F.col("level")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    target = F.when(shared.isNull(), F.col("most").cast("double")).otherwise(shared * F.col("weight"))
    return found.select("source", "source_size", "schedule", target.alias("target"))


def time_of(share: Column, schedule: Schedule) -> Column:
    """Time at which a schedule has spent this share of its integral."""
    total, spent, found = integral(schedule), 0.0, F.lit(1.0)
    pieces = []
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        slope = (w1 - w0) / (t1 - t0)
        ahead = F.greatest(share * total - spent, F.lit(0.0))
        # The stable root of w0 * x + slope / 2 * x^2 = ahead.
        root = ahead * 2 / (F.sqrt(F.greatest(ahead * (2 * slope) + w0 * w0, F.lit(0.0))) + w0)
        spent += (t1 - t0) * (w0 + w1) / 2
        pieces.append((share * total < spent, F.coalesce(root, F.lit(0.0)) + t0))
    for fits, at in reversed(pieces):
        found = F.when(fits, at).otherwise(found)
    return found


def _placed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``start``: the words of the source that stand before each row.

    ``rows`` is a written table ``(doc_id, source, size, ...)``.
    """
    rank = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    order = ["source", "rank", "doc_id", "size", *keys]
    # Ranges of the whole order are even, also where an id or a source holds a third of all rows. Their
    # bounds are sampled by each job, so the blocks are written before they are used.
    width = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.count() // BLOCK_ROWS)
    ranged = rows.withColumn("rank", rank).repartitionByRange(width, *order)
    rows, _ = settle(ranged.withColumn("block", F.spark_partition_id()))
    sums = rows.groupBy("source", "block").agg(F.sum("size").alias("in_block"))
    earlier = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source", "block", F.coalesce(F.sum("in_block").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("source", "block").orderBy("rank", "doc_id", "size", *keys).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    sums = sums.withColumnsRenamed({"source": "source_of", "block": "block_of"})
    same = F.col("source").eqNullSafe(F.col("source_of")) & (F.col("block") == F.col("block_of"))
    return rows.join(sums, same).select(*keys, "doc_id", "source", "size", (F.col("before") + F.col("within")).alias("start"))


def takes(rows: DataFrame, keys: Sequence[str] = (), schedules: Sequence[Schedule] = SCHEDULES, cap: int = CAP) -> DataFrame:
    """Each row of ``(doc_id, source, size)`` with an array of its takes.

    ``takes`` holds one struct ``(epoch, words, position)`` for each time that
    words of the document are taken; position is the training time. ``keys``
    are columns that tell rows apart and are carried along.
    """
    targets = source_targets(rows, schedules, cap)
    targets = targets.withColumnRenamed("source", "source_of")
    placed = _placed(rows, keys).join(targets, F.col("source").eqNullSafe(F.col("source_of")), "left")
    size, whole, start = F.col("size"), F.col("source_size"), F.col("start")
    goal = _long(F.round("target"))
    epochs = F.transform(F.array(*[F.lit(e).cast("long") for e in range(cap)]), lambda e: F.struct(
        e.cast("int").alias("epoch"),
        F.greatest(F.least(goal - e * whole - start, size), F.lit(0)).cast("long").alias("words"),
        # A source without words has a target of 0 and takes nothing.
        F.least(F.try_divide((e * whole + start).cast("double"), F.col("target")), F.lit(1.0)).alias("share"),
    ))
    taken = F.filter(epochs, lambda t: t["words"] > 0)

    def timed(take: Column) -> Column:
        at = F.lit(1.0)
        for number, schedule in enumerate(schedules):
            at = F.when(F.col("schedule") == number, time_of(take["share"], schedule)).otherwise(at)
        return F.struct(take["epoch"].alias("epoch"), take["words"].alias("words"), at.alias("position"))

    return placed.select(*keys, "doc_id", "source", "size", "source_size", "target", F.transform(taken, timed).alias("takes"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, sorted by first training position."""
    docs = table(spark, sf_dir, "documents")
    rows, _ = settle(numbered(docs, "doc_id", "source", "text").select("file", "at", "doc_id", "source", word_count(F.col("text")).alias("size")))
    taken = F.coalesce(F.aggregate("takes", F.lit(0).cast("long"), lambda total, t: total + t["words"]), F.lit(0))
    first = F.round(F.try_element_at("takes", F.lit(1))["position"], 6)
    return (
        takes(rows, ("file", "at"))
        .select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), first.alias("position"))
        .repartitionByRange("position", "doc_id")
        .sortWithinPartitions("position", "doc_id")
    )


def mixed(docs: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, cap: int = CAP) -> DataFrame:
    """``docs``, from any plan, as the mix takes them: a row per take, in training order.

    A document taken twice is there twice, one taken in part has its first
    words, and one not taken is left out. Columns stay as they are, but a cut
    text has its own ``n_chars``.
    """
    docs = in_place(docs)
    rows, _ = settle(numbered(docs, "doc_id", "source", "text").select("file", "at", "doc_id", "source", word_count(F.col("text")).alias("size")))
    found = takes(rows, ("file", "at"), schedules, cap).select(
        F.struct("file", "at").alias(ROW_ID), F.col("size").alias("__size"), F.inline("takes")
    )
    found = found.select(ROW_ID, "__size", F.col("words").alias("__words"), F.col("position").alias("__position"))
    joined = with_row_id(docs, from_files=True).join(found, ROW_ID)
    # Words with the space before them; evaluated for the few cut documents only.
    parts = F.split("text", rf"(?<={WORD[:-1]})(?={SPACE})")
    cut = F.col("__words") < F.col("__size")
    text = F.when(cut, F.array_join(F.slice(parts, F.lit(1), F.col("__words").cast("int")), "")).otherwise(F.col("text"))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(cut, F.length(text)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    ordered = joined.repartitionByRange("__position", "doc_id").sortWithinPartitions("__position", "doc_id")
    return ordered.withColumns(changed).select(*docs.columns)


def _time_sql(share: str, schedule: Schedule) -> str:
    """The expression of ``time_of`` in SQL, with the same order of operations."""
    total, spent, cases = integral(schedule), 0.0, []
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        slope = (w1 - w0) / (t1 - t0)
        ahead = f"greatest({share} * {total!r}::DOUBLE - {spent!r}::DOUBLE, 0.0::DOUBLE)"
        root = f"{ahead} * 2 / (sqrt(greatest({ahead} * {2 * slope!r}::DOUBLE + {w0 * w0!r}::DOUBLE, 0.0::DOUBLE)) + {w0!r}::DOUBLE)"
        spent += (t1 - t0) * (w0 + w1) / 2
        cases.append(f"WHEN {share} * {total!r}::DOUBLE < {spent!r}::DOUBLE THEN {root} + {t0!r}::DOUBLE")
    return f"CASE {' '.join(cases)} ELSE 1.0 END"


_TIMES = " ".join(f"WHEN {number} THEN {_time_sql('share', schedule)}" for number, schedule in enumerate(SCHEDULES))
OP1_SQL = rf"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(SCHEDULES)} AS schedule
    FROM sized GROUP BY source
), weighed AS (
    SELECT *, CASE schedule {" ".join(f"WHEN {n} THEN {integral(s)!r}::DOUBLE" for n, s in enumerate(SCHEDULES))} END AS weight,
           {CAP} * source_size AS most
    FROM sources
), levels AS (
    SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER (
               ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
           / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighed
), targets AS (
    SELECT source, source_size, schedule, coalesce(first_level * weight, most::DOUBLE) AS target FROM (
        SELECT *, first_value(CASE WHEN level * weight <= most THEN level END IGNORE NULLS) OVER (
            ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS first_level
        FROM levels)
), placed AS (
    SELECT doc_id, source, size, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
    FROM sized
), taken AS (
    SELECT doc_id, size, source_size, schedule, target, greatest(least(round(target)::BIGINT - e * source_size - start, size), 0) AS words,
           least((e * source_size + start)::DOUBLE / target, 1.0::DOUBLE) AS share, e
    FROM placed JOIN targets ON placed.source IS NOT DISTINCT FROM targets.source, range({CAP}) AS epochs(e)
)
SELECT doc_id, size, source_size, target, sum(words)::BIGINT AS taken,
       round(min_by(CASE schedule {_TIMES} END, e) FILTER (words > 0), 6) AS position
FROM taken GROUP BY doc_id, size, source_size, target
"""
