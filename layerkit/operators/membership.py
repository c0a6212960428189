"""A filter that says which rows may hold one of many keys.

When a set of keys is too large to be broadcast, a blocked Bloom filter of it
still is: every key sets ``PROBES`` bits in one block of four words. A row joins
the group of its block and is asked for its bits there. Rows that lack one hold
none of the keys and need no further join, so only the others are shuffled. Keys
are hashed, and bits set and tested, by built-in expressions. Blocks are broadcast
in groups: a row of the join's hash table for each would take the driver, and
every executor, five times the memory of the words.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerkit.sources.scratch import settle

WORDS = 4
PROBES = 3
BITS_PER_KEY = 16
# 32 MB of words: sixteen million keys at full strength. With more, more rows pass.
MOST_BLOCKS = 1 << 20
BLOCK_BITS = 64 * WORDS
# Blocks that are broadcast as one row, four kilobytes.
GROUP_BLOCKS = 128
_GROUP_SHIFT = GROUP_BLOCKS.bit_length() - 1


def blocks_for(keys: int) -> int:
    """Blocks by the measured number of keys."""
    return max(1, min(MOST_BLOCKS, -(-keys * BITS_PER_KEY // BLOCK_BITS)))


def _bits(key: Column) -> list[Column]:
    """The bits of its block that a hashed key sets."""
    return [F.shiftrightunsigned(key, 16 + 9 * probe).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int") for probe in range(PROBES)]


def bit_in(word: Column, bit: Column) -> Column:
    """The lowest six bits of ``bit`` name a bit of ``word``: one or zero."""
    return F.call_function("shiftright", word, bit.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1).cast("long"))


def one_bit(bit: Column) -> Column:
    """A word in which only that bit is set."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int"))


def _masks(key: Column) -> list[Column]:
    """The bits that a hashed key sets in each word of its block."""
    none = F.lit(0).cast("long")

    def word(place: int) -> Column:
        parts = [F.when(F.shiftright(bit, 6) == place, one_bit(bit)).otherwise(none) for bit in _bits(key)]
        return reduce(lambda a, b: a.bitwiseOR(b), parts)

    return [word(place) for place in range(WORDS)]


def _of_group(block: Column) -> Column:
    """The place of a block in its group."""
    return block.bitwiseAND(F.lit(GROUP_BLOCKS - 1)).cast("int")


@dataclass(frozen=True)
class Filter:
    """Groups ``(__group, __words)`` of the blocks of a set of hashed keys; groups without a key are absent."""

    groups: DataFrame
    count: int

    @staticmethod
    def of(keys: DataFrame, columns: list[str], rows: int) -> Filter:
        count = blocks_for(rows)
        hashed = keys.select(F.xxhash64(*columns).alias("__h"))
        words = [m.alias(f"__word{i}") for i, m in enumerate(_masks(F.col("__h")))]
        blocks = hashed.select(F.pmod("__h", F.lit(count)).alias("__block"), *words).groupBy("__block")
        held = blocks.agg(*[F.bit_or(f"__word{i}").alias(f"__word{i}") for i in range(WORDS)])
        entry = F.struct(_of_group(F.col("__block")).alias("place"), F.array(*[f"__word{i}" for i in range(WORDS)]).alias("words"))
        # At most GROUP_BLOCKS entries a group.
        groups = held.groupBy(F.shiftright("__block", _GROUP_SHIFT).alias("__group")).agg(F.map_from_entries(F.collect_list(entry)).alias("held"))
        none = F.array(*[F.lit(0).cast("long")] * WORDS)
        full = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(GROUP_BLOCKS - 1)), lambda i: F.coalesce(F.col("held")[i], none)))
        made, _ = settle(groups.select("__group", full.alias("__words")))
        return Filter(made, count)

    def flag(self, df: DataFrame, columns: list[str], name: str) -> DataFrame:
        """``df`` with a boolean: false where no key of the set can be in ``columns``."""
        side = self.groups.withColumnsRenamed({c: f"__of_{c}" for c in self.groups.columns})
        hashed = df.withColumn("__hash", F.xxhash64(*columns))
        block = F.pmod("__hash", F.lit(self.count))
        joined = hashed.join(F.broadcast(side), F.shiftright(block, _GROUP_SHIFT) == F.col("__of___group"), "left")
        # One look for each probe: a test of all words by masks is too much code for the JVM to compile.
        first = _of_group(block) * WORDS + 1
        looks = [bit_in(F.element_at("__of___words", first + F.shiftright(bit, 6)), bit) for bit in _bits(F.col("__hash"))]
        held = reduce(lambda a, b: a.bitwiseAND(b), looks) == 1
        return joined.select(*df.columns, F.coalesce(held, F.lit(False)).alias(name))
