"""Rows of a table marked by their place, one bit each.

Rows that are found by a shuffle of narrow columns are pointed out to the wide
rows without shuffling these: their bits are broadcast. A row id names file and
position, so a block of bits covers ``BLOCK_ROWS`` positions of one file. Blocks
without a marked row are absent. Marks are exact.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerkit.operators.membership import bit_in, one_bit
from layerkit.operators.rowid import ROW_ID
from layerkit.sources.scratch import BROADCAST_BYTES, settle

WORDS = 64
BLOCK_ROWS = 64 * WORDS
# A block in memory: its words, file and number, and what a hash table adds.
BLOCK_BYTES = 8 * WORDS + 88


@dataclass(frozen=True)
class Marks:
    """Blocks ``(__file, __block, __words)`` of the marked rows."""

    blocks: DataFrame

    @staticmethod
    def of(rows: DataFrame, most_bytes: int = BROADCAST_BYTES) -> Marks | None:
        """Marks of rows given by id; None where they take more memory than ``most_bytes``."""
        at = F.col(f"{ROW_ID}.at")
        placed = rows.select(F.col(f"{ROW_ID}.file").alias("__file"), F.shiftright(at, 6).alias("__word"), one_bit(at).alias("bit"))
        words = placed.groupBy("__file", "__word").agg(F.bit_or("bit").alias("word"))
        place = F.col("__word").bitwiseAND(F.lit(WORDS - 1)).cast("int")
        entry = F.struct(place.alias("place"), "word")
        # At most WORDS entries a block.
        blocks = words.groupBy("__file", F.shiftright("__word", 6).alias("__block")).agg(F.map_from_entries(F.collect_list(entry)).alias("held"))
        full = F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda i: F.coalesce(F.col("held")[i], F.lit(0).cast("long")))
        made, count = settle(blocks.select("__file", "__block", full.alias("__words")))
        return Marks(made) if count * BLOCK_BYTES <= most_bytes else None

    def flag(self, df: DataFrame, name: str) -> DataFrame:
        """``df``, which has row ids, with a boolean: whether a row is marked."""
        at = F.col(f"{ROW_ID}.at")
        here = (F.col(f"{ROW_ID}.file") == F.col("__file")) & (F.shiftright(at, 12) == F.col("__block"))
        joined = df.join(F.broadcast(self.blocks), here, "left")
        word = F.element_at("__words", F.shiftright(at, 6).bitwiseAND(F.lit(WORDS - 1)).cast("int") + 1)
        return joined.select(*df.columns, F.coalesce(bit_in(word, at) == 1, F.lit(False)).alias(name))
