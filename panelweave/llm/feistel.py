"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered 0 to n-1 in the order of their key and content, the numbers are
permuted by a four-round balanced Feistel network over the next even number of bits,
and numbers that fall outside 0 to n-1 walk along their cycle until they fall inside.
The permuted position gives shard (position modulo shards) and slot (position divided
by shards), so shard counts differ by one at most, slots have no gaps, and the row
that is at a slot of a shard can be computed back without a lookup.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelweave.llm.common import packed, place, small_side
from panelweave.session import stage

ROUNDS = 4
# Odd multipliers of the round function.
FIRST, SECOND = 2654435761, 2246822507
SEED = 20_240


@dataclass(frozen=True)
class Permutation:
    """A keyed bijection of 0..n-1; ``forward`` and ``inverse`` work on whole arrays."""

    n: int
    seed: int = SEED

    @property
    def half(self) -> int:
        """Bits of one half: the domain 4**half is below 4n for n > 1."""
        return max(1, (max(self.n - 1, 1).bit_length() + 1) // 2)

    def key(self, i: int) -> int:
        return (self.seed * 1_000_003 + i * 7_919 + 12_345) % 2_147_483_647

    def _mixed(self, x: np.ndarray, i: int) -> np.ndarray:
        x = x * FIRST + self.key(i)
        x = (x ^ (x >> 15)) & 0x7FFFFFFF
        x = x * SECOND
        x = x ^ (x >> 13)
        return x & ((1 << self.half) - 1)

    def _once(self, x: np.ndarray, rounds) -> np.ndarray:
        left, right = x >> self.half, x & ((1 << self.half) - 1)
        for i in rounds:
            left, right = right, left ^ self._mixed(right, i)
        return (left << self.half) | right

    def _walk(self, x: np.ndarray, step) -> np.ndarray:
        out = step(x)
        while (outside := out >= self.n).any():
            out[outside] = step(out[outside])
        return out

    def forward(self, x: np.ndarray) -> np.ndarray:
        return self._walk(np.asarray(x, dtype=np.int64), lambda v: self._once(v, range(ROUNDS)))

    def inverse(self, x: np.ndarray) -> np.ndarray:
        def back(v: np.ndarray) -> np.ndarray:
            left, right = v >> self.half, v & ((1 << self.half) - 1)
            for i in reversed(range(ROUNDS)):
                left, right = right ^ self._mixed(left, i), left
            return (left << self.half) | right

        return self._walk(np.asarray(x, dtype=np.int64), back)


def permuted(number: Column, n: int, seed: int = SEED) -> Column:
    permutation = Permutation(n, seed)

    @F.pandas_udf("long")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(permutation.forward(batch.to_numpy()))

    return apply(number)


def row_numbers(placed: DataFrame, name: str) -> DataFrame:
    """Add ``number``: the rows of earlier files plus the row in its own file. One row a file is gathered."""
    files = placed.groupBy(F.col("place.part").alias("part_"), F.col("place.file").alias("file_")).agg(
        F.count("*").alias("rows_"))
    before = Window.orderBy("part_", "file_").rowsBetween(Window.unboundedPreceding, -1)
    starts = small_side(files.withColumn("start_", F.coalesce(F.sum("rows_").over(before), F.lit(0))), f"{name}-starts")
    return placed.join(starts, F.col("place.file") == F.col("file_")).withColumn(
        "number", F.col("start_") + F.col("place.row")).drop("part_", "file_", "rows_", "start_")


def shard(docs: DataFrame, shards: int, *, key: str = "doc_id", text: str = "text",
          carry: tuple[str, ...] = (), seed: int = SEED, name: str = "shard") -> DataFrame:
    """Rows as (row, size, text_crc32, number, shard, slot); ``row`` holds the carried columns.

    * Every row gets a slot, rows with a null key (numbered last) or a null text
      (size 8, crc32 of no bytes) included.
    * Rows are numbered by key, size and crc32 of the text. Rows that agree in all
      three take neighbouring numbers in any order, which changes no result but the
      order of equal rows; a repeated run gives the same table.
    * An empty table gives an empty result with the same columns.

    ``docs`` should be a written table, as in the pipeline; write the result of joins or
    shuffles before (``panelweave.session.stage``).
    """
    body = F.coalesce(docs[text], F.lit(""))
    compact = docs.select(
        packed(docs, *carry).alias("row"), docs[key].alias("key"),
        (F.octet_length(body) + 8).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
    )
    if carry:  # narrow rows: written first, so that range bounds are not drawn from a second read of the texts
        compact = stage(compact, f"{name}-rows")
    placed = place(compact, ["key", "size", "text_crc32"], name)
    numbered = row_numbers(placed, name)
    position = permuted(F.col("number"), placed.count(), seed)
    return numbered.withColumn("position", position).select(
        "row", "size", "text_crc32", "number",
        F.pmod("position", F.lit(shards)).cast("int").alias("shard"),
        F.expr(f"position div {shards}").alias("slot"),
    )
