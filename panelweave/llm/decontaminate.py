"""Benchmark decontamination: windows as long as an item, SimHash, Hamming blocks, exact check.

* Items and windows are multisets of word shingles. An item of n shingles is compared
  with the windows of n shingles of every document, and with the whole of a document
  that has fewer.
* A window within the threshold shares so many shingles with its item that a count of
  them, taken from a bit table of all benchmark shingles, rules out nearly all windows
  before any is hashed. The table has a fixed largest size; a fuller table lets more
  windows through, never fewer.
* What is left gets a 128-bit SimHash. Fingerprints meet by blocks: two that differ in
  at most RADIUS bits agree up to BLOCK_RADIUS bits in one block at least, so an item is
  filed under all its blocks' variants and a window looks up its own blocks.
* Pairs within the radius are verified: shared over united shingles, each counted as
  often as it occurs, at the threshold or above.

Equal windows are looked up once, so a passage that a third of all documents holds is
one row until the last join.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelweave.llm import shingles as S
from panelweave.llm.common import packed, small_side
from panelweave.session import stage

THRESHOLD = 0.8
BITS, BLOCKS, BLOCK_RADIUS = 128, 16, 2
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
# a window at the threshold differs from its item in 19 bits on average, with a standard error of 4
LEAST_TABLE, MOST_TABLE = 20, 30
SPAN = 1 << 15


def counted(shingles: np.ndarray) -> np.ndarray:
    """A multiset as a sorted set: the second, third, ... occurrence of a shingle becomes an element of its own."""
    ordered = np.sort(shingles)
    new = np.ones(len(ordered), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    nth = np.arange(len(ordered)) - np.maximum.accumulate(np.where(new, np.arange(len(ordered)), 0))
    again = nth > 0
    ordered[again] = S.mixed(ordered[again] ^ (nth[again].astype(np.uint64) << np.uint64(40)), 5)
    return np.sort(ordered)


def simhash(shingles: np.ndarray) -> bytes:
    """Bit by bit the majority of the hashes of a multiset's elements.

    Each occurrence of a shingle is an element of its own, so that the bits in which two
    fingerprints differ follow the similarity that is verified, however often a shingle recurs.
    """
    shingles = counted(shingles)
    words = np.stack([S.mixed(shingles, 8), S.mixed(shingles, 9)], axis=1)
    bits = np.unpackbits(words.view(np.uint8), axis=1)
    return np.packbits(2 * bits.sum(0, dtype=np.int64) > len(shingles)).tobytes()


def _slots(shingles: np.ndarray, length: int, table_bits: int) -> np.ndarray:
    return (S.mixed(shingles, 100 + length) >> np.uint64(64 - table_bits)).astype(np.int64)


def _variants() -> np.ndarray:
    """All values of a block's eight bits that differ from zero in up to BLOCK_RADIUS bits."""
    return np.array([sum(1 << b for b in flips) for n in range(BLOCK_RADIUS + 1)
                     for flips in itertools.combinations(range(8), n)], dtype=np.int64)


def _items(table_bits: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips = _variants()
        for batch, texts in S.chunks(batches, "text"):
            words = S.word_hashes(texts)
            shingles, begin = words.shingles()
            rows = {c: [] for c in ("at", "n", "fingerprint", "elements", "slots", "keys")}
            for d in np.flatnonzero(np.diff(words.first) >= S.WIDTH):
                own = shingles[begin[d]:begin[d + 1]]
                fingerprint = simhash(own)
                blocks = np.frombuffer(fingerprint, dtype=np.uint8).astype(np.int64)
                rows["at"].append(d)
                rows["n"].append(len(own))
                rows["fingerprint"].append(fingerprint)
                rows["elements"].append(counted(own).view(np.int64))
                rows["slots"].append(np.concatenate([_slots(own, 0, table_bits), _slots(own, len(own), table_bits)]))
                rows["keys"].append(((np.arange(BLOCKS) << 8)[:, None] | (blocks[:, None] ^ flips[None, :])).ravel())
            yield pa.RecordBatch.from_arrays([
                batch.column("item").take(pa.array(rows["at"], pa.int64())), pa.array(rows["n"], pa.int64()),
                pa.array(rows["fingerprint"], pa.binary()), *(pa.array(rows[c], pa.list_(pa.int64())) for c in ("elements", "slots", "keys")),
            ], ["item", "n", "fingerprint", "elements", "slots", "keys"])

    return sketch


def _windows(table, table_bits: int, lengths: list[int], threshold: float):
    """Windows that may match: enough of their shingles are in the table under their own length."""
    needed = {n: math.ceil(2 * threshold / (1 + threshold) * n - 1e-9) for n in lengths}

    def held(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
        return (bits[slots >> 3] >> (slots & 7).astype(np.uint8) & 1).astype(bool)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(table.value, dtype=np.uint8)
        least, longest = min(needed.values(), default=0), max(lengths, default=0)
        least_short = min((math.ceil(threshold * n - 1e-9) for n in lengths), default=0)
        for batch, texts in S.chunks(batches, "text"):
            words = S.word_hashes(texts)
            shingles, begin = words.shingles()
            any_length = held(bits, _slots(shingles, 0, table_bits))
            sums = np.concatenate(([0], np.cumsum(any_length)))
            wanted = np.where(np.diff(begin) < longest, least_short, least)
            enough = (sums[begin[1:]] - sums[begin[:-1]] >= wanted) & (np.diff(words.first) >= S.WIDTH)
            at, start, n, fingerprints, elements = [], [], [], [], []
            for d in np.flatnonzero(enough):
                own, known = shingles[begin[d]:begin[d + 1]], any_length[begin[d]:begin[d + 1]]
                hits = np.flatnonzero(known)
                for length in lengths:
                    size = min(length, len(own))
                    need = needed[length] if size == length else math.ceil(threshold / (1 + threshold) * (size + length) - 1e-9)
                    if len(hits) < need or size < need:
                        continue
                    mine = np.zeros(len(own) + 1, dtype=np.int64)
                    mine[1 + hits[held(bits, _slots(own[hits], length, table_bits))]] = 1
                    total = np.cumsum(mine)
                    for s in np.flatnonzero(total[size:] - total[:-size] >= need):
                        at.append(d)
                        start.append(s)
                        n.append(length)
                        fingerprints.append(simhash(own[s:s + size]))
                        elements.append(counted(own[s:s + size]).view(np.int64))
            keys = batch.drop_columns(["text"]).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([
                *keys.columns, pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(fingerprints, pa.binary()),
                pa.array(elements, pa.list_(pa.int64())),
            ], [*keys.schema.names, "start", "n", "fingerprint", "elements"])

    return search


def _table(items: DataFrame, table_bits: int) -> bytes:
    """The bit table, put together by Spark in pieces of 32,768 bits; its size is fixed by ``table_bits``."""
    slot = F.explode("slots").alias("slot")
    pieces = items.select(slot).groupBy(F.expr(f"slot div {SPAN}").alias("piece")).agg(
        F.expr(f"bitmap_construct_agg(slot % {SPAN})").alias("bits"))
    table = bytearray(1 << (table_bits - 3))
    for r in pieces.toLocalIterator():
        table[r.piece * SPAN // 8:(r.piece + 1) * SPAN // 8] = r.bits
    return bytes(table)


def leaks(docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text", item: str = "item_id",
          item_text: str = "text", threshold: float = THRESHOLD, name: str = "leaks") -> DataFrame:
    """Rows (key, text_hash, item, similarity, first_word, n_words, n_windows): documents that hold an item.

    A row for each document and item with its most similar window (the first of equals)
    and the number of windows at the threshold. A document with fewer shingles than the
    item is one window. Items and documents with fewer than five
    words have no shingle and match nothing. Null texts are empty. Rows that agree in key
    and text are reported once; a repeated item identifier counts with each of its texts. A null key is
    reported like any other. Empty tables give an empty result; columns of any other name are not looked at.
    """
    spark = docs.sparkSession
    entries = benchmark.select(F.sum(F.regexp_count(F.lower(item_text), F.lit("[a-z0-9\\u0080-\\uffff]+"))).alias("n")).first().n or 0
    table_bits = min(MOST_TABLE, max(LEAST_TABLE, math.ceil(math.log2(32 * entries + 1))))
    item_type = T.StructType([
        T.StructField("item", benchmark.schema[item].dataType), T.StructField("n", T.LongType()), T.StructField("fingerprint", T.BinaryType()),
        *(T.StructField(c, T.ArrayType(T.LongType())) for c in ("elements", "slots", "keys"))])
    items = stage(benchmark.select(F.col(item).alias("item"), F.lower(item_text).alias("text")).mapInArrow(_items(table_bits), item_type),
                  f"{name}-items")
    lengths = sorted(r.n for r in items.select("n").distinct().collect())
    table = spark.sparkContext.broadcast(_table(items, table_bits))
    window_type = T.StructType([
        T.StructField("key", docs.schema[key].dataType), T.StructField("text_hash", T.LongType()), T.StructField("start", T.LongType()),
        T.StructField("n", T.LongType()), T.StructField("fingerprint", T.BinaryType()), T.StructField("elements", T.ArrayType(T.LongType()))])
    windows = docs.select(docs[key].alias("key"), F.xxhash64(docs[text]).alias("text_hash"), F.lower(docs[text]).alias("text")).mapInArrow(
        _windows(table, table_bits, lengths, threshold), window_type)
    windows = stage(windows.withColumn("window", F.sha2(F.array_join("elements", ",").cast("binary"), 256)), f"{name}-windows")

    distinct = windows.groupBy("window", "n").agg(F.min("fingerprint").alias("fingerprint"), F.min("elements").alias("elements"))
    keys = F.transform(F.sequence(F.lit(0), F.lit(BLOCKS - 1)), lambda b: F.shiftleft(b.cast("long"), 8) + F.conv(
        F.hex(F.substring("fingerprint", b + 1, F.lit(1))), 16, 10).cast("long"))
    looked = distinct.select("*", F.explode(keys).alias("block"))
    filed = items.select("item", F.col("n").alias("item_n"), F.col("fingerprint").alias("item_fingerprint"),
                         F.col("elements").alias("item_elements"), F.explode("keys").alias("item_block"))
    half = lambda c, at: F.conv(F.hex(F.substring(c, at, 8)), 16, -10).cast("long")
    differ = sum((F.bit_count(half("fingerprint", at).bitwiseXOR(half("item_fingerprint", at))) for at in (1, 9)), F.lit(0))
    met = looked.join(filed, (F.col("n") == F.col("item_n")) & (F.col("block") == F.col("item_block"))).where(differ <= RADIUS)
    shared = F.size(F.array_intersect("elements", "item_elements"))
    both = F.size("elements") + F.size("item_elements")
    matches = met.select("window", "n", "item", (shared / (both - shared)).alias("similarity")).where(
        F.col("similarity") >= threshold - 1e-12).groupBy("window", "n", "item").agg(F.max("similarity").alias("similarity"))
    matches = small_side(matches, f"{name}-matches")
    best = F.max(F.struct("similarity", (-F.col("start")).alias("before"), "size")).alias("best")
    found = windows.select("key", "text_hash", "start", "n", F.size("elements").alias("size"), "window").distinct().join(
        matches, ["window", "n"]).groupBy("key", "text_hash", "item").agg(
        best, F.count("*").alias("n_windows"))
    return found.select(
        F.col("key").alias(key), "text_hash", F.col("item").alias(item), "best.similarity", (-F.col("best.before")).alias("first_word"),
        (F.col("best.size").cast("long") + S.WIDTH - 1).alias("n_words"), "n_windows")


def clean(docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text", name: str = "leaks", **settings) -> DataFrame:
    """The documents that hold no item of the benchmark."""
    found = leaks(docs, benchmark, key=key, text=text, name=name, **settings)
    found = small_side(found.select(F.col(key).alias("key_"), F.col("text_hash").alias("hash_")).distinct(), f"{name}-found")
    rows = docs.select(packed(docs).alias("row"), docs[key].alias("k_"), F.xxhash64(docs[text]).alias("h_"))
    return rows.join(found, F.col("k_").eqNullSafe(F.col("key_")) & F.col("h_").eqNullSafe(F.col("hash_")), "left_anti").select("row.*")
