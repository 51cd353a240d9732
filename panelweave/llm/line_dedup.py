"""Line deduplication by a deletion-neighbourhood join.

A line is its sequence of words; white space does not count. Two lines are the same
within the edit bound if one word put in, taken out or replaced makes them equal and
both have at least LEAST_WORDS words; shorter lines must be equal.

* Equal lines are brought together by a 128-bit hash of their words.
* Lines within the bound share their first or their last half, so lines that share
  neither with any other line are left out before variants are emitted. This loses
  nothing: one edit lies in one half only.
* Every other line emits the hash of itself and of itself without each word in turn.
  Equal variants meet by aggregation, never pair by pair. Two lines of equal length are
  one replacement apart if they agree without the word at the same place; a line agrees
  with one a word longer if it equals one of that one's variants. That is the check of the
  edit distance, and it needs only the earliest line of each (variant, place).
* A line is dropped if an earlier line equals it or lies within the bound. Earlier is
  decided by document key, then hash of the text, then line number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelweave.llm import shingles as S
from panelweave.llm.common import packed, small_side
from panelweave.session import stage

LEAST_WORDS = 10
_IN_WORD = np.ones(256, dtype=bool)
_IN_WORD[[32, 9, 10, 11, 12, 13]] = False
# Two odd bases of the rolling hashes and their inverses modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
INVERSES = tuple(pow(b, -1, 1 << 64) for b in BASES)


class Lines:
    """The lines with words of some documents, with sums that give the hash of any run of words."""

    def __init__(self, texts: list[bytes]):
        text = S.split(texts, _IN_WORD)
        words = text.hashes()
        breaks = np.flatnonzero(text.data == 10)
        size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
        doc_start = np.concatenate(([0], np.cumsum(size)))
        first_line = np.searchsorted(breaks, doc_start)
        self.counts = np.diff(first_line)
        line_of_word = np.searchsorted(breaks, text.starts)
        new = np.append(True, line_of_word[1:] != line_of_word[:-1])[: len(line_of_word)]
        self.begin = np.append(np.flatnonzero(new), len(words))
        lines = line_of_word[self.begin[:-1]]
        self.doc = np.searchsorted(first_line, lines, side="right") - 1
        self.number = lines - first_line[self.doc]
        self.n = np.diff(self.begin)
        place = np.arange(len(words)) - np.repeat(self.begin[:-1], self.n)
        longest = int(self.n.max(initial=0)) + 1
        self.place, self.powers, self.inverse, self.sums = place, [], [], []
        for base, back in zip(BASES, INVERSES, strict=True):
            power = np.cumprod(np.append(np.uint64(1), np.full(longest, base, dtype=np.uint64)))
            self.powers.append(power)
            self.inverse.append(np.cumprod(np.append(np.uint64(1), np.full(longest, back, dtype=np.uint64))))
            self.sums.append(np.append(np.uint64(0), np.cumsum(words * power[place])))

    def run(self, base: int, line: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hash of words a to b - 1 of the lines, wherever they stand."""
        total = self.sums[base]
        at = self.begin[line]
        return (total[at + b] - total[at + a]) * self.inverse[base][a]

    def whole(self) -> list[np.ndarray]:
        every = np.arange(len(self.n))
        return [self.run(base, every, np.zeros_like(self.n), self.n) for base in (0, 1)]

    def halves(self) -> np.ndarray:
        """Four keys a line: its first and last words, half as many as it has and half of one less."""
        every, out = np.arange(len(self.n)), []
        for h in (self.n // 2, (self.n - 1) // 2):
            for side, a in ((21, np.zeros_like(self.n)), (22, self.n - h)):
                out.append(S.mixed(self.run(0, every, a, a + h) ^ S.mixed(self.run(1, every, a, a + h), side), side) + h.astype(np.uint64))
        return np.stack(out, axis=1)

    def without_each(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """For the chosen lines: line, place and hash of the line without the word at that place."""
        line = np.repeat(chosen, self.n[chosen])
        place = np.concatenate([np.arange(n) for n in self.n[chosen]]) if len(chosen) else np.zeros(0, dtype=np.int64)
        hashes = []
        for base in (0, 1):
            before = self.run(base, line, np.zeros_like(place), place)
            after = self.run(base, line, place + 1, self.n[line])
            hashes.append(before + after * self.powers[base][place])
        return line, place, hashes


def _fingerprint(n: np.ndarray, hashes: list[np.ndarray]) -> np.ndarray:
    return np.stack([S.mixed(h + n.astype(np.uint64), 31 + i) for i, h in enumerate(hashes)], axis=1)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in S.chunks(batches, "text"):
        lines = Lines(texts)
        fp = _fingerprint(lines.n, lines.whole()).view(np.int64)
        long = lines.n >= LEAST_WORDS
        halves = [np.unique(h).tolist() if keep else None for h, keep in zip(lines.halves().view(np.int64), long, strict=True)]
        keys = batch.drop_columns(["text"]).take(pa.array(lines.doc))
        yield pa.RecordBatch.from_arrays(
            [*keys.columns, pa.array(lines.number.astype(np.int32)), pa.array(fp[:, 0]), pa.array(fp[:, 1]), pa.array(halves, pa.list_(pa.int64()))],
            [*keys.schema.names, "line", "fp1", "fp2", "halves"])


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in S.chunks(batches, "text"):
        lines = Lines(texts)
        wanted = set()
        for d, numbers in enumerate(batch.column("lines").to_pylist()):
            wanted.update((d, n) for n in numbers)
        chosen = np.array([i for i, at in enumerate(zip(lines.doc.tolist(), lines.number.tolist(), strict=True)) if at in wanted], dtype=np.int64)
        own = _fingerprint(lines.n, lines.whole()).view(np.int64)
        line, place, hashes = lines.without_each(chosen)
        less = _fingerprint(lines.n[line] - 1, hashes).view(np.int64)
        owner, place = np.append(chosen, line), np.append(np.full(len(chosen), -1), place)
        variant = np.concatenate([own[chosen], less])
        keys = batch.drop_columns(["text", "lines"]).take(pa.array(lines.doc[owner]))
        yield pa.RecordBatch.from_arrays(
            [*keys.columns, pa.array(lines.number[owner].astype(np.int32)), pa.array(variant[:, 0]), pa.array(variant[:, 1]),
             pa.array(place.astype(np.int32))], [*keys.schema.names, "line", "v1", "v2", "place"])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in S.chunks(batches, "text"):
        out, total, gone = [], [], []
        missing = batch.column("text").is_null().to_pylist()
        for text, dropped, null in zip(texts, batch.column("dropped").to_pylist(), missing, strict=True):
            lines, drop = text.split(b"\n"), set(dropped or ())
            out.append(None if null else b"\n".join(line for i, line in enumerate(lines) if i not in drop).decode())
            total.append(0 if null else len(lines))
            gone.append(len(drop))
        kept = batch.drop_columns(["text", "dropped"])
        yield pa.RecordBatch.from_arrays(
            [*kept.columns, pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(out, pa.string())],
            [*kept.schema.names, "n_lines", "n_dropped", "text"])


def dropped_lines(docs: DataFrame, *, key: str = "doc_id", text: str = "text", name: str = "lines") -> DataFrame:
    """Rows (key, text_hash, dropped): numbers of the lines, from 0, that an earlier line makes superfluous.

    Documents that keep all lines are not listed. Lines without words are never dropped.
    Rows that agree in key and text are one document here and keep the same lines.
    Null keys come first; null and empty texts have no lines with words.
    """
    id_fields = [T.StructField("key", docs.schema[key].dataType), T.StructField("text_hash", T.LongType())]
    body = docs.select(docs[key].alias("key"), F.xxhash64(docs[text]).alias("text_hash"), docs[text].alias("text"))
    fields = lambda **types: T.StructType([*id_fields, *(T.StructField(c, t) for c, t in types.items())])
    long, int_ = T.LongType(), T.IntegerType()
    at = F.struct("key", "text_hash", "line")
    lines = stage(body.mapInArrow(_lines, fields(line=int_, fp1=long, fp2=long, halves=T.ArrayType(long))), f"{name}-all")
    distinct = stage(lines.groupBy("fp1", "fp2").agg(
        F.min(at).alias("first"), F.count("*").alias("n"), F.min("halves").alias("halves")), f"{name}-distinct")

    halves = distinct.select("first", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("n")).where("n > 1").select("half")
    live = halves.join(shared, "half").select("first").distinct()
    wanted = small_side(live.groupBy(F.col("first.key").alias("key_"), F.col("first.text_hash").alias("hash_")).agg(
        F.collect_list("first.line").alias("lines")), f"{name}-live")
    once = body.join(wanted, F.col("key").eqNullSafe(F.col("key_")) & (F.col("text_hash") == F.col("hash_"))).select(
        "key", "text_hash", "text", "lines")
    variants = once.mapInArrow(_variants, fields(line=int_, v1=long, v2=long, place=int_)).distinct()
    variants = stage(variants.select("v1", "v2", "place", at.alias("at")), f"{name}-variants")

    earliest = variants.groupBy("v1", "v2", "place").agg(F.min("at").alias("first"))
    # a variant has no more places than words
    whole = F.min(F.when(F.col("place") < 0, F.col("first")))
    shorter = F.min(F.when(F.col("place") >= 0, F.col("first")))
    by_variant = earliest.groupBy("v1", "v2").agg(whole.alias("whole"), shorter.alias("shorter"), F.map_from_entries(
        F.collect_list(F.struct("place", "first"))).alias("by_place"), F.count("*").alias("places"))
    met = variants.join(by_variant, ["v1", "v2"]).where(
        (F.col("at") > F.element_at("by_place", F.col("place")))
        | F.when(F.col("place") < 0, F.col("at") > F.col("shorter")).otherwise(F.col("at") > F.col("whole")))
    near = met.select(F.col("at").alias("first")).distinct().withColumn("near", F.lit(True))
    doubtful = distinct.select("fp1", "fp2", "first", "n").join(near, "first", "left").where("n > 1 or near").select(
        "fp1", "fp2", F.when(F.col("near").isNull(), F.col("first")).alias("stays"))
    gone = lines.join(doubtful, ["fp1", "fp2"]).where(~at.eqNullSafe(F.col("stays")))
    return gone.groupBy("key", "text_hash").agg(F.array_sort(F.collect_set("line")).alias("dropped")).withColumnRenamed("key", key)


def dedup_lines(docs: DataFrame, *, key: str = "doc_id", text: str = "text", name: str = "lines") -> DataFrame:
    """Rows (row, n_lines, n_dropped, text): every document, and its text without superfluous lines.

    ``row`` holds the columns of the document as they were. A null text stays null with 0
    lines; a text of which every line is dropped is empty. An empty table gives an
    empty result.
    """
    dropped = dropped_lines(docs, key=key, text=text, name=name).select(
        F.col(key).alias("key_"), F.col("text_hash").alias("hash_"), "dropped")
    rows = docs.select(packed(docs, *(c for c in docs.columns if c != text)).alias("row"), docs[text].alias("text"),
                       docs[key].alias("k_"), F.xxhash64(docs[text]).alias("h_"))
    joined = rows.join(small_side(dropped, f"{name}-dropped"), F.col("k_").eqNullSafe(F.col("key_")) & (F.col("h_") == F.col("hash_")), "left")
    kept = T.StructType([rows.schema["row"], T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()),
                         T.StructField("text", T.StringType())])
    return joined.select("row", "text", "dropped").mapInArrow(_kept, kept)
