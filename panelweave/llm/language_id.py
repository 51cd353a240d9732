"""Language identification: multinomial logistic regression on TF-IDF character n-grams.

* Text is lower-cased and everything but letters becomes a blank. The one to three
  characters from each letter on are hashed to one of DIMENSIONS features; a feature's
  value is its share of the document's n-grams times its inverse document frequency.
* Document frequencies are counted over all documents that may be learned from.
* Weights are learned by FTRL-proximal (follow the regularised leader, with L1 and L2
  penalties) on a bounded sample: every shard of it is passed through by one task and
  the leaders' states are averaged between rounds. L1 leaves most weights zero.
* A temperature, fitted on a part of the sample that no weight has seen, makes the
  score a probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelweave.llm.learning import averaged, shard_of
from panelweave.llm.shingles import pieces
from panelweave.session import stage

BITS = 16
DIMENSIONS = 1 << BITS
ORDERS = 3
#: Documents (about) that weights and temperature are learned from; all, if there are fewer.
SAMPLE = 10_000
ROUNDS, EPOCHS = 2, 1
RATE, BETA, L1, L2 = 0.5, 1.0, 0.002, 0.01
#: Every sixth document of the sample sets the temperature.
CALIBRATION = 6
SCALE = 20.0
CHUNK_BYTES = 1 << 18
#: Tasks that add up the counts of all others.
SLOTS = 16
UNKNOWN = "und"
TEMPERATURES = [2 ** (i / 4) for i in range(-16, 17)]
_FACTORS = np.array([[2654435761, 0, 0], [2246822519, 3266489917, 0], [668265263, 374761393, 2869860233]], dtype=np.uint32)
_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTERS[0]


def grams(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Features of the n-grams that start at each letter, one array for each n, and where documents begin."""
    codes = np.frombuffer("\0\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    is_letter = letters()[codes]
    codes = np.where(is_letter | (codes == 0), codes, np.uint32(32))
    at = np.flatnonzero(is_letter)
    size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 2
    begin = np.searchsorted(at, np.concatenate(([0], np.cumsum(size))))
    out = []
    for factors in _FACTORS:
        h = codes[at] * factors[0]
        for j in (1, 2):
            if factors[j]:
                h = h + codes[at + j] * factors[j]
        h ^= h >> np.uint32(15)
        h *= np.uint32(2654435769)
        out.append((h >> np.uint32(32 - BITS)).astype(np.int32))
    return out, begin


def text_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for piece in pieces(batches, "text", CHUNK_BYTES):
        yield piece, [text or "" for text in piece.column("text").to_pylist()]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a task: how many documents hold each feature, and in the last place how many documents there are."""
    counts = np.zeros(DIMENSIONS + 1, dtype=np.int64)
    for _, texts in text_chunks(batches):
        features, begin = grams(texts)
        for a, b in zip(begin[:-1], begin[1:], strict=True):
            if b > a:
                counts[np.unique(np.concatenate([f[a:b] for f in features]))] += 1
                counts[-1] += 1
    slot = TaskContext.get().partitionId() % SLOTS
    yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([counts.tobytes()], pa.binary())], ["slot", "counts"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(DIMENSIONS + 1, dtype=np.int64)
    for batch in batches:
        for part in batch.column("counts"):
            total += np.frombuffer(part.as_buffer(), dtype=np.int64)
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["counts"])


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """From all documents: tasks count, at most SLOTS tasks add up, and the driver gets an array from each of those."""
    counted = docs.select("text").mapInArrow(_frequencies, "slot int, counts binary")
    added = counted.repartition(SLOTS, "slot").mapInArrow(_added, "counts binary")
    total = np.zeros(DIMENSIONS + 1, dtype=np.int64)
    for row in added.toLocalIterator():
        total += np.frombuffer(row.counts, dtype=np.int64)
    return np.log((total[-1] + 1) / (total[:-1] + 1)) + 1


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / RATE + L2))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def _follow(idf: np.ndarray, classes: int):
    """One pass over a shard; the state is (z, n) for all features and classes, the last feature being constant."""
    def fit(rows: pd.DataFrame, model: list[np.ndarray], round_: int) -> tuple[list[np.ndarray], int]:
        z, n = (p.copy() for p in model)
        rows = rows.sort_values(["order", "text"]).reset_index(drop=True)
        for _ in range(EPOCHS):
            for text, label in zip(rows["text"], rows["label"], strict=True):
                features, begin = grams([text])
                if begin[1] == 0:
                    continue
                found, count = np.unique(np.concatenate(features), return_counts=True)
                x = np.append(SCALE * count / count.sum() * idf[found], 1.0)
                found = np.append(found, DIMENSIONS)
                w = weights(z[found], n[found])
                g = x[:, None] * (_softmax(x @ w) - (np.arange(classes) == label))
                step = (np.sqrt(n[found] + g * g) - np.sqrt(n[found])) / RATE
                z[found] += g - step * w
                n[found] += g * g
        return [z, n], len(rows)

    return fit


@dataclass(frozen=True)
class Model:
    """Languages and the fused table idf x weight; ``bias`` and the temperature that calibrates scores."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Logits, and the number of letters, of every document."""
        features, begin = grams(texts)
        size = np.diff(begin)
        out = np.zeros((len(texts), len(self.languages)))
        worded = np.flatnonzero(size)
        if len(worded):
            for f in features:
                out[worded] += np.add.reduceat(self.table[f], begin[:-1][worded], axis=0, dtype=np.float64)
            out[worded] *= (SCALE / (ORDERS * size[worded]))[:, None]
        return out + self.bias, size


def learn(docs: DataFrame, sample: int = SAMPLE, name: str = "language") -> Model:
    """Learn from rows (key, text, lang). Rows without language or text teach nothing."""
    spark = docs.sparkSession
    taught = docs.where("lang is not null and text is not null").select("key", F.lower("text").alias("text"), "lang")
    counts = {r.lang: r.n for r in taught.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros((DIMENSIONS, 0), dtype=np.float32), np.zeros(0))
    idf = inverse_frequencies(taught)
    share = min(1.0, sample / sum(counts.values()))
    draw = F.pmod(F.xxhash64("key", F.lit("sample")), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    number = F.create_map(*(F.lit(x) for i, lang in enumerate(languages) for x in (lang, i)))
    chosen = stage(taught.where(draw).select(
        F.element_at(number, F.col("lang")).alias("label"), "text", shard_of(F.col("key"), share * sum(counts.values())).alias("shard"),
        F.xxhash64("key", F.lit("order")).alias("order"),
        (F.pmod(F.xxhash64("key", F.lit("calibration")), F.lit(CALIBRATION)) == 0).alias("calibration")), f"{name}-sample")
    start = [np.zeros((DIMENSIONS + 1, len(languages)))] * 2
    z, n = averaged(chosen.where("not calibration"), start, ROUNDS, _follow(idf, len(languages)))
    w = weights(z, n)
    model = Model(languages, (w[:-1] * idf[:, None]).astype(np.float32), w[-1])
    return Model(languages, model.table, model.bias, temperature(chosen.where("calibration"), model, spark))


def temperature(rows: DataFrame, model: Model, spark) -> float:
    """The temperature with the least log loss; losses are summed up by Spark, one number for each candidate."""
    held = spark.sparkContext.broadcast(model)

    def losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(TEMPERATURES))
        for batch, texts in text_chunks(batches):
            logits, size = held.value.logits(texts)
            label = batch.column("label").to_numpy()
            for i, t in enumerate(TEMPERATURES):
                p = _softmax(logits / t)[np.arange(len(label)), label]
                total[i] -= np.log(np.maximum(p, 1e-12))[size > 0].sum()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], ["i", "loss"])

    summed = rows.select("text", "label").mapInArrow(losses, "i int, loss double").groupBy("i").agg(F.sum("loss").alias("loss")).collect()
    best = min(summed, key=lambda r: (round(r.loss, 6), abs(math.log(TEMPERATURES[r.i]))), default=None)
    return TEMPERATURES[best.i] if best is not None and best.loss > 0 else 1.0


def identify(docs: DataFrame, model: Model, *, text: str = "text", carry: tuple[Column, ...] = ()) -> DataFrame:
    """The carried columns as ``row``, with ``lang_pred`` and ``score``, the calibrated probability of it.

    Null texts and texts without a letter are "und" with score 0, as is every text if
    nothing was learned. Rows that repeat each get the same answer; an empty table gives an empty result. Very long
    texts are read as a whole.
    """
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*carry).alias("row"), F.lower(docs[text]).alias("text"))
    out_type = T.StructType([rows.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        for batch, texts in text_chunks(batches):
            logits, size = model.logits(texts)
            known = (size > 0) & bool(model.languages)
            best, score = np.full(len(texts), len(names) - 1), np.zeros(len(texts))
            if known.any():
                p = _softmax(logits[known] / model.temperature)
                best[known], score[known] = p.argmax(1), p.max(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(names[best].tolist(), pa.string()), pa.array(score)], ["row", "lang_pred", "score"])

    return rows.mapInArrow(predict, out_type)
