"""Quality classifier: attention-based multiple-instance learning over the passages of a document.

A document is a bag of passages of PASSAGE words each, all of them encoded: the mean of
learned vectors of its words and of the letters that words begin and end with, hashed to a table of fixed size; and
shares of kinds of characters, lengths, repetition. Only documents have labels. Passages pass a
learned layer, gated attention says how much each counts, and the weighted sum of their
representations is scored by a logistic output. All layers and the table are learned together
on a bounded sample, shard by shard, with models averaged between rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelweave.llm import shingles as S
from panelweave.llm.common import small_side
from panelweave.llm.learning import averaged, shard_of, sigmoid
from panelweave.session import stage

PASSAGE = 64
#: Labelled documents (about) that the model is learned from; all, if there are fewer.
SAMPLE = 12_000
HIDDEN, GATE = 16, 8
#: Rows of the table for words, as many for beginnings and for endings; letters of a beginning or ending.
TABLE, GRAM = 1 << 13, 3
ROUNDS, EPOCHS, BATCHES, LEAST_BATCH, RATE, DECAY = 3, 8, 8, 32, 0.02, 1e-4
#: Step of the table's rows and how they shrink.
TABLE_RATE, TABLE_DECAY = 0.02, 1e-3
SEED = 3
_IN_WORD = np.ones(256, dtype=bool)
_IN_WORD[[32, 9, 10, 11, 12, 13]] = False


def _kind(members: bytes | range) -> np.ndarray:
    table = np.zeros(256, dtype=np.uint8)
    table[list(members)] = 1
    return table


KINDS = (
    _kind(b"#*$%&|<>"), _kind(range(65, 91)), _kind(b"!?"), _kind(range(48, 58)), _kind(b".,;:"), _kind(b"\n"), _kind(range(128, 256)),
    _kind(b"()[]{}\"'/\\@^_`~+=-"),
)
FEATURES = len(KINDS) + 7


_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)


def word_features(text: S.Text) -> np.ndarray:
    """Rows of the table for each word: of itself, of its first GRAM bytes and of its last, in any case."""
    starts, ends = text.starts, text.ends
    last = np.uint64(64 - TABLE.bit_length() + 1)
    out = np.empty((len(starts), 3), dtype=np.int32)
    out[:, 0] = text.hashes() >> last
    for i, (step, edge) in enumerate(((1, starts), (-1, ends - 1)), 1):
        code = np.full(len(starts), i, dtype=np.uint64)
        for j in range(GRAM):
            at = edge + step * j
            inside = (at >= starts) & (at < ends)
            code = code * np.uint64(257) + np.where(inside, _LOWER[text.data[np.where(inside, at, 0)]] + np.uint64(1), np.uint64(0))
        out[:, i] = i * TABLE + (S.mixed(code, 5) >> last).astype(np.int64)
    return out


def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Counted features of all passages, where each document's begin, rows of the table of all words, and where each passage's words begin.

    A document without words is one passage of zeros that has no words.
    """
    text = S.split(texts, _IN_WORD)
    data, starts, ends, first = text.data, text.starts, text.ends, text.first
    words = np.diff(first)
    passages = np.maximum(1, -(-words // PASSAGE))
    begin = np.concatenate(([0], np.cumsum(passages)))
    out = np.zeros((begin[-1], FEATURES), dtype=np.float32)
    rows = word_features(text)
    worded = np.repeat(words > 0, passages)
    edges = np.concatenate((np.minimum(np.repeat(first[:-1], passages) + (np.arange(begin[-1]) - np.repeat(begin[:-1], passages)) * PASSAGE,
                                       len(starts)), [len(starts)]))
    if len(starts) == 0:
        return out, begin, rows, edges
    number = np.arange(begin[-1]) - np.repeat(begin[:-1], passages)
    first_word = (np.repeat(first[:-1], passages) + number * PASSAGE)[worded]
    last_word = np.append(first_word[1:], len(starts))
    n = (last_word - first_word).astype(np.float64)
    at = starts[first_word]
    chars = np.add.reduceat((ends - starts), first_word).astype(np.float64)
    block = out[worded]
    for i, kind in enumerate(KINDS):
        block[:, i] = np.sqrt(np.add.reduceat(kind[data], at, dtype=np.int64) / chars)
    owner = np.repeat(np.arange(len(first_word), dtype=np.uint64), (last_word - first_word))
    head = data[starts].astype(np.uint64)
    word = text.hashes()
    same = np.sort((owner << np.uint64(40)) | (word >> np.uint64(24)))
    new = np.append(True, same[1:] != same[:-1])
    distinct = np.bincount((same[new] >> np.uint64(40)).astype(np.int64), minlength=len(first_word))
    again = np.append(False, (word[1:] == word[:-1]) & (owner[1:] == owner[:-1]))
    k = len(KINDS)
    block[:, k] = distinct / n
    block[:, k + 1] = np.add.reduceat(again.astype(np.int64), first_word) / n
    block[:, k + 2] = np.log(chars / n)
    block[:, k + 3] = np.sqrt(np.add.reduceat((ends - starts >= 16).astype(np.int64), first_word) / n)
    block[:, k + 4] = np.sqrt(np.add.reduceat((ends - starts == 1).astype(np.int64), first_word) / n)
    block[:, k + 5] = np.sqrt(np.add.reduceat(((head >= 65) & (head < 91)).astype(np.int64), first_word) / n)
    block[:, k + 6] = np.log1p(n) / np.log1p(PASSAGE)
    out[worded] = block
    return out, begin, rows, edges


def meanings(table: np.ndarray, rows: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Mean of the vectors of each passage's words; zero for a passage without words."""
    n = np.diff(edges)
    out = np.zeros((len(n), HIDDEN))
    if len(rows):
        vectors = table.take(rows[:, 0], axis=0)
        for i in (1, 2):
            vectors += table.take(rows[:, i], axis=0)
        out[n > 0] = np.add.reduceat(vectors, edges[:-1][n > 0]) / n[n > 0, None]
    return out


def start_model(seed: int = SEED) -> list[np.ndarray]:
    draw = np.random.default_rng(seed)
    scaled = lambda a, b: draw.normal(0, 1 / np.sqrt(a), (a, b))
    return [scaled(FEATURES, HIDDEN), np.zeros(HIDDEN), scaled(HIDDEN, GATE), scaled(HIDDEN, GATE), scaled(GATE, 1)[:, 0],
            scaled(HIDDEN, 1)[:, 0], np.zeros(1), np.zeros((3 * TABLE, HIDDEN))]


def forward(model: list[np.ndarray], x: np.ndarray, begin: np.ndarray, meaning: np.ndarray):
    """Probability for every bag, and what the gradient needs."""
    w, b, v, u, a, c, c0, _ = model
    h = np.tanh(x @ w + b + meaning)
    tv, su = np.tanh(h @ v), sigmoid(h @ u)
    logit = (tv * su) @ a
    size = np.diff(begin)
    top = np.repeat(np.maximum.reduceat(logit, begin[:-1]), size)
    e = np.exp(logit - top)
    weight = e / np.repeat(np.add.reduceat(e, begin[:-1]), size)
    z = np.add.reduceat(weight[:, None] * h, begin[:-1])
    return sigmoid(z @ c + c0[0]), (h, tv, su, weight, z)


def gradient(model: list[np.ndarray], x: np.ndarray, begin: np.ndarray, y: np.ndarray, meaning: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Gradient of the mean log loss: of all layers but the table, and of the passages' meanings."""
    w, b, v, u, a, c, c0, _ = model
    p, (h, tv, su, weight, z) = forward(model, x, begin, meaning)
    size = np.diff(begin)
    d = (p - y) / len(y)
    dz = np.repeat(d[:, None] * c, size, axis=0)
    along = (dz * h).sum(1)
    mean = np.repeat(np.add.reduceat(weight * along, begin[:-1]), size)
    dlogit = weight * (along - mean)
    dtv, dsu = dlogit[:, None] * a * su * (1 - tv * tv), dlogit[:, None] * a * tv * su * (1 - su)
    dh = weight[:, None] * dz + dtv @ v.T + dsu @ u.T
    dx = dh * (1 - h * h)
    return [x.T @ dx, dx.sum(0), h.T @ dtv, h.T @ dsu, (tv * su).T @ dlogit, z.T @ d, np.array([d.sum()])], dx


class _Batch:
    """Bags of one step. ``found``: the table's rows in use; which passage uses each, and where the uses of a row begin."""

    def __init__(self, bags: list[tuple], y: np.ndarray):
        self.x = np.concatenate([b[0] for b in bags]).astype(np.float64)
        self.begin = np.concatenate(([0], np.cumsum([len(b[0]) for b in bags])))
        self.rows = np.concatenate([b[1] for b in bags])
        n = np.concatenate([np.diff(b[2]) for b in bags])
        self.edges, self.y = np.concatenate(([0], np.cumsum(n))), y
        flat = self.rows.ravel()
        order = np.argsort(flat, kind="stable")
        self.found, self.uses = np.unique(flat[order], return_index=True)
        self.passage = np.repeat(np.arange(len(n)), 3 * n)[order]
        self.share = 1.0 / np.maximum(n, 1)

    def table_gradient(self, dx: np.ndarray) -> np.ndarray:
        if not len(self.found):
            return np.zeros((0, HIDDEN), dtype=np.float32)
        return np.add.reduceat((dx * self.share[:, None]).astype(np.float32).take(self.passage, axis=0), self.uses)


def _fit(rows: pd.DataFrame, model: list[np.ndarray], round_: int) -> tuple[list[np.ndarray], int]:
    """Some epochs over a shard: Adam for the layers, Adagrad for the rows of the table that a step uses."""
    rows = rows.sort_values(["order", "bag", "words"]).reset_index(drop=True)
    bags = [(np.frombuffer(b, dtype=np.float32).reshape(-1, FEATURES), np.frombuffer(w, dtype=np.int32).reshape(-1, 3),
             np.frombuffer(e, dtype=np.int64)) for b, w, e in zip(rows["bag"], rows["words"], rows["edges"], strict=True)]
    y = rows["good"].to_numpy(dtype=np.float64)
    batches = max(1, min(BATCHES, len(rows) // LEAST_BATCH))
    steps = [_Batch(bags[i::batches], y[i::batches]) for i in range(batches)]
    model = [p.copy() for p in model]
    layers, table = model[:-1], model[-1].astype(np.float32)
    first, second = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    seen = np.zeros(len(table))
    rate, t, draw = RATE / (1 + round_), 0, np.random.default_rng([SEED, round_, len(rows)])
    # a few batches are gone through as many times as make up the steps of many
    for _ in range(EPOCHS * BATCHES // batches):
        for step in steps:
            t += 1
            # half of the documents go without their words, so that what is counted is learned as well as what is said
            shown = np.repeat(draw.random(len(step.y)) >= 0.5, np.diff(step.begin))[:, None]
            gradients, dx = gradient(model, step.x, step.begin, step.y, shown * meanings(table, step.rows, step.edges))
            for p, m, s, g in zip(layers, first, second, gradients, strict=True):
                g += DECAY * p
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.999 ** t)) + 1e-8)
            g = step.table_gradient(dx * shown)
            # one step size a row; rows that are hardly used move less than the gradient's size would have them
            seen[step.found] += (g * g).mean(1)
            table[step.found] -= TABLE_RATE * (g / np.sqrt(seen[step.found] + 1e-8)[:, None] + TABLE_DECAY * table[step.found])
    return [*layers, table], len(rows)


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in S.chunks(batches, "text"):
        x, begin, rows, edges = encode(texts)
        pairs = list(zip(begin[:-1], begin[1:], strict=True))
        bags = [x[a:b].tobytes() for a, b in pairs]
        words = [rows[edges[a]:edges[b]].tobytes() for a, b in pairs]
        ends = [(edges[a:b + 1] - edges[a]).astype(np.int64).tobytes() for a, b in pairs]
        kept = batch.drop_columns(["text"])
        yield pa.RecordBatch.from_arrays(
            [*kept.columns, *(pa.array(c, pa.binary()) for c in (bags, words, ends))], [*kept.schema.names, "bag", "words", "edges"])


def learn(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality",
          sample: int = SAMPLE, name: str = "quality") -> list[np.ndarray]:
    """The model, from documents and labels (key, 0 or 1); a key labelled both ways counts as 1.

    The sample is drawn from the labels by hash before any text is read. Null keys and
    labels teach nothing; without any the untrained model is returned.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("labelled")).agg(
        (F.max(label) > 0).cast("int").alias("good"))
    n = known.count()
    if not n:
        return start_model()
    share = min(1.0, sample / n)
    drawn = known.where(F.pmod(F.xxhash64("labelled", F.lit("sample")), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    drawn = small_side(drawn, f"{name}-labels")
    rows = docs.select(docs[key].alias("key"), docs[text].alias("text")).join(drawn, F.col("key") == F.col("labelled")).select(
        "good", shard_of(F.col("key"), share * n).alias("shard"), F.xxhash64("key", F.lit("order")).alias("order"), "text")
    bags = stage(rows.mapInArrow(_bags, "good int, shard int, order long, bag binary, words binary, edges binary"), f"{name}-bags")
    return averaged(bags, start_model(), ROUNDS, _fit)


def score(docs: DataFrame, model: list[np.ndarray], *, text: str = "text", carry: tuple[Column, ...] = ()) -> DataFrame:
    """The carried columns as ``row``, with ``score``: the probability of label 1, from all passages of the whole text.

    Null and empty texts are a bag with one empty passage and are scored like any other.
    Rows that repeat each get the same score, whatever their key. An empty table gives an empty result.
    """
    held = docs.sparkSession.sparkContext.broadcast([p.astype(np.float32) if i == len(model) - 1 else p.astype(np.float64) for i, p in enumerate(model)])
    rows = docs.select(F.struct(*carry).alias("row"), docs[text].alias("text"))
    out_type = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in S.chunks(batches, "text"):
            x, begin, words, edges = encode(texts)
            p, _ = forward(held.value, x, begin, meanings(held.value[-1], words, edges))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(p)], ["row", "score"])

    return rows.mapInArrow(predict, out_type)
