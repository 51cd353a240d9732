"""Spelling variants: words one edit apart, found by Gram matrices of letter counts.

1. Tasks count the words of their texts; counts of a task are added up by Spark.
2. A word is a vector of letter counts. Two words one edit apart differ by at most two in
   squared distance, and in length by at most one. Letters are dealt to a few classes of about equal
   weight; the counts of the classes name a word's block. An edit moves at most one letter
   from a class to another, so words one edit apart lie in the same block or in one of a
   fixed number of neighbours, of the same length or the next.
3. A word lives in its own block and visits the neighbours on one side, so each pair meets once.
   Blocks are sorted over the cluster and read as a stream: those who live there, then the visitors a batch at
   a time. One matrix product gives all squared distances of a batch; pairs at most two apart are
   compared letter by letter.

A word has at most some thousand words one edit away (places times letters), so pairs that
leave a task grow with the words. A block with very many words is cut into pieces that
all its visitors go to.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.llm.common import small_side
from panelweave.llm.shingles import pieces
from panelweave.session import stage

#: Letters of words, as their Latin-1 bytes: A-Z, a-z and U+00C0 to U+00FF.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LETTERS = bytes([*range(0x61, 0x7B), *range(0xC0, 0x100)])
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: Least length and count of a word; a form has at least so many times the count of its variant.
LENGTH, COUNT, TIMES = 5, 3, 2
#: Classes of letters, words that live in one piece of a block, and entries that a matrix of distances has at most.
CLASSES, LIVING, ENTRIES = 6, 2_048, 1 << 22
#: A task hands its counts on when it holds so many words.
HELD = 500_000

Edit = Callable[[bytes, bytes], bytes]


def _count(edit: Edit | None):
    """Kernel: rows (word, n) from rows (key, text). Words are Latin-1 bytes, lower-cased in A-Z, edited if asked for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        held: Counter = Counter()
        for piece in pieces(batches, "text", 1 << 20):
            for key, text in zip(piece.column("key").to_pylist(), piece.column("text").to_pylist(), strict=True):
                # lower-cased before they are counted: an edit looks at the lower-cased word
                words = Counter(w.encode("latin-1").translate(LOWER) for w in RUN.findall(text or ""))
                if edit is None:
                    held.update(words)
                    continue
                before = (key or "").encode()
                for word, n in words.items():
                    held[edit(before, word)] += n
                if len(held) > HELD:
                    yield out()
                    held = Counter()
        if held:
            yield out()

    return run


def drop_a_letter(every: int = 97) -> Edit:
    """Made misspellings: let h be the crc32 of UTF-8 ``key:word``; where ``every`` divides h, letter h % length goes."""
    def edit(before: bytes, word: bytes) -> bytes:
        h = zlib.crc32(before + b":" + (word if word.isascii() else word.decode("latin-1").encode()))
        if h % every:
            return word
        at = h % len(word)
        return word[:at] + word[at + 1:]

    return edit


def count_words(docs: DataFrame, *, key: str = "doc_id", text: str = "text", edit: Edit | None = None) -> DataFrame:
    """Rows (word, n): the maximal runs of letters of whole texts, lower-cased in A-Z and edited, and how often they occur."""
    body = docs.select(docs[key].cast("string").alias("key"), docs[text].alias("text")).where(F.col("text").isNotNull())
    return body.mapInArrow(_count(edit), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


_COLUMN = np.zeros(256, dtype=np.int64)
_COLUMN[list(LETTERS)] = np.arange(len(LETTERS))


def letter_counts(words: list[bytes]) -> np.ndarray:
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    letters = _COLUMN[np.frombuffer(b"".join(words), dtype=np.uint8)]
    at = np.repeat(np.arange(len(words)), lengths) * len(LETTERS) + letters
    return np.bincount(at, minlength=len(words) * len(LETTERS)).reshape(len(words), -1)


def _letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kernel: how many times each letter occurs in the words of a task."""
    total = np.zeros(len(LETTERS), dtype=np.int64)
    for batch in batches:
        for start in range(0, batch.num_rows, 4096):
            total += letter_counts(batch.column("word").slice(start, 4096).to_pylist()).sum(0)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(LETTERS))), pa.array(total)], ["letter", "n"])


def classes_of(weights: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """Class of each letter: the heaviest letter goes to the lightest class, and so on."""
    load, of = np.zeros(classes), np.zeros(len(weights), dtype=np.int64)
    for letter in np.argsort(-weights, kind="stable"):
        of[letter] = load.argmin()
        load[of[letter]] += weights[letter] + 1e-9
    return of


#: A block's number is a sum over its letters; each class counts with an odd 64-bit number.
_NUMBER = np.random.default_rng(13).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _moves(classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Steps (moves, classes) from a word's block to those it visits, and whether the words there are one shorter.

    One letter less of a class; or one less of a class and one more of a later one.
    """
    unit = np.eye(classes, dtype=np.int64)
    less = [-unit[i] for i in range(classes)]
    turned = [unit[j] - unit[i] for i in range(classes) for j in range(i + 1, classes)]
    return np.array(less + turned), np.array([True] * len(less) + [False] * len(turned))


def _blocks(of: np.ndarray, classes: int):
    """Kernel: rows (word, n) with the length, the number of the word's block and those of the blocks it visits."""
    steps, shorter = _moves(classes)
    shift = (steps.astype(np.uint64) * _NUMBER[:classes]).sum(1, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                piece = batch.slice(start, 4096)
                words = piece.column("word").to_pylist()
                counts = letter_counts(words).astype(np.uint64)
                home = (counts * _NUMBER[of]).sum(1, dtype=np.uint64)
                visits = (home[:, None] + shift[None, :]).view(np.int64)
                lengths = np.array([len(w) for w in words], dtype=np.int32)
                n, moves = visits.shape
                at = pa.array(np.arange(n + 1) * moves, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, pa.array(lengths), pa.array(home.view(np.int64)), pa.ListArray.from_arrays(at, pa.array(visits.ravel()))],
                    [*piece.schema.names, "length", "home", "visits"])

    return run


def _codes(words: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(words), dtype=np.uint8).reshape(len(words), width)


def one_edit(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For rows of letters of equal width: exactly one differs; else: one letter put into ``short`` gives ``long``."""
    width = short.shape[1]
    if long.shape[1] == width:
        return (short != long).sum(1) == 1
    first = np.cumprod(short == long[:, :width], axis=1).sum(1)
    last = np.cumprod((short == long[:, 1:])[:, ::-1], axis=1).sum(1)
    return first + last >= width


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All squared distances of the rows of ``a`` and ``b`` by one product; exact for counts below 4096."""
    one = lambda x: np.ones((len(x), 1), dtype=x.dtype)
    square = lambda x: (x * x).sum(1, keepdims=True)
    return np.hstack([a * -2, square(a), one(a)]) @ np.hstack([b, one(b), square(b)]).T


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kernel: near pairs of a sorted stream of (home length, block, piece, role, word, n), both ways round.

    Role 0 lives in this piece; 1 lives elsewhere in the block; 2 and above visit, of the same length or (3) one longer.
    """
    living = None

    def distances(mine, others, kind):
        return np.argwhere(squared_distances(mine.astype(kind), others.astype(kind)) <= 2.5)

    def pairs(words, counts, n, others, other_counts, other_n, role):
        kind = np.float32 if len(words[0]) < 2000 else np.float64
        codes, other = _codes(words, len(words[0])), _codes(others, len(others[0]))
        step = max(1, ENTRIES // (len(words) + len(words[0])))
        for start in range(0, len(others), step):
            found = distances(counts, other_counts[start:start + step], kind)
            i, j = found[:, 0], found[:, 1] + start
            if role < 2:  # of the same block: each pair once
                keep = np.array([words[x] < others[y] for x, y in zip(i.tolist(), j.tolist(), strict=True)], dtype=bool)
                i, j = i[keep], j[keep]
            near = np.zeros(len(i), dtype=bool)
            for at in range(0, len(i), 1 << 16):
                near[at:at + (1 << 16)] = one_edit(codes[i[at:at + (1 << 16)]], other[j[at:at + (1 << 16)]])
            for x, y in zip(i[near].tolist(), j[near].tolist(), strict=True):
                yield words[x], n[x], others[y], other_n[y]

    for batch in batches:
        out = []
        lengths, blocks, parts, roles, n = (
            batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "block", "piece", "role", "n"))
        words = batch.column("word").to_pylist()
        new = np.ones(batch.num_rows, dtype=bool)
        for column in (lengths, blocks, parts, roles):
            new[1:] &= column[1:] == column[:-1]
        starts = np.flatnonzero(~new | (np.arange(len(new)) == 0))
        for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            place, role = (lengths[a], blocks[a], parts[a]), roles[a]
            if role and (living is None or living[0] != place):
                continue  # nobody lives here
            mine, mine_n = words[a:b], n[a:b].tolist()
            counts = letter_counts(mine)
            if role == 0:
                if living is not None and living[0] == place:  # the words of a piece go on in another batch
                    out += pairs(living[1], living[2], living[3], mine, counts, mine_n, 0)
                    out += pairs(mine, counts, mine_n, living[1], living[2], living[3], 0)
                    out += pairs(mine, counts, mine_n, mine, counts, mine_n, 0)
                    living = (place, living[1] + mine, np.vstack([living[2], counts]), living[3] + mine_n)
                else:
                    living = (place, mine, counts, mine_n)
                    out += pairs(mine, counts, mine_n, mine, counts, mine_n, 0)
            else:
                out += pairs(living[1], living[2], living[3], mine, counts, mine_n, role)
        a, a_n, b, b_n = zip(*out, strict=True) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(a + b, pa.binary()), pa.array(b + a, pa.binary()), pa.array(b_n + a_n, pa.int64())], ["word", "near", "near_n"])


def near_words(words: DataFrame, *, classes: int = CLASSES, living: int = LIVING, name: str = "spelling") -> DataFrame:
    """Rows (word, near, near_n), both ways round, for all words of ``words`` (word binary, n) exactly one edit apart.

    ``words`` must be a written table of distinct words of known letters.
    """
    weights = np.zeros(len(LETTERS))
    for r in words.select("word").mapInArrow(_letters, "letter long, n long").groupBy("letter").agg(F.sum("n").alias("n")).collect():
        weights[r.letter] = r.n
    _, shorter = _moves(classes)
    placed = words.select("word", "n").mapInArrow(
        _blocks(classes_of(weights, classes), classes), "word binary, n long, length int, home long, visits array<long>")
    placed = stage(placed, f"{name}-placed")
    # blocks cut into several pieces: one of `living` words or more, so at most words / living of them
    big = placed.groupBy("length", "home").agg(F.count("*").alias("c")).where(F.col("c") > living).select(
        F.col("length").alias("at_length"), F.col("home").alias("at_block"), F.ceil(F.col("c") / living).cast("int").alias("parts"))
    big = small_side(big, f"{name}-big")
    own = placed.select("length", F.col("home").alias("block"), F.lit(0).alias("role"), "word", "n")
    flags = F.array(*(F.lit(bool(s)) for s in shorter))
    visiting = placed.select("length", "word", "n", F.posexplode("visits").alias("move", "block")).select(
        (F.col("length") - F.get(flags, F.col("move")).cast("int")).alias("length"), "block",
        F.when(F.get(flags, F.col("move")), 3).otherwise(2).alias("role"), "word", "n")
    cut = own.unionByName(visiting).join(
        big, (F.col("length") == F.col("at_length")) & (F.col("block") == F.col("at_block")), "left").drop("at_length", "at_block")
    parts = F.coalesce("parts", F.lit(1))
    mine = F.pmod(F.xxhash64("word"), parts).cast("int")
    everywhere = F.explode(F.sequence(F.lit(0), parts - 1)).alias("piece")
    whole = cut.where("parts is null").withColumn("piece", F.lit(0))
    pieced = cut.where("parts is not null").select("*", everywhere).withColumn(
        "role", F.when((F.col("role") == 0) & (F.col("piece") != mine), 1).otherwise(F.col("role")))
    rows = whole.unionByName(pieced).select("length", "block", "piece", "role", "word", "n")
    keys = ["length", "block", "piece"]
    met = rows.repartition(*keys).sortWithinPartitions(*keys, "role")
    return met.mapInArrow(_meet, "word binary, near binary, near_n long")


def roots(forms: DataFrame, name: str = "spelling") -> DataFrame:
    """Rows (word, root) for rows (word, form): forms followed to the last. Pointer doubling; chains must not close."""
    state = stage(forms.select("word", F.col("form").alias("root")), f"{name}-roots")
    while True:
        step = state.alias("a").join(state.alias("b"), F.col("a.root") == F.col("b.word"), "left").select(
            "a.word", F.coalesce("b.root", "a.root").alias("root"), F.col("b.root").isNotNull().alias("moved"))
        moved = stage(step, f"{name}-roots")
        state = moved.select("word", "root")
        if not moved.agg(F.max("moved")).first()[0]:
            return state


def variants(docs: DataFrame, *, key: str = "doc_id", text: str = "text", edit: Edit | None = None, length: int = LENGTH,
             count: int = COUNT, times: int = TIMES, classes: int = CLASSES, living: int = LIVING, name: str = "spelling") -> DataFrame:
    """Rows (word, n, n_near, form, form_n, root) for every word of at least ``length`` letters and ``count`` occurrences.

    ``n_near`` counts the words one inserted, deleted or replaced letter away. ``form`` is the one of them that occurs most (ties:
    the first in code-point order), if it occurs at least ``times`` as often as the word; null otherwise. ``root`` is where
    forms end; the word itself if it has none. ``edit`` changes a word by the key of its document before it is counted.

    Null texts have no words; a null key reads as empty text. Equal rows count as often as they are there. An empty table gives
    no rows. Other columns are not looked at. Texts and words of any length are taken whole.
    """
    if times < 2:
        raise ValueError("forms may go round in circles unless they occur more often")
    counted = count_words(docs, key=key, text=text, edit=edit)
    words = stage(counted.where((F.col("n") >= count) & (F.length("word") >= length)), f"{name}-words")
    near = near_words(words, classes=classes, living=living, name=name)
    best = near.groupBy("word").agg(
        # a set, of at most some thousands: blocks that share a number by chance would show a pair twice
        F.size(F.collect_set("near")).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near").alias("form"))).alias("best"))
    full = words.join(best, "word", "left")
    frequent = -F.col("best.rank") >= times * F.col("n")
    known = stage(full.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(frequent, F.col("best.form")).alias("form"),
        F.when(frequent, -F.col("best.rank")).alias("form_n")), f"{name}-known")
    ends = roots(known.where("form is not null"), name)
    read = lambda c: F.decode(c, "ISO-8859-1")
    return known.join(ends, "word", "left").select(
        read("word").alias("word"), "n", "n_near", read("form").alias("form"), "form_n", read(F.coalesce("root", "word")).alias("root"))
