"""Quality rules: a decision list learned by sequential covering from labelled statistics.

Rules for "reject" are grown one condition at a time on two thirds of the labelled
documents (most information gained), pruned on the other third (best margin of right
over wrong), and put in order; what a rule covers is taken out before the next one is
grown. Documents that no rule covers are kept. The list is a Spark expression.

All counting is done by Spark over all labelled documents: each step is one
aggregation to at most features x (cuts + 1) rows. Nothing else reaches the driver.
"""

from __future__ import annotations

import itertools
import math
from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelweave.llm.common import WORD, let, packed
from panelweave.session import stage

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
FEATURES = (
    "n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share",
    "capital_share", "mark_share", "digit_share", "words_a_line",
)
#: Quantiles of each feature that cuts lie between, as many again of rejected documents; conditions of a rule, and rules.
CUTS, MOST_CONDITIONS, MOST_RULES = 24, 4, 12
#: Values that the sketch for the most frequent one keeps track of.
TRACKED = 4096
LEAST_COVERED, LEAST_PRECISION = 3, 0.6


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of five words found twice or more, the first finding included.

    Windows are compared by 64-bit hash within a document. Documents whose windows all
    differ end there; else equal neighbours in hash order mark the repeated windows.
    """
    def covered(hashes):
        order = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        marked = let(order, lambda s: F.sort_array(F.filter(F.transform(s, lambda x, i: F.when(
            (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]), x["i"])), lambda p: p.isNotNull())))
        start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
        return F.aggregate(marked, start, lambda acc, p: F.struct(
            (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n"), p.alias("last")))["n"]

    hashes = F.when(F.size(words) >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.size(words) - WINDOW + 1), lambda i: F.xxhash64(F.slice(words, i, WINDOW))
    )).otherwise(F.array().cast("array<bigint>"))
    return let(hashes, lambda h: F.when(F.size(h) == F.size(F.array_distinct(h)), 0).otherwise(covered(h)))


def statistics(docs: DataFrame, *, text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Rows (row, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, features).

    Null and empty texts count no words and fail the base rule.
    """
    body = F.coalesce(docs[text], F.lit(""))
    parts = docs.select(
        packed(docs, *carry).alias("row"), body.alias("body"),
        F.regexp_extract_all(body, F.lit(WORD), F.lit(0)).alias("words"),
        F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    only = lambda keep: F.length(F.regexp_replace("body", f"[^{keep}]+", ""))
    counted = parts.select(
        "row", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("body") - F.length(F.translate("body", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.size(F.array_distinct("words")).alias("n_distinct"),
        only(r"\p{Lu}").alias("n_capitals"), only("!?").alias("n_marks"), only("0-9").alias("n_digits"),
    )
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))
    values = {
        "n_words": F.col("n_words").cast("double"), "mean_word": share("word_chars", "n_words"),
        "symbol_share": share("n_symbols", "word_chars"), "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"), "distinct_share": share("n_distinct", "n_words"),
        "capital_share": share("n_capitals", "word_chars"), "mark_share": share("n_marks", "word_chars"),
        "digit_share": share("n_digits", "word_chars"), "words_a_line": share("n_words", "n_lines"),
    }
    return counted.select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))).alias("base_failed"),
        F.struct(*(values[f].alias(f) for f in FEATURES)).alias("features"),
    )


@dataclass(frozen=True)
class Condition:
    """``feature > cut`` or ``feature <= cut``; ``bin`` is the number of cuts below values that pass."""

    feature: str
    above: bool
    cut: float
    bin: int

    def expression(self, value: Column) -> Column:
        return value > self.cut if self.above else value <= self.cut

    def on_bins(self) -> Column:
        bin_ = F.get("bins", F.lit(FEATURES.index(self.feature)))
        return bin_ >= self.bin if self.above else bin_ < self.bin

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


@dataclass
class DecisionList:
    """Rules for rejection in order; documents that none covers are kept."""

    rules: list[tuple[Condition, ...]] = field(default_factory=list)

    def decide(self, on_rule, default: Column) -> Column:
        out = None
        for rule in self.rules:
            covered = F.lit(True)
            for condition in rule:
                covered = covered & condition.expression(F.col(f"features.{condition.feature}"))
            out = F.when(covered, on_rule(rule)) if out is None else out.when(covered, on_rule(rule))
        return default if out is None else out.otherwise(default)

    def kept(self) -> Column:
        return self.decide(lambda _: F.lit(False), F.lit(True))

    def reason(self) -> Column:
        return self.decide(lambda rule: F.lit(" and ".join(map(str, rule))), F.lit(None).cast("string"))


def _gain(hit: int, miss: int, hit0: int, miss0: int) -> float:
    return hit * (math.log2(hit / (hit + miss)) - math.log2(hit0 / (hit0 + miss0))) if hit else 0.0


def cuts_of(labelled: DataFrame) -> dict[str, list[float]]:
    """Values of each feature that conditions may compare with, half way between neighbouring marks.

    Marks are the most frequent value, quantiles of all others (a feature that is mostly zero would have one
    quantile else), and quantiles of the bad rows, which may be few. A rule keeps its distance from either side.
    """
    wanted = F.array(*(F.lit(i / CUTS) for i in range(CUTS + 1)))
    top = labelled.select(*(F.expr(f"approx_top_k(features.{f}, 1, {TRACKED})").alias(f) for f in FEATURES)).first()
    common = {f: top[f][0]["item"] if top[f] else None for f in FEATURES}
    found = labelled.select(*(
        F.percentile_approx(F.when(keep, F.col(f"features.{f}")), wanted, F.lit(10_000)).alias(f"{side} {f}")
        for f in FEATURES for side, keep in (("other", F.col(f"features.{f}") != F.lit(common[f])), ("bad", ~F.col("good"))))).first()
    marks = {f: sorted({*(found[f"other {f}"] or ()), *(found[f"bad {f}"] or ()), *([] if common[f] is None else [common[f]])}) for f in FEATURES}
    return {f: [(a + b) / 2 for a, b in itertools.pairwise(values)] for f, values in marks.items()}


def learn(labelled: DataFrame, name: str = "rules") -> DecisionList:
    """Learn from rows (key, features, good: boolean). Without a bad row the list is empty."""
    cuts = cuts_of(labelled)

    def passed(f: str) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, cuts[f])).cast("array<double>"), lambda cut: F.col(f"features.{f}") > cut))

    bins = F.array(*map(passed, FEATURES))
    counts = stage(
        labelled.select(bins.alias("bins"), (F.pmod(F.xxhash64("key"), F.lit(3)) == 0).alias("pruning"), "good")
        .groupBy("bins", "pruning", "good").agg(F.count("*").alias("n")), f"{name}-counts")
    learned = DecisionList()

    def covers(rule) -> Column:
        out = F.lit(True)
        for condition in rule:
            out = out & condition.on_bins()
        return out

    def left() -> DataFrame:
        out = counts
        for rule in learned.rules:
            out = out.where(~covers(rule))
        return out

    def grown(rows: DataFrame) -> tuple[Condition, ...]:
        rule: tuple[Condition, ...] = ()
        while len(rule) < MOST_CONDITIONS:
            histogram = defaultdict(lambda: [0, 0])
            cells = rows.where(~F.col("pruning") & covers(rule)).select("good", "n", F.posexplode("bins").alias("f", "bin"))
            for r in cells.groupBy("f", "bin", "good").agg(F.sum("n").alias("n")).collect():
                histogram[r.f, r.bin][int(r.good)] += r.n
            bad0 = sum(v[0] for (f, _), v in histogram.items() if f == 0)
            good0 = sum(v[1] for (f, _), v in histogram.items() if f == 0)
            if not bad0 or not good0:
                return rule
            best, most = None, 1e-9
            for f, feature in enumerate(FEATURES):
                bad = good = 0
                for i, cut in enumerate(cuts[feature], 1):
                    below = histogram.get((f, i - 1), (0, 0))
                    bad, good = bad + below[0], good + below[1]
                    for above, hit, miss in ((False, bad, good), (True, bad0 - bad, good0 - good)):
                        if (gain := _gain(hit, miss, bad0, good0)) > most:
                            best, most = Condition(feature, above, cut, i), gain
            if best is None:
                return rule
            rule += (best,)
        return rule

    while len(learned.rules) < MOST_RULES:
        rows = left()
        rule = grown(rows)
        if not rule:
            break
        prefixes = [rule[:i] for i in range(1, len(rule) + 1)]
        when = lambda keep: F.coalesce(F.sum(F.when(keep, F.col("n"))), F.lit(0))
        held = rows.select(*(
            when(F.col("pruning") & covers(p) & (F.col("good") == good)).alias(f"{side}{i}")
            for i, p in enumerate(prefixes) for side, good in (("bad", False), ("good", True))
        ), *(when(covers(p) & ~F.col("good")).alias(f"all{i}") for i, p in enumerate(prefixes))).first()
        margin = lambda i: (held[f"bad{i}"] - held[f"good{i}"]) / max(1, held[f"bad{i}"] + held[f"good{i}"])
        best = max(range(len(prefixes)), key=lambda i: (margin(i), held[f"bad{i}"], -i))
        right, wrong = held[f"bad{best}"], held[f"good{best}"]
        if right < LEAST_PRECISION * (right + wrong) or not right or held[f"all{best}"] < LEAST_COVERED:
            break
        learned.rules.append(prefixes[best])
    return learned


def judge(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality",
          carry: tuple[str, ...] = (), name: str = "rules") -> tuple[DataFrame, DecisionList]:
    """Every document with its statistics, ``kept`` and ``reason``, and the list that was learned.

    Learned from the labelled documents that pass the base rule. A document labelled
    both ways counts as good; null labels and keys teach nothing. Rows that repeat a
    key are judged each by its own text. Without documents the result is empty.
    """
    carried = carry or tuple(docs.columns)
    known = stage(statistics(docs, text=text, carry=carried if key in carried else (*carried, key)), name)
    good = labels.where(F.col(label).isNotNull()).groupBy(F.col(key).alias("labelled")).agg(
        (F.max(label) > 0).alias("good"))
    taught = known.where(~F.col("base_failed")).select(F.col("row")[key].alias("key"), "features").join(
        good, F.col("key") == F.col("labelled")).select("key", "features", "good")
    learned = learn(taught, name)
    verdict = ~F.col("base_failed") & learned.kept()
    return known.withColumns({"kept": verdict, "reason": F.when(
        F.col("base_failed"), "base").otherwise(learned.reason())}), learned
