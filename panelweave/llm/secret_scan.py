"""Secret scan: fixed patterns, and a battery of randomness tests for everything else.

A token that looks like a key is tested for what a generated key is: even use of its
alphabet (chi-squared), no runs above or below the middle of the alphabet (runs test)
and no link between neighbours (serial correlation). The three p-values are combined
(Fisher) into one for "drawn evenly from its alphabet". Written language fails.

False discoveries are held down in two ways, over all tokens of a family (alphabet and
length band):

* What is reported is controlled by e-values (the e-BH procedure). The e-value of a token is how
  many times likelier an even draw from its alphabet is than ordinary text in the same
  alphabet: words, names, paths and numbers, in which case and kind of sign seldom change, vowels
  and consonants alternate and letters have the frequencies of language. Of such text the
  mean e-value is 1. Of m tokens the k with the largest are reported, k the largest number with all of
  them at m / (q k) or more; then ordinary text makes up a share q of the reported at most, on average. That depends on
  the share of keys among tokens, not on the size of the corpus: a corpus written twice gives the same.
* Of those, Benjamini-Hochberg on the battery's p-values takes out the ones that are not even.

E-values count in steps of a tenth of their logarithm, rounded down, p-values in steps of 1/1000 of a decade,
rounded up, so the counts that the procedures need are tables of bounded size whatever the corpus.

Every step is a DataFrame expression. No text is cut, no token dropped.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelweave.llm.common import let, packed
from panelweave.session import stage

# The patterns of known secrets, and the least length of what they find.
ASSIGN = (
    r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
ASSIGN_VALUE, ACCESS_LENGTH = 6, 20

# An equals sign ends a token as padding, so that NAME=value is two tokens.
TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
# Alphabets in the order in which they are tried, with their symbols in order.
ALPHABETS = (
    ("digits", r"^[0-9]+$", "0123456789"),
    ("hex", r"^[0-9a-f]+$", "0123456789abcdef"),
    ("HEX", r"^[0-9A-F]+$", "0123456789ABCDEF"),
    ("base32", r"^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("lower", r"^[a-z]+$", "abcdefghijklmnopqrstuvwxyz"),
    ("base36", r"^[0-9a-z]+$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base62", r"^[0-9A-Za-z]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", r"^[0-9A-Za-z+/_-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"),
)
# Ordinary text. Letters by their largest share in English, French, German and Spanish, so that what
# is rare in one of them tells nothing; the chance of each kind of symbol after another, and that a letter is a
# vowel after a vowel, a consonant or no letter.
LETTERS = dict(zip("abcdefghijklmnopqrstuvwxyz", (
    11.5, 2.2, 4, 5.1, 16.4, 2.2, 3, 6.1, 7.5, 0.6, 1.4, 5.5, 3.2, 9.8, 8.7, 2.5, 1.4, 7, 8, 9.1, 6.3, 1.8, 2.4, 0.4, 2, 1.1), strict=True))
KIND_AFTER = {
    "start": {"lower": 0.60, "upper": 0.25, "digit": 0.10, "sign": 0.05},
    "lower": {"lower": 0.88, "upper": 0.05, "digit": 0.02, "sign": 0.05},
    "upper": {"lower": 0.55, "upper": 0.40, "digit": 0.02, "sign": 0.03},
    "digit": {"lower": 0.06, "upper": 0.03, "digit": 0.83, "sign": 0.08},
    "sign": {"lower": 0.50, "upper": 0.20, "digit": 0.15, "sign": 0.15},
}
#: The two styles of ordinary text, even odds each: capitals at the start of words, and whole words of them.
STYLES = (KIND_AFTER, KIND_AFTER | {"upper": {"lower": 0.05, "upper": 0.82, "digit": 0.04, "sign": 0.09}})
VOWEL_AFTER = {"vowel": 0.15, "consonant": 0.55, "": 0.38}
GROUPS = (("start", ""), ("lower", "vowel"), ("lower", "consonant"), ("upper", "vowel"), ("upper", "consonant"), ("digit", ""), ("sign", ""))
FALSE_SHARE = 0.01
STEPS = 1000
LEAST_P = 1e-30
#: Steps of the logarithm of an e-value, which is cut off at this size: no family needs more to report.
E_STEPS, MOST_E = 10, 100
#: Matches of a text that are gone through at a time.
RUN = 256


def scanned(parts: Column, zero: Column, step, nothing: Column, emit) -> Column:
    """``emit(state before, x)``, an array, for each x of ``parts``, joined; the state goes on by ``step(state, x)``.

    An array that grows by one is copied each time, so runs of RUN are gone through by themselves, from the state that
    the runs before them leave: the work is in proportion to the number of parts.
    """
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / RUN).cast("int")),
                       lambda i: F.slice(parts, i * RUN + 1, F.lit(RUN)))

    def within(start, run):
        first = F.struct(start.alias("state"), nothing.alias("out"))
        return F.aggregate(run, first, lambda acc, x: F.struct(
            step(acc["state"], x).alias("state"), F.concat(acc["out"], emit(acc["state"], x)).alias("out")))["out"]

    def joined(all_runs):
        begins = F.struct(zero.alias("state"), F.array(zero).alias("at"))
        starts = F.aggregate(all_runs, begins, lambda acc, run: let(F.aggregate(run, acc["state"], step), lambda state: F.struct(
            state.alias("state"), F.concat(acc["at"], F.array(state)).alias("at"))))["at"]
        return let(starts, lambda at: F.flatten(F.transform(all_runs, lambda run, i: within(F.get(at, i), run))))

    return F.when(F.size(parts) > 0, let(runs, joined)).otherwise(nothing)


def spans(text: Column, pattern: str, kind: int, keep=None) -> Column:
    """Array of (start, kind, end, hit) of the non-overlapping matches, in code points.

    ``split`` gives what stands between the matches, so both lists together give the
    positions. Texts without a match skip both.
    """
    def emit(at, x):
        start = at + F.length(x["gap"])
        hit = F.array(F.struct(
            start.cast("bigint").alias("start"), F.lit(kind).alias("kind"), (start + F.length(x["hit"])).cast("bigint").alias("end"),
            x["hit"].alias("hit")))
        return hit if keep is None else F.when(keep(x["hit"]), hit).otherwise(NOTHING())

    def walk(hits):
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits))
        parts = F.zip_with(gaps, hits, lambda g, h: F.struct(g.alias("gap"), h.alias("hit")))
        ahead = lambda at, x: at + F.length(x["gap"]) + F.length(x["hit"])
        return let(parts, lambda found: scanned(found, F.lit(0).cast("bigint"), ahead, NOTHING(), emit))

    return F.when(text.rlike(pattern), let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), walk)).otherwise(NOTHING())


def NOTHING() -> Column:  # noqa: N802
    """No spans."""
    return F.array().cast("array<struct<start:bigint,kind:int,end:bigint,hit:string>>")


def free_of(tokens: Column, known: Column) -> Column:
    """The tokens that overlap none of the known spans, by two passes over both in order of their starts.

    From the left a token meets the furthest end of the spans that begin no later, from the right the nearest start of
    those that begin later.
    """
    is_token = lambda s: s["kind"] == 3
    one = lambda s, met: F.when(is_token(s) & ~met, F.array(s)).otherwise(NOTHING())

    def from_left(both):
        return scanned(both, F.lit(-1).cast("bigint"), lambda end, s: F.when(is_token(s), end).otherwise(F.greatest(end, s["end"])),
                       NOTHING(), lambda end, s: one(s, end > s["start"]))

    def from_right(both):
        return scanned(both, F.lit(1 << 62).cast("bigint"), lambda start, s: F.when(is_token(s), start).otherwise(s["start"]),
                       NOTHING(), lambda start, s: one(s, start < s["end"]))

    # known spans sort before tokens that begin with them
    left = let(F.array_sort(F.concat(known, tokens)), from_left)
    right = let(left, lambda kept: let(F.reverse(F.array_sort(F.concat(known, kept))), from_right))
    return F.when((F.size(known) == 0) | (F.size(tokens) == 0), tokens).otherwise(F.reverse(right))


def known_spans(text: Column) -> Column:
    value = lambda hit: F.length(F.regexp_extract(hit, ASSIGN, 1)) >= ASSIGN_VALUE
    long_enough = lambda hit: F.length(hit) >= ACCESS_LENGTH
    return F.concat(
        spans(text, ASSIGN, 0, value), spans(text, ACCESS, 1, long_enough), spans(text, HEX, 2))


def digest(found: Column) -> Column:
    """kind:start:end by start, then kind, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.sort_array(found), lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def normal_tail(z: Column) -> Column:
    """Upper tail of the standard normal for z >= 0 (a polynomial, good to 1e-7)."""
    t = 1 / (1 + 0.2316419 * z)
    # Coefficients of the polynomial approximation.
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * series


def upper_tail(z: Column) -> Column:
    return F.when(z >= 0, normal_tail(F.least(z, F.lit(37.0)))).otherwise(1 - normal_tail(F.least(-z, F.lit(37.0))))


def chi_squared_tail(x: Column, df: Column) -> Column:
    """Upper tail by the cube-root transformation to a normal."""
    spread = 2 / (9 * df)
    return upper_tail((F.pow(x / df, F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread))


def alphabet_of(core: Column) -> Column:
    which = F.lit(None).cast("int")
    for i, (_, pattern, _) in reversed(list(enumerate(ALPHABETS))):
        which = F.when(core.rlike(pattern), i).otherwise(which)
    return which


def places(core: Column, alphabet: Column) -> Column:
    """Position of every symbol in its alphabet; the last two signs of base64 have two spellings each."""
    letters = F.array(*(F.lit(symbols) for _, _, symbols in ALPHABETS))
    at = lambda c: F.instr(F.get(letters, alphabet), c)
    return F.transform(F.filter(F.split(core, ""), lambda c: c != ""), lambda c: (
        F.when(at(c) > 64, at(c) - 2).otherwise(at(c))).cast("double"))


def total(values: Column, value=lambda v: v) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + value(v))


def p_even(x: Column, k: Column) -> Column:
    """Chi-squared test that all k symbols are equally frequent."""
    n = F.size(x)
    squares = total(F.array_distinct(x), lambda d: F.pow(F.size(F.filter(x, lambda v: v == d)).cast("double"), F.lit(2.0)))
    return chi_squared_tail(F.greatest(squares * k / n - n, F.lit(0.0)), k - 1)


def p_runs(x: Column, k: Column) -> Column:
    """Runs test on the sides of the middle of the alphabet."""
    n = F.size(x).cast("double")
    high = total(x, lambda v: F.when(v > (k + 1) / 2, 1.0).otherwise(0.0))
    turns = total(F.zip_with(F.slice(x, 1, F.size(x) - 1), F.slice(x, 2, F.size(x) - 1),
                             lambda a, b: F.when((a > (k + 1) / 2) != (b > (k + 1) / 2), 1.0).otherwise(0.0)))
    mean = 2 * high * (n - high) / n + 1
    variance = (mean - 1) * (mean - 2) / (n - 1)
    return F.when(variance > 0, 2 * upper_tail(F.abs(turns + 1 - mean) / F.sqrt(variance))).otherwise(0.0)


def p_serial(x: Column) -> Column:
    """Correlation of neighbours, normal with mean -1/n and variance 1/n for independent symbols."""
    n = F.size(x).cast("double")

    def test(mean):
        spread = total(x, lambda v: (v - mean) * (v - mean))
        joint = total(F.zip_with(F.slice(x, 1, F.size(x) - 1), F.slice(x, 2, F.size(x) - 1),
                                 lambda a, b: (a - mean) * (b - mean)))
        return F.when(spread > 0, 2 * upper_tail(F.abs(joint / spread + 1 / n) * F.sqrt(n))).otherwise(0.0)

    return let(total(x) / n, test)


def combined(*p_values: Column) -> Column:
    """Fisher: -2 times the sum of logarithms of three p-values is chi-squared with six degrees of freedom."""
    half = sum((-F.log(F.greatest(p, F.lit(LEAST_P))) for p in p_values), F.lit(0.0))
    return let(half, lambda h: F.exp(-h) * (1 + h + h * h / 2))


def group_of(symbol: str) -> tuple[str, str]:
    kind = "digit" if symbol.isdigit() else "lower" if symbol.islower() else "upper" if symbol.isupper() else "sign"
    return kind, "" if kind in ("digit", "sign") else "vowel" if symbol.lower() in "aeiou" else "consonant"


def ordinary_text(kind_after: dict[str, dict[str, float]]) -> tuple[list[int], list[float], list[float]]:
    """Tables of the negative logarithm of the chance of a symbol, given the group of the one before, in ordinary text.

    By alphabet and position the group of the symbol and the part that it adds within its
    group; by alphabet, group before and group the part of the change. Chances add up to
    one over each alphabet, so text is compared with text of the same symbols.
    """
    groups, within, change = [], [], []
    for _, _, symbols in ALPHABETS:
        weight = [0.0] * 64
        for i, c in enumerate(symbols):
            weight[i if i < 64 else i - 2] += LETTERS.get(c.lower(), 1.0)
        group = [GROUPS.index(group_of(c)) for c in symbols[:64]]
        mass = [sum(w for w, g in zip(weight, group, strict=False) if g == at) for at in range(len(GROUPS))]
        groups += group + [0] * (64 - len(group))
        within += [-math.log(w / mass[g]) for w, g in zip(weight, group, strict=False)] + [0.0] * (64 - len(group))
        for kind, sound in GROUPS:
            chance = [0.0 if not mass[at] else kind_after[kind][k] * (
                {"vowel": VOWEL_AFTER[sound], "consonant": 1 - VOWEL_AFTER[sound]}.get(s, 1.0)) for at, (k, s) in enumerate(GROUPS)]
            change += [-math.log(c / sum(chance)) if c else 0.0 for c in chance]
    return groups, within, change


def evidence(x: Column, alphabet: Column, k: Column) -> Column:
    """Logarithm of how many times likelier an even draw from the alphabet is than ordinary text."""
    table = lambda values, kind: F.split(F.lit(" ".join(map(str, values))), " ").cast(f"array<{kind}>")
    (groups, within, _), *_ = styles = [ordinary_text(style) for style in STYLES]
    groups, within, n = table(groups, "int"), table(within, "double"), len(GROUPS)
    at = lambda v: alphabet * 64 + v.cast("int") - 1

    def changes(own):
        before = F.concat(F.array(F.lit(0)), F.slice(own, 1, F.size(own) - 1))
        steps = F.zip_with(before, own, lambda a, b: (alphabet * n + a) * n + b)
        return let(steps, lambda found: mean(*(
            total(found, lambda i, change=change: F.get(table(change, "double"), i)) for _, _, change in styles)))

    def mean(a, b):
        return F.least(a, b) - F.log1p(F.exp(-F.abs(a - b))) + math.log(2)

    text = total(x, lambda v: F.get(within, at(v))) + let(F.transform(x, lambda v: F.get(groups, at(v))), changes)
    return text - F.size(x) * F.log(k)


def battery(hit: Column) -> Column:
    """(alphabet, n, level, evidence) of a token; level counts steps of log10 of the combined p-value, rounded down.

    Padding at the end does not count. Undefined tests (no variation) count as failed.
    """
    size = F.array(*(F.lit(float(min(len(symbols), 64))) for _, _, symbols in ALPHABETS))

    def tests(core, alphabet, x):
        k = F.get(size, alphabet)
        p = combined(p_even(x, k), p_runs(x, k), p_serial(x))
        level = F.floor(-F.log10(F.greatest(p, F.lit(LEAST_P))) * STEPS)
        return F.struct(alphabet.alias("alphabet"), F.size(x).alias("n"), level.cast("int").alias("level"),
                        evidence(x, alphabet, k).alias("evidence"))

    return let(F.regexp_replace(hit, "=+$", ""), lambda core: let(alphabet_of(core), lambda alphabet: let(
        places(core, alphabet), lambda x: tests(core, alphabet, x))))


def band(n: Column) -> Column:
    return F.floor(4 * F.log2(n)).cast("int")


def thresholds(tokens: DataFrame) -> dict[tuple[int, int], int]:
    """Per family the level of the critical p-value q R / m of Benjamini-Hochberg, R being its rejections (or 1).

    What is gathered is one row a family: nine alphabets and four bands for each doubling of length.
    """
    family = [F.col("alphabet"), band(F.col("n")).alias("band")]
    counts = tokens.groupBy(*family, "level").agg(F.count("*").alias("tokens"))
    group = Window.partitionBy("alphabet", "band")
    ranked = counts.withColumn("m", F.sum("tokens").over(group)).withColumn(
        "rank", F.sum("tokens").over(group.orderBy(F.desc("level"))))
    rejected = F.pow(F.lit(10.0), -F.col("level") / STEPS) <= FALSE_SHARE * F.col("rank") / F.col("m")
    found = ranked.groupBy("alphabet", "band").agg(
        F.max(F.when(rejected, F.col("rank"))).alias("rejections"), F.max("m").alias("m"))
    return {
        (r.alphabet, r.band): math.ceil(STEPS * math.log10(r.m / (FALSE_SHARE * (r.rejections or 1)))) for r in found.collect()
    }


def e_step(evidence: Column) -> Column:
    """Logarithm of an e-value in whole steps, rounded down."""
    return F.floor(F.greatest(F.least(evidence, F.lit(float(MOST_E))), F.lit(-float(MOST_E))) * E_STEPS).cast("int")


def e_thresholds(tokens: DataFrame) -> dict[tuple[int, int], int]:
    """Per family the least step that e-BH reports: k is the largest rank whose e-value is m / (q k) or more. Families without one are left out."""
    family = [F.col("alphabet"), band(F.col("n")).alias("band")]
    counts = tokens.groupBy(*family, e_step(F.col("evidence")).alias("step")).agg(F.count("*").alias("tokens"))
    group = Window.partitionBy("alphabet", "band")
    ranked = counts.withColumn("m", F.sum("tokens").over(group)).withColumn("rank", F.sum("tokens").over(group.orderBy(F.desc("step"))))
    enough = F.col("step") / E_STEPS >= F.log(F.col("m") / (FALSE_SHARE * F.col("rank")))
    found = ranked.where(enough).groupBy("alphabet", "band").agg(F.min("step").alias("least"))
    return {(r.alphabet, r.band): r.least for r in found.collect()}


def scan(docs: DataFrame, *, text: str = "text", carry: tuple[str, ...] = (), name: str = "secrets") -> DataFrame:
    """Rows (row, known, random): spans of known kinds and of random tokens, each (start, kind, end, hit).

    Positions are code points, ends exclusive. Random tokens that overlap a known span
    are not reported twice. Null or empty text has no spans; an empty table gives an
    empty result; equal rows get equal spans.
    """
    body = F.coalesce(docs[text], F.lit(""))
    found = docs.select(packed(docs, *carry).alias("row"), known_spans(body).alias("known"),
                        spans(body, TOKEN, 3).alias("tokens"))
    free = free_of(F.col("tokens"), F.col("known"))
    tested = found.select("row", "known", F.transform(free, lambda t: F.struct(
        t.alias("span"), battery(t["hit"]).alias("test"))).alias("tested"))
    tested = stage(tested, name)
    tokens = tested.select(F.explode("tested.test").alias("test")).select("test.*").where("alphabet is not null")
    uneven, likely = thresholds(tokens), e_thresholds(tokens)
    rules = {f"{a}:{b}": (uneven[a, b], least) for (a, b), least in likely.items()}
    if not rules:
        return tested.select("row", "known", F.slice("known", 1, 0).alias("random"))
    rule = F.create_map(*(x for pair, (level, least) in sorted(rules.items()) for x in (
        F.lit(pair), F.struct(F.lit(level).alias("level"), F.lit(least).alias("least")))))

    def random(t):
        test = t["test"]
        own = F.element_at(rule, F.concat_ws(":", test["alphabet"].cast("string"), band(test["n"]).cast("string")))
        # a family without a rule reports nothing
        return test["alphabet"].isNotNull() & F.coalesce(
            (test["level"] < own["level"]) & (e_step(test["evidence"]) >= own["least"]), F.lit(False))

    return tested.select("row", "known", F.transform(F.filter("tested", random), lambda t: t["span"]).alias("random"))
