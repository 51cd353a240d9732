"""The same results by the plainest means, one document or pair at a time."""

import hashlib
import itertools
import math
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[0-9a-z\u0080-\U0010ffff]+")


def shingles(text):
    words = PLAIN.findall((text or "").lower())
    if len(words) < 5:
        return [tuple(words)] if words else []
    return [tuple(words[i:i + 5]) for i in range(len(words) - 4)]


def families(texts):
    """(class, copies, links) for each (id, text), by comparing all pairs of different shingle sets."""
    sets = {i: frozenset(shingles(t)) for i, t in texts}
    by_set = {}
    for i, s in sets.items():
        by_set.setdefault(s, []).append(i)
    worded = [s for s in by_set if s]
    holders = {}
    for n, s in enumerate(worded):
        for x in s:
            holders.setdefault(x, []).append(n)
    shared = Counter(pair for held in holders.values() for pair in itertools.combinations(held, 2))
    root = {s: s for s in worded}

    def find(s):
        while root[s] != s:
            s = root[s]
        return s

    links = Counter()
    for (a, b), n in shared.items():
        a, b = worded[a], worded[b]
        if n >= 0.8 * (len(a) + len(b) - n) - 1e-9:
            links[a] += 1
            links[b] += 1
            root[find(b)] = find(a)
    least = {}
    for s in worded:
        least[find(s)] = min(least.get(find(s), math.inf), *by_set[s])
    return {i: (least[find(s)], len(by_set[s]), links[s]) if s else (i, 1, 0) for i, s in sets.items()}


def leaks(docs, items):
    """(doc, item) -> best similarity, over all windows as long as the item."""
    out = {}
    for (i, text), (j, passage) in itertools.product(docs, items):
        item = shingles(passage)
        if len(PLAIN.findall((passage or "").lower())) < 5:
            continue
        own, need = shingles(text), Counter(item)
        if not set(own) & set(item) or len(PLAIN.findall((text or "").lower())) < 5:
            continue
        for start in range(len(own) - len(item) + 1):
            both = sum((Counter(own[start:start + len(item)]) & need).values())
            similarity = both / (2 * len(item) - both)
            if similarity >= 0.8 - 1e-12:
                out[i, j] = max(out.get((i, j), 0), similarity)
    return out


def statistics(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    inside = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside))


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def known_secrets(text):
    text = text or ""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    order = {"assign": 0, "access": 1, "hex": 2}
    found.sort(key=lambda s: (s[1], order[s[0]]))
    joined = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
    count = Counter(k for k, _, _ in found)
    return count["assign"], count["access"], count["hex"], hashlib.sha256(joined.encode()).hexdigest()


def mix_targets(sizes):
    """Sources by code point, null last; shares handed out again and again until none is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    limit, total = {s: 2 * sizes[s] for s in order}, 1.5 * sum(sizes.values())
    full = set()
    while True:
        left = total - sum(limit[s] for s in full)
        among = sum(weight[s] for s in order if s not in full)
        share = {s: limit[s] if s in full else left * weight[s] / among for s in order}
        over = {s for s in order if share[s] > limit[s] + 1e-9}
        if not over:
            return share
        full |= over


def learn_rules(rows, cuts, most_conditions, most_rules, least_covered, least_precision):
    """Sequential covering over rows (values by feature, pruning, good), every condition tried on every row.

    Rules are tuples of (feature, above, cut).
    """
    import math

    def covers(rule, values):
        return all((values[f] > cut) == above for f, above, cut in rule)

    def counts(rule, part):
        bad = sum(covers(rule, v) and not good for v, _, good in part)
        return bad, sum(covers(rule, v) and good for v, _, good in part)

    rules, left = [], list(rows)
    while len(rules) < most_rules:
        growing, rule = [r for r in left if not r[1]], ()
        while len(rule) < most_conditions:
            bad0, good0 = counts(rule, growing)
            if not bad0 or not good0:
                break
            best, most = None, 1e-9
            for f, values in cuts.items():
                for cut in values:
                    for above in (False, True):
                        bad, good = counts((*rule, (f, above, cut)), growing)
                        gain = bad * (math.log2(bad / (bad + good)) - math.log2(bad0 / (bad0 + good0))) if bad else 0.0
                        if gain > most:
                            best, most = (f, above, cut), gain
            if best is None:
                break
            rule += (best,)
        if not rule:
            break
        held = [r for r in left if r[1]]

        def worth(i, rule=rule, held=held):
            bad, good = counts(rule[:i], held)
            return (bad - good) / max(1, bad + good), bad, -i

        best = max(range(1, len(rule) + 1), key=worth)
        bad, good = counts(rule[:best], held)
        if bad < least_precision * (bad + good) or not bad or counts(rule[:best], left)[0] < least_covered:
            break
        rules.append(rule[:best])
        left = [r for r in left if not covers(rule[:best], r[0])]
    return rules
