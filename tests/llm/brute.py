"""Plain versions of the operators over lists of rows, to compare with."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def shingle_set(text, n=2):
    w = words(lowered(text))
    if not w:
        return frozenset()
    n = min(n, len(w))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def near_duplicates(docs, n=2, percent=80):
    """{doc_id: (n_shingles, component_id, kept)} by comparing all pairs that share a shingle."""
    sets = {d: shingle_set(t, n) for d, t in docs}
    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    common = Counter()
    for of in holders.values():
        for i, a in enumerate(of):
            for b in of[i + 1 :]:
                common[a, b] += 1
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), inter in common.items():
        if 100 * inter >= percent * (len(sets[a]) + len(sets[b]) - inter):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {d: (len(s), root(d), root(d) == d) for d, s in sets.items()}


def repeats(docs, width=50):
    """{doc_id: (n_words, n_removed, kept words joined)}."""
    first = {}
    lists = {d: words(t) for d, t in docs}
    for d, w in lists.items():
        for i in range(len(w) - width + 1):
            x = tuple(w[i : i + width])
            first[x] = min(d, first.get(x, d))
    out = {}
    for d, w in lists.items():
        gone = set()
        for i in range(len(w) - width + 1):
            if first[tuple(w[i : i + width])] < d:
                gone.update(range(i, i + width))
        out[d] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    windows = Counter(zip(w, w[1:], w[2:]))
    again = set()
    for i, x in enumerate(zip(w, w[1:], w[2:])):
        if windows[x] > 1:
            again |= {i, i + 1, i + 2}
    return (
        len(w),
        sum(map(len, w)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(again),
    )


ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def base_secrets(text):
    """(n_assign, n_access, n_hex, digest)."""
    text = text or ""
    found = {
        "assign": [m.span() for m in ASSIGN.finditer(text) if len(m[2]) >= 6],
        "access": [m.span() for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20],
        "hex": [m.span() for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 24],
    }
    order = list(found)
    spans = sorted((a, order.index(k), b) for k in found for a, b in found[k])
    line = ",".join(f"{order[k]}:{a}:{b}" for a, k, b in spans)
    return (*[len(v) for v in found.values()], hashlib.sha256(line.encode()).hexdigest())


def backoff(docs, order=3, alpha=0.4):
    """One (n_words, log_score, backed_off, unseen) per row, in order."""
    lists = [words(lowered(t)) for _, t in docs]

    def grams(w):
        return Counter(tuple(w[i : i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1))

    all_grams = Counter()
    for w in lists:
        all_grams.update(grams(w))
    total = sum(map(len, lists))
    out = []
    for w in lists:
        own = grams(w)
        score, backed, unseen = 0.0, 0, 0
        for i in range(len(w)):
            top = min(i + 1, order)
            for n in range(top, 0, -1):
                g = tuple(w[i - n + 1 : i + 1])
                c = all_grams[g] - own[g]
                if c:
                    under = all_grams[g[:-1]] - own[g[:-1]] if n > 1 else total - len(w)
                    score += math.log(c / under * alpha ** (top - n))
                    backed += n < top
                    break
            else:
                score += math.log(alpha ** (top - 1) / (total + 1))
                backed += 1
                unseen += 1
        out.append((len(w), score, backed, unseen))
    return out


def best_fit_decreasing(counts, capacity):
    """How many bins best-fit decreasing needs."""
    gaps = Counter()
    bins = 0
    for n in sorted(counts, reverse=True):
        for _ in range(counts[n]):
            gap = min((g for g in gaps if g >= n), default=None)
            if gap is None:
                bins, gap = bins + 1, capacity
            else:
                gaps[gap] -= 1
                if not gaps[gap]:
                    del gaps[gap]
            gaps[gap - n] += 1
    return bins
