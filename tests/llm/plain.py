"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII = {i: i + 32 for i in range(65, 91)}

EXTRA = "lang string, source string, n_chars long, node long, sig long, tag long, key string, part int, ranges string, rest string, hub long, copies int, `text_a` string, _c0 string"


def documents(spark, rows, lang="en"):
    """Rows of (doc_id, text) or (doc_id, text, source) among columns whose names the operators use inside."""
    full = []
    for row in rows:
        doc_id, text, source = (*row, "s")[:3]
        full.append((doc_id, text, lang, source, len(text or ""), 1, 2, 3, "k", 4, "r", "q", 5, 6, "a", "c"))
    return spark.createDataFrame(full, "doc_id long, text string, " + EXTRA)


def words(text):
    return WORD.findall(text or "")


def shingles(text, size=5):
    w = words((text or "").translate(ASCII))
    if len(w) >= size:
        return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    return frozenset([tuple(w)] if w else [])


class Groups:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, a):
        while self.up[a] != a:
            a = self.up[a]
        return a

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def similar(texts):
    """doc_id -> smallest doc_id reachable by links of similarity 0.8."""
    sets = {k: shingles(v) for k, v in texts.items()}
    holders = defaultdict(list)
    for k, s in sets.items():
        for f in s:
            holders[f].append(k)
    groups = Groups(texts)
    for k, s in sets.items():
        common = Counter(o for f in s for o in holders[f] if o < k)
        for o, n in common.items():
            if 100 * n >= 80 * (len(s) + len(sets[o]) - n):
                groups.join(k, o)
    return {k: groups.find(k) for k in texts}


def without_passages(texts, size=50):
    """doc_id -> kept words, and which words go."""
    split = {k: words(v) for k, v in texts.items()}
    first = {}
    for k in sorted(split):
        w = split[k]
        for i in range(len(w) - size + 1):
            first.setdefault(tuple(w[i : i + size]), k)
    out = {}
    for k, w in split.items():
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < k:
                gone[i : i + size] = [True] * size
        out[k] = [x for x, g in zip(w, gone) if not g], sum(gone)
    return out


def without_boilerplate(rows, ratio, least):
    """(site, text) rows -> texts."""
    pages, counts = Counter(), Counter()
    for site, text in rows:
        pages[site] += 1
        counts.update({(site, x.strip(" ")) for x in (text or "").split("\n") if x.strip(" ")})
    out = []
    for site, text in rows:
        over = lambda x: counts[site, x] >= least and counts[site, x] > ratio * pages[site]
        out.append(None if text is None else "\n".join(x for x in text.split("\n") if not over(x.strip(" "))))
    return out
