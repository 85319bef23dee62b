"""Operator 12 against plain Python."""

import hashlib
import random
from collections import Counter

import numpy as np
import plain
import pytest
from kpiwarden.llm import suffix_dedup
from kpiwarden.llm.suffix_dedup import Transform, anchored_runs, merged_intervals, removal_report, repeats_of, without_repeats

SIZE, ANCHOR = 40, 8


def plainly(rows, size):
    texts = [(i, (t or "").encode()) for i, t in rows]
    stands = Counter(t[a : a + size] for _, t in texts for a in range(len(t) - size + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for a in range(len(t) - size + 1):
            if stands[t[a : a + size]] > 1:
                gone[a : a + size] = b"\1" * size
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(g and not before for g, before in zip(gone, b"\0" + gone))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    def prose(n, letters="abcdefgh ñ日"):
        return "".join(rng.choices(letters, k=n))

    passage, near = prose(90), prose(300)
    rows = [(1, None), (2, ""), (3, "x"), (4, "y" * 39), (5, "y" * 40), (6, "y" * 41), (7, "z" * 900), (8, "ab" * 300 + prose(30))]
    rows += [(20 + i, prose(rng.randrange(120)) + passage[rng.randrange(40) :] + prose(60)) for i in range(30)]
    for i in range(40):
        t = list(near)
        for _ in range(rng.randrange(3)):
            t[rng.randrange(300)] = "!"
        rows.append((100 + i, "".join(t)))
    rows += [(200 + i, near + prose(50)) for i in range(3)] + [(300, near), (300, near), (300, near[:100]), (None, near), (None, passage)]
    rows += [(400, prose(20_000)), (401, rows[20][1] * 4), (402, prose(50) + "\n".join(["a line that stands very often, to be sure"] * 60))]
    rows += [(500 + i, prose(200)) for i in range(30)]
    rng.shuffle(rows)
    return rows


def test_removal_equals_plain_version(spark, corpus):
    docs = plain.documents(spark, corpus).repartition(3)
    want = plainly(corpus, SIZE)
    assert found(removal_report(docs, size=SIZE, anchor=ANCHOR)) == want
    assert 0 < sum(r[2] for r in want) < sum(r[1] for r in want)


def test_strings_of_hot_anchors_go_by_hash(spark, corpus, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_BYTES", 150)
    docs = plain.documents(spark, corpus).repartition(3)
    assert found(removal_report(docs, size=SIZE, anchor=ANCHOR)) == plainly(corpus, SIZE)


def test_whole_length(spark):
    rng = random.Random(9)
    passage = "".join(rng.choices("abcdefghij ", k=500))
    rows = [(i, "".join(rng.choices("klmn ", k=300)) + passage[i:]) for i in range(4)] + [(9, passage[:399]), (10, passage[:400])]
    assert found(removal_report(plain.documents(spark, rows))) == plainly(rows, 400)


def test_bytes_that_stay(spark, corpus):
    docs = plain.documents(spark, corpus)
    kept = without_repeats(docs, size=SIZE, anchor=ANCHOR).collect()
    assert sorted((str(r["doc_id"]), hashlib.sha256(r["kept"]).hexdigest()) for r in kept) == sorted(
        (str(r[0]), r[4]) for r in plainly(corpus, SIZE)
    )
    assert removal_report(docs.limit(0)).collect() == []


@pytest.mark.parametrize("shard", [1, 60, 300, 1 << 20])
def test_merged_transforms(monkeypatch, shard):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard)
    rng = random.Random(shard)
    for trial in range(25):
        size = rng.choice([4, 8, 12, 5, 6, 11])
        letters = b"ab" if trial % 2 else b"abcdef"
        base = bytes(rng.choices(letters, k=200))
        pieces = [bytes(rng.choices(letters, k=rng.randrange(size, 60))) for _ in range(4)]
        pieces += [base[a : a + rng.randrange(size, 60)] for a in rng.sample(range(100), 6)]
        copies = np.asarray(rng.choices([1, 1, 3], k=len(pieces)))
        stands = Counter()
        for p, c in zip(pieces, copies.tolist()):
            for a in range(len(p) - size + 1):
                stands[p[a : a + size]] += c
        for p, again in zip(pieces, repeats_of(pieces, copies, size)):
            assert again.tolist() == [stands[p[a : a + size]] > 1 for a in range(len(p) - size + 1)]


def test_interleave_gives_common_prefixes():
    """Rows of two shards lie in one interval exactly if they have that many symbols in common."""
    shards = [Transform([b"banana", b"bandana"], 1, 3), Transform([b"cabana"], 1, 3)]
    intervals = merged_intervals(shards, 3)
    texts = [b"bananabandana", b"cabana"]
    ends = [[6, 13], [6]]
    rows = []
    for s, text, end, interval in zip(shards, texts, ends, intervals):
        for at, i in zip(s.at.tolist(), interval[s.empty :].tolist()):
            rows.append((text[at : min(at + 3, next(e for e in end if e > at))], i))
    assert all((a == b) == (i == j) for a, i in rows for b, j in rows)


def test_equal_strings_have_equal_anchors():
    rng = random.Random(6)
    a, b = (bytes(rng.choices(b"abc", k=500)) for _ in range(2))
    shared = bytes(rng.choices(b"abc", k=120)) + b"d" * 90
    parts = [(0, 0, a + shared + b), (1, 0, b + shared), (2, 7, shared * 3)]
    seen = {}
    for doc, start, n, key, places in zip(*anchored_runs(parts, SIZE, ANCHOR)):
        text = parts[doc][2][start - parts[doc][1] :]
        assert n >= places >= 1
        for i in range(n):
            assert seen.setdefault(text[i : i + SIZE], key) == key
    assert sum(len(p[2]) - SIZE + 1 for p in parts) == sum(anchored_runs(parts, SIZE, ANCHOR)[2])
