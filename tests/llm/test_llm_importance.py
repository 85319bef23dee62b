"""Operator 11 against a plain Python version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import plain
import pytest
from kpiwarden.llm import importance
from kpiwarden.llm.importance import Features, resampled

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    w = WORD.findall((text or "").translate(plain.ASCII))
    return w, [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10000


def plainly(rows, target):
    source = Counter(bucket(f) for _, t in rows for f in features(t)[1])
    wanted = Counter(bucket(f) for t in target for f in features(t)[1])
    s_all, t_all = sum(source.values()), sum(wanted.values())

    def gain(b):
        return math.floor(1000 * math.log((wanted[b] + 1) * (s_all + 10000) / ((source[b] + 1) * (t_all + 10000))))

    out = []
    for i, t in rows:
        words, found = features(t)
        weight, score = sum(gain(bucket(f)) for f in found), None
        if i is not None:
            h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(found), weight, score, None, len(words)])
    able = sorted((r for r in out if r[3] is not None and r[5] >= 20), key=lambda r: (-r[3], r[0]))
    for n, r in enumerate(able[: 5 * len(able) // 100]):
        r[4] = n + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    letters = "abcdeXYZ09ñéß日"
    vocabulary = ["".join(rng.choices(letters, k=rng.randrange(1, 9))) for _ in range(300)]
    def text(n):
        return rng.choice([" ", "\n", " - ", "\x00"]).join(rng.choices(vocabulary, k=n))

    rows = [(i * 7 - 500, text(rng.randrange(60))) for i in range(400)]
    rows += [(9000, None), (9001, ""), (9002, "-- !"), (9003, "w" * 70 + " " + "v" * 300 + " x " + "u" * 64 + " " + "t" * 65),
             (9004, text(9000)), (9005, "one"), (9006, "a " * 3000)]
    return rows, [text(30) for _ in range(40)] + [None, ""]


def tables(spark, rows, target):
    return plain.documents(spark, rows), spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")


def test_resampled_equals_plain_version(spark, corpus):
    rows, target = corpus
    docs, wanted = tables(spark, rows, target)
    want = plainly(rows, target)
    assert found(resampled(docs.repartition(3), wanted)) == want
    assert sum(r[4] is not None for r in want) > 10


def test_no_target_and_no_documents(spark, corpus):
    rows, target = corpus
    docs, wanted = tables(spark, rows[:60], target)
    assert found(resampled(docs, wanted.limit(0))) == plainly(rows[:60], [])
    assert resampled(docs.limit(0), wanted).collect() == []
    few = found(resampled(docs.limit(5), wanted))
    assert len(few) == 5 and all(r[4] is None for r in few)


def test_repeated_and_missing_ids(spark):
    text = "word " * 25
    rows = [(1, text)] * 60 + [(2, text)] * 20 + [(None, text)] * 20 + [(3, "few words")]
    docs, wanted = tables(spark, rows, ["word"])
    out = found(resampled(docs.repartition(4), wanted))
    assert len(out) == len(rows)
    assert sorted(r[4] for r in out if r[4]) == [1, 2, 3, 4]  # 5 percent of 80
    assert all(r[3] is None and r[4] is None for r in out if r[0] is None)
    assert len({r[0] for r in out if r[4]}) == 1


def test_ties_go_to_smaller_ids(spark, corpus, monkeypatch):
    monkeypatch.setattr(importance, "noise", lambda doc_id, seed, scale: 0)
    rows = [(i, "same words " * 12) for i in range(200)]
    docs, wanted = tables(spark, rows, ["same"])
    out = found(resampled(docs.repartition(3), wanted))
    assert {r[0]: r[4] for r in out if r[4]} == {i: i + 1 for i in range(10)}


def test_hashes_of_features():
    rng = random.Random(8)
    texts = [bytes(rng.choices(b"aZ0 \n\xc3\xb1", k=rng.randrange(400))) for _ in range(40)]
    texts += [b"y" * n + b" " + b"z" * n for n in (63, 64, 65, 66, 500)]
    runs = Features(texts, 3, 10000).runs
    want = Counter()
    for t in texts:
        w = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())
        want.update((n, zlib.crc32(b" ".join(w[i : i + n])) % 10000) for n in (1, 2, 3) for i in range(len(w) - n + 1))
    assert Counter((n + 1, int(b)) for n, (bucket, _) in enumerate(runs) for b in bucket) == want
