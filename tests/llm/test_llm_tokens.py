"""Operators 2 and 5 against the tokenizer libraries."""

import base64
import hashlib
import random
import zlib

import numpy as np
import plain
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from kpiwarden.llm import byte_bpe, packing, remembered
from kpiwarden.llm.byte_bpe import ByteBpe, decoded, encoded, round_trip_report
from tokenizers import Tokenizer

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [
    None, "", " ", "  ", "\n", " a", "a ", "a  b", "a\n\nb", "it's\tI'll 'S", "naïve Éa ÉA ΑΣ ς", "x y z\x1cq\x85",
    "日本語" * 30, "a" * 5000, "ab" * 4000, "word " * 6000, "!!?? 123 4.5", "é ́ x", "<|endoftext|> a",
]


def random_texts():
    rng = random.Random(0)
    return ["".join(rng.choice("ab cd'sté.,1 \n\t日") for _ in range(rng.randrange(60))) for _ in range(400)]


@pytest.fixture(scope="module")
def docs(spark):
    return plain.documents(spark, list(enumerate(ODD + random_texts())) + [(3, ODD[3]), (None, "no id")])


def test_packing(spark, docs):
    encode = Tokenizer.from_file(WORDS)
    rows = packing.packed_documents(docs, WORDS, length=256).collect()
    want = []
    for r in docs.collect():
        ids = encode.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 256)):
            piece = np.asarray(ids[at : at + 256], "<u4")
            want.append((str(r["doc_id"]), k, at, len(piece), zlib.crc32(piece.tobytes())))
    assert sorted((str(r[0]), *r[1:5]) for r in rows) == sorted(want)
    fill = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == fill.get(r["sequence_id"], 0)
        fill[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(fill.values()) <= 256
    assert len(fill) <= -(-sum(w[3] for w in want) // 256) + 1
    assert packing.packed_documents(docs.limit(0), WORDS).collect() == []


def test_parts_of_words_are_encoded_once():
    own, made = packing.WordTokenizer(WORDS), []
    encode = own._new_parts
    own._new_parts = lambda parts: made.extend(parts) or encode(parts)
    texts = ["Word WORD, word?! wÖrd\nWÖRD. word", "", "a-B. (C) Word", ",; WORD", "3×4÷2 Straße ÿ ŸÀ µm, ªº. K x²"]
    texts += ["".join(random.Random(i).choices("aZé É×÷ß.,!\n -µ日Ω7", k=200)) for i in range(40)]
    plainly = Tokenizer.from_file(WORDS)
    want = [plainly.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode([t.encode() for t in texts])] == want
    assert [len(x) for x in own.encode([b"WORD; word."])] == [16]
    assert len(made) == len(set(made)) and {"word", "wörd", "?!", "a-B.", "(C)"} <= set(made)
    assert not {"Word", "WORD", "WORD,", "wÖrd", "WÖRD."} & set(made)
    assert own.encode([]) == [] and own.encode([b"", b" \n"]) == [b"", b""]


def test_parts_remembered_in_arrays_are_not_made_again_and_bounded():
    made, held = [], remembered.RememberedNumbers(most=4000)

    def numbers(keys):
        made.extend(keys)
        return {k: np.arange(len(k), dtype="<u4").tobytes() for k in keys}

    def asked(*keys):
        out, edge = held.of(pa.array(keys, pa.large_string()), numbers)
        return [out[x:y].tolist() for x, y in zip(edge, edge[1:])]

    want = lambda *keys: [list(range(len(k))) for k in keys]
    assert asked() == [] and asked("ab", "", "é日", "ab") == want("ab", "", "é日", "ab")
    assert made == ["ab", "", "é日"]
    assert asked("c", "ab", "é日") == want("c", "ab", "é日") and made == ["ab", "", "é日", "c"]
    long = "w" * 100_000
    assert asked(long, "ab") == want(long, "ab") and len(held) < 5
    for i in range(200):
        keys = [f"{i}", "ab", f"w{i % 90}", f"{i}"]
        assert asked(*keys) == want(*keys)
        assert held._bytes == int(remembered._bytes_held(held._keys, held._size).sum()) <= 4000
    assert made.count("ab") == 1 and made.count("w0") > 1 and 20 < len(held) < 4000 // remembered.EACH_IN_ARRAYS


def test_parts_that_are_forgotten_are_encoded_alike(monkeypatch):
    texts = [(t or "").encode() for t in ODD + random_texts()]
    want = packing.WordTokenizer(WORDS).encode(texts)
    monkeypatch.setattr(packing, "HELD", 500)
    own = packing.WordTokenizer(WORDS)
    for _ in range(2):
        assert [own.encode([t])[0] for t in texts] == want


def test_sequences_hold_the_ids(spark, docs):
    pieces = packing.tokenised_pieces(docs, WORDS, 256, with_ids=True)
    made = packing.sequences(packing.pack(pieces, 256)).collect()
    assert sum(r["length"] for r in made) == pieces.selectExpr("sum(length)").first()[0]
    assert all(len(r["ids"]) == 4 * r["length"] <= 1024 for r in made)


def test_best_fit_is_the_tightest():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 65, 500)
    sequence, offset = packing.best_fit_decreasing(lengths, 64)
    room = []
    for i in np.argsort(-lengths, kind="stable"):
        fits = [(r, k) for k, r in enumerate(room) if r >= lengths[i]]
        if fits:
            tight = min(fits)[0]
            assert room[sequence[i]] == tight
        else:
            assert sequence[i] == len(room)
            room.append(64)
        assert offset[i] == 64 - room[sequence[i]]
        room[sequence[i]] -= lengths[i]


def test_many_shards_place_every_piece(spark):
    rows = [(i, 0, 0, 1 + i % 100, i) for i in range(3000)] + [(5, 0, 0, 6, 5)] * 2000
    pieces = spark.createDataFrame(rows, packing.PIECES)
    packed = packing.pack(pieces, length=100, shard=500).collect()
    assert len(packed) == 5000
    spans = sorted((r["sequence_id"], r["offset"], r["length"]) for r in packed)
    for (s, o, n), (t, p, _) in zip(spans, spans[1:]):
        assert p == (o + n if s == t else 0)


@pytest.fixture(scope="module")
def library():
    with open(BYTES, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(spark, docs, library):
    rows = round_trip_report(docs, BYTES, public_tokenizers.PATTERN).collect()
    want = []
    for r in docs.collect():
        ids = library.encode_ordinary(r["text"] or "")
        sha = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want.append((str(r["doc_id"]), len(ids), sha, hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    assert sorted((str(r[0]), *r[1:]) for r in rows) == sorted(want)
    assert round_trip_report(docs.limit(0), BYTES, public_tokenizers.PATTERN).collect() == []


def test_bpe_ids_and_bytes(spark, docs, library):
    rows = decoded(encoded(docs, BYTES, public_tokenizers.PATTERN), BYTES, public_tokenizers.PATTERN).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert len(rows) == docs.count()
    for r in rows:
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode_ordinary(texts[r["doc_id"]])
        assert r["bytes"] == texts[r["doc_id"]].encode()


def test_pre_tokens_of_a_slice_merge_as_each_would_alone(library):
    bpe = ByteBpe.load(BYTES, public_tokenizers.PATTERN)
    rng = random.Random(3)
    syllables = ["th", "the", "an", "aa", "a", "ing", "tion", "é", "日本", "xq", "  ", "ab", "ba", "0", "ÿ"]
    words = ["".join(rng.choices(syllables, k=rng.randrange(1, 60))) for _ in range(3000)]
    words += ["a" * n for n in (1, 2, 63, 64, 65, 66, 1000)] + words[:50]
    want = [library._encode_single_piece(w.encode()) for w in words]
    assert [np.frombuffer(x, "<u4").tolist() for x in bpe.merge_all([w.encode() for w in words])] == want
    assert [bpe.merge(w.encode()) for w in words[:100]] == want[:100]
    assert bpe.merge_all([]) == [] and not any(bpe._words)


def test_short_and_long_pre_tokens_merge_alike(monkeypatch):
    tokens = [b"a", b"b", b"x", b"abx", b"bb", b"ab", b"aba", b"xa", b"abab"]
    bpe = ByteBpe({t: i for i, t in enumerate(tokens)}, r"\S+")
    rng = random.Random(4)
    data = ["".join(rng.choices("abx", k=rng.randrange(1, 40))).encode() for _ in range(2000)]
    together = bpe.merge_all(data)
    monkeypatch.setattr(byte_bpe, "_SHORT", 0)
    assert bpe.merge_all(data) == together


def test_ranks_that_fall_during_merging():
    # "abx" is a better pair than "ab" and "x" once "ab" is there
    tokens = [b"a", b"b", b"x", b"abx", b"bb", b"ab", b"aba"]
    bpe = ByteBpe({t: i for i, t in enumerate(tokens)}, r"\S+")
    for text in ("abxabx", "aababx", "bbabxx", "ababab", "abbbabxa"):
        parts = [bytes([c]) for c in text.encode()]
        while True:
            ranked = [(bpe.ranks.get(x + y, 99), i) for i, (x, y) in enumerate(zip(parts, parts[1:]))]
            rank, i = min(ranked, default=(99, 0))
            if rank == 99:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        assert bpe.merge(text.encode()) == [bpe.ranks[p] for p in parts]


def test_what_is_remembered_is_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(remembered, "MOST_BYTES", 10_000)
    made = []
    held = remembered.Remembered(lambda x: made.append(x) or x.encode())
    long = "w" * 5_000_000
    assert held[long] == long.encode() and long not in held
    for i in range(1000):
        assert held[f"w{i}"] == b"w%d" % i
    assert len(held) + len(held._older) < 2 * 10_000 // remembered.EACH
    before = len(made)
    assert held["w999"] == b"w999" and len(made) == before
