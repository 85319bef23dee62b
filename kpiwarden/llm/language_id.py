"""Language of a text by error-correcting output codes over character n-grams.

Every language has a codeword of bits. For each bit one binary classifier tells the
languages with a 1 from those with a 0; its weights are log odds of hashed byte n-grams,
so all it needs from the corpus are sums of n-gram counts per language, which tasks sum
up on their own before Spark adds the tasks' sums. A text is decoded to the codeword
nearest to the classifiers' margins, each bit weighted by how reliable its classifier
was; a small lead over the second nearest marks the text as ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiwarden.llm.words import columns, mix, prepare, slices

SIZE = 4096  # hashed n-grams of each order
ORDERS = (1, 2, 3)
ALL_CODES = 6  # up to so many languages, all useful bits; beyond, random ones
RANDOM_BITS = 10  # times the logarithm of the number of languages
AMBIGUOUS = 0.1
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_WIDTH = SIZE * len(ORDERS)


def gram_counts(texts: list[bytes]) -> np.ndarray:
    """Counts of hashed byte n-grams, a row per text; ASCII letters are lower-cased."""
    out = np.empty((len(texts), _WIDTH), np.float32)
    for i, text in enumerate(texts):
        data = np.frombuffer(text.lower(), np.uint8).astype(np.uint32)
        for k, order in enumerate(ORDERS):
            gram = np.zeros(max(0, len(data) - order + 1), np.uint32)
            for j in range(order):
                gram = gram * np.uint32(0x01000193) + data[j : len(data) - order + 1 + j] + np.uint32(1)
            if order > 1:
                gram *= np.uint32(0x9E3779B1)
                gram >>= np.uint32(32 - SIZE.bit_length() + 1)
            out[i, k * SIZE : (k + 1) * SIZE] = np.bincount(gram, minlength=SIZE)[:SIZE]
    return out


def codewords(n: int, seed: int = 6) -> np.ndarray:
    """A row of +1 and -1 for each of ``n`` languages; no column is constant, none repeats another."""
    if n <= ALL_CODES:
        columns_ = [
            [1 if (c >> i) & 1 else -1 for i in range(n)] for c in range(1, 1 << n) if c & 1 and c != (1 << n) - 1
        ]
        return np.asarray(columns_, int).reshape(-1, n).T
    rng = np.random.default_rng(seed)
    bits = int(np.ceil(RANDOM_BITS * np.log2(n)))
    best, apart = None, -1
    for _ in range(50):
        code = rng.choice([-1, 1], (n, bits))
        code[0] = 1
        varied = (np.abs(code.sum(0)) < n).all()
        distance = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
        if varied and distance > apart:
            best, apart = code, distance
    return best


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # n-grams x bits
    bias: np.ndarray
    trust: np.ndarray  # of each bit

    def margins(self, counts: np.ndarray) -> np.ndarray:
        total = np.maximum(counts.sum(1, keepdims=True), 1)
        return counts @ self.weights / total * len(ORDERS) + self.bias

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest language of each row, and its share of the likeness of all languages."""
        bounded = np.clip(margins * 20, -30, 30)
        loss = np.log1p(np.exp(-bounded[:, None, :] * self.code[None])) @ self.trust
        near = np.exp(loss.min(1, keepdims=True) - loss)
        return loss.argmin(1), near.max(1) / near.sum(1)

    def predict(self, texts: list[bytes | None]) -> tuple[list[str], np.ndarray]:
        has = [bool(t) and _LETTER.search(t.decode()) is not None for t in texts]
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.languages or not any(has):
            return names, scores
        at = np.flatnonzero(has)
        for lo in range(0, len(at), 256):
            some = at[lo : lo + 256]
            best, share = self.decode(self.margins(gram_counts([texts[i] for i in some])))
            scores[some] = share
            for i, b in zip(some, best):
                names[i] = self.languages[b]
        return names, scores


def _sums(docs: DataFrame) -> DataFrame:
    """``lang, fold, counts``: summed n-gram counts per language and half of the training rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple, np.ndarray] = {}
        for part, texts in slices(batches, "text"):
            keys = list(zip(part.column("lang").to_pylist(), part.column("half").to_pylist()))
            for lo in range(0, len(keys), 256):
                counts = gram_counts([t or b"" for t in texts[lo : lo + 256]])
                some = keys[lo : lo + 256]
                for key in set(some):
                    mine = counts[[k == key for k in some]].sum(0, dtype=np.float64)
                    total[key] = total[key] + mine if key in total else mine
        if total:
            yield pa.RecordBatch.from_pydict(
                {"lang": [k[0] for k in total], "half": pa.array([k[1] for k in total], pa.int32()),
                 "counts": [v.tolist() for v in total.values()]},
            )

    return docs.mapInArrow(run, "lang string, half int, counts array<double>")


def learn(docs: DataFrame) -> LanguageModel:
    """Fit on ``text, lang, half`` rows; ``half`` is 0 or 1 and serves to weigh the bits.

    Rows without a language or text are ignored. What reaches the driver is one vector of
    counts per language and half.
    """
    prepare(docs.sparkSession)
    rows = docs.where("lang is not null and text is not null").select("text", "lang", "half")

    def add(table: pa.Table) -> pa.Table:
        total = table.column("counts").combine_chunks().flatten().to_numpy().reshape(-1, _WIDTH).sum(0)
        return pa.table(
            {"lang": table.column("lang").slice(0, 1), "half": table.column("half").slice(0, 1), "counts": [total]}
        )

    sums = _sums(rows).groupBy("lang", "half").applyInArrow(add, "lang string, half int, counts array<double>")
    found = {(r["lang"], r["half"]): np.asarray(r["counts"]) for r in sums.collect()}
    languages = sorted({k[0] for k in found})
    if not languages:
        return LanguageModel([], np.zeros((0, 0)), np.zeros((_WIDTH, 0)), np.zeros(0), np.zeros(0))
    zero = np.zeros(_WIDTH)
    halves = [np.stack([found.get((x, h), zero) for x in languages]) for h in (0, 1)]
    code = codewords(len(languages))
    model = _fitted(languages, code, halves[0] + halves[1])
    # how well each bit, learnt on one half, tells the languages' n-grams of the other
    right = np.zeros(code.shape[1])
    for own, other in (halves, halves[::-1]):
        side = _fitted(languages, code, own)
        right += (side.margins(other) * code > 0).mean(0) / 2
    model.trust = np.clip(right - 0.5, 0.05, None) / max(1, code.shape[1])
    return model


def _fitted(languages: list[str], code: np.ndarray, counts: np.ndarray) -> LanguageModel:
    share = counts + 0.5
    # each language weighs the same, each order of n-grams is a distribution
    parts = share.reshape(len(languages), len(ORDERS), SIZE)
    share = (parts / parts.sum(2, keepdims=True)).reshape(len(languages), -1)
    weights = np.empty((_WIDTH, code.shape[1]))
    for b in range(code.shape[1]):
        weights[:, b] = np.log(share[code[:, b] > 0].mean(0)) - np.log(share[code[:, b] < 0].mean(0))
    bias, trust = np.zeros(code.shape[1]), np.ones(code.shape[1]) / max(1, code.shape[1])
    return LanguageModel(languages, code, weights, bias, trust)


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, ambiguous`` of every row.

    A null text and one without letters is ``und`` with score 0. ``ambiguous`` tells that
    no language leads clearly. With one language known, it is predicted with score 1.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "text"):
            names, scores = model.predict(texts)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(names, pa.string()), pa.array(scores),
                 pa.array(scores < 0.5 + AMBIGUOUS)],
                ["doc_id", "lang_pred", "score", "ambiguous"],
            )

    schema = "doc_id long, lang_pred string, score double, ambiguous boolean"
    return columns(docs, doc_id=id_col, text=text_col).mapInArrow(run, schema)


def predicted_languages(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, ambiguous``, learnt on the rows that are not held out.

    Held out are the documents whose id, as text, has a CRC-32 divisible by five; a null
    id counts as held out.
    """
    crc = F.crc32(F.col("doc_id").cast("string"))
    fold = F.coalesce(crc % 5, F.lit(0))
    rows = columns(docs, doc_id="doc_id", text="text", lang="lang")
    half = F.coalesce(F.floor(crc / 5) % 2, F.lit(0)).cast("int")
    model = learn(rows.where(fold != 0).select("text", "lang", half.alias("half")))
    out = predict(rows, model)
    return out.select("doc_id", (fold == 0).alias("held_out"), "lang_pred", "score", "ambiguous")
