"""Text quality from document statistics: random Fourier features, ridge, isotonic calibration.

Every text becomes a short vector of statistics. Random cosines of it approximate a
Gaussian kernel, so a linear fit on them is a kernel machine. The fit needs only sums
over rows, Z'Z and Z'y; each task sums its own and Spark adds up the tasks' sums. Rows
held back from the fit calibrate it: their fitted values are counted into a fixed number
of bins, and the shares of good documents are made monotone. What reaches the driver has
a size set by the parameters and not by the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiwarden.llm.words import columns, prepare, slices, windows, words
from kpiwarden.sources.scratch import stored

N_STATS = 18
COSINES = 256
RIDGE = 1e-3
BINS = 512
SPREAD = 8.0  # standardised statistics are limited to this many deviations
THRESHOLD = 0.3

_IS = {
    name: np.isin(np.arange(256), list(chars))
    for name, chars in {
        "upper": range(65, 91),
        "lower": range(97, 123),
        "digit": range(48, 58),
        "mark": b".,;:'\"()-",
        "shout": b"!?",
        "symbol": b"#$%&*@^~<>=+_\\/{}[]`",
        "bar": b"|",
        "stop": b".",
        "line": b"\n",
        "wide": range(128, 256),
    }.items()
}


def statistics(texts: list[bytes | None]) -> np.ndarray:
    """One row of N_STATS numbers per text; null counts as empty."""
    raw = [t or b"" for t in texts]
    w = words(raw)
    n_docs = len(raw)
    size = np.fromiter(map(len, raw), np.int64, n_docs)
    edge = np.concatenate(([0], np.cumsum(size + 1)))
    share = {}
    for name, table in _IS.items():
        sums = np.concatenate(([0], np.cumsum(table[w.data], dtype=np.int64)))
        share[name] = np.diff(sums[edge]).astype(float)
    share["line"] -= 1  # the separator
    n_words = w.counts()
    per_byte, per_word = np.maximum(size, 1), np.maximum(n_words, 1)
    length = np.concatenate(([0], np.cumsum(w.end - w.start)))
    distinct, most = _repeats(w.hash, w.first)
    twice = w.hash[1:] == w.hash[:-1]
    doc = np.repeat(np.arange(n_docs), n_words)
    twice &= doc[1:] == doc[:-1]
    grams, at = windows(w, 5)
    gram_first = np.searchsorted(at, w.first)
    gram_distinct, _ = _repeats(grams, gram_first)
    n_grams = np.diff(gram_first)
    letters = np.maximum(share["upper"] + share["lower"], 1)
    return np.stack(
        [
            np.log1p(size),
            np.log1p(n_words),
            np.diff(length[w.first]) / per_word,
            share["upper"] / letters,
            share["digit"] / per_byte,
            share["mark"] / per_byte,
            share["shout"] / per_word,
            share["symbol"] / per_word,
            share["bar"] / per_word,
            share["stop"] / per_word,
            np.log1p(share["line"] / per_word),
            share["wide"] / per_byte,
            distinct / per_word,
            np.log1p(distinct),
            most / per_word,
            np.bincount(doc[1:][twice], minlength=n_docs) / per_word,
            1 - gram_distinct / np.maximum(n_grams, 1),
            np.bincount(doc, w.end - w.start > 20, n_docs) / per_word,
        ],
        1,
    )


def _repeats(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in each part of ``hashes``, and how often its commonest value occurs."""
    n = len(first) - 1
    part = np.repeat(np.arange(n, dtype=np.uint64), np.diff(first))
    key = np.sort((part << np.uint64(40)) | (hashes >> np.uint64(24)))
    start = np.flatnonzero(np.concatenate((np.ones(min(1, len(key)), bool), key[1:] != key[:-1])))
    of = (key[start] >> np.uint64(40)).astype(np.int64)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, of, np.diff(np.append(start, len(key))))
    return np.bincount(of, minlength=n), most


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    centres: np.ndarray  # fitted values in the middle of the calibration steps
    levels: np.ndarray  # and the shares of good documents there

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -SPREAD, SPREAD)
        z = np.cos(x @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.concatenate((z, np.ones((len(z), 1))), 1)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.centres, self.levels)


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, stats`` of every row."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "text"):
            flat = pa.array(statistics(texts).ravel())
            stats = pa.FixedSizeListArray.from_arrays(flat, N_STATS).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), stats], ["doc_id", "stats"])

    return columns(docs, doc_id=id_col, text=text_col).mapInArrow(run, "doc_id long, stats array<double>")


def _stats_of(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("stats").flatten().to_numpy().reshape(-1, N_STATS)


def fold(doc_id: str = "doc_id", parts: int = 5):
    """Remainder that decides on what a document is used for; a null id has 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts, F.lit(0))


def fit(stats: DataFrame, labels: DataFrame, label_col: str = "quality", seed: int = 8) -> QualityModel:
    """Learn from labelled rows whose fold is not 0: folds 1 to 3 fit the ridge, fold 4 calibrates.

    ``stats`` has ``doc_id, stats``; ``labels`` has ``doc_id`` and the label, 0 or 1. Other
    labels are ignored; of several for one document the largest counts. Without any label
    the model gives 0.5 to everything.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id")
    known = known.agg(F.max(label_col).cast("double").alias("y")).withColumnRenamed("doc_id", "of")
    rows = stats.where(fold() != 0)
    rows = rows.join(known, rows["doc_id"] == known["of"]).select("stats", "y", fold().alias("fold"))
    rows = stored(rows, "labelled")
    columns_ = [F.col("stats")[i] for i in range(N_STATS)]
    about = rows.agg(F.count(F.lit(1)), *map(F.avg, columns_), *map(F.stddev_pop, columns_)).first()
    rng = np.random.default_rng(seed)
    directions = rng.normal(0, 1 / np.sqrt(N_STATS), (N_STATS, COSINES))
    phases = rng.uniform(0, 2 * np.pi, COSINES)
    empty = QualityModel(
        np.zeros(N_STATS), np.ones(N_STATS), directions, phases, np.zeros(COSINES + 1), np.zeros(1), np.full(1, 0.5)
    )
    if not about[0]:
        return empty
    empty.mean = np.asarray(about[1 : N_STATS + 1], float)
    spread = np.asarray(about[N_STATS + 1 :], float)
    empty.scale = np.where(spread > 1e-9, spread, 1.0)
    return _calibrated(_ridge(rows, empty), rows)


def _ridge(rows: DataFrame, model: QualityModel) -> QualityModel:
    d = COSINES + 1
    features = model.features

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d + 1))
        for batch in batches:
            z, y = features(_stats_of(batch)), batch.column("y").to_numpy()
            total += z.T @ np.concatenate((z, y[:, None]), 1)
        yield pa.RecordBatch.from_pydict({"row": np.arange(d, dtype=np.int32), "sums": list(total)})

    def add(table: pa.Table) -> pa.Table:
        total = table.column("sums").combine_chunks().flatten().to_numpy().reshape(-1, d + 1).sum(0)
        return pa.table({"row": table.column("row").slice(0, 1), "sums": [total]})

    schema = "row int, sums array<double>"
    parts = rows.where("fold != 4").select("stats", "y").mapInArrow(sums, schema)
    found = parts.groupBy("row").applyInArrow(add, schema).collect()  # d rows of d + 1 numbers
    normal = np.stack([np.asarray(r["sums"]) for r in sorted(found, key=lambda r: r["row"])])
    n = max(normal[-1, d - 1], 1)
    penalty = np.full(d, RIDGE * n / COSINES)
    penalty[-1] = 1e-9 * n + 1e-12
    model.weights = np.linalg.solve(normal[:, :d] + np.diag(penalty), normal[:, d])
    return model


def _calibrated(model: QualityModel, rows: DataFrame) -> QualityModel:
    raw = model.raw

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bin_ = np.clip((raw(_stats_of(batch)) + 0.5) / 2 * BINS, 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(bin_), batch.column("y")], ["bin", "y"])

    held = rows.where("fold = 4").select("stats", "y").mapInArrow(fitted, "bin int, y double")
    counts = held.groupBy("bin").agg(F.sum("y").alias("good"), F.count(F.lit(1)).alias("n")).collect()
    steps: list[list[float]] = []  # good, all, sum of fitted values
    for r in sorted(counts, key=lambda r: r["bin"]):
        steps.append([r["good"], r["n"], r["n"] * ((r["bin"] + 0.5) / BINS * 2 - 0.5)])
        while len(steps) > 1 and steps[-2][0] * steps[-1][1] >= steps[-1][0] * steps[-2][1]:
            last = steps.pop()
            steps[-1] = [x + y for x, y in zip(steps[-1], last)]
    if steps:
        model.centres = np.asarray([s[2] / s[1] for s in steps])
        # half a document either way keeps certainty in proportion to the evidence
        model.levels = np.maximum.accumulate([(s[0] + 0.5) / (s[1] + 1) for s in steps])
    return model


def score(stats: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted`` for rows of statistics."""
    rate = model.score

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = rate(_stats_of(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    return stats.mapInArrow(run, "doc_id long, score double, predicted int")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs`` (``doc_id, text``).

    Scores rise with the likelihood of label 1. Null and empty texts have statistics like
    any other (all zero but for lengths) and are scored by them. Rows that repeat are
    scored each. Labels of documents in fold 0 are never used.
    """
    stats = stored(document_statistics(docs), "statistics")
    model = fit(stats, columns(labels, doc_id="doc_id", quality="quality"))
    scored = score(stats, model)
    return scored.select("doc_id", (fold() == 0).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, model: QualityModel, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose text scores at least ``threshold``, with all their columns."""
    prepare(docs.sparkSession)
    at, rate = docs.columns.index(text_col), model.score

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, at):
            yield part.filter(pa.array(rate(statistics(texts)) >= threshold))

    return docs.mapInArrow(run, docs.schema)
