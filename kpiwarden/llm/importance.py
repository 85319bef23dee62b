"""Drawing documents that look like a target collection: importance resampling by word runs.

Features are hashed (CRC-32) into a fixed number of buckets. How often a bucket occurs in
the documents and in the target gives its gain, a whole number; the gains are one array
that scores a document by adding up its features. A random term that depends on the
document's id alone (Gumbel noise) turns the scores into a weighted draw without
replacement: the highest scores are the sample.

Who is drawn is decided without sorting all documents. The scores are written once; jobs
that only count rows narrow down the score of the last one drawn, then the id among its
ties, then the row among rows alike. Only drawn rows are range-partitioned, for ranks.

CRC-32 is linear: the value of a run of words follows from the values of its words. So
all words of a slice of documents are hashed together, byte by byte of the word, and the
runs are put together from them by table look-ups.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiwarden.llm.words import columns, prepare, slices
from kpiwarden.sources.scratch import stored

BUCKETS = 10_000
LONGEST = 3  # words of a feature
SEED = 42
LEAST_WORDS = 20
SHARE = 5  # percent of the documents that are long enough
SCALE = 1000
PROBES = 15  # thresholds that one job counts for
LONG_WORD = 64  # bytes from which a word is hashed by itself

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.ones(256, bool)
_IN_WORD[0x00:0x30] = _IN_WORD[0x3A:0x61] = _IN_WORD[0x7B:0x80] = False


@lru_cache(maxsize=1)
def _byte_table() -> np.ndarray:
    """Effect of one byte on a CRC-32 register."""
    return np.asarray([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32) ^ np.uint32(
        _advanced_by_zero_byte(0)
    )


def _advanced_by_zero_byte(register: int) -> int:
    """The register after a byte of zero, without the final inversion."""
    return zlib.crc32(b"\0", register ^ 0xFFFFFFFF) ^ 0xFFFFFFFF


@lru_cache(maxsize=1)
def _shift_tables() -> np.ndarray:
    """``[n, i, b]``: a register with byte i equal to b and nothing else, after n bytes of zero."""
    one = np.zeros((4, 256), np.uint32)
    for i in range(4):
        one[i] = [_advanced_by_zero_byte(b << (8 * i)) for b in range(256)]
    tables = np.zeros((LONG_WORD + 2, 4, 256), np.uint32)
    for i in range(4):
        tables[0, i] = np.arange(256, dtype=np.uint32) << np.uint32(8 * i)
    for n in range(1, len(tables)):
        tables[n] = _through(one, tables[n - 1])
    return tables


def _through(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    return (
        table[0][x & 255] ^ table[1][(x >> 8) & 255] ^ table[2][(x >> 16) & 255] ^ table[3][x >> 24]
    )


def _shifted(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Each register after its own number of bytes of zero."""
    tables = _shift_tables()
    most = len(tables) - 1
    flat, at = tables.ravel(), np.minimum(n, most) * 1024
    out = flat[at + (x & 255)]
    out ^= flat[at + 256 + ((x >> 8) & 255)]
    out ^= flat[at + 512 + ((x >> 16) & 255)]
    out ^= flat[at + 768 + (x >> 24)]
    for i in np.flatnonzero(n > most):  # runs with a long word: by squaring
        out[i] = _far_shifted(int(x[i]), int(n[i]))
    return out


@lru_cache(maxsize=64)
def _doubled(power: int) -> np.ndarray:
    """Table of a shift by ``2 ** power`` bytes."""
    if power == 0:
        return _shift_tables()[1]
    half = _doubled(power - 1)
    return _through(half, half)


def _far_shifted(x: int, n: int) -> int:
    value, power = np.asarray([x], np.uint32), 0
    while n:
        if n & 1:
            value = _through(_doubled(power), value)
        n, power = n >> 1, power + 1
    return int(value[0])


class Features:
    """Buckets of the features of a slice of documents."""

    def __init__(self, texts: list[bytes | None], longest: int, buckets: int):
        joined = b"\n".join(t or b"" for t in texts) + b"\n"
        data = _LOWER[np.frombuffer(joined, np.uint8)]
        inside = np.zeros(len(data) + 1, bool)
        inside[1:] = _IN_WORD[data]
        turn = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = turn[0::2], turn[1::2]
        lengths = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts))
        edges = np.concatenate(([0], np.cumsum(lengths)))
        #: number of each document's first word; one more at the end
        self.first = np.searchsorted(start, edges)
        self.n_words = np.diff(self.first)
        self._doc_end = np.repeat(self.first[1:], self.n_words)
        run = _crc_of_words(data, start, end - start)
        space = np.uint32(zlib.crc32(b" "))
        size = end - start + 1  # with the space before
        after_space = run ^ _shifted(np.full(len(run), space), size - 1)
        #: for each length of run, the bucket of the run that begins at each word, and its words
        self.runs = [(run % np.uint32(buckets), np.arange(len(run)))]
        for n in range(2, longest + 1):
            # the run of n words at each word, where the document has them
            at = np.arange(max(0, len(size) - n + 1))
            at = at[at + n <= self._doc_end[: len(at)]]
            longer = np.zeros(len(run), np.uint32)
            longer[at] = _shifted(run[at], size[at + n - 1]) ^ after_space[at + n - 1]
            run = longer
            self.runs.append((run[at] % np.uint32(buckets), at))

    def counted(self, buckets: int) -> np.ndarray:
        return sum(np.bincount(bucket, minlength=buckets) for bucket, _ in self.runs)

    def scored(self, gains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of features and sum of their gains, of each document."""
        n, total = np.zeros(len(self.n_words), np.int64), np.zeros(len(self.n_words), np.int64)
        for bucket, at in self.runs:
            sums = np.concatenate(([0], np.cumsum(gains[bucket])))
            edge = np.searchsorted(at, self.first)
            n += np.diff(edge)
            total += np.diff(sums[edge])
        return n, total


def _crc_of_words(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of each word: all words at once, a byte of each in a step."""
    order = np.argsort(-np.minimum(length, LONG_WORD + 1), kind="stable")
    start, length = start[order], length[order]
    n_long = int(np.searchsorted(-length, -LONG_WORD))  # words that are longer
    register = np.full(len(start), 0xFFFFFFFF, np.uint32)
    table = _byte_table()
    ends = np.searchsorted(-length[n_long:], -np.arange(LONG_WORD + 1)) + n_long  # words longer than j
    for j in range(int(length[n_long]) if n_long < len(length) else 0):
        some = slice(n_long, ends[j])
        x = register[some]
        register[some] = table[(x ^ data[start[some] + j]) & np.uint32(255)] ^ (x >> np.uint32(8))
    out = np.empty(len(start), np.uint32)
    register ^= np.uint32(0xFFFFFFFF)
    for i in range(n_long):
        register[i] = zlib.crc32(data[start[i] : start[i] + length[i]])
    out[order] = register
    return out


def _counted(longest: int, buckets: int):
    """``bucket, n``: how often a task's features fall into each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, texts in slices(batches, "text"):
            total += Features(texts, longest, buckets).counted(buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, text_col: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """How often the features of all texts fall into each bucket; tasks add up theirs first."""
    prepare(texts.sparkSession)
    rows = columns(texts, text=text_col).mapInArrow(_counted(longest, buckets), "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # no more rows than buckets
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * ln(ratio))`` of each bucket's smoothed share in the target to that in the source."""
    n, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.asarray(
        [
            math.floor(scale * math.log(((t + 1.0) * (s_all + n)) / ((s + 1.0) * (t_all + n))))
            for s, t in zip(source.tolist(), target.tolist())
        ],
        np.int64,
    )


def noise(doc_id: int, seed: int = SEED, scale: int = SCALE) -> int:
    """Gumbel noise from the hash of seed and id."""
    h = int(sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-scale * math.log(-math.log((h + 0.5) / 4294967296)))


def _scored(gains: np.ndarray, longest: int, seed: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "text"):
            found = Features(texts, longest, len(gains))
            n, weight = found.scored(gains)
            ids = part.column("doc_id").to_pylist()
            score = [None if i is None else w + noise(i, seed, scale) for i, w in zip(ids, weight.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), pa.array(n), pa.array(weight),
                    pa.array(score, pa.int64()), pa.array(found.n_words),
                ],
                ["doc_id", "n_features", "weight", "score", "n_words"],
            )

    return run


def _least_reaching(rows: DataFrame, key: str, wanted: int) -> tuple[int, int]:
    """The least value that ``wanted`` rows do not exceed in ``key``, and how many rows lie below it.

    Jobs that only count rows cut the range of values into parts until one value is left.
    """
    low, high = rows.agg(F.min(key), F.max(key)).first()
    below = 0
    while low < high:
        step = -(-(high - low + 1) // (PROBES + 1))
        ends = [e for e in (low + step * (i + 1) - 1 for i in range(PROBES)) if e < high]
        counts = rows.agg(*[F.count_if(F.col(key) <= e).alias(f"c{i}") for i, e in enumerate(ends)]).first()
        for e, n in zip(ends, counts):
            if n >= wanted:
                high = e
                break
            low, below = e + 1, n
    return low, below


def _cut_off(rows: DataFrame, keys: list[str], wanted: int) -> Column:
    """True for the first ``wanted`` rows in the order of the keys, which tell all rows apart."""
    inside, level = F.lit(False), F.lit(True)
    for key in keys:
        last, below = _least_reaching(rows, key, wanted)
        inside = inside | (level & (F.col(key) < last))
        level = level & (F.col(key) == last)
        rows, wanted = rows.where(F.col(key) == last), wanted - below
    return inside | level


def _ranked(drawn: DataFrame) -> DataFrame:
    """``rank`` from 1 in the order of ``place, doc_id, row``: position within a range plus the rows of ranges before."""
    drawn = drawn.repartitionByRange("place", "doc_id", "row").sortWithinPartitions("place", "doc_id", "row")
    drawn = stored(drawn.withColumn("position", F.monotonically_increasing_id()), "drawn")
    part = F.shiftright("position", 33).cast("int")
    counts = {r["part"]: r["n"] for r in drawn.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, starts = 0, []
    for p in sorted(counts):  # a row for each range
        starts.append((p, before))
        before += counts[p]
    starts = drawn.sparkSession.createDataFrame(starts, "of int, before long")
    rank = F.col("before") + F.col("position").bitwiseAND((1 << 33) - 1) + 1
    return drawn.join(F.broadcast(starts), part == F.col("of")).withColumn("rank", rank)


def resampled(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    seed: int = SEED,
    least_words: int = LEAST_WORDS,
    percent: int = SHARE,
    scale: int = SCALE,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row of ``docs``; ``rank`` is null where not drawn.

    A null, empty or wordless text has no features and weight 0; an empty target gives
    every bucket a gain by the documents alone. Of the documents with at least
    ``least_words`` words, ``percent`` in a hundred are drawn, rounded down: those with the
    highest scores, of equal scores those with smaller ids. Rows that repeat an id and
    a score are drawn in the order in which they are stored. A row without an id has no
    score, is not drawn, and does not count among those drawn from; its features count.

    The counting jobs run when this is called. An array of ``buckets`` numbers is sent to
    every task.
    """
    prepare(docs.sparkSession)
    source = columns(docs, doc_id=id_col, text=text_col)
    gains = bucket_gains(bucket_counts(source, "text", longest, buckets), bucket_counts(target, target_col, longest, buckets), scale)
    rows = source.mapInArrow(
        _scored(gains, longest, seed, scale),
        "doc_id long, n_features long, weight long, score long, n_words long",
    )
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "scored")
    rows = rows.withColumn("place", -F.col("score"))
    able = F.col("score").isNotNull() & (F.col("n_words") >= least_words)
    wanted = rows.where(able).count() * percent // 100
    fields = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if not wanted:
        return rows.select(*fields, none)
    inside = able & _cut_off(rows.where(able), ["place", "doc_id", "row"], wanted)
    others = rows.where(~F.coalesce(inside, F.lit(False))).select(*fields, none)
    return _ranked(rows.where(inside)).select(*fields, "rank").unionByName(others)
