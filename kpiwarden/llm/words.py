"""Words of many documents at once, as hashes in numpy arrays.

A word is a run of bytes other than space and the control characters 9 to 13. Every
step works on all bytes of a slice of documents together, so the cost per document is
small and no word becomes a Python object. A slice is cut between documents only: a
document is never shortened, and one that is longer than a slice gets a slice of its own.

Hashes have 64 bits. They depend on the bytes alone, so every task gives the same ones.
"""

from __future__ import annotations

import atexit
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path
from shutil import rmtree
from tempfile import mkdtemp
from zipfile import ZipFile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import kpiwarden

SLICE_BYTES = 1 << 20
BATCH_BYTES = 8 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93  # odd, so it has an inverse modulo 2^64
_SENT: set[str] = set()
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (the splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)


class _Powers:
    """Powers of the base and of its inverse, kept up to the longest slice seen."""

    def __init__(self, base: int):
        self._base = base
        self._inverse = pow(base, -1, 1 << 64)
        self._up = self._down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._up) < n:
            size = max(n, SLICE_BYTES * 2)
            for name, factor in (("_up", self._base), ("_down", self._inverse)):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        up, down = self._up[:n], self._down[:n]
        if n > SLICE_BYTES * 2:  # a giant document's powers are not kept
            self._up = self._down = np.ones(1, np.uint64)
        return up, down


_OF_BYTES = _Powers(_BASE)
_OF_WORDS = _Powers(0xA0761D6478BD642F)


@dataclass
class Words:
    """The words of a slice of documents, in order."""

    data: np.ndarray  # bytes of all documents, one separator after each
    first: np.ndarray  # for each document, the number of its first word; one more at the end
    start: np.ndarray  # of each word in data
    end: np.ndarray
    hash: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words(texts: list[bytes]) -> Words:
    joined = b"\n".join(texts) + b"\n"
    data = np.frombuffer(joined, np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    filled = np.empty(len(data) + 1, bool)
    filled[0] = False
    np.logical_not(_SPACE[data], out=filled[1:])
    turn = np.flatnonzero(filled[1:] != filled[:-1])
    start, end = turn[0::2], turn[1::2]
    up, down = _OF_BYTES.upto(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[data] * up[:-1], out=sums[1:])
    hashes = mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    edges = np.concatenate(([0], np.cumsum(lengths)))
    return Words(data, np.searchsorted(start, edges), start, end, hashes)


def windows(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words within one document, and its first word's number."""
    n = len(w.hash)
    if n < size:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    up, down = _OF_WORDS.upto(n + 1)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(w.hash * up[:n], out=sums[1:])
    at = np.arange(n - size + 1)
    doc_end = np.repeat(w.first[1:], w.counts())
    at = at[at + size <= doc_end[: n - size + 1]]
    return mix((sums[at + size] - sums[at]) * down[at]), at


def byte_windows(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` bytes."""
    n = len(data)
    if n < size:
        return np.empty(0, np.uint64)
    up, down = _OF_BYTES.upto(n + 1)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[data] * up[:n], out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * down[: n - size + 1])


def whole(w: Words, doc: int) -> np.uint64:
    """Hash of all words of one document as a single run."""
    lo, hi = w.first[doc], w.first[doc + 1]
    up, _ = _OF_WORDS.upto(hi - lo + 1)
    total = np.sum(w.hash[lo:hi] * up[: hi - lo], dtype=np.uint64)
    return mix(np.asarray([total]) + np.asarray([hi - lo], np.uint64) * _ODD)[0]


def slices(
    batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Parts of the batches with the column's values as bytes (null stays None), cut after ``most`` bytes."""
    for batch in batches:
        values = batch.column(column).cast(pa.large_binary()).to_pylist()
        lo = size = 0
        for i, v in enumerate(values):
            size += len(v or b"") + 1
            if size >= most or i + 1 == len(values):
                yield batch.slice(lo, i + 1 - lo), values[lo : i + 1]
                lo, size = i + 1, 0


def runs(batches: Iterator[pa.RecordBatch], key: list[str], values: list[str]) -> Iterator[list]:
    """Values of each run of equal keys in sorted batches; a run may go over several batches."""
    held: list[pa.RecordBatch] = []
    at = None

    def close() -> list:
        t = pa.Table.from_batches(held)
        return [
            t.column(v).to_pylist() if pa.types.is_binary(t.schema.field(v).type) else t.column(v).to_numpy()
            for v in values
        ]

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy() for k in key], 1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
            if at is not None and tuple(keys[lo]) != at:
                yield close()
                held = []
            at = tuple(keys[lo])
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield close()


def prepare(spark: SparkSession) -> None:
    """Make the session ready for functions of this library that run in Python workers.

    Batches handed to Python are cut at BATCH_BYTES (Spark's default is 64 MiB), and the
    library's source files are sent to the executors, once per application.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    root = Path(kpiwarden.__file__).parent
    folder = mkdtemp(prefix="kpiwarden-sources-")  # Spark serves the archive from here until the end
    atexit.register(rmtree, folder, ignore_errors=True)
    archive = Path(folder) / "kpiwarden-sources.zip"
    with ZipFile(archive, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SENT.add(context.applicationId)


def columns(df: DataFrame, **names: str) -> DataFrame:
    """Only the named columns, under fixed names, so that no other column can clash."""
    return df.select(*[df[old].alias(new) for new, old in names.items()])
