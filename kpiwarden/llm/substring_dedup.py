"""Long passages that repeat across documents, found by super-k-mer partitioning.

A window is a run of words of fixed length. Its minimiser is the least hash of the short
runs (m-mers) in it. Consecutive windows that share a minimiser travel together: their
hashes, packed into one string, go to the minimiser's bucket. Equal windows have equal
minimisers, so they meet in one bucket, where sorting finds them. Neighbouring windows
mostly share a minimiser, so there are some twenty times fewer rows than windows.

A passage that stands in very many documents makes a minimiser's bucket large. Minimisers
are counted first (before the shuffle as well). One that would fill more than a quarter
of a mean shuffle partition is hot; of those there are at most four times the partitions,
so their list may go to every task. Windows of hot minimisers are summed up to the least
document for each window, again before the shuffle, and what is shared is joined back to
the documents by minimiser; adaptive execution splits that join.

What comes back for a document is a list of word ranges, no longer than the document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiwarden.llm.words import columns, mix, prepare, slices, windows, words
from kpiwarden.sources.scratch import stored

WINDOW = 50
MINIMISER = 10
LEAST_HOT = 1000  # super-k-mers of a minimiser that are always one bucket
SHARE = 4  # hot minimisers per shuffle partition, at most
LOOKUP = 4096  # shared windows of a hot minimiser in one row
PACKED = 6  # bytes of a window's hash; the minimiser's 64 bits are compared besides
_SALT = np.uint64(0x94D049BB133111EB)


class _Runs:
    """Super-k-mers of a slice of documents: runs of windows with one minimiser."""

    def __init__(self, texts: list[bytes | None], size: int, m: int):
        w = words([t or b"" for t in texts])
        self.windows, at = windows(w, size)
        order = np.full(len(w.hash), np.iinfo(np.uint64).max, np.uint64)
        short, short_at = windows(w, m)
        order[short_at] = mix(short ^ _SALT)
        reach, step = size - m + 1, 1
        while step * 2 <= reach:
            order = np.minimum(order[:-step], order[step:])
            step *= 2
        least = np.minimum(order[at], order[at + reach - step])
        doc = np.searchsorted(w.first, at, side="right") - 1
        turn = np.ones(len(at), bool)
        turn[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])
        begin = np.flatnonzero(turn)
        self.edges = np.append(begin, len(at))
        self.key = least[begin].view(np.int64)
        self.doc = doc[begin]
        self.start = (at[begin] - w.first[self.doc]).astype(np.int32)

    def pick(self, chosen: np.ndarray, part: pa.RecordBatch) -> list[pa.Array]:
        docs = pa.array(self.doc[chosen])
        return [
            pa.array(self.key[chosen]),
            part.column("doc_id").take(docs),
            part.column("tag").take(docs),
            pa.array(self.start[chosen]),
        ]

    def held(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and hashes of the windows of the chosen runs."""
        if chosen.all():
            return self.edges, self.windows
        lengths = np.diff(self.edges)
        return np.concatenate(([0], np.cumsum(lengths[chosen]))), self.windows[np.repeat(chosen, lengths)]


def _counted(size: int, m: int):
    """Super-k-mers of each minimiser, and of all under a null key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches, "text"):
            key, n = np.unique(_Runs(texts, size, m).key, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([*key.tolist(), None], pa.int64()), pa.array([*n.tolist(), int(n.sum())], pa.int64())],
                ["key", "n"],
            )

    return run


def _packed(size: int, m: int, hot: np.ndarray):
    """Super-k-mers of the minimisers that are not hot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "text"):
            runs = _Runs(texts, size, m)
            chosen = ~np.isin(runs.key, hot)
            edges, hashes = runs.held(chosen)
            low = np.ascontiguousarray(hashes.view(np.uint8).reshape(-1, 8)[:, :PACKED])
            offsets = pa.py_buffer((edges * PACKED).astype(np.int32))
            packed = pa.BinaryArray.from_buffers(pa.binary(), len(edges) - 1, [None, offsets, pa.py_buffer(low)])
            yield pa.RecordBatch.from_arrays(
                [*runs.pick(chosen, part), packed], ["key", "doc_id", "tag", "start", "packed"]
            )

    return run


def _listed(size: int, m: int, hot: np.ndarray):
    """Super-k-mers of hot minimisers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "text"):
            runs = _Runs(texts, size, m)
            chosen = np.isin(runs.key, hot)
            edges, hashes = runs.held(chosen)
            held = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [*runs.pick(chosen, part), held], ["key", "doc_id", "tag", "start", "windows"]
            )

    return run


_RANGES = "doc_id long, tag long, lo int, hi int"


def _ranges(rows: pa.Table, edges: np.ndarray, again: np.ndarray, size: int) -> pa.RecordBatch:
    """Word ranges of the flagged windows, one for each run of them within a row."""
    row = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    flagged = np.flatnonzero(again)
    new = np.ones(len(flagged), bool)
    new[1:] = (np.diff(flagged) != 1) | (row[flagged[1:]] != row[flagged[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(flagged)) - 1 if len(first) else first
    of = row[flagged[first]]
    start = rows.column("start").to_numpy()[of] - edges[of]
    taken = pa.array(of)
    return pa.RecordBatch.from_arrays(
        [
            rows.column("doc_id").take(taken).combine_chunks(),
            rows.column("tag").take(taken).combine_chunks(),
            pa.array((start + flagged[first]).astype(np.int32)),
            pa.array((start + flagged[last] + size).astype(np.int32)),
        ],
        ["doc_id", "tag", "lo", "hi"],
    )


def _bucket(rows: pa.Table, size: int) -> pa.RecordBatch | None:
    """Ranges of the windows that also start in a document with a smaller id; all rows of a key are here."""
    key, doc = rows.column("key").to_numpy(), rows.column("doc_id").to_numpy()
    group = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
    at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    several = np.minimum.reduceat(doc, at) < np.maximum.reduceat(doc, at)
    if not several.any():
        return None
    keep = several[group]
    rows = rows.filter(pa.array(keep))
    doc, group = doc[keep], group[keep]
    packed = rows.column("packed").combine_chunks()
    raw = b"".join(packed.to_pylist())
    low = np.zeros((len(raw) // PACKED, 8), np.uint8)
    low[:, :PACKED] = np.frombuffer(raw, np.uint8).reshape(-1, PACKED)
    lengths = np.fromiter((len(x) // PACKED for x in packed.to_pylist()), np.int64, len(packed))
    edges = np.concatenate(([0], np.cumsum(lengths)))
    hashes = low.view(np.uint64)[:, 0]
    group = np.repeat(group, lengths)
    order = np.lexsort((hashes, group))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order[1:]] != hashes[order[:-1]]) | (group[order[1:]] != group[order[:-1]])
    owner_at = np.flatnonzero(new)
    docs = np.repeat(doc, lengths)[order]
    least = np.minimum.reduceat(docs, owner_at)
    again = np.empty(len(order), bool)
    again[order] = docs > np.repeat(least, np.diff(np.append(owner_at, len(order))))
    return _ranges(rows, edges, again, size)


def _buckets(size: int, at_once: int = 4096):
    """Whole buckets from sorted rows; a bucket may go over several batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def close(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if parts and (found := _bucket(pa.Table.from_batches(parts), size)) is not None:
                yield found

        for batch in batches:
            for lo in range(0, batch.num_rows, at_once):
                part = batch.slice(lo, at_once)
                key = part.column("key").to_numpy()
                last = int(np.searchsorted(key, key[-1]))  # where the last key begins
                if last or held and held[-1].column("key")[-1].as_py() != key[-1]:
                    yield from close([*held, part.slice(0, last)])
                    held = []
                held.append(part.slice(last))
        yield from close(held)

    return run


def _looked_up(size: int):
    """Ranges of a hot minimiser's rows, each with windows shared under it and their least document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = pa.Table.from_batches([batch.slice(i, 1)])
                doc = row.column("doc_id")[0].as_py()
                held = row.column("windows").combine_chunks().flatten().to_numpy()
                known = row.column("shared").combine_chunks().flatten().to_numpy()
                least = row.column("least").combine_chunks().flatten().to_numpy()
                again = np.isin(held, known[least < doc])
                if again.any():
                    yield _ranges(row, np.asarray([0, len(held)]), again, size)

    return run


def repeated_ranges(source: DataFrame, size: int = WINDOW, m: int = MINIMISER) -> DataFrame:
    """``doc_id, tag, lo, hi``: word ranges to remove, of ``doc_id, tag, text``; they may overlap."""
    spark = source.sparkSession
    known = source.where("doc_id is not null")
    counts = known.select("text").mapInArrow(_counted(size, m), "key long, n long")
    counts = counts.groupBy("key").agg(F.sum("n").alias("n"))
    large = stored(counts.where((F.col("n") > LEAST_HOT) | F.col("key").isNull()), "large")
    total = (large.where("key is null").first() or {"n": 0})["n"]
    limit = max(LEAST_HOT, total // (SHARE * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    hot = large.where(F.col("key").isNotNull() & (F.col("n") > limit)).select("key").collect()
    hot = np.asarray([r["key"] for r in hot], np.int64)
    packed = known.mapInArrow(
        _packed(size, m, hot), "key long, doc_id long, tag long, start int, packed binary"
    )
    found = packed.repartition("key").sortWithinPartitions("key").mapInArrow(_buckets(size), _RANGES)
    return found.unionByName(_hot_ranges(known, hot, size, m)) if len(hot) else found


def _hot_ranges(known: DataFrame, hot: np.ndarray, size: int, m: int) -> DataFrame:
    rows = known.mapInArrow(
        _listed(size, m, hot), "key long, doc_id long, tag long, start int, windows array<long>"
    )
    rows = stored(rows, "hot")
    single = rows.select("key", "doc_id", F.explode("windows").alias("window"))
    shared = single.groupBy("key", "window").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    shared = shared.where("lo < hi")
    rank = F.row_number().over(Window.partitionBy("key").orderBy("window"))
    shared = shared.withColumn("part", F.floor((rank - 1) / LOOKUP)).groupBy("key", "part")
    shared = shared.agg(F.collect_list("window").alias("shared"), F.collect_list("lo").alias("least"))
    shared = shared.select(F.col("key").alias("of"), "shared", "least")
    joined = rows.join(shared, rows["key"] == shared["of"])
    return joined.select("doc_id", "tag", "start", "windows", "shared", "least").mapInArrow(
        _looked_up(size), _RANGES
    )


def with_ranges(docs: DataFrame, id_col: str, text_col: str, size: int, m: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """Each row's ``doc_id, text``, the named extra columns, and ``ranges`` (null if nothing repeats)."""
    prepare(docs.sparkSession)
    # rows that share an id but not the text must not take each other's ranges
    source = columns(docs, doc_id=id_col, text=text_col).withColumn("tag", F.xxhash64("text"))
    ranges = repeated_ranges(source, size, m).distinct().groupBy("doc_id", "tag")
    ranges = ranges.agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    ranges = ranges.select(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag"), "ranges")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        F.xxhash64(text_col).alias("tag"),
        F.struct(*[F.col(f"`{c}`") for c in extra] or [F.lit(0).alias("none")]).alias("rest"),
    )
    joined = rows.join(ranges, (rows["doc_id"] == ranges["_id"]) & (rows["tag"] == ranges["_tag"]), "left")
    return joined.select("doc_id", "text", "rest", "ranges")


def _removed(n_words: int, ranges: list[dict]) -> np.ndarray:
    """Which words the ranges cover."""
    change = np.zeros(n_words + 1, np.int64)
    np.add.at(change, [r["lo"] for r in ranges], 1)
    np.add.at(change, [r["hi"] for r in ranges], -1)
    return np.cumsum(change[:-1]) > 0


def removal_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   size: int = WINDOW, m: int = MINIMISER) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row.

    A word goes if a window that covers it also starts in a document with a smaller id;
    all windows are judged on the input. The hash is that of the kept words joined by
    single spaces. Null, empty and blank texts have no words. A document without an id
    neither loses words nor takes them from others. Of rows with equal ids none is the
    smaller one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            out = []
            for text, ranges in zip(texts, batch.column("ranges").to_pylist()):
                kept = (text or b"").split()
                n = len(kept)
                if ranges:
                    gone = _removed(n, ranges)
                    kept = [x for x, g in zip(kept, gone.tolist()) if not g]
                out.append((n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            n, removed, sha = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    rows = with_ranges(docs, id_col, text_col, size, m).select("doc_id", "text", "ranges")
    return rows.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   size: int = WINDOW, m: int = MINIMISER) -> DataFrame:
    """``docs`` with the repeated passages cut out of the text; what stays keeps its white space.

    A document that is nothing but repeats stays as an empty text. See ``removal_report``
    for what counts as repeated.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            for i, ranges in enumerate(batch.column("ranges").to_pylist()):
                if ranges:
                    texts[i] = _cut(texts[i], ranges)
            yield batch.drop_columns(["text", "ranges"]).append_column("text", pa.array(texts, pa.binary()).cast(pa.string()))

    others = tuple(c for c in docs.columns if c != text_col)
    rows = with_ranges(docs, id_col, text_col, size, m, others).select("text", "rest", "ranges")
    rest = rows.schema["rest"].dataType.simpleString()
    out = rows.mapInArrow(run, f"rest {rest}, text string")
    fields = [F.col("text").alias(c) if c == text_col else F.col("rest")[c].alias(c) for c in docs.columns]
    return out.select(*fields)


def _cut(text: bytes, ranges: list[dict]) -> bytes:
    w = words([text])
    gone = _removed(len(w.hash), ranges)
    turn = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
    out, at = [], 0
    for lo, hi in zip(turn[0::2], turn[1::2]):
        out.append(text[at : w.start[lo]])
        at = w.start[hi] if hi < len(w.start) else len(text)
    out.append(text[at:])
    return b"".join(out)
