"""Byte strings of a fixed length that repeat anywhere, by merging Burrows-Wheeler transforms.

Two strings that are equal have the same *anchor*: of the short runs of bytes in a string
the one with the least hash, the first if there are several. Consecutive strings of a
document with the same anchor travel as one piece of text. An anchor that occurs once
holds nothing that repeats, so anchors are counted first, and only the pieces of the
others are sent to their anchor's bucket: all copies of a string meet in one task.

There, pieces are taken in shards of bounded size. A symbol is a fixed part of the length
looked for (a quarter), so that a string is four symbols and the suffixes of a piece are
those of its phases. For each shard the transform is made: the suffixes in the order of
their first four symbols, each with the symbol before it. The shards' transforms are then
merged without sorting suffixes again: an interleave says which shard each row of the
merged order comes from, and every round refines it by dealing out the rows, in their
present order, by the symbol before them. After round r the interleave is in the order of
r symbols, and rows that have these in common are an interval. The intervals of four
symbols are the equal strings; those with more than one string are the repeats.

Anchors whose pieces would be more than ``HOT_BYTES`` are not gathered. Their strings go
by hash, one at a time: each task keeps those that stand more than once with it, the
others are counted in a grouping that sums before its shuffle, and the result is joined
back. Adaptive execution splits that join where a string stands in very many documents.

Strings, symbols and anchors are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiwarden.llm.words import byte_windows, columns, mix, prepare, slices
from kpiwarden.sources.scratch import stored

SIZE = 400
ANCHOR = 64
PART_BYTES = 1 << 20  # of a text looked at in one go; longer texts overlap by a string
LONGEST = 4096  # strings in a piece
HOT_BYTES = 4 << 20  # of an anchor's pieces, from which its strings go by hash
SHARD_BYTES = 1 << 20
MERGE_BYTES = 4 << 20  # of pieces whose shards are merged in one go, and one bucket more
OUT_BYTES = 8 << 20
_POSITION = np.uint64((1 << 22) - 1)
_SALT = np.uint64(0xBF58476D1CE4E5B9)


def stable_order(ids: np.ndarray) -> np.ndarray:
    """Positions in the order of ids below 2^32, equal ones as they stand: by 16 bits at a time."""
    order = np.argsort(ids.astype(np.uint16), kind="stable")
    if len(ids) and int(ids.max()) >> 16:
        high = (ids >> 16).astype(np.uint16)
        order = order[np.argsort(high[order], kind="stable")]
    return order


class Transform:
    """Burrows-Wheeler transform of some pieces, over symbols of ``width`` bytes, to a depth.

    Rows are the empty suffixes, one for each phase of a piece, then all others in the
    order of their first ``depth`` symbols. ``before`` has the symbol before each row, as
    a place in ``alphabet``, or -1 at the beginning of a phase; ``at`` has the place of
    each row that is not empty.
    """

    def __init__(self, pieces: list[bytes], width: int, depth: int):
        data = np.frombuffer(b"".join(pieces), np.uint8)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        edge = np.concatenate(([0], np.cumsum(lengths)))
        begin, end = np.repeat(edge[:-1], lengths), np.repeat(edge[1:], lengths)
        place = np.arange(len(data))
        full = place[place + width <= end]  # a whole symbol begins here
        self.alphabet, named = np.unique(byte_windows(data, width)[full], return_inverse=True)
        symbol = np.zeros(len(data), np.int32)
        symbol[full] = named
        last = full[full + 2 * width > end[full]]  # the last symbol of a phase
        order = full
        for _ in range(depth):
            earlier = order[order - width >= begin[order]] - width
            order = np.concatenate((last, earlier))
            order = order[stable_order(symbol[order])]
        first = order - width < begin[order]
        self.empty = len(last)
        self.at = order
        self.before = np.concatenate((symbol[last], np.where(first, -1, symbol[order - width])))
        self.edge = edge


def merged_intervals(shards: list[Transform], depth: int) -> list[np.ndarray]:
    """For each shard, the interval of ``depth`` common symbols that each of its rows lies in."""
    alphabet = np.unique(np.concatenate([s.alphabet for s in shards]))
    before = []
    for s in shards:
        name = np.append(np.searchsorted(alphabet, s.alphabet), -1).astype(np.int32)
        before.append(name[s.before])
    before = np.concatenate(before)
    sizes = [len(s.before) for s in shards]
    empties = np.repeat(np.arange(len(shards), dtype=np.uint16), [s.empty for s in shards])
    source = np.repeat(np.arange(len(shards), dtype=np.uint16), sizes)
    interval = np.zeros(len(source), np.int32)
    ahead = np.empty_like(before)
    for _ in range(depth):
        ahead[np.argsort(source, kind="stable")] = before
        rows = np.flatnonzero(ahead >= 0)
        rows = rows[stable_order(ahead[rows])]
        symbol, was = ahead[rows], interval[rows]
        new = np.ones(len(rows), bool)
        new[1:] = (symbol[1:] != symbol[:-1]) | (was[1:] != was[:-1])
        source = np.concatenate((empties, source[rows]))
        interval = np.concatenate((np.zeros(len(empties), np.int32), np.cumsum(new, dtype=np.int32)))
    own = interval[np.argsort(source, kind="stable")]
    return np.split(own, np.cumsum(sizes)[:-1])


def depth_of(size: int) -> int:
    """Symbols in a string: four where that divides its length, else another small number."""
    return next(d for d in (4, 5, 3, 2, 7, 1) if size % d == 0)


def repeats_of(pieces: list[bytes], copies: np.ndarray, size: int) -> list[np.ndarray]:
    """For each of some different pieces, which of its strings also stand elsewhere; it stands ``copies`` times itself."""
    depth = depth_of(size)
    shards, begins, lo, held = [], [], 0, 0
    for i, piece in enumerate(pieces):
        held += len(piece)
        if held >= SHARD_BYTES or i + 1 == len(pieces):
            shards.append(Transform(pieces[lo : i + 1], size // depth, depth))
            begins.append(lo)
            lo, held = i + 1, 0
    intervals = merged_intervals(shards, depth)
    starts, weights = [], []
    for s, begin, interval in zip(shards, begins, intervals):
        piece = np.searchsorted(s.edge, s.at, side="right") - 1
        string = s.at + size <= s.edge[piece + 1]
        starts.append((s.at[string], piece[string], interval[s.empty :][string]))
        weights.append(copies[begin + piece[string]])
    count = np.bincount(np.concatenate([x[2] for x in starts]), np.concatenate(weights))
    out = []
    for s, (at, _, interval) in zip(shards, starts):
        again = np.zeros(s.edge[-1], bool)
        again[at] = count[interval] >= 2
        out += [again[a : b - size + 1] for a, b in zip(s.edge[:-1], s.edge[1:])]
    return out


def _parts(texts: list[bytes | None], size: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Lists of (document, offset, bytes) of bounded size with every string of the texts in one of them."""
    held, total = [], 0
    for doc, text in enumerate(texts):
        for lo in range(0, max(1, len(text or b"") - size + 1), PART_BYTES):
            part = (text or b"")[lo : lo + PART_BYTES + size - 1]
            if len(part) >= size:
                held.append((doc, lo, part))
                total += len(part)
            if total >= PART_BYTES:
                yield held
                held, total = [], 0
    if held:
        yield held


def anchored_runs(parts: list[tuple[int, int, bytes]], size: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Document, offset, number of strings, anchor, and places of that anchor, of each run of strings with one anchor."""
    lengths = np.fromiter((len(p[2]) for p in parts), np.int64, len(parts))
    data = np.frombuffer(b"".join(p[2] for p in parts), np.uint8)
    hashes = mix(byte_windows(data, anchor) ^ _SALT)
    least = (hashes & ~_POSITION) | np.arange(len(hashes), dtype=np.uint64)
    reach, step = size - anchor + 1, 1
    while step * 2 <= reach:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    edge = np.concatenate(([0], np.cumsum(lengths)))
    at = np.arange(len(data))
    at = at[at + size <= np.repeat(edge[1:], lengths)]
    place = (np.minimum(least[at], least[at + reach - step]) & _POSITION).astype(np.int64)
    begin = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    # runs of neighbouring places of equal anchors, as in text that repeats itself, are joined
    key, part = hashes[place[begin]], np.searchsorted(edge, at[begin], side="right") - 1
    new = np.ones(len(begin), bool)
    new[1:] = (key[1:] != key[:-1]) | (part[1:] != part[:-1])
    group = np.cumsum(new) - 1
    first = begin[new][group]
    new |= np.diff((begin - first) // LONGEST, prepend=0) != 0
    some = np.flatnonzero(new)
    begin, key, part = begin[some], key[some], part[some]
    doc = np.fromiter((p[0] for p in parts), np.int64, len(parts))[part]
    offset = np.fromiter((p[1] for p in parts), np.int64, len(parts))[part]
    n = np.diff(np.append(begin, len(at)))
    places = np.diff(np.append(some, len(new)))
    return doc, at[begin] - edge[part] + offset, n, key.view(np.int64), places


_RUN = "doc_id long, tag long, start long, n int, key long, places int"


def _listed(size: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "text"):
            for parts in _parts(texts, size):
                doc, start, n, key, places = anchored_runs(parts, size, anchor)
                doc = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(doc), part.column("tag").take(doc), pa.array(start),
                        pa.array(n.astype(np.int32)), pa.array(key), pa.array(places.astype(np.int32)),
                    ],
                    ["doc_id", "tag", "start", "n", "key", "places"],
                )

    return run


_PIECE = "key long, doc_id long, tag long, start long, piece binary, n int, until long"


def _cut(size: int):
    """Pieces of anchors that are not hot; of hot ones the strings' hashes, and what a batch has twice.

    A row is a piece; a string that stands ``n`` times here, with its place if it is once;
    or a range that repeats.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text"):
            ids, tags = batch.column("doc_id").to_pylist(), batch.column("tag").to_pylist()
            rows, held, hot = [], 0, []
            for i, (text, runs) in enumerate(zip(texts, batch.column("runs").to_pylist())):
                for r in runs:
                    if r["hot"]:
                        piece = np.frombuffer(text[r["start"] : r["start"] + r["n"] + size - 1], np.uint8)
                        hot.append((i, r["start"], byte_windows(piece, size)))
                        continue
                    piece = text[r["start"] : r["start"] + r["n"] + size - 1]
                    rows.append((r["key"], ids[i], tags[i], r["start"], piece, None, None))
                    held += len(piece)
                    if held >= OUT_BYTES:
                        yield _rows(rows)
                        rows, held = [], 0
            yield _rows(rows)
            if hot:
                yield _hot_rows(hot, ids, tags, size)

    return run


_PIECE_FIELDS = ("key", "doc_id", "tag", "start", "piece", "n", "until")
_PIECE_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64())


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    held = zip(*rows) if rows else [()] * len(_PIECE_FIELDS)
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(held, _PIECE_TYPES)], list(_PIECE_FIELDS))


def _hot_rows(hot: list[tuple], ids: list, tags: list, size: int) -> pa.RecordBatch:
    hashes = np.concatenate([h for _, _, h in hot]).view(np.int64)
    row = np.concatenate([np.full(len(h), i) for i, _, h in hot])
    at = np.concatenate([s + np.arange(len(h)) for _, s, h in hot])
    key, name, n = np.unique(hashes, return_inverse=True, return_counts=True)
    place = np.empty(len(key), np.int64)
    place[name] = np.arange(len(hashes))
    once = n == 1
    null = ~once
    of = pa.array(row[place], mask=null)
    strings = [
        pa.array(key), pa.array(ids, pa.int64()).take(of), pa.array(tags, pa.int64()).take(of),
        pa.array(at[place], mask=null), pa.nulls(len(key), pa.binary()),
        pa.array(np.minimum(n, 2).astype(np.int32)), pa.nulls(len(key), pa.int64()),
    ]
    again = np.flatnonzero(n[name] > 1)
    row, at = row[again], at[again]
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (np.diff(row) != 0)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1 if len(first) else first
    of = pa.array(row[first])
    ranges = [
        pa.nulls(len(first), pa.int64()), pa.array(ids, pa.int64()).take(of), pa.array(tags, pa.int64()).take(of),
        pa.array(at[first]), pa.nulls(len(first), pa.binary()), pa.nulls(len(first), pa.int32()),
        pa.array(at[last] + size),
    ]
    return pa.RecordBatch.from_arrays(
        [pa.concat_arrays([a, b]) for a, b in zip(strings, ranges)], list(_PIECE_FIELDS)
    )


_RANGE = "doc_id long, tag long, lo long, hi long"


def _bucket_ranges(rows: pa.Table, size: int) -> pa.RecordBatch:
    """Ranges of the repeated strings of whole buckets; equal pieces are looked at once."""
    held: dict[tuple, int] = {}
    keys, pieces = rows.column("key").to_pylist(), rows.column("piece").to_pylist()
    of = np.fromiter((held.setdefault(k, len(held)) for k in zip(keys, pieces)), np.int64, len(keys))
    copies = np.bincount(of, minlength=len(held))
    alone: dict[int, int] = {}
    for k, _ in held:
        alone[k] = alone.get(k, 0) + 1
    different = list(held)
    # a bucket of one piece and its copies needs no comparison
    open_ = [i for i, (k, _) in enumerate(different) if alone[k] > 1 or copies[i] == 1]
    flags: list[np.ndarray | None] = [None] * len(different)
    if open_:
        found = repeats_of([different[i][1] for i in open_], copies[open_], size)
        for i, again in zip(open_, found):
            flags[i] = again
    turns = []
    for again, (_, piece) in zip(flags, different):
        if again is None:
            turns.append(([0], [len(piece)]))
        else:
            turn = np.flatnonzero(np.diff(np.concatenate(([False], again, [False])).astype(np.int8)))
            turns.append((turn[0::2].tolist(), (turn[1::2] + size - 1).tolist()))
    row, lo, hi = [], [], []
    for i, (x, start) in enumerate(zip(of.tolist(), rows.column("start").to_pylist())):
        for a, b in zip(*turns[x]):
            row.append(i)
            lo.append(start + a)
            hi.append(start + b)
    taken = pa.array(row, pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            rows.column("doc_id").combine_chunks().take(taken), rows.column("tag").combine_chunks().take(taken),
            pa.array(lo, pa.int64()), pa.array(hi, pa.int64()),
        ],
        ["doc_id", "tag", "lo", "hi"],
    )


def _buckets(size: int):
    """Whole buckets, MERGE_BYTES of them at a time, from rows sorted by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        total = 0
        for batch, pieces in slices(batches, "piece"):
            key = batch.column("key").to_numpy()
            if total >= MERGE_BYTES:
                last = held[-1].column("key")[-1].as_py()
                rest = int(np.searchsorted(key, last, side="right"))  # of the bucket that is open
                if rest < len(key):
                    yield _bucket_ranges(pa.Table.from_batches([*held, batch.slice(0, rest)]), size)
                    held, total = [], 0
                    batch, pieces = batch.slice(rest), pieces[rest:]
            held.append(batch)
            total += sum(map(len, pieces))
        if held:
            yield _bucket_ranges(pa.Table.from_batches(held), size)

    return run


def repeated_ranges(source: DataFrame, size: int = SIZE, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id, tag, lo, hi``: byte ranges to remove, of ``doc_id, tag, text``; they may overlap."""
    runs = stored(source.mapInArrow(_listed(size, anchor), _RUN), "runs")
    anchors = runs.groupBy("key").agg(
        F.sum("places").alias("places"), F.sum(F.col("n") + size - 1).alias("bytes")
    )
    anchors = anchors.where("places > 1").select(F.col("key").alias("of"), (F.col("bytes") > HOT_BYTES).alias("hot"))
    some = runs.join(anchors, runs["key"] == anchors["of"])
    # rows that share id and text list the same runs
    some = some.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("start", "n", "key", "hot")).alias("runs"))
    some = some.select(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag"), "runs")
    texts = source.join(some, source["doc_id"].eqNullSafe(some["_id"]) & (source["tag"] == some["_tag"]))
    pieces = stored(texts.select("doc_id", "tag", "text", "runs").mapInArrow(_cut(size), _PIECE), "pieces")
    buckets = pieces.where("piece is not null").select("key", "doc_id", "tag", "start", "piece")
    found = buckets.repartition("key").sortWithinPartitions("key").mapInArrow(_buckets(size), _RANGE)
    at_once = pieces.where("until is not null").select("doc_id", "tag", F.col("start").alias("lo"), F.col("until").alias("hi"))
    strings = pieces.where("n is not null")
    again = strings.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select(F.col("key").alias("of"))
    single = strings.where("n = 1").select("key", "doc_id", "tag", "start")
    hot = single.join(again, single["key"] == again["of"]).select(
        "doc_id", "tag", F.col("start").alias("lo"), (F.col("start") + size).alias("hi")
    )
    return found.unionByName(at_once).unionByName(hot)


def spans(ranges: list[dict] | None, length: int) -> np.ndarray:
    """Maximal spans, in order, as rows of begin and end, that ranges within a text cover."""
    if not ranges:
        return np.empty((0, 2), np.int64)
    change = np.zeros(length + 1, np.int32)
    np.add.at(change, [r["lo"] for r in ranges], 1)
    np.add.at(change, [r["hi"] for r in ranges], -1)
    gone = np.concatenate(([False], np.cumsum(change[:-1]) > 0, [False]))
    return np.flatnonzero(gone[1:] != gone[:-1]).reshape(-1, 2)


def kept_bytes(text: bytes, cut: np.ndarray) -> bytes:
    """The text without the spans."""
    edge = [0, *cut.ravel().tolist(), len(text)]
    return b"".join(text[a:b] for a, b in zip(edge[0::2], edge[1::2]))


def with_ranges(docs: DataFrame, id_col: str, text_col: str, size: int, anchor: int) -> DataFrame:
    """``doc_id, text, ranges`` of every row; ``ranges`` is null where nothing repeats."""
    prepare(docs.sparkSession)
    # rows that share an id but not the text must not take each other's ranges
    source = columns(docs, doc_id=id_col, text=text_col).withColumn("tag", F.xxhash64("text"))
    ranges = stored(repeated_ranges(source, size, anchor), "ranges").groupBy("doc_id", "tag")
    ranges = ranges.agg(F.collect_set(F.struct("lo", "hi")).alias("ranges"))
    ranges = ranges.select(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag"), "ranges")
    same = source["doc_id"].eqNullSafe(ranges["_id"]) & (source["tag"] == ranges["_tag"])
    return source.join(ranges, same, "left").select("doc_id", "text", "ranges")


def _mapped(docs: DataFrame, per_text, kind: str) -> DataFrame:
    names = [x.split()[0] for x in kind.split(", ")]
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "text"):
            found = [per_text(t or b"", spans(r, len(t or b""))) for t, r in zip(texts, part.column("ranges").to_pylist())]
            made = [pa.array(v, types[x.split()[1]]) for v, x in zip(zip(*found), kind.split(", ")[1:])]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *made], names)

    return docs.mapInArrow(run, kind)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    size: int = SIZE, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id, kept`` of every row: the bytes that stay, which need not be whole characters.

    See ``removal_report`` for what goes.
    """
    rows = with_ranges(docs, id_col, text_col, size, anchor)
    return _mapped(rows, lambda text, cut: (kept_bytes(text, cut),), "doc_id long, kept binary")


def removal_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   size: int = SIZE, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row.

    A byte goes if a string of ``size`` bytes that covers it also starts anywhere else, in
    the same document or another; all strings are judged on the input. ``n_spans`` counts
    the maximal runs of bytes that go. Null and empty texts have no bytes. Rows that
    repeat, with or without an id, are documents like any other: the strings of each also
    start in the others.
    """

    def digest(text: bytes, cut: np.ndarray) -> tuple:
        kept = kept_bytes(text, cut)
        return len(text), len(text) - len(kept), len(cut), hashlib.sha256(kept).hexdigest()

    rows = with_ranges(docs, id_col, text_col, size, anchor)
    return _mapped(rows, digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
