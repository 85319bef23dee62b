"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

The parts of pre-tokens form a linked list of byte positions. Each pair of neighbours
that is a token waits in the bucket of its rank; a bitmap over the ranks, with a bitmap
over its words above it, tells the lowest rank that waits by finding first set bits. An
entry whose pair has changed meanwhile is skipped when its turn comes. A merge costs a
constant number of such steps and a heap's, so that pre-tokens of any length are encoded
in about linear time.

All pre-tokens of a slice of documents that are not remembered share one list and one
queue. A byte that no token of several bytes holds stands between them, so nothing merges
across, and each has its own pairs merged in the order of their ranks as it would alone.
Of pre-tokens up to ``_SHORT`` bytes, a bucket's positions are merged together, one of
each pre-token at a time, in numpy arrays. Longer ones have the positions of a bucket in a
heap and merge one after the other, as a merge may call for a lower rank first.
Pre-tokens repeat, so their ids are remembered in memory bounded by bytes.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from kpiwarden.llm.remembered import Remembered, no_collection
from kpiwarden.llm.words import columns, prepare, slices

_SHIFT = 8  # the bitmap's words have 256 bits, so two levels hold all ranks
_MASK = (1 << _SHIFT) - 1
_SHORT = 64
_SLICE = 4 << 20  # bytes of texts whose new pre-tokens are merged together
_HELD = 48 << 20  # bytes of memory for each kind of piece
_GONE, _UNKNOWN = -1, -2
_BETWEEN = b"\xff"  # no byte of UTF-8
_CODECS: dict = {}
# White space that is more than single spaces and line feeds between other characters.
_WIDE = re.compile(r"\s\s|[^\S \n]")


class ByteBpe:
    """Encoder and decoder for ranks of byte strings and a pattern of pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self._longer = {t: rank for t, rank in ranks.items() if len(t) > 1 and _BETWEEN not in t}
        self._of_byte = np.asarray([ranks.get(bytes([x]), _UNKNOWN) for x in range(256)], np.int32)
        self._of_byte[_BETWEEN[0]] = _GONE
        self._of_pair = np.full(1 << 16, _GONE, np.int32)
        for token, rank in self._longer.items():
            if len(token) == 2:
                self._of_pair[int.from_bytes(token)] = rank
        self._size = len(self.tokens) + 2
        halves = [
            ((ranks[t[:k]] + 2) * self._size + ranks[t[k:]] + 2, rank)
            for t, rank in self._longer.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks
        ]
        self._halves, self._whole = np.asarray(sorted(halves) or [(0, _GONE)], np.int64).T.copy()
        self._pattern = regex.compile(pattern)
        self._words = [0] * ((len(self.tokens) >> _SHIFT) + 1)  # all zero between calls
        self._pre_tokens, self._first, self._after_space = (Remembered(most=_HELD) for _ in range(3))

    @classmethod
    def load(cls, path: str, pattern: str) -> ByteBpe:
        with open(path, "rb") as f:
            rows = (line.split() for line in f if line.strip())
            return cls({base64.b64decode(token): int(rank) for token, rank in rows}, pattern)

    def merge(self, data: bytes) -> list[int]:
        """Ids of one pre-token."""
        return np.frombuffer(self.merge_all([data])[0], "<u4").tolist()

    def merge_all(self, pre_tokens: list[bytes]) -> list[bytes]:
        """Ids of each pre-token (UTF-8), as little-endian 32-bit numbers."""
        known = [self.ranks.get(x) for x in pre_tokens]
        short = iter(self._together([x for x, r in zip(pre_tokens, known) if r is None and len(x) <= _SHORT]))
        long = iter(self._by_heap([x for x, r in zip(pre_tokens, known) if r is None and len(x) > _SHORT]))
        return [
            next(short if len(x) <= _SHORT else long) if rank is None else rank.to_bytes(4, "little")
            for x, rank in zip(pre_tokens, known)
        ]

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of tokens, ``_GONE`` where they do not merge."""
        key = (left.astype(np.int64) + 2) * self._size + right + 2
        at = np.minimum(np.searchsorted(self._halves, key), len(self._halves) - 1)
        return np.where(self._halves[at] == key, self._whole[at], _GONE)

    def _pairs(self, pre_tokens: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Bytes with separators, and the rank of the pair that begins at each."""
        data = _BETWEEN + _BETWEEN.join(pre_tokens) + _BETWEEN
        at = np.frombuffer(data, np.uint8)
        waiting = np.full(len(data), _GONE, np.int32)
        waiting[:-1] = self._of_pair[at[:-1].astype(np.int32) << 8 | at[1:]]
        return data, at, waiting

    def _together(self, pre_tokens: list[bytes]) -> list[bytes]:
        if not pre_tokens:
            return []
        _, at, waiting = self._pairs(pre_tokens)
        after, before = np.arange(1, len(at) + 1), np.arange(-1, len(at) - 1)
        token, own = self._of_byte[at], np.cumsum(at == _BETWEEN[0])
        buckets, top = self._queue(waiting)
        buckets, words = {rank: [positions] for rank, positions in buckets.items()}, self._words
        while top:
            high = (top & -top).bit_length() - 1
            low = words[high] & -words[high]
            rank = (high << _SHIFT) + low.bit_length() - 1
            held = buckets.pop(rank)
            i = np.concatenate(held) if len(held) > 1 else held[0]
            i = np.sort(i[waiting[i] == rank])  # without pairs that have changed since
            first = np.ones(len(i), bool)
            np.not_equal(own[i[1:]], own[i[:-1]], out=first[1:])
            if first.all():
                words[high] ^= low
                if not words[high]:
                    top ^= 1 << high
            else:
                buckets[rank] = [i[~first]]
                i = i[first]
            if not len(i):
                continue
            gone = after[i]
            end = after[i] = after[gone]
            before[end] = i
            token[i], token[gone], waiting[gone] = rank, _GONE, _GONE
            left = before[i]
            start = np.concatenate([i, left])
            new = self._ranks_of(token[start], np.concatenate([token[end], token[i]]))
            waiting[start] = new
            order = np.argsort(new, kind="stable")
            order = order[np.searchsorted(new[order], 0) :]
            start, new = start[order], new[order]
            turns = np.ones(len(new), bool)
            np.not_equal(new[1:], new[:-1], out=turns[1:])
            cuts = np.flatnonzero(turns).tolist()
            for rank, lo, hi in zip(new[cuts].tolist(), cuts, [*cuts[1:], len(new)]):
                if rank in buckets:
                    buckets[rank].append(start[lo:hi])
                else:
                    buckets[rank] = [start[lo:hi]]
                    words[rank >> _SHIFT] |= 1 << (rank & _MASK)
                    top |= 1 << (rank >> _SHIFT)
        return self._ids(token, at)

    def _by_heap(self, pre_tokens: list[bytes]) -> list[bytes]:
        if not pre_tokens:
            return []
        data, at, pairs = self._pairs(pre_tokens)
        number = np.arange(len(data) + 1, dtype=np.int64)
        after, before = array("q", (number + 1).tobytes()), array("q", (number - 1).tobytes())
        token, waiting = array("i", self._of_byte[at].tobytes()), array("i", pairs.tobytes())
        buckets, top = self._queue(pairs)
        buckets = {rank: positions.tolist() for rank, positions in buckets.items()}
        words, rank_of = self._words, self._longer.get
        while top:
            word = words[high := (top & -top).bit_length() - 1]
            low = word & -word
            rank = (high << _SHIFT) + low.bit_length() - 1
            bucket, least = buckets[rank], rank
            while bucket and least == rank:
                i = heappop(bucket)
                if waiting[i] != rank:
                    continue  # the pair has changed since
                gone = after[i]
                end = after[i] = after[gone]
                before[end] = i
                token[i], token[gone], waiting[gone] = rank, _GONE, _GONE
                left = before[i]
                for start, stop in ((i, after[end]), (left, end)):
                    new = rank_of(data[start:stop])
                    if new is None:
                        waiting[start] = _GONE
                        continue
                    waiting[start] = new
                    held = buckets.get(new)
                    if held is None:
                        buckets[new] = [start]
                        words[new >> _SHIFT] |= 1 << (new & _MASK)
                        top |= 1 << (new >> _SHIFT)
                    else:
                        heappush(held, start)
                    if new < least:
                        least = new  # the pair's turn comes first
            if not bucket:
                del buckets[rank]
                words[high] ^= low
                if not words[high]:
                    top ^= 1 << high
        return self._ids(np.frombuffer(token, np.int32), at)

    @staticmethod
    def _ids(token: np.ndarray, at: np.ndarray) -> list[bytes]:
        if (token == _UNKNOWN).any():
            raise KeyError("a byte without a rank")
        there = token != _GONE
        edges = (np.cumsum(there)[at == _BETWEEN[0]] * 4).tolist()
        out = token[there].astype("<u4").tobytes()
        return [out[lo:hi] for lo, hi in zip(edges, edges[1:])]

    def _queue(self, pairs: np.ndarray) -> tuple[dict[int, np.ndarray], int]:
        """Positions by rank, in order, and the words of the bitmap that are set."""
        order = np.argsort(pairs, kind="stable")
        order = order[np.searchsorted(pairs[order], 0) :]
        ranks, first = np.unique(pairs[order], return_index=True)
        buckets, top = dict(zip(ranks.tolist(), np.split(order, first[1:]))), 0
        for rank in buckets:
            self._words[rank >> _SHIFT] |= 1 << (rank & _MASK)
            top |= 1 << (rank >> _SHIFT)
        return buckets, top

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers.

        Where all white space is single spaces and line feeds, no pre-token goes beyond
        one, and a space begins the pre-token that follows it. Such a text is cut there
        without the pattern, and its words are remembered too.
        """
        with no_collection():
            return self._encode_all(texts)

    def _encode_all(self, texts: list[str]) -> list[bytes]:
        lines = [None if _WIDE.search(t) else [line.split(" ") for line in t.split("\n")] for t in texts]
        words = {"\n"}.union(x[0] for text in lines if text for x in text)
        spaced = set().union(*(x[1:] for text in lines if text for x in text))
        first, later = self._first.known(words), self._after_space.known(spaced)
        found = self._pattern.findall
        new_first = {x: found(x) for x in words - first.keys()}
        new_later = {x: found(" " + x) for x in spaced - later.keys()}
        whole = {t: found(t) for t, text in zip(texts, lines) if text is None}
        cuts = [*new_first.values(), *new_later.values(), *whole.values()]
        pre_tokens = set().union(*cuts)
        ids = self._pre_tokens.known(pre_tokens)
        new = list(pre_tokens - ids.keys())
        merged = dict(zip(new, self.merge_all([x.encode() for x in new])))
        self._pre_tokens.keep(merged)
        ids |= merged
        for held, kept, cut in ((self._first, first, new_first), (self._after_space, later, new_later)):
            pieces = {x: ids[y[0]] if len(y) == 1 else b"".join([ids[z] for z in y]) for x, y in cut.items()}
            held.keep(pieces)
            kept |= pieces
        feed, out = first["\n"], []
        for t, text in zip(texts, lines):
            if text is None:
                out.append(b"".join([ids[x] for x in whole[t]]))
                continue
            parts = []
            for x in text:
                parts.append(feed)
                parts.append(first[x[0]])
                parts.extend(map(later.__getitem__, x[1:]))
            out.append(b"".join(parts[1:]))
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def codec(path: str, pattern: str) -> ByteBpe:
    """One per file and pattern in a Python worker."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = ByteBpe.load(path, pattern)
    return _CODECS[path, pattern]


def encoded(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` of every row: little-endian 32-bit ids; null texts count as empty."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for part, texts in slices(batches, "text", _SLICE):
            ids = own.encode_all([(t or b"").decode() for t in texts])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return columns(docs, doc_id=id_col, text=text_col).mapInArrow(run, "doc_id long, ids binary")


def decoded(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids, bytes``: the bytes that the ids stand for, which need not be whole characters."""
    prepare(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for part, ids in slices(batches, "ids"):
            data = pa.array([None if x is None else own.decode(x) for x in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), data], ["doc_id", "ids", "bytes"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, bytes binary")


def round_trip_report(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row.

    Hashes are of the ids in decimal, joined by single spaces, and of the bytes they decode
    to. A null or empty text has no tokens. Rows that repeat are reported each. One pass
    does it all, so that ids do not travel between Python workers.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        decimal = [str(i) for i in range(len(own.tokens))]
        for part, texts in slices(batches, "text", _SLICE):
            rows = []
            for ids in own.encode_all([(t or b"").decode() for t in texts]):
                numbers = np.frombuffer(ids, "<u4").tolist()
                listed = " ".join(map(decimal.__getitem__, numbers)).encode()
                hashes = (hashlib.sha256(x).hexdigest() for x in (listed, own.decode(ids)))
                rows.append((len(numbers), *hashes))
            n, first, second = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(first), pa.array(second)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    source = columns(docs, doc_id="doc_id", text="text")
    return source.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
