"""Best-fit-decreasing packing of tokenised documents into sequences of fixed length.

Documents are tokenised where they are read; from then on only lengths move. The pieces
are dealt out evenly to shards of bounded size, and each shard packs its own: longest
piece first, each into the open sequence with the least room that suffices. A segment
tree over the possible amounts of room finds it in a number of steps logarithmic in the
sequence length, however many sequences are open. With tens of thousands of pieces in a
shard, what shards cannot share is a sequence or two each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiwarden.llm.remembered import LONGEST, RememberedNumbers
from kpiwarden.llm.words import columns, prepare, slices
from kpiwarden.sources.scratch import stored

LENGTH = 2048
SHARD = 50_000  # pieces a shard has on average
SLICE = 2 << 20  # bytes of texts that are encoded at once
HELD = 16 << 20  # bytes of parts of words and their ids that are kept
_MARKS = ".,!?;:*#$%&|"
_MARK, _LETTER, _UPPER = (np.zeros(256, bool) for _ in range(3))
_MARK[list(_MARKS.encode())] = True
_UPPER[ord("A") : ord("Z") + 1] = _LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1] = True

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_TOKENIZERS: dict = {}


class WordTokenizer:
    """Ids of texts by a ``tokenizers`` file, as little-endian 32-bit numbers.

    Only for tokenizers that fold case, never join anything across a space, a line feed or
    the edge of a run of letters, and mark the end of such a run in its last token. Words
    are then encoded once and remembered, letters in lower case and apart from the marks
    that follow them, which is exact and far quicker. What is not plainly so is encoded as
    it stands.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._parts = RememberedNumbers(HELD)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text. All of it is done on arrays, but for parts of words that are not remembered."""
        data, edge, first = _parts_of_words(texts)
        parts = pa.LargeStringArray.from_buffers(len(edge) - 1, pa.py_buffer(edge), pa.py_buffer(data))
        ids, edge = self._parts.of(parts, self._new_parts)
        out = ids.tobytes()
        at = (4 * edge[first]).tolist()
        return [out[x:y] for x, y in zip(at, at[1:])]

    def _new_parts(self, parts: list[str]) -> dict[str, bytes]:
        letters, others, long = [], [], []
        for p in parts:
            (long if len(p) > LONGEST else letters if self._plain(p) else others).append(p)
        out = {p: self._encoded([p])[0] for p in long}
        out.update(zip(letters, self._encoded_runs(letters), strict=True))
        out.update(zip(others, self._encoded(others), strict=True))
        return out

    @staticmethod
    def _plain(part: str) -> bool:
        """Letters of which each has a lower case of its own, composed and in one piece."""
        return part.isalpha() and (part.isascii() or max(part) <= "\xff")

    def _encoded(self, parts: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        return [np.asarray(e.ids, "<u4").tobytes() for e in found]

    def _encoded_runs(self, runs: list[str]) -> list[bytes]:
        """Runs of letters encoded as one text, which is cut after each token that ends a run."""
        out = []
        for lo in range(0, len(runs), 2000):
            ids = self._encoded([" ".join(runs[lo : lo + 2000])])[0]
            ends = np.flatnonzero(self._ends[np.frombuffer(ids, "<u4")]) + 1
            at = [0, *(ends * 4).tolist()]
            out += [ids[x:y] for x, y in zip(at, at[1:])]
        return out


def _parts_of_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The parts of all words end to end, where each begins (and the last ends), and each text's first part.

    Words stand between spaces and line feeds. One of letters (of ASCII, or U+00C0 to
    U+00FF) that marks may follow is put in lower case and cut before its marks; any other
    word is one part, as it stands. The number of parts follows after the last text.
    """
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8).copy()
    data[data == 10] = 32
    kind = np.int32 if len(data) < 1 << 31 else np.int64
    space = data == 32
    end = np.flatnonzero(space)
    begin = np.concatenate(([0], end + 1))[: len(end)]
    begin, end = begin[end > begin], end[end > begin]
    letter, upper = _LETTER[data], _UPPER[data]
    second = np.flatnonzero(data == 0xC3) + 1
    second = second[(data[second] != 0x97) & (data[second] != 0xB7)]  # no letters: times, divided by
    letter[second - 1] = letter[second] = True
    upper[second[data[second] <= 0x9E]] = True
    after = np.where(_MARK[data], kind(0), np.arange(1, len(data) + 1, dtype=kind))
    marks = np.maximum.accumulate(after, out=after)[end - 1]  # behind the last byte that is no mark
    letters = np.zeros(len(data) + 1, kind)
    np.cumsum(letter, out=letters[1:])
    plain = (marks > begin) & (letters[marks] - letters[begin] == marks - begin)
    within = np.zeros(len(data) + 1, np.int8)
    within[begin[plain]] = 1
    within[marks[plain]] = -1
    data[upper & np.cumsum(within[:-1], dtype=np.int8).view(bool)] += 32
    cut = np.sort(np.concatenate((begin, marks[plain & (marks < end)])))
    kept = letters  # its memory is used again
    np.cumsum(~space, out=kept[1:])
    stop = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    first = np.concatenate(([0], np.searchsorted(cut, stop)))
    return data[~space], np.append(kept[cut], kept[-1]).astype(np.int64), first


def tokenizer(path: str) -> WordTokenizer:
    """One per file and Python worker."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def tokenised_pieces(
    docs: DataFrame, path: str, length: int = LENGTH, end: int = 0,
    id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``, 32-bit numbers as bytes).

    A document is its ids followed by ``end``. One that is longer than ``length`` is cut
    into pieces of that length, the last of which may be shorter. A null text counts as
    empty, so that its only id is ``end``.
    """
    prepare(docs.sparkSession)
    last = np.asarray([end], "<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        for part, texts in slices(batches, "text", SLICE):
            row, piece, held = [], [], []
            for i, ids in enumerate(own.encode([t or b"" for t in texts])):
                ids += last
                for k, at in enumerate(range(0, len(ids), 4 * length)):
                    row.append(i)
                    piece.append(k)
                    held.append(ids[at : at + 4 * length])
            number = np.asarray(piece, np.int32)
            arrays = [
                part.column("doc_id").take(pa.array(row, pa.int64())),
                pa.array(number),
                pa.array(number.astype(np.int64) * length),
                pa.array([len(x) // 4 for x in held], pa.int64()),
                pa.array([zlib.crc32(x) for x in held], pa.int64()),
                pa.array(held, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays[: len(names)], names)

    source = columns(docs, doc_id=id_col, text=text_col)
    return source.mapInArrow(run, PIECES + ", ids binary" * with_ids)


class RoomTree:
    """Open sequences by the room they have left, with the tightest fit in logarithmic time."""

    def __init__(self, length: int):
        self._width = 1 << length.bit_length()
        self._open = [0] * (2 * self._width)  # of each subtree
        self._at: list[list[int]] = [[] for _ in range(length + 1)]

    def add(self, room: int, sequence: int) -> None:
        self._at[room].append(sequence)
        self._change(room, 1)

    def take(self, room: int) -> int:
        self._change(room, -1)
        return self._at[room].pop()

    def _change(self, room: int, by: int) -> None:
        node = room + self._width
        while node:
            self._open[node] += by
            node >>= 1

    def tightest(self, need: int) -> int | None:
        """The least room of at least ``need`` that some open sequence has."""
        node, count = need + self._width, self._open
        if count[node]:
            return need
        while node > 1:
            if not node & 1 and count[node + 1]:
                node += 1
                while node < self._width:
                    node *= 2
                    if not count[node]:
                        node += 1
                return node - self._width
            node >>= 1
        return None


def best_fit_decreasing(lengths: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; ties in the order given."""
    tree, opened = RoomTree(length), 0
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        room = tree.tightest(need)
        if room is None:
            room, number = length, opened
            opened += 1
        else:
            number = tree.take(room)
        sequence[i], offset[i] = number, length - room
        if room > need:
            tree.add(room - need, number)
    return sequence, offset


def pack(pieces: DataFrame, length: int = LENGTH, shard: int = SHARD) -> DataFrame:
    """``pieces`` (each 1 to ``length`` long) with ``sequence_id`` and ``offset``.

    Every row is placed, rows that repeat as well. Sequence numbers are not consecutive
    over shards. ``pieces`` should be stored: they are counted, then read again.
    """
    shards = max(1, -(-pieces.count() // shard))
    number = F.monotonically_increasing_id()
    rows = pieces.withColumn("shard", F.pmod(F.xxhash64(number), F.lit(shards)))

    def place(table: pa.Table) -> pa.Table:
        order = pc.sort_indices(table, [("doc_id", "ascending"), ("piece", "ascending")])
        table = table.take(order)
        sequence, offset = best_fit_decreasing(table.column("length").to_numpy(), length)
        sequence += int(table.column("shard")[0].as_py()) << 32
        table = table.drop_columns(["shard"])
        return table.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return rows.groupBy("shard").applyInArrow(place, ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema] + ["sequence_id long", "offset long"]
    ))


def packed_documents(docs: DataFrame, path: str, length: int = LENGTH, end: int = 0,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Where every piece of every document goes: ``PIECES`` with ``sequence_id`` and ``offset``."""
    pieces = tokenised_pieces(docs, path, length, end, id_col, text_col)
    return pack(stored(pieces, "pieces"), length)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, length, ids``: the sequences themselves, of packed pieces with their ids."""

    def join(table: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(table.column("offset")))
        ids = b"".join(table.column("ids").to_pylist())
        return pa.table({
            "sequence_id": table.column("sequence_id").slice(0, 1),
            "length": pa.array([len(ids) // 4], pa.int64()),
            "ids": pa.array([ids], pa.binary()),
        })

    rows = packed.select("sequence_id", "offset", "ids")
    return rows.groupBy("sequence_id").applyInArrow(join, "sequence_id long, length long, ids binary")
