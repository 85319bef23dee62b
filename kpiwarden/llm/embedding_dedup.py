"""Near-duplicate embeddings by sorted projection passes.

A pass hashes every vector to a string of bits, the signs of random projections, sorts
by it, and compares each vector with a bounded number of neighbours in that order. Near
vectors share long prefixes, so some pass brings them close. Pairs are verified by cosine
in double precision and joined over all passes. Passes come in rounds with projections of
their own, and there are rounds until one joins nothing that was apart: vectors that lie
densely, or are very many, take more of them. A pass moves each vector once, so work and
shuffle grow with the vectors and not with their square.

A window may miss a pair in every pass, so the result is not exact by construction; the
recall is measured. Then the links within each component are counted by comparing its
members in blocks of bounded size. With ``exact``, all vectors are compared like that,
which is quadratic.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiwarden.llm.components import components
from kpiwarden.llm.words import columns, prepare, runs
from kpiwarden.sources.scratch import stored

BLOCK_BYTES = 16 << 20  # of the vectors of a block, at most
BLOCKS = 8  # at least, where blocks have no fewer than LEAST vectors by it
LEAST = 256
STRIP = 1 << 22  # pairs compared in one go
COSINE = 0.9
PASSES = 16  # in a round
WINDOW = 128  # earlier neighbours a vector is compared with
BITS = 63
SEED = 9


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``vec_id, vec``: components as 64-bit numbers of length one in all; null where there is no direction."""
    for batch in batches:
        out = []
        for v in batch.column("vec").to_pylist():
            unit = None
            if v and None not in v:
                x = np.asarray(v, float)
                top = np.abs(x).max()
                if np.isfinite(top) and top > 0:
                    x = x / top
                    unit = (x / np.sqrt(x @ x)).tobytes()
            out.append(unit)
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(out, pa.binary())], ["vec_id", "vec"])


def _matrix(vectors: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(vectors)).reshape(len(vectors), -1)


class _Forest:
    """Joins of nodes numbered from 0; ``label`` tells which are together."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.a, self.b = [], []  # the joins

    def join(self, near: np.ndarray, at: np.ndarray, to: np.ndarray) -> None:
        """Join ``at[i]`` with ``to[j]`` wherever ``near[i, j]``."""
        rest = near & (self.label[at][:, None] != self.label[to][None])
        while rest.any():
            i = np.flatnonzero(rest.any(1))
            j = np.flatnonzero(rest.any(0))
            self._join(np.concatenate((at[i], at[rest.argmax(0)[j]])), np.concatenate((to[rest.argmax(1)[i]], to[j])))
            rest &= self.label[at][:, None] != self.label[to][None]

    def _join(self, a: np.ndarray, b: np.ndarray) -> None:
        up = np.arange(len(self.label))
        for x, y in zip(a.tolist(), b.tolist()):
            p, q = int(self.label[x]), int(self.label[y])
            while p != up[p]:
                up[p] = p = up[up[p]]
            while q != up[q]:
                up[q] = q = up[up[q]]
            if p != q:
                up[max(p, q)] = min(p, q)
                self.a.append(x)
                self.b.append(y)
        while (up[up] != up).any():
            up = up[up]
        self.label = up[self.label]


def _keyed(passes: int, number: int):
    """(width, pass, key, node, vec): every vector once for each pass of a round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        powers = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            vectors = batch.column("vec").to_pylist()
            sizes = np.asarray([len(v) for v in vectors])
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                some, rows = batch.take(pa.array(at)), _matrix([vectors[i] for i in at])
                if size not in planes:
                    planes[size] = np.random.default_rng((SEED, size, number)).normal(size=(size // 8, passes * BITS))
                signs = (rows @ planes[size] > 0).reshape(len(at), passes, BITS)
                keys = signs @ powers
                for p in range(passes):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(at), size, np.int32)),
                            pa.array(np.full(len(at), p, np.int32)),
                            pa.array(keys[:, p]),
                            some.column("node"),
                            some.column("vec"),
                        ],
                        ["width", "pass", "key", "node", "vec"],
                    )

    return run


def _neighbours(window: int, cosine: float):
    """Verified pairs of sorted rows, as few as join the same vectors; windows do not cross widths and passes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held_node, held = None, np.empty(0, np.int64), None
        for batch in batches:
            for lo in range(0, batch.num_rows, 4 * window):
                part = batch.slice(lo, 4 * window)
                width, number = part.column("width").to_numpy(), part.column("pass").to_numpy()
                node, vectors = part.column("node").to_numpy(), part.column("vec").to_pylist()
                cuts = np.flatnonzero((width[1:] != width[:-1]) | (number[1:] != number[:-1])) + 1
                for i, j in zip([0, *cuts], [*cuts, len(node)]):
                    key, rows, nodes = (width[i], number[i]), _matrix(vectors[i:j]), node[i:j]
                    if held_key == key:
                        rows, nodes = np.concatenate((held, rows)), np.concatenate((held_node, nodes))
                    near = np.tril(rows @ rows.T >= cosine, -1)
                    near &= ~np.tri(len(nodes), k=-window - 1, dtype=bool)
                    held_key, held, held_node = key, rows[-window:], nodes[-window:]
                    if near.any():
                        forest = _Forest(len(nodes))
                        forest.join(near, np.arange(len(nodes)), np.arange(len(nodes)))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(nodes[forest.a]), pa.array(nodes[forest.b])], ["a", "b"]
                        )

    return run


def _compared(cosine: float):
    """``a, b, links`` of sorted runs of one block pair: links of a, where b is null, or a link of a and b."""

    def compare(rows: list) -> pa.RecordBatch:
        node, copies, left, right, vectors = rows
        x = _matrix(vectors)
        li, ri = np.flatnonzero(left), np.flatnonzero(right)
        one = len(li) == len(node)  # a block with itself
        to, links, forest = x[ri].T, np.zeros(len(node), np.int64), _Forest(len(node))
        step = max(1, STRIP // max(1, len(ri)))
        for lo in range(0, len(li), step):
            at = li[lo : lo + step]
            near = x[at] @ to >= cosine
            if one:
                near[np.arange(len(at)), at] = False
            i, j = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
            near = near[np.ix_(i, j)]
            links[at[i]] += near @ copies[ri[j]]
            if not one:
                links[ri[j]] += copies[at[i]] @ near
            forest.join(near, at[i], ri[j])
        own = np.flatnonzero(links)
        a, b = np.asarray(forest.a, np.int64), np.asarray(forest.b, np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate((node[own], node[a]))),
                pa.concat_arrays([pa.nulls(len(own), pa.int64()), pa.array(node[b], pa.int64())]),
                pa.array(np.concatenate((links[own], np.zeros(len(a), np.int64)))),
            ],
            ["a", "b", "links"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, ["whole", "i", "j"], ["node", "copies", "left", "right", "vec"]):
            yield compare(rows)

    return run


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
    cosine: float = COSINE, passes: int = PASSES, window: int = WINDOW, exact: bool = False,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    ``n_links`` counts the other rows of its component at a cosine of at least
    ``cosine``, and ``component_id`` is the least id reachable by such links as were
    found. A vector that is null, empty, zero, or has components that are null or not
    finite links with nothing; so do vectors of different lengths with each other. A row
    with a null id links with nothing, and its component is null. Rows that repeat an id
    count each. The rounds run when this is called.
    """
    prepare(vectors.sparkSession)
    rows = columns(vectors, vec_id=id_col, vec=vec_col).mapInArrow(_clean, "vec_id long, vec binary")
    rows = stored(rows, "vectors")
    some = rows.where("vec is not null and vec_id is not null")
    # equal vectors are one node
    nodes = stored(some.groupBy("vec").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")), "nodes")
    if exact:
        found = _compared_in_blocks(nodes.withColumn("whole", F.octet_length("vec").cast("long")), cosine)
        roots = components(found.where("b is not null").select("a", "b")).select(F.col("node").alias("member"), "root")
    else:
        roots = _joined_by_passes(nodes, cosine, passes, window)
        members = nodes.join(roots, nodes["node"] == roots["member"]).withColumnRenamed("root", "whole")
        found = _compared_in_blocks(members, cosine)
    links = found.where("b is null").groupBy(F.col("a").alias("of")).agg(F.sum("links").alias("links"))
    links = links.join(roots, links["of"] == roots["member"])
    about = nodes.join(links, nodes["node"] == links["of"], "left").select(
        F.col("vec").alias("same"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("root", "node").alias("component_id"),
    )
    out = rows.join(about, (rows["vec"] == about["same"]) & rows["vec_id"].isNotNull(), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def _joined_by_passes(nodes: DataFrame, cosine: float, passes: int, window: int) -> DataFrame:
    """``member, root`` of the nodes that have a link, after rounds of passes until one finds nothing new."""
    order = ["width", "pass", "key", "node"]
    joined, number = None, 0
    while True:
        keyed = nodes.select("node", "vec").mapInArrow(
            _keyed(passes, number), "width int, pass int, key long, node long, vec binary"
        )
        ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
        pairs = stored(ordered.mapInArrow(_neighbours(window, cosine), "a long, b long"), "pairs")
        pairs = pairs.distinct()
        if joined is None:
            joined = stored(_rooted(pairs), "joined")
        else:
            apart = stored(_between(pairs, joined), "apart")
            if apart.isEmpty():
                return joined
            # components and single nodes that a new pair joins become one
            moved = stored(_rooted(apart), "moved").select(F.col("member").alias("was"), F.col("root").alias("now"))
            own = joined.join(moved, joined["root"] == moved["was"], "left").select("member", F.coalesce("now", "root").alias("root"))
            single = moved.join(joined, moved["was"] == joined["member"], "left_anti").select("was", "now")
            joined = stored(own.union(single), "joined")
        number += 1


def _rooted(pairs: DataFrame) -> DataFrame:
    return components(pairs).select(F.col("node").alias("member"), "root")


def _between(pairs: DataFrame, joined: DataFrame) -> DataFrame:
    """Pairs of roots that pairs of nodes lead between; a node in no component is its own."""
    for end in ("a", "b"):
        root = joined.select(F.col("member").alias("of"), "root")
        pairs = pairs.join(root, pairs[end] == root["of"], "left").withColumn(end, F.coalesce("root", end)).select("a", "b")
    return pairs.where("a != b").distinct()


def _compared_in_blocks(members: DataFrame, cosine: float) -> DataFrame:
    """``a, b, links`` of all vectors within each ``whole``: links of a, where b is null, or a link of a and b."""
    return stored(_blocks(members).mapInArrow(_compared(cosine), "a long, b long, links long"), "compared")


def _blocks(members: DataFrame) -> DataFrame:
    """``members`` once for each pair of blocks of its whole that it is in, sorted by these."""
    sizes = members.groupBy("whole").agg(F.count(F.lit(1)).alias("size")).withColumnRenamed("whole", "wholly")
    rows = members.join(sizes, members["whole"] == sizes["wholly"])
    room = F.ceil(F.col("size") * F.octet_length("vec") / BLOCK_BYTES)
    blocks = F.greatest(room, F.least(F.lit(BLOCKS), F.ceil(F.col("size") / LEAST))).cast("int")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.select(
        "whole",
        F.least("block", "with").alias("i"),
        F.greatest("block", "with").alias("j"),
        "node",
        "copies",
        (F.col("block") <= F.col("with")).alias("left"),
        (F.col("block") >= F.col("with")).alias("right"),
        "vec",
    )
    return rows.repartition("whole", "i", "j").sortWithinPartitions("whole", "i", "j")
