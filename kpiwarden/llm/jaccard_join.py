"""Documents whose sets of word shingles are similar, by PartEnum signatures.

Two sets of sizes a and b with Jaccard similarity of at least s differ in at most
k = floor((a + b) (1 - s) / (1 + s)) features. Sizes are grouped into overlapping bands,
so that any two sizes that can reach s share a band. In a band, the feature domain is cut
into m > k partitions; of those, at most k can differ between two similar sets, so

* some two partitions are equal in both, if there are k + 2 or more: small bands show
  subsets of two;
* in larger bands a subset is a single partition.

A set need not show all m partitions. They are ordered by how many of its features they
hold, which is the same order for those that are equal in both sets. Before the first
equal one there are at most k others, before the second one more: so the first k + 1 are
enough for single partitions, and the subsets of the first k + 2 for pairs. Showing the
fullest first makes signatures selective; with more than k + 2 partitions, a small set
hardly ever shows two that are empty.

A signature is a hash of band, subset and the features in it. Sets that share none are
not similar, so nothing is lost. Sets that share one are candidates.

How candidates become links without going through all pairs of a group:

1. Equal sets are one node, whatever the number of documents.
2. The nodes of a signature are compared with the least and the greatest of them. What links
   is joined to components.
3. Signatures whose nodes lie in several components are taken up again, in blocks of
   bounded size: pairs of different components that are not ruled out by size and by
   the parities of their features (a lower bound of how many features differ).
4. Pairs are verified exactly on the words of both documents.

Only links between nodes of one component are left unexamined, and those change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiwarden.llm.components import components
from kpiwarden.llm.words import columns, mix, prepare, runs, slices, whole, windows, words
from kpiwarden.sources.scratch import stored

GROWTH = 4  # ratio of the sizes at either end of a band
SPREAD = 0.31  # partitions per feature of the largest set of a band
BLOCK = 1024  # nodes of a signature that are compared in one go
AT_ONCE = 200_000  # candidate pairs that are made distinct before they leave a task
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: list[bytes | None], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; ASCII letters are lower-cased."""
    w = words([(t or b"").lower() for t in texts])
    hashes, at = windows(w, size)
    edge = np.searchsorted(at, w.first)
    counts = w.counts()
    out = []
    for d in range(len(texts)):
        if counts[d] >= size:
            s = np.sort(hashes[edge[d] : edge[d + 1]])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif counts[d]:
            out.append(np.asarray([whole(w, d)]))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def set_hash(features: np.ndarray) -> int:
    total = np.sum(mix(features ^ _ODD), dtype=np.uint64, keepdims=True)
    return int(mix(total + np.asarray([len(features)], np.uint64) * _ODD).view(np.int64)[0])


def parities(features: np.ndarray) -> np.ndarray:
    """Eight to sixteen bits per feature: the parity of how many features fall on each.

    The number of words is a power of two; wider vectors fold onto narrower ones by
    exclusive or.
    """
    wide = 1 << max(0, int(len(features) - 1).bit_length() - 3)
    at = (features % np.uint64(64 * wide)).astype(np.int64)
    odd = np.bincount(at, minlength=64 * wide) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def fold(bits: np.ndarray, wide: int) -> np.ndarray:
    """The same parities over fewer words."""
    return np.bitwise_xor.reduce(bits.reshape(*bits.shape[:-1], -1, wide), axis=-2)


class Bands:
    """Size bands and signatures for a similarity (a fraction of whole numbers)."""

    def __init__(self, similarity: Fraction):
        self.s = similarity
        self.slack = (1 - similarity) / (1 + similarity)

    @lru_cache(maxsize=65536)  # noqa: B019
    def of(self, size: int) -> list[tuple[int, int, int, int]]:
        """(band, k for this size, partitions, partitions in a subset) of each band with this size."""
        edge, number, out = GROWTH, 0, []
        while True:
            low = edge // GROWTH + 1 if number else 1
            if low <= size <= edge:
                out.append(self._band(2 * number, size, edge))
            if self._least(edge + 1) <= size <= self._most(edge):
                out.append(self._band(2 * number + 1, size, self._most(edge)))
            if edge >= self._most(size):
                return out
            edge, number = edge * GROWTH, number + 1

    def _least(self, size: int) -> int:
        return -(-size * self.s.numerator // self.s.denominator)

    def _most(self, size: int) -> int:
        return size * self.s.denominator // self.s.numerator

    def _differ(self, a: int, b: int) -> int:
        return int((a + b) * self.slack)

    def _band(self, band: int, size: int, largest: int) -> tuple[int, int, int, int]:
        most = self._differ(largest, largest)
        k = self._differ(size, min(largest, self._most(size)))
        if most == 0:
            return band, 0, 1, 1
        if most <= 3:
            return band, k, 4 * most + 5, 2
        return band, k, max(most + 1, round(SPREAD * largest)), 1

    def signatures(self, features: np.ndarray) -> np.ndarray:
        """Sorted distinct features to signature hashes."""
        out = []
        spread = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(features ^ _ODD), dtype=np.uint64)))
        for band, k, m, together in self.of(len(features)):
            part = ((features >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
            held = np.bincount(part.astype(np.int64), minlength=m)
            edge = np.concatenate(([0], np.cumsum(held)))
            content = mix(spread[edge[1:]] - spread[edge[:-1]])
            mark = mix(np.asarray([band + 1], np.uint64))
            if together == 1:
                first = np.argsort(-held, kind="stable")[: k + 1]
                out.append(mix(content[first] + first.astype(np.uint64) * _ODD + mark))
            else:
                first = np.sort(np.argsort(-held, kind="stable")[: k + 2])
                p, q = np.asarray(list(combinations(first, together)), np.uint64).T
                pair = mix(content[p] + p * _ODD) + mix(content[q] + q * _ODD) * np.uint64(3)
                out.append(mix(pair + mark))
        return np.concatenate(out)


def _nodes(size: int):
    """Each document with the hashes of its text and of its set and the number of its shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "text"):
            sets = shingle_sets(texts, size)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("mark"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_hash(s) if len(s) else None for s in sets], pa.int64()),
                ],
                ["doc_id", "mark", "n", "node"],
            )

    return run


def _signatures(size: int, bands: Bands):
    """(signature, node), equal sets of a slice once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches, "text"):
            once = {set_hash(s): s for s in shingle_sets(texts, size) if len(s)}
            if once:
                found = [bands.signatures(s) for s in once.values()]
                nodes = np.repeat(np.fromiter(once, np.int64, len(once)), [len(f) for f in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found).view(np.int64)), pa.array(nodes)], ["sig", "node"]
                )

    return run


def _own(size: int):
    """Rows whose text has the node's set, with size and parities; where ids repeat, others may have been joined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "text"):
            node = part.column("node").to_pylist()
            sets = shingle_sets(texts, size)
            own = [len(s) > 0 and set_hash(s) == x for s, x in zip(sets, node)]
            rows = part.select(["node", "text"]).filter(pa.array(own, pa.bool_()))
            mine = [s for s, x in zip(sets, own) if x]
            rows = rows.append_column("n", pa.array([len(s) for s in mine], pa.int64()))
            yield rows.append_column("bits", pa.array([parities(s).tobytes() for s in mine], pa.binary()))

    return run


def _verify(size: int, similarity: Fraction):
    """Pairs whose texts reach the similarity."""
    num, den = similarity.numerator, similarity.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            ta = batch.column("text_a").cast(pa.large_binary())
            tb = batch.column("text_b").cast(pa.large_binary())
            kept = []
            for i in range(len(a)):
                if last[0] != a[i]:
                    last = (a[i], shingle_sets([ta[i].as_py()], size)[0])
                x, y = last[1], shingle_sets([tb[i].as_py()], size)[0]
                both = np.concatenate((x, y))
                both.sort()
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                kept.append(common * den >= num * (len(x) + len(y) - common))
            keep = np.asarray(kept, bool)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.asarray(a, np.int64)[keep]), pa.array(np.asarray(b, np.int64)[keep])], ["a", "b"]
            )

    return run


def _cross(similarity: Fraction):
    """Of sorted runs of one (signature, block pair): pairs of different components worth verifying.

    ``left`` and ``right`` tell which side of the block pair a row is on.
    """
    slack = (1 - similarity) / (1 + similarity)
    num, den = slack.numerator, slack.denominator

    def pairs(rows) -> tuple[np.ndarray, np.ndarray]:
        node, root, n, left, right, bits = rows
        wide = min(len(x) for x in bits) // 8
        parity = np.stack([fold(np.frombuffer(x, np.uint64), wide) for x in bits])
        li, ri = np.flatnonzero(left), np.flatnonzero(right)
        out_a, out_b = [], []
        for i in li:
            j = ri[(root[ri] != root[i]) & (node[ri] > node[i]) | (root[ri] != root[i]) & ~left[ri]]
            if not len(j):
                continue
            least = np.minimum(n[i], n[j]) * similarity.denominator
            j = j[least >= similarity.numerator * np.maximum(n[i], n[j])]
            apart = np.bitwise_count(parity[i] ^ parity[j]).sum(1)
            j = j[apart * den <= num * (n[i] + n[j])]
            out_a.append(np.full(len(j), node[i]))
            out_b.append(node[j])
        return (np.concatenate(x) if x else np.empty(0, np.int64) for x in (out_a, out_b))

    def once(found: list[np.ndarray]) -> pa.RecordBatch:
        a, b = np.unique(np.concatenate(found), axis=0).T
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] = []
        for rows in runs(batches, ["sig", "i", "j"], ["node", "root", "n", "left", "right", "bits"]):
            a, b = pairs(rows)
            found.append(np.stack([np.minimum(a, b), np.maximum(a, b)], 1))
            if sum(map(len, found)) >= AT_ONCE:
                yield once(found)
                found = []
        if found:
            yield once(found)

    return run


def similar_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    similarity: Fraction = Fraction(4, 5),
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    ``component_id`` is the least id reachable through links of at least ``similarity``,
    the document's own included. A text with fewer words than a shingle has one feature,
    the whole of it. Null, empty and blank texts have no features and link with nothing,
    each other included. Rows that repeat an id are returned each, all with the component
    of their own text. A null id is kept and never becomes a component's id unless no
    other is there.
    """
    rows, labelled = _labelled(columns(docs, doc_id=id_col, text=text_col), shingle, similarity)
    first = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    first = first.select(F.col("root").alias("of"), "component_id")
    named = labelled.join(first, labelled["root"] == first["of"]).select(
        F.col("node").alias("set"), "component_id"
    )
    out = rows.select("doc_id", "n", "node").join(named, F.col("node") == F.col("set"), "left")
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def one_of_each(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    similarity: Fraction = Fraction(4, 5),
) -> DataFrame:
    """Rows of ``docs``: one of each component of ``similar_documents``, and all texts without features.

    It is the row with the least id; a null id comes after all others, and of texts with
    the same id that of the least hash is taken. Of rows with equal id and text one is left.
    """
    rows, labelled = _labelled(columns(docs, doc_id=id_col, text=text_col), shingle, similarity)
    roots = labelled.select(F.col("node").alias("set"), "root")
    linked = rows.join(roots, rows["node"] == roots["set"])
    row = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("mark").alias("mark"))
    chosen = linked.groupBy("root").agg(F.min(row).alias("row")).select("row.id", "row.mark")
    chosen = chosen.union(rows.where("node is null").select("doc_id", "mark")).distinct()
    same = docs[id_col].eqNullSafe(chosen["id"]) & (F.xxhash64(docs[text_col]) == chosen["mark"])
    return docs.join(chosen, same, "left_semi").dropDuplicates([id_col, text_col])


def _labelled(source: DataFrame, shingle: int, similarity: Fraction) -> tuple[DataFrame, DataFrame]:
    """``doc_id, mark, n, node`` of every row and ``node, least, root`` of every node."""
    prepare(source.sparkSession)
    bands = Bands(similarity)
    rows = source.withColumn("mark", F.xxhash64("text"))
    rows = stored(rows.mapInArrow(_nodes(shingle), "doc_id long, mark long, n long, node long"), "sets")
    # of the rows with a node's set, one stands for it: its text is named by id and hash
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark"))
    nodes = rows.where("node is not null").groupBy("node").agg(first.alias("first"))
    nodes = stored(nodes.select("node", F.col("first.doc_id").alias("least"), "first.mark"), "nodes")
    edges = _links(source, nodes, shingle, similarity, bands)
    roots = components(edges).select(F.col("node").alias("member"), "root")
    # nodes without a link are their own component
    labelled = nodes.select("node", "least").join(roots, nodes["node"] == roots["member"], "left")
    return rows, stored(labelled.select("node", "least", F.coalesce("root", "node").alias("root")), "labels")


def _links(source: DataFrame, nodes: DataFrame, shingle: int, similarity: Fraction, bands: Bands) -> DataFrame:
    signatures = source.mapInArrow(_signatures(shingle, bands), "sig long, node long")
    hubs = signatures.groupBy("sig").agg(F.min("node").alias("hub"), F.max("node").alias("other"))
    hubs = hubs.where("hub != other").withColumnRenamed("sig", "of")
    # a set that stands in several slices shows its signatures in each
    shared = signatures.join(hubs, signatures["sig"] == hubs["of"]).select("sig", "node", "hub", "other").distinct()
    shared = stored(shared, "shared")
    texts = _texts(source, nodes, shared, shingle)
    tested = stored(_pairs(shared, "hub").union(_pairs(shared, "other")).distinct(), "hubs")
    edges = stored(_verified(tested, texts, shingle, similarity), "edges")
    crossing = _crossing(_apart(shared, edges), texts, similarity).join(tested, ["a", "b"], "left_anti")
    return edges.union(_verified(stored(crossing, "crossing"), texts, shingle, similarity))


def _pairs(rows: DataFrame, hub: str) -> DataFrame:
    ends = F.least("node", hub).alias("a"), F.greatest("node", hub).alias("b")
    return rows.where(F.col("node") != F.col(hub)).select(*ends)


def _apart(shared: DataFrame, edges: DataFrame) -> DataFrame:
    """``sig, node, root``: signatures whose nodes, hubs aside, lie in several components.

    Pairs with the signature's hubs have been verified.
    """
    shared = shared.where("node != hub and node != other").select("sig", "node")
    roots = components(edges).select(F.col("node").alias("member"), "root")
    rows = shared.join(roots, shared["node"] == roots["member"], "left")
    rows = stored(rows.select("sig", "node", F.coalesce("root", "node").alias("root")), "apart")
    several = rows.groupBy("sig").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high")
    return rows.join(several.select(F.col("sig").alias("of")), F.col("sig") == F.col("of"), "left_semi")


def _texts(source: DataFrame, nodes: DataFrame, shared: DataFrame, shingle: int) -> DataFrame:
    """One text of each node that shares a signature, with the size of its set and its parities."""
    wanted = shared.select("node").distinct()
    some = nodes.join(wanted, "node").select("node", F.col("least").alias("id"), F.col("mark").alias("its"))
    same = source["doc_id"].eqNullSafe(some["id"]) & (F.xxhash64(source["text"]) == some["its"])
    texts = source.join(some, same).select("id", "node", "text").distinct()
    return stored(texts.mapInArrow(_own(shingle), "node long, text string, n long, bits binary"), "texts")


def _verified(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: Fraction) -> DataFrame:
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_verify(shingle, similarity), "a long, b long")


def _crossing(rows: DataFrame, texts: DataFrame, similarity: Fraction) -> DataFrame:
    """Pairs of a signature that lie in different components and may be similar."""
    held = rows.groupBy("sig").agg(F.bit_xor(F.xxhash64("node")).alias("held")).withColumnRenamed("sig", "of")
    # signatures of the same nodes are one; should two others fall together, only more pairs are looked at
    rows = rows.join(held, rows["sig"] == held["of"]).select(F.col("held").alias("sig"), "node", "root")
    rows = stored(rows.distinct(), "held")
    # blocks are those of all that fell together, so that each stays within its bound
    sizes = rows.groupBy("sig").agg(F.count(F.lit(1)).alias("size")).withColumnRenamed("sig", "of")
    rows = rows.join(sizes, rows["sig"] == sizes["of"]).drop("of")
    about = texts.select(F.col("node").alias("id"), "n", "bits")
    rows = rows.join(about, rows["node"] == about["id"])
    block = F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / BLOCK)).cast("int")
    every = F.sequence(F.lit(0), (F.ceil(F.col("size") / BLOCK) - 1).cast("int"))
    rows = rows.withColumn("block", block).withColumn("with", F.explode(every))
    rows = rows.select(
        "sig",
        F.least("block", "with").alias("i"),
        F.greatest("block", "with").alias("j"),
        "node",
        "root",
        "n",
        (F.col("block") <= F.col("with")).alias("left"),
        (F.col("block") >= F.col("with")).alias("right"),
        "bits",
    )
    rows = rows.repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j")
    rows = rows.mapInArrow(_cross(similarity), "a long, b long")
    return rows.distinct()
