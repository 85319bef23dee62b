"""Centroid clustering (Lloyd's rounds) by equal-average equal-variance search, in whole numbers.

Every component x becomes floor(scale * x). A vector finds its nearest centroid without
comparing it with all of them: centroids are sorted by their mean, and the search goes
outward from the vector's own mean, on both sides. With S the sum of components, V the
length of the vector less its mean, and d the number of components,

* mean:      distance >= (S_x - S_c)^2 / d, which only grows further out, so a side ends
             at the first centroid for which this exceeds the least distance so far;
* deviation: distance >= (S_x - S_c)^2 / d + (V_x - V_c)^2, which rules out one centroid.

The mean test is in whole numbers. The deviation test is in doubles, with room for
rounding, and only ever rules out. What is left is measured exactly in whole numbers, so
ties and sums are exact.

A round is one pass: each task sums its vectors by cluster and component, Spark adds up
the tasks' sums, and ``k * (d + 1)`` numbers come back. No task gathers a cluster, so one
with a third of all vectors is like any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiwarden.llm.words import columns, prepare
from kpiwarden.sources.scratch import stored

WIDTH = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SEED = 3
ROWS = 8192  # vectors that are looked at in one go
ROUNDING = 1e-9  # share of a deviation that its rounding cannot reach


def largest(width: int) -> int:
    """Components up to this keep squared distances, times the width, within 64 bits."""
    return (1 << 30) // width


def _whole_numbers(width: int, scale: int):
    """Kept vectors as packed whole numbers; null where one is too large for the sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = batch.column("vec_id"), batch.column("vec")
            fits = pc.equal(pc.list_value_length(vectors), width)  # null, which filters out, for a null vector
            ids, vectors = ids.filter(fits), vectors.filter(fits)
            flat = vectors.flatten().cast(pa.float64())
            x = flat.to_numpy(zero_copy_only=False).reshape(-1, width)
            missing = flat.is_null().to_numpy(zero_copy_only=False).reshape(-1, width)
            good = np.isfinite(x).all(1) & ~missing.any(1)
            with np.errstate(over="ignore"):
                whole = np.floor(x[good] * scale)
            small = (np.abs(whole) <= largest(width)).all(1)
            whole = np.where(small[:, None], whole, 0).astype(np.int32)
            packed = [row.tobytes() if s else None for row, s in zip(whole, small)]
            yield pa.RecordBatch.from_arrays(
                [ids.filter(pa.array(good)), pa.array(packed, pa.binary())], ["vec_id", "packed"]
            )

    return run


def _unpacked(packed: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed.to_pylist()), np.int32).reshape(-1, width).astype(np.int64)


class Centroids:
    """Centroids in the order of their means, with what the two inequalities need."""

    def __init__(self, centroids: np.ndarray):
        self.sums = centroids.sum(1)
        self.number = np.argsort(self.sums, kind="stable")
        self.sums = self.sums[self.number]
        self.at = centroids[self.number]
        self.width = centroids.shape[1]
        self.off = _off_mean(self.at, self.sums)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of each row's nearest centroid; of equal ones the smaller number."""
        sums = x.sum(1)
        off = _off_mean(x, sums)
        begin = np.searchsorted(self.sums, sums)
        number = np.full(len(x), len(self.at), np.int64)
        best = np.full(len(x), np.iinfo(np.int64).max // self.width)
        for side, first in ((1, begin), (-1, begin - 1)):
            # the side above goes first; what it finds already narrows the side below
            rows, step = np.arange(len(x)), 0
            while len(rows):
                c = first[rows] + side * step
                inside = (c >= 0) & (c < len(self.at))
                rows, c = rows[inside], c[inside]
                apart = sums[rows] - self.sums[c]
                near = apart * apart <= best[rows] * self.width
                rows, c, apart = rows[near], c[near], apart[near]
                self._measure(x, rows, c, self._possible(apart, off[rows], c, best[rows]), number, best)
                step += 1
        return number, best

    def _possible(self, apart: np.ndarray, off: np.ndarray, c: np.ndarray, best: np.ndarray) -> np.ndarray:
        gap = np.abs(off - self.off[c]) - ROUNDING * (off + self.off[c])
        least = apart.astype(float) ** 2 / self.width + np.maximum(gap, 0) ** 2
        return least * (1 - ROUNDING) <= best

    def _measure(self, x, rows, c, possible, number, best) -> None:
        rows, c = rows[possible], c[possible]
        distance = ((x[rows] - self.at[c]) ** 2).sum(1)
        own = self.number[c]
        better = (distance < best[rows]) | (distance == best[rows]) & (own < number[rows])
        number[rows[better]], best[rows[better]] = own[better], distance[better]


def _off_mean(x: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Length of each row less its mean."""
    return np.sqrt(((x - sums[:, None] / x.shape[1]) ** 2).sum(1))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            yield batch.slice(lo, ROWS)


def _summed(centroids: np.ndarray):
    """``cluster, part, total``: sums by component of a task's vectors; their number as part -1."""
    k, width = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Centroids(centroids)
        total = np.zeros((k, width + 1), np.int64)
        for batch in _pieces(batches):
            x = _unpacked(batch.column("packed"), width)
            number, _ = search.nearest(x)
            order = np.argsort(number, kind="stable")
            held, first = np.unique(number[order], return_index=True)
            if len(held):
                total[held, :width] += np.add.reduceat(x[order], first)
                total[held, width] += np.diff(np.append(first, len(number)))
        some = np.flatnonzero(total[:, width])
        part = np.append(np.arange(width), -1)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(some, width + 1).astype(np.int32)),
                pa.array(np.tile(part, len(some)).astype(np.int32)),
                pa.array(total[some].ravel()),
            ],
            ["cluster", "part", "total"],
        )

    return run


def _assigned(centroids: np.ndarray):
    width = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Centroids(centroids)
        for batch in _pieces(batches):
            packed = batch.column("packed")
            there = packed.is_valid().to_numpy(zero_copy_only=False)
            number = np.zeros(len(packed), np.int32)
            distance = np.zeros(len(packed), np.int64)
            number[there], distance[there] = search.nearest(_unpacked(packed.drop_null(), width))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(number, mask=~there), pa.array(distance, mask=~there)],
                ["vec_id", "cluster", "distance"],
            )

    return run


def _first_centroids(rows: DataFrame, k: int, width: int, seed: int) -> np.ndarray:
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = rows.orderBy(hashed.asc_nulls_last(), "packed").limit(k).select("packed").collect()
    return np.frombuffer(b"".join(r["packed"] for r in first), np.int32).reshape(-1, width).astype(np.int64)


def _moved(centroids: np.ndarray, rows: DataFrame) -> np.ndarray:
    """Centroids as the floored means of their vectors; without vectors they stay."""
    width = centroids.shape[1]
    sums = rows.select("packed").mapInArrow(_summed(centroids), "cluster int, part int, total long")
    total = {(r["cluster"], r["part"]): r["total"] for r in sums.groupBy("cluster", "part").agg(F.sum("total").alias("total")).collect()}
    moved = centroids.copy()
    for c in range(len(centroids)):
        if n := total.get((c, -1)):
            moved[c] = [total[c, j] // n for j in range(width)]
    return moved


@lru_cache(maxsize=1024)
def _mark(centroid: tuple[int, ...]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def clustered_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    width: int = WIDTH,
    scale: int = SCALE,
    seed: int = SEED,
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every kept vector.

    Kept are vectors of exactly ``width`` components, none of them null or not finite;
    others do not come back. The first centroids are the ``k`` vectors with the least
    hash of seed and id, fewer if there are fewer; rows that repeat an id are ordered by
    their components, and rows without an id come last. Equal centroids may occur; the
    smaller number takes the vectors. Repeated rows count each. A vector with a component
    beyond ``largest(width)`` in whole numbers, whose distances would not fit a long,
    takes no part and comes back with nulls. A sum of distances that does not fit is null.

    The rounds run when this is called. ``k * width`` numbers are sent to every task and
    back to the driver; nothing else is.
    """
    prepare(vectors.sparkSession)
    rows = columns(vectors, vec_id=id_col, vec=vec_col).mapInArrow(
        _whole_numbers(width, scale), "vec_id long, packed binary"
    )
    rows = stored(rows, "vectors")
    some = rows.where("packed is not null")
    centroids = _first_centroids(some, k, width, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = _moved(centroids, some)
    kind = "vec_id long, cluster int, distance long"
    if len(centroids):
        rows = stored(rows.mapInArrow(_assigned(centroids), kind), "clusters")
    else:
        rows = rows.select("vec_id", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance"))
    sums = rows.where("cluster is not null").groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum"))
    sums = [(r["cluster"], int(r["sum"])) for r in sums.collect()]
    whole = _as_long(sum(x for _, x in sums))
    about = [(c, _as_long(x), whole, _mark(tuple(centroids[c].tolist()))) for c, x in sums]
    about = rows.sparkSession.createDataFrame(
        about, "of int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    # no more than k rows
    out = rows.join(F.broadcast(about), rows["cluster"] == about["of"], "left")
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _as_long(x: int) -> int | None:
    return x if x < 1 << 63 else None


def oracle_sql(k: int = CLUSTERS, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE, seed: int = SEED) -> str:
    """SQL for ``clustered_vectors`` over ``embeddings``: every round compares all vectors with all centroids."""
    def nearest(c: str) -> str:
        return f"""
    select id, arg_min(c, (d, c)) as c, min(d) as d
    from (
      select v.id, m.c, list_sum(list_transform(list_zip(v.x, m.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as d
      from vectors v cross join {c} m
    )
    group by id"""

    parts = [f"""kept as (
    select vec_id, list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) as x
    from embeddings
    where len(embedding) = {width}
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
  )""", f"""vectors as materialized (
    select row_number() over (order by sha256('{seed}:' || vec_id::varchar) nulls last, x) as id, vec_id, x from kept
  )""", f"m0 as materialized (select id - 1 as c, x from vectors where id <= {k})"]
    for n in range(1, rounds + 1):
        parts.append(f"a{n} as materialized ({nearest(f'm{n - 1}')})")
        parts.append(f"""m{n} as materialized (
    select m.c, coalesce(s.x, m.x) as x
    from m{n - 1} m left join (
      select c, list((total - (total % n + n) % n) // n order by j)::bigint[] as x
      from (
        select a.c, j, sum(v.x[j])::hugeint as total, count(*)::hugeint as n
        from a{n} a join vectors v using (id), range(1, {width + 1}) r(j)
        group by a.c, j
      )
      group by c
    ) s on m.c = s.c
  )""")
    parts.append(f"final as materialized ({nearest(f'm{rounds}')})")
    return "with " + ",\n  ".join(parts) + """
select v.vec_id, f.c::int as cluster, f.d as distance,
  sum(f.d) over (partition by f.c)::bigint as cluster_inertia,
  sum(f.d) over ()::bigint as inertia,
  sha256(list_aggregate(m.x, 'string_agg', ',')) as centroid_sha256
from final f join vectors v using (id) join m""" + f"{rounds} m on m.c = f.c"
