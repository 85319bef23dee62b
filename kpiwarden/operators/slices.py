"""Work on some of the series at a time, so that the shuffles of all are never on disk at once."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiwarden.sources.scratch import stored

#: Bytes of files from which a further slice is made, and the most slices: each reads the files again.
SLICE_BYTES = 32 << 20
MOST_SLICES = 4

Slice = Callable[[DataFrame], DataFrame]


def slices(read: DataFrame, by: Sequence[str]) -> list[Slice]:
    """Filters, each of which takes from any DataFrame with the columns ``by`` the rows of some series.

    Every row passes one of them, null keys included, and rows of a series pass the same
    one. Their number follows from the size of the files behind ``read``. Where Spark does not
    know it there is one, which passes everything.
    """
    n = min(MOST_SLICES, 1 + _bytes_read(read) // SLICE_BYTES)
    if n == 1:
        return [lambda df: df]
    return [partial(_of_slice, by=tuple(by), n=n, k=k) for k in range(n)]


def in_slices(
    read: DataFrame, by: Sequence[str], make: Callable[[Slice], DataFrame], purpose: str
) -> DataFrame:
    """What ``make`` gives, computed for one slice after the other.

    ``make`` is called with a filter that it has to apply to all it reads, and must not let
    one series depend on another. Each slice is written to the scratch folder, after which
    Spark removes its shuffles. With a single slice nothing is written or run here.
    """
    filters = slices(read, by)
    if len(filters) == 1:
        return make(filters[0])
    return reduce(DataFrame.unionByName, [stored(make(of), purpose) for of in filters])


def _of_slice(df: DataFrame, by: tuple[str, ...], n: int, k: int) -> DataFrame:
    return df.where(F.pmod(F.xxhash64(*by), F.lit(n)) == k)


def _bytes_read(df: DataFrame) -> int:
    """Bytes of the files that the plan reads; what Spark does not know the size of counts as nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    found = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return sum(size for size in found if size < 1 << 62)
