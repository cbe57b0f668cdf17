"""Embeddings as whole-number vectors, for operators whose arithmetic must be exact."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Components stop here on either side, so that a squared distance fits 64 bits up to 2 ** 12 components.
MOST = 1 << 24


def usable(embeddings: DataFrame) -> DataFrame:
    """The rows whose vector is there and holds neither null nor non-finite components."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return embeddings.where(F.col("embedding").isNotNull()).where(sound)


def whole(embeddings: DataFrame, scale: int, width: int, *carried: str) -> DataFrame:
    """The carried columns and ``values``, floor(scale * component), of vectors of the given width.

    Components beyond +-MOST count as +-MOST. Other columns are left behind.
    """
    number = F.transform(
        "embedding",
        lambda x: F.greatest(F.least(F.floor(x.cast("double") * F.lit(float(scale))), F.lit(MOST)), F.lit(-MOST)).cast("int"),
    )
    return usable(embeddings).where(F.size("embedding") == width).select(*carried, number.alias("values"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A column of equally long lists as rows of an int64 matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


class GroupSums:
    """Exact component sums and counts of vectors by group number, added up batch by batch."""

    def __init__(self, groups: int, width: int) -> None:
        self.count = np.zeros(groups, np.int64)
        self.total = np.zeros((groups, width), np.int64)

    def add(self, group: np.ndarray, values: np.ndarray) -> None:
        groups = len(self.count)
        self.count += np.bincount(group, minlength=groups)
        for d in range(values.shape[1]):  # whole numbers far below 2 ** 53: exact as doubles
            self.total[:, d] += np.bincount(group, values[:, d], groups).astype(np.int64)

    def rows(self, **fixed: int) -> pa.RecordBatch:
        """One row per group that has vectors: the fixed columns, ``g``, ``n`` and the sums ``s0``, ``s1``, ..."""
        used = np.flatnonzero(self.count)
        columns = {k: np.full(len(used), v, np.int64) for k, v in fixed.items()}
        columns |= {"g": used, "n": self.count[used]}
        columns |= {f"s{d}": self.total[used, d] for d in range(self.total.shape[1])}
        return pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in columns.items()})


def summed(partial: DataFrame, keys: list[str], width: int) -> Iterator[tuple]:
    """Rows (*keys, n, sums): the partial sums of all tasks added up; as many rows as there are groups."""
    sums = [F.sum(f"s{d}").alias(f"s{d}") for d in range(width)]
    for row in partial.groupBy(*keys).agg(F.sum("n").alias("n"), *sums).collect():
        yield (*[row[k] for k in keys], row["n"], [row[f"s{d}"] for d in range(width)])
