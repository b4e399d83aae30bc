"""What the operators on vectors share: which rows take part, and their components as arrays."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Profile(NamedTuple):
    """Length of the vectors that take part, how many they are, and the largest magnitude of a component."""

    width: int
    n: int
    most: float


def usable(vectors: DataFrame, vec_col: str, *columns: Column) -> DataFrame:
    """`columns` and v, the vector as doubles, of the rows whose vector is neither null nor empty and has only finite
    components."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select(*columns, F.col(vec_col).cast("array<double>").alias("v")).where((F.size("v") > 0) & finite)


def profile(rows: DataFrame) -> Profile | None:
    """Of the most frequent length among `usable` rows, of equally frequent ones the longest; None without rows."""
    magnitude = F.array_max(F.transform("v", F.abs))
    sizes = rows.groupBy(F.size("v").alias("width")).agg(F.count("*").alias("n"), F.max(magnitude).alias("most"))
    best = sizes.orderBy(F.desc("n"), F.desc("width")).limit(1).collect()
    return Profile(best[0]["width"], best[0]["n"], best[0]["most"]) if best else None


def components(column: pa.Array, width: int) -> np.ndarray:
    """A column of lists of one length as a matrix of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(-1, width)


def whole(x: np.ndarray, scale: int, limit: int) -> np.ndarray:
    """floor(scale * x) as longs, held within `limit` to either side."""
    with np.errstate(over="ignore"):  # what exceeds a double exceeds the limit
        return np.clip(np.floor(x * float(scale)), -float(limit), float(limit)).astype(np.int64)
