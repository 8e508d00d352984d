"""Dimension lookups with a checked broadcast.

A dimension is broadcast only when its row count - recorded when the dimension
was written - is at most ``max_broadcast_rows`` and its rows, by the types of the
columns that are taken, stay within ``MAX_BROADCAST_BYTES``; otherwise the join is left to
the planner (shuffle join, which AQE may still turn into a broadcast at run time
from measured sizes). Nothing is broadcast on a guess.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup broadcasts only the join key(s) plus the surrogate key / a few
# attributes (~50-100 bytes a row), so 1M rows stays around 100 MB per executor.
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 256 << 20
#: Bytes of a value in a hashed row, about; strings with their length word.
_WIDTH = {"string": 72, "decimal": 16}


def row_bytes(df: DataFrame) -> int:
    return 32 + sum(_WIDTH.get(f.dataType.typeName(), 8) for f in df.schema.fields)


def checked_broadcast(dim: DataFrame, n_rows: int | None,
                      max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    if n_rows is not None and n_rows <= max_rows and n_rows * row_bytes(dim) <= MAX_BROADCAST_BYTES:
        return F.broadcast(dim)
    return dim


def lookup(fact: DataFrame, dim: DataFrame, pairs: Sequence[tuple[str, str]], take: dict[str, str],
           how: str = "left", n_rows: int | None = None,
           max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Join ``fact`` to ``dim`` on ``fact_col == dim_col`` pairs and add ``take``
    (dim column -> output name). NULL fact keys never match (plain equality)."""
    tag = "__d_" + "_".join([*(fc for fc, _ in pairs), *take.values()])
    d = dim.select(*[F.col(dc).alias(f"{tag}_{dc}") for _, dc in pairs],
                   *[F.col(src).alias(out) for src, out in take.items()])
    d = checked_broadcast(d, n_rows, max_rows)
    cond = None
    for fc, dc in pairs:
        c = fact[fc] == d[f"{tag}_{dc}"]
        cond = c if cond is None else cond & c
    joined = fact.join(d, cond, how)
    return joined.drop(*[f"{tag}_{dc}" for _, dc in pairs])


def left_join_known(rows: DataFrame, other: DataFrame, on: Sequence[str], maybe: str) -> DataFrame:
    """Left join in which rows whose ``maybe`` key is NULL, and so match nothing, stay
    where they are: as one hot key they would all be shuffled to one task."""
    met = rows.where(F.col(maybe).isNotNull()).join(other, list(on), "left")
    rest = rows.where(F.col(maybe).isNull())
    new = [f for f in other.schema.fields if f.name not in on]
    rest = rest.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in new])
    return met.unionByName(rest)
