"""Insert-ignore and upsert on Parquet tables (L1).

PostgreSQL's ``INSERT ... SELECT ... ON CONFLICT (key) DO NOTHING`` skips a row
when its key already exists in the target *or* was inserted earlier by the same
statement; rows with a NULL key never conflict. Parquet has no unique index, so
the operator is written as two DataFrame steps:

1. in-batch dedup: one row per key, chosen by a deterministic tie-break. The 64-bit
   hashes that repeat are found first, by a hash aggregation of 8 bytes a key; all other
   rows pass through untouched, neither sorted nor shuffled. Rows whose hash repeats are
   reduced per key (keys that only share a hash stay apart) by ``min`` over a struct, not
   by a window, so map-side partial aggregation collapses a hot key before the shuffle.
   If too many hashes repeat to be broadcast, all rows take that way: one shuffle;
2. anti join against the target's keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from fleetdw.session import fresh_scratch

_ROW = "__row"
_BREAK = "__rows"
_HASH = "__hash"


def _order_struct(tie_break: Sequence[str]) -> Column:
    """Ascending order on ``tie_break`` with NULLs last (flag first, then value)."""
    fields = []
    for i, c in enumerate(tie_break):
        fields.append(F.col(c).isNull().alias(f"n{i}"))
        fields.append(F.col(c).alias(f"v{i}"))
    return F.struct(*fields) if fields else F.struct(F.lit(0).alias("z"))


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _key_hash(keys: Sequence[str]) -> Column:
    """64-bit hash of a key; NULL, which joins nothing, if a part is NULL."""
    return F.when(~_any_null(keys), F.xxhash64(*keys))


def repeated_hashes(hashes: DataFrame, by: Sequence[str]) -> tuple[DataFrame, int]:
    """The values of the columns ``by`` that more than one row has, written, and how many they are. They
    are counted on the map side first, so a hot key costs one row a task."""
    spark = hashes.sparkSession
    found = hashes.groupBy(*by).agg(F.count(F.lit(1)).alias(_BREAK)).where(F.col(_BREAK) > 1).select(*by)
    path = fresh_scratch(spark, "repeated-hashes")
    seen = Observation()
    found.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    return spark.read.schema(found.schema).parquet(path), int(seen.get["n"])


def dedup_batch(batch: DataFrame, keys: Sequence[str], tie_break: Sequence[str] = (),
                keep: str = "first", probe: DataFrame | None = None,
                max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """One row per non-NULL key (first or last by ``tie_break``); NULL-key rows kept.

    ``probe``: a cheaper frame that has at least one row for each row of ``batch`` with the same
    key (e.g. the table the batch was derived from), to find repeated keys in.
    """
    cols = batch.columns
    typed = [F.col(k).cast(batch.schema[k].dataType).alias(k) for k in keys]  # equal keys hash alike
    known = (batch if probe is None else probe).where(~_any_null(keys)).select(*typed)
    repeated, n = repeated_hashes(known.select(_key_hash(keys).alias(_HASH)), [_HASH])
    if not n:
        return batch

    def reduced(rows: DataFrame) -> DataFrame:
        # the order holds the values of its columns, so a row moves once: order, then what it lacks
        rest = [c for c in cols if c not in keys and c not in tie_break]
        order = _order_struct(tie_break)
        row = F.struct(order.alias("o"), F.struct(F.lit(0).alias("z"), *[F.col(c) for c in rest]).alias("r"))
        best = rows.groupBy(*keys).agg((F.min if keep == "first" else F.max)(row).alias(_ROW))
        at = {**{c: F.col(f"{_ROW}.o.v{i}") for i, c in enumerate(tie_break)}, **{c: F.col(f"{_ROW}.r.{c}") for c in rest}}
        return best.select(*[F.col(c) if c in keys else at[c].alias(c) for c in cols])

    if n > max_broadcast_rows:
        return batch.where(_any_null(keys)).unionByName(reduced(batch.where(~_any_null(keys))))
    hashed = batch.withColumn(_HASH, _key_hash(keys))
    several = reduced(hashed.join(F.broadcast(repeated), _HASH, "left_semi"))
    return hashed.join(F.broadcast(repeated), _HASH, "left_anti").select(*cols).unionByName(several)


def insert_ignore(target: DataFrame | None, batch: DataFrame, keys: Sequence[str],
                  tie_break: Sequence[str] = (), batch_rows: int | None = None,
                  max_broadcast_rows: int = 1_000_000, probe: DataFrame | None = None) -> DataFrame:
    """Rows of ``batch`` that ``ON CONFLICT (keys) DO NOTHING`` would insert.

    NULL keys never equal anything, so NULL-key rows survive the anti join.

    ``batch_rows`` (a known row count of ``batch``) enables the incremental plan:
    when the batch is at most ``max_broadcast_rows`` rows, its keys are broadcast
    and probed against the target on the map side, so a daily delta is checked
    against a large table without shuffling the table's keys. ``probe`` is a cheap
    frame holding the batch's key columns (e.g. the staging table the batch was
    derived from), so the batch's own plan is not evaluated twice; repeated keys are
    looked for in it, too.
    """
    deduped = dedup_batch(batch, keys, tie_break, probe=probe)
    if target is None:
        return deduped
    existing = target.select(*keys).where(~_any_null(keys))
    if batch_rows is not None and batch_rows <= max_broadcast_rows:
        probe_keys = F.broadcast((probe if probe is not None else batch).select(*keys).where(~_any_null(keys)))
        existing = F.broadcast(existing.join(probe_keys, list(keys), "left_semi"))
    return deduped.join(existing, list(keys), "left_anti").select(*batch.columns)


def skipped_by_reason(target: DataFrame | None, batch: DataFrame, keys: Sequence[str],
                      tie_break: Sequence[str] = ()) -> DataFrame:
    """Accounting for an insert-ignore: (reason, n_rows) for every skipped row."""
    keyed = batch.where(~_any_null(keys))
    per_key = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    if target is not None:
        existing = target.select(*keys).where(~_any_null(keys)).distinct().withColumn("hit", F.lit(True))
        per_key = per_key.join(existing, list(keys), "left")
    else:
        per_key = per_key.withColumn("hit", F.lit(None).cast("boolean"))
    conflict = F.when(F.col("hit"), F.col("n")).otherwise(0)
    in_batch = F.when(F.col("hit"), 0).otherwise(F.col("n") - 1)
    totals = per_key.agg(F.sum(conflict).alias("existing"), F.sum(in_batch).alias("batch"))
    return totals.select(F.inline(F.array(
        F.struct(F.lit("conflict_existing").alias("reason"),
                 F.coalesce(F.col("existing"), F.lit(0)).cast("long").alias("n_rows")),
        F.struct(F.lit("duplicate_in_batch").alias("reason"),
                 F.coalesce(F.col("batch"), F.lit(0)).cast("long").alias("n_rows")),
    )))


def upsert(target: DataFrame | None, batch: DataFrame, keys: Sequence[str],
           tie_break: Sequence[str] = ()) -> DataFrame:
    """Full table after ``ON CONFLICT (keys) DO UPDATE``: the batch row wins.

    Returns the whole new version; write it to a new directory and switch to it
    (never overwrite a path that is being read).
    """
    deduped = dedup_batch(batch, keys, tie_break)
    if target is None:
        return deduped
    fresh_keys = deduped.select(*keys).where(~_any_null(keys))
    kept = target.join(fresh_keys, list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(deduped)
