"""How the facts lie in storage, and the loads that use it.

A fact is partitioned by source and by the month of the date its key is tied to; rentals
also by whether they are open. So

* the conflict check of a batch reads the months the batch can hit (:func:`hit_months`),
  and only its key columns;
* R2 reads the open rentals, R3 the months to come;
* an update rewrites the partitions in which a row is new or differs, and no others
  (:func:`refresh`).

Rows are dealt out by partition before they are written (``REBALANCE``: AQE splits a large month
into several files and packs small ones into one task), so a month is a few files.

An update first writes the new content of the touched partitions to ``<table>.pending``, then
overwrites them (dynamic partition overwrite) and deletes those that have become empty. A run
that dies in between is finished by the next load (:func:`finish_pending`), before it reads.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetdw.session import CODEC

MONTH = "mes"
STATE = "situacao"
OPEN, CLOSED = "aberta", "fechada"
SYS = "id_sistema_origem"
#: Row count up to which a batch's keys are broadcast.
SMALL_BATCH = 1_000_000


@dataclass(frozen=True)
class Layout:
    """``date``: the date key (yyyymmdd) that gives the month; ``std_date``: the standard table's
    column it comes from; ``open``: the date key that open rows lack."""

    date: str
    std_date: str
    open: str | None = None

    @property
    def columns(self) -> list[str]:
        return [SYS, *([STATE] if self.open else []), MONTH]


LAYOUTS = {
    "fato_locacao": Layout("sk_tempo_retirada", "dt_retirada", open="sk_tempo_devolucao"),
    "fato_reserva": Layout("sk_tempo_retirada_prevista", "dt_retirada_prevista"),
    "fato_movimentacao_patio": Layout("sk_tempo", "dt_saida_origem"),
}


def month_of(date_key: Column) -> Column:
    return F.floor(date_key / 100).cast("int")


def laid_out(name: str, rows: DataFrame) -> DataFrame:
    """``rows`` with their partition columns."""
    lay = LAYOUTS[name]
    if lay.open:
        rows = rows.withColumn(STATE, F.when(F.col(lay.open).isNull(), OPEN).otherwise(CLOSED))
    return rows.withColumn(MONTH, month_of(F.col(lay.date)))


def write(name: str, rows: DataFrame, path: str, mode: str = "append") -> None:
    """Write ``rows`` (with their partition columns). ``mode="overwrite"`` replaces the partitions
    that ``rows`` has, and leaves all others as they are."""
    lay = LAYOUTS[name]
    dealt = rows.hint("rebalance", *[F.col(c) for c in lay.columns])
    (dealt.write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy(*lay.columns).parquet(path, compression=CODEC))


def hit_months(name: str, std: DataFrame) -> list[int | None]:
    """The months a batch of standard rows falls into: no more than the calendar has."""
    d = F.col(LAYOUTS[name].std_date)
    return [r[0] for r in std.select((F.year(d) * 100 + F.month(d)).alias("m")).distinct().collect()]


def in_months(fact: DataFrame, months: Sequence[int | None]) -> DataFrame:
    """The partitions of ``months``; a fact without months (an older layout) as it is."""
    if MONTH not in fact.columns:
        return fact
    hit = F.col(MONTH).isin([m for m in months if m is not None])
    return fact.where(hit | F.col(MONTH).isNull() if None in months else hit)


def open_rows(rentals: DataFrame) -> DataFrame:
    """Open rentals, from their partitions only."""
    still = F.col(LAYOUTS["fato_locacao"].open).isNull()
    return rentals.where((F.col(STATE) == OPEN) & still) if STATE in rentals.columns else rentals.where(still)


def with_requested(rentals: DataFrame, reservations: DataFrame) -> DataFrame:
    """Rentals with the vehicles their reservation asks for, as loaded (D1): carried on the rental, so
    that R4 does not join two facts."""
    from fleetdw.operators.lookup import left_join_known

    asked = (reservations.where(F.col("id_reserva_origem").isNotNull())
             .select(SYS, "id_reserva_origem", F.col("qt_veiculos_solicitados").alias("qt_veiculos_reserva")))
    return left_join_known(rentals, asked, [SYS, "id_reserva_origem"], "id_reserva_origem").select(
        *rentals.columns, "qt_veiculos_reserva")


# ------------------------------------------------------------------ update
def _partition(columns: Sequence[str], prefix: str = "") -> Column:
    return F.concat_ws("/", *[F.coalesce(F.col(prefix + c).cast("string"), F.lit("-")) for c in columns])


def differing(name: str, existing: DataFrame, batch: DataFrame, keys: Sequence[str], sk: str, start: int,
              small: bool) -> DataFrame:
    """Rows of ``batch`` (with partition columns) whose key is not in ``existing`` or whose other
    columns differ, with their surrogate key (kept, or new from ``start``) and, as
    ``was``, the partition of the row they replace."""
    lay = LAYOUTS[name]
    cols = [c for c in existing.columns if c != sk]
    wanted = batch.select(*keys).where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    old = existing.join(F.broadcast(wanted) if small else wanted, list(keys), "left_semi")
    old = old.select(F.col(sk).alias("o_sk"), *[F.col(c).alias(f"o_{c}") for c in cols])
    same_key = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"o_{k}") for k in keys])
    met = batch.join(F.broadcast(old) if small else old, same_key, "left")
    changed = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"o_{c}")) for c in cols])
    fresh = F.lit(start) + F.monotonically_increasing_id()
    return met.where(F.col("o_sk").isNull() | changed).select(
        F.coalesce("o_sk", fresh).alias(sk), *cols,
        F.when(F.col("o_sk").isNotNull(), _partition(lay.columns, "o_")).alias("was"))


def refresh(name: str, path: str, existing: DataFrame, changes: DataFrame, keys: Sequence[str],
            finish: Callable[[], None]) -> None:
    """Put ``changes`` (a written table of :func:`differing`) into the partitions they touch; ``finish``
    runs :func:`finish_pending`."""
    lay = LAYOUTS[name]
    now = _partition(lay.columns)
    touched = [r[0] for r in changes.select(now.alias("p")).unionByName(
        changes.where(F.col("was").isNotNull()).select(F.col("was").alias("p"))).distinct().collect()]
    if not touched:
        return
    replaced = changes.where(F.col("was").isNotNull()).select(*keys)
    kept = existing.where(now.isin(touched)).join(replaced, list(keys), "left_anti").select(*existing.columns)
    merged = kept.unionByName(changes.select(*existing.columns))
    # partitions that end up empty are named beside the rows: a row of nulls, marked
    rows = merged.withColumn("__emptied", F.lit(None).cast("string"))
    marks = changes.sparkSession.createDataFrame([(p,) for p in touched], "__emptied string")
    rows.unionByName(marks, allowMissingColumns=True).write.mode("overwrite").parquet(f"{path}.pending")
    finish()


def finish_pending(spark: SparkSession, name: str, path: str) -> bool:
    """Bring an update that was written, but not wholly applied, to its end."""
    from fleetdw.plans.star import committed, hadoop_path

    pending = f"{path}.pending"
    if not committed(spark, pending):
        return False
    lay = LAYOUTS[name]
    rows = spark.read.parquet(pending)
    content = rows.where(F.col("__emptied").isNull()).drop("__emptied")
    write(name, content, path, mode="overwrite")
    here = content.select(_partition(lay.columns).alias("__emptied")).distinct()
    gone = rows.where(F.col("__emptied").isNotNull()).select("__emptied").join(here, "__emptied", "left_anti")
    for (p,) in gone.collect():
        values = ["__HIVE_DEFAULT_PARTITION__" if v == "-" else v for v in p.split("/")]
        folder = "/".join([path, *[f"{c}={v}" for c, v in zip(lay.columns, values, strict=True)]])
        fs, p = hadoop_path(spark, folder)
        fs.delete(p, True)
    fs, p = hadoop_path(spark, pending)
    fs.delete(p, True)
    return True
