"""Dimension loads L2-L8 (rows to insert; keys are assigned by the star store)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetdw.functions.dates import calendar, sentinel_row
from fleetdw.operators.insert_ignore import insert_ignore
from fleetdw.schemas import NATURAL_KEYS

DIM_COLUMNS = {
    "dim_patio": ["id_patio_origem", "nome_patio", "cidade", "localizacao", "id_sistema_origem"],
    "dim_cliente": ["id_cliente_origem", "nome_cliente", "tipo_cliente", "cidade_origem",
                    "estado_origem", "id_sistema_origem"],
    "dim_grupo": ["id_grupo_origem", "nome_grupo", "mecanizacao", "classe_luxo",
                  "valor_diaria_base", "id_sistema_origem"],
    "dim_veiculo": ["id_veiculo_origem", "placa", "chassi", "marca", "modelo", "ano", "cor",
                    "ar_condicionado", "id_sistema_origem"],
}
SK_COLUMN = {"dim_patio": "sk_patio", "dim_cliente": "sk_cliente", "dim_grupo": "sk_grupo",
             "dim_veiculo": "sk_veiculo"}

# Deterministic choice among rows sharing a natural key inside one batch: these columns
# first, then all others, so that a retried task keeps the same row.
_FIRST = {
    "dim_patio": ["nome_patio"],
    "dim_cliente": ["nome_cliente"],
    "dim_grupo": ["mecanizacao"],  # D7: AUTOMATICO before MANUAL, NULL last
    "dim_veiculo": ["id_sistema_origem", "id_veiculo_origem"],  # D8: first source wins
}
TIE_BREAK = {name: [*first, *(c for c in DIM_COLUMNS[name] if c not in first)] for name, first in _FIRST.items()}


def date_bounds(std: dict[str, DataFrame]) -> DataFrame:  # L3
    """MIN/MAX over the 8 date columns, as plain-column aggregates.

    The reference unions eight date lists (one of them COALESCE(dt_reserva,
    dt_retirada_prevista)) only to take MIN and MAX. The union of that coalesce
    with dt_retirada_prevista is the same set as the two columns' own values, so
    every member is a plain column: one MIN/MAX pass per table, no distinct, and
    answerable from Parquet footer statistics where aggregate pushdown is enabled.
    Casting to date is monotonic, so it is applied after the aggregation.
    """
    cols = {
        "std_locacao": ["dt_retirada", "dt_devolucao_real", "dt_devolucao_prevista"],
        "std_reserva": ["dt_reserva", "dt_retirada_prevista", "dt_devolucao_prevista"],
        "std_movimentacao": ["dt_saida_origem", "dt_chegada_destino"],
    }
    parts = []
    for table, names in cols.items():
        agg = std[table].agg(*[F.min(c).alias(f"lo_{c}") for c in names],
                             *[F.max(c).alias(f"hi_{c}") for c in names])
        parts.append(agg.select(F.least(*[F.col(f"lo_{c}") for c in names]).cast("date").alias("lo"),
                                F.greatest(*[F.col(f"hi_{c}") for c in names]).cast("date").alias("hi")))
    u = reduce(lambda a, b: a.unionByName(b), parts)
    return u.agg(F.min("lo").alias("dt_ini"), F.max("hi").alias("dt_fim"))


def dim_tempo_rows(spark: SparkSession, std: dict[str, DataFrame],
                   existing: DataFrame | None = None) -> DataFrame:  # L2 + L4
    rows = sentinel_row(spark).unionByName(calendar(date_bounds(std).where(F.col("dt_ini").isNotNull())))
    return insert_ignore(existing, rows, NATURAL_KEYS["dim_tempo"])


def dim_rows(name: str, std: dict[str, DataFrame], existing: DataFrame | None = None) -> DataFrame:
    """L5-L8: std rows -> rows to insert into ``name`` (without surrogate key)."""
    src = {"dim_patio": "std_patio", "dim_cliente": "std_cliente", "dim_grupo": "std_grupo",
           "dim_veiculo": "std_veiculo"}[name]
    df = std[src]
    if name == "dim_veiculo":
        df = df.withColumn("ano", F.col("ano").cast("short"))
    batch = df.select(*DIM_COLUMNS[name])
    return insert_ignore(existing, batch, NATURAL_KEYS[name], TIE_BREAK[name])
