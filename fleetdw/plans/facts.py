"""Fact loads L9-L11 and their discard accounting (Q9).

Mandatory dimensions are inner joins (the reference writes LEFT JOIN + IS NOT
NULL, which is the same thing); optional ones are left joins. Date keys are
computed (smart keys), not looked up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetdw.functions.dates import date_key
from fleetdw.operators.insert_ignore import insert_ignore
from fleetdw.operators.lookup import lookup
from fleetdw.schemas import MONEY, NATURAL_KEYS, SENTINEL_KEY

FACT_COLUMNS = {
    "fato_locacao": ["id_locacao_origem", "sk_cliente", "sk_veiculo", "sk_grupo", "sk_patio_retirada",
                     "sk_patio_devolucao", "sk_tempo_retirada", "sk_tempo_devolucao",
                     "sk_tempo_devolucao_prevista", "valor_diaria", "dias_locacao", "km_rodados",
                     "valor_total", "status", "id_reserva_origem", "id_sistema_origem"],
    "fato_reserva": ["id_reserva_origem", "sk_cliente", "sk_grupo", "sk_patio_retirada",
                     "sk_patio_devolucao", "sk_tempo_reserva", "sk_tempo_retirada_prevista",
                     "sk_tempo_devolucao_prevista", "antecedencia_dias", "qt_veiculos_solicitados",
                     "status", "id_sistema_origem"],
    "fato_movimentacao_patio": ["id_movimentacao_origem", "sk_veiculo", "sk_patio_origem",
                                "sk_patio_destino", "sk_tempo", "motivo", "quantidade_veiculos",
                                "id_sistema_origem"],
}
SYS = "id_sistema_origem"


def _c(n: str) -> Column:
    return F.col(n)


def resolved_rate() -> Column:
    """COALESCE(rate, total / NULLIF(days, 0)); NULL drops the rental (D5)."""
    return F.coalesce(_c("valor_diaria"), _c("valor_total") / F.nullif(_c("dias_locacao"), F.lit(0)))


def _tie(fact: str, first: str) -> list[str]:
    """Order among rows of one key: a column, then all others, so that a retried task keeps the same row."""
    return [first, *(c for c in FACT_COLUMNS[fact] if c != first)]


class Dims:
    """Written dimensions plus their row counts (for checked broadcasts)."""

    def __init__(self, tables: dict[str, DataFrame], counts: dict[str, int] | None = None):
        self.t = tables
        self.n = counts or {}

    def look(self, fact, name, pairs, take, how="left"):
        return lookup(fact, self.t[name], pairs, take, how, self.n.get(name))


def _rental_lookups(std_loc: DataFrame, dims: Dims, how: str) -> DataFrame:
    """Keys of a rental's dimensions. Groups and yards, few enough for a broadcast, first: their names
    need not move with the rows when customers and vehicles are too many for one."""
    f = dims.look(std_loc, "dim_grupo", [("nome_grupo", "nome_grupo"), (SYS, SYS)], {"sk_grupo": "sk_grupo"}, how)
    f = dims.look(f, "dim_patio", [("id_patio_retirada_origem", "id_patio_origem"), (SYS, SYS)],
                  {"sk_patio": "sk_patio_retirada"}, how)
    f = dims.look(f, "dim_patio", [("id_patio_devolucao_origem", "id_patio_origem"), (SYS, SYS)],
                  {"sk_patio": "sk_patio_devolucao"}, "left")
    f = dims.look(f, "dim_cliente", [("id_cliente_origem", "id_cliente_origem"), (SYS, SYS)],
                  {"sk_cliente": "sk_cliente"}, how)
    return dims.look(f, "dim_veiculo", [("id_veiculo_origem", "id_veiculo_origem"), (SYS, SYS)],
                     {"sk_veiculo": "sk_veiculo"}, how)


def fato_locacao_rows(std_loc: DataFrame, dims: Dims, existing: DataFrame | None = None,
                      batch_rows: int | None = None) -> DataFrame:  # L9
    f = _rental_lookups(std_loc, dims, "inner").where(resolved_rate().isNotNull()
                                                      & _c("dt_retirada").isNotNull())
    out = f.select(
        _c("id_locacao_origem"), _c("sk_cliente"), _c("sk_veiculo"), _c("sk_grupo"),
        _c("sk_patio_retirada"), _c("sk_patio_devolucao"),
        date_key(_c("dt_retirada")).alias("sk_tempo_retirada"),
        date_key(_c("dt_devolucao_real")).alias("sk_tempo_devolucao"),
        F.coalesce(date_key(_c("dt_devolucao_prevista")), F.lit(SENTINEL_KEY)).alias("sk_tempo_devolucao_prevista"),
        resolved_rate().cast(MONEY).alias("valor_diaria"),
        _c("dias_locacao"), _c("km_rodados"),
        F.coalesce(_c("valor_total"), _c("valor_diaria") * _c("dias_locacao")).cast(MONEY).alias("valor_total"),
        _c("status"), _c("id_reserva_origem"), _c(SYS))
    return insert_ignore(existing, out, NATURAL_KEYS["fato_locacao"], _tie("fato_locacao", "sk_tempo_retirada"), batch_rows,
                         probe=std_loc)


def fato_reserva_rows(std_res: DataFrame, dims: Dims, existing: DataFrame | None = None,
                      batch_rows: int | None = None) -> DataFrame:  # L10
    f = dims.look(std_res, "dim_cliente", [("id_cliente_origem", "id_cliente_origem"), (SYS, SYS)],
                  {"sk_cliente": "sk_cliente"}, "inner")
    f = dims.look(f, "dim_patio", [("id_patio_retirada_origem", "id_patio_origem"), (SYS, SYS)],
                  {"sk_patio": "sk_patio_retirada"}, "left")
    f = dims.look(f, "dim_patio", [("id_patio_devolucao_origem", "id_patio_origem"), (SYS, SYS)],
                  {"sk_patio": "sk_patio_devolucao"}, "left")
    f = f.where(_c("dt_retirada_prevista").isNotNull())
    out = f.select(
        _c("id_reserva_origem"), _c("sk_cliente"), F.lit(None).cast("long").alias("sk_grupo"),
        _c("sk_patio_retirada"), _c("sk_patio_devolucao"),
        date_key(F.coalesce(_c("dt_reserva"), _c("dt_retirada_prevista"))).alias("sk_tempo_reserva"),
        date_key(_c("dt_retirada_prevista")).alias("sk_tempo_retirada_prevista"),
        date_key(_c("dt_devolucao_prevista")).alias("sk_tempo_devolucao_prevista"),
        _c("antecedencia_dias"),
        F.coalesce(_c("qt_veiculos_solicitados"), F.lit(1)).alias("qt_veiculos_solicitados"),
        _c("status"), _c(SYS))
    return insert_ignore(existing, out, NATURAL_KEYS["fato_reserva"], _tie("fato_reserva", "sk_tempo_reserva"), batch_rows,
                         probe=std_res)


def fato_movimentacao_rows(std_mov: DataFrame, dims: Dims, existing: DataFrame | None = None,
                           batch_rows: int | None = None) -> DataFrame:  # L11
    f = dims.look(std_mov, "dim_veiculo", [("id_veiculo_origem", "id_veiculo_origem"), (SYS, SYS)],
                  {"sk_veiculo": "sk_veiculo"}, "inner")
    f = dims.look(f, "dim_patio", [("id_patio_origem_origem", "id_patio_origem"), (SYS, SYS)],
                  {"sk_patio": "sk_patio_origem"}, "inner")
    f = dims.look(f, "dim_patio", [("id_patio_destino_origem", "id_patio_origem"), (SYS, SYS)],
                  {"sk_patio": "sk_patio_destino"}, "left")
    out = f.select(
        _c("id_movimentacao_origem"), _c("sk_veiculo"), _c("sk_patio_origem"), _c("sk_patio_destino"),
        date_key(_c("dt_saida_origem")).alias("sk_tempo"), _c("motivo"),
        F.lit(1).alias("quantidade_veiculos"), _c(SYS))
    return insert_ignore(existing, out, NATURAL_KEYS["fato_movimentacao_patio"], _tie("fato_movimentacao_patio", "sk_tempo"), batch_rows,
                         probe=std_mov)


#: fact -> (standard table, rows of a batch of it)
BUILDERS = {
    "fato_locacao": ("std_locacao", fato_locacao_rows),
    "fato_reserva": ("std_reserva", fato_reserva_rows),
    "fato_movimentacao_patio": ("std_movimentacao", fato_movimentacao_rows),
}


def discards(std: dict[str, DataFrame], dims: Dims) -> DataFrame:  # Q9
    """Every std row the fact loads drop, by first failing rule: (fato, motivo, sys, n)."""
    loc = _rental_lookups(std["std_locacao"], dims, "left")
    loc_reason = (F.when(_c("sk_cliente").isNull(), "cliente_ausente")
                  .when(_c("sk_veiculo").isNull(), "veiculo_ausente")
                  .when(_c("sk_grupo").isNull(), "grupo_ausente")
                  .when(_c("sk_patio_retirada").isNull(), "patio_retirada_ausente")
                  .when(_c("dt_retirada").isNull(), "retirada_sem_data")
                  .when(resolved_rate().isNull(), "valor_diaria_irresolvivel"))
    res = dims.look(std["std_reserva"], "dim_cliente", [("id_cliente_origem", "id_cliente_origem"), (SYS, SYS)],
                    {"sk_cliente": "sk_cliente"}, "left")
    res_reason = (F.when(_c("sk_cliente").isNull(), "cliente_ausente")
                  .when(_c("dt_retirada_prevista").isNull(), "retirada_prevista_ausente"))
    mov = dims.look(std["std_movimentacao"], "dim_veiculo", [("id_veiculo_origem", "id_veiculo_origem"), (SYS, SYS)],
                    {"sk_veiculo": "sk_veiculo"}, "left")
    mov = dims.look(mov, "dim_patio", [("id_patio_origem_origem", "id_patio_origem"), (SYS, SYS)],
                    {"sk_patio": "sk_patio_origem"}, "left")
    mov_reason = (F.when(_c("sk_veiculo").isNull(), "veiculo_ausente")
                  .when(_c("sk_patio_origem").isNull(), "patio_origem_ausente"))
    parts = [
        loc.select(F.lit("fato_locacao").alias("fato"), loc_reason.alias("motivo"), _c(SYS)),
        res.select(F.lit("fato_reserva").alias("fato"), res_reason.alias("motivo"), _c(SYS)),
        mov.select(F.lit("fato_movimentacao_patio").alias("fato"), mov_reason.alias("motivo"), _c(SYS)),
    ]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2]).where(_c("motivo").isNotNull())
    return u.groupBy("fato", "motivo", SYS).agg(F.count(F.lit(1)).alias("n_descartes"))
