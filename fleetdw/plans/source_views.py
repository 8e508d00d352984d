"""Management views V1-V5 defined on source C's own schema.

Large inputs (rentals, reservations) are aggregated on their foreign keys first
and only the small aggregate meets the lookup tables; the second aggregation
folds keys that share a label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(n: str) -> Column:
    return F.col(n)


def available_by_yard_group(c: dict[str, DataFrame]) -> DataFrame:  # V1
    v = c["veiculo"].where(_c("situacao") == "DISPONIVEL").groupBy("grupo_id", "patio_origem_id").agg(
        F.count(F.lit(1)).alias("n"))
    g = c["grupo"].select("id_grupo", _c("codigo").alias("grupo"))
    p = c["patio"].select("id_patio", _c("nome").alias("patio"))
    j = v.join(g, _c("grupo_id") == _c("id_grupo")).join(p, _c("patio_origem_id") == _c("id_patio"))
    return j.groupBy("patio", "grupo").agg(F.sum("n").cast("long").alias("total"))


def rentals_in_progress(c: dict[str, DataFrame]) -> DataFrame:  # V2
    l = c["locacao"].where(_c("status") == "EM_ANDAMENTO").groupBy("veiculo_id").agg(F.count(F.lit(1)).alias("n"))
    v = c["veiculo"].select("id_veiculo", "grupo_id")
    g = c["grupo"].select("id_grupo", _c("codigo").alias("grupo"))
    j = l.join(v, _c("veiculo_id") == _c("id_veiculo")).join(g, _c("grupo_id") == _c("id_grupo"))
    return j.groupBy("grupo").agg(F.sum("n").cast("long").alias("total_locacoes"))


def reservations_by_group_yard_city(c: dict[str, DataFrame]) -> DataFrame:  # V3
    r = (c["reserva"].where(_c("estado").isin("CONFIRMADA", "EM_FILA_ESPERA"))
         .groupBy("grupo_id", "patio_retirada_id", "cliente_id").agg(F.count(F.lit(1)).alias("n")))
    g = c["grupo"].select("id_grupo", _c("codigo").alias("grupo"))
    p = c["patio"].select("id_patio", _c("nome").alias("patio_retirada"))
    cl = c["cliente"].select("id_cliente", "cidade_origem")
    j = (r.join(g, _c("grupo_id") == _c("id_grupo")).join(p, _c("patio_retirada_id") == _c("id_patio"))
         .join(cl, _c("cliente_id") == _c("id_cliente")))
    return j.groupBy("grupo", "patio_retirada", "cidade_origem").agg(F.sum("n").cast("long").alias("total"))


def rentals_by_city_group(c: dict[str, DataFrame]) -> DataFrame:  # V4
    l = c["locacao"].groupBy("cliente_id", "veiculo_id").agg(F.count(F.lit(1)).alias("n"))
    cl = c["cliente"].select("id_cliente", "cidade_origem")
    v = c["veiculo"].select("id_veiculo", "grupo_id")
    g = c["grupo"].select("id_grupo", _c("codigo").alias("grupo"))
    j = (l.join(cl, _c("cliente_id") == _c("id_cliente")).join(v, _c("veiculo_id") == _c("id_veiculo"))
         .join(g, _c("grupo_id") == _c("id_grupo")))
    out = j.groupBy("cidade_origem", "grupo").agg(F.sum("n").cast("long").alias("total_locacoes"))
    return out.orderBy(_c("total_locacoes").desc())


def completed_by_yard_pair(c: dict[str, DataFrame]) -> DataFrame:  # V5 (same-yard pairs kept)
    l = (c["locacao"].where(_c("status") == "CONCLUIDA")
         .groupBy("patio_retirada_id", "patio_devolucao_id").agg(F.count(F.lit(1)).alias("n")))
    pr = c["patio"].select(_c("id_patio").alias("pr_id"), _c("nome").alias("patio_retirada"))
    pd = c["patio"].select(_c("id_patio").alias("pd_id"), _c("nome").alias("patio_devolucao"))
    j = l.join(pr, _c("patio_retirada_id") == _c("pr_id")).join(pd, _c("patio_devolucao_id") == _c("pd_id"))
    return j.groupBy("patio_retirada", "patio_devolucao").agg(F.sum("n").cast("long").alias("total_locacoes"))
