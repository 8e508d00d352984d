"""Transform T1-T7: raw staging (24 frames) -> standard staging (7 frames).

Conforms enum spellings, fills missing attributes with typed NULLs, computes
lead time and rental days as whole 24-hour periods, reconciles daily rate and
total per source and unions the four sources by name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetdw.functions.dates import whole_days
from fleetdw.functions.text import normalise_gearbox, null_of
from fleetdw.operators.lookup import left_join_known
from fleetdw.schemas import MONEY, STD_COLUMNS, SYS_A, SYS_B, SYS_C, SYS_D

LETTER_SYS = {"A": SYS_A, "B": SYS_B, "C": SYS_C, "D": SYS_D}


def _union(frames: list[DataFrame], table: str) -> DataFrame:
    cols = STD_COLUMNS[table]
    return reduce(lambda a, b: a.unionByName(b), [f.select(*cols) for f in frames])


def _c(n: str) -> Column:
    return F.col(n)


def std_patio(stg) -> DataFrame:  # T1
    return _union([stg[p]["patio"] for p in "ABCD"], "std_patio")


def std_cliente(stg) -> DataFrame:  # T2
    return _union([stg[p]["cliente"] for p in "ABCD"], "std_cliente")


def std_grupo(stg) -> DataFrame:  # T3: distinct (group, conformed gearbox) per source
    parts = []
    for p in "ABCD":
        v = stg[p]["veiculo"].where(_c("nome_grupo").isNotNull())
        parts.append(v.select(
            null_of("string").alias("id_grupo_origem"), _c("nome_grupo"),
            normalise_gearbox(LETTER_SYS[p], _c("mecanizacao")).alias("mecanizacao"),
            null_of("string").alias("classe_luxo"), null_of("decimal(10,2)").alias("valor_diaria_base"),
            _c("id_sistema_origem")).distinct())
    return _union(parts, "std_grupo")


def std_veiculo(stg) -> DataFrame:  # T4
    parts = [stg[p]["veiculo"].withColumn(
        "mecanizacao", normalise_gearbox(LETTER_SYS[p], _c("mecanizacao"))) for p in "ABCD"]
    return _union(parts, "std_veiculo")


def std_reserva(stg) -> DataFrame:  # T5
    parts = []
    for p in "ABCD":
        r = stg[p]["reserva"]
        if p == "A":
            r = r.withColumn("id_patio_devolucao_origem", null_of("string"))
        lead = (null_of("int") if p == "B"
                else whole_days(_c("dt_retirada_prevista"), _c("dt_reserva")))
        parts.append(r.withColumn("antecedencia_dias", lead))
    return _union(parts, "std_reserva")


def _rental_common(l: DataFrame) -> list[Column]:
    return [
        whole_days(_c("l.dt_devolucao_real"), _c("l.dt_retirada")).alias("dias_locacao"),
        null_of("int").alias("km_rodados"),
        F.when(_c("l.dt_devolucao_real").isNull(), "EM_ANDAMENTO").otherwise("CONCLUIDA").alias("status"),
    ]


def _rate_times_days() -> Column:
    days = whole_days(_c("l.dt_devolucao_real"), _c("l.dt_retirada"))
    return F.when(_c("l.dt_devolucao_real").isNotNull(), _c("l.valor_diaria") * days).cast(MONEY)


def std_locacao_of(stg, p: str) -> DataFrame:  # T6, one source
    ids = ["id_locacao_origem", "id_reserva_origem", "id_cliente_origem", "id_veiculo_origem"]
    yards = ["id_patio_retirada_origem", "id_patio_devolucao_origem", "dt_retirada", "dt_devolucao_real"]
    l = stg[p]["locacao"].alias("l")
    v = stg[p]["veiculo"].select("id_veiculo_origem", "nome_grupo").alias("v")
    j = l.join(v, _c("v.id_veiculo_origem") == _c("l.id_veiculo_origem"))
    if p in ("B", "C"):
        # walk-ins have no reservation: they are not one hot NULL key
        r = stg[p]["reserva"].select("id_reserva_origem", "dt_devolucao_prevista")
        rental = left_join_known(stg[p]["locacao"], r, ["id_reserva_origem"], "id_reserva_origem").alias("l")
        j = rental.join(v, _c("v.id_veiculo_origem") == _c("l.id_veiculo_origem"))
        planned = _c("l.dt_devolucao_prevista")
    else:
        planned = null_of("timestamp_ntz")
    if p in ("A", "C"):
        rate, total = _c("l.valor_diaria"), _rate_times_days()
    elif p == "B":
        rate, total = null_of("decimal(10,2)"), _c("l.valor_total")
    else:
        rate, total = null_of("decimal(10,2)"), F.coalesce(_c("l.valor_final"), _c("l.valor_previsto"))
    return j.select(
        *[_c(f"l.{c}").alias(c) for c in ids], _c("v.nome_grupo"),
        *[_c(f"l.{c}").alias(c) for c in yards],
        planned.alias("dt_devolucao_prevista"), rate.cast(MONEY).alias("valor_diaria"),
        total.cast(MONEY).alias("valor_total"), *_rental_common(l),
        _c("l.id_sistema_origem")).select(*STD_COLUMNS["std_locacao"])


def std_locacao(stg) -> DataFrame:  # T6
    return _union([std_locacao_of(stg, p) for p in "ABCD"], "std_locacao")


def std_movimentacao(stg) -> DataFrame:  # T7
    parts = []
    for p in "ABCD":
        m = stg[p]["movimentacao"]
        if p != "D":
            m = m.withColumn("motivo", null_of("string"))
        parts.append(m)
    return _union(parts, "std_movimentacao")


TRANSFORMS = {
    "std_patio": std_patio,
    "std_cliente": std_cliente,
    "std_grupo": std_grupo,
    "std_veiculo": std_veiculo,
    "std_reserva": std_reserva,
    "std_locacao": std_locacao,
    "std_movimentacao": std_movimentacao,
}


#: Standard tables whose joins shuffle a fact's rows: their rows of one source.
BY_SOURCE = {"std_locacao": std_locacao_of}


def transform_all(stg) -> dict[str, DataFrame]:
    return {name: fn(stg) for name, fn in TRANSFORMS.items()}
