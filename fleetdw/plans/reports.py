"""Management reports R1-R4 over the star schema.

Every report starts from the fact, reduces it as early as possible, and meets
the dimensions through surrogate keys. Dimensions are broadcast only behind the
row counts recorded at load time (``counts``); ``as_of`` replaces CURRENT_DATE.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetdw.functions.numeric import avg_round
from fleetdw.operators.lookup import checked_broadcast
from fleetdw.plans.fact_store import MONTH, open_rows, with_requested
from fleetdw.schemas import AS_OF, NOT_INFORMED, SENTINEL_KEY

# Status spellings the reference treats as cancelled (R3) and as
# completed (R4b, optional filter).
CANCELLED = ["cancelada", "cancelado", "CANCELADA", "CANCELADO"]
COMPLETED = ["concluida", "concluído", "CONCLUIDA", "CONCLUIDO"]


def _c(n: str) -> Column:
    return F.col(n)


def _dim(dw: dict[str, DataFrame], counts: dict[str, int] | None, name: str, *cols: Column) -> DataFrame:
    return checked_broadcast(dw[name].select(*cols), (counts or {}).get(name))


def fleet_by_group(dw: dict[str, DataFrame], counts: dict[str, int] | None = None) -> DataFrame:  # R1
    """Vehicles that were rented at least once, by make, model, group and source."""
    pairs = dw["fato_locacao"].select("sk_veiculo", "sk_grupo").distinct()
    v = _dim(dw, counts, "dim_veiculo", _c("sk_veiculo"), _c("marca"), _c("modelo"),
             _c("id_sistema_origem").alias("sys_v"))
    g = _dim(dw, counts, "dim_grupo", _c("sk_grupo"), _c("nome_grupo"), _c("mecanizacao"),
             _c("id_sistema_origem").alias("sys_g"))
    j = pairs.join(v, "sk_veiculo").join(g, "sk_grupo").where(_c("sys_v") == _c("sys_g"))
    out = j.groupBy("marca", "modelo", "nome_grupo", "mecanizacao", _c("sys_v").alias("sistema_origem")).agg(
        F.countDistinct("sk_veiculo").alias("qt_veiculos"))
    return out.orderBy(*[_c(k).asc_nulls_last() for k in ("sistema_origem", "nome_grupo", "marca", "modelo")])


def open_rentals(dw: dict[str, DataFrame], counts: dict[str, int] | None = None,
                 as_of: _dt.date = AS_OF) -> DataFrame:  # R2
    today = F.lit(as_of).cast("date")
    f = open_rows(dw["fato_locacao"])
    g = _dim(dw, counts, "dim_grupo", _c("sk_grupo"), _c("nome_grupo"), _c("mecanizacao"))
    v = _dim(dw, counts, "dim_veiculo", _c("sk_veiculo"), _c("placa"), _c("marca"), _c("modelo"))
    c = _dim(dw, counts, "dim_cliente", _c("sk_cliente"), _c("nome_cliente"))
    t_ret = _dim(dw, counts, "dim_tempo", _c("sk_tempo").alias("sk_tempo_retirada"), _c("dt_ref").alias("dt_retirada"))
    t_prev = _dim(dw, counts, "dim_tempo", _c("sk_tempo").alias("sk_tempo_devolucao_prevista"),
                  _c("dt_ref").alias("dt_devolucao_prevista"))
    j = (f.join(g, "sk_grupo").join(v, "sk_veiculo").join(c, "sk_cliente")
         .join(t_ret, "sk_tempo_retirada").join(t_prev, "sk_tempo_devolucao_prevista"))
    unknown = _c("sk_tempo_devolucao_prevista") == SENTINEL_KEY
    out = j.select(
        "nome_grupo", "mecanizacao", "placa", "marca", "modelo", "nome_cliente",
        _c("id_sistema_origem").alias("sistema_origem"), "dt_retirada", "dt_devolucao_prevista",
        _c("dias_locacao").alias("dias_contratados"),
        F.when(~unknown, F.datediff(_c("dt_devolucao_prevista"), today)).alias("dias_restantes_devolucao"),
        F.when(~unknown, _c("dt_devolucao_prevista") < today).alias("em_atraso"),
        "valor_diaria", "valor_total", "status")
    return out.orderBy(_c("dias_restantes_devolucao").asc_nulls_last(), _c("nome_grupo").asc_nulls_last(),
                       _c("placa").asc_nulls_last())


def horizon_bucket(pickup: Column, today: Column) -> Column:
    return (F.when(pickup <= F.date_add(today, 7), "Esta Semana")
            .when(pickup <= F.date_add(today, 14), "Próxima Semana")
            .when(pickup <= F.date_add(today, 30), "Este Mês")
            .when(pickup <= F.date_add(today, 90), "Próximos 3M")
            .otherwise("Mais de 3M"))


def duration_bucket(ret: Column, pickup: Column) -> Column:
    days = F.datediff(ret, pickup)  # calendar days (date - date)
    return (F.when(ret.isNull(), NOT_INFORMED)
            .when(days <= 3, "Até 3 dias")
            .when(days <= 7, "4 a 7 dias")
            .when(days <= 15, "8 a 15 dias")
            .otherwise("Mais de 15 dias"))


def reservation_demand(dw: dict[str, DataFrame], counts: dict[str, int] | None = None,
                       as_of: _dt.date = AS_OF, strict_reference: bool = False) -> DataFrame:  # R3
    """Future, non-cancelled reservations by group, yard, horizon, duration and customer.

    Cancelled = ``lower(status) in (cancelada, cancelado)``; ``strict_reference``
    uses the literal four-spelling list instead (misses source A's 'Cancelada').
    """
    today = F.lit(as_of).cast("date")
    fr = dw["fato_reserva"]
    status_ok = (~_c("status").isin(*CANCELLED) if strict_reference
                 else ~F.lower(_c("status")).isin("cancelada", "cancelado"))
    t_ret = _dim(dw, counts, "dim_tempo", _c("sk_tempo").alias("sk_tempo_retirada_prevista"),
                 _c("dt_ref").alias("dt_ret"))
    t_dev = _dim(dw, counts, "dim_tempo", _c("sk_tempo").alias("sk_tempo_devolucao_prevista"),
                 _c("dt_ref").alias("dt_dev"))
    # the key is yyyymmdd, so the date condition holds on the fact itself and prunes its partitions
    if MONTH in fr.columns:
        fr = fr.where(_c(MONTH) >= int(f"{as_of:%Y%m}"))
    f = fr.where(status_ok & (_c("sk_tempo_retirada_prevista") > int(f"{as_of:%Y%m%d}")))
    f = f.join(t_ret, "sk_tempo_retirada_prevista").where(_c("dt_ret") > today)
    f = f.join(t_dev, "sk_tempo_devolucao_prevista", "left")
    c = _dim(dw, counts, "dim_cliente", _c("sk_cliente"), _c("cidade_origem"), _c("tipo_cliente"))
    g = _dim(dw, counts, "dim_grupo", _c("sk_grupo"), _c("nome_grupo"), _c("mecanizacao"))
    p = _dim(dw, counts, "dim_patio", _c("sk_patio").alias("sk_patio_retirada"), _c("nome_patio"),
             _c("cidade").alias("cidade_patio_raw"))
    j = f.join(c, "sk_cliente").join(g, "sk_grupo", "left").join(p, "sk_patio_retirada", "left")
    j = j.select("*", horizon_bucket(_c("dt_ret"), today).alias("horizonte_retirada"),
                 duration_bucket(_c("dt_dev"), _c("dt_ret")).alias("faixa_duracao"))
    keys = ["nome_grupo", "mecanizacao", "nome_patio", "cidade_patio_raw", "horizonte_retirada", "dt_ret",
            "faixa_duracao", "cidade_origem", "tipo_cliente", "id_sistema_origem"]
    agg = j.groupBy(*keys).agg(F.count(F.lit(1)).alias("qt_reservas"),
                               F.sum("qt_veiculos_solicitados").cast("long").alias("qt_veiculos_solicitados"))
    fill = lambda col: F.coalesce(_c(col), F.lit(NOT_INFORMED))
    out = agg.select(
        fill("nome_grupo").alias("nome_grupo"), fill("mecanizacao").alias("mecanizacao"),
        fill("nome_patio").alias("nome_patio"), fill("cidade_patio_raw").alias("cidade_patio"),
        "horizonte_retirada", _c("dt_ret").alias("dt_retirada_prevista"), "faixa_duracao",
        fill("cidade_origem").alias("cidade_cliente"), "tipo_cliente",
        _c("id_sistema_origem").alias("sistema_origem"), "qt_reservas", "qt_veiculos_solicitados")
    return out.orderBy(*[_c(k).asc_nulls_last() for k in ("sistema_origem", "horizonte_retirada",
                                                          "dt_retirada_prevista", "nome_grupo", "nome_patio")])


def top_groups(dw: dict[str, DataFrame], counts: dict[str, int] | None = None,
               completed_only: bool = False) -> DataFrame:  # R4 / R4b
    """Rental volume by group x customer origin, ranked per source (RANK: ties share)."""
    f = dw["fato_locacao"]
    if completed_only:
        f = f.where(_c("status").isin(*COMPLETED))
    # D1: requested vehicles come from the rental's reservation, matched on (source, id); the load
    # carries them on the rental (facts that were not written by it are joined here)
    if "qt_veiculos_reserva" not in f.columns:
        f = with_requested(f, dw["fato_reserva"])
    # aggregate on the surrogate keys first: the customer dimension (too large to
    # broadcast at scale) then meets one row per (group, customer, source)
    pre = f.groupBy("sk_grupo", "sk_cliente", "id_sistema_origem").agg(
        F.count(F.lit(1)).alias("n"), F.sum("qt_veiculos_reserva").alias("qt"), F.sum("valor_total").alias("total"),
        F.sum("valor_diaria").alias("rate"), F.count("valor_diaria").alias("n_rate"),
        F.sum("dias_locacao").alias("days"), F.count("dias_locacao").alias("n_days"),
        F.min("dias_locacao").alias("min_d"), F.max("dias_locacao").alias("max_d"))
    g = _dim(dw, counts, "dim_grupo", _c("sk_grupo"), _c("nome_grupo"), _c("mecanizacao"), _c("classe_luxo"))
    c = _dim(dw, counts, "dim_cliente", _c("sk_cliente"), _c("cidade_origem"), _c("estado_origem"),
             _c("tipo_cliente"))
    j = pre.join(g, "sk_grupo").join(c, "sk_cliente")
    keys = ["nome_grupo", "mecanizacao", "classe_luxo", "cidade_origem", "estado_origem", "tipo_cliente",
            "id_sistema_origem"]
    agg = j.groupBy(*keys).agg(
        F.sum("n").alias("qt_locacoes"),
        F.sum("qt").cast("long").alias("qt_veiculos_solicitados"),
        F.sum("total").cast("decimal(38,2)").alias("valor_total_periodo"),
        F.sum("rate").alias("_sum_rate"), F.sum("n_rate").alias("_n_rate"),
        F.sum("days").alias("_sum_days"), F.sum("n_days").alias("_n_days"),
        F.min("min_d").alias("min_dias_locacao"), F.max("max_d").alias("max_dias_locacao"))
    rank = F.rank().over(Window.partitionBy("id_sistema_origem").orderBy(_c("qt_locacoes").desc()))
    fill = lambda col: F.coalesce(_c(col), F.lit(NOT_INFORMED))
    out = agg.select(
        rank.cast("int").alias("ranking_grupo"), "nome_grupo", fill("mecanizacao").alias("mecanizacao"),
        fill("classe_luxo").alias("classe_luxo"), fill("cidade_origem").alias("cidade_cliente"),
        fill("estado_origem").alias("estado_cliente"), "tipo_cliente",
        _c("id_sistema_origem").alias("sistema_origem"), "qt_locacoes", "qt_veiculos_solicitados",
        "valor_total_periodo",
        avg_round(_c("_sum_rate") * 100, _c("_n_rate"), 2, in_scale=2).alias("media_valor_diaria"),
        avg_round(_c("_sum_days"), _c("_n_days"), 1).alias("media_dias_locacao"),
        "min_dias_locacao", "max_dias_locacao", _c("estado_origem").alias("_st"), _c("cidade_origem").alias("_ci"))
    out = out.orderBy(_c("sistema_origem").asc_nulls_last(), _c("ranking_grupo").asc_nulls_last(),
                      _c("nome_grupo").asc_nulls_last(), _c("_st").asc_nulls_last(), _c("_ci").asc_nulls_last())
    return out.drop("_st", "_ci")
