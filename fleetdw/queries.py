"""Registry of runnable queries: name -> fn(spark, sf_dir) -> DataFrame.

ETL-stage queries (``ext_*``) run lazily on the source shapes; everything from
``std_*`` on reads the star store built once per (session, input folder) by
:func:`fleetdw.plans.star.store_for` - the daily ETL writes the star
schema, reports read it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetdw.operators.insert_ignore import dedup_batch, insert_ignore, skipped_by_reason, upsert
from fleetdw.operators.lookup import lookup
from fleetdw.operators.surrogate import assign_surrogate_key
from fleetdw.plans import declared as C
from fleetdw.plans import dims as D
from fleetdw.plans import markov as M
from fleetdw.plans import quality as Q
from fleetdw.plans import reports as R
from fleetdw.plans import source_views as V
from fleetdw.plans.facts import discards
from fleetdw.plans.transform import TRANSFORMS
from fleetdw.plans.star import DIM_ORDER, STAGING_KEYS, input_stamp, store_for
from fleetdw.session import CODEC, fresh_scratch, hadoop_path, release
from fleetdw.sources.adapters import Shapes
from fleetdw.sources.declared_shapes import extended
from fleetdw.sources.extract import ENTITIES, EXTRACTS, a_reserva
from fleetdw.sources.tpch import Tables

Query = Callable[[SparkSession, str], DataFrame]

_SHAPES: dict[tuple[int, str], tuple[Shapes, tuple]] = {}


def _shapes(spark, sf_dir) -> Shapes:
    """Source shapes per (session, input folder) as it is: the supplier count is taken once."""
    key, stamp = (id(spark._jsparkSession), sf_dir.rstrip("/")), input_stamp(spark, sf_dir)
    sh, seen = _SHAPES.get(key, (None, None))
    if sh is None or seen != stamp or sh.spark is not spark:
        sh = Shapes(spark, sf_dir)
        _SHAPES[key] = sh, stamp
    return sh


def _wh(spark, sf_dir):
    wh = store_for(spark, sf_dir)
    return wh, wh.tables()


# ------------------------------------------------------------------ Markov
def markov_long(spark, sf_dir):
    wh, dw = _wh(spark, sf_dir)
    return M.transition_long(dw["fato_movimentacao_patio"], dw["dim_patio"], wh.counts.get("dim_patio"))


def markov_counts(spark, sf_dir):
    wh, dw = _wh(spark, sf_dir)
    return M.transition_counts(dw["fato_movimentacao_patio"], dw["dim_patio"], wh.counts.get("dim_patio"))


def markov_matrix(spark, sf_dir):
    wh, dw = _wh(spark, sf_dir)
    names = [r[0] for r in M.yard_columns(dw["dim_patio"]).collect()]  # the result's columns (M4)
    return M.transition_matrix(dw["fato_movimentacao_patio"], dw["dim_patio"], names, wh.counts.get("dim_patio"))


def markov_columns(spark, sf_dir):
    _, dw = _wh(spark, sf_dir)
    return M.yard_columns(dw["dim_patio"])


# ------------------------------------------------------------------ extract / transform
def _extract_query(letter: str, entity: str) -> Query:
    def q(spark, sf_dir):
        src = getattr(_shapes(spark, sf_dir), f"source_{letter.lower()}")()
        return EXTRACTS[letter][entity](src)
    q.__name__ = f"ext_{letter.lower()}_{entity}"
    return q


def _std_query(name: str) -> Query:
    def q(spark, sf_dir):
        return store_for(spark, sf_dir).table(name)
    q.__name__ = name
    return q


# ------------------------------------------------------------------ load
def dim_tempo(spark, sf_dir):
    return store_for(spark, sf_dir).table("dim_tempo")


def date_bounds(spark, sf_dir):
    return D.date_bounds(store_for(spark, sf_dir).std())


def _dim_query(name: str) -> Query:
    def q(spark, sf_dir):
        return store_for(spark, sf_dir).table(name).select(*D.DIM_COLUMNS[name])
    q.__name__ = name
    return q


def _natural(dw: dict[str, DataFrame], counts, fact: str) -> DataFrame:
    """Fact rows with each surrogate key replaced by the natural key it points to."""
    f = dw[fact]
    n = counts or {}
    if "sk_cliente" in f.columns:
        f = lookup(f, dw["dim_cliente"], [("sk_cliente", "sk_cliente")], {"id_cliente_origem": "id_cliente_origem"},
                   n_rows=n.get("dim_cliente"))
    if "sk_veiculo" in f.columns:
        f = lookup(f, dw["dim_veiculo"], [("sk_veiculo", "sk_veiculo")], {"placa": "placa"},
                   n_rows=n.get("dim_veiculo"))
    if "sk_grupo" in f.columns:
        f = lookup(f, dw["dim_grupo"], [("sk_grupo", "sk_grupo")], {"nome_grupo": "nome_grupo"},
                   n_rows=n.get("dim_grupo"))
    roles = {"sk_patio_retirada": "id_patio_retirada_origem", "sk_patio_devolucao": "id_patio_devolucao_origem",
             "sk_patio_origem": "id_patio_origem_origem", "sk_patio_destino": "id_patio_destino_origem"}
    for sk, out in roles.items():
        if sk in f.columns:
            f = lookup(f, dw["dim_patio"], [(sk, "sk_patio")], {"id_patio_origem": out}, n_rows=n.get("dim_patio"))
    return f


FACT_OUT = {
    "fato_locacao": ["id_locacao_origem", "id_cliente_origem", "placa", "nome_grupo", "id_patio_retirada_origem",
                     "id_patio_devolucao_origem", "sk_tempo_retirada", "sk_tempo_devolucao",
                     "sk_tempo_devolucao_prevista", "valor_diaria", "dias_locacao", "km_rodados", "valor_total",
                     "status", "id_reserva_origem", "id_sistema_origem"],
    "fato_reserva": ["id_reserva_origem", "id_cliente_origem", "nome_grupo", "id_patio_retirada_origem",
                     "id_patio_devolucao_origem", "sk_tempo_reserva", "sk_tempo_retirada_prevista",
                     "sk_tempo_devolucao_prevista", "antecedencia_dias", "qt_veiculos_solicitados", "status",
                     "id_sistema_origem"],
    "fato_movimentacao_patio": ["id_movimentacao_origem", "placa", "id_patio_origem_origem",
                                "id_patio_destino_origem", "sk_tempo", "motivo", "quantidade_veiculos",
                                "id_sistema_origem"],
}


def _fact_query(name: str) -> Query:
    def q(spark, sf_dir):
        wh, dw = _wh(spark, sf_dir)
        return _natural(dw, wh.counts, name).select(*FACT_OUT[name])
    q.__name__ = name
    return q


def _staging_query(entity: str) -> Query:
    """An entity's staging table after a batch of all four extracts, all their columns: keys of even
    length are staged already (``lote`` 0, the last version of each) and stay as they are;
    of the batch, which holds every row twice, the first version of each new key is added.

    The source is part of the key, so one source is staged after the other, from its extract written
    once: on disk there are the shuffles of one at a time."""
    def q(spark, sf_dir):
        src = _shapes(spark, sf_dir).all_sources()
        key = STAGING_KEYS[entity]
        frames = {p: EXTRACTS[p][entity](src[p]) for p in "ABCD"}
        columns = list(dict.fromkeys(c for f in frames.values() for c in f.columns))
        tie = sorted(c for c in columns if c not in (key, "id_sistema_origem"))

        def staging_of(p: str) -> DataFrame:
            rows = frames[p].select(*[(F.col(c) if c in frames[p].columns else F.lit(None)).cast("string").alias(c)
                                      for c in columns])
            extract = fresh_scratch(spark, f"extract-{p.lower()}-{entity}")
            rows.write.parquet(extract, compression=CODEC)
            rows = spark.read.schema(rows.schema).parquet(extract)
            release(spark, extract)
            staged = dedup_batch(rows.where(F.length(key) % 2 == 0), ["id_sistema_origem", key], tie, keep="last", probe=rows)
            staged = staged.withColumn("lote", F.lit(0))
            batch = rows.withColumn("lote", F.lit(1)).unionByName(rows.withColumn("lote", F.lit(2)))
            out = staged.unionByName(insert_ignore(staged, batch, ["id_sistema_origem", key], ["lote", *tie]))
            path, schema = fresh_scratch(spark, f"staged-{p.lower()}-{entity}"), out.schema
            out.write.parquet(path, compression=CODEC)
            del rows, staged, batch, out
            release(spark, path)
            fs, at = hadoop_path(spark, extract)
            fs.delete(at, True)
            return spark.read.schema(schema).parquet(path)
        return reduce(lambda a, b: a.unionByName(b), [staging_of(p) for p in "ABCD"])
    q.__name__ = f"stg_{entity}"
    return q


# ------------------------------------------------------------------ insert-ignore / keys on lineitem
LI_KEYS = ["l_orderkey", "l_linenumber"]
LI_TIE = ["l_partkey", "l_suppkey", "l_shipdate"]


def _li_batch_target(spark, sf_dir):
    batch = Tables(spark, sf_dir).lineitem.select(*LI_KEYS, *LI_TIE, "l_quantity")
    # pre-existing table: even order keys, holding the *last* version of each key
    target = dedup_batch(batch.where(F.col("l_orderkey") % 2 == 0), LI_KEYS, LI_TIE, keep="last")
    return batch, target


def insert_ignore_new(spark, sf_dir):
    batch, target = _li_batch_target(spark, sf_dir)
    return insert_ignore(target, batch, LI_KEYS, LI_TIE)


def insert_ignore_dupes(spark, sf_dir):
    batch, target = _li_batch_target(spark, sf_dir)
    return skipped_by_reason(target, batch, LI_KEYS, LI_TIE)


def upsert_latest(spark, sf_dir):
    batch, target = _li_batch_target(spark, sf_dir)
    # of the target's even order keys, every second one is not in the batch and must stay
    return upsert(target, batch.where(F.col("l_orderkey") % 4 != 2), LI_KEYS, LI_TIE)


def surrogate_keys(spark, sf_dir):
    std = store_for(spark, sf_dir).table("std_locacao").select("id_sistema_origem", "id_locacao_origem")
    return assign_surrogate_key(std, ["id_sistema_origem", "id_locacao_origem"], "sk_locacao")


# ------------------------------------------------------------------ reports
def fleet_by_group(spark, sf_dir):
    wh, dw = _wh(spark, sf_dir)
    return R.fleet_by_group(dw, wh.counts)


def open_rentals(spark, sf_dir):
    wh, dw = _wh(spark, sf_dir)
    return R.open_rentals(dw, wh.counts)


def reservation_demand(spark, sf_dir):
    wh, dw = _wh(spark, sf_dir)
    return R.reservation_demand(dw, wh.counts)


def top_groups(spark, sf_dir):
    wh, dw = _wh(spark, sf_dir)
    return R.top_groups(dw, wh.counts)


def top_groups_completed(spark, sf_dir):
    wh, dw = _wh(spark, sf_dir)
    return R.top_groups(dw, wh.counts, completed_only=True)


# ------------------------------------------------------------------ source C views
def _view(fn) -> Query:
    def q(spark, sf_dir):
        return fn(_shapes(spark, sf_dir).source_c())
    q.__name__ = fn.__name__
    return q


# ------------------------------------------------------------------ data quality
def dq_not_null(spark, sf_dir):
    wh, dw = _wh(spark, sf_dir)
    return Q.dq_not_null(wh.std(), dw)


def dq_domain(spark, sf_dir):
    wh = store_for(spark, sf_dir)
    return Q.dq_domain(wh.std(), wh.table("dim_tempo"), _shapes(spark, sf_dir).all_sources())


def dq_unique(spark, sf_dir):
    wh, dw = _wh(spark, sf_dir)
    return Q.dq_unique(wh.std(), dw, _shapes(spark, sf_dir).all_sources())


def dq_one_open(spark, sf_dir):
    return Q.dq_one_open(store_for(spark, sf_dir).std(), _shapes(spark, sf_dir).source_c())


def dq_fk(spark, sf_dir):
    wh, dw = _wh(spark, sf_dir)
    return Q.dq_fk(wh.std(), dw)


def dq_order(spark, sf_dir):
    return Q.dq_order(store_for(spark, sf_dir).std(), a_reserva(_shapes(spark, sf_dir).source_a()))


def dq_xor(spark, sf_dir):
    return Q.dq_xor(_shapes(spark, sf_dir).source_a(), store_for(spark, sf_dir).std())


def dq_time(spark, sf_dir):
    return Q.dq_time(store_for(spark, sf_dir).std())


def dq_discards(spark, sf_dir):
    wh = store_for(spark, sf_dir)
    return discards(wh.std(), wh.dims())


def dq_width(spark, sf_dir):
    return Q.dq_width(store_for(spark, sf_dir).std())


def _declared_query(fn) -> Query:
    def q(spark, sf_dir):
        return fn(extended(_shapes(spark, sf_dir).all_sources()))
    q.__name__ = fn.__name__
    return q


def registry() -> dict[str, Query]:
    q: dict[str, Query] = {
        "markov_long": markov_long, "markov_counts": markov_counts,
        "markov_matrix": markov_matrix, "markov_columns": markov_columns,
    }
    for letter in "ABCD":
        for entity in ENTITIES:
            q[f"ext_{letter.lower()}_{entity}"] = _extract_query(letter, entity)
    for entity in ENTITIES:
        q[f"stg_{entity}"] = _staging_query(entity)
    for name in TRANSFORMS:
        q[name] = _std_query(name)
    q["dim_tempo"] = dim_tempo
    q["date_bounds"] = date_bounds
    for name in DIM_ORDER:
        q[name] = _dim_query(name)
    for name in FACT_OUT:
        q[name] = _fact_query(name)
    q.update(insert_ignore_new=insert_ignore_new, insert_ignore_dupes=insert_ignore_dupes,
             upsert_latest=upsert_latest, surrogate_keys=surrogate_keys)
    q.update(fleet_by_group=fleet_by_group, open_rentals=open_rentals, reservation_demand=reservation_demand,
             top_groups=top_groups, top_groups_completed=top_groups_completed)
    q.update(src_available=_view(V.available_by_yard_group), src_in_progress=_view(V.rentals_in_progress),
             src_reservations=_view(V.reservations_by_group_yard_city),
             src_city_groups=_view(V.rentals_by_city_group), src_yard_pairs=_view(V.completed_by_yard_pair))
    q.update(dq_not_null=dq_not_null, dq_domain=dq_domain, dq_unique=dq_unique, dq_one_open=dq_one_open,
             dq_fk=dq_fk, dq_order=dq_order, dq_xor=dq_xor, dq_time=dq_time, dq_discards=dq_discards,
             dq_width=dq_width)
    q.update({fn.__name__: _declared_query(fn) for fn in (C.dq_source_checks, C.dq_source_unique, C.dq_source_fk)})
    return q
