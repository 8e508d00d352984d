"""Data-quality rules Q1-Q10: the declared constraints of the sources and the
star store, re-aimed as validation jobs that return ``(rule, n_violations)``.

All row-level rules on one table fold into a single aggregation pass
(``sum(when(bad, 1))``); the keys of a table are counted in one pass as (rule, key)
pairs; references are ``left_anti`` joins (NULL references allowed). Constraints on columns
that only the sources' own schemas declare are in ``plans/declared.py``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetdw.operators.insert_ignore import repeated_hashes
from fleetdw.schemas import AS_OF, DW_WIDTHS, SYS_A, SYS_B, SYS_C, SYS_D

SYS = "id_sistema_origem"
#: Repeated hashes up to which they are broadcast.
SUSPECTS = 1_000_000


def _c(n: str) -> Column:
    return F.col(n)


def rule_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One pass over ``df``: violations per rule (a rule column is TRUE when violated)."""
    aggs = [F.sum(F.when(bad, 1).otherwise(0)).alias(f"r{i}") for i, bad in enumerate(rules.values())]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(name).alias("rule"), F.coalesce(_c(f"r{i}"), F.lit(0)).cast("long").alias("n_violations"))
            for i, name in enumerate(rules)]
    return wide.select(F.inline(F.array(*rows)))


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


NOT_NULL = {
    "std_patio": ["id_patio_origem", "nome_patio"],
    "std_cliente": ["id_cliente_origem", "nome_cliente", "tipo_cliente"],
    "std_veiculo": ["id_veiculo_origem", "placa", "modelo"],
    "std_reserva": ["id_reserva_origem", "id_cliente_origem", "dt_retirada_prevista", "status"],
    "std_locacao": ["id_locacao_origem", "id_cliente_origem", "id_veiculo_origem",
                    "id_patio_retirada_origem", "dt_retirada"],
    "std_movimentacao": ["id_movimentacao_origem", "id_veiculo_origem", "id_patio_origem_origem",
                         "dt_saida_origem"],
}


# declared NOT NULL columns of the loaded tables
DW_NOT_NULL = {
    "dim_tempo": ["sk_tempo", "dt_ref", "dia", "mes", "ano"],
    "dim_patio": ["sk_patio", "id_patio_origem", "nome_patio", SYS],
    "dim_cliente": ["sk_cliente", "id_cliente_origem", "nome_cliente", "tipo_cliente", SYS],
    "dim_grupo": ["sk_grupo", "nome_grupo", SYS],
    "dim_veiculo": ["sk_veiculo", "id_veiculo_origem", "placa", SYS],
    "fato_locacao": ["sk_locacao", "sk_cliente", "sk_veiculo", "sk_grupo", "sk_patio_retirada", "sk_tempo_retirada",
                     "valor_diaria", SYS],
    "fato_reserva": ["sk_reserva", "sk_cliente", "sk_tempo_retirada_prevista", SYS],
    "fato_movimentacao_patio": ["sk_movimentacao", "sk_veiculo", "sk_patio_origem", SYS],
}


def dq_not_null(std: dict[str, DataFrame], dw: dict[str, DataFrame]) -> DataFrame:  # Q1
    return _union([rule_counts(tables[t], {f"{t}.{c}": _c(c).isNull() for c in cols})
                   for tables, rules in ((std, NOT_NULL), (dw, DW_NOT_NULL)) for t, cols in rules.items()])


# Reservation status domain of each source.
RESERVATION_STATUS = {
    SYS_A: ["Confirmada", "Cancelada", "Atendida"],
    SYS_B: ["ativa", "confirmada", "cancelada", "espera"],
    SYS_C: ["CONFIRMADA", "EM_FILA_ESPERA", "CANCELADA", "CONCRETIZADA"],
    SYS_D: ["ATIVA", "CANCELADA", "CONVERTIDA"],
}
GEARBOX = ["MANUAL", "AUTOMATICO"]
# The 27 Brazilian federative units accepted by source A's address table.
UF = ["AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO", "MA", "MT", "MS", "MG", "PA", "PB", "PR", "PE", "PI",
      "RJ", "RN", "RS", "RO", "RR", "SC", "SP", "SE", "TO"]


def _outside(c: Column, lo: int, hi: int | None = None) -> Column:
    return (c < lo) if hi is None else ~c.between(lo, hi)


def dq_domain(std: dict[str, DataFrame], dim_tempo: DataFrame,
              sources: dict[str, dict[str, DataFrame]] | None = None) -> DataFrame:  # Q2
    """Enum and range rules: on the conformed tables, on the calendar, and - when
    ``sources`` is given - on the source columns the extracts read."""
    status_ok = reduce(lambda a, b: a | b, [(_c(SYS) == s) & _c("status").isin(*v)
                                            for s, v in RESERVATION_STATUS.items()])
    parts = [
        rule_counts(std["std_cliente"], {
            "std_cliente.tipo_cliente": ~_c("tipo_cliente").isin("PF", "PJ"),
            "std_cliente.estado_origem_len": F.length("estado_origem") != 2}),
        rule_counts(std["std_grupo"], {"std_grupo.mecanizacao": ~_c("mecanizacao").isin(*GEARBOX)}),
        rule_counts(std["std_veiculo"], {"std_veiculo.mecanizacao": ~_c("mecanizacao").isin(*GEARBOX)}),
        rule_counts(std["std_reserva"], {
            "std_reserva.status": ~status_ok,
            "std_reserva.qt_veiculos_solicitados": _c("qt_veiculos_solicitados") <= 0}),
        rule_counts(std["std_locacao"], {
            "std_locacao.valor_diaria": _c("valor_diaria") < 0,
            "std_locacao.valor_total": _c("valor_total") < 0}),
        rule_counts(dim_tempo, {
            "dim_tempo.dia": _outside(_c("dia"), 1, 31), "dim_tempo.mes": _outside(_c("mes"), 1, 12),
            "dim_tempo.trimestre": _outside(_c("trimestre"), 1, 4),
            "dim_tempo.semestre": _outside(_c("semestre"), 1, 2), "dim_tempo.ano": _outside(_c("ano"), 1900),
            "dim_tempo.dia_semana": _outside(_c("dia_semana"), 1, 7),
            "dim_tempo.semana_ano": _outside(_c("semana_ano"), 1, 53)}),
    ]
    if sources is not None:
        a, c, d = sources["A"], sources["C"], sources["D"]
        parts += [
            rule_counts(a["endereco"], {f"{SYS_A}.endereco.uf": ~_c("uf").isin(*UF)}),
            rule_counts(a["veiculo"], {f"{SYS_A}.veiculo.ano": _c("ano") < 1900}),
            rule_counts(a["reserva"], {f"{SYS_A}.reserva.qtveiculossolicitados": _c("qtveiculossolicitados") < 1}),
            rule_counts(a["locacao"], {f"{SYS_A}.locacao.valordiaria": _c("valordiaria") <= 0}),
            rule_counts(c["locacao"], {
                f"{SYS_C}.locacao.valor_diaria_aplicada": _c("valor_diaria_aplicada") < 0,
                f"{SYS_C}.locacao.status": ~_c("status").isin("EM_ANDAMENTO", "CONCLUIDA", "CANCELADA")}),
            rule_counts(d["locacao"], {f"{SYS_D}.locacao.valor_previsto": _c("valor_previsto") <= 0,
                                       f"{SYS_D}.locacao.valor_final": _c("valor_final") < 0}),
        ]
    return _union(parts)


UNIQUE = {
    "std_patio": [SYS, "id_patio_origem"],
    "std_cliente": [SYS, "id_cliente_origem"],
    "std_grupo": [SYS, "nome_grupo"],
    "std_veiculo": [SYS, "id_veiculo_origem"],
    "std_veiculo.placa": ["placa"],
    "std_reserva": [SYS, "id_reserva_origem"],
    "std_locacao": [SYS, "id_locacao_origem"],
    "std_movimentacao": [SYS, "id_movimentacao_origem"],
}


def duplicated_keys(df: DataFrame, keys: Sequence[str], rule: str) -> DataFrame:
    """Number of key values held by more than one row (NULL keys ignored)."""
    not_null = reduce(lambda a, b: a & b, [_c(k).isNotNull() for k in keys])
    per_key = df.where(not_null).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum(F.when(_c("n") > 1, 1).otherwise(0)).alias("v")).select(
        F.lit(rule).alias("rule"), F.coalesce(_c("v"), F.lit(0)).cast("long").alias("n_violations"))


def repeated_values(tables: Sequence[tuple[DataFrame, dict[str, Sequence[str]]]]) -> DataFrame:
    """Key values that more than one row has, per rule: (rule, n_violations). ``tables``: frames
    with their rules, each the columns of a key (NULL keys ignored).

    A row gives one (rule, key) pair per rule, so a table is read once for all its keys. Pairs are
    counted by a 64-bit hash of the key first, before anything moves, so a task holds and
    sends a few bytes a key and a hot key is one row; only pairs whose hash repeats are counted
    by the key itself."""
    names, parts = [], []
    for df, rules in tables:
        pairs = []
        for name, keys in rules.items():
            key = [_c(k).cast("string") for k in keys]
            whole = reduce(lambda a, b: a & b, [k.isNotNull() for k in key])
            pairs.append(F.when(whole, F.struct(F.lit(len(names)).alias("rule_no"), F.array(*key).alias("k"))))
            names.append(name)
        parts.append(df.select(F.explode(F.array(*pairs)).alias("p")).where(_c("p").isNotNull()).select("p.*"))
    pairs = _union(parts).withColumn("h", F.xxhash64("k"))
    suspect, n = repeated_hashes(pairs, ["rule_no", "h"])
    if n <= SUSPECTS:  # else nearly all pairs would be looked up
        pairs = pairs.join(F.broadcast(suspect), ["rule_no", "h"], "left_semi")
    counted = pairs.groupBy("rule_no", "k").agg(F.count(F.lit(1)).alias("n"))
    bad = counted.where(_c("n") > 1).groupBy("rule_no").agg(F.count(F.lit(1)).alias("n"))
    return _by_rule(tables[0][0], names, bad)


def _by_rule(some: DataFrame, names: Sequence[str], bad: DataFrame) -> DataFrame:
    """(rule, n_violations) of all rules from (rule_no, n) of those that are violated."""
    rows = F.array(*[F.struct(F.lit(i).alias("rule_no"), F.lit(name).alias("rule")) for i, name in enumerate(names)])
    return (some.sparkSession.range(1).select(F.inline(rows)).join(F.broadcast(bad), "rule_no", "left")  # a row per rule
            .select("rule", F.coalesce("n", F.lit(0)).cast("long").alias("n_violations")))


# natural keys of the loaded tables
DW_UNIQUE = {
    "dim_patio": [SYS, "id_patio_origem"], "dim_cliente": [SYS, "id_cliente_origem"],
    "dim_grupo": [SYS, "nome_grupo"], "dim_veiculo": ["placa"],
    "fato_locacao": [SYS, "id_locacao_origem"], "fato_reserva": [SYS, "id_reserva_origem"],
    "fato_movimentacao_patio": [SYS, "id_movimentacao_origem"],
}


def dq_unique(std: dict[str, DataFrame], dw: dict[str, DataFrame],
              sources: dict[str, dict[str, DataFrame]]) -> DataFrame:  # Q3
    tables: dict[str, tuple[DataFrame, dict[str, Sequence[str]]]] = {}
    for name, keys in UNIQUE.items():
        table, dot, _ = name.partition(".")
        tables.setdefault(table, (std[table], {}))[1][name if dot else f"{name}.pk"] = keys
    tables["dim_tempo"] = (dw["dim_tempo"], {"dim_tempo.dt_ref": ["dt_ref"]})
    for name, keys in DW_UNIQUE.items():
        tables[name] = (dw[name], {f"{name}.natural_key": keys})
    # chassis of every source that declares it; one rental per reservation
    for p, sys in (("A", SYS_A), ("B", SYS_B), ("C", SYS_C), ("D", SYS_D)):
        tables[f"{sys}.veiculo"] = (sources[p]["veiculo"], {f"{sys}.veiculo.chassi": ["chassi"]})
    tables["rental"] = (sources["C"]["locacao"], {f"{SYS_C}.locacao.reserva_id": ["reserva_id"]})
    return repeated_values(list(tables.values()))


def dq_one_open(std: dict[str, DataFrame], source_c: dict[str, DataFrame]) -> DataFrame:  # Q4
    src = duplicated_keys(source_c["locacao"].where(_c("status") == "EM_ANDAMENTO"), ["veiculo_id"],
                          "derived_moves.locacao.one_open_per_vehicle")
    conf = duplicated_keys(std["std_locacao"].where(_c("status") == "EM_ANDAMENTO"), [SYS, "id_veiculo_origem"],
                           "std_locacao.one_open_per_vehicle")
    return src.unionByName(conf)


FOREIGN_KEYS = [
    ("std_locacao", "id_cliente_origem", "std_cliente", "id_cliente_origem"),
    ("std_locacao", "id_veiculo_origem", "std_veiculo", "id_veiculo_origem"),
    ("std_locacao", "id_patio_retirada_origem", "std_patio", "id_patio_origem"),
    ("std_locacao", "id_patio_devolucao_origem", "std_patio", "id_patio_origem"),
    ("std_locacao", "id_reserva_origem", "std_reserva", "id_reserva_origem"),
    ("std_reserva", "id_cliente_origem", "std_cliente", "id_cliente_origem"),
    ("std_reserva", "id_patio_retirada_origem", "std_patio", "id_patio_origem"),
    ("std_reserva", "id_patio_devolucao_origem", "std_patio", "id_patio_origem"),
    ("std_movimentacao", "id_veiculo_origem", "std_veiculo", "id_veiculo_origem"),
    ("std_movimentacao", "id_patio_origem_origem", "std_patio", "id_patio_origem"),
    ("std_movimentacao", "id_patio_destino_origem", "std_patio", "id_patio_origem"),
]


# (fact, key, dimension, key); a null key refers to nothing
DW_FOREIGN_KEYS = [
    ("fato_locacao", "sk_cliente", "dim_cliente", "sk_cliente"),
    ("fato_locacao", "sk_veiculo", "dim_veiculo", "sk_veiculo"),
    ("fato_locacao", "sk_grupo", "dim_grupo", "sk_grupo"),
    ("fato_locacao", "sk_patio_retirada", "dim_patio", "sk_patio"),
    ("fato_locacao", "sk_patio_devolucao", "dim_patio", "sk_patio"),
    ("fato_locacao", "sk_tempo_retirada", "dim_tempo", "sk_tempo"),
    ("fato_locacao", "sk_tempo_devolucao", "dim_tempo", "sk_tempo"),
    ("fato_locacao", "sk_tempo_devolucao_prevista", "dim_tempo", "sk_tempo"),
    ("fato_reserva", "sk_cliente", "dim_cliente", "sk_cliente"),
    ("fato_reserva", "sk_patio_retirada", "dim_patio", "sk_patio"),
    ("fato_reserva", "sk_patio_devolucao", "dim_patio", "sk_patio"),
    ("fato_reserva", "sk_tempo_retirada_prevista", "dim_tempo", "sk_tempo"),
    ("fato_reserva", "sk_tempo_devolucao_prevista", "dim_tempo", "sk_tempo"),
    ("fato_movimentacao_patio", "sk_veiculo", "dim_veiculo", "sk_veiculo"),
    ("fato_movimentacao_patio", "sk_patio_origem", "dim_patio", "sk_patio"),
    ("fato_movimentacao_patio", "sk_patio_destino", "dim_patio", "sk_patio"),
    ("fato_movimentacao_patio", "sk_tempo", "dim_tempo", "sk_tempo"),
]


def orphans(tables: dict[str, DataFrame], rules: Sequence[tuple[str, str, str, str]], scope: Sequence[str]) -> DataFrame:
    """Violations of all references: one pass over each child and one over each parent.

    A child row gives one (rule, key) per non-null reference, counted per key before
    anything moves, so a hot key is one row; parents give their keys once per rule."""
    kids, parents = [], []
    for child in dict.fromkeys(r[0] for r in rules):
        refs = [F.struct(F.lit(i).alias("rule_no"), *[_c(c).alias(c) for c in scope], _c(col).cast("string").alias("k"))
                for i, (ch, col, _, _) in enumerate(rules) if ch == child]
        kids.append(tables[child].select(F.inline(F.array(*refs))).where(_c("k").isNotNull()))
    for parent in dict.fromkeys(r[2] for r in rules):
        keys = [F.struct(F.lit(i).alias("rule_no"), *[_c(c).alias(c) for c in scope], _c(pcol).cast("string").alias("k"))
                for i, (_, _, pa, pcol) in enumerate(rules) if pa == parent]
        parents.append(tables[parent].select(F.inline(F.array(*keys))))
    by = ["rule_no", *scope, "k"]
    per_key = _union(kids).groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    bad = per_key.join(_union(parents).distinct(), by, "left_anti").groupBy("rule_no").agg(F.sum("n").alias("n"))
    return _by_rule(tables[rules[0][0]], [f"{ch}.{col}->{pa}" for ch, col, pa, _ in rules], bad)


def dq_fk(std: dict[str, DataFrame], dw: dict[str, DataFrame]) -> DataFrame:  # Q5
    return orphans(std, FOREIGN_KEYS, [SYS]).unionByName(orphans(dw, DW_FOREIGN_KEYS, []))


def dq_order(std: dict[str, DataFrame], stg_a_reserva: DataFrame) -> DataFrame:  # Q6
    # C declares strict orders: equal times are violations there
    same = lambda a, b: (_c(SYS) == SYS_C) & (_c(a) == _c(b))
    return _union([
        rule_counts(std["std_locacao"], {
            "std_locacao.devolucao_antes_retirada":
                (_c("dt_devolucao_real") < _c("dt_retirada")) | same("dt_devolucao_real", "dt_retirada"),
            f"{SYS_B}.locacao.devolucao_sem_retirada":
                (_c(SYS) == SYS_B) & _c("dt_devolucao_real").isNotNull() & _c("dt_retirada").isNull()}),
        rule_counts(std["std_reserva"], {
            "std_reserva.retirada_antes_reserva": _c("dt_retirada_prevista") < _c("dt_reserva"),
            "std_reserva.devolucao_antes_retirada":
                (_c("dt_devolucao_prevista") < _c("dt_retirada_prevista"))
                | same("dt_devolucao_prevista", "dt_retirada_prevista")}),
        rule_counts(std["std_movimentacao"], {
            "std_movimentacao.chegada_antes_saida": _c("dt_chegada_destino") < _c("dt_saida_origem")}),
        rule_counts(stg_a_reserva, {
            "bay_level.reserva.limite_antes_retirada": _c("dt_limite_retirada") <= _c("dt_retirada_prevista")}),
    ])


def dq_xor(source_a: dict[str, DataFrame], std: dict[str, DataFrame]) -> DataFrame:  # Q7
    cc = source_a["centrocusto"]
    xor_bad = _c("idfisica").isNull() == _c("idempresa").isNull()
    mov = std["std_movimentacao"]
    same = _c("id_patio_origem_origem") == _c("id_patio_destino_origem")
    return _union([
        rule_counts(cc, {"bay_level.centrocusto.pf_xor_pj": xor_bad}),
        rule_counts(mov, {f"{s}.movimentacao.origem_igual_destino": (_c(SYS) == s) & same
                          for s in (SYS_B, SYS_D)}),
    ])


def dq_time(std: dict[str, DataFrame], as_of: _dt.date = AS_OF) -> DataFrame:  # Q8
    today = F.lit(as_of).cast("date").cast("timestamp_ntz")  # zone-free midnight
    return _union([
        rule_counts(std["std_reserva"], {"std_reserva.reserva_no_futuro": _c("dt_reserva") > today}),
        rule_counts(std["std_locacao"], {"std_locacao.retirada_no_futuro": _c("dt_retirada") > today}),
        rule_counts(std["std_movimentacao"], {"std_movimentacao.saida_no_futuro": _c("dt_saida_origem") > today}),
    ])


WIDTH_SOURCES = {"dim_patio": "std_patio", "dim_cliente": "std_cliente", "dim_grupo": "std_grupo",
                 "dim_veiculo": "std_veiculo"}


def dq_width(std: dict[str, DataFrame]) -> DataFrame:  # Q10
    parts = []
    for dim, widths in DW_WIDTHS.items():
        parts.append(rule_counts(std[WIDTH_SOURCES[dim]],
                                 {f"{dim}.{c}>{n}": F.length(c) > n for c, n in widths.items()}))
    return _union(parts)
