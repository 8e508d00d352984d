"""Final SELECT of every oracle query (see :mod:`fleetdw.checks.oracle` for the CTEs)."""

from __future__ import annotations

from fleetdw.checks.oracle import AS_OF, AS_OF_TS, CTE, build, kdate, pct
from fleetdw.checks.oracle_declared import FINAL as DECLARED

V = "VARCHAR"
FINAL: dict[str, str] = {}

# ---------------------------------------------------------------- Markov
FINAL["markov_counts"] = ("SELECT patio_origem, patio_destino, qtd AS total_movimentacoes FROM pair_named")
FINAL["markov_long"] = (f"SELECT patio_origem, patio_destino, qtd AS movimentacoes, total AS total_saidas_origem, "
                        f"{pct('qtd', 'total')} AS pct_transicao FROM pair_named")


def _matrix(yards: list[str]) -> str:
    """One column per yard: SQL needs their names (M4) when it is written."""
    return ("SELECT patio_origem, "
            + ", ".join(pct(f"SUM(qtd) FILTER (WHERE patio_destino = '{y}')", "SUM(qtd)") + f' AS "{y}"' for y in yards)
            + ", CAST(SUM(qtd) AS BIGINT) AS total_saidas_origem FROM pair_named GROUP BY s, o, patio_origem")


FINAL["markov_columns"] = "SELECT DISTINCT nome_patio FROM dim_patio_o"

# ---------------------------------------------------------------- extract / transform
for _p in "abcd":
    for _e in ("patio", "cliente", "veiculo", "reserva", "locacao", "movimentacao"):
        FINAL[f"ext_{_p}_{_e}"] = f"SELECT * FROM stg_{_p}_{_e}"
# staging: keys of even length are there already, in their last version; every row comes twice,
# the first version of a new key is added; keys may repeat within a source too
_STAGED = {
    "patio": ["nome_patio", "cidade", "localizacao"],
    "cliente": ["tipo_cliente", "nome_cliente", "cidade_origem", "estado_origem"],
    "veiculo": ["placa", "chassi", "marca", "modelo", "ano", "cor", "ar_condicionado", "nome_grupo", "mecanizacao"],
    "reserva": ["id_cliente_origem", "id_grupo_origem", "id_patio_retirada_origem", "id_patio_devolucao_origem", "dt_reserva",
                "dt_retirada_prevista", "dt_limite_retirada", "dt_devolucao_prevista", "qt_veiculos_solicitados", "status"],
    "locacao": ["id_reserva_origem", "id_cliente_origem", "id_veiculo_origem", "id_patio_retirada_origem",
                "id_patio_devolucao_origem", "dt_retirada", "dt_devolucao_real", "valor_diaria", "valor_total",
                "valor_previsto", "valor_final"],
    "movimentacao": ["id_veiculo_origem", "id_patio_origem_origem", "id_patio_destino_origem", "dt_saida_origem",
                     "dt_chegada_destino", "motivo"],
}
for _e, _cols in _STAGED.items():
    _key = f"id_{_e}_origem"
    _all = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in ["id_sistema_origem", _key, *_cols])
    _rows = " UNION ALL BY NAME ".join(f"SELECT * FROM stg_{p}_{_e}" for p in "abcd")
    _out = ", ".join(["id_sistema_origem", _key, *_cols])
    _up = ", ".join(f"{c} ASC NULLS LAST" for c in sorted(_cols))
    _down = ", ".join(f"{c} DESC NULLS FIRST" for c in sorted(_cols))
    FINAL[f"stg_{_e}"] = (
        f"SELECT {_out}, CASE WHEN there THEN 0 ELSE 1 END AS lote FROM (SELECT *, length({_key}) % 2 = 0 AS there, "
        f"row_number() OVER (PARTITION BY id_sistema_origem, {_key} ORDER BY {_up}) AS lowest, "
        f"row_number() OVER (PARTITION BY id_sistema_origem, {_key} ORDER BY {_down}) AS highest "
        f"FROM (SELECT {_all} FROM ({_rows}))) WHERE CASE WHEN there THEN highest = 1 ELSE lowest = 1 END")
for _t in ("patio", "cliente", "grupo", "veiculo", "reserva", "locacao", "movimentacao"):
    FINAL[f"std_{_t}"] = f"SELECT * FROM std_{_t}"

# ---------------------------------------------------------------- load
FINAL["dim_tempo"] = "SELECT * FROM dim_tempo_o"
FINAL["date_bounds"] = "SELECT dt_ini, dt_fim FROM bounds"
FINAL["dim_grupo"] = ("SELECT id_grupo_origem, nome_grupo, mecanizacao, classe_luxo, valor_diaria_base, "
                      "id_sistema_origem FROM dim_grupo_o")
FINAL["dim_patio"] = "SELECT id_patio_origem, nome_patio, cidade, localizacao, id_sistema_origem FROM dim_patio_o"
FINAL["dim_cliente"] = ("SELECT id_cliente_origem, nome_cliente, tipo_cliente, cidade_origem, estado_origem, "
                        "id_sistema_origem FROM dim_cliente_o")
FINAL["dim_veiculo"] = "SELECT * FROM dim_veiculo_o"
FINAL["fato_locacao"] = "SELECT * FROM fato_locacao_o"
FINAL["fato_reserva"] = "SELECT * FROM fato_reserva_o"
FINAL["fato_movimentacao_patio"] = "SELECT * FROM fato_mov_o"

# ---------------------------------------------------------------- insert-ignore on lineitem
CTE["li_batch"] = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity FROM lineitem"
CTE["li_target"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT b.*, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                 ORDER BY l_partkey DESC NULLS FIRST, l_suppkey DESC NULLS FIRST,
                                          l_shipdate DESC NULLS FIRST) AS rn
  FROM li_batch b WHERE l_orderkey % 2 = 0) WHERE rn = 1"""
CTE["li_first"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT b.*, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                 ORDER BY l_partkey ASC NULLS LAST, l_suppkey ASC NULLS LAST,
                                          l_shipdate ASC NULLS LAST) AS rn
  FROM li_batch b) WHERE rn = 1"""
FINAL["insert_ignore_new"] = """
SELECT f.* FROM li_first f
WHERE NOT EXISTS (SELECT 1 FROM li_target t WHERE t.l_orderkey = f.l_orderkey AND t.l_linenumber = f.l_linenumber)"""
FINAL["insert_ignore_dupes"] = """
SELECT 'conflict_existing' AS reason,
       CAST(COUNT(*) FILTER (WHERE EXISTS (SELECT 1 FROM li_target t WHERE t.l_orderkey = b.l_orderkey
                                             AND t.l_linenumber = b.l_linenumber)) AS BIGINT) AS n_rows
FROM li_batch b
UNION ALL
SELECT 'duplicate_in_batch', CAST(COUNT(*) - (SELECT COUNT(*) FROM li_first f WHERE NOT EXISTS (
         SELECT 1 FROM li_target t WHERE t.l_orderkey = f.l_orderkey AND t.l_linenumber = f.l_linenumber))
       - COUNT(*) FILTER (WHERE EXISTS (SELECT 1 FROM li_target t WHERE t.l_orderkey = b.l_orderkey
                                        AND t.l_linenumber = b.l_linenumber)) AS BIGINT)
FROM li_batch b"""
FINAL["upsert_latest"] = """
SELECT * FROM li_first WHERE l_orderkey % 4 <> 2
UNION ALL
SELECT * FROM li_target WHERE l_orderkey % 4 = 2"""
FINAL["surrogate_keys"] = """
SELECT id_sistema_origem, id_locacao_origem,
       CAST(row_number() OVER (ORDER BY id_sistema_origem, id_locacao_origem) AS BIGINT) AS sk_locacao
FROM std_locacao"""

# ---------------------------------------------------------------- reports
FINAL["fleet_by_group"] = """
SELECT v.marca, v.modelo, g.nome_grupo, g.mecanizacao, v.id_sistema_origem AS sistema_origem,
       COUNT(DISTINCT v.placa) AS qt_veiculos
FROM fato_locacao_o f
JOIN dim_veiculo_o v ON v.placa = f.placa
JOIN dim_grupo_o g ON g.id_sistema_origem = f.id_sistema_origem AND g.nome_grupo = f.nome_grupo
WHERE v.id_sistema_origem = g.id_sistema_origem
GROUP BY ALL"""
FINAL["open_rentals"] = f"""
SELECT g.nome_grupo, g.mecanizacao, v.placa, v.marca, v.modelo, c.nome_cliente, f.id_sistema_origem AS sistema_origem,
       {kdate('f.sk_tempo_retirada')} AS dt_retirada, {kdate('f.sk_tempo_devolucao_prevista')} AS dt_devolucao_prevista,
       f.dias_locacao AS dias_contratados,
       CASE WHEN f.sk_tempo_devolucao_prevista = 99991231 THEN NULL
            ELSE CAST({kdate('f.sk_tempo_devolucao_prevista')} - {AS_OF} AS INTEGER) END AS dias_restantes_devolucao,
       CASE WHEN f.sk_tempo_devolucao_prevista = 99991231 THEN NULL
            ELSE {kdate('f.sk_tempo_devolucao_prevista')} < {AS_OF} END AS em_atraso,
       f.valor_diaria, f.valor_total, f.status
FROM fato_locacao_o f
JOIN dim_grupo_o g ON g.id_sistema_origem = f.id_sistema_origem AND g.nome_grupo = f.nome_grupo
JOIN dim_veiculo_o v ON v.placa = f.placa
JOIN dim_cliente_o c ON c.id_sistema_origem = f.id_sistema_origem AND c.id_cliente_origem = f.id_cliente_origem
WHERE f.sk_tempo_devolucao IS NULL"""
CTE["res_enriched"] = f"""
SELECT r.*, c.cidade_origem, c.tipo_cliente, p.nome_patio, p.cidade AS cidade_patio_raw,
       {kdate('r.sk_tempo_retirada_prevista')} AS dt_ret, {kdate('r.sk_tempo_devolucao_prevista')} AS dt_dev
FROM fato_reserva_o r
JOIN dim_cliente_o c ON c.id_sistema_origem = r.id_sistema_origem AND c.id_cliente_origem = r.id_cliente_origem
LEFT JOIN dim_patio_o p ON p.id_sistema_origem = r.id_sistema_origem AND p.id_patio_origem = r.id_patio_retirada_origem"""
CTE["res_bucketed"] = f"""
SELECT *,
  CASE WHEN dt_ret <= {AS_OF} + 7 THEN 'Esta Semana' WHEN dt_ret <= {AS_OF} + 14 THEN 'Próxima Semana'
       WHEN dt_ret <= {AS_OF} + 30 THEN 'Este Mês' WHEN dt_ret <= {AS_OF} + 90 THEN 'Próximos 3M'
       ELSE 'Mais de 3M' END AS horizonte_retirada,
  CASE WHEN dt_dev IS NULL THEN '(não informado)' WHEN dt_dev - dt_ret <= 3 THEN 'Até 3 dias'
       WHEN dt_dev - dt_ret <= 7 THEN '4 a 7 dias' WHEN dt_dev - dt_ret <= 15 THEN '8 a 15 dias'
       ELSE 'Mais de 15 dias' END AS faixa_duracao
FROM res_enriched
WHERE dt_ret > {AS_OF} AND lower(status) NOT IN ('cancelada', 'cancelado')"""
FINAL["reservation_demand"] = """
SELECT coalesce(nome_grupo, '(não informado)') AS nome_grupo, '(não informado)' AS mecanizacao,
       coalesce(nome_patio, '(não informado)') AS nome_patio, coalesce(cidade_patio_raw, '(não informado)') AS cidade_patio,
       horizonte_retirada, dt_ret AS dt_retirada_prevista, faixa_duracao,
       coalesce(cidade_origem, '(não informado)') AS cidade_cliente, tipo_cliente, id_sistema_origem AS sistema_origem,
       COUNT(*) AS qt_reservas, CAST(SUM(qt_veiculos_solicitados) AS BIGINT) AS qt_veiculos_solicitados
FROM res_bucketed
GROUP BY nome_grupo, nome_patio, cidade_patio_raw, horizonte_retirada, dt_ret, faixa_duracao, cidade_origem,
         tipo_cliente, id_sistema_origem"""


def _avg(total: str, n: str, scale: int) -> str:
    """AVG of an exact decimal by remainder: the quotient cut towards zero, one unit more
    away from zero if twice what is left reaches the divisor."""
    t = f"CAST(({total}) * {10 ** scale} AS HUGEINT)" if scale == 1 else f"CAST(({total}) * 100 AS HUGEINT)"
    cut = f"(abs({t}) // ({n}))"
    up = f"(CASE WHEN 2 * (abs({t}) % ({n})) >= ({n}) THEN 1 ELSE 0 END)"
    return (f"CASE WHEN ({n}) > 0 THEN CAST(CAST(({cut} + {up}) * sign({t}) AS DECIMAL(18,0)) "
            f"* {'0.1' if scale == 1 else '0.01'} AS DECIMAL(18,{scale})) END")


# totals of one client in one group; clients' places and groups' classes meet the sums
CTE["rental_sums"] = """
SELECT s, grp, cli, kind_done, SUM(n) AS n, SUM(asked) AS asked, SUM(total) AS total, SUM(rate) AS rate,
       SUM(n_rate) AS n_rate, SUM(days) AS days, SUM(n_days) AS n_days, MIN(lo) AS lo, MAX(hi) AS hi
FROM (
  SELECT f.id_sistema_origem AS s, f.nome_grupo AS grp, f.id_cliente_origem AS cli,
         f.status IN ('concluida', 'concluído', 'CONCLUIDA', 'CONCLUIDO') AS kind_done, 1 AS n,
         (SELECT MAX(q.qt_veiculos_solicitados) FROM fato_reserva_o q
          WHERE q.id_sistema_origem = f.id_sistema_origem AND q.id_reserva_origem = f.id_reserva_origem) AS asked,
         f.valor_total AS total, f.valor_diaria AS rate, CASE WHEN f.valor_diaria IS NULL THEN 0 ELSE 1 END AS n_rate,
         f.dias_locacao AS days, CASE WHEN f.dias_locacao IS NULL THEN 0 ELSE 1 END AS n_days,
         f.dias_locacao AS lo, f.dias_locacao AS hi
  FROM fato_locacao_o f)
GROUP BY s, grp, cli, kind_done"""
CTE["group_attr"] = """
SELECT id_sistema_origem AS s, nome_grupo AS grp, coalesce(mecanizacao, '(não informado)') AS gear,
       coalesce(classe_luxo, '(não informado)') AS lux, mecanizacao IS NULL AS no_gear, classe_luxo IS NULL AS no_lux
FROM dim_grupo_o"""
CTE["client_attr"] = """
SELECT id_sistema_origem AS s, id_cliente_origem AS cli, tipo_cliente AS kind,
       coalesce(cidade_origem, '(não informado)') AS city, coalesce(estado_origem, '(não informado)') AS state,
       cidade_origem IS NULL AS no_city, estado_origem IS NULL AS no_state
FROM dim_cliente_o"""


def _top(where: str = "") -> str:
    return f"""
SELECT CAST((SELECT COUNT(*) FROM top_cells{where} o WHERE o.s = t.s AND o.n > t.n) + 1 AS INTEGER) AS ranking_grupo,
       t.grp AS nome_grupo, t.gear AS mecanizacao, t.lux AS classe_luxo, t.city AS cidade_cliente, t.state AS estado_cliente,
       t.kind AS tipo_cliente, t.s AS sistema_origem, CAST(t.n AS BIGINT) AS qt_locacoes,
       CAST(t.asked AS BIGINT) AS qt_veiculos_solicitados, CAST(t.total AS DECIMAL(38,2)) AS valor_total_periodo,
       {_avg("t.rate", "t.n_rate", 2)} AS media_valor_diaria, {_avg("t.days", "t.n_days", 1)} AS media_dias_locacao,
       t.lo AS min_dias_locacao, t.hi AS max_dias_locacao
FROM top_cells{where} t"""


def _cells(where: str) -> str:
    return f"""
SELECT a.s, a.grp, g.gear, g.lux, g.no_gear, g.no_lux, c.city, c.state, c.no_city, c.no_state, c.kind, SUM(a.n) AS n,
       SUM(a.asked) AS asked, SUM(a.total) AS total, SUM(a.rate) AS rate, SUM(a.n_rate) AS n_rate, SUM(a.days) AS days,
       SUM(a.n_days) AS n_days, MIN(a.lo) AS lo, MAX(a.hi) AS hi
FROM rental_sums a, group_attr g, client_attr c
WHERE a.s = g.s AND a.grp = g.grp AND a.s = c.s AND a.cli = c.cli {where}
GROUP BY a.s, a.grp, g.gear, g.lux, g.no_gear, g.no_lux, c.city, c.state, c.no_city, c.no_state, c.kind"""


CTE["top_cells"] = _cells("")
CTE["top_cells_done"] = _cells("AND a.kind_done")
FINAL["top_groups"] = _top()
FINAL["top_groups_completed"] = _top("_done")

# ---------------------------------------------------------------- source C views
# counted by foreign keys first; labels are looked up for the counts
CTE["c_label"] = """
SELECT v.id_veiculo AS car, (SELECT MAX(g.codigo) FROM c_grupo g WHERE g.id_grupo = v.grupo_id) AS grp FROM c_veiculo v"""
CTE["c_yard_name"] = "SELECT id_patio AS yard, nome AS name FROM c_patio"
FINAL["src_available"] = """
SELECT * FROM (
WITH parked AS (SELECT patio_origem_id AS yard, grupo_id, COUNT(*) AS n FROM c_veiculo
                WHERE situacao IN ('DISPONIVEL') GROUP BY 1, 2),
     named AS (SELECT (SELECT MAX(name) FROM c_yard_name y WHERE y.yard = k.yard) AS patio,
                      (SELECT MAX(codigo) FROM c_grupo g WHERE g.id_grupo = k.grupo_id) AS grupo, n FROM parked k)
SELECT patio, grupo, CAST(SUM(n) AS BIGINT) AS total FROM named
WHERE patio IS NOT NULL AND grupo IS NOT NULL GROUP BY 1, 2)"""
FINAL["src_in_progress"] = """
SELECT * FROM (
WITH out_now AS (SELECT veiculo_id AS car, COUNT(*) AS n FROM c_loc WHERE status IN ('EM_ANDAMENTO') GROUP BY 1)
SELECT grp AS grupo, CAST(SUM(n) AS BIGINT) AS total_locacoes
FROM c_label JOIN out_now USING (car) WHERE grp IS NOT NULL GROUP BY grp)"""
FINAL["src_reservations"] = """
SELECT * FROM (
WITH booked AS (SELECT grupo_id, patio_retirada_id, cliente_id, COUNT(*) AS n FROM c_res
                WHERE estado = 'CONFIRMADA' OR estado = 'EM_FILA_ESPERA' GROUP BY 1, 2, 3),
     named AS (SELECT (SELECT MAX(codigo) FROM c_grupo WHERE id_grupo = b.grupo_id) AS grupo,
                      (SELECT MAX(name) FROM c_yard_name WHERE yard = b.patio_retirada_id) AS patio_retirada,
                      b.cliente_id, n FROM booked b)
SELECT grupo, patio_retirada, cidade_origem, CAST(SUM(n) AS BIGINT) AS total
FROM c_cliente JOIN named ON cliente_id = id_cliente
WHERE grupo IS NOT NULL AND patio_retirada IS NOT NULL GROUP BY 1, 2, 3)"""
FINAL["src_city_groups"] = """
SELECT * FROM (
WITH hired AS (SELECT cliente_id, veiculo_id AS car, COUNT(*) AS n FROM c_loc GROUP BY ALL)
SELECT cidade_origem, grp AS grupo, CAST(SUM(n) AS BIGINT) AS total_locacoes
FROM hired JOIN c_label USING (car) JOIN c_cliente ON id_cliente = hired.cliente_id
WHERE grp IS NOT NULL GROUP BY ALL)"""
FINAL["src_yard_pairs"] = """
SELECT * FROM (
WITH trips AS (SELECT patio_retirada_id AS a, patio_devolucao_id AS b, COUNT(*) FILTER (WHERE status = 'CONCLUIDA') AS n
               FROM c_loc GROUP BY ALL),
     named AS (SELECT (SELECT MAX(name) FROM c_yard_name WHERE yard = a) AS patio_retirada,
                      (SELECT MAX(name) FROM c_yard_name WHERE yard = b) AS patio_devolucao, n FROM trips WHERE n > 0)
SELECT patio_retirada, patio_devolucao, CAST(SUM(n) AS BIGINT) AS total_locacoes FROM named
WHERE patio_retirada IS NOT NULL AND patio_devolucao IS NOT NULL GROUP BY ALL)"""


# ---------------------------------------------------------------- data quality
def _rules(table: str, rules: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS rule, CAST(COUNT(*) FILTER (WHERE {cond}) AS BIGINT) AS n_violations FROM {table}"
        for name, cond in rules.items())


_NN = {
    "std_patio": ["id_patio_origem", "nome_patio"],
    "std_cliente": ["id_cliente_origem", "nome_cliente", "tipo_cliente"],
    "std_veiculo": ["id_veiculo_origem", "placa", "modelo"],
    "std_reserva": ["id_reserva_origem", "id_cliente_origem", "dt_retirada_prevista", "status"],
    "std_locacao": ["id_locacao_origem", "id_cliente_origem", "id_veiculo_origem", "id_patio_retirada_origem",
                    "dt_retirada"],
    "std_movimentacao": ["id_movimentacao_origem", "id_veiculo_origem", "id_patio_origem_origem", "dt_saida_origem"],
}
# loaded tables: rule column -> the column whose presence it stands for (natural keys for surrogate ones)
_SYSCOL = {"id_sistema_origem": "id_sistema_origem"}
_NN_DW = {
    ("dim_tempo", "dim_tempo_o"): {c: c for c in ("sk_tempo", "dt_ref", "dia", "mes", "ano")},
    ("dim_patio", "dim_patio_o"): {"sk_patio": "id_patio_origem", "id_patio_origem": "id_patio_origem",
                                   "nome_patio": "nome_patio", **_SYSCOL},
    ("dim_cliente", "dim_cliente_o"): {"sk_cliente": "id_cliente_origem", "id_cliente_origem": "id_cliente_origem",
                                       "nome_cliente": "nome_cliente", "tipo_cliente": "tipo_cliente", **_SYSCOL},
    ("dim_grupo", "dim_grupo_o"): {"sk_grupo": "nome_grupo", "nome_grupo": "nome_grupo", **_SYSCOL},
    ("dim_veiculo", "dim_veiculo_o"): {"sk_veiculo": "placa", "id_veiculo_origem": "id_veiculo_origem", "placa": "placa",
                                       **_SYSCOL},
    ("fato_locacao", "fato_locacao_o"): {
        "sk_locacao": "id_locacao_origem", "sk_cliente": "id_cliente_origem", "sk_veiculo": "placa",
        "sk_grupo": "nome_grupo", "sk_patio_retirada": "id_patio_retirada_origem",
        "sk_tempo_retirada": "sk_tempo_retirada", "valor_diaria": "valor_diaria", **_SYSCOL},
    ("fato_reserva", "fato_reserva_o"): {
        "sk_reserva": "id_reserva_origem", "sk_cliente": "id_cliente_origem",
        "sk_tempo_retirada_prevista": "sk_tempo_retirada_prevista", **_SYSCOL},
    ("fato_movimentacao_patio", "fato_mov_o"): {
        "sk_movimentacao": "id_movimentacao_origem", "sk_veiculo": "placa", "sk_patio_origem": "id_patio_origem_origem",
        **_SYSCOL},
}
FINAL["dq_not_null"] = "\nUNION ALL\n".join([
    *(_rules(t, {f"{t}.{c}": f"{c} IS NULL" for c in cols}) for t, cols in _NN.items()),
    *(_rules(src, {f"{t}.{c}": f"{n} IS NULL" for c, n in cols.items()}) for (t, src), cols in _NN_DW.items())])
_STATUS_OK = ("(id_sistema_origem = 'bay_level' AND status IN ('Confirmada', 'Cancelada', 'Atendida')) OR "
              "(id_sistema_origem = 'charge_total' AND status IN ('ativa', 'confirmada', 'cancelada', 'espera')) OR "
              "(id_sistema_origem = 'derived_moves' AND status IN ('CONFIRMADA', 'EM_FILA_ESPERA', 'CANCELADA', "
              "'CONCRETIZADA')) OR (id_sistema_origem = 'quoted_total' AND status IN ('ATIVA', 'CANCELADA', 'CONVERTIDA'))")
FINAL["dq_domain"] = "\nUNION ALL\n".join([
    _rules("std_cliente", {"std_cliente.tipo_cliente": "NOT (tipo_cliente IN ('PF', 'PJ'))",
                           "std_cliente.estado_origem_len": "length(estado_origem) <> 2"}),
    _rules("std_grupo", {"std_grupo.mecanizacao": "NOT (mecanizacao IN ('MANUAL', 'AUTOMATICO'))"}),
    _rules("std_veiculo", {"std_veiculo.mecanizacao": "NOT (mecanizacao IN ('MANUAL', 'AUTOMATICO'))"}),
    _rules("std_reserva", {"std_reserva.status": f"NOT ({_STATUS_OK})",
                           "std_reserva.qt_veiculos_solicitados": "qt_veiculos_solicitados <= 0"}),
    _rules("std_locacao", {"std_locacao.valor_diaria": "valor_diaria < 0", "std_locacao.valor_total": "valor_total < 0"}),
    _rules("dim_tempo_o", {"dim_tempo.dia": "NOT (dia BETWEEN 1 AND 31)", "dim_tempo.mes": "NOT (mes BETWEEN 1 AND 12)",
                           "dim_tempo.trimestre": "NOT (trimestre BETWEEN 1 AND 4)",
                           "dim_tempo.semestre": "NOT (semestre BETWEEN 1 AND 2)", "dim_tempo.ano": "ano < 1900",
                           "dim_tempo.dia_semana": "NOT (dia_semana BETWEEN 1 AND 7)",
                           "dim_tempo.semana_ano": "NOT (semana_ano BETWEEN 1 AND 53)"}),
    _rules("a_endereco", {"bay_level.endereco.uf": "uf NOT IN ('AC', 'AL', 'AP', 'AM', 'BA', 'CE', 'DF', 'ES', "
                          "'GO', 'MA', 'MT', 'MS', 'MG', 'PA', 'PB', 'PR', 'PE', 'PI', 'RJ', 'RN', 'RS', 'RO', 'RR', "
                          "'SC', 'SP', 'SE', 'TO')"}),
    _rules("a_veiculo", {"bay_level.veiculo.ano": "ano < 1900"}),
    _rules("a_res", {"bay_level.reserva.qtveiculossolicitados": "qtveiculossolicitados < 1"}),
    _rules("a_loc", {"bay_level.locacao.valordiaria": "valordiaria <= 0"}),
    _rules("c_loc", {"derived_moves.locacao.valor_diaria_aplicada": "NOT valor_diaria_aplicada >= 0",
                     "derived_moves.locacao.status": "NOT status IN ('EM_ANDAMENTO', 'CONCLUIDA', 'CANCELADA')"}),
    _rules("d_loc", {"quoted_total.locacao.valor_previsto": "NOT valor_previsto > 0",
                     "quoted_total.locacao.valor_final": "NOT (valor_final IS NULL OR valor_final >= 0)"}),
])


def _dupes(table: str, keys: list[str], rule: str) -> str:
    k = ", ".join(keys)
    nn = " AND ".join(f"{c} IS NOT NULL" for c in keys)
    return (f"SELECT '{rule}' AS rule, CAST(COUNT(*) FILTER (WHERE n > 1) AS BIGINT) AS n_violations "
            f"FROM (SELECT {k}, COUNT(*) AS n FROM {table} WHERE {nn} GROUP BY {k})")


_S = "id_sistema_origem"
FINAL["dq_unique"] = "\nUNION ALL\n".join([
    _dupes("std_patio", [_S, "id_patio_origem"], "std_patio.pk"),
    _dupes("std_cliente", [_S, "id_cliente_origem"], "std_cliente.pk"),
    _dupes("std_grupo", [_S, "nome_grupo"], "std_grupo.pk"),
    _dupes("std_veiculo", [_S, "id_veiculo_origem"], "std_veiculo.pk"),
    _dupes("std_veiculo", ["placa"], "std_veiculo.placa"),
    _dupes("std_reserva", [_S, "id_reserva_origem"], "std_reserva.pk"),
    _dupes("std_locacao", [_S, "id_locacao_origem"], "std_locacao.pk"),
    _dupes("std_movimentacao", [_S, "id_movimentacao_origem"], "std_movimentacao.pk"),
    _dupes("dim_tempo_o", ["dt_ref"], "dim_tempo.dt_ref"),
    _dupes("dim_patio_o", [_S, "id_patio_origem"], "dim_patio.natural_key"),
    _dupes("dim_cliente_o", [_S, "id_cliente_origem"], "dim_cliente.natural_key"),
    _dupes("dim_grupo_o", [_S, "nome_grupo"], "dim_grupo.natural_key"),
    _dupes("dim_veiculo_o", ["placa"], "dim_veiculo.natural_key"),
    _dupes("fato_locacao_o", [_S, "id_locacao_origem"], "fato_locacao.natural_key"),
    _dupes("fato_reserva_o", [_S, "id_reserva_origem"], "fato_reserva.natural_key"),
    _dupes("fato_mov_o", [_S, "id_movimentacao_origem"], "fato_movimentacao_patio.natural_key"),
    *[_dupes(f"{p}_veiculo", ["chassi"], f"{s}.veiculo.chassi")
      for p, s in (("a", "bay_level"), ("b", "charge_total"), ("c", "derived_moves"), ("d", "quoted_total"))],
    _dupes("c_loc", ["reserva_id"], "derived_moves.locacao.reserva_id"),
])
CTE["c_open"] = "SELECT * FROM c_loc WHERE status = 'EM_ANDAMENTO'"
CTE["std_open"] = "SELECT * FROM std_locacao WHERE status = 'EM_ANDAMENTO'"
FINAL["dq_one_open"] = "\nUNION ALL\n".join([
    _dupes("c_open", ["veiculo_id"], "derived_moves.locacao.one_open_per_vehicle"),
    _dupes("std_open", [_S, "id_veiculo_origem"], "std_locacao.one_open_per_vehicle"),
])
_FK = [
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
_FK_DW = [  # fact, rule column, its natural column here, dimension, natural column there, same source too
    ("fato_locacao", "sk_cliente", "id_cliente_origem", "dim_cliente", "id_cliente_origem", True),
    ("fato_locacao", "sk_veiculo", "placa", "dim_veiculo", "placa", False),
    ("fato_locacao", "sk_grupo", "nome_grupo", "dim_grupo", "nome_grupo", True),
    ("fato_locacao", "sk_patio_retirada", "id_patio_retirada_origem", "dim_patio", "id_patio_origem", True),
    ("fato_locacao", "sk_patio_devolucao", "id_patio_devolucao_origem", "dim_patio", "id_patio_origem", True),
    *[("fato_locacao", c, c, "dim_tempo", "sk_tempo", False)
      for c in ("sk_tempo_retirada", "sk_tempo_devolucao", "sk_tempo_devolucao_prevista")],
    ("fato_reserva", "sk_cliente", "id_cliente_origem", "dim_cliente", "id_cliente_origem", True),
    ("fato_reserva", "sk_patio_retirada", "id_patio_retirada_origem", "dim_patio", "id_patio_origem", True),
    ("fato_reserva", "sk_patio_devolucao", "id_patio_devolucao_origem", "dim_patio", "id_patio_origem", True),
    *[("fato_reserva", c, c, "dim_tempo", "sk_tempo", False)
      for c in ("sk_tempo_retirada_prevista", "sk_tempo_devolucao_prevista")],
    ("fato_movimentacao_patio", "sk_veiculo", "placa", "dim_veiculo", "placa", False),
    ("fato_movimentacao_patio", "sk_patio_origem", "id_patio_origem_origem", "dim_patio", "id_patio_origem", True),
    ("fato_movimentacao_patio", "sk_patio_destino", "id_patio_destino_origem", "dim_patio", "id_patio_origem", True),
    ("fato_movimentacao_patio", "sk_tempo", "sk_tempo", "dim_tempo", "sk_tempo", False),
]
_FACT_CTE = {"fato_locacao": "fato_locacao_o", "fato_reserva": "fato_reserva_o", "fato_movimentacao_patio": "fato_mov_o"}
FINAL["dq_fk"] = "\nUNION ALL\n".join([
    *(f"SELECT '{ch}.{col}->{pa}' AS rule, CAST(COUNT(*) AS BIGINT) AS n_violations FROM {ch} x "
      f"WHERE x.{col} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {pa} y WHERE y.{_S} = x.{_S} AND y.{pcol} = x.{col})"
      for ch, col, pa, pcol in _FK),
    *(f"SELECT '{fact}.{rule}->{dim}' AS rule, CAST(COUNT(*) AS BIGINT) AS n_violations FROM {_FACT_CTE[fact]} x "
      f"WHERE x.{col} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {dim}_o y WHERE y.{there} = x.{col}"
      f"{f' AND y.{_S} = x.{_S}' if scoped else ''})"
      for fact, rule, col, dim, there, scoped in _FK_DW)])
# each predicate is the negation of the declared CHECK; null dates satisfy it
FINAL["dq_order"] = "\nUNION ALL\n".join([
    _rules("std_locacao", {
        "std_locacao.devolucao_antes_retirada":
            f"NOT (CASE WHEN {_S} = 'derived_moves' THEN dt_devolucao_real > dt_retirada "
            "ELSE dt_devolucao_real >= dt_retirada END)",
        "charge_total.locacao.devolucao_sem_retirada":
            f"{_S} = 'charge_total' AND NOT (dt_devolucao_real IS NULL OR dt_retirada IS NOT NULL)"}),
    _rules("std_reserva", {
        "std_reserva.retirada_antes_reserva": "NOT (dt_reserva <= dt_retirada_prevista)",
        "std_reserva.devolucao_antes_retirada":
            f"NOT (CASE WHEN {_S} = 'derived_moves' THEN dt_devolucao_prevista > dt_retirada_prevista "
            "ELSE dt_devolucao_prevista >= dt_retirada_prevista END)"}),
    _rules("std_movimentacao", {"std_movimentacao.chegada_antes_saida": "NOT (dt_chegada_destino >= dt_saida_origem)"}),
    _rules("stg_a_reserva", {"bay_level.reserva.limite_antes_retirada": "NOT (dt_limite_retirada > dt_retirada_prevista)"}),
])
FINAL["dq_xor"] = "\nUNION ALL\n".join([
    _rules("a_cc", {"bay_level.centrocusto.pf_xor_pj": "(idfisica IS NULL) = (idempresa IS NULL)"}),
    _rules("std_movimentacao", {
        f"{s}.movimentacao.origem_igual_destino":
            f"{_S} = '{s}' AND id_patio_origem_origem = id_patio_destino_origem"
        for s in ("charge_total", "quoted_total")}),
])
FINAL["dq_time"] = "\nUNION ALL\n".join([
    _rules("std_reserva", {"std_reserva.reserva_no_futuro": f"dt_reserva > {AS_OF_TS}"}),
    _rules("std_locacao", {"std_locacao.retirada_no_futuro": f"dt_retirada > {AS_OF_TS}"}),
    _rules("std_movimentacao", {"std_movimentacao.saida_no_futuro": f"dt_saida_origem > {AS_OF_TS}"}),
])
_RATE_RAW = ("coalesce(l.valor_diaria, CASE WHEN l.dias_locacao <> 0 THEN l.valor_total END)")
FINAL["dq_discards"] = f"""
SELECT fato, motivo, id_sistema_origem, COUNT(*) AS n_descartes FROM (
  SELECT 'fato_locacao' AS fato, l.id_sistema_origem,
    CASE WHEN c.id_cliente_origem IS NULL THEN 'cliente_ausente'
         WHEN v.placa IS NULL THEN 'veiculo_ausente'
         WHEN g.nome_grupo IS NULL THEN 'grupo_ausente'
         WHEN p.id_patio_origem IS NULL THEN 'patio_retirada_ausente'
         WHEN l.dt_retirada IS NULL THEN 'retirada_sem_data'
         WHEN {_RATE_RAW} IS NULL THEN 'valor_diaria_irresolvivel' END AS motivo
  FROM std_locacao l
  LEFT JOIN dim_cliente_o c ON c.id_cliente_origem = l.id_cliente_origem AND c.{_S} = l.{_S}
  LEFT JOIN dim_veiculo_o v ON v.id_veiculo_origem = l.id_veiculo_origem AND v.{_S} = l.{_S}
  LEFT JOIN dim_grupo_o g ON g.nome_grupo = l.nome_grupo AND g.{_S} = l.{_S}
  LEFT JOIN dim_patio_o p ON p.id_patio_origem = l.id_patio_retirada_origem AND p.{_S} = l.{_S}
  UNION ALL
  SELECT 'fato_reserva', r.id_sistema_origem,
    CASE WHEN c.id_cliente_origem IS NULL THEN 'cliente_ausente'
         WHEN r.dt_retirada_prevista IS NULL THEN 'retirada_prevista_ausente' END
  FROM std_reserva r
  LEFT JOIN dim_cliente_o c ON c.id_cliente_origem = r.id_cliente_origem AND c.{_S} = r.{_S}
  UNION ALL
  SELECT 'fato_movimentacao_patio', m.id_sistema_origem,
    CASE WHEN v.placa IS NULL THEN 'veiculo_ausente'
         WHEN p.id_patio_origem IS NULL THEN 'patio_origem_ausente' END
  FROM std_movimentacao m
  LEFT JOIN dim_veiculo_o v ON v.id_veiculo_origem = m.id_veiculo_origem AND v.{_S} = m.{_S}
  LEFT JOIN dim_patio_o p ON p.id_patio_origem = m.id_patio_origem_origem AND p.{_S} = m.{_S}
) WHERE motivo IS NOT NULL GROUP BY ALL"""
_WIDTHS = {
    "dim_patio": ("std_patio", {"nome_patio": 100, "cidade": 100, "localizacao": 100}),
    "dim_cliente": ("std_cliente", {"nome_cliente": 255, "cidade_origem": 100, "estado_origem": 2}),
    "dim_grupo": ("std_grupo", {"nome_grupo": 100, "mecanizacao": 20}),
    "dim_veiculo": ("std_veiculo", {"placa": 10, "chassi": 30, "marca": 50, "modelo": 100, "cor": 30}),
}
FINAL["dq_width"] = "\nUNION ALL\n".join(
    _rules(src, {f"{dim}.{c}>{n}": f"length({c}) > {n}" for c, n in cols.items()})
    for dim, (src, cols) in _WIDTHS.items())


#: The tables on which the SQL is run by default; it names the yards of the wide matrix.
SF_DIR = "/root/testdata/sf0.01"


def oracle_sql(sf_dir: str = SF_DIR) -> dict[str, str]:
    import pyarrow.parquet as pq

    yards = sorted(set(pq.read_table(f"{sf_dir}/supplier.parquet", columns=["s_name"])["s_name"].to_pylist()))
    finals = FINAL | DECLARED | {"markov_matrix": _matrix(yards)}
    return {name: build(sql) for name, sql in finals.items()}
