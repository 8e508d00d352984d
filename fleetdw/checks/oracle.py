"""DuckDB SQL oracle: the same adapter rules and pipeline semantics written as
plain SQL over the driver's views (region nation customer supplier part orders
lineitem), independently of the Spark code.

Each query is assembled as ``WITH <needed CTEs> SELECT ...``; the CTE list is the
transitive closure of names referenced by the final SELECT. Natural keys stand
in for surrogate keys. Exact rounding uses integer arithmetic on both sides.
"""

from __future__ import annotations

import re

AS_OF = "DATE '1998-06-01'"
AS_OF_TS = "TIMESTAMP '1998-06-01 00:00:00'"
NYARD = "(SELECT COUNT(*) FROM supplier)"


def dkey(e: str) -> str:
    """yyyymmdd INTEGER of a date/timestamp expression (NULL stays NULL)."""
    return f"CAST(year({e}) * 10000 + month({e}) * 100 + day({e}) AS INTEGER)"


def kdate(e: str) -> str:
    return f"CAST(strptime(CAST({e} AS VARCHAR), '%Y%m%d') AS DATE)"


def pct(n: str, d: str) -> str:
    return f"CAST(CAST((20000 * ({n}) + ({d})) // (2 * ({d})) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2))"


def plate(letter: str) -> str:
    return (f"CASE WHEN p_partkey % 50 = 0 THEN 'X' || CAST(p_partkey AS VARCHAR) "
            f"ELSE '{letter}' || CAST(p_partkey AS VARCHAR) END")


def chassis(letter: str) -> str:
    return f"'{letter}' || lpad(CAST(p_partkey AS VARCHAR), 16, '0')"


COLOUR = "'COR' || CAST(p_size % 7 AS VARCHAR)"
AIRCON = "(p_size % 3 <> 0)"
TIPO = "CASE WHEN c_custkey % 3 = 0 THEN 'PJ' ELSE 'PF' END"

CTE: dict[str, str] = {}

# ---------------------------------------------------------------- driver-shaped helpers
CTE["li_x"] = f"""
SELECT l.*,
  CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR)
    || '-' || CAST(l_suppkey AS VARCHAR) || '-' || strftime(l_shipdate, '%Y%m%d') AS rid,
  l_shipdate + INTERVAL 12 HOUR AS pick_ts,
  CASE WHEN l_linestatus = 'F'
       THEN l_shipdate + to_days(CAST(l_quantity AS INTEGER)) + to_hours(CAST(l_linenumber AS BIGINT)) END AS ret_ts,
  l_partkey % {NYARD} AS dest,
  CAST(l_extendedprice AS DECIMAL(10,2)) AS money,
  CASE WHEN l_linenumber <> 1 THEN l_orderkey END AS walkin_res,
  l_orderkey % 4 AS src
FROM lineitem l"""
CTE["lio_x"] = """
SELECT x.*, o.o_custkey, o.o_orderpriority FROM li_x x JOIN orders o ON o.o_orderkey = x.l_orderkey"""
CTE["yard_x"] = """
SELECT s.s_suppkey, s.s_name, s.s_nationkey, n.n_name, n.n_regionkey, r.r_name
FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey"""
CTE["cust_x"] = """
SELECT c.c_custkey, c.c_name, c.c_nationkey, n.n_name, n.n_regionkey
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey"""
CTE["ord_x"] = """
SELECT o.*, p.p_type AS res_group, o_orderkey % 4 AS src
FROM orders o LEFT JOIN part p ON p.p_partkey = o.o_custkey"""

# ---------------------------------------------------------------- source A
CTE["a_endereco"] = """
SELECT n_nationkey AS idendereco, 'R' || CAST(n.n_regionkey AS VARCHAR) AS uf, n_name AS cidade,
       r_name AS bairro, n_name AS logradouro, CAST(n_nationkey AS VARCHAR) AS numero
FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey"""
CTE["a_patio"] = "SELECT s_suppkey AS idpatio, s_name AS cdpatio, s_nationkey AS idendereco FROM supplier"
CTE["a_vaga"] = "SELECT s_suppkey * 7 + k AS idvaga, s_suppkey AS idpatio FROM supplier, range(7) t(k)"
CTE["a_categoria"] = "SELECT DISTINCT p_type AS idcategoria, p_type AS classificacao FROM part"
CTE["a_veiculo"] = f"""
SELECT p_partkey AS idveiculo, {plate('A')} AS placa, {chassis('A')} AS chassi, p_name AS modelo,
       1990 + p_size AS ano, {AIRCON} AS arcondicionado, p_type AS idcategoria FROM part"""
CTE["a_pf"] = ("SELECT c_custkey AS idfisica, c_name AS nome, c_nationkey AS idendereco FROM customer "
               "WHERE c_custkey % 3 <> 0")
CTE["a_emp"] = ("SELECT c_custkey AS idempresa, c_name AS razaosocial, c_nationkey AS idendereco FROM customer "
                "WHERE c_custkey % 3 = 0")
CTE["a_cc"] = """
SELECT c_custkey AS idcentrocusto,
       CASE WHEN c_custkey % 3 = 0 THEN c_custkey END AS idempresa,
       CASE WHEN c_custkey % 3 <> 0 THEN c_custkey END AS idfisica FROM customer"""
CTE["a_res"] = """
SELECT o_orderkey AS idreserva, CAST(1 + o_orderkey % 3 AS INTEGER) AS qtveiculossolicitados,
       o_orderdate - to_hours(o_orderkey % 97) AS dtreserva, o_orderdate AS dtretiradaprevista,
       o_orderdate + INTERVAL 2 DAY AS dtlimiteretirada,
       CASE o_orderstatus WHEN 'P' THEN 'Cancelada' WHEN 'F' THEN 'Atendida' ELSE 'Confirmada' END AS status,
       o_custkey AS idcentrocusto
FROM orders WHERE o_orderkey % 4 = 0"""
CTE["a_loc"] = """
SELECT rid AS idlocacao, money AS valordiaria, pick_ts AS dtretirada, ret_ts AS dtchegada,
       l_suppkey * 7 + l_linenumber - 1 AS idvagaretirada,
       CASE WHEN l_linestatus = 'F' THEN dest * 7 END AS idvagadevolvida,
       l_partkey AS idveiculo, l_orderkey AS idreserva
FROM li_x WHERE src = 0"""
CTE["a_mov"] = """
SELECT rid AS idmovimentacao, l_shipdate + INTERVAL 1 DAY AS dtchegada, l_shipdate AS dtretirada,
       l_partkey AS idveiculo, l_suppkey * 7 + l_linenumber - 1 AS idvagaorigem,
       CASE WHEN l_linenumber <> 7 THEN dest * 7 END AS idvagadestino
FROM li_x WHERE src = 0 AND l_returnflag = 'R'"""

# ---------------------------------------------------------------- source B
CTE["b_cliente"] = f"SELECT c_custkey AS id, c_name AS nome, {TIPO} AS tipo, n_name AS cidade FROM cust_x"
CTE["b_condutor"] = "SELECT c_custkey AS id, c_custkey AS cliente_id FROM customer"
CTE["b_grupo"] = "SELECT DISTINCT p_type AS id, p_type AS nome FROM part"
CTE["b_veiculo"] = f"""
SELECT p_partkey AS id, {plate('B')} AS placa, {chassis('B')} AS chassi, p_name AS modelo, p_brand AS marca,
       {COLOUR} AS cor, CASE WHEN p_partkey % 2 = 0 THEN 'manual' ELSE 'automatico' END AS tipo_mecanizacao,
       {AIRCON} AS ar_condicionado, p_type AS grupo_id FROM part"""
CTE["b_patio"] = "SELECT s_suppkey AS id, s_name AS nome, n_name AS cidade FROM yard_x"
CTE["b_res"] = f"""
SELECT o_orderkey AS id, o_custkey AS cliente_id, res_group AS grupo_id,
       o_orderkey % {NYARD} AS patio_retirada_id, o_custkey % {NYARD} AS patio_devolucao_id,
       CAST(o_orderdate AS DATE) AS data_inicio,
       CAST(o_orderdate AS DATE) + CAST(o_orderkey % 20 AS INTEGER) AS data_fim,
       CASE o_orderstatus WHEN 'P' THEN 'cancelada' WHEN 'F' THEN 'confirmada' ELSE 'ativa' END AS status
FROM ord_x WHERE src = 1"""
CTE["b_loc"] = """
SELECT rid AS id, walkin_res AS reserva_id, l_partkey AS veiculo_id, o_custkey AS condutor_id,
       l_suppkey AS patio_retirada_id, dest AS patio_devolucao_id,
       pick_ts AS data_retirada_realizada, ret_ts AS data_devolucao_realizada
FROM lio_x WHERE src = 1"""
CTE["b_cobranca"] = "SELECT rid AS locacao_id, money AS valor FROM li_x WHERE src = 1 AND l_returnflag <> 'N'"
CTE["b_mov"] = """
SELECT rid AS id, l_partkey AS veiculo_id, l_suppkey AS origem_patio_id, dest AS destino_patio_id,
       l_shipdate AS data_movimentacao
FROM li_x WHERE src = 1 AND l_returnflag = 'R' AND l_suppkey <> dest"""

# ---------------------------------------------------------------- source C
CTE["c_patio"] = "SELECT s_suppkey AS id_patio, s_name AS nome, n_name || ' - ' || r_name AS endereco FROM yard_x"
CTE["c_grupo"] = ("SELECT DISTINCT p_type AS id_grupo, p_type AS nome, upper(substr(p_type, 1, 3)) AS codigo "
                  "FROM part")
CTE["c_veiculo"] = f"""
SELECT p_partkey AS id_veiculo, p_type AS grupo_id, {plate('C')} AS placa, {chassis('C')} AS chassi,
       p_brand AS marca, p_name AS modelo, {COLOUR} AS cor, 1990 + p_size AS ano_fabricacao,
       CASE WHEN p_partkey % 2 = 0 THEN 'MANUAL' ELSE 'AUTOMATICA' END AS mecanizacao,
       {AIRCON} AS tem_ar_condicionado, p_partkey % {NYARD} AS patio_origem_id,
       CASE WHEN p_size % 2 = 0 THEN 'DISPONIVEL' ELSE 'LOCADO' END AS situacao
FROM part"""
CTE["c_cliente"] = f"SELECT c_custkey AS id_cliente, {TIPO} AS tipo_pessoa, c_name AS nome, n_name AS cidade_origem FROM cust_x"
CTE["c_res"] = f"""
SELECT o_orderkey AS id_reserva, o_custkey AS cliente_id, res_group AS grupo_id,
       o_orderkey % {NYARD} AS patio_retirada_id, o_custkey % {NYARD} AS patio_devolucao_id,
       o_orderdate - to_hours(o_orderkey % 97) AS data_reserva, o_orderdate AS data_retirada_prevista,
       o_orderdate + to_days(CAST(o_orderkey % 20 AS INTEGER)) AS data_devolucao_prevista,
       CASE WHEN o_orderstatus = 'P' THEN 'CANCELADA' WHEN o_orderstatus = 'F' THEN 'CONCRETIZADA'
            WHEN o_orderkey % 5 = 0 THEN 'EM_FILA_ESPERA' ELSE 'CONFIRMADA' END AS estado
FROM ord_x WHERE src = 2"""
CTE["c_loc"] = """
SELECT rid AS id_locacao, walkin_res AS reserva_id, o_custkey AS cliente_id, l_partkey AS veiculo_id,
       l_suppkey AS patio_retirada_id, dest AS patio_devolucao_id, pick_ts AS data_retirada_real,
       ret_ts AS data_devolucao_real, money AS valor_diaria_aplicada,
       CASE WHEN l_linestatus = 'F' THEN 'CONCLUIDA' WHEN l_returnflag = 'A' THEN 'CANCELADA'
            ELSE 'EM_ANDAMENTO' END AS status
FROM lio_x WHERE src = 2"""

# ---------------------------------------------------------------- source D
CTE["d_patio"] = ("SELECT s_suppkey AS id_patio, s_name AS nome_patio, n_name || ' - ' || r_name AS localizacao "
                  "FROM yard_x")
CTE["d_grupo"] = "SELECT DISTINCT p_type AS id_grupo, p_type AS nome_grupo FROM part"
CTE["d_cliente"] = f"""
SELECT c_custkey AS id_cliente, {TIPO} AS tipo_cliente, c_name AS nome_razao_social, n_name AS cidade,
       'R' || CAST(n_regionkey AS VARCHAR) AS estado FROM cust_x"""
CTE["d_veiculo"] = f"""
SELECT p_partkey AS id_veiculo, {plate('D')} AS placa, 'D-' || p_name AS chassi, p_brand AS marca,
       p_name AS modelo, {COLOUR} AS cor, CASE WHEN p_partkey % 2 = 0 THEN 'MANUAL' ELSE 'AUTOMATICO' END AS mecanizacao,
       {AIRCON} AS ar_condicionado, p_type AS id_grupo FROM part"""
CTE["d_res"] = f"""
SELECT o_orderkey AS id_reserva, CAST(o_orderdate - to_hours(o_orderkey % 97) AS DATE) AS data_reserva,
       CAST(o_orderdate AS DATE) AS data_prev_retirada,
       CAST(o_orderdate AS DATE) + CAST(o_orderkey % 20 AS INTEGER) AS data_prev_devolucao,
       CASE o_orderstatus WHEN 'P' THEN 'CANCELADA' WHEN 'F' THEN 'CONVERTIDA' ELSE 'ATIVA' END AS status_reserva,
       o_custkey AS id_cliente, res_group AS id_grupo, o_orderkey % {NYARD} AS id_patio_retirada,
       o_custkey % {NYARD} AS id_patio_devolucao_previsto
FROM ord_x WHERE src = 3"""
CTE["d_loc"] = """
SELECT rid AS id_locacao, pick_ts AS data_hora_retirada, ret_ts AS data_hora_real_devolucao,
       money AS valor_previsto,
       CASE WHEN l_linestatus = 'F' THEN CAST(money + CAST(l_quantity AS INTEGER) AS DECIMAL(10,2)) END AS valor_final,
       walkin_res AS id_reserva, o_custkey AS id_cliente, l_partkey AS id_veiculo, l_suppkey AS id_patio_retirada,
       CASE WHEN l_linestatus = 'F' THEN dest END AS id_patio_devolucao_real
FROM lio_x WHERE src = 3"""
CTE["d_mov"] = """
SELECT rid AS id_movimentacao, l_shipdate AS data_hora_movimentacao, o_orderpriority AS motivo_movimentacao,
       l_partkey AS id_veiculo, l_suppkey AS id_patio_origem, dest AS id_patio_destino
FROM lio_x WHERE src = 3 AND l_returnflag = 'R' AND l_suppkey <> dest"""

# ---------------------------------------------------------------- extracts (staging)
V = "VARCHAR"
CTE["stg_a_patio"] = f"""
SELECT CAST(p.idpatio AS {V}) AS id_patio_origem, p.cdpatio AS nome_patio, e.cidade,
       e.logradouro || ', ' || e.numero || ' - ' || e.bairro || ' - ' || e.uf AS localizacao,
       'bay_level' AS id_sistema_origem
FROM a_patio p JOIN a_endereco e ON e.idendereco = p.idendereco"""
# the driver mapping makes every third customer a company and seats a customer in its nation
CTE["stg_a_cliente"] = f"""
SELECT CAST(c_custkey AS {V}) AS id_cliente_origem, {TIPO} AS tipo_cliente, c_name AS nome_cliente,
       n_name AS cidade_origem, 'R' || CAST(n_regionkey AS {V}) AS estado_origem, 'bay_level' AS id_sistema_origem
FROM cust_x"""
CTE["stg_a_veiculo"] = f"""
SELECT CAST(v.idveiculo AS {V}) AS id_veiculo_origem, v.placa, v.chassi, CAST(NULL AS {V}) AS marca, v.modelo,
       CAST(v.ano AS INTEGER) AS ano, CAST(NULL AS {V}) AS cor, v.arcondicionado AS ar_condicionado,
       c.classificacao AS nome_grupo, CAST(NULL AS {V}) AS mecanizacao, 'bay_level' AS id_sistema_origem
FROM a_veiculo v JOIN a_categoria c ON c.idcategoria = v.idcategoria"""
CTE["stg_a_reserva"] = f"""
SELECT CAST(idreserva AS {V}) AS id_reserva_origem, CAST(idcentrocusto AS {V}) AS id_cliente_origem,
       CAST(NULL AS {V}) AS id_grupo_origem, CAST(NULL AS {V}) AS id_patio_retirada_origem,
       dtreserva AS dt_reserva, dtretiradaprevista AS dt_retirada_prevista, dtlimiteretirada AS dt_limite_retirada,
       CAST(NULL AS TIMESTAMP) AS dt_devolucao_prevista, qtveiculossolicitados AS qt_veiculos_solicitados,
       status, 'bay_level' AS id_sistema_origem
FROM a_res"""
# seven bays a yard, numbered through: the yard is the bay's number divided by seven
CTE["stg_a_locacao"] = f"""
SELECT idlocacao AS id_locacao_origem, CAST(idreserva AS {V}) AS id_reserva_origem,
       (SELECT CAST(MAX(o_custkey) AS {V}) FROM orders WHERE o_orderkey = idreserva) AS id_cliente_origem,
       CAST(idveiculo AS {V}) AS id_veiculo_origem, CAST(idvagaretirada // 7 AS {V}) AS id_patio_retirada_origem,
       CAST(idvagadevolvida // 7 AS {V}) AS id_patio_devolucao_origem, dtretirada AS dt_retirada,
       dtchegada AS dt_devolucao_real, valordiaria AS valor_diaria, 'bay_level' AS id_sistema_origem
FROM a_loc WHERE idreserva IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 4 = 0)
  AND idvagaretirada // 7 IN (SELECT s_suppkey FROM supplier)"""
CTE["stg_a_movimentacao"] = f"""
SELECT idmovimentacao AS id_movimentacao_origem, CAST(idveiculo AS {V}) AS id_veiculo_origem,
       CAST(idvagaorigem // 7 AS {V}) AS id_patio_origem_origem, CAST(idvagadestino // 7 AS {V}) AS id_patio_destino_origem,
       dtretirada AS dt_saida_origem, dtchegada AS dt_chegada_destino, 'bay_level' AS id_sistema_origem
FROM a_mov WHERE idvagaorigem // 7 IN (SELECT s_suppkey FROM supplier)"""
CTE["stg_b_patio"] = f"""
SELECT CAST(id AS {V}) AS id_patio_origem, nome AS nome_patio, cidade, CAST(NULL AS {V}) AS localizacao,
       'charge_total' AS id_sistema_origem FROM b_patio"""
CTE["stg_b_cliente"] = f"""
SELECT CAST(id AS {V}) AS id_cliente_origem, tipo AS tipo_cliente, nome AS nome_cliente, cidade AS cidade_origem,
       CAST(NULL AS {V}) AS estado_origem, 'charge_total' AS id_sistema_origem FROM b_cliente"""
CTE["stg_b_veiculo"] = f"""
SELECT CAST(v.id AS {V}) AS id_veiculo_origem, v.placa, v.chassi, v.marca, v.modelo, CAST(NULL AS INTEGER) AS ano,
       v.cor, v.ar_condicionado, g.nome AS nome_grupo, v.tipo_mecanizacao AS mecanizacao,
       'charge_total' AS id_sistema_origem
FROM b_veiculo v JOIN b_grupo g ON g.id = v.grupo_id"""
CTE["stg_b_reserva"] = f"""
SELECT CAST(id AS {V}) AS id_reserva_origem, CAST(cliente_id AS {V}) AS id_cliente_origem,
       CAST(grupo_id AS {V}) AS id_grupo_origem, CAST(patio_retirada_id AS {V}) AS id_patio_retirada_origem,
       CAST(patio_devolucao_id AS {V}) AS id_patio_devolucao_origem, CAST(NULL AS TIMESTAMP) AS dt_reserva,
       CAST(data_inicio AS TIMESTAMP) AS dt_retirada_prevista, CAST(data_fim AS TIMESTAMP) AS dt_devolucao_prevista,
       CAST(NULL AS INTEGER) AS qt_veiculos_solicitados, status, 'charge_total' AS id_sistema_origem
FROM b_res"""
# a driver is the customer of the same number; charges exist for what came back
CTE["stg_b_locacao"] = f"""
SELECT id AS id_locacao_origem, CAST(reserva_id AS {V}) AS id_reserva_origem, CAST(condutor_id AS {V}) AS id_cliente_origem,
       CAST(veiculo_id AS {V}) AS id_veiculo_origem, CAST(patio_retirada_id AS {V}) AS id_patio_retirada_origem,
       CAST(patio_devolucao_id AS {V}) AS id_patio_devolucao_origem, data_retirada_realizada AS dt_retirada,
       data_devolucao_realizada AS dt_devolucao_real, charge.valor AS valor_total, 'charge_total' AS id_sistema_origem
FROM b_loc LEFT JOIN (SELECT locacao_id, valor FROM b_cobranca) charge ON charge.locacao_id = id
WHERE condutor_id IN (SELECT c_custkey FROM customer)"""
CTE["stg_b_movimentacao"] = f"""
SELECT CAST(id AS {V}) AS id_movimentacao_origem, CAST(veiculo_id AS {V}) AS id_veiculo_origem,
       CAST(origem_patio_id AS {V}) AS id_patio_origem_origem, CAST(destino_patio_id AS {V}) AS id_patio_destino_origem,
       data_movimentacao AS dt_saida_origem, CAST(NULL AS TIMESTAMP) AS dt_chegada_destino,
       'charge_total' AS id_sistema_origem FROM b_mov"""

CTE["stg_c_patio"] = f"""
SELECT CAST(id_patio AS {V}) AS id_patio_origem, nome AS nome_patio, CAST(NULL AS {V}) AS cidade,
       endereco AS localizacao, 'derived_moves' AS id_sistema_origem FROM c_patio"""
CTE["stg_c_cliente"] = f"""
SELECT CAST(id_cliente AS {V}) AS id_cliente_origem, tipo_pessoa AS tipo_cliente, nome AS nome_cliente,
       cidade_origem, CAST(NULL AS {V}) AS estado_origem, 'derived_moves' AS id_sistema_origem FROM c_cliente"""
CTE["stg_c_veiculo"] = f"""
SELECT CAST(v.id_veiculo AS {V}) AS id_veiculo_origem, v.placa, v.chassi, v.marca, v.modelo,
       CAST(v.ano_fabricacao AS INTEGER) AS ano, v.cor, v.tem_ar_condicionado AS ar_condicionado,
       g.nome AS nome_grupo, v.mecanizacao, 'derived_moves' AS id_sistema_origem
FROM c_veiculo v JOIN c_grupo g ON g.id_grupo = v.grupo_id"""
CTE["stg_c_reserva"] = f"""
SELECT CAST(id_reserva AS {V}) AS id_reserva_origem, CAST(cliente_id AS {V}) AS id_cliente_origem,
       CAST(grupo_id AS {V}) AS id_grupo_origem, CAST(patio_retirada_id AS {V}) AS id_patio_retirada_origem,
       CAST(patio_devolucao_id AS {V}) AS id_patio_devolucao_origem, data_reserva AS dt_reserva,
       data_retirada_prevista AS dt_retirada_prevista, data_devolucao_prevista AS dt_devolucao_prevista,
       CAST(NULL AS INTEGER) AS qt_veiculos_solicitados, estado AS status, 'derived_moves' AS id_sistema_origem
FROM c_res"""
CTE["stg_c_locacao"] = f"""
SELECT CAST(id_locacao AS {V}) AS id_locacao_origem, CAST(reserva_id AS {V}) AS id_reserva_origem,
       CAST(cliente_id AS {V}) AS id_cliente_origem, CAST(veiculo_id AS {V}) AS id_veiculo_origem,
       CAST(patio_retirada_id AS {V}) AS id_patio_retirada_origem,
       CAST(patio_devolucao_id AS {V}) AS id_patio_devolucao_origem, data_retirada_real AS dt_retirada,
       data_devolucao_real AS dt_devolucao_real, valor_diaria_aplicada AS valor_diaria,
       'derived_moves' AS id_sistema_origem FROM c_loc"""
CTE["stg_c_movimentacao"] = f"""
SELECT 'LOC-' || CAST(id_locacao AS {V}) AS id_movimentacao_origem, CAST(veiculo_id AS {V}) AS id_veiculo_origem,
       CAST(patio_retirada_id AS {V}) AS id_patio_origem_origem,
       CAST(patio_devolucao_id AS {V}) AS id_patio_destino_origem, data_retirada_real AS dt_saida_origem,
       data_devolucao_real AS dt_chegada_destino, 'derived_moves' AS id_sistema_origem
FROM c_loc
WHERE status = 'CONCLUIDA' AND data_devolucao_real IS NOT NULL AND patio_retirada_id <> patio_devolucao_id"""

CTE["stg_d_patio"] = f"""
SELECT CAST(id_patio AS {V}) AS id_patio_origem, nome_patio, CAST(NULL AS {V}) AS cidade, localizacao,
       'quoted_total' AS id_sistema_origem FROM d_patio"""
CTE["stg_d_cliente"] = f"""
SELECT CAST(id_cliente AS {V}) AS id_cliente_origem, tipo_cliente, nome_razao_social AS nome_cliente,
       cidade AS cidade_origem, estado AS estado_origem, 'quoted_total' AS id_sistema_origem FROM d_cliente"""
CTE["stg_d_veiculo"] = f"""
SELECT CAST(v.id_veiculo AS {V}) AS id_veiculo_origem, v.placa, v.chassi, v.marca, v.modelo,
       CAST(NULL AS INTEGER) AS ano, v.cor, v.ar_condicionado, g.nome_grupo, v.mecanizacao,
       'quoted_total' AS id_sistema_origem
FROM d_veiculo v JOIN d_grupo g ON g.id_grupo = v.id_grupo"""
CTE["stg_d_reserva"] = f"""
SELECT CAST(id_reserva AS {V}) AS id_reserva_origem, CAST(id_cliente AS {V}) AS id_cliente_origem,
       CAST(id_grupo AS {V}) AS id_grupo_origem, CAST(id_patio_retirada AS {V}) AS id_patio_retirada_origem,
       CAST(id_patio_devolucao_previsto AS {V}) AS id_patio_devolucao_origem,
       CAST(data_reserva AS TIMESTAMP) AS dt_reserva, CAST(data_prev_retirada AS TIMESTAMP) AS dt_retirada_prevista,
       CAST(data_prev_devolucao AS TIMESTAMP) AS dt_devolucao_prevista,
       CAST(NULL AS INTEGER) AS qt_veiculos_solicitados, status_reserva AS status,
       'quoted_total' AS id_sistema_origem FROM d_res"""
CTE["stg_d_locacao"] = f"""
SELECT CAST(id_locacao AS {V}) AS id_locacao_origem, CAST(id_reserva AS {V}) AS id_reserva_origem,
       CAST(id_cliente AS {V}) AS id_cliente_origem, CAST(id_veiculo AS {V}) AS id_veiculo_origem,
       CAST(id_patio_retirada AS {V}) AS id_patio_retirada_origem,
       CAST(id_patio_devolucao_real AS {V}) AS id_patio_devolucao_origem, data_hora_retirada AS dt_retirada,
       data_hora_real_devolucao AS dt_devolucao_real, valor_previsto, valor_final,
       'quoted_total' AS id_sistema_origem FROM d_loc"""
CTE["stg_d_movimentacao"] = f"""
SELECT CAST(id_movimentacao AS {V}) AS id_movimentacao_origem, CAST(id_veiculo AS {V}) AS id_veiculo_origem,
       CAST(id_patio_origem AS {V}) AS id_patio_origem_origem, CAST(id_patio_destino AS {V}) AS id_patio_destino_origem,
       data_hora_movimentacao AS dt_saida_origem, CAST(NULL AS TIMESTAMP) AS dt_chegada_destino,
       motivo_movimentacao AS motivo, 'quoted_total' AS id_sistema_origem FROM d_mov"""

# ---------------------------------------------------------------- transform (standard staging)
WD = "CAST(date_part('day', {a} - {b}) AS INTEGER)"  # whole 24h days, truncated toward zero


def wd(a: str, b: str) -> str:
    return WD.format(a=a, b=b)


CTE["std_patio"] = "\nUNION ALL\n".join(
    f"SELECT id_patio_origem, nome_patio, cidade, localizacao, id_sistema_origem FROM stg_{p}_patio" for p in "abcd")
CTE["std_cliente"] = "\nUNION ALL\n".join(
    f"SELECT id_cliente_origem, nome_cliente, tipo_cliente, cidade_origem, estado_origem, id_sistema_origem "
    f"FROM stg_{p}_cliente" for p in "abcd")
GEAR = {"a": f"CAST(NULL AS {V})", "b": "upper(mecanizacao)",
        "c": "replace(upper(mecanizacao), 'AUTOMATICA', 'AUTOMATICO')", "d": "mecanizacao"}
CTE["std_grupo"] = "\nUNION ALL\n".join(
    f"SELECT DISTINCT CAST(NULL AS {V}) AS id_grupo_origem, nome_grupo, {GEAR[p]} AS mecanizacao, "
    f"CAST(NULL AS {V}) AS classe_luxo, CAST(NULL AS DECIMAL(10,2)) AS valor_diaria_base, id_sistema_origem "
    f"FROM stg_{p}_veiculo WHERE nome_grupo IS NOT NULL" for p in "abcd")
CTE["std_veiculo"] = "\nUNION ALL\n".join(
    f"SELECT id_veiculo_origem, placa, chassi, marca, modelo, ano, cor, ar_condicionado, nome_grupo, "
    f"{GEAR[p]} AS mecanizacao, id_sistema_origem FROM stg_{p}_veiculo" for p in "abcd")
CTE["std_reserva"] = "\nUNION ALL\n".join(
    "SELECT id_reserva_origem, id_cliente_origem, id_grupo_origem, id_patio_retirada_origem, "
    + (f"CAST(NULL AS {V})" if p == "a" else "id_patio_devolucao_origem") + " AS id_patio_devolucao_origem, "
    "dt_reserva, dt_retirada_prevista, dt_devolucao_prevista, "
    + ("CAST(NULL AS INTEGER)" if p == "b" else wd("dt_retirada_prevista", "dt_reserva")) + " AS antecedencia_dias, "
    f"qt_veiculos_solicitados, status, id_sistema_origem FROM stg_{p}_reserva" for p in "abcd")


def _std_loc(p: str) -> str:
    days = wd("l.dt_devolucao_real", "l.dt_retirada")
    planned = "r.dt_devolucao_prevista" if p in "bc" else "CAST(NULL AS TIMESTAMP)"
    join_r = (f"LEFT JOIN stg_{p}_reserva r ON r.id_reserva_origem = l.id_reserva_origem" if p in "bc" else "")
    if p in "ac":
        rate = "l.valor_diaria"
        total = f"CAST(CASE WHEN l.dt_devolucao_real IS NOT NULL THEN l.valor_diaria * {days} END AS DECIMAL(10,2))"
    elif p == "b":
        rate, total = "CAST(NULL AS DECIMAL(10,2))", "l.valor_total"
    else:
        rate, total = "CAST(NULL AS DECIMAL(10,2))", "coalesce(l.valor_final, l.valor_previsto)"
    return f"""SELECT l.id_locacao_origem, l.id_reserva_origem, l.id_cliente_origem, l.id_veiculo_origem, v.nome_grupo,
       l.id_patio_retirada_origem, l.id_patio_devolucao_origem, l.dt_retirada, l.dt_devolucao_real,
       {planned} AS dt_devolucao_prevista, CAST({rate} AS DECIMAL(10,2)) AS valor_diaria,
       CAST({total} AS DECIMAL(10,2)) AS valor_total, {days} AS dias_locacao, CAST(NULL AS INTEGER) AS km_rodados,
       CASE WHEN l.dt_devolucao_real IS NULL THEN 'EM_ANDAMENTO' ELSE 'CONCLUIDA' END AS status, l.id_sistema_origem
FROM stg_{p}_locacao l JOIN stg_{p}_veiculo v ON v.id_veiculo_origem = l.id_veiculo_origem {join_r}"""


CTE["std_locacao"] = "\nUNION ALL\n".join(_std_loc(p) for p in "abcd")
CTE["std_movimentacao"] = "\nUNION ALL\n".join(
    "SELECT id_movimentacao_origem, id_veiculo_origem, id_patio_origem_origem, id_patio_destino_origem, "
    "dt_saida_origem, dt_chegada_destino, " + ("motivo" if p == "d" else f"CAST(NULL AS {V})")
    + f" AS motivo, id_sistema_origem FROM stg_{p}_movimentacao" for p in "abcd")

# ---------------------------------------------------------------- dimensions
DAY_NAMES = "['Segunda-Feira', 'Terça-Feira', 'Quarta-Feira', 'Quinta-Feira', 'Sexta-Feira', 'Sábado', 'Domingo']"
MONTH_NAMES = ("['Janeiro', 'Fevereiro', 'Março', 'Abril', 'Maio', 'Junho', 'Julho', 'Agosto', 'Setembro', "
               "'Outubro', 'Novembro', 'Dezembro']")


def cal_cols(d: str) -> str:
    return f"""{dkey(d)} AS sk_tempo, {d} AS dt_ref, CAST(day({d}) AS SMALLINT) AS dia,
       CAST(month({d}) AS SMALLINT) AS mes, CAST(quarter({d}) AS SMALLINT) AS trimestre,
       CAST(CASE WHEN month({d}) <= 6 THEN 1 ELSE 2 END AS SMALLINT) AS semestre, CAST(year({d}) AS SMALLINT) AS ano,
       CAST(isodow({d}) AS SMALLINT) AS dia_semana, {DAY_NAMES}[isodow({d})] AS nome_dia,
       {MONTH_NAMES}[month({d})] AS nome_mes, CAST(week({d}) AS INTEGER) AS semana_ano, false AS is_feriado"""


CTE["all_dates"] = """
SELECT CAST(dt_retirada AS DATE) AS d FROM std_locacao UNION ALL
SELECT CAST(dt_devolucao_real AS DATE) FROM std_locacao UNION ALL
SELECT CAST(dt_devolucao_prevista AS DATE) FROM std_locacao UNION ALL
SELECT CAST(coalesce(dt_reserva, dt_retirada_prevista) AS DATE) FROM std_reserva UNION ALL
SELECT CAST(dt_retirada_prevista AS DATE) FROM std_reserva UNION ALL
SELECT CAST(dt_devolucao_prevista AS DATE) FROM std_reserva UNION ALL
SELECT CAST(dt_saida_origem AS DATE) FROM std_movimentacao UNION ALL
SELECT CAST(dt_chegada_destino AS DATE) FROM std_movimentacao"""
CTE["bounds"] = "SELECT min(d) AS dt_ini, max(d) AS dt_fim FROM all_dates WHERE d IS NOT NULL"
CTE["cal_days"] = ("SELECT CAST(g.d AS DATE) AS d FROM bounds, "
                   "generate_series(bounds.dt_ini, bounds.dt_fim, INTERVAL 1 DAY) g(d) WHERE bounds.dt_ini IS NOT NULL")
CTE["dim_tempo_o"] = (f"SELECT {cal_cols('d')} FROM cal_days\nUNION ALL\n"
                      f"SELECT {cal_cols(chr(39) + '9999-12-31' + chr(39) + '::DATE')}")


def first_per_key(src: str, keys: str, order: str) -> str:
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT t.*, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn "
            f"FROM {src} t) WHERE rn = 1")


CTE["dim_grupo_o"] = first_per_key("std_grupo", "id_sistema_origem, nome_grupo", "mecanizacao ASC NULLS LAST")
CTE["dim_patio_o"] = first_per_key("std_patio", "id_sistema_origem, id_patio_origem", "nome_patio ASC NULLS LAST")
CTE["dim_cliente_o"] = first_per_key("std_cliente", "id_sistema_origem, id_cliente_origem",
                                     "nome_cliente ASC NULLS LAST")
CTE["veh_sel"] = ("SELECT id_veiculo_origem, placa, chassi, marca, modelo, CAST(ano AS SMALLINT) AS ano, cor, "
                  "ar_condicionado, id_sistema_origem FROM std_veiculo")
CTE["dim_veiculo_o"] = first_per_key("veh_sel", "placa",
                                     "id_sistema_origem ASC NULLS LAST, id_veiculo_origem ASC NULLS LAST")

# ---------------------------------------------------------------- facts (natural keys)
RATE = ("coalesce(l.valor_diaria, CASE WHEN l.dias_locacao <> 0 THEN CAST(CAST((2 * CAST(l.valor_total * 100 AS BIGINT)"
        " + l.dias_locacao) // (2 * l.dias_locacao) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(10,2)) END)")
CTE["fato_locacao_o"] = f"""
SELECT l.id_locacao_origem, l.id_cliente_origem, v.placa, l.nome_grupo, l.id_patio_retirada_origem,
       pd.id_patio_origem AS id_patio_devolucao_origem, {dkey('l.dt_retirada')} AS sk_tempo_retirada,
       {dkey('l.dt_devolucao_real')} AS sk_tempo_devolucao,
       coalesce({dkey('l.dt_devolucao_prevista')}, 99991231) AS sk_tempo_devolucao_prevista,
       CAST({RATE} AS DECIMAL(10,2)) AS valor_diaria, l.dias_locacao, l.km_rodados,
       CAST(coalesce(l.valor_total, l.valor_diaria * l.dias_locacao) AS DECIMAL(10,2)) AS valor_total,
       l.status, l.id_reserva_origem, l.id_sistema_origem
FROM std_locacao l
JOIN dim_cliente_o c ON c.id_cliente_origem = l.id_cliente_origem AND c.id_sistema_origem = l.id_sistema_origem
JOIN dim_veiculo_o v ON v.id_veiculo_origem = l.id_veiculo_origem AND v.id_sistema_origem = l.id_sistema_origem
JOIN dim_grupo_o g ON g.nome_grupo = l.nome_grupo AND g.id_sistema_origem = l.id_sistema_origem
JOIN dim_patio_o pr ON pr.id_patio_origem = l.id_patio_retirada_origem AND pr.id_sistema_origem = l.id_sistema_origem
LEFT JOIN dim_patio_o pd ON pd.id_patio_origem = l.id_patio_devolucao_origem AND pd.id_sistema_origem = l.id_sistema_origem
WHERE {RATE} IS NOT NULL AND l.dt_retirada IS NOT NULL"""
CTE["fato_reserva_o"] = f"""
SELECT r.id_reserva_origem, r.id_cliente_origem, CAST(NULL AS {V}) AS nome_grupo,
       pr.id_patio_origem AS id_patio_retirada_origem, pd.id_patio_origem AS id_patio_devolucao_origem,
       {dkey('coalesce(r.dt_reserva, r.dt_retirada_prevista)')} AS sk_tempo_reserva,
       {dkey('r.dt_retirada_prevista')} AS sk_tempo_retirada_prevista,
       {dkey('r.dt_devolucao_prevista')} AS sk_tempo_devolucao_prevista, r.antecedencia_dias,
       CAST(coalesce(r.qt_veiculos_solicitados, 1) AS INTEGER) AS qt_veiculos_solicitados, r.status,
       r.id_sistema_origem
FROM std_reserva r
JOIN dim_cliente_o c ON c.id_cliente_origem = r.id_cliente_origem AND c.id_sistema_origem = r.id_sistema_origem
LEFT JOIN dim_patio_o pr ON pr.id_patio_origem = r.id_patio_retirada_origem AND pr.id_sistema_origem = r.id_sistema_origem
LEFT JOIN dim_patio_o pd ON pd.id_patio_origem = r.id_patio_devolucao_origem AND pd.id_sistema_origem = r.id_sistema_origem
WHERE r.dt_retirada_prevista IS NOT NULL"""
CTE["fato_mov_o"] = f"""
SELECT m.id_movimentacao_origem, v.placa, po.id_patio_origem AS id_patio_origem_origem,
       pd.id_patio_origem AS id_patio_destino_origem, {dkey('m.dt_saida_origem')} AS sk_tempo, m.motivo,
       1 AS quantidade_veiculos, m.id_sistema_origem
FROM std_movimentacao m
JOIN dim_veiculo_o v ON v.id_veiculo_origem = m.id_veiculo_origem AND v.id_sistema_origem = m.id_sistema_origem
JOIN dim_patio_o po ON po.id_patio_origem = m.id_patio_origem_origem AND po.id_sistema_origem = m.id_sistema_origem
LEFT JOIN dim_patio_o pd ON pd.id_patio_origem = m.id_patio_destino_origem AND pd.id_sistema_origem = m.id_sistema_origem"""

# ---------------------------------------------------------------- Markov
CTE["pair_counts"] = """
SELECT id_sistema_origem AS s, id_patio_origem_origem AS o, id_patio_destino_origem AS d, COUNT(*) AS qtd
FROM fato_mov_o WHERE id_patio_destino_origem IS NOT NULL GROUP BY ALL"""
CTE["pair_named"] = """
SELECT c.*, po.nome_patio AS patio_origem, pd.nome_patio AS patio_destino,
       CAST(SUM(c.qtd) OVER (PARTITION BY c.s, c.o) AS BIGINT) AS total
FROM pair_counts c
JOIN dim_patio_o po ON po.id_sistema_origem = c.s AND po.id_patio_origem = c.o
JOIN dim_patio_o pd ON pd.id_sistema_origem = c.s AND pd.id_patio_origem = c.d"""

_CTE_NAME = re.compile(r"\b([a-z_][a-z0-9_]*)\b")


def _deps(sql: str) -> list[str]:
    return [n for n in dict.fromkeys(_CTE_NAME.findall(sql)) if n in CTE]


def build(final: str) -> str:
    """Prefix ``final`` with every CTE it needs, in dependency order."""
    order: list[str] = []
    seen: set[str] = set()

    def visit(name: str) -> None:
        if name in seen:
            return
        seen.add(name)
        for d in _deps(CTE[name]):
            if d != name:
                visit(d)
        order.append(name)

    for n in _deps(final):
        visit(n)
    if not order:
        return final
    body = ",\n".join(f"{n} AS (\n{CTE[n].strip()}\n)" for n in order)
    return f"WITH {body}\n{final}"
