"""DuckDB SQL for the constraints that the source schemas declare (``dq_source_*``).

The checks are written as the schemas declare them and negated here; which columns are keys and
references is data, read from the rule catalogue.
"""

from __future__ import annotations

from fleetdw.checks.oracle import AS_OF, CTE
from fleetdw.plans.declared import KEYS, REFERENCES, SYS_OF, key_rule
from fleetdw.sources.declared_shapes import COLUMNS, TABLES

#: shapes whose name differs in the other statements
_SHORT = {
    "A": {"pessoafisica": "a_pf", "empresa": "a_emp", "centrocusto": "a_cc", "reserva": "a_res", "locacao": "a_loc",
          "movimentacao": "a_mov"},
    "B": {"grupo_veiculo": "b_grupo", "reserva": "b_res", "locacao": "b_loc", "movimentacao_patio": "b_mov"},
    "C": {"reserva": "c_res", "locacao": "c_loc"},
    "D": {"grupo_veiculo": "d_grupo", "reserva": "d_res", "locacao": "d_loc", "movimentacao_patio": "d_mov"},
}


def _shape(p: str, t: str) -> str:
    return _SHORT[p].get(t, f"{p.lower()}_{t}")


def _name(p: str, t: str) -> str:
    return f"whole_{p.lower()}_{t}"


for _p in "ABCD":
    for _t in {*KEYS[_p], *COLUMNS[_p]}:
        if _t in TABLES[_p]:
            _src, _cond, _cols = TABLES[_p][_t]
            CTE[_name(_p, _t)] = f"SELECT {', '.join(f'{e} AS {c}' for c, e in _cols.items())} FROM {_shape(_p, _src)} WHERE {_cond}"
        else:
            _more = "".join(f", {e} AS {c}" for c, e in COLUMNS[_p].get(_t, {}).items())
            CTE[_name(_p, _t)] = f"SELECT *{_more} FROM {_shape(_p, _t)}"

NOON = "TIMESTAMP '1998-06-01 12:00:00'"
_CNH = "IN ('A', 'B', 'C', 'D', 'E', 'AB', 'AC', 'AD', 'AE')"

#: (letter, table) -> rule -> the declared CHECK
CHECKS = {
    ("A", "endereco"): {"cep": "length(cep) = 8"},
    ("A", "patio"): {"lotacao": "lotacao > 0", "horario": "horariofechamento > horarioabertura"},
    ("A", "vaga"): {"andar": "andar IS NULL OR andar >= 0"},
    ("A", "categoria"): {"classeluxo": "classeluxo IN ('A', 'B', 'C')", "valordiariabase": "valordiariabase >= 0"},
    ("A", "veiculo"): {"portas": "portas > 0", "ultimakilometragem": "ultimakilometragem >= 0", "valordiaria": "valordiaria >= 0",
                       "dimensoes": "altura > 0 AND largura > 0"},
    ("A", "pessoafisica"): {"cpf": "length(cpf) = 11", "dtnascimento": f"dtnascimento < {AS_OF}"},
    ("A", "empresa"): {"cnpj": "length(cnpj) = 14"},
    ("A", "motorista"): {"categoriacnh": f"categoriacnh {_CNH}"},
    ("A", "prontuario"): {"custo": "custo >= 0"},
    ("A", "avaria"): {"dtregistro": f"dtregistro <= {NOON}"},
    ("B", "cliente"): {"tipo": "tipo IN ('PF', 'PJ')"},
    ("B", "veiculo"): {"tipo_mecanizacao": "tipo_mecanizacao IN ('manual', 'automatico')",
                       "status": "status IN ('disponivel', 'alugado', 'manutencao')"},
    ("B", "vaga"): {"status": "status IN ('livre', 'ocupada')"},
    ("B", "locacao"): {
        "km_na_retirada": "data_retirada_realizada IS NULL OR (km_entrega IS NOT NULL AND km_entrega >= 0)",
        "km_na_devolucao": "data_devolucao_realizada IS NULL OR (km_devolucao IS NOT NULL AND km_devolucao >= 0)",
        "datas_previstas": "data_devolucao_prevista >= data_retirada_prevista"},
    ("B", "cobranca"): {"valor": "valor >= 0", "status": "status IN ('pendente', 'pago', 'cancelado')"},
    ("B", "seguro"): {"valor": "valor >= 0"},
    ("C", "patio"): {"capacidade_vagas": "capacidade_vagas >= 0"},
    ("C", "grupo"): {"valor_diaria": "valor_diaria >= 0", "franquia_km_diaria": "franquia_km_diaria >= 0"},
    ("C", "veiculo"): {"mecanizacao": "mecanizacao IN ('MANUAL', 'AUTOMATICA')", "km_atual": "km_atual >= 0",
                       "situacao": "situacao IN ('DISPONIVEL', 'ALUGADO', 'MANUTENCAO', 'BAIXADO')"},
    ("C", "cliente"): {"tipo_pessoa": "tipo_pessoa IN ('PF', 'PJ')"},
    ("C", "cliente_pf"): {"cnh_categoria": f"cnh_categoria {_CNH}"},
    ("C", "condutor"): {"cnh_categoria": f"cnh_categoria {_CNH}"},
    ("C", "locacao"): {"km_saida": "km_saida >= 0", "km_chegada": "km_chegada IS NULL OR km_chegada >= km_saida"},
    ("C", "cobranca"): {"valor_total": "valor_total >= 0", "status": "status IN ('PENDENTE', 'PAGA', 'CANCELADA')"},
    ("D", "cliente"): {"tipo_cliente": "tipo_cliente IN ('PF', 'PJ')", "estado": "length(estado) = 2"},
    ("D", "veiculo"): {"mecanizacao": "mecanizacao IN ('MANUAL', 'AUTOMATICO')",
                       "status": "status IN ('DISPONIVEL', 'ALUGADO', 'MANUTENCAO', 'RESERVADO')"},
    ("D", "grupo_veiculo"): {"faixa_valor_diaria": "faixa_valor_diaria > 0"},
    ("D", "condutor"): {"validade_cnh": f"validade_cnh >= {AS_OF}"},
    ("D", "locacao"): {"status_locacao": "status_locacao IN ('ATIVA', 'FINALIZADA', 'CANCELADA')",
                       "datas_previstas": "data_hora_prev_devolucao >= data_hora_retirada"},
    ("D", "pagamento"): {"valor_pagamento": "valor_pagamento > 0",
                         "forma_pagamento": "forma_pagamento IN ('DINHEIRO', 'CARTAO', 'PIX', 'BOLETO')",
                         "tipo_pagamento": "tipo_pagamento IN ('ENTRADA', 'PARCIAL', 'FINAL')"},
}


def _broken(p: str, t: str, rule: str, check: str) -> str:
    return (f"SELECT '{SYS_OF[p]}.{t}.{rule}' AS rule, CAST(COUNT(*) AS BIGINT) AS n_violations "
            f"FROM {_name(p, t)} WHERE NOT ({check})")


def _repeated(p: str, t: str, key: list[str], primary: bool) -> str:
    cols = ", ".join(key)
    given = " AND ".join(f"{c} IS NOT NULL" for c in key)
    return (f"SELECT '{key_rule(p, t, key, primary)}' AS rule, CAST(COUNT(*) AS BIGINT) AS n_violations FROM "
            f"(SELECT {cols} FROM {_name(p, t)} WHERE {given} GROUP BY {cols} HAVING COUNT(*) > 1)")


def _dangling(p: str, child: str, col: str, parent: str) -> str:
    key = KEYS[p][parent][0][0]
    return (f"SELECT '{SYS_OF[p]}.{child}.{col}->{SYS_OF[p]}.{parent}' AS rule, CAST(COUNT(*) AS BIGINT) AS n_violations "
            f"FROM {_name(p, child)} x LEFT JOIN (SELECT DISTINCT {key} AS k FROM {_name(p, parent)} WHERE {key} IS NOT NULL) y "
            f"ON y.k = x.{col} WHERE x.{col} IS NOT NULL AND y.k IS NULL")


FINAL = {
    "dq_source_checks": "\nUNION ALL\n".join(
        _broken(p, t, rule, check) for (p, t), rules in CHECKS.items() for rule, check in rules.items()),
    "dq_source_unique": "\nUNION ALL\n".join(
        _repeated(p, t, key, i == 0) for p, ts in KEYS.items() for t, keys in ts.items() for i, key in enumerate(keys)),
    "dq_source_fk": "\nUNION ALL\n".join(
        _dangling(p, child, col, parent) for p, ts in REFERENCES.items() for child, refs in ts.items()
        for col, parent in refs.items()),
}
