"""The constraints that the four source schemas declare on columns and tables of their own: checks
(Q2, Q6, Q8), unique and primary keys (Q3), references (Q5), as data.

``sources`` is ``letter -> table -> DataFrame``; what is not there is not checked, so a caller may
pass the tables at hand. Every job reads a table once for all its rules: checks fold into one
aggregation, keys and references into one (rule, key) stream. A NULL satisfies a check and takes
no part in a key or a reference.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetdw.plans.quality import _union, orphans, repeated_values, rule_counts
from fleetdw.schemas import AS_OF, SYS_A, SYS_B, SYS_C, SYS_D

SYS_OF = {"A": SYS_A, "B": SYS_B, "C": SYS_C, "D": SYS_D}
c = F.col


def _below(col: str, least: int) -> Column:
    return c(col) < least


def _other(col: str, *values: str) -> Column:
    return ~c(col).isin(*values)


def _length(col: str, n: int) -> Column:
    return F.length(col) != n


# Driving licence classes of sources A and C.
LICENCE_A = ["A", "B", "C", "D", "E", "AB", "AC", "AD", "AE"]
LICENCE_C = ["A", "B", "AB", "C", "AC", "D", "AD", "E", "AE"]


def checks(as_of: _dt.date) -> dict[str, dict[str, dict[str, Column]]]:
    """letter -> table -> rule -> column that is TRUE where the rule is violated."""
    today = F.lit(as_of).cast("date")
    now = F.lit(_dt.datetime.combine(as_of, _dt.time(12))).cast("timestamp_ntz")  # a time of day, too
    return {
        "A": {
            "endereco": {"cep": _length("cep", 8)},
            "patio": {"lotacao": c("lotacao") <= 0, "horario": c("horariofechamento") <= c("horarioabertura")},
            "vaga": {"andar": _below("andar", 0)},
            "categoria": {"classeluxo": _other("classeluxo", "A", "B", "C"), "valordiariabase": _below("valordiariabase", 0)},
            "veiculo": {"portas": c("portas") <= 0, "ultimakilometragem": _below("ultimakilometragem", 0),
                        "valordiaria": _below("valordiaria", 0), "dimensoes": (c("altura") <= 0) | (c("largura") <= 0)},
            "pessoafisica": {"cpf": _length("cpf", 11), "dtnascimento": c("dtnascimento") >= today},
            "empresa": {"cnpj": _length("cnpj", 14)},
            "motorista": {"categoriacnh": _other("categoriacnh", *LICENCE_A)},
            "prontuario": {"custo": _below("custo", 0)},
            "avaria": {"dtregistro": c("dtregistro") > now},
        },
        "B": {
            "cliente": {"tipo": _other("tipo", "PF", "PJ")},
            "veiculo": {"tipo_mecanizacao": _other("tipo_mecanizacao", "manual", "automatico"),
                        "status": _other("status", "disponivel", "alugado", "manutencao")},
            "vaga": {"status": _other("status", "livre", "ocupada")},
            "locacao": {
                "km_na_retirada": c("data_retirada_realizada").isNotNull() & (c("km_entrega").isNull() | (c("km_entrega") < 0)),
                "km_na_devolucao": c("data_devolucao_realizada").isNotNull() & (c("km_devolucao").isNull() | (c("km_devolucao") < 0)),
                "datas_previstas": c("data_devolucao_prevista") < c("data_retirada_prevista")},
            "cobranca": {"valor": _below("valor", 0), "status": _other("status", "pendente", "pago", "cancelado")},
            "seguro": {"valor": _below("valor", 0)},
        },
        "C": {
            "patio": {"capacidade_vagas": _below("capacidade_vagas", 0)},
            "grupo": {"valor_diaria": _below("valor_diaria", 0), "franquia_km_diaria": _below("franquia_km_diaria", 0)},
            "veiculo": {"mecanizacao": _other("mecanizacao", "MANUAL", "AUTOMATICA"), "km_atual": _below("km_atual", 0),
                        "situacao": _other("situacao", "DISPONIVEL", "ALUGADO", "MANUTENCAO", "BAIXADO")},
            "cliente": {"tipo_pessoa": _other("tipo_pessoa", "PF", "PJ")},
            "cliente_pf": {"cnh_categoria": _other("cnh_categoria", *LICENCE_C)},
            "condutor": {"cnh_categoria": _other("cnh_categoria", *LICENCE_C)},
            "locacao": {"km_saida": _below("km_saida", 0), "km_chegada": c("km_chegada") < c("km_saida")},
            "cobranca": {"valor_total": _below("valor_total", 0), "status": _other("status", "PENDENTE", "PAGA", "CANCELADA")},
        },
        "D": {
            "cliente": {"tipo_cliente": _other("tipo_cliente", "PF", "PJ"), "estado": _length("estado", 2)},
            "veiculo": {"mecanizacao": _other("mecanizacao", "MANUAL", "AUTOMATICO"),
                        "status": _other("status", "DISPONIVEL", "ALUGADO", "MANUTENCAO", "RESERVADO")},
            "grupo_veiculo": {"faixa_valor_diaria": c("faixa_valor_diaria") <= 0},
            "condutor": {"validade_cnh": c("validade_cnh") < today},
            "locacao": {"status_locacao": _other("status_locacao", "ATIVA", "FINALIZADA", "CANCELADA"),
                        "datas_previstas": c("data_hora_prev_devolucao") < c("data_hora_retirada")},
            "pagamento": {"valor_pagamento": c("valor_pagamento") <= 0,
                          "forma_pagamento": _other("forma_pagamento", "DINHEIRO", "CARTAO", "PIX", "BOLETO"),
                          "tipo_pagamento": _other("tipo_pagamento", "ENTRADA", "PARCIAL", "FINAL")},
        },
    }


#: letter -> table -> keys; the first is the primary key
KEYS: dict[str, dict[str, list[list[str]]]] = {
    "A": {
        "endereco": [["idendereco"]], "parceira": [["idparceira"], ["cnpj"]], "patio": [["idpatio"], ["cdpatio"]],
        "vaga": [["idvaga"], ["codvaga"]], "categoria": [["idcategoria"]], "veiculo": [["idveiculo"], ["placa"], ["chassi"]],
        "pessoafisica": [["idfisica"], ["cpf"]], "empresa": [["idempresa"], ["cnpj"]],
        "motorista": [["idmotorista"], ["cnh"], ["idfisica"]], "centrocusto": [["idcentrocusto"]],
        "movimentacao": [["idmovimentacao"]], "reserva": [["idreserva"]], "locacao": [["idlocacao"]],
        "prontuario": [["idprontuario"]], "avaria": [["idavaria"]],
    },
    "B": {
        "empresa_locadora": [["id"], ["cnpj"]], "cliente": [["id"]], "condutor": [["id"], ["cnh"]], "grupo_veiculo": [["id"]],
        "veiculo": [["id"], ["placa"], ["chassi"]], "acessorio": [["id"], ["nome"]],
        "veiculo_acessorio": [["veiculo_id", "acessorio_id"]], "patio": [["id"]], "vaga": [["codigo", "patio_id"]],
        "reserva": [["id"]], "locacao": [["id"], ["reserva_id"]], "cobranca": [["locacao_id"]], "seguro": [["id"]],
        "locacao_seguro": [["locacao_id", "seguro_id"]], "foto": [["id"]], "manutencao": [["id"]], "movimentacao_patio": [["id"]],
    },
    "C": {
        "patio": [["id_patio"]], "vaga": [["patio_id", "codigo"]], "grupo": [["id_grupo"], ["codigo"]],
        "veiculo": [["id_veiculo"], ["placa"], ["chassi"], ["renavam"]], "cliente": [["id_cliente"], ["email"]],
        "cliente_pf": [["cliente_id"], ["cpf"], ["cnh_numero"]], "cliente_pj": [["cliente_id"], ["cnpj"]],
        "condutor": [["cliente_pj_id", "cpf"], ["cnh_numero"]], "reserva": [["id_reserva"]],
        "locacao": [["id_locacao"], ["numero_contrato"], ["reserva_id"]], "cobranca": [["id_cobranca"]],
    },
    "D": {
        "empresa": [["id_empresa"]], "patio": [["id_patio"], ["codigo_patio"]], "grupo_veiculo": [["id_grupo"]],
        "cliente": [["id_cliente"], ["cpf_cnpj"]], "condutor": [["id_condutor"], ["cpf"], ["numero_cnh"]],
        "veiculo": [["id_veiculo"], ["placa"], ["chassi"]], "reserva": [["id_reserva"]], "locacao": [["id_locacao"]],
        "pagamento": [["id_pagamento"]], "movimentacao_patio": [["id_movimentacao"]],
    },
}

#: letter -> child -> column -> parent, whose primary key is referenced
REFERENCES: dict[str, dict[str, dict[str, str]]] = {
    "A": {
        "patio": {"idendereco": "endereco", "idparceira": "parceira"}, "vaga": {"idpatio": "patio"},
        "veiculo": {"idcategoria": "categoria"}, "pessoafisica": {"idendereco": "endereco"}, "empresa": {"idendereco": "endereco"},
        "motorista": {"idfisica": "pessoafisica"},
        "centrocusto": {"idempresa": "empresa", "idfisica": "pessoafisica", "idresponsavel": "pessoafisica"},
        "movimentacao": {"idveiculo": "veiculo", "idvagaorigem": "vaga", "idvagadestino": "vaga"},
        "reserva": {"idcentrocusto": "centrocusto"},
        "locacao": {"idvagaretirada": "vaga", "idvagadevolvida": "vaga", "idveiculo": "veiculo", "idreserva": "reserva",
                    "idmotorista": "motorista"},
        "prontuario": {"idendereco": "endereco", "idveiculo": "veiculo"},
        "avaria": {"idlocacao": "locacao", "idveiculo": "veiculo", "idprontuariorelacionado": "prontuario"},
    },
    "B": {
        "condutor": {"cliente_id": "cliente"}, "veiculo": {"grupo_id": "grupo_veiculo", "empresa_id": "empresa_locadora"},
        "veiculo_acessorio": {"veiculo_id": "veiculo", "acessorio_id": "acessorio"}, "vaga": {"patio_id": "patio"},
        "reserva": {"cliente_id": "cliente", "grupo_id": "grupo_veiculo", "patio_retirada_id": "patio",
                    "patio_devolucao_id": "patio"},
        "locacao": {"reserva_id": "reserva", "veiculo_id": "veiculo", "condutor_id": "condutor", "patio_retirada_id": "patio",
                    "patio_devolucao_id": "patio"},
        "cobranca": {"locacao_id": "locacao"}, "locacao_seguro": {"locacao_id": "locacao", "seguro_id": "seguro"},
        "foto": {"veiculo_id": "veiculo"}, "manutencao": {"veiculo_id": "veiculo"},
        "movimentacao_patio": {"veiculo_id": "veiculo", "origem_patio_id": "patio", "destino_patio_id": "patio"},
    },
    "C": {
        "vaga": {"patio_id": "patio"}, "veiculo": {"grupo_id": "grupo", "patio_origem_id": "patio"},
        "cliente_pf": {"cliente_id": "cliente"}, "cliente_pj": {"cliente_id": "cliente"}, "condutor": {"cliente_pj_id": "cliente_pj"},
        "reserva": {"cliente_id": "cliente", "grupo_id": "grupo", "patio_retirada_id": "patio", "patio_devolucao_id": "patio"},
        "locacao": {"reserva_id": "reserva", "cliente_id": "cliente", "veiculo_id": "veiculo", "patio_retirada_id": "patio",
                    "patio_devolucao_id": "patio"},
        "cobranca": {"locacao_id": "locacao"},
    },
    "D": {
        "patio": {"id_empresa": "empresa"}, "condutor": {"id_cliente": "cliente"},
        "veiculo": {"id_grupo": "grupo_veiculo", "id_empresa": "empresa", "id_patio_atual": "patio"},
        "reserva": {"id_cliente": "cliente", "id_grupo": "grupo_veiculo", "id_patio_retirada": "patio",
                    "id_patio_devolucao_previsto": "patio"},
        "locacao": {"id_reserva": "reserva", "id_cliente": "cliente", "id_condutor": "condutor", "id_veiculo": "veiculo",
                    "id_patio_retirada": "patio", "id_patio_devolucao_previsto": "patio", "id_patio_devolucao_real": "patio"},
        "pagamento": {"id_locacao": "locacao"},
        "movimentacao_patio": {"id_veiculo": "veiculo", "id_patio_origem": "patio", "id_patio_destino": "patio"},
    },
}


def _there(sources, letter: str, *tables: str) -> bool:
    return letter in sources and all(t in sources[letter] for t in tables)


def dq_source_checks(sources: dict[str, dict[str, DataFrame]], as_of: _dt.date = AS_OF) -> DataFrame:  # Q2, Q6, Q8
    """(rule, n_violations) of every declared check; CURRENT_DATE is ``as_of``, CURRENT_TIMESTAMP its noon."""
    return _union([rule_counts(sources[p][t], {f"{SYS_OF[p]}.{t}.{name}": bad for name, bad in rules.items()})
                   for p, tables in checks(as_of).items() for t, rules in tables.items() if _there(sources, p, t)])


def key_rule(letter: str, table: str, key: Sequence[str], primary: bool) -> str:
    return f"{SYS_OF[letter]}.{table}.{'pk' if primary else '+'.join(key)}"


def dq_source_unique(sources: dict[str, dict[str, DataFrame]]) -> DataFrame:  # Q3
    """(rule, n_violations): key values that more than one row has."""
    return repeated_values([(sources[p][t], {key_rule(p, t, k, i == 0): k for i, k in enumerate(keys)})
                            for p, tables in KEYS.items() for t, keys in tables.items() if _there(sources, p, t)])


def dq_source_fk(sources: dict[str, dict[str, DataFrame]]) -> DataFrame:  # Q5
    """(rule, n_violations): rows whose reference leads nowhere."""
    tables, rules = {}, []
    for p, children in REFERENCES.items():
        for child, refs in children.items():
            for col, parent in refs.items():
                if _there(sources, p, child, parent):
                    a, b = f"{SYS_OF[p]}.{child}", f"{SYS_OF[p]}.{parent}"
                    tables[a], tables[b] = sources[p][child], sources[p][parent]
                    rules.append((a, col, b, KEYS[p][parent][0][0]))
    return orphans(tables, rules, [])
