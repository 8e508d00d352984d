"""Test data for the constraints that the four source schemas declare beyond the columns the
extracts read: further columns of the shapes in ``adapters`` and further tables, each an
expression over a shape's columns.

The expressions are plain SQL, the same in every dialect; the SQL oracle reads them, too, as it
shares the rules of the other shapes. Most rules meet some rows that violate them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetdw.sources.adapters import Shapes
from fleetdw.sources.lazy import Lazy


def _digits(expr: str, n: int | str = 11) -> str:
    return f"lpad(CAST({expr} AS STRING), {n}, '0')"


def _text(prefix: str, expr: str) -> str:
    return f"'{prefix}' || CAST({expr} AS STRING)"


def _money(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(10,2))"


#: further columns of a shape: letter -> table -> column -> expression
COLUMNS: dict[str, dict[str, dict[str, str]]] = {
    "A": {
        "endereco": {"cep": f"CASE WHEN idendereco % 11 = 3 THEN '1234' ELSE {_digits('20000000 + idendereco * 137', 8)} END"},
        "patio": {"lotacao": "idpatio % 40", "idparceira": "idpatio % 6",
                  "horarioabertura": f"{_digits('5 + idpatio % 5', 2)} || ':00:00'",
                  "horariofechamento": f"{_digits('CASE WHEN idpatio % 17 = 4 THEN 4 ELSE 18 + idpatio % 6 END', 2)} || ':30:00'"},
        "vaga": {"codvaga": _text("V", "CASE WHEN idvaga % 50 = 7 THEN idvaga - 1 ELSE idvaga END"),
                 "andar": "CASE WHEN idvaga % 3 = 0 THEN NULL WHEN idvaga % 50 = 1 THEN -1 ELSE idvaga % 5 END"},
        "categoria": {"classeluxo": "substr('ABCD', CAST(1 + length(idcategoria) % 4 AS INT), 1)",
                      "valordiariabase": _money("length(idcategoria) * 10 - 160")},
        "veiculo": {"portas": "idveiculo % 6", "ultimakilometragem": "idveiculo * 13 % 1000 - 5",
                    "altura": "CAST(idveiculo % 30 AS DECIMAL(5,2))", "largura": "CAST(idveiculo % 31 AS DECIMAL(5,2))",
                    "valordiaria": _money("idveiculo % 200 - 1")},
        "pessoafisica": {"cpf": _digits("idfisica % 997", "CASE WHEN idfisica % 101 = 5 THEN 10 ELSE 11 END"),
                         "dtnascimento": "DATE '1930-01-01' + CAST(idfisica * 37 % 25200 AS INT)"},
        "empresa": {"cnpj": _digits("idempresa % 997", "CASE WHEN idempresa % 101 = 3 THEN 13 ELSE 14 END")},
        "centrocusto": {"idresponsavel": "CASE WHEN idcentrocusto % 3 = 0 THEN idcentrocusto + 1 ELSE idcentrocusto END"},
        "locacao": {"idmotorista": "idveiculo"},
    },
    "B": {
        "condutor": {"cnh": _text("C", "id % 1009")},
        "veiculo": {"status": "CASE WHEN id % 19 = 0 THEN 'vendido' WHEN id % 2 = 0 THEN 'alugado' ELSE 'disponivel' END",
                    "empresa_id": "id % 10"},
        "locacao": {"data_retirada_prevista": "data_retirada_realizada - INTERVAL '1' HOUR",
                    "data_devolucao_prevista": "CASE WHEN veiculo_id % 37 = 0 THEN data_retirada_realizada - INTERVAL '2' HOUR "
                                               "ELSE data_retirada_realizada + INTERVAL '3' DAY END",
                    "km_entrega": "CASE WHEN veiculo_id % 41 = 0 THEN NULL ELSE veiculo_id * 3 - 5 END",
                    "km_devolucao": "CASE WHEN veiculo_id % 43 = 0 THEN NULL ELSE veiculo_id * 3 - 7 END"},
        "cobranca": {"status": "CASE WHEN length(locacao_id) % 5 = 0 THEN 'aberto' ELSE 'pago' END"},
    },
    "C": {
        "patio": {"capacidade_vagas": "id_patio % 50 - 1"},
        "grupo": {"valor_diaria": _money("length(id_grupo) * 10 - 160"), "franquia_km_diaria": "length(id_grupo) - 18"},
        "veiculo": {"renavam": _digits("id_veiculo % 1999"), "km_atual": "id_veiculo * 7 - 9"},
        "cliente": {"email": f"{_text('c', 'id_cliente % 1490')} || '@exemplo'"},
        "locacao": {"numero_contrato": "'K' || id_locacao", "km_saida": "veiculo_id * 3 - 4",
                    "km_chegada": "CASE WHEN data_devolucao_real IS NULL THEN NULL WHEN veiculo_id % 31 = 0 THEN veiculo_id * 3 - 40 "
                                  "ELSE veiculo_id * 3 + 50 END"},
    },
    "D": {
        "patio": {"id_empresa": "id_patio % 5", "codigo_patio": _text("Y", "id_patio % 95")},
        "grupo_veiculo": {"faixa_valor_diaria": _money("length(id_grupo) - 18")},
        "cliente": {"cpf_cnpj": _digits("id_cliente % 1480", 14)},
        "veiculo": {"status": "CASE WHEN id_veiculo % 29 = 0 THEN 'VENDIDO' WHEN id_veiculo % 2 = 0 THEN 'ALUGADO' ELSE 'DISPONIVEL' END",
                    "id_empresa": "id_veiculo % 5", "id_patio_atual": "id_veiculo % 101"},
        "locacao": {"status_locacao": "CASE WHEN id_veiculo % 53 = 0 THEN 'ABERTA' WHEN data_hora_real_devolucao IS NULL THEN 'ATIVA' "
                                      "ELSE 'FINALIZADA' END",
                    "data_hora_prev_devolucao": "CASE WHEN id_veiculo % 47 = 0 THEN data_hora_retirada - INTERVAL '2' HOUR "
                                                "ELSE data_hora_retirada + INTERVAL '3' DAY END",
                    "id_condutor": "id_cliente", "id_patio_devolucao_previsto": "id_veiculo % 102"},
    },
}

#: further tables: letter -> table -> (shape, condition, column -> expression)
TABLES: dict[str, dict[str, tuple[str, str, dict[str, str]]]] = {
    "A": {
        "parceira": ("endereco", "idendereco < 5", {"idparceira": "idendereco", "cnpj": _digits("idendereco % 4", 14)}),
        "motorista": ("pessoafisica", "idfisica IS NOT NULL", {
            "idmotorista": "idfisica", "cnh": _text("H", "idfisica % 499"),
            "categoriacnh": "CASE WHEN idfisica % 13 = 0 THEN 'F' WHEN idfisica % 2 = 0 THEN 'B' ELSE 'AB' END",
            "idfisica": "CASE WHEN idfisica % 71 = 1 THEN idfisica + 1 ELSE idfisica END"}),
        "prontuario": ("veiculo", "idveiculo % 10 = 0", {
            "idprontuario": "idveiculo", "custo": _money("idveiculo % 300 - 10"), "idendereco": "idveiculo % 30",
            "idveiculo": "idveiculo"}),
        "avaria": ("locacao", "idveiculo % 20 = 1", {
            "idavaria": "idlocacao", "dtregistro": "dtretirada + INTERVAL '6' HOUR", "idlocacao": "idlocacao",
            "idveiculo": "idveiculo", "idprontuariorelacionado": "CASE WHEN idveiculo % 3 = 0 THEN NULL ELSE idveiculo - 1 END"}),
    },
    "B": {
        "empresa_locadora": ("patio", "id < 9", {"id": "id", "cnpj": _digits("id % 7", 14)}),
        "acessorio": ("patio", "id < 20", {"id": "id", "nome": _text("ACESSORIO ", "id % 15")}),
        "veiculo_acessorio": ("veiculo", "id % 5 = 0", {"veiculo_id": "id", "acessorio_id": "id % 22"}),
        "vaga": ("veiculo", "id % 2 = 0", {
            "codigo": _text("P", "id % 9"), "patio_id": "id % 120",
            "status": "CASE WHEN id % 23 = 0 THEN 'reservada' WHEN id % 4 = 0 THEN 'livre' ELSE 'ocupada' END"}),
        "seguro": ("patio", "id < 12", {"id": "id", "valor": _money("id * 7 - 10")}),
        "locacao_seguro": ("locacao", "veiculo_id % 4 = 0", {"locacao_id": "id", "seguro_id": "veiculo_id % 14"}),
        "foto": ("veiculo", "id % 3 = 0", {"id": "id", "veiculo_id": "id + 1"}),
        "manutencao": ("veiculo", "id % 7 = 0", {"id": "id", "veiculo_id": "id * 2"}),
    },
    "C": {
        "vaga": ("veiculo", "id_veiculo % 2 = 0", {"patio_id": "id_veiculo % 130", "codigo": _text("S", "id_veiculo % 8")}),
        "cliente_pf": ("cliente", "tipo_pessoa = 'PF'", {
            "cliente_id": "CASE WHEN id_cliente % 89 = 1 THEN id_cliente + 1000000 ELSE id_cliente END",
            "cpf": _digits("id_cliente % 1400"), "cnh_numero": _text("N", "id_cliente % 1300"),
            "cnh_categoria": "CASE WHEN id_cliente % 61 = 1 THEN 'ZZ' ELSE 'AB' END"}),
        "cliente_pj": ("cliente", "tipo_pessoa = 'PJ'", {"cliente_id": "id_cliente", "cnpj": _digits("id_cliente % 1200", 14)}),
        "condutor": ("cliente", "id_cliente % 3 <> 2", {
            "cliente_pj_id": "id_cliente - id_cliente % 3", "cpf": _digits("id_cliente - id_cliente % 2"),
            "cnh_numero": _text("M", "id_cliente % 700"), "cnh_categoria": "CASE WHEN id_cliente % 67 = 1 THEN 'F' ELSE 'D' END"}),
        "cobranca": ("locacao", "status <> 'EM_ANDAMENTO'", {
            "id_cobranca": "id_locacao", "locacao_id": "id_locacao", "valor_total": "valor_diaria_aplicada - 2000",
            "status": "CASE WHEN veiculo_id % 59 = 0 THEN 'ABERTA' ELSE 'PAGA' END"}),
    },
    "D": {
        "empresa": ("patio", "id_patio < 4", {"id_empresa": "id_patio"}),
        "condutor": ("cliente", "id_cliente % 5 <> 4", {
            "id_condutor": "id_cliente", "cpf": _digits("id_cliente % 1100"), "numero_cnh": _text("Q", "id_cliente % 900"),
            "validade_cnh": "DATE '1997-01-01' + CAST(id_cliente * 11 % 2000 AS INT)",
            "id_cliente": "CASE WHEN id_cliente % 97 = 0 THEN id_cliente + 1000000 ELSE id_cliente END"}),
        "pagamento": ("locacao", "valor_final IS NOT NULL", {
            "id_pagamento": "id_locacao", "valor_pagamento": "valor_final - 1500", "id_locacao": "id_locacao",
            "forma_pagamento": "CASE WHEN id_veiculo % 73 = 0 THEN 'CHEQUE' ELSE 'PIX' END",
            "tipo_pagamento": "CASE WHEN id_veiculo % 79 = 0 THEN 'SINAL' ELSE 'FINAL' END"}),
    },
}


def extended(base: dict[str, dict[str, DataFrame]]) -> dict[str, Lazy]:
    """The four sources with all columns and tables that their constraints name."""
    out = {}
    for p in "ABCD":
        def shape(t, p=p):
            extra = COLUMNS[p].get(t, {})
            return base[p][t].select("*", *[F.expr(e).alias(c) for c, e in extra.items()])

        def table(t, p=p):
            src, cond, cols = TABLES[p][t]
            return base[p][src].where(cond).select(*[F.expr(e).alias(c) for c, e in cols.items()])

        out[p] = Lazy({**{t: (lambda t=t, f=shape: f(t)) for t in base[p].keys()},
                       **{t: (lambda t=t, f=table: f(t)) for t in TABLES[p]}})
    return out


def declared_sources(spark: SparkSession, sf_dir: str) -> dict[str, Lazy]:
    return extended(Shapes(spark, sf_dir).all_sources())
