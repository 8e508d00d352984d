"""Every declared source constraint on rows that keep it and rows that violate it."""

import datetime as dt
from decimal import Decimal as D

import pytest

from fleetdw.plans import declared as C
from fleetdw.plans.quality import repeated_values

AS_OF = dt.date(2026, 1, 10)


def t(s):
    return dt.datetime.fromisoformat(s)


#: letter -> table -> (DDL, a row that keeps all checks, rule -> columns changed to violate it)
CASES = {
    "A": {
        "endereco": ("idendereco long, cep string", (1, "20000000"), {"cep": {"cep": "2000000"}}),
        "patio": ("idpatio long, lotacao int, horarioabertura string, horariofechamento string", (1, 1, "08:00:00", "08:00:01"),
                  {"lotacao": {"lotacao": 0}, "horario": {"horariofechamento": "08:00:00"}}),
        "vaga": ("idvaga long, andar int", (1, 0), {"andar": {"andar": -1}}),
        "categoria": ("idcategoria string, classeluxo string, valordiariabase decimal(10,2)", ("x", "C", D("0.00")),
                      {"classeluxo": {"classeluxo": "D"}, "valordiariabase": {"valordiariabase": D("-0.01")}}),
        "veiculo": ("idveiculo long, portas int, ultimakilometragem int, valordiaria decimal(10,2), altura decimal(5,2), "
                    "largura decimal(5,2)", (1, 1, 0, D("0"), D("0.01"), D("0.01")),
                    {"portas": {"portas": 0}, "ultimakilometragem": {"ultimakilometragem": -1},
                     "valordiaria": {"valordiaria": D("-1")}, "dimensoes": {"largura": D("0")}}),
        "pessoafisica": ("idfisica long, cpf string, dtnascimento date", (1, "1" * 11, dt.date(2026, 1, 9)),
                         {"cpf": {"cpf": "1" * 10}, "dtnascimento": {"dtnascimento": AS_OF}}),
        "empresa": ("idempresa long, cnpj string", (1, "1" * 14), {"cnpj": {"cnpj": "1" * 15}}),
        "motorista": ("idmotorista long, categoriacnh string", (1, "AE"), {"categoriacnh": {"categoriacnh": "BA"}}),
        "prontuario": ("idprontuario long, custo decimal(10,2)", (1, D("0")), {"custo": {"custo": D("-0.01")}}),
        "avaria": ("idavaria long, dtregistro timestamp_ntz", (1, t("2026-01-10 12:00:00")),
                   {"dtregistro": {"dtregistro": t("2026-01-10 12:00:01")}}),
    },
    "B": {
        "cliente": ("id long, tipo string", (1, "PF"), {"tipo": {"tipo": "pf"}}),
        "veiculo": ("id long, tipo_mecanizacao string, status string", (1, "manual", "alugado"),
                    {"tipo_mecanizacao": {"tipo_mecanizacao": "MANUAL"}, "status": {"status": "vendido"}}),
        "vaga": ("codigo string, status string", ("p", "livre"), {"status": {"status": "outra"}}),
        "locacao": ("id string, data_retirada_realizada timestamp_ntz, data_devolucao_realizada timestamp_ntz, km_entrega int, "
                    "km_devolucao int, data_retirada_prevista timestamp_ntz, data_devolucao_prevista timestamp_ntz",
                    ("x", t("2026-01-01"), t("2026-01-02"), 0, 0, t("2026-01-01"), t("2026-01-01")),
                    {"km_na_retirada": {"km_entrega": None}, "km_na_devolucao": {"km_devolucao": -1},
                     "datas_previstas": {"data_devolucao_prevista": t("2025-12-31")}}),
        "cobranca": ("locacao_id string, valor decimal(10,2), status string", ("x", D("0"), "pago"),
                     {"valor": {"valor": D("-1")}, "status": {"status": "PAGO"}}),
        "seguro": ("id long, valor decimal(10,2)", (1, D("0")), {"valor": {"valor": D("-1")}}),
    },
    "C": {
        "patio": ("id_patio long, capacidade_vagas int", (1, 0), {"capacidade_vagas": {"capacidade_vagas": -1}}),
        "grupo": ("id_grupo string, valor_diaria decimal(10,2), franquia_km_diaria int", ("g", D("0"), 0),
                  {"valor_diaria": {"valor_diaria": D("-1")}, "franquia_km_diaria": {"franquia_km_diaria": -1}}),
        "veiculo": ("id_veiculo long, mecanizacao string, km_atual int, situacao string", (1, "AUTOMATICA", 0, "BAIXADO"),
                    {"mecanizacao": {"mecanizacao": "AUTOMATICO"}, "km_atual": {"km_atual": -1}, "situacao": {"situacao": "LOCADO"}}),
        "cliente": ("id_cliente long, tipo_pessoa string", (1, "PJ"), {"tipo_pessoa": {"tipo_pessoa": "P"}}),
        "cliente_pf": ("cliente_id long, cnh_categoria string", (1, "AB"), {"cnh_categoria": {"cnh_categoria": "F"}}),
        "condutor": ("cpf string, cnh_categoria string", ("1", "E"), {"cnh_categoria": {"cnh_categoria": ""}}),
        "locacao": ("id_locacao string, km_saida int, km_chegada int", ("x", 0, 0),
                    {"km_saida": {"km_saida": -1}, "km_chegada": {"km_saida": 1}}),
        "cobranca": ("id_cobranca string, valor_total decimal(10,2), status string", ("x", D("0"), "PAGA"),
                     {"valor_total": {"valor_total": D("-1")}, "status": {"status": "paga"}}),
    },
    "D": {
        "cliente": ("id_cliente long, tipo_cliente string, estado string", (1, "PF", "RJ"),
                    {"tipo_cliente": {"tipo_cliente": "X"}, "estado": {"estado": "R"}}),
        "veiculo": ("id_veiculo long, mecanizacao string, status string", (1, "MANUAL", "RESERVADO"),
                    {"mecanizacao": {"mecanizacao": "AUTOMATICA"}, "status": {"status": "X"}}),
        "grupo_veiculo": ("id_grupo string, faixa_valor_diaria decimal(10,2)", ("g", D("0.01")),
                          {"faixa_valor_diaria": {"faixa_valor_diaria": D("0")}}),
        "condutor": ("id_condutor long, validade_cnh date", (1, AS_OF), {"validade_cnh": {"validade_cnh": dt.date(2026, 1, 9)}}),
        "locacao": ("id_locacao string, status_locacao string, data_hora_prev_devolucao timestamp_ntz, "
                    "data_hora_retirada timestamp_ntz", ("x", "ATIVA", t("2026-01-01"), t("2026-01-01")),
                    {"status_locacao": {"status_locacao": "x"},
                     "datas_previstas": {"data_hora_prev_devolucao": t("2025-12-31 23:59:59")}}),
        "pagamento": ("id_pagamento string, valor_pagamento decimal(10,2), forma_pagamento string, tipo_pagamento string",
                      ("x", D("0.01"), "PIX", "FINAL"),
                      {"valor_pagamento": {"valor_pagamento": D("0")}, "forma_pagamento": {"forma_pagamento": "x"},
                       "tipo_pagamento": {"tipo_pagamento": "x"}}),
    },
}


def test_the_catalogue_has_a_case_for_every_check(spark):
    have = {(p, n, r) for p, ts in C.checks(AS_OF).items() for n, rules in ts.items() for r in rules}
    assert have == {(p, n, r) for p, ts in CASES.items() for n, (_, _, bad) in ts.items() for r in bad}


@pytest.mark.parametrize("letter", "ABCD")
def test_checks(spark, letter):
    sources, want = {letter: {}}, {}
    for name, (ddl, good, bad) in CASES[letter].items():
        cols = [c.split()[0] for c in ddl.split(", ")]
        # a row that keeps all checks, one of nulls, and per rule one that violates it
        rows = [good, (good[0], *[None] * (len(good) - 1))]
        for rule, change in bad.items():
            rows.append(tuple(change.get(c, v) for c, v in zip(cols, good, strict=True)))
            want[f"{C.SYS_OF[letter]}.{name}.{rule}"] = 1
        sources[letter][name] = spark.createDataFrame(rows, ddl)
    got = {r.rule: r.n_violations for r in C.dq_source_checks(sources, AS_OF).collect()}
    assert got == want


def test_unique_keys_per_rule(spark):
    sources = {"B": {"vaga": spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 1), ("a", None), ("a", None)],
                                                   "codigo string, patio_id long")},
               "A": {"motorista": spark.createDataFrame([(1, "H", 1), (2, "H", 1), (3, None, 2), (3, None, None)],
                                                        "idmotorista long, cnh string, idfisica long")}}
    got = {r.rule: r.n_violations for r in C.dq_source_unique(sources).collect()}
    assert got == {"charge_total.vaga.pk": 1, "bay_level.motorista.pk": 1, "bay_level.motorista.cnh": 1,
                   "bay_level.motorista.idfisica": 1}


def test_a_table_is_read_once_for_all_its_keys(spark):
    df = spark.range(10).selectExpr("id", "id % 3 AS a", "id % 4 AS b")
    out = repeated_values([(df, {"pk": ["id"], "a": ["a"], "ab": ["a", "b"]})])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0, 10") == 1
    assert {r.rule: r.n_violations for r in out.collect()} == {"pk": 0, "a": 3, "ab": 0}


def test_references(spark):
    sources = {"C": {
        "cliente": spark.createDataFrame([(1,), (2,)], "id_cliente long"),
        "cliente_pj": spark.createDataFrame([(1,), (5,)], "cliente_id long"),
        "condutor": spark.createDataFrame([(1,), (2,), (5,), (None,), (2,)], "cliente_pj_id long")}}
    got = {r.rule: r.n_violations for r in C.dq_source_fk(sources).collect()}
    assert got == {"derived_moves.cliente_pj.cliente_id->derived_moves.cliente": 1,
                   "derived_moves.condutor.cliente_pj_id->derived_moves.cliente_pj": 2}


def test_every_reference_and_key_names_columns_of_the_test_data(spark):
    from fleetdw.sources.declared_shapes import declared_sources

    sources = declared_sources(spark, "/root/testdata/sf0.001")
    for p, tables in C.KEYS.items():
        for name, keys in tables.items():
            assert {c for k in keys for c in k} <= set(sources[p][name].columns), (p, name)
    for p, children in C.REFERENCES.items():
        for child, refs in children.items():
            assert set(refs) <= set(sources[p][child].columns) and set(refs.values()) <= set(C.KEYS[p])


def test_repeated_values_sends_eight_bytes_a_key(spark, monkeypatch):
    from fleetdw.plans import quality as Q

    seen, was = [], Q.repeated_hashes
    monkeypatch.setattr(Q, "repeated_hashes", lambda rows, by: seen.append([rows.schema[c].dataType.simpleString() for c in by])
                        or was(rows, by))
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, "y"), (None, None), (None, None), (3, "y")], "id int, a string")
    for limit in (0, 1_000_000):
        monkeypatch.setattr(Q, "SUSPECTS", limit)
        out = Q.repeated_values([(df, {"pk": ["id"], "a": ["a"], "both": ["id", "a"]})])
        assert sorted(map(tuple, out.collect())) == [("a", 1), ("both", 0), ("pk", 1)]
    assert seen == [["int", "bigint"]] * 2
