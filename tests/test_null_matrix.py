"""Documented NULL matrix per source: which conformed columns each source cannot
fill (SURVEY §5), checked on the driver data."""

import os

import pytest
from pyspark.sql import functions as F

from fleetdw.plans.star import store_for
from fleetdw.schemas import SYS_A, SYS_B, SYS_C, SYS_D

SF = "/root/testdata/sf0.001"
ALL = {SYS_A, SYS_B, SYS_C, SYS_D}

# table -> column -> sources where the column is always NULL
NULL_MATRIX = {
    "std_patio": {"cidade": {SYS_C, SYS_D}, "localizacao": {SYS_B}},
    "std_cliente": {"estado_origem": {SYS_B, SYS_C}},
    "std_veiculo": {"marca": {SYS_A}, "cor": {SYS_A}, "ano": {SYS_B, SYS_D}, "mecanizacao": {SYS_A}},
    "std_grupo": {"id_grupo_origem": ALL, "classe_luxo": ALL, "valor_diaria_base": ALL},
    "std_reserva": {"antecedencia_dias": {SYS_B}, "dt_reserva": {SYS_B}, "qt_veiculos_solicitados": {SYS_B, SYS_C, SYS_D},
                    "dt_devolucao_prevista": {SYS_A}, "id_grupo_origem": {SYS_A},
                    "id_patio_retirada_origem": {SYS_A}, "id_patio_devolucao_origem": {SYS_A}},
    "std_locacao": {"valor_diaria": {SYS_B, SYS_D}, "km_rodados": ALL, "dt_devolucao_prevista": {SYS_A, SYS_D}},
    "std_movimentacao": {"motivo": {SYS_A, SYS_B, SYS_C}, "dt_chegada_destino": {SYS_B, SYS_D}},
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.mark.parametrize("table", sorted(NULL_MATRIX))
def test_null_matrix(spark, table):
    df = store_for(spark, SF).table(table)
    cols = NULL_MATRIX[table]
    agg = df.groupBy("id_sistema_origem").agg(
        *[F.count(F.col(c)).alias(c) for c in cols], F.count(F.lit(1)).alias("__n")).collect()
    assert {r.id_sistema_origem for r in agg} == ALL
    for r in agg:
        assert r["__n"] > 0
        for c, nulls in cols.items():
            if r.id_sistema_origem in nulls:
                assert r[c] == 0, (table, c, r.id_sistema_origem)
            else:
                assert r[c] > 0, (table, c, r.id_sistema_origem)
