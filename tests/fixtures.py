"""Hand-made rows in the four source shapes (FIXTURES.md §1) covering the edge
cases of FIXTURES.md §4. Report "today" for these rows is AS_OF below."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from fleetdw.sources.oltp import SOURCE_SCHEMAS

AS_OF = dt.date(2026, 1, 10)


def t(s: str | None):
    return None if s is None else dt.datetime.fromisoformat(s)


def d(s: str | None):
    return None if s is None else dt.date.fromisoformat(s)


SCHEMAS = SOURCE_SCHEMAS

ROWS = {
    "A": {
        "endereco": [(1, "RJ", "Rio", "Centro", "Rua A", "10"), (2, "SP", "Sao Paulo", "Se", "Rua B", "20"),
                     (3, "MG", "BH", "Savassi", "Rua C", None)],
        "patio": [(10, "Yard X", 1), (11, "A-Norte", 2), (12, "A-Sul", 3)],
        "vaga": [(100, 10), (110, 11), (120, 12)],
        "categoria": [("ECO", "ECONOMICO")],
        "veiculo": [(1, "AAA1111", "CHA1", "Gol", 2020, True, "ECO"), (2, "SHARED1", "CHA2", "Uno", 2019, False, "ECO")],
        "pessoafisica": [(1, "Ana", 1)],
        "empresa": [(2, "ACME", 2)],
        "centrocusto": [(1, None, 1), (2, 2, None)],
        "reserva": [(1, 2, t("2025-12-20 10:00:00"), t("2026-01-01 12:00:00"), t("2026-01-02 12:00:00"), "Atendida", 1),
                    (2, 1, t("2026-01-05 08:00:00"), t("2026-01-15 09:00:00"), t("2026-01-16 09:00:00"), "Cancelada", 2)],
        "locacao": [("A1", D("80.00"), t("2026-01-01 12:00:00"), t("2026-01-03 10:00:00"), 100, 110, 1, 1),
                    ("A2", D("80.00"), t("2026-01-05 12:00:00"), None, 100, None, 2, 1)],
        "movimentacao": [("M1", t("2026-01-02 00:00:00"), t("2026-01-01 00:00:00"), 1, 100, 110),
                         ("M2", t("2026-01-03 00:00:00"), t("2026-01-02 00:00:00"), 1, 100, 120),
                         ("M3", t("2026-01-04 00:00:00"), t("2026-01-03 00:00:00"), 1, 100, 120),
                         ("M4", t("2026-01-05 00:00:00"), t("2026-01-04 00:00:00"), 2, 110, None)],
    },
    "B": {
        "cliente": [(1, "Bruno", "PF", "Campinas")],
        "condutor": [(7, 1)],
        "grupo_veiculo": [("G1", "SUV")],
        "veiculo": [(1, "BBB1111", "CHB1", "Compass", "Jeep", "Preto", "manual", True, "G1"),
                    (2, "BBB2222", "CHB2", "Renegade", "Jeep", "Azul", "automatico", True, "G1")],
        "patio": [(20, "Yard X", "Campinas"), (21, "B-Leste", "Campinas")],
        "reserva": [(1, 1, "G1", 20, 21, d("2026-01-12"), d("2026-01-15"), "ativa"),
                    (2, 1, "G1", 20, 21, d("2026-01-20"), d("2026-01-20"), "cancelada")],
        "locacao": [("B1", 1, 1, 7, 20, 21, t("2026-01-01 09:00:00"), t("2026-01-01 18:00:00")),
                    ("B2", None, 2, 7, 20, 21, t("2026-01-02 10:00:00"), t("2026-01-05 10:00:00"))],
        "cobranca": [("B1", D("100.00")), ("B2", D("300.00"))],
        "movimentacao_patio": [("BM1", 1, 20, 21, t("2026-01-03 08:00:00"))],
    },
    "C": {
        "patio": [(30, "C-Centro", "Av 1"), (31, "C-Praia", "Av 2")],
        "grupo": [("G9", "HATCH", "HAT")],
        "veiculo": [(1, "G9", "CCC1111", "CHC1", "VW", "Fox", "Branco", 2018, "MANUAL", True, 30, "DISPONIVEL"),
                    (2, "G9", "CCC2222", "CHC2", "VW", "Polo", "Cinza", 2021, "AUTOMATICA", True, 30, "LOCADO"),
                    (3, "G9", "SHARED1", "CHC3", "VW", "Up", "Verde", 2017, "MANUAL", False, 31, "DISPONIVEL")],
        "cliente": [(1, "PJ", "Casa Ltda", "Niteroi")],
        "reserva": [(1, 1, "G9", 30, 31, t("2026-01-01 10:00:00"), t("2026-01-02 10:00:00"), t("2026-01-08 10:00:00"),
                     "CONCRETIZADA")],
        "locacao": [("C1", 1, 1, 2, 30, 31, t("2026-01-02 10:00:00"), None, D("50.00"), "EM_ANDAMENTO"),
                    ("C2", None, 1, 1, 30, 30, t("2026-01-01 10:00:00"), t("2026-01-04 10:00:00"), D("60.00"), "CONCLUIDA"),
                    ("C3", None, 1, 1, 30, 31, t("2026-01-04 11:00:00"), t("2026-01-06 11:00:00"), D("60.00"), "CONCLUIDA"),
                    ("C4", None, 1, 3, 31, 30, t("2026-01-04 11:00:00"), t("2026-01-05 12:00:00"), D("70.00"), "CONCLUIDA")],
    },
    "D": {
        "patio": [(40, "D-Porto", "Rua do Porto")],
        "grupo_veiculo": [("G5", "SEDAN")],
        "cliente": [(1, "PF", "Duda", "Recife", "PE")],
        "veiculo": [(1, "DDD1111", "D-" + "x" * 40, "Fiat", "Cronos", "Prata", "MANUAL", True, "G5")],
        "reserva": [(1, d("2026-01-01"), d("2026-01-11"), d("2026-01-11"), "ATIVA", 1, "G5", 40, 40)],
        "locacao": [("D1", t("2026-01-03 10:00:00"), None, D("300.00"), None, 1, 1, 1, 40, None),
                    ("D2", t("2026-01-01 10:00:00"), t("2026-01-03 12:00:00"), D("200.00"), D("210.00"), None, 1, 1,
                     40, 40)],
        "movimentacao_patio": [("DM1", t("2026-01-02 00:00:00"), "manutencao", 1, 40, 40)],
    },
}


def sources(spark):
    return {p: {name: spark.createDataFrame(ROWS[p][name], ddl) for name, ddl in tables.items()}
            for p, tables in SCHEMAS.items()}
