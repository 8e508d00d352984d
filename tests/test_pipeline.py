"""End-to-end on the hand-made source rows: one assertion per documented
behaviour (FIXTURES.md §4, SURVEY §2.X)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fleetdw.plans import markov as M
from fleetdw.plans import quality as Q
from fleetdw.plans import reports as R
from fleetdw.plans import source_views as V
from fleetdw.plans.facts import discards
from fleetdw.plans.star import build_from_sources, load
from fleetdw.schemas import NOT_INFORMED, SYS_A, SYS_B, SYS_C, SYS_D
from fleetdw.sources.extract import extract_all

from fixtures import AS_OF, sources


@pytest.fixture(scope="module")
def wh(spark):
    return build_from_sources(spark, sources(spark))


@pytest.fixture(scope="module")
def dw(wh):
    return wh.tables()


def test_extract_address_concat_and_cost_centre(spark):
    stg = extract_all(sources(spark))
    loc = {r.id_patio_origem: r.localizacao for r in stg["A"]["patio"].collect()}
    assert loc["10"] == "Rua A, 10 - Centro - RJ"
    assert loc["12"] is None  # one NULL piece -> NULL (|| semantics)
    cli = {r.id_cliente_origem: (r.tipo_cliente, r.nome_cliente, r.cidade_origem, r.estado_origem)
           for r in stg["A"]["cliente"].collect()}
    assert cli == {"1": ("PF", "Ana", "Rio", "RJ"), "2": ("PJ", "ACME", "Sao Paulo", "SP")}


def test_whole_days_and_totals(wh):
    std = {r.id_locacao_origem: r for r in wh.table("std_locacao").collect()}
    assert std["A1"].dias_locacao == 1 and std["A1"].valor_total == Decimal("80.00")
    assert std["B1"].dias_locacao == 0 and std["B1"].valor_total == Decimal("100.00")
    assert std["D2"].valor_total == Decimal("210.00") and std["D2"].valor_diaria is None
    assert std["C1"].dt_devolucao_prevista == dt.datetime(2026, 1, 8, 10)  # planned return via reservation
    assert std["B2"].dt_devolucao_prevista is None  # walk-in


def test_group_gearbox_conflict_keeps_one_row(wh, dw):
    std = wh.table("std_grupo").where(F.col("id_sistema_origem") == SYS_C).collect()
    assert sorted(r.mecanizacao for r in std) == ["AUTOMATICO", "MANUAL"]
    dims = {(r.id_sistema_origem, r.nome_grupo): r.mecanizacao for r in dw["dim_grupo"].collect()}
    assert dims == {(SYS_A, "ECONOMICO"): None, (SYS_B, "SUV"): "AUTOMATICO", (SYS_C, "HATCH"): "AUTOMATICO",
                    (SYS_D, "SEDAN"): "MANUAL"}


def test_shared_plate_first_source_wins(dw):
    v = {r.placa: r.id_sistema_origem for r in dw["dim_veiculo"].collect()}
    assert v["SHARED1"] == SYS_A and len(v) == 7


def test_surrogate_keys_dense(dw):
    for name, sk in [("dim_patio", "sk_patio"), ("dim_cliente", "sk_cliente"), ("dim_veiculo", "sk_veiculo"),
                     ("dim_grupo", "sk_grupo")]:
        keys = sorted(r[0] for r in dw[name].select(sk).collect())
        assert keys == list(range(1, len(keys) + 1))


def test_fact_rental_discards(spark, wh, dw):
    kept = {r.id_locacao_origem: r for r in dw["fato_locacao"].collect()}
    assert sorted(kept) == ["A1", "A2", "B2", "C1", "C2", "C3", "D2"]
    assert kept["B2"].valor_diaria == Decimal("100.00")
    assert kept["D2"].valor_diaria == Decimal("105.00")
    assert kept["A2"].sk_tempo_devolucao_prevista == 99991231
    acc = {(r.fato, r.motivo, r.id_sistema_origem): r.n_descartes
           for r in discards(wh.std(), wh.dims()).collect()}
    assert acc == {("fato_locacao", "valor_diaria_irresolvivel", SYS_B): 1,
                   ("fato_locacao", "valor_diaria_irresolvivel", SYS_D): 1,
                   ("fato_locacao", "veiculo_ausente", SYS_C): 1,
                   ("fato_movimentacao_patio", "veiculo_ausente", SYS_C): 1}


def test_derived_movements_skip_same_yard(wh):
    ids = {r.id_movimentacao_origem for r in wh.table("std_movimentacao").where(
        F.col("id_sistema_origem") == SYS_C).collect()}
    assert ids == {"LOC-C3", "LOC-C4"}


def test_open_rentals_report(dw):
    rows = {r.placa: r for r in R.open_rentals(dw, as_of=AS_OF).collect()}
    assert set(rows) == {"SHARED1", "CCC2222"}
    assert rows["SHARED1"].dias_restantes_devolucao is None and rows["SHARED1"].em_atraso is None
    assert rows["CCC2222"].dias_restantes_devolucao == -2 and rows["CCC2222"].em_atraso is True
    assert rows["CCC2222"].dias_contratados is None


def test_reservation_demand_buckets_and_cancelled(dw):
    rows = R.reservation_demand(dw, as_of=AS_OF).collect()
    got = {(r.sistema_origem, r.horizonte_retirada, r.faixa_duracao, r.nome_patio) for r in rows}
    assert got == {(SYS_B, "Esta Semana", "Até 3 dias", "Yard X"), (SYS_D, "Esta Semana", "Até 3 dias", "D-Porto")}
    assert all(r.nome_grupo == NOT_INFORMED for r in rows)
    strict = R.reservation_demand(dw, as_of=AS_OF, strict_reference=True).collect()
    a = [r for r in strict if r.sistema_origem == SYS_A]
    assert len(a) == 1 and a[0].nome_patio == NOT_INFORMED and a[0].faixa_duracao == NOT_INFORMED


def test_horizon_and_duration_edges(spark):
    today = F.lit(AS_OF).cast("date")
    offsets = [1, 7, 8, 14, 15, 30, 31, 90, 91]
    df = spark.createDataFrame([(o,) for o in offsets], "o int").select(
        "o", R.horizon_bucket(F.date_add(today, F.col("o")), today).alias("h"))
    assert [r.h for r in df.orderBy("o").collect()] == [
        "Esta Semana", "Esta Semana", "Próxima Semana", "Próxima Semana", "Este Mês", "Este Mês",
        "Próximos 3M", "Próximos 3M", "Mais de 3M"]
    days = [0, 3, 4, 7, 8, 15, 16, None]
    dd = spark.createDataFrame([(i, x) for i, x in enumerate(days)], "i int, n int").select(
        "i", R.duration_bucket(F.date_add(today, F.col("n")), today).alias("b"))
    assert [r.b for r in dd.orderBy("i").collect()] == [
        "Até 3 dias", "Até 3 dias", "4 a 7 dias", "4 a 7 dias", "8 a 15 dias", "8 a 15 dias", "Mais de 15 dias",
        NOT_INFORMED]


def test_markov_probabilities(dw):
    long = [r for r in M.transition_long(dw["fato_movimentacao_patio"], dw["dim_patio"]).collect()
            if r.patio_origem == "Yard X"]
    got = sorted((r.patio_destino, r.movimentacoes, r.total_saidas_origem, r.pct_transicao) for r in long)
    # two yards named alike (A and B) stay separate origins; in-transit move is absent
    assert got == [("A-Norte", 1, 3, Decimal("33.33")), ("A-Sul", 2, 3, Decimal("66.67")),
                   ("B-Leste", 1, 1, Decimal("100.00"))]
    wide = M.transition_matrix(dw["fato_movimentacao_patio"], dw["dim_patio"],
                               ["A-Norte", "A-Sul", "B-Leste", "Nowhere"]).collect()
    rows = sorted((tuple(r) for r in wide if r.patio_origem == "Yard X"), key=lambda r: r[-1])
    assert rows == [("Yard X", None, None, Decimal("100.00"), None, 1),
                    ("Yard X", Decimal("33.33"), Decimal("66.67"), None, None, 3)]
    origins = {r.patio_origem for r in M.transition_counts(dw["fato_movimentacao_patio"], dw["dim_patio"]).collect()}
    assert "A-Norte" not in origins  # its only move is in transit


def test_markov_rows_sum_to_total(dw):
    rows = M.transition_long(dw["fato_movimentacao_patio"], dw["dim_patio"]).collect()
    by_origin = {}
    for r in rows:
        by_origin.setdefault((r.patio_origem, r.total_saidas_origem), []).append(r)
    for (_, total), rs in by_origin.items():
        assert sum(r.movimentacoes for r in rs) == total
        assert abs(sum(r.pct_transicao for r in rs) - 100) <= Decimal("0.01") * len(rs)


def test_top_groups_rank_ties(spark):
    dims_g = spark.createDataFrame([(1, "G1", None, None, "S"), (2, "G2", None, None, "S"), (3, "G3", None, None, "S")],
                                   "sk_grupo long, nome_grupo string, mecanizacao string, classe_luxo string, "
                                   "id_sistema_origem string")
    dims_c = spark.createDataFrame([(1, "Rio", "RJ", "PF")],
                                   "sk_cliente long, cidade_origem string, estado_origem string, tipo_cliente string")
    facts = [(g, 1, Decimal("10.00"), 1, Decimal("10.00"), None, "S")
             for g, n in [(1, 5), (2, 5), (3, 3)] for _ in range(n)]
    fl = spark.createDataFrame(facts, "sk_grupo long, sk_cliente long, valor_diaria decimal(10,2), dias_locacao int, "
                                      "valor_total decimal(10,2), id_reserva_origem string, id_sistema_origem string")
    fr = spark.createDataFrame([], "id_sistema_origem string, id_reserva_origem string, qt_veiculos_solicitados int")
    out = R.top_groups({"fato_locacao": fl, "fato_reserva": fr, "dim_grupo": dims_g, "dim_cliente": dims_c})
    assert sorted((r.nome_grupo, r.ranking_grupo) for r in out.collect()) == [("G1", 1), ("G2", 1), ("G3", 3)]


def test_fleet_and_top_groups_run(dw):
    fleet = {(r.sistema_origem, r.modelo): r.qt_veiculos for r in R.fleet_by_group(dw).collect()}
    assert fleet[(SYS_A, "Gol")] == 1 and (SYS_C, "Up") not in fleet
    top = {(r.sistema_origem, r.nome_grupo): r for r in R.top_groups(dw).collect()}
    a = top[(SYS_A, "ECONOMICO")]
    # D1: requested vehicles come from the rental's reservation (A1, A2 -> reservation 1, qt 2)
    assert a.qt_locacoes == 2 and a.qt_veiculos_solicitados == 4 and a.media_dias_locacao == Decimal("1.0")


def test_source_views_keep_same_yard_pairs(spark):
    c = sources(spark)["C"]
    pairs = {(r.patio_retirada, r.patio_devolucao): r.total_locacoes for r in V.completed_by_yard_pair(c).collect()}
    assert pairs == {("C-Centro", "C-Centro"): 1, ("C-Centro", "C-Praia"): 1, ("C-Praia", "C-Centro"): 1}
    assert {r.grupo: r.total_locacoes for r in V.rentals_in_progress(c).collect()} == {"HAT": 1}


def test_quality_rules(spark, wh):
    std = wh.std()
    width = {r.rule: r.n_violations for r in Q.dq_width(std).collect()}
    assert width["dim_veiculo.chassi>30"] == 1
    xor = {r.rule: r.n_violations for r in Q.dq_xor(sources(spark)["A"], std).collect()}
    assert xor == {"bay_level.centrocusto.pf_xor_pj": 0, "charge_total.movimentacao.origem_igual_destino": 0,
                   "quoted_total.movimentacao.origem_igual_destino": 1}
    uniq = {r.rule: r.n_violations for r in Q.dq_unique(std, wh.tables(), sources(spark)).collect()}
    assert uniq["std_veiculo.placa"] == 1 and uniq["std_grupo.pk"] == 2


def test_reload_inserts_nothing(spark, wh):
    before = {n: sorted(tuple(r) for r in wh.table(n).collect()) for n in ("dim_patio", "dim_veiculo", "fato_locacao")}
    load(spark, wh)
    after = {n: sorted(tuple(r) for r in wh.table(n).collect()) for n in before}
    assert before == after
    assert set(wh.inserted) >= {"dim_tempo", "dim_patio", "fato_locacao"} and not any(wh.inserted.values())


def test_update_mode_refreshes_returned_rental(spark):
    from fixtures import ROWS, SCHEMAS, t

    from fleetdw.plans.star import StarStore, stage_sources

    wh_ignore = build_from_sources(spark, sources(spark))
    wh_update = build_from_sources(spark, sources(spark))
    sk_before = {r.id_locacao_origem: r.sk_locacao for r in wh_update.table("fato_locacao").collect()}
    rows = {p: dict(tables) for p, tables in ROWS.items()}
    # C1 was open at the first load and is returned before the second one
    rows["C"]["locacao"] = [r if r[0] != "C1" else
                            ("C1", 1, 1, 2, 30, 31, t("2026-01-02 10:00:00"), t("2026-01-09 11:00:00"),
                             Decimal("50.00"), "CONCLUIDA") for r in ROWS["C"]["locacao"]]
    changed = {p: {n: spark.createDataFrame(rows[p][n], ddl) for n, ddl in tables.items()}
               for p, tables in SCHEMAS.items()}
    for wh, mode in ((wh_ignore, "ignore"), (wh_update, "update")):
        stage_sources(changed, wh)
        load(spark, wh, mode=mode)
    c1_ignore = wh_ignore.table("fato_locacao").where(F.col("id_locacao_origem") == "C1").collect()
    c1_update = wh_update.table("fato_locacao").where(F.col("id_locacao_origem") == "C1").collect()
    assert len(c1_ignore) == 1 and c1_ignore[0].status == "EM_ANDAMENTO"
    assert len(c1_update) == 1 and c1_update[0].status == "CONCLUIDA" and c1_update[0].dias_locacao == 7
    assert c1_update[0].sk_locacao == sk_before["C1"]
    assert wh_update.table("fato_locacao").count() == len(sk_before)
    assert sorted(r.sk_patio for r in wh_update.table("dim_patio").collect()) == list(range(1, 9))
    # versions are found on disk: an object of another process reads the update and adds nothing
    other = StarStore(spark, wh_update.root)
    assert other.table("fato_locacao").where("id_locacao_origem = 'C1'").first().status == "CONCLUIDA"
    load(spark, other)
    assert set(other.inserted.values()) == {0}


def test_parquet_source_layout_round_trip(spark, dw):
    from fleetdw.session import fresh_scratch
    from fleetdw.sources.oltp import parquet_sources, write_parquet_sources

    root = fresh_scratch(spark, "oltp")
    write_parquet_sources(sources(spark), root)
    wh2 = build_from_sources(spark, parquet_sources(spark, root))
    for name in ("fato_locacao", "fato_reserva", "fato_movimentacao_patio", "dim_veiculo"):
        keys = [c for c in dw[name].columns if c.startswith("sk_") and c not in ("sk_tempo",) and "tempo" not in c]
        a = sorted((tuple(r) for r in dw[name].drop(*keys).collect()), key=repr)
        b = sorted((tuple(r) for r in wh2.table(name).drop(*keys).collect()), key=repr)
        assert a == b, name


def test_persisted_staging_never_refreshes(spark):
    """D11: with the reference's persisted staging, a rental staged while open stays
    open even under mode="update"; re-staging is idempotent."""
    from fixtures import ROWS, SCHEMAS, t

    from fleetdw.plans.star import stage_sources

    wh = build_from_sources(spark, sources(spark), persist_staging_tables=True)
    n_stg = spark.read.parquet(wh.path("stg", "c_locacao")).count()
    rows = {p: dict(tables) for p, tables in ROWS.items()}
    rows["C"]["locacao"] = [r if r[0] != "C1" else
                            ("C1", 1, 1, 2, 30, 31, t("2026-01-02 10:00:00"), t("2026-01-09 11:00:00"),
                             Decimal("50.00"), "CONCLUIDA") for r in ROWS["C"]["locacao"]]
    changed = {p: {n: spark.createDataFrame(rows[p][n], ddl) for n, ddl in tables.items()}
               for p, tables in SCHEMAS.items()}
    stage_sources(changed, wh, persist_staging_tables=True)
    load(spark, wh, mode="update")
    assert spark.read.parquet(wh.path("stg", "c_locacao")).count() == n_stg
    c1 = wh.table("fato_locacao").where(F.col("id_locacao_origem") == "C1").collect()
    assert len(c1) == 1 and c1[0].status == "EM_ANDAMENTO"


def test_markov_matrix_has_the_listed_columns(dw):
    names = [r.nome_patio for r in M.yard_columns(dw["dim_patio"]).collect()]
    wide = M.transition_matrix(dw["fato_movimentacao_patio"], dw["dim_patio"], names)
    assert wide.columns == ["patio_origem", *names, "total_saidas_origem"]
    row = [r for r in wide.collect() if r.patio_origem == "Yard X" and r.total_saidas_origem == 3][0]
    assert row["A-Sul"] == Decimal("66.67") and row["B-Leste"] is None


def test_failing_file_system_is_not_an_absent_table(spark):
    from fleetdw.plans.star import StarStore

    with pytest.raises(Exception, match="nosuchfs"):
        StarStore(spark, "nosuchfs://somewhere/root").exists("dw", "dim_patio")


def test_new_dimension_member_gets_next_key(spark):
    """L0 on a later load: existing keys unchanged, a new yard gets max + 1."""
    from fixtures import ROWS, SCHEMAS

    from fleetdw.plans.star import stage_sources

    wh = build_from_sources(spark, sources(spark))
    before = {(r.id_sistema_origem, r.id_patio_origem): r.sk_patio for r in wh.table("dim_patio").collect()}
    rows = {p: dict(tables) for p, tables in ROWS.items()}
    rows["D"]["patio"] = ROWS["D"]["patio"] + [(39, "D-Aeroporto", "Terminal 1")]
    changed = {p: {n: spark.createDataFrame(rows[p][n], ddl) for n, ddl in tables.items()}
               for p, tables in SCHEMAS.items()}
    stage_sources(changed, wh)
    load(spark, wh)
    after = {(r.id_sistema_origem, r.id_patio_origem): r.sk_patio for r in wh.table("dim_patio").collect()}
    assert {k: after[k] for k in before} == before
    assert after[(SYS_D, "39")] == max(before.values()) + 1
    assert wh.inserted["dim_patio"] == 1 and wh.inserted["fato_locacao"] == 0
