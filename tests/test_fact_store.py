"""Facts by month and state: pruned conflict checks, updates of touched partitions only."""

import datetime as dt
import glob
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from fleetdw.operators.insert_ignore import dedup_batch, insert_ignore
from fleetdw.plans import fact_store as FS
from fleetdw.plans import reports as R
from fleetdw.plans.facts import fato_locacao_rows
from fleetdw.plans.star import build_from_sources, load, stage_sources
from fleetdw.schemas import NATURAL_KEYS

from fixtures import AS_OF, ROWS, SCHEMAS, sources, t


def files(wh, name):
    root = wh.table_path(name)
    return {os.path.relpath(f, root): os.stat(f).st_mtime_ns for f in glob.glob(f"{root}/**/*.parquet", recursive=True)}


def scans(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(
        "formatted"))


def changed(spark, letter, table, edit):
    rows = {p: dict(tables) for p, tables in ROWS.items()}
    rows[letter][table] = edit(list(rows[letter][table]))
    return {p: {n: spark.createDataFrame(rows[p][n], ddl) for n, ddl in tables.items()} for p, tables in SCHEMAS.items()}


def later_return(rows):
    from decimal import Decimal

    return [r if r[0] != "C1" else ("C1", 1, 1, 2, 30, 31, t("2026-01-02 10:00:00"), t("2026-01-09 11:00:00"), Decimal("50.00"),
                                    "CONCLUIDA") for r in rows]


def test_layout(spark):
    wh = build_from_sources(spark, sources(spark))
    got = {(r.situacao, r.mes) for r in wh.table("fato_locacao").select("situacao", "mes").distinct().collect()}
    assert got == {("aberta", 202601), ("fechada", 202601)}
    for name, lay in FS.LAYOUTS.items():
        bad = wh.table(name).where(~F.col("mes").eqNullSafe(FS.month_of(F.col(lay.date))))
        assert bad.count() == 0
    kept = {r.id_locacao_origem: r.qt_veiculos_reserva for r in wh.table("fato_locacao").collect()}
    assert kept["A1"] == 2 and kept["B2"] is None and kept["C1"] == 1


def test_conflict_check_reads_the_months_of_the_batch(spark):
    wh = build_from_sources(spark, sources(spark))
    assert wh.dates_fixed()
    fact = wh.table("fato_locacao")
    months = FS.hit_months("fato_locacao", wh.table("std_locacao"))
    assert months == [202601]
    plan = scans(fato_locacao_rows(wh.table("std_locacao"), wh.dims(), FS.in_months(fact, months), 7))
    scan = [x for x in plan.split("\n\n") if "Scan parquet" in x and "fato_locacao" in x]
    assert scan and all(re.search(r"PartitionFilters: \[.*mes#\d+(L|) (IN|INSET|=)", x) for x in scan)
    # the fact's side is two key columns, and reaches its join by a broadcast
    assert all("ReadSchema: struct<id_locacao_origem:string>" in x for x in scan)
    assert FS.in_months(fact, [199901]).count() == 0


def test_a_key_that_comes_again_with_another_date_is_still_ignored(spark):
    wh = build_from_sources(spark, sources(spark))
    before = wh.table("fato_locacao").count()
    moved = changed(spark, "C", "locacao", lambda rows: [
        (r[0], *r[1:6], r[6] + dt.timedelta(days=90), r[7] and r[7] + dt.timedelta(days=90), *r[8:]) for r in rows])
    stage_sources(moved, wh)  # not through the staging: dates may vary from now on
    assert not wh.dates_fixed()
    load(spark, wh)
    assert wh.table("fato_locacao").count() == before and wh.inserted["fato_locacao"] == 0
    stage_sources(sources(spark), wh, persist_staging_tables=True)
    load(spark, wh)
    assert not wh.dates_fixed() and wh.inserted["fato_locacao"] == 0


def test_update_rewrites_touched_partitions_only(spark):
    wh = build_from_sources(spark, sources(spark))
    old = {n: files(wh, n) for n in FS.LAYOUTS}
    keys = {r.id_locacao_origem: r.sk_locacao for r in wh.table("fato_locacao").collect()}
    stage_sources(changed(spark, "C", "locacao", later_return), wh)
    load(spark, wh, mode="update")
    new = {n: files(wh, n) for n in FS.LAYOUTS}
    assert new["fato_reserva"] == old["fato_reserva"]
    # the derived move of the returned rental is new; no other source is touched
    for name in ("fato_locacao", "fato_movimentacao_patio"):
        touched = {f for f in {*old[name], *new[name]} if old[name].get(f) != new[name].get(f)}
        assert touched and all("id_sistema_origem=derived_moves" in f for f in touched)
    # C1 was the only open rental of its source: its partition is gone, not empty
    assert not any("derived_moves/situacao=aberta" in f for f in new["fato_locacao"])
    rows = {r.id_locacao_origem: r for r in wh.table("fato_locacao").collect()}
    assert {k: r.sk_locacao for k, r in rows.items()} == keys
    assert rows["C1"].status == "CONCLUIDA" and rows["C1"].situacao == "fechada"
    # the same update again changes nothing at all
    stage_sources(changed(spark, "C", "locacao", later_return), wh)
    load(spark, wh, mode="update")
    assert {n: files(wh, n) for n in FS.LAYOUTS} == new and wh.inserted["fato_locacao"] == 0


def test_an_update_that_died_is_finished_by_the_next_load(spark):
    wh = build_from_sources(spark, sources(spark))
    path, fact = wh.table_path("fato_locacao"), wh.table("fato_locacao")
    batch = FS.laid_out("fato_locacao", fact.drop("sk_locacao", "mes", "situacao").where("id_locacao_origem = 'C1'")
                        .withColumn("sk_tempo_devolucao", F.lit(20260109)).withColumn("status", F.lit("CONCLUIDA")))
    batch = batch.select(*[c for c in fact.columns if c != "sk_locacao"])
    keys = NATURAL_KEYS["fato_locacao"]
    changes = FS.differing("fato_locacao", fact, batch, keys, "sk_locacao", 1000, small=True)
    changes = spark.createDataFrame(changes.collect(), changes.schema)
    before = files(wh, "fato_locacao")
    FS.refresh("fato_locacao", path, fact, changes, keys, finish=lambda: None)  # dies here
    assert files(wh, "fato_locacao") == before
    load(spark, wh)
    rows = {r.id_locacao_origem: r.status for r in wh.table("fato_locacao").collect()}
    assert rows["C1"] == "CONCLUIDA" and len(rows) == 7
    assert not FS.finish_pending(spark, "fato_locacao", path)


def test_open_rentals_reads_open_partitions(spark):
    wh = build_from_sources(spark, sources(spark))
    plan = scans(R.open_rentals(wh.tables(), wh.counts, as_of=AS_OF))
    assert re.search(r"PartitionFilters: \[.*situacao#\d+ = aberta", plan)
    plan = scans(R.reservation_demand(wh.tables(), wh.counts, as_of=AS_OF))
    assert re.search(r"PartitionFilters: \[.*mes#\d+ >= 202601", plan)


def test_top_groups_joins_no_second_fact(spark):
    wh = build_from_sources(spark, sources(spark))
    assert "fato_reserva" not in scans(R.top_groups(wh.tables(), wh.counts))


@pytest.mark.parametrize("seed", range(6))
def test_update_against_a_model(spark, seed):
    """Random batches: the table is what replacing rows by key gives, keys of known rows stay."""
    g = random.Random(seed)
    from pyspark.sql import types as T

    cols = T.StructType([T.StructField("id_movimentacao_origem", T.StringType()), T.StructField("sk_tempo", T.IntegerType()),
                         T.StructField("motivo", T.StringType()), T.StructField("id_sistema_origem", T.StringType())])

    def batch(n):
        ids = g.sample(range(12), n)
        return [(str(i), g.choice([20260105, 20260207, 20260309, None]), g.choice(["a", "b", None]), "s") for i in ids]

    name, keys, sk = "fato_movimentacao_patio", ["id_sistema_origem", "id_movimentacao_origem"], "sk_movimentacao"
    from fleetdw.session import fresh_scratch

    path = fresh_scratch(spark, "model")
    first = batch(8)
    model = {r[0]: (i, r) for i, r in enumerate(first)}
    rows = spark.createDataFrame([(i, *r) for i, r in enumerate(first)], T.StructType([T.StructField(sk, T.LongType()), *cols]))
    FS.write(name, FS.laid_out(name, rows), path)
    for _ in range(2):
        new = batch(6)
        existing = spark.read.parquet(path)
        b = FS.laid_out(name, spark.createDataFrame(new, cols)).select(*[c for c in existing.columns if c != sk])
        ch = FS.differing(name, existing, b, keys, sk, 100, small=g.random() < .5)
        ch.write.parquet(at := fresh_scratch(spark, "model-changes"))
        FS.refresh(name, path, existing, spark.read.parquet(at), keys, lambda: FS.finish_pending(spark, name, path))
        for r in new:
            model[r[0]] = (model[r[0]][0] if r[0] in model else None, r)
        got = {r.id_movimentacao_origem: (r[sk], (r.id_movimentacao_origem, r.sk_tempo, r.motivo, r.id_sistema_origem))
               for r in spark.read.parquet(path).collect()}
        assert {k: v[1] for k, v in got.items()} == {k: v[1] for k, v in model.items()}
        assert all(got[k][0] == v[0] for k, v in model.items() if v[0] is not None)
        model = got


def test_dedup_leaves_rows_of_single_keys_alone(spark):
    rows = [(i, f"v{i}") for i in range(50)] + [(None, "x"), (None, "x")]
    plain = spark.createDataFrame(rows, "k long, v string")
    assert dedup_batch(plain, ["k"], ["v"]) is plain
    hot = plain.unionByName(spark.createDataFrame([(7, f"a{i}") for i in range(100)], "k long, v string"))
    got = sorted(map(tuple, dedup_batch(hot, ["k"], ["v"]).collect()), key=str)
    assert got == sorted([r if r[0] != 7 else (7, "a0") for r in rows], key=str)
    plan = insert_ignore(None, plain, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Exchange" not in plan
