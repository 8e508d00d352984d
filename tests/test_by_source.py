"""Large loads go source by source, few jobs at once."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from fleetdw.plans import fact_store as FS
from fleetdw.plans import facts as FX
from fleetdw.plans import star as ST
from fleetdw.schemas import SYSTEMS

from fixtures import sources

SYS = "id_sistema_origem"


def rows_of(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


def test_few_jobs_run_at_once():
    now, most, lock = [0], [0], threading.Lock()

    def task():
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.05)
        with lock:
            now[0] -= 1

    ST._in_parallel({str(i): task for i in range(24)})
    assert 1 < most[0] <= 4


def test_large_loads_are_written_source_by_source(spark, monkeypatch):
    whole, write, seen = ST.TRANSFORMS["std_locacao"], FS.write, []
    monkeypatch.setitem(ST.TRANSFORMS, "std_locacao", lambda stg: pytest.fail("all sources in one job"))
    monkeypatch.setattr(ST, "ROWS_AT_ONCE", 0)
    monkeypatch.setattr(FS, "write", lambda name, rows, path, **k: (
        seen.append((name, {r[0] for r in rows.select(SYS).distinct().collect()})), write(name, rows, path, **k)))
    wh = ST.build_from_sources(spark, sources(spark))
    assert sum(name == "fato_locacao" for name, _ in seen) == 4 and all(len(s) <= 1 for _, s in seen)
    want = whole(ST.extract_all(sources(spark)))
    assert wh.table("std_locacao").columns == want.columns
    assert rows_of(wh.table("std_locacao")) == rows_of(want)
    for name, sk in ST.FACT_SK.items():
        std, build = FX.BUILDERS[name]
        want = build(wh.table(std), wh.dims(), None)
        assert rows_of(wh.table(name).select(*want.columns)) == rows_of(want)
        assert wh.table(name).select(sk).distinct().count() == wh.table(name).count() == wh.inserted[name] > 0
    ST.load(spark, wh)
    assert all(wh.inserted[name] == 0 for name in ST.FACT_SK)


def test_parts_of_a_batch_hold_each_row_once(spark):
    tags = [*SYSTEMS, "other", None, SYSTEMS[1], None]
    batch = spark.createDataFrame([(i, s) for i, s in enumerate(tags)], f"i int, {SYS} string")
    parts = [sorted(r.i for r in p.collect()) for p in ST._by_source(batch)]
    assert parts == [[0], [1, 6], [2], [3], [4, 5, 7]]
    assert [p.count() for p in ST._by_source(batch.where(F.col("i") < 2))] == [1, 1]
