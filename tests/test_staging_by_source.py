"""The staging queries take one source at a time and leave no shuffle files behind."""

import time

import pytest

from fleetdw import queries as QU
from fleetdw import session as SE
from fleetdw.plans import star as ST
from fleetdw.schemas import SYSTEMS

from fixtures import sources

SYS = "id_sistema_origem"


def shuffle_blocks(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {blocks.apply(i).name() for i in range(blocks.size()) if blocks.apply(i).isShuffle()}


def test_release_lets_shuffle_files_go(spark, monkeypatch):
    monkeypatch.setattr(SE, "RELEASE_BYTES", 0)
    before = shuffle_blocks(spark)
    path = SE.fresh_scratch(spark, "released")
    spark.range(1000).repartition(3, "id").write.parquet(path)
    new = shuffle_blocks(spark) - before
    assert new
    for _ in range(20):  # the scheduler may hold the last job until the next one
        spark.range(1).count()
        SE.release(spark, path)
        time.sleep(0.2)
        if not new & shuffle_blocks(spark):
            return
    raise AssertionError("shuffle files are still there")


@pytest.mark.parametrize("entity", ["locacao", "reserva"])
def test_staging_takes_one_source_at_a_time(spark, monkeypatch, entity):
    class Shaped:
        def all_sources(self):
            return sources(spark)

    seen, merge = [], QU.insert_ignore

    def watched(staged, batch, keys, tie):
        seen.append({r[0] for r in batch.select(SYS).distinct().collect()})
        return merge(staged, batch, keys, tie)

    monkeypatch.setattr(QU, "_shapes", lambda spark, sf_dir: Shaped())
    monkeypatch.setattr(QU, "insert_ignore", watched)
    got = QU.registry()[f"stg_{entity}"](spark, "-")
    assert seen == [{s} for s in SYSTEMS]
    key, want = ST.STAGING_KEYS[entity], {}
    for letter in "ABCD":
        for r in ST.extract_all(sources(spark))[letter][entity].collect():
            want[(r[SYS], r[key])] = 0 if len(r[key]) % 2 == 0 else 1
    assert {(r[SYS], r[key]): r.lote for r in got.collect()} == want and got.count() == len(want)
