import os

from pyspark.sql import functions as F

from fleetdw.plans.star import build_from_sources
from fleetdw.session import fresh_scratch
from fleetdw.streaming import start_fact_stream

from fixtures import sources


def test_stream_appends_new_rentals_once(spark):
    wh = build_from_sources(spark, sources(spark))
    before = wh.table("fato_locacao").count()
    landing = fresh_scratch(spark, "landing")
    ckpt = fresh_scratch(spark, "stream-ckpt")
    std = wh.table("std_locacao")
    # a new rental (copy of A1 with a new id) plus a replay of an already loaded one
    new = std.where(F.col("id_locacao_origem") == "A1").withColumn("id_locacao_origem", F.lit("A9"))
    old = std.where(F.col("id_locacao_origem") == "C2")
    new.unionByName(old).write.mode("append").parquet(os.path.join(landing, "batch1"))
    q = start_fact_stream(wh, "fato_locacao", os.path.join(landing, "batch1"), ckpt)
    q.awaitTermination(120)
    after = wh.table("fato_locacao")
    assert after.count() == before + 1
    assert after.where(F.col("id_locacao_origem") == "A9").count() == 1
    # the same files again under a fresh checkpoint: insert-ignore makes the replay a no-op
    q2 = start_fact_stream(wh, "fato_locacao", os.path.join(landing, "batch1"), fresh_scratch(spark, "ck2"))
    q2.awaitTermination(120)
    assert wh.table("fato_locacao").count() == before + 1
