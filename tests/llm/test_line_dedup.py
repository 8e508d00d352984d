import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fleetdw.llm import line_dedup as L

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(SMALL)


def brute(texts, least, shortest=1):
    split = [(t or "").split("\n") for t in texts]
    n = Counter(k for ls in split for k in {key(x) for x in ls})
    out = []
    for ls in split:
        kept = [x for x in ls if len(key(x)) < shortest or n[key(x)] < least]
        out.append((len(ls), len(ls) - len(kept), "\n".join(kept)))
    return out


def test_documents_against_brute_force(documents):
    rows = documents.select("doc_id", "text").collect()
    want = {(r["doc_id"], *w) for r, w in zip(rows, brute([r["text"] for r in rows], 10), strict=True)}
    assert {tuple(r) for r in L.drop_common(documents).collect()} == want


@pytest.mark.parametrize("least, shortest, batches", [(1, 1, 1), (2, 1, 3), (3, 2, 5)])
def test_made_lines(spark, least, shortest, batches):
    g = random.Random(least)
    pieces = ["", " ", "\t", "A", "a", " a ", "b\r", "É", "é", "\xa0", "\x1c", "long line of text", "Long LINE of text\x0b", "x" * 500]
    texts = ["\n".join(g.choice(pieces) for _ in range(g.randint(0, 8))) for _ in range(40)] + [None, "", "same\nA", "same\nA"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = sorted(tuple(r) for r in L.drop_common(df, least=least, shortest=shortest, batches=batches).collect())
    assert got == [(i, *w) for i, w in enumerate(brute(texts, least, shortest))]


def test_a_line_of_most_documents_and_copies_of_one_text(spark):
    texts = ["license\n" + ("copy" if i % 3 == 0 else f"own {i}") for i in range(300)] + ["\n".join(f"l{i}" for i in range(20000))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(tuple(r) for r in L.drop_common(df).collect())
    assert got == [(i, *w) for i, w in enumerate(brute(texts, 10))]


def test_odd_rows_and_no_rows(odd_docs, no_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    for least in (2, 10):
        want = sorted(((r["doc_id"], *w) for r, w in zip(rows, brute([r["text"] for r in rows], least), strict=True)), key=str)
        assert sorted((tuple(r) for r in L.drop_common(odd_docs, least=least).collect()), key=str) == want
    clash = odd_docs.withColumn("t", F.lit(1)).withColumn("h", F.lit(1)).withColumn("at", F.lit("x")).withColumn("n", F.lit(None))
    assert L.drop_common(clash).count() == len(rows)
    assert L.drop_common(no_docs).collect() == []


def test_runs_are_merged_level_by_level_and_close(spark):
    def batch(counts):
        return spark.createDataFrame([(bytes([h]) * 16, n) for h, n in counts.items()], "h binary, n long")

    index = L.LineRuns(spark, least=10, buckets=4)
    index.add(batch({1: 10, 2: 4, 3: 1}))
    assert [len(x) for x in index.levels] == [1]
    index.add(batch({1: 7, 2: 5, 4: 1}))  # 1 is closed: not counted again
    assert [len(x) for x in index.levels] == [0, 1]
    got = lambda: {r["h"][0]: r["n"] for r in index.counts().collect()}
    assert got() == {1: 10, 2: 9, 3: 1, 4: 1}
    index.add(batch({2: 1, 3: 1}))
    assert [len(x) for x in index.levels] == [1, 1]
    assert {r["h"][0] for r in index.frequent().collect()} == {1, 2}
    index.add(batch({2: 50, 5: 2}))
    assert [len(x) for x in index.levels] == [0, 0, 1]
    assert got() == {1: 10, 2: 60, 3: 2, 4: 1, 5: 2}
    index.add(batch({2: 9, 5: 8}))
    assert got() == {1: 10, 2: 60, 3: 2, 4: 1, 5: 10}
    assert {r["h"][0] for r in index.frequent().collect()} == {1, 2, 5}
    index.forget()


def test_runs_are_not_shuffled_for_a_batch(spark):
    index = L.LineRuns(spark, least=2, buckets=8)
    rows = spark.range(1000).select(F.unhex(F.md5(F.col("id").cast("string"))).alias("h"), F.lit(1).cast("long").alias("n"))
    index.add(rows)
    run = spark.table(index.runs()[0]).where("n >= 2").select("h")
    plan = rows.hint("merge").join(run.hint("merge"), "h", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    index.forget()
