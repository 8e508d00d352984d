import importlib
import random

from fleetdw.operators.insert_ignore import dedup_batch, insert_ignore, skipped_by_reason, upsert
from fleetdw.operators.surrogate import assign_surrogate_key

SCHEMA = "k string, tb int, v string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_insert_ignore_skips_existing_and_later_in_batch_duplicates(spark):
    target = spark.createDataFrame([("a", 1, "old")], SCHEMA)
    batch = spark.createDataFrame(
        [("a", 0, "new-a"), ("b", 2, "b2"), ("b", 1, "b1"), ("c", None, "c-null-tb"), ("c", 5, "c5")], SCHEMA)
    new = insert_ignore(target, batch, ["k"], ["tb"])
    # b: first by tie-break (1 < 2); c: NULL tie-break sorts last
    assert rows(new) == [("b", 1, "b1"), ("c", 5, "c5")]


def test_null_keys_never_conflict(spark):
    target = spark.createDataFrame([(None, 1, "t")], SCHEMA)
    batch = spark.createDataFrame([(None, 1, "x"), (None, 2, "y")], SCHEMA)
    assert rows(insert_ignore(target, batch, ["k"], ["tb"])) == [(None, 1, "x"), (None, 2, "y")]


def test_insert_ignore_is_idempotent(spark):
    batch = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], SCHEMA)
    first = insert_ignore(None, batch, ["k"], ["tb"])
    assert rows(first) == [("a", 1, "x"), ("b", 1, "z")]
    assert insert_ignore(first, batch, ["k"], ["tb"]).count() == 0


def test_skip_accounting_and_upsert(spark):
    target = spark.createDataFrame([("a", 9, "old-a"), ("z", 1, "old-z")], SCHEMA)
    batch = spark.createDataFrame([("a", 1, "a1"), ("a", 2, "a2"), ("b", 1, "b1"), ("b", 3, "b3"), ("c", 1, "c1")],
                                  SCHEMA)
    acc = {r.reason: r.n_rows for r in skipped_by_reason(target, batch, ["k"], ["tb"]).collect()}
    assert acc == {"conflict_existing": 2, "duplicate_in_batch": 1}
    assert rows(upsert(target, batch, ["k"], ["tb"])) == [
        ("a", 1, "a1"), ("b", 1, "b1"), ("c", 1, "c1"), ("z", 1, "old-z")]


def test_dedup_keep_last(spark):
    batch = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y")], SCHEMA)
    assert rows(dedup_batch(batch, ["k"], ["tb"], keep="last")) == [("a", 2, "y")]


def test_surrogate_keys_dense_and_ordered_across_partitions(spark):
    keys = [f"k{i:05d}" for i in range(1000)]
    random.Random(7).shuffle(keys)
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "nk string, payload int").repartition(7)
    out = assign_surrogate_key(df, ["nk"], "sk", start=101, num_partitions=5)
    got = sorted((r.nk, r.sk) for r in out.collect())
    assert [sk for _, sk in got] == list(range(101, 1101))
    assert out.columns == ["sk", "nk", "payload"]


def test_surrogate_keys_on_empty_input(spark):
    df = spark.createDataFrame([], "nk string")
    assert assign_surrogate_key(df, ["nk"], "sk").count() == 0


def test_insert_ignore_incremental_plan_same_result(spark):
    target = spark.createDataFrame([(f"k{i}", 1, "old") for i in range(50)] + [(None, 1, "t")], SCHEMA)
    batch = spark.createDataFrame([("k3", 0, "x"), ("new", 2, "y"), ("new", 1, "z"), (None, 5, "n")], SCHEMA)
    plain = rows(insert_ignore(target, batch, ["k"], ["tb"]))
    probed = insert_ignore(target, batch, ["k"], ["tb"], batch_rows=4)
    assert rows(probed) == plain == sorted([(None, 5, "n"), ("new", 1, "z")], key=repr)
    plan = probed._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan


def test_broadcast_is_bounded_by_rows_and_bytes(spark):
    from fleetdw.operators.lookup import checked_broadcast

    narrow = spark.range(1).selectExpr("id AS a", "id AS b")
    wide = spark.range(1).selectExpr("id", *[f"CAST(id AS STRING) AS c{i}" for i in range(8)])
    hinted = lambda df, n: "broadcast" in checked_broadcast(df, n)._jdf.queryExecution().logical().toString()
    assert hinted(narrow, 1_000_000) and not hinted(narrow, 1_000_001) and not hinted(narrow, None)
    assert hinted(wide, 300_000) and not hinted(wide, 900_000)


def test_dedup_batch_finds_repeated_keys_by_eight_bytes_each(spark, monkeypatch):
    """What is looked for repeats in is a hash, not the key; the rows are those of either way."""
    I = importlib.import_module("fleetdw.operators.insert_ignore")  # noqa: N806 - the package names a function so
    seen, was = [], I.repeated_hashes
    monkeypatch.setattr(I, "repeated_hashes", lambda rows, by: seen.append(rows.schema) or was(rows, by))
    batch = spark.createDataFrame([("a", 1, None, "x"), ("a", 1, 2, "y"), ("a", 1, 1, "z"), ("b", 1, 5, None), (None, 1, 3, "n"),
                                   (None, 1, 3, "n"), ("c", 2, None, "q"), ("c", 2, None, "q")], "k string, j int, tb int, v string")
    for keep, a in (("first", ("a", 1, 1, "z")), ("last", ("a", 1, None, "x"))):
        want = sorted([a, ("b", 1, 5, None), (None, 1, 3, "n"), (None, 1, 3, "n"), ("c", 2, None, "q")], key=str)
        for limit in (0, 1_000_000):  # too many repeated hashes for a broadcast, and few
            got = dedup_batch(batch, ["k", "j"], ["tb"], keep=keep, probe=batch, max_broadcast_rows=limit)
            assert got.columns == batch.columns
            assert sorted(map(tuple, got.collect()), key=str) == want
    assert {tuple(f.dataType.simpleString() for f in s.fields) for s in seen} == {("bigint",)}
