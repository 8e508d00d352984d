import public_tokenizers
import pyarrow as pa

import corpus_pipeline as P
from fleetdw.llm import bpe, common, simhash


def test_stages_and_run(spark, sf_dir, documents):
    columns, docs = documents.columns, documents
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == columns and out.schema.simpleString() == docs.schema.simpleString(), name
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert [n for n, _ in P.STAGES] == ["toxicity", "simhash_near_dedup", "pii", "mixing", "bpe"]
    want = sorted(map(tuple, bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json")).collect()))
    assert sorted(map(tuple, P.run(spark, sf_dir).collect())) == want


def test_one_document_of_each_group_stays(spark, sf_dir, documents):
    ids = {r["doc_id"] for r in P.near_dedup(spark, documents, sf_dir).collect()}
    assert ids == {r["component_id"] for r in simhash.near_duplicates(documents).collect()}


def test_one_row_of_each_component_stays_whatever_the_ids(spark, odd_docs):
    def text(k):
        return " ".join(f"w{k}x{i * k % 97}" for i in range(60))

    made = spark.createDataFrame([
        (1, text(1), "en"), (2, text(2), "en"), (2, text(1), "en"), (2, text(3), "de"), (2, text(3), "en"),
        (None, text(4), "en"), (None, text(5), "en"), (None, text(5), "de"), (None, text(2), None), (None, None, "en"), (9, "", "en"),
    ], "doc_id long, text string, lang string")
    got = {tuple(r) for r in P.near_dedup(spark, made, "").collect()}
    assert got == {(1, text(1), "en"), (2, text(2), "en"), (2, text(3), "de"), (None, text(4), "en"),
                   (None, text(5), "de"), (9, "", "en")}
    out = P.near_dedup(spark, odd_docs, "")
    assert out.schema.simpleString() == odd_docs.schema.simpleString()
    roots = {simhash.fingerprint(r["text"], 3) for r in odd_docs.collect()}  # no two are within three bits
    assert all((a ^ b).bit_count() > 3 for a in roots for b in roots if a < b)
    kept = out.collect()
    assert len(kept) == len(roots) and {simhash.fingerprint(r["text"], 3) for r in kept} == roots
    assert {(r["doc_id"], r["text"]) for r in kept} >= {(None, "no id"), (4, "another text with the same id"), (0, None), (3, "a"), (7, "same")}


def test_clashing_columns_in_every_stage(spark, sf_dir, documents):
    some = documents.limit(40)
    names = ["root", "low", "fp", "__fp", "row", "n", "component_id", "hits", "pattern", "size", "copies", "__id", "__hits", "score"]
    docs = some.select("*", *[some["lang"].alias(c) for c in names])
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        assert all(r["root"] == r["lang"] == r["__fp"] for r in out.collect()), name
    assert {r["doc_id"] for r in P.near_dedup(spark, docs, sf_dir).collect()} == {
        r["doc_id"] for r in P.near_dedup(spark, some, sf_dir).collect()}


def test_empty_documents(spark, sf_dir, documents):
    docs = documents.where("1 = 0")
    for _, stage in P.STAGES:
        assert stage(spark, docs, sf_dir).collect() == []


def test_texts_go_to_python_in_bounded_batches(spark):
    made = spark.range(0, 2000, 1, 1).selectExpr("id as doc_id", "repeat('word and more ', 1000) as text")  # 28 MB
    bpe.encode_decode(made, public_tokenizers.path("word_bpe_49k.json"))  # sets the bound
    sizes = made.mapInArrow(lambda bs: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"]) for b in bs), "n long")
    assert max(r["n"] for r in sizes.collect()) < 2 * common.BATCH_BYTES
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "1m")
    common.bound_batches(spark)  # what the session says stays
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "1m"
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")


def test_near_dedup_moves_whole_rows_once_and_sorts_none(spark, tmp_path):
    made = spark.range(3000).selectExpr("id as doc_id", "md5(string(id)) as text", "repeat(md5(string(id)), 20) as more")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = simhash.representatives(made)
        assert out.count() == 3000
        out.write.parquet(f"{tmp_path}/out")
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "ShuffledHashJoin" in plan
    assert not [x for x in plan.splitlines() if "SortMergeJoin" in x and "doc_id" in x]
