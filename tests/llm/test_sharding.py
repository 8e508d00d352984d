import hashlib
from collections import defaultdict

from fleetdw.llm import sharding


def brute(rows, limit):
    def bits(text):
        return f"{int(hashlib.md5(text.encode()).hexdigest()[:15], 16):060b}"

    keyed = [(d, len((t or "").encode()), bits("null" if d is None else str(d)) + bits(t or "")) for d, t in rows]
    sums = defaultdict(int)
    for _, size, h in keyed:
        for k in range(121):
            sums[h[:k]] += size
    return [(d, size, next((k for k in range(121) if sums[h[:k]] <= limit), 120)) for d, size, h in keyed]


def test_buckets_split_only_when_too_large(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    for limit in (20_000, 1 << 20):
        got = sharding.assign(documents, limit).collect()
        assert sorted((r["doc_id"], r["bytes"], r["depth"]) for r in got) == sorted(brute(rows, limit))
        held = defaultdict(list)
        for r in got:
            held[r["depth"], r["prefix"], r["page"]].append(r)
        for rs in held.values():
            assert sum(r["bytes"] for r in rs) <= limit or (len(rs) == 1 and rs[0]["oversized"])


def test_odd_rows_and_copies(spark, odd_docs, no_docs):
    copies = spark.range(500).selectExpr("5 AS doc_id", "'forty characters of text, forty of them.' AS text")
    df = odd_docs.select("doc_id", "text").unionByName(copies)
    got = sharding.assign(df, 1000).collect()
    assert len(got) == df.count()
    pages = defaultdict(int)
    for r in got:
        pages[r["depth"], r["prefix"], r["page"]] += r["bytes"]
        assert r["oversized"] == (r["bytes"] > 1000)
    assert all(n <= 1000 or n in (15000, 30000) for n in pages.values())
    assert sharding.assign(no_docs, 1000).collect() == []


def test_documents_are_found_by_the_directory(spark, documents):
    from fleetdw.llm.common import materialise

    copies = spark.range(300).selectExpr("5 AS doc_id", "concat('text ', id % 40, repeat('x', 60)) AS text")
    df = documents.select("doc_id", "text").unionByName(copies)
    assigned = materialise(sharding.assign(df, 5000), "test-shards")
    table = materialise(sharding.directory(assigned), "test-directory")
    assert table.count() == table.select("depth", "prefix", "doc_id").distinct().count()
    assert {r["global_depth"] for r in table.collect()} == {max(r["depth"] for r in assigned.collect())}
    want = sorted((r["doc_id"], r["depth"], r["prefix"]) for r in assigned.collect())
    assert max(w[1] for w in want) > 60  # one id's texts are told apart by their own bits
    assert sorted(tuple(r) for r in sharding.place(df, table).collect()) == want
    # a document that is not there yet lands in the bucket whose prefix it has, or in none
    new = spark.createDataFrame([(10**9 + i, "new") for i in range(50)], "doc_id long, text string")
    for r in sharding.place(new, table).collect():
        h = int(hashlib.md5(str(r["doc_id"]).encode()).hexdigest()[:15], 16)
        here = [b for b in table.collect() if b["depth"] <= 60 and h >> (60 - b["depth"]) == b["prefix"]]
        assert [(b["depth"], b["prefix"]) for b in here] == ([] if r["depth"] is None else [(r["depth"], r["prefix"])])
    assert [tuple(r) for r in sharding.place(new.limit(1), table.where("1 = 0")).collect()] == [(10**9, None, None)]
