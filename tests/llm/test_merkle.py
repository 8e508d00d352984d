import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from fleetdw.llm import merkle as M


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, lower=False):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    text = row["text"]
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return h("".join(map(field, (row["doc_id"], row["source"], row["lang"], row["n_chars"], text))))


def whole_tree(leaves):
    """Root and, per leaf, its siblings by level, by rebuilding every level as a list."""
    level, found = [(x, [i]) for i, x in enumerate(leaves)], [[] for _ in leaves]
    while len(level) > 1:
        above = []
        for a in range(0, len(level), 8):
            run = level[a:a + 8]
            for k, (_, members) in enumerate(run):
                for i in members:
                    found[i].append(("".join(x for x, _ in run[:k]), "".join(x for x, _ in run[k + 1:])))
            above.append((h("".join(x for x, _ in run)), [i for _, m in run for i in m]))
        level = above
    return level[0][0], found


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    trees = {g: whole_tree([leaf(r) for r in groups[g]]) for g in names}
    root, top = whole_tree([trees[g][0] for g in names])
    out = []
    for g, upper in zip(names, top, strict=True):
        for r, below in zip(groups[g], trees[g][1], strict=True):
            proof = below + upper
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            folded = leaf(r, lower=tampered)
            for a, z in proof:
                folded = h(a + folded + z)
            out.append((r["doc_id"], leaf(r), trees[g][0], root, h("".join(a + z for a, z in proof)), folded, folded == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 511, 512, 513, 700])
def test_tree_appends_and_witnesses(n):
    leaves = [h(str(i)) for i in range(n)]
    root, proofs = whole_tree(leaves)
    tree = M.Tree()
    nodes = [tree.append(x) for x in leaves]
    if n > 8:  # the first leaf's witness has grown with its run, before the tree is closed
        assert nodes[0].witness()[0] == proofs[0][0]
    assert tree.close() == root
    assert [x.witness() for x in nodes] == proofs


def test_blocks_appended_at_their_height_give_the_same_root():
    leaves = [h(str(i)) for i in range(3 * 64 + 5)]
    tree = M.Tree()
    for a in range(0, len(leaves), 64):
        block = M.Tree()
        for x in leaves[a:a + 64]:
            block.append(x)
        tree.append(block.close(2), level=2)
    assert tree.close() == whole_tree(leaves)[0]
    assert M.Tree().close() is None


def test_documents(documents):
    assert sorted((tuple(r) for r in M.audit(documents).collect()), key=str) == brute(documents.collect())


def test_several_levels_of_blocks(spark):
    rows = [(i, "s", None if i % 5 == 0 else f"l{i % 2}" if i > 30 else f"x{i}", None, "T" * (i % 7)) for i in range(260)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    want = brute(df.collect())
    for height in (1, 2):
        assert sorted((tuple(r) for r in M.audit(df, height).collect()), key=str) == want


def test_odd_rows_and_no_rows(odd_docs, no_docs):
    for df in (odd_docs, no_docs):
        full = df.withColumn("n_chars", F.lit(None).cast("long")).withColumn("hash", F.lit("clash")).withColumn("g", F.lit(1))
        want = brute(full.collect()) if df is odd_docs else []
        assert sorted((tuple(r) for r in M.audit(full).collect()), key=str) == want


def test_manifest_carries_and_proves(spark):
    df = spark.createDataFrame([(i, f"g{i % 3}", f"t{i}") for i in range(30)], "id long, grp string, body string")
    out = M.manifest(df, ["body"], "grp", "id", carry={"was": F.col("body")})
    assert out.columns == ["id", "leaf", "subroot", "root", "proof", "was"]
    assert out.where(M.fold(F.col("leaf"), F.col("proof")) == F.col("root")).count() == 30
    assert out.where(F.sha2(F.concat(F.octet_length("was").cast("string"), F.lit(":"), F.col("was")), 256) == F.col("leaf")).count() == 30
