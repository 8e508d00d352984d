import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from fleetdw.llm import token_files as T

PATH = public_tokenizers.path("byte_bpe_50k.json")


def encoded(enc, texts, end_id=None):
    ids, counts = enc.block(pa.array(texts, pa.string()), end_id)
    cuts = np.cumsum(counts)
    assert cuts[-1] == len(ids)
    return [x.tolist() for x in np.split(ids, cuts[:-1])]


def odd_texts(n, seed):
    g = random.Random(seed)
    alphabet = ["a", "b", " ", "  ", "\n", "\t", "\r", "\x1c", "\x85", "\xa0", "é", "中", "😀", ".", ",", "'s", "<|endoftext|>", "0", "word", "Other", "!!", "...", "&&&", "don't", "_x", "\"", "[", "]", "~", "`", "@"]
    return ["".join(g.choice(alphabet) for _ in range(g.randint(0, 30))) for _ in range(n)] + ["", " ", "a  ", "  a", " \n ", "a\n \nb"]


def test_encoder_matches_the_library():
    lib, enc = Tokenizer.from_file(PATH), T.Encoder(PATH)
    for texts in (odd_texts(3000, 2), ["only one"], ["", ""], ["a  b"], odd_texts(500, 2)):
        for end in (None, 2):
            want = [lib.encode(t, add_special_tokens=False).ids + ([] if end is None else [end]) for t in texts]
            assert encoded(enc, texts, end) == want
    assert [len(x) for x in enc.block(pa.array([], pa.string()))] == [0, 0]


def test_the_memo_counts_all_it_holds(monkeypatch):
    monkeypatch.setattr(T, "MEMO_BYTES", 200_000)
    lib, enc = Tokenizer.from_file(PATH), T.Encoder(PATH)
    for k in range(30):  # parts that end in a line end, white space, and texts encoded whole
        texts = [f"title {chr(0x4e00 + 37 * k + i) * 300}\n" for i in range(20)] + [f"a  {k} " * 200, f"x{k} \x1c"]
        assert encoded(enc, texts) == [lib.encode(t, add_special_tokens=False).ids for t in texts]
        assert 0 < enc.held() < 200_000 + 150_000


def test_repair_round_trip_and_random_access():
    g = np.random.default_rng(3)
    for n, top in ((0, 5), (1, 5), (2, 1), (1000, 1), (1001, 2), (5000, 9), (5000, 70000)):
        ids = g.integers(0, top, n).astype(np.uint32)
        shard = T.Shard(T.pack([7], ids, np.array([n])))
        assert (shard.ids() == ids).all()
        for _ in range(30):
            a = int(g.integers(0, n + 1))
            b = int(g.integers(a, n + 1))
            assert (T.decode_range(shard, a, b) == ids[a:b]).all()
    shard = T.Shard(T.pack([7], np.array([4, 5] * 500, np.uint32), np.array([1000])))
    assert len(shard.seq) < 20  # rules nest


def test_rules_end_when_none_pays():
    """No pair that is left occurs often enough for a rule; a rule less would not be smaller."""
    g = np.random.default_rng(4)
    for ids in (g.integers(0, 30, 20000), g.zipf(1.3, 30000) % 4000, np.tile(g.integers(0, 5000, 700), 9)):
        ids = ids.astype(np.uint32)
        alphabet, rules, sizes, seq = T.compress(ids.copy())
        width = 2 if len(alphabet) <= 1 << 16 else 4
        left = {}
        last = None
        for pair in zip(seq[:-1].tolist(), seq[1:].tolist()):
            if pair == last and pair[0] == pair[1]:
                last = None  # a run of one symbol: every second pair
                continue
            left[pair] = left.get(pair, 0) + 1
            last = pair
        assert max(left.values()) * width <= T.RULE_BYTES or len(rules) + len(alphabet) == 1 << 16
        full = [1] * len(alphabet) + sizes.tolist()
        assert sum(full[x] for x in seq.tolist()) == len(ids)


def test_symbols_stay_within_two_bytes():
    g = np.random.default_rng(5)
    ids = np.concatenate([np.arange(65530), np.tile(g.integers(0, 60000, 400), 20)]).astype(np.uint32)
    blob = T.pack([1], ids, np.array([len(ids)]))
    shard = T.Shard(blob)
    assert shard.seq.dtype.itemsize == 2 and len(shard.size) <= 1 << 16 and (shard.ids() == ids).all()


def test_documents_are_whole_and_equal_rows_kept(spark):
    texts = ["word " * 3000, "short", "x" * 4000, "", None] * 7
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = sorted(tuple(r) for r in T.round_trip(df, PATH).collect())
    assert [r[0] for r in whole] == list(range(35))
    same = spark.createDataFrame([(5, "one and the same")] * 500, "doc_id long, text string").repartition(4)
    got = sorted(tuple(r) for r in T.round_trip(same, PATH).collect())
    assert len(got) == 500 and [r[1] for r in got] == [i * got[0][2] for i in range(500)]


def test_round_trip_of_documents(documents, odd_docs, no_docs, monkeypatch):
    lib = Tokenizer.from_file(PATH)
    for df in (documents, odd_docs):
        got = sorted((tuple(r) for r in T.round_trip(df, PATH, end_id=2).collect()), key=lambda r: r[1])
        n = 0
        for doc_id, start, n_tokens, _ in got:
            assert start == n
            n += n_tokens
        ids = [r[0] for r in got]
        assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
        want = []
        for r in df.collect():
            x = lib.encode(r["text"] or "", add_special_tokens=False).ids + [2]
            want.append((r["doc_id"], len(x), zlib.crc32(struct.pack(f"<{len(x)}I", *x))))
        assert sorted(((r[0], r[2], r[3]) for r in got), key=str) == sorted(want, key=str)
    assert T.round_trip(no_docs, PATH).collect() == []


def test_new_parts_go_to_the_library_in_short_texts(monkeypatch):
    lib, enc, asked = Tokenizer.from_file(PATH), T.Encoder(PATH), []
    once = enc.tok
    monkeypatch.setattr(enc, "tok", type("Library", (), {
        "encode_batch_fast": lambda self, texts, **more: asked.extend(texts) or once.encode_batch_fast(texts, **more)})())
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}" for k in range(1000)]
    text = " ".join(words)
    assert encoded(enc, [text]) == [lib.encode(text, add_special_tokens=False).ids]
    assert max(t.count(" ") for t in asked) <= 128
