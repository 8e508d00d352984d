import hashlib
import random
import re

import public_tokenizers as P

from fleetdw.llm import secret_scan as S

PATH = P.path("byte_bpe_50k.tiktoken")
KEY = "kX9vQ2mZr7TbL0wYp4HsN8dG"


def brute(text):
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def scan(df):
    return S.find(df, PATH, P.PATTERN).collect()


def test_base_spans_against_brute_force(spark, documents, odd_docs, no_docs):
    g = random.Random(7)
    parts = ["token", "Secret", "API_KEY", "apikey", "passwd", " = ", ":", "\"", "'", "  ", "AKIA", "ABCDEFGH", "0123456789", "abcdef",
             "é", "ſecret", "x", ".", "=", "\n"]
    made = spark.createDataFrame([(i, "".join(g.choice(parts) for _ in range(30))) for i in range(500)], "doc_id long, text string")
    for df in (made, documents, odd_docs):
        want = []
        for r in df.collect():
            b = brute(r["text"] or "")
            want.append((r["doc_id"], *[sum(s[1] == k for s in b) for k in range(3)], hashlib.sha256(S.said(b).encode()).hexdigest()))
        got = scan(df)
        assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
        for r in got:
            assert r["spans"].count("random:") == r["n_random"]
    assert scan(no_docs) == []


def test_token_efficiency_finds_random_strings_and_spares_known_ones(spark):
    spared = ["request_handler_2024_final_version", "d41d8cd98f00b204e9800998ecf8427e", "123e4567-e89b-12d3-a456-426614174000",
              "sha256-" + KEY, "12345678901234567890123456", "AbstractSingletonProxyFactoryBean3", "a" * 40000]
    rows = [(0, f"key {KEY} end"), (1, f"token={KEY}")] + [(i + 2, f"see {t} there") for i, t in enumerate(spared)]
    got = {r["doc_id"]: r for r in scan(spark.createDataFrame(rows, "doc_id long, text string"))}
    assert got[0]["spans"] == "random:4:28" and got[0]["found"][0]["text"] == KEY
    assert got[1]["n_random"] == 0 and got[1]["n_assign"] == 1
    assert all(got[i + 2]["n_random"] == 0 for i in range(len(spared)))


def test_ordinary_text_beside_a_random_string_does_not_hide_it(spark):
    letters, short = "qXvZkRwTjLpGbHnYcMdF", "kX9vQ2mZr7TbL0"
    found = [f"SESSION_SIGNING_VALUE={KEY}", f"example/download/reports/{KEY}", f"md5_backup/archive/{KEY}", f"etag=abc/{KEY}",
             f"internationalizationdownloadreports{KEY}", letters, short, f"123e4567-e89b-12d3-a456-426614174000/{KEY}"]
    spared = ["example/download/reports/2024-01-01T00-00-00/final", "d41d8cd98f00b204e9800998ecf8427e/readme_first_of_all",
              "getElementsByClassName", "integrity=sha384-oqVuAfXRKap7fdgcCY5uykM6+R9GqQ8K/uxy9rx7HNQlGYl1kPzQho1wx4JwY8wC",
              "example/123e4567-e89b-12d3-a456-426614174000/report", "internationalization", f"my_token={KEY}"]
    rows = [(i, f"see {t} there") for i, t in enumerate(found + spared)]
    got = {r["doc_id"]: r for r in scan(spark.createDataFrame(rows, "doc_id long, text string"))}
    for i, t in enumerate(found):
        hits = [f["text"] for f in got[i]["found"] if f["kind"] == "random"]
        assert len(hits) == 1 and hits[0].endswith(t[-14:]), t
    assert not [t for i, t in enumerate(spared) if got[len(found) + i]["n_random"]]


def test_many_base_spans_in_one_run_take_linear_time():
    import time

    tokens = S.Tokens(PATH, P.PATTERN)
    text = ("0123456789abcdef01234567" + "g") * 40000  # 1 MB, one run, 40,000 spans
    base = S.base_spans(text)
    assert len(base) == 40000
    begin = time.time()
    assert S.random_spans(text, base, tokens, S.MAX_RATIO) == []
    assert time.time() - begin < 1
    # spans in several pieces of one run, against the walk to the nearest separators
    part = "0123456789abcdef01234567"
    text = f"{part}xyz/{KEY}/{part}=abc_{part}"
    run = S.RUN.search(text)
    assert run.span() == (0, len(text))
    spans = S.random_spans(text, S.base_spans(text), tokens, S.MAX_RATIO)
    assert [text[a:z] for a, _, z in spans] == [f"/{KEY}/"]
