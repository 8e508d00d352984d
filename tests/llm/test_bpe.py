import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fleetdw.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_padding()
    t.no_truncation()
    return t


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest())


def test_random_texts_match_the_library(library):
    g = random.Random(1)
    alphabets = ["abehinst", "abcdefghijklmnopqrstuvwxyz ABC.,'!\n\t", "\x1c\x85\xa0  éÉßİſ́中😀09<|>/w"]
    texts = ["".join(g.choice(a) for _ in range(g.randint(0, 60))) for a in alphabets for _ in range(400)]
    texts += ["a" * k for k in range(1, 40)] + ["<|endoftext|>x<|startoftext|> <|ENDOFTEXT|>", "</w> a</w>", "it's we'LL"]
    found = list(bpe.encoder(PATH).block(texts))
    for text, (raw, decoded) in zip(texts, found, strict=True):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(raw, "<u4").tolist() == ids, text
        assert decoded == library.decode(ids, skip_special_tokens=False), text


def test_memo_generations_do_not_change_results(library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_CHARS", 50)
    enc = bpe.Encoder(PATH)
    for text in ["the quick brown fox", "jumps over the lazy dog", "the quick dog", "over and over again"] * 3:
        (raw, _), = enc.block([text])
        assert np.frombuffer(raw, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_documents_and_odd_rows(library, documents, odd_docs, no_docs):
    for df in (documents, odd_docs):
        got = sorted((tuple(r) for r in bpe.encode_decode(df, PATH).collect()), key=str)
        assert got == sorted(((r["doc_id"], *expected(library, r["text"])) for r in df.collect()), key=str)
    assert bpe.encode_decode(no_docs, PATH).collect() == []


def test_real_outputs(spark, library):
    df = spark.createDataFrame([(1, "Hello there, World")], "doc_id long, text string")
    row = bpe.encode_decode(df, PATH, keep_ids=True).first()
    assert row["ids"] == library.encode("Hello there, World", add_special_tokens=False).ids
    assert row["decoded"] == library.decode(row["ids"], skip_special_tokens=False)


def test_letters_and_signs_are_encoded_once(library, monkeypatch):
    enc, asked = bpe.Encoder(PATH), []
    once = enc.merges.encode_words
    monkeypatch.setattr(enc.merges, "encode_words", lambda words: once(asked.extend(words) or asked[-len(words):]))
    texts = ["Ración. ración RACIÓN!! ración", "(ración) Ración?! ??? İx ŉſ ªº µ ração.ração it's IT's 'S 's' x'", "ración, ración."]
    for text in texts:
        (raw, decoded), = enc.block([text])
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(raw, "<u4").tolist() == ids and decoded == library.decode(ids, skip_special_tokens=False)
    assert asked.count("raciÃ³n") == 2  # of letters and signs in any case, and within the others, as "(ración)"


def test_pieces_of_letters_and_signs_match_the_library(library):
    g = random.Random(2)
    letters = [chr(c) for c in range(0x180) if chr(c).isalpha()]
    texts = [" ".join("".join(g.choices(letters, k=g.randint(0, 9))) + "".join(g.choices("'.,!<|>/\"_-$", k=g.randint(0, 4)))
                      for _ in range(20)) for _ in range(200)]
    for text, (raw, decoded) in zip(texts, bpe.encoder(PATH).block(texts), strict=True):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(raw, "<u4").tolist() == ids, text
        assert decoded == library.decode(ids, skip_special_tokens=False), text


def test_other_splitters_are_asked_for_every_piece():
    assert bpe.Plain(lambda x: list(x.lower()), ()).cut is None  # a word a letter
    m = bpe.encoder(PATH).merges
    words = lambda x: [w for w, _ in m.split(m.normalise(x))]
    assert bpe.Plain(words, ["inside"]).cut is None  # a special token that may be part of a piece
    assert bpe.Plain(words, m.special).cut
