"""BPE encoding and decoding by prefix-sharing trie traversal (operator 10).

A word's BPE encoding is determined left to right: for every prefix there is
exactly one *last token* ``t`` such that ``t`` ends the prefix and may stand
directly after the last token of the prefix without ``t``. "May stand" is a fact
about two neighbouring tokens only, so it is memoised per pair. The distinct
words of a batch form a trie; visiting its nodes depth-first (words in sorted
order, one stack entry per symbol of the current path) computes the last token of
every shared prefix once. A word's ids are read off by walking back from its
leaf, whose symbol carries the end-of-word mark.

Texts are cut at white space first: no token of these vocabularies spans it. Pieces of Latin
letters with ASCII signs behind them (:class:`Plain`) are put together from the letters, in lower
case, and the signs, so pieces that differ in these only are encoded once; every other distinct piece
goes through the vocabulary's own normaliser and splitter. Only the merges are computed here. Memory
per task is bounded: texts are taken in blocks of ``BLOCK_CHARS`` characters, and the memo of pieces
keeps two generations of ``MEMO_CHARS`` characters each.

Cases: a null text counts as empty; an empty text has no ids and decodes to the
empty string; rows are never merged, so repeated rows give repeated results; an
empty table gives an empty result; only the id and text columns are read, so
other columns of any name do not matter.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
import string
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetdw.llm.common import bound_batches, ship_package

WORD_END = "</w>"
BLOCK_CHARS = 2_000_000
MEMO_CHARS = 7_000_000
#: White space for str.split() but not for the vocabulary's \s.
ODD_SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")
_PLAIN_SPACE = re.compile("[ \t\n\r\x0b\x0c\x85\xa0]+")


class Plain:
    """What a normaliser and splitter make of Latin letters and ASCII signs, asked letter by letter: ``table``
    has it. Letters are those that stay one word whatever their case; a run of them is a word, and so is a
    run of signs behind it. ``cut`` matches such pieces; it is None where a vocabulary does otherwise."""

    def __init__(self, words: Callable[[str], list[str]], special: Iterable[str]):
        made = {c: words(c) for c in map(chr, range(0x180)) if c.isalpha()}
        letters = "".join(c for c, ws in made.items() if len(ws) == 1 and made.get(c.lower()) == ws)
        signs = string.punctuation
        self.table = {ord(c): made[c][0] for c in letters}
        self.cut = re.compile(f"([{re.escape(letters)}]*)([{re.escape(signs)}]*)") if letters else None
        inside = re.compile(f"[{re.escape(signs)}][{re.escape(letters)}]") if letters else None
        asked = [(x, y) for x in ("", letters, letters[::-1]) for y in ("", signs, signs[::-1], *signs) if x or y]
        if (not letters or not all(inside.search(t) for t in special)  # else, one may be part of such a piece
                or any(words(x + y) != [w for w in (x.translate(self.table), y) if w] for x, y in asked)):
            self.cut = None

    def words(self, runs: list[str]) -> list[str]:
        """The word of each run of letters or signs."""
        return " ".join(runs).translate(self.table).split(" ") if runs else []


class State:
    """The longest tail of a path that begins some token; ``tokens`` end there."""

    __slots__ = ("text", "next", "tokens", "final")

    def __init__(self, text: str):
        self.text, self.next, self.tokens, self.final = text, {}, (), {}


class Merges:
    """The merge table of a vocabulary file, and which tokens may be neighbours."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.text = {i: t for t, i in self.vocab.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for k, m in enumerate(model["merges"]):
            left, right = m if isinstance(m, list) else m.split(" ")
            a, b, c = self.vocab[left], self.vocab[right], self.vocab[left + right]
            self.rank[a, b] = k
            self.parts.setdefault(c, (a, b, k))
        #: (string without the mark) -> id, for tokens inside and at the end of a word
        self.inner = {t: i for t, i in self.vocab.items() if not t.endswith(WORD_END)}
        self.final = {t[:-len(WORD_END)]: i for t, i in self.vocab.items() if t.endswith(WORD_END)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for t, i in self.special.items():
            self.inner.pop(t, None)
            self.text[i] = t
        self.prefixes = {t[:k] for t in self.inner for k in range(1, len(t) + 1)}
        self.prefixes |= {t[:k] for t in self.final for k in range(1, len(t))}
        self.states: dict[str, State] = {}
        self.root = State("")
        self.special_re = (re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))
                                      + ")") if self.special else None)
        tok = Tokenizer.from_file(path)
        self.normalise = tok.normalizer.normalize_str if tok.normalizer else (lambda s: s)
        self.split = tok.pre_tokenizer.pre_tokenize_str
        self.plain = Plain(lambda x: [w for w, _ in self.split(self.normalise(x))], self.special)
        self._ok: dict[tuple[int, int], bool] = {}

    def neighbours(self, a: int, b: int) -> bool:
        """May token ``b`` directly follow token ``a`` in an encoding?"""
        key = (a, b)
        ok = self._ok.get(key)
        if ok is None:
            if len(self._ok) > 1_000_000:
                self._ok.clear()
            ok = self._ok[key] = self._neighbours(a, b)
        return ok

    def _neighbours(self, a: int, b: int) -> bool:
        """Undo merges from the latest to the earliest; whenever the two symbols
        at the border could have merged before the last undone one, they would
        have. Equal ranks merge from the left."""
        before, equal_counts = float("inf"), False
        while True:
            k = self.rank.get((a, b))
            if k is not None and (k < before or (equal_counts and k == before)):
                return False
            pa_, pb_ = self.parts.get(a), self.parts.get(b)
            if pa_ is None and pb_ is None:
                return True
            if pb_ is None or (pa_ is not None and pa_[2] > pb_[2]):
                before, a, equal_counts = pa_[2], pa_[1], False
            else:
                before, b, equal_counts = pb_[2], pb_[0], True

    def encode_words(self, words: Iterable[str]) -> dict[str, list[int]]:
        """Ids of distinct, non-empty words (already normalised and split)."""
        neighbours, known, step, ending = self.neighbours, self._ok.get, self.step, self.ending
        root = self.root
        stack: list[tuple[int, int]] = []  # per symbol of the path: last token, its length
        states = [root]  # per symbol of the path: which tokens may still grow
        path, out = "", {}
        for word in sorted(words):
            n, keep, most = len(word), 0, min(len(stack), len(word))
            while keep < most and path[keep] == word[keep]:
                keep += 1
            del stack[keep:]
            del states[keep + 1:]
            state, i = states[-1], keep
            for c in word[keep:-1]:
                i += 1
                try:
                    state = state.next[c]
                except KeyError:
                    state = step(state, c)
                states.append(state)
                for last in state.tokens:
                    t, size = last
                    if size == i:
                        break
                    pair = stack[i - size - 1][0], t
                    ok = known(pair)
                    if neighbours(*pair) if ok is None else ok:
                        break
                else:
                    raise ValueError(f"no token ends {word[:i]!r}")  # the alphabet holds every byte
                stack.append(last)
            state, c = states[n - 1], word[-1]
            for t, size in state.final.get(c) or ending(state, c):
                if size == n or neighbours(stack[n - size - 1][0], t):
                    break
            else:
                raise ValueError(f"no token ends {word!r}")
            ids, i = [t], n - size
            while i:
                t, size = stack[i - 1]
                ids.append(t)
                i -= size
            ids.reverse()
            out[word] = ids
            path = word
        return out

    def step(self, state: State, c: str) -> State:
        """The state after one more symbol (kept on ``state``)."""
        s = state.text + c
        while s and s not in self.prefixes:
            s = s[1:]
        to = self.states.get(s)
        if to is None:
            to = self.states[s] = State(s)
            tails = [(s[k:], len(s) - k) for k in range(len(s))]
            to.tokens = tuple((self.inner[x], size) for x, size in tails if x in self.inner)
        state.next[c] = to
        return to

    def ending(self, state: State, c: str) -> tuple[tuple[int, int], ...]:
        """Tokens that may end a word with symbol ``c`` after ``state``, longest first."""
        s = state.text + c
        tails = [(s[k:], len(s) - k) for k in range(len(s))]
        found = state.final[c] = tuple((self.final[x], size) for x, size in tails if x in self.final)
        return found


class Encoder:
    """Piece memo on top of :class:`Merges`: white-space piece -> (id bytes, token text)."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.memo: dict[str, tuple[bytes, str]] = {}
        self.older: dict[str, tuple[bytes, str]] = {}
        self.held = 0

    def pieces(self, text: str) -> list[str]:
        if any(c in text for c in ODD_SEPARATORS):
            return [p for p in _PLAIN_SPACE.split(text) if p]
        return text.split()

    def _words(self, piece: str) -> list[str | int]:
        """Words of a piece in order; a special token stands as its id."""
        m, out = self.merges, []
        parts = m.special_re.split(piece) if m.special_re else [piece]
        for part in parts:
            if part in m.special:
                out.append(m.special[part])
            elif part:
                out += [w for w, _ in m.split(m.normalise(part)) if w]
        return out

    def _words_of(self, pieces: set[str]) -> dict[str, list[str | int]]:
        """The words of many pieces: those without special tokens are normalised
        and split in one call, joined by spaces, which no word spans."""
        m, out, plain = self.merges, {}, []
        for p in pieces:
            if "<|" in p or p.split() != [p]:
                out[p] = self._words(p)
            else:
                plain.append(p)
        joined = m.normalise(" ".join(plain))
        normal = joined.split(" ")
        if len(normal) != len(plain):  # not for these normalisers; kept for others
            return out | {p: self._words(p) for p in plain}
        found, k, end = m.split(joined), 0, 0
        for p, x in zip(plain, normal, strict=True):
            end += len(x)
            words = out[p] = []
            while k < len(found) and found[k][1][0] < end:
                words.append(found[k][0])
                k += 1
            end += 1
        return out

    def learn(self, pieces: set[str]) -> None:
        """Put ``pieces``, and the runs of letters and signs that some are made of, into the memo."""
        m, runs, others = self.merges, {}, []
        cut = m.plain.cut.fullmatch if m.plain.cut else lambda p: None
        for p in pieces:
            found = cut(p)
            if found:
                letters, signs = found.groups()
                runs[p] = letters.lower(), signs
            else:
                others.append(p)
        fresh = list(self._unknown({x for both in runs.values() for x in both if x}))
        words_of = dict(zip(fresh, m.plain.words(fresh), strict=True))
        others_of = self._words_of(others)
        ids_of = m.encode_words({*words_of.values(), *(w for ws in others_of.values() for w in ws if isinstance(w, str))})
        for p, w in words_of.items():
            self._keep(p, ids_of[w])
        for p, ws in others_of.items():
            self._keep(p, [i for w in ws for i in ((w,) if isinstance(w, int) else ids_of[w])])
        memo = self.memo
        for p, (letters, signs) in runs.items():
            if p not in memo:
                if letters and signs:
                    (a, x), (b, y) = memo[letters], memo[signs]
                    memo[p] = a + b, f"{x} {y}"
                else:
                    memo[p] = memo[letters or signs]
                self.held += 12 + len(p)

    def _keep(self, piece: str, ids: list[int]) -> None:
        text = self.merges.text
        self.memo[piece] = array("I", ids).tobytes(), " ".join([text[i] for i in ids])
        self.held += 12 + len(piece)

    def _unknown(self, pieces: set[str]) -> set[str]:
        """Those of ``pieces`` that the memo lacks; what the older generation has is taken from there."""
        memo, older = self.memo, self.older
        new = {p for p in pieces if p not in memo}
        for p in new & older.keys():
            memo[p] = older[p]
            self.held += 12 + len(p)
            new.discard(p)
        return new

    def block(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """(ids as little-endian 32-bit integers, decoded text) of each text."""
        if self.held > MEMO_CHARS:  # the older generation goes
            self.older, self.memo, self.held = self.memo, {}, 0
        cut = [self.pieces(t) for t in texts]
        new = set()
        for ps in cut:
            new.update(ps)
        new = self._unknown(new)
        if new:
            self.learn(new)
        get = self.memo.__getitem__
        for ps in cut:
            raws, decoded = zip(*map(get, ps), strict=True) if ps else ((), ())
            yield b"".join(raws), " ".join(filter(None, decoded))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def blocks(texts: list[str | None], limit: int = BLOCK_CHARS) -> Iterator[list[str]]:
    """Consecutive runs of whole texts of about ``limit`` characters."""
    run, held = [], 0
    for t in texts:
        t = t or ""
        run.append(t)
        held += len(t)
        if held >= limit:
            yield run
            run, held = [], 0
    if run:
        yield run


def encode_decode(df: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text",
                  keep_ids: bool = False) -> DataFrame:
    """Encode and decode each whole text.

    Returns ``id_col``, ``n_tokens``, ``ids_sha256`` (of the ids as little-endian
    32-bit integers) and ``decoded_sha256``; with ``keep_ids`` also ``ids``
    (array of int) and ``decoded``.
    """
    ship_package(df.sparkSession)
    bound_batches(df.sparkSession)
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if keep_ids:
        schema += ", ids array<int>, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocab_path)
        for b in batches:
            n, sha_ids, sha_text, ids, decoded = [], [], [], [], []
            for block in blocks(b.column(1).to_pylist()):
                for raw, text in enc.block(block):
                    n.append(len(raw) // 4)
                    sha_ids.append(hashlib.sha256(raw).hexdigest())
                    sha_text.append(hashlib.sha256(text.encode()).hexdigest())
                    if keep_ids:
                        ids.append(array("I", raw).tolist())
                        decoded.append(text)
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(sha_ids, pa.string()),
                    pa.array(sha_text, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                cols += [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return src.mapInArrow(run, schema)
