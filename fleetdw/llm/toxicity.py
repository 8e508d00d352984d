"""Toxicity by a bidirectional gated recurrent network (operator 1), in numpy.

A text is a sequence of words, seen through windows of ``WINDOW`` words. Scoring looks at the windows
at all offsets of the whole text, however long (:meth:`Network.every`), and at the filled-up window at its
end that learning cuts, too. Each word enters as the pair of

* a word input: an embedding of the hashed lower-case word, and
* a character input: the mean embedding of its hashed character n-grams, with marks
  at both ends, so that stems and inflections count.

Two gated recurrent networks read a window forwards and backwards; attention weights
their joint states; a linear layer on the pooled state gives the window's log-odds.
A text scores as its highest window.

Learning (multiple instance): a document has its label, and its windows are the
instances; each epoch scores the windows of the sample, cut at another offset each time,
then learns from the highest windows of each document. The sample is bounded and seeded: at
most ``SAMPLE`` documents a class, taken from the labelled documents of at most ``SAMPLE_CHARS``
characters that are there. Text is the only input of a score.

Scoring runs in Arrow batches; a word's input to the networks is computed once per
task and kept while the memo holds at most ``MEMO_WORDS`` words.

Cases: a null or empty text, or one of white space only, has the score of a window
without words; without labels of both classes there is no model and every score is 0;
repeated rows score alike; a document labelled twice has the highest
label, and of rows that repeat an id the sample takes the smallest text; an
empty table gives an empty result; only id and text are read from the documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetdw.llm.bpe import blocks
from fleetdw.llm.common import bound_batches, ship_package

WINDOW, STRIDE = 32, 28
HIDDEN = 8
WORD_ROWS, CHAR_ROWS, WORD_DIM, CHAR_DIM = 1 << 14, 1 << 15, 8, 12
NGRAMS = (3, 4, 5, 6, 7)
SAMPLE, SAMPLE_CHARS, SEED = 2000, 20_000, 7
EPOCHS, STEPS, BATCH = 4, 400, 64  # at least so many passes and updates
MEMO_WORDS = 150_000
WINDOWS_AT_ONCE = 2048
OFFSETS_AT_ONCE = 3072
WORDS_AT_ONCE = 1 << 13
BLOCK_CHARS = 2_000_000
EDGE = "\"'`.,;:!?()[]{}<>|*&%$#@~^_=+-/\\"


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


class Rows:
    """Rows of the embedding tables of a list of words: ``word`` has one a word, ``char`` the
    n-grams' of all words one after the other, word ``i`` from ``start[i]`` to ``start[i + 1]``.
    Row 0 of either table stands for no word."""

    def __init__(self, pieces: list[str], pad: bool = False):
        marked = [f"\x02{p.lower().strip(EDGE) or p}\x03".encode() for p in pieces]
        size = np.fromiter(map(len, marked), np.int64, len(marked))
        self.word = np.fromiter(map(zlib.crc32, marked), np.int64, len(marked)) % (WORD_ROWS - 1) + 1
        per_n = [np.maximum(size - n + 1, 0) for n in NGRAMS]  # every word has a 3-gram
        counts = np.sum(per_n, axis=0, dtype=np.int64) if len(size) else size
        self.start = np.concatenate([[0], np.cumsum(counts)])
        self.char = np.zeros(self.start[-1], np.uint16)
        if len(marked):
            letters = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint32)
            left = np.repeat(np.cumsum(size), size) - np.arange(len(letters))  # letters from there to the word's end
            h, factor, done = np.zeros(len(letters), np.uint32), 1, self.start[:-1].copy()
            for k in range(max(NGRAMS)):  # hash of the n letters from each place on, modulo 2 ** 32
                h[:len(letters) - k] += letters[k:] * np.uint32(factor)
                factor = factor * 0x01000193 % (1 << 32)
                if k + 1 in NGRAMS:
                    own = per_n[NGRAMS.index(k + 1)]
                    mixed = h[left > k]  # of each word, the first ``own`` places
                    mixed ^= np.uint32(k)
                    mixed *= np.uint32(0x9E3779B1)
                    mixed >>= np.uint32(8)
                    mixed -= mixed // np.uint32(CHAR_ROWS - 1) * np.uint32(CHAR_ROWS - 1)  # faster than numpy's %
                    mixed += np.uint32(1)
                    self.char[np.arange(len(mixed)) + np.repeat(done - (np.cumsum(own) - own), own)] = mixed
                    done += own
        if pad:  # number 0: no word
            self.word = np.concatenate([[0], self.word])
            self.char = np.concatenate([np.zeros(1, np.uint16), self.char])
            self.start = np.concatenate([[0], self.start + 1])

    @classmethod
    def of(cls, pieces: list[str]) -> Rows:
        """Number 0, then all pieces; made in parts, to need little memory besides."""
        parts = [cls(pieces[k:k + WORDS_AT_ONCE], pad=k == 0) for k in range(0, max(1, len(pieces)), WORDS_AT_ONCE)]
        out = cls([])
        out.word, out.char = (np.concatenate([getattr(p, a) for p in parts]) for a in ("word", "char"))
        out.start = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p.start) for p in parts]))])
        return out

    def pick(self, i: np.ndarray) -> Rows:
        """The rows of some of the words."""
        out = Rows([])
        counts = np.diff(self.start)[i]
        out.word, out.start = self.word[i], np.concatenate([[0], np.cumsum(counts)])
        out.char = self.char[np.arange(out.start[-1]) + np.repeat(self.start[i] - out.start[:-1], counts)]
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


class Network:
    """Parameters ``p`` (float32) with the forward and backward passes."""

    def __init__(self, seed: int = SEED):
        g = np.random.default_rng(seed)
        n = lambda *s, scale: (g.standard_normal(s) * scale).astype(np.float32)
        d = WORD_DIM + CHAR_DIM
        self.p = {"word": n(WORD_ROWS, WORD_DIM, scale=0.3), "char": n(CHAR_ROWS, CHAR_DIM, scale=0.5),
                  "att": n(2 * HIDDEN, scale=0.1), "out": n(2 * HIDDEN, scale=0.3), "bias": np.zeros(1, np.float32)}
        for side in "fb":
            self.p |= {f"w{side}": n(d, 3 * HIDDEN, scale=d ** -0.5), f"u{side}": n(HIDDEN, 3 * HIDDEN, scale=HIDDEN ** -0.5),
                       f"c{side}": np.zeros(3 * HIDDEN, np.float32)}

    # -- words
    def inputs(self, rows: Rows) -> np.ndarray:
        """(words, WORD_DIM + CHAR_DIM)"""
        if not len(rows.word):
            return np.zeros((0, WORD_DIM + CHAR_DIM), np.float32)
        size = np.diff(rows.start)
        longest = np.argsort(-size, kind="stable")
        first, left = rows.start[longest], np.searchsorted(-size[longest], -np.arange(size.max()))
        chars, grams = np.zeros((len(size), CHAR_DIM), self.p["char"].dtype), rows.char.astype(np.intp)
        part = np.empty_like(chars)
        for k, n in enumerate(left.tolist()):  # the k-th n-gram of the words that have one; "clip", as "raise" copies
            chars[:n] += self.p["char"].take(grams.take(first[:n] + k), axis=0, out=part[:n], mode="clip")
        mean = np.empty_like(chars)
        mean[longest] = chars / size[longest, None].astype(np.float32)
        return np.hstack([self.p["word"].take(rows.word, axis=0), mean])

    def gates(self, x: np.ndarray) -> np.ndarray:
        """Both networks' input sums of each word: (words, 6 * HIDDEN)."""
        return np.hstack([x @ self.p["wf"] + self.p["cf"], x @ self.p["wb"] + self.p["cb"]])

    def all_gates(self, rows: Rows) -> np.ndarray:
        out = np.empty((len(rows.word), 6 * HIDDEN), np.float32)
        for k in range(0, len(out), WORDS_AT_ONCE):
            some = np.arange(k, min(len(out), k + WORDS_AT_ONCE))
            out[some] = self.gates(self.inputs(rows.pick(some)))
        return out

    # -- windows; states are (HIDDEN, windows), so that every step works on whole rows
    def _run(self, gx, at, side, keep):
        """One network over the windows; states in window order."""
        h2, t_all = 2 * HIDDEN, range(at.shape[1])
        uzr, un = (np.ascontiguousarray(x.T) for x in np.split(self.p[f"u{side}"], [h2], axis=1))
        h = np.zeros((HIDDEN, len(at)), np.float32)
        states, saved = np.empty((at.shape[1], HIDDEN, len(at)), np.float32), []
        for t in (t_all if side == "f" else reversed(t_all)):
            g = np.ascontiguousarray(gx[at[:, t]].T)
            zr = g[:h2]
            zr += uzr @ h
            _sigmoid(zr)
            hu = un @ h
            n = zr[HIDDEN:] * hu
            n += g[h2:]
            np.tanh(n, out=n)
            if keep:
                saved.append((t, h, zr, hu, n))
            h = h - n
            h *= zr[:HIDDEN]
            h += n
            states[t] = h
        return states, saved

    @staticmethod
    def halves(gates: np.ndarray) -> list[np.ndarray]:
        """The input sums of each network, apart."""
        return [np.ascontiguousarray(g) for g in np.split(gates, 2, axis=1)]

    def forward(self, gates: np.ndarray | list[np.ndarray], at: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Log-odds of each window. ``at``: rows of ``gates`` (or their :meth:`halves`); ``mask``: 1 where
        there is a word."""
        each = gates if isinstance(gates, list) else self.halves(gates)
        runs = [self._run(g, at, side, keep) for g, side in zip(each, "fb", strict=True)]
        att, live = np.split(self.p["att"], 2), np.ascontiguousarray(mask.T)
        a = sum(np.einsum("h,thb->tb", w, s) for w, (s, _) in zip(att, runs, strict=True))
        a -= 1e4 * (1 - live)
        np.exp(a - a.max(axis=0), out=a)
        a *= live
        a /= a.sum(axis=0) + 1e-9
        pooled = np.concatenate([np.einsum("tb,thb->hb", a, s) for s, _ in runs])
        odds = self.p["out"] @ pooled + self.p["bias"][0]
        return (odds, (a, pooled, runs)) if keep else odds

    @np.errstate(over="ignore")  # what is divided by an infinite exp2(x) is 0, as it should be
    def every(self, gates: list[np.ndarray], numbers: np.ndarray) -> np.ndarray:
        """Log-odds of the windows of ``numbers`` (no word is 0) at all offsets, as :meth:`forward` gives them.

        Windows that start next to each other read neighbouring words at each step, so a step reads a
        stretch of the text as it lies; of a state only its share in attention and in the result is kept."""
        h2, h3 = 2 * HIDDEN, 3 * HIDDEN
        att, out = np.split(self.p["att"], 2), np.split(self.p["out"], 2)
        # a sigmoid is 1 / (1 + exp(-x)) and tanh(x) is 1 - 2 / (1 + exp(2 * x)), and exp(x) is exp2(x * log2(e)), as
        # numpy's exp2 takes half the time of its exp; the factors of x are in the weights and in ``g``. A state h is
        # kept as q = (1 - h) / 2, below which a row of ones gives the sums of the weights
        factor = np.repeat(np.array([-1, 2]) * np.log2(np.e), [h2, HIDDEN])[:, None]
        weights = [np.vstack([factor * self.p[f"u{side}"].T, att[i][None], out[i][None]]) for i, side in enumerate("fb")]
        weights = [np.hstack([-2 * w, w.sum(axis=1, keepdims=True)]).astype(np.float32) for w in weights]
        factor, one = factor.astype(np.float32), np.float32(1)
        odds = np.empty(len(numbers) - WINDOW + 1, np.float32)
        for k in range(0, len(odds), OFFSETS_AT_ONCE):
            n = min(OFFSETS_AT_ONCE, len(odds) - k)
            total, both = np.zeros((WINDOW, 2, n), np.float32), np.empty((h3 + 2, n), np.float32)
            zr, z, r, hu, shares = both[:h2], both[:HIDDEN], both[HIDDEN:h2], both[h2:h3], both[h3:]
            for gate, w, order in zip(gates, weights, (range(WINDOW), range(WINDOW - 1, -1, -1)), strict=True):
                g = np.ascontiguousarray(gate.take(numbers[k:k + n + WINDOW - 1], axis=0).T)
                g *= factor
                state, before = np.ones((HIDDEN + 1, n), np.float32), None
                q = state[:HIDDEN]
                q *= 0.5
                for t in order:
                    np.matmul(w, state, out=both)
                    if before is not None:
                        total[before] += shares
                    before = t
                    zr += g[:h2, t:t + n]
                    np.exp2(zr, out=zr)
                    zr += one
                    np.divide(hu, r, out=r)
                    r += g[h2:, t:t + n]
                    np.exp2(r, out=r)
                    r += one
                    np.reciprocal(r, out=r)  # the new state
                    q -= r
                    q /= z
                    q += r
                total[before] += w[h3:] @ state
            a = total[:, 0]
            a -= a.max(axis=0)
            np.exp(a, out=a)
            odds[k:k + n] = np.einsum("tb,tb->b", a, total[:, 1]) / (a.sum(axis=0) + 1e-9)
        odds += self.p["bias"][0]
        return odds

    def backward(self, gates, at, saved, d_odds):
        """Gradients of the parameters above the words, and of ``gates``."""
        a, pooled, runs = saved
        h1, h2 = HIDDEN, 2 * HIDDEN
        grad = {"out": pooled @ d_odds, "bias": np.array([d_odds.sum()], np.float32)}
        d_pool = np.split(self.p["out"][:, None] * d_odds, 2)
        d_a = sum(np.einsum("hb,thb->tb", d, s) for d, (s, _) in zip(d_pool, runs, strict=True))
        d_e = a * (d_a - (a * d_a).sum(axis=0))
        grad["att"] = np.concatenate([np.einsum("tb,thb->h", d_e, s) for s, _ in runs])
        d_gates = []
        words = at.T.ravel()
        where = np.argsort(words, kind="stable")
        starts = np.searchsorted(words[where], np.arange(len(gates)))
        for side, (_, kept), d, w in zip("fb", runs, d_pool, np.split(self.p["att"], 2), strict=True):
            u = self.p[f"u{side}"]
            du, dh = np.zeros_like(u), np.zeros((h1, len(at)), np.float32)
            steps = np.empty((at.shape[1], len(at), 3 * h1), np.float32)
            for t, h, zr, hu, n in reversed(kept):
                z, r = zr[:h1], zr[h1:]
                dh = dh + a[t] * d + d_e[t] * w[:, None]
                d_n = dh * (1 - z) * (1 - n * n)
                d_zr = np.concatenate([dh * (h - n), d_n * hu]) * zr * (1 - zr)
                d_hu = d_n * r
                du[:, :h2] += h @ d_zr.T
                du[:, h2:] += h @ d_hu.T
                steps[t] = np.concatenate([d_zr, d_n]).T
                dh = dh * z + u[:, :h2] @ d_zr + u[:, h2:] @ d_hu
            grad[f"u{side}"] = du
            d_gates.append(np.add.reduceat(steps.reshape(-1, 3 * h1)[where], starts, axis=0))
        return grad, np.hstack(d_gates)


class Reader:
    """Turns texts into windows of word numbers; ``gates`` of a word are computed once."""

    def __init__(self, net: Network):
        self.net = net
        self.clear()

    def clear(self):
        self.number: dict[str, int] = {}
        self.tables = [self.net.halves(self.net.gates(self.net.inputs(Rows([], pad=True))))]  # number 0: no word

    def numbers(self, texts: list[str], in_order: bool = False) -> list[np.ndarray]:
        """Word numbers of each text; ``in_order``: of the new words, by alphabet."""
        if len(self.number) > MEMO_WORDS:
            self.clear()
        cut = pc.utf8_split_whitespace(pa.array(texts, pa.large_string()))  # as str.split(), but for empty ends
        coded, number = cut.flatten().dictionary_encode(), self.number
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        fresh = [w for w in words if w and w not in number]
        if in_order:
            fresh.sort()
        number.update(zip(fresh, range(len(number) + 1, len(number) + len(fresh) + 1), strict=True))
        self.tables += [self.net.halves(self.net.gates(self.net.inputs(Rows(fresh[k:k + WORDS_AT_ONCE]))))
                        for k in range(0, len(fresh), WORDS_AT_ONCE)]
        found = np.fromiter(map(number.get, words, repeat(0)), np.int32, len(words))[coded.indices.to_numpy()]
        there = found > 0
        upto = np.concatenate([[0], np.cumsum(there)])[cut.offsets.to_numpy()[1:]]
        return np.split(found[there], upto)[:-1]

    @property
    def gates(self) -> list[np.ndarray]:
        """Input sums of all words so far, by number, apart for each network."""
        if len(self.tables) > 1:
            self.tables = [[np.concatenate(side) for side in zip(*self.tables, strict=True)]]
        return self.tables[0]


def windows(numbers: np.ndarray, offset: int = 0) -> np.ndarray:
    """Overlapping windows of a text to learn from, every ``STRIDE``-th from ``offset`` words before its
    begin on, filled up with 0: (windows, WINDOW)."""
    n = max(1, -(-max(0, len(numbers) + offset - WINDOW) // STRIDE) + 1)
    full = np.zeros((n - 1) * STRIDE + WINDOW, np.int32)
    full[offset:offset + len(numbers)] = numbers
    return np.lib.stride_tricks.sliding_window_view(full, WINDOW)[::STRIDE]


def between(numbers: np.ndarray, near: np.ndarray) -> np.ndarray:
    """The windows that start less than ``STRIDE`` words from those numbered ``near`` of :func:`windows`
    and that are not among these."""
    last = len(numbers) - WINDOW
    if last <= 0 or not len(near):
        return np.zeros((0, WINDOW), np.int32)
    hit = np.zeros(last + 1, bool)
    for k in near.tolist():
        hit[max(0, (k - 1) * STRIDE + 1):(k + 1) * STRIDE] = True
    hit[::STRIDE] = False
    return np.lib.stride_tricks.sliding_window_view(numbers, WINDOW)[hit]


def window_odds(net: Network, gates: np.ndarray | list[np.ndarray], at: np.ndarray) -> np.ndarray:
    if not len(at):
        return np.zeros(0, np.float32)
    gates = gates if isinstance(gates, list) else net.halves(gates)  # once, not per part
    out = [net.forward(gates, a := at[k:k + WINDOWS_AT_ONCE], (a > 0).astype(np.float32))
           for k in range(0, len(at), WINDOWS_AT_ONCE)]
    return np.concatenate(out)


def train(texts: list[str], labels: list[int], seed: int = SEED) -> Network:
    """Learn from whole documents with one label each."""
    net, g = Network(seed), np.random.default_rng(seed)
    reader = Reader(net)
    numbers = reader.numbers(texts, in_order=True)
    y = np.asarray(labels, np.float32)
    rows = Rows.of(list(reader.number))
    del reader
    moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.p.items()}
    epoch, step, rate = 0, 0, 0.01
    while epoch < EPOCHS or step < STEPS:
        # a passage lies anywhere in a window: cut the texts elsewhere every time
        shift = g.integers(0, STRIDE, len(numbers)) if epoch else np.zeros(len(numbers), np.int64)
        per_doc = [windows(x, int(o) if len(x) > WINDOW else 0) for x, o in zip(numbers, shift, strict=True)]
        at = np.concatenate(per_doc)
        doc = np.repeat(np.arange(len(per_doc)), [len(w) for w in per_doc])
        first = np.flatnonzero(np.r_[True, np.diff(doc) > 0])
        odds = window_odds(net, net.all_gates(rows), at) + g.random(len(at)).astype(np.float32) * 1e-3
        top = 3 if epoch < 2 else 1
        epoch += 1
        order = np.lexsort((-odds, doc))
        rank = np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)]))
        keep = order[(rank < np.where(y[doc[order]] > 0, top, 3))]
        g.shuffle(keep)
        for k in range(0, len(keep), BATCH):
            pick = keep[k:k + BATCH]
            used, inner = np.unique(at[pick], return_inverse=True)
            inner = inner.reshape(len(pick), WINDOW)
            mask = (at[pick] > 0).astype(np.float32)
            here = rows.pick(used)
            x = net.inputs(here)
            gates = net.gates(x)
            odds_b, saved = net.forward(gates, inner, mask, keep=True)
            d = (1 / (1 + np.exp(-odds_b)) - y[doc[pick]]).astype(np.float32) / len(pick)
            grad, dg = net.backward(gates, inner, saved, d)
            cut = 3 * HIDDEN
            dx = dg[:, :cut] @ net.p["wf"].T + dg[:, cut:] @ net.p["wb"].T
            grad |= {"wf": x.T @ dg[:, :cut], "wb": x.T @ dg[:, cut:], "cf": dg[:, :cut].sum(0), "cb": dg[:, cut:].sum(0)}
            step += 1
            for name, gr in grad.items():
                m, v = moment[name]
                m += 0.1 * (gr - m)
                v += 0.001 * (gr * gr - v)
                net.p[name] -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
            _adagrad(net.p["word"], moment["word"][1], here.word, dx[:, :WORD_DIM])
            sizes = np.diff(here.start)
            _adagrad(net.p["char"], moment["char"][1], here.char,
                     np.repeat(dx[:, WORD_DIM:] / sizes[:, None], sizes, axis=0))
    return net


def _adagrad(table, seen, at, grad, rate: float = 0.1):
    """Rows of an embedding move by their own summed gradient."""
    order = np.argsort(at, kind="stable")
    rows = at[order]
    starts = np.flatnonzero(np.r_[True, np.diff(rows) > 0])
    rows, g = rows[starts], np.add.reduceat(grad[order], starts, axis=0)
    seen[rows] += g * g
    table[rows] -= rate * g / (np.sqrt(seen[rows]) + 1e-6)


def score_texts(net: Network | None, reader: Reader | None, texts: list[str]) -> np.ndarray:
    """The highest window of each text, of those at all offsets, as a probability."""
    if net is None:
        return np.zeros(len(texts))
    numbers = reader.numbers(texts)
    ends = np.concatenate([windows(x)[-1:] for x in numbers])  # the whole text, if it is short
    highest = window_odds(net, reader.gates, ends).astype(np.float64)
    long = [i for i, x in enumerate(numbers) if len(x) > WINDOW]
    if long:
        odds = net.every(reader.gates, np.concatenate([numbers[i] for i in long]))
        size = np.array([len(numbers[i]) for i in long])
        first = np.cumsum(size) - size
        own = np.ravel([first, first + size - WINDOW + 1], "F")  # from there on, windows reach into the next text
        best = np.maximum.reduceat(np.append(odds, np.float32(-np.inf)), own)[::2]
        highest[long] = np.maximum(highest[long], best)
    return 1 / (1 + np.exp(-highest))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Network | None:
    """Learn from a bounded, seeded sample of labelled rows that are not held out."""
    usable = docs.where(F.length(F.col("text").cast("string")).between(1, SAMPLE_CHARS)).select(
        F.col("doc_id").cast("long").alias("doc_id"))
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).join(usable, "doc_id", "left_semi"))
    picked = None
    for value in (0, 1):
        part = known.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        picked = part if picked is None else picked.unionByName(part)
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .where(F.length("text").between(1, SAMPLE_CHARS))
            .join(F.broadcast(picked), "doc_id").groupBy("doc_id")
            .agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).collect())
    rows.sort(key=lambda r: r["doc_id"])
    if len({r["toxic"] for r in rows}) < 2:
        return None
    return train([r["text"] for r in rows], [int(r["toxic"]) for r in rows])


def _scorer(df: DataFrame, net: Network | None):
    """A function from texts to scores, for Python workers."""
    spark = df.sparkSession
    ship_package(spark)
    bound_batches(spark)
    sent = spark.sparkContext.broadcast(None if net is None else net.p)  # a fixed size

    def scorer():
        model = reader = None
        if sent.value is not None:
            model = Network.__new__(Network)
            model.p = sent.value
            reader = Reader(model)
        return lambda texts: np.concatenate(
            [np.zeros(0), *(score_texts(model, reader, block) for block in blocks(texts, BLOCK_CHARS))])

    return scorer


def score(df: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score for every row; all of every text is read."""
    scorer = _scorer(df, net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = scorer()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores(b.column(1).to_pylist()), pa.float64())],
                                             names=["doc_id", "score"])

    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, score double")


def keep_clean(df: DataFrame, net: Network | None, text_col: str = "text", below: float = 0.5) -> DataFrame:
    """The rows of ``df``, as they are, whose text scores below ``below``."""
    scorer, at = _scorer(df, net), df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = scorer()
        for b in batches:
            yield b.filter(pa.array(scores(b.column(at).to_pylist()) < below))

    return df.mapInArrow(run, df.schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    return score(docs, fit(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
