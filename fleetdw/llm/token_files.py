"""Token ids as Re-Pair compressed shards (operator 2).

Documents are range-partitioned and sorted by id, encoded, closed with the end id
and gathered into shards of about ``SHARD_IDS`` ids (documents are never split). A
shard is compressed by Re-Pair: frequent pairs of neighbouring symbols become new symbols
(rules), again and again, until no rule pays: a rule costs 12 bytes in the file and
saves one symbol per occurrence. Pairs are replaced in rounds: the most frequent first, and with
them those of at least a ``1 / ROUND`` of its count that share no symbol with it on the facing
side, so that they cannot overlap. (One pair a round would be the textbook order; the files
are much the same.) Rules are numbered after the shard's distinct ids. Symbols have two bytes as
long as the ids alone need no more: past that number every symbol of the shard would
double, so rules end there.

A shard file (little-endian; one row of a Parquet table in the shared folder, so that
Spark's commit protocol holds when an executor is lost):

    magic "RPR1" | 8 x u32: documents, ids, distinct ids, rules, symbols, index step,
    symbol bytes (2 or 4), 0 | distinct ids u32 | rules 2 x u32 each | expansion lengths
    of the rules u32 | symbols | id position of every ``step``-th symbol u64 | per
    document: id i64, null flag u8, first id position u64

:func:`decode_range` decodes any id range: the index gives the symbol to begin at,
the expansion lengths where it lies.

Encoding: no token spans the border before a blank that follows a visible character,
so texts are cut there. The parts of a block of texts are numbered by Arrow's dictionary
encoding; each distinct part goes through the tokenizers library once per memo, letters and the
signs behind them apart. The ids of all texts are taken by number from one Arrow column of
lists, so there is a Python object per distinct part of a block only. Texts with a blank after
other white space, or with white space other than blank, tab and line ends, are encoded
whole. The memo counts all it holds and is emptied beyond ``MEMO_BYTES``.

Cases: a null text counts as empty; an empty text is just its end id; a null id sorts
first; rows that repeat an id follow each other, ordered by their text's hash, and equal rows
are dealt out like any others; an empty table gives no shard and an empty result; other
columns are not read.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetdw.llm.common import shared_path, ship_package, shuffle_partitions

SHARD_IDS = 1 << 20
RULE_BYTES = 12
ROUND = 16
INDEX_STEP = 256
MEMO_BYTES = 256_000_000
KEY_BYTES = 150  # of Python for an entry, beside its characters
BLOCK_BYTES = 16_000_000
TOGETHER = 128  # parts in one text for the library, which takes longer for each of them in long texts
MAGIC = b"RPR1"
#: Texts to encode whole: a blank after white space; white space besides blank, tab and line
#: ends, and what Python takes for it.
WHOLE = ("[ \\t\\r\\n] |[\\x0b\\x0c\\x1c-\\x1f]|[\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


#: ASCII letters with ASCII signs behind them.
LETTERS_SIGNS = r"^(?P<letters>[A-Za-z]+)(?P<signs>[!-/:-@\[-`{-~]+)$"


class Grown:
    """A numpy array that grows by doubling."""

    def __init__(self, dtype):
        self.data, self.used = np.zeros(1 << 12, dtype), 0

    def extend(self, values: np.ndarray) -> None:
        need = self.used + len(values)
        if need > len(self.data):
            self.data = np.concatenate([self.data, np.zeros(max(need, 2 * len(self.data)) - len(self.data), self.data.dtype)])
        self.data[self.used:need] = values
        self.used = need


def _strings(column: pa.StringArray) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()  # much faster than to_pylist()


def _alternating(a: np.ndarray, a_counts: np.ndarray, b: np.ndarray, b_counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lists joined pair by pair: a's first, b's first, a's second and so on."""
    counts = a_counts + b_counts
    out = np.empty(len(a) + len(b), a.dtype)
    at = np.repeat(np.cumsum(counts) - counts - (np.cumsum(a_counts) - a_counts), a_counts) + np.arange(len(a))
    rest = np.ones(len(out), bool)
    rest[at] = False
    out[at], out[rest] = a, b
    return out, counts


class Memo:
    """Distinct texts, numbered, and their ids in a column of lists."""

    def __init__(self):
        self.number, self.keys = {}, 0
        self.ids, self.ends = Grown(np.uint32), Grown(np.int32)
        self.ends.extend(np.zeros(1, np.int32))

    def held(self) -> int:
        return self.keys + 4 * (self.ids.used + self.ends.used)

    def add(self, words: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        first = len(self.number)
        self.number.update(zip(words, range(first, first + len(words)), strict=True))
        self.ends.extend((self.ids.used + np.cumsum(counts)).astype(np.int32))
        self.ids.extend(ids)
        self.keys += sum(map(len, words)) + KEY_BYTES * len(words)

    def numbers(self, words: list[str], learn) -> np.ndarray:
        """Where ``words`` are; ``learn`` adds those that are not there yet."""
        known = list(map(self.number.get, words))
        fresh = [w for w, k in zip(words, known, strict=True) if k is None]
        if fresh:
            learn(list(dict.fromkeys(fresh)))
            known = list(map(self.number.__getitem__, words))
        return np.array(known, np.int32)

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some entries, joined, and how many each has."""
        lists = pa.ListArray.from_arrays(pa.array(self.ends.data[:self.ends.used]), pa.array(self.ids.data[:self.ids.used]))
        taken = lists.take(pa.array(numbers))
        return taken.flatten().to_numpy(), np.diff(taken.offsets.to_numpy())


class Encoder:
    """Ids of whole texts by the tokenizers library, each distinct part once per memo."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task per core
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_padding()
        self.tok.no_truncation()
        vocab = self.tok.get_vocab(with_added_tokens=False)  # a character stands for a byte
        self.width = np.zeros(self.tok.get_vocab_size() + 1, np.int64)
        for token, i in vocab.items():
            self.width[i] = len(token)
        for i, token in self.tok.get_added_tokens_decoder().items():
            self.width[i] = len(token.content.encode())
        self.forget()

    def forget(self) -> None:
        # with a blank before; first of a text; signs behind letters
        self.parts, self.firsts, self.tails = Memo(), Memo(), Memo()

    def held(self) -> int:
        return self.parts.held() + self.firsts.held() + self.tails.held()

    def _alone(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for x in found for i in x], np.uint32), np.array([len(x) for x in found], np.int64)

    def _learn_firsts(self, words: list[str]) -> None:
        self.firsts.add(words, *self._alone(words))

    def _learn_tails(self, words: list[str]) -> None:
        self.tails.add(words, *self._alone(words))

    def _learn_parts(self, words: list[str]) -> None:
        """Parts with a blank before each. No token spans the border from letters to signs either, so letters
        with signs behind them are put together from the two."""
        cut = pc.extract_regex(pa.array(words, pa.string()), LETTERS_SIGNS)
        both = pc.is_valid(cut)
        letters, signs = (_strings(cut.filter(both).field(k)) for k in (0, 1))
        plain = [w for w, split in zip(words, both.to_numpy(zero_copy_only=False).tolist(), strict=True) if not split]
        self._learn_plain([w for w in dict.fromkeys([*plain, *letters]) if w not in self.parts.number])
        if letters:
            a, a_counts = self.parts.take(self.parts.numbers(letters, self._learn_plain))
            b, b_counts = self.tails.take(self.tails.numbers(signs, self._learn_tails))
            self.parts.add([x + y for x, y in zip(letters, signs, strict=True)], *_alternating(a, a_counts, b, b_counts))

    def _learn_plain(self, words: list[str]) -> None:
        """Many are encoded as one text: no token spans their borders, and the tokens' lengths in bytes
        tell them apart. White space alone, or at the end, would run on into the next part."""
        open_end = [w for w in words if w[-1:] in ("", "\t", "\r", "\n")]
        if open_end:
            self.parts.add(open_end, *self._alone([" " + w for w in open_end]))
        closed = [w for w in words if w[-1:] not in ("", "\t", "\r", "\n")]
        if closed:
            found = self.tok.encode_batch_fast([" " + " ".join(closed[k:k + TOGETHER]) for k in range(0, len(closed), TOGETHER)],
                                               add_special_tokens=False)
            ids = np.concatenate([np.array(e.ids, np.uint32) for e in found])
            own = pc.binary_length(pa.array(closed, pa.string())).to_numpy().astype(np.int64) + 1
            cut = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum(own)) + 1
            self.parts.add(closed, ids, np.diff(cut, prepend=0))

    def _cut(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts that may be cut before blanks, joined, and how many each has."""
        split = pc.split_pattern(texts, " ")
        offsets = split.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        coded = split.flatten().dictionary_encode()
        index, words = coded.indices.to_numpy(), coded.dictionary
        first = offsets[:-1]
        used = np.ones(len(words), bool)  # but for those that only begin a text
        heads, times = np.unique(index[first], return_counts=True)
        used[heads] = np.bincount(index, minlength=len(words))[heads] > times
        by_word = np.zeros(len(words), np.int32)
        by_word[used] = self.parts.numbers(_strings(words.filter(pa.array(used))), self._learn_parts)
        begin, begin_counts = self.firsts.take(self.firsts.numbers(
            _strings(words.take(pa.array(heads))), self._learn_firsts)[np.searchsorted(heads, index[first])])
        rest = np.delete(by_word[index], first)
        ids, counts = self.parts.take(rest)
        after = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])[offsets - np.arange(len(offsets))]
        # every text's first part goes before its rest
        return _alternating(begin, begin_counts, ids, np.diff(after))

    def block(self, texts: pa.StringArray, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, joined, each text's closed with ``end_id``, and how many each has."""
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if self.held() > MEMO_BYTES:
            self.forget()
        whole = pc.match_substring_regex(texts, WHOLE).to_numpy(zero_copy_only=False)
        counts = np.zeros(len(texts), np.int64)
        ids = np.zeros(0, np.uint32)
        if not whole.all():
            ids, counts[~whole] = self._cut(texts.filter(pa.array(~whole)) if whole.any() else texts)
        if whole.any():
            own, own_counts = self._alone(texts.filter(pa.array(whole)).to_pylist())
            before = np.cumsum(counts)[whole]  # ids of cut texts before each of these
            counts[whole] = own_counts
            ids = np.insert(ids, np.repeat(before, own_counts), own)
        if end_id is not None:
            ids = np.insert(ids, np.cumsum(counts), np.uint32(end_id))
            counts = counts + 1
        return ids, counts


# ------------------------------------------------------------------ Re-Pair
def _pairs(left: np.ndarray, right: np.ndarray, symbols: int) -> np.ndarray:
    """left * symbols + right, as narrow as it fits."""
    kind = np.uint32 if symbols <= 1 << 16 else np.uint64
    return left.astype(kind) * kind(symbols) + right.astype(kind)


def _frequent(seq: np.ndarray, symbols: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys (left * symbols + right) and counts of pairs that occur ``least`` times."""
    keys = np.sort(_pairs(seq[:-1], seq[1:], symbols))
    if len(keys) < least:
        return keys[:0], keys[:0]
    long = keys[np.flatnonzero(keys[least - 1:] == keys[:len(keys) - least + 1])]  # ``least`` equal keys in a row
    if not len(long):
        return long, long
    first = np.flatnonzero(np.r_[True, long[1:] != long[:-1]])
    return long[first], np.diff(np.r_[first, len(long)]) + least - 1


def _replaced(seq: np.ndarray, chosen: np.ndarray, symbols: int) -> np.ndarray:
    """``seq`` with the k-th chosen pair as symbol ``symbols + k``."""
    order = np.argsort(chosen)
    known = chosen[order]
    is_left, is_right = np.zeros(symbols, bool), np.zeros(symbols, bool)
    is_left[(chosen // symbols).astype(np.int64)] = True
    is_right[(chosen % symbols).astype(np.int64)] = True
    at = np.flatnonzero(is_left.take(seq)[:-1] & is_right.take(seq)[1:])
    found = _pairs(seq.take(at), seq.take(at + 1), symbols)
    where = np.searchsorted(known, found)
    where[where == len(known)] = 0
    hit = known.take(where) == found
    at, name = at[hit], order.take(where[hit])
    if (at[1:] - at[:-1] == 1).any():  # a pair of equal symbols overlaps itself: every second one of a run counts
        run = np.flatnonzero(np.r_[True, np.diff(at) != 1])
        odd = (at - np.repeat(at[run], np.diff(np.r_[run, len(at)]))) % 2 == 1
        at, name = at[~odd], name[~odd]
    seq[at] = name + symbols
    keep = np.ones(len(seq), bool)
    keep[at + 1] = False
    return seq[keep]


def compress(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct ids, rules, expansion lengths of the rules, symbols)."""
    used = np.bincount(ids) > 0 if len(ids) else np.zeros(0, bool)
    alphabet = np.flatnonzero(used)
    seq = (np.cumsum(used, dtype=np.int32) - 1)[ids]
    width = 2 if len(alphabet) <= 1 << 16 else 4
    room = (1 << 16) - len(alphabet) if width == 2 else 1 << 31
    least = RULE_BYTES // width + 1  # so many occurrences save more than the rule costs
    rules = np.zeros((0, 2), np.int64)
    while len(seq) > 1 and len(rules) < room:
        symbols = len(alphabet) + len(rules)
        keys, counts = _frequent(seq, symbols, least)
        if not len(keys):
            break
        high = counts * ROUND >= counts.max()
        keys, counts = keys[high], counts[high]
        keys = keys[np.lexsort((keys, -counts))]
        lefts, rights, chosen = bytearray(symbols), bytearray(symbols), []
        for k, (a, b) in enumerate(zip((keys // symbols).tolist(), (keys % symbols).tolist(), strict=True)):
            if not rights[a] and not lefts[b]:
                lefts[a] = rights[b] = 1
                chosen.append(k)
        chosen = keys[chosen[:room - len(rules)]]
        seq = _replaced(seq, chosen, symbols)
        rules = np.concatenate([rules, np.stack(np.divmod(chosen.astype(np.int64), symbols), axis=1)])
    size = [1] * len(alphabet)
    for a, b in rules.tolist():
        size.append(size[a] + size[b])
    return alphabet.astype(np.uint32), rules.astype(np.uint32), np.array(size[len(alphabet):], np.uint32), seq


def pack(doc_ids: list[int | None], ids: np.ndarray, counts: np.ndarray) -> bytes:
    """A shard file of documents and their ids: all joined, and how many each has."""
    alphabet, rules, sizes, seq = compress(ids)
    width = 2 if len(alphabet) + len(rules) <= 1 << 16 else 4
    full = np.concatenate([np.ones(len(alphabet), np.int64), sizes])
    ends = np.cumsum(full[seq])
    docs = np.zeros(len(doc_ids), [("id", "<i8"), ("null", "u1"), ("start", "<u8")])
    docs["id"] = [0 if d is None else d for d in doc_ids]
    docs["null"] = [d is None for d in doc_ids]
    docs["start"] = np.cumsum(counts) - counts
    return b"".join([
        MAGIC, struct.pack("<8I", len(doc_ids), len(ids), len(alphabet), len(rules), len(seq), INDEX_STEP, width, 0),
        alphabet.astype("<u4").tobytes(), rules.astype("<u4").tobytes(), sizes.astype("<u4").tobytes(),
        seq.astype(f"<u{width}").tobytes(), (ends - full[seq])[::INDEX_STEP].astype("<u8").tobytes(), docs.tobytes()])


class Shard:
    """A shard file, opened."""

    def __init__(self, blob: bytes):
        if blob[:4] != MAGIC:
            raise ValueError("not a shard file")
        n_docs, self.n_ids, n_alpha, n_rules, n_seq, self.step, width, _ = struct.unpack_from("<8I", blob, 4)
        at = 36

        def take(dtype, n):
            nonlocal at
            out = np.frombuffer(blob, dtype, n, at)
            at += out.nbytes
            return out

        self.alphabet = take("<u4", n_alpha)
        rules = take("<u4", 2 * n_rules).reshape(-1, 2)
        self.size = np.concatenate([np.ones(n_alpha, np.int64), take("<u4", n_rules)])
        self.seq = take(f"<u{width}", n_seq)
        self.index = take("<u8", -(-n_seq // self.step))
        self.docs = take([("id", "<i8"), ("null", "u1"), ("start", "<u8")], n_docs)
        self.at = np.cumsum(self.size) - self.size
        self.table = np.zeros(int(self.size.sum()), np.uint32)
        self.table[:n_alpha] = self.alphabet
        # rules whose parts are expanded already, all at once, level by level
        level = [0] * n_alpha
        for a, b in rules.tolist():
            level.append(1 + max(level[a], level[b]))
        level = np.array(level)
        for k in range(1, int(level.max(initial=0)) + 1):
            here = np.flatnonzero(level == k)
            a, b = rules[here - n_alpha].T
            both = np.stack([a, b], axis=1).ravel()
            to = np.repeat(self.at[here] - (np.cumsum(self.size[here]) - self.size[here]), self.size[here])
            self.table[to + np.arange(len(to))] = self._expand(both)

    def _expand(self, seq: np.ndarray) -> np.ndarray:
        n = self.size[seq]
        before = np.cumsum(n) - n
        return self.table[np.repeat(self.at[seq] - before, n) + np.arange(n.sum())]

    def ids(self) -> np.ndarray:
        return self._expand(self.seq)


def decode_range(shard: Shard, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` (exclusive) of a shard, reading only the symbols they lie in."""
    start, stop = max(0, start), min(stop, shard.n_ids)
    if start >= stop:
        return np.zeros(0, np.uint32)
    k = int(np.searchsorted(shard.index, start, side="right")) - 1
    m = int(np.searchsorted(shard.index, stop, side="left"))
    skip = int(shard.index[k])
    return shard._expand(shard.seq[k * shard.step:m * shard.step])[start - skip:stop - skip]


# ------------------------------------------------------------------ Spark
_ENCODERS: dict[str, Encoder] = {}


def _blocks(texts: pa.StringArray, names: pa.Array) -> Iterator[tuple[pa.StringArray, pa.Array]]:
    """Consecutive whole texts of about ``BLOCK_BYTES``, with their names."""
    upto, a = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)), 0
    while a < len(texts):
        before = int(upto[a - 1]) if a else 0
        z = min(int(np.searchsorted(upto, before + BLOCK_BYTES)) + 1, len(texts))
        yield texts.slice(a, z - a), names.slice(a, z - a)
        a = z


def write(df: DataFrame, vocab_path: str, path: str, end_id: int = 2, id_col: str = "doc_id",
          text_col: str = "text") -> None:
    """Write the documents' ids as shards below ``path``, in ascending id order: partitions
    (``part``) ascend, and so do the shards in them."""
    ship_package(df.sparkSession)
    src = df.select(F.col(id_col).cast("long").alias("doc_id"),
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # the last key only deals equal rows out to several partitions
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc(), F.col("tie").asc()]
    ranged = (src.withColumn("tie", F.monotonically_increasing_id())
              .repartitionByRange(shuffle_partitions(df.sparkSession), *keys).sortWithinPartitions(*keys).drop("tie"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _ENCODERS.setdefault(vocab_path, None) or Encoder(vocab_path)
        _ENCODERS[vocab_path] = enc
        part, shard, docs, ids, counts = TaskContext.get().partitionId(), 0, [], [], []

        def flush():
            whole = np.concatenate(ids)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([len(whole)], pa.int64()),
                 pa.array([pack(docs, whole, np.concatenate(counts))], pa.binary())], names=["part", "shard", "n_ids", "file"])

        held = 0
        for b in batches:
            for texts, names in _blocks(b.column(1), b.column(0)):
                found, n = enc.block(texts, end_id)
                names, upto, done = names.to_pylist(), np.cumsum(n), 0
                while done < len(names):
                    begin = int(upto[done - 1]) if done else 0
                    # the document that fills the shard is its last one
                    last = min(int(np.searchsorted(upto, begin + SHARD_IDS - held)) + 1, len(names))
                    docs += names[done:last]
                    ids.append(found[begin:upto[last - 1]])
                    counts.append(n[done:last])
                    held, done = held + int(upto[last - 1]) - begin, last
                    if held >= SHARD_IDS:
                        yield flush()
                        shard, docs, ids, counts, held = shard + 1, [], [], [], 0
        if docs:
            yield flush()

    ranged.mapInArrow(run, "part int, shard int, n_ids long, file binary").write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    ship_package(spark)
    shards = spark.read.schema("part int, shard int, n_ids long, file binary").parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, number, blob in zip(*(c.to_pylist() for c in b.columns), strict=True):
                s = Shard(blob)
                raw, n = s.ids().astype("<u4").tobytes(), len(s.docs)
                starts = s.docs["start"].astype(np.int64)
                ends = np.r_[starts[1:], s.n_ids]
                crc = [zlib.crc32(raw[4 * a:4 * z]) for a, z in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, number, np.int32)),
                     pa.array(s.docs["id"].astype(np.int64), mask=s.docs["null"].astype(bool)), pa.array(starts),
                     pa.array(ends - starts), pa.array(crc, pa.int64())],
                    names=["part", "shard", "doc_id", "local", "n_tokens", "ids_crc32"])

    docs = shards.select("part", "shard", "file").mapInArrow(
        run, "part int, shard int, doc_id long, local long, n_tokens long, ids_crc32 long")
    sizes = shards.select("part", "shard", "n_ids")
    upto = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # one row a partition, as many as the session's shuffle partitions
    parts = (sizes.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
             .select("part", upto(W.orderBy("part")).alias("part_start")))
    offsets = (sizes.select("part", "shard", upto(W.partitionBy("part").orderBy("shard")).alias("shard_start"))
               .join(parts, "part"))
    return docs.join(offsets, ["part", "shard"]).select(
        "doc_id", (F.col("part_start") + F.col("shard_start") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(df: DataFrame, vocab_path: str, end_id: int = 2) -> DataFrame:
    """Write the shards to a new shared folder and read them back."""
    path = shared_path(df.sparkSession, "token-shards")
    write(df, vocab_path, path, end_id)
    return read(df.sparkSession, path)
