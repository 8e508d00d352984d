"""Secret scans by token efficiency (operator 5).

Base patterns find assignments, access keys and long hexadecimal strings. Beyond them,
a byte-pair vocabulary spends few tokens on text like that it was made from and many on
random strings: key characters whose *characters per token* stay at or below
``MAX_RATIO`` are taken for a secret (kind ``random``). Of a run of key characters are
measured the whole, its pieces between ``=``, ``/``, ``_`` and ``-``, and all windows of
tokens that reach ``LEAST`` characters, so ordinary text beside a random string does not
hide it. Left out, together with the piece that they stand in and nothing more, are

* hexadecimal pieces of a digest's length, and the piece behind the name of a digest,
* UUIDs and times, pieces without a letter, and windows over several short pieces,
* what a base span touches, which is reported already.

Letters without a digit need ``LEAST`` characters or a capital inside; others are measured
from ``SHORT`` characters on. Of the runs of 12 to 19 letters in sf0.1, ordinary words all,
2,744 of 40,508 are at or below the ratio, and none of 36 longer ones.

Runs are measured in slices of ``SLICE`` characters, and where their pieces end is found once
a run, so the time is linear in the text (but for a logarithm) whatever its runs and spans.

Cases: a null text counts as empty; a text without spans has counts of 0, the digest of
the empty string and empty ``spans``; repeated rows are scanned and returned each; an
empty table gives an empty result; only the id and text columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetdw.llm.common import ship_package

KINDS = ("assign", "access", "hex", "random")
# The contract's patterns; their least lengths follow.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # whole runs, as the contract's pattern with 24+ characters
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
#: One of these is in every text with an assignment, in lower case.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

LEAST, SHORT = 20, 12
RUN = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
PIECE = re.compile(r"[A-Za-z0-9+]+")
HEXES = re.compile("[0-9a-fA-F]+")
INNER, LONG = 8, 3  # least piece of a window, longest token at its ends
SEPARATORS = "=/_-"
CAPITAL = re.compile("[a-z][A-Z]")
MAX_RATIO = 2.0
SLICE = 256
# Hexadecimal lengths of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512.
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
UUID = r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}"
TIME = r"[0-9]{8}T[0-9]{4,9}Z?"
DIGEST = r"(md5|sha-?(1|224|256|384|512)|blake2[bs]|crc32|etag|integrity)"
DIGEST_NAME = re.compile(DIGEST + r"[\"'\x20]*[:=-]?[\"'\x20]*$", re.IGNORECASE)
#: What a digest's name stands for: Base64 of a digest's length, or else one piece.
DIGEST_TEXT = r"(?:(?:[A-Za-z0-9+/]{22}|[A-Za-z0-9+/]{27}|[A-Za-z0-9+/]{38}|[A-Za-z0-9+/]{43}|[A-Za-z0-9+/]{64}|[A-Za-z0-9+/]{86})" \
              r"(?![A-Za-z0-9+/])|[A-Za-z0-9+]+)={0,2}"
DIGEST_HERE = re.compile(DIGEST_TEXT)
KNOWN = re.compile(rf"(?<![A-Za-z0-9+])(?:(?:{DIGEST}[=_-])+{DIGEST_TEXT}|(?:{UUID}|{TIME})(?![A-Za-z0-9+]))", re.IGNORECASE)


class Tokens:
    """Counts tokens under a file of ranks."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        self.coder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def ratio(self, run: str) -> float:
        """Characters per token."""
        return len(run) / sum(len(self.coder.encode_ordinary(run[k:k + SLICE])) for k in range(0, len(run), SLICE))

    def windows(self, run: str, max_ratio: float) -> list[tuple[int, int]]:
        """Stretches of windows that reach ``LEAST`` characters within the ratio, without
        the long tokens at their ends."""
        size = [len(self.coder.decode_single_token_bytes(t)) for k in range(0, len(run), SLICE)
                for t in self.coder.encode_ordinary(run[k:k + SLICE])]
        out, i, chars = [], 0, 0
        for j, n in enumerate(size):
            chars += n
            while chars - size[i] >= LEAST:
                chars -= size[i]
                i += 1
            if chars >= LEAST and chars <= max_ratio * (j + 1 - i):
                if out and i <= out[-1][1]:
                    out[-1][1] = j + 1
                else:
                    out.append([i, j + 1])
        at = [0]
        for n in size:
            at.append(at[-1] + n)
        for w in out:
            while w[0] < w[1] and size[w[0]] > LONG:
                w[0] += 1
            while w[0] < w[1] and size[w[1] - 1] > LONG:
                w[1] -= 1
        return [(at[i], at[j]) for i, j in out if i < j]


def known(run: str, before: str) -> list[tuple[int, int]]:
    """Where a run holds digests and identifiers."""
    out = [m.span() for m in KNOWN.finditer(run)]
    out += [m.span() for m in PIECE.finditer(run) if len(m[0]) in DIGEST_LENGTHS and HEXES.fullmatch(m[0])]
    if DIGEST_NAME.search(before) and (m := DIGEST_HERE.match(run)):
        out.append(m.span())
    return out


def telling(part: str) -> bool:
    """Digits among letters, or letters that no ordinary word is made of."""
    if any(c.isdigit() for c in part) and any(c.isalpha() for c in part):
        return len(part) >= LEAST or sum(c.isalpha() for c in part) >= 4
    return any(not p.isdigit() and (len(p) >= LEAST or len(p) >= SHORT and CAPITAL.search(p)) for p in PIECE.findall(part))


def random_parts(part: str, tokens: Tokens, max_ratio: float) -> list[tuple[int, int]]:
    """The whole part, or its pieces and windows of low token efficiency, merged."""
    if len(part) < SHORT or not telling(part):
        return []
    if len(part) >= LEAST and tokens.ratio(part) <= max_ratio:
        return [(0, len(part))]
    found = [m.span() for m in PIECE.finditer(part)
             if len(m[0]) >= SHORT and telling(m[0]) and tokens.ratio(m[0]) <= max_ratio]
    if len(part) > LEAST:
        for i, j in tokens.windows(part, max_ratio):
            if telling(part[i:j]) and any(len(p) >= INNER and not p.isdigit() for p in PIECE.findall(part[i:j])):
                found.append((i, j))
    out = []
    for i, j in sorted(found):
        if out and i <= out[-1][1]:
            out[-1] = (out[-1][0], max(j, out[-1][1]))
        else:
            out.append((i, j))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of the kind, end) of the base patterns."""
    out = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def random_spans(text: str, base: list[tuple[int, int, int]], tokens: Tokens,
                 max_ratio: float) -> list[tuple[int, int, int]]:
    """Parts of runs of low token efficiency that touch no base span."""
    out, k, live = [], 0, []
    for m in RUN.finditer(text):
        run, at = m[0], m.start()
        while k < len(base) and base[k][0] < m.end():
            live.append(base[k])
            k += 1
        live = [b for b in live if b[2] > at]
        if not live and len(run) < LEAST and not telling(run):
            continue
        off = known(run, text[max(0, at - 16):at])
        if live:  # and the rest of the pieces that base spans end in
            cuts = [i for i, c in enumerate(run) if c in SEPARATORS]  # once a run, whatever it holds
            for a, _, z in live:
                i, j = bisect_left(cuts, a - at), bisect_left(cuts, min(z - at, len(run)))
                off.append((cuts[i - 1] + 1 if i else 0, cuts[j] if j < len(cuts) else len(run)))
        last = 0
        for a, z in [*sorted(off), (len(run), len(run))]:
            if a > last:
                out += [(at + last + i, 3, at + last + j) for i, j in random_parts(run[last:a], tokens, max_ratio)]
            last = max(last, z)
    return out


def said(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{z}" for a, k, z in spans)


_TOKENS: dict[str, Tokens] = {}


def find(df: DataFrame, vocab_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
         max_ratio: float = MAX_RATIO) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random and found (array of
    kind, start, end, text). ``vocab_path``: a file of ranks; ``pattern``: how it splits text."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocab_path not in _TOKENS:
            _TOKENS[vocab_path] = Tokens(vocab_path, pattern)
        tokens = _TOKENS[vocab_path]
        kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("text", pa.string())]))
        for b in batches:
            counts, sha, spans, found = [[], [], [], []], [], [], []
            for cell in b.column(1):
                text = cell.as_py() or ""
                base = base_spans(text)
                every = sorted(base + random_spans(text, base, tokens, max_ratio))
                for rank, c in enumerate(counts):
                    c.append(sum(s[1] == rank for s in every))
                sha.append(hashlib.sha256(said(base).encode()).hexdigest())
                spans.append(said(every))
                found.append([{"kind": KINDS[k], "start": a, "end": z, "text": text[a:z]} for a, k, z in every])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.int64()) for c in counts[:3]), pa.array(sha, pa.string()),
                 pa.array(spans, pa.string()), pa.array(counts[3], pa.int64()), pa.array(found, kinds)],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random", "found"])

    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
                               "spans string, n_random long, "
                               "found array<struct<kind:string,start:long,end:long,text:string>>")
