"""Personal data by candidate gradient boosting (operator 8), all in DataFrame
functions.

1. *Generators* propose spans: one per contract kind (``BASE``) and looser ones
   (``LOOSE``) for spelled-out addresses, telephone numbers without a plus and
   card-like digit groups. They overlap freely.
2. A base match that passes its kind's check is a base span and always stays.
3. *Boosted trees* score every candidate from its format (digits, separators)
   and context (neighbouring characters, words before it), both read from its
   *base form* (signs that are spelled out as signs, dots and slashes between card
   digits as blanks), so they do not tell the generators apart. They are learnt from
   all candidates: positive is what is, or overlaps, a base span of its kind, and
   what a loose generator found alone if its base form is an address, passes the
   digit sum or reads like a telephone number (``_strong``). Whether the base form passes its
   kind's check (digit sum, ranges, number of digits) is a feature, so a number that fails is no
   card because it looks like one. The features take few
   values, so the candidates aggregate to at most ``MAX_CELLS`` distinct rows
   (the product of the features' ranges, whatever the size of the input), and
   only those counts reach the driver.
4. A *calibrated threshold* per kind selects the redactions: the lowest score
   at or above which at least ``PRECISION`` of the candidates are positive, counted on
   the half of the texts (by hash) that the trees have not seen. Other
   candidates that reach it, touch no base span of their kind and lie in none of
   another kind are added to the spans.

Positions are code points, end exclusive. A match's position is the length of all
that the pattern's split puts before it, summed over the match rows (a window per
text and generator), so texts are read once and never sliced per match.

Patterns start a run only at its beginning or where the last match ended, and take
it possessively; both leave the leftmost matches as they are, and keep long runs of
one character class linear.

Cases: a null text counts as empty; a text without spans has counts of 0, the
digest of the empty string and empty ``spans``; repeated rows are scored and
returned each; an empty table gives an empty result and learns nothing; only the
id and text columns are read, so other columns of any name do not matter.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetdw.llm.common import materialise

KINDS = ("email", "ip", "card", "phone")

# The contract's patterns. \G: where the last match ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++\x20?(?:\(at\)|\[at\]|\{at\})\x20?[A-Za-z0-9-]++"
             r"(?:\x20?(?:\.|\(dot\)|\[dot\]|\{dot\})\x20?[A-Za-z0-9-]++)++",
    "card": r"(?<![0-9])[0-9]{3,6}(?:[\x20./-][0-9]{3,6}){2,4}(?![0-9])",
    "phone": r"(?<![0-9])(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-]{1,2}[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])",
}
#: What a text must hold for a generator to find anything.
NEEDS = {("email", True): "@", ("phone", True): "+", ("email", False): "at"}
GENERATORS = [(k, True, BASE[k]) for k in KINDS] + [(k, False, LOOSE[k]) for k in KINDS if k in LOOSE]

#: A base address that ends in letters, as real ones do.
ADDRESS = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$"
#: A trunk zero or three, three and four digits.
NUMBER = r"^0|^[0-9]{3}[^0-9]{1,2}[0-9]{3}[^0-9][0-9]{4}$"

BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
IP_OK = rf"^{BYTE}(?:\.{BYTE}){{3}}$"

CONTEXT = 24  # characters kept before a match
WORDS = {  # context words, by what they announce
    1: r"(?i)(?:mail|contact|adress|address|correo|courriel)\W{0,3}$",
    2: r"(?i)(?:card|visa|account|konto|karte|carte|tarjeta|payment)\W{0,3}(?:no|nr|number)?\W{0,3}$",
    3: r"(?i)(?:tel|phone|call|mobile|fax|telefon|cell)\W{0,3}$",
    4: r"(?i)(?:\bip|host|server|addr)\W{0,3}$",
}
#: Feature -> number of values it takes.
FEATURES = {"f_kind": 4, "f_digits": 9, "f_seps": 5, "f_marks": 16, "f_left": 4, "f_right": 4, "f_words": 5, "f_valid": 2}
MAX_CELLS = math.prod(FEATURES.values())
PRECISION = 0.5
ROUNDS, RATE, DEPTH, LEAST = 40, 0.4, 3, 1


def _matches(text: Column, gen: int) -> Column:
    """The generator's matches."""
    kind, base, pattern = GENERATORS[gen]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    need = NEEDS.get((kind, base))
    return F.when(text.contains(need), found) if need else found


def _rows(gen: int) -> Column:
    """An array with a row for each match; the split has one part more."""
    kind, base, _ = GENERATORS[gen]
    gap = F.col(f"gap{gen}")
    return F.when(F.size(f"m{gen}") > 0, F.transform(f"m{gen}", lambda m, i: F.struct(
        F.lit(gen).alias("gen"), F.lit(kind).alias("kind"), F.lit(base).alias("base"), i.alias("i"),
        F.length(F.get(gap, i)).alias("gap"), m.alias("m"),
        F.right(F.concat(F.coalesce(F.right(F.get(f"m{gen}", i - 1), F.lit(2)), F.lit("")), F.get(gap, i)),
                F.lit(CONTEXT)).alias("before"),
        F.left(F.concat(F.get(gap, i + 1), F.coalesce(F.left(F.get(f"m{gen}", i + 1), F.lit(2)), F.lit(""))),
               F.lit(2)).alias("after"))))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Digit sum of at most 19 digits, from the right."""
    back = F.split(F.reverse(digits), "")
    total = F.lit(0)
    for k in range(19):
        d = F.coalesce(F.get(back, F.lit(k)).cast("int"), F.lit(0))
        total = total + (d if k % 2 == 0 else d * 2 - F.when(d > 4, 9).otherwise(0))
    return total % 10 == 0


def _passes(kind: Column, m: Column) -> Column:
    digits = _digits(m)
    n = F.length(digits)
    return (F.when(kind == "email", F.lit(True))
            .when(kind == "ip", m.rlike(IP_OK))
            .when(kind == "card", n.between(12, 19) & F.when(n.between(12, 19), _luhn(digits)))
            .otherwise(n.between(9, 15)))


def _base_form(kind: Column, m: Column) -> Column:
    """What a loose match would be if it were written as a base match."""
    at = F.regexp_replace(m, r"\x20?[(\[{]at[)\]}]\x20?", "@")
    return (F.when(kind == "email", F.regexp_replace(at, r"\x20?[(\[{]dot[)\]}]\x20?|\x20\.\x20", "."))
            .when(kind == "card", F.translate(m, "./", "  ")).otherwise(m))


def _goes_on(left: bool) -> Column:
    """Digits go on beyond the match, behind a separator that it holds too."""
    side, rx = ("before", r"[0-9][\x20./-]$") if left else ("after", r"^[\x20./-][0-9]")
    sep = F.right(side, F.lit(1)) if left else F.left(side, F.lit(1))
    return F.col(side).rlike(rx) & F.col("m").contains(sep)


def _strong(kind: Column, m: Column, form: Column) -> Column:
    """A loose match with evidence of its own: an address, a digit sum, a number's shape or
    the words before it; numbers that are part of something longer have none."""
    apart = (~F.col("before").rlike(r"[\p{L}\p{N}_]$") & ~F.col("after").rlike(r"^(?!x[0-9])[\p{L}\p{N}_]")
             & (m.contains("(") | ~(_goes_on(True) | _goes_on(False))))
    number = m.contains("(") | m.rlike(NUMBER) | F.col("before").rlike(WORDS[3])
    return (F.when(kind == "email", form.rlike(ADDRESS))
            .when(kind == "card", apart & _passes(kind, form))
            .otherwise(apart & number & _passes(kind, form)))


def _char_class(c: Column) -> Column:
    return (F.when(c == "", 0).when(c.rlike(r"^\s"), 0).when(c.rlike(r"^\p{L}"), 1)
            .when(c.rlike("^[0-9]"), 2).otherwise(3))


def _features() -> dict[str, Column]:
    m, n = F.col("form"), F.length(_digits(F.col("form")))
    seps = F.length(F.regexp_replace(F.regexp_replace(m, r"^\+", ""), "[A-Za-z0-9]", ""))
    marks = F.lit(0)
    for bit, mark in ((1, " "), (2, "-"), (4, "."), (8, "(")):
        marks = marks + F.when(m.contains(mark), bit).otherwise(0)
    words = F.lit(0)
    for k, rx in WORDS.items():
        words = F.when(F.col("before").rlike(rx), k).otherwise(words)
    bounds = (6, 8, 9, 10, 11, 15, 16)
    digits = F.when(n == 0, 0)
    for k, top in enumerate(bounds):
        digits = digits.when(n <= top, k + 1)
    return {
        "f_kind": F.when(F.col("kind") == "email", 0).when(F.col("kind") == "ip", 1)
        .when(F.col("kind") == "card", 2).otherwise(3),
        "f_digits": digits.otherwise(len(bounds) + 1), "f_seps": F.least(seps, F.lit(4)), "f_marks": marks,
        "f_left": F.when(_goes_on(True), 2).otherwise(_char_class(F.right("before", F.lit(1)))),
        "f_right": F.when(_goes_on(False), 2).otherwise(_char_class(F.col("after"))),
        "f_words": words,
        "f_valid": F.coalesce(_passes(F.col("kind"), m), F.lit(False)).cast("int"),
    }


def candidates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per candidate (one with null ``kind`` for a text without): row, doc_id,
    text_hash, kind, base, start, end, features, positive, free (may be added). Written to
    the shared folder."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    every_gen = range(len(GENERATORS))
    found = rows.select("doc_id", "text", *[_matches(F.col("text"), g).alias(f"m{g}") for g in every_gen])
    found = found.select("*", *[F.when(F.size(f"m{g}") > 0, F.split("text", GENERATORS[g][2], -1)).alias(f"gap{g}")
                                for g in every_gen])
    every = found.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                         F.xxhash64("text").alias("text_hash"),
                         F.flatten(F.array_compact(F.array(*map(_rows, every_gen)))).alias("found"))
    every = materialise(every, "pii-matches")
    one = every.select("row", "doc_id", "text_hash", F.inline_outer("found"))
    here = W.partitionBy("row", "gen").orderBy("i").rowsBetween(W.unboundedPreceding, W.currentRow)
    size = F.length("m")
    placed = (one.repartition("row")  # serves all three windows
              .withColumn("end", F.sum(F.col("gap") + size).over(here))
              .withColumn("start", F.col("end") - size)
              .withColumn("form", F.when(F.col("base"), F.col("m")).otherwise(_base_form(F.col("kind"), F.col("m"))))
              .withColumn("strong", ~F.col("base") & _strong(F.col("kind"), F.col("m"), F.col("form")))
              .withColumn("base", F.col("base") & _passes(F.col("kind"), F.col("m"))))
    order = ("start", F.col("base").desc(), "end", "gen")
    kind, any_kind = W.partitionBy("row", "kind").orderBy(*order), W.partitionBy("row").orderBy(*order)
    past, rest = (kind.rowsBetween(W.unboundedPreceding, W.currentRow),
                  kind.rowsBetween(W.currentRow, W.unboundedFollowing))
    base_end = F.when(F.col("base"), F.col("end"))
    touches = ((F.max(base_end).over(past) > F.col("start"))
               | (F.min(F.when(F.col("base"), F.col("start"))).over(rest) < F.col("end")))
    inside = F.max(base_end).over(any_kind.rowsBetween(W.unboundedPreceding, W.currentRow)) >= F.col("end")
    twin = (F.lag("start").over(kind) == F.col("start")) & (F.lag("end").over(kind) == F.col("end"))
    flags = placed.select("*", *[F.coalesce(c, F.lit(False)).alias(n) for n, c in
                                 (("touches", touches), ("inside", inside), ("twin", twin))])
    out = flags.select("row", "doc_id", "text_hash", "kind", F.coalesce("base", F.lit(False)).alias("base"),
                       "start", "end", *[c.alias(n) for n, c in _features().items()],
                       (F.col("base") | F.col("touches") | (F.col("strong") & ~F.col("inside"))).alias("positive"),
                       (~F.col("touches") & ~F.col("inside") & ~F.col("twin")).alias("free"))
    return materialise(out, "pii-candidates")


def _leaf(cells: list) -> float:
    up = sum(c["g"] for c in cells)
    down = sum(c["h"] for c in cells)
    return RATE * up / (down + 1.0)


def _grow(cells: list, depth: int):
    """A regression tree on gradient sums: (feature, cut, left, right) or a leaf value."""
    total_g, total_h = sum(c["g"] for c in cells), sum(c["h"] for c in cells)
    best = (1e-9, None, None)
    for f in FEATURES if depth else ():
        by = defaultdict(lambda: [0.0, 0.0, 0])
        for c in cells:
            s = by[c["x"][f]]
            s[0] += c["g"]
            s[1] += c["h"]
            s[2] += c["n"]
        g = h = 0.0
        n, all_n = 0, sum(c["n"] for c in cells)
        for value in sorted(by)[:-1]:
            g, h, n = g + by[value][0], h + by[value][1], n + by[value][2]
            if min(n, all_n - n) < LEAST:
                continue
            gain = g * g / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1) - total_g ** 2 / (total_h + 1)
            if gain > best[0]:
                best = (gain, f, value)
    if best[1] is None:
        return _leaf(cells)
    _, f, cut = best
    return (f, cut, _grow([c for c in cells if c["x"][f] <= cut], depth - 1),
            _grow([c for c in cells if c["x"][f] > cut], depth - 1))


def _value(tree, x: dict) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree


def learn(cells: list[dict]) -> tuple[list, dict[int, float]]:
    """Boosted trees on counted cells (x: features, n: candidates, p: positives), and the
    threshold of each kind (log-odds), calibrated on other candidates (held: their number, held_p:
    positives). A kind without any of these has no threshold, so nothing of it is added."""
    for c in cells:
        c["s"] = 0.0
    trees = []
    for _ in range(ROUNDS):
        for c in cells:
            q = 1 / (1 + math.exp(-c["s"]))
            c["g"], c["h"] = c["p"] - c["n"] * q, c["n"] * q * (1 - q)
        tree = _grow(cells, DEPTH)
        trees.append(tree)
        for c in cells:
            c["s"] += _value(tree, c["x"])
    cuts = {}
    for kind in {c["x"]["f_kind"] for c in cells}:
        n = p = 0
        by_score = defaultdict(lambda: [0, 0])
        for c in cells:
            if c["x"]["f_kind"] == kind:
                by_score[round(c["s"], 9)][0] += c["held"]
                by_score[round(c["s"], 9)][1] += c["held_p"]
        for s in sorted(by_score, reverse=True):
            n, p = n + by_score[s][0], p + by_score[s][1]
            if by_score[s][0] and p >= PRECISION * n and by_score[s][1] >= PRECISION * by_score[s][0]:
                cuts[kind] = s - 1e-6
    return trees, cuts


def _column(tree) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    return F.when(F.col(tree[0]) <= tree[1], _column(tree[2])).otherwise(_column(tree[3]))


def scored(found: DataFrame) -> DataFrame:
    """``found`` of :func:`candidates` with ``score`` (0 to 1) and ``chosen``."""
    held, yes = F.pmod(F.xxhash64("text_hash"), F.lit(2)) == 1, F.col("positive")
    counts = {"n": ~held, "p": ~held & yes, "held": held, "held_p": held & yes}
    rows = (found.where(F.col("kind").isNotNull()).groupBy(*FEATURES)
            .agg(*[F.count_if(c).alias(name) for name, c in counts.items()]).collect())
    cells = sorted(({"x": {f: r[f] for f in FEATURES}, **{name: r[name] for name in counts}} for r in rows),
                   key=lambda c: sorted(c["x"].items()))
    trees, cuts = learn(cells) if cells else ([], {})
    odds = F.lit(0.0)
    for t in trees:
        odds = odds + _column(t)
    least = F.lit(math.inf)
    for kind, cut in sorted(cuts.items()):
        least = F.when(F.col("f_kind") == kind, cut).otherwise(least)
    odds_df = found.withColumn("odds", odds)
    return (odds_df.withColumn("score", 1 / (1 + F.exp(-F.col("odds"))))
            .withColumn("chosen", F.col("kind").isNotNull() & (
                F.col("base") | (F.col("free") & (F.col("odds") >= least)))))


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans,
    n_added, text_hash and hits (array of start, rank, end, kind, base, score)."""
    hits = scored(candidates(df, id_col, text_col))
    rank = F.lit(0)
    for k, name in enumerate(KINDS):
        rank = F.when(F.col("kind") == name, k).otherwise(rank)
    hit = F.when(F.col("chosen"), F.struct("start", rank.alias("rank"), "end", "kind", "base", "score"))
    base = F.col("base") & F.col("chosen")
    per = hits.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("text_hash").alias("text_hash"),
        *[F.count_if(base & (F.col("kind") == k)).alias(f"n_{k}") for k in KINDS],
        F.sort_array(F.collect_list(hit)).alias("hits"))
    said = lambda hs: F.array_join(F.transform(hs, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    return per.select(
        "doc_id", *[f"n_{k}" for k in KINDS],
        F.sha2(said(F.filter("hits", lambda x: x["base"])), 256).alias("base_sha256"), said(F.col("hits")).alias("spans"),
        (F.size("hits") - sum((F.col(f"n_{k}") for k in KINDS), F.lit(0))).alias("n_added"), "text_hash", "hits")


def redact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with every chosen span of its text replaced by ``[KIND]``; overlapping spans
    become one, named after the first. Rows and other columns stay as they are."""
    spans = (find(df, id_col, text_col).where(F.size("hits") > 0)
             .select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("hits").alias("__hits"))
             .groupBy("__id", "__hash").agg(F.first("__hits").alias("__hits")))
    start = F.struct(F.lit(0).cast("long").alias("to"), F.array().cast("array<struct<a:long,b:long,kind:string>>").alias("runs"))

    def merge(acc, x):
        last = F.element_at(acc["runs"], -1)
        run = F.struct(x["start"].cast("long").alias("a"), x["end"].cast("long").alias("b"), x["kind"].alias("kind"))
        joined = F.struct(last["a"].alias("a"), F.greatest(last["b"], run["b"]).alias("b"), last["kind"].alias("kind"))
        return F.when((F.size(acc["runs"]) > 0) & (x["start"] < acc["to"]), F.struct(
            F.greatest(acc["to"], run["b"]).alias("to"),
            F.concat(F.slice(acc["runs"], F.lit(1), F.size(acc["runs"]) - 1), F.array(joined)).alias("runs"))).otherwise(
            F.struct(run["b"].alias("to"), F.concat(acc["runs"], F.array(run)).alias("runs")))

    runs = F.aggregate("__hits", start, merge, lambda acc: acc["runs"])
    text = F.col(f"__d.{text_col}").cast("string")
    joined = (df.select(F.struct(*[F.col(c) for c in df.columns]).alias("__d"),
                        F.col(id_col).cast("long").alias("__i"),
                        F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("__h"))
              .join(spans, F.col("__i").eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__hash")), "left"))
    joined = joined.withColumn("__runs", F.when(F.col("__hits").isNotNull(), runs))
    kept = F.concat(
        F.array_join(F.transform("__runs", lambda r, i: F.concat(
            F.substr(text, F.when(i == 0, 0).otherwise(F.get("__runs", i - 1)["b"]).cast("int") + 1,
                     (r["a"] - F.when(i == 0, 0).otherwise(F.get("__runs", i - 1)["b"])).cast("int")),
            F.lit("["), F.upper(r["kind"]), F.lit("]"))), ""),
        F.substr(text, F.element_at("__runs", -1)["b"].cast("int") + 1))
    new = F.when(F.col("__runs").isNull(), text).otherwise(kept)
    return joined.select(*[new.alias(c) if c == text_col else F.col(f"__d.{c}").alias(c) for c in df.columns])
