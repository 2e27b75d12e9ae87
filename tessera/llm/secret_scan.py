"""Secret scans (native): patterns, and sliding-window entropy.

Pattern spans are the leftmost non-overlapping matches of each kind. Entropy
spans are candidate strings (runs of 20 or more token characters) in which
some window of ``WIDTH`` characters has a Shannon entropy of at least the bound of
the candidate's character class. The entropy is kept by incremental counts: a
table of counts, one place per symbol, travels with the window; per step the
count of the entering symbol goes up and that of the leaving one down, and the sum
of c*log2(c) changes by table look-ups at those two counts (in integers, so no
error adds up). Candidates on the allow-list, or over a pattern span, are suppressed.

All positions are code points, end exclusive. The positions of all matches of
a text follow from the lengths of the pieces between them by two-level prefix
sums, so a text of any length and number of matches is one row of work. There
is no shuffle and no Python.

Defined results: null text is empty; repeated rows give repeated results; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 20
_SCALE = 1 << 16
_CHUNK = 256

# The pattern kinds in listed order, and what a match must meet.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # the runs of [0-9a-f]+ that have 24 characters or more
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
SYMBOLS = string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/_=-"

# Character classes of candidates: (name, pattern, least bits per character).
# The first that fits holds; a candidate that fits none is not a secret.
CLASSES = (
    ("hex", r"^(?=[^0-9]*[0-9])(?=[^A-Fa-f]*[A-Fa-f])[0-9A-Fa-f]+$", 3.0),
    ("mixed", r"^(?=[^0-9]*[0-9])(?=[^a-z]*[a-z])(?=[^A-Z]*[A-Z])[A-Za-z0-9+/_=-]+$", 3.5),
    ("letters_digits", r"^(?=[^0-9]*[0-9][^0-9]*[0-9])(?=[^A-Za-z]*[A-Za-z])[A-Za-z0-9+/_=-]+$", 3.7),
)
# Allow-list: identifiers and prose that look random but are no secrets.
ALLOWED = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",  # UUID
    r"(?i)(example|placeholder|changeme|your_|dummy|sample|xxxx)",
    r"^(.{1,4})\1+.{0,4}$",  # one short piece repeated
)
# Slugs, paths, numbers and dates: no letter stands next to a digit.
NEXT_TO = r"[A-Za-z][0-9]|[0-9][A-Za-z]"


def _running(chunk: Column, start: Column) -> Column:
    """Prefix sums of one chunk: start, start + x1, start + x1 + x2, ..."""
    return F.aggregate(chunk, F.array(start), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))


def _with_starts(df: DataFrame, kinds: list[str]) -> DataFrame:
    """Adds ``<kind>_starts``, the position of every hit. Each step is a column
    of its own, so that nothing is computed again per element."""

    def each(name: str, make) -> dict[str, Column]:
        return {f"{k}_{name}": make(k) for k in kinds}

    def lengths(k: str) -> Column:  # gap, hit, gap, hit, ..., gap
        pair = lambda g, h: F.array(F.char_length(g), F.coalesce(F.char_length(h), F.lit(0)))
        return F.flatten(F.zip_with(f"{k}_gaps", f"{k}_hits", pair))

    def chunks(k: str) -> Column:
        n = F.ceil(F.size(f"{k}_lengths") / _CHUNK).cast("int")
        cut = F.transform(F.sequence(F.lit(0), n - 1), lambda c: F.slice(f"{k}_lengths", c * _CHUNK + 1, F.lit(_CHUNK)))
        return F.when(n > 0, cut).otherwise(F.array().cast("array<array<int>>"))

    def offsets(k: str) -> Column:
        sums = F.transform(f"{k}_chunks", lambda c: F.aggregate(c, F.lit(0), lambda acc, x: acc + x))
        return F.slice(_running(sums, F.lit(0)), F.lit(1), F.size(f"{k}_chunks"))

    def starts(k: str) -> Column:
        every = F.flatten(
            F.zip_with(f"{k}_chunks", f"{k}_offsets", lambda c, o: F.slice(_running(c, o), F.lit(1), F.size(c)))
        )
        return F.slice(F.filter(every, lambda x, i: i % 2 == 1), F.lit(1), F.size(f"{k}_hits"))

    for name, make in (("lengths", lengths), ("chunks", chunks), ("offsets", offsets), ("starts", starts)):
        df = df.withColumns(each(name, make))
    return df


def _entropy_sum(count: Column) -> Column:
    """count * log2(count), scaled to an integer."""
    table = [0] + [round(c * math.log2(c) * _SCALE) for c in range(1, WIDTH + 2)]
    return F.element_at(F.array(*[F.lit(x) for x in table]), count + 1)


def _least_sum(s: Column) -> Column:
    """Smallest sum of c*log2(c) of any full window of ``s`` (of SYMBOLS only).

    The counts are a string with one character per symbol, "A" for 0, "B" for 1,
    and so on, read and set at the symbol's place.
    """

    def place(ch: Column) -> Column:
        return F.position(ch, F.lit(SYMBOLS))

    def count(counts: Column, ch: Column) -> Column:
        return F.ascii(F.substr(counts, place(ch), F.lit(1))) - ord("A")

    def put(counts: Column, ch: Column, n: Column) -> Column:
        return F.overlay(counts, F.char(n + ord("A")), place(ch), F.lit(1))

    def enter(acc: Column, ch: Column) -> Column:
        seen = count(acc["counts"], ch)
        return F.struct(
            F.concat(acc["window"], ch).alias("window"),
            put(acc["counts"], ch, seen + 1).alias("counts"),
            (acc["total"] + _entropy_sum(seen + 1) - _entropy_sum(seen)).alias("total"),
            acc["least"].alias("least"),
        )

    def leave(acc: Column) -> Column:
        ch = F.substr(acc["window"], F.lit(1), F.lit(1))
        seen = count(acc["counts"], ch)
        return F.struct(
            F.substr(acc["window"], F.lit(2), F.lit(WIDTH)).alias("window"),
            put(acc["counts"], ch, seen - 1).alias("counts"),
            (acc["total"] + _entropy_sum(seen - 1) - _entropy_sum(seen)).alias("total"),
            acc["least"].alias("least"),
        )

    def step(acc: Column, ch: Column) -> Column:
        # An empty string stands for "a symbol leaves", if the window is full.
        full = F.length(acc["window"]) == WIDTH
        return F.when(ch != "", enter(acc, ch)).when(full, leave(acc)).otherwise(acc)

    def measured(acc: Column, ch: Column) -> Column:
        done = (ch == "") & (F.length(acc["window"]) == WIDTH)
        return F.struct(
            acc["window"].alias("window"), acc["counts"].alias("counts"), acc["total"].alias("total"),
            F.when(done, F.least(acc["least"], acc["total"])).otherwise(acc["least"]).alias("least"),
        )

    start = F.struct(
        F.lit("").alias("window"), F.lit("A" * len(SYMBOLS)).alias("counts"), F.lit(0).alias("total"), F.lit(1 << 30).alias("least")
    )
    # symbol, "", symbol, "", ...: each symbol enters, then the oldest one leaves.
    moves = F.flatten(F.transform(F.split(s, ""), lambda ch: F.array(ch, F.lit(""))))
    return F.aggregate(moves, start, lambda acc, ch: step(measured(acc, ch), ch), lambda acc: acc["least"])


def _random_looking(s: Column) -> Column:
    bound = F
    for _, pattern, bits in CLASSES:
        bound = bound.when(s.rlike(pattern), F.lit(int(WIDTH * (math.log2(WIDTH) - bits) * _SCALE)))
    allowed = ~s.rlike(NEXT_TO)
    for pattern in ALLOWED:
        allowed = allowed | s.rlike(pattern)
    return F.when(~allowed, _least_sum(s) <= bound.otherwise(F.lit(-1))).otherwise(False)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: id and ``found``, an array of (start, kind_order, end, kind)
    sorted by start; kinds are assign, access, hex and entropy."""
    kinds = (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("entropy", CANDIDATE))
    body = F.coalesce(F.col(text), F.lit(""))
    # One regular-expression pass decides; only texts with a match are cut up.
    base = docs.select(F.col(doc_id).alias("doc_id"), body.alias("body"))
    has = {k: (F.col("body").contains("AKIA") if k == "access" else F.col("body").rlike(p)) for k, p in kinds}
    none = F.array().cast("array<string>")
    cut = base.select(
        "doc_id",
        *[F.when(has[k], F.split("body", p, -1)).otherwise(none).alias(f"{k}_gaps") for k, p in kinds],
        *[F.when(has[k], F.regexp_extract_all("body", F.lit(p), F.lit(0))).otherwise(none).alias(f"{k}_hits") for k, p in kinds],
    )

    located = _with_starts(cut, [k for k, _ in kinds])
    checks = {
        "assign": lambda h: F.char_length(F.regexp_extract(h, ASSIGN, 2)) >= 6,
        "access": lambda h: F.char_length(h) >= 20,
        "hex": lambda h: F.lit(True),
    }

    def span(order: int, kind: str, x: Column) -> Column:
        return F.struct(
            x["start"].alias("start"),
            F.lit(order).alias("kind_order"),
            (x["start"] + F.char_length(x["hit"])).alias("end"),
            F.lit(kind).alias("kind"),
        )

    def placed(kind: str) -> Column:
        return F.zip_with(f"{kind}_starts", f"{kind}_hits", lambda s, h: F.struct(s.alias("start"), h.alias("hit")))

    def pattern_spans(order: int, kind: str) -> Column:
        kept = F.filter(placed(kind), lambda x: checks[kind](x["hit"]))
        return F.transform(kept, lambda x: span(order, kind, x))

    base = [pattern_spans(i, k) for i, (k, _) in enumerate(kinds[:3])]
    done = located.select("doc_id", F.concat(*base).alias("base"), placed("entropy").alias("maybe"))

    def new(m: Column) -> Column:
        end = m["start"] + F.char_length(m["hit"])
        return ~F.exists("base", lambda b: (b["start"] < end) & (m["start"] < b["end"]))

    more = F.transform(
        F.filter("maybe", lambda m: F.when(new(m), _random_looking(m["hit"])).otherwise(False)), lambda m: span(3, "entropy", m)
    )
    return done.select("doc_id", F.array_sort(F.concat("base", more)).alias("found"))


def _written(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def digest(docs: DataFrame) -> DataFrame:
    def n(kind: str) -> Column:
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("found", lambda x: x["kind"] != "entropy")
    return scan(docs).select(
        "doc_id", n("assign"), n("access"), n("hex"), F.sha2(_written(base), 256).alias("base_sha256"),
        _written(F.col("found")).alias("spans"), n("entropy"),
    )
