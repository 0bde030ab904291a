"""Secret scans: fixed patterns, and windows of high entropy in candidate strings.

Base spans (``assign``, ``access``, ``hex``) are the leftmost non-overlapping matches of fixed patterns that are long
enough. The method adds ``entropy`` spans: candidate strings of a character class in which some window of
``WINDOW`` signs has at least the class's Shannon entropy. The window slides sign by sign; counts of the signs in
it, and with them the entropy, are kept up to date by what enters and leaves. Strings on the allow-list and those
that overlap a base span are left out. Positions count code points, the end is exclusive.

A NULL text has no span, like an empty one. Texts are searched whole. Repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Callable
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the base kinds. The lengths the last two must have are part of the pattern: both take a
# run of signs to its end, so a run is either long enough or has no match.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_VALUE = 6
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
# Class, the strings that belong to it, and the entropy in bits that a window must reach. The first that fits counts. Those of
# lower, upper and base62 are what about 95 % or more of random strings of WINDOW signs reach (upper: of base32 ones). Names and
# paths have joiners, so the last class asks for more.
CLASSES = (
    ("hex", r"^[0-9A-Fa-f]+$", 3.0),
    ("lower", r"^[a-z0-9]+$", 3.5),
    ("upper", r"^[A-Z0-9]+$", 3.45),
    ("base62", r"^[A-Za-z0-9]+$", 3.68),
    ("base64", r"^[A-Za-z0-9+/_=-]+$", 3.9),
)
# Strings that are no secrets: digits only, letters and joiners only, names of capitalised words and digits, placeholders.
ALLOWED = (
    r"^[0-9]+$",
    r"^[A-Za-z/_=-]+$",
    r"^[a-z]*[0-9]*(?:[A-Z]+[0-9]+)?(?:[A-Z]+[a-z]{2,}[0-9]*)+[A-Z]*[0-9]*$",
    r"(?i:example|sample|dummy|placeholder|changeme)",
)
COVER = "\u0001"  # no candidate has this sign
C_LOG_C = [0.0] + [c * log2(c) for c in range(1, WINDOW + 1)]


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with the value computed once and not at each place it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _matches(text: Column, pattern: str) -> Column:
    """What lies between two matches and the matches themselves, in turn, make up the text: an array of (between, match),
    the last match NULL."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.zip_with(found, F.split(text, pattern, -1), lambda m, b: F.struct(b.alias("between"), m.alias("match")))


def spans(text: Column, pattern: str, kind: str) -> Column:
    """All matches as (start, end, kind, text). Positions are running sums of lengths.

    A fold that appends copies what it has, so sums run inside blocks and then over the blocks, about as many as a block
    has matches.
    """
    rows = F.filter(_matches(text, pattern), lambda x: x["match"].isNotNull())
    size = lambda r: F.ceil(F.sqrt(F.size(r))).cast("int")
    blocks = lambda r: F.transform(F.sequence(F.lit(0), size(r) - 1), lambda i: F.slice(r, i * size(r) + 1, size(r)))
    nothing = F.array().cast("array<struct<start:bigint,end:bigint,kind:string,text:string>>")
    start = F.struct(F.lit(0).cast("bigint").alias("at"), nothing.alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["between"])
        end = begin + F.length(x["match"])
        span = F.struct(begin.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), x["match"].alias("text"))
        return F.struct(end.alias("at"), F.array_append(acc["spans"], span).alias("spans"))

    def place(folded: Column) -> Column:
        ends = F.array(F.lit(0).cast("bigint"))
        offsets = F.aggregate(folded, ends, lambda acc, f: F.array_append(acc, F.element_at(acc, -1) + f["at"]))
        moved = lambda f, by: F.transform(
            f["spans"], lambda s: F.struct((s["start"] + by).alias("start"), (s["end"] + by).alias("end"), s["kind"].alias("kind"), s["text"].alias("text"))
        )
        return F.flatten(_bound(offsets, lambda o: F.transform(folded, lambda f, i: moved(f, F.get(o, i)))))

    fold = lambda r: F.transform(blocks(r), lambda block: F.aggregate(block, start, step))
    return _bound(rows, lambda r: F.when(F.size(r) > 0, _bound(fold(r), place)).otherwise(nothing))


def covered(text: Column, pattern: str, wanted: Callable[[Column], Column] = lambda _: F.lit(True)) -> Column:
    """``text`` with the signs of the ``wanted`` matches replaced by as many ``COVER``."""
    cover = lambda m: F.when(wanted(m), F.repeat(F.lit(COVER), F.length(m))).otherwise(m)
    pieces = F.transform(_matches(text, pattern), lambda x: F.concat(x["between"], F.coalesce(cover(x["match"]), F.lit(""))))
    return F.array_join(pieces, "")


def window_entropy(text: Column, window: int = WINDOW) -> Column:
    """The highest entropy of ``window`` signs in a row of a string over ``ALPHABET``; 0 for a shorter one."""
    codes = F.transform(F.split(text, "(?!^|$)"), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    f = lambda c: F.get(F.lit(C_LOG_C), c)

    def slide(acc: Column, code: Column) -> Column:
        """``acc`` holds the codes so far, their counts in the window, the sum of c * log2(c) and the best entropy."""
        counts, at = acc["counts"], acc["at"]
        out = F.when(at >= window, F.get(acc["codes"], at - window))
        come = f(F.get(counts, code) + 1) - f(F.get(counts, code))
        gone = F.when(out.isNull(), F.lit(0.0)).otherwise(f(F.get(counts, out) - 1) - f(F.get(counts, out)))
        total = F.when(out == code, acc["sum"]).otherwise(acc["sum"] + come + gone)
        updated = F.transform(counts, lambda c, i: c + (i == code).cast("int") - F.coalesce((i == out).cast("int"), F.lit(0)))
        bits = F.lit(log2(window)) - total / F.lit(float(window))
        best = F.when(at >= window - 1, F.greatest(acc["best"], bits)).otherwise(acc["best"])
        return F.struct(
            acc["codes"].alias("codes"), (at + 1).alias("at"), updated.alias("counts"), total.alias("sum"), best.alias("best")
        )

    initial = F.struct(
        codes.alias("codes"),
        F.lit(0).alias("at"),
        F.lit([0] * len(ALPHABET)).alias("counts"),
        F.lit(0.0).alias("sum"),
        F.lit(0.0).alias("best"),
    )
    return F.aggregate(codes, initial, slide, lambda acc: acc["best"])


def is_random(text: Column) -> Column:
    """Whether a candidate string is off the allow-list and has a window of its class's entropy."""
    needed = F.lit(None).cast("double")
    for _, pattern, bits in reversed(CLASSES):
        needed = F.when(text.rlike(pattern), F.lit(bits)).otherwise(needed)
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | text.rlike(pattern)
    return ~allowed & (F.round(window_entropy(text), 6) >= needed)


def by_start(found: Column) -> Column:
    """Spans by start and then in the order of ``KINDS``."""
    rank = lambda s: F.array_position(F.lit(list(KINDS)), s["kind"])
    keyed = F.transform(found, lambda s: F.struct(s["start"].alias("start"), rank(s).alias("rank"), s.alias("span")))
    return F.transform(F.array_sort(keyed), lambda x: x["span"])


def find_secrets(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, base, added) for every row: arrays of (start, end, kind, text) by start and kind.

    Candidates are looked for in the text with its base spans covered: a candidate that overlaps or touches one holds a
    cover and is left out, without a comparison of spans.
    """
    assigns = lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)) >= ASSIGN_VALUE
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = rows.withColumns(
        {
            "_assign": F.filter(spans(F.col("_text"), ASSIGN, "assign"), lambda s: assigns(s["text"])),
            "_access": spans(F.col("_text"), ACCESS, "access"),
            "_hex": spans(F.col("_text"), HEX, "hex"),
            "_covered": covered(F.translate("_text", COVER, " "), ASSIGN, assigns),
        }
    ).drop("_text")
    rows = rows.withColumn("_covered", covered(F.col("_covered"), ACCESS)).withColumn("_covered", covered(F.col("_covered"), HEX))
    candidates = spans(F.col("_covered"), CANDIDATE.replace("[", f"[{COVER}"), "entropy")
    added = F.filter(F.filter(candidates, lambda s: ~F.contains(s["text"], F.lit(COVER))), lambda s: is_random(s["text"]))
    return rows.select(key, by_start(F.concat("_assign", "_access", "_hex")).alias("base"), added.alias("added"))


def document_secrets(docs: DataFrame) -> DataFrame:
    """Counts and digests of the secrets of every row of ``documents``."""
    line = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    joined = lambda a: F.array_join(F.transform(a, line), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return find_secrets(docs).select(
        "doc_id",
        *(count(k) for k in KINDS[:3]),
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(by_start(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_entropy"),
    )
