"""Secret scans: rule matches and sliding-window entropy, in DataFrame functions only.

Matches are found with their places by cutting a text twice with the same pattern: the gaps and
the matches take turns, and the running sum of their lengths gives every start.

Candidate strings are the runs of token characters that mix letters and digits. A window slides
over each; the counts of its characters change by one entering and one leaving character, and
with them the sum of ``c * log2(c)``, kept as whole numbers so that every engine agrees. The
entropy of the window is ``log2(w) - sum / w``. Each class of characters has its own limit.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the base kinds, in the order of the contract, and the least length
# of the match (or of its second group).
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
# ASCII code of the first token character, and the codes from there to the last.
FIRST, ALPHABET = 43, 80
SCALE = 10_000
# Least entropy in bits of a window by character class: only hexadecimal digits, letters and digits
# of one case, anything else.
LIMITS = {"hex": 3.0, "single": 3.4, "mixed": 3.7}
# Candidates that are no secrets: dates and long numbers, UUIDs; and those made of words, capitals or
# numbers with at most four digits in a row, joined by signs.
ALLOW = (r"^[0-9_+/=-]*$", r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$")
ALLOWED_PART = r"^([A-Za-z]?[a-z]*[0-9]{0,4}|[A-Z]+)$"
SIGNS = "[_/=+-]"
# Weight of a character that stands c times in a window.
COUNT_WEIGHTS = [round(SCALE * c * math.log2(c)) if c else 0 for c in range(WINDOW + 1)]


def places(text: Column, pattern: str) -> Column:
    """array<struct<match, start>>: leftmost non-overlapping matches with their code-point places."""
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    lengths = F.transform(F.arrays_zip(gaps.alias("g"), found.alias("m")), lambda x: F.struct(F.length(x.g).alias("g"), F.coalesce(F.length(x.m), F.lit(0)).alias("m")))
    empty = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(0).alias("at"))
    starts = F.aggregate(
        lengths, empty, lambda s, x: F.struct(F.concat(s.starts, F.array(s.at + x.g)).alias("starts"), (s.at + x.g + x.m).alias("at")), lambda s: s.starts
    )
    pairs = F.arrays_zip(found.alias("match"), F.slice(starts, F.lit(1), F.size(found)).alias("start"))
    none = F.array().cast("array<struct<match:string,start:int>>")
    return F.when(text.rlike(pattern), pairs).otherwise(none)


def _spans(found: Column, kind: str, rank: int) -> Column:
    def span(x: Column) -> Column:
        return F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), (x["start"] + F.length(x["match"])).alias("end"))

    return F.transform(found, span)


def window_weight(token: Column, window: int = WINDOW) -> Column:
    """Least sum of count weights over the windows of a token (the highest entropy)."""
    weights = F.array(*[F.lit(w) for w in COUNT_WEIGHTS])
    start = F.struct(
        F.transform(F.split(token, ""), lambda c: F.ascii(c) - FIRST).alias("codes"),
        F.array_repeat(F.lit(0), ALPHABET).alias("counts"),
        F.lit(0).alias("sum"),
        F.lit(0).alias("n"),
        F.lit(1 << 30).alias("best"),
    )

    def step(s: Column, c: Column) -> Column:
        """One character enters; once the window is full, the one that falls out goes first."""
        code = F.ascii(c) - FIRST
        gone = F.when(s["n"] >= window, F.get(s["codes"], s["n"] - window)).otherwise(-1)
        out, into = F.get(s["counts"], gone), F.get(s["counts"], code)
        change = F.when(gone >= 0, F.get(weights, out - 1) - F.get(weights, out)).otherwise(0) + F.get(weights, into + 1) - F.get(weights, into)
        counts = F.transform(s["counts"], lambda x, i: x + (i == code).cast("int") - (i == gone).cast("int"))
        total = F.when(gone == code, s["sum"]).otherwise(s["sum"] + change)
        n = s["n"] + 1
        return F.struct(
            s["codes"].alias("codes"),
            F.when(gone == code, s["counts"]).otherwise(counts).alias("counts"),
            total.alias("sum"),
            n.alias("n"),
            F.when(n >= window, F.least(s["best"], total)).otherwise(s["best"]).alias("best"),
        )

    return F.aggregate(F.split(token, ""), start, step, lambda s: s["best"])


def limit_of(bits: float, window: int = WINDOW) -> int:
    """Largest sum of count weights whose window still has so many bits of entropy."""
    return math.floor(SCALE * window * (math.log2(window) - bits))


def suspicious(token: Column, limits: dict[str, float] = LIMITS, allow: Sequence[str] = ALLOW) -> Column:
    """Whether a candidate's best window passes the entropy limit of its class."""
    limit = (
        F.when(token.rlike("^[0-9a-f]+$") | token.rlike("^[0-9A-F]+$"), limit_of(limits["hex"]))
        .when(~(token.rlike("[a-z]") & token.rlike("[A-Z]")), limit_of(limits["single"]))
        .otherwise(limit_of(limits["mixed"]))
    )
    # Part by part: a pattern that repeats a group would recurse as deep as the token is long.
    listed = F.forall(F.split(token, SIGNS), lambda part: part.rlike(ALLOWED_PART))
    for pattern in allow:
        listed = listed | token.rlike(pattern)
    mixes = token.rlike("[0-9]") & token.rlike("[A-Za-z]")
    return F.when(mixes & ~listed, window_weight(token) <= limit).otherwise(False)


def _without(text: Column, spans: Column) -> Column:
    """The text with every character of the spans (ordered by start) replaced by a blank."""
    start = F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).alias("at"))

    def step(s: Column, span: Column) -> Column:
        between = F.substring(text, s["at"] + 1, F.greatest(F.lit(0), span["start"] - s["at"]))
        blank = F.repeat(F.lit(" "), F.greatest(F.lit(0), span["end"] - F.greatest(s["at"], span["start"])))
        return F.struct(F.concat(s["parts"], F.array(between, blank)).alias("parts"), F.greatest(s["at"], span["end"]).alias("at"))

    rest = F.aggregate(spans, start, step, lambda s: F.concat(F.array_join(s["parts"], ""), F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, rest).otherwise(text)


def scan(docs: DataFrame, text: str = "text", limits: dict[str, float] = LIMITS, allow: Sequence[str] = ALLOW) -> DataFrame:
    """``docs`` with ``secrets``: array<struct<start, rank, kind, end>>, ordered by start, then kind.

    Kinds are assign, access and hex by pattern, entropy by the sliding window. Base spans are cut
    out of the text before candidates are looked for, so what stands beside them is judged. Null and empty texts have no spans; repeated rows
    are scanned each for itself, other columns are kept as they are. No shuffle, no Python.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    assign = F.filter(places(body, ASSIGN), lambda x: F.length(F.regexp_extract(x["match"], ASSIGN, 2)) >= MIN_ASSIGN)
    access = F.filter(places(body, ACCESS), lambda x: F.length(x["match"]) >= MIN_ACCESS)
    # Shorter runs are dropped by the contract, and no run that is long enough can start inside one.
    hexes = places(body, HEX[:-1] + "{%d,}" % MIN_HEX)
    base = F.array_sort(F.concat(_spans(assign, "assign", 0), _spans(access, "access", 1), _spans(hexes, "hex", 2)))
    tokens = F.filter(places(F.col("_rest"), CANDIDATE), lambda x: suspicious(x["match"], limits, allow))
    return (
        docs.withColumn("_base", base)
        .withColumn("_rest", _without(body, F.col("_base")))
        .withColumn("secrets", F.array_sort(F.concat("_base", _spans(tokens, "entropy", 3))))
        .drop("_base", "_rest")
    )


def joined(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["rank"] < 3)


def of_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def redacted(text: Column, spans: Column, mask: str = "[secret]") -> Column:
    """The text with every span, or run of overlapping spans, replaced by ``mask``."""
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))

    def step(s: Column, span: Column) -> Column:
        between = F.substring(text, s["at"] + 1, span["start"] - s["at"])
        grown = F.when(span["start"] >= s["at"], F.concat(s["done"], between, F.lit(mask))).otherwise(s["done"])
        return F.struct(grown.alias("done"), F.greatest(s["at"], span["end"]).alias("at"))

    return F.aggregate(spans, start, step, lambda s: F.concat(s["done"], F.substring(text, s["at"] + 1, F.length(text))))
