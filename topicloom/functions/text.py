"""Text columns: width folding, delimited codecs, tag paths, letter runs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ideographic space and the full-width forms of '!' to '~'.
WIDE = "　" + "".join(chr(c) for c in range(0xFF01, 0xFF5F))
NARROW = " " + "".join(chr(c - 65248) for c in range(0xFF01, 0xFF5F))

DEFAULT_PATTERN = r"[\p{L}]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_half_width(c: Column | str) -> Column:
    """Full-width forms to ASCII, ideographic space to blank, the rest unchanged."""
    return F.translate(_col(c), WIDE, NARROW)


def to_simplified(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Replace single characters by ``mapping`` (one character to one character)."""
    if any(len(k) != 1 or len(v) != 1 for k, v in mapping.items()):
        raise ValueError("mapping must hold single characters")
    if not mapping:
        return _col(c)
    return F.translate(_col(c), "".join(mapping), "".join(mapping.values()))


def letter_runs(c: Column | str, pattern: str = DEFAULT_PATTERN) -> Column:
    """Lower-cased matches of ``pattern`` in order."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(pattern), F.lit(0))


def split_java(c: Column | str, sep: str) -> Column:
    """Split on a regex and drop trailing empty items, as JVM programs do.

    A text without a separator stays one item, even when it is empty.
    """
    parts = F.split(_col(c), sep)
    filled = F.array_max(F.transform(parts, lambda x, i: F.when(x != "", i + 1).otherwise(0)))
    return F.when(F.size(parts) == 1, parts).otherwise(F.slice(parts, F.lit(1), filled))


def parse_tokens(c: Column | str, sep: str = ",") -> Column:
    """Delimited text to tokens; empty tokens are dropped."""
    return F.filter(F.split(_col(c), sep), lambda x: x != "")


def join_tokens(c: Column | str, sep: str = ",") -> Column:
    return F.array_join(_col(c), sep)


def parse_weighted(c: Column | str, sep: str = ";", strict: bool = False) -> Column:
    """``w;x,w;x`` to an array of (word, weight).

    A malformed entry becomes ("", 0.0), or raises when ``strict``. ``sep`` is a literal.
    """
    quoted = "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)

    def one(entry: Column) -> Column:
        parts = F.split(entry, quoted)
        weight = F.try_element_at(parts, F.lit(2))
        number = weight.cast("double") if strict else weight.try_cast("double")
        good = weight.isNotNull() & (weight != "") & number.isNotNull()
        bad_word = F.raise_error(F.concat(F.lit("malformed entry: "), entry)).cast("string") if strict else F.lit("")
        return F.struct(
            F.when(good, parts[0]).otherwise(bad_word).alias("word"),
            F.when(good, number).otherwise(F.lit(0.0)).alias("weight"),
        )

    return F.transform(F.split(_col(c), ","), one)


def format_weighted(
    c: Column | str, sep: str = ";", word: str = "word", weight: str = "weight"
) -> Column:
    """Array of structs back to ``w;x,w;x``."""
    return F.array_join(
        F.transform(_col(c), lambda x: F.concat(x[word].cast("string"), F.lit(sep), x[weight].cast("string"))), ","
    )


def split_ids(c: Column | str) -> Column:
    """Composite id text to its member ids; commas count as bars."""
    return F.split(F.regexp_replace(_col(c), ",", "|"), r"\|")


def join_ids(c: Column | str) -> Column:
    return F.array_join(_col(c), "|")


def tag_prefixes(c: Column | str, depth: int = 3) -> Column:
    """``A-B-C-D`` to ``[A, A-B, A-B-C]``."""
    parts = split_java(c, "-")
    levels = F.sequence(F.lit(1), F.least(F.lit(depth), F.greatest(F.size(parts), F.lit(1))))
    return F.transform(levels, lambda i: F.array_join(F.slice(parts, F.lit(1), i), "-"))


def vec_to_string(c: Column | str) -> Column:
    return F.array_join(F.transform(_col(c), lambda x: x.cast("string")), ",")


def string_to_vec(c: Column | str) -> Column:
    return F.split(_col(c), ",").cast("array<double>")
