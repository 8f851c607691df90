"""URL filters: host and path rules, and a character language-model ratio for the rest.

URLs that a rule decides teach two smoothed Markov models of variable order, one of allowed and one
of blocked URLs. A character's probability after its context of two characters is interpolated
with those after one character and after none (Witten-Bell smoothing). A URL no rule decides is
judged by the difference of its log-likelihoods per character, against a threshold calibrated on
rule-decided URLs that were kept out of the counts.

The models are one table over all runs of three symbols: its size is fixed by the alphabet, so it
may be broadcast whatever the corpus. Log-ratios are whole numbers of 1e-6, so sums agree in any
order and engine. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicloom.session import cut_lineage

# Symbols of the models; any other character counts as the last one, and '^' stands before the first.
SYMBOLS = "^abcdefghijklmnopqrstuvwxyz0123456789./-_?"
N = len(SYMBOLS)
SCALE = 1_000_000
# Score bins of the calibration: from -RANGE to RANGE nats per character, STEPS bins to a nat.
RANGE, STEPS = 8, 100
# One URL in so many is kept out of the counts, for calibration.
KEPT_OUT = 4

# The rules of the contract: (host, path, verdict).
RULES: tuple[tuple[str, str, str], ...] = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty for null and for URLs without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def match_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for of_host, of_path, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == of_host) | host.endswith("." + of_host)) & path.startswith(of_path)
        rule, verdict = F.when(fits, of_host + of_path).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _codes(text: Column) -> Column:
    """Symbol numbers of a text, with two of the first symbol in front."""
    plain = F.regexp_replace(F.translate(text, _UPPER, _LOWER), r"(?s)[^a-z0-9./_-]", "?")
    return F.transform(F.split(F.concat(F.lit("^^"), plain), ""), lambda c: F.position(c, F.lit(SYMBOLS)) - 1)


def grams(text: Column) -> Column:
    """array<int>: codes of the runs of three symbols that end at each character of the text."""
    codes = _codes(text)
    runs = F.zip_with(
        F.zip_with(codes, F.slice(codes, F.lit(2), F.size(codes)), lambda a, b: a * N + b),
        F.slice(codes, F.lit(3), F.size(codes)),
        lambda ab, c: ab * N + c,
    )
    return F.when(F.length(text) == 0, F.array().cast("array<int>")).otherwise(F.filter(runs, lambda g: g.isNotNull()))


def train(rows: DataFrame) -> DataFrame:
    """(gram, ratio) for every run of three symbols, from rows (_text, verdict).

    A class without any URL has uniform probabilities.
    """
    kinds = ("allow", "block")
    counts = rows.select("verdict", F.explode(grams(F.col("_text"))).alias("gram")).groupBy("gram")
    counts = counts.agg(*(F.sum((F.col("verdict") == v).cast("bigint")).alias(v) for v in kinds))
    gram = F.col("gram")
    full = rows.sparkSession.range(N**3).select(F.col("id").cast("int").alias("gram")).join(counts, "gram", "left")
    full = full.select(
        "gram",
        F.floor(gram / (N * N)).alias("x"),
        (F.floor(gram / N) % N).alias("y"),
        (gram % N).alias("z"),
        *(F.coalesce(v, F.lit(0)).alias(f"c3_{v}") for v in kinds),
    )

    def total(value: Column, *by: str) -> Column:
        return F.sum(value).over(Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0)))

    def kinds_seen(count: str, copies: int, *by: str) -> Column:
        return total((F.col(count) > 0).cast("bigint"), *by) / copies

    for v in kinds:  # the table has N**3 rows, however long the corpus
        c3 = F.col(f"c3_{v}")
        full = full.withColumns({f"c2_{v}": total(c3, "y", "z"), f"c1_{v}": total(c3, "z")})
        full = full.withColumns(
            {
                f"t3_{v}": total(c3, "x", "y"),
                f"t2_{v}": total(c3, "y"),
                f"t1_{v}": total(c3),
                f"k3_{v}": kinds_seen(f"c3_{v}", 1, "x", "y"),
                f"k2_{v}": kinds_seen(f"c2_{v}", N, "y"),
                f"k1_{v}": kinds_seen(f"c1_{v}", N * N),
            }
        )

    def probability(v: str) -> Column:
        """Witten-Bell: the shorter context's probability counts as often as it has kinds of characters."""
        p = F.lit(1.0 / N)
        for order in (1, 2, 3):
            c, t, k = (F.col(f"{x}{order}_{v}") for x in "ctk")
            p = F.when(t == 0, p).otherwise((c + k * p) / (t + k))
        return p

    return full.select("gram", F.round(F.log(probability("allow") / probability("block")) * SCALE).cast("bigint").alias("ratio"))


def score(rows: DataFrame, model: DataFrame, wanted: Column) -> DataFrame:
    """``rows`` with ``bin``, the log-likelihood difference per character in steps; 0 for empty
    texts and where ``wanted`` is false. Repeated rows stay apart."""
    columns = [c for c in rows.columns if c != "_text"]
    own = rows.withColumn("_row", F.monotonically_increasing_id()).withColumn("_grams", F.when(wanted, grams(F.col("_text"))))
    # One row per character; their sums are built before the shuffle.
    each = own.select("_row", *columns, F.explode_outer("_grams").alias("gram")).join(F.broadcast(model), "gram", "left")
    sums = each.groupBy("_row").agg(*(F.first(c).alias(c) for c in columns), F.sum("ratio").alias("_sum"), F.count("gram").alias("_n"))
    step = F.floor(F.col("_sum") * float(STEPS) / (F.col("_n") * float(SCALE)))
    step = F.greatest(F.lit(-RANGE * STEPS), F.least(F.lit(RANGE * STEPS), step)).cast("int")
    return sums.select(*columns, F.when(F.col("_n") > 0, step).otherwise(0).alias("bin"))


def calibrate(scored: DataFrame) -> int:
    """The bin from which URLs are allowed: least sum of both error rates, then nearest to 0.

    0 if one of the classes has no URL.
    """
    spark = scored.sparkSession
    counts = scored.groupBy("bin").agg(*(F.sum((F.col("verdict") == v).cast("bigint")).alias(v) for v in ("allow", "block")))
    bins = spark.range(-RANGE * STEPS, RANGE * STEPS + 1).select(F.col("id").cast("int").alias("bin")).join(counts, "bin", "left")
    below, all_bins = Window.partitionBy(F.lit(0)).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(0))
    n = {v: F.coalesce(v, F.lit(0)).cast("decimal(18,0)") for v in ("allow", "block")}
    lost = F.coalesce(F.sum(n["allow"]).over(below), F.lit(0))  # allowed URLs below the bin
    passed = F.sum(n["block"]).over(all_bins) - F.coalesce(F.sum(n["block"]).over(below), F.lit(0))
    total = {v: F.sum(n[v]).over(all_bins).cast("double") for v in n}
    error = lost.cast("double") / total["allow"] + passed.cast("double") / total["block"]
    error = F.when((total["allow"] > 0) & (total["block"] > 0), F.round(error, 9)).otherwise(0.0)
    return bins.select("bin", error.alias("error")).orderBy("error", F.abs("bin"), "bin").first()[0]


def filter_urls(pages: DataFrame, url: str = "url", key: str = "page_id", rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """(key, host, path, rule, verdict, bin) per row; ``bin`` is 0 where a rule decides.

    Null URLs and URLs without ``://`` have an empty host and path; their score is 0. Without any
    rule-decided URL all scores are 0, and everything else is allowed. Repeated rows are judged
    each for itself; other columns are left out.
    """
    host, path = split_url(F.col(url))
    rows = pages.select(F.col(key).alias("_key"), host.alias("host"), path.alias("path"), F.substring(F.md5(F.coalesce(url, F.lit(""))), 1, 1).alias("_part"))
    rule, verdict = match_rule(F.col("host"), F.col("path"), rules)
    rows = rows.select("_key", "host", "path", rule.alias("rule"), verdict.alias("verdict"), "_part", F.concat("host", "path").alias("_text"))
    kept_out = F.col("_part").isin(*"0123456789abcdef"[: 16 // KEPT_OUT])
    model = cut_lineage(train(rows.where(F.col("rule").isNotNull() & ~kept_out).select("_text", "verdict")))
    known = rows.where(F.col("rule").isNotNull() & kept_out).select("_text", "verdict")
    least = calibrate(score(known, model, F.lit(True)))
    scored = score(rows.drop("_part"), model, F.col("rule").isNull())
    judged = F.coalesce("verdict", F.when(F.col("bin") >= least, "allow").otherwise("block"))
    return scored.select(F.col("_key").alias(key), "host", "path", "rule", judged.alias("verdict"), "bin")
