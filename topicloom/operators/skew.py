"""Joins, top-k and numbering that stay balanced when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicloom.session import cut_lineage

# Rows of one key that one task may take before the key is split.
ROWS_PER_SALT = 2_000_000
# A key is split once it holds more than its share of so many pieces per shuffle partition; so at
# most that many keys are split, whatever the data.
PIECES_PER_PARTITION = 4
# Largest lookup table that is broadcast.
BROADCAST_BYTES = 64 << 20


def _value_bytes(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0))
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.NumericType, T.BooleanType)):
            return F.coalesce(F.size(value) * 8, F.lit(0))
        parts = F.transform(value, lambda x: _value_bytes(x, kind.elementType) + 16)
        return F.coalesce(F.aggregate(parts, F.lit(0), lambda s, x: s + x), F.lit(0))
    if isinstance(kind, T.StructType):
        total = F.lit(0)
        for field in kind.fields:
            total = total + _value_bytes(value[field.name], field.dataType)
        return total
    return F.lit(8)


def table_bytes(df: DataFrame) -> int:
    """Size of a table in memory, from the lengths of its values; read it only if it is cheap to read."""
    row = F.lit(32)
    for field in df.schema.fields:
        row = row + 16 + _value_bytes(F.col(f"`{field.name}`"), field.dataType)
    return df.agg(F.sum(row.cast("bigint"))).first()[0] or 0


def hot_keys(counts: DataFrame, key: str, n: str, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """The heavy keys of a (key, n) table with the number of pieces each is cut in.

    The size of a piece follows from the total, so the list is short enough to be broadcast and no
    heavy key is left out of it.
    """
    partitions = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per_key = counts.groupBy(key).agg(F.max(n).alias("_rows"))
    share = F.ceil(per_key.agg(F.sum("_rows")).scalar() / (PIECES_PER_PARTITION * partitions))
    size = F.greatest(F.lit(rows_per_salt), share)
    return per_key.where(F.col("_rows") > size).select(key, F.ceil(F.col("_rows") / size).cast("int").alias("_pieces"))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    heat: str | None = None,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Equi-join whose hot left keys are cut in pieces and met by copies of the right rows.

    ``heat`` names a column of ``right`` with the number of left rows of the key; without it the
    left side is counted. Meant for sides that come grouped by the key, whose shuffles adaptive
    execution can't split. Results equal the plain join for inner, left, left_semi and left_anti.
    """
    if heat is None:
        hot = hot_keys(left.groupBy(key).agg(F.count("*").alias("_n")), key, "_n", rows_per_salt)
    else:
        hot = hot_keys(right, key, heat, rows_per_salt)
    pieces = F.coalesce("_pieces", F.lit(1))
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns])
    cut_left = (
        left.join(F.broadcast(hot), key, "left").withColumn("_salt", F.pmod(spread, pieces).cast("int")).drop("_pieces")
    )
    copied_right = (
        right.join(F.broadcast(hot), key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), pieces - 1)))
        .drop("_pieces")
    )
    return cut_left.join(copied_right, [key, "_salt"], how).drop("_salt")


def lookup_join(left: DataFrame, right: DataFrame, key: str | Column, how: str = "inner", max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join to a lookup table, which is computed once and written down.

    It is broadcast when its size allows. Otherwise both sides are shuffled for this join alone, so
    adaptive execution sees the rows of each key as they are and splits hot ones.
    """
    right = cut_lineage(right)
    return left.join(F.broadcast(right) if table_bytes(right) <= max_bytes else right, key, how)


def rows_by_key(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame | None]:
    """(rows whose key stands on no other row, rows of keys that stand on several, or None without any).

    What a grouping by key would bring together lies in one row for the former. Nulls are one key; only keys are
    shuffled to tell them."""
    many = df.groupBy(F.col(key).alias("_many")).agg(F.count("*").alias("_n")).where("_n > 1").select("_many")
    many = cut_lineage(many)
    same = F.col(key).eqNullSafe(F.col("_many"))
    return lookup_join(df, many, same, "left_anti"), None if many.isEmpty() else lookup_join(df, many, same, "left_semi")


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, pieces: int = 1, rank: str = "rank"
) -> DataFrame:
    """The first ``k`` rows of each group by ``order``, with their rank.

    Spark limits each map task to ``k`` rows per group before the shuffle. ``pieces`` > 1 adds
    a first pass per slice of a group, for groups spread over very many tasks.
    """
    if pieces > 1:
        slice_key = F.pmod(F.xxhash64(*df.columns), F.lit(pieces))
        local = Window.partitionBy(*group, "_slice").orderBy(*order)
        df = (
            df.withColumn("_slice", slice_key)
            .withColumn("_local", F.row_number().over(local))
            .where(F.col("_local") <= k)
            .drop("_slice", "_local")
        )
    whole = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(whole)).where(F.col(rank) <= k)


def dense_index(df: DataFrame, order: Sequence[Column | str], name: str = "index") -> DataFrame:
    """Number the rows 0..n-1 in the given (total) order without one task seeing all rows.

    The sorted rows are range partitioned and materialised once; each row then adds its
    place in its partition to the number of rows in the partitions before it.
    """
    ordered = cut_lineage(df.orderBy(*order))
    placed = ordered.withColumn("_part", F.spark_partition_id()).withColumn(
        "_place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    )
    # One row per partition: small enough for one task and for a broadcast.
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_place"))
        .drop("_part", "_place", "_start")
    )


def ranked_within(df: DataFrame, group: Sequence[str] | str, order: Sequence[Column], rank: str = "rank") -> DataFrame:
    """Rows with their rank (from 1) in their group, by a total order, however large a group is.

    The rows are sorted by group and order over range partitions, which may cut a group, and
    numbered as a whole; a group's first number is then taken off.
    """
    columns = df.columns
    group = [group] if isinstance(group, str) else list(group)
    numbered = dense_index(df, [*group, *order], "_nth").withColumn("_group", F.struct(*group))
    first = numbered.groupBy("_group").agg(F.min("_nth").alias("_first"))
    return lookup_join(numbered, first, "_group").select(*columns, (F.col("_nth") - F.col("_first") + 1).alias(rank))
