"""Tables with one partition column ``stat_date``, kept as Parquet folders."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTITION = "stat_date"

# Type names understood by schema text.
TYPE_NAMES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "bool": T.BooleanType(),
    "double": T.DoubleType(),
}


def create_schema(columns: Sequence[tuple[str, str]], nullable: bool = True) -> T.StructType:
    """Schema from (name, type name) pairs; other type names are an error."""
    unknown = [kind for _, kind in columns if kind.lower() not in TYPE_NAMES]
    if unknown:
        raise ValueError(f"unknown types: {unknown}")
    return T.StructType([T.StructField(name, TYPE_NAMES[kind.lower()], nullable) for name, kind in columns])


def create_string_schema(names: Sequence[str]) -> T.StructType:
    return create_schema([(name, "string") for name in names])


def spread(df: DataFrame) -> DataFrame:
    """A scan with fewer splits than cores is dealt out to all cores; a larger one is left as it is.

    Only for plain scans, whose splits are known without running anything; a table of one small file
    is left alone on a large cluster: it is dealt to as many tasks as shuffles have, at most."""
    spark = df.sparkSession
    tasks = min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df


def partition_path(table: str, dt: str | int) -> str:
    return f"{table.rstrip('/')}/{PARTITION}={dt}"


def save_partition(df: DataFrame, table: str, dt: str | int, part_type: str = "bigint") -> None:
    """Replace one partition of a table, also when the new rows are none at all.

    The rows are written to a staging folder of the table first (its name starts with ``_``, so
    readers skip it) and then put in place of the partition by renames: a failed write leaves the
    old rows alone, and the rows may be computed from the partition they replace. Other partitions
    are not touched and nothing is shuffled. An existing table keeps its columns: they must match in number and type and are
    filled by position."""
    if part_type not in ("bigint", "string"):
        raise ValueError(f"unknown partition type: {part_type}")
    if part_type == "bigint":
        dt = int(dt)
    old = _columns(df.sparkSession, table)
    if old is not None:
        types = [f.dataType.simpleString() for f in df.schema]
        if types != [f.dataType.simpleString() for f in old]:
            raise ValueError(f"columns {types} do not fit the table {old.simpleString()}")
        df = df.toDF(*old.names)
    target = partition_path(table, dt)
    stage = f"{table.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    df.write.parquet(stage)  # the old rows stay as they are until the new ones are complete
    _swap(df.sparkSession, stage, target)


def _swap(spark: SparkSession, stage: str, target: str) -> None:
    """Put a written folder in place of another by renames on one file system; on failure the old one stays."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    new, old = jvm_path(stage), jvm_path(target)
    fs = new.getFileSystem(spark._jsc.hadoopConfiguration())
    retired = jvm_path(f"{stage}-retired")
    had = fs.exists(old)
    if had and not fs.rename(old, retired):
        fs.delete(new, True)
        raise OSError(f"could not move {target} aside")
    if not fs.rename(new, old):
        if had:
            fs.rename(retired, old)
        raise OSError(f"could not move {stage} to {target}")
    if had:
        fs.delete(retired, True)


def _folders(spark: SparkSession, table: str) -> list[str]:
    """Partition folders of a table; nothing inside them is listed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(table)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found = [str(s.getPath().toString()) for s in fs.listStatus(path)]
    return sorted(p for p in found if f"/{PARTITION}=" in p)


def _columns(spark: SparkSession, table: str) -> T.StructType | None:
    folders = _folders(spark, table)
    return spark.read.parquet(folders[-1]).schema if folders else None


def read_partition(
    spark: SparkSession,
    table: str,
    dt: str | int | None = None,
    cols: Sequence[str] | None = None,
    part_type: str = "bigint",
) -> DataFrame:
    """Rows of one partition, or of all; only the folder of the partition is listed."""
    if dt is None:
        rows = spark.read.parquet(table)
        rows = rows.withColumn(PARTITION, F.col(PARTITION).cast(part_type))
    else:
        rows = spark.read.parquet(partition_path(table, dt)).withColumn(PARTITION, F.lit(dt).cast(part_type))
    return rows.select(*cols) if cols else rows
