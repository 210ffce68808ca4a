"""Parquet scans and sinks, temp views, SQL entry point and stage profiles."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from encore.session import ensure_checkpoint_dir


#: Scratch folders by application.
_SCRATCH: dict[str, list[str]] = {}


_INTEGRAL = ("tinyint", "smallint", "int", "bigint")


def _schema_fields(schema) -> list[tuple[str, str]]:
    if isinstance(schema, StructType):
        return [(f.name, f.dataType.simpleString()) for f in schema.fields]
    st = StructType.fromDDL(schema)
    return [(f.name, f.dataType.simpleString()) for f in st.fields]


def read_table(spark: SparkSession, path: str | list[str], schema=None, where=None) -> DataFrame:
    """Parquet scan; a directory or a list of paths reads as one table.

    With ``schema`` (DDL string or StructType) the declared columns are
    selected in the declared order and cast with checks: a value that does not
    fit the declared type, or has a fraction where a whole number is declared,
    fails the job. Column pruning reaches the scan; a filter above the casts
    does not, so ``where`` filters on the stored types.
    """
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.parquet(*paths)
    if where is not None:
        df = df.where(where)
    if schema is None:
        return df
    missing = [name for name, _ in _schema_fields(schema) if name not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} not in {paths}")
    return df.select(*[_checked_cast(df, name, dtype).alias(name) for name, dtype in _schema_fields(schema)])


def _checked_cast(df: DataFrame, name: str, dtype: str):
    """A cast that fails on a value outside the declared type, whatever the session's ANSI setting."""
    value = F.col(name)
    if dict(df.dtypes)[name] == dtype:
        return value
    tried = value.try_cast(dtype)
    whole = F.lit(True)
    if dtype in _INTEGRAL and (dict(df.dtypes)[name] in ("float", "double") or dict(df.dtypes)[name].startswith("decimal")):
        whole = tried.cast(dict(df.dtypes)[name]) == value  # a cast would cut a fraction off
    message = F.concat(F.lit(f"{name} does not fit {dtype}: "), value.cast("string"))
    return F.when(value.isNull() | (tried.isNotNull() & whole), tried).otherwise(F.raise_error(message).cast(dtype))


def write_table(df: DataFrame, path: str, mode: str = "errorifexists",
                partition_by: list[str] | None = None) -> str:
    """Parquet sink: ``overwrite`` or the default error-if-exists."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the reliable checkpoint directory (shared storage), noted for ``release_all``."""
    path = f"{ensure_checkpoint_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialize(df: DataFrame, name: str = "stage", partition_by: list[str] | None = None,
                written: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()``, but the stage is stored columnar
    and compressed, and later reads get column pruning, filter pushdown into
    row groups and file-size statistics for AQE. With ``partition_by`` the
    table is split into directories, and a filter on those columns reads only
    the matching ones. Row order and partitioning are not kept (use
    ``checkpoint()`` where they matter). The path is appended to ``written``
    when given, so the owner can delete its tables later.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if written is not None:
        written.append(path)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    # The schema is known: no footer reads to infer it again.
    return spark.read.schema(df.schema).parquet(path)


def materialize_counted(df: DataFrame, name: str, counts: dict[str, Column], partition_by: list[str] | None = None,
                        written: list[str] | None = None) -> tuple[DataFrame, dict[str, int]]:
    """``materialize``, and how many of the rows fulfil each condition: taken while they are written, so nothing is read again."""
    observed = Observation(f"{name}-{uuid.uuid4().hex}")
    seen = df.observe(observed, *[F.count(F.when(condition, 1)).alias(key) for key, condition in counts.items()])
    table = materialize(seen, name, partition_by, written)
    return table, {key: int(observed.get[key]) for key in counts}


def release_all(spark: SparkSession) -> int:
    """Delete every table that this application wrote to its scratch folder; frames built on them become invalid.

    Checkpoints of frames go with the frames (the session's cleaner setting).
    """
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    return sum(delete_path(spark, path) for path in paths)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path`` on its (shared) file system via Hadoop's API."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(hpath, True))


def register(df: DataFrame, name: str) -> str:
    """Temp view so SQL text and DataFrame code can be mixed."""
    df.createOrReplaceTempView(name)
    return name


def run_sql(spark: SparkSession, text: str) -> DataFrame:
    return spark.sql(text)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Concatenate by column name, then drop duplicate rows."""
    return a.unionByName(b).distinct()


def profile(stages: dict[str, DataFrame]) -> DataFrame:
    """One ``(stage, rows)`` row per named frame, all counted in one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("stage"), "rows")
             for name, df in stages.items()]
    return union_all(parts)


def sample_rows(df: DataFrame, n: int, key: list[str], seed: int = 42) -> DataFrame:
    """A seeded sample of exactly ``n`` rows (all, if fewer): those of the smallest md5 of ``seed|key...``.

    Whatever the partitioning, the same rows are taken, and samples of parts
    merge into the sample of the whole: a task keeps its ``n`` smallest rows and
    only these meet. ``key`` names columns that make a row unique; a null counts
    as the empty text.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key]
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    return df.orderBy(h, *[F.col(c).asc_nulls_first() for c in key]).limit(n)


def head_rows(df: DataFrame, order: list, n: int) -> DataFrame:
    """Deterministic head: the first ``n`` rows of a total order."""
    return df.orderBy(*order).limit(n)
