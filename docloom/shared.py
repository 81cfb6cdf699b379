"""Session helpers that every part of the engine uses: durable intermediate tables and size-checked broadcasts."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows and bytes up to which a lookup side may be broadcast. Beyond them joins shuffle.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20

_fallback: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only where that setting is absent (local tests) a temporary folder of this process is used.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if "dir" not in _fallback:
        _fallback["dir"] = tempfile.mkdtemp(prefix="docloom-")
    return _fallback["dir"]


def durable(df: DataFrame, *keys: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back, so that its lineage ends there.

    The files survive the loss of executors and are removed when the driver ends.
    ``keys`` only name columns to cluster the files by.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/docloom-{uuid.uuid4().hex}"
    (df.repartition(*keys) if keys else df).write.option("compression", "zstd").parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the JVM may be gone already
        pass


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``limit`` rows and ``BROADCAST_BYTES``, else unchanged.

    ``df`` must be cheap to count (a durable table or a small scan); counting stops at ``limit + 1``. Columns of any
    length are measured, where there are any.
    """
    if df.limit(limit + 1).count() > limit:
        return df
    fixed = [f for f in df.schema if isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DatetimeType))]
    long = [F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)) for f in df.schema if f not in fixed]
    size = df.agg(F.sum(sum(long, F.lit(8 * len(fixed)).cast("long")))).first()[0] if long else 0
    return F.broadcast(df) if (size or 0) <= BROADCAST_BYTES else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
