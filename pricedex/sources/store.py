"""Tables written once per application into the shared folder (``spark.checkpoint.dir``), then read back.

Used for the bronze stand-ins, the unified (silver) table and the forecast output — the places where the
reference also writes a table and serves many queries from it. Writing (instead of caching) cuts the lineage,
survives the loss of executors and keeps parquet statistics and partition pruning for the readers.
"""

from __future__ import annotations

import hashlib
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pricedex.session import application_id, parallelism, shared_table_root

_LOCK = threading.RLock()  # builds may materialise their own inputs
_WRITTEN: dict[tuple, str] = {}


def materialise(spark: SparkSession, name: str, key: tuple, build: Callable[[], DataFrame],
                partition_by: list[str] | None = None, schema: str | None = None,
                columns: list[str] | None = None) -> DataFrame:
    memo = (application_id(spark), name, key)
    with _LOCK:
        path = _WRITTEN.get(memo)
        if path is None:
            digest = hashlib.sha1(repr(key).encode()).hexdigest()[:12]
            path = f"{shared_table_root(spark)}/{name}/{digest}"
            w = build().write.mode("overwrite")
            if partition_by:
                w = w.partitionBy(*partition_by)
            w.parquet(path)
            _WRITTEN[memo] = path
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a folder of its own and read back: an intermediate result that several steps read."""
    spark = df.sparkSession
    path = f"{shared_table_root(spark)}/steps/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *key: str) -> DataFrame:
    """``df`` dealt to as many partitions as there are cores, or shuffle partitions if those are more (by ``key`` if given):
    for steps whose work is large against the bytes they read, which would otherwise be few tasks."""
    spark = df.sparkSession
    return df.repartition(max(parallelism(spark), int(spark.conf.get("spark.sql.shuffle.partitions"))), *key)
