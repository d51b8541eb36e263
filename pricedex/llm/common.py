"""Helpers shared by the text operators: tables in the shared folder, row identities, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricedex.session import application_id, ensure_checkpoint_dir


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder path (not yet created) below the shared folder named by ``spark.checkpoint.dir``."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/pricedex-llm/{application_id(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def as_row(docs: DataFrame) -> Column:
    """All columns of ``docs`` in one struct, so that columns a step adds cannot clash with any of their names."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def row_fields(docs: DataFrame, row: str, changed: dict[str, Column] | None = None) -> list[Column]:
    """The columns of ``docs`` out of the struct column ``row``, those in ``changed`` replaced."""
    return [(changed or {}).get(c, F.col(row).getField(c)).alias(c) for c in docs.columns]


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as make it none of the columns."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def _forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node of its component) of the components that the links u-v form."""
    nodes, inverse = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = inverse[: len(u)], inverse[len(u):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = np.minimum(new, new[new])
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    far = label != np.arange(len(nodes))
    return nodes[far], nodes[label[far]]


def _contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per batch, replace links by a spanning forest pointing to the smallest node (same components, fewer links)."""
    for batch in batches:
        if len(batch):
            node, root = _forest(batch["u"].to_numpy(np.int64), batch["v"].to_numpy(np.int64))
            yield pd.DataFrame({"u": node, "v": root})


def connected_components(links: DataFrame) -> DataFrame:
    """Components of an undirected graph given as links (u long, v long): rows (node, component).

    Only nodes with a link to another node are returned; ``component`` is the smallest node of the component. Every
    round points each node to its smallest neighbour and links that node's other neighbours to it too (alternating
    large and small stars), until the links are stars. The links stay distributed: neighbourhoods are never collected,
    only their minimum is (a partial aggregate before the shuffle), and the join by node leaves a hot node to Spark's
    skew-join handling. Each round is written to the shared folder.
    """
    pairs = links.select(F.least("u", "v").cast("long").alias("u"), F.greatest("u", "v").cast("long").alias("v"))
    pairs = pairs.where(F.col("u") < F.col("v"))
    stars = materialise(pairs.mapInPandas(_contract, "u long, v long").distinct(), "links")
    was = _digest(stars)
    while True:
        # large star: a node's larger neighbours move to its smallest neighbour
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = (both.where(F.col("v") > F.col("u")).join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        # small star: a node and its smaller neighbours move to the smallest of them
        low = moved.groupBy("u").agg(F.min("v").alias("m"))
        small = (moved.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        stars = materialise(small, "links")
        now = _digest(stars)
        if now == was:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
        was = now


def _digest(links: DataFrame) -> tuple:
    """Number of links and the sum of their hashes: equal exactly when a round has changed nothing."""
    hashes = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(links.agg(F.count("*"), F.sum(hashes)).first())
