"""Approximate nearest neighbours by windows on shifted Hilbert curves."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from resolvscope.session import work_path

CURVES = 8
DIMENSIONS = 16
BITS = 3
# Share of all vectors that a query's window covers on each curve.
SHARE = 0.2
# Vectors of a block, the piece of a curve that one task compares at a time, and queries compared with it at once.
BLOCK = 1024
QUERIES = 4096
SEED = 11


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of integer coordinates below ``2 ** bits`` (dimensions times bits below 64)."""
    x = cells.astype(np.int64).copy()
    n, dims = x.shape
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(dims):
            on = (x[:, i] & q) != 0
            swap = np.where(on, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(on, low, swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(n, np.int64)
    q = top
    while q > 1:
        flip ^= np.where((x[:, dims - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip[:, None]
    key = np.zeros(n, np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[:, i] >> b) & 1)
    return key


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector) of the rows that take part: finite, not all zero, of the table's commonest dimension, id not null."""
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    some = F.exists("embedding", lambda v: v != 0)
    kept = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite & some)
    kept = kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    common = kept.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).select("d")
    return kept.join(F.broadcast(common), F.size("vector") == F.col("d"), "left_semi")


def _project(dimension: int, curve: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions and shift of a curve: part of a random rotation, and where the grid's corner lies."""
    rng = np.random.default_rng([SEED, curve])
    directions = np.linalg.qr(rng.normal(size=(dimension, dimension)))[0][:, : min(DIMENSIONS, dimension)]
    return directions, rng.random(directions.shape[1])


def curve_keys(vectors: DataFrame, mean: np.ndarray, spread: np.ndarray, curves: int, bits: int) -> DataFrame:
    """(curve, key, vec_id, vector): every vector on every curve."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            x = (np.stack(frame["vector"].to_numpy()) - mean) / spread
            for c in range(curves):
                directions, shift = _project(len(mean), c)
                unit = np.clip((x @ directions + 4 + shift) / 9, 0, 1 - 1e-9)
                yield pd.DataFrame(
                    {"curve": c, "key": hilbert_keys((unit * (1 << bits)).astype(np.int64), bits), "vec_id": frame["vec_id"], "vector": frame["vector"]}
                )

    return vectors.mapInPandas(run, "curve int, key long, vec_id long, vector array<double>")


def _nearest(vectors: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest ids of a block for each query, itself left out, by the nearest row of each; ties at the edge are all kept."""
    if not len(vectors) or not len(queries):
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
    vectors = vectors.sort_values("vec_id", kind="stable")
    x, ids = np.stack(vectors["vector"].to_numpy()), vectors["vec_id"].to_numpy()
    y, asks = np.stack(queries["vector"].to_numpy()), queries["query_id"].to_numpy()
    distinct, first = np.unique(ids, return_index=True)
    out = []
    norms = (x * x).sum(1)
    for low in range(0, len(y), 512):
        part = y[low : low + 512]
        rough = norms[None] - 2 * part @ x.T
        rough[asks[low : low + 512, None] == ids[None]] = np.inf
        if len(distinct) > k:
            edge = np.partition(np.minimum.reduceat(rough, first, axis=1), k - 1, axis=1)[:, k - 1]
            # Rounding moves the rough measure by less than this.
            slack = 1e-9 * (1 + np.abs(edge) + norms.max() + (part * part).sum(1))
            q, v = np.nonzero((rough <= (edge + slack)[:, None]) & (rough < np.inf))
        else:
            q, v = np.nonzero(rough < np.inf)
        score = np.sqrt(((part[q] - x[v]) ** 2).sum(1))
        out.append(pd.DataFrame({"query_id": asks[low + q], "vec_id": ids[v], "score": score}))
    return pd.concat(out).groupby(["query_id", "vec_id"], as_index=False)["score"].min()


def search(vectors: DataFrame, is_query: Column, k: int = 10, curves: int = CURVES, share: float = SHARE, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query row, by Euclidean distance in double precision.

    Vectors are scaled by each component's mean and spread, projected on ``curves`` sets of random directions, shifted, and
    ordered along a Hilbert curve in each. Each order is dealt to tasks by range and cut into blocks; a query meets the
    blocks that its window of ``share`` of all vectors touches on each curve. The lists of all blocks are merged and
    ranked on the original vectors, ties to the smaller id. A window is a share, not a number, so recall does not fall as
    the table grows; every vector is on every curve.

    Rows that are null, all zero, not finite, of another dimension than most, or without an id take no part. Of rows that
    repeat an id the nearest counts. Fewer rows than ``k`` give all there are; an empty table gives none.
    """
    spark = vectors.sparkSession
    folder = work_path(spark, "curves")
    schema = "query_id long, rank int, vec_id long, score double"
    # Rows that are equal would fill a window without adding to it.
    chosen = usable(vectors).distinct()
    stats = (
        chosen.select(F.posexplode("vector").alias("i", "v")).groupBy("i").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s"), F.count("v").alias("n"))
    ).orderBy("i").collect()
    if not stats:
        return spark.createDataFrame([], schema)
    mean = np.array([r["m"] for r in stats])
    spread = np.array([r["s"] or 1.0 for r in stats])
    half = int(np.ceil(stats[0]["n"] * share / 2))
    tasks = max(curves, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = curve_keys(chosen, mean, spread, curves, min(bits, 62 // min(DIMENSIONS, len(mean)))).repartitionByRange(tasks, "curve", "key", "vec_id")
    dealt.withColumn("task", F.spark_partition_id()).write.parquet(f"{folder}/dealt")
    dealt = spark.read.parquet(f"{folder}/dealt")
    counts = dealt.groupBy("curve", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("curve").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("curve", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("curve", "task").orderBy("key", "vec_id")
    ordered = dealt.withColumn("at", F.row_number().over(inside) - 1).join(F.broadcast(bases), ["curve", "task"])
    ordered.select("curve", "vec_id", "vector", (F.col("base") + F.col("at")).alias("at")).write.parquet(f"{folder}/ordered")
    ordered = spark.read.parquet(f"{folder}/ordered")
    asked = ordered.where(is_query)
    chunks = max(1, -(-asked.where("curve = 0").count() // QUERIES))
    asks = asked.select(
        "curve",
        F.col("vec_id").alias("query_id"),
        "vector",
        F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int").alias("chunk"),
        F.explode(F.sequence(F.floor(F.greatest(F.col("at") - half, F.lit(0)) / block), F.floor((F.col("at") + half) / block))).alias("block"),
    )
    blocks = ordered.select(
        "curve", "vec_id", "vector", F.floor(F.col("at") / block).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk")
    )
    key = ["curve", "block", "chunk"]
    met = blocks.groupBy(*key).cogroup(asks.groupBy(*key)).applyInPandas(
        lambda left, right: _nearest(left, right, k), "query_id long, vec_id long, score double"
    )
    nearest = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        met.groupBy("query_id", "vec_id")
        .agg(F.min("score").alias("score"))
        .withColumn("rank", F.row_number().over(nearest))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
