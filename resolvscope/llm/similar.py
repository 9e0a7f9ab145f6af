"""Links between sets that share a key: a star for each key first, then blocks of what is still apart."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resolvscope.llm.components import _kept, components, spread_join

# Elements of a block's sets, about; a crowded key's members are dealt to blocks that meet two at a time.
BLOCK = 1 << 18


def matches(a: str, b: str) -> Column:
    """Number of places where two signature columns agree."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))


def similar(pairs: DataFrame, sets: DataFrame, percent: int, least: int) -> DataFrame:
    """The pairs (a, b) that agree in ``least`` places of the signatures, and whose sets have the similarity."""
    sized = sets.withColumn("n", F.size("set"))
    met = spread_join(pairs, sized.select(*[F.col(c).alias(f"{c}_b") for c in sized.columns]).withColumnRenamed("node_b", "b"), "b")
    met = spread_join(met, sized.select(*[F.col(c).alias(f"{c}_a") for c in sized.columns]).withColumnRenamed("node_a", "a"), "a")
    near = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    counted = met.where(near).where(matches("sig_a", "sig_b") >= least if least else F.lit(True))
    common = counted.select("a", "b", F.size(F.array_intersect("set_a", "set_b")).cast("long").alias("common"), (F.col("n_a") + F.col("n_b")).alias("both"))
    return common.where(100 * F.col("common") >= percent * (F.col("both") - F.col("common"))).select("a", "b")


def block_links(frame: pd.DataFrame, percent: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the similar sets of one block, or of two blocks; members of one root are not compared.

    ``side`` tells the blocks apart (0 and 1); where both occur, only sets of different blocks are compared. Of links that
    join the same two groups the first is kept, so the result is smaller than the number of members.
    """
    node, side = frame["node"].to_numpy(np.int64), frame["side"].to_numpy()
    sizes = np.array([len(s) for s in frame["set"]])
    elements, flat = np.unique(np.concatenate([np.asarray(s, np.int64) for s in frame["set"]]), return_inverse=True)
    ends = np.cumsum(sizes)
    signatures = np.array(frame["sig"].tolist(), np.int32) if least else None
    label = np.unique(frame["root"].to_numpy(np.int64), return_inverse=True)[1]
    crossing = side.min() != side.max()
    a, b = [], []
    mark = np.zeros(len(elements), bool)
    for x in range(len(frame) - 1):
        other = np.arange(x + 1, len(frame))
        fit = (label[other] != label[x]) & (100 * np.minimum(sizes[other], sizes[x]) >= percent * np.maximum(sizes[other], sizes[x]))
        if crossing:
            fit &= side[other] != side[x]
        other = other[fit]
        if least and len(other):
            other = other[(signatures[other] == signatures[x]).sum(axis=1) >= least]
        if not len(other):
            continue
        own = flat[ends[x] - sizes[x] : ends[x]]
        mark[own] = True
        if len(other) * 8 < len(frame):
            common = np.array([mark[flat[ends[y] - sizes[y] : ends[y]]].sum() for y in other])
        else:
            common = np.add.reduceat(mark[flat], ends - sizes, dtype=np.int64)[other]
        mark[own] = False
        for y in other[100 * common >= percent * (sizes[x] + sizes[other] - common)]:
            if label[y] != label[x]:
                label[label == label[y]] = label[x]
                a.append(node[x])
                b.append(node[y])
    return np.array(a, np.int64), np.array(b, np.int64)


def linked(lists: DataFrame, sets: DataFrame, percent: int, least: int = 0) -> DataFrame:
    """Links (a, b) that connect all nodes that share a key and whose sets have the similarity, in percent.

    ``lists`` holds (key, node), ``sets`` one row (node, sig, set) of each node; sets are not empty. ``least`` places of the
    signatures must agree, 0: none is looked at. First all members of a key are compared with the member that has most keys.
    Keys whose members are then still of several groups are compared whole, in blocks of bounded size, a block or two in a
    task; lists of the same members count once. Only links leave a block, fewer than it has members, so a group of copies
    never yields its pairs, and none is left out.
    """
    keys = lists.groupBy("node").agg(F.count(F.lit(1)).alias("keys"))
    members = _kept(spread_join(lists, keys, "node"), "members")
    heads = members.groupBy("key").agg(F.max(F.struct("keys", "node")).alias("head"), F.count(F.lit(1)).alias("rows"))
    heads = heads.where("rows > 1").select("key", F.col("head.node").alias("a"))
    stars = spread_join(members, heads, "key").where("a <> node").select("a", F.col("node").alias("b")).distinct()
    stars = _kept(similar(stars, sets, percent, least), "stars")
    roots = components(stars).withColumnRenamed("node", "own")
    owned = members.join(roots, F.col("node") == F.col("own"), "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    owned = _kept(spread_join(owned, sets.select("node", F.size("set").alias("n")), "node"), "owned")
    spread = owned.groupBy("key").agg(
        F.min("root").alias("low"),
        F.max("root").alias("high"),
        F.sum("n").alias("total"),
        F.count(F.lit(1)).alias("rows"),
        F.bit_xor(F.xxhash64("node")).alias("print"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("second"),
    )
    apart = spread.where("low < high").groupBy("rows", "print", "second").agg(F.min("key").alias("key"), F.min("total").alias("total"))
    apart = apart.select("key", F.ceil(F.col("total") / BLOCK).alias("blocks"))
    dealt = spread_join(owned, apart, "key").withColumn("own", F.pmod(F.xxhash64("node", F.lit(2)), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"), "node", "root")
    full = spread_join(dealt, sets, "node")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        a, b = block_links(frame, percent, least)
        return pd.DataFrame({"a": a, "b": b})

    rest = full.groupBy("key", "i", "j").applyInPandas(run, "a long, b long")
    return stars.unionAll(_kept(rest, "rest"))
