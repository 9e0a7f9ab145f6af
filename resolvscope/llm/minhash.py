"""Near duplicates by MinHash: an inverted join over signature coordinates, counted collisions, and true similarity."""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resolvscope.llm.components import _kept, components, spread_join
from resolvscope.llm.near_copies import shingles
from resolvscope.llm.similar import linked
from resolvscope.llm.text import digest

SHINGLE = 5
PERCENT = 85
COORDINATES = 64
# Chance that a pair of just the similarity agrees in fewer coordinates than the threshold.
MISSED = 1e-6
# Shingle hashes whose minima are taken at a time.
CHUNK = 4096
_FACTORS, _SHIFTS = np.random.default_rng(29).integers(0, 1 << 32, (2, 1024, 1), dtype=np.uint32)
_FACTORS = _FACTORS | np.uint32(1)


def signature(hashes: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """The smallest value of a set under each of the hash functions, at most 1,024 of them."""
    low = hashes.astype(np.uint32)
    least = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), CHUNK):
        np.minimum(least, (_FACTORS[:coordinates] * low[None, i : i + CHUNK] + _SHIFTS[:coordinates]).min(axis=1), out=least)
    return least.view(np.int32)


def match_threshold(coordinates: int, percent: int, missed: float = MISSED) -> int:
    """The most matches that a pair of the similarity fails to reach with a chance of ``missed`` at most."""
    p, below = percent / 100, 0.0
    for t in range(coordinates + 1):
        below += comb(coordinates, t) * p**t * (1 - p) ** (coordinates - t)
        if below > missed:
            return max(t, 1)
    return coordinates


def signatures(documents: DataFrame, shingle: int, coordinates: int) -> DataFrame:
    """(doc_id, digest, node, n, sig) of each row; node is a hash of the shingle set, null for an empty one."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sets = [shingles(t, shingle) for t in frame["text"]]
            nodes = [xxhash.xxh64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None for s in sets]
            out = {"doc_id": frame["doc_id"], "digest": frame["digest"], "node": pd.array(nodes, "Int64"), "n": [len(s) for s in sets]}
            yield pd.DataFrame(out | {"sig": [signature(s, coordinates) for s in sets]})

    chosen = documents.select(F.col("doc_id").cast("long"), digest(F.col("text")).alias("digest"), "text")
    return chosen.mapInPandas(run, "doc_id long, digest long, node long, n long, sig array<int>")


def posting_prefixes(nodes: DataFrame, least: int) -> DataFrame:
    """(key, node): every node posted under the rarest of its coordinate-value pairs that other nodes have too.

    A pair that nobody shares can match nothing and is skipped. Of a node's m shared pairs a partner with ``least`` matches
    has one among any m - least + 1, so the rarest ones are enough; a node with m < least has no partner. Keys that lists of
    one member are left with go too.
    """
    key = F.shiftleft(F.col("at").cast("long"), 32) + F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
    postings = nodes.select("node", F.posexplode("sig").alias("at", "value")).select("node", key.alias("key"))
    counts = postings.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    shared = spread_join(postings, counts, "key").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("rows", "key"))).alias("shared"))
    prefix = F.slice("shared", 1, F.size("shared") - least + 1)
    posted = _kept(shared.where(F.size("shared") >= least).select("node", F.explode(prefix).alias("p")).select("p.key", "node"), "posted")
    several = posted.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("key")
    return _kept(spread_join(posted, several, "key"), "lists")


def shingle_sets(documents: DataFrame, nodes: DataFrame, shingle: int, coordinates: int) -> DataFrame:
    """(node, sig, set) of the nodes, made from one text of each: that of the row ``first`` (doc_id, digest)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sets = [shingles(t, shingle) for t in frame["text"]]
            yield pd.DataFrame({"node": frame["node"], "sig": [signature(s, coordinates) for s in sets], "set": [s.view(np.int64) for s in sets]})

    wanted = nodes.select("node", F.col("first.doc_id").alias("k_id"), F.col("first.digest").alias("k_digest"))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), digest(F.col("text")).alias("digest"), "text")
    met = texts.join(wanted, (F.col("digest") == F.col("k_digest")) & F.col("doc_id").eqNullSafe(F.col("k_id"))).select("node", "text")
    return met.dropDuplicates(["node"]).mapInPandas(run, "node long, sig array<int>, set array<long>")


def near_duplicates(documents: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, coordinates: int = COORDINATES) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row; component_id is the smallest doc_id reachable by links.

    Two rows link if their sets of word shingles have the similarity, in percent; a text of fewer words is one shingle. Nodes
    are distinct sets, so copies cost nothing further. Candidates agree in the threshold of signature coordinates, which
    a pair of just the similarity fails with a chance of ``MISSED`` at most; links are confirmed on the full sets.

    Null texts and texts without words have no shingles, link with nothing and are kept. Rows without an id take part: their
    component is the smallest id there is in it, null if none; they are kept if that is null. Repeated rows come back as
    often. Columns other than ``doc_id`` and ``text`` are ignored. An empty table gives no rows.
    """
    rows = _kept(signatures(documents, shingle, coordinates), "signatures")
    first = F.min(F.struct("doc_id", "digest")).alias("first")
    nodes = _kept(rows.where("n > 0").groupBy("node").agg(first, F.first("sig").alias("sig"), F.min("doc_id").alias("first_id")), "nodes")
    least = match_threshold(coordinates, percent)
    lists = posting_prefixes(nodes.select("node", "sig"), least)
    wanted = spread_join(nodes.select("node", "first"), lists.select("node").distinct(), "node")
    sets = _kept(shingle_sets(documents, wanted, shingle, coordinates), "sets")
    roots = components(linked(lists, sets, percent, least))
    owned = nodes.select("node", "first_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    owned = _kept(owned, "owned")
    named = spread_join(owned, owned.groupBy("root").agg(F.min("first_id").alias("component_id")), "root").select("node", "component_id")
    return (
        spread_join(rows.select("doc_id", "node", F.col("n").alias("n_shingles")), named, "node", "left")
        .withColumn("component_id", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")))
        .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
    )
