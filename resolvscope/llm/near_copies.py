"""Near copies by shingle similarity: SimHash groups and banded minima propose candidates, true similarity decides."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resolvscope.llm import simhash
from resolvscope.llm.components import _kept, components, spread_join
from resolvscope.llm.similar import linked
from resolvscope.llm.text import digest, unused

SHINGLE = 5
SIMILARITY = 0.8
# Fingerprints of a text and minima in each: a pair of similarity 0.8 shares one but for (1 - 0.8 ** 6) ** 30 = 0.00011.
BANDS = 30
DEPTH = 6
# Shingle hashes whose minima are taken at a time.
CHUNK = 2048
_FACTORS, _SHIFTS = np.random.default_rng(17).integers(0, 1 << 32, (2, BANDS * DEPTH, 1), dtype=np.uint32)
_FACTORS = _FACTORS | np.uint32(1)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; a text of fewer words is one shingle, one without words has none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = map(b" ".join, zip(*[words[i:] for i in range(size)], strict=False)) if len(words) >= size else [b" ".join(words)]
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, joined), dtype=np.uint64))


def bands(hashes: np.ndarray) -> list[int]:
    """The fingerprints of a set of hashes, each told apart from those of other bands; an empty set has none."""
    if not len(hashes):
        return []
    low = hashes.astype(np.uint32)
    least = np.full(BANDS * DEPTH, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), CHUNK):
        np.minimum(least, (_FACTORS * low[None, i : i + CHUNK] + _SHIFTS).min(axis=1), out=least)
    rows = least.reshape(BANDS, DEPTH)
    return [xxhash.xxh64_intdigest(rows[i].tobytes(), i) - (1 << 63) for i in range(BANDS)]


def majority(hashes: np.ndarray) -> int:
    """SimHash of a set of hashes, as a signed long: a bit is set if over half the hashes set it."""
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def _fingerprints(documents: DataFrame, size: int) -> DataFrame:
    """(doc_id, digest, node, n, code, bands) of each row; node is a hash of the shingle set, n its size, code its SimHash."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sets = [shingles(t, size) for t in frame["text"]]
            nodes = [xxhash.xxh64_intdigest(s.tobytes()) - (1 << 63) for s in sets]
            out = {"doc_id": frame["doc_id"], "digest": frame["digest"], "node": nodes, "n": [len(s) for s in sets]}
            yield pd.DataFrame(out | {"code": [majority(s) for s in sets], "bands": [bands(s) for s in sets]})

    chosen = documents.select(F.col("doc_id").cast("long"), digest(F.col("text")).alias("digest"), "text")
    return chosen.mapInPandas(run, "doc_id long, digest long, node long, n long, code long, bands array<long>")


def _sets(documents: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(node, sig, set) of the nodes, made anew from one text of each; no signature is kept."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sets = [shingles(t, size).view(np.int64) for t in frame["text"]]
            yield pd.DataFrame({"node": frame["node"], "sig": [[] for _ in sets], "set": sets})

    wanted = nodes.select("node", F.col("first.doc_id").alias("k_id"), F.col("first.digest").alias("k_digest"))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), digest(F.col("text")).alias("digest"), "text")
    met = texts.join(wanted, (F.col("digest") == F.col("k_digest")) & F.col("doc_id").eqNullSafe(F.col("k_id"))).select("node", "text")
    return met.dropDuplicates(["node"]).mapInPandas(run, "node long, sig array<int>, set array<long>")


def near_copies(documents: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, digest, root) of each row; rows have one root if links of the similarity or more connect them.

    Similarity is that of the sets of word shingles (shared by all). Two sources propose candidates: the groups that SimHash
    fingerprints of the same shingles form within the radius of :mod:`simhash`, and the banded fingerprints. Texts that share
    either are compared by :func:`similar.linked`, so a group of copies never yields its pairs. Texts of one shingle set,
    those without words too, are one node. Rows without an id take part. An empty table gives no rows.
    """
    rows = _kept(_fingerprints(documents, shingle), "fingerprints")
    first = F.min(F.struct("doc_id", "digest")).alias("first")
    nodes = rows.where("n > 0").groupBy("node").agg(first, F.first("bands").alias("bands"), F.first("code").alias("code"))
    nodes = _kept(nodes, "nodes")
    close = components(simhash.links(nodes.select(F.col("code").alias("fingerprint")).distinct())).toDF("code", "code_root")
    grouped = nodes.select("node", "code").join(close, "code", "left").select(F.xxhash64(F.coalesce("code_root", "code"), F.lit("code")).alias("key"), "node")
    members = nodes.select(F.explode("bands").alias("key"), "node").unionAll(grouped)
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("key")
    members = _kept(spread_join(members, shared, "key"), "members")
    wanted = spread_join(nodes.select("node", "first"), members.select("node").distinct(), "node")
    sets = _kept(_sets(documents, wanted, shingle), "sets")
    roots = components(linked(members, sets, round(100 * similarity)))
    return spread_join(rows.select("doc_id", "digest", "node"), roots, "node", "left").select("doc_id", "digest", F.coalesce("root", "node").alias("root"))


def keep_one(documents: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE) -> DataFrame:
    """One row of each group of near copies: the one of the smallest id, of several the one of the smallest text digest.

    Rows without an id come last in their group. Rows that repeat id and text are one. Texts without words are copies of each
    other. All columns come back, whatever their names.
    """
    chosen = (
        near_copies(documents, similarity, shingle)
        .groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest")).alias("m"))
        .select("m.doc_id", "m.digest")
    )
    own, k_id, k_digest = (unused(documents, name) for name in ("own", "k_id", "k_digest"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(k_id)) & F.col(own).eqNullSafe(F.col(k_digest))
    joined = documents.withColumn(own, digest(F.col("text"))).join(chosen.toDF(k_id, k_digest), same)
    return joined.dropDuplicates([k_id, k_digest]).select(*[F.col(f"`{c}`") for c in documents.columns])
