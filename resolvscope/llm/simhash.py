"""Near duplicates by SimHash fingerprints and BK-trees."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resolvscope.llm.components import _kept, components, spread_join
from resolvscope.llm.text import digest

RADIUS = 3
# Shingle hashes that are turned into bits at a time.
CHUNK = 1 << 16
# Frontier entries that a tree search expands at a time.
FRONTIER = 1 << 20


def simhash(text: str | None, shingle: int = 3) -> int:
    """Fingerprint of a text: a bit is set if over half the shingle hashes set it. No words: zero."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, dtype=np.int64)
    hashed = xxhash.xxh64_intdigest
    for low in range(0, n, CHUNK):
        part = words[low : min(low + CHUNK, n) + shingle - 1]
        joined = map(b" ".join, zip(*[part[i:] for i in range(shingle)], strict=False)) if len(part) >= shingle else [b" ".join(part)]
        hashes = np.fromiter((hashed(s, 42) for s in joined), dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, digest, fingerprint) of each row, the fingerprint's 64 bits in a signed long; texts stay in their batch."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            codes = np.array([simhash(t, shingle) for t in frame["text"]], dtype=np.uint64)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "digest": frame["digest"], "fingerprint": codes.view(np.int64)})

    chosen = documents.select(F.col("doc_id").cast("long"), digest(F.col("text")).alias("digest"), "text")
    return chosen.mapInPandas(run, "doc_id long, digest long, fingerprint long")


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


def forest_links(codes: np.ndarray, tree: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within each tree of distinct codes: for every node the smallest code it reaches in its tree, if another one.

    ``tree`` numbers the trees and is sorted. All trees are BK-trees grown level by level: a node's children are keyed by
    their distance to it. Each code then walks its tree and follows only the edges whose distance differs from its own to
    the parent by the radius at most.
    """
    n = len(codes)
    index = np.arange(n)
    first = np.r_[True, tree[1:] != tree[:-1]] if n else np.zeros(0, bool)
    root = np.maximum.accumulate(np.where(first, index, 0)) if n else index
    edge_keys, edge_nodes = [], []
    at, rest = root[~first], index[~first]
    while len(rest):
        keys = at * 65 + _distances(codes[rest], codes[at])
        found, place, back = np.unique(keys, return_index=True, return_inverse=True)
        edge_keys.append(found)
        edge_nodes.append(rest[place])
        child = rest[place][back]
        keep = child != rest
        at, rest = child[keep], rest[keep]
    if not edge_keys:
        return codes[:0], codes[:0]
    keys, nodes = np.concatenate(edge_keys), np.concatenate(edge_nodes)
    order = np.argsort(keys)
    keys, nodes = keys[order], nodes[order]
    label = index.copy()

    def top(x: np.ndarray) -> np.ndarray:
        while True:
            y = label[x]
            if np.array_equal(x, y):
                return x
            x = y

    several = np.flatnonzero(np.bincount(root, minlength=n)[root] > 1)
    stack = [(several[i : i + FRONTIER], root[several[i : i + FRONTIER]]) for i in range(0, len(several), FRONTIER)]
    while stack:
        asks, sees = stack.pop()
        d = _distances(codes[asks], codes[sees])
        near = (d <= radius) & (asks != sees)
        a, b = asks[near], sees[near]
        while len(a):
            a, b = top(a), top(b)
            differ = a != b
            a, b = a[differ], b[differ]
            low, high = np.minimum(a, b), np.maximum(a, b)
            # Of several links of one root the last written wins; the others are tried again.
            label[high] = low
        low = np.searchsorted(keys, sees * 65 + np.maximum(d - radius, 1))
        high = np.searchsorted(keys, sees * 65 + np.minimum(d + radius, 64), side="right")
        size = high - low
        some = size > 0
        asks, low, size = asks[some], low[some], size[some]
        ends = np.cumsum(size)
        start = 0
        while start < len(asks):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + FRONTIER, side="right")))
            s = size[start:stop]
            step = np.arange(int(s.sum())) - np.repeat(np.cumsum(s) - s, s)
            stack.append((np.repeat(asks[start:stop], s), nodes[np.repeat(low[start:stop], s) + step]))
            start = stop
    final = top(index)
    differ = final != index
    return codes[differ], codes[final[differ]]


def _blocks(radius: int) -> list[list[int]]:
    """Masks of the pigeonhole tables: 64 bits in radius + 3 blocks, of which any pair within the radius shares three."""
    n = radius + 3
    edges = [64 * i // n for i in range(n + 1)]
    masks = [((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in range(n)]
    return [sum(masks[i] for i in chosen) for chosen in combinations(range(n), 3)]


def links(codes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (column ``fingerprint``) within the radius, without all pairs.

    Fingerprints within the radius agree on three of ``radius + 3`` bit blocks. For each choice of three, codes that share
    them form a shard with a BK-tree of its own; the shards reach their tasks by the shuffle. Codes of a shard that link,
    directly or through others, are returned as links to the smallest place among them, so a group never yields its pairs.
    """
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in _blocks(radius)]
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fingerprint").bitwiseAND(F.lit(m).cast("long")).alias("value")) for i, m in enumerate(signed)])
    shards = codes.select("fingerprint", F.explode(tables).alias("s")).select("fingerprint", F.xxhash64("s.t", "s.value").alias("tree"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def linked(tree: np.ndarray, code: np.ndarray) -> pd.DataFrame:
            a, b = forest_links(code.view(np.uint64), tree, radius)
            return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

        tree, code = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for frame in frames:
            tree = np.concatenate([tree, frame["tree"].to_numpy(np.int64)])
            code = np.concatenate([code, frame["fingerprint"].to_numpy(np.int64)])
            # The last tree may go on in the next batch.
            cut = int(np.searchsorted(tree, tree[-1])) if len(tree) else 0
            if cut:
                yield linked(tree[:cut], code[:cut])
                tree, code = tree[cut:], code[cut:]
        yield linked(tree, code)

    return shards.repartition("tree").sortWithinPartitions("tree").mapInPandas(run, "a long, b long")


def near_duplicates(documents: DataFrame, radius: int = RADIUS, shingle: int = 3) -> DataFrame:
    """(doc_id, digest, fingerprint, component_id, root) of each row; component_id is the smallest doc_id reachable by links.

    ``root`` is the component's smallest fingerprint as a signed long, which no other component has.

    Fingerprints that are equal are one node, so copies cost nothing further. Null and empty texts have fingerprint zero and
    link like others. Rows without an id take part; their component is the smallest id there is in it, null if none.
    Repeated rows come back as often. Columns other than ``doc_id`` and ``text`` are ignored.
    """
    rows = _kept(fingerprints(documents, shingle), "fingerprints")
    codes = _kept(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "codes")
    roots = components(links(codes.select("fingerprint"), radius))
    owned = codes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    owned = _kept(owned, "owned")
    least = owned.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = _kept(spread_join(owned, least, "root").select("fingerprint", "component_id", "root"), "components")
    return rows.join(named, "fingerprint").select("doc_id", "digest", "fingerprint", "component_id", "root")


def keep_one(documents: DataFrame, radius: int = RADIUS, shingle: int = 3) -> DataFrame:
    """One row of each component: the one of the smallest id, of several the one of the smallest text digest."""
    chosen = (
        near_duplicates(documents, radius, shingle)
        .groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest")).alias("m"))
        .select(F.col("m.doc_id").alias("k_id"), F.col("m.digest").alias("k_digest"))
    )
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("k_id")) & (F.col("__digest") == F.col("k_digest"))
    joined = documents.withColumn("__digest", digest(F.col("text"))).join(chosen, same)
    return joined.dropDuplicates(["k_id", "k_digest"]).select(*[F.col(c) for c in documents.columns])


def summarise(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
