from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pandas as pd
from corpus_tables import documents_of, messy, shingles_of  # noqa: F401

from resolvscope.llm import catalog, minhash, similar
from resolvscope.llm.components import components


def brute(rows, percent=85):
    sets = [shingles_of(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and group[i] != group[j]:
                common = len(sets[i] & sets[j])
                if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                    group = [group[j] if g == group[i] else g for g in group]
    out = []
    for (doc_id, _), own, g in zip(rows, sets, group, strict=True):
        ids = [d for (d, _), x in zip(rows, group, strict=True) if x == g and d is not None] if own else [doc_id]
        least = min(ids, default=None) if own else doc_id
        out.append((doc_id, len(own), least, doc_id == least))
    return sorted(out, key=repr)


def copies(rng, groups=25, members=12):
    rows = []
    for g in range(groups):
        words = [f"w{rng.randrange(900)}" for _ in range(60 + 8 * g)]
        for c in range(members):
            copy = list(words)
            for _ in range(c % 6):
                copy[rng.randrange(len(words))] = f"x{rng.randrange(60)}"
            # No group has its unedited text.
            if c:
                rows.append((1000 + 20 * g + c, " ".join(copy)))
    return rows


def test_query_as_by_brute_force(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in catalog.op13_minhash(spark, folder).collect()), key=repr)
    assert got == brute(rows) and any(not r[3] for r in got)


def test_components_as_by_brute_force(messy, documents_of):
    docs = messy.unionAll(documents_of(copies(random.Random(6)) + [(7, "four words only here"), (8, "Four words ONLY here"), (9, "one"), (None, "one")]))
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    for percent in (85, 80, 60):
        assert sorted((tuple(r) for r in minhash.near_duplicates(docs, percent).collect()), key=repr) == brute(rows, percent)
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_crowded_keys_are_compared_whole(spark, monkeypatch):
    """One key for all sets, no pivot near them all, blocks of a few members: every link must come out."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 60, 100)
    rows = []
    for i in range(120):
        own = base.copy()
        own[rng.choice(100, i % 9, replace=False)] = rng.integers(0, 1 << 60, i % 9)
        rows.append((i, [], sorted(own.tolist())))
    monkeypatch.setattr(similar, "BLOCK", 900)
    sets = spark.createDataFrame(rows, "node long, sig array<int>, set array<long>")
    lists = sets.selectExpr("1L as key", "node").unionAll(sets.selectExpr("node % 2 + 2 as key", "node"))
    found = similar.linked(lists, sets, 85)
    links = found.collect()
    held = [set(r[2]) for r in rows]
    assert all(100 * len(held[a] & held[b]) >= 85 * len(held[a] | held[b]) for a, b in links)
    group = list(range(120))
    for i in range(120):
        for j in range(i):
            if 100 * len(held[i] & held[j]) >= 85 * len(held[i] | held[j]):
                group = [group[j] if g == group[i] else g for g in group]
    got = {r.node: r.root for r in components(found).collect()}
    assert Counter(group.count(g) for g in group) == Counter(Counter(got.get(i, i) for i in range(120))[got.get(i, i)] for i in range(120))
    assert len(links) < 2000


def test_blocks_return_a_forest():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 60, 50)
    frame = pd.DataFrame({"node": range(40), "side": 0, "root": range(40), "sig": [np.zeros(1, np.int32)] * 40, "set": [np.sort(base)] * 40})
    a, b = similar.block_links(frame, 85, 1)
    assert len(a) == 39


def test_threshold_keeps_pairs_of_just_the_similarity():
    t = minhash.match_threshold(64, 85)
    draws = np.random.default_rng(1).binomial(64, 0.85, 1_000_000)
    assert (draws < t).mean() < 1e-5 and 30 < t < 54
