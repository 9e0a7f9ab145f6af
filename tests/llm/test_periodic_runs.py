from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from corpus_tables import documents_of, messy  # noqa: F401

from resolvscope.llm import catalog
from resolvscope.llm import periodic_runs as runs


def brute(s, shortest=24, periods=3):
    """Every maximal stretch of every period, kept for its smallest one."""
    n, least = len(s), {}
    for q in range(1, n):
        i = 0
        while i + q < n:
            if s[i] != s[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and s[j] == s[j + q]:
                j += 1
            if j - i >= q:
                least.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted(((a, length, q) for (a, length), q in least.items() if length >= max(shortest, periods * q)), key=lambda r: (r[0], r[2]))


def samples():
    rng = random.Random(5)
    yield from ([], [1], [1] * 23, [1] * 24, [1] * 300, [1, 2] * 12, [1, 2, 3] * 8 + [1], list(range(100)))
    for k in range(150):
        s = [rng.randrange(rng.choice((1, 2, 3, 50))) for _ in range(rng.randrange(1, 60))]
        for _ in range(rng.randrange(4)):
            p = rng.randrange(1, 20)
            unit = [rng.randrange(rng.choice((2, 40))) for _ in range(p)]
            s += (unit * 12)[: rng.randrange(1, 8 * p + 30)] + [rng.randrange(50) for _ in range(rng.randrange(5))]
        yield s


def test_runs_as_by_brute_force():
    texts = [np.array(s, np.int64) for s in samples()]
    assert sum(len(brute(s)) for s in texts) > 100
    assert runs.find_runs(texts) == [brute(list(s)) for s in texts]
    assert [runs.find_runs([s])[0] for s in texts] == [brute(list(s)) for s in texts]
    assert runs.find_runs(texts, 6, 2) == [brute(list(s), 6, 2) for s in texts]
    assert runs.find_runs(texts, 10, 4) == [brute(list(s), 10, 4) for s in texts]


def test_long_runs_over_many_grid_blocks(monkeypatch):
    rng = random.Random(3)
    s = [rng.randrange(9) for _ in range(700)]
    s = np.array(s + s[:50] * 9 + s[50:1] + s * 4 + [1] * 3000)
    assert (0, 700) not in [r[:2] for r in runs.find_runs([s])[0]]
    whole = runs.find_runs([s])[0]
    assert {q for _, _, q in whole} >= {1, 50, 700}
    monkeypatch.setattr(runs, "GRID", 1000)
    assert runs.find_runs([s])[0] == whole


def test_extensions_are_exact():
    rng = np.random.default_rng(2)
    for size in (2, 3, 20):
        s = np.r_[rng.integers(0, size, 400), np.tile(rng.integers(0, size, 7), 30), size]
        levels = runs.recompress(s)
        assert len(levels[-1].symbols) == 1
        a, b = (x.ravel() for x in np.triu_indices(len(s), 1))
        got = runs.Extensions(levels).common(a, b)
        k = rng.integers(0, len(a), 4000)
        for i, j, n in zip(a[k], b[k], got[k], strict=True):
            m = 0
            while j + m < len(s) and s[i + m] == s[j + m]:
                m += 1
            assert m == n


def described(doc_id, text):
    words = runs.planted(doc_id, (text or "").encode().split())
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    found = brute([number[w] for w in words])
    dropped = {i for a, length, q in found for i in range(a + q, a + length)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    listed = "".join(f"{a},{length},{q}\n" for a, length, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    milli = best[0] if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(found), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_as_by_brute_force(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect() if len(r.text) < 9000]
    got = {r.doc_id: tuple(r) for r in catalog.op11_periodic_runs(spark, folder).collect()}
    want = [described(*d) for d in docs]
    assert sum(w[1] > 0 for w in want) >= 10
    assert all(got[w[0]] == w for w in want)


def test_cases(spark, messy, documents_of):
    docs = messy.unionAll(documents_of([(None, "a b " * 30), (77, "x " * 24), (77, "x " * 24), (78, "x " * 23)]))
    rows = runs.summarise(docs, None).collect()
    assert len(rows) == docs.count()
    got = {(r.doc_id, r.start, r.length, r.period, r.exponent_milli) for r in rows if r.n_runs}
    assert got == {(None, 0, 60, 2, 30000), (77, 0, 24, 1, 24000), (5, 0, 20000, 4, 5000000)}
    texts = {r.doc_id: r.text for r in runs.collapse(docs).collect()}
    assert texts[77] == "x" and texts[78] == " ".join("x" * 23) and texts[2] == "" and texts[5].startswith("alpha beta gamma delta released")
    assert runs.summarise(docs.limit(0)).count() == 0


@pytest.mark.parametrize("doc_id", [None, 3])
def test_planting_leaves_nothing_alone(doc_id):
    assert runs.planted(doc_id, []) == []
