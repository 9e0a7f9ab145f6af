"""Cases in which an operator did less than the whole job."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
from corpus_tables import documents_of, messy, shingles_of  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from resolvscope.llm import license_scan, neighbours, simhash, toxicity, url_filter


def test_pipeline_drops_copies_from_similarity_0_8_on(spark, documents_of, messy):
    rng = random.Random(4)
    rows = []
    for g in range(60):
        words = [f"w{rng.randrange(3000)}" for _ in range(100 + g)]
        rows.append((1000 + 10 * g, " ".join(words)))
        for c in range(1, 4):
            copy = list(words)
            for _ in range(c):
                copy[rng.randrange(len(words))] = f"x{rng.randrange(10**9)}"
            rows.append((1000 + 10 * g + c if c < 3 else None, " ".join(copy)))
    docs = messy.unionAll(documents_of(rows))
    held = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    sets = [shingles_of(t) for _, t in held]
    group = list(range(len(held)))
    planted = 0
    for i in range(len(held)):
        for j in range(i):
            union = len(sets[i] | sets[j])
            alike = len(sets[i] & sets[j]) / union if union else 1.0
            planted += 0.8 <= alike <= 0.95
            if alike >= 0.8 and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if x == high else x for x in group]
    assert planted > 100
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    got = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.select("doc_id").collect())
    ids = [min((d is None, d or 0) for (d, _), x in zip(held, group, strict=True) if x == g) for g in set(group)]
    assert got == sorted(ids)


def test_toxicity_cuts_no_marked_word_and_needs_none():
    rng = random.Random(2)
    plain = [f"plain{rng.randrange(400)}" for _ in range(4000)]
    marked = [f"grimble{i:05d}".translate(str.maketrans("0123456789", "abcdefghij")) for i in range(3000)]
    rows = [(" ".join(rng.sample(plain, 40) + marked[i * 10 : i * 10 + 10]) + ".", 1) for i in range(300)]
    rows += [(" ".join(rng.sample(plain, 40)) + ".", 0) for _ in range(300)]
    model = toxicity.fit(rows, 0.5)
    shuffled = sorted(rows)
    random.Random(7).shuffle(shuffled)
    learnt = {w.encode() for t, y in shuffled[::3] + shuffled[1::3] if y for w in t.rstrip(".").split() if w.startswith("grimble")}
    assert sum(len(w) + 2 for w in learnt) > toxicity.TOXIC_BYTES
    assert learnt <= set(model.toxic.split())
    # Digits have no word beginnings to tell the classes by.
    digits = [(" ".join(str(rng.randrange(100, 200) + 100 * y) for _ in range(60)), y) for y in (0, 1) for _ in range(100)]
    unmarked = toxicity.fit(digits, 0.5)
    assert unmarked.toxic
    meter = toxicity.Meter(unmarked)
    assert sum(meter.score(t) for t, y in digits if y) > sum(meter.score(t) for t, y in digits if not y) + 50


def test_url_features_read_whole_urls_and_every_suffix(spark):
    long = "http://a.s1.zz/?" + "a" * 300 + "".join(chr(33 + i % 90) for i in range(500)) + "\u00e9\U0001f600"
    urls = [f"http://h.s{i}.org/fr/x" for i in range(1100)] + [f"http://h.s{i}.org/fr/y" for i in range(1000)] + ["http://b.net/"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate([*urls, long])], "page_id long, url string")
    model = url_filter.train(pages)
    got = {r.url: r for r in url_filter.features(url_filter.judged(pages, url_filter.RULES), model.suffixes).collect()}
    assert len(got) == pages.count()
    counts = Counter(long)
    assert abs(got[long].entropy - sum(-n / len(long) * math.log2(n / len(long)) for n in counts.values())) < 1e-9
    assert (got[long].suffix_block, got[long].suffix_seen) == (0.5, 0.0)
    assert all(got[u].suffix_seen > 0 for u in urls)


def test_neighbours_of_repeated_ids(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 8)).astype(np.float32).astype(float)
    rows = [(i, v) for i, v in enumerate(x)]
    rows += [(0, x[0] + 1e-3 * rng.normal(size=8).astype(np.float32)) for _ in range(12)] + [(0, x[0])] * 12
    rows += [(7, x[0] + 1e-2 * rng.normal(size=8)) for _ in range(15)]
    rows = [(i, [float(a) for a in np.asarray(v, np.float32)]) for i, v in rows]
    got = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 100 == 0, share=2.0).toPandas()
    for q in (0, 100, 200):
        best = {}
        for _, a in (r for r in rows if r[0] == q):
            for i, b in rows:
                if i != q:
                    best[i] = min(best.get(i, math.inf), math.dist(a, b))
        own = got[got["query_id"] == q].sort_values("rank")
        assert list(own["vec_id"]) == sorted(best, key=lambda i: (best[i], i))[:10]
        assert np.allclose(own["score"], sorted(best.values())[:10], atol=1e-9)


def test_keep_one_tells_components_of_one_id_apart(spark, documents_of, messy):
    rng = random.Random(6)
    words = [[f"w{rng.randrange(5000)}" for _ in range(300)] for _ in range(3)]
    one, two, other = (" ".join(w) for w in words)
    near = next(t for t in (" ".join([*words[2][:i], "changed", *words[2][i + 1 :]]) for i in range(300)) if 1 <= (simhash.simhash(t) ^ simhash.simhash(other)).bit_count() <= 3)
    kept = simhash.keep_one(documents_of([(1, one), (1, two), (None, other), (None, near)])).collect()
    assert len(kept) == 3 and {one, two} < {r.text for r in kept}


def test_license_passages_back_to_back_are_spans_each(documents_of):
    notice = "licensed under the apache license version 2 0"
    cases = {1: [notice] * 1, 2: [notice] * 2, 3: [notice] * 3, 9: [notice] * 9}
    rows = {r.doc_id: r for r in license_scan.scan(documents_of([(i, "see " + " ".join(c)) for i, c in cases.items()])).collect()}
    for i, row in rows.items():
        assert [(s.first_word, s.last_word) for s in row.spans if s.label == "apache-notice"] == [(1 + 8 * j, 8 + 8 * j) for j in range(i)]
    # A template that repeats words itself has stray votes between its copies.
    own = license_scan.Template("own", "a b c d e x a b c d e y p q r s t u v w")
    row = license_scan.scan(documents_of([(1, " ".join([own.text] * 4))]), [own]).first()
    assert [(s.first_word, s.last_word) for s in row.spans] == [(20 * j, 20 * j + 19) for j in range(4)]
