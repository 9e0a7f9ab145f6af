"""Operators over documents against plain Python."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest
from corpus_tables import documents_of, messy  # noqa: F401

from resolvscope.llm import decontaminate, license_scan, secret_scan, simhash, toxicity
from resolvscope.llm.text import WORD, lower_ascii

PHRASES = {"mit": ["mit", "license"], "apache": ["apache", "license"], "gpl": ["general", "public", "license"]}


def base_places(text):
    words = WORD.findall(lower_ascii(text))
    hits = [(i, n) for n, p in PHRASES.items() for i in range(len(words)) if words[i : i + len(p)] == p]
    starts = [i for i, _ in hits]
    return len(words), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({n for _, n in hits}))


def test_license_scan_matches_brute_force(messy, documents_of):
    more = documents_of([(10, "GNU General Public License, the MIT license; mit  LICENSE apache-license"), (11, "general public"), (12, "license mit")])
    docs = messy.unionAll(more)
    got = license_scan.summarise(license_scan.scan(docs)).collect()
    want = Counter((r.doc_id, *base_places(r.text)) for r in docs.select("doc_id", "text").collect())
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == want
    assert all(0 <= r.score <= 1 for r in got)


def test_license_text_with_a_gap_is_one_passage(documents_of):
    words = license_scan.TEXTS[6].text.split()
    text = "some words before " + " ".join(words[:40] + ["inserted", "words"] + words[40:]) + " and after"
    row = license_scan.scan(documents_of([(1, text)])).first()
    found = [s for s in row.spans if s.label == "mit-text"]
    assert len(found) == 1 and found[0].first_word == 3
    assert found[0].last_word == 3 + len(WORD.findall(lower_ascii(" ".join(words)))) + 1
    assert license_scan.scan(documents_of([(1, " ".join(words[:10]))])).first().spans == []


def secrets_of(text):
    out = []
    for place, rule in enumerate(secret_scan.BASE_RULES):
        out += [(m.start(), place, m.end(), rule.kind) for m in re.finditer(rule.pattern, text or "", re.ASCII) if len(m[rule.group]) >= rule.least]
    return sorted(out)


def test_secret_scan_matches_brute_force(messy, documents_of):
    more = documents_of(
        [
            (20, "secret=token: abcdefgh and token=token=abcdef"),
            (21, "PASSWORD: 'hunter22' passwd=abc api-key=nope apikey = \"ABCDEF/+=\" Api_Key:xyzxyz"),
            (22, "😀 AKIA" + "A1" * 8 + " AKIAAB AKIA" + "Z" * 40 + " deadbeef" * 3 + " " + "0a" * 12),
            (23, "é" * 10 + "f" * 24 + "g" + "f" * 23 + "g" + "0" * 60),
        ]
    )
    docs = messy.unionAll(more)
    got = secret_scan.summarise(secret_scan.scan(docs)).collect()
    assert len(got) == docs.count()
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        spans = secrets_of(r.text)
        line = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
        counts = Counter(k for *_, k in spans)
        want[(r.doc_id, counts["assign"], counts["access"], counts["hex"], hashlib.sha256(line.encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == want


def test_secret_scan_adds_kinds(documents_of):
    docs = documents_of([(1, "key ghp_" + "a1B2" * 9 + " end"), (2, "-----BEGIN RSA PRIVATE KEY-----"), (3, "Authorization: Bearer abcdefgh.ijk")])
    kinds = {r.doc_id: [s.kind for s in r.spans] for r in secret_scan.scan(docs).collect()}
    assert kinds == {1: ["github"], 2: ["private"], 3: ["bearer"]}


@pytest.mark.parametrize("rule", secret_scan.BASE_RULES + secret_scan.MORE_RULES, ids=lambda r: r.kind)
def test_trigram_query_is_necessary(rule):
    samples = {
        "assign": ["Password=abcdef", "api_key : 'abcdef'", "APIKEY=abcdef", "toKen\"=\"abcdef"],
        "access": ["AKIA" + "A" * 16],
        "hex": ["0" * 24],
        "private": ["-----BEGIN PRIVATE KEY-----", "-----BEGIN EC PRIVATE KEY-----"],
        "github": ["gho_" + "a" * 36],
        "slack": ["xoxb-1234567890"],
        "google": ["AIza" + "b" * 35],
        "stripe": ["sk_live_" + "1" * 16],
        "jwt": ["eyJabcdefgh.eyJabcdefgh.abcdefgh"],
        "bearer": ["authorization:bearer abcdefgh"],
    }[rule.kind]
    query = secret_scan.trigram_query(rule.pattern)
    for text in samples:
        assert re.search(rule.pattern, text)
        assert all(any(all(g in text.lower() for g in branch) for branch in clause) for clause in query)


def brute_components(rows):
    codes = [simhash.simhash(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= 3:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    named = {}
    for (doc, _), x in zip(rows, label, strict=True):
        if doc is not None:
            named[x] = min(named.get(x, doc), doc)
    return Counter((doc, f"{c:016x}", named.get(x)) for (doc, _), c, x in zip(rows, codes, label, strict=True))


def test_simhash_matches_brute_force(messy, documents_of):
    base = " ".join(f"word{i} thing{i % 7}" for i in range(300))
    near = [(100 + i, base.replace(f"word{i} ", f"other{i} ")) for i in range(12)] + [(90, base), (91, base), (92, "A b C"), (93, "a B c"), (94, "x y")]
    docs = messy.unionAll(documents_of(near))
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = simhash.summarise(simhash.near_duplicates(docs)).collect()
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == brute_components(rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({(c, f if c is None else "") for (_, f, c) in brute_components(rows)})


def test_forest_links_reach_what_brute_force_reaches():
    import numpy as np

    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    codes = np.unique(np.array([c ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, 3, False))) for c in centres for _ in range(60)], dtype=np.uint64))
    rng.shuffle(codes)
    tree = np.sort(rng.integers(0, 3, len(codes)))
    a, b = simhash.forest_links(codes, tree, 3)
    parent = {int(c): int(c) for c in codes}
    parent.update({int(x): int(y) for x, y in zip(a, b, strict=True)})
    for t in range(3):
        own = codes[tree == t]
        label = np.arange(len(own))
        for i in range(len(own)):
            for j in np.flatnonzero(np.bitwise_count(own ^ own[i]) <= 3):
                if label[i] != label[j]:
                    label[label == max(label[i], label[j])] = min(label[i], label[j])
        roots = [parent[int(c)] for c in own]
        assert all((roots[i] == roots[j]) == (label[i] == label[j]) for i in range(len(own)) for j in range(i))


def brute_leaks(text, items, window=10):
    words = WORD.findall(lower_ascii(text))
    hit, names = set(), set()
    for name, item in items:
        w = WORD.findall(lower_ascii(item))
        for i in range(max(1, len(w) - window + 1)) if w else ():
            part = w[i : i + window]
            for j in range(len(words) - len(part) + 1):
                if words[j : j + len(part)] == part:
                    hit.update(range(j, j + len(part)))
                    names.add(name)
    return len(words), len(hit), ",".join(sorted(names))


@pytest.mark.parametrize("part_bytes", [1 << 20, 40])
def test_leaks_match_brute_force(spark, messy, documents_of, part_bytes):
    item = "one two three four five six seven eight nine ten eleven twelve"
    items = [("1", item), ("2", "Mit-License"), ("3", ""), ("4", None), ("10", item.upper()), ("null", "straße 😀 mit")]
    bench = spark.createDataFrame([(None if n == "null" else int(n), t) for n, t in items], "item_id long, text string")
    more = [(50, "x " + item + " y two three four five six seven eight nine ten eleven z"), (51, item[:40]), (52, "ones " + item[4:])]
    docs = messy.unionAll(documents_of(more))
    found = decontaminate.scan(docs, bench, part_bytes=part_bytes)
    got = Counter((r.doc_id, r.leaks.n_words, r.leaks.n_hit, ",".join(r.leaks.items)) for r in found.collect())
    assert got == Counter((r.doc_id, *brute_leaks(r.text, items)) for r in docs.select("doc_id", "text").collect())
    spans = {r.doc_id: [r.text[s.start : s.end] for s in r.leaks.spans] for r in found.collect() if r.doc_id == 50}
    assert spans[50][0] == item
    assert decontaminate.clean(docs, bench).columns == docs.columns


def test_toxicity_learns_and_bears_odd_rows(spark, documents_of, messy):
    import random

    rng = random.Random(1)
    plain = [f"plain{rng.randrange(400)}" for _ in range(4000)]
    rows, labels = [], []
    for i in range(400):
        words = rng.sample(plain, 60)
        if i % 4 == 0:
            words[rng.randrange(60)] = "grimblewort" + rng.choice("abcdef")
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 4 == 0)))
    docs = documents_of(rows)
    marks = spark.createDataFrame(labels + [(None, 1, 1), (9999, 1, None), (7, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, marks)
    scored = toxicity.summarise(toxicity.score(docs, model)).collect()
    wrong = [r for r in scored if r.held_out and r.predicted != (r.doc_id % 4 == 0)]
    assert len(wrong) <= 0.1 * sum(r.held_out for r in scored)
    odd = toxicity.score(messy, model).collect()
    assert len(odd) == messy.count() and all(0 <= r.toxicity <= 1 for r in odd)
    nothing = toxicity.train(docs, marks.limit(0))
    assert {r.toxicity for r in toxicity.score(docs, nothing).collect()} == {0.0}
    assert toxicity.clean(messy, model).columns == messy.columns


def test_empty_documents_give_no_rows(spark, messy):
    none = messy.where("doc_id = -1")
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert license_scan.summarise(license_scan.scan(none)).count() == 0
    assert secret_scan.summarise(secret_scan.scan(none)).count() == 0
    assert simhash.summarise(simhash.near_duplicates(none)).count() == 0
    assert simhash.keep_one(none).count() == 0
    assert decontaminate.summarise(decontaminate.scan(none, bench)).count() == 0
    assert decontaminate.summarise(decontaminate.scan(messy, bench.limit(0))).where("contaminated").count() == 0
