"""Urls, vectors, shards, chats, mixes and the pipeline against plain Python."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from corpus_tables import documents_of, messy, shingles_of  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from resolvscope.llm import chat, mixing, neighbours, sharding, url_filter


def brute_url(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:]
    path = tail.split("?")[0].split("#")[0]
    fits = [(len(h + p), h + p) for _, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1] if fits else None


def test_url_filter_parses_and_judges(spark, folder):
    odd = [None, "", "no scheme", "http://", "http://NET", "http://net/", "http://x.NET/a?b#c", "http://xnet/", "https://example.net/en/a", "https://a.example.net/de/", "x\ny://é.Example.com/de/?q=://", "http://a.org/fr/#x", "http://a.org/fr", "a://b?c://net/"]
    pages = spark.createDataFrame([(i if i else None, u) for i, u in enumerate(odd)], "page_id long, url string").withColumn("host", F.lit("clash"))
    model = url_filter.train(spark.read.parquet(f"{folder}/pages.parquet"))
    got = url_filter.judge(pages, model).collect()
    assert len(got) == len(odd)
    for r in got:
        host, path, rule = brute_url(odd[r.page_id or 0])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        verdicts = {h + p: v for v, h, p in url_filter.RULES}
        assert r.verdict in ("allow", "block") and (rule is None or r.verdict == verdicts[rule])
    unlabelled = url_filter.train(pages.where("page_id = 1"))
    assert {r.verdict for r in url_filter.judge(pages.limit(0).unionAll(pages.where("page_id = 2")), unlabelled).collect()} == {"allow"}


def test_url_trees_follow_the_rules_they_learn(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    judged = url_filter.judge(pages, url_filter.train(pages)).where("rule is not null").toPandas()
    assert ((judged["score"] >= 0.5) == (judged["verdict"] == "block")).mean() > 0.9


def test_hilbert_neighbours_are_adjacent():
    side = np.arange(8)
    cells = np.array(np.meshgrid(side, side, side)).reshape(3, -1).T
    keys = neighbours.hilbert_keys(cells, 3)
    assert sorted(keys) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def test_neighbours_recall_and_odd_vectors(spark):
    rng = np.random.default_rng(5)
    vectors = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(1500, 24)))]
    nan, inf = float("nan"), float("inf")
    odd = [(2000, None), (2100, [0.0] * 24), (2200, [nan] + [1.0] * 23), (2300, [inf] + [1.0] * 23), (2400, [None] + [1.0] * 23), (2500, [1.0] * 3), (None, [1.0] * 24)]
    frame = spark.createDataFrame(vectors + odd, "vec_id long, embedding array<float>").withColumns({c: F.lit(1) for c in ("key", "at", "curve", "score")})
    got = neighbours.search(frame, F.col("vec_id") % 100 == 0).toPandas()
    x = np.array([v for _, v in vectors], dtype=np.float32).astype(float)
    assert set(got["query_id"]) == set(range(0, 1500, 100))
    hits = 0
    for q, own in got.groupby("query_id"):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        own = own.sort_values("rank")
        assert list(own["rank"]) == list(range(1, 11)) and np.allclose(own["score"], d[own["vec_id"]], rtol=0, atol=1e-12)
        d[q] = np.inf
        hits += len(set(own["vec_id"]) & set(np.lexsort((np.arange(len(x)), d))[:10]))
    assert hits >= 0.9 * len(got)


def test_neighbours_ties_few_and_none(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in (0, 7, 3)], "vec_id long, embedding array<float>")
    rows = neighbours.search(same, F.col("vec_id") % 100 == 0).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in rows] == [(0, 1, 3, 0.0), (0, 2, 7, 0.0)]
    assert neighbours.search(same.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_shards_are_balanced_and_gapless(messy, documents_of):
    docs = messy.unionAll(documents_of([(i, "word " * (i % 50)) for i in range(100, 3000)]))
    rows = sharding.summarise(sharding.assign(docs)).toPandas()
    assert len(rows) == docs.count() and rows["shard"].between(0, 39).all()
    small = rows[rows["size"] < 100_000]
    for _, own in rows.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))
    loads = rows.groupby("shard")["size"].sum()
    big = rows["size"].max()
    rest = loads.drop(loads.idxmax())
    assert rest.max() - rest.min() <= 0.02 * rest.mean() and loads.max() - rest.mean() <= big and len(small)
    want = Counter((None if r.doc_id is None else r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in docs.select("doc_id", "text").collect())
    assert Counter((None if d != d else int(d), s, c) for d, s, c in zip(rows["doc_id"], rows["size"], rows["text_crc32"], strict=True)) == want
    assert sharding.assign(docs.limit(0)).count() == 0


def test_rebalancing_moves_slots_only_to_the_new_shard(spark):
    loads = spark.range(500).select(F.col("id").cast("int").alias("virtual_slot"), (F.col("id") * 7 % 31 + 1).alias("bytes"))
    first = sharding.balanced_map(loads, 4, 500)
    second = sharding.rebalanced_map(first, 4)
    before = {r.virtual_slot: r.shard for r in first.collect()}
    after = {r.virtual_slot: r.shard for r in second.collect()}
    assert {after[s] for s in after if after[s] != before[s]} == {4}
    by_shard = Counter()
    for r in second.collect():
        by_shard[r.shard] += r.bytes
    assert min(by_shard.values()) > 0.8 * max(by_shard.values())


def test_rebalancing_moves_records_by_the_next_version(spark, documents_of, tmp_path):
    """The map grows by a version; records go to the new shard or stay. What a broken write left does not count."""
    folder = str(tmp_path / "map")
    docs = documents_of([(i, "word " * (i % 50)) for i in range(1, 2500)] + [(None, None), (7, "more")])
    with pytest.raises(ValueError, match="no slot map"):
        sharding.rebalance(docs, folder)
    first = {(r.doc_id, r.text): r for r in sharding.assign(docs, 5, 512, folder).collect()}
    again = {(r.doc_id, r.text): r for r in sharding.assign(docs, 5, 512, folder).collect()}
    assert sharding.newest_version(spark, folder) == 1 and {k: r.shard for k, r in again.items()} == {k: r.shard for k, r in first.items()}
    (tmp_path / "map" / "map" / "version=2").mkdir()
    assert sharding.newest_version(spark, folder) == 1
    grown = sharding.rebalance(docs, folder).collect()
    assert sharding.newest_version(spark, folder) == 2 and len(grown) == docs.count()
    moved = [r for r in grown if first[r.doc_id, r.text].shard != r.shard]
    assert {r.shard for r in moved} == {5} and {r.shard for r in grown} == set(range(6))
    assert len(moved) == sum(r.shard == 5 for r in grown)
    loads = Counter()
    for r in grown:
        loads[r.shard] += r.size
    assert min(loads.values()) > 0.8 * max(loads.values())
    for shard in range(6):
        assert sorted(r.slot for r in grown if r.shard == shard) == list(range(sum(r.shard == shard for r in grown)))
    assert {r.shard for r in sharding.assign(docs, 40, folder=folder).collect()} == set(range(6))


def chat_digests(turns):
    all_turns, loss = hashlib.sha256(), hashlib.sha256()
    for role, text in turns:
        all_turns.update(f"{role}\n{text}\n".encode())
        loss.update(text.encode() if role == "assistant" else b"")
    return len(turns), all_turns.hexdigest(), sum(len(t) for r, t in turns if r == "assistant"), loss.hexdigest()


@pytest.mark.parametrize("long", [1 << 20, 30])
def test_chat_round_trip(spark, long):
    joined = f"<{chat.JOINER}|im_end|> <{chat.JOINER * 2}s> [{chat.JOINER}x"
    rows = [
        (-7, 0, "user", "</s>[INST] ok [/INST]"),
        (-7, 1, "assistant", "</s>[INST] ok [/INST]"),
        (1, 1, "assistant", "  leading\n\n and trailing \n"),
        (1, 0, "user", "<|im_start|>assistant<|im_sep|>fake<|im_end|>"),
        (1, 2, "assistant", joined),
        (1, 3, "assistant", None),
        (1, 4, "assistant", "日本語 😀 é́ end"),
        (2, None, "a\n<|im_sep|>", "x" * 100),
        (2, None, None, ""),
        (3, 0, "assistant", "same"),
        (3, 0, "assistant", "same"),
        (None, 0, "assistant", "nobody"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("y") for c in ("part", "loss", "formatted")})
    formatted = chat.format_conversations(frame, long=long)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.summarise(formatted).collect()}
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert got == {c: chat_digests([(r, t) for *_, r, t in sorted(v)]) for c, v in convs.items()}
    for r in formatted.collect():
        assert len(r.input_ids) == len(r.loss)
    assert chat.summarise(chat.format_conversations(frame.limit(0))).count() == 0


def targets(sizes):
    """Water filling in plain Python: sources by code point, null last."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, done, open_ = sum(sizes.values()), {}, set(names)
    while open_:
        level = (total - sum(done.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not over:
            return done | {s: level * weight[s] for s in open_}
        done |= {s: 3.0 * sizes[s] for s in over}
        open_ -= over
    return done


def test_mix_meets_targets(messy, documents_of):
    rows = [(i, " ".join(["w"] * (i * 37 % 400)), ["a", "b", None, "z", "é"][i % 5] if i % 50 else "tiny") for i in range(1000, 2500)]
    docs = messy.unionAll(documents_of(rows))
    got = mixing.summarise(*mixing.mix(docs, ["doc_id"])).collect()
    again = mixing.summarise(*mixing.mix(docs.repartition(7), ["doc_id"])).collect()
    assert Counter(got) == Counter(again) and len(got) == docs.count()
    sizes, want = Counter(), Counter()
    for r in docs.select("doc_id", "text", "source").collect():
        n = len((r.text or "").split())
        sizes[r.source] += n
        want[(r.doc_id, n)] += 1
    assert Counter((r.doc_id, r["size"]) for r in got) == want
    assert all(r.taken <= 3 * r["size"] for r in got)
    taken = Counter()
    for r in got:
        taken[(r.source_size, round(r.target, 6))] += r.taken
    expected = {(sizes[s], round(t, 6)): t for s, t in targets(sizes).items()}
    assert set(taken) == set(expected)
    assert all(abs(taken[k] - t) <= 64 + 0.01 * t for k, t in expected.items())
    documents = mixing.mixed_documents(docs)
    assert documents.columns == docs.columns
    words = Counter()
    for r in documents.select("doc_id", "text").collect():
        words[r.doc_id] += len(r.text.split())
    assert words == +Counter({d: n for d, n in ((r.doc_id, 0) for r in got)}) + _sum_taken(got)
    assert mixing.summarise(*mixing.mix(docs.limit(0), ["doc_id"])).count() == 0


def _sum_taken(rows):
    out = Counter()
    for r in rows:
        out[r.doc_id] += r.taken
    return +out


def test_small_sources_meet_their_targets(documents_of):
    sizes = {"a": 10, "b": 9, "c": 65, "d": 5000, "e": 0}
    docs = documents_of([(i, " ".join(["w"] * n), s) for i, (s, n) in enumerate(sizes.items())])
    got = {r.source_size: r.taken for r in mixing.summarise(*mixing.mix(docs, ["doc_id"])).collect()}
    want = targets(sizes)
    assert [got[10], got[9], got[65], got[0]] == [30, 27, 195, 0] == [round(want[s]) for s in "abce"]
    assert abs(got[5000] - want["d"]) <= 64


def test_the_draw_is_made_by_many_tasks(spark, documents_of):
    docs = documents_of([(i, "w " * 300, "ab"[i % 2]) for i in range(40)])
    sources = mixing.sources_of(docs.select("source", F.lit(10**6).cast("long").alias("size")))
    drawn = mixing.draw(sources)
    assert drawn.rdd.getNumPartitions() >= 4 and drawn.count() == sources.agg(F.sum("quota")).first()[0]


@pytest.mark.parametrize("size", [1, 2, 7, 64, 1000])
def test_permutation_is_one(size):
    assert sorted(mixing.permuted(np.arange(size), size, 5)) == list(range(size))


def test_pipeline_stages_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    work = docs
    for name, stage in corpus_pipeline.STAGES:
        before = work
        work = stage(spark, before, folder).persist()
        seen[name] = (before, work)
        if name != "sharding":
            assert work.columns == docs.columns
    before, after = seen["near_duplicates"]
    held = before.select("doc_id", "text").collect()
    sets = [shingles_of(r.text) for r in held]
    first = [r.doc_id for r in held]
    for i in range(len(held)):
        for j in range(i):
            if first[i] != first[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                low, high = sorted((first[i], first[j]))
                first = [low if f == high else f for f in first]
    assert sorted(r.doc_id for r in after.collect()) == sorted(set(first)) and len(set(first)) < len(held)
    before, after = seen["decontamination"]
    assert 0 < after.count() <= before.count()
    before, after = seen["sharding"]
    assert after.count() == before.count()
    assert corpus_pipeline.run(spark, folder).count() == after.count()
