from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import sentencepiece
from corpus_tables import documents_of, messy  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from resolvscope.llm import catalog
from resolvscope.llm import token_alignment as alignment


def brute(rows):
    """The contract in plain Python, the first tokenizer by the library its file is made for."""
    a = Tokenizer.from_file(alignment.BYTE_VOCABULARY)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_MODEL)
    letters = alignment.byte_letters()
    held, links = [], Counter()
    for doc_id, text in rows:
        left = a.encode(" " + text, add_special_tokens=False).ids if text else []
        right = b.encode(text, num_threads=1) if text else []
        own = [bytes(letters[c] for c in a.id_to_token(i)) for i in left]
        other = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in right for p in [b.id_to_piece(i)]]
        raw = (" " + text).encode() if text else b""
        if b"".join(own) != raw or b"".join(other) != raw or not raw:
            held.append((doc_id, [], [], []))
            continue
        ends_a, ends_b = (np.cumsum([len(x) for x in s]).tolist() for s in (own, other))
        cuts = sorted(set(ends_a) & set(ends_b))
        pairs = [(left[ends_a.index(c)], right[ends_b.index(c)]) for c in cuts]
        groups, low = [], 0
        for c in cuts:
            one = ",".join(str(i) for i, e in zip(left, ends_a, strict=True) if low < e <= c)
            two = ",".join(str(i) for i, e in zip(right, ends_b, strict=True) if low < e <= c)
            groups.append(f"{one}|{two}")
            low = c
        links.update(pairs)
        held.append((doc_id, left, right, groups, pairs))
    best = Counter()
    for (_, y), n in links.items():
        best[y] = max(best[y], n)
    out = []
    for doc_id, left, right, groups, *rest in held:
        pairs = rest[0] if rest else []
        top = sum(links[p] == best[p[1]] for p in pairs)
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((doc_id, len(left), len(right), len(groups), len(pairs), top, sum(links[p] for p in pairs), sha))
    return sorted(out, key=repr)


def test_query_as_by_brute_force(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where(F.length("text") < 3000)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in catalog.op12_token_alignment(spark, str(tmp_path)).collect()), key=repr)
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert got == want and sum(w[5] < w[4] for w in want) > 20


def test_cases(messy, documents_of):
    odd = ["two  spaces", "▁mark", "tab\tand\r\nline", "<|endoftext|> <s> </s> <0x41>", " lead", "trail ", " x", "é ﬁ", "\U0001f600" * 9, "中文 text", "\x00\x01", "a" * 9000]
    docs = messy.unionAll(documents_of([(100 + i, t) for i, t in enumerate(odd)] + [(100, odd[0]), (None, "id less")]))
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect() if not r.text or len(r.text) < 30000]
    kept = docs.where("text is null or length(text) < 30000")
    assert sorted((tuple(r) for r in alignment.token_groups(kept).collect()), key=repr) == brute(rows)
    assert alignment.token_groups(docs).count() == docs.count()
    assert alignment.token_groups(docs.limit(0)).count() == 0


def test_both_ways_to_encode_agree():
    rng = random.Random(8)
    letters = "aeiou tnshr  'sdl\n\t.,!?0123456789ABCéßжя中文\U0001f600 ́_-#"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 200))) for _ in range(2000)]
    a = Tokenizer.from_file(alignment.BYTE_VOCABULARY)
    own = alignment.tokenizers(alignment.BYTE_VOCABULARY, alignment.PIECE_MODEL)
    assert [own.a.encode_ordinary(t) for t in texts] == [e.ids for e in a.encode_batch(texts, add_special_tokens=False)]


def test_pieces_find_what_the_whole_merge_does():
    rng = np.random.default_rng(1)
    for size in (0, 1, 5, 300):
        a, b = (np.unique(rng.integers(0, 2 * size + 2, size)) for _ in range(2))
        want = np.intersect1d(a, b)
        for piece in (1, 2, 3, 7, 1000):
            in_a, in_b = alignment.common_ends(a, b, piece)
            assert a[in_a].tolist() == b[in_b].tolist() == want.tolist()


def test_chunks_change_nothing(messy):
    few = alignment.aligned(messy, chunk_bytes=10)
    assert few.where("whole").count() > 4
    size = alignment.tokenizers(alignment.BYTE_VOCABULARY, alignment.PIECE_MODEL).size_b
    counts = [Counter(map(tuple, alignment.pair_counts(f, size).collect())) for f in (few, alignment.aligned(messy))]
    assert counts[0] == counts[1] and counts[0]
