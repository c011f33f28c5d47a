"""Contexts over the spaces, against a plain context tree."""

from __future__ import annotations

import collections
import math
import zlib

import numpy as np
import pytest

from pcmarts.llm import ctw


def events(text: str | None):
    past = b"\n" * (ctw.DEPTH - 1) + b" "
    for b in b"".join(w + b" " for w in (text or "").encode().lower().split()) + b"\n":
        yield past[::-1][: ctw.DEPTH], b
        past += bytes([b])


def plain_scores(train: list[str | None], texts: list[str | None]) -> list[float]:
    nodes, children = collections.defaultdict(lambda: [0, 0]), collections.defaultdict(set)
    for text in train:
        for context, b in events(text):
            for k in range(len(context) + 1):
                for j in range(8):
                    key = context[:k], 1 << j | b >> 8 - j
                    nodes[key][b >> 7 - j & 1] += 1
                    if k:
                        children[context[: k - 1], key[1]].add(key)
    memo: dict = {}

    def weighted(key):
        if key not in memo:
            n = nodes[key]
            own = math.lgamma(n[0] + 0.5) + math.lgamma(n[1] + 0.5) - math.lgamma(sum(n) + 1) - math.log(math.pi)
            if key in children:
                total = np.logaddexp(own, sum(weighted(c)[0] for c in children[key]))
                memo[key] = total - math.log(2), math.exp(own - total)
            else:
                memo[key] = own, 1.0
        return memo[key]

    def log10(context, b):
        out = 0.0
        for j in range(8):
            p, known = 0.5, False
            for k in range(len(context), -1, -1):
                key = context[:k], 1 << j | b >> 8 - j
                if key in nodes:
                    q, w = (nodes[key][b >> 7 - j & 1] + 0.5) / (sum(nodes[key]) + 1), weighted(key)[1]
                    p, known = (w * q + (1 - w) * p if known else q), True
            out += math.log10(p)
        return out

    return [sum(log10(c, b) for c, b in events(t)) for t in texts]


@pytest.mark.parametrize(("most", "piece"), [(3, 1 << 22), (1 << 21, 1 << 22), (40, 7)])
def test_scores_across_words(spark, monkeypatch, most, piece):
    monkeypatch.setattr(ctw, "TOP_CONTEXTS", most)
    monkeypatch.setattr(ctw, "PIECE", piece)  # with 7, texts are cut within words and START
    monkeypatch.setattr(ctw, "HELD_GRAMS", 60 if piece == 7 else 1 << 21)
    texts = ["a b a b a b a c", "of the cat of the hat", "the of cat the of hat", None, "", "new york new york é", "york new new york é", "of the cat", "é"] * 2
    docs = spark.createDataFrame([*enumerate(texts, 1), (None, "new york")], "doc_id long, text string").repartition(3)
    rows = [*enumerate(texts, 1), (None, "new york")]
    aside = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    assert 2 < sum(aside(i) for i, _ in rows) < len(rows)
    want = plain_scores([t for i, t in rows if not aside(i)], [t for _, t in rows])
    got = ctw.score(docs, across=True).collect()
    assert sorted((str(r.doc_id), round(r.score, 6)) for r in got) == sorted((str(i), round(w, 6)) for (i, _), w in zip(rows, want, strict=True))
    by_word = {str(r.doc_id): r for r in ctw.score(docs).collect()}
    for r in got:
        same = by_word[str(r.doc_id)]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.n_bytes) == (same.held_out, same.n_tokens, same.n_known, same.train_tokens, same.n_bytes)
        assert r.base_score == pytest.approx(same.base_score)
    assert ctw.score(docs.limit(0), across=True).count() == 0


def test_the_query_tells_a_text_from_its_words_shuffled(spark, tmp_path):
    from pcmarts.llm import queries

    rows = [(k, "the old dog of the small town " * 4) for k in range(40)] + [(900, "the old dog of the small town"), (901, "of the the town old small dog")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.score for r in queries.model_scores(spark, str(tmp_path)).collect()}
    assert got[900] > got[901] + 1
