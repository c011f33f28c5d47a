"""The context tree sorts each depth once, and rows are summed where they meet."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from pcmarts.llm import ctw


def group(seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Grams of one subtree (the last two bytes are equal) with counts, a third of them 0."""
    draw = np.random.default_rng(seed)
    low = np.unique(draw.integers(0, 1 << 8 * (ctw.DEPTH - 2 + 1), 4000) & 0x0303030303 | 0x60)
    return (0x6520 << ctw.PART_SHIFT) | low, draw.integers(0, 3, len(low))


def top_of(low: ctw.Level) -> list[ctw.Level]:
    key, n0, n1, log = ctw.summed(ctw.parents(low.key), low.n0, low.n1, low.log)
    return ctw.top_levels(pd.DataFrame({"key": key, "n0": n0, "n1": n1, "log": log}))


def test_a_depth_is_sorted_once_and_not_for_each_decision(monkeypatch):
    gram, count = group()
    gram, count, sizes, unique = gram[count > 0], count[count > 0], [], np.unique
    monkeypatch.setattr(np, "unique", lambda x, *a, **k: sizes.append(np.size(x)) or unique(x, *a, **k))
    ctw.subtree(gram, count)
    assert len(gram) > 500 and max(sizes) == len(gram)  # it was eight times as many, at every depth


def test_untrained_grams_change_nothing():
    gram, count = group()
    trained = ctw.subtree(gram[count > 0], count[count > 0])
    top, whole = top_of(trained[-1]), ctw.subtree(gram, count)
    want = ctw.log10_of(gram, trained, top)
    assert 0 < (count == 0).sum() and ctw.log10_of(gram, whole, top) == pytest.approx(want)
    assert ctw.log10_of(gram, whole, top, made=True) == pytest.approx(want)
    plain = [math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi) for a, b in ((0, 0), (1, 0), (5000, 9000))]
    assert ctw.kt_log(np.array([0.0, 1, 5000]), np.array([0.0, 0, 9000])) == pytest.approx(plain, abs=1e-9)


def test_words_are_those_of_bytes_split():
    texts = [" The\tcat\n\x0b\x0c\rSAT ", "", None, " \n ", "É é x\x1cy\x85Z  ", "a", "  two  words"]
    want = [(t or "").encode().lower().split() for t in texts]
    words, size, plain = ctw._split(pa.array(texts))
    assert words.to_pylist() == [w for x in want for w in x] and size.tolist() == [len(x) for x in want]
    assert plain.to_pylist() == [b"".join(w + b" " for w in x) for x in want]
    rows = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(len(texts)))], ["text", "k"])
    for most in (1, 20, 1 << 20):
        got = [x for part in ctw._portions(iter([rows.slice(0, 0), rows, rows]), most) for x in zip(*(c.to_pylist() for c in part), strict=True)]
        assert got == [*zip(texts, range(len(texts)), strict=True)] * 2


def test_sums_of_tasks_are_not_summed_again_before_the_shuffle(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "b")], "doc_id long, text string")
    for rows in (ctw.lexicon(docs), ctw.text_grams(docs)):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        assert plan.index("HashAggregate") < plan.rindex("HashAggregate") < plan.index("Exchange hashpartitioning")


def test_without_training_documents_a_decision_has_one_half(spark, monkeypatch):
    monkeypatch.setattr(ctw, "HELD_WORDS", 2)
    monkeypatch.setattr(ctw, "TOP_WORDS", 1)
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 1][:3]
    docs = spark.createDataFrame([(i, "ab c\tab  c d e f") for i in ids], "doc_id long, text string")
    for r in ctw.score(docs, across=True).collect():
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.n_bytes) == (True, 8, 0, 0, 17)
        assert r.score == pytest.approx(17 * 8 * np.log10(0.5))
