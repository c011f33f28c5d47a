"""Hard negatives, MinHash components and Merkle proofs against brute force."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pcmarts.llm import merkle, minhash, negatives

# Hard negatives


def plain_negatives(rows: list[tuple]) -> list[tuple]:
    """Rows (vec_id, label, vector); a row is itself by its place in the list."""
    usable = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (anchor, label, v) in enumerate(usable):
        if anchor is None or anchor % 50:
            continue
        met = [(-sum(x * y for x, y in zip(v, w, strict=False)), math.inf if i is None else i, other == label) for k, (i, other, w) in enumerate(usable) if k != at]
        met.sort(key=lambda m: m[:2])
        for score, i, _ in [m for m in met if m[2]][:5]:
            for rank, (below, j, _) in enumerate([m for m in met if not m[2] and 50 * -score <= 100 * -m[0] <= 95 * -score][:3], 1):
                out.append((anchor, None if i == math.inf else i, rank, None if j == math.inf else j, -score, -below))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [negatives.BLOCK_ROWS, 16])
def test_negatives_are_those_of_all_scores(spark, monkeypatch, block):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(negatives, "TILE", 7)
    monkeypatch.setattr(negatives, "ANCHORS_AT_ONCE", 2)
    rng = random.Random(1)
    rows = [(25 * k, rng.choice([0, 0, 0, 1, 2]), [rng.choice([-0.5, 0.25, 0.5, 0.3]) for _ in range(4)]) for k in range(60)]
    rows += [rows[4]] * 3 + [rows[8]] + [(None, 0, [0.5] * 4), (None, 1, [0.4] * 4), (300, 0, [0.5]), (350, 1, []), (400, 2, [0.5] * 6)]
    rows += [(450, None, [0.1] * 4), (500, 1, None), (550, 1, [0.1, None]), (600, 1, [0.1, math.nan]), (650, 1, [math.inf] * 4), (700, 9, [0.5] * 4)]
    data = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<double>, row string, score int")
    found = negatives.mine(data, F.col("id") % 50 == 0)
    got = sorted(map(tuple, found.collect()), key=repr)
    assert got == plain_negatives(rows) and len({g[0] for g in got}) > 20
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert negatives.mine(data.limit(0), F.col("id") % 50 == 0).count() == 0


def test_scores_beyond_64_bits_are_ranked(spark):
    rows = [(50, 0, [1e12, 0.0]), (1, 0, [1e12, 5.0]), (2, 1, [6e11, 3.0]), (3, 1, [9e11, 1.0]), (4, 1, [9.6e11, 1.0]), (100, 0, [3e7, 1.0])]
    got = negatives.mine(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"), F.col("id") % 50 == 0).collect()
    assert [(r.positive_id, r.negative_id, r.positive_score) for r in got if r.anchor_id == 50 and r.positive_id == 1] == [(1, 3, None), (1, 2, None)]
    assert [(r.positive_id, r.negative_id, r.negative_score) for r in got if r.anchor_id == 100 and r.positive_id == 50] == [(50, 3, None), (50, 2, None)]


@pytest.mark.parametrize("span", [3, 300, 1 << 20, 1 << 40])
def test_packed_products_are_exact(span):
    rng = np.random.default_rng(2)
    a, b = rng.integers(-span, span, (9, 65)), rng.integers(-span, 2 * span, (101, 65))
    assert (negatives.scores(a, b) == a.astype(object) @ b.T.astype(object)).all()
    wide, fields, _ = negatives.packed(np.full((101, 65), 320), 320)
    assert wide.dtype == np.float64 and fields == 2 and len(wide) == 51


# MinHash


def plain_sets(texts: list[str | None]) -> list[frozenset]:
    out = []
    for t in texts:
        words = (t or "").encode().lower().split()
        out.append(frozenset(tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))) if words else frozenset())
    return out


def plain_components(ids: list, sets: list[frozenset]) -> list:
    parent = list(range(len(ids)))

    def top(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(ids)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
            parent[top(i)] = top(j)
    groups = collections.defaultdict(list)
    for i in range(len(ids)):
        groups[top(i)].append(i)
    return [min((ids[j] for j in groups[top(i)] if ids[j] is not None), default=None) for i in range(len(ids))]


@pytest.mark.parametrize("block", [minhash.BLOCK_ROWS, 3])
def test_minhash_components_are_those_of_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK_ROWS", block)
    rng = random.Random(3)
    words = [f"Wört{k}" for k in range(400)]
    texts: list[str | None] = []
    for _ in range(10):
        base = [rng.choice(words) for _ in range(rng.choice([60, 200, 1500]))]
        texts += [" ".join(base), " ".join(base).replace("W", "w").replace(" ", "\n ")]
        for _ in range(rng.randint(0, 14)):  # each edit of one word takes three shingles
            copy = base[:]
            for at in rng.sample(range(len(copy)), max(1, round(len(copy) * rng.choice([0.01, 0.02, 0.026, 0.03, 0.05])))):
                copy[at] = rng.choice(words)
            texts.append(" ".join(copy))
    texts += [None, "", " \n\t", "one", "ONE", "one two", "a b c d e f g h i", " ".join(words * 40)]
    order = rng.sample(range(len(texts)), len(texts))
    rows = [(i, texts[k]) for i, k in enumerate(order)] + [(None, texts[0]), (None, "alone here"), (5, texts[order[5]]), (5, "another text of the same id")]
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in rows], "doc_id long, text string, node string, key int")
    sets = plain_sets([t for _, t in rows])
    want = plain_components([i for i, _ in rows], sets)
    # Documents without words link with nothing; the plain rule gives each of them a component of its own.
    want = sorted(((i, len(s), c, i == c) for (i, _), s, c in zip(rows, sets, want, strict=True)), key=repr)
    found = minhash.near_duplicates(docs)
    assert sorted(map(tuple, found.collect()), key=repr) == want
    assert 20 < sum(not w[3] for w in want) < len(want) - 20
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_chain_of_one_group_is_found_over_blocks(spark, monkeypatch):
    """Neighbours in a chain of edits link, the ends do not; with blocks of two rows most links lie between blocks."""
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 2)
    words = [f"w{k}" for k in range(230)]
    texts = [" ".join(words[3 * k : 3 * k + 110]) for k in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = plain_sets(texts)
    assert 100 * len(sets[0] & sets[1]) >= 85 * len(sets[0] | sets[1]) and not sets[0] & sets[-1]
    assert {(r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()} == {(0, True), (0, False)}


def test_bayesian_bounds():
    """The posterior of m equal minima of n, by numeric integration; the bound passes pairs of the similarity asked for."""
    grid = (np.arange(200_000) + 0.5) / 200_000
    for n, m in zip(range(minhash.BATCH, minhash.SIZE + 1, minhash.BATCH), minhash.least_equal(), strict=True):
        tail = lambda k: (density := grid**k * (1 - grid) ** (n - k))[grid >= 0.85].sum() / density.sum()  # noqa: B023, E731
        assert tail(m) >= minhash.MISS > tail(m - 1)
    assert (1 - 0.85**minhash.ROWS) ** minhash.BANDS < 1e-6


# Merkle


def H(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(nodes: list[str]) -> tuple[str, list[list[tuple[list[str], list[str]]]]]:
    """(top, for each node the siblings to its left and right, level by level)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            run = nodes[k - k % 8 : k - k % 8 + 8]
            paths[i].append((run[: k % 8], run[k % 8 + 1 :]))
        nodes, at = [H(*nodes[k : k + 8]) for k in range(0, len(nodes), 8)], [k // 8 for k in at]
    return nodes[0], paths


def plain_manifest(rows: list[tuple]) -> list[tuple]:
    def leaf(values):
        return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    trees = collections.defaultdict(list)
    for r in rows:
        trees[r[2]].append(r)
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    done = {}
    for lang in langs:
        trees[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        done[lang] = plain_tree([leaf(r) for r in trees[lang]])
    root, ways = plain_tree([done[x][0] for x in langs])
    out = []
    for lang, way in zip(langs, ways, strict=True):
        for r, path in zip(trees[lang], done[lang][1], strict=True):
            node = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                node = leaf((*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])))
            for lhs, rhs in path + way:
                node = H(*lhs, node, *rhs)
            out.append((r[0], leaf(r), done[lang][0], root, H(*(x for lhs, rhs in path + way for x in lhs + rhs)), node, node == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("depth", [1, 2, merkle.DEPTH])
def test_manifest_is_the_plain_tree(spark, monkeypatch, depth):
    monkeypatch.setattr(merkle, "DEPTH", depth)
    monkeypatch.setattr(merkle, "SPAN", 8**depth)
    rng = random.Random(4)
    langs = ["en"] * 20 + ["de", "é", "~", "", None] + [f"l{k}" for k in range(15)]
    rows = [(k * 7 - 100, rng.choice(["s", None]), rng.choice(langs), rng.randrange(9), rng.choice(["Text É", "low", "", None]) and f"T{k}") for k in range(700)]
    rows += [rows[3]] * 20 + [(None, None, None, None, None)] * 2 + [(2**60 + 1, "a", None, 1, "X")] + [(5, "a", "alone", 1, "X"), (6, "a", "pair", 1, None), (6, "b", "pair", 1, "long " * 30000)]
    docs = spark.createDataFrame([(*r, "n", 1) for r in rows], "doc_id long, source string, lang string, n_chars int, text string, node string, pos int")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.leaf(*fields, lowered))
    found = merkle.manifest(docs, F.col("doc_id"), F.col("lang"), merkle.leaf(*fields, F.col("text")), tampered).collect()
    got = [(r.id, r.leaf, r.subroot, r.root, H(r.proof), r.folded_root, r.folded_root == r.root) for r in found]
    assert sorted(got, key=repr) == plain_manifest(rows)
    assert all(merkle.fold(r.leaf, r.proof, r.places) == r.root for r in found)
    assert merkle.manifest(docs.limit(0), F.col("doc_id"), F.col("lang"), merkle.leaf(*fields)).count() == 0


def test_manifest_of_one_row(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, lang string")
    (r,) = merkle.manifest(docs, F.col("doc_id"), F.col("lang"), merkle.leaf(F.col("doc_id"))).collect()
    assert (r.leaf, r.subroot, r.root, r.proof, r.folded_root) == (H("1:1"), H("1:1"), H("1:1"), "", H("1:1"))
