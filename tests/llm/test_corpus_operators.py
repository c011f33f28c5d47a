"""SimHash, sketches, archives, classifier, mix, language model and pipeline against brute force."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from pcmarts.llm import common, ctw, mixing, queries, quality, simhash, sketch, warc

SMALL = "/root/testdata/sf0.001"


def plain_simhash(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(ids: list[int], prints: list[int], distance: int) -> list[int]:
    label = dict(enumerate(ids))
    changed = True
    while changed:
        changed = False
        for i, j in itertools.combinations(range(len(ids)), 2):
            if (prints[i] ^ prints[j]).bit_count() <= distance and label[i] != label[j]:
                label[i] = label[j] = min(label[i], label[j])
                changed = True
    return [label[i] for i in range(len(ids))]


@pytest.mark.parametrize("block", [simhash.HOT_BLOCK, 4])
def test_components_are_those_of_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "HOT_BLOCK", block)
    rng = random.Random(5)
    words = [f"w{k}" for k in range(500)]
    texts = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(400)]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 7)):
            base = base[:]
            base[rng.randrange(400)] = rng.choice(words)
            texts.append(" ".join(base))
    texts += [None, "", " \n", "one", "one two", "ONE two"]
    rng.shuffle(texts)
    docs = spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)], "doc_id long, text string, fp int")
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    prints = [plain_simhash(t) for t in texts]
    assert [got[k].fingerprint for k in range(len(texts))] == [format(p, "016x") for p in prints]
    assert [got[k].component_id for k in range(len(texts))] == plain_components(list(range(len(texts))), prints, 3)
    kept = [r.doc_id for r in simhash.keep_first(docs).collect()]
    assert sorted(kept) == sorted({r.component_id for r in got.values()})


@pytest.mark.parametrize("distance", [1, 2, 4])
def test_links_connect_all_within_the_distance(spark, distance):
    rng = random.Random(distance)
    prints = set()
    for _ in range(25):
        x = rng.getrandbits(64)
        for _ in range(6):
            prints.add(x)
            for _ in range(rng.randint(1, distance + 1)):
                x ^= 1 << rng.randrange(64)
    prints = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    roots = dict(simhash.components(simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"), distance)).collect())
    want = plain_components(prints, [p & (1 << 64) - 1 for p in prints], distance)
    assert [roots.get(p, p) for p in prints] == want


def test_simhash_rows(spark):
    rows = [(None, None), (5, ""), (5, ""), (4, "  \n"), (9, "a b"), (9, "A B"), (None, "zz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.Counter((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert got == {(None, 4): 1, (5, 4): 2, (4, 4): 1, (9, 9): 2, (None, None): 1}
    assert sorted((r.doc_id or 0, r.text) for r in simhash.keep_first(docs).collect()) in ([(0, "zz"), (4, "  \n"), (9, "A B")], [(0, "zz"), (4, "  \n"), (9, "a b")])
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_long_chain_of_links_is_one_component(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(300)], "a long, b long")
    assert {tuple(r) for r in simhash.components(edges).collect()} == {(k, 0) for k in range(1, 301)}


def exact_shingles(text: str) -> set[tuple[bytes, ...]]:
    words = text.encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_fingerprints_of_next_and_edited_texts(spark):
    rng = random.Random(8)
    words = [f"w{k}é" for k in range(3000)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice((0, 3, 30, 400, 2000)))) for _ in range(60)]
    rows = [(k * 7 % 61, t) for k, t in enumerate(texts)] + [(None, "n u l l"), (100, None), (30, "again")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, copy int")
    got = sketch.fingerprints(docs).collect()
    order = sorted(((-i if i is not None else math.inf, t or "", i) for i, t in rows))
    assert len(got) == len(rows)
    want = collections.Counter()
    for k, (_, text, i) in enumerate(order):
        after, third = order[(k + 1) % len(order)][1], len(text) // 3
        want[i, len(text), hashlib.sha256((text[: len(text) - third] + after[:third]).encode()).hexdigest()] += 1
    assert collections.Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    by_text = {r.fingerprint: r for r in got}
    for text in texts:
        assert sketch.written(sketch.sketch(text)) in by_text
    assert all(0 <= v <= 1 for r in got for v in (r.near_edited, r.near_next, r.contained_edited, r.contained_next))
    assert sketch.fingerprints(docs.limit(0)).count() == 0 and sketch.fingerprints(docs.where("doc_id = 100")).first().near_next == 1.0


def test_sketches_estimate_containment_and_merge():
    rng = random.Random(9)
    words = [f"x{k}" for k in range(10**6)]
    for share in (0.2, 0.5, 0.9):
        small = [rng.choice(words) for _ in range(3000)]
        cut = int(share * 3000)
        large = " ".join(small[:cut] + [rng.choice(words) for _ in range(40000)])
        a, b = exact_shingles(" ".join(small)), exact_shingles(large)
        near, within = sketch.likeness(sketch.sketch(" ".join(small)), sketch.sketch(large))
        assert abs(within - len(a & b) / len(a)) < 0.1 and abs(near - len(a & b) / len(a | b)) < 0.05
    one, two = "a b c d e f g h i j", "q r s t u v w x y z a b c d"
    merged = sketch.merged(sketch.written(sketch.sketch(one)), sketch.written(sketch.sketch(two)))
    parts = set(np.concatenate([sketch.sketch(one)[0], sketch.sketch(two)[0]]).tolist())
    assert merged == sketch.written((np.array(sorted(parts), np.uint64), min(sketch.sketch(one)[1], sketch.sketch(two)[1])))


def test_archives_round_trip(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 4000)
    monkeypatch.setattr(warc, "SAMPLE_BYTES", 3000)
    long = "<p>" + "long text é " * 30
    rows = [(k, f"http://h/é {k}", f"<p>page {k} " + "x" * (13 * k % 400)) for k in range(200)] + [(900, "u", long), (800, None, long), (850, "u", long), (None, "u", long), (300, "u", None), (301, "u", ""), (302, "u", "same"), (303, "u", "same"), (800, None, long)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, digest string").repartition(2)
    folder = f"file://{tmp_path}/warc"
    archives = warc.write(pages, folder)
    assert archives.count() > 4
    got = warc.read(archives, folder).collect()
    want = collections.Counter()
    for i, _, html in rows:
        data = (html or "").encode()
        again = html == long and i != 800
        want[i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", 800 if again else None, None if again else data] += 1
    assert collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got) == want
    name = archives.first().archive
    raw = open(f"{tmp_path}/warc/{name}", "rb").read()
    magic, size = int.from_bytes(raw[:4], "little"), int.from_bytes(raw[4:8], "little")
    words = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(raw[8 : 8 + size]))
    first = zstandard.ZstdDecompressor(dict_data=words).decompressobj()
    head = first.decompress(raw[8 + size :])
    assert magic == 0x184D2A5D and head.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") and first.unused_data  # one frame, one record
    empty = warc.write(pages.limit(0), folder)
    assert warc.read(empty, folder).count() == 0


def test_damaged_payload_is_found(spark, monkeypatch, tmp_path):
    pages = spark.createDataFrame([(1, "u", "x" * 200)], "page_id long, url string, html string")
    folder = f"file://{tmp_path}/bad"
    with monkeypatch.context() as m:
        m.setattr(warc, "page_record", lambda *a: warc.record("response", {"WARC-Record-ID": "<urn:page:1>", "WARC-Payload-Digest": "sha256:00", "X-Payload-Length": "1"}, b"\r\n\r\nx"))
        archives = warc.write(pages, folder)
    with pytest.raises(Exception, match="damaged"):
        warc.read(archives, folder).count()


def test_classifier_on_labels_it_has_not_seen(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    seen = labels.where("doc_id % 4 != 0")
    got = quality.classify(docs, seen, *queries.site()).join(labels.where("doc_id % 4 = 0"), "doc_id").toPandas()
    clean, bad = (got.quality == 1) & (got.toxic == 0), got.quality == 0
    assert len(got) > 80 and got.kept[clean].mean() > 0.97 and got.kept[bad].mean() < 0.4  # from 300 labelled texts


def test_classifier_rows(spark):
    rows = [(1, "good words here", "s", "en"), (1, "good words here", "s", "en"), (None, None, None, None), (2, "", "t", "fr"), (3, "bad bad ###", "s", "en")]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, source string, lang string, score double")
    labels = spark.createDataFrame([(1, 1, None), (3, 0, 0), (3, 1, 0), (None, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.classify(docs, labels, *queries.site()).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    silent = quality.classify(docs, labels.limit(0), *queries.site())
    assert silent.where("kept").count() == 5 and quality.classify(docs.limit(0), labels, *queries.site()).count() == 0
    assert quality.keep_good(docs, labels, *queries.site()).columns == docs.columns


def test_sparse_sites_shrink_to_the_global_rate(spark):
    rows = [("big", "big/a", 3.0)] * 400 + [("bad", "bad/a", -3.0)] * 400 + [("tiny", "tiny/a", -3.0)]
    scored = spark.createDataFrame(rows, "host string, path string, evidence double")
    rate = {r._host: r.path_rate for r in quality.posteriors(scored, 0.5).collect()}
    assert rate["big"] > 0.9 and rate["bad"] < 0.1 and 0.1 < rate["tiny"] < 0.5


def plain_targets(sizes: dict, weights=(1, 2, 3)) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    total, cut = sum(sizes.values()), set()
    while True:
        left, units = total - sum(3 * sizes[s] for s in cut), sum(weight[s] for s in names if s not in cut)
        more = {s for s in names if s not in cut and weight[s] * left > 3 * sizes[s] * units}
        if not more:
            return {s: 3.0 * sizes[s] if s in cut else weight[s] * left / units for s in names}
        cut |= more


def test_mix_meets_its_targets(spark):
    rng = random.Random(2)
    rows = [(k, rng.choice(["a", "b", "b", "b", "c", None, "é", "tiny"][: 7 + (k < 9)]), "w " * rng.randint(0, 60)) for k in range(1500)] + [(1500, "zero", None), (1500, "zero", "")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, source string, text string, size int")
    got = mixing.mix(docs, block_words=300).toPandas()
    assert len(got) == len(rows)
    sizes = collections.Counter()
    for _, s, t in rows:
        sizes[s] += len((t or "").split())
    want = plain_targets(sizes)
    got["taken"] = [s * len(d) for s, d in zip(got["size"], got.draws, strict=True)]
    taken = got.groupby("source", dropna=False).taken.sum()
    for s, target in want.items():
        mine = got[got.source.isna() if s is None else got.source == s]
        assert mine.target.iloc[0] == pytest.approx(target) and mine.source_size.iloc[0] == sizes[s]
        assert abs(taken[np.nan if s is None else s] - target) <= 10
    assert all(len(d) <= 3 and len({x["pass"] for x in d}) == len(d) for d in got.draws)
    again = mixing.mix(docs.repartition(3), block_words=300).toPandas()
    key = lambda f: sorted((int(i), sz, str(d)) for i, sz, d in zip(f.doc_id, f["size"], f.draws, strict=True))
    assert key(got) == key(again)
    assert mixing.mixed(docs, block_words=300).count() == sum(map(len, got.draws))
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mixed(docs.limit(0)).count() == 0


def test_split_tree_is_exact_and_hypergeometric(spark):
    quotas = {1: 500, 2: 0, 3: 37, 4: 1200}
    for levels in (4, 6):
        cells = mixing.split_tree(spark.createDataFrame(list(quotas.items()), "source_no int, quota long"), levels)
        got = cells.toPandas().pivot(index="shard", columns="source_no", values="n")
        assert len(got) == 2**levels and got.sum().to_dict() == quotas
        assert got.sum(axis=1).max() - got.sum(axis=1).min() <= levels
    places = mixing.places(cells).collect()
    assert sorted((r.source_no, r.at) for r in places) == [(s, k) for s, n in quotas.items() for k in range(n)]
    assert mixing.shard_levels(10) == 4 and mixing.shard_levels(10**12) == 15
    draws = spark.range(4000).select(mixing._hypergeometric(F.lit(50), F.lit(20), F.lit(10), (F.col("id") + 0.5) / 4000).alias("k")).groupBy("k").count().collect()
    for r in draws:
        exact = math.comb(20, r.k) * math.comb(30, 10 - r.k) / math.comb(50, 10)
        assert abs(r["count"] / 4000 - exact) <= 0.0005


def plain_ctw(train: list[bytes], ends: int, words: list[bytes]) -> tuple[list[float], float]:
    def events(word):
        past = b" "
        for b in word:
            context = past[::-1][: ctw.DEPTH]
            yield context[: context.find(b" ") + 1] if b" " in context else context, b
            past += bytes([b])

    nodes = collections.defaultdict(lambda: [0, 0])
    for context, b in itertools.chain(*(events(w + b" ") for w in train), [(b" ", 10)] * ends):
        for k in range(len(context) + 1):
            for j in range(8):
                nodes[context[:k], 1 << j | b >> 8 - j][b >> 7 - j & 1] += 1
    children = collections.defaultdict(list)
    for c, p in nodes:
        if c:
            children[c[:-1], p].append((c, p))
    kt = lambda n: math.lgamma(n[0] + 0.5) + math.lgamma(n[1] + 0.5) - math.lgamma(sum(n) + 1) - math.log(math.pi)

    def weighted(key):
        own = kt(nodes[key])
        if not children.get(key):
            return own, 1.0
        below = sum(weighted(c)[0] for c in children[key])
        total = np.logaddexp(own, below)
        return total - math.log(2), math.exp(own - total)

    def log10(context, b):
        out = 0.0
        for j in range(8):
            p, known, bit = 0.5, False, b >> 7 - j & 1
            for k in range(len(context), -1, -1):
                key = context[:k], 1 << j | b >> 8 - j
                if key in nodes:
                    q, w = (nodes[key][bit] + 0.5) / (sum(nodes[key]) + 1), weighted(key)[1]
                    p, known = (w * q + (1 - w) * p if known else q), True
            out += math.log10(p)
        return out

    return [sum(log10(c, b) for c, b in events(w + b" ")) for w in words], log10(b" ", 10)


@pytest.mark.parametrize("most", [3, 1 << 16])
def test_scores_are_those_of_plain_weighting(spark, monkeypatch, most):
    monkeypatch.setattr(ctw, "TOP_WORDS", most)  # with 3, nearly all words and grams are joined
    monkeypatch.setattr(ctw, "TOP_GRAMS", most)
    texts = ["the cat sat on The mat", "the cats sit at that hat é", None, "", "abc abcabcabcabc ab a", "zebra the cat", "thé q abcabc", "the the the", "the the the"]
    rows = [(k + 1, t) for k, t in enumerate(texts)] + [(None, "the null")]
    rows = [*rows, rows[-2]]
    docs = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, n long")
    aside = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    words = [w for i, t in rows if not aside(i) for w in (t or "").encode().lower().split()]
    ends = sum(not aside(i) for i, _ in rows)
    count, n, v = collections.Counter(words), len(words) + ends, len(set(words)) + 1
    lexicon = sorted({w for _, t in rows for w in (t or "").encode().lower().split()})
    logs, end = plain_ctw(words, ends, lexicon)
    logs = dict(zip(lexicon, logs, strict=True))
    base = lambda c: math.log10((c + 0.5) / (n + 0.5 * (v + 1)))
    want = []
    for i, t in rows:
        own = (t or "").encode().lower().split()
        want.append((str(i), aside(i), len(own) + 1, sum(count[w] > 0 for w in own) + 1, round(sum(base(count[w]) for w in own) + base(ends), 6), round(sum(logs[w] for w in own) + end, 6)))
    got = [(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in ctw.score(docs).collect()]
    assert any(aside(i) for i, _ in rows) and sorted(got) == sorted(want)
    assert ctw.score(docs.limit(0)).count() == 0


def test_model_predicts_a_distribution():
    gram, _ = ctw.grams_of([b"the", b"then", b"cat"])
    count = np.arange(1, len(gram) + 1)
    key, n = ctw.summed(gram, count.astype(float))
    levels = ctw.subtree(key, n)  # one group holds all here: roots are summed below
    low = levels[-1]
    import pandas as pd

    k, n0, n1, log = ctw.summed(ctw.parents(low.key), low.n0, low.n1, low.log)
    top = ctw.top_levels(pd.DataFrame({"key": k, "n0": n0, "n1": n1, "log": log}))
    for context in {int(g) >> 8 for g in key}:
        assert sum(10 ** ctw.log10_of(np.array([context << 8 | b for b in range(256)]), levels, top)) == pytest.approx(1)


def test_pipeline_stages(spark):
    docs, kept = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        kept.append(docs.toPandas())
        if name != "bpe":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            docs = spark.createDataFrame(kept[-1], docs.schema)
    judged, single, hidden, mix, coded = kept
    prints = [plain_simhash(t) for t in judged.text]
    assert sorted(single.doc_id) == sorted(set(plain_components(list(judged.doc_id), prints, 3)))
    assert sorted(hidden.doc_id) == sorted(single.doc_id) and not hidden.text.str.contains(r"[a-z0-9]@[a-z]").any()
    assert (hidden.text.str.len() == hidden.n_chars).all()
    assert set(mix.doc_id) <= set(hidden.doc_id) and mix.doc_id.value_counts().max() <= 3
    assert sorted(coded.doc_id) == sorted(mix.doc_id)
    assert corpus_pipeline.run(spark, SMALL).count() == len(coded)


def test_samples_are_the_least_hashes(spark):
    ids = spark.range(20000).withColumn("h", F.xxhash64("id"))
    want = [r.id for r in ids.orderBy("h").limit(300).collect()]
    assert [r.id for r in common.least_hash(ids, "id", 300).collect()] == want
    assert common.least_hash(ids.limit(10), "id", 300).count() == 10 and common.least_hash(ids.limit(0), "id", 3).count() == 0
