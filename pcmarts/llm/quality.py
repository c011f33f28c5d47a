"""Quality classifier with hierarchical empirical Bayes: document evidence combined with host and path posteriors.

1. Evidence. Two logistic heads (low quality, toxic) on hashed words, hashed beginnings of words and a few shares, trained in one task from a
   bounded sample: the TRAIN_ROWS labelled documents with the least hash of their id. All tasks hash the texts; that one gets bucket
   numbers, and the driver only the weights. A document's evidence is the log odds of being good (neither), less the log odds in the training sample.
2. Hierarchy. Each document's probability under the global prior is summed by host and path (grouped, with partial sums, so a hot host
   is a few rows). The global rate, the spread between hosts and the spread between paths of a host are estimated from these sums by
   moments; a host's rate is its sum shrunk to the global rate, a path's rate shrunk to its host's, each by the weight that its spread
   allows. A document of a sparse site is thus judged by the global prior.
3. Verdict. Evidence plus the log odds of the path's rate; a document is kept from THRESHOLD on. Site rates are held in RATES, so a
   site can move a verdict but a clean document on a bad site keeps its own evidence.

Null texts count as empty; null hosts and paths are a site of their own. A document is a row: repeated rows each count. Without labels
of both kinds a head stays silent (evidence 0); a null label is no label. A document with several labels: the worst holds.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pcmarts.llm.common import least_hash, saved, with_identity

TRAIN_ROWS, BUCKETS, THRESHOLD, RATES = 16000, 1 << 18, 0.5, (0.2, 0.98)
EPOCHS, STEPS, RATE, DECAY, BATCH, SEED = 10, 1000, 0.3, 1e-4, 48, 11
DENSE, PREFIXES, CACHE, ROWS_READ = 6, (4, 5), 1 << 17, 500
DENSE_SCALE, MIN_TEXTS = 4.0, 4  # words that fewer texts of the sample have get no weight


_buckets: dict[str, tuple[int, ...]] = {}


def _of_word(word: str) -> tuple[int, ...]:
    """Buckets of a word and of the first bytes of it: lower case, without punctuation around."""
    stem = word.strip(".,;:!?()[]{}\"'").lower().encode("utf-8", "surrogatepass")
    found = (zlib.crc32(stem) % BUCKETS, *(zlib.crc32(stem[:k], k) % BUCKETS for k in PREFIXES if len(stem) > k))
    if len(_buckets) < CACHE:
        _buckets[word] = found
    return found


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's distinct words and of their beginnings, and shares of odd characters and words."""
    words = (text or "").split()
    if not words:
        return np.zeros(0, np.int32), np.array([0.0] * (DENSE - 1) + [1.0], np.float32)
    distinct, n, get = set(words), len(words), _buckets.get
    buckets = np.unique(np.fromiter(chain.from_iterable([get(w) or _of_word(w) for w in distinct]), np.int32))
    odd = min(1.0, sum(map(text.count, "#*$%&!")) / n / 2)
    dense = [odd, min(1.0, text.count("|") / n), sum(map(str.isupper, distinct)) / len(distinct), max(0.0, 1 - len(distinct) / n**0.85), min(1.0, len(text) / n / 20)]
    return buckets, np.array([DENSE_SCALE * d for d in dense] + [1.0], np.float32)


class Head:
    """A logistic model on presence of buckets and on the dense shares."""

    def __init__(self) -> None:
        self.w, self.d = np.zeros(BUCKETS, np.float32), np.zeros(DENSE, np.float32)

    def margin(self, buckets: list[np.ndarray], dense: np.ndarray) -> np.ndarray:
        sizes = np.array([len(b) for b in buckets])
        flat = np.concatenate([*buckets, np.zeros(0, np.int32)]).astype(np.int64)
        sums = np.bincount(np.repeat(np.arange(len(buckets)), sizes), self.w[flat], len(buckets))
        return sums + dense @ self.d

    def fit(self, buckets: list[np.ndarray], dense: np.ndarray, y: np.ndarray) -> Head:
        """Adagrad over shuffled batches, EPOCHS times over the rows and STEPS batches at least; a fixed seed, so reruns agree."""
        if not 0 < y.sum() < len(y):
            return self
        count = np.zeros(BUCKETS, np.int32)
        for b in buckets:  # distinct within a text
            count[b] += 1
        common = count >= MIN_TEXTS
        buckets = [b[common[b]] for b in buckets]
        rng, gw, gd = np.random.default_rng(SEED), np.full(BUCKETS, 1e-2, np.float32), np.full(DENSE, 1e-2, np.float32)
        self.d[-1] = math.log(y.mean() / (1 - y.mean()))
        for _ in range(max(EPOCHS, STEPS * BATCH // len(y))):
            order = rng.permutation(len(y))
            for at in range(0, len(y), BATCH):
                rows = order[at : at + BATCH]
                part = [buckets[i] for i in rows]
                error = (1 / (1 + np.exp(-np.clip(self.margin(part, dense[rows]), -30, 30))) - y[rows]).astype(np.float32)
                flat = np.concatenate([*part, np.zeros(0, np.int32)]).astype(np.int64)
                used, at_used = np.unique(flat, return_inverse=True)
                g = np.bincount(at_used, np.repeat(error, [len(b) for b in part]), len(used)).astype(np.float32) / len(rows) + DECAY * self.w[used]
                gw[used] += g * g
                self.w[used] -= RATE * g / np.sqrt(gw[used])
                g = error @ dense[rows] / len(rows)
                gd += g * g
                self.d -= RATE * g / np.sqrt(gd)
        return self


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[Head, Head, float]:
    """(low-quality head, toxic head, share of good documents), from at most `rows` labelled documents with the least hash of the id."""
    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    picked = least_hash(marks.select(F.col("doc_id").alias("_id"), "quality", "toxic"), "_id", rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "quality", "toxic")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in (b.iloc[k : k + ROWS_READ] for b in batches for k in range(0, len(b), ROWS_READ)):
            found = [features(t) for t in x["text"]]
            yield pd.DataFrame({"doc_id": x["doc_id"], "quality": x["quality"], "toxic": x["toxic"], "buckets": [b.tobytes() for b, _ in found], "dense": [d.tobytes() for _, d in found]})

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = pa.Table.from_batches(batches, pa.schema(shown)).combine_chunks()
        if not got.num_rows:
            return
        column = got["buckets"].chunk(0)
        ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset :][: len(column) + 1]
        flat = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        buckets = [flat[a:b].view(np.int32) for a, b in zip(ends, ends[1:], strict=False)]  # no copies
        dense = np.stack([np.frombuffer(d, np.float32) for d in got["dense"].to_pylist()])
        bad, toxic = ((got[c].to_numpy() == mark).astype(float) for c, mark in (("quality", 0), ("toxic", 1)))
        heads = [Head().fit(buckets, dense, y) for y in (bad, toxic)]
        weights = [pa.array([x.tobytes()], pa.binary()) for h in heads for x in (h.w, h.d)]
        yield pa.RecordBatch.from_arrays([*weights, pa.array([float(((bad == 0) & (toxic == 0)).mean())])], ["w0", "d0", "w1", "d1", "good"])

    shown = [("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32()), ("buckets", pa.binary()), ("dense", pa.binary())]
    taken = sample.mapInPandas(run, "doc_id long, quality int, toxic int, buckets binary, dense binary").dropDuplicates(["doc_id"])
    one = taken.repartition(1).sortWithinPartitions("doc_id")  # at most `rows` rows
    found = one.mapInArrow(fit, "w0 binary, d0 binary, w1 binary, d1 binary, good double").first()
    if found is None:
        return Head(), Head(), 0.5
    heads = [Head(), Head()]
    for k, head in enumerate(heads):
        head.w, head.d = np.frombuffer(found[f"w{k}"], np.float32), np.frombuffer(found[f"d{k}"], np.float32)
    return heads[0], heads[1], min(max(found["good"], 0.01), 0.99)


def with_evidence(docs: DataFrame, model: tuple[Head, Head, float]) -> DataFrame:
    """docs with p_bad, p_toxic and evidence: log odds of being good less the log odds of the training sample."""
    silent, base = all(not h.w.any() for h in model[:2]), math.log(model[2] / (1 - model[2]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in (b.slice(k, ROWS_READ) for b in batches for k in range(0, b.num_rows, ROWS_READ)):
            found = [features(t) for t in x.column("_text").to_pylist()]
            buckets, dense = [b for b, _ in found], np.array([d for _, d in found], np.float32).reshape(-1, DENSE)
            bad, toxic = (1 / (1 + np.exp(-np.clip(h.margin(buckets, dense), -30, 30))) if h.w.any() else np.zeros(len(found)) for h in model[:2])
            good = np.clip((1 - bad) * (1 - toxic), 1e-9, 1 - 1e-9)
            evidence = np.zeros(len(found)) if silent else np.log(good / (1 - good)) - base
            kept = x.drop_columns(["_text"])
            names = [*kept.schema.names, "p_bad", "p_toxic", "evidence"]
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(bad), pa.array(toxic), pa.array(evidence)], names)

    rows = docs.withColumn("_text", F.col("text"))
    schema = docs.schema
    for name in ("p_bad", "p_toxic", "evidence"):
        schema = schema.add(name, "double")
    return rows.mapInArrow(run, schema)


def _odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def posteriors(scored: DataFrame, prior: float, host: str = "host", path: str = "path") -> DataFrame:
    """(host, path, n, host_rate, path_rate): rates of good documents, shrunk from path to host to all.

    With s the between-group variance by moments and v the mean variance within, a group of n rows weighs n against v / s.
    """
    p = 1 / (1 + F.exp(-(F.col("evidence") + math.log(prior / (1 - prior)))))
    sums = saved(scored.groupBy(host, path).agg(F.count("*").alias("n"), F.sum(p).alias("s")), "sites")
    hosts = sums.groupBy(F.col(host).alias("_host")).agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    total = hosts.agg(F.sum("hn").alias("n"), F.sum("hs").alias("s"), F.count("*").alias("k"), F.sum(F.col("hn") * F.pow(F.col("hs") / F.col("hn"), 2)).alias("q"), F.sum(F.col("hn") * F.col("hn").cast("double")).alias("n2")).first()
    inner = sums.join(hosts, F.col(host).eqNullSafe(F.col("_host")))
    part = inner.agg(F.count("*").alias("k"), F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.col("hs") / F.col("hn"), 2)).alias("q")).first()
    n, mean = total["n"] or 0, (total["s"] or 0.0) / max(total["n"] or 0, 1)
    mean = min(max(mean, RATES[0]), RATES[1]) if n else prior
    within = max(mean * (1 - mean), 1e-6)

    def weight(groups: int, square: float, size: float) -> float:
        """Rows that a group's prior counts for."""
        between = (square - (groups - 1) * within) / size if groups > 1 and size > 0 else 0.0
        return within / between if between > 1e-6 else 1e6

    k_host = weight(total["k"], (total["q"] or 0.0) - n * ((total["s"] or 0.0) / max(n, 1)) ** 2, n - (total["n2"] or 0.0) / max(n, 1)) if n else 1e6
    k_path = weight(part["k"] - total["k"] + 1, part["q"] or 0.0, float(n)) if n else 1e6
    host_rate = (F.col("hs") + k_host * mean) / (F.col("hn") + k_host)
    path_rate = (F.col("s") + k_path * F.col("host_rate")) / (F.col("n") + k_path)
    return inner.withColumn("host_rate", host_rate).withColumn("path_rate", path_rate).select(F.col(host).alias("_host"), F.col(path).alias("_path"), F.col("n").alias("site_rows"), "host_rate", "path_rate")


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column, rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, digest, host, path, p_bad, p_toxic, evidence, host_rate, path_rate, score, kept): a row per row of docs, without texts.

    digest is a hash of the text, so that rows which share an id can be told apart.
    """
    model = train(docs, labels, rows)
    site = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("digest"), host.cast("string").alias("host"), path.cast("string").alias("path"), "text")
    scored = saved(with_evidence(site, model).drop("text"), "evidence")
    rates = posteriors(scored, model[2])
    out = scored.join(rates, F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path")), "left").drop("_host", "_path")
    rate = F.least(F.greatest(F.col("path_rate"), F.lit(RATES[0])), F.lit(RATES[1]))
    score = 1 / (1 + F.exp(-(F.col("evidence") + _odds(rate))))
    return out.withColumn("score", score).withColumn("kept", F.col("score") >= threshold)


def keep_good(docs: DataFrame, labels: DataFrame, host: Column, path: Column, **options: object) -> DataFrame:
    """The rows of docs that the classifier keeps."""
    bad = classify(docs, labels, host, path, **options).where("not kept").select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).distinct()
    same = F.col("_row_id").eqNullSafe(F.col("_id")) & (F.col("_row_digest") == F.col("_digest"))
    return with_identity(docs).join(bad, same, "left_anti").select("_row.*")
