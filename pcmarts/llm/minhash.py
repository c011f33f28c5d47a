"""MinHash near-duplicates: banded candidates, sequential Bayesian verification, exact check, connected components.

A document's set holds its distinct shingles (64-bit hashes). Documents with the same set are one node, however many there are; the
node's name is the 128-bit digest of its set. A node's signature has SIZE minima, a byte of each; BANDS bands of ROWS minima give its
keys. Two sets of similarity 0.85 share no band with chance (1 - 0.85**ROWS)**BANDS, 8 in ten million.

Bayesian verification. Signatures that meet under a key are compared in batches of BATCH minima. With a uniform prior, n compared and m
equal minima give the similarity the posterior Beta(m + 1, n - m + 1); a pair goes as soon as the posterior puts less than MISS on the
similarity asked for. (A byte agrees by chance once in 256, which can only keep a pair.) What is left connects candidate groups.

Exact check. Every true link that met is inside one candidate group. The sets of a group's nodes are brought together once and all
pairs of different sets are decided by the sizes of intersection and union, counted by a product of membership matrices.

Both steps run on groups of any size in the same way (connected()). A group is cut into blocks of bounded rows and bytes; each block also
gets the group's pivot, so that blocks of one cluster are joined by a link to it. Links found in blocks give labels; rows that do not
have the label most frequent in their group then meet all blocks, and pairs of one label are passed over: they are connected already.
A large group of near copies costs its blocks, not its pairs, and no link between different labels is left out. Tasks return
spanning links, never pairs.

Nulls: a null or empty text has no shingles, links with nothing and is its own component. A null doc_id is never a component's least
id; a component of null ids only has a null id, and such rows are kept. Repeated rows are kept as rows with the same component. Other columns
are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pcmarts.llm.common import saved
from pcmarts.llm.simhash import components, forest

SHINGLE, PERCENT = 3, 85
ROWS, BANDS = 5, 24
SIZE, BATCH, MISS = 128, 32, 1e-6
BLOCK_ROWS, BLOCK_BYTES = 512, 8 << 20
COLUMNS, VALUES_AT_ONCE, ROWS_READ, CACHE = 1 << 13, 1 << 19, 1000, 1 << 18

_FACTORS = np.random.default_rng(20).integers(1, 1 << 63, SIZE, np.uint64) | np.uint64(1)
_OFFSETS = np.random.default_rng(21).integers(0, 1 << 63, SIZE, np.uint64)
_hashes: dict[bytes, int] = {}


def _of_word(word: bytes) -> int:
    found = xxhash.xxh64_intdigest(word)
    if len(_hashes) < CACHE:
        _hashes[word] = found
    return found


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct shingle hashes of a text, ascending."""
    words, get = (text or "").encode("utf-8", "surrogatepass").lower().split(), _hashes.get  # bytes: only A-Z and the six ASCII spaces count
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter([get(x) or _of_word(x) for x in words], np.uint64, len(words))
    size = min(shingle, len(w))
    h = np.full(len(w) - size + 1, size, np.uint64)
    for k in range(size):
        h = _mixed(h + w[k : len(w) - size + 1 + k])
    return np.unique(h)


def minima(hashes: np.ndarray) -> np.ndarray:
    """SIZE minima of a set that is not empty, each under a hash function of its own."""
    least, step = np.full(SIZE, np.iinfo(np.uint64).max), max(1, VALUES_AT_ONCE // SIZE)
    for at in range(0, len(hashes), step):
        h = hashes[at : at + step, None] * _FACTORS + _OFFSETS
        least = np.minimum(least, (h ^ (h >> np.uint64(29))).min(0))
    return least


def _beta_tail(m: int, n: int, at: float) -> float:
    """P(x >= at) for x of Beta(m + 1, n - m + 1): at most m of n + 1 trials of chance `at` succeed."""
    return sum(math.comb(n + 1, k) * at**k * (1 - at) ** (n + 1 - k) for k in range(m + 1))


@cache
def least_equal(percent: int = PERCENT, miss: float = MISS) -> tuple[int, ...]:
    """For each batch, the least number of equal minima so far that the posterior does not rule out."""
    return tuple(next(m for m in range(n + 1) if _beta_tail(m, n, percent / 100) >= miss) for n in range(BATCH, SIZE + 1, BATCH))


def prints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, digest, n_shingles, node, signature, keys): digest is a hash of the text; the last three are null without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in (b.slice(k, ROWS_READ) for b in batches for k in range(0, b.num_rows, ROWS_READ)):
            sizes, node, signature, keys = [], [], [], []
            for text in x.column("text").to_pylist():
                found = shingles(text, shingle)
                sizes.append(len(found))
                if not len(found):
                    node.append(None), signature.append(None), keys.append(None)
                    continue
                least = minima(found)
                node.append(xxhash.xxh3_128_digest(found.tobytes()))
                signature.append((least & np.uint64(255)).astype(np.uint8).tobytes())
                bands = least[: BANDS * ROWS].reshape(BANDS, ROWS)
                keys.append([int(xxhash.xxh3_64_intdigest(b.tobytes(), k) >> 1) for k, b in enumerate(bands)])
            columns = [x.column("doc_id"), x.column("digest"), pa.array(sizes, pa.int64()), pa.array(node, pa.binary()), pa.array(signature, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "n_shingles", "node", "signature", "keys"])

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("digest"), "text")
    return rows.mapInArrow(run, "doc_id long, digest long, n_shingles long, node binary, signature binary, keys array<long>")


Near = Callable[[list[bytes], np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def likely(percent: int, miss: float) -> Near:
    """Links that the Bayesian test leaves between rows (signatures); side and label say which pairs are asked for."""
    least = least_equal(percent, miss)

    def near(bodies: list[bytes], side: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        signature = np.frombuffer(b"".join(bodies), np.uint8).reshape(-1, SIZE)
        label, found = label.copy(), []
        for i in range(len(label)):
            left = np.arange(i + 1, len(label))
            left = left[(label[left] != label[i]) & ((side[left] != side[i]) | (side[i] == 0))]
            equal = np.zeros(len(left), np.int64)
            for step, bound in enumerate(least):
                if not left.size:
                    break
                part = slice(step * BATCH, (step + 1) * BATCH)
                equal += (signature[left, part] == signature[i, part]).sum(1)
                left, equal = left[equal >= bound], equal[equal >= bound]
            if left.size:
                found.append((np.full(len(left), i), left))
                label[np.isin(label, label[left])] = label[i]
        return tuple(map(np.concatenate, zip(*found, strict=True))) if found else (np.zeros(0, np.int64),) * 2

    return near


def exactly(percent: int) -> Near:
    """Links between rows (whole sets of shingle hashes) by the sizes of intersection and union."""

    def near(bodies: list[bytes], side: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(b) // 8 for b in bodies])
        allowed = np.triu(label[:, None] != label[None, :], 1) & ((side[:, None] != side[None, :]) | (side[:, None] == 0))
        allowed &= 100 * np.minimum(sizes[:, None], sizes[None, :]) >= percent * np.maximum(sizes[:, None], sizes[None, :])
        used = np.flatnonzero(allowed.any(0) | allowed.any(1))
        if not used.size:
            return used, used
        owner = np.repeat(np.arange(len(used)), sizes[used])
        hashes = np.frombuffer(b"".join(bodies[i] for i in used), np.uint64)
        order = np.argsort(hashes, kind="stable")
        hashes, owner = hashes[order], owner[order]
        column = np.cumsum(np.concatenate([[0], hashes[1:] != hashes[:-1]]))
        shared = np.bincount(column)[column] > 1
        owner, column = owner[shared], column[shared]
        both = np.zeros((len(used), len(used)), np.float32)  # counts below 2**24 are exact
        for at in range(0, int(column[-1]) + 1 if column.size else 0, COLUMNS):
            lo, hi = np.searchsorted(column, (at, at + COLUMNS))
            if lo < hi:
                cols, place = np.unique(column[lo:hi], return_inverse=True)
                member = np.zeros((len(used), len(cols)), np.float32)
                member[owner[lo:hi], place] = 1
                both += member @ member.T
        common = both.astype(np.int64)
        size = sizes[used]
        linked = 100 * common >= percent * (size[:, None] + size[None, :] - common)
        a, b = np.nonzero(linked & allowed[np.ix_(used, used)])
        return used[a], used[b]

    return near


def _linked(rows: DataFrame, near: Near) -> DataFrame:
    """(a, b): spanning links within groups; rows: key, one, two (the group), node, side, label, body. Only pairs of different sides
    (or of side 0) and of different labels are looked at."""
    names = ("key", "one", "two")
    rows = rows.select(*names, "node", "side", "label", "body").repartition(*names).sortWithinPartitions(*names, "side", "node")

    def out(held: list[tuple]) -> pa.RecordBatch | None:
        node, side, label, body = zip(*held, strict=True)
        codes = np.unique(np.array(label, object), return_inverse=True)[1] if label[0] is not None else np.arange(len(label))
        a, b = near(list(body), np.array(side), codes)
        if not len(a):
            return None
        a, b = forest(a, b)
        return pa.RecordBatch.from_arrays([pa.array([node[i] for i in a], pa.binary()), pa.array([node[i] for i in b], pa.binary())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in names), strict=True))
            for key, row in zip(keys, zip(*(batch.column(c).to_pylist() for c in ("node", "side", "label", "body")), strict=True), strict=True):
                if key != group:
                    found = out(held) if len(held) > 1 else None
                    if found is not None:
                        yield found
                    group, held = key, []
                if not held or held[-1][:2] != row[:2]:
                    held.append(row)
        found = out(held) if len(held) > 1 else None
        if found is not None:
            yield found

    return rows.mapInArrow(run, "a binary, b binary").distinct()


def connected(members: DataFrame, near: Near, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(a, b): links that connect, within each key of members (key, node, bytes, and a function's body), what `near` links.

    members is a written table without groups of one node. The node of a row may come several times under a key.
    """
    groups = members.groupBy("key").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"), F.min("node").alias("pivot"))
    cuts = F.greatest(F.ceil(F.col("n") / block_rows), F.ceil(F.col("bytes") / block_bytes)).cast("int")
    groups = saved(groups.select("key", "pivot", cuts.alias("cuts")), "groups")
    rows = members.join(groups, "key").withColumn("one", F.pmod(F.xxhash64("node"), "cuts").cast("int"))
    everywhere = F.when(F.col("node") == F.col("pivot"), F.sequence(F.lit(0), F.col("cuts") - 1)).otherwise(F.array("one"))
    first = rows.withColumn("one", F.explode(everywhere)).withColumn("two", F.col("one")).withColumn("side", F.lit(0)).withColumn("label", F.lit(None).cast("binary"))
    found = saved(_linked(first, near), "links")
    if groups.where("cuts > 1").isEmpty():
        return found

    # Groups of several blocks: rows without the most frequent label meet all blocks.
    labels = components(found)
    rows = rows.where("cuts > 1").join(labels, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root")
    rows = saved(rows, "labelled")
    most = rows.groupBy("key", "label").agg(F.count("*").alias("n")).groupBy("key").agg(F.max(F.struct("n", "label")).alias("most"), F.count("*").alias("labels"))
    most = most.where("labels > 1").select("key", F.col("most.label").alias("major"))
    rows = rows.join(most, "key")
    others = F.sequence(F.lit(0), F.col("cuts") - 1)
    left = rows.where("label <> major").withColumn("two", F.explode(others)).withColumn("side", F.lit(1))
    active = left.groupBy("key", "one").agg(F.lit(1).alias("x")).select("key", F.col("one").alias("with"))
    right = rows.withColumnRenamed("one", "two").join(active, "key").withColumnRenamed("with", "one").withColumn("side", F.lit(2))
    return found.union(_linked(left.unionByName(right), near))


def _sets(docs: DataFrame, live: DataFrame, shingle: int) -> DataFrame:
    """(key, node, bytes, body): the sets of the nodes in live (key, node, doc_id, digest), a row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in (b.slice(k, ROWS_READ) for b in batches for k in range(0, b.num_rows, ROWS_READ)):
            found = [shingles(t, shingle).tobytes() for t in x.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([x.column("key"), x.column("node"), pa.array([len(b) for b in found], pa.int64()), pa.array(found, pa.binary())], ["key", "node", "bytes", "body"])

    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_digest"), "text")
    same = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_digest") == F.col("digest"))
    return texts.join(live, same).select("key", "node", "text").mapInArrow(run, "key binary, node binary, bytes long, body binary").dropDuplicates(["node"])


def _several(rows: DataFrame) -> DataFrame:
    """The rows whose key holds more than one."""
    return rows.join(rows.groupBy("key").count().where("count > 1").select("key"), "key", "left_semi")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, miss: float = MISS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row per row of docs; component_id is the smallest doc_id that links reach."""
    rows = saved(prints(docs, shingle), "minhash")
    nodes = saved(rows.where("node is not null").groupBy("node", "signature", "keys").agg(F.min("doc_id").alias("first")), "nodes")

    keys = _several(nodes.select("node", F.explode("keys").alias("key")))
    met = keys.join(nodes.select("node", "signature"), "node").select("key", "node", F.lit(SIZE).alias("bytes"), F.col("signature").alias("body"))
    candidates = saved(components(connected(saved(met, "met"), likely(percent, miss), BLOCK_ROWS * 4)), "candidates")

    groups = candidates.select(F.col("root").alias("key"), "node").union(candidates.select("root", "root").distinct())
    live = rows.join(groups, "node").groupBy("key", "node").agg(F.min(F.struct("doc_id", "digest")).alias("d")).select("key", "node", "d.doc_id", "d.digest")
    roots = components(connected(saved(_sets(docs, live, shingle), "sets"), exactly(percent)))

    placed = nodes.select("node", "first").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = placed.groupBy("root").agg(F.min("first").alias("least"))
    placed = placed.join(ids, "root").select("node", "least")
    found = rows.select("doc_id", "n_shingles", "node").join(placed, "node", "left")
    component: Column = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
