"""SimHash near-duplicates: Pigeonring candidate search, full Hamming check, connected components.

Fingerprints are reduced to distinct values before anything is compared, so copies cost one row however many there are.

Candidates. 64 bits are cut into m = d + 1 consecutive segments (d: the largest distance that links). If two fingerprints differ in
at most d bits, the ring of segments has a start i from which the first l segments differ in at most floor(l * d / m) = l - 1 bits
together, for every l = 1..m. So segment i is equal and its successor differs in one bit at most: one half of the successor is
equal too. Segment i with either half of its successor is the search key (8 keys a fingerprint for d = 3). Pairs that share a key go
through the whole chain of budgets, then through the full Hamming check.

Hot keys (a large group of near copies shares its keys) are cut into blocks of HOT_BLOCK fingerprints; each pair of blocks is a
group of its own that any task can take. A task returns a spanning forest of the links it found and never the pairs: connectivity is
all that components need, and no link between different fingerprints is lost. There is no cap.

Nulls: a null text counts as empty (fingerprint zero, linked like any other). A null doc_id is never a component's smallest id; a
component of null ids only has a null id. Repeated rows are kept, a row each. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pcmarts.llm.common import saved, with_identity

SHINGLE, DISTANCE, SEED = 3, 3, 42
HOT_BLOCK = 2048
HASHES_AT_ONCE = 1 << 15
PAIRS_AT_ONCE = 1 << 17
ROWS_READ = 1000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of a text: a bit is 1 if over half of the shingle hashes have it."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and the six ASCII spaces count
    if not words:
        return 0
    digest, size = xxhash.xxh64_intdigest, min(shingle, len(words))
    count, total = np.zeros(64, np.int64), len(words) - size + 1
    for at in range(0, total, HASHES_AT_ONCE):
        part = words[at : min(at + HASHES_AT_ONCE, total) + size - 1]
        hashes = [digest(b" ".join(x), SEED) for x in zip(*(part[k:] for k in range(size)), strict=False)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * count > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, digest, fp): digest is a hash of the text, fp the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for part in (x.slice(k, ROWS_READ) for k in range(0, x.num_rows, ROWS_READ)):
                fp = np.fromiter((fingerprint(t, shingle) for t in part.column("text").to_pylist()), np.uint64, part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("digest"), pa.array(fp.view(np.int64))], ["doc_id", "digest", "fp"])

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("digest"), "text")
    return rows.mapInArrow(run, "doc_id long, digest long, fp long")


def _edges(distance: int) -> list[int]:
    return [64 * k // (distance + 1) for k in range(distance + 2)]


def _keys(distance: int) -> list:
    """A column for each search key of fp: (start of the chain, half of the successor, bits)."""
    edges, keys = _edges(distance), []
    bits = lambda lo, hi: F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))
    for i in range(distance + 1):
        lo, hi = edges[i], edges[i + 1]
        after = (i + 1) % (distance + 1)
        start, end = edges[after], edges[after + 1]
        middle = (start + end) // 2
        for half, (a, b) in enumerate(((start, middle), (middle, end))):
            keys.append(F.struct(F.lit(2 * i + half).alias("slot"), bits(lo, hi).alias("head"), bits(a, b).alias("tail")))
    return keys


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the links a-b connect: each value but the least of its group with that least value."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        while (new != new[new]).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    member = label != np.arange(len(nodes))
    return nodes[member], nodes[label[member]]


def _close(part: dict[str, np.ndarray], distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of the rows of whole groups; a group's rows stand together."""
    edges, m = _edges(distance), distance + 1
    mask = [np.uint64(((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1)) for i in range(m)]
    chain = np.zeros((m, m + 1), np.uint64)  # chain[i, l]: bits of the l segments from i on
    for i in range(m):
        for n in range(1, m + 1):
            chain[i, n] = chain[i, n - 1] | mask[(i + n - 1) % m]
    group, fp, side, first, slot = part["group"], part["fp"], part["side"], part["same"], part["slot"] // 2
    left, step, waiting, found = np.arange(len(fp)), 0, 0, []
    while left.size:
        step += 1
        left = left[left + step < len(fp)]
        left = left[group[left] == group[left + step]]
        a = left[first[left] | (side[left] != side[left + step])]
        x = fp[a] ^ fp[a + step]
        for n in range(2, m + 1):
            near = np.bitwise_count(x & chain[slot[a], n]) <= n - 1
            a, x = a[near], x[near]
        a = a[np.bitwise_count(x) <= distance]
        if a.size:
            found.append((fp[a], fp[a + step]))
            waiting += a.size
            if waiting > PAIRS_AT_ONCE:
                found = [forest(*map(np.concatenate, zip(*found, strict=True)))]
                waiting = found[0][0].size
    return forest(*map(np.concatenate, zip(*found, strict=True))) if found else (fp[:0], fp[:0])


def links(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) that connect all that differ in at most `distance` bits."""
    keys = distinct.select("fp", F.explode(F.array(*_keys(distance))).alias("key"))
    hot = keys.groupBy("key").count().where("count > 1").select("key", F.ceil(F.col("count") / HOT_BLOCK).cast("int").alias("blocks"))
    rows = keys.join(hot, "key").withColumn("side", F.pmod(F.xxhash64("fp"), "blocks").cast("int"))
    rows = rows.select("key", "fp", "side", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = rows.select("key", "fp", "side", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"))
    rows = rows.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    rows = rows.select("key.slot", "key.head", "key.tail", "lo", "hi", "side", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("slot", "head", "tail", "lo", "hi", "side", "fp")
        rest = np.zeros((len(names), 0), np.int64)  # the last group of a batch may go on in the next one

        def out(x: np.ndarray) -> pa.RecordBatch:
            group = np.concatenate([[0], np.cumsum((x[:5, 1:] != x[:5, :-1]).any(0))])
            part = {"group": group, "fp": x[6].view(np.uint64), "side": x[5], "same": x[3] == x[4], "slot": x[0]}
            return pa.RecordBatch.from_arrays([pa.array(v.view(np.int64)) for v in _close(part, distance)], ["a", "b"])

        for batch in batches:
            if batch.num_rows:
                rest = np.concatenate([rest, np.stack([batch.column(c).to_numpy().astype(np.int64) for c in names])], 1)
                other = np.flatnonzero((rest[:5] != rest[:5, -1:]).any(0))
                if other.size:
                    whole = int(other[-1]) + 1
                    yield out(np.ascontiguousarray(rest[:, :whole]))
                    rest = rest[:, whole:].copy()
        if rest.shape[1]:
            yield out(rest)

    return rows.mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of each component, for nodes with a link. Alternating large and small stars.

    A round attaches to every node's least neighbour first its larger, then its smaller neighbours; long chains shrink by a
    constant factor a round. Each round is written to the shared folder; only a count and a checksum reach the driver.
    """
    edges, before = saved(edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct(), "links"), None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        before = now
        both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(edges.select("hi", "lo"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select("v", "m").distinct()
        least = large.groupBy("v").agg(F.min("m").alias("r"))
        small = large.join(least, "v").select(F.explode(F.array(F.struct("v", "r"), F.struct(F.col("m").alias("v"), "r"))).alias("e"))
        edges = saved(small.where("e.v > e.r").select(F.col("e.r").alias("lo"), F.col("e.v").alias("hi")).distinct(), "links")


def _placed(docs: DataFrame, shingle: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, digest, fp) of each row, and (fp, root) of each distinct fingerprint."""
    if not 1 <= distance <= 15:
        raise ValueError("distance must be 1..15")
    prints = saved(fingerprints(docs, shingle), "simhash")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.min(F.struct(F.isnull("doc_id"), "doc_id", "digest")).alias("row"))
    roots = components(links(distinct.select("fp"), distance)).withColumnRenamed("node", "fp")
    return prints, distinct.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first", "row")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint, component_id), a row per row of docs; component_id is the smallest doc_id that links reach."""
    prints, placed = _placed(docs, shingle, distance)
    ids = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    placed = placed.join(ids, "root").select("fp", "component_id")
    return prints.join(placed, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of docs without near-duplicates: of each component the row with the smallest doc_id stays (null ids come last).

    If that id stands on several texts, the one with the least hash stays; of rows that are repeated as they are, one.
    """
    _, placed = _placed(docs, shingle, distance)
    kept = placed.groupBy("root").agg(F.min("row").alias("row")).select(F.col("row.doc_id").alias("_id"), F.col("row.digest").alias("_digest"))
    rows = with_identity(docs)
    rows = rows.join(kept, F.col("_row_id").eqNullSafe(F.col("_id")) & (F.col("_row_digest") == F.col("_digest")), "left_semi")
    return rows.dropDuplicates(["_row_id", "_row_digest"]).select("_row.*")
