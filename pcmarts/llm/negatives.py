"""Hard-negative mining with exact integer scores from Kronecker-packed products.

Components become floor(SCALE * x). A score is the integer inner product of two rows. For scoring, components are biased to be at least
0, and several candidates' components at one position are packed into separate fields of one wide integer; the sum over positions of
anchor component times wide integer then holds each candidate's sum in its own field. A field is as wide as the largest sum that the
rows at hand can give, so nothing carries over, and unpacking and taking off the biases gives exact scores. Wide integers of up to 53
bits are held in doubles, which are exact there and multiply as one matrix product; larger components take Python integers.

Anchors meet all rows in blocks, in two passes. First each anchor meets the blocks of its own label, for its positives. Then it meets
blocks of all rows, for the different-label rows between LOW and HIGH per cent of each positive's score. In a block the candidates (at
most BLOCK_ROWS or so) are held and packed once; anchors stream past. A block returns an anchor's best few, never scores of all pairs;
the best of all blocks are found by rank. No row is left out of either pass.

Hot labels are cut into as many blocks as they fill. Equal rows (id, label and components) are counted first and scored once.

Nulls: rows with a null label, a null vector, or a null or non-finite component take no part. A null id is never an anchor; as candidate
it comes last among equal scores. Repeated rows are rows of their own: each is an anchor, and a positive and negative for others and
for its copies. Of vectors of unequal length the longer one's further components count as times 0; an empty vector scores 0. Components
beyond +-2**53 count as that; a score outside the range of long is returned as null, though ranked exactly. Labels compare as text.
An empty table has no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pcmarts.llm.common import saved

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 3, 50, 95
BLOCK_ROWS, LEAST_BLOCK = 1 << 18, 1 << 10
ANCHORS_AT_ONCE, TILE = 128, 1 << 13
EXACT_BITS, WIDE_FIELDS, TOP = 53, 16, 1 << 53

_MATCH = "row long, id long, score decimal(38,0), times long"


def packed(rows: np.ndarray, top: int) -> tuple[np.ndarray, int, int]:
    """(wide integers [words, positions], fields in each, bits of a field) of rows of components >= 0, for factors up to `top`.

    Row k * words + j stands in field k of word j.
    """
    width = max(1, (rows.shape[1] * top * int(rows.max(initial=0))).bit_length())
    double = 2 * width <= EXACT_BITS
    fields = EXACT_BITS // width if double else WIDE_FIELDS
    words = -(-len(rows) // fields)
    wide = np.zeros((words, rows.shape[1]), np.float64 if double else object)
    for k in range(fields):
        part = rows[k * words : (k + 1) * words]
        wide[: len(part)] += part * 2.0 ** (k * width) if double else part.astype(object) * (1 << k * width)
    return wide, fields, width


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products [anchors, rows] of integer rows, exact (dtype object where 64 bits are too few)."""
    if not rows.shape[1] or not len(rows):
        return np.zeros((len(anchors), len(rows)), np.int64)
    low_a, low_r = int(anchors.min()), int(rows.min())
    largest = max(abs(low_a), int(anchors.max())), max(abs(low_r), int(rows.max()))
    if rows.shape[1] * 4 * largest[0] * largest[1] >= 1 << 62:
        anchors, rows = anchors.astype(object), rows.astype(object)
    up_a, up_r = anchors - low_a, rows - low_r
    wide, fields, width = packed(up_r, int(up_a.max()))
    product = (up_a.astype(wide.dtype) @ wide.T).astype(np.int64 if wide.dtype == np.float64 else object)
    mask = (1 << width) - 1
    found = np.concatenate([(product >> k * width) & mask for k in range(fields)], 1)[:, : len(rows)]
    if rows.dtype != object:
        found = found.astype(np.int64)
    return found + low_r * anchors.sum(1)[:, None] + low_a * rows.sum(1)[None, :] - rows.shape[1] * low_a * low_r


def _order(group: np.ndarray, score: np.ndarray) -> np.ndarray:
    """Places by group, then falling score; equal ones stay in order."""
    if score.dtype == object:
        return np.array(sorted(range(len(group)), key=lambda i: (group[i], -score[i])), np.int64)
    return np.lexsort((-score, group))


def _first(group: np.ndarray, n: int) -> np.ndarray:
    """Places of the first n of each run of equal values."""
    begins = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, np.int64)
    at = np.arange(len(group)) - np.repeat(begins, np.diff(np.append(begins, len(group))))
    return np.flatnonzero(at < n)


class Block:
    """The candidates of a block, by id (nulls last)."""

    def __init__(self, parts: list[pa.RecordBatch]) -> None:
        rows = pa.Table.from_batches(parts).combine_chunks()
        self.row = rows["row"].to_numpy()
        self.id, self.copies = rows["id"].combine_chunks(), rows["copies"].to_numpy()
        self.codes: dict[str, int] = {}
        self.label = np.array([self.codes.setdefault(x, len(self.codes)) for x in rows["label"].to_pylist()])
        self.vectors = matrix(rows["vec"].combine_chunks())

    def meet(self, anchors: pa.RecordBatch) -> pa.RecordBatch | None:
        """An anchor's best candidates of this block: POSITIVES of its label, or NEGATIVES for each score asked."""
        label = np.array([self.codes.get(x, -1) for x in anchors.column("label").to_pylist()])
        row, asked = anchors.column("row").to_numpy(), anchors.column("asked").to_pylist()
        vectors = matrix(anchors.column("vec"))
        size = max(vectors.shape[1], self.vectors.shape[1])
        vectors, found = widened(vectors, size), []
        for at in range(0, len(self.row), TILE):
            s = scores(vectors, widened(self.vectors[at : at + TILE], size))
            same = label[:, None] == self.label[None, at : at + TILE]
            if asked[0] is None:
                same &= ~((self.copies[at : at + TILE] == 1) & (row[:, None] == self.row[None, at : at + TILE]))
                found += self._best(at, s, same, np.zeros(len(row), np.int64), None, POSITIVES)
            else:
                found += self._windows(at, s, ~same, asked)
        if not found:
            return None
        a, c, s, of = (np.concatenate(x) for x in zip(*found, strict=True))
        group = a * POSITIVES + of
        keep = _order(group, s)  # tiles follow each other, so equal scores are still in the order of ids
        keep = keep[_first(group[keep], POSITIVES if asked[0] is None else NEGATIVES)]
        a, c, s, of = a[keep], c[keep], s[keep], of[keep]
        times = self.copies[c] - (row[a] == self.row[c])
        exact = pa.array([Decimal(int(x)) for x in s], pa.decimal128(38, 0))
        target = None if asked[0] is None else pa.array([asked[i][k] for i, k in zip(a, of, strict=True)], pa.decimal128(38, 0))
        columns = [pa.array(row[a]), self.id.take(pa.array(c)), exact, pa.array(times)] + ([] if target is None else [target])
        return pa.RecordBatch.from_arrays(columns, ["row", "id", "score", "times"] + ([] if target is None else ["target"]))

    def _best(self, at, s, allowed, of, threshold, n):
        """[(anchor, candidate, score, which score asked)] of each anchor's n best among those allowed."""
        most = min(n, s.shape[1])
        if s.dtype != object:
            least = np.iinfo(np.int64).min
            s = np.where(allowed, s, least)
            allowed &= s >= np.partition(s, s.shape[1] - most, 1)[:, s.shape[1] - most][:, None]
        a, c = np.nonzero(allowed)
        keep = _order(a, s[a, c])
        keep = keep[_first(a[keep], n)]
        return [(a[keep], c[keep] + at, s[a[keep], c[keep]], of[a[keep]])] if keep.size else []

    def _windows(self, at, s, allowed, asked):
        places = max(map(len, asked))
        edges = [[(-(-LOW * int(p) // 100), HIGH * int(p) // 100) for p in x] + [(1, 0)] * (places - len(x)) for x in asked]
        if s.dtype != object:  # scores are below 2**62 here, so wider windows may end there
            edges = [[(max(-TOP * 512, min(lo, TOP * 512)), max(-TOP * 512, min(hi, TOP * 512))) for lo, hi in x] for x in edges]
        lo, hi = (np.array([[w[e] for w in x] for x in edges], s.dtype).reshape(len(asked), places) for e in (0, 1))
        a, c = np.nonzero(allowed & (s >= lo.min(1)[:, None]) & (s <= hi.max(1)[:, None])) if places else (np.zeros(0, int),) * 2
        keep = _order(a, s[a, c])
        a, c = a[keep], c[keep]
        found, value = [], s[a, c]
        for k in range(places):
            inside = np.flatnonzero((value >= lo[a, k]) & (value <= hi[a, k]))
            inside = inside[_first(a[inside], NEGATIVES)]
            if inside.size:
                found.append((a[inside], c[inside] + at, value[inside], np.full(len(inside), k)))
        return found


def matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of integers; short ones are filled up with zeros."""
    ends = vectors.offsets.to_numpy().astype(np.int64)
    flat, sizes = vectors.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]], np.diff(ends)
    size = int(sizes.max(initial=0))
    if (sizes == size).all():
        return flat.reshape(len(sizes), size).astype(np.int64)
    out = np.zeros((len(sizes), size), np.int64)
    out[np.arange(size)[None, :] < sizes[:, None]] = flat
    return out


def widened(rows: np.ndarray, size: int) -> np.ndarray:
    return rows if rows.shape[1] == size else np.pad(rows, ((0, 0), (0, size - rows.shape[1])))


def _met(candidates: DataFrame, anchors: DataFrame, schema: str, blocks: int | None) -> DataFrame:
    """What the blocks return; both sides have the columns part and sub, which name a block."""
    wanted = ["part", "sub", "kind", "row", "id", "label", "copies", "vec", "asked"]
    both = candidates.withColumn("kind", F.lit(0)).withColumn("asked", F.lit(None).cast("array<decimal(38,0)>")).select(wanted)
    both = both.unionByName(anchors.withColumn("kind", F.lit(1)).select(wanted))
    both = both.repartitionById(blocks, F.col("sub")) if blocks else both.repartition("part", "sub")
    both = both.sortWithinPartitions("part", "sub", "kind", F.col("id").asc_nulls_last(), "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, block = None, [], None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("part", "sub", "kind")), strict=True))
            begins = [k for k in range(len(keys)) if k == 0 or keys[k] != keys[k - 1]] + [len(keys)]
            for start, end in zip(begins, begins[1:], strict=False):
                if keys[start][:2] != key:
                    key, held, block = keys[start][:2], [], None
                part = batch.slice(start, end - start)
                if keys[start][2] == 0:
                    held.append(part)
                elif held or block:
                    block, held = block or Block(held), []
                    for at in range(0, part.num_rows, ANCHORS_AT_ONCE):
                        found = block.meet(part.slice(at, ANCHORS_AT_ONCE))
                        if found is not None:
                            yield found

    return both.mapInArrow(run, schema)


def _table(rows: DataFrame, identity: str, label: str, vector: str) -> DataFrame:
    """(row, id, label, vec, copies): the distinct rows that take part, written once; row numbers them."""
    parts = F.transform(F.col(vector), lambda x: F.greatest(F.lit(-TOP), F.least(F.lit(TOP), F.floor(x.cast("double") * SCALE))))
    usable = F.col(label).isNotNull() & F.col(vector).isNotNull() & F.forall(F.col(vector), lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    rows = rows.where(usable).select(F.col(identity).cast("long").alias("id"), F.col(label).cast("string").alias("label"), parts.alias("vec"))
    ends = rows.agg(F.max(F.array_max("vec")).alias("top"), F.min(F.array_min("vec")).alias("low")).first()
    top = max(ends["top"] or 0, -(ends["low"] or 0))
    kind = "smallint" if top < 1 << 15 else "int" if top < 1 << 31 else "bigint"
    rows = rows.withColumn("vec", F.col("vec").cast(f"array<{kind}>")).groupBy("id", "label", "vec").agg(F.count("*").alias("copies"))
    return saved(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")


def _best(found: DataFrame, keys: list[str], n: int) -> DataFrame:
    """keys and best: the n first of found as an array of (id, score), copies repeated."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    listed = found.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score", "times"))).alias("best"))
    each = F.transform("best", lambda x: F.array_repeat(F.struct(x["id"].alias("id"), x["score"].alias("score")), F.least(x["times"], F.lit(n)).cast("int")))
    return listed.withColumn("best", F.slice(F.flatten(each), 1, n))


def mine(rows: DataFrame, chosen: Column, identity: str = "vec_id", label: str = "label", vector: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    chosen is a condition on the column id: the rows that are anchors. Positives are an anchor's first POSITIVES other rows of its
    label, negatives the first NEGATIVES rows of other labels with LOW * positive <= 100 * negative <= HIGH * positive.
    """
    table = _table(rows, identity, label, vector)
    counts = saved(table.groupBy("label").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("cuts"), F.count("*").alias("n")), "labels")
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, math.ceil(total / BLOCK_ROWS), min(partitions, math.ceil(total / LEAST_BLOCK)))

    own = table.join(counts.select("label", "cuts"), "label").withColumn("part", F.col("label"))
    anchors = table.where(chosen)
    mine_own = own.where(chosen).withColumn("asked", F.lit(None).cast("array<decimal(38,0)>")).withColumn("sub", F.explode(F.sequence(F.lit(0), F.col("cuts").cast("int") - 1)))
    found = _met(own.withColumn("sub", F.pmod(F.xxhash64("row"), "cuts").cast("int")), mine_own, _MATCH, None)
    positives = saved(_best(found, ["row"], POSITIVES), "positives")

    asked = anchors.join(positives, "row").withColumn("asked", F.array_distinct(F.transform("best", lambda x: x["score"])))
    asked = asked.withColumn("part", F.lit("")).withColumn("sub", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    everyone = table.withColumn("part", F.lit("")).withColumn("sub", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    found = _met(everyone, asked, _MATCH + ", target decimal(38,0)", blocks)
    negatives = _best(found, ["row", "target"], NEGATIVES).withColumnRenamed("best", "worse")

    pairs = anchors.select("row", F.col("id").alias("anchor_id"), F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    pairs = pairs.join(positives, "row").select("row", "anchor_id", F.explode("best").alias("p"))
    pairs = pairs.join(negatives, (pairs["row"] == negatives["row"]) & (pairs["p.score"] == negatives["target"])).select("anchor_id", "p", F.posexplode("worse").alias("at", "n"))
    return pairs.select(
        "anchor_id", F.col("p.id").alias("positive_id"), (F.col("at") + 1).cast("int").alias("rank"), F.col("n.id").alias("negative_id"),
        F.expr("try_cast(p.score as long)").alias("positive_score"), F.expr("try_cast(n.score as long)").alias("negative_score"),
    )
