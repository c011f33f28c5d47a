"""Document fingerprints as threshold-scaled sketches: every shingle hash below a fixed fraction is retained.

A sketch holds the hashes of a text's five-word shingles that lie below 1 / FRACTION of the range, so its size follows the text and a
short text's sketch lies in that of a long text that contains it: |A and B| / |A| estimates how much of A is in B, however unequal they
are. Sketches of parts merge by union. The least hash of all is kept too; it decides where nothing at all was retained.

Words are [^\\x20\\x09-\\x0D]+, A-Z lower-cased; a text of fewer than five words is one shingle, one without words has no hash. The
fingerprint is text: FRACTION, the least hash (16 hex digits), then the retained hashes (12 hex digits each, ascending).

with_next() brings each document together with the next one in descending doc_id: ids are cut into ranges of equal count at existing
ids (a list as long as the partitions), each range is sorted in its own partition, and the row at a cut goes to the range before it as
well. Each text is shuffled once. Null texts are empty; null ids come last; rows that share an id stand in the order of their texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHINGLE, FRACTION, CACHE, ROWS_OUT = 5, 8, 1 << 18, 200
KEPT = np.uint64((1 << 64) // FRACTION)
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of h."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_hashes: dict[bytes, int] = {}


def _of_word(word: bytes) -> int:
    found = xxhash.xxh64_intdigest(word) | 1
    if len(_hashes) < CACHE:
        _hashes[word] = found
    return found


def sketch(text: str) -> tuple[np.ndarray, int | None]:
    """(retained hashes, ascending and distinct; the least hash of all)."""
    words, get = text.encode("utf-8", "surrogatepass").lower().split(), _hashes.get
    if not words:
        return np.zeros(0, np.uint64), None
    w = np.fromiter([get(x) or _of_word(x) for x in words], np.uint64, len(words))
    size = min(SHINGLE, len(w))
    h = np.full(len(w) - size + 1, size, np.uint64)
    for k in range(size):
        h = h * MULTIPLIER + w[k : len(w) - size + 1 + k]
    h = _mixed(h)
    return np.unique(h[h < KEPT]), int(h.min())


def written(found: tuple[np.ndarray, int | None]) -> str:
    retained, least = found
    tail = np.ascontiguousarray((retained >> np.uint64(13)).astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes().hex()
    return f"{FRACTION}:{'' if least is None else format(least, '016x')}:{tail}"


def likeness(a: tuple[np.ndarray, int | None], b: tuple[np.ndarray, int | None]) -> tuple[float, float]:
    """Estimates of (resemblance, share of a's shingles that are in b); both empty: alike."""
    both = len(np.intersect1d(a[0], b[0], assume_unique=True))
    union = len(a[0]) + len(b[0]) - both
    equal = float(a[1] == b[1])
    return both / union if union else equal, both / len(a[0]) if len(a[0]) else equal


def merged(a: str, b: str) -> str:
    """The fingerprint of two texts' shingles together."""
    (_, la, ta), (_, lb, tb) = a.split(":"), b.split(":")
    parts = {t[i : i + 12] for t in (ta, tb) for i in range(0, len(t), 12)}
    return f"{FRACTION}:{min(filter(None, (la, lb)), default='')}:{''.join(sorted(parts))}"


def retained(fingerprint: Column) -> Column:
    """The retained hashes of a fingerprint as an array of hex words, for joins and set functions."""
    return F.regexp_extract_all(F.substring_index(fingerprint, ":", -1), F.lit(".{12}"), F.lit(0))


def _range_of(cuts: list[int], first: int = 0) -> Column:
    """The number of cuts that are >= the id (cuts descending): a tree of comparisons."""
    if not cuts:
        return F.lit(first)
    middle = len(cuts) // 2
    return F.when(F.col("doc_id") <= F.lit(cuts[middle]), _range_of(cuts[middle + 1 :], first + middle + 1)).otherwise(_range_of(cuts[:middle], first))


def in_ranges(docs: DataFrame) -> tuple[DataFrame, int]:
    """(doc_id, text, part, copy) and the number of parts; copy marks the row that begins the part after this one."""
    n = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    shares = [k / n for k in range(1, n)] or [0.5]
    found = rows.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, shares)), 100 * n).alias("q"), F.max("doc_id").alias("top")).first()
    cuts = sorted({x for x in found["q"] or [] if x != found["top"]}, reverse=True) if n > 1 else []
    own = F.when(F.col("doc_id").isNull(), F.lit(len(cuts))).otherwise(_range_of(cuts))
    top = F.lit(found["top"]).cast("long")
    begins = F.col("doc_id").eqNullSafe(top)
    before = F.when(begins, F.lit(len(cuts))).when(F.col("doc_id").isin(cuts) if cuts else F.lit(False), own - 1)
    places = F.array(F.struct(own.alias("part"), F.lit(False).alias("copy")), F.struct(before.alias("part"), F.lit(True).alias("copy")))
    rows = rows.select("doc_id", "text", F.explode(F.filter(places, lambda p: p["part"].isNotNull())).alias("p"))
    return rows.select("doc_id", "text", F.col("p.part").cast("int").alias("part"), "p.copy"), len(cuts) + 1


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, contained_edited double, contained_next double"


def fingerprints(docs: DataFrame) -> DataFrame:
    """A row per row of docs: its fingerprint, that of its edited text, and how alike they and the next document's are.

    Edited: the last third of the text (rounded down) is replaced by as many characters of the next document's start, or by all of it.
    """
    rows, parts = in_ranges(docs)
    rows = rows.repartitionById(parts, F.col("part")).sortWithinPartitions("copy", F.desc_nulls_last("doc_id"), "text")
    names = [c.split()[0] for c in RESULT.split(", ")]

    def compared(row: tuple, after: tuple) -> tuple:
        doc_id, text, own = row
        third = len(text) // 3
        edited = text[: len(text) - third] + after[1][:third]
        other = sketch(edited) if third else own
        (near, within), (near_next, within_next) = likeness(own, other), likeness(own, after[2])
        digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
        return doc_id, len(text), digest, written(own), written(other), near, near_next, within, within_next

    def out(found: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 4]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, found, over = None, [], False
        for x in batches:
            for doc_id, text, copy in zip(*(x.column(c).to_pylist() for c in ("doc_id", "text", "copy")), strict=True):
                if over:
                    continue  # further rows that share the id of the next part's first
                row = (doc_id, text, sketch(text))
                if waiting is not None:
                    found.append(compared(waiting, row))
                waiting, over = (None, True) if copy else (row, False)
                if len(found) >= ROWS_OUT:
                    yield out(found)
                    found = []
        if found:
            yield out(found)

    return rows.mapInArrow(run, RESULT)
