"""Language-model scores by context-tree weighting over bytes.

A text is its words (A-Z lower-cased), each as its bytes and a space, then an end byte. Each byte is eight binary decisions; every
decision has a context tree over the DEPTH bytes before it. A node holds counts of zeros and ones from the training documents and their
Krichevsky-Trofimov estimate; its weighted probability is half its own estimate and half the product of its children's. A decision is
predicted by the mixture along its context path, at each node with the weight that the counts have given the node against its subtree;
a context that training never met ends the path at the node above it. The score is the log10 probability of the text by the trained,
fixed model. With `across`, which the query uses, contexts are the true DEPTH bytes, earlier words included; a text begins after a
space and end bytes. Without, contexts stop at the space before a word, so a word's code length depends on the word alone.

How the work is spread, across words
1. Word counts (for the base score and n_known) and grams (context and byte) of the texts: each task sums what it reads, up to
   HELD_GRAMS grams at once, partial sums are shuffled. Grams of held-out documents have count 0.
2. Subtrees as in 2 below. A text's score is the sum over its grams: the most frequent ones (TOP_CONTEXTS, a bound on memory) are
   looked up in the task, all others are joined by key with the words in one shuffle. Texts are counted in portions of COUNTED bytes
   and looked up in portions of LOOKED_UP bytes, also of one long text. A gram or word comes to the join once per text, with its times.

How the work is spread, word by word
1. Word counts: each task counts words, partial sums are shuffled. Training words and words that only held-out documents have form the
   lexicon (count 0 for the latter).
2. Grams (context and byte) of the lexicon, summed likewise. They are dealt out by the last two context bytes: each value is a subtree.
   Only the subtrees' root values, 65,280 nodes at depth one and 255 at depth zero at most, go to the driver and back.
3. A gram's log probability needs its subtree and those top nodes. Words are sums over their grams, texts over their words. The most
   frequent grams and words (at most TOP_GRAMS, TOP_WORDS, a bound on memory, not on what is scored) are looked up in the task;
   all others are joined by key. So frequent keys are never shuffled and no row is dropped.

A document is held out if crc32 of its id as text leaves HELD_OUT modulo FOLDS; a null id counts as an empty text, a null text too.
Rows are scored one by one, so repeated rows stay. Without training documents every decision has probability one half.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pcmarts.llm.common import saved

DEPTH, SPLIT = 6, 2
FOLDS, HELD_OUT = 5, 1
TOP_WORDS, TOP_GRAMS = 1 << 16, 1 << 18
FLUSH_WORDS, FLUSH_ROWS = 200_000, 100_000
TOP_CONTEXTS, HELD_GRAMS, HELD_WORDS = 1 << 21, 1 << 21, 1 << 20
COUNTED, LOOKED_UP, PIECE = 1 << 22, 1 << 20, 1 << 16  # bytes; a piece stays in the cache
TEXTS = 1 << 8  # looked up at once: a gram of seven bytes and the text's number are one word of 64 bits
SPACE, END = 0x20, 0x0A
PART_SHIFT = 8 * (DEPTH - SPLIT + 1)  # what is above are the last SPLIT context bytes
LN2, LN10 = math.log(2), math.log(10)


# --- the binary context tree, on arrays of grams: context bytes above, the latest one highest, the coded byte lowest


def grams_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(grams, number of the word) of all bytes of the words, their closing spaces included."""
    text = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    gram, open_ = text[1:].astype(np.int64), np.ones(len(text) - 1, bool)
    for k in range(1, DEPTH + 1):
        before = np.zeros(len(text) - 1, np.uint8)
        before[k - 1 :] = text[: max(0, len(text) - k)]
        gram |= np.where(open_, before, 0).astype(np.int64) << (8 * (DEPTH - k + 1))
        open_ &= before != SPACE
    return gram, np.repeat(np.arange(len(words)), size)


START = bytes([END] * (DEPTH - 1) + [SPACE])  # what stands before a text; no word has an end byte


def pieces_of(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(grams, numbers of the text) of all bytes of texts (words, a space after each), with the DEPTH bytes before them, PIECE bytes at once."""
    if not texts:
        return
    data = np.frombuffer(bytes([END]) + b"".join(START + text + bytes([END]) for text in texts), np.uint8)
    size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1 + DEPTH
    begin = np.cumsum(size) - size + 1
    eight = np.lib.stride_tricks.as_strided(data[:8].view("<u8"), (max(0, len(data) - 7),), (1,))  # a byte is the highest of the eight up to it
    for lo in range(1 + DEPTH, len(data), PIECE):
        hi = min(lo + PIECE, len(data))
        value = eight[lo - 7 : hi - 7].copy()
        gram = value << np.uint64(8) >> np.uint64(8 * (7 - DEPTH)) & np.uint64((1 << 64) - 256) | value >> np.uint64(56)
        first, last = np.searchsorted(begin, lo, "right"), np.searchsorted(begin, hi, "left")
        step, own = np.zeros(hi - lo, np.int32), np.ones(hi - lo, bool)
        step[begin[first:last] - lo] = 1
        for k in range(DEPTH):  # START is not coded
            at = begin[max(0, first - 1) : last] + k - lo
            own[at[(at >= 0) & (at < hi - lo)]] = False
        yield gram.view(np.int64)[own], (np.cumsum(step, dtype=np.int32) + np.int32(first - 1))[own]


def grams_at_once(texts: list[bytes], most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pieces of the texts put together to about `most` bytes."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for piece in pieces_of(texts):
        held.append(piece)
        size += len(piece[0])
        if size >= most:
            whole = tuple(map(np.concatenate, zip(*held, strict=True)))
            held, size = [], 0
            yield whole
    if held:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def end_gram() -> int:
    return SPACE << (8 * DEPTH) | END


def lgamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x > 0: Stirling's series above 8, reached by the recurrence."""
    shift = np.zeros_like(x)
    x = x.copy()
    while (low := x < 8).any():
        shift[low] += np.log(x[low])
        x[low] += 1
    y = 1 / (x * x)
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + (1 / 12 - y * (1 / 360 - y * (1 / 1260 - y / 1680))) / x - shift


OF_HALF, OF_ONE = (lgamma(np.arange(1 << 12) + x) for x in (0.5, 1.0))  # small counts need no series


def lgamma_from(n: np.ndarray, more: float, table: np.ndarray) -> np.ndarray:
    """lgamma(n + more) of whole n, small ones from the table."""
    out, large = table[np.minimum(n, len(table) - 1).astype(np.int64)], n >= len(table)
    if large.any():
        out[large] = lgamma(n[large] + more)
    return out


def kt_log(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log probability of any one sequence of n0 zeros and n1 ones by the Krichevsky-Trofimov estimator."""
    return lgamma_from(n0, 0.5, OF_HALF) + lgamma_from(n1, 0.5, OF_HALF) - lgamma_from(n0 + n1, 1.0, OF_ONE) - math.log(math.pi)


def decisions(cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node keys, bits) of the eight decisions of each gram, cut to the depth: node = its context and the bits before."""
    byte = cut & 255
    keys = np.stack([cut - byte | (1 << j) | (byte >> (8 - j)) for j in range(8)])
    return keys, np.stack([(byte >> (7 - j)) & 1 for j in range(8)])


class Level:
    """The nodes of one depth: keys, counts, log KT, log of the children's product, log weighted probability.

    of: the nodes of the eight decisions of the grams that made the level, cut to its depth, ascending.
    """

    def __init__(self, key: np.ndarray, n0: np.ndarray, n1: np.ndarray, below: np.ndarray | None, of: np.ndarray | None = None) -> None:
        self.key, self.n0, self.n1, self.of = key, n0, n1, of
        kt = kt_log(n0, n1)
        total = kt if below is None else np.logaddexp(kt, below)
        self.own = np.exp(kt - total)  # weight of the node against its subtree
        self.log = total - (0.0 if below is None else LN2)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(node of each key, node is there)."""
        order = np.argsort(self.key)
        at = order[np.minimum(np.searchsorted(self.key, keys, sorter=order), len(self.key) - 1)]
        return at, self.key[at] == keys

    def mixed(self, keys: np.ndarray, bits: np.ndarray, up: np.ndarray, p: np.ndarray, known: np.ndarray, made: bool) -> tuple[np.ndarray, np.ndarray]:
        """(probability of the bits, node is there), given the same from the depth below. keys, bits: of the cut grams; up: their places."""
        if not len(self.key):
            return p, np.zeros_like(known)
        at, there = (self.of, True) if made else self.find(keys)
        n0, n1 = self.n0[at], self.n1[at]
        there = (there & (n0 + n1 > 0))[:, up]
        kt = ((np.where(bits == 1, n1, n0) + 0.5) / (n0 + n1 + 1))[:, up]
        own = np.where(known, self.own[at][:, up], 1.0)
        return np.where(there, own * kt + (1 - own) * p, p), there


def summed(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys and the sums of the values over equal ones."""
    keys, at = np.unique(key, return_inverse=True)
    return keys, *(np.bincount(at.ravel(), v.ravel(), len(keys)) for v in values)


def parents(key: np.ndarray) -> np.ndarray:
    """Keys of the nodes one context byte shorter."""
    return (key >> 16) << 8 | (key & 255)


def subtree(gram: np.ndarray, count: np.ndarray) -> list[Level]:
    """Levels DEPTH..SPLIT of the trees over the grams of one group. Nodes of untrained grams (count 0) only have probability one.

    At a depth the cut grams are sorted once: nodes of each of the eight decisions are runs of them.
    """
    levels, first, cut, n = [], [], gram, count.astype(float)
    for depth in range(DEPTH, SPLIT - 1, -1):
        cut, up = np.unique(cut if depth == DEPTH else parents(cut), return_inverse=True)
        n = np.bincount(up, n, len(cut))
        of, low, first, nodes, size = np.empty((8, len(cut)), np.int64), first, [], [], 0
        for j in range(8):
            node = cut >> (8 - j)
            new = np.concatenate([np.ones(min(1, len(cut)), bool), node[1:] != node[:-1]])
            begin = np.flatnonzero(new)
            of[j] = np.cumsum(new) + (size - 1)
            one = n * ((cut >> (7 - j)) & 1)
            all_, n1 = (np.add.reduceat(v, begin) if len(cut) else v for v in (n, one))
            nodes.append(((cut - (cut & 255) | (1 << j) | (cut & 255) >> (8 - j))[begin], all_ - n1, n1))
            first.append(begin)
            size += len(begin)
        # a node's first gram leads to the node above
        below = np.bincount(np.concatenate([of[j, up[low[j]]] for j in range(8)]), levels[-1].log, size) if levels else None
        levels.append(Level(*(np.concatenate(v) for v in zip(*nodes, strict=True)), below, of))
    return levels


def log10_of(gram: np.ndarray, levels: list[Level], top: list[Level], made: bool = False) -> np.ndarray:
    """log10 probability of each gram's byte in its context. made: the levels' subtree was made of just these grams."""
    p, known = np.full((8, len(gram)), 0.5), np.zeros((8, len(gram)), bool)
    cut, up = gram, np.arange(len(gram))
    for depth, level in zip(range(DEPTH, -1, -1), [*levels, *top], strict=True):
        cut, at = np.unique(cut if depth == DEPTH else parents(cut), return_inverse=True)
        up = at[up]
        keys, bits = decisions(cut)
        p, known = level.mixed(keys, bits, up, p, known, made and level.of is not None)
    return np.log(p).sum(0) / LN10


def top_levels(roots: pd.DataFrame) -> list[Level]:
    """Levels above SPLIT from the subtrees' root nodes, already summed by their parents: (key, n0, n1, log)."""
    key, order = np.sort(roots["key"].to_numpy(np.int64)), np.argsort(roots["key"].to_numpy(np.int64))
    values = [roots[c].to_numpy(float)[order] for c in ("n0", "n1", "log")]
    levels = [Level(key, values[0], values[1], values[2])]
    for _ in range(SPLIT - 1):
        low = levels[-1]
        key, n0, n1, below = summed(parents(low.key), low.n0, low.n1, low.log)
        levels.append(Level(key, n0, n1, below))
    return levels


# --- corpus jobs


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray, pa.Array]:
    """(words of all texts, numbers of words, texts as words with a space after each)."""
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    lists = pc.ascii_split_whitespace(trimmed)  # no text: one empty word
    some = pc.greater(pc.binary_length(trimmed), 0)
    size = np.where(some.to_numpy(zero_copy_only=False), pc.list_value_length(lists).to_numpy(zero_copy_only=False), 0).astype(np.int64)
    words = lists.flatten()
    plain = pc.binary_join_element_wise(pc.binary_join(lists, " "), pc.if_else(some, " ", ""), "")
    return words.filter(pc.greater(pc.binary_length(words), 0)).cast(pa.binary()), size, plain.cast(pa.binary())


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == HELD_OUT


def lexicon(docs: DataFrame) -> DataFrame:
    """(word, n): how often each word of the corpus occurs in training documents, 0 for words of held-out documents only."""

    def merged(parts: list[pa.Table]) -> pa.Table:
        sums = pa.concat_tables(parts).group_by("word", use_threads=False).aggregate([("n", "sum")])
        return sums.select(["word", "n_sum"]).rename_columns(["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, fresh, size = pa.schema({"word": pa.binary(), "n": pa.int64()}).empty_table(), [], 0
        for texts, aside in _portions(batches, COUNTED):
            for kind in (False, True):
                counts = pc.value_counts(_split(texts.filter(pc.equal(aside, kind)))[0])
                n = counts.field(1) if not kind else pa.array(np.zeros(len(counts), np.int64))
                fresh.append(pa.table({"word": counts.field(0), "n": n}))
                size += len(counts)
            if size >= max(HELD_WORDS // 2, len(held)):
                held, fresh, size = merged([held, *fresh]), [], 0
                if len(held) >= HELD_WORDS:
                    yield from held.combine_chunks().to_batches(FLUSH_ROWS)
                    held = held.slice(0, 0)
        yield from merged([held, *fresh]).combine_chunks().to_batches(FLUSH_ROWS)

    rows = docs.select("text", held_out(F.col("doc_id")).alias("aside")).mapInArrow(run, "word binary, n long")
    return rows.repartition("word").groupBy("word").agg(F.sum("n").alias("n"))  # tasks have summed: no use in trying again before the shuffle


def _flushed(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The batches put together to about so many rows."""
    held: list[pa.RecordBatch] = []
    for x in batches:
        held.append(x)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def grams(words: DataFrame, texts: int) -> DataFrame:
    """(gram, n): grams of the lexicon with their counts in `texts` training documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _flushed(batches, FLUSH_WORDS):
            if x.num_rows:
                gram, word = grams_of(x.column("word").to_pylist())
                key, n = summed(gram, x.column("n").to_numpy()[word].astype(float))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n.astype(np.int64))], ["gram", "n"])

    ends = words.sparkSession.createDataFrame([(end_gram(), texts)], "gram long, n long")
    return words.mapInArrow(run, "gram long, n long").union(ends).groupBy("gram").agg(F.sum("n").alias("n"))


def text_grams(docs: DataFrame) -> DataFrame:
    """(gram, n): grams of all texts with contexts across words, counted in training documents, 0 for those of held-out ones only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, fresh = (np.zeros(0, np.int64), np.zeros(0, np.int64)), []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            parts = [held, *fresh]
            fresh.clear()
            key, n = np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts])
            parts.clear()
            order = np.argsort(key)
            key, n = key[order], n[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
            return key[first], np.add.reduceat(n, first) if len(key) else n

        def out() -> Iterator[pa.RecordBatch]:
            for lo in range(0, len(held[0]), FLUSH_ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(v[lo : lo + FLUSH_ROWS]) for v in held], ["gram", "n"])

        for texts, aside in _portions(batches, COUNTED):
            for kind in (False, True):
                for gram, _ in grams_at_once(_split(texts.filter(pc.equal(aside, kind)))[2].to_pylist(), COUNTED):
                    key, times = np.unique(gram, return_counts=True)
                    fresh.append((key, times * (not kind)))
            if sum(len(k) for k, _ in fresh) >= max(HELD_GRAMS // 2, len(held[0])):
                held = merged()
                if len(held[0]) >= HELD_GRAMS:
                    yield from out()
                    held = np.zeros(0, np.int64), np.zeros(0, np.int64)
        held = merged()
        yield from out()

    rows = docs.select("text", held_out(F.col("doc_id")).alias("aside")).mapInArrow(run, "gram long, n long")
    return rows.repartition("gram").groupBy("gram").agg(F.sum("n").alias("n"))  # as for words


def _portions(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(texts, values of the second column) in portions of about `most` bytes."""
    held: list[pa.RecordBatch] = []
    size = 0

    def whole() -> tuple[pa.Array, pa.Array]:
        rows = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        return tuple(pa.concat_arrays(c.chunks) for c in rows.columns)

    for x in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(x.column(0)), 0).to_numpy().astype(np.int64) + DEPTH + 1)
        lo = done = 0
        while lo < x.num_rows:
            hi = min(int(np.searchsorted(ends, done + most - size)) + 1, x.num_rows)
            held.append(x.slice(lo, hi - lo))
            size += int(ends[hi - 1]) - done
            lo, done = hi, int(ends[hi - 1])
            if size >= most:
                yield whole()
                size = 0
    if held:
        yield whole()


def gram_keys(gram: np.ndarray) -> pa.Array:
    """Grams as binary keys that are no words: seven bytes and a space."""
    data = (gram.astype(np.uint64) << np.uint64(8) | np.uint64(SPACE)).astype(">u8").tobytes()
    return pa.Array.from_buffers(pa.binary(), len(gram), [None, pa.py_buffer(np.arange(0, 8 * len(gram) + 1, 8, dtype=np.int32)), pa.py_buffer(data)])


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(grams, counts) in portions of about FLUSH_ROWS rows that hold whole subtrees; rows of a subtree stand together."""
    gram = n = np.zeros(0, np.int64)
    for x in batches:
        gram, n = np.concatenate([gram, x.column("gram").to_numpy()]), np.concatenate([n, x.column("n").to_numpy()])
        if len(gram) >= FLUSH_ROWS:
            part = gram >> PART_SHIFT
            other = np.flatnonzero(part != part[-1])  # the last subtree may go on in the next batch
            if other.size:
                cut = int(other[-1]) + 1
                yield gram[:cut], n[:cut]
                gram, n = gram[cut:].copy(), n[cut:].copy()
    if len(gram):
        yield gram, n


def gram_logs(counted: DataFrame) -> DataFrame:
    """(gram, n, log10): the model's log10 probability of each gram's byte in its context."""
    part = F.shiftright("gram", PART_SHIFT)
    parts = counted.repartition(part).sortWithinPartitions("gram").select("gram", "n")

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for gram, n in _whole(batches):
            if (n > 0).any():
                low = subtree(gram[n > 0], n[n > 0])[-1]
                key, n0, n1, log = summed(parents(low.key), low.n0, low.n1, low.log)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n0), pa.array(n1), pa.array(log)], ["key", "n0", "n1", "log"])

    # At most 256 contexts of one byte and 255 nodes each: the bound of what the driver gets.
    sums = parts.mapInArrow(roots, "key long, n0 double, n1 double, log double").groupBy("key")
    top = top_levels(sums.agg(*(F.sum(c).alias(c) for c in ("n0", "n1", "log"))).toPandas())

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for gram, n in _whole(batches):
            logs = log10_of(gram, subtree(gram, n), top, made=True)
            yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(n), pa.array(logs)], ["gram", "n", "log10"])

    return parts.mapInArrow(scored, "gram long, n long, log10 double")


def frequent(rows: DataFrame, most: int) -> Column:
    """Condition on n that at most `most` rows meet: n lies in the upper classes of a histogram of a few hundred classes."""
    kind = F.floor(F.log2(F.col("n").cast("double")) * 8)
    left, least = most, None
    for x in sorted(rows.where("n > 0").groupBy(kind.alias("k")).count().collect(), reverse=True):
        left -= x["count"]
        if left < 0:
            break
        least = x["k"]
    return F.lit(False) if least is None else F.coalesce((F.col("n") > 0) & (kind >= least), F.lit(False))


def word_logs(words: DataFrame, logs: DataFrame) -> DataFrame:
    """(word, n, log10): the model's log10 probability of each word of the lexicon with its closing space."""
    top = logs.where(frequent(logs, TOP_GRAMS)).select("gram", "log10").toArrow().sort_by("gram")
    known, value = top["gram"].to_numpy(), top["log10"].to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = 0
        for x in _flushed(batches, FLUSH_ROWS):
            if not x.num_rows:
                continue
            gram, word = grams_of(x.column("word").to_pylist())
            at = np.minimum(np.searchsorted(known, gram), max(0, len(known) - 1))
            there = known[at] == gram if len(known) else np.zeros(len(gram), bool)
            sums = np.bincount(word[there], value[at[there]], x.num_rows)
            # A row for the word itself under a key that is no gram, and a row for each gram still to be looked up.
            own = -1 - np.arange(serial, serial + x.num_rows)
            serial += x.num_rows
            rest = word[~there]
            which = pa.array(np.concatenate([np.arange(x.num_rows), rest]))
            none = np.zeros(len(rest))
            n = np.concatenate([x.column("n").to_numpy(), none.astype(np.int64)])
            yield pa.RecordBatch.from_arrays([
                x.column("word").combine_chunks().take(which), pa.array(n), pa.array(np.concatenate([own, gram[~there]])), pa.array(np.concatenate([sums, none])),
            ], ["word", "n", "gram", "part"])

    rows = words.mapInArrow(run, "word binary, n long, gram long, part double")
    rows = rows.join(logs.select("gram", "log10"), "gram", "left")
    return rows.groupBy("word").agg(F.sum("n").alias("n"), F.sum(F.col("part") + F.coalesce("log10", F.lit(0.0))).alias("log10"))


def score(docs: DataFrame, across: bool = False) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes), a row per row of docs.

    across: contexts go on over the spaces into the words before.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    words = saved(lexicon(docs), "lexicon")
    texts = docs.where(~held_out(F.col("doc_id"))).count()
    total = words.agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("v")).first()
    n_all, v_all = (total["n"] or 0) + texts, total["v"] + (texts > 0)
    logs = saved(gram_logs(saved(text_grams(docs) if across else grams(words, texts), "grams")), "gramlogs")
    known_grams = gram_values = np.zeros(0)
    if across:
        common = frequent(logs, TOP_CONTEXTS)
        table = logs.where(common).select("gram", "log10").toArrow().sort_by("gram")
        known_grams, gram_values, end_log = table["gram"].to_numpy(), table["log10"].to_numpy(), 0.0
        scored = words.withColumn("log10", F.lit(0.0))  # words count for the base only
        key = F.unhex(F.concat(F.lpad(F.hex("gram"), F.lit(14), F.lit("0")), F.lit(f"{SPACE:02x}")))
        joined = scored.union(logs.where(~common).select(key, F.lit(None).cast("long"), "log10"))
    else:
        scored = joined = saved(word_logs(words, logs), "wordlogs")
        end_log = logs.where(F.col("gram") == end_gram()).first()["log10"]
    scale = n_all + 0.5 * (v_all + 1)
    base = lambda n: math.log10((n + 0.5) / scale)
    top = scored.where(frequent(scored, TOP_WORDS)).toArrow()
    # Compact on the driver and on the way; a task makes its own lookup table.
    near, near_counts, near_logs = pa.array(top["word"].to_pylist(), pa.binary()), top["n"].to_numpy(), top["log10"].to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near_base = np.log10((near_counts + 0.5) / scale)
        row = TaskContext.get().partitionId() << 40
        names, kinds = ["row", "word", "times", "doc_id", "n_tokens", "n_known", "base", "part", "n_bytes"], [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()]

        def rest(rows_: pa.Array, key: pa.Array, times: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([rows_, key, times, *(pa.nulls(len(key), k) for k in kinds[3:])], names)

        def looked_up(parts: np.ndarray, gram: np.ndarray, number: np.ndarray, first: int) -> Iterator[pa.RecordBatch]:
            """Adds known grams to the texts' parts; rows of the others, to be joined. number is below TEXTS: both sort as one word."""
            both = gram.view(np.uint64) << np.uint64(8)
            both |= number.astype(np.uint64)
            both.sort()
            gram = (both >> np.uint64(8)).view(np.int64)
            both &= np.uint64(TEXTS - 1)
            number = both.view(np.int64)
            begin = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])) if len(gram) else np.zeros(0, np.int64)
            distinct, times_ = gram[begin], np.diff(np.append(begin, len(gram)))  # equal grams are looked up once
            at = np.minimum(np.searchsorted(known_grams, distinct), max(0, len(known_grams) - 1))
            there = known_grams[at] == distinct if len(known_grams) else np.zeros(len(distinct), bool)
            value = np.zeros(len(distinct))
            value[there] = gram_values[at[there]]
            parts += np.bincount(number, np.repeat(value, times_), len(parts))
            far_ = ~np.repeat(there, times_)
            gram, number = gram[far_], number[far_] + first
            begin = np.flatnonzero(np.concatenate([[True], (gram[1:] != gram[:-1]) | (number[1:] != number[:-1])])) if len(gram) else np.zeros(0, np.int64)
            gram, number, times_ = gram[begin], number[begin], np.diff(np.append(begin, len(gram)))
            for lo in range(0, len(gram), FLUSH_ROWS):
                hi = lo + FLUSH_ROWS
                yield rest(pa.array(number[lo:hi]), gram_keys(gram[lo:hi]), pa.array(times_[lo:hi]))

        for held, ids in _portions(batches, LOOKED_UP):
            parts = np.zeros(len(held))
            words_, size, plain = _split(held)
            if across:
                for lo in range(0, len(held), TEXTS):
                    for gram, number in grams_at_once(plain[lo : lo + TEXTS].to_pylist(), LOOKED_UP):
                        yield from looked_up(parts[lo : lo + TEXTS], gram, number, row + lo)
            at = pc.fill_null(pc.index_in(words_, value_set=near), -1).to_numpy()
            number, there = np.repeat(np.arange(len(held)), size), at >= 0
            hit, of = at[there], number[there]
            known = np.bincount(of, minlength=len(held)) + int(texts > 0)
            lower = np.bincount(of, near_base[hit], len(held)) + base(texts)
            parts += np.bincount(of, near_logs[hit], len(held)) + end_log
            length = pc.binary_length(plain).to_numpy().astype(np.int64) + 1
            far = pa.table({"row": row + number[~there], "word": words_.filter(pa.array(~there))})
            far = far.group_by(["row", "word"], use_threads=False).aggregate([([], "count_all")]).combine_chunks()
            for x in far.select(["row", "word", "count_all"]).to_batches(FLUSH_ROWS):
                yield rest(*x.columns)
            numbers = np.arange(row, row + len(held))
            own = [numbers, [b" %d" % k for k in numbers.tolist()], np.zeros(len(held), np.int64), ids, size + 1, known, lower, parts, length]  # no word has a space
            yield pa.RecordBatch.from_arrays([c if c is ids else pa.array(c, k) for c, k in zip(own, kinds, strict=True)], names)
            row += len(held)

    rows = docs.select("text", "doc_id").mapInArrow(run, "row long, word binary, times long, doc_id long, n_tokens long, n_known long, base double, part double, n_bytes long")
    rows = rows.join(joined.select("word", "n", "log10"), "word", "left")
    low = F.log10((F.col("n") + 0.5) / F.lit(float(scale)))
    rows = rows.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"), F.max("n_bytes").alias("n_bytes"),
        F.sum(F.coalesce(F.col("n_known"), F.when(F.col("n") > 0, F.col("times")).otherwise(0))).alias("n_known"),
        F.sum(F.coalesce(F.col("base"), F.col("times") * low)).alias("base_score"), F.sum(F.coalesce(F.col("part"), F.col("times") * F.col("log10"))).alias("score"),
    )
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", F.lit(n_all).cast("long").alias("train_tokens"), "base_score", "score", "n_bytes")
