"""BPE encoding and decoding with a public vocabulary file, equal to the tokenizers library; long runs by tree concatenation.

A text is normalised and cut into words as the vocabulary file states; each word is merged on its own. A run that the cut leaves long
is encoded as a tree: halves are encoded apart, then joined. Around a join the last k tokens of the left and the first k of the right
are encoded again, k growing until the first and the last token of the window are those of the two sides. All neighbouring tokens are
then as in an encoding of the whole, and an encoding by ranked merges is determined by its neighbours being so.

Texts of over BIG bytes are cut into rows of PIECE characters, stretches of words and pieces of long runs, which other tasks encode; the
join tree then runs per text. The condition only decides where the work runs: both paths give the same ids.

encode(): a row per row of docs with ids (little-endian unsigned 32-bit numbers, one binary value) and n_tokens. A null text counts as
empty: no ids. Repeated rows and repeated or null ids stay rows of their own. decode() gives the text of ids.
Memory: a task holds one batch of texts, a vocabulary and a cache of CACHE words.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructType

LEAF, PIECE, BIG, CACHE, ROWS_OUT = 32, 1 << 14, 1 << 20, 1 << 17, 400
NO_RANK, UNRANKED = (1 << 60, 0), 1 << 60

# White space of the vocabulary's normaliser, as a character class.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def byte_names() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b if b in printable else next(rest)) for b in range(256)]


class Bpe:
    """A byte-level BPE with word ends from a tokenizers file: NFC, white space collapsed, lower case, one regex cut."""

    def __init__(self, source: str) -> None:
        spec = json.loads(source)
        model, cut = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.vocab, self.end = model["vocab"], model["end_of_word_suffix"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.numbers = {i: _u4([i]) for i in self.special.values()}
        self.name = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.rank = {}
        for k, (a, b) in enumerate(model["merges"]):
            self.rank.setdefault(self.vocab[a] << 17 | self.vocab[b], (k, self.vocab[a + b]))  # ids have 17 bits at most
        self.pairs = np.array(sorted(self.rank), np.int64)
        self.pair_rank = np.array([self.rank[k][0] for k in sorted(self.rank)], np.int64)
        self.made = np.array([self.vocab[a + b] for a, b in model["merges"]], np.int64)
        self.words = regex.compile(cut)
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.spaces, self.rare = re.compile(f"[{SPACE}]+"), re.compile("[\x1c-\x1f]")  # str.split() takes the rare ones for spaces
        self.inner, self.last = ([self.vocab[c + end] for c in byte_names()] for end in ("", self.end))
        self.parts: dict[int, list[int]] = {}
        self.cache: dict[str, bytes] = {}

    def symbols(self, word: str) -> list[int]:
        """Ids of the single symbols of a word, the last one with the word end."""
        data = word.encode("utf-8", "surrogatepass")
        ids = list(map(self.inner.__getitem__, data))
        ids[-1] = self.last[data[-1]]
        return ids

    def expand(self, token: int) -> list[int]:
        """The single symbols that a token was merged from."""
        if token not in self.parts:
            name = self.name[token]
            stem = name.removesuffix(self.end)
            chars = list(stem)
            if stem != name:
                chars[-1] += self.end
            self.parts[token] = [self.vocab[c] for c in chars]
        return self.parts[token]

    def merge(self, ids: list[int]) -> list[int]:
        """Plain encoding: of the pairs of lowest rank the first is merged, until no pair has a rank."""
        get, none = self.rank.get, NO_RANK
        ids = list(ids)
        ranks = [get(a << 17 | b, none) for a, b in zip(ids, ids[1:], strict=False)]
        while ranks:
            low = min(ranks)
            if low is none:
                break
            i = ranks.index(low)
            ids[i] = new = low[1]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get(ids[i - 1] << 17 | new, none)
            if i < len(ranks):
                ranks[i] = get(new << 17 | ids[i + 1], none)
        return ids

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of what left and right encode, one after the other."""
        if not left or not right:
            return left or right
        k = 1
        while True:
            a, b = left[-k:], right[:k]
            window = self.merge([s for t in a + b for s in self.expand(t)])
            if (k >= len(left) or window[0] == a[0]) and (k >= len(right) or window[-1] == b[-1]):
                return left[: max(0, len(left) - k)] + window + right[k:]
            k *= 2

    def tree(self, leaves: list[list[int]]) -> list[int]:
        """Joins encoded neighbours pairwise until one encoding is left."""
        while len(leaves) > 1:
            leaves = [self.join(*leaves[i : i + 2]) if i + 1 < len(leaves) else leaves[i] for i in range(0, len(leaves), 2)]
        return leaves[0] if leaves else []

    def run(self, ids: list[int]) -> list[int]:
        """The encoding of the symbols of a word or of a piece of one."""
        return self.tree([self.merge(ids[i : i + LEAF]) for i in range(0, len(ids), LEAF)])

    def chunks(self, text: str) -> list[str | int]:
        """Pieces between white space, normalised; special tokens as their ids. No word goes over white space."""
        out: list[str | int] = []
        for part in self.specials.split(text) if "<|" in text else (text,):
            if part in self.special:
                out.append(self.special[part])
                continue
            part = _lower(unicodedata.normalize("NFC", part))
            out += [x for x in self.spaces.split(part) if x] if self.rare.search(part) else part.split()
        return out

    def merge_all(self, words: list[str]) -> list[bytes]:
        """merge() of many words at once: in each round every word merges its first pair of lowest rank."""
        data = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.fromiter(map(len, data), np.int64, len(data))
        ids = np.array(self.inner, np.int64)[np.frombuffer(b"".join(data), np.uint8)]
        closing = np.cumsum(sizes) - 1
        ids[closing] = np.array(self.last, np.int64)[[x[-1] for x in data]]
        word = np.repeat(np.arange(len(data)), sizes)
        rank = self._ranks(ids[:-1], ids[1:])
        rank = np.append(rank, UNRANKED) if len(ids) else rank
        rank[closing] = UNRANKED  # the place of a pair is that of its first symbol
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(ids):
            start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            low = np.repeat(np.minimum.reduceat(rank, start), np.diff(np.append(start, len(ids))))
            over = low == UNRANKED
            if over.any():
                done.append((word[over], ids[over]))
                word, ids, rank, low = word[~over], ids[~over], rank[~over], low[~over]
                if not len(ids):
                    break
            at = np.flatnonzero(rank == low)
            at = at[np.concatenate([[True], word[at[1:]] != word[at[:-1]]])]
            ids[at] = self.made[rank[at]]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            last = np.append(word[1:] != word[:-1], True)[at + 1]  # the second symbol closed its word
            ids, word, rank = ids[keep], word[keep], rank[keep]
            at -= np.arange(len(at))
            rank[at] = UNRANKED
            go = at[~last]
            rank[go] = self._ranks(ids[go], ids[go + 1])
            back = at[at > 0]
            back = back[word[back - 1] == word[back]]
            rank[back - 1] = self._ranks(ids[back - 1], ids[back])
        word, ids = (np.concatenate(x) for x in zip(*done, strict=True)) if done else (np.zeros(0, np.int64),) * 2
        order = np.argsort(word, kind="stable")
        raw, ends = ids[order].astype("<u4").tobytes(), (4 * np.cumsum(np.bincount(word, minlength=len(data)))).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs, UNRANKED for pairs that are never merged."""
        key = a << 17 | b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.pair_rank[at], UNRANKED)

    def ids_of(self, chunks: set[str]) -> dict[str, bytes]:
        """Ids of chunks that the cache does not hold; the first CACHE chunks, among them all frequent ones, are remembered."""
        words = {c: (c,) if c.isalpha() else tuple(self.words.findall(c)) for c in chunks}
        distinct = list({w for ws in words.values() for w in ws})
        short = [w for w in distinct if 4 * len(w) <= LEAF or len(w.encode("utf-8", "surrogatepass")) <= LEAF]
        ids = dict(zip(short, self.merge_all(short), strict=True))
        ids |= {w: _u4(self.run(self.symbols(w))) for w in distinct if w not in ids}
        found = {c: b"".join([ids[w] for w in ws]) for c, ws in words.items()}
        room = CACHE - len(self.cache)
        if room > 0:
            self.cache.update((c, i) for c, i in list(found.items())[:room] if len(c) <= 64)
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        chunks = [self.chunks(t or "") for t in texts]
        known = dict(self.cache) | self.numbers
        known |= self.ids_of(set().union(*chunks) - known.keys())
        return [b"".join(map(known.__getitem__, x)) for x in chunks]

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.name.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def cut(self, text: str, piece: int) -> Iterator[tuple[int, str, bytes]]:
        """(run, kind, data): a text as stretches of words and as the symbols of long runs, at most `piece` characters each."""
        run, held, size = 0, [], 0

        def stretch() -> Iterator[tuple[int, str, bytes]]:
            if held:
                yield run, "words", " ".join(held).encode("utf-8", "surrogatepass")

        for chunk in self.chunks(text):
            if isinstance(chunk, str) and len(chunk) <= piece:
                held.append(chunk)
                size += len(chunk) + 1
                if size < piece:
                    continue
            yield from stretch()
            run, held, size = run + 1, [], 0
            if isinstance(chunk, int):
                yield run, "ids", _u4([chunk])
            elif len(chunk) > piece:
                for word in self.words.findall(chunk):
                    symbols = self.symbols(word)
                    run += 1
                    yield from ((run, "symbols", _u4(symbols[i : i + piece])) for i in range(0, len(symbols), piece))
            run += 1
        yield from stretch()

    def piece(self, kind: str, data: bytes) -> bytes:
        """The ids of what cut() gave."""
        if kind == "ids":
            return data
        if kind == "symbols":
            return _u4(self.run(np.frombuffer(data, "<u4").tolist()))
        chunks = data.decode("utf-8", "surrogatepass").split(" ")
        found = self.ids_of(set(chunks))
        return b"".join([found[c] for c in chunks])


def _lower(text: str) -> str:
    """Lower case character by character: a final capital sigma has no form of its own."""
    return text.replace("Σ", "σ").lower()


def _u4(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def encode(docs: DataFrame, vocabulary: str, text: str = "text", decoded: str | None = None) -> DataFrame:
    """docs with ids and n_tokens in place of the text, and with the decoded text if a name is given for it.

    vocabulary is the path of a tokenizers file on the driver.
    """
    source = open(vocabulary, encoding="utf-8").read()
    kept = [c for c in docs.columns if c not in (text, "ids", "n_tokens", decoded)]
    row, whole = F.struct(*kept) if kept else F.struct(F.lit(0).alias("none")), F.coalesce(F.col(text), F.lit(""))
    docs = docs.select(row.alias("row"), whole.alias("whole"))
    long = F.octet_length("whole") > BIG
    kind = docs.schema["row"].dataType

    def done(bpe: Bpe, rows: pa.Array, ids: list[bytes]) -> pa.RecordBatch:
        texts = [bpe.decode(i) if decoded else None for i in ids]
        return pa.RecordBatch.from_arrays([rows, pa.array(ids, pa.binary()), pa.array(texts, pa.string())], ["row", "ids", "decoded"])

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(source)
        for x in batches:
            for part in (x.slice(i, ROWS_OUT) for i in range(0, x.num_rows, ROWS_OUT)):
                yield done(bpe, part.column(0), bpe.encode(part.column(1).to_pylist()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, text_no = Bpe(source), TaskContext.get().partitionId() << 40
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        for x in batches:
            for i, t in enumerate(x.column(1).to_pylist()):
                rows = [(text_no, k, *p) for k, p in enumerate(bpe.cut(t, PIECE))] or [(text_no, 0, 0, "ids", b"")]
                first = x.column(0).take(pa.array([i] + [None] * (len(rows) - 1), pa.int64()))
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([first, *columns], ["row", "text_no", "place", "run", "kind", "data"])
                text_no += 1

    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(source)
        for x in batches:
            data = [bpe.piece(k, d) for k, d in zip(x.column("kind").to_pylist(), x.column("data").to_pylist(), strict=True)]
            yield x.set_column(x.schema.get_field_index("data"), "data", pa.array(data, pa.binary()))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(source)
        for x in batches:
            for k in range(x.num_rows):
                runs: dict[int, list[list[int]]] = {}
                for p in x.column("pieces")[k].as_py():  # in the order of the text
                    runs.setdefault(p["run"], []).append(np.frombuffer(p["data"], "<u4").tolist())
                yield done(bpe, x.column("row").slice(k, 1), [_u4([i for leaves in runs.values() for i in bpe.tree(leaves)])])

    out = StructType().add("row", kind).add("ids", BinaryType()).add("decoded", StringType())
    pieces = StructType().add("row", kind).add("text_no", LongType()).add("place", LongType()).add("run", LongType()).add("kind", StringType()).add("data", BinaryType())
    leaves = docs.where(long).mapInArrow(cut, pieces).repartition("text_no", "place").mapInArrow(leaf, pieces)
    texts = leaves.groupBy("text_no").agg(F.array_sort(F.collect_list(F.struct("place", "run", "data"))).alias("pieces"), F.first("row", True).alias("row"))
    rows = docs.where(~long).mapInArrow(plain, out).union(texts.select("row", "pieces").mapInArrow(joined, out))
    more = [F.col("decoded").alias(decoded)] if decoded else []
    return rows.select(*([f"row.`{c}`" for c in kept]), "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), *more)


def decode(encoded: DataFrame, vocabulary: str, into: str = "decoded") -> DataFrame:
    """encoded with the text of its ids: the tokens' names with a space between them. Null ids give an empty text."""
    source = open(vocabulary, encoding="utf-8").read()

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = Bpe(source)
        for x in batches:
            yield pd.Series([bpe.decode(i or b"") for i in x])

    return encoded.withColumn(into, F.pandas_udf(run, "string")("ids"))
