"""WARC archives compressed with an embedded Zstandard dictionary (.warc.zst), written and read by tasks.

An archive is a leading skippable frame that holds a dictionary, then one Zstandard frame per record, so a record can be read alone.
The dictionary is built from the archive's own first records (SAMPLE_BYTES of them). A task writes its rows to archives of about
ARCHIVE_BYTES each, through the file system that the folder's address names (file, hdfs, s3, gs). An archive gets a new name in every
attempt and counts only once its task has succeeded and listed it, so a lost executor leaves no half archive among the results.

Payloads: page_id, url, html. A null html is an empty payload, a null url has no target; a null page_id has no record number and comes
after all others. Of equal payloads of at least REVISIT_BYTES the smallest page_id is the response, others are revisits that refer to
it; if all ids of a payload are null, all are responses. Rows repeated with the same page_id and payload are responses both.
Only ids and digests are grouped; html is shuffled once, by page_id.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pcmarts.llm.common import saved

REVISIT_BYTES, SAMPLE_BYTES, DICTIONARY_BYTES, ARCHIVE_BYTES, LEVEL = 100, 1 << 20, 1 << 16, 1 << 28, 3
ROWS_OUT = 256
DATE = "1970-01-01T00:00:00Z"  # pages carry no time of capture

# Fixed values of the formats.
DICTIONARY_MAGIC, PROFILE = 0x184D2A5D, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(kind: str, fields: dict[str, str], block: bytes) -> bytes:
    head = {"WARC-Type": kind, "WARC-Date": DATE, **fields, "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, html: str | None, digest: str, refers_to: int | None) -> bytes:
    """A response, or a revisit without payload if refers_to is given."""
    payload = (html or "").encode("utf-8", "surrogatepass")
    fields = {"WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>" if page_id is None else f"<urn:page:{page_id}>"}
    if url:
        fields["WARC-Target-URI"] = quote(url, safe="".join(map(chr, range(33, 127))))
    fields |= {"WARC-Payload-Digest": f"sha256:{digest}", "X-Payload-Length": str(len(payload)), "Content-Type": "application/http; msgtype=response"}
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is None:
        return record("response", fields, http + payload)
    return record("revisit", fields | {"WARC-Refers-To": f"<urn:page:{refers_to}>", "WARC-Profile": PROFILE}, http)


def dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on the samples; of too few samples, their last bytes as they are."""
    size = min(DICTIONARY_BYTES, max(256, sum(map(len, samples)) // 8))
    try:
        return zstandard.train_dictionary(size, samples, k=512, d=8, dict_id=1 << 16)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[-size:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class Archive:
    """An archive that is being written: the first records are held until the dictionary is built."""

    def __init__(self, folder: str) -> None:
        self.fs, base = pyarrow.fs.FileSystem.from_uri(folder)
        self.fs.create_dir(base, recursive=True)
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.out = self.fs.open_output_stream(f"{base}/{self.name}", compression=None)
        self.held, self.bytes, self.records, self.frames = [], 0, 0, None
        self.add(record("warcinfo", {"WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n"))

    def add(self, data: bytes) -> None:
        self.records += 1
        if self.frames is None:
            self.held.append(data)
            self.bytes += len(data)
            if self.bytes >= SAMPLE_BYTES:
                self.start()
        else:
            self.bytes += self.out.write(self.frames.compress(data))

    def start(self) -> None:
        words = dictionary(self.held)
        packed = zstandard.ZstdCompressor(level=19).compress(words.as_bytes())
        self.out.write(struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed)
        self.frames, self.bytes = zstandard.ZstdCompressor(level=LEVEL, dict_data=words, write_checksum=True), 0
        for data in self.held:
            self.bytes += self.out.write(self.frames.compress(data))
        self.held = []

    def close(self) -> tuple[str, int]:
        if self.frames is None:
            self.start()
        self.out.close()
        return self.name, self.records


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of an open archive; memory: one record."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no dictionary frame at the start of the archive")
    words = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(stream.read(size)))
    source = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=words).stream_reader(stream, read_across_frames=True), 1 << 16)
    while line := source.readline():
        if line.strip() != b"WARC/1.1":
            raise ValueError(f"no record at {line[:40]!r}")
        fields = {}
        while (line := source.readline().strip()):
            name, _, value = line.decode().partition(": ")
            fields[name] = value
        block = source.read(int(fields["Content-Length"]))
        if source.read(4) != b"\r\n\r\n":
            raise ValueError("record without its end")
        yield fields, block


def roles(pages: DataFrame) -> DataFrame:
    """pages with digest and refers_to, the page_id of the response that a row revisits."""
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha2(html, 256).alias("digest"))
    small = pages.select(F.col("page_id").cast("long").alias("r_id"), F.sha2(html, 256).alias("r_digest"), F.octet_length(html).alias("size"))
    small = small.where(F.col("size") >= REVISIT_BYTES)
    first = small.groupBy("r_digest").agg(F.min("r_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 and refers_to is not null").drop("n")
    again = small.join(first, "r_digest").where("not (r_id <=> refers_to)").select("r_id", "r_digest", "refers_to").distinct()
    same = F.col("page_id").eqNullSafe(F.col("r_id")) & (F.col("digest") == F.col("r_digest"))
    return rows.join(again, same, "left").drop("r_id", "r_digest")


def write(pages: DataFrame, folder: str) -> DataFrame:
    """(archive, n_records) of the archives written to folder, as a table that is there when this returns."""

    fields = ("page_id", "url", "html", "digest", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, done = None, []
        for x in (b.slice(k, ROWS_OUT) for b in batches for k in range(0, b.num_rows, ROWS_OUT)):
            for row in zip(*(x.column(c).to_pylist() for c in fields), strict=True):
                archive = archive or Archive(folder)
                archive.add(page_record(*row))
                if archive.bytes >= ARCHIVE_BYTES:
                    done.append(archive.close())
                    archive = None
        if archive:
            done.append(archive.close())
        yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], ["archive", "n_records"])

    return saved(roles(pages).mapInArrow(run, "archive string, n_records long"), "archives")


READ = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary"


def read(archives: DataFrame, folder: str) -> DataFrame:
    """The response and revisit records of the listed archives; digests of responses are computed from their payloads and compared."""

    def page(name: str | None) -> int | None:
        return int(name[10:-1]) if name and name.startswith("<urn:page:") else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pyarrow.fs.FileSystem.from_uri(folder)
        for x in batches:
            for name in x.column("archive").to_pylist():
                rows = []
                with fs.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for fields, block in records(stream):
                        kind, stated = fields["WARC-Type"], fields.get("WARC-Payload-Digest", "").removeprefix("sha256:")
                        if kind not in ("response", "revisit"):
                            continue
                        payload, size = None, int(fields["X-Payload-Length"])
                        if kind == "response":
                            payload = block.partition(b"\r\n\r\n")[2]
                            size, found = len(payload), hashlib.sha256(payload).hexdigest()
                            if found != stated:
                                raise ValueError(f"payload of {fields['WARC-Record-ID']} in {name} is damaged")
                        rows.append((page(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), kind, stated, size, page(fields.get("WARC-Refers-To")), payload))
                        if len(rows) >= ROWS_OUT:
                            yield _batch(rows)
                            rows = []
                yield _batch(rows)

    # A stated number of partitions: the list is small, and adaptive execution would read all archives in one task.
    tasks = min(max(1, archives.count()), 4 * int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return archives.repartition(tasks).mapInArrow(run, READ)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    named = [c.split() for c in READ.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[kind]) for k, (_, kind) in enumerate(named)], [n for n, _ in named])
