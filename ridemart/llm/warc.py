"""WARC archives of web pages, compressed record by record with a dictionary of the archive's own.

Pages become WARC/1.1 records. Of the records with equal payloads (by SHA-256
and length) of at least ``min_revisit`` bytes the one with the smallest
page_id is a *response*, the others are *revisits* without a payload that name
it; shorter payloads are always responses. Only (digest, page_id) of the pages
is shuffled for that. The few digests that occur again are joined back:
broadcast while they are at most ``BROADCAST_MAX_ROWS``, else a shuffle join,
in which AQE splits a hot digest.

Each task streams its pages into ``.warc.zst`` files of about
``archive_bytes`` of payload. The first ``SAMPLE_BYTES`` of a file's records
are held back, a Zstandard dictionary is trained on them and written as a
leading skippable frame (magic number 0x184D2A5D), then a warcinfo record and
every page record follow as frames of their own, so that a record can be read
alone at its offset. Where a dictionary can't be trained (a handful of
records), the file has no such frame and the records are compressed without.

A file is written under the attempt's own name and renamed when complete, so
a rerun task replaces the file it wrote before and no half-written archive is
ever listed. The index (page_id, file, offset, length, dictionary bytes) is
kept as Parquet beside the archives.

Defined results: null html is an empty payload; a null url writes no target
address; a null page_id writes no id, sorts after all others and comes back as
null; rows that repeat a page_id with the same payload are all what the first
of them is (all responses, or all revisits of the smaller id); an empty table
writes no archive. Characters that would break a header line are
percent-encoded.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridemart.llm.frames import ship
from ridemart.llm.storage import opened, qualified
from ridemart.plans.joins import maybe_broadcast
from ridemart.session import scratch_path

MIN_REVISIT = 100             # payload bytes from which an equal payload becomes a revisit
ARCHIVE_BYTES = 256 << 20     # payload of one archive file
DICTIONARY_BYTES = 112_640
SAMPLE_BYTES = 8 << 20        # records of a file that its dictionary is trained on
LEVEL = 6
DICTIONARY_MAGIC = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"  # the tables carry no fetch time; a fixed one keeps archives repeatable
_LAST = (1 << 63) - 1

INDEX = "page_id long, record_type string, file string, offset long, length long, dictionary_bytes int"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def planned(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            min_revisit: int = MIN_REVISIT) -> DataFrame:
    """(page_id, url, html, digest, refers_to) of every page; refers_to is null for a response."""
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    own = F.coalesce("page_id", F.lit(_LAST))
    first = (rows.where(F.octet_length("html") >= min_revisit)
             .groupBy("digest").agg(F.min(own).alias("first"), F.max(own).alias("last"))
             .where("first < last").select("digest", "first"))
    joined = rows.join(maybe_broadcast(first), "digest", "left")
    return joined.select("page_id", "url", "html", "digest", F.when(own > F.col("first"), F.col("first")).alias("refers_to"))


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page {page_id}')}>"


def _address(url: str) -> str:
    return "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record(page_id, url, html: str, digest: str, refers_to) -> bytes:
    """One WARC record with its HTTP header block (and its payload, for a response)."""
    payload = html.encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    kind = "response" if refers_to is None else "revisit"
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if url is not None:
        head.append(f"WARC-Target-URI: {_address(url)}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-Id: {refers_to}"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _info(name: str) -> bytes:
    block = b"format: WARC File Format 1.1\r\n"
    head = ("WARC/1.1\r\nWARC-Type: warcinfo\r\n"
            f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, name)}>\r\nWARC-Date: {DATE}\r\nWARC-Filename: {name}\r\n"
            f"Content-Type: application/warc-fields\r\nContent-Length: {len(block)}\r\n\r\n")
    return head.encode() + block + b"\r\n\r\n"


def trained(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary for the samples, or nothing where they are too few to train one."""
    size = min(size, sum(map(len, samples)) // 8)
    if size < 1024 or len(samples) < 8:
        return b""
    try:
        return zstandard.train_dictionary(size, samples, k=512, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


class _Archive:
    """One open archive: holds the first records back until a dictionary is trained on them."""

    def __init__(self, folder: str, name: str, attempt: int, level: int):
        self.store, self.base = opened(folder)
        self.name, self.level, self.temp = name, level, f"{self.base}/.{name}.{attempt}"
        self.held, self.held_bytes, self.payload, self.index = [], 0, 0, []
        self.out = None

    def add(self, page_id, kind: str, raw: bytes, sample_bytes: int) -> None:
        self.payload += len(raw)
        if self.out is not None:
            return self._put(page_id, kind, raw)
        self.held.append((page_id, kind, raw))
        self.held_bytes += len(raw)
        if self.held_bytes >= sample_bytes:
            self._begin()

    def _begin(self) -> None:
        dictionary = trained([raw for _, _, raw in self.held])
        self.out, self.at, self.dictionary_bytes = self.store.open_output_stream(self.temp), 0, len(dictionary)
        if dictionary:
            self._write(DICTIONARY_MAGIC.to_bytes(4, "little") + len(dictionary).to_bytes(4, "little") + dictionary)
        self.press = zstandard.ZstdCompressor(level=self.level, write_checksum=True, write_content_size=True,
                                              dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        if dictionary:
            self.press = zstandard.ZstdCompressor(dict_data=self._digested(dictionary), level=self.level, write_checksum=True,
                                                  write_content_size=True)
        self._write(self.press.compress(_info(self.name)))
        for x in self.held:
            self._put(*x)
        self.held = []

    def _digested(self, dictionary: bytes) -> zstandard.ZstdCompressionDict:
        d = zstandard.ZstdCompressionDict(dictionary)
        d.precompute_compress(level=self.level)          # once a file, not once a record
        return d

    def _write(self, raw: bytes) -> None:
        self.out.write(raw)
        self.at += len(raw)

    def _put(self, page_id, kind: str, raw: bytes) -> None:
        frame = self.press.compress(raw)
        self.index.append((page_id, kind, self.name, self.at, len(frame), self.dictionary_bytes))
        self._write(frame)

    def close(self) -> None:
        if self.out is None:
            self._begin()
        self.out.close()
        self.store.move(self.temp, f"{self.base}/{self.name}")


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows), fields)], names=[n for n, _ in fields])


def _write(folder: str, archive_bytes: int, sample_bytes: int, level: int):
    def run(batches):
        task, n, archive = TaskContext.get(), 0, None
        for b in batches:
            for page_id, url, html, digest, refers_to in zip(*(b.column(i) for i in range(5))):
                page_id, url, refers_to = page_id.as_py(), url.as_py(), refers_to.as_py()
                if archive is None:
                    archive = _Archive(folder, f"pages-{task.partitionId():06d}-{n:04d}.warc.zst", task.taskAttemptId(), level)
                    n += 1
                archive.add(page_id, "response" if refers_to is None else "revisit",
                            record(page_id, url, html.as_py(), digest.as_py(), refers_to), sample_bytes)
                if archive.payload >= archive_bytes:
                    archive.close()
                    yield _batch(archive.index, INDEX)
                    archive = None
        if archive is not None:
            archive.close()
            yield _batch(archive.index, INDEX)
    return run


def write_archives(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", archive_bytes: int = ARCHIVE_BYTES, sample_bytes: int = SAMPLE_BYTES,
                   level: int = LEVEL, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write the pages as archives under ``folder``/archives; returns the index (kept in ``folder``/index).

    ``folder`` is new or empty, on storage that the driver and all executors share.
    """
    spark = pages.sparkSession
    ship(spark)
    folder = qualified(spark, folder or scratch_path(spark, "llm-warc"))
    store, base = opened(folder)
    store.create_dir(f"{base}/archives", recursive=True)
    rows = planned(pages, id_col, url_col, html_col, min_revisit)
    (rows.mapInArrow(_write(f"{folder}/archives", archive_bytes, sample_bytes, level), INDEX)
     .withColumn("file", F.concat(F.lit(f"{folder}/archives/"), "file")).write.parquet(f"{folder}/index"))
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def _dictionary(f) -> bytes:
    """The dictionary of the leading skippable frame; leaves the file at the first record."""
    head = f.read(8)
    if len(head) == 8 and int.from_bytes(head[:4], "little") == DICTIONARY_MAGIC:
        return f.read(int.from_bytes(head[4:], "little"))
    f.seek(0)
    return b""


def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def frames(f, chunk: int = 1 << 20):
    """The decompressed records of an open archive, one frame after the other."""
    press, rest = _decompressor(_dictionary(f)), b""
    while True:
        rest = rest or f.read(chunk)
        if not rest:
            return
        one, parts = press.decompressobj(), []
        while not one.eof:
            if not rest and not (rest := f.read(chunk)):
                raise ValueError("the archive ends inside a record")
            parts.append(one.decompress(rest))
            rest = one.unused_data if one.eof else b""
        yield b"".join(parts)


_LINE = re.compile(rb"([^:\r\n]+): ?([^\r\n]*)\r\n")


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record; wrong lengths are errors."""
    end = raw.index(b"\r\n\r\n") + 4
    if not raw.startswith(b"WARC/1.1\r\n"):
        raise ValueError("not a WARC record")
    head = {k.decode().lower(): v.decode() for k, v in _LINE.findall(raw[10:end - 2])}
    block = raw[end:-4]
    if len(block) != int(head["content-length"]) or raw[-4:] != b"\r\n\r\n":
        raise ValueError(f"record {head.get('warc-record-id')} has a block of {len(block)} bytes")
    return head, block


def described(raw: bytes) -> tuple | None:
    """(page_id, payload_bytes, digest, type, refers_to) of a page record; a response's payload is hashed again."""
    head, block = parsed(raw)
    kind = head["warc-type"]
    if kind == "warcinfo":
        return None
    end = block.index(b"\r\n\r\n") + 4
    size = int(dict(_LINE.findall(block[:end - 2]))[b"Content-Length"])
    digest = head["warc-payload-digest"].removeprefix("sha256:")
    if kind == "response" and (len(block) - end != size or hashlib.sha256(block[end:]).hexdigest() != digest):
        raise ValueError(f"record {head['warc-record-id']} does not hold its payload")
    number = {k: int(head[k]) if k in head else None for k in ("x-page-id", "x-refers-to-page-id")}
    return number["x-page-id"], size, digest, kind, number["x-refers-to-page-id"]


def _read(batches):
    for b in batches:
        for name in b.column(0).to_pylist():
            store, path = opened(name)
            rows = []
            with store.open_input_file(path) as f:
                for raw in frames(f):
                    if (row := described(raw)) is not None:
                        rows.append(row)
                    if len(rows) >= 10_000:
                        yield _batch(rows, RECORDS)
                        rows = []
            if rows:
                yield _batch(rows, RECORDS)


def read_archives(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Every page record of the archives named in the column ``file``, one archive a task at a time."""
    ship(spark)
    names = files.select("file").distinct()
    # more tasks than Spark would give a short list of names: each stands for a file of many megabytes
    return names.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file").mapInArrow(_read, RECORDS)


def read_record(file: str, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """Header and block of the single record that the index places at ``offset``."""
    store, path = opened(file)
    with store.open_input_file(path) as f:
        dictionary = _dictionary(f)
        f.seek(offset)
        return parsed(_decompressor(dictionary).decompress(f.read(length)))
