"""Exact removal of word windows that earlier documents hold, by a relative Lempel-Ziv parse.

Every window of ``window`` consecutive words is a reference block. The block's
reference is its first occurrence: the smallest doc_id that holds it, and the
word where it starts there. A document is parsed from the left against the
blocks of all documents with a smaller doc_id. At a word whose block has a
reference a factor begins; it grows as long as the next block's reference is the
next word of the same document, so it is a copy of that stretch of the
reference, at least ``window`` words long. The parse goes on behind it; a word
whose block has no reference is a literal. Blocks that begin in the last words
of a factor and reach over its end may be known from yet another document: they
are checked one by one. Factors and known boundary blocks together are the
duplicate spans whose words are removed, and they cover exactly the known blocks.

The index is distributed. Documents are cut into chunks of a few megabytes by
doc_id range, with borders at quantiles of the text's bytes; a chunk sends each
of its distinct block hashes once, with the place of its first occurrence, to
the bucket of the hash's upper bits, so a block shared by any number of
documents costs one entry a chunk. A bucket answers each entry with one bit,
known from an earlier chunk or not, and with the reference of the known ones.
Entries and answers travel as byte planes under Zstandard: hashes are sorted
and places are small numbers, so their upper bytes cost next to nothing. The
chunk, joined with its answers, settles the order inside itself and parses its
documents. Chunk and bucket sizes do not depend on the size of the corpus,
their numbers do; a doc_id that fills several chunks is split further by a hash
of the text, and a longer text than a chunk forms one by itself.

Defined results: null text has no words; a null doc_id comes after all
others; rows of one doc_id, repeated rows among them, count as one reference
and never remove each other's words; an empty table gives an empty result.
Blocks are equal when their 64-bit hashes are.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridemart.llm import tokens as tk
from ridemart.llm.frames import slim

WINDOW = 13
CHUNK_BYTES = 8 << 20     # text of a chunk, on average
BUCKET_BYTES = 8 << 20    # hashes of a bucket, on average
_LAST = (1 << 63) - 1
_SUB = 20                 # bits of a chunk number for the parts of one heavy doc_id

ENTRIES = "bucket int, chunk long, n int, entries binary"
ANSWERS = "chunk long, bucket int, n int, answers binary"
RESULT = ("doc_id long, n_words long, n_removed long, kept string, "
          "factors array<struct<start:int,length:int,ref_doc:long,ref_start:int>>, "
          "spans array<struct<start:int,length:int>>")


def chunked(docs: DataFrame, n_chunks: int, chunk_bytes: int) -> DataFrame:
    """Adds ``chunk``: a number that grows with doc_id. Borders are quantiles of doc_id over units of text, so that a row
    weighs as much as its text is long (the rest of a unit is rounded at random: it only moves borders)."""
    q = [i / n_chunks for i in range(1, n_chunks)]
    units = F.floor(F.octet_length("text") / max(1, chunk_bytes // 128) + F.rand(7)).cast("int")
    weighed = docs.select("id", units.alias("units")).where("units > 0").select("id", F.explode(F.sequence(F.lit(1), "units")))
    cuts = weighed.agg(F.percentile_approx("id", q, 10_000 if n_chunks < 2_000 else 5 * n_chunks)).first()[0] if q else []
    bounds, times = np.unique(np.array(cuts or [], np.int64), return_counts=True)
    parts = np.where(times > 1, times, 0)

    @F.pandas_udf("long")
    def number(ids: pd.Series, th: pd.Series) -> pd.Series:
        i = ids.to_numpy(np.int64)
        at = np.searchsorted(bounds, i, "right")
        heavy = np.zeros(len(i), np.int64)
        if len(bounds):
            equal = (at > 0) & (bounds[np.maximum(at - 1, 0)] == i)
            heavy = np.where(equal, parts[np.maximum(at - 1, 0)], 0)
        sub = np.where(heavy > 0, th.to_numpy(np.int64) % np.maximum(heavy, 1), 0)
        return pd.Series(((2 * at - (heavy > 0)) << _SUB) + sub)

    return docs.withColumn("chunk", number("id", "th"))


def _pack(values: np.ndarray) -> bytes:
    """Numbers as byte planes, upper bytes first."""
    kind = values.dtype.newbyteorder(">")
    return np.ascontiguousarray(values.astype(kind).view(np.uint8).reshape(len(values), kind.itemsize).T).tobytes()


def _unpack(raw: memoryview, n: int, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(raw, np.uint8, n * size).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(np.dtype(kind).newbyteorder(">")).reshape(n).astype(kind)


class _Chunk:
    """Words, block starts, block hashes and the distinct hashes of a chunk's documents, by (id, hash of the text)."""

    def __init__(self, table: pa.Table, window: int):
        self.table = table = table.sort_by([("id", "ascending"), ("th", "ascending")])
        counts, starts, hashes, words = [], [], [], []
        base = 0
        for _, t in tk.slices(table.column("text")):
            w = tk.Words(t, tk.BLANK_WORDS)
            s = tk.whole_starts(w.count, w.first, window)
            counts.append(w.count)
            starts.append(s + base)
            hashes.append(tk.grams_at(w.hash, window, s))
            words.append(w)
            base += len(w)
        self.words = words
        self.ids = np.asarray(table.column("id"))
        self.count = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.count)])
        self.start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        self.hash = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.doc = np.searchsorted(self.first, self.start, "right") - 1

    def place(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """doc_id and word of the given blocks."""
        doc = self.doc[at]
        return self.ids[doc], self.start[at] - self.first[doc]


def _entries(window: int, bits: int):
    def run(table: pa.Table) -> pa.Table:
        c = _Chunk(table, window)
        distinct, at = np.unique(c.hash, return_index=True)         # a block's first occurrence has the smallest doc_id
        ref, word = c.place(at)
        bucket = (distinct >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(distinct), np.int64)
        edge = np.searchsorted(bucket, np.arange((1 << bits) + 1))
        some = np.flatnonzero(np.diff(edge))
        chunk = table.column("chunk")[0].as_py()
        low = c.ids[:1]
        put = zstandard.ZstdCompressor(level=1).compress
        packed = [put(low.tobytes() + _pack(distinct[a:z]) + _pack((ref[a:z] - low).view(np.uint64)) + _pack(word[a:z].astype(np.uint32)))
                  for a, z in zip(edge[some], edge[some + 1])]
        return pa.table({"bucket": pa.array(some, pa.int32()), "chunk": pa.array(np.full(len(some), chunk)),
                         "n": pa.array(edge[some + 1] - edge[some], pa.int32()), "entries": pa.array(packed, pa.binary())})
    return run


def _answers(table: pa.Table) -> pa.Table:
    """Which entries of a bucket an earlier chunk has as well, and where the first of those has them."""
    table = table.sort_by("chunk")
    chunk, size = np.asarray(table.column("chunk")), np.asarray(table.column("n")).astype(np.int64)
    edge = np.concatenate([[0], np.cumsum(size)])
    h, ref, word = np.empty(edge[-1], np.uint64), np.empty(edge[-1], np.int64), np.empty(edge[-1], np.uint32)
    get, put = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(level=1).compress
    for x, a, z in zip(table.column("entries"), edge[:-1], edge[1:]):
        raw, n = memoryview(get(x.as_buffer())), z - a
        h[a:z] = _unpack(raw[8:], n, "u8")
        ref[a:z] = _unpack(raw[8 + 8 * n:], n, "u8").view(np.int64) + np.frombuffer(raw, np.int64, 1)
        word[a:z] = _unpack(raw[8 + 16 * n:], n, "u4")
    rank = np.repeat(chunk >> _SUB, size)
    by = np.argsort(h, kind="stable")                     # chunks of one hash stay in ascending order
    hs = h[by]
    head = np.concatenate([[True], hs[1:] != hs[:-1]])
    first = np.empty(len(h), np.int64)
    first[by] = by[np.flatnonzero(head)][np.cumsum(head) - 1]
    known = rank > rank[first]
    packed = []
    for a, z in zip(edge[:-1], edge[1:]):
        k = known[a:z]
        f = first[a:z][k]
        packed.append(put(np.packbits(k).tobytes() + _pack(ref[f].view(np.uint64)) + _pack(word[f])))
    return pa.table({"chunk": pa.array(chunk), "bucket": table.column("bucket"), "n": table.column("n"),
                     "answers": pa.array(packed, pa.binary())})


def _references(c: _Chunk, answers: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every block of a chunk: is it in a document with a smaller doc_id, and which one has it first and where."""
    distinct, at, index = np.unique(c.hash, return_index=True, return_inverse=True)
    ref, word = c.place(at)
    base, get = 0, zstandard.ZstdDecompressor().decompress
    for row in answers.sort_by("bucket").select(["n", "answers"]).to_pylist():
        n, raw = row["n"], memoryview(get(row["answers"]))
        bits = np.frombuffer(raw, np.uint8, (n + 7) // 8)
        some = base + np.flatnonzero(np.unpackbits(bits, count=n))
        ref[some] = _unpack(raw[len(bits):], len(some), "u8").view(np.int64)
        word[some] = _unpack(raw[len(bits) + 8 * len(some):], len(some), "u4")
        base += n
    ref, word = ref[index], word[index]
    return ref < c.ids[c.doc], ref, word


def parse(start: np.ndarray, doc: np.ndarray, ref: np.ndarray, word: np.ndarray, window: int):
    """Greedy factors of known blocks (word where they start, document, reference): the block each factor begins with,
    its length in words, and which blocks lie in no factor (those over factor boundaries)."""
    new = np.ones(len(start), bool)
    new[1:] = ((doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)
               | (ref[1:] != ref[:-1]) | (word[1:] != word[:-1] + 1))
    head = np.flatnonzero(new)
    stop = np.concatenate([head[1:], [len(start)]]) if len(head) else head
    begin, length, end = [], [], 0
    for i, a, n in zip(head.tolist(), start[head].tolist(), (stop - head).tolist()):
        skip = max(0, end - a)
        if skip < n:
            begin.append(i + skip)
            length.append(n - skip - 1 + window)
            end = a + n - 1 + window
    begin, length = np.array(begin, np.int64), np.array(length, np.int64)
    inside = np.zeros(len(start) + 1, np.int64)
    inside[begin] += 1
    np.add.at(inside, begin + length - window + 1, -1)
    return begin, length, np.cumsum(inside[:-1]) == 0


def _join_words(words: tk.Words, keep: np.ndarray, n: int) -> tuple[np.ndarray, bytes]:
    """Kept words of every text with one space between: text offsets and bytes."""
    a, size, doc = words.start[keep], (words.end - words.start)[keep], words.doc[keep]
    first = np.concatenate([[True], doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, bool)
    width = size + ~first
    end = np.cumsum(width)
    out = np.full(int(end[-1]) if len(end) else 0, 0x20, np.uint8)
    begin = end - size
    i = np.arange(int(size.sum()))
    shift = np.cumsum(size) - size
    out[i + np.repeat(begin - shift, size)] = words.data[i + np.repeat(a - shift, size)]
    per_text = np.bincount(doc, weights=width, minlength=n).astype(np.int64)
    return np.concatenate([[0], np.cumsum(per_text)]), out.tobytes()


def _lists(row: np.ndarray, n: int, fields: dict[str, np.ndarray]) -> pa.Array:
    """One list of structs for each of n rows, from fields in the order of their rows."""
    kinds = {"ref_doc": pa.int64()}
    items = pa.StructArray.from_arrays([pa.array(v, kinds.get(k, pa.int32())) for k, v in fields.items()], names=list(fields))
    off = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))])
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), items)


def _parse(window: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        c = _Chunk(docs, window)
        docs, ids = c.table, c.ids
        hit, ref, word = _references(c, answers)
        at, of, ref, word = c.start[hit], c.doc[hit], ref[hit], word[hit]
        begin, length, over = parse(at, of, ref, word, window)
        gone = tk.covered(np.concatenate([at[begin], at[over]]),
                          np.concatenate([length, np.full(int(over.sum()), window)]), int(c.first[-1]))
        factors = _lists(of[begin], len(ids), {"start": at[begin] - c.first[of[begin]], "length": length,
                                               "ref_doc": ref[begin], "ref_start": word[begin]})
        new = np.ones(len(at), bool)
        new[1:] = (of[1:] != of[:-1]) | (at[1:] != at[:-1] + 1)
        head = np.flatnonzero(new)
        spans = _lists(of[head], len(ids), {"start": at[head] - c.first[of[head]],
                                            "length": np.diff(np.concatenate([head, [len(at)]])) - 1 + window if len(head) else head})
        kept, base = [], 0
        for w in c.words:
            n = len(w.count)
            edge, raw = _join_words(w, ~gone[base:base + len(w)], n)
            kept.append(pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(edge), pa.py_buffer(raw)])
                        .cast(pa.binary()).cast(pa.string(), safe=False))
            base += len(w)
        removed = np.concatenate([[0], np.cumsum(gone)])[c.first]
        return pa.table({"doc_id": docs.column("doc_id"), "n_words": pa.array(c.count, pa.int64()),
                         "n_removed": pa.array(np.diff(removed), pa.int64()), "kept": pa.chunked_array(kept, pa.string()),
                         "factors": factors, "spans": spans})
    return run


def remove_earlier(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per document: n_words, n_removed, kept (remaining words), the factors of the parse (first word, words, and
    the doc_id and word they copy) and the spans of neighbouring known blocks that factors and boundary blocks make up."""
    rows = slim(docs, id_col, text_col).select(
        F.coalesce("doc_id", F.lit(_LAST)).alias("id"), F.xxhash64("text").alias("th"), "doc_id", "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1.0, size * 8 / 6 / bucket_bytes))))       # a word is about six bytes
    parts = chunked(rows, max(1, math.ceil(size / chunk_bytes)), chunk_bytes).select("chunk", "id", "th", "doc_id", "text")
    entries = parts.groupBy("chunk").applyInArrow(_entries(window, bits), ENTRIES)
    answers = entries.groupBy("bucket").applyInArrow(_answers, ANSWERS)
    return (parts.groupBy("chunk").cogroup(answers.groupBy("chunk"))
            .applyInArrow(_parse(window), RESULT))


def digest(result: DataFrame) -> DataFrame:
    """The words left by their hash; ``n_factors`` counts the joined spans."""
    return result.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
                         F.size("spans").cast("long").alias("n_factors"))
