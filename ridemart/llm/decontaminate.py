"""Benchmark decontamination by winnowing.

Training and test texts are cut into words; in every window of
``window - gram + 1`` consecutive word grams the one with the smallest hash is
kept as a fingerprint, so any shared span of ``window`` words shares a
fingerprint. Fingerprints of the test set go into a bitmap of fixed size
(``BITMAP_BITS``; a larger test set makes it denser, never longer), which
drops most training fingerprints where they are made. What is left is
extended to whole windows and joined exactly with the windows of the test
set, by shuffle. Test items shorter than a window are one window of their own
length, looked up for each such length.

Defined results: null or empty text has no words, is never contaminated and
gets ``n_items`` 0; repeated rows and repeated doc_ids give one result row
each; test rows with a null text have no window, with a null item_id they
hit but are not listed; an empty test set hits nothing. Window equality is
equality of a 64-bit hash of the window's word hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridemart.llm import tokens as tk
from ridemart.llm.frames import keyed, materialize, slim

WINDOW = 13
GRAM = 5
BITMAP_BITS = 24

ITEM_SCHEMA = "item_id long, h long, length int, fp long"
DOC_SCHEMA = "doc_id long, id long, th long, n_words long, start array<int>, length array<int>, h array<long>"


def _windows(w: tk.Words, window: int, gram: int):
    """Starts of the whole windows and the fingerprint position each one keeps."""
    starts = tk.whole_starts(w.count, w.first, window)
    if not len(starts):
        return starts, starts, np.zeros(0, np.uint64)
    g = tk.grams(w.hash, gram)
    return starts, tk.sliding_argmin(g, window - gram + 1)[starts], g


def _item_rows(window: int, gram: int):
    def run(batches):
        for b in batches:
            ids = b.column(0)
            for lo, t in tk.slices(b.column(1)):
                w = tk.Words(t, tk.ALNUM_WORDS, lower=True)
                starts, at, g = _windows(w, window, gram)
                h, n = tk.grams_at(w.hash, window, starts), np.full(len(starts), window)
                doc, fp = w.doc[starts], g[at] if len(at) else np.zeros(0, np.uint64)
                parts = [(doc, h, n, fp)]
                for size in np.unique(w.count[(w.count > 0) & (w.count < window)]):
                    d = np.flatnonzero(w.count == size)
                    hs = tk.grams_at(w.hash, int(size), w.first[d])
                    parts.append((d, hs, np.full(len(d), size), hs))
                doc, h, n, fp = (np.concatenate(x) for x in zip(*parts))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(doc + lo)), pa.array(tk.as_long(h)), pa.array(n, pa.int32()),
                     pa.array(tk.as_long(fp))], names=["item_id", "h", "length", "fp"])
    return run


def _doc_rows(bitmap: bytes, sizes: list[int], window: int, gram: int):
    def run(batches):
        bits = np.frombuffer(bitmap, np.uint8)

        def hit(h):
            i = (h >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
            return (bits[i >> 3] >> (i & 7).astype(np.uint8)) & 1 == 1

        for b in batches:
            for lo, t in tk.slices(b.column(3)):
                w = tk.Words(t, tk.ALNUM_WORDS, lower=True)
                starts, at, g = _windows(w, window, gram)
                keep = hit(g)[at] if len(at) else np.zeros(0, bool)
                starts = starts[keep]
                parts = [(starts, np.full(len(starts), window), tk.grams_at(w.hash, window, starts))]
                for size in sizes:
                    s = tk.whole_starts(w.count, w.first, size)
                    hs = tk.grams_at(w.hash, size, s)
                    s, hs = s[hit(hs)], hs[hit(hs)]
                    parts.append((s, np.full(len(s), size), hs))
                s, n, h = (np.concatenate(x) for x in zip(*parts))
                doc = w.doc[s]
                order = np.argsort(doc, kind="stable")
                counts = np.bincount(doc, minlength=t.n)
                local = (s - w.first[doc])[order]
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c).slice(lo, t.n) for c in range(3)), pa.array(w.count.astype(np.int64)),
                     tk.list_array(local.astype(np.int32), counts, pa.int32()),
                     tk.list_array(n[order].astype(np.int32), counts, pa.int32()),
                     tk.list_array(tk.as_long(h[order]), counts, pa.int64())],
                    names=["doc_id", "id", "th", "n_words", "start", "length", "h"])
    return run


def _bitmap(items: DataFrame) -> bytes:
    """Fixed-size bitmap of the fingerprints, put together by one aggregation of bounded output."""
    bucket = F.shiftrightunsigned("fp", 64 - BITMAP_BITS)
    rows = (items.select(F.shiftright(bucket, 5).alias("word"),
                         F.expr(f"shiftleft(1L, cast(shiftrightunsigned(fp, {64 - BITMAP_BITS}) & 31 as int))").alias("bit"))
            .groupBy("word").agg(F.bit_or("bit").alias("bits")).collect())       # at most 2^(BITMAP_BITS-5) rows
    out = np.zeros(1 << (BITMAP_BITS - 5), np.uint32)
    for r in rows:
        out[r["word"]] = r["bits"]
    return out.astype("<u4").tobytes()


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text",
                  window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per document: n_words, n_hit, items (sorted ids as strings), spans of hit words, and its row key (id, th)."""
    items = materialize(slim(benchmark, item_col, item_text_col).withColumnRenamed("doc_id", "item_id")
                        .mapInArrow(_item_rows(window, gram), ITEM_SCHEMA), "items")
    sizes = sorted(r[0] for r in items.where(F.col("length") < window).select("length").distinct().collect())
    found = materialize(
        keyed(docs, id_col, text_col).select("doc_id", "id", "th", "text").mapInArrow(_doc_rows(_bitmap(items), sizes, window, gram), DOC_SCHEMA)
        .withColumn("row", F.monotonically_increasing_id()), "fingerprints")
    hits = (found.where(F.size("h") > 0)
            .select("row", F.explode(F.arrays_zip("start", "length", "h")).alias("x"))
            .select("row", "x.start", "x.length", "x.h"))
    exact = items.select("h", "length").distinct()
    spans = (hits.join(exact, ["h", "length"], "left_semi")
             .groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "length"))).alias("spans")))
    listed = (hits.select("row", "h", "length").distinct()
              .join(items.where("item_id is not null").select("h", "length", "item_id").distinct(), ["h", "length"])
              .select("row", F.col("item_id").cast("string").alias("item")).distinct()
              .groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items")))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto")),
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0), x["start"] + x["length"] - F.greatest(acc["upto"], x["start"]))).alias("n"),
            F.greatest(acc["upto"], x["start"] + x["length"]).alias("upto")), lambda acc: acc["n"].cast("long"))
    return (found.select("row", "doc_id", "id", "th", "n_words").join(spans, "row", "left").join(listed, "row", "left")
            .select("doc_id", "id", "th", "n_words", F.coalesce(covered, F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"), "spans"))


def contaminated() -> F.Column:
    """The verdict on a row of :func:`contamination`: at least a twentieth of the words is hit."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))


def digest(result: DataFrame) -> DataFrame:
    return result.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), contaminated().alias("contaminated"))
