"""Exact removal of repeated byte strings by sampled hashes and one pair step.

A byte is removed if a string of ``threshold`` bytes covering it also starts
anywhere else. Of prefix doubling this keeps one step: positions are keyed by
a hash of their first h = threshold / 2 bytes, those with a unique key are
dropped, and the rest is keyed by the pair (key, key h further on), which covers
the threshold. Nothing is sorted, and there are no further rounds.

Keying every position would send a hash and a position, 16 bytes before
compression, for each byte of the corpus (a count, not a measurement), so the
first round (h = threshold / 2) ranks sampled positions only: for every
possible start s, the position with the smallest hash among the
``threshold - h + 1`` positions whose first h bytes lie inside the string.
The choice depends on the string's content alone, so equal strings choose the
same place, and consecutive starts share one sampled position: about one in a
hundred is ranked. What a sampled position stands for is a run of starts; if
the bytes of the whole run (with the sampled place) occur again, every string
starting in it does, and the run is settled as it is. Runs whose sampled rank
repeats in other surroundings go to the second round: one copy of each
distinct run is fetched, all its starts are ranked by pairs (h bytes, h bytes
further on) and compared with the others of the same sampled rank.

Ranks are 64-bit hashes; what repeats inside a task's slice is settled there,
and counts are added up on the map side, so a very large group of copies or a
periodic text costs a row for each slice. The second
round of a rank with very many distinct surroundings runs as a Spark
aggregation of single starts instead of inside one task.

:func:`doubled_starts` is prefix doubling in full, as rows of Spark: every
position is ranked by its first bytes, (position, rank) rows are sorted
together with those ``h`` bytes further on, pairs of ranks become the ranks of
twice the length, and unique positions are dropped, until the threshold is
reached. It gives the same spans (``remove_repeats(..., doubling=True)``) at
some rows for each byte of text; README has the figures of both.

Defined results: null counts as the empty text; repeated rows repeat each
other and are removed like any copy; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridemart.llm import tokens as tk
from ridemart.llm.frames import keyed, materialize

THRESHOLD = 400
FIRST_BYTES = 25          # length of the first ranks of prefix doubling
STARTS = 1 << 16          # positions a batch of rows holds
HOT_RUNS = 5_000          # distinct surroundings of one rank that a task may hold

RUNS = "id long, th long, rank long, body long, start int, n int, times int"
BLOCK = "rank long, hot boolean, single boolean, id long, th long, start int, block binary"
SPANS = "id long, th long, start int, n int"


def sampled_runs(t: tk.Texts, size: int):
    """Runs of string starts of a slice: text, first start, number, rank of the sampled place, hash of the run."""
    h = size // 2
    starts = tk.whole_starts(np.diff(t.off), t.off, size)
    if not len(starts):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    span = tk.SpanHash(t.data)
    rank = span.fixed(h)
    at = tk.sliding_argmin(rank, size - h + 1)[starts]
    new = np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)])
    first = np.flatnonzero(new)
    lo, n = starts[first], np.diff(np.concatenate([first, [len(starts)]]))
    place = at[first]
    body = tk.mix(span(lo, lo + n - 1 + size) ^ tk.mix((place - lo).astype(np.uint64) + np.uint64(1)))
    doc = np.searchsorted(t.off, lo, "right") - 1
    return doc, lo - t.off[doc], n, rank[place], body


def _find_runs(size: int):
    """Runs of every text. What repeats inside a slice is settled there: its spans (``times`` 0, no rank) and,
    for the others to compare with, one run with the number of times."""
    def run(batches):
        for b in batches:
            for lo, t in tk.slices(b.column(2)):
                doc, start, n, rank, body = sampled_runs(t, size)
                _, at, index, times = np.unique(body, return_index=True, return_inverse=True, return_counts=True)
                many = np.flatnonzero(times[index] > 1)
                d, s, k = _merged(doc[many], start[many], n[many])
                none = pa.nulls(len(d), pa.int64())
                row = pa.array(d + lo)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(row), b.column(1).take(row), none, none, pa.array(s, pa.int32()), pa.array(k, pa.int32()),
                     pa.array(np.zeros(len(d)), pa.int32())], names=_RUN_NAMES)
                row = pa.array(doc[at] + lo)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(row), b.column(1).take(row), pa.array(tk.as_long(rank[at])), pa.array(tk.as_long(body[at])),
                     pa.array(start[at], pa.int32()), pa.array(n[at], pa.int32()), pa.array(times, pa.int32())], names=_RUN_NAMES)
    return run


_RUN_NAMES = [f.split()[0] for f in RUNS.split(", ")]


def _merged(doc: np.ndarray, start: np.ndarray, n: np.ndarray):
    """Spans that follow one another in a text, as one."""
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + n[:-1])
    head = np.flatnonzero(new)
    upto = np.concatenate([[0], np.cumsum(n)])
    return doc[head], start[head], upto[np.concatenate([head[1:], [len(doc)]])] - upto[head] if len(doc) else n


def _cut_blocks(size: int):
    """Bytes of the wanted runs of every text."""
    def run(batches):
        for b in batches:
            rows = {k: [] for k in ("rank", "hot", "single", "id", "th", "start", "block")}
            held = 0
            for i, th, text, wanted in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist()):
                raw = text.as_buffer().to_pybytes()
                for w in wanted:
                    block = raw[w["start"]:w["start"] + w["n"] - 1 + size]
                    for k, v in zip(rows, (w["rank"], w["hot"], w["single"], i, th, w["start"], block)):
                        rows[k].append(v)
                    held += len(block)
                if held > 1 << 22:
                    yield _block_batch(rows)
                    rows, held = {k: [] for k in rows}, 0
            if held:
                yield _block_batch(rows)
    return run


def _block_batch(rows):
    kinds = (pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds)], names=list(rows))


def pair_ranks(blocks: pa.Array, size: int):
    """(block number, offset, rank) of every string start: the pair of its two halves' ranks."""
    out = []
    blocks = blocks.cast(pa.large_binary())
    lens = np.asarray(pc.binary_length(blocks))
    ends = np.cumsum(lens)
    i = 0
    while i < len(blocks):
        base = ends[i - 1] if i else 0
        j = max(int(np.searchsorted(ends, base + tk.SLICE_BYTES, "right")), i + 1)
        t = tk.Texts(blocks.slice(i, j - i), binary=True)
        h = size // 2
        half = tk.SpanHash(t.data).fixed(h)
        s = tk.whole_starts(np.diff(t.off), t.off, size)
        doc = np.searchsorted(t.off, s, "right") - 1
        rank = tk.mix(half[s] * np.uint64(0x9E3779B97F4A7C15) + half[s + (size - h)])
        out.append((doc + i, s - t.off[doc], rank))
        i = j
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)


def _spans_of(block: np.ndarray, at: np.ndarray):
    """Maximal runs of consecutive offsets inside a block: block, first offset, number."""
    new = np.concatenate([[True], (block[1:] != block[:-1]) | (at[1:] != at[:-1] + 1)])
    first = np.flatnonzero(new)
    return block[first], at[first], np.diff(np.concatenate([first, [len(at)]]))


def _compare(size: int):
    """All blocks of a rank are in this partition: starts whose pair occurs twice, for blocks that occur once."""
    def run(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got)
        ids, ths, start = (t.column(c).combine_chunks() for c in ("id", "th", "start"))
        single = np.asarray(t.column("single").combine_chunks().cast(pa.int8())) == 1
        parts, base = [], 0
        for chunk in t.column("block").chunks:
            block, at, rank = pair_ranks(chunk, size)
            parts.append((block + base, at, rank))
            base += len(chunk)
        block, at, rank = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(rank)
        r = rank[order]
        twice = np.zeros(len(r), bool)
        same = r[1:] == r[:-1]
        twice[1:] |= same
        twice[:-1] |= same
        hit = np.zeros(len(r), bool)
        hit[order] = twice
        hit &= single[block]
        if hit.any():
            block, at, n = _spans_of(block[hit], at[hit])
            row = pa.array(block)
            yield pa.RecordBatch.from_arrays(
                [ids.take(row), ths.take(row), pa.array(np.asarray(start)[block] + at, pa.int32()), pa.array(n, pa.int32())],
                names=["id", "th", "start", "n"])
    return run


def _single_starts(size: int):
    def run(batches):
        for b in batches:
            col = b.schema.get_field_index
            block, at, rank = pair_ranks(b.column(col("block")), size)
            row = pa.array(block)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tk.as_long(rank)), b.column(col("single")).take(row), b.column(col("id")).take(row),
                 b.column(col("th")).take(row), pa.array(np.asarray(b.column(col("start")))[block] + at, pa.int32())],
                names=["pair", "single", "id", "th", "start"])
    return run


def _remove(size: int):
    def run(batches):
        for b in batches:
            col = b.schema.get_field_index
            texts, hits = b.column(col("text")), b.column(col("hits"))
            for lo, t in tk.slices(texts):
                part = hits.slice(lo, t.n)
                count = np.asarray(part.value_lengths().fill_null(0))
                flat = part.flatten()
                doc = np.repeat(np.arange(t.n), count)
                s = t.off[doc] + np.asarray(flat.field(0)).astype(np.int64)
                gone = tk.covered(s, np.asarray(flat.field(1)).astype(np.int64) - 1 + size, len(t.data))
                keep = ~gone
                kept_upto = np.concatenate([[0], np.cumsum(keep)])[t.off]
                edge = np.zeros(len(gone), bool)                     # a removed run ends with its text
                edge[t.off[:-1][np.diff(t.off) > 0]] = True
                begin = gone & (np.concatenate([[True], ~gone[:-1]]) | edge)
                stop = gone & (np.concatenate([~gone[1:], [True]]) | np.concatenate([edge[1:], [True]]))
                a, z = np.flatnonzero(begin), np.flatnonzero(stop) + 1
                of = np.searchsorted(t.off, a, "right") - 1
                spans = pa.StructArray.from_arrays([pa.array(a - t.off[of], pa.int64()), pa.array(z - t.off[of], pa.int64())],
                                                   names=["start", "stop"])
                off = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=t.n))])
                kept = pa.Array.from_buffers(pa.binary(), t.n, [None, pa.py_buffer(kept_upto.astype(np.int32)),
                                                                pa.py_buffer(t.data[keep].tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [b.column(col("doc_id")).slice(lo, t.n), pa.array(np.diff(t.off)), kept,
                     pa.ListArray.from_arrays(pa.array(off, pa.int32()), spans)],
                    names=["doc_id", "n_bytes", "kept", "spans"])
    return run


def repeated_spans(docs: DataFrame, size: int, hot_runs: int = HOT_RUNS) -> DataFrame:
    """(id, th, start, n): starts of strings of ``size`` bytes that also start elsewhere; ``docs`` is keyed()."""
    texts = docs.select("id", "th", "text")
    found = materialize(texts.mapInArrow(_find_runs(size), RUNS), "runs")
    again = found.where("times > 0").groupBy("rank").agg(F.sum("times").alias("c")).where("c > 1").select("rank")
    alive = materialize(found.join(again, "rank", "left_semi"), "alive")
    bodies = alive.groupBy("rank", "body").agg(F.sum("times").alias("c"), F.min(F.struct("id", "th", "start", "n")).alias("one"))
    bodies = materialize(bodies, "bodies")
    settled = (alive.where("times = 1").join(bodies.where("c > 1").select("rank", "body"), ["rank", "body"], "left_semi")
               .select("id", "th", "start", "n").union(found.where("times = 0").select("id", "th", "start", "n")))
    ranks = bodies.groupBy("rank").agg(F.count("*").alias("k"), F.min("c").alias("least")).where("k > 1 and least = 1")
    wanted = (bodies.join(ranks, "rank")
              .select("one.id", "one.th", F.struct("rank", (F.col("k") > hot_runs).alias("hot"), (F.col("c") == 1).alias("single"),
                                                   "one.start", "one.n").alias("w"))
              .groupBy("id", "th").agg(F.collect_list("w").alias("wanted")))
    once = texts.join(wanted, ["id", "th"]).dropDuplicates(["id", "th"]).select("id", "th", "text", "wanted")
    blocks = materialize(once.mapInArrow(_cut_blocks(size), BLOCK), "blocks")
    few = (blocks.where("not hot").repartition("rank")
           .mapInArrow(_compare(size), SPANS))
    starts = blocks.where("hot").mapInArrow(_single_starts(size), "pair long, single boolean, id long, th long, start int")
    twice = starts.groupBy("pair").count().where("count > 1").select("pair")
    many = (starts.where("single").join(twice, "pair", "left_semi")
            .select("id", "th", "start", F.lit(1).alias("n")))
    return settled.unionByName(few).unionByName(many)


def _all_starts(h: int):
    """Every position with h bytes after it, ranked by their hash."""
    def run(batches):
        for b in batches:
            col = b.schema.get_field_index
            for lo, t in tk.slices(b.column(col("text"))):
                at = tk.whole_starts(np.diff(t.off), t.off, h)
                rank = tk.SpanHash(t.data).fixed(h)[at] if len(at) else np.zeros(0, np.uint64)
                doc = np.searchsorted(t.off, at, "right") - 1
                for i in range(0, len(at), STARTS):
                    part = slice(i, i + STARTS)
                    row = pa.array(doc[part] + lo)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(col(c)).take(row) for c in ("id", "th", "times")]
                        + [pa.array(at[part] - t.off[doc[part]], pa.int32()), pa.array(tk.as_long(rank[part]))],
                        names=["id", "th", "times", "start", "rank"])
    return run


def _not_unique(ranked: DataFrame) -> DataFrame:
    """Positions whose rank another position has too; counts are added up before the shuffle."""
    again = ranked.groupBy("rank").agg(F.sum("times").alias("c")).where("c > 1").select("rank")
    return materialize(ranked.join(again, "rank", "left_semi").select("id", "th", "times", "start", "rank"), "ranks")


def doubled_starts(docs: DataFrame, size: int, first: int = FIRST_BYTES) -> DataFrame:
    """(id, th, start, n) of every string of ``size`` bytes that also starts elsewhere, by prefix doubling; ``docs`` is keyed().

    Repeated rows are ranked once and count as often as they occur. A position with a unique rank has no equal at
    any greater length, nor has a position whose pair holds it, so an inner join drops both.
    """
    h = min(first, size)
    texts = docs.groupBy("id", "th").agg(F.count("*").alias("times"), F.first("text").alias("text"))
    alive = _not_unique(texts.mapInArrow(_all_starts(h), "id long, th long, times long, start int, rank long"))
    while h < size:
        step = min(h, size - h)
        ahead = alive.select("id", "th", (F.col("start") - step).alias("start"), F.col("rank").alias("ahead"))
        pairs = alive.join(ahead.hint("merge"), ["id", "th", "start"])
        alive = _not_unique(pairs.select("id", "th", "times", "start", F.xxhash64("rank", "ahead").alias("rank")))
        h += step
    return alive.select("id", "th", "start", F.lit(1).alias("n"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD,
                   hot_runs: int = HOT_RUNS, doubling: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, kept (the remaining bytes) and the removed spans [start, stop)."""
    rows = keyed(docs, id_col, text_col)
    spans = doubled_starts(rows, threshold) if doubling else repeated_spans(rows, threshold, hot_runs)
    hits = spans.groupBy("id", "th").agg(F.collect_set(F.struct("start", "n")).alias("hits"))
    return (rows.join(hits, ["id", "th"], "left").select("doc_id", "text", "hits")
            .mapInArrow(_remove(threshold), "doc_id long, n_bytes long, kept binary, spans array<struct<start:long,stop:long>>"))


def digest(result: DataFrame) -> DataFrame:
    return result.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
