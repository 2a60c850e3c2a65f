"""Near-duplicate documents by an exact grouped prefix join on word n-grams.

A document's set holds its distinct 5-word shingles; two documents link when
the Jaccard similarity of their sets is 0.8 or more. Shingles are ordered from
rare to frequent (counts over all documents, kept in a sketch of fixed size;
the order is the same for every document whatever the sketch's precision, so
the join stays exact). Linked sets share a shingle among the first
``n - ceil(0.8 n) + 1`` of each.

1. Documents with the same set are one class; classes with the same prefix and
   size are one group. Only groups enter the inverted lists of prefix
   shingles, packed by hash bucket.
2. Group pairs of a list pass the length and the positional filter. In short
   lists every group first meets one partner only, the pivot (the smallest
   group of a list) it shares most lists with; in long lists a few pivots, the
   same for all lists of a family, meet all others. Members of these pairs are
   verified and joined into components; long lists that still hold several
   components take further turns with other pivots, as long as pivots link
   with a fair part of what they meet.
3. Whatever candidate pairs then lie in different components are expanded to
   members and verified too. So every candidate pair is verified or already
   connected: no link between components is lost, while a group of thousands
   of near copies costs a few verifications a member.

Long lists (of more than ``SMALL_LIST`` groups) are kept as rows; a list that
the sketch shows to be very long never enters one task as a whole.

Defined results: null or empty text has the empty set, links with nothing and
is its own component; texts of fewer than five words have one shingle;
repeated rows share a component; a null doc_id takes its component's smallest
doc_id, if any; an empty table gives an empty result. Shingles are equal when
their 64-bit hashes are.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridemart.llm import tokens as tk
from ridemart.llm.components import connected_components
from ridemart.llm.frames import keyed, materialize, with_key

SHINGLE = 5
PERCENT = 80
SKETCH_BITS = 21          # counters of the frequency sketch (one byte each when broadcast)
SMALL_LIST = 16
WORTH_A_TURN = 0.05       # further pivots are tried while this part of the tried pairs links
PIVOTS = 8                # members of a long list that are tried against all others at first
LATER_PIVOTS = 64         # members of its largest component that are tried against all outside in later turns
HOT_LIST = 50_000
BUCKET_BYTES = 8 << 20
HELD_ENTRIES = 250_000    # list entries a task holds before it sends them on
_SUM = np.uint64(0xA0761D6478BD642F)
_PART = 15                # log2 of the counters in a row of the sketch

FIGURES = "doc_id long, id long, th long, n int, cls long, chk long, part int, counts binary"
POSTINGS = "bucket int, kind int, h binary, gid binary, n binary, pos binary, extra binary"
CANDIDATES = "kind int, a long, b long, c long, d long, n int, pos int"
STAR, PAIR, LIST, HOT, MEMBER = range(5)


def shingle_sets(t: tk.Texts, k: int = SHINGLE):
    """Distinct shingle hashes, ordered by text then hash, and their number for each text."""
    w = tk.Words(t, tk.BLANK_WORDS, lower=True)
    s = tk.whole_starts(w.count, w.first, k)
    h, doc = [tk.grams_at(w.hash, k, s)], [w.doc[s]]
    for size in range(1, k):
        d = np.flatnonzero(w.count == size)
        h.append(tk.grams_at(w.hash, size, w.first[d]))
        doc.append(d)
    h, doc = np.concatenate(h), np.concatenate(doc)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], doc[new], np.bincount(doc[new], minlength=t.n)


def _sums(h: np.ndarray, n: np.ndarray, salt: np.uint64) -> np.ndarray:
    """Order-free 64-bit hash of every text's shingles."""
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tk.mix(h ^ salt))])
    end = np.cumsum(n)
    return tk.mix(upto[end] - upto[end - n] + n.astype(np.uint64) * _SUM)


def _figures(k: int):
    def run(batches):
        sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
        for b in batches:
            for lo, t in tk.slices(b.column(3)):
                h, _, n = shingle_sets(t, k)
                sketch += np.bincount((h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(sketch)).astype(np.uint32)
                none = pa.nulls(t.n, pa.int32()), pa.nulls(t.n, pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, t.n), b.column(1).slice(lo, t.n), b.column(2).slice(lo, t.n), pa.array(n, pa.int32()),
                     pa.array(tk.as_long(_sums(h, n, np.uint64(1)))), pa.array(tk.as_long(_sums(h, n, np.uint64(2)))), *none],
                    names=["doc_id", "id", "th", "n", "cls", "chk", "part", "counts"])
        parts = np.minimum(sketch, 65_535).astype(np.uint16).reshape(-1, 1 << _PART)
        some = np.flatnonzero(parts.any(1))
        if len(some):
            long, int32 = pa.nulls(len(some), pa.int64()), pa.nulls(len(some), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [long, long, long, int32, long, long, pa.array(some, pa.int32()), pa.array([parts[i].tobytes() for i in some], pa.binary())],
                names=["doc_id", "id", "th", "n", "cls", "chk", "part", "counts"])
    return run


def _add_counts(table: pa.Table) -> pa.Table:
    total = np.zeros(1 << _PART, np.uint64)
    for c in table.column("counts"):
        total += np.frombuffer(c.as_buffer(), np.uint16)
    return pa.table({"part": table.column("part").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})


def frequency_classes(figures: DataFrame) -> tuple[np.ndarray, int]:
    """Quarter-octave class of every sketch counter (one byte each), and the class from which lists are hot."""
    rows = (figures.where("part is not null").select("part", "counts").groupBy("part")
            .applyInArrow(_add_counts, "part int, counts binary").collect())        # 2^SKETCH_BITS counters at most
    total = np.zeros(1 << SKETCH_BITS, np.uint64)
    for r in rows:
        total[r.part << _PART:(r.part + 1) << _PART] = np.frombuffer(r.counts, np.uint64)
    hot = max(HOT_LIST, 4 * int(total.mean()))
    return np.floor(4 * np.log2(total + 1.0)).astype(np.uint8), int(4 * math.log2(hot + 1)) + 1


def _prefix(n: np.ndarray, percent: int) -> np.ndarray:
    return np.where(n > 0, n - (n * percent + 99) // 100 + 1, 0)


def prefixes(t: tk.Texts, classes: np.ndarray, k: int, percent: int):
    """Prefix shingles in order: hash, text, place; with each text's size and set hash."""
    h, doc, n = shingle_sets(t, k)
    cls = _sums(h, n, np.uint64(1))
    q = classes[(h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    order = np.lexsort((h, q, doc))
    place = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
    p = _prefix(n, percent)
    keep = place < p[doc]
    return h[order][keep], doc[keep], place[keep], n, p, cls


def _postings(shared, hot: int, bits: int, k: int, percent: int):
    def emit(parts, bucket_of, kind, names):
        cols = [np.concatenate(x) for x in zip(*parts)]
        bucket = bucket_of(cols[0])
        order = np.argsort(bucket, kind="stable")
        cols = [c[order] for c in cols]
        edge = np.searchsorted(bucket[order], np.arange((1 << bits) + 1))
        some = np.flatnonzero(np.diff(edge))
        blank = pa.nulls(len(some), pa.binary())
        got = {x: pa.array([c[edge[i]:edge[i + 1]].tobytes() for i in some], pa.binary()) for x, c in zip(names, cols)}
        return pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(np.full(len(some), kind), pa.int32()),
             *[got.get(x, blank) for x in ("h", "gid", "n", "pos", "extra")]],
            names=["bucket", "kind", "h", "gid", "n", "pos", "extra"])

    def bucket_of(x):
        return (x >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(x), np.int64)

    def flush(lists, members, hots):
        yield emit(lists, bucket_of, PAIR, ("h", "gid", "n", "pos"))
        yield emit(members, bucket_of, MEMBER, ("gid", "n", "extra"))
        if hots:
            yield emit(hots, lambda x: bucket_of(tk.mix(x + np.arange(len(x), dtype=np.uint64))), HOT, ("h", "gid", "n", "pos"))

    def run(batches):
        classes = shared.value
        for b in batches:
            lists, hots, members, seen = [], [], [], np.zeros(0, np.uint64)
            for lo, t in tk.slices(b.column(2)):
                h, doc, place, n, p, cls = prefixes(t, classes, k, percent)
                gid = tk.mix(_sums(h, p, np.uint64(3)) + n.astype(np.uint64))
                ids = np.asarray(b.column(0).slice(lo, t.n)), np.asarray(b.column(1).slice(lo, t.n))
                some = np.flatnonzero(n > 0)
                extra = np.stack([tk.as_long(cls[some]), ids[0][some], ids[1][some]], 1)
                members.append((gid[some], n[some].astype(np.uint32), extra))
                # a group's list entries once a batch
                _, at = np.unique(gid, return_index=True)
                fresh = np.zeros(t.n, bool)
                fresh[at] = True
                fresh &= (n > 0) & ~np.isin(gid, seen)
                seen = np.concatenate([seen, gid[fresh]])
                keep = fresh[doc]
                h, doc, place = h[keep], doc[keep], place[keep]
                row = (h, gid[doc], n[doc].astype(np.uint32), place.astype(np.uint32))
                is_hot = classes[(h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)] >= hot
                lists.append(tuple(c[~is_hot] for c in row))
                if is_hot.any():
                    hots.append(tuple(c[is_hot] for c in row))
                if sum(len(x[0]) for x in lists) > HELD_ENTRIES:
                    yield from flush(lists, members, hots)
                    lists, hots, members = [], [], []
            if members:
                yield from flush(lists, members, hots)
    return run


def may_link(na, pa_, nb, pb, percent: int):
    """Length and positional filter of a pair whose first common shingle is at these places."""
    na, nb = na.astype(np.int64), nb.astype(np.int64)
    most = 1 + np.minimum(na - pa_ - 1, nb - pb - 1)
    return (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)) & ((100 + percent) * most >= percent * (na + nb))


def _candidate_rows(kind, a, b, c=None, d=None, n=None, pos=None):
    m = len(a)
    longs = [pa.nulls(m, pa.int64()) if x is None else pa.array(x.view(np.int64) if x.dtype == np.uint64 else x, pa.int64()) for x in (a, b, c, d)]
    ints = [pa.nulls(m, pa.int32()) if x is None else pa.array(x.astype(np.int32)) for x in (n, pos)]
    return pa.table([pa.array(np.full(m, kind), pa.int32()), *longs, *ints], names=["kind", "a", "b", "c", "d", "n", "pos"])


def _candidates(percent: int):
    """The lists of a bucket: pivot pairs with the number of lists, pairs of short lists, rows of long ones."""
    def column(t: pa.Table, name: str, kind) -> np.ndarray:
        return np.concatenate([np.zeros(0, kind)] + [np.frombuffer(x.as_buffer(), kind) for x in t.column(name)])

    def run(table: pa.Table) -> pa.Table:
        kind = np.asarray(table.column("kind"))
        part = {k: table.filter(pa.array(kind == k)) for k in (PAIR, HOT, MEMBER)}
        out = []
        gid, extra, n = (column(part[MEMBER], c, x) for c, x in (("gid", np.uint64), ("extra", np.int64), ("n", np.uint32)))
        extra = extra.reshape(-1, 3)
        # one document of a class is enough here
        _, at = np.unique(np.stack([gid.view(np.int64), extra[:, 0]], 1), axis=0, return_index=True)
        out.append(_candidate_rows(MEMBER, gid[at], extra[at, 0], extra[at, 1], extra[at, 2], n[at]))
        h, gid, n, pos = (column(part[HOT], c, x) for c, x in (("h", np.uint64), ("gid", np.uint64), ("n", np.uint32), ("pos", np.uint32)))
        out.append(_candidate_rows(HOT, gid, h, n=n, pos=pos))
        h, gid, n, pos = (column(part[PAIR], c, x) for c, x in (("h", np.uint64), ("gid", np.uint64), ("n", np.uint32), ("pos", np.uint32)))
        order = np.lexsort((gid, h))
        h, gid, n, pos = h[order], gid[order], n[order].astype(np.int64), pos[order].astype(np.int64)
        if len(h):
            fresh = np.concatenate([[True], (h[1:] != h[:-1]) | (gid[1:] != gid[:-1])])
            h, gid, n, pos = h[fresh], gid[fresh], n[fresh], pos[fresh]
            head = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            size = np.diff(np.concatenate([head, [len(h)]]))
            first, m = np.repeat(head, size), np.repeat(size, size)
            rest = np.flatnonzero((np.arange(len(h)) > first) & may_link(n[first], pos[first], n, pos, percent))
            out.append(_count_pairs(STAR, gid[first[rest]], gid[rest]))
            short = []
            for step in range(1, SMALL_LIST):
                i = np.flatnonzero((m <= SMALL_LIST) & (np.arange(len(h)) + step < first + m))
                j = i + step
                ok = may_link(n[i], pos[i], n[j], pos[j], percent)
                short.append((gid[i[ok]], gid[j[ok]]))
            out.append(_count_pairs(PAIR, *(np.concatenate(x) for x in zip(*short))))
            long = m > SMALL_LIST
            out.append(_candidate_rows(LIST, gid[long], h[long], n=n[long], pos=pos[long]))
        return pa.concat_tables(out)
    return run


def _count_pairs(kind: int, a: np.ndarray, b: np.ndarray) -> pa.Table:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    at = np.flatnonzero(new)
    return _candidate_rows(kind, a[at], b[at], np.diff(np.concatenate([at, [len(a)]])))


def _verify(k: int, percent: int):
    """Pairs whose texts' sets reach the similarity."""
    def run(batches):
        for b in batches:
            ta, tb = b.column(2).cast(pa.large_string()), b.column(3).cast(pa.large_string())
            ends = np.cumsum(np.asarray(pc.binary_length(ta)) + np.asarray(pc.binary_length(tb)))
            i = 0
            while i < len(ta):
                base = ends[i - 1] if i else 0
                j = max(int(np.searchsorted(ends, base + 2 * tk.SLICE_BYTES, "right")), i + 1)
                ha, da, na = shingle_sets(tk.Texts(ta.slice(i, j - i)), k)
                hb, db, nb = shingle_sets(tk.Texts(tb.slice(i, j - i)), k)
                h, d = np.concatenate([ha, hb]), np.concatenate([da, db])
                order = np.lexsort((h, d))
                h, d = h[order], d[order]
                both = np.bincount(d[1:][(h[1:] == h[:-1]) & (d[1:] == d[:-1])], minlength=j - i)
                linked = np.flatnonzero((both > 0) & (100 * both >= percent * (na + nb - both))) + i
                if len(linked):
                    row = pa.array(linked)
                    yield pa.RecordBatch.from_arrays([b.column(0).take(row), b.column(1).take(row)], names=["a", "b"])
                i = j
    return run


def verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The (a, b) pairs of classes that link; ``texts`` has one text for every class."""
    side = lambda x: texts.select(F.col("cls").alias(x), F.col("text").alias(f"t{x}"))
    return (pairs.select("a", "b").join(side("b"), "b").join(side("a"), "a").select("a", "b", "ta", "tb")
            .mapInArrow(_verify(k, percent), "a long, b long"))


def _ordered(df: DataFrame) -> DataFrame:
    return df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()


def classes_and_components(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(doc_id, id, th, n, cls) of every document, and (cls, comp) of every class that links; ``docs`` is keyed()."""
    spark = docs.sparkSession
    figures = materialize(docs.select("doc_id", "id", "th", "text").mapInArrow(_figures(k), FIGURES), "sets")
    rows = figures.where("part is null").select("doc_id", "id", "th", "n", "cls")
    total = rows.agg(F.sum("n")).first()[0] or 0
    classes, hot = frequency_classes(figures)
    shared = spark.sparkContext.broadcast(classes)                                   # 2^SKETCH_BITS bytes
    bits = max(0, math.ceil(math.log2(max(1.0, total * (100 - percent) / 100 * 24 / BUCKET_BYTES))))
    found = materialize(
        docs.select("id", "th", "text").mapInArrow(_postings(shared, hot, bits, k, percent), POSTINGS)
        .groupBy("bucket").applyInArrow(_candidates(percent), CANDIDATES), "candidates")

    member = found.where(F.col("kind") == MEMBER).select(F.col("a").alias("gid"), F.col("b").alias("cls"), "n",
                                                         F.struct(F.col("c").alias("id"), F.col("d").alias("th")).alias("doc"))
    member = materialize(member.groupBy("gid", "cls", "n").agg(F.min("doc").alias("doc")), "members")
    group = member.groupBy("gid").agg(F.min("cls").alias("rep"))
    star = (found.where(F.col("kind") == STAR).select("a", "b", "c").groupBy("b", "a").agg(F.sum("c").alias("c"))
            .groupBy("b").agg(F.max_by("a", F.struct("c", "a")).alias("a")))
    lists = materialize(found.where(F.col("kind").isin(LIST, HOT))
                        .select(F.col("b").alias("h"), F.col("a").alias("gid"), "n", "pos").distinct(), "lists")
    short = _ordered(found.where(F.col("kind") == PAIR))

    # one text for every class that may link with another
    wanted = (short.select(F.explode(F.array("a", "b")).alias("gid")).union(lists.select("gid"))
              .union(member.groupBy("gid").count().where("count > 1").select("gid")).distinct())
    need = member.join(wanted, "gid", "left_semi").groupBy("cls").agg(F.min("doc").alias("doc")).select("cls", "doc.id", "doc.th")
    texts = materialize(docs.select("id", "th", "text").join(need, ["id", "th"]).dropDuplicates(["cls"]).select("cls", "text"), "texts")

    def rep(df: DataFrame, x: str) -> DataFrame:
        return df.join(group.select(F.col("gid").alias(x), F.col("rep").alias(f"r{x}")), x)

    first = rep(rep(star, "a"), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    inside = member.join(group, "gid").where("cls <> rep").select(F.col("rep").alias("a"), F.col("cls").alias("b"))
    alone = member.select("gid", "cls", F.col("cls").alias("comp"))
    pairs = first.union(inside).union(_pivot_pairs(lists.join(alone, "gid"), 0, percent))
    tested = materialize(_ordered(pairs), "pivots")
    links = materialize(verified(tested, texts, k, percent), "links")
    turn, tries, joined = 0, tested.count(), links.count()
    while True:
        comps = connected_components(links)
        spread = materialize(member.join(comps.withColumnRenamed("node", "cls"), "cls", "left")
                             .select("gid", "cls", F.coalesce("comp", "cls").alias("comp")), "spread")
        at = lists.join(spread, "gid")
        mixed = at.groupBy("h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("h")
        at = materialize(at.join(mixed, "h", "left_semi"), "open")
        if joined <= tries * WORTH_A_TURN:
            break
        turn += 1
        more = materialize(_ordered(_pivot_pairs(at, turn, percent)).join(tested, ["a", "b"], "left_anti"), "pivots")
        new = materialize(verified(more, texts, k, percent), "links")
        tested, links, tries, joined = tested.union(more), links.union(new), more.count(), new.count()

    # candidates still in different components
    def side(x: str) -> DataFrame:
        return spread.select(F.col("gid").alias(x), F.col("cls").alias(f"c{x}"), F.col("comp").alias(f"p{x}"))

    across = short.join(side("a"), "a").join(side("b"), "b").where("pa <> pb").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    mixed = spread.groupBy("gid").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("gid")
    within = spread.join(mixed, "gid", "left_semi")
    within = (within.alias("x").join(within.alias("y"), "gid").where("x.comp < y.comp")
              .select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")))
    far = (at.alias("x").join(at.alias("y"), "h")
           .where((F.col("x.comp") < F.col("y.comp")) & _may_link("x.n", "x.pos", "y.n", "y.pos", percent))
           .select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")))
    rest = _ordered(across.union(within).union(far)).join(tested, ["a", "b"], "left_anti")
    more = materialize(verified(materialize(rest, "rest"), texts, k, percent), "links")
    return rows, connected_components(links.union(more)).withColumnRenamed("node", "cls")


def _pivot_pairs(at: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs of pivots and other classes of every list, in different components.

    First ``PIVOTS`` classes of a list by a hash, with all others; in later
    turns ``LATER_PIVOTS`` of the list's largest component, with all outside.
    The hash is the same in all lists, so the many lists of one family share
    their pivots.
    """
    order = Window.partitionBy("h").orderBy(F.xxhash64("cls", F.lit(turn)), "cls")
    pool, most = at, PIVOTS
    if turn:
        large = (at.groupBy("h", "comp").agg(F.count("*").alias("c")).groupBy("h")
                 .agg(F.max_by("comp", F.struct("c", "comp")).alias("comp")))
        pool, most = at.join(large, ["h", "comp"], "left_semi"), LATER_PIVOTS
    top = pool.withColumn("r", F.row_number().over(order)).where(F.col("r") <= most)
    return (at.alias("x").join(top.alias("y"), "h")
            .where((F.col("x.comp") != F.col("y.comp")) & _may_link("x.n", "x.pos", "y.n", "y.pos", percent))
            .select(F.col("y.cls").alias("a"), F.col("x.cls").alias("b")))


def _may_link(na: str, pa_: str, nb: str, pb: str, percent: int):
    n1, p1, n2, p2 = F.col(na), F.col(pa_), F.col(nb), F.col(pb)
    return ((100 * F.least(n1, n2) >= percent * F.greatest(n1, n2))
            & ((100 + percent) * F.least(n1 - p1, n2 - p2) >= percent * (n1 + n2)))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, id, th (its row key), n_shingles, component (class) and component_id."""
    rows, comps = classes_and_components(keyed(docs, id_col, text_col), shingle, percent)
    known = rows.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("low"))
    placed = (known.join(comps, "cls", "left").select("cls", F.coalesce("comp", "cls").alias("component"), "low"))
    lowest = placed.groupBy("component").agg(F.min("low").alias("component_id"))
    of_class = placed.join(lowest, "component").select("cls", "component", "component_id")
    linked = rows.where("n > 0").join(of_class, "cls").select("doc_id", "id", "th", "n", "component", "component_id")
    alone = rows.where("n = 0").select("doc_id", "id", "th", "n", F.lit(None).cast("long").alias("component"),
                                       F.col("doc_id").alias("component_id"))
    return linked.union(alone).withColumn("n", F.col("n").cast("long")).withColumnRenamed("n", "n_shingles")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` less all but one row of each component: the one of the smallest doc_id (null last).

    Texts without a word link with nothing and all stay. A repeated row stays once.
    """
    found = near_duplicates(docs, id_col, text_col, shingle, percent).where("component is not null")
    first = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "id", "th")).alias("m")).select("m.id", "m.th")
    rows = with_key(docs, id_col, text_col)
    word = F.coalesce(F.col(f"row.`{text_col}`"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    chosen = rows.where(word).join(first, ["id", "th"], "left_semi").dropDuplicates(["id", "th"])
    return chosen.select("row.*").union(rows.where(~word).select("row.*"))


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_shingles", "component_id")
