"""Near-duplicate line removal by an exact set-similarity join.

A line's set holds its distinct words. A line is removed if an earlier line
(by doc_id, then text hash, then line number) has a set with a Jaccard
similarity of 0.8 or more; equal lines included, lines without a word never.

1. Equal lines are one node, at its first place; later places are removed.
2. A line's words are ordered from rare to frequent, by counts over all
   documents in a sketch of fixed size (any fixed order keeps the join exact).
   Similar sets share a word among the first ``n - ceil(0.8 n) + 1`` of each;
   these prefixes are indexed, packed by hash bucket.
3. The lines of a word's list pass the length filter, the positional filter
   (nothing before the first common word matches) and a parity filter: sets
   that differ in d words differ in at most d bits of a 64-bit parity of their
   words. What is left of a list is almost only similar lines, given as pairs,
   or as members where a list holds a large family. Lists of more than
   ``LONG_LIST`` lines are given as members untested; a list that the sketch
   shows to be very long is dealt over all buckets, so no task holds it whole.
4. Every later line is verified against one earlier candidate of its pairs and
   the first few members of its families; those that found no match are
   verified against all other earlier candidates. A family of any size costs
   a few verifications a line, if its first members are similar to the others.
5. Texts are put together again from the lines that stay.

Counting, joins, ordering and the new texts are DataFrame operations; words,
prefixes, lists and the verification run in Arrow tasks. Without ``packed``
these are DataFrame operations too (:func:`similar_earlier`), with the same
rows but more disk and CPU: prefixes are rows, without words that occur once,
and the first ``FIRST`` lines of a list are joined with its others at once.

Defined results: null text stays null, an empty text empty; rows that share
doc_id and text share the decisions, none of them earlier than the other; a
null doc_id comes first; an empty table gives an empty result. Lines and words
are equal when their 64-bit hashes are.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ridemart.llm import tokens as tk
from ridemart.llm.frames import keyed, materialize, with_key

PERCENT = 80
SKETCH_BITS = 21          # counters of the word sketch (one byte each when broadcast)
SHORT_LIST = 64           # lists up to which all members are compared by shifts
DENSE_LIST = 64           # pairs of a list from which its members are given instead
LONG_LIST = 4_096         # lists from which members are given without testing them against each other
HOT_LIST = 50_000         # lines of a word from which its list is dealt over all buckets
SALTS = 32                # parts of an untested list that are joined apart
PIVOTS = 8
FIRST = 32                # members of a list that are compared with all its others at once
BUCKET_BYTES = 8 << 20
BITMAP_BITS = 22
_PART = 15

LINES = "id long, th long, line_no int, h long, part int, counts binary"
POSTINGS = "bucket int, hot boolean, k binary, h binary, parity binary, n binary, place binary"
MEETINGS = "k long, a long, b long, n int, place int, parity long, wide boolean"


class Lines:
    """The lines of a slice that hold a word, and their distinct words."""

    def __init__(self, t: tk.Texts, sets: bool = True):
        w = tk.Words(t, tk.BLANK_WORDS, hashes=sets)
        breaks = np.flatnonzero(t.data == 10)
        starts = np.unique(np.concatenate([t.off[:-1][np.diff(t.off) > 0], breaks + 1]))
        line = np.searchsorted(starts, w.start, "right") - 1
        new = np.ones(len(line), bool)
        new[1:] = line[1:] != line[:-1]
        self.doc = w.doc[new]
        self.start = starts[line[new]]
        stop = np.concatenate([breaks, [len(t.data)]])
        self.end = np.minimum(stop[np.searchsorted(stop, self.start)], t.off[1:][self.doc])
        upto = np.searchsorted(breaks, self.start)
        self.line_no = upto - np.searchsorted(breaks, t.off[:-1])[self.doc]
        of_bytes = w.hash_of if sets else tk.SpanHash(t.data)
        self.h = of_bytes(self.start, self.end)
        if sets:
            own = np.cumsum(new) - 1
            order = np.lexsort((w.hash, own))
            word, own = w.hash[order], own[order]
            fresh = np.ones(len(word), bool)
            fresh[1:] = (word[1:] != word[:-1]) | (own[1:] != own[:-1])
            self.word, self.own = word[fresh], own[fresh]
            self.n = np.bincount(self.own, minlength=len(self.h))


def _counter(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _line_rows(batches):
    sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
    names = [f.split()[0] for f in LINES.split(", ")]
    for b in batches:
        for lo, t in tk.slices(b.column(2)):
            x = Lines(t)
            sketch += np.bincount(_counter(x.word), minlength=len(sketch)).astype(np.uint32)
            row = pa.array(x.doc + lo)
            m = len(x.h)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(row), b.column(1).take(row), pa.array(x.line_no, pa.int32()), pa.array(tk.as_long(x.h)),
                 pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names=names)
    parts = np.minimum(sketch, 65_535).astype(np.uint16).reshape(-1, 1 << _PART)
    some = np.flatnonzero(parts.any(1))
    if len(some):
        long, int32 = pa.nulls(len(some), pa.int64()), pa.nulls(len(some), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [long, long, int32, long, pa.array(some, pa.int32()), pa.array([parts[i].tobytes() for i in some], pa.binary())], names=names)


def _add_counts(table: pa.Table) -> pa.Table:
    total = np.zeros(1 << _PART, np.uint64)
    for c in table.column("counts"):
        total += np.frombuffer(c.as_buffer(), np.uint16)
    return pa.table({"part": table.column("part").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})


def word_classes(found: DataFrame) -> tuple[np.ndarray, int, int]:
    """Quarter-octave frequency class of every counter, the class from which lists are hot, and the number of
    distinct words of all lines together."""
    rows = (found.where("part is not null").select("part", "counts").groupBy("part")
            .applyInArrow(_add_counts, "part int, counts binary").collect())          # 2^SKETCH_BITS counters at most
    total = np.zeros(1 << SKETCH_BITS, np.uint64)
    for r in rows:
        total[r.part << _PART:(r.part + 1) << _PART] = np.frombuffer(r.counts, np.uint64)
    hot = max(HOT_LIST, 4 * int(total.mean()))
    return np.floor(4 * np.log2(total + 1.0)).astype(np.uint8), int(4 * math.log2(hot + 1)) + 1, int(total.sum())


def _postings(shared, hot: int, bits: int, percent: int):
    def bucket_of(x):
        return (x >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(x), np.int64)

    def run(batches):
        classes = shared.value
        for b in batches:
            seen, parts = np.zeros(0, np.uint64), []
            for _, t in tk.slices(b.column(0)):
                x = Lines(t)
                _, at = np.unique(x.h, return_index=True)                 # equal lines once a batch
                fresh = np.zeros(len(x.h), bool)
                fresh[at] = True
                fresh &= ~np.isin(x.h, seen)
                seen = np.concatenate([seen, x.h[fresh]])
                q = classes[_counter(x.word)]
                order = np.lexsort((x.word, q, x.own))
                word, own = x.word[order], x.own[order]
                first = np.cumsum(x.n) - x.n
                parity = np.bitwise_xor.reduceat(np.uint64(1) << (x.word >> np.uint64(58)), first) if len(first) else np.zeros(0, np.uint64)
                place = np.arange(len(word)) - first[own]
                keep = (place < (x.n - (x.n * percent + 99) // 100 + 1)[own]) & fresh[own]
                own = own[keep]
                parts.append((q[order][keep] >= hot, tk.mix(word[keep]), x.h[own], parity[own], x.n[own].astype(np.uint32), place[keep].astype(np.uint32)))
            if not parts:
                continue
            is_hot, *cols = [np.concatenate(c) for c in zip(*parts)]
            # a hot list is dealt by its lines as well; equal entries still meet
            at = np.flatnonzero(is_hot)
            bucket = bucket_of(cols[0])
            bucket[at] = bucket_of(tk.mix(cols[0][at] ^ tk.mix(cols[1][at])))
            bucket = bucket * 2 + is_hot
            order = np.argsort(bucket, kind="stable")
            edge = np.searchsorted(bucket[order], np.arange((2 << bits) + 1))
            some = np.flatnonzero(np.diff(edge))
            yield pa.RecordBatch.from_arrays(
                [pa.array(some >> 1, pa.int32()), pa.array(some & 1 == 1),
                 *[pa.array([c[order[edge[i]:edge[i + 1]]].tobytes() for i in some], pa.binary()) for c in cols]],
                names=[f.split()[0] for f in POSTINGS.split(", ")])
    return run


def may_link(nx, px, bx, ny, py, by, percent: int) -> np.ndarray:
    """Length, positional (first common word) and parity filter for arrays of pairs."""
    both = nx + ny
    need = (percent * both + 99 + percent) // (100 + percent)             # least overlap, rounded up
    ok = (100 * np.minimum(nx, ny) >= percent * np.maximum(nx, ny)) & (1 + np.minimum(nx - px - 1, ny - py - 1) >= need)
    return ok & (np.bitwise_count(bx ^ by) <= both - 2 * need)


def _meet(percent: int, longest: int = LONG_LIST):
    """The lists of a bucket: pairs of lists with few of them, members of the others.

    Lists of more than ``longest`` lines and hot ones give all members, untested.
    """
    def run(table: pa.Table) -> pa.Table:
        def col(name, kind):
            return np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in table.column(name)])
        k, h, parity = (col(c, np.uint64) for c in ("k", "h", "parity"))
        n, place = col("n", np.uint32).astype(np.int64), col("place", np.uint32).astype(np.int64)
        wide = np.repeat(np.asarray(table.column("hot")), np.asarray(pc.binary_length(table.column("k"))) // 8)
        order = np.lexsort((h, k))
        fresh = np.ones(len(k), bool)
        ks, hs = k[order], h[order]
        fresh[1:] = (ks[1:] != ks[:-1]) | (hs[1:] != hs[:-1])
        order = order[fresh]
        k, h, parity, n, place, wide = (c[order] for c in (k, h, parity, n, place, wide))
        head = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        size = np.diff(np.concatenate([head, [len(k)]]))
        last = np.repeat(head + size, size)
        length = np.repeat(size, size)
        wide |= length > longest
        family = wide.copy()

        def test(i, j):
            ok = may_link(n[i], place[i], parity[i], n[j], place[j], parity[j], percent)
            return i[ok], j[ok]

        left, right = [], []
        base = np.flatnonzero((length > 1) & (length <= SHORT_LIST) & ~wide)
        for step in range(1, SHORT_LIST):
            base = base[base + step < last[base]]
            if not len(base):
                break
            i, j = test(base, base + step)
            left.append(i)
            right.append(j)
        tested = (size > SHORT_LIST) & ~wide[head]
        for a, m in zip(head[tested], size[tested]):
            found, held, some = 0, [], np.zeros(m, bool)
            for i in range(a, a + m - 1):                                 # one member against the rest of its list
                x, y = test(np.full(a + m - i - 1, i), np.arange(i + 1, a + m))
                if len(y):
                    found += len(y)
                    some[i - a] = True
                    some[y - a] = True
                    if found <= DENSE_LIST:                               # no more pairs than this are held
                        held.append((x, y))
            if found > DENSE_LIST:
                family[a:a + m] = some
            else:
                left += [x for x, _ in held]
                right += [y for _, y in held]
        i = np.concatenate(left) if left else np.zeros(0, np.int64)
        j = np.concatenate(right) if right else np.zeros(0, np.int64)
        of = np.searchsorted(head, i, "right") - 1
        dense = np.bincount(of, minlength=len(head)) > DENSE_LIST
        alone = ~dense[of]
        pairs = np.unique(np.stack([h[i[alone]], h[j[alone]]], 1), axis=0)
        family[i[~alone]] = family[j[~alone]] = True
        member = np.flatnonzero(family)
        p, m = len(pairs), len(member)

        def both(first, second, kind):
            return pa.concat_arrays([first, second]) if len(second) or len(first) else pa.array([], kind)
        return pa.table([
            both(pa.nulls(p, pa.int64()), pa.array(tk.as_long(k[member])), pa.int64()),
            both(pa.array(tk.as_long(np.ascontiguousarray(pairs[:, 0]))), pa.array(tk.as_long(h[member])), pa.int64()),
            both(pa.array(tk.as_long(np.ascontiguousarray(pairs[:, 1]))), pa.nulls(m, pa.int64()), pa.int64()),
            both(pa.nulls(p, pa.int32()), pa.array(n[member], pa.int32()), pa.int32()),
            both(pa.nulls(p, pa.int32()), pa.array(place[member], pa.int32()), pa.int32()),
            both(pa.nulls(p, pa.int64()), pa.array(tk.as_long(parity[member])), pa.int64()),
            both(pa.nulls(p, pa.bool_()), pa.array(wide[member]), pa.bool_())],
            names=[f.split()[0] for f in MEETINGS.split(", ")])
    return run


def _wanted_lines(bitmap):
    """(h, line) of the lines whose hash is in the bitmap, once a batch."""
    def run(batches):
        bits = np.frombuffer(bitmap.value, np.uint8)
        for b in batches:
            seen = np.zeros(0, np.uint64)
            for _, t in tk.slices(b.column(0)):
                x = Lines(t, sets=False)
                i = (tk.mix(x.h) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
                _, at = np.unique(x.h, return_index=True)
                at = at[((bits[i[at] >> 3] >> (i[at] & 7).astype(np.uint8)) & 1 == 1) & ~np.isin(x.h[at], seen)]
                seen = np.concatenate([seen, x.h[at]])
                raw = t.data.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tk.as_long(x.h[at])), pa.array([raw[s:e] for s, e in zip(x.start[at], x.end[at])], pa.binary())],
                    names=["h", "line"])
    return run


def _hash_bitmap(df: DataFrame, col: str) -> bytes:
    """Fixed-size bitmap of the column's hashes (of ``tokens.mix`` of them), from one aggregation per task."""
    def rows(batches):
        bits = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
        for b in batches:
            i = (tk.mix(np.asarray(b.column(0)).view(np.uint64)) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
            np.bitwise_or.at(bits, i >> 3, np.uint8(1) << (i & 7).astype(np.uint8))
        words = bits.view(np.int64)
        some = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(words[some])], names=["i", "v"])
    got = df.select(col).mapInArrow(rows, "i int, v long").groupBy("i").agg(F.bit_or("v").alias("v")).collect()
    out = np.zeros(1 << (BITMAP_BITS - 6), np.int64)                       # that many rows at most
    for r in got:
        out[r.i] = r.v
    return out.tobytes()


def _verify(percent: int):
    def sets(col: pa.Array):
        t = tk.Texts(col, binary=True)
        w = tk.Words(t, tk.BLANK_WORDS)
        order = np.lexsort((w.hash, w.doc))
        word, doc = w.hash[order], w.doc[order]
        new = np.ones(len(word), bool)
        new[1:] = (word[1:] != word[:-1]) | (doc[1:] != doc[:-1])
        return word[new], doc[new], np.bincount(doc[new], minlength=t.n)

    def run(batches):
        for b in batches:
            y, tx, ty = b.column(1), b.column(2).cast(pa.large_binary()), b.column(3).cast(pa.large_binary())
            ends = np.cumsum(np.asarray(pc.binary_length(tx)) + np.asarray(pc.binary_length(ty)))
            i = 0
            while i < len(tx):
                base = ends[i - 1] if i else 0
                j = max(int(np.searchsorted(ends, base + 2 * tk.SLICE_BYTES, "right")), i + 1)
                wx, dx, nx = sets(tx.slice(i, j - i))
                wy, dy, ny = sets(ty.slice(i, j - i))
                w, d = np.concatenate([wx, wy]), np.concatenate([dx, dy])
                order = np.lexsort((w, d))
                w, d = w[order], d[order]
                common = np.bincount(d[1:][(w[1:] == w[:-1]) & (d[1:] == d[:-1])], minlength=j - i)
                ok = np.flatnonzero(100 * common >= percent * (nx + ny - common)) + i
                yield pa.RecordBatch.from_arrays([y.take(pa.array(np.unique(ok)))], names=["h"])
                i = j
    return run


def _matched(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The later lines (h) of the (x, y) pairs that are similar."""
    def side(c):
        return texts.select(F.col("h").alias(c), F.col("line").alias(f"t{c}"))
    return (pairs.select("x", "y").join(side("y"), "y").join(side("x"), "x").select("x", "y", "tx", "ty")
            .mapInArrow(_verify(percent), "h long").distinct())


def later_matches(found: DataFrame, texts: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(h, first, count) of every distinct line, and the h of those with a similar earlier line.

    ``found`` is the table of lines and word counts, ``texts`` has one column, the text.
    """
    spark: SparkSession = found.sparkSession
    nodes = materialize(found.where("part is null").select("h", F.struct("id", "th", "line_no").alias("p"))
                        .groupBy("h").agg(F.min("p").alias("first"), F.count("*").alias("count")), "nodes")
    classes, hot, total = word_classes(found)
    shared = spark.sparkContext.broadcast(classes)                          # 2^SKETCH_BITS bytes
    bits = max(0, math.ceil(math.log2(max(1.0, total * (100 - percent) / 100 * 32 / BUCKET_BYTES))))
    met = materialize(texts.mapInArrow(_postings(shared, hot, bits, percent), POSTINGS)
                      .groupBy("bucket").applyInArrow(_meet(percent, LONG_LIST), MEETINGS), "met")

    place = nodes.select("h", "first")
    two = met.where("k is null").select("a", "b").distinct()
    two = (two.join(place.select(F.col("h").alias("a"), F.col("first").alias("fa")), "a")
           .join(place.select(F.col("h").alias("b"), F.col("first").alias("fb")), "b"))
    a_first = F.col("fa") < F.col("fb")
    two = materialize(two.select(F.when(a_first, F.col("a")).otherwise(F.col("b")).alias("x"), F.least("fa", "fb").alias("first"),
                                 F.when(a_first, F.col("b")).otherwise(F.col("a")).alias("y")), "pairs")
    many = materialize(met.where("k is not null").select("k", F.col("a").alias("h"), "n", "place", "parity", "wide").join(place, "h"), "families")

    need = two.select(F.explode(F.array("x", "y")).alias("h")).union(many.select("h")).distinct()
    bitmap = spark.sparkContext.broadcast(_hash_bitmap(need, "h"))
    lines = materialize(texts.mapInArrow(_wanted_lines(bitmap), "h long, line binary").dropDuplicates(["h"]), "texts")

    early = many.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy("first"))).where(F.col("r") <= PIVOTS)
    tries = (two.groupBy("y").agg(F.min_by("x", "first").alias("x")).select("x", "y")
             .union(_earlier(early, many, percent)).distinct())
    tries = materialize(tries, "tries")
    hit = materialize(_matched(tries, lines, percent), "matched")
    open_two = two.select("x", "y").join(hit.withColumnRenamed("h", "y"), "y", "left_anti")
    open_many = many.join(hit, "h", "left_anti")
    rest = (open_two.select("x", "y").union(_earlier(many, open_many, percent)).distinct()
            .join(tries, ["x", "y"], "left_anti"))
    return nodes, materialize(hit.union(_matched(materialize(rest, "rest"), lines, percent)), "later")


def _earlier(xs: DataFrame, ys: DataFrame, percent: int) -> DataFrame:
    """(x, y) pairs of a family's members, x earlier, that pass the filters; untested lists are joined in ``SALTS`` parts."""
    xs = xs.withColumn("salt", F.explode(F.when(F.col("wide"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    ys = ys.withColumn("salt", F.when(F.col("wide"), F.pmod(F.xxhash64("h"), F.lit(SALTS))).otherwise(F.lit(0)).cast("int"))
    both = F.col("x.n") + F.col("y.n")
    need = F.ceil(percent * both / (100 + percent))
    return (xs.alias("x").join(ys.alias("y"), ["k", "salt"])
            .where((F.col("x.first") < F.col("y.first")) & (F.col("x.h") != F.col("y.h"))
                   & (100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n"))
                   & (F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place")) >= need)
                   & (F.bit_count(F.col("x.parity").bitwiseXOR(F.col("y.parity"))) <= both - 2 * need))
            .select(F.col("x.h").alias("x"), F.col("y.h").alias("y")))


def _bitmap(df: DataFrame, col: str) -> Column:
    """Condition on ``col``: false only for values that are not in ``df`` (fixed size).

    The bits are a scalar subquery: as a literal they would stand in every plan that is printed or kept.
    """
    b = F.shiftrightunsigned(F.xxhash64(col), 64 - BITMAP_BITS)
    rows = (df.select(b.alias("b")).groupBy(F.shiftright("b", 6).cast("int").alias("i"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(b & 63 as int)))").alias("v")).collect())   # 2^(BITMAP_BITS-6) rows at most
    out = [0] * (1 << (BITMAP_BITS - 6))
    for r in rows:
        out[r["i"]] = r["v"]
    bits = df.sparkSession.createDataFrame([(out,)], "bits array<bigint>").scalar()
    word = F.get(bits, F.shiftright(b, 6).cast("int"))
    return word.bitwiseAND(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64({col}), {64 - BITMAP_BITS}) & 63 as int))")) != 0


_WORD = r"[^\x20\x09-\x0D]"
_BLANKS = r"[\x20\x09-\x0D]+"


def _lines(rows: DataFrame) -> DataFrame:
    """(id, th, line_no, line, h) of every line that holds a word."""
    return (rows.select("id", "th", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
            .where(F.col("line").rlike(_WORD)).withColumn("h", F.xxhash64("line")))


def _word_hashes(line: str | Column) -> Column:
    return F.transform(F.array_remove(F.split(line, _BLANKS), ""), lambda w: F.xxhash64(w))


def _classes(rows: DataFrame) -> Column:
    """Half-octave frequency class of every counter of the words, as one array (2^SKETCH_BITS bytes)."""
    spark = rows.sparkSession
    words = rows.select(F.explode(F.split("text", _BLANKS)).alias("w")).where("w <> ''")
    count = words.groupBy(F.shiftrightunsigned(F.xxhash64("w"), 64 - SKETCH_BITS).alias("id")).count()
    half = F.least(F.floor(2 * F.log2(F.coalesce("count", F.lit(0)) + 1)), F.lit(63)).cast("byte")
    parts = (spark.range(1 << SKETCH_BITS).join(count, "id", "left").select(F.shiftright("id", _PART).alias("part"), F.struct("id", half.alias("c")).alias("e"))
             .groupBy("part").agg(F.sort_array(F.collect_list("e")).getField("c").alias("c")))
    one = parts.groupBy().agg(F.flatten(F.sort_array(F.collect_list(F.struct("part", "c"))).getField("c")).alias("c"))
    return materialize(one, "classes").scalar()


def prefixes(rows: DataFrame, percent: int) -> DataFrame:
    """(k, h, id, n, place, parity): the prefix words of every line.

    A token is a word's class in the upper bits and 57 bits of its hash below, so tokens sort from rare to
    frequent. Words of a counter of one are in one line only and lead nowhere.
    """
    # the classes enter as a column of their own, since no subquery may be written inside a function of words;
    # the optimizer puts both selects together
    lines = _lines(rows).select("h", "id", "line", _classes(rows).alias("classes"))
    token = F.transform(F.array_distinct(_word_hashes("line")), lambda w: F.shiftleft(
        F.get("classes", F.shiftrightunsigned(w, 64 - SKETCH_BITS).cast("int")).cast("long"), 57).bitwiseOR(F.shiftrightunsigned(w, 7)))
    bit = F.expr("aggregate(t, 0L, (a, x) -> a ^ shiftleft(1L, cast(x & 63 as int)))")
    own = lines.select("h", "id", F.sort_array(token).alias("t"))
    own = own.select("h", "id", F.size("t").alias("n"), bit.alias("parity"),
                     F.expr(f"slice(t, 1, size(t) - cast((size(t) * {percent}L + 99) div 100 as int) + 1)").alias("t"))
    return (own.select("h", "id", "n", "parity", F.posexplode_outer("t").alias("place", "w")).where(F.shiftright("w", 57) > 2)
            .select(F.xxhash64("w").bitwiseAND(0x7FFFFFFF).cast("int").alias("k"), "h", "id", "n", "place", "parity"))


def _can_link(x: str, y: str, percent: int) -> Column:
    """:func:`may_link` of the columns of x and y."""
    def least(c):
        return F.least(F.col(f"{x}.n") - F.col(f"{x}.{c}"), F.col(f"{y}.n") - F.col(f"{y}.{c}"))
    both = F.col(f"{x}.n") + F.col(f"{y}.n")
    need = F.expr(f"({percent}L * ({x}.n + {y}.n) + {99 + percent}) div {100 + percent}")
    return ((100 * F.least(f"{x}.n", f"{y}.n") >= percent * F.greatest(f"{x}.n", f"{y}.n")) & (least("place") >= need)
            & (F.bit_count(F.col(f"{x}.parity").bitwiseXOR(F.col(f"{y}.parity"))) <= both - 2 * need))


def _ranked(entries: DataFrame) -> DataFrame:
    """The members of lists of two and more, once each, with their place r in the list (by id) and its size."""
    own, whole = Window.partitionBy("k").orderBy("id", "h"), Window.partitionBy("k")
    once = entries.repartition("k").groupBy("k", "h", "n", "place", "parity").agg(F.min("id").alias("id"))
    return (once.withColumn("r", F.row_number().over(own)).withColumn("size", F.count("*").over(whole)).where("size > 1")
            .select("k", "h", "n", "place", "parity", "r", "size"))


def _pairs(ranked: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of every list's first members with the others that pass the filters."""
    x, y = ranked.where(F.col("r") <= FIRST).alias("x"), ranked.alias("y")
    return (x.join(y.hint("merge"), F.col("x.k") == F.col("y.k"))
            .where((F.col("x.r") < F.col("y.r")) & (F.col("x.h") != F.col("y.h")) & _can_link("x", "y", percent))
            .select(F.least("x.h", "y.h").alias("a"), F.greatest("x.h", "y.h").alias("b")).distinct())


def _similar(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The later lines (h) of the (x, y) pairs whose sets reach the similarity; no other texts are shuffled."""
    def side(c):
        return texts.where(_bitmap(pairs.select(F.col(c).alias("h")), "h")).select(F.col("h").alias(c), F.col("line").alias(f"t{c}"))
    sets = (pairs.select("x", "y").join(side("y"), "y").join(side("x"), "x")
            .select("y", F.array_distinct(_word_hashes("tx")).alias("wx"), F.array_distinct(_word_hashes("ty")).alias("wy")))
    both = sets.select("y", F.size(F.array_intersect("wx", "wy")).alias("both"), (F.size("wx") + F.size("wy")).alias("all"))
    return both.where(100 * F.col("both") >= percent * (F.col("all") - F.col("both"))).select(F.col("y").alias("h")).distinct()


def similar_earlier(rows: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The h of the lines with a similar earlier line; ``nodes`` has the first place of every distinct line."""
    lines = _lines(rows)
    # one exchange of the prefixes serves both sides of the pairs and the longer lists, if all want the same rows of it
    ranked = _ranked(materialize(prefixes(rows, percent), "prefixes")
                     .where("k is not null and h is not null and id is not null and n is not null and place is not null and parity is not null"))
    pairs = _pairs(ranked, percent).selectExpr("int(null) as k", "a", "b", "int(null) as n", "int(null) as place", "bigint(null) as parity",
                                               "boolean(null) as wide")
    # the pairs of a longer list's first members are known; its other members are compared below
    longer = ranked.where((F.col("size") > FIRST + 1) & (F.col("r") > 0))
    met = materialize(pairs.union(longer.select("k", "h", F.lit(None).cast("long"), "n", "place", "parity", F.col("size") > LONG_LIST)), "met")
    place = nodes.select("h", "first")
    two = (met.where("k is null").select("a", "b").join(place.select(F.col("h").alias("a"), F.col("first").alias("fa")), "a")
           .join(place.select(F.col("h").alias("b"), F.col("first").alias("fb")), "b"))
    a_first = F.col("fa") < F.col("fb")
    two = materialize(two.select(F.when(a_first, F.col("a")).otherwise(F.col("b")).alias("x"), F.least("fa", "fb").alias("first"),
                                 F.when(a_first, F.col("b")).otherwise(F.col("a")).alias("y")), "pairs")
    many = materialize(met.where("k is not null").select("k", F.col("a").alias("h"), "n", "place", "parity", "wide").join(place, "h"), "families")

    need = two.select(F.explode(F.array("x", "y")).alias("h")).union(many.select("h"))
    wanted = lines.where(_bitmap(need, "h")).select("h", "line").dropDuplicates(["h"])
    texts = materialize(wanted, "texts")

    tries = materialize(two.groupBy("y").agg(F.min_by("x", "first").alias("x")).select("x", "y"), "tries")
    hit = materialize(_similar(tries, texts, percent), "matched")
    open_two = two.select("x", "y").join(hit.withColumnRenamed("h", "y"), "y", "left_anti")
    open_many = many.join(hit, "h", "left_anti")
    rest = (open_two.select("x", "y").union(_earlier(many, open_many, percent)).distinct()
            .join(tries, ["x", "y"], "left_anti"))
    return materialize(hit.union(_similar(materialize(rest, "rest"), texts, percent)), "later")


def _places(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, th, line_no, h) of every line with a word; (h, first, count) of every distinct one."""
    found = materialize(_lines(rows).select("id", "th", "line_no", "h"), "lines")
    nodes = found.select("h", F.struct("id", "th", "line_no").alias("p")).groupBy("h").agg(F.min("p").alias("first"), F.count("*").alias("count"))
    return found, materialize(nodes, "nodes")


def dedup_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, packed: bool = True) -> DataFrame:
    """(row, lines): the rows of ``docs`` as structs, their text less the removed lines.

    ``lines`` has n_lines, n_removed and ``emptied``: whether the text had a word and has none left, that is
    whether all of it repeats earlier lines. No column name of ``docs`` can clash.
    """
    rows = keyed(docs, id_col, text_col)
    if packed:
        found = materialize(rows.select("id", "th", "text").mapInArrow(_line_rows, LINES), "lines")
        nodes, later = later_matches(found, rows.select("text"), percent)
        found = found.where("part is null")
    else:
        found, nodes = _places(rows)
        later = similar_earlier(rows, nodes, percent)
    cut = (nodes.join(later.withColumn("gone", F.lit(True)), "h", "left")
           .select("h", "first", F.coalesce("gone", F.lit(False)).alias("gone"), "count").where("gone or count > 1").drop("count"))
    drop = (found.select("h", "id", "th", "line_no").join(cut, "h")
            .where(F.col("gone") | (F.col("first") != F.struct("id", "th", "line_no")))
            .groupBy("id", "th").agg(F.array_sort(F.collect_set("line_no")).alias("drop")))
    drop = materialize(drop, "drop")
    key = with_key(docs, id_col, text_col)
    touched = _bitmap(drop, "th")                        # other texts need no shuffle
    own = F.col("row").getField(text_col)
    n_lines = F.size(F.split(own, "\n"))
    nothing = F.struct(F.coalesce(n_lines, F.lit(0)).alias("n_lines"), F.lit(0).alias("n_removed"), F.lit(False).alias("emptied")).alias("lines")
    plain = key.where(~touched).select("row", nothing)
    parts = (key.where(touched).join(drop, ["id", "th"], "left")
             .select("row", "drop", F.split(own, "\n").alias("part")))
    stay = parts.withColumn("stay", F.when(F.col("drop").isNotNull(),
                                           F.array_except(F.sequence(F.lit(0), F.size("part") - 1), "drop")))
    text = F.when(F.col("drop").isNull(), own).otherwise(F.expr("array_join(transform(stay, i -> part[i]), '\n')"))
    emptied = F.col("drop").isNotNull() & own.rlike(_WORD) & ~text.rlike(_WORD)
    done = stay.select(F.col("row").withField(f"`{text_col}`", text).alias("row"),
                       F.struct(F.coalesce(F.size("part"), F.lit(0)).alias("n_lines"),
                                F.coalesce(F.size("drop"), F.lit(0)).alias("n_removed"),
                                F.coalesce(emptied, F.lit(False)).alias("emptied")).alias("lines"))
    return plain.union(done)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, packed: bool = True) -> DataFrame:
    """The rows of ``docs`` with their text less the removed lines, and struct ``_lines`` (in place of a column so named)."""
    rows = dedup_rows(docs, id_col, text_col, percent, packed)
    if "_lines" in docs.columns:
        rows = rows.withColumn("row", F.col("row").dropFields("_lines"))
    return rows.select("row.*", F.col("lines").alias("_lines"))


def digest(result: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return result.select(id_col, F.col("_lines.n_lines").cast("long").alias("n_lines"),
                         F.col("_lines.n_removed").cast("long").alias("n_removed"),
                         F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256).alias("kept_sha256"))
