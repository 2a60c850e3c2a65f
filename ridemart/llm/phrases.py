"""Phrase collocations from a weighted de Bruijn graph of three-word edges.

Texts are cut into pieces at punctuation and line ends, and pieces into words.
Per language, an edge (w1 w2 w3) joins the overlapping nodes (w1 w2) and
(w2 w3) and weighs as much as it occurs. Only edges are counted. A piece's
last two positions are edges into the piece's end, so every shorter count is
a flow: f(w1 w2) is the sum of the edges that leave the node, f(w1) the sum
over the nodes that begin with the word, ends included, and n the sum of all.

A node whose whole flow comes in by one edge and goes out by one edge lies on
a unary path. These paths are compacted by pointer doubling, in as many rounds
as the logarithm of the longest one; a path occurs in texts only as a whole,
so its inner two-word phrases are never worth reporting and its length tells
how long the fixed expression around a candidate is (``path_words``).

How it scales: a task counts the edges of about ``FLUSH_WORDS`` words before
it sends them, as packed columns, to buckets of ``BUCKET_BYTES`` of input. A
bucket owns whole words. Words with more than a bucket's fair share are dealt
by node and nodes with more than that by edge; which these are is estimated on
a sample of ``SAMPLE_BYTES`` (their number is at most 1 / share), and only
the load depends on it: partial flows of dealt keys are added up in Spark.
Everything at or above ``min_count`` is kept, nothing else is cut.

Defined results: null text counts as empty, null language as ``und``; empty
pieces have no words; repeated rows count again; an empty table gives an empty
result. Words are equal when their 64-bit hashes are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridemart.llm import tokens as tk
from ridemart.llm.frames import materialize, ship, task_partitions
from ridemart.plans.joins import maybe_broadcast
from ridemart.session import scratch_path

MIN_COUNT = 10
TOP = 2000
INSIDE_PERCENT = 50           # a phrase is dropped if a longer one has this share of its occurrences
FLUSH_WORDS = 1 << 20
BUCKET_BYTES = 4 << 20        # of the input's size on disk
SAMPLE_BYTES = 16 << 20
MAX_HOT = 1 << 16             # words and nodes that may be dealt further, each
UNKNOWN = "und"

BREAKS = np.zeros(256, bool)
BREAKS[list(b".,;:!?\n\x0b\x0c\r")] = True
WORDS = ~BREAKS
WORDS[[0x20, 0x09]] = False

PACKED = "bucket int, lang string, w1 binary, w2 binary, w3 binary, n binary, words binary"
COUNTS = "kind string, lang string, w1 long, w2 long, w3 long, n long, word string"
_END = np.uint64(0)           # the end of a piece, in place of a word


def combine(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    return tk.mix(h * np.uint64(0x9E3779B97F4A7C15) + w)


def _lang_hash(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def _keys(lang: np.ndarray, w1, w2):
    """Hashes of (language, word) and of (language, node)."""
    word = combine(lang, w1)
    return word, combine(word, w2)


class _Grams:
    """(w1, w2, w3) from every word of some texts, with the end of the piece for missing words."""

    def __init__(self, t: tk.Texts):
        self.words = w = tk.Words(t, WORDS, lower=True)
        h = w.hash
        h[h == _END] = np.uint64(1)
        breaks = np.concatenate([[0], np.cumsum(BREAKS[w.data])])
        joined = np.zeros(len(w), bool)
        joined[:-1] = (w.doc[1:] == w.doc[:-1]) & (breaks[w.start[1:]] == breaks[w.end[:-1]])
        self.w1 = h
        self.w2, self.w3 = np.full(len(h), _END), np.full(len(h), _END)
        i = np.flatnonzero(joined)
        self.w2[i] = h[i + 1]
        self.w3[i] = self.w2[i + 1]


def _texts(batch: pa.RecordBatch):
    """Slices of a batch and the language number of every text, with the languages."""
    langs = batch.column(0).dictionary_encode()
    names, codes = langs.dictionary.to_pylist(), np.asarray(langs.indices)
    for lo, t in tk.slices(batch.column(1)):
        yield t, codes[lo:lo + t.n], names


def _member(keys: np.ndarray, of: np.ndarray) -> np.ndarray:
    if not len(of):
        return np.zeros(len(keys), bool)
    return of[np.minimum(np.searchsorted(of, keys), len(of) - 1)] == keys


def _bucket(word, node, w3, hot_words, hot_nodes, n: int) -> np.ndarray:
    key = word.copy()
    dealt = np.flatnonzero(_member(word, hot_words))
    key[dealt] = node[dealt]
    further = dealt[_member(node[dealt], hot_nodes)]
    key[further] = combine(node[further], w3[further])
    return ((key >> np.uint64(20)) % np.uint64(n)).astype(np.int32)


def _edges(n_buckets: int, hot_words: np.ndarray, hot_nodes: np.ndarray, flush_words: int):
    def run(batches):
        seen = np.zeros(0, np.uint64)                   # words this task has spelled already (bounded, see below)
        langs: dict[str, int] = {}
        held, size, spelled = [], 0, []

        def flush():
            nonlocal seen
            if not held:
                return
            code, w1, w2, w3 = (np.concatenate(x) for x in zip(*held))
            names = list(langs)
            word, node = _keys(np.array([_lang_hash(x) for x in names], np.uint64)[code], w1, w2)
            _, at, n = np.unique(combine(node, w3), return_index=True, return_counts=True)
            code, w1, w2, w3, word, node = (x[at] for x in (code, w1, w2, w3, word, node))
            bucket = _bucket(word, node, w3, hot_words, hot_nodes, n_buckets)
            order = np.lexsort((w2, w1, code, bucket))
            code, w1, w2, w3, n, bucket = (x[order] for x in (code, w1, w2, w3, n.astype(np.uint32), bucket))
            edge = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (code[1:] != code[:-1])]))
            rows = [(int(bucket[a]), names[code[a]], *(x[a:z].tobytes() for x in (w1, w2, w3, n)), None)
                    for a, z in zip(edge, [*edge[1:], len(bucket)])]
            # the spelling of words that are new to this task, to the bucket of the word itself
            h, text = zip(*spelled) if spelled else ((), ())
            h, text = np.concatenate([*h, np.zeros(0, np.uint64)]), [x for part in text for x in part]
            h, at = np.unique(h, return_index=True)
            seen = np.union1d(seen, h) if len(seen) < flush_words else h
            to = ((h >> np.uint64(20)) % np.uint64(n_buckets)).astype(np.int32)
            order = np.argsort(to, kind="stable")
            edge = np.flatnonzero(np.concatenate([[True], np.diff(to[order]) != 0])) if len(order) else []
            rows += [(int(to[order[a]]), None, h[order[a:z]].tobytes(), None, None, None, b"\n".join(text[i] for i in at[order[a:z]]))
                     for a, z in zip(edge, [*edge[1:], len(order)])]
            held.clear()
            spelled.clear()
            kinds = (pa.int32(), pa.string(), *[pa.binary()] * 5)
            for lo in range(0, len(rows), 1000):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[lo:lo + 1000]), kinds)],
                                                 names=[f.split()[0] for f in PACKED.split(", ")])

        for batch in batches:
            for t, codes, names in _texts(batch):
                g = _Grams(t)
                if not len(g.w1):
                    continue
                own = np.array([langs.setdefault(x, len(langs)) for x in names], np.int32)[codes]
                held.append((own[g.words.doc], g.w1, g.w2, g.w3))
                h, at = np.unique(g.w1, return_index=True)
                new = ~_member(h, seen)
                raw, start, end = g.words.data.tobytes(), g.words.start, g.words.end
                spelled.append((h[new], [raw[start[i]:end[i]] for i in at[new]]))
                size += len(g.w1)
                if size >= flush_words:
                    yield from flush()
                    size = 0
        yield from flush()
    return run


def _starts(*cols: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins."""
    new = np.ones(len(cols[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
    return np.flatnonzero(new)


def _count(hot_words: np.ndarray, hot_nodes: np.ndarray, min_count: int):
    def run(rows: pa.Table) -> pa.Table:
        out = []

        def put(kind, lang, w1=None, w2=None, w3=None, n=None, word=None):
            size = len(w1) if w1 is not None else 1
            cols = [pa.array(tk.as_long(x), pa.int64()) if x is not None else pa.nulls(size, pa.int64()) for x in (w1, w2, w3)]
            out.append(pa.table([pa.array([kind] * size, pa.string()), pa.array([lang] * size, pa.string()), *cols,
                                 pa.array(n, pa.int64()) if n is not None else pa.nulls(size, pa.int64()),
                                 pa.array(word, pa.string()) if word is not None else pa.nulls(size, pa.string())],
                                names=[f.split()[0] for f in COUNTS.split(", ")]))

        langs = rows.column("lang").to_pylist()
        blobs = [rows.column(c) for c in ("w1", "w2", "w3", "n")]

        def joined(c, at, kind):
            return np.concatenate([np.frombuffer(blobs[c][i].as_buffer(), kind) for i in at])

        for lang in sorted({x for x in langs if x is not None}):
            at = [i for i, x in enumerate(langs) if x == lang]
            w1, w2, w3 = (joined(c, at, np.uint64) for c in range(3))
            n = joined(3, at, np.uint32).astype(np.int64)
            word, node = _keys(np.full(len(w1), _lang_hash(lang)), w1, w2)
            order = np.lexsort((w3, node, word))
            w1, w2, w3, n, word, node = (x[order] for x in (w1, w2, w3, n, word, node))
            s = _starts(word)
            flow, dealt = np.add.reduceat(n, s), _member(word[s], hot_words)
            keep = dealt | (flow >= min_count)
            put("total", lang, n=[int(n.sum())])
            put("word", lang, w1[s][keep], n=flow[keep])
            s = _starts(word, node)
            flow = np.add.reduceat(n, s)
            keep = (w2[s] != _END) & (_member(node[s], hot_nodes) & _member(word[s], hot_words) | (flow >= min_count))
            put("node", lang, w1[s][keep], w2[s][keep], n=flow[keep])
            s = _starts(word, node, w3)
            flow = np.add.reduceat(n, s)
            keep = (w3[s] != _END) & (flow >= min_count)
            put("edge", lang, w1[s][keep], w2[s][keep], w3[s][keep], n=flow[keep])
        at = [i for i, x in enumerate(langs) if x is None]
        if at:
            h, first = np.unique(joined(0, at, np.uint64), return_index=True)
            text = [x for i in at for x in rows.column("words")[i].as_py().split(b"\n")]
            put("spelling", None, h, word=[text[i].decode() for i in first])
        return pa.concat_tables(out)
    return run


def _heavy(batches):
    """Counts of (language, word) and (language, node) hashes of a sample."""
    for batch in batches:
        for t, codes, names in _texts(batch):
            g = _Grams(t)
            lang = np.array([_lang_hash(x) for x in names], np.uint64)[codes][g.words.doc]
            for kind, keys in enumerate(_keys(lang, g.w1, g.w2)):
                h, n = np.unique(keys, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), kind), pa.int32()), pa.array(tk.as_long(h)), pa.array(n, pa.int64())],
                                                 names=["kind", "h", "n"])


def heavy_keys(texts: DataFrame, n_buckets: int, disk_bytes: int) -> list[np.ndarray]:
    """Words and nodes that hold a fourth of a bucket's share or more in a sample, sorted hashes of each."""
    fraction = min(1.0, SAMPLE_BYTES / max(1, disk_bytes))
    some = texts.sample(False, fraction, seed=7) if fraction < 1 else texts
    counts = some.mapInArrow(_heavy, "kind int, h long, n long").groupBy("kind", "h").agg(F.sum("n").alias("n"))
    share = max(1 / (4 * n_buckets), 1 / MAX_HOT)
    counts = materialize(counts.where("n > 1"), "heavy")
    n = (counts.where("kind = 0").agg(F.sum("n")).first()[0] or 0)
    found = counts.where(F.col("n") >= max(2, share * n)).select("kind", "h").collect()      # at most 1 / share of each kind
    return [np.sort(np.array([r.h for r in found if r.kind == k], np.int64).view(np.uint64)) for k in (0, 1)]


def graph(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT,
          flush_words: int = FLUSH_WORDS, bucket_bytes: int = BUCKET_BYTES) -> dict[str, DataFrame]:
    """Edges, nodes and words that occur ``min_count`` times, all words' total, and the spelling of word hashes."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(UNKNOWN)).alias("lang"),
                        F.col(f"`{text_col}`").cast("string").alias("text"))
    size = int(texts._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    size = size if size < 1 << 60 else 0                # unknown to the planner
    n_buckets = min(max(task_partitions(spark), size // bucket_bytes), 1 << 24)
    hot = heavy_keys(texts, n_buckets, size)
    path = scratch_path(spark, "llm-phrases")
    (texts.mapInArrow(_edges(n_buckets, *hot, flush_words), PACKED).groupBy("bucket").applyInArrow(_count(*hot, min_count), COUNTS)
     .write.partitionBy("kind").parquet(path))
    rows = spark.read.schema(COUNTS).option("basePath", path).parquet(path)

    def part(kind: str, *cols: str) -> DataFrame:
        return rows.where(F.col("kind") == kind).select(*cols)

    def flow(kind: str, *cols: str) -> DataFrame:
        return part(kind, *cols, "n").groupBy(*cols).agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)

    return {"edges": part("edge", "lang", "w1", "w2", "w3", "n"), "nodes": flow("node", "lang", "w1", "w2"),
            "words": flow("word", "lang", "w1"), "totals": part("total", "lang", "n").groupBy("lang").agg(F.sum("n").alias("n")),
            "spelling": part("spelling", "w1", "word")}


def flows(g: dict[str, DataFrame]) -> DataFrame:
    """Nodes with their largest edge in and out; ``unary`` where one edge each carries the whole flow."""
    out = g["edges"].groupBy("lang", "w1", "w2").agg(F.max("n").alias("most_out"))
    into = (g["edges"].groupBy("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"))
            .agg(F.max("n").alias("most_in"), F.max_by("w1", "n").alias("w0")))
    nodes = g["nodes"].join(out, ["lang", "w1", "w2"], "left").join(into, ["lang", "w1", "w2"], "left")
    return nodes.withColumn("unary", F.coalesce((F.col("most_out") == F.col("n")) & (F.col("most_in") == F.col("n")), F.lit(False)))


def compacted(nodes: DataFrame) -> DataFrame:
    """For every unary node the first edge of its path (h1, h2, h3) and how many edges back that is.

    Pointer doubling: a node points to the one before it and takes over that
    node's pointer while it points to a unary node. A path occurs in texts as
    a whole, so no path is longer than the longest piece, and none is a ring.
    """
    one = nodes.where("unary").select("lang", "w1", "w2", F.col("w0").alias("p1"), F.col("w1").alias("p2"),
                                      F.col("w0").alias("h1"), F.col("w1").alias("h2"), F.col("w2").alias("h3"), F.lit(1).cast("long").alias("back"))
    at = materialize(one, "paths")
    while True:
        ahead = at.select("lang", F.col("w1").alias("p1"), F.col("w2").alias("p2"), F.struct("p1", "p2", "h1", "h2", "h3", "back").alias("to"))
        step = at.join(ahead, ["lang", "p1", "p2"], "left")
        cols = [F.coalesce(F.col(f"to.{c}"), F.col(c)).alias(c) for c in ("p1", "p2", "h1", "h2", "h3")]
        at = materialize(step.select("lang", "w1", "w2", *cols, (F.col("back") + F.coalesce(F.col("to.back"), F.lit(0))).alias("back"),
                                     F.col("to").isNotNull().alias("moved")), "paths")
        if at.where("moved").isEmpty():
            return at.drop("moved")
        at = at.drop("moved")


def path_lengths(edges: DataFrame, paths: DataFrame) -> DataFrame:
    """Every edge with the number of words of the unary path it lies on (3 if its ends branch)."""
    length = paths.groupBy("lang", "h1", "h2", "h3").agg(F.max("back").alias("further"))
    inner = edges.join(paths.select("lang", "w1", "w2", "h1", "h2", "h3"), ["lang", "w1", "w2"], "left")
    head = [F.coalesce(F.col(h), F.col(w)).alias(h) for h, w in (("h1", "w1"), ("h2", "w2"), ("h3", "w3"))]
    return (inner.select("lang", "w1", "w2", "w3", "n", *head).join(length, ["lang", "h1", "h2", "h3"], "left")
            .select("lang", "w1", "w2", "w3", "n", (3 + F.coalesce("further", F.lit(0))).alias("path_words")))


def _score(left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)) without rounding."""
    return F.expr(f"(cast(a as decimal(19,0)) * cast(a as decimal(19,0)) * cast(1000000 as decimal(7,0))) div "
                  f"(cast({left} as decimal(19,0)) * cast({right} as decimal(19,0)))")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT, top: int = TOP,
                 inside_percent: int = INSIDE_PERCENT, flush_words: int = FLUSH_WORDS, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The best ``top`` phrases of two and three words of every language: lang, rank, phrase, a, l, r, n, score, path_words."""
    g = graph(docs, lang_col, text_col, min_count, flush_words, bucket_bytes)
    nodes = materialize(flows(g), "nodes")
    words = materialize(g["words"], "words")
    word = {w: words.select("lang", F.col("w1").alias(w), F.col("n").alias(f"f{w[1]}")) for w in ("w1", "w2", "w3")}
    edges = path_lengths(g["edges"], compacted(nodes))
    flow = nodes.select("lang", "w1", "w2", F.col("n").alias("f"))
    three = (edges.withColumnRenamed("n", "a")
             .join(flow.withColumnRenamed("f", "f12"), ["lang", "w1", "w2"])
             .join(flow.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("f").alias("f23")), ["lang", "w2", "w3"])
             .join(word["w1"], ["lang", "w1"]).join(word["w3"], ["lang", "w3"])
             .withColumn("s1", _score("f1", "f23")).withColumn("s2", _score("f12", "f3")))
    early = F.col("s1") <= F.col("s2")
    three = three.select("lang", "w1", "w2", "w3", "a", F.when(early, F.col("f1")).otherwise(F.col("f12")).alias("l"),
                         F.when(early, F.col("f23")).otherwise(F.col("f3")).alias("r"), F.least("s1", "s2").alias("score"), "path_words")
    inside = 100 * F.greatest(F.coalesce("most_out", F.lit(0)), F.coalesce("most_in", F.lit(0))) >= inside_percent * F.col("n")
    two = (nodes.where(~inside).select("lang", "w1", "w2", F.col("n").alias("a")).join(word["w1"], ["lang", "w1"]).join(word["w2"], ["lang", "w2"])
           .select("lang", "w1", "w2", F.lit(None).cast("long").alias("w3"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"),
                   _score("f1", "f2").alias("score"), F.lit(2).cast("long").alias("path_words")))
    by = [F.col("score").desc(), F.col("a").desc()]
    # spelling settles ties only: everything that can still be among the first is spelled
    best = materialize(three.unionByName(two).withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*by)))
                       .where(F.col("place") <= top).drop("place"), "phrases")
    needed = best.select(F.explode(F.array("w1", "w2", "w3")).alias("w1")).where("w1 is not null").distinct()
    spelled = materialize(g["spelling"].join(maybe_broadcast(needed), "w1", "left_semi").dropDuplicates(["w1"]), "spelled")
    for w in ("w1", "w2", "w3"):
        best = best.join(spelled.select(F.col("w1").alias(w), F.col("word").alias(f"t{w}")), w, "left")
    best = best.withColumn("phrase", F.concat_ws(" ", "tw1", "tw2", "tw3")).join(g["totals"], "lang")
    order = Window.partitionBy("lang").orderBy(*by, F.col("phrase"))
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "path_words"))


def unary_paths(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT) -> DataFrame:
    """The compacted paths themselves: fixed expressions of four words and more (lang, phrase, n_words, n)."""
    g = graph(docs, lang_col, text_col, min_count)
    nodes = materialize(flows(g), "nodes")
    paths = compacted(nodes).join(nodes.select("lang", "w1", "w2", "n"), ["lang", "w1", "w2"])
    # word i + 3 of a path is the last word of the node i edges behind its first edge
    word = F.explode(F.when(F.col("back") == 1, F.array(*[F.struct(F.lit(i).cast("long").alias("i"), F.col(h).alias("w1")) for i, h in enumerate(("h1", "h2", "h3"))]))
                     .otherwise(F.array(F.struct((F.col("back") + 1).alias("i"), F.col("w2").alias("w1")))))
    head = ["lang", "h1", "h2", "h3"]
    last = (g["edges"].join(paths.select(*head, "w1", "w2", "back"), ["lang", "w1", "w2"])
            .select(*head, F.struct((F.col("back") + 2).alias("i"), F.col("w3").alias("w1")).alias("x"), "n"))
    every = paths.select(*head, word.alias("x"), "n").unionByName(last).select(*head, "x.i", "x.w1", "n").distinct()
    return (every.join(g["spelling"].dropDuplicates(["w1"]), "w1").groupBy(*head)
            .agg(F.sort_array(F.collect_list(F.struct("i", "word"))).alias("x"), F.max("n").alias("n"))
            .select("lang", F.concat_ws(" ", "x.word").alias("phrase"), F.size("x").cast("long").alias("n_words"), "n"))
