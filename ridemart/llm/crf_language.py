"""Language identification by a linear-chain conditional random field over words.

Every word of a text gets a language from its affix, n-gram and lexicon
features and from learned transitions to its neighbours; forward-backward
gives each word's marginal distribution. A text's language is the one with
the largest mean marginal, its score that mean. Code-switched text is thus
labelled word by word, see :func:`label_words`.

Training uses a bounded sample of labelled rows: at most ``DOCS_PER_LABEL``
texts for each label, chosen by a hash of the doc_id, and of each of them a
stretch of ``STRETCH_CHARS`` characters from a hashed place, cut in the tasks,
so that every sampled text counts and what is collected is bounded in bytes. From it, sequences that switch between labels are put together, so
that transitions are learned as well. The model is a few arrays of fixed
size (``2^FEATURE_BITS`` weights a label), fitted by AdaGrad on the driver;
everything that reads the corpus runs in tasks, one pass, no shuffle but the
sample's.

Defined results: null text, or text without a letter, is ``und`` with score
0; without any training row everything is ``und``; repeated rows give equal
rows; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridemart.llm import tokens as tk
from ridemart.llm.frames import ship, slim

UNDETERMINED = "und"
DOCS_PER_LABEL = 150
STRETCH_CHARS = 2_500       # of every sampled text: about 400 words, 60,000 a label
FEATURE_BITS = 16
LEXICON = 400             # frequent words kept for each label
SEQUENCE = 48             # words of a training sequence
BATCH = 192
STEPS = 150
RATE = 0.3
RIDGE = 1e-5
TASK_BYTES = 1 << 20      # text handled at once in a task

#: Words: runs of ASCII letters and non-ASCII bytes.
LETTERS = tk.byte_class((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def lower_bytes(data: np.ndarray) -> np.ndarray:
    """Lower case of ASCII and Latin-1 letters in UTF-8 bytes."""
    out = tk.LOWER[data]
    if len(out) > 1:
        latin = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
        out[latin] += 0x20
    return out


class WordTypes:
    """The distinct words of a slice and their features (affixes, byte n-grams, lexicon word)."""

    def __init__(self, t: tk.Texts):
        low = tk.Texts.__new__(tk.Texts)
        low.data, low.off, low.n = lower_bytes(t.data), t.off, t.n
        self.words = w = tk.Words(low, LETTERS)
        self.key, at, self.index = np.unique(w.hash, return_index=True, return_inverse=True)
        start, size = w.start[at], w.end[at] - w.start[at]
        self.n = len(at)
        edge = np.concatenate([[0], np.cumsum(size + 2)])
        buf = np.full(edge[-1], 0x3C, np.uint8)                      # <word>
        inner = np.arange(int(size.sum())) + np.repeat(2 * np.arange(self.n) + 1, size)
        src = np.arange(int(size.sum())) + np.repeat(start - (np.cumsum(size) - size), size)
        buf[inner] = low.data[src]
        buf[edge[1:] - 1] = 0x3E
        self.buf, self.edge, self.size = buf, edge, size + 2
        self.hash_of = tk.SpanHash(buf)

    def features(self, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers word by word, and how many each word has."""
        bits = np.uint64(64 - FEATURE_BITS)
        own = np.repeat(np.arange(self.n), self.size)
        end = self.edge[1:]
        ids, of = [], []
        for k in (2, 3, 4):                                          # n-grams, those with < or > are affixes
            p = np.arange(len(self.buf))
            ok = p + k <= end[own]
            p = p[ok]
            ids.append(tk.mix(self.hash_of(p, p + k) + np.uint64(k)) >> bits)
            of.append(own[ok])
        for k in (4, 5):                                             # longer affixes, told from n-grams by their kind
            w = np.flatnonzero(self.size > k)
            for kind, s in ((11, self.edge[:-1][w]), (13, end[w] - k)):
                ids.append(tk.mix(self.hash_of(s, s + k) + np.uint64(kind)) >> bits)
                of.append(w)
        i = np.searchsorted(lexicon, self.key)
        known = (i < len(lexicon)) & (lexicon[np.minimum(i, max(len(lexicon) - 1, 0))] == self.key if len(lexicon) else False)
        ids.append(np.where(known, tk.mix(self.key + np.uint64(17)) >> bits, np.uint64(0)))
        of.append(np.arange(self.n))
        ids, of = np.concatenate(ids).astype(np.int64), np.concatenate(of)
        order = np.argsort(of, kind="stable")
        return ids[order], np.bincount(of, minlength=self.n)


def emissions(weights: np.ndarray, ids: np.ndarray, count: np.ndarray) -> np.ndarray:
    off = np.concatenate([[0], np.cumsum(count)[:-1]])
    if not len(count):
        return np.zeros((0, weights.shape[1]))
    return np.add.reduceat(weights[ids], off, axis=0) / np.sqrt(count)[:, None]


class Chain:
    """Time-major layout of sequences of different length, longest first."""

    def __init__(self, count: np.ndarray):
        self.order = np.argsort(-count, kind="stable")
        length = count[self.order]
        self.length = length[length > 0]
        self.order = self.order[:len(self.length)]
        top = int(self.length[0]) if len(self.length) else 0
        self.active = len(self.length) - np.searchsorted(self.length[::-1], np.arange(top), "right")
        self.off = np.concatenate([[0], np.cumsum(self.active)])

    def rows(self, first: np.ndarray) -> np.ndarray:
        """Item positions in time-major order."""
        t = np.repeat(np.arange(len(self.active)), self.active)
        r = np.arange(self.off[-1]) - self.off[t]
        return first[self.order][r] + t

    def marginals(self, psi: np.ndarray, start: np.ndarray, trans: np.ndarray):
        """Yields (t, marginals, forward message, backward message from t+1), from the last step to the first."""
        alpha = np.empty_like(psi)
        a = None
        for t, k in enumerate(self.active):
            x = psi[self.off[t]:self.off[t + 1]]
            a = x * (start if t == 0 else a[:k] @ trans)
            a /= a.sum(1, keepdims=True)
            alpha[self.off[t]:self.off[t + 1]] = a
        back = np.ones((0, psi.shape[1]))
        ahead = back
        for t in range(len(self.active) - 1, -1, -1):
            k = self.active[t]
            beta = np.ones((k, psi.shape[1]))
            if len(back):
                beta[:len(back)] = back
            g = alpha[self.off[t]:self.off[t + 1]] * beta
            g /= g.sum(1, keepdims=True)
            yield t, g, alpha[self.off[t]:self.off[t + 1]], ahead
            if t:
                ahead = psi[self.off[t]:self.off[t + 1]] * beta
                back = ahead @ trans.T
                back /= back.sum(1, keepdims=True)


class Model:
    def __init__(self, labels, weights, start, trans, lexicon):
        self.labels, self.weights, self.start, self.trans, self.lexicon = labels, weights, start, trans, lexicon

    def potentials(self, types: WordTypes) -> np.ndarray:
        e = emissions(self.weights, *types.features(self.lexicon))
        return np.exp(e - e.max(1, keepdims=True)) + 1e-12 if len(e) else e


def _softmax(x):
    x = np.exp(x - x.max(-1, keepdims=True))
    return x / x.sum(-1, keepdims=True)


def fit(sample: list[tuple[str, str]], seed: int = 7) -> Model | None:
    """Model from (label, text) rows, learned in the order given; None without a word to learn from."""
    rng = np.random.default_rng(seed)
    labels = sorted({l for l, _ in sample})
    if not labels:
        return None
    texts = [pa.array([t for l, t in sample if l == label]) for label in labels]
    types = WordTypes(tk.Texts(pa.concat_arrays(texts)))
    doc_label = np.repeat(np.arange(len(labels)), [len(x) for x in texts])
    word_label = doc_label[types.words.doc]
    streams, lexicon = [], []
    for i in range(len(labels)):
        s = types.index[word_label == i]
        if len(s):
            n = np.bincount(s, minlength=types.n)
            top = np.argsort(-n, kind="stable")[:LEXICON]
            lexicon.append(types.key[top[n[top] > 1]])
        streams.append(s)
    keep = [i for i, s in enumerate(streams) if len(s)]
    if not keep:
        return None
    labels, streams = [labels[i] for i in keep], [streams[i] for i in keep]
    lexicon = np.unique(np.concatenate(lexicon))
    ids, count = types.features(lexicon)
    begin = np.concatenate([[0], np.cumsum(count)])
    n_label = len(labels)
    w = np.zeros((1 << FEATURE_BITS, n_label), np.float32)
    w2 = np.full_like(w, 1e-6)
    start, trans = np.zeros(n_label), np.zeros((n_label, n_label))
    s2, t2 = np.full(n_label, 1e-6), np.full((n_label, n_label), 1e-6)
    chain = Chain(np.full(BATCH, SEQUENCE))
    for _ in range(STEPS):
        # sequences of runs, each run a piece of one label's text
        y = np.empty((SEQUENCE, BATCH), np.int64)
        x = np.empty((SEQUENCE, BATCH), np.int64)
        cur = rng.integers(n_label, size=BATCH)
        at = [rng.integers(len(s), size=BATCH) for s in streams]
        at = np.stack(at)
        for t in range(SEQUENCE):
            if t:
                switch = rng.random(BATCH) < 0.06
                cur = np.where(switch, rng.integers(n_label, size=BATCH), cur)
            y[t] = cur
            for i, s in enumerate(streams):
                m = cur == i
                x[t, m] = s[(at[i, m] + t) % len(s)]
        used, inv = np.unique(x.reshape(-1), return_inverse=True)
        fid, cnt = tk.gather(ids, begin[:-1], count, used)
        e = emissions(w, fid, cnt)
        psi = np.exp(e - e.max(1, keepdims=True))[inv] + 1e-12
        g = np.empty_like(psi)
        ps, pt = _softmax(start), np.exp(trans)
        expected = np.zeros((n_label, n_label))
        for t, m, before, ahead in chain.marginals(psi, ps, pt):
            g[t * BATCH:(t + 1) * BATCH] = m
            if len(ahead):
                joint = before[:, :, None] * pt[None] * ahead[:, None, :]
                expected += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
        truth = np.zeros_like(g)
        truth[np.arange(len(g)), y.reshape(-1)] = 1
        delta = truth - g
        per_word = np.zeros((len(used), n_label))
        np.add.at(per_word, inv, delta)
        grad = np.zeros_like(w, dtype=np.float64)
        np.add.at(grad, fid, np.repeat(per_word / np.sqrt(cnt)[:, None], cnt, axis=0))
        grad = grad / BATCH - RIDGE * w
        w2 += grad ** 2
        w += (RATE * grad / np.sqrt(w2)).astype(np.float32)
        gs = delta[:BATCH].mean(0)
        s2 += gs ** 2
        start += RATE * gs / np.sqrt(s2)
        seen = np.zeros((n_label, n_label))
        np.add.at(seen, (y[:-1].reshape(-1), y[1:].reshape(-1)), 1)
        gt = (seen - expected) / seen.sum() - RIDGE * trans
        t2 += gt ** 2
        trans += 0.1 * gt / np.sqrt(t2)
    return Model(labels, w, _softmax(start), np.exp(trans), lexicon)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
          keep: Column | None = None, docs_per_label: int = DOCS_PER_LABEL) -> Model | None:
    """Fit on a bounded sample of the labelled rows that satisfy ``keep``."""
    rows = docs.where(F.col(f"`{label_col}`").isNotNull() & F.col(f"`{text_col}`").isNotNull())
    if keep is not None:
        rows = rows.where(keep)
    text = F.col(f"`{text_col}`").cast("string")
    rows = rows.select(F.col(f"`{label_col}`").cast("string").alias("label"), text.alias("text"),
                       F.xxhash64(F.col(f"`{id_col}`").cast("string"), F.lit(11)).alias("pick"))
    first = Window.partitionBy("label").orderBy("pick", F.xxhash64("text"))
    # cut before the ranking, so that no task ever sorts or sends whole texts
    rows = rows.select("label", "pick", stretch(F.col("text"), F.xxhash64("pick", "text")).alias("text"))
    picked = rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= docs_per_label)
    # docs_per_label stretches of STRETCH_CHARS a label at most, in the order of their hash
    got = sorted((r.label, r.pick, r.text) for r in picked.select("label", "pick", "text").collect())
    model = fit([(label, t) for label, _, t in got])
    tk.trim()                      # the driver would hold on to what the features took
    return model


def stretch(text: Column, pick: Column, chars: int = STRETCH_CHARS) -> Column:
    """At most ``chars`` characters of a text from a place that ``pick`` chooses, without the words cut at its ends."""
    spare = F.greatest(F.length(text) - chars, F.lit(0))
    at = F.pmod(pick, spare + 1)
    piece = F.substr(text, at.cast("int") + 1, F.lit(chars))
    piece = F.when(at > 0, F.regexp_replace(piece, r"^[^\x20\x09-\x0D]+(?=[\x20\x09-\x0D])", "")).otherwise(piece)
    return F.when(at < spare, F.regexp_replace(piece, r"(?<=[\x20\x09-\x0D])[^\x20\x09-\x0D]+$", "")).otherwise(piece)


def _no_letter(t: tk.Texts, words: tk.Words) -> np.ndarray:
    """Texts without any letter; only texts without an ASCII letter need a closer look."""
    ascii_letter = np.concatenate([[0], np.cumsum(LETTERS[t.data] & (t.data < 0x80))])
    none = ascii_letter[t.off[1:]] == ascii_letter[t.off[:-1]]
    for i in np.flatnonzero(none & (words.count > 0)):
        none[i] = not any(c.isalpha() for c in t.data[t.off[i]:t.off[i + 1]].tobytes().decode("utf-8", "replace"))
    return none


def _judge(model: Model | None, t: tk.Texts, runs: bool):
    """Language, score, number of words and runs of every text of a slice."""
    pred, score, spans = [UNDETERMINED] * t.n, np.zeros(t.n), [[] for _ in range(t.n)]
    types = WordTypes(t)
    n_words = types.words.count
    if model is None or not len(types.words):
        return pred, score, n_words, spans
    chain = Chain(n_words)
    at = chain.rows(types.words.first[:t.n])
    psi = model.potentials(types)[types.index[at]]
    total = np.zeros((len(chain.order), len(model.labels)))
    best = np.empty(len(at), np.int32) if runs else None
    for step, g, _, _ in chain.marginals(psi, model.start, model.trans):
        total[:len(g)] += g
        if runs:
            best[at[chain.off[step]:chain.off[step + 1]]] = g.argmax(1)
    mean = total / chain.length[:, None]
    und = _no_letter(t, types.words)
    for r, d in enumerate(chain.order):
        if not und[d]:
            k = int(mean[r].argmax())
            pred[d], score[d] = model.labels[k], min(1.0, float(mean[r, k]))
            if runs:
                y = best[types.words.first[d]:types.words.first[d + 1]]
                edge = np.concatenate([[0], np.flatnonzero(np.diff(y)) + 1, [len(y)]])
                spans[d] = [{"lang": model.labels[y[i]], "n_words": int(j - i)} for i, j in zip(edge[:-1], edge[1:])]
    return pred, score, n_words, spans


def _predict(model: Model | None, keep: list[str], text_col: str, runs: bool):
    def rows(batches):
        for b in batches:
            at_col = b.schema.get_field_index
            for lo, t in tk.slices(b.column(at_col(text_col)), TASK_BYTES):
                pred, score, n_words, spans = _judge(model, t, runs)
                cols = [b.column(at_col(c)).slice(lo, t.n) for c in keep]
                cols += [pa.array(pred), pa.array(score), pa.array(n_words.astype(np.int64))]
                names = [*keep, "lang_pred", "score", "n_words"]
                if runs:
                    cols.append(pa.array(spans, pa.list_(pa.struct([("lang", pa.string()), ("n_words", pa.int32())]))))
                    names.append("runs")
                yield pa.RecordBatch.from_arrays(cols, names=names)
    return rows


def annotate(docs: DataFrame, model: Model | None, text_col: str = "text", runs: bool = False) -> DataFrame:
    """The rows of ``docs`` with lang_pred, score and n_words (and ``runs``), in place of columns so named."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)                   # fixed size: 2^FEATURE_BITS weights a label
    added = ["lang_pred", "score", "n_words"] + ["runs"] * runs
    keep = [c for c in docs.columns if c not in added]
    new = "lang_pred string, score double, n_words long" + ", runs array<struct<lang:string,n_words:int>>" * runs
    schema = T.StructType(docs.select([f"`{c}`" for c in keep]).schema.fields + T.StructType.fromDDL(new).fields)

    def task(batches):
        return _predict(shared.value, keep, text_col, runs)(batches)
    return docs.select([f"`{c}`" for c in keep]).mapInArrow(task, schema)


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score, n_words."""
    return annotate(slim(docs, id_col, text_col), model).drop("text")


def label_words(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The same with ``runs``: the languages of consecutive words, in order."""
    return annotate(slim(docs, id_col, text_col), model, runs=True).drop("text")


def accepted(min_score: float = 0.5, short: int = 10) -> Column:
    """Rows of :func:`annotate` with a language: texts of ``short`` words or more need ``min_score`` for it."""
    return (F.col("lang_pred") != UNDETERMINED) & ((F.col("score") >= min_score) | (F.col("n_words") < short))


def identify_all(docs: DataFrame) -> DataFrame:
    """Learn from the rows that are not held out, predict every row."""
    model = train(docs, keep=~held_out())
    return (identify(docs, model).withColumn("held_out", held_out())
            .select("doc_id", "held_out", "lang_pred", "score", "n_words"))
