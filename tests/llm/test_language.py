"""Language identification: forward-backward against enumeration, held-out accuracy, awkward texts."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from ridemart.llm import crf_language as crf
from tests.conftest import SF_CHECK
from tests.llm.test_narrow import awkward, frame


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    count, first = np.array([3, 0, 5, 1]), np.array([0, 3, 3, 8])
    psi, start, trans = rng.random((9, 3)) + .1, rng.random(3), rng.random((3, 3))
    chain = crf.Chain(count)
    at = chain.rows(first)
    got = np.zeros((9, 3))
    for t, g, _, _ in chain.marginals(psi[at], start, trans):
        got[at[chain.off[t]:chain.off[t + 1]]] = g
    for n, f in zip(count, first):
        want = np.zeros((n, 3))
        for y in itertools.product(range(3), repeat=int(n)):
            p = np.prod([psi[f + i, y[i]] * (start[y[0]] if i == 0 else trans[y[i - 1], y[i]]) for i in range(n)])
            for i in range(n):
                want[i, y[i]] += p
        assert np.allclose(got[f:f + n], want / want.sum(1, keepdims=True))


def test_held_out_accuracy_and_switches(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    r = (crf.identify_all(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
         .agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first())
    assert r[1] > 100 and r[0] > 0.97
    model = crf.train(docs, keep=~crf.held_out())
    en, de = (docs.where(F.col("lang") == l).orderBy("doc_id").first().text.split()[:25] for l in ("en", "de"))
    runs = crf.label_words(frame(spark, [" ".join(en + de)]), model).first().runs
    assert runs[0].lang == "en" and runs[-1].lang == "de" and sum(x.n_words for x in runs) >= 45


def test_undetermined_and_empty(spark):
    texts = awkward() + ["123 456", "¿— …", "日本"]
    docs = frame(spark, texts).withColumn("lang", F.lit("xx"))
    rows = {r.doc_id: r for r in crf.identify_all(docs).collect()}
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 for r in rows.values())
    for i, t in enumerate(texts):
        assert (rows[i].lang_pred == "und") == (not any(c.isalpha() for c in t or "")), i
    none = crf.identify_all(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in none} == {"und"}
    assert crf.identify_all(docs.limit(0)).count() == 0


def test_every_sampled_text_gives_a_bounded_stretch(spark):
    texts = ["aa " * 40_000, "bb cc", "é" * 9_000, " ".join("w%d" % i for i in range(5_000)), "", "x\n" * 3_000]
    rows = frame(spark, texts).select("text", crf.stretch(F.col("text"), F.xxhash64("doc_id", "text")).alias("s")).collect()
    for r in rows:
        assert len(r.s) <= crf.STRETCH_CHARS and r.s in r.text and (len(r.text) > crf.STRETCH_CHARS or r.s == r.text)
        assert set(r.s.split()) <= set(r.text.split()) or len(r.text.split()) == 1
        assert len(r.s) > crf.STRETCH_CHARS - 20 or r.s == r.text or len(r.text.split()) == 1
    # one very long text and many short ones of a label: words of all of them are learned
    own = [("z%sz y%sy " % (chr(97 + i), chr(97 + i))) * 30 for i in range(20)]
    docs = frame(spark, ["aa " * 100_000, *own]).withColumn("lang", F.lit("xx"))
    model = crf.train(docs)
    assert model.labels == ["xx"] and len(model.lexicon) >= 41
