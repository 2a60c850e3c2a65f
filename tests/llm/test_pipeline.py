"""The corpus pipeline against plain Python, stage by stage, and the registration of the queries."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as cp
from tests.conftest import SF_CHECK, SF_SMALL
from tests.llm import brute

WORD = r"[^\x20\x09-\x0D]"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """The sf0.001 documents with copies, near copies, benchmark passages, empty and odd rows added."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(COLUMNS).collect()]
    bench = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    extra = []
    for i, d in enumerate(docs[:30]):
        extra.append((10_000 + i, d[1] + " closing", *d[2:]))
        extra.append((20_000 + i, d[1], *d[2:]))
    extra += [(30_000 + i, f"{docs[40 + i][1][:200]} {b[1]}", "en", "x", 1) for i, b in enumerate(bench[:8])]
    extra += [(40_000, None, "en", None, None), (40_001, "", None, "x", 0), (40_002, "12 34", "en", "x", 5), (40_003, "word", "en", "x", 4)]
    schema = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(COLUMNS).schema
    spark.createDataFrame(docs + extra, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, docs + extra, bench


def test_stages_match_plain_python(spark, corpus):
    folder, rows, bench = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = cp.keep_known_language(spark, docs, folder)
    assert got.columns == COLUMNS
    kept = {r.doc_id: r.text for r in got.collect()}
    letters = {d[0] for d in rows if re.search(r"[^\W\d_]", d[1] or "")}
    assert set(kept) <= letters and len(kept) >= 0.97 * len(letters)

    lined = cp.drop_repeated_lines(spark, got, folder)
    assert lined.columns == COLUMNS
    want = dict(zip(kept, brute.earlier_lines(list(kept.items()))))
    emptied = {i for i, t in want.items() if re.search(WORD, kept[i]) and not re.search(WORD, t)}
    assert len(emptied) >= 25                                   # the planted exact copies at least
    assert {i for i in kept if 20_000 <= i < 30_000} <= emptied
    want = {i: t for i, t in want.items() if i not in emptied}
    have = {r.doc_id: (r.text, r.n_chars) for r in lined.collect()}
    assert have == {i: (t, len(t)) for i, t in want.items()}

    single = cp.one_of_near_duplicates(spark, lined, folder)
    assert single.columns == COLUMNS
    items = list(want.items())
    want = {i: t for (i, t), (n, comp) in zip(items, brute.components(items)) if n == 0 or comp == i}
    assert {r.doc_id: r.text for r in single.collect()} == want

    clean = cp.drop_contaminated(spark, single, folder)
    assert clean.columns == COLUMNS
    items = list(want.items())
    bad = {i for (i, _), (n, hit, _) in zip(items, brute.contamination([t for _, t in items], bench)) if hit and 20 * hit >= n}
    assert bad and {r.doc_id for r in clean.collect()} == set(want) - bad

    coded = cp.encode(spark, clean, folder).collect()
    assert {r.doc_id: r.text for r in coded} == {i: t for i, t in want.items() if i not in bad}
    assert all(r.lossless and r.n_tokens == len(r.ids) for r in coded)
    whole = cp.run(spark, folder).select("doc_id", "n_tokens", "lossless").collect()
    assert sorted((r.doc_id, r.n_tokens) for r in whole) == sorted((r.doc_id, r.n_tokens) for r in coded)


def test_stages_on_an_empty_table_and_repeated_rows(spark, corpus):
    folder, _, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for rows, n in ((docs.limit(0), 0), (docs.where("doc_id in (1, 40001)").union(docs.where("doc_id in (1, 40001)")), None)):
        for _, stage in cp.STAGES:
            rows = stage(spark, rows, folder)
        assert rows.count() == 0 if n == 0 else rows.count() <= 1


def test_stages_keep_columns_that_clash_with_their_own(spark, corpus):
    folder, _, _ = corpus
    docs = (spark.read.parquet(f"{folder}/documents.parquet").drop("n_chars").where("doc_id < 60 or doc_id >= 20000")
            .withColumns({"score": F.lit(777.0), "n_words": F.lit(-5), "lang_pred": F.lit("x"), "_lines": F.lit(1), "row": F.lit("r"), "a.b": F.lit(2),
                          "lines": F.lit("l"), "stay": F.lit(3), "th": F.lit("t")}))
    rows = docs
    for _, stage in cp.STAGES[:4]:
        rows = stage(spark, rows, folder)
        assert rows.columns == docs.columns
    got = rows.collect()
    assert got and {(r["score"], r["n_words"], r["lang_pred"], r["_lines"], r["row"], r["a.b"], r["lines"], r["stay"], r["th"]) for r in got} == {
        (777.0, -5, "x", 1, "r", 2, "l", 3, "t")}


def test_every_operator_is_registered():
    names = list(E.queries())
    assert [n for n in range(1, 14) if sum(x.startswith(f"op{n}_") for x in names) != 1] == []
    assert E.queries()["pipeline"] is cp.run and "pipeline" not in E.oracle_sql()
    assert [name for name, _ in cp.STAGES] == ["language", "line_dedup", "near_duplicates", "decontamination", "encoding"]


def test_queries_return_one_row_per_document(spark):
    n = spark.read.parquet(f"{SF_CHECK}/documents.parquet").count()
    for name in ("op2_crf_language", "op3_repetition", "op9_pii"):
        df = E.queries()[name](spark, SF_CHECK)
        assert df.select("doc_id").distinct().count() == df.agg(F.count("*")).first()[0] == n
