"""Deduplication operators against brute force."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ridemart.llm import line_dedup, lz_dedup, ngram_join, suffix_dedup
from tests.llm import brute
from tests.llm.test_narrow import awkward, frame, words


def copies(rng):
    base = [words(rng, 60, 500) for _ in range(6)]
    out = list(base) + base[:3] + [None, "", "é" * 60, "é" * 61 + "x", "ab" * 100, "ab" * 90 + "c"]
    for _ in range(20):
        a, b = rng.choice(base).split(), rng.choice(base).split()
        i, j = rng.randrange(20), rng.randrange(25, 55)
        out.append(" ".join([words(rng, rng.randrange(5), 9)] + a[i:j] + [words(rng, 3, 500)] + b[j - 10:]))
    passage = words(rng, 15, 500)
    out += [words(rng, 8, 900) + " " + passage + " " + words(rng, 8, 900) for _ in range(25)]
    return out


@pytest.mark.parametrize("hot", [1, 5_000])
@pytest.mark.parametrize("size", [16, 41])
def test_byte_dedup_matches_brute_force(spark, size, hot):
    rng = random.Random(size)
    texts = copies(rng) + [words(rng, 200, 3)]
    rng.shuffle(texts)
    got = {r.doc_id: r for r in suffix_dedup.digest(
        suffix_dedup.remove_repeats(frame(spark, texts).repartition(5), threshold=size, hot_runs=hot)).collect()}
    for i, want in enumerate(brute.repeated_bytes(texts, size)):
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want, i


@pytest.mark.parametrize("size", [16, 41, 70])
def test_prefix_doubling_matches_brute_force(spark, size):
    rng = random.Random(size)
    texts = copies(rng) + [words(rng, 200, 3)]
    got = {r.doc_id: r for r in suffix_dedup.digest(
        suffix_dedup.remove_repeats(frame(spark, texts).repartition(5), threshold=size, doubling=True)).collect()}
    for i, want in enumerate(brute.repeated_bytes(texts, size)):
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want, i


@pytest.mark.parametrize("doubling", [False, True])
def test_byte_dedup_repeated_rows_and_ids(spark, doubling):
    texts = ["x%d" % i * 30 for i in range(3)] * 2 + [None, "q" * 50]
    ids = [1, 1, None, 1, 2, None, None, 5]
    got = suffix_dedup.digest(suffix_dedup.remove_repeats(frame(spark, texts, ids), threshold=20, doubling=doubling)).collect()
    want = brute.repeated_bytes(texts, 20)
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(want)
    assert suffix_dedup.remove_repeats(frame(spark, texts).limit(0)).count() == 0


@pytest.mark.parametrize("chunk", [600, 1 << 20])
def test_earlier_blocks_match_brute_force(spark, chunk):
    rng = random.Random(chunk)
    texts = copies(rng) + awkward() + [words(rng, 200, 3)] * 2
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    ids[3] = ids[40] = None
    ids[5] = ids[6] = ids[7] = ids[20]
    got = lz_dedup.digest(lz_dedup.remove_earlier(frame(spark, texts, ids).repartition(4), chunk_bytes=chunk, bucket_bytes=chunk)).collect()
    want = brute.earlier_windows(list(zip(ids, texts)))
    assert (sorted(((r.doc_id is None, r.doc_id or 0), r.n_words, r.n_removed, r.kept_sha256) for r in got)
            == sorted(((i is None, i or 0), *w) for i, w in zip(ids, want)))


def test_earlier_blocks_with_one_id_on_a_third_of_the_rows(spark):
    rng = random.Random(3)
    texts = copies(rng)
    ids = [7 if i % 3 == 0 else i for i in range(len(texts))]
    got = lz_dedup.remove_earlier(frame(spark, texts, ids), chunk_bytes=500, bucket_bytes=2_000)
    want = brute.earlier_windows(list(zip(ids, texts)))
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in lz_dedup.digest(got).collect()) == sorted(
        (i, *w) for i, w in zip(ids, want))
    factors = [(r.n_words, f) for r in got.collect() for f in r.factors]
    assert factors and all(f.length >= 13 and f.start + f.length <= n for n, f in factors)
    assert lz_dedup.remove_earlier(frame(spark, texts).limit(0)).count() == 0


@pytest.mark.parametrize("chunk", [700, 1 << 20])
def test_factors_are_greedy_copies_of_their_references(spark, chunk):
    rng = random.Random(chunk)
    texts = copies(rng) + [" ".join(words(rng, 40, 900) for _ in range(3))] + [words(rng, 300, 2)] * 2
    texts += [" ".join(a.split()[:20] + b.split()[10:40] + a.split()[15:]) for a, b in zip(texts[:5], texts[1:6])]
    ids = [5 * i - 40 for i in range(len(texts))]
    rng.shuffle(ids)
    got = lz_dedup.remove_earlier(frame(spark, texts, ids), chunk_bytes=chunk, bucket_bytes=3_000).collect()
    want = brute.greedy_factors(list(zip(ids, texts)))
    assert {r.doc_id: [tuple(f) for f in r.factors] for r in got} == want
    word = {i: brute.BLANK.findall(t or "") for i, t in zip(ids, texts)}
    over = 0
    for r in got:
        inside = set()
        for f in r.factors:
            assert f.ref_doc < r.doc_id
            assert word[r.doc_id][f.start:f.start + f.length] == word[f.ref_doc][f.ref_start:f.ref_start + f.length]
            assert not inside & set(range(f.start, f.start + f.length))
            inside |= set(range(f.start, f.start + f.length))
        spans = {p for x in r.spans for p in range(x.start, x.start + x.length)}
        assert inside <= spans and len(spans) == r.n_removed
        over += len(spans - inside)
    assert over                                          # some words only the check at boundaries finds


def test_chunks_are_cut_by_bytes(spark):
    rng = random.Random(8)
    texts = [words(rng, 20, 500) for _ in range(500)] + [words(rng, 4_000, 500) for _ in range(40)]
    size = sum(map(len, texts))
    rows = frame(spark, texts).selectExpr("doc_id AS id", "xxhash64(text) AS th", "text")
    per = [r.n for r in lz_dedup.chunked(rows, 10, size // 10).groupBy("chunk").agg(F.sum(F.octet_length("text")).alias("n")).collect()]
    assert len(per) >= 8 and max(per) < size / 10 + 2 * max(map(len, texts))


def test_earlier_blocks_in_long_texts(spark):
    rng = random.Random(9)
    long = words(rng, 60_000, 2_000).split()
    texts = [" ".join(long), " ".join(long[:30_000] + ["x"] + long[30_000:]), words(rng, 50, 2_000), None, ""]
    got = sorted(tuple(r)[:4] for r in lz_dedup.digest(lz_dedup.remove_earlier(frame(spark, texts), chunk_bytes=100_000)).collect())
    want = brute.earlier_windows(list(enumerate(texts)))
    assert min(len(texts[0]), len(texts[1])) > 100_000 and got == [(i, *w) for i, w in enumerate(want)]


def line_texts(rng):
    lines = [words(rng, rng.randrange(1, 45), 3_000) for _ in range(60)]
    out = []
    for _ in range(40):
        doc = []
        for _ in range(rng.randrange(1, 9)):
            x = rng.choice(lines).split()
            for _ in range(rng.randrange(4) * rng.randrange(2)):
                x[rng.randrange(len(x))] = words(rng, 1, 3_000)
            if rng.random() < .3:
                rng.shuffle(x)
            doc.append("  ".join(x) if rng.random() < .2 else " ".join(x))
        out.append("\n".join(doc))
    variant = words(rng, 30, 3_000)
    out += ["\n".join([variant + f" v{i}", "a b c", "b c a", "the same line here"]) for i in range(40)]
    return out + [None, "", "\n\n \n", "x\r\nx\r\ny", "q" * 9_000]


def test_line_dedup_matches_brute_force(spark):
    rng = random.Random(12)
    texts = line_texts(rng) + awkward()
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    ids[4] = None
    df = frame(spark, texts, ids).withColumnRenamed("row", "_lines2")
    got = {r.doc_id: r for r in line_dedup.dedup_lines(df).collect()}
    want = brute.earlier_lines(list(zip(ids, texts)))
    for i, t, w in zip(ids, texts, want):
        assert got[i].text == w, (i, t)
        assert got[i].kept == "x" and got[i].h == "z"
        assert (got[i]._lines.n_removed == 0) == (w == t)


def family_texts(rng):
    """Template lines with one varying word, lines around a word they share, and others."""
    template = words(rng, 10, 3_000).split()
    lines = [" ".join(template[:-1] + [f"v{i}"]) for i in range(150)]
    lines += [f"common {words(rng, rng.randrange(1, 4), 3_000)}" for _ in range(150)]
    lines += [" ".join(x.split()[::-1]) for x in lines[::7]] + [words(rng, 12, 3_000) for _ in range(50)]
    rng.shuffle(lines)
    return ["\n".join(lines[i:i + 5]) for i in range(0, len(lines), 5)]


@pytest.mark.parametrize("hot, long", [(20, 4_096), (50_000, 70), (100, 100)])
def test_line_dedup_with_long_and_hot_lists(spark, monkeypatch, hot, long):
    monkeypatch.setattr(line_dedup, "HOT_LIST", hot)
    monkeypatch.setattr(line_dedup, "LONG_LIST", long)
    monkeypatch.setattr(line_dedup, "BUCKET_BYTES", 4_000)
    texts = family_texts(random.Random(31))
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(frame(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == brute.earlier_lines(list(enumerate(texts)))


def test_line_dedup_unpacked_runs_dataframe_operations_only(spark, monkeypatch):
    rng = random.Random(40)
    texts = line_texts(rng) + family_texts(rng) + awkward()
    df = frame(spark, texts)
    packed = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}

    def python(*a, **b):
        raise AssertionError("Python on the executors")
    for name in ("mapInArrow", "mapInPandas"):
        monkeypatch.setattr(type(df), name, python)
    for name in ("applyInArrow", "applyInPandas"):
        monkeypatch.setattr(type(df.groupBy("doc_id")), name, python)
    monkeypatch.setattr(line_dedup, "FIRST", 3)          # most lists are longer
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df, packed=False).collect()}
    assert [got[i] for i in range(len(texts))] == brute.earlier_lines(list(enumerate(texts)))
    assert got == packed
    assert line_dedup.dedup_lines(df.limit(0), packed=False).count() == 0


def test_line_lists_give_pairs_of_their_first_members_only(spark):
    template = words(random.Random(41), 10, 3_000)
    texts = ["\n".join(f"{template} v{i + j}" for j in range(10)) for i in range(0, 400, 10)]
    rows = frame(spark, texts).selectExpr("doc_id AS id", "xxhash64(text) AS th", "text")
    met = line_dedup._ranked(line_dedup.prefixes(rows, 80)).cache()
    assert met.agg(F.max("size")).first()[0] == 400
    assert line_dedup._pairs(met, 80).count() <= 400 * line_dedup.FIRST * met.select("k").distinct().count()
    met.unpersist()


def postings(m, hot):
    """A list of m similar lines of ten words, as the packed row of a bucket."""
    one = {"k": np.full(m, 5, np.uint64), "h": np.arange(m, dtype=np.uint64), "parity": np.zeros(m, np.uint64),
           "n": np.full(m, 10, np.uint32), "place": np.zeros(m, np.uint32)}
    return pa.table({"bucket": [0], "hot": [hot], **{c: pa.array([x.tobytes()], pa.binary()) for c, x in one.items()}})


@pytest.mark.parametrize("m, hot", [(3_000, False), (20_000, False), (20_000, True)])
def test_line_list_of_a_large_family_holds_no_pairs(m, hot):
    tracemalloc.start()
    met = line_dedup._meet(80)(postings(m, hot))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert met.num_rows == m and met.column("k").null_count == 0
    assert peak < 2_000 * m                              # m * m / 2 pairs of 16 bytes would be 8,000 m and more


@pytest.mark.parametrize("hot", [False, True])
def test_hot_line_list_is_dealt_over_buckets(hot):
    class Shared:                                        # every word has class 9
        value = np.full(1 << line_dedup.SKETCH_BITS, 9, np.uint8)
    text = pa.array(["\n".join("same" + " " * (i + 1) for i in range(500))])      # 500 different lines, one word
    run = line_dedup._postings(Shared, 9 if hot else 10, 4, 80)
    rows = pa.Table.from_batches(run(iter([pa.RecordBatch.from_arrays([text], names=["text"])])))
    sizes = [len(x) // 8 for x in rows.column("k").to_pylist()]
    assert sum(sizes) == 500 and rows.column("hot").to_pylist() == [hot] * len(sizes)
    assert max(sizes) < 100 if hot else sizes == [500]


def test_line_dedup_repeated_rows(spark):
    rows = [(1, "one line here\nother line"), (1, "one line here\nother line"), (1, "one line here"), (2, "other line\nnew"), (2, None), (None, "new")]
    df = frame(spark, [t for _, t in rows], [i for i, _ in rows])
    got = sorted(((r.doc_id is None, r.doc_id or 0), "-" if r.text is None else r.text) for r in line_dedup.dedup_lines(df).collect())
    one = {t for (null, i), t in got if not null and i == 1}
    assert ((True, 0), "new") in got and ((False, 2), "-") in got and ((False, 2), "") in got
    assert len(got) == 6 and one in ({"one line here\nother line", ""}, {"other line", "one line here"})
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def near_copies(rng):
    base = [words(rng, rng.randrange(1, 90), 5_000).split() for _ in range(25)]
    rows = []
    for _ in range(90):
        x = list(rng.choice(base))
        for _ in range(rng.randrange(5)):
            x[rng.randrange(len(x))] = words(rng, 1, 5_000)
        rows.append(" ".join(x[rng.randrange(3):]))
    family = words(rng, 80, 5_000).split()
    for i in range(60):                                  # more than a short list holds
        x = list(family)
        x[i % 80] = f"v{i}"
        rows.append(" ".join(x))
    for i in range(12):                                  # a chain whose ends do not link
        family = family[4:] + words(rng, 4, 5_000).split()
        rows.append(" ".join(family))
    return rows + [None, "", "  ", "one", "One", "a b c d", "A b  c\nd", "same words " * 30, "same words " * 20]


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(21)
    texts = near_copies(rng) + awkward()
    ids = [3 * i for i in range(len(texts))]
    rng.shuffle(ids)
    ids[0] = None
    ids[7] = ids[8] = ids[9]
    got = ngram_join.digest(ngram_join.near_duplicates(frame(spark, texts, ids))).collect()
    want = brute.components(list(zip(ids, texts)))
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(((i, *w) for i, w in zip(ids, want)), key=key)


def test_near_duplicates_with_hot_lists(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HOT_LIST", 20)
    rng = random.Random(22)
    texts = near_copies(rng)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.digest(ngram_join.near_duplicates(frame(spark, texts))).collect()}
    assert [got[i] for i in range(len(texts))] == brute.components(list(enumerate(texts)))
    assert ngram_join.near_duplicates(frame(spark, texts).limit(0)).count() == 0
