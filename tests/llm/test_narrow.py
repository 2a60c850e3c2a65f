"""Operators judged text by text: repetition rules, personal data, decontamination."""

import random
import re
import time

from pyspark.sql import types as T

from ridemart.llm import decontaminate, pii, repetition
from tests.llm import brute

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("kept", T.StringType()), T.StructField("row", T.StringType()),
                     T.StructField("h", T.StringType())])


def frame(spark, texts, ids=None):
    ids = ids or list(range(len(texts)))
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in zip(ids, texts)], DOCS)


def words(rng, n, vocab=6):
    return " ".join("w%d" % rng.randrange(vocab) for _ in range(n))


def awkward():
    rng = random.Random(5)
    texts = [None, "", " \n\t ", "one", "é" * 30, "\n".join(["same line here"] * 9), words(rng, 400, 2), words(rng, 700, 50),
             "a b c d e f g h " * 40, words(rng, 5000, 400), "x" * 50_000]
    body = words(rng, 120, 1000)
    texts += [body + " " + words(rng, 30, 1000) + " " + body, body.replace(" ", "\n"), "tail\x0b\x0cword\r\nnext nbsp  x"]
    return texts


def test_repetition_matches_brute_force(spark):
    texts = awkward()
    rows = {r["doc_id"]: r for r in repetition.verdict(repetition.repetition(frame(spark, texts))).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        r = rows[i]
        want = brute.repetition(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.longest_repeat) == want, i
        assert r.n_covered == r.n_repeat_words
        base = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
        assert r.base_failed == base and not (r.kept and base)


def test_each_limit_rejects_a_text_of_its_own(spark):
    rng = random.Random(6)
    fresh = iter("u%d" % i for i in range(100_000))
    own = lambda n: [next(fresh) for _ in range(n)]
    repeat = own(60)
    covered = repeat + own(180) + repeat + own(150)             # 120 of 450 words (27 percent) in a repeat of 60
    passage = own(130)
    longest = passage + own(3000) + passage                     # 8 percent, but 130 words at a stretch
    fine = own(50) + (few := own(40)) + own(400) + few + own(50)
    base = [rng.choice("ab") for _ in range(300)]
    rows = {r.doc_id: r for r in repetition.verdict(repetition.repetition(frame(spark, [" ".join(x) for x in (covered, longest, fine, base)]))).collect()}
    assert [(rows[i].base_failed, rows[i].kept) for i in range(4)] == [(False, False), (False, False), (False, True), (True, False)]
    assert rows[0].longest_repeat == 60 and rows[0].n_covered == 120 and rows[1].longest_repeat == 130 and rows[1].n_covered == 260


def test_verdict_matches_brute_force(spark):
    rng = random.Random(12)
    texts = awkward() + [" ".join(("w%d" % rng.randrange(3000) for _ in range(400))) + " " + " ".join(["a b c d e f g h i j k l"] * rng.randrange(0, 14)) for _ in range(60)]
    rows = {r.doc_id: r for r in repetition.verdict(repetition.repetition(frame(spark, texts))).collect()}
    verdicts = []
    for i, t in enumerate(texts):
        n, _, _, _, again, longest = brute.repetition(t)
        base = n < 20 or 100 * again > 30 * n
        want = not base and again <= 0.24 * n and longest <= 100
        assert rows[i].kept == want, i
        verdicts.append((base, want))
    assert len(set(verdicts)) == 3


def test_repetition_repeated_rows_and_empty_table(spark):
    df = frame(spark, ["a b", "a b", None], [1, 1, None])
    assert repetition.repetition(df).count() == 3
    assert repetition.verdict(repetition.repetition(df.limit(0))).count() == 0


def test_personal_data_matches_brute_force(spark):
    texts = [None, "", "mail a@b.c x@y a.b+c%d@e-f.gh.ij. and a@b.c%x@d.e end", "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 001.02.3.255",
             "card 4111 1111 1111 1111 or 4111-1111-1111-1112, 4111111111111111", "+49 (30) 1234-5678 +1 2 +123456789012345678",
             "é日本 +49 30 12345678 é a@b.co 10.0.0.1", "@" * 3000, "a" * 30_000 + "@", "1" * 30_000, "1 " * 5000, "a.b" * 5000 + "@c" + ".d" * 5000,
             "+" + "(" * 20_000, "1." * 10_000]
    rows = {r["doc_id"]: r for r in pii.digest(pii.find_personal_data(frame(spark, texts))).collect()}
    for i, t in enumerate(texts):
        counts, digest = brute.pii_base(t)
        r = rows[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts, (i, r)
        assert r.base_sha256 == digest, i


def test_personal_data_added_kinds_and_scores(spark):
    texts = ["IBAN DE89 3704 0044 0532 0130 00 paid", "DE89 3704 0044 0532 0130 01", "my ssn is 123-45-6789", "part 123-45-6789",
             "reach a@b.co", "please contact a@b.co"]
    rows = {r["doc_id"]: r for r in pii.find_personal_data(frame(spark, texts)).collect()}
    kinds = [[s.kind for s in rows[i].found] for i in range(len(texts))]
    assert kinds == [["iban"], [], ["ssn"], [], ["email"], ["email"]]
    assert rows[4].found[0].score < rows[5].found[0].score
    assert (rows[0].found[0].b, rows[0].found[0].e) == (5, 32)


def test_context_windows_match_brute_force(spark):
    """Scores of every span against the plain window of 40 characters on each side, wherever matches crowd."""
    rng = random.Random(8)
    bits = ["a@b.co", "mail", "10.0.0.1", "host", "é", " ", "  ", "card", "4111 1111 1111 1111", "+49 30 1234567", "call", "x" * 35, "123-45-6789", "ssn", "日本語 text "]
    texts = ["a@b.co" + " " * gap + "mail" for gap in range(30, 90)] + ["mail" + " " * gap + "a@b.co" for gap in range(30, 50)]
    texts += [rng.choice(["", " "]).join(rng.choice(bits) for _ in range(rng.randrange(1, 400))) for _ in range(150)]
    rows = pii.find_personal_data(frame(spark, texts)).collect()
    kinds = {k.name: k for k in pii.KINDS}
    seen = 0
    for r in rows:
        t = texts[r.doc_id]
        for s in r.found:
            at = max(s.b - 40, 0)
            near = re.search(kinds[s.kind].context, t[at:at + s.e - s.b + 80].lower())
            assert abs(s.score - min(1.0, kinds[s.kind].score + (0.25 if near else 0))) < 1e-9, (r.doc_id, s)
            seen += 1
    assert seen > 2000


def test_many_matches_cost_linear_time(spark):
    took = {}
    for n in (10_000, 40_000):
        df = frame(spark, ["ab@cd.ef " * n])
        pii.find_personal_data(frame(spark, ["ab@cd.ef " * 500])).collect()
        t = time.time()
        row = pii.find_personal_data(df).selectExpr("size(found) as n", "found[size(found) - 1].e as e").first()
        took[n] = time.time() - t
        assert (row.n, row.e) == (n, 9 * n - 1)
    assert took[40_000] <= 5 * took[10_000] + 1


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_decontamination_matches_brute_force(spark):
    rng = random.Random(9)
    items = [(i, words(rng, rng.randrange(1, 40), 30)) for i in range(25)] + [(99, None), (98, ""), (97, "Éa B-c"), (25, words(rng, 60, 30)), (None, "only listed without id here")]
    items += [(60, items[3][1]), (3, items[3][1])]
    texts = awkward() + [words(rng, 30, 300) + " " + items[k][1] + " " + words(rng, 50, 300) for k in range(0, 25, 2)]
    texts += ["Éa, b c", "x " + items[24][1][:20], items[4][1].upper(), "only listed without id here", words(rng, 300, 30)]
    got = decontaminate.contamination(frame(spark, texts), bench(spark, items)).collect()
    rows = {r["doc_id"]: r for r in got}
    for i, want in enumerate(brute.contamination(texts, items)):
        r = rows[i]
        assert (r.n_words, r.n_hit, r["items"]) == want, i


def test_decontamination_empty_sides_and_repeats(spark):
    df = frame(spark, ["a b c", "a b c", None], [7, 7, None])
    none = decontaminate.digest(decontaminate.contamination(df, bench(spark, [(1, "q")]).limit(0))).collect()
    assert len(none) == 3 and not any(r.contaminated for r in none)
    hit = decontaminate.digest(decontaminate.contamination(df, bench(spark, [(1, "b")]))).collect()
    assert sorted(r.n_hit for r in hit) == [0, 1, 1]
    assert decontaminate.contamination(df.limit(0), bench(spark, [(1, "b")])).count() == 0
