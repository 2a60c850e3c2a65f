"""Tokenizer alignment against token-by-token brute force and the plain tokenizer library."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ridemart.llm import align

COLS = "doc_id long, text string, chunk long, groups string, `a.b` string, n long"


def frame(spark, texts, ids=None):
    return spark.createDataFrame([(i, t, 7, "g", "x", 1) for i, t in zip(ids or range(len(texts)), texts)], COLS)


def tokens(text):
    a, b = align.loaded(align.ByteBpe, align.BYTE_BPE), align.loaded(align.PieceBpe, align.PIECE_BPE)
    if not text:
        return [], []
    slow = Tokenizer.from_file(align.BYTE_BPE)
    slow.encode_special_tokens = True
    ia, ib = slow.encode(" " + text, add_special_tokens=False).ids, b.model.encode(text)
    parts = []
    for ids, pool in ((ia, a.pool), (ib, b.pool)):
        items = [pool.data[pool.start[i]:pool.start[i] + pool.size[i]].tobytes() for i in ids]
        if b"".join(items) != (" " + text).encode():
            return [], []
        parts.append(list(zip(ids, items)))
    return parts


def brute(texts):
    rows, count = [], Counter()
    for text in texts:
        a, b = tokens(text)
        spans = []
        for side in (a, b):
            end, got = 0, []
            for i, raw in side:
                got.append((i, end, end + len(raw)))
                end += len(raw)
            spans.append(got)
        links = [(i, j) for i, s, e in spans[0] for j, p, q in spans[1] if s < q and p < e]
        ends = sorted({x[2] for x in spans[0]} & {x[2] for x in spans[1]})
        groups, last = [], 0
        for e in ends:
            groups.append("|".join(",".join(str(i) for i, _, z in side if last < z <= e) for side in spans))
            last = e
        count.update(links)
        rows.append((len(a), len(b), ";".join(groups), len(ends), links))
    best = defaultdict(int)
    for (_, j), c in count.items():
        best[j] = max(best[j], c)
    return [(na, nb, g, len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
             hashlib.sha256(text.encode()).hexdigest() if na else "") for na, nb, text, g, links in rows]


TEXTS = [None, "", " ", "a", "The quick brown fox", "Ünïcode tëxt mit Wörtern wie Straße", "日本語のテキスト と spaces", "tabs\tand\nnew\n\nlines  double",
         "<|endoftext|> and </s> <s> <unk> <0x41>", "under▁score", "x" * 3000, "é" * 700, " " * 50, "12,345.67 don't we're", "emoji 👩‍👩‍👧 ok", "nbsp x y",
         "\x00\x01 control \x7f", "\r\n crlf \r\n", "The quick brown fox"]


def test_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    words = "the of and tion Straße été naïve foo_bar baz, qux. 日本 3.14 x1y2".split()
    texts = TEXTS + [" ".join(rng.choice(words, rng.integers(1, 60))) for _ in range(60)]
    rows = {r.doc_id: r for r in align.digest(align.align(frame(spark, texts).repartition(4), chunk_bytes=500)).collect()}
    for i, want in enumerate(brute(texts)):
        r = rows[i]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) == want, (i, texts[i])


def test_texts_are_encoded_once(spark):
    out = align.align(frame(spark, TEXTS))
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("ReusedExchange") >= 2 and final.count("MapInArrow") == 1


def test_repeated_rows_null_ids_and_empty_table(spark):
    got = align.align(frame(spark, ["ab cd", "ab cd", None], [None, None, 4])).collect()
    assert sorted((r.doc_id is None, r.n_links, r.count_sum) for r in got)[1:] == [(True, got[0].n_links or got[1].n_links, 2 * got[0].n_links or 2 * got[1].n_links)] * 2
    assert align.align(frame(spark, TEXTS).limit(0)).count() == 0


def test_fast_path_gives_the_ids_of_the_plain_library():
    a = align.ByteBpe(align.BYTE_BPE)
    slow = Tokenizer.from_file(align.BYTE_BPE)
    slow.encode_special_tokens = True
    assert a.fast is not None
    step = 64
    # every character in two neighbourhoods, and the awkward texts
    chars = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000][::37] + list(range(0x3000))
    texts = [x for x in TEXTS if x] + ["".join(f" a{chr(c)}1 {chr(c)}{chr(c)}b" for c in chars[i:i + step]) for i in range(0, len(chars), step)]
    assert a.encode(texts) == [slow.encode(x, add_special_tokens=False).ids for x in texts]


def test_very_long_runs():
    a = align.ByteBpe(align.BYTE_BPE)
    for x in (" " * 300_000, "a" * 300_000, "\n" * 300_000 + "x", "!" * 100_000, "1" * 100_000):
        ids = np.array(a.encode([x])[0])
        assert a.pool.joined(ids)[0].tobytes() == x.encode()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(1, 40), min_size=1, max_size=30), min_size=1, max_size=6), st.randoms())
def test_galloping_finds_what_binary_search_finds(cuts, rnd):
    hay = np.cumsum(np.concatenate(cuts))
    x = np.sort(np.array([rnd.randint(1, int(hay[-1])) for _ in range(rnd.randint(1, 40))]))
    guess = np.array([rnd.randrange(len(hay)) for _ in x])
    assert (align.gallop(x, hay, guess) == np.searchsorted(hay, x)).all()
