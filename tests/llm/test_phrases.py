"""Phrase mining against plain counting of all n-grams."""

import random
import re
from collections import Counter, defaultdict

import pytest

from ridemart.llm import phrases

COLS = "doc_id long, text string, lang string, n long, `a.b` string, kind string, w1 long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, 3, "x", "edge", 5) for i, (t, g) in enumerate(rows)], COLS)


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def pieces(rows):
    for t, lang in rows:
        for s in re.split("[.,;:!?\n\x0b\x0c\r]", lower(t or "")):
            yield (lang if lang is not None else "und"), re.findall("[^ \t]+", s)


def counted(rows):
    f = defaultdict(Counter)
    for lang, w in pieces(rows):
        for k in (1, 2, 3):
            f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    return f


def path_of(f, min_count):
    """Unary path (as words) of every frequent three-word edge."""
    edges = {g: n for g, n in f.items() if len(g) == 3 and n >= min_count}
    out, into = {}, {}
    for g, n in edges.items():
        if n == f[g[:2]]:
            out[g[:2]] = g
        if n == f[g[1:]]:
            into[g[1:]] = g
    unary = set(out) & set(into)
    paths = {}
    for g in edges:
        first = g
        while first[:2] in unary:
            first = into[first[:2]]
        words, last = list(first), first
        while last[1:] in unary:
            last = out[last[1:]]
            words.append(last[2])
        paths[g] = words
    return paths


def brute(rows, min_count, top, percent=50):
    got = []
    for lang, f in counted(rows).items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        paths, best = path_of(f, min_count), []
        for g, a in f.items():
            if len(g) < 2 or a < min_count:
                continue
            cuts = [(a * a * 1000000 // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            if len(g) == 2 and any(100 * c >= percent * a for h, c in f.items() if len(h) == 3 and c >= min_count and g in (h[:2], h[1:])):
                continue
            best.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]], len(paths[g]) if len(g) == 3 else 2))
        got += [(lang, i + 1, p.decode(), -a, le, r, n, -s, w) for i, (s, a, p, le, r, w) in enumerate(sorted(best)[:top])]
    return sorted(got)


def corpus():
    rng = random.Random(4)
    vocab = ["w%d" % i for i in range(40)] + ["É", "日本", "a-b", "X1", "it's", " ", "\x00", "ﬁ"]
    rows = [(None, "en"), ("", None), (" \t ", "de"), ("...", "en"), ("One", "xx"), ("hot " * 3000, "en"), ("a b\x85c " * 30, "fr")]
    rows += [(" ".join(rng.choice(vocab[:1 + rng.randrange(len(vocab))]) + rng.choice(["", "", "", ",", ".", "\n", "\r\n"]) for _ in range(rng.randrange(1, 200))),
              rng.choice(["en", "en", "en", "de", None, "und", "o'x"])) for _ in range(150)]
    fixed = "this licence text is always the very same long line of words without any other beginning or end"
    rows += [(rng.choice(["", "Zu ", "q w "]) + fixed + rng.choice(["", " after", "; more"]), "en") for _ in range(30)]
    rows += [("x y z", "tie")] * 12 + [("p q r", "tie")] * 12
    return rows


@pytest.mark.parametrize("flush, bucket, top", [(1 << 20, 4 << 20, 2000), (300, 200, 37)])
def test_matches_brute_force(spark, flush, bucket, top):
    rows = corpus()
    got = phrases.collocations(frame(spark, rows).repartition(5), min_count=10, top=top, flush_words=flush, bucket_bytes=bucket)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score", "path_words"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 10, top)


def test_hot_words_and_nodes_are_dealt_without_loss(spark, monkeypatch):
    rows = corpus()
    monkeypatch.setattr(phrases, "heavy_keys", lambda texts, n, size: _all_keys(rows))
    got = phrases.collocations(frame(spark, rows).repartition(3), min_count=10, flush_words=500)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 10, 2000)


def _all_keys(rows):
    """Every second word and node counts as hot."""
    import numpy as np
    import pyarrow as pa
    texts = pa.RecordBatch.from_arrays([pa.array([g if g is not None else "und" for _, g in rows]), pa.array([t or "" for t, _ in rows])], names=["lang", "text"])
    keys = [set(), set()]
    for b in phrases._heavy([texts]):
        keys[b.column(0)[0].as_py()].update(np.asarray(b.column(1)).view(np.uint64)[::2].tolist())
    return [np.sort(np.array(list(k), np.uint64)) for k in keys]


def test_unary_paths(spark):
    rows = corpus()
    got = {(r.lang, r.phrase, r.n) for r in phrases.unary_paths(frame(spark, rows)).collect()}
    want = set()
    for lang, f in counted(rows).items():
        want |= {(lang, " ".join(w), f[tuple(w[:3])]) for w in path_of(f, 10).values() if len(w) > 3}
    assert got == want
    assert any(len(p.split()) > 12 for _, p, _ in got)


def test_empty_table(spark):
    assert phrases.collocations(frame(spark, [("a b", "en")]).limit(0)).count() == 0
