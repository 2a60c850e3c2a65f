"""Token operators: merge-dropout round trips, training-order shards."""

import numpy as np
import pyarrow as pa
import sentencepiece

from ridemart.llm import merge_dropout as md
from ridemart.llm import shards
from ridemart.llm import tokens as tk
from tests.llm.test_narrow import awkward, frame

ODD = [None, "", " ", "  two  spaces ", "a\nb\tc\n\n x", "é日本𝄞 x", "▁ literal ▁▁mark", "fi ﬁ ½", "\n", "x" * 20_000, "<s></s><unk><0x41>",
       "Same words here", "Same words here"]


def test_plain_encoding_equals_the_library(spark):
    texts = ODD[:6] + ODD[7:] + awkward()
    sp = sentencepiece.SentencePieceProcessor(model_file=md.MODEL)
    rows = {r.doc_id: r for r in md.encode(frame(spark, texts), dropout=0).collect()}
    for i, t in enumerate(texts):
        assert rows[i].ids == (None if t is None else sp.encode(t)), (i, t)


def test_dropout_is_seeded_varied_and_lossless(spark):
    texts = ODD + awkward() + ["the quick brown fox jumps over the lazy dog and the river bank " * 20] * 12
    df = frame(spark, texts)
    a, again, other, plain = (md.encode(df, dropout=p, seed=s) for p, s in ((0.3, 1), (0.3, 1), (0.3, 2), (0, 1)))
    ids = [{r.doc_id: r.ids for r in x.collect()} for x in (a, again, other, plain)]
    assert ids[0] == ids[1] and ids[0] != ids[2] and ids[0] != ids[3]
    assert len({tuple(ids[0][i]) for i in range(len(texts) - 12, len(texts))}) > 1
    rows = {r.doc_id: r for r in md.decode(a).collect()}
    for i, t in enumerate(texts):
        assert rows[i].decoded == t and rows[i].text == t
    assert all(r.lossless for r in md.digest(md.decode(a)).collect())
    whole = md.round_trip(df, dropout=0.3, seed=1)
    assert {r.doc_id: r.ids for r in whole.collect()} == ids[0] and all(r.lossless for r in md.digest(whole).collect())
    assert md.digest(md.decode(md.encode(df.limit(0)))).count() == 0


def test_every_occurrence_of_a_word_has_its_own_coins(spark):
    word, times = "internationalisation", 300
    texts = [" ".join([word] * times)] * 40
    rows = {r.doc_id: r.ids for r in md.encode(frame(spark, texts)).collect()}
    assert len({tuple(x) for x in rows.values()}) == len(texts)         # exact copies, no two alike
    v = md.vocabulary(md.MODEL)
    starts = {i for i, (a, b) in enumerate(zip(v.pool_off, v.pool_off[1:])) if b > a and v.pool[a] == 0x20}

    def words(ids):
        cuts = [i for i, x in enumerate(ids) if x in starts] + [len(ids)]
        return [tuple(ids[a:b]) for a, b in zip(cuts, cuts[1:])]
    assert all(len(words(x)) == times for x in rows.values())
    assert all(len(set(words(x))) > 4 for x in rows.values())           # one text varies by itself
    assert len({w for x in rows.values() for w in words(x)}) > 40


def test_texts_that_share_an_id_have_their_own_coins(spark):
    words = "internationalisation notwithstanding " * 60
    df = spark.createDataFrame([(None, words + x) for x in "ab"] + [(7, words + x) for x in "ab"] + [(7, words + "a")], "doc_id long, text string")
    rows = [(r.doc_id, r.text, tuple(r.ids)) for r in md.encode(df).collect()]
    assert len(set(rows)) == 4 and len({x[2][:100] for x in rows}) == 4  # the repeated row has equal ids


def test_units_together_and_alone_agree():
    v = md.vocabulary(md.MODEL)
    texts = [t for t in ODD + awkward() if t]
    for t in (0, 1 << 29, 1 << 31):
        u = tk.Units(tk.Texts(pa.array(texts)), np.arange(len(texts)).astype(np.uint64) % np.uint64(3))
        values, size = md.segment_units(u, v, t, np.arange(len(u.key)))
        off = np.concatenate([[0], np.cumsum(size)])
        for i, k in enumerate(u.key.tolist()):
            assert values[off[i]:off[i + 1]].tolist() == md.segment(u.content(i), v, k, t)


def test_feistel_is_a_keyed_bijection():
    for n in (1, 2, 3, 100, 4097):
        p = shards.feistel(np.arange(n), n, 7)
        assert sorted(p) == list(range(n))
    assert list(shards.feistel(np.arange(500), 500, 7)) != list(shards.feistel(np.arange(500), 500, 8))


def test_shards_hold_every_token_at_its_slot(spark, scratch):
    texts = awkward() + ODD + ["word%d " % i * 50 for i in range(60)] + ["twice"] * 5
    folder = "file://" + scratch("shards").removeprefix("file://")
    size, per = 64, 16
    texts = [t for t in texts if "▁" not in (t or "")]      # the library writes these otherwise
    man = shards.materialise_order(frame(spark, texts), folder, seq_len=size, seqs_per_shard=per, key=3).collect()
    n = len(man)
    assert sorted(r.slot for r in man) == sorted(r.seq for r in man) == list(range(n))
    got = shards.read_slots(folder + "/shards", 0, n, size, per)
    by_seq = got[np.array([r.slot for r in sorted(man, key=lambda r: r.seq)])].reshape(-1)
    sp = sentencepiece.SentencePieceProcessor(model_file=md.MODEL)
    rows = sorted(spark.read.parquet(folder + "/tokens").collect(), key=lambda r: (r.part, r.start))
    want = [x for r in rows for x in sp.encode(texts[r.doc_id] or "") + [shards.END_TOKEN]]
    assert len(rows) == len(texts)
    assert list(by_seq[:len(want)]) == want and set(by_seq[len(want):]) <= {shards.END_TOKEN} and len(by_seq) - len(want) < size
    assert (shards.read_slots(folder + "/shards", n // 2, 3, size, per) == got[n // 2:n // 2 + 3]).all()


def test_shards_of_an_empty_table(spark, scratch):
    assert shards.materialise_order(frame(spark, ["x"]).limit(0), scratch("shards-empty")).count() == 0
