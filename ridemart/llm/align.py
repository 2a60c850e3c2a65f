"""Alignment of two tokenizers: groups between common token ends, overlap links and their corpus-wide counts.

Every text, with one space in front, is encoded by a byte-level BPE (A) and by
a SentencePiece BPE (B). The ends of the tokens in bytes are two increasing
lists; each token of the shorter list looks its end up in the longer one by
galloping (doubling steps from where it should lie, then halving), so the cost
follows the distances and not the length of the longer list. Ends found in
both cut the tokens into groups. The rank that a token's end takes in the
other list, and the rank of the token before it, bound the tokens it overlaps:
that range gives the links without comparing tokens.

Chunks of ``chunk_bytes`` of text are encoded once and travel as packed token
ids, in one exchange that all later steps read. A chunk reports each of its different (A id, B id) pairs once with a
count; Spark sums these, finds each B id's highest count, and joins both back
to the chunks that hold the pair. Rows shuffled are a chunk's distinct pairs,
never a document's links; a pair that occurs everywhere is a row a chunk, which
AQE's skew join splits.

Defined results: a text that is null or empty, or that either tokenizer does
not reproduce byte by byte, has no tokens (zeros and an empty ``groups``);
every row is aligned by itself, so repeated rows give equal rows and add to
the counts twice; a null doc_id is kept; an empty table gives an empty result.
Special tokens are not recognised in texts.
"""

from __future__ import annotations

import itertools
import json

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ridemart.llm import tokens as tk
from ridemart.llm.frames import slim

TOKENIZERS = "/opt/tokenizers"
BYTE_BPE = f"{TOKENIZERS}/byte_bpe_50k.json"
PIECE_BPE = f"{TOKENIZERS}/piece_bpe_32k.model"
CHUNK_BYTES = 2 << 20
#: The pattern of byte-level BPE's splitting into words (a fixed value of that format).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

PACKED = "chunk long, ids binary, na binary, nb binary, a binary, b binary"
PAIRS = "chunk long, a int, b int, n long"
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


class Pool:
    """The byte string of every id, end to end."""

    def __init__(self, items: list[bytes]):
        self.size = np.array([len(x) for x in items], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(items), np.uint8)

    def joined(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tk.gather(self.data, self.start, self.size, ids)


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level BPE writes for every byte: visible Latin-1 for itself, the rest from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """Tokenizer A: ids of texts and the bytes of every id.

    Where the file's ids follow its merge order and it splits by the usual
    pattern, its merges run in tiktoken (several times faster, same ids);
    any other file, and any text tiktoken refuses, runs in ``tokenizers``.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path, letters, vocab = path, byte_letters(), spec["model"]["vocab"]
        special = {x["content"] for x in spec.get("added_tokens", [])}
        items = [b""] * (max([*vocab.values(), *(x["id"] for x in spec.get("added_tokens", []))]) + 1)
        for token, i in vocab.items():
            items[i] = token.encode() if token in special else bytes(letters[c] for c in token)
        self.pool, self.fast, self.slow = Pool(items), None, None
        merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
        split = spec.get("pre_tokenizer") or {}
        usual = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space") and not spec.get("normalizer")
        if usual and [vocab.get(m) for m in merges] == list(range(256, 256 + len(merges))):
            ranks = {items[i]: i for token, i in vocab.items() if token not in special}
            self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list:
        if self.fast is not None:
            try:
                return [self.fast.encode_ordinary(x) for x in texts]
            except BaseException as e:  # a regular expression out of stack is a panic, which is no Exception
                if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                    raise
        if self.slow is None:
            self.slow = Tokenizer.from_file(self.path)
            self.slow.encode_special_tokens = True
        return [self.slow.encode(x, add_special_tokens=False).ids for x in texts]


class PieceBpe:
    """Tokenizer B: ids of texts (it puts the leading space itself) and the bytes of every id."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        self.pool = Pool([bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                          for i, p in enumerate(self.model.id_to_piece(list(range(n))))])

    def encode(self, texts: list[str]) -> list:
        return self.model.encode(texts, out_type=int, num_threads=1)


_loaded: dict[tuple, object] = {}


def loaded(kind: type, path: str):
    if (kind, path) not in _loaded:
        _loaded[kind, path] = kind(path)
    return _loaded[kind, path]


def gallop(x: np.ndarray, hay: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """For every x the first index i with hay[i] >= x (hay increasing, its last value >= all x).

    The search starts at ``guess``: steps double away from it until x is
    bracketed, and the bracket is halved.
    """
    left, right = guess - 1, guess.copy()
    up = np.flatnonzero(hay[guess] < x)
    left[up], right[up] = guess[up], np.minimum(guess[up] + 1, len(hay) - 1)
    down = np.flatnonzero(hay[guess] >= x)
    step = 1
    while len(up) or len(down):
        up = up[hay[right[up]] < x[up]]
        down = down[(left[down] >= 0) & (hay[left[down]] >= x[down])]
        step *= 2
        left[up], right[up] = right[up], np.minimum(right[up] + step, len(hay) - 1)
        right[down], left[down] = left[down], np.maximum(left[down] - step, -1)
    wide = np.flatnonzero(right - left > 1)
    while len(wide):
        mid = (left[wide] + right[wide]) >> 1
        less = hay[mid] < x[wide]
        left[wide[less]], right[wide[~less]] = mid[less], mid[~less]
        wide = wide[right[wide] - left[wide] > 1]
    return right


class Alignment:
    """Groups and links of the tokens of some texts that both sides reproduce.

    ``a``, ``b``: token ids end to end; ``na``, ``nb``: tokens of every text.
    """

    def __init__(self, a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray, size_a: np.ndarray, size_b: np.ndarray):
        self.a, self.b, self.na, self.nb = a, b, na, nb
        self.end = np.cumsum(size_a[a]), np.cumsum(size_b[b])
        self.text = np.repeat(np.arange(len(na)), na), np.repeat(np.arange(len(nb)), nb)
        self.common = np.zeros(len(a), bool), np.zeros(len(b), bool)      # tokens that end where one of the other side ends
        links = []
        for short in (0, 1):
            texts = na <= nb if short == 0 else nb < na
            links.append(self._drive(short, texts))
        self.link_a = np.concatenate([links[0][0], links[1][1]])
        self.link_b = np.concatenate([links[0][1], links[1][0]])

    def _drive(self, short: int, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Look the ends of the ``short`` side up in the other one, for the texts marked; the links found there."""
        n, m = (self.na, self.nb) if short == 0 else (self.nb, self.na)
        base_n, base_m = np.cumsum(n) - n, np.cumsum(m) - m
        i = np.flatnonzero(texts[self.text[short]])
        none = np.zeros(0, np.int64)
        if not len(i):
            return none, none
        t, x, hay = self.text[short][i], self.end[short][i], self.end[1 - short]
        local = i - base_n[t]
        at = gallop(x, hay, base_m[t] + local * m[t] // n[t])
        both = hay[at] == x
        self.common[short][i[both]] = True
        self.common[1 - short][at[both]] = True
        first = np.empty(len(i), np.int64)
        first[1:] = at[:-1] + both[:-1]                  # rank of the token's begin: ends up to it
        head = local == 0
        first[head] = base_m[t[head]]
        count = at - first + 1
        other = np.arange(int(count.sum())) + np.repeat(first - (np.cumsum(count) - count), count)
        return np.repeat(i, count), other

    def written(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of ``a1,a2|b1;a3|b2,b3`` of every text, each closed by ``;``, and the sizes."""
        ca, cb = self.common
        group_a, group_b = np.cumsum(ca) - ca, np.cumsum(cb) - cb
        upto_a = np.concatenate([[0], np.flatnonzero(ca) + 1])
        upto_b = np.concatenate([[0], np.flatnonzero(cb) + 1])
        n = len(self.a) + len(self.b)
        what, of = np.empty(n, np.int64), np.empty(n, np.int64)
        at_a, at_b = np.arange(len(self.a)) + upto_b[group_a], np.arange(len(self.b)) + upto_a[group_b + 1]
        what[at_a], what[at_b] = 3 * self.a + ca, 3 * self.b + 2 * cb
        of[at_a], of[at_b] = self.text
        raw, size = numbers(int(max(self.a.max(initial=0), self.b.max(initial=0)))).joined(what)
        return raw, np.bincount(of, weights=size, minlength=len(self.na)).astype(np.int64)


_numbers: list[Pool] = []


def numbers(most: int) -> Pool:
    """Decimal numbers up to ``most``, each followed by a comma, a bar and a semicolon."""
    if not _numbers or len(_numbers[0].size) <= 3 * most + 2:
        _numbers[:] = [Pool([b"%d%c" % (i, c) for i in range(max(most + 1, 1 << 16)) for c in b",|;"])]
    return _numbers[0]


def _flat(lists: list) -> tuple[np.ndarray, np.ndarray]:
    n = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(n.sum())), n


def _unfit(ids: np.ndarray, n: np.ndarray, pool: Pool, spaced: list[bytes]) -> np.ndarray:
    """Texts whose joined token bytes are not the text's."""
    raw, size = pool.joined(ids)
    edge = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(n)])]
    if raw.tobytes() == b"".join(spaced) and (np.diff(edge) == np.fromiter(map(len, spaced), np.int64, len(spaced))).all():
        return np.zeros(len(n), bool)
    raw = raw.tobytes()
    return np.array([raw[edge[i]:edge[i + 1]] != s for i, s in enumerate(spaced)], bool)


def encoded(texts: list, a: ByteBpe, b: PieceBpe) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of both sides and their number for every text; zero tokens for texts that are not aligned."""
    some = [i for i, x in enumerate(texts) if x]
    spaced = [" " + texts[i] for i in some]
    ia, na = _flat(a.encode(spaced))
    ib, nb = _flat(b.encode([texts[i] for i in some]))
    raw = [x.encode() for x in spaced]
    bad = _unfit(ia, na, a.pool, raw) | _unfit(ib, nb, b.pool, raw)
    ia, ib = ia[np.repeat(~bad, na)], ib[np.repeat(~bad, nb)]
    counts = np.zeros((2, len(texts)), np.int64)
    counts[0, some], counts[1, some] = na * ~bad, nb * ~bad
    return ia, counts[0], ib, counts[1]


def _pack(x: np.ndarray) -> bytes:
    """Unsigned numbers of two or four bytes, compressed; low and high bytes apart take less room."""
    x = x.astype("<u2" if x.max(initial=0) < 1 << 16 else "<u4")
    return zstandard.ZstdCompressor(level=6).compress(bytes([x.itemsize]) + x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes())


def _unpack(raw: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(raw)
    planes = np.frombuffer(raw, np.uint8, offset=1).reshape(raw[0], -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(f"<u{raw[0]}").astype(np.int64)


def _encode(path_a: str, path_b: str, chunk_bytes: int):
    def run(batches):
        a, b, part, n = loaded(ByteBpe, path_a), loaded(PieceBpe, path_b), TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, col = batch.column(0), batch.column(1)
            for lo, t in tk.slices(col, chunk_bytes):
                ia, na, ib, nb = encoded(col.slice(lo, t.n).to_pylist(), a, b)
                sink = pa.BufferOutputStream()
                some = pa.RecordBatch.from_arrays([ids.slice(lo, t.n)], names=["doc_id"])
                with pa.ipc.new_stream(sink, some.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                    w.write_batch(some)
                blobs = [sink.getvalue().to_pybytes(), *map(_pack, (na, nb, ia, ib))]
                yield pa.RecordBatch.from_arrays([pa.array([(part << 32) + n], pa.int64()), *(pa.array([x], pa.binary()) for x in blobs)],
                                                 names=["chunk", "ids", "na", "nb", "a", "b"])
                n += 1
    return run


def _aligned(row: pa.Table, i: int, a: ByteBpe, b: PieceBpe) -> Alignment:
    x = {c: _unpack(row.column(c)[i].as_py()) for c in ("na", "nb", "a", "b")}
    return Alignment(x["a"], x["na"], x["b"], x["nb"], a.pool.size, b.pool.size)


def _pairs(path_a: str, path_b: str):
    def run(rows: pa.Table) -> pa.Table:
        a, b = loaded(ByteBpe, path_a), loaded(PieceBpe, path_b)
        out = []
        for i in range(len(rows)):
            m = _aligned(rows, i, a, b)
            key, n = np.unique((m.a[m.link_a] << 32) + m.b[m.link_b], return_counts=True)
            out.append(pa.table({"chunk": pa.array(np.full(len(key), rows.column("chunk")[i].as_py()), pa.int64()),
                                 "a": pa.array(key >> 32, pa.int32()), "b": pa.array(key & 0xFFFFFFFF, pa.int32()),
                                 "n": pa.array(n, pa.int64())}))
        return pa.concat_tables(out)
    return run


def _finish(path_a: str, path_b: str):
    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        a, b = loaded(ByteBpe, path_a), loaded(PieceBpe, path_b)
        key = (np.asarray(answers.column("a")).astype(np.int64) << 32) + np.asarray(answers.column("b"))
        order = np.argsort(key)
        key, total = key[order], np.asarray(answers.column("total"))[order]
        best = np.asarray(answers.column("best"))[order].astype(bool)
        out = []
        for i in range(len(rows)):
            m = _aligned(rows, i, a, b)
            ids = pa.ipc.open_stream(rows.column("ids")[i].as_py()).read_all().column(0).combine_chunks()
            n = len(m.na)
            of = m.text[0][m.link_a]
            at = np.searchsorted(key, (m.a[m.link_a] << 32) + m.b[m.link_b])
            upto = np.concatenate([[0], np.cumsum(total[at])]) if len(at) else np.zeros(1, np.int64)
            # the links of a text stand together, those driven by A before those driven by B
            links = np.bincount(of, minlength=n)
            edge = np.concatenate([[0], np.flatnonzero(of[1:] != of[:-1]) + 1, [len(of)]]) if len(of) else np.zeros(1, np.int64)
            sums = np.zeros(n, np.int64)
            sums[of[edge[:-1]]] = upto[edge[1:]] - upto[edge[:-1]]
            raw, size = m.written()
            end = np.cumsum(size)
            keep = np.ones(len(raw), bool)
            keep[end[size > 0] - 1] = False              # the last semicolon
            off = np.concatenate([[0], end - np.cumsum(size > 0)])
            text = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(raw[keep].tobytes())])
            cols = [m.na, m.nb, np.bincount(m.text[0][m.common[0]], minlength=n), links,
                    np.bincount(of[best[at]], minlength=n), sums]
            names = [f.split()[0] for f in ALIGNED.split(", ")]
            out.append(pa.table([ids, *(pa.array(c, pa.int64()) for c in cols), text.cast(pa.binary()).cast(pa.string())], names=names))
        return pa.concat_tables(out)
    return run


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE,
          chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: token, group and link counts, and the groups as ``a1,a2|b1;a3|b2,b3``.

    ``n_best`` counts the links whose pair is as frequent as any pair of its B
    id in the corpus, ``count_sum`` adds the corpus-wide counts over the links.
    """
    packed = slim(docs, id_col, text_col).mapInArrow(_encode(byte_bpe, piece_bpe, chunk_bytes), PACKED)
    pairs = packed.groupBy("chunk").applyInArrow(_pairs(byte_bpe, piece_bpe), PAIRS)
    total = pairs.groupBy("a", "b").agg(F.sum("n").alias("total"))
    most = total.groupBy("b").agg(F.max("total").alias("most"))
    judged = total.join(most, "b").select("a", "b", "total", (F.col("total") == F.col("most")).alias("best"))
    answers = pairs.join(judged, ["a", "b"]).select("chunk", "a", "b", "total", "best")
    return (packed.groupBy("chunk").cogroup(answers.groupBy("chunk"))
            .applyInArrow(_finish(byte_bpe, piece_bpe), ALIGNED))


def digest(aligned: DataFrame) -> DataFrame:
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                          F.when(F.col("n_a") == 0, "").otherwise(F.sha2(F.col("groups").cast("binary"), 256)).alias("groups_sha256"))
