"""SentencePiece BPE encoding with seeded merge-dropout, and lossless decoding.

A text is cut into units no merge can cross (runs of spaces start a unit).
Inside a unit an agenda holds the candidate merges by score, then position;
a candidate taken from the agenda is skipped when the hash of (seed, doc_id,
text, the unit's place in the text, unit, position, piece) falls under the
dropout rate. So every occurrence of a word has coins of its own, within a text
and between texts, exact copies included; a rerun gives the same ids. All
occurrences of a slice are segmented many together. Plain encoding (rate 0) has
no coins: there distinct units are segmented once and kept by the worker, told
apart by 64-bit hashes. The digest checks the round trip.

Decoding joins the pieces; a piece's space mark is a space, byte pieces are
bytes. A literal space mark in the text is encoded by its bytes, so decoding
gives back every text exactly.

Defined results: null text gives null ids and decodes to null; the empty text
gives no ids; repeated rows give equal rows; an empty table an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridemart.llm import tokens as tk
from ridemart.llm.frames import ship, slim

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 20_240
MARK = "▁"
_LITERAL_MARK = "\ud800"  # stands for a literal mark inside a unit; no piece has it
_MASK = (1 << 64) - 1
_NEVER = 1 << 30
KEEP_UNITS = 1_000_000    # segmented units a worker keeps (some 35 bytes each)
UNITS_AT_ONCE = 16_384
TASK_BYTES = 1 << 20      # text handled at once in a task
WIDTHS = (6, 9, 12, 18, 32)     # length classes of units that are segmented together
SHORT_UNIT = WIDTHS[-1]


class Vocabulary:
    """Merges and ids of the pieces, and the bytes of every id.

    Symbols are numbered by their piece id; characters that only occur inside
    pieces get numbers above, all others negative ones (they merge with nothing).
    """

    def __init__(self, path: str, merges: bool = True):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.byte = [0] * 256
        number: dict[str, int] = {}
        score: dict[int, float] = {}
        raw = []
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                b = int(piece[3:5], 16)
                self.byte[b] = i
                raw.append(bytes([b]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                raw.append(b"")
            else:
                number[piece], score[i] = i, sp.get_score(i)
                raw.append(piece.replace(MARK, " ").encode())
        self.n = n
        self.pool = np.frombuffer(b"".join(raw), np.uint8)
        self.pool_off = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
        if not merges:                       # decoding needs no more
            return
        pieces = list(number.items())
        self.outside = []                    # characters with a number from n on
        for piece, _ in pieces:
            for c in piece:
                if c not in number:
                    number[c] = n + len(self.outside)
                    self.outside.append(c)
        self.char = {c: i for c, i in number.items() if len(c) == 1}
        places = {x: r for r, x in enumerate(sorted(set(score.values()), reverse=True))}
        self.rank = [places[score[i]] if i in score else 0 for i in range(n)]
        merge: dict[int, int] = {}
        for piece, i in pieces:
            for cut in range(1, len(piece)):
                left, right = number.get(piece[:cut]), number.get(piece[cut:])
                if left is not None and right is not None:
                    merge[left << 20 | right] = i

        self.of_code = -1 - np.arange(0x110000, dtype=np.int32)
        for c, i in self.char.items():
            self.of_code[ord(c)] = i
        self.of_code[ord(MARK)] = -1 - ord(_LITERAL_MARK)
        self.of_code[0x20] = self.char[MARK]
        self.ranks = np.array(self.rank, np.int32)
        self._fill_pairs(np.array(list(merge), np.int64), np.array(list(merge.values()), np.int32))

    def _fill_pairs(self, keys: np.ndarray, ids: np.ndarray) -> None:
        """The merges as an open-addressing table of arrays."""
        self.bits = max(4, (2 * len(keys)).bit_length())
        self.pair = np.full(1 << self.bits, -1, np.int64)
        self.made = np.full(1 << self.bits, -1, np.int32)
        at = self._slot(keys)
        while len(keys):
            free = self.pair[at] == -1
            _, one = np.unique(np.where(free, at, -1 - np.arange(len(at))), return_index=True)
            put = one[free[one]]
            self.pair[at[put]], self.made[at[put]] = keys[put], ids[put]
            left = np.ones(len(keys), bool)
            left[put] = False
            keys, ids, at = keys[left], ids[left], (at[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Piece that two symbols make, -1 if none."""
        out = np.full(len(left), -1, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        key = left[todo].astype(np.int64) << 20 | right[todo]
        at = self._slot(key)
        while len(todo):
            there = self.pair[at]
            same = there == key
            out[todo[same]] = self.made[at[same]]
            on = ~same & (there != -1)
            todo, key, at = todo[on], key[on], (at[on] + 1) & ((1 << self.bits) - 1)
        return out

    def symbols(self, unit: bytes) -> list[int]:
        text = unit.decode("utf-8", "surrogateescape").replace(MARK, _LITERAL_MARK).replace(" ", MARK)
        get = self.char.get
        return [get(c, -1 - ord(c)) for c in text]

    def ids(self, symbols: list[int]) -> list[int]:
        if min(symbols) >= 0 and max(symbols) < self.n:
            return symbols
        out = []
        for s in symbols:
            if 0 <= s < self.n:
                out.append(s)
            else:
                c = (chr(-1 - s) if s < 0 else self.outside[s - self.n]).replace(_LITERAL_MARK, MARK)
                out.extend(self.byte[b] for b in c.encode("utf-8", "surrogateescape"))
        return out


def skipped(key: int, left: int, piece: int, threshold: int) -> bool:
    """The keyed coin of one candidate merge (``left``: its first character's place in the unit)."""
    x = (key ^ (left * 0x9E3779B97F4A7C15) ^ (piece * 0xC2B2AE3D27D4EB4F)) & _MASK
    x = ((x ^ (x >> 31)) * 0xBF58476D1CE4E5B9) & _MASK
    return ((x ^ (x >> 32)) & 0xFFFFFFFF) < threshold


def segment(unit: bytes, v: Vocabulary, key: int = 0, threshold: int = 0) -> list[int]:
    """Ids of one unit; ``threshold`` is the dropout rate times 2^32."""
    return v.ids(_agenda(v.symbols(unit), v, key, threshold))


def _coins(key: np.ndarray, left: np.ndarray, piece: np.ndarray, threshold: int) -> np.ndarray:
    """:func:`skipped` for many candidates."""
    x = key ^ (left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (piece.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(32))) & np.uint64(0xFFFFFFFF)) < threshold


def _many(sym: np.ndarray, size: np.ndarray, v: Vocabulary, key: np.ndarray, threshold: int) -> np.ndarray:
    """Units of one length class, a row each: in every round each unit takes the head of its agenda.

    ``sym`` is changed in place; the mask of the symbols that are left is returned.
    """
    n, width = sym.shape
    col = np.arange(width)
    alive = col < size[:, None]
    nxt = np.broadcast_to(col + 1, sym.shape).astype(np.int16)
    prev = np.broadcast_to(col - 1, sym.shape).astype(np.int16)
    piece = np.full((n, width), -1, np.int32)
    piece[:, :-1] = v.merged(np.where(alive[:, :-1], sym[:, :-1], -1).reshape(-1),
                             np.where(alive[:, 1:], sym[:, 1:], -1).reshape(-1)).reshape(n, width - 1)
    order = np.where(piece >= 0, v.ranks[piece], _NEVER)
    rows = np.arange(n)
    while len(rows):
        i = order[rows].argmin(1)
        some = order[rows, i] < _NEVER
        rows, i = rows[some], i[some]
        m = piece[rows, i]
        order[rows, i] = _NEVER
        if threshold:
            go = ~_coins(key[rows], i, m, threshold)
            r, i, m = rows[go], i[go], m[go]
        else:
            r = rows
        j = nxt[r, i].astype(np.int64)
        k = nxt[r, j].astype(np.int64)
        sym[r, i], alive[r, j], nxt[r, i], order[r, j] = m, False, k, _NEVER
        right = k < size[r]
        prev[r[right], k[right]] = i[right]
        p = prev[r, i].astype(np.int64)
        left = p >= 0
        for rr, a, b in ((r[right], i[right], k[right]), (r[left], p[left], i[left])):
            x = v.merged(sym[rr, a], sym[rr, b])
            piece[rr, a] = x
            order[rr, a] = np.where(x >= 0, v.ranks[x], _NEVER)
    return alive


def segment_units(u: tk.Units, v: Vocabulary, threshold: int, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of some distinct units of a slice, one after the other, and their number for each unit."""
    return segment_spans(u.buf, u.start[u.example[which]], u.end[u.example[which]], u.key[which], v, threshold)


def segment_spans(buf: np.ndarray, start: np.ndarray, end: np.ndarray, key: np.ndarray, v: Vocabulary,
                  threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the units at these places of a buffer, each with the key of its coins, and their number for each unit."""
    raw = buf.tobytes()
    try:
        code = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        char = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    except UnicodeDecodeError:                       # not valid UTF-8: one unit at a time
        code = None
    size = char[end] - char[start] if code is not None else np.full(len(start), SHORT_UNIT + 1)
    parts, of = [], []
    low = 0
    for width in WIDTHS:
        some = np.flatnonzero((size > low) & (size <= width))
        low = width
        for lo in range(0, len(some), UNITS_AT_ONCE):
            unit = some[lo:lo + UNITS_AT_ONCE]
            at = char[start[unit]][:, None] + np.arange(width)
            sym = v.of_code[code[np.minimum(at, len(code) - 1)]]
            alive = _many(sym, size[unit], v, key[unit], threshold)
            parts.append(sym[alive])
            of.append(np.repeat(unit, alive.sum(1)))
    for i in np.flatnonzero(size > SHORT_UNIT):
        x = _agenda(v.symbols(raw[start[i]:end[i]]), v, int(key[i]), threshold)
        parts.append(np.array(x, np.int32))
        of.append(np.full(len(x), i))
    values = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    of = np.concatenate(of) if of else np.zeros(0, np.int64)
    order = np.argsort(of, kind="stable")
    values, of = values[order], of[order]
    odd = np.unique(of[(values < 0) | (values >= v.n)])
    if len(odd):                                     # characters without a piece become their bytes
        edge = np.searchsorted(of, np.arange(len(start) + 1))
        pieces, owners, done = [], [], 0
        for i in odd:
            x = np.array(v.ids(values[edge[i]:edge[i + 1]].tolist()), np.int32)
            pieces += [values[done:edge[i]], x]
            owners += [of[done:edge[i]], np.full(len(x), i)]
            done = edge[i + 1]
        values, of = np.concatenate([*pieces, values[done:]]), np.concatenate([*owners, of[done:]])
    return values, np.bincount(of, minlength=len(start))


class Segmented:
    """What a worker has segmented so far: sorted unit keys with the place and number of their ids."""

    def __init__(self):
        self.key, self.start, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.values = np.zeros(0, np.int32)

    def encode(self, u: tk.Units, v: Vocabulary, threshold: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units of a slice in order, and their number for each unit."""
        if len(self.key) > KEEP_UNITS:
            self.__init__()
        new = np.flatnonzero(~np.isin(u.key, self.key, assume_unique=True))
        values, size = segment_units(u, v, threshold, new)
        at = np.searchsorted(self.key, u.key[new])
        self.start = np.insert(self.start, at, len(self.values) + np.cumsum(size) - size)
        self.size = np.insert(self.size, at, size)
        self.key = np.insert(self.key, at, u.key[new])
        self.values = np.concatenate([self.values, values])
        at = np.searchsorted(self.key, u.key)
        return tk.gather(self.values, self.start[at], self.size[at], u.index)


def _agenda(sym: list[int], v: Vocabulary, key: int, threshold: int) -> list[int]:
    """A unit of any length: the agenda is a heap of (rank, place, piece)."""
    rank = v.rank
    n = len(sym)
    alive = [True] * n
    prev, nxt = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = []

    def propose(i):
        j = nxt[i]
        if j < n:
            m = int(v.merged(np.array([sym[i]]), np.array([sym[j]]))[0])
            if m >= 0:
                heapq.heappush(heap, (rank[m], i, m, sym[i], sym[j]))

    made = v.merged(np.array(sym[:-1]), np.array(sym[1:])) if n > 1 else ()
    heap = [(rank[m], i, m, sym[i], sym[i + 1]) for i, m in enumerate(np.asarray(made).tolist()) if m >= 0]
    heapq.heapify(heap)
    while heap:
        _, i, m, a, b = heapq.heappop(heap)
        j = nxt[i]
        if not alive[i] or j >= n or sym[i] != a or sym[j] != b:
            continue
        if threshold and skipped(key, i, m, threshold):
            continue
        sym[i], alive[j] = m, False
        nxt[i] = nxt[j]
        if nxt[i] < n:
            prev[nxt[i]] = i
            propose(i)
        if prev[i] >= 0:
            propose(prev[i])
    return [s for s, live in zip(sym, alive) if live]


_loaded: dict[tuple[str, bool], Vocabulary] = {}
_kept: dict[tuple, Segmented] = {}       # of this worker, for each model and rate; plain encoding only


def segmented(path: str, threshold: int) -> Segmented:
    return _kept.setdefault((path, threshold), Segmented())


def coin_keys(u: tk.Units, salt: np.ndarray) -> np.ndarray:
    """A key for every unit of a slice: of its text's salt, its place in the text and its content."""
    count = np.diff(u.first)
    place = (np.arange(len(u.start)) - np.repeat(u.first[:-1], count)).astype(np.uint64)
    return tk.mix(u.key[u.index] ^ tk.mix(np.repeat(salt, count) + place * np.uint64(0x9E3779B97F4A7C15)))


def vocabulary(path: str, merges: bool = True) -> Vocabulary:
    if (path, merges) not in _loaded:
        _loaded[path, merges] = Vocabulary(path, merges)
    return _loaded[path, merges]


def _encode(path: str, dropout: float, seed: int):
    def run(batches):
        v, threshold = vocabulary(path), int(dropout * 2**32)
        for b in batches:
            ids_col, texts = b.column(0), b.column(1)
            ids = np.asarray(ids_col.fill_null(-1)).astype(np.int64).view(np.uint64)
            salt = tk.mix(tk.mix(ids) + np.uint64(seed))
            for lo, t in tk.slices(texts, TASK_BYTES):
                u = tk.Units(t)
                if threshold:
                    own = tk.mix(salt[lo:lo + t.n] ^ tk.SpanHash(t.data)(t.off[:-1], t.off[1:]))
                    values, size = segment_spans(u.buf, u.start, u.end, coin_keys(u, own), v, threshold)
                else:
                    values, size = segmented(path, 0).encode(u, v, 0)
                upto = np.concatenate([[0], np.cumsum(size)])
                # the unit of an empty text is its leading space alone
                empty = np.diff(t.off) == 0
                per_text = upto[u.first[1:]] - upto[u.first[:-1]]
                if empty.any():
                    values = values[np.repeat(~empty, per_text)]
                    per_text[empty] = 0
                out = tk.list_array(values, per_text, pa.int32())
                chunk = texts.slice(lo, t.n)
                if chunk.null_count:
                    out = pa.array([None if not ok else x for ok, x in zip(chunk.is_valid().to_pylist(), out.to_pylist())],
                                   pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([ids_col.slice(lo, t.n), chunk, out], names=["doc_id", "text", "ids"])
    return run


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL,
           dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """doc_id, text and ids (array<int>) of every document; ``dropout`` 0 is the plain encoding."""
    return slim(docs, id_col, text_col).mapInArrow(_encode(model, dropout, seed),
                                                   "doc_id long, text string, ids array<int>")


def _decode(path: str, others: list[str], ids_col: str, out: str):
    def run(batches):
        v = vocabulary(path, merges=False)
        for b in batches:
            col = b.column(b.schema.get_field_index(ids_col))
            step = max(1, int(len(col) * (TASK_BYTES // 4) // max(1, len(col.values) if len(col) else 1)))
            for lo in range(0, len(col), step):
                part = col.slice(lo, step)
                counts = np.asarray(part.value_lengths().fill_null(0))
                values = np.asarray(part.flatten())
                raw, size = tk.gather(v.pool, v.pool_off[:-1], np.diff(v.pool_off), values)
                upto = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(counts)])]
                keep = np.ones(len(raw), bool)
                keep[upto[:-1][counts > 0]] = False         # the leading space
                raw = raw[keep].tobytes()
                ends = upto - np.concatenate([[0], np.cumsum(counts > 0)])
                text = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(part),
                                                        [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(raw)])
                text = text.cast(pa.binary()).cast(pa.string(), safe=False)
                if part.null_count:
                    text = pc.if_else(part.is_valid(), text, pa.scalar(None, pa.string()))
                cols = [b.column(b.schema.get_field_index(c)).slice(lo, len(part)) for c in others]
                yield pa.RecordBatch.from_arrays([*cols, text], names=[*others, out])
    return run


def decode(encoded: DataFrame, ids_col: str = "ids", out: str = "decoded", model: str = MODEL) -> DataFrame:
    """Adds the decoded text of every row's ids."""
    ship(encoded.sparkSession)
    others = [c for c in encoded.columns if c != out]
    schema = encoded.select(others).schema.add(out, "string")
    return encoded.select(others).mapInArrow(_decode(model, others, ids_col, out), schema)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL,
               dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """:func:`encode` and :func:`decode` in one pass: doc_id, text, ids and decoded."""
    encoder, decoder = _encode(model, dropout, seed), _decode(model, ["doc_id", "text", "ids"], "ids", "decoded")
    return slim(docs, id_col, text_col).mapInArrow(lambda batches: decoder(encoder(batches)),
                                                   "doc_id long, text string, ids array<int>, decoded string")


def digest(decoded: DataFrame) -> DataFrame:
    """Token counts, a hash of the ids, and whether decoding gave the text back."""
    return decoded.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"),
                          F.xxhash64("ids").alias("ids_hash"), F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))
