"""Quality rules on repetition inside a text, by suffix array and LCP intervals.

The words of a text form its string. Only positions whose first ``min_words``
words occur again in the same text can start a repeat, so the suffix array is
built over those: they are ranked by their first ``min_words`` words and
re-ranked by pairs (rank, rank one length further) at doubling lengths until
no two are equal. The ranks of all lengths then give the longest common prefix
of neighbours in suffix order by binary descent. A suffix belongs to the
maximal repeat of its larger neighbouring LCP; the union of these spans is the
repeated part, the largest LCP the longest repeat.

Defined results: null or empty text has no words and fails the base rules
(fewer than ``MIN_WORDS`` words); every row is judged on its own, so repeated
rows give equal rows; an empty table gives an empty result. Words and lines
are equal when their 64-bit hashes are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridemart.llm import tokens as tk
from ridemart.llm.frames import slim

MIN_REPEAT = 8            # words of the shortest repeat that counts
MIN_WORDS = 20            # base rule: shorter texts fail
BASE_REPEAT_PERCENT = 30  # base rule: share of words in repeated 8-word windows
# Verdict: share of words inside maximal repeats. Published quality rules allow 12 percent of a text in repeated
# 8-grams without their first occurrence; with it, as spans count here, that is twice as much.
MAX_COVERED = 0.24
MAX_LONGEST = 100         # verdict: words of the longest maximal repeat, however little of the text it is

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "n_repeats long, n_covered long, longest_repeat long")


def _per_text(t: tk.Texts, mask: np.ndarray) -> np.ndarray:
    """Number of marked bytes of every text."""
    c = np.concatenate([[0], np.cumsum(mask)])
    return c[t.off[1:]] - c[t.off[:-1]]


def dup_lines(t: tk.Texts, w: tk.Words) -> np.ndarray:
    """Lines that hold a word and equal an earlier line of the same text."""
    if not len(w):
        return np.zeros(t.n, np.int64)
    breaks = np.flatnonzero(t.data == 10)
    line_start = np.unique(np.concatenate([t.off[:-1], breaks + 1]))
    line = np.searchsorted(line_start, w.start, "right") - 1
    first = np.concatenate([[True], line[1:] != line[:-1]])
    line, doc = line[first], w.doc[first]
    stop = np.concatenate([breaks, [len(t.data)]])
    start = line_start[line]
    end = np.minimum(stop[np.searchsorted(stop, start)], t.off[1:][doc])
    key = tk.mix(w.hash_of(start, end) + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    at = np.unique(key, return_index=True)[1]
    return np.bincount(doc, minlength=t.n) - np.bincount(doc[at], minlength=t.n)


def _ranks(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense rank of every key, and whether it occurs more than once."""
    _, inv, count = np.unique(key, return_inverse=True, return_counts=True)
    return inv, count[inv] > 1


def suffix_repeats(h: np.ndarray, doc: np.ndarray, starts: np.ndarray, min_words: int):
    """Positions in suffix order and their longest repeat (in words); ``starts``: whole-window positions."""
    n = len(h)
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(starts):
        return none
    key = tk.mix(tk.grams(h, min_words)[starts] + doc[starts].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    rank, again = _ranks(key)
    pos, rank = starts[again], rank[again]
    if not len(pos):
        return none
    # levels[j][p]: rank of the min_words * 2^j words from p, unique negative where nothing else is equal
    levels, size, order_key = [], min_words, rank
    at = np.arange(-1, -n - 1, -1, dtype=np.int64)
    level = at.copy()
    level[pos] = rank
    live = pos
    sa_keys = [rank]
    full = np.zeros(n, np.int64)
    while len(live):
        levels.append(level)
        nxt = live + size
        inside = nxt < n
        second = at[live].copy()
        second[inside] = np.where(doc[nxt[inside]] == doc[live[inside]], level[nxt[inside]], second[inside])
        # order-preserving pair rank: by first rank, then second
        order = np.lexsort((second, level[live]))
        a, b = level[live][order], second[order]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        r = np.cumsum(new) - 1
        pair = np.empty(len(live), np.int64)
        pair[order] = r
        full[:] = 0
        full[live] = pair + 1
        sa_keys.append(full[pos].copy())
        twice = np.bincount(r, minlength=r[-1] + 1)[pair] > 1
        level = at.copy()
        level[live[twice]] = pair[twice]
        live, size = live[twice], size * 2
    order = np.lexsort(sa_keys[::-1])
    p = pos[order]
    a, b, lcp = p[:-1], p[1:], np.zeros(len(p) - 1, np.int64)
    for j in range(len(levels) - 1, -1, -1):
        i, k = a + lcp, b + lcp
        ok = (i < n) & (k < n)
        same = np.zeros(len(a), bool)
        same[ok] = levels[j][i[ok]] == levels[j][k[ok]]
        lcp += same * (min_words << j)
    live = np.flatnonzero(lcp > 0)
    for _ in range(min_words - 1):          # the rest is shorter than the shortest ranked length
        i, k = a[live] + lcp[live], b[live] + lcp[live]
        ok = (i < n) & (k < n)
        live, i, k = live[ok], i[ok], k[ok]
        same = (h[i] == h[k]) & (doc[i] == doc[a[live]]) & (doc[k] == doc[b[live]])
        live = live[same]
        lcp[live] += 1
    best = np.maximum(np.concatenate([[0], lcp]), np.concatenate([lcp, [0]]))
    return p, best


def _rows(min_words: int):
    def run(batches):
        for batch in batches:
            for lo, t in tk.slices(batch.column(1)):
                w = tk.Words(t, tk.BLANK_WORDS)
                in_word = tk.BLANK_WORDS[t.data]
                p, best = suffix_repeats(w.hash, w.doc, tk.whole_starts(w.count, w.first, min_words), min_words)
                window = tk.covered(p, min_words, len(w))
                spans = tk.covered(p, best, len(w))
                longest = np.zeros(t.n, np.int64)
                np.maximum.at(longest, w.doc[p], best)
                begin, _ = tk.runs(spans)
                cols = [w.count, _per_text(t, in_word & ((t.data & 0xC0) != 0x80)), _per_text(t, SYMBOLS[t.data]),
                        dup_lines(t, w), np.bincount(w.doc[window], minlength=t.n),
                        np.bincount(w.doc[begin], minlength=t.n), np.bincount(w.doc[spans], minlength=t.n), longest]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, t.n)] + [pa.array(c, pa.int64()) for c in cols],
                                                 names=[f.split()[0] for f in SCHEMA.split(", ")])
    return run


def repetition(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_REPEAT) -> DataFrame:
    """One row per document with its counts and the figures of its maximal repeats."""
    return slim(docs, id_col, text_col).mapInArrow(_rows(min_words), SCHEMA)


def verdict(figures: DataFrame, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """Adds base_failed and kept to the rows of :func:`repetition`."""
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > BASE_REPEAT_PERCENT * F.col("n_words"))
    fine = (F.col("n_covered") <= max_covered * F.col("n_words")) & (F.col("longest_repeat") <= max_longest)
    return figures.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & fine)
