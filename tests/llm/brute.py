"""Plain Python versions of the operators, for small inputs."""

import hashlib
import re

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower_ascii(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def sha(s):
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


def repetition(text, k=8):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, longest repeat."""
    t = text or ""
    w = BLANK.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if BLANK.search(line):
            dup += line in seen
            seen.add(line)
    at = {}
    for i in range(len(w) - k + 1):
        at.setdefault(tuple(w[i:i + k]), []).append(i)
    cover = {i + j for v in at.values() if len(v) > 1 for i in v for j in range(k)}
    longest, n = 0, k
    while True:
        c = {}
        for i in range(len(w) - n + 1):
            c[tuple(w[i:i + n])] = c.get(tuple(w[i:i + n]), 0) + 1
        if not any(v > 1 for v in c.values()):
            break
        longest, n = n, n + 1
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(cover), longest


def contamination(texts, items, k=13):
    """n_words, n_hit, sorted item ids of each text."""
    wins = {}
    for item, text in items:
        w = ALNUM.findall(lower_ascii(text or ""))
        if w:
            n = min(k, len(w))
            for i in range(len(w) - n + 1):
                wins.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = []
    for text in texts:
        w = ALNUM.findall(lower_ascii(text or ""))
        hit, ids = set(), set()
        for n in {len(x) for x in wins}:
            for i in range(len(w) - n + 1):
                x = wins.get(tuple(w[i:i + n]))
                if x:
                    hit.update(range(i, i + n))
                    ids |= x
        out.append((len(w), len(hit), sorted(str(x) for x in ids if x is not None)))
    return out


def pii_base(text):
    t = text or ""
    def luhn(d):
        s = 0
        for i, c in enumerate(reversed(d)):
            v = int(c) * (1 + i % 2)
            s += v - 9 if v > 9 else v
        return s % 10 == 0
    digits = lambda m: re.sub("[^0-9]", "", m)
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15)]
    found = [(m.start(), k, m.end(), name) for k, (name, rx, ok) in enumerate(kinds)
             for m in re.finditer(rx, t) if ok(m.group())]
    found.sort()
    return [sum(f[1] == k for f in found) for k in range(4)], sha(",".join(f"{n}:{b}:{e}" for b, _, e, n in found))


def repeated_bytes(texts, size):
    """n_bytes, n_removed, n_spans, kept hash of each text."""
    raw = [(t or "").encode() for t in texts]
    at = {}
    for d, b in enumerate(raw):
        for i in range(len(b) - size + 1):
            at.setdefault(b[i:i + size], []).append((d, i))
    gone = [[False] * len(b) for b in raw]
    for places in at.values():
        if len(places) > 1:
            for d, i in places:
                gone[d][i:i + size] = [True] * size
    out = []
    for b, g in zip(raw, gone):
        spans = sum(x and not (i and g[i - 1]) for i, x in enumerate(g))
        out.append((len(b), sum(g), spans, sha(bytes(c for c, x in zip(b, g) if not x))))
    return out


def earlier_windows(rows, size=13):
    """n_words, n_removed, kept hash of each (doc_id, text) row; a null id comes after all others."""
    key = lambda i: (i is None, i or 0)
    first = {}
    words = [BLANK.findall(t or "") for _, t in rows]
    for (i, _), w in zip(rows, words):
        for j in range(len(w) - size + 1):
            x = tuple(w[j:j + size])
            first[x] = min(first.get(x, key(i)), key(i))
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for j in range(len(w) - size + 1):
            if first[tuple(w[j:j + size])] < key(i):
                gone.update(range(j, j + size))
        out.append((len(w), len(gone), sha(" ".join(x for j, x in enumerate(w) if j not in gone))))
    return out


def shingle_set(text, k=5):
    w = BLANK.findall(lower_ascii(text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(rows, percent=80):
    """n_shingles and component id of each (doc_id, text) row."""
    sets = [shingle_set(t) for _, t in rows]
    label = list(range(len(rows)))
    def root(x):
        while label[x] != x:
            x = label[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                label[root(a)] = root(b)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    return [(len(s), low.get(root(i))) for i, s in enumerate(sets)]


def earlier_lines(rows, percent=80):
    """Text of each (doc_id, text) row without the lines that match an earlier line; needs distinct doc_ids."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    seen, out = [], [None] * len(rows)
    for i in order:
        if rows[i][1] is None:
            continue
        keep = []
        for line in rows[i][1].split("\n"):
            s = set(BLANK.findall(line))
            if not s or not any(100 * len(s & t) >= percent * len(s | t) for t in seen):
                keep.append(line)
            if s:
                seen.append(s)
        out[i] = "\n".join(keep)
    return out


def greedy_factors(rows, k=13):
    """Factors (start, length, reference doc_id, reference word) of each (doc_id, text); doc_ids differ."""
    docs = {i: BLANK.findall(t or "") for i, t in rows}
    first = {}
    for i in sorted(docs):
        for p in range(len(docs[i]) - k + 1):
            first.setdefault(tuple(docs[i][p:p + k]), (i, p))
    out = {}
    for i, w in docs.items():
        ref = [first[tuple(w[p:p + k])] for p in range(len(w) - k + 1)]
        p, out[i] = 0, []
        while p < len(ref):
            r, q = ref[p]
            if r == i:
                p += 1
                continue
            n = 1
            while p + n < len(ref) and ref[p + n] == (r, q + n):
                n += 1
            out[i].append((p, n - 1 + k, r, q))
            p += n - 1 + k
    return out
