"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words(text, lower=True):
    raw = (text or "").encode()
    return WORD.findall(raw.translate(LOWER) if lower else raw)


def shingle_set(text, k):
    w = words(text)
    return set(zip(*(w[i:] for i in range(k)), strict=False)) if len(w) >= k else ({tuple(w)} if w else set())


def components(docs, k, percent):
    """[(n_shingles, component_id)] for [(doc_id, text)]; component named by the smallest non-null id."""
    sets = [shingle_set(t, k) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(docs):
        if d is not None:
            ids[find(i)].append(d)
    return [(len(s), min(ids[find(i)], default=None) if s else docs[i][0]) for i, s in enumerate(sets)]


def line_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    t = text or ""
    w = words(t, lower=False)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    times = Counter(windows)
    covered = {i + j for i, x in enumerate(windows) if times[x] > 1 for j in range(8)}
    return (len(w), sum(len(x.decode()) for x in w), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered))


def lm(docs, folds=10, held=0):
    """Unigram and bigram counts of the training rows of [(doc_id, text)]."""
    uni, bi = Counter(), Counter()
    for d, t in docs:
        if d is not None and zlib.crc32(str(d).encode()) % folds != held:
            w = ["<b>", *words(t), "<e>"]
            uni.update(w)
            bi.update(zip(w, w[1:], strict=False))
    return uni, bi


def base_score(text, uni):
    n, v = sum(c for w, c in uni.items() if w != "<b>"), len([w for w in uni if w != "<b>"])
    w = [*words(text), "<e>"]
    return sum(math.log10((uni[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), sum(uni[x] > 0 for x in w), len(w), n, v


def viterbi(emit, trans):
    """Best of all label sequences, by trying each."""
    import itertools
    best = max(itertools.product((0, 1), repeat=len(emit)),
               key=lambda y: sum(emit[i][y[i]] for i in range(len(y))) + sum(trans[a][b] for a, b in zip(y, y[1:], strict=False)))
    return list(best)


def runs(words, min_words, min_exponent):
    """[(start, length, period)] of the maximal repetitions, by start, then period."""
    n, out = len(words), []
    for p in range(1, n // min_exponent + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(min_words, min_exponent * p):
                smaller = any(all(words[k] == words[k + q] for k in range(i, j + p - q)) for q in range(1, p))
                out += [] if smaller else [(i, j + p - i, p)]
            i = max(i + 1, j)
    return sorted(out, key=lambda r: (r[0], r[2]))


def with_tail(doc_id, text):
    """The words of a document, a tenth of them with a periodic tail."""
    w = [x.decode() for x in WORD.findall((text or "").encode())]
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if doc_id is None or h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def run_row(doc_id, w, min_words=24, min_exponent=3):
    found, dropped, top = runs(w, min_words, min_exponent), set(), None
    for s, n, q in found:
        dropped |= set(range(s + q, s + n))
        if top is None or n * top[2] > top[1] * q:
            top = (s, n, q)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = " ".join(x for i, x in enumerate(w) if i not in dropped)
    return (doc_id, len(found), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def without_repeats(rows, length):
    """[(doc_id, n_bytes, n_removed, n_spans, sha256 of the rest)] for [(doc_id, text)]."""
    first, out = {}, []
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - length + 1) if d is not None else ():
            first[b[i:i + length]] = min(d, first.get(b[i:i + length], d))
    for d, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - length + 1) if d is not None else ():
            if first[b[i:i + length]] < d:
                gone[i:i + length] = [True] * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def hard_negatives(rows, anchor, keep=5, scale=256):
    """[(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)] for [(vec_id, label, vector)]."""
    v = [(i, y, [math.floor(scale * x) for x in e]) for i, y, e in rows
         if y is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for k, (i, y, q) in enumerate(v):
        if i is None or not anchor(i):
            continue
        scored = sorted(((-max(-1 << 63, min((1 << 63) - 1, sum(a * b for a, b in zip(q, o)))), j is None, j or 0, z == y, n)
                         for n, (j, z, o) in enumerate(v) if n != k))
        negative = [(-s, None if null else j) for s, null, j, same, _ in scored if not same]
        for p, j in [(-s, None if null else j) for s, null, j, same, _ in scored if same][:keep]:
            window = [x for x in negative if 80 * p <= 100 * x[0] <= 100 * p][:keep]
            out += [(i, j, r + 1, n, p, s) for r, (s, n) in enumerate(window)]
    return out
