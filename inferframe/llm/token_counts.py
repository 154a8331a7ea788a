"""Exact token counts of every prefix by dynamic programming.

Byte-pair encodings have a prefix property: cutting the encoding of a piece of text after any token
gives the encoding of that shorter piece. So the last token of each prefix is decided left to
right: for prefix length p it is the one token t ending at p that is reachable by merges and
whose neighbour, the last token of the prefix before t, stays separate next to it. Storing the last
token and the count per prefix answers "how many tokens has this prefix" and "where must the text be cut for a
budget" without encoding anything again (`PrefixCounter.prefixes`, `PrefixCounter.cut`).

The text is first cut into pieces by the tokenizer's own pattern, as the library does; counts add up over
pieces. Three places need care because a prefix may be cut differently from the whole text, and
`prefixes` treats them exactly: inside a run of white space (the whole run up to the cut is one
piece there), inside a contraction such as 're (quote and letters are separate until it is
complete), and inside a special string (ordinary text until it is complete).

Whole-text counts are kept per distinct piece in a two-generation cache of `CACHE` pieces, so the
dynamic programme runs only once per new piece and memory stays bounded. Special strings in texts
count as the library's default treats them: one token each.

Defined results: null text counts as empty: 0 bytes, 0 tokens. Prefix positions are code points. A null doc_id is
carried through, repeated rows get equal answers, an empty table gives an empty result, extra columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inferframe.llm.shared import ship

LIMIT = 512
CACHE = 300_000
#: fixed: the cutting pattern of byte-level BPE vocabularies of this family
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_counters: dict[str, PrefixCounter] = {}


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files of this kind: printable
    Latin-1 bytes stand for themselves, the others follow from code point 256 on, in byte order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter:
    """Prefix counts for one byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        import regex
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letter = byte_letters()
        raw = lambda s: bytes(letter[c] for c in s)
        self.rank = {}
        for i, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.rank.setdefault((raw(a), raw(b)), i)
        self.specials = [t["content"] for t in spec["added_tokens"] if t["special"]]
        marks = {t["content"] for t in spec["added_tokens"]}
        vocab = [raw(t) for t in spec["model"]["vocab"] if t not in marks and all(c in letter for c in t)]
        # a token that merges never reach can't be in an encoding
        self.tokens = {t for t in vocab if len(t) == 1 or self.merge(t) == [t]}
        self.longest = max(map(len, self.tokens))
        self.pattern, self.space = regex.compile(PATTERN), regex.compile(r"\s+")
        self.special = regex.compile("|".join(map(regex.escape, self.specials))) if self.specials else None
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.counts = _Counts(self)

    def merge(self, piece: bytes) -> list[bytes]:
        """Plain byte-pair merging, used only to decide single tokens and pairs of tokens."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            ranks = [self.rank.get(p, 1 << 60) for p in zip(parts, parts[1:], strict=False)]
            best = min(ranks)
            if best == 1 << 60:
                break
            a, b = next(p for p, r in zip(zip(parts, parts[1:], strict=False), ranks, strict=True) if r == best)
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and parts[i] == a and parts[i + 1] == b:
                    out.append(a + b)
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def apart(self, a: bytes, b: bytes) -> bool:
        """Do a and b stay two tokens when they are neighbours."""
        got = self.pairs.get((a, b))
        if got is None:
            if len(self.pairs) > CACHE:
                self.pairs.clear()
            got = self.pairs[a, b] = self.merge(a + b) == [a, b]
        return got

    def table(self, piece: bytes) -> list[int]:
        """Token counts of the byte prefixes of one piece: entry p for the first p bytes."""
        n, tokens, longest = len(piece), self.tokens, self.longest
        counts, last = [0] * (n + 1), [b""] * (n + 1)
        for p in range(1, n + 1):
            for s in range(max(0, p - longest), p):
                t = piece[s:p]
                if t in tokens and (s == 0 or self.apart(last[s], t)):
                    counts[p], last[p] = counts[s] + 1, t
                    break
            else:
                raise ValueError("the vocabulary has no token for a byte")
        return counts

    def segments(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text between special strings, and the special strings themselves (True)."""
        at = 0
        for m in self.special.finditer(text) if self.special is not None else ():
            if m.start() > at:
                yield text[at:m.start()], False
            yield m.group(), True
            at = m.end()
        if at < len(text):
            yield text[at:], False

    def count(self, text: str) -> int:
        """Tokens of the whole text."""
        if self.special is None or not any(s in text for s in self.specials):
            return sum(map(self.counts.__getitem__, self.pattern.findall(text)))
        return sum(1 if special else sum(map(self.counts.__getitem__, self.pattern.findall(part)))
                   for part, special in self.segments(text))

    def _piece_prefixes(self, piece: str) -> list[int]:
        """Counts after each code point of one piece (the first entry, 0, left out)."""
        table, at, out = self.table(piece.encode()), 0, []
        for c in piece:
            at += len(c.encode())
            out.append(table[at])
        return out

    def _segment_prefixes(self, text: str) -> list[int]:
        out, base, run_end = [], 0, 0
        for m in self.pattern.finditer(text):
            piece, a, b = m.group(), m.start(), m.end()
            if self.space.fullmatch(piece):
                # a prefix that ends inside a run of white space has the run so far as one piece
                if a >= run_end:
                    run_end = self.space.match(text, a).end()
                    run = self._piece_prefixes(text[a:run_end])
                    run_start, run_base = a, base
                out += [run_base + run[i - run_start] for i in range(a, b)]
            else:
                if piece[0] == "'" and len(piece) > 1 and piece[1:].isalpha():
                    inside = [1] + [1 + self._piece_prefixes(piece[1:])[i] for i in range(len(piece) - 2)] + [self.counts[piece]]
                else:
                    inside = self._piece_prefixes(piece)
                if a < run_end and piece[0] == " ":  # the blank that the run hands to the next piece
                    inside[0] = run_base + run[a - run_start] - base
                out += [base + x for x in inside]
            base += self.counts[piece]
        return out

    def prefixes(self, text: str) -> np.ndarray:
        """Exact token count of text[:i] for i = 0 ... len(text)."""
        out, done = [0], 0
        parts = list(self.segments(text))
        for k, (part, special) in enumerate(parts):
            if special:
                # until it is complete, a special string continues the text before it
                before = parts[k - 1][0] if k and not parts[k - 1][1] else ""
                base = done - sum(map(self.counts.__getitem__, self.pattern.findall(before)))
                out += [base + self.count(before + part[:i]) for i in range(1, len(part))] + [done + 1]
                done += 1
            else:
                inside = self._segment_prefixes(part)
                out += [done + x for x in inside]
                done += inside[-1] if inside else 0
        return np.array(out, np.int64)

    def cut(self, text: str, budget: int) -> int:
        """Length in code points of the longest prefix of at most `budget` tokens."""
        return int(np.flatnonzero(self.prefixes(text) <= budget)[-1])


class _Counts(dict):
    """piece -> number of tokens, filled by the dynamic programme; old entries leave by generation."""

    def __init__(self, owner: PrefixCounter):
        super().__init__()
        self.owner, self.old = owner, {}

    def __missing__(self, piece: str) -> int:
        got = self.old.get(piece)
        if got is None:
            raw = piece.encode()
            got = 1 if raw in self.owner.tokens else self.owner.table(raw)[-1]
        if len(self) >= CACHE:
            self.old = dict(self)
            self.clear()
        if len(piece) <= 64:
            self[piece] = got
        return got


def counter(path: str) -> PrefixCounter:
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def _count_batches(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(tokenizer)
        for batch in batches:
            ids, text = batch.column(0), batch.column(1)
            size = pc.fill_null(pc.binary_length(text), 0).cast(pa.int64())
            for i in range(0, len(ids), 256):
                n = [c.count(x) if x else 0 for x in text.slice(i, 256).to_pylist()]
                yield pa.RecordBatch.from_arrays([ids.slice(i, len(n)), size.slice(i, len(n)), pa.array(n, pa.int64())],
                                                 names=["doc_id", "n_bytes", "n_tokens"])
    return run


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of docs."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")) \
        .mapInArrow(_count_batches(tokenizer), "doc_id long, n_bytes long, n_tokens long") \
        .withColumn("over_limit", F.col("n_tokens") > limit)


def _prefix_batches(tokenizer: str, budget: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(tokenizer)
        for batch in batches:
            for i in range(len(batch)):
                counts = c.prefixes(batch.column(1)[i].as_py() or "")
                if budget is None:
                    made, name = pa.array([counts.tolist()], pa.list_(pa.int64())), "prefix_tokens"
                else:
                    made, name = pa.array([int(np.flatnonzero(counts <= budget)[-1])], pa.int64()), "fit_chars"
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), made], names=["doc_id", name])
    return run


def prefix_tokens(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and the token count of every prefix of its text (array of n_chars + 1 counts)."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")) \
        .mapInArrow(_prefix_batches(tokenizer, None), "doc_id long, prefix_tokens array<long>")


def truncated(docs: DataFrame, tokenizer: str, budget: int) -> DataFrame:
    """doc_id and fit_chars, the length in code points of the longest prefix within `budget` tokens."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")) \
        .mapInArrow(_prefix_batches(tokenizer, budget), "doc_id long, fit_chars long")
