"""Benchmark decontamination by pigeonhole edit matching.

A document leaks a test item if some stretch of it is within the item's error
budget (edit distance). The item is split into budget + 1 pieces; with at most
``budget`` edits one piece stands unchanged, so an Aho-Corasick automaton of all
pieces finds every candidate stretch. A candidate is dropped if too many of the
item's 4-grams are missing from it (an edit spoils at most four), and verified
with Myers' bit-parallel edit distance otherwise.

The test items are a stated query set: they meet all documents in blocks of at
most ``BLOCK_CHARS`` characters, each block broadcast by itself.

Texts are compared lower-cased, with each run of white space as one space.
Defined results: NULL and blank texts and items match nothing; repeated items
and documents are reported each; of several stretches of one document the
closest, then the first, is reported.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regcurate.llm.shared import in_arrow

BUDGET = 0.1
BLOCK_CHARS = 4_000_000
_GRAM = 4


def plain(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def pieces_of(text: str, budget: int) -> list[tuple[int, str]]:
    """(offset, piece): budget + 1 pieces of nearly equal length."""
    n = budget + 1
    cuts = [i * len(text) // n for i in range(n + 1)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(pattern_bits: dict[str, int], m: int, text: str, budget: int) -> tuple[int, int] | None:
    """(least distance, first end) of the pattern in any stretch of ``text``,
    None if it is beyond the budget."""
    mask, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = mask, 0, m
    best: tuple[int, int] | None = None
    for j, c in enumerate(text, 1):
        eq = pattern_bits.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & mask
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph = (ph << 1) & mask              # row 0 stays 0: a match may start anywhere
        mh = (mh << 1) & mask
        pv = mh | ~(xv | ph) & mask
        mv = ph & xv
        if score <= budget and (best is None or score < best[0]):
            best = (score, j)
    return best


class Matcher:
    """Automaton and patterns of one block of test items."""

    def __init__(self, items: list[tuple[int, str]], rate: float = BUDGET):
        import ahocorasick

        self.items = []
        where: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            text = plain(text)
            if not text:
                continue
            budget = int(len(text) * rate)
            bits: dict[str, int] = {}
            for i, c in enumerate(text):
                bits[c] = bits.get(c, 0) | 1 << i
            grams = [text[i:i + _GRAM] for i in range(len(text) - _GRAM + 1)]
            for at, piece in pieces_of(text, budget):
                where.setdefault(piece, []).append((len(self.items), at))
            self.items.append((item_id, len(text), budget, bits, grams))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        if where:
            self.automaton.make_automaton()

    def find(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item_id, distance, end in the plain text) of the items in a text."""
        text = plain(text)
        if not text or not self.items:
            return []
        spans: dict[int, list[list[int]]] = {}
        for end, (size, places) in self.automaton.iter(text):
            for k, at in places:
                _, m, budget, _, _ = self.items[k]
                start = end + 1 - size - at
                lo, hi = max(0, start - budget), min(len(text), start + m + budget)
                own = spans.setdefault(k, [])
                if own and own[-1][0] <= lo <= own[-1][1]:      # pieces of one candidate
                    own[-1][1] = max(own[-1][1], hi)
                else:
                    own.append([lo, hi])
        out = []
        for k, windows in spans.items():
            item_id, m, budget, bits, grams = self.items[k]
            best = None
            for lo, hi in windows:
                window = text[lo:hi]
                have = {window[i:i + _GRAM] for i in range(len(window) - _GRAM + 1)}
                if sum(g not in have for g in grams) > _GRAM * budget:
                    continue
                found = myers(bits, m, window, budget)
                if found and (best is None or (found[0], lo + found[1]) < best):
                    best = (found[0], lo + found[1])
            if best:
                out.append((item_id, *best))
        return out


_MATCHERS: dict[str, Matcher] = {}


def _matcher(key: str, items: list[tuple[int, str]], rate: float) -> Matcher:
    if key not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[key] = Matcher(items, rate)
    return _MATCHERS[key]


_FOUND = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int32()),
                    ("ends_at", pa.int64())])


def _blocks(items: DataFrame, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    rows = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")) \
        .where("text is not null")
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // block_chars)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(n, 1)))
    for b in range(n):
        # about block_chars characters of the query set
        yield [(r["item_id"], r["text"]) for r in rows.where(block == b).collect()]


def matches(docs: DataFrame, items: DataFrame, rate: float = BUDGET,
            block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, distance, ends_at of each item found in a document."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = rows.where("false").selectExpr("doc_id", "0L as item_id", "0 as distance",
                                           "0L as ends_at")
    for block in _blocks(items, block_chars):
        found = found.unionByName(_scan(rows, block, rate))
    return found


def _scan(rows: DataFrame, block: list[tuple[int, str]], rate: float) -> DataFrame:
    sent, name = rows.sparkSession.sparkContext.broadcast(block), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(name, sent.value, rate)
        for batch in batches:
            out = [(doc_id, *hit)
                   for doc_id, text in zip(batch.column("doc_id").to_pylist(),
                                           (t.as_py() for t in batch.column("text")))
                   for hit in matcher.find(text)]
            yield pa.RecordBatch.from_pylist([dict(zip(_FOUND.names, r)) for r in out], _FOUND)

    return in_arrow(rows, run, "doc_id long, item_id long, distance int, ends_at long")


def clean(docs: DataFrame, items: DataFrame, rate: float = BUDGET,
          block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents, all columns, that no test item was found in. Each row is
    judged by its own text, so no join is needed."""
    schema = docs.schema
    for block in _blocks(items, block_chars):
        docs = _drop(docs, block, rate)
    return docs.select(*[F.col(f"`{c}`") for c in schema.names])


def _drop(docs: DataFrame, block: list[tuple[int, str]], rate: float) -> DataFrame:
    sent, name = docs.sparkSession.sparkContext.broadcast(block), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(name, sent.value, rate)
        for batch in batches:
            yield batch.filter(pa.array([not matcher.find(t.as_py())
                                         for t in batch.column("text")], pa.bool_()))

    return in_arrow(docs, run, docs.schema)
