"""Suffix-array dedup: every byte covered by a ``WINDOW``-byte string that also
starts anywhere else, found by bucket-pointer refinement.

The suffixes that can matter are narrowed down first. In each window the
``GRAM``-byte string with the least hash is its anchor; equal windows have equal
anchors at equal offsets, so only windows around an anchor that occurs twice can
repeat. The initial buckets are the anchors' strings:

1. Anchors (about 2 / (WINDOW - GRAM + 2) of all bytes) are dealt by their hash
   as packed arrays, with a hash of their context: the bytes any window around
   them can hold. Two equal contexts settle all their windows at once. A task
   settles equal contexts it sees itself and passes on one of them, so groups of
   copies do not travel.
2. Where one anchor string has different contexts, one of each is fetched from
   its document, and the suffixes in them are refined: buckets of Q-byte strings
   first, then by sorting on (own bucket, bucket of a later offset), which
   doubles the length each time up to WINDOW; suffixes alone in their bucket
   drop out, and with them every suffix that points at them.
3. An anchor string with more than ``CONTEXTS`` different contexts is split: its
   windows themselves are dealt by their 128-bit identity instead. Anchors that
   a sample shows to be hotter still are dealt by context from the start.
4. Each document meets its spans in one join by content key.

Texts are UTF-8 bytes, NULL counts as empty; no window crosses a document.
Documents are known by 88 bits of their SHA-256, so rows with equal text share
their spans and repeated or NULL doc_ids do no harm; anchors, contexts and the
first buckets are 64-bit hashes. Texts shorter than a window stay whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regcurate.llm.shared import (by_bytes, in_arrow, mix64, per_group, prefix_hash, range_hash,
                                  staged, utf8)

WINDOW, GRAM = 200, 80
#: Length of the strings in the first buckets of the refinement.
Q = 50
#: Bytes of a window before its anchor, at most.
REACH = WINDOW - GRAM
#: Records per bucket of step 1, contexts per bucket of step 2.
BUCKET_ROWS, BUCKET_CONTEXTS = 250_000, 4_000
#: Different contexts from which an anchor string is split into windows.
CONTEXTS = 4_000
#: One text in SAMPLE looks for hot anchors; hot from HOT occurrences in all.
SAMPLE, HOT, HOT_MOST = 64, 2_000_000, 4096

_RECORD = np.dtype([("id1", "<u8"), ("id2", "<u8"), ("k1", "<i8"), ("k2", "<i4"), ("at", "<i4"),
                    ("before", "u1"), ("after", "u1"), ("settled", "u1")])
_SPAN = np.dtype([("k1", "<i8"), ("k2", "<i4"), ("lo", "<i4"), ("hi", "<i4")])


def content_key(text: bytes) -> tuple[int, int]:
    digest = hashlib.sha256(text).hexdigest()
    return int(digest[:15], 16), int(digest[15:22], 16)


def key_columns(text: Column) -> list[Column]:
    """The content key as columns k1, k2."""
    digest = F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1, 15), 16, 10).cast("long").alias("k1"),
            F.conv(F.substring(digest, 16, 7), 16, 10).cast("int").alias("k2")]


# --- 1 anchors ------------------------------------------------------------------

def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """best (np.minimum or np.maximum) over each run of ``width`` values."""
    step = 1
    while 2 * step <= width:
        values = best(values[:-step], values[step:])
        step *= 2
    rest = width - step
    return best(values[:len(values) - rest], values[rest:]) if rest else values


def anchors(grams: np.ndarray) -> np.ndarray:
    """Positions whose gram hash is the least of some window."""
    least = _sliding(grams, REACH + 1, np.minimum)
    pad = np.zeros(REACH, np.uint64)
    return np.flatnonzero(_sliding(np.concatenate([pad, least, pad]), REACH + 1,
                                   np.maximum) == grams)


def _text_anchors(raw: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(text, its records) for the texts of at least one window."""
    prefix = prefix_hash(raw)
    if len(raw) < WINDOW:
        return
    starts = np.arange(len(raw) - GRAM + 1)
    grams = range_hash(prefix, starts, starts + GRAM)
    for d, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
        if b - a < WINDOW:
            continue
        at = anchors(grams[a:b - GRAM + 1])
        lo, hi = np.maximum(at - REACH, 0), np.minimum(at + WINDOW, b - a)
        out = np.zeros(len(at), _RECORD)
        out["id1"], out["at"] = grams[a + at], at
        out["id2"] = range_hash(prefix, a + lo, a + hi) ^ mix64(
            ((at - lo) * 256 + hi - at).astype(np.uint64))
        out["before"], out["after"] = at - lo, hi - at
        out["k1"], out["k2"] = content_key(raw[a:b].tobytes())
        yield d, out


def _runs(data: np.ndarray, *fields: str) -> tuple[np.ndarray, np.ndarray]:
    """(first index, length) of each run of equal fields in sorted data."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.zeros(len(data) - 1, bool)
    for f in fields:
        new |= data[f][1:] != data[f][:-1]
    first = np.flatnonzero(np.append(True, new))
    return first, np.diff(np.append(first, len(data)))


def _spans_of(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data), _SPAN)
    out["k1"], out["k2"] = data["k1"], data["k2"]
    out["lo"], out["hi"] = data["at"] - data["before"], data["at"] + data["after"].astype(np.int64)
    out = out[np.lexsort((out["lo"], out["k2"], out["k1"]))]
    return out[_runs(out, "k1", "k2", "lo", "hi")[0]]


def collapse(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(records to pass on, settled spans): of records with equal identities
    all are settled and one, marked so, goes on."""
    data = data[np.lexsort((data["id2"], data["id1"]))]
    first, size = _runs(data, "id1", "id2")
    known = np.logical_or.reduceat(data["settled"] > 0, first) if len(first) else first > 0
    twice = (size > 1) | known
    spans = _spans_of(data[np.repeat(twice, size) & (data["settled"] == 0)])
    out = data[first].copy()
    out["settled"] = twice
    return out, spans


_PACKED = "bucket long, spans boolean, data binary"


def _pack(records: np.ndarray, spans: np.ndarray, keys: np.ndarray,
          buckets: int) -> pa.RecordBatch:
    """One row per bucket with its records, and one with the settled spans."""
    key = keys % np.uint64(buckets)
    order = np.argsort(key, kind="stable")
    key, records = key[order], records[order]
    ends = (np.flatnonzero(np.append(key[1:] != key[:-1], True)) + 1).tolist() if len(key) else []
    rows = [(int(key[b - 1]), False, records[a:b].tobytes()) for a, b in zip([0, *ends], ends)]
    if len(spans):
        rows.append((int(spans["k1"][0]) % buckets, True, spans.tobytes()))
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.bool_()),
         pa.array([r[2] for r in rows], pa.binary())], names=["bucket", "spans", "data"])


def _unpack(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(records, spans) of one bucket."""
    records, spans = [np.empty(0, _RECORD)], [np.empty(0, _SPAN)]
    for is_span, data in zip(table["spans"].to_pylist(), table["data"].to_pylist()):
        (spans if is_span else records).append(
            np.frombuffer(data, _SPAN if is_span else _RECORD))
    return np.concatenate(records), np.concatenate(spans)


#: kind 0: settled span lo to hi; 1: context to refine; 2: context that only
#: others are compared with; 3: context to split into windows.
_FOUND = "k1 long, k2 int, at int, lo int, hi int, kind int, gram long"
_FOUND_SCHEMA = pa.schema([("k1", pa.int64()), ("k2", pa.int32()), ("at", pa.int32()),
                           ("lo", pa.int32()), ("hi", pa.int32()), ("kind", pa.int32()),
                           ("gram", pa.int64())])


def _found(spans: np.ndarray, asked: np.ndarray | None = None,
           kinds: np.ndarray | None = None) -> pa.Table:
    if asked is None:
        asked, kinds = np.empty(0, _RECORD), np.empty(0, np.int32)
    own, none = _spans_of_all(asked), np.zeros(len(spans), np.int64)
    return pa.table([
        pa.array(np.concatenate([spans["k1"], asked["k1"]])),
        pa.array(np.concatenate([spans["k2"], asked["k2"]])),
        pa.array(np.concatenate([spans["lo"], asked["at"]])),
        pa.array(np.concatenate([spans["lo"], own["lo"]])),
        pa.array(np.concatenate([spans["hi"], own["hi"]])),
        pa.array(np.concatenate([none, kinds]).astype(np.int32)),
        pa.array(np.concatenate([none, asked["id1"].astype(np.int64)]))], schema=_FOUND_SCHEMA)


def _spans_of_all(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data), _SPAN)
    out["lo"], out["hi"] = data["at"] - data["before"], data["at"] + data["after"].astype(np.int64)
    return out


def _settle(contexts: int, hot: np.ndarray):
    """Step 1 in one bucket of anchors."""
    def run(table: pa.Table) -> pa.Table:
        data, spans = _unpack(table)
        data, more = collapse(data)               # one record per context from here on
        first, size = _runs(data, "id1")
        split = (size > contexts) | np.isin(data["id1"][first], hot)
        per = np.repeat(size, size)
        kinds = np.where(np.repeat(split, size), 3, np.where(data["settled"] > 0, 2, 1))
        ask = (per > 1) | np.repeat(split, size)
        return _found(np.concatenate([spans, more]), data[ask], kinds[ask])
    return run


def _hot_anchors(rows: DataFrame, hot: int, sample: int) -> np.ndarray:
    """Anchor hashes that occur about ``hot`` times or more, by a sample of
    texts; at most HOT_MOST of them. They only steer how anchors are dealt."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            parts = [r["id1"] for _, r in _text_anchors(*utf8(batch.column("text")))]
            grams = np.concatenate([np.empty(0, np.uint64), *parts]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(grams)], names=["gram"])

    some = rows.select("text").where(F.rand(7) < 1 / sample)
    top = in_arrow(some, run, "gram long").groupBy("gram").count() \
        .where(F.col("count") >= max(2, hot // sample)) \
        .orderBy(F.desc("count"), "gram").limit(HOT_MOST).collect()
    return np.array([r["gram"] for r in top], np.int64).astype(np.uint64)


def _anchor_rows(rows: DataFrame, buckets: int, hot: np.ndarray) -> DataFrame:
    def flush(parts: list[np.ndarray]) -> pa.RecordBatch:
        records, spans = collapse(np.concatenate(parts))
        key = mix64(records["id1"])
        far = np.isin(records["id1"], hot)
        key[far] = mix64(key[far] ^ records["id2"][far])
        return _pack(records, spans, key, buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in by_bytes(batches, "text"):
            for _, records in _text_anchors(*utf8(batch.column("text"))):
                parts.append(records)
                held += len(records)
            if held > BUCKET_ROWS:
                yield flush(parts)
                parts, held = [], 0
        if parts:
            yield flush(parts)

    return in_arrow(rows.select("text"), run, _PACKED)


# --- 2 refinement ----------------------------------------------------------------

def _rank(keys: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Bucket of each position from its key; -1 where it is alone or absent."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.append(True, ordered[1:] != ordered[:-1]) if len(keys) else np.zeros(0, bool)
    bucket = np.cumsum(new)
    alone = new & np.append(new[1:], True) if len(keys) else new
    out = np.full(n, -1, np.int64)
    out[at[order[~alone]]] = bucket[~alone]
    return out


def repeated_windows(text: np.ndarray, ends: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Bucket of every position of ``text`` that starts a ``window``-byte string
    which occurs at another position too; -1 elsewhere. ``ends`` gives for each
    position where its stretch ends."""
    n, length = len(text), min(Q, window)
    at = np.flatnonzero(np.arange(n) + length <= ends)
    rank = _rank(range_hash(prefix_hash(text), at, at + length), at, n)
    while length < window:
        step = min(length, window - length)       # the last step overlaps
        at = np.flatnonzero(rank >= 0)
        at = at[at + step + length <= ends[at]]
        at = at[rank[at + step] >= 0]             # points at a bucket of two or more
        rank = _rank((rank[at] << np.int64(32)) | rank[at + step], at, n)
        length += step
    return rank


_CONTEXT = np.dtype([("k1", "<i8"), ("k2", "<i4"), ("lo", "<i4"), ("size", "<i4"), ("kind", "<i4")])


def _refine(table: pa.Table) -> pa.Table:
    """Step 2 in one bucket: spans of the repeated windows in its contexts."""
    heads = np.concatenate([np.frombuffer(h, _CONTEXT) for h in table["head"].to_pylist()])
    text = np.frombuffer(b"".join(table["body"].to_pylist()), np.uint8)
    size = heads["size"].astype(np.int64)
    begin = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(heads)), size)
    rank = repeated_windows(text, np.repeat(begin + size, size))
    at = np.flatnonzero(rank >= 0)
    # contexts of one document overlap: a window must stand at two places
    order = np.lexsort((heads["k2"], heads["k1"]))
    first, size_ = _runs(heads[order], "k1", "k2")
    doc = np.empty(len(heads), np.int64)
    doc[order] = np.repeat(np.arange(len(first)), size_)
    place = (doc[owner[at]] << np.int64(32)) | (heads["lo"][owner[at]] + at - begin[owner[at]])
    bucket = rank[at]
    order = np.lexsort((place, bucket))
    bucket_, place_ = bucket[order], place[order]
    new = np.append(True, (bucket_[1:] != bucket_[:-1]) | (place_[1:] != place_[:-1])) \
        if len(at) else np.zeros(0, bool)
    places = np.bincount(bucket_[new], minlength=1)
    hit = at[(places[bucket] > 1) & (heads["kind"][owner[at]] == 1)]
    who, start = owner[hit], hit - begin[owner[hit]]
    first = np.flatnonzero(np.append(True, who[1:] != who[:-1])) if len(who) else who
    spans = np.zeros(len(first), _SPAN)
    got = heads[who[first]]
    spans["k1"], spans["k2"] = got["k1"], got["k2"]
    if len(first):                                # windows around one anchor overlap
        spans["lo"] = got["lo"] + np.minimum.reduceat(start, first)
        spans["hi"] = got["lo"] + np.maximum.reduceat(start, first) + WINDOW
    return _found(spans)


def _wanted(rows: DataFrame, asked: DataFrame) -> DataFrame:
    """text with the contexts asked of it, for texts that have any."""
    lists = staged(asked.groupBy("k1", "k2").agg(
        F.collect_list(F.struct("at", "lo", "hi", "kind", "gram")).alias("asked")),
        "repeats-asked")
    return rows.select(*key_columns(F.col("text")), "text").join(lists, ["k1", "k2"]) \
        .select("k1", "k2", "text", "asked")


def _each_text(batch: pa.RecordBatch, seen: set) -> Iterator[tuple[int, int, int, dict]]:
    """(row, k1, k2, contexts asked as arrays) of texts not met before."""
    asked = batch.column("asked")
    flat, off = asked.flatten(), asked.offsets.to_numpy()
    off = off - off[0]
    fields = {f: flat.field(f).to_numpy(zero_copy_only=False) for f in
              ("at", "lo", "hi", "kind", "gram")}
    for d, key in enumerate(zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist())):
        if key not in seen:
            seen.add(key)
            yield d, *key, {f: v[off[d]:off[d + 1]] for f, v in fields.items()}


def _context_rows(wanted: DataFrame, buckets: int) -> DataFrame:
    """Contexts to refine, dealt by anchor string."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in by_bytes(batches, "text"):
            raw, off = utf8(batch.column("text"))
            heads: dict[int, list] = {}
            for d, k1, k2, ask in _each_text(batch, seen):
                keys = mix64(ask["gram"].astype(np.uint64)) % np.uint64(buckets)
                for b, lo, hi, kind in zip(keys.tolist(), ask["lo"].tolist(), ask["hi"].tolist(),
                                           ask["kind"].tolist()):
                    if kind != 3:
                        a = int(off[d])
                        heads.setdefault(b, []).append(
                            ((k1, k2, lo, hi - lo, kind), raw[a + lo:a + hi].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(heads), pa.int64()),
                 pa.array([np.array([h for h, _ in v], _CONTEXT).tobytes()
                           for v in heads.values()], pa.binary()),
                 pa.array([b"".join(t for _, t in v) for v in heads.values()], pa.binary())],
                names=["bucket", "head", "body"])

    return in_arrow(wanted, run, "bucket long, head binary, body binary")


# --- 3 split anchors --------------------------------------------------------------

_OTHER = 0xC2B2AE3D27D4EB4F                       # base of the second window hash


def _window_rows(wanted: DataFrame, buckets: int) -> DataFrame:
    """Windows of the contexts to split, dealt by identity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        parts, held = [], 0
        for batch in by_bytes(batches, "text"):
            raw, off = utf8(batch.column("text"))
            one, two = prefix_hash(raw), prefix_hash(raw ^ np.uint8(0x5A), _OTHER)
            for d, k1, k2, ask in _each_text(batch, seen):
                split = ask["kind"] == 3
                marks = np.zeros(int(off[d + 1] - off[d]) + 1, np.int64)
                np.add.at(marks, ask["lo"][split], 1)
                np.add.at(marks, ask["hi"][split] - WINDOW + 1, -1)
                at = np.flatnonzero(np.cumsum(marks) > 0)      # each window once
                out = np.zeros(len(at), _RECORD)
                begin = off[d] + at
                out["id1"] = range_hash(one, begin, begin + WINDOW)
                out["id2"] = range_hash(two, begin, begin + WINDOW, _OTHER)
                out["k1"], out["k2"], out["at"], out["after"] = k1, k2, at, WINDOW
                parts.append(out)
                held += len(out)
            if held > BUCKET_ROWS:
                yield flush(parts)
                parts, held = [], 0
        if parts:
            yield flush(parts)

    def flush(parts: list[np.ndarray]) -> pa.RecordBatch:
        records, spans = collapse(np.concatenate(parts))
        return _pack(records, spans, mix64(records["id1"]), buckets)

    return in_arrow(wanted, run, _PACKED)


def _settle_windows(table: pa.Table) -> pa.Table:
    data, spans = _unpack(table)
    _, more = collapse(data)
    return _found(np.concatenate([spans, more]))


# --- spans per document ------------------------------------------------------------

def spans(docs: DataFrame, contexts: int = CONTEXTS, hot: int = HOT,
          sample: int = SAMPLE) -> DataFrame:
    """k1, k2 and the spans (array of lo, hi; they may overlap) of every distinct
    text with repeated windows; staged."""
    rows = docs.select(F.col("text").cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    records = 2 * total // (REACH + 2)
    hottest = _hot_anchors(rows, hot, sample) if records >= hot else np.zeros(0, np.uint64)
    found = staged(per_group(
        _anchor_rows(rows, max(8, -(-records // BUCKET_ROWS)), hottest), ["bucket"],
        _settle(contexts, hottest), _FOUND), "repeats-found")

    kinds = {r["kind"]: r["count"] for r in found.groupBy("kind").count().collect()}
    parts = [found.where("kind = 0")]
    if any(kinds.get(k) for k in (1, 2)):
        n = kinds.get(1, 0) + kinds.get(2, 0)
        wanted = _wanted(rows, found.where("kind in (1, 2)"))
        parts.append(staged(per_group(
            _context_rows(wanted, max(8, -(-n // BUCKET_CONTEXTS))), ["bucket"], _refine, _FOUND),
            "repeats-refined"))
    if kinds.get(3):
        wanted = _wanted(rows, found.where("kind = 3"))
        buckets = max(8, -(-kinds[3] * (REACH + 1) // BUCKET_ROWS))
        parts.append(staged(per_group(_window_rows(wanted, buckets), ["bucket"],
                                      _settle_windows, _FOUND), "repeats-windows"))
    all_ = parts[0].select("k1", "k2", "lo", "hi")
    for p in parts[1:]:
        all_ = all_.union(p.select("k1", "k2", "lo", "hi"))
    return staged(all_.distinct().groupBy("k1", "k2").agg(
        F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("spans")), "repeats-spans")


def merged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by spans sorted by ``lo``."""
    if not len(lo):
        return lo, hi
    reach = np.maximum.accumulate(hi)
    new = np.append(True, lo[1:] > reach[:-1])
    return lo[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(lo) - 1)]


def with_spans(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Column ``row`` (all columns of ``docs``), text and spans of every row."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("text").cast("string").alias("text"))
    return rows.select("row", "text", *key_columns(F.col("text"))) \
        .join(found, ["k1", "k2"], "left").select("row", "text", "spans")


def _batch_runs(batch: pa.RecordBatch) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """(text bytes, run starts, run ends) of every row."""
    raw, off = utf8(batch.column("text"))
    spans_, none = batch.column("spans"), np.zeros(0, np.int64)
    for d, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
        own = spans_[d]
        if own.is_valid:
            lo, hi = (own.values.field(f).to_numpy().astype(np.int64) for f in ("lo", "hi"))
            yield raw[a:b].tobytes(), *merged(lo, hi)
        else:
            yield raw[a:b].tobytes(), none, none


def _kept(text: bytes, lo: np.ndarray, hi: np.ndarray) -> bytes:
    if not len(lo):
        return text
    edges = [0, *np.stack([lo, hi], 1).ravel().tolist(), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def digests(docs: DataFrame, **parameters) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            out = [(len(t), int((hi - lo).sum()), len(lo),
                    hashlib.sha256(_kept(t, lo, hi)).hexdigest())
                   for t, lo, hi in _batch_runs(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array([o[k] for o in out], kind) for k, kind in
                                           enumerate((pa.int64(), pa.int64(), pa.int64(),
                                                      pa.string())))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    joined = with_spans(rows, spans(rows, **parameters)).select("row.doc_id", "text", "spans")
    return in_arrow(joined, run, "doc_id long, n_bytes long, n_removed long, n_spans long, "
                                 "kept_sha256 string")


def remove_repeats(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text``. A character that
    loses part of its bytes goes as a whole, so texts stay UTF-8. NULL stays
    NULL."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            texts = [None if not valid.as_py() else
                     _kept(t, lo, hi).decode("utf-8", "ignore")
                     for valid, (t, lo, hi) in zip(batch.column("text").is_valid(),
                                                   _batch_runs(batch))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"])

    joined = with_spans(docs, spans(docs, **parameters))
    kind = joined.schema["row"].dataType.simpleString()
    new = in_arrow(joined, run, f"row {kind}, text string")
    return new.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c)
                        for c in docs.columns])
