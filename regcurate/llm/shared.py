"""Helpers shared by the training-data operators: staged tables in the
session's shared folder, size-checked broadcasts, and numpy text primitives
over Arrow string buffers."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regcurate.session import _context, ensure_checkpoint_dir, ship_package
from regcurate.sources.fs import delete_on_exit

#: Sides of at most this many bytes (estimated from a real row count) are
#: broadcast; larger ones go through a shuffled join.
BROADCAST_BYTES = 32 << 20

#: Bytes of an Arrow batch where the session has Spark's own 64 MiB: a batch is
#: held by the JVM and by its Python worker, several times over while it is copied.
ARROW_BATCH, _SPARKS_BATCH = "8m", "67108864b"

#: A staged table is written in at most this many files per core of the cluster.
FILES_PER_CORE = 4


# --- staged tables ----------------------------------------------------------

def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder the session names."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, merge: bool = True) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back:
    lineage is cut there, and a lost executor costs only a re-read. More
    partitions than a few rounds of tasks are written one after the other by
    the same tasks, so that many small partitions are not as many small files
    (not with ``merge`` off: for tasks that know themselves by their number). The
    table is deleted when the application ends."""
    spark = df.sparkSession
    path, context = scratch_path(spark, name), _context(spark)
    if merge and context is not None:
        df = df.coalesce(FILES_PER_CORE * context.defaultParallelism)
    df.write.parquet(path)
    if context is not None:
        delete_on_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, row_bytes: int, rows: int | None = None) -> DataFrame:
    """``df`` marked for broadcast if its counted rows times ``row_bytes`` stay
    under BROADCAST_BYTES; otherwise unchanged, so that the join is shuffled.
    Only for staged (cheap to count) sides."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n * row_bytes <= BROADCAST_BYTES else df


def sha256_key(text: Column | str) -> Column:
    """128 bits of the text's SHA-256 as 32 hex digits; NULL counts as ''."""
    col = F.col(text) if isinstance(text, str) else text
    return F.substring(F.sha2(F.coalesce(col, F.lit("")).cast("binary"), 256), 1, 32)


# --- Python tasks -----------------------------------------------------------

def give_back() -> None:
    """Return freed memory to the system. Arrow's pool and the C heap would keep
    it for as long as the worker lives, next to the tasks of later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc has it
    if trim is not None:
        trim(0)


def in_arrow(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with this package at hand in the workers, which take
    batches of bounded size and give freed memory back when a task ends."""
    ship_package(df.sparkSession)
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(key, None) == _SPARKS_BATCH:
        conf.set(key, ARROW_BATCH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def per_group(df: DataFrame, keys: Sequence[str], fn: Callable, schema) -> DataFrame:
    """``fn(pa.Table) -> pa.Table`` for all rows of each key, likewise."""
    ship_package(df.sparkSession)
    return df.groupBy(*keys).applyInArrow(fn, schema)


# --- Arrow ------------------------------------------------------------------

def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column as numpy views; NULL counts as ''."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if not n or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[
        column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def by_bytes(batches: Iterable[pa.RecordBatch], column: str, limit: int = 1 << 20,
             rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with about ``limit`` text bytes, so that
    working arrays stay small whatever the batch size (a longer single text is
    a run of its own)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        _, off = utf8(batch.column(column))
        at = 0
        while at < n:
            end = int(np.searchsorted(off, off[at] + limit, side="right")) - 1
            end = min(max(end, at + 1), n, at + rows)
            yield batch.slice(at, end - at)
            at = end


# --- hashing (wrap-around 64-bit arithmetic) ----------------------------------

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15                       # odd, hence invertible mod 2**64


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser (public SplitMix64 constants)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.empty(size, np.uint64)
        have[0] = 1
        done = 1
        while done < size:                        # doubling: p[d:2d] = p[:d] * base**d
            step = np.uint64(pow(base, done, 1 << 64))
            k = min(done, size - done)
            have[done:done + k] = have[:k] * step
            done += k
        _POWERS[base] = have
    return have[:n]


def prefix_hash(raw: np.ndarray, base: int = _BASE) -> np.ndarray:
    """H with H[j] - H[i] determined by raw[i:j] up to the factor base**i; the
    base must be odd."""
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(base, len(raw)), out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray,
               base: int = _BASE) -> np.ndarray:
    """64-bit hash of each byte range [start, end): equal for equal bytes,
    wherever they stand; the length is mixed in."""
    inv = _powers(pow(base, -1, 1 << 64), len(prefix))
    body = (prefix[end] - prefix[start]) * inv[start]
    return mix64(body + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def word_spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first) of the words ``[^\\x20\\x09-\\x0D]+`` of all texts
    of a batch; the words of text d are first[d]:first[d + 1]."""
    inside = ~_SPACE[raw]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    edge = off[1:-1]                              # a text's edge ends a word
    edge = edge[(edge > 0) & (edge < len(raw))]
    begins[edge] |= inside[edge]
    stops[edge - 1] |= inside[edge - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(raw: np.ndarray, off: np.ndarray, lower: bool = True
                ) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first): A-Z lower-cased if asked."""
    if lower:
        raw = _LOWER[raw]
    starts, ends, first = word_spans(raw, off)
    return range_hash(prefix_hash(raw), starts, ends), first


_STEP = np.array([pow(0xA0761D6478BD642F, k + 1, 1 << 64) for k in range(8)], np.uint64)


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words (the caller drops runs across texts)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        total += words[k:len(words) - n + 1 + k] * _STEP[k]
    return mix64(total + np.uint64(n))


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values (a plain sort beats np.unique on short arrays)."""
    values = np.sort(values)
    keep = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    return values[keep]


def shingle_sets(raw: np.ndarray, off: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """Per text its sorted distinct shingle hashes: ``size``-word windows of the
    lower-cased words, the whole sequence where there are fewer words, none
    without words."""
    words, first = word_hashes(raw, off)
    grams = ngram_hashes(words, size)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= size:
            out.append(distinct(grams[a:b - size + 1]))
        elif b > a:
            out.append(ngram_hashes(words[a:b], int(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
