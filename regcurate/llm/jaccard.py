"""N-gram Jaccard join with adaptive multi-match prefixes.

Two documents link if the Jaccard similarity of their sets of word shingles
reaches ``percent`` / 100. Under one global order of shingles, two such sets
share at least l shingles among their first n - ceil(t n) + l ones each, for any
l (Wang, Li and Feng, 2012). Each document chooses its own l: a longer prefix
costs more postings, but asks for more shared ones before a pair is verified. A
pair is a candidate if it shares as many prefix shingles as the smaller l of the
two asks for; since prefixes only grow with l, no link is lost.

Steps, all over the whole table:

1. A count sketch of fixed size over all shingles gives the order (rare first)
   and the cost estimate; a minimum-values sketch gives the distinct shingles.
2. Documents with equal sets form classes, each with its least doc_id.
3. Prefix postings of one document per class are dealt by shingle as packed
   arrays. A posting stays if the shingle is in another document of near size,
   and both have as many postings left as that pair must share. Dealt by document,
   the postings left are counted, and so on, PASSES times. Shingles the sketch
   calls hot are dealt by shingle and document and kept as they are.
4. Star rounds: for every shingle, one document of each component meets the one
   whose shingles are the most common -- the original among its edited copies;
   verified links merge components. Large groups of near copies thus collapse
   with few pairs, because only connection matters.
5. All candidate pairs that still lie in two components are verified.

What a pair must share follows from both prefixes: all shingles up to the earlier
prefix end are compared, so an overlap of o needs o less what lies behind it.

Shingles are 64-bit hashes: a wrong link needs two different shingles of one
pair of documents to collide. Documents are identified by doc_id: rows that share
one are versions of one document and linked. Defined results: a text without
words, or NULL, has no shingles and stays alone; a row with a NULL doc_id stays
alone with a NULL component; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regcurate.llm.components import components
from regcurate.llm.shared import (by_bytes, in_arrow, mix64, per_group, shingle_sets,
                                  small_side, staged, utf8)

PERCENT, WORDS = 80, 5
#: Counters of the frequency sketch, and slices in which it is summed up.
COUNTERS, SLICES = 1 << 20, 64
#: Values of the minimum-values sketch.
LEAST = 4096
#: Cost of a posting and of verifying a candidate per shingle, in one unit.
POSTING, VERIFYING = 8.0, 1.0
#: Postings a bucket should hold, and the frequency from which a shingle is
#: dealt out over several buckets.
BUCKET_ROWS, HOT = 250_000, 200_000
#: Star rounds at most; what they leave goes to the last step.
ROUNDS = 4


# --- 1 sketches ----------------------------------------------------------------

def _merge_least(parts: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate(parts))[:LEAST]


def _sum_slices(table: pa.Table) -> pa.Table:
    slice_ = table["slice"][0].as_py()
    parts = [np.frombuffer(b.as_py(), "<u8") for b in table["data"]]
    data = _merge_least(parts) if slice_ < 0 else np.sum(parts, axis=0, dtype=np.uint64)
    return pa.table({"slice": pa.array([slice_], pa.int32()),
                     "part": pa.array([table["part"][0].as_py() // 64], pa.int32()),
                     "data": pa.array([data.astype("<u8").tobytes()], pa.binary())})


class Frequencies:
    """Estimated document frequency of shingles."""

    def __init__(self, counters: np.ndarray, least: np.ndarray):
        self.counters = np.minimum(counters, 0xFFFFFFFF).astype(np.uint32)
        self.total = int(counters.sum())
        self.distinct = len(least) if len(least) < LEAST else \
            int((LEAST - 1) / (float(least[-1]) / 2.0 ** 64))
        mean = self.distinct / COUNTERS
        #: what a counter may hold without any frequent shingle
        self.noise = mean + 4 * math.sqrt(mean) + 1
        #: other documents per shingle, on average
        self.spread = max(0.0, self.total / max(1, self.distinct) - 1)

    def of(self, grams: np.ndarray) -> np.ndarray:
        return self.counters[(grams & np.uint64(COUNTERS - 1)).astype(np.int64)]


def frequencies(docs: DataFrame, words: int = WORDS) -> Frequencies:
    """Sketches over the shingles of all documents; the result has a fixed size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        counts, least = np.zeros(COUNTERS, np.int64), np.zeros(0, np.uint64)
        for batch in by_bytes(batches, "text"):
            grams = np.concatenate([np.zeros(0, np.uint64),
                                    *shingle_sets(*utf8(batch.column("text")), words)])
            counts += np.bincount((grams & np.uint64(COUNTERS - 1)).astype(np.int64),
                                  minlength=COUNTERS)
            if len(least) == LEAST:
                grams = grams[grams < least[-1]]
            least = _merge_least([least, grams])
        parts = [*np.split(counts.astype("<u8"), SLICES), least.astype("<u8")]
        slices = [*range(SLICES), -1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(slices, pa.int32()),
             pa.array([TaskContext.get().partitionId() // 64] * len(slices), pa.int32()),
             pa.array([p.tobytes() for p in parts], pa.binary())], names=["slice", "part", "data"])

    schema = "slice int, part int, data binary"
    parts = in_arrow(docs.select(F.col("text").cast("string")), run, schema)
    for keys in (["slice", "part"], ["slice"]):
        parts = per_group(parts, keys, _sum_slices, schema)
    got = {r["slice"]: np.frombuffer(r["data"], "<u8") for r in parts.collect()}
    if not got:
        return Frequencies(np.zeros(COUNTERS, np.uint64), np.zeros(0, np.uint64))
    return Frequencies(np.concatenate([got[k] for k in range(SLICES)]), got[-1])


# --- 2 and 3 classes and postings -------------------------------------------------

def prefix(grams: np.ndarray, freq: Frequencies, percent: int) -> tuple[np.ndarray, int]:
    """(prefix shingles, l) of one document: the l of least estimated cost."""
    n = len(grams)
    seen = freq.of(grams)
    order = np.argsort(seen, kind="stable")       # grams are sorted: (frequency, hash)
    short = n - -(-percent * n // 100)
    choices = np.array([1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256, 512, 1024])
    choices = choices[choices <= max(1, n // 10)]
    others = np.cumsum(np.maximum(seen[order] - freq.noise, 0.0) + freq.spread)
    met = others[short + choices - 1]             # postings of other documents met
    cost = POSTING * choices + met + VERIFYING * n * met / choices
    best = int(choices[np.argmin(cost)])
    return grams[order[:short + best]], best


_SETS = "doc_id long, n int, k1 long, k2 long"


def sets(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n and a 128-bit key of the shingle set, for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            n, k1, k2 = [], [], []
            for grams in shingle_sets(*utf8(batch.column("text")), words):
                a, b = set_key(grams)
                n.append(len(grams))
                k1.append(a)
                k2.append(b)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int32()), pa.array(k1, pa.int64()),
                 pa.array(k2, pa.int64())], names=["doc_id", "n", "k1", "k2"])

    return in_arrow(docs, run, _SETS)


def set_key(grams: np.ndarray) -> tuple[int, int]:
    """Two order-free sums over independently mixed shingles."""
    a = mix64(grams ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    b = mix64(grams + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


_RECORD = np.dtype([("gram", "<u8"), ("doc", "<i8"), ("n", "<i4"), ("l", "<i4"), ("left", "<i4"),
                    ("hot", "u1")])
_PACKED = "bucket long, data binary"


def needed(nx, ny, lx, ly, percent: int):
    """Prefix shingles two documents must share to be similar enough (arrays)."""
    overlap = -(-(nx + ny) * percent // (100 + percent))
    behind = np.maximum(-(-percent * nx // 100) - lx, -(-percent * ny // 100) - ly)
    return np.maximum(np.minimum(lx, ly), overlap - behind)


def _deal(data: np.ndarray, key: np.ndarray, buckets: int) -> pa.RecordBatch:
    """One row per bucket with its records."""
    key = key % np.uint64(buckets)
    order = np.argsort(key, kind="stable")
    key, data = key[order], data[order]
    ends = (np.flatnonzero(np.append(key[1:] != key[:-1], True)) + 1).tolist() if len(key) else []
    return pa.RecordBatch.from_arrays(
        [pa.array([int(key[b - 1]) for b in ends], pa.int64()),
         pa.array([data[a:b].tobytes() for a, b in zip([0, *ends], ends)], pa.binary())],
        names=["bucket", "data"])


def _gram_key(data: np.ndarray) -> np.ndarray:
    """By shingle; hot ones by shingle and document."""
    return mix64(np.where(data["hot"] > 0, data["gram"] ^ mix64(data["doc"].astype(np.uint64)),
                          data["gram"]))


def _unpack(table: pa.Table) -> np.ndarray:
    return np.concatenate([np.frombuffer(b.as_py(), _RECORD) for b in table["data"]])


def _prefix_rows(docs: DataFrame, freq: Frequencies, percent: int, words: int,
                 buckets: int) -> DataFrame:
    """Prefix postings of all documents, dealt by shingle."""
    sent = docs.sparkSession.sparkContext.broadcast(freq)       # fixed size

    def rows(parts: list[np.ndarray]) -> pa.RecordBatch:
        data = np.concatenate(parts)
        data["hot"] = sent.value.of(data["gram"]) >= max(HOT, 8 * sent.value.noise)
        return _deal(data, _gram_key(data), buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in by_bytes(batches, "text"):
            for doc, grams in zip(batch.column("doc_id").to_pylist(),
                                  shingle_sets(*utf8(batch.column("text")), words)):
                if doc is None or not len(grams):
                    continue
                chosen, l_ = prefix(grams, sent.value, percent)
                part = np.zeros(len(chosen), _RECORD)
                part["gram"], part["doc"], part["n"], part["l"] = chosen, doc, len(grams), l_
                part["left"] = len(chosen)
                parts.append(part)
                held += len(part)
            if held > BUCKET_ROWS:
                yield rows(parts)
                parts, held = [], 0
        if parts:
            yield rows(parts)

    return in_arrow(docs, run, _PACKED)


#: Neighbours in size that a posting is compared with before it is kept untested.
NEIGHBOURS = 2048
#: Times the postings are dealt by shingle.
PASSES = 3


def met_postings(data: np.ndarray, percent: int) -> np.ndarray:
    """Postings whose shingle stands in another document of near size, if both
    documents have as many postings left as the pair must share. Hot ones stay."""
    data = data[np.lexsort((data["doc"], data["n"], data["gram"]))]
    first = np.ones(len(data), bool)                # a repeated row says nothing new
    first[1:] = (data["gram"][1:] != data["gram"][:-1]) | (data["n"][1:] != data["n"][:-1]) \
        | (data["doc"][1:] != data["doc"][:-1])
    data = data[first]
    gram, doc = data["gram"].copy(), data["doc"].copy()
    n, l_, left = (data[f].astype(np.int64) for f in ("n", "l", "left"))
    kept = data["hot"] > 0
    live = np.arange(len(data))
    for step in range(1, NEIGHBOURS + 1):
        live = live[live + step < len(data)]
        live = live[gram[live] == gram[live + step]]
        live = live[100 * n[live] >= percent * n[live + step]]
        if not len(live):
            return data[kept]
        two = live[(doc[live] != doc[live + step]) & ~(kept[live] & kept[live + step])]
        other = two + step
        met = np.minimum(left[two], left[other]) >= needed(n[two], n[other], l_[two], l_[other],
                                                           percent)
        kept[two[met]] = True
        kept[other[met]] = True
    kept[live] = True                               # more neighbours than are compared
    kept[live + NEIGHBOURS] = True
    return data[kept]


def _by_gram(percent: int, buckets: int):
    """Step by shingle: what has a partner goes on to its document's bucket."""
    def run(table: pa.Table) -> pa.Table:
        data = met_postings(_unpack(table), percent)
        return pa.Table.from_batches([_deal(data, mix64(data["doc"].astype(np.uint64)), buckets)])
    return run


def _by_document(buckets: int):
    """Step by document: its postings are counted and go back to the shingles'."""
    def run(table: pa.Table) -> pa.Table:
        data = _unpack(table)
        data = data[np.lexsort((data["n"], data["doc"]))]
        new = np.ones(len(data), bool)
        new[1:] = (data["doc"][1:] != data["doc"][:-1]) | (data["n"][1:] != data["n"][:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(data)))
        data["left"] = np.repeat(count, count)
        return pa.Table.from_batches([_deal(data, _gram_key(data), buckets)])
    return run


def _plain(percent: int):
    def run(table: pa.Table) -> pa.Table:
        data = met_postings(_unpack(table), percent)
        return pa.table({"gram": pa.array(data["gram"].astype(np.int64)),
                         "rep": data["doc"].copy(), "n": data["n"].copy(), "l": data["l"].copy()})
    return run


def postings(docs: DataFrame, freq: Frequencies, percent: int, words: int) -> DataFrame:
    """gram, rep, n, l: prefix postings that can still belong to a pair."""
    buckets = max(8, -(-freq.total // (3 * BUCKET_ROWS)))       # prefixes: about a third
    packed = _prefix_rows(docs, freq, percent, words, buckets)
    for _ in range(PASSES - 1):
        packed = per_group(packed, ["bucket"], _by_gram(percent, buckets), _PACKED)
        packed = per_group(packed, ["bucket"], _by_document(buckets), _PACKED)
    return per_group(packed, ["bucket"], _plain(percent), "gram long, rep long, n int, l int")


# --- verification ---------------------------------------------------------------

def _whole_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """doc_id and whole shingle set of the wanted documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"),
                 pa.array([g.astype("<u8").tobytes()
                           for g in shingle_sets(*utf8(batch.column("text")), words)],
                          pa.binary())], names=["doc_id", "grams"])

    found = docs.join(small_side(wanted, 16), "doc_id").select("doc_id", "text")
    return in_arrow(found, run, "doc_id long, grams binary")


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def verified(docs: DataFrame, pairs: DataFrame, percent: int, words: int) -> DataFrame:
    """Those (a, b) of ``pairs`` whose whole sets are similar enough; staged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist()):
                p, q = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                both = common(p, q) if len(p) <= len(q) else common(q, p)
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b")], names=["a", "b"]) \
                .filter(pa.array(keep, pa.bool_()))

    wanted = staged(pairs.selectExpr("a as doc_id").union(pairs.selectExpr("b")).distinct(),
                    "jaccard-wanted")
    whole = staged(_whole_sets(docs, wanted, words), "jaccard-sets")
    joined = pairs.join(whole.selectExpr("doc_id as b", "grams as right"), "b") \
        .join(whole.selectExpr("doc_id as a", "grams as left"), "a")
    return staged(in_arrow(joined, run, "a long, b long").distinct(), "jaccard-links")


# --- 4 and 5 components -----------------------------------------------------------

def _near_in_size(a: str, b: str, percent: int):
    return F.expr(f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})")


def _with_components(rows: DataFrame, merged: DataFrame | None) -> DataFrame:
    """``rows`` (with ``rep``) and the component its class is in by now."""
    if merged is None:
        return rows.withColumn("component", F.col("rep"))
    known = small_side(merged.withColumnRenamed("node", "rep"), 24)
    return rows.join(known, "rep", "left") \
        .withColumn("component", F.coalesce("component", "rep"))


def _open(rows: DataFrame) -> DataFrame:
    """Postings of shingles that stand in two components or more."""
    across = rows.groupBy("gram").agg(F.min("component").alias("lo"),
                                      F.max("component").alias("hi")) \
        .where("lo < hi").select("gram")
    return rows.join(across, "gram", "left_semi")


def _enough(percent: int):
    """Whether the ``met`` shingles of a pair are what it must share."""
    return F.expr(f"""met >= greatest(least(la, lb),
        ceil((na + nb) * {percent} / {100 + percent})
        - greatest(ceil({percent} * na / 100) - la, ceil({percent} * nb / 100) - lb))""")


def _star_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b): for each shingle, the document of every component with the most
    common shingles against the one of all; of a document's centres the one met
    most often."""
    common_ = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("c"))
    weight = rows.join(common_, "gram").groupBy("rep").agg(
        F.sum("c").alias("w"), F.min("n").alias("n"), F.min("l").alias("l"))
    weight = staged(weight, "jaccard-weights")
    heads = rows.join(weight.select("rep", "w"), "rep").groupBy("gram", "component") \
        .agg(F.max(F.struct("w", "rep")).alias("head"))
    centres = heads.groupBy("gram").agg(F.max("head").alias("centre"))
    met = heads.join(centres, "gram").where("head <> centre") \
        .groupBy(F.col("centre.rep").alias("a"), F.col("head.rep").alias("b")) \
        .agg(F.count(F.lit(1)).alias("met"))
    sizes = weight
    near = met.join(sizes.selectExpr("rep as a", "n as na", "l as la"), "a") \
        .join(sizes.selectExpr("rep as b", "n as nb", "l as lb"), "b") \
        .where(_near_in_size("na", "nb", percent) & _enough(percent))
    return near.groupBy("b").agg(F.max_by("a", F.struct("met", -F.col("a"))).alias("a")) \
        .select("a", "b")


def _units(rows: DataFrame, percent: int) -> DataFrame:
    """One row per document version with its open shingles, rarest first (at most
    a prefix), and ``ask``: the least number of them any partner in its lists
    could ask for."""
    lists = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("c"), F.min("l").alias("l0"),
                                     F.min("n").alias("n0"), F.max("n").alias("n1"))
    units = rows.join(lists, "gram").groupBy("rep", "n", "l", "component").agg(
        F.sort_array(F.collect_list(F.struct("c", "gram"))).alias("grams"),
        F.min("l0").alias("l0"), F.min("n0").alias("n0"), F.max("n1").alias("n1"))
    p = percent
    return units.selectExpr(
        "rep", "n", "l", "component", "transform(grams, g -> g.gram) as grams",
        "least(l, l0) as l0", f"greatest(n0, ceil({p} * n / 100)) as n0",
        f"least(n1, floor(100 * n / {p})) as n1") \
        .withColumn("ask", F.expr(f"""greatest(1, l0, least(
            ceil((n + n0) * {p} / {100 + p}) - ceil({p} * n / 100) + l,
            ceil((n + n1) * {p} / {100 + p}) - ceil({p} * n1 / 100) + l0) - 2)""")) \
        .where("size(grams) >= ask").select("rep", "n", "l", "component", "grams", "ask")


def _all_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Every candidate pair across components. Two documents that share ``ask``
    open shingles share one of the first size - ask + 1 of each, so only those
    meet; what the pair shares is then counted on the whole lists. Of each
    shingle's documents those in its largest component are on one side only, so a
    component is never paired with itself."""
    units = staged(_units(rows, percent), "jaccard-units")
    probes = units.select("rep", "n", "l", "component", F.explode(F.slice(
        "grams", F.lit(1), (F.size("grams") - F.col("ask") + 1).cast("int"))).alias("gram"))
    largest = probes.groupBy("gram", "component").count().groupBy("gram") \
        .agg(F.max_by("component", F.struct("count", "component")).alias("largest"))
    probes = probes.join(largest, "gram")
    x = probes.selectExpr("gram", "rep as a", "n as na", "l as la", "component as ca")
    y = probes.where("component <> largest").selectExpr(
        "gram", "rep as b", "n as nb", "l as lb", "component as cb", "largest")
    met = x.join(y, "gram").where("ca <> cb and (ca = largest or a < b)") \
        .where(_near_in_size("na", "nb", percent)) \
        .select("a", "na", "la", "b", "nb", "lb").distinct()
    left, right = (units.selectExpr(f"rep as {v}", f"n as n{v}", f"l as l{v}", f"grams as g{v}")
                   for v in "ab")
    return met.join(left, ["a", "na", "la"]).join(right, ["b", "nb", "lb"]) \
        .withColumn("met", F.size(F.array_intersect("ga", "gb"))).where(_enough(percent)) \
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def linked(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    members = staged(sets(rows, words), "jaccard-members")
    classes = members.where("n > 0 and doc_id is not null").groupBy("k1", "k2", "n") \
        .agg(F.min("doc_id").alias("rep"))
    members = staged(members.join(classes, ["k1", "k2", "n"], "left")
                     .select("doc_id", "n", "rep"), "jaccard-classes")

    freq = frequencies(rows, words)
    of_class = members.where("rep is not null")
    # documents that only repeat others' sets
    copies = staged(of_class.groupBy("doc_id").agg(
        F.bool_or(F.col("rep") == F.col("doc_id")).alias("own")).where("not own")
        .select("doc_id"), "jaccard-copies")
    single = rows.join(small_side(copies, 24), "doc_id", "left_anti").select("doc_id", "text")
    live = staged(postings(single, freq, percent, words), "jaccard-live")

    versions = of_class.groupBy("doc_id") \
        .agg(F.min("rep").alias("a"), F.max("rep").alias("top")).where("a < top")
    links = staged(of_class.join(versions, "doc_id").where("rep > a")
                   .select("a", F.col("rep").alias("b")), "jaccard-versions")
    merged = staged(components(links), "jaccard-merged") if links.take(1) else None
    for step in range(ROUNDS + 1):
        live = staged(_open(_with_components(live.drop("component"), merged)), "jaccard-live")
        if not live.take(1):
            break
        pairs = staged(_all_pairs(live, percent) if step == ROUNDS else
                       _star_pairs(live, percent), "jaccard-pairs")
        new = verified(rows, pairs, percent, words) if pairs.take(1) else pairs
        if step < ROUNDS and not new.take(1):
            pairs = staged(_all_pairs(live, percent), "jaccard-pairs")
            new, step = verified(rows, pairs, percent, words), ROUNDS
        links = links.union(new)
        merged = staged(components(links), "jaccard-merged")
        if step == ROUNDS:
            break
    done = _with_components(members, merged)
    return done.select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                       F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
                       .alias("component_id"))


def one_of_each(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """``docs``, all columns, with one row of each component: of the document
    with the least doc_id. Rows with a NULL doc_id stay."""
    found = staged(linked(docs, percent, words).select("doc_id", "component_id"),
                   "jaccard-linked")
    gone = staged(found.where("component_id <> doc_id").select("doc_id").distinct(),
                  "jaccard-gone")
    kept = docs.join(small_side(gone, 24), "doc_id", "left_anti").select(*docs.columns)
    again = staged(found.where("doc_id is not null").groupBy("doc_id").count()
                   .where("count > 1").select("doc_id"), "jaccard-again")
    if not again.take(1):
        return kept
    again = small_side(again, 24)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    single = kept.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(
        F.min_by(whole, F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("row"))
    return kept.join(again, "doc_id", "left_anti").select(*docs.columns) \
        .unionByName(single.select("row.*"))
