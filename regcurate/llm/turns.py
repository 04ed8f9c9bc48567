"""Conversation structure repair by Hirschberg's divide and conquer.

A repaired conversation's role initials read ``(s?(ua)+)?``. Four states follow
them: E nothing yet, S after ``s``, U after ``u``, A after ``a``; E and A may end
a conversation. Every row is kept (K, cost 0), given the role user or assistant
that fits (R, 3) or deleted (D, 4; required for blank rows and for repeated
ones); empty turns are inserted (I, 3) before a row or at the end; a row whose
text breaks off costs 3 more unless it is deleted.

``forward`` carries a cost and an audit rank for each state: audits up to the
same row that end in different states differ before either ends, so the rank
orders them for good. ``backward`` carries the cost to the end. In the middle of
a conversation both vectors meet; the state with the least sum, by rank where
several have it, is the crossing of the audit-least optimal path, and both
halves are solved likewise. Only vectors are held, never a table of the rows.

On Spark the rows are range-partitioned by conversation and place and sorted;
one pass solves every conversation that lies inside a partition and is short
(HELD_ROWS, HELD_BYTES). The others (those at a partition's edges, long ones)
go a second way with the same result at any length: rows are cut into blocks,
each block gives its 4 x 4 matrix of costs and ranks, the matrices are composed
in order to the crossings at the block edges, and each block is solved between
its crossings. Only the SHA-256 of a whole conversation is taken in one stream,
in constant memory, and its audit is one string, so a conversation has fewer
than 2**31 edits.

Defined results: NULL texts and roles count as one space (so the text is blank),
NULL turns come first; rows of one turn are ordered by role, then by the SHA-256
of their text; rows without a conversation id are one conversation; a
conversation of ``ids`` without rows has zeros, an empty audit and the empty
string's hash; repeated rows are duplicates; texts of any length are hashed
whole; other columns, whatever their names, are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regcurate.llm.shared import in_arrow, per_group, staged

#: A conversation up to these sizes is solved where its rows are sorted.
HELD_ROWS, HELD_BYTES = 4096, 4 << 20
#: Rows of one block of a longer conversation.
BLOCK_ROWS = 1 << 16

E, S, U, A = range(4)
_FITS = (U, U, A, U)                      # state after the user/assistant turn that fits
_CLOSE = {E: (0, ""), A: (0, ""), U: (3, "I"), S: (6, "II")}
_KEEP = {(E, "s"): S, (E, "u"): U, (S, "u"): U, (U, "a"): A, (A, "u"): U}
_INITIALS = "sua"
FINE, TRUNCATED, MUST_GO = 0, 1, 2        # faults, as far as they bear on costs
FINAL = -1                                # target: any state, closed by insertions


def row_code(initial: str, fault: int) -> int:
    """A row as far as costs go: class of its role initial and fault."""
    return 4 * fault + (_INITIALS.index(initial) if initial and initial in _INITIALS else 3)


@lru_cache(maxsize=None)
def options(code: int, state: int) -> dict[int, tuple[int, str]]:
    """Cheapest (cost, letters) from ``state`` to each state just after the row,
    insertions before the row included; of equal costs the least letters."""
    fault, initial = code // 4, (_INITIALS + "?")[code % 4]
    best: dict[int, tuple[int, str]] = {}
    at, cost, letters = state, 0, ""
    for _ in range(3):                    # a third insertion leads nowhere new
        found = [(at, 4, "D")]
        if fault != MUST_GO:
            extra = 3 if fault == TRUNCATED else 0
            found.append((_FITS[at], 3 + extra, "R"))
            if (at, initial) in _KEEP:
                found.append((_KEEP[at, initial], extra, "K"))
        for to, price, letter in found:
            best[to] = min(best.get(to, (99, "")), (cost + price, letters + letter))
        at, cost, letters = _FITS[at], cost + 3, letters + "I"
    return best


@lru_cache(maxsize=1 << 16)
def _forward(vector: tuple, code: int) -> tuple[tuple, int]:
    best: dict[int, tuple] = {}
    for state, entry in enumerate(vector):
        if entry is not None:
            for to, (price, letters) in options(code, state).items():
                new = (entry[0] + price, entry[1], letters)
                if to not in best or new < best[to]:
                    best[to] = new
    order = sorted(best, key=lambda to: best[to][1:])
    least = min(x[0] for x in best.values())
    return tuple((best[q][0] - least, order.index(q)) if q in best else None
                 for q in range(4)), least


def forward(codes: bytes, lo: int, hi: int, state: int) -> tuple[tuple, int]:
    """((cost, audit rank) per state just after row hi - 1, cost to be added)
    for rows [lo, hi) entered in ``state``."""
    vector, base = tuple((0, 0) if q == state else None for q in range(4)), 0
    for k in range(lo, hi):
        vector, add = _forward(vector, codes[k])
        base += add
    return vector, base


@lru_cache(maxsize=1 << 16)
def _backward(vector: tuple, code: int) -> tuple[tuple, int]:
    out = [min((price + vector[to] for to, (price, _) in options(code, q).items()
                if vector[to] is not None), default=None) for q in range(4)]
    least = min(x for x in out if x is not None)
    return tuple(None if x is None else x - least for x in out), least


def _ending(target: int) -> tuple:
    if target == FINAL:
        return tuple(_CLOSE[q][0] for q in range(4))
    return tuple(0 if q == target else None for q in range(4))


def backward(codes: bytes, lo: int, hi: int, target: int) -> tuple:
    """Cost from each state before row lo to the target after row hi - 1, up to
    a constant; None where there is no way."""
    vector = _ending(target)
    for k in range(hi - 1, lo - 1, -1):
        vector, _ = _backward(vector, codes[k])
    return vector


def solve(codes: bytes, lo: int, hi: int, state: int, target: int) -> list[str]:
    """The audit-least cheapest edits: letters per row, insertions in front; with
    the target FINAL the last row's letters end with the closing insertions."""
    if lo == hi:
        return []
    if hi - lo == 1:
        ways = [(price + _CLOSE[to][0], letters + _CLOSE[to][1]) if target == FINAL
                else (price, letters)
                for to, (price, letters) in options(codes[lo], state).items()
                if target in (FINAL, to)]
        return [min(ways)[1]]
    mid = (lo + hi) // 2
    ahead, behind = forward(codes, lo, mid, state)[0], backward(codes, mid, hi, target)
    crossing = min((ahead[q][0] + behind[q], ahead[q][1], q) for q in range(4)
                   if ahead[q] is not None and behind[q] is not None)[2]
    return solve(codes, lo, mid, state, crossing) + solve(codes, mid, hi, crossing, target)


def price_of(codes: bytes, letters: list[str]) -> int:
    return sum(3 * (x.count("I") + x.count("R")) + 4 * x.count("D")
               + (3 if code // 4 == TRUNCATED and "D" not in x else 0)
               for code, x in zip(codes, letters))


_ROLE = {U: "user", A: "assistant"}


def repaired(state: int, roles: Iterator, texts: Iterator, letters: Iterator
             ) -> Iterator[tuple[str, str, str, int]]:
    """(role, text, letter, state) of every turn that stays or comes in."""
    for role, text, row in zip(roles, texts, letters):
        for x in row:
            if x == "K":
                state = _KEEP[state, role[:1]]
                yield role, text, x, state
            elif x != "D":
                state = _FITS[state]
                yield _ROLE[state], "" if x == "I" else text, x, state


# --- rows in order ------------------------------------------------------------

_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
RESULT = "conv_id long, " + ", ".join(f"{c} long" for c in _COUNTS) + \
    ", audit string, repaired_sha256 string"
_TURN = "conv_id long, place long, part int, role string, text string, edit string"
_OPEN = "seq long, turn long, role string, text string, shape int"
_EMPTY = hashlib.sha256(b"").hexdigest()
_ABSENT = 3                               # shape of a row that only names its conversation
_BLANK = r" \t\n\u000B\u000C\r"


def _ordered(rows: DataFrame, ids: DataFrame | None) -> DataFrame:
    """conv_id and the columns of _OPEN, in conversation order: ``seq`` grows with
    the place; ``shape`` is 0, 1 truncated, 2 blank, 3 no row."""
    last = F.right(F.expr(f"trim(TRAILING '{_BLANK}' FROM text)"), F.lit(1))
    shape = F.when(F.expr(f"trim(BOTH '{_BLANK}' FROM text) = ''"), 2) \
        .when(last.isin(".", "!", "?"), 0).otherwise(1)
    df = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text")) \
        .withColumn("shape", shape.cast("int"))
    if ids is not None:
        df = df.unionByName(ids.selectExpr(
            "cast(conv_id as long) as conv_id", "cast(null as long) as turn", "'' as role",
            "'' as text", f"{_ABSENT} as shape").distinct())
    # copy: lets a large run of equal rows span several partitions
    keys = ["conv_id", "turn", "role", "_tie", "_copy"]
    return df.withColumns({"_tie": F.sha2(F.col("text").cast("binary"), 256),
                           "_copy": F.monotonically_increasing_id()}) \
        .repartitionByRange(*keys).sortWithinPartitions(*keys) \
        .withColumn("seq", F.monotonically_increasing_id()) \
        .select("conv_id", "seq", "turn", "role", "text", "shape")


class _Tally:
    """Counts over rows in order that do not need to see a row twice."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.first = self.last = None

    def add(self, turn, initial, shape, repeated) -> int:
        """Counts a row; returns its fault."""
        fault = MUST_GO if shape == 2 or repeated else shape
        if shape == 2:
            self.blank += 1
        elif repeated:
            self.duplicate += 1
        elif shape == 1:
            self.truncated += 1
        if self.first is None:
            self.first = initial
        elif self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = initial
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        return fault

    def join(self, b: "_Tally") -> None:
        """Adds the rows that follow."""
        self.blank, self.duplicate = self.blank + b.blank, self.duplicate + b.duplicate
        self.truncated, self.illegal = self.truncated + b.truncated, self.illegal + b.illegal
        self.turns += b.turns
        if b.first is not None:
            if self.first is None:
                self.first = b.first
            elif self.last + b.first not in ("su", "ua", "au"):
                self.illegal += 1
            self.last = b.last
        if b.low is not None:
            if self.high == b.low:
                self.turns -= 1
            self.low, self.high = b.low if self.low is None else self.low, b.high

    def counts(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal


def _whole(rows: list[tuple]) -> tuple[tuple, list[str], list, list]:
    """(counts, letters, roles, texts) of a conversation held whole."""
    tally, seen, codes, roles, texts = _Tally(), set(), bytearray(), [], []
    for _, turn, role, text, shape in rows:
        if shape != _ABSENT:
            fault = tally.add(turn, role[:1], shape, (role, text) in seen)
            seen.add((role, text))
            codes.append(row_code(role[:1], fault))
            roles.append(role)
            texts.append(text)
    letters = solve(bytes(codes), 0, len(codes), E, FINAL)
    return (*tally.counts(), price_of(codes, letters)), letters, roles, texts


def _first_pass(turns: bool):
    """Solves the conversations inside a partition; hands the rows of the others
    on. Output: conv_id, open, then the columns of a result (or of the repaired
    turns) and those of _OPEN."""
    schema = _pass_schema(turns)

    def held(conv, rows):
        counts, letters, roles, texts = _whole(rows)
        if turns:
            at = (x for (seq, *_), row in zip([r for r in rows if r[4] != _ABSENT], letters)
                  for x in [seq] * sum(c != "D" for c in row))
            for k, (place, (role, text, edit, _)) in enumerate(
                    zip(at, repaired(E, roles, texts, letters))):
                yield (conv, False, place, k, role, text, edit) + (None,) * 5
        else:
            lines = [f"{role}:{text}" for role, text, *_ in repaired(E, roles, texts, letters)]
            sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
            yield (conv, False, *counts, "".join(letters), sha) + (None,) * 5

    blank = (None,) * (5 if turns else 8)

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0                     # rows to be handed on, characters in them
        conv, rows, held_bytes, is_open, begun = None, [], 0, True, False

        def done(last: bool) -> list[tuple]:
            """The conversation so far: as rows if it is open, else solved."""
            if is_open or last:
                return [(conv, True, *blank, *r) for r in rows]
            return list(held(conv, rows))

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in
                    ("conv_id", "seq", "turn", "role", "text", "shape")]
            for c, *row in zip(*cols):
                if not begun or c != conv:
                    if begun:
                        out += done(False)
                    # the partition's first conversation may have begun before
                    conv, rows, held_bytes, is_open, begun = c, [], 0, not begun, True
                rows.append(tuple(row))
                held_bytes += len(row[2]) + len(row[3])
                size += len(row[3])
                if len(rows) > HELD_ROWS or held_bytes > HELD_BYTES:
                    is_open = True
                if is_open and len(rows) >= 256:
                    out += done(False)
                    rows, held_bytes = [], 0
                if out and (len(out) >= 2048 or size > HELD_BYTES):
                    yield batch_of(out)
                    out, size = [], 0
        if begun:
            out += done(True)                 # it may go on in the next partition
        if out:
            yield batch_of(out)

    return run


def _fields(ddl: str) -> list[tuple[str, pa.DataType]]:
    types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    return [(name, types[kind]) for name, kind in (x.split() for x in ddl.split(", "))]


def _pass_ddl(turns: bool) -> str:
    own = _TURN if turns else RESULT
    rest = ", ".join("o_" + x for x in _OPEN.split(", "))
    return own.replace("conv_id long, ", "conv_id long, open boolean, ", 1) + ", " + rest


def _pass_schema(turns: bool) -> pa.Schema:
    ddl = _pass_ddl(turns).replace("open boolean, ", "")
    fields = _fields(ddl)
    return pa.schema([fields[0], ("open", pa.bool_()), *fields[1:]])


# --- conversations at partition edges and long ones ----------------------------

_SEGMENT = pa.schema([
    ("conv_id", pa.int64()), ("seq", pa.int64()), ("n", pa.int64()),
    ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
    ("illegal", pa.int64()), ("turns", pa.int64()), ("low", pa.int64()), ("high", pa.int64()),
    ("first", pa.string()), ("last", pa.string()), ("cost", pa.list_(pa.int64())),
    ("rank", pa.list_(pa.int32())), ("seqs", pa.list_(pa.int64())), ("codes", pa.binary())])
_SEGMENT_DDL = ("conv_id long, seq long, n long, blank long, duplicate long, truncated long, "
                "illegal long, turns long, low long, high long, first string, last string, "
                "cost array<long>, rank array<int>, seqs array<long>, codes binary")


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows of one conversation, at most BLOCK_ROWS each: counts and the
    costs and ranks from every state to every state."""
    conv, begun, tally, codes, seqs = None, False, _Tally(), bytearray(), []

    def done():
        if not begun:
            return
        t, costs, ranks = tally, [], []
        for p in range(4):
            vector, base = forward(bytes(codes), 0, len(codes), p)
            costs += [None if v is None else v[0] + base for v in vector]
            ranks += [None if v is None else v[1] for v in vector]
        yield pa.RecordBatch.from_pylist([dict(zip(_SEGMENT.names, (
            conv, seqs[0] if seqs else start, len(codes), t.blank, t.duplicate, t.truncated,
            t.illegal, t.turns, t.low, t.high, t.first, t.last, costs, ranks, seqs,
            bytes(codes))))], _SEGMENT)

    start = 0
    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in
                ("conv_id", "seq", "turn", "initial", "shape", "repeated")]
        for c, seq, turn, initial, shape, again in zip(*cols):
            if not begun or c != conv or len(codes) >= BLOCK_ROWS:
                yield from done()
                conv, begun, tally, codes, seqs, start = c, True, _Tally(), bytearray(), [], seq
            if shape != _ABSENT:
                codes.append(row_code(initial, tally.add(turn, initial, shape, again)))
                seqs.append(seq)
    yield from done()


_CROSSING = pa.schema([("conv_id", pa.int64()), ("seq", pa.int64()), ("state", pa.int32()),
                       ("target", pa.int32()), *[(c, pa.int64()) for c in _COUNTS]])
_CROSSING_DDL = ("conv_id long, seq long, state int, target int, "
                 + ", ".join(f"{c} long" for c in _COUNTS))


def _compose(table: pa.Table) -> pa.Table:
    """Crossings at the block edges of one conversation, from its block matrices
    (one row per BLOCK_ROWS rows and partition)."""
    blocks = sorted(table.to_pylist(), key=lambda b: b["seq"])
    vector, total, came = tuple((0, 0) if q == E else None for q in range(4)), _Tally(), []
    for b in blocks:
        part = _Tally()
        for name in ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high",
                     "first", "last"):
            setattr(part, name, b[name])
        total.join(part)
        best: dict[int, tuple] = {}
        for p, entry in enumerate(vector):
            for q in range(4):
                cost, rank = b["cost"][4 * p + q], b["rank"][4 * p + q]
                if entry is not None and cost is not None:
                    new = (entry[0] + cost, entry[1], rank, p)
                    best[q] = min(best.get(q, new), new)
        order = sorted(best, key=lambda q: best[q][1:3])
        came.append({q: x[3] for q, x in best.items()})
        vector = tuple((best[q][0], order.index(q)) if q in best else None for q in range(4))
    cost, _, state = min((x[0] + _CLOSE[q][0], x[1], q) for q, x in enumerate(vector)
                         if x is not None)
    # the last block with rows closes the conversation
    last = max((k for k, b in enumerate(blocks) if b["n"]), default=-1)
    out = []
    for k in range(len(blocks) - 1, -1, -1):
        before = came[k][state]
        out.append((blocks[k]["conv_id"], blocks[k]["seq"], before,
                    FINAL if k == last else state, *total.counts(), cost))
        state = before
    return pa.Table.from_pylist([dict(zip(_CROSSING.names, r)) for r in out], _CROSSING)


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and edits of each block between its crossings."""
    schema = pa.schema([("seq", pa.int64()), ("audit", pa.string()),
                        ("edits", pa.list_(pa.string())), ("states", pa.list_(pa.int32()))])
    for batch in batches:
        for b in batch.to_pylist():
            state, states = b["state"], []
            letters = solve(b["codes"], 0, b["n"], state, b["target"])
            for code, row in zip(b["codes"], letters):
                states.append(state)
                for x in row:
                    if x == "K":
                        state = _KEEP[state, (_INITIALS + "?")[code % 4]]
                    elif x != "D":
                        state = _FITS[state]
            yield pa.RecordBatch.from_pylist(
                [{"seq": b["seq"], "audit": "".join(letters), "edits": letters,
                  "states": states}], schema)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's repaired turns, streamed in order."""
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
    conv, sha, empty = None, None, True
    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "edit", "state")]
        out = []
        for c, role, text, edit, state in zip(*cols):
            if sha is None or c != conv:
                if sha is not None:
                    out.append((conv, sha.hexdigest()))
                conv, sha, empty = c, hashlib.sha256(), True
            for r, t, *_ in repaired(state, [role], [text], [edit]):
                sha.update(f"{'' if empty else chr(10)}{r}:{t}".encode())
                empty = False
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)
    if sha is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (conv, sha.hexdigest())))],
                                         schema)


def _turns_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(_fields(_TURN))
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            for k, (role, text, x, _) in enumerate(
                    repaired(r["state"], [r["role"]], [r["text"]], [r["edit"]])):
                out.append((r["conv_id"], r["seq"], k, role, text, x))
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)


def _open_rows(first: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows with edits and entering states, crossings, solved blocks) of the
    conversations the first pass handed on."""
    rows = first.where("open").selectExpr(
        "conv_id", *[f"o_{x.split()[0]} as {x.split()[0]}" for x in _OPEN.split(", ")])
    keyed = rows.withColumn("_key", F.sha2(F.concat_ws(":", "role", "text").cast("binary"), 256))
    firsts = keyed.where(f"shape <> {_ABSENT}").groupBy(
        F.col("conv_id").alias("_conv"), F.col("role").alias("_role"),
        F.col("_key").alias("_text")).agg(
            F.min("seq").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    again = keyed.select("conv_id", "seq", "turn", "role", "shape", "_key").join(
        firsts, F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("role").eqNullSafe(
            F.col("_role")) & (F.col("_key") == F.col("_text")), "left")
    coded = again.selectExpr("conv_id", "seq", "turn", "left(role, 1) as initial", "shape",
                             f"coalesce(seq > _first, false) and shape <> {_ABSENT} as repeated") \
        .repartitionByRange("seq").sortWithinPartitions("seq")
    segments = staged(in_arrow(coded, _segments, _SEGMENT_DDL), "turn-blocks")
    crossings = staged(per_group(segments.drop("codes", "seqs"), ["conv_id"], _compose,
                                 _CROSSING_DDL), "turn-crossings")
    solved = staged(in_arrow(
        segments.select("seq", "n", "codes").join(crossings.select("seq", "state", "target"),
                                                  "seq"),
        _solved, "seq long, audit string, edits array<string>, states array<int>"), "turn-edits")
    edits = segments.select("seq", "seqs").join(solved, "seq").selectExpr(
        "inline(arrays_zip(seqs, edits, states)) as (seq, edit, state)")
    return rows.join(edits, "seq"), crossings, solved


def repair(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """RESULT per conversation of ``rows`` (conv_id, turn, role, text) and of
    ``ids`` (conv_id): faults, cost, audit and hash of the repaired turns."""
    first = staged(in_arrow(_ordered(rows, ids), _first_pass(False), _pass_ddl(False)),
                   "turn-repairs")
    names = [x.split()[0] for x in RESULT.split(", ")]
    edited, crossings, solved = _open_rows(first)
    audits = crossings.select("conv_id", "seq", *_COUNTS).join(
        solved.select("seq", "audit"), "seq").groupBy("conv_id", *_COUNTS).agg(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "audit"))),
                                     lambda x: x["audit"]), "").alias("audit"))
    sums = in_arrow(edited.select("conv_id", "seq", "role", "text", "edit", "state")
                    .repartition("conv_id").sortWithinPartitions("conv_id", "seq"),
                    _hashes, "conv_id long, repaired_sha256 string") \
        .withColumnRenamed("conv_id", "_conv")
    rest = audits.join(sums, F.col("conv_id").eqNullSafe(F.col("_conv")), "left") \
        .withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.lit(_EMPTY)))
    return first.where("not open").select(names).unionByName(rest.select(names))


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations as rows: conv_id, place and part (their order
    within the conversation), role, text, edit."""
    first = staged(in_arrow(_ordered(rows, None), _first_pass(True), _pass_ddl(True)),
                   "turn-repairs")
    names = [x.split()[0] for x in _TURN.split(", ")]
    edited, _, _ = _open_rows(first)
    rest = in_arrow(edited.select("conv_id", "seq", "role", "text", "edit", "state"),
                    _turns_of, _TURN)
    return first.where("not open").select(names).unionByName(rest)
