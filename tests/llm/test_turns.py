import hashlib
import itertools
import random
import re

import pytest

from regcurate.llm import queries, turns

SCHEMA = "conv_id long, turn int, role string, text string, cost string, audit int"
LEGAL = re.compile(r"(s?(ua)+)?\Z")


def plain(rows):
    """One conversation by search over whole audits: all edits of all rows with
    up to two insertions before each and at the end."""
    seen, codes = set(), []
    counts = {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not last else "duplicate" if (role, text) in seen else \
            "truncated" if last[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        codes.append(fault)
    initials = [r[1][:1] for r in rows]
    best = None
    slots = [""] + ["I", "II"]
    per_row = [["D"] if f in ("blank", "duplicate") else ["D", "K", "R"] for f in codes]
    for letters in itertools.product(*per_row):
        for ins in itertools.product(slots, repeat=len(rows) + 1):
            out, cost, audit = "", 0, ""
            for k, x in enumerate(letters):
                for _ in ins[k]:
                    out += "a" if out[-1:] == "u" else "u"
                audit += ins[k] + x
                cost += 3 * len(ins[k])
                if x == "D":
                    cost += 4
                    continue
                cost += 3 * (x == "R") + 3 * (codes[k] == "truncated")
                out += (initials[k] or "?") if x == "K" else "a" if out[-1:] == "u" else "u"
            for _ in ins[-1]:
                out += "a" if out[-1:] == "u" else "u"
            audit, cost = audit + ins[-1], cost + 3 * len(ins[-1])
            if LEGAL.match(out) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return counts, best


def stepwise(rows):
    """The same by a table over all rows, from the end: (cost, audit) from each
    state; for conversations too long to enumerate."""
    seen, faults = set(), []
    for _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("go" if not last or (role, text) in seen else
                      "cut" if last[-1] not in ".!?" else "")
        seen.add((role, text))
    nxt = {"": "u", "s": "u", "u": "a", "a": "u"}
    legal = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}
    best = {"": (0, ""), "a": (0, ""), "u": (3, "I"), "s": (6, "II")}
    for (_, role, _), fault in zip(reversed(rows), reversed(faults)):
        new = {}
        for q in nxt:
            ways = [(best[q][0] + 4, "D" + best[q][1])]
            if fault != "go":
                extra = 3 * (fault == "cut")
                ways.append((best[nxt[q]][0] + 3 + extra, "R" + best[nxt[q]][1]))
                if (q, role[:1]) in legal:
                    ways.append((best[role[:1]][0] + extra, "K" + best[role[:1]][1]))
            new[q] = min(ways)
        for _ in range(2):
            for q in nxt:
                new[q] = min(new[q], (new[nxt[q]][0] + 3, "I" + new[nxt[q]][1]))
        best = new
    return best[""]


def rebuilt(rows, audit):
    out, last, it = [], "", iter(rows)
    for x in audit:
        fit = "assistant" if last == "u" else "user"
        if x == "I":
            out.append((fit, ""))
        else:
            _, role, text = next(it)
            if x == "D":
                continue
            out.append((role if x == "K" else fit, text))
        last = out[-1][0][:1]
    assert next(it, None) is None
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()


def _random(r, n):
    return [(r.choice([None, 0, 1, 2, 3, 5, 9]), r.choice(["user", "assistant", "system", "tool", ""]),
             r.choice(["Yes.", "No!", "cut off", " ", "", "Why?  "])) for _ in range(n)]


def _in_order(rows):
    return sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1],
                                       hashlib.sha256(x[2].encode()).hexdigest()))


def test_audits_are_the_least_of_all_cheapest():
    r = random.Random(5)
    for n in (0, 1, 2, 3, 3, 4):
        for _ in range(25 if n < 4 else 6):
            rows = _random(r, n)
            counts, best = plain(rows)
            got, letters, _, _ = turns._whole([(k, *x, 2 if not x[2].strip() else
                                                0 if x[2].strip()[-1] in ".!?" else 1)
                                               for k, x in enumerate(rows)])
            assert (got[5], "".join(letters)) == best == stepwise(rows)
            assert dict(zip(("blank", "duplicate", "truncated"), got[1:4])) == counts


def _expected(convs):
    want = {}
    for c, rows in convs.items():
        rows = _in_order(rows)
        seen = [x[0] for x in rows if x[0] is not None]
        cost, audit = stepwise(rows)
        pairs = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        gaps = max(seen) - min(seen) + 1 - len(set(seen)) if seen else 0
        want[c] = (gaps, pairs, cost, audit, rebuilt(rows, audit))
    return want


@pytest.mark.parametrize("held,block", [(4096, 1 << 16), (3, 4), (0, 1)])
def test_same_result_however_conversations_are_cut(spark, monkeypatch, held, block):
    monkeypatch.setattr(turns, "HELD_ROWS", held)
    monkeypatch.setattr(turns, "BLOCK_ROWS", block)
    r = random.Random(held)
    convs = {c: _random(r, r.choice([1, 2, 3, 5, 8, 21])) for c in range(60)}
    convs[None] = _random(r, 12)
    convs[1000] = [(k // 3, "user" if k % 2 else "assistant", f"{k % 50} {'.' if k % 7 else ''}")
                   for k in range(1500)]                      # long, with repeated rows
    convs[1001] = [(None, "user", "Same.")] * 400             # one row over and over
    rows = [(c, *x, "c", 1) for c, xs in convs.items() for x in xs]
    r.shuffle(rows)
    ids = spark.createDataFrame([(c,) for c in convs] + [(7777,), (7778,), (7777,)], "conv_id long")
    df = spark.createDataFrame(rows, SCHEMA)
    got = {x.conv_id: x for x in turns.repair(df.repartition(5), ids).collect()}
    want = _expected(convs)
    assert set(got) == set(want) | {7777, 7778}
    for c, w in want.items():
        g = got[c]
        assert (g.gaps, g.illegal, g.cost, g.audit, g.repaired_sha256) == w, c
    empty = hashlib.sha256(b"").hexdigest()
    assert tuple(got[7777])[1:] == (0, 0, 0, 0, 0, 0, "", empty)


def test_turns_are_those_of_the_digest(spark, monkeypatch):
    monkeypatch.setattr(turns, "HELD_ROWS", 6)
    r = random.Random(3)
    rows = [(c, *x, "c", 1) for c in range(30) for x in _random(r, 9)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = {}
    for x in turns.repaired_turns(df).orderBy("conv_id", "place", "part").collect():
        found.setdefault(x.conv_id, []).append(f"{x.role}:{x.text}")
    for x in turns.repair(df).collect():
        text = "\n".join(found.get(x.conv_id, []))
        assert hashlib.sha256(text.encode()).hexdigest() == x.repaired_sha256


def test_nulls_and_empty_table(spark):
    df = spark.createDataFrame([(1, None, None, None, "c", 1), (1, 0, "user", "Hi.", "c", 1),
                                (1, 1, "assistant", "x" * 300_000 + ".", "c", 1)], SCHEMA)
    got = turns.repair(df).collect()[0]
    assert (got.blank, got.cost, got.audit) == (1, 4, "DKK")
    assert turns.repair(df.limit(0)).collect() == []


def test_query_over_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    damaged = queries._damaged_turns(queries.table(spark, sf, "conversations"))
    convs = {}
    for x in damaged.collect():
        convs.setdefault(x.conv_id, []).append((x.turn, x.role, x.text))
    want = _expected(convs)
    got = {x.conv_id: x for x in queries.op13_conversation_repair(spark, sf).collect()}
    assert len(got) == queries.table(spark, sf, "conversations").select("conv_id").distinct().count()
    for c, w in want.items():
        g = got[c]
        assert (g.gaps, g.illegal, g.cost, g.audit, g.repaired_sha256) == w
