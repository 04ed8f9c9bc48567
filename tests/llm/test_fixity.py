from regcurate.llm import fixity

SCHEMA = "archive string, at long, record_id long, payload string"


def _audit(spark, ours, theirs, **kw):
    a, b = (spark.createDataFrame(r, SCHEMA) for r in (ours, theirs))
    return sorted(tuple(r) for r in fixity.audit(a, b, **kw).collect())


def _records(n, size=100):
    return [(f"w{k % 3}", (k // 3) * size, k, f"payload {k}") for k in range(n)]


def test_locates_damage(spark):
    ours = _records(300)
    theirs = [r for r in ours if r[2] != 17]
    theirs = [(a, at, i, "x" if i == 100 else p) for a, at, i, p in theirs]
    theirs += [("w9", 5, 1000, "new"), ("w0", 99_999, 1001, "late")]
    want = sorted([("w2", 500, 17, "missing"), ("w1", 3300, 100, "altered"),
                   ("w9", 5, 1000, "extra"), ("w0", 99_999, 1001, "extra")])
    for width, fanout in ((64, 2), (1000, 4), (1 << 18, 16)):
        assert _audit(spark, ours, theirs, width=width, fanout=fanout) == want


def test_equal_replicas_in_any_order_agree(spark):
    ours = _records(50) + [("w0", 0, 7, "tie"), ("w0", 0, 7, "tie"), (None, 1, 1, "void")]
    assert _audit(spark, ours, ours[::-1], width=200, fanout=2) == []


def test_ties_nulls_and_empty(spark):
    ours = [("a", 0, 1, None), ("a", 0, 2, "x"), ("a", 10, None, "y")]
    assert _audit(spark, ours, [("a", 0, 1, ""), ("a", 0, 2, "x"), ("a", 10, 5, "y")]) == []
    assert _audit(spark, ours, ours + [ours[1]]) == [("a", 0, 1, "altered")]
    assert _audit(spark, ours, []) == [("a", 0, 1, "missing"), ("a", 10, None, "missing")]
    assert _audit(spark, [], []) == []


def test_digests_in_place_of_payloads_and_clashing_columns(spark):
    ours, theirs = _records(40), [(a, at, i, "x" if i == 7 else p) for a, at, i, p in _records(40)]
    sides = [spark.createDataFrame([(*r, "n", 1, "h") for r in rows],
                                   SCHEMA + ", least string, part int, hash string")
             for rows in (ours, theirs)]
    digests = [df.withColumn("payload_sha256", fixity.digest_of(df["payload"])).drop("payload")
               for df in sides]
    want = [("w1", 200, 7, "altered")]
    assert [tuple(r) for r in fixity.audit(*sides, width=64, fanout=2).collect()] == want
    assert [tuple(r) for r in fixity.audit(*digests, width=64, fanout=2).collect()] == want


def test_query_matches_record_comparison(spark):
    from regcurate.llm import queries

    sf = "/root/testdata/sf0.01"
    sides = []
    for side in queries._replicas(spark, sf):
        places = {}
        for r in side.collect():
            places.setdefault((r.archive, r["at"]), []).append((r.record_id, r.payload_sha256))
        sides.append({k: sorted(v) for k, v in places.items()})
    a, b = sides
    want = {(*k, "missing" if k not in b else "extra" if k not in a else "altered")
            for k in a.keys() | b.keys() if a.get(k) != b.get(k)}
    got = {(r.archive, r["at"], r.status) for r in queries.op4_fixity(spark, sf).collect()}
    assert got == want and got
