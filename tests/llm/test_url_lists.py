from datetime import date

from regcurate.llm import url_lists


def test_entries_active_at_fetch_time(spark):
    d = date
    entries = spark.createDataFrame([
        ("ads", "Bad.example.com", d(2024, 1, 10), True),
        ("ads", "bad.example.com", d(2024, 2, 1), False),
        ("ads", "bad.example.com", d(2024, 3, 1), True),
        ("ads", "bad.example.com", d(2024, 3, 1), False),      # listing wins
        ("spam", "example.com", d(2024, 2, 15), True),
        ("spam", None, d(2024, 1, 1), True), ("spam", "x.org", None, True),
        ("gone", "bad.example.com", d(2020, 1, 1), False),
    ], "list_name string, host string, dated date, listed boolean")
    rows = [(1, "http://bad.example.com/a", d(2024, 1, 9)),
            (2, "https://u:p@BAD.example.com:80/a?b#c", d(2024, 1, 10)),
            (3, "http://bad.example.com", d(2024, 2, 1)),
            (4, "http://bad.example.com", d(2024, 2, 15)),
            (5, "http://a.b.bad.example.com/", d(2024, 3, 1)),
            (6, "http://notexample.com/", d(2024, 3, 1)), (7, None, d(2024, 3, 1)),
            (8, "no url", d(2024, 3, 1)), (9, "http://example.com", None),
            (2, "https://u:p@BAD.example.com:80/a?b#c", d(2024, 1, 10))]
    captures = spark.createDataFrame(rows, "page_id long, url string, fetched_on date") \
        .selectExpr("*", "1 as n_active", "'x' as domain")
    got = sorted((r.page_id, r.n_active, r.first_list or "", r.blocked)
                 for r in url_lists.judge_captures(captures, entries).collect())
    assert got == [(1, 0, "", False), (2, 1, "ads", True), (2, 1, "ads", True),
                   (3, 0, "", False), (4, 1, "spam", True), (5, 2, "ads", True),
                   (6, 0, "", False), (7, 0, "", False), (8, 0, "", False), (9, 0, "", False)]
    assert url_lists.judge_captures(captures, entries.limit(0)).where("blocked").count() == 0
    assert url_lists.judge_captures(captures.limit(0), entries).count() == 0


def test_addresses_dots_and_case(spark):
    d = date(2024, 1, 1)
    entries = spark.createDataFrame([
        ("a", "0.0.1", d, True), ("a", "evil.com", d, True), ("a", ".Dotted.org.", d, True),
        ("a", "*.star.net", d, True), ("a", "[2001:db8::1]", d, True), ("a", "10.0.0.2", d, True),
        ("a", " . ", d, True)], "list_name string, host string, dated date, listed boolean")
    urls = ["http://10.0.0.1/x", "http://evil.com./x", "http://sub.dotted.org/", "http://star.net",
            "http://u:p@[2001:DB8::1]:80/", "http://10.0.0.2:8080", "http://[2001:db8::2]/",
            "http://com./", "http://./"]
    captures = spark.createDataFrame([(k, u, d) for k, u in enumerate(urls)],
                                     "page_id long, url string, fetched_on date")
    got = {r.page_id: (r.host, r.blocked)
           for r in url_lists.judge_captures(captures, entries).collect()}
    assert [got[k][1] for k in range(len(urls))] == [False, True, True, True, True, True, False,
                                                     False, False]
    assert got[1][0] == "evil.com" and got[4][0] == "[2001:db8::1]" and got[8][0] is None


def test_a_hot_domain_meets_the_lists_once_per_host(spark):
    entries = spark.createDataFrame([("a", "com", date(2024, 1, 5), True)],
                                    "list_name string, host string, dated date, listed boolean")
    captures = spark.range(20_000).selectExpr(
        "id as page_id", "concat('http://h', id % 300, '.com/', id) as url",
        "date_add(date'2024-01-01', cast(id % 7 as int)) as fetched_on")
    got = url_lists.judge_captures(captures, entries)
    assert got.where("blocked").count() == got.where("fetched_on >= '2024-01-05'").count()
