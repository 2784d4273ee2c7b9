import datetime as dt

from wardbook.llm.url_filters import filtered, host_of, intervals, lookup_keys

CAPTURES = "id long, url string, fetched_at timestamp_ntz, category string"
ENTRIES = "pattern string, listed_at timestamp_ntz, action string, category string"


def day(n, hour=0):
    return dt.datetime(2024, 1, 1, hour) + dt.timedelta(days=n)


def verdicts(spark, captures, entries):
    rows = spark.createDataFrame([(i, u, t, "own") for i, (u, t) in enumerate(captures)], CAPTURES)
    out = filtered(rows, spark.createDataFrame(entries, ENTRIES))
    return [(r["blocked"], r["pattern"], r["category"], r["valid_from"]) for r in sorted(out.collect(), key=lambda r: r["id"])]


def test_entries_hold_from_their_addition_to_the_next_change(spark):
    entries = [("bad.com", day(1), "add", "x"), ("bad.com", day(3), "remove", None), ("bad.com", day(5), "add", "y")]
    urls = [("http://bad.com/", day(n, h)) for n, h in ((0, 23), (1, 0), (2, 23), (3, 0), (4, 0), (5, 0), (99, 0))]
    assert [v[0] for v in verdicts(spark, urls, entries)] == [False, True, True, False, False, True, True]
    assert verdicts(spark, urls, entries)[-1] == (True, "bad.com", "y", day(5))


def test_the_most_specific_active_entry_is_named(spark):
    entries = [("bad.com", day(0), "add", "d"), ("www.bad.com", day(2), "add", "h"), ("www.bad.com/a/b", day(3), "add", "p")]
    url = "https://user@WWW.bad.com:80/A/b/c?q#f"
    assert [v[1] for v in verdicts(spark, [(url, day(n)) for n in range(5)], entries)] == ["bad.com", "bad.com", "www.bad.com", "www.bad.com/a/b", "www.bad.com/a/b"]


def test_patterns_match_whole_labels_and_folders(spark):
    entries = [("bad.com", day(0), "add", "d"), ("x.org/ab", day(0), "add", "p")]
    urls = ["http://notbad.com/", "http://bad.com.net/", "http://x.org/abc", "http://x.org/ab", "http://y.x.org/ab", "http://a.b.c.d.e.f.g.h.i.j.bad.com/"]
    assert [v[0] for v in verdicts(spark, [(u, day(1)) for u in urls], entries)] == [False, False, False, True, False, True]


def test_nulls_ties_and_repeated_rows(spark):
    entries = [("bad.com", day(1), "add", "a"), ("bad.com", day(1), "add", "b"), ("bad.com", day(1), "add", "b"), ("worse.com", day(1), "add", "a"), ("worse.com", day(1), "remove", None), (None, day(0), "add", "n"), ("ok.com", None, "add", "n"), ("ok.com", day(0), None, "n"), ("ok.com", day(0), "other", "n")]
    urls = [("http://bad.com", day(2)), ("http://bad.com", day(2)), ("http://worse.com", day(2)), (None, day(2)), ("", day(2)), ("no url", day(2)), ("http://bad.com", None), ("http://ok.com", day(2)), ("http://" + "a" * 100_000, day(2))]
    found = verdicts(spark, urls, entries)
    assert [v[0] for v in found] == [True, True] + [False] * 7
    assert found[0][2] == "b"


def test_empty_tables(spark):
    assert verdicts(spark, [("http://bad.com", day(1))], []) == [(False, None, None, None)]
    assert verdicts(spark, [], [("bad.com", day(1), "add", "a")]) == []


def test_as_brute_force(spark):
    entries = [(f"h{i % 7}.com", day(i * 5 % 17, i % 24), "add" if i % 3 else "remove", f"c{i}") for i in range(60)]
    urls = [(f"http://w{i % 4}.h{i % 9}.com/x", day(i % 19, i % 24)) for i in range(200)]
    changes = {}
    for p, t, a, c in entries:
        changes[p, t] = max(changes.get((p, t), ("", "")), (a, c))
    for (url, at), got in zip(urls, verdicts(spark, urls, entries), strict=True):
        host = url.split("/")[2].split(".", 1)[1]
        before = [(t, a, c) for (p, t), (a, c) in changes.items() if p == host and t <= at]
        t, a, c = max(before, default=(None, "remove", None))
        assert got == ((True, host, c, t) if a == "add" else (False, None, None, None))


def test_hosts_and_keys(spark):
    urls = ["HTTP://A.b.Com./x/y/?z", "ftp://u:p@h:1", "mailto:x", "//x.y", None]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in frame.select(host_of(frame.url)).collect()] == ["a.b.com", "h", None, None, None]
    keys = [r[0] for r in frame.select(lookup_keys(frame.url, 2, 1)).collect()]
    assert keys == [["com", "b.com", "a.b.com/x"], ["h"], [], [], []]


def test_intervals_are_disjoint(spark):
    rows = spark.createDataFrame([("p", day(n), "add", str(n)) for n in (3, 1, 2)], ENTRIES)
    spans = sorted((r["valid_from"], r["valid_until"]) for r in intervals(rows).collect())
    assert spans == [(day(1), day(2)), (day(2), day(3)), (day(3), None)]
