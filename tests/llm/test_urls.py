import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tripmart.llm.urls import url_keys, url_verdicts, validity_intervals

DAY = datetime(2024, 1, 1)
CAPTURES = "page_id long, url string, fetched_at timestamp, key string"
ENTRIES = "list string, verdict string, key string, action string, at timestamp"


def keys(url):
    if not url or "://" not in url:
        return []
    host, _, path = url.split("://")[1].split("?")[0].split("#")[0].partition("/")
    host = host.lower()
    labels, steps = host.split("."), [s for s in path.split("/") if s]
    return [".".join(labels[k:]) for k in range(len(labels))] + ["/".join([host, *steps[: k + 1]]) for k in range(len(steps))]


def brute(url, at, entries):
    active = []
    for name, verdict, key in {e[:3] for e in entries}:
        if key not in keys(url) or at is None:
            continue
        changes = sorted((e[4], e[3]) for e in entries if e[:3] == (name, verdict, key) and e[4] is not None and e[4] <= at)
        if changes and changes[-1][1] == "add":
            active.append((len(key), key, verdict == "block"))
    return len(active), max(active)[1] if active else None, bool(active and max(active)[2])


def test_keys(spark):
    urls = ["https://U@A.b.Com:80/x//y?z#f", "http://h", "ftp://h/a", "no url", None, "", "http:///x"]
    got = spark.createDataFrame([(u,) for u in urls], "u string").select(url_keys(F.col("u")).alias("k")).collect()
    assert [r.k for r in got] == [["a.b.com", "b.com", "com", "a.b.com/x", "a.b.com/x/y"], ["h"], ["h", "h/a"], [], [], [], []]


def test_verdicts_equal_brute_force(spark):
    rng = random.Random(3)
    urls = [f"https://{h}/{p}" for h in ("a.x.com", "x.com", "b.org") for p in ("", "p", "p/q?r", "q/p")]
    captures = [(k % 70, rng.choice([*urls, None, "x"]), rng.choice([None, DAY + timedelta(hours=rng.randrange(2400))])) for k in range(120)]
    entries = [
        (rng.choice("lm"), rng.choice(["block", "allow"]), rng.choice(["x.com", "a.x.com", "a.x.com/p", "b.org/q/p", "org", None]),
         rng.choice(["add", "remove"]), rng.choice([None] + [DAY + timedelta(hours=rng.randrange(2400)) for _ in range(6)]))
        for _ in range(150)]
    c = spark.createDataFrame([(*r, "k") for r in captures], CAPTURES).repartition(3)
    e = spark.createDataFrame(entries, ENTRIES)
    got = sorted(((r.page_id, r.url, r.fetched_at, r.n_active, r.matched, r.blocked) for r in url_verdicts(c, e).collect()), key=repr)
    at_once = {(x[:3], x[4]) for x in entries if x[3] == "remove"}
    fixed = [x for x in entries if not (x[3] == "add" and (x[:3], x[4]) in at_once)]
    assert got == sorted(((*r, *brute(r[1], r[2], fixed)) for r in captures), key=repr)


def test_intervals(spark):
    t = [DAY + timedelta(days=k) for k in range(6)]
    rows = [("l", "block", "k", a, t[d]) for d, a in ((0, "remove"), (1, "add"), (2, "add"), (3, "remove"), (3, "add"), (5, "add"))]
    got = validity_intervals(spark.createDataFrame(rows, ENTRIES)).orderBy("valid_from").collect()
    assert [(r.valid_from, r.valid_to) for r in got] == [(t[1], t[3]), (t[5], None)]


def test_empty_tables(spark):
    c = spark.createDataFrame([(1, "http://a/b", DAY, "")], CAPTURES)
    e = spark.createDataFrame([("l", "block", "a", "add", DAY)], ENTRIES)
    assert url_verdicts(c.limit(0), e).collect() == []
    assert [(r.blocked, r.host) for r in url_verdicts(c, e.limit(0)).collect()] == [(False, "a")]
    assert [r.matched for r in url_verdicts(c, e).collect()] == ["a"]
