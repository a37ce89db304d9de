import datetime as dt
import random
import re

from rivulet.llm import url_filter as U

CAP = "page_id bigint, url string, fetched date, verdict string, k string"
ENT = "list string, verdict string, kind string, pattern string, action string, effective date, note string"
D0 = dt.date(2024, 1, 1)


def day(n):
    return None if n is None else D0 + dt.timedelta(days=n)


def keys(url):
    m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", url or "")
    if not m:
        return []
    host = re.sub(r"^www\.|\.$", "", m[1].lower())
    path = [x for x in re.match(r"[^:]+://[^/?#]*([^?#]*)", url)[1].split("/") if x]
    labels = host.split(".")
    return ([("url", re.sub("#.*$", "", url)), ("host", host)] + [("prefix", host + "/" + "/".join(path[:i + 1])) for i in range(len(path))]
            + [("domain", ".".join(labels[i:])) for i in range(max(1, len(labels) - 1))])


def brute(captures, entries):
    state = {}
    for lst, verdict, kind, pattern, action, when in entries:
        if None not in (lst, kind, pattern, action, when):
            removed, v = state.setdefault((lst, kind, pattern), {}).get(when, (False, ""))
            state[(lst, kind, pattern)][when] = (removed or action == "remove", max(v, verdict))
    out = []
    for i, url, when in captures:
        hits = []
        for (lst, kind, pattern), days in state.items():
            past = [d for d in days if when is not None and d <= when]
            if (kind, pattern) in keys(url) and past and not days[max(past)][0]:
                verdict = days[max(past)][1]
                hits.append(((-U.RANK[kind], -len(pattern), verdict != "allow"), (verdict, lst, kind, pattern)))
        best = min(hits)[1] if hits else ("none", None, None, None)
        out.append((i, url, when, *best, len(hits)))
    return sorted(out, key=repr)


def run(spark, captures, entries):
    c = spark.createDataFrame([(*x, "own", "own") for x in captures], CAP)
    e = spark.createDataFrame([(*x, "own") for x in entries], ENT)
    return sorted(map(tuple, U.evaluate(c, e).select("page_id", "url", "fetched", "verdict", "list", "kind", "pattern", "n_active").collect()),
                  key=repr)


def sample(seed):
    r = random.Random(seed)
    hosts = ["a.com", "m.a.com", "x.m.a.com", "b.org", "localhost", "c.co.uk"]
    captures = [(k, f"http://{'www.' if r.random() < .2 else ''}{r.choice(hosts)}{r.choice(['', '/', '/p', '/p/q?x=1', '/p/q#top', '//p//r/'])}",
                 day(r.randrange(40))) for k in range(120)]
    captures += [(1, "http://u:p@A.com:80/p", day(3)), (None, "http://a.com/p", day(9)), (5, None, day(1)), (6, "not a url", day(1)),
                 (7, "", day(2)), (8, "http://a.com/p", None), (9, "http://a.com/p", day(9)), (9, "http://a.com/p", day(9)),
                 (10, "https://a.com/" + "seg/" * 300, day(20))]
    entries = [(r.choice(["l1", "l2", "ok"]), None, *r.choice([("host", "a.com"), ("host", "m.a.com"), ("domain", "a.com"), ("domain", "com"),
                ("domain", "co.uk"), ("prefix", "a.com/p"), ("prefix", "a.com/p/q"), ("url", "http://b.org/p/q?x=1"), ("host", "localhost")]),
                r.choice(["add", "add", "remove"]), day(r.randrange(40))) for _ in range(80)]
    entries = [(lst, "allow" if lst == "ok" else "block", *rest) for lst, _, *rest in entries]
    return captures, entries + entries[:5] + [("l1", "block", None, "a.com", "add", day(1)), ("l1", "block", "host", "b.org", "add", None)]


def test_equals_brute_force(spark):
    for seed in (1, 2):
        captures, entries = sample(seed)
        assert run(spark, captures, entries) == brute(captures, entries)


def test_intervals_open_and_close(spark):
    e = [("l", "block", "host", "a.com", a, day(d)) for a, d in (("add", 1), ("add", 3), ("remove", 5), ("remove", 8), ("add", 9), ("remove", 9))]
    got = U.intervals(spark.createDataFrame([(*x, "own") for x in e], ENT)).orderBy("valid_from").collect()
    assert [(r["valid_from"].date(), r["valid_to"].date()) for r in got] == [(day(1), day(3)), (day(3), day(5))]


def test_empty_tables(spark):
    captures, entries = sample(3)
    assert run(spark, [], entries) == []
    assert {r[3] for r in run(spark, captures, [])} == {"none"}


def test_plan_has_no_python_nor_cross_join(spark):
    captures, entries = sample(1)
    df = U.evaluate(spark.createDataFrame([(*x, "own", "own") for x in captures], CAP), spark.createDataFrame([(*x, "own") for x in entries], ENT))
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", df._jdf.queryExecution().executedPlan().toString())


def test_entries_act_from_their_moment_on(spark):
    """A capture before an entry of the same day takes effect is not touched by it; times meet across buckets."""
    at = lambda d, h, m=0: dt.datetime(2024, 1, d, h, m)
    entries = [("l", "block", "host", "a.com", "add", at(1, 20), "own"), ("l", "block", "host", "a.com", "remove", at(3, 8, 30), "own"),
               ("l", "block", "host", "a.com", "add", at(3, 9), "own")]
    times = [at(1, 8), at(1, 19, 59), at(1, 20), at(2, 5), at(3, 8, 29), at(3, 8, 30), at(3, 8, 59), at(3, 9), at(20, 0)]
    c = spark.createDataFrame([(k, "http://a.com/x", t) for k, t in enumerate(times)], "page_id bigint, url string, fetched timestamp_ntz")
    e = spark.createDataFrame(entries, ENT.replace("effective date", "effective timestamp_ntz"))
    for seconds in (60, 3600, 10 ** 9):
        got = [r["verdict"] for r in U.evaluate(c, e, bucket_seconds=seconds).orderBy("page_id").collect()]
        assert got == ["none", "none", "block", "block", "block", "none", "none", "block", "block"]


def test_times_equal_brute_force(spark):
    r = random.Random(9)
    moment = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=r.randrange(4000))
    captures = [(k, f"http://{r.choice(['a.com', 'm.a.com', 'b.org'])}/p/q", moment()) for k in range(150)]
    entries = [(r.choice(["l1", "l2"]), "block", *r.choice([("host", "a.com"), ("domain", "a.com"), ("prefix", "b.org/p")]),
                r.choice(["add", "remove"]), moment()) for _ in range(60)]
    c = spark.createDataFrame(captures, "page_id bigint, url string, fetched timestamp_ntz")
    e = spark.createDataFrame([(*x, "own") for x in entries], ENT.replace("effective date", "effective timestamp_ntz"))
    got = sorted(map(tuple, U.evaluate(c, e).select("page_id", "url", "fetched", "verdict", "list", "kind", "pattern", "n_active").collect()), key=repr)
    assert got == brute(captures, entries)
