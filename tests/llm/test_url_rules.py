"""URL parts, listed rules and mined verdicts against plain Python."""

import time
from itertools import combinations

import __spark_entry__ as contract
from delaycast.llm import url_rules as ur

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    rest = rest[end:]
    return host, rest[: min([rest.index(c) for c in "?#" if c in rest], default=len(rest))]


def plain_rule(host, path):
    fits = [r for r in RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
    return (best[1] + best[2], best[0]) if best else (None, None)


def plain_verdicts(rows, support, confidence):
    """Verdict of each (tokens, listed, label): every subset of tokens is counted."""
    counts = {}
    for tokens, listed, label in rows:
        if listed or label not in (0, 1) or not tokens:
            continue
        for n in range(1, len(tokens) + 1):
            for part in combinations(sorted(tokens), n):
                of = counts.setdefault(part, {"allow": 0, "block": 0})
                of["allow" if label else "block"] += 1
    rules = [
        (n / sum(of.values()), n, -len(part), verdict, set(part))
        for part, of in counts.items()
        for verdict, n in of.items()
        if n >= support and n / sum(of.values()) >= confidence
    ]
    out = []
    for tokens, listed, _ in rows:
        best = max((r for r in rules if r[4] <= set(tokens)), key=lambda r: r[:4], default=None)
        out.append(listed or (best[3] if best else "allow"))
    return out


URLS = [
    "http://A.Example.COM/en/1?page=2#top", "https://www.example.com/en/", "https://x.www.example.com/en/a/b", "http://net/es/", "ftp://m.b.net/fr/3.html",
    "http://b.net/frx", "http://evilnet/es/", "http://example.com", "http://example.com?x=/en/", "HTTP://example.com#/en/", "no scheme", "", None, "://",
    "a://b://c/d", "http:///en/", "http://É.com/ü", "http://com/", "http://xcom/", "http://h.org/" + "s/" * 3000, "http://a.net/es/#?x", "http://it's.com/en/\n",
]


def test_parts_and_listed_rules(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] + [(None, URLS[0], "y"), (0, URLS[0], "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    labels = spark.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id long, quality int")
    found = ur.judge_urls(df, labels, ur.UrlParameters(support=1)).collect()
    expected = sorted(str((r[0], *plain_parts(r[1]), plain_rule(*plain_parts(r[1]))[0])) for r in rows)
    assert sorted(str((r.page_id, r.host, r.path, r.rule)) for r in found) == expected
    for r in found:
        listed = plain_rule(r.host, r.path)[1]
        assert r.verdict in ([listed] if listed else ["allow", "block"])


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "http://a.org/b")], "page_id long, url string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.verdict for r in ur.judge_urls(df, labels).collect()] == ["allow"]
    assert ur.judge_urls(df.limit(0), labels).count() == 0


def test_mined_verdicts_equal_counting_all_subsets(spark):
    hosts = ["a.org", "spam.org", "b.org", "m.c.org"]
    rows = [(i, f"http://{hosts[i % 4]}/{'xy'[i % 3 % 2]}/{i}" + ("?ref=ad" if i % 5 == 0 else "")) for i in range(400)]
    labels = [(i, int(not (i % 4 == 1 or (i % 5 == 0 and i % 3 == 1)))) for i in range(300)]
    df, known = spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int")
    parameters = ur.UrlParameters(support=8, confidence=0.8)
    found = {r.page_id: r.verdict for r in ur.judge_urls(df, known, parameters).collect()}
    parts = ur.judged_parts(df, parameters, "page_id", "url").collect()
    expected = plain_verdicts([(r.tokens, r.listed, dict(labels).get(r.page_id)) for r in parts], 8, 0.8)
    assert [found[r.page_id] for r in parts] == expected
    assert {"allow", "block"} == set(expected)


def test_query_against_brute_force(spark):
    folder = contract.SMOKE_DIR
    frame = contract.queries()["op2_association_rules"](spark, folder)
    assert "Python" not in frame._jdf.queryExecution().toString()
    found = {r.page_id: r for r in frame.collect()}
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    parts = ur.judged_parts(spark.read.parquet(f"{folder}/pages.parquet"), ur.UrlParameters(), "page_id", "url").collect()
    verdicts = plain_verdicts([(r.tokens, r.listed, labels.get(r.page_id)) for r in parts], 20, 0.8)
    assert len(found) == len(pages)
    for part, verdict in zip(parts, verdicts):
        row = found[part.page_id]
        assert (row.host, row.path) == plain_parts(pages[part.page_id])
        assert row.rule == plain_rule(row.host, row.path)[0] and row.verdict == verdict


def test_urls_of_many_arguments_are_one_item(spark):
    many = "&".join(f"a{chr(97 + i)}=x" for i in range(20))
    rows = [(i, f"http://s{i % 3}.org/p?{many}" if i % 2 else f"http://t.org/q?{many[:7]}") for i in range(300)]
    rows += [(1000, f"http://new.org/?{many[-4:]}"), (1001, "http://new.org/?zz=1")]
    labels = [(i, int(i % 2 == 0)) for i in range(300)]
    df, known = spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int")
    started = time.perf_counter()
    found = {r.page_id: r.verdict for r in ur.judge_urls(df, known, ur.UrlParameters(support=10)).collect()}
    assert time.perf_counter() - started < 60
    assert all(found[i] == ("block" if i % 2 else "allow") for i in range(300))
    # One argument stands for the item of all that always came with it.
    assert found[1000] == "block" and found[1001] == "allow"


def test_support_does_not_fall_with_the_table(spark):
    rows = [(i, f"http://h{i % 50}.org/a/{i}") for i in range(3000)] + [(9000 + i, "http://bad.org/x") for i in range(25)]
    rows += [(20_000 + i, "http://x.com/") for i in range(500)]  # a listed rule decides these
    labels = [(i, int(i < 9000)) for i, _ in rows]
    df, known = spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int")
    found = {r.page_id: r.verdict for r in ur.judge_urls(df, known).collect()}
    assert all(v == ("block" if 9000 <= i < 20_000 else "allow") for i, v in found.items())
