import itertools
import re

from tessera.llm import url_rules as ur
from tessera.llm.queries import op9_association_url_rules

SF = "/root/testdata/sf0.01"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    h = re.split("[/?#]", rest, maxsplit=1)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), h), re.split("[?#]", rest[len(h):], maxsplit=1)[0]


def fixed(h, p):
    fits = [(len(rh + rp), rh + rp, v) for v, rh, rp in ur.RULES if (h == rh or h.endswith("." + rh)) and p.startswith(rp)]
    return max(fits)[1:] if fits else (None, None)


def test_query_equals_brute_force(spark):
    got = {r.page_id: r for r in op9_association_url_rules(spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()
    assert len(got) == len(pages)
    for p in pages:
        h, pa = split(p.url)
        rule, verdict = fixed(h, pa)
        r = got[p.page_id]
        assert (r.host, r.path, r.rule) == (h, pa, rule)
        assert r.verdict == (verdict or ("block" if r.confidence is not None else "allow"))


def test_mined_rules_equal_brute_force(spark):
    urls = [f"http://{'bad' if i % 3 == 0 else 'fine'}.site{i % 2}.net/{'x' if i % 5 else 'y'}/{i}" for i in range(120)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(i, int(not ("bad" in u and "/x/" in u)), 0) for i, u in enumerate(urls)], "doc_id long, quality int, toxic int")
    sets = {r.page_id: frozenset(r.t) for r in ur.parsed(pages).withColumn("t", ur.tokens()).collect()}
    bad = {i for i, u in enumerate(urls) if "bad" in u and "/x/" in u}
    n, hits = {}, {}
    for i, s in sets.items():
        for k in range(1, len(s) + 1):
            for c in itertools.combinations(sorted(s), k):
                n[c] = n.get(c, 0) + 1
                hits[c] = hits.get(c, 0) + (i in bad)
    rules = {c: hits[c] / n[c] for c in n if hits[c] >= ur.SUPPORT and hits[c] / n[c] >= ur.CONFIDENCE}
    rules = {c: v for c, v in rules.items() if not any(len(d) < len(c) and w >= v and set(d) <= set(c) for d, w in rules.items())}
    mined = ur.mine(pages, labels)
    assert {tuple(sorted(r.tokens)): round(r.confidence, 9) for r in mined.collect()} == {c: round(v, 9) for c, v in rules.items()}
    for r in ur.judge(pages, mined).collect():
        want = max([v for c, v in rules.items() if set(c) <= sets[r.page_id]], default=None)
        assert r.confidence == want and (r.verdict == "block") == (want is not None)


def test_edge_rows(spark):
    df = spark.createDataFrame([(1, None, "z"), (1, "nonsense", "z"), (2, "HTTP://A.Example.ORG?x", "z"), (2, "http://Example.org/es/1://y", "z"), (3, "x://com", "z")], "page_id long, url string, host string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rules = ur.mine(df, none)
    got = [(r.host, r.path, r.rule, r.verdict) for r in ur.judge(df, rules).orderBy("page_id", "host").collect()]
    assert got == [("", "", None, "allow")] * 2 + [("a.example.org", "", None, "allow"), ("example.org", "/es/1://y", "example.org/es/", "block"), ("com", "", None, "allow")]
    assert ur.judge(df.limit(0), rules).count() == 0
