import html as entities
import re

from tessera.llm.html import RUN, blocks, extract
from tessera.llm.queries import op7_host_suffix_array

SF = "/root/testdata/sf0.01"


def test_query_gives_the_article(spark):
    got = {r.page_id: r for r in op7_host_suffix_array(spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        body = re.search(r"<article>(.*)</article>", p.html, re.S)[1]
        want = " ".join(entities.unescape(re.sub(r"</?(?:b|i|em|a)\b[^>]*>", "", re.sub(r"</?(?!(?:b|i|em|a)\b)[a-z][^>]*>", " ", body))).split())
        r = got[p.page_id]
        assert r.text == want and r.n_chars == len(want) and r.url == p.url


def test_blocks():
    page = """<html><head><title>t</title></head><body><header>top</header><nav><ul><li>x</ul></nav><div class="cookie-notice">c</div>
    <main><h1>A &amp; B</h1><p>one<b>two</b> <i>three</i><br>four<p>five <script>"</main>"</script><div id='comments'><p>no</div>
    <aside>s</aside><form>f</form><section>si&#120; < 7</section></main><footer>foot</footer></body></html>"""
    assert " ".join(blocks(page)[0]) == "A & B onetwo three four five six < 7"
    assert blocks("")[0] == [] and blocks("<p>a<!-- b")[1] == ["a"] and blocks("a <b c")[1] == ["a <b c"]
    assert blocks("<article>a<div class=ad>x</article>b")[:2] == (["a"], ["b"])


def test_repeated_runs_equal_brute_force(spark):
    line = "please read our terms and the rules of this site before use"
    rows = [(i, f"http://h{i % 2}.net/{i}", f"<div>{line if i < 6 else ''}</div><p>unique words number {i} and " + " ".join(f"w{i * 7 + k}" for k in range(12)) + f"</p><div>{line if i % 2 else 'short one'}</div>") for i in range(9)]
    rows += [rows[0], (50, None, None), (51, "http://h0.net/", ""), (52, "http://h7.net/a", rows[0][2])]
    got = sorted((r.page_id, r.text) for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    streams = {(i, u): " ".join(blocks(h or "")[1]).split() for i, u, h in rows}
    site = {k: re.sub(r".*://([^/]*).*", r"\1", k[1] or "") for k in streams}
    grams = {k: [tuple(t[j:j + RUN]) for j in range(len(t) - RUN + 1)] for k, t in streams.items()}
    want = []
    for i, u, _ in rows:
        k, gone = (i, u), set()
        for j, g in enumerate(grams[k]):
            if any(g in grams[o] for o in grams if o != k and site[o] == site[k]):
                gone |= set(range(j, j + RUN))
        want.append((i, " ".join(t for j, t in enumerate(streams[k]) if j not in gone)))
    assert got == sorted(want) and any("terms" not in t for _, t in want)


def test_empty_table(spark):
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
