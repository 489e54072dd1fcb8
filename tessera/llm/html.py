"""Main text of web pages: structure, and a suffix array over each host's pages.

A page is cut into blocks. Blocks in menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and comments are chrome (by element, role, class or id). The text of an ``article``
or ``main`` element, without chrome, is the main text and stays whole: copies of an article under
other URLs repeat across pages, so repetition is no evidence there. The other text of all
pages of a host forms one token stream; its suffixes are ordered by their first ``RUN`` tokens,
and suffixes that agree there on two distinct pages are long repeated substrings. In pages
without such an element the tokens covered by them are boilerplate, and unique runs are kept.

The suffix array is cut at ``RUN`` tokens (a longer repeat is the union of its shorter ones), so
ordering is one grouping by (host, first tokens), combined on the map side: neither a large host
nor a very common line is one task's group.

Edge cases: null and empty html give empty text; a null URL belongs to the host ''; rows that
repeat a page are not distinct pages; broken markup is read as far as it goes (an end tag closes
all that was opened inside it; a lone ``<`` is text).
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import shingle_hashes, stage, with_columns, word_hashes
from tessera.llm.url_rules import host

#: Tokens that a repeated substring must have.
RUN = 8

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)([^>\"']*+(?:\"[^\"]*+\"[^>\"']*+|'[^']*+'[^>\"']*+)*+)>", re.S)
_ATTR = re.compile(r"(class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes", "iframe"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike",
           "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
_SELF_CLOSING = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}
_CHROME = {"nav", "footer", "aside", "form", "noscript", "template", "head", "menu", "button", "select", "dialog", "svg", "object", "canvas", "fieldset"} | _RAW
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "form", "menu", "menubar"}
_NAMES = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|menu|nav|navbar|navigation|breadcrumbs?|sidebar|footer|site-header|page-header|header"
                    r"|masthead|topbar|comments?|disqus|replies|related|share|sharing|social|newsletter|subscribe|popup|modal|widget|pager|pagination)(?:$|[\s_-])", re.I)


def _is_chrome(tag: str, attrs: str, inside: bool) -> bool:
    if tag in _CHROME or tag == "header" and not inside:
        return True
    if tag in ("article", "main", "body", "html") or "=" not in attrs:
        return False
    for m in _ATTR.finditer(attrs):
        value = m[2] or m[3] or m[4] or ""
        if m[1].lower() == "role" and value.lower() in _ROLES or m[1].lower() in ("class", "id") and _NAMES.search(value):
            return True
    return False


def blocks(page: str) -> tuple[list[str], list[str], bool, list[str]]:
    """(main blocks, other unmarked blocks, does a main element exist, chrome blocks), in page order."""
    main, other, chrome = [], [], []
    stack: list[tuple[str, int]] = []  # open elements; 1: chrome begins, 2: main begins
    opened: dict[str, int] = {}
    hidden = inside = 0
    exists = False
    run: list[str] = []

    def close() -> None:
        text = " ".join(entities.unescape("".join(run)).split())
        run.clear()
        if text:
            (chrome if hidden else main if inside else other).append(text)

    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        run.append(page[at:m.start() if m else end])
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        tag, closing = m[2].lower(), m[1]
        if tag not in _INLINE:
            close()
        if closing:
            if opened.get(tag):
                if tag in _INLINE:  # an inline end tag closes its own element only
                    i = len(stack) - 1
                    while stack[i][0] != tag:
                        i -= 1
                    if not stack[i][1]:
                        del stack[i]
                        opened[tag] -= 1
                        continue
                    close()
                while True:
                    t, mark = stack.pop()
                    opened[t] -= 1
                    hidden -= mark == 1
                    inside -= mark == 2
                    if t == tag:
                        break
            continue
        if tag in _RAW:  # raw text up to its end tag; never shown as markup
            stop = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            at = stop.start() if stop else end
            if stop:
                at = page.find(">", at) + 1 or end
            continue
        if tag in _VOID or m[3].endswith("/"):
            continue
        mark = 1 if _is_chrome(tag, m[3], inside > 0) else 2 if tag in ("article", "main") or "role" in m[3] and re.search(r"role\s*=\s*[\"']?main\b", m[3]) else 0
        if mark and tag in _INLINE:
            close()
        hidden += mark == 1
        inside += mark == 2
        exists |= mark == 2 and not hidden
        if tag in _SELF_CLOSING and stack and stack[-1] == (tag, 0):
            stack.pop()
            opened[tag] -= 1
        stack.append((tag, mark))
        opened[tag] = opened.get(tag, 0) + 1
    close()
    return main, other, exists, chrome


def _prefixes(tokens: list[str], run: int) -> np.ndarray:
    """Hashes of the first ``run`` tokens of every suffix that has so many."""
    return shingle_hashes(word_hashes([t.encode("utf-8", "replace") for t in tokens]), run).view(np.int64) if len(tokens) >= run else np.empty(0, np.int64)


def extract(pages: DataFrame, run: int = RUN) -> DataFrame:
    """``pages`` (page_id, url, html) with ``text`` and ``n_chars``; html is dropped."""
    pages = pages.withColumns({"site": host(F.col("url")), "page_key": F.xxhash64("page_id", "url", "html")})

    def make():
        def parse(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {"text": [], "open_blocks": [], "suffixes": []}
            for h in batch.column("html").to_pylist():
                main, other, exists, chrome = blocks(h or "")
                out["text"].append(" ".join(main) if exists else None)
                out["open_blocks"].append(None if exists else other)
                out["suffixes"].append(_prefixes(" ".join([*other, *chrome]).split(), run).tolist())
            return out
        return parse

    read = stage(with_columns(pages, "text string, open_blocks array<string>, suffixes array<long>", make).drop("html", "n_chars"), "blocks")
    suffix = read.select("site", "page_key", F.explode("suffixes").alias("prefix"))
    repeated = suffix.groupBy("site", "prefix").agg(F.min("page_key").alias("a"), F.max("page_key").alias("b")).where("a < b").select("site", "prefix")
    whole = read.where("text is not null").select(*[c for c in read.columns if c not in ("open_blocks", "suffixes")])
    loose = read.where("text is null")
    covered = (loose.select("site", "page_key", F.explode("suffixes").alias("prefix")).distinct().join(repeated, ["site", "prefix"])
               .groupBy("page_key").agg(F.collect_set("prefix").alias("covered")))

    def make_unique():
        def keep(batch: pa.RecordBatch) -> dict:
            texts = []
            for parts, seen in zip(batch.column("open_blocks").to_pylist(), batch.column("covered").to_pylist()):
                tokens = " ".join(parts or []).split()
                cover = np.zeros(len(tokens) + 1, np.int64)
                hits = np.flatnonzero(np.isin(_prefixes(tokens, run), np.array(seen or [], np.int64)))
                np.add.at(cover, hits, 1)
                np.add.at(cover, hits + run, -1)
                texts.append(" ".join(t for t, c in zip(tokens, np.cumsum(cover)) if not c))
            return {"text": texts}
        return keep

    unique = with_columns(loose.join(covered, "page_key", "left").drop("text"), "text string", make_unique).select(*whole.columns)
    return whole.unionByName(unique).drop("site", "page_key").withColumn("n_chars", F.char_length("text").cast("long"))
