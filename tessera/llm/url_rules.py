"""URL filter: fixed host and path rules, and association rules mined by FP-growth.

A URL becomes a set of tokens (scheme, host suffixes, path segments, extension, query keys).
FP-growth mines, over all labelled pages, token combinations that go with a bad label (quality 0
or toxic 1; ``labels.doc_id`` is the page's id). Rules below the least support or confidence are
pruned, and so are rules with a shorter rule of at least their confidence. The rules left form an
inverted index: each stands under its rarest token, URLs meet it by an equi-join on their
tokens, and a rule matches if all its tokens are there. Fixed rules go first.

Everything is DataFrame operations and Spark's FP-growth. URLs are matched once per distinct URL.

Edge cases: a null URL or one without ``://`` has empty host and path, no rule, and verdict allow;
repeated rows stay and get equal verdicts; without bad labels no rule is mined; pages labelled
twice are bad if any label says so.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (verdict, host, path) of the fixed rules; the longest that fits wins.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
#: Labelled pages that must hold a combination, and the least share of bad ones among them.
SUPPORT = 8
CONFIDENCE = 0.6
BAD = "=bad"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def tokens(url: str = "url", h: str = "host", p: str = "path") -> Column:
    """The distinct tokens of a URL."""
    labels = F.split(F.col(h), r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.lit("h:"), F.array_join(F.slice(labels, i, n), ".")))
    parts = F.filter(F.split(F.col(p), "/"), lambda x: x != "")
    query = F.split(F.regexp_extract(F.col(url), r"\?([^#]*)", 1), "&")
    return F.array_distinct(F.concat(
        F.array(F.concat(F.lit("s:"), F.lower(F.regexp_extract(F.col(url), r"(?s)^(.*?)://", 1)))), suffixes,
        F.transform(parts, lambda x: F.concat(F.lit("p:"), x)),
        F.transform(F.filter(query, lambda x: x != ""), lambda x: F.concat(F.lit("q:"), F.split(x, "=")[0])),
        F.transform(F.filter(F.array(F.regexp_extract(F.col(p), r"\.(\w{1,5})$", 1)), lambda x: x != ""), lambda x: F.concat(F.lit("x:"), x))))


def parsed(pages: DataFrame) -> DataFrame:
    return pages.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})


def mine(pages: DataFrame, labels: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """Pruned rules: tokens, anchor (the rarest token), confidence."""
    marks = (labels.where("doc_id is not null and (quality is not null or toxic is not null)").groupBy(F.col("doc_id").alias("page_id"))
             .agg(F.max(F.expr("coalesce(quality = 0, false) or coalesce(toxic = 1, false)")).alias("bad")))
    sets = (parsed(pages.select("page_id", "url").where("url like '%://%'")).join(marks, "page_id")
            .select(F.when(F.col("bad"), F.concat(tokens(), F.array(F.lit(BAD)))).otherwise(tokens()).alias("items")))
    n = sets.count()
    empty = pages.sparkSession.createDataFrame([], "tokens array<string>, anchor string, confidence double")
    if not n:
        return empty
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, support / n), minConfidence=0.0).fit(sets)
    sets_of = model.freqItemsets.withColumn("items", F.sort_array("items"))
    bad = sets_of.where(F.array_contains("items", BAD) & (F.size("items") > 1)).select(F.array_remove("items", BAD).alias("tokens"), F.col("freq").alias("hits"))
    rules = (bad.join(sets_of.select(F.col("items").alias("tokens"), "freq"), "tokens").select("tokens", (F.col("hits") / F.col("freq")).alias("confidence"))
             .where(F.col("confidence") >= confidence))
    # a rule falls if a shorter one, found under its least token, is as sure
    shorter = rules.select(F.array_min("tokens").alias("key"), F.col("tokens").alias("part"), F.col("confidence").alias("sure"))
    beaten = (rules.withColumn("key", F.explode("tokens")).join(shorter, "key")
              .where((F.size("part") < F.size("tokens")) & (F.col("sure") >= F.col("confidence")) & (F.size(F.array_except("part", "tokens")) == 0))
              .select("tokens").distinct())
    single = sets_of.where(F.size("items") == 1).select(F.col("items")[0].alias("anchor"), "freq")
    anchors = (rules.join(beaten, "tokens", "left_anti").withColumn("anchor", F.explode("tokens")).join(single, "anchor")
               .groupBy("tokens", "confidence").agg(F.min(F.struct("freq", "anchor")).alias("low")))
    return anchors.select("tokens", F.col("low.anchor").alias("anchor"), "confidence")


def judge(pages: DataFrame, rules: DataFrame, fixed=RULES) -> DataFrame:
    """``pages`` with host, path, rule, verdict and ``confidence`` of the best mined rule."""
    kept = pages.drop("host", "path", "rule", "verdict", "confidence")
    urls = parsed(kept.select("url").where("url like '%://%'").distinct()).withColumn("tokens", tokens())
    index = rules.select("anchor", F.col("tokens").alias("needs"), F.col("confidence").alias("sure"))
    best = (urls.select("url", "tokens", F.explode("tokens").alias("anchor")).join(index, "anchor")
            .where(F.size(F.array_except("needs", "tokens")) == 0).groupBy("url").agg(F.max("sure").alias("confidence")))
    out = parsed(kept.join(best, "url", "left"))
    rule, verdict = F.lit(None).cast("string"), F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
    for v, h, p in sorted(fixed, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return out.withColumns({"rule": rule, "verdict": verdict})
