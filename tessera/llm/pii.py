"""Personal data: candidate spans, boosted trees, calibrated thresholds.

Base spans follow fixed patterns and always stay. Besides them, high-recall generators propose
overlapping spans (spelled-out e-mail addresses, defanged addresses of hosts, numbers with any
separators). Boosted trees judge each from its format and its context; a calibrated threshold
for each kind selects what is added. Where chosen spans overlap, the likelier one stays.

No table marks personal data, so the trees learn from the corpus itself: base spans, and the same
spans rewritten the way people disguise them, are positive; proposals that fail the kind's own
check (Luhn sum, parts over 255, digits), and base spans spoiled so that they fail, are negative.
The sample is bounded by ``SAMPLE`` distinct texts with candidates and ``ROWS`` feature rows (least hash first),
so copies of a text count once and a very long text brings no more than its share.

Edge cases: null and empty texts have no spans (base_sha256 is the hash of no bytes); repeated
rows give repeated results; spans starting together are ordered by kind; without any candidate
to learn from nothing is added.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.boosting import BoostedTrees
from tessera.llm.common import bounded_batches, release, with_columns

KINDS = ("email", "ip", "card", "phone")
#: Distinct texts with candidates that the trees learn from, at most, and feature rows made of them.
SAMPLE = 4000
ROWS = 200_000
#: Share of chosen proposals that must be right on the calibration rows.
PRECISION = 0.98

# Base patterns (fixed values). The e-mail's local part is found leftwards from each "@".
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    d = [int(c) for c in reversed(digits)]
    return sum(d[::2]) % 10 + sum(sum(divmod(2 * x, 10)) for x in d[1::2]) % 10 in (0, 10)


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def valid_ip(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the fixed patterns, leftmost and without overlap within a kind, in order."""
    out = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at - (len(head := text[done:at]) - len(head.rstrip(_LOCAL)))
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end(), "email"))
        done = m.end() if m else at + 1
        at = text.find("@", done)
    out += [(m.start(), m.end(), "ip") for m in _IP.finditer(text) if valid_ip(m[0])]
    out += [(m.start(), m.end(), "card") for m in _CARD.finditer(text) if 14 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    if "+" in text:
        out += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


# Proposals: each pattern starts at a rare sign and is bounded, so no text makes them slow.
_AT = r"[ ]?[\[({]?[ ]?(?:at|AT|@)[ ]?[\])}]?[ ]?"
_DOT = r"(?:[ ]?[\[({]?[ ]?(?:dot|DOT)[ ]?[\])}]?[ ]?|[ ]?[\[({]?\.[\])}]?[ ]?)"
_SPELLED = re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,40}}(?:[ ]?[\[({{][ ]?(?:at|AT|@)[ ]?[\])}}][ ]?|[ ](?:at|AT|@)[ ])[A-Za-z0-9-]{{1,40}}(?:{_DOT}[A-Za-z0-9-]{{2,24}}){{1,3}}(?![A-Za-z0-9])")
_DEFANGED = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:[ ]?(?:\[\.\]|\(\.\)|\[dot\]|\(dot\)|dot|\.)[ ]?[0-9]{1,3}){3}(?![0-9])")
_NUMBER = re.compile(r"(?<![0-9])[+(]{0,2}[0-9](?:[ ().\-/_]{0,3}[0-9]){6,24}(?![0-9])")


def proposals(text: str) -> list[tuple[int, int, str]]:
    """Overlapping candidate spans with the kind each could be."""
    out = []
    if "@" in text or " at " in text or "at]" in text or "at)" in text or "at}" in text or " AT" in text or "AT]" in text:
        out += [(m.start(), m.end(), "email") for m in _SPELLED.finditer(text)]
    out += [(m.start(), m.end(), "ip") for m in _DEFANGED.finditer(text)]
    for m in _NUMBER.finditer(text):
        n = len(_digits(m[0]))
        if 13 <= n <= 19:
            out.append((m.start(), m.end(), "card"))
        if 8 <= n <= 15:
            out.append((m.start(), m.end(), "phone"))
    return out


_CONTEXT = [re.compile(p, re.I) for p in (r"mail|contact|write|courriel|correo", r"tel|phone|call|fax|mobile|appel|anruf", r"card|visa|master|pay|karte|carte|tarjeta", r"\bip\b|host|server|addr", r"order|invoice|id|no\.|number|token|hash|ref")]


def features(text: str, span: tuple[int, int, str]) -> list[float]:
    """Format of the span and what stands around it."""
    a, b, kind = span
    s, before, after = text[a:b], text[max(0, a - 24):a], text[b:b + 8]
    d = _digits(s)
    groups = re.findall(r"[0-9]+", s)
    seps = re.findall(r"[^0-9A-Za-z]+", s)
    last = re.findall(r"[A-Za-z0-9-]+", s)[-1:]
    return [
        *(kind == k for k in KINDS), len(s), len(d), len(groups), max(map(len, groups), default=0), len(groups[0]) if groups else 0, len(groups[-1]) if groups else 0,
        len(d) > 1 and luhn(d), all(len(g) <= 3 and int(g) <= 255 for g in groups), int(d[0]) if d else -1,
        s[:1] == "+", "(" in s, len(set(seps)), len(seps), sum(c in ".-/" for c in s), sum(c.isalpha() for c in s),
        "@" in s, bool(re.search(r"at|AT", s)), bool(re.search(r"dot|DOT", s)), bool(re.search(r"[\[({]", s)), len(last[0]) if last else 0, bool(last and last[0].isalpha()),
        before[-1:].isalnum(), before[-1:].isspace() or not before, after[:1].isalnum(), after[:1].isspace() or not after, sum(c.isdigit() for c in before + after),
        *(bool(p.search(before)) for p in _CONTEXT),
    ]


def _union(spans: list) -> list[tuple[int, int]]:
    """The stretches that sorted spans cover, apart from each other."""
    out: list[tuple[int, int]] = []
    for a, b, *_ in spans:
        if out and a < out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def _overlaps(apart: list, a: int, b: int) -> bool:
    """Does [a, b) meet one of the sorted spans, none of which overlap? Only the last that starts before b can."""
    i = bisect_left(apart, (b,))
    return i > 0 and apart[i - 1][1] > a


def _disguised(s: str, kind: str, rng: random.Random) -> str:
    """A base span as people rewrite it."""
    if kind == "email":
        at, dot = rng.choice([(" at ", " dot "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", "."), (" AT ", " DOT "), (" @ ", ".")])
        user, _, host = s.partition("@")
        user = (re.sub("[0-9]+", "", user).strip("._-+%") or user) if rng.random() < 0.5 else user
        return user + at + host.replace(".", dot)
    if kind == "ip":
        return s.replace(".", rng.choice(["[.]", "(.)", " dot ", "[dot]", " . "]))
    sep = rng.choice(" .-/_")
    d = _digits(s)
    if kind == "card":
        return sep.join(d[i:i + 4] for i in range(0, len(d), 4))
    d = d[-10:] if rng.random() < 0.5 else d
    cut = len(d) - 10
    return rng.choice([sep.join(x for x in (d[:cut], d[cut:cut + 3], d[cut + 3:cut + 6], d[cut + 6:]) if x), f"({d[cut:cut + 3]}) {d[cut + 3:cut + 6]}-{d[cut + 6:]}", "00" + s[1:]])


def _spoiled(s: str, kind: str, rng: random.Random) -> str:
    """A look-alike that isn't personal data."""
    if kind == "email":
        user, _, host = s.partition("@")
        place, *rest = re.findall("[A-Za-z]+", host) or ["home"]
        return f"{re.sub('[^A-Za-z]', '', user) or 'we'} at {place}{rng.choice(['. ', ' . '])}{(rest or ['then'])[0].capitalize()}"
    if kind == "ip":
        return ".".join(str(int(p.lstrip("0") or 0) + rng.choice([0, 256, 400])) for p in s.split("."))
    if kind == "card":
        i = rng.randrange(len(s))
        while not s[i].isdigit():
            i = rng.randrange(len(s))
        return s[:i] + str((int(s[i]) + rng.randrange(1, 10)) % 10) + s[i + 1:]
    years = rng.choice([" ", "-", "/"]).join(str(rng.randrange(1900, 2030)) for _ in range(rng.choice([2, 3])))
    return rng.choice([_digits(s)[:rng.choice([8, 9])], str(rng.randrange(10 ** 7, 10 ** rng.randrange(8, 15))), years])


def training_rows(t: str, seed: int) -> tuple[list[list[float]], list[int]]:
    """Features and marks of one text's candidates, disguised and spoiled ones included."""
    rng, x, y = random.Random(seed), [], []

    def add(text: str, mark: int, span: tuple[int, int, str]) -> None:
        x.append(features(text, span))
        y.append(mark)

    base = base_spans(t)
    for a, b, kind in base:
        add(t, 1, (a, b, kind))
        for change, mark in ((_disguised, 1), (_spoiled, 0)) * 4:
            s = change(t[a:b], kind, rng)
            near = t[max(0, a - 60):a] + s + t[b:b + 60]
            at = min(a, 60)
            for span in proposals(near):
                if span[0] <= at + 2 and span[1] >= at + len(s) - 2 and (span[2] == kind or not mark):
                    right = mark and (kind != "card" or luhn(_digits(s)))
                    add(near, int(right), span)
    apart = _union(base)
    for span in proposals(t):
        if not _overlaps(apart, span[0], span[1]):
            add(t, 0, span)
    return x, y


class SpanModel:
    """Boosted trees with one threshold for each kind."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        order = np.random.default_rng(3).permutation(len(y))
        fit, held = order[:len(y) * 2 // 3], order[len(y) * 2 // 3:]
        self.trees, self.least = None, {}
        if min(y[fit].sum(), len(fit) - y[fit].sum()) < 20 or min(y[held].sum(), len(held) - y[held].sum()) < 10:
            return
        self.trees = BoostedTrees().fit(x[fit], y[fit]).calibrate(x[held], y[held])
        p = self.trees.probability(x[held])
        for k, kind in enumerate(KINDS):
            mine = x[held][:, k] > 0
            for cut in np.arange(0.5, 1, 0.02):
                chosen = mine & (p >= cut)
                if chosen.sum() >= 5 and y[held][chosen].mean() >= PRECISION:
                    self.least[kind] = float(cut)
                    break

    def added(self, text: str, base: list) -> list[tuple[int, int, str, float]]:
        """Chosen proposals that meet neither a base span nor a likelier proposal."""
        if not self.least:
            return []
        apart = _union(base)
        spans = [s for s in dict.fromkeys(proposals(text)) if s[2] in self.least and not _overlaps(apart, s[0], s[1])]
        if not spans:
            return []
        p = self.trees.probability(np.array([features(text, s) for s in spans], float))
        taken: list = []
        for (a, b, kind), q in sorted(zip(spans, p.tolist()), key=lambda r: (-r[1], r[0])):
            if q >= self.least[kind] and not _overlaps(taken, a, b):
                taken.insert(bisect_left(taken, (a,)), (a, b, kind, q))
        return taken


def fit(docs: DataFrame, text: str = "text", sample: int = SAMPLE, rows: int = ROWS) -> SpanModel:
    """The model, from a bounded sample of the distinct texts that hold digits or an at-sign. Tasks make
    the sample's features; at most ``rows`` of them reach the driver."""
    some = docs.where(F.col(text).rlike("[0-9]{4}|@")).select(F.col(text).alias("_t"), F.xxhash64(text).alias("_h"))
    chosen = some.select(F.col("_h").alias("_chosen")).distinct().orderBy("_chosen").limit(sample)
    # at most ``sample`` numbers are broadcast; copies give one row
    texts = some.join(F.broadcast(chosen), F.col("_h") == F.col("_chosen"), "left_semi").groupBy("_h").agg(F.first("_t").alias("_t"))

    def run(batches):
        for batch in batches:
            for t, h in zip(batch.column("_t").to_pylist(), batch.column("_h").to_pylist()):
                x, y = training_rows(t, h)
                if x:
                    yield pa.RecordBatch.from_arrays([pa.array([h] * len(x)), pa.array(range(len(x)), pa.int64()), pa.array(x, pa.list_(pa.float64())), pa.array(y, pa.float64())], ["h", "n", "x", "y"])
        release()

    bounded_batches(docs.sparkSession)
    made = texts.mapInArrow(run, "h long, n long, x array<double>, y double")
    got = made.orderBy(F.xxhash64("h", "n"), "h", "n").limit(rows).toPandas().sort_values(["h", "n"])
    return SpanModel(np.array(got["x"].tolist(), float).reshape(len(got), -1 if len(got) else 0), got["y"].to_numpy(float))


def _listed(spans: list) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k, *_ in spans)


def find(docs: DataFrame, model: SpanModel, text: str = "text", redact: bool = False) -> DataFrame:
    """``docs`` with the counts and hash of base spans and all chosen spans; with ``redact``
    also ``redacted``: the text with each stretch of chosen spans replaced by its first kind."""
    def make():
        def run(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {n: [] for n in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "redacted")}
            for t in batch.column(text).to_pylist():
                t = t or ""
                base = base_spans(t)
                spans = sorted([(a, b, k, 1.0) for a, b, k in base] + model.added(t, base), key=lambda s: (s[0], KINDS.index(s[2])))
                for k in KINDS:
                    out[f"n_{k}"].append(sum(s[2] == k for s in base))
                out["base_sha256"].append(hashlib.sha256(_listed(base).encode()).hexdigest())
                out["spans"].append(_listed(spans))
                out["redacted"].append(redacted(t, spans) if redact else None)
            return out
        return run

    return with_columns(docs, "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string" + ", redacted string" * redact, make)


def redacted(text: str, spans: list) -> str:
    out, done = [], 0
    for a, b, kind, *_ in spans:
        if a >= done:
            out += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, b)
    return "".join(out) + text[done:]
