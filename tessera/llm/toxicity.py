"""Toxicity by noisy-channel deobfuscation.

1. A character 4-gram model over folded letters (a-z and a word boundary) is counted over all
   documents. Its cells are bounded by the alphabet (27^4), so the table is broadcast.
2. Suspicious stretches (signs or digits among letters, letters spelled apart, letters repeated)
   become lattices: each character may stand for several letters, for a separator, or for
   nothing; a star may stand for any letter. Viterbi decoding under the model, over all states,
   gives the likeliest letters; other text stays.
3. The restored words are scored: word and prefix log-odds from labelled rows, the document's
   strongest words and their share, and a logistic regression over these few figures.

Labels are learned only from rows outside fold 0, from at most ``SAMPLE`` labelled rows (least
hash of the id first), one text an id: repeated rows of an id neither weigh more nor lengthen the
sample. Labels, language, source and ids are never inputs of a score.

Edge cases: null and empty texts have no words and get the score of a document without evidence;
documents labelled twice count as toxic if any label says so; null labels and ids are ignored;
without labels of both kinds every score is the share of toxic labels (0 without any).
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fold, stage, with_columns

#: Labelled rows learned from, at most.
SAMPLE = 40_000
#: Toxic documents that must hold a word or prefix before it is evidence.
SUPPORT = 4
#: Log-odds from which a word counts as strong.
STRONG = 2.5

SIZE = 27  # boundary, a-z
_CODE = np.zeros(256, np.int64)
_CODE[97:123] = np.arange(1, 27)

# What a sign may stand for (fixed values), with log-probabilities of the channel.
_LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "*": "abcdefghijklmnopqrstuvwxyz"}
_SEPARATORS = " .-_~"
_KEEP, _SWAP, _WILD, _DROP, _BREAK, _SINGLE, _DOUBLE, _HALVE = -0.05, -1.0, -2.5, -5.0, -3.0, -0.7, -1.2, -9.0
#: Stars or states from which decoding works on arrays of states; steps between saved scores.
_STARS, _MANY, _SAVED = 2, 64, 256
#: Stars at the end of a stretch up to which the best endings of all states are remembered.
_ENDING = 64

_TRACE = re.compile(r"[a-z][0-9@$!|+*]|[0-9@$!|+*][a-z]|([a-z])\1\1|(?<![a-z])[a-z][ .\-_~]{1,2}[a-z][ .\-_~]{1,2}[a-z](?![a-z])")
_RUN = re.compile(r"[a-z0-9@$!|+*]+")
_APART = re.compile(r"[a-z](?:[ .\-_~]{1,2}[a-z](?![a-z]))+")


def folded(text: str) -> str:
    """Lower case, accents removed, other signs outside ASCII dropped."""
    text = text.lower()
    return text if text.isascii() else unicodedata.normalize("NFD", text).encode("ascii", "ignore").decode()


# ---- character model ---------------------------------------------------------------------

def count_characters(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Counts of letter 4-grams over all documents (an array of 27^4 cells)."""
    def grams(joined: str) -> np.ndarray:
        c = _CODE[np.frombuffer(joined.encode(), np.uint8)]
        return np.bincount(((c[:-3] * SIZE + c[1:-2]) * SIZE + c[2:-1]) * SIZE + c[3:], minlength=SIZE ** 4)

    def run(batches):
        total, pending, size = np.zeros(SIZE ** 4, np.int64), [], 0
        for batch in batches:
            for t in batch.column(0):
                if t := t.as_py():
                    pending.append(f"   {folded(t)} ")
                    size += len(t)
                if size > 1_000_000:
                    total += grams("".join(pending))
                    pending, size = [], 0
        total += grams("".join(pending))
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], ["cell", "n"])

    rows = docs.select(text).mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(SIZE ** 4, np.int64)
    out[rows["cell"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out


def log_model(counts: np.ndarray) -> np.ndarray:
    """log P(letter | three before), each order smoothed by the one below (Witten-Bell)."""
    c = counts.reshape((SIZE,) * 4).astype(float)
    p = np.full(SIZE, 1 / SIZE)
    for order in (3, 2, 1, 0):
        n = c.sum(axis=tuple(range(order)))
        total, kinds = n.sum(-1, keepdims=True), (n > 0).sum(-1, keepdims=True)
        p = np.where(total > 0, (n + kinds * p) / np.maximum(total + kinds, 1), p)
    return np.log(p).astype(np.float32).reshape(-1, SIZE)


# ---- decoding ----------------------------------------------------------------------------

def lattice(stretch: str) -> list[list[tuple[str, float]]]:
    """For each character or run of one letter: the strings it may stand for."""
    out = []
    body = len(stretch.rstrip("!"))  # exclamation marks at the end may as well be what they are
    for m in re.finditer(r"(.)\1*", stretch):
        ch, n = m[1], len(m[0])
        if "a" <= ch <= "z":
            out.append([(ch, _KEEP)] if n == 1 else [(ch * 2, _KEEP), (ch, _HALVE)] if n == 2 else [(ch, _SINGLE), (ch * 2, _DOUBLE)])
        elif ch in _SEPARATORS:
            out.append([("", _KEEP), (" ", _BREAK)])
        else:
            cost = _WILD if ch == "*" else _SWAP
            out += [[(x, cost) for x in _LEET[ch]] + [("", _SWAP if m.start() >= body else _DROP)]] * n
    return out


class Decoder:
    """Viterbi decoding of suspicious stretches; what was decoded is remembered per task."""

    def __init__(self, model: np.ndarray):
        self.model, self.known = np.asarray(model, np.float64), {}
        self.endings = [self.model[:, 0]]  # by stars still to come: the best score from each state to the end

    def decode(self, stretch: str) -> str:
        if stretch not in self.known:
            if len(self.known) > 200_000:
                self.known = {}
            self.known[stretch] = self._viterbi(stretch)
        return self.known[stretch]

    def _ending(self, stars: int) -> np.ndarray:
        """For each state, the best score of that many stars and the end of the stretch. It does not
        depend on what stands before them, so it is worked out once for all stretches."""
        while len(self.endings) <= stars:
            after = self.endings[-1]
            # the state after a letter forgets the oldest of the three: rows repeat every SIZE^2 states
            letters = self.model[:, 1:] + np.tile(after.reshape(-1, SIZE)[:, 1:], (SIZE, 1))
            self.endings.append(np.maximum(after + _DROP, letters.max(1) + _WILD))
        return self.endings[stars]

    def _ended(self, beam: dict, stars: int) -> str:
        """The best path of ``beam`` with its best ending, followed forwards."""
        best = self._ending(stars)
        at = max(beam, key=lambda x: beam[x][0] + best[x])
        chain, out, tail = beam[at][1], [], []
        while chain:
            chain, ch = chain
            out.append(ch)
        for left in reversed(range(stars)):
            after = self.endings[left]
            to = at % (SIZE * SIZE) * SIZE
            scores = self.model[at, 1:] + after[to + 1:to + SIZE] + _WILD
            code = int(scores.argmax())
            if scores[code] >= after[at] + _DROP:
                tail.append(chr(97 + code))
                at = to + code + 1
        return ("".join(reversed(out)) + "".join(tail)).strip()

    def _viterbi(self, stretch: str) -> str:
        body = stretch.rstrip("*")
        stars = len(stretch) - len(body)
        if body.count("*") >= _STARS or stars > _ENDING:
            return self._all_states(stretch)
        model, square = self.model, SIZE * SIZE
        beam = {0: (0.0, None)}  # last three letters -> log-probability, back-pointer chain
        # stars at the end are not walked through: their best endings are known for every state
        for choices in lattice(stretch)[:-stars] if stars else [*lattice(stretch), [(" ", 0.0)]]:
            new: dict = {}
            for state, (score, back) in beam.items():
                for letters, cost in choices:
                    s, at, chain = score + cost, state, back
                    for ch in letters:
                        code = 0 if ch == " " else ord(ch) - 96
                        s += float(model[at, code])
                        at = at % square * SIZE + code
                        chain = (chain, ch)
                    if at not in new or s > new[at][0]:
                        new[at] = (s, chain)
            if len(new) >= _MANY:
                return self._all_states(stretch)
            beam = new
        if stars:
            return self._ended(beam, stars)
        chain, out = max(beam.values(), key=lambda x: x[0])[1], []
        while chain:
            chain, ch = chain
            out.append(ch)
        return "".join(reversed(out)).strip()

    def _pushed(self, at: np.ndarray, score: np.ndarray, letters: str, cost: float) -> tuple[np.ndarray, np.ndarray]:
        s = score + cost
        for ch in letters:
            code = 0 if ch == " " else ord(ch) - 96
            s, at = s + self.model[at, code], at % (SIZE * SIZE) * SIZE + code
        return at, s

    def _step(self, at: np.ndarray, score: np.ndarray, choices: list[tuple[str, float]]) -> tuple[np.ndarray, np.ndarray]:
        """The states reached by one step, and the best score of each."""
        if len(at) == len(choices) == 1:
            return self._pushed(at, score, *choices[0])
        new = np.full(SIZE ** 3, -np.inf)
        if len(choices) == SIZE:  # a star: any letter at one cost, or nothing
            if len(at) < 4000:
                to = (at % (SIZE * SIZE) * SIZE)[:, None] + np.arange(1, SIZE)
                np.maximum.at(new, to.ravel(), ((score + choices[0][1])[:, None] + self.model[at, 1:]).ravel())
            else:
                whole = np.full(SIZE ** 3, -np.inf)
                whole[at] = score + choices[0][1]
                new = (whole[:, None] + self.model).reshape(SIZE, SIZE * SIZE, SIZE).max(0)
                new[:, 0] = -np.inf
                new = new.ravel()
            choices = choices[-1:]
        for choice in choices:
            np.maximum.at(new, *self._pushed(at, score, *choice))
        at = np.flatnonzero(new > -np.inf)
        return at, new[at]

    def _all_states(self, stretch: str) -> str:
        """The same on arrays, for stretches that reach many states. The way back is found from the
        scores; those of every ``_SAVED``-th step are kept and the others worked out again."""
        steps = [*lattice(stretch), [(" ", 0.0)]]
        now = np.zeros(1, np.int64), np.zeros(1)
        saved, trail = [], []
        for i, choices in enumerate(steps):
            if i % _SAVED == 0:
                saved.append(now)
                trail = []
            trail.append(now)
            now = self._step(*now, choices)
        best = int(now[1].argmax())
        state, score, out = int(now[0][best]), now[1][best], []
        for i in reversed(range(0, len(steps), _SAVED)):
            now = saved.pop()
            if not trail:
                for choices in steps[i:i + _SAVED]:
                    trail.append(now)
                    now = self._step(*now, choices)
            for choices in reversed(steps[i:i + _SAVED]):
                at, scores = trail.pop()
                for letters, cost in choices:
                    to, s = self._pushed(at, scores, letters, cost)
                    hit = np.flatnonzero((to == state) & (s == score))
                    if len(hit):
                        out.append(letters)
                        state, score = int(at[hit[0]]), scores[hit[0]]
                        break
                else:
                    raise AssertionError(stretch)
        return "".join(reversed(out)).strip()

    def restore(self, text: str) -> str:
        """The folded text with every suspicious stretch decoded."""
        t, out, done = folded(text), [], 0
        for m in _TRACE.finditer(t):
            if m.start() < done:
                continue
            apart = _APART.match(t, m.start()) if t[m.start() + 1] in _SEPARATORS else None
            a = m.start()
            if apart:
                b = apart.end()
            else:
                while a > done and (t[a - 1].isalnum() or t[a - 1] in "@$!|+*"):
                    a -= 1
                b = _RUN.match(t, a).end()
            out += [t[done:a], " ", self.decode(t[a:b]), " "]
            done = b
        return "".join(out) + t[done:]


def words_of(restored: str) -> set[str]:
    return set(re.findall("[a-z]+", restored))


# ---- scoring -----------------------------------------------------------------------------

def marks(word: str) -> list[str]:
    """The word itself and its beginnings."""
    return ["=" + word, *("^" + word[:k] for k in range(4, min(8, len(word)) + 1))]


@dataclass
class ToxicityModel:
    model: np.ndarray
    lexicon: dict[str, float]
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray

    def evidence(self, words: set[str], known: dict[str, float]) -> list[float]:
        """The document's strongest words, their mean, their share, and the strongest against the
        document's size: all zero without evidence."""
        got = []
        for w in words:
            s = known.get(w)
            if s is None:
                s = known[w] = max((self.lexicon.get(m, 0.0) for m in marks(w)), default=0.0)
            if s > 0:
                got.append(s)
        top = sorted(got, reverse=True)[:10] + [0.0] * max(0, 10 - len(got))
        n = len(words)
        return [top[0], top[1], top[2], top[4], sum(top) / 10, sum(s > STRONG for s in got) / max(1, n) ** 0.5, top[0] * np.log1p(n)]

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = self.weights[0] + ((x - self.mean) / self.spread) @ self.weights[1:]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    mean, spread = x.mean(0), x.std(0) + 1e-9
    z = np.c_[np.ones(len(x)), (x - mean) / spread]
    w = np.zeros(z.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hess = (z * (p * (1 - p))[:, None]).T @ z + 0.1 * np.eye(len(w))
        step = np.linalg.solve(hess, z.T @ (y - p) - 0.1 * w)
        w += step / max(1.0, np.abs(step).max() / 3)
        if np.abs(step).max() < 1e-7:
            break
    return mean, spread, w


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, support: int = SUPPORT) -> ToxicityModel:
    """Learns from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    model = log_model(count_characters(docs))
    chosen = (labels.where("toxic is not null and doc_id is not null").where(fold() != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    # at most ``sample`` rows of two numbers are broadcast; of an id on many rows the least text is learned from
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))

    def make():
        decoder = Decoder(model)
        return lambda batch: {"words": [sorted(words_of(decoder.restore(t or ""))) for t in batch.column("text").to_pylist()]}

    seen = stage(with_columns(rows, "words array<string>", make).drop("text"), "labelled")
    n = dict(seen.groupBy(F.col("toxic") > 0).count().collect())
    toxic, clean = n.get(True, 0), n.get(False, 0)
    none = np.zeros(7)
    if not toxic or not clean:
        p = toxic / max(1, toxic + clean)
        return ToxicityModel(model, {}, none, none + 1, np.r_[np.log((p + 1e-9) / (1 - p + 1e-9)), none])

    def counted(part: DataFrame, wanted: frozenset | None) -> dict[str, int]:
        """Documents of the part that hold each mark (each wanted one, or those with support)."""
        def count(batches):
            for batch in batches:
                for at in range(0, batch.num_rows, 200):  # few documents at a time: their marks are many
                    found: Counter = Counter()
                    for words in batch.slice(at, 200).column("words").to_pylist():
                        held = {m for w in words for m in marks(w)}
                        found.update(held if wanted is None else held & wanted)
                    yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["mark", "n"])

        rows = part.select("words").mapInArrow(count, "mark string, n long").groupBy("mark").agg(F.sum("n").alias("n"))
        got = (rows.where(F.col("n") >= support) if wanted is None else rows).toArrow()
        return dict(zip(got["mark"].to_pylist(), got["n"].to_pylist()))

    # only marks of toxic documents can be evidence: the clean ones are counted for these alone
    held = counted(seen.where("toxic > 0"), None)
    others = counted(seen.where("toxic <= 0"), frozenset(held))
    odds = {m: float(np.log((a + 0.5) / (toxic + 1)) - np.log((others.get(m, 0) + 0.5) / (clean + 1))) for m, a in held.items()}
    out = ToxicityModel(model, {m: o for m, o in odds.items() if o > 0.7}, none, none + 1, np.zeros(8))

    def figures():
        known: dict[str, float] = {}
        return lambda batch: {"x": [out.evidence(set(w), known) for w in batch.column("words").to_pylist()]}

    # eight numbers a row of the bounded sample; in a fixed order, so that sums do not depend on the partitions
    got = with_columns(seen.select("doc_id", "toxic", "words"), "x array<double>", figures).select("doc_id", (F.col("toxic") > 0).alias("y"), "x").toArrow().sort_by("doc_id")
    x, y = got["x"].combine_chunks().flatten().to_numpy().reshape(-1, 7), got["y"].to_numpy().astype(float)
    out.mean, out.spread, out.weights = _logistic(x, y)
    return out


def score(docs: DataFrame, fitted: ToxicityModel, text: str = "text", restored: bool = False) -> DataFrame:
    """``docs`` with ``score``, ``predicted`` and, if asked for, the ``restored`` text."""
    def make():
        decoder, known = Decoder(fitted.model), {}

        def run(batch: pa.RecordBatch) -> dict:
            evidence, texts = [], []
            for t in batch.column(text):  # one text at a time
                t = decoder.restore(t.as_py() or "")
                if len(known) > 300_000:
                    known.clear()
                evidence.append(fitted.evidence(words_of(t), known))
                texts.append(t if restored else None)
            p = fitted.probability(np.array(evidence))
            return {"score": p.tolist(), "predicted": (p >= 0.5).astype(int).tolist(), "restored": texts}
        return run

    return with_columns(docs, "score double, predicted int" + ", restored string" * restored, make)
