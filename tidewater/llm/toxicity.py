"""Toxicity by a linear-chain conditional random field over words.

Fitting, on a bounded sample of labelled rows (``FIT_ROWS`` of each label, by
the smallest hashes of their ids, texts up to ``FIT_CHARS`` characters; near
copies of a sampled text count once):

1. Each word has features: itself and its beginnings of 3 to 10 letters.  The
   log-odds of a feature's documents give its evidence; only features of
   ``MIN_DOCS`` documents and over ``MIN_ODDS`` are kept.
2. Tokens are labelled from the documents' labels: toxic where a document
   labelled toxic has a word of strong evidence.  The field (two tags, the
   evidence of a word, transitions) is fitted to these tags by gradient steps
   on the exact conditional likelihood.
3. A logistic curve turns a document's largest marginals and its expected
   number of toxic tokens into a score; it is fitted on a part of the sample
   that steps 1 and 2 do not see.

Scoring runs in ``mapInArrow`` tasks over whole texts.  Forward and backward
messages of all documents in a batch are one chain that starts anew at each
document; it is cut into equal segments whose transfer matrices are multiplied
side by side, so a very long text takes no more steps than short ones.  No
shuffle is made, so no key can be hot; the model is bounded by the sample.

Defined cases: null text counts as empty and scores like a text without any
marginal; conflicting labels of one id count as toxic; rows that repeat an id
keep their rows; without labels of both kinds every score is the share of
toxic ones (0 if there are none); an empty table gives no rows.  Labels and
columns other than the text are no input of a score.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import ship, trimmed
from tidewater.llm.minhash import SEEDS, FACTORS, minima, shingles

FIT_ROWS, FIT_CHARS = 2500, 20_000
#: Of the sample, texts of each label whose tokens fit the field; one text in
#: ``CURVE_OF`` fits the curve instead.
FIELD_ROWS, CURVE_OF = 300, 4
MIN_DOCS, MIN_ODDS, STRONG = 6, 2.0, 3.0
#: A beginning counts as a feature if it has so many words of its own.
MIN_WORDS = 4
PREFIXES = range(3, 11)
STEPS, RATE, RIDGE = 120, 0.15, 1e-3
SEGMENT, REMEMBERED = 128, 120_000
WORDS = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def feature(word: str, n: int) -> str | None:
    """The word itself (``n`` 0) or its beginning of ``n`` letters."""
    return "=" + word if n == 0 else word[:n] if len(word) >= n else None


def evidence_of(docs: list[tuple[list[str], int]]) -> dict[str, float]:
    """Log-odds of the features that speak for toxic documents; one length of
    beginnings after another, which bounds the counters."""
    total = [sum(y == k for _, y in docs) for k in (0, 1)]
    out = {}
    for n in (0, *PREFIXES):
        def found(words, n=n) -> set:
            return {feature(w, n) for w in set(words)} - {None}

        toxic = Counter(f for words, y in docs if y for f in found(words))
        toxic = {f: a for f, a in toxic.items() if a >= MIN_DOCS}
        clean = Counter(f for words, y in docs if not y for f in found(words) if f in toxic)
        carriers: dict[str, set[str]] = {f: set() for f in toxic}
        for words, y in docs:
            for w in set(words) if y and n else ():
                if (f := feature(w, n)) in carriers:
                    carriers[f].add(w)
        for f, a in toxic.items():
            odds = np.log((a + 0.5) / (total[1] + 1)) - np.log((clean[f] + 0.5) / (total[0] + 1))
            if odds >= MIN_ODDS and (n == 0 or len(carriers[f]) >= MIN_WORDS):
                out[f] = float(odds)
    return out


@dataclass
class Model:
    evidence: dict[str, float] = field(default_factory=dict)
    #: Weights of 1, evidence, strong evidence.
    emit: np.ndarray = field(default_factory=lambda: np.zeros(3))
    move: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    curve: np.ndarray = field(default_factory=lambda: np.zeros(4))
    constant: float | None = None

    def word_evidence(self, word: str) -> float:
        get = self.evidence.get
        best = get("=" + word, 0.0)
        for n in PREFIXES:
            if len(word) < n:
                break
            best = max(best, get(word[:n], 0.0))
        return best


def _scan(first: np.ndarray, move: np.ndarray, e1: np.ndarray) -> np.ndarray:
    """Messages of a chain of two states, as (2, n) arrays that sum to 1.

    m_t = (m_{t-1} @ move) * (1, e1_t), starting anew with (1, e1_t) wherever
    ``first``.  Segments run side by side, three passes of ``SEGMENT`` steps.
    """
    n = len(e1)
    cols = -(-n // SEGMENT)
    pad = cols * SEGMENT - n
    e = np.append(e1, np.ones(pad)).reshape(cols, SEGMENT).T
    f = np.append(first, np.zeros(pad, bool)).reshape(cols, SEGMENT).T
    a, b, c, d = move.ravel()

    def step(x, y, t):
        u = np.where(f[t], 1.0, x * a + y * c)
        v = np.where(f[t], 1.0, x * b + y * d) * e[t]
        s = u + v
        return u / s, v / s, s

    # rows of each segment's transfer matrix: what either incoming state becomes
    x0, y0 = np.ones(cols), np.zeros(cols)
    x1, y1 = np.zeros(cols), np.ones(cols)
    w = np.zeros(cols)  # log weight of row 1 over row 0
    for t in range(SEGMENT):
        x0, y0, s0 = step(x0, y0, t)
        x1, y1, s1 = step(x1, y1, t)
        w = np.where(f[t], 0.0, w + np.log(s1) - np.log(s0))
    w = np.exp(np.clip(w, -500, 500))
    px, py = np.empty(cols), np.empty(cols)
    x, y = 0.5, 0.5
    for k, (r0x, r0y, r1x, r1y, q) in enumerate(zip(
            x0.tolist(), y0.tolist(), x1.tolist(), y1.tolist(), w.tolist(), strict=True)):
        px[k], py[k] = x, y
        x, y = x * r0x + y * q * r1x, x * r0y + y * q * r1y
        s = x + y
        x, y = x / s, y / s
    out = np.empty((2, SEGMENT, cols))
    for t in range(SEGMENT):
        px, py, _ = step(px, py, t)
        out[0, t], out[1, t] = px, py
    return out.transpose(0, 2, 1).reshape(2, -1)[:, :n]


def emissions(ev: np.ndarray) -> np.ndarray:
    """Feature rows (n, 3) of tokens."""
    return np.stack([np.ones(len(ev)), ev, ev >= STRONG], axis=1)


def messages(model: Model, x: np.ndarray, first: np.ndarray):
    """(forward, backward with its emission, emission odds)."""
    e1 = np.exp(np.clip(x @ model.emit, -30, 30))
    move = np.exp(model.move)
    last = np.append(first[1:], True)
    back = _scan(last[::-1], move.T, e1[::-1])[:, ::-1]
    return _scan(first, move, e1), back, e1


def marginals(model: Model, ev: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Probability of the toxic tag of each token."""
    if not len(ev):
        return ev
    f, b, e1 = messages(model, emissions(ev), first)
    one, zero = f[1] * b[1] / e1, f[0] * b[0]
    return one / (one + zero)


def fit_field(model: Model, docs: list[list[str]], tags: list[list[int]]) -> None:
    """Adam on the conditional log-likelihood of the tags."""
    ev = np.array([model.word_evidence(w) for d in docs for w in d])
    tag = np.array([t for d in tags for t in d], dtype=int)
    first = np.zeros(len(ev), dtype=bool)
    first[np.cumsum([0, *map(len, docs)])[:-1]] = True
    x = emissions(ev)
    inner = np.flatnonzero(~first)
    seen_emit = x.T @ tag
    seen_move = np.zeros((2, 2))
    np.add.at(seen_move, (tag[inner - 1], tag[inner]), 1)
    at = np.concatenate([model.emit, model.move.ravel()])
    m, v = np.zeros_like(at), np.zeros_like(at)
    for step in range(1, STEPS + 1):
        model.emit, model.move = at[:3], at[3:].reshape(2, 2)
        f, b, e1 = messages(model, x, first)
        one, zero = f[1] * b[1] / e1, f[0] * b[0]
        hope = x.T @ (one / (one + zero))
        pair = f[:, None, inner - 1] * np.exp(model.move)[:, :, None] * b[None, :, inner]
        hope_move = (pair / pair.sum(axis=(0, 1))).sum(axis=2)
        grad = np.concatenate([seen_emit - hope, (seen_move - hope_move).ravel()])
        grad = grad / max(1.0, tag.sum()) - RIDGE * at
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        at = at + RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    model.emit, model.move = at[:3], at[3:].reshape(2, 2)


def summary(p: np.ndarray) -> list[float]:
    """What a document's marginals give its score."""
    top = np.sort(p)[::-1][:2] if len(p) else p
    top = np.append(top, np.zeros(2 - len(top)))
    return [1.0, float(top[0]), float(top[1]), float(np.log1p(p[p > 0.1].sum()))]


def fit_curve(model: Model, x: np.ndarray, y: np.ndarray) -> None:
    """Logistic regression by Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w = w + np.linalg.solve(h, x.T @ (y - p) - 0.1 * w)
    model.curve = w


def apart(texts: list[str]) -> list[int]:
    """Positions of texts that share no minimum of shingles with one before."""
    seen: set[tuple[int, int]] = set()
    out = []
    for k, t in enumerate(texts):
        s = shingles(t.encode(), 5)
        marks = set(enumerate(minima(s, SEEDS[:6], FACTORS[:6]).tolist())) if len(s) else {(-1, 0)}
        if not marks & seen:
            out.append(k)
        seen |= marks
    return out


def fit_model(texts: list[str], labels: list[int]) -> Model:
    """A model from texts and their labels (1 toxic, 0 not)."""
    if len(set(labels)) < 2:
        return Model(constant=float(np.mean(labels)) if labels else 0.0)
    # interned: the sample's words are held once
    pairs = [(list(map(sys.intern, words_of(texts[k]))), labels[k]) for k in apart(texts)]
    learn = [p for k, p in enumerate(pairs) if k % CURVE_OF]
    rows = pairs[::CURVE_OF]
    if len({y for _, y in rows}) < 2 or len({y for _, y in learn}) < 2:
        learn = rows = pairs
    model = Model(evidence=evidence_of(learn))
    field_rows = [p for y in (1, 0) for p in [p for p in learn if p[1] == y and p[0]][:FIELD_ROWS]]
    tags = [[int(y == 1 and model.word_evidence(w) >= STRONG) for w in words] for words, y in field_rows]
    fit_field(model, [w for w, _ in field_rows], tags)
    x = []
    for words, _ in rows:
        ev = np.array([model.word_evidence(w) for w in words])
        first = np.zeros(len(ev), dtype=bool)
        first[:1] = True
        x.append(summary(marginals(model, ev, first)))
    fit_curve(model, np.array(x), np.array([y for _, y in rows], dtype=float))
    return model


def in_fold(doc_id: Column) -> Column:
    """Held out: never used for fitting."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on at most ``FIT_ROWS`` labelled rows of each kind."""
    known = (labels.select("doc_id", "toxic").filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
             .filter(~in_fold(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = [known.filter(F.col("toxic") == y).orderBy(*order).limit(FIT_ROWS) for y in (1, 0)]
    sample = F.broadcast(chosen[0].unionByName(chosen[1]))  # at most 2 * FIT_ROWS rows
    text = F.coalesce("text", F.lit(""))
    rows = (docs.select("doc_id", text.alias("text")).filter(F.length("text") <= FIT_CHARS)
            .join(sample, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
            .orderBy("doc_id").toPandas())
    return fit_model(rows["text"].tolist(), rows["toxic"].astype(int).tolist())


def score(docs: DataFrame, model: Model, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, the ``carry`` columns as they are, score, predicted, and
    the toxic tokens as starts and ends (code points)."""
    ship(docs.sparkSession)
    rows = docs.select("doc_id", "text", *[c for c in carry if c != "text"])
    names = ["doc_id", *carry]
    types = dict(rows.dtypes)
    shape = ", ".join(f"`{c}` {types[c]}" for c in names)

    def run(batches):
        seen: dict[str, float] = {}
        for batch in batches:
            size = pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0).to_pylist()
            lo, held = 0, 0
            for k, n in enumerate(size):  # about a MB of text at a time
                held += n
                if held > 1 << 20 or k == len(size) - 1:
                    part = batch.slice(lo, k + 1 - lo)
                    yield one(part.select(names), [t or "" for t in part.column("text").to_pylist()], seen)
                    lo, held = k + 1, 0

    def one(rest, texts, seen):
        ev: list[float] = []
        ends = [0]
        for t in texts:
            for w in words_of(t):
                e = seen.get(w)
                if e is None:
                    e = model.word_evidence(w)
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen[w] = e
                ev.append(e)
            ends.append(len(ev))
        first = np.zeros(len(ev) + 1, dtype=bool)
        first[ends[:-1]] = True
        p = marginals(model, np.array(ev), first[:-1]) if model.constant is None else np.zeros(len(ev))
        scores, starts, stops = [], [], []
        for t, a, z in zip(texts, ends[:-1], ends[1:], strict=True):
            x = float(np.dot(summary(p[a:z]), model.curve))
            scores.append(1 / (1 + np.exp(-x)) if model.constant is None else model.constant)
            hit = np.flatnonzero(p[a:z] > 0.5)
            spans = []
            if len(hit):
                low = t.lower()
                at = [m.span() for m in WORDS.finditer(low)]
                # offsets hold for texts that lower-casing leaves as long as they are
                spans = [at[k] for k in hit] if len(low) == len(t) else _offsets(t, at, hit)
            starts.append([s for s, _ in spans])
            stops.append([s for _, s in spans])
        many = pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays(
            [*rest.columns, pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()),
             pa.array(starts, many), pa.array(stops, many)],
            names=[*rest.schema.names, "score", "predicted", "starts", "ends"])

    return rows.mapInArrow(trimmed(run), f"{shape}, score double, predicted int, "
                                "starts array<long>, ends array<long>")


def _offsets(text: str, at: list[tuple[int, int]], hit) -> list[tuple[int, int]]:
    """Spans of the lower-cased text as spans of the text."""
    place = np.cumsum([0, *[len(c.lower()) for c in text]])
    back = lambda k: int(np.searchsorted(place, k, side="right")) - 1
    return [(back(at[k][0]), back(at[k][1])) for k in hit]
