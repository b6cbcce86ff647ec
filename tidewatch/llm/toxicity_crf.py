"""Toxic spans by a linear-chain conditional random field over a document's words.

Labels exist for documents only, so token labels are derived: a word or word beginning that is found
nearly only in toxic documents marks its tokens there; every other token is clean. The field has
two states, hashed features of the word's form, a start weight and four transition weights, and is
fitted to windows of a bounded sample of labelled documents. Forward-backward marginals over
whole documents give the offending offsets; a logistic rule over their sum, the two largest ones and
the length turns them into the document's score.

A task runs forward-backward over all documents of a batch at once: their tokens are one chain
whose transitions forget the past where a document starts, cut into lanes that advance together.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .common import per_worker, pick, remainder
from .pretokens import Cache

#: Bounds of the sample: labelled documents by label, and windows taken from each document.
TOXIC_DOCUMENTS = 6_000
CLEAN_DOCUMENTS = 12_000
WINDOWS = 3
WINDOW_TOKENS = 32

#: A form marks toxic tokens if so many sampled documents have it and this share of them is toxic.
SEED_SUPPORT = 5
SEED_SHARE = 0.8
MOST_SEEDS = 50_000

DIMENSIONS = 1 << 18
FORMS = 6
EPOCHS = 4
RATE = 0.3
DECAY = 1e-6
TOKENS_PER_STEP = 8_192

#: Steps of a lane, and tokens handled at a time.
LANE = 256
AT_ONCE = 1 << 19
#: Marginals below this do not add to a document's score; from MARK on a token is offending.
FLOOR = 0.02
MARK = 0.5
DECISION = 0.3
CACHE_SIZE = 400_000
#: Numbers that the document rule sees; the weight that draws its weights to zero.
SUMMARY = 5
RIDGE = 1.0

TOKEN = re.compile(r"[^\W_]+")


def forms(word: str) -> list[str]:
    """The word's form features."""
    w = word.lower()
    return ["w" + w, "a" + w[:3], "b" + w[:4], "c" + w[:5], "e" + w[-3:], f"n{min(len(w), 12)}"]


def hashed(word: str) -> list[int]:
    return [zlib.crc32(f.encode("utf-8", "surrogatepass")) % DIMENSIONS for f in forms(word)]


@dataclass
class Field:
    """Emission weights of the toxic state (the clean one has none), its bias, the log potential of
    starting toxic, the log potentials [from, to] of transitions, and the document rule's weights."""

    weights: np.ndarray
    bias: float
    start: float
    move: np.ndarray
    rule: np.ndarray

    def emission(self, word: str) -> float:
        return self.bias + float(self.weights[hashed(word)].sum())

    def chain(self, emissions: np.ndarray, first: np.ndarray):
        """Forward and backward odds (toxic to clean) of every token. ``first`` marks document starts."""
        n = len(emissions)
        lanes = -(-n // LANE)
        pad = lanes * LANE - n
        e = np.exp(np.clip(np.concatenate([emissions, np.zeros(pad)]), -30, 30)).reshape(lanes, LANE)
        f = np.concatenate([first, np.ones(pad, bool)]).reshape(lanes, LANE)
        t = np.exp(self.move)
        s = np.exp(self.start)
        # Step matrices: row = state before, column = state now; at a start both rows are equal.
        k00, k10 = np.where(f, 1.0, t[0, 0]), np.where(f, 1.0, t[1, 0])
        k01, k11 = np.where(f, s, t[0, 1]) * e, np.where(f, s, t[1, 1]) * e
        # Product of each lane.
        p00, p01 = np.ones(lanes), np.zeros(lanes)
        p10, p11 = np.zeros(lanes), np.ones(lanes)
        for i in range(LANE):
            a, b, c, d = k00[:, i], k01[:, i], k10[:, i], k11[:, i]
            p00, p01, p10, p11 = p00 * a + p01 * c, p00 * b + p01 * d, p10 * a + p11 * c, p10 * b + p11 * d
            z = p00 + p01 + p10 + p11
            p00, p01, p10, p11 = p00 / z, p01 / z, p10 / z, p11 / z
        # Odds at each lane's entrance and exit.
        enter, leave = np.empty(lanes), np.empty(lanes)
        odds = 1.0
        for j in range(lanes):
            enter[j] = odds
            odds = (p01[j] + odds * p11[j]) / (p00[j] + odds * p10[j])
        odds = 1.0
        for j in range(lanes - 1, -1, -1):
            leave[j] = odds
            odds = (p10[j] + p11[j] * odds) / (p00[j] + p01[j] * odds)
        forward, backward = np.empty((lanes, LANE)), np.empty((lanes, LANE))
        odds = enter
        for i in range(LANE):
            odds = (k01[:, i] + odds * k11[:, i]) / (k00[:, i] + odds * k10[:, i])
            forward[:, i] = odds
        odds = leave
        for i in range(LANE - 1, -1, -1):
            backward[:, i] = odds
            odds = (k10[:, i] + k11[:, i] * odds) / (k00[:, i] + k01[:, i] * odds)
        return forward.ravel()[:n], backward.ravel()[:n], e.ravel()[:n]

    def marginals(self, emissions: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Probability of the toxic state for every token."""
        forward, backward, _ = self.chain(emissions, first)
        odds = forward * backward
        return odds / (1 + odds)


def fit_field(features: np.ndarray, labels: np.ndarray, first: np.ndarray,
              epochs: int = EPOCHS) -> Field:
    """Maximum likelihood by AdaGrad over runs of whole windows, in a fixed order."""
    field = Field(np.zeros(DIMENSIONS), 0.0, 0.0, np.zeros((2, 2)), np.zeros(SUMMARY))
    if not len(labels):
        return field
    squares, other = np.full(DIMENSIONS, 1e-6), np.full(6, 1e-6)
    starts = np.flatnonzero(first)
    cuts = [*starts[::max(1, TOKENS_PER_STEP // WINDOW_TOKENS)].tolist(), len(labels)]
    spans = list(zip(cuts, cuts[1:]))
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for at in order.permutation(len(spans)):
            lo, hi = spans[at]
            x, y, f = features[lo:hi], labels[lo:hi].astype(float), first[lo:hi]
            emissions = field.bias + field.weights[x].sum(1)
            forward, backward, e = field.chain(emissions, f)
            odds = forward * backward
            p = odds / (1 + odds)
            g = y - p
            inner = np.flatnonzero(~f)
            # Pair probabilities of neighbours within a window, by state before and now.
            a, b = forward[inner - 1], backward[inner]
            t = np.exp(field.move)
            pair = np.stack([np.stack([t[0, 0] + 0 * a, t[0, 1] * e[inner] * b]),
                             np.stack([t[1, 0] * a, t[1, 1] * a * e[inner] * b])])
            pair /= pair.sum((0, 1))
            before, now = y[inner - 1], y[inner]
            seen = np.array([[((1 - before) * (1 - now)).sum(), ((1 - before) * now).sum()],
                             [(before * (1 - now)).sum(), (before * now).sum()]])
            gradient = np.bincount(x.ravel(), np.repeat(g, x.shape[1]), DIMENSIONS)
            gradient -= DECAY * len(y) * field.weights
            squares += gradient ** 2
            field.weights += RATE * gradient / np.sqrt(squares)
            rest = np.array([g.sum(), (y - p)[f].sum(), *(seen - pair.sum(2)).ravel()])
            other += rest ** 2
            move = RATE * rest / np.sqrt(other)
            field.bias += move[0]
            field.start += move[1]
            field.move = field.move + move[2:].reshape(2, 2)
    return field


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_id: str = "doc_id", label_col: str = "toxic", toxic: int = TOXIC_DOCUMENTS,
                    clean: int = CLEAN_DOCUMENTS) -> DataFrame:
    """(text, toxic) of at most so many labelled documents, those with the smallest id hashes.

    An id with several labels counts as toxic if one of them is 1. Null ids and labels are left out.
    """
    known = (labels.select(labels[label_id].alias("id"), labels[label_col].alias("toxic"))
             .filter("id IS NOT NULL AND toxic IS NOT NULL").groupBy("id").agg(F.max("toxic").alias("toxic")))
    chosen = None
    for value, most in ((1, toxic), (0, clean)):
        part = known.filter(F.col("toxic") == value).orderBy(F.xxhash64("id"), "id").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = pick(docs, id_col, text_col)
    # Bounded by ``toxic`` + ``clean`` ids.
    return rows.join(F.broadcast(chosen), rows["doc_id"] == chosen["id"]).select("text", "toxic")


def seeds(sample: DataFrame, support: int = SEED_SUPPORT, share: float = SEED_SHARE) -> set[str]:
    """Forms (word, beginnings of four and five letters) found nearly only in toxic documents."""
    def run(batches):
        for batch in batches:
            found, marks = [], []
            for text, toxic in zip(*(batch.column(i).to_pylist() for i in range(2))):
                own = {f for w in set(TOKEN.findall(text)) for f in seed_forms(w)}
                found += own
                marks += [toxic] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(marks, pa.int32())],
                                             names=["form", "toxic"])

    # Copies of a document are one observation.
    distinct = sample.groupBy("text").agg(F.max("toxic").cast("int").alias("toxic"))
    counts = (distinct.mapInArrow(run, "form string, toxic int").groupBy("form")
              .agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic"))
              .filter((F.col("toxic") >= support) & (F.col("toxic") >= share * F.col("n"))))
    return {r["form"] for r in counts.orderBy(F.desc("toxic"), "form").limit(MOST_SEEDS).collect()}


def seed_forms(word: str) -> list[str]:
    """The forms of at least four letters that may mark a token."""
    own = forms(word)
    return [f for f in (own[0], own[2], own[3]) if len(f) > 4]


def windows(sample: DataFrame, seed_set: set[str]) -> DataFrame:
    """Training windows: features (n x FORMS numbers as bytes) and labels (a byte per token).

    Every document gives windows around tokens with a seed form, clean ones too, and windows at
    places drawn by a hash of the text.
    """
    def run(batches):
        for batch in batches:
            out = []
            for text, toxic in zip(*(batch.column(i).to_pylist() for i in range(2))):
                words = TOKEN.findall(text)
                if not words:
                    continue
                at = [i for i, w in enumerate(words) if any(f in seed_set for f in seed_forms(w))]
                marks = bytearray(len(words))
                if toxic == 1:
                    for i in at:
                        marks[i] = 1
                draw = zlib.crc32(text.encode("utf-8", "surrogatepass"))
                turn = draw % len(at) if at else 0
                picks = (at[turn:] + at[:turn])[:WINDOWS - 1]
                picks += [(draw >> 3 * k) % len(words) for k in range(WINDOWS - len(picks))]
                for p in picks:
                    lo = max(0, p - WINDOW_TOKENS // 2)
                    piece = words[lo:lo + WINDOW_TOKENS]
                    x = np.array([hashed(w) for w in piece], "<i4")
                    out.append((x.tobytes(), bytes(marks[lo:lo + WINDOW_TOKENS])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], pa.binary()) for i in (0, 1)], names=["features", "labels"])

    return sample.mapInArrow(run, "features binary, labels binary")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_id: str = "doc_id", label_col: str = "toxic") -> Field:
    """A field fitted on a bounded sample of the labelled documents.

    Without labelled documents it has no weights and marks nothing."""
    sample = written(labelled_sample(docs, labels, id_col, text_col, label_id, label_col))
    marks = seeds(sample)
    # At most WINDOWS windows for each of a bounded number of documents come to the driver.
    # The order is fixed there, so that a repeated run gives the same field.
    found = windows(sample, marks).collect() if marks else []
    rows = sorted(found, key=lambda r: (zlib.crc32(r["features"]), bytes(r["features"]), bytes(r["labels"])))
    if not rows:
        return Field(np.zeros(DIMENSIONS), -30.0, 0.0, np.zeros((2, 2)), np.array([-5.0, 0, 0, 0, 0]))
    sizes = np.array([len(r["labels"]) for r in rows])
    features = np.frombuffer(b"".join(r["features"] for r in rows), "<i4").reshape(-1, FORMS)
    y = np.frombuffer(b"".join(r["labels"] for r in rows), np.uint8)
    first = np.zeros(len(y), bool)
    first[np.cumsum(sizes) - sizes] = True
    return _with_rule(fit_field(features, y, first), sample, labels, label_col)


def summary(marginals: np.ndarray) -> list[float]:
    """What the document rule sees of a document's marginals."""
    big = np.sort(marginals[marginals >= FLOOR])[::-1]
    first, second = [*big[:2].tolist(), 0.0, 0.0][:2]
    return [1.0, float(np.log1p(big.sum())), first, second, float(np.log1p(len(marginals))) / 10]


def fit_rule(rows: np.ndarray, labels: np.ndarray, weights: np.ndarray, steps: int = 30) -> np.ndarray:
    """Logistic regression by Newton's method with a ridge, for rows of ``summary``."""
    w = np.zeros(rows.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        gradient = rows.T @ (weights * (labels - p)) - RIDGE * w
        curve = (rows * (weights * p * (1 - p))[:, None]).T @ rows + RIDGE * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def document_marginals(field: Field, cache: Cache, texts: list[str]):
    """(text, marginals of its tokens) of each text, whole, in order."""
    held: list[tuple[str, np.ndarray]] = []
    size = 0

    def flush():
        lengths = np.array([len(e) for _, e in held])
        chain = np.concatenate([e for _, e in held])
        first = np.zeros(len(chain), bool)
        begins = np.cumsum(lengths) - lengths
        first[begins[lengths > 0]] = True
        p = field.marginals(chain, first) if len(chain) else chain
        for (text, e), b in zip(held, begins.tolist()):
            yield text, p[b:b + len(e)]

    for text in texts:
        emissions = np.array([cache[w] for w in TOKEN.findall(text)], float)
        held.append((text, emissions))
        size += len(emissions)
        if size >= AT_ONCE:
            yield from flush()
            held, size = [], 0
    if held:
        yield from flush()


def offending(text: str, marginals: np.ndarray) -> list[tuple[int, int, float]]:
    """(start, end, largest marginal) of runs of offending tokens."""
    spans: list[tuple[int, int, float]] = []
    if not len(marginals) or marginals.max() < MARK:
        return spans
    last = -2
    for i, m in enumerate(TOKEN.finditer(text)):
        if marginals[i] < MARK:
            continue
        if last == i - 1:
            spans[-1] = (spans[-1][0], m.end(), max(spans[-1][2], float(marginals[i])))
        else:
            spans.append((m.start(), m.end(), float(marginals[i])))
        last = i
    return spans


def score(field: Field, marginals: np.ndarray) -> float:
    """0 without a token; else the document rule's probability."""
    if not len(marginals):
        return 0.0
    return float(1 / (1 + np.exp(-np.clip(np.dot(field.rule, summary(marginals)), -30, 30))))


def _shared(docs: DataFrame, field: Field):
    """The field as a broadcast value, and how a worker gets it with its cache."""
    value = docs.sparkSession.sparkContext.broadcast(
        (field.weights.astype(np.float32), field.bias, field.start, field.move, field.rule))
    key = ("crf", zlib.crc32(field.weights.tobytes()), float(field.bias))

    def own() -> tuple[Field, Cache]:
        weights, *rest = value.value
        fitted = Field(weights.astype(float), *rest)
        return fitted, per_worker(key, lambda: Cache(fitted.emission, CACHE_SIZE))

    return own


def _with_rule(field: Field, sample: DataFrame, labels: DataFrame, label_col: str) -> Field:
    """The field with a document rule fitted on the sample; weights undo the sample's choice of labels."""
    own = _shared(sample, field)

    def run(batches):
        fitted, cache = own()
        for batch in batches:
            rows = [summary(p) for _, p in document_marginals(fitted, cache, batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(1)],
                                             names=["row", "toxic"])

    kind = sample.schema["toxic"].dataType.simpleString()
    # A few numbers for each document of the bounded sample.
    rows = sorted(sample.mapInArrow(run, f"row array<double>, toxic {kind}").collect(),
                  key=lambda r: (r["toxic"], r["row"]))
    x, y = np.array([r["row"] for r in rows]), np.array([r["toxic"] for r in rows], float)
    known = {r[0]: r[1] for r in labels.groupBy(F.col(label_col)).count().collect()}
    share = [known.get(v, 0) / max(1, (y == v).sum()) for v in (0, 1)]
    weights = np.where(y == 1, 1.0, share[0] / share[1] if share[1] else 1.0)
    return replace(field, rule=fit_rule(x, y, weights))


def tag(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text",
        decision: float = DECISION) -> DataFrame:
    """One row per row: doc_id, score (0 to 1), predicted (1 if score >= decision), spans: an array of
    (start, end, marginal) of offending tokens, neighbours joined, in code points.

    A null text counts as empty; a text without words has score 0. Rows are independent of ids.
    """
    own = _shared(docs, field)

    def run(batches):
        fitted, cache = own()
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())]))
        for batch in batches:
            scores, spans = [], []
            for text, p in document_marginals(fitted, cache, batch.column(1).to_pylist()):
                scores.append(score(fitted, p))
                spans.append([dict(zip(("start", "end", "marginal"), x)) for x in offending(text, p)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()),
                 pa.array([int(x >= decision) for x in scores], pa.int32()), pa.array(spans, span)],
                names=["doc_id", "score", "predicted", "spans"])

    rows = pick(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double, predicted int, "
                                "spans array<struct<start:int,end:int,marginal:double>>")


def learning_labels(labels: DataFrame, id_col: str = "doc_id", folds: int = 4, held_out: int = 2) -> DataFrame:
    """The labels to learn from: all but the held-out fold."""
    return labels.filter(remainder(labels[id_col], folds) != held_out)
