"""Quality classifier from positive and unlabelled documents.

Trusted positives, unlabelled web text and an estimated class prior p give an
unbiased risk without negatives: p R+(+1) + (R_u(-1) - p R+(-1)). The second part
estimates the negatives' risk, which cannot be negative; a step that finds it below
zero goes back on it instead (non-negative risk). The model is linear over the mean of
hashed byte trigrams and a few bins of sizes and repetition.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import ship

#: Rows the classifier is fitted on: about this many trusted positives and this many
#: unlabelled documents, those with the lowest hashes, and never more than twice that.
POSITIVES = 2000
UNLABELLED = 4000
BUCKETS = 1 << 12
EPOCHS = 60
BATCH = 512
#: A share of the positives is kept back to estimate the prior.
HELD_BACK = 0.25
SEED = 1
#: Weight of the trigram means and of a bin in the features.
SCALE, BIN = 5.0, 4.0

#: Bin edges: words; shares of distinct word pairs, distinct lines and words equal to
#: the one before; shares of capitals, of other ASCII signs and of digits in all bytes.
_EDGES = (
    np.array([1, 4, 8, 12, 16, 20, 24, 32, 48, 96]),
    np.array([0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.97]),
    np.array([0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.97]),
    np.array([0.01, 0.03, 0.1, 0.2, 0.4, 0.6, 0.8]),
    np.array([0.01, 0.03, 0.06, 0.1, 0.2, 0.4, 0.7]),
    np.array([0.01, 0.03, 0.06, 0.1, 0.15, 0.2, 0.3, 0.5]),
    np.array([0.01, 0.05, 0.1, 0.3]),
)
_STARTS = np.cumsum([0] + [len(e) + 1 for e in _EDGES])
BINS = int(_STARTS[-1])
_KINDS = np.zeros(256, dtype=np.uint8)  # 1: capitals, 2: other signs, 3: digits
_KINDS[33:127] = 2
_KINDS[65:91], _KINDS[97:123], _KINDS[48:58] = 1, 0, 3


def _trigrams(data: bytes) -> np.ndarray:
    a = np.frombuffer(data, dtype=np.uint8).astype(np.uint32)
    if len(a) < 3:
        return np.zeros(0, dtype=np.uint32)
    mixed = (a[:-2] * np.uint32(0x9E3779B1) ^ a[1:-1] * np.uint32(0x85EBCA77)) + a[2:] * np.uint32(0xC2B2AE3D)
    mixed ^= mixed >> np.uint32(15)
    return (mixed * np.uint32(0x27D4EB2F)) >> np.uint32(32 - BUCKETS.bit_length() + 1)


def _bins(data: bytes) -> np.ndarray:
    """One bin of each kind in _EDGES."""
    words = data.split()
    n = len(words)
    after = words[1:]
    pairs = len(set(zip(words, after))) / (n - 1) if n > 1 else 1.0
    again = sum(map(bytes.__eq__, words, after)) / (n - 1) if n > 1 else 0.0
    lines = data.split(b"\n")
    kinds = np.bincount(_KINDS[np.frombuffer(data, dtype=np.uint8)], minlength=4) / max(1, len(data))
    values = (n, pairs, len(set(lines)) / len(lines), again, kinds[1], kinds[2], kinds[3])
    return _STARTS[:-1] + [np.searchsorted(e, v, side="right") for e, v in zip(_EDGES, values)]


def features(text: str | None) -> np.ndarray:
    """Mean trigram counts and the bins, as one dense row."""
    data = (text or "").encode()
    out = np.zeros(BUCKETS + BINS, dtype=np.float32)
    grams = _trigrams(data)
    if len(grams):
        out[:BUCKETS] = np.bincount(grams, minlength=BUCKETS)
        out[:BUCKETS] *= np.float32(SCALE) / np.float32(len(grams))
    out[BUCKETS + _bins(data)] = BIN
    return out


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    prior: float

    def logit(self, text: str | None) -> float:
        """The same as the dense features' product, without making them."""
        data = (text or "").encode()
        grams = _trigrams(data)
        total = self.bias + BIN * float(self.weights[BUCKETS + _bins(data)].sum())
        if len(grams):
            total += SCALE * float(self.weights[:BUCKETS][grams].mean())
        return total


def _sigmoid(x):
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _descend(positive, unlabelled, prior: float, epochs: int, seed: int):
    """Minimise the non-negative risk with the logistic loss by Adam, in minibatches."""
    rng = np.random.default_rng(seed)
    w = np.zeros(positive.shape[1] + 1, dtype=np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    step = 0
    steps = max(1, len(unlabelled) // BATCH)
    for epoch in range(epochs):
        rate = 0.05 * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
        for _ in range(steps):
            p = positive[rng.integers(0, len(positive), BATCH)]
            u = unlabelled[rng.integers(0, len(unlabelled), BATCH)]
            gp, gu = p @ w[:-1] + w[-1], u @ w[:-1] + w[-1]
            sp, su = _sigmoid(gp), _sigmoid(gu)
            # logistic loss: l(g, +1) = log(1 + e^-g), l(g, -1) = log(1 + e^g)
            negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
            dp, du = -prior * sp / len(p), su / len(u)
            if negative >= 0:
                dp = dp + prior * (sp - 1) / len(p)
            else:
                dp, du = -dp, -du
            g = np.append(p.T @ dp + u.T @ du, dp.sum() + du.sum()).astype(np.float32)
            g[:-1] += 1e-4 * w[:-1]
            step += 1
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w


def _estimate_prior(score_positive: np.ndarray, score_unlabelled: np.ndarray) -> float:
    """The share of positives in the unlabelled: of any set of documents, the share of
    the unlabelled in it is at least the prior times that of the positives. So the
    least ratio over sets of high scores that hold most positives bounds the prior."""
    cuts = np.quantile(score_positive, np.linspace(0.01, 0.3, 30))
    ratio = [
        (score_unlabelled >= c).mean() / max((score_positive >= c).mean(), 1e-9) for c in cuts
    ]
    return float(np.clip(min(ratio), 0.02, 0.98))


def train(positive: np.ndarray, unlabelled: np.ndarray, seed: int = SEED) -> Model:
    """Fit the classifier to rows of ``features``; the prior is estimated with a first
    classifier that tells positives from unlabelled, on positives it has not seen."""
    p, u = positive.copy(), unlabelled
    rng = np.random.default_rng(seed)
    rng.shuffle(p)
    back = max(1, int(len(p) * HELD_BACK))
    seen = p[back:] if len(p) > back else p
    first = _descend(seen, u, 0.5, max(3, EPOCHS // 6), seed)
    prior = _estimate_prior(p[:back] @ first[:-1], u @ first[:-1])
    w = _descend(p, u, prior, EPOCHS, seed + 1)
    return Model(w[:-1], float(w[-1]), prior)


def _collected(texts: DataFrame) -> np.ndarray:
    """Features of a bounded number of rows (text), made in the tasks, so that what comes
    to the driver does not grow with the texts; only values that are not 0 are sent."""
    ship(__name__)
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            rows = [features(t) for t in batch.column("text").to_pylist()]
            places = [np.flatnonzero(r).astype(np.int32) for r in rows]
            values = [r[p] for r, p in zip(rows, places)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(places, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))],
                names=["places", "values"])

    sent = texts.select("text").mapInArrow(run, "places array<int>, values array<float>").toArrow()
    out = np.zeros((len(sent), BUCKETS + BINS), dtype=np.float32)
    lengths = sent["places"].combine_chunks().value_lengths().to_numpy()
    at = np.repeat(np.arange(len(sent)), lengths)
    out[at, sent["places"].combine_chunks().flatten().to_numpy()] = sent["values"].combine_chunks().flatten().to_numpy()
    # the order in which tasks answer must not change the model
    return out[np.argsort([r.tobytes() for r in out], kind="stable")] if len(out) else out


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Train on a bounded sample: positives are rows of ``docs`` with label 1, the
    unlabelled come from all rows. None without positives."""
    rows = docs.select("doc_id", "text")
    good = labels.filter("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()

    def lowest(frame: DataFrame, draw, wanted: int, tie: str) -> DataFrame:
        """About ``wanted`` rows, at most twice as many: those of the lowest draw."""
        share = wanted / max(wanted, frame.count())
        unit = F.pmod(draw, F.lit(1 << 30)) / F.lit(float(1 << 30))
        return frame.filter(unit < share).orderBy(unit, F.xxhash64(tie)).limit(2 * wanted)

    some = F.broadcast(lowest(good, F.xxhash64("doc_id"), POSITIVES, "doc_id"))  # at most 2 * POSITIVES ids
    positive = rows.join(some, "doc_id").orderBy(F.xxhash64("doc_id"), F.xxhash64("text")).limit(2 * POSITIVES)
    unlabelled = lowest(rows, F.xxhash64("doc_id", F.length("text")), UNLABELLED, "text")
    p = _collected(positive)
    return train(p, _collected(unlabelled)) if len(p) else None


def score(docs: DataFrame, model: Model | None, least: float = 0.3) -> DataFrame:
    """Score of every row of ``docs`` (doc_id, text): doc_id, score and predicted.

    Whole texts are read; a null text scores like an empty one; null ids and repeated
    rows are scored like others; without a model (no positives) every score is 0; an
    empty table gives an empty result.
    """
    ship(__name__)
    import pyarrow as pa

    # BUCKETS + BINS weights, as plain values: a broadcast names classes, and executors
    # have no copy of this module
    plain = (model.weights, model.bias, model.prior) if model else None
    sent = docs.sparkSession.sparkContext.broadcast(plain)

    def run(batches):
        model = Model(*sent.value) if sent.value else None
        for batch in batches:
            texts = batch.column("text").to_pylist()
            logits = np.array([model.logit(t) for t in texts]) if model else np.full(len(texts), -np.inf)
            scores = _sigmoid(logits)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()),
                 pa.array((scores >= least).astype(np.int32))],
                names=["doc_id", "score", "predicted"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, score double, predicted int"
    )
