"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time. Every byte of a text
is read, in segments of fixed length, forwards and backwards; every position gets a
distribution over the languages, and a document's probabilities are the normalised
sum of the logarithms' means over its positions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import ship, small_side
from martlet.session import written

#: Labelled rows the network is fitted on: at most this many of each language, the
#: first by hash of their id, and of each text two segments, from a place drawn by the
#: same hash.
ROWS_PER_LANGUAGE = 600
#: Every language is learned. Beyond this many, each gives fewer rows, one at least, and
#: fewer segments are read together, so that training and tasks stay bounded.
MANY_LANGUAGES = 64
SEGMENT = 96
HIDDEN = 6
STEPS = 240
BATCH = 128
SEED = 9
#: Segments read together in a task; bounds its memory.
TOGETHER = 8192


@dataclass
class Network:
    """Weights of both directions and of the output, in single precision.

    ``table`` maps a byte (256: beyond the text) to the inputs of the three gates,
    ``state`` maps the hidden state to them; both have a leading axis for direction.
    """

    labels: list[str]
    table: np.ndarray  # 2, 3H, 257
    state: np.ndarray  # 2, 3H, H
    out: np.ndarray  # L, 2H
    bias: np.ndarray  # L


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


def _forward(table, state, symbols):
    """Hidden states (steps, H, N) of one direction, and the gates for training."""
    steps, n = symbols.shape
    h = state.shape[1]
    hidden = np.zeros((h, n), dtype=np.float32)
    hiddens = np.empty((steps + 1, h, n), dtype=np.float32)
    hiddens[0] = hidden
    gates = []
    for t in range(steps):
        given = table[:, symbols[t]]
        mine = state @ hidden
        update = _sigmoid(given[:h] + mine[:h])
        reset = _sigmoid(given[h : 2 * h] + mine[h : 2 * h])
        new = np.tanh(given[2 * h :] + reset * mine[2 * h :])
        gates.append((update, reset, new, mine[2 * h :]))
        hidden = new + update * (hidden - new)
        hiddens[t + 1] = hidden
    return hiddens, gates


def _backward(table, state, symbols, hiddens, gates, grad):
    """Gradients of table and state, given those of the hidden states."""
    steps, n = symbols.shape
    h = state.shape[1]
    d_table, d_state = np.zeros_like(table), np.zeros_like(state)
    after = np.zeros((h, n), dtype=np.float32)
    for t in reversed(range(steps)):
        update, reset, new, mine = gates[t]
        before = hiddens[t]
        d = grad[t] + after
        d_new = d * (1 - update) * (1 - new * new)
        d_update = d * (before - new) * update * (1 - update)
        d_reset = d_new * mine * reset * (1 - reset)
        d_in = np.concatenate((d_update, d_reset, d_new))
        d_mine = np.concatenate((d_update, d_reset, d_new * reset))
        np.add.at(d_table.T, symbols[t], d_in.T)
        d_state += d_mine @ before.T
        after = d * update + state.T @ d_mine
    return d_table, d_state


def train(segments: np.ndarray, targets: np.ndarray, labels: list[str], hidden: int = HIDDEN,
          steps: int = STEPS, seed: int = SEED) -> Network:
    """Fit the network to segments (rows of SEGMENT symbols) with Adam, in about
    ``steps`` batches.

    Every position's label is the document's; positions beyond the text do not count.
    """
    rng = np.random.default_rng(seed)
    n_labels = len(labels)
    scale = 1 / np.sqrt(hidden)
    weights = [
        rng.normal(0, 0.3, (2, 3 * hidden, 257)).astype(np.float32),
        rng.normal(0, scale, (2, 3 * hidden, hidden)).astype(np.float32),
        rng.normal(0, scale, (n_labels, 2 * hidden)).astype(np.float32),
        np.zeros(n_labels, dtype=np.float32),
    ]
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    step = 0
    epochs = -(-steps // -(-len(segments) // BATCH))
    for epoch in range(epochs):
        rate = 0.02 * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
        order = rng.permutation(len(segments))
        for low in range(0, len(order), BATCH):
            rows = order[low : low + BATCH]
            symbols = np.ascontiguousarray(segments[rows].T)
            table, state, out, bias = weights
            runs = [_forward(table[d], state[d], symbols[:: 1 - 2 * d]) for d in (0, 1)]
            joined = np.concatenate((runs[0][0][1:], runs[1][0][1:][::-1]), axis=1)
            logits = np.einsum("lh,thn->tln", out, joined) + bias[:, None]
            logits -= logits.max(axis=1, keepdims=True)
            chance = np.exp(logits)
            chance /= chance.sum(axis=1, keepdims=True)
            counts = symbols < 256
            d_logits = chance
            d_logits[:, targets[rows], np.arange(len(rows))] -= 1
            d_logits *= (counts / max(1, counts.sum()))[:, None, :].astype(np.float32)
            d_out = np.einsum("tln,thn->lh", d_logits, joined)
            d_joined = np.einsum("lh,tln->thn", out, d_logits)
            parts = [
                _backward(table[d], state[d], symbols[:: 1 - 2 * d], *runs[d],
                          (d_joined[:, :hidden], d_joined[::-1, hidden:])[d])
                for d in (0, 1)
            ]
            grads = [
                np.stack([p[0] for p in parts]), np.stack([p[1] for p in parts]),
                d_out, d_logits.sum(axis=(0, 2)),
            ]
            step += 1
            for w, g, m, v in zip(weights, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Network(labels, *weights)


def symbols_of(data: bytes, segment: int = SEGMENT) -> np.ndarray:
    """All bytes of a text, in rows of ``segment`` symbols; the last is filled up."""
    rows = -(-len(data) // segment)
    out = np.full(rows * segment, 256, dtype=np.int16)
    out[: len(data)] = np.frombuffer(data, dtype=np.uint8)
    return out.reshape(rows, segment)


def position_logs(net: Network, segments: np.ndarray) -> np.ndarray:
    """For each segment, the sum over its positions of the log distributions (N, L)."""
    symbols = np.ascontiguousarray(segments.T)
    steps, n = symbols.shape
    h = net.state.shape[2]
    n_labels = len(net.labels)
    half = np.empty((steps, n_labels, n), dtype=np.float32)
    total = np.zeros((n_labels, n), dtype=np.float32)
    for d, places in ((0, range(steps)), (1, reversed(range(steps)))):
        # gates from rows of a table with one row for each byte: one gather for each step
        # halves make a sigmoid of tanh; the state keeps both in single precision
        scale = np.concatenate((np.full(2 * h, 0.5), np.ones(h))).astype(np.float32)
        given_by_byte = np.ascontiguousarray((net.table[d] * scale[:, None]))
        state = net.state[d] * scale[:, None]
        out = net.out[:, d * h : (d + 1) * h]
        hidden = np.zeros((h, n), dtype=np.float32)
        for t in places:
            given = given_by_byte.take(symbols[t], axis=1)
            mine = state @ hidden
            gate = given[: 2 * h]
            gate += mine[: 2 * h]
            np.tanh(gate, out=gate)
            gate += 1
            gate *= np.float32(0.5)
            new = mine[2 * h :]
            new *= gate[h:]
            new += given[2 * h :]
            np.tanh(new, out=new)
            hidden -= new
            hidden *= gate[:h]
            hidden += new
            if d == 0:
                np.matmul(out, hidden, out=half[t])
            else:
                logits = out @ hidden
                logits += half[t]
                logits += net.bias[:, None]
                logits -= logits.max(axis=0)
                logits -= np.log(np.exp(logits).sum(axis=0))
                if t >= steps - 1 or symbols[t].max() == 256:
                    logits *= symbols[t] < 256
                total += logits
    return total.T


def fit(docs: DataFrame, labels: tuple[str, ...] | None = None) -> Network | None:
    """Train on a bounded sample of rows (doc_id, text, lang) of ``docs``.

    Rows without language, text or letters are left out. None if no row is left.
    """
    draw = F.xxhash64("doc_id", F.length("text"))
    letter = r"\p{L}"
    rows = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").rlike(letter))
    from pyspark.sql import Window

    counts = written(rows.groupBy("lang").count(), "languages")
    each = max(1, ROWS_PER_LANGUAGE * MANY_LANGUAGES // max(MANY_LANGUAGES, counts.count()))
    # the addend only matters for few rows: hardly a language is left without any
    common = small_side(counts.select(
        "lang", F.least(F.lit(1.0), (3.0 * each + (30.0 if each < ROWS_PER_LANGUAGE else 0.0)) / F.col("count")).alias("chance")
    ))
    chosen = rows.join(common, "lang").withColumn("draw", draw)
    # about three times the rows wanted come out of the scan, the window cuts them
    unit = F.pmod("draw", F.lit(1 << 30)) / F.lit(float(1 << 30))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(unit, "doc_id", "draw"))
    spot = F.pmod(F.shiftright("draw", 31), F.greatest(F.length("text") - SEGMENT, F.lit(1))).cast("int")
    sample = (
        chosen.filter(unit < F.col("chance"))
        .withColumn("drawn", F.substr("text", spot + 1, F.lit(2 * SEGMENT)))
        # a piece without a letter says nothing: take it from the first letter on
        .withColumn("piece", F.when(F.col("drawn").rlike(letter), F.col("drawn")).otherwise(
            F.substr("text", F.regexp_instr("text", F.lit(letter)), F.lit(2 * SEGMENT))
        ))
        .withColumn("place", place).filter(F.col("place") <= each)
        .select("lang", "piece", unit.alias("unit")).toPandas()
        .sort_values(["lang", "unit", "piece"])
    )
    if not len(sample):
        return None
    known = sorted(sample["lang"].unique())
    targets = sample["lang"].map({k: i for i, k in enumerate(known)}).to_numpy()
    segments = [symbols_of(p.encode()[: 2 * SEGMENT]) for p in sample["piece"]]
    targets = np.repeat(targets, [len(s) for s in segments])
    return train(np.concatenate(segments), targets, known)


_LETTER = regex.compile(r"\p{L}").search


def identify(docs: DataFrame, net: Network | None) -> DataFrame:
    """Language of every row of ``docs`` (doc_id, text): doc_id, lang_pred and score.

    A null text and one without a letter is ``und`` with score 0, as is every row if
    there is no network. The score is the chance of the language named. Texts are
    read whole; null ids and repeated rows are read like others; an empty table gives
    an empty result.
    """
    ship(__name__)
    import pyarrow as pa

    # a few thousand weights, as plain values: a broadcast names classes, and executors
    # have no copy of this module
    plain = (net.labels, net.table, net.state, net.out, net.bias) if net else None
    sent = docs.sparkSession.sparkContext.broadcast(plain)

    def run(batches):
        net = Network(*sent.value) if sent.value else None
        for batch in batches:
            texts = batch.column("text").to_pylist()
            langs, scores = ["und"] * len(texts), np.zeros(len(texts))
            if net is not None:
                logs = np.zeros((len(texts), len(net.labels)))
                sizes = np.zeros(len(texts))
                together = max(1, TOGETHER * MANY_LANGUAGES // max(MANY_LANGUAGES, len(net.labels)))
                waiting, owners, rows = [], [], 0

                def read():
                    owner = np.concatenate(owners)
                    np.add.at(logs, owner, position_logs(net, np.concatenate(waiting)))
                    waiting.clear()
                    owners.clear()

                for i, text in enumerate(texts):
                    if text is None or not _LETTER(text):
                        continue
                    data = text.encode()
                    sizes[i] = len(data)
                    parts = symbols_of(data)
                    for low in range(0, len(parts), together):
                        part = parts[low : low + together]
                        waiting.append(part)
                        owners.append(np.full(len(part), i))
                        rows += len(part)
                        if rows >= together:
                            read()
                            rows = 0
                if waiting:
                    read()
                for i in np.flatnonzero(sizes):
                    # the mean over positions, sharpened by the number of segments
                    mean = logs[i] / sizes[i] * min(SEGMENT, sizes[i])
                    chance = np.exp(mean - mean.max())
                    best = int(chance.argmax())
                    langs[i], scores[i] = net.labels[best], chance[best] / chance.sum()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores)],
                names=["doc_id", "lang_pred", "score"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, lang_pred string, score double"
    )
