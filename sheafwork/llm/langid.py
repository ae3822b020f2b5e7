"""Language identification by a bidirectional gated recurrent network over bytes.

A text is read in windows of ``WINDOW`` bytes, the last one shorter. Two gated
recurrent layers run over each window, one from each end; at every byte their
states give the probabilities of the languages. A document's probabilities are
the means over all its bytes; the language is the largest (ties: first by
name), the score its probability.

The network is trained in numpy by backpropagation through time with Adam, on a
bounded sample: ``SAMPLE_DOCS`` labelled documents of each language (by a hash
of the id) and ``SAMPLE_WINDOWS`` windows of each, spread over the text. The
language names met in the labelled rows are the classes; one row for each comes
to the driver.

Defined cases: a null text, or one without letters, is ``und`` with score 0. A
table without labelled rows gives ``und`` everywhere. Rows with one id are
judged one by one. The two columns added replace columns of their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheafwork.llm.jobs import record, tidy
from sheafwork.llm.textops import text_chunks

WINDOW = 64
HIDDEN = 8
SAMPLE_DOCS = 300
SAMPLE_WINDOWS = 6
STEPS = 250
BATCH = 256
#: Windows that run through the network side by side.
LANES = 4096
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    #: Per direction: input table [256, 3H], recurrent [3H, H]; output [C, 2H], bias [C].
    inputs: tuple[np.ndarray, np.ndarray]
    recurrent: tuple[np.ndarray, np.ndarray]
    output: np.ndarray
    bias: np.ndarray


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(np.minimum(x, 60, out=x), out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _forward(table, recurrent, steps: np.ndarray, mask: np.ndarray, keep: bool = False):
    """States after each step [T, H, B]; with ``keep`` also what backpropagation needs."""
    hidden = recurrent.shape[1]
    size = steps.shape[1]
    h = np.zeros((hidden, size), np.float32)
    states = np.empty((len(steps), hidden, size), np.float32)
    saved = []
    for t in range(len(steps)):
        x = table[steps[t]].T
        gates = recurrent[: 2 * hidden] @ h
        gates += x[: 2 * hidden]
        _sigmoid(gates)
        z, r = gates[:hidden], gates[hidden:]
        c = recurrent[2 * hidden :] @ (r * h)
        c += x[2 * hidden :]
        np.tanh(c, out=c)
        if keep:
            saved.append((h, z, r, c))
        h = h + z * (c - h)
        h *= mask[t]
        states[t] = h
    return (states, saved) if keep else states


def _backward(recurrent, steps, mask, saved, grad_states):
    """Gradients of the input table and the recurrent weights."""
    hidden = recurrent.shape[1]
    grad_recurrent = np.zeros_like(recurrent)
    grad_inputs = np.empty((3 * hidden, *steps.shape), np.float32)
    dh = np.zeros_like(grad_states[0])
    for t in range(len(steps) - 1, -1, -1):
        h, z, r, c = saved[t]
        dh = (dh + grad_states[t]) * mask[t]
        dc = dh * z * (1 - c * c)
        dz = dh * (c - h) * z * (1 - z)
        drh = recurrent[2 * hidden :].T @ dc
        dr = drh * h * r * (1 - r)
        pre = np.concatenate([dz, dr, dc])
        grad_inputs[:, t] = pre
        grad_recurrent[: 2 * hidden] += pre[: 2 * hidden] @ h.T
        grad_recurrent[2 * hidden :] += dc @ (r * h).T
        dh = dh * (1 - z) + drh * r + recurrent[: 2 * hidden].T @ pre[: 2 * hidden]
    flat = steps.ravel()
    grad_table = np.stack([np.bincount(flat, g.ravel(), minlength=256) for g in grad_inputs], axis=1)
    return grad_table.astype(np.float32), grad_recurrent


def _probabilities(model_output, bias, forward, backward) -> np.ndarray:
    """Class probabilities at each position, [C, T, B]."""
    hidden = forward.shape[1]
    logits = np.einsum("ch,thb->ctb", model_output[:, :hidden], forward, optimize=True)
    logits += np.einsum("ch,thb->ctb", model_output[:, hidden:], backward, optimize=True)
    logits += bias[:, None, None]
    logits -= logits.max(axis=0)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=0)
    return logits


def train(windows: list[bytes], labels: list[str], hidden: int = HIDDEN, steps: int = STEPS, seed: int = 7) -> Model:
    """Fit the network on labelled windows."""
    langs = tuple(sorted(set(labels)))
    rng = np.random.default_rng(seed)
    y = np.array([langs.index(x) for x in labels])
    lengths = np.array([len(w) for w in windows])
    grid = np.zeros((len(windows), WINDOW), np.uint8)
    for i, w in enumerate(windows):
        grid[i, : len(w)] = np.frombuffer(w, np.uint8)
    scale = 1 / np.sqrt(hidden)
    params = [rng.normal(0, 0.3, (256, 3 * hidden)) for _ in range(2)]
    params += [rng.normal(0, scale, (3 * hidden, hidden)) for _ in range(2)]
    params += [rng.normal(0, scale, (len(langs), 2 * hidden)), np.zeros(len(langs))]
    params = [p.astype(np.float32) for p in params]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    by_lang = [np.flatnonzero(y == k) for k in range(len(langs))]
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(m, max(1, BATCH // len(langs))) for m in by_lang])
        x = grid[pick].T
        mask = (np.arange(WINDOW)[:, None] < lengths[pick]).astype(np.float32)
        forward, kept_f = _forward(params[0], params[2], x, mask, True)
        backward, kept_b = _forward(params[1], params[3], x[::-1], mask[::-1], True)
        backward = backward[::-1]
        p = _probabilities(params[4], params[5], forward, backward)
        p[y[pick], :, np.arange(len(pick))] -= 1
        p *= mask / mask.sum()
        grad_out = np.concatenate(
            [np.einsum("ctb,thb->ch", p, s, optimize=True) for s in (forward, backward)], axis=1
        )
        grad_f = np.einsum("ch,ctb->thb", params[4][:, :hidden], p, optimize=True)
        grad_b = np.einsum("ch,ctb->thb", params[4][:, hidden:], p, optimize=True)
        table_f, rec_f = _backward(params[2], x, mask, kept_f, grad_f)
        table_b, rec_b = _backward(params[3], x[::-1], mask[::-1], kept_b, grad_b[::-1])
        rate = 0.02 * min(1.0, 2 * (1 - step / (steps + 1)))
        for i, g in enumerate((table_f, table_b, rec_f, rec_b, grad_out, p.sum(axis=(1, 2)))):
            g = np.clip(g, -1, 1)
            first[i] += 0.1 * (g - first[i])
            second[i] += 0.001 * (g * g - second[i])
            params[i] -= rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Model(langs, (params[0], params[1]), (params[2], params[3]), params[4], params[5])


def document_probabilities(data: np.ndarray, offsets: np.ndarray, model: Model) -> np.ndarray:
    """Mean class probabilities over all bytes of each text, [n, C]; zeros for an empty text."""
    sizes = np.diff(offsets)
    counts = -(-sizes // WINDOW)
    doc = np.repeat(np.arange(len(sizes)), counts)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = offsets[:-1][doc] + number * WINDOW
    lengths = np.minimum(offsets[1:][doc] - starts, WINDOW)
    padded = np.append(data, np.zeros(WINDOW, np.uint8))
    sums = np.zeros((len(doc), len(model.langs)))
    for lo in range(0, len(doc), LANES):
        s, n = starts[lo : lo + LANES], lengths[lo : lo + LANES]
        x = np.ascontiguousarray(padded[s[:, None] + np.arange(WINDOW)].T)
        mask = (np.arange(WINDOW)[:, None] < n).astype(np.float32)
        forward = _forward(model.inputs[0], model.recurrent[0], x, mask)
        backward = _forward(model.inputs[1], model.recurrent[1], x[::-1], mask[::-1])[::-1]
        p = _probabilities(model.output, model.bias, forward, backward)
        sums[lo : lo + LANES] = np.einsum("ctb,tb->bc", p, mask, optimize=True)
    out = np.zeros((len(sizes), len(model.langs)))
    np.add.at(out, doc, sums)
    return out / np.maximum(sizes, 1)[:, None]


def _sample_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, ranks, windows = [], [], []
        for lang, rank, text in zip(*(batch.column(c).to_pylist() for c in ("_lang", "_rank", "_text"))):
            raw = text.encode()
            room = max(len(raw) - WINDOW, 0)
            at = sorted({room * k // max(SAMPLE_WINDOWS - 1, 1) for k in range(SAMPLE_WINDOWS)})
            for a in at:
                names.append(lang)
                ranks.append(rank)
                windows.append(raw[a : a + WINDOW])
        yield record(lang=pa.array(names, pa.string()), rank=pa.array(ranks, pa.int64()), window=pa.array(windows, pa.binary()))


def fit(docs: DataFrame, learn: Column, id_col="doc_id", text_col="text", lang_col="lang", sample=SAMPLE_DOCS) -> Model | None:
    """Train on a sample of the rows that ``learn`` selects; null without any.

    At most ``sample`` rows for each language, whatever rows repeat an id or a text.
    """
    learnt = docs.where(learn & F.col(lang_col).isNotNull() & (F.length(text_col) > 0)).select(
        F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text"),
        F.xxhash64(F.col(id_col), F.lit("lang")).alias("_rank"), F.xxhash64(text_col).alias("_hash"),
    )
    first = Window.partitionBy("_lang").orderBy("_rank", "_id", "_hash")
    place = F.row_number().over(first)
    # The group limit below the shuffle leaves ``sample`` short rows for each language in a task.
    chosen = learnt.drop("_text").withColumn("_place", place).where(F.col("_place") <= sample).drop("_place").distinct()
    # Repeated rows join more than once; they are cut to the sample again.
    keys = ["_id", "_lang", "_rank", "_hash"]
    rows = learnt.join(F.broadcast(chosen), keys).withColumn("_place", place).where(F.col("_place") <= sample).select(
        "_lang", "_rank", "_text"
    ).mapInArrow(_sample_windows, "lang string, rank long, window binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r.lang, r.rank, bytes(r.window)))
    return train([bytes(r.window) for r in rows], [r.lang for r in rows])


def _lettered(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has a letter."""
    letters = np.append(0, np.cumsum(_LETTER[data]))
    lettered = letters[offsets[1:]] > letters[offsets[:-1]]
    for i in np.flatnonzero(~lettered & (np.diff(offsets) > 0)):
        lettered[i] = any(ch.isalpha() for ch in data[offsets[i] : offsets[i + 1]].tobytes().decode())
    return lettered


def with_letters(docs: DataFrame, text_col="text") -> DataFrame:
    """The documents whose text has a letter: those that a model finds a language for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_chunks(batches, text_col):
            yield batch.filter(pa.array(_lettered(data, offsets)))

    return docs.mapInArrow(tidy(run), docs.schema)


def predict(docs: DataFrame, model: Model | None, text_col="text", lang_out="lang_pred", score_out="score") -> DataFrame:
    """All columns of the documents with the predicted language and its score."""
    docs = docs.drop(lang_out, score_out)
    schema = docs.select("*", F.lit("").alias(lang_out), F.lit(0.0).alias(score_out)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_chunks(batches, text_col):
            n = batch.num_rows
            langs, score = ["und"] * n, np.zeros(n)
            if model is not None:
                p = document_probabilities(data, offsets, model)
                lettered = _lettered(data, offsets)
                best = p.argmax(axis=1)
                langs = [model.langs[b] if ok else "und" for b, ok in zip(best, lettered)]
                score = np.where(lettered, p.max(axis=1), 0.0)
            columns = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(langs, pa.string()), pa.array(score, pa.float64())], names=schema.names
            )

    return docs.mapInArrow(tidy(run), schema)
