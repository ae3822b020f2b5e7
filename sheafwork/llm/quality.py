"""Quality rules: text counts with fixed limits, then a learned verdict.

The verdict comes from a logistic regression over hashed n-grams: words and
word pairs, and 3-grams and 4-grams of the characters (code points) of the text
with A-Z in lower case. A feature is
the share of a bucket among the n-grams of its group, so long and short texts
are alike. The model is fitted with numpy on a bounded sample of labelled rows
(``SAMPLE_ROWS``, half of each class, by a hash of the id), calibrated by a
logistic curve on the third of the sample it has not seen, and applied in Arrow
batches to whole texts. Labels are used for fitting only.

Defined cases: a null text has no words and fails the base rules. Null labels
are left out. A repeated label counts once, and so do rows of one id and text;
of an id with several texts each may be in the sample, which is cut to
its bound after the texts are known (ties go by features). Without labelled rows of both classes the model keeps what the
base rules keep (score 1). Rows with one id are judged one by one. A very long
text is judged whole, in one chunk of a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheafwork.llm.jobs import record
from sheafwork.llm.textops import (
    byte_hashes, code_points, lower_ascii, mix, owner, span_hashes, text_chunks, windows, word_spans,
)

#: Labelled rows used for fitting, half of each class.
SAMPLE_ROWS = 1200
BUCKETS = 1 << 13
GROUPS = ("words", "pairs", "chars3", "chars4")
THRESHOLD = 0.5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # [groups, buckets]
    bias: float
    slope: float  # calibration
    shift: float

    def probability(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * z + self.shift, -50, 50)))


def _ngrams(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each group: bucket of every n-gram, and the first n-gram of each document (n + 1)."""
    low = lower_ascii(data)
    starts, ends, first = word_spans(low, offsets)
    words = byte_hashes(low, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    at, pairs = windows(words, first, 2)
    out = [(words, first), (pairs, np.searchsorted(at, first))]
    # A character is the number that its bytes spell.
    lead = np.flatnonzero((low & 0xC0) != 0x80)
    size = np.minimum(np.diff(np.append(lead, len(low))), 4).astype(np.uint64)
    padded = np.append(low, np.zeros(8, np.uint8))
    chars = np.ndarray((len(low),), "<u8", padded, strides=(1,))[lead] & ((np.uint64(1) << (size * np.uint64(8))) - np.uint64(1))
    begins = np.searchsorted(lead, offsets)  # first character of each document
    for n in (3, 4):
        counts = np.maximum(np.diff(begins) - n + 1, 0)
        index = np.append(0, np.cumsum(counts))
        at = np.arange(index[-1]) + np.repeat(begins[:-1] - index[:-1], counts)
        grams = np.full(len(at), n, np.uint64)
        for k in range(n):
            grams = mix(grams ^ chars[at + k])
        out.append((grams, index))
    return [((h & np.uint64(BUCKETS - 1)).astype(np.int32), f) for h, f in out]


def _means(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.append(0.0, np.cumsum(values, dtype=np.float64))
    return (total[first[1:]] - total[first[:-1]]) / np.maximum(np.diff(first), 1)


def scores(data: np.ndarray, offsets: np.ndarray, model: Model) -> np.ndarray:
    """Uncalibrated score of each text."""
    z = np.full(len(offsets) - 1, model.bias)
    for (bucket, first), w in zip(_ngrams(data, offsets), model.weights):
        z += _means(w[bucket], first)
    return z


def text_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of each text."""
    n = len(offsets) - 1
    starts, ends, first = word_spans(data, offsets)
    symbols = np.append(0, np.cumsum(_SYMBOL[data], dtype=np.int64))
    chars = np.append(0, np.cumsum(code_points(data, starts, ends)))
    words = byte_hashes(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    at, grams = windows(words, first, 3)
    covered = np.zeros(len(words) + 3, np.int64)
    if len(at):
        doc = owner(first, at)
        again = _repeated(doc, grams)
        np.add.at(covered, at[again], 1)
        np.add.at(covered, at[again] + 3, -1)
    covered = np.append(0, np.cumsum(np.cumsum(covered[: len(words)]) > 0))
    return {
        "n_words": np.diff(first),
        "word_chars": chars[first[1:]] - chars[first[:-1]],
        "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
        "n_dup_lines": _duplicate_lines(data, offsets, starts, n),
        "n_repeat_words": covered[first[1:]] - covered[first[:-1]],
    }


def _repeated(doc: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Marks entries whose key occurs at least twice in their document."""
    order = np.lexsort((key, doc))
    same = np.zeros(len(order) + 1, dtype=bool)
    same[1:-1] = (doc[order][1:] == doc[order][:-1]) & (key[order][1:] == key[order][:-1])
    out = np.zeros(len(order), dtype=bool)
    out[order] = same[1:] | same[:-1]
    return out


def _duplicate_lines(data, offsets, word_starts, n) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    if len(data) == 0:
        return np.zeros(n, np.int64)
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.concatenate([offsets[:-1], breaks + 1])
    ends = np.concatenate([offsets[1:], breaks])
    doc = np.concatenate([np.arange(n), np.searchsorted(offsets, breaks, "right") - 1])
    # A text's first line ends at its first break, its last line at the text's end.
    order = np.lexsort((starts, doc))
    starts, doc = starts[order], doc[order]
    ends = ends[np.lexsort((ends, np.concatenate([np.arange(n), np.searchsorted(offsets, breaks, "right") - 1])))]
    worded = np.searchsorted(word_starts, ends) > np.searchsorted(word_starts, starts)
    starts, ends, doc = starts[worded], ends[worded], doc[worded]
    if len(starts) == 0:
        return np.zeros(n, np.int64)
    key = byte_hashes(data, starts, ends)
    order = np.lexsort((starts, key, doc))
    same = np.zeros(len(order), dtype=bool)
    same[1:] = (doc[order][1:] == doc[order][:-1]) & (key[order][1:] == key[order][:-1])
    return np.bincount(doc[order][same], minlength=n)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in text_chunks(batches, "_text"):
        grams = _ngrams(data, offsets)
        labels = batch.column("_label").to_pylist()
        for d, label in enumerate(labels):
            index, value = [], []
            for g, (bucket, first) in enumerate(grams):
                mine, count = np.unique(bucket[first[d] : first[d + 1]], return_counts=True)
                index.append(mine + g * BUCKETS)
                value.append(count / max(count.sum(), 1))
            yield record(
                label=pa.array([label], pa.int32()),
                rank=pa.array(batch.column("_rank").slice(d, 1)),
                index=pa.array([np.concatenate(index).astype("<i4").tobytes()], pa.binary()),
                value=pa.array([np.concatenate(value).astype("<f4").tobytes()], pa.binary()),
            )


def fit(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="quality", rows=SAMPLE_ROWS) -> Model:
    """Fit and calibrate on a bounded sample of labelled rows."""
    rank = F.xxhash64(F.col(id_col), F.lit("quality"))
    marked = labels.select(
        F.col(id_col).cast("long").alias("_id"), (F.col(label_col) > 0).cast("int").alias("_label"), rank.alias("_rank")
    ).where("_label is not null")
    sample = None
    for label in (0, 1):
        one = marked.where(F.col("_label") == label).orderBy("_rank", "_id").limit(rows // 2)
        sample = one if sample is None else sample.union(one)
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    # The sample has at most ``rows`` rows of three numbers.
    features = texts.join(F.broadcast(sample.distinct()), "_id").select("_label", "_rank", "_text").mapInArrow(
        _features, "label int, rank long, index binary, value binary"
    )
    # Rows that repeat an id are cut to the sample again; the group limit does so in each task.
    place = F.row_number().over(Window.partitionBy("label").orderBy("rank", "index", "value"))
    found = features.distinct().withColumn("_place", place).where(F.col("_place") <= rows // 2).drop("_place").collect()
    found.sort(key=lambda r: (r.rank, r.label, bytes(r["index"])))
    return train(
        np.array([r.label for r in found], np.float64),
        [np.frombuffer(r["index"], "<i4") for r in found], [np.frombuffer(r["value"], "<f4") for r in found],
    )


def train(y: np.ndarray, index: list[np.ndarray], value: list[np.ndarray], steps: int = 150, decay: float = 1e-6) -> Model:
    """Logistic regression by AdaGrad on two thirds, calibration on the rest."""
    size = len(GROUPS) * BUCKETS
    if len(set(y.tolist())) < 2:
        return Model(np.zeros((len(GROUPS), BUCKETS), np.float32), 0.0, 0.0, 50.0)
    held = np.arange(len(y)) % 3 == 2
    if len(set(y[held].tolist())) < 2 or len(set(y[~held].tolist())) < 2:
        held[:] = False
    doc = np.repeat(np.arange(len(y)), [len(i) for i in index])
    flat, x = np.concatenate(index), np.concatenate(value).astype(np.float64)
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())) * ~held
    w, bias, grads, grad_bias = np.zeros(size), 0.0, np.full(size, 1e-8), 1e-8
    for _ in range(steps):
        z = np.bincount(doc, w[flat] * x, minlength=len(y)) + bias
        error = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) * weight / max(weight.sum(), 1)
        g = np.bincount(flat, error[doc] * x, minlength=size) + decay * w
        grads += g * g
        w -= 0.5 * g / np.sqrt(grads)
        grad_bias += error.sum() ** 2
        bias -= 0.1 * error.sum() / np.sqrt(grad_bias)
    z = np.bincount(doc, w[flat] * x, minlength=len(y)) + bias
    use = held if held.any() else ~held
    slope, shift = _calibrate(z[use], y[use])
    return Model(w.reshape(len(GROUPS), BUCKETS).astype(np.float32), float(bias), slope, shift)


def _calibrate(z: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Logistic curve over scores (Newton steps on smoothed targets)."""
    up, down = y.sum(), (1 - y).sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    design = np.stack([z, np.ones_like(z)], axis=1)
    theta = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -50, 50)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        theta = theta - np.linalg.solve(hessian, design.T @ (p - target) + 1e-3 * (theta - [1.0, 0.0]))
        if not np.isfinite(theta).all() or theta[0] <= 0:
            return 1.0, 0.0
    return float(theta[0]), float(theta[1])


def judge(docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col="doc_id", text_col="text") -> DataFrame:
    """Counts, base rules, score and verdict of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_chunks(batches, "_text"):
            c = text_counts(data, offsets)
            p = model.probability(scores(data, offsets, model))
            failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])
            yield record(
                doc_id=batch.column("_id"), **{k: pa.array(v, pa.int64()) for k, v in c.items()},
                base_failed=pa.array(failed), kept=pa.array(~failed & (p >= threshold)), score=pa.array(p, pa.float64()),
            )

    return docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).mapInArrow(
        run,
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, score double",
    )


__all__ = ["Model", "fit", "train", "judge", "scores", "text_counts", "span_hashes"]
