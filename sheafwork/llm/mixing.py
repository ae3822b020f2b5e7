"""Temperature mixing of sources to target weights.

A source's weight is its token share to the power of an exponent between 0
(all alike) and 1 (as they are), normalised. The exponent is bisected so that
the weights have a target entropy, or so that they are as flat as a limit on
the repetition of any source allows.

The weights become token budgets. A source goes through its documents epoch by
epoch until its budget is spent: documents lie in blocks by a hash, and every
epoch has its own permutation of the blocks and of the documents in a block.
Only the last epoch is cut. The cut is a key of the permutation, found by a
running total over a range-partitioned table of keys and token counts; a
document is in the last epoch if its key is not beyond the cut. So the result
depends on the row only, and no text is shuffled.

Defined cases: a null text has no tokens; a null source is one of its own;
sources without tokens are kept once. Equal rows are taken together. With no
rows there are no weights and no result. The result's struct column replaces
one of its name; all other columns are kept, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafwork.llm.jobs import every, free, record, stage, task_number, task_offsets

BLOCKS = 4096
SEED = 11


def word_tokens(text_col: str = "text") -> Column:
    """Words as a measure of tokens."""
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


@dataclass(frozen=True)
class Share:
    tokens: int
    weight: float
    budget: int

    @property
    def epochs(self) -> int:
        """Whole epochs."""
        return self.budget // self.tokens if self.tokens else 1

    @property
    def rest(self) -> int:
        """Tokens of the last epoch."""
        return self.budget - self.epochs * self.tokens if self.tokens else 0


def _weights(tokens: list[int], exponent: float) -> list[float]:
    total = sum(tokens)
    raw = [(t / total) ** exponent if t else 0.0 for t in tokens]
    return [r / sum(raw) for r in raw]


def _budget(tokens: list[int], weights: list[float], budget: int | None) -> float:
    """Tokens to spend; without a given number, as few as use every source once."""
    return float(budget) if budget is not None else max(t / w for t, w in zip(tokens, weights) if t)


def solve(
    totals: dict[str | None, int], budget: int | None = None, entropy: float | None = None, repetition: float | None = None
) -> dict[str | None, Share]:
    """Weights and budgets by source.

    ``entropy`` is a share (0 to 1) of the largest possible entropy;
    ``repetition`` limits how often any source's tokens are used. With neither,
    shares stay as they are. Targets out of reach give the nearest exponent.
    """
    live = {s: t for s, t in totals.items() if t > 0}
    tokens = list(live.values())

    def too_flat(exponent: float) -> bool:
        w = _weights(tokens, exponent)
        if entropy is not None:
            return -sum(x * math.log(x) for x in w if x > 0) > entropy * math.log(len(w))
        spend = _budget(tokens, w, budget)
        return max(spend * x / t for x, t in zip(w, tokens)) > repetition

    exponent = 1.0
    if tokens and len(tokens) > 1 and (entropy is not None or repetition is not None):
        low, high = 0.0, 1.0
        if too_flat(low):
            for _ in range(60):
                middle = (low + high) / 2
                low, high = (middle, high) if too_flat(middle) else (low, middle)
            exponent = high
        else:
            exponent = 0.0
    shares = {s: Share(0, 0.0, 0) for s in totals}
    if tokens:
        weights = _weights(tokens, exponent)
        spend = _budget(tokens, weights, budget)
        for (s, t), w in zip(live.items(), weights):
            # A budget a hair below a whole epoch is that epoch.
            shares[s] = Share(t, w, math.floor(spend * w + 1e-6 * t + 1e-9))
    return shares


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, total = task_number(), {}
    for batch in batches:
        sources, local = batch.column("_source").to_pylist(), []
        for s, n in zip(sources, batch.column("_tokens").to_pylist()):
            total[s] = total.get(s, 0) + n
            local.append(total[s])
        yield record(
            task=pa.array([task] * len(local), pa.int64()), _source=pa.array(sources, pa.string()),
            _block=batch.column("_block"), _doc=batch.column("_doc"), _tokens=batch.column("_tokens"),
            _local=pa.array(local, pa.int64()),
        )


def mix_sources(
    docs: DataFrame, budget: int | None = None, entropy: float | None = None, repetition: float | None = None,
    tokens: Column | None = None, seed: int = SEED, id_col="doc_id", text_col="text", source_col="source",
    out: str = "_mix",
) -> DataFrame:
    """Documents with ``copies`` (0 and up), ``weight`` and ``n_tokens``, in a struct column ``out``.

    One row for each source comes to the driver.
    """
    spark = docs.sparkSession
    tokens = word_tokens(text_col) if tokens is None else tokens
    source = F.col(source_col).cast("string")
    docs = docs.drop(out)
    totals = {r[0]: int(r[1]) for r in docs.groupBy(source.alias("_source")).agg(F.sum(tokens)).collect()}
    shares = solve(totals, budget, entropy, repetition)
    table = spark.createDataFrame(
        [(s, x.epochs, x.rest, x.weight) for s, x in shares.items()], "_s string, _epochs long, _rest long, _weight double"
    )
    row = F.xxhash64(F.col(id_col), F.col(text_col))
    block = F.pmod(F.col("_row"), F.lit(BLOCKS))
    # Keys of the last epoch's permutation: of the block, then of the document in it.
    block_key = F.xxhash64(F.lit(seed), F.col("_epochs"), F.col("_s"), block)
    doc_key = F.xxhash64(F.lit(seed), F.col("_epochs"), F.col("_row"))
    narrow = docs.select(source.alias("_source"), row.alias("_row"), tokens.alias("_tokens"))
    known = narrow.join(F.broadcast(table), F.col("_source").eqNullSafe(F.col("_s")))
    keys = (
        known.where("_rest > 0").select("_source", block_key.alias("_block"), doc_key.alias("_doc"), "_tokens")
        .groupBy("_source", "_block", "_doc").agg(F.sum("_tokens").alias("_tokens"))
        .repartitionByRange("_source", "_block", "_doc").sortWithinPartitions("_source", "_block", "_doc")
    )
    totals_run = stage(
        keys.mapInArrow(_running, "task long, _source string, _block long, _doc long, _tokens long, _local long"), "mix_keys"
    )
    before = task_offsets(totals_run, "_tokens", ("_source",)).select(
        F.col("task").alias("_t"), F.col("_source").alias("_o"), "before"
    )
    taken = (
        totals_run.join(before, (F.col("task") == F.col("_t")) & F.col("_source").eqNullSafe(F.col("_o")))
        .join(F.broadcast(table), F.col("_source").eqNullSafe(F.col("_s")))
        .where(F.col("_local") + F.col("before") <= F.col("_rest"))
        .groupBy("_source").agg(F.max(F.struct("_block", "_doc")).alias("cut"))
    )
    cuts = {r[0]: r[1] for r in taken.collect()}
    # Beside the documents' own columns, names that none of them begins with.
    p = free(docs, "_m")
    table = spark.createDataFrame(
        [(s, x.epochs, x.weight, *(cuts.get(s) or (None, None))) for s, x in shares.items()],
        f"{p}_s string, {p}_epochs long, {p}_weight double, {p}_cut_block long, {p}_cut_doc long",
    )
    key = F.xxhash64(F.lit(seed), F.col(f"{p}_epochs"), F.col(f"{p}_s"), F.pmod(row, F.lit(BLOCKS)))
    inner = F.xxhash64(F.lit(seed), F.col(f"{p}_epochs"), row)
    cut_block, cut_doc = F.col(f"{p}_cut_block"), F.col(f"{p}_cut_doc")
    in_last = F.coalesce((key < cut_block) | ((key == cut_block) & (inner <= cut_doc)), F.lit(False))
    mixed = docs.select(*every(docs), source.alias(f"{p}_source")).join(
        F.broadcast(table), F.col(f"{p}_source").eqNullSafe(F.col(f"{p}_s"))
    )
    return mixed.select(
        *every(docs),
        F.struct(
            (F.col(f"{p}_epochs") + in_last.cast("long")).alias("copies"),
            F.col(f"{p}_weight").alias("weight"), tokens.alias("n_tokens"),
        ).alias(out),
    )


def repeat_rows(mixed: DataFrame, out: str = "_mix") -> DataFrame:
    """Every document as often as its ``copies``; the columns of the documents."""
    docs = mixed.drop(out)
    number = F.explode(F.sequence(F.lit(1), F.col(f"{out}.copies"))).alias(free(mixed, "_copy"))
    return mixed.where(F.col(f"{out}.copies") > 0).select(*every(docs), number).select(*every(docs))
