"""Training-data pipeline over the documents table.

``STAGES`` are applied one after another; each takes all documents that its
predecessor kept and returns a DataFrame with the columns of documents, the
last one the pieces of the packed sequences.

1. language ID: documents without a language (``und``: no letter in the text) go.
2. line dedup: lines that ten documents hold go from all of them.
3. near duplicates: one document of each component of five-word shingle sets
   with a likeness of 0.8 stays.
4. mixing: sources are repeated as a flatter mix asks, each document at least once.
5. packing: the mix is packed into sequences to the sources' token proportions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork.llm import jaccard, langid, linededup, mixing, packing
from sheafwork.llm.jobs import documents, every, free, prepare, stage
from sheafwork.llm.queries import REPETITION, WORD_END_ID, held_out, tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language. Learns from the rows that are not held out.

    Every document with a letter has a language, whichever the model finds;
    without labelled rows there is no model, and the same documents stay.
    """
    prepare(spark)
    model = langid.fit(docs, F.coalesce(~held_out(), F.lit(False)))
    if model is None:
        return langid.with_letters(docs)
    name = free(docs, "_found")
    found = langid.predict(docs, model, lang_out=f"{name}_lang", score_out=f"{name}_score")
    return found.where(F.col(f"{name}_lang") != "und").select(*every(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without common lines; ``n_chars`` follows the text."""
    prepare(spark)
    added = free(docs, "_lines")
    kept = linededup.drop_common_lines(docs, counts=(f"{added}_all", f"{added}_dropped"))
    columns = [
        F.length("text").cast("long").alias(name) if name == "n_chars" else c for name, c in zip(docs.columns, every(docs))
    ]
    return kept.select(*columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    prepare(spark)
    return jaccard.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix uses them; every document at least once."""
    prepare(spark)
    name = free(docs, "_mix")
    return mixing.repeat_rows(mixing.mix_sources(docs, repetition=REPETITION, out=name), name)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences."""
    prepare(spark)
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), WORD_END_ID)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mix", mix),
    ("pack", pack),
]

#: The stages learn, follow links and tokenize: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each result written and reread."""
    docs = documents(prepare(spark), sf_dir)
    for name, fn in STAGES[:-1]:
        docs = stage(fn(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
