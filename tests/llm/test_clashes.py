"""Documents whose further columns bear the names that operators add or use inside."""

from __future__ import annotations

import re
from pathlib import Path

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import sheafwork.llm
from sheafwork.llm import fuzzy, hostgraph, jaccard, langid, linededup, mixing, packing, pfor, quality, repeats
from sheafwork.llm.jobs import prepare

TAKEN = {"doc_id", "text", "lang", "source", "n_chars", "page_id", "url", "html"}


def _names() -> list[str]:
    """Every plain or underscored word that stands quoted in an operator: a superset of their column names."""
    found = set()
    for file in Path(sheafwork.llm.__file__).parent.glob("*.py"):
        found |= set(re.findall(r"""["'. ](_?[a-z][a-z_]{0,20})["', )]""", file.read_text()))
    return sorted(found - TAKEN)


@pytest.fixture(scope="module")
def docs(spark):
    # Half of the names in capitals: names differ by more than case.
    rows = [(i, f"word{i % 3} " * 60 + f"x{i}\nline", ["en", "de"][i % 2], ["a", None][i % 2], 1) for i in range(12)]
    plain = prepare(spark).createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return plain.select("*", *[F.lit(k).alias(n.upper() if k % 2 else n) for k, n in enumerate(_names())])


def test_stages(spark, docs):
    for name, fn in corpus_pipeline.STAGES:
        out = fn(spark, docs, "")
        assert out.count() > 0
        if name != "pack":
            assert out.columns == docs.columns and out.schema["text"] == docs.schema["text"]


def test_operators(spark, docs):
    word, byte = (public_tokenizers.path(p) for p in ("word_bpe_49k.json", "byte_bpe_50k.json"))
    assert fuzzy.fingerprint_table(docs).count() == 12
    assert mixing.mix_sources(docs, repetition=1.5).select("_mix.copies").count() == 12
    assert langid.predict(docs, None).select("lang_pred", "score").distinct().collect() == [("und", 0.0)]
    assert pfor.read_ids(pfor.write_ids(docs, byte, 2)).count() == 12
    assert linededup.drop_common_lines(docs).select("n_dropped").groupBy().sum().first()[0] == 12
    assert quality.judge(docs, quality.fit(docs, docs.select("doc_id", "score", F.lit(1).alias("quality")))).count() == 12
    assert packing.pack(docs, word, 1).groupBy("doc_id").count().count() == 12
    assert jaccard.components_table(docs).count() == 12
    assert repeats.drop_repeats(docs).count() == 12
    pages = docs.select("*", F.col("doc_id").alias("page_id"), F.lit("http://a.net/").alias("url"), F.col("text").alias("html"))
    assert hostgraph.judge_urls(pages, (("block", "net/"),)).where("verdict = 'block'").count() == 12
