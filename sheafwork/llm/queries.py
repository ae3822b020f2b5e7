"""Registered queries of the operators, with production parameters.

``QUERIES`` maps names to ``fn(spark, sf_dir)``; ``ORACLE_SQL`` holds the SQL of
those that SQL can express. The others are tested against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork.llm import (
    fuzzy, hostgraph, jaccard, langid, linededup, mixing, packing, pfor, prefixtrie, quality, repeats, rtree, tilejoin,
)
from sheafwork.llm.jobs import documents, prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: Repetition limit of the registered mix; its budget is all tokens once.
REPETITION = 1.25
URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
BYTE_END_ID = 2
WORD_END_ID = 1


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def register(name: str, sql: str | None = None):
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir.rstrip("/"))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLE_SQL[name] = sql
        return fn

    return wrap


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op1_fuzzy_fingerprint")
def fuzzy_fingerprint(spark, sf_dir):
    """Piecewise fingerprints of texts and edited texts, with likenesses."""
    return fuzzy.fingerprint_table(documents(spark, sf_dir))


@register("op2_temperature_mix")
def temperature_mix(spark, sf_dir):
    """Copies of each document in a mix of all tokens' size, no source above the repetition limit."""
    docs = documents(spark, sf_dir)
    budget = docs.agg(F.sum(mixing.word_tokens())).first()[0] or 0
    mixed = mixing.mix_sources(docs, budget=int(budget), repetition=REPETITION)
    return mixed.select("doc_id", "source", "_mix.n_tokens", "_mix.weight", "_mix.copies")


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string")) % 4 == 2


@register("op3_language_id")
def language_id(spark, sf_dir):
    """Predicted language of every document."""
    docs = documents(spark, sf_dir)
    learn = F.coalesce(~held_out(), F.lit(False))
    found = langid.predict(docs.select("doc_id", "text"), langid.fit(docs, learn))
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


_HOSTS_SQL = r"""
WITH RECURSIVE rules(action, suffix, path, rule) AS (
  VALUES ('block', 'net', '/', 'net/'), ('allow', 'example.net', '/en/', 'example.net/en/'),
         ('block', 'example.com', '/de/', 'example.com/de/'), ('allow', 'org', '/fr/', 'org/fr/')
), rest AS (
  SELECT page_id, html,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), named AS (
  SELECT page_id, html,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM rest
), ruled AS (
  SELECT n.page_id, n.host, n.path, r.rule, r.action
  FROM named n LEFT JOIN rules r
    ON (n.host = r.suffix OR ends_with(n.host, '.' || r.suffix)) AND starts_with(n.path, r.path)
  QUALIFY row_number() OVER (PARTITION BY n.page_id ORDER BY length(r.rule) DESC) = 1
), seeds AS (
  SELECT kind, host, seed FROM (
    SELECT 'trust' AS kind, host, avg(CASE WHEN action = 'allow' THEN 1.0 ELSE 0.0 END) AS seed FROM ruled GROUP BY host
    UNION ALL
    SELECT 'distrust', host, avg(CASE WHEN action = 'block' THEN 1.0 ELSE 0.0 END) FROM ruled GROUP BY host
  ) WHERE host <> '' AND seed > 0
), links AS (
  SELECT host AS src, translate(dst, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst
  FROM (SELECT host, unnest(regexp_extract_all(
          coalesce(html, ''), '(?i)href\s*=\s*["'']?\s*(?:https?:)?//([^/?#"''\s>]+)', 1)) AS dst
        FROM named WHERE host <> '')
), edges AS (
  SELECT src, dst, count(*) AS n FROM links WHERE src <> dst GROUP BY src, dst
), both_ways AS (
  SELECT 'trust' AS kind, src, dst, n FROM edges UNION ALL SELECT 'distrust', dst, src, n FROM edges
), flow AS (
  SELECT kind, src AS host, dst, n / sum(n) OVER (PARTITION BY kind, src) AS part FROM both_ways
), walk(k, kind, host, score) AS (
  SELECT 0, kind, host, seed FROM seeds
  UNION ALL
  SELECT any_value(w.k) + 1, w.kind, f.dst, sum(0.5 * w.score * f.part)
  FROM walk w JOIN flow f ON w.kind = f.kind AND w.host = f.host
  WHERE w.k < 8
  GROUP BY w.kind, f.dst
), verdicts AS (
  SELECT host, sum(CASE WHEN kind = 'distrust' THEN score ELSE -score END) AS distrust FROM walk GROUP BY host
)
SELECT page_id, r.host, path, rule,
       coalesce(action, CASE WHEN distrust > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled r LEFT JOIN verdicts v ON r.host = v.host
"""


@register("op4_host_graph", _HOSTS_SQL)
def host_graph(spark, sf_dir):
    """Rules, else trust and distrust over the link graph, for every page."""
    found = hostgraph.judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict")


@register("op5_token_files")
def token_files(spark, sf_dir):
    """Token files of all documents, read back."""
    files = pfor.write_ids(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), BYTE_END_ID)
    return pfor.read_ids(files)


_LINES_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), common AS (
  SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(c.k) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE c.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common c ON keyed.k = c.k
GROUP BY doc_id
"""


@register("op6_line_runs", _LINES_SQL)
def line_runs(spark, sf_dir):
    """Documents without the lines that ten documents hold."""
    kept = linededup.drop_common_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@register("op7_quality")
def quality_rules(spark, sf_dir):
    """Base counts and rules, and the learned verdict, of every document."""
    docs = documents(spark, sf_dir)
    return quality.judge(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


@register("op8_mixture_packing")
def mixture_packing(spark, sf_dir):
    """All documents packed to the sources' own token proportions."""
    return packing.pack(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"), WORD_END_ID)


_JACCARD_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM docs WHERE len(words) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON a.doc_id = x.doc_id JOIN sizes y ON b.doc_id = y.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM docs
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
)
SELECT d.doc_id, coalesce(any_value(z.n), 0) AS n_shingles, min(r.other) AS component_id
FROM docs d JOIN reach r ON d.doc_id = r.doc_id LEFT JOIN sizes z ON d.doc_id = z.doc_id
GROUP BY d.doc_id
"""


@register("op9_jaccard_join", _JACCARD_SQL)
def jaccard_join(spark, sf_dir):
    """Shingle sets and near-duplicate components of all documents."""
    return jaccard.components_table(documents(spark, sf_dir))


_REPEATS_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
  SELECT doc_id, i, array_to_string(words[i : i + 19], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM docs WHERE len(words) >= 20)
), later AS (
  SELECT doc_id, i FROM starts QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, i) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS pos FROM later
), placed AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM docs
), kept AS (
  SELECT p.doc_id, count(g.pos) AS n_removed,
         string_agg(word, ' ' ORDER BY p.pos) FILTER (WHERE g.pos IS NULL) AS text
  FROM placed p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.pos = g.pos
  GROUP BY p.doc_id
)
SELECT d.doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""


@register("op10_repeated_passages", _REPEATS_SQL)
def repeated_passages(spark, sf_dir):
    """Words left and removed when repeats of 20 words go."""
    kept = repeats.drop_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


_NEGATIVES_SQL = r"""
WITH good AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
  FROM good a JOIN good c ON a.vec_id <> c.vec_id
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


@register("op11_hard_negatives", _NEGATIVES_SQL)
def hard_negatives(spark, sf_dir):
    """Rows of other labels scored within 30 to 90 percent of each anchor's five positives."""
    label = F.col("label").cast("long")
    shifted = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", shifted.alias("label"))
    return rtree.hard_negatives(rows, F.col("vec_id") % 100 == 0)


_NEAREST_SQL = r"""
WITH good AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         sqrt(list_sum(list_transform(list_zip(q.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS score
  FROM good q JOIN good c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@register("op12_block_matrix_join", _NEAREST_SQL)
def block_matrix_join(spark, sf_dir):
    """The ten nearest rows of every hundredth row."""
    return tilejoin.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


_TRIE_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id,
         list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, md5(length(role) || ':' || role || text)) AS turns,
         -- CRC-32, bit by bit, of the decimal id
         xor(4294967295, list_reduce(
           list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
           lambda crc, byte: list_reduce(
             list_prepend(xor(crc, byte), range(8)), lambda bits, step: xor(bits >> 1, 3988292384 * (bits & 1))
           ))) % 9 AS h
  FROM turns GROUP BY conv_id
), built AS (
  SELECT o.conv_id, list_concat(coalesce(d.turns[1 : o.h], []), o.turns[o.h + 1 :]) AS turns
  FROM own o LEFT JOIN own d ON d.conv_id = o.conv_id - o.conv_id % 5
), prefixes AS (
  SELECT conv_id, depth, turns[1 : depth] AS prefix, len(turns) AS size
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM built)
), nodes AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, prefix[1 : depth - 1] AS parent,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE size = depth), '')) AS ends_sha256
  FROM prefixes GROUP BY prefix, depth
), children AS (
  SELECT parent AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent
), counted AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children,
         CASE WHEN depth > 0 THEN (n_convs - 1) * strlen(n.prefix[depth].text) ELSE 0 END AS saved
  FROM nodes n LEFT JOIN children c ON n.prefix = c.prefix
), below AS (
  SELECT prefix[1 : up] AS prefix, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM counted) GROUP BY prefix[1 : up]
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM counted n JOIN below b ON n.prefix = b.prefix LEFT JOIN nodes p ON n.depth > 0 AND n.parent = p.prefix
"""


@register("op13_prefix_trie", _TRIE_SQL)
def prefix_trie(spark, sf_dir):
    """Trie of conversations that begin with turns of the first one of their five."""
    return prefixtrie.trie(prefixtrie.respliced(_table(spark, sf_dir, "conversations")))
