"""Array, map, struct and JSON queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheafwork.functions import nested
from sheafwork.queries.registry import big, money, query, real, table


def _words(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang", F.split("text", " ").alias("words"))


@query("array_job", "COL-01..06 SRT-06", """
WITH w AS (SELECT doc_id, string_split(text, ' ') AS words FROM documents)
SELECT doc_id, len(words) AS n, words[1] AS first_word, words[-1] AS last_word, words[100001] AS beyond,
       list_contains(words, 'and') AS has_and, CAST(coalesce(list_position(words, 'the'), 0) AS BIGINT) AS the_at,
       len(list_distinct(words)) AS n_distinct, list_sort(words)[1] AS smallest,
       array_to_string(list_sort(list_distinct(list_filter(words, lambda x: x IN ('and', 'the', 'of')))), ',') AS common,
       len(list_filter(words, lambda x: x <> 'the')) AS without_the, array_to_string(words[1:5], '|') AS opening,
       len(list_distinct(list_concat(words, ['one', 'two']))) AS n_union,
       len(list_distinct(list_filter(words, lambda x: x NOT IN ('and', 'the', 'of')))) AS n_except FROM w""")
def array_job(spark, sf):
    w = F.col("words")
    common = F.array(F.lit("and"), F.lit("the"), F.lit("of"))
    return _words(spark, sf).select(
        "doc_id", big(F.size(w)).alias("n"),
        F.get(w, 0).alias("first_word"), F.element_at(w, -1).alias("last_word"),
        F.try_element_at(w, F.lit(100001)).alias("beyond"),
        F.array_contains(w, "and").alias("has_and"), F.array_position(w, "the").alias("the_at"),
        big(F.size(F.array_distinct(w))).alias("n_distinct"), F.get(F.array_sort(w), 0).alias("smallest"),
        F.array_join(F.array_sort(F.array_intersect(w, common)), ",").alias("common"),
        big(F.size(F.array_remove(w, "the"))).alias("without_the"), F.array_join(F.slice(w, 1, 5), "|").alias("opening"),
        big(F.size(F.array_union(w, F.array(F.lit("one"), F.lit("two"))))).alias("n_union"),
        big(F.size(F.array_except(w, common))).alias("n_except"),
    )


@query("array_null_rules", "COL-01 COL-03 COL-06", """
SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN len(string_split(text, ' ')) END AS n,
       CASE WHEN doc_id % 5 <> 0 THEN list_contains(string_split(text, ' '), 'and') END AS has_and,
       len(string_split(text, ' ')) * 2 AS n_flat FROM documents""")
def array_null_rules(spark, sf):
    """Null arrays give null sizes and null membership; nested arrays flatten."""
    maybe = F.when(F.col("doc_id") % 5 != 0, F.col("words"))
    return _words(spark, sf).select(
        "doc_id", big(F.cardinality(maybe)).alias("n"), F.array_contains(maybe, "and").alias("has_and"),
        big(F.size(F.flatten(F.array("words", "words")))).alias("n_flat"),
    )


@query("hof_job", "COL-07", """
WITH w AS (SELECT doc_id, string_split(text, ' ') AS words FROM documents)
SELECT doc_id, CAST(list_sum(list_transform(words, lambda x: length(x))) AS BIGINT) AS letters,
       len(list_filter(words, lambda x: length(x) > 5)) AS long_words,
       len(list_filter(words, lambda x: starts_with(x, 'http'))) > 0 AS any_link,
       len(list_filter(words, lambda x: length(x) >= 30)) = 0 AS all_short FROM w""")
def hof_job(spark, sf):
    w = F.col("words")
    lengths = F.transform(w, lambda x: F.length(x).cast("bigint"))
    return _words(spark, sf).select(
        "doc_id", nested.fold(lengths, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("letters"),
        big(F.size(F.filter(w, lambda x: F.length(x) > 5))).alias("long_words"),
        F.exists(w, lambda x: x.startswith("http")).alias("any_link"),
        F.forall(w, lambda x: F.length(x) < 30).alias("all_short"),
    )


@query("vector_job", "COL-07", """
SELECT vec_id, label::BIGINT AS label, len(embedding) AS dims, embedding[1]::DOUBLE AS first_value, embedding[-1]::DOUBLE AS last_value,
       list_max(embedding)::DOUBLE AS top_value, len(list_filter(embedding, lambda x: x > 0)) AS positive FROM embeddings""")
def vector_job(spark, sf):
    e = F.col("embedding")
    return table(spark, sf, "embeddings").select(
        "vec_id", big("label").alias("label"), big(F.size(e)).alias("dims"),
        real(F.get(e, 0)).alias("first_value"), real(F.element_at(e, -1)).alias("last_value"),
        real(F.array_max(e)).alias("top_value"), big(F.size(F.filter(e, lambda x: x > 0))).alias("positive"),
    )


@query("explode_job", "COL-10", """
WITH w AS (SELECT lang, unnest(string_split(text, ' ')) AS word FROM documents)
SELECT lang, word, count(*) AS n FROM w GROUP BY 1, 2""")
def explode_job(spark, sf):
    return _words(spark, sf).select("lang", F.explode("words").alias("word")).groupBy("lang", "word").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("explode_outer_job", "COL-10", """
WITH w AS (SELECT lang, CASE WHEN doc_id % 5 <> 0 THEN string_split(text, ' ') END AS words FROM documents)
SELECT lang, CAST(sum(coalesce(len(words), 1)) AS BIGINT) AS outer_rows, CAST(sum(coalesce(len(words), 0)) AS BIGINT) AS inner_rows,
       CAST(max(len(words)) - 1 AS BIGINT) AS last_position FROM w GROUP BY 1""")
def explode_outer_job(spark, sf):
    """Outer explode keeps a row for a null array; positions start at 0."""
    rows = _words(spark, sf).select("lang", F.when(F.col("doc_id") % 5 != 0, F.col("words")).alias("words"))
    exploded = rows.select("lang", F.posexplode_outer("words").alias("pos", "word"))
    return exploded.groupBy("lang").agg(
        F.count(F.lit(1)).alias("outer_rows"), F.count("pos").alias("inner_rows"), big(F.max("pos")).alias("last_position")
    )


def order_items(spark, sf):
    """Orders as documents: one row per order with its line items, of which an order has a handful."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", F.struct(F.col("l_partkey").alias("part"), big("l_quantity").alias("qty"), money("l_extendedprice").alias("price")).alias("item")
    )
    return lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("item")).alias("items"))


@query("nested_total", "COL-08", """
SELECT l_orderkey, CAST(sum(CAST(l_quantity AS BIGINT) * CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
       count(*) AS n_items FROM lineitem GROUP BY 1""")
def nested_total(spark, sf):
    """Fold each order's items to its total."""
    total = nested.fold(
        F.col("items"), F.lit(0).cast("decimal(28,2)"),
        lambda a, x: (a + x["qty"] * x["price"]).cast("decimal(28,2)"),
    )
    return order_items(spark, sf).select("l_orderkey", real(total).alias("total"), big(F.size("items")).alias("n_items"))


@query("nested_discount", "COL-09 COL-11", """
SELECT l_orderkey, l_partkey AS part, CAST(l_quantity AS BIGINT) AS qty,
       CAST(CASE WHEN l_quantity >= 30 THEN round(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.9, 2) ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS DOUBLE) AS price
FROM lineitem""")
def nested_discount(spark, sf):
    """Rewrite prices inside the array, then flatten it again."""
    cut = F.transform(
        "items",
        lambda x: x.withField(
            "price",
            F.when(x["qty"] >= 30, F.round(x["price"] * F.lit(0.9).cast("decimal(2,1)"), 2).cast("decimal(18,2)"))
            .otherwise(x["price"]),
        ),
    )
    flat = order_items(spark, sf).select("l_orderkey", F.inline(cut))
    return flat.select("l_orderkey", "part", "qty", real("price").alias("price"))


@query("nested_round_trip", "COL-12 COL-17", """
SELECT l_orderkey, l_partkey AS part, CAST(l_quantity AS BIGINT) AS qty, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS price FROM lineitem""")
def nested_round_trip(spark, sf):
    flat = order_items(spark, sf).select("l_orderkey", F.explode("items").alias("i"))
    return flat.select("l_orderkey", F.col("i.part").alias("part"), F.col("i.qty").alias("qty"), real("i.price").alias("price"))


@query("struct_job", "COL-17", """
SELECT o_orderkey, o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(18,2))::DOUBLE AS price, o_custkey AS owner,
       o_orderpriority AS priority FROM orders""")
def struct_job(spark, sf):
    doc = F.struct(
        F.col("o_custkey").alias("owner"),
        F.struct(F.col("o_orderstatus").alias("status"), F.struct(money("o_totalprice").alias("price"),
                 F.col("o_orderpriority").alias("priority")).alias("detail")).alias("state"),
    )
    nested_rows = table(spark, sf, "orders").select("o_orderkey", doc.alias("d"))
    return nested_rows.select(
        "o_orderkey", "d.state.status", real("d.state.detail.price").alias("price"), "d.owner", "d.state.detail.priority"
    )


@query("map_job", "COL-13 COL-14 COL-16", """
WITH f AS (SELECT l_orderkey, l_returnflag AS flag, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey, max(CASE WHEN flag = 'R' THEN qty END) AS returned, count(*) AS n, string_agg(flag, ',' ORDER BY flag) AS flags,
       CAST(sum(qty) AS BIGINT) AS total, bool_or(flag = 'A') AS has_a, count(*) FILTER (qty > 50) AS heavy FROM f GROUP BY 1""")
def map_job(spark, sf):
    """Quantity by return flag as a map per order (few flags, so a map stays small)."""
    sums = table(spark, sf, "lineitem").groupBy("l_orderkey", F.col("l_returnflag").alias("flag")).agg(
        F.sum(big("l_quantity")).alias("qty")
    )
    maps = sums.groupBy("l_orderkey").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("flag", "qty")))).alias("m")
    )
    m = F.col("m")
    return maps.select(
        "l_orderkey", F.try_element_at(m, F.lit("R")).alias("returned"), big(F.size(m)).alias("n"),
        F.array_join(F.array_sort(F.map_keys(m)), ",").alias("flags"),
        nested.fold(F.map_values(m), F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"),
        F.map_contains_key(m, "A").alias("has_a"), big(F.size(F.map_filter(m, lambda k, v: v > 50))).alias("heavy"),
    )


@query("map_build_job", "COL-13 COL-15", """
SELECT c_custkey, c_mktsegment AS segment, CAST(c_nationkey AS VARCHAR) AS nation, c_name AS name, NULL::VARCHAR AS missing,
       3::BIGINT AS n FROM customer""")
def map_build_job(spark, sf):
    a = F.create_map(F.lit("segment"), F.col("c_mktsegment"), F.lit("nation"), F.col("c_nationkey").cast("string"))
    b = F.map_from_arrays(F.array(F.lit("name")), F.array("c_name"))
    rows = table(spark, sf, "customer").select("c_custkey", F.map_concat(a, b).alias("m"))
    m = F.col("m")
    return rows.select(
        "c_custkey", m["segment"].alias("segment"), m["nation"].alias("nation"), m["name"].alias("name"),
        m["missing"].alias("missing"), big(F.size(m)).alias("n"),
    )


# Every twentieth payload loses its closing brace.
_BROKEN = "CASE WHEN event_id % 20 = 0 THEN left(props, length(props) - 1) ELSE props END"


def _payloads(spark, sf):
    cut = F.when(F.col("event_id") % 20 == 0, F.expr("left(props, length(props) - 1)")).otherwise(F.col("props"))
    return table(spark, sf, "events").select("event_id", "event_type", cut.alias("payload"))


@query("json_job", "COL-18 COL-19 COL-20", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS k_text,
       json_extract_string(props, '$.k') AS k_tuple, json_extract_string(props, '$.none') AS nothing,
       '{"k":' || json_extract_string(props, '$.k') || ',"kind":"' || event_type || '"}' AS packed,
       'STRUCT<k: BIGINT>' AS shape FROM events""")
def json_job(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "props")
    parsed = nested.parse_json(events, "props", "k bigint")
    tupled = parsed.select("*", F.json_tuple("props", "k").alias("k_tuple"))
    k = F.col("parsed.k")
    return tupled.select(
        "event_id", k.alias("k"), F.get_json_object("props", "$.k").alias("k_text"), "k_tuple",
        F.get_json_object("props", "$.none").alias("nothing"),
        F.to_json(F.struct(k.alias("k"), F.col("event_type").alias("kind"))).alias("packed"),
        F.schema_of_json(F.lit('{"k": 1}')).alias("shape"),
    )


@query("json_good_rows", "COL-18 COL-21", f"""
SELECT event_id, CAST(json_extract_string(payload, '$.k') AS BIGINT) AS k FROM (SELECT event_id, {_BROKEN} AS payload FROM events)
WHERE json_valid(payload)""")
def json_good_rows(spark, sf):
    good, _ = nested.route_json(_payloads(spark, sf), "payload", "k bigint")
    return good.select("event_id", F.col("parsed.k").alias("k"))


@query("json_dead_letter", "COL-21 QLT-04", f"""
SELECT event_id, event_type, payload FROM (SELECT event_id, event_type, {_BROKEN} AS payload FROM events) WHERE NOT json_valid(payload)""")
def json_dead_letter(spark, sf):
    _, bad = nested.route_json(_payloads(spark, sf), "payload", "k bigint")
    return bad
