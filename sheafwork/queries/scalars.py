"""String, date and number functions inside table jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheafwork.plans.orders import normal_name
from sheafwork.queries.registry import big, money, query, real, table


@query("string_job", "STRF-01..06 STRF-09..12", """
SELECT c_custkey, trim('  ' || c_name || ' ') AS trimmed, length(ltrim('  ' || c_name || ' ')) AS left_len,
       length(rtrim('  ' || c_name || ' ')) AS right_len, upper(c_name) AS upped, lower(c_mktsegment) AS lowered,
       upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS titled, length(c_name) AS n_chars,
       substr(c_name, 1, 3) AS head, string_split(c_name, '#')[1] AS first_part, string_split(c_name, '#')[3] AS third_part,
       c_name || '/' || nullif(c_mktsegment, 'BUILDING') AS glued, concat_ws('/', c_name, nullif(c_mktsegment, 'BUILDING')) AS glued_ws,
       c_name LIKE 'Cust%1' AS like_one, contains(c_name, '#0000') AS has_zeroes, starts_with(c_name, 'Customer') AS starts,
       ends_with(c_name, '7') AS ends_seven, instr(c_name, '#') AS hash_at, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS padded,
       translate(c_name, 'Cus', 'kUS') AS translated, substr(c_name, 1, 2) || '__' || substr(c_name, 5) AS overlaid,
       'key=' || lpad(CAST(c_custkey AS VARCHAR), 5, '0') || ' seg=' || c_mktsegment AS formatted FROM customer""")
def string_job(spark, sf):
    name, seg = F.col("c_name"), F.col("c_mktsegment")
    padded = F.concat(F.lit("  "), name, F.lit(" "))
    parts = F.split(name, "#")
    some = F.nullif(seg, F.lit("BUILDING"))
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.trim(padded).alias("trimmed"),
        big(F.length(F.ltrim(padded))).alias("left_len"),
        big(F.char_length(F.rtrim(padded))).alias("right_len"),
        F.upper(name).alias("upped"),
        F.lower(seg).alias("lowered"),
        F.initcap(seg).alias("titled"),
        big(F.length(name)).alias("n_chars"),
        F.substring(name, 1, 3).alias("head"),
        F.get(parts, 0).alias("first_part"),
        F.get(parts, 2).alias("third_part"),
        F.concat(name, F.lit("/"), some).alias("glued"),
        F.concat_ws("/", name, some).alias("glued_ws"),
        name.like("Cust%1").alias("like_one"),
        name.contains("#0000").alias("has_zeroes"),
        name.startswith("Customer").alias("starts"),
        name.endswith("7").alias("ends_seven"),
        big(F.locate("#", name)).alias("hash_at"),
        F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("padded"),
        F.translate(name, "Cus", "kUS").alias("translated"),
        F.overlay(name, F.lit("__"), 3, 2).alias("overlaid"),
        F.format_string("key=%05d seg=%s", "c_custkey", seg).alias("formatted"),
    )


@query("regex_job", "STRF-07 STRF-08", """
SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, regexp_extract(url, 'page=([0-9]+)', 1) AS page_no,
       md5(regexp_replace(html, '<[^>]*>', ' ', 'g')) AS text_digest, length(regexp_replace(html, '[0-9]+', '#', 'g')) AS masked_len
FROM pages""")
def regex_job(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id",
        F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"),
        F.regexp_extract("url", "page=([0-9]+)", 1).alias("page_no"),
        F.md5(F.regexp_replace("html", "<[^>]*>", " ")).alias("text_digest"),
        big(F.length(F.regexp_replace("html", "[0-9]+", "#"))).alias("masked_len"),
    )


@query("name_normalise", "STRF-13", """
SELECT s_suppkey, nullif(trim(regexp_replace(trim(raw), '[^a-zA-Z ]', '', 'g')), '') AS name
FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 9 = 0 THEN ' 12-' ELSE '  ' || s_name || '''s  ' END AS raw FROM supplier)""")
def name_normalise(spark, sf):
    raw = F.when(F.col("s_suppkey") % 9 == 0, " 12-").otherwise(F.concat(F.lit("  "), F.col("s_name"), F.lit("'s  ")))
    return table(spark, sf, "supplier").select("s_suppkey", normal_name(raw).alias("name"))


@query("text_profile", "STRF-03 STRF-05 STRF-09", """
SELECT lang, count(*) AS docs, CAST(sum(length(text)) AS BIGINT) AS chars, CAST(sum(len(string_split(text, ' '))) AS BIGINT) AS words,
       count(*) FILTER (contains(text, 'http')) AS with_link FROM documents GROUP BY 1""")
def text_profile(spark, sf):
    return table(spark, sf, "documents").groupBy("lang").agg(
        F.count(F.lit(1)).alias("docs"),
        F.sum(big(F.length("text"))).alias("chars"),
        F.sum(big(F.size(F.split("text", " ")))).alias("words"),
        F.count_if(F.col("text").contains("http")).alias("with_link"),
    )


@query("date_job", "DATF-03 DATF-04 DATF-06..11 DATF-05", """
SELECT o_orderkey, year(d) AS y, month(d) AS m, day(d) AS dd, quarter(d) AS q, dayofweek(d) + 1 AS dow, weekofyear(d) AS week,
       date_diff('day', d, DATE '2002-01-15') AS days_left, datesub('month', d, DATE '2002-01-15') AS months_left,
       d + 30 AS plus_30, d - 7 AS minus_7,
       CAST(d + INTERVAL 1 MONTH AS DATE) AS next_month, strftime(d, '%d/%m/%Y') AS dmy, strftime(d, '%B %Y') AS month_name,
       strftime(d, '%Y-%m') AS ym, CAST(date_trunc('month', d) AS DATE) AS month_start, last_day(d) AS month_end,
       CAST(d + to_days(CAST(7 - (dayofweek(d) + 6) % 7 AS INTEGER)) AS DATE) AS next_monday, true AS not_future
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def date_job(spark, sf):
    d = F.col("d")
    target = F.lit("2002-01-15").cast("date")
    return table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d")).select(
        "o_orderkey",
        big(F.year(d)).alias("y"), big(F.month(d)).alias("m"), big(F.dayofmonth(d)).alias("dd"),
        big(F.quarter(d)).alias("q"), big(F.dayofweek(d)).alias("dow"), big(F.weekofyear(d)).alias("week"),
        big(F.datediff(target, d)).alias("days_left"),
        big(F.months_between(target, d)).alias("months_left"),
        F.date_add(d, 30).alias("plus_30"), F.date_sub(d, 7).alias("minus_7"), F.add_months(d, 1).alias("next_month"),
        F.date_format(d, "dd/MM/yyyy").alias("dmy"), F.date_format(d, "MMMM yyyy").alias("month_name"),
        F.date_format(d, "yyyy-MM").alias("ym"), F.trunc(d, "MM").alias("month_start"), F.last_day(d).alias("month_end"),
        F.next_day(d, "Mon").alias("next_monday"), (d <= F.current_date()).alias("not_future"),
    )


@query("date_parse", "DATF-01", """
SELECT o_orderkey, TRY_CAST(raw AS DATE) AS day,
       strftime(TRY_CAST(CASE WHEN o_orderkey % 11 <> 0 THEN raw || ' 10:30:00' END AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS moment
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'not a date' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS raw FROM orders)""")
def date_parse(spark, sf):
    """Strings to dates and timestamps by pattern; unreadable text becomes null."""
    raw = F.when(F.col("o_orderkey") % 11 == 0, "not a date").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    rows = table(spark, sf, "orders").select("o_orderkey", raw.alias("raw"))
    moment = F.try_to_timestamp(F.concat("raw", F.lit(" 10:30:00")), F.lit("yyyy-MM-dd HH:mm:ss"))
    return rows.select(
        "o_orderkey", F.try_to_date("raw", "yyyy-MM-dd").alias("day"),
        F.date_format(moment, "yyyy-MM-dd HH:mm:ss").alias("moment"),
    )


@query("time_job", "DATF-02 DATF-03 DATF-10", """
SELECT event_id, hour(ts) AS h, minute(ts) AS mi, second(ts) AS s, CAST(floor(epoch(ts)) AS BIGINT) AS unix,
       strftime(to_timestamp(floor(epoch(ts))) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS from_unix,
       strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour_start FROM events""")
def time_job(spark, sf):
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf, "events").select(
        "event_id", big(F.hour("ts")).alias("h"), big(F.minute("ts")).alias("mi"), big(F.second("ts")).alias("s"),
        F.unix_timestamp(ts).alias("unix"),
        F.from_unixtime(F.unix_timestamp(ts), "yyyy-MM-dd HH:mm:ss").alias("from_unix"),
        F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH:mm:ss").alias("hour_start"),
    )


@query("timezone_job", "DATF-12", """
SELECT event_id, strftime(ts + INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS east, strftime(ts - INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS back,
       strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') AS tokyo FROM events""")
def timezone_job(spark, sf):
    ts, form = F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss"
    return table(spark, sf, "events").select(
        "event_id",
        F.date_format(F.from_utc_timestamp(ts, "+02:00"), form).alias("east"),
        F.date_format(F.to_utc_timestamp(ts, "+02:00"), form).alias("back"),
        F.date_format(F.convert_timezone(F.lit("UTC"), F.lit("Asia/Tokyo"), F.col("ts")), form).alias("tokyo"),
    )


@query("math_job", "MTHF-01..05", """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)), 1) AS DOUBLE) AS rounded,
       round_even(l_quantity / 2, 0) AS half_even, round(l_quantity / 2, 0) AS half_up,
       CAST(ceil(l_discount * 100 + 0.25) AS BIGINT) AS up, CAST(floor(l_discount * 100 + 0.25) AS BIGINT) AS down,
       abs(l_quantity - 25) AS distance, sqrt(l_quantity) AS root, pow(l_quantity, 2) AS squared,
       CAST(round(ln(l_quantity) * 1000000) AS BIGINT) AS log_micro,
       greatest(l_quantity, NULL, 10.0) AS most, least(l_quantity, NULL, 10.0) AS fewest,
       CASE WHEN l_tax <> 0 THEN l_quantity / (l_tax * 100) END AS per_tax FROM lineitem""")
def math_job(spark, sf):
    q, none = F.col("l_quantity"), F.lit(None).cast("double")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", big("l_linenumber").alias("l_linenumber"), "l_partkey",
        real(F.round(money("l_extendedprice"), 1)).alias("rounded"),
        F.bround(q / 2, 0).alias("half_even"), F.round(q / 2, 0).alias("half_up"),
        F.ceil(F.col("l_discount") * 100 + 0.25).alias("up"), F.floor(F.col("l_discount") * 100 + 0.25).alias("down"),
        F.abs(q - 25).alias("distance"), F.sqrt(q).alias("root"), F.pow(q, F.lit(2)).alias("squared"),
        big(F.round(F.log(q) * 1000000)).alias("log_micro"),
        F.greatest(q, none, F.lit(10.0)).alias("most"), F.least(q, none, F.lit(10.0)).alias("fewest"),
        F.try_divide(q, F.col("l_tax") * 100).alias("per_tax"),
    )
