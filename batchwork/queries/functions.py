"""§2.9 scalar function queries (F1-F33) applied to whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as CAL
from ..functions import clean as C
from ..operators.joins import code_table, latest_as_of
from . import load, register
from ._common import REPORT_DATE


@register("str_substring", """
SELECT c_custkey, substring(c_name, 10, 9) AS digits_part, substring(c_name, 1, 8) AS prefix_1based,
       substring(c_mktsegment, 1, 3) AS seg3
FROM customer
""")
def str_substring(spark, sf):
    c = load(spark, sf, "customer")
    return c.select("c_custkey", F.substring("c_name", 10, 9).alias("digits_part"),
                    F.substring("c_name", 1, 8).alias("prefix_1based"), F.substring("c_mktsegment", 1, 3).alias("seg3"))


@register("str_strip_chars", """
SELECT c_custkey, trim('**' || c_mktsegment || ' *', '* ') AS stripped, trim(c_name, 'C0') AS name_core
FROM customer
""")
def str_strip_chars(spark, sf):
    c = load(spark, sf, "customer")
    return c.select("c_custkey", C.strip_chars(F.concat(F.lit("**"), "c_mktsegment", F.lit(" *")), "* ").alias("stripped"),
                    C.strip_chars("c_name", "C0").alias("name_core"))


@register("str_concat", """
SELECT c_custkey, c_mktsegment || '-' || CAST(c_nationkey AS VARCHAR) AS seg_nation,
       concat_ws('|', c_name, c_mktsegment, CAST(c_custkey AS VARCHAR)) AS joined
FROM customer
""")
def str_concat(spark, sf):
    c = load(spark, sf, "customer")
    return c.select("c_custkey", F.concat("c_mktsegment", F.lit("-"), F.col("c_nationkey").cast("string")).alias("seg_nation"),
                    F.concat_ws("|", "c_name", "c_mktsegment", F.col("c_custkey").cast("string")).alias("joined"))


@register("str_compress", """
SELECT c_custkey, translate(c_name, '#0', '') AS no_hash_zero, regexp_replace(c_name, '[^0-9]', '', 'g') AS digits
FROM customer
""")
def str_compress(spark, sf):
    c = load(spark, sf, "customer")
    return c.select("c_custkey", C.remove_chars("c_name", "#0").alias("no_hash_zero"), C.digits_only("c_name").alias("digits"))


@register("str_verify_pattern", """
SELECT p_partkey, p_type, regexp_matches(p_type, '^[EMS][A-Z]+$') AS valid_type,
       regexp_matches(p_brand, '^Brand#[1-9][0-9]?$') AS valid_brand
FROM part
""")
def str_verify_pattern(spark, sf):
    p = load(spark, sf, "part")
    return p.select("p_partkey", "p_type", F.col("p_type").rlike("^[EMS][A-Z]+$").alias("valid_type"),
                    F.col("p_brand").rlike("^Brand#[1-9][0-9]?$").alias("valid_brand"))


@register("num_zero_pad", """
SELECT o_orderkey, lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS key10,
       lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS cust6
FROM orders
""")
def num_zero_pad(spark, sf):
    o = load(spark, sf, "orders")
    return o.select("o_orderkey", C.zero_pad("o_orderkey", 10).alias("key10"), C.zero_pad("o_custkey", 6).alias("cust6"))


@register("str_length_valid", """
SELECT c_custkey, length(rtrim(regexp_replace(c_name, '[^0-9]', '', 'g'))) = 9 AS valid_id,
       length(rtrim(c_mktsegment)) = 8 AS seg_len8
FROM customer
""")
def str_length_valid(spark, sf):
    c = load(spark, sf, "customer")
    return c.select("c_custkey", C.valid_length(C.digits_only("c_name"), 9).alias("valid_id"),
                    C.valid_length("c_mktsegment", 8).alias("seg_len8"))


@register("str_contains", """
SELECT p_partkey, contains(upper(p_name), 'RING') AS has_ring, starts_with(p_type, 'ECO') AS is_economy
FROM part
""")
def str_contains(spark, sf):
    p = load(spark, sf, "part")
    return p.select("p_partkey", F.upper("p_name").contains("RING").alias("has_ring"),
                    F.col("p_type").startswith("ECO").alias("is_economy"))


@register("num_parse", """
SELECT c_custkey, TRY_CAST(substring(c_name, 10, 9) AS DOUBLE) AS id_number,
       TRY_CAST(trim(c_mktsegment) AS DOUBLE) AS seg_number
FROM customer
""")
def num_parse(spark, sf):
    c = load(spark, sf, "customer")
    return c.select("c_custkey", C.parse_number(F.substring("c_name", 10, 9)).alias("id_number"),
                    C.parse_number("c_mktsegment").alias("seg_number"))


@register("code_normalise", """
SELECT p_partkey, p_size,
       CASE WHEN p_size < 10 THEN '0' || CAST(p_size AS VARCHAR) || '0' ELSE CAST(p_size AS VARCHAR) END AS size_code
FROM part
""")
def code_normalise(spark, sf):
    p = load(spark, sf, "part")
    return p.select("p_partkey", "p_size", C.normalise_code(F.lpad(F.col("p_size").cast("string"), 2, "0")).alias("size_code"))


_MMDD_NUM = ("CAST(CASE WHEN day(o_orderdate) = 31 THEN '02' ELSE strftime(o_orderdate, '%m') END "
             "|| strftime(o_orderdate, '%d%Y') || '000' AS BIGINT)")


@register("date_from_mmddyyyy", f"""
SELECT o_orderkey, {_MMDD_NUM} AS date_num,
       CAST(try_strptime(substring(lpad(CAST({_MMDD_NUM} AS VARCHAR), 11, '0'), 1, 8), '%m%d%Y') AS DATE) AS decoded
FROM orders
""")
def date_from_mmddyyyy(spark, sf):
    o = load(spark, sf, "orders")
    mm = F.when(F.dayofmonth("o_orderdate") == 31, F.lit("02")).otherwise(F.date_format("o_orderdate", "MM"))
    num = F.concat(mm, F.date_format("o_orderdate", "ddyyyy"), F.lit("000")).cast("bigint")
    return o.select("o_orderkey", num.alias("date_num"), C.date_from_mmddyyyy(num).alias("decoded"))


_YYMMDD = "CAST(strftime(o_orderdate, '%y%m%d') AS INTEGER)"


def _yy_sql(cut):
    base = cut - cut % 100
    return (f"CAST(try_strptime(CAST(CASE WHEN {_YYMMDD} // 10000 >= {cut % 100} THEN {base} ELSE {base + 100} END "
            f"+ {_YYMMDD} // 10000 AS VARCHAR) || substring(lpad(CAST({_YYMMDD} AS VARCHAR), 6, '0'), 3, 4), '%Y%m%d') AS DATE)")


@register("date_from_yymmdd", f"""
SELECT o_orderkey, {_YYMMDD} AS yymmdd, {_yy_sql(1950)} AS d_cut1950, {_yy_sql(1997)} AS d_cut1997
FROM orders
""")
def date_from_yymmdd(spark, sf):
    o = load(spark, sf, "orders")
    num = F.date_format("o_orderdate", "yyMMdd").cast("int")
    return o.select("o_orderkey", num.alias("yymmdd"), C.date_from_yymmdd(num, 1950).alias("d_cut1950"),
                    C.date_from_yymmdd(num, 1997).alias("d_cut1997"))


@register("date_from_day_number", """
SELECT o_orderkey, CAST(date_diff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS day_no,
       CAST(DATE '1960-01-01' + CAST(date_diff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS DATE) AS decoded
FROM orders
""")
def date_from_day_number(spark, sf):
    o = load(spark, sf, "orders").withColumn("day_no", C.day_number(F.col("o_orderdate").cast("date")))
    return o.select("o_orderkey", "day_no", C.date_from_day_number("day_no").alias("decoded"))


@register("date_from_parts", """
SELECT l_orderkey, l_linenumber,
       CAST(try_strptime(CAST(year(l_shipdate) AS VARCHAR) || lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0')
            || lpad(CAST(day(l_shipdate) + 3 AS VARCHAR), 2, '0'), '%Y%m%d') AS DATE) AS shifted
FROM lineitem
""")
def date_from_parts(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     C.date_from_parts(F.year("l_shipdate"), F.month("l_shipdate"), F.dayofmonth("l_shipdate") + 3).alias("shifted"))


@register("date_parts", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
       CAST(day(o_orderdate) AS INTEGER) AS d, strftime(o_orderdate, '%d/%m/%Y') AS ddmmyyyy,
       strftime(o_orderdate, '%m%y') AS mmyy
FROM orders
""")
def date_parts(spark, sf):
    o = load(spark, sf, "orders")
    return o.select("o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"),
                    F.dayofmonth("o_orderdate").alias("d"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("ddmmyyyy"),
                    F.date_format("o_orderdate", "MMyy").alias("mmyy"))


@register("days_between_class", """
WITH s AS (SELECT l_orderkey, MAX(CAST(l_shipdate AS DATE)) AS last_ship FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderkey, CAST(date_diff('day', CAST(o.o_orderdate AS DATE), s.last_ship) AS INTEGER) AS days,
       CASE WHEN s.last_ship IS NULL OR date_diff('day', CAST(o.o_orderdate AS DATE), s.last_ship) < 366
            THEN 'SHORT' ELSE 'LONG' END AS term
FROM orders o LEFT JOIN s ON o.o_orderkey = s.l_orderkey
""")
def days_between_class(spark, sf):
    s = load(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.max(F.col("l_shipdate").cast("date")).alias("last_ship"))
    o = load(spark, sf, "orders").withColumn("od", F.col("o_orderdate").cast("date"))
    j = o.join(s, o.o_orderkey == s.l_orderkey, "left")
    return j.select("o_orderkey", C.days_between("od", "last_ship").alias("days"),
                    F.when(C.short_term("od", "last_ship"), F.lit("SHORT")).otherwise(F.lit("LONG")).alias("term"))


@register("month_end_offset", """
SELECT o_orderkey, last_day(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH) AS next_end,
       last_day(CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH) AS prev_end,
       last_day(CAST(o_orderdate AS DATE) + INTERVAL 3 MONTH) AS q_end
FROM orders
""")
def month_end_offset(spark, sf):
    o = load(spark, sf, "orders").withColumn("od", F.col("o_orderdate").cast("date"))
    return o.select("o_orderkey", C.month_end_offset("od", 1).alias("next_end"),
                    C.month_end_offset("od", -1).alias("prev_end"), C.month_end_offset("od", 3).alias("q_end"))


@register("report_period", """
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS rept_date FROM orders)
SELECT rept_date,
  CASE day(rept_date) WHEN 8 THEN '1' WHEN 15 THEN '2' WHEN 22 THEN '3' ELSE '4' END AS rept_week,
  CASE day(rept_date) WHEN 8 THEN '4' WHEN 15 THEN '1' WHEN 22 THEN '2' ELSE '3' END AS rept_prev_week,
  lpad(CAST(month(rept_date) AS VARCHAR), 2, '0') AS rept_month,
  lpad(CAST(CASE WHEN month(rept_date) = 1 THEN 12 ELSE month(rept_date) - 1 END AS VARCHAR), 2, '0') AS rept_prev_month,
  lpad(CAST(CASE WHEN day(rept_date) = 8 THEN (CASE WHEN month(rept_date) = 1 THEN 12 ELSE month(rept_date) - 1 END)
                 ELSE month(rept_date) END AS VARCHAR), 2, '0') AS rept_week_month,
  substring(CAST(year(rept_date) AS VARCHAR), 3, 2) AS rept_year2,
  lpad(CAST(day(rept_date) AS VARCHAR), 2, '0') AS rept_day,
  make_date(year(rept_date), month(rept_date),
            CASE day(rept_date) WHEN 8 THEN 1 WHEN 15 THEN 9 WHEN 22 THEN 16 ELSE 23 END) AS week_start,
  CAST(date_trunc('month', rept_date) AS DATE) AS month_start,
  CAST(date_trunc('month', rept_date) - INTERVAL 1 MONTH AS DATE) AS prev_month_start
FROM d
""")
def report_period(spark, sf):
    d = load(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("rept_date")).distinct()
    return d.select("rept_date", *[c.alias(n) for n, c in CAL.report_period("rept_date").items()])


@register("period_end_of", """
WITH d AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS run_date FROM lineitem)
SELECT run_date,
  CASE WHEN day(run_date) < 8 THEN CAST(date_trunc('month', run_date) - INTERVAL 1 DAY AS DATE)
       WHEN day(run_date) < 15 THEN make_date(year(run_date), month(run_date), 8)
       WHEN day(run_date) < 22 THEN make_date(year(run_date), month(run_date), 15)
       ELSE make_date(year(run_date), month(run_date), 22) END AS period_end
FROM d
""")
def period_end_of(spark, sf):
    d = load(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("run_date")).distinct()
    return d.select("run_date", CAL.period_end_of("run_date").alias("period_end"))


@register("month_starts", """
SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
       CAST(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH AS DATE) AS prev_month_start
FROM orders
""")
def month_starts(spark, sf):
    o = load(spark, sf, "orders").withColumn("od", F.col("o_orderdate").cast("date"))
    return o.select("o_orderkey", CAL.month_start("od").alias("month_start"), CAL.prev_month_start("od").alias("prev_month_start"))


# Independent oracle: the month-stepping loop itself, as a recursive query over the
# distinct (report date, maturity) pairs.
@register("remaining_months", """
WITH RECURSIVE p AS (
  SELECT DISTINCT CAST(o.o_orderdate AS DATE) AS r, CAST(l.l_shipdate AS DATE) AS e
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
steps(r, e, n, fol) AS (
  SELECT r, e, 0, r FROM p WHERE e >= r
  UNION ALL
  SELECT r, e, n + 1,
    CASE WHEN day(r) IN (29, 30, 31) AND (month(fol) % 12) + 1 = 2
           THEN CAST(make_date(year(fol) + CASE WHEN month(fol) = 12 THEN 1 ELSE 0 END, 3, 1) - INTERVAL 1 DAY AS DATE)
         WHEN day(r) = 31 AND (month(fol) % 12) + 1 IN (4, 6, 9, 11)
           THEN make_date(year(fol) + CASE WHEN month(fol) = 12 THEN 1 ELSE 0 END, (month(fol) % 12) + 1, 30)
         WHEN day(r) = 30 AND (month(fol) % 12) + 1 IN (1, 3, 5, 7, 8, 10, 12)
           THEN make_date(year(fol) + CASE WHEN month(fol) = 12 THEN 1 ELSE 0 END, (month(fol) % 12) + 1, 31)
         ELSE make_date(year(fol) + CASE WHEN month(fol) = 12 THEN 1 ELSE 0 END, (month(fol) % 12) + 1, day(r)) END
  FROM steps WHERE n = 0 OR e > fol),
m AS (SELECT r, e, MAX(n) AS n FROM steps GROUP BY r, e)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, CAST(o.o_orderdate AS DATE) AS rept_date,
       CAST(l.l_shipdate AS DATE) AS maturity, CAST(COALESCE(m.n, 51) AS INTEGER) AS remain_months
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN m ON m.r = CAST(o.o_orderdate AS DATE) AND m.e = CAST(l.l_shipdate AS DATE)
""")
def remaining_months(spark, sf):
    li = load(spark, sf, "lineitem")
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    r, e = F.col("o_orderdate").cast("date"), F.col("l_shipdate").cast("date")
    return j.select("l_orderkey", "l_linenumber", "l_partkey", r.alias("rept_date"), e.alias("maturity"),
                    F.coalesce(C.remaining_months(e, r), F.lit(51)).cast("int").alias("remain_months"))


@register("term_months", """
SELECT l_orderkey, l_linenumber, CAST(12 * (year(l.l_shipdate) - year(o.o_orderdate))
       + (month(l.l_shipdate) - month(o.o_orderdate)) AS INTEGER) AS term
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
""")
def term_months(spark, sf):
    li = load(spark, sf, "lineitem")
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select("l_orderkey", "l_linenumber", C.term_months("o_orderdate", "l_shipdate").cast("int").alias("term"))


@register("arrears_bucket", f"""
WITH d AS (SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '{REPORT_DATE}') AS days
           FROM orders WHERE o_orderstatus = 'O')
SELECT o_orderkey, CAST(days AS INTEGER) AS days, CAST(floor(days / 30.0005) AS BIGINT) AS months_arrears,
       CAST(ceil(days / 30.0005) AS BIGINT) AS instalments
FROM d
""")
def arrears_bucket(spark, sf):
    o = load(spark, sf, "orders").where("o_orderstatus = 'O'")
    o = o.withColumn("days", C.days_between(F.col("o_orderdate").cast("date"), F.lit(REPORT_DATE).cast("date")))
    return o.select("o_orderkey", "days", C.arrears_months("days").cast("bigint").alias("months_arrears"),
                    C.instalments_due("days").cast("bigint").alias("instalments"))


@register("same_month", """
SELECT l.l_orderkey, l.l_linenumber,
       date_trunc('month', l.l_shipdate) = date_trunc('month', o.o_orderdate) AS shipped_same_month
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
""")
def same_month(spark, sf):
    li = load(spark, sf, "lineitem")
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select("l_orderkey", "l_linenumber",
                    C.same_month(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date")).alias("shipped_same_month"))


@register("num_round_trunc", """
SELECT l_orderkey, l_linenumber,
  CAST(ROUND(CAST(l_extendedprice * l_discount AS DECIMAL(38,10)), 2) AS DOUBLE) AS rounded,
  CAST(sign(CAST(l_extendedprice * l_discount AS DECIMAL(38,10)))
       * floor(abs(CAST(l_extendedprice * l_discount AS DECIMAL(38,10))) * 100) / 100 AS DOUBLE) AS truncated
FROM lineitem
""")
def num_round_trunc(spark, sf):
    li = load(spark, sf, "lineitem")
    x = F.col("l_extendedprice") * F.col("l_discount")
    return li.select("l_orderkey", "l_linenumber", C.round_half_up(x, 2).cast("double").alias("rounded"),
                     C.trunc_to(x, 2).cast("double").alias("truncated"))


@register("row_sum", """
WITH d AS (SELECT l_orderkey, l_linenumber, NULLIF(l_discount, 0) AS a, NULLIF(l_tax, 0) AS b FROM lineitem)
SELECT l_orderkey, l_linenumber,
       CASE WHEN a IS NULL AND b IS NULL THEN NULL ELSE COALESCE(a, 0) + COALESCE(b, 0) END AS sas_sum,
       a + b AS plus
FROM d
""")
def row_sum(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber",
                                            F.nullif("l_discount", F.lit(0.0)).alias("a"), F.nullif("l_tax", F.lit(0.0)).alias("b"))
    return li.select("l_orderkey", "l_linenumber", C.row_sum("a", "b").alias("sas_sum"), (F.col("a") + F.col("b")).alias("plus"))


@register("unearned_interest", """
SELECT l_orderkey, l_linenumber,
  CAST(ROUND(CAST((floor(l_quantity / 2) * (floor(l_quantity / 2) + 1))
        * ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)), 2)
        / (l_quantity * (l_quantity + 1)) AS DECIMAL(38,10)), 2) AS DOUBLE) AS unearned
FROM lineitem
""")
def unearned_interest(spark, sf):
    li = load(spark, sf, "lineitem")
    n_left = F.floor(F.col("l_quantity") / 2).cast("decimal(10,0)")
    n_tot = F.col("l_quantity").cast("decimal(10,0)")
    i = C.round_half_up(F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_tax").cast("decimal(4,2)"), 2)
    u = C.unearned_interest(n_left, n_tot, i)
    return li.select("l_orderkey", "l_linenumber", C.round_half_up(u, 2).cast("double").alias("unearned"))


# Fixed assignment of the supplied flags to a rate series ("currency")
FLAG_CURRENCY = [("A", "click"), ("N", "view"), ("R", "purchase")]


@register("fx_convert", """
WITH r AS (SELECT event_type AS ccy, MAX_BY(value, (ts, value)) AS rate FROM events
           WHERE CAST(ts AS DATE) <= DATE '2024-01-20' GROUP BY event_type),
m(flag, ccy) AS (VALUES ('A', 'click'), ('N', 'view'), ('R', 'purchase'))
SELECT l.l_orderkey, l.l_linenumber, m.ccy, r.rate,
       CAST(ROUND(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(r.rate AS DECIMAL(18,6)), 2) AS DOUBLE) AS amount_local
FROM lineitem l JOIN m ON l.l_returnflag = m.flag LEFT JOIN r ON r.ccy = m.ccy
""")
def fx_convert(spark, sf):
    ev = load(spark, sf, "events").withColumn("d", F.col("ts").cast("date"))
    rates = latest_as_of(ev.withColumnRenamed("event_type", "ccy"), "ccy", "ts", "value",
                         F.lit("2024-01-20 23:59:59.999999").cast("timestamp_ntz"))
    rates = rates.select("ccy", F.col("value").alias("rate"))
    # one rate per currency: the flags' table keeps its proven size with its rates on it, so no line is dealt by currency
    m = code_table(spark, FLAG_CURRENCY, "flag string, ccy string").join(rates, "ccy", "left")
    li = load(spark, sf, "lineitem")
    j = li.join(F.broadcast(m), F.col("l_returnflag") == F.col("flag"))
    amt = F.round(F.col("l_extendedprice").cast("decimal(18,2)") * F.col("rate").cast("decimal(18,6)"), 2)
    return j.select("l_orderkey", "l_linenumber", "ccy", "rate", amt.cast("double").alias("amount_local"))


@register("abs_flip", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN -abs(l_extendedprice) ELSE abs(l_extendedprice) END AS signed_amount,
       abs(l_discount - 0.05) AS dist
FROM lineitem
""")
def abs_flip(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", C.abs_flip("l_extendedprice", F.col("l_returnflag") == "R").alias("signed_amount"),
                     F.abs(F.col("l_discount") - 0.05).alias("dist"))


@register("date_band", """
SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) BETWEEN DATE '1995-01-01' AND DATE '1996-12-31' THEN 'BAND1'
                        WHEN CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1998-06-30' THEN 'BAND2'
                        ELSE 'BAND3' END AS band
FROM orders
""")
def date_band(spark, sf):
    d = F.col("o_orderdate").cast("date")
    band = (F.when(d.between(F.lit("1995-01-01").cast("date"), F.lit("1996-12-31").cast("date")), F.lit("BAND1"))
             .when(d.between(F.lit("1997-01-01").cast("date"), F.lit("1998-06-30").cast("date")), F.lit("BAND2"))
             .otherwise(F.lit("BAND3")))
    return load(spark, sf, "orders").select("o_orderkey", band.alias("band"))


@register("struct_fields", """
SELECT o_orderkey, o_custkey AS cust, o_totalprice AS amount FROM orders
""")
def struct_fields(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", F.struct(F.col("o_custkey").alias("cust"),
                                                                F.col("o_totalprice").alias("amount")).alias("s"))
    return o.select("o_orderkey", F.col("s.cust").alias("cust"), F.col("s")["amount"].alias("amount"))


@register("conditional_tag", """
SELECT o.o_orderkey,
  CASE WHEN c.c_nationkey < 5 AND CAST(o.o_orderdate AS DATE) < DATE '1997-01-01' THEN 'HOME-OLD'
       WHEN c.c_nationkey < 5 THEN 'HOME'
       WHEN CAST(o.o_orderdate AS DATE) >= DATE '2000-01-01' THEN 'ABROAD-NEW'
       ELSE 'ABROAD' END AS geo_tag
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
""")
def conditional_tag(spark, sf):
    o = load(spark, sf, "orders")
    c = load(spark, sf, "customer").select("c_custkey", "c_nationkey")
    d = F.col("o_orderdate").cast("date")
    home = F.col("c_nationkey") < 5
    tag = (F.when(home & (d < F.lit("1997-01-01").cast("date")), F.lit("HOME-OLD")).when(home, F.lit("HOME"))
            .when(d >= F.lit("2000-01-01").cast("date"), F.lit("ABROAD-NEW")).otherwise(F.lit("ABROAD")))
    return o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", tag.alias("geo_tag"))
