"""§2.1 source queries.

File-format keys first write a supplied table in the legacy layout to a fresh folder
under the session's shared checkpoint location, then read it back with the reader
under test; their oracle is a plain query on the source table.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from ..sinks.writers import Out, to_fixed
from ..sources import readers as R
from . import load, register
from ._common import REPORT_DATE


@register("scan_dated_orders", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1998-08-15'
""")
def scan_dated_orders(spark, sf):
    path = scratch_path(spark, "dated_orders")
    o = load(spark, sf, "orders")
    (o.withColumn("year", F.year("o_orderdate")).withColumn("month", F.month("o_orderdate"))
      .withColumn("day", F.dayofmonth("o_orderdate"))
      .repartition("year", "month").write.partitionBy("year", "month").parquet(path))
    return R.scan_snapshot(spark, path, 1998, 8, 15, ["o_orderkey", "o_custkey", "o_totalprice"])


@register("scan_filter_pushdown", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 45 AND l_returnflag = 'R'
""")
def scan_filter_pushdown(spark, sf):
    return R.scan_where(spark, f"{sf}/lineitem.parquet", "l_quantity > 45 AND l_returnflag = 'R'") \
            .select("l_orderkey", "l_linenumber", "l_quantity")


CUSTOMER_LAYOUT_OUT = [Out("c_custkey", 1, 10, "zero"), Out("c_name", 11, 25), Out("c_nationkey", 36, 3, "num"),
                       Out("c_acctbal", 39, 12, "implied", decimals=2), Out("c_mktsegment", 51, 10)]
CUSTOMER_LAYOUT_IN = [R.Field("c_custkey", 1, 10, "long"), R.Field("c_name", 11, 25),
                      R.Field("c_nationkey", 36, 3, "int"), R.Field("c_acctbal", 39, 12, "decimal", scale=2),
                      R.Field("c_mktsegment", 51, 10)]


def _write_text(df, path, col="record"):
    df.select(col).write.text(path)
    return path


@register("fixed_width_scan", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
""")
def fixed_width_scan(spark, sf):
    path = scratch_path(spark, "customer_fixed")
    _write_text(to_fixed(load(spark, sf, "customer"), CUSTOMER_LAYOUT_OUT), path)
    df = R.read_fixed(spark, path, CUSTOMER_LAYOUT_IN)
    return df.withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@register("header_body_split", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, DATE '{REPORT_DATE}' AS feed_date FROM orders
""")
def header_body_split(spark, sf):
    path = scratch_path(spark, "orders_feed")
    lay = [Out("o_orderkey", 1, 10, "zero"), Out("o_custkey", 11, 10, "zero"), Out("o_orderstatus", 21, 1)]
    rec = to_fixed(load(spark, sf, "orders"), lay).select("record")
    # every part file starts with the header line 'HDR' + YYYYMMDD (CSV writer header)
    header = "HDR" + REPORT_DATE.replace("-", "")
    (rec.withColumnRenamed("record", header).write.option("header", True).option("sep", "\u0001")
        .option("quote", "").option("escape", "").csv(path))
    first = R.read_header(spark, path).first()["value"]           # one line: the feed date
    feed_date = F.try_to_date(F.lit(first[3:11]), "yyyyMMdd")
    body = R.parse_fixed(R.read_body(spark, path),
                         [R.Field("o_orderkey", 1, 10, "long"), R.Field("o_custkey", 11, 10, "long"),
                          R.Field("o_orderstatus", 21, 1)])
    return body.withColumn("feed_date", feed_date)


@register("record_type_scan", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
""")
def record_type_scan(spark, sf):
    path = scratch_path(spark, "typed_records")
    o = load(spark, sf, "orders")
    rec = o.select(F.concat(F.when(F.col("o_orderstatus") == "F", F.lit("+")).otherwise(F.lit("X")),
                            F.lpad(F.col("o_orderkey").cast("string"), 10, "0"),
                            F.lpad(F.format_number("o_totalprice", 2), 16, " ")).alias("record"))
    _write_text(rec, path)
    df = R.read_typed_records(spark, path, "+", [R.Field("o_orderkey", 2, 10, "long"),
                                                 R.Field("o_totalprice", 12, 16, "amount")])
    return df.withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


DELIM_SCHEMA = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
                             T.StructField("c_acctbal", T.DoubleType()), T.StructField("since", T.DateType()),
                             T.StructField("c_mktsegment", T.StringType())])


@register("delimited_scan", """
SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_acctbal < 0 THEN NULL ELSE DATE '1998-08-15' END AS since,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment
FROM customer
""")
def delimited_scan(spark, sf):
    path = scratch_path(spark, "customer_pipe")
    c = load(spark, sf, "customer")
    # short lines (no date, no segment) for negative balances
    line = F.when(F.col("c_acctbal") < 0,
                  F.concat_ws("|", F.col("c_custkey").cast("string"), F.concat(F.lit('"'), "c_name", F.lit('"')),
                              F.col("c_acctbal").cast("string")))
    line = line.otherwise(F.concat_ws("|", F.col("c_custkey").cast("string"), F.concat(F.lit('"'), "c_name", F.lit('"')),
                                      F.col("c_acctbal").cast("string"), F.lit("1998-08-15"), "c_mktsegment"))
    _write_text(c.select(line.alias("record")), path)
    return R.read_delimited(spark, path, DELIM_SCHEMA, sep="|", date_format="yyyy-MM-dd")


@register("csv_roundtrip", """
SELECT n_nationkey, n_name, n_regionkey FROM nation
""")
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "nation") + ".csv"
    load(spark, sf, "nation").write.option("header", True).csv(path)
    return R.read_any(spark, path, sep=",", schema="n_nationkey int, n_name string, n_regionkey int")


# Packed layout of the line feed: key PD6, line no. PD2, amount PD8.2 (signed), code text
LINE_PACKED = [R.PackedField("l_orderkey", 1, 6), R.PackedField("l_linenumber", 7, 2),
               R.PackedField("amount", 9, 8, 2), R.PackedField("l_returnflag", 17, 1, kind="text")]
LINE_RECLEN = 17


def _pack(col, length, scale=0):
    """Encode a number as packed decimal bytes (test-data writer)."""
    digits = 2 * length - 1
    v = F.abs(F.round(col.cast("decimal(38,10)") * F.lit(10 ** scale), 0)).cast("decimal(38,0)").cast("string")
    sign = F.when(col < 0, F.lit("D")).otherwise(F.lit("C"))
    return F.unhex(F.concat(F.lpad(v, digits, "0"), sign))


def write_packed(df, path: str) -> str:
    """Write fixed-length binary records, one file per partition (test-data writer).

    File names are the partition number and each file is written to a temporary name
    then moved into place, so a retried or speculative task replaces its own output
    instead of adding a second copy.
    """
    import pyarrow.fs as pafs

    def part(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        ctx = TaskContext.get()
        pid, attempt = ctx.partitionId(), ctx.attemptNumber()
        fs, base = pafs.FileSystem.from_uri(path)
        fs.create_dir(base, recursive=True)
        final = f"{base}/part-{pid:05d}.bin"
        tmp = f"{base}/_tmp-{pid:05d}-{attempt}"
        n = 0
        with fs.open_output_stream(tmp) as out:
            for b in batches:
                arr = b.column(0)
                if len(arr) == 0:
                    continue
                # records are fixed length and never null: the values buffer between the
                # first and last offset is the records back to back
                width = np.int64 if pa.types.is_large_binary(arr.type) else np.int32
                offs = np.frombuffer(arr.buffers()[1], dtype=width)[arr.offset:arr.offset + len(arr) + 1]
                out.write(arr.buffers()[2][int(offs[0]):int(offs[-1])])
                n += len(arr)
        fs.move(tmp, final)
        yield pa.RecordBatch.from_pydict({"file": [final], "n": [n]})

    df.select("rec").mapInArrow(part, "file string, n long").write.format("noop").mode("overwrite").save()
    return path


@register("packed_decimal_scan", """
SELECT l_orderkey, l_linenumber,
       CAST(CASE WHEN l_returnflag = 'R' THEN -CAST(l_extendedprice AS DECIMAL(15,2)) ELSE CAST(l_extendedprice AS DECIMAL(15,2)) END AS DOUBLE) AS amount,
       l_returnflag FROM lineitem
""")
def packed_decimal_scan(spark, sf):
    path = scratch_path(spark, "line_packed")
    li = load(spark, sf, "lineitem")
    amt = F.when(F.col("l_returnflag") == "R", -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice"))
    rec = li.select(F.concat(_pack(F.col("l_orderkey"), 6), _pack(F.col("l_linenumber"), 2), _pack(amt, 8, 2),
                             F.encode(F.col("l_returnflag"), "US-ASCII")).alias("rec"))
    write_packed(rec, path)
    df = R.read_packed(spark, path, LINE_RECLEN, LINE_PACKED)
    return df.select(F.col("l_orderkey").cast("bigint").alias("l_orderkey"),
                     F.col("l_linenumber").cast("int").alias("l_linenumber"),
                     F.col("amount").cast("double").alias("amount"), "l_returnflag")


@register("parse_amounts", """
SELECT l_orderkey, l_linenumber,
       CAST(CASE WHEN l_returnflag = 'R' THEN -CAST(l_extendedprice AS DECIMAL(22,2)) ELSE CAST(l_extendedprice AS DECIMAL(22,2)) END AS DOUBLE) AS amount
FROM lineitem
""")
def parse_amounts(spark, sf):
    from ..functions.clean import parse_amount
    li = load(spark, sf, "lineitem")
    # COMMA22.2 text as a feed carries it: thousands separators, trailing minus
    txt = F.when(F.col("l_returnflag") == "R", F.concat(F.format_number("l_extendedprice", 2), F.lit("-"))) \
           .otherwise(F.format_number("l_extendedprice", 2))
    return li.select("l_orderkey", "l_linenumber", parse_amount(txt).cast("double").alias("amount"))


@register("nth_latest_snapshot", """
WITH g AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS gen FROM orders),
pick AS (SELECT gen FROM (SELECT gen, DENSE_RANK() OVER (ORDER BY gen DESC) AS r FROM g) WHERE r = 2)
SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS gen FROM orders
WHERE CAST(date_trunc('month', o_orderdate) AS DATE) IN (SELECT gen FROM pick)
""")
def nth_latest_snapshot(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("gen"))
    return R.scan_generation(o, "gen", back=1)


@register("period_scan", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE year(o_orderdate) = 1998 AND month(o_orderdate) = 8
  AND (CASE WHEN day(o_orderdate) <= 8 THEN '1' WHEN day(o_orderdate) <= 15 THEN '2'
            WHEN day(o_orderdate) <= 22 THEN '3' ELSE '4' END) = '2'
""")
def period_scan(spark, sf):
    d = F.dayofmonth("o_orderdate")
    wk = F.when(d <= 8, "1").when(d <= 15, "2").when(d <= 22, "3").otherwise("4")
    o = load(spark, sf, "orders").withColumn("py", F.year("o_orderdate")).withColumn("pm", F.month("o_orderdate")) \
        .withColumn("pw", wk)
    return R.scan_period(o, "py", "pm", "pw", 1998, 8, "2").select("o_orderkey", "o_totalprice")


NATION_SCHEMA = T.StructType([T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType()),
                              T.StructField("n_regionkey", T.IntegerType())])


@register("optional_source", """
SELECT n_nationkey, n_name, n_regionkey FROM nation
""")
def optional_source(spark, sf):
    absent = R.read_or_empty(spark, scratch_path(spark, "absent_nation"), NATION_SCHEMA, optional=True)
    present = R.read_or_empty(spark, f"{sf}/nation.parquet", NATION_SCHEMA, optional=False)
    return present.unionByName(absent)


CONFORM_SCHEMA = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_nationkey", T.StringType()),
                               T.StructField("c_acctbal", T.DecimalType(12, 2)), T.StructField("c_phone", T.StringType()),
                               T.StructField("c_mktsegment", T.StringType())])


@register("conform_schema", """
SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS c_nationkey, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE) AS c_acctbal,
       'NA' AS c_phone, c_mktsegment FROM customer
""")
def conform_schema(spark, sf):
    c = R.conform(load(spark, sf, "customer"), CONFORM_SCHEMA, {"c_phone": "NA"})
    return c.withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@register("two_book_scan", """
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 'book_a' ELSE 'book_b' END AS book FROM orders
""")
def two_book_scan(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return R.scan_books({"book_a": o.where("o_orderstatus = 'F'"), "book_b": o.where("o_orderstatus <> 'F'")})
