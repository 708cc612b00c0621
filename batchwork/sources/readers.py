"""Readers for dated snapshots and legacy feeds.

Every reader returns a lazy DataFrame: text feeds are cut into columns with native
``substring``/``try_cast`` expressions, so the parse runs inside whole-stage codegen on
executors, one split per task.  Packed-decimal record files are cut into byte ranges
read by tasks into an Arrow binary column (``mapInArrow``); decoding is still SQL.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clean import blank_to_null


# ------------------------------------------------------------------ dated tables
def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def scan_snapshot(spark: SparkSession, root: str, year: int, month: int, day: int,
                  cols: list[str] | None = None, where: str | None = None) -> DataFrame:
    """One day of a ``year=/month=/day=`` partitioned table; the partition filter
    prunes directories, ``cols`` prune the parquet read, ``where`` is pushed down."""
    df = spark.read.parquet(root).where((F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day))
    if where:
        df = df.where(where)
    return df.select(*cols) if cols else df


def scan_where(spark: SparkSession, path: str, condition: str) -> DataFrame:
    """``SELECT * FROM parquet WHERE ...`` — the condition reaches the scan."""
    return spark.read.parquet(path).where(condition)


def scan_generation(df: DataFrame, date_col: str, back: int = 0) -> DataFrame:
    """The ``back``-th previous generation (0 = latest) of a dated table.

    The distinct dates are few (one per generation); they are ranked and the chosen
    one is semi-joined back, so the data itself is only filtered, never collected.
    """
    from pyspark.sql import Window
    gens = df.select(date_col).distinct()
    pick = gens.withColumn("__g", F.dense_rank().over(Window.orderBy(F.col(date_col).desc()))) \
               .where(F.col("__g") == back + 1).select(date_col)
    return df.join(F.broadcast(pick), on=date_col, how="left_semi")


def scan_period(df: DataFrame, year_col: str, month_col: str, week_col: str | None,
                year: int, month: int, week: str | None = None) -> DataFrame:
    """The table for one report period (partition filter instead of a table name)."""
    c = (F.col(year_col) == year) & (F.col(month_col) == month)
    if week_col and week is not None:
        c = c & (F.col(week_col) == week)
    return df.where(c)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, optional: bool = True,
                  fmt: str = "parquet") -> DataFrame:
    """A source the caller marks optional yields an empty frame when absent;
    a required source that is absent raises."""
    # asked of the file system that Spark itself would read the path from
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        if not optional:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).schema(schema).load(path)


def conform(df: DataFrame, schema: T.StructType, defaults: dict | None = None) -> DataFrame:
    """The columns of ``schema`` in order: present ones cast (bad values → NULL),
    missing ones added with their default."""
    defaults = defaults or {}
    out = []
    for f in schema.fields:
        if f.name in df.columns:
            out.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
        else:
            out.append(F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name))
    return df.select(*out)


def scan_books(frames: dict[str, DataFrame], flag: str = "book") -> DataFrame:
    """The same table from several books stacked, with the book named."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [df.withColumn(flag, F.lit(name)) for name, df in frames.items()])


# ------------------------------------------------------------------ text feeds
@dataclass(frozen=True)
class Field:
    """One field of a fixed layout: 1-based ``start``, ``length`` characters.

    ``kind``: ``text`` (trimmed, blank → NULL), ``int``, ``long``, ``decimal`` (implied
    ``scale`` decimals when the text has no point), ``date`` (``fmt``), ``amount``
    (commas and trailing minus).
    """
    name: str
    start: int
    length: int
    kind: str = "text"
    scale: int = 0
    fmt: str | None = None


def _field_expr(raw, f: Field):
    from ..functions.clean import parse_amount
    t = F.trim(raw)
    if f.kind == "text":
        return blank_to_null(raw)
    if f.kind in ("int", "long"):
        return F.nullif(t, F.lit("")).try_cast("int" if f.kind == "int" else "bigint")
    if f.kind == "decimal":
        p = max(f.length, f.scale + 1)
        v = F.nullif(t, F.lit("")).try_cast(f"decimal({p + 1},{f.scale})")
        implied = F.nullif(t, F.lit("")).try_cast(f"decimal({p},0)") / F.lit(10 ** f.scale)
        return F.when(t.contains(".") | F.lit(f.scale == 0), v).otherwise(implied.cast(f"decimal({p + 1},{f.scale})"))
    if f.kind == "date":
        return F.try_to_date(F.nullif(t, F.lit("")), F.lit(f.fmt or "yyyyMMdd"))
    if f.kind == "amount":
        return parse_amount(raw)
    raise ValueError(f"unknown field kind {f.kind}")


def parse_fixed(lines: DataFrame, layout: list[Field], col: str = "value") -> DataFrame:
    """S3 core: cut a one-string-column frame into typed columns."""
    return lines.select(*[_field_expr(F.substring(F.col(col), f.start, f.length), f).alias(f.name) for f in layout])


def read_fixed(spark: SparkSession, path: str, layout: list[Field], skip_header: bool = False) -> DataFrame:
    """S3: fixed-width text file → typed columns (optionally without its header line)."""
    lines = read_body(spark, path) if skip_header else spark.read.text(path)
    return parse_fixed(lines, layout)


def read_body(spark: SparkSession, path: str) -> DataFrame:
    """Every line but the first of each file (FIRSTOBS=2), as column ``value``.

    The CSV reader drops the header line of each file in the split that holds it; one
    column, a separator and quote that never occur, so lines arrive untouched.
    """
    return (spark.read.option("header", True).option("sep", "\u0001").option("quote", "")
            .option("escape", "").option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .schema("value string").csv(path))


def read_header(spark: SparkSession, path: str) -> DataFrame:
    """The first line of a single-file feed (OBS=1)."""
    return spark.read.text(path).limit(1)


def read_typed_records(spark: SparkSession, path: str, tag: str, layout: list[Field]) -> DataFrame:
    """Keep the lines whose first character is ``tag``, then cut them."""
    lines = spark.read.text(path).where(F.substring("value", 1, 1) == tag)
    return parse_fixed(lines, layout)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = "|",
                   header: bool = False, date_format: str | None = None) -> DataFrame:
    """Delimited feed with an explicit schema; short lines give NULLs (PERMISSIVE)."""
    r = spark.read.option("sep", sep).option("header", header).option("mode", "PERMISSIVE")
    if date_format:
        r = r.option("dateFormat", date_format)
    return r.schema(schema).csv(path)


def read_any(spark: SparkSession, path: str, sep: str = ",", schema=None) -> DataFrame:
    """Reader chosen by suffix; the separator is given, never guessed."""
    p = path.rstrip("/")
    if p.endswith(".parquet"):
        return spark.read.parquet(path)
    r = spark.read.option("header", True).option("sep", sep)
    return r.schema(schema).csv(path) if schema is not None else r.option("inferSchema", False).csv(path)


# ------------------------------------------------------------------ packed decimal
@dataclass(frozen=True)
class PackedField:
    """``PDw.d``: ``length`` bytes at 1-based ``start``, ``scale`` implied decimals.
    ``kind='text'`` reads the bytes as characters instead."""
    name: str
    start: int
    length: int
    scale: int = 0
    kind: str = "packed"


def decode_packed(rec, start: int, length: int, scale: int = 0):
    """Packed decimal (two BCD digits per byte, last nibble the sign) → decimal.

    Sign nibble C/F/A/E positive, D/B negative; any other nibble or a non-digit → NULL.
    """
    h = F.hex(F.substring(rec, start, length))
    digits = F.substring(h, 1, 2 * length - 1)
    sign = F.substring(h, 2 * length, 1)
    prec = 2 * length - 1
    mag = digits.try_cast(f"decimal({prec},0)")
    val = (mag / F.lit(10 ** scale)).cast(f"decimal({prec},{scale})") if scale else mag
    # a digit nibble A-F is invalid (and 'E' must not be read as an exponent)
    only_digits = F.translate(digits, "0123456789", "") == ""
    return (F.when(sign.isin("C", "F", "A", "E") & only_digits, val)
             .when(sign.isin("D", "B") & only_digits, -val))


def parse_packed(records: DataFrame, layout: list[PackedField], col: str = "rec") -> DataFrame:
    out = []
    for f in layout:
        if f.kind == "text":
            out.append(blank_to_null(F.decode(F.substring(F.col(col), f.start, f.length), "US-ASCII")).alias(f.name))
        else:
            out.append(decode_packed(F.col(col), f.start, f.length, f.scale).alias(f.name))
    return records.select(*out)


# byte ranges handed to one task (rounded down to whole records)
PACKED_SPLIT_BYTES = 32 * 1024 * 1024


# file systems the task-side Arrow reader opens itself; other Hadoop schemes use the
# Hadoop fixed-length record reader
_ARROW_SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "gcs": "gs",
                  "abfs": "abfs", "abfss": "abfss"}


def _scheme(p: str) -> str:
    return p.split(":", 1)[0].lower() if ":" in p.split("/", 1)[0] else "file"


def _arrow_uri(p: str) -> str:
    if p.startswith("file:") and not p.startswith("file://"):
        return "file://" + p[5:]
    sch = _scheme(p)
    if sch in _ARROW_SCHEMES and _ARROW_SCHEMES[sch] != sch:
        return _ARROW_SCHEMES[sch] + p[len(sch):]
    return p


def read_packed(spark: SparkSession, path: str, reclen: int, layout: list[PackedField],
                split_bytes: int = PACKED_SPLIT_BYTES, reader: str = "auto") -> DataFrame:
    """Fixed-length binary records → decoded columns.

    File sizes come from the ``binaryFile`` listing (content is pruned, not read); each
    file is cut into record-aligned byte ranges, the ranges are spread over tasks, and
    each task reads its range and hands it to Spark as one Arrow binary column
    (zero-copy, no per-record Python objects).  Decoding is SQL (``parse_packed``).
    Paths on a file system the Arrow reader does not open go through Hadoop's
    fixed-length record reader instead (splittable; records pass through Python once).
    """
    if reader == "hadoop" or (reader == "auto" and _scheme(path) not in _ARROW_SCHEMES):
        rdd = spark.sparkContext.binaryRecords(path, reclen)
        return parse_packed(spark.createDataFrame(rdd.map(lambda b: (bytes(b),)), "rec binary"), layout)
    step = max(1, split_bytes // reclen) * reclen
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    ranges = (files.select("path", "length", F.explode(F.sequence(
                  F.lit(0), F.greatest(F.ceil(F.col("length") / step).cast("int") - 1, F.lit(0)))).alias("i"))
                   .select("path", (F.col("i") * step).alias("start"),
                           F.least(F.col("length"), (F.col("i") + 1) * step).alias("end")))
    # one range per task; an explicit count is not coalesced by adaptive execution
    ranges = ranges.repartition(max(1, ranges.count()))

    def read_ranges(batches):
        import pyarrow as pa
        import pyarrow.fs as pafs
        for b in batches:
            for p, start, end in zip(*(b.column(i).to_pylist() for i in range(3))):
                n = (end - start) // reclen
                if n <= 0:
                    continue
                fs, rel = pafs.FileSystem.from_uri(_arrow_uri(p))
                with fs.open_input_file(rel) as fh:
                    buf = pa.py_buffer(fh.read_at(n * reclen, start))
                arr = pa.FixedSizeBinaryArray.from_buffers(pa.binary(reclen), n, [None, buf]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([arr], names=["rec"])

    recs = ranges.mapInArrow(read_ranges, "rec binary")
    return parse_packed(recs, layout)
