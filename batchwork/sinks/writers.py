"""Writers: tables, fixed-layout extracts, routed outputs, reports (K1-K9).

An exclusive split is one ``partitionBy`` write (one pass over the data), not n
filtered writes.  Fixed layouts are resolved on the driver (they are a few dozen
fields of metadata) into one ``concat`` expression evaluated on executors.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def gathered(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Rows of one output partition brought together before a partitioned write.

    Spark splits the large ones and joins the small ones by the sizes it meets (adaptive
    rebalancing), so the number of files follows the data, not tasks x partitions.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_by])


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                formats: tuple[str, ...] = ("parquet", "csv"), mode: str = "overwrite") -> dict[str, str]:
    """K1: write each output as parquet and CSV (with header)."""
    out = {}
    for fmt in formats:
        w = (gathered(df, partition_by) if partition_by else df).write.mode(mode)
        if partition_by:
            w = w.partitionBy(*partition_by)
        p = f"{path.rstrip('/')}/{fmt}"
        if fmt == "csv":
            w.option("header", True).csv(p)
        else:
            w.format(fmt).save(p)
        out[fmt] = p
    return out


def publish(df: DataFrame, path: str, period_cols: list[str]) -> str:
    """K8: replace only the period partitions present in ``df`` (dynamic overwrite)."""
    (gathered(df, period_cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*period_cols).parquet(path))
    return path


def append(df: DataFrame, path: str) -> str:
    """K7: PROC APPEND across runs."""
    df.write.mode("append").parquet(path)
    return path


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh shared scratch folder and read it again: cuts the plan and survives lost executors."""
    from ..session import scratch_path
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ------------------------------------------------------------------ fixed layouts
@dataclass(frozen=True)
class Out:
    """One output field at 1-based ``start``, ``length`` wide.

    ``kind``: ``text`` left-aligned blank-filled; ``num`` right-aligned blank-filled;
    ``zero`` zero-filled integer; ``implied`` zero-filled with ``decimals`` implied
    decimals (value × 10^decimals); ``dec`` right-aligned with ``decimals`` written out;
    ``date`` with ``fmt`` (blank where missing), ``day`` the same with zeros where missing;
    ``constant`` the text ``fmt``.  A text that is too long is cut only where the field
    says so (``cut``).
    """
    name: str
    start: int
    length: int
    kind: str = "text"
    decimals: int = 0
    fmt: str | None = None
    source: str | None = None    # column to read (defaults to name)
    cut: bool = False            # a text field that takes the first ``length`` characters


def _render(f: Out, kind: T.DataType | None = None) -> Column:
    c = F.col(f.source or f.name) if f.kind != "constant" else None
    if f.kind == "text":
        s = F.coalesce(c.cast("string"), F.lit(""))
    elif f.kind == "num":
        s = F.coalesce(c.cast("string"), F.lit(""))
    elif f.kind in ("zero", "implied"):
        v = c.cast("decimal(38,10)") * F.lit(10 ** f.decimals) if f.kind == "implied" else c.cast("decimal(38,10)")
        r = F.round(v, 0).cast("decimal(38,0)")
        # negative values keep their sign in front of the zeros
        s = F.when(r < 0, F.concat(F.lit("-"), F.lpad(F.abs(r).cast("string"), f.length - 1, "0"))) \
             .otherwise(F.lpad(F.coalesce(r, F.lit(0)).cast("string"), f.length, "0"))
        s = F.when(c.isNull(), F.lpad(F.lit(""), f.length, "0")).otherwise(s)
        return s
    elif f.kind == "dec":
        s = F.coalesce(F.round(c.cast("decimal(38,10)"), f.decimals).cast(f"decimal(38,{f.decimals})").cast("string"), F.lit(""))
    elif f.kind == "date":
        s = F.coalesce(F.date_format(c, f.fmt or "yyyyMMdd"), F.lit(""))
    elif f.kind == "day":
        s = F.coalesce(_day(c, f.fmt) if isinstance(kind, T.DateType) else F.date_format(c, f.fmt), F.lit("".join("0" if x.isalpha() else x for x in f.fmt)))
    elif f.kind == "constant":
        s = F.lit(f.fmt)
    else:
        raise ValueError(f.kind)
    return s


_PARTS = {"dd": F.dayofmonth, "MM": F.month, "yyyy": F.year}


def _day(c: Column, fmt: str) -> Column:
    """``date_format`` of a date; where the format has only days, months and years, from these as one number (much cheaper)."""
    parts = re.findall("dd|MM|yyyy", fmt)
    if "".join(parts) != fmt:
        return F.date_format(c, fmt)
    number = reduce(lambda n, p: n * 10 ** len(p) + _PARTS[p](c), parts[1:], _PARTS[parts[0]](c))
    usual = c.between(F.lit("0001-01-01").cast("date"), F.lit("9999-12-31").cast("date"))
    return F.when(usual, F.lpad(number.cast("string"), len(fmt), "0")).otherwise(F.date_format(c, fmt))


def _whole_number(kind: T.DataType | None) -> bool:
    return isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) or (isinstance(kind, T.DecimalType) and kind.scale == 0 and kind.precision <= 28)


def _direct(f: Out, kind: T.DataType | None, wide: Column) -> Column | None:
    """The field where the column's type says that its own text is the field's, but for filling; None elsewhere.

    ``wide`` is the value of a text that is too long.  What comes out is what ``_pad`` of
    ``_render`` gives, without decimals of other scales on the way.
    """
    c = F.col(f.source or f.name)
    text = c.cast("string")
    if f.kind == "zero" and _whole_number(kind):
        signed = F.concat(F.lit("-"), F.lpad(F.substring(text, 2, f.length), f.length - 1, "0"))
        filled = F.when(text.startswith("-"), signed).otherwise(F.lpad(text, f.length, "0"))
        missing = "0" * f.length
    elif (f.kind == "num" and kind is not None) or (f.kind == "dec" and isinstance(kind, T.DecimalType) and kind.scale == f.decimals <= 10 and kind.precision - kind.scale <= 28):
        filled, missing = F.lpad(text, f.length, " "), " " * f.length
    else:
        return None
    return F.when(c.isNull(), F.lit(missing)).when(F.length(text) > f.length, wide).otherwise(filled)


def _raw_width(f: Out) -> Column:
    if f.kind in ("day", "constant"):
        return F.lit(len(f.fmt))
    c = F.col(f.source or f.name)
    if f.kind in ("zero", "implied"):
        v = c.cast("decimal(38,10)") * F.lit(10 ** (f.decimals if f.kind == "implied" else 0))
        r = F.round(v, 0).cast("decimal(38,0)")
        return F.length(F.abs(r).cast("string")) + F.when(r < 0, 1).otherwise(0)
    return F.length(_render(f))


def _pad(f: Out, s: Column) -> Column:
    if f.kind == "text" and f.cut:
        return F.rpad(s, f.length, " ")  # takes the first characters of a longer one
    if f.kind in ("num", "dec"):
        return F.lpad(s, f.length, " ")
    if f.kind in ("zero", "implied"):
        return s
    return F.rpad(s, f.length, " ")


def resolve_layout(layout: list[Out]) -> list[tuple[int, int, Out, int]]:
    """K3: resolve fields that overlap or are listed out of order.

    Each position belongs to the field written last that covers it.  Returns segments
    ``(start, length, field, offset_in_field)`` in position order; uncovered positions
    are blank (field None).
    """
    width = max(f.start + f.length - 1 for f in layout)
    owner: list[Out | None] = [None] * (width + 1)
    for f in layout:                       # later fields overwrite earlier ones
        for p in range(f.start, f.start + f.length):
            owner[p] = f
    segs = []
    p = 1
    while p <= width:
        f = owner[p]
        q = p
        while q + 1 <= width and owner[q + 1] is f:
            q += 1
        segs.append((p, q - p + 1, f, (p - f.start) if f else 0))
        p = q + 1
    return segs


def _overflows(f: Out) -> Column:
    return F.lit(False) if f.cut and f.kind == "text" else F.coalesce(_raw_width(f) > f.length, F.lit(False))


def record_column(layout: list[Out], on_overflow: str = "raise", types: dict[str, T.DataType] | None = None) -> Column:
    """K2: the fixed-layout record as one text column (see ``to_fixed``).

    ``types`` gives the columns' types, with which many fields take fewer steps.
    """
    if on_overflow not in ("raise", "flag"):
        raise ValueError(on_overflow)
    types = types or {}

    def whole(f: Out) -> Column:
        kind = types.get(f.source or f.name)
        if f.kind in ("day", "constant") or (f.cut and f.kind == "text"):
            return _pad(f, _render(f, kind))
        if on_overflow == "flag":
            wide = F.lit("*" * f.length)
        else:
            message = F.concat(F.lit(f"value of field {f.name} is wider than {f.length}: "), F.col(f.source or f.name).cast("string"))
            wide = F.raise_error(message).cast("string")
        direct = _direct(f, kind, wide)
        return F.when(_overflows(f), wide).otherwise(_pad(f, _render(f))) if direct is None else direct
    # keyed by position in the layout: one column may be written at several places
    rendered = {id(f): whole(f) for f in layout}
    parts = [F.lit(" " * length) if f is None else rendered[id(f)] if length == f.length else F.substring(rendered[id(f)], off + 1, length)
             for start, length, f, off in resolve_layout(layout)]
    return F.concat(*parts)


def _types_of(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def to_fixed(df: DataFrame, layout: list[Out], record: str = "record", on_overflow: str = "raise") -> DataFrame:
    """K2: one text column per row with every field at its exact position.

    A value wider than its field is never cut.  ``on_overflow``: ``raise`` fails the job
    and names the field; ``flag`` fills the field with ``*`` and adds ``overflow``, the
    list of such fields (see ``fixed_and_rejects`` for a side output).
    """
    out = df.withColumn(record, record_column(layout, on_overflow, _types_of(df)))
    if on_overflow == "flag":
        out = out.withColumn("overflow", F.array_distinct(F.array_compact(
            F.array(*[F.when(_overflows(f), F.lit(f.name)) for f in layout]))))
    return out


def parse_layout(text: str) -> list[Out]:
    """A layout from text: fields separated by ``|``, each ``name width``, following on from the one before.

    ``@45`` in front of a field moves to position 45.  Widths: ``9`` number, right-aligned;
    ``$9`` text, cut at its width; ``z9`` zero-filled; ``9.2`` number with decimals; a date
    format such as ``ddMMyyyy`` (zeros where missing); a quoted constant has no name.
    """
    out, at = [], 1
    for part in (p.strip() for p in text.replace("\n", " ").split("|")):
        if not part:
            continue
        if part.startswith("@"):
            jump, part = part[1:].split(None, 1)
            at = int(jump)
        if part.startswith("'"):
            f = Out("constant", at, len(part) - 2, "constant", fmt=part[1:-1])
        else:
            name, spec = part.split(None, 1)
            if spec.startswith("$"):
                f = Out(name, at, int(spec[1:]), "text", cut=True)
            elif spec.startswith("z"):
                f = Out(name, at, int(spec[1:]), "zero")
            elif spec[0].isdigit():
                width, _, decimals = spec.partition(".")
                f = Out(name, at, int(width), "dec" if decimals else "num", int(decimals or 0))
            else:
                f = Out(name, at, len(spec), "day", fmt=spec)
        out.append(f)
        at = f.start + f.length
    return out


def _split_up(text: str, column: str) -> Column:
    """``text``, in a form that keeps its projection out of whole-stage code generation.

    There a projection of up to 100 columns becomes part of one method; with the fields of a
    record that method passes the 8,000 bytes up to which the JVM compiles it, and runs interpreted
    for good.  Outside, a projection's code is split into small methods.  A higher-order function
    is what Spark leaves outside; this one sees nothing but whether a key is missing.
    """
    return F.get(F.transform(F.array(F.col(column).isNull()), lambda _: F.lit(text)), F.lit(0))


def file_records(df: DataFrame, files: list[tuple[str, Column | None, list[Out]]], keys: list[str]) -> DataFrame:
    """K2/K5/K6: several fixed layouts in one pass.

    ``files`` lists (file, condition, layout); a file may be listed more than once.  Each
    row becomes an array of its (file, record) pairs, which is exploded: ``df`` is
    computed once, however many files there are.  Returns ``keys``, ``file`` and ``record``.

    The array is a projection of its own, for which Spark generates code; as an argument of the
    generator or of a filter on arrays it would be interpreted, field by field.
    """
    types = _types_of(df)
    pairs = [F.struct(_split_up(name, keys[0]).alias("file"), record_column(layout, types=types).alias("record")) for name, _, layout in files]
    each = F.array(*[p if cond is None else F.when(cond, p) for p, (_, cond, _) in zip(pairs, files)])
    # the outer form: no filter on the array's size, which would compute the records twice (the array is never empty)
    rows = df.select(*keys, each.alias("__each")).select(*keys, F.explode_outer("__each").alias("__r"))
    return rows.where("__r IS NOT NULL").select(*keys, "__r.file", "__r.record")


def write_files(records: DataFrame, path: str) -> str:
    """One partitioned text write: a folder ``file=...`` per register file."""
    gathered(records.select("file", "record"), ["file"]).write.mode("overwrite").partitionBy("file").text(path)
    return path


def fixed_and_rejects(df: DataFrame, layout: list[Out], record: str = "record") -> dict[str, DataFrame]:
    """K2 with a side output: ``records`` that fit, and ``rejects`` (rows with a value that does not)."""
    out = to_fixed(df, layout, record, on_overflow="flag")
    fits = F.size("overflow") == 0
    return {"records": out.where(fits).drop("overflow"), "rejects": out.where(~fits)}


# ------------------------------------------------------------------ routing / reports
def route(df: DataFrame, routes: dict[str, Column], exclusive: bool = True, col: str = "route",
          default: str | None = None) -> DataFrame:
    """K5: send rows to named outputs.  Exclusive: first matching route (or ``default``);
    non-exclusive: a row goes to every route it matches (one row per route)."""
    if exclusive:
        r = F.lit(default)
        for name, cond in reversed(list(routes.items())):
            r = F.when(cond, F.lit(name)).otherwise(r)
        return df.withColumn(col, r).where(F.col(col).isNotNull())
    arr = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in routes.items()]))
    return df.withColumn(col, F.explode(arr))


def write_routes(df: DataFrame, path: str, col: str = "route") -> str:
    """K5: one pass, one folder per route."""
    gathered(df, [col]).write.mode("overwrite").partitionBy(col).parquet(path)
    return path


def exception_report(df: DataFrame, marker: dict[str, object]) -> DataFrame:
    """K9: the exceptions, or one marker row when there are none.

    The marker row is kept when a one-row prefix of ``df`` is empty, so the test stops
    at the first exception instead of running the whole input again.
    """
    m = df.limit(1).agg(F.count(F.lit(1)).alias("__n")).where("__n = 0")
    m = m.select(*[F.lit(v).cast(df.schema[k].dataType).alias(k) if k in df.columns else F.lit(v).alias(k)
                   for k, v in marker.items()])
    return df.unionByName(m, allowMissingColumns=True)


def report_lines(df: DataFrame, title: str, columns: list[str], sep: str = ",") -> DataFrame:
    """K4: title line + header line + delimited data lines, with a sort key.

    ``line_type`` 0 = title, 1 = header, 2 = data; data lines keep the row's own sort
    columns so a sorted write prints them in order.
    """
    data = df.select(F.lit(2).alias("line_type"),
                     F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]).alias("line"),
                     *[F.col(c).alias("sort_" + c) for c in columns])
    spark = df.sparkSession
    head = spark.createDataFrame([(0, title), (1, sep.join(c.upper() for c in columns))], "line_type int, line string")
    return head.unionByName(data, allowMissingColumns=True)
