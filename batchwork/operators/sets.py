"""Set operations on tables of possibly different shapes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .keys import _cols


def concat(frames: list[DataFrame]) -> DataFrame:
    """SET a b c — by name, columns missing on one side become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


_NUM_RANK = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.FloatType, T.DoubleType]


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b:
        return a
    ra = next((i for i, t in enumerate(_NUM_RANK) if isinstance(a, t)), None)
    rb = next((i for i, t in enumerate(_NUM_RANK) if isinstance(b, t)), None)
    if ra is not None and rb is not None:
        if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
            s = max(a.scale, b.scale)
            return T.DecimalType(min(38, max(a.precision - a.scale, b.precision - b.scale) + s), s)
        return a if ra >= rb else b
    return T.StringType()


def concat_relaxed(frames: list[DataFrame]) -> DataFrame:
    """Like ``concat`` but a column whose type differs is widened (numbers to the
    widest number, anything else to string) before the union."""
    types: dict[str, T.DataType] = {}
    order: list[str] = []
    for f in frames:
        for fld in f.schema.fields:
            if fld.name not in types:
                types[fld.name] = fld.dataType
                order.append(fld.name)
            else:
                types[fld.name] = _wider(types[fld.name], fld.dataType)
    conformed = [f.select(*[F.col(c).cast(types[c]).alias(c) if c in f.columns
                            else F.lit(None).cast(types[c]).alias(c) for c in order]) for f in frames]
    return reduce(lambda a, b: a.unionByName(b), conformed)


def concat_with_source(frames: dict[str, DataFrame], flag: str = "source") -> DataFrame:
    """SET A(IN=x) B — a literal column says where each row came from."""
    return concat([df.withColumn(flag, F.lit(name)) for name, df in frames.items()])


def except_by_key(a: DataFrame, b: DataFrame, keys) -> DataFrame:
    """U4: rows of ``a`` whose key is not in ``b``."""
    return a.join(b.select(*_cols(keys)), on=_cols(keys), how="left_anti")


def intersect_by_key(a: DataFrame, b: DataFrame, keys) -> DataFrame:
    """Rows of ``a`` whose key is also in ``b``."""
    return a.join(b.select(*_cols(keys)), on=_cols(keys), how="left_semi")
