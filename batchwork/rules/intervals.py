"""Code classes held as lists and ranges, looked up by one binary search.

``ClassIndex`` merges the lists and ranges of any number of classes into disjoint sorted intervals,
each with the set of classes that it belongs to (one bit per class).  ``mask`` is a binary search as
one SQL expression, so testing a code against ten lists costs a few comparisons, once.  ``table`` and ``join_classes`` do the same for indexes too large for an
expression: an equi-join on a prefix of the code, then the range test.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import code_table


class ClassIndex:
    """Classes of fixed-width codes: each a list of codes and ``(low, high)`` ranges, both ends in.

    Codes compare as texts; the ranges of one class may overlap.
    """

    def __init__(self, **classes: list):
        self.bits = {name: 1 << i for i, name in enumerate(classes)}
        edges: dict[tuple[str, int], dict[str, int]] = {}  # a place is (code, 0) before it or (code, 1) after it
        for name, codes in classes.items():
            for c in codes:
                lo, hi = c if isinstance(c, tuple) else (c, c)
                for place, step in (((lo, 0), 1), ((hi, 1), -1)):
                    here = edges.setdefault(place, {})
                    here[name] = here.get(name, 0) + step
        self.starts: list[tuple[tuple[str, int], int]] = []  # where an interval starts, and its mask
        depth = dict.fromkeys(classes, 0)
        for place in sorted(edges):
            for name, step in edges[place].items():
                depth[name] += step
            mask = sum(self.bits[n] for n, k in depth.items() if k > 0)
            if not self.starts or self.starts[-1][1] != mask:
                self.starts.append((place, mask))

    def mask(self, column: str) -> str:
        """SQL text of the classes of a code (0: none, also for a missing code).

        The search halves its step each time: as many comparisons as the count of
        intervals has binary digits, over two constant arrays.
        """
        n = len(self.starts)
        starts = ", ".join(f"concat('{code}', char(0))" if after else f"'{code}'" for (code, after), _ in self.starts)
        masks = ", ".join(str(m) for m in [0, *(m for _, m in self.starts)])
        halves = ", ".join(str(1 << k) for k in reversed(range(n.bit_length())))
        place = f"aggregate(array({halves}), 0, (at, step) -> IF(get(array({starts}), at + step - 1) <= {column}, at + step, at))"
        return f"coalesce(get(array({masks}), {place}), 0)"

    def has(self, flags: str, *classes: str) -> str:
        """SQL text: is the code with mask ``flags`` in one of the classes?"""
        return f"({flags} & {sum(self.bits[c] for c in classes)}) <> 0"

    def table(self, spark: SparkSession, prefix: int, alphabet: str = "0123456789") -> DataFrame:
        """The intervals as rows (bucket, low, low_after, high, high_after, mask), one per code prefix that they touch."""
        rows = []
        for i, ((lo, la), mask) in enumerate(self.starts):
            if not mask:
                continue
            hi, ha = self.starts[i + 1][0]
            first, last = lo[:prefix], hi[:prefix]
            rows += [(b, lo, la, hi, ha, mask) for b in _prefixes(first, last, alphabet)]
        return code_table(spark, rows, "bucket string, low string, low_after int, high string, high_after int, mask int")


def _prefixes(first: str, last: str, alphabet: str) -> list[str]:
    """Every prefix from ``first`` to ``last`` over the alphabet, in order."""
    def next_one(p: str) -> str | None:
        for i in range(len(p) - 1, -1, -1):
            at = alphabet.index(p[i])
            if at + 1 < len(alphabet):
                return p[:i] + alphabet[at + 1] + alphabet[0] * (len(p) - i - 1)
        return None
    out, p = [], first
    while p is not None and p <= last:
        out.append(p)
        p = next_one(p)
    return out


def join_classes(df: DataFrame, code: str, intervals: DataFrame, prefix: int, out: str = "mask") -> DataFrame:
    """``df`` with the mask of ``code``: equi-join on the code's prefix, then the range test (0 where no interval holds it)."""
    c = F.col(f"__d.`{code}`")
    above = (c > F.col("__i.low")) | ((c == F.col("__i.low")) & (F.col("__i.low_after") == 0))
    below = (c < F.col("__i.high")) | ((c == F.col("__i.high")) & (F.col("__i.high_after") == 1))
    j = df.alias("__d").join(intervals.alias("__i"), (F.substring(c, 1, prefix) == F.col("__i.bucket")) & above & below, "left")
    return j.select(*[F.col(f"__d.`{x}`") for x in df.columns], F.coalesce(F.col("__i.mask"), F.lit(0)).alias(out))


def class_mask(index: ClassIndex, column: str) -> Column:
    return F.expr(index.mask(column))
