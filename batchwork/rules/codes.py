"""Code rule sets held as data: ordered lookups where precedence is explicit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import code_table

# Collateral category → class codes, in the order the reference lists
# them.  A code listed under two categories belongs to the one listed later ("111"
# appears under "90" and "50": it is "50").
COLLATERAL_CLASSES = {
    "29": ["001", "006", "007", "014", "016", "024", "112", "113", "114", "115", "116", "117",
           "025", "026", "046", "048", "049", "149"],
    "70": ["000", "011", "012", "013", "017", "018", "019", "021", "027", "028", "029", "030",
           "124", "031", "105", "106"],
    "90": ["002", "003", "041", "042", "043", "058", "059", "067", "068", "069", "070", "111", "123",
           "071", "072", "078", "079", "084", "107"],
    "30": ["004", "005", "127", "128", "129", "142", "143"],
    "10": ["032", "033", "034", "035", "036", "037", "038", "039", "040", "044", "050", "051", "052",
           "053", "054", "055", "056", "057", "118", "119", "121", "122", "060", "061", "062"],
    "40": ["065", "066", "075", "076", "082", "083", "093", "094", "095", "096", "097", "098",
           "131", "132", "133", "134", "135", "136", "137", "138", "139", "141", "101", "102", "103", "104"],
    "60": ["063", "064", "073", "074", "080", "081"],
    "50": ["010", "085", "086", "087", "088", "089", "090", "091", "092", "111", "125", "126", "144"],
    "00": ["009", "022", "023"],
    "21": ["008"],
    "22": ["045", "047"],
    "23": ["015"],
    "80": ["020"],
    "81": ["108", "109"],
    "99": ["077"],
}
# Sub-types within the property and vehicle categories
PROPERTY_TYPES = [("LAND", ["032", "033", "034"]), ("BUILDING", ["035", "036", "037"]), ("HOUSE", ["038", "039", "040"])]
MOTOR_CODES = ["004", "005"]
HEAVY_CODES = ["065", "066"]


def collateral_table(spark: SparkSession) -> DataFrame:
    """(code, category) with the later-listed category winning a repeated code."""
    resolved: dict[str, str] = {}
    for cat, codes in COLLATERAL_CLASSES.items():
        for c in codes:
            resolved[c] = cat
    return code_table(spark, sorted(resolved.items()), "cclassc string, collater string")


def collateral_category(df: DataFrame, code_col: str) -> DataFrame:
    """Category by broadcast lookup, then the sub-type of property / vehicles."""
    t = collateral_table(df.sparkSession)
    j = df.join(t, df[code_col] == t.cclassc, "left").drop("cclassc")
    code = F.col(code_col)
    prop = F.lit("OTHER")
    for name, codes in reversed(PROPERTY_TYPES):
        prop = F.when(code.isin(codes), F.lit(name)).otherwise(prop)
    sub = (F.when(F.col("collater") == "10", prop)
            .when(F.col("collater") == "30", F.when(code.isin(MOTOR_CODES), F.lit("MOTOR")).otherwise(F.lit("OTHER")))
            .when(F.col("collater") == "40", F.when(code.isin(HEAVY_CODES), F.lit("HEAVY")).otherwise(F.lit("OTHER"))))
    return j.withColumn("subtype", sub)


def staged(df: DataFrame, stages: list[tuple[str, Column]]) -> DataFrame:
    """Apply ordered rule stages; each stage sees the columns written before it."""
    for name, expr in stages:
        df = df.withColumn(name, expr)
    return df


def precedence_lookup(df: DataFrame, lookups: list[tuple[DataFrame, str, str]], out: str, default=None) -> DataFrame:
    """Several lookup tables tried in precedence order: the first table holding
    the row's key gives the value.  Each lookup is a (small) broadcast left join."""
    vals = []
    for i, (tbl, key, val) in enumerate(lookups):
        t = tbl.select(F.col(key).alias(f"__k{i}"), F.col(val).alias(f"__v{i}"))
        df = df.join(t, df[key] == t[f"__k{i}"], "left").drop(f"__k{i}")
        vals.append(F.col(f"__v{i}"))
    df = df.withColumn(out, F.coalesce(*vals, F.lit(default)))
    return df.drop(*[f"__v{i}" for i in range(len(lookups))])
