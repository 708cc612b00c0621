"""Facility of a loan from product code, loan type and purpose.

One table of rows with wildcards (missing keys match anything); the most specific row wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import wildcard_lookup

# Facility by product code
BY_PRODUCT = {34210: ["34190"], 34322: ["34120", "54120"], 34331: ["34111", "54124"], 34341: ["34112"], 34351: ["34114"], 34361: ["34113"],
              34371: ["34230"], 34391: ["34149", "34117", "34115"]}
# Facility by loan type
BY_TYPE = [(34321, [110, 141, 200, 201, 225, 227, 230, 232, 237, 239, 244, 246, 249, 409, 479, 484, 433, 445]),
           (34322, [981, 984, 991, 994, 410, 486, 489, 494, 472, 473, 474]), (34331, [993, 996, 983]), (34332, [130, 132, 381, 705, 725, 699]),
           (34391, [500, 520, 982, 985, 992, 995]), (34391, [800, 801, 804, 851, 852, 853, 854, 855, 805, 807, 809, 811, 813]),
           (34210, [802, 803, 856, 857, 858, 859, 860, 806, 808, 810, 812, 814]), (34371, [102, 103, 104, 105])]
# Loan types whose facility and facility code are set together, after all others
PAIRS = [(34322, 34320, [412, 413, 414, 911, 415, 466]), (34391, 34391, [912, 575, 416, 467, 461]), (34391, 34392, [307, 422, 464, 465]),
         (34371, 34371, [103, 104]), (34351, 34364, [191, 417])]
# Vehicle loans, facility code by purpose; and types with a facility code of their own
VEHICLE_TYPES = [128, 130, 131, 132, 380, 381, 700, 705, 709, 710, 720, 725, 750, 752, 760, 983, 993, 996, 698, 699]
VEHICLE_PURPOSES = {34333: ["3100", "3101", "3110", "3120"], 34334: ["3300", "3900", "3901", "4100", "5100", "5200", "3200", "3201"]}
OWN_CODE = [(34333, [698, 699])]
SHADOW_PRODUCT = {698: "34111"}


def facility_rows() -> list[tuple]:
    """(loan type, product code, purpose, layer, facility, facility code); a later layer beats an earlier one."""
    rows = [(None, p, None, 1, facility, None) for facility, products in BY_PRODUCT.items() for p in products]
    rows += [(t, None, None, 2, facility, None) for facility, types in BY_TYPE for t in types]
    rows += [(t, None, None, 2, None, code) for code, types in OWN_CODE for t in types]
    rows += [(t, None, p, 3, None, code) for code, purposes in VEHICLE_PURPOSES.items() for p in purposes for t in VEHICLE_TYPES]
    rows += [(t, None, None, 4, facility, code) for facility, code, types in PAIRS for t in types]
    return rows


def facility_codes(df: DataFrame) -> DataFrame:
    """D2 on rows with loantype, prodcd and purpose: adds ``facility`` and ``faccode`` (the facility where no row gives a code)."""
    shadow = F.lit(None).cast("string")
    for kind, product in SHADOW_PRODUCT.items():
        shadow = F.when(F.col("loantype") == kind, F.lit(product)).otherwise(shadow)
    d = df.withColumn("prodcd", F.coalesce(shadow, F.col("prodcd")))
    out = wildcard_lookup(d, facility_rows(), ["loantype", "prodcd", "purpose"], ["int", "string", "string"], {"facility": "int", "faccode": "int"})
    return out.withColumn("faccode", F.coalesce("faccode", "facility"))
