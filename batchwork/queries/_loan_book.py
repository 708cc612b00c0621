"""A loan book derived from the supplied orders: the real codes, dealt out by order key.

Every column takes its values from a list in turn (``order key // step % length``), so that all
codes meet all others; amounts and dates come from the order itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import load

# column -> (step, type, values)
DEALT: dict[str, tuple[int, str, list]] = {
    "loantype": (1, "int", [128, 130, 380, 700, 983, 993, 996, 131, 720, 709, 600, 650, 698, 699, 678, 981, 982, 984, 985, 991, 992, 994, 995, 110, 122,
                            124, 145, 461, 170, 180, 193, 135, 182, 200, 225, 300, 358, 362, 500, 517, 530, 532, 533, 555, 559, 560, 561, 564, 566, 567,
                            568, 573, 521, 528, 227, 236, 359, 531, 907, 910, 925, 914, 950, 953, 4, 27, 62, 75, 360, 390, 103, 412, 800, 972, None]),
    "noteno": (3, "int", [10, 10010, 97999, 98000, 98500, 30010, None]),
    "paidind": (5, "string", ["P", "N", " ", None, "P"]),
    "write_down_bal": (7, "int", [0, None, -5, 100]),
    "lsttrncd": (2, "int", [658, 662, 663, 100, None]),
    "borstat": (11, "string", ["S", "F", "W", "X", "Q", "I", " ", None, "R"]),
    "modeldes": (13, "string", ["C", "T012UK", "C103D", "W204U ", "M305DK", "R999U", "S1A0U", "RAM1", "RARM2", "A1A", "AK1F", "Y", "", None, "T012X"]),
    "user5": (17, "string", ["N", "F", "R", " ", None]),
    "oldrr": (19, "string", [None, None, "R", " "]),
    "restruct_feed": (23, "string", [None, None, None, "R", "S", "C", "T", "X", " ", None]),
    "akpk_status": (29, "string", [None, "AKPK", "RAKPK", "NONE", None, None]),
    "nurs_tag": (31, "string", [None, "K", "D", "X9", "E2", "C1", "zz", None, "T3"]),
    "tfa_nurs_tag": (37, "string", [None, "C1", "G9", "K5", "D", "N3 ", None]),
    "manual_rr_tag": (41, "string", [None, "UAJ", "MAJ", "UBJ", "FJ", "XX"]),
    "akpk_ra_tag": (43, "string", [None, "AU1", "CU0", "BU3", "AF9", "DUx", "ZZ1"]),
    "facility": (6, "int", [34331, 34332, 34210, 34371, None]),
    "faccode": (4, "int", [34371, 34331, 0]),
    "loanstat": (9, "int", [1, 2, 3, None]),
    "riskrate": (47, "string", [None, " ", "1", "2", "3", "4", "9"]),
    "nplind": (53, "string", [None, "P", "F", " "]),
    "rrcycle": (59, "string", [None, "HP3", "HP0", "HPx", "AB3"]),
    "nodays": (61, "int", [0, 12, 90, 400, None]),
    "pzipcode": (14, "int", [566, 170, 560, 573, 561, 556, 522, 112, 180, 135, 209, 910, 518, 570, 1, None]),
    "ntindex": (8, "int", [1, 30, 38, 39, 52, 7, None]),
    "spread": (15, "double", [-0.5, 0.0, 1.25, None]),
    "cfindex": (16, "int", [997, *range(900, 934, 3), 924, 925, 930, 0, None]),
    "costfund": (21, "double", [0.0, 1.0, None]),
    "product": (10, "int", [30, 34, 32, 73, 114, 124, 165, 177, None]),
    "wostat": (12, "string", ["W", "P", "C", "R", None]),
    "openind": (18, "string", ["B", "C", "P", "O", None]),
    "riskcode": (22, "string", ["1", "4", "9", None]),
    "apprlimt": (20, "int", [0, None, 1, 5000]),
    "previous_outstand": (24, "double", [0.4, 0.6, -3.0, None]),
    "previous_limit": (25, "int", [0, 7, None]),
    "lmtindex": (26, "int", [18, 1, 30, 38, 52, 0, None, 0, 77]),
    "lmtrate": (27, "double", [4.0, 5.0, None]),
    "lmtbaser": (28, "double", [4.5, None, 4.0]),
    "fdrcno": (32, "int", [0, None, 12, 0]),
    "lmtamt": (33, "int", [0, None, 900, 0]),
    "odplan": (34, "int", [110, 114, 100, 104, 106, 998, 120, 102, None]),
    "billcnt": (35, "int", [0, 1, 5, None]),
    "mo_instl_arr": (36, "int", [None, None, 2, 0]),
    "oldnotedayarr": (38, "int", [None, 0, 15]),
    "mordayarr": (39, "int", [None, None, None, 7, 120]),
    "flag1": (42, "string", ["F", "P", "I", None, " "]),
    "lmo_tag": (44, "string", ["R1", "F2", "X", None]),
    "cavaiamt": (45, "int", [100, None, 0, 2500]),
    "apprlim2": (46, "int", [0, 700, None]),
    "acty": (71, "string", ["LN", "LN", "LN", "OD"]),
    "branch": (1, "int", list(range(2, 90, 3))),
    "commno": (5, "int", [0, 10, 20, None]),
    "aano": (7, "string", ["AA1", "AA2 ", None, ""]),
    "curcode": (9, "string", ["MYR", "USD", "SGD", None]),
    "forate": (11, "double", [3.5, None, 0.0, 2.25]),
    "ind": (2, "string", ["A", "B", None]),
    "gp3ind": (73, "string", [None, "Y", " "]),
    "leg": (79, "string", [None, "A", "B"]),
    "delqcd": (83, "string", ["10", "7", None]),
    "repaid": (67, "int", [0, 10, 250, None]),
    "mtd_repay_type10_amt": (1, "int", [0, 5, None]),
    "mtd_repay_type20_amt": (2, "int", [7, 0, None, -3]),
    "mtd_repay_type30_amt": (3, "int", [None, 0, 12]),
    "costctr": (4, "int", [3904, 12, None]),
    "totiis": (6, "int", [0, None, 41]),
    "custcd": (1, "string", ["77", "78", "95", "96", "02", "17", "40", "45", "79", "71", "74", "41", "54", "61", "20", "80", "88", "90", "82", "99", "66", "01", "57", "85", "", None]),
    "sectorc": (2, "int", [111, 311, 430, 431, 1000, 1110, 1111, 8110, 8130, 9101, 9999, 5000, None, 0]),
    "sectorcd": (3, "string", ["0410", "0111", "0430", "0431", "1110", "1111", "8110", "8120", "9101", "9203", "9420", "9999", "5001", "", None, "91", "8999"]),
    "crispurp": (5, "string", ["4300", "4100", "5300", "0440", "3100", "", None]),
    "sectold": (7, "string", ["", None, "0311", " "]),
    "fisspurp": (4, "string", ["0470", "0390", "0212", "0430", "0990", "1111", None]),
    "ccricode": (9, "int", [None, 3100, None]),
    "prodcd": (6, "string", ["34111", "34190", "34120", "54120", "54124", "34112", "34114", "34113", "34230", "34149", "34117", "34999", None]),
    "industrial_sector_cd": (8, "string", [None, None, None, "01111", "64191", "00000", "0111", "abcde", ""]),
    "purpose": (11, "string", ["3100", "3120", "3300", "5200", "3201", "9999", "", None]),
}
# dates: days after the order date, none where the key's turn says so
DATED: dict[str, tuple[int, list]] = {
    "issued": (2, [0, -2500, 3200, 4100, None]), "delivered_on": (3, [0, 1200, 6500, None]), "coupon_start": (5, [None, 10, None, 200]),
    "foreclosed_on": (7, [None, -300, 90, None, -60]), "assessed": (9, [None, 30, None]), "nurs_tagdt": (4, [0, 40, None]),
    "tfa_nurs_tag_dt": (6, [40, 0, 39, None]), "manual_rr_dt": (8, [0, -400, -100, None]), "akpk_ra_start": (10, [0, -90, -700, None]),
    "akpk_ra_end": (11, [30, -20, 600, None]), "closed_on": (12, [None, 100]),
    "bldate": (13, [0, -40, 300, None, 1500]), "relief_from": (14, [None, -100, -3000]), "relief_to": (15, [None, 10, 9000]), "exoddt": (16, [None, 10, 700]),
    "tempoddt": (17, [None, 20, 5])}

_TURN = "o_orderkey // {step} % {n} + 1"


def dealt(step: int, kind: str, values: list) -> Column:
    place = (F.floor(F.col("o_orderkey") / step) % len(values) + 1).cast("int")
    return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), place)


def loan_book(spark, sf) -> DataFrame:
    return book_of(load(spark, sf, "orders"), F.col("o_orderkey"))


def book_of(orders: DataFrame, acctno: Column) -> DataFrame:
    price, day = F.col("o_totalprice").cast("decimal(18,2)"), F.col("o_orderdate").cast("date")
    return orders.select(
        acctno.alias("acctno"), F.col("o_custkey").alias("custno"), day.alias("opened"),
        price.alias("balance"), F.when(F.col("o_orderkey") % 7 != 0, price - 150000).alias("outstand"), price.alias("curbal"),
        (price * 3).cast("decimal(18,2)").alias("interdue"), (price + 5).cast("decimal(18,2)").alias("feeamt"),
        *[dealt(*turn).alias(c) for c, turn in DEALT.items()],
        *[F.date_add(day, dealt(step, "int", values)).alias(c) for c, (step, values) in DATED.items()])


def _literal(v, kind: str) -> str:
    return "NULL" if v is None else f"'{v}'" if kind == "string" else str(v)


_SQL_KIND = {"int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE"}


def _dealt_sql(step: int, values: list, kind: str) -> str:
    turn = _TURN.format(step=step, n=len(values))
    return f"(CAST([{', '.join(_literal(v, kind) for v in values)}] AS {_SQL_KIND[kind]}[]))[{turn}]"


LOAN_BOOK_SQL = f"""book AS (SELECT o_orderkey AS acctno, o_custkey AS custno, CAST(o_orderdate AS DATE) AS opened,
  CAST(o_totalprice AS DECIMAL(18,2)) AS balance, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) - 150000 END AS outstand,
  CAST(o_totalprice AS DECIMAL(18,2)) AS curbal, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 3 AS DECIMAL(18,2)) AS interdue,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) + 5 AS DECIMAL(18,2)) AS feeamt,
  {', '.join(f'{_dealt_sql(step, values, kind)} AS {c}' for c, (step, kind, values) in DEALT.items())},
  {', '.join(f"CAST(CAST(o_orderdate AS DATE) + {_dealt_sql(step, values, 'int')} AS DATE) AS {c}" for c, (step, values) in DATED.items())} FROM orders)"""


def steps(start: str, *each: str) -> str:
    """CTEs that change columns one step after another (``* REPLACE``); the last one is named ``done``."""
    out, at = [], start
    for i, change in enumerate(each):
        name = "done" if i == len(each) - 1 else f"t{i}"
        out.append(f"{name} AS (SELECT * REPLACE ({change}) FROM {at})")
        at = name
    return ",\n".join(out)
