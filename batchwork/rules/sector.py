"""Repair of customer, sector and purpose codes.

Ordered rules over two indexed code systems; whenever a rule may have changed a code, its classes
are looked up again (one binary search), so that later rules see the repaired code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keys import join_on
from .compiler import Rule, compile_rules, ladder, listed, rule, within
from .intervals import ClassIndex

# Classes of customer codes
CUSTOMERS = ClassIndex(
    person=["77", "78", "95", "96"],
    individual=["77", "78"],
    financial=["02", "03", "04", "05", "06", "11", "12", "13", "17", "30", "31", "32", "33", "34", "35", "37", "38", "39", "45"],
    exchange=["40"],
    household=["79"],
    government=["71", "72", "73", "74"],
    enterprise=["79", "61", "62", "63", "75", "57", "59", "41", "42", "43", "44", "46", "47", "48", "49", "51", "52", "53", "54"],
    outside=["01", "02", "03", "11", "12", "20", "13", "17", ("30", "40"), "45", "04", "05", "06", ("80", "88"), "90"],
    purpose_free=["01", "02", "03", "11", "12", "20", "13", "17", ("30", "40"), "45", "04", "05", "06", "61", ("41", "44"), "62", "46", "47", "63", "48", "49",
                  "51", "57", "75", "59", "52", "53", "54", ("66", "69")],
    foreign=["82", "83", "84", "86", "90", "91", "95", "96", "98", "99"])
# Classes of sector codes
SECTORS = ClassIndex(primary=[("0111", "0430")], known=[("1111", "9999")], abroad=[("1000", "9999")], banking=["8110", "8120", "8130"],
                     public=[("91", "99~")], home=["9203", "9420", "9440"])
# purposes
REOPENED, PURPOSE_OF_CAR, PURPOSE_OF_HOME = ["0390", "0440", "0470"], "0212", "0410"
PERSONAL_PURPOSES = ["0110", "0120", "0131", "0132", "0139", "0210", "0220", "0230", "0200", "0211", "0212", "0311", "0312", "0313", "0314", "0315",
                     "0316", "0321", "0322", "0323", "0324", "0325", "0326", "0327", "0328", "0329", "0410", "0420", "0430", "0990"]
CAR_PURPOSES = ["0211", "0212", "0200", "0210", "0390", "0430"]
HIRE_PURCHASE = [128, 130, 380, 381, 700, 705, 983, 993, 996]
TEXTS = ["custcd", "sectorcd", "crispurp", "sectold", "fisspurp", "prodcd", "industrial_sector_cd"]


def _classes() -> list[Rule]:
    return [rule("true", _cust=CUSTOMERS.mask("custcd"), _code=SECTORS.mask("sectorcd"))]


def sector_rules() -> list[Rule]:
    """The rules in order; ``sector`` is the raw sector as four digits, ``sectorcd`` the one repaired."""
    cust, code, raw = (lambda *c: CUSTOMERS.has("_cust", *c)), (lambda *c: SECTORS.has("_code", *c)), (lambda *c: SECTORS.has("_raw", *c))
    individual = ladder(("custcd = '77'", {"custcd": "'41'"}), ("true", {"custcd": "'44'"}))

    def to_enterprise(when: str) -> Rule:
        return Rule(tuple((f"{when} AND ({w})", sets) for w, sets in individual.cases))
    unknown = f"NOT ({cust('person')}) AND sectorcd < '1111'"
    nothing_known = f"(crispurp = '' AND ccricode IS NULL AND sectold = '') OR {listed('fisspurp', REOPENED)}"
    return [
        rule("true", _raw=SECTORS.mask("sector")), *_classes(),
        to_enterprise(f"{cust('individual')} AND {raw('known')}"), *_classes(),
        rule(f"{cust('person')} AND {code('primary')}", sectorcd="'0410'"),
        rule(f"NOT ({cust('outside')}) AND {raw('banking')}", sectorcd="'9999'"),
        rule(f"{cust('person')} AND {raw('primary')}", sectorcd="'0410'"),
        ladder((f"{unknown} AND {cust('financial')}", {"sectorcd": "'8110'"}), (f"{unknown} AND {cust('exchange')}", {"sectorcd": "'8130'"}),
               (f"{unknown} AND {cust('household')}", {"sectorcd": "'9203'"}), (f"{unknown} AND {cust('government')}", {"sectorcd": "'9101'"}),
               (unknown, {"sectorcd": "'9999'"})), *_classes(),
        rule(f"{cust('enterprise')} AND {code('banking')}", sectorcd="'9999'"), *_classes(),
        rule(f"{cust('financial', 'exchange')} AND NOT ({code('banking')})", sectorcd="'8110'"), *_classes(),
        rule(f"{cust('government')} AND NOT ({code('public')})", sectorcd="'9101'"), *_classes(),
        to_enterprise(f"{cust('individual')} AND {code('known')}"), *_classes(),
        rule(f"{cust('purpose_free')} AND crispurp IN ('4300', '4100') AND sectold = ''", fisspurp="'0990'"),
        rule("custcd = '79' AND crispurp IN ('5300', '0440', '0460', '5200', '5100') AND sectold = ''", fisspurp="'0990'"),
        rule(f"custcd = '79' AND NOT ({code('home')})", sectorcd="'9203'"),
        rule(f"{cust('foreign')} AND {raw('abroad')}", custcd="'86'"), *_classes(),
        *within(cust("person"), "_person",
                ladder((f"({nothing_known}) AND NOT coalesce(acctno > 3000000000 AND acctno < 4000000000, false) AND {listed('product', HIRE_PURCHASE)}",
                        {"fisspurp": f"'{PURPOSE_OF_CAR}'"}), (nothing_known, {"fisspurp": f"'{PURPOSE_OF_HOME}'"})),
                rule(listed("fisspurp", PERSONAL_PURPOSES), sectorcd="'9700'")),
        rule(f"prodcd = '34111' AND NOT {listed('fisspurp', CAR_PURPOSES)}", fisspurp=f"'{PURPOSE_OF_CAR}'"),
        rule("length(industrial_sector_cd) = 5 AND coalesce(try_cast(industrial_sector_cd AS int) > 0, false)",
             sectorcd="coalesce(industrial_sector, substring(industrial_sector_cd, 1, 4))"),
        rule(cust("person"), sectorcd="'9700'"),
    ]


def sector_repair(df: DataFrame, industrial: DataFrame) -> DataFrame:
    """D1 on rows with custcd, sectorc (a number), sectorcd, crispurp, sectold, fisspurp, ccricode, product, prodcd,
    industrial_sector_cd, acctno; ``industrial`` (industrial_sector_cd, industrial_sector) labels industry codes."""
    d = df.withColumn("sector", F.coalesce(F.lpad(F.col("sectorc").cast("string"), 4, "0"), F.lit("   .")))
    d = join_on(d, industrial, "industrial_sector_cd", "left").select(*d.columns, "industrial_sector")
    return compile_rules(d, sector_rules(), blank=TEXTS)
