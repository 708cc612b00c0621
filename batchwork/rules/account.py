"""Rules on loans and overdrafts: status, restructuring, pricing, schemes, tags.

Each set is a list of ordered rules for ``compiler.compile_rules``; the code lists are data.
Dates are dates; texts are blank-normalised (``TEXTS``); a missing number counts as below every
number where the rules say so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .compiler import Rule, compile_rules, ladder, listed, rule, unlisted, within

# Loan types of hire purchase; types whose renumbered or bad notes count as
# rescheduled; types with a written-down balance; closed types; types of the two write-off kinds
HIRE_PURCHASE = [128, 130, 380, 381, 700, 705, 983, 993, 996]
RESCHEDULED_TYPES = [128, 130, 700, 705, 380, 381, 709, 710, 131, 132, 720, 725]
WRITTEN_DOWN_TYPES = [(600, 699)]
SETTLED_SPLITS = [984, 985, 994, 995]
WRITTEN_OFF_TYPES = [981, 982, 983, 991, 992, 993, 698, 699]
SHADOW_TYPES = [983, 993, 698, 699]
MODEL_TYPES = [128, 130, 131, 132, 720, 725, 380, 381, 700, 705, 709, 710, 983, 993, 996]
DATED_RESTRUCTURE_TYPES = [128, 130, 380, 381, 700, 705, 720, 725]
EXTENDED_TYPES = [128, 130, 380, 381, 700, 705, 720, 725, 131, 132]
AGENCY_TYPES = [128, 130, 131, 132, 380, 381, 700, 705, 720, 725, 678, 679, 698, 699, 983, 993]
VEHICLE_FACILITIES = [34331, 34332]
STAFF_FACILITY = 34371
# Last-transaction codes of a write-off
WRITE_OFF_CODES = [658, 662, 663]
# Model codes of an extension
EXTENSION_MODELS = ["A1A", "A1B", "A1C", "A1D", "A1E", "A1F", "AK1A", "AK1B", "AK1C", "AK1D", "AK1E", "AK1F"]
# Marks of a running relief, by which the instalment of the last day counts; of hire purchase, by model code
RELIEF_MARKS, RELIEF_MODELS = ["R", "F", "V", "A", "B"], ["A1AM", "A1BM", "A1CM", "A1DM", "A1EM", "A1FM"]
# Agency relief tags by the months that they run
SHORT_RELIEF, LONG_RELIEF = ["UAJ", "MAJ"], ["UBJ", "MBJ", "FJ", "MJ"]
SHORT_PREFIXES, LONG_PREFIXES = ["AU", "CU"], ["BU", "DU", "AF"]

TEXTS = ["flag1", "lmo_tag", "paidind", "borstat", "modeldes", "user5", "oldrr", "restruct_feed", "akpk_status", "nurs_tag", "manual_rr_tag", "akpk_ra_tag"]
STATUS_TYPES = {"xnodays": "int", "arrears": "int", "instalm": "int", "nodays": "int", "acctstat": "string", "impaired": "string", "classifi": "string", "restruct": "string", "rrtag": "string", "complyind": "string",
                "oldrracc": "string", "cyc": "int", "lnty": "int", "completed_on": "date", "ends_on": "date", "assessed_on": "date"}
_CLOSED = {"arrears": 0, "instalm": 0, "nodays": 0, "undrawn": 0}
_MONTH_END = "last_day(add_months({0}, {1}))"


def loan_status_rules(rept: str) -> list[Rule]:
    """D4 and D13 for loans at the report date ``rept``; the last rule that matches wins.

    Status: O open, S settled, W written off, P partly written off, T rescheduled, C
    restructured, K agency, J relief.  Writes ``acctstat``, ``impaired``, ``classifi``,
    ``restruct``, ``rrtag``, ``cyc``, ``completed_on``, ``ends_on``, the measures ``nodays``
    (D6), ``arrears``, ``instalm`` and ``undrawn`` (D8), and zeroes those of settled accounts.
    """
    day, paid, hire = f"DATE '{rept}'", "paidind = 'P'", listed("loantype", HIRE_PURCHASE)
    written_down, written_off = listed("loantype", WRITTEN_DOWN_TYPES), listed("lsttrncd", WRITE_OFF_CODES)
    shadow = listed("loantype", SHADOW_TYPES)
    no_balance, settled = "coalesce(write_down_bal, 0) = 0", {"acctstat": "'S'", "impaired": "'N'", **_CLOSED}
    gone, partly = {"acctstat": "'W'", "impaired": "'Y'"}, {"acctstat": "'P'", "impaired": "'Y'"}
    lost = "coalesce(write_down_bal, -1) <= 0"
    open_again = rule("acctstat NOT IN ('S', 'W')", acctstat="'O'")
    relief = f"CASE WHEN {hire} THEN {listed('modeldes', RELIEF_MODELS)} OR modeldes LIKE 'RAM%' ELSE {listed('substring(lmo_tag, 1, 1)', RELIEF_MARKS)} END"
    pattern = "modeldes RLIKE '^[CTRSWM][0-9]{3}[UD](K| |$)'"
    return [
        # where every account starts
        rule("true", acctstat="'O'", restruct="''", rrtag="''", lnty=0, cyc=0, xnodays=0, arrears=0, nodays=0, instalm="billcnt", undrawn="coalesce(cavaiamt, 0)"),
        rule(listed("facility", VEHICLE_FACILITIES), undrawn=0),
        rule(paid, outstand=0, curbal=0, interdue=0, feeamt=0),
        # paid and written-down accounts
        ladder((f"{hire} AND {paid}", {"acctstat": "'S'", "outstand": 0, **_CLOSED}),
               (f"{written_down} AND {paid} AND NOT ({no_balance})", {}),
               (f"{written_down} AND {paid} AND {written_off}", gone),
               (f"{written_down} AND {paid}", settled),
               (f"{written_down} AND {lost}", gone),
               (written_down, partly),
               (f"{paid} AND coalesce(outstand, 0) = 0 AND {written_off}", gone),
               (f"{paid} AND coalesce(outstand, 0) = 0", settled)),
        # rescheduled
        rule(listed("loantype", RESCHEDULED_TYPES), lnty=1),
        rule("lnty = 1 AND (coalesce(noteno >= 98000, false) OR borstat = 'S')", acctstat="'T'"),
        rule("lnty = 0 AND borstat = 'S'", acctstat="'T'"),
        # restructure mark, by type
        *within(listed("loantype", MODEL_TYPES), "_model",
                rule("noteno >= 98000", restruct="'C'"),
                rule("borstat = 'S'", restruct="'T'"),
                rule("modeldes LIKE 'RAM%' OR modeldes LIKE 'RARM%'", restruct="'Y'"),
                rule("coupon_start IS NOT NULL", completed_on="coupon_start"),
                rule("rrcycle LIKE 'HP%'", cyc="try_cast(substring(rrcycle, 3, 1) AS int)"),
                rule("coalesce(cyc, -1) <= 0 AND foreclosed_on IS NOT NULL", cyc=6)),
        Rule((("_model", {}), ("modeldes IN ('C', 'T', 'Y')", {"restruct": "modeldes"}), ("borstat = 'S'", {"restruct": "'T'"}),
              ("borstat = 'Q'", {"restruct": "'C'"}))),
        ladder((f"{hire} AND borstat = 'W'", {"acctstat": "'P'"}), (f"{hire} AND borstat = 'X'", {"acctstat": "'W'"})),
        # days overdue: since the bill date, with those of the note before, or as given
        rule("bldate IS NOT NULL", nodays=f"greatest(datediff({day}, bldate), 0)"),
        rule("oldnotedayarr > 0 AND noteno BETWEEN 98000 AND 98999", nodays="nodays + oldnotedayarr", xnodays="oldnotedayarr"),
        rule("mordayarr IS NOT NULL", nodays="mordayarr"),
        # restructure mark, by the six places of the model code
        *within(pattern, "_pattern",
                rule("true", rrtag="modeldes", restruct="substring(modeldes, 1, 1)", cyc="try_cast(substring(modeldes, 3, 2) AS int)"),
                ladder((f"NOT {written_down} AND {paid} AND NOT {written_off}", {"acctstat": "'S'"}),
                       (f"NOT {written_down} AND restruct IN ('C', 'R', 'W')", {"acctstat": "'C'"}),
                       (f"NOT {written_down}", {"acctstat": "'T'"})),
                *within(f"_pattern AND (coalesce({day} < delivered_on, false) OR (foreclosed_on IS NOT NULL AND assessed IS NOT NULL))", "_undone",
                        rule("true", restruct="''"), open_again),
                rule("assessed IS NOT NULL", completed_on="assessed"),
                ladder(("restruct = 'W'", {"restruct": "'R'"}), ("restruct = 'M'", {"restruct": "'S'"}))),
        # a cycle of months after foreclosure that has run out
        rule("foreclosed_on IS NOT NULL AND cyc > 0", ends_on=_MONTH_END.format("foreclosed_on", "cyc - 1")),
        *within(f"foreclosed_on IS NOT NULL AND coalesce({day} >= ends_on, true) AND (assessed IS NOT NULL OR coupon_start IS NOT NULL)", "_complied",
                rule("lnty <> 1 OR (user5 <> 'N' AND issued >= DATE '2015-04-06')", restruct="''"),
                open_again, rule("true", complyind="'Y'")),
        # arrears and instalments; one billed for the last day of a month counts from the next
        rule("true", arrears="floor(nodays / 30.0005)", instalm="coalesce(mo_instl_arr, billcnt)"),
        rule(f"day(date_add(bldate, 1)) = 1 AND instalm > 0 AND NOT ({relief} AND coalesce({day} BETWEEN relief_from AND relief_to, false))", instalm="instalm - 1"),
        ladder(("flag1 = 'F'", {"undrawn": 0}), ("flag1 IN ('P', 'I')", {"undrawn": "coalesce(cavaiamt, 0)"})),
        rule("coalesce(balance, -1) < 0", undrawn="apprlim2"),
        # impaired: by loan status; staff loans by days, borrower and user code
        rule("true", impaired="CASE WHEN loanstat = 3 THEN 'Y' ELSE 'N' END"),
        rule(f"faccode = {STAFF_FACILITY} AND (nodays >= 90 OR borstat IN ('F', 'I', 'R') OR user5 = 'N')", impaired="'Y'"),
        # class of a risk rating
        ladder(("coalesce(rtrim(riskrate), '') = ''", {"classifi": "'P'"}), ("riskrate = '1'", {"classifi": "'C'"}), ("riskrate = '2'", {"classifi": "'S'"}),
               ("riskrate = '3'", {"classifi": "'D'"}), ("riskrate = '4'", {"classifi": "'B'"})),
        rule("nplind = 'P'", classifi="'P'"),
        # types that stand for others
        rule(f"{listed('loantype', SETTLED_SPLITS)} AND noteno = 10010", acctstat="'S'", outstand=0, balance=0, arrears=0, instalm=0, undrawn=0),
        rule(listed("loantype", WRITTEN_OFF_TYPES), acctstat="'W'", outstand=0, balance=0, undrawn=0, curbal=0, interdue=0, feeamt=0),
        rule(f"{shadow} AND ({paid} OR user5 = 'F')", acctstat="'S'", classifi="'P'", impaired="'N'", **_CLOSED),
        rule("borstat = 'F'", instalm=999),
        rule(f"borstat = 'F' AND {shadow}", classifi="'B'", impaired="'Y'"),
        # written-down accounts again, now that the impaired flag is known
        rule(f"{written_down} AND NOT {paid} AND loanstat = 3 AND impaired = 'Y'", acctstat=f"CASE WHEN {lost} THEN 'W' ELSE 'P' END"),
        rule(f"{written_down} AND {paid}", acctstat=f"CASE WHEN {written_off} THEN 'W' ELSE 'S' END", impaired=f"CASE WHEN {written_off} THEN 'Y' ELSE 'N' END"),
        rule(f"{shadow} AND NOT {paid}", classifi="'B'", impaired="'Y'"),
        # restructured in certain years
        *within(f"{listed('loantype', DATED_RESTRUCTURE_TYPES)} AND noteno >= 98000", "_dated",
                ladder(("coalesce(issued, DATE '0001-01-01') <= DATE '2005-09-30' OR issued BETWEEN DATE '2007-12-19' AND DATE '2008-08-31'", {"restruct": "'T'"}),
                       ("issued >= DATE '2008-09-01' OR issued BETWEEN DATE '2005-10-01' AND DATE '2007-12-18'", {"restruct": "'C'"})),
                ladder(("restruct = 'C'", {"acctstat": "'C'"}), ("restruct = 'T'", {"acctstat": "'T'"})),
                rule(paid, acctstat="'S'", outstand=0, **_CLOSED)),
        rule(f"{listed('loantype', EXTENDED_TYPES)} AND coalesce(noteno, 0) < 98000 AND {listed('modeldes', EXTENSION_MODELS)}", restruct="'C'", acctstat="'C'", rrtag="modeldes"),
        # the restructure feed overwrites the mark wherever it has the account
        *within("restruct_feed <> ''", "_fed",
                rule("true", restruct="CASE restruct_feed WHEN 'R' THEN 'C' WHEN 'S' THEN 'T' ELSE restruct_feed END"),
                rule(f"{unlisted('loantype', [983, 993])} AND NOT {paid} AND restruct IN ('C', 'T')", acctstat="restruct")),
        *within("user5 = 'R' OR oldrr = 'R'", "_old",
                rule("true", oldrracc="'R'"),
                *within("_old AND (user5 = 'R' OR coalesce(delivered_on, DATE '0001-01-01') < DATE '2016-03-01')", "_lapsed",
                        rule("true", restruct="''"), rule("acctstat NOT IN ('S', 'W', 'P')", acctstat="'O'"))),
        # agency and relief
        rule(f"{listed('loantype', AGENCY_TYPES)} AND akpk_status IN ('AKPK', 'RAKPK') AND acctstat NOT IN ('S', 'F')", acctstat="'K'"),
        rule(f"{listed('loantype', AGENCY_TYPES)} AND akpk_status = 'RAKPK' AND noteno >= 98000", restruct="''", rrtag="akpk_status"),
        rule("true", assessed_on="assessed"),
        rule(f"NOT {hire} AND acctstat <> 'S' AND nurs_tag = 'K'", acctstat="'K'", assessed_on="nurs_tagdt"),
        rule(f"{listed('facility', VEHICLE_FACILITIES)} AND acctstat <> 'S' AND manual_rr_dt <= {day}"
             f" AND (({listed('manual_rr_tag', SHORT_RELIEF)} AND {day} <= {_MONTH_END.format('manual_rr_dt', 5)})"
             f" OR ({listed('manual_rr_tag', LONG_RELIEF)} AND {day} <= {_MONTH_END.format('manual_rr_dt', 23)}))", acctstat="'J'"),
        rule(f"{unlisted('facility', VEHICLE_FACILITIES)} AND acctstat <> 'S' AND substring(akpk_ra_tag, 3, 1) BETWEEN '1' AND '9' AND akpk_ra_start <= {day}"
             f" AND (({listed('substring(akpk_ra_tag, 1, 2)', SHORT_PREFIXES)} AND {day} <= {_MONTH_END.format('akpk_ra_start', 5)})"
             f" OR ({listed('substring(akpk_ra_tag, 1, 2)', LONG_PREFIXES)} AND {day} <= last_day(akpk_ra_end)))", acctstat="'J'"),
    ]


# Overdraft products that are inactive
INACTIVE_PRODUCTS = [(30, 34)]


def overdraft_status_rules() -> list[Rule]:
    """D4 for overdrafts: inactive products by write-off status, then accounts gone or closed."""
    inactive = listed("product", INACTIVE_PRODUCTS)
    no_limit = "coalesce(apprlimt, 0) = 0 AND round(outstand) <= 0"
    closed = "closed_on IS NOT NULL AND openind IN ('B', 'C', 'P')"
    return [
        rule("true", acctstat="'O'"),
        ladder((f"{inactive} AND wostat = 'W' AND coalesce(write_down_bal, -1) <= 0", {"acctstat": "'W'"}),
               (f"{inactive} AND wostat IN ('W', 'P')", {"acctstat": "'P'"}),
               (f"{inactive} AND wostat = 'C'", {"acctstat": "'X'"}),
               (f"NOT {inactive} AND wostat = 'R'", {"acctstat": "'O'"})),
        rule(f"(({no_limit} AND (coalesce(round(previous_outstand) > 0, false) OR coalesce(previous_limit > 0, false))) OR ({closed}))"
             f" AND (NOT (coalesce(riskcode IN ('1', '2', '3', '4'), false) OR {inactive}) OR openind IN ('B', 'C', 'P'))",
             acctstat="'S'", arrears=0, instalm=0, nodays=0),
    ]


# Pricing by the limit's index, by the overdraft plan, by the cost-of-funds index
BASE_RATE, BASE_FINANCING = [1, 30], [38, 39]
PLAN_PRICING = {"43": [110, 111, 114], "41": [100, 101, (103, 105), 107], "00": [106, 998], "44": [120, 121]}
FIXED_TYPES = [983, 993, 128, 130, 380, 381, 700, 705]
VARIABLE_TYPES = [678, 679, 698, 699, 131, 132, 720, 725]
INDEX_PRICING = [((900, 903), "53"), ((904, 907), "57"), ((908, 911), "54"), ((912, 915), "55"), ((916, 919), "56"), ((920, 923), "58"),
                 ((925, 925), "79"), ((926, 926), "61"), ((927, 927), "62"), ((928, 928), "63"), ((929, 929), "64"), ((930, 930), "65"),
                 ((931, 931), "66"), ((932, 932), "67"), ((933, 933), "51")]


def overdraft_pricing() -> Rule:
    """D3 for overdrafts: one ladder on the limit's index, then plan."""
    none, no_amount = "coalesce(lmtindex, 0) = 0", "coalesce(lmtamt, 0) = 0"
    return ladder(
        ("lmtindex IN (18, 19)", {"typeprc": "'59'"}),
        (f"{listed('lmtindex', BASE_RATE)} AND coalesce(lmtrate >= lmtbaser, lmtbaser IS NULL)", {"typeprc": "'41'"}),
        (listed("lmtindex", BASE_RATE), {"typeprc": "'42'"}),
        (listed("lmtindex", BASE_FINANCING), {"typeprc": "'43'"}),
        (f"{none} AND fdrcno > 0", {"typeprc": "'68'"}),
        *[(f"{none} AND {no_amount} AND {listed('odplan', plans)}", {"typeprc": f"'{code}'"}) for code, plans in PLAN_PRICING.items()],
        (f"{none} AND {no_amount}", {"typeprc": "'79'"}),
        (f"{none} AND lmtamt > 0", {"typeprc": "'59'"}),
        ("lmtindex = 52", {"typeprc": "'44'"}),
        ("true", {"typeprc": "'79'"}))


def loan_pricing() -> Rule:
    """D3 for loans: by type, then by note index, then by cost-of-funds index.

    A spread that is missing counts as below zero.  (The range test on types 1-99 and
    100-109 at once can't hold, so those types follow the general cases.)
    """
    below = [(f"{listed('ntindex', BASE_RATE)} AND coalesce(spread, -1) < 0", "42"), (listed("ntindex", BASE_RATE), "41"), (listed("ntindex", BASE_FINANCING), "43")]
    variable = listed("loantype", VARIABLE_TYPES)
    return ladder(
        (listed("loantype", FIXED_TYPES), {"typeprc": "'80'"}),
        *[(f"{variable} AND {when}", {"typeprc": f"'{code}'"}) for when, code in below],
        (variable, {"typeprc": "'80'"}),
        ("cfindex = 997", {"typeprc": "'68'"}),
        *[(when, {"typeprc": f"'{code}'"}) for when, code in below],
        ("ntindex = 52", {"typeprc": "'44'"}),
        *[(listed("cfindex", [band]), {"typeprc": f"'{code}'"}) for band, code in INDEX_PRICING],
        ("cfindex = 924 OR costfund > 0", {"typeprc": "'68'"}),
        ("true", {"typeprc": "'59'"}))


# Special funds and concepts by loan type (and, for the types that stand for
# others, by the type they stand for), in the order in which they apply; the last one wins
FUNDS = [("00", [124, 145], []), ("10", [566], [566]), ("11", [170, 564, 565], [170, 564, 565]), ("12", [559, 560, 567], [559, 560, 567]),
         ("14", [568, 570, 532, 533, 573, 574], [568, 570, 573]), ("16", [561], [561]), ("18", [555, 556], [555, 556]),
         ("99", [521, 522, 523, 528], [521, 522, 523, 528])]
FUND_STAND_INS = [991, 994]
CONCEPT_F = [(110, 120), 122, 126, 141, 142, 143, 127, 129, 139, 140, 170, 172, 181, (194, 196)]
CONCEPT_G = [6, 7, 61, 200, 201, 204, 205, (209, 212), 214, 215, 219, 220, 225, 226, (300, 302), 304, 305, 309, 310, 315, 320, 325, 330, 335,
             340, 345, 350, (355, 358), (362, 365), 391, (504, 506), 509, 510, 515, 516, (900, 905), 909, 914, 915, 919, 920, 950, 951]
CONCEPT_H = [500, (517, 530), 532, 555, 556, 559, 560, 561, (564, 570), 573]
CONCEPTS = [(10, [124, 145, 461], [], []), (10, CONCEPT_F, [981, 982, 984, 985], CONCEPT_F), (13, [180], [981, 982, 984, 985], [180]),
            (16, [128, 130, 131, 132, 983], [], []), (18, [193], [], []), (26, [135, 136, 138, 182], [982, 985], [135, 136]),
            (51, CONCEPT_G, [981, 982, 994, 995], CONCEPT_G), (52, [910, 925], [992, 995], [910, 925]),
            (59, [4, 5, 15, 20, (25, 34), 60, 62, 63, (70, 78), 360, 380, 381, 390, 700, 705, 993, 996], [], []),
            (60, [227, 228, (230, 243), 359, 361, 531, 906, 907], [], []), (99, CONCEPT_H, [991, 992, 994, 995], CONCEPT_H)]
SYNDICATED = [180, 914, 915, 919, 920, 925, 950, 951, 953]


def scheme_rules() -> list[Rule]:
    """Special fund, concept and syndication of a loan type; the last match wins."""
    out = [rule("true", specialf="'00'", fconcept=99, syndicat="'N'")]
    for fund, types, behind in FUNDS:
        out.append(rule(listed("loantype", types), specialf=f"'{fund}'"))
        if behind:
            out.append(rule(f"{listed('loantype', FUND_STAND_INS)} AND {listed('pzipcode', behind)}", specialf=f"'{fund}'"))
    for concept, types, stand_ins, behind in CONCEPTS:
        out.append(rule(listed("loantype", types), fconcept=concept))
        if behind:
            out.append(rule(f"{listed('loantype', stand_ins)} AND {listed('pzipcode', behind)}", fconcept=concept))
    return [*out, rule(listed("loantype", SYNDICATED), syndicat="'Y'")]


# The two families of relief tags
OWN_TAGS = ["D", "X", "L", *[f"{c}{i}" for c in "DXL" for i in range(1, 10)], "O", "P", "R1", "R2", "R3", "E", "T", "W", "E1", "E2", "E3", "T1", "T2", "T3"]
FURTHER_TAGS = [f"{c}{i}" for c in "CGMNQK" for i in range(1, 10)]


def latest_tag(facility: Column, agency: Column, issued: Column, own: Column, own_date: Column, further: Column, further_date: Column) -> tuple[Column, Column]:
    """The relief tag of an account and its date.

    Vehicle facilities carry the agency's status and the issue date.  Others carry the
    latest of the tags that belong to one of the two families; on equal dates the further
    one, and a missing date is the earliest.  The greater of two structs settles it.
    """
    def dated(tag: Column, day: Column, family: int, codes: list[str]) -> Column:
        return F.when(F.rtrim(tag).isin(codes), F.struct(day.alias("day"), F.lit(family).alias("family"), F.rtrim(tag).alias("tag")))
    best = F.greatest(dated(own, own_date, 1, OWN_TAGS), dated(further, further_date, 2, FURTHER_TAGS))
    vehicle = F.coalesce(facility.isin(VEHICLE_FACILITIES), F.lit(False))
    return F.when(vehicle, agency).otherwise(best["tag"]), F.when(vehicle, issued).otherwise(best["day"])


def loan_status(loans: DataFrame, rept: str) -> DataFrame:
    """D4 and D13 on a table of loans (see ``loan_status_rules`` for what is read and written)."""
    return compile_rules(loans, loan_status_rules(rept), blank=TEXTS, types=STATUS_TYPES)
