"""Layouts of the loan register files (see ``sinks.writers.parse_layout`` for the notation).

Fixed values: names, widths and places of the fields, file by file, in the order of places.
"""

from __future__ import annotations

from pyspark.sql import types as T

from ..sinks.writers import Out, parse_layout

_HEAD = "ficode 9 | apcode 3 | acctno 10"
_NOTE = _HEAD + " | @43 noteno 10 | @73"

SUB_ACCOUNT = parse_layout(f"""{_NOTE} facility 5 | syndicat $1 | specialf $2 | purposes $4 | fconcept 2 | noteterm z3 | payfreqc $2 | restruct $1
| cagamas 8 | recourse $1 | '00000000' | custcode 2 | sector $4 | oldbrh 5 | score $3 | costctr 4 | paid_from ddMMyyyy | granted ddMMyyyy | census z6
| matures ddMMyyyy | first_maturity ddMMyyyy | cavaiamt 16 | collmake $6 | modeldes $6 | delivered ddMMyyyy | collmm z2 | collyr z2 | next_bill ddMMyyyy
| payfreq $1 | orgtype $1 | paidind $1 | aano $13 | final_release ddMMyyyy | acctstat $1 | bonusano 5 | migratdt $11
| @260 smcrite1 $1 | @262 smcrite2 $1 | @264 smcrite3 $1 | @266 smcrite4 $1 | @268 smcrite5 $1 | @270 smcrite6 $1
| @272 factor1 $1 | @274 factor2 $1 | @276 factor3 $1 | @278 factor4 $1 | @280 factor5 $1 | @282 factor6 $1 | @284 factor7 $1
| @286 acctind $1 | @288 sm_status $1 | @290 sm_date ddMMyyyy | @299 odstatus $2 | @302 crr1 $7 | rmsbba z15 | next_review ddMMyyyy | curcode $3
| issue ddMMyyyy | intrate 5 | rebate z16 | spaamt z16 | typeprc $2 | @400 crrtotsc 4 | @410 caccrsck $30 | @450 cadchqck $30 | @490 cadcheqs $3
| @495 caccris $3 | @500 legalacc $3 | @505 legalbor $3 | @509 faccode 5 | @515 review_done $8 | @524 histbal z17 | @542 oriwodate 8 | @551 lastmdate 8
| @559 oricode 3 | @563 cmmaturdt $8 | sectfiss $4 | custfiss $2 | @578 user5 $1 | @580 borstat $1 | @582 rrpaycnt z4 | @590 crrini $5 | @596 crrnow $5
| @602 pzipcode 9 | @612 dnbfisme $1 | @614 floodind $1 | @616 cashprice 17.2 | @634 accrual1 15.7 | @650 cyc z3 | foreclosed_on yyyyMMdd
| completed_on yyyyMMdd | delqcd $2 | @672 utilise $1 | rrtag $6 | masmatdt $8 | rsn $1 | oldrracc $1 | @690 staffno 11 | @702 relief_start yyyyMMdd
| @711 relief_end yyyyMMdd | @720 ia_lru $1 | totamt z15 | netproc z15 | curbal z15 | commno_old 3 | oldrr $1 | riskcode $1 | exceeded ddMMyyyy
| issued ddMMyyyy | @788 fdb $1 | @790 rejected yyyyMMdd | @799 reason $294 | @1094 stp $1 | @1096 frtdiscode $3 | @1100 lstdiscode $3 | @1103 flag1 $1
| full_release ddMMyyyy | lmtindex 5 | odplan 5 | unuseamt 16 | corgamt 16 | strupco_3yr $5 | @1160 dsr 6.2 | refin_flg $3 | old_fi_cd $10
| old_macc_no $30 | old_subacc_no $30 | refin_amt 20.2 | @1260 ln_utilise_locat_cd $5 | @1266 akpk_status $9 | @1276 industrial_sector_cd $5
| @1282 rr_start yyyyMMdd | @1291 rr_complete yyyyMMdd | @1300 climate_class $5 | lu_add1 $40 | lu_add2 $40 | lu_add3 $40 | lu_add4 $40
| lu_town_city $20 | lu_postcode $5 | lu_state_cd $2 | lu_country_cd $2 | lu_source $5""")

CREDIT_POSITION = parse_layout(f"""{_NOTE} report ddMMyyyy | outstand z16 | arrears z3 | instalm z3 | undrawn z17 | acctstat $1 | nodays z5 | oldbrh 5 | biltot z17
| odxsamt z17 | costctr 4 | aano $13 | facility 5 | compliby $60 | complied yyyyMMdd | compligr $15 | eir_adj z16 | paidind $1 | lsttrncd z3 | disburse z15
| repaid z15 | @321 curbal z17 | interdue z17 | feeamt z17 | @373 faccode 5 | ntint $1 | wostat $1 | loanstat 1 | payamt 17.2 | impaired_on yyyyMMdd
| @407 hcurbal 15.2 | @423 xnodays z5 | @429 assessed_on yyyy | @434 assessed_on MM | @437 assessed_on dd | ccris_instlamt 17.2 | mtd_tawidh_amt 17.2
| mtd_gharamah_amt 17.2 | repaysrc $4 | @496 repay_type_cd $2 | mtd_repaid_amt 17.2 | man_rev_rate 9.6 | @525 man_rev_date $8 | sys_rev_rate 9.6
| @543 sys_rev_date $8 | @553 nurs_tag $6 | nurs_tagdt yyyyMMdd | lmo_tag $2 | ratag $10 | ratag_date ddMMyyyy | wrioff_tag $1 | wrioff_date ddMMyyyy
| @596 fwrite_down_bal z15""")

PROVISION = parse_layout(f"""{_NOTE} report ddMMyyyy | classifi $1 | arrears z3 | curbal z17 | interdue z17 | feeamt z16
| {' | '.join(f'{a} z17' for a in 'realisab iisopbal totiis totiisr totwof iisdanah iistrans spopbal spcharge spwbamt spwof spdanah sptrans'.split())}
| gp3ind $1 | oldbrh 5 | costctr 5 | aano $13 | facility 5 | nplind $1 | faccode 5
| @392 {' | '.join(f'{a} z17' for a in 'ledgbal cumrc bdr cumsc woamt bdr_mth sc_mth rc_mth nai_mth cumwosp cumwois cumnai'.split())} | impaired $1""")

LEGAL_ACTION = parse_layout(f"{_HEAD} | @43 delqcd $2 | report ddMMyyyy | oldbrh 5 | costctr 4 | aano $13 | facility 5 | faccode 5")


def repayment(kind: str) -> list[Out]:
    """The repayment file's record of one kind of repayment."""
    return parse_layout(f"branch 4 | @6 acctno z11 | @19 report ddMMyyyy | @28 '1200' | @33 '{kind}' | @36 mtd_repay_type{kind}_amt 16.2 | @53 mtd_repaid_amt 16.2")


SETTLED_OVERDRAFT = parse_layout(f"""{_NOTE} report ddMMyyyy | outstand z16 | arrears z3 | instalm z3 | undrawn z17 | acctstat $1 | nodays z5 | oldbrh 5 | biltot z17
| odxsamt z17 | costctr 4 | aano $13 | facility 5 | faccode 5 | disburse z15 | repaid z15""")

ACCOUNT = parse_layout(f"""{_HEAD} | @43 curcode $3 | limtcurr z24 | limtcurr z16 | issue ddMMyyyy | oldbrh z5 | lmtamt z16 | liabcode $2 | costctr 4 | aano $13
| apprlmaa 15 | aadate yyyyMMdd | reconame $60 | reftype $70 | nmref1 $60 | nmref2 $60 | apvnme1 $60 | apvnme2 $60 | facility 5 | newic $20 | apprxsc z15
| @570 apvby $5 | @576 fxrate z8 | @585 faccode 5 | @592 desgreco $30 | @622 mniaplmt z16 | mniapdt z8 | @647 oribrh 3 | preacct 10 | acct_aano $13
| acct_lntype 9 | acct_lnterm 10 | acct_outbal z16 | acct_aplmt z16 | acct_approved ddMMyyyy | acct_reviewed ddMMyyyy | acct_disbursed ddMMyyyy
| acct_settled ddMMyyyy | acct_expires ddMMyyyy | authorise_limit z16 | operlimt z16""")

REPAYMENT_KINDS = ["10", "20", "30"]
ROW_FILES = [SUB_ACCOUNT, CREDIT_POSITION, PROVISION, LEGAL_ACTION, *[repayment(k) for k in REPAYMENT_KINDS]]
_TYPES = {"text": T.StringType(), "num": T.LongType(), "zero": T.DecimalType(24, 0), "day": T.DateType()}


def layout_schema(*layouts: list[Out]) -> T.StructType:
    """The columns that the layouts read, with their types (the first layout that names a column settles it)."""
    fields: dict[str, T.DataType] = {}
    for f in (f for layout in layouts for f in layout if f.kind != "constant"):
        fields.setdefault(f.name, T.DecimalType(24, f.decimals) if f.kind == "dec" else _TYPES[f.kind])
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])
