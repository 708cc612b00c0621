"""Shared helpers for the registered queries (re-aiming notes in README)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed report date used by period-driven queries on the supplied tables: the
# orders span 1995-01-01 .. 2001-08-01, lines ship until 2001-11.
REPORT_DATE = "1998-08-15"


def money_sum(c, alias: str) -> Column:
    """Sum money as decimal(18,2) (order-independent), return as double."""
    col = F.col(c) if isinstance(c, str) else c
    return F.sum(col.cast("decimal(18,2)")).cast("double").alias(alias)


def money(c, alias: str | None = None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    out = col.cast("decimal(18,2)").cast("double")
    return out.alias(alias) if alias else out


def as_date(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("date")


def rdate() -> Column:
    return F.lit(REPORT_DATE).cast("date")


MSUM = "CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


def msum(x: str, alias: str) -> str:
    return MSUM.format(x=x) + f" AS {alias}"


# Expected class code -> collateral category, written out for the SQL twins (fixed values,
# by code; independent of the table that the library looks them up in)
COLLATERAL_PAIRS = """
('000','70'), ('001','29'), ('002','90'), ('003','90'), ('004','30'), ('005','30'), ('006','29'), ('007','29'), ('008','21'),
('009','00'), ('010','50'), ('011','70'), ('012','70'), ('013','70'), ('014','29'), ('015','23'), ('016','29'), ('017','70'),
('018','70'), ('019','70'), ('020','80'), ('021','70'), ('022','00'), ('023','00'), ('024','29'), ('025','29'), ('026','29'),
('027','70'), ('028','70'), ('029','70'), ('030','70'), ('031','70'), ('032','10'), ('033','10'), ('034','10'), ('035','10'),
('036','10'), ('037','10'), ('038','10'), ('039','10'), ('040','10'), ('041','90'), ('042','90'), ('043','90'), ('044','10'),
('045','22'), ('046','29'), ('047','22'), ('048','29'), ('049','29'), ('050','10'), ('051','10'), ('052','10'), ('053','10'),
('054','10'), ('055','10'), ('056','10'), ('057','10'), ('058','90'), ('059','90'), ('060','10'), ('061','10'), ('062','10'),
('063','60'), ('064','60'), ('065','40'), ('066','40'), ('067','90'), ('068','90'), ('069','90'), ('070','90'), ('071','90'),
('072','90'), ('073','60'), ('074','60'), ('075','40'), ('076','40'), ('077','99'), ('078','90'), ('079','90'), ('080','60'),
('081','60'), ('082','40'), ('083','40'), ('084','90'), ('085','50'), ('086','50'), ('087','50'), ('088','50'), ('089','50'),
('090','50'), ('091','50'), ('092','50'), ('093','40'), ('094','40'), ('095','40'), ('096','40'), ('097','40'), ('098','40'),
('101','40'), ('102','40'), ('103','40'), ('104','40'), ('105','70'), ('106','70'), ('107','90'), ('108','81'), ('109','81'),
('111','50'), ('112','29'), ('113','29'), ('114','29'), ('115','29'), ('116','29'), ('117','29'), ('118','10'), ('119','10'),
('121','10'), ('122','10'), ('123','90'), ('124','70'), ('125','50'), ('126','50'), ('127','30'), ('128','30'), ('129','30'),
('131','40'), ('132','40'), ('133','40'), ('134','40'), ('135','40'), ('136','40'), ('137','40'), ('138','40'), ('139','40'),
('141','40'), ('142','30'), ('143','30'), ('144','50'), ('149','29')
"""
