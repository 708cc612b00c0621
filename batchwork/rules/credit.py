"""Credit rules on limits, balances and arrears."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.clean import arrears_months, instalments_due, lt_missing, row_sum

# Products held in foreign currency; the facility of staff loans; loan types
# that release their net proceeds; loan types that release the amount in use.
FOREIGN_PRODUCTS = ["MCF", "MFL", "MOF"]
STAFF_FACILITY = 34371
NET_PROCEEDS_TYPES = [128, 130, 131, 132, 380, 381, 700, 705, 720, 725, 750, 752, 760]
IN_USE_TYPES = [146, 184, 302, 350, 351, 364, 365, 506, 902, 903, 910, 925, 951, 604, 605, 634, 660, 685]
# risk rating -> class (fixed values)
RISK_CLASSES = {"": "P", "1": "C", "2": "S", "3": "D", "4": "B"}


def undrawn(limit: Column, balance: Column) -> tuple[Column, Column]:
    """Approved limit repaired, then the undrawn amount.

    A limit below zero — a missing limit counts as below zero (R2) — becomes the
    balance when that is positive, else 0.  Undrawn = limit − balance (R4 sum), and a
    negative (or missing) result is 0.
    """
    lim2 = F.when(lt_missing(limit, 0), F.when(balance > 0, balance).otherwise(F.lit(0))).otherwise(limit)
    und = row_sum(lim2, -balance)
    return lim2, F.when(lt_missing(und, 0), F.lit(0)).otherwise(und)


def undrawn_overdraft(limit: Column, balance: Column) -> Column:
    """D8, overdrafts: the limit less the balance; all of it on a credit balance, nothing beyond the limit."""
    beyond = F.coalesce(balance > limit, limit.isNull() & balance.isNotNull())
    return F.when(beyond, F.lit(0)).when(lt_missing(balance, 0), limit).otherwise(row_sum(limit, -balance))


def undrawn_loan(available: Column, facility: Column, release: Column, balance: Column, limit: Column) -> Column:
    """D8, loans: what is still available; nothing on vehicle facilities unless partly released,
    nothing when fully released; the limit on a credit balance; not below 0."""
    left = F.when(facility.isin(34331, 34332), F.lit(0)).otherwise(F.coalesce(available, F.lit(0)))
    left = F.when(release == "F", F.lit(0)).when(release.isin("P", "I"), F.coalesce(available, F.lit(0))).otherwise(left)
    return F.greatest(F.coalesce(F.when(lt_missing(balance, 0), limit).otherwise(left), F.lit(0)), F.lit(0))


def undrawn_by_use(limit: Column, direct: Column, indirect: Column, has_direct: Column, has_indirect: Column) -> tuple[Column, Column]:
    """H5: what is left of a limit beside its direct use, and beside its indirect use.

    A use that does not occur is missing, one below zero (or missing) counts as 0.  The
    direct figure is missing without direct use; sums skip what is missing (R4).
    """
    def used(x: Column, has: Column) -> Column:
        return F.when(F.coalesce(has, F.lit(False)), F.when(lt_missing(x, 0), F.lit(0)).otherwise(x))
    d, i = used(direct, has_direct), used(indirect, has_indirect)
    return F.when(d.isNotNull(), row_sum(limit, -d, -i)), row_sum(limit, -i)


def risk_class(rating: Column, npl: Column) -> Column:
    """D5, loans: class of a risk rating; a performing flag ``P`` wins."""
    r = F.rtrim(F.coalesce(rating, F.lit("")))
    out = F.lit(None).cast("string")
    for code, cls in RISK_CLASSES.items():
        out = F.when(r == code, F.lit(cls)).otherwise(out)
    return F.when(npl == "P", F.lit("P")).otherwise(out)


def impaired(loan_status: Column, facility: Column, days: Column, borrower_status: Column, user_code: Column) -> Column:
    """D5, loans: status 3 is impaired; staff loans also by days, borrower status or user code."""
    staff = (facility == STAFF_FACILITY) & (F.coalesce(days >= 90, F.lit(False)) | F.coalesce(borrower_status.isin("F", "I", "R"), F.lit(False))
                                            | F.coalesce(user_code == "N", F.lit(False)))
    return F.coalesce(loan_status == 3, F.lit(False)) | F.coalesce(staff, F.lit(False))


def provision_class(days: Column, npl: Column, outstanding: Column, given: Column | None = None) -> tuple[Column, Column]:
    """D5, trade: D from 90 days (or flag F), B beyond 182; flag P, or hardly anything
    outstanding, makes it P.  The impaired flag: 90 days or more, or flag F."""
    f = F.coalesce(npl == "F", F.lit(False))
    cls = F.when(F.coalesce(days.between(90, 182), F.lit(False)) | f, F.lit("D")).when(days > 182, F.lit("B")).otherwise(
        given if given is not None else F.lit(None).cast("string"))
    cls = F.when(npl == "P", F.lit("P")).otherwise(cls)
    cls = F.when(lt_missing(outstanding, 1), F.lit("P")).otherwise(cls)
    return cls, F.coalesce(days >= 90, F.lit(False)) | f


def overdue_overdraft(exceed_date: Column, temporary_date: Column, balance: Column, rept: Column) -> tuple[Column, Column, Column]:
    """D6, overdrafts: days since the earlier of two dates, both ends counted, where the
    account is not in credit; arrears and instalments only for days above 0."""
    since = F.least(exceed_date, temporary_date)
    days = F.when(since.isNotNull() & (balance <= 0), F.datediff(rept, since) + 1)
    return days, F.when(days > 0, arrears_months(days)), F.when(days > 0, instalments_due(days))


def overdue_loan(bill_date: Column, rept: Column, older_days: Column | None = None, note: Column | None = None,
                 given_days: Column | None = None) -> Column:
    """D6, loans: days since the bill date, not below 0; renumbered notes (98000-98999) add
    the days of the note they replace; days given by hand win."""
    days = F.greatest(F.datediff(rept, bill_date), F.lit(0))
    if older_days is not None and note is not None:
        days = F.when((older_days > 0) & note.between(98000, 98999), row_sum(days, older_days)).otherwise(days)
    return F.coalesce(given_days, days) if given_days is not None else days


def interest_receivable(principal: Column, discount: Column, discount_foreign: Column, interest_ytd: Column, rate: Column,
                        product: Column, first_day: Column, issued_this_month: Column, prior: Column) -> Column:
    """Interest receivable of a trade bill.

    Nothing without principal or discount.  Local products: interest of the year less the
    discount (R4 sum).  Foreign products: on the first day of a month the converted interest
    less the discount; a bill issued this month owes its converted discount; else the
    figure of the prior snapshot stays.
    """
    foreign = F.coalesce(product.isin(FOREIGN_PRODUCTS), F.lit(False))
    none = (F.coalesce(principal, F.lit(0)) == 0) | F.coalesce(discount == 0, F.lit(False))
    return (F.when(none, F.lit(0))
             .when(~foreign & (principal > 0), row_sum(interest_ytd, -discount))
             .when(foreign & F.coalesce(issued_this_month, F.lit(False)), -(discount_foreign * rate))
             .when(foreign & F.coalesce(first_day, F.lit(False)), row_sum(interest_ytd * rate, -discount))
             .otherwise(prior))


def release_amount(loan_type: Column, commitment: Column, net_proceeds: Column, granted: Column, available: Column,
                   used: Column, original: Column) -> Column:
    """Amount released, by loan type: net proceeds; under a commitment what is granted
    less what is still available (not below 0), or the amount in use; else the original balance."""
    still = F.when(lt_missing(available, 0), F.lit(0)).otherwise(available)
    return (F.when(loan_type.isin(NET_PROCEEDS_TYPES), net_proceeds)
             .when((commitment > 0) & ~loan_type.isin(IN_USE_TYPES), row_sum(granted, -still))
             .when(commitment > 0, used)
             .otherwise(original))
