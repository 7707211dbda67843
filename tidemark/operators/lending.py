"""Lending dataflows: client -> account -> loan -> schedule -> ledger.

All builders are narrow: they project and explode within a partition, so the
row blow-up (one client, up to four loans, as many installments as months) never
passes through a shuffle.  Input is a frame with ``id bigint`` and ``dt date``,
the numeric client id and the business date of its feed.

Raw amounts are doubles rounded to two places.  They are computed once per
account or loan, before the rows multiply, and are added up in whole cents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import terms
from tidemark.functions.keys import branch_code, hash_key, in_hash_sample, padded, pick
from tidemark.functions.money import amount, cents
from tidemark.schemas import raw_columns

REPAYMENT_RATE = 0.8


def _id() -> Column:
    return F.col("id")


def _dt() -> Column:
    return F.col("dt")


def layout(df: DataFrame, table: str, *extra: str) -> DataFrame:
    """Only the landed columns of ``table``, in order, then ``extra`` ones."""
    return df.select(*raw_columns(table), *extra)


def _audit(number: Column, at: Column) -> list[Column]:
    return [
        at.alias("CreatedAt"),
        terms.user_code(number).alias("CreatedBy"),
        at.alias("LastUpdatedAt"),
    ]


def _day_start() -> Column:
    return _dt().cast("timestamp")


def client_id(number: Column) -> Column:
    return F.concat(F.lit("CL"), padded(number, 10))


def clients(ids: DataFrame, today: str) -> DataFrame:
    """One client per id.  ``today`` (yyyy-MM-dd) anchors the birth dates."""
    return ids.select(
        "id",
        "dt",
        branch_code(_id()).alias("OurBranchID"),
        client_id(_id()).alias("ClientID"),
        terms.client_name(_id()).alias("ClientName"),
        terms.client_type(_id()).alias("ClientType"),
        terms.birth_date(_id(), F.lit(today).cast("date")).alias("DOB"),
        (_id() % 20 != 0).alias("IsActive"),
        pick(terms.STATES, _id()).alias("State"),
        F.lit("IND").alias("Country"),
        *_audit(_id(), _day_start()),
    )


def accounts(
    ids: DataFrame, first_id: int = 1, first_seq: int = 1, seq_width: int = 4
) -> DataFrame:
    """Two accounts for an even client id, one for an odd one.

    The sequence inside AccountID is padded to ``seq_width`` but never cut, so
    two accounts cannot share an id once the numbers outgrow the padding.
    """
    slots = F.explode(F.sequence(F.lit(1), F.when(_id() % 2 == 0, 2).otherwise(1)))
    slot = F.col("slot")
    sequence = (_id() - first_id) * 2 + slot + (first_seq - 1)
    balance = ids.select("id", "dt", terms.balance(_id()).alias("balance"), slots.alias("slot"))
    return balance.select(
        "id",
        "dt",
        "slot",
        branch_code(_id()).alias("OurBranchID"),
        client_id(_id()).alias("ClientID"),
        F.concat(branch_code(_id()), F.lit("LN"), padded(sequence, seq_width)).alias("AccountID"),
        terms.product_code(_id(), slot).alias("ProductID"),
        F.when(slot == 1, "LOAN_PRIMARY").otherwise("LOAN_SECONDARY").alias("AccountType"),
        F.col("balance").alias("ClearBalance"),
        F.round(F.col("balance") * (_id() % 10) / 100, 2).alias("FreezeAmount"),
        terms.account_status(_id()).alias("AccountStatus"),
        *_audit(_id(), _day_start()),
    )


def loans(accounts_df: DataFrame) -> DataFrame:
    """Two loan series per account of a client id divisible by three, else one."""
    series = F.explode(F.sequence(F.lit(1), F.when(_id() % 3 == 0, 2).otherwise(1)))
    based = accounts_df.select(
        "id",
        "dt",
        "OurBranchID",
        "AccountID",
        terms.sanction(_id()).alias("sanction"),
        terms.interest_rate(_id()).alias("rate"),
        terms.tenure_months(_id()).alias("Tenure"),
        series.alias("LoanSeries"),
    )
    sanction = F.col("sanction")
    interest = F.round(sanction * F.col("rate") / 100 * F.col("Tenure") / 12, 2)
    return based.select(
        "id",
        "dt",
        "OurBranchID",
        "AccountID",
        "LoanSeries",
        _dt().alias("SanctionDate"),
        sanction.alias("SanctionAmount"),
        _dt().alias("DisbursementDate"),
        F.round(sanction * terms.DISBURSED_SHARE, 2).alias("DisbursementAmount"),
        terms.loan_status(_id()).alias("LoanStatus"),
        F.col("rate").alias("InterestRate"),
        interest.alias("InterestAmount"),
        "Tenure",
        terms.frequency(_id()).alias("Frequency"),
        terms.repayment_type(_id()).alias("RepaymentType"),
        sanction.alias("OutstandingPrincipal"),
        interest.alias("OutstandingInterest"),
        F.lit(0).alias("DPD"),
        F.lit(False).alias("IsNPS"),
        F.lit(False).alias("ParFlag"),
        terms.fund_code(_id()).alias("FundID"),
        hash_key("OurBranchID", "AccountID", "LoanSeries").alias("LoanID"),
        F.add_months(_dt(), F.col("Tenure")).alias("MaturityDate"),
        *_audit(_id(), _day_start()),
    )


def installment_terms(
    loans_df: DataFrame,
    principal: Column,
    yearly_percent: Column,
    tenure: Column,
    first_day: Column,
    max_installments: int | None = None,
) -> DataFrame:
    """Adds what all installments of a loan share, in cents.

    ``n`` installments (the tenure, or ``max_installments`` at most), the flat principal share ``p`` and
    interest ``i`` of each, and the disbursement day ``d0``.  Computed once per
    loan, before anything is exploded.
    """
    count = tenure if max_installments is None else F.least(F.lit(max_installments), tenure)
    count = count.cast("int")
    return loans_df.withColumns(
        {
            "n": count,
            "amount_cents": cents(principal),
            "d0": first_day.cast("date"),
            "p": cents(F.round(principal / count, 2)),
            "i": cents(F.round(principal * yearly_percent / 100 / 12, 2)),
        }
    )


def schedule(with_terms: DataFrame, settle_remainder: bool = False) -> DataFrame:
    """One row per installment: ``k``, ``due_date``, ``principal_due``, ``interest_due``.

    Due monthly from one month after disbursement, month ends clamped.  With
    ``settle_remainder`` the last installment takes what rounding left over, so
    that the principal parts add up to the loan exactly.
    """
    share = F.col("p")
    if settle_remainder:
        share = F.when(
            F.col("k") == F.col("n"), F.col("amount_cents") - F.col("p") * (F.col("n") - 1)
        ).otherwise(F.col("p"))
    return (
        with_terms.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n"))))
        .withColumns(
            {
                "due_date": F.add_months("d0", F.col("k")),
                "principal_due": share,
                "interest_due": F.col("i"),
            }
        )
    )


def installment_due_on(with_terms: DataFrame, day: str) -> DataFrame:
    """The installment of each loan that falls due on ``day``, without exploding.

    ``add_months(d0, k)`` always lands ``k`` calendar months after ``d0``, so at
    most one ``k`` can match and it follows from the month distance.
    """
    on = F.lit(day).cast("date")
    k = (F.year(on) - F.year("d0")) * 12 + F.month(on) - F.month("d0")
    return (
        with_terms.withColumn("k", k.cast("int"))
        .where((F.col("k") >= 1) & (F.col("k") <= F.col("n")))
        .where(F.add_months("d0", F.col("k")) == on)
        .withColumns(
            {"due_date": on, "principal_due": F.col("p"), "interest_due": F.col("i")}
        )
    )


def loan_terms_of(loans_df: DataFrame, max_installments: int | None = None) -> DataFrame:
    """``installment_terms`` for the loan layout."""
    return installment_terms(
        loans_df,
        F.col("SanctionAmount"),
        F.col("InterestRate"),
        F.col("Tenure"),
        F.col("DisbursementDate"),
        max_installments,
    )


def installments(loans_df: DataFrame, max_installments: int | None = None) -> DataFrame:
    """The schedule of every loan in the landed layout, all still pending."""
    return schedule(loan_terms_of(loans_df, max_installments)).select(
        "id",
        "dt",
        "OurBranchID",
        "AccountID",
        "LoanSeries",
        "LoanID",
        F.col("k").alias("InstallmentNo"),
        F.col("due_date").alias("InstallmentDate"),
        amount(F.col("principal_due")).alias("PrincipalDue"),
        amount(F.col("interest_due")).alias("InterestDue"),
        amount(F.col("principal_due") + F.col("interest_due")).alias("InstallmentAmount"),
        F.lit("PENDING").alias("PaidStatus"),
        F.lit(None).cast("date").alias("TransactionDate"),
        "CreatedAt",
        "CreatedBy",
        "LastUpdatedAt",
    )


def _ledger_rows(
    df: DataFrame,
    kind: str,
    side: str,
    day: Column,
    hour: int,
    total: Column,
    principal: Column,
    interest: Column,
) -> DataFrame:
    # by the wall clock, also on days that a time zone makes shorter or longer
    at = F.make_timestamp(
        F.year(day), F.month(day), F.day(day), F.lit(hour), F.lit(0), F.lit(0)
    )
    checksum = F.crc32(F.col("AccountID"))
    return df.select(
        "OurBranchID",
        "AccountID",
        "LoanID",
        "LoanSeries",
        F.lit(kind).alias("TrxType"),
        F.lit(side).alias("DrCr"),
        total.alias("Amount"),
        at.alias("TrxDateTime"),
        day.alias("ValueDate"),
        principal.alias("PrincipalComponent"),
        interest.alias("InterestComponent"),
        pick(terms.PAYMENT_MODES, checksum).alias("PaymentMode"),
        *_audit(checksum, at),
    )


def disbursements(loans_df: DataFrame, day: str | None = None) -> DataFrame:
    """One credit per loan at 10:00 of its disbursement day; ``day`` keeps that day only."""
    if day is not None:
        loans_df = loans_df.where(F.col("DisbursementDate") == F.lit(day).cast("date"))
    return _ledger_rows(
        loans_df, "DISBURSEMENT", "CR", F.col("DisbursementDate"), 10,
        F.col("DisbursementAmount"), F.lit(0.0), F.lit(0.0),
    )


def due_installments(
    landed: DataFrame, day: str, max_installments: int | None = None
) -> DataFrame:
    """Landed installments due on ``day``.

    The bounds on ``dt`` add nothing to the result but prune the scan: an installment
    falls due after its own ``dt``, and within as many months as the schedule was landed
    with; give that number if there was one.
    """
    on = F.lit(day).cast("date")
    open_from = landed.where(_dt() < on)
    if max_installments is not None:
        open_from = open_from.where(_dt() >= F.add_months(on, -max_installments - 1))
    return open_from.where(F.col("InstallmentDate") == on)


def repayments(due: DataFrame, rate: float = REPAYMENT_RATE) -> DataFrame:
    """A debit at 14:00 for ``rate`` of the due installments; the rest stay unpaid.

    Who pays is decided by a hash of the installment's key, so a retried task
    or another layout repays the same installments.
    """
    paid = due.where(in_hash_sample(rate, "LoanID", "InstallmentNo", salt="repay"))
    return _ledger_rows(
        paid, "REPAYMENT", "DR", F.col("InstallmentDate"), 14,
        F.col("InstallmentAmount"), F.col("PrincipalDue"), F.col("InterestDue"),
    )


def ledger(*parts: DataFrame) -> DataFrame:
    """The union of transaction frames with a content-derived TrxID."""
    combined = parts[0]
    for part in parts[1:]:
        combined = combined.unionByName(part)
    return combined.withColumn(
        "TrxID",
        hash_key(
            "AccountID", "LoanID", "LoanSeries", "TrxType", "TrxDateTime",
            prefix="TRX", digits=14,
        ),
    )


def paid_totals(payments: DataFrame, as_of: str) -> DataFrame:
    """``loan``, ``paid`` cents up to and including ``as_of``; combined map-side.

    ``payments``: ``loan``, ``value_date``, ``paid_cents``.
    """
    return (
        payments.where(F.col("value_date") <= F.lit(as_of).cast("date"))
        .groupBy("loan")
        .agg(F.sum("paid_cents").alias("paid"))
    )


def loan_position(with_terms: DataFrame, payments: DataFrame, as_of: str) -> DataFrame:
    """Days past due, outstanding amounts and status of every loan on a date.

    ``with_terms``: frame of ``installment_terms`` with the loan number in ``loan``.
    Payments settle installments in order, so with equal installments the
    number of settled ones is a division: neither the schedule nor the payment
    history of a loan is ever gathered in one place.
    """
    day = F.lit(as_of).cast("date")
    joined = with_terms.join(paid_totals(payments, as_of), "loan", "left").withColumn(
        "paid", F.coalesce("paid", F.lit(0).cast("bigint"))
    )
    settled = joined.withColumn(
        "settled",
        F.expr("if(p + i > 0, least(cast(n as bigint), paid div (p + i)), cast(n as bigint))")
        .cast("int"),
    )
    next_due = F.add_months("d0", F.col("settled") + 1)
    late = (F.col("settled") < F.col("n")) & (next_due < day)
    return settled.withColumns(
        {
            "dpd": F.when(late, F.datediff(day, next_due)).otherwise(F.lit(0)),
            "outstanding_principal": F.col("p") * (F.col("n") - F.col("settled")),
            "outstanding_interest": F.col("i") * (F.col("n") - F.col("settled")),
        }
    ).withColumn("is_past_due", F.col("dpd") > 0)


def installment_status(with_terms: DataFrame, payments: DataFrame, as_of: str) -> DataFrame:
    """PAID, PARTIAL, OVERDUE or PENDING per installment, payments applied in order."""
    day = F.lit(as_of).cast("date")
    totals = paid_totals(payments, as_of)
    joined = with_terms.join(totals, "loan", "left").withColumn(
        "paid", F.coalesce("paid", F.lit(0).cast("bigint"))
    )
    due_before = (F.col("p") + F.col("i")) * (F.col("k") - 1)
    due_through = (F.col("p") + F.col("i")) * F.col("k")
    return schedule(joined).withColumn(
        "paid_status",
        F.when(F.col("paid") >= due_through, "PAID")
        .when(F.col("due_date") < day, "OVERDUE")
        .when(F.col("paid") > due_before, "PARTIAL")
        .otherwise("PENDING"),
    )


def running_balance(opening: DataFrame, payments: DataFrame) -> DataFrame:
    """Outstanding amount after each payment date of a loan.

    ``opening``: ``loan``, ``amount_cents``.  Payments are summed to one row per
    loan and date first, so that the window of a loan never holds more rows
    than the calendar has days, however often that loan was paid.
    """
    daily = payments.groupBy("loan", "value_date").agg(F.sum("paid_cents").alias("paid_cents"))
    so_far = Window.partitionBy("loan").orderBy("value_date").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    running = daily.withColumn("paid_so_far", F.sum("paid_cents").over(so_far))
    return running.join(opening, "loan").withColumn(
        "outstanding", F.greatest(F.col("amount_cents") - F.col("paid_so_far"), F.lit(0))
    )
