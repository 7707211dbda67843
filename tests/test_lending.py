"""Lending rules against a plain Python reading of them."""

from datetime import date
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import lending
from tidemark.schemas import SILVER_RULES, raw_columns


@pytest.fixture(scope="module")
def ids(spark):
    return spark.range(1, 1801).withColumn("dt", F.lit("2024-01-31").cast("date"))


def half_up(value, places="0.01"):
    return float(Decimal(repr(value)).quantize(Decimal(places), ROUND_HALF_UP))


def add_months(day, months):
    month = day.month - 1 + months
    year, month = day.year + month // 12, month % 12 + 1
    last = [31, 29 if year % 4 == 0 and (year % 100 or year % 400 == 0) else 28, 31, 30, 31, 30,
            31, 31, 30, 31, 30, 31][month - 1]
    return date(year, month, min(day.day, last))


def test_layouts_are_complete(ids):
    accounts = lending.accounts(ids)
    loans = lending.loans(accounts)
    installments = lending.installments(loans)
    ledger = lending.ledger(lending.disbursements(loans))
    frames = {
        "t_Client": lending.clients(ids, "2024-03-01"),
        "t_AccountCustomer": accounts,
        "t_Loan": loans,
        "t_LoanInstallment": installments,
        "t_AccountTrx": ledger,
    }
    for name, df in frames.items():
        assert lending.layout(df, name).columns == raw_columns(name)
    assert sum(len(r) for r in SILVER_RULES.values()) == 89


def test_loan_amounts(ids):
    loans = lending.loans(lending.accounts(ids))
    for r in loans.where("LoanSeries = 1").select("id", *raw_columns("t_Loan")).collect():
        n = r.id
        sanction = half_up(10 ** (4 + (n % 100) / 20))
        rate = half_up(8 + (n % 120) / 10)
        tenure = n % 360 + 12
        assert (r.SanctionAmount, r.InterestRate, r.Tenure) == (sanction, rate, tenure)
        assert r.MaturityDate == add_months(date(2024, 1, 31), tenure)
        assert r.InterestAmount == half_up(sanction * rate / 100 * tenure / 12)
        assert r.DisbursementAmount == half_up(sanction * 0.95)


def test_installment_amounts(ids):
    loans = lending.loans(lending.accounts(ids))
    first = lending.installments(loans, 36).where("InstallmentNo = 1 and LoanSeries = 1")
    for r in first.select("id", "PrincipalDue", "InterestDue", "InstallmentAmount").collect():
        sanction, n = half_up(10 ** (4 + (r.id % 100) / 20)), min(36, r.id % 360 + 12)
        assert r.PrincipalDue == half_up(sanction / n)
        assert r.InterestDue == half_up(sanction * half_up(8 + (r.id % 120) / 10) / 100 / 12)
        assert r.InstallmentAmount == half_up(r.PrincipalDue + r.InterestDue)


def test_account_ids_stay_unique(spark):
    ids = spark.range(1, 20001).withColumn("dt", F.lit("2024-02-01").cast("date"))
    accounts = lending.accounts(ids)
    assert accounts.count() == 30000 == accounts.select("AccountID").distinct().count()
    loans = lending.loans(accounts)
    assert loans.count() == loans.select("LoanID").distinct().count()


def test_schedule_dates_and_shares(ids):
    loans = lending.loans(lending.accounts(ids.where("id = 29")))
    rows = lending.installments(loans, 36).orderBy("InstallmentNo").collect()
    assert len(rows) == 36
    assert lending.installments(loans).count() == 29 % 360 + 12
    assert [r.InstallmentDate for r in rows[:3]] == [
        date(2024, 2, 29), date(2024, 3, 31), date(2024, 4, 30)
    ]
    amount = loans.first().SanctionAmount
    assert rows[0].PrincipalDue == half_up(amount / 36)
    assert all(r.PaidStatus == "PENDING" and r.TransactionDate is None for r in rows)


def test_due_lookup_equals_filtering_the_schedule(ids, rows):
    terms = lending.loan_terms_of(
        lending.loans(lending.accounts(ids)).withColumn(
            "DisbursementDate", F.date_add("dt", (F.col("id") % 60).cast("int"))
        )
    )
    for day in ("2024-02-29", "2024-03-31", "2025-02-28", "2027-03-30", "2024-01-31"):
        fast = rows(lending.installment_due_on(terms, day), "LoanID", "k")
        slow = rows(lending.schedule(terms).where(F.col("due_date") == day), "LoanID", "k")
        assert fast == slow


def test_due_scan_bounds_are_harmless(ids, rows):
    landed = lending.installments(
        lending.loans(
            lending.accounts(ids.withColumn("dt", F.date_add("dt", (F.col("id") % 700).cast("int"))))
        )
    )
    for day in ("2024-02-29", "2025-03-31", "2026-02-28"):
        bounded = rows(lending.due_installments(landed, day), "LoanID", "InstallmentNo")
        plain = rows(landed.where(F.col("InstallmentDate") == day), "LoanID", "InstallmentNo")
        assert bounded == plain and plain


def test_installment_48_of_a_long_loan_is_found(spark, rows):
    ids = spark.createDataFrame([(48, date(2020, 1, 15))], "id bigint, dt date")
    loans = lending.loans(lending.accounts(ids))
    assert loans.first().Tenure == 60
    for most in (None, 48, 60):
        landed = lending.installments(loans, most)
        due = lending.due_installments(landed, "2024-01-15", most)
        assert {r.InstallmentNo for r in due.collect()} == {48}
        assert lending.installment_due_on(
            lending.loan_terms_of(loans, most), "2024-01-15"
        ).select("k").distinct().first().k == 48
    assert lending.due_installments(lending.installments(loans, 36), "2024-01-15", 36).isEmpty()


def test_settled_schedule_adds_up(ids):
    terms = lending.loan_terms_of(lending.loans(lending.accounts(ids)))
    per_loan = lending.schedule(terms, settle_remainder=True).groupBy("LoanID", "amount_cents").agg(
        F.sum("principal_due").alias("s")
    )
    assert per_loan.where("s <> amount_cents").count() == 0


def test_repaid_share(ids):
    due = lending.installments(lending.loans(lending.accounts(ids)))
    share = lending.repayments(due).count() / due.count()
    assert 0.78 < share < 0.82


def test_transactions_keep_their_id_when_the_account_is_damaged(ids):
    from tidemark.operators import defects

    ledger = lending.ledger(lending.disbursements(lending.loans(lending.accounts(ids))))
    cut = defects.truncate(ledger, "AccountID", ["TrxID"], rate=1.0)
    assert cut.join(ledger, "TrxID", "left_anti").count() == 0
    assert cut.where(F.length("AccountID") >= 10).count() == 0


def test_position_of_a_paid_and_an_unpaid_loan(spark):
    loans = spark.createDataFrame(
        [(1, 1200.0, 12.0, 12, date(2024, 1, 31)), (2, 1200.0, 12.0, 12, date(2024, 1, 31))],
        "loan int, a double, r double, t int, d date",
    )
    terms = lending.installment_terms(loans, F.col("a"), F.col("r"), F.col("t"), F.col("d"))
    payments = spark.createDataFrame(
        [(1, date(2024, 2, 1), 22400), (1, date(2025, 1, 1), 10**9)],
        "loan int, value_date date, paid_cents bigint",
    )
    got = {r.loan: r for r in lending.loan_position(terms, payments, "2024-05-10").collect()}
    assert (got[1].settled, got[1].dpd) == (2, 10)  # third falls due 2024-04-30
    assert (got[2].settled, got[2].dpd) == (0, 71)  # first fell due 2024-02-29
    assert got[1].outstanding_principal == 100000 and got[2].outstanding_principal == 120000
