"""Fan-out, loan terms, schedules and ledgers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import keys, terms
from tidemark.functions.money import cents
from tidemark.functions.terms import FEED_INSTALLMENTS
from tidemark.operators import lending
from tidemark.plans import inputs
from tidemark.plans.inputs import sampled, table, with_sql
from tidemark.plans.registry import query

DUE_DAY = "2024-05-15"
AS_OF = "1999-01-01"
SAMPLE_RATE = 0.05


@query(
    """
SELECT l_orderkey, l_linenumber, 'TRX' || substr(upper(md5(concat_ws('|',
  CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR),
  CAST(l_suppkey AS VARCHAR), CAST(CAST(l_shipdate AS DATE) AS VARCHAR)))), 1, 14) AS trx_id
FROM lineitem"""
)
def hash_txn_id(spark, sf_dir):
    """A transaction id from the content of the row."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        keys.hash_key(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", inputs.day("l_shipdate"),
            prefix="TRX", digits=14,
        ).alias("trx_id"),
    )


@query(
    f"""SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE {sampled(SAMPLE_RATE, "sample", "l_orderkey", "l_linenumber", "l_partkey")}"""
)
def hash_sample(spark, sf_dir):
    """A repeatable Bernoulli sample without replacement."""
    key = ["l_orderkey", "l_linenumber", "l_partkey"]
    return (
        table(spark, sf_dir, "lineitem")
        .select(*key)
        .where(keys.in_hash_sample(SAMPLE_RATE, *key, salt="sample"))
    )


@query(
    """
SELECT o_orderkey, ['NEFT', 'RTGS', 'IMPS', 'CASH', 'CHEQUE', 'UPI', 'DD'][o_orderkey % 7 + 1]
  AS mode, 'USER' || lpad(CAST(o_orderkey % 100 + 1 AS VARCHAR), 4, '0') AS user_code
FROM orders"""
)
def pick_by_modulus(spark, sf_dir):
    """An element of a constant list by the number of the row."""
    number = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        keys.pick(terms.PAYMENT_MODES, number).alias("mode"),
        terms.user_code(number).alias("user_code"),
    )


@query(
    """
SELECT lpad(CAST(s_suppkey % 50 + 1 AS VARCHAR), 4, '0') AS branch, count(*) AS suppliers,
  min(s_suppkey) AS first_key, max(s_suppkey) AS last_key
FROM supplier GROUP BY 1"""
)
def branch_code(spark, sf_dir):
    """Suppliers per four-digit branch code."""
    number = F.col("s_suppkey")
    return (
        table(spark, sf_dir, "supplier")
        .groupBy(keys.branch_code(number).alias("branch"))
        .agg(
            F.count(F.lit(1)).alias("suppliers"),
            F.min(number).alias("first_key"),
            F.max(number).alias("last_key"),
        )
    )


@query(
    with_sql(inputs.IDS_SQL, inputs.CLIENTS_SQL)
    + """SELECT "OurBranchID", "ClientID", "ClientName", "ClientType", CAST("DOB" AS VARCHAR)
  AS "DOB", "IsActive", "State", "Country", "CreatedAt", "CreatedBy", "LastUpdatedAt"
FROM clients"""
)
def client_rows(spark, sf_dir):
    """The client table in its landed layout."""
    clients = lending.clients(inputs.client_ids(spark, sf_dir), inputs.TODAY)
    return lending.layout(clients, "t_Client")


@query(
    with_sql(inputs.IDS_SQL, inputs.accounts_sql())
    + """SELECT "OurBranchID", "ClientID", "AccountID", "ProductID", "AccountType",
  balance_cents / 100.0 AS "ClearBalance", freeze_cents / 100.0 AS "FreezeAmount",
  "AccountStatus", "CreatedAt", "CreatedBy", "LastUpdatedAt" FROM accounts"""
)
def account_fanout(spark, sf_dir):
    """One or two accounts per client."""
    return lending.layout(inputs.accounts_of_clients(spark, sf_dir), "t_AccountCustomer")


@query(
    with_sql(*inputs.loans_sql())
    + """SELECT "OurBranchID", "AccountID", "LoanSeries", "LoanID", CAST(dt AS VARCHAR) AS dt
FROM loans"""
)
def loan_fanout(spark, sf_dir):
    """One or two loan series per account with a content-derived id."""
    loans = inputs.loans_of_clients(spark, sf_dir)
    return loans.select("OurBranchID", "AccountID", "LoanSeries", "LoanID", "dt")


@query(
    with_sql(*inputs.loans_sql())
    + """SELECT "LoanID", sanction AS sanction_cents, disbursed AS disbursed_cents,
  interest AS interest_cents, tenths AS rate_tenths, "Tenure", "LoanStatus", "Frequency",
  "RepaymentType", "FundID", CAST("MaturityDate" AS VARCHAR) AS "MaturityDate"
FROM loans"""
)
def loan_terms(spark, sf_dir):
    """Amounts, rate, tenure, status and maturity of every loan."""
    loans = inputs.loans_of_clients(spark, sf_dir)
    return loans.select(
        "LoanID",
        cents(F.col("SanctionAmount")).alias("sanction_cents"),
        cents(F.col("DisbursementAmount")).alias("disbursed_cents"),
        cents(F.col("InterestAmount")).alias("interest_cents"),
        F.round(F.col("InterestRate") * 10).cast("bigint").alias("rate_tenths"),
        "Tenure", "LoanStatus", "Frequency", "RepaymentType", "FundID", "MaturityDate",
    )


@query(
    """
SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'CORPORATE' WHEN o_orderkey % 5 = 0 THEN 'SME'
    ELSE 'INDIVIDUAL' END AS client_type,
  CASE WHEN o_orderkey % 50 = 0 THEN 'CLOSED' WHEN o_orderkey % 25 = 0 THEN 'DORMANT'
    WHEN o_orderkey % 15 = 0 THEN 'FROZEN' ELSE 'ACTIVE' END AS account_status,
  CASE WHEN o_orderkey % 100 < 60 THEN 'ACTIVE' WHEN o_orderkey % 100 < 80 THEN 'CLOSED'
    WHEN o_orderkey % 100 < 90 THEN 'NPA' WHEN o_orderkey % 100 < 95 THEN 'WRITTEN_OFF'
    ELSE 'RESTRUCTURED' END AS loan_status,
  count(*) AS records
FROM orders GROUP BY 1, 2, 3"""
)
def segment_bands(spark, sf_dir):
    """Orders per client type, account status and loan status; the first rule that fits wins."""
    number = F.col("o_orderkey")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(
            terms.client_type(number).alias("client_type"),
            terms.account_status(number).alias("account_status"),
            terms.loan_status(number).alias("loan_status"),
        )
        .agg(F.count(F.lit(1)).alias("records"))
    )


@query(
    with_sql(inputs.ORDER_TERMS_SQL)
    + """SELECT loan, k, CAST(due_date AS VARCHAR) AS due_date, p AS principal_due,
  i AS interest_due FROM schedule"""
)
def amortisation_schedule(spark, sf_dir):
    """Every installment of every loan: equal rounded shares."""
    loans = inputs.spread(inputs.order_loans(spark, sf_dir), F.col("n"))
    return lending.schedule(loans).select(
        "loan", "k", "due_date", "principal_due", "interest_due"
    )


@query(
    with_sql(inputs.FULL_TERMS_SQL)
    + """SELECT loan, k, CAST(due_date AS VARCHAR) AS due_date, p AS principal_due,
  i AS interest_due FROM schedule"""
)
def full_tenure_schedule(spark, sf_dir):
    """Every installment over the whole tenure, up to 371 months."""
    loans = inputs.spread(inputs.order_loans(spark, sf_dir, max_installments=None), F.col("n"))
    return lending.schedule(loans).select(
        "loan", "k", "due_date", "principal_due", "interest_due"
    )


@query(
    with_sql(inputs.ORDER_TERMS_SQL)
    + """SELECT loan, count(*) AS installments, CAST(sum(CASE WHEN k = n
    THEN amount_cents - p * (n - 1) ELSE p END) AS BIGINT) AS principal_cents,
  CAST(max(CASE WHEN k = n THEN amount_cents - p * (n - 1) END) AS BIGINT) AS last_share,
  CAST(max(due_date) AS VARCHAR) AS last_due
FROM schedule GROUP BY loan"""
)
def settled_schedule(spark, sf_dir):
    """Schedules whose last installment takes the rounding remainder, summed per loan."""
    loans = inputs.spread(inputs.order_loans(spark, sf_dir), F.col("n"))
    shares = lending.schedule(loans, settle_remainder=True)
    return shares.groupBy("loan").agg(
        F.count(F.lit(1)).alias("installments"),
        F.sum("principal_due").alias("principal_cents"),
        F.max(F.when(F.col("k") == F.col("n"), F.col("principal_due"))).alias("last_share"),
        F.max("due_date").alias("last_due"),
    )


@query(
    with_sql(inputs.ORDER_TERMS_SQL)
    + f"""SELECT loan, k, p AS principal_due, i AS interest_due FROM schedule
WHERE due_date = DATE '{AS_OF}'"""
)
def due_on_date(spark, sf_dir):
    """Installments due on one day, found without exploding the schedules."""
    due = lending.installment_due_on(inputs.order_loans(spark, sf_dir), AS_OF)
    return due.select("loan", "k", "principal_due", "interest_due")


_LEDGER_COLUMNS = """ "TrxID", "AccountID", "LoanID", "LoanSeries", "TrxType", "DrCr",
  amount AS amount_cents, CAST(moved_at AS VARCHAR) AS "TrxDateTime",
  CAST("ValueDate" AS VARCHAR) AS "ValueDate", principal AS principal_cents,
  interest_part AS interest_cents FROM ledger"""
_LEDGER_VIEWS = [*inputs.loans_sql(), inputs.INSTALLMENTS_SQL]
_ON_DAY = f"\"InstallmentDate\" = DATE '{DUE_DAY}'"


def _ledger_columns(df):
    return df.select(
        "TrxID", "AccountID", "LoanID", "LoanSeries", "TrxType", "DrCr",
        cents(F.col("Amount")).alias("amount_cents"), "TrxDateTime", "ValueDate",
        cents(F.col("PrincipalComponent")).alias("principal_cents"),
        cents(F.col("InterestComponent")).alias("interest_cents"),
    )


@query(
    with_sql(*_LEDGER_VIEWS, inputs.ledger_sql("FALSE"))
    + f"SELECT {_LEDGER_COLUMNS} WHERE \"ValueDate\" = DATE '2024-02-15'"
)
def disbursements(spark, sf_dir):
    """Credits of the loans disbursed on one business date."""
    loans = inputs.loans_of_clients(spark, sf_dir)
    return _ledger_columns(lending.ledger(lending.disbursements(loans, "2024-02-15")))


def _due(spark, sf_dir, on):
    """The installments due on a day, in the landed layout, straight from the loans."""
    loans = inputs.loans_of_clients(spark, sf_dir)
    due = lending.installment_due_on(lending.loan_terms_of(loans, FEED_INSTALLMENTS), on)
    return due.select(
        "OurBranchID", "AccountID", "LoanSeries", "LoanID",
        F.col("k").alias("InstallmentNo"),
        F.col("due_date").alias("InstallmentDate"),
        (F.col("p") / 100.0).alias("PrincipalDue"),
        (F.col("i") / 100.0).alias("InterestDue"),
        ((F.col("p") + F.col("i")) / 100.0).alias("InstallmentAmount"),
    )


@query(
    with_sql(*_LEDGER_VIEWS, inputs.ledger_sql(_ON_DAY))
    + f"SELECT {_LEDGER_COLUMNS} WHERE \"TrxType\" = 'REPAYMENT'"
)
def repayments(spark, sf_dir):
    """Debits for four fifths of the installments due on one day."""
    return _ledger_columns(lending.ledger(lending.repayments(_due(spark, sf_dir, DUE_DAY))))


@query(with_sql(*_LEDGER_VIEWS, inputs.ledger_sql("TRUE")) + f"SELECT {_LEDGER_COLUMNS}")
def ledger_union(spark, sf_dir):
    """All disbursements and repayments of all days with content-derived ids."""
    loans = inputs.loans_of_clients(spark, sf_dir)
    return _ledger_columns(
        lending.ledger(
            lending.disbursements(loans), lending.repayments(lending.installments(loans, FEED_INSTALLMENTS))
        )
    )


@query(
    with_sql(inputs.PAYMENTS_SQL)
    + """SELECT loan, CAST(value_date AS VARCHAR) AS value_date, paid_cents,
  CAST(sum(paid_cents) OVER (PARTITION BY loan ORDER BY value_date) AS BIGINT) AS paid_so_far,
  CAST(greatest(amount_cents - sum(paid_cents) OVER (PARTITION BY loan ORDER BY value_date), 0)
    AS BIGINT) AS outstanding
FROM (SELECT loan, value_date, CAST(sum(paid_cents) AS BIGINT) AS paid_cents
      FROM payments GROUP BY loan, value_date)
JOIN (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS amount_cents FROM orders)
  ON loan = o_orderkey"""
)
def running_outstanding(spark, sf_dir):
    """What is left of a loan after each day it was paid."""
    opening = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("loan"), cents(F.col("o_totalprice")).alias("amount_cents")
    )
    balance = lending.running_balance(opening, inputs.line_payments(spark, sf_dir))
    return balance.select("loan", "value_date", "paid_cents", "paid_so_far", "outstanding")


# Brute force: every installment against the running total of what was due.
_POSITION_SQL = f"""paid AS (
  SELECT loan AS paid_loan, sum(paid_cents) AS paid FROM payments
  WHERE value_date <= DATE '{AS_OF}' GROUP BY loan),
covered AS (
  SELECT s.*, coalesce(paid, 0) AS paid,
    sum(p + i) OVER (PARTITION BY loan ORDER BY k) AS due_through
  FROM schedule s LEFT JOIN paid ON loan = paid_loan)"""


@query(
    with_sql(inputs.ORDER_TERMS_SQL, inputs.PAYMENTS_SQL, _POSITION_SQL)
    + f"""SELECT loan, count(*) FILTER (WHERE due_through <= paid) AS settled,
  coalesce(greatest(date_diff('day', min(CASE WHEN due_through > paid THEN due_date END),
    DATE '{AS_OF}'), 0), 0) AS dpd,
  CAST(coalesce(sum(CASE WHEN due_through > paid THEN p END), 0) AS BIGINT)
    AS outstanding_principal,
  CAST(coalesce(sum(CASE WHEN due_through > paid THEN i END), 0) AS BIGINT)
    AS outstanding_interest
FROM covered GROUP BY loan"""
)
def dpd_as_of(spark, sf_dir):
    """Days past due and outstanding amounts of every loan on a date."""
    position = lending.loan_position(
        inputs.order_loans(spark, sf_dir), inputs.line_payments(spark, sf_dir), AS_OF
    )
    return position.select(
        "loan",
        F.col("settled").cast("bigint").alias("settled"),
        F.col("dpd").cast("bigint").alias("dpd"),
        "outstanding_principal",
        "outstanding_interest",
    )


@query(
    with_sql(inputs.ORDER_TERMS_SQL, inputs.PAYMENTS_SQL, _POSITION_SQL)
    + f"""SELECT loan, k, CASE WHEN paid >= due_through THEN 'PAID'
    WHEN due_date < DATE '{AS_OF}' THEN 'OVERDUE'
    WHEN paid > due_through - (p + i) THEN 'PARTIAL' ELSE 'PENDING' END AS paid_status
FROM covered"""
)
def installment_status(spark, sf_dir):
    """Paid status of every installment on a date."""
    status = lending.installment_status(
        inputs.order_loans(spark, sf_dir), inputs.line_payments(spark, sf_dir), AS_OF
    )
    return status.select("loan", "k", "paid_status")
