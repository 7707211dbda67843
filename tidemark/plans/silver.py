"""Silver tables from column rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.terms import FEED_INSTALLMENTS
from tidemark.operators import defects, lending, quality, silver
from tidemark.operators.dedup import latest_per_key
from tidemark.plans import inputs
from tidemark.plans.inputs import sampled, table, with_sql
from tidemark.plans.registry import query
from tidemark.schemas import SILVER_RULES, ColumnRule, natural_key
from tidemark.sources import config

SALT = "pepper"


def _silver(df, name, rare_duplicates=False):
    return silver.silver(df, SILVER_RULES[name], natural_key(name), salt=SALT, rare_duplicates=rare_duplicates)


def _landed(df, name):
    """The landed layout with its partition columns."""
    return lending.layout(df, name, "dt").withColumn("batch", F.lit(1))


def _money(whole_cents: str) -> str:
    return f"CAST(CAST({whole_cents} / 100.0 AS DECIMAL(15,2)) AS VARCHAR)"


_AUDIT = """ "CreatedAt", "CreatedBy", "LastUpdatedAt", CAST(dt AS VARCHAR) AS dt,
  CAST(1 AS INTEGER) AS batch"""


@query(
    with_sql(inputs.IDS_SQL, inputs.CLIENTS_SQL)
    + f"""SELECT "OurBranchID", "ClientID", sha256('{SALT}' || "ClientName") AS "ClientName",
  "ClientType", CAST(CAST(date_trunc('year', "DOB") AS DATE) AS VARCHAR) AS "DOB", "IsActive",
  CASE WHEN NOT {sampled(defects.NULL_RATE, "blank", '"ClientID"')} THEN "State" END AS "State",
  "Country", {_AUDIT} FROM clients"""
)
def silver_client(spark, sf_dir):
    """Clients with masked names and birth dates."""
    clients = lending.clients(inputs.client_ids(spark, sf_dir), inputs.TODAY)
    return _silver(_landed(defects.blank(clients, "State", ["ClientID"]), "t_Client"), "t_Client")


@query(
    with_sql(inputs.IDS_SQL, inputs.accounts_sql())
    + f"""SELECT "OurBranchID", "ClientID", "AccountID", substr("AccountID", 1, 4)
  AS "BranchCode", substr("AccountID", 5, 2) AS "ProductCode", substr("AccountID", 7)
  AS "AccountSeq", "ProductID", "AccountType", {_money("balance_cents")} AS "ClearBalance",
  {_money("freeze_cents")} AS "FreezeAmount", "AccountStatus", {_AUDIT} FROM accounts"""
)
def silver_account(spark, sf_dir):
    """Accounts with the parts of their id and decimal balances."""
    accounts = inputs.accounts_of_clients(spark, sf_dir)
    return _silver(_landed(accounts, "t_AccountCustomer"), "t_AccountCustomer")


@query(
    with_sql(*inputs.loans_sql())
    + f"""SELECT "OurBranchID", "AccountID", "LoanID", "LoanSeries", CAST(dt AS VARCHAR)
  AS "SanctionDate", {_money("sanction")} AS "SanctionAmount", CAST(dt AS VARCHAR)
  AS "DisbursementDate", {_money("disbursed")} AS "DisbursementAmount", "LoanStatus",
  CAST(CAST(tenths / 10.0 AS DECIMAL(6,4)) AS VARCHAR) AS "InterestRate",
  {_money("interest")} AS "InterestAmount", "Tenure", "Frequency", "RepaymentType",
  {_money("sanction")} AS "OutstandingPrincipal", {_money("interest")}
  AS "OutstandingInterest", CAST(0 AS INTEGER) AS "DPD", FALSE AS "IsNPS", FALSE AS "ParFlag",
  "FundID", CAST("MaturityDate" AS VARCHAR) AS "MaturityDate", {_AUDIT} FROM loans"""
)
def silver_loan(spark, sf_dir):
    """Loans, one row per id although some were delivered twice."""
    loans = inputs.loans_of_clients(spark, sf_dir)
    return _silver(_landed(defects.duplicate(loans, ["LoanID"]), "t_Loan"), "t_Loan")


@query(
    with_sql(*inputs.loans_sql(), inputs.INSTALLMENTS_SQL)
    + f"""SELECT "OurBranchID", "AccountID", "LoanID", "LoanSeries", "InstallmentNo",
  CAST("InstallmentDate" AS VARCHAR) AS "InstallmentDate", {_money("principal")}
  AS "PrincipalDue", {_money("interest_due")} AS "InterestDue",
  {_money("(principal + interest_due)")} AS "InstallmentAmount", 'PENDING' AS "PaidStatus",
  CAST(NULL AS VARCHAR) AS "TransactionDate", {_AUDIT} FROM installments"""
)
def silver_installment(spark, sf_dir):
    """Installments with decimal amounts."""
    installments = lending.installments(
        inputs.loans_of_clients(spark, sf_dir), FEED_INSTALLMENTS
    )
    return _silver(_landed(installments, "t_LoanInstallment"), "t_LoanInstallment", rare_duplicates=True)


@query(
    with_sql(*inputs.loans_sql(), inputs.INSTALLMENTS_SQL, inputs.ledger_sql("TRUE"))
    + f"""SELECT "OurBranchID", "AccountID", "LoanID", "LoanSeries", "TrxID",
  CAST(moved_at AS VARCHAR) AS "TrxDateTime", CAST("ValueDate" AS VARCHAR) AS "ValueDate", "TrxType",
  "DrCr", {_money("amount")} AS "Amount", {_money("principal")} AS "PrincipalComponent",
  {_money("interest_part")} AS "InterestComponent", CAST("ValueDate" AS VARCHAR) AS dt,
  CAST(1 AS INTEGER) AS batch FROM ledger"""
)
def silver_ledger(spark, sf_dir):
    """All transactions with decimal amounts.

    Payment mode and user depend on a CRC that the SQL side cannot compute, so
    they are left out of the comparison.
    """
    loans = inputs.loans_of_clients(spark, sf_dir)
    trx = lending.ledger(
        lending.disbursements(loans), lending.repayments(lending.installments(loans, FEED_INSTALLMENTS))
    ).withColumn("dt", F.col("ValueDate"))
    result = _silver(_landed(trx, "t_AccountTrx"), "t_AccountTrx", rare_duplicates=True)
    return result.drop("PaymentMode", "CreatedBy", "CreatedAt", "LastUpdatedAt")


ORDER_RULES = [
    ColumnRule("o_orderkey", "LoanNumber", "BIGINT", nullable=False, purpose="NATURAL_KEY"),
    ColumnRule("o_custkey", "ClientNumber", "BIGINT", nullable=False, purpose="FOREIGN_KEY"),
    ColumnRule("o_totalprice", "SanctionAmount", "DECIMAL(15,2)", purpose="MEASURE"),
    ColumnRule("o_orderdate", "SanctionDate", "DATE", nullable=False),
    ColumnRule("o_orderstatus", "o_orderstatus", "STRING", nullable=False, purpose="FLAG"),
    ColumnRule("o_orderpriority", "Priority", "STRING", active=False),
]


@query(
    """
SELECT o_orderkey AS "LoanNumber", o_custkey AS "ClientNumber",
  CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS "SanctionAmount",
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS "SanctionDate", o_orderstatus
FROM orders"""
)
def silver_orders(spark, sf_dir):
    """Orders renamed, typed and without the inactive column."""
    orders = table(spark, sf_dir, "orders")
    return silver.silver(
        orders, ORDER_RULES, ["LoanNumber"], newest_first=("SanctionDate",), rare_duplicates=True
    )


REJECT_RULES = [
    ColumnRule("o_orderkey", "LoanNumber", "BIGINT", nullable=False, purpose="NATURAL_KEY"),
    ColumnRule("client_text", "ClientNumber", "BIGINT", nullable=False, purpose="FOREIGN_KEY"),
    ColumnRule("o_orderstatus", "Status", "STRING", nullable=False),
]
_BAD_CLIENT = sampled(defects.NULL_RATE, "letters", "o_orderkey")
_NO_STATUS = sampled(defects.NULL_RATE, "blank", "o_orderkey")


@query(
    f"""
SELECT o_orderkey AS "LoanNumber", concat_ws(',',
  CASE WHEN {_BAD_CLIENT} THEN 'cast:ClientNumber' END,
  CASE WHEN {_NO_STATUS} THEN 'null:Status' END) AS reject_reasons
FROM orders WHERE {_BAD_CLIENT} OR {_NO_STATUS}"""
)
def silver_rejects(spark, sf_dir):
    """Rows refused by the column rules, with all reasons."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    damaged = defects.blank(orders, "o_orderstatus", ["o_orderkey"]).withColumn(
        "client_text",
        F.when(
            lending.in_hash_sample(defects.NULL_RATE, "o_orderkey", salt="letters"),
            F.concat(F.lit("C"), F.col("o_custkey").cast("string")),
        ).otherwise(F.col("o_custkey").cast("string")),
    )
    refused = silver.rejected(silver.checked(damaged, REJECT_RULES))
    return refused.select(
        "LoanNumber", F.array_join("reject_reasons", ",").alias("reject_reasons")
    )


@query(
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
  l_tax, l_returnflag, l_linestatus, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ship_day
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
    l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
    l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST,
    l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) AS r
  FROM lineitem) WHERE r = 1"""
)
def silver_dedup_latest(spark, sf_dir):
    """The newest lineitem of every order and line number."""
    newest = latest_per_key(
        table(spark, sf_dir, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
         "l_tax", "l_returnflag", "l_linestatus"],
    )
    return newest.withColumn("ship_day", inputs.day("l_shipdate")).drop("l_shipdate")


CUSTOMER_RULES = [
    ColumnRule("c_custkey", "ClientNumber", "BIGINT", nullable=False, purpose="NATURAL_KEY"),
    ColumnRule("c_name", "ClientName", "STRING", nullable=False, pii=True),
    ColumnRule("c_acctbal", "Balance", "DECIMAL(15,2)", pii=True),
    ColumnRule("c_mktsegment", "ClientType", "STRING", nullable=False),
]


@query(
    f"""
SELECT c_custkey AS "ClientNumber", sha256('{SALT}' || c_name) AS "ClientName",
  CAST(NULL AS VARCHAR) AS "Balance", c_mktsegment AS "ClientType" FROM customer"""
)
def pii_masked(spark, sf_dir):
    """Customers with their personal values masked."""
    customers = table(spark, sf_dir, "customer")
    return silver.accepted(customers, CUSTOMER_RULES, SALT)


_CLIENT_COLUMNS = [r.source for r in SILVER_RULES["t_Client"]]
_REQUIRED = {r.source: not r.nullable for r in SILVER_RULES["t_Client"]}


@query(
    with_sql(inputs.IDS_SQL, inputs.CLIENTS_SQL)
    + f""", damaged AS (SELECT * EXCLUDE ("ClientType"), 1 AS batch,
  CASE WHEN NOT {sampled(defects.NULL_RATE, "blank", '"ClientID"')} THEN "ClientType" END
  AS "ClientType" FROM clients)
"""
    + "\nUNION ALL\n".join(
        f"""SELECT 't_Client' AS source_table_name, '{r.target}' AS column_name,
  '{r.data_type}' AS data_type, {not r.nullable} AS is_required, '{r.purpose}' AS column_purpose,
  count(*) AS rows, count(*) - count("{r.source}") AS nulls,
  {not r.nullable} AND count(*) > count("{r.source}") AS is_violated FROM damaged"""
        for r in SILVER_RULES["t_Client"]
    )
)
def config_cross_values(spark, sf_dir):
    """Configured columns of the client table against the values that arrived."""
    clients = lending.clients(inputs.client_ids(spark, sf_dir), inputs.TODAY)
    damaged = _landed(defects.blank(clients, "ClientType", ["ClientID"]), "t_Client")
    seen = quality.null_rates(damaged, "t_Client", _CLIENT_COLUMNS)
    tables = config.table_config(spark, "landing")
    declared = config.column_config(tables, config.rule_rows(spark)).join(
        tables.select("table_id", "source_table_name"), "table_id"
    )
    return (
        seen.join(
            declared.withColumnRenamed("source_column_name", "column_name"),
            (F.col("table_name") == F.col("source_table_name"))
            & (seen["column_name"] == F.col("target_column_name")),
        )
        .select(
            "source_table_name",
            F.col("target_column_name").alias("column_name"),
            "data_type",
            (~F.col("is_nullable")).alias("is_required"),
            "column_purpose",
            "rows",
            "nulls",
            ((~F.col("is_nullable")) & (F.col("nulls") > 0)).alias("is_violated"),
        )
    )
