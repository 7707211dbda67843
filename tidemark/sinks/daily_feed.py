"""One business date of the lending feed, landed as five related tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.terms import FEED_INSTALLMENTS
from tidemark.operators import defects, lending
from tidemark.sinks.tables import write_batch
from tidemark.sources.landing import landed, next_batch


def client_range(spark: SparkSession, first: int, last: int) -> DataFrame:
    """Consecutive client numbers, both ends included."""
    return spark.range(first, last + 1)


def land_day(
    ids: DataFrame,
    root: str,
    run_dt: str,
    today: str,
    first_id: int = 1,
    first_seq: int = 1,
    with_defects: bool = True,
) -> dict[str, int]:
    """Lands the clients in ``ids`` (column ``id``) with all that follows from them.

    All five tables get the batch number the client table is due for.  Repaid are
    installments of earlier dates that fall due on ``run_dt``; the scan for them
    opens three years of folders at most.  Only the client numbers are shuffled,
    into as many parts as the largest table needs files; each table is then
    written straight from the exploded plan, which is cheaper to compute again
    than to keep.  Returns the rows landed per table.
    """
    spark = ids.sparkSession
    batch = next_batch(spark, root, run_dt)
    parts = _parts(ids.count(), spark.sparkContext.defaultParallelism)
    dated = ids.select("id").repartition(parts).withColumn("dt", F.lit(run_dt).cast("date"))
    clients = lending.clients(dated, today)
    accounts = lending.accounts(dated, first_id, first_seq)
    loans = lending.loans(accounts)
    moved = [lending.disbursements(loans)]
    due = _due(spark, root, run_dt)
    if due is not None:
        moved.append(lending.repayments(due))
    ledger = lending.ledger(*moved)

    landing_loans = loans
    if with_defects:
        clients = defects.blank(clients, "State", ["ClientID"])
        landing_loans = defects.duplicate(loans, ["LoanID"])
        ledger = defects.truncate(ledger, "AccountID", ["TrxID"])
        ledger = defects.postdate(ledger, "CreatedAt", ["TrxID"])

    frames = {
        "t_Client": clients,
        "t_AccountCustomer": accounts,
        "t_Loan": landing_loans,
        "t_LoanInstallment": lending.installments(loans, FEED_INSTALLMENTS),
        "t_AccountTrx": ledger,
    }
    return {
        name: write_batch(
            lending.layout(df, name), root, name, run_dt, batch, keep_layout=True
        )
        for name, df in frames.items()
    }


def _parts(clients: int, cores: int) -> int:
    """Parts of at most 50,000 clients, whose installments fill a file of the target
    size; smaller ones, down to 2,000, while there are idle cores."""
    return max(1, -(-clients // 50_000), min(cores, -(-clients // 2_000)))


def _due(spark: SparkSession, root: str, run_dt: str) -> DataFrame | None:
    """Installments landed so far that are due, or None before the first delivery."""
    try:
        return lending.due_installments(landed(spark, root, "t_LoanInstallment"), run_dt, FEED_INSTALLMENTS)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
