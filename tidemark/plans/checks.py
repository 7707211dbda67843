"""Volume reports, data-quality checks and referential integrity."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.terms import FEED_INSTALLMENTS
from tidemark.operators import defects, joins, lending, quality, reports
from tidemark.plans import inputs
from tidemark.plans.inputs import day, sampled, table, with_sql
from tidemark.plans.registry import query
from tidemark.schemas import BUSINESS_RELATIONS, Relation

TABLE_KEYS = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "events": ["event_id"],
    "documents": ["doc_id"],
    "labels": ["doc_id"],
    "embeddings": ["vec_id"],
    "pages": ["page_id"],
    "benchmark": ["item_id"],
    "conversations": ["conv_id", "turn"],
}

RELATIONS = [
    Relation("nation", ("n_regionkey",), "region", ("r_regionkey",)),
    Relation("customer", ("c_nationkey",), "nation", ("n_nationkey",)),
    Relation("supplier", ("s_nationkey",), "nation", ("n_nationkey",)),
    Relation("orders", ("o_custkey",), "customer", ("c_custkey",)),
    Relation("lineitem", ("l_orderkey",), "orders", ("o_orderkey",)),
    Relation("lineitem", ("l_partkey",), "part", ("p_partkey",)),
    Relation("lineitem", ("l_suppkey",), "supplier", ("s_suppkey",)),
    Relation("labels", ("doc_id",), "documents", ("doc_id",)),
]

_FIXED_WIDTH = 10
_TRX_SQL = [*inputs.loans_sql(_FIXED_WIDTH), inputs.INSTALLMENTS_SQL, inputs.ledger_sql("FALSE")]


@query(
    """
SELECT 'orders' AS table_name, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS dt,
  count(*) AS records FROM orders GROUP BY 2
UNION ALL
SELECT 'lineitem', CAST(CAST(l_shipdate AS DATE) AS VARCHAR), count(*) FROM lineitem GROUP BY 2
UNION ALL
SELECT 'events', CAST(CAST(ts AS DATE) AS VARCHAR), count(*) FROM events GROUP BY 2
ORDER BY 1, 2"""
)
def rows_per_table_per_dt(spark, sf_dir):
    """Volume report: records per table and business date, sorted."""
    return reports.volume_report(
        {
            "orders": (table(spark, sf_dir, "orders"), day("o_orderdate")),
            "lineitem": (table(spark, sf_dir, "lineitem"), day("l_shipdate")),
            "events": (table(spark, sf_dir, "events"), day("ts")),
        }
    )


_VOLUME_SQL = """
WITH loans AS (
  SELECT 't_Loan' AS table_name, CAST(o_orderdate AS DATE) AS dt, count(*) AS records
  FROM {orders} WHERE o_totalprice >= :least GROUP BY CAST(o_orderdate AS DATE)),
payments AS (
  SELECT 't_AccountTrx' AS table_name, CAST(l_shipdate AS DATE) AS dt, count(*) AS records
  FROM {lineitem} WHERE l_extendedprice >= :least GROUP BY CAST(l_shipdate AS DATE))
SELECT * FROM loans UNION ALL SELECT * FROM payments ORDER BY table_name, dt"""


@query(
    "SELECT table_name, CAST(dt AS VARCHAR) AS dt, records FROM ("
    + _VOLUME_SQL.format(orders="orders", lineitem="lineitem").replace(":least", "5000")
    + ")"
)
def volume_report_sql(spark, sf_dir):
    """The volume report as SQL: named sub-queries, UNION ALL and a bound parameter."""
    return spark.sql(
        _VOLUME_SQL,
        args={"least": 5000},
        orders=table(spark, sf_dir, "orders"),
        lineitem=table(spark, sf_dir, "lineitem"),
    )


@query(
    "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, count(*) AS records FROM {name}" for name in TABLE_KEYS
    )
)
def table_row_counts(spark, sf_dir):
    """Global row count of every table."""
    return quality.row_counts({name: table(spark, sf_dir, name) for name in TABLE_KEYS})


@query(
    """
SELECT l_orderkey, l_linenumber, count(*) AS copies
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""
)
def duplicate_keys(spark, sf_dir):
    """Composite keys that occur more than once."""
    return quality.duplicate_keys(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


@query(
    with_sql(*inputs.loans_sql())
    + f"""SELECT "LoanID", CAST(2 AS BIGINT) AS copies FROM loans
WHERE {sampled(defects.DUPLICATE_RATE, "duplicate", '"LoanID"')}"""
)
def duplicated_loans(spark, sf_dir):
    """Duplicate loan ids after a known share of loans was duplicated."""
    loans = inputs.loans_of_clients(spark, sf_dir)
    return quality.duplicate_keys(defects.duplicate(loans, ["LoanID"]), ["LoanID"])


@query(
    with_sql(inputs.IDS_SQL, inputs.CLIENTS_SQL)
    + f"""SELECT 't_Client' AS table_name, column_name, rows, nulls FROM (
  SELECT count(*) AS rows,
    count(*) FILTER (WHERE {sampled(defects.NULL_RATE, "blank", '"ClientID"')}) AS s,
    count(*) FILTER (WHERE "DOB" IS NULL) AS d,
    count(*) FILTER (WHERE "ClientName" IS NULL) AS c
  FROM clients), LATERAL (VALUES ('State', s), ('DOB', d), ('ClientName', c))
    AS v(column_name, nulls)"""
)
def null_rate(spark, sf_dir):
    """NULLs per nominated column after a known share of states was blanked."""
    clients = lending.clients(inputs.client_ids(spark, sf_dir), inputs.TODAY)
    blanked = defects.blank(clients, "State", ["ClientID"])
    return quality.null_rates(blanked, "t_Client", ["State", "DOB", "ClientName"])


_NULL_CHECKED = {
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
}


@query(
    "\nUNION ALL\n".join(
        f"""SELECT '{name}' AS table_name, '{column}' AS column_name, count(*) AS rows,
  count(*) FILTER (WHERE {column} IS NULL) AS nulls FROM {name}"""
        for name, columns in _NULL_CHECKED.items()
        for column in columns
    )
)
def given_null_rates(spark, sf_dir):
    """NULLs per column of whole given tables, as they are."""
    return joins.union_all(
        [
            quality.null_rates(table(spark, sf_dir, name), name, columns)
            for name, columns in _NULL_CHECKED.items()
        ]
    )


@query("SELECT doc_id, source FROM documents WHERE length(source) <> 4")
def given_malformed_sources(spark, sf_dir):
    """Documents whose source code does not have the usual length, as they are."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "source")
    return quality.malformed(documents, "source", 4)


_BUSINESS_VIEWS = {
    "t_Client": "clients",
    "t_AccountCustomer": "accounts",
    "t_Loan": "loans",
    "t_LoanInstallment": "installments",
    "t_AccountTrx": "ledger",
}


def _business_relation_sql(r: Relation) -> str:
    (child,), (parent,) = r.child_keys, r.parent_keys
    known = f"""EXISTS (SELECT 1 FROM {_BUSINESS_VIEWS[r.parent]} p WHERE p."{parent}" = c."{child}")"""
    return f"""SELECT '{r.child}' AS child_table, '{child}' AS child_column,
  '{r.parent}' AS parent_table, '{parent}' AS parent_column, count(*) AS checked_rows,
  count(*) FILTER (WHERE NOT {known}) AS orphan_rows,
  count(DISTINCT CASE WHEN NOT {known} THEN "{child}" END) AS orphan_keys
FROM {_BUSINESS_VIEWS[r.child]} c WHERE "{child}" IS NOT NULL"""


@query(
    with_sql(
        inputs.IDS_SQL, inputs.CLIENTS_SQL, *inputs.loans_sql()[1:], inputs.INSTALLMENTS_SQL,
        inputs.ledger_sql("FALSE"),
    )
    + "\nUNION ALL\n".join(_business_relation_sql(r) for r in BUSINESS_RELATIONS)
)
def business_relations(spark, sf_dir):
    """The declared foreign keys of the lending tables that follow from the customers."""
    ids = inputs.client_ids(spark, sf_dir)
    accounts = lending.accounts(inputs.spread(ids, inputs.ROWS_OF_CLIENT))
    loans = lending.loans(accounts)
    frames = {
        "t_Client": lending.clients(ids, inputs.TODAY),
        "t_AccountCustomer": accounts,
        "t_Loan": loans,
        "t_LoanInstallment": lending.installments(loans, FEED_INSTALLMENTS),
        "t_AccountTrx": lending.ledger(lending.disbursements(loans)),
    }
    return joins.relation_checks(frames, BUSINESS_RELATIONS)


def _ledger(spark, sf_dir):
    return lending.ledger(
        lending.disbursements(inputs.loans_of_clients(spark, sf_dir, _FIXED_WIDTH))
    )


@query(
    with_sql(*_TRX_SQL)
    + f"""SELECT "TrxID", substr("AccountID", 1, 15) AS "AccountID" FROM ledger
WHERE {sampled(defects.TRUNCATE_RATE, "truncate", '"TrxID"')}"""
)
def malformed_keys(spark, sf_dir):
    """Transactions whose account id lost a character."""
    cut = defects.truncate(_ledger(spark, sf_dir), "AccountID", ["TrxID"])
    return quality.malformed(cut, "AccountID", 6 + _FIXED_WIDTH).select("TrxID", "AccountID")


@query(
    with_sql(*_TRX_SQL)
    + f"""SELECT "TrxID", CAST(moved_at + INTERVAL 30 DAY AS VARCHAR) AS "CreatedAt",
  CAST(moved_at AS VARCHAR) AS "TrxDateTime" FROM ledger
WHERE {sampled(defects.FUTURE_RATE, "postdate", '"TrxID"')}"""
)
def future_dated(spark, sf_dir):
    """Transactions created after they took place."""
    moved = defects.postdate(_ledger(spark, sf_dir), "CreatedAt", ["TrxID"])
    return quality.later_than(moved, "CreatedAt", "TrxDateTime").select(
        "TrxID", "CreatedAt", "TrxDateTime"
    )


@query(
    """
SELECT l_returnflag, l_linestatus, count(*) AS records
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE o_orderdate > l_shipdate GROUP BY l_returnflag, l_linestatus"""
)
def ordered_after_shipping(spark, sf_dir):
    """Lines dated before their own order."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_shipdate", "l_returnflag", "l_linestatus"
    )
    # two plain shuffles into one join: AQE splits an order with very many lines
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return (
        quality.later_than(joined, "o_orderdate", "l_shipdate")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(F.count(F.lit(1)).alias("records"))
    )


@query(
    with_sql(*inputs.loans_sql())
    + f"""SELECT "LoanID", "OurBranchID", "AccountID" FROM loans l WHERE NOT EXISTS (
  SELECT 1 FROM (SELECT "OurBranchID",
      CASE WHEN {sampled(defects.NULL_RATE, "truncate", '"AccountID"')}
           THEN substr("AccountID", 1, length("AccountID") - 1) ELSE "AccountID" END
      AS "AccountID" FROM accounts) a
  WHERE a."OurBranchID" = l."OurBranchID" AND a."AccountID" = l."AccountID")"""
)
def orphans_two_key(spark, sf_dir):
    """Loans without their account, by branch and account, after some ids were damaged."""
    accounts = inputs.accounts_of_clients(spark, sf_dir)
    loans = lending.loans(accounts)
    damaged = defects.truncate(accounts, "AccountID", ["AccountID"], defects.NULL_RATE)
    orphans = joins.orphan_rows(loans, damaged, ["OurBranchID", "AccountID"])
    return orphans.select("LoanID", "OurBranchID", "AccountID")


_FOUR = ["OurBranchID", "AccountID", "LoanSeries", "LoanID"]


@query(
    with_sql(*inputs.loans_sql(), inputs.INSTALLMENTS_SQL)
    + f"""SELECT "OurBranchID", "AccountID", "LoanSeries", "LoanID", count(*) AS orphans
FROM installments i WHERE NOT EXISTS (
  SELECT 1 FROM loans l WHERE l."OurBranchID" = i."OurBranchID"
    AND l."AccountID" = i."AccountID" AND l."LoanSeries" = i."LoanSeries"
    AND l."LoanID" = i."LoanID"
    AND NOT {sampled(defects.NULL_RATE, "truncate", 'l."LoanID"')})
GROUP BY 1, 2, 3, 4"""
)
def orphans_four_key(spark, sf_dir):
    """Installments without their loan, counted per missing four-part key."""
    loans = inputs.loans_of_clients(spark, sf_dir)
    damaged = defects.truncate(loans, "LoanID", ["LoanID"], defects.NULL_RATE)
    return joins.orphan_counts(lending.installments(loans, FEED_INSTALLMENTS), damaged, _FOUR)


@query(
    """
SELECT o_orderkey, o_custkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)"""
)
def childless_parents(spark, sf_dir):
    """Orders without any line."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem")
    return joins.orphan_rows(orders, lines, ["o_orderkey"], ["l_orderkey"])


@query(
    """
SELECT 'orders' AS table_name, column_name, rows, violations FROM (
  SELECT count(*) AS rows, count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS a,
    count(*) FILTER (WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) AS b
  FROM orders), LATERAL (VALUES ('o_orderstatus', a), ('o_orderpriority', b))
    AS v(column_name, violations)
UNION ALL
SELECT 'events', 'event_type', count(*),
  count(*) FILTER (WHERE event_type NOT IN ('click', 'view', 'purchase', 'signup')) FROM events"""
)
def allowed_values(spark, sf_dir):
    """Rows outside a column's list of allowed values."""
    rules = {
        "orders": {
            "o_orderstatus": ["F", "O"],
            "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM"],
        },
        "events": {"event_type": ["click", "view", "purchase", "signup"]},
    }
    return joins.union_all(
        [
            quality.value_violations(table(spark, sf_dir, name), name, columns)
            for name, columns in rules.items()
        ]
    )


def _key_sql(name: str, keys: list[str]) -> str:
    listed = ", ".join(keys)
    missing = " OR ".join(f"{k} IS NULL" for k in keys)
    return f"""SELECT '{name}' AS table_name, CAST(sum(copies) AS BIGINT) AS rows,
  count(*) AS distinct_keys, count(*) FILTER (WHERE copies > 1) AS duplicated_keys,
  CAST(coalesce(sum(CASE WHEN {missing} THEN copies END), 0) AS BIGINT) AS null_key_rows
FROM (SELECT {listed}, count(*) AS copies FROM {name} GROUP BY {listed})"""


@query("\nUNION ALL\n".join(_key_sql(name, keys) for name, keys in TABLE_KEYS.items()))
def pk_violations(spark, sf_dir):
    """Primary-key check of every table."""
    return joins.union_all(
        [
            quality.key_violations(table(spark, sf_dir, name), name, keys)
            for name, keys in TABLE_KEYS.items()
        ]
    )


def _relation_sql(r: Relation) -> str:
    child, parent = r.child_keys[0], r.parent_keys[0]
    known = f"EXISTS (SELECT 1 FROM {r.parent} p WHERE p.{parent} = c.{child})"
    return f"""SELECT '{r.child}' AS child_table, '{child}' AS child_column,
  '{r.parent}' AS parent_table, '{parent}' AS parent_column, count(*) AS checked_rows,
  count(*) FILTER (WHERE NOT {known}) AS orphan_rows,
  count(DISTINCT CASE WHEN NOT {known} THEN {child} END) AS orphan_keys
FROM {r.child} c WHERE {child} IS NOT NULL"""


@query("\nUNION ALL\n".join(_relation_sql(r) for r in RELATIONS))
def relation_checks(spark, sf_dir):
    """Every declared foreign key with its orphans."""
    names = {r.child for r in RELATIONS} | {r.parent for r in RELATIONS}
    return joins.relation_checks({n: table(spark, sf_dir, n) for n in names}, RELATIONS)


@query(
    """
SELECT p_name AS source_table_name, count(*) AS matches,
  CASE WHEN count(*) = 1 THEN 'OK' ELSE 'AMBIGUOUS' END AS verdict
FROM part GROUP BY p_name"""
)
def lookup_uniqueness(spark, sf_dir):
    """Whether a configuration lookup by name finds exactly one row."""
    return quality.lookup_verdicts(inputs.feed_registry(spark, sf_dir), "source_table_name")
