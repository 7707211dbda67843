"""Table layouts, allowed values and declared relations.

Everything here is declared as data; ``operators`` turns it into plans.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

@dataclass(frozen=True)
class ColumnRule:
    """One configured output column."""

    source: str
    target: str
    data_type: str
    nullable: bool = True
    pii: bool = False
    purpose: str = "ATTRIBUTE"
    active: bool = True


@dataclass(frozen=True)
class Relation:
    """A declared foreign key."""

    child: str
    child_keys: tuple[str, ...]
    parent: str
    parent_keys: tuple[str, ...]


# --- fixed values: Silver column declarations, source then target column ------
SILVER_RULES: dict[str, list[ColumnRule]] = {
    "t_Client": [
        ColumnRule("OurBranchID", "OurBranchID", "STRING", nullable=False, purpose="DIMENSION"),
        ColumnRule("ClientID", "ClientID", "STRING", nullable=False, purpose="NATURAL_KEY"),
        ColumnRule("ClientName", "ClientName", "STRING", nullable=False, pii=True),
        ColumnRule("ClientType", "ClientType", "STRING", nullable=False),
        ColumnRule("DOB", "DOB", "DATE", pii=True),
        ColumnRule("IsActive", "IsActive", "BOOLEAN", nullable=False, purpose="FLAG"),
        ColumnRule("State", "State", "STRING"),
        ColumnRule("Country", "Country", "STRING"),
        ColumnRule("CreatedAt", "CreatedAt", "TIMESTAMP", nullable=False, purpose="AUDIT"),
        ColumnRule("CreatedBy", "CreatedBy", "STRING", nullable=False, purpose="AUDIT"),
        ColumnRule("LastUpdatedAt", "LastUpdatedAt", "TIMESTAMP", purpose="AUDIT"),
        ColumnRule("dt", "dt", "DATE", nullable=False, purpose="PARTITION"),
        ColumnRule("batch", "batch", "INT", nullable=False, purpose="PARTITION"),
    ],
    "t_AccountCustomer": [
        ColumnRule("OurBranchID", "OurBranchID", "STRING", nullable=False, purpose="DIMENSION"),
        ColumnRule("ClientID", "ClientID", "STRING", nullable=False, purpose="FOREIGN_KEY"),
        ColumnRule("AccountID", "AccountID", "STRING", nullable=False, purpose="NATURAL_KEY"),
        ColumnRule("AccountID", "BranchCode", "STRING", nullable=False, purpose="DERIVED"),
        ColumnRule("AccountID", "ProductCode", "STRING", nullable=False, purpose="DERIVED"),
        ColumnRule("AccountID", "AccountSeq", "STRING", nullable=False, purpose="DERIVED"),
        ColumnRule("ProductID", "ProductID", "STRING"),
        ColumnRule("AccountType", "AccountType", "STRING", nullable=False),
        ColumnRule("ClearBalance", "ClearBalance", "DECIMAL(15,2)", purpose="DERIVED"),
        ColumnRule("FreezeAmount", "FreezeAmount", "DECIMAL(15,2)", purpose="DERIVED"),
        ColumnRule("AccountStatus", "AccountStatus", "STRING", nullable=False),
        ColumnRule("CreatedAt", "CreatedAt", "TIMESTAMP", nullable=False, purpose="AUDIT"),
        ColumnRule("CreatedBy", "CreatedBy", "STRING", nullable=False, purpose="AUDIT"),
        ColumnRule("LastUpdatedAt", "LastUpdatedAt", "TIMESTAMP", purpose="AUDIT"),
        ColumnRule("dt", "dt", "DATE", nullable=False, purpose="PARTITION"),
        ColumnRule("batch", "batch", "INT", nullable=False, purpose="PARTITION"),
    ],
    "t_Loan": [
        ColumnRule("OurBranchID", "OurBranchID", "STRING", nullable=False, purpose="DIMENSION"),
        ColumnRule("AccountID", "AccountID", "STRING", nullable=False, purpose="FOREIGN_KEY"),
        ColumnRule("LoanID", "LoanID", "STRING", nullable=False, purpose="NATURAL_KEY"),
        ColumnRule("LoanSeries", "LoanSeries", "INT", nullable=False),
        ColumnRule("SanctionDate", "SanctionDate", "DATE"),
        ColumnRule("SanctionAmount", "SanctionAmount", "DECIMAL(15,2)", purpose="DERIVED"),
        ColumnRule("DisbursementDate", "DisbursementDate", "DATE"),
        ColumnRule("DisbursementAmount", "DisbursementAmount", "DECIMAL(15,2)", purpose="DERIVED"),
        ColumnRule("LoanStatus", "LoanStatus", "STRING", nullable=False),
        ColumnRule("InterestRate", "InterestRate", "DECIMAL(6,4)", purpose="DERIVED"),
        ColumnRule("InterestAmount", "InterestAmount", "DECIMAL(15,2)", purpose="DERIVED"),
        ColumnRule("Tenure", "Tenure", "INT"),
        ColumnRule("Frequency", "Frequency", "STRING"),
        ColumnRule("RepaymentType", "RepaymentType", "STRING"),
        ColumnRule(
            "OutstandingPrincipal", "OutstandingPrincipal", "DECIMAL(15,2)", purpose="DERIVED",
        ),
        ColumnRule(
            "OutstandingInterest", "OutstandingInterest", "DECIMAL(15,2)", purpose="DERIVED",
        ),
        ColumnRule("DPD", "DPD", "INT", purpose="DERIVED"),
        ColumnRule("IsNPS", "IsNPS", "BOOLEAN", purpose="FLAG"),
        ColumnRule("ParFlag", "ParFlag", "BOOLEAN", purpose="FLAG"),
        ColumnRule("FundID", "FundID", "STRING", purpose="DIMENSION"),
        ColumnRule("MaturityDate", "MaturityDate", "DATE"),
        ColumnRule("CreatedAt", "CreatedAt", "TIMESTAMP", nullable=False, purpose="AUDIT"),
        ColumnRule("CreatedBy", "CreatedBy", "STRING", nullable=False, purpose="AUDIT"),
        ColumnRule("LastUpdatedAt", "LastUpdatedAt", "TIMESTAMP", purpose="AUDIT"),
        ColumnRule("dt", "dt", "DATE", nullable=False, purpose="PARTITION"),
        ColumnRule("batch", "batch", "INT", nullable=False, purpose="PARTITION"),
    ],
    "t_LoanInstallment": [
        ColumnRule("OurBranchID", "OurBranchID", "STRING", nullable=False, purpose="DIMENSION"),
        ColumnRule("AccountID", "AccountID", "STRING", nullable=False, purpose="FOREIGN_KEY"),
        ColumnRule("LoanID", "LoanID", "STRING", nullable=False, purpose="FOREIGN_KEY"),
        ColumnRule("LoanSeries", "LoanSeries", "INT", nullable=False),
        ColumnRule("InstallmentNo", "InstallmentNo", "INT", nullable=False, purpose="NATURAL_KEY"),
        ColumnRule("InstallmentDate", "InstallmentDate", "DATE", nullable=False),
        ColumnRule(
            "PrincipalDue", "PrincipalDue", "DECIMAL(15,2)", nullable=False, purpose="DERIVED",
        ),
        ColumnRule(
            "InterestDue", "InterestDue", "DECIMAL(15,2)", nullable=False, purpose="DERIVED",
        ),
        ColumnRule(
            "InstallmentAmount", "InstallmentAmount", "DECIMAL(15,2)", nullable=False, purpose="DERIVED",
        ),
        ColumnRule("PaidStatus", "PaidStatus", "STRING", nullable=False),
        ColumnRule("TransactionDate", "TransactionDate", "DATE"),
        ColumnRule("CreatedAt", "CreatedAt", "TIMESTAMP", nullable=False, purpose="AUDIT"),
        ColumnRule("CreatedBy", "CreatedBy", "STRING", nullable=False, purpose="AUDIT"),
        ColumnRule("LastUpdatedAt", "LastUpdatedAt", "TIMESTAMP", purpose="AUDIT"),
        ColumnRule("dt", "dt", "DATE", nullable=False, purpose="PARTITION"),
        ColumnRule("batch", "batch", "INT", nullable=False, purpose="PARTITION"),
    ],
    "t_AccountTrx": [
        ColumnRule("OurBranchID", "OurBranchID", "STRING", nullable=False, purpose="DIMENSION"),
        ColumnRule("AccountID", "AccountID", "STRING", nullable=False, purpose="FOREIGN_KEY"),
        ColumnRule("LoanID", "LoanID", "STRING", purpose="FOREIGN_KEY"),
        ColumnRule("LoanSeries", "LoanSeries", "INT"),
        ColumnRule("TrxID", "TrxID", "STRING", nullable=False, purpose="NATURAL_KEY"),
        ColumnRule("TrxDateTime", "TrxDateTime", "TIMESTAMP", nullable=False),
        ColumnRule("ValueDate", "ValueDate", "DATE", nullable=False),
        ColumnRule("TrxType", "TrxType", "STRING", nullable=False),
        ColumnRule("DrCr", "DrCr", "STRING", nullable=False),
        ColumnRule("Amount", "Amount", "DECIMAL(15,2)", nullable=False, purpose="DERIVED"),
        ColumnRule("PrincipalComponent", "PrincipalComponent", "DECIMAL(15,2)", purpose="DERIVED"),
        ColumnRule("InterestComponent", "InterestComponent", "DECIMAL(15,2)", purpose="DERIVED"),
        ColumnRule("PaymentMode", "PaymentMode", "STRING"),
        ColumnRule("CreatedAt", "CreatedAt", "TIMESTAMP", nullable=False, purpose="AUDIT"),
        ColumnRule("CreatedBy", "CreatedBy", "STRING", nullable=False, purpose="AUDIT"),
        ColumnRule("LastUpdatedAt", "LastUpdatedAt", "TIMESTAMP", purpose="AUDIT"),
        ColumnRule("dt", "dt", "DATE", nullable=False, purpose="PARTITION"),
        ColumnRule("batch", "batch", "INT", nullable=False, purpose="PARTITION"),
    ],
}

# Allowed values per metadata table and column.
ALLOWED_VALUES: dict[str, dict[str, list[str]]] = {
    "table_config": {"drift_policy": ["STRICT", "EVOLVE", "QUARANTINE"]},
    "table_process_config": {
        "process_type": ["BRONZE", "SILVER", "GOLD"],
        "load_type": ["FULL", "INCREMENTAL"],
    },
    "input_column_config": {
        "process_type": ["BRONZE", "SILVER", "GOLD"],
        "column_purpose": [
            "NATURAL_KEY", "FOREIGN_KEY", "ATTRIBUTE", "MEASURE", "FLAG",
            "DERIVED", "AUDIT", "DIMENSION", "PARTITION",
        ],
    },
    "etl_process_master": {
        "process_type": ["BRONZE", "SILVER", "GOLD"],
        "trigger_type": ["SCHEDULED", "MANUAL", "BACKFILL"],
        "status": ["STARTED", "SUCCESS", "FAILED", "PARTIAL"],
    },
    "etl_process_log": {
        "process_type": ["BRONZE", "SILVER", "GOLD"],
        "load_type": ["FULL", "INCREMENTAL"],
        "status": ["STARTED", "SUCCESS", "FAILED", "SKIPPED", "QUARANTINED"],
    },
    "schema_drift_log": {
        "event_type": ["NEW", "MISSING", "TYPE_CHANGED"],
        "action_taken": ["AUTO_EVOLVED", "REJECTED", "QUARANTINED"],
    },
}

# Load order of the five business tables; a lower number loads earlier.
LOAD_PRIORITIES = {
    "t_Client": 10,
    "t_AccountCustomer": 20,
    "t_Loan": 30,
    "t_LoanInstallment": 40,
    "t_AccountTrx": 50,
}
SOURCE_SYSTEM = "LMS_CORE"

# Columns of the metadata tables; False marks a required one.
METADATA_SCHEMAS: dict[str, T.StructType] = {
    "table_config": T.StructType(
        [
            T.StructField(
                "table_id", T.LongType(), False,
                {"comment": "stable number of the source table"},
            ),
            T.StructField(
                "source_table_name", T.StringType(), False,
                {"comment": "name of the feed and of its landing folder"},
            ),
            T.StructField("source_system", T.StringType(), False, {"comment": "system of origin"}),
            T.StructField(
                "source_format", T.StringType(), False,
                {"comment": "PARQUET, CSV, JSON or DELTA"},
            ),
            T.StructField(
                "source_path_pattern", T.StringType(), False,
                {"comment": "landing path with {table}, {run_dt}, {batch}"},
            ),
            T.StructField(
                "target_catalog", T.StringType(), False,
                {"comment": "catalog of the Bronze table"},
            ),
            T.StructField(
                "target_schema", T.StringType(), False,
                {"comment": "schema of the Bronze table"},
            ),
            T.StructField(
                "target_table", T.StringType(), False,
                {"comment": "name of the Bronze table"},
            ),
            T.StructField("partition_cols", T.StringType(), True, {"comment": "comma list"}),
            T.StructField(
                "replace_where_template", T.StringType(), True,
                {"comment": "rows a load may replace, with {run_dt}"},
            ),
            T.StructField(
                "drift_policy", T.StringType(), False,
                {"comment": "STRICT, EVOLVE or QUARANTINE"},
            ),
            T.StructField(
                "load_priority", T.IntegerType(), False,
                {"comment": "lower loads earlier"},
            ),
            T.StructField(
                "is_active", T.BooleanType(), False,
                {"comment": "false leaves the table out of every load"},
            ),
            T.StructField("created_at", T.TimestampType()),
            T.StructField("created_by", T.StringType()),
            T.StructField("last_edited_at", T.TimestampType()),
            T.StructField("last_edited_by", T.StringType()),
        ]
    ),
    "table_process_config": T.StructType(
        [
            T.StructField("process_config_id", T.LongType()),
            T.StructField("table_id", T.LongType(), False, {"comment": "table_config.table_id"}),
            T.StructField(
                "process_type", T.StringType(), False,
                {"comment": "BRONZE, SILVER or GOLD"},
            ),
            T.StructField("load_type", T.StringType(), False, {"comment": "FULL or INCREMENTAL"}),
            T.StructField(
                "depends_on_table_ids", T.StringType(), True,
                {"comment": "comma list of upstream table_ids"},
            ),
            T.StructField(
                "transform_module", T.StringType(), True,
                {"comment": "registered transform, null for an as-is load"},
            ),
            T.StructField("is_active", T.BooleanType(), False),
            T.StructField("created_at", T.TimestampType()),
            T.StructField("created_by", T.StringType()),
            T.StructField("last_edited_at", T.TimestampType()),
            T.StructField("last_edited_by", T.StringType()),
        ]
    ),
    "input_column_config": T.StructType(
        [
            T.StructField("column_id", T.LongType()),
            T.StructField("table_id", T.LongType(), False, {"comment": "table_config.table_id"}),
            T.StructField(
                "process_type", T.StringType(), False,
                {"comment": "layer the declaration is for"},
            ),
            T.StructField("source_column_name", T.StringType(), False),
            T.StructField(
                "target_column_name", T.StringType(), True,
                {"comment": "null keeps the source name"},
            ),
            T.StructField(
                "data_type", T.StringType(), False,
                {"comment": "Spark type of the target column"},
            ),
            T.StructField(
                "is_nullable", T.BooleanType(), True,
                {"comment": "false rejects rows without a value"},
            ),
            T.StructField("is_pii", T.BooleanType(), True, {"comment": "true masks the value"}),
            T.StructField(
                "column_purpose", T.StringType(), True,
                {"comment": "role of the column"},
            ),
            T.StructField(
                "is_active", T.BooleanType(), False,
                {"comment": "false leaves the column out"},
            ),
            T.StructField("created_at", T.TimestampType()),
            T.StructField("created_by", T.StringType()),
            T.StructField("last_edited_at", T.TimestampType()),
            T.StructField("last_edited_by", T.StringType()),
        ]
    ),
    "etl_process_master": T.StructType(
        [
            T.StructField("run_id", T.StringType(), False),
            T.StructField("pipeline_name", T.StringType(), False),
            T.StructField("process_type", T.StringType(), False),
            T.StructField(
                "run_dt", T.StringType(), False,
                {"comment": "business date, yyyy-MM-dd"},
            ),
            T.StructField("trigger_type", T.StringType(), False),
            T.StructField("triggered_by", T.StringType(), False),
            T.StructField("status", T.StringType(), False),
            T.StructField("total_tables", T.IntegerType()),
            T.StructField("success_count", T.IntegerType()),
            T.StructField("failed_count", T.IntegerType()),
            T.StructField("skipped_count", T.IntegerType()),
            T.StructField("started_at", T.TimestampType(), False),
            T.StructField("finished_at", T.TimestampType()),
            T.StructField("duration_seconds", T.DoubleType()),
            T.StructField("error_message", T.StringType()),
            T.StructField("created_by", T.StringType()),
            T.StructField("created_at", T.TimestampType()),
            T.StructField("updated_at", T.TimestampType()),
        ]
    ),
    "etl_process_log": T.StructType(
        [
            T.StructField("log_id", T.StringType(), False),
            T.StructField(
                "run_id", T.StringType(), False,
                {"comment": "etl_process_master.run_id"},
            ),
            T.StructField("table_id", T.LongType(), False, {"comment": "table_config.table_id"}),
            T.StructField("table_name", T.StringType(), False),
            T.StructField("process_type", T.StringType(), False),
            T.StructField("load_type", T.StringType(), False),
            T.StructField(
                "run_dt", T.StringType(), False,
                {"comment": "business date; the latest successful one is the watermark"},
            ),
            T.StructField("status", T.StringType(), False),
            T.StructField("rows_read", T.LongType()),
            T.StructField("rows_written", T.LongType()),
            T.StructField(
                "delta_version_before", T.LongType(), True,
                {"comment": "target version before the load"},
            ),
            T.StructField(
                "delta_version_after", T.LongType(), True,
                {"comment": "target version after the load"},
            ),
            T.StructField("started_at", T.TimestampType(), False),
            T.StructField("finished_at", T.TimestampType()),
            T.StructField(
                "heartbeat_at", T.TimestampType(), True,
                {"comment": "stale while STARTED means the run died"},
            ),
            T.StructField("duration_seconds", T.LongType()),
            T.StructField("error_message", T.StringType()),
            T.StructField("error_stacktrace", T.StringType()),
            T.StructField("created_by", T.StringType()),
            T.StructField("created_at", T.TimestampType()),
            T.StructField("updated_at", T.TimestampType()),
        ]
    ),
    "schema_drift_log": T.StructType(
        [
            T.StructField("drift_log_id", T.StringType(), False),
            T.StructField(
                "run_id", T.StringType(), False,
                {"comment": "etl_process_master.run_id"},
            ),
            T.StructField("table_id", T.LongType(), False, {"comment": "table_config.table_id"}),
            T.StructField("column_name", T.StringType(), False),
            T.StructField(
                "column_data_type", T.StringType(), True,
                {"comment": "the type seen in the source"},
            ),
            T.StructField("event_type", T.StringType(), False),
            T.StructField("action_taken", T.StringType(), False),
            T.StructField("detected_at", T.TimestampType(), False),
            T.StructField("created_by", T.StringType()),
            T.StructField("created_at", T.TimestampType()),
            T.StructField("updated_at", T.TimestampType()),
        ]
    ),
}

METADATA_KEYS = {
    "table_config": "table_id",
    "table_process_config": "process_config_id",
    "input_column_config": "column_id",
    "etl_process_master": "run_id",
    "etl_process_log": "log_id",
    "schema_drift_log": "drift_log_id",
}

METADATA_RELATIONS = [
    Relation("table_process_config", ("table_id",), "table_config", ("table_id",)),
    Relation("input_column_config", ("table_id",), "table_config", ("table_id",)),
    Relation("etl_process_log", ("run_id",), "etl_process_master", ("run_id",)),
    Relation("etl_process_log", ("table_id",), "table_config", ("table_id",)),
    Relation("schema_drift_log", ("run_id",), "etl_process_master", ("run_id",)),
    Relation("schema_drift_log", ("table_id",), "table_config", ("table_id",)),
]

BUSINESS_RELATIONS = [
    Relation("t_AccountCustomer", ("ClientID",), "t_Client", ("ClientID",)),
    Relation("t_Loan", ("AccountID",), "t_AccountCustomer", ("AccountID",)),
    Relation("t_LoanInstallment", ("AccountID",), "t_AccountCustomer", ("AccountID",)),
    Relation("t_LoanInstallment", ("LoanID",), "t_Loan", ("LoanID",)),
    Relation("t_AccountTrx", ("AccountID",), "t_AccountCustomer", ("AccountID",)),
    Relation("t_AccountTrx", ("LoanID",), "t_Loan", ("LoanID",)),
]

# Silver columns cut out of another column: target -> (start, length).
DERIVED_SUBSTRINGS = {
    "BranchCode": (1, 4),
    "ProductCode": (5, 2),
    "AccountSeq": (7, 2**31 - 1),
}
# --------------------------------------------------------------------------


def raw_columns(table: str) -> list[str]:
    """The landed columns of a business table, without its partition columns."""
    seen = dict.fromkeys(
        r.source for r in SILVER_RULES[table] if r.purpose != "PARTITION"
    )
    return list(seen)


def natural_key(table: str) -> list[str]:
    """The key that must be unique in Silver."""
    if table == "t_LoanInstallment":
        return ["LoanID", "InstallmentNo"]
    return [r.target for r in SILVER_RULES[table] if r.purpose == "NATURAL_KEY"]
