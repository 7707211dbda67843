"""The tables, folds and staging that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDS = 5

# The contracts count words between ASCII blanks.
WORD_SEPARATORS = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str = "doc_id") -> Column:
    """Remainder of the CRC of the id as text; fold 0 is held out from learning."""
    return F.crc32(F.col(doc_id).cast("string")) % FOLDS


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def split_words(text: Column) -> Column:
    """Words between ASCII blanks; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_SEPARATORS), "")


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Gives the Python workers this package, once per application.

    Workers need not share the driver's folders or its ``sys.path``.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="tidemark-code-")) / "tidemark_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)
