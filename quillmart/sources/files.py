"""Raw-layer ingestion: one reader by file kind, table naming, column sanitising,
sensitive-column removal, all-text typing with a batch stamp.

All reads are single distributed ``spark.read`` calls; nothing is loaded on
the driver. Column names are metadata (``toDF``), not a scan.
"""

from __future__ import annotations

import os
import re
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.functions.fixed_values import SENSITIVE_COLUMNS

FORMATS = {".csv": "csv", ".parquet": "parquet", ".json": "json", ".html": "html", ".htm": "html"}
UNSUPPORTED = {".xlsx": "no distributed Excel reader", ".pkl": "pickled Python objects are not loaded",
               ".pickle": "pickled Python objects are not loaded"}


def table_name(file_name: str) -> str:
    """'A-b c.csv' -> 'a_b_c_csv' (base: spaces and dashes to '_', lower; plus extension)."""
    base, ext = os.path.splitext(file_name)
    return base.replace(" ", "_").replace("-", "_").lower() + "_" + ext.replace(".", "").lower()


def sanitize(name: str) -> str:
    """Lower case, non-word characters to '_', runs of '_' collapsed, trimmed."""
    n = re.sub(r"[^\w]", "_", name.lower())
    n = re.sub(r"_+", "_", n)
    return n.strip("_")


def sanitize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[sanitize(c) for c in df.columns])


def normalise_index_column(df: DataFrame) -> DataFrame:
    """A leftover pandas index header ('Unnamed: 0', 'index') becomes 'unnamed_0'."""
    out = df
    for c in df.columns:
        if re.fullmatch(r"unnamed: 0", c, flags=re.IGNORECASE) or c == "index":
            out = out.withColumnRenamed(c, "unnamed_0")
    return out


def drop_sensitive(df: DataFrame, sensitive: Sequence[str] = SENSITIVE_COLUMNS) -> DataFrame:
    """Drop sensitive columns. Applied after sanitising, so 'CVV' or
    'Credit Card Number' are caught as well."""
    return df.drop(*[c for c in df.columns if c in set(sensitive)])


def as_raw(df: DataFrame, stamp: str) -> DataFrame:
    """Every column as text plus the batch stamp ``ingested_at``."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns],
                     F.lit(stamp).cast("timestamp_ntz").alias("ingested_at"))


def read_source(spark: SparkSession, path: str) -> DataFrame:
    """The one reader of an export, by its extension; an unsupported one is
    an error."""
    from quillmart.sources import formats

    ext = os.path.splitext(path.rstrip("/"))[1].lower()
    if ext not in FORMATS:
        raise ValueError(f"{path}: {UNSUPPORTED.get(ext, 'unknown kind of file')}")
    readers = {"parquet": lambda: spark.read.parquet(path), "csv": lambda: formats.read_csv_fallback(spark, path),
               "json": lambda: formats.read_json_any(spark, path), "html": lambda: formats.read_html_tables(spark, path)}
    return readers[FORMATS[ext]]()


def bad_records(spark: SparkSession, path: str) -> DataFrame | None:
    """(file, reason, record) of what ``read_source`` leaves out; a Parquet
    export has no single records to leave out."""
    from quillmart.sources import formats

    kind = FORMATS[os.path.splitext(path.rstrip("/"))[1].lower()]
    found = {"csv": formats.bad_csv, "json": formats.bad_json, "html": formats.bad_html}.get(kind)
    return found(spark, path) if found else None


def quarantine_report(spark: SparkSession, sources: dict[str, str]) -> DataFrame:
    """Per source (name, path) the rows read, the bad records left out, and
    why a source was skipped as a whole: unsupported, unreadable or empty. One
    source's fault does not stop the others."""
    rows = []
    for name, path in sources.items():
        ext = os.path.splitext(path.rstrip("/"))[1].lower()
        good = bad = 0
        skipped = None
        if ext not in FORMATS:
            skipped = UNSUPPORTED.get(ext, "unknown kind of file")
        else:
            try:
                good = read_source(spark, path).count()
                left_out = bad_records(spark, path)
                bad = left_out.count() if left_out is not None else 0
                skipped = None if good or bad else "empty"
            except (AnalysisException, PySparkException, Py4JJavaError):
                skipped = "unreadable"
        rows.append((name, good, bad, skipped))
    return spark.createDataFrame(rows, "source string, good long, bad long, skipped string")
