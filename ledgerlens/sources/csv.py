"""CSV sources (latin-1, header) with explicit schema and tolerant date parsing."""

from __future__ import annotations


from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_sales_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
                   date_col: str | None = "Order Date", date_format: str | None = None) -> DataFrame:
    """Read a header CSV in ISO-8859-1. Fails when the path is absent.

    Without a schema every column is read as a string (no inference pass over the data);
    ``date_col`` is parsed with ``try_to_timestamp`` so bad dates become NULL.
    """
    reader = spark.read.option("header", True).option("encoding", "ISO-8859-1").option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    try:
        df = reader.csv(path)
    except AnalysisException as e:  # the reader knows every file system, the driver only its own
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"CSV not found: {path}") from e
        raise
    if date_col and date_col in df.columns:
        df = df.withColumn(date_col, parse_timestamp(F.col(date_col), date_format))
    return df


def parse_timestamp(col, fmt: str | None = None):
    """Timestamp parse where unparseable text becomes NULL (pandas ``errors='coerce'``)."""
    text = col.cast("string")
    if fmt:
        return F.try_to_timestamp(text, F.lit(fmt))
    return F.try_to_timestamp(text)


# The static renames of the compact pipeline (source header → standard name).
STANDARD_RENAMES = {"Order Date": "date", "Region": "region", "Product Name": "product", "Quantity": "quantity",
                    "Profit": "profit"}


def rename_standard(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """PRJ4: rename known headers to the standard vocabulary; absent headers are ignored."""
    mapping = mapping or STANDARD_RENAMES
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})
