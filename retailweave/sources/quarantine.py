"""CSV files with malformed lines: rows that read well, and a side table of the lines that do not.

Every line goes to one of the two. A line is malformed if it has too few or too many values, or one that does not read
as its column's type; rows are refused besides for text that has to be a date and is none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LINE = "__line"
MALFORMED = "malformed"


def read_csv_lines(spark: SparkSession, path: str, schema: T.StructType | str, dates: Sequence[str] = (), **options: str) -> DataFrame:
    """The rows of CSV files, with a header unless ``options`` say otherwise: the columns of ``schema`` and ``__line``, ``__file`` and ``__reason``.

    ``__reason`` is null for good rows, ``malformed``, or the names of the columns of ``dates`` whose text is no date.
    ``__line`` is the text of a refused line. All columns are parsed whatever is selected, so that a line is malformed or not for every query.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    # Written without the values that a line of the wrong length happens to have.
    whole = T.StructType([*fields.fields, T.StructField(_LINE, T.StringType())])
    reader = spark.read.option("header", True).options(**options).option("columnNameOfCorruptRecord", _LINE).option("columnPruning", False)
    rows = reader.csv(path, schema=whole, mode="PERMISSIVE", enforceSchema=True)
    no_dates = F.concat_ws(",", *(F.when(F.col(_quoted(name)).isNotNull() & F.col(_quoted(name)).try_cast("date").isNull(), F.lit(name)) for name in dates))
    # Spark reads the types of the columns that a query needs. This never holds, and needs all of them.
    never = F.xxhash64(*(F.col(_quoted(name)) for name in fields.names)) < F.lit(-(1 << 63)).cast("long")
    reason = F.when(F.col(_LINE).isNotNull() | never, MALFORMED).when(no_dates != "", no_dates)
    line = F.coalesce(F.col(_LINE), F.to_csv(F.struct(*(F.col(_quoted(name)) for name in fields.names))))
    return rows.select(
        *(_quoted(name) for name in fields.names), reason.alias("__reason"), F.when(reason.isNotNull(), line).alias(_LINE), F.col("_metadata.file_path").alias("__file")
    )


def read_csv_quarantined(
    spark: SparkSession, path: str, schema: T.StructType | str, quarantine: str, dates: Sequence[str] = (), **options: str
) -> DataFrame:
    """The good rows of CSV files; refused lines are appended as Parquet to ``quarantine``, with ``file``, ``line``, ``reason`` and ``refused_at``.

    The side table is written now; the good rows are read when they are used.
    """
    rows = read_csv_lines(spark, path, schema, dates, **options)
    refused = rows.where("__reason is not null").select(
        F.col("__file").alias("file"), F.col(_LINE).alias("line"), F.col("__reason").alias("reason"), F.current_timestamp().alias("refused_at")
    )
    refused.write.mode("append").parquet(quarantine)
    return rows.where("__reason is null").drop("__reason", _LINE, "__file")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
