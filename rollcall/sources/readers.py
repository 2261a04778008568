"""Readers (S1–S8).  Every reader takes a declared schema; nothing infers.

* S1 :func:`read_table` – parquet path or JDBC table (partitioned reads).
* S2 :func:`flatten_pages` – listing pages → one row per resource.
* S3 :func:`read_json_array` – a file holding one JSON array of resources.
* S4 :func:`read_uid_lookup` – headerless positional CSV, last row wins.
* S5 :func:`read_csv_with_header`; S6 :func:`read_external_ids`.
* S7 :func:`numbered_names` – zero-padded numbered labels per input row.
* S8 :func:`device_listing` – pages of devices, projected and filtered.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from rollcall.operators.ranking import last_wins
from rollcall.schemas import DEVICE_RESOURCE, EXTERNAL_ID_CSV, UID_LOOKUP_CSV


def read_table(spark: SparkSession, source: str | Mapping[str, str], columns=None) -> DataFrame:
    """A relational table.

    ``source`` is a parquet path, or JDBC options (``url``, ``dbtable`` and,
    for parallel reads, ``partitionColumn``/``lowerBound``/``upperBound``/
    ``numPartitions``).  ``columns`` prunes the read.
    """
    if isinstance(source, str):
        df = spark.read.parquet(source)
    else:
        df = spark.read.format("jdbc").options(**source).load()
    return df.select(*columns) if columns else df


def flatten_pages(pages: DataFrame, field: str, schema: StructType | None = None,
                  text_col: str = "page") -> DataFrame:
    """Concatenate one array field of every page.  A page without the
    field contributes nothing (the reference raised or skipped)."""
    if schema is not None:
        pages = pages.select(F.from_json(F.col(text_col), schema).alias("__p"))
        arr = F.col(f"__p.{field}")
    else:
        arr = F.col(field)
    return pages.select(F.explode(F.coalesce(arr, F.array())).alias("item")).select("item.*")


def read_json_array(spark: SparkSession, path: str, item_schema: StructType) -> DataFrame:
    """S3: a JSON file holding one top-level array of resources."""
    return spark.read.schema(item_schema).option("multiLine", True).json(path)


def _ordinal() -> Column:
    # File order: splits of one file keep their offset order, rows within a
    # split keep line order; the file path separates files.
    return F.struct(F.input_file_name(), F.monotonically_increasing_id())


def read_uid_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Headerless CSV keyed by column 3 (e-mail) → (user type, uid);
    the last row of a repeated key wins (A4)."""
    raw = spark.read.schema(UID_LOOKUP_CSV).option("header", False).csv(path).withColumn("__ord", _ordinal())
    return last_wins(raw.select("email", "uid", "user_type", "__ord"), ["email"], "__ord").drop("__ord")


def read_csv_with_header(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """S5."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_external_ids(spark: SparkSession, path: str) -> DataFrame:
    """Headerless CSV: 1 user key, 2 id type, 3 id value."""
    return spark.read.schema(EXTERNAL_ID_CSV).option("header", False).csv(path).drop("c0")


def numbered_names(df: DataFrame, prefix: Column, first: int, last: int, width: int = 2,
                   sep: str = "-") -> DataFrame:
    """For each input row, labels prefix-02 … prefix-27 (generated per
    row with ``sequence``, no cross join)."""
    n = F.explode(F.sequence(F.lit(first), F.lit(last))).alias("n")
    out = df.select("*", n)
    return out.withColumn("name", F.concat(prefix, F.lit(sep), F.lpad(F.col("n").cast("string"), width, "0")))


def device_listing(pages: DataFrame, projection: list[str] | None = None, query: Column | None = None,
                   text_col: str = "page") -> DataFrame:
    """Device pages → devices, optionally projected and filtered."""
    schema = StructType([StructField("chromeosdevices", ArrayType(DEVICE_RESOURCE))])
    d = flatten_pages(pages, "chromeosdevices", schema, text_col)
    if query is not None:
        d = d.filter(query)
    return d.select(*projection) if projection else d
