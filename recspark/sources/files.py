"""Readers and writers: CSV ingest, Parquet sinks, run artefacts."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Raw CSV file names of the seven tables the prepare stage reads.
RAW_FILES = {
    "orders": "olist_orders_dataset.csv",
    "items": "olist_order_items_dataset.csv",
    "customers": "olist_customers_dataset.csv",
    "products": "olist_products_dataset.csv",
    "reviews": "olist_order_reviews_dataset.csv",
    "translation": "product_category_name_translation.csv",
    "payments": "olist_order_payments_dataset.csv",
}

RAW_SCHEMAS = {
    "orders": "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz",
    "items": "order_id string, order_item_id int, product_id string, price double, freight_value double",
    "customers": "customer_id string, customer_unique_id string",
    "products": "product_id string, product_category_name string",
    "reviews": "order_id string, review_score int",
    "translation": "product_category_name string, product_category_name_english string",
    "payments": "order_id string, payment_sequential int, payment_type string",
}


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def resolve_dir(spark: SparkSession, base: str, sub: str = "raw") -> str:
    """Prefer ``base/sub`` when it exists, else ``base`` (works on any Hadoop file system)."""
    candidate = f"{base.rstrip('/')}/{sub}"
    return candidate if _exists(spark, candidate) else base


def clean_headers(df: DataFrame, junk: str = r"[\"']") -> DataFrame:
    """Strip stray quotes and surrounding blanks from column names; data is untouched."""
    return df.toDF(*[re.sub(junk, "", c).strip() for c in df.columns])


def read_raw(spark: SparkSession, base: str, names=None, schemas=None, files=None) -> dict[str, DataFrame]:
    """Read the raw CSV tables with explicit schemas; any malformed row fails the job.

    The header row is used for names (cleaned), the declared schema for types: the file is
    read untyped first only to learn the header order, which touches one line.
    """
    schemas = schemas or RAW_SCHEMAS
    files = files or RAW_FILES
    names = names or list(files)
    folder = resolve_dir(spark, base)
    out = {}
    for name in names:
        path = f"{folder.rstrip('/')}/{files[name]}"
        if not _exists(spark, path):
            raise FileNotFoundError(path)
        declared = T._parse_datatype_string(schemas[name])
        header = clean_headers(spark.read.option("header", True).csv(path)).columns
        by_name = {f.name: f for f in declared.fields}
        # columns not declared are read as strings and dropped right away
        fields = [by_name.get(h, T.StructField(h, T.StringType())) for h in header]
        df = (
            spark.read.schema(T.StructType(fields))
            .option("header", True)
            .option("mode", "FAILFAST")
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
            .csv(path)
            .select(*[f.name for f in declared.fields])
        )
        out[name] = df
    return out


def write_parquet(df: DataFrame, path: str, partition_by=None, mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def path_size_bytes(spark: SparkSession, path: str) -> int:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(hpath).getLength())


def write_interactions(df: DataFrame, path: str) -> int:
    """Write interactions as Parquet; returns bytes written."""
    write_parquet(df, path)
    return path_size_bytes(df.sparkSession, path)


def write_features(df: DataFrame, path: str, stats: dict | None = None) -> None:
    """Feature Parquet plus a one-row JSON metadata table next to it."""
    write_parquet(df, path)
    meta = {"n_columns": len(df.columns), "columns": ",".join(df.columns)}
    meta.update({k: str(v) for k, v in (stats or {}).items()})
    spark = df.sparkSession
    spark.createDataFrame([meta]).coalesce(1).write.mode("overwrite").json(path.rstrip("/") + "_metadata")


def write_splits(df_with_split: DataFrame, path: str, split_col: str = "split") -> None:
    """All splits in one write, one folder per split value."""
    write_parquet(df_with_split, path, partition_by=[split_col])


def write_recs(recs: DataFrame, path: str) -> None:
    """Recommendations of every user, partitioned by model and list length."""
    write_parquet(recs, path, partition_by=["model", "k"])


def write_id_mappings(maps: dict[str, DataFrame], folder: str) -> None:
    for name, df in maps.items():
        write_parquet(df, f"{folder.rstrip('/')}/{name}")


# Fixed value: file-name pattern of exported recommendation lists, model_variant_K<k>.csv
RECS_FILE_PATTERN = r"recommendations_([^_/]+)_([^/]+)_K(\d+)\.csv$"


def load_recs(spark: SparkSession, path: str) -> DataFrame:
    """Recommendation lists stacked by column name, with ``rank``: what ``write_recs`` wrote, or CSV exports.

    CSV files (a path that ends in .csv) are grouped by header; model, variant and k come
    from the name. A single column is the item, whatever its header (``top_10``); files
    without a rank are ranked in line order. Columns that a file lacks are null.
    """
    if not path.endswith(".csv"):
        return spark.read.parquet(path)
    names = [r[0] for r in spark.read.text(path).select(F.input_file_name()).distinct().collect()]
    groups: dict[tuple, list[str]] = {}
    for name in sorted(names):
        groups.setdefault(tuple(spark.read.option("header", True).csv(name).columns), []).append(name)
    out = None
    for header, files in groups.items():
        df = spark.read.option("header", True).csv(files)
        if len(header) == 1:
            df = df.toDF("product_id")
        df = df.withColumn("_file", F.input_file_name())
        if "rank" in df.columns:
            df = df.withColumn("rank", F.col("rank").cast("int"))
        else:
            lines = Window.partitionBy("_file").orderBy(F.monotonically_increasing_id())
            df = df.withColumn("rank", F.row_number().over(lines))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    part = lambda i: F.regexp_extract("_file", RECS_FILE_PATTERN, i)
    return out.withColumns({"model": part(1), "variant": part(2), "k": part(3).cast("int")}).drop("_file")


def load_runs(spark: SparkSession, pattern: str, sort_metric: str = "test.NDCG@K") -> DataFrame:
    """All run-metric JSON files, flattened to one row per run (``section.metric`` columns), best first.

    The run's name is its ``run_name``, else the file's. ``sort_metric`` names one column;
    a metric that no file has is an error.
    """
    df = spark.read.option("multiLine", True).json(pattern)
    name = F.regexp_extract(F.input_file_name(), r"metrics_(.+)\.json$", 1)
    own = F.col("run_name").cast("string") if "run_name" in df.columns else F.lit(None).cast("string")
    df = df.withColumn("run", F.coalesce(own, name))
    flat = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StructType):
            flat += [F.col(f"`{f.name}`.`{s.name}`").alias(f"{f.name}.{s.name}") for s in f.dataType.fields]
        elif f.name != "run_name":
            flat.append(F.col(f"`{f.name}`"))
    out = df.select(*flat)
    if sort_metric not in out.columns:
        raise ValueError(f"no run has {sort_metric!r}; there are {sorted(out.columns)}")
    return out.orderBy(F.col(f"`{sort_metric}`").desc_nulls_last(), "run")
