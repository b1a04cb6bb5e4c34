"""Star-schema tables: schemas, readers, writers, publishing."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names and order of the star schema (fixed values).
SCHEMAS: dict[str, str] = {
    "dim_books": (
        "author STRING, book_id BIGINT, category_name STRING, price DOUBLE, purchase_count BIGINT, "
        "rating_avg DOUBLE, seller_username STRING, title STRING"
    ),
    "dim_date": (
        "date DATE, year INT, month INT, day INT, day_of_week STRING, quarter INT, is_weekend BOOLEAN"
    ),
    "dim_users": (
        "user_id BIGINT, username STRING, full_name STRING, email STRING, role STRING, "
        "is_active BOOLEAN"
    ),
    "fact_cart": "cart_id BIGINT, buyer_id BIGINT, book_id BIGINT, quantity INT, added_at TIMESTAMP",
    "fact_reviews": (
        "book_id BIGINT, buyer_id BIGINT, score DOUBLE, total_reviews_at_snapshot INT, "
        "snapshot_date TIMESTAMP"
    ),
    "fact_sales": (
        "order_item_id BIGINT, order_id BIGINT, buyer_id BIGINT, seller_id BIGINT, book_id BIGINT, "
        "order_date TIMESTAMP, quantity INT, unit_price DOUBLE, line_total DOUBLE, "
        "order_overall_status STRING, item_status STRING, payment_method STRING, "
        "payment_status STRING"
    ),
}

# Nested seed document: one or more objects, each with any of the three arrays (fixed values).
SEED_SCHEMA = (
    "buyers ARRAY<STRUCT<username: STRING, full_name: STRING, email: STRING, is_active: BOOLEAN>>, "
    "sellers ARRAY<STRUCT<username: STRING>>, "
    "products ARRAY<STRUCT<title: STRING, author: STRING, category_name: STRING, price: DOUBLE, "
    "seller_username: STRING>>"
)
FACTOR_SCHEMA = "id BIGINT, features ARRAY<FLOAT>"


def qualified(table: str, catalog: str = "main", schema: str = "gold") -> str:
    return f"{catalog}.{schema}.{table}"


def warehouse_table(spark: SparkSession, table: str, catalog: str = "main", schema: str = "gold") -> DataFrame:
    return spark.table(qualified(table, catalog, schema))


def query(spark: SparkSession, sql: str, params: Mapping | None = None, **frames: DataFrame) -> DataFrame:
    """Run SQL with ``:name`` parameters; ``{name}`` in the text refers to a passed DataFrame."""
    return spark.sql(sql, args=dict(params or {}), **frames)


def preview(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in an order; every task hands on ``n`` rows at most."""
    return df.orderBy(*order).limit(n)


def read_csv(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return (
        spark.read.schema(SCHEMAS[table])
        .option("header", True)
        .option("enforceSchema", False)
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(f"{folder}/{table}.csv")
    )


def read_parquet(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def write_csv(df: DataFrame, folder: str, table: str) -> None:
    """Header CSV in the column order of the schema."""
    columns = [f.name for f in T.StructType.fromDDL(SCHEMAS[table]).fields]
    (
        df.select(*columns)
        .write.option("header", True)
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(f"{folder}/{table}.csv")
    )


def read_seed(spark: SparkSession, path: str, multi_line: bool = True) -> dict[str, DataFrame]:
    """The arrays of nested seed objects as three tables; a missing array is an empty table."""
    seed = spark.read.schema(SEED_SCHEMA).option("multiLine", multi_line).json(path)
    return {name: seed.select(F.inline(F.col(name))) for name in ("buyers", "sellers", "products")}


def publish(
    df: DataFrame, name: str, table: bool = False, buckets: int | None = None, key: str = "user_id", path: str | None = None
) -> None:
    """Make an intermediate readable by SQL: a view, or a table, in ``path`` if one is given.

    With ``buckets`` the table is stored in as many parts by a hash of its join key, each sorted and written as one file:
    tables with equal buckets are joined and grouped by the key without a shuffle.
    """
    if not table:
        df.createOrReplaceTempView(name)
        return
    if buckets:
        df = df.repartition(buckets, key)
    writer = df.write.mode("overwrite")
    if path:
        writer = writer.option("path", path)
    if buckets:
        writer = writer.bucketBy(buckets, key).sortBy(key)
    writer.saveAsTable(name)


def manifest(spark: SparkSession, readers: Mapping[str, DataFrame | None]) -> DataFrame:
    """Row and column count per required source, in one job; absent sources have no rows counted."""
    parts = []
    for name, df in readers.items():
        if df is None:
            parts.append(
                spark.range(1).select(
                    F.lit(name).alias("table_name"),
                    F.lit(False).alias("present"),
                    F.lit(0).cast("long").alias("row_count"),
                    F.lit(0).cast("long").alias("column_count"),
                )
            )
            continue
        parts.append(
            df.agg(F.count("*").alias("row_count")).select(
                F.lit(name).alias("table_name"),
                F.lit(True).alias("present"),
                "row_count",
                F.lit(len(df.columns)).cast("long").alias("column_count"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def optional_source(reader, *args) -> DataFrame | None:
    """The table, or None when it does not exist."""
    try:
        return reader(*args)
    except AnalysisException:
        return None


def require_sources(sources: Mapping[str, DataFrame | None]) -> dict[str, DataFrame]:
    missing = sorted(name for name, df in sources.items() if df is None)
    if missing:
        raise FileNotFoundError(f"missing source tables: {', '.join(missing)}")
    return dict(sources)


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return df


def save_factors(path: str, users: DataFrame, items: DataFrame, **params) -> None:
    """Write a factor model: two factor tables and a one-row parameter table."""
    if not path:
        raise ValueError("a model path is required")
    users.select("id", "features").write.mode("overwrite").parquet(f"{path}/user")
    items.select("id", "features").write.mode("overwrite").parquet(f"{path}/item")
    spark = users.sparkSession
    spark.range(1).select(
        *[F.lit(v).alias(k) for k, v in sorted(params.items())], F.lit(path).alias("path")
    ).write.mode("overwrite").parquet(f"{path}/params")


def load_factors(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return (
        spark.read.schema(FACTOR_SCHEMA).parquet(f"{path}/user"),
        spark.read.schema(FACTOR_SCHEMA).parquet(f"{path}/item"),
    )
