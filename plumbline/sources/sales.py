"""Generated sales rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.encode import padded_id
from ..functions.hashing import draw_int

# How many of each the generated columns choose from.
SHOPS, YEARS, WEEKS, PRODUCTS, COLORS = 999, 5, 52, 9_999, 99
FIRST_YEAR = 2020
ROWS = 50_000


def sales_rows(keys: DataFrame, key: str, seed: int = 0, how: str = "xxhash64", keep_key: bool = False) -> DataFrame:
    """One sales row per key, each field drawn uniformly and on its own.

    The draw is a hash of key, field and seed: rows do not depend on the
    partitioning and a lost task rebuilds the same ones.
    """
    draw = lambda field, size: draw_int(key, field, size, seed, how)
    return keys.select(
        *([key] if keep_key else []),
        padded_id("SHOP_", draw("shop_code", SHOPS) + 1, 5).alias("shop_code"),
        (draw("year_no", YEARS) + FIRST_YEAR).cast("int").alias("year_no"),
        (draw("week_no", WEEKS) + 1).cast("int").alias("week_no"),
        padded_id("PROD_", draw("product_no", PRODUCTS) + 1, 6).alias("product_no"),
        padded_id("Product_", draw("product_name", PRODUCTS) + 1, 0).alias("product_name"),
        padded_id("CLR_", draw("color_no", COLORS) + 1, 3).alias("color_no"),
        padded_id("Color_", draw("color_name", COLORS) + 1, 0).alias("color_name"),
        (draw("is_top", 2) == 1).alias("is_top"),
    )


def sales_table(spark: SparkSession, rows: int = ROWS, seed: int = 0) -> DataFrame:
    return sales_rows(spark.range(rows), "id", seed)
