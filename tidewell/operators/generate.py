"""Made-up sales rows.

Every choice is cut from one hash of the row's id and the seed. A row is thus a
function of its id: it does not matter which task makes it, and a row can be made
again, which is how the copies are made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The choices the rows are drawn from.
STORES = [(1, "Downtown"), (2, "Suburb"), (3, "Airport"), (4, "Mall"), (5, "University")]
PRODUCTS = [
    (501, "Notebook", "3.50"),
    (502, "Pen", "0.80"),
    (503, "Stapler", "5.25"),
    (504, "Folder", "1.20"),
    (505, "Marker", "1.75"),
    (506, "Highlighter", "0.90"),
    (507, "Scissors", "4.50"),
    (508, "Tape", "2.25"),
    (509, "Glue", "1.80"),
    (510, "Eraser", "0.50"),
]
PROMO_CODES = ["DISC10", "DISC5", "SAVE20", "WELCOME", None, None, None]
FIRST_DAY = "2025-01-01"
DAYS = 365
MAX_QUANTITY = 10
FIRST_CUSTOMER, CUSTOMERS = 2001, 100
MISSING_CUSTOMERS_PER_1000 = 50
ROWS_PER_COPY = 100


def _draws(seed: int) -> dict[str, Column]:
    digest = F.md5(F.concat_ws(":", F.col("id").cast("string"), F.lit(str(seed))))
    names = ["day", "store", "product", "quantity", "missing", "customer", "promo"]
    # md5 has 32 hex digits; each choice takes 4 of its own.
    return {
        name: F.conv(F.substring(digest, 1 + 4 * i, 4), 16, 10).cast("int")
        for i, name in enumerate(names)
    }


def _choice(values: list, type_name: str, index: Column) -> Column:
    options = F.array(*[F.lit(v).cast(type_name) for v in values])
    return options[index % len(values)]


def sales_rows(ids: DataFrame, seed: int) -> DataFrame:
    """The sales row of every ``id``."""
    draw = _draws(seed)
    customer = F.when(
        draw["missing"] % 1000 >= MISSING_CUSTOMERS_PER_1000,
        draw["customer"] % CUSTOMERS + FIRST_CUSTOMER,
    )
    rows = ids.select(
        F.col("id").alias("transaction_id"),
        _choice([s[0] for s in STORES], "int", draw["store"]).alias("store_id"),
        _choice([s[1] for s in STORES], "string", draw["store"]).alias("store_name"),
        F.date_add(F.lit(FIRST_DAY).cast("date"), draw["day"] % DAYS).alias("date"),
        _choice([p[0] for p in PRODUCTS], "int", draw["product"]).alias("product_id"),
        _choice([p[1] for p in PRODUCTS], "string", draw["product"]).alias("product_name"),
        (draw["quantity"] % MAX_QUANTITY + 1).alias("quantity"),
        _choice([p[2] for p in PRODUCTS], "decimal(18,2)", draw["product"]).alias("unit_price"),
        customer.alias("customer_id"),
        _choice(PROMO_CODES, "string", draw["promo"]).alias("promo_code"),
    )
    total = (F.col("quantity") * F.col("unit_price")).cast("decimal(18,2)")
    ordered = [*rows.columns[:8], "total", *rows.columns[8:]]
    return rows.withColumn("total", total).select(*ordered)


def generate_sales(spark: SparkSession, after_id: int, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows with ids after ``after_id``, and copies of 1 % of them.

    One row of each hundred is drawn by the seed, the last draw being from all
    that are left, so the copied rows are all different and lie all over the
    table. No sort, join or sample of the rows is needed.
    """
    n_copies = n // ROWS_PER_COPY
    first = F.lit(after_id + 1)
    fresh = spark.range(n).select((F.col("id") + first).alias("id"))
    digest = F.md5(F.concat_ws(":", F.lit("copy"), F.col("id").cast("string"), F.lit(str(seed))))
    drawn = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    last = F.col("id") == n_copies - 1
    choices = F.when(last, F.lit(ROWS_PER_COPY + n % ROWS_PER_COPY)).otherwise(ROWS_PER_COPY)
    place = F.col("id") * ROWS_PER_COPY + drawn % choices
    copied = spark.range(n_copies).select((place + first).alias("id"))
    return sales_rows(fresh.union(copied), seed)
