"""The same queries as plain SQL, for another engine to check the results with.

needs and they become its WITH clauses.
"""

from __future__ import annotations

from tidewell.operators import generate
from tidewell.operators.quality import LOW_VOLUME_MESSAGE
from tidewell.plans.orders import PARTITIONS
from tidewell.queries.steps import (
    COUNTRY,
    DISTANCE_UNDER,
    DOMAIN,
    FARE_OVER,
    NEXT_DAY,
    ORDER_DAY,
    SLICE_DAY,
)

VIEWS = {
    "trips": """
        SELECT l_shipdate AS tpep_pickup_datetime, l_quantity - 5 AS trip_distance,
               l_extendedprice AS fare_amount, l_suppkey % 25 AS pickup_zip,
               l_partkey % 25 AS dropoff_zip
        FROM lineitem""",
    "raw": "SELECT * FROM trips WHERE trip_distance > 0.0",
    "flagged": f"""
        SELECT CAST(date_trunc('week', tpep_pickup_datetime) AS DATE) AS week, pickup_zip AS zip,
               fare_amount, trip_distance
        FROM raw
        WHERE (pickup_zip = dropoff_zip AND fare_amount > {FARE_OVER})
           OR (trip_distance < {DISTANCE_UNDER} AND fare_amount > {FARE_OVER})""",
    "weekly": """
        SELECT CAST(date_trunc('week', tpep_pickup_datetime) AS DATE) AS week,
               CAST(sum(CAST(fare_amount AS DECIMAL(28,10))) AS DOUBLE) / count(fare_amount)
                   AS avg_amount,
               CAST(sum(CAST(trip_distance AS DECIMAL(28,10))) AS DOUBLE) / count(trip_distance)
                   AS avg_distance
        FROM raw GROUP BY 1""",
    "sales": """
        SELECT l_orderkey * 10 + l_linenumber AS transaction_id,
               CAST(l_shipdate AS DATE) AS transaction_date, l_partkey AS product_id,
               l_suppkey AS store_id, CASE l_linenumber WHEN 3 THEN l_quantity / 1000 WHEN 5 THEN l_quantity + 0.125
                    ELSE l_quantity - 2 END AS quantity,
               round(l_extendedprice * 1.0001, 6) AS unit_price,
               round(l_discount / 8, 6) AS discount
        FROM lineitem""",
    "deduped": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY
                transaction_date ASC NULLS FIRST, product_id ASC NULLS FIRST,
                store_id ASC NULLS FIRST, unit_price ASC NULLS FIRST,
                quantity ASC NULLS FIRST, discount ASC NULLS FIRST) AS rn
            FROM sales) WHERE rn = 1""",
    "judged": """
        SELECT d.*,
               CAST(quantity AS DECIMAL(14,3)) * CAST(unit_price AS DECIMAL(18,6))
                    - CAST(discount AS DECIMAL(18,6)) AS correct_total,
               CASE WHEN quantity > 0 THEN CASE WHEN unit_price > 0 THEN
                    CASE WHEN s_suppkey IS NOT NULL THEN NULL ELSE 'store_id' END
                    ELSE 'unit_price' END ELSE 'quantity' END AS reject_reason
        FROM deduped d
        LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) ON store_id = s_suppkey""",
    "silver": "SELECT * EXCLUDE (reject_reason) FROM judged WHERE reject_reason IS NULL",
    "stores": """
        SELECT s_suppkey AS store_id, s_name AS store_name, r_name AS region
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "products": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category FROM part""",
    "daily": """
        SELECT transaction_date,
               sum(correct_total) AS daily_revenue
        FROM silver GROUP BY transaction_date""",
    "monthly": """
        SELECT CAST(month(transaction_date) AS BIGINT) AS month, region,
               sum(correct_total) AS monthly_revenue
        FROM silver JOIN stores USING (store_id) GROUP BY 1, 2""",
    "performance": """
        SELECT product_name, category,
               sum(correct_total) AS total_revenue
        FROM silver JOIN products USING (product_id) GROUP BY 1, 2""",
    "merge_source": """
        SELECT * EXCLUDE (discount, correct_total), discount * 2 AS discount,
               CAST(quantity AS DECIMAL(14,3)) * CAST(unit_price AS DECIMAL(18,6))
                    - CAST(discount * 2 AS DECIMAL(18,6)) AS correct_total
        FROM silver WHERE transaction_id % 3 <> 0""",
    "customers": """
        SELECT c_custkey AS customer_id, c_name AS name, n_name AS country
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "dim_customers": """
        SELECT * FROM customers WHERE customer_id % 3 <> 0
        UNION ALL
        SELECT customer_id, name, 'OLD' FROM customers
        WHERE customer_id % 2 = 0 AND customer_id % 3 = 0""",
    "staged": """
        SELECT l_orderkey AS order_id,
               CASE WHEN l_linenumber = 7 AND l_tax = 0 THEN NULL ELSE l_shipdate END
                   AS order_timestamp,
               NULLIF(l_suppkey % 50, 0) AS customer_id, NULLIF(l_partkey % 50, 0) AS product_id,
               CAST(l_quantity - 5 AS INTEGER) AS quantity, l_extendedprice AS total_amount,
               CASE l_returnflag WHEN 'N' THEN 'USD' WHEN 'A' THEN 'EUR' END AS currency,
               l_linestatus AS status
        FROM lineitem""",
    "latest": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY
                order_timestamp DESC NULLS FIRST, customer_id ASC NULLS FIRST,
                product_id ASC NULLS FIRST, quantity ASC NULLS FIRST,
                total_amount ASC NULLS FIRST, currency ASC NULLS FIRST,
                status ASC NULLS FIRST) AS rn
            FROM staged) WHERE rn = 1""",
    "fact": """
        SELECT order_id, order_timestamp AS order_timestamp_utc,
               CAST(order_timestamp AS DATE) AS order_date, customer_id, product_id, quantity,
               CASE WHEN currency = 'USD' THEN total_amount END AS total_amount_usd, currency,
               CASE WHEN currency <> 'USD' THEN TRUE ELSE FALSE END AS currency_mismatch_flag,
               status
        FROM latest
        WHERE quantity > 0 AND customer_id IS NOT NULL AND product_id IS NOT NULL""",
    "order_book": """
        SELECT o_orderkey AS order_id, o_orderdate AS order_timestamp, o_custkey AS customer_id,
               n_name AS country, o_totalprice AS amount, o_orderstatus AS status,
               CAST(o_orderdate AS DATE) AS order_date
        FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey""",
    "pos": """
        SELECT s_name AS store_name, CAST(l_shipdate AS DATE) AS date,
               CAST(l_quantity - 1 AS INTEGER) AS quantity,
               CASE WHEN l_linenumber <> 7 THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2))
                    * CAST(1.00001 AS DECIMAL(6,5)) AS DECIMAL(18,7)) END AS total,
               NULLIF(l_suppkey % 20, 0) AS customer_id,
               CASE WHEN l_returnflag <> 'R' THEN l_returnflag END AS promo_code
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "pos_distinct": "SELECT DISTINCT * FROM pos",
    "clean": """
        SELECT store_name, date, quantity,
               coalesce(total, (SELECT CAST(round(CAST(sum(total) AS DOUBLE) / count(total), 7)
                                       AS DECIMAL(18,7)) FROM pos_distinct)) AS total,
               coalesce(CAST(customer_id AS VARCHAR), 'Unknown') AS customer_id,
               coalesce(promo_code, 'No Code') AS promo_code
        FROM pos_distinct""",
}

# Which other views a view reads.
_NEEDS = {
    "raw": ["trips"],
    "flagged": ["raw"],
    "weekly": ["raw"],
    "deduped": ["sales"],
    "judged": ["deduped"],
    "silver": ["judged"],
    "daily": ["silver"],
    "monthly": ["silver", "stores"],
    "performance": ["silver", "products"],
    "merge_source": ["silver"],
    "dim_customers": ["customers"],
    "latest": ["staged"],
    "fact": ["latest"],
    "pos_distinct": ["pos"],
    "clean": ["pos_distinct"],
}


_LOW_VOLUME = f"""
            WITH counts AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n
                            FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1),
            days AS (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE)
                            AS order_date FROM counts)
            SELECT order_date, coalesce(n, 0) AS order_count, CAST(3 AS BIGINT) AS threshold,
                   '{LOW_VOLUME_MESSAGE}' AS message
            FROM days LEFT JOIN counts ON d = order_date WHERE coalesce(n, 0) < 3"""


def _sql(select: str, *views: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for other in _NEEDS.get(name, []):
            add(other)
        if name not in order:
            order.append(name)

    for name in views:
        add(name)
    if not order:
        return select
    return "WITH " + ",\n".join(f"{name} AS ({VIEWS[name]})" for name in order) + "\n" + select


def _null_count(column: str, view: str) -> str:
    return f"""SELECT '{column}' AS "column", count(*) - count("{column}") AS n_null FROM {view}"""


def _generated() -> str:
    """One md5 per id; each choice takes four hex digits of its own."""

    def draw(i: int) -> str:
        return f"CAST('0x' || substr(h, {1 + 4 * i}, 4) AS INTEGER)"

    def choice(values: list, i: int) -> str:
        listed = ", ".join("NULL" if v is None else repr(v) for v in values)
        return f"([{listed}])[{draw(i)} % {len(values)} + 1]"

    price = choice([float(p[2]) for p in generate.PRODUCTS], 2)
    return f"""
        WITH size AS (SELECT max(l_orderkey * 10 + l_linenumber) AS last, count(*) AS n
                      FROM lineitem),
        ids AS (
            SELECT unnest(range(n)) + last + 1 AS id FROM size
            UNION ALL
            SELECT i * 100 + last + 1 + CAST('0x' || substr(md5('copy:' || i || ':42'), 1, 8) AS BIGINT)
                   % CASE WHEN i = n // 100 - 1 THEN 100 + n % 100 ELSE 100 END
            FROM (SELECT unnest(range(n // 100)) AS i, n, last FROM size)),
        hashed AS (SELECT id, md5(CAST(id AS VARCHAR) || ':42') AS h FROM ids)
        SELECT id AS transaction_id,
               {choice([s[0] for s in generate.STORES], 1)} AS store_id,
               {choice([s[1] for s in generate.STORES], 1)} AS store_name,
               CAST('{generate.FIRST_DAY}' AS DATE) + {draw(0)} % {generate.DAYS} AS date,
               {choice([p[0] for p in generate.PRODUCTS], 2)} AS product_id,
               {choice([p[1] for p in generate.PRODUCTS], 2)} AS product_name,
               {draw(3)} % {generate.MAX_QUANTITY} + 1 AS quantity,
               CAST({price} AS DOUBLE) AS unit_price,
               CAST(CAST(({draw(3)} % {generate.MAX_QUANTITY} + 1)
                    * CAST({price} AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS DOUBLE) AS total,
               CASE WHEN {draw(4)} % 1000 >= {generate.MISSING_CUSTOMERS_PER_1000}
                    THEN {draw(5)} % {generate.CUSTOMERS} + {generate.FIRST_CUSTOMER} END
                   AS customer_id,
               {choice(generate.PROMO_CODES, 6)} AS promo_code
        FROM hashed
        UNION ALL
        SELECT l_orderkey * 10 + l_linenumber, l_suppkey, 'Store ' || l_suppkey, CAST(l_shipdate AS DATE),
               l_partkey, 'Product ' || l_partkey, CAST(l_quantity AS INTEGER),
               CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE),
               CAST(CAST(CAST(l_quantity AS INTEGER) * CAST(l_extendedprice AS DECIMAL(18,2))
                    AS DECIMAL(18,2)) AS DOUBLE), NULL, NULL
        FROM lineitem"""


_POS_TYPES = {
    "store_name": "string",
    "date": "date",
    "quantity": "int",
    "total": "decimal(18,7)",
    "customer_id": "bigint",
    "promo_code": "string",
}
# Decimals up to here; the other engine shows them as DOUBLE.
_SHOWN = "* REPLACE (CAST(correct_total AS DOUBLE) AS correct_total)"
_POS = "SELECT * REPLACE (CAST(total AS DOUBLE) AS total) FROM pos"
_HIT = f"country = '{COUNTRY}' AND status = 'O'"


def all_oracles() -> dict[str, str]:
    return {
        "stream_ingest_expect": _sql("SELECT * FROM raw", "raw"),
        "stream_flagged_rides": _sql("SELECT * FROM flagged", "flagged"),
        "expectation_counts": _sql(
            """SELECT count(*) AS n_in,
                      count(*) - count(*) FILTER (WHERE trip_distance > 0.0) AS n_dropped,
                      count(*) FILTER (WHERE trip_distance > 0.0) AS n_kept FROM trips""",
            "trips",
        ),
        "flagged_rides": _sql("SELECT * FROM flagged", "flagged"),
        "weekly_stats": _sql("SELECT * FROM weekly ORDER BY week", "weekly"),
        "top_n_rides": _sql(
            """SELECT week, round(avg_amount, 2) AS avg_amount,
                      round(avg_distance, 3) AS avg_distance, fare_amount, trip_distance, zip
               FROM flagged LEFT JOIN weekly USING (week)
               ORDER BY fare_amount DESC NULLS LAST, week, zip, trip_distance LIMIT 3""",
            "flagged",
            "weekly",
        ),
        "bronze_enrich": _sql("SELECT *, 'manual_csv' AS source_system FROM sales", "sales"),
        "silver_dedup": _sql("SELECT * FROM deduped", "deduped"),
        "silver_valid": _sql(f"SELECT {_SHOWN} FROM silver", "silver"),
        "silver_quarantine": _sql(
            f"SELECT {_SHOWN} FROM judged WHERE reject_reason IS NOT NULL", "judged"
        ),
        "merge_upsert": _sql(
            f"""SELECT {_SHOWN} FROM silver t WHERE transaction_id % 2 = 0 AND NOT EXISTS (
                   SELECT 1 FROM merge_source s WHERE s.transaction_id = t.transaction_id)
               UNION ALL BY NAME SELECT {_SHOWN} FROM merge_source""",
            "merge_source",
        ),
        "gold_daily_sales": _sql("SELECT * REPLACE (CAST(daily_revenue AS DOUBLE) AS daily_revenue) FROM daily ORDER BY transaction_date", "daily"),
        "gold_monthly_region": _sql("SELECT * REPLACE (CAST(monthly_revenue AS DOUBLE) AS monthly_revenue) FROM monthly", "monthly"),
        "gold_product_performance": _sql("SELECT * REPLACE (CAST(total_revenue AS DOUBLE) AS total_revenue) FROM performance", "performance"),
        "gold_reconcile": _sql(
            """SELECT "table", CAST(gold_total AS DOUBLE) AS gold_total, CAST(silver_total AS DOUBLE) AS silver_total,
                      CAST(gold_total - silver_total AS DOUBLE) AS diff FROM (
                   SELECT 'daily_sales' AS "table",
                          sum(daily_revenue) AS gold_total
                   FROM daily
                   UNION ALL
                   SELECT 'monthly_region',
                          sum(monthly_revenue) FROM monthly
                   UNION ALL
                   SELECT 'product_performance',
                          sum(total_revenue)
                   FROM performance),
               (SELECT sum(correct_total) AS silver_total
                FROM silver)""",
            "daily",
            "monthly",
            "performance",
        ),
        "report_total_revenue": _sql(
            """SELECT CAST(sum(daily_revenue) AS DOUBLE) AS total_revenue
               FROM daily""",
            "daily",
        ),
        "report_top_products": _sql(
            """SELECT * REPLACE (CAST(total_revenue AS DOUBLE) AS total_revenue) FROM performance
               ORDER BY total_revenue DESC NULLS LAST, product_name, category LIMIT 10""",
            "performance",
        ),
        "report_category_revenue": _sql(
            """SELECT category,
                      CAST(sum(total_revenue) AS DOUBLE) AS revenue
               FROM performance GROUP BY category""",
            "performance",
        ),
        "dim_customers_upsert": _sql("SELECT * FROM dim_customers", "dim_customers"),
        "dim_products_upsert": """
            SELECT p_partkey AS product_id, p_name AS product_name,
                   CASE WHEN p_partkey % 3 <> 0 THEN p_type ELSE 'OLD' END AS category,
                   p_retailprice AS unit_price
            FROM part WHERE p_partkey % 3 <> 0 OR p_partkey % 2 = 0""",
        "latest_order": _sql("SELECT * FROM latest", "latest"),
        "fact_orders": _sql("SELECT * FROM fact", "fact"),
        "fact_orders_slice": _sql(
            f"""SELECT * FROM fact WHERE order_date IS DISTINCT FROM DATE '{SLICE_DAY}'
                UNION ALL
                SELECT * REPLACE (quantity * 2 AS quantity) FROM fact
                WHERE order_date = DATE '{SLICE_DAY}'
                UNION ALL
                SELECT * REPLACE (-1 - order_id AS order_id, quantity * 2 AS quantity) FROM fact
                WHERE order_date = DATE '{NEXT_DAY}'""",
            "fact",
        ),
        "dq_report": _sql(
            """SELECT *, bad_count = 0 AS passed FROM (
                   SELECT 'dim_customers_not_empty' AS "check",
                          CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS bad_count FROM dim_customers
                   UNION ALL
                   SELECT 'fact_orders_not_null_keys',
                          count(*) FILTER (WHERE customer_id IS NULL OR product_id IS NULL)
                   FROM fact
                   UNION ALL
                   SELECT 'fact_orders_rowcount_match', count(*) FROM (
                       SELECT CAST(order_timestamp AS DATE) AS d, count(*) AS n FROM latest
                       WHERE quantity > 0 AND customer_id IS NOT NULL AND product_id IS NOT NULL
                       GROUP BY 1) v
                   FULL JOIN (SELECT order_date AS d, count(*) AS n FROM fact GROUP BY 1) f
                   ON v.d IS NOT DISTINCT FROM f.d WHERE v.n IS DISTINCT FROM f.n)""",
            "dim_customers",
            "fact",
        ),
        "dq_rowcount_match": _sql(
            """SELECT coalesce(v.order_date, f.order_date) AS order_date,
                      coalesce(valid_count, 0) AS valid_count, coalesce(fact_count, 0) AS fact_count,
                      coalesce(valid_count, 0) = coalesce(fact_count, 0) AS passed
               FROM (SELECT CAST(order_timestamp AS DATE) AS order_date, count(*) AS valid_count
                     FROM latest
                     WHERE quantity > 0 AND customer_id IS NOT NULL AND product_id IS NOT NULL
                     GROUP BY 1) v
               FULL JOIN (SELECT order_date, count(*) AS fact_count FROM fact GROUP BY 1) f
               ON v.order_date IS NOT DISTINCT FROM f.order_date""",
            "fact",
        ),
        "low_volume_days": _LOW_VOLUME,
        "stored_low_volume_summary": _LOW_VOLUME,
        "pruned_orders": _sql(
            f"""SELECT * FROM order_book
                WHERE country = '{COUNTRY}' AND order_date = DATE '{ORDER_DAY}'""",
            "order_book",
        ),
        "partition_inventory": _sql(
            f"""SELECT {', '.join(PARTITIONS)}, count(*) AS n_rows FROM order_book
                GROUP BY {', '.join(PARTITIONS)}""",
            "order_book",
        ),
        "update_where": _sql(
            f"""SELECT * REPLACE (CASE WHEN {_HIT} THEN 'P' ELSE status END AS status)
                FROM order_book""",
            "order_book",
        ),
        "delete_where": _sql(
            "SELECT * FROM order_book WHERE amount >= 5000 OR amount IS NULL", "order_book"
        ),
        "schema_evolve_append": _sql(
            """SELECT *, CAST(NULL AS VARCHAR) AS payment_method,
                      CAST(NULL AS VARCHAR) AS coupon_code FROM order_book
               UNION ALL BY NAME
               SELECT -1 AS order_id, TIMESTAMP '2024-05-17 16:45:10' AS order_timestamp,
                      -7 AS customer_id, 'Iceland' AS country, 42.75 AS amount, 'F' AS status,
                      DATE '2024-05-17' AS order_date, 'voucher' AS payment_method,
                      'MAY' AS coupon_code
               UNION ALL BY NAME
               SELECT -2 AS order_id, TIMESTAMP '2024-06-02 08:05:00' AS order_timestamp,
                      -8 AS customer_id, 'Peru' AS country, 1310.0 AS amount, 'O' AS status,
                      DATE '2024-06-02' AS order_date, NULL AS payment_method,
                      'JUNE' AS coupon_code""",
            "order_book",
        ),
        "as_of_version": _sql(
            f"""SELECT order_id, country, CASE WHEN {_HIT} THEN 'P' ELSE status END AS status
                FROM order_book""",
            "order_book",
        ),
        "table_history": _sql(
            f"""SELECT 0 AS version, 'WRITE' AS operation, count(*) AS n_rows FROM order_book
                UNION ALL SELECT 1, 'UPDATE', count(*) FILTER (WHERE {_HIT}) FROM order_book
                UNION ALL SELECT 2, 'DELETE', count(*) FILTER (WHERE amount < 5000)
                FROM order_book""",
            "order_book",
        ),
        "filter_store": _sql(f"{_POS} WHERE store_name = 'Supplier#000000007'", "pos"),
        "filter_date_range": _sql(
            f"{_POS} WHERE date BETWEEN DATE '1997-02-01' AND DATE '1997-03-15'", "pos"
        ),
        "filter_high_value": _sql(f"{_POS} WHERE total > 50000", "pos"),
        "dedup_rows": _sql(
            """SELECT DISTINCT * REPLACE (CAST(total AS DOUBLE) AS total)
               FROM (SELECT * FROM pos UNION ALL SELECT * FROM pos)""",
            "pos",
        ),
        "clean_sales": _sql(_POS.replace("FROM pos", "FROM clean"), "clean"),
        "derive_fields": _sql(
            """SELECT * REPLACE (CAST(total AS DOUBLE) AS total),
                      CASE WHEN quantity <> 0 THEN CAST(total AS DOUBLE) / quantity END AS revenue_per_item,
                      CAST(month(date) AS BIGINT) AS month, dayname(date) AS day_of_week
               FROM clean""",
            "clean",
        ),
        "sales_stats": _sql(
            """SELECT round(CAST(sum(total) AS DOUBLE) / count(total), 4) AS mean,
                      round(median(CAST(total AS DOUBLE)), 4) AS median,
                      round(CAST(sum(total) AS DOUBLE), 4) AS sum,
                      round(CAST(sum(total) AS DOUBLE) / count(total), 4) AS average_basket
               FROM clean""",
            "clean",
        ),
        "total_by_store": _sql(
            """SELECT store_name, CAST(sum(total) AS DOUBLE) AS total
               FROM clean WHERE store_name IS NOT NULL GROUP BY store_name""",
            "clean",
        ),
        "null_counts": _sql(
            " UNION ALL ".join(_null_count(c, "pos") for c in _POS_TYPES), "pos"
        ),
        "id_range": _sql(
            "SELECT min(transaction_id) AS min_id, max(transaction_id) AS max_id FROM sales",
            "sales",
        ),
        "table_shape": _sql(
            f"SELECT count(*) AS n_rows, CAST({len(_POS_TYPES)} AS BIGINT) AS n_cols FROM pos", "pos"
        ),
        "table_info": _sql(
            " UNION ALL ".join(
                f"""SELECT '{c}' AS "column", '{t}' AS "type", count("{c}") AS n_non_null FROM pos"""
                for c, t in _POS_TYPES.items()
            ),
            "pos",
        ),
        "describe_categorical": """
            WITH counts AS (SELECT event_type, count(*) AS n FROM events
                            WHERE event_type IS NOT NULL GROUP BY 1)
            SELECT CAST((SELECT sum(n) FROM counts) AS BIGINT) AS "count",
                   (SELECT count(*) FROM counts) AS "unique", event_type AS top, n AS freq
            FROM counts ORDER BY n DESC, event_type LIMIT 1""",
        "closed_domain": f"""
            SELECT event_id, CASE WHEN event_type IN ({', '.join(map(repr, DOMAIN))})
                                  THEN event_type END AS cat FROM events""",
        "trim_fields": "SELECT c_custkey, trim('  ' || c_name || ' ') AS c_name FROM customer",
        "except_rows": """
            SELECT p_partkey AS key FROM part
            EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 45""",
        "union_all": """
            SELECT p_partkey AS key FROM part
            UNION ALL SELECT l_partkey FROM lineitem WHERE l_quantity > 45""",
        "preview_first_n": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10",
        "preview_last_n": "SELECT * FROM orders ORDER BY o_orderkey DESC LIMIT 10",
        "shuffled_sales": _sql("SELECT * FROM sales", "sales"),
        "stored_csv_strings": """
            SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer""",
        "stored_csv_inferred": """
            SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS day
            FROM orders""",
        "stored_csv_positional": """
            SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 10 <> 0""",
        "stored_csv_rejected": """
            SELECT count(*) AS n_rejected FROM customer WHERE c_custkey % 10 = 0""",
        "stored_json_lines": _sql(
            "SELECT * REPLACE (CAST(order_id AS VARCHAR) AS order_id) FROM staged", "staged"
        ),
        "stored_bronze_appended": _sql(
            "SELECT *, 'manual_csv' AS source_system FROM sales UNION ALL "
            "SELECT *, 'manual_csv' AS source_system FROM sales",
            "sales",
        ),
        "stored_new_columns": """
            SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END
                   AS o_orderpriority FROM orders""",
        "stored_partition_scan": _sql(
            f"SELECT * FROM order_book WHERE country = '{COUNTRY}' AND status = 'O'", "order_book"
        ),
        "stored_partition_counts": _sql(
            "SELECT country, status, count(*) AS n_rows FROM order_book GROUP BY 1, 2", "order_book"
        ),
        "stored_quarantine": _sql(f"SELECT {_SHOWN} FROM judged WHERE reject_reason IS NOT NULL", "judged"),
        "stored_compacted": _sql("SELECT * FROM order_book", "order_book"),
        "stored_small_files_compacted": _sql("SELECT * FROM order_book", "order_book"),
        "stored_clustered": _sql("SELECT * FROM order_book", "order_book"),
        "stored_merge": _sql(
            f"""SELECT * FROM order_book WHERE order_id % 5 <> 0 OR country <> '{COUNTRY}'
                UNION ALL
                SELECT * REPLACE (amount * 2 AS amount) FROM order_book
                WHERE order_id % 5 = 0 AND country = '{COUNTRY}'
                UNION ALL
                SELECT * REPLACE (-1 - order_id AS order_id, amount * 2 AS amount) FROM order_book
                WHERE order_id % 5 = 0 AND country = '{COUNTRY}'""",
            "order_book",
        ),
        "stored_changes": _sql(
            f"""SELECT * FROM (
                    SELECT * REPLACE (CASE WHEN country = '{COUNTRY}' AND customer_id % 2 = 0 THEN amount + 1
                                           ELSE amount END AS amount) FROM order_book)
                WHERE amount >= 5000 OR amount IS NULL""",
            "order_book",
        ),
        "audit_trail": _sql(
            """SELECT 'silver' AS pipeline_layer, event_type, record_count, status,
                      CAST(NULL AS VARCHAR) AS error_message
               FROM (SELECT 'START' AS event_type, 0 AS record_count, 'RUNNING' AS status
                     UNION ALL SELECT 'END', count(*), 'SUCCESS' FROM silver
                     UNION ALL SELECT 'REJECTED', count(*), 'SUCCESS' FROM judged
                     WHERE reject_reason IS NOT NULL)""",
            "silver",
        ),
        "stored_silver_merged": _sql(
            f"""SELECT {_SHOWN} FROM merge_source
                UNION ALL BY NAME
                SELECT {_SHOWN} FROM silver WHERE transaction_id % 6 = 0""",
            "merge_source",
        ),
        "stored_silver_incremental": _sql(
            f"""SELECT {_SHOWN} FROM merge_source
                UNION ALL BY NAME
                SELECT {_SHOWN} FROM silver WHERE transaction_id % 6 = 0""",
            "merge_source",
        ),
        "stored_managed_table": _sql("SELECT * FROM order_book", "order_book"),
        "stored_registered_folder": _sql("SELECT * FROM order_book", "order_book"),
        "stored_staging_reloaded": """
            SELECT CAST(c_custkey AS INTEGER) AS customer_id, c_name AS first_name, 'x' AS last_name,
                   c_custkey || '@x.org' AS email, DATE '2024-01-05' AS signup_date, n_name AS country
            FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 2 = 1""",
        "run_properties": """
            SELECT 'bronze' AS "table", count(*) AS n_rows, CAST(0 AS BIGINT) AS n_without_time,
                   CAST(1 AS BIGINT) AS n_marks FROM lineitem
            UNION ALL SELECT 'log', 2, 0, 1""",
        "stream_expectation_counts": _sql(
            """SELECT count(*) AS n_in,
                      count(*) - count(*) FILTER (WHERE trip_distance > 0.0) AS n_dropped FROM trips""",
            "trips",
        ),
        "generate_sales": _generated(),
    }
