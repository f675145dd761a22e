import datetime as dt
from decimal import Decimal

import pytest
from helpers import rows
from pyspark.sql import types as T

from tidewell import sources
from tidewell.plans.warehouse import CUSTOMER_SCHEMA, ORDER_SCHEMA, PRODUCT_SCHEMA


def put(path, text):
    path.write_text(text)
    return str(path)


def test_dated_path():
    expected = "/in/customers/customers_20250203.csv"
    assert sources.dated_path("/in", "customers", "2025-02-03", "csv") == expected
    assert sources.dated_path("/in", "customers", dt.date(2025, 2, 3), "csv") == expected


def test_inferred_types(spark, tmp_path):
    path = put(tmp_path / "o.csv", "id,at,amount\nO-1,2025-11-01T10:07:00Z,1.5\n")
    assert dict(sources.read_csv_inferred(spark, path).dtypes) == {
        "id": "string",
        "at": "timestamp",
        "amount": "double",
    }


def test_all_strings(spark, tmp_path):
    path = put(tmp_path / "s.csv", "id,quantity\nT1,2\nT2,x\n")
    df = sources.read_csv_strings(spark, path)
    assert df.dtypes == [("id", "string"), ("quantity", "string")]
    assert rows(df) == [("T1", "2"), ("T2", "x")]


@pytest.mark.parametrize("schema", [None, "day string, n int"])
def test_date_column(spark, tmp_path, schema):
    path = put(tmp_path / "d.csv", "day,n\n2025-01-02,1\n")
    df = sources.read_csv_with_date(spark, path, "day", schema)
    assert rows(df) == [(dt.date(2025, 1, 2), 1)]


CUSTOMERS = """customer_id,first_name,last_name,email,signup_date,country
1, Ann ,\tLee,ann@x.org,2024-01-05, US
2,Bo,Ray,bo@x.org,2024-01-06,IN

3,Five,Fields,c@x.org,2024-01-07
4,Seven,Fields,d@x.org,2024-01-07,US,extra
5,"Quoted, Comma",X,e@x.org,2024-01-07,US
6,Empty,,,2024-01-08,
"""


def test_positional_skips_other_field_counts(spark, tmp_path):
    path = put(tmp_path / "c.csv", CUSTOMERS)
    df = sources.read_csv_positional(spark, path, CUSTOMER_SCHEMA)
    assert rows(df) == [
        (1, "Ann", "Lee", "ann@x.org", dt.date(2024, 1, 5), "US"),
        (2, "Bo", "Ray", "bo@x.org", dt.date(2024, 1, 6), "IN"),
        (6, "Empty", "", "", dt.date(2024, 1, 8), ""),
    ]
    assert rows(sources.rejected_lines(spark, path, CUSTOMER_SCHEMA)) == [(4,)]
    # The count does not depend on the columns asked for.
    assert df.count() == df.select("country").count() == 3


def test_positional_takes_the_first_line_of_each_file_as_header(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    put(folder / "a.csv", "nr,what,kind,price\n1,Pen,Desk,1\n2,\"Cup,Desk,2\n")
    put(folder / "b.csv", "x\n1,Pen,Desk,1\n \n3,4\n")
    put(folder / "c.csv", "product_id,product_name,category,unit_price\n")
    df = sources.read_csv_positional(spark, str(folder), PRODUCT_SCHEMA)
    price = Decimal("1.00")
    assert rows(df) == [(1, "Pen", "Desk", price), (1, "Pen", "Desk", price), (2, '"Cup', "Desk", price * 2)]
    assert rows(sources.rejected_lines(spark, str(folder), PRODUCT_SCHEMA)) == [(2,)]


def test_positional_keeps_a_data_line_that_equals_the_header(spark, tmp_path):
    schema = T.StructType().add("a", "string").add("b", "string")
    path = put(tmp_path / "same.csv", "a,b\na,b\nc,d\n")
    assert rows(sources.read_csv_positional(spark, path, schema)) == [("a", "b"), ("c", "d")]


def test_positional_header_spelling_and_bad_value(spark, tmp_path):
    path = put(tmp_path / "p.csv", "Product_ID, product_name,category ,unit_price\r\n7,Pen,Desk,1.005\r\n")
    df = sources.read_csv_positional(spark, path, PRODUCT_SCHEMA)
    assert rows(df) == [(7, "Pen", "Desk", Decimal("1.01"))]
    bad = put(tmp_path / "b.csv", "product_id,product_name,category,unit_price\nseven,Pen,Desk,1\n")
    with pytest.raises(Exception, match="product_id is no int"):
        sources.read_csv_positional(spark, bad, PRODUCT_SCHEMA).collect()


def test_json_lines(spark, tmp_path):
    text = (
        '{"order_id": "A", "order_timestamp": "2025-01-01T10:00:00", "customer_id": 1, '
        '"product_id": "2", "quantity": 3, "total_amount": 9.99, "currency": "USD", "status": "NEW"}\n'
        "\n   \n \t \n"
        '\t{"order_id": "B", "colour": "red", "nested": [{"a": 1}, {"b": 2}]} \t\n'
    )
    found = sources.read_json_lines(spark, put(tmp_path / "o.json", text), ORDER_SCHEMA)
    assert found.schema == ORDER_SCHEMA
    at = dt.datetime(2025, 1, 1, 10)
    assert rows(found) == [
        ("A", at, 1, 2, 3, Decimal("9.99"), "USD", "NEW"),
        ("B", None, None, None, None, None, None, None),
    ]


@pytest.mark.parametrize(
    "line",
    [
        '{"order_id": ',
        '{"order_id": "A"} x',
        '{"order_id": "A"}{"order_id": "B"}',
        '{"order_id": "A"}, {"order_id": "B"}',
        '{"order_id": "A"}]',
        '[{"order_id": "A"}]',
        "[",
        "5",
        "null",
        '"text"',
    ],
)
def test_broken_json_fails(spark, tmp_path, line):
    path = put(tmp_path / "x.json", '{"order_id": "A"}\n' + line + "\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        sources.read_json_lines(spark, path, ORDER_SCHEMA).collect()


def test_ensure_table_keeps_rows(spark, folder):
    schema = T.StructType().add("a", "integer")
    path = f"{folder}/t"
    sources.ensure_table(spark, path, schema)
    assert sources.read_path(spark, path).schema == schema
    sources.inline_rows(spark, [(1,)], schema).write.mode("append").parquet(path)
    sources.ensure_table(spark, path, schema)
    assert rows(sources.read_path(spark, path)) == [(1,)]


def test_row_position_is_unique(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    places = orders.select(*sources.row_position())
    assert places.distinct().count() == orders.count()
