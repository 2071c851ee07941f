"""Files and catalog tables: round trips, guards, plans."""

import datetime as dt
import glob

import os

import pytest
from pyspark.sql import functions as F

from tallyframe import schemas
from tallyframe.operators.insights import run_sql
from tallyframe.plans.inspect import describe_shape, plan_text
from tallyframe.plans import lineage
from tallyframe.sources import catalog, files

ROWS = [(1, 1, "Pen", "Office", 2, 1.5, dt.date(2023, 1, 12)),
        (2, 1, "Ink", "Office", 1, 9.0, dt.date(2023, 2, 1))]


@pytest.fixture
def orders(spark):
    return files.from_rows(spark, ROWS, schemas.ORDERS)


def same(a, b):
    return sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_parquet(spark, orders, tmp_path):
    path = str(tmp_path / "p")
    files.write_parquet(orders, path)
    files.write_parquet(orders, path)
    back = files.read_parquet(spark, path)
    assert same(back, orders) and back.schema == orders.schema


def test_parquet_by_month(spark, orders, tmp_path):
    path = str(tmp_path / "m")
    files.write_parquet(orders.withColumn("month", F.date_format("order_date", "yyyy-MM")), path,
                        partition_by=("month",))
    january = files.read_parquet(spark, path).filter("month = '2023-01'")
    assert january.count() == 1 and len(january.inputFiles()) >= 1
    assert len(glob.glob(path + "/month=*")) == 2


def test_csv(spark, orders, tmp_path):
    path = str(tmp_path / "c.csv")
    files.write_csv(orders, path)
    assert same(files.read_csv(spark, path, schemas.ORDERS), orders)
    assert dict(files.read_csv(spark, path).dtypes)["price"] == "double"
    with pytest.raises(Exception):
        files.write_csv(orders, path)
    files.write_csv(orders, path, mode="overwrite")


def test_malformed_csv_fails(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("order_id,customer_id,product,category,quantity,price,order_date\n"
                    "x,1,Pen,Office,2,1.5,2023-01-12\n")
    with pytest.raises(Exception):
        files.read_csv(spark, str(path), schemas.ORDERS).collect()
    kept = files.read_csv(spark, str(path), schemas.ORDERS, mode="PERMISSIVE").collect()
    assert kept[0].order_id is None and kept[0].product == "Pen"


def test_text_pairs(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("Pen", 3), ("Ink", 4)], "k string, v int")
    files.write_pairs(df, path, "k", "v")
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["(Ink, 4)", "(Pen, 3)"]


def test_sheets(spark, orders, tmp_path):
    a, b = str(tmp_path / "a.csv"), str(tmp_path / "b")
    files.write_csv(orders, a)
    files.write_parquet(orders, b)
    sheets = files.read_sheets(spark, {"one": a, "two": b}, {"one": schemas.ORDERS})
    assert same(sheets["one"], sheets["two"])


def test_header_must_fit_the_schema(spark, tmp_path):
    path = str(tmp_path / "swapped.csv")
    spark.createDataFrame([("USA", "Ann")], "country string, name string").write.option("header", True).csv(path)
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, path, spark.createDataFrame([], "name string, country string").schema).collect()


def test_scratch_is_empty_after_a_job(spark):
    folder = lineage.scratch_dir(spark).removeprefix("file:")
    lineage.materialize(spark.range(3)).count()
    assert os.listdir(folder)
    lineage.drop_scratch(spark)
    assert not os.listdir(folder)
    assert lineage.materialize(spark.range(3)).count() == 3


def test_snapshot_refuses_the_path_it_reads(spark, orders, tmp_path):
    old, new = str(tmp_path / "v1"), str(tmp_path / "v2")
    files.write_parquet(orders, old)
    changed = files.read_parquet(spark, old).withColumn("quantity", F.col("quantity") + 1)
    with pytest.raises(ValueError):
        files.write_snapshot(changed, old)
    assert files.write_snapshot(changed, new).agg(F.sum("quantity")).first()[0] == 5
    assert files.read_parquet(spark, old).agg(F.sum("quantity")).first()[0] == 3


def test_catalog_life(spark, orders):
    catalog.drop_if_present(spark, "shop_orders")
    assert catalog.create_if_absent(spark, "shop_orders", schemas.ORDERS)
    assert not catalog.create_if_absent(spark, "shop_orders", schemas.ORDERS)
    catalog.append_by_name(orders.select("price", "order_id"), "shop_orders")
    catalog.append_by_name(orders, "shop_orders")
    rows = spark.table("shop_orders")
    assert rows.count() == 4 and rows.filter("product is null").count() == 2
    assert rows.filter("order_id = 2").agg(F.min("price")).first()[0] == 9.0
    with pytest.raises(ValueError):
        catalog.append_by_name(orders.withColumn("extra", F.lit(1)), "shop_orders")
    assert catalog.peek_table(spark, "shop_orders", 3).count() == 3
    catalog.drop_if_present(spark, "shop_orders")
    catalog.drop_if_present(spark, "shop_orders")
    assert not spark.catalog.tableExists("shop_orders")


def test_create_as_select_and_clone(spark, orders):
    catalog.drop_if_present(spark, "shop_copy")
    catalog.save_table(orders.filter("quantity > 1"), "shop_copy")
    assert spark.table("shop_copy").count() == 1
    with pytest.raises(Exception):
        catalog.save_table(orders, "shop_copy")
    empty = catalog.empty_clone(orders)
    assert empty.count() == 0 and empty.schema == orders.schema
    catalog.drop_if_present(spark, "shop_copy")


def test_views_and_sql(spark, orders):
    catalog.register_views({"shop": orders})
    assert spark.sql("SELECT count(*) AS n FROM shop").first().n == 2
    assert run_sql(spark, "SELECT 1 AS one").first().one == 1
    spark.catalog.dropTempView("shop")


def test_shape(orders):
    shape = describe_shape(orders, 1)
    assert shape["rows"] == 2 and len(shape["sample"]) == 1
    assert shape["columns"][0] == ("order_id", "int")


def test_bucketed_tables_join_without_a_shuffle(spark):
    for name in ("bucket_lines", "bucket_heads"):
        catalog.drop_if_present(spark, name)
    lines = spark.range(400).select((F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    catalog.save_table(lines, "bucket_lines", bucket_by=(4, ["k"]))
    catalog.save_table(lines.select("k").distinct(), "bucket_heads", bucket_by=(4, ["k"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = spark.table("bucket_lines").join(spark.table("bucket_heads"), "k")
        totals = joined.groupBy("k").agg(F.sum("v"))
        assert "Exchange" not in plan_text(totals) and totals.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for name in ("bucket_lines", "bucket_heads"):
        catalog.drop_if_present(spark, name)


HEAD = "order_id,customer_id,product,category,quantity,price,order_date"


def test_intake_sets_aside_what_does_not_fit(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    good = [f"{i},1,Pen,Office,2,1.5,2023-01-12" for i in range(300)]
    one = [HEAD, *good[:5], "x,1,Pen,Office,2,1.5,2023-01-12", '6,1,"Pen, red",Office,2,1.5,2023-01-12', "7,1,Pen", "", "8,1,Pen,Office,2,1.5,2023-01-12,more", *good[10:13]]
    two = [HEAD, *good[100:280], HEAD, "9,1,Pen,Office,2,1.5,2023-02-30", *good[280:290]]
    (folder / "one.csv").write_text("\n".join(one) + "\n")
    (folder / "two.csv").write_text("\r\n".join(two))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    spark.conf.set("spark.sql.files.minPartitionNum", "8")
    try:
        got = files.load_csv(spark, str(folder), schemas.ORDERS, str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert got.good.schema.names == schemas.ORDERS.names and dict(got.good.dtypes)["order_date"] == "date"
    assert sorted(r.order_id for r in got.good.collect()) == sorted([*range(5), 6, *range(10, 13), *range(100, 290)])
    assert got.good.filter("order_id = 6").first().product == "Pen, red"
    rejects = sorted((r.file.rpartition("/")[2], r.line, r.record.split(",")[0]) for r in got.rejects.collect())
    assert rejects == [("one.csv", 7, "x"), ("one.csv", 9, "7"), ("one.csv", 11, "8"), ("two.csv", 183, "9")]
    assert got.counts == {"good": 199, "reject": 4, "header": 3, "blank": 1}


def test_intake_of_nothing_but_a_header_and_of_another_header(spark, tmp_path):
    (tmp_path / "empty.csv").write_text(HEAD + "\n")
    got = files.load_csv(spark, str(tmp_path / "empty.csv"), schemas.ORDERS, str(tmp_path / "e"))
    assert got.good.count() == 0 and got.rejects.count() == 0 and got.counts["header"] == 1
    (tmp_path / "other.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="other.csv"):
        files.load_csv(spark, str(tmp_path / "other.csv"), schemas.ORDERS, str(tmp_path / "o"))
