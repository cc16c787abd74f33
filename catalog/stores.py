"""Sources and sinks: tables written to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog.columns_and_text import LISTING_COLUMNS_SQL
from catalog.inputs import cte, derive, table, zone_rings
from catalog.registry import query
from lotline.operators.spatial import edge_table
from lotline.operators.stats import describe_all
from lotline.sources import io
from lotline.staging import stage_root


def folder(spark) -> str:
    return f"{stage_root(spark).rstrip('/')}/io-{uuid.uuid4().hex}"


@query("read_listings_from_csv", cte("ads") + f"select {LISTING_COLUMNS_SQL} from ads")
def _(spark, sf):
    path = folder(spark)
    ads = derive(spark, sf, "ads").selectExpr(
        "id as property_id", "price", "cast(yr as int) as year", "surface_total", "bathrooms", "title",
        "concat(text, '\\n\"', title, '\", ', id) as description")
    ads.write.option("header", True).option("escape", '"').csv(path)
    schema = ("property_id string, price double, year int, surface_total double, bathrooms double, title string, "
              "description string")
    return io.read_listings(spark, path, schema, multi_line=True).withColumn("description", F.replace("description", F.lit("\n"), F.lit("|")))


@query("read_point_layer", "select s_suppkey, s_name, s_nationkey, s_acctbal, 3116 as srid from supplier")
def _(spark, sf):
    return io.read_layer(spark, f"{sf}/supplier.parquet", 3116)


@query("read_polygon_layer", cte("zones", "edges") + "select zid as poly_id, 0 as ring, x1, y1, x2, y2 from edges")
def _(spark, sf):
    path = folder(spark)
    zone_rings(spark, sf).write.parquet(path)
    return edge_table(io.read_layer(spark, path, 3116))


@query("save_and_load_table", "select o_orderkey, o_custkey, o_totalprice from orders")
def _(spark, sf):
    return io.save_table(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), folder(spark))


@query("write_predictions", "select l_partkey as property_id, round_even(l_extendedprice / 8, 0) as price from lineitem")
def _(spark, sf):
    df = table(spark, sf, "lineitem").selectExpr("l_partkey as property_id", "l_extendedprice / 8 as prediction")
    path = io.write_predictions(df, folder(spark), "boosting", {"depth": 5, "eta": 0.05})
    return spark.read.schema("property_id long, price double").option("header", True).csv(path)


@query("write_statistics_table", "select 'l_quantity' as variable, min(l_quantity) as min, median(l_quantity) as p50, "
       "max(l_quantity) as max from lineitem")
def _(spark, sf):
    path = folder(spark)
    io.write_report(describe_all(table(spark, sf, "lineitem"), ["l_quantity"]), path)
    return spark.read.parquet(path).select("variable", "min", "p50", "max")
