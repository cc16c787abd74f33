"""Duplicates, joins, set operations, profiles and tests."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from catalog.inputs import cte, derive, more, table
from catalog.registry import query
from lotline.operators import features as ft
from lotline.operators import impute as im
from lotline.operators import rows as rw
from lotline.operators import stats as st
from lotline.operators.quantiles import approximate_quantiles
from lotline.operators.skew import outer_merge, skew_join

LINE_ID = "l_orderkey, l_linenumber, l_partkey"


@query("duplicate_flag", f"""
    select {LINE_ID}, l_suppkey,
      cast(count(*) over (partition by l_partkey, l_suppkey) > 1 as integer) as dup from lineitem""")
def _(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return rw.flag_duplicates(df, ["l_partkey", "l_suppkey"])


def ranked(order: str) -> str:
    return cte("ads_history") + f"""
    select k1, k2, yr, mon, ord, line, qty, price from (select *, row_number() over (
      partition by k1, k2 order by {order}, ord, line, qty, price) as rn from ads_history) where rn = 1"""


@query("first_per_key", ranked("yr, mon"))
def _(spark, sf):
    return rw.first_per_key(derive(spark, sf, "ads_history"), ["k1", "k2"], ["yr", "mon"])


@query("latest_per_key", ranked("yr desc, mon desc"))
def _(spark, sf):
    return rw.latest_per_key(
        derive(spark, sf, "ads_history"), ["k1", "k2"], ["yr", "mon"], ["ord", "line", "qty", "price"])


@query("top_k_by_score", f"""
    select {LINE_ID}, l_extendedprice from lineitem order by l_extendedprice desc, {LINE_ID} limit 100""")
def _(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return rw.top_k(df, 100, F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey")


@query("preview", "select o_orderkey, o_totalprice from orders order by o_orderkey limit 5")
def _(spark, sf):
    return rw.preview(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey")


SAMPLE_MARK = "((o_orderkey % 2147483647) * 48271) % 2147483647"


@query("random_sample", f"select o_orderkey, o_custkey, o_totalprice from orders order by {SAMPLE_MARK}, o_orderkey limit 1000")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return rw.sample_rows(orders, 1000, ["o_orderkey"], mark=F.expr(SAMPLE_MARK))


@query("append_tagged", """
    select 'customer' as base, c_custkey as id, c_acctbal as balance from customer
    union all select 'supplier', s_suppkey, s_acctbal from supplier""")
def _(spark, sf):
    return rw.append_tagged({
        "customer": table(spark, sf, "customer").selectExpr("c_custkey as id", "c_acctbal as balance"),
        "supplier": table(spark, sf, "supplier").selectExpr("s_suppkey as id", "s_acctbal as balance")})


@query("reassemble_parts", """
    select c_custkey as id, c_mktsegment as segment, cast(null as double) as balance from customer where c_acctbal < 0
    union all select c_custkey, c_mktsegment, c_acctbal from customer where c_acctbal >= 0""")
def _(spark, sf):
    df = table(spark, sf, "customer").selectExpr("c_custkey as id", "c_mktsegment as segment", "c_acctbal as balance")
    return rw.reassemble(df.where("balance < 0").drop("balance"), df.where("balance >= 0"))


@query("id_difference", """
    select distinct l_partkey from lineitem where l_returnflag = 'R'
    except select l_partkey from lineitem where l_returnflag = 'A'""")
def _(spark, sf):
    df = table(spark, sf, "lineitem")
    return rw.id_difference(df.where("l_returnflag = 'R'"), df.where("l_returnflag = 'A'"), "l_partkey")


@query("id_intersection", """
    select l_partkey from lineitem where l_returnflag = 'R'
    intersect select l_partkey from lineitem where l_returnflag = 'A'""")
def _(spark, sf):
    df = table(spark, sf, "lineitem")
    return rw.id_intersection(df.where("l_returnflag = 'R'"), df.where("l_returnflag = 'A'"), "l_partkey")


@query("id_union", """
    select l_suppkey as key from lineitem union select s_suppkey from supplier""")
def _(spark, sf):
    return rw.id_union(table(spark, sf, "lineitem").selectExpr("l_suppkey as key"),
                       table(spark, sf, "supplier").selectExpr("s_suppkey as key"), "key")


# keys are shifted, so that both sides have rows without a partner although whole tables are joined
@query("left_join_by_key", f"""
    select l_partkey, {LINE_ID.replace(', l_partkey', '')}, p_brand, p_size
    from lineitem left join part on l_partkey = p_partkey + 50""")
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parts = table(spark, sf, "part").selectExpr("p_partkey + 50 as l_partkey", "p_brand", "p_size")
    return skew_join(lines, parts, ["l_partkey"], "left")


HOT_INT = "cast(case when l_linenumber <= 3 then 7 else l_partkey % 1000000007 end as int)"


@query("left_join_mixed_key_types", f"""
    select {HOT_INT} as k, l_orderkey, l_linenumber, p_brand from lineitem left join part on {HOT_INT} = p_partkey""")
def _(spark, sf):
    lines = table(spark, sf, "lineitem").selectExpr(f"{HOT_INT} as k", "l_orderkey", "l_linenumber")
    parts = table(spark, sf, "part").selectExpr("cast(p_partkey as bigint) as k", "p_brand")
    return skew_join(lines, parts, ["k"], "left")


@query("outer_merge_by_key", """
    select coalesce(k, c_custkey) as custkey, spent, c_name
    from (select o_custkey + 10 as k, round(sum(o_totalprice), 2) as spent from orders group by 1)
    full join customer on k = c_custkey""")
def _(spark, sf):
    spent = table(spark, sf, "orders").groupBy((F.col("o_custkey") + 10).alias("custkey")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("spent"))
    names = table(spark, sf, "customer").selectExpr("c_custkey as custkey", "c_name")
    return outer_merge(spent, names, ["custkey"])


# --- profiles --------------------------------------------------------------------------------


@query("frequency_table", "select l_returnflag, l_linestatus, count(*) as n from lineitem group by 1, 2")
def _(spark, sf):
    return st.frequency_table(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")


def profile_sql(column: str, kind: str, numeric: bool) -> str:
    stats = (f"round(avg({column}), 4) as mean, round(stddev_samp({column}), 4) as sd, "
             f"min({column}) as min, max({column}) as max") if numeric else (
        "cast(null as double) as mean, cast(null as double) as sd, cast(null as double) as min, "
        "cast(null as double) as max")
    return (f"select '{column}' as variable, '{kind}' as type, count(*) as rows, count(*) - count({column}) as nulls, "
            f"round(count({column}) / count(*), 6) as complete, {stats} from ads")


PROFILED = {"title": ("string", False), "surface_total": ("double", True), "bathrooms": ("double", True),
            "price": ("double", True)}


@query("null_profile", cte("ads") + " union all ".join(profile_sql(c, *k) for c, k in PROFILED.items()))
def _(spark, sf):
    out = st.null_profile(derive(spark, sf, "ads"), list(PROFILED))
    return out.withColumns({"complete": F.round("complete", 6), "mean": F.round("mean", 4), "sd": F.round("sd", 4)})


@query("six_number_summary", cte("ads") + """
    select min(surface_total) as min, quantile_cont(surface_total, 0.25) as p25, median(surface_total) as median,
      round(avg(surface_total), 6) as mean, quantile_cont(surface_total, 0.75) as p75, max(surface_total) as max,
      count(*) - count(surface_total) as nulls from ads""")
def _(spark, sf):
    return st.six_numbers(derive(spark, sf, "ads"), "surface_total").withColumn("mean", F.round("mean", 6))


DESCRIBED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def describe_sql(source: str, columns: list[str]) -> str:
    return " union all ".join(
        f"select '{c}' as variable, round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as sd, "
        f"cast(min({c}) as double) as min, round(quantile_cont(cast({c} as double), 0.25), 4) as p25, "
        f"round(quantile_cont(cast({c} as double), 0.5), 4) as p50, "
        f"round(quantile_cont(cast({c} as double), 0.75), 4) as p75, cast(max({c}) as double) as max from {source}"
        for c in columns)


def rounded(df, *columns, digits=4):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("describe_all", describe_sql("lineitem", DESCRIBED))
def _(spark, sf):
    out = st.describe_all(table(spark, sf, "lineitem"), DESCRIBED)
    return rounded(out, "mean", "sd", "p25", "p50", "p75")


@query("wide_to_long_to_wide", """
    select l_returnflag, 'l_quantity' as variable, round(avg(l_quantity), 6) as mean, max(l_quantity) as max
    from lineitem group by 1 union all
    select l_returnflag, 'l_tax', round(avg(l_tax), 6), max(l_tax) from lineitem group by 1""")
def _(spark, sf):
    wide = table(spark, sf, "lineitem").groupBy("l_returnflag").agg(*[
        e.alias(f"{c}.{k}") for c in ("l_quantity", "l_tax")
        for k, e in (("mean", F.round(F.avg(c), 6)), ("max", F.max(c)))])
    long = wide.unpivot(["l_returnflag"], [f"`{c}`" for c in wide.columns[1:]], "label", "value")
    long = long.select("l_returnflag", *[F.split_part("label", F.lit("."), F.lit(i)).alias(n)
                                         for i, n in ((1, "variable"), (2, "stat"))], "value")
    return st.to_wide(long, ["l_returnflag", "variable"], "stat", "value", ["mean", "max"])


@query("impute_median_and_mode", cte("ads") + more(
    "mid as (select median(surface_total) as m from ads)",
    "top as (select bathrooms as b from ads where bathrooms is not null group by 1 order by count(*) desc, 1 limit 1)",
) + """
    select id, coalesce(surface_total, (select m from mid)) as surface_total,
      coalesce(bathrooms, (select b from top)) as bathrooms from ads""")
def _(spark, sf):
    ads = derive(spark, sf, "ads").select("id", "surface_total", "bathrooms")
    return im.fit_mode(ads, ["bathrooms"]).transform(im.fit_median(ads, ["surface_total"]).transform(ads))


@query("trim_by_sd", """
    with b as (select round_even(avg(o_totalprice) - 1.5 * stddev_samp(o_totalprice), 2) as low,
      round_even(avg(o_totalprice) + 1.5 * stddev_samp(o_totalprice), 0) as high from orders)
    select o_orderkey, o_totalprice from orders where o_totalprice >= (select low from b)
      and o_totalprice <= (select high from b)""")
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return im.fit_sd_trim(df, "o_totalprice", 1.5).transform(df)


PROBS = [0.0, 0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]


@query("exact_quantiles", " union all ".join(
    f"select cast({p} as double) as p, round(quantile_cont(l_extendedprice, {p}), 4) as value from lineitem" for p in PROBS))
def _(spark, sf):
    return rounded(st.quantile_table(table(spark, sf, "lineitem"), "l_extendedprice", PROBS), "value")


@query("approximate_quantiles")
def _(spark, sf):
    return approximate_quantiles(table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"], [0.25, 0.5, 0.75])


@query("grouped_means", """
    select l_returnflag, round(avg(l_quantity), 6) as l_quantity, round(avg(l_extendedprice), 4) as l_extendedprice
    from lineitem group by 1""")
def _(spark, sf):
    out = st.grouped_means(table(spark, sf, "lineitem"), ["l_returnflag"], ["l_quantity", "l_extendedprice"])
    return rounded(rounded(out, "l_quantity", digits=6), "l_extendedprice")


BREAKS = more("br as (select list_distinct([" + ", ".join(
    f"quantile_cont(obs, {i / 10})" for i in range(11)) + "]) as b from scored)")
BIN = "cast(greatest(1, len(list_filter(b, lambda e: e < obs))) as integer)"


@query("error_by_decile", cte("scored") + BREAKS + f"""
    select {BIN} as bin, count(*) as n, round(avg(obs), 3) as mean_observed, round(avg(pred), 3) as mean_predicted,
      round(avg(abs(obs - pred)), 3) as mae, round(avg(abs((obs - pred) / obs)) * 100, 6) as mape
    from scored cross join br group by 1""")
def _(spark, sf):
    out = st.error_by_quantile_bin(derive(spark, sf, "scored"), "obs", "pred")
    return rounded(rounded(out, "mean_observed", "mean_predicted", "mae", digits=3), "mape", digits=6)


BALANCED = ["l_quantity", "l_discount", "l_tax"]
F_SQL = " union all ".join(f"""
    select '{c}' as variable, k - 1 as df1, n - k as df2, round((ssb / (k - 1)) / (ssw / (n - k)), 6) as f from (
      select count(*) as k, cast(sum(n) as bigint) as n, sum(n * (m - g) * (m - g)) as ssb, sum((n - 1) * v) as ssw from (
        select count({c}) as n, avg({c}) as m, var_samp({c}) as v, (select avg({c}) from lineitem) as g
        from lineitem group by l_returnflag))""" for c in BALANCED)


@query("equal_means_f_test", F_SQL)
def _(spark, sf):
    moments = st.group_moments(table(spark, sf, "lineitem"), "l_returnflag", BALANCED)
    return rounded(st.equal_means_test(moments), "f", digits=6)


@query("chi_square_test", """
    with o as (select l_linestatus as a, l_returnflag as b, count(*) as o from lineitem group by 1, 2),
    r as (select a, sum(o) as r from o group by 1), c as (select b, sum(o) as c from o group by 1)
    select 'l_linestatus' as variable, (count(distinct r.a) - 1) * (count(distinct c.b) - 1) as df1,
      round(sum((coalesce(o.o, 0) - r * c / (select sum(o) from o)) ** 2 / (r * c / (select sum(o) from o))), 6) as chi2
    from r cross join c left join o on o.a = r.a and o.b = c.b""")
def _(spark, sf):
    return rounded(st.chi_square_test(table(spark, sf, "lineitem"), "l_linestatus", "l_returnflag"), "chi2", digits=6)


def balance_sql() -> str:
    cells = lambda e: ", ".join(f"{e.format(g=g)}" for g in "FO")
    means = " union all ".join(
        f"""select '{c}' as variable, cast(null as varchar) as level, """ + cells(
            f"count({c}) filter (l_linestatus = '{{g}}') as {{g}}_n, round(avg({c}) filter (l_linestatus = '{{g}}'), 6) as {{g}}_mean, "
            f"round(stddev_samp({c}) filter (l_linestatus = '{{g}}'), 6) as {{g}}_sd") + " from lineitem" for c in BALANCED)
    shares = "select 'l_returnflag', l_returnflag, " + cells(
        "count(*) filter (l_linestatus = '{g}'), round(count(*) filter (l_linestatus = '{g}') * 100.0e0 "
        "/ (select count(*) from lineitem where l_linestatus = '{g}' and l_returnflag is not null), 6), cast(null as double)")
    return f"{means} union all {shares} from lineitem where l_returnflag is not null group by l_returnflag"


def balanced(spark, sf):
    return st.balance_table(table(spark, sf, "lineitem"), "l_linestatus", ["F", "O"], BALANCED, ["l_returnflag"])


@query("balance_table", balance_sql())
def _(spark, sf):
    return rounded(balanced(spark, sf).drop("p"), "F_mean", "F_sd", "O_mean", "O_sd", digits=6)


@query("balance_table_p_values")
def _(spark, sf):
    return balanced(spark, sf).select("variable", "level", "p")


@query("histogram", """
    with b as (select min(o_totalprice) as lo, (max(o_totalprice) - min(o_totalprice)) / 50 as w from orders)
    select cast(least(floor((o_totalprice - (select lo from b)) / (select w from b)), 49) as integer) as bin,
      count(*) as n from orders group by 1""")
def _(spark, sf):
    return st.histogram(table(spark, sf, "orders"), "o_totalprice", 50).drop("left")


DENSITY = """
    with b as (select min(o_totalprice) as lo, (max(o_totalprice) - min(o_totalprice)) / 511 as step, count(*) as n,
      0.9 * least(stddev_samp(o_totalprice),
        (quantile_cont(o_totalprice, 0.75) - quantile_cont(o_totalprice, 0.25)) / 1.34) * count(*) ** -0.2 as h from orders),
    s as (select (o_totalprice - (select lo from b)) / (select step from b) as spot from orders),
    l as (select spot, least(floor(spot), 510) as i from s),
    m as (select i, sum(w) as w from (select i, 1 - (spot - i) as w from l union all select i + 1, spot - i from l) group by 1),
    k as (select g, sum(w * exp(-0.5 * ((g - i) * (select step / h from b)) ** 2)) as d
      from m cross join (select cast(unnest(range(512)) as integer) as g) group by 1)
    select g as point, round(d / ((select h * n from b) * sqrt(2 * pi())) * 1e9, 6) as density from k"""


@query("kernel_density", DENSITY)
def _(spark, sf):
    out = st.density(table(spark, sf, "orders"), "o_totalprice")
    return out.select("point", F.round(F.col("density") * 1e9, 6).alias("density"))


QQ_POINTS = 199
QQ_PROBS = [(i - 0.5) / QQ_POINTS for i in range(1, QQ_POINTS + 1)]


@query("normal_qq_table", "with g(point, p, theoretical) as (values " + ", ".join(
    f"(cast({i} as integer), {p:.17e}, {NormalDist().inv_cdf(p):.17e})" for i, p in enumerate(QQ_PROBS, 1)) + f"""),
    s as (select unnest(quantile_cont(l_extendedprice - 2000 * l_quantity, [{', '.join(f'{p:.17e}' for p in QQ_PROBS)}])) as sample,
      unnest(range(1, {QQ_POINTS + 1})) as point from lineitem)
    select g.point, round(p, 9) as p, round(theoretical, 9) as theoretical, round(sample, 4) as sample from g join s on g.point = s.point""")
def _(spark, sf):
    df = table(spark, sf, "lineitem").selectExpr("l_extendedprice - 2000 * l_quantity as residual")
    return rounded(rounded(st.qq_table(df, "residual", QQ_POINTS), "p", "theoretical", digits=9), "sample", digits=4)


@query("table_shapes", """
    select 'lineitem' as "table", (select count(*) from lineitem) as rows, 11 as columns, 1.0e0 as ratio union all
    select 'orders', (select count(*) from orders), 6, round((select count(*) from orders) / (select count(*) from lineitem), 6)""")
def _(spark, sf):
    out = st.table_shape({n: table(spark, sf, n) for n in ("lineitem", "orders")})
    return rounded(out, "ratio", digits=6)


# --- feature preparation -----------------------------------------------------------------------


@query("one_hot_columns", cte("ads") + """
    select id, cast(title is not distinct from 'Apartamento en venta' as integer) as "title_Apartamento en venta",
      cast(title is not distinct from 'Casa amplia' as integer) as "title_Casa amplia",
      cast(title is not distinct from 'Venta de inmueble' as integer) as "title_Venta de inmueble",
      cast(title is null as integer) as "title_NA" from ads""")
def _(spark, sf):
    return ft.one_hot_columns(derive(spark, sf, "ads").select("id", "title"), "title")


@query("z_scores", f"""
    select {LINE_ID}, round((l_quantity - (select avg(l_quantity) from lineitem))
      / (select stddev_samp(l_quantity) from lineitem), 8) as l_quantity from lineitem""")
def _(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return rounded(ft.fit_scale(df, ["l_quantity"]).transform(df), "l_quantity", digits=8)


@query("interaction_terms", f"""
    select {LINE_ID}, round(l_quantity * l_discount, 6) as l_quantity_x_l_discount,
      round(l_quantity * l_tax, 6) as l_quantity_x_l_tax from lineitem""")
def _(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax")
    out = ft.interactions(df, [("l_quantity", "l_discount"), ("l_quantity", "l_tax")])
    return rounded(out.drop("l_quantity", "l_discount", "l_tax"),
                   "l_quantity_x_l_discount", "l_quantity_x_l_tax", digits=6)


@query("orthogonal_polynomial", """
    with m as (select avg(o_totalprice) as m, count(*) as n from orders),
    d as (select o_orderkey, o_totalprice - (select m from m) as d from orders),
    s as (select sum(d**2) as s2, sum(d**3) as s3, sum(d**4) as s4 from d)
    select o_orderkey, round(d / (select sqrt(s2) from s) * 1000, 6) as poly1,
      round((d*d - (select s3/s2 from s) * d - (select s2 from s) / (select n from m))
        / (select sqrt(s4 - s3**2/s2 - s2**2/(select n from m)) from s) * 1000, 6) as poly2 from d""")
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    out = ft.fit_polynomial(df, "o_totalprice").transform(df)
    return out.select("o_orderkey", *[
        F.round(F.col(f"o_totalprice_poly{i}") * 1000, 6).alias(f"poly{i}") for i in (1, 2)])
