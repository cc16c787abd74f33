"""Projections, filters, scalar expressions and text operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import cte, derive, table
from catalog.registry import query
from lotline import fixed_values as fv
from lotline.functions import columns as cl
from lotline.functions import text as tx


def q(pattern: str) -> str:
    """A pattern as a SQL string literal."""
    return "'" + pattern.replace("'", "''") + "'"


@query("select_and_drop", "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity from lineitem")
def _(spark, sf):
    df = table(spark, sf, "lineitem")
    keep = cl.column_difference(df.columns, [c for c in df.columns if c.endswith(("flag", "status", "date"))])
    return cl.select_columns(df, keep, drop=["l_extendedprice", "l_discount", "l_tax"])


@query("rename_and_reorder",
       "select c_mktsegment as segment, c_custkey as custkey, c_name as name, c_nationkey as nationkey, "
       "c_acctbal as acctbal from customer")
def _(spark, sf):
    return cl.rename_columns(
        table(spark, sf, "customer"), {"c_mktsegment": "c_segment"}, replace=("c_", ""), first=["segment"])


@query("unit_rescale",
       "select o_orderkey, o_totalprice / 1000.0e0 as thousands, o_totalprice / 1000000.0e0 as millions from orders")
def _(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("thousands"), F.col("o_totalprice").alias("millions"))
    return cl.rescale(df, {"thousands": 1000, "millions": 1_000_000})


@query("drop_null_rows", cte("ads") + """
    select id, title, surface_total, bathrooms from ads
    where surface_total is not null and bathrooms is not null""")
def _(spark, sf):
    df = derive(spark, sf, "ads").select("id", "title", "surface_total", "bathrooms")
    return cl.drop_null_rows(df, ["surface_total", "bathrooms"])


@query("drop_rows_with_any_null", cte("ads") + """
    select id, title, surface_total, bathrooms from ads
    where title is not null and surface_total is not null and bathrooms is not null""")
def _(spark, sf):
    return cl.drop_null_rows(derive(spark, sf, "ads").select("id", "title", "surface_total", "bathrooms"))


@query("bounding_box_filter", cte("pts") + """
    select id, x, y from pts where x between 2000 and 8000 and y between 1500 and 9000""")
def _(spark, sf):
    return derive(spark, sf, "pts").select("id", "x", "y").where(cl.within_box("x", "y", (2000, 1500, 8000, 9000)))


@query("membership_filter",
       "select o_orderkey, o_orderstatus, o_orderpriority from orders "
       "where o_orderstatus <> 'P' and (o_orderpriority is null or o_orderpriority not in ('1-URGENT', '5-LOW'))")
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return df.where((F.col("o_orderstatus") != "P") & cl.not_in("o_orderpriority", ["1-URGENT", "5-LOW"]))


@query("conditional_value", """
    select l_orderkey, l_linenumber, l_partkey,
      case l_returnflag when 'A' then 'accepted' when 'R' then 'returned' else 'none' end as flag,
      case when l_quantity > 25 then 1 else 0 end as large
    from lineitem""")
def _(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        cl.case_map("l_returnflag", {"A": "accepted", "R": "returned"}, "none").alias("flag"),
        F.when(F.col("l_quantity") > 25, 1).otherwise(0).alias("large"))


MIXED = "case when p_partkey % 3 = 0 then p_type else cast(p_retailprice as string) end"


@query("safe_number_cast",
       f"select * from (select p_partkey, try_cast({MIXED} as double) as price from part) where price is not null")
def _(spark, sf):
    df = table(spark, sf, "part").selectExpr("p_partkey", f"{MIXED} as price")
    return df.withColumn("price", cl.to_number("price")).na.drop(subset=["price"])


@query("two_level_flag",
       "select l_orderkey, l_linenumber, l_partkey, case l_returnflag when 'R' then 1 when 'A' then 0 end as returned "
       "from lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", cl.two_level_flag("l_returnflag", "A", "R").alias("returned"))


@query("target_transforms", """
    select o_orderkey, round(ln(o_totalprice), 9) as log_price, round(ln(1 + o_totalprice), 9) as log1p_price,
      round(exp(ln(o_totalprice)), 4) as from_log, round(exp(ln(1 + o_totalprice)) - 1, 4) as from_log1p
    from orders""")
def _(spark, sf):
    price = F.col("o_totalprice")
    (log, exp), (log1p, expm1) = cl.TARGET_TRANSFORMS["log"], cl.TARGET_TRANSFORMS["log1p"]
    return table(spark, sf, "orders").select(
        "o_orderkey", F.round(log(price), 9).alias("log_price"), F.round(log1p(price), 9).alias("log1p_price"),
        F.round(exp(log(price)), 4).alias("from_log"), F.round(expm1(log1p(price)), 4).alias("from_log1p"))


@query("round_half_even_and_clip", """
    select l_orderkey, l_linenumber, l_partkey, round_even(l_quantity / 2, 0) as halves,
      least(greatest(l_extendedprice, 5000.0e0), 90000.0e0) as held
    from lineitem""")
def _(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        cl.round_half_even(F.col("l_quantity") / 2).alias("halves"),
        cl.clip("l_extendedprice", 5000, 90000).alias("held"))


# --- text ------------------------------------------------------------------------------------

NORMAL = r"regexp_replace(lower(text), '\s+', ' ', 'g')"
CONTEXT = f"nullif(regexp_extract(text, {q(tx.context_pattern(fv.CONTEXT_UNITS, 5, 5))}), '')"


def sql_number(hit: str) -> str:
    return f"try_cast(nullif(regexp_extract({hit}, {q(tx.NUMBER)}), '') as double)"


def sql_mined(context: str = CONTEXT) -> str:
    hit = f"nullif(regexp_extract({context}, {q(tx.unit_pattern(fv.SURFACE_UNITS))}), '')"
    return sql_number(hit)


def sql_vetoed(context: str, value: str) -> str:
    bad = f"regexp_matches({context}, {q(tx.word_pattern(fv.EXCLUSION_WORDS, True))})"
    return f"case when not coalesce({bad}, false) then {value} end"


def sql_dimension(text: str) -> str:
    hit = f"nullif(regexp_extract({text}, {q(tx.dimension_pattern())}), '')"
    first = f"try_cast(nullif(regexp_extract({hit}, {q('^[ ]*' + tx.NUMBER)}), '') as double)"
    second = (f"try_cast(nullif(regexp_extract({hit}, "
              f"{q('(?i)(?:' + fv.LENGTH_SEPARATORS + ')' + chr(92) + 's*(' + tx.NUMBER + ')')}, 1), '') as double)")
    return f"case when not regexp_matches({hit}, {q(fv.WATCH_HOURS)}) then {first} * {second} end"


def sql_labelled(text: str) -> str:
    return sql_number(f"nullif(regexp_extract({text}, {q(tx.labelled_pattern())}), '')")


def sql_class(columns: list[str], fallback: str) -> str:
    parts = []
    for c in columns:
        whens = " ".join(f"when regexp_matches(lower({c}), {q(p)}) then '{v}'" for p, v in tx.HOUSING_RULES)
        parts.append(f"case {whens} end")
    return f"coalesce({', '.join([*parts, fallback])})"


def sql_count(text: str) -> str:
    words = "|".join(fv.NUMBER_WORDS)
    hit = f"nullif(regexp_extract({text}, {q(rf'(?i)({chr(92)}d+){chr(92)}s*({fv.BATH_NOUN})|(?:{words}){chr(92)}s*({fv.BATH_NOUN})')}), '')"
    whens = " ".join(f"when lower({hit}) like '%{w}%' then {n}.0e0" for w, n in fv.NUMBER_WORDS.items())
    digits = r"try_cast(nullif(regexp_extract(" + hit + r", '\d+'), '') as double)"
    value = f"case {whens} else {digits} end"
    return f"case when ({value}) < {fv.BATH_LIMIT} then ({value}) end"


# The ads are written by a rule (`ads` in inputs.py), so what a text says is known without any pattern.
def told(**cases: str) -> str:
    return "case id % 6 " + " ".join(f"when {k[1:]} then cast({v} as double)" for k, v in cases.items()) + " end"


def sql_least_distance(text: str, words: list[str]) -> str:
    """Whether some substring is within one edit of a word, by edit distances of all substrings of fitting length."""
    def nearest(w: str) -> str:
        lengths = ", ".join(f"levenshtein(substr({text}, i, {len(w) + d}), '{w}')" for d in (-1, 0, 1))
        return f"list_min([least({lengths}) for i in range(1, length({text}) + 1)])"

    tests = " or ".join(f"{nearest(w)} <= 1" for w in words)
    return f"coalesce(cast(({tests}) as integer), 0)"


def sql_fuzzy(text: str, words: list[str]) -> str:
    tests = " or ".join(f"regexp_matches({text}, {q(tx.one_edit_pattern(w))})" for w in words)
    return f"coalesce(cast(({tests}) as integer), 0)"


@query("normalize_text", cte("ads") + rf"""
    select id, {NORMAL} as plain, translate({NORMAL}, 'áéíóúüñ', 'aeiouun') as no_accents from ads""")
def _(spark, sf):
    return derive(spark, sf, "ads").select(
        "id", tx.normalize_text("text").alias("plain"), tx.normalize_text("text", accents=False).alias("no_accents"))


@query("context_window", cte("ads") + f"select id, {CONTEXT} as context from ads")
def _(spark, sf):
    return derive(spark, sf, "ads").select("id", tx.context_window("text").alias("context"))


ADS_SIZED = cte("ads") + ", a as (select p_partkey as id, p_size as p from part) "


@query("number_with_unit", ADS_SIZED + "select id, " + told(_0="p + 30", _1="p", _3="p + 60") + " as surface from a")
def _(spark, sf):
    return derive(spark, sf, "ads").select("id", tx.number_with_unit(tx.context_window("text")).alias("surface"))


@query("word_list_veto", ADS_SIZED + "select id, " + told(_0="p + 30") + " as surface from a")
def _(spark, sf):
    ads = derive(spark, sf, "ads").withColumn("context", tx.context_window("text"))
    return ads.select("id", tx.veto(tx.number_with_unit("context"), "context").alias("surface"))


@query("dimension_product", ADS_SIZED + "select id, " + told(_2="8 * p") + " as area from a")
def _(spark, sf):
    return derive(spark, sf, "ads").select("id", tx.dimension_product(tx.normalize_text("text")).alias("area"))


@query("labelled_quantity", ADS_SIZED + "select id, " + told(_3="p + 60") + " as built from a")
def _(spark, sf):
    return derive(spark, sf, "ads").select("id", tx.labelled_quantity(tx.normalize_text("text")).alias("built"))


@query("classify_by_keywords", cte("ads") + """
    select id, case when id % 4 = 0 then 'Apartamento' when id % 4 = 1 then 'Casa' when id % 6 = 0 then 'Apartamento' else stored end as housing
    from ads""")
def _(spark, sf):
    return derive(spark, sf, "ads").select("id", tx.classify_by_keywords(["title", "text"], fallback="stored").alias("housing"))


@query("digit_or_word_count", ADS_SIZED + "select id, " + told(_0="3", _1="2", _4="2") + " as baths from a")
def _(spark, sf):
    return derive(spark, sf, "ads").select("id", tx.digit_or_word_count(tx.normalize_text("text")).alias("baths"))


@query("amenity_flags", cte("ads") + "select id, " + ", ".join(
    f"{sql_least_distance('text', words)} as {name}" for name, words in fv.AMENITY_WORDS.items()) + " from ads")
def _(spark, sf):
    return derive(spark, sf, "ads").select(
        "id", *[tx.fuzzy_contains("text", words).alias(name) for name, words in fv.AMENITY_WORDS.items()])


@query("amenity_flags_in_documents", "select doc_id, " + ", ".join(
    f"{sql_fuzzy('text', words)} as {name}" for name, words in fv.AMENITY_WORDS.items()) + " from documents")
def _(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", *[tx.fuzzy_contains("text", words).alias(name) for name, words in fv.AMENITY_WORDS.items()])


@query("split_label",
       "select p_partkey, split_part(p_type, ' ', 1) as grade, split_part(p_type, ' ', 2) as finish from part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", *tx.split_label("p_type", " ", ["grade", "finish"]))


@query("coalesce_cascade", cte("ads") + f"""
    select id, coalesce(surface_total, {sql_labelled(NORMAL)},
      case when {sql_vetoed(CONTEXT, sql_mined())} > 25 then {sql_vetoed(CONTEXT, sql_mined())} end,
      case when {sql_dimension(NORMAL)} > 25 then {sql_dimension(NORMAL)} end) as surface
    from ads""")
def _(spark, sf):
    ads = derive(spark, sf, "ads").withColumns({
        "context": tx.context_window("text"), "normal": tx.normalize_text("text")})
    return ads.select("id", cl.fill_from("surface_total", [
        (tx.labelled_quantity("normal"), None),
        (tx.veto(tx.number_with_unit("context"), "context"), 25),
        (tx.dimension_product("normal"), 25)]).alias("surface"))


LISTING_COLUMNS_SQL = (
    "cast(id as string) as property_id, price, cast(yr as integer) as year, surface_total, bathrooms, title, "
    "text || '|\"' || title || '\", ' || cast(id as string) as description"
)
