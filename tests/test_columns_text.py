import pytest
from pyspark.sql import functions as F

from lotline import fixed_values as fv
from lotline.functions import columns as cl
from lotline.functions import geo
from lotline.functions import text as tx


def value(spark, text, expr):
    return spark.createDataFrame([(text,)], "t string").select(expr.alias("v")).head()["v"]


def test_normalize(spark):
    assert value(spark, "Balcón  Ñ\n x", tx.normalize_text("t")) == "balcón ñ x"
    assert value(spark, "Balcón  Ñ\n x", tx.normalize_text("t", accents=False)) == "balcon n x"
    assert value(spark, "Straße Œuvre", tx.strip_accents("t")) == "Strasse OEuvre"


@pytest.mark.parametrize("text,want", [
    ("apto de 45.5 m2 con vista", 45.5), ("sin medida", None), ("80 m² ", 80.0), (None, None),
    ("área de 120 metros cuadrados", 120.0)])
def test_number_with_unit(spark, text, want):
    assert value(spark, text, tx.number_with_unit(tx.context_window("t"))) == want


def test_context_takes_five_words_each_side(spark):
    text = "a b c d e f g 45 m2 h i j k l m n"
    assert value(spark, text, tx.context_window("t")) == "c d e f g 45 m2 h i j k l"


@pytest.mark.parametrize("text,want", [
    ("con terraza de 20 m2", None), ("con TERRAZA de 20 m2", None), ("apto de 20 m2", 20.0),
    ("balcón y 30 m2", None), ("parqueaderos 30 m2", 30.0)])
def test_veto(spark, text, want):
    context = tx.context_window("t")
    assert value(spark, text, tx.veto(tx.number_with_unit(context), context)) == want


@pytest.mark.parametrize("text,want", [
    ("lote 8 x 20", 160.0), ("vigilancia 24x7", None), ("7 x 24", None), ("6.5 mts de frente por 12 mts de fondo", 78.0),
    ("nada", None)])
def test_dimension_product(spark, text, want):
    assert value(spark, text, tx.dimension_product("t")) == want


def test_labelled_quantity(spark):
    assert value(spark, "área construida 80 m2", tx.labelled_quantity("t")) == 80.0
    assert value(spark, "superficie total construida 95.5 mts", tx.labelled_quantity("t")) == 95.5
    assert value(spark, "área 80 m2", tx.labelled_quantity("t")) is None


def test_classify(spark):
    rows = [("Casa apto", None, "x"), (None, "penthouse", "x"), ("nada", None, "Casa"), ("casamiento", None, "x"),
            ("aptos", "casa", "x"), (None, None, None)]
    df = spark.createDataFrame(rows, "title string, text string, stored string")
    got = [r[0] for r in df.select(tx.classify_by_keywords(["title", "text"], fallback="stored")).collect()]
    assert got == ["Casa", "Apartamento", "Casa", "Casa", "Apartamento", None]


@pytest.mark.parametrize("text,want", [
    ("tres baños", 3.0), ("2 banos", 2.0), ("25 baños", None), ("22 baños", None), (None, None), ("Dos Baños", 2.0)])
def test_counts(spark, text, want):
    assert value(spark, text, tx.digit_or_word_count("t")) == want


@pytest.mark.parametrize("text,want", [
    ("picina", 1), ("piscinas", 1), ("pixcina", 1), ("piiscina", 1), ("pcna", 0), (None, 0), ("iscina", 1), ("pis\ncina", 1),
    ("la piscin", 1)])
def test_fuzzy_one_edit(spark, text, want):
    assert value(spark, text, tx.fuzzy_contains("t", ["piscina"])) == want


def test_fuzzy_matches_edit_distance_brute_force(spark):
    import itertools

    def within(text, word):
        return any(edits(text[i:j], word) <= 1 for i in range(len(text) + 1) for j in range(i, len(text) + 1))

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, prev = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(prev[j] + 1, row[-1] + 1, prev[j - 1] + (x != y)))
        return row[-1]

    texts = ["".join(t) for n in range(5) for t in itertools.product("gymx", repeat=n)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["t"]: r["v"] for r in df.select("t", tx.fuzzy_contains("t", ["gym"]).alias("v")).collect()}
    assert all(got[t] == int(within(t, "gym")) for t in texts)


def test_edits_are_looked_for_from_a_whole_half(spark):
    """Either pattern starts from a half, and both together match what the pattern of the whole word does."""
    import random

    draw = random.Random(3)
    for word in [w for words in fv.AMENITY_WORDS.values() for w in words]:
        cut = len(word) // 2
        assert [p.startswith(f"(?s){half}") for half, p in tx.half_patterns(word)] == [True, True]
        texts = [word, word[:cut], word[cut:], f"{word[:cut]} {word[cut:]}", f"{word[cut:]}{word[:cut]}"]
        for _ in range(300):
            letters = list(draw.choice(["", "a ", word[:2]]) + word + draw.choice(["", " b", word[-2:]]))
            for _ in range(draw.choice([1, 1, 2, 2, 3])):
                at = draw.randrange(len(letters))
                letters[at:at + draw.choice([0, 1])] = draw.choice([[], ["x"], ["\n"], [draw.choice(word)]])
                letters = letters or ["x"]
            texts.append("".join(letters))
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        rows = df.select("t", tx.fuzzy_contains("t", [word]).alias("got"), F.col("t").rlike(tx.one_edit_pattern(word)).cast("int").alias("want")).collect()
        assert [r for r in rows if r["got"] != r["want"]] == [] and {r["want"] for r in rows} == {0, 1}


def test_white_space_and_words_before_patterns(spark):
    texts = ["a b", " a", "a ", "a  b", "a\tb", "a \t b", "a\n\n b ", "\t", "  ", "", "A\u00a0 \x0bB\r\n", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    want = [r[0] for r in df.select(F.regexp_replace(F.lower("t"), r"\s+", " ")).collect()]
    assert [r[0] for r in df.select(tx.normalize_text("t")).collect()] == want
    held = df.select(tx.has_any("t", ["b", "ab", "a"]).alias("v"))
    assert [r["v"] for r in held.where("v is not null").collect()] == [any(c in t for c in "ab") for t in texts if t is not None]
    homes = ["apto", "xapto", "aptos", "Peth House", "casapto", "apt\u00e1", "local", "el apto.", None]
    rows = spark.createDataFrame([(t,) for t in homes], "t string").select(
        tx.classify_by_keywords(["t"]).alias("got"), tx.classify_by_keywords(["t"], rules=tx.HOUSING_RULES).alias("want")).collect()
    assert [r["got"] for r in rows] == [r["want"] for r in rows] and {r["got"] for r in rows} == {fv.HOUSE, fv.FLAT, None}


def test_a_text_is_searched_once(spark):
    """A search that a plan names twice inside a condition is made twice."""
    rows = [(None, "8 x 5"), (3.0, "24x7"), (None, "tres banos"), (None, "30 banos"), (None, None), (None, "a x b 4x2.5"), (None, "banos")]
    df = spark.createDataFrame(rows, "need double, t string")
    lacks = F.col("need").isNull()
    got = df.select(F.when(lacks, tx.dimension_product("t")).alias("area"), F.when(lacks, tx.digit_or_word_count("t")).alias("n"),
                    F.when(lacks, tx.number_with_unit("t")).alias("size"), F.when(lacks, tx.first_match("t", "[0-9]+")).alias("first"))
    assert [tuple(r) for r in got.collect()] == [
        (40.0, None, None, "8"), (None,) * 4, (None, 3.0, None, None), (None, None, None, "30"), (None,) * 4, (10.0, None, None, "4"), (None,) * 4]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("(frente|frente") == 1 and plan.count("|cuatro|") == 1


def test_fill_from(spark):
    rows = [(None, 80.0, 30.0, 10.0), (None, None, 30.0, 10.0), (None, None, 20.0, 40.0), (None, None, 20.0, 20.0)]
    df = spark.createDataFrame(rows, "t double, a double, b double, c double")
    got = [r[0] for r in df.select(cl.fill_from("t", [("a", None), ("b", 25), ("c", 25)])).collect()]
    assert got == [80.0, 30.0, 40.0, None]


def test_rounding_and_clip(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (None,)], "v double")
    assert [r[0] for r in df.select(cl.round_half_even("v")).collect()] == [0.0, 2.0, 2.0, None]
    assert [r[0] for r in df.select(cl.clip("v", 1, 2)).collect()] == [1.0, 1.5, 2.0, None]


def test_rename_with_dots_and_order(spark):
    df = spark.createDataFrame([(1, 2)], "a_x int, b_y int")
    assert cl.rename_columns(df, replace=("_", "."), first=["b.y"]).columns == ["b.y", "a.x"]


def test_two_level_flag(spark):
    df = spark.createDataFrame([("Casa",), ("Apartamento",), ("otro",), (None,)], "k string")
    assert [r[0] for r in df.select(cl.two_level_flag("k", "Casa", "Apartamento")).collect()] == [0, 1, None, None]


def test_projection_known_points_and_round_trip(spark):
    df = spark.createDataFrame([(-74.0775079166667, 4.59620041666667), (-74.05, 4.65)], "lon double, lat double")
    x, y = geo.MAGNA_BOGOTA.forward("lon", "lat")
    rows = df.select(x.alias("x"), y.alias("y")).collect()
    assert rows[0]["x"] == pytest.approx(1e6, abs=1e-6) and rows[0]["y"] == pytest.approx(1e6, abs=1e-6)
    assert rows[1]["x"] == pytest.approx(1003052.1554, abs=1e-3) and rows[1]["y"] == pytest.approx(1005949.2975, abs=1e-3)
    for plane in (geo.MAGNA_BOGOTA, geo.CITY_PLANE, geo.WEB_MERCATOR, geo.utm(geo.utm_zone(-74.05))):
        x, y = plane.forward("lon", "lat")
        there = df.select("lon", "lat", x.alias("x"), y.alias("y"))
        lon, lat = plane.inverse("x", "y")
        for r in there.select(lon.alias("a"), lat.alias("b"), "lon", "lat").collect():
            assert abs(r["a"] - r["lon"]) < 1e-8 and abs(r["b"] - r["lat"]) < 1e-8


def test_segment_distance_and_rim(spark):
    df = spark.createDataFrame([(0.0, 5.0), (12.0, 0.0), (3.0, 0.0)], "px double, py double")
    ends = [F.lit(float(v)) for v in (0, 0, 10, 0)]
    d = df.select(geo.segment_squared_distance("px", "py", *ends).alias("d"), geo.on_segment("px", "py", *ends).alias("on"))
    assert [(r["d"], r["on"]) for r in d.collect()] == [(25.0, False), (4.0, False), (0.0, True)]
