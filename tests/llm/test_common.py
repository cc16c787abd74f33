import pytest
from lotline.llm.common import drawn
from pyspark.sql import functions as F


@pytest.mark.parametrize("part,whole,share", [(10, 10, 1), (20, 10, 1), (1, 10, 0.1), (3, 4, 0.75), (0, 5, 0), (20_000, 5 * 10**10, 0)])
def test_drawn(spark, part, whole, share):
    n = spark.range(20_000).where(drawn(F.xxhash64("id"), part, whole)).count()
    assert n == pytest.approx(20_000 * share, abs=300)


def test_a_tiny_share_is_not_none(spark):
    least = spark.createDataFrame([(0,), (3_689_348_814,), (2**62,)], "h long")
    assert [r["h"] for r in least.where(drawn(F.col("h"), 20_000, 5 * 10**10)).collect()] == [0, 3_689_348_814]
