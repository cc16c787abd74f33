import pytest

from lotline.staging import stage_root


@pytest.fixture
def docs_of(spark):
    """Small document tables from texts, with ids 0, 1, 2 ... unless pairs are given."""
    stage_root(spark)

    def make(rows, extra=()):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame([(*r, "en", "s0", *extra) for r in rows],
                                     "doc_id long, text string, lang string, source string" + "".join(f", {c} string" for c in extra))

    return make
