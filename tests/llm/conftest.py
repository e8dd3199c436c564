import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or longer tuples, with a column whose name operators use themselves."""

    def make(*rows, extra=True):
        full = [(*r, *(None,) * (5 - len(r))) for r in rows]
        df = spark.createDataFrame(full, DOCUMENT)
        if extra:
            for name in ("score", "piece", "copy", "node", "text_id", "root", "key", "segments", "times"):
                df = df.selectExpr("*", f"'kept' as {name}")
        return df

    return make
