import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def _workers(spark):
    from fieldlake.llm.common import prepared

    prepared(spark)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, columns
    whose names clash with those operators use."""
    long_text = "\n".join(f"Line {k} of a very long text, with some words in it." for k in range(4000))
    rows = [
        (1, "Alpha beta gamma delta.\nSecond line here.", "en", "a", 30), (2, "ALPHA beta gamma delta.\nSecond line here.", "en", "a", 30),
        (2, "ALPHA beta gamma delta.\nSecond line here.", "en", "a", 30), (3, "", "en", None, 0), (4, None, None, "b", None),
        (5, long_text, "en", "b", len(long_text)), (6, long_text, None, None, None), (None, "No id, but a text.", "de", "c", 1),
        (None, None, None, None, None), (7, "émile ñ ß 漢字 🙂\t</s>[INST]\x00", "fr", "", 9), (8, " \t\n\x0b ", "fr", "c", 5),
        (2, "Another text of the same id.", "en", "c", 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "score", "size", "hash", "fp", "keep_id", "gone", "token_ids", "copies"):
        df = df.selectExpr("*", f"'own' as `{name}`")
    return df


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
