"""Small tables for the operators' tests."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, value long, ids string"


def documents(spark, texts, sources=None, ids=None):
    """Rows with extra columns whose names the operators use themselves."""
    rows = [
        (ids[i] if ids else i, t, "en", sources[i] if sources else "s", 0, "clash", 1, "clash")
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA)
