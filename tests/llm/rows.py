"""Small tables with what real ones may hold: nulls, empty and long texts, repeated rows, columns whose names clash."""

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, size long, slot long, shard int, part int, label int"


def documents(spark, texts, first=0):
    """Documents with ids from `first`, and columns named like those that operators use inside."""
    rows = [(first + i, t, "en", "s", len(t or ""), -1, -1, -1, -1, -1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCUMENTS)


def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)
