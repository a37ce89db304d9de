"""Small tables with the awkward cases: nulls, empty and very long texts, repeated rows, clashing column names."""

AWKWARD = [(1, "alpha beta gamma delta epsilon"), (2, None), (3, ""), (4, " \t\n "), (None, "alpha beta gamma delta epsilon"),
           (5, "word " * 30_000), (6, "one"), (6, "one"), (7, "!!! ... 12 34"), (8, "Ünïcode Straße naïve Ærø x")]


def docs(spark, rows=AWKWARD, extra="fingerprint string, n_words string, score string, w string, `key.dot` string"):
    """documents-like table with columns that clash with names the operators use inside."""
    names = [c.split(" ")[0] for c in extra.split(", ")] if extra else []
    return spark.createDataFrame([(i, t, *["own"] * len(names)) for i, t in rows],
                                 "doc_id bigint, text string" + (f", {extra}" if extra else ""))


def empty(spark):
    return docs(spark, [])
