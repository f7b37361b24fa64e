"""Small tables with the awkward cases of every operator."""

LONG = "word " * 30_000 + "x" * 5_000

DOCS = [
    (1, "The quick brown fox jumps over the lazy dog. Ask jo@ex.org or +1 (555) 123-4567.", "en", "b", 80),
    (1, "The quick brown fox jumps over the lazy dog. Ask jo@ex.org or +1 (555) 123-4567.", "en", "b", 80),
    (2, "The quick brown fox jumps over the lazy dog. Ask jo@ex.org or +1 (555) 123-4567.", "en", "a", 80),
    (3, None, "en", "a", 0),
    (4, "", None, None, 0),
    (5, " \t\n ", "de", "é", 4),
    (6, LONG, "en", "b", len(LONG)),
    (None, "no id here, 4111 1111 1111 1111", "en", "a", None),
    (7, "ALL!! CAPS!! HERE!! 10.0.0.1 and 300.1.1.1", "en", None, 42),
    (8, "naïve café — “quotes” 日本語 🎉 <|endoftext|> tail x  y", "fr", "𝒳", 50),
    (9, "two words", "en", "b", 9),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = [(1, 1, 0), (2, 1, 0), (3, None, 0), (7, 0, 1), (7, 0, 1), (None, 1, 0), (9, 2, 0)]


def docs(spark, rows=None):
    return spark.createDataFrame(DOCS if rows is None else rows, SCHEMA)


def labels(spark, rows=None):
    return spark.createDataFrame(LABELS if rows is None else rows, "doc_id long, quality int, toxic int")


def crowded(df):
    """The frame with further columns whose names clash with the inputs in
    other case and with the operators' own column names."""
    from pyspark.sql import functions as F

    extra = {n: F.lit("clash") for n in ("TEXT", "Doc_ID", "fp", "_hash", "_keep", "score", "size", "place", "rank", "_new", "range", "order", "v", "speaker", "perspective")}
    names = {n: c for n, c in extra.items() if n not in df.columns}
    return df.select("*", *[c.alias(n) for n, c in names.items()])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
