"""Small document tables for the operators' tests."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

AWKWARD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, "   \n\t ", "en", "a", 6),
    (4, "word", "en", "a", 4),
    (5, "x" * 20000, "de", "b", 20000),
    (6, "the quick brown fox jumps over the lazy dog again and again " * 400, "en", "b", 0),
    (7, "same text here for two rows of a table", "en", None, 1),
    (8, "same text here for two rows of a table", "en", None, 1),
    (9, "Ünïcode   und   Abstände \x1c!\x1c! naïve café été don't it's <|endoftext|> x<|endoftext|>y 12345", "de", "c", 3),
    (10, "퟿ \U0001f600\U0001f600 emoji 漢字 テスト", "ja", "c", 3),
]


def frame(spark, rows=AWKWARD):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, DOCS)
    # names that operators use inside
    return df.withColumns({c: F.lit(1) for c in ("n_tokens", "component_id", "size", "kind", "block", "kept", "score")})
