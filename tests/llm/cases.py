"""Awkward tables that every operator and stage must take."""

LONG = "word another " * 20_000


def awkward(spark, more=""):
    """Nulls in every column, empty and very long texts, repeated rows and texts, clashing column names."""
    rows = [
        (1, "the cat sat on the mat and the dog lay by the door", "en", "a", 10),
        (2, "the cat sat on the mat and the dog lay by the door", "en", "a", 10),
        (2, "the cat sat on the mat and the dog lay by the door", "en", "a", 10),
        (3, None, None, None, None),
        (4, "", "en", None, 0),
        (5, "   \n\t ", None, "b", 6),
        (None, "a row without an id", "en", "a", 19),
        (None, None, None, None, None),
        (6, LONG, "en", "a", len(LONG)),
        (7, "der hund und die katze sind im haus und schlafen", "de", "b", 48),
        (8, "12345 !!! ???", None, "b", 13),
        (9, "▁ odd  spaces  日本語 \U0001d518 é́ ​", "de", "b", 5),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("kept", "lang_pred", "toxicity", "token_ids", "Evidence", "n_tokens", "x_text", "component_id", "shard"):
        frame = frame.withColumn(name, frame["source"])
    return frame


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
