"""Rows that every operator must survive."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = "ka lo mi ren tu sha vel po dra nim est or qua fi".split()


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 3))) for _ in range(words))


LONG = prose(99, 60_000)


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    base = prose(1, 120)
    return [
        (1, base, "en", "a", 5), (2, base, "en", "a", None), (3, base + " end", None, None, 5), (4, None, "en", "b", 0), (5, "", "de", "b", 0),
        (6, " \n\t ", "de", "b", 4), (7, "few words here", "en", None, 1), (None, prose(2, 90), "en", "a", 1), (None, None, None, None, None),
        (8, LONG, "en", "c", 1), (9, prose(3, 80), "en", "c", 1), (9, prose(3, 80), "en", "c", 1), (10, prose(4, 70) + " é €\u0000 <|endoftext|> 's", "fr", "c", 1),
        (11, "x" * 5000, "en", "a", 1), (12, base, "en", "a", 5),
    ]


def odd_docs(spark, clash: bool = False):
    df = spark.createDataFrame(odd_rows(), DOCS)
    if clash:
        for name in ("shard", "slot", "size", "kept", "block", "group", "copies", "_hash", "_copy", "text_hash", "ids", "others", "_part", "row", "n"):
            df = df.selectExpr("*", f"'mine' AS `{name}`")
    return df


def no_docs(spark):
    return spark.createDataFrame([], DOCS)
