"""Odd rows that every operator must take."""

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, seed string, k int"


def words(n, tag="w"):
    return " ".join(f"{tag}{i % 97}x{i}" for i in range(n))


LONG = words(9000, "long")
PASSAGE = words(120, "p")


def odd_rows():
    """Null and empty texts, blanks, very long and repeated rows, shared passages, null ids and sources."""
    rows = [
        (1, None, "en", "a"),
        (2, "", None, "a"),
        (3, " \t\n ", "en", None),
        (4, LONG, "en", "b"),
        (5, LONG, "en", "b"),
        (6, "one two", "en", "c"),
        (7, "One  TWO", "en", "c"),
        (8, PASSAGE, "de", "a"),
        (9, "before it " + PASSAGE + " and after", "de", "a"),
        (10, words(60, "q") + " " + PASSAGE[:400], "fr", "é"),
        (10, words(60, "q") + " " + PASSAGE[:400], "fr", "é"),
        (11, "ü" * 900 + " 漢字 " + "\u0085 " + "ü" * 500, "de", "z"),
        (None, "no id " + PASSAGE, "en", "b"),
        (12, "mail a.b@c.org or +1 (234) 567-8901 from 10.0.0.1", "en", None),
    ]
    return [r + (len(r[1]) if r[1] is not None else None, 0.5, "x", 3) for r in rows]


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), DOC_SCHEMA)
