"""Small tables for the tests of this folder."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

LONG = " ".join(f"word{i % 700} fox{i % 13}" for i in range(6000))

#: (doc_id, text): NULLs, empty and very long texts, ties and repeated rows.
ODD_TEXTS = [
    (1, "the quick brown fox jumps over the lazy dog and runs away from the very old bear"),
    (2, "the quick brown fox jumps over the lazy dog and runs away from the very old bear"),
    (3, "The Quick brown fox jumps over the lazy dog and runs away from the very old bear"),
    (3, "The Quick brown fox jumps over the lazy dog and runs away from the very old bear"),
    (4, None),
    (5, ""),
    (6, " \t\n "),
    (7, LONG),
    (8, LONG + " tail"),
    (9, "one"),
    (10, "two words"),
    (None, "a row without an id but with a text of some words"),
    (None, None),
    (11, "éa Çb ñ c d \x1c e"),
    (12, "stop\x00zero byte"),
    (13, "x" * 50_000),
]


def odd_docs(spark):
    """ODD_TEXTS with NULLs in the other columns and extra columns whose names clash with results."""
    rows = [
        (i, t, None if n % 3 == 0 else "en", None if n % 4 == 0 else "src0", None, f"x{n}", n * 1.0, n % 2 == 0, "r")
        for n, (i, t) in enumerate(ODD_TEXTS)
    ]
    names = "doc_id long, text string, lang string, source string, n_chars long, n_words string, score double, kept boolean, row string"
    return spark.createDataFrame(rows, names)


def no_docs(spark):
    return odd_docs(spark).limit(0)
