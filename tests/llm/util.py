"""Shared parts of these tests: rows with every awkward case, and plain versions of the rules."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def awkward_docs(seed=7, n=60):
    """Prose with copies, NULLs in every column, empty and very long texts, repeated rows."""
    r = random.Random(seed)
    vocabulary = ["the", "of", "thering", "éou", "naïve", "x1", "über", "#tag", "a|b", "ñandú", "stone", "river", "Cloud"]
    rows = []
    for i in range(n):
        text = " ".join(r.choice(vocabulary) for _ in range(r.randint(0, 90)))
        if rows and r.random() < 0.3:
            text = r.choice(rows)[1] or text
        if r.random() < 0.3:
            text += "\n" + "one and the same line of some nine words here" + "\n"
        rows.append((i, text, r.choice(["en", "fr", None]), r.choice(["a", "b", "c", None]), len(text)))
    rows += [(n, None, "en", "a", None), (n + 1, "", None, None, 0), (None, "a row without an id", "en", "b", 19),
             (n + 2, "\x20\t\n\x0b\x0c\r", "fr", "a", 6), (n + 3, " ".join(r.choice(vocabulary) for _ in range(30_000)), "en", "c", 1),
             (n + 4, "word " * 3000, "fr", "c", 1), (n + 5, "\U0001f600 ́ ß\x00 İ", "fr", "b", 5)]
    return rows + [rows[3], rows[3], rows[4]]


def frame(spark, rows=None):
    return spark.createDataFrame(awkward_docs() if rows is None else rows, SCHEMA)


def clashing(df):
    """The same rows with further columns, of names that operators use inside."""
    from pyspark.sql import functions as F
    names = "id h row size bin text_hash spans base kept place cls part n start found key w lines segments p rank score lang_pred copies".split()
    return df.withColumns({name: F.lit("x") for name in names if name not in df.columns})


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
