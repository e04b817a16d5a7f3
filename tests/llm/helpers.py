"""Small tables with awkward rows."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names the operators use themselves, and their output columns.
CLASHES = (
    "component_id kept node n_shingles registers bucket host row key part size taken target tokens place sequence_id "
    "offset spans fingerprint score features label c0 next_key failed host_rejected words"
).split()


def text_of(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join("".join(chr(97 + (v >> (4 * k)) % 16) for k in range(3)) for v in rng.choices(range(vocabulary), k=n))


def awkward_rows():
    """Nulls in every column, empty and white texts, one long text, repeated rows and ids, odd characters."""
    base = text_of(1, 120)
    near = base.rsplit(" ", 2)[0] + " other end"
    return [
        (1, base, "en", "a", len(base)),
        (2, base, "en", "a", len(base)),
        (2, base, "en", "a", len(base)),
        (3, near, "en", "b", len(near)),
        (4, text_of(2, 60), None, None, None),
        (5, None, "en", "a", 0),
        (6, "", "de", "b", 0),
        (7, " \t\n ", "de", "b", 4),
        (8, "one two three", "de", "c", 13),
        (9, "ONE two\tthree", "de", "c", 13),
        (None, text_of(3, 40), "en", "a", 1),
        (None, None, None, None, None),
        (10, text_of(4, 30000), "en", "a", 5),
        (11, "😀é — ñ # | <|endoftext|> it's ＡＢ 123.45, x" * 5, "fr", "b", 3),
        (12, "\n".join(["the same line"] * 30), "fr", "b", 3),
        (12, text_of(5, 50), "fr", "c", 3),
        (13, text_of(6, 9) + " " + "ab " * 60, "fr", None, 3),
    ]


def table(spark, rows, clash=True):
    df = spark.createDataFrame(rows, SCHEMA)
    if clash:
        df = df.select("*", *(F.lit(f"x{i}").alias(name) for i, name in enumerate(CLASHES)))
    return df


def rows_of(df, *columns):
    columns = columns or df.columns
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
