"""Small tables with every awkward case, and brute-force versions of word and n-gram rules."""

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Column names that operators use inside or return.
CLASHES = ("score", "bucket", "row", "row_number", "row_mark", "key", "class", "shard", "size", "n_words", "spans", "items",
           "label", "kind", "attempt", "piece", "file", "hash", "part", "weight", "predicted", "text_", "mark", "group")

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def grams(text, n=5):
    w = words(text)
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def odd_rows():
    prose = " ".join(f"wort{i % 97}{'ä' if i % 5 == 0 else ''}" for i in range(300))
    long = " ".join(f"Long{i % 1013} e{i}." for i in range(40_000))
    return [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, prose, "de", "a", 5), (4, prose, None, "b", None),
        (4, prose, None, "b", None), (5, "x", "en", None, 1), (6, long, "en", "a", len(long)),
        (7, "tab\tand\r\nnew\n\nline é 日本語 🙂 \u0000 <|endoftext|> İ ß", "xx", "", 9), (None, "no id at all", "en", "a", 12),
        (None, None, None, None, None), (8, "   \n  ", "en", "a", 7), (9, prose + " more words here", "de", "a", 1),
        (-10, prose.upper(), "de", "a", 1),
    ]


def odd_documents(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(odd_rows(), DOCS)
    for i, c in enumerate(CLASHES):
        df = df.withColumn(c, F.lit(i) if i % 2 else F.lit(f"v{i}"))
    return df


def empty_documents(spark):
    return spark.createDataFrame([], DOCS)


def fixture_documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
