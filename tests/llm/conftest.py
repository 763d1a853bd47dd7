import sys

import pytest

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(20_000))

# nulls, empty and blank texts, a very long one, ties, copies, near copies, repeated rows
ROWS = [
    (1, "One two three four five six seven. " * 12, "en", "src1", 5, "x"),
    (2, "One two three four five six seven. " * 12, "en", "src2", 5, "x"),
    (3, None, "en", "src1", None, None),
    (4, "", None, None, 0, ""),
    (5, " \t\n ", "de", "src3", 3, "y"),
    (6, LONG, "en", "src1", len(LONG), "z"),
    (7, LONG + " end", None, "src1", len(LONG) + 4, "z"),
    (8, "12345 !!! ???", "fr", "other", 13, "z"),
    (None, "a text without an id " * 20, "en", "src9", 1, None),
    (9, "zwölf große Bären " * 30 + "\nline\nline\n", "de", "src3", 9, "q"),
    (9, "zwölf große Bären " * 30 + "\nline\nline\n", "de", "src3", 9, "q"),
    (10, "x", "en", "src1", 1, "q"),
]
# extra columns whose names are those that operators add or use inside
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, Score string"
EXTRA = ("fingerprint", "fp", "node", "root", "component_id", "token_ids", "decoded", "shard", "slot", "size", "tie", "h",
         "lines", "host", "kept", "lang_pred", "held_out", "tokens", "epoch", "take_tokens", "domain", "budget", "__text",
         "text_key", "label", "toxic", "quality", "x")


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with every awkward case, and columns with clashing names."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.select("*", *[F.lit("clash").alias(c) for c in EXTRA])


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


sys.modules.setdefault("llm_cases", sys.modules[__name__])
