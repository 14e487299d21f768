import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

LOOP = "word " * 40
EDGE = [
    (1, None, "en", "s1"), (2, "", "en", "s1"), (3, "   \n\t ", None, "s1"), (4, "one", "en", None), (5, "one two", "en", "s1"),
    (6, "The Same text here, in ten words or more: a b c d.", "en", "s1"), (7, "the same TEXT here, in ten words or more: a b c d.", "en", "s2"),
    (8, "É ü ß 日本語 😀 text with other letters, mail a.b+c@x-y.example.org or +1 (415) 555-2671", "de", "s2"),
    (9, LOOP, "en", "s2"), (10, "a line\n" * 12, "en", "s2"), (None, "No number has this one, but it has words enough to stay", "en", "s2"),
    (11, "ten words and a card 4111 1111 1111 1111 from 10.0.255.1 " + "long text. " * 4000, "en", "s1"), (12, "x" * 30000, "en", "s1"),
    (13, "Released under the MIT License.", "en", "s1"), (14, "ÉTÉ ÀÉ <|endoftext|> Σ ΟΔΟΣ it's", "fr", "s1"),
    (15, "row that stands twice in the table, with words enough to stay", "en", "s1"), (15, "row that stands twice in the table, with words enough to stay", "en", "s1"),
]
NAMES = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside.
CLASHING = ("m", "v", "mask", "key", "n", "f", "u", "recipe", "keep_id", "norm", "tokens", "block", "budget", "shard", "row", "label", "node", "pii", "quality", "score",
            "__mix", "__source", "__plan", "__block", "__epoch", "__host", "__m", "__verdict", "__quality", "__keep", "__times", "__sha", "__again", "__digest",
            "__proposed_ip", "__id", "of_source", "plan", "epoch", "host", "of_host", "verdict", "keep", "times", "sha", "again", "digest", "proposed_ip", "mix", "m_")


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and long texts, ties, repeated rows."""
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in EDGE], NAMES).repartition(3)


@pytest.fixture(scope="session")
def clashing(edge):
    from pyspark.sql import functions as F
    return edge.withColumns({c: F.lit("own") for c in CLASHING})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], NAMES)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def tokenizer():
    from lendmart.llm.queries import tokenizer_path
    return tokenizer_path()
