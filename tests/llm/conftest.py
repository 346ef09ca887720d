import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    ]
)
WORDS = "amber birch cedar delta ember fjord grove heron inlet juniper kelp lotus maple nectar otter pine quartz river spruce tidal".split()


def sentence(seed: int, words: int) -> str:
    """Different invented prose for every seed."""
    out, x = [], seed * 7_919 + 1
    for k in range(words):
        x = (x * 1_103_515_245 + 12_345) % (1 << 31)
        out.append(WORDS[(x >> 8) % len(WORDS)] + ("s" if (x >> 20) % 3 == 0 else ""))
    return " ".join(out)


@pytest.fixture
def make_documents(spark):
    """Documents from (doc_id, text[, source[, lang]]) with columns whose names clash with those operators add."""

    def make(rows):
        full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "a", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture
def clashing(make_documents):
    """A frame whose further columns carry names that operators use for their own."""
    from pyspark.sql import functions as F

    def make(rows):
        names = ("size", "score", "kept", "n_words", "length", "offset", "key", "node", "rate", "copies", "row_number", "th", "did", "predicted")
        return make_documents(rows).withColumns({n: F.lit("mine") for n in names})

    return make
