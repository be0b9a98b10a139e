import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

# Defined inputs that every operator must survive: null, empty, blank, one word, a
# very long word, a very long text, and non-ASCII text.
ODD_TEXTS = [None, "", "   \n\t ", "word", "x" * 100_000, "lorem ipsum dolor sit amet " * 4000, "für été ñandú 中文 😀 \x1c\x85　 end"]


@pytest.fixture
def docs_of(spark):
    """Documents from texts (ids from 0), with the table's own columns."""
    def build(texts, ids=None):
        ids = list(range(len(texts))) if ids is None else ids
        return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in zip(ids, texts)], SCHEMA)

    return build


@pytest.fixture
def odd_docs(docs_of):
    """Odd texts, repeated rows, null ids and clashing extra columns."""
    from pyspark.sql import functions as F

    texts = [*ODD_TEXTS, *ODD_TEXTS[:4], ODD_TEXTS[3]]
    ids = [*range(len(ODD_TEXTS)), 0, 1, 2, 3, None]
    extra = ("fp", "value", "kind", "component_id", "n_words", "row_key", "anchor", "window", "label", "features", "ids", "text_key")
    return docs_of(texts, ids).withColumns({c: F.lit(f"extra {c}") for c in extra})


@pytest.fixture
def words():
    """Random texts over a small vocabulary, repeatable."""
    def build(n, vocabulary=200, seed=0):
        rng = random.Random(seed)
        return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))

    return build
