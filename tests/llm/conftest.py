import pytest

from cohortspark.sources.scratch import Scratch

# Extra columns that carry names the operators use inside.
CLASHES = ("key", "block", "n", "keys", "rep", "chunk", "shard", "words", "open", "cluster")


@pytest.fixture
def scratch(spark):
    with Scratch(spark) as folder:
        yield folder


@pytest.fixture
def docs(spark):
    def make(*rows, extra=True):
        """Documents from (doc_id, text), with columns that clash."""
        names = ", ".join(f"{c} string" for c in CLASHES) if extra else ""
        filled = [(*row, *["x"] * (len(CLASHES) if extra else 0)) for row in rows]
        return spark.createDataFrame(filled, "doc_id long, text string" + (", " + names) * extra)

    return make


@pytest.fixture
def corpus(spark):
    """The smallest given documents with odd ones added."""
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [tuple(r) for r in given.select("doc_id", "text").collect()]
    odd = [
        None, "", " ", "\n", "a", "a b", "one two three", "ONE two\tthree ", "x " * 9000,
        "É ß ŉ \u0130stanbul", "A\x1cB\x85C\u00a0D", "\n\n a \n\n a \n", "l" * 45, "<|endoftext|>",
    ]
    top = max(i for i, _ in texts) + 1
    return texts + [(top + i, t) for i, t in enumerate(odd)]
