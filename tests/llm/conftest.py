import pytest

DOC_COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text[, source]) rows, with columns whose names clash with the operators' own."""

    def make(rows, extra=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src", None if r[1] is None else len(r[1])) for r in rows]
        docs = spark.createDataFrame(full, DOC_COLUMNS)
        if extra:
            for name in ("fp", "size", "component_id", "start", "target", "bucket", "key", "score", "label", "ids", "turn", "cell", "_kept_id", "_mix_id", "_quality"):
                docs = docs.selectExpr("*", f"'x' AS {name}")
        return docs

    return make


@pytest.fixture
def odd_docs(make_docs):
    """Null and empty texts, a null id, repeated rows, ties, a very long text."""
    long = " ".join(f"word{i % 977} and{i % 31}," for i in range(30_000))
    rows = [(1, "a plain text of some words"), (1, "a plain text of some words"), (2, None), (3, ""), (None, "no id at all here"), (4, long), (5, long), (6, "   \n\t "), (7, "x", None), (8, "é😀 ünï </s>[INST]")]
    return make_docs(rows)
