import pytest

from shelfmark.llm.common import quoted


@pytest.fixture()
def docs(spark):
    """A documents frame from (doc_id, text) pairs; extra columns clash with names the operators use."""

    def make(pairs, **extra):
        columns = "doc_id bigint, text string" + "".join(f", {quoted(k)} string" for k in extra)
        return spark.createDataFrame([(*p, *extra.values()) for p in pairs], columns)

    return make


CLASHING = {k: "x" for k in (
    "seed", "at", "hits", "rid", "spans", "items", "n_words", "print", "row", "score", "label", "size", "part",
    "start", "text_hash", "piece_ids", "count", "kept_id", "my col", "a.b", "a:b", "a-b")}


@pytest.fixture()
def clashing():
    return dict(CLASHING)
