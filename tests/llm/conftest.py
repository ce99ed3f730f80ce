import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) pairs, with an extra column whose
    names clash with those that operators use inside."""

    def make(rows):
        full = [(i, t, "en", "src0", None if t is None else len(t), "x", 1) for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, fp string, shard int")

    return make


EDGES = [(0, None), (1, ""), (2, " \n\t "), (3, "word"), (None, "a null id"), (5, "Word " * 30_000), (5, "Word " * 30_000), (6, "é中\u00a0x\u0000y"), (7, "A.b,c!")]


@pytest.fixture(scope="session")
def edge_docs(docs_of):
    return docs_of(EDGES)


@pytest.fixture(scope="session")
def no_docs(docs_of):
    return docs_of([(0, "x")]).where("doc_id < 0")
