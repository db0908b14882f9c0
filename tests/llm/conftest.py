import pytest

from coursepulse.llm.shipping import ship_package

#: Null and empty texts, white space only, a very long text, ties, copies and a repeated row.
LONG = " ".join(f"word{i % 700}x{i % 13}" for i in range(30_000))
PROSE = "the quick brown fox jumps over the lazy dog while seven grey birds watch from a tall green tree nearby"
EDGE = [(0, None), (1, ""), (2, " \n\t "), (3, LONG), (4, PROSE), (5, PROSE + " "), (6, PROSE.replace(" ", "\n")),
        (7, "a b"), (8, "a b"), (9, "Ünïcode ß 한국 ▁ \x00 &amp; <|endoftext|>"), (4, PROSE), (10, LONG + " tail")]
CLASHES = "lang string, n_words long, kept boolean, grp long, digit long, n long, rest string, features string, row string, t long, x long"


@pytest.fixture(scope="session")
def docs(spark):
    """``docs(rows)``: a table of documents with extra columns whose names the operators use themselves."""
    ship_package(spark)

    def make(rows):
        return spark.createDataFrame([(*r, "en", 1, True, 1, 1, 1, "r", "f", "w", 1, 1) for r in rows],
                                     "doc_id long, text string, " + CLASHES)

    return make


@pytest.fixture(scope="session")
def edge(docs):
    return docs(EDGE)


@pytest.fixture(scope="session")
def empty(docs):
    return docs([])
