import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty and blank texts, ties, repeated rows, upper case, a long text, an extra column with a clashing name."""
    long = " ".join(f"w{k % 701}" for k in range(6000))
    passage = " ".join(f"p{k}" for k in range(40))
    rows = [
        (0, "Hello World this is a text", "en", "a"), (1, "hello world THIS is a text", "en", "a"), (2, None, None, None), (3, "", "en", "b"), (4, " \t\n", None, "b"),
        (5, long, "en", "b"), (6, long + " tail", "de", "b"), (7, f"before {passage} after one", "en", "c"), (8, f"other {passage} end", "de", "c"), (9, "été à la plage ÀÉ", "fr", None),
        (10, "x y z", "en", "c"), (11, "X Y Z", "en", "c"), (12, "12 34 56", "de", "d"), (13, "rep eat", "fr", "d"), (13, "rep eat", "fr", "d"), (40, "idiot scum you", "en", "a"),
    ]
    return spark.createDataFrame([(*r, "q") for r in rows], "doc_id long, text string, lang string, source string, norm string")


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")
