import pytest

SF_SMALL = "/root/testdata/sf0.001"

#: Null, empty, repeated and clashing rows that every operator must take.
ODD = [(1, "Alpha beta gamma delta epsilon zeta"), (2, "alpha beta gamma delta epsilon zeta"), (2, None), (3, ""),
       (None, "Alpha beta gamma delta epsilon zeta"), (None, None), (4, "x"), (4, "x"), (5, " \t\n"),
       (6, "É è ß 漢字   🙂 " * 50), (7, "word " * 20_000), (8, "y" * 60_000)]


@pytest.fixture(scope="module")
def odd(spark):
    """The odd rows, with extra columns whose names clash with the operators' own."""
    rows = [(i, t, "b", 1, "s", i, 2) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, h string, rid int, source string, keep_id long, n int")


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


def bag(df, *cols):
    """Rows as a sorted list of tuples (nulls first)."""
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: [(x is not None, x) for x in r])
