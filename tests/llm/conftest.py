from pathlib import Path

import pytest

SF = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    if not SF.exists():
        pytest.skip("the synthetic tables are not here")
    return str(SF)


#: Cases that every operator must bear: null, empty, no letter, short, repeated, very long.
ODD = [(1, None), (2, ""), (3, "?!"), (4, "a"), (5, "one two"), (5, "one two"), (None, "no id at all"), (7, "word " * 30_000), (8, "é　 \n\t x"), (9, "same text here " * 20), (10, "same text here " * 20)]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, "en" if i and i % 2 else None, "s", 0, True, -1) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score int")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")
