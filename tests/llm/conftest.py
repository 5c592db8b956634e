import random

import pytest

#: Columns whose names an operator may use inside.
CLASHES = "fp long, key long, row string, length long, ghost boolean, _slot int, h long, n long, word string, score double, quality int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows and clashing columns."""
    rng = random.Random(7)
    words = [w + s for w in ("alpha", "Beta", "gámma", "the", "of") for s in ("", "1", "x", ".", ",")]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    long = text(9000)
    rows = [(1, None), (2, ""), (3, long), (4, long + " tail"), (5, "the"), (6, "the of"), (7, " \n\t "), (None, "no id here"), (8, "x" * 5000)]
    base = text(400)
    rows += [(9, base), (10, base), (10, base), (11, base.replace("the", "THE")), (12, base + "\nmore"), (12, "other text of twelve")]
    rows += [(20 + i, text(rng.randint(1, 60)) + "\n" + text(5)) for i in range(12)]
    rows += [(40, "All Rights Reserved. cc by cc by\nGeneral Public License"), (41, "日本語 テキスト\r\n<|endoftext|> emoji 😀😀")]
    clash = (1, 2, "r", 3, True, 4, 5, 6, "w", 0.5, 1)
    return spark.createDataFrame([(i, t, "en", "src0", None if t is None else len(t), *clash) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, " + CLASHES)


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)
