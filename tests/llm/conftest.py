import pytest

CLASH = {"row": 1, "hash": "h", "block": "b", "score": 0.5, "lang_pred": "zz", "kind": 3, "words": "w", "rank": 9}


@pytest.fixture
def docs_of(spark):
    """A documents table of (doc_id, text) rows with further columns whose names operators use."""
    def make(rows, **extra):
        cols = {"lang": "en", "source": "s", "n_chars": 1} | CLASH | extra
        schema = "doc_id long, text string, lang string, source string, n_chars long, " \
                 "row int, hash string, block string, score double, lang_pred string, kind int, words string, rank int"
        return spark.createDataFrame([(i, t, *cols.values()) for i, t in rows], schema)
    return make


@pytest.fixture
def plain_rows():
    """Nulls, empty and long texts, repeated rows and ties."""
    import random

    rng = random.Random(5)
    words = ["w%d" % i for i in range(60)] + ["été", "ÜBER", "naïve"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    a, b, c = text(60), text(200), text(30)
    rows = [(1, a), (2, a), (3, a + " " + c), (4, b), (5, b.replace("w7", "w8")), (6, c), (7, None), (8, ""), (9, " \n\t "), (10, "x"),
            (10, "x"), (11, text(3000)), (12, "zz " + b + "  " + a), (13, "q" * 500), (14, "q" * 500 + "é"), (15, b.upper()), (16, c + "\n" + c)]
    return rows
