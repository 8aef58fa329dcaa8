import pytest

from ledgerlens.llm.common import reach


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    reach(spark)


@pytest.fixture(scope="session")
def corpus(spark):
    """Small documents with nulls, empty, long and repeated texts, ties, and columns that clash."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    prose = [" ".join(words[(i * k + i) % 10] + str(i * k % 37) for i in range(120)) for k in range(1, 8)]
    passage = "a passage that several of the documents hold, long enough to be found as a repeated string " * 2
    texts = [*prose, prose[0], prose[0] + " changed", passage + prose[1], prose[2] + "\n" + passage, None, "", " \n\t ", "one two",
             "repeat this line\n" * 80, "x" * 5000, "é漢😀" * 400, "*** %%% !!! " * 60, "Wörter " * 3 + passage]
    rows = [(i, t, "en", f"src{i % 3}", len(t or ""), 0.5, "clash", i) for i, t in enumerate(texts)]
    rows += [(3, texts[3], "en", "src0", len(texts[3]), 0.5, "clash", 3), (None, prose[4], None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "score double, keep_0 string, variant long")


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, 0 if i in (15, 18) else 1, 0) for i in range(20)] + [(None, 1, 0), (5, None, None), (99, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def nothing(corpus):
    return corpus.limit(0)
