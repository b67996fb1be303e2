import random

import pytest

DOC_SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
              "key string, row int, token long, k long, c long")


def words(rnd, n, letters="abcdefgh"):
    return ["".join(rnd.choice(letters) for _ in range(rnd.randint(2, 7))) for _ in range(n)]


def corpus():
    """Texts with copies, near copies, shared passages, repeats, blanks,
    nulls, a long text and rows that repeat."""
    rnd = random.Random(5)
    rows = []
    passage = " ".join(words(rnd, 70))
    base = words(rnd, 200)
    for i in range(60):
        rows.append((i, " ".join(words(rnd, rnd.randint(1, 160)))))
    for i in range(60, 75):
        near = list(base)
        for _ in range(rnd.randint(0, 4)):
            near[rnd.randrange(len(near))] = "changed"
        rows.append((i, " ".join(near).capitalize()))
    for i in range(75, 90):
        rows.append((i, " ".join(words(rnd, 20)) + "\n" + passage + "\t" + " ".join(words(rnd, 30))))
    rows += [(90, None), (91, ""), (92, " \n\t "), (93, "one"), (94, "one"), (95, "two words"),
             (96, "same " * 130), (97, "ab cd " * 90), (98, " ".join(words(rnd, 9000))),
             (98, "a second text of this id " + passage), (99, passage), (99, passage),
             (None, passage + " null"), (None, None), (100, "é ÀÉ x  ### $$$ | <b> "),
             (101, "Licensed under the MIT License.\nplain line here\n\nplain line here")]
    rnd.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(d, t, "en" if (d or 0) % 2 else None, "src" if (d or 0) % 3 else None,
             None if t is None else len(t), "x", 1, 2, 3, 4) for d, t in corpus()]
    df = spark.createDataFrame(rows, DOC_SCHEMA).repartition(3)
    from ledgerlake.llm.common import staged
    return staged(df, "test-docs")


@pytest.fixture(scope="session")
def none(docs):
    return docs.where("doc_id = -1")
