import random

import pytest

from clutchforge.llm.common import prepare

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, words array<string>, uid string, size long, "
          "rows string, score string, label string, block string, copies string, spans string, `a.b` string")


@pytest.fixture(scope="session")
def llm(spark):
    return prepare(spark)


def frame(spark, rows):
    """documents (doc_id, text, source) with more columns of clashing names, read from files as jobs do."""
    import tempfile
    full = [(i, t, "en", s, None if t is None else len(t), ["x"], "u", 1, "r", "s", "l", "b", "c", "p", "d") for i, t, s in rows]
    path = tempfile.mkdtemp(prefix="llm-frame-") + "/t"
    spark.createDataFrame(full, SCHEMA).coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


def hard_rows(seed=3, n=40):
    """Null and empty texts, repeated rows, ties, near copies, a very long text, null ids and sources."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefgäñ") for _ in range(r.randint(1, 8))) for _ in range(300)]
    say = lambda k: " ".join(r.choice(vocabulary) for _ in range(k))
    rows = [(i, say(r.randint(0, 120)), f"s{i % 4}") for i in range(n)]
    base = say(100)
    for i in range(n, n + 12):
        w = base.split(" ")
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] = r.choice(vocabulary)
        rows.append((i, " ".join(w), "s1"))
    rows += [(100, None, None), (101, "", "s0"), (102, " \t\n ", "s0"), (103, base, "s2"), (104, base.replace(" ", "  \n"), None),
             (105, say(20000), "s3"), (106, "Mit License und CC-BY", "s0"), (None, "no id at all", "s0"),
             (None, "no id at all", "s0"), (107, "one", "s1"), (107, "one", "s1"), (107, "one", "s1")]
    return rows
