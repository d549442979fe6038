"""Retention and phrase keywords against direct Python versions."""

import random

from pyspark.sql import functions as F

from tests.conftest import SF01
from tidepool.operators import keywords, retention


def test_retention_by_sets(spark):
    r = random.Random(5)
    rows = [(r.choice(["a", "b", None]), r.choice([1, 2, 3, 4, None]), r.choice([1, 2, 3, 5, 8, None]))
            for _ in range(150)]
    df = spark.createDataFrame(rows, "g string, m int, p int").repartition(5)
    got = {(x["g"], x["lag"]): (x["seen"], x["kept"], x["kept_bp"])
           for x in retention.retention(df, ["g"], "m", F.col("p"), [1, 3, 9]).collect()}
    have = {x for x in rows if x[1] is not None and x[2] is not None}
    want = {}
    for g in ("a", "b", None):
        for lag in (1, 3, 9):
            seen = [x for x in have if x[0] == g and x[2] + lag <= 8]
            kept = [x for x in seen if (g, x[1], x[2] + lag) in have]
            if seen:
                want[g, lag] = (len(seen), len(kept), 10000 * len(kept) // len(seen))
    assert got == want and len(got) == 6
    assert retention.retention(df.where("false"), ["g"], "m", F.col("p"), [1]).collect() == []


def longest(rows, skills, most):
    out = []
    for key, text in rows:
        w = (text or "").lower().split()
        for i in range(len(w)):
            for k in range(most, 0, -1):
                if i + k <= len(w) and tuple(w[i:i + k]) in skills:
                    out.append((key, i, " ".join(w[i:i + k]), k))
                    break
    return sorted(out)


def test_longest_phrases_broadcast_and_shuffled(spark):
    r = random.Random(6)
    names = "a b c d e".split()
    skills = {tuple(r.choice(names) for _ in range(r.randint(1, 3))) for _ in range(25)}
    skills |= {("A".lower(), "b", "c", "d"), ("e", "e", "e", "e")}
    skills.discard(("e",))
    rows = [(i, " ".join(r.choice(names).upper() for _ in range(r.randint(0, 30)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "a b c d"), (103, "a b c"), (104, "e")]
    docs = spark.createDataFrame(rows, "id int, text string")
    known = spark.createDataFrame([(list(s),) for s in skills] + [(None,), ([],), (["a"] * 9,)],
                                  "p array<string>")
    w = keywords.words(F.col("text"), r"\s+")
    for most in (1_000_000, 1):
        got = keywords.longest_matches(docs, "id", w, known, "p", 4, max_broadcast_rows=most)
        assert sorted(map(tuple, got.collect())) == longest(rows, skills, 4)


def test_words_of_texts_are_not_shuffled(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    known = spark.createDataFrame([(["the", "of"],), (["the"],)], "p array<string>")
    found = keywords.longest_matches(docs, "doc_id", keywords.words(F.col("text"), " "), known, "p")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hash" not in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
