"""Patterns in texts, and names that are alike, against comparisons of all pairs."""

import random
import time

import pytest

from pyspark.sql import functions as F

from lexledger.operators import contain, likeness


def test_patterns_equal_all_pairs(spark, monkeypatch):
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("abé ") for _ in range(n))
    texts = [(k, word(rng.randrange(60))) for k in range(60)] + [(1, "twice"), (99, None), (98, ""), (None, "ab")]
    patterns = [word(rng.randrange(1, 6)) for _ in range(150)] + ["", None, "ab", "ab", "twice"]
    df, known = spark.createDataFrame(texts, "id long, text string"), spark.createDataFrame([(p,) for p in patterns], "pattern string")
    want = sorted((str(i), p) for i, t in texts for p in set(patterns) if p is not None and t is not None and p in t)
    for most in (200_000, 40):  # one automaton, and several
        monkeypatch.setattr(contain, "BLOCK_PATTERNS", most)
        assert sorted((str(r.id), r.pattern) for r in contain.found_in(df, known, "id").collect()) == want
    assert contain.found_in(df, known.limit(0), "id").count() == 0 == contain.found_in(df.limit(0), known, "id").count()


def test_a_hundred_thousand_patterns(spark):
    known = spark.range(100_000).select(F.concat(F.lit("code-"), F.col("id").cast("string"), F.lit(";")).alias("pattern"))
    texts = spark.range(3000).select("id", F.concat(F.repeat(F.lit("plain words "), 30), F.lit("code-"), (F.col("id") * 31).cast("string"), F.lit("; tail")).alias("text"))
    began = time.perf_counter()
    got = {r.id: r.pattern for r in contain.found_in(texts, known, "id").collect()}
    assert got == {k: f"code-{31 * k};" for k in range(3000)} and time.perf_counter() - began < 60


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("most", [0, 1, 2, 3])
def test_alike_names_equal_all_pairs(spark, most):
    rng = random.Random(most)
    make = lambda: "".join(rng.choice("aabé") for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 6, 7, 8, 12])))
    left, right = [make() for _ in range(70)], [make() for _ in range(70)] + ["name of a field", "nmae of field"]
    left += [x[:3] + "z" + x[3:] for x in right[:20]] + ["name of a field", None]
    frame = lambda names: spark.createDataFrame([(n,) for n in [*names, *names[:5]]], "name string")
    want = sorted((a, b, edits(a, b)) for a in set(left) if a is not None for b in set(right) if edits(a, b) <= most)
    found = likeness.alike(frame(left), frame(right), most)
    assert sorted(tuple(r) for r in found.collect()) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_more_edits_are_refused(spark):
    with pytest.raises(ValueError, match="most"):
        likeness.alike(spark.createDataFrame([("a",)], "name string"), spark.createDataFrame([("a",)], "name string"), 4)
