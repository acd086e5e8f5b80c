"""The stages of the corpus pipeline, each on what the one before it kept."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from lexledger.llm import language
from tests.llm.test_minhash import brute
from tests.llm.test_suffixes import brute as brute_bytes

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark):
    rng = random.Random(5)
    vocabulary = {lang: [p + s for p in starts.split() for s in "a e i o an er en".split()] for lang, starts in {"en": "the wh ing st shr", "de": "sch ung pf zw ein"}.items()}
    make = lambda lang, n: " ".join(rng.choice(vocabulary[lang]) for _ in range(n))
    rows = [(k, make(lang := rng.choice(["en", "de"]), rng.choice([40, 90, 200])), lang, f"s{k % 3}") for k in range(60)]
    passage = make("en", 60)
    rows += [(100 + k, make("en", 30) + " " + passage + " " + make("en", 30), "en", "s0") for k in range(5)]
    rows += [(200 + k, rows[k][1], rows[k][2], "s1") for k in range(6)] + [(300, rows[9][1] + " tail", rows[9][2], "s2")]
    rows += [(400, None, "en", "s0"), (401, "12 34", None, "s0"), (402, "", "de", None)]
    return spark.createDataFrame([(d, t, lang, s, len(t or "")) for d, t, lang, s in rows], DOC)


def test_stages_take_effect(spark):
    docs = documents(spark)
    stages = dict(corpus_pipeline.STAGES)
    known = stages["language_id"](spark, docs, "").persist()
    assert known.columns == docs.columns
    model = language.fit(docs)
    scored = {r.doc_id: r.score >= language.MARGIN and r.lang_pred != "und" for r in language.identify(docs, model).collect()}
    assert {r.doc_id for r in known.collect()} == {d for d, ok in scored.items() if ok} and not {400, 401, 402} & {r.doc_id for r in known.collect()}
    rows = [(r.doc_id, r.text) for r in known.collect()]
    once = stages["minhash_near_dedup"](spark, known, "").persist()
    assert once.columns == docs.columns
    assert {r.doc_id for r in once.collect()} == {d for d, (_, _, kept) in brute(rows).items() if kept}
    cut = stages["suffix_array_dedup"](spark, once, "").persist()
    assert cut.columns == docs.columns
    want = {d: n - gone for d, n, gone, *_ in brute_bytes([(r.doc_id, r.text) for r in once.collect()])}
    assert {r.doc_id: len(r.text.encode()) for r in cut.collect()} == {d: n for d, n in want.items() if n}
    assert cut.where("n_chars <> length(text)").count() == 0
    mixed = stages["mixing"](spark, cut, "").persist()
    assert mixed.columns == docs.columns and mixed.select("doc_id").distinct().count() <= cut.count()
    packed = stages["packing"](spark, mixed, "")
    assert packed.where("piece = 0").count() == mixed.count()


def test_repeated_rows_and_missing_ids(spark):
    rows = [(1, "a b c d e f", "en", "s", 1)] * 3 + [(2, "a b c d e f", "en", "s", 1), (None, "a b c d e f", "en", "s", 1), (None, None, None, None, None)]
    got = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, DOC), "").collect()
    assert sorted((str(r.doc_id) for r in got)) == ["1", "None", "None"]


def test_near_copies_of_80_percent_go(spark):
    words = [f"w{i}" for i in range(100)]
    other = [f"x{i}" if i in (10, 50) else w for i, w in enumerate(words)]
    docs = spark.createDataFrame([(1, " ".join(words), "en", "s", 1), (2, " ".join(other), "en", "s", 1)], DOC)  # 86 of 106 shingles
    assert [r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()] == [1]


def test_whole_run_and_empty_table(spark, tmp_path):
    docs = documents(spark)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 40
    docs.limit(0).write.parquet(str(tmp_path / "none/documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_clashing_columns_keep_their_values(spark):
    names = ("score", "lang_pred", "n_bytes", "n_removed", "n_spans", "kept_sha256", "Spans", "copy", "shuffle_key", "_h", "_source", "row", "own_score_0", "back`tick", "a.b", "Back``Tick ")
    docs = documents(spark)
    for c in names:
        docs = docs.withColumn(c, F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, "")
        assert got.columns == docs.columns, name
        rows = got.collect()
        assert rows and all(r[c] == f"{c} of {r.doc_id}" for r in rows for c in names), name


def test_blocks_are_written_to_the_shared_folder(spark):
    before = {r.namespace for r in spark.sql("SHOW DATABASES").collect()}
    assert corpus_pipeline.suffix_dedup(spark, documents(spark), "").count() > 0
    assert {r.namespace for r in spark.sql("SHOW DATABASES").collect()} == before  # dropped, and its tables with it
