import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lexiloom.operators import language, perf, profile, reports
from lexiloom.operators.cleaning import process_documents
from lexiloom.operators.language import language_profile, with_language, words
from lexiloom.sources.reports import write_report


def docs(spark):
    rows = [
        (0, "a" * 10, "x"),
        (1, "a" * 10, "x"),
        (2, "b" * 31, "y"),
        (3, " \n", "y"),
        (4, None, "z"),
        (5, None, "z"),
        (6, "c" * 40, None),
    ]
    return spark.createDataFrame(rows, "doc_id LONG, text STRING, category STRING")


def test_raw_profile(spark):
    got = profile.raw_profile(docs(spark)).first().asDict()
    assert got == {
        "total_docs": 7,
        "null_count": 2,
        "empty_or_whitespace_count": 1,
        "duplicate_count": 2,
        "encoding_issue_count": 0,
        "length_min": 2,
        "length_max": 40,
        "length_mean": 18.6,
        "length_median": 10.0,
        "very_short_count": 3,
    }


def test_profiles_of_an_empty_table(spark):
    none = docs(spark).filter("doc_id < 0")
    got = profile.raw_profile(none).first()
    assert (got.total_docs, got.duplicate_count, got.length_mean) == (0, 0, None)
    quality = profile.quality_profile(process_documents(none)).first()
    assert (quality.total_docs, quality.pct_reduction) == (0, 0.0)


def test_reduction_uses_rounded_averages(spark):
    df = spark.createDataFrame(
        [("a", 10, 1), ("b", 11, 2), ("c", 11, 2)], "clean_text STRING, original_length INT, clean_length INT"
    )
    row = profile.quality_profile(df).first()
    assert (row.avg_original_length, row.avg_clean_length) == (10.7, 1.7)
    assert row.pct_reduction == round(100 * (1 - 1.7 / 10.7), 1)


def test_duplicates_are_merged_before_the_shuffle(spark):
    plan = profile.duplicate_count(docs(spark), "text")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 4 and "sha2" in plan


def test_categories_and_languages(spark):
    counts = profile.category_counts(docs(spark)).collect()
    assert [(r.category, r.n) for r in counts] == [(None, 1), ("x", 2), ("y", 2), ("z", 2)]
    assert profile.category_cardinality(docs(spark)).first()[0] == 3
    df = spark.createDataFrame([(c,) for c in "bbaac"], "language STRING")
    top = profile.language_distribution(df, top=2).collect()
    assert [(r.language, r.n, r.pct) for r in top] == [("a", 2, 40.0), ("b", 2, 40.0)]


def test_reports(spark, tmp_path):
    report = reports.profile_report(docs(spark))
    lines = [r.line for r in reports.report_lines(report, "Profile").collect()]
    assert lines[0].startswith("# Profile") and "- Mean: 18.6" in lines and "- x: 2" in lines
    assert lines.index("- Mean: 18.6") > lines.index("- Null text entries: 2")
    write_report(report, str(tmp_path / "report"), "Profile")
    written = "\n".join(r.value for r in spark.read.text(str(tmp_path / "report")).collect())
    assert "## Category Distribution" in written

    processed = process_documents(docs(spark)).withColumn("language", F.lit("en"))
    values = {r.metric: r.value for r in reports.quality_report(processed).collect()}
    assert values["Total documents processed"] == "7" and values["en"] == "7 (100.0%)"
    assert values["Average size reduction"].endswith("%")


def test_language_on_held_out_documents(spark, folder):
    data = spark.read.parquet(f"{folder}/documents.parquet").filter(F.length("text") > 40)
    trained = language_profile(data.filter("doc_id % 2 = 0"))
    held = data.filter("doc_id % 2 = 1")
    right = with_language(held, trained, "text").filter("language = lang").count()
    assert right / held.count() > 0.97


def test_undecidable_language(spark):
    train = spark.createDataFrame([("the cat", "en"), ("le chat", "fr")], "text STRING, lang STRING")
    df = spark.createDataFrame(
        [(1, "the dog"), (2, "1234 !!"), (3, None), (4, ""), (5, "le the")], "doc_id LONG, clean_text STRING"
    )
    profile = language_profile(train)
    want = {1: "en", 2: "unknown", 3: "unknown", 4: "unknown", 5: "en"}
    for bound in (10, 0):
        got = with_language(df, profile, profile_bound=bound).collect()
        assert {r.doc_id: r.language for r in got} == want
    assert with_language(df.limit(0), profile).count() == 0
    nothing_known = with_language(df, profile.limit(0)).select("language").distinct().collect()
    assert [r.language for r in nothing_known] == ["unknown"]


def test_language_depends_on_the_text_alone(spark):
    train = spark.createDataFrame([("the cat", "en"), ("le chat", "fr")], "text STRING, lang STRING")
    rows = [(1, "the dog"), (1, "1234"), (1, "le chat"), (None, "le chat")]
    df = spark.createDataFrame(rows, "doc_id LONG, clean_text STRING")
    for bound in (10, 0):
        got = with_language(df, language_profile(train), profile_bound=bound).collect()
        assert sorted((r.clean_text, r.language) for r in got) == [
            ("1234", "unknown"), ("le chat", "fr"), ("le chat", "fr"), ("the dog", "en")
        ]


UNSPACED = [
    ("我们在北京的学校学习中文", "zh"), ("他们不喜欢在家里吃饭", "zh"), ("这是一本很好的书", "zh"),
    ("私は学校で日本語を勉強します", "ja"), ("彼は本を読んでいます", "ja"), ("これは良い本です", "ja"),
    ("ฉันเรียนภาษาไทยที่โรงเรียน", "th"), ("เขาชอบกินข้าวที่บ้าน", "th"),
    ("the school is in the city", "en"),
]


def test_language_of_scripts_without_spaces(spark):
    train = spark.createDataFrame(UNSPACED, "text STRING, lang STRING")
    held = [(1, "我在学校吃饭", "zh"), (2, "私は本を読みます", "ja"), (3, "ฉันกินข้าว", "th"),
            (4, "city 学", "en"), (5, "한국어", "unknown"), (6, "中", "zh"), (7, "我在学校吃饭", "zh"), (8, None, "unknown")]
    df = spark.createDataFrame(held, "doc_id LONG, clean_text STRING, lang STRING")
    for bound in (1000, 0):
        got = with_language(df, language_profile(train), profile_bound=bound).collect()
        assert {r.doc_id: r.language for r in got} == {i: lang for i, _, lang in held}


def test_words_of_mixed_scripts(spark):
    df = spark.createDataFrame([("Ab 北京x1 大",), ("no pairs",), ("",), (None,)], "t STRING")
    got = [r.w for r in df.select(words(F.col("t")).alias("w")).collect()]
    assert got == [["ab", "x", "北", "京", "大", "北京"], ["no", "pairs"], [], None]


def test_language_of_a_long_text_and_many_languages(spark):
    train = spark.range(600).selectExpr("concat('w', translate(id, '0123456789', 'abcdefghij')) AS text", "concat('l', id) AS lang")
    df = spark.createDataFrame([(1, "wfb " * 400_000 + "wa"), (2, "wfjj")], "doc_id LONG, clean_text STRING")
    for bound in (1000, 0):
        got = with_language(df, language_profile(train), profile_bound=bound).collect()
        assert {r.doc_id: r.language for r in got} == {1: "l51", 2: "l599"}


def test_merged_sketches(spark):
    df = spark.range(60_000).selectExpr("id % 7 AS day", "id % 20000 AS v", "CAST(NULL AS BIGINT) AS nothing")
    states = profile.distinct_sketches(df, F.col("v"), "day")
    estimate = profile.merged_distinct(states).first().distinct_estimate
    assert abs(estimate - 20_000) <= profile.SKETCH_ERROR * 20_000
    assert max(len(r.sketch) for r in states.collect()) <= (1 << profile.SKETCH_SIZE) + 64
    empty = profile.distinct_sketches(df, F.col("nothing"), "day")
    assert {r.distinct_estimate for r in profile.merged_distinct(empty, "day").collect()} == {0}
    assert profile.merged_distinct(states.limit(0), "day").count() == 0


def test_language_needs_no_shuffle(spark):
    train = spark.createDataFrame([("the cat", "en")], "text STRING, lang STRING")
    df = spark.range(5).selectExpr("id AS doc_id", "'the' AS clean_text")
    plan = with_language(df, language_profile(train))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "ArrowEvalPython" in plan


def test_batch_stats(spark):
    df = spark.createDataFrame(
        [("b1", 2.0, [1.0, 0.0]), ("b1", 2.0, [0.0, 1.0]), ("b2", 0.5, [0.0, 1.0])],
        "batch STRING, s DOUBLE, embedding ARRAY<FLOAT>",
    )
    got = {r.batch: r for r in perf.batch_stats(df, ["batch"], "s").collect()}
    assert (got["b1"].num_chunks, got["b1"].total_time_sec, got["b1"].avg_time_per_chunk_sec) == (2, 2.0, 1.0)
    assert got["b2"].embedding_dim == 2
    assert perf.batch_stats(df.limit(0), ["batch"], "s").count() == 0


def test_published_rollup_shape(spark):
    """Two models; the sums and means are those of a hand calculation."""
    df = spark.createDataFrame(
        [("m", 256, 15.742, 384), ("m", 254, 8.9, 384), ("n", 1, 0.2158, 64)],
        "model_name STRING, num_chunks INT, total_time_sec DOUBLE, embedding_dim INT",
    )
    got = {r.model_name: r for r in perf.embedding_rollup(df).collect()}
    assert (got["m"].num_chunks, got["m"].total_time_sec) == (510, 24.64)
    assert got["m"].avg_time_per_chunk_sec == round(24.642 / 510, 6)


def test_words_held_decide_most_texts_and_the_others_are_joined(spark, monkeypatch):
    from lexiloom.operators import language

    rows = [("the cat sat on the mat rare%d" % (i % 7), "en") for i in range(40)]
    rows += [("le chat est sur le tapis seul%d" % (i % 7), "fr") for i in range(40)] + [("the le both", "xx"), ("abc once", "xx")]
    train = spark.createDataFrame(rows, "text STRING, lang STRING")
    texts = ["the cat", "le chat the", "once", "the once once once", "both", "seul on", "nothing", None, "le le the", "the le"]
    df = spark.createDataFrame(list(enumerate(texts)) + [(50, "once")], "doc_id LONG, clean_text STRING")
    profile = language_profile(train)
    want = {r.doc_id: r.language for r in with_language(df, profile).collect()}
    joined, real = [], language._joined
    monkeypatch.setattr(language, "_joined", lambda d, *rest: joined.append(d.count()) or real(d, *rest))
    for bound in (0, 3, 6, 9, profile.count() - 1):
        got = {r.doc_id: r.language for r in with_language(df, profile, profile_bound=bound).collect()}
        assert got == want
    assert joined[0] == 11 and joined[-1] < 8


def test_characters_are_counted_and_scored_as_numbers(spark):
    texts = ["漢字かな交じり文 and words", "a漢b字\U00020000\U00020001漢漢漢", "ภาษาไทย ไทย", "plain words only", "", None, "ßé 漢", "々〆ー"]
    rows = [(i, t, "ab"[i % 2]) for i, t in enumerate(texts * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    met = docs.select("lang", F.explode(language.words(F.col("text"))).alias("word"))
    want = {(r.lang, r.word): r["count"] for r in met.groupBy("lang", "word").count().collect()}
    total = {x: sum(n for (y, _), n in want.items() if y == x) for x in "ab"}
    profile = language.language_profile(docs)
    got = {(r.language, r.word): r.weight for r in profile.collect()}
    assert got.keys() == want.keys() and any(len(w) == 2 and ord(w[0]) > 0xFFFF for _, w in got)
    assert all(abs(w - math.log(1 + want[k] / total[k[0]] / language.FLOOR)) < 1e-6 for k, w in got.items())
    # Neither the profile nor the classifier makes a row or a text of every character any more.
    plan = profile._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan
    ways = {}
    for bound in (10**6, 10, 0):
        found = language.with_language(docs, profile, "text", profile_bound=bound)
        ways[bound] = sorted((r.doc_id, r.language) for r in found.collect())
    assert ways[10**6] == ways[10] == ways[0] and {x for _, x in ways[0]} == {"a", "b", "unknown"}


def test_scores_are_the_same_as_a_table_and_by_entries(monkeypatch):
    rng = np.random.default_rng(3)
    words, langs = [f"w{i}" for i in range(30)], ["x", "y", "z"]
    pairs = [(w, x) for w in words for x in langs if rng.random() < 0.6]
    table = pa.table({"language": [x for _, x in pairs], "word": [w for w, _ in pairs], "weight": np.round(rng.random(len(pairs)), 6)})
    held = language._Profile(table, 0.0, np.zeros(language._POINTS, dtype=bool))
    text_of, place = np.sort(rng.integers(0, 50, 4000)), rng.integers(0, len(held.words), 4000)
    found = held.scores(50, text_of, place)
    monkeypatch.setattr(language, "_CELLS", 100)
    cut = held.scores(50, text_of, place)
    monkeypatch.setattr(language, "_SPARSE", 0)
    assert (held.scores(50, text_of, place) == found).all() and (cut == found).all() and found.any()
