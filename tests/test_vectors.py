import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ladle.operators import vectors


def test_top_k_is_exact_with_ties_and_zero_norm(spark):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(400, 8))
    data[7] = 0.0
    data[20] = data[10]
    data[30] = data[10] * 3
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], "id bigint, v array<float>").repartition(6)
    questions = {"a": data[10].tolist(), "b": rng.normal(size=8).tolist()}
    got = vectors.top_k(df, "id", "v", questions, 4).collect()
    f32 = data.astype(np.float32).astype(float)
    norm = np.linalg.norm(f32, axis=1, keepdims=True)
    unit = np.divide(f32, norm, out=np.zeros_like(f32), where=norm > 0)
    for name, q in questions.items():
        s = np.round(unit @ (np.array(q) / np.linalg.norm(q)), 6)
        want = sorted(range(400), key=lambda i: (-s[i], i))[:4]
        assert [r.id for r in sorted((r for r in got if r.question == name), key=lambda r: r["rank"])] == want
    assert [r.id for r in sorted((r for r in got if r.question == "a"), key=lambda r: r["rank"])][:3] == [10, 20, 30]


def test_null_vectors_score_zero_and_ragged_ones_leave(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [1.0]), (4, [0.0, 1.0])], "id bigint, v array<float>")
    got = {r.id: r.score for r in vectors.top_k(df, "id", "v", {"q": [1.0, 0.0]}, 4).collect()}
    assert got == {1: 1.0, 2: 0.0, 4: 0.0}  # a null scores 0, another width cannot be compared


def test_long_question_lists_go_in_blocks(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [-1.0])], "id bigint, v array<float>")
    n = vectors.QUESTIONS_AT_ONCE + 5
    got = vectors.top_k(df, "id", "v", {str(i): [1.0] for i in range(n)}, 1)
    assert got.count() == n and got.select("id").distinct().collect()[0][0] == 1


def test_other_widths_take_no_part(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 2.0, 3.0])], "id bigint, v array<float>")
    assert [r.id for r in vectors.top_k(df, "id", "v", {"q": [1.0, 0.0]}, 4).collect()] == [1]
    with pytest.raises(ValueError):
        vectors.centroids(df.withColumn("l", df["id"] * 0), "l", "v")


def test_letters_of_all_scripts_are_tokens():
    import numpy as np
    assert not np.array_equal(vectors.token_vector("été à Zürich"), vectors.token_vector("t z rich"))
    assert vectors.token_vector("сталь и прокат").sum() == 3


def test_embedding_counts_tokens_and_reads_whole_texts():
    a = vectors.token_vector("Steel steel, STEEL; bar!")
    assert a.sum() == 4 and a.max() >= 3
    long = vectors.token_vector("x " * 200000 + "tail")
    assert long.sum() == 200001
    assert vectors.token_vector("").sum() == 0


def test_index_sync_embeds_only_changes(spark):
    index = spark.createDataFrame([("a", "old", [1.0]), ("b", "keep", [2.0]), ("c", "gone", [3.0])], "k string, t string, v array<float>")
    feed = spark.createDataFrame([("a", "new text", "update"), ("c", None, "delete"), ("d", "fresh", "insert")], "k string, t string, change_type string")
    got = {r.k: (r.t, len(r.v)) for r in vectors.sync_index(index, feed, "k", "t", "v").collect()}
    assert got == {"a": ("new text", 256), "b": ("keep", 1), "d": ("fresh", 256)}


def test_embedding_of_many_long_texts_is_bounded(spark):
    texts = pa.array(["aa bb " * 100_000, None, "", *["cc dd"] * 3000])
    pieces = list(vectors._pieces(texts))
    assert pa.concat_arrays(pieces).equals(texts)
    assert all(len(p) == 1 or len(p) <= vectors.TEXTS_AT_ONCE and p.nbytes <= 2 * vectors.BYTES_AT_ONCE for p in pieces)
    assert len(list(vectors._pieces(pa.array(["x" * vectors.BYTES_AT_ONCE] * 3)))) == 3
    want = vectors.token_matrix(texts)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts.to_pylist())], "id long, text string").repartition(2)
    got = df.select(vectors.embed_column("text").alias("v"), "id").orderBy("id").collect()
    assert np.array([r["v"] for r in got]).tolist() == want.tolist()


def test_sql_function_embeds_the_question_once(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["aa bb " * 9, None, "", *["cc dd"] * 3000])], "id long, text string")
    profiles = df.select(F.col("id").cast("string").alias("k"), F.coalesce("text", F.lit("")).alias("t")).withColumn("v", vectors.embed_column("t"))
    vectors.register_search_function(spark, profiles, "k", "t", "v")
    found = spark.sql("SELECT * FROM search_customer_profiles('dd aa')")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "ArrowEvalPython" in line and "embed_text" in line and "embed(" in line]
    assert "BroadcastNestedLoopJoin" in plan and [r["customer_hk"] for r in found.collect()] == ["0", "10", "100", "1000", "1001"]
