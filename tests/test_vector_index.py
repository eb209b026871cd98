import numpy as np
import pytest
from pyspark.sql import functions as F

from ladle.operators import vector_index, vectors

SCHEMA = "id bigint, v array<float>"


@pytest.fixture(scope="module", autouse=True)
def fewer_rounds():
    vector_index.ROUNDS, before = 3, vector_index.ROUNDS
    yield
    vector_index.ROUNDS = before


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """3,000 vectors around 40 centres, a third of them around one; a NULL and one of another width."""
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((40, 24))
    which = np.where(rng.random(3000) < 0.33, 0, rng.integers(0, 40, 3000))
    data = (centres[which] + 0.35 * rng.standard_normal((3000, 24))).astype(np.float32)
    rows = [(i, x.tolist()) for i, x in enumerate(data)] + [(9000, None), (9001, [1.0, 2.0])]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    path = str(tmp_path_factory.mktemp("index"))
    vector_index.build(df, "id", "v", path, cells=24, sample_rows=1000)
    return df, path, data


def test_every_row_is_stored_once_with_its_vector(spark, stored):
    df, path, data = stored
    cells = spark.read.parquet(f"{path}/cells")
    assert cells.count() == 3002 and cells.filter("cell = -1").count() == 2 and cells.select("cell").distinct().count() > 15
    assert cells.select("id", "v").exceptAll(df).isEmpty()


def test_recall_against_the_exact_search(spark, stored):
    df, path, data = stored
    questions = {str(i): data[i].tolist() for i in range(0, 3000, 60)}
    want = {(r.question, r.id) for r in vectors.top_k(df.filter("id < 9000"), "id", "v", questions, 10).collect()}
    got = vector_index.search(spark, path, "id", "v", questions, 10, probes=6)
    found = {(r.question, r.id) for r in got.collect()}
    assert len(found) == len(questions) * 10 and len(found & want) / len(want) >= 0.9
    exact = {(r.question, r.id): r.score for r in vectors.top_k(df, "id", "v", questions, 40).collect()}
    assert all(abs(r.score - exact[r.question, r.id]) < 2e-6 for r in got.collect() if (r.question, r.id) in exact)


def test_a_search_reads_few_cells_and_embeds_nothing(spark, stored):
    _, path, data = stored
    got = vector_index.search(spark, path, "id", "v", {"q": data[5].tolist()}, 5, probes=3)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert all("cell#" in scan[:120] for scan in plan.split("PartitionFilters: ")[1:])
    assert "ArrowEvalPython" not in plan
    near = vector_index.load_model(spark, path)["coarse"]
    unit = data[5] / np.linalg.norm(data[5])
    chosen = set(np.argsort((near * near).sum(1) - 2 * near @ unit)[:3].tolist())
    held = {r.cell for r in spark.read.parquet(f"{path}/cells").join(got.select("id"), "id").select("cell").collect()}
    assert held <= chosen and got.first().id == 5


def test_sync_rewrites_touched_cells_only(spark, stored, tmp_path):
    df, _, data = stored
    path = str(tmp_path / "index")
    vector_index.build(df, "id", "v", path, cells=24, sample_rows=1000)
    read = lambda: {r.f: r.cell for r in spark.read.parquet(f"{path}/cells").select(F.input_file_name().alias("f"), "cell").distinct().collect()}
    before = read()
    changes = spark.createDataFrame([(7, (-data[7]).tolist(), "update"), (11, None, "delete"), (5000, data[3].tolist(), "insert")], "id bigint, v array<float>, change_type string")
    touched = vector_index.sync(spark, path, "id", "v", changes)
    after = read()
    assert 1 <= len(touched) <= 4 and {f for f, c in before.items() if c not in touched} == {f for f, c in after.items() if c not in touched}
    rows = {r.id: r.v for r in spark.read.parquet(f"{path}/cells").collect()}
    assert len(rows) == 3002 and 11 not in rows and np.allclose(rows[7], -data[7]) and np.allclose(rows[5000], data[3])
    assert vector_index.search(spark, path, "id", "v", {"q": (-data[7]).tolist()}, 1, probes=4).first().id == 7
    assert vector_index.sync(spark, path, "id", "v", changes.filter("false")) == []
    assert spark.read.parquet(f"{path}/cells").count() == 3002
