import json

import pytest
from pyspark.sql import functions as F

from ladle import sinks
from ladle.operators import eventlog, fingerprints, lineage, products
from ladle.sources import catalog, files, registry, seeds
from ladle.streaming import jobs


def test_registry_lookup_defaults_and_validation(spark):
    src = registry.source("qad_so_mstr")
    assert src["format"] == "json" and src["primary_key"] == ["so_domain", "so_nbr"]
    with pytest.raises(KeyError):
        registry.source("nope")
    frame = registry.registry_frame(spark)
    assert frame.count() == 12
    assert registry.validate(frame).filter("NOT valid").count() == 0
    bad = frame.limit(1).withColumns({"pattern": F.lit("ftp"), "primary_key": F.array().cast("array<string>"), "target_table": F.lit("x.y")})
    row = registry.validate(bad).first()
    assert not (row.pattern_ok or row.pk_ok or row.target_ok or row.valid) and row.region_ok
    assert registry.trigger("continuous") == {"processingTime": "30 seconds"}
    assert registry.trigger("0 * * * *") == {"availableNow": True}
    assert registry.table_name("bronze.sap.vbak") == "sap_vbak"


def test_rules_are_parsed_against_the_source_schema(spark):
    df = spark.createDataFrame([("a",)], "id string")
    assert registry.unparsable_rules(df, {"ok": "id IS NOT NULL", "typo": "idd IS NOT NULL", "syntax": "id IN ("}) == ["typo", "syntax"]


def test_rule_with_quotes_survives_registration(spark):
    sinks.create_tables(spark)
    sinks.append(registry.registry_frame(spark), "cfg.source_registry")
    row = spark.table("cfg.source_registry").filter("source_name = 'ot_furnace_telemetry'").first()
    assert row.expectations["good_quality"] == "quality IN ('GOOD','UNCERTAIN')"
    assert {r.table_name for r in catalog.tables(spark, "audit").collect()} == {"rejected_records", "batch_log", "dq_results"}
    cols = catalog.columns(spark, "audit")
    assert cols.filter("table_name = 'dq_results' AND column_name = 'score'").first().data_type == "double"


@pytest.mark.parametrize("fmt", ["json", "csv", "parquet"])
def test_incremental_ingest_takes_each_file_once(spark, tmp_path, fmt):
    land, base = str(tmp_path / "land"), str(tmp_path / "job")

    def drop(rows):
        df = spark.createDataFrame(rows, "id bigint, name string").coalesce(1)
        (df.write.option("header", "true") if fmt == "csv" else df.write).mode("append").format(fmt).save(land)

    def run():
        return jobs.run_append(files.incremental(spark, land, fmt, str(tmp_path / "schema")), base)

    drop([(1, "a"), (2, "b")])
    assert run().count() == 2
    assert run().count() == 2
    drop([(3, "c")])
    assert {int(r.id) for r in run().collect()} == {1, 2, 3}


def test_json_array_files_read_with_multiline(spark, tmp_path):
    (tmp_path / "land").mkdir()
    (tmp_path / "land" / "a.json").write_text(json.dumps([{"Id": "1", "Amount": 2.5}, {"Id": "2", "Amount": 1.0}]))
    out = jobs.run_append(files.incremental(spark, str(tmp_path / "land"), "json", str(tmp_path / "s"), multiLine="true"), str(tmp_path / "j"))
    assert {(r.Id, r.Amount) for r in out.collect()} == {("1", 2.5), ("2", 1.0)}


def test_versioned_table_rewrites_a_retried_batch_and_evolves(spark, tmp_path):
    t = sinks.VersionedTable(spark, str(tmp_path / "t"))
    assert not t.exists()
    t.append(spark.range(3).toDF("id"), "b1")
    t.append(spark.range(3).toDF("id"), "b1")
    t.append(spark.range(3, 5).select("id", F.lit("x").alias("added")), "b2")
    assert t.read().count() == 5
    assert t.read().filter("added IS NULL").count() == 3
    assert t.exists()


def test_clustered_layout_keeps_rows_and_orders_files(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), "id")
    out = sinks.write_clustered(df, str(tmp_path / "c"), ["k"], files=4)
    assert out.count() == 1000
    spans = out.groupBy(F.input_file_name().alias("f")).agg(F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("lo").collect()
    assert len(spans) == 4 and all(a.hi < b.lo for a, b in zip(spans, spans[1:]))


def test_progress_of_more_than_a_hundred_batches_is_stored(spark, tmp_path):
    """Every micro-batch leaves its counters; the engine itself remembers the last hundred."""
    rows = [(i, i % 3, None if i % 10 == 0 else i % 7) for i in range(412)]
    for n in range(103):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{n}.json").write_text("\n".join(json.dumps({"id": i, "flow": f, "v": v}) for i, f, v in rows[n * 4:n * 4 + 4]))
    stream = spark.readStream.schema("id int, flow int, v int").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    base = str(tmp_path / "run")
    progress = jobs.run_counted(stream, {"valid_pk": "v IS NOT NULL"}, {"small": "v < 5"}, {"part": F.col("flow")}, "id", base)
    assert progress.select("batch").distinct().count() == 103 and progress.agg(F.sum("rows_read")).first()[0] == 412
    assert spark.read.parquet(f"{base}/rows").filter("NOT kept").count() == sum(v is None for _, _, v in rows)
    events = jobs.progress_events(progress, F.lit("p1"), F.lit("r1"), F.concat(F.lit("f"), F.col("part")))
    reg = seeds.inline(spark, [("p1", "true")], "pipeline_id string; active boolean")
    live = eventlog.active_events(events, reg)
    log = {r.source_name: (r.rows_read, r.rows_written, r.rows_rejected) for r in eventlog.batch_log(live).collect()}
    mine = lambda f: [v for _, x, v in rows if x == f]
    assert log == {f"f{f}": (len(mine(f)), sum(v is not None for v in mine(f)), sum(v is None for v in mine(f))) for f in range(3)}
    rejects = {(r.source_name, r.failed_rule): json.loads(r.record_payload)["failed_records"] for r in eventlog.rule_rejects(live).collect()}
    assert rejects == {(f"f{f}", n): x for f in range(3) for n, x in (("valid_pk", sum(v is None for v in mine(f))), ("small", sum(v is None or v >= 5 for v in mine(f))))}
    off = seeds.inline(spark, [("p1", "false")], "pipeline_id string; active boolean")
    assert eventlog.active_events(events, off).count() == 0
    again = jobs.run_counted(stream, {"valid_pk": "v IS NOT NULL"}, {"small": "v < 5"}, {"part": F.col("flow")}, "id", base)
    assert again.count() == progress.count()  # a run with nothing new adds nothing


def test_columns_read_by_expressions(spark):
    """Function names, literals, lambda variables and nested fields are told from columns; lost columns are reported."""
    frame = spark.createDataFrame([], "a string, `b c` int, s struct<x int, y int>, xs array<int>, d date, x int")
    for expression, want in [("concat_ws('-', A, `b c`, 'd')", ["a", "b c"]), ("s.x + 1", ["s"]), ("transform(xs, x -> x + 1)", ["xs"]), ("upper(lost) || a", ["lost", "a"]),
                             ("date_add(d, 1)", ["d"]), ("'a'", []), ("current_date()", []), ("CASE WHEN x > 1 THEN a END", ["x", "a"])]:
        assert sorted(lineage.read_columns(frame, expression)) == sorted(want), expression
    with pytest.raises(Exception):
        lineage.read_columns(frame, "no_such_function(a)")


def test_column_impact_follows_expressions_and_cycles(spark):
    frame = spark.createDataFrame([], "k1 string, k2 string, v int")
    edges = lineage.column_edges(spark, [("b", "s", "id", "concat_ws('-', k1, k2)"), ("b", "s", "v", "v"), ("s", "s", "hk", "sha2(id, 256)"), ("s", "g", "key", "hk"),
                                         ("g", "s", "id", "key"), ("s", "g", "both", "concat(id, v)")],
                                 {"b": frame, "s": spark.createDataFrame([], "id string, v int, hk string")})
    got = {(r.table_name, r.column_name): r.depth for r in lineage.column_impact(edges, "b", "k2").collect()}
    assert got == {("s", "id"): 1, ("s", "hk"): 2, ("g", "both"): 2, ("g", "key"): 3}
    assert {(r.table_name, r.column_name) for r in lineage.column_impact(edges, "b", "v").collect()} == {("s", "v"), ("g", "both")}


def test_lineage_walk_and_drift(spark):
    edges = seeds.inline(spark, [("a", "b"), ("b", "c"), ("a", "c"), ("c", "d"), ("x", "y")], "src_table string; tgt_table string")
    assert {(r.table_name, r.depth) for r in lineage.downstream(edges, "a").collect()} == {("b", 1), ("c", 1), ("d", 2)}
    chain = [(f"n{i}", f"n{i + 1}") for i in range(54)] + [("n0", "n2"), ("n54", "n0")]
    deep = lineage.downstream(spark.createDataFrame(chain, "src_table string, tgt_table string"), "n0")
    assert deep.count() == 55 and deep.agg({"depth": "max"}).first()[0] == 54
    old = seeds.inline(spark, [("t", "a", "int"), ("t", "b", "int")], "table_name string; column_name string; data_type string")
    new = lineage.column_profile(spark.createDataFrame([("x", 1)], "a string, c int"), "t")
    assert {(r.column_name, r.change, r.breaking) for r in lineage.schema_diff(old, new).collect()} == {
        ("a", "type_changed", True), ("b", "dropped", True), ("c", "added", False)}


def test_contract_conformity(spark):
    view = spark.createDataFrame([("a", None), ("b", 1)], "k string, v int")
    rows = {r.column_name: (r.change, r.conforms) for r in products.contract_conformity(
        view, [("k", "string", False), ("v", "int", False), ("w", "int", True)]).collect()}
    assert rows == {"k": ("same", True), "v": ("same", False), "w": ("dropped", False)}


def test_local_fallback_of_the_shared_folder(spark, monkeypatch):
    from ladle import session

    class Unset:
        sparkContext = spark.sparkContext

        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: default)

    first, second = session.shared_dir(Unset, "a"), session.shared_dir(Unset, "a")
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]

    class Cluster(Unset):
        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

    with pytest.raises(RuntimeError):
        session.shared_dir(Cluster, "a")


def test_fingerprints_find_what_was_done_to_old_batches(spark):
    """Lost, changed, added and copied rows, NULLs, and a batch of its own; order and partitioning do not matter."""
    rows = [(f"b{i % 3}", i, None if i % 7 == 0 else f"v{i % 11}") for i in range(600)]
    before = spark.createDataFrame(rows, "day string, id int, v string").repartition(5)
    later = [r for r in rows if r[1] != 4] + [("b2", 5, "v5"), ("b0", 9999, "new"), ("b9", 1, "a new batch")]
    later = [(d, i, "other" if i == 7 else "was null" if i == 14 else v) for d, i, v in later]
    after = spark.createDataFrame(later, "day string, id int, v string").repartition(3, "v")
    trees = [fingerprints.tree(df, "day", ["id"], ["id", "v"]) for df in (before, after)]
    leaves = fingerprints.differing(*trees)
    assert 0 < leaves.count() <= 5 and fingerprints.differing(trees[0], fingerprints.tree(before.repartition(2), "day", ["id"], ["id", "v"])).isEmpty()
    got = {(r.batch, r.id): (r.lost, r.changed, r.added) for r in fingerprints.violations(before, after, "day", ["id"], ["id", "v"]).collect()}
    assert got == {("b1", 4): (1, 0, 0), ("b1", 7): (0, 1, 0), ("b2", 14): (0, 1, 0), ("b2", 5): (0, 0, 1), ("b0", 9999): (0, 0, 1)}
    report = {r.batch: (r.rows, r.lost, r.changed, r.added, r.insert_only) for r in fingerprints.audit(before, after, "day", ["id"], ["id", "v"]).collect()}
    assert report == {"b0": (200, 0, 0, 1, False), "b1": (200, 1, 1, 0, False), "b2": (200, 0, 1, 1, False)}
    assert fingerprints.audit(before.filter("false"), after, "day", ["id"], ["id", "v"]).count() == 0
