import json
import os
import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from ladle.operators import telemetry
from ladle.streaming import jobs


@pytest.mark.parametrize("topic,table", [
    ("plant/north/meltshop/f1/temp", "bronze.ot.furnace_telemetry"),
    ("plant/north/caster/c1/level", "bronze.ot.caster_history"),
    ("plant/north/rollmill/mes/order_start", "bronze.mes.rollmill_orders"),
    ("plant/north/rollmill/other", "bronze.ot.unmapped_topics"),
    ("plant/a/b/meltshop/x", "bronze.ot.unmapped_topics"),
    ("other/north/meltshop/f1", None),
    ("xplant/north/meltshop/f1", None),
])
def test_first_match_wins(spark, topic, table):
    assert spark.createDataFrame([(topic,)], "topic string").select(telemetry.route(F.col("topic"))).first()[0] == table


def test_filter_regex_is_anchored_and_escaped():
    assert re.fullmatch(telemetry.topic_regex("a.b/+/c/#"), "a.b/x/c/d/e")
    assert not re.fullmatch(telemetry.topic_regex("a.b/+/c/#"), "aXb/x/c/d")
    assert not re.fullmatch(telemetry.topic_regex("a/#"), "a")
    assert re.fullmatch(telemetry.topic_regex("a/#", parent=True), "a")


def message(asset, tag, value, ts, quality="GOOD"):
    ms = int(ts.replace(tzinfo=timezone.utc).timestamp() * 1000)
    return (f"plant/north/meltshop/{asset}/{tag}",
            json.dumps({"deviceID": asset, "tagName": tag, "value": value, "timestamp": ms, "quality": quality}), ts)


SCHEMA = "topic string, value string, timestamp timestamp"


def at(minute, second=0):
    return datetime(2024, 1, 1, 0, minute, second)


def test_parse_keeps_broken_payload_as_null_row(spark):
    rows = [message("f1", "temp", 1.5, at(1)), ("plant/north/meltshop/f1/temp", "not json", at(1))]
    out = telemetry.parse_telemetry(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.asset, r.tag, r.value) for r in out] == [("f1", "temp", 1.5), ("f1", None, None)]
    assert out[1].ts is None


def test_stream_equals_batch_for_closed_windows_and_drops_late_rows(spark, tmp_path):
    first = [message("f1", "temp", v, at(m)) for v, m in [(1.0, 0), (3.0, 4), (9.0, 5)]]
    second = [message("f1", "temp", 5.0, at(3)), message("f1", "temp", 2.0, at(40))]   # late, but inside the watermark
    third = [message("f1", "temp", 2.0, at(59))]
    fourth = [message("f1", "temp", 99.0, at(1)), message("f1", "temp", 2.0, at(59, 30))]   # window closed: dropped
    seen = set()
    for i, part in enumerate([first, second, third, fourth]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        for file in set((tmp_path / "in").glob("*.json")) - seen:   # files are taken in order of their time
            os.utime(file, (1_000_000 + i * 60, 1_000_000 + i * 60))
            seen.add(file)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    out = jobs.run_append(telemetry.SENSOR_WINDOWS.apply(telemetry.parse_telemetry(stream), "15 minutes"), str(tmp_path / "job"))
    got = {r.window_start.minute: (r.avg_value, r.max_value, r.samples) for r in out.collect()}
    assert got[0] == (3.0, 5.0, 3)
    assert got[5] == (9.0, 9.0, 1)
    assert 55 not in got


def test_windows_close_once_and_late_rows_are_kept_apart(spark, tmp_path):
    """Several runs over one checkpoint, a batch that fails after its writes and is run again, rows without a time."""
    batches = [[message("f1", "temp", v, at(m)) for v, m in [(1.0, 0), (3.0, 4), (9.0, 5)]] + [message("f2", "temp", 4.0, at(1))],
               [message("f1", "temp", 5.0, at(3)), message("f1", "temp", 2.0, at(40)), ("plant/north/meltshop/f1/temp", "no json", at(41))],
               [message("f1", "temp", 99.0, at(1)), message("f1", "temp", 7.0, at(41)), message("f2", "temp", 8.0, at(24, 59))],
               [message("f1", "temp", 6.0, at(26)), message("f1", "temp", 1.0, at(59))]]
    mark, windows, late = None, {}, []
    for rows in batches:
        before = mark
        for topic, value, when in rows:
            body = json.loads(value) if value.startswith("{") else None
            end = None if body is None else when.minute - when.minute % 5 + 5
            if body is None or (before is not None and end * 60 <= before):
                late.append(body and body["value"])
            else:
                windows.setdefault((end - 5, topic.split("/")[3]), []).append(body["value"])
                mark = max(mark if mark is not None else -10**6, when.minute * 60 + when.second - 15 * 60)
    folder, base = str(tmp_path / "in"), str(tmp_path / "job")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).write.mode("append").json(folder)
        parsed = telemetry.parse_telemetry(spark.readStream.schema(SCHEMA).json(folder))
        if i == 1:   # the last write of this batch fails: nothing of it may count twice
            broken = rollup_that_fails(telemetry.SENSOR_WINDOWS)
            with pytest.raises(Exception, match="broken"):
                jobs.run_windows(parsed, broken, "15 minutes", base)
        got, apart = jobs.run_windows(parsed, telemetry.SENSOR_WINDOWS, "15 minutes", base)
    assert {(r.window_start.minute, r.asset): (r.samples, r.max_value, r.avg_value) for r in got.collect()} == {
        k: (len(v), max(v), sum(v) / len(v)) for k, v in windows.items() if (k[0] + 5) * 60 <= mark}
    assert got.count() == sum((k[0] + 5) * 60 <= mark for k in windows)
    assert sorted(map(str, (r.value for r in apart.collect()))) == sorted(map(str, late)) and 99.0 in late and None in late
    same = telemetry.SENSOR_WINDOWS.apply(telemetry.parse_telemetry(spark.createDataFrame(batches[0], SCHEMA)))
    merged = telemetry.SENSOR_WINDOWS.finish(telemetry.SENSOR_WINDOWS.cells(telemetry.parse_telemetry(spark.createDataFrame(batches[0], SCHEMA))))
    assert sorted(map(tuple, same.select(merged.columns).collect())) == sorted(map(tuple, merged.collect()))


def rollup_that_fails(good):
    class Broken(type(good)):
        def finish(self, cells):
            if not cells.isEmpty():
                raise RuntimeError("broken")
            return super().finish(cells)
    return Broken(**{f: getattr(good, f) for f in good.__dataclass_fields__})


def test_alerts(spark):
    t = spark.createDataFrame([("temp", 5.0), ("temp", 50.0), ("o2", 99.0)], "tag string, value double")
    limits = spark.createDataFrame([("temp", 10.0)], "tag string, limit_value double")
    assert [r.value for r in telemetry.alerts(t, limits).collect()] == [50.0]
