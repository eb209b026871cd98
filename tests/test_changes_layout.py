import random
from datetime import date, timedelta
from pathlib import Path
from statistics import median

import pyarrow.parquet as pq
import pytest

from ladle.operators import changes, layout


def brute_force(values, baseline=12, slack=0.5, alarm=5.0, floor=0.01):
    """One pass over (run, value): the sum is kept, cut at zero, and a stretch above zero that passed the alarm is a change."""
    seen = [(r, v) for r, v in values if v is not None]
    centre = median(v for _, v in seen[:baseline])
    scale = max(1.4826 * median(abs(v - centre) for _, v in seen[:baseline]), abs(centre) * floor, 1e-9)
    found = set()
    for sign, direction in ((-1, "down"), (1, "up")):
        s, stretch = 0.0, []
        for run, v in [*seen, (None, None)]:
            step = None if run is None else sign * round(max(min((v - centre) / scale, 4.0), -4.0), 6) - slack
            s = 0.0 if run is None else max(0.0, s + step)
            if s > 1e-9:
                stretch.append((run, s))
                continue
            over = [r for r, x in stretch if x > alarm + 1e-9]
            if over:
                found.add((direction, stretch[0][0], over[0], stretch[-1][0], len(stretch), round(max(x for _, x in stretch), 6)))
            stretch, s = [], 0.0
    return found


def series(kind):
    rnd = random.Random(kind)
    noise = [100 + rnd.uniform(-2, 2) for _ in range(60)]
    if kind in ("jump", "drift"):
        noise = [98.0 + i * 7 % 5 for i in range(60)]  # even noise, so that dates are exact
    if kind == "jump":
        return [v - 15 if i >= 30 else v for i, v in enumerate(noise)]
    if kind == "drift":
        return [v - 0.4 * max(0, i - 25) for i, v in enumerate(noise)]
    if kind == "burst":
        return [v + 30 if 20 <= i < 24 else v for i, v in enumerate(noise)]
    if kind == "outlier":
        return [v - 90 if i == 30 else v for i, v in enumerate(noise)]
    if kind == "nulls":
        return [None if i % 3 else v for i, v in enumerate(noise)]
    return [1.0] * 20 + [0.9] * 10


@pytest.fixture(scope="module")
def found(spark):
    rows = [(k, i, v) for k in ("jump", "drift", "burst", "outlier", "nulls", "flat") for i, v in enumerate(series(k))]
    rows += [("empty", i, None) for i in range(5)]
    df = spark.createDataFrame(rows, "name string, run long, value double").repartition(4)
    out = {}
    for r in changes.change_points(df, ["name"], "run", "value").collect():
        out.setdefault(r["name"], set()).add((r.direction, r.first_bad, r.alarmed_at, r.last_bad, r.runs, round(r.peak, 6)))
    return out


@pytest.mark.parametrize("kind", ["jump", "drift", "burst", "outlier", "nulls", "flat"])
def test_changes_match_one_pass_in_order(found, kind):
    assert found.get(kind, set()) == brute_force(list(enumerate(series(kind))))


def test_jump_and_drift_are_dated_and_one_odd_run_is_not_a_change(found):
    assert [c[1] for c in found["jump"] if c[0] == "down"] == [30]
    assert [24 <= c[1] <= 32 for c in found["drift"] if c[0] == "down"] == [True]
    assert [c[1] for c in found["flat"]] == [20]
    assert not [c for c in found.get("outlier", ()) if c[0] == "down" and c[1] == 30]
    assert "empty" not in found


def fact(n=20_000):
    rnd, day = random.Random(4), date(2000, 1, 1)
    return [(day + timedelta(days=rnd.randint(0, 999)), None if i % 3 == 0 else f"{rnd.getrandbits(40):010x}", i) for i in range(n)]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("curve") / "t")
    df = spark.createDataFrame(fact(), "place date, hk string, amount long")
    return layout.write_curve(df, path, ["place", "hk"], files=64), path


def test_no_row_is_lost_though_a_column_is_named_like_the_curves(stored):
    frame, _ = stored
    assert sorted(map(str, frame.collect())) == sorted(f"Row(place={d!r}, hk={h!r}, amount={a})" for d, h, a in fact())


def test_footers_let_a_filter_on_either_column_skip_most_row_groups(stored):
    groups = []
    for file in Path(stored[1]).glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        groups += [[meta.row_group(g).column(c).statistics for c in (0, 1)] for g in range(meta.num_row_groups)]

    def touched(column, low, high):
        return sum(1 for g in groups if g[column].has_min_max and g[column].min <= high and g[column].max >= low)

    assert len(groups) >= 60
    assert touched(0, date(2000, 5, 1), date(2000, 5, 20)) < len(groups) * 0.4
    assert touched(1, "80", "82") < len(groups) * 0.4


def test_null_key_that_holds_a_third_spreads_over_files(stored):
    per_file = stored[0].filter("hk IS NULL").selectExpr("_metadata.file_name AS f").groupBy("f").count().collect()
    assert len(per_file) > 10 and max(r["count"] for r in per_file) < 1500


def test_one_box_splits_and_empty_tables_stay_empty(spark, tmp_path):
    same = spark.createDataFrame([(1, "a", i) for i in range(5000)], "k long, h string, v long")
    out = layout.write_curve(same, str(tmp_path / "same"), ["k", "h"], files=8)
    sizes = [r["count"] for r in out.selectExpr("_metadata.file_name AS f").groupBy("f").count().collect()]
    assert sum(sizes) == 5000 and len(sizes) >= 6
    none = spark.createDataFrame([], "k long, h string, v long")
    assert layout.write_curve(none, str(tmp_path / "none"), ["k", "h"]).count() == 0
