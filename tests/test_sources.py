import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from wearline.constants import ALL_SENSORS, TELEMETRY_COLUMNS
from wearline.sources import requests as rq
from wearline.sources import tables, text


def _line(unit, cycle, base=1.0, sep=" "):
    vals = [str(unit), str(cycle)] + [f"{base + i / 10:.4f}" for i in range(24)]
    return sep.join(vals)


def test_parse_handles_tabs_blank_short_and_malformed(spark):
    lines = [
        _line(1, 1),
        "\t" + _line(1, 2, sep="  \t ") + "  ",
        "",
        "   ",
        "1 3 0.1 0.2",                                     # too short
        _line(1, 4).replace("1.3000", "abc"),              # bad number
        _line(1, 5).replace("1.3000", "nan"),              # NaN becomes NULL
        "x " + _line(1, 6).split(" ", 1)[1],               # bad key
        _line(2, 1) + " 9.9",                              # too long
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    good = text.parse_telemetry(df).orderBy("unit", "cycle").collect()
    assert [(r.unit, r.cycle) for r in good] == [(1, 1), (1, 2), (1, 5)]
    assert good[1].sensor_21 == pytest.approx(1.0 + 23 / 10)
    nan_row = good[2].asDict()
    assert sum(v is None for v in nan_row.values()) == 1
    bad = {r.error for r in text.malformed_lines(df).collect()}
    assert bad == {"field_count", "bad_number", "bad_key"}
    assert text.malformed_lines(df).count() == 4
    assert text.parse_telemetry(df).columns == TELEMETRY_COLUMNS


def test_parse_matches_pandas_reader(spark, scratch):
    lines = [_line(u, c, base=u + c / 100, sep=[" ", "  ", "\t"][c % 3]) for u in (1, 2) for c in range(1, 8)]
    path = os.path.join(scratch, "train_FD001.txt")
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    expected = pd.read_csv(path, sep=r"\s+", header=None, names=TELEMETRY_COLUMNS)
    got = text.read_telemetry(spark, path).orderBy("unit", "cycle").toPandas()
    assert got.shape == expected.shape
    pd.testing.assert_frame_equal(got.reset_index(drop=True), expected.astype(got.dtypes.to_dict()), check_dtype=False)


def test_read_fleet_tags_dataset_from_file_name(spark, scratch):
    for tag, units in (("FD001", (1, 2)), ("FD002", (1,))):
        with open(os.path.join(scratch, f"test_{tag}.txt"), "w") as fh:
            fh.write("\n".join(_line(u, c) for u in units for c in (1, 2, 3)) + "\n")
    fleet = text.read_fleet(spark, os.path.join(scratch, "test_FD00*.txt"))
    keys = sorted({(r.dataset, r.fleet_unit) for r in fleet.collect()})
    assert keys == [("FD001", "FD001_1"), ("FD001", "FD001_2"), ("FD002", "FD002_1")]
    assert fleet.count() == 9


def test_fleet_key_drops_null_units(spark):
    df = spark.createDataFrame([("FD001", 1, 1), ("FD001", None, 2)], "dataset string, unit long, cycle long")
    out = text.fleet_key(df).collect()
    assert [r.fleet_unit for r in out] == ["FD001_1"]


def test_union_fleet_keeps_duplicates(spark):
    a = spark.createDataFrame([(1, 1)], "unit long, cycle long")
    b = spark.createDataFrame([(1, 1)], "cycle long, unit long")
    assert text.union_fleet(a, b).count() == 2


def _reading(v):
    return {s: float(v) for s in ALL_SENSORS}


def test_validate_requests_lengths(spark):
    rows = [
        ("empty", []),
        ("one", [_reading(1)]),
        ("five", [_reading(i) for i in range(5)]),
        ("six", [_reading(i) for i in range(6)]),
        ("hole", [dict(_reading(1), sensor_7=None)]),
    ]
    df = spark.createDataFrame(rows, rq.REQUEST)
    got = {r.request_id: r.error for r in rq.validate_requests(df).collect()}
    assert got == {"empty": "empty", "one": None, "five": None, "six": "too_many_readings", "hole": "missing_sensor"}


def test_parse_request_json_and_explode(spark):
    body = '{"request_id": "r1", "recent_cycles": [' + ",".join(
        "{" + ",".join(f'"{s}": {i}.5' for s in ALL_SENSORS) + "}" for i in range(3)) + "]}"
    df = rq.parse_request_json(spark.createDataFrame([(body,)], "body string"))
    ex = rq.explode_requests(df).orderBy("pos").collect()
    assert [r.pos for r in ex] == [1, 2, 3]
    assert [r.sensor_9 for r in ex] == [0.5, 1.5, 2.5]


def test_build_requests_last_k_oldest_first(spark):
    rows = [(1, c, *[float(c)] * 21) for c in range(1, 9)] + [(2, 1, *[7.0] * 21)]
    df = spark.createDataFrame(rows, ["unit", "cycle", *ALL_SENSORS])
    req = {r.unit: r for r in rq.build_requests(df, k=5).collect()}
    assert [x.sensor_1 for x in req[1].recent_cycles] == [4.0, 5.0, 6.0, 7.0, 8.0]
    assert len(req[2].recent_cycles) == 1


def test_tables_round_trip(spark, scratch):
    df = spark.createDataFrame([("FD001", 1, 5, 10.5), ("FD002", 1, 7, 3.0)], "dataset string, unit long, cycle long, prediction double")
    tables.write_scores(df, os.path.join(scratch, "scores"))
    back = tables.read_scores(spark, os.path.join(scratch, "scores")).orderBy("dataset").collect()
    assert [(r.dataset, r.unit, r.cycle, r.predicted_rul) for r in back] == [("FD001", 1, 5, 10.5), ("FD002", 1, 7, 3.0)]
    tables.write_predictions(df, os.path.join(scratch, "preds"), fmt="csv")
    assert tables.read_predictions(spark, os.path.join(scratch, "preds"), fmt="csv").count() == 2
    split = df.withColumn("split", F.when(F.col("dataset") == "FD001", "train").otherwise("validation"))
    tables.write_split(split, os.path.join(scratch, "split"))
    assert tables.read_split(spark, os.path.join(scratch, "split"), "train").count() == 1


def test_null_request_is_rejected_not_failed(spark):
    df = spark.createDataFrame([("nil", None)], rq.REQUEST)
    assert [r.error for r in rq.validate_requests(df).collect()] == ["empty"]


def test_profile_approx_distinct(spark, sf_small):
    from wearline.operators.profile import profile
    from wearline.sources.adapters import tele_events

    te = tele_events(spark, sf_small)
    exact, approx = profile(te).first(), profile(te, approx=True).first()
    assert exact.n_rows == approx.n_rows and abs(exact.n_units - approx.n_units) <= max(2, exact.n_units // 20)
