import math

import pytest
from pyspark.sql import functions as F

from wattlake.functions import rules
from wattlake.operators.windows import with_anomaly

NAN = math.nan

CASES = [
    # kwh, voltage, current, code
    (5.0, 220.0, 22.73, 0),
    (100.0, 220.0, 10.0, 1),
    (5.0, 300.0, 10.0, 2),
    (25.0, 220.0, 113.64, 3),
    (5.0, 220.0, 30.0, 4),
    (0.0, 200.0, 0.0, 0),
    (0.0, 220.0, 1.0, 4),
    (4.8, 240.0, 20.0, 0),
    (-0.01, 220.0, 0.0, 1),
    (50.01, 220.0, 10.0, 1),
    (4.4, 199.9, 22.0, 2),
    (4.8, 240.1, 20.0, 2),
    (4.4, 220.0, -0.1, 3),
    (22.0, 220.0, 100.0, 0),
    (60.0, 300.0, 200.0, 1),
    (None, 220.0, 10.0, -1),
    (5.0, None, 10.0, -1),
    (5.0, 220.0, None, -1),
]
SCHEMA = "i int, kwh double, voltage double, current double"


def codes(spark, rows, nan="reject"):
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)
    result = rules.with_validation(frame, nan).orderBy("i").collect()
    assert all(r.is_valid == (r.error_code == 0) for r in result)
    return [r.error_code for r in result]


def test_codes(spark):
    assert codes(spark, [c[:3] for c in CASES]) == [c[3] for c in CASES]


def test_empty_input_gives_empty_output(spark):
    assert codes(spark, []) == []


def test_nan_is_rejected_or_passed(spark):
    rows = [(NAN, 220.0, 10.0), (5.0, NAN, 22.73), (5.0, 220.0, NAN)]
    assert codes(spark, rows) == [1, 2, 3]
    assert codes(spark, rows, "pass") == [0, 0, 0]
    assert codes(spark, [(NAN, 300.0, 10.0), (NAN, 220.0, 200.0)], "pass") == [2, 3]
    with pytest.raises(ValueError):
        rules.error_code("ignore")


def test_messages(spark):
    frame = spark.createDataFrame([(c,) for c in (-1, 0, 1, 2, 3, 4, 5, 6)], "c int")
    texts = [r[0] for r in frame.orderBy("c").select(rules.error_message(F.col("c"))).collect()]
    assert texts[0] == texts[-1] == "Unknown error"
    assert texts[1:7] == [rules.MESSAGES[c] for c in range(6)]
    full = frame.filter("c = 2").select(rules.error_text(F.col("c"))).first()[0]
    assert full == "validation error [2]: Voltage out of valid range"


def test_split_keeps_every_row(spark, make):
    rows = make([(i, 0, i, float(i * 10)) for i in range(12)])
    good, bad = rules.valid_only(rows), rules.rejected(rows)
    assert good.columns == rows.columns
    assert good.count() + bad.count() == 12
    assert {r.error_code for r in bad.collect()} <= {1, 3}


ANOMALY_CASES = [
    # previous (kwh, voltage), now (kwh, voltage), code
    ((5.0, 220.0), (10.0, 220.0), 5),
    ((5.0, 220.0), (7.5, 220.0), 0),
    ((5.0, 220.0), (7.51, 220.0), 5),
    ((5.0, 220.0), (2.5, 220.0), 0),
    ((0.0, 220.0), (1.0, 220.0), 5),
    ((0.0, 220.0), (0.0, 220.0), 0),
    ((5.0, 200.0), (5.0, 230.0), 5),
    ((5.0, 200.0), (5.0, 219.0), 0),
    ((5.0, 0.0), (5.0, 0.0), 0),
    ((5.0, 0.0), (5.0, 1.0), 5),
    ((None, 220.0), (5.0, 220.0), -1),
    ((5.0, 220.0), (5.0, None), -1),
]


def anomaly_codes(spark, make, cases, nan="reject"):
    rows = []
    for meter, (before, now, _) in enumerate(cases):
        for second, (kwh, voltage) in enumerate((before, now)):
            rows.append((2 * meter + second, meter, second, kwh, voltage, 1.0))
    coded = with_anomaly(make(rows, total=100), nan=nan).orderBy("event_id").collect()
    assert all(r.anomaly_code == -1 for r in coded[::2])
    return [r.anomaly_code for r in coded[1::2]]


def test_anomaly(spark, make):
    assert anomaly_codes(spark, make, ANOMALY_CASES) == [c[2] for c in ANOMALY_CASES]


def test_anomaly_nan(spark, make):
    cases = [((5.0, 220.0), (NAN, 220.0), 0), ((NAN, 220.0), (5.0, 220.0), 0),
             ((0.0, 220.0), (NAN, 220.0), 0), ((NAN, 220.0), (5.0, 300.0), 5)]
    assert anomaly_codes(spark, make, cases, "pass") == [c[2] for c in cases]
    assert anomaly_codes(spark, make, cases) == [5, 5, 5, 5]
