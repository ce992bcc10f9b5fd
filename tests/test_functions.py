import datetime

import pytest
from pyspark.sql import functions as F

from coffer.functions.json_text import elements, scalar, scalar_at
from coffer.functions.keys import entry_id, key_text
from coffer.functions.text import (
    budget_cell,
    month_labels,
    month_start,
    parse_range,
    path_head,
    path_tail,
    sheet_address,
)


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_budget_cells(spark):
    cells = ["1,234", "-", "", None, " 12 ", "(12)", "1d", "12f", "$5", "-3.5", "1e3", ".5", "5."]
    expected = [1234.0, None, None, None, 12.0, None, None, None, None, -3.5, 1000.0, 0.5, 5.0]
    assert column(spark, cells, budget_cell("x")) == expected


def test_budget_cells_as_decimal(spark):
    assert [str(v) for v in column(spark, ["1,234.5"], budget_cell("x", "decimal(18,4)"))] == ["1234.5000"]


def test_account_path(spark):
    paths = ["A", "A:B", "A:B:C", "A:", ":B", "", None, "A:B\nC"]
    assert column(spark, paths, path_head(F.col("x"))) == ["A", "A", "A", "A", "B", None, None, "A"]
    tails = [None, "B", "B:C", "", "B", None, None, "B"]
    assert column(spark, paths, path_tail(F.col("x"))) == tails


def test_month_labels_cross_years():
    labels = month_labels()
    assert (labels[0], labels[11], labels[12], labels[35]) == (
        "jan25_budget", "dec25_budget", "jan26_budget", "dec27_budget",
    )
    assert month_labels("1999-11", 4) == ["nov99_budget", "dec99_budget", "jan00_budget", "feb00_budget"]


def test_month_start_pivots_two_digit_years(spark):
    labels = ["jan25_budget", "Dec27_budget", "feb68", "mar69", "apr99", "may00"]
    expected = [
        datetime.date(2025, 1, 1), datetime.date(2027, 12, 1), datetime.date(2068, 2, 1),
        datetime.date(1969, 3, 1), datetime.date(1999, 4, 1), datetime.date(2000, 5, 1),
    ]
    assert column(spark, labels, month_start(F.col("x"))) == expected


def test_sheet_address(spark):
    urls = [
        "https://docs.example/d/ID/edit?gid=1#gid=1",
        "https://docs.example/d/ID/edit#gid=1?x",
        "https://docs.example/d/ID",
    ]
    assert column(spark, urls, sheet_address(F.col("x"))) == ["https://docs.example/d/ID"] * 3


def test_parse_range():
    assert parse_range("Budget Summary!A4:AS69") == ("Budget Summary", 4, 69, 0, 44)
    assert parse_range("B2:C3") == (None, 2, 3, 1, 2)
    for bad in ("A4", "A9:B2", "C1:A2", "A0:B2"):
        with pytest.raises(ValueError):
            parse_range(bad)


def test_json_scalars(spark):
    texts = ['{"v": "1"}', '{"v": 2}', '{"v": true}', '{"v": null}', '{"v": {"a": 1}}', '{"v": [1]}', '{"V": 1}', "junk", None]
    expected = ["1", "2", "true", None, None, None, None, None, None]
    assert column(spark, texts, scalar_at("x", "$.v")) == expected
    assert column(spark, ["a", "{a", "[a", "", None], scalar("x")) == ["a", None, None, "", None]


def test_json_elements(spark):
    element = "STRUCT<Amount: STRING, D: STRUCT<value: STRING>>"
    texts = [
        '[{"Amount": 1, "D": {"value": "a"}}, {"Amount": "2.5"}]',
        '[{"Amount": 1, "D": "odd"}, {"Amount": 2, "D": {"value": "b"}}]',
        '[7, null, "x", {"Amount": 3, "D": {"value": "c"}}]',
        "[]", "{}", '{"Amount": 1}', '[{"Amount": 1}', "junk", "", None,
    ]
    found = column(spark, texts, elements("x", element))
    assert [(e.Amount, e.D and e.D.value) for e in found[0]] == [("1", "a"), ("2.5", None)]
    assert [(e.Amount, e.D and e.D.value) for e in found[1]] == [("1", None), ("2", "b")]
    assert [(e.Amount, e.D.value) for e in found[2] if e is not None] == [("3", "c")]
    assert found[3] == []
    assert found[4:] == [None] * 6


def test_keys_do_not_collide(spark):
    df = spark.createDataFrame(
        [("a|1:b", "c"), ("a", "b|1:c"), ("n", None), (None, "n"), (None, None), ("", None)],
        "x string, y string",
    )
    assert len({r[0] for r in df.select(key_text("x", "y")).collect()}) == 6
    ids = [r[0] for r in df.select(entry_id("x", "y")).collect()]
    assert len(set(ids)) == 6 and all(len(i) == 32 for i in ids)
    assert ids == [r[0] for r in df.select(entry_id("x", "y")).collect()]


def test_json_text_that_looks_nested(spark):
    texts = [
        '{"v":"[12] Sales"}', '{"v":[12]}', '{"v" : "{x"}', '{"v":{"a":"[b"}}', '{"a":"say \\":\\"[q","v":"plain"}',
        '{"v":" [1]"}', '{"v":"[]"}', '{"v":"\\u0001x"}',
    ]
    expected = ["[12] Sales", None, "{x", None, "plain", " [1]", "[]", "\x01x"]
    assert column(spark, texts, scalar_at("x", "$.v")) == expected
    lines = ['[{"R":{"v":"[12] Sales"}},{"R":{"v":[12]}}]', '[{"R":{"v":"{z"}},5]']
    df = spark.createDataFrame([(t,) for t in lines], "x string").select(F.explode(elements("x", "STRUCT<R: STRUCT<v: STRING>>")).alias("e"))
    assert [r[0] for r in df.select(scalar("e.R.v")).collect()] == ["[12] Sales", None, "{z", None]
