import datetime

import pytest
from pyspark.sql import functions as F

from books import no_budget, pnl, rows
from coffer.operators.blend import blend
from coffer.operators.comments import (
    _perhaps_commented,
    add_comments,
    empty_comments,
    ensure_comments,
    group_entries,
    latest_comment,
    latest_per_entry,
    reading_order,
    with_comments,
)


def at(day):
    return datetime.datetime(2025, 1, day) if day else None


def comments(spark, *entries):
    """Comments from (id, entry, text, author, day)."""
    data = [("c", i, entry, text, by, at(day), None) for i, entry, text, by, day in entries]
    return spark.createDataFrame(data, empty_comments(spark).schema)


@pytest.fixture
def facts(spark):
    frame = blend(pnl(spark, ("p", "a", None, 1.0), ("p", "b", "x", 2.0), (None, "d", None, 3.0)), no_budget(spark))
    return frame.withColumn("entry_id", F.concat(F.lit("id-"), "sub_account"))


def test_latest_fields_are_chosen_one_by_one(spark):
    table = comments(
        spark,
        ("1", "e", "first", "ann", 1), ("2", "e", "second", "bob", 2), ("3", "e", None, "cat", 3),
        ("1", "tie", "low", "ann", 5), ("2", "tie", "high", "bob", 5),
        ("9", "untimed", "no time", "ann", None), ("1", "untimed", "timed", "bob", 1),
        ("4", "never", None, None, None),
    )
    latest = {r.entry_id: r for r in latest_per_entry(table).collect()}
    shown = {k: tuple(f and f["value"] for f in (r.comment_text, r.comment_by, r.comment_date)) for k, r in latest.items()}
    assert shown == {
        "e": ("second", "cat", at(3)),
        "tie": ("high", "bob", at(5)),
        "untimed": ("timed", "bob", at(1)),
        "never": (None, None, None),
    }


def test_facts_with_comments(spark, facts):
    table = comments(spark, ("1", "id-b", "on b", "ann", 1), ("2", "id-d", "on d", "bob", 2), ("3", "id-d", "newer", "cat", 4))
    shown = rows(with_comments(facts, table), "sub_account", "actual", "comment_text", "comment_by", "entry_ids_json")
    assert shown == [
        ("a", 1.0, None, None, '["id-a"]'),
        ("b", 2.0, "on b", "ann", '["id-b"]'),
        ("d", 3.0, "newer", "cat", '["id-d"]'),
    ]
    per_grain = rows(latest_comment(facts, table), "sub_account", "comment_text")
    assert per_grain == [("a", None), ("b", "on b"), ("d", "newer")]


def test_literal_join_misses_null_keys(spark, facts):
    table = comments(spark, ("1", "id-b", "on b", "ann", 1), ("2", "id-a", "on a", "bob", 2))
    shown = rows(with_comments(facts, table, "literal"), "sub_account", "comment_text")
    assert shown == [("a", None), ("b", "on b"), ("d", None)]


def test_groups_of_several_entries(spark, facts):
    doubled = facts.unionByName(facts.withColumn("entry_id", F.concat(F.lit("0"), "entry_id")))
    table = comments(spark, ("1", "id-a", "older", "ann", 1), ("2", "0id-a", "newer", "bob", 2))
    grouped = rows(group_entries(doubled), "sub_account", "actual")
    assert grouped == [("a", 2.0), ("b", 4.0), ("d", 6.0)]
    shown = rows(with_comments(doubled, table).filter("sub_account = 'a'"), "comment_text", "entry_ids_json")
    assert shown == [("newer", '["0id-a","id-a"]')]


def test_comments_never_change_totals(spark, facts):
    many = comments(spark, *[(str(i), "id-a", "x", "y", 1 + i % 20) for i in range(50)])
    for table in (empty_comments(spark), many):
        result = with_comments(facts, table)
        assert result.count() == 3
        assert result.agg(F.sum("actual")).first()[0] == 6.0


def test_table_is_created_once_and_kept(spark, tmp_path):
    path = f"{tmp_path}/comments"
    assert ensure_comments(spark, path).count() == 0
    assert ensure_comments(spark, path).schema == empty_comments(spark).schema
    add_comments(comments(spark, ("1", "e", "t", "u", 1)), path)
    add_comments(comments(spark, ("2", "e", "t", "u", 1)), path)
    assert rows(ensure_comments(spark, path), "comment_id") == [("1",), ("2",)]


def test_reading_order_puts_nulls_first(facts):
    subs = [r.sub_account for r in reading_order(facts).collect()]
    assert subs == ["d", "a", "b"]


def test_unknown_mode(spark, facts):
    with pytest.raises(ValueError):
        with_comments(facts, empty_comments(spark), "other")


def test_filter_keeps_every_commented_entry(spark):
    entries = spark.range(2000).selectExpr("if(id = 7, NULL, 'c') AS client", "if(id = 8, NULL, concat('id-', id)) AS entry_id")
    table = comments(spark, *[(str(i), f"id-{i}", "t", "u", 1) for i in (1, 2, 7, 1999)], ("n", None, "t", "u", 1))
    kept = {r.entry_id for r in _perhaps_commented(entries, table).collect()}
    assert {"id-1", "id-2", "id-1999"} <= kept and len(kept) < 20
    assert _perhaps_commented(entries, empty_comments(spark)).count() == 0


def test_ids_of_any_kind_are_grouped(spark):
    """Ids that are the hash of their grain, repeated, of another grain, from elsewhere, and none."""
    one = blend(pnl(spark, ("p", "a", None, 1.0)), no_budget(spark)).localCheckpoint()
    own = one.first().entry_id
    other = blend(pnl(spark, ("p", "b", None, 1.0)), no_budget(spark)).first().entry_id
    ids = [own, own, other, "uuid-1", "uuid-1", None]
    several = one.withColumn("entry_id", F.explode(F.array(*[F.lit(i) for i in ids])))
    assert group_entries(several).first().entry_ids == sorted(i for i in ids if i)
    assert group_entries(one.withColumn("entry_id", F.lit(None).cast("string"))).first().entry_ids == []


def test_literal_comments_multiply_over_classifications(spark):
    """The literal key leaves the classification out, and matches no NULL."""
    facts = blend(
        pnl(spark, ("p", "a", "x", 1.0, "One", "Income"), ("p", "a", "x", 2.0, "Two", "Income"),
            ("p", "b", None, 4.0, "One", "Income"), ("p", "b", None, 8.0, "Two", "Income")), no_budget(spark)
    ).withColumn("entry_id", F.concat_ws("-", F.lit("id"), "sub_account", "classification"))
    table = comments(spark, ("1", "id-a-One", "on one", "ann", 1), ("2", "id-b-One", "lost", "bob", 1))
    shown = rows(with_comments(facts, table, "literal"), "classification", "actual", "comment_text", "entry_ids_json")
    assert shown == [
        ("One", 1.0, None, '["id-a-One"]'), ("One", 1.0, "on one", '["id-a-One"]'), ("One", 4.0, None, '["id-b-One"]'),
        ("Two", 2.0, None, '["id-a-Two"]'), ("Two", 2.0, "on one", '["id-a-Two"]'), ("Two", 8.0, None, '["id-b-Two"]'),
    ]
