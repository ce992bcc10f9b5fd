import pytest
from pyspark.sql import functions as F

from books import no_budget, pnl, rows
from coffer.operators.blend import BLEND_COLUMNS, blend, blend_refresh
from coffer.operators.comments import empty_comments
from coffer.schemas import GRAIN

SHAPE = ("sub_account", "child_account", "actual")


def comments_on(spark, *ids):
    data = [("c", f"k{i}", entry, "text", "me", None, None) for i, entry in enumerate(ids)]
    return spark.createDataFrame(data, empty_comments(spark).schema)


def id_of(frame, sub):
    return [r.entry_id for r in frame.filter(F.col("sub_account") == sub).collect()]


def settled(frame):
    """A stored version: later plans read it, not its history."""
    return frame.sparkSession.createDataFrame(frame.collect(), frame.schema)


def test_first_run_adds_actual_and_budget(spark):
    facts = pnl(spark, ("p", "a", None, 3.0), ("p", "a", None, 4.0), ("p", "b", "x", 1.0))
    budget = pnl(spark, ("p", "a", None, 10.0), ("p", "z", None, 2.0)).withColumnRenamed(
        "txnDate", "budget_date").withColumnRenamed("amount", "budget_amount")
    result = blend(facts, budget)
    assert tuple(result.columns) == BLEND_COLUMNS
    assert rows(result, "sub_account", "child_account", "actual", "budget_amount") == [
        ("a", None, 7.0, 10.0), ("b", "x", 1.0, 0.0), ("z", None, 0.0, 2.0),
    ]
    assert result.select("entry_id").distinct().count() == 3
    assert result.filter(F.col("last_refreshed").isNull()).count() == 0


def test_random_ids(spark):
    facts = pnl(spark, ("p", "a", None, 1.0), ("p", "b", None, 2.0))
    ids = [r.entry_id for r in blend(facts, no_budget(spark), random_ids=True).collect()]
    assert len(set(ids)) == 2 and all(len(i) == 36 for i in ids)


def test_ids_survive_refreshes(spark):
    nothing = no_budget(spark)
    first = settled(blend(pnl(spark, (None, "a", None, 1.0), ("p", "b", None, 2.0)), nothing))
    first = settled(first.withColumn("entry_id", F.concat(F.lit("uuid-"), "sub_account")))
    changed = pnl(spark, (None, "a", None, 100.0), ("p", "b", None, 2.0), ("p", "n", None, 5.0))
    none = empty_comments(spark)
    second = settled(blend_refresh(first, changed, nothing, none))
    third = settled(blend_refresh(second, changed, nothing, none))
    assert rows(second, *SHAPE) == [("a", None, 100.0), ("b", None, 2.0), ("n", None, 5.0)]
    assert id_of(second, "a") == ["uuid-a"] and id_of(second, "b") == ["uuid-b"]
    assert rows(third, "entry_id", *GRAIN, "actual") == rows(second, "entry_id", *GRAIN, "actual")


def test_vanished_rows_stay_while_commented(spark):
    nothing = no_budget(spark)
    start = pnl(spark, ("p", "a", None, 1.0), ("p", "b", None, 2.0), ("p", "d", None, 4.0))
    first = settled(blend(start, nothing))
    comments = comments_on(spark, *id_of(first, "b"), *id_of(first, "b"), *id_of(first, "d"))
    now = pnl(spark, ("p", "d", None, 4.0))
    second = settled(blend_refresh(first, now, nothing, comments))
    third = settled(blend_refresh(second, now, nothing, comments))
    for version in (second, third):
        assert rows(version, *SHAPE) == [("b", None, 0.0), ("d", None, 4.0)]
        assert id_of(version, "b") == id_of(first, "b")
    kept = second.filter("sub_account = 'b'").first()
    assert kept.last_refreshed == first.filter("sub_account = 'b'").first().last_refreshed
    back = settled(blend_refresh(third, start, nothing, comments))
    assert rows(back, *SHAPE) == [("a", None, 1.0), ("b", None, 2.0), ("d", None, 4.0)]
    assert id_of(back, "b") == id_of(first, "b")


def test_type_and_classification_are_part_of_the_match(spark):
    nothing = no_budget(spark)
    facts = pnl(spark, ("p", "a", None, 1.0, "Expense", "Expense"), ("p", "a", None, 2.0, "Revenue", "Income"))
    version = settled(blend(facts, nothing))
    for _ in range(2):
        version = settled(blend_refresh(version, facts, nothing, empty_comments(spark)))
    assert rows(version, "account_type", "actual") == [("Expense", 1.0), ("Income", 2.0)]


def test_repeated_grain_in_previous_version(spark):
    nothing = no_budget(spark)
    facts = pnl(spark, ("p", "a", None, 5.0))
    one = blend(facts, nothing)
    doubled = one.withColumn("entry_id", F.explode(F.array(F.lit("x1"), F.lit("x2"), F.lit("x2"), F.lit("x3"))))
    result = blend_refresh(settled(doubled), facts, nothing, comments_on(spark, "x2", "x1"))
    assert rows(result, "entry_id", "actual") == [("x1", 5.0), ("x2", 0.0)]


def test_comments_of_another_client_keep_nothing(spark):
    nothing = no_budget(spark)
    first = settled(blend(pnl(spark, ("p", "a", None, 1.0)), nothing))
    foreign = comments_on(spark, *id_of(first, "a")).withColumn("client", F.lit("d"))
    assert blend_refresh(first, pnl(spark, ("p", "b", None, 1.0)), nothing, foreign).count() == 1


def test_literal_refresh_multiplies(spark):
    nothing = no_budget(spark)
    facts = pnl(spark, ("p", "a", None, 100.0))
    version = settled(blend(facts, nothing))
    comments = comments_on(spark, *id_of(version, "a"))
    sizes, totals = [], []
    for _ in range(3):
        version = settled(blend_refresh(version, facts, nothing, comments, "literal"))
        sizes.append(version.count())
        totals.append(version.agg(F.sum("actual")).first()[0])
    assert sizes == [2, 4, 8] and totals == [100.0, 200.0, 400.0]


def test_literal_match_is_not_null_safe_on_parents(spark):
    nothing = no_budget(spark)
    facts = pnl(spark, (None, "a", None, 1.0))
    first = settled(blend(facts, nothing).withColumn("entry_id", F.lit("old")))
    literal = blend_refresh(first, facts, nothing, empty_comments(spark), "literal")
    assert id_of(literal, "a") != ["old"]
    assert id_of(blend_refresh(first, facts, nothing, empty_comments(spark)), "a") == ["old"]


def test_unknown_mode(spark):
    facts = pnl(spark, ("p", "a", None, 1.0))
    with pytest.raises(ValueError):
        blend_refresh(blend(facts, no_budget(spark)), facts, no_budget(spark), empty_comments(spark), "other")


@pytest.mark.parametrize("mode", ["intended", "literal"])
def test_ids_of_any_kind_are_carried(spark, mode):
    """Hashes of the own grain move as a mark; hashes of another one, other ids and none as they are."""
    nothing = no_budget(spark)
    facts = pnl(spark, ("p", "own", None, 1.0), ("p", "foreign", "x", 2.0), ("p", "swapped", None, 3.0), ("p", "none", None, 4.0))
    first = settled(blend(facts, nothing))
    own, swapped = id_of(first, "own"), id_of(first, "none")
    sub = F.col("sub_account")
    ids = F.when(sub == "own", F.col("entry_id")).when(sub == "foreign", "uuid").when(sub == "swapped", swapped[0])
    second = settled(first.withColumn("entry_id", ids))
    result = settled(blend_refresh(second, facts, nothing, comments_on(spark, "uuid"), mode))
    assert id_of(result, "own") == own and id_of(result, "swapped") == swapped and id_of(result, "none") == swapped
    assert id_of(result, "foreign") == ["uuid"] * (2 if mode == "literal" else 1)
