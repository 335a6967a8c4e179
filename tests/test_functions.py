"""Edge cases of the column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakestrata.functions import codes, measures, predicates, recode, stable
from lakestrata.plans.silver import occupation_code


def values(spark, schema, rows, expr):
    df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)
    return [r[0] for r in df.select(expr).collect()]


def test_zero_pad_keeps_longer_values_and_is_idempotent(spark):
    padded = codes.zero_pad(F.col("c"), 5)
    assert values(spark, "c string", ["1", "1000", "75001", "123456", None, "2A004"], padded) == [
        "00001", "01000", "75001", "123456", None, "2A004"]
    assert values(spark, "c string", ["7"], codes.zero_pad(padded, 5)) == ["00007"]


def test_split_label_is_greedy_on_both_sides(spark):
    rows = ["A - B - C", "plain", "Variable filtre - x"]
    assert values(spark, "c string", rows, codes.label_answer(F.col("c"))) == ["B - C", "", "x"]
    assert values(spark, "c string", rows, codes.label_question(F.col("c"))) == ["A - B", "", "Variable filtre"]


def test_bins_put_bounds_on_the_right_side(spark):
    left = recode.bin_left_closed(F.col("c"), [70, 115])
    assert values(spark, "c double", [69.0, 70.0, 114.0, 115.0, None], left) == [1, 2, 2, 3, None]
    right = recode.bin_right_closed(F.col("c"), [50, 90, 150], null_as=3)
    assert values(spark, "c double", [50.0, 50.1, 90.0, 150.0, 151.0, None], right) == [0, 1, 1, 2, 3, 3]


def test_recode_without_default_is_null(spark):
    assert values(spark, "c int", [1, 12, None], recode.recode(F.col("c"), {1: 0})) == [0, None, None]


def test_flag_other_counts_null_as_one(spark):
    assert values(spark, "c int", [1, 2, None], recode.flag_other(F.col("c"), 1)) == [0, 1, 1]


def test_label_to_ordinal_keeps_numbers_only(spark):
    label = recode.label_to_ordinal(F.col("c"), ["insuffisante", "moyenne"])
    assert values(spark, "c string", ["moyenne", "3", "inconnue", None], label) == [2, 3, None, None]


def test_rowwise_mean_truncates_and_ignores_zero_and_null(spark):
    mean = measures.rowwise_positive_mean([F.col("a"), F.col("b"), F.col("c")])
    rows = [(2, 3, None), (None, None, None), (4, 0, -1), (0, 0, 0)]
    assert values(spark, "a int, b int, c int", rows, mean) == [2, None, 4, None]


def test_decode_label_falls_through_to_the_code(spark):
    assert values(spark, "c int", [1, 9, None], recode.decode_label(F.col("c"), {1: "Gaz"})) == ["Gaz", "9", None]


def test_rule_flag(spark):
    flag = recode.rule_flag(F.col("k"), [2], [1, 3], [F.col("a"), F.col("b")], 4)
    rows = [(2, 0, 0), (1, 4, 0), (3, 0, 5), (1, 3, 3), (4, 6, 6), (1, None, 4), (None, 6, 6)]
    assert values(spark, "k int, a int, b int", rows, flag) == [1, 1, 1, 0, 0, 1, 0]


def test_occupation_of_job_eleven_collides_as_documented(spark):
    rows = [(1, 3), (2, 11), (1, None), (5, None), (1, 11)]
    assert values(spark, "w int, j int", rows, occupation_code(F.col("w"), F.col("j"))) == [8, 0, -1, 3, -1]


def test_classify_members_splits_on_markers(spark):
    got = recode.classify_members(F.col("e"), {1: ["gas"], 4: ["net"]}, ["power"], F.col("g"), ["PAC", "pompe"], 5, 6)
    rows = [("gas", None), ("power", "PAC air"), ("power", "pompe x"), ("power", "other"), ("power", None), ("coal", "")]
    assert values(spark, "e string, g string", rows, got) == [1, 5, 5, 6, 6, None]


def test_date_windows(spark):
    rows = ["2013-12-31", "2014-01-01", "2017-01-01", "2017-01-02"]
    day = F.col("c").cast("date")
    assert values(spark, "c string", rows, predicates.within_dates(day, "2014-01-01", "2017-01-01")) == [
        False, True, True, False]
    assert values(spark, "c string", rows, predicates.inside_dates(day, "2014-01-01", "2017-01-02")) == [
        False, False, True, False]


def test_scope_and_sentinels(spark):
    assert values(spark, "c string", ["01", "2A", "97", None], predicates.code_in_scope(F.col("c"), 96)) == [
        True, False, False, False]
    assert values(spark, "c int", [9, 10, 99, None], predicates.not_sentinel(F.col("c"), [10, 11, 99])) == [
        True, False, False, False]
    assert values(spark, "c string", ["12.5", "x", None], predicates.is_number(F.col("c"))) == [True, False, False]


def test_clamped_year_and_safe_ratio(spark):
    assert values(spark, "c string", ["2023-05-01", "2021-01-01", None],
                  measures.clamp_year(F.col("c").cast("date"), 2022)) == [2022, 2021, None]
    assert values(spark, "a double, b int", [(6.0, 3), (1.0, 0)], measures.safe_ratio(F.col("a"), F.col("b"))) == [2.0, None]


def test_seeded_pick_does_not_depend_on_partitioning(spark):
    df = spark.range(500).withColumn("p", stable.seeded_pick([2014, 2015, 2016], F.col("id")))
    again = spark.range(500).repartition(7).withColumn("p", stable.seeded_pick([2014, 2015, 2016], F.col("id")))
    assert sorted(df.collect()) == sorted(again.collect())
    assert {r.p for r in df.collect()} == {2014, 2015, 2016}


def test_hash_split_shares(spark):
    counts = dict(spark.range(20000).groupBy(stable.hash_split(F.col("id")).alias("s")).count().collect())
    assert abs(counts["train"] / 20000 - 0.6) < 0.02 and abs(counts["val"] / 20000 - 0.2) < 0.02
