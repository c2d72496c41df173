"""List joins against brute force, with duplicates, NULLs and a hot key."""

import random

import pytest
from pyspark.sql import functions as F

from tallymark.operators import relate


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def two_lists(spark, pairs):
    return spark.createDataFrame(pairs, "TestA int, TestB int")


def test_membership_gives_one_row_per_id(spark):
    ids = spark.createDataFrame([(1,), (2,), (3,), (4,)], "ID int")
    lists = two_lists(spark, [(1, 2), (2, None), (1, 1), (None, 3)])
    flags = relate.list_flags(lists, "TestA", "TestB", "ID")
    assert rows(relate.with_membership(ids, "ID", flags)) == [(1, 1), (2, 1), (3, 3), (4, 2)]
    assert rows(relate.with_membership(ids, "ID", flags, one_sided=2)) == [
        (1, 1), (2, 1), (3, 2), (4, 2),
    ]


def test_membership_counts_of_overlapping_ranges(spark):
    # List A misses every third id, list B every fourth; ids go up to 1200.
    ids = range(1, 1201)
    a = [i for i in ids if i % 3]
    b = [i for i in ids if i % 4]
    side_by_side = [(a[k] if k < len(a) else None, b[k]) for k in range(len(b))]
    flags = relate.list_flags(two_lists(spark, side_by_side), "TestA", "TestB", "ID")
    coded = relate.with_membership(spark.createDataFrame([(i,) for i in ids], "ID int"), "ID", flags)
    counts = dict(coded.groupBy("test_results").count().collect())
    assert counts == {1: 600, 3: 500, 2: 100}


@pytest.mark.parametrize("partitions", [1, 17])
def test_either_key_matches_brute_force(spark, partitions):
    draw = random.Random(3)
    # One id holds a third of the right rows; some ids are NULL or match nothing.
    right = [
        (7 if draw.random() < 0.33 else draw.choice([None, *range(40)]), draw.choice([None, *range(40)]))
        for _ in range(300)
    ]
    right.append((5, 5))
    left = [i for i in range(60)] + [7]
    expected = []
    for i in left:
        found = [p for p in right if i in p]
        expected += [(i, *p) for p in found] or [(i, None, None)]
    df = spark.createDataFrame([(i,) for i in left], "ID int").repartition(partitions)
    pairs = two_lists(spark, right).repartition(partitions)
    out = relate.left_join_either_key(df, "ID", pairs, "TestA", "TestB")
    assert rows(out) == sorted(expected, key=repr)


def test_two_left_joins_do_not_multiply_rows(spark):
    ids = spark.createDataFrame([(1,), (2,)], "ID int")
    lists = two_lists(spark, [(1, 1), (1, None), (1, 1)])
    once = relate.mark_in_list(ids, "ID", relate.id_list(lists, "TestA", "A"), "A")
    twice = relate.mark_in_list(once, "ID", relate.id_list(lists, "TestB", "B"), "B")
    assert rows(twice) == [(1, 1, 1), (2, None, None)]
    flags = relate.list_flags(lists, "TestA", "TestB", "ID")
    assert rows(relate.mark_in_lists(ids, "ID", flags, "A", "B")) == rows(twice)


def test_in_both_lists(spark):
    ids = spark.createDataFrame([(1,), (2,), (3,), (3,)], "ID int")
    flags = relate.list_flags(two_lists(spark, [(1, 2), (2, None), (None, 3)]), "TestA", "TestB", "ID")
    assert rows(relate.in_both_lists(ids, "ID", flags)) == [(2,)]


def test_empty_lists_keep_every_id(spark):
    ids = spark.createDataFrame([(1,), (2,)], "ID int")
    empty = two_lists(spark, [])
    assert rows(relate.left_join_either_key(ids, "ID", empty, "TestA", "TestB")) == [
        (1, None, None), (2, None, None),
    ]
    flags = relate.list_flags(empty, "TestA", "TestB", "ID")
    assert rows(relate.with_membership(ids, "ID", flags)) == [(1, 2), (2, 2)]
    assert flags.where(F.col("in_first")).count() == 0
