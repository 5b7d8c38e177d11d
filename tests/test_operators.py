"""Quality operators against brute force and their own laws."""

import math
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import brute
from starledger.operators import (
    distinct_values,
    drop_incomplete,
    drop_matching,
    drop_value,
    duplicate_report,
    keep_first,
    matching_report,
    null_drop_report,
    null_ratios,
    only_matching,
    remove_duplicates,
    unique_value_counts,
    unique_values,
    value_report,
)

few = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
small = st.one_of(st.none(), st.integers(0, 3))
texts = st.one_of(st.none(), st.sampled_from(["a", "b", "", ' x"" (2014)"', "(1999)"]))
pairs = st.lists(st.tuples(small, texts), max_size=25)


def rows(df):
    return [tuple(r) for r in df.collect()]


def frame(spark, data):
    return spark.createDataFrame(data, "k int, v string").repartition(3)


@few
@given(data=pairs)
def test_duplicates(spark, data):
    df = frame(spark, data)
    keys = {(k,) for k, _ in data}
    assert rows(duplicate_report(df, ["k"], "t")) == [("t", len(data), len(keys), len(data) - len(keys))]
    assert set(rows(remove_duplicates(df, ["k"]).select("k"))) == keys
    assert remove_duplicates(df, ["k"]).count() == len(keys)
    first = {}
    for k, v in sorted(data, key=lambda row: (row[1] is not None, row[1] or "")):
        first.setdefault(k, v)
    assert dict(rows(keep_first(df, ["k"], ["v"]))) == first
    last = {}
    for k, v in sorted(data, key=lambda row: (row[1] is not None, row[1] or "")):
        last[k] = v
    assert dict(rows(keep_first(df, ["k"], [F.desc("v")]))) == last


@few
@given(data=pairs)
def test_removal_keeps_count_of_every_row(spark, data):
    df = frame(spark, data)
    hit = [v for _, v in data if v is not None and v.endswith('(2014)"')]
    kept = [v for _, v in data if v is not None and not v.endswith('(2014)"')]
    nulls = [v for _, v in data if v is None]
    assert rows(matching_report(df, "v")) == [(len(data), len(hit), len(kept), len(nulls))]
    assert only_matching(df, "v").count() == len(hit)
    assert drop_matching(df, "v").count() == len(kept)
    same = [v for _, v in data if v == "a"]
    assert rows(value_report(df, "v", "a")) == [(len(data), len(same), len(data) - len(same) - len(nulls), len(nulls))]
    assert drop_value(df, "v", "a").count() == len(data) - len(same) - len(nulls)


@few
@given(data=st.lists(st.tuples(small, st.one_of(st.none(), st.sampled_from([0.5, 1.0, math.nan]))), max_size=25))
def test_missing_values(spark, data):
    df = spark.createDataFrame(data, "k int, r float").repartition(2)
    complete = [row for row in data if brute.is_complete(row)]
    clean = drop_incomplete(df)
    assert brute.comparable(rows(clean)) == brute.comparable(complete)
    assert brute.comparable(rows(clean)) == brute.comparable(rows(df.na.drop()))
    assert brute.comparable(rows(drop_incomplete(clean))) == brute.comparable(complete)
    assert rows(null_drop_report(df, "t")) == [("t", len(data), len(data) - len(complete), len(complete))]
    shares = [sum(row[i] is None for row in data) / len(data) if data else None for i in (0, 1)]
    assert rows(null_ratios(df)) == [tuple(shares)]


@few
@given(data=pairs, limit=st.sampled_from([1, 2, 3, None, 2000]))
def test_unique_values(spark, data, limit):
    df = frame(spark, data)
    columns = {"k": {None if k is None else str(k) for k, _ in data}, "v": {v for _, v in data}}
    expected = []
    for name, values in columns.items():
        ordered = sorted(values, key=lambda v: (v is not None, v or ""))
        expected += [(name, v) for v in ordered[:limit]]
    assert brute.comparable(rows(unique_values(df, limit))) == brute.comparable(expected)
    assert dict(rows(unique_value_counts(df))) == {n: len(v) for n, v in columns.items()}
    assert {c for c, _ in rows(unique_values(df, limit, ignore=["v"]))} <= {"k"}
    assert Counter(v for (v,) in rows(distinct_values(df, "v"))) == Counter(columns["v"])


def test_unique_values_needs_a_column(spark):
    with pytest.raises(ValueError):
        unique_values(frame(spark, [(1, "a")]), ignore=["k", "v"])


def test_ratios_of_an_empty_table_are_null(spark):
    empty = frame(spark, [])
    assert rows(null_ratios(empty)) == [(None, None)]
    assert rows(null_drop_report(empty, "t")) == [("t", 0, 0, 0)]
    assert rows(duplicate_report(empty, ["k"], "t")) == [("t", 0, 0, 0)]
