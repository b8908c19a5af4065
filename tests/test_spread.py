"""The rows of a task are bounded, whatever the bytes of a split, and the results stay the same."""

import pytest

from catalog import feeds, live, tables

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(repr, df.collect()))


def test_splits_of_many_rows_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(tables, "TASK_ROWS", 50, raising=False)
    parts = live._events(spark, SF).rdd.glom().map(len).collect()
    assert len(parts) == 20 and max(parts) <= 50


@pytest.mark.parametrize("query", [live.QUERIES["stream_nhl_rollup"], feeds.QUERIES["odds_best_prices"]])
def test_results_stay(spark, monkeypatch, query):
    expected = rows(query(spark, SF))
    monkeypatch.setattr(tables, "TASK_ROWS", 250, raising=False)
    assert expected and rows(query(spark, SF)) == expected
