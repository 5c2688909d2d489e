"""The entry points, with and without the llm folder."""

import __spark_entry__ as entry


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert "score_pairs" in entry.queries()
