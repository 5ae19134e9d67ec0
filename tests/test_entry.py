"""The driver contract in __spark_entry__.py."""

from __future__ import annotations

import re

import __spark_entry__ as entry_module


def test_entry_returns_the_flagship(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0
    assert df.columns == ["id", "name", "dob", "gender", "country", "email", "eskey", "status", "start_date",
                          "end_date", "file_name", "created_date"]


def test_every_oracle_has_a_query_and_names_are_unique():
    queries, oracles = entry_module.queries(), entry_module.oracle_sql()
    assert set(oracles) <= set(queries)
    own = {k for k in queries if not re.match(r"op\d+_", k) and k != "pipeline"}
    assert own - set(oracles) == {"profile_approx"}
