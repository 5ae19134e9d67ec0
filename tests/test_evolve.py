"""Types of text loads: sketches that add up, types that widen, nothing lost."""

from __future__ import annotations

import json

import pytest

from tidemark.sources import evolve
from tidemark.streaming.typed import TypedTable, stream_typed


def df(spark, *rows):
    return spark.createDataFrame([(a, b, None) for a, b in rows], "a string, b string, _corrupt_record string")


def test_sketches_add_up_and_choose_the_narrowest_type(spark):
    one = df(spark, ("1", "2024-01-01"), ("-7", None), ("x", "2024-02-03"), ("12", "2024-01-01"))
    two = df(spark, ("3000000000", "2024-01-01 10:00:00"), ("0", "2024-01-02"))
    a, b = evolve.sketch(one, ["a", "b"]), evolve.sketch(two, ["a", "b"])
    both = evolve.sketch(one.unionByName(two), ["a", "b"])
    assert evolve.merged(a, b) == both
    assert evolve.types_of(a) == {"a": "int", "b": "date"}
    assert evolve.types_of(both, evolve.types_of(a)) == {"a": "bigint", "b": "timestamp_ntz"}


@pytest.mark.parametrize("values, want", [
    (["1", "2"], "int"), (["1", "2.5"], "double"), (["007", "012"], "string"), (["true", "false"], "boolean"),
    (["12345678901234567890", "1"], "string"), (["9007199254740993", "2"], "bigint"), (["1e3", ".5"], "double"),
    (["2024-02-30", "x"], "string"), (["0.30000000000000004"], "double"), ([None, None], ""), (["+1", "1 "], "string")])
def test_types_lose_no_text(spark, values, want):
    d = df(spark, *[(v, None) for v in values])
    assert evolve.types_of(evolve.sketch(d, ["a"]))["a"] == want


def test_whole_numbers_become_doubles_only_if_all_are_short(spark):
    short = evolve.sketch(df(spark, ("3000000000", None)), ["a"])
    long = evolve.sketch(df(spark, ("9007199254740993", None)), ["a"])
    fraction = evolve.sketch(df(spark, *[("0.5", None)] * 9), ["a"])
    assert evolve.types_of(evolve.merged(short, fraction), {"a": "bigint"})["a"] == "double"
    assert evolve.types_of(evolve.merged(long, fraction), {"a": "bigint"})["a"] == "string"


def test_loads_widen_and_rescued_values_move_into_their_columns(spark, tmp_path):
    t = TypedTable(spark, str(tmp_path / "t"))
    t.write(0, df(spark, *[(str(i), None) for i in range(9)], ("2.5", None)), ["a", "b"])
    assert t.schema()["a"].dataType.simpleString() == "double"
    t = TypedTable(spark, str(tmp_path / "u"))
    t.write(0, df(spark, *[(str(i), None) for i in range(9)], ("n/a", None)), ["a", "b"])
    assert t.schema()["a"].dataType.simpleString() == "int"
    t.write(1, df(spark, *[("4000000000", "x")] * 9), ["a", "b"])
    t.write(2, df(spark, *[("word", "y")] * 30), ["a", "b"])
    t.write(2, df(spark, *[("word", "y")] * 30), ["a", "b"])  # a replay of the last load
    got = t.read().collect()
    assert t.schema()["a"].dataType.simpleString() == "string"
    assert sorted(r.a for r in got) == sorted([*map(str, range(9)), "n/a", *["4000000000"] * 9, *["word"] * 30])
    assert all(r._rescued_data is None for r in got) and sum(r.b is None for r in got) == 10


def test_header_names_broken_lines_and_restart(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    (land / "a.csv").write_text("id,v\n1,10\n2,zz\n3,30\n4,40\n5,50\n6,60,more\n7\n")
    args = (spark, str(land), str(tmp_path / "t"), str(tmp_path / "ck"))
    stream_typed(*args)
    (land / "b.csv").write_text("id,v\n8000000000,70\n")
    for _ in range(2):
        t = stream_typed(*args)
    got = {r.id: (r.v, r._rescued_data and json.loads(r._rescued_data)) for r in t.read().collect()}
    assert got == {1: (10, None), 2: (None, {"v": "zz"}), 3: (30, None), 4: (40, None), 5: (50, None),
                   6: (60, {"_corrupt_record": "6,60,more"}), 7: (None, {"_corrupt_record": "7"}), 8000000000: (70, None)}
    assert t.schema()["id"].dataType.simpleString() == "bigint"
