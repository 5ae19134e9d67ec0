"""Types of text columns that widen load by load (S-03, S-04).

Files of text arrive without types.  A *sketch* counts, for every column, how
many values there are and how many fit each type of a ladder.  Sketches of
several loads add up, so the types of all data so far are known without reading
it again.  A column's type is the narrowest of those that most values fit, if at
least ``MIN_FIT`` of them do, and text otherwise; types only ever widen along
the ladder.  Values that do not fit go to the rescue column, none is lost.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: narrow to wide, and what holds all values of each; a column without any value so far has the type ""
LADDER = ("boolean", "int", "bigint", "double", "date", "timestamp_ntz", "string")
WIDER = {"": LADDER, "boolean": ("string",), "int": ("bigint", "double", "string"), "bigint": ("string",),
         "double": ("string",), "date": ("timestamp_ntz", "string"), "timestamp_ntz": ("string",), "string": ()}
#: what a sketch counts: values, values that fit each type, whole numbers that a double does not keep
COUNTS = ("n", *LADDER[:-1], "long_only")
#: the share of a column's values that a type must fit
MIN_FIT = 0.75
#: digits that a double keeps
DIGITS = 15

Sketch = dict[str, dict[str, int]]


def fits(value: Column, dtype: str) -> Column:
    """Whether a text can be stored as ``dtype`` without loss: numbers with
    leading zeros are codes, a double keeps ``DIGITS`` digits (or the text it prints)."""
    cast = value.try_cast(dtype or "string")
    if dtype == "boolean":
        return value.isin("true", "false")
    if dtype in ("int", "bigint"):
        return cast.isNotNull() & value.rlike(r"^(0|-?[1-9][0-9]*)$")
    if dtype == "double":
        short = F.length(F.regexp_replace(value, r"[eE].*$|[^0-9]", "")) <= DIGITS
        return (cast.isNotNull() & value.rlike(r"^-?(0|[1-9][0-9]*)?(\.[0-9]+)?([eE][+-]?[0-9]+)?$")
                & (short | (cast.cast("string") == value)))
    if dtype == "date":
        return cast.isNotNull() & value.rlike(r"^\d{4}-\d{2}-\d{2}$")
    if dtype == "timestamp_ntz":
        return cast.isNotNull() & value.rlike(r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?$")
    return F.lit(True)


def sketch_aggregates(columns: Sequence[str]) -> list[Column]:
    """One count a column and type (``<i>:<type>``) and one of its values (``<i>:n``)."""
    out = []
    for i, c in enumerate(columns):
        v = F.col(f"`{c}`")
        out.append(F.count(v).alias(f"{i}:n"))
        ok = {t: F.coalesce(fits(v, t), F.lit(False)) for t in LADDER[:-1]}
        out += [F.count_if(ok[t]).alias(f"{i}:{t}") for t in ok]
        out.append(F.count_if(ok["bigint"] & ~ok["double"]).alias(f"{i}:long_only"))
    return out


def as_sketch(columns: Sequence[str], counts: Mapping[str, int]) -> Sketch:
    return {c: {k: int(counts.get(f"{i}:{k}") or 0) for k in COUNTS} for i, c in enumerate(columns)}


def sketch(df: DataFrame, columns: Sequence[str]) -> Sketch:
    """The sketch of one load: one aggregate, one row to the driver."""
    return as_sketch(columns, df.agg(*sketch_aggregates(columns)).first().asDict())


def merged(a: Sketch, b: Sketch) -> Sketch:
    return {c: {k: a.get(c, {}).get(k, 0) + b.get(c, {}).get(k, 0) for k in COUNTS} for c in {**a, **b}}


def widened(old: str, new: str) -> str:
    """The narrowest type that holds the values of both."""
    if new == old or new in WIDER[old]:
        return new
    if old in WIDER[new]:
        return old
    return next(t for t in LADDER if t in WIDER[old] and t in WIDER[new])


def types_of(seen: Sketch, before: Mapping[str, str] | None = None, min_fit: float = MIN_FIT) -> dict[str, str]:
    """The type of each column, never narrower than ``before``."""
    out = {}
    for c, counts in seen.items():
        best = max((counts[t] for t in LADDER[:-1]), default=0)
        chosen = "string"
        if counts["n"] and best >= min_fit * counts["n"]:
            chosen = next(t for t in LADDER[:-1] if counts[t] == best)
        known = (before or {}).get(c, "")
        if not counts["n"]:
            out[c] = known
        elif known == "bigint" and chosen == "double" and not counts["long_only"]:
            out[c] = chosen  # all whole numbers so far are short enough
        else:
            out[c] = widened(known, chosen)
    return out


def typed_schema(types: Mapping[str, str], rescue: str) -> T.StructType:
    return T.StructType([T.StructField(c, T._parse_datatype_string(t or "string")) for c, t in types.items()]
                        + [T.StructField(rescue, T.StringType())])


def typed(df: DataFrame, types: Mapping[str, str], rescue: str, extra: Sequence[str] = ()) -> DataFrame:
    """Text columns as their types; a value that does not fit becomes null and
    stands, by column name, in the JSON of ``rescue``, as do the values of
    ``extra`` columns.  A ``rescue`` column of ``df`` is taken over."""
    out, bad = [], []
    for c, t in types.items():
        v = F.col(f"`{c}`")
        ok = F.coalesce(fits(v, t), F.lit(False))
        out.append(F.when(ok, v.try_cast(t or "string")).alias(c))
        if t not in ("", "string"):
            bad += [F.lit(c), F.when(v.isNotNull() & ~ok, v)]
    for c in extra:
        bad += [F.lit(c), F.col(f"`{c}`")]
    if not bad:
        return df.select(*out, F.lit(None).cast("string").alias(rescue))
    m = F.map_filter(F.create_map(*bad), lambda k, v: v.isNotNull())
    return df.select(*out, F.when(F.size(m) > 0, F.to_json(m)).alias(rescue))


def retyped(df: DataFrame, types: Mapping[str, str], now: Mapping[str, str], rescue: str) -> DataFrame:
    """Rows written with ``types`` as rows of the wider types ``now``: stored
    values are cast, rescued texts that fit by now move into their columns."""
    if dict(types) == dict(now):
        return df
    kept = F.from_json(F.col(rescue), "map<string,string>")
    out, moved = [], []
    for c, t in now.items():
        if c not in types:
            out.append(F.lit(None).cast(t or "string").alias(c))
            continue
        text = F.try_element_at(kept, F.lit(c))
        ok = text.isNotNull() & F.coalesce(fits(text, t), F.lit(False))
        value = F.col(f"`{c}`").cast(t or "string")
        out.append((F.when(ok, text.try_cast(t or "string")).otherwise(value) if types[c] != t else value).alias(c))
        if types[c] != t:
            moved.append(F.when(ok, F.lit(c)))
    gone = F.array_compact(F.array(*moved)) if moved else F.array().cast("array<string>")
    left = F.map_filter(kept, lambda k, v: ~F.array_contains(gone, k))
    return df.select(*out, F.when(F.size(left) > 0, F.to_json(left)).alias(rescue))
