"""Operator 4, personal data by weak supervision: regex, gazetteer and context
labelers vote on candidate spans, expectation-maximisation estimates how
reliable they are, and a span classifier is trained on the resulting labels.

Only SQL functions touch the rows.

1. One pass over the whole texts finds candidates: the four base kinds (also
   matches that fail their check; these count as candidates but are never
   reported) and the looser kinds of ``EXTRA``.  Positions are code points.
   Each candidate carries the votes of five labelers (yes, no or no opinion) as
   a short code, and features that the labelers do not see: the words on both
   sides (hashed), the shape of its characters, its length and its variety.
2. Votes take few values, so the corpus is summed up by one aggregate into a
   table of codes and counts whose size does not depend on the number of
   documents (at most ``MAX_CODES`` by construction).  On that table the driver
   runs expectation-maximisation over the labelers' confusion rates and the
   prior of each kind.
3. A second aggregate sums the probabilities of the codes by kind and feature,
   over all candidates (at most ``len(KINDS) * WIDTH`` rows).  These sums are all
   that the span classifier, a naive Bayes model per kind on the soft labels, is
   trained from: its weights are one array, a span's log odds the sum of the
   weights of its features.  It knows nothing of the votes.
4. Spans of the base kinds that pass their check are always reported.  Spans of
   the other kinds that pass theirs (``FORMS``) are added where the classifier
   gives a probability of at least ``accept`` and no base span overlaps.

The base patterns are matched leftmost and without overlaps, each kind for
itself.  They are written so that matching takes linear time and no deep stack
(possessive repeats, and no start inside a run already tried).

Edge cases: a null text is the empty text and has no spans; rows with null or
repeated ids are rows of their own; an empty table gives an empty result; other
columns are ignored (or passed on by ``detect(..., keep=True)``), whatever
their names.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text, materialise

BASE = ["email", "ip", "card", "phone"]
EXTRA = ["secret", "ssn", "iban", "obfuscated_email", "local_phone"]
KINDS = BASE + EXTRA
LABELERS = ["regex", "gazetteer", "context", "boundary", "shape"]
#: kinds, three votes by five labelers
MAX_CODES = len(KINDS) * 3 ** len(LABELERS)

#: features of the span classifier: buckets of the nearest word before, the one before that, the nearest word after
#: and the shape; classes of length and of variety
BUCKETS, GRADES = 64, 8
SLOTS = [BUCKETS, BUCKETS, BUCKETS, BUCKETS, GRADES, GRADES]
#: places a kind has in the table of weights; the first one is the prior
WIDTH = 1 + sum(SLOTS)
#: how many spans without evidence a class counts for, and the weight of a feature (they are not independent)
STEADY, DAMPED = 8.0, 0.5

_LOCAL = "A-Za-z0-9._%+-"
_LABEL = "[A-Za-z0-9-]"
#: kind: (cheap condition on the text, pattern)
PATTERNS = {
    "email": ("contains(text, '@')",
              rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@{_LABEL}++(?:\.{_LABEL}++)++"),
    "ip": ("text rlike '[0-9][.][0-9]'",
           r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": ("text rlike '[0-9]'", r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){13,}+"),
    "phone": ("contains(text, '+')", r"\+[0-9][\x20().0-9-]+[0-9]"),
    "secret": ("text rlike '[:=]' or contains(text, 'AKIA')",
               r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])|(?i)(?<![a-z0-9])(?:api[_-]?key|access[_-]?key|secret|token|password|passwd)[\x22']?"
               r"[\x20\t]{0,3}[:=][\x20\t]{0,3}[\x22']?[a-z0-9+/_=-]{8,}+[\x22']?"),
    "ssn": ("text rlike '[0-9]-[0-9]'", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "iban": ("text rlike '[A-Z]{2}[0-9]{2}'",
             r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "obfuscated_email": ("text rlike '(?i)[\\\\[(]at[\\\\])]'",
                         rf"(?i)(?<![{_LOCAL}])[{_LOCAL}]++\x20?[\[(]at[\])]\x20?{_LABEL}++"
                         rf"(?:\x20?(?:[\[(]dot[\])]|\.)\x20?{_LABEL}++)++"),
    "local_phone": ("text rlike '[0-9]{3}[ .-][0-9]{4}'",
                    r"(?<![0-9+().-])(?<![0-9]\x20)\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"),
}

# gazetteers: fixed values
TLDS = ["com", "org", "net", "edu", "gov", "int", "info", "biz", "io", "ai", "app", "dev", "eu", "de", "fr", "es", "it",
        "nl", "be", "ch", "at", "uk", "us", "ca", "au", "nz", "jp", "cn", "in", "br", "mx", "ru", "pl", "se", "no", "fi"]
CONTEXT = {
    "email": ["mail", "contact", "write"], "ip": ["ip", "host", "server", "address", "login"],
    "card": ["card", "visa", "credit", "payment"], "phone": ["phone", "tel", "call", "mobile", "fax"],
    "secret": ["token", "key", "akia", "secret", "password", "passwd"], "ssn": ["ssn", "social", "security"],
    "iban": ["iban", "account", "bank"], "obfuscated_email": ["mail", "contact", "write"],
    "local_phone": ["phone", "tel", "call", "mobile", "fax"],
}
OPPOSED = ["version", "isbn", "order", "invoice", "serial", "chapter", "section", "release"]
WINDOW = 32


def _q(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


_SPAN = "array<struct<kind:string,start:int,stop:int,span:string,before:string,after:string>>"


#: matches whose lengths are summed one by one; longer lists add up such blocks first
SUMMED = 128


def _find(kind: str) -> str:
    """SQL: all matches of a kind with their places, from the gaps between them,
    and the ends of the gaps on both sides.

    A place is the length of all before it.  Lengths are summed in two levels,
    inside blocks of ``SUMMED`` matches and over the blocks, so that the work
    grows with the matches and not with their square."""
    condition, pattern = PATTERNS[kind]
    # element i: the gap before match i, match i, the gap after it; the gap after the last match has no match
    zipped = (f"transform(array(split(text, {_q(pattern)}, -1)), g -> slice(arrays_zip(g, "
              f"regexp_extract_all(text, {_q(pattern)}, 0), slice(g, 2, greatest(size(g) - 1, 0))), 1, size(g) - 1))[0]")
    length = "length(y.g) + length(y.`1`)"
    total = f"aggregate(slice(z, cast(b * {SUMMED} as int) + 1, {SUMMED}), 0, (s, y) -> s + {length})"
    blocks = f"transform(sequence(0, cast(floor((size(z) - 1) / {SUMMED}) as int)), b -> {total})"
    before = "aggregate({0}, cast(array(0) as array<int>), (acc, n) -> array_append(acc, element_at(acc, -1) + n))".format(blocks)
    inside = f"aggregate(slice(z, i - i % {SUMMED} + 1, i % {SUMMED}), 0, (s, y) -> s + {length})"
    place = f"(p[cast(floor(i / {SUMMED}) as int)] + {inside} + length(x.g))"
    made = (f"named_struct('kind', '{kind}', 'start', at, 'stop', at + length(x.`1`), 'span', x.`1`, "
            f"'before', lower(right(x.g, {WINDOW})), 'after', lower(left(x.`2`, {WINDOW})))")
    # one-element arrays name what is used several times
    spans = (f"transform(array({before}), p -> transform(z, (x, i) -> transform(array({place}), at -> {made})[0]))[0]")
    return (f"if({condition}, transform(array({zipped}), z -> if(size(z) = 0, cast(array() as {_SPAN}), {spans}))[0], "
            f"cast(array() as {_SPAN}))")


_DIGITS = "regexp_replace(c.span, '[^0-9]', '')"
# doubled digits from the right, every second one, less nine above nine
_LUHN = (f"aggregate(transform(split(reverse({_DIGITS}), ''), (d, i) -> if(d = '', 0, if(i % 2 = 0, cast(d as int), "
         "cast(d as int) * 2 - if(cast(d as int) > 4, 9, 0)))), 0, (a, d) -> a + d) % 10 = 0")
#: SQL on a candidate ``c``: whether a base match counts
CHECKS = {
    "email": "true",
    "ip": r"forall(split(c.span, '\\.'), p -> length(ltrim('0', p)) <= 3 and "
          "coalesce(cast(nullif(ltrim('0', p), '') as int), 0) <= 255)",
    "card": f"length({_DIGITS}) between 14 and 19 and {_LUHN}",
    "phone": f"length({_DIGITS}) between 10 and 15",
}
#: the same for the other kinds that have numbers which are never given out, or a fixed range of lengths
FORMS = {
    "ssn": "substring(c.span, 1, 3) not in ('000', '666') and substring(c.span, 1, 1) <> '9' "
           "and substring(c.span, 5, 2) <> '00' and substring(c.span, 8, 4) <> '0000'",
    "iban": "length(replace(c.span, ' ', '')) between 15 and 34",
}


def _case(by_kind: dict[str, str], otherwise: str) -> str:
    return "case c.kind " + " ".join(f"when '{k}' then {v}" for k, v in by_kind.items()) + f" else {otherwise} end"


def _list(values: list[str]) -> str:
    return "array(" + ", ".join(_q(v) for v in values) + ")"


def _votes() -> str:
    """SQL: one letter per labeler, y(es), n(o) or - (no opinion)."""
    regex = _case({**CHECKS, **FORMS,
                   "secret": r"c.span rlike '[0-9]' and c.span rlike '[A-Za-z0-9+/_=-]{16,}'"}, "true")
    tld = r"array_contains(" + _list(TLDS) + r", lower(regexp_extract(right(c.span, 32), '([A-Za-z0-9-]+)$', 1)))"
    gazetteer = _case({"email": f"if({tld}, 'y', 'n')", "obfuscated_email": f"if({tld}, 'y', 'n')",
                       "card": "if(substring(c.span, 1, 1) in ('3', '4', '5', '6'), 'y', 'n')",
                       "ip": "if(c.span rlike '^(?:0|127|255)[.]', 'n', 'y')",
                       "phone": "if(c.span rlike '^[+][1-9]', 'y', 'n')",
                       "secret": "if(lower(c.span) rlike '^(?:api|access|akia|passw|secret|token)', 'y', '-')"}, "'-'")
    for_kind = _case({k: "'" + "|".join(v) + "'" for k, v in CONTEXT.items()}, "'-'")
    around = "concat(c.before, ' ', left(lower(c.span), 40), ' ', c.after)"
    context = (f"if(c.before rlike '{'|'.join(OPPOSED)}', 'n', "
               f"if(exists(split({for_kind}, '[|]'), w -> contains({around}, w)), 'y', '-'))")
    neighbours = "concat(right(c.before, 1), left(c.after, 1))"
    boundary = f"if({neighbours} rlike '[A-Za-z0-9]', 'n', 'y')"
    shape = f"if(length({_DIGITS}) = 0, '-', if(size(array_distinct(split({_DIGITS}, ''))) >= 4, 'y', 'n'))"
    return f"concat(if({regex}, 'y', 'n'), {gazetteer}, {context}, {boundary}, {shape})"


def _features() -> str:
    """SQL: the places of a candidate's features in the table of weights.

    Shapes keep up to 24 characters with runs of small letters, capitals and
    digits as one sign each.  A word that is missing is a feature too."""
    shape = ("regexp_replace(regexp_replace(regexp_replace(left(c.span, 24), '[a-z]+', 'a'), '[A-Z]+', 'A'), '[0-9]+', '0')")
    word = r"regexp_extract(c.{0}, '{1}', 1)"
    seen = [word.format("before", r"([a-z0-9_]+)[^a-z0-9_]*$"), word.format("before", r"([a-z0-9_]+)[^a-z0-9_]+[a-z0-9_]+[^a-z0-9_]*$"),
            word.format("after", r"^[^a-z0-9_]*([a-z0-9_]+)"), shape]
    places, at = ["0"], 1  # the prior
    for slot, what in enumerate(seen):
        places.append(f"{at} + pmod(xxhash64({what}, {slot}), {BUCKETS})")
        at += BUCKETS
    places.append(f"{at} + least({GRADES - 1}, floor(log2(c.stop - c.start)))")
    at += GRADES
    places.append(f"{at} + least({GRADES - 1}, size(array_distinct(split(left(c.span, 64), ''))) div 3)")
    own = _case({k: str(i * WIDTH) for i, k in enumerate(KINDS)}, "0")
    return f"transform(array({', '.join(places)}), f -> cast({own} + f as int))"


def candidates(docs: DataFrame, id_col: str, text_col: str, keep: bool = False) -> DataFrame:
    """``id``, ``spans`` (kind, start, stop, base, formed, code, features) and,
    with ``keep``, the row's own columns as the struct ``row``."""
    if keep:
        texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
                            F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    else:
        texts = id_and_text(docs, id_col, text_col)
    found = texts.withColumn("found", F.expr("concat(" + ", ".join(_find(k) for k in KINDS) + ")"))
    base, formed = _case(CHECKS, "false"), _case({**CHECKS, **FORMS}, "true")
    spans = F.expr(f"transform(found, c -> named_struct('kind', c.kind, 'start', c.start, 'stop', c.stop, 'base', {base}, "
                   f"'formed', {formed}, 'code', concat_ws(' ', c.kind, {_votes()}), 'features', {_features()}))")
    return found.select("id", *(["row"] if keep else []), spans.alias("spans"))


def estimate_reliability(counts: dict[str, int], rounds: int = 60) -> dict[str, float]:
    """Probability of each code (``kind votes``) that its spans are
    personal data: Dawid-Skene over the labelers, with a prior per kind.
    Counts are smoothed toward labelers that are right more often than not."""
    codes = {c: c.split(" ") for c in counts}
    p = {}
    for c, (_, votes) in codes.items():
        yes, no = votes.count("y"), votes.count("n")
        p[c] = (yes + 1) / (yes + no + 2) if votes[0] != "n" else 0.1
    for _ in range(rounds):
        prior = {}
        for kind in {k for k, _ in codes.values()}:
            n = sum(counts[c] for c in codes if codes[c][0] == kind)
            prior[kind] = (1 + sum(counts[c] * p[c] for c in codes if codes[c][0] == kind)) / (n + 2)
        rate = []
        for i in range(len(LABELERS)):
            table = {(1, "y"): 8.0, (1, "n"): 1.0, (1, "-"): 3.0, (0, "y"): 3.0, (0, "n"): 6.0, (0, "-"): 3.0}
            for c, (_, votes) in codes.items():
                table[1, votes[i]] += counts[c] * p[c]
                table[0, votes[i]] += counts[c] * (1 - p[c])
            for y in (0, 1):
                total = sum(table[y, v] for v in "yn-")
                for v in "yn-":
                    table[y, v] /= total
            rate.append(table)
        for c, (kind, votes) in codes.items():
            odds = math.log(prior[kind] / (1 - prior[kind]))
            odds += sum(math.log(rate[i][1, v] / rate[i][0, v]) for i, v in enumerate(votes))
            p[c] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return p


def train_classifier(sums: dict[int, tuple[float, float]]) -> list[float]:
    """The table of weights from the sums of the labels' probabilities (that a
    span with the feature is personal data, that it is not) by place.

    A class's share of a feature is drawn toward the share among all spans of the
    kind by ``STEADY`` spans, so that a class with few spans says little; the
    prior is the kind's odds."""
    weights = [0.0] * (len(KINDS) * WIDTH)
    for kind in range(len(KINDS)):
        yes, no = sums.get(kind * WIDTH, (0.0, 0.0))
        weights[kind * WIDTH] = math.log((yes + 1) / (no + 1))
        at = 1
        for size in SLOTS:
            for place in range(kind * WIDTH + at, kind * WIDTH + at + size):
                with_yes, with_no = sums.get(place, (0.0, 0.0))
                share = (with_yes + with_no + 1) / (yes + no + size)
                likely = ((with_yes + STEADY * share) / (yes + STEADY), (with_no + STEADY * share) / (no + STEADY))
                weights[place] = DAMPED * math.log(likely[0] / likely[1])
            at += size
    return weights


def _literal(spark: SparkSession, values: list, of: str) -> DataFrame:
    """One row per value, read from a text in the plan."""
    return spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(values)), f"array<{of}>")).alias("x")).select("x.*")


def learn(found: DataFrame) -> list[float]:
    """The weights of the span classifier, from the result of :func:`candidates`."""
    spans = found.select(F.explode("spans").alias("c"))
    counts = {r["code"]: r["n"] for r in spans.groupBy(F.col("c.code").alias("code"))
              .agg(F.count("*").alias("n")).collect()}  # at most MAX_CODES rows
    labels = [{"code": c, "p": p} for c, p in sorted(estimate_reliability(counts).items())]
    soft = F.broadcast(_literal(found.sparkSession, labels, "struct<code:string,p:double>"))  # as many
    seen = spans.withColumn("code", F.col("c.code")).join(soft, "code").select("p", F.explode("c.features").alias("place"))
    # at most len(KINDS) * WIDTH rows
    sums = {r["place"]: (r["yes"], r["n"] - r["yes"]) for r in
            seen.groupBy("place").agg(F.sum("p").alias("yes"), F.count("*").alias("n")).collect()}
    return train_classifier(sums)


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", accept: float = 0.5,
           keep: bool = False) -> DataFrame:
    """``id_col`` and ``spans``: the reported spans (kind, start, stop, base) by
    start, then kind; with ``keep`` also the input row as the struct ``row``."""
    found = materialise(candidates(docs, id_col, text_col, keep), "pii-candidates")
    weights = F.from_json(F.lit(json.dumps(learn(found))), "array<double>")  # folded to a literal by the optimizer
    least = math.log(accept / (1 - accept))

    def odds(c: Column) -> Column:
        return F.aggregate(c["features"], F.lit(0.0), lambda total, f: total + F.get(weights, f))

    def reported(based: Column):
        return lambda c: c["base"] | (c["kind"].isin(EXTRA) & c["formed"] & (odds(c) >= F.lit(least)) & ~F.exists(
            based, lambda b: (b["start"] < c["stop"]) & (c["start"] < b["stop"])))

    order = " ".join(f"when '{k}' then {i}" for i, k in enumerate(KINDS))
    spans = (found.withColumn("based", F.filter("spans", lambda c: c["base"]))
             .withColumn("spans", F.filter("spans", reported(F.col("based"))))
             .withColumn("spans", F.expr(
                 f"transform(array_sort(transform(spans, c -> named_struct('start', c.start, 'k', case c.kind {order} end, "
                 "'stop', c.stop, 'kind', c.kind, 'base', c.base))), c -> named_struct('kind', c.kind, 'start', c.start, "
                 "'stop', c.stop, 'base', c.base))")))
    return spans.select(F.col("id").alias(id_col), *(["row"] if keep else []), "spans")


def digests(detected: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base spans by kind, their SHA-256, all spans as text, and
    the counts of all spans and of the added ones by kind."""
    text = "array_join(transform(filter(spans, c -> {0}), c -> concat_ws(':', c.kind, c.start, c.stop)), ',')"
    return detected.select(
        id_col, *[F.expr(f"cast(size(filter(spans, c -> c.base and c.kind = '{k}')) as long)").alias(f"n_{k}") for k in BASE],
        F.sha2(F.expr(text.format("c.base")), 256).alias("base_sha256"), F.expr(text.format("true")).alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
        *[F.expr(f"cast(size(filter(spans, c -> c.kind = '{k}')) as long)").alias(f"n_{k}") for k in EXTRA])


def mask(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with every reported span replaced by its kind in square
    brackets (of overlapping spans the part not yet replaced is cut out)."""
    detected = detect(docs, id_col, text_col, keep=True)
    text = f"row.`{text_col}`"
    rebuilt = F.expr(
        "aggregate(spans, named_struct('at', 0, 'out', ''), (acc, c) -> if(c.stop <= acc.at, acc, named_struct("
        f"'at', c.stop, 'out', concat(acc.out, substring({text}, acc.at + 1, greatest(c.start - acc.at, 0)), '[', c.kind, ']'))), "
        f"acc -> concat(acc.out, substring({text}, acc.at + 1)))")
    return detected.select(*[F.when(F.size("spans") > 0, rebuilt).otherwise(F.col(text)).alias(c) if c == text_col
                             else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
