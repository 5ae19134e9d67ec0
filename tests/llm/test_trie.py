"""The prefix trie against one built turn by turn."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from tidemark.llm import prefix_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string, n long, words string, depth int"


def plain(rows) -> list[tuple]:
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, tie, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in rebuilt.items():
        ends[tuple(turns)].append(c)
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    words = {n: len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0 for n in members}
    children = defaultdict(int)
    for n in members:
        if n:
            children[n[:-1]] += 1
    out = []
    for n in members:
        under = [m for m in members if m[:len(n)] == n]
        out.append((min(members[n]), len(n), min(members[n[:-1]]) if n else None, len(members[n]), children[n],
                    sum(children[m] == 0 for m in under), sum((len(members[m]) - 1) * words[m] for m in under),
                    hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()))
    return sorted(out, key=str)


def nodes(df) -> list[tuple]:
    turns = trie.ordered_turns(df).cache()
    conv = F.col("conv")
    rebuilt = trie.splice(turns, conv - conv % 20, F.crc32(conv.cast("string").cast("binary")) % 4, longest=3)
    return sorted([tuple(r) for r in trie.prefix_trie(rebuilt, turns.select("conv")).collect()], key=str)


def made(spark, rows):
    return spark.createDataFrame([(*r, 1, "w", 3) for r in rows], SCHEMA)


def test_trie_of_random_conversations(spark):
    r = random.Random(6)
    rows = []
    for c in r.sample(range(400), 160):
        for turn in range(r.randint(1, 6)):
            rows.append((c, turn, r.choice(["user", "assistant"]), r.choice(["yes", "no it is", "so  be\tit"])))
    r.shuffle(rows)
    got = nodes(made(spark, rows))
    assert got == plain(rows)
    assert any(x[4] == 0 and x[3] > 1 for x in got)  # leaves with several members


def test_trie_of_odd_rows(spark):
    rows = [(40, None, None, None), (40, 0, "user", "a b"), (40, 0, "user", "a b"), (40, 0, "user", ""),
            (41, 5, "user", "only"), (42, 1, "u", "x"), (42, 2, "u", "y"), (43, None, "u", "x"), (60, 1, "u", "w " * 9000),
            (None, 1, "u", "lost"), (999, 0, "u", None), (998, 0, "", "12:"), (997, 3, "1", "2:"), (61, 0, "u", "q")]
    rows += [(61, t, "u", f"t{t}") for t in range(1, 40)]
    assert nodes(made(spark, rows)) == plain(rows)


def test_trie_of_a_hot_conversation_and_of_many_copies(spark):
    """One sequence with more members than a text of ids holds, one conversation with many turns."""
    rows = [(20 * i, 0, "user", "hello there") for i in range(trie.CHUNK + 900)]
    rows += [(7, t, "user", f"turn {t % 5}") for t in range(1500)]
    got = nodes(made(spark, rows))
    same = ",".join(str(20 * i) for i in range(trie.CHUNK + 900))
    assert hashlib.sha256(same.encode()).hexdigest() in {x[-1] for x in got}
    assert max(x[1] for x in got) in (1499, 1500)
    root = next(x for x in got if x[1] == 0)
    assert root[3] == trie.CHUNK + 901 and root[2] is None


def test_trie_of_an_empty_table(spark):
    assert nodes(made(spark, [(1, 1, "u", "x")]).limit(0)) == []
