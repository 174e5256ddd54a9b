import hashlib
import random
import zlib
from collections import defaultdict
from math import fmod

import pytest

from cohortspark.llm import prefix_trie as operator
from cohortspark.llm import registry

SCHEMA = "conv_id long, turn long, role string, text string, block long, d1 string, part string"


def ordered(rows):
    """Turns (role, text) of every conversation."""
    conversations = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            conversations[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in conversations.items()}


def rebuilt(conversations):
    out = {}
    for c, turns in conversations.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = conversations.get(c - int(fmod(c, 100)), [])
        out[c] = base[:h] + turns[h:]
    return out


def trie(conversations):
    """Rows of all nodes, prefix by prefix."""
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for key, inside in members.items():
        for d in range(len(key) + 1):
            leaves[key[:d]] += key not in children
            saved[key[:d]] += (len(inside) - 1) * len(key[-1][1]) if key else 0
    return sorted(
        (
            min(inside),
            len(key),
            min(members[key[:-1]]) if key else -1,
            len(inside),
            len(children[key]) if key in children else 0,
            leaves[key],
            saved[key],
            hashlib.sha256(",".join(map(str, sorted(ends.get(key, [])))).encode()).hexdigest(),
        )
        for key, inside in list(members.items())
    )


def found(frame):
    return sorted(tuple(-1 if v is None else v for v in r) for r in frame.collect())


def run(spark, scratch, rows, parts=3):
    frame = spark.createDataFrame([(*r, 1, "x", "x") for r in rows], SCHEMA).repartition(parts)
    turns = operator.number_turns(frame, scratch)
    plain = found(operator.prefix_trie(turns, turns.select("conv_id").distinct(), scratch))
    borrowed = operator.with_borrowed_openings(turns, scratch)
    return plain, found(operator.prefix_trie(*borrowed, scratch))


def both(rows):
    conversations = ordered(rows)
    return trie(conversations), trie(rebuilt(conversations))


ODD = [
    (0, None, "user", "first"), (0, None, "user", "also first"), (0, 3, None, None),
    (0, 2, "user", "x"), (0, 2, "user", "x"), (0, 2, "assistant", "x"), (0, 9, "", ""),
    (1, 1, "user", "x"), (2, 1, "user", "x"), (102, 5, "user", "x"), (103, 1, "", "userx"),
    (104, 1, "user", "x"), (104, 2, "a", "\n"), (-5, 1, "user", "é\U0001f600"), (-105, 1, "a", "b"),
    (None, 1, "user", "nobody"), (200, 1, "u", "t" * 100_000), (201, 1, "u", "t" * 99_999 + "s"),
    (2**62, 1, "user", "x"), (-(2**62), 1, "user", "x"),
]


def test_odd_rows(spark, scratch):
    assert run(spark, scratch, ODD) == both(ODD)


def test_random_conversations(spark, scratch):
    dice = random.Random(7)
    rows = []
    for c in range(250):
        for turn in range(dice.choice([1, 2, 4, 5, 8, 9, 13])):
            text = dice.choice("aab") if turn not in (4, 7) else "fixed"
            rows.append((c, turn, dice.choice(["u", "u", "u", None]), text))
    dice.shuffle(rows)
    assert run(spark, scratch, rows) == both(rows)


def test_a_long_and_a_popular_conversation(spark, scratch, monkeypatch):
    monkeypatch.setattr(operator, "_SEGMENT", 3)
    rows = [(7, i, "u", str(i % 5)) for i in range(700)] + [(8, i, "u", str(i % 5)) for i in range(650)]
    rows += [(1000 + c, t, "u", f"same {t}") for c in range(300) for t in range(5)]
    rows += [(2000 + c, 0, "u", f"same {c % 2}") for c in range(100)]
    assert run(spark, scratch, rows, 8) == both(rows)


def test_all_turns_tied(spark, scratch):
    rows = [(c, 1, "u", str(i)) for c in (1, 2) for i in range(120)]
    assert run(spark, scratch, rows) == both(rows)


def test_no_conversations(spark, scratch):
    assert run(spark, scratch, []) == ([], [])
    assert run(spark, scratch, [(None, 1, "a", "b")]) == ([], [])


def test_only_turnless_conversations(spark, scratch):
    # crc32("25") % 6 = 1, and there is no conversation 0.
    short = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6)
    rows = [(short, 1, "u", "x")]
    plain, borrowed = run(spark, scratch, rows)
    assert (plain, borrowed) == both(rows)
    assert len(borrowed) == 1 and borrowed[0][:6] == (short, 0, -1, 1, 0, 1)


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_the_query_over_the_given_tables(spark, sf):
    folder = f"/root/testdata/{sf}"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    got = found(registry.queries()["op13_prefix_trie"](spark, folder))
    assert got == trie(rebuilt(ordered(rows)))
