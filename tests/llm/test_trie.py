"""The trie of conversation prefixes against a plain version."""

import hashlib
import random
import zlib

import pytest

from lampyris.llm import prefix_trie as module
from lampyris.llm.prefix_trie import prefix_trie, rebuilt

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows, every=20, heads=4):
    """All nodes by dictionaries of whole prefixes."""
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append(((turn is not None, turn), (role or "", text or "")))
    turns = {c: [t for _, t in sorted(v, key=lambda x: x[0])] for c, v in turns.items()}
    made = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = turns.get(c - int(c - every * int(c / every)), [])
        made[c] = base[:h] + own[h:]
    members = {}
    for c, own in made.items():
        for d in range(len(own) + 1):
            members.setdefault(tuple(own[:d]), []).append(c)
    words = lambda text: len([w for w in text.translate(str.maketrans("\t\n\v\f\r", "     ")).split(" ") if w])
    out = []
    for node, convs in members.items():
        below = [x for x in members if x[: len(node)] == node]
        children = lambda x: sum(len(y) == len(x) + 1 and y[: len(x)] == x for y in members)
        ends = sorted(c for c in convs if len(made[c]) == len(node))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), children(node), sum(children(x) == 0 for x in below),
            sum((len(members[x]) - 1) * words(x[-1][1]) for x in below if x), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def nodes(spark, rows, **kw):
    got = prefix_trie(rebuilt(spark.createDataFrame(rows, SCHEMA), **kw))
    return sorted((tuple(r) for r in got.collect()), key=str)


def conversations(seed, n=70):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        kind = c % 4
        for t in range(rng.randint(1, 6)):
            text = f"opening {t}" if kind == 0 else rng.choice(["yes", "no", "a b  c\n"]) if kind == 1 else f"own {c} {rng.random()}"
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_nodes_equal_a_plain_version(spark, seed):
    rows = conversations(seed)
    assert nodes(spark, rows) == plain(rows)


def test_conversations_as_they_are(spark):
    rows = conversations(3, 30)
    assert nodes(spark, rows, heads=1) == plain(rows, heads=1)


def test_odd_rows(spark):
    rows = [(0, None, None, None), (0, 1, "user", ""), (0, 1, "user", ""), (1, 5, None, "x"), (None, 1, "user", "lost"), (-3, 1, "user", "minus"), (45, 9, "user", "base is absent")]
    assert nodes(spark, rows) == plain(rows)


def test_empty_table_and_extra_columns(spark):
    assert nodes(spark, []) == []
    rows = conversations(4, 10)
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", depth int, P1 string")
    assert sorted((tuple(r) for r in prefix_trie(rebuilt(frame)).collect()), key=str) == plain(rows)


def test_long_conversations_and_a_crowded_sketch(spark, monkeypatch):
    """Conversations longer than a chunk, copies whose ids fill several ranges, and a sketch too small to prove anything alone."""
    monkeypatch.setattr(module, "CHUNK", 4)
    monkeypatch.setattr(module, "IDS", 3)
    monkeypatch.setattr(module, "WIDEST", 1)
    rows = [(c, t, "user", f"turn {t}" if c != 7 or t < 9 else "other") for c in range(11) for t in range(15)]
    rows += [(c, 0, "user", "same") for c in range(100, 112)]
    monkeypatch.setattr(module, "DEPTH", 1)
    assert nodes(spark, rows) == plain(rows)


def test_a_node_proven_alone_above_one_that_is_not(spark, monkeypatch):
    """In a narrow sketch some prefixes collide and those before them do not."""
    monkeypatch.setattr(module, "WIDEST", 1)
    rows = [(c, t, "user", f"own {c} {t}") for c in range(1, 60) for t in range(30)]
    assert nodes(spark, rows, heads=1) == plain(rows, heads=1)


def test_turns_of_equal_number_stand_by_role_and_text(spark):
    """Each conversation begins as the one before it, if ties stand in this order; nulls come last."""
    said = [("assistant", "b"), ("assistant", None), ("user", "a"), ("user", "c"), ("user", None), (None, "a")]
    rows = [(c, turn, *said[i]) for c in range(1, 7) for turn in (None, 3) for i in range(c if turn else 1)]
    assert nodes(spark, rows[::-1], heads=1) == plain(rows, heads=1)
