"""The tree of conversation beginnings against brute force."""

import hashlib
import random
import zlib

import pytest

from checks.compare import canonical, connect
from widefold.llm import prefix_tree

CONVERSATIONS = "conv_id long, turn long, role string, text string"
SF = "/root/testdata/sf0.01"


def brute_force(rows):
    """Nodes of the tree by lists of turns."""
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    rebuilt = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        giver = c - (abs(c) % 5) * (1 if c > 0 else -1)
        rebuilt[c] = tuple(turns.get(giver, [])[:h] + turns[c][h:])
    members = {}
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    out = []
    for path, cs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        parents = {p[:-1] for p in below if p}
        out.append((
            min(cs), len(path), min(members[path[:-1]]) if path else None, len(cs),
            sum(1 for p in below if len(p) == len(path) + 1), sum(1 for p in below if p not in parents),
            sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p),
            hashlib.sha256(",".join(map(str, sorted(c for c in cs if rebuilt[c] == path))).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def tree_of(spark, rows, monkeypatch=None, schema=CONVERSATIONS):
    df = spark.createDataFrame(rows, schema)
    sized = df.selectExpr("*", "cast(octet_length(coalesce(text, '')) as long) AS bytes")
    conversations, turns = prefix_tree.rebuild(sized, ["bytes"])
    return sorted([tuple(r) for r in prefix_tree.prefix_tree(conversations, turns).collect()], key=repr)


def generated(seed, conversations, most_turns, words):
    draw = random.Random(seed)
    rows = []
    for c in range(-5, conversations):
        for i in range(draw.randint(1, most_turns)):
            turn = None if i == 0 and draw.random() < 0.3 else i
            role = draw.choice(["user", "assistant", None])
            rows.append((c, turn, role, draw.choice(words)))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = generated(seed, 60, 6, ["a", "b", None, "", "héllo"])
    assert tree_of(spark, rows) == brute_force(rows)


def test_small_blocks(spark, monkeypatch):
    """Conversations of many blocks, and lists of ends of many rows."""
    monkeypatch.setattr(prefix_tree, "BLOCK", 3)
    monkeypatch.setattr(prefix_tree, "LISTED", 2)
    rows = generated(3, 40, 25, ["a"]) + [(c, t, "user", "same") for c in range(100, 140) for t in range(30)]
    assert tree_of(spark, rows) == brute_force(rows)


def test_odd_rows(spark):
    """Null ids are left out; repeated rows are turns; conversations may end up without turns."""
    rows = [(None, 1, "user", "lost"), (7, 1, "user", "x"), (7, 1, "user", "x"), (0, None, None, None), (0, 3, "user", "y" * 100_000)]
    rows += [(11, 1, "user", "gone"), (12, 1, "user", "gone"), (13, 1, "user", "gone")]
    assert tree_of(spark, rows) == brute_force(rows)
    assert any(r[1] == 0 and r[7] != hashlib.sha256().hexdigest() for r in tree_of(spark, rows))


def test_empty_table(spark):
    assert tree_of(spark, []) == []


def test_other_columns_do_not_clash(spark):
    rows = [(1, 1, "user", "x"), (2, 1, "user", "x")]
    more = [(*r, "a", 1, 2) for r in rows]
    assert tree_of(spark, more, schema=CONVERSATIONS + ", range string, pos long, digest long") == brute_force(rows)


def test_nodes_with_their_turns(spark):
    rows = [(0, 1, "user", "hi"), (0, 2, "assistant", "hello")]
    conversations, turns = prefix_tree.rebuild(spark.createDataFrame(rows, CONVERSATIONS))
    tree = prefix_tree.prefix_tree(conversations, turns.selectExpr("*", "cast(octet_length(text) as long) AS bytes"))
    shown = prefix_tree.with_turns(tree, turns).orderBy("depth").select("depth", "role", "text").collect()
    assert [tuple(r) for r in shown] == [(0, None, None), (1, "user", "hi"), (2, "assistant", "hello")]


def test_query_and_sql(spark):
    df = prefix_tree.query(spark, SF)
    result = connect(SF).execute(prefix_tree.ORACLE_SQL)
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(result.fetchall(), names)
