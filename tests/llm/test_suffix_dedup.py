"""Removal of repeated byte strings against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from widefold.llm import suffix_dedup

DOCUMENTS = "doc_id long, text string"


def covered(rows, length, keep):
    """Removed bytes of each row, by looking at every string of `length` bytes."""
    texts = [(d, (t or "").encode()) for d, t in rows]
    if keep == "first":
        order = sorted(range(len(texts)), key=lambda i: (texts[i][0] is None, texts[i][0] or 0, hashlib.sha256(texts[i][1]).digest()[:16]))
    else:
        order = range(len(texts))
    seen, times = {}, Counter()
    for i in order:
        b = texts[i][1]
        for s in range(len(b) - length + 1):
            times[b[s : s + length]] += 1
            seen.setdefault(b[s : s + length], (texts[i][0], b, s))
    out = []
    for d, b in texts:
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            f = b[s : s + length]
            if times[f] > 1 and (keep == "none" or seen[f] != (d, b, s)):
                gone[s : s + length] = True
        out.append(gone)
    return texts, out


def expected(rows, length, keep):
    texts, gone = covered(rows, length, keep)
    out = []
    for (d, b), g in zip(texts, gone, strict=True):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], g.astype(int), [0]])))
        kept = bytes(np.frombuffer(b, np.uint8)[~g])
        out.append((d, kept, edges[::2].tolist(), edges[1::2].tolist()))
    return sorted(out, key=repr)


def actual(spark, rows, length, keep):
    df = suffix_dedup.without_repeats(spark.createDataFrame(rows, DOCUMENTS).repartition(3), length, keep)
    return sorted([(r["doc_id"], bytes(r["kept"]), r["starts"], r["ends"]) for r in df.collect()], key=repr)


def generated(seed, n, length):
    """Texts of few characters with shared passages, copies, periods and nulls."""
    draw = random.Random(seed)
    passages = ["".join(draw.choices("abcé", k=draw.randint(length // 2, 4 * length))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(draw.randint(0, 4)):
            p = draw.choice(passages)
            a = draw.randint(0, len(p) // 2)
            parts += ["".join(draw.choices("abcdé", k=draw.randint(0, length))), p[a : a + draw.randint(0, len(p))]]
        rows.append((i, "".join(parts)))
    rows += [(n, "ab" * 3 * length), (n + 1, "x" * 5 * length), (n + 2, None), (n + 3, ""), (n + 4, rows[3][1])]
    return [*rows, (n + 5, rows[4][1]), (n + 5, rows[4][1]), (None, rows[5][1]), (None, "no id" * length), (None, "0123456789" * 9)]


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("length", [13, 40])
def test_against_brute_force(spark, keep, length):
    rows = generated(length, 50, length)
    if keep == "first":
        rows = list(dict.fromkeys(rows))
    assert actual(spark, rows, length, keep) == expected(rows, length, keep)


@pytest.mark.parametrize("keep", ["none", "first"])
def test_small_pieces_and_blocks(spark, keep, monkeypatch):
    """Texts of many pieces, and anchors whose stretches are dealt out over many suffix arrays."""
    monkeypatch.setattr(suffix_dedup, "PIECE", 64)
    monkeypatch.setattr(suffix_dedup, "TOGETHER", 2)
    monkeypatch.setattr(suffix_dedup, "SORTED_BYTES", 200)
    rows = list(dict.fromkeys(generated(5, 60, 20)))
    assert actual(spark, rows, 20, keep) == expected(rows, 20, keep)


def test_common_passage(spark):
    """A passage that all documents share, with other edges in each."""
    draw = random.Random(1)
    passage = "".join(draw.choices("abcdefghij", k=300))
    rows = [(i, "".join(draw.choices("klmnop", k=draw.randint(0, 50))) + passage[i % 7 : 290 + i % 11] + str(i)) for i in range(80)]
    assert actual(spark, rows, 200, "none") == expected(rows, 200, "none")
    assert actual(spark, rows, 200, "first") == expected(rows, 200, "first")


def test_longest_previous_factors():
    """Every suffix of a text, against a search at each earlier place."""
    draw = random.Random(2)
    for n in (1, 2, 50, 300):
        text = "".join(draw.choices("ab", k=n))
        order = np.array(sorted(range(n), key=lambda i: text[i:]))

        def shared(i, j):
            k = 0
            while max(i, j) + k < n and text[i + k] == text[j + k]:
                k += 1
            return k

        common = np.array([0, *[shared(a, b) for a, b in zip(order, order[1:])]])
        found = suffix_dedup.longest_previous(order, common, np.arange(n))
        assert found.tolist() == [max([shared(i, j) for j in range(i)], default=0) for i in range(n)]


def test_odd_tables(spark):
    assert actual(spark, [], 200, "none") == []
    assert actual(spark, [(1, None), (None, ""), (1, "short")], 200, "first") == [(1, b"", [], []), (1, b"short", [], []), (None, b"", [], [])]
    big = "".join(random.Random(3).choices("abcdefgh ", k=3_000_000))
    rows = [(1, big), (2, "y" * 1000 + big[1_500_000:1_500_300] + "z")]
    out = actual(spark, rows, 200, "none")
    assert out[0][2:] == ([1_500_000], [1_500_300]) and out[1][2:] == ([0], [1300])
    with pytest.raises(ValueError):
        suffix_dedup.repeated_spans(spark.createDataFrame([], DOCUMENTS), 200, "last")


def test_extra_columns(spark):
    df = spark.createDataFrame([(1, "a" * 500, "k", 1, 2)], DOCUMENTS + ", key string, start int, n int")
    row = suffix_dedup.without_repeats(df, keep="none").first()
    assert row["whole"]["key"] == "k" and bytes(row["kept"]) == b"" and row["ends"] == [500]


def test_query(spark):
    """Whole given texts, the strings counted by their digests."""
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    wanted = {d: (kept, starts) for d, kept, starts, _ in expected(rows, 200, "none")}
    out = suffix_dedup.query(spark, sf).collect()
    assert len(out) == len(rows) and sum(r["n_removed"] for r in out) > 0
    for r in out:
        kept, starts = wanted[r["doc_id"]]
        assert (r["n_bytes"] - r["n_removed"], r["n_spans"]) == (len(kept), len(starts))
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()
