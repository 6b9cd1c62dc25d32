"""Alignment of two tokenizers against one that aligns whole texts token by token."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from widefold.llm import alignment

DOCUMENTS = "doc_id long, text string"
#: A vocabulary writes bytes that don't print as later characters: a fixed rule.
PRINTING = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_OF = {chr(b): b for b in PRINTING} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in PRINTING)}
ROWS = [
    (1, "Hello world, it's 12 345 o'clock  already.\n\n  Indented\tline "), (2, ""), (3, None), (4, " "), (5, "  two spaces"),
    (6, "漢字 kanji émigré naïve 🙂 ok"), (7, "a <|endoftext|> b <s> c </s>"), (8, "the▁mark is not a space"),
    (9, "the the the a b"), (9, "the the the a b"), (None, "no id here"), (10, "x" * 5000 + " y " * 3000), (11, "nul \x00 byte"),
    (12, chr(0x180E) + " odd " + chr(0x200B) + " spaces\x85and\x1c more"), (13, "<0x41> and ▁"), (14, "\n"), (15, "  trailing   "),
]


def whole(text):
    """Token ids and bytes of a text by both tokenizers, or none."""
    a, b = Tokenizer.from_file(alignment.vocabulary_paths()[0]), sentencepiece.SentencePieceProcessor()
    a.encode_special_tokens = True
    b.load(alignment.vocabulary_paths()[1])
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    bytes_a = [bytes(BYTE_OF[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    wanted = (" " + text).encode()
    if not text or b"".join(bytes_a) != wanted or b"".join(bytes_b) != wanted:
        return [], [], [], []
    return ids_a, ids_b, np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()


def brute_force(rows):
    tokens = [whole(t or "") for _, t in rows]
    counts, links = Counter(), []
    for ids_a, ids_b, ends_a, ends_b in tokens:
        own = [(a, b) for a, i in zip(ids_a, ends_a) for b, j in zip(ids_b, ends_b) if i == j]
        links.append(own)
        counts.update(own)
    highest = defaultdict(int)
    for (a, b), n in counts.items():
        highest[b] = max(highest[b], n)
    out = []
    for (doc_id, _), (ids_a, ids_b, ends_a, ends_b), own in zip(rows, tokens, links):
        shown, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            to_i, to_j = ends_a.index(end) + 1, ends_b.index(end) + 1
            shown.append(",".join(map(str, ids_a[i:to_i])) + "|" + ",".join(map(str, ids_b[j:to_j])))
            i, j = to_i, to_j
        digest = hashlib.sha256(";".join(shown).encode()).hexdigest() if ids_a else ""
        best = sum(counts[p] == highest[p[1]] for p in own)
        out.append((doc_id, len(ids_a), len(ids_b), len(shown), len(own), best, sum(counts[p] for p in own), digest))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "x", 1) for r in ROWS], DOCUMENTS + ", pair string, shard int").repartition(3)


@pytest.fixture(scope="module")
def expected():
    return brute_force(ROWS)


def rows_of(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_against_whole_texts(docs, expected):
    df = alignment.alignments(docs)
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows_of(df) == expected


def test_beyond_the_limit_and_many_shards(docs, expected, monkeypatch):
    monkeypatch.setattr(alignment, "SHARD", 40)
    monkeypatch.setattr(alignment, "WINDOW", 20)
    assert rows_of(alignment.alignments(docs)) == expected
    assert rows_of(alignment.alignments(docs, limit=0)) == expected


def test_empty_table(spark):
    none = spark.createDataFrame([], DOCUMENTS)
    assert rows_of(alignment.alignments(none)) == []
    assert rows_of(alignment.alignments(none, limit=-1)) == []


def test_no_text_has_tokens(spark):
    rows = [(1, None), (2, ""), (3, "▁")]
    assert rows_of(alignment.alignments(spark.createDataFrame(rows, DOCUMENTS))) == brute_force(rows)


def test_given_texts(spark):
    """Parts aligned one by one against whole texts."""
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60)
    rows = [tuple(r) for r in table.collect()]
    assert rows_of(alignment.alignments(spark.createDataFrame(rows, DOCUMENTS))) == brute_force(rows)


def test_counts_by_pair(docs):
    tokens = alignment.tokenised(docs, alignment.vocabulary_paths())
    counts = Counter()
    for _, text in ROWS:
        ids_a, ids_b, ends_a, ends_b = whole(text or "")
        counts.update((a, b) for a, i in zip(ids_a, ends_a) for b, j in zip(ids_b, ends_b) if i == j)
    assert {(r["a"], r["b"]): r["n"] for r in alignment.pairs_of(alignment.pair_counts(tokens)).collect()} == counts


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash(n):
    keys = np.random.default_rng(n).choice(1 << 31, n, replace=False).astype(np.int64)
    function = alignment.PerfectHash.from_bytes(*alignment.PerfectHash.of(keys).to_bytes())
    assert sorted(function.verified(keys).tolist()) == list(range(n))
    others = np.setdiff1d(np.arange(2000), keys)
    assert (function.verified(others) == -1).all()


def test_groups(docs):
    shown = {r["doc_id"]: r["groups"] for r in alignment.groups(docs).collect()}
    digests = {r["doc_id"]: r["groups_sha256"] for r in alignment.alignments(docs).collect()}
    assert {d: hashlib.sha256(g.encode()).hexdigest() if g else "" for d, g in shown.items()} == digests
