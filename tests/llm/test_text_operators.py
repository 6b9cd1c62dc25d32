"""The text operators against brute force and hand-made cases."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from widefold.llm import (
    components,
    decontaminate,
    exact_dedup,
    html_blocks,
    html_extract,
    language_id,
    licenses,
    line_dedup,
    packing,
    quotations,
    secrets,
    simhash,
    tokens,
)

SF = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i}" for i in range(30_000))
#: Nulls in every column, empty, repeated and very long rows.
ODD = [
    (None, None, None, None, None), (1, None, None, None, 0), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 4),
    (4, "one two three four five six", "en", "a", 27), (4, "one two three four five six", "en", "a", 27),
    (5, "one two three four five six", None, None, 27), (6, LONG, "en", "b", len(LONG)), (None, "no id here", "en", None, 10),
    (7, "é ñ 漢字 <|endoftext|> '' 's x", "fr", "c", 5),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCUMENTS)


@pytest.fixture(scope="module")
def clashing(odd):
    """Extra columns with the names that operators use inside."""
    names = ["row_key", "hash", "print", "row", "file", "n", "text_sha256", "cut", "lang_pred", "length", "root"]
    return odd.select("*", *[F.lit("x").alias(n) for n in names])


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")


@pytest.fixture(scope="module")
def language_model(documents):
    return language_id.train(documents)


# ---- exact dedup ---------------------------------------------------------------------------------


def taken_in(spark, tmp_path, rows, digest=exact_dedup.digest_of):
    path, state = str(tmp_path / "docs.parquet"), str(tmp_path / "state")
    spark.createDataFrame(rows, DOCUMENTS).repartition(3).write.parquet(path)
    exact_dedup.ingest(spark, path, state, digest)
    return exact_dedup.exact_groups(spark.read.parquet(path), state, digest).toPandas()


def test_exact_groups(spark, tmp_path):
    out = taken_in(spark, tmp_path, ODD)
    assert len(out) == len(ODD)
    by_text = defaultdict(list)
    for doc_id, text, *_ in ODD:
        by_text[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    for text, ids in by_text.items():
        rows = out[out.text_sha256 == hashlib.sha256(text.encode()).hexdigest()]
        known = [i for i in ids if i is not None]
        assert (rows.group_size == len(ids)).all() and rows.kept.sum() == 1
        assert rows.keep_id.isna().all() if not known else (rows.keep_id == min(known)).all()


def test_texts_with_one_digest_are_told_apart(spark, tmp_path):
    rows = [(i, f"text {i % 7}", "en", "a", 6) for i in range(60)]
    out = taken_in(spark, tmp_path, rows, digest=lambda text: F.substring(F.sha2(text, 256), 1, 1))
    assert (out.keep_id == out.doc_id % 7).all()
    assert out.kept.sum() == 7


def test_state_goes_on(spark, tmp_path):
    path, state = str(tmp_path / "docs.parquet"), str(tmp_path / "state")
    for part in (["a", "b"], ["b", "c"]):
        rows = [(i + 10 * (part[0] == "b"), t, "en", "a", 1) for i, t in enumerate(part)]
        spark.createDataFrame(rows, DOCUMENTS).coalesce(1).write.mode("append").parquet(path)
        exact_dedup.ingest(spark, path, state)
    out = exact_dedup.exact_groups(spark.read.parquet(path), state).toPandas().set_index("doc_id")
    assert out.keep_id.to_dict() == {0: 0, 1: 1, 10: 1, 11: 11}
    assert out.group_size.to_dict() == {0: 1, 1: 2, 10: 2, 11: 1}


# ---- line dedup ----------------------------------------------------------------------------------


def chunks_of(text):
    lines = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) % line_dedup.PRIME for x in lines]
    marks = [((h[i - 1] if i else 0) * line_dedup.BASE + h[i]) % line_dedup.PRIME % line_dedup.DIVISOR == 0 for i in range(len(h))]
    ends = [i + 1 for i in range(len(h)) if marks[i] and not (i and marks[i - 1])]
    starts = [0, *[e for e in ends if e < len(lines)], len(lines)]
    return [(a, lines[a:b]) for a, b in zip(starts, starts[1:], strict=False)]


def test_line_dedup_against_brute_force(spark, documents):
    rows = sorted((r.doc_id, r.text) for r in documents.collect())
    seen, expected = set(), {}
    for doc_id, text in rows:
        kept = []
        for _, chunk in chunks_of(text):
            if len(chunk) >= 2 and tuple(chunk) in seen:
                continue
            if len(chunk) >= 2:
                seen.add(tuple(chunk))
            kept += chunk
        expected[doc_id] = "\n".join(kept)
    out = line_dedup.dedup_lines(documents).toPandas()
    assert out.set_index("doc_id").text.to_dict() == expected
    assert out.n_removed.sum() > 0


def test_boundaries_resist_shifts(spark):
    block = [f"shared line {i} of the block" for i in range(60)]
    texts = ["\n".join(block), "\n".join(["own line", *block[:30], "put in", *block[30:], "end"])]
    df = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], DOCUMENTS)
    out = line_dedup.dedup_lines(df).toPandas().set_index("doc_id")
    assert out.n_removed[0] == 0 and out.n_removed[1] >= 35
    assert {"own line", "put in", "end"} <= set(out.text[1].split("\n"))


def test_line_dedup_plan_is_native(documents):
    plan = line_dedup.dedup_lines(documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---- packing -------------------------------------------------------------------------------------


def test_ids_are_the_tokenizers(spark, documents):
    from tokenizers import Tokenizer

    path = packing.vocabulary_path()
    tokenizer = Tokenizer.from_file(path)
    cases = [t or "" for _, t, *_ in ODD] + [r.text for r in documents.limit(60).collect()]
    cases += ["  two  spaces ", "it's they'll 'tis", "a\n\n b\r\n\tc", "x" * 5000, "²½ 12³", "\x1cq", "naïve_name__x", "a <|endoftext|> b"]
    for text in cases:
        ids = np.frombuffer(tokens.token_bytes(text, path), "<u4").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids, text[:50]
    assert 50256 in np.frombuffer(tokens.token_bytes("a <|endoftext|> b", path), "<u4")


def test_windows_do_not_change_ids(monkeypatch):
    text = " ".join(f"word{i}, and  {i}" for i in range(3000))
    path = packing.vocabulary_path()
    whole = tokens.token_bytes(text, path)
    monkeypatch.setattr(tokens, "WINDOW", 100)
    assert tokens.token_bytes(text, path) == whole


def check_packing(out, texts, capacity):
    path = packing.vocabulary_path()
    expected = []
    for doc_id, text in texts:
        ids = tokens.token_bytes(text or "", path) + bytes(4)
        total = len(ids) // 4
        first = total if total <= capacity else total - capacity * ((total - 1) // capacity)
        bounds = [0, *range(first, total + 1, capacity)]
        for piece, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
            expected.append((doc_id, piece, a, b - a, zlib.crc32(ids[4 * a : 4 * b])))
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = sorted((tuple(None if pd.isna(v) else v for v in r) for r in out[key].itertuples(index=False)), key=str)
    assert got == sorted(expected, key=str)
    placed = out.sort_values(["sequence_id", "offset"])
    before = (placed.offset + placed.length).groupby(placed.sequence_id).shift(fill_value=0)
    assert (before == placed.offset).all()
    assert placed.groupby("sequence_id").length.sum().max() <= capacity


def test_packing(spark, documents):
    out = packing.pack(documents).toPandas()
    check_packing(out, [(r.doc_id, r.text) for r in documents.collect()], 2048)
    assert out.sequence_id.nunique() <= -(-out.length.sum() // 2048) + 1


def test_packing_of_odd_rows(odd, empty):
    out = packing.pack(odd).toPandas()
    check_packing(out, [(r[0], r[1]) for r in ODD], 2048)
    assert packing.pack(empty).count() == 0


def test_plan_uses_up_the_histogram():
    chance = np.random.default_rng(5)
    for counts in (chance.integers(0, 50, 65), np.bincount([40] * 100, minlength=65), np.zeros(65, int)):
        counts[0] = 0
        plan = packing.pack_histogram(counts, 64)
        used = np.zeros(65, int)
        for lengths, n in plan:
            assert sum(lengths) <= 64
            np.add.at(used, list(lengths), n)
        assert (used == counts).all()
        assert sum(n for _, n in plan) <= sum(n for _, n in packing.best_fit(counts, 64))


def test_least_squares_uses_patterns_that_fit_exactly():
    counts = np.bincount([10] * 30 + [22] * 30, minlength=33)
    patterns = packing.enumerate_patterns(counts > 0, 32)
    repeats = packing.fit_repeats(patterns, counts.astype(float), rounds=500)
    assert {tuple(p): round(r) for p, r in zip(patterns.lengths, repeats, strict=True)}[22, 10, 0] == 30


def test_patterns_are_all_that_fit():
    present = np.isin(np.arange(25), [2, 3, 5, 8, 11, 24])
    for spare in (0, 2):
        found = packing.enumerate_patterns(present, 24, spare)
        rows = [tuple(sorted((a, t) for a, t in zip(p, n, strict=True) if t)) for p, n in zip(found.lengths, found.times, strict=True)]
        got = {tuple(sorted(a for a, t in r for _ in range(t))) for r in rows}
        lengths = np.flatnonzero(present).tolist()
        exact = {tuple(sorted(x for x in (a, b, c) if x)) for a in lengths for b in [0, *lengths] for c in [0, *lengths] if a + b + c == 24}
        # Of two lengths the shorter one fills what the repeats of the longer one leave.
        repeated = set()
        for a in lengths:
            for i in range(1, 24 // a + 1):
                repeated |= {(a,) * i} if 24 - i * a <= spare and i > 1 else set()
                for b in [x for x in lengths if x < a]:
                    j = (24 - i * a) // b
                    if j and 24 - i * a - j * b <= spare and (i > 1 or j > 1):
                        repeated.add(tuple(sorted([a] * i + [b] * j)))
        assert got == exact | repeated


def patterned(plan):
    return sum(n for lengths, n in plan if len(lengths) > 1)


def test_patterns_do_the_packing():
    """Over half of all sequences hold several pieces and come from patterns, with no more than best fit needs."""
    documents = duckdb.sql("SELECT text FROM '/root/testdata/sf0.1/documents.parquet'").fetchall()
    path, counts = packing.vocabulary_path(), np.zeros(2049, np.int64)
    for (text,) in documents:
        n = len(tokens.token_bytes(text or "", path)) // 4 + 1
        counts[n % 2048] += n % 2048 > 0
        counts[2048] += n // 2048
    short = np.bincount(np.random.default_rng(1).integers(20, 600, 20_000), minlength=2049)
    for histogram in (counts, short):
        plan = packing.pack_histogram(histogram)
        total, bound = sum(n for _, n in plan), -(-int((histogram * np.arange(2049)).sum()) // 2048)
        assert total == bound
        kept = next(k for step in range(packing.GIVEN_BACK) if (k := packing.given_back(packing.fitted_part(histogram)[0], packing.GIVEN_BACK, step)) == plan[: len(k)])
        assert 2 * patterned(kept) > total


def test_given_back_is_even():
    plan = [((5, 3), 7), ((8,), 4), ((4, 4), 90), ((2, 6), 3)]
    for step in range(20):
        kept = packing.given_back(plan, 20, step)
        assert patterned(kept) == 100 - 5 * step and ((8,), 4) in kept


def test_numbers_run_on_over_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "NUMBERED_TOGETHER", 7)
    df = spark.range(200).select(F.col("id").alias("row"), (F.col("id") % 3 + 1).alias("length"))
    counts = {r["length"]: r["count"] for r in df.groupBy("length").count().collect()}
    out = packing.numbered(df, counts).toPandas()
    assert all(sorted(g.number) == list(range(len(g))) for _, g in out.groupby("length"))


# ---- decontamination -----------------------------------------------------------------------------


def brute_tiles(item, text, least):
    """Greedy string tiling by comparing all places."""
    used_a, used_b, covered = [False] * len(item), [False] * len(text), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n] and not used_a[i + n] and not used_b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return covered
        used_a[i : i + n], used_b[j : j + n] = [True] * n, [True] * n
        covered += n


def test_tiles_against_brute_force():
    chance = random.Random(2)
    for _ in range(60):
        item = [chance.choice("abcde") for _ in range(chance.randint(5, 30))]
        text = [chance.choice("abcde") for _ in range(10)] + item[10:] + [None] + item[:10] + [chance.choice("abc")] * 3
        found = decontaminate.tiles(item, text, 3)
        for i, j, n in found:
            assert item[i : i + n] == text[j : j + n]
        for k in range(2):  # no overlaps
            taken = [p for t in found for p in range(t[k], t[k] + t[2])]
            assert len(taken) == len(set(taken))
        assert max((n for *_, n in found), default=0) >= 3
        assert abs(sum(n for *_, n in found) - brute_tiles(item, text, 3)) <= 6


def test_contaminated_against_brute_force(documents, benchmark):
    docs, items = documents.collect(), benchmark.collect()
    expected = set()
    for d in docs:
        words = decontaminate.words_of(d.text)
        joined = f" {' '.join(words)} "
        for item in items:
            w = decontaminate.words_of(item.text)
            if any(f" {' '.join(w[i : i + 5])} " in joined for i in range(len(w) - 4)) and (
                sum(n for *_, n in decontaminate.tiles(w, words, 5)) >= 0.6 * len(w)
            ):
                expected.add((d.doc_id, item.item_id))
    out = decontaminate.contaminated(documents, benchmark).toPandas()
    assert set(zip(out.doc_id, out.item_id, strict=True)) == expected
    assert expected


def test_reordered_passages_are_found(spark):
    item = "the quick brown fox jumps over the lazy dog while seven wise owls watch from the tall old oak"
    words = item.split()
    moved = " ".join([*words[10:], "and", *words[:10]])
    half = " ".join(words[:8])
    rows = [(1, moved, "en", "a", 1), (2, half, "en", "a", 1), (3, item.upper() + "!", "en", "a", 1), (4, moved * 300, "en", "a", 1)]
    docs = spark.createDataFrame([*rows, *ODD], DOCUMENTS)
    items = spark.createDataFrame([(9, item), (8, item), (7, None), (6, ""), (5, "too short"), (None, None)], "item_id long, text string")
    out = decontaminate.contaminated(docs, items).toPandas()
    assert sorted(zip(out.doc_id, out.item_id, strict=True)) == [(1, 8), (3, 8), (4, 8)]
    assert decontaminate.keep_clean(docs, items).count() == len(rows) + len(ODD) - 3


# ---- HTML ----------------------------------------------------------------------------------------


def test_blocks():
    page = (
        "<html><head><title>T</title><script>var a='<p>x</p>';</script></head><body class='Post main'><p>A&amp;B <b>c</b>d"
        "<p>two<br>three<ul><li><a href='x>y'>l1</a><li>l2</ul><!-- no <p>n</p> --><div>1 &lt; 2</div> tail < end"
    )
    blocks = html_blocks.blocks_of(page)
    assert [b.text for b in blocks] == ["A&B cd", "two", "three", "l1", "l2", "1 < 2", "tail < end"]
    assert blocks[3].tags == ("html", "body", "ul", "li", "a") and blocks[3].link_chars == 2
    assert blocks[0].names == ("post", "main")
    assert html_blocks.blocks_of("") == [] and html_blocks.blocks_of("<p></p>") == []
    assert [b.text for b in html_blocks.blocks_of("plain")] == ["plain"]


@pytest.mark.parametrize(("page", "texts"), [
    ("<p>a</p><script>for(var i=0;i<n;i++){a(i)}</script><p>b</p>", ["a", "b"]),
    ("<script>var s='<!--';</SCRIPT ><p>b</p><!-- c --><p>d</p>", ["b", "d"]),
    ("<script><!-- w('<script>x</script>') --></script><p>b</p>", ["b"]),
    ("<style>a>b{content:'<!--'}</style><p>b</p>", ["b"]),
    ("<p>a</p><textarea>i<n <!-- \"</textarea><p>b</p>", ["a", "b"]),
    ("<title>a <b & <!-- c</title><p>b</p>", ["b"]),
    ("<template><script>'</template>'</script>t</template><p>b</p>", ["b"]),
    ("<svg><g/><svg/></svg><p>b</p>", ["b"]),
    ("<html><head><meta charset=x><title>T</title><p>b</p>", ["b"]),
    ("<head><title>T</title><link rel=x><article>b<p>c</article>", ["b", "c"]),
    ("<head><title>T</title><style>s</style></head>b", ["b"]),
    ("<p>a</p><script>no end <p>b</p>", ["a"]),
])
def test_raw_elements_and_open_heads(page, texts):
    blocks = html_blocks.blocks_of(page)
    assert [b.text for b in blocks] == texts
    assert all("head" not in b.tags for b in blocks)


def test_viterbi_and_marginals_against_all_labellings():
    import itertools

    chance = np.random.default_rng(0)
    model = html_extract.Field(chance.normal(size=html_extract.FEATURES), chance.normal(size=(2, 2)))
    features = [[int(v) for v in chance.integers(0, html_extract.FEATURES, 3)] for _ in range(6)]
    scores = model.scores(features)
    total = {
        y: sum(scores[i, v] for i, v in enumerate(y)) + sum(model.moves[a, b] for a, b in zip(y, y[1:], strict=False))
        for y in itertools.product((0, 1), repeat=6)
    }
    assert tuple(model.decode(features)) == max(total, key=total.get)
    z = np.logaddexp.reduce(list(total.values()))
    chances, moves = html_extract.marginals(scores, model.moves)
    for i in range(6):
        assert np.isclose(chances[i, 1], sum(np.exp(s - z) for y, s in total.items() if y[i]))
    assert np.isclose(moves[0, 1], sum(np.exp(s - z) * list(zip(y, y[1:], strict=False)).count((0, 1)) for y, s in total.items()))


def test_extraction(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    model = html_extract.train(pages)
    out = {r.page_id: r for r in html_extract.extract(pages, model).collect()}
    for r in pages.collect():
        blocks = html_blocks.blocks_of(r.html)
        assert out[r.page_id].text == " ".join(b.text for b in blocks if "article" in b.tags)
        assert out[r.page_id].n_chars == len(out[r.page_id].text)
    # Held-out layouts: none of these pages were learned from.
    chance = random.Random(77)
    right = total = 0
    for r in pages.collect()[:40]:
        blocks = html_blocks.blocks_of(r.html)
        anew = html_blocks.blocks_of(html_extract.laid_out(blocks, html_extract.told_by_elements(blocks), chance))
        got = model.decode(html_extract.features_of(anew))
        right += sum(a == b.marked for a, b in zip(got, anew, strict=True))
        total += len(anew)
    assert right / total > 0.95


def test_extraction_of_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (None, None, None), (3, "u", "<p>" * 3000), (3, "u", "<p>" * 3000), (4, "u", "<div class='")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = html_extract.extract(pages, html_extract.train(pages)).toPandas()
    assert len(out) == len(rows) and (out[out.page_id != 4].text == "").all()
    assert html_extract.extract(pages.limit(0), html_extract.train(pages.limit(0))).count() == 0


def test_rare_labelled_pages_are_drawn(spark):
    rows = [(f"<p>plain {i}</p>" if i % 50 else f"<nav>n</nav><Article>a{i}</Article>",) for i in range(1000)]
    rows += [(f"<article>nothing besides {i}</article>",) for i in range(100)]
    pages = spark.createDataFrame(rows, "html string").repartition(4)
    for n in (5, 20):
        drawn = html_extract.draw(pages, n, 2)
        assert len(set(drawn)) == n and all("<nav>" in h for h in drawn)
    with pytest.warns(UserWarning, match="only 20 of 30"):
        assert html_extract.train(pages, 30).weights.any()


def test_digits_count_over_the_whole_block():
    block = html_blocks.Block("a" * 200 + "1" * 600, (), (), 0, False)
    assert "digits 3" in set(html_extract.described(block, 0, 1))


# ---- quotations ----------------------------------------------------------------------------------

MESSAGES = [
    (1, 0, "user", "Hello there friends\nhow do I pack things?"), (1, 1, "a", "> how do I  pack things?\nUse best fit."),
    (1, 2, "user", "On Monday A wrote:\n>> how do I pack things?\n> Use best fit.\nThanks!"),
    (1, 3, "a", "> hello there FRIENDS\nHi."), (2, 0, "u", "> Use best fit.\nReally?"), (2, 1, "u", None), (3, 0, "u", ""),
    (3, 0, "u", ""), (None, None, "x", "> nothing known"), (4, 5, None, "> Thanks!\n> Hi."),
]


def test_quotations(spark):
    messages = spark.createDataFrame(MESSAGES, "conv_id long, turn long, role string, text string")
    out = quotations.linked(messages.withColumn("hash", F.lit(1))).toPandas()
    got = {(r.conv_id, r.turn): (r.reply_conv, r.reply_turn, r.depth, r.text) for r in out.itertuples() if r.conv_id in (1, 2)}
    assert got[1, 1] == (1, 0, 1, "Use best fit.")
    assert got[1, 2] == (1, 1, 2, "Thanks!")
    assert got[1, 3] == (1, 0, 1, "Hi.")
    assert got[2, 0] == (1, 1, 1, "Really?")
    assert got[2, 1][:2] == (2, 0)
    assert len(out) == len(MESSAGES)
    whole = {r.conv_id: [m.turn for m in r.messages] for r in quotations.conversations(messages).collect()}
    assert whole[1] == [0, 1, 3, 2]
    assert quotations.linked(messages.limit(0)).count() == 0


def test_quotations_against_sql(spark, tmp_path):
    messages = spark.createDataFrame(MESSAGES, "conv_id long, turn long, role string, text string")
    messages.write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    expected = con.sql(quotations.ORACLE_SQL).fetchall()
    columns = [d[0] for d in con.execute(quotations.ORACLE_SQL).description]
    out = [tuple(r) for r in quotations.query(spark, str(tmp_path)).select(columns).collect()]
    assert sorted(out, key=str) == sorted(expected, key=str)


def replies(spark, rows):
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return {(r.conv_id, r.turn): (r.reply_conv, r.reply_turn) for r in quotations.linked(messages).collect()}


def test_whole_passages_come_before_lines(spark):
    got = replies(spark, [
        (1, 0, "a", "x\ny"), (1, 1, "b", "x\n\ny\nz"), (1, 2, "a", "> x\n> y\n>\n> z\nagreed"), (1, 3, "b", "> y\n> z\nclipped"),
        (2, 0, "a", "x"), (3, 0, "a", "y\nz"), (4, 0, "a", "> Y\n> z\nfrom elsewhere"), (5, 0, "a", "> q\nlater"), (5, 1, "a", "q"),
        (6, 0, "a", "q"),
    ])
    assert got[1, 2] == (1, 1)
    assert got[1, 3] == (1, 1)
    assert got[4, 0] == (3, 0)
    # The first message over all that said it is a later one of the same conversation.
    assert got[5, 0] == (6, 0)


def plain_replies(rows):
    """The rules, message by message."""
    own, quoted = {}, {}
    for conv, turn, _, text in rows:
        runs = []
        for line in text.split("\n"):
            marks = re.match(r"[> ]*", line)[0]
            if said := line[len(marks):].strip().lower():
                level = marks.count(">")
                if not runs or runs[-1][0] != level:
                    runs.append((level, []))
                runs[-1][1].append(said)
        own[conv, turn] = [tuple(r) for level, r in runs if level == 0]
        quoted[conv, turn] = [(level, tuple(r)) for level, r in runs if level]
    by_run, by_line = {}, {}
    for at in sorted(own):
        for run in own[at]:
            by_run.setdefault(run, []).append(at)
            for line in set(run):
                if at not in by_line.setdefault(line, []):
                    by_line[line].append(at)

    out = {}
    for at, passages in quoted.items():
        votes = {}

        def vote(level, source, first):
            seen = votes.setdefault((-level, source), [0, 0])
            seen[0] += 1
            seen[1] += first

        def split(sayers):
            return [s for s in sayers if s[0] == at[0] and s < at], [s for s in sayers if s[0] != at[0]]

        for level, run in passages:
            near, far = split(by_run.get(run, []))
            for line in run:
                line_near, line_far = split(by_line.get(line, []))
                if near:
                    vote(level, near[0], 1)
                elif line_near:
                    for i, source in enumerate(line_near):
                        vote(level, source, i == 0)
                elif far or line_far:
                    vote(level, (far or line_far)[0], 1)
        before = max((a for a in own if a[0] == at[0] and a < at), default=(None, None))
        out[at] = max(((*k[:1], *n, k[1][1], k[1][0]) for k, n in votes.items()), default=None)
        out[at] = (out[at][4], out[at][3]) if out[at] else before
    return out


def test_quotations_against_brute_force(spark):
    pick = random.Random(5)
    words = [f"line {i}" for i in range(25)] + ["yes."] * 10
    rows, said = [], []
    for conv in range(60):
        for turn in range(12):
            lines = []
            for _ in range(pick.randint(0, 2)):
                whole = pick.choice(said if said and pick.random() < 0.3 else [s for c, s in said if c == conv] and said[-turn or None:] or [(0, ["none"])])[1]
                part = whole if pick.random() < 0.5 else whole[pick.randint(0, len(whole) - 1):]
                lines += [">" * pick.choice([1, 1, 1, 2]) + " " + x.upper() for x in part]
            mine = [pick.choice(words) for _ in range(pick.randint(1, 4))]
            said.append((conv, mine))
            rows.append((conv, turn, "u", "\n".join([*lines, *mine])))
    expected = plain_replies(rows)
    assert replies(spark, rows) == expected
    assert sum(e[0] is not None and e != (c, t - 1) for (c, t), e in expected.items()) > 200


def test_turns_run_on_over_groups(spark, monkeypatch):
    monkeypatch.setattr(quotations, "TURNS_PER_GROUP", 4)
    rows = spark.createDataFrame([(1, t) for t in (0, 1, 2, 9, 10, 30)] + [(2, 7)], "conv_id long, turn long")
    out = {(r.conv_id, r.turn): r.before for r in quotations.turns_before(rows).collect()}
    assert out == {(1, 0): None, (1, 1): 0, (1, 2): 1, (1, 9): 2, (1, 10): 9, (1, 30): 10, (2, 7): None}


# ---- secrets -------------------------------------------------------------------------------------


def base_spans(text):
    assign = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A)
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def test_secrets_against_brute_force(spark, documents):
    chance = random.Random(3)
    made = [
        (900, "é password: token: abcdefgh12 x", None, None, 1), (901, "API_KEY='" + "Zz9+" * 5 + "' AKIA" + "Q1" * 8 + "AKIAshort", None, None, 1),
        (902, "𝒳 " + "0123456789abcdef" * 3 + " secret=short secret=longenough", None, None, 1),
        (903, "ſecret=abcdefgh12 toKen=abcdefgh12", None, None, 1),
        (904, "key " + "".join(chance.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(40)), None, None, 1),
    ]
    docs = documents.unionByName(spark.createDataFrame([*made, *ODD], DOCUMENTS))
    out = secrets.scan(docs, secrets.train(documents)).toPandas()
    assert len(out) == docs.count()
    texts = defaultdict(list)
    for r in docs.collect():
        spans = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in base_spans(r.text or ""))
        texts[str(r.doc_id)].append(hashlib.sha256(spans.encode()).hexdigest())
    for r in out.itertuples():
        assert r.base_sha256 in texts[str(None if pd.isna(r.doc_id) else int(r.doc_id))]
    at = out.set_index("doc_id")
    assert at.n_random[904] == 1 and at.spans[904] == "random:4:44"
    assert at.n_assign.sum() > 2 and out.n_random.sum() <= 3


def test_secret_plan_is_native(documents):
    plan = secrets.scan(documents, secrets.train(documents))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---- language ID ---------------------------------------------------------------------------------


def test_language_on_held_out_rows(documents, language_model):
    out = language_id.identify(documents, language_model).toPandas().merge(documents.select("doc_id", "lang").toPandas())
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in out.doc_id]).all()
    told = out[out.held_out]
    assert (told.lang == told.lang_pred).mean() > 0.95
    assert out.score.between(0, 1).all()


def test_language_of_odd_rows(odd, empty, language_model):
    out = language_id.identify(odd, language_model).toPandas()
    assert len(out) == len(ODD)
    for r, (_, text, *_) in zip(out.itertuples(), ODD, strict=True):
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text or ""))
    nothing = language_id.train(empty)
    assert language_id.identify(odd, nothing).toPandas().lang_pred.eq("und").all()
    assert language_id.keep_identified(odd, language_model).columns == odd.columns


def test_counts_do_not_depend_on_windows(monkeypatch):
    text = " ".join(f"Wört{i}" for i in range(500))
    whole = language_id.ngram_counts(text)
    monkeypatch.setattr(language_id, "WINDOW", 37)
    assert (language_id.ngram_counts(text) == whole).all()


# ---- licences ------------------------------------------------------------------------------------


def test_longest_rising_part_against_brute_force():
    import itertools

    chance = random.Random(4)
    for _ in range(40):
        ys = chance.sample(range(20), 8)
        pairs = list(enumerate(ys))
        best = max(len(c) for n in range(9) for c in itertools.combinations(ys, n) if list(c) == sorted(c))
        chain = licenses.rising(pairs)
        assert len(chain) == best and chain == sorted(chain) and [y for _, y in chain] == sorted(y for _, y in chain)


def test_licences(spark, clashing):
    notice = "Released under the MIT License."
    full = licenses.TEMPLATES["MIT"]
    words = full.split()
    changed = " ".join(w for i, w in enumerate(words) if i % 9 != 4)
    filler = " ".join(f"the under license w{i}" for i in range(500))
    rows = [
        (1, f"{filler} {notice} {filler} released UNDER the  MIT license", None, None, 1), (2, f"{filler} {changed} {filler}", None, None, 1),
        (3, filler, None, None, 1), (4, " ".join(reversed(words)), None, None, 1), (5, full + " " + full, None, None, 1),
    ]
    out = licenses.scan(spark.createDataFrame(rows, DOCUMENTS)).toPandas()
    by_doc = out.groupby("doc_id").license.apply(list).to_dict()
    assert by_doc == {1: ["MIT notice"] * 2, 2: ["MIT"], 5: ["MIT"] * 2}
    assert out[out.doc_id == 2].anchors.iloc[0] > 20
    assert licenses.scan(clashing).count() == 0


def licences_of(text):
    words = licenses.words_of(text)
    found = [f for k, v in licenses.TEMPLATES.items() for f in licenses.find(words, licenses.Template.of(k, v))]
    return [f.template for f in licenses.best_covered(found)]


def test_each_template_is_told_from_all_others():
    assert len({k.split(" ")[0] for k in licenses.TEMPLATES}) >= 20
    for name, text in licenses.TEMPLATES.items():
        assert licences_of(f"Some words stand ahead of it: {text} And some words are behind it.") == [name]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("This is licensed under the GNU General Public License, version 2.", ["GPL-2.0 notice"]),
        ("It is licensed under the GNU Lesser General Public License, version 3", ["LGPL-3.0 notice"]),
        ("It is licensed under the GNU Affero General Public License, version 3", ["AGPL-3.0 notice"]),
        ("licensed under the GNU General Public License", []),
        ("Released under the BSD License", ["BSD notice"]),
        ("work done under the MIT License last year", []),
        ("Released to us under the MIT License", ["MIT notice"]),
        ("Licensed under CC BY-SA 4.0", ["CC-BY-SA-4.0 notice"]),
        ("Licensed under CC BY 3.0", ["CC-BY-3.0 notice"]),
        ("Licensed under CC BY-NC-SA 4.0 and CC BY-NC-ND 4.0", ["CC-BY-NC-SA-4.0 notice"]),
        ("Licensed under the Apache License, Version 1.1", []),
        ("licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License", ["CC-BY-SA-3.0 long notice"]),
    ],
)
def test_look_alikes(text, expected):
    assert licences_of(text) == expected


def test_gnu_headers_and_bsd_texts_with_changes():
    """Every ninth word changed, but for those that tell the licences apart."""
    for name in ("GPL-2.0 header", "LGPL-2.1 header", "AGPL-3.0 header", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Zlib"):
        template = licenses.Template.of(name, licenses.TEMPLATES[name])
        words = [w if i in template.telling or i % 9 != 4 else "changed" for i, w in enumerate(template.words)]
        assert licences_of(" ".join(words)) == [name]


def test_alignment_against_brute_force():
    """Aligned places rise in both and hold equal words; without repeated words as many as can be are aligned."""
    chance = random.Random(15)
    for n in range(60):
        letters = [f"w{i}" for i in range(9 if n % 2 else 40)]
        a, b = chance.choices(letters, k=8) if n % 2 else chance.sample(letters, 12), chance.sample(letters, 9)
        matched, _ = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in matched)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(matched, matched[1:], strict=False))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert len(matched) <= table[-1][-1]
        if len(set(a)) == len(a):
            assert len(matched) == table[-1][-1]


# ---- SimHash -------------------------------------------------------------------------------------


def brute_print(text, size=4):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text)) if w]
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints):
    root = {p: p for p in prints}

    def top(p):
        while root[p] != p:
            p = root[p]
        return p

    ordered = sorted(root)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1 :]:
            if (a ^ b).bit_count() <= 4:
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {p: top(p) for p in ordered}


def test_simhash_against_brute_force(spark, documents, clashing):
    docs = documents.unionByName(clashing.select(documents.columns))
    rows = [(r.doc_id, brute_print(r.text or "")) for r in docs.collect()]
    groups = brute_groups({p for _, p in rows})
    least = {}
    for doc_id, p in rows:
        if doc_id is not None:
            least[groups[p]] = min(doc_id, least.get(groups[p], doc_id))
    expected = sorted((str(i), f"{p:016x}", least.get(groups[p])) for i, p in rows)
    out = simhash.near_groups(docs).collect()
    got = sorted((str(r.doc_id), f"{r.print % (1 << 64):016x}", r.component_id) for r in out)
    assert got == expected


def copies_of(chance, n, length, edits):
    """Texts of random words, each followed by a copy with some words replaced."""
    for _ in range(n):
        words = [f"w{chance.randrange(5000)}" for _ in range(length)]
        yield " ".join(words)
        for at in chance.sample(range(length), edits):
            words[at] = "new"
        yield " ".join(words)


def test_near_dedup_keeps_the_first_of_each_component(spark):
    chance = random.Random(12)
    texts = [t for length in (60, 300) for edits in (0, 1, 2, 9) for t in copies_of(chance, 8, length, edits)]
    texts += ["", " ", "a b", "A  b", "a b c", None]
    prints = [brute_print(t or "") for t in texts]
    groups = brute_groups(set(prints))
    first = {}
    for i, p in enumerate(prints):
        first.setdefault(groups[p], i)
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate(texts)], DOCUMENTS)
    kept = corpus_pipeline.without_near_duplicates(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(first.values())
    assert len(texts) - 40 < len(first) < len(texts) - 15


def test_unlike_texts_of_null_or_repeated_ids_are_kept(spark):
    chance = random.Random(3)
    texts = [" ".join(f"w{chance.randrange(5000)}" for _ in range(100)) for _ in range(7)]
    ids = [None, None, None, 5, 5, 6, None]
    rows = [(i, t, "en", "a", len(t)) for i, t in zip(ids, texts, strict=True)]
    rows += [rows[0], (9, texts[1], "en", "a", 0), (4, texts[3], "en", "a", 0)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    kept = corpus_pipeline.without_near_duplicates(spark, docs, SF)
    expected = zip([None, 9, None, 4, 5, 6, None], texts, strict=True)
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=str) == sorted(expected, key=str)


def test_shingles_meet_sparks_hash(spark):
    text = "Ünï one\ttwo\vTHREE four"
    words = "Ünï one two three four".split()
    expected = [spark.range(1).select(F.xxhash64(F.lit(" ".join(words[i : i + 4])))).first()[0] for i in range(2)]
    assert np.concatenate(list(simhash.shingle_hashes(text, 4))).astype(np.int64).tolist() == expected


def test_masks_cover_every_near_pair():
    masks = [m % (1 << 64) for m in simhash.covering_masks(4)]
    assert len(masks) == 31
    chance = random.Random(6)
    for _ in range(3000):
        x = chance.getrandbits(64)
        y = x
        for bit in chance.sample(range(64), chance.randint(0, 4)):
            y ^= 1 << bit
        assert any(x & m == y & m for m in masks)


def test_large_buckets_are_dealt_out(spark):
    chance = random.Random(8)
    centre = chance.getrandbits(63)
    prints = {centre}
    while len(prints) < 300:
        y = chance.choice(sorted(prints)[:50])
        for bit in chance.sample(range(63), 3):
            y ^= 1 << bit
        prints.add(y)
    df = spark.createDataFrame([(p,) for p in prints], "print long")
    expected = {p: r for p, r in brute_groups(prints).items() if p != r}
    for block in (16, 1000):
        links = simhash.near_links(df, rows_per_block=block)
        got = {r.node: r.root for r in components.components(links).collect()}
        assert got == expected


def test_components_of_a_long_chain(spark):
    chance = random.Random(9)
    order = chance.sample(range(1000), 200)
    links = spark.createDataFrame([*zip(order, order[1:], strict=False), (5000, 5001), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components.components(links).collect()}
    assert got == {n: min(order) for n in order if n != min(order)} | {5001: 5000}
    assert components.components(links.limit(0)).count() == 0


# ---- all of them, and the pipeline ---------------------------------------------------------------


def test_odd_rows_and_clashing_names(clashing, empty, benchmark, language_model):
    for df, n in ((clashing, len(ODD)), (empty, 0)):
        assert line_dedup.dedup_lines(df).count() == n
        assert language_id.identify(df, language_model).count() == n
        assert secrets.scan(df, secrets.train(df)).count() == n
        assert simhash.near_groups(df).count() == n
        assert decontaminate.contaminated(df, benchmark).count() == 0
        assert decontaminate.keep_clean(df, benchmark).count() == n
        assert decontaminate.keep_clean(df, benchmark.limit(0)).count() == n


def test_pipeline(spark, documents):
    docs = documents
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == documents.columns, name
        kept[name] = docs.count()
    assert documents.count() >= kept["language_id"] >= kept["line_dedup"] >= kept["near_dedup"] > kept["decontamination"] > 0
    out = corpus_pipeline.run(spark, SF).toPandas()
    check_packing(out, [(r.doc_id, r.text) for r in docs.collect()], 2048)
