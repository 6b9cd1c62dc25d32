"""Benchmark decontamination by greedy string tiling.

Texts are compared as lower-case words. A document and an item become a pair where they share a seed, a
run of MIN_MATCH words. In each pair, running Karp-Rabin finds the longest common runs; the longest that
do not overlap are marked as tiles, and the search goes on with shorter ones down to MIN_MATCH words. An
item is found in a document where its tiles cover at least `threshold` of its words, in any order.

Items of fewer than MIN_MATCH words, empty and null ones are never found. Items with equal words are one
item, named by the least item_id. Null text is empty. Rows that agree in doc_id and text are one
document. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from widefold.llm.common import as_struct, read_table, row_key, same, whole_text

MIN_MATCH = 5
THRESHOLD = 0.6
#: Search length to begin with.
FIRST_LENGTH = 20
#: Size of the filter that drops most of a document's seeds before the join. It is fixed, whatever the benchmark.
FILTER_BITS = 24
CACHED_WORDS = 300_000
WORDS = re.compile(r"\w+")
MODULUS = (1 << 61) - 1
BASE = 1_000_003


class WordHashes(dict):
    """Hashes of words met so far; starts anew when full, so memory is bounded."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def seed_places(words: list[str], hashes: WordHashes, length: int) -> np.ndarray:
    """The place in the filter of each run of `length` words."""
    if len(words) < length:
        return np.array([], np.int64)
    values = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    mixed = np.zeros(len(words) - length + 1, np.uint64)
    for i in range(length):
        mixed = mixed * np.uint64(0x100000001B3) + values[i : len(values) - length + 1 + i]
    return ((mixed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def tiles(item: list, text: list, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in item, place in text, length), longest first. None matches nothing."""
    item_free = np.array([w is not None for w in item], bool)
    text_free = np.array([w is not None for w in text], bool)
    codes = {w: i for i, w in enumerate(dict.fromkeys([*item, *text]), 1)}
    a, b = [codes[w] for w in item], [codes[w] for w in text]
    out: list[tuple[int, int, int]] = []
    length = max(least, min(FIRST_LENGTH, len(item), len(text)))
    while True:
        matches = maximal_matches(a, b, item_free, text_free, length)
        longest = max((m[2] for m in matches), default=0)
        if longest > 2 * length:
            length = longest
            continue
        for i, j, n in sorted(matches, key=lambda m: (-m[2], m[0], m[1])):
            if item_free[i : i + n].all() and text_free[j : j + n].all():
                item_free[i : i + n] = False
                text_free[j : j + n] = False
                out.append((i, j, n))
            # Part of a run that an earlier tile cut is found again at a smaller length.
        if length == least:
            if not matches:
                return out
        else:
            length = max(least, length // 2)


def windows(codes: list[int], free: np.ndarray, length: int) -> Iterator[tuple[int, int]]:
    """(hash, place) of each window of free words, by a rolling hash."""
    power = pow(BASE, length, MODULUS)
    value = run = 0
    for i, code in enumerate(codes):
        if not free[i]:
            value = run = 0
            continue
        value = (value * BASE + code) % MODULUS
        run += 1
        if run > length:
            value = (value - codes[i - length] * power) % MODULUS
        if run >= length:
            yield value, i - length + 1


def maximal_matches(a: list[int], b: list[int], a_free, b_free, length: int) -> list[tuple[int, int, int]]:
    """Common runs of free words, of `length` words or more, that cannot be made longer."""
    places = defaultdict(list)
    for value, j in windows(b, b_free, length):
        places[value].append(j)
    found = []
    for value, i in windows(a, a_free, length):
        for j in places.get(value, ()):
            if i and j and a_free[i - 1] and b_free[j - 1] and a[i - 1] == b[j - 1]:
                continue  # inside a run that begins earlier
            n = 0
            while i + n < len(a) and j + n < len(b) and a_free[i + n] and b_free[j + n] and a[i + n] == b[j + n]:
                n += 1
            if n >= length:
                found.append((i, j, n))
    return found


def shared_runs(hits: list, least: int, useful: int) -> list:
    """The parts of a document that seeds cover, parted by None.

    Of equal parts only `useful` are taken: more copies than an item has room for tiles add nothing.
    """
    runs: list[list[str]] = []
    before = None
    for place, seed in hits:
        words = seed.split(" ")
        if before is not None and place <= before + least:
            runs[-1].extend(words[len(words) - (place - before) :] if place - before < least else words)
        else:
            runs.append(words)
        before = place
    counts: Counter = Counter()
    out: list = []
    for run in runs:
        counts[tuple(run)] += 1
        if counts[tuple(run)] <= useful:
            out += [*run, None]
    return out


def coverage(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc_id, key, item_id, item_words, hits in batch.itertuples(index=False):
            item = item_words.split(" ")
            ordered = sorted((h["place"], h["seed"]) for h in hits)
            found = tiles(item, shared_runs(ordered, MIN_MATCH, len(item) // MIN_MATCH), MIN_MATCH)
            rows.append((doc_id, key, item_id, len(item), sum(n for *_, n in found), len(found)))
        names = ["doc_id", "row_key", "item_id", "item_words", "covered_words", "tiles"]
        out = pd.DataFrame(rows, columns=names)
        yield out.astype({"doc_id": "Int64", "item_id": "Int64"})


def item_words(items: DataFrame) -> DataFrame:
    """item_id and words of each different item that is long enough."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [words_of(t) for t in batch["text"]]
            batch["words"] = [" ".join(w) if len(w) >= MIN_MATCH else None for w in words]
            yield batch[["item_id", "words"]].dropna(subset=["words"]).astype({"item_id": "Int64"})

    rows = items.select(F.col("item_id").cast("long"), whole_text().alias("text")).mapInPandas(
        run, "item_id long, words string"
    )
    return rows.groupBy("words").agg(F.min("item_id").alias("item_id"))


def item_seeds(items: DataFrame) -> DataFrame:
    """seed, words and filter place of every seed of the different items."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            rows = set()
            for text in batch["words"]:
                words = text.split(" ")
                for i, place in enumerate(seed_places(words, hashes, MIN_MATCH)):
                    rows.add((" ".join(words[i : i + MIN_MATCH]), text, int(place)))
            yield pd.DataFrame(list(rows), columns=["seed", "words", "bit"])

    return items.select("words").mapInPandas(run, "seed string, words string, bit long")


def document_seeds(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """doc_id, row_key, place and seed of the documents' seeds that pass the filter."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, allowed = WordHashes(), shared.value
        for batch in batches:
            rows = []
            for doc_id, key, text in batch.itertuples(index=False):
                words = words_of(text)
                places = seed_places(words, hashes, MIN_MATCH)
                passed = (allowed[places >> 3] >> (places & 7).astype(np.uint8)) & 1
                for i in np.flatnonzero(passed):
                    rows.append((doc_id, key, int(i), " ".join(words[i : i + MIN_MATCH])))
            out = pd.DataFrame(rows, columns=["doc_id", "row_key", "place", "seed"])
            yield out.astype({"doc_id": "Int64"})

    rows = docs.select(F.col("doc_id").cast("long"), row_key().alias("row_key"), whole_text().alias("text"))
    return rows.mapInPandas(run, "doc_id long, row_key long, place int, seed string")


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, row_key, item_id, item_words, covered_words, tiles of each document and item found in it.

    The driver sees only which of the filter's 2^FILTER_BITS places a seed of the benchmark takes. What
    passes the filter meets the items by a join on the seed itself, which Spark shuffles where
    the benchmark is large. A pair carries the parts of the document that the seeds cover, never the text.
    """
    known = item_words(items)
    seeds = item_seeds(known)
    bits = np.zeros(1 << FILTER_BITS, bool)
    for r in seeds.select("bit").distinct().toLocalIterator(prefetchPartitions=True):
        bits[r["bit"]] = True
    hits = document_seeds(docs, np.packbits(bits, bitorder="little"))
    pairs = hits.join(seeds.select("seed", "words").distinct(), "seed").groupBy("doc_id", "row_key", "words").agg(
        F.collect_set(F.struct("place", "seed")).alias("hits")
    )
    ready = pairs.join(known, "words").select("doc_id", "row_key", "item_id", "words", "hits")
    found = ready.mapInPandas(
        coverage, "doc_id long, row_key long, item_id long, item_words int, covered_words int, tiles int"
    )
    return found.where(F.col("covered_words") >= F.col("item_words") * threshold)


def keep_clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with their columns, in which no item is found."""
    found = contaminated(docs, items, threshold).select("doc_id", "row_key").distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row_key"), as_struct(docs))
    return rows.join(found, same(rows, found, "doc_id", "row_key"), "left_anti").select("whole.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and item found in it."""
    found = contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "item_words", "covered_words", "tiles")
