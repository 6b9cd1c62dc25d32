"""Removal of long byte strings that occur more than once, by longest-previous-factor arrays.

A factor is a string of `length` bytes. With keep='first' a byte goes where a factor that covers it starts
at an earlier place too, so that the first copy stays; with keep='none' where it starts at any other place.
Places are ordered by doc_id, null last, then by text, then by offset; matches never cross documents.

One suffix array of a large corpus has no natural cut, so only suffixes that can matter are sorted, in many
small arrays. Each factor is stood for by its anchor, the least hash among its strings of `anchor_bytes`, the
first of equal ones. Equal factors have equal anchors, so

1. anchors are hashed and counted over all documents; those seen once settle their factors;
2. the others are written with a digest of their stretch, all factors that they stand for; equal stretches
   are equal as a whole, which settles the inside of long copies;
3. of unlike stretches with one anchor, one of each kind is cut out of its text. The suffixes that begin
   their factors are sorted; for each, the nearest smaller places before and after it in suffix order, found
   by pointer jumping, give its longest previous factor (and next factor, by the places in reverse).

An anchor with more than `TOGETHER` kinds of stretches is dealt out in blocks with a suffix array each; what
the blocks' factors have in common is then found by digests of 128 bits. The groups in which stretches are
compared do so not grow with the copies of a text or passage.

Null text is empty; texts under `length` bytes lose nothing. Rows that agree in doc_id and text are two
documents to keep='none' and one to keep='first'. Texts of any length are gone through in overlapping pieces. An
empty table gives no rows. Extra columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from widefold.llm.common import as_struct, read_table, whole_text
from widefold.plans.small_side import join_lookup, materialise

LENGTH = 200
ANCHOR_BYTES = 64
#: Bytes of text whose hashes are worked out at once, and bits that hold a place among them.
PIECE = 1 << 18
PLACE_BITS = 22
#: Kinds of stretches of one anchor that share a suffix array, and bytes of stretches sorted together.
TOGETHER = 8_192
SORTED_BYTES = 1 << 18
#: An odd number that polynomial hashes are built on.
BASE = 0x9E3779B97F4A7C15


# ---- anchors of one task's texts -----------------------------------------------------------------


def anchor_bytes(length: int) -> int:
    return min(ANCHOR_BYTES, (length + 1) // 2)


@cache
def powers(size: int, inverse: bool) -> np.ndarray:
    """Powers of BASE, or of its inverse, modulo 2^64."""
    base = pow(BASE, -1, 1 << 64) if inverse else BASE
    out = np.full(size, base, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of every string of `size` bytes."""
    room = 1 << max(PIECE + 4 * LENGTH, len(data)).bit_length()
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(room, False)[: len(data)], out=sums[1:])
        return mixed((sums[size:] - sums[:-size]) * powers(room, True)[: len(data) - size + 1])


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every `width` neighbours, from minima that run forwards and backwards in blocks."""
    blocks = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    blocks[: len(values)] = values
    blocks = blocks.reshape(-1, width)
    forwards = np.minimum.accumulate(blocks, axis=1).ravel()
    backwards = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - width + 1
    return np.minimum(backwards[:n], forwards[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, lengths: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Of texts laid end to end: place of each anchor, first and last start of its factors, its hash."""
    if len(data) < length:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    hashes = window_hashes(data, anchor_bytes(length))
    place = np.uint64((1 << PLACE_BITS) - 1)
    ranked = (hashes & ~place) | np.arange(len(hashes), dtype=np.uint64)
    least = window_minima(ranked, length - anchor_bytes(length) + 1)
    ends = np.repeat(np.cumsum(lengths), lengths)[: len(least)]
    starts = np.flatnonzero(np.arange(len(least)) + length <= ends)
    at = (least[starts] & place).astype(np.int64)
    if not len(at):
        return at, at, at, at
    new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([new[1:] - 1, [len(at) - 1]])
    return at[new], starts[new], starts[last], hashes[at[new]].view(np.int64)


def pieces(texts: list[bytes], length: int, room: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Number, offset and bytes of pieces of texts, about room bytes at a time.

    Pieces of a text overlap by one byte less than a factor, so each factor lies in one of them.
    """
    group, size = [], 0
    for i, text in enumerate(texts):
        for start in range(0, max(0, len(text) - length + 1), room):
            piece = text[start : start + room + length - 1]
            if group and size + len(piece) > room:
                yield group
                group, size = [], 0
            group.append((i, start, piece))
            size += len(piece)
    if group:
        yield group


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans in rising order of start, with those that touch or overlap joined."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reached = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(np.concatenate([[True], starts[1:] > reached[:-1]]))
    return starts[new], reached[np.concatenate([new[1:] - 1, [len(starts) - 1]])]


# ---- the passes ----------------------------------------------------------------------------------


def text_key() -> Column:
    """Half of a text's SHA-256."""
    return F.substring(F.unhex(F.sha2(whole_text().cast("binary"), 256)), 1, 16)


def repeated_anchors(texts: DataFrame, length: int) -> DataFrame:
    """anchor: the hashes of anchors that are met more than once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for group in pieces(batch["bytes"].tolist(), length, PIECE):
                data = np.frombuffer(b"".join([p for _, _, p in group]), np.uint8)
                hashes = anchors(data, np.array([len(p) for _, _, p in group]), length)[3]
                found, times = np.unique(hashes, return_counts=True)
                yield pd.DataFrame({"anchor": found, "n": times})

    counted = texts.select("bytes").mapInPandas(run, "anchor long, n long")
    return counted.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor", F.lit(True).alias("again"))


STRETCHES = "key binary, doc_id long, start long, end long, anchor long, digest binary, n long"


def stretches(texts: DataFrame, length: int, keep: str) -> DataFrame:
    """The stretches of all anchors; and, without anchor, spans that repeat inside one text.

    Equal stretches of a text give one row, the first, with their number. A text of one character all over
    so gives a few rows.
    """

    def rows(group: list, keys: list, ids: list) -> pd.DataFrame:
        joined = b"".join([p for _, _, p in group])
        sizes = np.array([len(p) for _, _, p in group])
        at, first, last, hashes = anchors(np.frombuffer(joined, np.uint8), sizes, length)
        begin = np.cumsum(sizes) - sizes
        piece = np.searchsorted(begin, first, "right") - 1
        owner = np.array([i for i, _, _ in group])[piece]
        shift = np.array([s for _, s, _ in group])[piece] - begin[piece]
        cut = zip(first.tolist(), (last + length).tolist(), (at - first).tolist(), strict=True)
        digests = [xxhash.xxh3_128_digest(joined[a:b], seed) for a, b, seed in cut]
        halves = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
        order = np.lexsort([first, halves[:, 1], halves[:, 0], owner])
        same = (halves[order[1:]] == halves[order[:-1]]).all(axis=1) & (owner[order[1:]] == owner[order[:-1]])
        new = np.concatenate([[True], ~same]) if len(order) else np.zeros(0, bool)
        heads = order[new]
        times = np.diff(np.concatenate([np.flatnonzero(new), [len(order)]]))
        start, end = first + shift, last + length + shift
        out = [pd.DataFrame({
            "owner": owner[heads], "start": start[heads], "end": end[heads], "anchor": pd.array(hashes[heads], "Int64"),
            "digest": [digests[i] for i in heads], "n": times,
        })]
        again = order[~new]
        if keep == "none":
            again = np.concatenate([again, heads[times > 1]])
        for i in np.unique(owner[again]):
            own = again[owner[again] == i]
            s, e = merged(start[own], end[own])
            none = pd.array([None] * len(s), "Int64")
            out.append(pd.DataFrame({"owner": i, "start": s, "end": e, "anchor": none, "digest": None, "n": 0}))
        table = pd.concat(out, ignore_index=True)
        table["key"] = [keys[i] for i in table["owner"]]
        table["doc_id"] = pd.array([ids[i] for i in table["owner"]], "Int64")
        return table[["key", "doc_id", "start", "end", "anchor", "digest", "n"]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = batch["key"].tolist()
            ids = [None if pd.isna(i) else int(i) for i in batch["doc_id"].tolist()]
            for group in pieces(batch["bytes"].tolist(), length, PIECE):
                yield rows(group, keys, ids)

    return texts.select("key", "doc_id", "bytes").mapInPandas(run, STRETCHES)


def place(start: str = "start") -> Column:
    """Orders places of the corpus."""
    return F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key", F.col(start).alias("start"))


def cut_out(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of wanted stretches (key, doc_id, start, end, anchor, kinds), each once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            times = batch["starts"].map(len).to_numpy()
            cut = [t[s:e] for t, ss, es in zip(batch["bytes"], batch["starts"], batch["ends"], strict=True) for s, e in zip(ss, es, strict=True)]
            joined = {c: np.concatenate([np.zeros(0, np.int64), *batch[c]]) for c in ("starts", "anchors", "kinds")}
            yield pd.DataFrame({
                "key": np.repeat(batch["key"].to_numpy(), times), "doc_id": batch["doc_id"].astype("Int64").repeat(times).array,
                "start": joined["starts"], "anchor": joined["anchors"], "kinds": joined["kinds"], "bytes": cut,
            })

    listed = F.collect_list(F.struct("start", "end", "anchor", "kinds")).alias("w")
    per_text = materialise(wanted.groupBy("key", F.col("doc_id").alias("first_id")).agg(listed).select(
        "key", "first_id", F.col("w.start").alias("starts"), F.col("w.end").alias("ends"),
        F.col("w.anchor").alias("anchors"), F.col("w.kinds").alias("kinds"),
    ))
    found = join_lookup(texts, per_text, ["key"]).where(F.col("doc_id").eqNullSafe(F.col("first_id")))
    cut = found.select("key", "doc_id", "bytes", "starts", "ends", "anchors", "kinds")
    return cut.mapInPandas(run, "key binary, doc_id long, start long, anchor long, kinds long, bytes binary").dropDuplicates(
        ["key", "start"]
    )


# ---- suffix order --------------------------------------------------------------------------------


def nearest_smaller(places: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Length shared with the nearest smaller place ahead in suffix order; 0 where there is none.

    places: of the suffixes in order; common: shared length of each with the one ahead of it. All suffixes
    jump at once from one ahead to the smaller one ahead of that, and carry the least length on the way.
    """
    n = len(places)
    ahead, shared = np.arange(n) - 1, common.copy()
    open_ = np.flatnonzero(ahead >= 0)
    while len(open_):
        open_ = open_[places[ahead[open_]] > places[open_]]
        over = ahead[open_]
        shared[open_], ahead[open_] = np.minimum(shared[open_], shared[over]), ahead[over]
        gone = ahead[open_] < 0
        shared[open_[gone]] = 0
        open_ = open_[~gone]
    if n:
        shared[ahead < 0] = 0
    return shared


def longest_previous(order: np.ndarray, common: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Longest string that starts at each suffix and at a smaller place, by suffix."""
    ahead = nearest_smaller(places[order], common)
    behind = nearest_smaller(places[order][::-1], np.concatenate([[0], common[1:][::-1]]))[::-1]
    out = np.zeros(len(order), np.int64)
    out[order] = np.maximum(ahead, behind)
    return out


def ranks_of(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys)
    ahead = keys[order]
    ranks = np.empty(len(keys), np.int64)
    ranks[order] = np.cumsum(np.concatenate([[False], ahead[1:] != ahead[:-1]])) if len(keys) else 0
    return ranks


def prefix_ranks(data: np.ndarray, length: int) -> np.ndarray:
    """Rank of the suffix at each place by its first `length` bytes, by doubling the bytes that count."""
    known = min(8, length)
    padded = np.concatenate([data, np.zeros(known, np.uint8)])
    words = np.zeros(len(data), np.uint64)
    for i in range(known):
        words = (words << np.uint64(8)) | padded[i : i + len(data)]
    ranks = ranks_of(words)
    while known < length:
        step = min(known, length - known)
        behind = np.zeros(len(data), np.int64)
        behind[: len(data) - step] = ranks[step:]
        ranks = ranks_of(ranks * (len(data) + 1) + behind)
        known += step
    return ranks


def sorted_suffixes(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of suffixes by their first `length` bytes, equal ones by place; and what each shares with the one ahead.

    Only whether that is `length` bytes matters, so less counts as nothing.
    """
    ranks = prefix_ranks(data, length)[starts]
    order = np.argsort(ranks, kind="stable")
    common = np.zeros(len(order), np.int64)
    common[1:][ranks[order[1:]] == ranks[order[:-1]]] = length
    return order, common


MATCHES = "key binary, doc_id long, start long, end long, digest binary"


def matches(length: int, keep: str):
    """Spans to remove in each group of stretches; and, with a digest, the distinct factors of dealt out groups."""

    def found(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "key", "start"], na_position="last", ignore_index=True)
        sizes = rows["bytes"].map(len).to_numpy()
        data = np.frombuffer(b"".join(rows["bytes"]), np.uint8)
        counts = sizes - length + 1
        owner = np.repeat(np.arange(len(rows)), counts)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = (np.cumsum(sizes) - sizes)[owner] + inside
        order, common = sorted_suffixes(data, starts, length)
        places = np.arange(len(starts))
        longest = longest_previous(order, common, places)
        if keep == "none":
            longest = np.maximum(longest, longest_previous(order, common, -places))
        hit = np.flatnonzero(longest >= length)
        least = np.full(len(rows), np.iinfo(np.int64).max)
        most = np.full(len(rows), -1)
        np.minimum.at(least, owner[hit], inside[hit])
        np.maximum.at(most, owner[hit], inside[hit])
        # All factors of a stretch hold its anchor, so those found cover one span.
        some = most >= 0
        base = rows["start"].to_numpy()
        out = rows.loc[some, ["key", "doc_id"]].assign(start=(base + least)[some], end=(base + most)[some] + length, digest=None)
        dealt = (rows["kinds"] > TOGETHER).to_numpy()
        if dealt.any():
            heads = np.sort(order[common < length])
            heads = heads[dealt[owner[heads]]]
            digests = [xxhash.xxh3_128_digest(data[s : s + length]) for s in starts[heads].tolist()]
            at = base[owner[heads]] + inside[heads]
            own = rows.iloc[owner[heads]][["key", "doc_id"]]
            out = pd.concat([out, own.assign(start=at, end=at + length, digest=digests)], ignore_index=True)
        return out.astype({"doc_id": "Int64"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            ids = rows[["anchor", "block"]].to_numpy()
            ends = np.concatenate([[0], np.cumsum(rows["bytes"].map(len).to_numpy())])
            begin = 0
            for cut in (np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1).tolist():
                if ends[cut] - ends[begin] >= SORTED_BYTES:
                    yield found(rows.iloc[begin:cut])
                    begin = cut
            rest = rows.iloc[begin:]
        if rest is not None and len(rest):
            yield found(rest)

    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH, keep: str = "first") -> DataFrame:
    """key (of a text) and spans, its spans [start, end) in bytes that go; only texts that lose some."""
    if keep not in ("first", "none"):
        raise ValueError(f"unknown rule: {keep}")
    texts = docs.select(text_key().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), whole_text().cast("binary").alias("bytes"))
    texts = texts.where(F.length("bytes") >= length)
    if keep == "first":
        copied = join_lookup(texts, first_ids(docs), ["key"], "left")
        texts = copied.where(F.col("n").isNull() | F.col("doc_id").eqNullSafe(F.col("first_id"))).select(texts.columns)
        texts = texts.dropDuplicates(["key", "doc_id"])
    again = materialise(repeated_anchors(texts, length))
    met = join_lookup(stretches(texts, length, keep), again, ["anchor"], "left").where("anchor IS NULL OR again").drop("again")
    met = materialise(met)
    hits = met.where("anchor IS NOT NULL")

    size = F.max(F.col("end") - F.col("start")).alias("size")
    kinds = materialise(
        hits.groupBy("anchor", "digest").agg(F.sum("n").alias("n"), F.min(place()).alias("first"), size)
    )
    copied = kinds.where("n > 1").select("anchor", "digest", F.col("first").alias("of"))
    whole = join_lookup(hits, materialise(copied), ["anchor", "digest"])
    if keep == "first":
        whole = whole.where((F.col("key") != F.col("of.key")) | (F.col("start") != F.col("of.start")))
    groups = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.count_if(F.col("n") == 1).alias("singles"))
    groups = materialise(groups.where("kinds > 1 AND singles > 0" if keep == "none" else "kinds > 1").drop("singles"))
    wanted = join_lookup(kinds, groups, ["anchor"]).select(
        "first.key", "first.doc_id", "first.start", (F.col("first.start") + F.col("size")).alias("end"), "anchor", "kinds"
    )
    cut = cut_out(texts, wanted).withColumn(
        "block", F.pmod(F.xxhash64("key", "start"), F.ceil(F.col("kinds") / TOGETHER)).cast("int")
    )
    dealt = cut.repartition("anchor", "block").sortWithinPartitions("anchor", "block")
    matched = materialise(dealt.mapInPandas(matches(length, keep), MATCHES))

    factors = matched.where("digest IS NOT NULL")
    common = factors.groupBy("digest").agg(F.count("*").alias("n"), F.min(place()).alias("of")).where("n > 1")
    across = join_lookup(factors, materialise(common), ["digest"])
    if keep == "first":
        across = across.where((F.col("key") != F.col("of.key")) | (F.col("start") != F.col("of.start")))
    span = ["key", "start", "end"]
    every = (
        met.where("anchor IS NULL").select(*span)
        .unionByName(whole.select(*span))
        .unionByName(matched.where("digest IS NULL").select(*span))
        .unionByName(across.select(*span))
    )
    # A text has no more spans than a few for each of its anchors.
    return every.groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def first_ids(docs: DataFrame) -> DataFrame:
    """key, n, first_id: the least doc_id of texts that occur more than once, null last."""
    least = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").cast("long").alias("doc_id"))).alias("first")
    counted = docs.select(text_key().alias("key"), "doc_id").groupBy("key").agg(F.count("*").alias("n"), least)
    return materialise(counted.where("n > 1").select("key", "n", F.col("first.doc_id").alias("first_id")))


def cleaned(columns: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """The bytes of texts that are left, and their maximal removed spans."""
    for texts, all_starts, all_ends in columns:
        rows = []
        for text, starts, ends in zip(texts, all_starts, all_ends, strict=True):
            if starts is None:
                rows.append((text, [], []))
                continue
            starts, ends = merged(np.asarray(starts), np.asarray(ends))
            edges = zip([0, *ends.tolist()], [*starts.tolist(), len(text)], strict=True)
            rows.append((b"".join([text[a:b] for a, b in edges]), starts, ends))
        yield pd.DataFrame(rows, columns=["kept", "starts", "ends"])


def without_repeats(docs: DataFrame, length: int = LENGTH, keep: str = "first") -> DataFrame:
    """doc_id, whole (the row), bytes, kept, starts, ends: each document's bytes that stay and the spans that go."""
    spans = materialise(repeated_spans(docs, length, keep).select("key", F.col("spans.start").alias("starts"), F.col("spans.end").alias("ends")))
    rows = docs.select(text_key().alias("key"), "doc_id", as_struct(docs), whole_text().cast("binary").alias("bytes"))
    starts, ends = F.col("starts"), F.col("ends")
    joined = join_lookup(rows, spans, ["key"], "left")
    if keep == "first":
        joined = join_lookup(joined, first_ids(docs), ["key"], "left")
        later = F.col("n").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.length("bytes") >= length)
        starts = F.when(later, F.array(F.lit(0).cast("long"))).otherwise(starts)
        ends = F.when(later, F.array(F.length("bytes").cast("long"))).otherwise(ends)
    clean = F.pandas_udf(cleaned, "kept binary, starts array<long>, ends array<long>")
    return joined.select("doc_id", "whole", "bytes", clean("bytes", starts, ends).alias("r")).select(
        "doc_id", "whole", "bytes", "r.*"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_repeats(read_table(spark, sf_dir, "documents"), keep="none")
    removed = F.length("bytes") - F.length("kept")
    return out.select(
        "doc_id", F.length("bytes").cast("long").alias("n_bytes"), removed.cast("long").alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
