"""Alignment of two tokenizers over a corpus, with corpus-wide counts of which tokens stand for which.

A text is cut into tokens by both tokenizers; byte offsets where tokens of both end cut it into groups, and
the two tokens that end there are linked. A link's count is how often its pair of ids is linked in all texts.

The counts sit in dense vectors without keys of their own: a first pass finds the distinct pairs, which are
dealt out by hash to shards of about `SHARD` pairs, and each shard gets a minimal perfect hash function, by
levels of bit maps in which the pairs that fall alone take a place. The counts of the leaves of a tree are
added up place by place, `FAN_IN` vectors at a time. Every place also keeps its pair, so that a lookup tells
a pair it does not know. A second pass aligns the texts anew and looks their pairs up.

What the tasks of the second pass hold are 13 bytes or so a pair. Up to `LIMIT` bytes, measured, the vectors
are sent to them; beyond that the pairs of each text are joined to the counts by shuffle.

Texts are cut into tokens once and their ids kept in a table from which both passes align, since that costs a fifth
of cutting them. Neither tokenizer has a token across a single space between two characters that are no white space, so very
long texts are cut there, and a task holds the tokens of about `WINDOW` characters.

Null text, empty text, and texts that the tokens of either don't spell have no tokens: zeros and ''. Strings of
special tokens are ordinary text. Texts of any length are read whole. Every row of the input gives one row,
repeated rows and rows without doc_id too. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame, SparkSession, functions as F

from widefold.llm.common import read_table, whole_text
from widefold.llm.tokens import PIECES, byte_ranks, patterns
from widefold.plans.small_side import BROADCAST_LIMIT_BYTES, join_lookup, materialise

LIMIT = BROADCAST_LIMIT_BYTES
SHARD = 1 << 18
#: Leaves of the tree of count vectors, and vectors that are added at a time.
LEAVES = 64
FAN_IN = 8
#: Bits of a level of the hash function for each pair that it has to place.
SPREAD = 2
#: Characters of text that a task goes through at once.
WINDOW = 1 << 20
#: A pair of ids as one number.
B_IDS = 1 << 15
#: Characters that are white space to one library and not to another.
DOUBTFUL = "".join(map(chr, [0x180E, 0x200B, 0x2060, 0xFEFF]))
#: A space that no token crosses.
CUT = re.compile(rf"(?<=[^\s{DOUBTFUL}]) (?=[^\s{DOUBTFUL}])")


def vocabulary_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# ---- texts of one task ---------------------------------------------------------------------------


class Aligned(NamedTuple):
    """Stretches laid end to end: the text of each, tokens of both, and where the last tokens of groups are.

    from_a, from_b and from_link tell how many tokens and groups lie ahead of each stretch.
    """

    owners: list[int]
    a: np.ndarray
    b: np.ndarray
    last_a: np.ndarray
    last_b: np.ndarray
    from_a: np.ndarray
    from_b: np.ndarray
    from_link: np.ndarray

    def links(self) -> np.ndarray:
        """The pair that ends each group, as one number."""
        return self.a[self.last_a] * B_IDS + self.b[self.last_b]


class Aligner:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_file(path_a)
        self.plain.encode_special_tokens = True
        ranks = byte_ranks(self.plain.get_vocab(with_added_tokens=False))
        self.fast = tiktoken.Encoding("plain", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        spelled = {i: t for t, i in ranks.items()}
        self.bytes_a = [spelled.get(i, b"") for i in range(max(spelled) + 2)]
        self.bytes_b = [self.piece_bytes(i) for i in range(self.b.vocab_size())]
        self.length_a = np.array([len(t) for t in self.bytes_a])
        self.length_b = np.array([len(t) for t in self.bytes_b])
        # Ids as they are written in groups: a token inside a group and its last one, of either side.
        self.written = [f"{i}{sep}" for n, sep in self.sides() for i in range(n)]

    def sides(self) -> list[tuple[int, str]]:
        return [(len(self.bytes_a), ","), (len(self.bytes_a), "|"), (len(self.bytes_b), ","), (len(self.bytes_b), ";")]

    def piece_bytes(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:-1], 16)])
        return self.b.id_to_piece(i).replace("▁", " ").encode()

    def ids_a(self, text: str) -> np.ndarray:
        """A's ids, which spell every text byte by byte.

        Texts with characters that two libraries may cut differently go to the tokenizer itself.
        """
        if patterns()[1].fullmatch(text):
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        return np.array(self.plain.encode(text, add_special_tokens=False).ids, np.int64)

    def tokens(self, chunk: list[tuple[int, str]]) -> Iterator[tuple[int, bytes | None, bytes | None]]:
        """Number of the text and ids of both, two bytes each, of stretches; no ids where they don't spell it.

        B encodes a stretch with a space put ahead. All it can fail to spell is its own mark for spaces.
        """
        for (i, stretch), ids_b in zip(chunk, self.b.encode([s for _, s in chunk], num_threads=1), strict=True):
            ids_a, whole = self.ids_a(" " + stretch), b" " + stretch.encode("utf-8", "surrogatepass")
            if int(self.length_a[ids_a].sum()) == len(whole) and b"".join(map(self.bytes_b.__getitem__, ids_b)) == whole:
                yield i, ids_a.astype("<u2").tobytes(), np.array(ids_b, "<u2").tobytes()
            else:
                yield i, None, None

    def align(self, chunk: list[tuple[int, bytes, bytes]]) -> Aligned:
        """The alignment of stretches, given as number of the text and ids of both."""
        all_a, all_b = ([np.frombuffer(x[side], "<u2") for x in chunk] for side in (1, 2))
        a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (all_a, all_b))
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        size = int(ends_a[-1]) + 1 if len(a) else 0
        ends_of_a, ends_of_b = np.zeros(size, bool), np.zeros(size, bool)
        ends_of_a[ends_a], ends_of_b[ends_b] = True, True
        last_a, last_b = np.flatnonzero(ends_of_b[ends_a]), np.flatnonzero(ends_of_a[ends_b])
        from_a, from_b = (np.cumsum([0, *map(len, x)]) for x in (all_a, all_b))
        owners = [i for i, _, _ in chunk]
        return Aligned(owners, a, b, last_a, last_b, from_a, from_b, np.searchsorted(last_a, from_a))

    def groups(self, x: Aligned) -> list[str]:
        """The groups of each stretch as `a1,a2|b1;a3|b2,b3`."""
        n_a, n_b = len(self.bytes_a), len(self.bytes_b)
        closes_a, closes_b = np.zeros(len(x.a), bool), np.zeros(len(x.b), bool)
        closes_a[x.last_a], closes_b[x.last_b] = True, True
        group_a, group_b = np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b
        # A token's place: its own tokens ahead, and the other side's of the groups that come first.
        written = np.empty(len(x.a) + len(x.b), np.int64)
        written[np.arange(len(x.a)) + np.concatenate([[0], x.last_b + 1])[group_a]] = x.a + n_a * closes_a
        written[np.arange(len(x.b)) + np.concatenate([x.last_a + 1, [0]])[group_b]] = x.b + 2 * n_a + n_b * closes_b
        shown = written.tolist()
        bounds = (x.from_a + x.from_b).tolist()
        get = self.written.__getitem__
        return ["".join(map(get, shown[s:e]))[:-1] for s, e in zip(bounds[:-1], bounds[1:], strict=True)]


def stretches(text: str, window: int) -> Iterator[str]:
    """A text in stretches of about window characters, cut at a CUT where there is one; '' has none."""
    start = 0
    while len(text) - start > window:
        cut = CUT.search(text, start + window)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.end()
    if start < len(text):
        yield text[start:]


def chunks(pieces: Iterator[tuple], window: int) -> Iterator[list[tuple]]:
    """Numbered pieces, of about window characters or bytes together."""
    chunk, size = [], 0
    for piece in pieces:
        chunk.append(piece)
        size += len(piece[1])
        if size >= window:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def token_chunks(batch: pd.DataFrame, window: int) -> Iterator[list[tuple[int, bytes, bytes]]]:
    """The tokens of a batch of texts, in chunks for align."""
    sides = zip(batch["a"], batch["b"], strict=True)
    return chunks(((i, a, b) for i, (x, y) in enumerate(sides) for a, b in zip(x, y, strict=True)), window)


@cache
def loaded(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


# ---- minimal perfect hashing ---------------------------------------------------------------------


def mixed(pairs: np.ndarray, seed: int) -> np.ndarray:
    """64 well spread bits of each number."""
    with np.errstate(over="ignore"):
        x = pairs.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Places 0 to n - 1 for n distinct numbers, and back."""

    def __init__(self, levels: list[np.ndarray], keys: np.ndarray | None = None):
        self.levels = levels
        ranks, before = [], 0
        for bits in levels:
            ranks.append(before + np.cumsum(bits) - 1)
            before += int(bits.sum())
        self.ranks, self.size = ranks, before
        self.keys = keys

    @classmethod
    def of(cls, pairs: np.ndarray) -> PerfectHash:
        levels, left = [], pairs
        while len(left):
            size = max(8, SPREAD * len(left))
            at = (mixed(left, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        made = cls(levels)
        made.keys = np.zeros(made.size, np.int64)
        made.keys[made.places(pairs)] = pairs
        return made

    def places(self, pairs: np.ndarray) -> np.ndarray:
        """The place of each number; some place or -1 for one that was not there."""
        out = np.full(len(pairs), -1, np.int64)
        open_ = np.arange(len(pairs))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = (mixed(pairs[open_], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[open_[hit]] = ranks[at[hit]]
            open_ = open_[~hit]
        return out

    def verified(self, pairs: np.ndarray) -> np.ndarray:
        """The place of each number, -1 for one that was not there."""
        at = self.places(pairs)
        known = at >= 0
        known[known] = self.keys[at[known]] == pairs[known]
        return np.where(known, at, -1)

    def to_bytes(self) -> tuple[bytes, bytes]:
        """The levels, each with its length ahead, and the keys."""
        levels = b"".join(
            len(b).to_bytes(8, "little") + np.packbits(b, bitorder="little").tobytes() for b in self.levels
        )
        return levels, self.keys.astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, levels: bytes, keys: bytes) -> PerfectHash:
        out, at = [], 0
        while at < len(levels):
            size = int.from_bytes(levels[at : at + 8], "little")
            packed = np.frombuffer(levels, np.uint8, (size + 7) // 8, at + 8)
            out.append(np.unpackbits(packed, count=size, bitorder="little").astype(bool))
            at += 8 + len(packed)
        return cls(out, np.frombuffer(keys, "<u4").astype(np.int64))


def shard_of(pairs: np.ndarray, shards: int) -> np.ndarray:
    return (mixed(pairs, 1 << 20) % np.uint64(shards)).astype(np.int64)


# ---- the passes ----------------------------------------------------------------------------------


def tokenised(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """doc_id, a and b: the ids of both tokenizers, two bytes each, in stretches; none where a text has no tokens.

    Both passes read them from here, so that texts are cut into tokens once.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner = loaded(*paths)
        for batch in batches:
            pieces = ((i, s) for i, text in enumerate(batch["text"]) for s in stretches(text, WINDOW))
            sides: list[tuple[list, list]] = [([], []) for _ in range(len(batch))]
            odd = set()
            for chunk in chunks(pieces, WINDOW):
                for i, a, b in aligner.tokens(chunk):
                    if a is None:
                        odd.add(i)
                    else:
                        sides[i][0].append(a)
                        sides[i][1].append(b)
            sides = [([], []) if i in odd else x for i, x in enumerate(sides)]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "a": pd.Series([a for a, _ in sides], batch.index),
                "b": pd.Series([b for _, b in sides], batch.index),
            })

    rows = docs.select("doc_id", whole_text().alias("text"))
    return rows.mapInPandas(run, "doc_id long, a array<binary>, b array<binary>")


def linked_pairs(tokens: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """pair and n, the links of each pair, added up within chunks; the first pass."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner = loaded(*paths)
        for batch in batches:
            for chunk in token_chunks(batch, WINDOW):
                at, found = pd.factorize(aligner.align(chunk).links())
                yield pd.DataFrame({"pair": found, "n": np.bincount(at, minlength=len(found))})

    return tokens.select("a", "b").mapInPandas(run, "pair long, n long")


def shard_column(shards: int):
    @F.pandas_udf("int")
    def run(pairs: pd.Series) -> pd.Series:
        return pd.Series(shard_of(pairs.to_numpy(), shards).astype("int32"))

    return run


def build_functions(pairs: DataFrame) -> DataFrame:
    """shard, levels and keys of each shard's function, from distinct pairs with their shard."""

    def build(group: pd.DataFrame) -> pd.DataFrame:
        levels, keys = PerfectHash.of(group["pair"].to_numpy()).to_bytes()
        return pd.DataFrame({"shard": group["shard"].iloc[:1], "levels": [levels], "keys": [keys]})

    return pairs.groupBy("shard").applyInPandas(build, "shard int, levels binary, keys binary")


def count_vectors(sums: DataFrame, functions: DataFrame) -> DataFrame:
    """shard and counts, the vector of each shard, from pair, n, shard and leaf of sums.

    A leaf holds a pair once, so none of its vectors is made of more rows than the shard has pairs.
    """

    def fill(rows: pd.DataFrame, function: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({"shard": [], "node": [], "counts": []})
        places = PerfectHash.from_bytes(function["levels"].iloc[0], function["keys"].iloc[0])
        vector = np.zeros(places.size, "<i8")
        vector[places.verified(rows["pair"].to_numpy())] = rows["n"].to_numpy()
        return pd.DataFrame(
            {"shard": rows["shard"].iloc[:1], "node": rows["leaf"].iloc[:1], "counts": [vector.tobytes()]}
        )

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(v, "<i8") for v in rows["counts"])
        return pd.DataFrame({"shard": rows["shard"].iloc[:1], "node": rows["node"].iloc[:1], "counts": [total.tobytes()]})

    shape = "shard int, node int, counts binary"
    every_leaf = functions.withColumn("leaf", F.explode(F.sequence(F.lit(0), F.lit(LEAVES - 1))))
    vectors = sums.groupBy("shard", "leaf").cogroup(every_leaf.groupBy("shard", "leaf")).applyInPandas(fill, shape)
    nodes = LEAVES
    while nodes > 1:
        nodes = -(-nodes // FAN_IN)
        vectors = vectors.withColumn("node", F.floor(F.col("node") / FAN_IN).cast("int"))
        vectors = vectors.groupBy("shard", "node").applyInPandas(add, shape)
    return vectors.drop("node")


def pair_counts(tokens: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """shard, levels, keys and counts: the functions of all shards and their vectors, stored."""
    sums = materialise(linked_pairs(tokens, paths or vocabulary_paths()))
    distinct = materialise(sums.select("pair").distinct())
    shards = max(1, -(-distinct.count() // SHARD))
    functions = materialise(build_functions(distinct.withColumn("shard", shard_column(shards)("pair"))))
    leaf = F.pmod(F.xxhash64("pair", "n"), F.lit(LEAVES)).cast("int").alias("leaf")
    leaves = sums.select("pair", "n", leaf).groupBy("pair", "leaf").agg(F.sum("n").alias("n"))
    vectors = count_vectors(leaves.withColumn("shard", shard_column(shards)("pair")), functions)
    return materialise(functions.join(vectors, "shard"))


def pairs_of(vectors: DataFrame) -> DataFrame:
    """a, b and n: the ids of each pair and its count."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for keys, counts in zip(batch["keys"], batch["counts"], strict=True):
                pairs = np.frombuffer(keys, "<u4").astype(np.int64)
                yield pd.DataFrame({"a": pairs // B_IDS, "b": pairs % B_IDS, "n": np.frombuffer(counts, "<i8")})

    return vectors.select("keys", "counts").mapInPandas(run, "a long, b long, n long")


class Lookup:
    """Count of each pair, and whether it is its B id's highest."""

    def __init__(self, shards: list[tuple[int, bytes, bytes, bytes]], highest: np.ndarray):
        self.shards = {s: (PerfectHash.from_bytes(l, k), np.frombuffer(c, "<i8")) for s, l, k, c in shards}
        self.highest = highest

    def counts(self, pairs: np.ndarray) -> np.ndarray:
        out = np.zeros(len(pairs), np.int64)
        shards = shard_of(pairs, len(self.shards))
        for s, (places, counts) in self.shards.items():
            mine = np.flatnonzero(shards == s)
            if len(mine):
                at = places.verified(pairs[mine])
                out[mine] = np.where(at >= 0, counts[at], 0)
        return out

    def scores(self, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The count of each link, and whether it is its B id's highest."""
        at, pairs = pd.factorize(links)
        counts = self.counts(pairs)
        return counts[at], (counts == self.highest[pairs % B_IDS])[at]


MEASURES = "n_a long, n_b long, n_groups long, n_links long"


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


class Measures:
    """What is added up over the stretches of a batch of texts. Each group ends with one link."""

    def __init__(self, texts: int):
        self.n_a, self.n_b, self.n_links, self.n_best, self.count_sum = np.zeros((5, texts), np.int64)
        self.digests: list = [None] * texts

    def add(self, x: Aligned, groups: list[str]) -> None:
        np.add.at(self.n_a, x.owners, np.diff(x.from_a))
        np.add.at(self.n_b, x.owners, np.diff(x.from_b))
        np.add.at(self.n_links, x.owners, np.diff(x.from_link))
        for i, text in zip(x.owners, groups, strict=True):
            if self.digests[i] is None:
                self.digests[i] = hashlib.sha256(text.encode())
            else:
                self.digests[i].update(b";" + text.encode())

    def add_scores(self, x: Aligned, counts: np.ndarray, best: np.ndarray) -> None:
        np.add.at(self.count_sum, x.owners, np.diff(np.concatenate([[0], np.cumsum(counts)])[x.from_link]))
        np.add.at(self.n_best, x.owners, np.diff(np.concatenate([[0], np.cumsum(best)])[x.from_link]))

    def rows(self, ids: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame({
            "doc_id": ids.astype("Int64"), "n_a": self.n_a, "n_b": self.n_b, "n_groups": self.n_links, "n_links": self.n_links,
            "n_best": self.n_best, "count_sum": self.count_sum,
            "groups_sha256": ["" if d is None else d.hexdigest() for d in self.digests],
        })
        return out[COLUMNS]


def looked_up(tokens: DataFrame, vectors: DataFrame, highest: np.ndarray, paths: tuple[str, str]) -> DataFrame:
    """The second pass where the vectors fit: each task looks its pairs up."""
    names = ["shard", "levels", "keys", "counts"]
    sent = tokens.sparkSession.sparkContext.broadcast(([tuple(r) for r in vectors.select(*names).collect()], highest))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner, lookup = loaded(*paths), Lookup(*sent.value)
        for batch in batches:
            measures = Measures(len(batch))
            for chunk in token_chunks(batch, WINDOW):
                found = aligner.align(chunk)
                measures.add(found, aligner.groups(found))
                measures.add_scores(found, *lookup.scores(found.links()))
            yield measures.rows(batch["doc_id"].reset_index(drop=True))

    shape = f"doc_id long, {MEASURES}, n_best long, count_sum long, groups_sha256 string"
    return tokens.mapInPandas(run, shape)


def joined_up(tokens: DataFrame, vectors: DataFrame, highest: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """The second pass where the vectors are too large to send: the pairs of each text are joined to the counts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner = loaded(*paths)
        for batch in batches:
            measures, links = Measures(len(batch)), [[np.zeros(0, np.int64)] for _ in range(len(batch))]
            for chunk in token_chunks(batch, WINDOW):
                found = aligner.align(chunk)
                measures.add(found, aligner.groups(found))
                for i, own in zip(found.owners, np.split(found.links(), found.from_link[1:-1]), strict=True):
                    links[i].append(own)
            counted = [np.unique(np.concatenate(own), return_counts=True) for own in links]
            out = measures.rows(batch["doc_id"].reset_index(drop=True)).drop(columns=["n_best", "count_sum"])
            yield out.assign(pairs=[p for p, _ in counted], times=[n for _, n in counted])

    shape = f"doc_id long, {MEASURES}, groups_sha256 string, pairs array<long>, times array<long>"
    found = tokens.mapInPandas(run, shape)
    found = materialise(found.withColumn("row", F.monotonically_increasing_id()))
    pair = (F.col("a") * B_IDS + F.col("b")).alias("pair")
    scored = pairs_of(vectors).join(F.broadcast(highest), "b").select(pair, "n", (F.col("n") == F.col("highest")).alias("best"))
    each = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", "p.pairs", "p.times")
    joined = join_lookup(each.withColumnRenamed("pairs", "pair"), materialise(scored), ["pair"])
    totals = joined.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("times")).alias("count_sum"),
    )
    zero = F.lit(0).cast("long")
    return found.join(totals, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )


def alignments(docs: DataFrame, paths: tuple[str, str] | None = None, limit: int = LIMIT) -> DataFrame:
    """One row per document: its tokens, groups and links, and what their pairs count in all documents."""
    paths = paths or vocabulary_paths()
    tokens = materialise(tokenised(docs, paths))
    vectors = pair_counts(tokens, paths)
    # As many rows as the B vocabulary at most.
    highest = materialise(pairs_of(vectors).groupBy("b").agg(F.max("n").alias("highest")))
    size = vectors.agg(F.sum(F.length("levels") + F.length("keys") + F.length("counts")).alias("n")).first()["n"]
    if (size or 0) > limit:
        return joined_up(tokens, vectors, highest, paths)
    best = np.zeros(B_IDS, np.int64)
    for row in highest.collect():
        best[row["b"]] = row["highest"]
    return looked_up(tokens, vectors, best, paths)


def groups(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """doc_id and groups, as `a1,a2|b1;a3|b2,b3`; '' for a text without tokens."""
    paths = paths or vocabulary_paths()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner = loaded(*paths)
        for batch in batches:
            shown: list[list[str]] = [[] for _ in range(len(batch))]
            for chunk in token_chunks(batch, WINDOW):
                found = aligner.align(chunk)
                for i, text in zip(found.owners, aligner.groups(found), strict=True):
                    shown[i].append(text)
            joined = [";".join(x) for x in shown]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "groups": joined})

    return tokenised(docs, paths).mapInPandas(run, "doc_id long, groups string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments(read_table(spark, sf_dir, "documents"))
