"""Packing of token sequences by patterns that fit the length histogram.

Lengths are counted over all pieces. Patterns of up to three lengths, the shorter ones with repeats, that fill
a sequence or nearly so are enumerated; non-negative least squares fits how often each is to be used, so that
together they use up the histogram. The repeats are rounded by largest remainder to what is there, and what
is left over is packed best fit, longest first, on its own histogram. Only the histogram, one number per length, is gathered; which piece
goes where is worked out by each task from a piece's length and its number among those of that length.

Null text is empty: one piece of one token. Repeated rows are packed like any others. An empty table
gives no pieces. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from widefold.llm.common import read_table, whole_text
from widefold.llm.tokens import token_bytes
from widefold.plans.small_side import materialise

CAPACITY = 2048
END_OF_DOCUMENT = 0
ROUNDS = 100
#: Patterns may leave this part of a sequence empty, and the fit is repeated so often at most.
SPARE_PART = 512
FITS = 4
#: Parts in which patterned sequences are given back.
GIVEN_BACK = 20
#: Pieces of one length that are numbered by one task.
NUMBERED_TOGETHER = 4_000


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# ---- the plan, from the histogram ----------------------------------------------------------------


@dataclass(frozen=True)
class Patterns:
    """What may fill a sequence: each row has up to three lengths, and how often each is there; 0 for none."""

    lengths: np.ndarray
    times: np.ndarray

    def __len__(self) -> int:
        return len(self.lengths)


def enumerate_patterns(present: np.ndarray, capacity: int, spare: int = 0) -> Patterns:
    """Patterns of few lengths that occur: three that fill a sequence exactly, or two with repeats that leave at
    most `spare` places. present[n] tells whether length n occurs."""
    lengths = np.flatnonzero(present)
    lengths = lengths[lengths > 0]
    with_none = np.concatenate([[0], lengths])
    rows, times = [], []
    for a in lengths:
        b = with_none[with_none <= a]
        c = capacity - a - b
        fits = (c >= 0) & (c <= b)
        b, c = b[fits], c[fits]
        fits = (c == 0) | present[np.minimum(c, capacity)]
        rows.append(np.stack([np.full(fits.sum(), a), b[fits], c[fits]], axis=1))
        times.append((rows[-1] > 0).astype(int))
        smaller = lengths[lengths < a]
        for i in range(1, capacity // a + 1):
            left = capacity - i * a
            j = left // smaller if len(smaller) else np.zeros(0, int)
            close = (left - j * smaller <= spare) & (j > 0) & ((i > 1) | (j > 1))
            n = int(close.sum())
            rows.append(np.stack([np.full(n, a), smaller[close], np.zeros(n, int)], axis=1))
            times.append(np.stack([np.full(n, i), j[close], np.zeros(n, int)], axis=1))
            if left <= spare and i > 1:
                rows.append(np.array([[a, 0, 0]]))
                times.append(np.array([[i, 0, 0]]))
    if not rows:
        return Patterns(np.zeros((0, 3), int), np.zeros((0, 3), int))
    return Patterns(np.concatenate(rows), np.concatenate(times))


def fit_repeats(patterns: Patterns, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """How often to use each pattern: the non-negative least-squares solution of pattern use = counts,
    by accelerated projected gradient steps. Each column has three entries at most, so a step costs
    as much as there are patterns."""
    size = len(counts)

    def apply(x: np.ndarray) -> np.ndarray:
        out = np.bincount(patterns.lengths.ravel(), (patterns.times * x[:, None]).ravel(), size)
        out[0] = 0
        return out

    def back(r: np.ndarray) -> np.ndarray:
        return (r[patterns.lengths] * patterns.times).sum(axis=1)

    probe = np.ones(len(patterns))
    largest = 1.0
    for _ in range(20):
        probe = back(apply(probe))
        largest = float(np.linalg.norm(probe))
        probe /= max(largest, 1e-12)
    x = momentum = np.zeros(len(patterns))
    t = 1.0
    for _ in range(rounds):
        step = np.maximum(0, momentum - back(apply(momentum) - counts) / (1.05 * largest))
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        momentum = step + (t - 1) / t_next * (step - x)
        x, t = step, t_next
    return x


def rounded_use(patterns: Patterns, repeats: np.ndarray, counts: np.ndarray) -> tuple[list, np.ndarray]:
    """(lengths, number of sequences) of the patterns used, and the counts that are left.

    Repeats are rounded by largest remainder among the patterns of one longest length, long ones first: whole
    parts, then one more of each in the order of what was cut off, while there are pieces. Rounding each on
    its own would lose nearly all, since the fit spreads over more patterns than there are sequences.
    """
    left = counts.astype(np.int64).copy()
    used: dict[int, int] = defaultdict(int)
    whole = np.floor(repeats).astype(np.int64)
    longest = patterns.lengths[:, 0]
    by_length = np.lexsort([-(repeats - whole), -longest])
    bounds = np.flatnonzero(np.diff(longest[by_length], prepend=-1, append=-1))
    for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
        group = by_length[begin:end]
        length = int(longest[group[0]])
        for i, n in [*((i, int(whole[i])) for i in group if whole[i]), *((i, 1) for i in group)]:
            if not left[length]:
                break
            need: dict[int, int] = defaultdict(int)
            for part, t in zip(patterns.lengths[i].tolist(), patterns.times[i].tolist(), strict=True):
                if t:
                    need[part] += t
            n = min([n, *[int(left[part]) // t for part, t in need.items()]])
            if n > 0:
                for part, t in need.items():
                    left[part] -= n * t
                used[i] += n
    plan = []
    for i, n in used.items():
        lengths = [part for part, t in zip(patterns.lengths[i].tolist(), patterns.times[i].tolist(), strict=True) for _ in range(t)]
        plan.append((tuple(lengths), n))
    return plan, left


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, on a histogram: (lengths of a sequence, number of such sequences)."""
    bins: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)
    room: list[int] = []

    def put(space: int, lengths: tuple[int, ...], n: int) -> None:
        if not bins[space]:
            insort(room, space)
        bins[space][lengths] = bins[space].get(lengths, 0) + n

    for length in range(len(counts) - 1, 0, -1):
        left = int(counts[length])
        while left:
            at = bisect_left(room, length)
            if at == len(room):
                each = capacity // length
                full, rest = divmod(left, each)
                if full:
                    put(capacity - each * length, (length,) * each, full)
                if rest:
                    put(capacity - rest * length, (length,) * rest, 1)
                left = 0
                continue
            space = room[at]
            lengths, n = next(iter(bins[space].items()))
            taken = min(n, left)
            del bins[space][lengths]
            if n > taken:
                bins[space][lengths] = n - taken
            elif not bins[space]:
                room.pop(at)
            put(space - length, (*lengths, length), taken)
            left -= taken
    return [(lengths, n) for by_lengths in bins.values() for lengths, n in by_lengths.items()]


def fitted_part(counts: np.ndarray, capacity: int = CAPACITY) -> tuple[list, np.ndarray]:
    """The sequences that patterns fill, and the counts of the pieces that are left.

    The fit is made again on what rounding has left, until it uses little more. Only exact patterns take
    part in the first one.
    """
    left, plan = counts.astype(np.int64).copy(), []
    for fit in range(FITS):
        patterns = enumerate_patterns(left > 0, capacity, capacity // SPARE_PART if fit else 0)
        if not len(patterns):
            break
        more, left = rounded_use(patterns, fit_repeats(patterns, left.astype(float)), left)
        plan += more
        if sum(n for _, n in more) <= sum(n for _, n in plan) // 50:
            break
    return plan, left


def given_back(plan: list, steps: int, step: int) -> list:
    """The plan without step of every `steps` sequences of short pieces, taken evenly over the plan."""
    out, seen = [], 0
    for lengths, n in plan:
        if len(lengths) == 1:
            out.append((lengths, n))
            continue
        # Sequences seen to seen + n - 1 of the plan; those whose number modulo steps is below step go.
        gone = sum((seen + n - r + steps - 1) // steps - (seen - r + steps - 1) // steps for r in range(step))
        seen += n
        if n > gone:
            out.append((lengths, n - gone))
    return out


def pack_histogram(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, number of sequences) that use up counts, counts[n] being the number of pieces of length n.

    Pieces that no pattern takes may lack short ones to be packed with. So a twentieth of the patterned sequences
    after the other is given back, until no more sequences are needed than by best fit of all pieces;
    where none would be left, that is plain best fit.
    """
    plan, _ = fitted_part(counts, capacity)
    plain = best_fit(counts, capacity)
    fewest = sum(n for _, n in plain)
    for step in range(GIVEN_BACK):
        kept = given_back(plan, GIVEN_BACK, step)
        left = counts.astype(np.int64).copy()
        for lengths, n in kept:
            for length in lengths:
                left[length] -= n
        whole = kept + best_fit(left, capacity)
        if kept and sum(n for _, n in whole) <= fewest:
            return whole
    return plain


@dataclass(frozen=True)
class Slots:
    """Where pieces go: those of a length, from number `first` on, go to one sequence each from `sequence` on.

    `keys` joins length and first number, in rising order. There are as many slots as the plan has
    lengths in its patterns, which depends on the capacity and not on the number of pieces.
    """

    keys: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray

    @staticmethod
    def key(length: np.ndarray, number: np.ndarray) -> np.ndarray:
        return (length.astype(np.int64) << 48) | number

    @classmethod
    def of(cls, plan: list[tuple[tuple[int, ...], int]]) -> Slots:
        used: dict[int, int] = defaultdict(int)
        rows, sequence = [], 0
        for lengths, n in plan:
            offset = 0
            for length in lengths:
                rows.append((length, used[length], sequence, offset))
                used[length] += n
                offset += length
            sequence += n
        table = np.array(sorted(rows), np.int64).reshape(-1, 4)
        return cls(cls.key(table[:, 0], table[:, 1]), table[:, 2], table[:, 3])

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = self.key(length, number)
        at = np.searchsorted(self.keys, key, side="right") - 1
        return self.sequence[at] + (key - self.keys[at]), self.offset[at]


# ---- pieces, and where they go ---------------------------------------------------------------------


def pieces_of(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece. A document of more than `capacity` ids is
    cut so that all pieces but the first are full."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        end = np.array([END_OF_DOCUMENT], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc_id, text in batch.itertuples(index=False):
                ids = token_bytes(text, path) + end
                total = len(ids) // 4
                stops = range(total % capacity or min(total, capacity), total + 1, capacity)
                start = 0
                for piece, stop in enumerate(stops):
                    rows.append((doc_id, piece, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop])))
                    start = stop
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield out.astype({"doc_id": "Int64"})

    rows = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    return rows.mapInPandas(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def numbered(pieces: DataFrame, counts: dict[int, int]) -> DataFrame:
    """Adds `number`, from 0 among the pieces of a length.

    A length's pieces are dealt into groups, which are numbered on their own and then moved up by the
    size of the groups before them, so a length that many pieces share keeps many tasks busy.
    pieces has a unique `row`, and is stored.
    """
    spark = pieces.sparkSession
    sizes = [(length, -(-n // NUMBERED_TOGETHER)) for length, n in counts.items()]
    dealt = pieces.join(F.broadcast(spark.createDataFrame(sizes, "length long, groups long")), "length")
    dealt = dealt.withColumn("group", F.pmod(F.xxhash64("row"), F.col("groups"))).drop("groups")
    before = Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("length", "group").agg(F.count("*").alias("n")).select(
        "length", "group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    inside = F.row_number().over(Window.partitionBy("length", "group").orderBy("row")) - 1
    return dealt.withColumn("inside", inside).join(starts, ["length", "group"]).select(
        *pieces.columns, (F.col("first") + F.col("inside")).alias("number")
    )


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its sequence_id and its offset there."""
    spark = docs.sparkSession
    pieces = materialise(
        pieces_of(docs, path or vocabulary_path(), capacity).withColumn("row", F.monotonically_increasing_id())
    )
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    histogram = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        histogram[length] = n
    slots = spark.sparkContext.broadcast(Slots.of(pack_histogram(histogram, capacity)))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        sequence, offset = slots.value.place(length.to_numpy(), number.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    placed = numbered(pieces, counts).withColumn("place", place("length", "number"))
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("place.sequence_id"), F.col("place.offset")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))
