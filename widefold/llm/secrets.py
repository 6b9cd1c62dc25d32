"""Secret scan, with DataFrame functions only.

Three patterns find assignments to telling names, access keys and long hexadecimal strings. Two character
Markov models, one of random strings and one of ordinary identifiers, find more: long tokens whose
log-likelihood ratio favours the random model. Samples are labelled by the patterns: what they find is
random, tokens of texts in which they find nothing are ordinary.

Spans are in code points, end exclusive. Null text is empty and has no spans. Rows that agree in doc_id
and text are one document to the scan, and each gets its result. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from widefold.llm.common import let, read_table, row_key, whole_text

ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGNED_LENGTH = 8
#: A run that is long enough is found whole either way; so these need no check of the length afterwards.
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
#: Tokens that the models judge.
TOKEN = "[A-Za-z0-9+/_=-]{16,}"
KINDS = ("assign", "access", "hex", "random")

FIRST_CODE = 33
CODES = 90
#: About so many texts give ordinary tokens, and so many found values give random ones.
ORDINARY_TEXTS = 2_000
RANDOM_VALUES = 20_000
#: Weight of a uniform distribution in the random model: strings of any alphabet are random, not only those seen.
UNIFORM_WEIGHT = 20.0
BACK_OFF = 20.0
#: Least log-likelihood ratio of a token to a character, in nats.
THRESHOLD = 3.0


@dataclass(frozen=True)
class MarkovPair:
    """Log-likelihood ratio of each pair of characters, random over ordinary."""

    ratios: np.ndarray

    def per_character(self, token: Column) -> Column:
        table = F.split(F.lit(",".join(f"{v:.5f}" for v in self.ratios.ravel())), ",").cast("array<double>")

        def code(i: Column) -> Column:
            return F.ascii(F.substr(token, i, F.lit(1))) - FIRST_CODE

        total = F.aggregate(
            F.sequence(F.lit(1), F.length(token) - 1), F.lit(0.0),
            lambda sum_, i: sum_ + F.get(table, code(i) * CODES + code(i + 1)),
        )
        return total / (F.length(token) - 1)


def found(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """Matches of a pattern in order: kind, place among them, length of what precedes each since the last
    one, own length, whether the group is long enough, and the group."""

    def build(matches: Column, groups: Column, gaps: Column) -> Column:
        return F.transform(
            matches,
            lambda m, i: F.struct(
                F.lit(kind).alias("kind"), i.alias("place"), F.length(F.get(gaps, i)).alias("gap"),
                F.length(m).alias("length"), (F.length(F.get(groups, i)) >= least).alias("counts"),
                F.get(groups, i).alias("value"),
            ),
        )

    def all_of(g: int) -> Column:
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(g))

    whole = let(
        F.struct(all_of(0).alias("m"), all_of(group).alias("g"), F.split(text, pattern, -1).alias("gaps")),
        lambda x: build(x["m"], x["g"], x["gaps"]),
    )
    # Most texts have no match; for them nothing but this one search is done.
    return F.when(F.rlike(text, F.lit(pattern)), whole)


def base_matches(text: Column) -> Column:
    empty = F.array().cast(
        "array<struct<kind:int,place:int,gap:int,length:int,counts:boolean,value:string>>"
    )
    parts = [found(text, ASSIGN, 0, 2, ASSIGNED_LENGTH), found(text, ACCESS, 1), found(text, HEX, 2)]
    return F.concat(*[F.coalesce(p, empty) for p in parts])


def with_key(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", row_key().alias("row_key"), whole_text().alias("text"))


def spans(rows: DataFrame, matches: Column) -> DataFrame:
    """doc_id, row_key, kind, start, end, value of the matches that count.

    A match begins where the gaps and matches up to it end. That is a running sum over the matches of
    one document, so a text with very many of them takes no longer per match.
    """
    listed = rows.select("doc_id", "row_key", F.explode(matches).alias("m")).select("doc_id", "row_key", "m.*")
    once = listed.dropDuplicates(["doc_id", "row_key", "kind", "place"])
    so_far = Window.partitionBy("doc_id", "row_key", "kind").orderBy("place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    ended = once.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(so_far))
    return ended.where("counts").select(
        "doc_id", "row_key", "kind", (F.col("end") - F.col("length")).alias("start"), "end", "value"
    )


def pair_counts(tokens: DataFrame) -> np.ndarray:
    """Counts of adjacent characters in a column `token`; at most CODES squared rows are gathered."""
    pairs = tokens.select(
        F.explode(F.transform(
            F.sequence(F.lit(1), F.length("token") - 1), lambda i: F.substr(F.col("token"), i, F.lit(2))
        )).alias("pair")
    )
    counts = np.zeros((CODES, CODES))
    for r in pairs.groupBy("pair").agg(F.count("*").alias("n")).collect():
        a, b = (ord(c) - FIRST_CODE for c in r["pair"])
        counts[a, b] = r["n"]
    return counts


def log_probabilities(counts: np.ndarray, weight: float) -> np.ndarray:
    """Of the next character given the one before, drawn by weight towards how often it comes at all."""
    often = counts.sum(axis=0) + 0.5
    prior = weight * often / often.sum()
    return np.log((counts + prior) / (counts.sum(axis=1, keepdims=True) + weight))


def train(docs: DataFrame, ordinary_texts: int = ORDINARY_TEXTS, random_values: int = RANDOM_VALUES) -> MarkovPair:
    """Fit both models on a bounded sample, drawn by hashes from all rows."""
    rows = with_key(docs).withColumn("matches", base_matches(F.col("text")))
    totals = rows.agg(F.count("*").alias("texts"), F.sum(F.size("matches")).alias("values")).first()
    part = 1_000_000

    def drawn(of: Column, wanted: int, there: int | None) -> Column:
        return F.pmod(F.xxhash64(of, F.lit(7)), F.lit(part)) < min(part, part * wanted // max(1, there or 0) + 1)

    plain = rows.where(drawn(F.col("row_key"), ordinary_texts, totals["texts"]) & (F.size("matches") == 0))
    ordinary = plain.select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z0-9+/_=-]{2,}"), F.lit(0))).alias("token"))
    values = rows.select("row_key", F.explode("matches").alias("m")).where("m.counts and length(m.value) >= 16")
    random = values.where(drawn(F.struct("row_key", "m.place"), random_values, totals["values"])).select(
        F.regexp_replace("m.value", "[^A-Za-z0-9+/_=-]", "").alias("token")
    ).where("length(token) >= 2")
    seen = pair_counts(random)
    # Every pair of the token alphabet, evenly: as many as the weight says for each first character.
    allowed = [ord(c) - FIRST_CODE for c in map(chr, range(FIRST_CODE, FIRST_CODE + CODES)) if c.isalnum() or c in "+/_=-"]
    even = np.zeros_like(seen)
    even[np.ix_(allowed, allowed)] = UNIFORM_WEIGHT
    scaled = seen / np.maximum(seen.sum(axis=1, keepdims=True), 1) * UNIFORM_WEIGHT * len(allowed)
    return MarkovPair(
        log_probabilities(scaled + even, 1e-3) - log_probabilities(pair_counts(ordinary), BACK_OFF)
    )


def scan(docs: DataFrame, model: MarkovPair, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_sha256 and spans of every row.

    Tokens that lie over a span of a pattern are left to the pattern.
    """
    rows = with_key(docs)
    random = F.transform(
        found(F.col("text"), TOKEN, 3),
        lambda m: m.withField("counts", model.per_character(m["value"]) >= threshold),
    )
    none = F.array().cast("array<struct<kind:int,place:int,gap:int,length:int,counts:boolean,value:string>>")
    every = spans(rows, F.concat(base_matches(F.col("text")), F.coalesce(random, none)))
    ordered = F.sort_array(F.collect_list(F.struct("start", "kind", "end")))
    listed = every.groupBy("doc_id", "row_key").agg(ordered.alias("all"))
    base = F.filter("all", lambda s: s["kind"] < 3)
    clear = let(base, lambda b: F.filter(
        "all", lambda s: (s["kind"] < 3) | ~F.exists(b, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"]))
    ))
    parted = listed.select(F.col("doc_id").alias("id"), F.col("row_key").alias("key"), base.alias("base"), clear.alias("clear"))
    whole = rows.select("doc_id", "row_key")
    joined = whole.join(parted, whole["doc_id"].eqNullSafe(parted["id"]) & (whole["row_key"] == parted["key"]), "left")

    def number(kind: int) -> Column:
        of_kind = F.filter("clear", lambda s: s["kind"] == kind)
        return F.coalesce(F.size(of_kind), F.lit(0)).cast("long").alias(f"n_{KINDS[kind]}")

    def text_of(column: str) -> Column:
        names = F.array(*map(F.lit, KINDS))
        written = F.transform(column, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
        return F.coalesce(F.array_join(written, ","), F.lit(""))

    return joined.select(
        "doc_id", *[number(k) for k in range(4)], F.sha2(text_of("base"), 256).alias("base_sha256"),
        text_of("clear").alias("spans"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return scan(docs, train(docs))
