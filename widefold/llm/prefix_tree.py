"""The tree of shared beginnings of conversations, and what keeping each beginning once would save.

Conversations that are equal from end to end are collapsed to one sequence with a weight and the list of
those that end there. Sequences that begin another one are found by an anti-join against all proper
beginnings; the others are the leaves. Weights, children, leaves and savings of a node are sums over the
beginnings of the collapsed sequences, so the work is linear in the turns, whatever their depth.

A beginning is named by its depth and 128 bits: the exclusive or of hashes of its turns, each hashed with
its position. It can so be worked out in blocks of positions, and a conversation of any length is shared by
many tasks. A SHA-256 of a node's ends cannot: one task streams the numbers of those that end at a node,
gathered in rows of `LISTED` before, in bounded memory.

Turns are ordered by turn, null first; turns of equal number by a digest of role and text. Null role or text
is empty. Rows without conv_id belong to no conversation and are left out. Repeated rows are turns of their
own. Texts of any length are digested at once and not moved. An empty table gives no nodes, not even a root.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from widefold.llm.common import read_table
from widefold.plans.small_side import join_lookup, materialise

#: Conversations that take their beginning from the same one, and the most turns they take.
FAMILY = 5
MOST_TAKEN = 8
#: Positions of a conversation that one task goes through in order.
BLOCK = 1024
#: Conversation numbers written as one row.
LISTED = 4096
KEY = ["depth", "k1", "k2"]


# ---- conversations as numbered turns -------------------------------------------------------------


def turn_digest() -> Column:
    """Digest of role and text; the length of the role keeps the two apart."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))


def in_ranges(rows: DataFrame, *order: Column | str) -> DataFrame:
    """The rows dealt out by ranges of the order and stored, with `range`, the number of each row's range."""
    return materialise(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()))


def numbered(rows: DataFrame) -> DataFrame:
    """The rows with pos, a turn's place in its conversation from 1.

    Each range numbers its own turns; one that goes on with a conversation of ranges before it adds
    their turns. There is at most one such conversation to a range, so that table is broadcast.
    """
    turn = F.col("turn").asc_nulls_first()
    placed = in_ranges(rows.where(F.col("conv_id").isNotNull()), "conv_id", turn, "digest")
    here = Window.partitionBy("range", "conv_id").orderBy(turn, "digest")
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counted = placed.groupBy("range", "conv_id").agg(F.count("*").alias("n"))
    carried = counted.select("range", "conv_id", F.sum("n").over(before).alias("before")).where("before > 0")
    local = placed.withColumn("pos", F.row_number().over(here).cast("long"))
    return local.join(F.broadcast(carried), ["range", "conv_id"], "left").select(
        *rows.columns, (F.col("pos") + F.coalesce("before", F.lit(0))).alias("pos")
    )


def rebuild(conversations: DataFrame, payload: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """conv_id of all conversations, and their rebuilt turns: conv_id, pos, digest, payload columns.

    A conversation c is rebuilt from the first h turns of conversation c - c % FAMILY and its own turns after
    the first h, where h is crc32 of its decimal number, modulo MOST_TAKEN + 1. payload is by default role and text.
    """
    payload = ["role", "text"] if payload is None else payload
    rows = conversations.select("conv_id", "turn", turn_digest().alias("digest"), *payload)
    turns = materialise(numbered(rows).drop("turn"))
    lengths = materialise(turns.groupBy("conv_id").agg(F.count("*").alias("n")))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_TAKEN + 1)).alias("h")
    giver = (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("giver")
    plans = lengths.select("conv_id", taken, giver)
    given = lengths.select(F.col("conv_id").alias("giver"), F.col("n").alias("given"))
    missing = F.greatest(F.col("h") - F.coalesce("given", F.lit(0)), F.lit(0)).alias("missing")
    plans = materialise(plans.join(given, "giver", "left").select("conv_id", "h", "giver", missing))
    firsts = turns.where(F.col("pos") <= MOST_TAKEN).withColumnRenamed("conv_id", "giver")
    begun = plans.join(firsts, "giver").where("pos <= h").select("conv_id", "pos", "digest", *payload)
    own = turns.join(plans.hint("merge"), "conv_id").where("pos > h").select(
        "conv_id", (F.col("pos") - F.col("missing")).alias("pos"), "digest", *payload
    )
    return plans.select("conv_id"), begun.unionByName(own)


# ---- the tree ------------------------------------------------------------------------------------


def running(rows: DataFrame, combine: Callable[[str], Column], falling: bool, **values: str) -> DataFrame:
    """Adds running totals of columns over each conversation's depths, from the first or, falling, the last.

    values: name of each total and its column. Blocks of positions are totalled side by side, and the
    totals of the blocks ahead are added to each.
    """
    order = F.desc if falling else F.asc
    block = F.floor(F.col("depth") / BLOCK).alias("block")
    placed = rows.withColumn("block", block)
    here = Window.partitionBy("conv_id", "block").orderBy(order("depth"))
    ahead = Window.partitionBy("conv_id").orderBy(order("block")).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("conv_id", block).agg(*[combine(c).alias(n) for n, c in values.items()])
    carried = totals.select("conv_id", "block", *[combine(n).over(ahead).alias(f"{n}_ahead") for n in values])
    carried = materialise(carried.where(" OR ".join(f"{n}_ahead IS NOT NULL" for n in values)))
    local = placed.select("*", *[combine(c).over(here).alias(n) for n, c in values.items()])
    both = {n: combine_two(combine, F.col(n), F.coalesce(f"{n}_ahead", F.lit(0))).alias(n) for n in values}
    joined = join_lookup(local, carried, ["conv_id", "block"], "left")
    return joined.select(*rows.columns, *both.values())


def combine_two(combine: Callable[[str], Column], a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b) if combine is F.bit_xor else a + b


def beginnings(turns: DataFrame) -> DataFrame:
    """All beginnings of all conversations but the empty one: conv_id, depth, k1, k2, p1, p2, bytes.

    (k1, k2) names the beginning that ends with the turn, (p1, p2) the one before it.
    """
    hashes = [F.xxhash64(F.lit(seed), "pos", "digest").alias(f"h{seed}") for seed in (1, 2)]
    rows = turns.select("conv_id", F.col("pos").alias("depth"), *hashes, "bytes")
    named = running(rows, F.bit_xor, False, k1="h1", k2="h2")
    return named.select(
        "conv_id", *KEY, F.col("k1").bitwiseXOR(F.col("h1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("h2")).alias("p2"), "bytes"
    )


def root_of(conversations: DataFrame, *columns: Column | str) -> DataFrame:
    """The empty beginning of conversations, in the form of beginnings."""
    zero = F.lit(0).cast("long")
    names = [*KEY, "p1", "p2", "bytes"]
    return conversations.select("conv_id", *[zero.alias(n) for n in names], *columns)


def ends(whole: DataFrame) -> DataFrame:
    """depth, k1, k2 and ends_sha256: the digest of the numbers of the conversations that end at a node.

    whole has one row per conversation.
    """
    order = [*KEY, "conv_id"]
    placed = in_ranges(whole.select(*order), *order)
    here = Window.partitionBy("range", *KEY).orderBy("conv_id")
    part = F.floor((F.row_number().over(here) - 1) / LISTED).alias("part")
    numbers = F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string"))
    listed = (
        placed.select(*order, "range", part)
        .groupBy(*KEY, "range", "part")
        .agg(F.array_join(numbers, ",").alias("numbers"))
    )
    sorted_rows = listed.repartition(*KEY).sortWithinPartitions(*KEY, "range", "part")
    return sorted_rows.mapInPandas(streamed_digests, "depth long, k1 long, k2 long, ends_sha256 string")


def streamed_digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of the comma-joined lists of each node; rows come in order, a node may run over batches."""
    current, digest = None, None
    for batch in batches:
        out = []
        keys = zip(*[batch[c].tolist() for c in KEY], strict=True)
        for key, numbers in zip(keys, batch["numbers"], strict=True):
            if key == current:
                digest.update(b",")
            else:
                if current is not None:
                    out.append((*current, digest.hexdigest()))
                current, digest = key, hashlib.sha256()
            digest.update(numbers.encode())
        yield pd.DataFrame(out, columns=[*KEY, "ends_sha256"])
    if current is not None:
        yield pd.DataFrame([(*current, digest.hexdigest())], columns=[*KEY, "ends_sha256"])


def prefix_tree(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    conversations has conv_id of every conversation, those without turns too; turns has conv_id, pos from
    1 without gaps, digest and bytes, the length of the text.
    """
    steps = materialise(beginnings(turns))
    every = steps.select("conv_id", *KEY).unionByName(root_of(conversations).select("conv_id", *KEY))
    last = F.max_by(F.struct("k1", "k2"), "depth").alias("k")
    whole = materialise(
        every.groupBy("conv_id").agg(F.max("depth").alias("depth"), last).select("conv_id", "depth", "k.*")
    )

    collapsed = materialise(whole.groupBy(*KEY).agg(F.count("*").alias("weight"), F.min("conv_id").alias("conv_id")))
    inner = steps.select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).distinct()
    leaves = collapsed.join(inner, KEY, "left_anti").withColumn("leaf", F.lit(1).cast("long"))
    proper = collapsed.join(inner, KEY, "left_semi").withColumn("leaf", F.lit(0).cast("long"))
    sequences = materialise(leaves.unionByName(proper).select("conv_id", "weight", "leaf"))

    below = steps.join(sequences.hint("merge"), "conv_id")
    rows = materialise(below.unionByName(root_of(sequences, "weight", "leaf"))).withColumn(
        "owner", F.when(F.col("leaf") == 1, F.col("conv_id"))
    )
    nodes = materialise(
        rows.groupBy(*KEY).agg(
            F.min("conv_id").alias("conv_id"),
            F.max("p1").alias("p1"),
            F.max("p2").alias("p2"),
            F.sum("weight").alias("n_convs"),
            F.sum("leaf").alias("n_leaves"),
            F.max("bytes").alias("bytes"),
            F.min("owner").alias("owner"),
        )
    )

    # Each node is counted on one leaf's path, so that sums along the paths count it once for each node above.
    gains = nodes.select(
        F.col("owner").alias("conv_id"), "depth", ((F.col("n_convs") - 1) * F.col("bytes")).alias("gain")
    )
    paths = rows.where("leaf = 1").select("conv_id", *KEY).join(gains, ["conv_id", "depth"], "left")
    paths = materialise(paths.select("conv_id", *KEY, F.coalesce("gain", F.lit(0)).cast("long").alias("gain")))
    saved = running(paths, F.sum, True, saved="gain").groupBy(*KEY).agg(F.sum("saved").alias("saved_tokens"))

    children = nodes.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")
    ).agg(F.count("*").alias("n_children"))
    full = materialise(nodes.join(saved, KEY).join(children, KEY, "left").join(ends(whole), KEY, "left"))
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("k1").alias("p1"),
        F.col("k2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    return full.join(parents.hint("merge"), ["depth", "p1", "p2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def with_turns(tree: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes with role and text of their last turn; turns as rebuild gives them. The root has neither."""
    last = turns.select("conv_id", F.col("pos").alias("depth"), "role", "text")
    return tree.join(last, ["conv_id", "depth"], "left")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, sf_dir, "conversations")
    sized = table.select("conv_id", "turn", "role", "text", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("bytes"))
    conversations, turns = rebuild(sized, ["bytes"])
    return prefix_tree(conversations, turns)


#: crc32 is spelled out, bit by bit; a node is the list of its turns.
ORACLE_SQL = """
WITH RECURSIVE numbered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
plans AS (
  SELECT DISTINCT conv_id, conv_id - conv_id % 5 AS giver,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
      lambda c, b: list_reduce(list_prepend(xor(c, b), CAST(range(8) AS BIGINT[])), lambda a, i: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295) % 9 AS h
  FROM numbered),
rebuilt AS (
  SELECT p.conv_id, 0 AS side, n.pos, n.role, n.text FROM plans p JOIN numbered n ON n.conv_id = p.giver WHERE n.pos <= p.h
  UNION ALL
  SELECT p.conv_id, 1, n.pos, n.role, n.text FROM plans p JOIN numbered n USING (conv_id) WHERE n.pos > p.h),
whole AS (
  SELECT p.conv_id, coalesce(list({'role': r.role, 'text': r.text} ORDER BY r.side, r.pos) FILTER (WHERE r.pos IS NOT NULL), []) AS turns
  FROM plans p LEFT JOIN rebuilt r USING (conv_id) GROUP BY p.conv_id),
members AS (
  SELECT conv_id, len(turns) AS total, unnest(range(len(turns) + 1)) AS depth, turns FROM whole),
nodes AS (
  SELECT depth, turns[1:depth] AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE total = depth), '')) AS ends_sha256
  FROM members GROUP BY ALL),
children AS (SELECT depth - 1 AS depth, path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
counted AS (
  SELECT nodes.*, coalesce(n, 0) AS n_children,
    CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(path[depth].text) END AS gain
  FROM nodes LEFT JOIN children USING (depth, path)),
above AS (
  SELECT u.d AS depth, c.path[1:u.d] AS path, sum(gain) AS saved, count_if(n_children = 0) AS leaves
  FROM counted c, LATERAL (SELECT unnest(range(c.depth + 1)) AS d) u GROUP BY ALL)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, a.leaves AS n_leaves,
  CAST(a.saved AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted c JOIN above a USING (depth, path)
LEFT JOIN nodes p ON p.depth = c.depth - 1 AND p.path = c.path[1:c.depth - 1]
"""
