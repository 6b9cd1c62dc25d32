"""Line dedup over content-defined chunks, with DataFrame functions only.

A document's lines are hashed. A rolling hash over the last `window` line hashes marks a line as a
candidate where it divides by `divisor`; a chunk ends after a candidate that follows no candidate. The
rule looks at a few neighbouring lines only, so lines put in or taken out elsewhere do not move a
boundary, and all chunks but a document's first and last have two lines or more.

Of equal chunks of at least `min_lines` lines the first one stays (least doc_id, then place); all
others are removed. Chunks meet by hash, and then are grouped by their bytes.

Null text is empty. An empty text has one empty line and loses nothing. Rows that agree in doc_id and
text are one document and get the same answer. A null doc_id counts as least. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from widefold.llm.common import as_struct, read_table, row_key, same, whole_text
from widefold.plans.small_side import materialise

WINDOW = 2
DIVISOR = 2
MIN_LINES = 2
BASE = 1_000_003
PRIME = 2_147_483_647


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_hash(line: Column) -> Column:
    """The first 31 bits or so of the line's MD5, as a number below PRIME."""
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("bigint") % PRIME


def rolling(hashes: Column, i: Column, window: int) -> Column:
    """Polynomial hash of the window of line hashes that ends at line i; fewer at the start."""
    value = F.lit(0).cast("bigint")
    for back in range(window - 1, -1, -1):
        term = F.coalesce(F.get(hashes, i - back), F.lit(0).cast("bigint"))
        value = (value * BASE + term) % PRIME
    return value


def with_starts(docs: DataFrame, window: int, divisor: int) -> DataFrame:
    """Adds `starts`: the first line of each chunk, and at the end the number of lines.

    Each step is a column of its own, else Spark would compute the inner arrays once per line.
    """
    lines = docs.withColumn("n_lines", F.size(lines_of(F.col("text"))))
    hashed = lines.withColumn("hashes", F.transform(lines_of(F.col("text")), line_hash))
    marked = hashed.withColumn(
        "marks",
        F.transform(
            F.sequence(F.lit(0), F.col("n_lines") - 1), lambda i: rolling(F.col("hashes"), i, window) % divisor == 0
        ),
    )
    ends = F.filter(
        F.sequence(F.lit(0), F.col("n_lines") - 1),
        lambda i: F.get("marks", i) & ((i == 0) | ~F.coalesce(F.get("marks", i - 1), F.lit(False))),
    )
    starts = F.array_distinct(F.concat(F.array(F.lit(0)), F.transform(ends, lambda i: i + 1), F.array(F.col("n_lines"))))
    return marked.withColumn("starts", starts).drop("hashes", "marks")


def chunk_text(lines: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(lines, start + 1, length), "\n")


def removals(
    docs: DataFrame, window: int = WINDOW, divisor: int = DIVISOR, min_lines: int = MIN_LINES
) -> DataFrame:
    """doc_id, row_key, and `cut`: the (start, length) in lines of each chunk to be removed.

    Chunks are first met as hashes, without their text. Only chunks whose hash occurs more than once
    are then taken out of their texts and grouped by their bytes. Counting and the choice of the
    first chunk begin inside each task, so a chunk found in a third of all rows costs no more.
    """
    rows = docs.select("doc_id", row_key().alias("row_key"), whole_text().alias("text"))
    chunked = with_starts(rows, window, divisor)
    ranges = F.transform(
        F.sequence(F.lit(0), F.size("starts") - 2),
        lambda i: F.struct(
            F.get("starts", i).alias("start"), (F.get("starts", i + 1) - F.get("starts", i)).alias("length")
        ),
    )
    long_enough = F.filter(ranges, lambda r: r["length"] >= min_lines)
    listed = chunked.withColumn("ranges", long_enough).withColumn("lines", lines_of(F.col("text")))
    with_hash = F.transform(
        F.col("ranges"),
        lambda r: F.struct(
            F.xxhash64(chunk_text(F.col("lines"), r["start"], r["length"])).alias("hash"),
            r["start"].alias("start"), r["length"].alias("length"),
        ),
    )
    # Written once: it is small beside the texts, and hashing their lines is most of the work.
    met = materialise(
        listed.select("doc_id", "row_key", F.explode(with_hash).alias("c")).select("doc_id", "row_key", "c.*")
    )
    # Stored, so that adaptive execution can cut a frequent hash into pieces in the join.
    repeated = materialise(met.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"))
    hits = met.join(repeated, "hash").groupBy("doc_id", "row_key").agg(
        F.collect_set(F.struct("start", "length", "hash")).alias("hits")
    )
    found = rows.join(hits, same(rows, hits, "doc_id", "row_key")).select(
        rows["doc_id"], rows["row_key"], lines_of(F.col("text")).alias("lines"), "hits"
    )
    taken = found.select("doc_id", "row_key", "lines", F.explode("hits").alias("h")).select(
        "doc_id", "row_key", "h.*", chunk_text(F.col("lines"), F.col("h.start"), F.col("h.length")).alias("chunk")
    )
    place = F.struct("doc_id", "start", "row_key")
    groups = materialise(taken.groupBy("hash", "chunk").agg(F.min(place).alias("first")))
    later = taken.join(groups, ["hash", "chunk"]).where(~place.eqNullSafe(F.col("first")))
    return later.groupBy("doc_id", "row_key").agg(
        F.sort_array(F.collect_set(F.struct("start", "length"))).alias("cut")
    )


def dedup_lines(
    docs: DataFrame, window: int = WINDOW, divisor: int = DIVISOR, min_lines: int = MIN_LINES
) -> DataFrame:
    """Every row with all its columns, `text` without the removed chunks, and two more columns:
    n_lines, and n_removed of them. A null text stays null. Where nothing is removed the text is as it was."""
    rows = docs.select("doc_id", row_key().alias("row_key"), as_struct(docs))
    cuts = removals(docs, window, divisor, min_lines).toDF("cut_id", "cut_key", "cut")
    is_cut = F.col("doc_id").eqNullSafe(F.col("cut_id")) & (F.col("row_key") == F.col("cut_key"))
    # The kept ranges lie between one cut's end and the next one's start.
    edges = rows.join(cuts, is_cut, "left").withColumn("lines", lines_of(whole_text("whole.text"))).withColumn(
        "kept",
        F.zip_with(
            F.concat(F.array(F.lit(0)), F.transform("cut", lambda c: c["start"] + c["length"])),
            F.concat(F.transform("cut", lambda c: c["start"]), F.array(F.size("lines"))),
            lambda start, end: F.struct(start.alias("start"), (end - start).alias("length")),
        ),
    )
    kept = F.flatten(F.transform("kept", lambda r: F.slice(F.col("lines"), r["start"] + 1, r["length"])))
    removed = F.coalesce(F.aggregate("cut", F.lit(0), lambda a, c: a + c["length"]), F.lit(0))
    text = F.when(F.col("cut").isNull(), F.col("whole.text")).otherwise(F.array_join(kept, "\n"))
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    return edges.select(
        *[text.alias("text") if c == "text" else F.col(f"whole.`{c}`") for c in names],
        F.size("lines").alias("n_lines"), removed.alias("n_removed"),
    )


def drop_repeats(docs: DataFrame) -> DataFrame:
    """The rows with their columns and the text that is left. Rows of which every line was a repeat go."""
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in others]).alias("others"))
    done = dedup_lines(rows).where(F.col("n_removed") < F.col("n_lines"))
    return done.select(*[F.col("text") if c == "text" else F.col(f"others.`{c}`") for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed and the SHA-256 of the text that is left, for every document."""
    done = dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_removed", F.sha2(whole_text(), 256).alias("text_sha256"))


ORACLE_SQL = f"""
WITH docs AS (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS i
  FROM docs),
hashed AS (
  SELECT *, CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) % {PRIME} AS h FROM lines),
rolled AS (
  SELECT *, (coalesce(lag(h) OVER w, 0) * {BASE} + h) % {PRIME} % {DIVISOR} = 0 AS mark
  FROM hashed WINDOW w AS (PARTITION BY doc_id, text ORDER BY i)),
ends AS (
  SELECT *, mark AND NOT coalesce(lag(mark) OVER w, false) AS is_end
  FROM rolled WINDOW w AS (PARTITION BY doc_id, text ORDER BY i)),
numbered AS (
  SELECT *, coalesce(sum(CASE WHEN is_end THEN 1 ELSE 0 END)
    OVER (PARTITION BY doc_id, text ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk_no
  FROM ends),
chunks AS (
  SELECT doc_id, text, chunk_no, min(i) AS start, count(*) AS n,
         string_agg(line, chr(10) ORDER BY i) AS chunk
  FROM numbered GROUP BY doc_id, text, chunk_no),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY doc_id NULLS FIRST, start) AS place
  FROM chunks WHERE n >= {MIN_LINES}),
kept AS (
  SELECT n.doc_id, n.text, n.line, n.i, coalesce(r.place, 1) > 1 AS gone
  FROM numbered n LEFT JOIN ranked r
    ON n.doc_id IS NOT DISTINCT FROM r.doc_id AND n.text = r.text AND n.chunk_no = r.chunk_no),
done AS (
  SELECT doc_id, text, CAST(count(*) AS INTEGER) AS n_lines,
         CAST(count(*) FILTER (WHERE gone) AS INTEGER) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS rest
  FROM kept GROUP BY doc_id, text)
SELECT d.doc_id, o.n_lines, o.n_removed, sha256(o.rest) AS text_sha256
FROM documents d JOIN done o ON d.doc_id IS NOT DISTINCT FROM o.doc_id AND coalesce(d.text, '') = o.text
"""
