"""Line dedup over overlapping windows of three lines.

Every three consecutive lines of a document form a window. A window that also stands earlier,
in a document with a smaller doc_id or further up in the same one, is a repeat; the lines of
all repeats of a document are merged and taken out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterlake.llm.common import free_names, row_key

WINDOW_LINES = 3


def line_dedup(docs: DataFrame) -> DataFrame:
    """The documents with `text` shortened and `n_lines`, `n_removed` (longs) added.

    Lines end at a newline. Windows of white space only are no repeats. The first place of a
    window, by (doc_id, line), stays; null ids come first. Texts of fewer than three lines are
    left as they are; a null text stays null with 0 lines; a text that loses every line becomes
    empty. Rows with one doc_id and different texts are documents of their own; rows that are
    equal in both lose the same lines. Columns of these names are replaced, others stay,
    whatever their names; an empty table gives no rows.
    """
    named = docs.drop("n_lines", "n_removed")
    rows, lines, rest = divided(named)
    all_lines = F.coalesce(F.size(lines), F.lit(0))
    removed = F.coalesce(F.size(lines) - F.size(rest), F.lit(0))
    return rows.select(
        *other_columns(named, lines, rest),
        all_lines.cast("long").alias("n_lines"),
        removed.cast("long").alias("n_removed"),
    )


def shortened(docs: DataFrame) -> DataFrame:
    """The documents with `text` shortened, as by `line_dedup`, and no other column touched."""
    rows, lines, rest = divided(docs)
    return rows.select(*other_columns(docs, lines, rest))


def divided(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """The documents with all lines and, where some are covered, the numbers of the rest; the
    names of these two columns."""
    key, covered, lines, rest = free_names(docs, "key", "covered", "lines", "rest")
    numbers = F.sequence(F.lit(0), F.size(lines) - 1)
    found = covered_lines(windows(docs)).toDF(key, covered)
    rows = (
        docs.withColumn(key, row_key())
        .join(found, key, "left")
        .withColumn(lines, F.split("text", "\n", -1))
        .withColumn(rest, F.when(F.col(covered).isNotNull(), F.array_except(numbers, covered)))
    )
    return rows, lines, rest


def other_columns(docs: DataFrame, lines: str, rest: str) -> list[Column]:
    kept = F.array_join(F.transform(rest, lambda i: F.col(lines)[i]), "\n")
    text = F.when(F.col(rest).isNull(), F.col("text")).otherwise(kept)
    return [text.alias("text") if name == "text" else F.col(name) for name in docs.columns]


def windows(docs: DataFrame) -> DataFrame:
    """`doc_id, key, line, window`: first line and 128-bit hash of every window."""
    lines = docs.where("text LIKE '%\n%\n%'").select(
        "doc_id", row_key().alias("key"), F.split("text", "\n", -1).alias("lines")
    )
    starts = F.sequence(F.lit(1), F.size("lines") - (WINDOW_LINES - 1))
    joined = F.transform(starts, lambda i: F.array_join(F.slice("lines", i, WINDOW_LINES), "\n"))
    return (
        lines.select("doc_id", "key", F.posexplode(joined).alias("line", "joined"))
        .where(F.col("joined").rlike(r"\S"))
        .select("doc_id", "key", "line", F.unhex(F.md5("joined")).alias("window"))
    )


def covered_lines(found: DataFrame) -> DataFrame:
    """`key, covered`: the lines of later occurrences.

    Windows are counted in each task before they meet; only repeated ones are joined back, and
    adaptive execution splits the places of a hot window.
    """
    place = F.struct("doc_id", "line", "key")
    repeated = (
        found.groupBy("window")
        .agg(F.count("*").alias("places"), F.min(place).alias("first"))
        .where("places > 1")
        .select("window", "first")
    )
    later = found.join(repeated, "window").where(place > F.col("first"))
    starts = later.groupBy("key").agg(F.collect_set("line").alias("starts"))
    spans = F.transform(
        "starts", lambda at: F.sequence(at, at + (WINDOW_LINES - 1))
    )
    return starts.select("key", F.array_distinct(F.flatten(spans)).alias("covered"))


def digest(docs: DataFrame) -> DataFrame:
    """`doc_id, n_lines, n_removed, kept_sha256` of every row, as by `line_dedup`."""
    return line_dedup(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_removed",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def kept_text_sql(source: str) -> str:
    """CTEs ending in `line_kept(doc_id, n_lines, n_removed, text)` over a table of documents."""
    return f"""
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) - 1 AS nr
  FROM {source} WHERE text IS NOT NULL),
windows AS (
  SELECT doc_id, nr, line || chr(10) || lead(line, 1) OVER o || chr(10) || lead(line, 2) OVER o
    AS joined
  FROM lines WINDOW o AS (PARTITION BY doc_id ORDER BY nr)),
later AS (
  SELECT doc_id, nr FROM windows
  WHERE joined IS NOT NULL AND regexp_matches(joined, '\\S')
  QUALIFY row_number() OVER (PARTITION BY joined ORDER BY doc_id, nr) > 1),
covered AS (
  SELECT DISTINCT doc_id, nr + step AS nr FROM later, (VALUES (0), (1), (2)) AS s(step)),
line_kept AS (
  SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed,
    CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text
  FROM {source} AS d LEFT JOIN (
    SELECT doc_id, count(*) AS n_lines, count(c.nr) AS n_removed,
      string_agg(line, chr(10) ORDER BY l.nr) FILTER (c.nr IS NULL) AS text
    FROM lines AS l LEFT JOIN covered AS c USING (doc_id, nr)
    GROUP BY doc_id) AS k USING (doc_id))"""


ORACLE_SQL = f"""
WITH {kept_text_sql("documents")}
SELECT doc_id, n_lines, n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM line_kept
"""
