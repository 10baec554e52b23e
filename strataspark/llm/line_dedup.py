"""Line dedup by overlapping three-line windows (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

WINDOW = 3


def line_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per window of three consecutive lines: (id, key, pos, h1, h2).

    A window is named by 128 bits of hash over its lines, so that texts themselves
    are never shuffled. ``key`` tells rows with the same id but other texts apart.
    """
    lines = docs.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.split(F.col(text_col), "\n").alias("l"))
    at = lambda i: [F.col("l")[i + k] for k in range(WINDOW)]
    spots = F.when(F.size("l") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size("l") - WINDOW),
        lambda i: F.struct(i.alias("pos"), F.xxhash64(*at(i)).alias("h1"), F.xxhash64(F.lit(1), *at(i)).alias("h2"))))
    return (lines.select("id", "key", F.explode_outer(spots).alias("w"))
            .select("id", "key", "w.pos", "w.h1", "w.h2").filter("pos is not null"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove every later occurrence of a repeated window of three lines.

    Windows overlap (one starts at each line). Of the occurrences of a window in the
    whole table the first by (id, text hash, line number) stays; the positions that
    later ones cover are merged and those lines go. Returns the rows of ``docs`` with
    the remaining lines joined again, plus ``n_lines`` (before) and ``n_removed``
    (columns of these names in the input are replaced).

    Nulls: a null text stays null with n_lines 0; a row with a null id neither gives
    nor loses lines. Texts of fewer than three lines stay as they are; an empty text is one
    empty line. Rows that repeat both id and text count as one occurrence and stay alike. A text
    all of whose lines go becomes empty. Scale: only 32-byte window rows are shuffled
    for the search, pre-aggregated by window; the join that finds later occurrences is a plain
    equi-join that adaptive execution splits for hot windows; texts are shuffled
    at most once, for the join with the removed positions.
    """
    windows = cut(line_windows(docs, id_col, text_col))
    repeated = (windows.groupBy("h1", "h2")
                .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "key", "pos")).alias("first"))
                .filter("n > 1").select("h1", "h2", "first"))
    later = (windows.join(repeated, ["h1", "h2"])
             .filter(F.struct("id", "key", "pos") > F.col("first")))
    covered = (later.groupBy("id", "key").agg(F.sort_array(F.collect_set("pos")).alias("__cut"))
               .select(F.col("id").alias("__id"), F.col("key").alias("__key"), "__cut"))
    rows = docs.drop("n_lines", "n_removed")
    names = rows.columns
    joined = (rows.withColumn("__hash", F.xxhash64(text_col))
              .join(covered, (F.col(id_col) == F.col("__id")) & (F.col("__hash") == F.col("__key")), "left"))
    lines = F.split(F.col(text_col), "\n")
    cuts = F.col("__cut")
    n = F.size(cuts)
    begin = lambda i: F.when(i == 0, F.lit(0)).otherwise(cuts[i - 1] + WINDOW)
    end = lambda i: F.when(i == n, F.size("__lines")).otherwise(cuts[i])
    kept = F.flatten(F.transform(
        F.sequence(F.lit(0), n),
        lambda i: F.when(end(i) > begin(i), F.slice("__lines", begin(i) + 1, end(i) - begin(i)))
        .otherwise(F.array().cast("array<string>"))))
    split_up = joined.withColumn("__lines", F.when(cuts.isNotNull(), lines))
    done = split_up.withColumn("__kept", F.when(cuts.isNotNull(), kept))
    total = F.when(F.col(text_col).isNull(), 0).otherwise(
        F.length(text_col) - F.length(F.replace(F.col(text_col), F.lit("\n"), F.lit(""))) + 1)
    out = done.select(
        *[F.when(cuts.isNotNull(), F.array_join("__kept", "\n")).otherwise(F.col(c)).alias(c)
          if c == text_col else F.col(f"`{c}`") for c in names],
        total.cast("long").alias("n_lines"),
        F.when(cuts.isNotNull(), F.size("__lines") - F.size("__kept")).otherwise(0).cast("long").alias("n_removed"))
    return out
