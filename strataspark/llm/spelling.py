"""Grouping of spelling variants by an even-partition pigeonhole join.

Two words are near if one inserted, deleted or replaced character makes them equal. A word of length L is indexed under its two segments, cut at L // 2. One edit
leaves one of the segments as it is, so a word of the same length holds it at the same place, and a word one longer holds the first segment at the start or
the second one place later: these substrings are probed. Words that meet under a segment are verified, and pairs found twice are dropped.

A segment that more than GROUP words hold or probe is not compared as it stands. The edit then lies in the other part, which is cut in two again by the same rule, so that its words
meet only if half of that part is equal too, and so on until one character is left. Every group that is compared is small, no pair is lost, and candidates
grow with the words instead of their square.

Null texts hold no word; a null id counts as an empty string. Repeated rows count as often as they stand there. An empty table has no words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, discard

GROUP = 500  # words of a group that are compared with each other
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def damaged(word: Column, name: Column, every: int) -> Column:
    """``word`` without one character where crc32 of ``name`` is a multiple of ``every``: the character at crc32 modulo the length."""
    h = F.crc32(name.cast("binary"))
    at = (h % F.length(word)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))).otherwise(word)


def count_words(df: DataFrame, text: Column, name: Column, every: int = 199, least_length: int = 6, least_n: int = 5) -> DataFrame:
    """(word, n): runs of letters A-Z, a-z and U+00C0 to U+00FF with A-Z in lower case, damaged by ``name``:run, that have ``least_length`` characters and ``least_n`` occurrences."""
    found = df.select(F.coalesce(name.cast("string"), F.lit("")).alias("name"), F.explode(F.regexp_extract_all(text, F.lit("[A-Za-z\\u00C0-\\u00FF]+"), F.lit(0))).alias("run"))
    runs = found.filter(F.length("run") >= least_length).select("name", F.translate("run", UPPER, LOWER).alias("run"))
    words = runs.select(damaged(F.col("run"), F.concat_ws(":", "name", "run"), every).alias("word")).filter(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_n)


def near_pairs(words: DataFrame) -> DataFrame:
    """A written table (a, b, n_a, n_b) of near words of (word, n), each pair once: ``a`` is the shorter one, of equals the smaller one."""
    half = lambda size: F.floor(size / 2).cast("int")
    part = lambda s, start, size: F.substring(s, start + 1, size)

    def entries(rows: DataFrame) -> DataFrame:
        """Each entry (role, word, n, path, rest) under the two segments of its rest; an entry that is probed for words one shorter skips a character before the second."""
        size = F.length("rest")
        m = F.when(F.col("role") == "longer", size - 1).otherwise(size)  # of the word it is to meet
        p, skip = half(m), F.when(F.col("role") == "longer", 1).otherwise(0)
        first = F.struct(F.lit(0).alias("side"), part(F.col("rest"), F.lit(0), p).alias("same"), part(F.col("rest"), p, size).alias("rest"), m.alias("m"))
        second = F.struct(F.lit(1).alias("side"), part(F.col("rest"), p + skip, size).alias("same"), part(F.col("rest"), F.lit(0), p + skip).alias("rest"), m.alias("m"))
        cuts = rows.withColumn("cut", F.explode(F.array(first, second)))
        left = F.length("cut.rest") - F.when(F.col("role") == "longer", 1).otherwise(0)
        return cuts.select("role", "word", "n", F.xxhash64("path", "cut.m", "cut.side", "cut.same").alias("path"), F.col("cut.rest").alias("rest"), left.alias("left"))

    role = F.explode(F.array(F.lit("index"), F.lit("longer")))  # an index entry also probes for words of its own length
    held = cut(entries(words.select(role.alias("role"), "word", "n", F.lit(0).cast("long").alias("path"), F.col("word").alias("rest"))))
    found = []
    while True:
        sizes = cut(held.groupBy("path").agg(F.count(F.lit(1)).alias("size"), F.max("left").alias("most")).filter((F.col("size") > GROUP) & (F.col("most") > 1)).select("path"))
        large = sizes.count()
        small = held.join(sizes, "path", "left_anti") if large else held
        index = small.filter("role = 'index'").select("path", F.col("word").alias("a"), F.col("n").alias("n_a"))
        probe = small.select("path", F.col("word").alias("b"), F.col("n").alias("n_b"), (F.col("role") == "longer").alias("longer"))
        met = index.join(probe, (index.path == probe.path) & (F.col("longer") | (F.col("a") < F.col("b"))) & (F.length("b") - F.length("a") == F.col("longer").cast("int")) & (F.levenshtein("a", "b", 1) == 1))
        found.append(cut(met.select("a", "b", "n_a", "n_b")))
        if not large:
            break
        held, before = cut(entries(held.join(sizes, "path", "left_semi").drop("left"))), held
        discard(before)
        discard(sizes)
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return cut(pairs.groupBy("a", "b").agg(F.max("n_a").alias("n_a"), F.max("n_b").alias("n_b")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last word that forms lead to. Each round doubles the way, so rounds are few; forms lead nowhere twice, as n rises along them."""
    ways = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = cut(ways.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        discard(ways)
        ways = step.select("word", "root")
        if not step.filter("moved").limit(1).count():
            return ways
        ways._cut_path = step._cut_path


def spelling_variants(words: DataFrame, times: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of (word, n): ``form`` is the near word of largest n (ties: the smallest), if that is ``times`` the word's n; ``root`` the
    last word that forms lead to."""
    words = cut(words.select("word", "n"))
    pairs = near_pairs(words)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("m")).unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("m")))
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    fit = -F.col("best.m") >= times * F.col("n")
    out = cut(words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(fit, F.col("best.other")).alias("form"), F.when(fit, -F.col("best.m")).alias("form_n")))
    last = roots(out.filter("form is not null"))
    return out.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
