"""Language identification by Bayesian fusion of text, declared language, address and host evidence."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, list_array, with_columns

BITS, SAMPLE_ROWS = 14, 6000
TABLE_CELLS = 1 << 24  # of the classifier: beyond 1,024 languages trigrams share places
STRENGTH = 20.0  # pseudo-documents that a level of the host hierarchy takes from the level above
TEMPER = 1 / 3  # overlapping trigrams count each character three times
MIN_POSTERIOR = 0.5
CHUNK = 1 << 20
LETTER = np.zeros(256, bool)
LETTER[[*range(97, 123), *range(128, 256)]] = True


def trigram_places(texts: list[str | None], bits: int = BITS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, hashed places of the letter trigrams, how many belong to each text) in bounded runs.
    Bytes other than letters count as one word end; trigrams without two letters are left out."""
    first, run, size = 0, [], 0
    for i, t in enumerate([*texts, None]):
        b = (t or "").lower().encode("utf-8", "surrogatepass")
        if run and (i == len(texts) or size + len(b) > CHUNK):
            a = np.frombuffer(b" ".join(run) + b" ", np.uint8)
            letter = LETTER[a]
            c = np.where(letter, a, 32).astype(np.uint32)
            ends = np.cumsum([len(x) + 1 for x in run])
            if len(c) >= 3:
                pair = letter[1:-1] & (letter[:-2] | letter[2:])
                at = np.flatnonzero(pair)
                h = (c[at] * np.uint32(0x9E3779B1)) ^ (c[at + 1] * np.uint32(0x85EBCA77)) ^ (c[at + 2] * np.uint32(0xC2B2AE3D))
                places = (h * np.uint32(0x27D4EB2F)) >> np.uint32(32 - bits)
                counts = np.diff(np.searchsorted(at + 1, ends), prepend=0)
            else:
                places, counts = np.empty(0, np.uint32), np.zeros(len(run), np.int64)
            yield first, places, counts
            first, run, size = i, [], 0
        run.append(b)
        size += len(b)


def train(docs: DataFrame, text_col: str, label: Column, rows: int = SAMPLE_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages and log(P(trigram | language) / P(trigram)) per hashed place, from about ``rows`` labelled rows: each language gives the same number,
    or all it has, picked by the hash of the text (a task reads a repeated text once). Every label that is sampled is a language.
    Counts are summed before they leave the executors, so the driver gets one table of TABLE_CELLS cells at most."""
    named = docs.select(F.col(text_col).alias("t"), label.alias("l")).filter("l is not null and length(t) > 0")
    sizes = named.groupBy("l").agg(F.count(F.lit(1)).alias("all"))
    langs_held = sizes.count()
    if not langs_held:
        return [], np.zeros((1 << BITS, 0), np.float32)
    bits = BITS
    while langs_held << bits > TABLE_CELLS and bits > 8:
        bits -= 1
    share = F.least(F.lit(1.0), F.lit(max(1.0, rows / langs_held)) / F.col("all"))
    place = F.pmod(F.xxhash64("t"), F.lit(1_000_003))
    sample = named.join(F.broadcast(sizes.select("l", F.ceil(share * 1_000_003).alias("upto"))), "l").filter(place < F.col("upto")).select("l", "t")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables: dict[str, np.ndarray] = {}
        seen: set[tuple[str, int]] = set()
        for pdf in batches:
            for lang, part in pdf.groupby("l"):
                texts = [t for t in part["t"].tolist() if (k := (lang, hash(t))) not in seen and not seen.add(k)]
                t = tables.setdefault(lang, np.zeros(1 << bits, np.int64))
                for _, places, _ in trigram_places(texts, bits):
                    t += np.bincount(places, minlength=1 << bits)
        for lang, t in tables.items():
            at = np.flatnonzero(t)
            yield pd.DataFrame({"l": lang, "place": at, "n": t[at]})

    counts = sample.mapInPandas(count, "l string, place long, n long").groupBy("l", "place").agg(F.sum("n").alias("n"))
    sums = {lang: np.bincount(part["place"], part["n"], minlength=1 << bits) for lang, part in counts.toPandas().groupby("l")}
    langs = sorted(sums)
    if not langs:
        return [], np.zeros((1 << bits, 0), np.float32)
    p = np.stack([(sums[k] + 0.5) / (sums[k].sum() + 0.5 * (1 << bits)) for k in langs], axis=1)
    return langs, np.log(p * (1 << bits)).astype(np.float32)  # against trigrams drawn evenly


def domain_of(host: Column) -> Column:
    return F.regexp_extract(host, r"([^.]*\.?[^.]*)$", 1)


def suffix_of(url: Column) -> Column:
    """A language named by an address: its first path part of two letters, else the last part of the host name."""
    path = F.regexp_extract(url, r"^[a-z]+://[^/?#]*/([A-Za-z]{2})(?:[-_][A-Za-z]{2})?(?:[/?#]|$)", 1)
    top = F.regexp_extract(url, r"^[a-z]+://[^/?#:]*\.([A-Za-z]{2,})(?:[:/?#]|$)", 1)
    return F.lower(F.when(path != "", path).otherwise(top))


def text_scores(docs: DataFrame, text_col: str, langs: list[str], table: np.ndarray, carry: dict[str, Column]) -> DataFrame:
    """Carried columns, plus n (trigrams) and scores (tempered text log likelihood ratio of each language)."""
    shared = docs.sparkSession.sparkContext.broadcast(table)  # TABLE_CELLS cells at most
    k, bits = len(langs), len(table).bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.zeros(len(batch), np.int64)
            scores = np.zeros((len(batch), k))
            for first, places, counts in trigram_places(batch.column("__t").to_pylist(), bits):
                n[first: first + len(counts)] = counts
                ends = np.cumsum(counts)
                for j in range(k):
                    total = np.concatenate([[0.0], np.cumsum(shared.value[places, j], dtype=np.float64)])
                    scores[first: first + len(counts), j] = (total[ends] - total[ends - counts]) * TEMPER
            yield with_columns(batch.drop_columns(["__t"]), n=pa.array(n), scores=list_array(np.round(scores, 6)))

    kept = docs.select(*[c.alias(name) for name, c in carry.items()], F.col(text_col).alias("__t"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields if f.name != "__t")
    return kept.mapInArrow(run, schema + ", n long, scores array<double>")


def softmax(scores: Column) -> Column:
    top = F.array_max(scores)
    powers = F.transform(scores, lambda s: F.exp(s - top))
    return F.transform(powers, lambda p: p / F.aggregate(powers, F.lit(0.0), lambda a, x: a + x))


def identify(docs: DataFrame, text_col: str = "text", declared: Column | None = None, url: Column | None = None,
             host: Column | None = None, carry: dict[str, Column] | None = None) -> DataFrame:
    """Carried columns, plus lang, posterior, n_grams and accepted for each row.

    The posterior of a language is proportional to P(text) P(declared markup language) P(address suffix) P(language
    at the host). Text: letter trigrams, trained on a bounded sample of rows with a declared language. A grouped
    aggregation over all rows sums text posteriors by (host, declared, suffix); from it come P(declared | language),
    P(suffix | language), and host priors, each level smoothed by the next (host, registered domain, all).
    A row is rejected if it has no letter trigrams, if no language explains its text better than trigrams drawn evenly,
    or if no language has MIN_POSTERIOR. Missing evidence (null or empty) says nothing. Null and empty texts are
    rejected with a null lang; repeated rows are judged alike. Only numbers are shuffled, never texts; the plan grows with the number of languages.
    """
    declared = F.lit(None).cast("string") if declared is None else declared
    langs, table = train(docs, text_col, F.lower(F.nullif(declared, F.lit(""))))
    none = lambda c: F.coalesce(F.lower(c), F.lit(""))
    own = [F.col(f"`{c}`") for c in carry or {}]
    carry = {**(carry or {}), "__declared": none(declared), "__suffix": none(suffix_of(url)) if url is not None else F.lit(""),
             "__host": none(host) if host is not None else F.lit("")}
    scored = text_scores(docs, text_col, langs, table, carry)
    if not langs:
        return scored.select(*own, F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("posterior"), F.col("n").alias("n_grams"), F.lit(False).alias("accepted"))
    scored = cut(scored)
    k = len(langs)
    sums = [F.sum(F.when(F.col("n") > 0, F.col("p")[j]).otherwise(0.0)).alias(f"s{j}") for j in range(k)]
    cells = cut(scored.withColumn("p", softmax(F.col("scores"))).groupBy("__host", "__declared", "__suffix").agg(*sums))
    over = lambda *by: cells.groupBy(*by).agg(*[F.sum(f"s{j}").alias(f"s{j}") for j in range(k)])
    arr = lambda: F.array(*[F.col(f"s{j}") for j in range(k)])
    total = cells.agg(*[F.coalesce(F.sum(f"s{j}"), F.lit(0.0)).alias(f"s{j}") for j in range(k)]).first()
    everywhere = np.array([total[j] + 1.0 for j in range(k)])
    root = F.array(*[F.lit(float(x)) for x in everywhere / everywhere.sum()])

    def smooth(counts: Column, above: Column) -> Column:
        n = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(counts, above, lambda c, u: (c + STRENGTH * u) / (n + STRENGTH))

    domains = over(domain_of(F.col("__host")).alias("domain")).select("domain", smooth(arr(), root).alias("up"))
    hosts = (over("__host").withColumn("domain", domain_of(F.col("__host"))).join(domains, "domain")
             .select("__host", F.transform(smooth(arr(), F.col("up")), lambda x: F.log(x)).alias("prior")))

    def likelihood(name: str) -> DataFrame:  # few distinct values; log P(value | language)
        per = F.array(*[(F.col(f"s{j}") + 0.5) / F.lit(float(everywhere[j] + 10)) for j in range(k)])
        return over(name).select(name, F.when(F.col(name) != "", F.transform(per, lambda x: F.log(x)))
                                 .otherwise(F.array_repeat(F.lit(0.0), k)).alias(name + "_ll"))

    fused = scored.join(hosts, "__host").join(likelihood("__declared"), "__declared").join(likelihood("__suffix"), "__suffix")
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    post = softmax(add(add(F.col("scores"), F.col("prior")), add(F.col("__declared_ll"), F.col("__suffix_ll"))))
    out = fused.withColumn("post", post).withColumn("posterior", F.round(F.array_max("post"), 6))
    best = F.array_position("post", F.array_max("post")).cast("int")
    lang = F.when(F.col("n") > 0, F.element_at(F.array(*[F.lit(x) for x in langs]), best))
    good = (F.col("n") > 0) & (F.element_at("scores", best) > 0) & (F.col("posterior") >= MIN_POSTERIOR)
    return out.select(*own, lang.alias("lang"), "posterior", F.col("n").alias("n_grams"), good.alias("accepted"))
