"""Approximate nearest neighbours by multi-index hashing of learned rotated binary codes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

BITS, PARTS = 64, 4
SAMPLE_ROWS, PROBE_ROWS, TARGET = 4000, 200, 0.95
CELL_ROWS = 2048  # index rows that one cell of a substring table holds before it is split
TIE = 1e-14  # cosines that differ by less are ties: rounding of sums
SCHEMA = "part int, cell int, lane int, tag int, id long, code long, vec binary"


def usable(vec: Column) -> Column:
    """Neither null nor zero, all components finite."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vec.isNotNull() & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def fit(sample: np.ndarray, k: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray, int]:
    """(mean, projection, radius) from a bounded sample of unit vectors: principal directions, turned by alternating
    between codes and the best rotation; more bits than dimensions take further random turns. The radius is the
    Hamming distance that TARGET of the sample's own nearest neighbours keep."""
    rng = np.random.default_rng(seed)
    mean = sample.mean(0) if len(sample) else np.zeros(1)
    x = sample - mean
    d = x.shape[1]
    _, axes = np.linalg.eigh(x.T @ x)
    turns = []
    while sum(t.shape[1] for t in turns) < BITS:
        v = x @ axes
        r, _ = np.linalg.qr(rng.normal(size=(d, d)))
        for _ in range(20):
            u, _, w = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
            r = (u @ w).T
        turns.append(axes @ r)
    projection = np.hstack(turns)[:, :BITS]
    codes = encode(sample, mean, projection)
    some = np.arange(min(len(sample), PROBE_ROWS))
    if len(sample) <= k + 1:
        return mean, projection, BITS
    cos = sample[some] @ sample.T
    cos[some, some] = -2
    near = np.argpartition(-cos, k - 1, axis=1)[:, :k]
    dist = np.bitwise_count(codes[some][:, None] ^ codes[near])
    return mean, projection, int(np.quantile(dist, TARGET, method="higher"))


def encode(unit: np.ndarray, mean: np.ndarray, projection: np.ndarray) -> np.ndarray:
    bits = (unit - mean) @ projection >= 0
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()


def directions(x: np.ndarray) -> np.ndarray:
    """Rows divided by their largest component: multiples of a vector give the same bytes (a quotient is rounded once), and squares do not overflow."""
    return x / np.abs(x).max(1, keepdims=True) + 0.0


def unit_rows(blobs) -> np.ndarray:
    y = np.frombuffer(b"".join(blobs), np.float64).reshape(len(blobs), -1)
    return y / np.linalg.norm(y, axis=1, keepdims=True)


def best_pairs(close: np.ndarray, queries: np.ndarray, units: np.ndarray, ids: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of each query's ``limit`` best rows among those that are close; scores that differ by less than TIE go by the smaller
    id. The score of a pair does not depend on the block in which it is met."""
    rough = np.where(close, queries @ units.T, -2.0)
    at = min(limit, rough.shape[1]) - 1
    least = -np.partition(-rough, at, axis=1)[:, at]
    q, c = np.nonzero(close & (rough >= (least - 2 * TIE)[:, None]))
    score = np.einsum("ij,ij->i", queries[q], units[c])
    order = np.lexsort((ids[c], -np.round(score / TIE), q))
    q, c, score = q[order], c[order], score[order]
    first = np.searchsorted(q, q)
    keep = np.arange(len(q)) - first < limit
    return q[keep], c[keep], score[keep]


def nearest(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest rows by cosine, its own row left out.

    (1) Vectors of equal direction (multiples of each other) collapse to one with its k + 1 smallest ids: no others can be among the k nearest,
    so the result is that over all rows. (2) BITS-bit codes from a rotation learned on a bounded sample (SAMPLE_ROWS)
    are cut into PARTS substrings; each substring has a table of cells, a cell being the leading bits of the substring
    (so many that it holds about CELL_ROWS; larger cells are split over lanes). Rows and queries meet by an equi-join on (table, cell, lane). (3) By the pigeonhole rule a code
    within radius R of the query differs by at most R // PARTS in some substring: the query visits the cells whose
    leading bits differ in at most that many places, listed by flipping bits, and there every code within R is found (by the first substring that qualifies, so once)
    and reranked by its floats in double precision. A cell's rows are held, queries stream by: memory is bounded. (4) The
    nearest of all visits are kept; a query that found fewer than k + 1 vectors within R is compared with all in blocks.
    Ties go to the smaller id. Vectors that are null, zero, of another length than most or hold null or non-finite
    components take no part. ``queries`` holds ids (rows of ``vectors``) in ``id_col``.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).filter(usable(F.col("v")) & F.col("id").isNotNull())
    widths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    empty = "query_id long, rank int, vec_id long, score double"
    if widths is None:
        return spark.createDataFrame([], empty)
    dim = widths.d

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = directions(np.stack(pdf["v"].to_numpy())) if len(pdf) else np.empty((0, dim))
            yield pd.DataFrame({"id": pdf["id"], "vec": [r.tobytes() for r in x]})

    packed = rows.filter(F.size("v") == dim).mapInPandas(pack, "id long, vec binary").withColumn("h", F.xxhash64("vec"))
    packed = cut(packed)
    # rank limits run before the shuffle too, so a vector that a third of the rows share costs k + 1 rows a task
    ranked = packed.distinct().selectExpr("*", "row_number() over (partition by h, vec order by id) as rn").filter(F.col("rn") <= k + 1)
    distinct = cut(ranked.groupBy("h", "vec").agg(F.sort_array(F.collect_list("id")).alias("ids")).select("h", "vec", "ids", F.col("ids")[0].alias("rep")))
    count = distinct.count()
    share = min(1.0, SAMPLE_ROWS / max(count, 1))
    sample = distinct.filter(F.pmod(F.xxhash64("h"), F.lit(1_000_003)) < int(share * 1_000_003) + 1).select("vec").limit(2 * SAMPLE_ROWS).toPandas()
    mean, projection, radius = fit(unit_rows(sample["vec"].tolist()), k)
    model = spark.sparkContext.broadcast((mean, projection))

    def codes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                unit = unit_rows(pdf["vec"].tolist())
                yield pdf.assign(code=encode(unit, *model.value).view(np.int64))

    coded = cut(distinct.select(F.col("rep").alias("id"), "h", "vec").mapInPandas(codes, "id long, h long, vec binary, code long"))
    asked = queries.select(F.col(id_col).cast("long").alias("id")).distinct().join(packed, "id").select("id", "h", "vec").distinct()
    asked = cut(asked)
    wanted = coded.join(asked.select("h", "vec").distinct(), ["h", "vec"], "left_semi")
    width = BITS // PARTS
    lead = min(width, max(0, int(np.ceil(np.log2(max(1, count / CELL_ROWS))))))
    reach = radius // PARTS
    part = F.explode(F.array(*[F.lit(j) for j in range(PARTS)])).alias("part")
    # the cell of a substring: its leading bits
    cell = f"cast(shiftrightunsigned(code, part * {width} + {width - lead}) & {(1 << lead) - 1} as int)"
    index = coded.select("id", "code", "vec", part).withColumn("cell", F.expr(cell))
    splits = index.groupBy("part", "cell").agg(F.ceil(F.count(F.lit(1)) / (2 * CELL_ROWS)).cast("int").alias("lanes"))
    index = index.join(splits, ["part", "cell"]).withColumn("lane", F.pmod(F.xxhash64("id"), "lanes").cast("int"))
    # the cells in reach of a query's own one: its leading bits with at most ``reach`` of them flipped, each an equi-join key
    flips = F.filter(F.sequence(F.lit(0), F.lit((1 << lead) - 1)), lambda m: F.bit_count(m) <= reach)
    probes = wanted.select("id", "code", "vec", part).withColumn("cell", F.explode(F.transform(flips, lambda m: m.bitwiseXOR(F.expr(cell)))))
    cells = splits.select("part", "cell", F.explode(F.sequence(F.lit(0), F.col("lanes") - 1)).alias("lane"))
    visits = probes.join(cells, ["part", "cell"])
    names = ["part", "cell", "lane", "tag", "id", "code", "vec"]
    both = index.withColumn("tag", F.lit(0)).select(names).union(visits.withColumn("tag", F.lit(1)).select(names))
    mask, limit = np.uint64((1 << width) - 1), k + 1

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, ids, codes_, units, table = None, [], [], [], None
        for pdf in batches:
            for here, g in pdf.groupby(["part", "cell", "lane", "tag"], sort=True):
                *where, tag = here
                if where != key:
                    key, ids, codes_, units, table = where, [], [], [], None
                unit = unit_rows(g["vec"].tolist())
                code = g["code"].to_numpy().view(np.uint64)
                if tag == 0:
                    ids.append(g["id"].to_numpy()), codes_.append(code), units.append(unit)
                    continue
                if not ids:
                    continue
                if table is None:
                    table = np.concatenate(ids), np.concatenate(codes_), np.concatenate(units)
                for at in range(0, len(g), 256):
                    x = code[at: at + 256, None] ^ table[1][None, :]
                    ok = np.bitwise_count(x) <= radius
                    for j in range(where[0] + 1):
                        close = np.bitwise_count((x >> np.uint64(j * width)) & mask) <= reach
                        ok &= close if j == where[0] else ~close
                    q, c, score = best_pairs(ok, unit[at: at + 256], table[2], table[0], limit)
                    yield pd.DataFrame({"q": g["id"].to_numpy()[at: at + 256][q], "found": table[0][c], "score": score})

    # a visit puts out its k + 1 best directions by score, then id: the k + 1 smallest of tied ids belong to the first k + 1 directions
    hits = both.repartition("part", "cell", "lane").sortWithinPartitions("part", "cell", "lane", "tag").mapInPandas(search, "q long, found long, score double")
    hits = cut(hits.selectExpr("*", "row_number() over (partition by q order by round(score / 1e-14) desc, found) as rn").filter(F.col("rn") <= limit).drop("rn"))
    few = wanted.select(F.col("id").alias("q")).join(hits.groupBy("q").count().filter(F.col("count") >= min(limit, count)), "q", "left_anti")
    few = cut(few)  # their hits within R are found again among all rows
    hits = hits.join(few, "q", "left_anti").unionByName(_all_blocks(few.join(wanted, F.col("q") == F.col("id")).select("q", "vec"), coded, limit, count))
    named = hits.join(distinct.select(F.col("rep").alias("found"), "ids"), "found")
    flat = named.select("q", "score", F.explode("ids").alias("vec_id"))
    heads = distinct.select("h", "vec", F.col("rep").alias("q"))
    answers = asked.withColumnRenamed("id", "query_id").join(heads, ["h", "vec"]).select("query_id", "q").join(flat, "q").filter("query_id <> vec_id")
    return (answers.selectExpr("query_id", "cast(row_number() over (partition by query_id order by round(score / 1e-14) desc, vec_id) as int) as rank", "vec_id", "score")
            .filter(F.col("rank") <= k))


def _all_blocks(few: DataFrame, coded: DataFrame, limit: int, count: int) -> DataFrame:
    """The exact way for queries with too few codes in reach: against all rows, in blocks; queries stream by."""
    blocks = max(1, count // (8 * CELL_ROWS) + 1)
    held = coded.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("tag"), "id", "vec")
    asks = few.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("tag"), F.col("q").alias("id"), "vec")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, ids, units = None, [], []
        for pdf in batches:
            for (block, tag), g in pdf.groupby(["block", "tag"], sort=True):
                if block != key:
                    key, ids, units = block, [], []
                unit = unit_rows(g["vec"].tolist())
                if tag == 0:
                    ids.append(g["id"].to_numpy()), units.append(unit)
                    continue
                all_ids, all_units = np.concatenate(ids), np.concatenate(units)
                for at in range(0, len(g), 256):
                    x = unit[at: at + 256]
                    q, c, score = best_pairs(np.ones((len(x), len(all_ids)), bool), x, all_units, all_ids, limit)
                    yield pd.DataFrame({"q": g["id"].to_numpy()[at: at + 256][q], "found": all_ids[c], "score": score})

    return held.union(asks).repartition("block").sortWithinPartitions("block", "tag").mapInPandas(search, "q long, found long, score double")
