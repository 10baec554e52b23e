"""Benchmark decontamination by the q-gram lemma over diagonal bands and banded alignment."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import with_columns

Q, SHORT_Q, SHORT = 8, 4, 24  # passages of less than SHORT code points go by shorter q-grams, as the lemma asks for q * edits < length
EDIT_SHARE = 0.08
WINDOW = 160  # code points of a passage; longer items are cut into overlapping ones
BLOCK_CHARS = 2_000_000  # of benchmark text held by a task at once
TABLE_BITS = 22
CHUNK = 1 << 18
R = np.uint64(0x9E3779B97F4A7C15)


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(c: np.ndarray, q: int) -> np.ndarray:
    """64-bit hashes of the q-grams of a sequence of code points."""
    n = len(c) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    x = c.astype(np.uint64) + np.uint64(1)
    h = x[:n].copy()
    for j in range(1, q):
        h *= R
        h += x[j: j + n]
    return (h ^ (h >> np.uint64(29))) * R


@dataclass
class Index:
    """Passages of a block of the benchmark and their q-grams."""

    q: int
    items: np.ndarray
    texts: list[str]
    lengths: np.ndarray
    budget: np.ndarray
    keys: np.ndarray  # sorted q-gram hashes, with the passage and place of each
    passage: np.ndarray
    place: np.ndarray
    marks: np.ndarray  # whether some q-gram has this leading part
    least: int  # fewest shared q-grams that any passage asks for


def passages(text: str) -> list[str]:
    """An item whole, or, if longer than WINDOW, windows of that length at every half of it and one at the end."""
    if len(text) <= WINDOW:
        return [text]
    starts = {*range(0, len(text) - WINDOW, WINDOW // 2), len(text) - WINDOW}
    return [text[s: s + WINDOW] for s in sorted(starts)]


def build_index(found: dict[tuple[str, int], None], q: int) -> Index | None:
    if not found:
        return None
    texts, items = zip(*found)
    hashed = [grams(points(t), q) for t in texts]
    lengths = np.array([len(t) for t in texts])
    budget = (EDIT_SHARE * lengths).astype(int)  # at least 1 is left of the lemma's bound, as lengths go with q
    keys = np.concatenate(hashed)
    order = np.argsort(keys, kind="stable")
    marks = np.zeros(1 << TABLE_BITS, bool)
    marks[keys >> np.uint64(64 - TABLE_BITS)] = True
    return Index(q, np.array(items), list(texts), lengths, budget, keys[order], np.repeat(np.arange(len(texts)), [len(h) for h in hashed])[order],
                 np.concatenate([np.arange(len(h)) for h in hashed])[order], marks, int((lengths - q + 1 - q * budget).min()))


def build_indexes(rows: list[tuple[int, str]]) -> tuple[list[Index], re.Pattern | None, dict[str, list[int]]]:
    """Indexes by length of passage, and a pattern of the items that are shorter than a q-gram with the items of each."""
    long, short, tiny = {}, {}, {}
    for item, text in rows:
        for p in passages(normal(text)):
            if len(p) >= SHORT:
                long.setdefault((p, item))
            elif len(p) >= Q:
                short.setdefault((p, item))
            elif p:
                tiny.setdefault(p, []).append(item)
    words = re.compile(r"(?<!\w)(?=(" + "|".join(map(re.escape, sorted(tiny, key=lambda p: (-len(p), p)))) + r")(?!\w))") if tiny else None
    return [x for x in (build_index(long, Q), build_index(short, SHORT_Q)) if x is not None], words, tiny


def banded(pattern: np.ndarray, region: np.ndarray, offset: int, band: int, budget: int) -> int | None:
    """Least edit distance of the whole pattern and a part of the region whose alignment keeps within ``band``
    of the diagonal that begins at ``offset``; None if over the budget."""
    width = 2 * band + 1
    shift = np.arange(width)
    big = 1 << 20
    at = offset - band  # place in the region of column 0 before the pattern's first character
    row = np.where((at + shift >= 0) & (at + shift <= len(region)), 0, big)
    padded = np.concatenate([np.full(max(0, -at) + 1, 0xFFFFFFFF, np.uint32), region, np.full(len(pattern) + width + 2, 0xFFFFFFFF, np.uint32)])
    base = at + max(0, -at) + 1
    for i, ch in enumerate(pattern):
        cells = padded[base + i: base + i + width]
        new = np.minimum(row + (cells != ch), np.append(row[1:], big) + 1)
        new = np.where((at + i + 1 + shift >= 0) & (at + i + 1 + shift <= len(region)), new, big)
        row = np.minimum.accumulate(new - shift) + shift  # steps within the row
        if row.min() > budget:
            return None
    return int(row.min()) if row.min() <= budget else None


def regions(index: Index, hits: np.ndarray, h: np.ndarray) -> Iterator[tuple[int, int]]:
    """(passage, first diagonal) of bands that hold as many shared q-grams as an occurrence within the budget must."""
    lo, hi = np.searchsorted(index.keys, h, "left"), np.searchsorted(index.keys, h, "right")
    n = hi - lo
    if not n.sum():
        return
    which = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    passage, diagonal = index.passage[which], np.repeat(hits, n) - index.place[which]
    width = index.budget[passage] + 1
    band = (diagonal + WINDOW) // width
    key = passage.astype(np.int64) << 32 | band
    keys, counts = np.unique(key, return_counts=True)
    # two bands that touch make one of twice the width; these overlap by half
    after = np.searchsorted(keys, keys + 1)
    after_is = (after < len(keys)) & (keys[np.minimum(after, len(keys) - 1)] == keys + 1)
    both = counts + np.where(after_is, counts[np.minimum(after, len(keys) - 1)], 0)
    p = (keys >> 32).astype(int)
    need = index.lengths[p] - index.q + 1 - index.q * index.budget[p]
    for k in np.flatnonzero(both >= need):
        w = index.budget[p[k]] + 1
        yield int(p[k]), int((keys[k] & 0xFFFFFFFF) * w - WINDOW)


def leaks(indexes: tuple, text: str, memo: dict) -> dict[int, tuple[int, int]]:
    """For each benchmark item found in a normalised text: (edits, start) of the best passage."""
    known, words, tiny = indexes
    best: dict[int, tuple[int, int]] = {}
    for index in known:
        for item, hit in occurrences(index, text, memo).items():
            best[item] = min(best.get(item, hit), hit)
    for m in words.finditer(text) if words else ():
        for n in range(len(m[1])):  # shorter items may begin at the same place
            part = m[1][: len(m[1]) - n]
            if part in tiny and not re.match(r"\w", text[m.start() + len(part): m.start() + len(part) + 1]):
                for item in tiny[part]:
                    best[item] = min(best.get(item, (0, m.start())), (0, m.start()))
    return best


def occurrences(index: Index, text: str, memo: dict) -> dict[int, tuple[int, int]]:
    """For each benchmark item found in a normalised text: (edits, start) of the best passage."""
    best: dict[int, tuple[int, int]] = {}
    for begin in range(0, max(1, len(text)), CHUNK):  # chunks overlap by more than a passage can take up
        piece = text[begin: begin + CHUNK + 2 * WINDOW]
        c = points(piece)
        h = grams(c, index.q)
        marked = index.marks[h >> np.uint64(64 - TABLE_BITS)]
        if np.count_nonzero(marked) < index.least:
            continue
        total = np.concatenate([[0], np.cumsum(marked)])
        span = 2 * WINDOW + int(index.budget.max())  # a passage with its edits lies whole in one span
        starts = np.arange(0, len(h), WINDOW)
        dense = starts[total[np.minimum(starts + span, len(h))] - total[starts] >= index.least]
        if not len(dense):
            continue
        near = np.zeros(len(h), bool)
        for s in dense:
            near[s: s + span] = True
        hits = np.flatnonzero(marked & near)
        for p, first in regions(index, hits, h[hits]):
            e, item = int(index.budget[p]), int(index.items[p])
            n = int(index.lengths[p])
            left = max(0, first - e - 1)
            part = piece[left: first + 2 * (e + 1) + n + e]
            key = (index.q, p, part, first - left)
            if key not in memo:
                if len(memo) > 20_000:
                    memo.clear()
                at = part.find(index.texts[p])
                memo[key] = (0, at) if at >= 0 else (d, max(0, first - left)) if (d := banded(
                    points(index.texts[p]), points(part), first - left + e // 2 + 1, 2 * (e + 1), e)) is not None else None
            if memo[key] is not None:
                d, at = memo[key]
                best[item] = min(best.get(item, (1 << 30, 0)), (d, begin + left + at))
    return best


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", carry: dict | None = None) -> DataFrame:
    """(doc_id, item_id, edits, start): the benchmark items that each document holds.

    Texts are compared lower-cased, runs of white space being one space; ``start`` is a place in that form. A passage
    (an item of up to WINDOW code points, or each WINDOW long window of a longer one) counts as held when it stands in the text
    within EDIT_SHARE of its length in edits. An occurrence with e edits
    shares length - q + 1 - q * e q-grams with the passage on diagonals that differ by e at most, so bands of 2 (e + 1) diagonals
    that overlap by half hold them all: other bands are passed over without loss, the rest verified by alignment.
    Items are read in blocks of BLOCK_CHARS, the only thing broadcast; documents are read where they lie, nothing is shuffled
    but found rows. Passages of less than SHORT code points have shorter q-grams; items of less than Q code points must stand in the text
    as they are, between word borders. Null or empty texts hold nothing and null or empty items are not looked for; rows with a null id are
    reported under the null id; rows that repeat are reported each; long texts are read in overlapping chunks.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(item_text_col).alias("t")).filter("t is not null and i is not null")
    chars = items.agg(F.coalesce(F.sum(F.length("t")), F.lit(0)).alias("n")).first().n
    blocks = max(1, -(-2 * chars // BLOCK_CHARS))
    carry = carry or {"doc_id": F.col(id_col)}
    kept = docs.select(*[c.alias(n) for n, c in carry.items()], F.col(text_col).alias("__t"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields if f.name != "__t") + ", item_id long, edits int, start int"
    found = None
    for block in range(blocks):  # one round per bounded part of the benchmark
        rows = items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block).collect()
        indexes = build_indexes([(r.i, r.t) for r in rows])
        if not indexes[0] and indexes[1] is None:
            continue
        part = kept.mapInArrow(_scanner(spark.sparkContext.broadcast(indexes)), schema)
        found = part if found is None else found.union(part)
    return spark.createDataFrame([], schema) if found is None else found


def _scanner(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict = {}
        for batch in batches:
            at, out = [], []
            for i, t in enumerate(batch.column("__t").to_pylist()):
                for item, (edits, start) in sorted(leaks(shared.value, normal(t), memo).items()):
                    at.append(i)
                    out.append((item, edits, start))
            if at:
                item, edits, start = (pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int32(), pa.int32())))
                yield with_columns(batch.drop_columns(["__t"]).take(pa.array(at)), item_id=item, edits=edits, start=start)

    return run
