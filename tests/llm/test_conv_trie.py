"""The prefix trie against building it conversation by conversation."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from strataspark.llm import conv_trie, keyed

COLUMNS = "conv_id long, turn long, role string, text string"


def plain(rows, every=100, most=6):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in turns.items()}
    paths = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % most
        base = int(c / every) * every
        paths[c] = tuple(own.get(base, [])[:h] + v[h:])
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    children, out = defaultdict(list), []
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if paths[c] == p)
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0], r[1]))


def run(spark, rows, columns=COLUMNS):
    df = spark.createDataFrame(rows, columns).repartition(5)
    return sorted((tuple(r) for r in conv_trie.trie(*conv_trie.rebuilt(conv_trie.positions(df))).collect()), key=lambda r: (r[0], r[1]))


def made(seed, n=150, length=7, words=3):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-150, 500), n):
        for t in range(r.randint(1, length)):
            rows.append((c, t, r.choice(("user", "bot")) if t > 2 else "user", "w" * r.randint(0, words) + r.choice(("", "é"))))
    return rows


@pytest.mark.parametrize("share", [1, 1000])
def test_equals_building_it(spark, monkeypatch, share):
    """At a share of 1 keys meet by shuffle; at 1000 of few rows nearly all by broadcast."""
    monkeypatch.setattr(keyed, "SHARE", share)
    rows = made(share)
    assert run(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rows = made(4, 60)
    rows += [(7, None, None, "first"), (7, None, "user", None), (7, 3, "user", "again"), (7, 3, "user", "again"), (7, 3, "bot", "tie")]  # nulls, ties, repeats
    rows += [(None, 1, "user", "nobody"), (901, 0, None, None), (903, 5, "user", "y" * 100_000), (904, 5, "user", "y" * 100_000)]
    rows += [(c, t, "user", "copy") for c in range(1000, 1060) for t in range(9)]  # copies
    assert run(spark, rows) == plain(rows)


def test_one_conversation_holds_most_rows(spark):
    rows = made(9, 30) + [(200, t, "user", f"{t}") for t in range(3000)] + [(203, t, "user", f"{t}") for t in range(2000)]
    assert run(spark, rows) == plain(rows)


def test_turnless_single_and_empty(spark):
    absent = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 > 1)  # no base, fewer turns than h
    assert run(spark, [(absent, 0, "user", "x")]) == plain([(absent, 0, "user", "x")])
    assert run(spark, [(absent, 0, "user", "x")])[0][:7] == (absent, 0, None, 1, 0, 1, 0)
    assert run(spark, []) == []


def test_blocks_of_ids_are_joined(spark, monkeypatch):
    monkeypatch.setattr(conv_trie, "BLOCK_IDS", 7)
    rows = [(c, t, "user", "same") for c in range(100, 160) for t in range(2)]
    assert run(spark, rows) == plain(rows)


def test_clashing_columns(spark):
    rows = made(2, 20)
    wide = [(*r, 1, "x", 2) for r in rows]
    assert run(spark, wide, COLUMNS + ", position int, digest string, n int") == plain(rows)
