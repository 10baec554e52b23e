"""N-gram Jaccard self-join by filters under many global token orders."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut, local_forest
from .textvec import mix, shingle_sets

TOGETHER = 3  # orders under which a pair must share its prefix token at the same time
MISS = 1e-12  # chance that a pair at the least similarity shares them in none of the sets of orders
BLOCK, BLOCK_SHINGLES = 1500, 2_000_000  # members of a candidate group, and their shingles, compared in one task
BROADCAST_ROWS = 50_000
SALT = np.uint64(0x5851F42D4C957F2D)


def orders(num: int, den: int) -> np.ndarray:
    """Odd factors, one per global token order (a token's rank is its hash times the factor): TOGETHER times as many as make
    a miss at the least similarity as unlikely as MISS."""
    sets = max(1, int(np.ceil(np.log(MISS) / np.log(1 - min(0.999, num / den) ** TOGETHER))))
    return mix(np.arange(1, sets * TOGETHER + 1, dtype=np.uint64) * SALT) | np.uint64(1)


def order_keys(s: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """For each set of TOGETHER orders the hash of the set's first tokens (prefixes of one) under them."""
    first = np.full(len(factors), np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(s), 4096):
        first = np.minimum(first, np.multiply.outer(factors, s[at: at + 4096]).min(axis=1))
    rows = mix(first).reshape(-1, TOGETHER)
    key = np.arange(1, len(rows) + 1, dtype=np.uint64)
    for j in range(TOGETHER):
        key = mix(key * SALT + rows[:, j])
    return key


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    one, two = mix(s ^ SALT), mix(s + SALT)
    return int(one.sum(dtype=np.uint64).astype(np.int64)), int(two.sum(dtype=np.uint64).astype(np.int64))


def shingle_features(docs: DataFrame, id_col: str, text_col: str, k: int, factors: np.ndarray) -> DataFrame:
    """(id, th, n, f1, f2, keys): hash of the text, set size, fingerprints (f1 names the set as a node) and candidate keys."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(len(s), *fingerprint(s), (order_keys(s, factors) if len(s) else s).view(np.int64)) for s in shingle_sets(pdf["t"].tolist(), k)]
            yield pdf[["i", "nil", "th"]].reset_index(drop=True).join(pd.DataFrame(out, columns=["n", "f1", "f2", "keys"]))

    named = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"))
    named = named.select(F.coalesce("i", F.lit(0)).alias("i"), F.col("i").isNull().alias("nil"), F.xxhash64("t").alias("th"), "t")
    found = named.mapInPandas(run, "i long, nil boolean, th long, n long, f1 long, f2 long, keys array<long>")
    return found.select(F.when(~F.col("nil"), F.col("i")).alias("id"), "th", "n", "f1", "f2", "keys")  # pandas has no null among integers


POSTING = "edge boolean, key long, node long"


def combine(key: np.ndarray, node: np.ndarray) -> pd.DataFrame:
    """Postings of a task: nodes that share a key are joined to the smallest of their component here, and one row per
    key goes on, which names that smallest node."""
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    same = np.concatenate([[False], key[1:] == key[:-1]])
    at = np.flatnonzero(same & np.concatenate([[False], node[1:] != node[:-1]]))
    pairs = np.unique(np.stack([node[at], node[at - 1]], axis=1), axis=0) if len(at) else np.empty((0, 2), np.int64)
    forest = pd.concat([pd.DataFrame({"a": [], "b": []}, dtype=np.int64), *local_forest(iter([pd.DataFrame(pairs, columns=["a", "b"])]))])
    up = dict(zip(forest["a"].tolist(), forest["b"].tolist()))
    edges = forest[forest["a"] != forest["b"]]
    key, node = key[~same], node[~same]
    if up:
        node = np.array([up.get(x, x) for x in node.tolist()], np.int64)
    return pd.DataFrame({"edge": np.repeat([False, True], [len(key), len(edges)]),
                         "key": np.concatenate([key, edges["a"].to_numpy(np.int64)]), "node": np.concatenate([node, edges["b"].to_numpy(np.int64)])})


def shared_token_links(postings: DataFrame) -> DataFrame:
    """(a, b) links that connect all nodes of each key: neighbours in the key's sorted rows, contracted in each task. Rows were
    combined in each task before, so a key that a third of all documents hold has one row per task."""
    def neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for pdf in batches:
            edge, key, node = pdf["edge"].to_numpy(), pdf["key"].to_numpy(), pdf["node"].to_numpy()
            a, b = [key[edge]], [node[edge]]
            key, node = key[~edge], node[~edge]
            if last is not None and len(key):
                key, node = np.concatenate([[last[0]], key]), np.concatenate([[last[1]], node])
            if len(key):
                at = np.flatnonzero((key[1:] == key[:-1]) & (node[1:] != node[:-1]))
                a.append(node[at + 1]), b.append(node[at])
                last = key[-1], node[-1]
            yield pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return local_forest(neighbours(batches))

    return postings.repartition("key").sortWithinPartitions("edge", "key", "node").mapInPandas(run, "a long, b long")


def key_postings(feats: DataFrame) -> DataFrame:
    """Postings (key, node) of all candidate keys, combined in each task."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, nodes, size = [], [], 0
        for pdf in batches:
            if not len(pdf):
                continue
            keys.append(np.concatenate(pdf["keys"].to_numpy()))
            nodes.append(np.repeat(pdf["f1"].to_numpy(), pdf["keys"].map(len)))
            size += len(keys[-1])
            if size > 2_000_000:
                yield combine(np.concatenate(keys), np.concatenate(nodes))
                keys, nodes, size = [], [], 0
        if size:
            yield combine(np.concatenate(keys), np.concatenate(nodes))

    return feats.filter("n > 0").select("f1", "keys").mapInPandas(run, POSTING)


def _verify(ids, comp, sets, keys, block, first, second, num, den) -> list[tuple[int, int]]:
    """Links of a candidate group that join its members: for each member, those not yet connected with it that
    agree under some set of orders are compared with it exactly."""
    m = len(ids)
    ns = np.array([len(s) for s in sets])
    block = np.asarray(block)
    root = np.unique(comp, return_inverse=True)[1]
    values, rank = np.unique(np.concatenate(sets), return_inverse=True)
    at = np.concatenate([[0], np.cumsum(ns)])
    flag = np.zeros(len(values), bool)
    links = []
    for i in range(m - 1):
        may = (root != root[i]) & (num * np.maximum(ns, ns[i]) <= den * np.minimum(ns, ns[i]))
        may[: i + 1] = False
        if first != second:
            may &= block != block[i]
        picked = np.flatnonzero(may)
        picked = picked[(keys[picked] == keys[i]).any(axis=1)]
        if not len(picked):
            continue
        own = rank[at[i]: at[i + 1]]
        flag[own] = True
        both = np.array([np.count_nonzero(flag[rank[at[j]: at[j + 1]]]) for j in picked])
        flag[own] = False
        for j in picked[den * both >= num * (ns[i] + ns[picked] - both)]:
            links.append((ids[i], ids[j]))
            if root[j] != root[i]:
                root[root == root[j]] = root[i]
    return links


def verified_links(rows: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(a, b) over rows (grp, first, second, node, comp, block, t), a task's groups one after the other."""
    factors = orders(num, den)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held = None, {}

        def close():
            if len(held) < 2:
                return None
            named = zip(held, shingle_sets([x[2] for x in held.values()], k))
            real = {x: s for x, s in named if len(s)}
            if len(real) < 2:
                return None
            found = _verify(list(real), [held[x][0] for x in real], list(real.values()), np.stack([order_keys(s, factors) for s in real.values()]),
                            [held[x][1] for x in real], key[1], key[2], num, den)
            return pd.DataFrame(found, columns=["a", "b"]) if found else None

        for pdf in batches:
            for r in pdf.itertuples(index=False, name=None):
                if r[:3] != key:
                    out = close()
                    if out is not None:
                        yield out
                    key, held = r[:3], {}
                held[r[3]] = r[4:]
        out = close()
        if out is not None:
            yield out

    keys = ["grp", "first", "second"]
    return (rows.select(*keys, "node", "comp", "block", "t").repartition(*keys).sortWithinPartitions(*keys)
            .mapInPandas(run, "a long, b long"))


def in_blocks(members: DataFrame) -> DataFrame:
    """Members (node, grp, n, ...) with the block of each and how many blocks its group has."""
    sizes = members.groupBy("grp").agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    return members.join(sizes, "grp").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))


def group_links(members: DataFrame, texts: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(id, component) over all members (node, grp, n, rep, th) that are linked. First each block by itself, then one member
    of each component, then, where a group of several blocks still has several components, all pairs of blocks."""
    def check(rows: DataFrame) -> DataFrame:
        few = rows.count() <= BROADCAST_ROWS
        return verified_links(texts.join(F.broadcast(rows) if few else rows, ["rep", "th"]), k, num, den)

    own = lambda rows: rows.withColumn("first", F.col("block")).withColumn("second", F.col("block"))
    placed = cut(in_blocks(members).withColumn("comp", F.col("node")))
    links = cut(check(own(placed)))
    known = components(links)
    wide = placed.filter("blocks > 1").drop("comp", "block", "blocks")
    for last in (False, True):
        if not wide.limit(1).count():
            return known
        now = (wide.join(known.withColumnRenamed("id", "node"), "node", "left")
               .withColumn("comp", F.coalesce("component", "node")).drop("component"))
        parts = now.groupBy("grp").agg((F.min("comp") < F.max("comp")).alias("open")).filter("open").select("grp")
        now = cut(now.join(parts, "grp", "left_semi"))
        if not now.limit(1).count():
            return known
        if last:
            rows = in_blocks(now)
            rows = rows.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            rows = cut(rows.withColumn("first", F.least("block", "o")).withColumn("second", F.greatest("block", "o")).filter("first < second"))
        else:
            heads = now.groupBy("comp").agg(F.min("node").alias("node")).select("node")
            rows = cut(own(in_blocks(now.join(heads, "node", "left_semi"))))
        more = cut(check(rows))
        if more.limit(1).count():
            links = links.union(more)
            known = components(links)
    return known


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                       num: int = 80, den: int = 100) -> DataFrame:
    """Group documents whose word-shingle sets have a Jaccard similarity of num/den or more.

    Returns (id, n_shingles, component_id): the size of the row's shingle set and the smallest id reachable by
    links, itself included. Words are runs of bytes other than space and tab to carriage return, A-Z lower-cased;
    with fewer than ``shingle`` words the whole sequence is the one shingle. Texts without words, null and empty
    ones, are linked with nothing. A null id has a null component; rows that repeat an id, with whatever texts, count as one
    document for the component (each row keeps the size of its own set).
    Shingles are compared by 64-bit hashes.

    Method: (1) tokens are ranked under many global orders; a pair of documents is a candidate if it shares the prefix
    token under TOGETHER different orders at the same time, for some of the sets of orders. There are so many sets
    that a pair at the least similarity fails all of them with a chance of MISS, 1e-12, more alike pairs less still. (2) Equal sets
    are one node, named by a fingerprint; (3) nodes that agree form groups: each task links what it holds of a key and
    passes one row on, so neither copies nor frequent keys pile up; (4) texts of groups of two or more go to their
    group and pairs that agree are compared exactly, pairs already connected excepted. Large groups are
    compared in blocks of bounded size (see ``group_links``). No pair of documents is ever a row but for links that join
    parts. The text table is joined by broadcast only below BROADCAST_ROWS members, counted before.
    """
    feats = cut(shingle_features(docs, id_col, text_col, shingle, orders(num, den)))
    some = feats.filter("n > 0 and id is not null")
    classes = some.groupBy("f1", "f2", "n").agg(F.min(F.struct("id", "th")).alias("r")).select("f1", "f2", "n", F.col("r.id").alias("rep"), F.col("r.th").alias("th"))
    texts = docs.select(F.col(id_col).cast("long").alias("rep"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("t")).filter("rep is not null")
    groups = components(shared_token_links(key_postings(feats)), contracted=True).filter("id is not null")
    members = classes.join(groups.select(F.col("id").alias("f1"), F.col("component").alias("grp")), "f1").select(F.col("f1").alias("node"), "grp", "n", "rep", "th")
    links = group_links(members, texts, shingle, num, den)
    # rows of one id with different texts are one document: their classes are linked
    several = some.groupBy("id").agg(F.min("f1").alias("least"), F.max("f1").alias("most")).filter("least < most").select("id", "least")
    again = cut(some.join(several, "id").select(F.col("f1").alias("a"), F.col("least").alias("b")).distinct())
    known = components(links.select(F.col("id").alias("a"), F.col("component").alias("b")).union(again)) if again.limit(1).count() else links
    ids = classes.join(known.select(F.col("id").alias("f1"), "component"), "f1", "left").withColumn("component", F.coalesce("component", "f1"))
    least = ids.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = (ids.join(least, "component").select(F.col("f1").alias("c1"), F.col("f2").alias("c2"), F.col("n").alias("cn"), "component_id"))
    out = feats.drop("keys", "th").join(named, (F.col("f1") == F.col("c1")) & (F.col("f2") == F.col("c2")) & (F.col("n") == F.col("cn")), "left")
    own = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select("id", F.col("n").alias("n_shingles"), own.alias("component_id"))
