"""Mixing to target weights: predicted soft domains and document rates by projected gradient."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, list_array, with_columns
from .textvec import CHUNK, mix, pieces, word_hashes

DOMAINS = ["good", "low", "toxic"]
TARGETS = {"good": 0.9, "low": 0.1, "toxic": 0.0}
BITS, SAMPLE_ROWS, MIN_CHI2, MAX_FEATURES = 18, 8000, 12.0, 4000
RIDGE, STEPS, TOLERANCE = 0.0005, 40, 1e-5


def features(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(index of the first text, hashed places, the text of each place counted from the first, words of each text) in
    bounded runs. A text's places are the distinct hashes of its lower-cased words and of their last two bytes."""
    for first, run in pieces(texts, CHUNK // 2):
        words, at = word_hashes(run)
        owner = np.repeat(np.arange(len(run), dtype=np.uint64), np.diff(at))
        blob = np.frombuffer(b"\n".join(run) + b"\n", np.uint8)
        space = (blob == 32) | ((blob >= 9) & (blob <= 13))
        ends = np.flatnonzero(space & ~np.concatenate([[True], space[:-1]])) - 1
        tail = (blob[ends].astype(np.uint64) << np.uint64(8) | blob[np.maximum(ends - 1, 0)].astype(np.uint64)) + np.uint64(1 << 40)
        shift = np.uint64(64 - BITS)
        both = np.concatenate([owner << np.uint64(BITS) | words >> shift, owner << np.uint64(BITS) | mix(tail) >> shift])
        distinct = np.unique(both)
        yield first, (distinct & np.uint64((1 << BITS) - 1)).astype(np.int64), (distinct >> np.uint64(BITS)).astype(np.int64), np.diff(at)


@dataclass
class Classifier:
    """Multinomial logistic regression over presence of chosen places."""

    slot: np.ndarray  # place -> chosen feature, or the last one, whose weights are nil
    weights: np.ndarray

    def scores(self, places: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        at = self.slot[places]
        use = at < len(self.weights) - 2
        out = np.tile(self.weights[-1], (n, 1))
        for k in range(out.shape[1]):
            out[:, k] += np.bincount(owner[use], self.weights[at[use], k], minlength=n)
        return out


def softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit_classifier(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS) -> Classifier:
    """Fit on about ``rows`` labelled documents picked by hash (a bounded sample, the parameter): places
    whose presence goes with a domain (chi-square of MIN_CHI2 or more) are kept, then weighted by regression."""
    named = labels.select(F.col("doc_id").alias("__l"), F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 1, 0).when(F.col("quality") == 0, 1).alias("__y")).filter("__y is not null")
    share = min(1.0, rows / max(1, named.count()))
    picked = named.filter(F.pmod(F.xxhash64("__l"), F.lit(1_000_003)) < int(share * 1_000_003) + 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for first, places, owner, words in features(pdf["t"].tolist()):
                ends = np.searchsorted(owner, np.arange(len(words) + 1))
                yield pd.DataFrame({"y": pdf["y"].to_numpy()[first: first + len(words)],
                                    "x": [places[s:e].astype(np.int32).tobytes() for s, e in zip(ends, ends[1:])]})

    sample = (docs.select(F.col(id_col).alias("d"), F.col(text_col).alias("t")).join(picked, F.col("d") == F.col("__l"))
              .select("t", F.col("__y").alias("y")).mapInPandas(run, "y int, x binary").limit(2 * rows).toPandas())
    k = len(DOMAINS)
    slot = np.full(1 << BITS, 0)
    if not len(sample):
        return Classifier(slot, np.zeros((2, k)))
    x = [np.frombuffer(b, np.int32) for b in sample["x"]]
    y = np.eye(k)[sample["y"].to_numpy()]
    owner = np.repeat(np.arange(len(x)), [len(v) for v in x])
    flat = np.concatenate(x)
    n, total = len(x), np.bincount(flat, minlength=1 << BITS).astype(float)
    chi = np.zeros(1 << BITS)
    for j in range(k):
        have = np.bincount(flat, y[owner, j], minlength=1 << BITS)
        p = y[:, j].mean()
        if 0 < p < 1:
            spread = total * p * (1 - p) * (1 - total / n)
            chi = np.maximum(chi, np.where((spread > 0) & (total >= 3), (have - total * p) ** 2 / np.maximum(spread, 1e-9), 0))
    chosen = np.argsort(-chi, kind="stable")[:MAX_FEATURES]
    chosen = chosen[chi[chosen] >= MIN_CHI2]
    f = len(chosen)
    slot[:] = f
    slot[chosen] = np.arange(f)
    at = slot[flat]
    use = at < f
    at, own = at[use], owner[use]
    w, square = np.zeros((f + 2, k)), np.full((f + 2, k), 1e-6)
    w[-1] = np.log(y.mean(0) + 1e-3)
    best = w
    for _ in range(150):  # full-batch steps scaled by the running sum of squares
        miss = (softmax(w[-1] + np.stack([np.bincount(own, w[at, j], minlength=n) for j in range(k)], axis=1)) - y) / n
        g = np.zeros_like(w)
        for j in range(k):
            g[:f, j] = np.bincount(at, miss[own, j], minlength=f)[:f]
        g[-1] = miss.sum(0)
        g[:f] += 1e-4 * w[:f]
        square += g * g
        w = w - 0.5 * g / np.sqrt(square)
        best = w
    return Classifier(slot, best)


def posteriors(docs: DataFrame, model: Classifier, carry: dict[str, Column], text_col: str = "text") -> DataFrame:
    """Carried columns, plus tokens (words) and p (domain posteriors, in the order of DOMAINS)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # MAX_FEATURES weights and a table of 2 ** BITS places

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = np.zeros(len(batch), np.int64)
            p = np.zeros((len(batch), len(DOMAINS)))
            for first, places, owner, words in features(batch.column("__t").to_pylist()):
                tokens[first: first + len(words)] = words
                p[first: first + len(words)] = softmax(shared.value.scores(places, owner, len(words)))
            yield with_columns(batch.drop_columns(["__t"]), tokens=pa.array(tokens), p=list_array(np.round(p, 6)))

    kept = docs.select(*[c.alias(n) for n, c in carry.items()], F.col(text_col).alias("__t"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields if f.name != "__t")
    return kept.mapInArrow(run, schema + ", tokens long, p array<double>")


def fit_rates(scored: DataFrame, targets: dict[str, float]) -> tuple[Column, list[dict]]:
    """The rate of a row as an expression of ``p``, and the residuals of each step.

    Minimises, over rates r >= 0,
        1/2 sum_k ((sum_d r_d w_d p_dk - T_k) / W)^2 + RIDGE / 2 sum_d (w_d / W) (r_d - 1)^2,
    w being tokens and W their sum. The gradient by a row's rate, in that row's weight, is p_d . c + RIDGE (r_d - 1) with the
    residuals c = (sum - T) / W, one number per domain. Each step is one distributed aggregation; rates are not stored: every iterate
    is 1 + p_d . u projected to its bound, where u gathers the steps so far. Steps are scaled by the inverse of the
    K x K matrix sum w p p' / W over rows with a rate above zero (summed in the same pass) and halved while they do not help.
    """
    k = len(DOMAINS)
    weight = sum(targets.get(d, 0.0) for d in DOMAINS)
    goal = np.array([targets.get(d, 0.0) / weight for d in DOMAINS])
    raw = lambda u: F.lit(1.0) + sum((F.col("p")[j] * float(u[j]) for j in range(k)), F.lit(0.0))
    rate = lambda u: F.greatest(F.lit(0.0), raw(u))
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0.0))

    def residual(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = F.col("tokens").cast("double")
        free = F.when(raw(u) > 0, w).otherwise(0.0)
        sums = [zero(w), *[zero(rate(u) * w * F.col("p")[j]) for j in range(k)]]
        sums += [zero(free * F.col("p")[i] * F.col("p")[j]) for i in range(k) for j in range(k)]
        row = np.array(list(scored.agg(*[c.alias(f"c{i}") for i, c in enumerate(sums)]).first()), float)
        total = row[0] or 1.0
        return row[1: k + 1] / total - goal + RIDGE * u, row[k + 1:].reshape(k, k) / total

    u = np.zeros(k)
    g, gram = residual(u)
    history = [{"step": 0, **dict(zip(DOMAINS, map(float, g - RIDGE * u)))}]
    scale = 1.0
    while len(history) < STEPS and np.abs(g).max() > TOLERANCE and scale > 1e-3:
        new = u - scale * np.linalg.solve(gram + RIDGE * np.eye(k), g)
        near, held = residual(new)
        if np.linalg.norm(near) < np.linalg.norm(g):
            u, g, gram, scale = new, near, held, min(1.0, 2 * scale)
        else:
            scale /= 2
        history.append({"step": len(history), **dict(zip(DOMAINS, map(float, g - RIDGE * u)))})
    return rate(u), history


def mix_documents(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text",
                  carry: dict[str, Column] | None = None) -> DataFrame:
    """Carried columns (the id) plus tokens, p_good, p_low, p_toxic, rate of each document and worst_residual.

    A classifier fitted on labelled rows predicts soft domain memberships; nonnegative rates are fitted so that the expected
    tokens of each domain, sum of rate * tokens * posterior, match the target shares of all tokens, while
    rates keep near one (see ``fit_rates``). A rate is how often a document enters the mix on average, without an upper bound; those at zero are
    out. ``worst_residual``, the same in all rows, is the largest difference of a domain's expected share and its target. Null or
    empty texts have no tokens and get the rate of their prior; rows that repeat share one rate; without labels
    all domains are equally likely. Every step aggregates a few numbers over all rows.
    """
    model = fit_classifier(docs, labels, id_col, text_col)
    carry = carry or {"doc_id": F.col(id_col)}
    scored = cut(posteriors(docs, model, carry, text_col))
    rate, history = fit_rates(scored, targets or TARGETS)
    worst = max(abs(history[-1][d]) for d in DOMAINS)
    return scored.select(*carry, "tokens", *[F.col("p")[j].alias("p_" + d) for j, d in enumerate(DOMAINS)], F.round(rate, 4).alias("rate"),
                         F.lit(round(worst, 6)).alias("worst_residual"))
