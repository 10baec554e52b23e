"""Spelling variants against comparing all words with all."""

import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from strataspark.llm import queries, spelling


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(words, times=5):
    near = {w: [v for v in words if one_edit(v, w)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= times * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def made_words(seed, n, letters="abcé", long=True):
    r = random.Random(seed)
    words = {}
    while len(words) < n:
        w = "".join(r.choice(letters) for _ in range(r.randint(6, 9)))
        words[w] = r.choice((5, 6, 24, 25, 30, 125, 1000))
        if r.random() < 0.5:  # a copy with an edit
            i = r.randrange(len(w))
            words[w[:i] + r.choice(("", "a", "b" + w[i])) + w[i + 1:]] = r.randint(5, 200)
    if long:
        base = "x" * 3000 + "y" + "z" * 2000
        words |= {base: 500, base[1:]: 5, base[:-1] + "q": 20, base + "z": 5, base[:2000] + "k" + base[2001:]: 101}
    return {w: n for w, n in words.items() if len(w) >= 6}


@pytest.mark.parametrize("group", [3, 500])
def test_all_pairs_and_roots(spark, monkeypatch, group):
    monkeypatch.setattr(spelling, "GROUP", group)
    words = made_words(group, 700)
    rows = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    got = sorted(map(tuple, spelling.spelling_variants(rows).collect()))
    assert got == plain(words)
    assert any(r[1] and r[2] != r[1] for r in got)  # chains of forms


def test_a_common_half_is_split_until_groups_are_small(spark, monkeypatch):
    monkeypatch.setattr(spelling, "GROUP", 20)
    r = random.Random(1)
    words = {"common" + "".join(r.choice("abcdefgh") for _ in range(6)): r.randint(5, 60) for _ in range(900)}
    rows = spark.createDataFrame(list(words.items()), "word string, n long")
    assert sorted(map(tuple, spelling.spelling_variants(rows).collect())) == plain(words)


def test_words_are_counted_and_damaged(spark):
    texts = {1: "Hello WORLDS hello-world's Élan élanvital ÉLANVITAL " * 9, 2: "abcdef " * 5 + "abcde " * 9 + "abcĀdefghi", 3: None, 4: "", 5: "étéétéété×÷ÿÿ " * 6}
    texts |= {i: "variant sixsix " for i in range(10, 1500)}
    rows = [(i, t, "x", 1) for i, t in texts.items()] + [(None, "nobody " * 5, "y", 2), (2, texts[2], "again", 3)]
    counts = Counter()
    for i, t, *_ in rows:
        run = ""
        for ch in (t or "") + " ":
            if "A" <= ch <= "Z" or "a" <= ch <= "z" or "À" <= ch <= "ÿ":
                run += ch.lower() if ch < "\x80" else ch
                continue
            if len(run) >= 6:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                word = run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run
                if len(word) >= 6:
                    counts[word] += 1
            run = ""
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string, n int")
    got = {r.word: r.n for r in spelling.count_words(docs, F.col("text"), F.col("doc_id")).collect()}
    assert got == {w: n for w, n in counts.items() if n >= 5}
    assert len(got) > 6 and any(len(w) == 6 and w not in ("nobody", "abcdef", "sixsix") for w in got)  # damaged ones are among them


def test_ties_and_empty(spark):
    none = spark.createDataFrame([], "word string, n long")
    assert spelling.spelling_variants(none).count() == 0
    words = {"kitten": 5, "kittan": 25, "kittbn": 25, "alone!": 7}
    got = {r.word: (r.form, r.root, r.n_near, r.form_n) for r in spelling.spelling_variants(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    assert got["kitten"] == ("kittan", "kittan", 2, 25) and got["alone!"] == (None, "alone!", 0, None)


def test_query_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op12_spelling_variants(spark, str(tmp_path)).count() == 0
