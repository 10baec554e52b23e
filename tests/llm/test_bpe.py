"""Byte-level BPE against merging pair after pair."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F
from strataspark.llm import bpe, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load_vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def merged(ranks, piece):
    """The plain algorithm: merge the pair of least rank, the leftmost first, until none is left."""
    parts = [bytes([b]) for b in piece]
    if piece in ranks:
        return [ranks[piece]]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        i = min(pairs)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def plain(vocabulary, text):
    return [t for piece in regex.findall(vocabulary.pattern, text or "") for t in merged(vocabulary.ranks, piece.encode())]


def odd_texts():
    r = random.Random(3)
    bits = ["a", "b", "the", "ing", " ", "  ", "\n", " \n", "\t", "'s", "'ll", "é", "ß", "1", "22", "!", "??", "中", " ", "\x1c", " ", "🙂", "é", "x" * 70, "=" * 130]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 30))) for _ in range(300)]
    texts += ["".join(chr(r.randint(97, 101)) for _ in range(r.randint(0, 120))) for _ in range(150)]
    return [None, "", " ", "\n\n", "ab" * 900, *texts]


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_ids_are_those_of_merging(name):
    v = bpe.load_vocabulary(public_tokenizers.path(name), public_tokenizers.PATTERN)
    encoder, whole = bpe.SpacedEncoder(v), bpe.Encoder(v)
    for text in odd_texts()[1:]:
        want = plain(v, text)
        assert np.frombuffer(encoder.encode(text), np.int32).tolist() == want, text[:80]
        assert np.frombuffer(whole.encode(text), np.int32).tolist() == want


def test_agrees_with_the_library_on_every_code_point(vocabulary):
    import tiktoken
    library = tiktoken.Encoding("own", pat_str=vocabulary.pattern, mergeable_ranks=vocabulary.ranks, special_tokens={})
    encoder = bpe.SpacedEncoder(vocabulary)
    for c in [*range(0x3100), *range(0x3100, 0xD800, 37), *range(0xE000, 0x110000, 97)]:
        text = f"a{chr(c)}b {chr(c)} 1{chr(c)}{chr(c)}"
        assert np.frombuffer(encoder.encode(text), np.int32).tolist() == library.encode_ordinary(text), hex(c)


def walks(encoder):
    """Counts the pieces that are walked one by one."""
    one, calls = encoder.piece, []
    encoder.piece = lambda data: calls.append(data) or one(data)
    return calls


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
@pytest.mark.parametrize("kind", ["SpacedEncoder", "Encoder"])
def test_new_pieces_are_encoded_together(name, kind):
    v = bpe.load_vocabulary(public_tokenizers.path(name), public_tokenizers.PATTERN)
    encoder = getattr(bpe, kind)(v)
    r = random.Random(7)
    words = ["".join(r.choice("abeinorstéß") for _ in range(r.randint(1, 14))) + r.choice(["", "", ".", "'s", ",\n", "7"]) for _ in range(1500)]
    texts = [" ".join(words[i:i + 50]) for i in range(0, len(words), 50)]
    calls = walks(encoder)
    assert encoder.encode_all(pa.array(texts)).to_pylist() == [plain(v, t) for t in texts]
    assert len(calls) <= len(texts)  # first words at most
    for some in (odd_texts()[1:], ["a  b", "c \u3000d", " ", "", "e \x1cf", "x "] * 20, [""], []):
        assert encoder.encode_all(pa.array(some, pa.string())).to_pylist() == [plain(v, t) for t in some]


def test_dead_ends_and_whole_tokens_together(tmp_path):
    import base64
    tokens = [bytes([b]) for b in range(256)] + [b"ab", b"ba", b"abab", b"aba", b"bb", b"abb", b"babab", b"bbbbb"]
    path = tmp_path / "small.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for r, t in enumerate(tokens)))
    v = bpe.load_vocabulary(str(path), r"\S+|\s+")
    assert 263 not in v.halves  # never made by merging
    encoder = bpe.Encoder(v)
    r = random.Random(5)
    pieces = ["".join(r.choice("ab") for _ in range(r.randint(1, 40))) for _ in range(3000)] + ["bbbbb", "é"]
    calls = walks(encoder)
    assert [np.frombuffer(x, np.int32).tolist() for x in encoder.together(pieces)] == [plain(v, p) for p in pieces] and not calls


def test_a_small_vocabulary_with_many_dead_ends():
    ranks = {bytes([b]): b for b in range(256)} | {t: 256 + i for i, t in enumerate([b"ab", b"ba", b"abab", b"aba", b"bb", b"abb", b"babab"])}
    halves = {}
    import base64
    import tempfile
    with tempfile.NamedTemporaryFile("wb", suffix=".tiktoken") as f:
        f.write(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in ranks.items()))
        f.flush()
        v = bpe.load_vocabulary(f.name, r"\S+|\s+")
    halves = {t: v.halves.get(r) for t, r in ranks.items()}
    assert halves[b"abab"] == (256, 256)
    r = random.Random(5)
    encoder = bpe.Encoder(v)
    for _ in range(3000):
        text = "".join(r.choice("ab") for _ in range(r.randint(1, 40)))
        assert np.frombuffer(encoder.encode(text), np.int32).tolist() == plain(v, text), text


def test_a_vocabulary_without_all_bytes_is_refused(tmp_path):
    (tmp_path / "x").write_bytes(b"YQ== 0\n")
    with pytest.raises(ValueError):
        bpe.load_vocabulary(str(tmp_path / "x"), r"\S+")


def test_memory_of_words_stays_bounded(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_ENTRIES", 50)
    monkeypatch.setattr(bpe, "MEMO_WORDS", 50)
    encoder = bpe.SpacedEncoder(vocabulary)
    text = " ".join(f"word{i} {'y' * i}" for i in range(400))
    assert np.frombuffer(encoder.encode(text), np.int32).tolist() == plain(vocabulary, text)
    assert len(encoder.words) <= 50 and len(encoder.pieces) <= 50 and len(encoder.known) <= 50


def test_round_trip_and_edge_cases(spark, vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "BATCH_IDS", 500)
    rows = [(i, t, "kept") for i, t in enumerate(odd_texts()[:120])] + [(None, "twice", None), (None, "twice", None), (7, "x " * 50_000, "long")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    ids = bpe.encode(docs, vocabulary, carry={"doc_id": F.col("doc_id"), "word": F.col("ids")})
    got = bpe.decode(ids, vocabulary).collect()
    assert sorted(((r.doc_id or -1), r.word or "", bytes(r.decoded).decode(), tuple(r.ids)) for r in got) == sorted(
        ((d or -1), w or "", t or "", tuple(plain(vocabulary, t))) for d, t, w in rows)
    none = bpe.decode(bpe.encode(docs.limit(0), vocabulary), vocabulary)
    assert none.count() == 0 and none.columns == ["doc_id", "ids", "decoded"]
    held = spark.createDataFrame([(1, None), (2, []), (3, [64, 65])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded and bytes(r.decoded) for r in bpe.decode(held, vocabulary).collect()} == {1: None, 2: b"", 3: b"ab"}


def test_query_digests(spark, vocabulary):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.op11_bpe_codec(spark, SF).collect()
    assert len(got) == len(docs)
    digest = lambda b: hashlib.sha256(b).hexdigest()
    for r in got:
        ids = plain(vocabulary, docs[r.doc_id]) if len(docs[r.doc_id] or "") < 5000 else None
        if ids is not None:
            assert (r.n_tokens, r.ids_sha256) == (len(ids), digest(" ".join(map(str, ids)).encode()))
        assert r.decoded_sha256 == digest((docs[r.doc_id] or "").encode())


def test_encodes_and_decodes_in_one_worker(spark, vocabulary):
    plan = queries.op11_bpe_codec(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(odd_texts())], "doc_id long, text string")
    for spaced in (True, False):
        one = bpe.encode(rows, vocabulary, spaced=spaced, decoded=True)
        two = bpe.decode(bpe.encode(rows, vocabulary, spaced=spaced), vocabulary)
        assert sorted(one.collect()) == sorted(two.collect())
        assert {r.doc_id: bytes(r.decoded).decode() for r in one.collect()} == {i: t or "" for i, t in enumerate(odd_texts())}
