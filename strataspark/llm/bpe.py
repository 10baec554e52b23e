"""Byte-level BPE encoding and decoding by backtracking over longest matches.

A text is cut into pieces by the tokenizer's pattern; a piece's bytes are read as Latin-1, so that an Aho-Corasick automaton
over strings finds the longest token at every byte. Tokens are then laid one after the other: the longest that is compatible with the
token before it, else a shorter prefix, else the last one is taken back and its end is marked as dead. A piece has one sequence of pairwise
compatible tokens only, and that is the one the merges yield, so the ids are those of merging pair after pair; as an end is marked once at
most, work is linear in the piece. Pieces met for the first time are laid side by side, many at a time: each step of the walk is one
numpy expression over all of them.

Null texts count as empty: no ids, no bytes. Rows are independent: repeated rows give repeated results, an empty table an empty one, and
columns besides the text take part only if ``carry`` names them.
"""

from __future__ import annotations

import base64
import gc
import re
import uuid
from array import array
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEMO_ENTRIES = 300_000  # of pieces, and of pairs of tokens, that a worker remembers at once
MEMO_WORDS = 800_000  # and of words with what stands beside them
MEMO_CHARS = 64  # longer pieces are encoded without being remembered
BATCH_IDS = 2_000_000  # ids of a record batch that is handed on
RUN_BYTES = 1 << 22  # of texts that are encoded together
PAIR_BITS = 20  # of the table of pairs of tokens that are looked up together
FEW = 64  # pieces that are not worth numpy expressions


@dataclass
class Vocabulary:
    """A rank file: ``ranks`` of byte strings; a token's two ``halves`` as the merges make it, None for single bytes. Tokens that merging never makes
    from their own bytes have no halves and stand only for a whole piece."""

    ranks: dict[bytes, int]
    halves: dict[int, tuple[int, int] | None]
    pattern: str


def load_vocabulary(path: str, pattern: str) -> Vocabulary:
    """Read a file of base64 tokens with ranks, on the driver; a vocabulary's size does not depend on the data."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    missing = 256 - sum(bytes([b]) in ranks for b in range(256))
    if missing:
        raise ValueError(f"{path}: {missing} of the 256 bytes have no rank, so that not every text can be encoded")
    names = {rank: token for token, rank in ranks.items()}
    halves: dict[int, tuple[int, int] | None] = {ranks[bytes([b])]: None for b in range(256)}
    fits = compatibility(ranks, names, halves)
    for rank in sorted(names):
        token = names[rank]
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and b is not None and a in halves and b in halves and (halves[a] is None or a < rank) and (halves[b] is None or b < rank) and fits(a, b, rank):
                halves[rank] = (a, b)
                break
    return Vocabulary(ranks, halves, pattern)


def compatibility(ranks: dict[bytes, int], names: dict[int, bytes], halves: dict[int, tuple[int, int] | None]) -> Callable[..., bool]:
    """A test whether merging leaves tokens ``a`` and ``b`` side by side: their merges are undone from the last to the first, and at no time may
    the two parts that touch be a pair that would have been merged earlier. Equal ranks are merged from the left."""
    order = lambda t: -1 if halves[t] is None else t  # noqa: E731  when a token came to be; bytes are there from the start

    def fits(a: int, b: int, before: int | None = None) -> bool:
        limit = before  # a merge across the border counts if its rank is below this
        while True:
            joined = ranks.get(names[a] + names[b])
            if joined is not None and (limit is None or joined < limit):
                return False
            if halves[a] is None and halves[b] is None:
                return True
            if order(a) > order(b):
                limit, a = a, halves[a][1]
            else:
                limit, b = b + 1, halves[b][0]

    return fits


class Memo(dict):
    """Results of ``make`` by string. When half of ``most`` are held they become the old half, from which strings that are met again are taken over; the old
    half before is forgotten. Long strings are not kept."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        super().__init__()
        self.make, self.half, self.old = make, most // 2, {}

    def __missing__(self, key: str) -> bytes:
        out = self.old.get(key)
        if out is None:
            out = self.make(key)
        if len(key) <= MEMO_CHARS:
            self.put(key, out)
        return out

    def put(self, key: str, out: bytes) -> None:
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[key] = out

    def put_all(self, keys: list[str], outs: list[bytes]) -> None:
        if len(self) + len(keys) <= self.half:
            self.update(zip(keys, outs))
        else:
            for key, out in zip(keys, outs):
                self.put(key, out)

    def unknown(self, keys: Iterable[str]) -> list[str]:
        """The distinct ones that would be made and kept."""
        return [k for k in set(keys) if k not in self and k not in self.old and len(k) <= MEMO_CHARS]


class Encoder:
    """Encodes texts to ids packed as 32-bit integers."""

    def __init__(self, vocabulary: Vocabulary):
        self.ranks = vocabulary.ranks
        names = {rank: token for token, rank in self.ranks.items()}
        made = sorted(vocabulary.halves)
        self.size = {t: len(names[t]) for t in made}
        self.shorter = {t: next((s for n in range(len(names[t]) - 1, 0, -1) if (s := self.ranks.get(names[t][:n])) in vocabulary.halves), -1) for t in made}
        self.matches = ahocorasick.Automaton()
        self.bytes = [self.ranks[bytes([b])] for b in range(256)]  # these need no automaton
        for t in made:
            if self.size[t] > 1:
                self.matches.add_word(names[t].decode("latin-1"), t)
        if len(self.matches):
            self.matches.make_automaton()
        self.fits = compatibility(self.ranks, names, vocabulary.halves)
        self.known: dict[tuple[int, int], bool] = {}
        self.split = regex.compile(vocabulary.pattern).findall
        self.letters = r"| ?\p{L}+|" in vocabulary.pattern
        self.pieces = Memo(lambda piece: array("i", self.piece(piece.encode())).tobytes(), MEMO_ENTRIES)
        span = max(self.ranks.values()) + 1
        self.sizes, self.shorters = np.zeros(span, np.int64), np.full(span, -1, np.int64)
        self.sizes[made], self.shorters[made] = [self.size[t] for t in made], [self.shorter[t] for t in made]
        self.whole_only = self.ranks.keys() - {names[t] for t in made}
        self.pairs = np.full(1 << PAIR_BITS, -1, np.int64)  # 2 * pair + whether it fits, at the pair's hashed place; one that is pushed out is in ``known``

    def compatible(self, a: int, b: int) -> bool:
        if len(self.known) >= MEMO_ENTRIES:
            self.known.clear()
        found = self.known[a, b] = self.fits(a, b)
        return found

    def found(self, data: str) -> Iterable[tuple[int, int]]:
        """(last place, token) of all tokens of two bytes or more."""
        return self.matches.iter(data) if len(self.matches) else ()

    def piece(self, data: bytes) -> list[int]:
        """The ids of one match of the pattern."""
        if (whole := self.ranks.get(data)) is not None:
            return [whole]
        n, size, known = len(data), self.size, self.known
        longest = list(map(self.bytes.__getitem__, data))
        for end, t in self.found(data.decode("latin-1")):
            longest[end - size[t] + 1] = t  # ends rise, so the longest comes last
        dead, path, at, t = bytearray(n + 1), [], 0, longest[0]
        while True:
            end = at + size[t]
            if not dead[end] and (not path or (fits := known.get((path[-1], t))) or fits is None and self.compatible(path[-1], t)):
                path.append(t)
                if end == n:
                    return path
                at, t = end, longest[end]
            elif self.shorter[t] >= 0:
                t = self.shorter[t]
            else:
                dead[at] = 1
                t = path.pop()
                at -= size[t]

    def compatible_all(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pair = a << 31 | b
        place = (pair.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - PAIR_BITS)
        held = self.pairs[place]
        fits = (held & 1).astype(bool)
        miss = np.flatnonzero(held >> 1 != pair)
        if len(miss):
            new, back = np.unique(pair[miss], return_inverse=True)
            found = [self.compatible(*k) if (f := self.known.get(k)) is None else f for k in zip((new >> 31).tolist(), (new & 0x7FFFFFFF).tolist())]
            fits[miss] = np.array(found)[back]
            self.pairs[place[miss]] = pair[miss] << 1 | fits[miss]
        return fits

    def together(self, pieces: list[str]) -> list[bytes]:
        """The packed ids of many pieces, none of them empty: ``piece`` for all at once. They stand in one string with a mark between
        them (UTF-8 has no byte 255); a place is one of that string."""
        if len(pieces) < FEW:
            return [array("i", self.piece(p.encode())).tobytes() for p in pieces]
        data = b"\xff".join(map(str.encode, pieces))
        byte = np.frombuffer(data, np.uint8)
        marks = np.flatnonzero(byte == 255)
        first, stop = np.concatenate([[0], marks + 1]), np.concatenate([marks, [len(data)]])
        found = np.fromiter(chain.from_iterable(self.found(data.decode("latin-1").replace("\xff", "\u0100"))), np.int64).reshape(-1, 2)
        longest = np.append(np.array(self.bytes)[byte], 0)
        longest[found[:, 0] - self.sizes[found[:, 1]] + 1] = found[:, 1]  # ends rise, so the longest comes last
        dead, upto = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, np.int64)  # upto: the path's token that ends at a place
        at, begin, end_of = first, first, stop
        t = longest[at]
        while len(at):
            end, inner = at + self.sizes[t], np.flatnonzero(at != begin)
            good = ~dead[end]
            inner = inner[good[inner]]
            good[inner] = self.compatible_all(upto[at[inner]], t[inner])
            upto[end[good]] = t[good]
            less = self.shorters[t]
            back = np.flatnonzero(~good & (less < 0))
            t = np.where(good, longest[end], less)
            dead[at[back]] = True
            t[back] = upto[at[back]]
            at = np.where(good, end, at)
            at[back] -= self.sizes[t[back]]
            more = at != end_of
            at, t, begin, end_of = at[more], t[more], begin[more], end_of[more]
        path = np.full(len(data) + 1, -1, np.int32)
        at, begin = stop, first
        while len(at):
            t = upto[at]
            at = at - self.sizes[t]
            path[at] = t
            more = at != begin
            at, begin = at[more], begin[more]
        used = path >= 0
        packed, ends = path[used].tobytes(), (4 * np.cumsum(used)[stop - 1]).tolist()
        out = [packed[a:b] for a, b in zip([0, *ends], ends)]
        if self.whole_only:
            for i, p in enumerate(pieces):
                if (token := p.encode()) in self.whole_only:
                    out[i] = array("i", [self.ranks[token]]).tobytes()
        return out

    def parts(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def encode(self, text: str) -> bytes:
        return self.parts(text)

    def encode_all(self, texts: pa.Array) -> pa.ListArray:
        """The ids of each text."""
        cut = list(map(self.split, texts.to_pylist()))
        new = self.pieces.unknown(chain.from_iterable(cut))
        self.pieces.put_all(new, self.together(new))
        return packed_lists([b"".join(map(self.pieces.__getitem__, c)) for c in cut])


class SpacedEncoder(Encoder):
    """For patterns in which a match never runs over a space that begins a word, as those whose only part with a leading space is `` ?``: text may be cut before
    each space that a character other than white space follows, and words, which repeat far more than texts, are remembered whole."""

    CUT = re.compile(r" (?=\S)")
    WIDE = r" ([\t-\r\x1c-\x1f\x{85}\pZ]|\z)"  # a space at which CUT may not cut

    def __init__(self, vocabulary: Vocabulary):
        super().__init__(vocabulary)
        self.words = Memo(self.word, MEMO_WORDS)

    def word(self, word: str) -> bytes:
        """What a space and ``word`` give; letters alone are one match."""
        return array("i", self.piece(f" {word}".encode())).tobytes() if word.isalpha() and self.letters else self.parts(" " + word)

    def encode(self, text: str) -> bytes:
        first, *words = self.CUT.split(text)
        return self.parts(first) + b"".join(map(self.words.__getitem__, words))

    def encode_all(self, texts: pa.Array) -> pa.ListArray:
        """Arrow cuts the texts and finds the distinct words; texts in which white space follows a space are cut by CUT."""
        odd = pc.match_substring_regex(texts, self.WIDE)
        if pc.any(odd).as_py():
            at = odd.to_numpy(zero_copy_only=False)
            parts = [packed_lists([self.encode(t) for t in texts.filter(odd).to_pylist()]), self.encode_all(texts.filter(pc.invert(odd)))]
            return pa.concat_arrays(parts).take(pa.array(np.argsort(np.argsort(~at, kind="stable"))))
        cut = pc.split_pattern(texts, " ")
        begins = cut.offsets.to_numpy()
        flat = cut.flatten().dictionary_encode()
        words, codes = flat.dictionary.to_pylist(), flat.indices.to_numpy().copy()
        codes[begins[:-1]], firsts = np.arange(len(words), len(words) + len(cut)), flat.take(pa.array(begins[:-1])).to_pylist()
        ids = list(map(self.words.get, words))
        gaps = [i for i, found in enumerate(ids) if found is None]
        self.learn(self.words.unknown(map(words.__getitem__, gaps)))
        for i in gaps:
            ids[i] = self.words[words[i]]
        laid = packed_lists(ids + list(map(self.parts, firsts))).take(pa.array(codes))
        return pa.ListArray.from_arrays(laid.offsets.take(pa.array(begins)), laid.values)

    def learn(self, words: list[str]) -> None:
        plain = [w for w in words if self.letters and w.isalpha()]
        self.words.put_all(plain, self.together([" " + w for w in plain]))
        mixed = [w for w in words if not (self.letters and w.isalpha())]
        cut = [self.split(" " + w) for w in mixed]
        new = self.pieces.unknown(chain.from_iterable(cut))
        self.pieces.put_all(new, self.together(new))
        self.words.put_all(mixed, [b"".join(map(self.pieces.__getitem__, c)) for c in cut])


def packed_lists(packed: list[bytes]) -> pa.ListArray:
    """Lists of ids from packed ones."""
    ends = np.cumsum([0, *map(len, packed)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), np.int32)))


def ranges(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Rows in ranges that are closed by each further ``most`` of their sizes."""
    ends = [*(np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // most)) + 1).tolist(), len(sizes)] if len(sizes) else []
    return list(zip([0, *ends], ends))


_encoders: dict[str, object] = {}


def encode(df: DataFrame, vocabulary: Vocabulary, text: str = "text", carry: dict[str, Column] | None = None, spaced: bool = True, decoded: bool = False) -> DataFrame:
    """``carry`` (by default all columns but the text) with ids array<int>. ``spaced``: see SpacedEncoder; else every text is matched as a whole.
    ``decoded``: with the bytes of the ids too, as ``decode`` gives them; made in the same task, as two functions in a row would take two Python workers."""
    carry = {c: F.col(f"`{c}`") for c in df.columns if c not in (text, "ids")} if carry is None else carry
    rows = df.select(*[v.alias(k) for k, v in carry.items()], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)
    kind, mark = SpacedEncoder if spaced else Encoder, uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if _encoders.get("of") != mark:  # a worker builds its automaton once
            gc.unfreeze()
            _encoders.clear()
            gc.collect()  # an encoder before, with all that it remembers
            _encoders.update(of=mark, encoder=kind(shared.value), tokens=token_array(shared.value))
            gc.freeze()  # else the collector walks the memo, which holds no cycles, again and again
        encoder, tokens = _encoders["encoder"], _encoders["tokens"]
        for batch in batches:
            texts, kept = batch.column(batch.num_columns - 1), batch.select(batch.schema.names[:-1])
            for a, b in ranges(pc.binary_length(texts).to_numpy(), RUN_BYTES):
                ids = encoder.encode_all(texts.slice(a, b - a))
                for c, d in ranges(ids.value_lengths().to_numpy(), BATCH_IDS):
                    part, lists = kept.slice(a + c, d - c), ids.slice(c, d - c)
                    more = {"ids": lists} | ({"decoded": decoded_bytes(tokens, lists)} if decoded else {})
                    yield pa.RecordBatch.from_arrays([*part.columns, *more.values()], names=[*part.schema.names, *more])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{fields}{', ' if fields else ''}ids array<int>{', decoded binary' if decoded else ''}")


def token_array(vocabulary: Vocabulary) -> pa.Array:
    """Tokens by rank, null where a rank has none."""
    table: list[bytes | None] = [None] * (max(vocabulary.ranks.values()) + 1)
    for token, rank in vocabulary.ranks.items():
        table[rank] = token
    return pa.array(table, pa.large_binary())


def decoded_bytes(tokens: pa.Array, lists: pa.ListArray) -> pa.Array:
    found = tokens.take(lists.flatten())
    if found.null_count:
        raise ValueError("an id has no token")
    ends = np.frombuffer(found.buffers()[1], np.int64)[found.offset: found.offset + len(found) + 1] if len(found) else np.zeros(1, np.int64)
    sizes = lists.value_lengths().fill_null(0).to_numpy()
    at = ends[np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)]
    data = memoryview(found.buffers()[2]) if len(found) and found.buffers()[2] else memoryview(b"")
    valid = lists.is_valid().to_pylist()
    return pa.array([bytes(data[a:b]) if v else None for a, b, v in zip(at[:-1].tolist(), at[1:].tolist(), valid)], pa.binary())


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with the bytes of its ids; a null list stays null, an id without token is an error."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_array(shared.value)
        for batch in batches:
            out = decoded_bytes(tokens, batch.column(batch.schema.names.index(ids)))
            yield pa.RecordBatch.from_arrays([*batch.columns, out], names=[*batch.schema.names, into])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{fields}, `{into}` binary")
