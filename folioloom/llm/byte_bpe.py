"""Byte-level BPE: texts to ids of a given vocabulary, with the offsets of the tokens, and ids back to bytes.

Texts are cut before the merges without a regular expression. Code points become symbols (letter, number, white space,
apostrophe, letters of contractions, others; some by what follows), and each symbol is a function on eight states. Those
functions and all that they compose to are some dozens, so a scan composes their numbers by a table: first within
stretches of the batch side by side, then over the stretches, then the states within them. A table of (state, symbol)
tells where slices begin. Arrow's dictionary gives the different slices of a batch; each is merged once and kept.

Merges join the adjacent pair of least rank, the leftmost of equals, until no pair is in the vocabulary; a slice that is
in it as a whole is one token. Special tokens are ordinary text. Null texts are empty and have no tokens. Rows that
repeat give equal results, an empty table gives an empty one; null ids pass through, as do other columns, but for
those named like the results, which are replaced. Texts are done whole, slices of any length in n log n steps.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType

from .common import as_arrow, beside, bounded_batches, in_parts, schema_beside, utf8, whole_row, with_results

# Symbols. Letters that a contraction can hold are told by what follows them, white space by whether it is the last.
LETTER, NUMBER, OTHER, APOSTROPHE, ONE, TWO, SPACE_LAST, WHITE_LAST, WHITE = range(9)
#: The symbols of a text's first code point are these numbers more, as nothing before it counts.
FIRST = 9
# States: between slices, within letters, numbers, others or white space, behind a space that a slice may begin with,
# behind an apostrophe that begins a slice, within the letters of a contraction.
FREE, LETTERS, NUMBERS, OTHERS, SPACES, SPACED, QUOTED, SHORTENED = range(8)
#: Fixed by the pattern of the vocabulary: what may follow an apostrophe.
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")

#: Slices are kept with their ids until there are so many, or so many bytes of them.
KEPT, KEPT_BYTES = 500_000, 50_000_000
#: Slices of up to so many bytes are merged together with others of their length.
SIDE_BY_SIDE = 64
NO_PAIR = 1 << 60
#: Bytes of texts that are cut at a time.
STRETCH = 4_000_000


def step(state: int, symbol: int) -> tuple[int, bool]:
    """(the next state, whether a slice begins here)."""
    if symbol in (SPACE_LAST, WHITE_LAST):
        return (SPACED if symbol == SPACE_LAST else FREE), True
    if symbol == WHITE:
        return SPACES, state != SPACES
    if state == SHORTENED:
        return FREE, False
    if state == QUOTED and symbol == ONE:
        return FREE, False
    if state == QUOTED and symbol == TWO:
        return SHORTENED, False
    if symbol in (LETTER, ONE, TWO):
        return LETTERS, state not in (LETTERS, SPACED)
    if symbol == NUMBER:
        return NUMBERS, state not in (NUMBERS, SPACED)
    goes_on = state in (OTHERS, SPACED, QUOTED)
    return (OTHERS if symbol == OTHER or goes_on else QUOTED), not goes_on


@lru_cache(1)
def machine() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(next[state, function], function[after, before], begins[state, symbol]); the first functions are the symbols' own."""
    states, symbols = range(8), range(2 * FIRST)
    moves = [[step(FREE if s >= FIRST else q, s % FIRST) for q in states] for s in symbols]
    functions = [tuple(q for q, _ in m) for m in moves]
    number = {f: k for k, f in reversed(list(enumerate(functions)))}
    known = len(functions)
    k = 0
    while k < known:  # all that they compose to
        for s in symbols:
            f = tuple(functions[s][q] for q in functions[k])
            if f not in number:
                number[f] = known
                functions.append(f)
                known += 1
        k += 1
    table = np.array(functions, np.uint8)
    composed = np.array([[number[tuple(after[q] for q in before)] for before in functions] for after in functions], np.uint16)
    return np.ascontiguousarray(table.T), composed, np.array([[moves[s][q][1] for s in symbols] for q in states])


def states_before(functions: np.ndarray) -> np.ndarray:
    """The state in front of each place, by a scan: stretches side by side, then over the stretches, then within them."""
    move, composed, _ = machine()
    n = len(functions)
    width = max(1, int(np.sqrt(n)))
    rows = -(-n // width)
    padded = np.zeros(rows * width, np.uint16)
    padded[:n] = functions
    block = np.ascontiguousarray(padded.reshape(rows, width).T)
    whole = block[0].copy()
    for k in range(1, width):
        whole = composed[block[k], whole]
    shift = 1
    while shift < rows:  # after a round, each has the composition of twice as many stretches up to it
        whole[shift:] = composed[whole[shift:], whole[:-shift]]
        shift *= 2
    state = np.concatenate([[FREE], move[FREE][whole[:-1]]]).astype(np.uint8)
    out = np.empty((width, rows), np.uint8)
    for k in range(width):
        out[k] = state
        state = move[state, block[k]]
    return out.T.reshape(-1)[:n]


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points, their first bytes) of UTF-8."""
    first = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[first].astype(np.int32)
    size = np.diff(np.append(first, len(data)))
    out = np.where(size == 1, lead, lead & (0x7F >> size))
    for k in range(1, 4):
        more = np.flatnonzero(size > k)
        out[more] = (out[more] << 6) | (data[first[more] + k] & 0x3F)
    return out, first


def symbols_of(points: np.ndarray, first: np.ndarray, at: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """A symbol for each code point; kinds has LETTER, NUMBER, WHITE or OTHER for each."""
    out = kinds[points]
    starts = np.zeros(len(points) + 1, bool)
    starts[np.searchsorted(first, at)] = True
    starts[-1] = True
    following = np.append(points[1:], 0)
    following[starts[1:]] = -1
    white_next = np.append(out[1:] == WHITE, True) | starts[1:]
    last = (out == WHITE) & ~white_next
    out[last] = np.where(points[last] == 32, SPACE_LAST, WHITE_LAST)
    out[points == ord("'")] = APOSTROPHE
    for letter in ONE_LETTER:
        out[points == ord(letter)] = ONE
    for a, b in TWO_LETTERS:
        out[(points == ord(a)) & (following == ord(b))] = TWO
    out[starts[:-1]] += FIRST
    return out


def _safe(data: np.ndarray, lo: int) -> int:
    """The first place from `lo` on where a slice begins whatever stands before: a space, then visible ASCII."""
    while lo < len(data) - 1:
        part = data[lo : lo + 100_001]
        found = np.flatnonzero((part[:-1] == 32) & (part[1:] > 32) & (part[1:] < 127))
        if len(found):
            return lo + int(found[0])
        lo += len(part) - 1
    return len(data)


def slices(data: np.ndarray, at: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """The first bytes of all slices of all texts, in order, and the end. Long texts are cut at safe places for this."""
    out, lo = [], 0
    while lo < len(data):
        hi = len(data) if len(data) - lo <= STRETCH else _safe(data, lo + STRETCH)
        points, first = code_points(data[lo:hi])
        inside = at[(at > lo) & (at < hi)] - lo
        symbols = symbols_of(points, first, np.append([0], inside), kinds)
        begins = machine()[2][states_before(symbols.astype(np.uint16)), symbols]
        out.append(first[begins] + lo)
        lo = hi
    return np.concatenate([*out, [len(data)]]).astype(np.int64)


def kinds_of_code_points() -> np.ndarray:
    """Whether each code point is a letter, a number, white space or another, by the tokenizer library's own tables.

    They are asked of the library, as its version of Unicode needn't be Python's.
    """
    import tiktoken

    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    single = {bytes([k]): k for k in range(256)}
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (WHITE, r"\s")):
        probe = tiktoken.Encoding(f"class-{kind}", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        found = np.frombuffer(bytes(probe.encode_ordinary(every)), np.uint8)
        out[code_points(found)[0]] = kind
    return out


class Vocabulary:
    """Ranks by bytes, and the bytes of all ids as one array with offsets.

    Of a file that has, on each line, the bytes in base 64 and the rank. It is read on the driver and broadcast, as
    vocabularies have some 100 000 lines and megabytes at most.
    """

    def __init__(self, path: str):
        with open(path, "rb") as f:
            lines = f.read().splitlines()
        self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        by_id = sorted((b, a) for a, b in self.ranks.items())
        if missing := [k for k in range(256) if bytes([k]) not in self.ranks]:
            raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")
        self.place = np.full(by_id[-1][0] + 1, -1, np.int32)
        self.place[[b for b, _ in by_id]] = np.arange(len(by_id))
        self.data = np.frombuffer(b"".join(a for _, a in by_id), np.uint8)
        self.at = np.concatenate([[0], np.cumsum([len(a) for _, a in by_id])])
        self.kinds = kinds_of_code_points()
        get, pairs = self.ranks.get, {}
        for whole, rank in self.ranks.items():
            for k in range(1, len(whole)):
                if (a := get(whole[:k])) is not None and (b := get(whole[k:])) is not None:
                    pairs[a << 32 | b] = rank
        self.pairs = np.array(sorted(pairs), np.int64)
        self.made = np.array([pairs[k] for k in self.pairs.tolist()], np.int64)
        self.single = np.array([self.ranks[bytes([k])] for k in range(256)], np.int64)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of what pairs of ids merge to; NO_PAIR >> 8 where they don't."""
        key = left << 32 | right
        k = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[k] == key, self.made[k], NO_PAIR >> 8)

    def merged_alike(self, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number for each) of slices of one length, which are rows of bytes: each round does one merge in each row."""
        n, length = pieces.shape
        ids = self.single[pieces]
        after, before = np.tile(np.arange(1, length + 1), (n, 1)), np.tile(np.arange(-1, length - 1), (n, 1))
        order = np.full((n, length), NO_PAIR)  # rank, then column: the least is the leftmost of least rank
        order[:, :-1] = self.rank_of(ids[:, :-1], ids[:, 1:]) << 8 | np.arange(length - 1)
        rows = np.arange(n)
        while len(rows):
            least = order[rows].min(axis=1)
            going = least < NO_PAIR
            rows, least = rows[going], least[going]
            k, made = least & 255, least >> 8
            middle = after[rows, k]
            end = after[rows, middle]
            after[rows, k], ids[rows, k], ids[rows, middle] = end, made, -1
            order[rows, middle] = order[rows, k] = NO_PAIR
            more = np.flatnonzero(end < length)
            r, c, e = rows[more], k[more], end[more]
            before[r, e] = c
            order[r, c] = self.rank_of(made[more], ids[r, e]) << 8 | c
            p = before[rows, k]
            more = np.flatnonzero(p >= 0)
            r, p = rows[more], p[more]
            order[r, p] = self.rank_of(ids[r, p], made[more]) << 8 | p
        left = ids >= 0
        return ids[left], left.sum(axis=1)

    def merged(self, piece: bytes) -> list[int]:
        """The ids of one slice."""
        ranks = self.ranks
        if (whole := ranks.get(piece)) is not None:
            return [whole]
        if len(piece) <= SIDE_BY_SIDE:
            return self.merged_alike(np.frombuffer(piece, np.uint8)[None])[0].tolist()
        # A heap of pairs, in n log n steps; what a pair was is held against what it is.
        n = len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n))
        heap = [r << 40 | k for k in range(n - 1) if (r := ranks.get(piece[k : k + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            least = heapq.heappop(heap)
            k, rank = least & ((1 << 40) - 1), least >> 40
            middle = after[k]
            if middle is None or middle >= n or ranks.get(piece[k : after[middle]]) != rank:
                continue
            end = after[k] = after[middle]
            after[middle] = None
            if end < n:
                before[end] = k
                if (r := ranks.get(piece[k : after[end]])) is not None:
                    heapq.heappush(heap, r << 40 | k)
            if k and (r := ranks.get(piece[before[k] : end])) is not None:
                heapq.heappush(heap, r << 40 | before[k])
        out, k = [], 0
        while k < n:
            out.append(ranks[piece[k : after[k]]])
            k = after[k]
        return out


def spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... size[0] of them, then those of the next."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - size), size)


class Encoder:
    """Encodes batches of texts; slices that it has merged stay until they are too many."""

    def __init__(self, vocabulary: Vocabulary):
        self.of = vocabulary
        self._forget()

    def _forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.flat, self.size, self.bytes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], 0

    def _learn(self, pieces: list[bytes]) -> None:
        """Merges slices that aren't known yet."""
        alike: dict[int, list[bytes]] = {}
        known, others = [], []
        for x in pieces:
            if x in self.of.ranks:
                known.append(x)
            elif len(x) <= SIDE_BY_SIDE:
                alike.setdefault(len(x), []).append(x)
            else:
                others.append(x)
        flat, size = [np.array([self.of.ranks[x] for x in known], np.int32)], [np.ones(len(known), np.int64)]
        for length, group in alike.items():
            ids, n = self.of.merged_alike(np.frombuffer(b"".join(group), np.uint8).reshape(-1, length))
            flat.append(ids.astype(np.int32))
            size.append(n)
            known += group
        for x in others:
            flat.append(np.array(self.of.merged(x), np.int32))
            size.append(np.array([len(flat[-1])]))
            known.append(x)
        self.number.update(zip(known, range(len(self.number), len(self.number) + len(known)), strict=True))
        self.flat, self.size = [np.concatenate([*self.flat, *flat])], [np.concatenate([*self.size, *size])]
        self.bytes += sum(map(len, known))

    def batch(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first bytes within their text, tokens before each text and in all) of the texts."""
        starts = slices(data, at, self.of.kinds)
        if len(starts) < 2:
            return np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
        cut = pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        if len(self.number) > KEPT or self.bytes > KEPT_BYTES:
            self._forget()
        pieces = cut.dictionary.to_pylist()
        if new := [x for x in pieces if x not in self.number]:
            self._learn(new)
        which = np.fromiter(map(self.number.__getitem__, pieces), np.int64, len(pieces))[cut.indices.to_numpy()]
        flat, size = self.flat[0], self.size[0]
        out = flat[spread((np.cumsum(size) - size)[which], size[which])]
        place = self.of.place[out]
        width = (self.of.at[1:] - self.of.at[:-1])[place]
        ends = np.cumsum(width)
        tokens = np.searchsorted(ends, at, "right")
        return out, ends - width - np.repeat(at[:-1], np.diff(tokens)), tokens


def decoded(vocabulary: Vocabulary, ids: np.ndarray, most: int = 500_000) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, their number before each token and in all) of ids."""
    if len(ids) and (ids.min() < 0 or ids.max() >= len(vocabulary.place) or (vocabulary.place[ids] < 0).any()):
        raise ValueError("an id is not in the vocabulary")
    place = vocabulary.place[ids]
    first, size = vocabulary.at[place], vocabulary.at[place + 1] - vocabulary.at[place]
    parts = [vocabulary.data[spread(first[k : k + most], size[k : k + most])] for k in range(0, len(ids), most)]
    return np.concatenate([np.zeros(0, np.uint8), *parts]), np.concatenate([[0], np.cumsum(size)])


def _lists(values: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values.astype(np.int32)))


def encode(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """The rows without their text, with ids and offsets (the first byte of each token in the UTF-8 of its text)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(Vocabulary(vocabulary))
    rows = docs.select(beside(docs, text).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in in_parts(batches):
            ids, offsets, tokens = encoder.batch(*utf8(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("row"), _lists(ids, tokens), _lists(offsets, tokens)], names=["row", "ids", "offsets"])

    kinds = {"ids": ArrayType(IntegerType()), "offsets": ArrayType(IntegerType())}
    return with_results(rows.mapInArrow(kernel, schema_beside(rows, kinds)), [c for c in docs.columns if c != text], {c: c for c in kinds})


def decode(rows: DataFrame, vocabulary: str, ids: str = "ids", result: str = "decoded") -> DataFrame:
    """The rows with the bytes that their ids stand for. Null lists are empty; ids that are null or unknown are errors."""
    spark = rows.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(Vocabulary(vocabulary))
    wanted = rows.select(whole_row(rows).alias("row"), F.coalesce(F.col(f"`{ids}`").cast("array<int>"), F.array().cast("array<int>")).alias("ids"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("ids")
            values = column.flatten()
            if values.null_count:
                raise ValueError("an id is null")
            at = column.offsets.to_numpy().astype(np.int64)
            data, before = decoded(shared.value, values.to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column("row"), as_arrow(data, before[at - at[0]], binary=True)], names=["row", "decoded"])

    return with_results(wanted.mapInArrow(kernel, schema_beside(wanted, {"decoded": BinaryType()})), rows.columns, {result: "decoded"})


def encode_digest(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, and the hashes of the ids, in decimal and joined by commas, and of the bytes decoded from them."""
    made = encode(docs.select("doc_id", "text"), vocabulary)
    hashed = made.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"))
    return decode(hashed, vocabulary).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
