"""Byte-level BPE encoding and decoding as a reduction over a tree.

A text is halved recursively at places where the split pattern always separates (a blank after
something that is not blank), so the token lists of the halves are simply joined.  Each match of
the pattern that is no token itself is halved again, byte-wise, down to a few bytes, and there
the lists of two neighbours cannot just be joined, since merges may cross the border.  They are
joined by encoding a window around the border anew and letting it grow until the tokens outside
are settled: a list of tokens is the encoding of its bytes if and only if every two neighbours in
it are the encoding of their own bytes, so it suffices that the outermost tokens of the window
and their neighbours outside pass that test.  The join is associative and the empty list is its
neutral element.  Decoding joins the bytes of the tokens up the tree.

Texts are spread by Spark; a task holds one batch and bounded stores of matches it has encoded
and of pairs it has tested.

Defined results: a null text counts as empty and has no tokens; special tokens are ordinary text;
repeated rows are encoded each; unknown or null ids raise an error on decoding, a null list
decodes to no bytes; an empty table gives an empty result; only named columns are read, all
others pass through untouched.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

LEAF = 4096  # characters of a text, or tokens of a list, that are not halved further
MATCH_LEAF = 8  # bytes of a match encoded by plain merging
KNOWN = 150_000  # matches of up to KNOWN_LENGTH characters a worker remembers, twice
KNOWN_LENGTH = 64
LONG = 128  # bytes from which plain merging keeps its candidates in a heap
GATHER = 1 << 20  # tokens whose bytes are gathered at once when a batch is decoded


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file with a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines if line.strip())}


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.never = len(ranks) + max(ranks.values(), default=0) + 1  # above every rank
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.fits = lru_cache(maxsize=200_000)(self._fits)
        # all tokens' bytes one after the other, by id; unknown ids have width -1
        width = np.full(max(self.bytes_of, default=-1) + 1, -1, np.int64)
        start = np.zeros(width.size, np.int64)
        at = 0
        for r in sorted(self.bytes_of):
            width[r], start[r] = len(self.bytes_of[r]), at
            at += width[r]
        self.width, self.start = width, start
        self.blob = np.frombuffer(b"".join(self.bytes_of[r] for r in sorted(self.bytes_of)), np.uint8)

    # --- bytes of one match -------------------------------------------------------------

    def merged(self, piece: bytes) -> list[int]:
        """Plain merging: the pair of lowest rank first, the leftmost of equals."""
        if len(piece) > LONG:
            return self._merged_by_heap(piece)
        get, never = self.ranks.get, self.never
        cuts = list(range(len(piece) + 1))
        pairs = [get(piece[i : i + 2], never) for i in range(len(piece) - 1)]
        while pairs:
            least = min(pairs)
            if least == never:
                break
            i = pairs.index(least)
            del cuts[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = get(piece[cuts[i] : cuts[i + 2]], never)
            if i:
                pairs[i - 1] = get(piece[cuts[i - 1] : cuts[i + 1]], never)
        return [self.ranks[piece[x:y]] for x, y in pairwise(cuts)]

    def _merged_by_heap(self, piece: bytes) -> list[int]:
        """The same for long inputs, with the candidate pairs in a heap."""
        get, n = self.ranks.get, len(piece)
        end = list(range(1, n + 1))  # end of the part that starts here, 0 once it is merged away
        before = list(range(-1, n))  # start of the part before; one entry more for the text's end
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(piece[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            _, i, stop = heappop(heap)
            middle = end[i]
            if not middle or middle >= n or end[middle] != stop:
                continue  # one of its parts has changed since
            end[i], end[middle], before[stop] = stop, 0, i
            if stop < n and (r := get(piece[i : end[stop]])) is not None:
                heappush(heap, (r, i, end[stop]))
            if i and (r := get(piece[before[i] : stop])) is not None:
                heappush(heap, (r, before[i], stop))
        out, at = [], 0
        while at < n:
            out.append(self.ranks[piece[at : end[at]]])
            at = end[at]
        return out

    def _fits(self, left: int, right: int) -> bool:
        """Are two tokens the encoding of their joined bytes?"""
        return self.merged(self.bytes_of[left] + self.bytes_of[right]) == [left, right]

    def joined(self, left: list[int], right: list[int]) -> list[int]:
        """Encoding of the bytes of two encodings."""
        if not left or not right:
            return left or right
        if self.fits(left[-1], right[0]):
            return left + right
        if len(left) <= 2 and len(right) <= 2:  # the first window is all there is
            return self.merged(b"".join([self.bytes_of[i] for i in left + right]))
        size = 2
        while True:
            a, b = left[-size:], right[:size]
            window = self.merged(b"".join(map(self.bytes_of.__getitem__, a + b)))
            before, after = left[: len(left) - len(a)], right[len(b) :]
            if (not before or self.fits(before[-1], window[0])) and (
                not after or self.fits(window[-1], after[0])
            ):
                return before + window + after
            size *= 2

    def halved(self, piece: bytes) -> list[int]:
        """Encoding by halves, joined up the tree."""
        if len(piece) <= MATCH_LEAF:
            return self.merged(piece)
        middle = len(piece) // 2
        return self.joined(self.halved(piece[:middle]), self.halved(piece[middle:]))

    def encode_match(self, match: str) -> bytes:
        """Ids of one match of the pattern, packed; a match that is a token needs no merging.

        Full stores are set aside; what is met again from them moves to the new one, so words in
        use stay known."""
        ids = self.older.get(match)
        if ids is None:
            piece = match.encode("utf-8")
            whole = self.ranks.get(piece)
            ids = array("i", (whole,) if whole is not None else self.halved(piece)).tobytes()
        if len(match) <= KNOWN_LENGTH:
            if len(self.known) >= KNOWN:
                self.known, self.older = {}, self.known
            self.known[match] = ids
        return ids

    # --- texts ----------------------------------------------------------------------------

    def packed(self, text: str) -> bytes:
        """Ids of a text as 32-bit integers, which join by writing them one after the other."""
        cut = self._border(text) if len(text) > LEAF else None
        if cut is None:
            known, encode = self.known, self.encode_match
            return b"".join([known.get(m) or encode(m) for m in self.pattern.findall(text)])
        return self.packed(text[:cut]) + self.packed(text[cut:])

    def ids(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.packed(text or ""), np.int32)

    def encode(self, text: str | None) -> list[int]:
        return self.ids(text).tolist()

    @staticmethod
    def _border(text: str) -> int | None:
        """A blank after a character that is none, as near to the middle as can be: no match
        spans it, and what is matched on either side does not depend on the other side."""
        middle = len(text) // 2
        after = _BORDER.search(text, middle)
        if after and after.start() - middle < LEAF // 2:
            return after.start()
        before = next((m.start() for m in _BORDER.finditer(text, max(0, middle - LEAF), middle + 1)), None)
        return before if before else (after.start() if after else None)

    def decode(self, ids: Sequence[int]) -> bytes:
        if len(ids) <= LEAF:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])

    def decode_lists(self, lists: pa.Array) -> pa.Array:
        """Bytes of each list of ids at once, gathered from the joined tokens; a null list has none."""
        counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        values = lists.flatten()
        if values.null_count:
            raise KeyError(None)
        ids = values.to_numpy(zero_copy_only=False).astype(np.int64)
        unknown = (ids < 0) | (ids >= self.width.size)
        if unknown.any() or (self.width[ids] < 0).any():
            raise KeyError(int(ids[unknown | (self.width[np.where(unknown, 0, ids)] < 0)][0]))
        widths = self.width[ids]
        token_ends = np.concatenate([[0], np.cumsum(widths)])
        row_ends = token_ends[np.concatenate([[0], np.cumsum(counts)])]
        parts = []
        for lo in range(0, ids.size, GATHER):
            w, s = widths[lo : lo + GATHER], self.start[ids[lo : lo + GATHER]]
            into = np.cumsum(w) - w  # where each token's bytes begin in this part
            parts.append(self.blob[np.repeat(s - into, w) + np.arange(int(w.sum()))])
        data = np.concatenate(parts) if parts else np.empty(0, np.uint8)
        offsets = pa.array(row_ends, pa.int64()).cast(pa.int32())  # fails, as before, beyond 2 GB
        return pa.Array.from_buffers(pa.binary(), len(counts), [None, offsets.buffers()[1], pa.py_buffer(data)])


_BORDER = regex.compile(r"(?<=\S)\s")

_CODECS: dict[tuple[str, str], Codec] = {}


def _codec(shared, name: str, pattern: str) -> Codec:
    """One codec per Python worker and vocabulary."""
    if (name, pattern) not in _CODECS:
        _CODECS[name, pattern] = Codec(shared.value, pattern)
    return _CODECS[name, pattern]


def _shared(df: DataFrame, ranks: dict[bytes, int]):
    """The vocabulary as a broadcast, which does not grow with the data, and its name."""
    name = hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()
    return df.sparkSession.sparkContext.broadcast(ranks), name


def _encoded_lists(codec: Codec, texts: pa.Array) -> pa.Array:
    """The token ids of each text of a batch as one list array."""
    offsets, parts = [0], []
    for text in texts:
        ids = codec.ids(text.as_py())
        parts.append(ids)
        offsets.append(offsets[-1] + len(ids))
    values = np.concatenate(parts) if parts else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def encoded(
    df: DataFrame, ranks: dict[bytes, int], pattern: str, text_column: str = "text", ids_column: str = "token_ids"
) -> DataFrame:
    """``df`` without its text and with the token ids of it."""
    shared, name = _shared(df, ranks)
    kept = [c for c in df.columns if c not in (text_column, ids_column)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared, name, pattern)
        for batch in batches:
            lists = _encoded_lists(codec, batch.column(batch.schema.get_field_index(text_column)))
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, lists], names=[*kept, ids_column])

    schema = StructType(
        [df.schema[c] for c in kept] + [StructField(ids_column, ArrayType(IntegerType(), False))]
    )
    return df.mapInArrow(run, schema)


def decoded(
    df: DataFrame, ranks: dict[bytes, int], ids_column: str = "token_ids", bytes_column: str = "decoded"
) -> DataFrame:
    """``df`` with the bytes its token ids stand for."""
    shared, name = _shared(df, ranks)
    kept = [c for c in df.columns if c != bytes_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared, name, "")
        for batch in batches:
            out = codec.decode_lists(batch.column(batch.schema.get_field_index(ids_column)))
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, out], names=[*kept, bytes_column])

    schema = StructType([df.schema[c] for c in kept] + [StructField(bytes_column, BinaryType())])
    return df.mapInArrow(run, schema)


def encoded_and_decoded(
    df: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    text_column: str = "text",
    ids_column: str = "token_ids",
    bytes_column: str = "decoded",
) -> DataFrame:
    """``decoded(encoded(df, ...))`` in one pass: each batch is decoded as soon as it is encoded.

    One Python worker per task and one codec per worker, where the two passes take two of each."""
    shared, name = _shared(df, ranks)
    kept = [c for c in df.columns if c not in (text_column, ids_column, bytes_column)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared, name, pattern)
        for batch in batches:
            lists = _encoded_lists(codec, batch.column(batch.schema.get_field_index(text_column)))
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            out = [*columns, lists, codec.decode_lists(lists)]
            yield pa.RecordBatch.from_arrays(out, names=[*kept, ids_column, bytes_column])

    schema = StructType(
        [df.schema[c] for c in kept]
        + [StructField(ids_column, ArrayType(IntegerType(), False)), StructField(bytes_column, BinaryType())]
    )
    return df.mapInArrow(run, schema)
