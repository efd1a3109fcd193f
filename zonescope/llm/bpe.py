"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A text is cut into pre-tokens by the vocabulary's pattern; no merge crosses
their ends, and pre-tokens not seen yet are merged many at a time.  The merge
queue has one bucket per merge rank holding positions of a linked list of
tokens; two bitmap levels find the lowest non-empty rank by find-first-set, and
an entry whose pair has changed since it was queued is skipped when it comes up.  A pre-token of n bytes costs
O(n log n), so one of a megabyte is no problem.

Results: a null text is the empty text and has no tokens; repeated rows are
encoded row by row; an empty table gives an empty table; columns besides the
text pass through, and one named like an output is replaced.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from zonescope.llm.common import MEMO_ENTRIES, Memo, arrow_map, broadcast_bytes, texts, worker_table

#: A space that is followed by white space or ends the text: such a text is cut by the pattern as a whole.
_LOOSE_SPACE = re.compile(r" (?:\s|\Z)")
#: Stands for a byte that is no token.
_NO_ID = -2
#: Characters of text whose new parts are cut together, and bytes of pieces that are merged together.
GROUP_CHARS = 1 << 18
MERGED_BYTES = 1 << 16


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes -> rank from the lines ``base64 rank`` of a rank file."""
    out = {}
    for line in data.splitlines():
        if line:
            token, rank = line.split()
            out[base64.b64decode(token)] = int(rank)
    return out


class RankQueue:
    """Positions by rank: a bucket per rank, and two bitmap levels over the ranks that have one."""

    def __init__(self, ranks: int):
        self.low = [0] * ((ranks >> 8) + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def fill(self, pair: np.ndarray) -> None:
        """Queue every position whose pair has a rank."""
        at = np.flatnonzero(pair >= 0)
        at = at[np.argsort(pair[at], kind="stable")]
        found, starts = np.unique(pair[at], return_index=True)
        places, cuts, low = at.tolist(), [*starts.tolist(), len(at)], self.low
        for rank, a, b in zip(found.tolist(), cuts, cuts[1:], strict=False):
            self.buckets[rank] = places[a:b]
            low[rank >> 8] |= 1 << (rank & 255)
            self.top |= 1 << (rank >> 8)


class Encoder:
    """Texts to packed little-endian unsigned 32-bit ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.queue = RankQueue(max(ranks.values(), default=0) + 1)
        self.bytes = np.array([ranks.get(bytes([x]), _NO_ID) for x in range(256)], np.int64)
        self.twos = np.array([ranks.get(bytes([x, y]), -1) for x in range(256) for y in range(256)], np.int64)
        self.pieces = Memo(lambda piece: self._merged([piece])[0])
        self.spaced: dict[str, bytes] = {}

    def forget(self) -> None:
        self.pieces.clear()
        self.spaced.clear()

    def merge(self, piece: bytes) -> list[int]:
        return np.frombuffer(self.merge_all([piece])[0], "<u4").tolist()

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """The packed ids of each piece.  The pieces lie in one list with a mark before, between and after them, over
        which no pair goes, and share one queue: a rank's bucket is worked off as a whole, in order of position.

        Pushes are written out here: a call for each would cost more than its work.
        """
        get, low, buckets = self.ranks.get, self.queue.low, self.queue.buckets
        data = b"\0" + b"\0".join(pieces) + b"\0"
        codes = np.frombuffer(data, np.uint8).astype(np.int64)
        marks = np.cumsum([0, *(len(p) + 1 for p in pieces)])
        start, first = self.bytes[codes], np.append(self.twos[codes[:-1] << 8 | codes[1:]], -1)
        start[marks] = first[marks] = first[marks[1:] - 1] = -1
        self.queue.fill(first)
        top = self.queue.top
        ids, pair = start.tolist(), first.tolist()
        after, before = list(range(1, len(data) + 1)), list(range(-1, len(data) - 1))
        while top:
            a = (top & -top).bit_length() - 1
            word = low[a]
            rank = a << 8 | (word & -word).bit_length() - 1
            low[a] = word = word & word - 1
            if not word:
                top &= top - 1
            bucket = buckets.pop(rank)
            bucket.sort()
            lower = False
            for i in bucket:
                if pair[i] != rank:
                    continue  # stale: the pair here has changed
                ids[i] = rank
                j = after[i]
                k = after[i] = after[j]
                before[k] = i
                ids[j] = pair[j] = -1
                if ids[k] != -1:
                    new = pair[i] = get(data[i : after[k]], -1)
                    if new >= 0:
                        if new in buckets:
                            buckets[new].append(i)
                        else:
                            buckets[new] = [i]
                            a = new >> 8
                            low[a] |= 1 << (new & 255)
                            top |= 1 << a
                        lower = new < rank
                else:
                    pair[i] = -1
                h = before[i]
                if ids[h] != -1:
                    new = pair[h] = get(data[h:k], -1)
                    if new >= 0:
                        if new in buckets:
                            buckets[new].append(h)
                        else:
                            buckets[new] = [h]
                            a = new >> 8
                            low[a] |= 1 << (new & 255)
                            top |= 1 << a
                        lower |= new < rank
                if lower:  # a pair of a lower rank has come up and goes first
                    rest = bucket[bucket.index(i) + 1 :]
                    if rest:
                        buckets[rank] = rest
                        low[rank >> 8] |= 1 << (rank & 255)
                        top |= 1 << (rank >> 8)
                    break
        self.queue.top = top
        merged = np.array(ids)
        if (merged == _NO_ID).any():
            raise ValueError("the vocabulary lacks a byte")
        live = merged >= 0
        packed = merged[live].astype("<u4").tobytes()
        cuts = (4 * np.cumsum(live)[marks]).tolist()
        return [packed[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _merged(self, pieces: list[str]) -> list[bytes]:
        """Packed ids: the rank of a piece that is a token, the rest merged together, about ``MERGED_BYTES`` at a time."""
        out, rest, size = [], [], 0
        whole, places = self.ranks.get, []

        def work() -> None:
            for i, ids in zip(places, self.merge_all(rest), strict=True):
                out[i] = ids

        for piece in pieces:
            data = piece.encode()
            rank = whole(data)
            if rank is None:
                places.append(len(out))
                rest.append(data)
                size += len(data)
            out.append(b"" if rank is None else rank.to_bytes(4, "little"))
            if size >= MERGED_BYTES:
                work()
                places, rest, size = [], [], 0
        if rest:
            work()
        return out

    def learn(self, cut: list[str]) -> None:
        """Merge the pieces not seen yet."""
        known, distinct = self.pieces, set(cut)
        new = [p for p in distinct if p not in known]
        if len(known) + len(new) > MEMO_ENTRIES:
            known.clear()
            new = list(distinct)
        known.update(zip(new, self._merged(new), strict=True))

    def _cut(self, text: str) -> bytes:
        cut = self.find(text)
        self.learn(cut)
        return b"".join(map(self.pieces.__getitem__, cut))

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, some: list[str]) -> list[bytes]:
        """Encode texts, about ``GROUP_CHARS`` characters of them at a time."""
        out, a, size = [], 0, 0
        for b, text in enumerate(some, 1):
            size += len(text)
            if size >= GROUP_CHARS or b == len(some):
                out += self._group(some[a:b])
                a, size = b, 0
        return out

    def _group(self, some: list[str]) -> list[bytes]:
        """No pre-token goes on past a space that a non-space follows, so such texts are cut at spaces and cut parts are remembered.

        The parts that no text of the group has shown yet are cut by the pattern together (a pre-token that starts with a
        space starts a part) and merged together.
        """
        split = [None if _LOOSE_SPACE.search(text) else text.split(" ") for text in some]
        known, distinct = self.spaced, set().union(*(parts[1:] for parts in split if parts))
        new = list(distinct.difference(known))
        if len(known) + len(new) > MEMO_ENTRIES:
            known.clear()
            new = list(distinct)
        if new:
            cut = self.find(" " + " ".join(new))
            self.learn(cut)
            starts = [i for i, piece in enumerate(cut) if piece[:1] == " "]
            for part, a, b in zip(new, starts, [*starts[1:], len(cut)], strict=True):
                known[part] = self.pieces[cut[a]] if b == a + 1 else b"".join(map(self.pieces.__getitem__, cut[a:b]))
        return [b"".join([self._cut(parts[0]), *map(known.__getitem__, parts[1:])]) if parts else self._cut(text) for text, parts in zip(some, split, strict=True)]


def _with(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    kept = [n for n in batch.schema.names if n not in columns]
    return pa.RecordBatch.from_arrays([batch.column(n) for n in kept] + list(columns.values()), names=[*kept, *columns])


def _schema_with(df: DataFrame, **columns: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name not in columns] + [T.StructField(k, v) for k, v in columns.items()])


def _encoder(vocabulary, pattern: str) -> Encoder:
    return worker_table(("bpe", hash(vocabulary.value), pattern), lambda: Encoder(read_ranks(vocabulary.value), pattern))


def encode(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """Add ``n_tokens`` and ``ids`` (token ids as packed little-endian unsigned 32-bit integers)."""
    vocabulary = broadcast_bytes(df.sparkSession, ranks_path)

    def make():
        encoder = _encoder(vocabulary, pattern)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = encoder.encode_all(texts(batch, text_col))
            return _with(batch, n_tokens=pa.array([len(x) >> 2 for x in ids], pa.int64()), ids=pa.array(ids, pa.binary()))

        return step

    return arrow_map(df, _schema_with(df, n_tokens=T.LongType(), ids=T.BinaryType()), make)


def decode(df: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """Add ``decoded``: the bytes that packed ids stand for (null ids: none).  An id outside the vocabulary is an error."""
    vocabulary = broadcast_bytes(df.sparkSession, ranks_path)

    def make():
        tokens = {rank: token for token, rank in read_ranks(vocabulary.value).items()}

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = [b"".join(map(tokens.__getitem__, np.frombuffer(x or b"", "<u4").tolist())) for x in batch.column(ids_col).to_pylist()]
            return _with(batch, decoded=pa.array(out, pa.binary()))

        return step

    return arrow_map(df, _schema_with(df, decoded=T.BinaryType()), make)
