"""Token ids packed into fixed rows: best-fit-decreasing with a segment tree over free room.

Texts are tokenized with a public byte-level BPE vocabulary (path is a parameter). A
document longer than a row is split losslessly into full-row pieces and a rest. The pieces of a
group are packed in decreasing length; the row for a piece is the one with the least
free room that still fits, found by descending a segment tree over room sizes, so a
group of n pieces costs n log(row length). Each row comes out as a matrix line of ids (little-endian
unsigned 16 bit, padded), the cumulative segment lengths, the position ids' reset points and,
per segment, the document and where in the document it starts, so documents can be put together again.

A group is ``group_tokens`` tokens of one input partition, tokenized and packed as a
stream: no shuffle, bounded memory, and a lost executor's partition is simply packed again.
Row ids are (partition, number in it).

Defined results: null and empty texts have no tokens and no segment; repeated rows are packed each;
null ids stay null in ``doc_ids``; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from pulsegrid.llm.common import map_batches, type_of

VOCAB = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The published splitting pattern of this vocabulary (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Unicode white space as the tokenizer's pattern sees it.
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
ID = np.dtype("<u2")


class Encoder:
    """Token ids of a text as little-endian unsigned 16-bit bytes.

    The pattern's look-ahead only matters where two white space characters meet; the
    other texts go through the same pattern without it, which is faster and gives the same ids.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        if max(ranks.values()) >= 1 << 16:
            raise ValueError("ids must fit 16 bits")
        make = lambda pattern: tiktoken.Encoding(os.path.basename(path), pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.plain = make(PATTERN)
        self.fast = make(PATTERN.replace(r"|\s+(?!\S)", ""))
        self.meet = re.compile(f"[{SPACE}][{SPACE}]")

    def encode(self, text: str) -> bytes:
        coder = self.plain if self.meet.search(text) else self.fast
        return np.array(coder.encode_ordinary(text), ID).tobytes()


@lru_cache(1)
def encoder(path: str) -> Encoder:
    """One encoder a worker process."""
    return Encoder(path)


class RoomTree:
    """Counts of open rows by free room; finds the least room of at least n by descending a segment tree."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: dict[int, list[int]] = {}

    def add(self, room: int, row: int) -> None:
        self.rows.setdefault(room, []).append(row)
        self._change(room, 1)

    def _change(self, room: int, by: int) -> None:
        node = self.leaves + room
        while node:
            self.count[node] += by
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, row) with the least room >= need, removed; None if no row fits."""
        node = self.leaves + need
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._change(room, -1)
        return room, self.rows[room].pop()


def pack(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit-decreasing: rows of piece numbers. Equal sizes go in their order."""
    tree, rows = RoomTree(capacity), []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = tree.take(sizes[i])
        if found is None:
            room, row = capacity, len(rows)
            rows.append([])
        else:
            room, row = found
        rows[row].append(i)
        if room > sizes[i]:
            tree.add(room - sizes[i], row)
    return rows


def pieces_of(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: full rows, then the rest."""
    return [(at, min(capacity, n - at)) for at in range(0, n, capacity)]


FIELDS = "row_id string, n_tokens int, ids binary, cu_seqlens array<int>, position_resets array<int>, doc_ids array<{}>, doc_starts array<int>"


def packed(docs: DataFrame, capacity: int = 2048, group_tokens: int = 500_000, pad: int = 50_256, vocab: str = VOCAB) -> DataFrame:
    """One row per packed line of ``capacity`` ids over ``docs(doc_id, text)``.

    ``cu_seqlens``: 0 and the end of each segment; ``position_resets``: where position ids start again at 0
    (each segment's start, and the padding's); ``doc_starts``: the token of its document a segment starts with.
    """
    kind = type_of(docs, "doc_id")

    def lines(group: list[tuple], part: int, first: int, of: pa.DataType) -> pa.RecordBatch:
        parts = [(doc, at, n, ids) for doc, ids in group for at, n in pieces_of(len(ids) // 2, capacity)]
        rows = pack([p[2] for p in parts], capacity)
        out: list[list] = [[] for _ in range(7)]
        for k, row in enumerate(rows):
            got = [parts[i] for i in row]
            ends = np.cumsum([0] + [p[2] for p in got]).tolist()
            body = b"".join(p[3][2 * p[1] : 2 * (p[1] + p[2])] for p in got)
            body += array("H", [pad] * (capacity - ends[-1])).tobytes()
            values = (f"{part}-{first + k}", ends[-1], body, ends, ends[:-1] + ([ends[-1]] if ends[-1] < capacity else []), [p[0] for p in got], [p[1] for p in got])
            for column, value in zip(out, values):
                column.append(value)
        kinds = [pa.string(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(of), pa.list_(pa.int32())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=[x.split()[0] for x in FIELDS.split(", ")])

    def run(batches):
        part = TaskContext.get().partitionId()
        group: list[tuple] = []
        held, made, of = 0, 0, pa.int64()
        for b in batches:
            of = b.schema.field("doc_id").type
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                text = text.as_py()
                if not text:
                    continue
                group.append((doc, encoder(vocab).encode(text)))
                held += len(group[-1][1]) // 2
                if held >= group_tokens:
                    batch = lines(group, part, made, of)
                    made += batch.num_rows
                    group, held = [], 0
                    yield batch
        if group:
            yield lines(group, part, made, of)

    return map_batches(docs.select("doc_id", "text"), run, FIELDS.format(kind))


def matrix(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, ID)


def positions(resets: list[int], capacity: int) -> np.ndarray:
    """Position ids of a row from its reset points."""
    out = np.arange(capacity)
    start = np.zeros(capacity, np.int64)
    start[resets] = resets
    return out - np.maximum.accumulate(start)
