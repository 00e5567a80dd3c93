"""Harmonic packing of token sequences.

A sequence holds `capacity` tokens. Class k takes pieces of more than
capacity/(k+1) and at most capacity/k tokens, and a bin of the class is full with k
of them, so a worker fills bins by counting, without looking at what others do. A
document gives whole sequences first; its rest is cut at the largest reciprocal
slot below its length until what is left fills its own slot but for a share
`slack`, so that full bins have next to no padding.

Bins that are not full when a worker ends are fewer than capacity pieces for each
class. Those of `group` workers go to one task, whatever the size of the input, and
are packed there best fit first, longest pieces first.

With `special=ADDED` the ids are those that the library tokenizers gives for the vocabulary file. They
are made by tiktoken from the same vocabulary, which takes about a quarter of the
time; a test holds both against each other.

Nulls and odd rows: a null text is empty and gives the end id alone; a document id
that repeats is packed each time. Runs of white space may have any length.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiloom.llm.common import in_batches, rows_of, stored

CAPACITY = 2048
END_ID = 1
#: Fixed value: what the vocabulary file adds to the ranks. Without it in `special` such text is text like any other.
ADDED = (("<|endoftext|>", 50256),)
_WORKER = 1 << 32
_CHUNK = 1 << 20
#: Between a letter or digit, one space and a letter or digit, no token spans the place before the space.
_SAFE = re.compile(r"(?<=[A-Za-z0-9])(?= [A-Za-z0-9])")

#: A run of white space is one word, but for its last character if something follows; longer runs than this are cut out, as the
#: search for words goes back through a run character by character, on a stack.
_LONG_RUN = 100_000
_WHITE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % _LONG_RUN)

Piece = tuple[int, int]  # start, length


@cache
def encoder(ranks_path: str, pattern: str, special: tuple[tuple[str, int], ...] = ()) -> Callable[[str], np.ndarray]:
    """The ids of a text; `pattern` cuts it into words, and each text of `special`, without spaces, becomes the id beside it."""
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(special))

    added = tuple(word for word, _ in special)

    def encode(text: str) -> np.ndarray:
        out, at = [], 0
        for run in _WHITE.finditer(text):
            end = run.end() - (run.end() < len(text) and not text.startswith(added, run.end()))
            out += [without_runs(text[at : run.start()]), np.array(encoding._encode_single_piece(text[run.start() : end]), "<u4")]
            at = end
        return np.concatenate([*out, without_runs(text[at:])])

    def without_runs(text: str) -> np.ndarray:
        parts, at = [], 0
        while len(text) - at > _CHUNK and (cut := _SAFE.search(text, at + _CHUNK)):
            parts.append(text[at : cut.start()])
            at = cut.start()
        return np.concatenate([np.array(encoding.encode(p, allowed_special="all"), "<u4") for p in (*parts, text[at:])])

    return encode


def cut(length: int, capacity: int = CAPACITY, slack: float = 1 / 32) -> Iterator[Piece]:
    """Pieces of a document of so many tokens."""
    start = 0
    while start < length:
        rest = length - start
        piece = capacity
        if rest < capacity:
            k = capacity // rest
            slot = capacity // k
            piece = rest if slot - rest <= slack * slot else capacity // (k + 1)
        yield start, piece
        start += piece


class Bins:
    """The open bin of each class. `put` gives the pieces of a bin that has become full."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.open: defaultdict[int, list[tuple]] = defaultdict(list)

    def put(self, piece: tuple, length: int) -> list[tuple]:
        k = self.capacity // length
        held = self.open[k]
        held.append(piece)
        return self.open.pop(k) if len(held) == k else []

    def rest(self) -> Iterator[tuple]:
        for held in self.open.values():
            yield from held


def best_fit(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Bin and offset of each piece: the longest first, each into the fullest bin that has room."""
    by_room: defaultdict[int, list[int]] = defaultdict(list)
    rooms = 0  # a bit for each room that some bin has
    out, bins = [(0, 0)] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        above = rooms >> lengths[i]
        if above:
            room = lengths[i] + (above & -above).bit_length() - 1
            number = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, number, bins = capacity, bins, bins + 1
        out[i] = number, capacity - room
        if room > lengths[i]:
            by_room[room - lengths[i]].append(number)
            rooms |= 1 << (room - lengths[i])
    return out


_FIELDS = [("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
_PIECES = pa.schema([("doc_id", pa.int64()), *_FIELDS, ("sequence_id", pa.int64()), ("offset", pa.int64()), ("worker", pa.int64())])
_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(
    docs: DataFrame, ranks_path: str, pattern: str, capacity: int = CAPACITY, end_id: int = END_ID,
    slack: float = 1 / 32, group: int = 16, special: tuple[tuple[str, int], ...] = (),
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of every piece."""

    def fill(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = TaskContext.get().partitionId()
        encode, bins = encoder(ranks_path, pattern, special), Bins(capacity)

        def pieces() -> Iterator[tuple]:
            sequence = worker * _WORKER
            for doc_id, text in rows_of(batches, "doc_id", "text"):
                ids = np.append(encode(text), np.uint32(end_id)).astype("<u4")
                for start, length in cut(len(ids), capacity, slack):
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    offset = 0
                    for piece in bins.put((doc_id, start, length, crc, len(ids)), length):
                        yield *piece, sequence, offset, worker
                        offset += piece[2]
                    sequence += offset > 0
            for piece in bins.rest():
                yield *piece, None, None, worker

        return in_batches(pieces(), _PIECES, 5000)

    # Both what is packed and what is left come from this one table: a second run of the same tasks may deal rows otherwise.
    first = stored(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(fill, _DDL + ", worker long"), "pieces")

    def fill_rest(key: tuple, left: pd.DataFrame) -> pd.DataFrame:
        left = left.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], ignore_index=True)
        places = best_fit(left["length"].tolist(), capacity)
        left["sequence_id"] = [-1 - (int(key[0]) * _WORKER + number) for number, _ in places]
        left["offset"] = [offset for _, offset in places]
        return left[[c.split()[0] for c in _DDL.split(", ")]]

    by_group = first.where("sequence_id IS NULL").withColumn("group", F.expr(f"worker div {group}"))
    rest = by_group.groupBy("group").applyInPandas(fill_rest, _DDL)
    return first.where("sequence_id IS NOT NULL").drop("worker").union(rest)
