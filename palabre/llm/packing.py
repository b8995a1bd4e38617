"""Best-fit packing of token sequences with dominance reduction.

Packing depends on nothing but how many pieces there are of each length, and there are
no more lengths than a sequence has tokens. So the plan is made from that histogram, of a
size fixed by the capacity: sets of lengths and how often each set is filled. Spark
makes the pieces, counts them, numbers those of a length and looks up their places.

The plan first fixes sets that provably dominate every other set with the same longest
piece (the reduction of Martello and Toth), on what is left it packs best-fit in order
of decreasing length.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import SparkFiles
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from palabre.llm.common import ids_and_texts, stage

CAPACITY = 2048
END_ID = 0
#: Pieces that are numbered within one task, about.
NUMBERED = 100_000
# Fixed value: how byte-level BPE files of this kind part a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


#: Texts with so many blanks in a row are encoded by the tokenizers library itself.
LONG_BLANKS = 20_000
_BLANKS = re.compile(r"\s{%d}" % LONG_BLANKS)


@dataclass(frozen=True)
class Filled:
    """``times`` sequences, each with ``uses`` pieces of each of the lengths."""

    pieces: tuple[tuple[int, int], ...]
    times: int


def _dominating(counts: np.ndarray, longest: int, capacity: int) -> tuple[int, ...] | None:
    """The lengths which, next to one piece of ``longest``, dominate all other choices.

    A set dominates another one if the other's pieces can be dealt out so that each
    heap fits where one piece of the set stands: then swapping them costs nothing.
    """
    room = capacity - longest
    left = counts.copy()
    left[longest] -= 1
    sizes = np.flatnonzero(left[: room + 1])
    if not len(sizes):
        return ()
    largest = int(sizes[-1])
    if largest == room:
        return (largest,)
    smallest = np.repeat(sizes[:3], np.minimum(left[sizes[:3]], 3))[:3]
    if len(smallest) < 2 or smallest[:2].sum() > room:
        return (largest,)
    if len(smallest) == 3 and smallest.sum() <= room:
        return None
    # At most two more fit. The best pair sum, and the largest piece that can be the
    # smaller one of a pair:
    best, second = 0, 0
    for a in sizes[::-1]:
        left[a] -= 1
        fitting = np.flatnonzero(left[: min(room - a, a) + 1])
        left[a] += 1
        if len(fitting):
            best, second = max(best, int(a + fitting[-1])), max(second, int(fitting[-1]))
    if best <= largest:
        return (largest,)
    left[largest] -= 1
    beside = np.flatnonzero(left[: room - largest + 1])
    if len(beside) and int(beside[-1]) >= second:
        return (largest, int(beside[-1]))
    return None


def reduce_by_dominance(counts: np.ndarray, capacity: int) -> tuple[list[Filled], np.ndarray]:
    """Fix dominating sets as long as there are any; also returns the counts left over."""
    counts, fixed = counts.astype(np.int64).copy(), []
    again = True
    while again:
        again = False
        for longest in np.flatnonzero(counts)[::-1].tolist():
            while counts[longest]:
                others = _dominating(counts, longest, capacity)
                if others is None:
                    break
                lengths, uses = np.unique((longest, *others), return_counts=True)
                times = int((counts[lengths] // uses).min())
                counts[lengths] -= uses * times
                fixed.append(Filled(tuple(zip(lengths.tolist(), uses.tolist(), strict=True)), times))
                again = True
    return fixed, counts


def best_fit(counts: np.ndarray, capacity: int) -> list[Filled]:
    """Longest pieces first, each in the fullest sequence with room; alike ones at once."""
    open_: list[list[Filled]] = [[] for _ in range(capacity + 1)]
    filled = np.zeros(capacity + 1, dtype=bool)

    def put(room: int, one: Filled) -> None:
        open_[room].append(one)
        filled[room] = True

    for length in np.flatnonzero(counts)[::-1].tolist():
        n = int(counts[length])
        while n:
            rooms = np.flatnonzero(filled[length:])
            room = length + int(rooms[0]) if len(rooms) else capacity
            each = room // length
            one = open_[room].pop() if len(rooms) else Filled((), max(1, n // each))
            if len(rooms):
                filled[room] = bool(open_[room])
            full = min(one.times, n // each)
            if full:
                put(room - each * length, Filled((*one.pieces, (length, each)), full))
                n -= full * each
            spare = one.times - full
            if n and spare and n < each:
                put(room - n * length, Filled((*one.pieces, (length, n)), 1))
                n, spare = 0, spare - 1
            if spare and one.pieces:
                put(room, Filled(one.pieces, spare))
    return [one for room in open_ for one in room]


def plan_packing(counts: np.ndarray, capacity: int = CAPACITY) -> list[Filled]:
    """Sequences for ``counts[n]`` pieces of each length n."""
    fixed, rest = reduce_by_dominance(counts, capacity)
    return fixed + best_fit(rest, capacity)


def _places(plan: list[Filled]) -> dict[str, np.ndarray]:
    """Where the pieces of each length go, in the order of their numbers."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for one in plan:
        offset = 0
        for length, uses in one.pieces:
            first = used.get(length, 0)
            rows.append((length, first, one.times, base, offset))
            used[length] = first + uses * one.times
            offset += uses * length
        base += one.times
    names = ("length", "first", "times", "base", "offset")
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, len(names))
    return dict(zip(names, table.T, strict=True))


@lru_cache(maxsize=2)
def _encoding(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a tokenizers file as an encoding with the same ids."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    special = {t["content"] for t in model["added_tokens"]}
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    ranks = {
        bytes(byte_of[c] for c in token): rank
        for token, rank in model["model"]["vocab"].items()
        if token not in special
    }
    return tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str], list[int]]:
    """Texts to ids as the tokenizers library has them, without tokens it would put around them.

    The library finds the file's added tokens in a text before all else, special ones too:
    the leftmost first, of those the longest.
    """
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    encoding = _encoding(path)
    whole = Tokenizer.from_file(path)
    added = {t["content"]: t["id"] for t in model["added_tokens"]}
    if any(t.get(flag) for t in model["added_tokens"] for flag in ("single_word", "lstrip", "rstrip")):
        raise ValueError(f"{path} has added tokens that take in or need what is beside them")
    parted = re.compile(f"({'|'.join(map(re.escape, sorted(added, key=len, reverse=True)))})") if added else None

    def encode(text: str) -> list[int]:
        # tiktoken's pattern engine needs stack for each blank of a run: it panics on very long ones.
        if len(text) > LONG_BLANKS and _BLANKS.search(text):
            return whole.encode(text, add_special_tokens=False).ids
        ids: list[int] = []
        for i, part in enumerate(parted.split(text) if parted else [text]):
            if i % 2:
                ids.append(added[part])
            elif part:
                ids.extend(encoding.encode_ordinary(part))
        return ids

    return encode


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    digests_only: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids``: documents as pieces of at most ``capacity`` ids.

    ``end_id`` ends each document. Of a longer one all pieces but the first are full.
    With ``digests_only`` the CRC-32 of the little-endian 32-bit ids takes their place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer if os.path.exists(tokenizer) else SparkFiles.get(os.path.basename(tokenizer))
        encode = encoder(path)
        shown = pa.int64() if digests_only else pa.list_(pa.int32())
        for batch in batches:
            rows, row_of = [], []
            for row, text in enumerate(batch.column("text")):
                ids = np.array([*encode(text.as_py()), end_id], dtype="<u4")
                first = (len(ids) - 1) % capacity + 1
                starts = [0, *range(first, len(ids), capacity)]
                for piece, (start, end) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                    part = ids[start:end]
                    rows.append((piece, start, end - start, zlib.crc32(part.tobytes()) if digests_only else part))
                    row_of.append(row)
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = (pa.int32(), pa.int64(), pa.int64(), shown)
            # Arrow keeps ids whole beside a missing one; pandas would make them floats.
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row_of, pa.int64())),
                 *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["doc_id", "piece", "start", "length", name],
            )

    name, kind = ("ids_crc32", "long") if digests_only else ("ids", "array<int>")
    schema = f"doc_id long, piece int, start long, length long, {name} {kind}"
    return ids_and_texts(docs).mapInArrow(run, schema)


def assign_sequences(pieces: DataFrame, capacity: int = CAPACITY, numbered: int = NUMBERED) -> DataFrame:
    """Adds ``sequence_id`` and ``offset``: sequences of at most ``capacity`` without gaps.

    ``pieces`` has ``doc_id, piece, length`` and is read twice, so it should be stored.
    Pieces of a length are numbered in parts of about ``numbered`` rows, so that a length
    which very many documents share isn't numbered in one task.
    """
    spark = pieces.sparkSession
    histogram = pieces.groupBy("length").count().collect()  # at most ``capacity`` rows
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram:
        counts[length] = n
    places = _places(plan_packing(counts, capacity))
    parts = spark.createDataFrame(
        [(int(n), int(-(-counts[n] // numbered))) for n in np.flatnonzero(counts)],
        "length long, parts long",
    )
    # One row for each length: bounded by the capacity.
    dealt = pieces.join(F.broadcast(parts), "length").withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "piece"), F.col("parts"))
    )
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = dealt.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")).select(
        "length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    within = Window.partitionBy("length", "part").orderBy("doc_id", "piece")
    ranked = dealt.withColumn("row", F.row_number().over(within)).join(firsts, ["length", "part"])
    columns = pieces.columns
    ranked = ranked.select(*columns, (F.col("first") + F.col("row") - 1).alias("number"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = places["length"] * (1 << 48) + places["first"]
        for batch in batches:
            number, length = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("number", "length"))
            at = np.searchsorted(keys, length * (1 << 48) + number, side="right") - 1
            turn, which = np.divmod(number - places["first"][at], places["times"][at])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(places["base"][at] + which),
                 pa.array(places["offset"][at] + turn * length)],
                names=[*columns, "sequence_id", "offset"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    digests_only: bool = False,
) -> DataFrame:
    """All documents as pieces with their places in sequences of at most ``capacity`` ids.

    Returns ``doc_id, piece, start, length, ids`` (or ``ids_crc32``), ``sequence_id, offset``.
    ``tokenizer`` is a byte-level BPE file of the tokenizers library; strings of its added
    tokens get their ids, as there. A missing or empty text is the end id alone. Repeated rows
    are packed as often as they occur, rows without a doc_id too. No row is dropped.
    """
    pieces = stage(token_pieces(docs, tokenizer, capacity, end_id, digests_only), "pieces")
    return assign_sequences(pieces, capacity)
