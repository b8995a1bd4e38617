"""Removal of long byte strings that occur more than once in a corpus.

Every byte goes that is covered by a string of ``length`` bytes which also starts anywhere
else, in the same document or in another. Such strings are found by a suffix sort, but not
every suffix is sorted:

1. Each string of ``length`` bytes is anchored at its least-hashed gram. Equal strings have
   equal anchors, so a string whose anchor occurs once in the corpus is unique. Neighbouring
   strings share anchors: there is about one for 55 bytes, and only these are counted.
2. Strings with the same anchor in a row form a segment. Segments with equal bytes are one
   class; all strings of a class with two members are repeated. Classes are summed up before
   they are shuffled, so thousands of copies of a document are few rows.
3. One segment of each class goes to the suffix sort if its anchor has other classes too: the
   suffixes at the same distance from the anchor are sorted by hash-compared mergesort, and
   neighbours with ``length`` bytes in common (checked byte by byte) are repeated.
4. An anchor with more than ``bucket`` classes (the edge of a passage that very many documents
   share, each in words of its own) is not sorted in one task: digests of its strings are
   counted by Spark, summed up before the shuffle, with the same result.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palabre.llm.common import ids_and_texts, maybe_in, stage
from palabre.llm.suffix_sort import SuffixSorter, anchors

#: Bytes of a string that must not be repeated, and of a gram that anchors it.
LENGTH, GRAM = 200, 73
#: Classes of segments of one anchor that one task sorts.
BUCKET = 128
#: Segments that are sorted at once.
_AT_ONCE = 2048
#: Rows of segments that a worker holds before it sends them on.
_ROWS = 4096

_CLASS = ["anchor", "seg1", "seg2"]
_KEY = ["k1", "k2"]


def _keyed(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """``doc_id, text, k1, k2``: the bytes, and 120 bits of their SHA-256 as two longs."""
    rows = ids_and_texts(docs, id_column, text)
    digest = F.sha2("text", 256)

    def part(first: int) -> Column:
        return F.conv(F.substring(digest, first, 15), 16, 10).cast("long")

    return rows.select("doc_id", F.col("text").cast("binary").alias("text"), part(1).alias("k1"), part(16).alias("k2"))


def _anchor_hashes(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (np.frombuffer(t.as_buffer(), np.uint8) for t in batch.column("text"))
            found = np.concatenate([anchors(t, length, gram)[3] for t in texts] or [np.empty(0, np.uint64)])
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["anchor"])

    return run


def _pairs(firsts: np.ndarray, lasts: np.ndarray) -> bytes:
    return np.stack([firsts, lasts], axis=1).astype("<i8").tobytes()


def _joined(firsts: np.ndarray, lasts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ranges, with those that touch or overlap made one."""
    reach = np.maximum.accumulate(lasts)
    new = np.append(True, firsts[1:] > reach[:-1] + 1)
    at = np.flatnonzero(new)
    return firsts[at], reach[np.append(at[1:], len(firsts)) - 1]


_SEGMENTS = "k1 long, k2 long, anchor long, seg1 long, seg2 long, n long, first long, size int, at int, runs binary"


def _segments(length: int, gram: int, maybe):
    """Each document's distinct segments whose anchor may be repeated in the corpus."""

    names = [c.split()[0] for c in _SEGMENTS.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.int32()] * 2 + [pa.binary()]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        arrays = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def of(k1: int, k2: int, text: bytes) -> Iterator[tuple]:
        first, last, place, name = anchors(np.frombuffer(text, np.uint8), length, gram)
        name = name.view(np.int64)
        live = np.flatnonzero(maybe(name))
        rows: dict[tuple, list] = {}
        for lo, hi, at, hashed in zip(*(x[live].tolist() for x in (first, last, place, name)), strict=True):
            digest = hashlib.blake2b(text[lo : hi + length], digest_size=16).digest()
            rows.setdefault((hashed, digest), []).append((lo, hi, at - lo))
        for (hashed, digest), runs in rows.items():
            lo, hi, at = runs[0]
            if len(runs) == 1:
                packed = struct.pack("<qq", lo, hi)
            else:
                ends = np.array(runs, dtype=np.int64)
                packed = _pairs(*_joined(ends[:, 0], ends[:, 1]))
            yield (k1, k2, hashed, *struct.unpack("<qq", digest), len(runs), lo, hi - lo + 1, at, packed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for k1, k2, text in zip(*(batch.column(c) for c in ("k1", "k2", "text")), strict=True):
                for row in of(k1.as_py(), k2.as_py(), text.as_py()):
                    rows.append(row)
                    if len(rows) == _ROWS:
                        yield made(rows)
                        rows = []
            if rows:
                yield made(rows)

    return run


def _cut(length: int):
    """The bytes of the wanted segments of each text."""
    fields = [*_CLASS, "n", "at"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, segments in zip(batch.column("text"), batch.column("segments"), strict=True):
                whole, rows = text.as_py(), segments.as_py()
                arrays = [pa.array([r[f] for r in rows], pa.int32() if f == "at" else pa.int64()) for f in fields]
                cut = [whole[r["first"] : r["first"] + r["size"] + length - 1] for r in rows]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(cut, pa.binary())], names=[*fields, "segment"])

    return run


def _sort_buckets(length: int):
    """The repeated strings of single segments, by a suffix sort of whole buckets.

    Rows come sorted by anchor, so a bucket ends where the next one begins.
    """

    def judge(rows: pa.Table) -> pa.RecordBatch:
        columns = {c: rows.column(c).to_numpy() for c in (*_CLASS, "n", "at")}
        texts = rows.column("segment").to_pylist()
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        strings = sizes - length + 1
        data = np.frombuffer(b"".join(texts), np.uint8)
        which = np.repeat(np.arange(len(texts)), strings)
        within = np.arange(len(which)) - np.repeat(np.cumsum(strings) - strings, strings)
        bucket = np.cumsum(np.diff(columns["anchor"], prepend=columns["anchor"][:1]) != 0)
        group = bucket[which] * length + (columns["at"][which] - within)
        found = SuffixSorter(data, length).repeated((np.cumsum(sizes) - sizes)[which] + within, group)
        edges = np.diff(np.append(found, False).astype(np.int8), prepend=0)
        # A run also ends where its segment does.
        edge_first = np.flatnonzero((edges == 1)[:-1] | (found & (within == 0)))
        ends = found & np.append(~found[1:] | (within[1:] == 0), True)
        edge_last = np.flatnonzero(ends)
        ranges: dict[int, list] = {}
        for lo, hi in zip(edge_first.tolist(), edge_last.tolist(), strict=True):
            ranges.setdefault(int(which[lo]), []).append((within[lo], within[hi]))
        kept = [i for i in ranges if columns["n"][i] == 1]
        arrays = [pa.array(columns[c][kept]) for c in _CLASS]
        packed = pa.array([np.array(ranges[i], dtype="<i8").tobytes() for i in kept], pa.binary())
        return pa.RecordBatch.from_arrays([*arrays, packed], names=[*_CLASS, "ranges"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) < _AT_ONCE:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            anchor = rows.column("anchor").to_numpy()
            whole = int(np.searchsorted(anchor, anchor[-1]))
            if whole:
                yield judge(rows.slice(0, whole))
            held = rows.slice(whole).combine_chunks().to_batches()
        if held:
            yield judge(pa.Table.from_batches(held).combine_chunks())

    return run


#: Neighbouring strings that are told apart at once, then those of what is left, and so on.
_SLICES = (16, 4, 1)


def _count_strings(segments: DataFrame, length: int, gram: int) -> DataFrame:
    """The repeated strings of single segments in buckets of any size, by counted digests.

    Strings go by their distance before the anchor, which equal ones have in common. Those of
    a slice of distances share a core: if it is in no other segment, none of them is repeated.
    If another segment has all the bytes of the slice, all of them are. What is still open
    goes on in smaller slices, down to the strings themselves.
    """
    strings = F.length("segment") - (length - 1)
    wide = -(-(length - gram + 1) // _SLICES[0]) * _SLICES[0]
    open_ = segments.select(*_CLASS, F.lit(0).alias("slice"))
    found = None
    for width in _SLICES:
        parts = F.sequence(F.col("slice"), F.least(F.col("slice") + (wide - 1), F.col("at")), F.lit(width))
        inside = open_.join(segments, _CLASS).withColumn("slice", F.explode(parts)).select(
            *_CLASS,
            "n",
            "segment",
            "at",
            "slice",
            # The distances of the slice that the segment has.
            F.greatest("slice", F.col("at") - strings + 1).alias("near"),
            F.least(F.col("slice") + (width - 1), F.col("at")).alias("far"),
        ).filter("near <= far")
        core = F.substring("segment", F.col("at") - F.col("slice") + 1, F.lit(length - width + 1))
        bytes_ = F.substring("segment", F.col("at") - F.col("far") + 1, F.col("far") - F.col("near") + length)
        slices = inside.select(
            *_CLASS, "n", "at", "slice", "near", "far", F.sha2(core, 256).alias("core"), F.sha2(bytes_, 256).alias("whole")
        )
        slices = stage(slices, "slices")
        same = ["anchor", "slice", "near", "far", "whole"]
        wholes = slices.groupBy(*same, "core").agg(F.count(F.lit(1)).alias("wholes"), F.min("seg1").alias("one"))
        cores = wholes.groupBy("anchor", "slice", "core").agg(
            F.sum("wholes").alias("cores"), F.count(F.lit(1)).alias("kinds")
        )
        live = slices.join(cores.filter("cores > 1").drop("cores"), ["anchor", "slice", "core"])
        judged = stage(live.join(wholes.select(*same, "one", (F.col("wholes") > 1).alias("done")), same), "judged")
        done = judged.filter("done and n = 1").select(
            *_CLASS, F.struct((F.col("at") - F.col("far")).alias("first"), (F.col("at") - F.col("near")).alias("last")).alias("range")
        )
        found = done if found is None else found.unionByName(done)
        # One of equal slices goes on for those that share only a part with them.
        open_ = judged.filter("not done or (kinds > 1 and seg1 = one)").select(*_CLASS, "slice")
        wide = width
    # At most ``length`` ranges of one segment.
    lists = found.groupBy(*_CLASS).agg(F.collect_set("range").alias("found"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for ranges in batch.column("found").to_pylist():
                ends = np.array(sorted((r["first"], r["last"]) for r in ranges), dtype=np.int64)
                packed.append(_pairs(*_joined(ends[:, 0], ends[:, 1])))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in _CLASS), pa.array(packed, pa.binary())], names=[*_CLASS, "ranges"]
            )

    return lists.mapInArrow(pack, "anchor long, seg1 long, seg2 long, ranges binary")


def _place_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges within a segment as ranges of its document."""
    for batch in batches:
        runs = [
            own if ranges is None else (np.frombuffer(ranges, "<i8") + first).tobytes()
            for first, own, ranges in zip(*(batch.column(c).to_pylist() for c in ("first", "runs", "ranges")), strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("k1"), batch.column("k2"), pa.array(runs, pa.binary())], names=["k1", "k2", "runs"]
        )


def _remove(length: int, digests_only: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, gone, spans, kept = [], [], [], []
            for text, runs in zip(batch.column("text"), batch.column("runs"), strict=True):
                whole = text.as_py()
                data = np.frombuffer(whole, np.uint8)
                ranges = np.frombuffer(b"".join(runs.as_py() or []), "<i8").reshape(-1, 2)
                change = np.zeros(len(data) + 1, dtype=np.int64)
                np.add.at(change, ranges[:, 0], 1)
                np.add.at(change, ranges[:, 1] + length, -1)
                out = np.cumsum(change) > 0
                edges = np.flatnonzero(np.diff(out.view(np.int8), prepend=0)).tolist()
                found = [{"start": a, "end": b} for a, b in zip(edges[0::2], edges[1::2], strict=True)]
                rest = data[~out[:-1]].tobytes()
                sizes.append(len(data))
                gone.append(len(data) - len(rest))
                spans.append(len(found) if digests_only else found)
                kept.append(hashlib.sha256(rest).hexdigest() if digests_only else rest)
            span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            kinds = (pa.int64(), pa.string()) if digests_only else (pa.list_(span), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(spans, kinds[0]), pa.array(kept, kinds[1])],
                names=["doc_id", "n_bytes", "n_removed", *_names(digests_only)],
            )

    return run


def _names(digests_only: bool) -> tuple[str, str]:
    return ("n_spans", "kept_sha256") if digests_only else ("spans", "kept")


def repeated_runs(keyed: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket: int = BUCKET) -> DataFrame:
    """``k1, k2, runs``: for each distinct text ranges of starts of repeated strings."""
    texts = keyed.select("k1", "k2", "text").filter(F.length("text") >= length)
    counted = texts.select("text").mapInArrow(_anchor_hashes(length, gram), "anchor long")
    repeated = stage(counted.groupBy("anchor").count().filter("count > 1").select("anchor"), "anchors")
    maybe = maybe_in(repeated, "anchor", 1 << 27, bits_each=8)
    found = texts.mapInArrow(_segments(length, gram, maybe), _SEGMENTS)
    segments = stage(found.join(repeated, "anchor", "left_semi"), "segments")

    # Any member of a class can stand for it; "first" takes all fields from one row.
    one = [F.first(c).alias(c) for c in ("k1", "k2", "first", "size", "at")]
    classes = stage(segments.groupBy(*_CLASS).agg(F.sum("n").alias("n"), *one), "classes")
    sizes = stage(classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("classes")).filter("classes > 1"), "sizes")
    open_ = stage(classes.join(sizes, "anchor"), "open")

    wanted = open_.groupBy(*_KEY).agg(
        F.collect_list(F.struct(*_CLASS, "n", "first", "size", "at")).alias("segments")
    )
    likely = maybe_in(open_, F.xxhash64("k1", "k2"))
    holders = texts.filter(likely.column(F.xxhash64("k1", "k2"))).dropDuplicates(_KEY)
    cut = holders.join(wanted, _KEY).mapInArrow(
        _cut(length), "anchor long, seg1 long, seg2 long, n long, at int, segment binary"
    )
    cut = stage(cut.join(sizes, "anchor"), "cut")
    small = cut.filter(F.col("classes") <= bucket).drop("classes").repartition("anchor").sortWithinPartitions("anchor")
    partial = small.mapInArrow(_sort_buckets(length), "anchor long, seg1 long, seg2 long, ranges binary").unionByName(
        _count_strings(cut.filter(F.col("classes") > bucket), length, gram)
    )
    whole = classes.filter("n > 1").select(*_CLASS, F.lit(None).cast("binary").alias("ranges"))
    verdicts = stage(whole.unionByName(partial), "verdicts")
    placed = segments.join(verdicts, _CLASS).mapInArrow(_place_runs, "k1 long, k2 long, runs binary")
    # Copies of a document have equal runs, which a set holds once.
    return stage(placed.groupBy(*_KEY).agg(F.collect_set("runs").alias("runs")), "runs")


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    bucket: int = BUCKET,
    digests_only: bool = False,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Each document's spans of repeated strings and the bytes that are left.

    Returns ``doc_id, n_bytes, n_removed, spans, kept``: spans are the maximal removed
    runs, as ``start`` and ``end`` (behind the last byte); ``kept`` holds the other bytes.
    With ``digests_only`` there are ``n_spans`` and ``kept_sha256`` (hex) in their place.
    Strings are judged on the input, not on what is left. One row comes back for each row:
    repeated rows are copies of each other like any equal texts, whatever their id; rows
    without an id are judged too. A missing text is empty; texts shorter than ``length``
    lose nothing. An empty table gives no rows; further columns are not read.
    """
    keyed = _keyed(docs, id_column, text)
    runs = repeated_runs(keyed, length, gram, bucket)
    likely = maybe_in(runs, F.xxhash64("k1", "k2"))
    hit = likely.column(F.xxhash64("k1", "k2"))
    hits = keyed.filter(hit).join(runs, _KEY, "left").select("doc_id", "text", "runs")
    others = keyed.filter(~hit).select("doc_id", "text", F.lit(None).cast("array<binary>").alias("runs"))
    a, b = _names(digests_only)
    kinds = ("long", "string") if digests_only else ("array<struct<start:long,end:long>>", "binary")
    schema = f"doc_id long, n_bytes long, n_removed long, {a} {kinds[0]}, {b} {kinds[1]}"
    return hits.unionByName(others).mapInArrow(_remove(length, digests_only), schema)
