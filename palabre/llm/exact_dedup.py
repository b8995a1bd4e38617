"""Exact duplicates by merged counting quotient filters and byte verification.

Texts are equal when they are the same bytes after lower-casing A-Z.

1. One pass over the texts gives each row a 64-bit fingerprint and a digest.
2. Each partition builds counting quotient filters of its fingerprints, one for
   each range of fingerprints. A hot text is one entry with a count.
3. The filters of a range are merged by their sorted remainders, in two levels. Ranges are
   cut so that a merged filter stays small however many rows there are.
4. Only rows whose fingerprint is counted more than once go on to verification,
   which groups them by their normalised bytes (summed up before the shuffle).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palabre.llm.common import ids_and_texts, keep_ids, stage
from palabre.llm.quotient_filter import CountingQuotientFilter

#: Rows for each range of fingerprints, about.
RANGE_ROWS = 500_000
#: Rows that a filter is built of at once.
BUILT_ROWS = 200_000
#: Groups in which the filters of a range are merged before those of the groups are.
LANES = 32

_DIGESTS = "doc_id long, fingerprint long, text_sha256 string"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pc.ascii_lower(batch.column("text"))
        data = texts.cast(pa.binary()).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(np.array([xxhash.xxh3_64_intdigest(d) for d in data], np.uint64).view(np.int64)),
                pa.array([hashlib.sha256(d).hexdigest() for d in data], pa.string()),
            ],
            names=["doc_id", "fingerprint", "text_sha256"],
        )


def _normalised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pc.ascii_lower(batch.column("text"))
        prints = [xxhash.xxh3_64_intdigest(t) for t in texts.cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.array(prints, np.uint64).view(np.int64)), texts],
            names=["doc_id", "fingerprint", "text"],
        )


def repeated_fingerprints(
    digests: DataFrame, range_rows: int = RANGE_ROWS, lanes: int = LANES
) -> DataFrame:
    """The fingerprints that occur more than once, by merging filters of the partitions.

    A filter is as large as its entries are many, so that many ranges cost no more than few.
    """
    rows = digests.count()
    range_bits = max(0, int(np.ceil(np.log2(max(1, rows / range_rows)))))

    def block(prints: np.ndarray) -> pd.DataFrame:
        ranges = prints >> np.uint64(64 - range_bits) if range_bits else np.zeros_like(prints)
        rest = prints << np.uint64(range_bits)
        order = np.argsort(ranges, kind="stable")
        names, first = np.unique(ranges[order], return_index=True)
        filters = [
            CountingQuotientFilter.build(part).to_bytes()
            for part in np.split(rest[order], first[1:])
        ]
        lane = TaskContext.get().partitionId() % lanes
        return pd.DataFrame({"part": names.astype(np.int64), "lane": lane, "block": filters})

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(batch["fingerprint"].to_numpy().view(np.uint64))
            if sum(map(len, held)) >= BUILT_ROWS:
                yield block(np.concatenate(held))
                held = []
        if held:
            yield block(np.concatenate(held))

    def merge(key: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
        merged = CountingQuotientFilter.merge_all(blocks["block"])
        found = merged.repeated() >> np.uint64(range_bits)
        if range_bits:
            found |= np.uint64(int(key[0])) << np.uint64(64 - range_bits)
        return pd.DataFrame({"fingerprint": found.view(np.int64)})

    def merge_lane(key: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
        merged = CountingQuotientFilter.merge_all(blocks["block"]).to_bytes()
        return pd.DataFrame({"part": [key[0]], "block": [merged]})

    blocks = digests.select("fingerprint").mapInPandas(build, "part long, lane int, block binary")
    lanes_merged = blocks.groupBy("part", "lane").applyInPandas(merge_lane, "part long, block binary")
    return lanes_merged.groupBy("part").applyInPandas(merge, "fingerprint long")


def exact_duplicates(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """For each row its group of equal texts: the row with the largest doc_id stays.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256``. Missing texts count as
    empty and are equal to each other. A row without a doc_id counts in its group but
    stays only if no row there has one. Rows that repeat a doc_id and text count each and
    get the same result. An empty table gives no rows; further columns are not read.
    """
    rows = ids_and_texts(docs)
    digests = stage(rows.mapInArrow(_digests, _DIGESTS), "digests")
    repeated = stage(repeated_fingerprints(digests, range_rows), "repeated")
    suspects = rows.mapInArrow(_normalised, "doc_id long, fingerprint long, text string").join(
        repeated, "fingerprint", "left_semi"
    )
    # Equal bytes meet here; copies are summed up before they are shuffled.
    groups = suspects.groupBy("text").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    verified = stage(
        groups.filter("group_size > 1").select(
            F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size"
        ),
        "groups",
    )
    joined = digests.join(verified, "text_sha256", "left")
    size = F.coalesce("group_size", F.lit(1).cast("long"))
    return joined.select(
        "doc_id",
        F.coalesce("keep_id", "doc_id").alias("keep_id"),
        size.alias("group_size"),
        F.coalesce(
            F.col("doc_id") == F.coalesce("keep_id", "doc_id"), F.col("keep_id").isNull()
        ).alias("kept"),
        "text_sha256",
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The documents without their exact copies, all columns kept.

    Of equal texts the row with the largest doc_id stays, once; rows without a doc_id
    cannot be named and all stay.
    """
    return keep_ids(docs, exact_duplicates(docs).filter("kept").select("doc_id"))
