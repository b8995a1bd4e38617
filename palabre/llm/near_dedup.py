"""Near duplicates by MinHash bands and sequential Bayesian verification.

1. Each text becomes a set of word shingles and a MinHash signature. Texts with equal
   sets form a class, of which one member goes on.
2. Signatures are cut into bands; classes with an equal band meet in a bucket. Of each
   bucket every member is paired with its smallest member only, never all with all.
3. A pair's signatures are compared batch by batch. It is pruned as soon as the
   posterior probability that its similarity reaches the threshold is below the
   chosen miss probability. Survivors are verified on their whole sets.
4. Links make components. In buckets that still hold several, members outside the
   largest one are compared with all others, in blocks: a task gets a bounded number of
   each and gives back links only, so no link is lost and no pairs are written.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palabre.llm.common import ids_and_texts, keep_ids, only_ids, stage
from palabre.llm.components import connected_components
from palabre.llm.text import mix, shingles

SHINGLE_WORDS = 5
THRESHOLD_PERCENT = 75
BANDS, BAND_ROWS = 40, 5
#: Hashes compared at a time, and the posterior probability below which a pair is pruned.
BATCH, MISS = 20, 1e-7
#: Members of a bucket, outside its largest component and of all, that one task compares.
OUTSIDE_ROWS, MEMBER_ROWS = 256, 512

_HASHES = BANDS * BAND_ROWS
_RANDOM = np.random.default_rng(75)
_FACTOR = (_RANDOM.integers(0, 1 << 31, _HASHES, dtype=np.uint32) * 2 + 1)[:, None]
_SHIFT = _RANDOM.integers(0, 1 << 32, _HASHES, dtype=np.uint32)[:, None]
_BAND_FACTOR = _RANDOM.integers(0, 1 << 63, BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(items: np.ndarray) -> np.ndarray:
    """The low 16 bits of each hash function's least value over the set."""
    low = (items >> np.uint64(32)).astype(np.uint32)
    least = np.full(_HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for start in range(0, len(low), 256):
        part = low[None, start : start + 256] * _FACTOR
        part += _SHIFT
        np.minimum(least, part.min(axis=1), out=least)
    # The least values are small numbers; their mixed low bits tell them apart.
    return mix(least.astype(np.uint64)).astype(np.uint16)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each signature (rows)."""
    bands = signatures.reshape(len(signatures), BANDS, BAND_ROWS).astype(np.uint64)
    keys = (bands * _BAND_FACTOR).sum(axis=2) + np.arange(BANDS, dtype=np.uint64)
    return mix(mix(keys) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


@lru_cache
def least_matches(threshold_percent: int, miss: float, hashes: int = _HASHES) -> np.ndarray:
    """Matches needed after each batch of hashes for a pair to stay.

    With a uniform prior the similarity after m matches in n hashes has a Beta(m + 1,
    n - m + 1) posterior. Its upper tail from t on is the chance of at most m
    successes in n + 1 trials of probability t.
    """
    t = threshold_percent / 100
    needed = []
    for n in range(BATCH, hashes + 1, BATCH):
        tail, m = 0.0, 0
        while True:
            tail += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if tail >= miss:
                break
            m += 1
        needed.append(m)
    return np.array(needed)


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sizes, keys, signs = [], [], []
        for text in batch["text"]:
            items = shingles(text, SHINGLE_WORDS)
            sizes.append(len(items))
            # Two sums of differently mixed items name the set; both must agree.
            sums = (items.sum(dtype=np.uint64), mix(items + np.uint64(1)).sum(dtype=np.uint64))
            keys.append(f"{len(items):x}-{int(sums[0]):016x}{int(sums[1]):016x}")
            signs.append(signature(items).tobytes() if len(items) else None)
        yield pd.DataFrame(
            {"doc_id": batch["doc_id"], "n_shingles": sizes, "set_key": keys, "signature": signs}
        )


def _bands(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if len(batch):
            signs = np.frombuffer(b"".join(batch["signature"]), np.uint16).reshape(-1, _HASHES)
            yield pd.DataFrame(
                {
                    "bucket": band_keys(signs).ravel(),
                    "member": np.repeat(batch["doc_id"].to_numpy(), BANDS),
                    "size": np.repeat(batch["n_shingles"].to_numpy(), BANDS),
                }
            )


def _alive(left: np.ndarray, right: np.ndarray, needed: np.ndarray) -> np.ndarray:
    """Which pairs of rows are left after all batches of hashes."""
    alive = np.arange(max(len(left), len(right)))
    left, right = np.broadcast_arrays(left, right)
    matches = np.zeros(len(alive), dtype=np.int64)
    for k, least in enumerate(needed):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches[alive] += (left[alive, part] == right[alive, part]).sum(axis=1)
        alive = alive[matches[alive] >= least]
    return alive


def _signatures(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(-1, _HASHES)


def _pruned(needed: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                sides = _signatures(batch["signature_a"]), _signatures(batch["signature_b"])
                yield batch[["a", "b"]].iloc[_alive(*sides, needed)]

    return run


def _compared(percent: int, needed: np.ndarray):
    """Links of the outside members of a bucket's block, one to each other component."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        bucket, links = int(key[0]), []
        outside, all_ = rows[rows["outside"]], rows[~rows["outside"]]
        if not len(outside) or not len(all_):
            return pd.DataFrame({"a": [], "b": []}, dtype=np.int64)
        signs = _signatures(all_["signature"])
        bands = band_keys(signs)
        ids, parts = all_["member"].to_numpy(), all_["part"].to_numpy()
        inner = parts == all_["main"].to_numpy()
        sets = [shingles(t, SHINGLE_WORDS) for t in all_["text"]]
        sizes = np.array([len(x) for x in sets])
        own_signs = _signatures(outside["signature"])
        for i, (one, part, text) in enumerate(
            zip(outside["member"], outside["part"], outside["text"], strict=True)
        ):
            items = shingles(text, SHINGLE_WORDS)
            same_band = bands == band_keys(own_signs[i : i + 1])
            # A pair that meets in several buckets is compared in the first of them.
            first = bands[np.arange(len(bands)), same_band.argmax(axis=1)] == bucket
            apart = (parts != part) & (inner | (ids < one))
            near = 100 * np.minimum(sizes, len(items)) >= percent * np.maximum(sizes, len(items))
            wanted = np.flatnonzero(first & apart & near)
            wanted = wanted[_alive(own_signs[i : i + 1], signs[wanted], needed)] if len(wanted) else wanted
            if not len(wanted):
                continue
            joined = np.concatenate([sets[j] for j in wanted])
            at = np.minimum(np.searchsorted(items, joined), len(items) - 1)
            starts = np.cumsum(sizes[wanted]) - sizes[wanted]
            common = np.add.reduceat((items[at] == joined).astype(np.int64), starts)
            linked = wanted[100 * common >= percent * (sizes[wanted] + len(items) - common)]
            _, firsts = np.unique(parts[linked], return_index=True)
            links += [(one, b) for b in ids[linked[firsts]]]
        return pd.DataFrame(links, columns=["a", "b"]).astype(np.int64)

    return run


def _verified(percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            linked = np.zeros(len(batch), dtype=bool)
            for i, (a, b, x, y) in enumerate(
                zip(batch["a"], batch["b"], batch["text_a"], batch["text_b"], strict=True)
            ):
                one = shingles(x, SHINGLE_WORDS)
                if b not in held:  # the smallest members of buckets come again and again
                    if len(held) >= 64:
                        held.clear()
                    held[b] = shingles(y, SHINGLE_WORDS)
                two = held[b]
                common = len(np.intersect1d(one, two, assume_unique=True))
                linked[i] = 100 * common >= percent * (len(one) + len(two) - common)
            yield batch[["a", "b"]][linked]

    return run


def _near_size(x: Column, y: Column, percent: int) -> Column:
    return (100 * F.least(x, y)) >= (percent * F.greatest(x, y))


def _links(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The pairs that pass the Bayesian comparison and the exact verification."""

    def side(name: str, column: str) -> DataFrame:
        return members.select(F.col("doc_id").alias(name), F.col(column).alias(f"{column}_{name}"))

    signed = pairs.join(side("a", "signature"), "a").join(side("b", "signature"), "b")
    left = stage(signed.mapInPandas(_pruned(least_matches(percent, MISS)), "a long, b long"), "survivors")
    texts = left.join(side("a", "text"), "a").join(side("b", "text"), "b")
    return stage(texts.mapInPandas(_verified(percent), "a long, b long"), "links")


def _leftover_links(buckets: DataFrame, links: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Links within buckets whose members are still in several components."""
    parts = connected_components(links).withColumnRenamed("id", "member")
    placed = buckets.join(parts, "member", "left").select(
        "bucket", "member", F.coalesce("component", "member").alias("part")
    )
    counted = placed.groupBy("bucket", "part").agg(F.count(F.lit(1)).alias("n"))
    largest = (
        counted.groupBy("bucket")
        .agg(F.max(F.struct("n", "part")).alias("most"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts"))
        # In a bucket of two, the pair was compared already.
        .filter("parts > 1 and n > 2")
        .select(
            "bucket",
            F.col("most.part").alias("main"),
            F.ceil((F.col("n") - F.col("most.n")) / OUTSIDE_ROWS).alias("blocks"),
            F.ceil(F.col("n") / MEMBER_ROWS).alias("chunks"),
        )
    )
    mixed = stage(placed.join(largest, "bucket"), "mixed")

    def dealt(own: str, other: str, outside: bool) -> DataFrame:
        """Each row goes to one part by its id, and to all parts of the other kind."""
        names = ("block", "chunk") if outside else ("chunk", "block")
        last = (F.col(other) - 1).cast("int")
        return mixed.select(
            "bucket", "member", "part", "main",
            F.lit(outside).alias("outside"),
            F.pmod(F.xxhash64("member"), F.col(own)).cast("int").alias(names[0]),
            F.explode(F.sequence(F.lit(0), last)).alias(names[1]),
        )

    rows = dealt("blocks", "chunks", True).filter("part <> main").unionByName(dealt("chunks", "blocks", False))
    full = rows.join(members.withColumnRenamed("doc_id", "member"), "member")
    compare = _compared(percent, least_matches(percent, MISS))
    return stage(full.groupBy("bucket", "block", "chunk").applyInPandas(compare, "a long, b long"), "links")


def near_duplicates(docs: DataFrame, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """For each document its number of shingles and its group of near duplicates.

    Returns ``doc_id, n_shingles, component_id, kept``. Documents are linked when
    ``100 * intersection >= percent * union`` of their sets of five-word shingles; shorter
    texts are one shingle. Missing texts and texts without words are linked with nothing.
    Equal sets are always linked. A pair at the threshold shares no band with a
    probability of (1 - 0.75^5)^40, 2 in 100,000, and less the more alike it is. Rows
    without a doc_id are left out; repeated rows give repeated results.
    """
    texts = ids_and_texts(docs).filter(F.col("doc_id").isNotNull())
    sets = stage(
        texts.mapInPandas(_sets, "doc_id long, n_shingles long, set_key string, signature binary"),
        "sets",
    )
    least = F.min(F.struct("doc_id", "n_shingles", "signature")).alias("head")
    heads = stage(
        sets.filter("n_shingles > 0").groupBy("set_key").agg(least).select("set_key", "head.*"), "heads"
    )
    bands = heads.mapInPandas(_bands, "bucket long, member long, size long")
    shared = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    buckets = stage(bands.join(shared, "bucket", "left_semi"), "buckets")
    ids = stage(buckets.select(F.col("member").alias("doc_id")).distinct(), "ids")
    members = stage(
        only_ids(texts, ids)
        .dropDuplicates(["doc_id"])
        .join(heads.select("doc_id", "signature"), "doc_id"),
        "members",
    )

    first = buckets.groupBy("bucket").agg(F.min(F.struct("member", "size")).alias("pivot"))
    near = _near_size(F.col("size"), F.col("pivot.size"), percent)
    star = buckets.join(first, "bucket").filter((F.col("member") != F.col("pivot.member")) & near)
    star = star.select(F.col("member").alias("a"), F.col("pivot.member").alias("b")).distinct()
    links = _links(star, members, percent)

    more = _leftover_links(buckets, links, members, percent)
    linked = connected_components(links.unionByName(more))

    named = heads.join(linked, F.col("doc_id") == F.col("id"), "left").select(
        "set_key", F.coalesce("component", "doc_id").alias("component_id")
    )
    return (
        sets.select("doc_id", "n_shingles", "set_key")
        .join(named, "set_key", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce("component_id", "doc_id").alias("component_id"),
            (F.col("doc_id") == F.coalesce("component_id", "doc_id")).alias("kept"),
        )
    )


def drop_near_duplicates(docs: DataFrame, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """The documents with one member of each group of near duplicates, the smallest doc_id.

    All columns are kept; documents without words and rows without a doc_id stay.
    """
    return keep_ids(docs, near_duplicates(docs, percent).filter("kept").select("doc_id"))
