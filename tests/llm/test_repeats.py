"""op11: the suffix sort by itself, and removal against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from palabre.llm.common import bound_batches
from palabre.llm.repeats import remove_repeats
from palabre.llm.suffix_sort import PrefixHashes, SuffixSorter, anchors


def brute(texts, length):
    datas = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in datas for i in range(len(d) - length + 1))
    out = []
    for d in datas:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(d, gone, strict=True) if not g)
        starts = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(d), len(d) - len(kept), starts, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("alphabet", [b"ab", b"abcdefgh"])
def test_suffixes_are_sorted_by_their_bytes(alphabet):
    rnd = random.Random(len(alphabet))
    data = bytes(rnd.choice(alphabet) for _ in range(3000)) * 2
    length = 24
    starts = np.array(rnd.sample(range(len(data) - length), 900))
    groups = np.array([rnd.randrange(7) for _ in starts])
    sorter = SuffixSorter(np.frombuffer(data, np.uint8), length)
    order = sorter.sort(starts, groups)
    keys = [(g, data[s : s + length]) for g, s in zip(groups.tolist(), starts.tolist(), strict=True)]
    assert [keys[i] for i in order] == sorted(keys)
    # Comparisons are those of a mergesort by ranks, each of log2(length) steps.
    assert sorter.comparisons < 900 * 8 * 9
    count = Counter(keys)
    assert sorter.repeated(starts, groups).tolist() == [count[k] > 1 for k in keys]


def test_common_extension_is_exact():
    data = np.frombuffer(b"abcabcabdxabcabcabczzzz", np.uint8)
    found = SuffixSorter(data, 8).common(np.array([0, 0, 3, 9]), np.array([10, 3, 13, 0]))
    assert found.tolist() == [8, 5, 5, 0]


def test_colliding_hashes_change_nothing(monkeypatch):
    """With a hash that tells nothing apart the bytes decide."""
    monkeypatch.setattr(PrefixHashes, "of", lambda self, start, length: np.zeros(len(start), np.uint64))
    data = np.frombuffer(b"aaaabbbbaaaaccccaaaa", np.uint8)
    starts = np.array([0, 4, 8, 12, 16])
    assert SuffixSorter(data, 4).repeated(starts, np.zeros(5, int)).tolist() == [True, False, True, False, True]


def test_equal_strings_have_equal_anchors():
    rnd = random.Random(3)
    shared = bytes(rnd.randrange(97, 123) for _ in range(60))
    places = []
    for n in (0, 5, 900, 40_000):
        data = np.frombuffer(bytes(rnd.randrange(97, 123) for _ in range(n)) + shared + b"tail" * 20, np.uint8)
        first, last, place, name = anchors(data, 40, 16)
        assert first[0] == 0 and last[-1] == len(data) - 40 and (first[1:] == last[:-1] + 1).all()
        run = np.searchsorted(first, np.arange(n, n + 20), side="right") - 1
        places.append(((place[run] - n).tolist(), name[run].tolist()))
    assert all(p == places[0] for p in places)
    for size in (0, 39, 40):
        assert len(anchors(np.zeros(size, np.uint8), 40, 16)[0]) == (size >= 40)


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(40)] + ["é", "日本"]

    def text(n):
        return " ".join(rnd.choice(words) for _ in range(n))

    shared = [text(n) for n in (30, 60, 150)]
    out = [None, "", "short", " " * 3000, "ab" * 400, text(1500)]
    for _ in range(120):
        t = text(rnd.randint(5, 120))
        if rnd.random() < 0.7:
            cut = rnd.randrange(len(t))
            t = t[:cut] + rnd.choice(shared) + t[cut:]
        if rnd.random() < 0.3:
            t = out[5][: rnd.randint(100, 900)] + t
        out.append(t)
    return out + out[50:60]


@pytest.mark.parametrize("bucket", [128, 3])
def test_removal_is_that_of_brute_force(spark, texts, bucket):
    """With small buckets most anchors are judged by counted strings, with the same result."""
    bound_batches(spark)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r[0]: tuple(r)[1:] for r in remove_repeats(df, length=80, gram=20, bucket=bucket, digests_only=True).collect()}
    want = brute(texts, 80)
    assert [got[i] for i in range(len(texts))] == want
    assert 0.2 < sum(w[1] for w in want) / sum(w[0] for w in want) < 0.9


def test_odd_rows(spark):
    """Repeated rows are copies; rows without an id, short, empty and missing texts come back."""
    bound_batches(spark)
    long = "".join(f"{i}," for i in range(300_000))
    rows = [(1, None, "x"), (2, "", "x"), (None, "n" * 199, "x"), (None, long, "x"), (3, "é" * 150 + "q", "x"),
            (3, "é" * 150 + "q", "x"), (4, "z" * 200, "x"), (5, "z" * 201, "x")]
    more = ("a", "k", "r")
    df = spark.createDataFrame([(*r, *more) for r in rows], "doc_id long, text string, segment string, anchor string, k1 string, runs string")
    got = sorted(
        ((r.doc_id, r.n_bytes, r.n_removed, [tuple(s) for s in r.spans], bytes(r.kept)) for r in remove_repeats(df).collect()),
        key=repr,
    )
    whole = (301, 301, [(0, 301)], b"")
    size = len(long)
    want = [(1, 0, 0, [], b""), (2, 0, 0, [], b""), (None, 199, 0, [], b"n" * 199), (None, size, 0, [], long.encode()),
            (3, *whole), (3, *whole), (4, 200, 200, [(0, 200)], b""), (5, 201, 201, [(0, 201)], b"")]
    assert got == sorted(want, key=repr)
    assert remove_repeats(df.limit(0)).count() == 0
