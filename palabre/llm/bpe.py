"""Byte-level BPE by prefix dynamic programming.

For each prefix of a byte string exactly one last token is valid, so an encoding is a
chain of last tokens. A token may end a prefix if it starts it, or if it is compatible
with the last token of what stands before it: merging the bytes of both must give just
these two tokens. The table of last tokens never changes when bytes are appended, and
after an edit only entries near it are made anew.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from palabre.llm.common import ids_and_texts

#: Entries of a worker's caches; a full cache starts anew.
CACHE = 800_000
#: Only strings of up to so many bytes are kept in caches.
SHORT = 64
NEVER = 1 << 60


class Vocabulary:
    """The ranks of a byte-level BPE and which tokens may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self._halves: dict[int, tuple[int, int] | None] = {}
        #: The last token of prefixes that were met; with a prefix all shorter ones are there.
        self.prefixes: dict[bytes, int] = {}
        #: For left << 32 | right, whether the two tokens may stand side by side.
        self.known: dict[int, bool] = {}
        self._edges: dict[tuple[int, bool], list[tuple[bytes, int, int]]] = {}
        #: The tokens that merging can lead to; others only stand for a whole piece.
        self.usable = {t: r for t, r in ranks.items() if self.halves(r) != (r, r)}
        #: The length of the longest of them that ends with these three bytes.
        self.longest: dict[bytes, int] = {}
        self.most_bytes = max(map(len, self.usable), default=1)
        for token in self.usable:
            if len(token) > 2:
                self.longest[token[-3:]] = max(len(token), self.longest.get(token[-3:], 0))

    @classmethod
    def from_file(cls, path: str) -> Vocabulary:
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            return cls({base64.b64decode(token): int(rank) for token, rank in pairs})

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a byte.

        A token that merging its bytes doesn't lead to has the halves (token, token).
        """
        if token not in self._halves:
            parts = [bytes([b]) for b in self.tokens[token]]
            while len(parts) > 2:
                found = [(self.ranks.get(x + y, NEVER), i) for i, (x, y) in enumerate(zip(parts, parts[1:]))]
                rank, at = min(found)
                if rank == NEVER:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            if len(parts) == 1:
                self._halves[token] = None
            elif len(parts) == 2:
                self._halves[token] = (self.ranks[parts[0]], self.ranks[parts[1]])
            else:
                self._halves[token] = (token, token)
        return self._halves[token]

    def _edge(self, token: int, last: bool) -> list[tuple[bytes, int, int]]:
        """What stands at a token's end (or start) while it is merged: bytes, from when, to when."""
        key = (token, last)
        if key not in self._edges:
            out, until = [], NEVER
            while True:
                halves = self.halves(token)
                out.append((self.tokens[token], -1 if halves is None else token, until))
                if halves is None:
                    break
                until, token = token, halves[last]
            self._edges[key] = out
        return self._edges[key]

    def fits(self, left: int, right: int) -> bool:
        """Whether the bytes of both tokens encode to just these two.

        They don't if at some time the piece at the end of the left and the one at the
        start of the right are both there and their merge is due. Of equal merges the
        leftmost comes first: it takes the left piece away, but not the right one.
        """
        if len(self.known) >= CACHE:
            self.known.clear()
        fit = self.known[left << 32 | right] = self._decide(left, right)
        return fit

    def _decide(self, left: int, right: int) -> bool:
        ranks = self.ranks
        for x, x_from, x_to in self._edge(left, True):
            for y, y_from, y_to in self._edge(right, False):
                due = ranks.get(x + y)
                if due is not None and x_from < due < x_to and y_from < due <= y_to:
                    return False
        return True


    def ending(self, data: bytes, end: int, last: Callable[[int], int]) -> int:
        """The last token of the first ``end`` bytes, if ``last`` has that of shorter prefixes."""
        usable, known = self.usable.get, self.known.get
        longest = self.longest.get(data[end - 3 : end], 2) if end > 2 else end
        for begin in range(end - longest if end > longest else 0, end):
            token = usable(data[begin:end])
            if token is None:
                continue
            if not begin:
                return token
            left = last(begin)
            fit = known(left << 32 | token)
            if fit is None:
                fit = self.fits(left, token)
            if fit:
                return token
        raise ValueError(f"no token ends with byte {data[end - 1]}")

    def encode_short(self, data: bytes) -> tuple[int, ...]:
        """The tokens of a short string; last tokens of prefixes it shares are looked up."""
        shared = self.prefixes
        if len(shared) >= CACHE:
            shared.clear()
        n = start = len(data)
        while start and data[:start] not in shared:
            start -= 1

        def last(begin: int) -> int:
            return shared[data[:begin]]

        for end in range(start + 1, n + 1):
            shared[data[:end]] = self.ending(data, end, last)
        out = []
        while n:
            token = shared[data[:n]]
            out.append(token)
            n -= len(self.tokens[token])
        return tuple(out[::-1])


class PrefixTable:
    """The valid last token of each prefix of a byte string."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = bytearray()
        #: At i - 1 the last token of the prefix of i bytes.
        self.last: list[int] = []
        #: How many entries were made.
        self.made = 0
        self.append(data)

    def append(self, more: bytes) -> None:
        """Add bytes; the table so far stays as it is."""
        start = len(self.data)
        self.data += more
        for _ in self._extend(start):
            pass

    def _extend(self, start: int) -> Iterator[int]:
        """Sets the last token of each prefix longer than ``start`` bytes, one at a time."""
        last, ending = self.last, self.vocabulary.ending
        # No token reaches further back than the longest one is long.
        base = max(0, start - self.vocabulary.most_bytes - 1)
        data = bytes(self.data[base:])
        for end in range(start + 1, len(self.data) + 1):
            self.made += 1
            last.append(ending(data, end - base, lambda begin: last[begin + base - 1]))
            yield end

    def replace(self, begin: int, end: int, new: bytes) -> None:
        """Put ``new`` in the place of bytes ``begin`` to ``end``; only entries near them are made anew.

        An entry depends on the bytes and entries of one longest token before it. Behind so
        many new entries that equal the old ones of the same bytes, all others do.
        """
        begin = min(begin, len(self.data))
        end = max(begin, min(end, len(self.data)))
        old = self.last[end:]
        self.data[begin:end] = new
        del self.last[begin:]
        edited, same = begin + len(new), 0
        for n in self._extend(begin):
            at = n - edited - 1
            same = same + 1 if at >= 0 and self.last[-1] == old[at] else 0
            if same > self.vocabulary.most_bytes:
                self.last += old[at + 1 :]
                return

    def ids(self, end: int | None = None) -> list[int]:
        """The encoding of the first ``end`` bytes (default: all)."""
        end, out = len(self.data) if end is None else end, []
        while end:
            token = self.last[end - 1]
            out.append(token)
            end -= len(self.vocabulary.tokens[token])
        return out[::-1]


class _Pieces(dict):
    """The ids of each piece of text that was met, made when it is met."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> tuple[int, ...]:
        data = piece.encode("utf-8", "replace")
        whole = self.vocabulary.ranks.get(data)
        if whole is not None:
            ids = (whole,)
        elif len(data) > SHORT:
            return tuple(PrefixTable(self.vocabulary, data).ids())
        else:
            ids = self.vocabulary.encode_short(data)
        if len(data) <= SHORT:
            if len(self) >= CACHE:
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """Encodes and decodes whole texts: each match of the pattern by itself."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary = vocabulary
        self.pieces = regex.compile(pattern).findall
        self._ids = _Pieces(vocabulary)

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self._ids.__getitem__, self.pieces(text))))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """The worker's encoder for a rank file."""
    return Encoder(Vocabulary.from_file(path), pattern)


def encode_documents(
    docs: DataFrame, rank_file: str, pattern: str, digests_only: bool = False
) -> DataFrame:
    """Each document's ids and the bytes they decode to, by the ranks in ``rank_file``.

    Returns ``doc_id, n_tokens, ids, decoded``, or with ``digests_only`` hex SHA-256
    digests of the comma-joined ids and of the decoded bytes in their place. ``rank_file``
    has the form of tiktoken's rank files and is at the same path on every machine, or
    was given to ``addFile`` under its name. A missing or empty text has no ids. Rows are
    independent: repeated ones give repeated results, and further columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = rank_file if os.path.exists(rank_file) else SparkFiles.get(os.path.basename(rank_file))
        coder = encoder(path, pattern)
        decimal = [str(i) for i in range(len(coder.vocabulary.tokens))]
        for batch in batches:
            counts, left, right = [], [], []
            for text in batch.column("text"):
                ids = coder.encode(text.as_py())
                counts.append(len(ids))
                decoded = coder.decode(ids)
                if digests_only:
                    joined = ",".join(map(decimal.__getitem__, ids))
                    left.append(hashlib.sha256(joined.encode()).hexdigest())
                    right.append(hashlib.sha256(decoded).hexdigest())
                else:
                    left.append(ids)
                    right.append(decoded)
            shown = (pa.string(), pa.string()) if digests_only else (pa.list_(pa.int32()), pa.binary())
            # Arrow keeps ids whole beside a missing one; pandas would make them floats.
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(left, shown[0]), pa.array(right, shown[1])],
                names=["doc_id", "n_tokens", *names],
            )

    names = ("ids_sha256", "decoded_sha256") if digests_only else ("ids", "decoded")
    kinds = ("string", "string") if digests_only else ("array<int>", "binary")
    schema = f"doc_id long, n_tokens long, {names[0]} {kinds[0]}, {names[1]} {kinds[1]}"
    return ids_and_texts(docs).mapInArrow(run, schema)
