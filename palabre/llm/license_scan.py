"""License detection by ordered signature rules with a keyword prefilter.

One pass of an Aho-Corasick automaton finds which keywords a text has; only rules with
such a keyword are searched for, over the whole text. Of overlapping detections the one
that contains the other wins unless the other has a higher priority.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from palabre.llm.common import ids_and_texts
from palabre.llm.license_rules import Rule, build_rules

# Phrases that always give their label.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
PHRASE_SCORE = 0.9

#: A-Z become small; what is no digit, letter or byte beyond ASCII parts words.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_PHRASES = [(f" {phrase} ".encode(), label) for phrase, label in PHRASES.items()]


def phrase_places(text: str) -> tuple[int, list[tuple[int, str]]]:
    """The number of words, and where (in words) each phrase stands."""
    words = text.encode("utf-8", "surrogatepass").translate(_FOLD).split()
    joined = b" " + b" ".join(words) + b" "
    found = []
    for phrase, label in _PHRASES:
        at, before, words_before = joined.find(phrase), 0, 0
        while at >= 0:
            # Only what lies between two places is counted.
            words_before += joined.count(b" ", before, at)
            found.append((words_before, label))
            before, at = at, joined.find(phrase, at + 1)
    return len(words), found


def _unsuppressed(found: list[tuple[int, int, int]], priorities: list[int]) -> list[tuple[int, int, int]]:
    """The detections that none before them contains or is contained by; higher and longer ones first.

    Kept ones never contain each other, so by start they are in order of their ends, too: of
    those that start no later the last one reaches furthest, of those that start no earlier
    the first one ends first. Detections of a priority and length are looked up together.
    """
    if len(found) < 2:
        return found
    spans = np.array(found, dtype=np.int64)
    level = np.array(priorities)[spans[:, 2]]
    size = spans[:, 1] - spans[:, 0]
    order = np.lexsort((spans[:, 2], spans[:, 0], -size, -level))
    spans, level, size = spans[order], level[order], size[order]
    # Of equal spans of a priority the earliest rule speaks.
    first = np.append(True, (np.diff(level) != 0) | (np.diff(size) != 0) | (np.diff(spans[:, 0]) != 0))
    spans, level, size = spans[first], level[first], size[first]
    cuts = np.flatnonzero(np.append(True, (np.diff(level) != 0) | (np.diff(size) != 0)))
    kept = spans[:0]
    for group in np.split(spans, cuts[1:]):
        start, end = group[:, 0], group[:, 1]
        if len(kept):
            before = np.searchsorted(kept[:, 0], start, side="right") - 1
            after = np.searchsorted(kept[:, 0], start, side="left")
            contained = (before >= 0) & (kept[before, 1] >= end)
            contains = (after < len(kept)) & (kept[np.minimum(after, len(kept) - 1), 1] <= end)
            group = group[~(contained | contains)]
        if len(group):
            kept = np.concatenate([kept, group])
            kept = kept[np.argsort(kept[:, 0], kind="stable")]
    return [tuple(row) for row in kept.tolist()]


class Scanner:
    """The rules and the automaton of their keywords."""

    def __init__(self, rules: list[Rule]):
        self.rules = rules
        by_word: dict[str, list[int]] = {}
        for i, rule in enumerate(rules):
            for word in rule.keywords:
                by_word.setdefault(word.lower(), []).append(i)
        self.automaton = ahocorasick.Automaton()
        for word, which in by_word.items():
            self.automaton.add_word(word, tuple(which))
        self.automaton.make_automaton()

    def candidates(self, text: str) -> list[int]:
        """The rules of which the text has a keyword (white space counts as one space)."""
        found = {which for _, which in self.automaton.iter(" ".join(text.lower().split()))}
        return sorted({i for which in found for i in which})

    def detections(self, text: str) -> list[tuple[int, int, int]]:
        """``(start, end, rule)`` of each detection that isn't suppressed, in order.

        A detection is suppressed by one that contains it and has at least its priority,
        and by one of a higher priority that it contains. Of the same span and priority
        the earlier rule speaks.
        """
        found = [
            (m.start(), m.end(), i)
            for i in self.candidates(text)
            for m in self.rules[i].pattern.finditer(text)
            if m.end() > m.start()
        ]
        return _unsuppressed(found, [r.priority for r in self.rules])


@lru_cache(maxsize=1)
def scanner() -> Scanner:
    return Scanner(build_rules())


_SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, detections array<struct<start: long, end: long, label: string, rule: int>>"
)
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("rule", pa.int32())]))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """The licenses that each whole text states.

    Returns ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` and
    ``detections`` (characters from and to, label, rule). ``n_base`` counts the places of the
    fixed phrases, ``first_word`` and ``last_word`` are the first and last of them in words.
    ``labels`` adds those of the rules; both are distinct, sorted and comma-joined, empty if
    there are none. ``score`` is the surest finding's, 0 without one. A missing text is
    empty. Repeated rows give repeated results, further columns are not read.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = scanner()
        for batch in batches:
            rows: list[tuple] = []
            for text in batch.column("text").to_pylist():
                n_words, base = phrase_places(text)
                spans = own.detections(text)
                rules = [own.rules[i] for _, _, i in spans]
                base_labels = {label for _, label in base}
                at = [place for place, _ in base]
                rows.append(
                    (
                        n_words,
                        len(base),
                        min(at, default=None),
                        max(at, default=None),
                        ",".join(sorted(base_labels)),
                        ",".join(sorted(base_labels | {r.label for r in rules})),
                        max([PHRASE_SCORE * bool(base), *(r.confidence for r in rules)]),
                        [
                            {"start": s, "end": e, "label": r.label, "rule": i}
                            for (s, e, i), r in zip(spans, rules, strict=True)
                        ],
                    )
                )
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), _SPAN]
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            names = [part.split()[0] for part in _SCHEMA.split(", ")[:8]] + ["detections"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=names)

    return ids_and_texts(docs).mapInArrow(scan, _SCHEMA)
