"""URL filtering by association rules over URL tokens.

FP-growth mines which combinations of tokens occur often among labelled URLs, and with
which label. Rules that are frequent and sure enough, and no less sure than any rule
they extend, are kept. A URL is judged by the rules all of whose tokens it has, which an
inverted index from tokens to rules finds. Curated rules for hosts and paths go first.

A URL has tokens of ten fixed kinds, one of each at most, and as many others as it has
labels, segments, words and query keys. A token combination must occur in a set share of
the rows. FP-growth finds those of the fixed kinds, of any size: at most 2^10 / share.
Those of all kinds are counted level by level, up to ``LONGEST`` tokens.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import pandas as pd
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
# Curated rules, longest first among those that fit.
CURATED = {"net/": BLOCK, "example.net/en/": ALLOW, "example.com/de/": BLOCK, "org/fr/": ALLOW}
_CLASS = "class="
#: Kinds that a URL has one token of at most, and kinds it may have many of.
SINGLE = ("scheme", "top", "site", "name", "front", "section", "ending", "number", "query", "fragment")
MANY = ("label", "segment", "word", "key", "given")
#: Tokens in a combination that has one of the second kinds.
LONGEST = 3


@dataclass(frozen=True)
class Rule:
    tokens: frozenset[str]
    verdict: str
    confidence: float
    support: float


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host with A-Z lowered and the path; both empty for a NULL or a URL without ``://``."""
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.substring_index(url, "://", 1)
    rest = F.substr(url, F.length(rest) + 4)
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(has, _lower(host)).otherwise(""), F.when(has, path).otherwise("")


def curated_rule(host: Column, path: Column, rules: dict[str, str] = CURATED) -> Column:
    """The longest fitting rule, else NULL. A rule fits its host and all subdomains."""
    fits = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, _, rest = rule.partition("/")
        same = (host == name) | F.endswith(host, F.lit(f".{name}"))
        fits = F.when(same & F.startswith(path, F.lit(f"/{rest}")), F.lit(rule)).otherwise(fits)
    return fits


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """The distinct tokens of a URL: one at most of each kind of ``SINGLE``, then all of ``MANY``.

    Those are host labels and path segments that no single token has, words of labels and
    segments, query keys and keys with their values.
    """
    labels, parts = F.split(host, r"\."), F.split(path, "/")
    last = F.try_element_at(parts, F.lit(-1))

    def token(kind: str, value: Column, there: Column) -> Column:
        return F.when(there & (value != ""), F.concat(F.lit(f"{kind}="), value))

    flag = F.lit("1")
    kinds = [
        token("scheme", _lower(F.substring_index(url, "://", 1)), host != ""),
        token("top", F.try_element_at(labels, F.lit(-1)), F.size(labels) > 1),
        token("site", F.array_join(F.slice(labels, -2, 2), "."), F.size(labels) > 1),
        token("name", F.try_element_at(labels, F.lit(-3)), F.size(labels) > 2),
        token("front", F.try_element_at(labels, F.lit(1)), F.size(labels) > 3),
        token("section", F.try_element_at(parts, F.lit(2)), F.size(parts) > 2),
        token("ending", F.regexp_extract(last, r"\.(\w{1,8})$", 1), F.lit(True)),
        token("number", flag, F.coalesce(last.rlike(r"\d"), F.lit(False))),
        token("query", F.regexp_extract(url, r"\?([^=&#]{1,40})=", 1), F.instr(url, "?") > 0),
        token("fragment", flag, F.instr(url, "#") > 0),
    ]

    def tokens(kind: str, values: Column) -> Column:
        return F.transform(F.filter(values, lambda x: x != ""), lambda x: F.concat(F.lit(f"{kind}="), x))

    own = F.slice(labels, 1, F.greatest(F.size(labels) - 2, F.lit(0)))
    middle = F.slice(labels, 2, F.greatest(F.size(labels) - 4, F.lit(0)))
    # The first of several segments is the section.
    segments = F.when(F.size(parts) > 2, F.slice(parts, 3, F.size(parts))).otherwise(F.slice(parts, 2, F.size(parts)))
    words = F.split(F.lower(F.concat_ws(".", F.array_join(own, "."), path)), r"[^\p{L}\p{N}]+")
    given = F.split(F.when(host != "", F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)).otherwise(""), "[&;]")
    many = F.concat(
        tokens("label", middle),
        tokens("segment", segments),
        tokens("word", words),
        tokens("key", F.transform(given, lambda x: F.substring_index(x, "=", 1))),
        tokens("given", F.filter(given, lambda x: F.contains(x, F.lit("=")))),
    )
    return F.array_distinct(F.concat(F.array_compact(F.array(*kinds)), F.coalesce(many, F.array().cast("array<string>"))))


def _frequent_sets(known: DataFrame, least: int, longest: int) -> list[tuple[tuple[str, ...], int, int]]:
    """All sets of up to ``longest`` tokens that ``least`` rows have: ``(tokens, rows, blocked rows)``.

    Level by level: of a row only sets are counted whose subsets are all frequent.
    """
    one = known.select(F.explode(F.array_distinct("tokens")).alias("t"), F.col("blocked").cast("int").alias("b"))
    counted = one.groupBy("t").agg(F.count("*").alias("n"), F.sum("b").alias("blocked")).filter(F.col("n") >= least)
    # At most as many as a row has tokens, times total / least.
    found = [((r["t"],), r["n"], r["blocked"]) for r in counted.collect()]
    level, every = {s for s, _, _ in found}, list(found)
    for size in range(2, longest + 1):
        if not level:
            break
        shared = known.sparkSession.sparkContext.broadcast((level, {t for s in level for t in s}))

        def run(batches: Iterator[pd.DataFrame], size: int = size) -> Iterator[pd.DataFrame]:
            below, single = shared.value
            for batch in batches:
                seen: dict[bool, Counter] = {True: Counter(), False: Counter()}
                for tokens, blocked in zip(batch["tokens"], batch["blocked"], strict=True):
                    items = sorted({t for t in tokens if t in single})
                    if size == 2:
                        seen[bool(blocked)].update(combinations(items, 2))
                        continue
                    for base in combinations(items, size - 1):
                        if base in below:
                            after = (t for t in items if t > base[-1])
                            sets = ((*base, t) for t in after)
                            seen[bool(blocked)].update(s for s in sets if below.issuperset(combinations(s, size - 1)))
                rows = [(list(s), n, n * is_blocked) for is_blocked, own in seen.items() for s, n in own.items()]
                yield pd.DataFrame(rows, columns=["items", "n", "blocked"])

        sets = known.select("tokens", "blocked").mapInPandas(run, "items array<string>, n long, blocked long")
        counted = sets.groupBy("items").agg(F.sum("n").alias("n"), F.sum("blocked").alias("blocked")).filter(F.col("n") >= least)
        found = [(tuple(r["items"]), r["n"], r["blocked"]) for r in counted.collect()]
        level = {s for s, _, _ in found}
        every += found
    return every


def mine_rules(
    labelled: DataFrame,
    min_support: float = 0.002,
    min_confidence: float = 0.6,
    min_rows: int = 10,
    min_lift: float = 1.2,
) -> list[Rule]:
    """Rules from ``labelled (tokens, blocked)``, pruned by support, confidence and lift.

    ``min_support`` is a share of the rows, but at least ``min_rows`` of them. A rule is dropped
    if a shorter one with the same verdict is at least as sure. Rules with tokens of kinds
    that a URL may have many of have up to ``LONGEST`` tokens, others any number. There are no rules without rows of both labels; rows with a NULL label are not used.
    """
    known = labelled.filter(F.col("blocked").isNotNull() & F.col("tokens").isNotNull())
    verdict = F.when(F.col("blocked"), F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    fixed = F.filter("tokens", lambda t: ~F.substring_index(t, "=", 1).isin(*MANY))
    baskets = known.select(F.array_append(fixed, F.concat(F.lit(_CLASS), verdict)).alias("items"))
    shares = {r["v"]: r["n"] for r in known.groupBy(verdict.alias("v")).agg(F.count("*").alias("n")).collect()}
    total = sum(shares.values())
    if len(shares) < 2:
        return []
    min_support = max(min_support, min_rows / total)
    if min_support > 1:
        return []
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    consequent = F.col("consequent")[0]
    mined = (
        model.associationRules.filter(F.startswith(consequent, F.lit(_CLASS)))
        .select(
            "antecedent", F.substr(consequent, F.lit(len(_CLASS) + 1)).alias("verdict"), "confidence", "support"
        )
        .filter(F.col("confidence") >= min_confidence)
        .collect()  # at most 2^10 / min_support rows
    )
    rows = [(frozenset(r["antecedent"]), r["verdict"], r["confidence"], r["support"]) for r in mined]
    for tokens, n, blocked in _frequent_sets(known, math.ceil(min_support * total), LONGEST):
        if not any(t.split("=", 1)[0] in MANY for t in tokens):
            continue
        for verdict, own in ((BLOCK, blocked), (ALLOW, n - blocked)):
            if own / total >= min_support and own / n >= min_confidence:
                rows.append((frozenset(tokens), verdict, own / n, own / total))

    def order(row: tuple) -> tuple:
        return len(row[0]), sum(t.split("=", 1)[0] in MANY for t in row[0]), sorted(row[0])

    kept: dict[tuple[frozenset[str], str], Rule] = {}
    for tokens, verdict, confidence, support in sorted(rows, key=order):
        if confidence * total < min_lift * shares[verdict]:
            continue
        shorter = (kept.get((frozenset(s), verdict)) for k in range(1, len(tokens)) for s in combinations(tokens, k))
        if not any(r and r.confidence >= confidence for r in shorter):
            kept[tokens, verdict] = Rule(tokens, verdict, confidence, support)
    return list(kept.values())


class RuleIndex:
    """Finds the rules all of whose tokens a URL has."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules = list(rules)
        self.by_token: dict[str, list[int]] = {}
        for i, rule in enumerate(self.rules):
            for token in rule.tokens:
                self.by_token.setdefault(token, []).append(i)
        self._known: dict[tuple[str, ...], int | None] = {}

    def best(self, tokens: Sequence[str]) -> int | None:
        """The surest matching rule; of equally sure ones the more frequent, then a block."""
        key = tuple(t for t in tokens if t in self.by_token)
        if key not in self._known:
            if len(self._known) >= 100_000:
                self._known.clear()
            hits: dict[int, int] = {}
            for token in key:
                for i in self.by_token.get(token, ()):
                    hits[i] = hits.get(i, 0) + 1
            full = [i for i, n in hits.items() if n == len(self.rules[i].tokens)]

            def rank(i: int) -> tuple:
                rule = self.rules[i]
                return rule.confidence, rule.support, rule.verdict == BLOCK, -i

            self._known[key] = max(full, key=rank, default=None)
        return self._known[key]


def filter_urls(
    pages: DataFrame,
    labelled_urls: DataFrame,
    curated: dict[str, str] = CURATED,
    min_support: float = 0.002,
    min_confidence: float = 0.6,
) -> DataFrame:
    """A verdict for each row of ``pages (page_id, url)``.

    Returns ``page_id, host, path, rule, verdict, mined_rule, confidence``. ``rule`` is the curated
    rule that decides, else NULL. Otherwise the best mined rule decides, learned from
    ``labelled_urls (url, blocked)``; a URL without any rule is allowed. NULL and malformed
    URLs have an empty host and path. Repeated rows give repeated results; an empty page
    table gives no rows, an empty label table no mined rules.
    """

    def parsed(rows: DataFrame, *more: str) -> DataFrame:
        host, path = host_and_path(F.col("url"))
        made = rows.select(*more, "url", host.alias("host"), path.alias("path"))
        return made.withColumn("tokens", url_tokens(F.col("url"), F.col("host"), F.col("path")))

    rules = mine_rules(parsed(labelled_urls.select("url", "blocked"), "blocked"), min_support, min_confidence)
    shared = pages.sparkSession.sparkContext.broadcast(RuleIndex(rules))

    @F.pandas_udf("mined_rule string, verdict string, confidence double")
    def judge(tokens: pd.Series) -> pd.DataFrame:
        index, rows = shared.value, []
        for own in tokens:
            best = index.best(own) if own is not None else None
            if best is None:
                rows.append((None, ALLOW, None))
            else:
                r = index.rules[best]
                rows.append((" ".join(sorted(r.tokens)), r.verdict, r.confidence))
        return pd.DataFrame(rows, columns=["mined_rule", "verdict", "confidence"]).astype({"confidence": float})

    found = parsed(pages.select("page_id", "url"), "page_id").select(
        "page_id", "host", "path",
        curated_rule(F.col("host"), F.col("path"), curated).alias("rule"),
        judge("tokens").alias("mined"),
    )
    fixed = F.lit(None).cast("string")
    for rule, verdict in curated.items():
        fixed = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(fixed)
    return found.select(
        "page_id", "host", "path", "rule",
        F.coalesce(fixed, F.col("mined.verdict")).alias("verdict"),
        F.when(F.col("rule").isNull(), F.col("mined.mined_rule")).alias("mined_rule"),
        F.when(F.col("rule").isNull(), F.col("mined.confidence")).alias("confidence"),
    )
