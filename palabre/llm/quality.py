"""Quality rules by the divergence of a document's histograms from its language's.

All of it is SQL functions within a row, but for the references: one row for each language.
They are means of shares, so a long text counts like a short one; each distinct text of a
source counts once, and each source like any other, so neither copies nor a source with a
third of all rows move them. What fails the base is left out. A second round, which makes the
references, takes the nearer half of each language's texts and weighs a source by how many
of its own are among them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palabre.llm.common import stage

# Common words of each language whose shares are compared.
COMMON_WORDS = {
    "de": "der die das und ist nicht ein eine zu von mit auf für den sich auch",
    "en": "the of and to in is that it for was on are with as be this",
    "es": "el la los las que y en un una del con por para su es se",
    "fr": "le la les et des un une du est que pour dans qui sur pas au",
}
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
# Kinds of characters whose shares are compared, besides spaces and all others.
KINDS = [r"\p{Lu}", "[0-9]", r"[.,;:!?'\"()-]", SYMBOLS]


@dataclass(frozen=True)
class Limits:
    """What a document may differ by, and from how many words on that is judged.

    Distances of well-formed texts shrink with the square root of the number of words: times
    it they are within the scaled limits. Long texts may differ by the least ones.
    """

    words: int = 100
    kinds_least: float = 0.15
    kinds_scaled: float = 2.2
    words_least: float = 0.12
    words_scaled: float = 3.5
    #: Texts that the reference over all languages counts for in that of each.
    prior: int = 10


#: Steps that distances are counted in to find a language's median.
STEPS = 1000


def _removed(text: Column, pattern: str) -> Column:
    """How many characters of single-character matches a text has."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def base_features(docs: DataFrame) -> DataFrame:
    """Counts within each row; see ``judge_quality``."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        (F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")).alias("source"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    split = rows.select(
        "*",
        F.array_remove(F.split("text", SPACE), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        # Two spaces between words, so that each has its own on both sides.
        F.concat(F.lit(" "), F.regexp_replace(F.lower("text"), r"[^\p{L}]+", "  "), F.lit(" ")).alias("plain"),
    )
    word = F.col("words")
    windows = F.transform(
        F.when(F.size(word) > 2, F.sequence(F.lit(0), F.size(word) - 3)).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(
            F.xxhash64(F.get(word, i), F.get(word, i + 1), F.get(word, i + 2)).alias("h"), i.alias("i")
        ),
    )
    sorted_ = split.withColumn("windows", F.sort_array(windows))
    # Equal windows are neighbours now: keep those with an equal one beside them.
    near = F.col("windows")
    repeated = sorted_.withColumn(
        "repeated",
        F.filter(
            near,
            lambda x, i: F.coalesce(F.get(near, i - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(near, i + 1)["h"] == x["h"], F.lit(False)),
        ),
    )
    covered = F.flatten(F.transform("repeated", lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    plain = F.col("plain")

    def share(name: str) -> Column:
        """How often a common word occurs."""
        removed = F.octet_length(plain) - F.octet_length(F.replace(plain, F.lit(f" {name} "), F.lit("")))
        return (removed / (len(name.encode()) + 2)).cast("long")

    common = F.lit(None).cast("array<bigint>")
    for lang, names in COMMON_WORDS.items():
        common = F.when(F.col("lang") == lang, F.array(*map(share, names.split()))).otherwise(common)
    kinds = [_removed(F.col("text"), k).cast("long") for k in KINDS]
    n_words = F.size("words").cast("long")
    word_chars = F.aggregate("words", F.lit(0).cast("long"), lambda n, w: n + F.length(w))
    return repeated.select(
        "doc_id",
        "lang",
        "source",
        F.sha2("text", 256).alias("digest"),
        n_words.alias("n_words"),
        word_chars.alias("word_chars"),
        kinds[-1].alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct(covered)).cast("long").alias("n_repeat_words"),
        F.array((F.length("text") - word_chars), *kinds).alias("kinds"),
        F.length("text").cast("long").alias("n_chars"),
        common.alias("common"),
    )


def _histograms(rows: DataFrame) -> DataFrame:
    """With the rest of the characters and words as last values of both histograms."""

    def total(name: str) -> Column:
        return F.aggregate(name, F.lit(0).cast("long"), lambda a, x: a + x)

    return rows.select(
        *[c for c in rows.columns if c not in ("kinds", "common", "n_chars")],
        F.concat("kinds", F.array(F.col("n_chars") - total("kinds"))).alias("kinds"),
        F.concat("common", F.array(F.greatest(F.col("n_words") - total("common"), F.lit(0)))).alias("common"),
    )


def _shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    return F.when(total > 0, F.transform(counts, lambda x: x / total))


def jensen_shannon(counts: Column, reference: Column) -> Column:
    """The distance (0 to 1) of a histogram from a reference distribution; NULL if either is missing."""
    pairs = F.zip_with(
        _shares(counts), reference, lambda p, q: F.struct(p.alias("p"), q.alias("q"), ((p + q) / 2).alias("m"))
    )

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    sum_ = F.aggregate(pairs, F.lit(0.0), lambda a, x: a + part(x["p"], x["m"]) + part(x["q"], x["m"]))
    return F.sqrt(F.greatest(sum_ / 2, F.lit(0.0)))


def references(texts: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``of, kinds_reference, words_reference`` for each language of ``texts``, as shares.

    ``texts`` has ``lang, source``, both histograms as shares and whether the text is ``near``,
    distinct within a source. A source counts by the share of its texts that are near.
    """
    sizes = {"kinds": len(KINDS) + 2, "words": 17}
    places = [(name, i) for name, size in sizes.items() for i in range(size)]
    by_source = texts.groupBy("lang", "source").agg(
        *[F.avg(F.when(F.col("near"), F.get(name, F.lit(i))).otherwise(F.get(name, F.lit(i)) * 0)).alias(f"{name}{i}") for name, i in places],
        F.avg(F.col("near").cast("double")).alias("weight"),
        F.count_if("near").alias("n"),
    )
    means = [(F.sum(f"{name}{i}") / F.sum("weight")).alias(f"{name}{i}") for name, i in places]
    anywhere = by_source.agg(*means[: sizes["kinds"]]).first()  # one row
    by_lang = by_source.groupBy("lang").agg(*means, F.sum("n").alias("n"))
    prior = limits.prior

    def weighed(i: int) -> Column:
        return (F.col(f"kinds{i}") * F.col("n") + F.lit(anywhere[i]) * prior) / (F.col("n") + prior)

    words = F.array(*[F.col(f"words{i}") for i in range(sizes["words"])])
    return by_lang.select(
        F.col("lang").alias("of"),
        F.array(*map(weighed, range(sizes["kinds"]))).cast("array<double>").alias("kinds_reference"),
        F.when(F.col("words0").isNotNull(), words).alias("words_reference"),
    )


def _measured(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` with both distances from their language's reference."""
    joined = rows.join(found, F.col("lang").eqNullSafe(F.col("of")), "left")
    return joined.select(
        *rows.columns,
        jensen_shannon(F.col("kinds"), F.col("kinds_reference")).alias("kinds_distance"),
        jensen_shannon(F.col("common"), F.col("words_reference")).alias("words_distance"),
    )


def _nearer_half(measured: DataFrame) -> DataFrame:
    """With ``near``: whether a text is within its language's median of the kinds' distance, in steps."""
    stepped = measured.withColumn("step", F.floor(F.col("kinds_distance") * STEPS))
    # At most a row for each step and language.
    each = Window.partitionBy("lang")
    counts = stepped.groupBy("lang", "step").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(each.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    halves = counts.withColumn("enough", 2 * upto >= F.sum("n").over(each)).filter("enough")
    median = halves.groupBy(F.col("lang").alias("of")).agg(F.min("step").alias("median"))
    judged = stepped.join(median, F.col("lang").eqNullSafe(F.col("of")))
    return judged.select("*", (F.col("step") <= F.col("median")).alias("near"))


def _base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judge_quality(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Counts, distances and a verdict for each whole text.

    Returns ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kinds_distance, words_distance, kept``. A document fails the base if it has under 50
    words or more than half of them are in repeated three-word windows. Otherwise it is
    kept unless it has ``limits.words`` words and either histogram is further from its
    language's reference than allowed. Kinds of characters are judged in every language (a
    missing one is one, too, and the reference over all weighs in where texts are few),
    words where there is a list for the language. Distances are NULL, and nothing is judged
    by them, where no text of the language can make a reference. A missing text has no
    words. Windows are told apart by 64-bit hashes within their row. Repeated rows give
    repeated results; further columns are not read.
    """
    rows = stage(_histograms(base_features(docs)), "features")
    able = rows.filter(~_base_failed() & (F.col("n_words") >= limits.words))
    # Any row of a source stands for all that have its text.
    texts = able.groupBy("lang", "source", "digest").agg(
        F.first("kinds").alias("kinds"), F.first("common").alias("common")
    )
    texts = stage(texts, "texts")

    def found(of: DataFrame) -> DataFrame:
        histograms = (_shares(F.col(c)).alias(name) for c, name in (("kinds", "kinds"), ("common", "words")))
        return stage(references(of.select("lang", "source", "near", *histograms), limits), "references")

    first = found(texts.withColumn("near", F.lit(True)))
    measured = _measured(rows, found(_nearer_half(_measured(texts, first))))
    root = F.sqrt(F.greatest("n_words", F.lit(1)))
    far = (F.col("kinds_distance") > F.greatest(F.lit(limits.kinds_least), limits.kinds_scaled / root)) | (
        F.col("words_distance") > F.greatest(F.lit(limits.words_least), limits.words_scaled / root)
    )
    failed = _base_failed()
    judged = F.coalesce((F.col("n_words") >= limits.words) & far, F.lit(False))
    return measured.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        "kinds_distance",
        "words_distance",
        (~failed & ~judged).alias("kept"),
    )
