"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

from __future__ import annotations

import public_tokenizers
import pytest

import corpus_pipeline
from palabre.llm.bpe import encode_documents
from palabre.llm.common import bound_batches
from palabre.llm.exact_dedup import drop_exact_duplicates, exact_duplicates
from palabre.llm.language_id import predict_language, train_language_id
from palabre.llm.license_scan import scan_licenses
from palabre.llm.near_dedup import drop_near_duplicates, near_duplicates
from palabre.llm.packing import pack_documents
from palabre.llm.pii import pseudonymise
from palabre.llm.quality import judge_quality
from palabre.llm.toxicity import score_toxicity, train_toxicity
from palabre.llm.url_filter import filter_urls

LONG = " ".join(f"word{i % 9973} and{i % 31}" for i in range(60_000))
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "fingerprint string, component string, score string, kept string, part string, bucket string, `a b` string"
)
ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "s", 0),
    (3, "   \n\t ", None, "s", 5),
    (4, LONG, "en", "s", len(LONG)),
    (5, "Same Text of the day, and more", "en", None, 30),
    (5, "Same Text of the day, and more", "en", None, 30),
    (6, "same text OF the day, and more", "de", "s", None),
    (None, "a row without an id of its own", "en", "s", 9),
    (7, "ÀÉ 日本語 ☃ \x00 mixed", "xx", "s", 3),
    (8, "5 5 5", "en", "s", 5),
]


@pytest.fixture(scope="module")
def odd(spark):
    bound_batches(spark)
    more = ("f", "c", "s", "k", "p", "b", "x")
    return spark.createDataFrame([(*r, *more) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_exact(odd, none):
    rows = exact_duplicates(odd).collect()
    assert len(rows) == len(ROWS)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in rows}
    assert got[1] == (2, 2, False) and got[2] == (2, 2, True)
    assert got[5] == (6, 3, False) and got[6] == (6, 3, True)
    assert got[None][2] is True and got[4] == (4, 1, True)
    kept = drop_exact_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 3, 4, 6, 7, 8]
    assert exact_duplicates(none).count() == drop_exact_duplicates(none).count() == 0


def test_near(odd, none):
    got = by_id(near_duplicates(odd), "n_shingles", "component_id", "kept")
    assert got[1] == (0, 1, True) and got[2] == (0, 2, True) and got[3] == (0, 3, True)
    assert got[5] == (3, 5, True) and got[6] == (3, 5, False)
    assert got[8] == (1, 8, True) and None not in got
    kept = drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 7, 8]
    assert near_duplicates(none).count() == drop_near_duplicates(none).count() == 0


def test_pseudonyms(odd, none):
    kept = pseudonymise(odd, "key")
    assert kept.columns == odd.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, odd.collect()))
    assert pseudonymise(none, "key", counted="n").count() == 0


def test_quality(odd, none):
    got = by_id(judge_quality(odd), "n_words", "n_repeat_words", "base_failed", "kept")
    assert got[1] == got[2] == got[3] == (0, 0, True, False)
    assert got[8][:2] == (3, 0) and got[4][0] == 120_000
    assert judge_quality(odd).count() == len(ROWS) and judge_quality(none).count() == 0


def test_licenses(odd, none):
    got = by_id(scan_licenses(odd), "n_words", "first_word", "labels", "score")
    assert got[1] == got[2] == (0, None, "", 0.0) and got[4][0] == 120_000
    assert scan_licenses(odd).count() == len(ROWS) and scan_licenses(none).count() == 0


def test_languages(odd, none):
    model = train_language_id(odd)
    got = by_id(predict_language(odd, model), "lang_pred", "score", "rejected")
    assert got[1] == got[2] == got[3] == got[8] == ("und", 0.0, True)
    assert got[4][0] in {"de", "en", "xx"} and 0 <= got[4][1] <= 1
    empty = train_language_id(none)
    assert {r.lang_pred for r in predict_language(odd, empty).collect()} == {"und"}
    assert predict_language(none, model).count() == 0


def test_toxicity(spark, odd, none):
    labels = spark.createDataFrame([(4, 0), (5, 1), (6, None), (None, 1)], "doc_id long, toxic int")
    for model in (train_toxicity(odd, labels), train_toxicity(none, labels), train_toxicity(odd, labels.limit(0))):
        rows = score_toxicity(odd, model).collect()
        assert len(rows) == len(ROWS)
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
        assert score_toxicity(none, model).count() == 0


def test_encoding(odd, none):
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rows = encode_documents(odd, ranks, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(ROWS)
    texts = {r[0]: r[1] or "" for r in ROWS}
    assert all(bytes(r.decoded).decode() == texts[r.doc_id] and len(r.ids) == r.n_tokens for r in rows)
    assert encode_documents(none, ranks, public_tokenizers.PATTERN, digests_only=True).count() == 0


def test_packing(odd, none):
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    rows = pack_documents(odd, tokenizer, capacity=64).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert sum(r.doc_id == 5 for r in rows) == 2 and sum(r.doc_id is None for r in rows) == 1
    assert [r.ids for r in rows if r.doc_id == 1] == [[0]]
    assert pack_documents(none, tokenizer, digests_only=True).count() == 0


def test_urls(spark):
    pages = spark.createDataFrame(
        [(1, None, "h"), (2, "", "h"), (3, "no scheme", None), (4, "HTTP://A.Example.NET/en/x?a=b#c", "h"), (4, "x://" + "a" * 50_000, "h"),
         (5, "http://net", "h"), (6, "http://example.com/de/1", "h"), (7, "http://b.org?x/fr/", "h")],
        "page_id long, url string, tokens string",
    )
    none = spark.createDataFrame([], "url string, blocked boolean")
    rows = filter_urls(pages, none).collect()
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows if len(r.host) < 999}
    assert got[1] == got[2] == got[3] == ("", "", None, "allow") and len(rows) == 8
    assert got[4] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert got[5] == ("net", "", None, "allow") and got[6][2:] == ("example.com/de/", "block")
    assert got[7] == ("b.org", "", None, "allow")
    assert filter_urls(pages.limit(0), none).count() == 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
@pytest.mark.parametrize("empty", [False, True])
def test_stages(spark, odd, none, scratch, name, stage, empty):
    spark.createDataFrame([(4, 0, 0), (5, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{scratch}/labels.parquet")
    docs = none if empty else odd
    out = stage(spark, docs, scratch)
    if name != "packing":
        assert out.columns == odd.columns
    rows = out.collect()
    assert bool(rows) != empty
    if not empty and name != "packing":
        assert {r.doc_id for r in rows} <= {r[0] for r in ROWS}
