"""op13: trees, resumed states and proofs against hashing everything again."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from palabre.llm.merkle import Parent, document_manifest, fold, grow, path_above

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, place string, digest string"


def tampered():
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 0


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    fields = (doc_id, source, lang, n_chars, text)
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def all_levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def brute(rows):
    leaves = [leaf(*r) for r in rows]
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    order = {
        lang: [i for *_, i in sorted((rows[i][0] is not None, rows[i][0] or 0, leaves[i], i) for i in range(len(rows)) if rows[i][2] == lang)]
        for lang in langs
    }
    trees = {lang: all_levels([leaves[i] for i in order[lang]]) for lang in langs}
    top = all_levels([trees[lang][-1][0] for lang in langs])
    root, out = top[-1][0], []
    for t, lang in enumerate(langs):
        for place, i in enumerate(order[lang]):
            doc_id, text, *rest = rows[i]
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and text is not None:
                text = text.translate({c: c + 32 for c in range(65, 91)})
            folded, proof = leaf(doc_id, text, *rest), []
            for tree, at in ((trees[lang], place), (top, t)):
                for level in tree[:-1]:
                    run, slot = level[at // 8 * 8 : at // 8 * 8 + 8], at % 8
                    proof += run[:slot] + run[slot + 1 :]
                    folded = digest("".join(run[:slot] + [folded] + run[slot + 1 :]))
                    at //= 8
            out.append((doc_id, leaves[i], trees[lang][-1][0], root, digest("".join(proof)), folded, folded == root))
    return sorted(out, key=repr)


def manifest(spark, rows, **options):
    df = spark.createDataFrame([(*r, "t", "p", "d") for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, document_manifest(df, tampered(), **options).collect()), key=repr)


def test_a_resumed_state_hashes_only_what_is_to_the_right():
    children = [digest(str(i)) for i in range(8)]
    parent = Parent(children)
    assert parent.digest == digest("".join(children))
    for slot in range(8):
        new = digest(f"new {slot}")
        assert parent.replaced(slot, children[slot]) == parent.digest
        # The children to the left come from the kept state alone.
        kept, parent.children = parent.children, ["lost"] * slot + children[slot:]
        assert parent.replaced(slot, new) == digest("".join(children[:slot] + [new] + children[slot + 1 :]))
        parent.children = kept


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 600])
def test_folding_gives_the_root_of_the_changed_tree(n):
    nodes = [digest(str(i)) for i in range(n)]
    tree = grow(nodes)
    for place in {0, n // 2, n - 1}:
        changed = nodes[:place] + ["new"] + nodes[place + 1 :]
        assert fold("new", path_above(tree, place)) == (all_levels(changed)[-1][0])


@pytest.mark.parametrize("levels", [4, 1])
def test_manifest_is_that_of_brute_force(spark, levels):
    """Small blocks make several levels of blocks."""
    rnd = random.Random(1)
    rows = [
        (i if rnd.random() < 0.97 else None, rnd.choice(["Abc {}", "x {}", "É {}", "{}"]).format(i) if rnd.random() < 0.9 else None,
         rnd.choice(["en", "en", "en", "fr", None, "dé", ""]), rnd.choice(["s", None]), rnd.choice([i, None]))
        for i in range(300)
    ]
    rows += rows[:9]
    got = manifest(spark, rows, levels=levels)
    assert got == brute(rows) and 0 < sum(r[-1] for r in got) < len(got)


@pytest.mark.parametrize("langs, n", [(1, 1), (70, 70), (20, 50)])
def test_many_small_trees(spark, langs, n):
    rows = [(i, f"Text {i}", f"l{i % langs}", "s", 6) for i in range(n)]
    assert manifest(spark, rows, levels=1) == brute(rows)


def test_odd_rows(spark):
    """Empty and missing texts differ, long ones are hashed whole, missing columns count as null."""
    rows = [(1, None, None, None, None), (2, "", "en", "", 0), (3, "A" * 2_000_000, "en", "s", 5), (3, "A" * 2_000_000, "en", "s", 5),
            (None, "x", "", "s", -4)]
    assert manifest(spark, rows) == brute(rows)
    assert manifest(spark, rows[:1])[0][2:4] == (leaf(*rows[0]),) * 2
    few = spark.createDataFrame([(7, "Ab")], "doc_id long, text string")
    assert document_manifest(few, F.lit(None)).first().leaf == leaf(7, "Ab", None, None, None)
    assert document_manifest(spark.createDataFrame([], SCHEMA), tampered()).count() == 0
