"""SQL twins (DuckDB) of the queries that SQL can express."""

from __future__ import annotations

import string

from palabre.llm.quality import COMMON_WORDS, KINDS, STEPS, Limits

LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
SPACE = r"[\x20\x09-\x0D]+"
EXACT = f"""
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM (
  SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
         sha256(t) AS text_sha256
  FROM (SELECT doc_id, {LOWER} AS t FROM documents)
  WINDOW same AS (PARTITION BY t)
)
"""

NEAR = rf"""
WITH RECURSIVE
w AS (
  SELECT doc_id, list_filter(regexp_split_to_array({LOWER}, '{SPACE}'), lambda x: x <> '') AS ws FROM documents
),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE
    WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
  END)) AS g
  FROM w
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
  GROUP BY 1, 2
),
links AS (
  SELECT a, b FROM shared JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * c >= 75 * (p.n + q.n - c)
),
reach AS (
  SELECT a AS id, b AS other FROM links
  UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a
),
first AS (SELECT id, min(other) AS other FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles,
       least(d.doc_id, coalesce(other, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(other, d.doc_id)) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN first ON id = d.doc_id
"""


def _distance(own: str, reference: str) -> str:
    """The Jensen-Shannon distance of a list of counts from one of shares."""
    pairs = f"list_zip(list_transform({own}, lambda x: x / list_sum({own})), {reference})"
    term = "CASE WHEN x[{0}] > 0 THEN x[{0}] * log2(x[{0}] / ((x[1] + x[2]) / 2)) ELSE 0.0 END"
    total = f"list_sum(list_transform({pairs}, lambda x: {term.format(1)} + {term.format(2)}))"
    return f"CASE WHEN list_sum({own}) > 0 AND {reference} IS NOT NULL THEN sqrt(greatest({total} / 2, 0.0)) END"


def _references(name: str, texts: str, limits: Limits, bins: int) -> str:
    """Mean shares of near texts, sources by the share of theirs that are; kinds with those of all languages."""

    def summed(column: str, size: int) -> str:
        listed = ", ".join(f"avg(CASE WHEN near THEN {column}[{i + 1}] ELSE 0 * {column}[{i + 1}] END)" for i in range(size))
        return f"[{listed}] AS {column}"

    def mean(column: str, size: int) -> str:
        return f"[{', '.join(f'sum({column}[{i + 1}]) / sum(weight)' for i in range(size))}] AS {column}"

    weighed = f"(x[1] * n + x[2] * {limits.prior}) / (n + {limits.prior})"
    return f"""
{name}_source AS (
  SELECT lang, source, {summed('kinds', bins)}, {summed('words', 17)}, avg(near::INT) AS weight,
         count(*) FILTER (near) AS n
  FROM (
    SELECT lang, source, near, list_transform(kinds, lambda x: x / list_sum(kinds)) AS kinds,
           list_transform(common, lambda x: x / list_sum(common)) AS words
    FROM {texts}) GROUP BY lang, source
),
{name} AS (
  SELECT lang, list_transform(list_zip(kinds, all_kinds), lambda x: {weighed}) AS all_kinds,
         CASE WHEN words[1] IS NOT NULL THEN words END AS all_common
  FROM (SELECT lang, {mean('kinds', bins)}, {mean('words', 17)}, sum(n) AS n FROM {name}_source GROUP BY lang),
       (SELECT kinds AS all_kinds FROM (SELECT {mean('kinds', bins)} FROM {name}_source))
)"""


def _quality(limits: Limits = Limits()) -> str:
    def count(word: str) -> str:
        gone = f"strlen(p) - strlen(replace(p, ' {word} ', ''))"
        return f"(({gone}) // {len(word.encode()) + 2})::BIGINT"

    kinds = [f"length(t) - length(regexp_replace(t, '{k.replace(chr(39), chr(39) * 2)}', '', 'g'))" for k in KINDS]
    common = " ".join(
        f"WHEN '{lang}' THEN [{', '.join(count(w) for w in words.split())}]" for lang, words in COMMON_WORDS.items()
    )
    bins = len(KINDS) + 2
    return rf"""
WITH d AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
         ' ' || regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}]+', '  ', 'g') || ' ' AS p
  FROM documents
),
w AS (
  SELECT *, list_filter(regexp_split_to_array(t, '{SPACE}'), lambda x: x <> '') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
),
spots AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) > 2),
twice AS (
  SELECT doc_id, i FROM spots
  QUALIFY count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) > 1
),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id
),
f AS (
  SELECT w.doc_id, lang, source, t, len(ws)::BIGINT AS n_words,
         length(regexp_replace(t, '{SPACE}', '', 'g'))::BIGINT AS word_chars,
         ({kinds[-1]})::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words,
         length(t) AS n_chars,
         [{", ".join(kinds)}] AS kinds,
         CASE lang {common} END AS common
  FROM w LEFT JOIN covered ON covered.doc_id = w.doc_id
),
h AS (
  SELECT * REPLACE (
    list_prepend(n_chars - word_chars, list_append(kinds, word_chars - list_sum(kinds)))::BIGINT[] AS kinds,
    list_append(common, greatest(n_words - list_sum(common), 0))::BIGINT[] AS common
  ) FROM f
),
a AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM h),
e AS (
  SELECT lang, source, t, any_value(kinds) AS kinds, any_value(common) AS common, TRUE AS near
  FROM a WHERE NOT base_failed AND n_words >= {limits.words} GROUP BY lang, source, t
),{_references("first", "e", limits, bins)},
m AS (
  SELECT e.* EXCLUDE (near), floor({_distance("kinds", "all_kinds")} * {STEPS}) AS step
  FROM e LEFT JOIN first ON first.lang IS NOT DISTINCT FROM e.lang
),
near AS (
  SELECT m.*, step <= median AS near FROM m JOIN (
    SELECT lang, min(step) AS median FROM (
      SELECT lang, step, 2 * count(*) OVER (PARTITION BY lang ORDER BY step) >= count(*) OVER (PARTITION BY lang) AS enough
      FROM m) WHERE enough GROUP BY lang
  ) half ON half.lang IS NOT DISTINCT FROM m.lang
),{_references("r", "near", limits, bins)},
j AS (
  SELECT a.*, {_distance("kinds", "all_kinds")} AS kd, {_distance("common", "all_common")} AS wd
  FROM a LEFT JOIN r ON r.lang IS NOT DISTINCT FROM a.lang
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       round(kd, 6) AS kinds_distance, round(wd, 6) AS words_distance,
       NOT base_failed AND NOT coalesce(n_words >= {limits.words} AND (
         kd > greatest({limits.kinds_least}, {limits.kinds_scaled} / sqrt(n_words)) OR wd > greatest({limits.words_least}, {limits.words_scaled} / sqrt(n_words))), FALSE) AS kept
FROM j
"""


REPEATS = """
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS hx, strlen(coalesce(text, '')) AS n
  FROM documents
),
w AS (SELECT r, unnest(range(0, n - 199)) AS s, hx FROM t WHERE n >= 200),
g AS (SELECT r, s, md5(substr(hx, 2 * s + 1, 400)) AS g FROM w),
d AS (SELECT r, s FROM g QUALIFY count(*) OVER (PARTITION BY g) > 1),
e AS (SELECT r, s, coalesce(s > lag(s) OVER (PARTITION BY r ORDER BY s) + 200, TRUE) AS new FROM d),
f AS (SELECT r, s, sum(new::INT) OVER (PARTITION BY r ORDER BY s) AS run FROM e),
runs AS (SELECT r, run, min(s) AS a, max(s) + 200 AS b FROM f GROUP BY r, run),
gaps AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM runs),
kept AS (
  SELECT t.r, sum(b - a) AS gone, count(*) AS spans, max(b) AS last,
         string_agg(substr(hx, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
  FROM gaps JOIN t ON t.r = gaps.r GROUP BY t.r
)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(hx, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM t LEFT JOIN kept ON kept.r = t.r
"""


def _manifest(levels: int = 8, top_levels: int = 4) -> str:
    """Trees of up to 8^levels leaves and 8^top_levels languages, level by level."""

    def field(value: str) -> str:
        shown = f"CAST({value} AS VARCHAR)"
        return f"coalesce(strlen({shown}) || ':' || {shown}, '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(map(field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"

    # The CRC-32 bit by bit: a byte is mixed in, then eight steps are made.
    steps = "flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda a, x: {step}), 4294967295)"
    lower = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

    def grown(name: str, depth: int) -> str:
        parts = []
        for k in range(depth):
            parts.append(
                f"{name}_run{k} AS (SELECT tree, i // 8 AS i, list(h ORDER BY i) AS hs, any_value(n) AS n FROM "
                f"(SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}{k}) GROUP BY tree, i // 8)"
            )
            parts.append(
                f"{name}{k + 1} AS (SELECT tree, i, CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h "
                f"FROM {name}_run{k})"
            )
        return ",\n".join(parts)

    def folded(name: str, start: str, place: str, tree: str, depth: int) -> str:
        parts, before = [], start
        for k in range(depth):
            slot = f"(({place} // {8**k}) % 8)"
            new = f"array_to_string(list_transform(hs, lambda x, j: CASE WHEN j = {slot} + 1 THEN f ELSE x END), '')"
            others = f"array_to_string(list_filter(hs, lambda x, j: j <> {slot} + 1), '')"
            parts.append(
                f"{name}_fold{k} AS (SELECT p.* EXCLUDE (f, proof), CASE WHEN n > 1 THEN sha256({new}) ELSE f END AS f, "
                f"CASE WHEN n > 1 THEN proof || {others} ELSE proof END AS proof FROM {before} p JOIN {name}_run{k} q "
                f"ON q.tree IS NOT DISTINCT FROM p.{tree} AND q.i = p.{place} // {8 ** (k + 1)})"
            )
            before = f"{name}_fold{k}"
        return ",\n".join(parts)

    return f"""
WITH leaves AS (
  SELECT doc_id, lang, {leaf('text')} AS leaf,
         CASE WHEN {crc} % 3 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS f
  FROM documents
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, f) - 1 AS place, '' AS proof FROM leaves
),
low0 AS (SELECT lang AS tree, place AS i, leaf AS h FROM placed),
{grown('low', levels)},
subroots AS (SELECT tree AS lang, h AS subroot, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS t FROM low{levels}),
top0 AS (SELECT '' AS tree, t AS i, subroot AS h FROM subroots),
{grown('top', top_levels)},
{folded('low', 'placed', 'place', 'lang', levels)},
named AS (
  SELECT p.*, subroot, t, '' AS one FROM low_fold{levels - 1} p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang
),
{folded('top', 'named', 't', 'one', top_levels)}
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = h AS verified
FROM top_fold{top_levels - 1}, top{top_levels}
"""


ORACLES: dict[str, str] = {
    "op11_suffix_array_dedup": REPEATS,
    "op13_merkle_manifest": _manifest(),
    "op4_quality_rules": _quality(),
    "op8_minhash_near_dedup": NEAR,
    "op10_exact_dedup": EXACT,
}
