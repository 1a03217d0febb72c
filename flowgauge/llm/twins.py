"""DuckDB twins of the operators that SQL can express."""

from __future__ import annotations

from flowgauge.llm.license_scans import TEMPLATES, templates_of

FILL_IN_MIDDLE = r"""
WITH drawn AS (
    SELECT doc_id, coalesce("text", '') AS whole,
        regexp_extract_all(coalesce("text", ''), '[^\n]*\n|[^\n]+') AS units,
        sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
    FROM documents
), cut AS (
    SELECT doc_id, whole, units, len(units) AS n,
        CAST('0x' || digest[1:8] AS BIGINT) % (len(units) + 1) AS x,
        CAST('0x' || digest[9:16] AS BIGINT) % (len(units) + 1) AS y,
        CASE WHEN whole = '' OR contains(whole, '<P>') OR contains(whole, '<S>') OR contains(whole, '<M>') THEN 'plain'
            WHEN CAST('0x' || digest[25:32] AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), thirds AS (
    SELECT *, array_to_string(units[1:least(x, y)], '') AS prefix,
        array_to_string(units[least(x, y) + 1:greatest(x, y)], '') AS middle,
        array_to_string(units[greatest(x, y) + 1:n], '') AS suffix
    FROM cut
)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN whole WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
        ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
    sha256(whole) AS restored_sha256
FROM thirds
"""

CONVERSATION_TRIE = r"""
WITH said AS (
    SELECT CAST(conv_id AS BIGINT) AS conv, turn, coalesce("text", '') AS said,
        md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce("text", '')) AS id
    FROM conversations WHERE conv_id IS NOT NULL
), placed AS (
    SELECT conv, struct_pack(id := id, words := CAST(len(regexp_extract_all(said, '[^\x20\x09-\x0D]+')) AS BIGINT)) AS turn,
        row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, id) - 1 AS pos
    FROM said
), whole AS (
    SELECT conv, list(turn ORDER BY pos) AS turns FROM placed GROUP BY conv
), bits AS (
    SELECT conv, turns, flatten(list_transform(string_split(CAST(conv AS VARCHAR), ''),
        lambda x: list_transform(range(8), lambda k: CAST((ascii(x) >> k) & 1 AS BIGINT)))) AS bits
    FROM whole
), headed AS (
    SELECT conv, turns, CAST(xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], bits),
        lambda crc, bit: xor(crc >> 1, CASE WHEN (crc & 1) <> bit THEN CAST(3988292384 AS BIGINT) ELSE CAST(0 AS BIGINT) END)),
        CAST(4294967295 AS BIGINT)) % 4 AS INTEGER) AS h
    FROM bits
), rebuilt AS (
    SELECT c.conv, list_concat(coalesce(b.turns, [])[1:c.h], c.turns[c.h + 1:]) AS turns
    FROM headed c LEFT JOIN whole b ON b.conv = c.conv - c.conv % 20
), prefixes AS (
    SELECT conv, len(turns) AS n, d AS depth, turns[1:d] AS prefix, turns
    FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
), nodes AS (
    SELECT depth, prefix, min(conv) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(CAST(conv AS VARCHAR), ',' ORDER BY conv) FILTER (n = depth), '')) AS ends_sha256,
        CASE WHEN depth > 0 THEN (count(*) - 1) * any_value(prefix[depth].words) ELSE 0 END AS worth
    FROM prefixes GROUP BY depth, prefix
), children AS (
    SELECT prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), counted AS (
    SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.prefix = n.prefix
), sums AS (
    SELECT prefix, sum(leaf) AS n_leaves, sum(worth) AS saved_tokens
    FROM (SELECT prefix[1:d] AS prefix, leaf, worth FROM (
        SELECT prefix, worth, CAST(n_children = 0 AS INTEGER) AS leaf, unnest(range(0, depth + 1)) AS d FROM counted))
    GROUP BY prefix
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
    CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM counted n JOIN sums s ON s.prefix = n.prefix
    LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1]
"""


def license_scans(threshold: float = 0.9) -> str:
    """Every block compared with every template, without any filter."""
    rows = ", ".join(
        f"('{t.label}', [{', '.join(repr(w) for w in t.words)}], {t.need}, {t.stride})" for t in templates_of(TEMPLATES, threshold)
    )
    return rf"""
WITH templates(label, words, need, stride) AS (VALUES {rows}),
split AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM documents
), placed AS (
    SELECT r, doc_id, ws, len(ws) AS n,
        list_filter(range(len(ws)), lambda i: ws[i + 1] = 'mit' AND ws[i + 2] = 'license') AS mit,
        list_filter(range(len(ws)), lambda i: ws[i + 1] = 'apache' AND ws[i + 2] = 'license') AS apache,
        list_filter(range(len(ws)), lambda i: ws[i + 1] = 'general' AND ws[i + 2] = 'public' AND ws[i + 3] = 'license') AS gpl
    FROM split
), based AS (
    SELECT *, list_concat(mit, list_concat(apache, gpl)) AS places,
        list_filter([CASE WHEN len(mit) > 0 THEN 'mit' END, CASE WHEN len(apache) > 0 THEN 'apache' END,
            CASE WHEN len(gpl) > 0 THEN 'gpl' END], lambda x: x IS NOT NULL) AS base
    FROM placed
), blocks AS (
    SELECT r, stride, list_distinct(ws[k * stride + 1:k * stride + 2 * stride]) AS block
    FROM (SELECT r, ws, stride, unnest(range(CAST(greatest(0, ceil(n / stride) - 2) AS BIGINT) + 1)) AS k
        FROM placed, (SELECT DISTINCT stride FROM templates))
), met AS (
    SELECT r, list(DISTINCT label) AS labels, max(common / size) AS score
    FROM (SELECT r, label, need, len(words) AS size, len(list_intersect(words, block)) AS common
        FROM blocks JOIN templates USING (stride))
    WHERE common >= need GROUP BY r
)
SELECT doc_id, n AS n_words, len(places) AS n_base, list_min(places) AS first_word, list_max(places) AS last_word,
    array_to_string(list_sort(base), ',') AS base_labels,
    array_to_string(list_sort(list_distinct(list_concat(base, coalesce(labels, [])))), ',') AS labels,
    CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(score, 0.0::DOUBLE) END AS score
FROM based LEFT JOIN met USING (r)
"""
