"""SQL for the queries that SQL can express."""

from __future__ import annotations

NAMES = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in name)
                 for name in ("password", "passwd", "secret", "token", "api_?key"))
# (kind, pattern, group that must be long enough, shortest length)
KINDS = (
    ("assign", f"({NAMES})[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]+", 0, 32),
)


def _spans(number: int, kind: str, pattern: str, group: int, shortest: int) -> str:
    """Spans of one kind: gaps and matches alternate, so their lengths add up to positions."""
    return f"""
SELECT doc_id, t, list_filter(list_transform(range(1, len(m) + 1), lambda i: {{
    's': list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0),
    'k': {number}, 'n': '{kind}', 'l': length(m[i]), 'g': length(g[i])}}), lambda x: x.g >= {shortest}) AS spans
FROM (SELECT row_no, doc_id, t, regexp_extract_all(t, '{pattern}') AS m, regexp_extract_all(t, '{pattern}', {group}) AS g,
    string_split_regex(t, '{pattern}') AS gaps FROM docs)"""


def _count(kind: str) -> str:
    return f"CAST(len(list_filter(spans, lambda x: x.n = '{kind}')) AS BIGINT) AS n_{kind}"


def _secrets() -> str:
    kinds = [_spans(number, *kind).replace("SELECT doc_id, t,", "SELECT row_no,") for number, kind in enumerate(KINDS)]
    joined = " ".join(f"JOIN k{number} USING (row_no)" for number in range(3))
    return f"""
WITH docs AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS t FROM documents),
{", ".join(f"k{number} AS ({body})" for number, body in enumerate(kinds))},
found AS (SELECT docs.doc_id, list_sort(k0.spans || k1.spans || k2.spans) AS spans FROM docs {joined})
SELECT doc_id, {", ".join(_count(kind[0]) for kind in KINDS)}, sha256(joined) AS base_sha256, joined AS spans
FROM (SELECT doc_id, spans, array_to_string(list_transform(spans, lambda x:
    concat(x.n, ':', CAST(x.s AS BIGINT), ':', CAST(x.s + x.l AS BIGINT))), ',') AS joined FROM found)"""


PREFERENCES = """
WITH known AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    WHERE conv_id IS NOT NULL),
replies AS (SELECT conv_id, turn AS last, min(text) AS text FROM known WHERE role = 'assistant' AND turn IS NOT NULL
    GROUP BY conv_id, turn QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1),
ring AS (SELECT conv_id, last, coalesce(lead(text) OVER (ORDER BY conv_id),
    first_value(text) OVER (ORDER BY conv_id)) AS other, count(*) OVER () AS total FROM replies),
sides AS (
    SELECT *, 'chosen' AS part FROM known
    UNION SELECT k.*, 'rejected' FROM known k LEFT JOIN ring r ON k.conv_id = r.conv_id
        WHERE r.last IS NULL OR k.turn IS DISTINCT FROM r.last OR k.role <> 'assistant'
    UNION SELECT conv_id, last, 'assistant', other, 'rejected' FROM ring WHERE total > 1),
turns AS (SELECT *, count(*) OVER (PARTITION BY conv_id, turn, role, text) AS n FROM sides),
marked AS (SELECT *, bool_or(n = 1 AND turn IS NULL) OVER (PARTITION BY conv_id) AS at_once,
    min(CASE WHEN n = 1 THEN turn END) OVER (PARTITION BY conv_id) AS first FROM turns),
pieces AS (SELECT DISTINCT conv_id, turn, role, '<|' || role || '|>' || chr(10) || text || chr(10) AS piece,
    CASE WHEN at_once THEN part WHEN first IS NULL OR turn IS NULL OR turn < first THEN 'prompt' ELSE part END AS part
    FROM marked),
ends AS (SELECT *, sum(length(piece)) OVER (PARTITION BY conv_id, part ORDER BY turn NULLS FIRST, role, piece
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stop FROM pieces),
spans AS (SELECT *, CASE WHEN role = 'assistant' THEN concat(CAST(stop - length(piece) AS BIGINT), ':', CAST(stop AS BIGINT)) END AS span
    FROM ends)
SELECT conv_id AS pair_id,
    coalesce(string_agg(piece, '' ORDER BY turn NULLS FIRST, role, piece) FILTER (WHERE part = 'prompt'), '') AS prompt,
    coalesce(string_agg(piece, '' ORDER BY turn NULLS FIRST, role, piece) FILTER (WHERE part = 'chosen'), '') AS chosen,
    coalesce(string_agg(piece, '' ORDER BY turn NULLS FIRST, role, piece) FILTER (WHERE part = 'rejected'), '') AS rejected,
    coalesce(string_agg(span, ',' ORDER BY stop) FILTER (WHERE part = 'chosen'), '') AS chosen_mask,
    coalesce(string_agg(span, ',' ORDER BY stop) FILTER (WHERE part = 'rejected'), '') AS rejected_mask
FROM spans GROUP BY conv_id"""

EMBEDDINGS = """
WITH RECURSIVE good AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links, m.component_id,
    e.vec_id = m.component_id AS kept
FROM embeddings e JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) m ON e.vec_id = m.a"""

# Keys of the sample come from MD5, so the whole mix can be followed: shares by filling up, then a running sum.
MIX = r"""
WITH quality AS (SELECT doc_id, CASE max(quality) WHEN 1 THEN 2.0 ELSE 0.5 END AS quality FROM labels
    WHERE doc_id IS NOT NULL AND quality IN (0, 1) GROUP BY doc_id),
sized AS (SELECT d.doc_id, d.source, len(regexp_extract_all(coalesce(d.text, ''), '[^\x20\x09-\x0D]+')) AS size,
    CAST(coalesce(q.quality, 1.0) AS DOUBLE) AS quality, md5(coalesce(d.text, '')) AS digest
    FROM documents d LEFT JOIN quality q ON d.doc_id = q.doc_id),
keyed AS (SELECT *, -ln((CAST('0x' || substr(md5(concat_ws(':', 'mix', coalesce(CAST(doc_id AS VARCHAR), ''), size, digest)), 1, 13)
    AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE) / quality AS real FROM sized),
rows AS (SELECT *, CAST(least(floor(real / (real + 1) * 1152921504606846976::DOUBLE), 1152921504606846975) AS BIGINT) AS key FROM keyed),
numbered AS (SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS number
    FROM rows GROUP BY source),
weighted AS (SELECT *, CASE number % 3 WHEN 1 THEN 5 WHEN 2 THEN 2 ELSE 1 END AS weight FROM numbered),
filled AS (SELECT *, row_number() OVER (ORDER BY source_size / weight, number) AS place, coalesce(sum(3 * source_size) OVER below, 0) AS held, coalesce(sum(weight) OVER below, 0) AS gone,
    sum(source_size) OVER () AS total, sum(weight) OVER () AS weights FROM weighted
    WINDOW below AS (ORDER BY source_size / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
rates AS (SELECT arg_min(CAST(total - held AS DOUBLE) / CAST(weights - gone AS DOUBLE), place) AS rate FROM filled
    WHERE CAST(total - held AS DOUBLE) / CAST(weights - gone AS DOUBLE) * weight <= 3 * source_size),
aimed AS (SELECT source, CAST(source_size AS BIGINT) AS source_size,
    least(weight * coalesce(rate, 0), CAST(3 * source_size AS DOUBLE)) AS target FROM filled, rates),
running AS (SELECT r.doc_id, r.size, a.source_size, a.target, CAST(floor(a.target + 0.5) AS BIGINT) AS budget,
    coalesce(sum(r.size) OVER (PARTITION BY r.source ORDER BY r.key, r.doc_id NULLS FIRST, r.size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM rows r JOIN aimed a ON r.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(CASE WHEN source_size = 0 THEN 0 ELSE
    budget // source_size * size + least(size, greatest(0, budget % source_size - before)) END AS BIGINT) AS taken
FROM running"""

ORACLE: dict[str, str] = {
    "op1_secret_scan": _secrets(),
    "op5_preference_format": PREFERENCES,
    "op7_embedding_tiles": EMBEDDINGS,
    "op11_source_mix": MIX,
}
