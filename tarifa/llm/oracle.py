"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def near_dup(shingle: int, source: str = "documents") -> str:
    joined = " || ' ' || ".join(f"ws[i + {k}]" for k in range(shingle))
    return rf"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+') AS ws FROM {source}
    ), sets AS (
        SELECT doc_id, list_distinct(CASE
            WHEN len(ws) = 0 THEN []
            WHEN len(ws) < {shingle} THEN [array_to_string(ws, ' ')]
            ELSE list_transform(range(1, len(ws) - {shingle} + 2), lambda i: {joined}) END) AS sh
        FROM words
    ), items AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS s FROM sets),
    links AS (
        SELECT x.doc_id AS a, y.doc_id AS b FROM items x JOIN items y ON x.s = y.s AND x.doc_id <> y.doc_id
        GROUP BY ALL HAVING 100 * count(*) >= 80 * (any_value(x.n) + any_value(y.n) - count(*))
    ), reach(doc_id, other) AS (
        SELECT a, b FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
    ), least_of AS (SELECT doc_id, min(other) AS m FROM reach GROUP BY doc_id)
    SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, coalesce(least(m, s.doc_id), s.doc_id) AS component_id,
           coalesce(least(m, s.doc_id), s.doc_id) = s.doc_id AS kept
    FROM sets s LEFT JOIN least_of USING (doc_id)
    """


def decontamination(source: str = "documents") -> str:
    words = rf"regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return rf"""
    WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {words} AS ws FROM benchmark),
    windows AS (
        SELECT DISTINCT item, least(len(ws), 10) AS size, unnest(CASE WHEN len(ws) < 10 THEN [array_to_string(ws, ' ')]
            ELSE list_transform(range(1, len(ws) - 8), lambda i: array_to_string(ws[i : i + 9], ' ')) END) AS phrase
        FROM items WHERE len(ws) > 0
    ), docs AS (SELECT doc_id, {words} AS ws FROM {source}),
    sizes AS (SELECT DISTINCT size FROM windows),
    runs AS (
        SELECT doc_id, size, unnest(range(1, len(ws) - size + 2)) AS pos, ws FROM docs, sizes WHERE len(ws) >= size
    ), hits AS (
        SELECT doc_id, pos, r.size, item FROM (SELECT doc_id, size, pos, array_to_string(ws[pos : pos + size - 1], ' ') AS phrase FROM runs) r
        JOIN windows w ON r.phrase = w.phrase AND r.size = w.size
    ), covered AS (
        SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS word FROM hits) GROUP BY doc_id
    ), named AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
    )
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
    """


WARC = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS h FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id > first THEN first END AS refers_to
FROM f
"""

EMBEDDINGS = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
    WHERE list_cosine_similarity(x.e, y.e) >= 0.93
), reach(vec_id, other) AS (
    SELECT a, b FROM links UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other
), least_of AS (SELECT vec_id, min(other) AS m FROM reach GROUP BY vec_id),
counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, coalesce(least(m, vec_id), vec_id) AS component_id,
       coalesce(least(m, vec_id), vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN least_of USING (vec_id) LEFT JOIN counted USING (vec_id)
"""

MARKED = r"regexp_replace({}, '([<\[])(\\*)(/?s>|/?INST\])', '\1\2\\\3', 'g')"

CHAT = f"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), numbered AS (
    SELECT *, row_number() OVER w AS number, CAST(ceil(length(text) / 4) AS BIGINT) + 4 AS tokens,
           length({MARKED.format("role")}) + length({MARKED.format("text")}) + length('<s>[INST][/INST]</s>') AS chars
    FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), begun AS (
    SELECT *, sum(tokens) OVER (PARTITION BY conv_id ORDER BY number) - tokens AS begin FROM numbered
), systems AS (
    SELECT conv_id, min(number) AS s_number, min_by(tokens, number) AS s_tokens, min_by(chars, number) AS s_chars
    FROM begun WHERE role = 'system' GROUP BY conv_id
), cells AS (
    SELECT *, greatest((512 - 64 - coalesce(s_tokens, 0)) // 2, 64) AS cell FROM begun LEFT JOIN systems USING (conv_id)
), uses AS (
    SELECT *, begin // cell AS part, 2 AS use FROM cells
    UNION ALL SELECT *, begin // cell + 1, 1 FROM cells WHERE begin >= (begin // cell + 1) * cell - 64
), parts AS (
    SELECT conv_id, part, sum(chars) + CASE WHEN bool_or(number = s_number) OR any_value(s_chars) IS NULL THEN 0 ELSE any_value(s_chars) END AS chars
    FROM uses GROUP BY conv_id, part HAVING max(use) = 2
), formatted AS (SELECT conv_id, sum(chars) AS chars FROM parts GROUP BY conv_id)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY number)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY number) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(any_value(f.chars) AS BIGINT) AS formatted_chars
FROM numbered JOIN formatted f USING (conv_id) GROUP BY conv_id
"""


def divergence_sql(least: int = 10, top: int = 10) -> str:
    return rf"""
    WITH docs AS (
        SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               regexp_extract_all({LOWERED}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
        FROM documents
    ), found AS (SELECT d, lang, source, unnest(ts) AS term FROM docs),
    kept AS (SELECT lang, term FROM found GROUP BY ALL HAVING count(DISTINCT d) >= {least}),
    counts AS (SELECT lang, source, term, count(*) AS n FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL),
    langs AS (
        SELECT lang, (SELECT count(*) FROM kept k WHERE k.lang = l.lang) AS v,
               (SELECT coalesce(sum(n), 0) FROM counts c WHERE c.lang = l.lang) AS total
        FROM (SELECT DISTINCT lang FROM docs) l
    ), groups_ AS (
        SELECT g.lang, g.source, v, (SELECT coalesce(sum(n), 0) FROM counts c WHERE c.lang = g.lang AND c.source = g.source) AS total
        FROM (SELECT DISTINCT lang, source FROM docs) g JOIN langs USING (lang)
    ), shares AS (
        SELECT g.lang, g.source, term, coalesce(n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(n, 0) + 2) // (g.total + 2 * v)::HUGEINT AS p
        FROM groups_ g JOIN kept USING (lang) LEFT JOIN counts c USING (lang, source, term)
    ), lang_shares AS (
        SELECT lang, term, 1 + 1000000000::HUGEINT * (sum(n) + 2)::HUGEINT // any_value(l.total + 2 * v)::HUGEINT AS q
        FROM counts JOIN langs l USING (lang) GROUP BY ALL
    ), pairs AS (
        SELECT a.lang, a.source, b.source AS item,
               coalesce((SELECT sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) FROM shares x JOIN shares y USING (lang, term)
                         WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
        FROM groups_ a JOIN groups_ b ON a.lang = b.lang AND a.source <> b.source
    ), terms AS (
        SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value FROM shares JOIN lang_shares USING (lang, term)
        WHERE n > 0 AND p > q
    )
    SELECT lang, source, 'pair' AS part, item, value::BIGINT AS value,
           row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM pairs
    UNION ALL
    SELECT lang, source, 'term', item, value::BIGINT, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank
    FROM terms QUALIFY rank <= {top}
    """


def repair_sql() -> str:
    """The damage, then row by row the least (cost, edits) of each state, and the least of those that may end."""
    return r"""
    WITH RECURSIVE crc AS (
        SELECT list(c ORDER BY i) AS steps FROM (
            SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
                lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c
            FROM range(256) r(i))
    ), original AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
        FROM conversations
    ), kinds AS (
        SELECT o.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(k, ''), lambda c: ascii(c)::BIGINT)),
                   lambda a, b: xor(steps[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) % 20 AS kind
        FROM original o, crc
    ), damaged AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
               CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
        FROM kinds, range(2) t(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)
    ), placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged
    ), facts AS (
        SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
               row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
               regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS core
        FROM placed
    ), rows_ AS (
        SELECT *, core = '' AS blank, core <> '' AND again AS duplicate,
               core <> '' AND NOT again AND right(core, 1) NOT IN ('.', '!', '?') AS truncated
        FROM facts
    ), leads(state, initial, after) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
    inserts(state, letters, after, lines) AS (VALUES
        (0, '', 0, ''), (0, 'I', 2, 'user:' || chr(10)), (0, 'II', 3, 'user:' || chr(10) || 'assistant:' || chr(10)),
        (1, '', 1, ''), (1, 'I', 2, 'user:' || chr(10)), (1, 'II', 3, 'user:' || chr(10) || 'assistant:' || chr(10)),
        (2, '', 2, ''), (2, 'I', 3, 'assistant:' || chr(10)), (3, '', 3, ''), (3, 'I', 2, 'user:' || chr(10))
    ), best AS (
        SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS state, 0 AS cost, '' AS audit, '' AS lines FROM original
        UNION ALL
        SELECT conv_id, i, state, cost, audit, lines FROM (
            SELECT r.conv_id, r.i, e.after AS state, b.cost + 2 * len(n.letters) + e.cost + (CASE WHEN e.edit <> 'D' AND truncated THEN 1 ELSE 0 END) AS cost,
                   b.audit || n.letters || e.edit AS audit,
                   b.lines || n.lines || CASE e.edit WHEN 'D' THEN '' WHEN 'K' THEN r.role || ':' || r.text || chr(10)
                       ELSE e.name || ':' || r.text || chr(10) END AS lines
            FROM best b JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i + 1
            JOIN inserts n ON n.state = b.state
            JOIN (
                SELECT state, initial, after, 'K' AS edit, 0 AS cost, '' AS name FROM leads
                UNION ALL SELECT state, NULL, after, 'R', 2, CASE initial WHEN 'u' THEN 'user' ELSE 'assistant' END FROM leads WHERE initial <> 's'
                UNION ALL SELECT s, NULL, s, 'D', 3, '' FROM range(4) x(s)
            ) e ON e.state = n.after AND (e.edit <> 'K' OR e.initial = r.initial) AND (e.edit = 'D' OR NOT (blank OR duplicate))
        ) QUALIFY row_number() OVER (PARTITION BY conv_id, i, state ORDER BY cost, audit) = 1
    ), sizes AS (
        SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
               count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
        FROM rows_ GROUP BY conv_id
    ), ends AS (
        SELECT b.conv_id, b.cost + 2 * len(n.letters) AS cost, b.audit || n.letters AS audit, b.lines || n.lines AS lines
        FROM best b LEFT JOIN sizes s ON s.conv_id IS NOT DISTINCT FROM b.conv_id
        JOIN inserts n ON n.state = b.state AND n.after IN (0, 3)
        WHERE b.i = coalesce(s.n, 0)
        QUALIFY row_number() OVER (PARTITION BY b.conv_id ORDER BY b.cost + 2 * len(n.letters), b.audit || n.letters) = 1
    )
    SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, e.cost::BIGINT AS cost, audit,
           sha256(left(lines, greatest(len(lines) - 1, 0))) AS repaired_sha256
    FROM ends e LEFT JOIN sizes s ON s.conv_id IS NOT DISTINCT FROM e.conv_id
    """


def oracle() -> dict[str, str]:
    return {
        "op2_near_dup": near_dup(4),
        "op4_warc": WARC,
        "op5_embeddings": EMBEDDINGS,
        "op6_chat": CHAT,
        "op9_decontamination": decontamination(),
        "op11_divergence": divergence_sql(),
        "op12_repair": repair_sql(),
    }
