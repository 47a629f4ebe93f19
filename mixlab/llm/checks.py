"""SQL checks that are too long to stand beside their queries."""

from __future__ import annotations

from mixlab.llm.vector_codes import ENTRIES, PARTS, ROUNDS, SCALE
from mixlab.llm.winnowing import BASES, PRIMES, TOKEN, K, WINDOW


def vector_codes_sql() -> str:
    """All rounds of the codebooks, one pair of common tables each, over one row per component."""

    def assigned(book: str) -> str:
        return f"""
        SELECT vec_id, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
            SELECT c.vec_id, c.part, b.entry, sum((c.x - b.x) * (c.x - b.x)) AS d
            FROM comps c JOIN {book} b ON c.part = b.part AND c.place = b.place GROUP BY c.vec_id, c.part, b.entry
        ) GROUP BY vec_id, part"""

    tables = [
        f"""kept AS MATERIALIZED (
            SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        )""",
        f"""comps AS MATERIALIZED (
            SELECT vec_id, label, (i - 1) // (len(v) // {PARTS}) AS part, (i - 1) % (len(v) // {PARTS}) AS place, v[i] AS x
            FROM (SELECT *, unnest(range(1, len(v) + 1)) AS i FROM kept)
        )""",
        f"""book0 AS MATERIALIZED (
            SELECT part, f.entry, place, x FROM comps
            JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT {ENTRIES}) f USING (vec_id)
        )""",
    ]
    for r in range(ROUNDS):
        tables.append(f"near{r} AS MATERIALIZED ({assigned(f'book{r}')})")
        tables.append(
            f"""book{r + 1} AS MATERIALIZED (
            SELECT b.part, b.entry, b.place, coalesce(m.x, b.x) AS x FROM book{r} b LEFT JOIN (
                SELECT c.part, n.entry, c.place, CAST(floor(sum(c.x) / count(*)) AS BIGINT) AS x
                FROM comps c JOIN near{r} n ON c.vec_id = n.vec_id AND c.part = n.part GROUP BY c.part, n.entry, c.place
            ) m ON b.part = m.part AND b.entry = m.entry AND b.place = m.place
        )"""
        )
    return f"""
    WITH {', '.join(tables)},
    last AS MATERIALIZED ({assigned(f'book{ROUNDS}')}),
    coded AS (
        SELECT vec_id, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
        FROM last GROUP BY vec_id
    )
    SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
           (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, place)) FROM book{ROUNDS}) AS codebooks_sha256
    FROM kept k JOIN coded c ON k.vec_id = c.vec_id
    """


PREFIX_TRIE = r"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
    ),
    ordered AS (
        SELECT conv_id, list((role, text) ORDER BY turn NULLS FIRST, sha256(CAST(length(role) AS VARCHAR) || ':' || role || ':' || text)) AS own
        FROM turns GROUP BY conv_id
    ),
    -- CRC-32 of the decimal id, bit by bit, modulo 4
    checked AS (
        SELECT *, list_reduce(
            list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1), lambda i: CAST(unicode(substr(CAST(conv_id AS VARCHAR), i, 1)) AS BIGINT))),
            lambda c, b: list_reduce(list_prepend(xor(c, b), range(0, 8)), lambda r, i: xor(r >> 1, 3988292384 * (r & 1)))
        ) AS state FROM ordered
    ),
    rebuilt AS (
        SELECT c.conv_id, list_concat(coalesce(b.own, [])[1:c.h], c.own[c.h + 1:]) AS seq
        FROM (SELECT *, CAST((4294967295 - state) % 4 AS BIGINT) AS h FROM checked) c LEFT JOIN ordered b ON b.conv_id = c.conv_id - c.conv_id % 20
    ),
    members AS (
        SELECT conv_id, d AS depth, len(seq) = d AS ended, CAST(seq[1:d] AS VARCHAR) AS node, CASE WHEN d > 0 THEN CAST(seq[1:d - 1] AS VARCHAR) END AS parent,
               CASE WHEN d > 0 THEN len(regexp_extract_all(seq[d][2], '[^\x20\x09-\x0D]+')) ELSE 0 END AS words
        FROM (SELECT *, unnest(range(0, len(seq) + 1)) AS d FROM rebuilt)
    ),
    nodes AS (
        SELECT node, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n, any_value(words) AS words,
               coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ended), '') AS ends
        FROM members GROUP BY node, depth
    ),
    kids AS (SELECT parent, depth - 1 AS depth, count(*) AS children FROM nodes WHERE depth > 0 GROUP BY parent, depth),
    full_nodes AS (
        SELECT n.*, coalesce(k.children, 0) AS children FROM nodes n LEFT JOIN kids k ON n.node = k.parent AND n.depth = k.depth
    ),
    -- every node above a node, taken from its least member
    above AS (
        SELECT m.node, m.depth, f.n, f.words, f.children FROM full_nodes f JOIN members m ON m.conv_id = f.conv_id AND m.depth <= f.depth
    ),
    sums AS (
        SELECT node, depth, count(*) FILTER (children = 0) AS leaves, sum((n - 1) * words) AS saved FROM above GROUP BY node, depth
    )
    SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n AS n_convs, f.children AS n_children, s.leaves AS n_leaves,
           CAST(s.saved AS BIGINT) AS saved_tokens, sha256(f.ends) AS ends_sha256
    FROM full_nodes f JOIN sums s ON f.node = s.node AND f.depth = s.depth LEFT JOIN nodes p ON f.parent = p.node AND f.depth = p.depth + 1
    """


def winnowing_sql() -> str:
    """One row per token, gram and window; the CRC-32 of each distinct token bit by bit."""

    def gram(which: int) -> str:
        prime, base = PRIMES[which], BASES[which]
        items = [f"coalesce(lead(v, {j}) OVER w, 0) * {pow(base, K - 1 - j, prime)}" for j in range(K)]
        return f"({' + '.join(items)}) % {prime}"

    return rf"""
    WITH docs AS (
        SELECT doc_id, coalesce(text, '') AS text, lead(coalesce(text, '')) OVER o AS following, first_value(coalesce(text, '')) OVER (ORDER BY doc_id NULLS LAST) AS opening
        FROM documents WINDOW o AS (ORDER BY doc_id NULLS LAST)
    ),
    texts AS (
        SELECT doc_id, text, length(text) AS n_chars,
               text[1:length(text) - length(text) // 4] || coalesce(following, opening)[1:length(text) // 4] AS edited,
               coalesce(following, opening) AS next
        FROM docs
    ),
    sides AS (SELECT doc_id, 'own' AS side, text AS t FROM texts UNION ALL SELECT doc_id, 'edited', edited FROM texts UNION ALL SELECT doc_id, 'next', next FROM texts),
    listed AS (SELECT doc_id, side, regexp_extract_all(t, '[^\x20\x09-\x0D]{{1,{TOKEN}}}') AS tokens FROM sides),
    tokens AS (SELECT doc_id, side, unnest(tokens) AS token, unnest(range(0, len(tokens))) AS i, len(tokens) AS n FROM listed),
    hashed AS (
        SELECT token, (4294967295 - list_reduce(
            list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, len(hex(encode(token))) // 2 + 1), lambda j: CAST('0x' || substr(hex(encode(token)), 2 * j - 1, 2) AS BIGINT))),
            lambda c, b: list_reduce(list_prepend(xor(c, b), range(0, 8)), lambda r, i: xor(r >> 1, 3988292384 * (r & 1)))
        )) % {PRIMES[0]} AS v
        FROM (SELECT DISTINCT token FROM tokens)
    ),
    grams AS (
        SELECT doc_id, side, i, n, {gram(0)} AS h1, {gram(1)} AS h2 FROM tokens JOIN hashed USING (token) WINDOW w AS (PARTITION BY doc_id, side ORDER BY i)
    ),
    whole AS (SELECT * FROM grams WHERE i <= greatest(n - {K}, 0)),
    windows AS (
        SELECT doc_id, side, i, n, arg_min(i, (h1, -i)) OVER w AS pick FROM whole
        WINDOW w AS (PARTITION BY doc_id, side ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING)
    ),
    picked AS (SELECT DISTINCT doc_id, side, pick AS i FROM windows WHERE i <= greatest(n - {K + WINDOW - 1}, 0)),
    marks AS (SELECT doc_id, side, i, h1 * 1073741824 + h2 AS h FROM picked JOIN whole USING (doc_id, side, i)),
    strings AS (SELECT doc_id, side, string_agg(CAST(i AS VARCHAR) || ':' || lower(hex(h)), ',' ORDER BY i) AS mark, list(DISTINCT h) AS hs FROM marks GROUP BY doc_id, side)
    SELECT t.doc_id, t.n_chars, sha256(t.edited) AS edited_sha256, coalesce(a.mark, '') AS fingerprint, coalesce(b.mark, '') AS edited_fingerprint,
           CASE WHEN a.hs IS NULL AND b.hs IS NULL THEN 1.0::DOUBLE
                ELSE len(list_intersect(coalesce(a.hs, []), coalesce(b.hs, [])))::DOUBLE / len(list_distinct(list_concat(coalesce(a.hs, []), coalesce(b.hs, []))))::DOUBLE END AS near_edited,
           CASE WHEN a.hs IS NULL AND c.hs IS NULL THEN 1.0::DOUBLE
                ELSE len(list_intersect(coalesce(a.hs, []), coalesce(c.hs, [])))::DOUBLE / len(list_distinct(list_concat(coalesce(a.hs, []), coalesce(c.hs, []))))::DOUBLE END AS near_next
    FROM texts t
    LEFT JOIN strings a ON a.doc_id = t.doc_id AND a.side = 'own'
    LEFT JOIN strings b ON b.doc_id = t.doc_id AND b.side = 'edited'
    LEFT JOIN strings c ON c.doc_id = t.doc_id AND c.side = 'next'
    """
