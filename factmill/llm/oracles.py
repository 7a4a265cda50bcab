"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

TOP_K = """
WITH v AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.row AS query_row, a.vec_id AS query_id, b.vec_id AS vec_id,
           list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::BIGINT AS score
    FROM v a JOIN v b ON a.row <> b.row
    WHERE a.vec_id % 50 = 0
), r AS (
    SELECT *, row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""

LINES = """
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
    FROM documents
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), shared AS (
    SELECT key, min(doc_id) AS holder FROM keyed WHERE length(key) >= 10
    GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), judged AS (
    SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.holder AS gone FROM keyed k LEFT JOIN shared s USING (key)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

LEAKS = """
WITH item_words AS (
    SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
    FROM benchmark
), item_sizes AS (
    SELECT item_id, w, least(len(w), 5) AS k FROM item_words WHERE len(w) > 0
), item_shingles AS (
    SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s
    FROM item_sizes, LATERAL (SELECT unnest(range(1, len(w) - k + 2)) AS i)
), sized AS (
    SELECT item_id, count(*) AS n FROM item_shingles GROUP BY item_id
), doc_words AS (
    SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
    FROM documents
), doc_shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + k - 1], ' ') AS s
    FROM doc_words, (SELECT DISTINCT k FROM item_sizes), LATERAL (SELECT unnest(range(1, len(w) - k + 2)) AS i)
), shared AS (
    SELECT doc_id, item_id, count(*) AS n_shared FROM doc_shingles JOIN item_shingles USING (s) GROUP BY doc_id, item_id
)
SELECT doc_id, item_id, n::BIGINT AS n_shingles, n_shared::BIGINT AS n_shared
FROM shared JOIN sized USING (item_id) WHERE 5 * n_shared >= 4 * n
"""

NEAR = """
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                        ELSE [array_to_string(w, ' ')] END) AS s
    FROM words WHERE len(w) > 0
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)
), both_ways AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(a, b) AS (
    SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a
), least AS (
    SELECT a, min(b) AS b FROM reach GROUP BY a
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id
FROM words LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON a = doc_id
"""


def _lloyd(rounds: int = 6) -> str:
    """Plain Lloyd rounds: every part is compared with every entry, one pair of subqueries a round."""
    nearest = """
n{i} AS MATERIALIZED (
    SELECT row, p, any_value(part) AS part, min_by(c, (d, c)) AS c, min(d) AS d
    FROM (SELECT s.row, s.p, s.part, b.c, list_sum(list_transform(list_zip(s.part, b.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
          FROM parts s JOIN b{i} b ON s.p = b.p)
    GROUP BY row, p
)"""
    replaced = """
b{j} AS MATERIALIZED (
    SELECT b.p, b.c, coalesce(m.e, b.e) AS e FROM b{i} b LEFT JOIN (
        SELECT p, c, list(x ORDER BY k) AS e FROM (
            SELECT p, c, k, floor(sum(x) / count(*))::BIGINT AS x
            FROM (SELECT p, c, unnest(part) AS x, generate_subscripts(part, 1) AS k FROM n{i}) GROUP BY p, c, k)
        GROUP BY p, c) m ON b.p = m.p AND b.c = m.c
)"""
    steps = [nearest.replace("{i}", str(i)) + "," + replaced.replace("{i}", str(i)).replace("{j}", str(i + 1)) for i in range(rounds)]
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id, embedding) AS row, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
    SELECT row, p, v[p * (len(v) // 8) + 1:(p + 1) * (len(v) // 8)] AS part FROM kept, range(8) AS r(p)
), b0 AS (
    SELECT p, row - 1 AS c, part AS e FROM parts WHERE row <= 16
), {",".join(steps)}, {nearest.replace("{i}", str(rounds))}, books AS (
    SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, c, k)) AS digest
    FROM (SELECT p, c, unnest(e) AS x, generate_subscripts(e, 1) AS k FROM b{rounds})
), coded AS (
    SELECT row, string_agg(printf('%02x', c::INTEGER), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM n{rounds} GROUP BY row
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, digest AS codebooks_sha256
FROM kept JOIN coded USING (row), books
"""


CHAT = """
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
    SELECT *, CASE role WHEN 'user' THEN 13 WHEN 'system' THEN 11 WHEN 'assistant' THEN 7
                        ELSE 19 + length(regexp_replace(role, '([<\\[])(\\\\*(?:/?s>|/?INST\\]|/?SYS\\]|/?TEXT\\]|ROLE\\]))', '\\1-\\2', 'g')) END
              + length(regexp_replace(text, '([<\\[])(\\\\*(?:/?s>|/?INST\\]|/?SYS\\]|/?TEXT\\]|ROLE\\]))', '\\1-\\2', 'g')) AS chars
    FROM said
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
"""The lengths of a turn's control strings, and one character more for each escape."""

_FOLD = """list_reduce(list_prepend({{'h': {h}, 's': NULL, 'odd': 0}}, {siblings}), lambda a, x: {{
    'h': CASE WHEN x.s IS NULL THEN sha256(a.h) WHEN x.odd = 1 THEN sha256(x.s || a.h) ELSE sha256(a.h || x.s) END, 's': NULL, 'odd': 0}}).h"""
_ABOVE = "list_transform(range((len(nodes) + 1) // 2), lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], '')))"


def _leaf(n_chars: str) -> str:
    return " || ".join(f"coalesce(strlen(({f})::VARCHAR) || ':' || ({f})::VARCHAR, '-')" for f in ("doc_id", "source", "lang", n_chars, "text"))



MERKLE = f"""
WITH RECURSIVE leaves AS MATERIALIZED (
    SELECT doc_id, lang, sha256({_leaf("n_chars")}) AS leaf, sha256({_leaf("n_chars + 1")}) AS changed,
           list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
               lambda a, x: CASE WHEN xor(a, x) % 2 = 1 THEN xor(xor(a, x) // 2, 3988292384) ELSE xor(a, x) // 2 END) AS register
    FROM documents
), placed AS MATERIALIZED (
    SELECT doc_id, lang, leaf, CASE WHEN xor(register, 4294967295) % 7 = 0 THEN changed ELSE leaf END AS told,
           row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
    FROM leaves
), trees AS (
    SELECT lang, 0 AS level, list(leaf ORDER BY i) AS nodes FROM placed GROUP BY lang
    UNION ALL SELECT lang, level + 1, {_ABOVE} FROM trees WHERE len(nodes) > 1
), subroots AS MATERIALIZED (
    SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS j FROM trees WHERE len(nodes) = 1
), tops AS (
    SELECT 0 AS level, list(subroot ORDER BY j) AS nodes FROM subroots
    UNION ALL SELECT level + 1, {_ABOVE} FROM tops WHERE len(nodes) > 1
), above AS MATERIALIZED (
    SELECT s.lang, s.subroot, (SELECT nodes[1] FROM tops WHERE len(nodes) = 1) AS root,
           coalesce(list({{'h': NULL::VARCHAR, 's': t.nodes[xor(s.j >> t.level, 1) + 1], 'odd': (s.j >> t.level) & 1}} ORDER BY t.level) FILTER (WHERE t.level IS NOT NULL), []) AS path
    FROM subroots s LEFT JOIN tops t ON len(t.nodes) > 1 GROUP BY ALL
), paths AS MATERIALIZED (
    SELECT p.doc_id, p.lang, p.leaf, p.told, p.i,
           coalesce(list({{'h': NULL::VARCHAR, 's': t.nodes[xor(p.i >> t.level, 1) + 1], 'odd': (p.i >> t.level) & 1}} ORDER BY t.level) FILTER (WHERE t.level IS NOT NULL), []) AS path
    FROM placed p LEFT JOIN trees t ON t.lang IS NOT DISTINCT FROM p.lang AND len(t.nodes) > 1 GROUP BY ALL
), folded AS (
    SELECT p.doc_id, p.leaf, a.subroot, a.root, a.path AS upper, p.path, {_FOLD.format(h="p.told", siblings="p.path || a.path")} AS folded_root
    FROM paths p JOIN above a ON a.lang IS NOT DISTINCT FROM p.lang
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_filter(list_transform(path || upper, lambda x: x.s), lambda x: x IS NOT NULL), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM folded
"""
"""The register is the CRC's, bit by bit; a tree is a list of nodes a level, a proof a list of siblings."""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": LINES, "op2_decontaminate": LEAKS, "op5_ngram_jaccard": NEAR, "op8_topk": TOP_K,
        "op11_codes": _lloyd(), "op12_chat": CHAT, "op13_merkle": MERKLE,
    }
