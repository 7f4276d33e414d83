"""DuckDB SQL of the corpus queries that SQL can express."""

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP2_MINHASH = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, {WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
    FROM documents
),
sets AS (
    SELECT doc_id, CASE
        WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')]
        ELSE [] END AS s
    FROM words
),
places AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n, unnest(s) AS shingle FROM sets),
links AS (
    SELECT x.doc_id AS a, y.doc_id AS b
    FROM places x JOIN places y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
    GROUP BY x.doc_id, y.doc_id, x.n, y.n
    HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
),
reached(doc_id, first) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT l.b, r.first FROM reached r JOIN links l ON l.a = r.doc_id WHERE r.first < l.b
),
components AS (SELECT doc_id, min(first) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN components USING (doc_id)
"""

OP3_SUFFIXES = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
chunks AS (SELECT doc_id, n, pos, substr(h, 2 * pos + 1, 1098) AS c FROM (SELECT *, unnest(range(0, n, 500)) AS pos FROM d)),
windows AS (
    SELECT doc_id, pos + k AS p, substr(c, 2 * k + 1, 100) AS s
    FROM (SELECT *, unnest(range(0, least(500, n - 49 - pos))) AS k FROM chunks)
),
firsts AS (SELECT s, min(doc_id) AS first FROM windows GROUP BY s HAVING min(doc_id) < max(doc_id)),
hits AS (
    SELECT w.doc_id, w.p, coalesce(w.p - lag(w.p) OVER (PARTITION BY w.doc_id ORDER BY w.p) > 50, true) AS new
    FROM windows w JOIN firsts f ON w.s = f.s AND f.first < w.doc_id
),
numbered AS (SELECT doc_id, p, sum(CAST(new AS INT)) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM hits),
runs AS (SELECT doc_id, run, min(p) AS a, max(p) + 50 AS b FROM numbered GROUP BY doc_id, run),
gaps AS (SELECT *, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM runs),
cuts AS (
    SELECT doc_id, sum(b - a) AS removed, count(*) AS spans, max(b) AS last,
        string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
    FROM gaps JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
    sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cuts USING (doc_id)
"""

OP5_QUALITY = rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS.format("coalesce(text, '')")} AS words FROM documents),
lines AS (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM w),
windows AS (
    SELECT doc_id, i, array_to_string(words[i : i + 4], ' ') AS five
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w)
),
repeated AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, five) > 1),
covered AS (
    SELECT doc_id, sum(n) AS n
    FROM (SELECT doc_id, least(5, i - lag(i, 1, -5) OVER (PARTITION BY doc_id ORDER BY i)) AS n FROM repeated)
    GROUP BY doc_id
),
counts AS (
    SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars, len(ls) AS n_lines,
        len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
        coalesce(n, 0) AS n_repeat_words, length(regexp_replace(text, '[^\p{{L}}]+', '', 'g')) AS letters,
        length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g')) AS capitals
    FROM lines LEFT JOIN covered USING (doc_id)
),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
    CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
    NOT (base_failed OR 10 * n_symbols > n_words OR word_chars > 40 * n_words OR 2 * word_chars < 3 * n_words
        OR 10 * n_dup_lines > 3 * greatest(n_lines, 1) OR 10 * letters < 6 * greatest(word_chars, 1)
        OR 2 * capitals > greatest(word_chars, 1)) AS kept
FROM judged
"""


OP11_MIDDLES = """
WITH u AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
lots AS (
    SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
        CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
    FROM u
),
ranks AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM lots),
parts AS (
    SELECT doc_id, text, n,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
            WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
        coalesce(array_to_string(u[1 : a], ''), '') AS p, coalesce(array_to_string(u[a + 1 : b], ''), '') AS m, coalesce(array_to_string(u[b + 1 :], ''), '') AS s
    FROM ranks
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parts
"""

_NEAREST = """n{turn} AS (
    SELECT id, pos, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d
    FROM (SELECT x.id, x.pos, x.part, e.entry, list_sum(list_transform(range(1, len(x.part) + 1), lambda i: (x.part[i] - e.part[i]) * (x.part[i] - e.part[i]))) AS d
        FROM parts x JOIN c{turn} e ON x.pos = e.pos)
    GROUP BY id, pos, part
)"""
_UPDATE = """m{turn} AS (SELECT pos, entry, k, sum(v) AS s, count(*) AS n FROM (SELECT pos, entry, unnest(range(1, len(part) + 1)) AS k, unnest(part) AS v FROM n{turn}) GROUP BY pos, entry, k),
v{turn} AS (SELECT pos, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY k) AS part FROM m{turn} GROUP BY pos, entry),
c{next} AS (SELECT c.pos, c.entry, coalesce(v.part, c.part) AS part FROM c{turn} c LEFT JOIN v{turn} v USING (pos, entry))"""
OP13_CODES = (
    """
WITH kept AS (
    SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
parts AS (SELECT id, pos, v[pos * len(v) // 4 + 1 : (pos + 1) * len(v) // 4] AS part FROM (SELECT id, v, unnest(range(4)) AS pos FROM kept)),
c0 AS (SELECT pos, id - 1 AS entry, part FROM parts WHERE id <= 256),
"""
    + ",\n".join(f"{_NEAREST.format(turn=t)},\n{_UPDATE.format(turn=t, next=t + 1)}" for t in range(4))
    + f",\n{_NEAREST.format(turn=4)},\n"
    + """coded AS (SELECT id, lower(string_agg(printf('%02x', entry), '' ORDER BY pos)) AS code, CAST(sum(d) AS BIGINT) AS error FROM n4 GROUP BY id),
books AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY pos, entry, k)) AS codebooks_sha256 FROM (SELECT pos, entry, unnest(range(1, len(part) + 1)) AS k, unnest(part) AS x FROM c4))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (id) CROSS JOIN books
"""
)


def all_oracles() -> dict[str, str]:
    """SQL by the name of its query."""
    return {
        "op2_minhash": OP2_MINHASH,
        "op3_suffixes": OP3_SUFFIXES,
        "op5_quality": OP5_QUALITY,
        "op11_middles": OP11_MIDDLES,
        "op13_codes": OP13_CODES,
    }
