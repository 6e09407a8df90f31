"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

#: Words of a text as a list.
_WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"

LINES = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t, text IS NULL AS no_text, {_WORDS.format('text')} AS w FROM documents),
l AS (SELECT r, source, line, len({_WORDS.format('line')}) AS n FROM (SELECT r, source, unnest(string_split(t, chr(10))) AS line FROM d)
      WHERE len({_WORDS.format('line')}) > 0),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM l GROUP BY r),
g AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
twice AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
rep AS (SELECT r, count(DISTINCT i + j) AS n FROM twice, range(5) AS o(j) GROUP BY r),
norm AS (SELECT r, source, n, lower(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM l),
one AS (SELECT min(r) AS r, source FROM d GROUP BY source, t, no_text),
hosts AS (SELECT source, count(*) AS n FROM one GROUP BY source),
freq AS (SELECT norm.source, h FROM norm SEMI JOIN one ON norm.r = one.r JOIN hosts ON norm.source IS NOT DISTINCT FROM hosts.source
         GROUP BY norm.source, h, hosts.n HAVING count(DISTINCT norm.r) > 1000 OR (count(DISTINCT norm.r) > 20 AND count(DISTINCT norm.r) > 0.05 * hosts.n)),
lost AS (SELECT r, sum(norm.n) AS n FROM norm JOIN freq ON norm.h = freq.h AND norm.source IS NOT DISTINCT FROM freq.source GROUP BY r),
b AS (SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
      length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
      coalesce(rep.n, 0) AS n_repeat_words, CAST(coalesce(lost.n, 0) AS BIGINT) AS n_frequent_words
      FROM d LEFT JOIN dup USING (r) LEFT JOIN rep USING (r) LEFT JOIN lost USING (r))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT base_failed AND n_words - n_frequent_words >= 10 AND n_words - n_frequent_words >= 0.33 * n_words AS kept FROM b
"""

TOPK = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""

_CONTROL = r"([<\[])(\\*)(s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>|ROLE\]|:ROLE\]|/ROLE\])"
CHAT = rf"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
f AS (SELECT *, length(regexp_replace(text, '{_CONTROL}', '\1\\\2\3', 'g')) + CASE role
        WHEN 'system' THEN length('<<SYS>>  <</SYS>>  ') WHEN 'user' THEN length('[INST]  [/INST]') WHEN 'assistant' THEN length('<s>  </s> ')
        ELSE length('[ROLE][:ROLE][/ROLE] ') + length(regexp_replace(role, '{_CONTROL}', '\1\\\2\3', 'g')) END AS n,
        lag(role) OVER w AS prev, lead(turn) OVER w IS NULL AS is_last, row_number() OVER w AS pos
      FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars,
       bool_and(CASE role WHEN 'system' THEN pos = 1 WHEN 'user' THEN pos = 1 OR prev IN ('system', 'assistant')
                          WHEN 'assistant' THEN coalesce(prev = 'user', false) ELSE false END)
         AND max_by(role, pos) = 'assistant' AS valid
FROM f GROUP BY conv_id
"""

DEBRUIJN = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format('text')} AS w FROM documents),
g AS (SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS g FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
twice AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY g) > 1),
gone AS (SELECT r, list(DISTINCT i + j) AS gone FROM twice, range(35) AS o(j) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone.gone), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN gone.gone IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(gone.gone, i)) END, ' '), '')) AS kept_sha256
FROM d LEFT JOIN gone USING (r)
"""

#: CRC-32 of a text's bytes, its table made by rule.
INTERLEAVE = r"""
WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda c, b: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)) AS crc),
d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t, strlen(coalesce(text, '')) + 16 AS size,
      list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: (instr('0123456789ABCDEF', x[1]) - 1) * 16 + instr('0123456789ABCDEF', x[2]) - 1) AS b
      FROM documents),
c AS (SELECT r, doc_id, source, size, xor(4294967295, list_reduce(list_concat([4294967295], b), lambda s, x: xor(s // 256, crc[xor(s % 256, x) + 1]))) AS text_crc32,
      md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM d, crc),
f AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY h, doc_id NULLS FIRST, size, text_crc32, r) AS pos,
      count(*) OVER (PARTITION BY source) AS n, count(*) OVER () AS total FROM c),
p AS (SELECT *, row_number() OVER (ORDER BY CAST(2 * pos - 1 AS DOUBLE) / CAST(2 * n AS DOUBLE), h, doc_id NULLS FIRST, size, text_crc32, source NULLS FIRST, r) - 1 AS number FROM f)
SELECT doc_id, source, size, text_crc32, 'rows' AS law, CAST(number * 40 // total AS INTEGER) AS shard,
       number - ((number * 40 // total) * total + 39) // 40 AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM p
"""

COLLOCATIONS = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM d),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, range(1, 6) AS s(k))),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase HAVING count(*) >= 100),
c AS (SELECT lang, phrase, f AS a, k, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
inner_ AS (SELECT DISTINCT c.lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, a FROM c, range(2, 5) AS s(m), range(1, 5) AS t(i) WHERE m < k AND i + m - 1 <= k),
free AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM inner_ x WHERE x.lang = c.lang AND x.phrase = c.phrase AND x.a >= c.a)),
cut AS (SELECT free.lang, free.phrase, a, j, l.f AS l, r.f AS r, n, CAST(1000 * CAST(a AS HUGEINT) * n // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
        FROM free JOIN range(1, 5) AS s(j) ON j < free.k JOIN n USING (lang)
        JOIN f l ON l.lang = free.lang AND l.phrase = array_to_string(w[1:j], ' ') JOIN f r ON r.lang = free.lang AND r.phrase = array_to_string(w[j + 1:free.k], ' ')),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM best QUALIFY rank <= 2000
"""

JACCARD = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id,
       {_WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
s AS (SELECT DISTINCT r, array_to_string(w[i:i + 3], ' ') AS s FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 2, CASE WHEN len(w) > 0 THEN 2 ELSE 1 END))) AS i FROM d)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.r < b.r GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.r = x JOIN n b ON b.r = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
cc(r, root) USING KEY (r) AS (
  SELECT r, doc_id FROM d
  UNION
  SELECT e.y, min(cc.root) FROM cc JOIN e ON e.x = cc.r JOIN recurring.cc AS old ON old.r = e.y WHERE cc.root < old.root GROUP BY e.y)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, cc.root AS component_id FROM d JOIN cc USING (r) LEFT JOIN n USING (r)
"""

BYTES = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
g AS (SELECT r, i, md5_number(h[2 * i + 1:2 * i + 800]) AS g FROM (SELECT r, h, unnest(range(0, n - 399)) AS i FROM d)),
twice AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY g) > 1),
cut AS (SELECT r, i, coalesce(i - lag(i) OVER (PARTITION BY r ORDER BY i) > 400, true) AS new FROM twice),
part AS (SELECT r, i, sum(CAST(new AS INTEGER)) OVER (PARTITION BY r ORDER BY i) AS k FROM cut),
span AS (SELECT r, k, min(i) AS a, max(i) + 400 AS z FROM part GROUP BY r, k),
gone AS (SELECT r, CAST(count(*) AS BIGINT) AS n_spans, CAST(sum(z - a) AS BIGINT) AS n_removed FROM span GROUP BY r),
left_ AS (SELECT d.r, string_agg(h[2 * a + 1:2 * z], '' ORDER BY a) AS h FROM d JOIN (
            SELECT r, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS a, a AS z FROM span
            UNION ALL SELECT r, max(z), 1000000000000 FROM span GROUP BY r) x USING (r) GROUP BY d.r)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN n_spans IS NULL THEN d.h ELSE coalesce(left_.h, '') END)) AS kept_sha256
FROM d LEFT JOIN gone USING (r) LEFT JOIN left_ USING (r)
"""

ORACLE = {"op1_lines": LINES, "op2_debruijn": DEBRUIJN, "op3_topk": TOPK, "op4_chat": CHAT, "op8_jaccard": JACCARD, "op9_pfp": BYTES,
          "op11_interleave": INTERLEAVE, "op13_collocations": COLLOCATIONS}
