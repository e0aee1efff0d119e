"""SQL for DuckDB that says what a query must return, where SQL can say it on whole tables."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PLAIN = r"list_filter(string_split_regex({x}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"
#: From links (a, b), both ways, to the smallest id that each reaches.
REACH = "WITH RECURSIVE {links}, reach AS (SELECT a AS x, a AS y FROM link UNION SELECT r.x, l.b FROM reach r JOIN link l ON r.y = l.a), least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY 1)"

OP2 = """
WITH d AS (SELECT row_number() OVER () AS k, doc_id, encode(coalesce(text, '')) AS raw FROM documents),
n AS (SELECT k, doc_id, raw, octet_length(raw) AS n FROM d),
w AS (SELECT k, i, md5(array_slice(raw, i, i + 199)) AS h FROM n, unnest(range(1, n - 198)) AS t(i) WHERE n >= 200),
dup AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
hit AS (SELECT k, i FROM w WHERE h IN (SELECT h FROM dup)),
mark AS (SELECT k, i, CASE WHEN i <= max(i) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 200 THEN 0 ELSE 1 END AS new FROM hit),
grp AS (SELECT k, i, sum(new) OVER (PARTITION BY k ORDER BY i) AS g FROM mark),
span AS (SELECT k, g, min(i) AS lo, max(i) + 200 AS hi FROM grp GROUP BY 1, 2),
piece AS (SELECT k, coalesce(lag(hi) OVER (PARTITION BY k ORDER BY lo), 1) AS lo, lo - 1 AS hi FROM span
  UNION ALL SELECT n.k, coalesce(max(s.hi), 1), any_value(n.n) FROM n LEFT JOIN span s ON s.k = n.k GROUP BY n.k),
kept AS (SELECT p.k, coalesce(string_agg(CASE WHEN p.lo <= p.hi THEN hex(array_slice(n.raw, p.lo, p.hi)) ELSE '' END, '' ORDER BY p.lo, p.hi), '') AS x FROM piece p JOIN n ON n.k = p.k GROUP BY p.k),
cut AS (SELECT k, sum(hi - lo)::BIGINT AS n_removed, count(*)::BIGINT AS n_spans FROM span GROUP BY 1)
SELECT n.doc_id, n.n::BIGINT AS n_bytes, coalesce(cut.n_removed, 0)::BIGINT AS n_removed, coalesce(cut.n_spans, 0)::BIGINT AS n_spans, sha256(unhex(kept.x)) AS kept_sha256
FROM n LEFT JOIN cut ON cut.k = n.k JOIN kept ON kept.k = n.k"""

OP3 = rf"""
WITH dw AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS s FROM iw, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
occ AS (SELECT k, i, sizes.n, array_to_string(w[i:i + sizes.n - 1], ' ') AS s FROM dw, sizes, unnest(range(1, len(w) - sizes.n + 2)) AS t(i) WHERE len(w) >= sizes.n),
hit AS (SELECT occ.k, occ.i, occ.n, win.item_id FROM occ JOIN win ON occ.n = win.n AND occ.s = win.s),
word AS (SELECT k, count(DISTINCT j)::BIGINT AS n_hit FROM (SELECT DISTINCT k, i, n FROM hit), unnest(range(i, i + n)) AS t(j) GROUP BY 1),
item AS (SELECT k, count(*)::BIGINT AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT k, item_id::VARCHAR AS id FROM hit) GROUP BY 1),
out AS (SELECT dw.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, coalesce(ids, '') AS ids FROM dw LEFT JOIN word ON word.k = dw.k LEFT JOIN item ON item.k = dw.k)
SELECT doc_id, n_words, n_hit, n_items, sha256(ids) AS items_sha256, n_hit > 0 AND 20 * n_hit >= n_words AS contaminated FROM out"""

OP4 = REACH.format(links=f"""
dw AS (SELECT row_number() OVER () AS k, doc_id, {PLAIN.format(x=f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")} AS w FROM documents),
sh AS (SELECT DISTINCT k, md5(array_to_string(w[i:i + 3], chr(10))) AS s FROM dw, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS t(i) WHERE len(w) > 0),
n AS (SELECT k, count(*) AS n FROM sh GROUP BY 1),
inter AS (SELECT a.k AS a, b.k AS b, count(*) AS m FROM sh a JOIN sh b ON a.s = b.s AND a.k < b.k GROUP BY 1, 2),
near AS (SELECT a, b FROM inter JOIN n x ON x.k = a JOIN n y ON y.k = b WHERE 100 * m >= 80 * (x.n + y.n - m)),
link AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near)""").replace("least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY 1)", "least AS (SELECT x, min(doc_id) AS component_id FROM reach JOIN dw ON dw.k = y GROUP BY 1)") + """
SELECT dw.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(component_id, dw.doc_id) AS component_id, dw.doc_id = coalesce(component_id, dw.doc_id) AS kept
FROM dw LEFT JOIN n ON n.k = dw.k LEFT JOIN least ON least.x = dw.k"""

OP6 = REACH.format(links="""
v AS (SELECT row_number() OVER () AS k, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
good AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0),
near AS (SELECT a.k AS a, b.k AS b FROM good a JOIN good b ON a.label = b.label AND a.k < b.k AND len(a.e) = len(b.e) WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.93),
link AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near)""").replace("least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY 1)", "least AS (SELECT x, min(vec_id) AS component_id FROM reach JOIN v ON v.k = y GROUP BY 1)") + """
SELECT vec_id, coalesce(c.n, 0)::BIGINT AS n_links, coalesce(component_id, vec_id) AS component_id, vec_id = coalesce(component_id, vec_id) AS kept
FROM v LEFT JOIN (SELECT a, count(*) AS n FROM link GROUP BY 1) c ON c.a = v.k LEFT JOIN least ON least.x = v.k"""

OP8 = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {PLAIN.format(x="coalesce(text, '')")} AS w FROM documents),
win AS (SELECT k, doc_id, i, md5(array_to_string(w[i:i + 12], chr(10))) AS h FROM d, unnest(range(1, len(w) - 11)) AS t(i) WHERE len(w) >= 13),
first AS (SELECT h, min(doc_id) AS first FROM win GROUP BY 1),
bad AS (SELECT k, i FROM win JOIN first USING (h) WHERE first < doc_id),
word AS (SELECT d.k, t.i, w[t.i] AS word, b.i IS NOT NULL AS starts FROM d CROSS JOIN unnest(range(1, len(w) + 1)) AS t(i) LEFT JOIN bad b ON b.k = d.k AND b.i = t.i),
gone AS (SELECT k, i, word, bool_or(starts) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone FROM word),
agg AS (SELECT k, count(*) FILTER (gone)::BIGINT AS n_removed, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '') AS kept FROM gone GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN agg ON agg.k = d.k"""

_SAID = "(CASE WHEN {x} IS NULL THEN '' ELSE {x} END)"
_ESCAPED = "replace(replace({x}, '\\', '\\\\'), '<|', '<\\|')"
OP9 = f"""
WITH t AS (SELECT conv_id, turn, {_SAID.format(x='role')} AS r, {_SAID.format(x='text')} AS x FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY turn NULLS FIRST, r, x)) AS turns_sha256,
  coalesce(sum(length(x)) FILTER (r = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(x, '' ORDER BY turn NULLS FIRST, r, x) FILTER (r = 'assistant'), '')) AS loss_sha256,
  sum(24 + length(replace({_ESCAPED.format(x='r')}, chr(10), '\\n')) + length({_ESCAPED.format(x='x')}))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id"""

#: The unsigned CRC-32 of a text of digits, by a table that is made from its polynomial; `crc` must be in scope.
_CRC_TABLE = "crc AS (SELECT list(list_reduce(range(0, 8), lambda c, k: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t FROM range(0, 256) AS r(i))"
_CRC = "xor(list_reduce(list_transform(range(1, length({x}) + 1), lambda i: ascii(substr({x}, i::INT, 1))::BIGINT), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"
_DIMS = ("source", "lang", "length", "date")
OP11 = f"""
WITH {_CRC_TABLE},
v AS (SELECT row_number() OVER () AS k, doc_id, source, lang, coalesce(octet_length(encode(text)), -1) AS length, coalesce({_CRC.format(x='doc_id::VARCHAR')} % 365, -1) AS date FROM documents, crc),
c AS (SELECT k, doc_id, {', '.join(f"(8 * (rank() OVER (ORDER BY {d} NULLS FIRST) - 1)) // count(*) OVER () AS c{i}" for i, d in enumerate(_DIMS))} FROM v),
z AS (SELECT *, {' + '.join(f"((c{i} >> {b}) & 1) * {2 ** (4 * b + 3 - i)}" for b in (2, 1, 0) for i in range(4))} AS z FROM c),
p AS (SELECT *, row_number() OVER (ORDER BY z, doc_id NULLS FIRST, k) - 1 AS position FROM z),
f AS (SELECT *, position // {{file_rows}} AS file FROM p),
bound AS (SELECT file, {', '.join(f"{m}(c{i}) AS {n}{i}" for i in range(4) for n, m in (("lo", "min"), ("hi", "max")))} FROM f GROUP BY 1),
cell AS (SELECT DISTINCT z, c0, c1, c2, c3 FROM f),
touched AS (SELECT z, count(*) AS n FROM cell JOIN bound ON c0 BETWEEN lo0 AND hi0 AND c1 BETWEEN lo1 AND hi1 AND c2 BETWEEN lo2 - 1 AND hi2 + 1 AND c3 BETWEEN lo3 - 1 AND hi3 + 1 GROUP BY 1),
held AS (SELECT DISTINCT file, z, c0, c1, c2, c3 FROM f),
matching AS (SELECT a.z, count(DISTINCT b.file) AS n FROM cell a JOIN held b ON a.c0 = b.c0 AND a.c1 = b.c1 AND abs(a.c2 - b.c2) <= 1 AND abs(a.c3 - b.c3) <= 1 GROUP BY 1)
SELECT doc_id, f.z::BIGINT AS z, position::BIGINT AS position, f.file::BIGINT AS file, touched.n::BIGINT AS files_touched, matching.n::BIGINT AS files_matching,
  concat_ws(',', {', '.join(f"{n}{i}" for i in range(4) for n in ("lo", "hi"))}) AS file_bounds
FROM f JOIN bound ON bound.file = f.file JOIN touched ON touched.z = f.z JOIN matching ON matching.z = f.z"""

#: A SHA-1 in base32: each 20 bits are four characters.
_BASE32 = "array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr({hex}, (i // 4 * 5 + 1)::INT, 5))::BIGINT >> (15 - i % 4 * 5)::INT) & 31)::INT + 1, 1)), '')"
OP12 = f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS x, sha256(coalesce(html, '')) AS h FROM pages),
r AS (SELECT *, row_number() OVER w AS k, first_value(page_id) OVER w AS first FROM p WINDOW w AS (PARTITION BY h ORDER BY page_id NULLS LAST, url NULLS LAST)),
s AS (SELECT *, sha1(x) AS d FROM r)
SELECT page_id, octet_length(encode(x))::BIGINT AS payload_bytes, {_BASE32.format(hex='d')} AS payload_digest,
  CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN k > 1 THEN first END AS refers_to FROM s"""

SQL = {
    "op2_suffix_dedup": OP2,
    "op3_decontamination": OP3,
    "op4_minhash": OP4,
    "op6_embedding_dedup": OP6,
    "op8_substring_dedup": OP8,
    "op9_chat": OP9,
    "op11_cell_layout": OP11.format(file_rows=1000),
    "op12_warc": OP12,
}
