"""SQL that gives the same rows as the queries of this subpackage that SQL can express."""

from __future__ import annotations

_CRC_STEPS = ", ".join(
    f"t{k + 1} AS (SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END AS v FROM t{k})" for k in range(8)
)

SHARDING = f"""
WITH t0 AS (SELECT i, i::BIGINT AS v FROM range(256) r(i)), {_CRC_STEPS},
crc AS (SELECT list(v ORDER BY i) AS t FROM t8),
docs AS (SELECT doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS (
  SELECT doc_id, (octet_length(encode(text)) + 1)::BIGINT AS size,
         xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(h)::BIGINT, 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT)),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) AS text_crc32
  FROM docs, crc),
placed AS (
  SELECT *, sum(size) OVER w AS e, row_number() OVER w - 1 AS r, sum(size) OVER () AS total FROM sized
  WINDOW w AS (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING)),
cut AS (SELECT *, least(7, ((2 * e - size) * 8) // (2 * total))::INTEGER AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, r - min(r) OVER (PARTITION BY shard) AS slot, NULL::INTEGER AS grown_shard FROM cut
"""

EMBEDDINGS = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM good UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
low AS (SELECT a, min(b) AS c FROM reach GROUP BY a), n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, coalesce(low.c, vec_id) AS component_id, vec_id = coalesce(low.c, vec_id) AS kept
FROM embeddings LEFT JOIN low ON low.a = vec_id LEFT JOIN n ON n.a = vec_id
"""

_BROKEN = "replace({0}, chr(92), chr(92) || 'b')"
for _whole, _cut in (
    ("<|im_start|>", 1), ("<|im_end|>", 1), ("<s>", 1), ("</s>", 1), ("<<SYS>>", 1), ("<</SYS>>", 1), ("[INST]", 1), ("[/INST]", 1),
):
    _BROKEN = f"replace({_BROKEN}, '{_whole}', '{_whole[:_cut]}' || chr(92) || 'x{_whole[_cut:]}')"
_TOKENS = r"'\w+|[^\w\s]'"

CHAT = f"""
WITH base AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
shown AS (SELECT *, replace({_BROKEN.format("role")}, chr(10), chr(92) || 'n') AS r, {_BROKEN.format("text")} AS x FROM base),
tok AS (
  SELECT *, 10 + length(regexp_replace(r, {_TOKENS}, 'x', 'g')) - length(regexp_replace(r, {_TOKENS}, '', 'g'))
         + length(regexp_replace(x, {_TOKENS}, 'x', 'g')) - length(regexp_replace(x, {_TOKENS}, '', 'g')) AS tokens FROM shown),
seq AS (
  SELECT *, row_number() OVER w - 1 AS pos, sum(tokens) OVER w - tokens AS begun, sum((tokens > 448)::INT) OVER w AS wides,
         first_value(role) OVER w AS r0, first_value(turn) OVER w AS t0 FROM tok
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)),
sys AS (
  SELECT *, coalesce(max(tokens) FILTER (WHERE r0 = 'system' AND role = 'system' AND turn IS NOT DISTINCT FROM t0) OVER (PARTITION BY conv_id), 0) AS s FROM seq),
lined AS (
  SELECT *, greatest(0, begun - s) AS start, greatest(0, 2 * (wides - (s > 448)::INT) - (tokens > 448)::INT) AS step, greatest(1, 1344 - s) AS stride FROM sys),
cutd AS (SELECT *, {{'at': start // stride, 'step': step}} AS cut FROM lined),
win AS (
  SELECT conv_id AS c1, cut AS w1, lead(min(start)) OVER (PARTITION BY conv_id ORDER BY cut) AS nf, count(*) OVER (PARTITION BY conv_id) AS nw
  FROM cutd GROUP BY conv_id, cut),
each AS (
  SELECT s.*, 12 + length(r) + 1 + length(x) + 11 AS chars,
         CASE WHEN pos = 0 AND role = 'system' THEN nw WHEN nf - start <= 256 THEN 2 ELSE 1 END AS times
  FROM cutd s JOIN win ON c1 IS NOT DISTINCT FROM conv_id AND w1 = cut)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256, sum(chars * times)::BIGINT AS formatted_chars
FROM each GROUP BY conv_id
"""

FILL_IN_MIDDLE = """
WITH base AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
hashed AS (SELECT *, list_transform([1, 9, 17, 25], lambda k: ('0x' || substr(h, k, 8))::BIGINT) AS v FROM base),
chosen AS (
  SELECT doc_id, t, n, least(v[1] % (n + 1), v[2] % (n + 1)) AS a, greatest(v[1] % (n + 1), v[2] % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR v[3] % 100 >= 90 THEN 'plain'
              WHEN v[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM hashed),
parts AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM chosen)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""

_TERMS = (
    "unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))"
)

LEXICAL_SEARCH = f"""
WITH words AS (SELECT doc_id, {_TERMS} AS term FROM documents),
size AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
whole AS (SELECT count(*) AS nd, sum(n)::BIGINT AS al FROM size),
asked AS (SELECT DISTINCT item_id, {_TERMS} AS term FROM benchmark),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term),
weights AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, whole GROUP BY term, nd),
impact AS (SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // al)) AS i FROM tf JOIN size USING (doc_id), whole),
scored AS (
  SELECT item_id, doc_id, sum(w * i)::BIGINT AS score FROM asked JOIN weights USING (term) JOIN impact USING (term) GROUP BY item_id, doc_id HAVING sum(w * i) > 0),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 10
"""
