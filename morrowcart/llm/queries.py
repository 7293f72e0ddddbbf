"""The registered queries of the training-data operators, each over its whole
table with production parameters, and the DuckDB SQL of those SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import conversation_repair, decontam, embedding_dedup, jaccard_join, language_id, line_chunks, maxent_lm, mixing, preference, quality, url_filter, vector_codes, warc
from .common import stored, table


def _remainder(n: int):
    return F.crc32(F.col("doc_id").cast("string")) % n


def op1_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(F.col("doc_id").isNotNull() & (_remainder(3) != 1)).select("lang", "text"))
    return language_id.predict(docs, model).select(
        "doc_id", F.coalesce(_remainder(3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op2_url_filter(spark, sf_dir):
    return url_filter.url_filter(table(spark, sf_dir, "pages"))


def op3_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_quality(spark, sf_dir):
    got = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), _remainder(5) != 0)
    return got.select("doc_id", F.coalesce(_remainder(5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op5_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_classes(table(spark, sf_dir, "documents"))


def op6_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"), labels=table(spark, sf_dir, "labels"))


def op7_line_dedup(spark, sf_dir):
    return line_chunks.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "removed_chunks", "removed_bytes")


def op8_warc(spark, sf_dir):
    return warc.archive_pages(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_preference(spark, sf_dir):
    return preference.format_pairs(*preference.stale_reply_pairs(table(spark, sf_dir, "conversations")))


def op10_decontamination(spark, sf_dir):
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_vector_codes(spark, sf_dir):
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op12_conversation_repair(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations")
    rows = conversation_repair.damaged(conversations)
    plans = stored(conversation_repair.repair_plans(rows, known=conversations), "repair-plans")
    return conversation_repair.repaired_digests(rows, plans)


def op13_maxent_lm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = maxent_lm.fit(docs.where(F.col("doc_id").isNotNull() & (_remainder(7) != 2)))
    return maxent_lm.score(docs.select("doc_id", F.coalesce(_remainder(7) == 2, F.lit(False)).alias("held_out"), "text"), model)


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_url_filter, op3_embedding_dedup, op4_quality, op5_jaccard_join, op6_mixing, op7_line_dedup, op8_warc, op9_preference, op10_decontamination,
    op11_vector_codes, op12_conversation_repair, op13_maxent_lm)}

_UPPER, _LOWER = url_filter._UPPER, url_filter._LOWER


def _url_sql() -> str:
    """The template tree level by level, as in `url_filter`."""
    ctes = [f"""parsed AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages)""",
            "rules(what, rule) AS (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in url_filter.RULES) + ")",
            """fits AS (
  SELECT host, path, max_by(rule, length(rule)) AS rule, max_by(what, length(rule)) AS rule_verdict
  FROM (SELECT DISTINCT host, path FROM parsed) p JOIN rules r
    ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1))) AND starts_with(path, substr(rule, strpos(rule, '/')))
  GROUP BY host, path)""",
            "seg AS (SELECT p.*, rule, rule_verdict, list_filter(string_split(p.path, '/'), lambda s: s <> '') AS s FROM parsed p LEFT JOIN fits f ON p.host = f.host AND p.path = f.path)"]
    depth = url_filter.DEPTH

    def general(x):
        stem, ext = (f"regexp_extract({x}, '(?s)^(.*?)(\\.[A-Za-z]{{1,5}})?$', {k})" for k in (1, 2))
        return (f"(CASE WHEN regexp_matches({stem}, '^[0-9]+$') THEN '<n>' WHEN regexp_matches({stem}, '^[0-9a-fA-F-]{{8,}}$') THEN '<h>' "
                f"WHEN regexp_matches({stem}, '[0-9]') THEN '<m>' ELSE {stem} END) || {ext}")

    def shape(x):
        return f"(CASE WHEN {x} = '' OR regexp_matches({x}, '^<[nhm]>') THEN {x} ELSE 'w' || regexp_extract({x}, '(\\.[A-Za-z]{{1,5}})$', 1) END)"

    segments = ", ".join(f"{general(f's0[{i}]')} AS g{i}" for i in range(1, depth + 1))
    ctes.append(f"""rows AS (SELECT page_id, host, path, rule, rule_verdict, {segments}, coalesce(array_to_string(list_transform(s[{depth + 1}:], lambda x: {general("x")}), '/'), '') AS tail
  FROM (SELECT *, list_concat(s, ['' for _ in range({depth})]) AS s0 FROM seg))""")
    gs = ", ".join(f"g{i}" for i in range(1, depth + 1))
    ctes.append(f"tree0 AS (SELECT host, {gs}, tail, count(*) AS n, count(rule) AS labelled, count(*) FILTER (rule_verdict = 'block') AS blocked FROM rows GROUP BY host, {gs}, tail)")
    prefix = ["host"]
    on = lambda a, b, ks: " AND ".join(f"{a}.{k} = {b}.{k}" for k in ks)
    for i in range(1, depth + 1):
        p, lit = ", ".join(prefix), f"NOT regexp_matches(g{i}, '^<[nhm]>') AND g{i} <> ''"
        rest = [f"nullif({shape(f'g{k}')}, '')" for k in range(i, depth + 1)]
        rest.append(f"nullif(array_to_string(list_transform(string_split(tail, '/'), lambda x: {shape('x')}), '/'), '')")
        ctes.append(f"shapes{i} AS (SELECT {p}, g{i}, concat_ws('/', {', '.join(rest)}) AS shape, sum(n) AS n, sum(labelled) AS l, sum(blocked) AS b FROM tree{i - 1} GROUP BY ALL)")
        ctes.append(f"""branch{i} AS (SELECT {p}, g{i}, sum(n) OVER w AS bn, sum(l) OVER w AS bl, sum(b) OVER w AS bb, shape, n, l, b,
  first_value(shape) OVER (PARTITION BY {p}, g{i} ORDER BY n DESC, shape DESC) AS pool FROM shapes{i} WHERE {lit} WINDOW w AS (PARTITION BY {p}, g{i}))""")
        ctes.append(f"""pool{i} AS (SELECT *, sum(n) OVER (PARTITION BY {p}, pool, shape) AS pn, sum(n) OVER q AS pt, sum(l) OVER q AS pl, sum(b) OVER q AS pb
  FROM branch{i} WINDOW q AS (PARTITION BY {p}, pool))""")
        ctes.append(f"several{i} AS (SELECT {p}, pool, count(DISTINCT g{i}) AS branches FROM branch{i} GROUP BY {p}, pool)")
        ctes.append(f"""alike{i} AS (SELECT {', '.join('x.' + k for k in prefix)}, x.g{i}, x.pool, round(sum(least(n::DOUBLE / bn::DOUBLE, pn::DOUBLE / pt::DOUBLE)), 9) AS shared, max(branches) AS branches,
  max(bl) AS bl, max(abs(bb::DOUBLE / nullif(bl, 0)::DOUBLE - pb::DOUBLE / nullif(pl, 0)::DOUBLE)) AS apart
  FROM pool{i} x JOIN several{i} y ON {on('x', 'y', [*prefix, 'pool'])} GROUP BY ALL)""")
        ctes.append(f"""named{i} AS (SELECT {p}, g{i}, CASE WHEN branches > 1 AND shared >= {url_filter.ALIKE} AND (bl = 0 OR apart <= {url_filter.APART}::DOUBLE) THEN '*[' || pool || ']' ELSE g{i} END AS t{i}
  FROM alike{i} UNION ALL SELECT DISTINCT {p}, g{i}, g{i} FROM shapes{i} WHERE NOT ({lit}))""")
        ctes.append(f"tree{i} AS (SELECT t.*, b.t{i} FROM tree{i - 1} t JOIN named{i} b ON {on('t', 'b', [*prefix, f'g{i}'])})")
        prefix.append(f"t{i}")
    key = ", ".join([*prefix, "tail"])
    ctes.append(f"purity AS (SELECT {key}, (sum(blocked) + 1)::DOUBLE / (sum(labelled) + 2)::DOUBLE AS purity, sum(labelled) >= {url_filter.EVIDENCE} * sum(n) AS known FROM tree{depth} GROUP BY {key})")
    ts = ", ".join(f"nullif(t.t{i}, '')" for i in range(1, depth + 1))
    ctes.append(f"judged AS (SELECT t.*, purity, known, '/' || concat_ws('/', {ts}, nullif(t.tail, '')) AS template FROM tree{depth} t JOIN purity p ON {' AND '.join(f't.{k} = p.{k}' for k in [*prefix, 'tail'])})")
    joined = " AND ".join(f"r.{k} = j.{k}" for k in ["host", *[f"g{i}" for i in range(1, depth + 1)], "tail"])
    return "WITH " + ",\n".join(ctes) + f"""
SELECT page_id, r.host, path, rule, coalesce(rule_verdict, CASE WHEN purity >= {url_filter.REJECT} AND known THEN 'block' ELSE 'allow' END) AS verdict, template, purity
FROM rows r JOIN judged j ON {joined}"""


_EMBEDDING_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(e) > 0
       AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
         WHERE list_cosine_similarity(a.e, b.e) >= {embedding_dedup.COSINE}),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
low AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
deg AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT v.vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(least(m, v.vec_id), v.vec_id) AS component_id,
       coalesce(least(m, v.vec_id), v.vec_id) = v.vec_id AS kept
FROM v LEFT JOIN low ON low.a = v.vec_id LEFT JOIN deg ON deg.a = v.vec_id"""

_JACCARD_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
      ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM w),
u AS (SELECT doc_id, unnest(s) AS g FROM s),
rare AS (SELECT g FROM u GROUP BY g HAVING count(*) > 1),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM u a JOIN u b ON a.g = b.g AND a.doc_id <> b.doc_id WHERE a.g IN (FROM rare) GROUP BY ALL),
link AS (SELECT a, b FROM both_ JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * i >= {jaccard_join.PERCENT} * (len(x.s) + len(y.s) - i)),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
low AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, coalesce(least(m, doc_id), doc_id) AS component_id FROM s LEFT JOIN low ON low.a = doc_id"""

_MIX_SQL = f"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
q AS (SELECT doc_id, max(quality) AS q FROM labels GROUP BY doc_id),
k AS (SELECT d.*, -ln((('0x' || substr(md5('{mixing.SEED}|' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5::DOUBLE) / {1 << 52}::DOUBLE)
        / (CASE q.q {' '.join(f'WHEN {a} THEN {b}' for a, b in mixing.QUALITY.items())} ELSE 1.0 END)::DOUBLE AS key
      FROM d LEFT JOIN q ON q.doc_id = d.doc_id),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [{', '.join(map(str, mixing.WEIGHTS))}][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)}) + 1] AS weight FROM s),
f AS (SELECT *, {mixing.EPOCHS} * source_size AS stop,
        (sum(source_size) OVER ()) - coalesce(sum({mixing.EPOCHS} * source_size) OVER b, 0) AS words_left, (sum(weight) OVER ()) - coalesce(sum(weight) OVER b, 0) AS weight_left
      FROM w WINDOW b AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, stop * weight_left <= weight * words_left AS bound FROM f),
l AS (SELECT sum(source_size) - coalesce(sum(stop) FILTER (bound), 0) AS words_left, sum(weight) FILTER (NOT bound) AS weight_left FROM g),
t AS (SELECT source, source_size, CASE WHEN bound THEN stop::DOUBLE ELSE (weight * l.words_left)::DOUBLE / l.weight_left::DOUBLE END AS target FROM g, l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
r AS (SELECT k.*, source_size, target, whole, floor(target)::BIGINT - whole * source_size AS rest,
        coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, source, size, source_size, target, (whole * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM r"""

_WARC_SQL = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, max(page_id) AS first FROM p WHERE payload_bytes >= {warc.MIN_PAYLOAD} GROUP BY payload_digest)
SELECT page_id, payload_bytes, p.payload_digest, CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND payload_bytes >= {warc.MIN_PAYLOAD}"""

_PREFERENCE_SQL = f"""
WITH c AS (SELECT conv_id AS pair_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
e AS (SELECT pair_id, arg_min(text, turn) AS stale, min(turn) AS first, max(turn) AS last FROM c WHERE role = '{preference.TRAINED}' GROUP BY pair_id),
r AS (SELECT c.pair_id, turn, role, CASE WHEN role = '{preference.TRAINED}' AND turn = last THEN stale ELSE text END AS text
      FROM c LEFT JOIN e ON c.pair_id = e.pair_id WHERE NOT coalesce(role = '{preference.TRAINED}' AND turn = last AND first = last, false)),
a AS (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY turn NULLS FIRST, role, text) AS i FROM c),
b AS (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY turn NULLS FIRST, role, text) AS i FROM r),
n AS (SELECT pair_id, max(i) AS n FROM a GROUP BY pair_id),
m AS (SELECT pair_id, max(i) AS n FROM b GROUP BY pair_id),
d AS (SELECT a.pair_id, min(a.i) AS i FROM a JOIN b ON a.pair_id = b.pair_id AND a.i = b.i WHERE a.role <> b.role OR a.text <> b.text GROUP BY a.pair_id),
p AS (SELECT n.pair_id, n.n AS na, coalesce(m.n, 0) AS nb, coalesce(d.i - 1, least(n.n, coalesce(m.n, 0))) AS k FROM n LEFT JOIN m ON n.pair_id = m.pair_id LEFT JOIN d ON n.pair_id = d.pair_id),
x AS (SELECT 'a' AS side, a.pair_id, i, role, i > k AS own, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS out FROM a JOIN p ON a.pair_id = p.pair_id
      UNION ALL SELECT 'b', b.pair_id, i, role, i > k, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) FROM b JOIN p ON b.pair_id = p.pair_id),
y AS (SELECT *, sum(length(out)) FILTER (own) OVER (PARTITION BY side, pair_id ORDER BY i) AS stop FROM x),
z AS (SELECT pair_id, coalesce(string_agg(out, '' ORDER BY i) FILTER (side = 'a' AND NOT own), '') AS prompt,
        coalesce(string_agg(out, '' ORDER BY i) FILTER (side = 'a' AND own), '') AS chosen, coalesce(string_agg(out, '' ORDER BY i) FILTER (side = 'b' AND own), '') AS rejected,
        coalesce(string_agg((stop - length(out) + length(role) + 5)::BIGINT || '-' || stop::BIGINT, ';' ORDER BY i) FILTER (side = 'a' AND own AND role = '{preference.TRAINED}'), '') AS chosen_mask,
        coalesce(string_agg((stop - length(out) + length(role) + 5)::BIGINT || '-' || stop::BIGINT, ';' ORDER BY i) FILTER (side = 'b' AND own AND role = '{preference.TRAINED}'), '') AS rejected_mask
      FROM y GROUP BY pair_id)
SELECT z.pair_id, prompt, chosen, rejected, chosen_mask, rejected_mask, k::INTEGER AS prefix_turns, (na - k)::INTEGER AS chosen_turns, (nb - k)::INTEGER AS rejected_turns
FROM z JOIN p ON z.pair_id = p.pair_id"""

def _codes_sql() -> str:
    """Every round written out: all parts against all entries."""
    parts, distance = vector_codes.PARTS, "list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - e[i]) * (x[i] - e[i])))"
    ctes = [f"""k AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS r, list_transform(embedding, lambda x: floor(x::DOUBLE * {vector_codes.SCALE})::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
            f"p AS MATERIALIZED (SELECT r, part, v[part * (len(v) // {parts}) + 1 : (part + 1) * (len(v) // {parts})] AS x FROM k, range({parts}) t(part))",
            f"b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, x AS e FROM p WHERE r <= {vector_codes.ENTRIES})"]
    for i in range(vector_codes.ROUNDS + 1):
        ctes.append(f"a{i} AS MATERIALIZED (SELECT part, r, x, min({{'d': {distance}, 'entry': entry}}) AS m FROM p JOIN b{i} USING (part) GROUP BY part, r, x)")
        if i < vector_codes.ROUNDS:
            ctes.append(f"""b{i + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(n.e, b.e) AS e FROM b{i} b LEFT JOIN (
    SELECT part, entry, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY pos) AS e
    FROM (SELECT part, m.entry AS entry, pos, sum(x[pos]) AS s, count(*) AS n FROM a{i}, range(1, 1 + (SELECT max(len(x)) FROM p)) t(pos) GROUP BY ALL) GROUP BY part, entry) n
  ON n.part = b.part AND n.entry = b.entry)""")
    last = vector_codes.ROUNDS
    return "WITH " + ",\n".join(ctes) + f"""
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) FROM b{last}) AS codebooks_sha256
FROM k JOIN (SELECT r, string_agg(printf('%02x', m.entry), '' ORDER BY part) AS code, sum(m.d)::BIGINT AS error FROM a{last} GROUP BY r) USING (r)"""


_CRC = ("xor(list_reduce(list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT), "
        "lambda a, c: list_reduce(range(8), lambda x, y: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END), xor(a, c)), 4294967295::BIGINT), 4294967295::BIGINT)")

_REPAIR_SQL = f"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC} % 20 AS kind FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
      FROM k, range(2) t(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, {conversation_repair.HEAD}), sha256(text)) AS rn FROM d),
f AS MATERIALIZED (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) > 1 THEN 'd'
             WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE 'k' END AS fault,
             left(role, 1) AS c, left(role, 1) || lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY rn) AS pair FROM r),
best AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS q, {{'cost': 0::BIGINT, 'audit': '', 'text': ''}} AS v FROM f
  UNION ALL
  SELECT f.conv_id, f.rn, o.q, min({{'cost': b.cost + o.cost + CASE WHEN f.fault = 't' AND o.edit <> 'D' THEN {conversation_repair.CUT} ELSE 0 END, 'audit': b.audit || o.edit,
         'text': b.text || CASE o.edit WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || f.role || ':' || f.text ELSE chr(10) || CASE o.q WHEN 2 THEN 'user:' ELSE 'assistant:' END || f.text END}})
  FROM (SELECT conv_id, i, CASE WHEN n = 0 THEN q WHEN q = 2 THEN 3 ELSE 2 END AS q, v.cost + n * {conversation_repair.INSERT} AS cost, v.audit || repeat('I', n) AS audit,
               v.text || CASE WHEN n = 0 THEN '' WHEN q = 2 THEN chr(10) || 'assistant:' ELSE chr(10) || 'user:' END AS text
        FROM best, (VALUES (0), (1)) t(n)) b
  JOIN f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.rn = b.i + 1
  JOIN (VALUES (0, 'K', 's', 0, 1), (0, 'K', 'u', 0, 2), (1, 'K', 'u', 0, 2), (3, 'K', 'u', 0, 2), (2, 'K', 'a', 0, 3),
               (0, 'R', '', 2, 2), (1, 'R', '', 2, 2), (3, 'R', '', 2, 2), (2, 'R', '', 2, 3),
               (0, 'D', '', 3, 0), (1, 'D', '', 3, 1), (2, 'D', '', 3, 2), (3, 'D', '', 3, 3)) o(p, edit, c, cost, q)
    ON o.p = b.q AND (o.edit <> 'K' OR o.c = f.c) AND (o.edit = 'D' OR f.fault NOT IN ('b', 'd'))
  GROUP BY f.conv_id, f.rn, o.q),
ends AS (SELECT conv_id, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
                count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(rn) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps FROM f GROUP BY conv_id),
goal AS (SELECT e.conv_id, min(CASE WHEN q = 2 THEN {{'cost': v.cost + 2, 'audit': v.audit || 'I', 'text': v.text || chr(10) || 'assistant:'}} ELSE v END) AS v
         FROM ends e JOIN best b ON e.conv_id IS NOT DISTINCT FROM b.conv_id AND b.i = e.n WHERE q IN (0, 2, 3) GROUP BY e.conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(v.cost, 0)::BIGINT AS cost, coalesce(v.audit, '') AS audit, sha256(substr(coalesce(v.text, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN goal g ON g.conv_id IS NOT DISTINCT FROM c.conv_id"""

ORACLE_SQL = {"op2_url_filter": _url_sql(), "op3_embedding_dedup": _EMBEDDING_SQL, "op5_jaccard_join": _JACCARD_SQL,
              "op6_mixing": _MIX_SQL, "op8_warc": _WARC_SQL, "op9_preference": _PREFERENCE_SQL,
              "op11_vector_codes": _codes_sql(), "op12_conversation_repair": _REPAIR_SQL}
