"""DuckDB SQL for the registered queries that SQL can express."""

OP1 = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.rid, q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.rid <> c.rid AND len(q.e) = len(c.e)
  WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS k FROM s
)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= 20
"""

OP2 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), lines AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid
), windows AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT rid, w, unnest(generate_series(1, len(w) - 2)) AS i FROM d WHERE len(w) >= 3)
), repeated AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT rid, count(DISTINCT i + k) AS n_repeat_words
  FROM repeated, (SELECT unnest([0, 1, 2]) AS k) GROUP BY rid
), m AS (
  SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         len(list_filter(w, lambda x: length(x) > 1 AND regexp_matches(x, '[\p{Lu}\p{Lt}]') AND NOT regexp_matches(x, '[\p{Ll}\p{Lt}]'))) AS n_upper_words,
         len(list_distinct(w)) AS n_distinct_words
  FROM d LEFT JOIN lines USING (rid) LEFT JOIN covered USING (rid)
), b AS (
  SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
         CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
         CAST(n_repeat_words AS BIGINT) AS n_repeat_words, CAST(n_upper_words AS BIGINT) AS n_upper_words,
         CAST(n_distinct_words AS BIGINT) AS n_distinct_words,
         CAST(CASE WHEN n_words < 50 THEN 1 ELSE 0 END
         + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
         + CASE WHEN 100 * n_symbols > 10 * n_words THEN 4 ELSE 0 END
         + CASE WHEN n_dup_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END
         + CASE WHEN 100 * n_upper_words > 30 * n_words THEN 16 ELSE 0 END
         + CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 32 ELSE 0 END
         + CASE WHEN n_words >= 50 AND 100 * n_distinct_words < 5 * n_words THEN 64 ELSE 0 END AS BIGINT) AS fail_bits
  FROM m
)
SELECT *, (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept FROM b
"""

# H(x) is sha256 of concatenated text; a node's siblings are the others of its run of eight.
OP11 = """
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, CAST(doc_id AS BIGINT) AS doc_id, lang,
         concat_ws('', coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-'),
                   coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
                   coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-')) AS fields,
         coalesce(strlen(text) || ':' || text, '-') AS text,
         coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS lower_text,
         xor(4294967295, list_reduce(
           list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
           lambda crc, c: list_reduce(
             list_concat([xor(crc, c)], CAST(range(8) AS BIGINT[])),
             lambda v, bit: xor(v >> 1, 3988292384 * (v & 1))))) AS crc
  FROM documents
), leaf AS (
  SELECT rid, doc_id, lang, sha256(fields || text) AS leaf,
         CASE WHEN crc % 3 = 0 THEN sha256(fields || lower_text) ELSE sha256(fields || text) END AS found
  FROM d
), placed AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS tree, count(*) OVER (PARTITION BY lang) AS n,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM leaf
), nodes AS (
  SELECT CAST(tree AS BIGINT) AS tree, 0 AS lvl, CAST(pos AS BIGINT) AS pos, leaf AS digest, CAST(n AS BIGINT) AS n FROM placed
  UNION ALL
  SELECT tree, lvl + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (n + 7) // 8
  FROM nodes WHERE n > 1 GROUP BY tree, lvl, n, pos // 8
), subroots AS (
  SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
), upper_nodes AS (
  SELECT 0 AS lvl, CAST(pos AS BIGINT) AS pos, digest, CAST(n AS BIGINT) AS n FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (n + 7) // 8
  FROM upper_nodes WHERE n > 1 GROUP BY lvl, n, pos // 8
), beside AS (
  SELECT tree, lvl, pos,
         coalesce(string_agg(other, '' ORDER BY other_pos) FILTER (other_pos < pos), '') AS b,
         coalesce(string_agg(other, '' ORDER BY other_pos) FILTER (other_pos > pos), '') AS a
  FROM (SELECT x.tree, x.lvl, x.pos, y.pos AS other_pos, y.digest AS other
        FROM nodes x JOIN nodes y ON x.tree = y.tree AND x.lvl = y.lvl AND x.pos // 8 = y.pos // 8 WHERE x.n > 1)
  GROUP BY tree, lvl, pos
), upper_beside AS (
  SELECT lvl, pos, coalesce(string_agg(other, '' ORDER BY other_pos) FILTER (other_pos < pos), '') AS b,
         coalesce(string_agg(other, '' ORDER BY other_pos) FILTER (other_pos > pos), '') AS a
  FROM (SELECT x.lvl, x.pos, y.pos AS other_pos, y.digest AS other
        FROM upper_nodes x JOIN upper_nodes y ON x.lvl = y.lvl AND x.pos // 8 = y.pos // 8 WHERE x.n > 1)
  GROUP BY lvl, pos
), steps AS (
  SELECT p.rid, s.lvl, s.b, s.a
  FROM placed p JOIN beside s ON s.tree = p.tree AND s.pos = p.pos // CAST(pow(8, s.lvl) AS BIGINT)
  UNION ALL
  SELECT p.rid, 100 + s.lvl, s.b, s.a
  FROM placed p JOIN subroots r ON r.tree = p.tree JOIN upper_beside s ON s.pos = r.pos // CAST(pow(8, s.lvl) AS BIGINT)
), path AS (
  SELECT rid, list({'b': b, 'a': a} ORDER BY lvl) AS path, string_agg(b || a, '' ORDER BY lvl) AS siblings FROM steps GROUP BY rid
), folded AS (
  SELECT p.*, r.digest AS subroot, (SELECT digest FROM upper_nodes WHERE n = 1) AS root, sha256(coalesce(siblings, '')) AS proof_sha256,
         list_reduce(list_concat([{'b': found, 'a': ''}], coalesce(path, [])), lambda x, s: {'b': sha256(s.b || x.b || s.a), 'a': ''}).b AS folded_root,
         coalesce(len(path), 0) AS n_levels,
         (SELECT coalesce(sum(c), 0) FROM (SELECT tree AS t, count(*) AS c FROM placed GROUP BY tree) WHERE t < p.tree) + p.pos AS leaf_rank
  FROM placed p JOIN subroots r USING (tree) LEFT JOIN path USING (rid)
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, CAST(leaf_rank AS BIGINT) AS leaf_rank,
       CAST(n_levels AS INTEGER) AS n_levels, folded_root = root AS verified
FROM folded
"""


def op13(rounds: int = 10, clusters: int = 8) -> str:
    """Lloyd's rounds, one pair of common table expressions for each."""
    parts = [f"""
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST) - 1 AS k, e
  FROM v ORDER BY sha256('3:' || vec_id) NULLS LAST LIMIT {clusters}
)"""]
    for r in range(rounds + 1):
        parts.append(f""", a{r} AS MATERIALIZED (
  SELECT rid, k, d FROM (
    SELECT *, row_number() OVER (PARTITION BY rid ORDER BY d, k) AS place FROM (
      SELECT v.rid, c.k, list_sum(list_transform(range(1, 65), lambda i: (v.e[i] - c.e[i]) * (v.e[i] - c.e[i]))) AS d FROM v, c{r} c))
  WHERE place = 1
)""")
        if r < rounds:
            parts.append(f""", c{r + 1} AS MATERIALIZED (
  SELECT c.k, coalesce(m.e, c.e) AS e FROM c{r} c LEFT JOIN (
    SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS e FROM (
      SELECT k, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
      FROM (SELECT a.k, unnest(v.e) AS x, unnest(range(64)) AS i FROM a{r} a JOIN v USING (rid)) GROUP BY k, i) GROUP BY k) m USING (k)
)""")
    parts.append(f"""
SELECT v.vec_id, CAST(a.k AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM a{rounds} a JOIN v USING (rid) JOIN c{rounds} c USING (k)
""")
    return "".join(parts)


OP12 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, CAST(doc_id AS BIGINT) AS doc_id, coalesce(text, '') AS t FROM documents
), o AS (
  SELECT *, coalesce(lead(t) OVER w, first_value(t) OVER w) AS next_t FROM d
  WINDOW w AS (ORDER BY doc_id DESC NULLS LAST, md5(t) ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
), e AS (
  SELECT *, left(t, length(t) - length(t) // 2) || left(next_t, length(t) // 2) AS edited FROM o
), texts AS (
  SELECT rid, 0 AS part, t AS x FROM e UNION ALL SELECT rid, 1, edited FROM e UNION ALL SELECT rid, 2, next_t FROM e
), words AS (
  SELECT rid, part, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS w FROM texts
), s AS (
  SELECT rid, part, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) ELSE list_sort(list_distinct(list_transform(
           range(1, greatest(len(w) - 4, 1) + 1), lambda i: substr(md5(array_to_string(w[i:i + 4], ' ')), 1, 16))))[1:128] END AS sketch
  FROM words
), m AS (
  SELECT e.rid, doc_id, t, edited, a.sketch AS a, b.sketch AS b, c.sketch AS c,
         list_sort(list_distinct(list_concat(a.sketch, b.sketch)))[1:128] AS ab,
         list_sort(list_distinct(list_concat(a.sketch, c.sketch)))[1:128] AS ac
  FROM e JOIN s a ON a.rid = e.rid AND a.part = 0 JOIN s b ON b.rid = e.rid AND b.part = 1 JOIN s c ON c.rid = e.rid AND c.part = 2
), f AS (
  SELECT *, CASE WHEN len(ab) = 0 THEN 1.0 ELSE len(list_intersect(ab, list_intersect(a, b))) / CAST(len(ab) AS DOUBLE) END AS near_edited,
         CASE WHEN len(ac) = 0 THEN 1.0 ELSE len(list_intersect(ac, list_intersect(a, c))) / CAST(len(ac) AS DOUBLE) END AS near_next,
         CASE WHEN len(a) < 128 THEN CAST(len(a) AS DOUBLE)
              ELSE CAST(127 AS DOUBLE) / (CAST(CAST('0x' || substr(a[128], 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0::DOUBLE) END AS n_a,
         CASE WHEN len(ab) < 128 THEN CAST(len(ab) AS DOUBLE)
              ELSE CAST(127 AS DOUBLE) / (CAST(CAST('0x' || substr(ab[128], 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0::DOUBLE) END AS n_ab
  FROM m
)
SELECT doc_id, length(t) AS n_chars, sha256(edited) AS edited_sha256, array_to_string(a, '') AS fingerprint,
       array_to_string(b, '') AS edited_fingerprint, CAST(near_edited AS DOUBLE) AS near_edited, CAST(near_next AS DOUBLE) AS near_next,
       n_a AS n_shingles, CASE WHEN len(a) = 0 THEN CAST(1 AS DOUBLE) ELSE least(CAST(1 AS DOUBLE), CAST(near_edited AS DOUBLE) * n_ab / n_a) END AS kept_share
FROM f
"""

# Every 50-byte window as 100 hex digits; bytes go where the window also starts in a document with a smaller id.
OP4 = """
WITH d AS (
  SELECT row_number() OVER () AS rid, CAST(doc_id AS BIGINT) AS doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents
), w AS (
  SELECT rid, doc_id, p, substr(h, 2 * p + 1, 100) AS bytes
  FROM (SELECT rid, doc_id, h, unnest(range(len(h) // 2 - 49)) AS p FROM d WHERE len(h) >= 100)
), least AS (
  SELECT bytes, min(doc_id) AS owner FROM w GROUP BY bytes
), hits AS (
  SELECT rid, p, lag(p) OVER (PARTITION BY rid ORDER BY p) AS before FROM w JOIN least USING (bytes) WHERE owner < doc_id
), runs AS (
  SELECT rid, min(p) AS a, max(p) + 50 AS b FROM (
    SELECT rid, p, sum(CASE WHEN before IS NULL OR p > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY p) AS run FROM hits)
  GROUP BY rid, run
), left_over AS (
  SELECT d.rid, coalesce(lag(b) OVER (PARTITION BY d.rid ORDER BY a), 0) AS start, a AS stop, d.h FROM d JOIN runs ON runs.rid = d.rid
  UNION ALL
  SELECT d.rid, coalesce(max(b), 0), len(any_value(h)) // 2, any_value(h) FROM d LEFT JOIN runs ON runs.rid = d.rid GROUP BY d.rid
), kept AS (
  SELECT rid, string_agg(substr(h, 2 * start + 1, 2 * (stop - start)), '' ORDER BY start) AS h FROM left_over GROUP BY rid
)
SELECT d.doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, CAST((len(d.h) - len(kept.h)) // 2 AS BIGINT) AS n_removed,
       (SELECT count(*) FROM runs WHERE runs.rid = d.rid) AS n_spans, sha256(unhex(kept.h)) AS kept_sha256
FROM d JOIN kept ON kept.rid = d.rid
"""

OP5 = r"""
WITH RECURSIVE d AS (
  SELECT CAST(doc_id AS BIGINT) AS doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) ELSE list_distinct(list_transform(
           range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i:i + 3], ' '))) END AS shingles
  FROM d
), each AS (
  SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s
), links AS MATERIALIZED (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM each x JOIN each y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id AND 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n)
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), reached AS (
  SELECT doc_id AS a, doc_id AS b FROM s
  UNION
  SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, (SELECT min(b) FROM reached WHERE a = s.doc_id) AS component_id
FROM s
"""

# Highest quotients, listed; the seeded orders are MD5 of seed, id and the text's MD5.
OP6 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, CAST(doc_id AS BIGINT) AS doc_id, source, md5(coalesce(text, '')) AS digest,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST(greatest(ceil(count(*) / 2048), ceil(sum(size) / 2000000), 1) AS BIGINT) AS shards
  FROM d GROUP BY source
), weighed AS (
  SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS weight,
         CAST(source_size AS DOUBLE) * 2.0::DOUBLE AS full_size
  FROM src
), levels AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE
             - coalesce(sum(full_size) OVER (ORDER BY full_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY full_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
), aimed AS (
  SELECT source, source_size, shards, least(full_size, (SELECT max(level) FROM levels) * weight) AS target FROM levels
), seats AS (
  SELECT CAST(round(sum(target) / 16) AS BIGINT) AS n FROM aimed
), source_quota AS (
  SELECT source, count(*) AS blocks FROM (
    SELECT source, row_number() OVER (ORDER BY target / (2 * k - 1) DESC, source NULLS LAST) AS place
    FROM (SELECT source, target, unnest(range(1, CAST(ceil(target / 16) AS BIGINT) + 2)) AS k FROM aimed WHERE target > 0))
  WHERE place <= (SELECT n FROM seats) GROUP BY source
), placed AS (
  SELECT d.*, a.source_size, a.target,
         CAST('0x' || substr(md5(concat_ws(':', '20240601', CAST(doc_id AS VARCHAR), digest)), 1, 15) AS BIGINT) % a.shards AS shard
  FROM d JOIN aimed a ON d.source IS NOT DISTINCT FROM a.source
), cells AS (
  SELECT p.source, shard, CAST(sum(size) AS BIGINT) AS words, any_value(coalesce(q.blocks, 0)) AS blocks
  FROM placed p LEFT JOIN source_quota q ON p.source IS NOT DISTINCT FROM q.source GROUP BY p.source, shard
), cell_quota AS (
  SELECT source, shard, count(*) AS quota FROM (
    SELECT source, shard, blocks, row_number() OVER (PARTITION BY source ORDER BY words / (2 * k - 1) DESC, shard) AS place
    FROM (SELECT *, unnest(range(1, CAST(ceil(words * 2 / 16) AS BIGINT) + 2)) AS k FROM cells WHERE words > 0))
  WHERE place <= blocks GROUP BY source, shard
), takes AS (
  SELECT c.source, c.shard, words, least(coalesce(quota, 0) * 16, words * 2) AS takes
  FROM cells c LEFT JOIN cell_quota q ON c.source IS NOT DISTINCT FROM q.source AND c.shard = q.shard
), laid AS (
  SELECT p.*, t.words, t.takes, sum(size) OVER (
    PARTITION BY p.source, p.shard ORDER BY md5(concat_ws(':', '20240602', CAST(doc_id AS VARCHAR), digest)), doc_id, digest, size, rid) AS stop
  FROM placed p JOIN takes t ON p.source IS NOT DISTINCT FROM t.source AND p.shard = t.shard
)
SELECT doc_id, source, size, source_size, target,
       CAST(CASE WHEN words > 0 THEN (takes // words) * size + greatest(0, least(stop, takes % words) - (stop - size)) ELSE 0 END AS BIGINT) AS taken
FROM laid
"""

ORACLE: dict[str, str] = {"op1_metric_tree_top_k": OP1, "op2_rule_ledger": OP2, "op4_suffix_dedup": OP4, "op5_jaccard_join": OP5,
                          "op6_source_mix": OP6, "op11_merkle_manifest": OP11,
                          "op12_fingerprints": OP12, "op13_orchard_clusters": op13()}
