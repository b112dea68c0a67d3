"""DuckDB SQL of the queries that SQL can express."""

UPPER, LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"
PLAIN, SPACED = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'", r"'[^\x20\x09-\x0D]+'"

DECONTAMINATE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), {UPPER}, {LOWER}), {PLAIN}) AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, w, least(10, len(w)) AS n FROM (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {UPPER}, {LOWER}), {PLAIN}) AS w
        FROM benchmark WHERE item_id IS NOT NULL) WHERE len(w) > 0),
iw AS (SELECT DISTINCT item, n, array_to_string(w[k:k + n - 1], ' ') AS win
       FROM (SELECT item, n, w, unnest(range(1, len(w) - n + 2)) AS k FROM i)),
dw AS (SELECT r, k, n, array_to_string(w[k:k + n - 1], ' ') AS win
       FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM iw))),
h AS (SELECT r, k, dw.n, item FROM dw JOIN iw ON dw.win = iw.win AND dw.n = iw.n),
c AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS p FROM h) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)
"""

MIX_CTES = f"""
d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), {SPACED})) AS BIGINT) AS size,
             md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
s AS (SELECT source, sum(size) AS source_size, 2.0::DOUBLE * sum(size) AS lim,
             [3.0::DOUBLE, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
      FROM d GROUP BY source),
o AS (SELECT *, row_number() OVER (ORDER BY lim / w, source NULLS LAST) AS k FROM s),
f AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(lim) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate FROM o),
rate AS (SELECT arg_min(rate, k) AS rate FROM f WHERE w * rate <= lim),
goal AS (SELECT source, source_size, least(lim, w * coalesce((SELECT rate FROM rate), 'inf'::DOUBLE)) AS target FROM s),
p AS (SELECT d.*, CAST(g.source_size AS BIGINT) AS source_size, g.target,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lead
      FROM d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source)
"""

MIX = f"""
WITH {MIX_CTES}
SELECT doc_id, size, source_size, target,
       CAST(greatest(0, least(size, floor(target) - lead)) + greatest(0, least(size, floor(target) - lead - source_size)) AS BIGINT) AS taken
FROM p
"""

RULES = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, 'und') AS stratum, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), {SPACED}) AS w FROM documents),
k3 AS (SELECT r, k, w[k] AS a, w[k + 1] AS b, w[k + 2] AS c FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS k FROM d)),
twice AS (SELECT r, k FROM (SELECT r, k, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM k3) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([k, k + 1, k + 2]) AS p FROM twice) GROUP BY r),
lines AS (SELECT r, count(*) AS n, count(DISTINCT line) AS kinds FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, {SPACED}) GROUP BY r),
s AS (SELECT d.r, doc_id, stratum, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
             CAST(length(t) - length(translate(t, {UPPER}, '')) AS BIGINT) AS n_upper,
             CAST(coalesce(lines.n, 0) AS BIGINT) AS n_lines, CAST(coalesce(lines.n - lines.kinds, 0) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
      FROM d LEFT JOIN rep ON d.r = rep.r LEFT JOIN lines ON d.r = lines.r),
v AS (SELECT r, stratum, doc_id, unnest(['symbol_ratio', 'dup_line_ratio', 'repeat_ratio', 'upper_ratio']) AS rule,
             unnest([coalesce(n_symbols / nullif(word_chars, 0)::DOUBLE, 0), coalesce(n_dup_lines / nullif(n_lines, 0)::DOUBLE, 0),
                     coalesce(n_repeat_words / nullif(n_words, 0)::DOUBLE, 0), coalesce(n_upper / nullif(word_chars, 0)::DOUBLE, 0)]) AS x FROM s),
cut(rule, cutoff) AS (VALUES @CUTOFFS),
clean AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1),
cell AS (SELECT stratum, rule, cutoff, count(*) AS n, CAST(sum(CASE WHEN x > cutoff THEN 1 ELSE 0 END) AS BIGINT) AS k
         FROM v JOIN cut USING (rule) WHERE doc_id IN (SELECT doc_id FROM clean) GROUP BY ALL),
term AS (SELECT stratum, rule, cutoff, n, k, lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.0125) + (n - i) * ln(1 - 0.0125) AS l
         FROM (SELECT *, unnest(range(0, k + 1)) AS i FROM cell WHERE k < n * 0.0125)),
bound AS (SELECT stratum, rule, cutoff, max(l) + ln(sum(exp(l - top))) AS p
          FROM (SELECT *, max(l) OVER (PARTITION BY stratum, rule, cutoff) AS top FROM term) GROUP BY ALL),
lim AS (SELECT stratum, rule, min(cutoff) AS cutoff FROM bound WHERE p <= ln(0.05 / (SELECT count(*) FROM cell)) GROUP BY ALL),
bad AS (SELECT DISTINCT r FROM v JOIN lim USING (stratum, rule) WHERE x > lim.cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed AS base_failed,
       NOT failed AND r NOT IN (SELECT r FROM bad) AS kept
FROM (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS failed FROM s)
""".replace("@CUTOFFS", ", ".join(f"('{r}', {c}::DOUBLE)" for r, cs in {
    "symbol_ratio": (0.5, 0.3, 0.2, 0.1, 0.05), "dup_line_ratio": (0.7, 0.5, 0.4, 0.3, 0.2),
    "repeat_ratio": (0.45, 0.4, 0.35, 0.3, 0.25), "upper_ratio": (0.7, 0.5, 0.4, 0.3, 0.2)}.items() for c in cs))

NEAR_VECTORS = """
WITH RECURSIVE e AS (SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
ok AS (SELECT r, vec_id, label, v, sqrt(list_inner_product(v, v)) AS l FROM e
       WHERE label IS NOT NULL AND v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND list_inner_product(v, v) > 0),
pairs AS (SELECT a.r AS a, b.r AS b FROM ok a JOIN ok b ON a.label = b.label AND len(a.v) = len(b.v) AND a.r <> b.r
          WHERE list_inner_product(a.v, b.v) / (a.l * b.l) >= 0.98),
reach AS (SELECT r AS a, r AS b FROM e UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON reach.b = pairs.a),
least AS (SELECT reach.a AS r, min(e.vec_id) AS component_id FROM reach JOIN e ON e.r = reach.b GROUP BY reach.a),
n AS (SELECT a AS r, count(*) AS n FROM pairs GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM e JOIN least USING (r) LEFT JOIN n USING (r)
"""

#: A word without its k-th letter stands for all words that differ there, so
#: joins on it find words one edit apart.  CRC-32 is folded over the bytes.
SPELLING = f"""
WITH RECURSIVE t AS (SELECT list_transform(range(256), lambda i: list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda c, k:
            CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, CAST(i AS BIGINT))) AS crc),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), {UPPER}, {LOWER}), '[a-zÀ-ÿ]+')) AS w
         FROM documents),
r AS (SELECT id, w, count(*) AS n FROM runs WHERE length(w) >= 5 GROUP BY ALL),
h AS (SELECT w, n, xor(list_reduce(flatten(list_transform(string_split(id || ':' || w, ''), lambda c:
            CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 | (unicode(c) >> 6), 128 | (unicode(c) & 63)] END)),
            lambda c, b: xor(c >> 8, crc[CAST(xor(c, b) & 255 AS INTEGER) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS h FROM r, t),
x AS (SELECT CASE WHEN h % 97 = 0 THEN left(w, CAST(h % length(w) AS INTEGER)) || substr(w, CAST(h % length(w) AS INTEGER) + 2) ELSE w END AS word, n FROM h),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM x WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
d AS (SELECT word, n, length(word) AS s, k, left(word, k - 1) || substr(word, k + 1) AS rest
      FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM v)),
near AS (SELECT a.word, b.word AS near, b.n FROM d a JOIN d b ON a.s = b.s AND a.k = b.k AND a.rest = b.rest WHERE a.word <> b.word
         UNION SELECT v.word, d.word, d.n FROM d JOIN v ON d.rest = v.word
         UNION SELECT d.word, v.word, v.n FROM d JOIN v ON d.rest = v.word),
best AS (SELECT word, count(*) AS n_near, arg_min(near, (-n, near)) AS near, max(n) AS near_n FROM near GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * v.n THEN near END AS form,
             CASE WHEN near_n >= 2 * v.n THEN near_n END AS form_n FROM v LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root FROM f UNION ALL SELECT chain.word, f.form FROM chain JOIN f ON f.word = chain.root WHERE f.form IS NOT NULL)
SELECT f.word, f.n, n_near, form, form_n, root FROM f JOIN (SELECT chain.word, root FROM chain JOIN f ON f.word = root WHERE f.form IS NULL) USING (word)
"""
