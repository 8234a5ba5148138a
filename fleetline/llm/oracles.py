"""DuckDB SQL for the operators that SQL can express."""

OP1 = r"""
WITH words AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, text,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
positions AS (SELECT rid, w, unnest(generate_series(1, len(w) - 2)) AS p FROM words WHERE len(w) > 2),
grams AS (SELECT rid, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS g FROM positions),
twice AS (SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, g) AS n FROM grams) WHERE n > 1),
repeats AS (SELECT rid, count(DISTINCT p + k) AS n FROM twice, (VALUES (0), (1), (2)) t(k) GROUP BY rid),
base AS (
  SELECT words.rid, doc_id, lang, source, len(w)::BIGINT AS n_words, len(l) AS n_lines,
    coalesce(length(array_to_string(w, '')), 0)::BIGINT AS word_chars,
    coalesce(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')), 0)::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM words LEFT JOIN repeats USING (rid)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    [CASE WHEN word_chars > 0 THEN n_symbols * 1000 // word_chars ELSE 0 END,
     CASE WHEN n_lines > 0 THEN n_dup_lines * 1000 // n_lines ELSE 0 END,
     CASE WHEN n_words > 0 THEN n_repeat_words * 1000 // n_words ELSE 0 END,
     CASE WHEN n_words > 0 THEN word_chars * 10 // n_words ELSE 0 END] AS v FROM base),
entries AS (SELECT rid, base_failed, lang, source, unnest([1, 2, 3, 4]) AS m,
    floor(ln(unnest(v)::DOUBLE + 1) * 50)::INT AS b FROM judged),
levels AS (
  SELECT 1 AS level, lang, source, m, b FROM entries WHERE NOT base_failed
  UNION ALL SELECT 2, lang, NULL, m, b FROM entries WHERE NOT base_failed
  UNION ALL SELECT 3, NULL, NULL, m, b FROM entries WHERE NOT base_failed),
cumulated AS (
  SELECT level, lang, source, m, b, n, sum(n) OVER (PARTITION BY level, lang, source, m ORDER BY b) AS cum,
    sum(n) OVER (PARTITION BY level, lang, source, m) AS total
  FROM (SELECT level, lang, source, m, b, count(*) AS n FROM levels GROUP BY ALL)),
fences AS (
  SELECT level, lang, source, m, max(total) AS total, min(b) FILTER (WHERE cum * 100 >= total * 25) AS q25,
    min(b) FILTER (WHERE cum * 100 >= total * 75) AS q75 FROM cumulated GROUP BY ALL),
verdicts AS (
  SELECT e.rid, bool_and(
    e.b <= greatest(f.q75 + 3 * (f.q75 - f.q25), floor(ln([100, 500, 300, 120][e.m] + 1.0) * 50))
    AND (e.m <> 4 OR e.b >= least(f.q25 - 3 * (f.q75 - f.q25), floor(ln(26.0) * 50)))) AS inside
  FROM entries e JOIN fences s ON s.level = 1 AND s.m = e.m AND s.lang IS NOT DISTINCT FROM e.lang
      AND s.source IS NOT DISTINCT FROM e.source
    JOIN fences l ON l.level = 2 AND l.m = e.m AND l.lang IS NOT DISTINCT FROM e.lang
    JOIN fences f ON f.m = e.m AND f.level = CASE WHEN s.total >= 200 THEN 1 WHEN l.total >= 200 THEN 2 ELSE 3 END
      AND (f.level = 3 OR f.lang IS NOT DISTINCT FROM e.lang)
      AND (f.level <> 1 OR f.source IS NOT DISTINCT FROM e.source)
  GROUP BY e.rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(inside, true) AS kept
FROM judged LEFT JOIN verdicts USING (rid)
"""

OP2 = r"""
WITH parsed AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
outcomes AS (
  SELECT page_id, quality = 0 AS bad FROM parsed JOIN labels
    ON labels.doc_id = try_cast(regexp_extract(path, '^/[^/]*/([0-9]{1,18})', 1) AS BIGINT)
  WHERE quality IS NOT NULL),
per_page AS (SELECT page_id, count(*) AS n, count(*) FILTER (WHERE bad) AS k FROM outcomes GROUP BY 1),
hosts AS (
  SELECT host, coalesce(sum(n), 0)::DOUBLE AS n, coalesce(sum(k), 0)::DOUBLE AS k,
    regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS name
  FROM parsed LEFT JOIN per_page USING (page_id) GROUP BY host),
domains0 AS (
  SELECT *, CASE WHEN regexp_matches(name, '^[0-9]+(\.[0-9]+){3}$') THEN name
    WHEN array_to_string(string_split(name, '.')[-2:], '.') IN ('co.uk', 'org.uk', 'ac.uk', 'com.au',
      'co.jp', 'com.br', 'co.nz', 'co.in') THEN array_to_string(string_split(name, '.')[-3:], '.')
    ELSE array_to_string(string_split(name, '.')[-2:], '.') END AS domain FROM hosts),
leaves AS (
  SELECT *, CASE WHEN regexp_matches(domain, '^[0-9]+(\.[0-9]+){3}$') THEN domain
    WHEN contains(domain, '.') THEN regexp_replace(domain, '^[^.]*\.', '') ELSE domain END AS suffix FROM domains0),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM leaves GROUP BY 1, 2),
suffixes AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM domains GROUP BY 1),
levels AS (SELECT 'h' AS level, n, k FROM leaves UNION ALL SELECT 'd', n, k FROM domains
  UNION ALL SELECT 's', n, k FROM suffixes),
moments AS (SELECT level, count(*) AS m, sum(n) AS n, sum(k) AS k, sum(n * n) AS nn, sum(k * k / n) AS kk
  FROM levels WHERE n > 0 GROUP BY 1),
spread AS (SELECT *, k / n AS p, k / n * (1 - k / n) * (n - nn / n - (m - 1)) AS free FROM moments),
rho AS (SELECT *, CASE WHEN m < 2 OR k = 0 OR k = n OR free <= 0 THEN 0
  ELSE (kk - n * p * p - p * (1 - p) * (m - 1)) / free END AS r FROM spread),
weights AS (SELECT level, CASE WHEN r > 0 THEN least(greatest((1 - r) / r, 1.0), 1000.0) ELSE 1000.0 END AS w FROM rho),
w AS (SELECT coalesce(max(w) FILTER (WHERE level = 'h'), 1000.0) AS wh,
    coalesce(max(w) FILTER (WHERE level = 'd'), 1000.0) AS wd,
    coalesce(max(w) FILTER (WHERE level = 's'), 1000.0) AS ws FROM weights),
total AS (SELECT sum(n) AS n, sum(k) AS k FROM suffixes),
priors AS (
  SELECT d.domain, d.n, d.k, ((total.k - s.k + 1) / (total.n - s.n + 2) * ws + s.k - d.k) / (s.n - d.n + ws) AS m
  FROM domains d JOIN suffixes s USING (suffix), total, w),
means AS (
  SELECT l.host, l.n, wh, (((p.m * wd + p.k - l.k) / (p.n - l.n + wd)) * wh + l.k) / (l.n + wh) AS mean
  FROM leaves l JOIN priors p USING (domain), w),
bounds AS (SELECT host, mean - 1.645 * sqrt(mean * (1 - mean) / (n + wh + 1)) AS lower FROM means),
rules(verdict, rule, rule_host, rule_path) AS (VALUES ('allow', 'org/', 'org', '/'),
  ('block', 'example.org/es/', 'example.org', '/es/'), ('block', 'example.org/en/1', 'example.org', '/en/1'),
  ('allow', 'com/fr/', 'com', '/fr/'), ('block', 'com/de/', 'com', '/de/')),
fits AS (
  SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(rules.verdict, length(rule)) AS verdict
  FROM (SELECT DISTINCT host, path FROM parsed) JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY 1, 2)
SELECT page_id, host, path, rule,
  coalesce(fits.verdict, CASE WHEN lower > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM parsed LEFT JOIN fits USING (host, path) LEFT JOIN bounds USING (host)
"""

OP7 = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS o,
    len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size
  FROM documents),
sources AS (
  SELECT source, sum(size)::DOUBLE AS s, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn
  FROM sized GROUP BY source),
levels AS (SELECT *, [3.0, 1.0, 2.0][(turn % 3 + 1)::INT]::DOUBLE AS weight FROM sources),
tries AS (
  SELECT *, 2 * s / weight AS level,
    (1.5 * sum(s) OVER () - coalesce(sum(2 * s) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS try
  FROM levels WINDOW o AS (ORDER BY 2 * s / weight, turn)),
found AS (SELECT try AS lam FROM tries WHERE try <= level ORDER BY level, turn LIMIT 1),
targets AS (SELECT source, turn, s, least(2 * s, lam * weight) AS target FROM tries, found),
placed AS (
  SELECT doc_id, size, s::BIGINT AS source_size, turn, target, s,
    sum(size) OVER (PARTITION BY turn ORDER BY o, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before,
    least(CASE WHEN s > 0 THEN floor(target / s) ELSE 0 END, 2) AS times
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source),
taken AS (
  SELECT *, CASE WHEN size = 0 THEN 0 ELSE times
    + (times < 2 AND before + size / 2 <= target - times * s)::INT END AS copies FROM placed),
shares AS (SELECT *, least((before + size / 2) / target, 1.0) AS q, (turn % 3)::INT AS k FROM taken)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken,
  CASE WHEN copies = 0 THEN NULL WHEN k = 1 THEN q
    WHEN k = 0 THEN CASE WHEN q <= 0.625 THEN 2 * q / (sqrt(2.25 - 2 * q) + 1.5)
      ELSE 0.5 + 2 * (q - 0.625) / (sqrt(1 - 2 * (q - 0.625)) + 1) END
    ELSE CASE WHEN q <= 0.375 THEN 2 * q / (sqrt(0.25 + 2 * q) + 0.5)
      ELSE 0.5 + 2 * (q - 0.375) / (sqrt(1 + 2 * (q - 0.375)) + 1) END END AS position
FROM shares
"""

ORACLE_SQL = {"op1_quality_rules": OP1, "op2_url_reputation": OP2, "op7_curriculum_mix": OP7}
