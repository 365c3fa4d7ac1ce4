"""The queries in SQL for another engine, written from their definitions."""

OP1 = """
WITH bodies AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
     sized AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest FROM bodies),
     firsts AS (SELECT payload_digest, max(page_id) AS newest FROM sized WHERE payload_bytes >= 1000 GROUP BY ALL)
SELECT s.page_id, s.payload_bytes, s.payload_digest,
       CASE WHEN f.newest > s.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.newest > s.page_id THEN f.newest END AS refers_to
FROM sized s LEFT JOIN firsts f ON f.payload_digest = s.payload_digest AND s.payload_bytes >= 1000
"""

OP4 = """
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), rules(rule_host, rule_path, decides) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fitting AS (
  SELECT page_id, rule_host || rule_path AS rule, decides
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
), longest AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(decides, length(rule)) AS decides FROM fitting GROUP BY page_id
)
SELECT p.page_id, p.host, p.path, l.rule, coalesce(l.decides, 'allow') AS verdict FROM parts p LEFT JOIN longest l USING (page_id)
"""

OP6 = """
WITH bare AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
  FROM documents
), ranked AS (
  SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id
  FROM bare
)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, text_sha256 FROM ranked
"""


def _deal(level: int, names: list[str]) -> str:
    """CTEs that deal the budgets of the nodes above to the children at ``level``."""
    here, above = ", ".join(names[:level]), ", ".join(names[: level - 1])
    own = names[level - 1]
    family = f"PARTITION BY {above}" if above else ""
    budget = f"FROM n{level} JOIN b{level - 1} USING ({above})" if above else f"FROM n{level}, budget_of_all"
    return f"""
n{level} AS (
  SELECT {here}, CASE WHEN w > 0 THEN able ELSE 0 END AS able, w
  FROM (SELECT {here}, CAST(sum(tokens) * 2 AS BIGINT) AS able, weight_of('{own}', {own}) AS w FROM leaves GROUP BY {here})
), h{level} AS (
  SELECT {here}, able, w, have, sum(able) OVER later - able AS gone, sum(w) OVER upto AS open_w
  {budget}
  WINDOW later AS ({family} ORDER BY w = 0, able / greatest(w, 1), {here} ROWS UNBOUNDED PRECEDING),
         upto AS ({family} ORDER BY w = 0, able / greatest(w, 1), {here} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), d{level} AS (
  SELECT *, able * CAST(open_w AS HUGEINT) <= (have - gone) * CAST(w AS HUGEINT) AS short FROM h{level}
), s{level} AS (
  SELECT *, max(CASE WHEN NOT short THEN have - gone END) OVER ({family}) AS rest,
         max(CASE WHEN NOT short THEN open_w END) OVER ({family}) AS rest_w
  FROM d{level}
), b{level} AS (
  SELECT {here}, CAST(CASE WHEN short THEN able ELSE least(able, rest * w // rest_w) END AS BIGINT) AS have FROM s{level}
)"""


def _mixture() -> str:
    """Whole leaves are ordered here, which is what the cells of the Spark plan avoid."""
    names = ["domain", "lang", "source"]
    weight = """
CASE WHEN level = 'domain' THEN CASE v WHEN 'web' THEN 3 WHEN 'books' THEN 2 ELSE 1 END
     WHEN level = 'lang' THEN CASE v WHEN 'en' THEN 4 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END
     ELSE CASE v WHEN 'src0' THEN 2 ELSE 1 END END"""
    deals = ",".join(_deal(i, names).replace(f"weight_of('{n}', {n})", weight.replace("level", f"'{n}'").replace("CASE v", f"CASE {n}")) for i, n in enumerate(names, 1))
    return f"""
WITH docs AS (
  SELECT doc_id, lang, source, length(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens,
         CASE try_cast(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS INTEGER) % 3 WHEN 1 THEN 'books' WHEN 2 THEN 'forum' ELSE 'web' END AS domain
  FROM documents
), leaves AS (SELECT domain, lang, source, sum(tokens) AS tokens FROM docs GROUP BY ALL),
budget_of_all AS (SELECT CAST(floor(sum(tokens) * 0.8) AS BIGINT) AS have FROM leaves),
{deals},
plan AS (
  SELECT l.*, have // greatest(tokens, 1) AS epochs, have % greatest(tokens, 1) AS rest
  FROM leaves l JOIN b3 USING (domain, lang, source) WHERE tokens > 0
), placed AS (
  SELECT d.*, p.epochs, p.rest,
         sum(d.tokens) OVER (PARTITION BY domain, lang, source
           ORDER BY ('0x' || md5('17-' || epochs || '-' || doc_id)[1:15])::BIGINT, doc_id) AS upto
  FROM docs d JOIN plan p USING (domain, lang, source)
)
SELECT doc_id, domain, lang, source, CAST(unnest(range(CAST(epochs + CASE WHEN upto <= rest THEN 1 ELSE 0 END AS BIGINT))) AS INTEGER) AS epoch,
       CAST(tokens AS BIGINT) AS tokens
FROM placed
"""


OP11 = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), split AS (
  SELECT lang, row_number() OVER () AS piece_id, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces
), words AS (
  SELECT lang, piece_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM split
), follows AS (
  SELECT lang, w AS w1, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3, lead(w, 3) OVER o AS w4, lead(w, 4) OVER o AS w5
  FROM words WINDOW o AS (PARTITION BY piece_id ORDER BY pos)
), sizes AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, [w1] AS ws, count(*) AS f FROM follows GROUP BY ALL HAVING count(*) >= 100
  UNION ALL SELECT lang, [w1, w2], count(*) FROM follows WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 100
  UNION ALL SELECT lang, [w1, w2, w3], count(*) FROM follows WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 100
  UNION ALL SELECT lang, [w1, w2, w3, w4], count(*) FROM follows WHERE w4 IS NOT NULL GROUP BY ALL HAVING count(*) >= 100
  UNION ALL SELECT lang, [w1, w2, w3, w4, w5], count(*) FROM follows WHERE w5 IS NOT NULL GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
  SELECT g.lang, g.ws, g.f AS a, x.k, p.f AS l, q.f AS r, s.n,
         (CAST(1000 AS HUGEINT) * g.f * s.n) // (CAST(p.f AS HUGEINT) * q.f) AS score
  FROM grams g CROSS JOIN (VALUES (1), (2), (3), (4)) x(k)
  JOIN grams p ON p.lang = g.lang AND p.ws = g.ws[1:x.k]
  JOIN grams q ON q.lang = g.lang AND q.ws = g.ws[x.k + 1:]
  JOIN sizes s ON s.lang = g.lang
  WHERE len(g.ws) > x.k
), best AS (
  SELECT lang, ws, a, n, min(score) AS score, arg_min(l, score * 10 + k) AS l, arg_min(r, score * 10 + k) AS r FROM cuts GROUP BY lang, ws, a, n
), inside AS (
  SELECT lang, ws[1:len(ws) - 1] AS ws, f FROM grams WHERE len(ws) > 2
  UNION ALL SELECT lang, ws[2:], f FROM grams WHERE len(ws) > 2
  UNION ALL SELECT lang, ws[1:2], f FROM grams WHERE len(ws) > 3
  UNION ALL SELECT lang, ws[2:3], f FROM grams WHERE len(ws) > 3
  UNION ALL SELECT lang, ws[3:4], f FROM grams WHERE len(ws) > 3
  UNION ALL SELECT lang, ws[4:5], f FROM grams WHERE len(ws) > 4
  UNION ALL SELECT lang, ws[1:3], f FROM grams WHERE len(ws) > 4
  UNION ALL SELECT lang, ws[2:4], f FROM grams WHERE len(ws) > 4
  UNION ALL SELECT lang, ws[3:5], f FROM grams WHERE len(ws) > 4
), shadow AS (SELECT lang, ws, max(f) AS f FROM inside GROUP BY lang, ws),
ranked AS (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, array_to_string(b.ws, ' ')) AS rank,
         array_to_string(b.ws, ' ') AS phrase, b.a, b.l, b.r, b.n, CAST(b.score AS BIGINT) AS score
  FROM best b LEFT JOIN shadow s ON s.lang = b.lang AND s.ws = b.ws
  WHERE s.f IS NULL OR 100 * s.f < 100 * b.a
)
SELECT * FROM ranked WHERE rank <= 2000
"""

OP12 = """
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents
), marks AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
failing AS (
  SELECT part,
         CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END ||
         CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END ||
         CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END ||
         CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END ||
         CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails,
         coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM words w LEFT JOIN marks m ON m.doc_id = w.doc_id
), kinds AS (
  SELECT part, fails, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic FROM failing GROUP BY ALL
), letters(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
  JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)
), hits AS (
  SELECT k.*, o.filter_order, s.step, substr(filter_order, s.step, 1) AS letter,
         coalesce(list_min(list_transform(string_split(k.fails, ''), lambda c: CASE WHEN c = '' THEN 9 ELSE strpos(filter_order, c) END)), 9) AS first_step
  FROM kinds k CROSS JOIN orders o CROSS JOIN (VALUES (1), (2), (3), (4), (5)) s(step)
), counted AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, letter,
         CAST(sum(CASE WHEN first_step > step THEN n ELSE 0 END) AS BIGINT) AS kept,
         CAST(sum(CASE WHEN first_step = step THEN n ELSE 0 END) AS BIGINT) AS removed,
         CAST(sum(CASE WHEN contains(fails, letter) AND first_step < step THEN n ELSE 0 END) AS BIGINT) AS redundant,
         CAST(sum(CASE WHEN fails = letter THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
         CAST(sum(CASE WHEN first_step = step THEN good ELSE 0 END) AS BIGINT) AS good_lost,
         CAST(sum(CASE WHEN first_step = step THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM hits GROUP BY ALL
)
SELECT * EXCLUDE (letter), CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM counted
"""

OP13 = """
WITH bytes AS (
  SELECT doc_id, row_number() OVER () AS r, encode(coalesce(text, '')) AS b, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents
), starts AS (
  SELECT r, b, unnest(range(n - 399)) AS i FROM bytes WHERE n >= 400
), windows AS (
  SELECT r, i, md5(array_slice(b, i + 1, i + 400)) AS w FROM starts
), hits AS (
  SELECT r, i FROM windows SEMI JOIN (SELECT w FROM windows GROUP BY w HAVING count(*) > 1) USING (w)
), marked AS (
  SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 400 THEN 0 ELSE 1 END AS opens FROM hits
), numbered AS (
  SELECT r, i, sum(opens) OVER (PARTITION BY r ORDER BY i) AS span FROM marked
), spans AS (
  SELECT r, min(i) AS first, max(i) + 400 AS upto FROM numbered GROUP BY r, span
), gaps AS (
  SELECT s.r, first, upto, hex(array_slice(b, coalesce(lag(upto) OVER (PARTITION BY s.r ORDER BY first), 0) + 1, first)) AS before
  FROM spans s JOIN bytes USING (r)
), kept AS (
  SELECT r, CAST(sum(upto - first) AS BIGINT) AS n_removed, count(*) AS n_spans, string_agg(before, '' ORDER BY first) AS head, max(upto) AS upto
  FROM gaps GROUP BY r
)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || hex(array_slice(b, coalesce(upto, 0) + 1, n)))) AS kept_sha256
FROM bytes LEFT JOIN kept USING (r)
"""

OP2 = _mixture()
SQL = {
    "op1_warc_transactions": OP1, "op2_source_mixture": OP2, "op4_url_cascade": OP4, "op6_chunk_recipes": OP6,
    "op11_son_phrases": OP11, "op12_filter_audit": OP12,
    "op13_suffix_runs": OP13,
}
