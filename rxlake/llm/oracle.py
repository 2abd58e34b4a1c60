"""SQL of the later training-data queries, for DuckDB."""

OP12_SQL = r"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')) AS key FROM conversations),
h AS (SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(key) + 1), lambda i: ord(key[i])::BIGINT)),
        lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS h FROM k),
g AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
        CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE WHEN h = 3 THEN [1, 2] ELSE [1] END) AS copy FROM h WHERE h <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
        left(role, 1) AS x, left(coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy), '-'), 1) AS px,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen FROM g),
t AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1 WHEN seen > 1 THEN 2
        WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS fault FROM o),
c AS (SELECT row_number() OVER () AS cid, conv_id FROM (SELECT DISTINCT conv_id FROM conversations)),
r AS (SELECT cid, i, x, fault, role, text FROM t JOIN c ON t.conv_id IS NOT DISTINCT FROM c.conv_id),
step(q, role, p) AS (VALUES ('0', 's', 's'), ('0', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')),
more(q, p, times) AS (VALUES ('0', '0', 0), ('0', 'u', 1), ('0', 'a', 2), ('s', 's', 0), ('s', 'u', 1), ('s', 'a', 2), ('u', 'u', 0), ('u', 'a', 1), ('a', 'a', 0), ('a', 'u', 1)),
dp(cid, i, p, m) AS (
  SELECT cid, 0::BIGINT, p, {'cost': 5 * times, 'audit': repeat('I', times)} FROM c, more WHERE q = '0'
  UNION ALL
  SELECT e.cid, e.i, more.p, min({'cost': e.cost + 5 * times, 'audit': e.audit || repeat('I', times)})
  FROM (SELECT dp.cid, r.i, dp.p AS q, dp.m.cost + 2 AS cost, dp.m.audit || 'D' AS audit FROM dp JOIN r ON r.cid = dp.cid AND r.i = dp.i + 1
        UNION ALL
        SELECT dp.cid, r.i, step.p, dp.m.cost + (r.x <> step.role)::INT + CASE WHEN fault = 3 THEN 5 ELSE 0 END, dp.m.audit || CASE WHEN r.x = step.role THEN 'K' ELSE 'R' END
        FROM dp JOIN r ON r.cid = dp.cid AND r.i = dp.i + 1 JOIN step ON step.q = dp.p
        WHERE fault IN (0, 3) AND (r.x = step.role OR step.role <> 's')) e JOIN more ON more.q = e.q
  GROUP BY e.cid, e.i, more.p),
n AS (SELECT cid, max(i) AS n FROM r GROUP BY cid),
best AS (SELECT dp.cid, min(m) AS m FROM dp LEFT JOIN n ON n.cid = dp.cid WHERE dp.i = coalesce(n.n, 0) AND dp.p IN ('0', 'a') GROUP BY dp.cid),
letters AS (SELECT cid, m.audit AS audit, unnest(range(1, length(m.audit) + 1)) AS j FROM best),
l AS (SELECT cid, j, audit[j] AS e, count(*) FILTER (audit[j] <> 'I') OVER w AS i, count(*) FILTER (audit[j] <> 'D') OVER w AS place,
        (length(audit) - length(replace(audit, 'D', ''))) AS gone, length(audit) AS len FROM letters WINDOW w AS (PARTITION BY cid ORDER BY j)),
fixed AS (SELECT l.cid, j, CASE WHEN e = 'K' THEN role WHEN (place - (len - gone) % 2) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END AS line
        FROM l LEFT JOIN r ON r.cid = l.cid AND r.i = l.i WHERE e <> 'D'),
sha AS (SELECT cid, sha256(string_agg(line, chr(10) ORDER BY j)) AS repaired_sha256 FROM fixed GROUP BY cid),
facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
        count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (i > 1 AND px || x NOT IN ('su', 'ua', 'au')) AS illegal FROM t GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(best.m.cost, 0)::BIGINT AS cost, coalesce(best.m.audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM c LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN best ON best.cid = c.cid LEFT JOIN sha ON sha.cid = c.cid
"""

OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT rid, lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM w GROUP BY lang),
grams AS (SELECT lang, k::BIGINT AS k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS phrase
          FROM w, range(1, 6) r(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
cuts AS (SELECT c.*, unnest(range(1, k)) AS cut FROM c),
s AS (SELECT cuts.lang, cuts.k, cuts.phrase, a, cut, l.f AS l, r.f AS r, n, (1000::HUGEINT * a * n) // (l.f * r.f) AS score
      FROM cuts JOIN totals USING (lang)
      JOIN f l ON l.lang = cuts.lang AND l.phrase = array_to_string(w[1 : cut], ' ') AND l.k = cut
      JOIN f r ON r.lang = cuts.lang AND r.phrase = array_to_string(w[cut + 1 :], ' ') AND r.k = cuts.k - cut),
b AS (SELECT lang, k, phrase, a, n, min_by(l, score * 8 + cut) AS l, min_by(r, score * 8 + cut) AS r, min(score) AS score FROM s GROUP BY lang, k, phrase, a, n),
m AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM c x WHERE x.lang = b.lang AND x.k > b.k AND 100 * x.a >= 100 * b.a
        AND contains(' ' || x.phrase || ' ', ' ' || b.phrase || ' '))),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM m)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM r WHERE rank <= 2000
"""
