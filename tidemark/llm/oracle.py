"""DuckDB SQL with the same result as the query of that name, where SQL can express it."""

MIX = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), placed AS (
  SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS place FROM per_source
), weighed AS (
  SELECT *, [5, 2, 1][(place % 3 + 1)::INT] AS weight, 2.0::DOUBLE * source_size AS cap FROM placed
), capped AS (
  SELECT *, cap / weight AS reached_at FROM weighed
), levels AS (
  SELECT *,
    (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER before, 0)) /
    (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM capped
  WINDOW before AS (ORDER BY reached_at, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT arg_min(level, (reached_at, place)) AS level FROM levels WHERE level <= reached_at
), plan AS (
  SELECT source, source_size, least(cap, (SELECT level FROM level) * weight) AS target FROM levels
), parts AS (
  SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS whole FROM plan
), lefts AS (
  SELECT *, target - whole * source_size AS words_left FROM parts
), per_size AS (
  SELECT s.source, s.size, count(*) * s.size AS words, any_value(p.words_left) AS words_left
  FROM sized s JOIN lefts p ON s.source IS NOT DISTINCT FROM p.source WHERE s.size > 0 AND p.words_left > 0 GROUP BY s.source, s.size
), tried AS (
  SELECT source, size,
    words_left - coalesce(sum(words) OVER (PARTITION BY source ORDER BY size DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open_left,
    sum(sqrt(size::DOUBLE) * words) OVER (PARTITION BY source ORDER BY size DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS spread
  FROM per_size
), scales AS (
  SELECT source, max(size) AS open_size, arg_max(open_left, size) AS open_left, arg_max(spread, size) AS spread
  FROM tried WHERE open_left * sqrt(size::DOUBLE) < spread GROUP BY source
), chances AS (
  SELECT s.doc_id, s.source, s.size, p.source_size, p.target, p.whole, c.open_left,
    (('0x' || substr(md5(concat_ws(':', 'mix-1', s.doc_id::VARCHAR)), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u,
    s.size > 0 AND p.words_left > 0 AND (c.open_size IS NULL OR s.size > c.open_size) AS certain,
    CASE WHEN s.size > 0 AND p.words_left > 0 AND s.size <= c.open_size THEN c.open_left * sqrt(s.size::DOUBLE) / c.spread END AS chance
  FROM sized s JOIN lefts p ON s.source IS NOT DISTINCT FROM p.source LEFT JOIN scales c ON s.source IS NOT DISTINCT FROM c.source
), odds AS (
  SELECT *, (u / (1 - u)) / (chance / (1 - chance)) AS odds FROM chances
), ranked AS (
  SELECT *, sum(CASE WHEN odds IS NOT NULL THEN size END) OVER (
    PARTITION BY source ORDER BY odds NULLS LAST, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS so_far FROM odds
)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE WHEN certain OR odds IS NOT NULL AND so_far - size / 2.0::DOUBLE <= open_left THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ranked
"""

URLS = r"""
WITH rests AS (
  SELECT row_number() OVER () AS row_id, page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT row_id, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rests
), rules(rule_host, rule_path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), best AS (
  SELECT row_id, arg_max({'rule': rule_host || rule_path, 'verdict': verdict}, (length(rule_host || rule_path), length(rule_host))) AS best
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY row_id
)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict
FROM parts LEFT JOIN best USING (row_id)
"""

RANKS = r"""
WITH fold AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), docs AS (
  SELECT row_number() OVER () AS doc, doc_id, terms, len(terms)::BIGINT AS n FROM fold WHERE len(terms) > 0
), totals AS (
  SELECT count(*)::BIGINT AS docs, coalesce(sum(n), 0)::BIGINT AS words FROM docs
), held AS (
  SELECT doc, term, count(*)::BIGINT AS tf FROM (SELECT doc, unnest(terms) AS term FROM docs) GROUP BY doc, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * (SELECT docs FROM totals) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM held GROUP BY term
), asked AS (
  SELECT row_number() OVER () AS item, item_id,
    list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS terms
  FROM (SELECT DISTINCT item_id, text FROM benchmark)
), sums AS (
  SELECT a.item, a.item_id, d.doc_id, d.doc,
    sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * d.n * t.docs) // t.words))))::BIGINT AS score
  FROM (SELECT item, item_id, unnest(terms) AS term FROM asked) a
  JOIN held h USING (term) JOIN weights USING (term) JOIN docs d ON d.doc = h.doc CROSS JOIN totals t
  GROUP BY a.item, a.item_id, d.doc_id, d.doc
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM sums WHERE score > 0)
WHERE rank <= 50
"""

VECTORS = r"""
WITH RECURSIVE given AS (
  SELECT row_number() OVER () AS node, vec_id, label,
    CASE WHEN label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0 THEN embedding::DOUBLE[] END AS v
  FROM embeddings
), valid AS (
  SELECT *, sqrt(list_dot_product(v, v)) AS norm FROM given WHERE v IS NOT NULL
), links AS (
  SELECT a.node AS a, b.node AS b FROM valid a JOIN valid b ON a.label = b.label AND a.node <> b.node
  WHERE CASE WHEN len(a.v) = len(b.v) THEN list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.98 ELSE false END
), reach AS (
  SELECT node AS a, node AS b FROM given
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), components AS (
  SELECT reach.a AS node, min(g.vec_id) AS component_id FROM reach JOIN given g ON g.node = reach.b GROUP BY reach.a
), counts AS (
  SELECT a AS node, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM given JOIN components USING (node) LEFT JOIN counts USING (node)
"""

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"""

NEAREST = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, doc_id, {_WORDS} AS words FROM documents
), totals AS (
  SELECT count(*) AS n, sum(len(words)) / count(*) AS mean FROM docs
), held AS (
  SELECT doc, word, count(*) AS tf FROM (SELECT doc, unnest(words) AS word FROM docs) GROUP BY doc, word
), rarity AS (
  SELECT word, ln(1 + ((SELECT n FROM totals) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM held GROUP BY word
), asked AS (
  SELECT query, query_id, word, count(*) AS f
  FROM (SELECT row_number() OVER () AS query, doc_id AS query_id, unnest({_WORDS}) AS word
        FROM (SELECT DISTINCT doc_id, text FROM documents WHERE doc_id % 50 = 0))
  GROUP BY ALL
), scores AS (
  SELECT query, query_id, doc_id, doc, sum(f * idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / mean))) AS score
  FROM asked JOIN held USING (word) JOIN rarity USING (word) JOIN docs USING (doc) CROSS JOIN totals
  GROUP BY query, query_id, doc_id, doc
)
SELECT query_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(score, 9) DESC, doc_id NULLS LAST) AS rank FROM scores)
WHERE rank <= 10
"""


def _discounts(level: str) -> str:
    """Good-Turing discounts of counts 1 to 5, or absolute ones where they do not exist; as a list."""
    turing = ", ".join(f"(({r + 1}.0 * n[{r + 1}] / nullif(n[{r}], 0) / {r} - common) / nullif(1 - common, 0))" for r in range(1, 6))
    absolute = ", ".join(f"(({r} - cut) / {r})" for r in range(1, 6))
    return f"""
{level}_of AS (SELECT list_transform(range(1, 7), lambda r: coalesce(counts[r], 0)) AS n FROM (
  SELECT map_from_entries(list((c, kinds))) AS counts FROM (SELECT c, count(*) AS kinds FROM {level} WHERE c <= 6 GROUP BY c))),
{level}_d AS (
  SELECT CASE WHEN len(list_filter(turing, lambda x: x IS NOT NULL AND isfinite(x) AND x > 0 AND x <= 1)) = 5 AND turing[1] < 1 THEN turing ELSE [{absolute}] END AS d
  FROM (SELECT [{turing}] AS turing, CASE WHEN n[1] > 0 AND n[2] > 0 THEN n[1] / (n[1] + 2.0 * n[2]) ELSE 0.5 END AS cut
        FROM (SELECT n, 6.0 * n[6] / nullif(n[1], 0) AS common FROM {level}_of))
)"""


KATZ = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, doc_id, list_append({_WORDS}, chr(10)) AS words,
    coalesce(xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
      lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 7 = 2, false) AS held_out
  FROM documents
), tokens AS (
  SELECT doc, held_out, unnest(words) AS w, unnest(list_concat([' '], words[:-2])) AS h FROM docs
), singles AS (
  SELECT w, count(*) AS c FROM tokens WHERE NOT held_out GROUP BY w
), pairs AS (
  SELECT h, w, count(*) AS c FROM tokens WHERE NOT held_out GROUP BY h, w
), {_discounts("singles")}, {_discounts("pairs")},
sizes AS (
  SELECT coalesce(sum(c), 0)::BIGINT AS n, count(*) AS kinds, coalesce(sum(CASE WHEN c <= 5 THEN d[c] ELSE 1 END * c), 0) AS kept
  FROM singles CROSS JOIN singles_d
), whole AS (
  SELECT *, CASE WHEN n - kept > 1e-9 THEN n ELSE n + 1 END AS whole FROM sizes
), single AS (
  SELECT w, c, CASE WHEN c <= 5 THEN d[c] ELSE 1 END * c / whole AS p FROM singles CROSS JOIN singles_d CROSS JOIN whole
), taken AS (
  SELECT h, sum(pairs.c) AS seen, sum(CASE WHEN pairs.c <= 5 THEN d[pairs.c] ELSE 1 END * pairs.c) AS kept, sum(p) AS followed
  FROM pairs JOIN single USING (w) CROSS JOIN pairs_d GROUP BY h
), histories AS (
  SELECT h, whole, (1 - kept / whole) / (1 - followed) AS alpha FROM (SELECT *, CASE WHEN seen - kept > 1e-9 THEN seen ELSE seen + 1 END AS whole FROM taken)
), told AS (
  SELECT t.doc, s.c AS known, coalesce(s.c, 0) AS c, coalesce(s.p, 1 - x.kept / x.whole) AS one,
    CASE WHEN p.c <= 5 THEN d[p.c] ELSE 1 END * p.c / g.whole AS two, coalesce(g.alpha, 1) AS alpha, x.n, x.kinds
  FROM tokens t LEFT JOIN single s ON t.w = s.w LEFT JOIN pairs p ON t.h = p.h AND t.w = p.w LEFT JOIN histories g ON t.h = g.h
  CROSS JOIN whole x CROSS JOIN pairs_d
)
SELECT doc_id, held_out, count(*)::BIGINT AS n_tokens, count(known)::BIGINT AS n_known, any_value(n) AS train_tokens,
  sum(log10((c + 1) / (n + kinds + 1.0::DOUBLE))) AS base_score, sum(log10(CASE WHEN two IS NULL THEN alpha * one ELSE two END)) AS score
FROM told JOIN docs USING (doc) GROUP BY doc, doc_id, held_out
"""

ORACLE: dict[str, str] = {
    "op1_lattice": VECTORS,
    "op5_katz": KATZ,
    "op6_bm25": NEAREST,
    "op8_mixing": MIX,
    "op11_url_filters": URLS,
    "op12_mask_search": RANKS,
}
