"""SQL texts for the operators that SQL can express. They compare plainly, without hashes or ranges."""

from __future__ import annotations

from natalis.llm import decontaminate, perspectives

_W, _EQUAL, _INSIDE = decontaminate.WINDOW, decontaminate.MIN_EQUAL, decontaminate.LEAST_INSIDE
_LETTER = "".join(f"\\p{{{script}}}" for script in decontaminate.UNSPACED)
_WORDS = f"regexp_extract_all(lower(regexp_replace(coalesce(text, ''), '([{_LETTER}])', ' \\1 ', 'g')), '[\\p{{L}}\\p{{N}}]+')"

#: every aligned window of equal size, found from all pairs of equal words on one alignment; short items by their whole list
DECONTAMINATE = f"""
WITH doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
a AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, unnest(range(len(w))) AS i FROM doc WHERE len(w) >= {_W}),
b AS (SELECT item_id, len(w) AS m, unnest(w) AS word, unnest(range(len(w))) AS j FROM item WHERE len(w) >= {_W}),
pairs AS (SELECT doc_id, item_id, i - j AS shift, n, m, i FROM a JOIN b USING (word)),
likely AS (SELECT doc_id, item_id, shift FROM pairs GROUP BY ALL HAVING count(*) >= {_EQUAL}),
windows AS (
  SELECT doc_id, item_id, shift, n, m, i - back AS s, count(*) AS equal
  FROM pairs JOIN likely USING (doc_id, item_id, shift), range({_W}) r(back)
  GROUP BY ALL
),
short AS (SELECT item_id, w, len(w) AS size FROM item WHERE len(w) BETWEEN 1 AND {_W - 1}),
places AS (
  SELECT doc_id, size, w, unnest(range(len(w) - size + 1)) AS s
  FROM doc, (SELECT DISTINCT size FROM short) WHERE len(w) = size OR (len(w) > size AND size >= {_INSIDE})
),
found AS (
  SELECT doc_id, item_id, shift, s, {_W} AS size, equal FROM windows
  WHERE equal >= {_EQUAL} AND s >= 0 AND s + {_W} <= n AND s - shift >= 0 AND s - shift + {_W} <= m
  UNION ALL
  SELECT doc_id, item_id, s AS shift, s, p.size, p.size AS equal
  FROM places p JOIN short i ON p.size = i.size AND p.w[s + 1 : s + p.size] = i.w
)
SELECT doc_id, item_id, CAST(min(s) AS INTEGER) AS doc_start, CAST(max(s + size) AS INTEGER) AS doc_end,
  CAST(min(s - shift) AS INTEGER) AS item_start, count(*) AS n_windows, CAST(max(equal) AS INTEGER) AS max_equal
FROM found
GROUP BY doc_id, item_id, shift
"""

_TOLD = ", ".join(f"'{n}'" for n in perspectives.NARRATORS)
PERSPECTIVES = f"""
WITH turns AS (
  SELECT conv_id, turn, regexp_replace(trim(coalesce(role, '')), '\\s+', '_', 'g') AS named,
    replace(coalesce(text, ''), '<|im_', '< |im_') AS said
  FROM conversations
),
spoken AS (
  SELECT conv_id, turn, CASE WHEN named = '' THEN '{perspectives.UNKNOWN}' ELSE replace(named, '<|im_', '< |im_') END AS speaker, said
  FROM turns
),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM spoken WHERE speaker NOT IN ({_TOLD})),
views AS (
  SELECT s.conv_id, perspective, turn, speaker, said,
    CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker IN ({_TOLD}) THEN speaker ELSE 'user' END AS role,
    CASE WHEN speaker <> perspective AND speaker NOT IN ({_TOLD}) THEN speaker END AS name
  FROM spoken s JOIN people p ON s.conv_id IS NOT DISTINCT FROM p.conv_id
),
written AS (
  SELECT *, '{perspectives.OPEN}' || role || coalesce(' name=' || name, '') || chr(10) AS head FROM views
),
whole AS (SELECT *, head || said || '{perspectives.CLOSE}' || chr(10) AS segment FROM written),
placed AS (
  SELECT *, row_number() OVER o - 1 AS position,
    CAST(coalesce(sum(length(segment)) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM whole
  WINDOW o AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, md5(said))
)
SELECT conv_id, perspective, position, turn, role, name, segment, start, start + length(segment) AS stop,
  CASE WHEN role = 'assistant' THEN start + length(head) END AS mask_start,
  CASE WHEN role = 'assistant' THEN start + length(segment) - 1 END AS mask_stop
FROM placed
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS c
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
),
pairs AS (
  SELECT a.r AS ar, a.vec_id AS anchor_id, b.r AS br, b.vec_id AS id, a.label = b.label AS same,
    CAST(list_sum([coalesce(p[1] * p[2], 0) for p in list_zip(a.c, b.c)]) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.r <> b.r
),
near AS (
  SELECT ar, anchor_id, br, id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, id NULLS LAST, br) <= 5
)
SELECT n.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY n.ar, n.br ORDER BY p.score DESC, p.id NULLS LAST, p.br) AS INTEGER) AS rank,
  p.id AS negative_id, positive_score, p.score AS negative_score
FROM near n JOIN pairs p ON n.ar = p.ar AND NOT p.same AND 30 * positive_score <= 100 * p.score AND 100 * p.score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY n.ar, n.br ORDER BY p.score DESC, p.id NULLS LAST, p.br) <= 10
"""

SUBSTRINGS = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
windows AS (SELECT r, doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM places),
least AS (SELECT h, min(doc_id) AS first FROM windows GROUP BY h),
gone AS (SELECT DISTINCT r, i + k AS i FROM windows JOIN least USING (h), range(50) t(k) WHERE doc_id > first),
words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

COLLOCATIONS = r"""
WITH lowered AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
),
pieces AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM lowered),
words AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
places AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, range(1, 5) r(k)),
grams AS MATERIALIZED (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM places GROUP BY ALL),
sizes AS (SELECT lang, sum(f) AS n FROM grams WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE k > 1 AND f >= 30),
cut_at AS (SELECT *, unnest(range(1, k)) AS cut FROM candidates),
parts AS (SELECT lang, phrase, a, cut, array_to_string(w[1:cut], ' ') AS x, array_to_string(w[cut + 1:], ' ') AS y FROM cut_at),
cuts AS (
  SELECT p.lang, p.phrase, a, cut, g.f AS l, h.f AS r, CAST((CAST(2000000 AS HUGEINT) * a) // (CAST(g.f AS HUGEINT) + h.f) AS BIGINT) AS score
  FROM parts p JOIN grams g ON g.lang = p.lang AND g.phrase = x JOIN grams h ON h.lang = p.lang AND h.phrase = y
),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_phrases AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS most
  FROM (SELECT lang, w, a, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM candidates))
  GROUP BY ALL
),
kept AS (
  SELECT o.* FROM lowest o LEFT JOIN inner_phrases i USING (lang, phrase)
  WHERE most IS NULL OR CAST(100 AS HUGEINT) * most < CAST(80 AS HUGEINT) * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
  CAST(n AS BIGINT) AS n, score
FROM kept JOIN sizes USING (lang)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""

TEXTS = {"op13_collocations": COLLOCATIONS, "op12_substrings": SUBSTRINGS, "op11_hard_negatives": HARD_NEGATIVES, "op1_decontaminate": DECONTAMINATE, "op3_perspectives": PERSPECTIVES}
