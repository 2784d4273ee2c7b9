"""DuckDB SQL for the subpackage's queries, where SQL can express them.

The others have none: a trained network or classifier (op2, op10), fingerprints and
sampled paths (op1, op5), keyed characters (op3) and a maximum flow (op8). They are tested
against brute force, held-out labels or planted cases instead.
"""

from __future__ import annotations

from wardbook.llm import collocations, mixing, quality, substrings

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def mixing_sql() -> str:
    rules = mixing.MixRules()
    weights = "[" + ", ".join(map(str, rules.weights)) + "]"
    most = rules.most_copies
    return f"""
WITH sized AS (
  SELECT row_number() OVER () AS id, doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size FROM documents
), ordered AS (
  SELECT *, md5(concat_ws(':', '{rules.seed}', doc_id, size)) AS place FROM sized
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    {weights}[1 + (row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) - 1) % {len(rules.weights)}] AS weight
  FROM ordered GROUP BY source
), rooms AS (
  SELECT *, {most} * source_size AS room,
    sum({most} * source_size) OVER w AS room_before, sum(weight) OVER w AS weight_before,
    sum(source_size) OVER () AS all_size, sum(weight) OVER () AS all_weight
  FROM sources
  WINDOW w AS (ORDER BY {most} * source_size / weight, source COLLATE "binary" NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), marked AS (
  SELECT *, room < weight * ((all_size - coalesce(room_before, 0)) / (all_weight - coalesce(weight_before, 0))) AS stops
  FROM rooms
), targets AS (
  SELECT source, source_size,
    CASE WHEN stops THEN CAST(room AS DOUBLE) ELSE weight * (
      (all_size - sum(CASE WHEN stops THEN room ELSE 0 END) OVER ()) / sum(CASE WHEN stops THEN 0 ELSE weight END) OVER ()
    ) END AS target
  FROM marked
), queued AS (
  SELECT o.*, t.source_size, t.target,
    coalesce(sum(size) OVER (PARTITION BY o.source ORDER BY place, doc_id, size, id
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
  FROM ordered o JOIN targets t ON o.source IS NOT DISTINCT FROM t.source
), copies AS (
  SELECT id, size, (copy * source_size + earlier + size) / target AS finish, place, source
  FROM queued, range({most}) AS c(copy) WHERE size > 0 AND target > 0
), running AS (
  SELECT *, sum(size) OVER (ORDER BY finish, place, source NULLS FIRST ROWS UNBOUNDED PRECEDING) AS given,
    (SELECT sum(size) FROM ordered) AS budget
  FROM copies
), taken AS (
  SELECT id, sum(greatest(0, least(size, budget - (given - size)))) AS taken FROM running GROUP BY id
)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM queued LEFT JOIN taken USING (id)
"""


def substrings_sql() -> str:
    n = substrings.WINDOW_WORDS
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS id, doc_id, {_WORDS} AS words FROM documents
), windows AS (
  SELECT id, pos, md5(array_to_string(words[pos:pos + {n - 1}], ' ')) AS code
  FROM (SELECT id, words, unnest(range(1, len(words) - {n - 2})) AS pos FROM texts WHERE len(words) >= {n})
), repeated AS (
  SELECT id, pos FROM windows JOIN (SELECT code FROM windows GROUP BY code HAVING count(*) > 1) USING (code)
), covered AS (
  SELECT DISTINCT id, unnest(range(pos, pos + {n})) AS place FROM repeated
), placed AS (
  SELECT id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM texts
), kept AS (
  SELECT id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n
  FROM placed ANTI JOIN covered USING (id, place) GROUP BY id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (id)
"""


def url_filters_sql() -> str:
    host = r"nullif(rtrim(regexp_extract(lower(url), '^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), '.'), '')"
    return rf"""
WITH captures AS (
  SELECT page_id, url, {host} AS host,
    TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(((page_id * 7919) % 8784 + 8784) % 8784 AS INTEGER)) AS fetched_at
  FROM pages
), named AS (
  SELECT host AS pattern, 'host' AS category FROM captures
  UNION ALL
  SELECT array_to_string(string_split(host, '.')[-3:], '.'), 'domain' FROM captures WHERE len(string_split(host, '.')) > 3
  UNION ALL
  SELECT host || '/' || nullif(regexp_extract(lower(url), '^[a-z]+://[^/?#]*/([^/?#]+)/', 1), ''), 'folder' FROM captures
), patterns AS (
  SELECT pattern, max(category) AS category, CAST('0x' || substr(md5(pattern), 1, 8) AS BIGINT) AS code
  FROM named WHERE pattern IS NOT NULL GROUP BY pattern
), changes AS (
  SELECT pattern, 'add' AS action, code % 4000 AS hours, category FROM patterns WHERE code % 3 < 2
  UNION ALL SELECT pattern, 'remove', code % 4000 + 1500, NULL FROM patterns WHERE code % 2 = 0
  UNION ALL SELECT pattern, 'add', code % 4000 + 3000, 'again' FROM patterns WHERE code % 5 = 0
), intervals AS (
  SELECT pattern, action, category, TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(hours AS INTEGER)) AS valid_from,
    lead(TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(hours AS INTEGER))) OVER (PARTITION BY pattern ORDER BY hours) AS valid_until
  FROM changes
), found AS (
  SELECT page_id, i.pattern, i.category, i.valid_from,
    row_number() OVER (PARTITION BY page_id ORDER BY length(i.pattern) DESC) AS best
  FROM captures c JOIN intervals i
    ON i.action = 'add' AND i.valid_from <= c.fetched_at AND (i.valid_until IS NULL OR c.fetched_at < i.valid_until)
   AND (c.host = i.pattern OR suffix(c.host, '.' || i.pattern)
        OR (contains(i.pattern, '/') AND split_part(i.pattern, '/', 1) = c.host
            AND split_part(i.pattern, '/', 2) = split_part(regexp_extract(lower(c.url), '^[a-z][a-z0-9+.\-]*://[^/?#]*/+([^?#]*)', 1), '/', 1)))
)
SELECT page_id, url, fetched_at, host, pattern IS NOT NULL AS blocked, pattern, category, valid_from
FROM captures LEFT JOIN (SELECT * FROM found WHERE best = 1) USING (page_id)
"""


def quality_sql() -> str:
    rules, n = quality.Rules(), quality.WINDOW_WORDS
    words = r"len(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))"
    return rf"""
WITH texts AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS body, {_WORDS} AS words FROM documents
), windows AS (
  SELECT id, pos, array_to_string(words[pos:pos + {n - 1}], ' ') AS code
  FROM (SELECT id, words, unnest(range(1, len(words) - {n - 2})) AS pos FROM texts WHERE len(words) >= {n})
), repeated AS (
  SELECT id, pos FROM windows JOIN (SELECT id, code FROM windows GROUP BY id, code HAVING count(*) > 1) USING (id, code)
), covered AS (
  SELECT id, count(DISTINCT place) AS n FROM (SELECT id, unnest(range(pos, pos + {n})) AS place FROM repeated) GROUP BY id
), lines AS (
  SELECT id, unnest(string_split(body, chr(10))) AS line FROM texts
), judged AS (
  SELECT id, count(*) - count(DISTINCT line) AS n_dup_lines,
    sum(CASE WHEN fails THEN length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) ELSE 0 END) AS lost
  FROM (
    SELECT id, line,
      ({words} < {rules.short_line_words} AND NOT regexp_matches(line, {_quoted(quality.SENTENCE_END)}))
      OR ({words} <= {rules.navigation_words} AND regexp_matches(line, {_quoted(quality.NAVIGATION)}))
      OR regexp_matches(line, {_quoted(quality.BOILERPLATE)})
      OR len(regexp_extract_all(line, '{quality.SYMBOL}')) > {words} * CAST({rules.max_line_symbol_share} AS DOUBLE)
      OR contains(line, '{{') AS fails
    FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
  ) GROUP BY id
), base AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(body, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(body, '{quality.SYMBOL}')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, coalesce(lost, 0) AS lost
  FROM texts LEFT JOIN covered USING (id) LEFT JOIN judged USING (id)
), failed AS (
  SELECT *, n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_percent} * n_words AS base_failed FROM base
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND lost <= word_chars * CAST({rules.max_lost_share} AS DOUBLE) AS kept
FROM failed
"""


def collocations_sql() -> str:
    rules = collocations.PhraseRules()
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH cut AS (
  SELECT coalesce(lang, '{collocations.NO_LANGUAGE}') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), pieces AS (
  SELECT lang, w FROM (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM cut) WHERE len(w) > 0
), sizes AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang
), phrases AS (
  SELECT lang, words, phrase, count(*) AS a
  FROM (
    SELECT lang, words, unnest(list_transform(range(1, len(w) - words + 2),
      lambda i: array_to_string(w[i : i + words - 1], ' '))) AS phrase
    FROM pieces, range(1, {rules.longest} + 1) AS r(words) WHERE len(w) >= words
  ) GROUP BY lang, words, phrase HAVING count(*) >= {rules.least}
), cuts AS (
  SELECT lang, words, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS rest
  FROM (SELECT *, string_split(phrase, ' ') AS w FROM phrases WHERE words > 1), range(1, {rules.longest}) AS r(k)
  WHERE k < words
), scored AS (
  SELECT c.lang, c.words, c.phrase, c.a, k, x.a AS l, y.a AS r,
    CAST((1000000 * CAST(c.a AS HUGEINT) * c.a) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM cuts c JOIN phrases x ON x.lang = c.lang AND x.phrase = head JOIN phrases y ON y.lang = c.lang AND y.phrase = rest
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
  SELECT p.lang, array_to_string(w[i : i + n - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, string_split(phrase, ' ') AS w FROM phrases WHERE words > 2) p,
    range(2, {rules.longest}) AS r(n), range(1, {rules.longest}) AS s(i)
  WHERE n < words AND i + n - 1 <= words GROUP BY 1, 2
)
SELECT * FROM (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank,
    b.phrase, a, l, r, n, score
  FROM best b JOIN sizes USING (lang) LEFT JOIN longer x ON x.lang = b.lang AND x.phrase = b.phrase
  WHERE longer IS NULL OR 100 * longer < {rules.absorbed_percent} * a
) WHERE rank <= {rules.top}
"""


def statements() -> dict[str, str]:
    return {
        "op4_mixing": mixing_sql(),
        "op6_substrings": substrings_sql(),
        "op7_url_filters": url_filters_sql(),
        "op9_quality": quality_sql(),
        "op13_collocations": collocations_sql(),
    }
