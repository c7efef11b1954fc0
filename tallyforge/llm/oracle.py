"""DuckDB texts for the queries that SQL can express over whole tables."""

from __future__ import annotations

WORD = r"'[^\x20\x09-\x0D]+'"
ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

STREAM_DEDUP = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY body ORDER BY length(t) DESC, doc_id) AS keep_id,
  count(*) OVER (PARTITION BY body) AS group_size,
  doc_id = first_value(doc_id) OVER (PARTITION BY body ORDER BY length(t) DESC, doc_id) AS kept,
  sha256(body) AS text_sha256 FROM d"""

QUALITY_LEDGER = rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {WORD}) AS w
  FROM documents),
grams AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i,
  unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2])) AS g FROM d WHERE len(w) > 2),
twice AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
inside AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM twice, (VALUES (0), (1), (2)) steps(o) GROUP BY doc_id),
m AS (SELECT d.doc_id, cast(len(w) AS bigint) AS n_words, cast(length(array_to_string(w, '')) AS bigint) AS word_chars,
  cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS bigint) AS n_symbols,
  list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, {WORD})) AS lines,
  length(t) - length(regexp_replace(t, '\p{{Lu}}', '', 'g')) AS capitals, coalesce(inside.n, 0) AS n_repeat_words
  FROM d LEFT JOIN inside ON inside.doc_id = d.doc_id),
e AS (SELECT *, length(array_to_string(lines, '')) AS line_chars, length(array_to_string(list_distinct(lines), '')) AS distinct_chars FROM m),
f AS (SELECT *, cast((n_words < 50)::int + 2 * (100 * n_repeat_words > 50 * n_words)::int + 4 * (10 * n_symbols > n_words)::int
  + 8 * (10 * (len(lines) - len(list_distinct(lines))) > 3 * len(lines))::int
  + 16 * (word_chars < 2 * n_words OR word_chars > 16 * n_words)::int + 32 * (2 * capitals > word_chars)::int
  + 64 * (n_words > 100000)::int + 128 * (10 * (line_chars - distinct_chars) > 3 * line_chars)::int AS bigint) AS failed FROM e)
SELECT doc_id, n_words, word_chars, n_symbols, cast(len(lines) - len(list_distinct(lines)) AS bigint) AS n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words
    OR 10 * (line_chars - distinct_chars) > 3 * line_chars
    OR word_chars < 2 * n_words OR word_chars > 16 * n_words OR 2 * capitals > word_chars) AS kept, failed, 'prose-2' AS policy FROM f"""

MINHASH = rf"""WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), {WORD}) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE len(w) WHEN 0 THEN [] WHEN 1 THEN w
  ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
sized AS (SELECT s.doc_id, g, n FROM s JOIN n USING (doc_id)),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM sized a JOIN sized b
    ON a.g = b.g AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)"""


#: Exact windows by their words joined; near ones among items all of whose words the document has, by alignments up to two words off.
DECONTAMINATION = rf"""WITH d AS (SELECT row_number() OVER () AS u, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), {ALNUM}) AS w FROM documents),
b AS (SELECT row_number() OVER () AS item, * FROM (SELECT DISTINCT item_id,
  regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), {ALNUM}) AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL)
  WHERE len(w) > 0),
win AS (SELECT item, item_id, s, least(10, len(w)) AS span, w[s + 1:s + least(10, len(w))] AS v
  FROM (SELECT *, unnest(range(len(w) - least(10, len(w)) + 1)) AS s FROM b)),
grams AS (SELECT u, i, span, array_to_string(w[i + 1:i + span], ' ') AS g FROM (
  SELECT u, w, span, unnest(range(len(w) - span + 1)) AS i FROM d, (SELECT DISTINCT span FROM win) k WHERE len(w) >= span)),
hits AS (SELECT u, i, grams.span, item_id FROM grams JOIN win ON g = array_to_string(v, ' ') AND grams.span = win.span),
hit AS (SELECT u, count(DISTINCT place) AS n FROM (SELECT u, unnest(range(i, i + span)) AS place FROM hits) GROUP BY u),
named AS (SELECT u, list_sort(list(DISTINCT cast(item_id AS varchar))) AS ids FROM hits GROUP BY u),
words AS (SELECT u, unnest(w) AS word, unnest(range(len(w))) AS pos FROM d),
wanted AS (SELECT item, item_id, s, span, unnest(v) AS word, unnest(range(span)) AS p FROM win),
possible AS (SELECT u, item, s FROM (SELECT DISTINCT u, word FROM words) JOIN (
    SELECT item, s, unnest(list_distinct(v)) AS word, len(list_distinct(v)) AS n FROM win) USING (word)
  GROUP BY u, item, s, n HAVING count(*) = n),
close AS (SELECT DISTINCT u, item_id FROM (SELECT u, item_id, s, item, span, pos - p + e AS place, p
    FROM possible JOIN wanted USING (item, s) JOIN words USING (u, word), (VALUES (-2), (-1), (0), (1), (2)) off(e))
  GROUP BY u, item_id, item, s, span, place HAVING count(DISTINCT p) = span),
near AS (SELECT u, count(DISTINCT item_id) AS n FROM close GROUP BY u)
SELECT doc_id, cast(len(w) AS bigint) AS n_words, coalesce(hit.n, 0) AS n_hit, cast(coalesce(len(ids), 0) AS bigint) AS n_items,
  sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated, coalesce(near.n, 0) AS n_near
FROM d LEFT JOIN hit ON hit.u = d.u LEFT JOIN named ON named.u = d.u LEFT JOIN near ON near.u = d.u"""


PHRASES = rf"""WITH d AS (SELECT row_number() OVER () AS u, coalesce(lang, 'und') AS lang,
  unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
total AS (SELECT lang, cast(sum(len(w)) AS hugeint) AS n FROM p GROUP BY lang),
f AS (SELECT lang, array_to_string(w[s:s + m - 1], ' ') AS phrase, m, count(*) AS f FROM (
    SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM p, (SELECT unnest(range(1, 6)) AS m) k WHERE len(w) >= m)
  GROUP BY lang, phrase, m HAVING count(*) >= 100),
c AS (SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS v FROM f WHERE m > 1),
cut AS (SELECT *, unnest(range(1, m)) AS k FROM c),
s AS (SELECT cut.lang, cut.phrase, v, cut.m, k, a, h.f AS l, t.f AS r, n, (1000 * cast(a AS hugeint) * n) // (cast(h.f AS hugeint) * t.f) AS score
  FROM cut JOIN f h ON h.lang = cut.lang AND h.phrase = array_to_string(v[1:k], ' ')
  JOIN f t ON t.lang = cut.lang AND t.phrase = array_to_string(v[k + 1:cut.m], ' ') JOIN total ON total.lang = cut.lang
  QUALIFY row_number() OVER (PARTITION BY cut.lang, cut.phrase ORDER BY score, k) = 1),
part AS (SELECT lang, a AS longer, array_to_string(v[i:i + j - 1], ' ') AS phrase FROM (
  SELECT *, unnest(range(1, m - j + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS j FROM c))),
covered AS (SELECT lang, phrase, max(longer) AS longer FROM part GROUP BY lang, phrase),
kept AS (SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank FROM s
  LEFT JOIN covered ON covered.lang = s.lang AND covered.phrase = s.phrase WHERE longer IS NULL OR 100 * longer < 100 * a)
SELECT lang, rank, phrase, a, l, r, cast(n AS bigint) AS n, cast(score AS bigint) AS score FROM kept WHERE rank <= 2000"""


def oracle_sql() -> dict[str, str]:
    return {"op4_stream_dedup": STREAM_DEDUP, "op6_minhash": MINHASH, "op8_quality_ledger": QUALITY_LEDGER,
            "op11_phrases": PHRASES, "op13_decontamination": DECONTAMINATION}
