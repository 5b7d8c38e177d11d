"""The registered queries in SQL for DuckDB, where SQL can express them. They take ids of documents and pages as unique."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str, between: str) -> str:
    lowered = f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"
    return f"list_filter(string_split_regex({lowered}, '{between}'), lambda w: w <> '')"


_SPACE = r"[\x20\x09-\x0D]+"
_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT body, min(page_id) AS first FROM p GROUP BY body)
SELECT page_id, cast(strlen(p.body) as bigint) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((cast('0x' || substr(digest, cast((j // 4) * 5 + 1 as bigint), 5) as bigint)
                 >> cast(15 - 5 * (j % 4) as integer)) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN f ON p.body = f.body
"""

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_words("text", _NO_WORD)} AS words FROM documents),
b AS (SELECT item_id, {_words("text", _NO_WORD)} AS words FROM benchmark),
c AS (SELECT item_id, words, least(10, len(words)) AS n, unnest(range(0, len(words) - least(10, len(words)) + 1)) AS i
      FROM b WHERE len(words) > 0),
w AS (SELECT DISTINCT item_id, n, array_to_string(words[i + 1:i + n], ' ') AS win FROM c),
p AS (SELECT doc_id, words, n, unnest(range(0, greatest(0, len(words) - n + 1))) AS i
      FROM d, (SELECT DISTINCT n FROM w)),
h AS (SELECT doc_id, i, p.n, item_id FROM (SELECT *, array_to_string(words[i + 1:i + n], ' ') AS win FROM p) p
      JOIN w ON p.n = w.n AND p.win = w.win),
t AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM h) GROUP BY doc_id),
s AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
      FROM (SELECT DISTINCT doc_id, cast(item_id as varchar) AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, cast(len(words) as bigint) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN t USING (doc_id) LEFT JOIN s USING (doc_id)
"""

REPEATED_TEXT = """
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS k
      FROM (SELECT doc_id, h, unnest(range(0, greatest(0, len(h) // 2 - 199))) AS i FROM t)),
m AS (SELECT doc_id, i FROM s WHERE k IN (SELECT k FROM s GROUP BY k HAVING count(*) > 1)),
g AS (SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200, true) AS fresh FROM m),
n AS (SELECT doc_id, i, sum(fresh::int) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g),
r AS (SELECT doc_id, min(i) AS b, max(i) + 200 AS e FROM n GROUP BY doc_id, run),
l AS (SELECT doc_id, list(b ORDER BY b) AS bs, list(e ORDER BY b) AS es, count(*) AS n_spans, sum(e - b) AS n_removed
      FROM r GROUP BY doc_id)
SELECT t.doc_id, len(h) // 2 AS n_bytes, cast(coalesce(n_removed, 0) as bigint) AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN bs IS NULL THEN h ELSE array_to_string(list_transform(range(0, len(bs) + 1), lambda k:
           CASE WHEN k = len(bs) THEN substr(h, 2 * es[k] + 1)
                WHEN k = 0 THEN substr(h, 1, 2 * bs[1])
                ELSE substr(h, 2 * es[k] + 1, 2 * (bs[k + 1] - es[k])) END), '') END)) AS kept_sha256
FROM t LEFT JOIN l USING (doc_id)
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_words("text", _SPACE)} AS words FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(0, len(words) - 2), lambda i: array_to_string(words[i + 1:i + 3], ' ')) END) AS sh FROM d),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS n_both
      FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c WHERE 100 * n_both >= 85 * (na + nb - n_both)),
u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, other) AS (SELECT a, a FROM u UNION SELECT r.doc_id, u.b FROM r JOIN u ON r.other = u.a),
m AS (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id)
SELECT s.doc_id, cast(len(sh) as bigint) AS n_shingles, coalesce(component_id, s.doc_id) AS component_id,
       s.doc_id = coalesce(component_id, s.doc_id) AS kept
FROM s LEFT JOIN m ON s.doc_id = m.doc_id
"""

_NO_TERM = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

NORM_SEARCH = f"""
WITH d AS (SELECT doc_id, {_words("text", _NO_TERM)} AS terms FROM documents),
b AS (SELECT item_id, list_distinct({_words("text", _NO_TERM)}) AS terms FROM benchmark),
s AS (SELECT cast(count(*) FILTER (len(terms) > 0) as bigint) AS all_docs, cast(sum(len(terms)) as bigint) AS all_terms FROM d),
p AS (SELECT doc_id, term, count(*) AS tf, any_value(n) AS n
      FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY doc_id, term),
q AS (SELECT item_id, unnest(terms) AS term FROM b),
w AS (SELECT term, cast(floor(1000 * ln((2 * any_value(all_docs) + 2) / (2 * count(*) + 1))) as bigint) AS w
      FROM p, s WHERE term IN (SELECT term FROM q) GROUP BY term),
i AS (SELECT doc_id, p.term, w.w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * all_docs) // all_terms)))) AS impact
      FROM p JOIN w ON p.term = w.term, s),
r AS (SELECT item_id, doc_id, cast(sum(impact) as bigint) AS score FROM q JOIN i ON q.term = i.term GROUP BY item_id, doc_id)
SELECT item_id, cast(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) as int) AS rank, doc_id, score
FROM r WHERE score > 0 QUALIFY rank <= 50
"""

_PIECES = f"string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')"
_PARTS_OF_PIECE = r"list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '')"
_SCORE = "(1000::hugeint * a * n) // (l::hugeint * r)"

COLLOCATIONS = f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest({_PIECES}) AS piece FROM documents),
w AS (SELECT lang, {_PARTS_OF_PIECE} AS words FROM p),
z AS (SELECT lang, cast(sum(len(words)) as bigint) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, words, unnest(range(0, len(words) - k + 1)) AS i FROM w, range(1, 6) t(k) WHERE len(words) >= k),
f AS (SELECT lang, k, array_to_string(words[i + 1:i + k], ' ') AS phrase, count(*) AS f FROM g GROUP BY 1, 2, 3
      HAVING count(*) >= 100),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE k > 1),
u AS (SELECT c.*, unnest(range(1, k)) AS cut FROM c),
x AS (SELECT u.lang, u.phrase, u.k, u.a, cut, h.f AS l, t.f AS r, z.n FROM u
      JOIN f h ON h.lang = u.lang AND h.k = cut AND h.phrase = array_to_string(words[1:cut], ' ')
      JOIN f t ON t.lang = u.lang AND t.k = u.k - cut AND t.phrase = array_to_string(words[cut + 1:u.k], ' ')
      JOIN z ON z.lang = u.lang),
b AS (SELECT lang, phrase, a, l, r, n, cast({_SCORE} as bigint) AS score FROM x
      QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY {_SCORE}, cut) = 1),
o AS (SELECT lang, a, k, words, unnest(range(2, k)) AS size FROM c),
s AS (SELECT lang, a, size, words, unnest(range(0, k - size + 1)) AS i FROM o),
v AS (SELECT lang, array_to_string(words[i + 1:i + size], ' ') AS phrase, max(a) AS cover FROM s GROUP BY 1, 2)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, n, score
FROM b LEFT JOIN v ON v.lang = b.lang AND v.phrase = b.phrase WHERE coalesce(100 * cover < 100 * a, true) QUALIFY rank <= 2000
"""
