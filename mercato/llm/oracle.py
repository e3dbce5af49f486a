"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from .disclosure import CARD, EMAIL, IP, PHONE
from .licenses import TEMPLATES
from .warc_store import HTTP, REVISIT_PROFILE

#: Words of a text: runs of characters other than ASCII white space.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS d, text FROM documents
), lines AS (
  SELECT r, d, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d
), split AS (
  SELECT r, d, i, regexp_extract_all(line, '[^ \\t\\x0b\\x0c\\r]+') AS own FROM lines
), masked AS (
  SELECT *, list_transform(own, lambda w: CASE WHEN regexp_matches(w, '[0-9]') THEN '<*>' ELSE w END) AS m FROM split
), tokens AS (
  SELECT r, d, i, CASE WHEN 2 * len(list_filter(m, lambda w: w = '<*>')) <= len(m) THEN m ELSE own END AS t FROM masked WHERE len(own) >= 2
), wordings AS (
  SELECT t, len(t) AS n, t[1:2] AS lead, min(d) AS lo, max(d) AS hi FROM tokens GROUP BY t
), shared AS (
  SELECT n, lead FROM wordings GROUP BY n, lead HAVING count(*) > 1 AND min(lo) < max(hi)
), places AS (
  SELECT t, n, lead, lo, hi, unnest(t) AS token, generate_subscripts(t, 1) AS place FROM wordings SEMI JOIN shared USING (n, lead)
), counted AS (
  SELECT *, count(*) OVER (PARTITION BY n, lead, place, token) AS held FROM places
), middle AS (
  SELECT *, list_sort(list(held) OVER (PARTITION BY t))[n // 2 + 1] AS median FROM counted
), learnt AS (
  SELECT t, n, lo, hi, string_agg(CASE WHEN literal THEN token ELSE '<*>' END, ' ' ORDER BY place) AS k
  FROM (SELECT *, held > 1 AND 2 * held >= median AND token <> '<*>' AS literal FROM middle)
  GROUP BY t, n, lead, lo, hi HAVING count(*) FILTER (literal) >= 3 AND 3 * count(*) FILTER (literal) >= 2 * n
), firsts AS (
  SELECT t, min(lo) AS first_doc FROM (
    SELECT t, lo FROM wordings UNION ALL SELECT t, min(lo) OVER (PARTITION BY n, k) FROM learnt) GROUP BY t
), gone AS (
  SELECT r, i FROM tokens JOIN firsts USING (t) WHERE first_doc < d
), kept AS (
  SELECT l.r, count(*) AS n_lines, count(g.r) AS n_dropped,
    coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE g.r IS NULL), '') AS kept
  FROM lines l LEFT JOIN gone g ON l.r = g.r AND l.i = g.i GROUP BY l.r
)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

OP2 = f"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents
), windows AS (
  SELECT r, i, array_to_string(ws[i:i + 34], ' ') AS g
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35)
), again AS (
  SELECT r, i FROM windows WHERE g IN (SELECT g FROM windows GROUP BY g HAVING count(*) > 1)
), gone AS (
  SELECT DISTINCT r, p FROM (SELECT r, unnest(range(i, i + 35)) AS p FROM again)
), kept AS (
  SELECT t.r, string_agg(t.x, ' ' ORDER BY t.p) AS kept, count(*) AS n
  FROM (SELECT r, unnest(ws) AS x, generate_subscripts(ws, 1) AS p FROM w) t
  LEFT JOIN gone g ON t.r = g.r AND t.p = g.p WHERE g.r IS NULL GROUP BY t.r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (r)
"""

_KINDS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}


def _spans(text: str, kind: str) -> str:
    """List of (start, end, value) of the valid matches of one kind."""
    pattern = _KINDS[kind]
    found, between = f"regexp_extract_all({text}, '{pattern}')", f"string_split_regex({text}, '{pattern}')"
    digits = "regexp_replace(x.v, '[^0-9]', '', 'g')"
    worth = f"[CASE WHEN j % 2 = 0 THEN {digits}[len({digits}) - j]::INT ELSE {digits}[len({digits}) - j]::INT * 2 - CASE WHEN {digits}[len({digits}) - j]::INT > 4 THEN 9 ELSE 0 END END FOR j IN range(0, len({digits}))]"
    valid = {
        "email": "true",
        "ip": "len(list_filter(string_split(x.v, '.'), lambda q: q::DOUBLE > 255)) = 0",
        "card": f"len({digits}) BETWEEN 16 AND 19 AND list_sum({worth}) % 10 = 0",
        "phone": f"len({digits}) BETWEEN 8 AND 15",
    }[kind]
    at = "coalesce(list_sum([len(q) FOR q IN b[1:i]]), 0) + coalesce(list_sum([len(q) FOR q IN f[1:i - 1]]), 0)"
    return (
        f"(SELECT coalesce(list({{'a': a, 'v': v}} ORDER BY a), []) FROM (SELECT f[i] AS v, ({at})::BIGINT AS a FROM "
        f"(SELECT {found} AS f, {between} AS b, unnest(range(1, len({found}) + 1)) AS i)) x WHERE {valid})"
    )


_ALL_SPANS = ", ".join(f"{_spans('t', k)} AS {k}" for k in _KINDS)
_SAME = {"email": "lower(x.v)", "ip": "x.v", "card": "regexp_replace(x.v, '[^0-9]', '', 'g')", "phone": "regexp_replace(x.v, '[^0-9]', '', 'g')"}
_ENTITIES = " || ".join(f"[concat('{k}:', {same}) FOR x IN {k}]" for k, same in _SAME.items())
_SPAN_TEXT = " || ".join(f"[concat('{k}:', x.a, ':', x.a + len(x.v)) FOR x IN {k}]" for k in _KINDS)
_ALL_PLACES = " || ".join(f"[{{'a': x.a, 'b': x.a + len(x.v)}} FOR x IN {k}]" for k in _KINDS)
_PUNCTUATION = "!\"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~"

OP3 = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), base AS (
  SELECT r, doc_id, t, {_ALL_SPANS} FROM d
), split AS (
  SELECT r, string_split(text, chr(10)) AS ls FROM (SELECT row_number() OVER () AS r, text FROM documents) WHERE text IS NOT NULL
), areas AS (
  SELECT array_to_string(ls[run * 16 + 1:run * 16 + 32], chr(10)) AS t
  FROM (SELECT ls, unnest(range(0, greatest(0, (len(ls) - 32 + 15) // 16) + 1)) AS run FROM split)
), spanned AS (
  SELECT t, {_ALL_SPANS} FROM areas
), placed AS (
  SELECT *, {_ALL_PLACES} AS bs,
    list_transform(string_split_regex(t, '[\x20\x09-\x0D]'), lambda w: {{'w': w, 'n': len(w) + 1}}) AS xs FROM spanned
), words AS (
  SELECT *, CASE WHEN len(bs) = 0 THEN [x.w FOR x IN xs] ELSE (
    SELECT list(w ORDER BY i) FROM (SELECT xs[i].w AS w, i, coalesce(sum(xs[i].n) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a
      FROM (SELECT unnest(range(1, len(xs) + 1)) AS i))
    WHERE len(list_filter(bs, lambda b: b.a < a + len(w) AND a < b.b)) = 0) END AS free FROM placed
), terms AS (
  SELECT t, email, ip, card, phone, list_distinct([trim(lower(w), '{_PUNCTUATION}') FOR w IN coalesce(free, [])] || ['']) AS ws FROM words
), mention AS (
  SELECT t, ws, unnest(list_distinct({_ENTITIES})) AS e FROM terms
), n_e AS (
  SELECT e, count(*) AS n_e FROM mention GROUP BY e
), meet AS (
  SELECT e, w, count(*) AS n_both FROM (SELECT e, t, unnest(ws) AS w FROM mention)
  WHERE w <> '' GROUP BY e, w HAVING count(DISTINCT t) >= 3
), n_w AS (
  SELECT w, count(*) AS n_w FROM (SELECT unnest(ws) AS w FROM terms) GROUP BY w
), total AS (
  SELECT count(*)::DOUBLE AS n FROM areas
), found AS (
  SELECT w FROM meet JOIN n_e USING (e) JOIN n_w USING (w), total
  GROUP BY w HAVING max(log2(n_both * total.n / (n_w * n_e)) / nullif(log2(total.n / n_e), 0)) >= 0.6
), hit AS (
  SELECT r, list({{'a': a, 'b': a + len(x)}} ORDER BY a) AS term FROM (
    SELECT r, x, trim(lower(x), '{_PUNCTUATION}') AS w,
      (sum(len(x) + 1) OVER (PARTITION BY r ORDER BY i) - len(x) - 1)::BIGINT AS a
    FROM (SELECT r, unnest(string_split_regex(t, '[\x20\x09-\x0D]')) AS x, generate_subscripts(string_split_regex(t, '[\x20\x09-\x0D]'), 1) AS i FROM d))
  WHERE w IN (SELECT w FROM found) GROUP BY r
), clear AS (
  SELECT r, list_filter(term, lambda x: len(list_filter({_ALL_PLACES}, lambda b: b.a < x.b AND x.a < b.b)) = 0) AS term FROM hit JOIN base USING (r)
)
SELECT doc_id, len(email)::BIGINT AS n_email, len(ip)::BIGINT AS n_ip, len(card)::BIGINT AS n_card, len(phone)::BIGINT AS n_phone,
  sha256(array_to_string({_SPAN_TEXT}, ',')) AS base_sha256, array_to_string({_SPAN_TEXT} || [concat('term:', x.a, ':', x.b) FOR x IN coalesce(term, [])], ',') AS spans
FROM base LEFT JOIN clear USING (r)
"""



def _record_id(page: str, nth: str) -> str:
    h = f"md5(concat_ws(':', payload_digest, coalesce({page}::VARCHAR, 'null'), {nth}))"
    return f"concat('<urn:uuid:', {h}[1:8], '-', {h}[9:12], '-', {h}[13:16], '-', {h}[17:20], '-', {h}[21:32], '>')"


_HTTP = "replace('" + HTTP.replace("\r\n", "|") + "', '|', chr(13) || chr(10))"
_URL = "replace(replace(coalesce(url, ''), chr(13), '%0D'), chr(10), '%0A')"

OP4 = f"""
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS payload_digest, chr(13) || chr(10) AS n FROM pages
), f AS (
  SELECT *, octet_length(encode(html))::BIGINT AS payload_bytes, min(page_id) OVER (PARTITION BY payload_digest) AS first_page,
    row_number() OVER (PARTITION BY payload_digest, page_id ORDER BY url NULLS FIRST) AS nth FROM p
), r AS (
  SELECT *, payload_bytes >= 100 AND NOT (page_id IS NOT DISTINCT FROM first_page AND nth = 1) AS again, {_HTTP} || payload_bytes || n || n AS http FROM f
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN first_page END AS refers_to,
  sha256(concat('WARC/1.1', n, 'WARC-Type: ', CASE WHEN again THEN 'revisit' ELSE 'response' END, n, 'WARC-Record-ID: ', {_record_id('page_id', 'nth')}, n,
    'WARC-Target-URI: ', {_URL}, n, 'WARC-Date: 1970-01-01T00:00:00Z', n, 'WARC-Payload-Digest: sha256:', payload_digest,
    CASE WHEN again THEN concat(n, 'WARC-Profile: {REVISIT_PROFILE}', n, 'WARC-Refers-To: ', {_record_id('first_page', '1')}) ELSE '' END, n,
    'Content-Type: application/http; msgtype=response', n, 'Content-Length: ', len(http) + CASE WHEN again THEN 0 ELSE payload_bytes END, n, n, http,
    CASE WHEN again THEN '' ELSE html END, n, n)) AS record_sha256
FROM r
"""

OP7 = f"""
WITH rows AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size,
         md5('11:' || coalesce(doc_id::VARCHAR, 'null')) AS digest
  FROM documents
), sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM sizes
), weighed AS (
  SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
         2 * source_size AS cap FROM ranked
), lined AS (
  SELECT *,
    coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS full_words,
    sum(weight) OVER (ORDER BY cap::DOUBLE / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS left_weight,
    (sum(source_size) OVER () * 150)::DOUBLE / 100.0 AS budget
  FROM weighed
), levelled AS (
  SELECT *, max((budget - full_words) / left_weight) OVER () AS level FROM lined
), goal AS (
  SELECT source, source_size, rank, least(weight * level, cap::DOUBLE) AS target FROM levelled
), placed AS (
  SELECT r.*, g.source_size, g.rank, g.target,
    (sum(r.size) OVER (PARTITION BY g.rank ORDER BY r.digest, r.size ROWS UNBOUNDED PRECEDING) - r.size)::BIGINT AS start
  FROM rows r JOIN goal g ON r.source IS NOT DISTINCT FROM g.source
), taken AS (
  SELECT *, start + size / 2.0::DOUBLE AS middle,
    CASE WHEN size > 0 AND start + size / 2.0::DOUBLE <= target THEN 1 ELSE 0 END
    + CASE WHEN size > 0 AND source_size + start + size / 2.0::DOUBLE <= target THEN 1 ELSE 0 END AS passes
  FROM placed
)
SELECT doc_id, size, source_size, target, (passes * size)::BIGINT AS taken,
  CASE WHEN passes > 0 THEN floor(1000000 * CASE (rank - 1) % 3
    WHEN 0 THEN 2 * (middle / target) / (1.5 + sqrt(2.25 - 2 * (middle / target)))
    WHEN 1 THEN middle / target
    ELSE 2 * (middle / target) / (0.5 + sqrt(0.25 + 2 * (middle / target))) END)::BIGINT END AS first_position_ppm
FROM taken
"""

_TEMPLATES = ", ".join(f"({i}, '{spdx}', '{text}')" for i, (spdx, text) in enumerate(TEMPLATES))
_SPLIT = r"string_split_regex(coalesce(text, ''), '\n|[.!?;:][ \t]+')"
_TERMS = r"regexp_extract_all(translate(seg, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x01-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP8 = f"""
WITH t AS (
  SELECT k, spdx, term, count(*) AS n
  FROM (SELECT k, spdx, unnest(regexp_extract_all(lower(body), '[a-z0-9]+')) AS term FROM (VALUES {_TEMPLATES}) v(k, spdx, body))
  GROUP BY ALL
), f AS (
  SELECT row_number() OVER () AS r, doc_id, concat_ws('/', coalesce(source, 'unknown'), coalesce(lang, 'unknown'), doc_id::VARCHAR) AS path,
    concat_ws('/', coalesce(source, 'unknown'), coalesce(lang, 'unknown')) AS directory, text FROM documents
), segs AS (
  SELECT r, s, {_TERMS} AS ts FROM (SELECT r, unnest({_SPLIT}) AS seg, generate_subscripts({_SPLIT}, 1) AS s FROM f)
), used AS (
  SELECT * FROM segs WHERE len(ts) > 0
), total AS (
  SELECT count(*) AS n FROM used
), tf AS (
  SELECT r, s, term, count(*) AS n FROM (SELECT r, s, unnest(ts) AS term FROM used) GROUP BY ALL
), df AS (
  SELECT term, count(*) AS n FROM tf WHERE term IN (SELECT term FROM t) GROUP BY term
), idf AS (
  SELECT term, ln((total.n + 1)::DOUBLE / (coalesce(df.n, 0) + 1)) + 1 AS w
  FROM (SELECT DISTINCT term FROM t) LEFT JOIN df USING (term), total
), norms AS (
  SELECT r, s, sqrt(sum(power(tf.n * coalesce(idf.w, ln(total.n + 1) + 1), 2))) AS norm
  FROM tf LEFT JOIN idf USING (term), total GROUP BY r, s
), tnorms AS (
  SELECT k, spdx, sqrt(sum(power(t.n * idf.w, 2))) AS norm FROM t JOIN idf USING (term) GROUP BY k, spdx
), cosines AS (
  SELECT tf.r, tf.s, t.k, sum(tf.n * idf.w * t.n * idf.w) AS dot
  FROM tf JOIN t USING (term) JOIN idf USING (term) GROUP BY tf.r, tf.s, t.k
), best AS (
  SELECT r, s, spdx, round(dot / (norms.norm * tnorms.norm), 6) AS cosine, c.k,
    row_number() OVER (PARTITION BY r, s ORDER BY round(dot / (norms.norm * tnorms.norm), 6) DESC, c.k) AS nth
  FROM cosines c JOIN norms USING (r, s) JOIN tnorms USING (k)
), hit AS (
  SELECT r, s, spdx, cosine, k, len(ts) AS n FROM best JOIN used USING (r, s) WHERE nth = 1 AND cosine >= 0.6
), own AS (
  SELECT r, first(spdx ORDER BY cosine DESC, k) AS license, max(cosine) AS cosine, sum(n) AS n FROM hit GROUP BY r
), sizes AS (
  SELECT r, sum(len(ts)) AS n FROM segs GROUP BY r
), files AS (
  SELECT f.*, o.license, o.cosine, o.n * 2 >= z.n AS is_file FROM f LEFT JOIN own o USING (r) LEFT JOIN sizes z USING (r)
), given AS (
  SELECT directory, first(license ORDER BY cosine DESC, path) AS license FROM files WHERE is_file GROUP BY directory
)
SELECT f.path, f.doc_id, coalesce(f.license, g.license) AS license,
  CASE WHEN f.license IS NOT NULL THEN 'own' WHEN g.license IS NOT NULL THEN 'inherited' END AS how, f.cosine,
  CASE WHEN f.license IS NULL THEN g.directory END AS inherited_from
FROM files f LEFT JOIN given g USING (directory)
"""

OP9 = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
    [translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FOR w IN {_WORDS}] AS ws FROM documents
), sets AS (
  SELECT r, doc_id, CASE WHEN len(ws) >= 3 THEN list_distinct([concat(ws[i], ' ', ws[i + 1], ' ', ws[i + 2]) FOR i IN range(1, len(ws) - 1)])
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS s FROM d
), grams AS (
  SELECT r, len(s) AS n, unnest(s) AS g FROM sets
), pairs AS (
  SELECT a.r AS a, b.r AS b FROM grams a JOIN grams b ON a.g = b.g AND a.r < b.r AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), links AS (
  SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reach AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), low AS (
  SELECT reach.a AS r, min(sets.doc_id) AS low FROM reach JOIN sets ON reach.b = sets.r GROUP BY reach.a
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, low) AS component_id FROM sets LEFT JOIN low USING (r)
"""

OP10 = f"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text, {_WORDS} AS ws FROM documents
), grams AS (
  SELECT r, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)
), hit AS (
  SELECT r, unnest([i, i + 1, i + 2]) AS p
  FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM grams) WHERE n >= 2
), repeats AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words FROM hit GROUP BY r
), lines AS (
  SELECT r, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM w
), m AS (
  SELECT w.doc_id, w.source, len(ws)::BIGINT AS n_words,
    length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w JOIN lines USING (r) LEFT JOIN repeats USING (r)
), f AS (
  SELECT *, n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed,
    n_symbols * 100 > n_words * 100 AS severe, n_symbols * 100 > n_words * 10 AS symbols,
    n_dup_lines * 100 > n_lines * 30 AS dup_lines,
    word_chars < n_words * 3 OR word_chars > n_words * 10 AS word_len
  FROM m
), hosts AS (
  SELECT source, count(*)::DOUBLE AS n, sum(symbols::INT)::DOUBLE AS s, sum(dup_lines::INT)::DOUBLE AS d, sum(word_len::INT)::DOUBLE AS l
  FROM f GROUP BY source
), fit AS (
  SELECT sum(s) / sum(n) AS ms, sum(d) / sum(n) AS md, sum(l) / sum(n) AS ml,
    var_pop(s / n) - sum(s) / sum(n) * (1 - sum(s) / sum(n)) * avg(1 / n) AS vs,
    var_pop(d / n) - sum(d) / sum(n) * (1 - sum(d) / sum(n)) * avg(1 / n) AS vd,
    var_pop(l / n) - sum(l) / sum(n) * (1 - sum(l) / sum(n)) * avg(1 / n) AS vl
  FROM hosts
), prior AS (
  SELECT ms, md, ml,
    CASE WHEN vs > 0 THEN least(greatest(ms * (1 - ms) / vs - 1, 1), 1e6) ELSE 1e6 END AS ks,
    CASE WHEN vd > 0 THEN least(greatest(md * (1 - md) / vd - 1, 1), 1e6) ELSE 1e6 END AS kd,
    CASE WHEN vl > 0 THEN least(greatest(ml * (1 - ml) / vl - 1, 1), 1e6) ELSE 1e6 END AS kl
  FROM fit
), rates AS (
  SELECT source, (s + ms * ks) / (n + ks) AS rs, (d + md * kd) / (n + kd) AS rd, (l + ml * kl) / (n + kl) AS rl
  FROM hosts, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR severe OR (symbols AND rs >= 0.5) OR (dup_lines AND rd >= 0.5) OR (word_len AND rl >= 0.5)) AS kept
FROM f JOIN rates r ON f.source IS NOT DISTINCT FROM r.source
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": OP1,
        "op2_substring_dedup": OP2,
        "op3_pii": OP3,
        "op4_warc": OP4,
        "op7_mixing": OP7,
        "op8_licenses": OP8,
        "op9_jaccard_join": OP9,
        "op10_quality_rules": OP10,
    }
