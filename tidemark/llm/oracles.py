"""DuckDB SQL of the queries that SQL can express, written from the contracts, not the plans.

Token counts need a tokenizer's file and toxicity is learned; tests hold the first against brute force
and the second against labels it did not see.
"""

from __future__ import annotations

from tidemark.llm import licenses, mixing, quality, sharding
from tidemark.llm.common import ALNUM, LOWER, SPACED, UPPER

ORACLES: dict[str, str] = {}


def _lower(x: str) -> str:
    return f"translate(coalesce({x}, ''), '{UPPER}', '{LOWER}')"


def _alnum(x: str) -> str:
    return f"regexp_extract_all({_lower(x)}, '{ALNUM}')"


def _spaced(x: str) -> str:
    return f"regexp_extract_all(coalesce({x}, ''), '{SPACED}')"


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_NOTICES = ", ".join(
    f"({i}, '{n.label}', {n.phrase}, {n.needed}, {len(set(n.words))}, {len(n.words)}, "
    f"'{' '.join(n.words)}', {_list(sorted(set(n.words)))})"
    for i, n in enumerate(licenses.NOTICES)
)
ORACLES["op1_license_scan"] = f"""
WITH notices(notice, label, phrase, needed, size, length, seq, words) AS (VALUES {_NOTICES}),
d AS (SELECT doc_id, {_alnum('text')} AS w FROM documents),
tok AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS p FROM d),
nw AS (SELECT notice, unnest(words) AS word FROM notices),
hit AS (SELECT doc_id, p, notice, word FROM tok JOIN nw USING (word)),
blocks AS (
  SELECT doc_id, p // 32 AS b, notice, word FROM hit
  UNION SELECT doc_id, p // 32 - 1, notice, word FROM hit WHERE p >= 32
),
share AS (
  SELECT doc_id, b, notice, count(DISTINCT word) AS n FROM blocks GROUP BY ALL
),
near AS (SELECT doc_id, label, n / size AS score FROM share JOIN notices USING (notice)
         WHERE n >= needed AND NOT phrase),
places AS (
  SELECT doc_id, label, p FROM (SELECT DISTINCT doc_id, p, notice FROM hit) h
  JOIN notices USING (notice) JOIN d USING (doc_id)
  WHERE phrase AND array_to_string(w[p + 1 : p + length], ' ') = seq
),
base AS (
  SELECT doc_id, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY doc_id
),
every AS (SELECT doc_id, label, score FROM near
          UNION ALL SELECT doc_id, label, 1.0 FROM places),
labels AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
           max(score) AS score FROM every GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN labels USING (doc_id)
"""

ORACLES["op2_sharding"] = f"""
WITH s AS (
  SELECT doc_id, CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR),
    'text:' || coalesce(text, ''))), 1, 12) AS BIGINT) % {sharding.SLOTS} AS INTEGER) AS slot
  FROM documents
)
SELECT doc_id, slot, 'shard-' || lpad(
  string_split('{','.join(map(str, sharding.slot_table()))}', ',')[slot + 1], 3, '0') AS shard
FROM s
"""

ORACLES["op4_repeated_spans"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
wins AS (
  SELECT doc_id, i, md5(substr(x, 2 * i + 1, 400)) AS h FROM (
    SELECT doc_id, x, unnest(range(CAST(length(x) / 2 - 199 AS BIGINT))) AS i
    FROM d WHERE length(x) >= 400)
),
twice AS (SELECT h FROM wins GROUP BY h HAVING count(*) > 1),
starts AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before
           FROM wins SEMI JOIN twice USING (h)),
runs AS (SELECT doc_id, i, sum(CASE WHEN before + 200 >= i THEN 0 ELSE 1 END)
           OVER (PARTITION BY doc_id ORDER BY i) AS run FROM starts),
spans AS (SELECT doc_id, run, min(i) AS lo, max(i) + 200 AS hi FROM runs GROUP BY ALL),
ends AS (SELECT *, lag(hi, 1, 0) OVER (PARTITION BY doc_id ORDER BY run) AS since FROM spans),
cut AS (
  SELECT doc_id, count(*) AS n_spans, sum(hi - lo) AS n_removed, max(hi) AS upto,
    string_agg(substr(x, 2 * since + 1, 2 * (lo - since)), '' ORDER BY run) AS kept
  FROM ends JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, CAST(length(x) / 2 AS BIGINT) AS n_bytes,
  CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(x, 2 * coalesce(upto, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""

ORACLES["op5_warc"] = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
             sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100
        THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM f
"""


def _escaped_length(x: str) -> str:
    controls = " + ".join(
        f"(length({x}) - length(replace({x}, '{c}', ''))) // {len(c)}"
        for c in ("<s>", "</s>", "[INST]", "[/INST]")
    )
    return f"length({x}) + length({x}) - length(replace({x}, '\\', '')) + {controls}"


ORACLES["op6_chat_formatting"] = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'),
                                  (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
),
g AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, role, text)
      FILTER (WHERE role = 'assistant'), '') AS loss,
    sum({_escaped_length('role')} + {_escaped_length('text')} + 20) AS chars
  FROM t GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars FROM g
"""

ORACLES["op7_ngram_jaccard"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_lower('text')}, '{SPACED}') AS w
                     FROM documents),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + 5], ' ') AS g FROM (
    SELECT doc_id, w, unnest(range(greatest(1, len(w) - 4))) AS i FROM d WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM sets a JOIN sets b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 75 * (max(x.n) + max(y.n) - count(*))
),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles,
  least(doc_id, coalesce((SELECT min(b) FROM reach WHERE a = doc_id), doc_id)) AS component_id
FROM d LEFT JOIN sizes USING (doc_id)
"""

_SIZE = 1 << 20
ORACLES["op8_mixing"] = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len({_spaced('text')}) AS BIGINT) AS size,
    md5(concat_ws('|', coalesce(CAST(doc_id AS VARCHAR), 'null'), coalesce(source, ''),
      coalesce(text, ''))) AS tie FROM documents
),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM d GROUP BY source
),
levels AS (
  SELECT CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0) AS DOUBLE)
    / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS level
  FROM s WINDOW before AS (ORDER BY 3 * source_size / weight, source
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
t AS (SELECT *, least(CAST(3 * source_size AS DOUBLE), weight * (SELECT max(level) FROM levels))
        AS target FROM s),
r AS (SELECT *, CAST(round(coalesce(target / nullif(source_size, 0), 1) * {_SIZE}) AS BIGINT)
        AS step FROM t),
e AS (
  SELECT d.*, source_size, target, step,
    CAST('0x' || substr(tie, 1, 5) AS BIGINT) AS a,
    CAST('0x' || substr(tie, 6, 5) AS BIGINT) * 2 + 1 AS b
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
),
tries AS (
  SELECT source, k, abs(sum(size * ((step + (a + k * b) % {_SIZE}) // {_SIZE})) - max(target))
    AS away FROM e CROSS JOIN range({mixing.TRIES}) x(k) GROUP BY source, k
),
best AS (SELECT source, k FROM tries
         QUALIFY row_number() OVER (PARTITION BY source ORDER BY away, k) = 1)
SELECT doc_id, size, source_size, target,
  CAST(size * ((step + (a + k * b) % {_SIZE}) // {_SIZE}) AS BIGINT) AS taken,
  CAST((step + (a + k * b) % {_SIZE}) // {_SIZE} AS BIGINT) AS copies
FROM e JOIN best ON e.source IS NOT DISTINCT FROM best.source
"""


def _sql(expr: str) -> str:
    return expr.replace(" div ", " // ")


_SHIFT = "greatest(0, length(bin(v)) - 5)"
def _level(group: str) -> str:
    by = f"{group}, measure" if group else "measure"
    return f"""
  SELECT {by}, docs, least(cap, high + {quality.FENCE} * greatest(high - low, least)) AS top FROM (
    SELECT {by}, max(docs) AS docs, any_value(least) AS least, any_value(cap) AS cap,
      min(floor_) FILTER (WHERE 100 * upto >= docs * low_at) AS low,
      min(floor_) FILTER (WHERE 100 * upto >= docs * high_at) AS high FROM (
      SELECT *, count(*) OVER (PARTITION BY {by}) AS docs,
        count(*) OVER (PARTITION BY {by} ORDER BY floor_) AS upto FROM v) GROUP BY {by})"""


_MEASURES = " UNION ALL ".join(
    f"SELECT doc_id, lang, source, '{name}' AS measure, {_sql(expr)} AS v, {least} AS least, "
    f"{low} AS low_at, {high} AS high_at, {quality.CEILINGS.get(name, 10 ** 18)} AS cap FROM base"
    for name, (expr, least, low, high) in quality.MEASURES.items()
)
ORACLES["op9_quality_rules"] = rf"""
WITH d AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text, {_spaced('text')} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents
),
grams AS (
  SELECT doc_id, i, array_to_string(w[i + 1 : i + 5], ' ') AS g FROM (
    SELECT doc_id, w, unnest(range(len(w) - 4)) AS i FROM d WHERE len(w) >= 5)
),
twice AS (SELECT doc_id, i FROM grams
          QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
          SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY doc_id),
base AS (
  SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT)
      AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words
  FROM d LEFT JOIN rep USING (doc_id)
),
failed AS (SELECT doc_id FROM base WHERE n_words < 10 OR 100 * n_repeat_words > 20 * n_words),
m AS ({_MEASURES}),
v AS (SELECT *, (v >> {_SHIFT}) << {_SHIFT} AS floor_ FROM m ANTI JOIN failed USING (doc_id)),
l0 AS ({_level('lang, source')}), l1 AS ({_level('lang')}), l2 AS ({_level('')}),
out AS (
  SELECT m.doc_id, m.measure FROM m
  LEFT JOIN l0 ON m.measure = l0.measure AND m.lang IS NOT DISTINCT FROM l0.lang
    AND m.source IS NOT DISTINCT FROM l0.source
  LEFT JOIN l1 ON m.measure = l1.measure AND m.lang IS NOT DISTINCT FROM l1.lang
  LEFT JOIN l2 ON m.measure = l2.measure
  WHERE m.v > CASE WHEN l0.docs >= {quality.MIN_GROUP} THEN l0.top
    WHEN l1.docs >= {quality.MIN_GROUP} THEN l1.top ELSE l2.top END
),
why AS (SELECT doc_id, arg_min(measure, list_position(
          {_list(quality.MEASURES)}, measure)) AS measure FROM out GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  f.doc_id IS NOT NULL AS base_failed,
  f.doc_id IS NULL AND measure IS NULL AS kept,
  CASE WHEN n_words < 10 THEN 'words' WHEN f.doc_id IS NOT NULL THEN 'repeats'
    ELSE measure END AS failed
FROM base LEFT JOIN failed f USING (doc_id) LEFT JOIN why USING (doc_id)
"""

ORACLES["op10_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_alnum('text')} AS w FROM documents),
it AS (SELECT item_id, {_alnum('text')} AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, l, array_to_string(w[i + 1 : i + l], ' ') AS g FROM (
    SELECT item_id, w, least(13, len(w)) AS l,
      unnest(range(len(w) - least(13, len(w)) + 1)) AS i FROM it WHERE len(w) > 0)
),
dwins AS (
  SELECT doc_id, i, l, array_to_string(w[i + 1 : i + l], ' ') AS g FROM (
    SELECT doc_id, w, l, unnest(range(greatest(0, len(w) - l + 1))) AS i
    FROM d CROSS JOIN (SELECT DISTINCT l FROM wins))
),
hits AS (SELECT doc_id, i, l, item_id FROM dwins JOIN wins USING (g, l)),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
        SELECT doc_id, unnest(range(i, i + l)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
            string_agg(DISTINCT CAST(item_id AS VARCHAR), ','
              ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLES["op11_filter_audit"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS x,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
  FROM documents
),
f AS (
  SELECT part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS tox, [
    len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w),
    100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 10 * length(x),
    regexp_matches(x, '[#$%&*|]'), coalesce(doc_id > first_id, false)] AS fails
  FROM d LEFT JOIN labels USING (doc_id)
),
profiles AS (SELECT part, good, tox, fails, count(*) AS n FROM f GROUP BY ALL),
letters AS (SELECT unnest(range(1, 6)) AS i),
orders AS (
  SELECT [a.i, b.i, c.i, e.i, g.i] AS o FROM letters a, letters b, letters c, letters e, letters g
  WHERE len(list_distinct([a.i, b.i, c.i, e.i, g.i])) = 5
),
steps AS (SELECT o, unnest(range(1, 6)) AS step FROM orders),
told AS (
  SELECT part, o, step, n, good, tox, fails[o[step]] AS here,
    list_bool_or([fails[o[j]] FOR j IN range(1, step)]) IS NOT DISTINCT FROM true AS before,
    len(list_filter(fails, LAMBDA y: y)) AS n_fails
  FROM profiles, steps
),
counts AS (
  SELECT part, o, step,
    sum(n) FILTER (NOT here AND NOT before) AS kept, sum(n) FILTER (here AND NOT before) AS removed,
    sum(n) FILTER (here AND before) AS redundant, sum(n) FILTER (here AND n_fails = 1) AS unique_fails,
    sum(n) FILTER (here AND NOT before AND good) AS good_lost,
    sum(n) FILTER (here AND NOT before AND tox) AS toxic_lost
  FROM told GROUP BY ALL
)
SELECT part, array_to_string([substr('ABCDE', i, 1) FOR i IN o], '') AS filter_order,
  CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept,
  CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
  CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
  CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(sum(removed) OVER (PARTITION BY part, o[step]), 0) AS BIGINT) AS shapley
FROM counts
"""

ORACLES["op13_collocations"] = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array({_lower('text')}, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 4) AS s(k))
),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE k > 1 AND f >= 10),
parts AS (
  SELECT lang, phrase, a, cut, array_to_string(w[1 : cut], ' ') AS head,
    array_to_string(w[cut + 1 : k], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM cand)
),
total AS (SELECT lang, phrase AS part, f FROM f),
lefts AS (SELECT p.*, t.f AS l FROM parts p JOIN total t ON t.lang = p.lang AND t.part = p.head),
cuts AS (
  SELECT p.*, t.f AS r, (1000000 * CAST(a AS HUGEINT) * a) // (CAST(l AS HUGEINT) * t.f) AS score
  FROM lefts p JOIN total t ON t.lang = p.lang AND t.part = p.rest
),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_pairs AS (
  SELECT lang, unnest([array_to_string(w[1 : 2], ' '), array_to_string(w[2 : 3], ' ')]) AS phrase, a
  FROM cand WHERE k = 3
),
cover AS (SELECT lang, phrase, max(a) AS longer FROM inner_pairs GROUP BY ALL),
ranked AS (
  SELECT lang, phrase, a, l, r, score,
    row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
  FROM best LEFT JOIN cover USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
