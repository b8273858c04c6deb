"""DuckDB statements of the queries that SQL can express, written from the contracts."""

from __future__ import annotations

_OPEN, _BETWEEN = len("</s>[INST] "), len(" [/INST] ")
_ESCAPED = r"length(regexp_replace({}, '([\\<\[])', '\\\1', 'g'))"

OP3 = rf"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
),
sized AS (
  SELECT *, sum({_OPEN + _BETWEEN} + {_ESCAPED.format('role')} + {_ESCAPED.format('text')})
      OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS so_far,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS from_end
  FROM said
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(so_far) FILTER (WHERE role = 'assistant' OR from_end = 1) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

_ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_PATTERNS = (
    ("assign", 1, _ASSIGN, f"length(regexp_extract(hit, '{_ASSIGN}', 2)) >= 6"),
    ("access", 2, "AKIA[A-Z0-9]+", "length(hit) >= 20"),
    ("hex", 3, "[0-9a-f]+", "length(hit) >= 24"),
)
_HITS = " UNION ALL ".join(
    f"""SELECT doc_id, '{kind}' AS kind, {nth} AS nth, start, start + length(hit) AS stop FROM (
      SELECT doc_id, hits[i] AS hit, CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x)))
          + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS start
      FROM (SELECT doc_id, hits, gaps, unnest(range(1, len(hits) + 1)) AS i FROM (
        SELECT doc_id, regexp_extract_all(text, '{pattern}') AS hits, string_split_regex(text, '{pattern}') AS gaps
        FROM texts WHERE regexp_matches(text, '{screen}')))
    ) WHERE {long_enough}"""
    for (kind, nth, pattern, long_enough), screen in zip(
        _PATTERNS, (_ASSIGN, "AKIA[A-Z0-9]{16}", "[0-9a-f]{24}"), strict=True
    )
)
OP4 = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS ({_HITS}),
shown AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
    count(*) FILTER (WHERE kind = 'hex') AS n_hex,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, nth) AS spans
  FROM found GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN shown USING (doc_id)
"""

#: The seeds and bounds again, as the statement must not follow the operator's. Items shorter than a
#: seed are left out here: the benchmark tables hold none.
_MASKS = ("11101011", "110100111", "1100101101")


def _seeds(table: str, key: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {key}, {k} AS mask, pos, concat_ws(' ', "
        + ", ".join(f"words[pos + {i + 1}]" for i, c in enumerate(mask) if c == "1")
        + f") AS seed FROM (SELECT {key}, words, unnest(range(0, len(words) - {len(mask) - 1})) AS pos FROM {table}"
        + f" WHERE len(words) >= {len(mask)})"
        for k, mask in enumerate(_MASKS)
    )


_WORDS = r"string_split(trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')), ' ')"
OP7 = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS words FROM documents WHERE text IS NOT NULL),
items AS (SELECT item_id, {_WORDS} AS words FROM benchmark WHERE text IS NOT NULL),
asked AS ({_seeds('(SELECT * FROM items WHERE len(words) >= 10)', 'item_id')}),
windows AS ({_seeds('docs', 'doc_id')}),
hits AS (
  SELECT doc_id, item_id, windows.pos - asked.pos AS shift, least(len(items.words), 30) AS judged,
    greatest(0, least(asked.pos - 10, len(items.words) - least(len(items.words), 30))) AS first,
    docs.words AS said, items.words AS item
  FROM windows JOIN asked USING (mask, seed) JOIN docs USING (doc_id) JOIN items USING (item_id)
),
judged AS (
  SELECT doc_id, item_id, len(list_filter(range(first, first + judged),
      lambda q: q + shift >= 0 AND item[q + 1] = said[q + shift + 1])) / CAST(judged AS DOUBLE) AS similarity
  FROM hits
)
SELECT doc_id, item_id, count(*) AS n_hits, max(similarity) AS similarity
FROM judged WHERE similarity >= 0.8 GROUP BY doc_id, item_id
"""

#: Sums of lanes, three to a number 20 bits apart: of bit s, s + 20 and s + 40 of each of a hash's four words.
_LANES = [f"sum((('0x' || substr(h, {15 * w + 1}, 15))::BIGINT >> {s}) & {1 | 1 << 20 | 1 << 40})::BIGINT" for w in range(4) for s in range(20)]
_SIGNS = f"flatten(list_transform({{0}}.lanes, lambda x: list_transform([0, 20, 40], lambda j: 2 * ((x >> j) & {(1 << 19) - 1}) - {{0}}.n)))::DOUBLE[]"
_SHOWN = "printf('%015x', {0}.n) || array_to_string(list_transform({0}.lanes, lambda x: printf('%015x', x)), '')"
_NEAR = (
    "CASE WHEN {0}.squares + {1}.squares = 0 THEN 1.0 ELSE "
    "least(greatest(2 * list_inner_product({0}.signs, {1}.signs) / ({0}.squares + {1}.squares), 0.0), 1.0) END"
)
OP11 = rf"""
WITH ordered AS (
  SELECT doc_id, coalesce(text, '') AS text, lead(coalesce(text, '')) OVER (ORDER BY doc_id) AS behind,
    lead(doc_id) OVER (ORDER BY doc_id) AS next_id, first_value(coalesce(text, '')) OVER (ORDER BY doc_id) AS first_text,
    first_value(doc_id) OVER (ORDER BY doc_id) AS first_id FROM documents
),
docs AS (
  SELECT doc_id, text, coalesce(next_id, first_id) AS next_id,
    left(text, length(text) - length(text) // 2) || left(coalesce(behind, first_text), length(text) // 2) AS edited FROM ordered
),
versions AS (SELECT doc_id, 0 AS version, text FROM docs UNION ALL SELECT doc_id, 1, edited FROM docs),
parts AS (SELECT doc_id, version, sha256(unnest(regexp_extract_all(text, '[^\n]*?(?:\n|[.!?] )|[^\n]+'))) AS h FROM versions),
summed AS (SELECT doc_id, version, count(*) AS n, [{', '.join(_LANES)}] AS lanes FROM parts GROUP BY doc_id, version),
prints AS (
  SELECT v.doc_id, v.version, coalesce(s.n, 0) AS n, coalesce(s.lanes, list_transform(range(80), lambda x: 0::BIGINT)) AS lanes
  FROM versions v LEFT JOIN summed s USING (doc_id, version)
),
signed AS (SELECT *, {_SIGNS.format('prints')} AS signs FROM prints),
squared AS (SELECT *, list_inner_product(signs, signs) AS squares FROM signed)
SELECT d.doc_id, length(d.text) AS n_chars, sha256(d.edited) AS edited_sha256, {_SHOWN.format('a')} AS fingerprint,
  {_SHOWN.format('b')} AS edited_fingerprint, {_NEAR.format('a', 'b')} AS near_edited, {_NEAR.format('a', 'c')} AS near_next
FROM docs d JOIN squared a ON a.doc_id = d.doc_id AND a.version = 0 JOIN squared b ON b.doc_id = d.doc_id AND b.version = 1
  JOIN squared c ON c.doc_id = d.next_id AND c.version = 0
"""

#: A hex digit pair is a byte; a CRC-32 takes a byte at a time through a table that follows from its polynomial.
OP12 = r"""
WITH RECURSIVE crc_bits AS (
  SELECT i AS byte, i::BIGINT AS c, 0 AS bit FROM range(256) t(i) UNION ALL
  SELECT byte, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, bit + 1 FROM crc_bits WHERE bit < 8
),
steps AS (SELECT list(c ORDER BY byte) AS step FROM crc_bits WHERE bit = 8),
said AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark
),
split AS (
  SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM said
),
features AS (
  SELECT kind, id, unnest(words) AS feature FROM split UNION ALL
  SELECT kind, id, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) FROM split
),
counted AS (SELECT kind, id, feature, count(*) AS n FROM features GROUP BY ALL),
hashed AS (
  SELECT feature, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(x), 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT feature, hex(encode(feature)) AS x FROM (SELECT DISTINCT feature FROM counted)), steps
),
per_bucket AS (
  SELECT bucket, coalesce(sum(n) FILTER (WHERE kind = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (WHERE kind = 'b'), 0)::DOUBLE AS t
  FROM counted JOIN hashed USING (feature) GROUP BY bucket
),
totals AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM per_bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))))::BIGINT AS gain FROM per_bucket, totals
),
sums AS (
  SELECT id AS doc_id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS gain
  FROM counted JOIN hashed USING (feature) JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY id
),
weighed AS (
  SELECT doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features,
    coalesce((gain - ((gain % n_features) + n_features) % n_features) // n_features, 0)::BIGINT AS weight,
    floor(-1000 * ln(-ln((('0x' || left(sha256('7:' || doc_id), 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS noise
  FROM (SELECT id AS doc_id, words FROM split WHERE kind = 'd') LEFT JOIN sums USING (doc_id)
),
scored AS (SELECT *, weight + noise AS score, n_words >= 20 AS able FROM weighed),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY able) AS of FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 25 * of // 100 THEN place END AS rank FROM ranked
"""

OP13 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
runs AS (
  SELECT lang, k, unnest(list_transform(range(1, len(words) - k + 2), lambda i: array_to_string(words[i:i + k - 1], ' '))) AS phrase
  FROM split, range(1, 5) t(k) WHERE len(words) >= k
),
counted AS (SELECT lang, k, phrase, count(*) AS a FROM runs GROUP BY ALL HAVING count(*) >= 30),
totals AS (SELECT lang, sum(len(words))::BIGINT AS n FROM split GROUP BY lang),
able AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS words FROM counted WHERE k > 1),
parts AS (
  SELECT lang, phrase, a, cut, array_to_string(words[1:cut], ' ') AS first_part, array_to_string(words[cut + 1:], ' ') AS rest
  FROM able, range(1, 4) t(cut) WHERE cut < k
),
cuts AS (
  SELECT parts.lang, parts.phrase, parts.a, cut, x.a AS l, y.a AS r, (2000000 * parts.a::HUGEINT // (x.a + y.a))::BIGINT AS score
  FROM parts JOIN counted x ON x.lang = parts.lang AND x.phrase = first_part JOIN counted y ON y.lang = parts.lang AND y.phrase = rest
),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT DISTINCT able.lang, array_to_string(words[i:i + n - 1], ' ') AS phrase, a
  FROM able, range(2, 4) t(n), range(1, 4) u(i) WHERE n < k AND i + n - 1 <= k
),
covered AS (SELECT lang, phrase, max(a) AS most FROM inside GROUP BY ALL),
kept AS (
  SELECT best.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best LEFT JOIN covered USING (lang, phrase) WHERE coalesce(100 * most < 80 * a, true)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM kept JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLE = {
    "op3_chat": OP3,
    "op4_secrets": OP4,
    "op7_decontaminate": OP7,
    "op11_fingerprints": OP11,
    "op12_resample": OP12,
    "op13_collocations": OP13,
}
