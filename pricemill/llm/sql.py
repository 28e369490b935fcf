"""DuckDB SQL that must give the rows of the operators' queries."""

from pricemill.llm.personal_data import IBAN_LENGTHS, KINDS, LEAST_SCORE, LOWER, NEAR, RAISE, Kind, words

# Base32 of the SHA-1, five bits at a time; the largest page of each payload is the response.
WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (
  SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS hex FROM p
),
bits AS (
  SELECT DISTINCT hex, array_to_string(list_transform(range(1, 41), lambda i: right(bin(strpos('0123456789abcdef', hex[i]) - 1 + 16), 4)), '') AS b
  FROM d
),
b32 AS (
  SELECT hex, array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + list_sum(list_transform(range(0, 5), lambda j:
      CAST(substr(b, CAST(5 * i + j + 1 AS BIGINT), 1) AS BIGINT) * CAST(pow(2, 4 - j) AS BIGINT))) AS BIGINT), 1)), '') AS payload_digest
  FROM bits
),
t AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS top FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM t JOIN b32 USING (hex)
"""


def _proposals(number: int, kind: Kind) -> str:
    """Every match of a pattern with its place and the text around it, from the texts between the matches."""
    return f"""
  SELECT row, {number} AS number, '{kind.name}' AS kind, m[i] AS value, g[i] AS before, g[i + 1] AS after,
    coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0)
      + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS start,
    {kind.prior} AS prior, '{words(kind.raises)}' AS raises, '{words(kind.lowers)}' AS lowers, {kind.stays} AS stays
  FROM (
    SELECT row, m, g, unnest(range(1, len(m) + 1)) AS i FROM (
      SELECT row, regexp_extract_all(text, '{kind.proposes}') AS m, string_split_regex(text, '{kind.proposes}') AS g FROM d
    )
  )"""


_IBANS = ", ".join(f"'{country}': {length}" for country, length in IBAN_LENGTHS.items())

PERSONAL_DATA_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
proposed AS ({" UNION ALL ".join(_proposals(i, k) for i, k in enumerate(KINDS))}
),
sized AS (
  SELECT *, regexp_replace(value, '[^0-9]', '', 'g') AS digits, map {{{_IBANS}}}[value[1:2]] AS iban_length FROM proposed
),
ended AS (
  SELECT *, CASE WHEN kind = 'iban' AND value[iban_length + (iban_length - 1) // 4 + 1] = ' '
    THEN value[1:iban_length + (iban_length - 1) // 4] ELSE value END AS v FROM sized
),
placed AS (SELECT *, value[length(v) + 1:] || after AS behind, replace(v, ' ', '') AS account FROM ended),
checked AS (
  SELECT *, NOT regexp_matches(before, '[A-Za-z0-9+.-]$') AND NOT regexp_matches(behind, '^[-A-Za-z0-9]') AS alone FROM placed
),
valid AS (
  SELECT *, lower(right(before, {NEAR}) || ' ' || left(behind, {NEAR})) AS near FROM checked WHERE CASE kind
    WHEN 'email' THEN true
    WHEN 'ip' THEN len(list_filter(string_split(v, '.'), lambda x: length(ltrim(x, '0')) > 3 OR (length(ltrim(x, '0')) = 3 AND ltrim(x, '0') > '255'))) = 0
    WHEN 'card' THEN length(digits) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1), lambda i:
      CASE WHEN (length(digits) - i) % 2 = 0 THEN CAST(digits[i] AS INT)
           ELSE CAST(digits[i] AS INT) * 2 % 10 + CAST(digits[i] AS INT) * 2 // 10 END)) % 10 = 0
    WHEN 'phone' THEN length(digits) BETWEEN 9 AND 15
    WHEN 'iban' THEN alone AND length(account) = iban_length AND list_reduce(list_transform(
      string_split('0' || account[5:] || account[1:4], ''), lambda x: strpos('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', x) - 1),
      lambda r, x: CASE WHEN x > 9 THEN (r * 100 + x) % 97 ELSE (r * 10 + x) % 97 END) = 1
    WHEN 'ssn' THEN alone AND length(v) = 11 AND v[1:3] NOT IN ('000', '666') AND v[1] <> '9' AND v[5:6] <> '00' AND v[8:11] <> '0000'
    WHEN 'tel' THEN alone AND NOT regexp_matches(before, '[+][0-9]{{1,3}}[ .(-]{{0,2}}$')
  END
),
spans AS (
  SELECT *, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + length(v) AS BIGINT) AS span FROM valid
  WHERE stays OR round(least(1.0, greatest(0.0, prior + CASE WHEN regexp_matches(near, raises) THEN {RAISE} ELSE 0.0 END
    - CASE WHEN regexp_matches(near, lowers) THEN {LOWER} ELSE 0.0 END)), 2) >= {LEAST_SCORE}
),
listed AS (
  SELECT row, {", ".join(f"count(*) FILTER (kind = '{k.name}') AS n_{k.name}" for k in KINDS)},
    string_agg(span, ',' ORDER BY number, start) FILTER (stays) AS base, string_agg(span, ',' ORDER BY number, start) AS spans
  FROM spans GROUP BY row
)
SELECT doc_id, {", ".join(f"coalesce(n_{k.name}, 0) AS n_{k.name}" for k in KINDS)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN listed USING (row)
"""
