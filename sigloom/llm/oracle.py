"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from sigloom.llm import licences
from sigloom.llm.secrets import BASE_RULES, RULES

# The expressions of the rules as DuckDB needs them: only ASCII letters count in either case.


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_either_case, ("password", "passwd", "secret", "token"))) + "|" + _either_case("api") + "_?" + _either_case("key")
_PATTERNS = {r.kind: r.pattern for r in RULES} | {
    "assign": rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
}


def _matches(place: int, kind: str, group: int, least: int) -> str:
    pattern = _PATTERNS[kind].replace("'", "''")
    return f"""
    SELECT row, {place} AS place, '{kind}' AS kind, begin, begin + length(hits[i]) AS finish FROM (
      SELECT row, i, hits, parts, CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x)))
             + coalesce(list_sum(list_transform(hits[1:i-1], lambda x: length(x))), 0) AS BIGINT) AS begin
      FROM (SELECT row, hits, gaps, parts, unnest(range(1, len(hits) + 1)) AS i FROM (
        SELECT row, regexp_extract_all(t, '{pattern}') AS hits, string_split_regex(t, '{pattern}') AS gaps,
               regexp_extract_all(t, '{pattern}', {group}) AS parts FROM rows_))
    ) WHERE length(parts[i]) >= {least}"""


_SPANS = "\n    UNION ALL".join(_matches(i, r.kind, r.group, r.least) for i, r in enumerate(RULES))
_BASE = ", ".join(f"'{r.kind}'" for r in BASE_RULES)
_TOLD = "string_agg(kind || ':' || begin || ':' || finish, ',' ORDER BY begin, place)"

SECRETS = f"""
WITH rows_ AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({_SPANS}),
told AS (
  SELECT row, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex, {_TOLD} AS spans,
         {_TOLD.removesuffix(")")}) FILTER (kind IN ({_BASE})) AS base
  FROM spans GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM rows_ LEFT JOIN told USING (row)
"""

_DOUBLED = "replace({0}, chr(92), chr(92) || chr(92))"
_ESCAPED = (
    "regexp_replace(" + _DOUBLED + r""", '(?i)(<)(\||/?s>|</?sys>>|(?:unk|pad|bos|eos)>)|(\[)(/?inst\])', '\1\3\\\2\4', 'g')"""
)
_MARKS = len("<|im_start|>" + "<|im_sep|>" + "<|im_end|>\n")

CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({_MARKS} + length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")})) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

TOPK = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

_LICENSE_RULES = ",\n".join(
    f"({i}, {r.rank}, '{r.label}', '{r.expression}', [{', '.join(repr(f' {k} ') for k in r.keywords)}], {licences._SURE[r.rank]})"
    for i, r in enumerate(licences.RULES)
)
LICENSES = f"""
WITH rules(rule, rank, label, expression, keywords, sure) AS (VALUES {_LICENSE_RULES}),
cut AS (
  SELECT row_number() OVER () AS row, doc_id, trim(regexp_replace(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', '  ', 'g'), ' ') AS spaced
  FROM documents),
rows_ AS MATERIALIZED (SELECT row, doc_id, CASE WHEN spaced = '' THEN '' ELSE ' ' || spaced || ' ' END AS words FROM cut),
tried AS (
  SELECT row, rule, rank, label, sure, regexp_extract_all(words, expression) AS hits, string_split_regex(words, expression) AS gaps
  FROM rows_ JOIN rules ON len(list_filter(keywords, lambda k: NOT contains(words, k))) = 0),
sized AS (
  SELECT row, rule, rank, label, sure, list_transform(hits, lambda x: (length(x) - length(replace(x, ' ', ''))) // 2) AS hits,
         list_transform(gaps, lambda x: (length(x) - length(replace(x, ' ', ''))) // 2) AS gaps
  FROM tried WHERE len(hits) > 0),
found AS (
  SELECT row, rule, rank, label, sure, CAST(list_sum(gaps[1:i]) + coalesce(list_sum(hits[1:i-1]), 0) AS BIGINT) AS begin,
         CAST(list_sum(gaps[1:i]) + list_sum(hits[1:i]) AS BIGINT) AS finish
  FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM sized)),
kept AS (
  SELECT * FROM found d WHERE rank = {licences.BASE} OR NOT EXISTS (
    SELECT 1 FROM found e WHERE e.row = d.row AND e.rank <= d.rank AND e.begin <= d.begin AND e.finish >= d.finish
      AND (e.rank < d.rank OR e.begin < d.begin OR e.finish > d.finish OR e.rule < d.rule))),
told AS (
  SELECT row, count(*) FILTER (rank = {licences.BASE}) AS n_base, min(begin) FILTER (rank = {licences.BASE}) AS first_word,
         max(begin) FILTER (rank = {licences.BASE}) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (rank = {licences.BASE}) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(sure) AS score
  FROM kept GROUP BY row)
SELECT doc_id, CAST((length(words) - length(replace(words, ' ', ''))) // 2 AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base,
       first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM rows_ LEFT JOIN told USING (row)
"""

ORACLE = {"op1_secret_scans": SECRETS, "op9_chat_format": CHAT, "op10_topk_search": TOPK, "op11_license_scans": LICENSES}
