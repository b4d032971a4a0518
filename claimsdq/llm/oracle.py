"""DuckDB SQL for the queries of this subpackage that SQL can express.

The others are tested against brute force: op1 (64-bit hashes and reachability),
op3 (hypergeometric draws), op4 (hash scores), op6, op7, op10, op11 (by held-out
accuracy) and op13.
"""

from __future__ import annotations

from claimsdq.llm.licenses import COPYRIGHT_LINE, KNOWN, PLAIN, PUNCTUATION, SPELLINGS, TYPOGRAPHIC

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP2 = f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)
WINDOW same AS (PARTITION BY t)
"""

OP9 = r"""
WITH d AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows) WHERE c > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM repeated) GROUP BY doc_id),
figures AS (
  SELECT d.doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM d LEFT JOIN covered ON d.doc_id = covered.doc_id),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM figures)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 10 * n_symbols <= 3 * n_words AND 2 * n_dup_lines <= n_lines
       AND word_chars <= 40 * n_words AS kept
FROM judged
"""


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _canonical(col: str) -> str:
    t = f"translate({col}, '{UPPER}', '{LOWER}')"
    t = f"translate({t}, {_quoted(TYPOGRAPHIC)}, {_quoted(PLAIN)})"
    t = f"regexp_replace({t}, {_quoted(COPYRIGHT_LINE)}, ' ', 'g')"
    t = f"trim(regexp_replace({t}, {_quoted(PUNCTUATION)}, ' ', 'g'))"
    t = f"replace({t}, 'all rights reserved', '')"
    for old, new in SPELLINGS:
        t = f"replace({t}, '{old}', '{new}')"
    return f"trim(regexp_replace({t}, ' +', ' ', 'g'))"


OP5 = f"""
WITH known AS (
  SELECT sha256(form) AS known_digest, min(license) AS license
  FROM (SELECT license, {_canonical("known_text")} AS form
        FROM (VALUES {", ".join(f"({_quoted(n)}, {_quoted(t)})" for n, t in KNOWN)}) AS k(license, known_text))
  GROUP BY 1),
docs AS (SELECT DISTINCT doc_id, coalesce(text, '') AS t FROM documents),
units AS (
  SELECT doc_id, t, unnest(list_concat([t], string_split(t, chr(10)))) AS unit,
         generate_subscripts(list_concat([t], string_split(t, chr(10))), 1) AS spot
  FROM docs),
digests AS (SELECT doc_id, t, spot, {_canonical("unit")} AS form FROM units),
found AS (
  SELECT doc_id, t, spot, sha256(form) AS digest, license
  FROM digests LEFT JOIN known ON sha256(form) = known_digest AND form <> '')
SELECT doc_id, max(digest) FILTER (spot = 1) AS text_digest, max(license) FILTER (spot = 1) AS text_license,
       coalesce(string_agg(DISTINCT license, ',' ORDER BY license), '') AS licenses,
       count(license) FILTER (spot > 1) AS n_license_lines
FROM found GROUP BY doc_id, t
"""

_TURN = "'<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10)"


def _text(turns: str) -> str:
    return f"coalesce(array_to_string(list_transform({turns}, lambda t: {_TURN}), ''), '')"


def _loss(d: str) -> str:
    before = f"coalesce(list_sum(list_transform({d}[1:i - 1], lambda t: length({_TURN}))), 0)"
    own = _TURN.replace("t.", f"{d}[i].")
    return (f"coalesce(array_to_string(list_transform(list_filter(range(1, len({d}) + 1), "
            f"lambda i: {d}[i].role = 'assistant'), lambda i: "
            f"({before} + 12 + length({d}[i].role) + 1)::BIGINT || ':' || ({before} + length({own}))::BIGINT), ','), '')")


OP8 = f"""
WITH conv AS (
  SELECT conv_id, list({{'turn': turn, 'role': r, 'text': x}} ORDER BY turn NULLS FIRST, r, x) AS c
  FROM (SELECT conv_id, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS alone, turn::BIGINT AS turn,
               coalesce(role, 'unknown') AS r, coalesce(text, '') AS x FROM conversations)
  GROUP BY conv_id, alone),
own AS (
  SELECT conv_id, c, list_max(list_filter(range(1, len(c) + 1), lambda i: c[i].role = 'assistant')) AS spot FROM conv),
mates AS (
  SELECT a.conv_id, a.c, a.spot, b.c[b.spot].text AS other FROM own a LEFT JOIN own b ON b.conv_id = xor(a.conv_id, 1)),
pairs AS (
  SELECT conv_id, c, CASE WHEN spot IS NULL THEN c WHEN other IS NULL THEN c[1:spot - 1]
    ELSE list_append(c[1:spot - 1], {{'turn': c[spot].turn, 'role': 'assistant', 'text': other}}) END AS r
  FROM mates),
cut AS (
  SELECT *, coalesce(list_min(list_filter(range(1, least(len(c), len(r)) + 1),
           lambda i: c[i].role <> r[i].role OR c[i].text <> r[i].text)) - 1, least(len(c), len(r))) AS n FROM pairs),
sides AS (SELECT conv_id, n, c[1:n] AS same, c[n + 1:len(c)] AS a, r[n + 1:len(r)] AS b FROM cut),
done AS (
  SELECT conv_id AS pair_id, n AS prompt_turns, {_text("same")} AS prompt, {_text("a")} AS chosen,
         {_text("b")} AS rejected, {_loss("a")} AS chosen_loss, {_loss("b")} AS rejected_loss FROM sides)
SELECT *, chosen_loss <> '' AND rejected_loss <> '' AS usable FROM done
"""


def _share(count: str, n: str, size: str) -> str:
    return f"(1 + 1000000000::HUGEINT * ({count} + 1) // nullif({n} + {size}, 0))"


# Plain and dense: every kept term of the lang for every pair of sources.
OP12 = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words
  FROM documents),
w AS (SELECT r, lang, source, unnest(words) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
sized AS (SELECT l.lang, count(k.term) AS v FROM (SELECT DISTINCT lang FROM d) l LEFT JOIN kept k ON l.lang = k.lang GROUP BY 1),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT s.lang, s.source, coalesce(sum(n), 0)::HUGEINT AS total, any_value(v) AS v
      FROM (SELECT DISTINCT lang, source FROM d) s JOIN sized USING (lang) LEFT JOIN c ON c.lang = s.lang AND c.source = s.source
      GROUP BY ALL),
l AS (SELECT lang, term, sum(n)::HUGEINT AS n, sum(sum(n)) OVER (PARTITION BY lang)::HUGEINT AS total FROM c GROUP BY lang, term),
p AS (SELECT g.lang, g.source, kept.term, coalesce(n, 0) AS n, {_share("coalesce(n, 0)", "g.total", "v")} AS p
      FROM g JOIN kept ON kept.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
             FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) x
    ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (
  SELECT p.lang, p.source, p.term AS item, ((p.p - q) * (p.p - q) // q)::BIGINT AS value
  FROM p JOIN (SELECT l.lang, l.term, {_share("l.n", "l.total", "v")} AS q FROM l JOIN sized USING (lang)) t
    ON t.lang = p.lang AND t.term = p.term
  WHERE p.n > 0 AND p.p > q),
ranked AS (
  SELECT 'pair' AS part, *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT 'term' AS part, *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM terms)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": OP2, "op5_license_scan": OP5, "op8_preferences": OP8, "op9_quality_rules": OP9,
            "op12_source_divergence": OP12}
