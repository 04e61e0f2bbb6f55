"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations


def _license_sql() -> str:
    from tidewater.llm.license_scan import BASE, TEMPLATES
    parts = []
    for phrase, label in BASE:
        parts.append((label, 1, [(w, k) for k, w in enumerate(phrase.split())], []))
    for text, label in TEMPLATES:
        before, key, after = (x.split() for x in text.split("|"))
        key_at = [(w, k) for k, w in enumerate(key) if w != "_"]
        context = ([(w, k - len(before)) for k, w in enumerate(before) if w != "_"]
                   + [(w, k + len(key)) for k, w in enumerate(after) if w != "_"])
        parts.append((label, 0, key_at, context))
    word = "w[p + {o} + 1] = '{w}'"
    places = " UNION ALL ".join(
        f"SELECT doc_id, p, '{label}' AS label, {base} AS base, ("
        + " + ".join([str(len(key))] + [
            f"CASE WHEN p + {o} >= 0 AND {word.format(w=x, o=o)} THEN 1 ELSE 0 END"
            for x, o in context])
        + f") / {float(len(key) + len(context))} AS score FROM words, unnest(range(len(w))) AS u(p)"
        + " WHERE " + " AND ".join(word.format(w=x, o=o) for x, o in key)
        for label, base, key, context in parts)
    return rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
places AS ({places}),
found AS (
  SELECT doc_id, count(*) FILTER (base = 1) AS n_base, min(p) FILTER (base = 1) AS first_word,
         max(p) FILTER (base = 1) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base = 1) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
  FROM places GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM words LEFT JOIN found USING (doc_id)"""


URL_SQL = """
WITH u AS (
  SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0
                       THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
p AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
rules(r_host, r_path, r_verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits AS (
  SELECT DISTINCT host, path, r_host || r_path AS rule, r_verdict,
         row_number() OVER (PARTITION BY host, path ORDER BY length(r_host || r_path) DESC) AS k
  FROM (SELECT DISTINCT host, path FROM p)
  JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path))
SELECT page_id, p.host, p.path, rule, coalesce(r_verdict, CASE
    WHEN regexp_matches(p.host, 
           '(^|[.])(ads-track|adult-x|casino-win|cheap-pills|free-bets|spam-farm)[.]example[.](com|net|org)$')
     AND starts_with(p.path, '/') THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN fits ON p.host = fits.host AND p.path = fits.path AND k = 1"""


def queries_sql() -> dict[str, str]:
    return {"op1_license_scan": _license_sql(), "op8_url_filter": URL_SQL}
