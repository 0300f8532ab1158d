"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from . import licenses, secrets, warc

WARC = f"""
SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN top END AS refers_to
FROM (SELECT *, strlen(payload) >= {warc.REVISIT_BYTES} AND page_id < top AS again
      FROM (SELECT page_id, coalesce(html, '') AS payload, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top FROM pages))
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secret_kind(order: int, kind: str, pattern: str, group: int, least: int) -> str:
    """Matches of one kind with their places: matches lie between the pieces that splitting leaves."""
    p = _quoted(pattern)
    good = f"length(v) >= {least}" if kind != "mixed" else "regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]')"
    return f"""
    SELECT doc_id, source, lang, {order} AS ord, '{kind}' AS kind, start, start + length(m) AS stop, v FROM (
      SELECT *, sum(length(gap)) OVER w + coalesce(sum(length(m)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM (
        SELECT doc_id, source, lang, generate_subscripts(string_split_regex(text, {p}), 1) AS i, unnest(string_split_regex(text, {p})) AS gap,
               unnest(regexp_extract_all(text, {p}, 0)) AS m, unnest(regexp_extract_all(text, {p}, {group})) AS v
        FROM documents WHERE regexp_matches(text, {p}))
      WINDOW w AS (PARTITION BY doc_id ORDER BY i)) WHERE m IS NOT NULL AND {good}"""


_BASE = "(" + ", ".join(f"'{k}'" for k in secrets.BASE) + ")"
_TOLD = "string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, ord)"
SECRETS = f"""
WITH found AS ({" UNION ALL ".join(_secret_kind(i, *k[:4]) for i, k in enumerate(secrets.KINDS))}),
held AS (SELECT v, count(DISTINCT coalesce(source, '')) <= 1 AND count(DISTINCT (coalesce(source, ''), coalesce(lang, ''))) <= 2 AS live FROM found GROUP BY v),
kept AS (SELECT * FROM found JOIN held USING (v) WHERE live OR kind IN {_BASE}),
told AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         {_TOLD} FILTER (kind IN {_BASE}) AS base, {_TOLD} AS spans, count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example FROM kept GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM documents d LEFT JOIN told t ON d.doc_id = t.doc_id
"""

_TERM = _quoted(licenses.TERM)
_TEMPLATES = ", ".join(f"({i}, {_quoted(n)}, {_quoted(t)})" for i, (n, t) in enumerate(licenses.TEMPLATES))
_END = _quoted(licenses.SENTENCE_END)
LICENSES = f"""
WITH template AS (SELECT * FROM (VALUES {_TEMPLATES}) AS t(tid, licence, body)),
wanted AS (SELECT tid, licence, term, count(*) AS k FROM (SELECT tid, licence, unnest(regexp_extract_all(lower(body), {_TERM})) AS term FROM template) GROUP BY 1, 2, 3),
size AS (SELECT tid, sum(k) AS length FROM wanted GROUP BY 1),
line AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line, unnest(string_split(text, chr(10))) AS t FROM documents),
piece AS (SELECT doc_id, line, generate_subscripts(p, 1) AS part, unnest(p) AS t FROM (SELECT doc_id, line, string_split(regexp_replace(lower(t), {_END}, '\\1' || chr(1), 'g'), chr(1)) AS p FROM line)),
unit AS (SELECT doc_id, line, terms, len(terms) AS n, row_number() OVER w AS pos, sum(len(terms)) OVER w - len(terms) AS before FROM (SELECT doc_id, line, part, regexp_extract_all(t, {_TERM}) AS terms FROM piece) WHERE len(terms) > 0 WINDOW w AS (PARTITION BY doc_id ORDER BY line, part ROWS UNBOUNDED PRECEDING)),
known AS (SELECT doc_id, pos, term FROM (SELECT doc_id, pos, unnest(terms) AS term FROM unit) WHERE term IN (SELECT term FROM wanted)),
total AS (SELECT count(*) AS n FROM documents),
weight AS (SELECT v.term, power(ln((n + 1) / (count(DISTINCT doc_id) + 1)) + 1, 2) AS w FROM (SELECT DISTINCT term FROM wanted) v CROSS JOIN total LEFT JOIN known ON known.term = v.term GROUP BY v.term, n),
own AS (SELECT tid, sum(k * k * w) AS norm FROM wanted JOIN weight USING (term) GROUP BY tid),
start AS (SELECT DISTINCT doc_id, pos, tid FROM known JOIN wanted USING (term)),
passage AS (SELECT s.doc_id, s.pos, s.tid, any_value(a.line) AS line, max(b.pos) AS last, sum(b.n) AS total FROM start s JOIN size USING (tid) JOIN unit a ON a.doc_id = s.doc_id AND a.pos = s.pos JOIN unit b ON b.doc_id = s.doc_id AND b.pos >= s.pos AND b.before < a.before + length GROUP BY 1, 2, 3),
held AS (SELECT p.doc_id, p.pos, p.tid, k.term, count(*) AS n FROM passage p JOIN known k ON k.doc_id = p.doc_id AND k.pos BETWEEN p.pos AND p.last GROUP BY 1, 2, 3, 4),
sums AS (SELECT h.doc_id, h.pos, h.tid, sum(h.n * coalesce(w.k, 0) * g.w) AS dot, sum(h.n * h.n * g.w) AS norm, sum(h.n) AS n FROM held h JOIN weight g ON g.term = h.term LEFT JOIN wanted w ON w.tid = h.tid AND w.term = h.term GROUP BY 1, 2, 3),
cosine AS (SELECT p.doc_id, p.line, t.licence, round(s.dot / (sqrt(o.norm) * sqrt(s.norm + (p.total - s.n) * power(ln((c.n + 1)::DOUBLE) + 1, 2))), 6) AS score
           FROM passage p JOIN sums s ON s.doc_id = p.doc_id AND s.pos = p.pos AND s.tid = p.tid JOIN own o ON o.tid = p.tid JOIN template t ON t.tid = p.tid CROSS JOIN total c),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, licence DESC, line) AS k FROM cosine WHERE score >= {licenses.THRESHOLD}) WHERE k = 1),
doc AS (SELECT d.doc_id, concat_ws('/', source, lang, d.doc_id) AS path, concat_ws('/', source, lang) AS dir, licence AS own, score, line FROM documents d LEFT JOIN best b ON b.doc_id = d.doc_id),
said AS (SELECT dir, own FROM (SELECT dir, own, row_number() OVER (PARTITION BY dir ORDER BY count(*) DESC, own) AS k FROM doc WHERE own IS NOT NULL GROUP BY dir, own) WHERE k = 1)
SELECT doc_id, path, doc.own AS own, score, line, coalesce(doc.own, said.own) AS licence,
       CASE WHEN doc.own IS NOT NULL THEN 'own' WHEN said.own IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       CASE WHEN doc.own IS NULL AND said.own IS NOT NULL THEN doc.dir END AS inherited_from
FROM doc LEFT JOIN said USING (dir)
"""
