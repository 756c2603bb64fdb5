"""Comparison SQL of the operators that SQL can express."""

from __future__ import annotations

from .chat import ChatTemplate
from .quality_rules import HostRules

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

URL_FILTER = f"""
WITH rules(action, host, path) AS (VALUES
    ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
page AS (SELECT page_id, url, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
cut AS (SELECT page_id, translate(url, {_LOWER}) AS low, translate(regexp_extract(rest, '^([^/?#]*)', 1), {_LOWER}) AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM page),
fit AS (SELECT c.*, r.action, r.host || r.path AS rule,
    row_number() OVER (PARTITION BY page_id ORDER BY length(r.host || r.path) DESC NULLS LAST, r.action DESC, r.host || r.path DESC) AS n
    FROM cut c LEFT JOIN rules r ON (c.host = r.host OR ends_with(c.host, '.' || r.host)) AND starts_with(c.path, r.path))
SELECT page_id, host, path, rule, CASE WHEN action IS NOT NULL THEN action
    WHEN contains(low, '/security/spam-farm.report/') THEN 'allow'
    WHEN contains(low, 'spam-farm.') OR contains(low, 'cheap-pills.') OR contains(low, '/casino/') OR contains(low, 'adserver.')
        OR contains(low, '/banner/') OR regexp_matches(low, '(?s)tracker\\..*/click\\?') THEN 'block'
    ELSE 'allow' END AS verdict
FROM fit WHERE n = 1
"""

_RULES = HostRules()
_FAILS = {
    "short": f"n_words < {_RULES.min_words}",
    "repeats": f"100 * n_repeat_words > {_RULES.max_repeat_percent} * n_words",
    "symbols": f"100 * n_symbols > {_RULES.max_symbol_percent} * word_chars",
    "dup_lines": f"100 * n_dup_lines > {_RULES.max_dup_line_percent} * n_lines",
}


def _host_sql() -> str:
    """Hosts that are refused: moments over hosts, then a shrunken rate for each rule."""
    sums = ", ".join(f"sum(CASE WHEN {c} THEN 1.0 ELSE 0 END)::DOUBLE AS k_{r}" for r, c in _FAILS.items())
    moments = ", ".join(f"sum(k_{r}) AS all_{r}, sum(k_{r} * k_{r} / n_docs) AS q_{r}" for r in _FAILS)
    tests = []
    for r in _FAILS:
        mean = f"(all_{r} / n)"
        chance = f"({mean} * (1 - {mean}))"
        spread = f"(CASE WHEN hosts > 1 THEN (q_{r} - n * {mean} * {mean} - (hosts - 1) * {chance}) / (n - n / hosts) ELSE 0 END)"
        weight = (
            f"(CASE WHEN {spread} <= 0 THEN {_RULES.weak_prior} WHEN {chance} <= {spread} THEN 1.0 "
            f"ELSE least({_RULES.weak_prior}, greatest(1.0, {chance} / {spread} - 1)) END)"
        )
        tests.append(f"(k_{r} + {mean} * {weight}) / (n_docs + {weight}) > {_RULES.max_rate}")
    return f"""
hosts AS (SELECT source AS host, count(*)::DOUBLE AS n_docs, {sums} FROM counted WHERE source IS NOT NULL GROUP BY source),
total AS (SELECT sum(n_docs) AS n, count(*)::DOUBLE AS hosts, {moments} FROM hosts),
refused AS (SELECT host FROM hosts, total WHERE {" OR ".join(tests)})"""


QUALITY_RULES = rf"""
WITH base AS (SELECT doc_id, source, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
windows AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM base, unnest(range(1, len(w) - 1)) AS t(i)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1),
places AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, unnest(range(0, 3)) AS t(k) GROUP BY doc_id),
counted AS (SELECT doc_id, source, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines
    FROM base LEFT JOIN places USING (doc_id)),{_host_sql()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, {_FAILS['short']} OR {_FAILS['repeats']} AS base_failed,
    refused.host IS NOT NULL AS host_refused, NOT ({_FAILS['short']} OR {_FAILS['repeats']}) AND refused.host IS NULL AS kept
FROM counted LEFT JOIN refused ON source = refused.host
"""

TOP_K = """
WITH vectors AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

FILTER_AUDIT = r"""
WITH d AS (SELECT coalesce(source, '') AS part, doc_id, coalesce(text, '') AS t FROM documents),
firsts AS (SELECT t, min(doc_id) AS f FROM d GROUP BY t),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
w AS (SELECT d.*, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM d),
fails AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    map(['A', 'B', 'C', 'D', 'E'], [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w),
    100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t), regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > f, false)]) AS m
    FROM w JOIN firsts USING (t) LEFT JOIN marks USING (doc_id)),
counts AS (SELECT part, m, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY part, m),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (SELECT a.c || b.c || d.c || e.c || f.c AS filter_order FROM letters a, letters b, letters d, letters e, letters f
    WHERE len(list_distinct([a.c, b.c, d.c, e.c, f.c])) = 5),
steps AS (SELECT filter_order, s AS step, substr(filter_order, s, 1) AS own, string_split(substr(filter_order, 1, s - 1), '') AS ran FROM orders, range(1, 6) AS r(s)),
marked AS (SELECT part, filter_order, step, own, n, good, toxic, m[own] AS bad, len(list_filter(ran, lambda x: x <> '' AND m[x])) > 0 AS gone,
    len(list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: x <> own AND m[x])) = 0 AS alone FROM counts, steps),
summed AS (SELECT part, filter_order, step, own, sum(CASE WHEN NOT gone AND NOT bad THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN NOT gone AND bad THEN n ELSE 0 END)::BIGINT AS removed, sum(CASE WHEN gone AND bad THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN alone AND bad THEN n ELSE 0 END)::BIGINT AS unique_fails, sum(CASE WHEN NOT gone AND bad THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN NOT gone AND bad THEN toxic ELSE 0 END)::BIGINT AS toxic_lost FROM marked GROUP BY ALL)
SELECT * EXCLUDE (own), sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley FROM summed
"""

SOURCE_DIVERGENCE = r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS i,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
groups AS (SELECT DISTINCT lang, source FROM d),
w AS (SELECT lang, source, i, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT i) >= 10),
sizes AS (SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS n FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS c FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sums AS (SELECT lang, source, sum(c)::HUGEINT AS n FROM counts GROUP BY ALL),
shares AS (SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c, 1 + 1000000000 * (coalesce(c, 0) + 2) // (coalesce(sums.n, 0) + 2 * v) AS p,
    1 + 1000000000 * (k.total::HUGEINT + 2) // (sizes.n + 2 * v) AS q
    FROM groups g JOIN kept k USING (lang) JOIN sizes USING (lang) LEFT JOIN sums USING (lang, source) LEFT JOIN counts USING (lang, source, term)),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM shares WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""

_CHAT = ChatTemplate()


def _codes_sql(text: str, role: bool = False) -> str:
    """Length of a text after escaping: one more for each character with a code."""
    pattern = "[" + "".join(f"\\{c}" for c, _ in _CHAT.codes(role)) + "]"
    return f"(2 * length({text}) - length(regexp_replace({text}, '{pattern}', '', 'g')))"


CHAT_FORMAT = f"""
WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
    UNION ALL SELECT -7, n, CASE WHEN n = 0 THEN 'user' ELSE 'assistant' END, '\\### Assistant: </turn> ok' FROM range(2) AS r(n)),
said AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, role, t) AS turns,
    coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, role, t) FILTER (WHERE role IN ('assistant')), '') AS loss,
    sum({_codes_sql("role", True)} + {_codes_sql("t")} + {len(_CHAT.open + _CHAT.role_end + _CHAT.close)})::BIGINT AS formatted_chars FROM rows GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM said
"""

ORACLES = {
    "op1_url_filter": URL_FILTER,
    "op2_quality_rules": QUALITY_RULES,
    "op10_top_k": TOP_K,
    "op11_filter_audit": FILTER_AUDIT,
    "op12_source_divergence": SOURCE_DIVERGENCE,
    "op13_chat_format": CHAT_FORMAT,
}
