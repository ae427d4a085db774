"""DuckDB statements for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from tarmac.llm import chat, mixing, urls

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def chat_format(added: list[tuple]) -> str:
    rows = ", ".join(f"({c}, {t}, {_quoted(r)}, {_quoted(x)})" for c, t, r, x in added)
    headers = " ".join(f"WHEN {_quoted(role)} THEN {len(h)}" for role, h in chat.HEADERS.items())
    other = len(chat.OTHER) + len(chat.OTHER_END)
    escapes = lambda c: (
        f"len(regexp_extract_all({c}, '\\\\|</turn>|<said>')) + coalesce(list_sum(list_transform(regexp_extract_all({c}, '#{{3,}}'), lambda m: length(m) - 2)), 0)"
    )
    return f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES {rows})),
sized AS (
  SELECT *, CASE role {headers} ELSE {other} + length(role) + {escapes("role")} END
    + length(text) + {escapes("text")} + {len(chat.END)} AS chars FROM rows),
chats AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS learned,
    sum(chars) AS formatted_chars
  FROM sized GROUP BY conv_id)
SELECT conv_id, n_turns::BIGINT AS n_turns, sha256(said) AS turns_sha256, length(learned)::BIGINT AS loss_chars,
  sha256(learned) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars FROM chats"""


DECONTAMINATE = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)),
hits AS (SELECT doc_id, item_id, x.n, i FROM doc_windows x JOIN item_windows y ON x.win = y.win AND x.n = y.n),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)"""

NGRAM_JACCARD = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * n_both >= 90 * (p.n + q.n - n_both)),
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c.component_id
FROM d LEFT JOIN sizes USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) c USING (doc_id)"""

EXACT_TOPK = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""


#: Rounds that the statement spells out; the given pages need fewer levels and fewer rounds of groups.
SQL_LEVELS, SQL_ROUNDS = 12, 6


def url_filter() -> str:
    rules = ", ".join(f"({_quoted(r.verdict)}, {_quoted(r.host)}, {_quoted(r.path)})" for r in urls.RULES)
    levels, last = [], "nodes"
    for i in range(1, SQL_LEVELS + 1):
        levels.append(f"""
c{i} AS (SELECT *, template[1:{i - 1}] AS parent, template[{i}] AS child FROM {last}),
v{i} AS (SELECT host, parent FROM (SELECT host, parent, child, sum(n) AS n FROM c{i} WHERE child IS NOT NULL AND child <> '*' GROUP BY ALL)
  GROUP BY host, parent HAVING count(*) >= {urls.MIN_CHILDREN} AND count(*) >= {urls.CHILD_SHARE} * sum(n)),
l{i} AS (SELECT c.host, lexical, n, labelled, blocked,
  CASE WHEN v.host IS NOT NULL AND child IS NOT NULL THEN list_concat(list_concat(template[1:{i - 1}], ['*']), template[{i + 1}:]) ELSE template END AS template
  FROM c{i} c LEFT JOIN v{i} v ON c.host = v.host AND c.parent = v.parent),""")
        last = f"l{i}"
    rounds = []
    for i in range(1, SQL_ROUNDS + 1):
        rounds.append(f"""
s{i} AS (SELECT *, blocked / labelled - (sum(blocked) OVER w - blocked) / nullif(sum(labelled) OVER w - labelled, 0) AS apart,
  sum(blocked) OVER w / sum(labelled) OVER w AS pooled, 1 / labelled + 1 / nullif(sum(labelled) OVER w - labelled, 0) AS spread
  FROM g{i - 1} WINDOW w AS (PARTITION BY host, parent, grp)),
x{i} AS (SELECT *, bool_or(coalesce(abs(apart) > {urls.SIMILAR_Z} * sqrt(pooled * (1 - pooled) * spread), false)) OVER (PARTITION BY host, parent, grp) AS splits FROM s{i}),
g{i} AS (SELECT host, parent, template, labelled, blocked,
  grp || CASE WHEN NOT splits THEN '' WHEN blocked / labelled < pooled THEN '{i}<' ELSE '{i}>' END AS grp FROM x{i}),""")
    m = urls.PRIOR_PAGES
    return f"""
WITH rules(verdict, rule_host, rule_path) AS (VALUES {rules}),
u AS (SELECT page_id, coalesce(CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END, '') AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), '{urls.UPPER}', '{urls.LOWER}') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
fits AS (SELECT DISTINCT p.host, p.path, rule_host || rule_path AS rule, verdict,
  row_number() OVER (PARTITION BY p.host, p.path ORDER BY length(rule_host || rule_path) DESC) AS place
  FROM (SELECT DISTINCT host, path FROM p) p JOIN rules ON ends_with('.' || p.host, '.' || rule_host) AND starts_with(p.path, rule_path)),
r AS (SELECT p.*, rule, verdict AS label, list_transform(list_filter(string_split(p.path, '/'), lambda s: s <> ''),
  lambda s: CASE WHEN regexp_matches(s, '[0-9]') THEN '*' ELSE s END) AS lexical
  FROM p LEFT JOIN fits f ON p.host = f.host AND p.path = f.path AND place = 1),
nodes AS (SELECT host, lexical, lexical AS template, count(*) AS n, count(label) AS labelled, count(*) FILTER (label = 'block') AS blocked FROM r GROUP BY host, lexical),
{"".join(levels)}
b AS (SELECT host, template, template[1:greatest(len(template) - 1, 0)] AS parent, sum(labelled)::DOUBLE AS labelled, sum(blocked)::DOUBLE AS blocked FROM {last} GROUP BY host, template),
corpus AS (SELECT (sum(blocked) + {m * urls.PRIOR_RATE}) / (sum(labelled) + {m}) AS corpus_rate FROM b),
hosts AS (SELECT host, (sum(blocked) + {m} * min(corpus_rate)) / (sum(labelled) + {m}) AS host_rate FROM b, corpus GROUP BY host),
places AS (SELECT host, parent, (sum(blocked) + {m} * min(host_rate)) / (sum(labelled) + {m}) AS place_rate FROM b JOIN hosts USING (host) GROUP BY host, parent),
g0 AS (SELECT host, parent, template, labelled, blocked, '' AS grp FROM b WHERE labelled > 0),
{"".join(rounds)}
purity AS (SELECT g.host, template, (sum(blocked) OVER w + {m} * place_rate) / (sum(labelled) OVER w + {m}) AS purity
  FROM g{SQL_ROUNDS} g JOIN places p ON g.host = p.host AND g.parent = p.parent WINDOW w AS (PARTITION BY g.host, g.parent, grp)
  UNION ALL SELECT b.host, template, place_rate FROM b JOIN places p ON b.host = p.host AND b.parent = p.parent WHERE labelled = 0)
SELECT page_id, r.host, path, rule, coalesce(label, CASE WHEN purity > {urls.BLOCK_ABOVE} THEN 'block' ELSE 'allow' END) AS verdict
FROM r JOIN {last} l ON r.host = l.host AND r.lexical = l.lexical JOIN purity q ON q.host = l.host AND q.template = l.template"""


def mixed(domain_weights: list[tuple], language_weights: list[tuple], max_epochs: int, seed: int) -> str:
    values = lambda rows: ", ".join("(" + ", ".join(repr(x) for x in r) + ")" for r in rows)
    levels, path, above = [], ["root"], "root"
    given = {"domain": ("domain", domain_weights), "lang": ("domain, lang", language_weights)}
    for level in mixing.LEVELS:
        here = [c for c in path if c != "root"] + [level]
        cols, keys = ", ".join(here), ", ".join(path)
        if level in given:
            names, rows = given[level]
            weights = f"LEFT JOIN (VALUES {values(rows)}) w({names}, weight) USING ({names})"
            weight = "coalesce(w.weight, 1)::DOUBLE"
        else:
            weights, weight = "", "1::DOUBLE"
        levels.append(f"""
n_{level} AS (SELECT 0 AS root, {cols}, sum(tokens * {max_epochs}) AS capacity FROM leaves GROUP BY {cols}),
i_{level} AS (SELECT n.*, {weight} AS given, budget FROM n_{level} n {weights} JOIN {above} USING ({keys})),
w_{level} AS (SELECT *, CASE WHEN sum(given) OVER s > 0 THEN given ELSE 1.0 END AS weight FROM i_{level} WINDOW s AS (PARTITION BY {keys})),
f_{level} AS (SELECT *, CASE WHEN weight > 0 THEN capacity / weight ELSE 'infinity'::DOUBLE END AS fill FROM w_{level}),
b_{level} AS (SELECT *, coalesce(sum(capacity) OVER o, 0) AS filled, sum(weight) OVER (PARTITION BY {keys}) - coalesce(sum(weight) OVER o, 0) AS rest
  FROM f_{level} WINDOW o AS (PARTITION BY {keys} ORDER BY fill, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l_{level} AS (SELECT *, CASE WHEN rest > 0 THEN (budget - filled) / rest END AS level FROM b_{level}),
u_{level} AS (SELECT *, level >= fill AND weight > 0 AS is_full FROM l_{level}),
o_{level} AS (SELECT *, first(level) OVER (PARTITION BY {keys} ORDER BY (NOT is_full AND weight > 0) DESC, fill, {level}
  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS open_level FROM u_{level}),
a_{level} AS (SELECT {cols}, least(CASE WHEN weight = 0 THEN 0 WHEN is_full THEN capacity ELSE floor(open_level * weight) END, capacity)::BIGINT AS budget FROM o_{level}),""")
        path, above = here, f"a_{level}"
    return rf"""
WITH crc AS (SELECT source, CASE WHEN source IS NULL THEN 0 ELSE list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(source)), lambda i: ord(source[i + 1])::BIGINT)),
  lambda c, x: list_reduce(list_prepend(xor(c, x), [1, 1, 1, 1, 1, 1, 1, 1]::BIGINT[]), lambda k, one: CASE WHEN k & 1 = 1 THEN xor(k >> 1, 3988292384) ELSE k >> 1 END)) END AS state
  FROM (SELECT DISTINCT source FROM documents)),
sized AS (SELECT doc_id, 'domain' || (xor(state, 4294967295) % 3) AS domain, lang, d.source,
  len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+'))::BIGINT AS n_tokens FROM documents d JOIN crc ON d.source IS NOT DISTINCT FROM crc.source),
leaves AS (SELECT domain, lang, source, sum(n_tokens) AS tokens, count(*) AS docs FROM sized GROUP BY ALL),
root AS (SELECT 0 AS root, least(floor(sum(tokens) / 2), sum(tokens * {max_epochs})) AS budget FROM leaves),
{"".join(levels)}
plan AS (SELECT l.*, budget, CASE WHEN tokens > 0 THEN floor(budget / tokens) ELSE 0 END::BIGINT AS whole FROM leaves l JOIN a_source USING (domain, lang, source)),
rows AS (SELECT s.*, tokens, budget, whole, unnest(range(0, least(whole, {max_epochs - 1}) + 1)) AS epoch FROM sized s JOIN plan USING (domain, lang, source)),
cut AS (SELECT *, budget - whole * tokens AS part, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source
    ORDER BY md5('{seed}|' || epoch || '|' || doc_id), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM rows WHERE epoch = whole)
SELECT doc_id, domain, lang, source, epoch::INTEGER AS epoch, n_tokens, n_tokens AS taken FROM rows WHERE epoch < whole
UNION ALL
SELECT doc_id, domain, lang, source, epoch::INTEGER, n_tokens, least(n_tokens, part - before)::BIGINT FROM cut WHERE part > before AND n_tokens > 0"""


FILL_MIDDLE = """
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), numbers AS (
    SELECT doc_id, t, length(t) AS n,
        [CAST('0x' || substr(h, 1, 8) AS BIGINT), CAST('0x' || substr(h, 9, 8) AS BIGINT),
         CAST('0x' || substr(h, 17, 8) AS BIGINT), CAST('0x' || substr(h, 25, 8) AS BIGINT)] AS x
    FROM cut
), formed AS (
    SELECT doc_id, t, n, least(x[1] % (n + 1), x[2] % (n + 1)) AS a, greatest(x[1] % (n + 1), x[2] % (n + 1)) AS b,
        CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR x[3] % 100 >= 90 THEN 'plain'
             WHEN x[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM numbers
), pieces AS (
    SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM formed
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
    CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM pieces
"""
