"""DuckDB SQL that says the same as the operators."""

from __future__ import annotations

from tidegrid.llm import secrets
from tidegrid.llm.chat import ESCAPE, ESCAPED_ESCAPE, LETTERS, Template

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _words(text: str, pattern: str, lower: bool) -> str:
    text = f"coalesce({text}, '')"
    return f"regexp_extract_all({f'translate({text}, {_lit(UPPER)}, {_lit(LOWER)})' if lower else text}, '{pattern}')"


NOT_SPACE = r"[^\x20\x09-\x0D]+"
LETTER_DIGIT = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

DECONTAMINATE = f"""
WITH items AS (SELECT item_id, {_words("text", LETTER_DIGIT, True)} AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, w[i:i + least(10, len(w)) - 1] AS win FROM items, LATERAL unnest(range(1, greatest(2, len(w) - 8))) AS t(i) WHERE len(w) > 0),
docs AS (SELECT doc_id, {_words("text", LETTER_DIGIT, True)} AS w FROM documents),
sizes AS (SELECT DISTINCT len(win) AS size FROM windows),
runs AS (SELECT doc_id, size, i, w[i:i + size - 1] AS win FROM docs, sizes, LATERAL unnest(range(1, len(w) - size + 2)) AS t(i)),
hits AS (SELECT doc_id, i, size, item_id FROM runs JOIN windows USING (win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)
"""

# The same shares and blocks as tidegrid.llm.mixture; of its apportionment only the definition: highest quotients.
MIX = f"""
WITH d AS (SELECT doc_id, source, coalesce('=' || source, '') AS skey, CAST(len({_words("text", NOT_SPACE, False)}) AS BIGINT) AS size FROM documents),
s AS (SELECT skey, any_value(source) AS source, sum(size)::BIGINT AS size, count(*) AS docs FROM d GROUP BY skey),
w AS (SELECT *, CAST([3, 1, 2][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS DOUBLE) AS weight FROM s),
l AS (SELECT *, (1.5::DOUBLE * sum(size) OVER () - coalesce(sum(2.0::DOUBLE * size) OVER (ORDER BY 2.0::DOUBLE * size / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
  / sum(weight) OVER (ORDER BY 2.0::DOUBLE * size / weight, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT *, least(2.0::DOUBLE * size, coalesce(max(CASE WHEN level * weight <= 2.0::DOUBLE * size THEN level END) OVER () * weight, 2.0::DOUBLE * size)) AS target FROM l),
b AS (SELECT *, greatest(1, floor(least(sum(target) OVER () / 20000, min(CASE WHEN target > 0 THEN target END) OVER () / 64)))::BIGINT AS block,
  sum(target) OVER () AS total, least(65536, ceil(docs / 8192))::BIGINT AS shards FROM t),
n AS (SELECT *, round(total / block)::BIGINT AS blocks FROM b),
q AS (SELECT skey, count(*) FILTER (won) AS source_quota FROM (
  SELECT skey, row_number() OVER (ORDER BY target / (2 * j + 1) DESC, source IS NULL, source, j) <= blocks AS won FROM n, LATERAL unnest(range(0, (2 * target / block)::BIGINT + 3)) AS u(j) WHERE target > 0) GROUP BY skey),
r AS (SELECT d.doc_id, d.skey, d.size, n.size AS source_size, n.target, n.block, coalesce(q.source_quota, 0) AS source_quota,
  md5('mix-1:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')) AS place, ('0x' || substr(md5('mix-1:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 8))::BIGINT % n.shards AS shard
  FROM d JOIN n USING (skey) LEFT JOIN q USING (skey)),
p AS (SELECT skey, shard, sum(size)::BIGINT AS words, any_value(source_quota) AS source_quota, any_value(block) AS block FROM r GROUP BY skey, shard),
pq AS (SELECT skey, shard, count(*) FILTER (won) AS quota FROM (
  SELECT skey, shard, row_number() OVER (PARTITION BY skey ORDER BY words / (2 * j + 1) DESC, shard, j) <= source_quota AS won FROM p, LATERAL unnest(range(0, (3 * words / block)::BIGINT + 3)) AS u(j) WHERE words > 0) GROUP BY skey, shard),
x AS (SELECT r.*, p.words, coalesce(pq.quota, 0) AS quota, ceil(p.words / r.block)::BIGINT AS n,
  sum(r.size) OVER (PARTITION BY r.skey, r.shard ORDER BY r.place, r.size ROWS UNBOUNDED PRECEDING)::BIGINT AS stop FROM r JOIN p USING (skey, shard) LEFT JOIN pq USING (skey, shard)),
y AS (SELECT *, least(quota // greatest(n, 1), 2) AS every, CASE WHEN quota // greatest(n, 1) >= 2 THEN 0 ELSE quota % greatest(n, 1) END AS rest,
  ('0x' || substr(md5('mix-1:' || skey || ':' || shard), 1, 8))::BIGINT % greatest(n, 1) AS start FROM x),
blocks AS (SELECT doc_id, skey, size, source_size, target, every, unnest(CASE WHEN size > 0 THEN range((stop - size) // block, (stop - 1) // block + 1) ELSE [0] END) AS k, block, stop, start, rest, n FROM y)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target, CAST(any_value(every) * size + coalesce(sum(CASE WHEN size > 0 AND (k + 1 + start) * rest // n > (k + start) * rest // n
  THEN least(stop, (k + 1) * block) - greatest(stop - size, k * block) ELSE 0 END), 0) AS BIGINT) AS taken
FROM blocks GROUP BY doc_id, size, source_size, target
"""


def chat_format(template: Template) -> str:
    """The digests straight from the table, and the length of the formatted text by its definition."""
    turn = "coalesce(role, '') || chr(10) || coalesce(text, '') || chr(10)"

    def escaped(text: str) -> str:
        text = f"replace({text}, {_lit(ESCAPE)}, {_lit(ESCAPED_ESCAPE)})"
        for letter, control in zip(LETTERS, template.controls()):
            text = f"replace({text}, {_lit(control)}, {_lit(ESCAPE + letter)})"
        return text

    fixed = len(template.turn) + len(template.role_end) + len(template.end)
    role = f"replace({escaped(_coalesce('role'))}, chr(10), '\\n')"
    loss = ", ".join(map(_lit, template.loss_roles))
    order = "ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')"
    said = _lit("</s>[INST] ok [/INST]")
    return f"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', {said} UNION ALL SELECT -7, 1, 'assistant', {said})
SELECT conv_id, count(*) AS n_turns, sha256(string_agg({turn}, '' {order})) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role IN ({loss})), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(coalesce(text, ''), '' {order}) FILTER (role IN ({loss})), '')) AS loss_sha256,
  CAST({len(template.begin)} + sum({fixed} + length({role}) + length({escaped(_coalesce('text'))})) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""


def _coalesce(name: str) -> str:
    return f"coalesce({name}, '')"


def jaccard(k: int, percent: int) -> str:
    """Components by labels that spread along links; pairs come from shared shingles."""
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, {_words("text", NOT_SPACE, True)} AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {k} THEN [array_to_string(w, ' ')]
  ELSE [array_to_string(w[i:i + {k - 1}], ' ') FOR i IN range(1, len(w) - {k - 2})] END)) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (g) WHERE x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {percent} * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS v, doc_id AS root FROM n UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.v WHERE r.root < e.b)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(min(r.root), d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN r ON r.v = d.doc_id GROUP BY d.doc_id, n.n
"""


def remove_repeats(window: int) -> str:
    """Windows of every document, the smallest id of each, and the words they cover."""
    return f"""
WITH d AS (SELECT doc_id, {_words("text", NOT_SPACE, False)} AS w FROM documents),
r AS (SELECT doc_id, i, md5(array_to_string(w[i:i + {window - 1}], ' ')) AS win FROM d, LATERAL unnest(range(1, len(w) - {window - 2})) AS t(i)),
f AS (SELECT win, min(doc_id) AS least FROM r GROUP BY win),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + {window})) AS p FROM r JOIN f USING (win) WHERE least < doc_id),
l AS (SELECT doc_id, list(p) AS gone FROM c GROUP BY doc_id),
k AS (SELECT d.doc_id, w, coalesce(len(gone), 0) AS n, CASE WHEN gone IS NULL THEN w ELSE list_select(w, list_sort(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(gone, i)))) END AS kept FROM d LEFT JOIN l USING (doc_id))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(n AS BIGINT) AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k
"""


def secret_scan(reach: int = secrets.REACH) -> str:
    """Base spans of tidegrid.llm.secrets by splitting, and weak ones by comparing all parts of a document."""
    patterns = secrets.BASE | secrets.WEAK | {"break": secrets.BREAK}

    def scan(kind: str, pattern: str) -> str:
        p = _lit(pattern)
        value = f"regexp_extract_all(text, {p}, {2 if kind == 'assign' else 0})"
        return f"SELECT r, {_lit(kind)} AS kind, string_split_regex(text, {p}) AS gaps, regexp_extract_all(text, {p}, 0) AS found, {value} AS vals FROM d WHERE regexp_matches(text, {p})"

    case = lambda table, column: "CASE " + " ".join(f"WHEN {column} = {_lit(k)} THEN {_lit(str(v))}" for k, v in table.items()) + " END"
    needs = " OR ".join(
        f"(w.kind = {_lit(k)} AND " + " AND ".join(f"count(*) FILTER (WHERE o.role = {_lit(x)}) > 0" for x in v) + ")" for k, v in secrets.NEEDS.items())
    base = ", ".join(_lit(k) for k in secrets.BASE)
    weak = ", ".join(_lit(k) for k in secrets.WEAK)
    order = "start, place"
    listed = lambda where: f"coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY {order}){where}, '')"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = {_lit(k)} AND base) AS n_{k}" for k in secrets.BASE)
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
scans AS ({" UNION ALL ".join(scan(k, p) for k, p in patterns.items())}),
each AS (SELECT r, kind, i, length(gaps[i]) AS gap, length(found[i]) AS size, length(vals[i]) AS val FROM scans, LATERAL unnest(range(1, len(found) + 1)) AS t(i)),
sums AS (SELECT *, CAST(sum(gap + size) OVER (PARTITION BY r, kind ORDER BY i) AS BIGINT) AS stop FROM each),
parts AS (SELECT DISTINCT r, CASE WHEN kind <> 'assign' OR val >= {secrets.MIN_VALUE} THEN kind WHEN val >= {secrets.MIN_PHRASE} THEN 'phrase' END AS kind, stop - size AS start, stop FROM sums),
roles AS (SELECT *, {case(secrets.ROLES, "kind")} AS role FROM parts WHERE kind IS NOT NULL AND kind <> 'break'),
breaks AS (SELECT r, start FROM parts WHERE kind = 'break'),
scoped AS (SELECT p.*, (SELECT count(*) FROM breaks b WHERE b.r = p.r AND b.start < p.start) AS scope FROM roles p),
added AS (SELECT w.r, w.kind, w.start, w.stop FROM scoped w JOIN scoped o ON o.r = w.r AND o.scope = w.scope AND o.role <> w.role
  AND (o.start BETWEEN w.stop AND w.stop + {reach} OR o.stop BETWEEN w.start - {reach} AND w.start)
  WHERE w.kind IN ({weak}) GROUP BY w.r, w.kind, w.start, w.stop HAVING {needs}),
spans AS (SELECT r, kind, start, stop, true AS base FROM roles WHERE kind IN ({base}) UNION ALL SELECT r, kind, start, stop, false FROM added),
placed AS (SELECT *, CAST({case({k: i for i, k in enumerate(secrets.KINDS)}, "kind")} AS INTEGER) AS place FROM spans),
found AS (SELECT r, {counts}, {listed(" FILTER (WHERE base)")} AS base_spans, {listed("")} AS spans FROM placed GROUP BY r)
SELECT doc_id, {", ".join(f"CAST(coalesce(n_{k}, 0) AS BIGINT) AS n_{k}" for k in secrets.BASE)}, sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN found USING (r)
"""


TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

RANKED = f"""
WITH items AS (SELECT DISTINCT item_id, unnest({_words("text", TERM, True)}) AS term FROM benchmark),
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_words("text", TERM, True)} AS w FROM documents),
sizes AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS words FROM d WHERE len(w) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS weight FROM df, sizes),
m AS (SELECT r, doc_id, 100 - 50 + (50 * len(w) * docs) // words AS m FROM d, sizes WHERE len(w) > 0),
scores AS (SELECT item_id, r, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM items JOIN tf USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY item_id, r, doc_id),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, r) AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""
