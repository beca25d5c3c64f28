"""DuckDB SQL for the registered queries that SQL can express on whole tables.

The others (tokenizer, alignment, fitted trees, rule tables, nested quotes) are tested against
brute force in ``tests/llm``.
"""

from __future__ import annotations

from cordon.llm import hostrules, jaccard, mixing, negatives, secrets, suffixdedup

WORD = r"[^\x20\x09-\x0D]+"


def _mix() -> str:
    weights = ", ".join(f"CAST({w} AS DOUBLE)" for w in mixing.WEIGHTS)
    rounds = " UNION ALL ".join(f"SELECT *, (served + source_size * {e}) / target AS finish, {e + 1} AS round FROM queue WHERE size > 0 AND target > 0"
                                for e in range(mixing.MAX_ROUNDS))
    return f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '-')) AS key
  FROM documents
),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, [{weights}][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} AS INTEGER) + 1] AS weight,
         CAST(sum(source_size) OVER () AS DOUBLE) AS budget, CAST(source_size AS DOUBLE) * {mixing.MAX_ROUNDS} AS cap
  FROM per
),
levelled AS (
  SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
            / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked
),
chosen AS (SELECT level FROM levelled WHERE level <= cap / weight ORDER BY cap / weight, level LIMIT 1),
targets AS (
  SELECT source, source_size, budget,
         CASE WHEN source_size = 0 THEN 0.0 ELSE coalesce(least(cap, (SELECT level FROM chosen) * weight), cap) END AS target
  FROM ranked
),
queue AS (
  SELECT s.*, t.source_size, t.target, t.budget, sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key ROWS UNBOUNDED PRECEDING) AS served
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
),
copies AS ({rounds}),
ordered AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source IS NULL, coalesce(source, ''), key, served, round ROWS UNBOUNDED PRECEDING) AS upto FROM copies
),
taken AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS copies FROM ordered WHERE upto <= budget GROUP BY doc_id)
SELECT q.doc_id, q.size, q.source_size, q.target, CAST(q.size * coalesce(t.copies, 0) AS BIGINT) AS taken, coalesce(t.copies, 0) AS copies
FROM queue q LEFT JOIN taken t ON q.doc_id = t.doc_id
"""


def _host_rules() -> str:
    r = hostrules.DEFAULT
    low, high = r.word_length
    return rf"""
WITH split AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l
  FROM documents
),
grams AS (SELECT doc_id, i, array_to_string(w[i:i + 4], chr(10)) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM split)),
often AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
repeats AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM often, (SELECT unnest(range(0, 5)) AS k) GROUP BY doc_id),
m AS (
  SELECT s.doc_id, s.source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(t) - length(regexp_replace(t, '{WORD}', '', 'g')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(l) AS BIGINT) AS n_lines,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM split s LEFT JOIN repeats r ON s.doc_id = r.doc_id
),
failed AS (
  SELECT *, n_words < {r.min_words} OR n_repeat_words * 100 > n_words * {r.max_repeat_pct} AS base_failed,
         CAST(n_words < {r.min_words} AS BIGINT) + CAST(n_repeat_words * 100 > n_words * {r.max_repeat_pct} AS BIGINT)
         + CAST(n_symbols * 100 > n_words * {r.max_symbol_pct} AS BIGINT) + CAST(n_dup_lines * 100 > n_lines * {r.max_dup_line_pct} AS BIGINT)
         + CAST(word_chars < n_words * {low} OR word_chars > n_words * {high} AS BIGINT) AS n_failed
  FROM m
),
hosts AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE n_failed > 0) AS bad FROM failed GROUP BY source),
prior AS (SELECT avg(bad / n) AS mean, var_pop(bad / n) AS var FROM hosts),
shrunk AS (
  SELECT source, (bad + mean * k) / (n + k) AS rate, (bad + mean * k) / (n + k) > {r.reject_rate} AS rejected
  FROM hosts, (SELECT mean, CASE WHEN var > 0 THEN least(greatest(mean * (1 - mean) / var - 1, 1.0), {r.max_prior}) ELSE {r.max_prior} END AS k FROM prior)
)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (rejected AND n_failed > 0) AS kept, n_failed, round(rate * 1e6) / 1e6 AS host_rate, rejected AS host_rejected
FROM failed f JOIN shrunk s ON f.source IS NOT DISTINCT FROM s.source
"""


def _spans(kind: str, pattern: str, keep: str) -> str:
    """Matches of a pattern with their places: a match starts after all pieces and matches before it."""
    p = pattern.replace("'", "''")
    rank = secrets.KINDS.index(kind)
    return f"""
SELECT doc_id, {rank} AS rank, '{kind}' AS kind, start, start + length(found) AS stop, found FROM (
  SELECT doc_id, found[i] AS found, list_sum(list_transform(between[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS start
  FROM (SELECT doc_id, found, between, unnest(range(1, len(found) + 1)) AS i
        FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{p}') AS found, string_split_regex(coalesce(text, ''), '{p}') AS between FROM documents))
) WHERE {keep}
"""


def _secrets() -> str:
    rule = secrets.DEFAULT
    value = secrets.ASSIGN.replace("'", "''")
    allow = " OR ".join(f"regexp_matches(found, '{a}')" for a in rule.allow)
    joined = "string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, rank)"
    return f"""
WITH base AS (
  {_spans("assign", secrets.ASSIGN, f"length(regexp_extract(found, '^{value}$', 1)) >= {secrets.ASSIGN_MIN}")}
  UNION ALL {_spans("access", "AKIA[A-Z0-9]+", "length(found) >= 20")}
  UNION ALL {_spans("hex", "[0-9a-f]+", "length(found) >= 24")}
),
candidates AS ({_spans("entropy", "[A-Za-z0-9+/_=-]{20,}", "regexp_matches(found, '[0-9]')")}),
open_ AS (SELECT row_number() OVER () AS id, * FROM candidates c
          WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = c.doc_id AND b.start < c.stop AND c.start < b.stop) AND NOT ({allow})),
windows AS (SELECT id, substr(found, CAST(i AS BIGINT), {rule.window}) AS w, i FROM (SELECT id, found, unnest(range(1, length(found) - {rule.window} + 2)) AS i FROM open_)),
counts AS (SELECT id, i, count(*) AS c FROM (SELECT id, i, unnest(string_split(w, '')) AS ch FROM windows) GROUP BY id, i, ch),
bits AS (SELECT id, max(h) AS h FROM (SELECT id, i, log2({rule.window}) - sum(c * log2(c)) / {rule.window} AS h FROM counts GROUP BY id, i) GROUP BY id),
added AS (
  SELECT o.* EXCLUDE (id) FROM open_ o JOIN bits b ON o.id = b.id
  WHERE b.h >= CASE WHEN regexp_matches(found, '^([0-9a-f]+|[0-9A-F]+)$') THEN {rule.hex_bits}
                    WHEN regexp_matches(found, '^[A-Za-z0-9]+$') THEN {rule.alnum_bits} ELSE {rule.base64_bits} END
),
per_base AS (SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
                    count(*) FILTER (WHERE kind = 'hex') AS n_hex, {joined} AS s FROM base GROUP BY doc_id),
per_all AS (SELECT doc_id, {joined} AS s FROM (SELECT * FROM base UNION ALL SELECT * FROM added) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b.s, '')) AS base_sha256, coalesce(a.s, '') AS spans
FROM documents d LEFT JOIN per_base b ON d.doc_id = b.doc_id LEFT JOIN per_all a ON d.doc_id = a.doc_id
"""


def _repeats() -> str:
    n = suffixdedup.LENGTH
    return f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents),
windows AS (SELECT doc_id, i, md5(substr(h, CAST(2 * i + 1 AS BIGINT), {2 * n})) AS w FROM (SELECT doc_id, h, unnest(range(0, n - {n - 1})) AS i FROM d)),
later AS (SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, i) > 1),
edges AS (SELECT doc_id, i, i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {n}, -1) AS new FROM later),
numbered AS (SELECT doc_id, i, sum(CAST(new AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS k FROM edges),
removed AS (SELECT doc_id, k, min(i) AS start, max(i) + {n} AS stop FROM numbered GROUP BY doc_id, k),
borders AS (
  SELECT doc_id, 0 AS a, min(start) AS b FROM removed GROUP BY doc_id
  UNION ALL
  SELECT r.doc_id, r.stop AS a, coalesce(lead(r.start) OVER (PARTITION BY r.doc_id ORDER BY r.start), d.n) AS b FROM removed r JOIN d ON r.doc_id = d.doc_id
),
kept AS (
  SELECT x.doc_id, string_agg(substr(d.h, CAST(2 * x.a + 1 AS BIGINT), CAST(2 * (x.b - x.a) AS BIGINT)), '' ORDER BY x.a) AS h
  FROM borders x JOIN d ON x.doc_id = d.doc_id GROUP BY x.doc_id
),
per AS (SELECT doc_id, CAST(sum(stop - start) AS BIGINT) AS n_removed, count(*) AS n_spans FROM removed GROUP BY doc_id)
SELECT d.doc_id, d.n AS n_bytes, coalesce(p.n_removed, 0) AS n_removed, coalesce(p.n_spans, 0) AS n_spans, sha256(unhex(coalesce(k.h, d.h))) AS kept_sha256
FROM d LEFT JOIN per p ON d.doc_id = p.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id
"""


def _jaccard() -> str:
    k = jaccard.WORDS
    t = jaccard.THRESHOLD
    upper = "".join(map(chr, range(65, 91)))
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{WORD}') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + {k - 1}], chr(10)) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {k - 2}, least(len(w), 1) + 1))) AS i FROM w)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM both_ JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE {t.denominator} * c >= {t.numerator} * (nx.n + ny.n - c)
),
sides AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM reach r JOIN sides e ON r.y = e.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) r ON r.x = d.doc_id
"""


def _manifest() -> str:
    """Levels of the forest and of the tree over its roots by ``GROUP BY idx // 3``; proofs by joins per level; crc32 bit by bit."""
    def field(x):
        return f"CASE WHEN {x} IS NULL THEN '-' ELSE octet_length(encode(CAST({x} AS VARCHAR))) || ':' || CAST({x} AS VARCHAR) END"

    def leaf(text):
        return f"sha256({' || '.join([field(c) for c in ('doc_id', 'source', 'lang', 'n_chars')] + [field(text)])})"

    step = "CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    crc = ("list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))), "
           f"lambda acc, x: list_reduce(list_concat([xor(acc, x)], list_transform(range(8), lambda z: CAST(0 AS BIGINT))), lambda a, b: {step}))")

    def levels(name, start):
        return f"""
{name} AS (
  {start}
  UNION ALL
  SELECT tree, level + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), any_value((n + 2) // 3)
  FROM {name} WHERE n > 1 GROUP BY tree, level, idx // 3
)"""

    def climb(name, start, nodes):
        return f"""
{name} AS (
  {start}
  UNION ALL
  SELECT c.row, c.tree, c.level + 1, c.idx // 3,
         c.proof || coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (WHERE s.idx <> c.idx), ''),
         sha256(string_agg(CASE WHEN s.idx = c.idx THEN c.fold ELSE s.h END, '' ORDER BY s.idx))
  FROM {name} c JOIN {nodes} s ON s.tree = c.tree AND s.level = c.level AND s.idx // 3 = c.idx // 3
  WHERE s.n > 1 GROUP BY c.row, c.tree, c.level, c.idx, c.proof, c.fold
)"""

    return f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS tree, {leaf("text")} AS leaf,
         CASE WHEN (xor({crc}, 4294967295)) % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS other
  FROM documents
),
placed AS (
  SELECT *, row_number() OVER () AS row, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY tree) AS n FROM hashed
),
{levels("nodes", "SELECT tree, 0 AS level, CAST(idx AS BIGINT) AS idx, leaf AS h, CAST(n AS BIGINT) AS n FROM placed")},
subroots AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
{levels("top", "SELECT '' AS tree, 0 AS level, CAST(idx AS BIGINT) AS idx, h, CAST(n AS BIGINT) AS n FROM subroots")},
{climb("lower", "SELECT row, tree, 0 AS level, CAST(idx AS BIGINT) AS idx, '' AS proof, other AS fold FROM placed", "nodes")},
{climb("upper", "SELECT l.row, '' AS tree, 0 AS level, CAST(s.idx AS BIGINT) AS idx, l.proof, l.fold FROM lower l JOIN nodes e ON e.tree = l.tree AND e.level = l.level AND e.n = 1 JOIN subroots s ON s.tree = l.tree", "top")}
SELECT p.doc_id, p.leaf, s.h AS subroot, r.h AS root, sha256(u.proof) AS proof_sha256, u.fold AS folded_root, u.fold = r.h AS verified
FROM placed p JOIN subroots s ON s.tree = p.tree JOIN (SELECT level, h FROM top WHERE n = 1) r ON true
JOIN upper u ON u.row = p.row AND u.level = r.level
"""


def _negatives() -> str:
    p, n = negatives.POSITIVES, negatives.NEGATIVES
    return f"""
WITH rows_ AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, row_number() OVER () AS uid,
         list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.uid, a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
         CAST(list_sum(list_transform(list_zip(a.v, r.v), lambda z: coalesce(z[1], 0) * coalesce(z[2], 0))) AS BIGINT) AS score
  FROM rows_ a JOIN rows_ r ON a.uid <> r.uid WHERE a.vec_id % 100 = 0
),
positives AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, id) AS slot FROM scored WHERE same QUALIFY slot <= {p})
SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.uid, p.slot ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
       s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.uid = p.uid AND NOT s.same AND {negatives.LEAST} * p.score <= 100 * s.score AND 100 * s.score <= {negatives.MOST} * p.score
QUALIFY rank <= {n}
"""


def llm_oracle_sql() -> dict[str, str]:
    return {"op1_suffix_merge_dedup": _repeats(), "op4_jaccard_metric_join": _jaccard(), "op8_host_rules": _host_rules(),
            "op9_entropy_secrets": _secrets(), "op10_fair_queue_mix": _mix(),
            "op11_postorder_manifest": _manifest(), "op13_multi_index_negatives": _negatives()}
