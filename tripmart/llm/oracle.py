"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

from tripmart.llm.quality import RULES

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
    f" 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}')"
)

STATEMENTS: dict[str, str] = {}

STATEMENTS["op2_decontamination"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item, least(len(w), 10) AS k,
    array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS t
  FROM i, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS u(s) WHERE len(w) > 0),
ks AS (SELECT DISTINCT k FROM iw),
dw AS (
  SELECT r, k, s, array_to_string(w[s : s + k - 1], ' ') AS t
  FROM d, ks, unnest(range(1, len(w) - k + 2)) AS u(s)),
h AS (SELECT r, s, k, item FROM dw JOIN iw USING (k, t)),
p AS (SELECT r, count(DISTINCT s + j) AS n_hit FROM h, unnest(range(0, k)) AS v(j) GROUP BY r),
n AS (SELECT r, list_sort(list(DISTINCT item)) AS items FROM h GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(items), 0) AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (r) LEFT JOIN n USING (r)
"""

# Kinds in their order, patterns, least length (of the second group for assign).
_KINDS = [
    ("assign", r"(?i:password|passwd|secret|token|api_?key)[\"\x27]?\x20*[:=]\x20*[\"\x27]?([A-Za-z0-9+/_.=-]+)", 1, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
    ("private_key", r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----", 0, 1),
    ("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 1),
    ("host_token", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("url_login", r"[A-Za-z][A-Za-z0-9+.-]{1,20}://[^/:@\x00-\x20]{1,100}:[^/:@\x00-\x20]{1,100}@", 0, 1),
]


def _secrets() -> str:
    each = "\nUNION ALL\n".join(
        f"""SELECT r, '{kind}' AS kind, {rank} AS rank, unnest(p) AS gap, unnest(m) AS width, unnest(g) AS checked,
  {least} AS least, unnest(range(1, len(p) + 1)) AS place
FROM (SELECT r, list_transform(string_split_regex(t, '{pattern}'), lambda x: length(x)) AS p,
  list_transform(regexp_extract_all(t, '{pattern}'), lambda x: length(x)) AS m,
  list_transform(regexp_extract_all(t, '{pattern}', {group}), lambda x: length(x)) AS g FROM d
  WHERE regexp_matches(t, '{pattern}'))"""
        for rank, (kind, pattern, group, least) in enumerate(_KINDS)
    )
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
e AS ({each}),
f AS (
  SELECT *, sum(gap) OVER w + coalesce(sum(width) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b
  FROM e WINDOW w AS (PARTITION BY r, kind ORDER BY place)),
s AS (
  SELECT r, kind, rank, b::BIGINT AS b, kind || ':' || b::BIGINT || ':' || (b + width)::BIGINT AS span
  FROM f WHERE width IS NOT NULL AND checked >= least)
SELECT doc_id, count(span) FILTER (kind = 'assign') AS n_assign,
  count(span) FILTER (kind = 'access') AS n_access, count(span) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(span, ',' ORDER BY b, rank) FILTER (rank < 3), '')) AS base_sha256,
  coalesce(string_agg(span, ',' ORDER BY b, rank), '') AS spans
FROM d LEFT JOIN s USING (r) GROUP BY r, doc_id
"""


STATEMENTS["op7_secret_scan"] = _secrets()


def source_mix(shard_words: int = 131072) -> str:
    """Quotients are listed in full and ranked; sources at their limit are found in order of size / weight."""
    return f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
    md5('0:' || coalesce(doc_id::VARCHAR, '')) AS place FROM documents),
n AS (SELECT sum(size)::BIGINT AS total FROM d),
sh AS (SELECT source, greatest(1, ((sum(size) + {shard_words - 1}) // {shard_words})::BIGINT) AS shards FROM d GROUP BY source),
e AS MATERIALIZED (
  SELECT d.*, ('0x' || substr(place, 1, 8))::BIGINT % shards AS shard FROM d JOIN sh ON d.source IS NOT DISTINCT FROM sh.source),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM e GROUP BY source),
o AS (
  SELECT s.*, 3 * total - coalesce(4 * sum(source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS r2,
    sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight,
    row_number() OVER w AS k
  FROM s, n WINDOW w AS (ORDER BY source_size / weight, source NULLS LAST)),
f AS (SELECT min(k) AS k FROM o WHERE weight * r2 <= 4 * source_size * open_weight),
l AS (SELECT (r2 / 2.0)::DOUBLE AS level, open_weight FROM o JOIN f USING (k)),
t AS MATERIALIZED (
  SELECT source, source_size, CASE WHEN o.k < f.k THEN (2 * source_size)::DOUBLE
    ELSE o.weight * level / l.open_weight::DOUBLE END AS target FROM o, f, l),
b AS (SELECT floor(total * 1.5 / 64 + 0.5)::BIGINT AS blocks FROM n),
q AS (
  SELECT source, row_number() OVER (ORDER BY target / (2 * a + 1) DESC, source NULLS LAST, a) AS place
  FROM t, b, unnest(range(0, (2 * target / 64)::BIGINT + 22)) AS u(a) WHERE target > 0),
g AS (SELECT source, count(*) AS seats FROM q, b WHERE place <= blocks GROUP BY source),
c AS MATERIALIZED (SELECT source, shard, sum(size)::BIGINT AS cell_size FROM e GROUP BY source, shard),
h AS (
  SELECT c.source, shard, seats,
    row_number() OVER (PARTITION BY c.source ORDER BY cell_size::DOUBLE / (2 * a + 1) DESC, shard, a) AS place
  FROM c JOIN g ON c.source IS NOT DISTINCT FROM g.source, unnest(range(0, seats)) AS u(a) WHERE cell_size > 0),
i AS (SELECT source, shard, count(*) AS quota FROM h WHERE place <= seats GROUP BY source, shard),
j AS (
  SELECT c.source, c.shard, cell_size, coalesce(quota, 0) * 64 AS given, 2 * cell_size AS most
  FROM c LEFT JOIN i ON c.source IS NOT DISTINCT FROM i.source AND c.shard = i.shard),
p AS (
  SELECT source, shard, cell_size, (least(given, most) + least(greatest(0, most - given), greatest(0,
    sum(greatest(0, given - most)) OVER (PARTITION BY source)
    - coalesce(sum(greatest(0, most - given)) OVER (
        PARTITION BY source ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))))::BIGINT AS amount
  FROM j),
v AS (
  SELECT e.*, coalesce(sum(size) OVER (PARTITION BY source, shard ORDER BY place, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM e)
SELECT doc_id, v.size, t.source_size, t.target,
  (CASE WHEN v.size > 0 THEN amount // cell_size * v.size
    + greatest(0, least(v.size, amount % cell_size - start)) ELSE 0 END)::BIGINT AS taken
FROM v JOIN p ON v.source IS NOT DISTINCT FROM p.source AND v.shard = p.shard
JOIN t ON v.source IS NOT DISTINCT FROM t.source
"""


STATEMENTS["op8_source_mix"] = source_mix()

# Each capture's keys against the last change of each entry up to its fetch day.
STATEMENTS["op6_url_filters"] = """
WITH p AS (
  SELECT row_number() OVER () AS r, page_id, url, (page_id * 37) % 365 AS day,
    coalesce(lower(rtrim(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '.')), '') AS host,
    list_filter(string_split(regexp_extract(url, '^[^:/?#]+://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS steps
  FROM pages),
h AS (SELECT host, min(page_id) AS m, string_split(host, '.') AS labels FROM p WHERE host <> '' GROUP BY host),
e AS (
  SELECT 'hosts' AS list, 'block' AS verdict, host AS key, 'add' AS action, m * 13 % 200 AS since FROM h
  UNION ALL SELECT 'hosts', 'block', host, 'remove', m * 13 % 200 + 20 + m % 50 FROM h
  UNION ALL SELECT 'hosts', 'block', host, 'add', m * 13 % 200 + 90 FROM h
  UNION ALL SELECT 'sections', 'allow', host || '/' || ['en', 'de', 'fr', 'es'][m % 4 + 1], 'add', m * 13 % 200 + 10 FROM h
  UNION ALL SELECT 'sections', 'allow', host || '/' || ['en', 'de', 'fr', 'es'][m % 4 + 1], 'remove', m * 13 % 200 + 120 FROM h
  UNION ALL SELECT 'domains', 'block', array_to_string(labels[greatest(1, len(labels) - 2) :], '.'), 'add', m * 13 % 200 + 150 FROM h
  UNION ALL SELECT 'domains', 'block', array_to_string(labels[greatest(1, len(labels) - 2) :], '.'), 'remove', m * 13 % 200 + 170 + m % 50 FROM h),
c AS (SELECT list, verdict, key, since, bool_and(action = 'add') AS active FROM e GROUP BY ALL),
k AS (
  SELECT DISTINCT r, day, array_to_string(string_split(host, '.')[i :], '.') AS key
  FROM p, unnest(range(1, len(string_split(host, '.')) + 1)) AS u(i) WHERE host <> ''
  UNION SELECT r, day, host || '/' || array_to_string(steps[1 : i], '/') FROM p, unnest(range(1, len(steps) + 1)) AS u(i) WHERE host <> ''),
s AS (
  SELECT r, key, list, verdict, arg_max(active, since) AS active FROM k JOIN c USING (key) WHERE since <= day
  GROUP BY r, key, list, verdict),
a AS (
  SELECT r, count(*) AS n_active, max({'n': length(key), 'key': key, 'block': (verdict = 'block')::INT}) AS best
  FROM s WHERE active GROUP BY r)
SELECT page_id, url, host, coalesce(n_active, 0) AS n_active, best.key AS matched, coalesce(best.block, 0) = 1 AS blocked
FROM p LEFT JOIN a USING (r)
"""

# The rules as they stand in the operator; thresholds are the feature, so they are not repeated here.
def _quality(rounds: int = 50) -> str:
    names = [f"v{k}" for k in range(len(RULES))]
    votes = ", ".join(f"CASE WHEN {r.bad} THEN -1 WHEN {r.good} THEN 1 ELSE 0 END AS {v}" for v, r in zip(names, RULES, strict=True))
    listed = ", ".join(names)
    start = " + ".join(names)
    steps = [f"p0 AS MATERIALIZED (SELECT {listed}, n, CASE WHEN {start} > 0 THEN 0.99 WHEN {start} < 0 THEN 0.01 ELSE 0.5 END::DOUBLE AS q FROM c)"]
    for k in range(rounds):
        sums = ", ".join(
            f"(1 + coalesce(sum(n * {w}) FILTER ({v} = {vote}), 0)) / (3 + sum(n * {w})) AS {v}_{side}{vote + 1}"
            for v in names for side, w in (("g", "q"), ("b", "(1 - q)")) for vote in (-1, 0, 1))
        steps.append(f"m{k} AS MATERIALIZED (SELECT (1 + sum(n * q)) / (2 + sum(n)) AS good, {sums} FROM p{k})")
        score = " + ".join(
            f"CASE {v} WHEN -1 THEN ln({v}_g0 / {v}_b0) WHEN 1 THEN ln({v}_g2 / {v}_b2) ELSE ln({v}_g1 / {v}_b1) END" for v in names)
        steps.append(
            f"p{k + 1} AS MATERIALIZED (SELECT {listed}, n, 1 / (1 + exp(-(ln(good / (1 - good)) + {score}))) AS q FROM p{k}, m{k})")
    return f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents),
u AS (SELECT r, s, array_to_string(w[s : s + 4], ' ') AS t FROM d, unnest(range(1, len(w) - 3)) AS x(s)),
g AS (SELECT r, t FROM u GROUP BY r, t HAVING count(*) > 1),
e AS (SELECT r, count(DISTINCT s + j) AS n FROM u JOIN g USING (r, t), unnest(range(0, 5)) AS y(j) GROUP BY r),
f AS MATERIALIZED (
  SELECT r, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
    length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS n_upper,
    len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, len(list_distinct(w)) AS n_distinct,
    len(list_filter(l, lambda x: regexp_matches(x, '[.!?:;…。！？]["\\x27»”)\\]]*[\\x20\\x09-\\x0D]*$'))) AS n_ended,
    coalesce(n, 0) AS n_repeat_words
  FROM d LEFT JOIN e USING (r)),
v AS MATERIALIZED (SELECT *, {votes} FROM f),
c AS MATERIALIZED (SELECT {listed}, count(*) AS n FROM v GROUP BY ALL),
{", ".join(steps)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND q >= 0.5 AS kept
FROM v JOIN p{rounds} USING ({listed})
"""


STATEMENTS["op5_quality_rules"] = _quality()

_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def _manifest() -> str:
    """Levels of each language's tree and of the tree of subroots; each document's path is then folded."""
    value = lambda c: f"CASE WHEN ({c}) IS NULL THEN '-' ELSE strlen(({c})::VARCHAR) || ':' || ({c}) END"
    leaf = " || ".join(value(c) for c in _FIELDS)
    other = " || ".join(value("CASE WHEN hit THEN n_chars + 1 ELSE n_chars END" if c == "n_chars" else c) for c in _FIELDS)
    crc = (
        "xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(doc_id::VARCHAR, ''),"
        " lambda x: [ord(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),"
        " lambda c, o: CASE WHEN o >= 0 THEN xor(c, o) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)")
    up = lambda name: f"""
  SELECT lang, level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (n + 1) // 2
  FROM {name} WHERE n > 1 GROUP BY lang, level, i // 2, n"""  # noqa: E731
    return f"""
WITH RECURSIVE c AS MATERIALIZED (SELECT *, coalesce({crc} % 7 = 0, false) AS hit FROM documents),
l AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, lang, sha256({leaf}) AS leaf, sha256({other}) AS other FROM c),
b AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY lang) AS n FROM l),
t AS (SELECT lang, 0 AS level, i, leaf AS h, n FROM b UNION ALL {up("t")}),
s AS MATERIALIZED (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS lang, 0 AS level, i, subroot AS h, n FROM s UNION ALL {up("u")}),
p AS MATERIALIZED (
  SELECT r, t.level AS step, (b.i >> t.level) & 1 AS odd, v.h
  FROM b JOIN t ON t.lang IS NOT DISTINCT FROM b.lang AND t.i = b.i >> t.level AND t.n > 1
  LEFT JOIN t v ON v.lang IS NOT DISTINCT FROM b.lang AND v.level = t.level AND v.i = xor(b.i >> t.level, 1)
  UNION ALL
  SELECT r, 1000 + u.level, (s.i >> u.level) & 1, v.h
  FROM b JOIN s ON s.lang IS NOT DISTINCT FROM b.lang JOIN u ON u.i = s.i >> u.level AND u.n > 1
  LEFT JOIN u v ON v.level = u.level AND v.i = xor(s.i >> u.level, 1)),
w AS MATERIALIZED (
  SELECT r, list(CASE WHEN h IS NULL THEN '' WHEN odd = 1 THEN '<' || h ELSE '>' || h END ORDER BY step) AS path,
    sha256(coalesce(string_agg(h, '' ORDER BY step), '')) AS proof FROM p GROUP BY r),
z AS (
  SELECT b.*, subroot, (SELECT h FROM u WHERE n = 1) AS root, coalesce(proof, sha256('')) AS proof_sha256,
    list_reduce([other] || coalesce(path, []), lambda a, x: sha256(
      CASE WHEN x = '' THEN a WHEN x[1] = '<' THEN x[2:] || a ELSE a || x[2:] END)) AS folded_root
  FROM b LEFT JOIN w USING (r) JOIN s ON s.lang IS NOT DISTINCT FROM b.lang)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM z
"""


STATEMENTS["op13_merkle_manifest"] = _manifest()


def statements() -> dict[str, str]:
    return dict(STATEMENTS)
