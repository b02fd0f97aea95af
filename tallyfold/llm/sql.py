"""DuckDB SQL that restates the queries which SQL can express."""

from __future__ import annotations

from tallyfold.llm import boilerplate, centroids, licenses, mixing


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _html_text(column: str) -> str:
    out = f"regexp_replace({column}, {_quoted(boilerplate.BREAKS)}, chr(10), 'g')"
    out = f"regexp_replace({out}, {_quoted(boilerplate.HIDDEN)}, '', 'g')"
    for name, sign in boilerplate.ENTITIES:
        out = f"replace({out}, {_quoted(name)}, {_quoted(sign)})"
    return out


def site_lines() -> str:
    trimmed = "trim(x, ' ' || chr(9) || chr(13))"
    return f"""
WITH p AS (
  SELECT page_id, nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1)), '') AS host,
         {_html_text("html")} AS text
  FROM pages),
l AS (SELECT page_id, host, text, string_split(text, chr(10)) AS lines FROM p),
d AS (SELECT host, unnest(list_distinct(list_filter(list_transform(lines, lambda x: {trimmed}), lambda x: x <> ''))) AS line
      FROM l WHERE host IS NOT NULL),
t AS (SELECT host, count(*) AS pages FROM p WHERE host IS NOT NULL GROUP BY host),
b AS (SELECT d.host, d.line FROM d JOIN t USING (host) GROUP BY d.host, d.line
      HAVING count(*) >= {boilerplate.MIN_PAGES} AND count(*) > {boilerplate.RATIO} * any_value(t.pages)),
f AS (SELECT host, list(line) AS frame FROM b GROUP BY host),
r AS (SELECT l.page_id, l.host, l.text, l.lines,
             list_filter(l.lines, lambda x: NOT list_contains(coalesce(f.frame, []), {trimmed})) AS rest
      FROM l LEFT JOIN f USING (host))
SELECT page_id, host,
       coalesce(len(list_filter(lines, lambda x: {trimmed} <> '')), 0)::BIGINT AS n_lines,
       coalesce(len(lines) - len(rest), 0)::BIGINT AS n_dropped,
       CASE WHEN len(rest) < len(lines) THEN coalesce(array_to_string(rest, chr(10)), '') ELSE text END AS text
FROM r"""


def dice() -> str:
    rows = ", ".join(f"({k}, {_quoted(name)}, {_quoted(text)})" for k, (name, text) in enumerate(licenses.TEMPLATES))
    words = "list_filter(regexp_split_to_array(lower({0}), '[^a-z0-9]+'), lambda w: w <> '')"
    grams = "CASE WHEN len(w) = 1 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END"
    return f"""
WITH t AS (SELECT template, license, len(w) AS n_words, {grams} AS grams
           FROM (SELECT template, license, {words.format("text")} AS w FROM (VALUES {rows}) AS v(template, license, text))),
s AS (SELECT DISTINCT doc_id, text, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
u AS (SELECT doc_id, text, unnest(range(1, len(lines) + 1)) AS line, unnest(lines) AS unit FROM s
      UNION ALL SELECT doc_id, text, 0 AS line, text AS unit FROM s WHERE len(lines) > 1),
g AS (SELECT doc_id, text, line, {grams} AS grams
      FROM (SELECT doc_id, text, line, {words.format("unit")} AS w FROM u) WHERE len(w) > 0),
c AS (SELECT g.doc_id, g.line, t.template, t.license,
             2.0::DOUBLE * len(list_intersect(g.grams, t.grams)) / (len(g.grams) + len(t.grams)) AS dice
      FROM g, t WHERE len(g.grams) BETWEEN len(t.grams) * {licenses.THRESHOLD} / (2 - {licenses.THRESHOLD})
                                       AND len(t.grams) * (2 - {licenses.THRESHOLD}) / {licenses.THRESHOLD}),
a AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {words.format("text")} AS w FROM s),
h AS (SELECT r, i, w[i] || ' ' || w[i + 1] AS gram FROM (SELECT r, w, unnest(range(1, len(w))) AS i FROM a)),
k AS (SELECT r, i, template, n_words, size,
             count(*) OVER (PARTITION BY r, template ORDER BY i RANGE BETWEEN CURRENT ROW AND (n_words - 2) FOLLOWING) AS hits
      FROM h JOIN (SELECT template, n_words, len(grams) AS size, unnest(grams) AS gram FROM t WHERE n_words > 1) USING (gram)),
x AS (SELECT doc_id, template, {grams} AS grams
      FROM (SELECT doc_id, template, w[i:i + n_words - 1] AS w FROM k JOIN a USING (r)
            WHERE hits >= size * {licenses.THRESHOLD} / (2 - {licenses.THRESHOLD}) - 1e-9)),
f AS (SELECT doc_id, line, template, license, dice FROM c
      UNION ALL
      SELECT doc_id, 0 AS line, t.template, t.license,
             2.0::DOUBLE * len(list_intersect(x.grams, t.grams)) / (len(x.grams) + len(t.grams)) AS dice
      FROM x JOIN t USING (template))
SELECT doc_id, line::BIGINT AS line, arg_max(license, dice * 1000000 - template) AS license, max(dice) AS dice
FROM f WHERE dice >= {licenses.THRESHOLD} GROUP BY doc_id, line, CASE WHEN line = 0 THEN license END"""


def mix() -> str:
    """The level at which the targets meet the total: the first rank, by cap over weight, whose share stays below its cap."""
    weights = ", ".join(map(str, mixing.WEIGHTS))
    return f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, {_quoted(mixing.WORD)})), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|0'), 1, 15))::BIGINT AS draw
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             ([{weights}])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)}] AS weight
      FROM d GROUP BY source),
r AS (SELECT *, {mixing.MAX_EPOCHS} * source_size AS cap, sum(source_size) OVER () AS total,
             row_number() OVER (ORDER BY {mixing.MAX_EPOCHS} * source_size / weight, source NULLS LAST) AS k FROM s),
c AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS open_size,
             (sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS open_weight FROM r),
v AS (SELECT open_size, open_weight FROM c WHERE open_size * weight <= cap * open_weight ORDER BY k LIMIT 1),
t AS (SELECT source, source_size,
             least(cap::DOUBLE, v.open_size::DOUBLE * weight::DOUBLE / v.open_weight::DOUBLE) AS target FROM c, v),
b AS (SELECT *, least(floor(target + 0.5)::BIGINT, {mixing.MAX_EPOCHS} * source_size) AS budget FROM t),
p AS (SELECT d.doc_id, d.source, d.size, b.source_size, b.target, b.budget,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.doc_id, d.size
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS begins
      FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0
            ELSE (budget // source_size) * size + greatest(0, least(size, budget % source_size - begins)) END::BIGINT AS taken
FROM p"""


def trie() -> str:
    """Nodes by the text of their turns' ids; crc32 bit by bit."""
    turn = "md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))"
    n_words = f"coalesce(len(regexp_extract_all(text, {_quoted(mixing.WORD)})), 0)"
    bits = "list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    codes = "list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, b: {bits}), 4294967295)"
    return f"""
WITH o AS (SELECT conv_id, list({{'id': id, 'words': words}} ORDER BY turn NULLS FIRST, id) AS ts
           FROM (SELECT conv_id, turn, {turn} AS id, {n_words} AS words FROM conversations WHERE conv_id IS NOT NULL)
           GROUP BY conv_id),
r AS (SELECT o.conv_id, list_concat(coalesce(b.ts, [])[1:h], o.ts[h + 1:]) AS ts
      FROM (SELECT *, ({crc} % 4)::BIGINT AS h FROM o) AS o LEFT JOIN o AS b ON b.conv_id = o.conv_id - o.conv_id % 20),
m AS (SELECT conv_id, d, array_to_string(list_transform(ts[1:d], lambda t: t.id), '') AS path,
             CASE WHEN d > 0 THEN array_to_string(list_transform(ts[1:d - 1], lambda t: t.id), '') END AS up,
             coalesce(ts[d].words, 0) AS words, len(ts) = d AS ended
      FROM (SELECT *, unnest(range(len(ts) + 1)) AS d FROM r)),
n AS MATERIALIZED (
  SELECT path, any_value(up) AS up, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * any_value(words) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ended), '')) AS ends_sha256
  FROM m GROUP BY path),
c AS (SELECT up AS path, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY up),
t AS (SELECT substr(n.path, 1, 32 * k) AS path, sum(n.saved)::BIGINT AS saved_tokens, count(*) FILTER (WHERE c.path IS NULL) AS n_leaves
      FROM (SELECT *, unnest(range(depth + 1)) AS k FROM n) AS n LEFT JOIN c ON c.path = n.path GROUP BY 1)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children,
       t.n_leaves, t.saved_tokens, n.ends_sha256
FROM n JOIN t ON t.path = n.path LEFT JOIN n AS p ON p.path = n.up LEFT JOIN c ON c.path = n.path"""


def clusters(rounds: int = 10, k: int = 8) -> str:
    """Every round is a pair of tables: nearest centroids, and their exact floors."""
    reach, scale = centroids.REACH, centroids.SCALE
    out = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x) AND abs(x::DOUBLE) < {reach})) = 64),
e AS MATERIALIZED (SELECT r, unnest(range(64)) AS i, unnest(x) AS x FROM v),
s AS (SELECT row_number() OVER (ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, '')), x) - 1 AS k, x FROM v),
c0 AS MATERIALIZED (SELECT k, unnest(range(64)) AS i, unnest(x) AS c FROM s WHERE k < {k})"""
    for n in range(rounds + 1):
        out += f""",
a{n} AS MATERIALIZED (
  SELECT r, min({{'d': d, 'k': k}}) AS m
  FROM (SELECT r, k, sum((x - c) * (x - c))::BIGINT AS d FROM e JOIN c{n} USING (i) GROUP BY r, k) GROUP BY r)"""
        if n < rounds:
            out += f""",
c{n + 1} AS MATERIALIZED (
  SELECT k, i, coalesce((t - ((t % n) + n) % n) // n, c)::BIGINT AS c
  FROM c{n} LEFT JOIN (SELECT m.k AS k, i, sum(x)::BIGINT AS t, count(*) AS n FROM a{n} JOIN e USING (r) GROUP BY m.k, i) USING (k, i))"""
    return f"""{out},
h AS (SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY k)
SELECT vec_id, m.k::INTEGER AS cluster, m.d AS distance, (sum(m.d) OVER (PARTITION BY m.k))::BIGINT AS cluster_inertia,
       (sum(m.d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN h ON h.k = m.k"""


SQL = {"op7_site_lines": site_lines(), "op10_dice": dice(), "op11_trie": trie(), "op12_centroids": clusters(), "op13_mixing": mix()}
