"""DuckDB statements of the operators that SQL can express."""

from __future__ import annotations

from rollwise.llm import manifest, url_filter, vector_codes


def vector_code_sql() -> str:
    parts, entries, scale = vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.SCALE
    steps = [f"""
kept AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS MATERIALIZED (SELECT vec_id, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS x
  FROM kept, (SELECT unnest(range({parts})) AS p)),
book0 AS MATERIALIZED (SELECT p, e, x FROM part JOIN
  (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT {entries}) USING (vec_id))"""]
    near = f"""
near{{k}} AS MATERIALIZED (SELECT vec_id, part.p, min(CAST(list_sum(list_transform(list_zip(part.x, b.x),
  lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) * {entries} + b.e) AS m FROM part JOIN book{{k}} AS b USING (p) GROUP BY ALL)"""
    for k in range(vector_codes.ROUNDS):
        steps.append(near.format(k=k))
        steps.append(f"""
mean{k} AS MATERIALIZED (SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM
  (SELECT p, m % {entries} AS e, i, sum(x[i]) AS s, count(*) AS n FROM
    (SELECT part.p, m, x, unnest(range(1, len(x) + 1)) AS i FROM near{k} JOIN part USING (vec_id, p)) GROUP BY ALL) GROUP BY ALL),
book{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(mean{k}.x, old.x) AS x FROM book{k} AS old LEFT JOIN mean{k} USING (p, e))""")
    last = vector_codes.ROUNDS
    steps.append(near.format(k=last))
    return f"""WITH {','.join(steps)},
coded AS MATERIALIZED (SELECT vec_id, label, string_agg(format('{{:02x}}', m % {entries}), '' ORDER BY p) AS code,
  CAST(sum(m // {entries}) AS BIGINT) AS error FROM near{last} JOIN kept USING (vec_id) GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, i)) FROM
    (SELECT p, e, unnest(x) AS c, unnest(range(len(x))) AS i FROM book{last})) AS codebooks_sha256 FROM coded"""


def _field(c: str) -> str:
    text = f"CAST({c} AS VARCHAR)"
    return f"coalesce(CAST(strlen({text}) AS VARCHAR) || ':' || {text}, '-')"


#: CRC-32 of the decimal doc_id, bit by bit.
_CRC = ("xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: CAST(ord(s) AS BIGINT)), "
        "lambda c, b: list_reduce(range(8), lambda d, i: xor(d >> 1, (d & 1) * 3988292384), xor(c, b)), 4294967295), 4294967295)")


def _tree(name: str, leaves: str, depth: int) -> list[str]:
    """Levels ``name``0.. of the trees over ``leaves`` (g, idx, h): each node's
    digest and its siblings' texts to the left and right (l, r)."""
    out, before, w = [], leaves, manifest.ARITY
    for k in range(depth):
        out.append(f"""
{name}{k} AS MATERIALIZED (SELECT g, idx, h, n, CASE WHEN n > 1 THEN array_to_string(run[1 : idx % {w}], '') ELSE '' END AS l,
  CASE WHEN n > 1 THEN array_to_string(run[idx % {w} + 2 :], '') ELSE '' END AS r FROM
  (SELECT *, count(*) OVER (PARTITION BY g) AS n, list(h) OVER (PARTITION BY g, idx // {w} ORDER BY idx
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS run FROM {before}))""")
        out.append(f"""
{name}_up{k} AS MATERIALIZED (SELECT g, idx // {w} AS idx, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY idx))
  ELSE any_value(h) END AS h FROM {name}{k} GROUP BY g, idx // {w})""")
        before = f"{name}_up{k}"
    return out


def manifest_sql(depth: int = 14, top: int = 8) -> str:
    """For at most ARITY ** depth documents a source, ARITY ** top sources."""
    text = "replace(text, chr(10), '')"
    leaf = "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || {})"
    steps = [f"""
doc AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM
  (SELECT doc_id, {leaf.format(_field('text'))} AS leaf, {leaf.format(_field(text))} AS changed,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g FROM documents)),
leaves AS (SELECT g, idx, leaf AS h FROM doc)"""]
    steps += _tree("low", "leaves", depth)
    steps.append(f"\nsubroots AS MATERIALIZED (SELECT 0 AS g, g AS idx, h FROM low_up{depth - 1})")
    steps += _tree("high", "subroots", top)
    w = manifest.ARITY
    joins = [f"JOIN low{k} ON low{k}.g = doc.g AND low{k}.idx = doc.idx // {w ** k}" for k in range(depth)]
    joins += [f"JOIN high{k} ON high{k}.idx = doc.g // {w ** k}" for k in range(top)]
    levels = [f"low{k}" for k in range(depth)] + [f"high{k}" for k in range(top)]
    sides = ", ".join(f"{t}.l AS l{i}, {t}.r AS r{i}, {t}.n > 1 AS more{i}" for i, t in enumerate(levels))
    steps.append(f"\nfold0 AS MATERIALIZED (SELECT doc_id, leaf, doc.g, {sides}, CASE WHEN {_CRC} % 2 = 0 THEN coalesce(changed, leaf) "
                 f"ELSE leaf END AS f FROM doc {' '.join(joins)})")
    for i in range(len(levels)):
        steps.append(f"\nfold{i + 1} AS MATERIALIZED (SELECT * REPLACE (CASE WHEN more{i} THEN sha256(l{i} || f || r{i}) ELSE f END AS f) FROM fold{i})")
    proof = " || ".join(f"l{i} || r{i}" for i in range(len(levels)))
    return f"""WITH {','.join(steps)}
SELECT doc_id, leaf, s.h AS subroot, t.h AS root, sha256({proof}) AS proof_sha256, f AS folded_root, f = t.h AS verified
FROM fold{len(levels)} AS d JOIN subroots AS s ON s.idx = d.g, high_up{top - 1} AS t"""


def url_filter_sql(rules: list[tuple[str, str, str]]) -> str:
    listed = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)
    return f"""WITH page AS (SELECT row_number() OVER () AS k, page_id,
  coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
listed(h, p, v) AS (VALUES {listed}),
best AS (SELECT k, max_by(h || p, length(h || p) * 100000 + length(h)) AS rule, max_by(v, length(h || p) * 100000 + length(h)) AS verdict
  FROM page, listed WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY k)
SELECT page_id, host, path, rule, coalesce(verdict, '{url_filter.UNLISTED}') AS verdict FROM page LEFT JOIN best USING (k)"""
