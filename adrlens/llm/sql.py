"""DuckDB SQL for the queries that SQL can express over whole tables.

The others have none: 2 and 7 need a tokeniser, 5 and 9 too, 6 and 8 draw on a trained network
and on sampled sketches, 10 on offsets of regular-expression matches; they are tested against
brute force.
"""

from __future__ import annotations

from adrlens.llm.queries import REPUTATION

_USABLE = "len({v}) > 0 AND len(list_filter({v}, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND vec_id IS NOT NULL"

_TOP_K = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE {_USABLE.format(v="embedding")}),
q AS (SELECT DISTINCT vec_id, e FROM v WHERE vec_id % 50 = 0),
s AS (
  SELECT q.vec_id AS query_id, q.e, c.vec_id, TRY_CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id, e ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM s WHERE score IS NOT NULL QUALIFY rank <= 5"""

_RANGE_JOIN = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE {_USABLE.format(v="embedding")} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (
  SELECT vec_id, vec_id AS other FROM v
  UNION SELECT reach.vec_id, link.b FROM reach JOIN link ON link.a = reach.other),
found AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
counted AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
       coalesce(component_id, vec_id) IS NOT DISTINCT FROM vec_id AS kept
FROM embeddings LEFT JOIN found USING (vec_id) LEFT JOIN counted USING (vec_id)"""


def _rule(value) -> str:
    cases = [f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{value(r)}'"
             for r in sorted(REPUTATION.rules, key=lambda r: -len(r.name))]
    return "CASE " + " ".join(cases) + " END"


def _strength(groups: str) -> str:
    """Beta strength of a level by one-way analysis of variance."""
    least, most = REPUTATION.least_strength, REPUTATION.most_strength
    return f"""(SELECT CASE WHEN k < 2 OR n <= k OR rho IS NULL OR rho <= 0 THEN {most}
      ELSE least(greatest((1 - rho) / rho, {least}), {most}) END FROM (
      SELECT *, CASE WHEN between_ + (size - 1) * inside > 0
        THEN (between_ - inside) / (between_ + (size - 1) * inside) ELSE 0 END AS rho FROM (
        SELECT k, n, (w - b * b / n) / (k - 1) AS between_, (b - w) / (n - k) AS inside, (n - nn / n) / (k - 1) AS size
        FROM (SELECT count(*) AS k, CAST(sum(n) AS DOUBLE) AS n, CAST(sum(bad) AS DOUBLE) AS b,
                     CAST(sum(n * n) AS DOUBLE) AS nn, sum(CAST(bad * bad AS DOUBLE) / n) AS w
              FROM {groups} WHERE n > 0))))"""


_SUFFIXES = ", ".join(f"'{s}'" for s in REPUTATION.two_part_suffixes)

_REPUTATION = f"""
WITH page AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
outcome AS (
  SELECT doc_id AS page_id, count(*) AS n, sum(bad) AS bad
  FROM (SELECT doc_id, greatest(toxic, 1 - quality) AS bad FROM labels) WHERE bad IS NOT NULL GROUP BY doc_id),
site AS (
  SELECT host, coalesce(sum(n), 0) AS n, coalesce(sum(bad), 0) AS bad,
         string_split(regexp_replace(host, ':[0-9]*$', ''), '.') AS names
  FROM page LEFT JOIN outcome USING (page_id) GROUP BY host),
host_ AS (
  SELECT host, n, bad, array_to_string(names[greatest(1, len(names) - parts):], '.') AS domain,
         array_to_string(names[greatest(1, len(names) - parts + 1):], '.') AS suffix
  FROM (SELECT *, CASE WHEN array_to_string(names[-2:], '.') IN ({_SUFFIXES}) THEN 2 ELSE 1 END AS parts FROM site)),
domain_ AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM host_ GROUP BY ALL),
suffix_ AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domain_ GROUP BY ALL),
k AS (SELECT {_strength("host_")} AS kh, {_strength("domain_")} AS kd, {_strength("suffix_")} AS ks,
             (SELECT (sum(bad) + 0.5) / (sum(n) + 1.0) FROM host_) AS overall),
judged AS (
  SELECT host, CAST(h.n AS BIGINT) AS n_labelled, kh, (h.bad + kh * (d.bad + kd * (s.bad + ks * overall) / (s.n + ks))
         / (d.n + kd)) / (h.n + kh) AS mean
  FROM host_ h JOIN domain_ d USING (domain, suffix) JOIN suffix_ s USING (suffix), k),
bounded AS (SELECT *, mean - {REPUTATION.z} * sqrt(mean * (1 - mean) / (n_labelled + kh + 1)) AS bound FROM judged)
SELECT page_id, host, path, {_rule(lambda r: r.name)} AS rule,
       coalesce({_rule(lambda r: r.verdict)}, CASE WHEN bound > {REPUTATION.max_bad} THEN 'block' ELSE 'allow' END) AS verdict,
       n_labelled, round(mean, 6) AS bad_mean, round(bound, 6) AS bad_bound
FROM page JOIN bounded USING (host)"""

_TERMS = r"""list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
         lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))"""

_RANKED = f"""
WITH doc AS (SELECT row_number() OVER () AS row_no, doc_id, {_TERMS} AS terms FROM documents),
total AS (SELECT count(*) AS docs, CAST(sum(len(terms)) AS BIGINT) AS length FROM doc WHERE len(terms) > 0),
item AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark WHERE item_id IS NOT NULL),
hit AS (
  SELECT row_no, doc_id, n, term, count(*) AS tf
  FROM (SELECT row_no, doc_id, len(terms) AS n, unnest(terms) AS term FROM doc) WHERE term IN (SELECT term FROM item)
  GROUP BY ALL),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM hit GROUP BY term), total),
scored AS (
  SELECT item_id, row_no, doc_id, CAST(sum(w * (1000000000 * tf // (1000 * tf + 20 * (100 - 50 + 50 * n * docs // length)))) AS BIGINT) AS score
  FROM hit JOIN weight USING (term) JOIN item USING (term), total GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank,
       doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50"""


def _leaf(*values: str) -> str:
    parts = [f"CASE WHEN {v} IS NULL THEN '-' ELSE concat(strlen(CAST({v} AS VARCHAR)), ':', {v}) END" for v in values]
    return f"sha256(concat({', '.join(parts)}))"


_CRC_BYTE = "list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, (x & 1) * 3988292384))"
_CRC = f"""xor(4294967295, list_reduce(list_concat([4294967295], list_transform(
  string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))), lambda crc, byte: {_CRC_BYTE}))"""


def _levels(name: str, leaves: str) -> str:
    """Nodes of the trees over ``leaves`` (tree, i, n, h), and what stands beside each in its run."""
    return f"""
{name} AS (
  SELECT tree, 0 AS level, i, n, h FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM {name}
  WHERE n > 1 GROUP BY tree, level, i // 3, n),
{name}_step AS (
  SELECT a.tree, a.level, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,
         coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
  FROM {name} a JOIN {name} b ON a.tree = b.tree AND a.level = b.level AND a.i // 3 = b.i // 3
  WHERE a.n > 1 GROUP BY a.tree, a.level, a.i)"""


_PLACE = "CAST(pow(3, level) AS BIGINT)"
_MERKLE = f"""
WITH RECURSIVE doc AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, {_leaf('doc_id', 'source', 'lang', 'n_chars', 'text')} AS h,
         CASE WHEN ({_CRC}) % 2 = 0 THEN {_leaf('doc_id', 'source', 'lang', 'n_chars', "replace(text, chr(10), '')")} END AS other
  FROM documents),
leaf AS (
  SELECT *, row_number() OVER () AS row_no, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS i,
         count(*) OVER (PARTITION BY tree) AS n FROM doc),
{_levels('node', 'leaf')},
sub AS (SELECT tree AS name, '' AS tree, h, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n
        FROM node WHERE n = 1),
{_levels('top', 'sub')},
step AS (
  SELECT row_no, level, l, r FROM leaf JOIN node_step s ON s.tree = leaf.tree AND s.i = leaf.i // {_PLACE}
  UNION ALL
  SELECT row_no, 100 + level, l, r FROM leaf JOIN sub ON sub.name = leaf.tree JOIN top_step s ON s.i = sub.i // {_PLACE}),
proof AS (SELECT row_no, list({{'l': l, 'r': r, 'h': ''}} ORDER BY level) AS steps FROM step GROUP BY row_no),
folded AS (
  SELECT leaf.*, coalesce(steps, []) AS steps, list_reduce(
    list_concat([{{'l': '', 'r': '', 'h': coalesce(other, h)}}], coalesce(steps, [])),
    lambda x, y: {{'l': '', 'r': '', 'h': sha256(concat(y.l, x.h, y.r))}}).h AS folded_root
  FROM leaf LEFT JOIN proof USING (row_no))
SELECT doc_id, folded.h AS leaf, sub.h AS subroot, top.h AS root,
       sha256(array_to_string(list_transform(steps, lambda s: concat(s.l, s.r)), '')) AS proof_sha256,
       folded_root, folded_root = top.h AS verified
FROM folded JOIN sub ON sub.name = folded.tree, top WHERE top.n = 1"""

ORACLE_SQL: dict[str, str] = {
    "op1_topk_search": _TOP_K, "op3_host_reputation": _REPUTATION, "op4_metric_range_join": _RANGE_JOIN,
    "op11_ranked_search": _RANKED, "op12_merkle_manifest": _MERKLE}
