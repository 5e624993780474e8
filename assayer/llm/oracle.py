"""Reference SQL for the operators that SQL can express."""

from assayer.llm.url_filter import LOWER, RULES, UPPER

_RULES = ", ".join(f"('{verdict}', '{rule}')" for verdict, rule in RULES)


def _weight(groups: str) -> str:
    """Weight of a level's beta prior, from its groups (n, bad, m)."""
    return f"""
    SELECT CASE WHEN coalesce(extra, 0) = 0 THEN 1.0
                WHEN seen - plain <= 0 THEN 1e4
                ELSE least(1e4, greatest(1e-2, 1 / ((seen - plain) / extra) - 1)) END AS w
    FROM (SELECT sum((bad - n * m) ** 2) AS seen, sum(n * m * (1 - m)) AS plain,
                 sum(n * (n - 1) * m * (1 - m)) AS extra FROM {groups})"""


OP3 = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages
), here AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut
), rules(verdict, rule) AS (VALUES {_RULES}),
fit AS (
  SELECT page_id, max_by(r.rule, length(r.rule)) AS rule, max_by(r.verdict, length(r.rule)) AS verdict
  FROM here JOIN rules r ON (host = split_part(r.rule, '/', 1) OR ends_with(host, '.' || split_part(r.rule, '/', 1)))
    AND starts_with(path, substr(r.rule, instr(r.rule, '/')))
  GROUP BY page_id
), judged AS (SELECT here.*, rule, verdict FROM here LEFT JOIN fit USING (page_id)),
hosts AS (
  SELECT host, string_split(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '.') AS parts,
         count(rule) AS n, count(*) FILTER (verdict = 'block') AS bad
  FROM judged GROUP BY host
), sited AS (
  SELECT host, n, bad, parts[-1] AS suffix, array_to_string(parts[-2:], '.') AS domain FROM hosts
), top AS (SELECT (coalesce(sum(bad), 0) + 0.5) / (coalesce(sum(n), 0) + 1.0) AS m FROM sited),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(m) AS m FROM sited, top GROUP BY suffix),
sw AS ({_weight("s")}),
sp AS (SELECT suffix, (bad + w * m) / (n + w) AS m FROM s, sw),
d AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad, any_value(m) AS m FROM sited JOIN sp USING (suffix) GROUP BY suffix, domain),
dw AS ({_weight("d")}),
dp AS (SELECT suffix, domain, (bad + w * m) / (n + w) AS m FROM d, dw),
h AS (SELECT host, n, bad, m FROM sited JOIN dp USING (suffix, domain)),
hw AS ({_weight("h")}),
hp AS (SELECT host, (bad + w * m) / (n + w) AS mean, n + w AS weight FROM h, hw),
blocked AS (SELECT host FROM hp WHERE mean - 1.64 * sqrt(mean * (1 - mean) / (weight + 1)) > 0.5)
SELECT page_id, host, path, rule,
       CASE WHEN rule IS NOT NULL THEN verdict WHEN host IN (SELECT host FROM blocked) THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""

# The remainder of dividing c's CRC-32 (reflected, 0xEDB88320) by 9: -1 stands for a shift by one bit.
_CRC = """xor(4294967295::ubigint, list_reduce(
  list_concat([4294967295::bigint], flatten(list_transform(string_split(c::varchar, ''), lambda ch: [ord(ch), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)::ubigint)"""

# Prefixes are told apart by the md5 of the digests of their turns, one after the other.
OP12 = f"""
WITH given AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT c, octet_length(encode(text)) AS size, md5(octet_length(encode(role)) || ':' || role || text) AS digest,
         row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, md5(octet_length(encode(role)) || ':' || role || text)) - 1 AS pos
  FROM given
), convs AS MATERIALIZED (SELECT c, c - c % 5 AS base, {_CRC} % 9 AS h FROM (SELECT DISTINCT c FROM own)),
turned AS (
  SELECT convs.c, 0 AS part, pos, size, digest FROM convs JOIN own ON own.c = base WHERE pos < h
  UNION ALL SELECT convs.c, 1, pos, size, digest FROM convs JOIN own USING (c) WHERE pos >= h
), numbered AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS d FROM turned),
prefixes AS MATERIALIZED (
  SELECT c, 0 AS d, '' AS p, 0 AS size FROM convs
  UNION ALL SELECT c, d, md5(string_agg(digest, '') OVER (PARTITION BY c ORDER BY d)) AS p, size FROM numbered
), lengths AS (SELECT c, max(d) AS n FROM prefixes GROUP BY c),
nodes AS MATERIALIZED (SELECT d, p, min(c) AS conv_id, count(*) AS n_convs, any_value(size) AS size FROM prefixes GROUP BY d, p),
up AS (
  SELECT v.d, v.p, v.conv_id, u.p AS parent, u.conv_id AS parent_conv_id
  FROM nodes v JOIN prefixes x ON x.c = v.conv_id AND x.d = v.d - 1 JOIN nodes u ON u.d = x.d AND u.p = x.p
), kids AS (SELECT d - 1 AS d, parent AS p, count(*) AS n FROM up GROUP BY ALL),
worth AS (
  SELECT v.d, v.p, v.conv_id, (v.n_convs - 1) * v.size AS saved, CASE WHEN k.n IS NULL THEN 1 ELSE 0 END AS leaf
  FROM nodes v LEFT JOIN kids k USING (d, p)
), below AS (
  SELECT x.d, x.p, sum(w.leaf) AS n_leaves, sum(w.saved) AS saved
  FROM worth w JOIN prefixes x ON x.c = w.conv_id AND x.d <= w.d GROUP BY x.d, x.p
), ends AS (
  SELECT d, p, string_agg(c::varchar, ',' ORDER BY c) AS ids FROM prefixes JOIN lengths USING (c) WHERE d = n GROUP BY d, p
)
SELECT v.conv_id, v.d::bigint AS depth, up.parent_conv_id, v.n_convs, coalesce(k.n, 0)::bigint AS n_children,
       b.n_leaves::bigint AS n_leaves, b.saved::bigint AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes v LEFT JOIN up USING (d, p) LEFT JOIN kids k USING (d, p) LEFT JOIN below b USING (d, p) LEFT JOIN ends e USING (d, p)
"""

ORACLE: dict[str, str] = {"op3_url_filter": OP3, "op12_conversation_trie": OP12}
