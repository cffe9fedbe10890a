"""DuckDB SQL for the queries that SQL can express, written from the contracts and not from the operators.

The others have none: fingerprints and MinHash rest on Spark's and xxHash's hash functions, the scorers are learned,
chaining and byte-pair merges are iterative. They are tested against brute force, held-out labels and round trips.
"""

from __future__ import annotations


def _spans(kinds: dict[str, tuple[str, str]]) -> str:
    """(doc_id, s, rank, kind, e): matches of plain patterns that pass a condition on ``h``."""
    parts = []
    for rank, (kind, (pattern, passes)) in enumerate(kinds.items()):
        quoted = pattern.replace("'", "''")
        parts.append(f"""
SELECT doc_id, s, {rank} AS rank, '{kind}' AS kind, s + length(h) AS e FROM (
  SELECT doc_id, hits[i] AS h, CAST(list_sum(list_transform(gaps[:i], lambda x: length(x)))
         + coalesce(list_sum(list_transform(hits[:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s
  FROM (SELECT doc_id, hits, gaps, unnest(range(1, len(hits) + 1)) AS i FROM (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{quoted}') AS hits,
           string_split_regex(coalesce(text, ''), '{quoted}') AS gaps FROM documents) WHERE len(hits) > 0)
) WHERE {passes.format(pattern=quoted)}""")
    return " UNION ALL ".join(parts)


def _digest(kinds: dict[str, tuple[str, str]], base: list[str], counted: list[str]) -> str:
    listed = ", ".join(f"'{k}'" for k in base)
    counts = ", ".join(f"CAST(coalesce(n_{k}, 0) AS BIGINT) AS n_{k}" for k in counted)
    sums = ", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in counted)
    one = "kind || ':' || s || ':' || e, ',' ORDER BY s, rank"
    return f"""
SELECT d.doc_id, {counts}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM documents d LEFT JOIN (
  SELECT doc_id, {sums}, string_agg({one}) FILTER (WHERE kind IN ({listed})) AS base, string_agg({one}) AS spans
  FROM ({_spans(kinds)}) GROUP BY doc_id) f ON d.doc_id = f.doc_id"""


_DIGITS = "regexp_replace(h, '[^0-9]', '', 'g')"
_LUHN = f"""length({_DIGITS}) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length({_DIGITS}) + 1),
  lambda i: CASE WHEN i % 2 = 1 THEN CAST(substr({_DIGITS}, length({_DIGITS}) - i + 1, 1) AS INTEGER)
  ELSE CAST(substr({_DIGITS}, length({_DIGITS}) - i + 1, 1) AS INTEGER) * 2
       - CASE WHEN CAST(substr({_DIGITS}, length({_DIGITS}) - i + 1, 1) AS INTEGER) > 4 THEN 9 ELSE 0 END END)) % 10 = 0"""
_PLAIN = "regexp_replace(h, '[^A-Z0-9]', '', 'g')"
_MOD97 = f"""TRY_CAST(array_to_string(list_transform(string_split(substr({_PLAIN}, 5) || substr({_PLAIN}, 1, 4), ''),
  lambda c: CASE WHEN c >= 'A' THEN CAST(ascii(c) - 55 AS VARCHAR) ELSE c END), '') AS HUGEINT) % 97 = 1"""

_PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "TRUE"),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
           "list_max(list_transform(string_split(h, '.'), lambda x: CAST(x AS BIGINT))) <= 255"),
    "card": (r"[0-9]([\x20-]?[0-9])+", _LUHN),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15"),
    "iban": (r"\b[A-Z]{2}[0-9]{2}(\x20?[A-Z0-9]{4}){2,7}(\x20?[A-Z0-9]{1,3})?\b",
             _MOD97),
}

_SECRETS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
               "length(regexp_extract(h, '{pattern}', 2)) >= 6"),
    "access": (r"AKIA[A-Z0-9]+", "length(h) >= 20"),
    "hex": (r"[0-9a-f]+", "length(h) >= 24"),
    "forge": (r"gh[pousr]_[A-Za-z0-9]+", "length(h) >= 40"),
    "chat": (r"xox[abprs]-[A-Za-z0-9-]+", "length(h) >= 15"),
    "jwt": (r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", "TRUE"),
    "pem": (r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", "TRUE"),
}


def _words(table: str, key: str) -> str:
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"SELECT {key}, regexp_extract_all({low}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {table}"


_DECONTAMINATION = f"""
WITH d AS ({_words("documents", "doc_id")}), b AS ({_words("benchmark", "item_id")}),
windows AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, w[i + 1:i + 10] AS win FROM (
  SELECT item_id, w, unnest(range(greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(win) AS size FROM windows),
places AS (SELECT doc_id, size, i, w[i + 1:i + size] AS win FROM (
  SELECT doc_id, size, w, unnest(range(len(w) - size + 1)) AS i FROM d, sizes WHERE len(w) >= size)),
hits AS (SELECT doc_id, size, i, item FROM places JOIN windows USING (win)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
  SELECT doc_id, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT doc_id, i, size FROM hits)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS listed
          FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(covered.n, 0) > 0 AS contaminated
FROM d LEFT JOIN covered ON d.doc_id = covered.doc_id LEFT JOIN items ON d.doc_id = items.doc_id"""

# The checksum as its definition has it: a table of 256 remainders, then byte by byte.
_SHARDING = """
WITH RECURSIVE rem AS (
  SELECT i, CAST(i AS BIGINT) AS c, 0 AS n FROM range(256) r(i) UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(CAST(3988292384 AS BIGINT), c >> 1) ELSE c >> 1 END, n + 1 FROM rem WHERE n < 8),
tab AS (SELECT list(c ORDER BY i) AS t FROM rem WHERE n = 8),
crc AS (SELECT doc_id, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
    regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT))),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), CAST(4294967295 AS BIGINT)) AS v FROM documents, tab),
jump AS (
  SELECT doc_id, CAST(doc_id AS UHUGEINT) AS k, CAST(0 AS BIGINT) AS j, CAST(0 AS BIGINT) AS s, CAST(0 AS BIGINT) AS g
  FROM documents UNION ALL
  SELECT doc_id, n, CAST(floor((j + 1) * (2147483648.0::DOUBLE / (CAST(n // 8589934592 AS BIGINT) + 1))) AS BIGINT),
         CASE WHEN j < 24 THEN j ELSE s END, j
  FROM (SELECT *, (k * 2862933555777941757::UHUGEINT + 1::UHUGEINT) % 18446744073709551616::UHUGEINT AS n FROM jump WHERE j < 25))
SELECT d.doc_id, CAST(coalesce(octet_length(encode(d.text)), 0) + 8 AS BIGINT) AS size, v AS text_crc32, 'key' AS law,
       CAST(s AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY s ORDER BY d.doc_id % 1009, d.doc_id) - 1 AS slot, CAST(g AS INTEGER) AS grown_shard
FROM documents d JOIN crc ON d.doc_id = crc.doc_id JOIN jump ON d.doc_id = jump.doc_id WHERE j >= 25"""

# Trees level by level, then every row's way up with the sibling of its node; groups and the tree over them alike.
_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE octet_length(encode(CAST({0} AS VARCHAR))) || ':' || {0} END"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "{n}", "text")) + ")"
_CHECKSUM_OF_ID = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
    regexp_extract_all(hex(encode(CAST(doc_id AS VARCHAR))), '..'), lambda h: CAST('0x' || h AS BIGINT))),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), CAST(4294967295 AS BIGINT))"""
_UP = """SELECT {keys}, lvl + 1 AS lvl, pos // 2 AS pos, sha256(string_agg(node, '' ORDER BY pos)) AS node
  FROM (SELECT *, count(*) OVER (PARTITION BY {group}) AS n FROM {nodes}) WHERE n > 1 GROUP BY {keys}, lvl, pos // 2"""
_WAY = """SELECT w.doc_id, w.lang, w.leaf, w.lvl + 1 AS lvl, w.pos // 2 AS pos,
  sha256(CASE WHEN s.node IS NULL THEN w.node WHEN w.pos % 2 = 1 THEN s.node || w.node ELSE w.node || s.node END) AS node,
  w.proof || coalesce(s.node, '') AS proof
  FROM {way} w JOIN {heights} h ON {on_height} LEFT JOIN {nodes} s ON {on_node} s.lvl = w.lvl AND s.pos = xor(w.pos, 1) WHERE w.lvl < h.height"""
_MERKLE = f"""
WITH RECURSIVE rem AS (
  SELECT i, CAST(i AS BIGINT) AS c, 0 AS n FROM range(256) r(i) UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(CAST(3988292384 AS BIGINT), c >> 1) ELSE c >> 1 END, n + 1 FROM rem WHERE n < 8),
tab AS (SELECT list(c ORDER BY i) AS t FROM rem WHERE n = 8),
docs AS (SELECT doc_id, coalesce('+' || lang, '') AS lang, {_LEAF.replace('{n}', 'n_chars')} AS leaf,
  CASE WHEN {_CHECKSUM_OF_ID} % 7 = 0 THEN {_LEAF.replace('{n}', '(n_chars + 1)')} ELSE {_LEAF.replace('{n}', 'n_chars')} END AS presented
  FROM documents, tab),
leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM docs),
nodes AS (SELECT lang, 0 AS lvl, pos, leaf AS node FROM leaves UNION ALL
  {_UP.format(keys="lang", group="lang", nodes="nodes")}),
heights AS (SELECT lang, max(lvl) AS height FROM nodes GROUP BY lang),
subroots AS (SELECT lang, node, row_number() OVER (ORDER BY encode(lang)) - 1 AS pos FROM nodes JOIN heights USING (lang) WHERE lvl = height),
tops AS (SELECT 0 AS one, 0 AS lvl, pos, node FROM subroots UNION ALL {_UP.format(keys="one", group="one", nodes="tops")}),
top AS (SELECT max(lvl) AS height FROM tops),
ways AS (SELECT doc_id, lang, leaf, 0 AS lvl, pos, presented AS node, '' AS proof FROM leaves UNION ALL
  {_WAY.format(way="ways", heights="heights", on_height="h.lang = w.lang", nodes="nodes", on_node="s.lang = w.lang AND")}),
more AS (SELECT w.doc_id, w.lang, w.leaf, 0 AS lvl, s.pos, w.node, w.proof FROM ways w JOIN heights h ON h.lang = w.lang AND w.lvl = h.height
  JOIN subroots s ON s.lang = w.lang UNION ALL
  {_WAY.format(way="more", heights="top", on_height="TRUE", nodes="tops", on_node="")})
SELECT m.doc_id, m.leaf, s.node AS subroot, r.node AS root, sha256(m.proof) AS proof_sha256, m.node AS folded_root,
       m.node = r.node AS verified
FROM more m JOIN top ON m.lvl = top.height JOIN subroots s ON s.lang = m.lang JOIN tops r ON r.lvl = top.height"""

ORACLES: dict[str, str] = {
    "op1_pii": _digest(_PII, ["email", "ip", "card", "phone"], list(_PII)),
    "op4_secrets": _digest(_SECRETS, ["assign", "access", "hex"], ["assign", "access", "hex"]),
    "op7_decontamination": _DECONTAMINATION,
    "op10_sharding": _SHARDING,
    "op13_merkle": _MERKLE,
}
