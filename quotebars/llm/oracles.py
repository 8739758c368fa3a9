"""DuckDB SQL of the operators on trees and conversations, and of CRC-32, which DuckDB lacks."""

from __future__ import annotations


def crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII string expression, bit by bit with the reflected polynomial."""
    byte = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = f"list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {byte}), 4294967295::BIGINT)"


#: levels that the Merkle SQL goes up: 8^7, about two million, leaves in a group
LEVELS = 7


def _framed(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_framed(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(name: str) -> str:
    """Levels 1 to LEVELS above the table ``name``0 (tree, place, n, digest); a tree that has come to one node stays.
    Each node of a level also gets what stands left and right of it in its run (null where the tree has ended)."""
    out = []
    for k in range(LEVELS + 1):
        run = "OVER (PARTITION BY tree, place // 8 ORDER BY place ROWS BETWEEN"
        out.append(f"""{name}{k}s AS (
  SELECT tree, place, n, digest,
         CASE WHEN n > 1 THEN coalesce(string_agg(digest, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS l,
         CASE WHEN n > 1 THEN coalesce(string_agg(digest, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') END AS r
  FROM {name}{k})""")
        out.append(f"""{name}{k + 1} AS (
  SELECT tree, place // 8 AS place, (n + 7) // 8 AS n,
         CASE WHEN n > 1 THEN sha256(string_agg(digest, '' ORDER BY place)) ELSE any_value(digest) END AS digest
  FROM {name}{k} GROUP BY tree, place // 8, n)""")
    return ",\n".join(out)


def _climb(name: str, start: str) -> str:
    """Joins each row of ``start`` (tree, place, folded, proof) with every level of ``name``."""
    out = []
    for k in range(LEVELS + 1):
        source = start if k == 0 else f"{name}_up{k - 1}"
        out.append(f"""{name}_up{k} AS (
  SELECT u.* REPLACE (u.place // 8 AS place, CASE WHEN s.l IS NULL THEN folded ELSE sha256(s.l || folded || s.r) END AS folded,
                      proof || coalesce(s.l || s.r, '') AS proof)
  FROM {source} u JOIN {name}{k}s s ON u.tree = s.tree AND u.place = s.place)""")
    return ",\n".join(out)


_LOW = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP12_SQL = f"""
WITH d AS (
  SELECT doc_id, lang, {_framed('lang')} AS tree, {_leaf('text')} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {crc32("CAST(coalesce(doc_id, 0) AS VARCHAR)")} % 3 = 0
              THEN {_leaf(_LOW)} ELSE {_leaf('text')} END AS claimed
  FROM documents),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY tree) AS n FROM d),
g0 AS (SELECT tree, place, n, leaf AS digest FROM ranked),
{_tree('g')},
named AS (SELECT tree, any_value(lang) AS lang FROM d GROUP BY tree),
subroots AS (
  SELECT tree, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS rank, count(*) OVER () AS n
  FROM g{LEVELS + 1} JOIN named USING (tree)),
t0 AS (SELECT '' AS tree, rank AS place, n, subroot AS digest FROM subroots),
{_tree('t')},
leaves AS (SELECT doc_id, leaf, tree, place, claimed AS folded, '' AS proof FROM ranked),
{_climb('g', 'leaves')},
middle AS (
  SELECT doc_id, leaf, subroot, '' AS tree, rank AS place, folded, proof FROM g_up{LEVELS} JOIN subroots USING (tree)),
{_climb('t', 'middle')}
SELECT doc_id, leaf, subroot, root.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
       folded = root.digest AS verified
FROM t_up{LEVELS}, (SELECT digest FROM t{LEVELS + 1}) root
"""


def _edit(state: str, cost: str, letters: str, told: str = "''") -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letters}', 't': {state}.t || {told}}}"


def _least(*offers: str) -> str:
    return f"list_sort([{', '.join(offers)}])[1]"


_NONE = "{'c': 1000000::BIGINT, 'a': '', 't': ''}"
_ASK, _REPLY = r"chr(10) || 'user:'", r"chr(10) || 'assistant:'"
#: every state with the insertions that may come before the next row
_ASKED = _least("s2", *[_edit(s, "2", "I", _ASK) for s in ("s0", "s1", "s3")])
_REPLIED = _least("s3", _edit("p2", "2", "I", _REPLY))


def _kept(state: str, initial: str) -> str:
    return f"CASE WHEN left(role, 1) = '{initial}' AND NOT gone THEN {_edit(state, 'cut', 'K', 'chr(10) || role || chr(58) || text')} ELSE {_NONE} END"


def _turned(state: str, told: str) -> str:
    return f"CASE WHEN NOT gone THEN {_edit(state, '2 + cut', 'R', f'{told} || text')} ELSE {_NONE} END"


#: rows of one turn go by role and text
OP13_SQL = rf"""
WITH RECURSIVE faults AS (
  SELECT conv_id, coalesce('=' || CAST(conv_id AS VARCHAR), '') AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS fault
  FROM conversations),
damaged AS (
  SELECT conv, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy
  FROM faults WHERE fault <> 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS k,
         regexp_replace(text, '[\x20\x09-\x0D]', '', 'g') AS visible
  FROM damaged),
told AS (
  SELECT *, visible = '' AS blank, visible <> '' AND row_number() OVER (PARTITION BY conv, role, text ORDER BY k) > 1 AS duplicate,
         left(lag(role) OVER (PARTITION BY conv ORDER BY k), 1) || left(role, 1) NOT IN ('su', 'ua', 'au') AS illegal
  FROM numbered),
turns AS (
  SELECT *, blank OR duplicate AS gone, CAST(NOT blank AND NOT duplicate AND right(visible, 1) NOT IN ('.', '!', '?') AS BIGINT) AS cut
  FROM told),
counts AS (
  SELECT conv, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (duplicate) AS duplicate, CAST(sum(cut) AS BIGINT) AS truncated, count(*) FILTER (illegal) AS illegal
  FROM turns GROUP BY conv),
run AS (
  SELECT conv, 0::BIGINT AS k, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS s0, {_NONE} AS s1, {_NONE} AS s2, {_NONE} AS s3 FROM counts
  UNION ALL
  SELECT conv, k, {_edit('s0', '3', 'D')}, {_least(_edit('s1', '3', 'D'), _kept('s0', 's'))},
         {_least(_edit('p2', '3', 'D'), *[_turned(s, "chr(10) || 'user:'") for s in ('s0', 's1', 'p3')], *[_kept(s, 'u') for s in ('s0', 's1', 'p3')])},
         {_least(_edit('p3', '3', 'D'), _turned('p2', "chr(10) || 'assistant:'"), _kept('p2', 'a'))}
  FROM (SELECT t.conv, t.k, t.role, t.text, t.gone, t.cut, s0, s1, p2, {_REPLIED} AS p3
        FROM (SELECT *, {_ASKED} AS p2 FROM run) r JOIN turns t ON t.conv = r.conv AND t.k = r.k + 1)),
ended AS (
  SELECT conv, {_least('s0', _REPLIED)} AS best
  FROM (SELECT run.*, {_ASKED} AS p2 FROM run JOIN counts USING (conv) WHERE run.k = counts.n))
SELECT DISTINCT faults.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit,
       sha256(coalesce(best.t[2:], '')) AS repaired_sha256
FROM faults LEFT JOIN counts USING (conv) LEFT JOIN ended USING (conv)
"""


#: strings of so many bytes that start earlier, too, are removed
_SPAN = 100

#: every window of the texts, as hex digits: the one that starts first stays
OP5_SQL = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT doc_id, s, substr(h, 2 * s + 1, {2 * _SPAN}) AS x FROM d, unnest(range(0, greatest(n - {_SPAN - 1}, 0))) AS t(s)),
hits AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY x ORDER BY doc_id, s) AS k FROM w) WHERE k > 1),
marked AS (SELECT doc_id, s, coalesce(s > lag(s) OVER (PARTITION BY doc_id ORDER BY s) + {_SPAN}, true) AS opens FROM hits),
numbered AS (SELECT doc_id, s, count(*) FILTER (opens) OVER (PARTITION BY doc_id ORDER BY s ROWS UNBOUNDED PRECEDING) AS run FROM marked),
runs AS (SELECT doc_id, min(s) AS b, max(s) + {_SPAN} AS e FROM numbered GROUP BY doc_id, run),
gaps AS (SELECT doc_id, b, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS before FROM runs),
cut AS (
  SELECT doc_id, sum(e - b) AS n_removed, count(*) AS n_spans, max(e) AS last,
         string_agg(substr(h, 2 * before + 1, 2 * (b - before)), '' ORDER BY b) AS head
  FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""

SHARDS = 24


def _jump(shards: int) -> str:
    """The published algorithm over the unsigned 64-bit ``key``: steps after the last jump change nothing."""
    k = "(a.k * 2862933555777941757::HUGEINT + 1) % 18446744073709551616::HUGEINT"
    j = f"floor((a.j + 1)::DOUBLE * (2147483648.0 / ((({k}) // 8589934592::HUGEINT)::DOUBLE + 1)))::BIGINT"
    start = "{'b': -1::BIGINT, 'j': 0::BIGINT, 'k': key::HUGEINT}"
    steps = f"list_transform(range({shards + 1}), lambda i: {start})"
    return f"list_reduce({steps}, lambda a, x: CASE WHEN a.j < {shards} THEN {{'b': a.j, 'j': {j}, 'k': {k}}} ELSE a END, {start}).b::INTEGER"


#: CRC-32 of whole texts, a byte at a time by the table of its 256 remainders
OP9_SQL = f"""
WITH remainders AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1))) ORDER BY i) AS r FROM range(256) AS t(i)),
d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n,
         ('0x' || md5(coalesce(CAST(doc_id AS VARCHAR), ''))[1:16])::UBIGINT AS key
  FROM documents),
told AS (
  SELECT doc_id, n + 8 AS size, {_jump(SHARDS)} AS shard, {_jump(SHARDS + 1)} AS grown_shard,
         xor(list_reduce(list_transform(range(n), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
                         lambda c, b: xor(c >> 8, r[1 + (xor(c, b) & 255)]), 4294967295::BIGINT), 4294967295::BIGINT) AS text_crc32
  FROM d, remainders)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot, grown_shard
FROM told
"""
