"""DuckDB SQL of the operators whose queries need more than plain SQL text: CRC-32
as a fold over bytes, a shortest path as a fold over rows, components and
chains by recursion."""

from __future__ import annotations

# The 256 values of the CRC-32 table (reflected polynomial 0xEDB88320 = 3988292384, a fixed value), from their rule.
CRC_TABLE = """
bits AS MATERIALIZED (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)
              ORDER BY i) AS t
  FROM (SELECT unnest(range(256))::BIGINT AS i))""".strip()


def crc32(data: str) -> str:
    """CRC-32 of a list of bytes; ``bits`` must be in the FROM clause."""
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {data}), "
            "lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295)")


# ------------------------------------------------------------ op11

OP11 = r"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT rid, array_to_string(w[p:p + 3], ' ') AS shingle
  FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT rid, count(*) AS n FROM s GROUP BY rid),
link AS MATERIALIZED (
  SELECT x, y FROM (SELECT a.rid AS x, b.rid AS y, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.rid <> b.rid GROUP BY ALL)
         JOIN n AS nx ON x = nx.rid JOIN n AS ny ON y = ny.rid
  WHERE 100 * shared >= 80 * (nx.n + ny.n - shared)),
walk(rid, here) AS (SELECT rid, rid FROM d UNION SELECT walk.rid, link.y FROM walk JOIN link ON walk.here = link.x),
comp AS (SELECT walk.rid, min(d.doc_id) AS component_id FROM walk JOIN d ON walk.here = d.rid GROUP BY walk.rid)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id IS NOT DISTINCT FROM component_id AS kept
FROM d JOIN comp ON d.rid = comp.rid LEFT JOIN n ON d.rid = n.rid
"""


# ------------------------------------------------------------ op12

# A path is nine digits of cost and its audit, so text order is the order of paths. Lists of four paths, by the
# state they start from: nothing yet, after s, after u, after a.
TURN = (3, 3, 4, 3)  # place of the state after an inserted or reroled row
KEPT = {"s": {0: 2}, "u": {0: 3, 1: 3, 3: 3}, "a": {2: 4}}
NONE = "'999999999'"


def put(letter: str, cost: int | str, path: str) -> str:
    return f"printf('%09d', {path}[:9]::BIGINT + {cost}) || '{letter}' || {path}[10:]"


def inserts(name: str) -> str:
    """Up to two inserted rows in front of the paths ``name``."""
    once = ", ".join(f"least({name}[{s + 1}], {put('I', 3, f'{name}[{TURN[s]}]')})" for s in range(4))
    twice = ", ".join(f"least({name}[{s + 1}], {put('I', 3, f'one[{TURN[s]}]')})" for s in range(4))
    return f"list_transform([[{once}]], lambda one: [{twice}])[1]"


def step() -> str:
    """The paths in front of one row."""
    out = []
    for s in range(4):
        keeps = "".join(f"WHEN row.initial = '{i}' THEN {put('K', 'row.extra', f'acc.p[{to[s]}]')} "
                        for i, to in KEPT.items() if s in to)
        stays = f"least({put('R', '3 + row.extra', f'acc.p[{TURN[s]}]')}, {f'CASE {keeps}ELSE {NONE} END' if keeps else NONE})"
        out.append(f"least({put('D', 4, f'acc.p[{s + 1}]')}, CASE WHEN row.goes THEN {NONE} ELSE {stays} END)")
    return "[" + ", ".join(out) + "]"


OP12 = f"""
WITH {CRC_TABLE},
d AS MATERIALIZED (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32("list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT)")} % 20 AS draw
  FROM conversations, bits),
m AS (
  SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
         CASE draw WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM d, (VALUES (0), (1)) AS v(again) WHERE draw <> 0 AND (again = 0 OR draw = 3)),
o AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM m),
f AS MATERIALIZED (
  SELECT *, substr(role, 1, 1) AS initial,
         CASE WHEN last_char = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN last_char NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || substr(role, 1, 1) AS pair
  FROM (SELECT *, right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last_char,
               row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS nth FROM o)),
stat AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal,
         list({{'p': NULL::VARCHAR[], 'initial': initial, 'goes': fault IN ('blank', 'duplicate'),
               'extra': CASE fault WHEN 'truncated' THEN 3 ELSE 0 END}} ORDER BY pos DESC) AS rows
  FROM f GROUP BY conv_id),
best AS MATERIALIZED (
  SELECT * EXCLUDE (rows), list_reduce(list_prepend({{'p': {inserts("['000000000', '999999990', '999999990', '000000000']")},
               'initial': '', 'goes': false, 'extra': 0}}, rows),
           lambda acc, row: {{'p': list_transform([{step()}], lambda now: {inserts("now")})[1],
                             'initial': '', 'goes': false, 'extra': 0}}).p[1] AS path
  FROM stat),
edit AS (
  SELECT conv_id, p, e, count(*) FILTER (WHERE e <> 'I') OVER w AS pos, count(*) FILTER (WHERE e <> 'D') OVER w AS place
  FROM (SELECT conv_id, unnest(string_split(path[10:], '')) AS e, generate_subscripts(string_split(path[10:], ''), 1) AS p
        FROM best WHERE length(path) > 9)
  WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
put AS (
  SELECT edit.*, f.role, f.text, max(CASE WHEN e = 'K' AND f.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY edit.conv_id) AS headed
  FROM edit LEFT JOIN f ON e <> 'I' AND edit.conv_id IS NOT DISTINCT FROM f.conv_id AND edit.pos = f.pos),
said AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (place - headed) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
                             || CASE e WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS repaired
  FROM put WHERE e <> 'D' GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(path[:9]::BIGINT, 0) AS cost,
       coalesce(path[10:], '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS c
     LEFT JOIN best ON c.conv_id IS NOT DISTINCT FROM best.conv_id LEFT JOIN said ON c.conv_id IS NOT DISTINCT FROM said.conv_id
"""


# ------------------------------------------------------------ op13

OP13 = f"""
WITH RECURSIVE {CRC_TABLE},
r AS MATERIALIZED (
  SELECT doc_id, run, count(*) AS times
  FROM (SELECT coalesce(doc_id::VARCHAR, '') AS doc_id,
               translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents) GROUP BY ALL),
h AS (
  SELECT run, times, {crc32("flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)::BIGINT] ELSE [192 + (ord(x) >> 6)::BIGINT, 128 + (ord(x) & 63)::BIGINT] END))")} AS h
  FROM r, bits),
w AS MATERIALIZED (
  SELECT word, sum(times)::BIGINT AS n
  FROM (SELECT times, CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
                           ELSE run END AS word FROM h)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
cut AS MATERIALIZED (
  SELECT word, n, p, substr(word, 1, p - 1) AS front, substr(word, p + 1) AS back FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM w)),
near AS MATERIALIZED (
  SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.p = b.p AND a.front = b.front AND a.back = b.back AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN w ON c.front || c.back = w.word
  UNION SELECT w.word, c.word, c.n FROM cut c JOIN w ON c.front || c.back = w.word),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS other_n FROM near GROUP BY word),
formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * w.n THEN other END AS form,
         CASE WHEN other_n >= 2 * w.n THEN other_n END AS form_n
  FROM w LEFT JOIN best ON w.word = best.word),
walk(word, here) AS (
  SELECT word, form FROM formed WHERE form IS NOT NULL
  UNION ALL SELECT walk.word, formed.form FROM walk JOIN formed ON walk.here = formed.word WHERE formed.form IS NOT NULL),
root AS (SELECT walk.word, walk.here AS root FROM walk JOIN formed ON walk.here = formed.word WHERE formed.form IS NULL)
SELECT formed.word, form, coalesce(root, formed.word) AS root, n, n_near, form_n FROM formed LEFT JOIN root ON formed.word = root.word
"""
