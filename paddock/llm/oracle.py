"""DuckDB counterparts of queries whose rows SQL can express."""

from __future__ import annotations

SPACE, ENDS = "\\x20\\x09-\\x0D", "[.!?]"

# crc32 of a UTF-8 text, by the table of the reflected polynomial 0xEDB88320.
CRC_TABLE = """crc_table AS (
    SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS entries
)"""


def _crc(digits: str) -> str:
    """The crc32 of bytes given as text of hexadecimal digits; needs crc_table."""
    nibble = lambda i: f"(strpos('0123456789ABCDEF', substring({digits}, 2 * i + {i}, 1)) - 1)"
    data = f"list_transform(range(0, length({digits}) // 2), lambda i: {nibble(1)} * 16 + {nibble(2)})"
    step = "lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, {data}), {step}), 4294967295)"


SPELLING = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
    SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents WHERE text IS NOT NULL
), lowered AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
    FROM runs WHERE length(run) >= 7 GROUP BY ALL
), digits AS (
    SELECT run, n, hex(coalesce(doc_id::VARCHAR, '') || ':' || run) AS digits FROM lowered
), hashed AS (
    SELECT run, n, {_crc('digits')} AS h FROM digits, crc_table
), written AS (
    SELECT n, CASE WHEN h % 31 <> 0 THEN run
        ELSE substring(run, 1, (h % length(run))::BIGINT) || substring(run, (h % length(run))::BIGINT + 2) END AS word
    FROM hashed
), words AS MATERIALIZED (
    SELECT word, sum(n)::BIGINT AS n FROM written WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), shorter AS MATERIALIZED (
    SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
    SELECT a.word, b.word AS other, b.n AS other_n
    FROM shorter a JOIN shorter b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word
), best AS (
    SELECT word, count(*) AS n_near, min({{'less': -other_n, 'other': other}}) AS top FROM near GROUP BY word
), formed AS MATERIALIZED (
    SELECT words.word, n, coalesce(n_near, 0) AS n_near,
           CASE WHEN -top.less >= 10 * n THEN top.other END AS form, CASE WHEN -top.less >= 10 * n THEN -top.less END AS form_n
    FROM words LEFT JOIN best USING (word)
), chains AS (
    SELECT word, word AS root FROM formed
    UNION ALL SELECT chains.word, formed.form FROM chains JOIN formed ON chains.root = formed.word WHERE formed.form IS NOT NULL
)
SELECT formed.word, formed.form, chains.root, formed.n, formed.n_near, formed.form_n
FROM formed JOIN chains ON formed.word = chains.word JOIN formed last ON chains.root = last.word AND last.form IS NULL
"""


def _more(way: str, cost: str, audit: str, line: str) -> str:
    """A way (cost, audit, lines) with one more edit."""
    return f"{{'cost': {way}.cost + {cost}, 'audit': {way}.audit || '{audit}', 'lines': {way}.lines || {line}}}"


def _repair_step() -> str:
    """From the ways to the four states before a turn to those after it: z nothing yet, s, u, and a a pair's end."""
    insert = lambda way, name: _more(way, "3", "I", f"chr(10) || '{name}:'")
    two = lambda way: _more(way, "6", "II", "chr(10) || 'user:' || chr(10) || 'assistant:'")
    opened = f"least(p.u, {insert('p.z', 'user')}, {insert('p.s', 'user')}, {insert('p.a', 'user')})"
    paired = f"least(p.a, {insert('p.u', 'assistant')}, {two('p.z')}, {two('p.s')})"
    delete = lambda way: _more(way, "4", "D", "''")
    stays = "x.stays + CASE WHEN x.initial = '{}' THEN 0 ELSE 1000000000000 END"
    keep = lambda way, initial: _more(way, f"({stays.format(initial)})", "K", "chr(10) || x.role || ':' || x.text")
    rerole = lambda way, name: _more(way, "(x.stays + 3)", "R", f"chr(10) || '{name}:' || x.text")
    to_user = ", ".join(f"{keep(w, 'u')}, {rerole(w, 'user')}" for w in ("q.p.z", "q.p.s", "q.paired"))
    rest = ", ".join(f"'{name}': q.p.{name}" for name in ("stays", "initial", "role", "text"))
    return f"""lambda p, x: list_transform([{{'p': p, 'opened': {opened}, 'paired': {paired}}}], lambda q: {{
        'z': {delete('q.p.z')},
        's': least({delete('q.p.s')}, {keep('q.p.z', 's')}),
        'u': least({delete('q.p.u')}, {to_user}),
        'a': least({delete('q.p.a')}, {keep('q.opened', 'a')}, {rerole('q.opened', 'assistant')}),
        {rest} }})[1]"""


_NEVER = "{'cost': 1000000000000::BIGINT, 'audit': '', 'lines': ''}"
_START = f"'z': {{'cost': 0::BIGINT, 'audit': '', 'lines': ''}}, 's': {_NEVER}, 'u': {_NEVER}, 'a': {_NEVER}"

CONVERSATIONS = f"""
WITH {CRC_TABLE},
digits AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           hex(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')) AS digits
    FROM conversations
), kinds AS (
    SELECT conv_id, turn, role, text, {_crc('digits')} % 20 AS kind FROM digits, crc_table
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '{ENDS}', '', 'g') ELSE text END AS text,
           unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
    FROM kinds WHERE kind <> 0
), ordered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS place,
           NOT regexp_matches(text, '[^{SPACE}]') AS blank,
           NOT regexp_matches(text, '{ENDS}[{SPACE}]*$') AS endless
    FROM damaged
), faults AS (
    SELECT *, left(role, 1) AS initial, NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 AS duplicate,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) || left(role, 1) AS pair
    FROM ordered
), counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
           count(*) FILTER (NOT blank AND NOT duplicate AND endless) AS truncated,
           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
           list({{ {_START}, 'stays': CASE WHEN blank OR duplicate THEN 1000000000000::BIGINT WHEN endless THEN 3::BIGINT ELSE 0::BIGINT END,
                  'initial': initial, 'role': role, 'text': text }} ORDER BY place) AS turns
    FROM faults GROUP BY conv_id
), folded AS (
    SELECT * EXCLUDE (turns), list_reduce(turns, {_repair_step()},
        {{ {_START}, 'stays': 0::BIGINT, 'initial': '', 'role': '', 'text': '' }}) AS ways
    FROM counted
), ended AS (
    SELECT conv_id, gaps, blank, duplicate, truncated, illegal,
           least(ways.z, ways.a, {_more('ways.u', '3', 'I', "chr(10) || 'assistant:'")},
                 {_more('ways.s', '6', 'II', "chr(10) || 'user:' || chr(10) || 'assistant:'")}) AS best
    FROM folded
)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost,
       coalesce(best.audit, '') AS audit, sha256(substring(coalesce(best.lines, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids LEFT JOIN ended ON ids.conv_id IS NOT DISTINCT FROM ended.conv_id
"""
