"""DuckDB SQL of the corpus queries that SQL can express, written from their contracts."""

OP4 = r"""
WITH d AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')) AS place
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
k AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS kind FROM s),
w AS (
  SELECT source, source_size, 2.0::DOUBLE * source_size AS cap,
         (CASE kind WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::DOUBLE AS weight,
         (CASE kind WHEN 0 THEN 1.5 WHEN 1 THEN 1.0 ELSE 0.5 END)::DOUBLE AS up,
         (CASE kind WHEN 0 THEN 0.5 WHEN 1 THEN 1.0 ELSE 1.5 END)::DOUBLE AS down
  FROM k),
-- The level: the words per weight at which capped shares add up to all words.
lv AS (
  SELECT max((1.5::DOUBLE * a.total - a.capped) / a.open_weight) AS level
  FROM (
    SELECT x.source,
           (SELECT sum(source_size) FROM w) AS total,
           coalesce(sum(y.cap) FILTER (y.cap / y.weight < x.cap / x.weight), 0) AS capped,
           sum(y.weight) FILTER (y.cap / y.weight >= x.cap / x.weight) AS open_weight
    FROM w x, w y GROUP BY x.source, x.cap, x.weight) a),
t AS (SELECT w.*, least(cap, coalesce(level, 0) * weight) AS target, weight * up AS r0, weight * down AS r1 FROM w, lv),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.r0, t.r1,
         floor(t.target)::BIGINT AS quota,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.doc_id, d.size
                           ROWS UNBOUNDED PRECEDING)::BIGINT - d.size AS begin
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (
  SELECT *, least(greatest(quota - begin, 0), size)::BIGINT AS w0,
         least(greatest(quota - (begin + source_size), 0), size)::BIGINT AS w1 FROM p),
a AS (SELECT *, least((begin + w0 / 2) / target, 1.0::DOUBLE) * (1.0::DOUBLE * (r0 + r1) / 2) AS asked FROM c)
SELECT doc_id, size, source_size, target, (w0 + w1)::BIGINT AS taken,
       CASE WHEN w0 > 0 THEN round(least(2 * asked / (r0 + sqrt(greatest(r0 * r0 + 2 * (r1 - r0) * asked, 0))), 1.0::DOUBLE), 6)
       END AS first_position
FROM a
"""

OP5 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT doc_id, CASE
    WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3]))
    END AS grams
  FROM w),
n AS (SELECT doc_id, len(grams)::BIGINT AS n_shingles FROM s),
g AS (SELECT doc_id, unnest(grams) AS gram FROM s),
pair AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
  SELECT x, y FROM pair JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE 100 * common >= 85 * (nx.n_shingles + ny.n_shingles - common)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM n
  UNION
  SELECT r.doc_id, l.y FROM reach r JOIN link l ON l.x = r.other)
SELECT n.doc_id, n.n_shingles, min(r.other) AS component_id
FROM n JOIN reach r ON r.doc_id = n.doc_id GROUP BY n.doc_id, n.n_shingles
"""


def _crc_table() -> str:
    """The 256 remainders of CRC-32, from its reversed polynomial."""
    out = []
    for x in range(256):
        for _ in range(8):
            x = x >> 1 ^ (0xEDB88320 if x & 1 else 0)
        out.append(x)
    return "[" + ", ".join(f"{x}::BIGINT" for x in out) + "]"


def _repair_rules() -> str:
    """(fault, initial, state) -> state, cost, edits, kind of line, lines inserted behind:
    every edit of a row followed by up to two insertions."""
    step = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    insert = {0: ("user:", 2), 1: ("user:", 2), 2: ("assistant:", 3), 3: ("user:", 2)}
    rows = []
    for fault, more in (("", 0), ("truncated", 3), ("gone", None)):
        for initial in ("s", "u", "a", "?"):
            for q in range(4):
                edits = [(q, 4, "D", "")]
                if more is not None:
                    if initial in step[q]:
                        edits.append((step[q][initial], more, "K", "own"))
                    edits += [(step[q][r[0]], 3 + more, "R", r) for r in ("user", "assistant") if r[0] in step[q]]
                for to, cost, edit, line in edits:
                    behind = ""
                    for _ in range(3):
                        rows.append(f"('{fault}', '{initial}', {q}, {to}, {cost}, '{edit}', '{line}', '{behind}')")
                        new, to = insert[to]
                        cost, edit, behind = cost + 3, edit + "I", behind + "\n" + new
    return ",\n  ".join(rows)


OP13 = r"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce([4294967295::BIGINT] || list_transform(
               string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT),
             lambda c, b: xor(c // 256, (@crc)[xor(c % 256, b) + 1])), 4294967295) % 20 AS kind
  FROM conversations),
d AS (
  SELECT conv_id, turn, if(kind = 4, 'user', role) AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(if(kind = 3, 2, 1))) AS copy
  FROM k WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
             rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS seen FROM d),
f AS (
  SELECT *, left(role, 1) AS initial,
         CASE WHEN seen = '' THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN right(seen, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
  FROM o),
rule(fault, initial, q, target, cost, edits, line, behind) AS (VALUES
  @rules),
path AS (
  SELECT conv_id, 0::BIGINT AS i, q, {'cost': cost, 'audit': audit, 'lines': lines} AS best
  FROM (SELECT DISTINCT conv_id FROM conversations),
       (VALUES (0, 0::BIGINT, '', ''), (2, 3, 'I', chr(10) || 'user:'), (3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'))
       s(q, cost, audit, lines)
  UNION ALL
  SELECT p.conv_id, f.i, r.target, min({
           'cost': p.best.cost + r.cost, 'audit': p.best.audit || r.edits,
           'lines': p.best.lines || CASE r.line WHEN '' THEN '' WHEN 'own' THEN chr(10) || f.role || ':' || f.text
                                         ELSE chr(10) || r.line || ':' || f.text END || r.behind})
  FROM path p JOIN f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1
  JOIN rule r ON r.q = p.q AND r.fault = if(f.fault IN ('blank', 'duplicate'), 'gone', f.fault)
             AND r.initial = if(f.initial IN ('s', 'u', 'a'), f.initial, '?')
  GROUP BY p.conv_id, f.i, r.target),
c AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM f GROUP BY conv_id),
a AS (SELECT DISTINCT conv_id FROM conversations),
e AS (
  SELECT a.conv_id, min(p.best) AS best
  FROM a LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
  JOIN path p ON p.conv_id IS NOT DISTINCT FROM a.conv_id AND p.i = coalesce(c.n, 0) AND p.q IN (0, 3)
  GROUP BY a.conv_id)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, e.best.cost::BIGINT AS cost, e.best.audit AS audit,
       sha256(substr(e.best.lines, 2)) AS repaired_sha256
FROM e LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
""".replace("@crc", _crc_table()).replace("@rules", _repair_rules())


#: name, measure, above, cutoffs from the strictest.
_RULES = [("symbols", "100 * n_symbols, n_words", ">", "5, 10, 20, 30, 50, 80, 120, 200"),
          ("repeated_words", "100 * n_repeat_words, n_words", ">", "5, 10, 15, 20, 30, 40"),
          ("repeated_lines", "100 * n_dup_lines, n_lines", ">", "10, 20, 30, 40, 50, 60"),
          ("long_words", "10 * word_chars, n_words", ">", "60, 65, 70, 75, 80, 90, 100"),
          ("short_words", "10 * word_chars, n_words", "<", "45, 42, 40, 38, 35, 30")]


def _risk_steps() -> str:
    """One step a rule: the cutoff of the most gain among the rows the rules before let
    through, then the rows it lets through."""
    out, before = [], "tune"
    for i, (name, measure, sign, cutoffs) in enumerate(_RULES):
        part, whole = measure.split(", ")
        out.append(f"""
g{i} AS (
  SELECT lang, cut, place, count(*) FILTER (NOT good) - 20 * count(*) FILTER (good) AS gain
  FROM {before}, (SELECT unnest([{cutoffs}]) AS cut, unnest(range({len(cutoffs.split(', '))})) AS place)
  WHERE {part} {sign} cut * {whole} GROUP BY lang, cut, place),
c{i} AS (SELECT lang, arg_max(cut, gain * 100 + place) AS cut FROM g{i} WHERE gain > 0 GROUP BY lang),
t{i} AS (
  SELECT {before}.* FROM {before} LEFT JOIN c{i} ON c{i}.lang IS NOT DISTINCT FROM {before}.lang
  WHERE NOT coalesce({part} {sign} c{i}.cut * {whole}, FALSE)),
v{i} AS (
  SELECT lang, cut, {i} AS step FROM c{i})""")
        before = f"t{i}"
    return ",".join(out)


def _fails(step: int, limit: str) -> str:
    part, whole = _RULES[step][1].split(", ")
    return f"coalesce({part} {_RULES[step][2]} {limit} * {whole}, FALSE)"


OP11 = r"""
WITH d AS (SELECT row_number() OVER () AS row, * FROM documents),
w AS (
  SELECT row, doc_id, lang, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d),
win AS (
  SELECT row, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS win
  FROM (SELECT row, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (
  SELECT row, count(DISTINCT i + k) AS n
  FROM (SELECT row, i, count(*) OVER (PARTITION BY row, win) AS times FROM win), (VALUES (0), (1), (2)) x(k)
  WHERE times > 1 GROUP BY row),
m AS (
  SELECT w.row, doc_id, lang, len(ws)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(ws, lambda x: len(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         len(ls)::BIGINT AS n_lines,
         (len(ws) < 50 OR 100 * coalesce(rep.n, 0) > 50 * len(ws)) AS base_failed
  FROM w LEFT JOIN rep ON rep.row = w.row),
y AS (SELECT doc_id, min(quality) > 0 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
k AS (
  SELECT m.*, good, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(m.doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
           lambda c, b: xor(c // 256, (@crc)[xor(c % 256, b) + 1])), 4294967295) % 3 <> 0 AS holdout
  FROM m JOIN y ON y.doc_id = m.doc_id WHERE NOT base_failed),
tune AS (SELECT * FROM k WHERE NOT holdout),
held AS (SELECT * FROM k WHERE holdout AND good),
n AS (SELECT 0.05::DOUBLE / greatest(1, (SELECT count(*) FROM (SELECT DISTINCT lang FROM k))) AS error),
@steps,
test AS (@tests),
p AS (
  SELECT lang, step, cut,
         coalesce((SELECT sum(exp(lgamma(total + 1.0) - lgamma(j + 1.0) - lgamma(total - j + 1.0) + j * ln(0.02::DOUBLE) + (total - j) * ln(0.98::DOUBLE)))
                   FROM (SELECT unnest(range(bad + 1)) AS j)), 1) AS chance, total, bad
  FROM test),
ok AS (
  SELECT lang, step, cut FROM (
    SELECT *, bool_and(total > 0 AND bad < 0.02::DOUBLE * total AND chance <= (SELECT error FROM n))
                OVER (PARTITION BY lang ORDER BY step) AS passed FROM p)
  WHERE passed)
SELECT m.doc_id, m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, m.base_failed,
       NOT m.base_failed AND @failed IS NULL AS kept,
       CASE WHEN NOT m.base_failed THEN @failed END AS failed_rule
FROM m @joins
""".replace("@crc", _crc_table()).replace("@steps", _risk_steps().lstrip()).replace(
    "@tests", "\n  UNION ALL ".join(
        f"SELECT v{i}.lang, v{i}.step, any_value(v{i}.cut) AS cut, count(h.row) AS total, count(h.row) FILTER ("
        + " OR ".join(_fails(j, f"u{j}.cut") for j in range(i + 1)) + f") AS bad FROM v{i} "
        + " ".join(f"LEFT JOIN c{j} u{j} ON u{j}.lang IS NOT DISTINCT FROM v{i}.lang" for j in range(i + 1))
        + f" LEFT JOIN held h ON h.lang IS NOT DISTINCT FROM v{i}.lang GROUP BY v{i}.lang, v{i}.step" for i in range(len(_RULES)))).replace(
    "@failed", "CASE " + " ".join(f"WHEN {_fails(i, f'o{i}.cut')} THEN '{r[0]}'" for i, r in enumerate(_RULES)) + " END").replace(
    "@joins", " ".join(f"LEFT JOIN ok o{i} ON o{i}.step = {i} AND o{i}.lang IS NOT DISTINCT FROM m.lang" for i in range(len(_RULES))))

ORACLE_SQL = {"op4_mixing": OP4, "op5_ngram_join": OP5, "op11_quality_rules": OP11, "op13_conversation_repair": OP13}
