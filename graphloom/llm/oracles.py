"""DuckDB SQL for the queries that SQL can express."""
from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP2 = """
WITH per AS (SELECT source, count(*) AS n, sqrt(count(*)::DOUBLE) AS share FROM documents GROUP BY source),
tot AS (SELECT sum(share) AS s, sum(n)::DOUBLE AS n FROM per),
rated AS (SELECT source, share / (SELECT s FROM tot) * (SELECT n FROM tot) / n AS rate FROM per),
lam AS (SELECT source, rate / greatest(1, ceil(rate / 32.0)) AS rate, greatest(1, ceil(rate / 32.0))::INT AS strata FROM rated),
cdf AS (SELECT source, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS c
        FROM (SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 20)::INT)) AS k FROM lam)),
told AS (SELECT *, md5(concat_ws(':', coalesce(text, 'null'), coalesce(lang, 'null'), coalesce(source, 'null'), coalesce(n_chars::VARCHAR, 'null'))) AS digest,
                count(*) OVER (PARTITION BY doc_id) > 1 OR doc_id IS NULL AS unclear FROM documents),
named AS (SELECT * EXCLUDE (digest, unclear), CASE WHEN unclear THEN coalesce(doc_id::VARCHAR, 'null') || '#' || digest || '#'
                 || row_number() OVER (PARTITION BY doc_id, digest) ELSE doc_id::VARCHAR END AS name FROM told),
st AS (SELECT d.*, l.strata, unnest(range(1, l.strata + 1)) AS stratum
       FROM named d JOIN lam l ON d.source IS NOT DISTINCT FROM l.source),
u AS (SELECT *, (('0x' || substr(sha256('7:rate:' || name || ':' || stratum), 1, 15))::BIGINT >> 8)::DOUBLE AS bits
      FROM st),
counted AS (SELECT u.doc_id, u.text, u.lang, u.source, u.n_chars, u.stratum, u.name,
                   (SELECT count(*) FROM cdf WHERE cdf.source IS NOT DISTINCT FROM u.source
                     AND cdf.c < (u.bits + 0.5) / 4503599627370496.0) AS k FROM u),
copies AS (SELECT * EXCLUDE (k), unnest(range(1, k + 1)) AS copy FROM counted WHERE k > 0),
keyed AS (SELECT *, ('0x' || substr(sha256('7:order:' || name || ':' || stratum || ':' || copy), 1, 15))::BIGINT AS o
          FROM copies)
SELECT doc_id, text, lang, source, n_chars, stratum::INT AS stratum, copy::INT AS copy,
       row_number() OVER (ORDER BY o, doc_id, name, stratum, copy) - 1 AS position
FROM keyed
"""

OP3 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
q AS (SELECT * FROM v WHERE vec_id % 50 = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.v::DOUBLE[], v.v::DOUBLE[])::BIGINT AS score
      FROM q JOIN v ON q.vec_id <> v.vec_id)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""

OP9 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, {WORDS} AS w FROM documents),
ln AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
       FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)
       WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
win AS (SELECT rid, i, array_to_string(list_slice(w, i, i + 7), ' ') AS g
        FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, sum(step) AS n FROM
        (SELECT rid, least(8, i - lag(i, 1, -8) OVER (PARTITION BY rid ORDER BY i)) AS step FROM twice) GROUP BY rid),
m AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
             coalesce(cov.n, 0)::BIGINT AS n_repeat_words
      FROM d LEFT JOIN ln USING (rid) LEFT JOIN cov USING (rid)),
b AS (SELECT *, ((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT
              + 4 * (10 * n_symbols > n_words)::INT + 8 * (100 * n_dup_lines > 30 * n_lines)::INT
              + 16 * (word_chars < 2 * n_words OR word_chars > 15 * n_words)::INT
              + 32 * (n_words > 100000)::INT)::BIGINT AS fail_bits FROM m)
SELECT *, fail_bits & 3 <> 0 AS base_failed, fail_bits & 23 = 0 AS kept FROM b
"""


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    step = "list_reduce([0,1,2,3,4,5,6,7], lambda d, k: xor(d >> 1, 3988292384 * (d & 1)), xor(c, b)::BIGINT)::BIGINT"
    codes = f"list_transform(range(1, strlen({text}) + 1), lambda i: ord(({text})[i])::BIGINT)"
    return f"xor(4294967295, list_reduce({codes}, lambda c, b: {step}, 4294967295::BIGINT))"


OP12 = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, list({{'r': role, 'x': text}} ORDER BY turn NULLS FIRST, md5(strlen(role) || ':' || role || text)) AS s
      FROM t GROUP BY conv_id),
h AS (SELECT conv_id, s, conv_id - conv_id % 5 AS base, ({_crc32('conv_id::VARCHAR')} % 9)::INT AS h FROM l),
r AS (SELECT h.conv_id, list_concat(coalesce(list_slice(b.s, 1, h.h), []), list_slice(h.s, h.h + 1, len(h.s))) AS s
      FROM h LEFT JOIN l b ON b.conv_id = h.base),
m AS (SELECT conv_id, d, min(conv_id) OVER w AS node, count(*) OVER w AS n, strlen(s[d].x) AS bytes, len(s) = d AS ends
      FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM r)
      WINDOW w AS (PARTITION BY d, list_slice(s, 1, d))),
node AS (SELECT node, d, any_value(n) AS n, coalesce(any_value(bytes), 0) AS bytes,
                sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
         FROM m GROUP BY node, d),
up AS (SELECT x.*, p.node AS parent FROM node x LEFT JOIN m p ON p.conv_id = x.node AND p.d = x.d - 1),
kids AS (SELECT parent, d - 1 AS d, count(*) AS n_children FROM up WHERE parent IS NOT NULL GROUP BY 1, 2),
full_node AS (SELECT up.*, coalesce(n_children, 0) AS n_children FROM up LEFT JOIN kids ON kids.parent = up.node AND kids.d = up.d),
sums AS (SELECT m.node, m.d, sum((y.n_children = 0)::INT) AS n_leaves, sum((y.n - 1) * y.bytes) AS saved
         FROM full_node y JOIN m ON m.conv_id = y.node AND m.d <= y.d GROUP BY 1, 2)
SELECT f.node AS conv_id, f.d::BIGINT AS depth, f.parent AS parent_conv_id, f.n::BIGINT AS n_convs, f.n_children::BIGINT AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, f.ends_sha256
FROM full_node f JOIN sums s ON s.node = f.node AND s.d = f.d
"""


def _edited(letters: str, cost: str, rest: str) -> str:
    return f"{{'c': {cost} + {rest}.c, 'a': '{letters}' || {rest}.a}}"


def _least(*ways: str) -> str:
    """The smallest of some (cost, audit) structs; NULL ways are ruled out."""
    return f"list_min([{', '.join(ways)}])"


_NEXT = {0: 2, 1: 2, 2: 3, 3: 2}  # pattern state after the turn that may come next
_KEPT = {0: "CASE ini WHEN 's' THEN e1 WHEN 'u' THEN e2 END", 1: "CASE ini WHEN 'u' THEN e2 END",
         2: "CASE ini WHEN 'a' THEN e3 END", 3: "CASE ini WHEN 'u' THEN e2 END"}


def _row_edit(q: int) -> str:
    kept = f"CASE WHEN NOT gone AND ({_KEPT[q]}) IS NOT NULL THEN {_edited('K', 'extra', f'({_KEPT[q]})')} END"
    turned = f"CASE WHEN NOT gone THEN {_edited('R', '1 + extra', f'e{_NEXT[q]}')} END"
    return _least(_edited("D", "2", f"e{q}"), kept, turned) + f" AS g{q}"


def _with_inserts(q: int) -> str:
    a, b = _NEXT[q], _NEXT[_NEXT[q]]
    return _least(f"g{q}", _edited("I", "5", f"g{a}"), _edited("II", "10", f"g{b}")) + f" AS e{q}"


OP13 = rf"""
WITH RECURSIVE src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
hurt AS (SELECT *, {_crc32('name')} % 20 AS kind, md5(strlen(role) || ':' || role || text) AS tie FROM src),
dam AS (SELECT coalesce(conv_id::VARCHAR, '') AS ck, turn, tie, copy, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
               CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM (SELECT *, unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM hurt)),
num AS (SELECT *, row_number() OVER (PARTITION BY ck ORDER BY turn NULLS FIRST, tie, copy) AS i, left(role, 1) AS ini,
               rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS seen FROM dam),
flag AS (SELECT *, seen = '' AS blank, seen <> '' AND row_number() OVER (PARTITION BY ck, role, text ORDER BY i) > 1 AS dup,
                lag(ini) OVER (PARTITION BY ck ORDER BY i) || ini NOT IN ('su', 'ua', 'au') AS bad FROM num),
rows AS (SELECT *, blank OR dup AS gone, CASE WHEN NOT blank AND NOT dup AND right(seen, 1) NOT IN ('.', '!', '?') THEN 5 ELSE 0 END AS extra FROM flag),
per AS (SELECT ck, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(blank::INT) AS blank, sum(dup::INT) AS duplicate,
               sum((extra > 0)::INT) AS truncated, sum(coalesce(bad, false)::INT) AS illegal, count(*) AS n FROM rows GROUP BY ck),
dp AS (
  SELECT ck, n AS i, {{'c': 0::BIGINT, 'a': ''}} AS e0, {{'c': 10::BIGINT, 'a': 'II'}} AS e1, {{'c': 5::BIGINT, 'a': 'I'}} AS e2,
         {{'c': 0::BIGINT, 'a': ''}} AS e3 FROM per
  UNION ALL
  SELECT ck, i, {', '.join(_with_inserts(q) for q in range(4))}
  FROM (SELECT ck, dp.i - 1 AS i, {', '.join(_row_edit(q) for q in range(4))}
        FROM dp JOIN rows USING (ck) WHERE rows.i = dp.i)),
best AS (SELECT ck, e0.c AS cost, e0.a AS audit FROM dp WHERE i = 0),
step AS (SELECT ck, k, audit[k] AS letter,
                count(*) FILTER (audit[k] <> 'I') OVER (PARTITION BY ck ORDER BY k) AS i,
                count(*) FILTER (audit[k] <> 'D') OVER (PARTITION BY ck ORDER BY k) AS m
         FROM (SELECT ck, audit, unnest(range(1, length(audit) + 1)) AS k FROM best)),
placed AS (SELECT s.*, r.role, r.text, max((letter = 'K' AND ini = 's')::INT) OVER (PARTITION BY s.ck) AS head
           FROM step s LEFT JOIN rows r ON r.ck = s.ck AND r.i = s.i AND s.letter <> 'I'),
said AS (SELECT ck, string_agg(CASE WHEN letter = 'K' THEN role WHEN (m - head) % 2 = 1 THEN 'user' ELSE 'assistant' END
                               || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS t
         FROM placed WHERE letter <> 'D' GROUP BY ck)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(conv_id::VARCHAR, '') AS ck FROM conversations) c
LEFT JOIN per USING (ck) LEFT JOIN best USING (ck) LEFT JOIN said USING (ck)
"""

ORACLES: dict[str, str] = {
    "op2_mix_sources": OP2,
    "op3_top_k": OP3,
    "op9_quality": OP9,
    "op12_prefix_trie": OP12,
    "op13_structure_repair": OP13,
}
