"""The corpus queries as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from issuelens.llm import dialogue_repair as R
from issuelens.llm import divergence as D
from issuelens.llm import quality_rules as Q
from issuelens.llm.queries import SITE_RULES
from issuelens.llm.url_filters import DEFAULT_PATTERNS

_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NGRAM_JOIN = f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS sh FROM w),
n AS (SELECT doc_id, len(sh)::BIGINT AS n_shingles FROM s),
t AS (SELECT doc_id, unnest(sh) AS x FROM s),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS i FROM t a JOIN t b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id),
l AS (SELECT u, v FROM p JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v
  WHERE 100 * i >= 90 * (a.n_shingles + b.n_shingles - i)),
e AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM n UNION SELECT e.v, r.root FROM r JOIN e ON r.doc_id = e.u)
SELECT doc_id, n_shingles, min(root) AS component_id FROM r JOIN n USING (doc_id) GROUP BY doc_id, n_shingles
"""

LINE_DEDUP = f"""
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(range(len(ls))) AS pos, unnest(ls) AS line FROM cut),
k AS (SELECT doc_id, pos, line, translate(trim(line, {_WHITE}), '{_UP}', '{_LOW}') AS key FROM l),
r AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.doc_id, k.pos, k.line, r.keeper IS NOT NULL AND k.doc_id < r.keeper AS gone FROM k LEFT JOIN r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

MIXING = """
WITH d AS (SELECT doc_id, source,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> ''))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))), 1, 15))::BIGINT >> 20 AS h
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM s),
o AS (SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS w_all,
    coalesce(sum(2 * source_size) OVER p, 0) AS c_before, coalesce(sum(w) OVER p, 0) AS w_before
  FROM r WINDOW p AS (ORDER BY 2.0 * source_size / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lev AS (SELECT max((1.5::DOUBLE * total::DOUBLE - c_before::DOUBLE) / (w_all - w_before)::DOUBLE) AS level FROM o),
t AS (SELECT r.*, least(2.0::DOUBLE * source_size::DOUBLE, level * w) AS target FROM r, lev),
b AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
g AS (SELECT d.source, d.h, sum(d.size) AS size FROM d GROUP BY d.source, d.h),
c AS (SELECT g.source, g.h, sum(g.size) OVER (PARTITION BY g.source ORDER BY g.h) AS upto, g.size FROM g),
pick AS (SELECT c.source, c.h, b.whole + CASE
    WHEN c.upto <= b.target - b.whole * b.source_size THEN 1
    WHEN c.upto - c.size <= b.target - b.whole * b.source_size
     AND c.upto - (b.target - b.whole * b.source_size) < (b.target - b.whole * b.source_size) - (c.upto - c.size) THEN 1
    ELSE 0 END AS copies
  FROM c JOIN b ON c.source IS NOT DISTINCT FROM b.source)
SELECT d.doc_id, d.size, b.source_size, b.target, (d.size * pick.copies)::BIGINT AS taken
FROM d JOIN pick ON d.h = pick.h AND d.source IS NOT DISTINCT FROM pick.source
JOIN b ON d.source IS NOT DISTINCT FROM b.source
"""


def _quality_sql() -> str:
    """Limits, then the minimum-covariance-determinant steps as a chain of CTEs."""
    dims = range(Q.DIMS)
    cells = [(i, j) for i in dims for j in range(i + 1)]
    xs = ", ".join(f"x{i}" for i in dims)
    ys = ", ".join(f"(x{i} - m{i}" + "".join(f" - l{i}{k} * y{k}" for k in range(i)) + f") / l{i}{i} AS y{i}" for i in dims)
    d2 = " + ".join(f"y{i} * y{i}" for i in dims) + " AS d2"
    sums = ", ".join(["count(*) AS n", *[f"sum(x{i}) AS s{i}" for i in dims],
                      *[f"sum(x{i} * x{j}) AS c{i}{j}" for i, j in cells]])
    again = ", ".join(f"sum({c}) AS {c}" for c in ["n", *[f"s{i}" for i in dims], *[f"c{i}{j}" for i, j in cells]])

    def estimate(factor: float) -> str:
        cov = [f"(c{i}{j} / n - (s{i} / n) * (s{j} / n)) * {factor} + {(Q.FLOORS[i] * Q.GRAIN) ** 2 if i == j else 0.0} AS v{i}{j}"
               for i, j in cells]
        chol = []
        for i, j in cells:
            dot = "".join(f" - l{i}{k} * l{j}{k}" for k in range(j))
            chol.append(f"sqrt(greatest(v{i}{i}{dot}, 1.0)) AS l{i}{i}" if i == j else f"(v{i}{j}{dot}) / l{j}{j} AS l{i}{j}")
        return ", ".join(["g", *[f"s{i} / n AS m{i}" for i in dims], *cov, *chol])

    steps = []
    for k in range(Q.STEPS):
        steps.append(f"""b{k} AS (SELECT g, bin, {sums} FROM (
  SELECT g, {xs}, {ys}, {d2}, floor(ln(d2 + 1e-6) * 8) AS bin FROM fit JOIN e{k} USING (g)) GROUP BY g, bin),
e{k + 1} AS MATERIALIZED (SELECT {estimate(Q.CONSISTENCY)} FROM (SELECT g, {again} FROM (
  SELECT *, sum(n) OVER (PARTITION BY g ORDER BY bin) - n AS before, sum(n) OVER (PARTITION BY g) AS total FROM b{k})
  WHERE before < total * {Q.PART} GROUP BY g))""")
    start = ", ".join([*[f"max(m) FILTER (WHERE d = {i}) AS m{i}" for i in dims], *[
        f"max(sqrt(sd * sd + {(Q.FLOORS[i] * Q.GRAIN) ** 2})) FILTER (WHERE d = {i}) AS l{i}{i}" if i == j
        else f"0.0 AS l{i}{j}" for i, j in cells]])
    each = " UNION ALL ".join(f"SELECT g, {i} AS d, floor(x{i} / 16) AS v FROM fit" for i in dims)
    at = lambda q: f"(min(v) FILTER (WHERE upto >= {q} * total) * 16.0 + 8.0)"
    white, symbols = "[\\x20\\x09-\\x0D]", "[#*$%&|<>]"
    return f"""
WITH doc AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, lang, source,
    list_filter(regexp_split_to_array(coalesce(text, ''), '{white}+'), lambda x: x <> '') AS ws FROM documents),
win AS (SELECT rid, i, ws[i:i + 4] AS gram FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM doc)),
rep AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, gram) > 1),
cov AS (SELECT rid, count(DISTINCT i + k) AS n FROM rep, range(5) AS r(k) GROUP BY rid),
base AS (SELECT rid, doc_id, lang, source, t, len(ws)::BIGINT AS n_words,
    length(regexp_replace(t, '{white}', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '{symbols}', '', 'g')))::BIGINT AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: trim(x, {_WHITE}) <> '') AS ls,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
    length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
  FROM doc LEFT JOIN cov USING (rid)),
st AS (SELECT *, greatest(n_words, 1)::DOUBLE AS nw,
    round(ln(greatest(word_chars, 1) / nw) * {Q.GRAIN}) AS x0, round(ln(1 + 10.0::DOUBLE * n_symbols / nw) * {Q.GRAIN}) AS x1,
    round(ln(1 + 100.0::DOUBLE * n_dup_lines / nw) * {Q.GRAIN}) AS x2,
    round(ln(1 + 10.0::DOUBLE * n_repeat_words / nw) * {Q.GRAIN}) AS x3,
    round(ln(1 + 10.0::DOUBLE * n_upper / greatest(word_chars, 1)) * {Q.GRAIN}) AS x4 FROM base),
sz AS (SELECT lang, source, count(*) FILTER (WHERE NOT base_failed) AS n FROM st GROUP BY lang, source),
gr AS (SELECT *, sum(CASE WHEN n < {Q.MIN_GROUP} THEN n ELSE 0 END) OVER (PARTITION BY lang) AS rest FROM sz),
nm AS (SELECT lang, source, CASE WHEN n >= {Q.MIN_GROUP} THEN {{k: 0, a: lang, b: source}}
    WHEN rest >= {Q.MIN_GROUP} THEN {{k: 1, a: lang, b: NULL}} ELSE {{k: 2, a: NULL, b: NULL}} END AS g FROM gr),
rs AS MATERIALIZED (SELECT st.*, nm.g FROM st JOIN nm ON st.lang IS NOT DISTINCT FROM nm.lang
  AND st.source IS NOT DISTINCT FROM nm.source),
fit AS MATERIALIZED (SELECT g, {xs} FROM rs WHERE NOT base_failed),
ct AS (SELECT g, d, v, count(*) AS n FROM ({each}) GROUP BY g, d, v),
up AS (SELECT *, sum(n) OVER (PARTITION BY g, d ORDER BY v) AS upto, sum(n) OVER (PARTITION BY g, d) AS total FROM ct),
sp AS (SELECT g, d, {at(0.5)} AS m, ({at(0.75)} - {at(0.25)}) / 1.349 AS sd FROM up GROUP BY g, d),
e0 AS MATERIALIZED (SELECT g, {start} FROM sp GROUP BY g),
{", ".join(steps)},
fin AS MATERIALIZED (SELECT {estimate(Q.REWEIGHTED)} FROM (SELECT g, {sums} FROM (
  SELECT g, {xs}, {ys}, {d2} FROM fit JOIN e{Q.STEPS} USING (g)) WHERE d2 <= {Q.REWEIGHT_AT} GROUP BY g)),
sc AS (SELECT rs.*, {ys}, {d2} FROM rs LEFT JOIN fin USING (g))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(d2, 0) <= {Q.REJECT_AT} AS kept FROM sc
"""


def _url_sql() -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    sites = ", ".join(f"({q(r.action)}, {q(r.name.partition('/')[0])}, {q('/' + r.name.partition('/')[2])}, {q(r.name)})"
                      for r in SITE_RULES)
    blocks = " OR ".join(f"regexp_matches(host || path, {q(p.pattern)})" for p in DEFAULT_PATTERNS)
    return f"""
WITH rules(action, rhost, rpath, name) AS (VALUES {sites}),
u AS (SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{_UP}', '{_LOW}') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
f AS (SELECT u.page_id, u.host, u.path, first(rules.name ORDER BY length(rules.name) DESC) FILTER (WHERE rules.name IS NOT NULL) AS rule,
    first(rules.action ORDER BY length(rules.name) DESC) FILTER (WHERE rules.name IS NOT NULL) AS action
  FROM u LEFT JOIN rules ON (u.host = rhost OR u.host LIKE '%.' || rhost) AND starts_with(u.path, rpath)
  GROUP BY ALL)
SELECT page_id, host, path, rule, coalesce(action, CASE WHEN {blocks} THEN 'block' ELSE 'allow' END) AS verdict FROM f
"""


DIVERGENCE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts FROM documents),
t AS (SELECT rid, lang, source, unnest(ts) AS term FROM d),
k AS (SELECT lang, term, count(*) OVER (PARTITION BY lang) AS v FROM (
  SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT rid) >= {D.MIN_DOCS})),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY lang, source, term),
c AS (SELECT g.lang, g.source, k.term, k.v, coalesce(n.n, 0)::HUGEINT AS n FROM g JOIN k USING (lang) LEFT JOIN n USING (lang, source, term)),
p AS (SELECT lang, source, term, n,
    1 + {D.SCALE}::HUGEINT * (n + 2) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p,
    1 + {D.SCALE}::HUGEINT * (sum(n) OVER (PARTITION BY lang, term) + 2) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS q FROM c),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value,
  (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM r
QUALIFY part = 'pair' OR rank <= {D.TOP_TERMS}
"""


def _repair_sql() -> str:
    """Least label (cost, audit, text) for each end of the pattern, row by row."""
    best = lambda *ways: f"list_min([{', '.join(ways)}])"
    put = lambda v, cost, letter, line: f"{{c: {v}.c + {cost}, a: {v}.a || '{letter}', t: {v}.t || {line}}}"
    gone = lambda v: put(v, R.DELETE, "D", "''")
    added = lambda v, role: put(v, R.INSERT, "I", f"chr(10) || '{role}:'")

    def into(v: str, initial: str, role: str) -> list[str]:
        far = "NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR)"
        kept = f"CASE WHEN NOT bad AND initial = '{initial}' THEN {put(v, 'cut', 'K', 'chr(10) || line')} ELSE {far} END"
        named = f"""CASE WHEN NOT bad THEN {put(v, f'cut + {R.RENAME}', 'R', f"chr(10) || '{role}:' || text")} ELSE {far} END"""
        return [kept] if initial == "s" else [kept, named]

    user = [w for v in ("v0", "vs", "va") for w in into(v, "u", "user")]
    step = f"""SELECT key, pos, v0, vs, u AS vu, va FROM (
  SELECT key, pos, v0, vs, {best("u", added("va", "user"))} AS u, va FROM (
  SELECT key, pos, v0, vs, u, {best("a", added("u", "assistant"))} AS va FROM (
  SELECT key, pos, v0, vs, {best("u", added("v0", "user"), added("vs", "user"), added("a", "user"))} AS u, a FROM (
  SELECT w.key, x.pos, {gone("v0")} AS v0, {best(gone("vs"), *into("v0", "s", ""))} AS vs, {best(gone("vu"), *user)} AS u,
    {best(gone("va"), *into("vu", "a", "assistant"))} AS a FROM w JOIN x ON x.key = w.key AND x.pos = w.pos + 1))))"""
    start = "{c: %s::BIGINT, a: '%s', t: %s}"
    lines = "chr(10) || 'user:'"
    ends = ", ".join(start % x for x in ((0, "", "''"), (10 ** 9, "", "''"), (3, "I", lines), (6, "II", lines + " || chr(10) || 'assistant:'")))
    crc = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(id, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(1, 9)), lambda y, i: xor(y >> 1, (y & 1) * 3988292384::BIGINT))), 4294967295::BIGINT)"""
    count = lambda what: f"count(*) FILTER (WHERE {what})"
    return f"""
WITH RECURSIVE r AS (SELECT conv_id, coalesce('=' || conv_id::VARCHAR, '') AS key, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS id FROM conversations),
h AS (SELECT *, {crc} % 20 AS fate FROM r),
d AS (SELECT key, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM h, range(CASE WHEN fate = 3 THEN 2 ELSE 1 END) WHERE fate <> 0),
o AS (SELECT *, left(role, 1) AS initial, trim(text, {_WHITE}) AS solid,
    row_number() OVER (PARTITION BY key ORDER BY turn NULLS FIRST, role, text) AS pos FROM d),
s AS (SELECT *, solid = '' AS blank, solid <> '' AND row_number() OVER (PARTITION BY key, role, text ORDER BY pos) > 1 AS again,
    lag(initial) OVER (PARTITION BY key ORDER BY pos) || initial AS two FROM o),
x AS (SELECT key, pos, turn, role || ':' || text AS line, text, initial, blank, again, blank OR again AS bad, two,
    NOT blank AND NOT again AND right(solid, 1) NOT IN ('.', '!', '?') AS short, CASE WHEN short THEN {R.CUT} ELSE 0 END AS cut FROM s),
z AS (SELECT key, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, {count("blank")} AS blank,
    {count("again")} AS duplicate, {count("short")} AS truncated, {count("two NOT IN ('su', 'ua', 'au')")} AS illegal FROM x GROUP BY key),
w(key, pos, v0, vs, vu, va) AS (SELECT key, 0::BIGINT, {ends} FROM z UNION ALL {step}),
e AS (SELECT w.key, list_min([v0, va]) AS v FROM w JOIN z ON z.key = w.key AND z.n = w.pos)
SELECT c.conv_id, coalesce(z.gaps, 0)::BIGINT AS gaps, coalesce(z.blank, 0) AS blank, coalesce(z.duplicate, 0) AS duplicate,
  coalesce(z.truncated, 0) AS truncated, coalesce(z.illegal, 0) AS illegal, coalesce(e.v.c, 0)::BIGINT AS cost,
  coalesce(e.v.a, '') AS audit, sha256(coalesce(substr(e.v.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, key FROM r) c LEFT JOIN z USING (key) LEFT JOIN e USING (key)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_ngram_join": NGRAM_JOIN, "op3_line_dedup": LINE_DEDUP, "op6_quality_rules": _quality_sql(), "op8_source_mixing": MIXING,
            "op10_url_filters": _url_sql(), "op11_conversation_repair": _repair_sql(), "op12_source_divergence": DIVERGENCE}
