"""DuckDB SQL for the registered queries that SQL can express. Values are written out here, not imported."""

OP1 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
starts AS (SELECT r, words, unnest(generate_series(1, len(words) - 7)) AS i FROM w WHERE len(words) >= 8),
windows AS (SELECT r, i, array_to_string(words[i:i + 7], ' ') AS g FROM starts),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM windows) WHERE c > 1),
covered AS (SELECT r, sum(least(8, i - before)) AS n FROM (
        SELECT r, i, coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), i - 8) AS before FROM twice) GROUP BY r),
m AS (SELECT w.r, doc_id, len(words) AS n_words, len(array_to_string(words, '')) AS word_chars,
        len(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        coalesce(covered.n, 0) AS n_repeat_words, greatest(len(lines), 1) AS n_lines,
        len(list_filter(words, lambda x: list_contains(string_split('the of and to in a is that it for was on are as with his they be at this from have or by not but what all were we when your can said there an which she do how their if will le la les des et est un une du en que qui dans pour pas sur au avec ce il je ne se plus par son der die das und ist nicht ein eine den von zu mit sich auf als auch dem des im el los las de y una no por con para su al lo como', ' '), x))) AS stops,
        len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS ellipses,
        len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[•*-][\x20\x09-\x0D]'))) AS bullets,
        len(regexp_replace(t, '\P{Lu}+', '', 'g')) AS uppers, len(regexp_replace(t, '\P{L}+', '', 'g')) AS letters
      FROM w LEFT JOIN covered ON covered.r = w.r),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, greatest(n_words, 1) AS n FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND word_chars / n >= 2 AND word_chars / n <= 15 AND n_symbols / n <= 0.1 AND stops / n >= 0.02
    AND n_dup_lines / n_lines <= 0.5 AND ellipses / n_lines <= 0.3 AND bullets / n_lines <= 0.9
    AND uppers / greatest(letters, 1) <= 0.6 AS kept
FROM b"""

OP5 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
s AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS h, max(page_id) OVER (PARTITION BY body) AS first FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
    (CAST('0x' || substr(h, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM s"""

OP6 = r"""
WITH i AS (SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS want FROM benchmark),
it AS (SELECT item_id, len(want) AS n, hash(want) AS v, generate_subscripts(want, 1) AS q, unnest(want) AS tok FROM i WHERE len(want) >= 5),
d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS have FROM documents),
dt AS (SELECT doc_id, generate_subscripts(have, 1) AS p, unnest(have) AS tok FROM d),
m AS (SELECT doc_id, item_id, v, n, q, p - q AS shift FROM dt JOIN it USING (tok)),
near AS (SELECT *, count(*) OVER (PARTITION BY doc_id, item_id, v, shift ORDER BY q RANGE BETWEEN CURRENT ROW AND 12 FOLLOWING) AS c FROM m),
found AS (SELECT DISTINCT doc_id, item_id FROM near WHERE c >= ceil(least(n, 13) * 0.8)),
per AS (SELECT doc_id, list_sort(list(item_id)) AS items FROM found GROUP BY doc_id)
SELECT doc_id, items IS NOT NULL AS contaminated, array_to_string(coalesce(items, []), ',') AS items FROM documents LEFT JOIN per USING (doc_id)"""

OP8 = r"""
WITH u AS (SELECT page_id, url, CAST(DATE '2024-01-01' + CAST(page_id % 365 AS INTEGER) AS DATE) AS fetched_on,
    nullif(lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '') AS h0,
    regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS p0 FROM pages),
c AS (SELECT page_id, url, fetched_on, regexp_replace(h0, '\.$', '') AS host, CASE WHEN p0 = '' THEN '/' ELSE p0 END AS path FROM u),
hosts AS (SELECT host, max(string_split(path, '/')[2]) AS top, md5(host) AS h FROM c WHERE host IS NOT NULL GROUP BY host),
x AS (SELECT host, top, CAST('0x' || substr(h, 1, 1) AS INTEGER) AS a, CAST('0x' || substr(h, 2, 1) AS INTEGER) AS b,
    CAST('0x' || substr(h, 3, 1) AS INTEGER) AS c, CAST('0x' || substr(h, 4, 3) AS INTEGER) AS e, CAST('0x' || substr(h, 7, 1) AS INTEGER) AS f,
    CAST('0x' || substr(h, 8, 2) AS INTEGER) AS g, CAST('0x' || substr(h, 10, 3) AS INTEGER) AS i, CAST('0x' || substr(h, 13, 1) AS INTEGER) AS j,
    CASE WHEN CAST('0x' || substr(h, 1, 1) AS INTEGER) < 8 OR len(string_split(host, '.')) < 1 THEN host
      ELSE '.' || array_to_string(string_split(host, '.')[-2:], '.') END AS pattern FROM hosts),
entries AS (
  SELECT pattern, CAST(DATE '2023-10-01' + e % 300 AS DATE) AS listed_on, CASE WHEN b < 11 THEN 'block' ELSE 'allow' END AS action, 'c' || (c % 5) AS category FROM x
  UNION ALL SELECT pattern, CAST(DATE '2023-10-01' + (e % 300 + 20 + g) AS DATE), 'remove', 'c' || (c % 5) FROM x WHERE f < 6
  UNION ALL SELECT host || '/' || top || '/', CAST(DATE '2023-10-01' + i % 400 AS DATE), CASE WHEN j < 8 THEN 'block' ELSE 'allow' END, 'path' FROM x WHERE top <> ''),
one AS (SELECT CASE WHEN contains(pattern, '/') THEN lower(split_part(pattern, '/', 1)) || substr(pattern, strpos(pattern, '/')) ELSE lower(pattern) END AS pattern, listed_on, max({'action': action, 'category': category}) AS e FROM entries GROUP BY 1, 2),
spans AS (SELECT pattern, listed_on, lead(listed_on) OVER (PARTITION BY pattern ORDER BY listed_on) AS until, e FROM one),
keys AS (SELECT page_id, fetched_on, host AS pattern FROM c WHERE host IS NOT NULL
  UNION SELECT page_id, fetched_on, '.' || array_to_string(string_split(host, '.')[k:], '.') FROM c, range(1, 40) t(k)
    WHERE host IS NOT NULL AND k <= len(string_split(host, '.'))
  UNION SELECT page_id, fetched_on, host || array_to_string(string_split(path, '/')[:k], '/') || '/' FROM c, range(1, 200) t(k)
    WHERE host IS NOT NULL AND k <= greatest(len(string_split(path, '/')) - 1, 1)),
hit AS (SELECT page_id, max({'size': len(k.pattern), 'pattern': k.pattern, 'action': e.action, 'category': e.category, 'listed_on': listed_on}) AS b
  FROM keys k JOIN spans s ON s.pattern = k.pattern AND listed_on <= fetched_on AND (until IS NULL OR fetched_on < until)
  WHERE e.action IN ('block', 'allow') GROUP BY page_id)
SELECT page_id, host, fetched_on, coalesce(b.action = 'block', false) AS blocked, b.pattern AS pattern, b.category AS category, b.listed_on AS listed_on
FROM c LEFT JOIN hit USING (page_id)"""

OP9 = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM d),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS gram FROM g),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS n, b.n AS m, count(*) AS common FROM e a JOIN e b ON a.gram = b.gram AND a.doc_id < b.doc_id
  AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n) GROUP BY ALL),
l AS (SELECT a, b FROM p WHERE 100 * common >= 90 * (n + m - common)),
links AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, k.b FROM reach r JOIN links k ON r.b = k.a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, (SELECT min(b) FROM reach WHERE a = doc_id)) AS component_id FROM g"""

def _crc32(text: str) -> str:
    """CRC-32 of ASCII text, bit by bit."""
    step = ("list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], lambda a, z: "
            "xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END))")
    return (f"xor(list_reduce([4294967295::UBIGINT] || list_transform(string_split({text}, ''), lambda x: ascii(x)::UBIGINT), lambda c, b: {step}), "
            "4294967295::UBIGINT)")


def _tree(name: str, first: str, levels: int) -> str:
    """Nodes (g, p, d, n: nodes of the level) from the leaves up; a group of one node stays as it is."""
    parts = [f"{name}0 AS ({first})"]
    for k in range(1, levels + 1):
        parts.append(f"{name}{k} AS (SELECT g, CAST(floor(p / 2) AS BIGINT) AS p, CASE WHEN n > 1 THEN sha256(string_agg(d, '' ORDER BY p)) ELSE min(d) END AS d, "
                     f"CAST(ceil(n / 2.0) AS BIGINT) AS n FROM {name}{k - 1} GROUP BY g, CAST(floor(p / 2) AS BIGINT), n)")
    return ", ".join(parts)


def _climb(name: str, tree: str, first: str, levels: int) -> str:
    """From rows (r, g, p, proof, f) their proofs and folded digests at the group's root."""
    parts = [f"{name}0 AS ({first})"]
    for k in range(levels):
        parts.append(f"""{name}{k + 1} AS (SELECT c.r, c.g, CAST(floor(c.p / 2) AS BIGINT) AS p, c.proof || coalesce(s.d, '') AS proof,
            CASE WHEN o.n = 1 THEN c.f WHEN s.d IS NULL THEN sha256(c.f) WHEN c.p % 2 = 1 THEN sha256(s.d || c.f) ELSE sha256(c.f || s.d) END AS f
            FROM {name}{k} AS c JOIN {tree}{k} AS o ON o.g = c.g AND o.p = c.p LEFT JOIN {tree}{k} AS s ON s.g = c.g AND s.p = CASE WHEN c.p % 2 = 0 THEN c.p + 1 ELSE c.p - 1 END)""")
    return ", ".join(parts)


def _leaf(n_chars: str) -> str:
    def part(v: str) -> str:
        return f"coalesce(CAST(strlen(CAST({v} AS VARCHAR)) AS VARCHAR) || ':' || CAST({v} AS VARCHAR), '-')"
    return "sha256(" + " || ".join(part(v) for v in ("doc_id", "source", "lang", n_chars, "text")) + ")"


def _least(state: int, deleted: str, forced: str, kept: str) -> str:
    """Least cost of taking row f from a state, without inserts before it; each target's cost is a column of b."""
    return f"least(3 + b.{deleted}, CASE WHEN f.fault < 2 THEN 2 + f.fault + b.{forced} ELSE 1000000000 END, CASE WHEN f.fault < 2 THEN CASE {kept} ELSE 1000000000 END ELSE 1000000000 END)"


OP11 = rf"""
WITH RECURSIVE d AS (SELECT conv_id, turn, coalesce('=' || CAST(conv_id AS VARCHAR), '') AS c, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS what FROM conversations),
e AS (SELECT c, turn, CASE WHEN what = 4 THEN 'user' ELSE role END AS role, CASE what WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN what = 3 THEN [1, 2] ELSE [1] END) AS copy FROM d WHERE what <> 0),
h AS (SELECT *, sha256(CAST(length(role) AS VARCHAR) || ':' || role || text) AS digest, regexp_replace(text, '[ 	-]+$', '') AS body FROM e),
o AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, digest, copy) AS n, row_number() OVER (PARTITION BY c, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
    lag(substr(role, 1, 1)) OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, digest, copy) AS last FROM h),
f AS (SELECT *, CASE WHEN body = '' THEN 3 WHEN seen > 1 THEN 2 WHEN right(body, 1) IN ('.', '!', '?') THEN 0 ELSE 1 END AS fault, substr(role, 1, 1) AS letter FROM o),
every AS (SELECT c, min(conv_id) AS conv_id FROM d GROUP BY c),
size AS (SELECT every.c, count(f.n) AS m FROM every LEFT JOIN f ON f.c = every.c GROUP BY every.c),
costs AS (SELECT c, m + 1 AS n, CAST(0 AS BIGINT) AS v0, CAST(4 AS BIGINT) AS v1, CAST(2 AS BIGINT) AS v2, CAST(0 AS BIGINT) AS v3 FROM size
  UNION ALL SELECT c, n, CAST(least(w0, 2 + w2, 4 + w3) AS BIGINT) AS v0, CAST(least(w1, 2 + w2, 4 + w3) AS BIGINT) AS v1, CAST(least(w2, 2 + w3) AS BIGINT) AS v2, CAST(least(w3, 2 + w2) AS BIGINT) AS v3
  FROM (SELECT f.c, f.n, {_least(0, 'v0', 'v2', "f.letter WHEN 's' THEN f.fault + b.v1 WHEN 'u' THEN f.fault + b.v2")} AS w0, {_least(1, 'v1', 'v2', "f.letter WHEN 'u' THEN f.fault + b.v2")} AS w1,
          {_least(2, 'v2', 'v3', "f.letter WHEN 'a' THEN f.fault + b.v3")} AS w2, {_least(3, 'v3', 'v2', "f.letter WHEN 'u' THEN f.fault + b.v2")} AS w3
        FROM costs AS b JOIN f ON f.c = b.c AND f.n = b.n - 1) AS s),
k AS (SELECT a.c, a.n, s.state, CASE s.state WHEN 0 THEN a.v0 WHEN 1 THEN a.v1 WHEN 2 THEN a.v2 ELSE a.v3 END AS here, CASE s.state WHEN 2 THEN 3 ELSE 2 END AS forced,
    CASE s.state WHEN 2 THEN a.v3 ELSE a.v2 END AS inserted, z.v0 IS NULL AS ended, CASE s.state WHEN 0 THEN z.v0 WHEN 1 THEN z.v1 WHEN 2 THEN z.v2 ELSE z.v3 END AS deleted, f.fault,
    CASE WHEN f.fault >= 2 THEN NULL WHEN s.state = 0 AND f.letter = 's' THEN 1 WHEN s.state <> 2 AND f.letter = 'u' THEN 2 WHEN s.state = 2 AND f.letter = 'a' THEN 3 END AS kept, z.v1, z.v2, z.v3
  FROM costs AS a CROSS JOIN (SELECT CAST(range AS INTEGER) AS state FROM range(4)) AS s LEFT JOIN costs AS z ON z.c = a.c AND z.n = a.n + 1 LEFT JOIN f ON f.c = a.c AND f.n = a.n),
choice AS (SELECT c, n, state, forced, kept, CASE WHEN ended THEN CASE WHEN state IN (1, 2) THEN 'I' END WHEN here = 3 + deleted THEN 'D' WHEN here = 2 + inserted THEN 'I'
    WHEN kept IS NOT NULL AND here = fault + CASE kept WHEN 1 THEN v1 WHEN 2 THEN v2 ELSE v3 END THEN 'K' ELSE 'R' END AS edit FROM k),
steps AS (SELECT c, CAST(0 AS BIGINT) AS step, CAST(1 AS BIGINT) AS n, 0 AS state, CAST('' AS VARCHAR) AS edit FROM size
  UNION ALL SELECT t.c, t.step + 1 AS step, CASE WHEN x.edit = 'I' THEN t.n ELSE t.n + 1 END AS n, CAST(CASE x.edit WHEN 'D' THEN t.state WHEN 'K' THEN x.kept ELSE x.forced END AS INTEGER) AS state, x.edit
  FROM steps AS t JOIN choice AS x ON x.c = t.c AND x.n = t.n AND x.state = t.state WHERE x.edit IS NOT NULL),
lines AS (SELECT t.c, t.step, t.edit, CASE t.edit WHEN 'K' THEN f.role WHEN 'D' THEN NULL ELSE CASE t.state WHEN 2 THEN 'user' ELSE 'assistant' END END || ':' || CASE WHEN t.edit = 'I' THEN '' ELSE f.text END AS line
  FROM steps AS t LEFT JOIN f ON f.c = t.c AND f.n = t.n - 1 AND t.edit <> 'I' WHERE t.step > 0),
done AS (SELECT c, string_agg(edit, '' ORDER BY step) AS audit, string_agg(line, chr(10) ORDER BY step) AS whole FROM lines GROUP BY c),
facts AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 3) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate,
    count(*) FILTER (WHERE fault = 1) AS truncated, count(*) FILTER (WHERE last IS NOT NULL AND last || letter NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY c)
SELECT every.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(v0, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM every LEFT JOIN facts ON facts.c = every.c LEFT JOIN done ON done.c = every.c LEFT JOIN costs ON costs.c = every.c AND costs.n = 1"""

LEVELS = 24  # enough for sixteen million documents of a language, and as many languages
OP12 = f"""
WITH d AS (SELECT doc_id, lang, {_leaf("n_chars")} AS leaf, CASE WHEN doc_id IS NOT NULL AND {_crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_leaf("n_chars + 1")} END AS other FROM documents),
e AS (SELECT *, coalesce('=' || lang, '') AS g FROM d),
x AS (SELECT *, row_number() OVER () AS r, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY g) AS n FROM e),
{_tree("a", "SELECT g, p, leaf AS d, n FROM x", LEVELS)},
y AS (SELECT g AS lang_key, d, row_number() OVER (ORDER BY g) - 1 AS p, count(*) OVER () AS n FROM a{LEVELS} WHERE p = 0),
{_tree("t", "SELECT 'all' AS g, p, d, n FROM y", LEVELS)},
{_climb("c", "a", "SELECT r, g, p, '' AS proof, coalesce(other, leaf) AS f FROM x", LEVELS)},
{_climb("u", "t", f"SELECT c.r, 'all' AS g, y.p, c.proof, c.f FROM c{LEVELS} AS c JOIN y ON y.lang_key = c.g", LEVELS)}
SELECT x.doc_id, x.leaf, y.d AS subroot, t.d AS root, sha256(u.proof) AS proof_sha256, u.f AS folded_root, u.f = t.d AS verified
FROM x JOIN y ON y.lang_key = x.g JOIN u{LEVELS} AS u ON u.r = x.r CROSS JOIN t{LEVELS} AS t"""

ORACLES = {"op1_quality": OP1, "op5_warc": OP5, "op6_decontamination": OP6, "op8_url_filters": OP8, "op9_jaccard_join": OP9, "op11_conversation_repair": OP11, "op12_merkle": OP12}
