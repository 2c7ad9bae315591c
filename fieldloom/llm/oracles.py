"""DuckDB SQL of the queries that SQL can express, written from their contracts."""

CHAT = r"""WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
coded AS (SELECT *, replace(replace(text, '### ', '#\## '), '</turn>', '<\/turn>') AS once,
  replace(replace(replace(text, '\', '\b'), '#', '\h'), '<', '\l') AS twice,
  replace(replace(replace(replace(replace(role, '\', '\b'), '#', '\h'), '<', '\l'), ':', '\c'), chr(10), '\n') AS name FROM rows),
shown AS (SELECT *, CASE WHEN NOT contains(text, '### ') AND NOT contains(text, '</turn>') THEN text
  WHEN NOT contains(once, '### ') AND NOT contains(once, '</turn>')
    AND replace(replace(once, '<\/turn>', '</turn>'), '#\## ', '### ') = text THEN once ELSE twice END AS escaped FROM coded),
whole AS (SELECT conv_id, count(*) AS n_turns,
  string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
  coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
  CAST(sum(4 + length(name) + 4 + length(escaped) + 8) AS BIGINT) AS formatted_chars FROM shown GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, formatted_chars FROM whole"""

SEEDS = range(16)
DRAWS = ", ".join(f"CAST('0x' || substr(md5('mix {i // 4}:' || doc_id), {1 + 7 * (i % 4)}, 7) AS BIGINT)" for i in SEEDS)
SUMS = ", ".join(f"sum(size * (whole + CAST(draws[{i + 1}] < fraction * 268435456 AS BIGINT))) AS s{i}" for i in SEEDS)
TRIED = ", ".join(f"struct_pack(off := abs(s{i} - target), seed := {i})" for i in SEEDS)

MIXING = f"""WITH sized AS (SELECT doc_id, source,
  CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents),
ranked AS (SELECT source, source_size, 2 * source_size AS stop,
  [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS w
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source)),
prefixes AS (SELECT *, 3 * sum(source_size) OVER () - 2 * coalesce(sum(stop) OVER before, 0) AS num,
  2 * (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS den,
  row_number() OVER (ORDER BY stop / w, source) AS k FROM ranked
  WINDOW before AS (ORDER BY stop / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
rate AS (SELECT num, den FROM prefixes WHERE stop * den >= w * num ORDER BY k LIMIT 1),
targets AS (SELECT source, source_size, CASE WHEN stop * den < w * num THEN CAST(stop AS DOUBLE)
  ELSE CAST(w * num AS DOUBLE) / CAST(den AS DOUBLE) END AS target FROM ranked, rate),
rates AS (SELECT *, CAST(floor(coalesce(target / nullif(source_size, 0), 0)) AS BIGINT) AS whole,
  coalesce(target / nullif(source_size, 0), 0) - floor(coalesce(target / nullif(source_size, 0), 0)) AS fraction FROM targets),
drawn AS (SELECT doc_id, source, size, source_size, target, whole, fraction, [{DRAWS}] AS draws
  FROM sized JOIN rates USING (source)),
chosen AS (SELECT source, list_min([{TRIED}]).seed AS seed FROM (
  SELECT source, any_value(target) AS target, {SUMS} FROM drawn GROUP BY source))
SELECT doc_id, size, source_size, target,
  size * (whole + CAST(draws[CAST(seed + 1 AS INT)] < fraction * 268435456 AS BIGINT)) AS taken
FROM drawn JOIN chosen USING (source)"""

DIGESTS = """WITH bytes AS (SELECT page_id, coalesce(encode(html), ''::BLOB) AS payload FROM pages),
hashed AS (SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS hex FROM bytes),
bits AS (SELECT *, list_aggregate(list_transform(range(0, 40), lambda i: list_aggregate(list_transform(range(0, 4),
  lambda b: CAST((CAST('0x' || hex[i + 1] AS INT) >> (3 - b)) & 1 AS VARCHAR)), 'string_agg', '')), 'string_agg', '') AS text
  FROM hashed),
coded AS (SELECT page_id, payload_bytes, list_aggregate(list_transform(range(0, 32), lambda i:
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[CAST(1 + list_sum(list_transform(range(0, 5), lambda b:
  CAST(text[5 * i + b + 1] AS INT) * (1 << CAST(4 - b AS INT)))) AS BIGINT)]), 'string_agg', '') AS payload_digest FROM bits)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM coded)"""

# crc32 as a rule: the table of the reflected polynomial, then one step a byte
CRC_TABLE = """crc AS (SELECT list(list_reduce(range(8), lambda a, b: xor(a >> 1, (a & 1) * 3988292384), i) ORDER BY i) AS t
  FROM range(256) r(i))"""


def crc32(text: str, table: str = "(SELECT t FROM crc)") -> str:
    octets = (f"list_transform(range(octet_length(encode({text}))), lambda i: "
              f"CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT))")
    return (f"xor(list_reduce({octets}, lambda a, b: xor(a >> 8, {table}[xor(a & 255, b) + 1]), "
            "4294967295::BIGINT), 4294967295)")


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode(CAST({value} AS VARCHAR))) || ':' || {value}, '-')"


def _row(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


CHANGED = f"CASE WHEN {crc32('CAST(doc_id AS VARCHAR)', 't')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END"


def _grown(name: str, base: str) -> str:
    """Levels of trees: tree, lvl, pos, h."""
    return f"""{name} AS ({base} UNION ALL SELECT tree, lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}) WHERE n > 1 GROUP BY tree, lvl, pos // 3)"""


def _climbed(name: str, base: str, nodes: str) -> str:
    """Rows that climb a tree: rowno, tree, lvl, pos, h (recomputed), proof."""
    return f"""{name} AS ({base} UNION ALL SELECT c.rowno, c.tree, c.lvl + 1, c.pos // 3,
  sha256(string_agg(CASE WHEN n.pos = c.pos THEN c.h ELSE n.h END, '' ORDER BY n.pos)),
  c.proof || coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (n.pos <> c.pos), '')
  FROM {name} c JOIN {nodes} n ON n.tree = c.tree AND n.lvl = c.lvl AND n.pos // 3 = c.pos // 3
  JOIN (SELECT tree, max(lvl) AS top FROM {nodes} GROUP BY tree) m ON m.tree = c.tree AND c.lvl < m.top
  GROUP BY c.rowno, c.tree, c.lvl, c.pos, c.h, c.proof)"""


MERKLE = f"""WITH RECURSIVE {CRC_TABLE},
given AS (SELECT doc_id, source, {_row("text")} AS leaf, {_row("changed")} AS changed
  FROM (SELECT *, {CHANGED} AS changed FROM documents, crc)),
rows AS (SELECT *, coalesce('=' || source, '') AS tree, row_number() OVER () AS rowno,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM given),
{_grown("nodes", "SELECT tree, 0 AS lvl, pos, leaf AS h FROM rows")},
subroots AS (SELECT tree, arg_max(h, lvl) AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos FROM nodes GROUP BY tree),
{_grown("outer_nodes", "SELECT '' AS tree, 0 AS lvl, pos, subroot AS h FROM subroots")},
roots AS (SELECT arg_max(h, lvl) AS root FROM outer_nodes),
{_climbed("inside", "SELECT rowno, tree, 0 AS lvl, pos, changed AS h, '' AS proof FROM rows", "nodes")},
at_top AS (SELECT rowno, arg_max(h, lvl) AS h, arg_max(proof, lvl) AS proof, any_value(tree) AS tree FROM inside GROUP BY rowno),
{_climbed("outside", "SELECT rowno, '' AS tree, 0 AS lvl, s.pos, h, proof FROM at_top JOIN subroots s USING (tree)", "outer_nodes")},
ended AS (SELECT rowno, arg_max(h, lvl) AS folded_root, arg_max(proof, lvl) AS proof FROM outside GROUP BY rowno)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified
FROM rows JOIN subroots USING (tree) JOIN ended USING (rowno), roots"""

LETTERS = "[A-Za-zÀ-ÿ]+"
# near words meet on a word or on a word less one letter, with the letter's place
SPELLING = f"""WITH RECURSIVE {CRC_TABLE},
raw AS (SELECT doc_id, unnest(regexp_extract_all(text, '{LETTERS}')) AS run FROM documents),
lower AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
  FROM raw GROUP BY ALL),
hashed AS (SELECT *, {crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run", 't')} AS h FROM lower, crc),
cut AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) + 2 AS BIGINT))
  ELSE run END AS word, k FROM hashed),
words AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
less AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (SELECT a.word, b.word AS other, b.n AS m FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, min(struct_pack(m := -m, form := other)) AS o FROM near GROUP BY word),
forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -o.m >= 2 * n THEN o.form END AS form,
  CASE WHEN -o.m >= 2 * n THEN -o.m END AS form_n FROM words LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS held, 0 AS step FROM forms
  UNION ALL SELECT w.word, f.form, step + 1 FROM walk w JOIN forms f ON f.word = w.held WHERE f.form IS NOT NULL),
ended AS (SELECT word, arg_max(held, step) AS root FROM walk GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ended USING (word)"""
