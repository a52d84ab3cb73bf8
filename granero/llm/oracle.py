"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations


def _escaped(text: str) -> str:
    doubled = f"replace({text}, '\\', '\\\\')"
    angles = rf"regexp_replace({doubled}, '<(\||/?s>)', '\\l\1', 'g')"
    return rf"regexp_replace({angles}, '\[(/?INST\])', '\\b\1', 'g')"


OP1 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), told AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS every,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
         sum(length('<|start|>') + length({_escaped("role")}) + 1 + length({_escaped("text")}) + length('<|end|>') + 1) AS chars
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(every) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
       chars::BIGINT AS formatted_chars
FROM told
"""

#: Rows of ``documents`` after line dedup, from a table ``source`` with doc_id and text.
LINE_DEDUP = r"""
split AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS l FROM {source}),
places AS (SELECT doc_id, l, unnest(range(0, greatest(len(l) - 3, 0) + 1)) AS s FROM split),
texts AS (SELECT doc_id, s, len(l) AS n, array_to_string(l[s + 1 : s + 3], chr(10)) AS t FROM places),
ranked AS (
  SELECT doc_id, s, n, row_number() OVER (PARTITION BY t ORDER BY doc_id, s) AS nth FROM texts WHERE regexp_matches(t, '\S')
),
covered AS (SELECT DISTINCT doc_id, unnest(range(s, least(s + 3, n))) AS p FROM ranked WHERE nth > 1),
each_line AS (SELECT doc_id, unnest(l) AS line, unnest(range(0, len(l))) AS p FROM split),
kept AS (
  SELECT e.doc_id, string_agg(e.line, chr(10) ORDER BY e.p) AS text, count(*) AS n
  FROM each_line e ANTI JOIN covered c ON e.doc_id = c.doc_id AND e.p = c.p GROUP BY e.doc_id
),
deduped AS (
  SELECT s.doc_id, CASE WHEN s.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
         CASE WHEN s.text IS NULL THEN 0 ELSE len(s.l) END::BIGINT AS n_lines,
         (CASE WHEN s.text IS NULL THEN 0 ELSE len(s.l) - coalesce(k.n, 0) END)::BIGINT AS n_removed
  FROM split s LEFT JOIN kept k ON s.doc_id = k.doc_id
)
"""

OP6 = "WITH " + LINE_DEDUP.format(source="documents") + "SELECT doc_id, text, n_lines, n_removed FROM deduped"

OP9 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: Contamination of a table ``source`` with doc_id and text: report(doc_id, n_words, n_hit, ids).
CONTAMINATION = f"""
item_words AS (SELECT item_id, {_ALNUM.format(_FOLD.format("text"))} AS w FROM benchmark WHERE text IS NOT NULL),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[s + 1 : s + least(len(w), 13)], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(0, len(w) - least(len(w), 13) + 1)) AS s FROM item_words WHERE len(w) > 0)
),
doc_words AS (SELECT doc_id, {_ALNUM.format(_FOLD.format("coalesce(text, '')"))} AS w FROM {{source}}),
doc_windows AS (
  SELECT doc_id, n, s, array_to_string(w[s + 1 : s + n], ' ') AS t
  FROM (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS s
        FROM doc_words, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)
),
hits AS (SELECT d.doc_id, d.s, d.n, i.item_id FROM doc_windows d JOIN item_windows i ON d.n = i.n AND d.t = i.t),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id
),
report AS (
  SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit,
         coalesce(i.n_items, 0)::BIGINT AS n_items, sha256(coalesce(i.ids, '')) AS items_sha256,
         coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
  FROM doc_words d LEFT JOIN hit_words h ON d.doc_id = h.doc_id LEFT JOIN hit_items i ON d.doc_id = i.doc_id
)
"""

OP7 = "WITH " + CONTAMINATION.format(source="documents") + "SELECT * FROM report"

#: Groups of a table ``source`` with doc_id and text by shingles of ``k`` words and a least similarity ``percent``:
#: grouped(doc_id, n_shingles, component_id).
NEAR_DUPLICATES = f"""
blank_words AS (
  SELECT doc_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM {{source}}
),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[s + 1 : s + {{k}}], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - {{k}}, 0) + 1)) AS s FROM blank_words WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= {{percent}} * (x.n + y.n - c)
),
reach(doc_id, root) AS (
  SELECT doc_id, doc_id FROM sizes UNION SELECT l.b, r.root FROM reach r JOIN links l ON r.doc_id = l.a
),
grouped AS (
  SELECT b.doc_id, coalesce(any_value(s.n), 0)::BIGINT AS n_shingles, coalesce(min(r.root), b.doc_id) AS component_id
  FROM blank_words b LEFT JOIN sizes s ON s.doc_id = b.doc_id LEFT JOIN reach r ON r.doc_id = b.doc_id GROUP BY b.doc_id
)
"""

OP2 = "WITH RECURSIVE " + NEAR_DUPLICATES.format(source="documents", k=5, percent=75) + "SELECT * FROM grouped"
OP11 = "WITH RECURSIVE " + NEAR_DUPLICATES.format(source="documents", k=4, percent=80)
OP11 += "SELECT *, doc_id IS NOT DISTINCT FROM component_id AS kept FROM grouped"

def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text; needs the table ``crc``."""
    return (
        f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)),"
        " lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)"
    )


_CRC_TABLE = """
crc_steps(n, c, k) AS (
  SELECT n, n, 0 FROM range(256) r(n) UNION ALL
  SELECT n, CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END, k + 1 FROM crc_steps WHERE k < 8
),
crc AS (SELECT list(c ORDER BY n) AS t FROM crc_steps WHERE k = 8)
"""


def _leaf(n_chars: str) -> str:
    shown = [
        f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", n_chars, "text")
    ]
    return f"sha256({' || '.join(shown)})"


_PARENTS = "list_transform(range(0, len(h), 2), lambda i: sha256(h[i + 1] || coalesce(h[i + 2], '')))"

OP12 = f"""
WITH RECURSIVE {_CRC_TABLE},
leaves AS (
  SELECT doc_id, lang, {_leaf("n_chars")} AS leaf,
         CASE WHEN coalesce({_crc32("doc_id::VARCHAR")} % 7 = 0, FALSE) THEN {_leaf("(n_chars + 1)")} ELSE {_leaf("n_chars")} END AS shown,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
  FROM documents, crc
),
levels(lang, k, h) AS (
  SELECT lang, 0, list(leaf ORDER BY i) FROM leaves GROUP BY lang UNION ALL
  SELECT lang, k + 1, {_PARENTS} FROM levels WHERE len(h) > 1
),
subroots AS (
  SELECT lang, h[1] AS subroot, k AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS r FROM levels WHERE len(h) = 1
),
tops(k, h) AS (
  SELECT 0, list(subroot ORDER BY r) FROM subroots UNION ALL SELECT k + 1, {_PARENTS} FROM tops WHERE len(h) > 1
),
siblings AS (
  SELECT l.doc_id, l.leaf, l.i, l.lang, 0 AS part, v.k, (l.i >> v.k) & 1 AS is_right, v.h[xor(l.i >> v.k, 1) + 1] AS s
  FROM leaves l JOIN levels v ON l.lang IS NOT DISTINCT FROM v.lang AND len(v.h) > 1
  UNION ALL
  SELECT l.doc_id, l.leaf, l.i, l.lang, 1, v.k, (b.r >> v.k) & 1, v.h[xor(b.r >> v.k, 1) + 1]
  FROM leaves l JOIN subroots b ON l.lang IS NOT DISTINCT FROM b.lang JOIN tops v ON len(v.h) > 1
),
proofs AS (
  SELECT i, lang, list({{'r': is_right, 's': s}} ORDER BY part, k) AS p, coalesce(string_agg(s, '' ORDER BY part, k), '') AS told
  FROM siblings GROUP BY i, lang
),
folded(i, lang, p, z, d) AS (
  SELECT l.i, l.lang, coalesce(p.p, []), 1, l.shown FROM leaves l LEFT JOIN proofs p ON l.i = p.i AND l.lang IS NOT DISTINCT FROM p.lang
  UNION ALL
  SELECT i, lang, p, z + 1,
         sha256(CASE WHEN p[z].s IS NULL THEN d WHEN p[z].r = 1 THEN p[z].s || d ELSE d || p[z].s END)
  FROM folded WHERE z <= len(p)
)
SELECT l.doc_id, l.leaf, b.subroot, (SELECT h[1] FROM tops WHERE len(h) = 1) AS root, sha256(coalesce(p.told, '')) AS proof_sha256,
       f.d AS folded_root, f.d = (SELECT h[1] FROM tops WHERE len(h) = 1) AS verified
FROM leaves l JOIN subroots b ON l.lang IS NOT DISTINCT FROM b.lang
LEFT JOIN proofs p ON p.i = l.i AND p.lang IS NOT DISTINCT FROM l.lang
JOIN folded f ON f.i = l.i AND f.lang IS NOT DISTINCT FROM l.lang AND f.z = len(f.p) + 1
"""

def _least(*options: str) -> str:
    return f"list_min(list_filter([{', '.join(options)}], lambda o: o.c IS NOT NULL))"


def _step(cost: str, edit: str, rest: str) -> str:
    return f"{{'c': {cost} + {rest}.c, 'a': '{edit}' || {rest}.a}}"


def _edits(state: int, needed: int) -> str:
    """Cheapest way to deal with one row in a state, without insertions in front of it."""
    kept = {1: "CASE i WHEN 's' THEN 2 WHEN 'u' THEN 3 END", 3: "CASE i WHEN 'a' THEN 4 END"}.get(state, "CASE i WHEN 'u' THEN 3 END")
    stays = "CASE WHEN gone THEN NULL ELSE short END"
    return _least(_step("3", "D", f"v[{state}]"), _step(stays, "K", f"v[{kept}]"), _step(f"2 + {stays}", "R", f"v[{needed}]"))


_STATES = {1: 3, 2: 3, 3: 4, 4: 3}  # start, system, user, assistant: what each needs next
_BASE = ", ".join(_edits(state, needed) for state, needed in _STATES.items())
_INSERTED = ", ".join(
    _least(f"b[{state}]", _step("2", "I", f"b[{needed}]"), _step("4", "II", f"b[{_STATES[needed]}]")) for state, needed in _STATES.items()
)
_NEEDED = "CASE state WHEN 3 THEN 4 ELSE 3 END"
_MADE = "CASE state WHEN 3 THEN 'assistant' ELSE 'user' END"

OP13 = f"""
WITH RECURSIVE {_CRC_TABLE},
kinds AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS k
  FROM conversations, crc
),
damaged AS (
  SELECT conv_id, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role,
         CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE k WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM kinds WHERE k <> 0
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS p FROM damaged
),
faults AS (
  SELECT *, left(role, 1) AS i, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 AS again,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS ends_short,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY p) || left(role, 1) AS step
  FROM placed
),
signs AS (
  SELECT conv_id, p, role, text, turn, i, step, blank, again AND NOT blank AS duplicate,
         ends_short AND NOT again AND NOT blank AS truncated, blank OR again AS gone,
         CASE WHEN ends_short AND NOT again AND NOT blank THEN 1 ELSE 0 END AS short
  FROM faults
),
counts AS (
  SELECT conv_id, max(p) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
         count_if(duplicate) AS duplicate, count_if(truncated) AS truncated, count_if(step NOT IN ('su', 'ua', 'au')) AS illegal
  FROM signs GROUP BY conv_id
),
dp(conv_id, p, v) AS (
  SELECT conv_id, n + 1, [{{'c': 0, 'a': ''}}, {{'c': 4, 'a': 'II'}}, {{'c': 2, 'a': 'I'}}, {{'c': 0, 'a': ''}}] FROM counts
  UNION ALL
  SELECT conv_id, p, [{_INSERTED}] FROM (
    SELECT d.conv_id, s.p, [{_BASE}] AS b FROM dp d JOIN signs s ON s.conv_id IS NOT DISTINCT FROM d.conv_id AND s.p = d.p - 1
  )
),
found AS (SELECT conv_id, v[1].c AS cost, v[1].a AS audit FROM dp WHERE p = 1),
walk(conv_id, audit, z, p, state, line) AS (
  SELECT conv_id, audit, 0, 0, 1, NULL::VARCHAR FROM found
  UNION ALL
  SELECT conv_id, audit, z, p, CASE WHEN e = 'D' THEN state WHEN e = 'K' AND i = 's' THEN 2 ELSE {_NEEDED} END,
         CASE e WHEN 'D' THEN NULL WHEN 'K' THEN role || ':' || text WHEN 'R' THEN {_MADE} || ':' || text ELSE {_MADE} || ':' END
  FROM (
    SELECT w.conv_id, w.audit, w.z + 1 AS z, w.p + (w.audit[w.z + 1] <> 'I')::INT AS p, w.state, w.audit[w.z + 1] AS e, s.role, s.text, s.i
    FROM walk w LEFT JOIN signs s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.p = w.p + 1 WHERE w.z < length(w.audit)
  )
),
lines AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY z) AS told FROM walk GROUP BY conv_id)
SELECT e.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank, coalesce(c.duplicate, 0)::BIGINT AS duplicate,
       coalesce(c.truncated, 0)::BIGINT AS truncated, coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce(f.cost, 0)::BIGINT AS cost,
       coalesce(f.audit, '') AS audit, sha256(coalesce(l.told, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN found f ON f.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM e.conv_id
"""

ORACLE = {"op11_minhash_near_dedup": OP11, "op13_conversation_repair": OP13, "op12_merkle_manifest": OP12, "op2_ngram_jaccard_join": OP2, "op7_benchmark_decontamination": OP7, "op1_chat_formatting": OP1, "op6_line_dedup": OP6, "op9_topk_search": OP9}
