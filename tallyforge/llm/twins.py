"""SQL twins of the operators that SQL can express on small tables: links by all common shingles or pairs, spans by marked matches, repairs by recursion over rows, trees level by level."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_FOLDED = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"
_SPACE_WORDS = rf"list_filter(string_split_regex({_FOLDED}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_ITEM_WORDS = rf"regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _reach(nodes: str, links: str) -> str:
    """The least node that each node reaches; links hold both directions."""
    return f"SELECT a, min(b) c FROM (WITH RECURSIVE r(a, b) AS (SELECT id, id FROM {nodes} UNION SELECT r.a, l.b FROM r JOIN {links} l ON l.a = r.b) SELECT * FROM r) GROUP BY a"


DECONTAMINATE = f"""
WITH i AS (SELECT CAST(item_id AS VARCHAR) item, {_ITEM_WORDS} w FROM benchmark), v AS (SELECT DISTINCT item, least(13, len(w)) n, array_to_string(w[k:k + least(13, len(w)) - 1], ' ') t FROM (SELECT item, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) k FROM i WHERE len(w) > 0)),
 d AS (SELECT doc_id, {_ITEM_WORDS} w FROM documents), g AS (SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') t FROM (SELECT doc_id, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) k FROM d, (SELECT DISTINCT n FROM v) WHERE len(w) >= n)),
 h AS (SELECT doc_id, g.n, k, item FROM g JOIN v USING (n, t)), p AS (SELECT doc_id, count(DISTINCT q) n_hit FROM (SELECT doc_id, unnest(range(k, CAST(k + n AS BIGINT))) q FROM (SELECT DISTINCT doc_id, k, n FROM h)) GROUP BY 1),
 m AS (SELECT doc_id, count(*) n_items, string_agg(item, ',' ORDER BY item) l FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items, sha256(coalesce(l, '')) items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated FROM d LEFT JOIN p USING (doc_id) LEFT JOIN m USING (doc_id)"""

EMBEDDINGS = f"""
WITH v AS (SELECT vec_id id, label, CAST(embedding AS DOUBLE[]) e FROM embeddings), s AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
 l AS (SELECT a.id a, b.id b FROM s a JOIN s b ON a.label = b.label AND len(a.e) = len(b.e) AND a.id <> b.id WHERE list_cosine_similarity(a.e, b.e) >= 0.98), n AS (SELECT a, count(*) n FROM l GROUP BY 1), c AS ({_reach('v', 'l')})
SELECT id vec_id, coalesce(n, 0) n_links, c component_id, id = c AS kept FROM v LEFT JOIN n ON n.a = id JOIN c ON c.a = id"""

JACCARD = f"""
WITH d AS (SELECT doc_id id, {_SPACE_WORDS} w FROM documents), s AS (SELECT id, list_distinct(list_transform(range(1, CAST(greatest(len(w) - 4, 0) + 2 AS BIGINT)), lambda k: array_to_string(w[k:k + 3], ' '))) s FROM d WHERE len(w) > 0),
 e AS (SELECT id, len(s) n, unnest(s) x FROM s), l AS (SELECT a.id a, b.id b FROM e a JOIN e b ON a.x = b.x AND a.id <> b.id GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))), c AS ({_reach('d', 'l')})
SELECT d.id doc_id, CAST(coalesce(len(s), 0) AS BIGINT) n_shingles, c component_id FROM d LEFT JOIN s ON s.id = d.id JOIN c ON c.a = d.id"""

#: The kinds in order: their patterns, the group that counts, and its least length.
_KINDS = (
    ("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"'']?\x20*[:=]\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", 2, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24),
    ("github", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 0), ("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0), ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}(\.[A-Za-z0-9_-]+)?", 0, 0), ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
)
_MARKED = " UNION ALL ".join(rf"SELECT doc_id, {k} o, '{n}' kind, string_split(regexp_replace(coalesce(text, ''), '{p}', chr(57345) || '\0' || chr(57346), 'g'), chr(57345)) m FROM documents" for k, (n, p, _, _) in enumerate(_KINDS))
_LONG = " OR ".join(f"(kind = '{n}' AND length(regexp_extract(t, '{p}', {g})) >= {least})" for n, p, g, least in _KINDS)
SECRETS = f"""
WITH a AS ({_MARKED}), b AS (SELECT doc_id, o, kind, unnest(m[2:]) x, unnest(range(2, CAST(len(m) + 1 AS BIGINT))) k, m FROM a), c AS (SELECT doc_id, o, kind, split_part(x, chr(57346), 1) t, length(array_to_string(m[1:k - 1], '')) - (k - 2) s FROM b),
 f AS (SELECT doc_id, o, kind, s, s + length(t) e FROM c WHERE {_LONG}), g AS (SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') n_assign, count(*) FILTER (WHERE kind = 'access') n_access, count(*) FILTER (WHERE kind = 'hex') n_hex,
  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) FILTER (WHERE o < 3) base, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) every FROM f GROUP BY 1)
SELECT doc_id, coalesce(n_assign, 0) n_assign, coalesce(n_access, 0) n_access, coalesce(n_hex, 0) n_hex, sha256(coalesce(base, '')) base_sha256, coalesce(every, '') spans FROM documents LEFT JOIN g USING (doc_id)"""


def _crc32(text: str) -> str:
    """Unsigned crc32 of a short ASCII string, bit by bit."""
    return f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({text}) + 1), lambda i: ascii(({text})[i])::BIGINT)), lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"


def _add(item: str, cost: str, letter: str) -> str:
    """An item, nine digits of cost and the audit, with a letter more."""
    return f"(lpad(CAST(CAST({item}[:9] AS BIGINT) + {cost} AS VARCHAR), 9, '0') || {item}[10:] || '{letter}')"


def _put(item: str, initial: str) -> str:
    return f"(CASE WHEN fault < 2 THEN CASE WHEN role[:1] = '{initial}' THEN {_add(item, 'fault', 'K')} ELSE {_add(item, 'fault + 2', 'R')} END END)"


_PLACE = "PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(strlen(role) || ':' || role || text)"
_CLOSED = f"SELECT *, least(a0, {_add('u', '2', 'I')}) a FROM (SELECT * EXCLUDE (u, a), a a0, least(u, {_add('n', '2', 'I')}, {_add('s', '2', 'I')}, {_add('a', '2', 'I')}) u FROM {{0}})"
REPAIR = rf"""
WITH RECURSIVE f AS (SELECT conv_id, turn, coalesce(role, ' ') r, coalesce(text, ' ') t, {_crc32("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 fate FROM conversations),
 d AS (SELECT conv_id, turn, CASE fate WHEN 4 THEN 'user' ELSE r END AS role, CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(t, '.!?', '') ELSE t END AS text, unnest(range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM f),
 o AS (SELECT conv_id, turn, role, text, row_number() OVER ({_PLACE}) i, lag(role[:1]) OVER ({_PLACE}) before FROM d),
 g AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 3 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2 WHEN regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 0 ELSE 1 END fault FROM o),
 p AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT) i, '000000000' n, CAST(NULL AS VARCHAR) s, CAST(NULL AS VARCHAR) u, CAST(NULL AS VARCHAR) a FROM conversations UNION ALL
  SELECT conv_id, i, {_add('n', '3', 'D')}, least({_add('s', '3', 'D')}, CASE WHEN fault < 2 AND role[:1] = 's' THEN {_add('n', 'fault', 'K')} END), least({_add('u', '3', 'D')}, {_put('n', 'u')}, {_put('s', 'u')}, {_put('a', 'u')}), least({_add('a', '3', 'D')}, {_put('u', 'a')})
  FROM ({_CLOSED.format('(SELECT g.*, n, s, u, a FROM p JOIN g ON g.conv_id IS NOT DISTINCT FROM p.conv_id AND g.i = p.i + 1)')})),
 e AS (SELECT conv_id, i, least(n, a) best FROM ({_CLOSED.format('(SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1)')})),
 l AS (SELECT conv_id, best[10:] w, unnest(range(1, CAST(length(best) - 8 AS BIGINT))) k FROM e), m AS (SELECT conv_id, k, w[k] c, length(regexp_replace(w[:k], 'I', '', 'g')) i, length(regexp_replace(w[:k], 'D', '', 'g')) q FROM l),
 x AS (SELECT m.conv_id, c, q, role, text, max(CASE WHEN q = 1 AND c = 'K' AND role[:1] = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY m.conv_id) z FROM m LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM m.conv_id AND g.i = m.i WHERE c <> 'D'),
 y AS (SELECT conv_id, string_agg(CASE WHEN c = 'K' THEN role WHEN (q - z) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN c = 'I' THEN '' ELSE text END, chr(10) ORDER BY q) t FROM x GROUP BY 1),
 h AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) gaps, count(*) FILTER (WHERE fault = 3) b, count(*) FILTER (WHERE fault = 2) d, count(*) FILTER (WHERE fault = 1) t, count(*) FILTER (WHERE i > 1 AND before || role[:1] NOT IN ('su', 'ua', 'au')) l FROM g GROUP BY 1)
SELECT e.conv_id, coalesce(gaps, 0) gaps, coalesce(b, 0) AS blank, coalesce(d, 0) duplicate, coalesce(h.t, 0) truncated, coalesce(h.l, 0) illegal, CAST(best[:9] AS BIGINT) AS cost, best[10:] AS audit, sha256(coalesce(y.t, '')) repaired_sha256
FROM e LEFT JOIN h ON h.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN y ON y.conv_id IS NOT DISTINCT FROM e.conv_id"""


def _framed(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR) END"


def _leaf(text: str) -> str:
    return f"sha256(concat({', '.join(map(_framed, ('doc_id', 'source', 'lang', 'n_chars', text)))}))"


def _climb(name: str, levels: int) -> str:
    """From {name}0 (t: tree, i: place from 0, n: nodes, h), a level above another, where single nodes stay; {name}p: the joined siblings of each level's nodes."""
    out = []
    for k in range(levels):
        out.append(f"{name}{k + 1} AS (SELECT t, i // 8 i, (any_value(n) + 7) // 8 n, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END h FROM {name}{k} GROUP BY t, i // 8)")
    sides = [
        f"SELECT {k} lv, t, i, coalesce(string_agg(h, '' ORDER BY i) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') a, coalesce(string_agg(h, '' ORDER BY i) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') b, n > 1 AS up FROM {name}{k} WINDOW w AS (PARTITION BY t, i // 8 ORDER BY i)"
        for k in range(levels)
    ]
    return ", ".join([*out, f"{name}p AS ({' UNION ALL '.join(sides)})"])


_TIERS, _TOPS = 7, 3  # 8^7 documents of a language, 8^3 languages
_PROOF = [(f"x{k}", f"x{k}.lv = {k} AND x{k}.t IS NOT DISTINCT FROM l.t AND x{k}.i = l.i // {8**k}", "lp") for k in range(_TIERS)] + [(f"y{k}", f"y{k}.lv = {k} AND y{k}.i = r.i // {8**k}", "rp") for k in range(_TOPS)]


def _fold(start: str) -> str:
    """A subquery for each level would name the one below many times: the levels are reduced over a list of [left, right, raised] instead."""
    steps = ", ".join(f"[{x}.a, {x}.b, CAST({x}.up AS VARCHAR)]" for x, _, _ in _PROOF)
    return f"list_reduce([[{start}, '', ''], {steps}], lambda c, s: CASE WHEN s[3] = 'true' THEN [sha256(s[1] || c[1] || s[2]), '', ''] ELSE c END)[1]"


MERKLE = f"""
WITH v AS (SELECT doc_id, lang t, {_leaf('text')} h, CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN {_leaf(f"translate(text, '{_UPPER}', '{_UPPER.lower()}')")} END bad FROM documents),
 l0 AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, h) - 1 i, count(*) OVER (PARTITION BY t) n FROM v), {_climb('l', _TIERS)},
 r0 AS (SELECT t lang, 0 t, row_number() OVER (ORDER BY encode(t) NULLS FIRST) - 1 i, count(*) OVER () n, h FROM l{_TIERS}), {_climb('r', _TOPS)}, z AS (SELECT h AS root FROM r{_TOPS}),
 q AS (SELECT doc_id, l.h leaf, r.h subroot, root, concat({', '.join(f'{x}.a, {x}.b' for x, _, _ in _PROOF)}) proof, {_fold('coalesce(l.bad, l.h)')} folded_root
  FROM l0 l JOIN r0 r ON r.lang IS NOT DISTINCT FROM l.t {' '.join(f'JOIN {t} {x} ON {on}' for x, on, t in _PROOF)}, z)
SELECT doc_id, leaf, subroot, root, sha256(proof) proof_sha256, folded_root, folded_root = root AS verified FROM q"""


def _escaped(text: str) -> str:
    out = rf"replace({text}, '\', '\\')"
    for c in ("<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"):
        out = rf"replace({out}, '{c}', '{c[0]}\{c[1:]}')"
    return out


#: Marks are 12, 10 and 11 letters long, the last with its line end.
CHAT = rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') r, coalesce(text, '') t FROM conversations UNION ALL SELECT -1, x, ['user', 'assistant'][x], '</s>[INST] ok [/INST]' FROM range(1, 3) y(x)),
 g AS (SELECT conv_id, count(*) n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, r, t)) turns_sha256, coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, r, t) FILTER (WHERE r = 'assistant'), '') loss, sum(33 + length({_escaped('r')}) + length({_escaped('t')})) n FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, CAST(length(loss) AS BIGINT) loss_chars, sha256(loss) loss_sha256, CAST(n AS BIGINT) formatted_chars, CASE conv_id WHEN -1 THEN 'prompt_completion' ELSE 'messages' END layout FROM g"""
