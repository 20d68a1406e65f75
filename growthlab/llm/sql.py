"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _level(path: list[str], source: str, weights: str) -> str:
    """Budgets of one level's children: full where their room is smallest for their weight."""
    keys, parent = ", ".join(path), ", ".join(path[:-1])
    part = f"PARTITION BY {parent}" if parent else ""
    name = " || '/' || ".join(path)
    return f"""
    (WITH child AS (
        SELECT {keys}, sum(capacity)::BIGINT AS room, max(budget)::BIGINT AS given,
               coalesce(any_value(CASE {name} {weights} END), 1) AS weight
        FROM {source} GROUP BY {keys}),
     ranked AS (
        SELECT *, coalesce(sum(room) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier,
               sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS heavier
        FROM child WINDOW w AS ({part} ORDER BY room / nullif(weight, 0) ASC NULLS LAST, {keys})),
     rated AS (SELECT *, max((given - earlier)::DOUBLE / nullif(heavier, 0)) OVER ({part}) AS rate FROM ranked)
     SELECT s.* REPLACE (coalesce(least(room, floor(weight * rate)), 0)::BIGINT AS budget)
     FROM {source} s JOIN rated USING ({keys}))"""


def source_mix(weights: dict[str, int], web: list[str], forum: list[str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.items())
    names = lambda x: ", ".join(f"'{s}'" for s in x)
    return f"""
WITH d AS (
    SELECT doc_id, coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source,
           CASE WHEN source IN ({names(web)}) THEN 'web' WHEN source IN ({names(forum)}) THEN 'forum'
                WHEN source IS NOT NULL THEN 'books' ELSE 'unknown' END AS domain,
           len({_WORDS})::BIGINT AS n_tokens
    FROM documents),
counted AS (SELECT * FROM d WHERE n_tokens > 0),
leaf AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS supply FROM counted GROUP BY ALL),
l0 AS (SELECT *, supply * 2 AS capacity,
              least((sum(supply) OVER ())::BIGINT * 80 // 100, (sum(supply * 2) OVER ())::BIGINT) AS budget FROM leaf),
l1 AS {_level(["domain"], "l0", whens)},
l2 AS {_level(["domain", "lang"], "l1", whens)},
l3 AS {_level(["domain", "lang", "source"], "l2", whens)},
passes AS (
    SELECT c.*, l3.budget, l3.supply, unnest(range(0, l3.budget // l3.supply + 1))::BIGINT AS epoch
    FROM counted c JOIN l3 USING (domain, lang, source)),
placed AS (
    SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source, epoch
                                  ORDER BY md5('7:' || epoch || ':' || doc_id), doc_id, n_tokens
                                  ROWS UNBOUNDED PRECEDING) AS running
    FROM passes)
SELECT doc_id, epoch, domain, lang, source, n_tokens, budget FROM placed
WHERE epoch < budget // supply OR (budget % supply > 0 AND running <= budget % supply)"""


_SUBSTRINGS = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20),
windows AS (SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS s FROM starts),
again AS (
    SELECT doc_id, i FROM (
        SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM windows)
    WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM again, range(0, 20) r(k)),
lists AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
words AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
    SELECT words.doc_id, string_agg(w[p], ' ' ORDER BY p) AS text
    FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY words.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN lists USING (doc_id) LEFT JOIN kept USING (doc_id)"""

_NEAR = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
        ELSE [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] END) AS s FROM w),
items AS (SELECT doc_id, unnest(s) AS x FROM sets),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id
    GROUP BY ALL),
links AS (
    SELECT a, b FROM common JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
    WHERE 100 * n >= 80 * (len(x.s) + len(y.s) - n)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON l.a = r.b),
least AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, c AS component_id, doc_id = c AS kept
FROM sets JOIN least ON least.a = doc_id"""

_PREFERENCES = """
WITH t AS (SELECT conv_id >> 1 AS pair_id, conv_id & 1 AS odd, conv_id, turn, role, text FROM conversations),
cut AS (
    SELECT coalesce(c.pair_id, r.pair_id) AS pair_id, min(coalesce(c.turn, r.turn)) AS cut
    FROM (SELECT * FROM t WHERE odd = 0) c FULL JOIN (SELECT * FROM t WHERE odd = 1) r
      ON c.pair_id = r.pair_id AND c.turn = r.turn
    WHERE c.role IS DISTINCT FROM r.role OR c.text IS DISTINCT FROM r.text GROUP BY 1),
parts AS (
    SELECT t.*, CASE WHEN cut IS NULL OR turn < cut THEN 'prompt' WHEN odd = 0 THEN 'chosen' ELSE 'rejected' END AS part
    FROM t LEFT JOIN cut USING (pair_id)),
pieces AS (
    SELECT *, '<|im_start|>' || role || chr(10) AS head,
           '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS piece
    FROM parts WHERE part <> 'prompt' OR odd = 0),
placed AS (
    SELECT *, coalesce(sum(length(piece)) OVER (PARTITION BY pair_id, part ORDER BY turn
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
    FROM pieces),
spans AS (
    SELECT *, CASE WHEN part <> 'prompt' AND role = 'assistant'
                   THEN (before + length(head)) || ':' || (before + length(piece) - 1) END AS span
    FROM placed)
SELECT pair_id,
       max(conv_id) FILTER (odd = 0) AS chosen_id,
       any_value(other) AS rejected_id,
       coalesce(string_agg(piece, '' ORDER BY turn) FILTER (part = 'prompt'), '') AS prompt,
       count(*) FILTER (part = 'prompt') AS prompt_turns,
       coalesce(string_agg(piece, '' ORDER BY turn) FILTER (part = 'chosen'), '') AS chosen,
       coalesce(string_agg(piece, '' ORDER BY turn) FILTER (part = 'rejected'), '') AS rejected,
       coalesce(string_agg(span, ',' ORDER BY turn) FILTER (part = 'chosen'), '') AS chosen_train,
       coalesce(string_agg(span, ',' ORDER BY turn) FILTER (part = 'rejected'), '') AS rejected_train
FROM spans LEFT JOIN (SELECT pair_id, max(conv_id) AS other FROM t WHERE odd = 1 GROUP BY 1) USING (pair_id)
GROUP BY pair_id"""



def _crc32(text: str) -> str:
    """Unsigned crc32 of an ASCII text: eight shifts for each of its characters."""
    shift = "lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    one = f"lambda a, ch: list_reduce(list_prepend(xor(a, ch), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), {shift})"
    codes = f"list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), {one}), 4294967295::BIGINT)"


def _way(letter: str, cost: str, rest: str, line: str = "''") -> str:
    return f"{{c: {cost} + {rest}.c, e: '{letter}' || {rest}.e, t: {line} || {rest}.t}}"


def _repair() -> str:
    """Costs, edits and texts of the best repair of the rest, row by row from the last, for four states."""
    said = {2: "'user:'", 3: "'assistant:'"}
    spoken = (2, 2, 3, 2)
    kept = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
    best = []
    for s in range(4):
        to = spoken[s]
        options = [f"CASE WHEN NOT gone THEN {_way('R', '2 + extra', f'f{to}', f'{said[to]} || text || chr(10)')} END"]
        for initial, then in kept[s].items():
            keep = _way("K", "extra", f"f{then}", "role || ':' || text || chr(10)")
            options.append(f"CASE WHEN NOT gone AND left(role, 1) = '{initial}' THEN {keep} END")
        options.append(_way("D", "3", f"f{s}"))
        best.append(f"list_min(list_filter([{', '.join(options)}], lambda x: x IS NOT NULL)) AS g{s}")
    added = []
    for s in range(4):
        to, ways, rest = spoken[s], [f"g{s}"], ""
        ways.append(_way("I", "2", f"g{to}", f"{said[to]} || chr(10)"))
        more = spoken[to]
        ways.append(
            f"{{c: 4 + g{more}.c, e: 'II' || g{more}.e, t: {said[to]} || chr(10) || {said[more]} || chr(10) || g{more}.t}}"
        )
        added.append(f"list_min([{', '.join(ways)}]) AS f{s}")
    none = "{c: %d, e: '%s', t: %s}"
    ends = ", ".join(
        none % x + f" AS f{s}"
        for s, x in enumerate(
            [(0, "", "''"), (4, "II", "'user:' || chr(10) || 'assistant:' || chr(10)"), (2, "I", "'assistant:' || chr(10)"), (0, "", "''")]
        )
    )
    return rf"""
WITH RECURSIVE d AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS fate
    FROM conversations),
damaged AS (
    SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
           CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE WHEN fate = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM d WHERE fate <> 0),
r AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
           lead(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS next_role,
           count(*) OVER (PARTITION BY conv_id) AS n,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS copied,
           right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last
    FROM damaged),
m AS (
    SELECT *, CASE WHEN last = '' THEN 'blank' WHEN copied THEN 'duplicate'
                   WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault FROM r),
k AS (SELECT *, fault IN ('blank', 'duplicate') AS gone, (fault = 'truncated')::INT AS extra FROM m),
walk AS (
    SELECT conv_id, n + 1 AS i, {ends} FROM k WHERE i = n
    UNION ALL
    SELECT conv_id, i, {", ".join(added)} FROM (
        SELECT k.conv_id, k.i, {", ".join(best)}
        FROM walk w JOIN k ON k.conv_id IS NOT DISTINCT FROM w.conv_id AND k.i = w.i - 1)),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (next_role IS NOT NULL AND left(role, 1) || left(next_role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
    FROM k GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(f0.c, 0)::BIGINT AS cost,
       coalesce(f0.e, '') AS audit, sha256(coalesce(left(f0.t, length(f0.t) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN (SELECT * FROM walk WHERE i = 1) w ON w.conv_id IS NOT DISTINCT FROM o.conv_id"""


_SYMBOLS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
_BASE32 = " || ".join(
    f"{_SYMBOLS}[(('0x' || hex[{5 * k + 1} : {5 * k + 5}])::BIGINT >> {shift} & 31) + 1]"
    for k in range(8)
    for shift in (15, 10, 5, 0)
)
_PAGES = f"""
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
q AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS least FROM p)
SELECT page_id, strlen(html) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> least THEN least END AS refers_to
FROM q"""

_TRIE = rf"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
x AS (SELECT conv_id, turn, md5(length(role) || ':' || role || text) AS k, len({_WORDS}) AS w FROM t),
own AS (
    SELECT conv_id, list({{k: k, w: w}} ORDER BY turn NULLS FIRST, k, w) AS turns,
           {_crc32("conv_id::VARCHAR")} % 4 AS h FROM x GROUP BY conv_id),
built AS (
    SELECT o.conv_id, list_concat(coalesce(b.turns, [])[1 : o.h], o.turns[o.h + 1 :]) AS turns
    FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
pre AS (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM built),
p AS (
    SELECT conv_id, d, d = len(turns) AS ends, array_to_string([y.k FOR y IN turns[1 : d]], '') AS key,
           CASE WHEN d > 0 THEN turns[d].w ELSE 0 END AS w FROM pre),
nodes AS (
    SELECT d, key, min(conv_id) AS conv_id, count(*) AS n, any_value(w) AS w,
           coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ends
    FROM p GROUP BY d, key),
kids AS (SELECT d - 1 AS d, left(key, 32 * (d - 1)) AS key, count(*) AS kids FROM nodes WHERE d > 0 GROUP BY ALL),
grown AS (SELECT nodes.*, coalesce(kids, 0) AS kids FROM nodes LEFT JOIN kids USING (d, key)),
up AS (SELECT unnest(range(0, d + 1)) AS e, key, kids, (n - 1) * w AS saved FROM grown),
sub AS (
    SELECT e AS d, left(key, 32 * e) AS key, count(*) FILTER (kids = 0) AS leaves, sum(saved)::BIGINT AS saved
    FROM up GROUP BY ALL)
SELECT g.conv_id, g.d AS depth, parent.conv_id AS parent_conv_id, g.n AS n_convs, g.kids AS n_children,
       leaves AS n_leaves, saved AS saved_tokens, sha256(g.ends) AS ends_sha256
FROM grown g JOIN sub USING (d, key)
LEFT JOIN grown parent ON parent.d = g.d - 1 AND parent.key = left(g.key, 32 * (g.d - 1))"""

ALL: dict[str, str] = {
    "op4_near_duplicates": _NEAR,
    "op8_substring_dedup": _SUBSTRINGS,
    "op10_preference_pairs": _PREFERENCES,
    "op11_conversation_repair": _repair(),
    "op12_warc_records": _PAGES,
    "op13_prefix_trie": _TRIE,
}
