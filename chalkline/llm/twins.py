"""DuckDB twins of the queries that SQL can express."""

# Words are split at ASCII white space; NULL has none.
_SPACED = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BENCH = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP8 = rf"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item, {_BENCH} AS words FROM benchmark),
windows AS (
    SELECT DISTINCT item, len(part) AS n, array_to_string(part, ' ') AS pattern FROM (
        SELECT item, unnest([words[k:k + 9] FOR k IN range(1, greatest(len(words) - 9, 1) + 1)]) AS part
        FROM item WHERE len(words) > 0)),
doc AS (SELECT row_number() OVER () AS row_no, doc_id, {_BENCH} AS words FROM documents),
places AS (SELECT row_no, words, unnest(range(1, len(words) + 1)) AS pos FROM doc),
found AS (
    SELECT row_no, pos, windows.n, item FROM (
        SELECT row_no, pos, n, array_to_string(words[pos:pos + n - 1], ' ') AS pattern
        FROM places JOIN (SELECT DISTINCT n FROM windows) ON pos + n - 1 <= len(words)) AS run JOIN windows USING (pattern)),
hit AS (SELECT row_no, count(DISTINCT word) AS n_hit FROM (
    SELECT row_no, unnest(range(pos, pos + n)) AS word FROM found) GROUP BY row_no),
named AS (SELECT row_no, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT row_no, item FROM found WHERE item IS NOT NULL) GROUP BY row_no)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN hit USING (row_no) LEFT JOIN named USING (row_no)
"""


OP2 = r"""
WITH counted AS (
    SELECT source, lang, 'words-1' AS tokenizer, len(regexp_extract_all(CASE WHEN doc_id % 10 = 7
        THEN regexp_replace(coalesce(text, ''), '[0-9]+', '', 'g') ELSE coalesce(text, '') END, '[^\x20\x09-\x0D]+')) AS n
    FROM documents WHERE coalesce(doc_id % 10 <> 3, true)
    UNION ALL
    SELECT source, lang, 'words-2', len(regexp_extract_all(coalesce(text, ''), '[^\x09-\x0D\x20-\x2F\x3A-\x40]+'))
    FROM documents WHERE coalesce(doc_id % 10 <> 3, true))
SELECT source, lang, tokenizer, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens FROM counted GROUP BY ALL
"""

_COMPONENTS = r"""
WITH RECURSIVE split AS (
    SELECT row_number() OVER () AS row_no, doc_id,
        regexp_extract_all(LOWERED, '[^\x20\x09-\x0D]+') AS words
    FROM documents),
shingle AS (
    SELECT DISTINCT row_no, array_to_string(words[pos:pos + MORE], ' ') AS shingle FROM (
        SELECT row_no, words, unnest(range(1, greatest(len(words) - MORE, 1) + 1)) AS pos FROM split WHERE len(words) > 0)),
sized AS (SELECT row_no, count(*) AS n FROM shingle GROUP BY row_no),
common AS (
    SELECT x.row_no AS a, y.row_no AS b, count(*) AS n FROM shingle x JOIN shingle y USING (shingle)
    WHERE x.row_no <> y.row_no GROUP BY ALL),
link AS (
    SELECT a, b FROM common JOIN sized x ON x.row_no = a JOIN sized y ON y.row_no = b
    WHERE 100 * common.n >= 80 * (x.n + y.n - common.n)),
reach(a, b) AS (
    SELECT row_no, row_no FROM split
    UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b)
SELECT split.doc_id, coalesce(any_value(sized.n), 0) AS n_shingles, min(other.doc_id) AS component_id
FROM split LEFT JOIN sized USING (row_no) JOIN reach ON reach.a = split.row_no JOIN split AS other ON other.row_no = reach.b
GROUP BY split.row_no, split.doc_id
""".replace("LOWERED", _LOWERED)
OP5 = _COMPONENTS.replace("MORE", "4")
OP13 = f"SELECT *, doc_id IS NOT DISTINCT FROM component_id AS kept FROM ({_COMPONENTS.replace('MORE', '1')})"


def _quality_twin():
    from chalkline.llm.quality_rules import MAX_REPEAT_PERCENT, MIN_WORDS, SYMBOLS, THRESHOLDS
    from chalkline.llm.text_stats import STOP_WORDS

    stops = ", ".join(f"'{w}'" for w in sorted({w for words in STOP_WORDS.values() for w in words}))
    rules = []
    for _, numerator, denominator, least, most, from_words in THRESHOLDS:
        per = denominator or "1"
        bounds = [f"{numerator} {sign} {per} * {bound}" for sign, bound in ((">=", least), ("<=", most)) if bound is not None]
        rules.append(f"(n_words < {from_words} OR ({' AND '.join(bounds)}))")
    return rf"""
    WITH split AS (
        SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS body, {_SPACED} AS words,
            list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
        FROM documents),
    runs AS (SELECT row_no, pos, array_to_string(words[pos:pos + 4], ' ') AS run
        FROM (SELECT row_no, words, unnest(range(1, len(words) - 3)) AS pos FROM split WHERE len(words) >= 5)),
    again AS (SELECT row_no, unnest(ats) AS pos FROM (
        SELECT row_no, list(pos) AS ats FROM runs GROUP BY row_no, run HAVING count(*) > 1)),
    repeats AS (SELECT row_no, count(DISTINCT word) AS n FROM (
        SELECT row_no, unnest(range(pos, pos + 5)) AS word FROM again) GROUP BY row_no),
    counted AS (
        SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
            length(regexp_replace(body, '[^{SYMBOLS}]', '', 'g')) AS n_symbols,
            length(regexp_replace(body, '[^!]', '', 'g')) AS n_exclamations, len(lines) AS n_lines,
            len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
            len(list_filter(words, lambda w: lower(w) IN ({stops}))) AS n_stop_words
        FROM split LEFT JOIN repeats USING (row_no)),
    judged AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counted)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed AND {' AND '.join(rules)} AS kept, n_stop_words, n_lines, n_exclamations
    FROM judged
    """


def _repair_twin():
    def way(cost, letter, after, turn=None):
        turns = f"{after}.t" if turn is None else f"list_prepend({turn}, {after}.t)"
        return f"{{'c': {cost} + {after}.c, 'a': '{letter}' || {after}.a, 't': {turns}}}"

    def least(*ways):
        return f"list_sort([{', '.join(ways)}])[1]"

    def before(place, following, name, kept):
        """The cheapest way from a place at a row, without inserts before it."""
        ways, spoken = [way("3", "D", place)], "role || ':' || text"
        changed = way("(2 + cut)", "R", following, f"'{name}:' || text")
        keep = " ".join(f"WHEN '{initial}' THEN {way('cut', 'K', to, spoken)}" for initial, to in kept)
        free = least(*ways, changed, f"CASE init {keep} ELSE {changed} END")
        return f"CASE WHEN gone THEN {ways[0]} ELSE {free} END"

    def inserted(place, following, name):
        return least(place, way("2", "I", following, f"'{name}:'"))

    nothing, both = "CAST([] AS VARCHAR[])", "['user:', 'assistant:']"
    return rf"""
    WITH RECURSIVE crc AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(range(8),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c FROM range(256) AS r(i))),
    keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
    drawn AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_transform(string_split(key, ''), lambda x: CAST(ord(x) AS BIGINT)),
        lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]), 4294967295), 4294967295) % 20 AS draw FROM keyed, crc),
    damaged AS (SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role, CASE draw WHEN 1 THEN ''
            WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM drawn, (SELECT unnest([1, 2]) AS copy) WHERE draw <> 0 AND (copy = 1 OR draw = 3)),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM damaged),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS nth FROM placed),
    judged AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
            WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
        left(role, 1) AS init, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS prev FROM ranked),
    counted AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (prev || init NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id),
    ways AS (
        SELECT conv_id, n AS pos, {{'c': 0, 'a': '', 't': {nothing}}} AS e, {{'c': 4, 'a': 'II', 't': {both}}} AS s,
            {{'c': 2, 'a': 'I', 't': ['assistant:']}} AS u, {{'c': 0, 'a': '', 't': {nothing}}} AS a FROM counted
        UNION ALL
        SELECT conv_id, pos, {inserted('e', 'u', 'user')}, {inserted('s', 'u', 'user')}, u, {inserted('a', 'u', 'user')} FROM (
            SELECT conv_id, pos, e, s, {inserted('u', 'a', 'assistant')} AS u, a FROM (
                SELECT conv_id, pos - 1 AS pos, {before('e', 'u', 'user', [('s', 's'), ('u', 'u')])} AS e,
                    {before('s', 'u', 'user', [('u', 'u')])} AS s, {before('u', 'a', 'assistant', [('a', 'a')])} AS u,
                    {before('a', 'u', 'user', [('u', 'u')])} AS a
                FROM (SELECT ways.*, j.init, j.role, j.text, CAST(j.fault = 'truncated' AS INT) AS cut, j.fault IN ('blank', 'duplicate') AS gone
                    FROM ways JOIN judged AS j ON j.conv_id IS NOT DISTINCT FROM ways.conv_id AND j.pos = ways.pos)))),
    cheapest AS (SELECT conv_id, e FROM ways WHERE pos = 0)
    SELECT own.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
        coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(e.c, 0) AS BIGINT) AS cost,
        coalesce(e.a, '') AS audit, sha256(coalesce(array_to_string(e.t, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) AS own
        LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM own.conv_id
        LEFT JOIN cheapest ON cheapest.conv_id IS NOT DISTINCT FROM own.conv_id
    """


TWINS = {
    "op2_token_rollup": OP2, "op5_ngram_join": OP5, "op8_decontaminate": OP8, "op10_quality_rules": _quality_twin(),
    "op11_turn_repair": _repair_twin(), "op13_hyperminhash": OP13,
}
