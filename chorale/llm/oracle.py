"""The queries of this subpackage as SQL for DuckDB, where SQL can say them."""

from __future__ import annotations

from chorale.llm import chat, fill_middle, licenses, quality, source_divergence

# Words parted by white space, and plain words, as DuckDB reads patterns.
SPACED = r"[^\x20\x09-\x0D]+"
PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _escaped(text: str) -> str:
    text = f"replace({text}, '\\', '\\\\')"
    for control in chat.CONTROLS:
        text = f"replace({text}, {_quoted(control)}, {_quoted(control[0] + chr(92) + control[1:])})"
    return text


def _chat() -> str:
    said = "'</s>[INST] ok [/INST]'"
    frame = len(chat.OPEN) + len(chat.CLOSE) + 2
    order = "ORDER BY turn NULLS FIRST, role NULLS FIRST, sha256(said)"
    return f"""
    WITH chats AS (
        SELECT conv_id, turn, role, coalesce(text, '') AS said FROM conversations
        UNION ALL SELECT -7, 0, 'user', {said} UNION ALL SELECT -7, 1, 'assistant', {said})
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(coalesce(role, '') || chr(10) || said || chr(10), '' {order})) AS turns_sha256,
        CAST(coalesce(sum(length(said)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(said, '' {order}) FILTER (role = 'assistant'), '')) AS loss_sha256,
        CAST(sum({frame} + length({_escaped("said")})
            + length(replace({_escaped("coalesce(role, '')")}, chr(10), '\\-'))) AS BIGINT) AS formatted_chars
    FROM chats GROUP BY conv_id"""


def _quality() -> str:
    rules = quality.LineRules()
    n = quality.WINDOW
    window = ", ".join(f"lead(word, {k}) OVER w" for k in range(1, n))
    phrases = " OR ".join(f"contains(lower(line), {_quoted(p)})" for p in quality.BOILERPLATE)
    closing, blanks = r"""["'’”»)\]]""", r"[\x20\x09-\x0D]"
    end = f"[.!?:;…。！？؟।]{closing}{{0,9}}$"
    finished = f"(?s)^.*(?:[.!?:;…؟।]{closing}{{0,9}}(?:{blanks}|$)|[。！？]{closing}{{0,9}})"
    # Ends of sentences, which RE2 can't look back at, are marked with two controls.
    after_blank = f"([.!?…؟।]{closing}{{0,9}})({blanks})"
    full_width = f"([。！？]{closing}*)"
    chars = "length(regexp_replace({}, '[\\x20\\x09-\\x0D]', '', 'g'))"
    marked = f"""regexp_replace(regexp_replace(done, {_quoted(full_width)}, '\\1' || chr(1) || chr(2), 'g'),
        {_quoted(after_blank)}, '\\1' || chr(1) || chr(2) || '\\2', 'g')"""
    marks = "len(regexp_extract_all(line, '[|»›•·]'))"
    symbols = f"len(regexp_extract_all({{}}, '{quality.SYMBOL}'))"
    return f"""
    WITH words AS (
        SELECT doc_id, unnest(list) AS word, generate_subscripts(list, 1) AS place
        FROM (SELECT doc_id, regexp_extract_all(text, '{SPACED}') AS list FROM documents)),
    windows AS (
        SELECT doc_id, place, concat_ws(' ', word, {window}) AS run
        FROM words WINDOW w AS (PARTITION BY doc_id ORDER BY place)
        QUALIFY lead(word, {n - 1}) OVER w IS NOT NULL),
    found_again AS (
        SELECT doc_id, place FROM windows
        QUALIFY count(*) OVER (PARTITION BY doc_id, run) > 1),
    repeated AS (
        SELECT doc_id, count(DISTINCT place + k) AS n_repeat_words
        FROM found_again, range({n}) AS steps(k) GROUP BY doc_id),
    lines AS (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
    judged_lines AS (
        SELECT doc_id, line, {chars.format("line")} AS chars, regexp_extract(line, {_quoted(finished)}) AS done,
            ({marks} >= {rules.menu_marks}
                AND {marks} > {rules.menu_share} * len(regexp_extract_all(line, '{SPACED}')))
            OR {symbols.format("line")} > {rules.symbol_share} * length(line) AS furniture,
            NOT regexp_matches(right(rtrim(line), {quality.ENDING}), {_quoted(end)}) OR {phrases} AS unfinished
        FROM lines),
    cut_lines AS (
        SELECT *, furniture OR unfinished AS fails, {chars.format(f"""
            CASE WHEN {phrases.replace("(line)", "(done)")} THEN array_to_string(list_filter(
                string_split({marked}, chr(1) || chr(2)), lambda s: NOT ({phrases.replace("(line)", "(s)")})), '')
            ELSE done END""")} AS rest
        FROM judged_lines),
    by_line AS (
        SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
            count(*) FILTER (fails) AS n_failed_lines,
            CAST(sum(chars) AS BIGINT) AS word_chars,
            CAST(sum(CASE WHEN NOT fails THEN chars WHEN furniture THEN 0
                WHEN len(regexp_extract_all(line, '{SPACED}')) < {rules.short_line} AND 2 * rest <= chars THEN 0
                ELSE rest END) AS BIGINT) AS kept_chars
        FROM cut_lines WHERE chars > 0 GROUP BY doc_id),
    counted AS (
        SELECT d.doc_id, coalesce(len(regexp_extract_all(d.text, '{SPACED}')), 0) AS n_words,
            coalesce(l.word_chars, 0) AS word_chars,
            coalesce({symbols.format("d.text")}, 0) AS n_symbols,
            coalesce(l.n_dup_lines, 0) AS n_dup_lines,
            coalesce(r.n_repeat_words, 0) AS n_repeat_words,
            coalesce(l.kept_chars, 0) AS kept_chars,
            coalesce(l.n_lines, 0) AS n_lines, coalesce(l.n_failed_lines, 0) AS n_failed_lines
        FROM documents d LEFT JOIN by_line l USING (doc_id) LEFT JOIN repeated r USING (doc_id)),
    based AS (
        SELECT *, n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeated} * n_words
            AS base_failed FROM counted)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed AND kept_chars >= {1 - rules.max_loss} * word_chars AS kept, n_lines, n_failed_lines,
        kept_chars
    FROM based"""


def _decontaminate() -> str:
    def words(table: str, key: str) -> str:
        lowered = LOWER.format("text")
        return f"""SELECT {key}, unnest(list) AS word, generate_subscripts(list, 1) AS place, len(list) AS n
        FROM (SELECT {key}, regexp_extract_all({lowered}, '{PLAIN}') AS list FROM {table})"""

    def runs(table: str, key: str, length: int) -> str:
        more = ", ".join(f"lead(word, {k}) OVER w" for k in range(1, length))
        whole = f"concat_ws(' ', word, {more})" if more else "word"
        last = f"lead(word, {length - 1}) OVER w IS NOT NULL"
        return f"""SELECT {key}, place, {length} AS length, {whole} AS run FROM {table}
        WINDOW w AS (PARTITION BY {key} ORDER BY place) QUALIFY {last}"""

    lengths = range(1, 11)
    short = " UNION ALL ".join(
        f"({runs('(SELECT * FROM item_words WHERE n = ' + str(k) + ')', 'item_id', k)})" for k in lengths if k < 10
    )
    long = runs("(SELECT * FROM item_words WHERE n >= 10)", "item_id", 10)
    in_docs = " UNION ALL ".join(f"({runs('doc_words', 'doc_id', k)})" for k in lengths)
    return f"""
    WITH doc_words AS ({words("documents", "doc_id")}),
    item_words AS ({words("benchmark", "item_id")}),
    windows AS (SELECT DISTINCT item_id, length, run FROM ({short} UNION ALL ({long}))),
    hits AS (
        SELECT d.doc_id, d.place, d.length, w.item_id
        FROM ({in_docs}) d JOIN windows w ON d.length = w.length AND d.run = w.run),
    words_hit AS (
        SELECT doc_id, count(DISTINCT place + k) AS n_hit
        FROM hits, range(10) AS steps(k) WHERE k < length GROUP BY doc_id),
    items_hit AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
    SELECT d.doc_id, coalesce(len(regexp_extract_all({LOWER.format("d.text")}, '{PLAIN}')), 0) AS n_words,
        coalesce(h.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
        sha256(coalesce(i.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
    FROM documents d LEFT JOIN words_hit h USING (doc_id) LEFT JOIN items_hit i USING (doc_id)"""


def _licenses() -> str:
    phrases = " UNION ALL ".join(
        f"SELECT {_quoted(p)} AS phrase, {_quoted(label)} AS label, {len(p.split())} AS n"
        for p, label in licenses.PHRASES.items()
    )
    rows = ", ".join(
        f"({_quoted(label)}, {k}, [{', '.join(map(_quoted, words))}], "
        f"[{', '.join(_quoted(' ' + m + ' ') for m in licenses.MARKS[label])}])"
        for (label, k), words in licenses.template_words().items()
    )
    lowered = LOWER.format("block")
    return f"""
    WITH words AS (
        SELECT doc_id, unnest(list) AS word, generate_subscripts(list, 1) - 1 AS place
        FROM (SELECT doc_id, regexp_extract_all({LOWER.format("text")}, '{PLAIN}') AS list FROM documents)),
    runs AS (
        SELECT doc_id, place, word AS w1, lead(word, 1) OVER w AS w2, lead(word, 2) OVER w AS w3,
            lead(word, 3) OVER w AS w4
        FROM words WINDOW w AS (PARTITION BY doc_id ORDER BY place)),
    places AS (
        SELECT r.doc_id, r.place, p.label FROM runs r JOIN ({phrases}) p
        ON p.phrase = CASE p.n WHEN 2 THEN r.w1 || ' ' || r.w2
            ELSE r.w1 || ' ' || r.w2 || ' ' || r.w3 || ' ' || r.w4 END),
    base AS (
        SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
            list_sort(list(DISTINCT label)) AS labels FROM places GROUP BY doc_id),
    templates AS (SELECT * FROM (VALUES {rows}) AS t(label, number, tokens, marks)),
    blocks AS (
        SELECT row_number() OVER () AS block, doc_id, regexp_extract_all({lowered}, '{PLAIN}') AS held FROM (
            SELECT doc_id, unnest(string_split_regex(text, '\\n[\\x20\\x09-\\x0D]*\\n')) AS block FROM documents)),
    alike AS (
        SELECT h.doc_id, h.held, t.* FROM blocks h
        JOIN templates t ON len(list_intersect(h.held, t.tokens)) >= ceil({licenses.THRESHOLD} * len(t.tokens) - 1e-9)),
    spans AS (
        SELECT doc_id, label, tokens, marks, held[i:i + {licenses.RUN_RATIO} * len(tokens) - 1] AS run
        FROM (SELECT *, unnest(range(1, len(held) + 1)) AS i FROM alike) WHERE list_contains(tokens, held[i])),
    matched AS (
        SELECT doc_id, label, len(list_intersect(run, tokens)) / len(tokens) AS containment FROM spans
        WHERE len(list_intersect(run, tokens)) >= ceil({licenses.THRESHOLD} * len(tokens) - 1e-9)
            AND len(list_filter(marks, lambda m: contains(' ' || array_to_string(run, ' ') || ' ', m))) = len(marks)),
    found AS (
        SELECT doc_id, list(DISTINCT label) AS labels, max(containment) AS containment
        FROM matched GROUP BY doc_id)
    SELECT d.doc_id, coalesce(len(regexp_extract_all({LOWER.format("d.text")}, '{PLAIN}')), 0) AS n_words,
        coalesce(b.n_base, 0) AS n_base, b.first_word, b.last_word,
        coalesce(array_to_string(b.labels, ','), '') AS base_labels,
        array_to_string(list_sort(list_distinct(
            list_concat(coalesce(b.labels, []), coalesce(f.labels, [])))), ',') AS labels,
        CASE WHEN b.n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(f.containment, 0)::DOUBLE END AS score
    FROM documents d LEFT JOIN base b USING (doc_id) LEFT JOIN found f USING (doc_id)"""


def _substrings(length: int = 35) -> str:
    more = ", ".join(f"lead(word, {k}) OVER w" for k in range(1, length))
    return f"""
    WITH words AS (
        SELECT doc_id, unnest(list) AS word, generate_subscripts(list, 1) AS place
        FROM (SELECT doc_id, regexp_extract_all(text, '{SPACED}') AS list FROM documents)),
    windows AS (
        SELECT doc_id, place, md5(concat_ws(' ', word, {more})) AS run
        FROM words WINDOW w AS (PARTITION BY doc_id ORDER BY place)
        QUALIFY lead(word, {length - 1}) OVER w IS NOT NULL),
    found_again AS (SELECT doc_id, place FROM windows QUALIFY count(*) OVER (PARTITION BY run) > 1),
    gone AS (
        SELECT DISTINCT doc_id, place + k AS place FROM found_again, range({length}) AS steps(k)),
    left_words AS (
        SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS kept, count(*) AS n_kept
        FROM words ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
    SELECT d.doc_id, coalesce(len(regexp_extract_all(d.text, '{SPACED}')), 0) AS n_words,
        coalesce(len(regexp_extract_all(d.text, '{SPACED}')), 0) - coalesce(l.n_kept, 0) AS n_removed,
        sha256(coalesce(l.kept, '')) AS kept_sha256
    FROM documents d LEFT JOIN left_words l USING (doc_id)"""


def _fill_middle(seed: int = 7, rate: int = 100, suffix_first: int = 50) -> str:
    drawn = ", ".join(f"CAST('0x' || substr(digest, {8 * k + 1}, 8) AS BIGINT) AS h{k + 1}" for k in range(4))
    p, s, m = (_quoted(x) for x in (fill_middle.PREFIX, fill_middle.SUFFIX, fill_middle.MIDDLE))
    marked = " OR ".join(f"contains(said, {x})" for x in (p, s, m))
    return f"""
    WITH units AS (
        SELECT doc_id, coalesce(text, '') AS said, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
            sha256('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents),
    drawn AS (SELECT doc_id, said, units, len(units) AS n, {drawn} FROM units),
    cut AS (
        SELECT doc_id, said, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
            units, CASE WHEN said = '' OR {marked} OR h3 % 100 >= {rate} THEN 'plain'
                WHEN h4 % 100 < {suffix_first} THEN 'spm' ELSE 'psm' END AS form
        FROM drawn),
    pieces AS (
        SELECT doc_id, said, n, form, array_to_string(units[1:a], '') AS prefix,
            array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:n], '') AS suffix
        FROM cut)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
        CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN said WHEN 'psm' THEN {p} || prefix || {s} || suffix || {m} || middle
            ELSE {s} || suffix || {p} || prefix || {m} || middle END) AS output_sha256,
        sha256(said) AS restored_sha256
    FROM pieces"""


def _source_divergence() -> str:
    rules = source_divergence
    lowered = LOWER.format("coalesce(text, '')")

    def price(n: str, total: str) -> str:
        return f"CAST(1 + ({rules.SCALE}::HUGEINT * ({n} + {rules.SMOOTHING})) // ({total} + {rules.SMOOTHING} * v) AS BIGINT)"

    return f"""
    WITH read AS (
        SELECT row_number() OVER () AS number, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            regexp_extract_all({lowered}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
    places AS (SELECT number, lang, source, unnest(terms) AS term FROM read),
    kept AS (SELECT lang, term FROM places GROUP BY ALL HAVING count(DISTINCT number) >= {rules.MIN_DOCS}),
    sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
    counts AS (SELECT lang, source, term, count(*) AS n FROM places JOIN kept USING (lang, term) GROUP BY ALL),
    groups AS (
        SELECT g.lang, g.source, coalesce(v, 0) AS v, CAST(coalesce(sum(n), 0) AS BIGINT) AS total
        FROM (SELECT DISTINCT lang, source FROM read) g LEFT JOIN sizes USING (lang)
        LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL),
    langs AS (SELECT lang, any_value(v) AS v, CAST(sum(total) AS BIGINT) AS total FROM groups GROUP BY lang),
    priced AS (
        SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, {price("coalesce(c.n, 0)", "total")} AS p
        FROM groups g JOIN kept k ON k.lang = g.lang
        LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    of_langs AS (
        SELECT l.lang, t.term, {price("t.n", "total")} AS q
        FROM langs l JOIN (SELECT lang, term, CAST(sum(n) AS BIGINT) AS n FROM counts GROUP BY ALL) t USING (lang)),
    apart AS (
        SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
        FROM priced a JOIN priced b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    pairs AS (
        SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
    above AS (
        SELECT p.lang, p.source, p.term AS item, p - q AS value
        FROM priced p JOIN of_langs l ON l.lang = p.lang AND l.term = p.term WHERE n > 0 AND p > q),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place
        FROM (SELECT lang, source, 'pair' AS part, item, value FROM pairs
            UNION ALL SELECT lang, source, 'term', item, value FROM above))
    SELECT lang, source, part, item, value, CAST(place AS INTEGER) AS rank
    FROM ranked WHERE part = 'pair' OR place <= {rules.TOP_TERMS}"""


ORACLE: dict[str, str] = {
    "op2_chat_format": _chat(),
    "op3_quality_rules": _quality(),
    "op4_decontaminate": _decontaminate(),
    "op7_license_scan": _licenses(),
    "op9_substring_dedup": _substrings(),
    "op11_fill_middle": _fill_middle(),
    "op12_source_divergence": _source_divergence(),
}
