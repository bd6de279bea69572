"""The expected result as SQL for another engine, where SQL can express it."""

from __future__ import annotations

import re

from loadkeeper.llm import licenses, resample, rules, spelling
from loadkeeper.llm.shared import UPPER


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def licence_scan() -> str:
    """Sentences by one search in the lines of a piece, then one nested select for each rule, as a pattern over the identifiers' names."""
    piece = "p"
    for pattern, to in licenses.ENDS:
        piece = f"regexp_replace({piece}, {_quoted(pattern)}, {_quoted(to.replace('$', chr(92)))}, 'g')".replace("\n", "' || chr(10) || '")
    bare = r"regexp_replace(regexp_replace(x, '[^a-z0-9.]+', ' ', 'g'), '(^|\s)\.+|\.+($|\s)', ' ', 'g')"
    marks = r"^(?:[0-9]{1,2}|[a-z]|i{2,3}) (redistribution|neither |the )"
    line = f"regexp_replace(trim(regexp_replace({bare}, ' +', ' ', 'g')), '{marks}', '\\1')"
    cues = lambda x: " OR ".join(f"contains({x}, {_quoted(c)})" for c in licenses.CUES)
    known, tags = (", ".join(f"{_quoted(s)}: {_quoted(i)}" for s, i in entries.items()) for entries in (licenses.SENTENCES, licenses.TAGS))
    tag = _quoted(licenses.TAG)
    named = f"""CASE WHEN starts_with(x, {tag}) THEN list_transform(regexp_split_to_array(replace(substr(x, {len(licenses.TAG) + 1}), ' or later', ' orlater'),
        ' (?:and|or|with) '), lambda t: coalesce(MAP {{{tags}}}[t], '?')) ELSE [coalesce(MAP {{{known}}}[regexp_replace(x, '^.* nor the names of ', 'nor the names of ')], '?')] END"""
    out = f"""WITH pieces AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '\\.[^a-z0-9\\s]*\\s|\\n\\n+'),
        lambda x: {cues('x')} OR contains(x, 'free') OR contains(x, 'rights')) AS pieces FROM documents),
    lines AS (SELECT doc_id, list_transform(pieces, lambda p: array_to_string(list_transform(string_split({piece}, chr(10)), lambda x: {line}), chr(10))) AS pieces FROM pieces),
    found AS (SELECT doc_id, list_filter(list_transform(flatten(list_transform(pieces, lambda p: regexp_extract_all(p, {_quoted(licenses.LINES)}))),
        lambda x: translate(x, chr(10), ' ')), lambda x: {cues('x')}) AS sentences FROM lines),
    named AS (SELECT doc_id, flatten(list_transform(sentences, lambda x: {named})) AS ids FROM found)
    SELECT doc_id, ids, array_to_string(list_transform(ids, lambda i: '<' || i || '>'), '') AS rest, CAST([] AS VARCHAR[]) AS found FROM named"""
    for name, sequence in licenses.RULES:
        names = [re.escape(f"<{i}>").replace("\\ ", " ") for i in sequence.split(",")]
        part, between = _quoted("(.*?)".join(names)), _quoted("".join(f"\\{n}" for n in range(1, len(names))))
        out = f"""SELECT doc_id, ids, regexp_replace(rest, {part}, {between}, 'g') AS rest,
          CASE WHEN regexp_matches(rest, {part}) AND NOT list_contains(found, {_quoted(name)}) THEN list_append(found, {_quoted(name)}) ELSE found END AS found
          FROM ({out}) r"""
    return f"""SELECT doc_id, array_to_string(ids, ',') AS sentences, array_to_string(found, ',') AS licences,
      CAST(len(list_filter(ids, lambda x: x = '?')) AS BIGINT) AS n_unknown FROM ({out}) q"""


def _checksum(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, one byte after the other, with the table ``crc`` in scope."""
    steps = f"list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex({text}), '..'), lambda h: CAST('0x' || h AS BIGINT)))"
    return f"xor(4294967295::BIGINT, list_reduce({steps}, lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1])))"


CRC = """crcs AS (SELECT list(list_reduce(list_prepend(i, range(8)),
    lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END) ORDER BY i) AS crc FROM range(256) r(i))"""
WORD = r"[^\x20\x09-\x0D]"


def spelling_variants() -> str:
    """Words by counting; near words by patterns with one code point left out; roots by following forms."""
    plain = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    short = f"length(%s) >= {spelling.LEAST_LENGTH}"
    return f"""WITH RECURSIVE {CRC},
    runs AS (SELECT doc_id, unnest(regexp_extract_all({plain}, '[a-zÀ-ÿ]+')) AS run FROM documents),
    checked AS (SELECT run, n, {_checksum("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h
      FROM (SELECT doc_id, run, count(*) AS n FROM runs WHERE {short % "run"} GROUP BY ALL) r, crcs),
    words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT n,
        CASE WHEN h % {spelling.SPOILED} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
      FROM checked) w WHERE {short % "word"} GROUP BY word HAVING sum(n) >= {spelling.LEAST_COUNT}),
    cuts AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM words, range(30000) r(i) WHERE i < length(word)),
    near AS (SELECT a.word, b.word AS other, b.n AS m FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
      UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
      UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word),
    best AS (SELECT w.word, w.n, count(other) AS n_near, max(m) AS m, arg_min(other, (-m, other)) AS other
      FROM words w LEFT JOIN near USING (word) GROUP BY w.word, w.n),
    forms AS (SELECT word, n, n_near, CASE WHEN m >= {spelling.RATIO} * n THEN other END AS form, CASE WHEN m >= {spelling.RATIO} * n THEN m END AS form_n FROM best),
    chain AS (SELECT word, word AS root FROM words
      UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON c.root = f.word WHERE f.form IS NOT NULL)
    SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c USING (word) JOIN forms e ON e.word = c.root WHERE e.form IS NULL"""


def quality_rules() -> str:
    """Words and lines as lists; repeated words by numbering words and joining windows with themselves."""
    starts = "|".join(re.escape(m) for m in rules.BULLETS)
    ends = "|".join(re.escape(m) for m in rules.ELLIPSES)
    known = ", ".join(_quoted(w) for line in rules.STOP_WORDS for w in line.split())
    held = lambda marks: f"length(text) - length(translate(text, {_quoted(marks)}, ''))"
    run = " || chr(10) || ".join(["word", *[f"lead(word, {k}) OVER of_text" for k in range(1, rules.WINDOW)]])
    broken = []
    for r in rules.RULES:
        per = r.per or "1"
        value = f"100 * {r.count}" if r.per else r.count
        sides = [f"{value} < {per} * {r.least}"] * (r.least is not None) + [f"{value} > {per} * {r.most}"] * (r.most is not None)
        broken.append(f"CASE WHEN {per} >= {r.among} AND ({' OR '.join(sides)}) THEN '{r.name}' END")
    return f"""WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
    parts AS (SELECT *, regexp_extract_all(text, '{WORD}+') AS words,
      list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines FROM texts),
    words AS (SELECT row, unnest(words) AS word, unnest(range(len(words))) AS place FROM parts),
    runs AS (SELECT row, place, {run} AS run FROM words WINDOW of_text AS (PARTITION BY row ORDER BY place)),
    again AS (SELECT row, place FROM runs WHERE run IS NOT NULL QUALIFY count(*) OVER (PARTITION BY row, run) > 1),
    repeats AS (SELECT row, count(DISTINCT place + k) AS n FROM again, range({rules.WINDOW}) r(k) GROUP BY row),
    echoes AS (SELECT a.row, count(*) AS n FROM words a JOIN words b ON a.row = b.row AND a.place = b.place + 1 AND a.word = b.word GROUP BY a.row),
    counts AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
      CAST({held(rules.SYMBOLS)} AS BIGINT) AS n_symbols, {held(rules.SHOUTS)} AS n_shouts, {held(UPPER)} AS n_capitals,
      len(list_filter(words, lambda w: list_contains([{known}], translate(lower(w), '.,;:!?"''()', '')))) AS n_stop_words,
      CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, coalesce(e.n, 0) AS n_echoes, len(lines) AS n_lines,
      CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
      len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*({starts})'))) AS n_bullets,
      len(list_filter(lines, lambda x: regexp_matches(x, '({ends})[\x20\x09-\x0D]*$'))) AS n_cut_lines
      FROM parts p LEFT JOIN repeats r ON r.row = p.row LEFT JOIN echoes e ON e.row = p.row),
    judged AS (SELECT *, list_filter([{", ".join(broken)}], lambda f: f IS NOT NULL) AS failed FROM counts)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
      n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
      NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND len(failed) = 0 AS kept, array_to_string(failed, ',') AS failed FROM judged"""


def resampling() -> str:
    """Features as rows, their distinct texts hashed once; the draw by a plain window."""
    plain = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    split = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    runs = " UNION ALL ".join(
        f"SELECT side, row, unnest(list_transform(range(1, len(words) - {k} + 2), lambda i: array_to_string(words[i:i + {k - 1}], ' '))) AS feature FROM texts"
        for k in range(1, resample.WIDTH + 1)
    )
    smooth, steps = resample.BUCKETS, resample.STEPS
    return f"""WITH {CRC},
    texts AS (SELECT 's' AS side, row_number() OVER () AS row, doc_id, regexp_extract_all({plain}, '{split}') AS words FROM documents
      UNION ALL SELECT 't', -row_number() OVER (), NULL, regexp_extract_all({plain}, '{split}') FROM benchmark),
    features AS (SELECT side, row, feature, count(*) AS n FROM ({runs}) f GROUP BY ALL),
    hashed AS (SELECT feature, {_checksum("feature")} % {smooth} AS bucket FROM (SELECT DISTINCT feature FROM features) d, crcs),
    placed AS (SELECT side, row, bucket, CAST(sum(n) AS BIGINT) AS n FROM features JOIN hashed USING (feature) GROUP BY ALL),
    sides AS (SELECT bucket, sum(n) FILTER (side = 's') AS s, coalesce(sum(n) FILTER (side = 't'), 0) AS t FROM placed GROUP BY bucket),
    totals AS (SELECT CAST(sum(s) AS DOUBLE) AS all_s, CAST(sum(t) AS DOUBLE) AS all_t FROM sides),
    gains AS (SELECT bucket, CAST(floor({steps} * ln(CAST(t + 1 AS DOUBLE) * (all_s + {smooth}) / (CAST(s + 1 AS DOUBLE) * (all_t + {smooth})))) AS BIGINT) AS gain
      FROM sides, totals),
    weights AS (SELECT row, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight FROM placed JOIN gains USING (bucket) WHERE side = 's' GROUP BY row),
    scored AS (SELECT doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
        + CAST(floor(-{steps} * ln(-ln((CAST('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
      FROM texts LEFT JOIN weights USING (row) WHERE side = 's'),
    drawn AS (SELECT *, row_number() OVER (PARTITION BY n_words >= {resample.LEAST_WORDS} ORDER BY score DESC, doc_id NULLS LAST) AS place,
      count(*) OVER (PARTITION BY n_words >= {resample.LEAST_WORDS}) * {resample.PERCENT} // 100 AS wanted FROM scored)
    SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= {resample.LEAST_WORDS} AND place <= wanted THEN place END AS rank FROM drawn"""


SQL = {
    "op10_licenses": licence_scan(),
    "op11_spelling_variants": spelling_variants(),
    "op12_quality_rules": quality_rules(),
    "op13_resampling": resampling(),
}
