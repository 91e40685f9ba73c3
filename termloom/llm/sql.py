"""The native operators' queries once more, as SQL for DuckDB.

The others have no SQL: their hashes, models and token ids are beyond it, and
tests hold them against brute force or held-out labels.
"""

from __future__ import annotations

from termloom.llm.pii import BASE
from termloom.llm.rules import MAX_REPEAT_PERCENT, MIN_WORDS, RULES, STOP_WORDS

SPACE = r"\x20\x09-\x0D"


def quality_rules() -> str:
    stop = "|".join(sorted(set(STOP_WORDS.split())))
    broken = []
    for rule in RULES:
        value = f"({rule.numerator} / nullif({rule.denominator}, 0))" if rule.denominator else rule.numerator
        sides = [f"{value} < {rule.low}"] if rule.low is not None else []
        sides += [f"{value} > {rule.high}"] if rule.high is not None else []
        broken.append(f"CASE WHEN {' OR '.join(sides)} THEN '{rule.name}' END")
    return rf"""WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT doc_id, text,
    list_filter(string_split_regex(text, '[{SPACE}]+'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^{SPACE}]')) AS lines
  FROM texts
),
placed AS (SELECT doc_id, generate_subscripts(words, 1) AS i, unnest(words) AS word FROM split),
windows AS (
  SELECT doc_id, i, word AS a, lead(word) OVER o AS b, lead(word, 2) OVER o AS c
  FROM placed WINDOW o AS (PARTITION BY doc_id ORDER BY i)
),
twice AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS k FROM windows WHERE c IS NOT NULL
  ) WHERE k > 1
),
repeats AS (
  SELECT doc_id, count(DISTINCT i + d) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS d) GROUP BY doc_id
),
measured AS (
  SELECT split.doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[{SPACE}]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words,
    len(lines) AS n_lines,
    len(list_filter(words, lambda x: regexp_matches(x, '^(?i:{stop})([.,;:!?]|$)'))) AS n_stop_words
  FROM split LEFT JOIN repeats ON split.doc_id IS NOT DISTINCT FROM repeats.doc_id
),
judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
    concat_ws(',', {', '.join(broken)}) AS failed
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND failed = '' AS kept, failed
FROM judged"""


DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
LUHN = f"""list_sum(list_transform(range(1, length({DIGITS}) + 1), lambda i:
  CASE WHEN i % 2 = 1 THEN CAST(substr(reverse({DIGITS}), i, 1) AS INT)
  ELSE 2 * CAST(substr(reverse({DIGITS}), i, 1) AS INT)
    - CASE WHEN substr(reverse({DIGITS}), i, 1) > '4' THEN 9 ELSE 0 END END)) % 10 = 0"""
MOD_97 = """list_reduce(list_prepend(0, list_transform(
  string_split(substr(m, 5) || substr(m, 1, 4), ''),
  lambda c: CASE WHEN c >= 'A' THEN ascii(c) - 55 ELSE ascii(c) - 48 END)),
  lambda total, v: (total * CASE WHEN v > 9 THEN 100 ELSE 10 END + v) % 97) = 1"""
# Pattern and check of each kind. An account number is a whole run of letters and digits.
KINDS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "TRUE"),
    "ip": (
        r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
        """len(list_filter(string_split(m, '.'), lambda p: length(ltrim(p, '0')) > 3
          OR coalesce(TRY_CAST(ltrim(p, '0') AS INT), 0) > 255)) = 0""",
    ),
    "card": (r"[0-9](?:[\x20-]?[0-9])+", f"length({DIGITS}) BETWEEN 13 AND 19 AND {LUHN}"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", f"length({DIGITS}) BETWEEN 9 AND 15"),
    "iban": (
        "[A-Za-z0-9]+",
        f"regexp_full_match(m, '[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}}') AND {MOD_97}",
    ),
}


# Score of each kind without and with a word that goes with it, in hundredths.
SCORES = {
    "email": (90, 100, "(?i)mail|contact|write"),
    "ip": (60, 90, r"(?i)\bip\b|address|server|host"),
    "card": (70, 100, "(?i)card|visa|credit|payment"),
    "phone": (60, 90, "(?i)phone|call|tel|mobile|fax"),
    "iban": (80, 100, "(?i)iban|account|bank|transfer"),
}


def personal_data() -> str:
    found = []
    for number, (kind, (pattern, check)) in enumerate(KINDS.items()):
        low, high, words = SCORES[kind]
        # An account number's run may be a part of the text that is near another one.
        near = (
            "right(gap, 40) || ' ' || left(next_gap, 40)"
            if kind != "iban"
            else "right(substr(text, 1, start), 40) || ' ' || substr(text, start + length(m) + 1, 40)"
        )
        found.append(rf"""SELECT doc_id, {number} AS k, '{kind}' AS kind, start, start + length(m) AS stop,
  CASE WHEN regexp_matches({near}, '{words}') THEN {high} ELSE {low} END AS score
FROM (
  SELECT doc_id, text, m, gap, next_gap,
    CAST(sum(length(gap) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) - length(m) AS BIGINT) AS start
  FROM (
    SELECT doc_id, text, generate_subscripts(ms, 1) AS i, unnest(ms) AS m,
      unnest(gaps[1:len(ms)]) AS gap, unnest(gaps[2:len(ms) + 1]) AS next_gap
    FROM (
      SELECT doc_id, text, regexp_extract_all(text, '{pattern}') AS ms,
        string_split_regex(text, '{pattern}') AS gaps
      FROM documents WHERE text IS NOT NULL
    )
  )
) WHERE {check}""")
    base = len(BASE)
    joined = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY k, start)"
    scores = "string_agg(CAST(score AS VARCHAR), ',' ORDER BY k, start)"
    counts = ",\n  ".join(
        f"CAST(coalesce(n_{kind}, 0) AS BIGINT) AS n_{kind}" for kind in BASE
    )
    sums = ", ".join(f"count(*) FILTER (WHERE kind = '{kind}') AS n_{kind}" for kind in BASE)
    return f"""WITH found AS (
{' UNION ALL '.join(found)}
),
per_document AS (
  SELECT doc_id, {sums}, {joined} FILTER (WHERE k < {base}) AS base, {joined} AS spans, {scores} AS scores
  FROM found GROUP BY doc_id
)
SELECT documents.doc_id,
  {counts},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
FROM documents LEFT JOIN per_document ON documents.doc_id IS NOT DISTINCT FROM per_document.doc_id"""


def line_dedup() -> str:
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    key = f"translate(trim(line, {blanks}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""WITH lines AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS i, unnest(ls) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
),
keyed AS (SELECT doc_id, i, line, {key} AS k FROM lines),
repeated AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3
),
judged AS (
  SELECT doc_id, i, line, keeper IS NOT NULL AND doc_id <> keeper AS lost
  FROM keyed LEFT JOIN repeated USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""


def filter_audit() -> str:
    letters = "ABCDE"
    failing = " || ".join(f"CASE WHEN {name} THEN '{name}' ELSE '' END" for name in letters)
    return rf"""WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
),
split AS (
  SELECT *, list_filter(string_split_regex(text, '[{SPACE}]+'), lambda x: x <> '') AS words,
    min(doc_id) OVER (PARTITION BY text) AS least
  FROM texts
),
judged AS (
  SELECT doc_id, part, len(words) < 200 AS A,
    100 * len(list_distinct(words)) < 50 * len(words) AS B,
    100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 3 * length(text) AS C,
    regexp_matches(text, '[#$%&*|]') AS D, doc_id > least AS E
  FROM split
),
kinds AS (
  SELECT part, {failing} AS fails, coalesce(quality, 0) = 1 AS good, coalesce(toxic, 0) = 1 AS bad,
    count(*) AS n
  FROM judged LEFT JOIN (
    SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id
  ) USING (doc_id) GROUP BY ALL
),
names AS (SELECT unnest(string_split('{letters}', '')) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM names a, names b, names c, names d, names e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
),
steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, step, 1) AS f,
    substr(filter_order, 1, step - 1) AS earlier
  FROM (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders)
),
met AS (
  SELECT part, filter_order, step, f, n, fails, good, bad, contains(fails, f) AS fails_it,
    earlier <> '' AND fails <> translate(fails, earlier, '') AS gone
  FROM kinds, steps
),
counted AS (
  SELECT part, filter_order, step, f,
    sum(n) FILTER (WHERE NOT gone AND NOT fails_it) AS kept,
    sum(n) FILTER (WHERE NOT gone AND fails_it) AS removed,
    sum(n) FILTER (WHERE gone AND fails_it) AS redundant,
    sum(n) FILTER (WHERE fails = f) AS unique_fails,
    sum(n) FILTER (WHERE NOT gone AND fails_it AND good) AS good_lost,
    sum(n) FILTER (WHERE NOT gone AND fails_it AND bad) AS toxic_lost
  FROM met GROUP BY ALL
)
SELECT part, filter_order, step,
  {", ".join(
      f"CAST(coalesce({name}, 0) AS BIGINT) AS {name}"
      for name in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
  )},
  CAST(coalesce(sum(removed) OVER (PARTITION BY part, f), 0) AS BIGINT) AS shapley
FROM counted"""


def statements() -> dict[str, str]:
    return {
        "op7_quality_rules": quality_rules(),
        "op10_pii": personal_data(),
        "op12_line_dedup": line_dedup(),
        "op13_filter_audit": filter_audit(),
    }
