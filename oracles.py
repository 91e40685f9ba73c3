"""The registered queries once more, as SQL for DuckDB."""

from __future__ import annotations

from termloom.functions.stop_words import ENGLISH

CUSTOM_STOPS = ["on", "erin", "thing", "st", "france"]
OWN_STOPS = ", ".join(f"'{word}'" for word in CUSTOM_STOPS)
# Sources repeat, and are null for one of them.
REPEATED = "nullif(source, 'src0')"
STOPS = ", ".join("'" + word.replace("'", "''") + "'" for word in ENGLISH)
# Two or more capitalised words, written for an engine that knows no possessive quantifiers.
SEVERAL_CAPITALISED = r"\p{Lu}[\p{L}\p{N}]*(?:[\t-\r ]+\p{Lu}[\p{L}\p{N}]*)+"
PLAIN_NAMES = "[A-Z][a-z]+(?: [A-Z][a-z]+)*"
# Written out, since \s means other things in other dialects.
ASCII_SPACE = r"\x09-\x0d "
UNICODE_SPACE = (
    r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def clean(kind: str, text: str) -> str:
    if kind == "space":
        return f"trim(regexp_replace(lower({text}), '[^a-z0-9]+', ' ', 'g'))"
    if kind == "delete":
        return f"regexp_replace(lower({text}), '[^a-z0-9{UNICODE_SPACE}]', '', 'g')"
    return f"lower({text})"


def split(cleaned: str) -> str:
    body = f"regexp_replace({cleaned}, '[{ASCII_SPACE}]+$', '')"
    return (
        f"CASE WHEN length({cleaned}) > 0 AND {body} = '' THEN []::VARCHAR[] "
        f"ELSE string_split_regex({body}, '[{ASCII_SPACE}]') END"
    )


def stopped(tokens: str, stops: str = STOPS) -> str:
    return f"list_filter({tokens}, lambda x: x NOT IN ({stops}))"


def toks(kind: str, doc_id: str = "doc_id", stops: str = STOPS) -> str:
    """CTE of (doc_id, tokens)."""
    return f"""toks AS (
  SELECT doc_id, {stopped(split('c'), stops)} AS tokens
  FROM (
    SELECT {doc_id} AS doc_id, {clean(kind, 'text')} AS c FROM documents WHERE text IS NOT NULL
  )
)"""


def counts(kind: str, doc_id: str = "doc_id", stops: str = STOPS) -> str:
    """CTEs n, toks, tf, df, len."""
    return f"""{toks(kind, doc_id, stops)},
n AS (SELECT count(*) AS n FROM documents WHERE text IS NOT NULL),
tf AS (
  SELECT doc_id, term, count(*) AS tf
  FROM (SELECT doc_id, unnest(tokens) AS term FROM toks) GROUP BY doc_id, term
),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
len AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS length FROM tf GROUP BY doc_id)"""


KIND = {"normalized": "space", "smoothed": "delete"}


def idf(profile: str, df: str = "df") -> str:
    return f"ln(n / {df})" if profile == "normalized" else f"ln((n + 1) / ({df} + 1))"


def exact_sum(x: str, bits: int) -> str:
    """A sum in fixed point, in whole numbers, so that no order of addition matters."""
    unit = f"{2.0**bits!r}::DOUBLE"
    return f"CAST(sum(CAST(floor(({x}) * {unit}) AS HUGEINT)) AS DOUBLE) / {unit}"


def weights(profile: str, doc_id: str = "doc_id", stops: str = STOPS) -> str:
    """CTEs up to w (doc_id, term, weight) and norms."""
    tf = "(tf / length)" if profile == "normalized" else "tf"
    return f"""{counts(KIND[profile], doc_id, stops)},
w AS (
  SELECT tf.doc_id, tf.term, tf, length, {tf} * {idf(profile)} AS weight
  FROM tf JOIN df USING (term) JOIN len ON tf.doc_id IS NOT DISTINCT FROM len.doc_id, n
),
norms AS (
  SELECT doc_id, any_value(length) AS length, sqrt({exact_sum('weight * weight', 64)}) AS norm
  FROM w GROUP BY doc_id
)"""


BENCHMARK = "SELECT item_id AS query_id, text AS query_raw FROM benchmark"
WORDS = """SELECT item_id * 1000000 + generate_subscripts(words, 1) - 1 AS query_id,
  unnest(words) AS query_raw
FROM (SELECT item_id, regexp_extract_all(text, '[A-Za-z]+') AS words FROM benchmark)"""
MIXED = f"""
  SELECT query_id * 10 AS query_id, query_raw FROM ({BENCHMARK})
  UNION ALL SELECT query_id * 10 + 1, query_raw FROM ({WORDS})
  UNION ALL SELECT query_id * 10 + 2, query_raw || ' ' || query_raw FROM ({WORDS})
  UNION ALL SELECT n_nationkey * 10 + 3, n_name FROM nation
  UNION ALL SELECT r_regionkey * 10 + 4, r_name FROM region
  UNION ALL SELECT r_regionkey * 10 + 5, regexp_replace(r_name, '[A-Z ]', '!', 'g') FROM region
  UNION ALL SELECT r_regionkey * 10 + 6, 'The of AND' FROM region"""


def query_tokens(profile: str, queries: str, stops: str = STOPS) -> str:
    """CTEs queries and qtoks (query_id, tokens)."""
    if profile == "normalized":
        tokens = stopped(split(clean("space", "query_raw")), stops)
    else:
        words = f"string_split_regex({clean('delete', 'query_raw')}, '[{UNICODE_SPACE}]+')"
        tokens = f"list_filter({stopped(words, stops)}, lambda x: x <> '')"
    return f"""queries AS ({queries}),
qtoks AS (SELECT CAST(query_id AS BIGINT) AS query_id, {tokens} AS tokens FROM queries)"""


def query_side(profile: str, queries: str, stops: str = STOPS) -> str:
    """CTEs queries, qtoks, qv on top of weights()."""
    if profile == "normalized":
        join, df = "JOIN", "df"
    else:
        join, df = "LEFT JOIN", "coalesce(df, 0)"
    return f"""{query_tokens(profile, queries, stops)},
qtf AS (
  SELECT query_id, any_value(len) AS len, term, count(*) AS qtf
  FROM (SELECT query_id, len(tokens) AS len, unnest(tokens) AS term FROM qtoks)
  WHERE term <> '' GROUP BY query_id, term
),
qw AS (
  SELECT query_id, len, term, qtf, {df} AS df, qtf * {idf(profile, df)} AS qweight
  FROM qtf {join} df USING (term), n
),
qv AS (
  SELECT qw.*, qnorm FROM qw JOIN (
    SELECT query_id, sqrt({exact_sum('qweight * qweight', 64)}) AS qnorm FROM qw GROUP BY query_id
  ) USING (query_id)
)"""


def significant(x: str) -> str:
    """Nine significant digits."""
    shift = f"pow(10.0::DOUBLE, 8 - floor(log10({x})))"
    return f"CASE WHEN {x} > 0 THEN floor({x} * {shift} + 0.5) / {shift} ELSE {x} END"


def hits(profile: str, k: int = 10) -> str:
    """CTE hits (query_id, mode, rank, doc_id, score)."""
    part = "(weight / nullif(norm, 0)) * (qweight / nullif(qnorm, 0))"
    part += "" if profile == "normalized" else " * qtf"
    tie = "" if profile == "normalized" else (
        " CASE WHEN mode = 'single' THEN CAST(doc_id AS VARCHAR) END DESC NULLS LAST,"
    )
    return f"""scored AS (
  SELECT query_id, 'single' AS mode, doc_id, weight AS score
  FROM qv JOIN w USING (term) WHERE len = 1
  UNION ALL
  SELECT query_id, 'cosine', doc_id, cosine
  FROM (
    SELECT query_id, w.doc_id, {exact_sum(part, 88)} AS cosine
    FROM qv JOIN w USING (term) JOIN norms ON w.doc_id IS NOT DISTINCT FROM norms.doc_id
    WHERE len > 1 GROUP BY query_id, w.doc_id
  ) WHERE cosine > 0
),
hits AS (
  SELECT query_id, mode, doc_id, {significant('score')} AS score, rank FROM (
    SELECT query_id, mode, doc_id, score, CAST(row_number() OVER (
      PARTITION BY query_id ORDER BY score DESC,{tie} doc_id NULLS FIRST) AS INTEGER) AS rank
    FROM scored
  ) WHERE rank <= {k}
)"""


def status(profile: str) -> str:
    if profile == "normalized":
        case = """CASE WHEN len(tokens) = 0 THEN 'ignored'
    WHEN len(tokens) = 1 AND tokens[1] = '' THEN 'skipped'
    WHEN len(tokens) = 1 AND n_hits IS NULL THEN 'no documents'
    WHEN n_known IS NULL THEN 'terms not found in corpus'
    WHEN n_hits IS NULL THEN 'no similar documents' ELSE 'ok' END"""
    else:
        case = """CASE WHEN len(tokens) = 0 THEN 'no searchable terms'
    WHEN n_hits IS NULL THEN 'no hits' ELSE 'ok' END"""
    return f"""SELECT query_id,
  CASE len(tokens) WHEN 0 THEN 'none' WHEN 1 THEN 'single' ELSE 'cosine' END AS mode,
  {case} AS status, coalesce(n_hits, 0) AS n_hits
FROM qtoks
LEFT JOIN (SELECT query_id, count(*) AS n_known FROM qv GROUP BY query_id) USING (query_id)
LEFT JOIN (SELECT query_id, count(*) AS n_hits FROM hits GROUP BY query_id) USING (query_id)"""


JOINED_LINES = (
    r"regexp_replace(regexp_replace(text, '(\r\n|\n|\r)\z', ''), '\r\n|\n|\r', ' ', 'g')"
)
CHUNKS = f"""chunks AS (
  SELECT doc_id, CAST(i AS INTEGER) AS chunk_id, substr(t, i * 10000 + 1, 10000) AS chunk
  FROM (SELECT doc_id, t, unnest(range(CAST(ceil(length(t) / 10000) AS BIGINT))) AS i
        FROM (SELECT doc_id, {JOINED_LINES} AS t FROM documents WHERE text IS NOT NULL))
)"""


WHOLE = f"""chunks AS (
  SELECT {JOINED_LINES} AS chunk FROM documents WHERE text IS NOT NULL
)"""


BOOK_TEXTS = r"""books AS (
  SELECT source, string_agg(regexp_replace(text, '\r\n|\n|\r', ' ', 'g'), ' ' ORDER BY doc_id) AS t
  FROM documents WHERE text IS NOT NULL GROUP BY source
)"""
BOOKS = f"{BOOK_TEXTS}, chunks AS (SELECT t AS chunk FROM books)"


def mentions(pattern: str, chunks: str = CHUNKS) -> str:
    return f"""{chunks},
found AS (
  SELECT trim(regexp_replace(m, '[{ASCII_SPACE}]+', ' ', 'g')) AS mention
  FROM (SELECT unnest(regexp_extract_all(chunk, '{pattern}')) AS m FROM chunks)
),
counted AS (
  SELECT mention, count(*) AS n FROM found WHERE mention LIKE '% %' GROUP BY mention
)"""


def lines(text: str) -> str:
    return rf"unnest(string_split_regex({text}, '\r\n|\n|\r')) AS line, " + (
        rf"generate_subscripts(string_split_regex({text}, '\r\n|\n|\r'), 1) AS pos"
    )


def kept_lines() -> str:
    blank = r"regexp_replace(line, '^[\x09-\x0d ]+|[\x09-\x0d ]+$', '', 'g')"
    return f"""SELECT doc_id, pos, l FROM (
  SELECT doc_id, pos, {blank} AS l
  FROM (SELECT doc_id, {lines('text')} FROM documents WHERE text IS NOT NULL)
) WHERE l <> '' AND l NOT LIKE '#%'"""


def statements() -> dict[str, str]:
    one_line = r"regexp_replace(text, '[\r\n\t]', ' ', 'g')"
    top10 = "SELECT mention, n FROM counted ORDER BY n DESC, mention LIMIT 10"
    sql = {
        "corpus_scan": "SELECT doc_id, text FROM documents WHERE text IS NOT NULL",
        "corpus_count": "SELECT count(*) AS n_docs FROM documents WHERE text IS NOT NULL",
        "sample_5": f"""WITH {toks('none')}
SELECT doc_id, array_to_string(tokens, ' ') AS tokens FROM toks ORDER BY doc_id LIMIT 5""",
        "clean_space": f"SELECT doc_id, {clean('space', 'text')} AS clean FROM documents WHERE text IS NOT NULL",
        "clean_delete": f"SELECT doc_id, {clean('delete', 'text')} AS clean FROM documents WHERE text IS NOT NULL",
        "document_frequency_distinct": f"""WITH {toks('delete')}
SELECT term, count(DISTINCT doc_id) AS df
FROM (SELECT doc_id, unnest(tokens) AS term FROM toks) GROUP BY term""",
        "tf_normalized": f"""WITH {counts('space')}
SELECT doc_id, term, round(tf / length, 6) AS tf_share FROM tf JOIN len USING (doc_id)""",
        "query_lines": f"""SELECT doc_id,
  row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS query_id, l AS query_raw
FROM ({kept_lines()})""",
        "query_file": f"""SELECT row_number() OVER (ORDER BY doc_id, pos) AS query_id, l AS query_raw
FROM ({kept_lines()})""",
        "corpus_tsv": f"""SELECT doc_id, text FROM (
  SELECT CAST(doc_id AS VARCHAR) AS doc_id,
         nullif(split_part({one_line}, chr(9), 1), '') AS text FROM documents
) WHERE text IS NOT NULL""",
        "titles_tsv": """SELECT CAST(doc_id AS VARCHAR) AS doc_id,
  CASE WHEN toxic = 0 THEN CAST(quality AS VARCHAR) END AS title FROM labels""",
        "titles_lines": """SELECT CAST(doc_id AS VARCHAR) AS doc_id,
  CAST(quality AS VARCHAR) AS title FROM labels WHERE toxic = 0""",
        "text_chunks": f"WITH {CHUNKS} SELECT doc_id, chunk_id, chunk FROM chunks",
        "mention_counts": f"WITH {mentions(SEVERAL_CAPITALISED)} SELECT mention, n FROM counted",
        "mention_counts_custom": f"""WITH {mentions(PLAIN_NAMES)}
SELECT mention, n FROM counted""",
        "mention_counts_whole": f"WITH {mentions(SEVERAL_CAPITALISED, WHOLE)} SELECT mention, n FROM counted",
        "mention_top10": f"WITH {mentions(SEVERAL_CAPITALISED, WHOLE)} {top10}",
        "book_chunks": rf"""WITH {BOOK_TEXTS}
SELECT source, CAST(i AS INTEGER) AS chunk_id, substr(t, i * 10000 + 1, 10000) AS chunk
FROM (SELECT source, t, unnest(range(CAST(ceil(length(t) / 10000) AS BIGINT))) AS i FROM books)""",
        "titles_last": """SELECT lang AS doc_id, max_by(source, doc_id) AS title
FROM documents GROUP BY lang""",
        "empty_inputs": f"""WITH {weights('normalized')}, {query_side('normalized', BENCHMARK)},
{hits('normalized')}
SELECT 'queries' AS input, 0 AS n UNION ALL SELECT 'hits', 0 UNION ALL SELECT 'status', 0
UNION ALL SELECT 'untitled', count(*) FROM hits""",
        "mention_counts_overlap": f"WITH {mentions(PLAIN_NAMES, WHOLE)} SELECT mention, n FROM counted WHERE length(mention) < 500",
        "book_mentions": f"""WITH {mentions(SEVERAL_CAPITALISED, BOOKS)}
SELECT mention, n FROM counted WHERE length(mention) < 500""",
        "mention_listing": f"""WITH {mentions(SEVERAL_CAPITALISED, WHOLE)}
SELECT CASE WHEN length(mention) < 30 THEN rpad(mention, 30, ' ') ELSE mention END
  || ' | ' || CAST(n AS VARCHAR) AS line FROM ({top10})""",
    }
    for key, kind in (("tokens_space", "space"), ("tokens_delete", "delete"), ("tokens_raw", "none")):
        sql[key] = f"""WITH {toks(kind)}
SELECT doc_id, CAST(generate_subscripts(tokens, 1) - 1 AS INTEGER) AS position,
  unnest(tokens) AS term FROM toks"""
    for name, kind in KIND.items():
        default = {"normalized": "[Title Not Found]", "smoothed": "Unknown Movie Name"}[name]
        base = f"WITH {counts(kind)}"
        weighed = f"WITH {weights(name)}"
        single = f"{weighed}, {query_side(name, WORDS)}, {hits(name)}"
        several = f"{weighed}, {query_side(name, BENCHMARK)}, {hits(name)}"
        mixed = f"{weighed}, {query_side(name, MIXED)}, {hits(name)}"
        titled = f"""SELECT query_id, mode, rank, hits.doc_id, score,
  CASE WHEN t.doc_id IS NULL THEN '{default}' ELSE t.title END AS title
FROM hits LEFT JOIN (
  SELECT doc_id, min(CAST(quality AS VARCHAR)) AS title FROM labels GROUP BY doc_id
) t ON hits.doc_id = t.doc_id"""
        sql |= {
            f"term_frequency_{name}": f"{base} SELECT term, doc_id, tf FROM tf",
            f"document_frequency_{name}": f"{base} SELECT term, df FROM df",
            f"document_length_{name}": f"{base} SELECT doc_id, length FROM len",
            f"idf_{name}": f"{base} SELECT term, df, round({idf(name)}, 6) AS idf FROM df, n",
            f"tfidf_{name}": f"{weighed} SELECT doc_id, term, round(weight, 6) AS weight FROM w",
            f"document_norm_{name}": f"""{weighed}
SELECT doc_id, length, round(norm, 6) AS norm FROM norms""",
            f"document_vector_{name}": f"""{weighed}
SELECT doc_id, count(*) AS n_terms, round(sum(weight), 6) AS weight_sum FROM w GROUP BY doc_id""",
            f"query_headings_{name}": f"""WITH {query_tokens(name, MIXED)}
SELECT query_id, CASE WHEN len(tokens) = 1 THEN upper(tokens[1])
  ELSE array_to_string(tokens, ' ') END AS heading FROM qtoks""",
            f"loaded_index_{name}": f"""{several}
SELECT query_id, rank, doc_id, score FROM hits""",
            f"search_term_{name}": f"""{weighed}
SELECT CAST(row_number() OVER (
    ORDER BY weight DESC,{' CAST(doc_id AS VARCHAR) DESC,' * (name == 'smoothed')} doc_id) AS INTEGER) AS rank,
  doc_id, {significant('weight')} AS score
FROM w WHERE term = (SELECT term FROM df ORDER BY df DESC, term LIMIT 1)
ORDER BY rank LIMIT 10""",
            f"search_custom_stops_{name}": f"""WITH {weights(name, stops=OWN_STOPS)},
{query_side(name, MIXED, OWN_STOPS)}, {hits(name)}
SELECT query_id, mode, rank, doc_id, score FROM hits""",
            f"index_repeated_ids_{name}": f"""WITH {weights(name, REPEATED)}
SELECT doc_id, term, tf, length, round(weight, 6) AS weight FROM w""",
            f"search_repeated_ids_{name}": f"""WITH {weights(name, REPEATED)},
{query_side(name, BENCHMARK)}, {hits(name)}
SELECT query_id, mode, rank, doc_id, score FROM hits""",
            f"query_vector_{name}": f"""{weighed}, {query_side(name, BENCHMARK)}
SELECT query_id, term, qtf, df, round(qweight, 6) AS qweight, round(qnorm, 6) AS qnorm FROM qv""",
            f"single_term_top10_{name}": f"""{single}
SELECT query_id, rank, doc_id, score FROM hits WHERE mode = 'single'""",
            f"cosine_top10_{name}": f"""{several}
SELECT query_id, rank, doc_id, score FROM hits WHERE mode = 'cosine'""",
            f"cosine_pruned_{name}": f"""{several}
SELECT query_id, rank, doc_id, score FROM hits WHERE mode = 'cosine'""",
            f"top2000_{name}": f"""{weighed}, {query_side(name, BENCHMARK)}, {hits(name, 2000)}
SELECT query_id, rank, doc_id, score FROM hits""",
            f"vector_blocks_{name}": f"""WITH {weights(name, REPEATED)},
placed AS (
  SELECT doc_id, term, weight, (row_number() OVER (PARTITION BY doc_id ORDER BY term) - 1) // 1000 AS block
  FROM w
)
SELECT doc_id, block, min(term) AS first_term, max(term) AS last_term, count(*) AS n_terms,
  round(sum(weight), 6) AS weight_sum FROM placed GROUP BY doc_id, block""",
            f"search_batch_{name}": f"{mixed} SELECT query_id, mode, rank, doc_id, score FROM hits",
            f"search_status_{name}": f"{mixed} {status(name)}",
            f"hits_with_titles_{name}": f"{mixed} {titled}",
            f"hit_listing_{name}": f"""{mixed}
SELECT query_id, rank,
  CAST(rank AS VARCHAR) || '. ' || title || ' (' || printf('%.4f', floor(score * 10000.0::DOUBLE + 0.5) / 10000.0::DOUBLE) || ')' AS line
FROM ({titled})""",
        }
    return sql
