"""

All queries read whole tables. The index of a profile is built once per
session and scale and then shared by the queries that search it.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracles  # noqa: E402
from termloom.functions.text import clean_delete, clean_space  # noqa: E402
from termloom.functions.weights import document_tf, idf  # noqa: E402
from termloom.operators.chunks import CHUNK_SIZE, chunk_texts  # noqa: E402
from termloom.operators.corpus import corpus_size, tokenize_corpus  # noqa: E402
from termloom.operators.frequency import (  # noqa: E402
    document_frequency,
    document_frequency_by_row,
    document_frequency_distinct,
    document_length,
    explode_tokens,
    has_unique_ids,
    term_frequency,
)
from termloom.operators.mentions import count_mentions, extract_mentions  # noqa: E402
from termloom.operators.queries import COSINE, SINGLE, tokenize_queries  # noqa: E402
from termloom.operators.titles import one_title_per_id  # noqa: E402
from termloom.plans.index import TextIndex, build_index, load_index  # noqa: E402
from termloom.plans.mention_report import mention_report  # noqa: E402
from termloom.plans.search import query_vectors, search, search_term, search_vectors  # noqa: E402
from termloom.plans.workspace import Workspace  # noqa: E402
from termloom.profiles import NORMALIZED, RAW, SMOOTHED, Profile  # noqa: E402
from termloom.sources.listings import hit_lines, mention_lines, query_headings  # noqa: E402
from termloom.sources.readers import (  # noqa: E402
    query_lines,
    read_book,
    read_corpus_table,
    read_corpus_tsv,
    read_queries,
    read_titles_lines,
    read_titles_tsv,
)

try:
    import corpus_pipeline
    from termloom.llm import queries as llm
except ModuleNotFoundError as error:
    # The subpackage for training data is optional, as a whole.
    if error.name not in ("corpus_pipeline", "termloom.llm"):
        raise
    llm = corpus_pipeline = None

Query = Callable[[SparkSession, str], DataFrame]

# More than a benchmark text has words, so that its words have numbers of their own.
WORDS_PER_TEXT = 1_000_000
# Terms of a vector block, so that sources have many.
VECTOR_BLOCK = 1_000
# Characters of chunks that many names cross, and of the text around them.
SHORT_CHUNK = 1_000
SHORT_OVERLAP = 500
# Decimals shown of weights and norms, so that two engines' logarithms agree.
DIGITS = 6

# A stop list that is not the default: words of the corpus, and common ones left in.
CUSTOM_STOPS = oracles.CUSTOM_STOPS

_indexes: dict[tuple[str, str, str], TextIndex] = {}


def entry(spark: SparkSession) -> DataFrame:
    """Cosine top 10 of every benchmark text over the documents, at sf0.001."""
    return _cosine_top10(NORMALIZED)(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    registered: dict[str, Query] = {
        "corpus_scan": _documents,
        "corpus_count": lambda spark, sf: corpus_size(_documents(spark, sf, spread=False)),
        "sample_5": _sample_5,
        "clean_space": lambda spark, sf: _documents(spark, sf).select(
            "doc_id", clean_space(F.col("text")).alias("clean")
        ),
        "clean_delete": lambda spark, sf: _documents(spark, sf).select(
            "doc_id", clean_delete(F.col("text")).alias("clean")
        ),
        "tokens_space": lambda spark, sf: explode_tokens(_tokens(spark, sf, NORMALIZED)),
        "tokens_delete": lambda spark, sf: explode_tokens(_tokens(spark, sf, SMOOTHED)),
        "tokens_raw": lambda spark, sf: explode_tokens(_tokens(spark, sf, RAW)),
        "document_frequency_distinct": _document_frequency_distinct,
        "tf_normalized": _tf_normalized,
        "query_lines": lambda spark, sf: query_lines(_documents(spark, sf)),
        "query_file": _query_file,
        "corpus_tsv": _corpus_tsv,
        "titles_tsv": lambda spark, sf: read_titles_tsv(spark, _title_file(spark, sf)),
        "titles_lines": lambda spark, sf: read_titles_lines(spark, _title_file(spark, sf)),
        "text_chunks": lambda spark, sf: chunk_texts(_documents(spark, sf)),
        "book_chunks": _book_chunks,
        "mention_counts": _mention_counts,
        "mention_counts_whole": lambda spark, sf: count_mentions(
            extract_mentions(chunk_texts(_documents(spark, sf), None))
        ),
        "titles_last": _titles_last,
        "empty_inputs": _empty_inputs,
        "mention_counts_custom": _mention_counts_custom,
        "mention_counts_overlap": _mention_counts_overlap,
        "book_mentions": _book_mentions,
        "mention_top10": lambda spark, sf: mention_report(_documents(spark, sf)),
        "mention_listing": lambda spark, sf: mention_lines(mention_report(_documents(spark, sf))),
    }
    for profile in (NORMALIZED, SMOOTHED):
        name = profile.name
        registered |= {
            f"term_frequency_{name}": _term_frequency(profile),
            f"document_frequency_{name}": _document_frequency(profile),
            f"document_length_{name}": _document_length(profile),
            f"idf_{name}": _idf(profile),
            f"tfidf_{name}": _tfidf(profile),
            f"document_norm_{name}": _document_norm(profile),
            f"document_vector_{name}": _document_vector(profile),
            f"query_headings_{name}": _query_headings(profile),
            f"query_vector_{name}": _query_vector(profile),
            f"single_term_top10_{name}": _single_term_top10(profile),
            f"cosine_top10_{name}": _cosine_top10(profile),
            f"cosine_pruned_{name}": _cosine_pruned(profile),
            f"vector_blocks_{name}": _vector_blocks(profile),
            f"top2000_{name}": _top2000(profile),
            f"search_batch_{name}": _search_batch(profile),
            f"search_status_{name}": _search_status(profile),
            f"hits_with_titles_{name}": _hits_with_titles(profile),
            f"hit_listing_{name}": _hit_listing(profile),
            f"search_term_{name}": _search_term(profile),
            f"loaded_index_{name}": _loaded_index(profile),
            f"search_custom_stops_{name}": _search_custom_stops(profile),
            f"index_repeated_ids_{name}": _index_repeated_ids(profile),
            f"search_repeated_ids_{name}": _search_repeated_ids(profile),
        }
    if llm is not None:
        registered |= llm.queries() | {"pipeline": corpus_pipeline.run}
    return registered


def oracle_sql() -> dict[str, str]:
    statements = oracles.statements()
    if llm is not None:
        statements |= llm.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            statements["pipeline"] = corpus_pipeline.ORACLE_SQL
    return statements


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _documents(spark: SparkSession, sf: str, spread: bool = True) -> DataFrame:
    """The documents, dealt out over the cores where work on their texts follows."""
    partitions = spark.sparkContext.defaultParallelism if spread else None
    return read_corpus_table(spark, f"{sf}/documents.parquet", partitions=partitions)


def _tokens(spark: SparkSession, sf: str, profile: Profile) -> DataFrame:
    return tokenize_corpus(_documents(spark, sf), profile)


def _index(spark: SparkSession, sf: str, profile: Profile) -> TextIndex:
    key = (spark.sparkContext.applicationId, sf, profile.name)
    if key not in _indexes:
        path = Workspace(spark).path("index")
        _indexes[key] = build_index(_documents(spark, sf), profile, path)
    return _indexes[key]


def _benchmark_queries(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query_raw")
    )


def _words(spark: SparkSession, sf: str) -> DataFrame:
    """Single-term queries: every plain word of every benchmark text."""
    words = F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))
    return (
        _table(spark, sf, "benchmark")
        .select("item_id", F.posexplode(words).alias("position", "query_raw"))
        .select((F.col("item_id") * WORDS_PER_TEXT + F.col("position")).alias("query_id"), "query_raw")
    )


def _mixed_queries(spark: SparkSession, sf: str) -> DataFrame:
    """Every kind of query: long, single, repeated, unknown, empty, stopped."""
    nation = _table(spark, sf, "nation").select("n_nationkey", "n_name")
    region = _table(spark, sf, "region").select("r_regionkey", "r_name")
    words = _words(spark, sf)

    def kind(rows: DataFrame, key: str, number: int, text) -> DataFrame:
        return rows.select(
            (F.col(key).cast("bigint") * 10 + number).alias("query_id"), text.alias("query_raw")
        )

    word = F.col("query_raw")
    return (
        kind(_benchmark_queries(spark, sf), "query_id", 0, word)
        .unionByName(kind(words, "query_id", 1, word))
        .unionByName(kind(words, "query_id", 2, F.concat_ws(" ", word, word)))
        .unionByName(kind(nation, "n_nationkey", 3, F.col("n_name")))
        .unionByName(kind(region, "r_regionkey", 4, F.col("r_name")))
        .unionByName(kind(region, "r_regionkey", 5, F.regexp_replace("r_name", "[A-Z ]", "!")))
        .unionByName(kind(region, "r_regionkey", 6, F.regexp_replace("r_name", ".+", "The of AND")))
    )


def _titles(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "labels").select("doc_id", F.col("quality").cast("string").alias("title"))


def _sample_5(spark: SparkSession, sf: str) -> DataFrame:
    documents = _documents(spark, sf, spread=False)
    # Five ids are found without their texts.
    first = F.broadcast(documents.select("doc_id").orderBy("doc_id").limit(5))
    return tokenize_corpus(documents.join(first, "doc_id", "left_semi"), RAW).select(
        "doc_id", F.array_join("tokens", " ").alias("tokens")
    )


def _term_frequency(profile: Profile) -> Query:
    return lambda spark, sf: term_frequency(_tokens(spark, sf, profile))


def _document_frequency(profile: Profile) -> Query:
    return lambda spark, sf: _frequency_of(_documents(spark, sf), profile)


def _frequency_of(documents: DataFrame, profile: Profile) -> DataFrame:
    """Pairs of term and document are shuffled only where ids repeat."""
    tokens = tokenize_corpus(documents, profile)
    if has_unique_ids(documents):
        return document_frequency_by_row(tokens)
    return document_frequency(term_frequency(tokens))


def _document_frequency_distinct(spark: SparkSession, sf: str) -> DataFrame:
    documents = _documents(spark, sf)
    tokens = tokenize_corpus(documents, SMOOTHED)
    if has_unique_ids(documents):
        return document_frequency_by_row(tokens)
    return document_frequency_distinct(tokens)


def _document_length(profile: Profile) -> Query:
    return lambda spark, sf: document_length(_tokens(spark, sf, profile))


def _idf(profile: Profile) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        documents = _documents(spark, sf)
        df = _frequency_of(documents, profile)
        n_docs = corpus_size(documents).scalar()
        return df.select(
            "term", "df", F.round(idf(profile, n_docs, F.col("df")), DIGITS).alias("idf")
        )

    return run


def _tf_normalized(spark: SparkSession, sf: str) -> DataFrame:
    share = document_tf(NORMALIZED, F.col("tf"), F.col("length"))
    return (
        _index(spark, sf, NORMALIZED)
        .counts()
        .select("doc_id", "term", F.round(share, DIGITS).alias("tf_share"))
    )


def _tfidf(profile: Profile) -> Query:
    return lambda spark, sf: _index(spark, sf, profile).weights().select(
        "doc_id", "term", F.round("weight", DIGITS).alias("weight")
    )


def _document_norm(profile: Profile) -> Query:
    return lambda spark, sf: _index(spark, sf, profile).docs.select(
        "doc_id", "length", F.round("norm", DIGITS).alias("norm")
    )


def _document_vector(profile: Profile) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        weight_sum = F.aggregate(F.map_values("vector"), F.lit(0.0), lambda total, w: total + w)
        return _index(spark, sf, profile).vectors().select(
            "doc_id",
            F.size("vector").cast("bigint").alias("n_terms"),
            F.round(weight_sum, DIGITS).alias("weight_sum"),
        )

    return run


def _query_headings(profile: Profile) -> Query:
    return lambda spark, sf: query_headings(tokenize_queries(_mixed_queries(spark, sf), profile))


def _query_vector(profile: Profile) -> Query:
    return lambda spark, sf: query_vectors(
        _index(spark, sf, profile), _benchmark_queries(spark, sf)
    ).select(
        "query_id",
        "term",
        "qtf",
        "df",
        F.round("qweight", DIGITS).alias("qweight"),
        F.round("qnorm", DIGITS).alias("qnorm"),
    )


def _top10(profile: Profile, make: Query, mode: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        index = _index(spark, sf, profile)
        vectors = query_vectors(index, make(spark, sf))
        return search_vectors(index, vectors.filter(F.col("mode") == mode)).drop("mode")

    return run


def _single_term_top10(profile: Profile) -> Query:
    return _top10(profile, _words, SINGLE)


def _cosine_top10(profile: Profile) -> Query:
    return _top10(profile, _benchmark_queries, COSINE)


def _cosine_pruned(profile: Profile) -> Query:
    """The same hits, without scoring the documents that can't be among them."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        index = _index(spark, sf, profile)
        vectors = query_vectors(index, _benchmark_queries(spark, sf))
        cosine = vectors.filter(F.col("mode") == COSINE)
        return search_vectors(index, cosine, prune=True).drop("mode")

    return run


def _vector_blocks(profile: Profile) -> Query:
    """Vectors of documents of any length, in blocks; here a document is all of a source."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        blocks = _repeated_index(spark, sf, profile).vector_blocks(Workspace(spark), VECTOR_BLOCK)
        weight_sum = F.aggregate("weights", F.lit(0.0), lambda total, w: total + w)
        return blocks.select(
            "doc_id",
            "block",
            "first_term",
            "last_term",
            F.size("terms").cast("bigint").alias("n_terms"),
            F.round(weight_sum, DIGITS).alias("weight_sum"),
        )

    return run


def _top2000(profile: Profile) -> Query:
    """More hits than Spark's own group limit has, of every word's search."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        index = _index(spark, sf, profile)
        vectors = query_vectors(index, _benchmark_queries(spark, sf))
        return search_vectors(index, vectors, k=2000).drop("mode")

    return run


def _search_batch(profile: Profile) -> Query:
    return lambda spark, sf: search(_index(spark, sf, profile), _mixed_queries(spark, sf)).hits


def _search_status(profile: Profile) -> Query:
    return lambda spark, sf: search(_index(spark, sf, profile), _mixed_queries(spark, sf)).status


def _hits_with_titles(profile: Profile) -> Query:
    return lambda spark, sf: search(
        _index(spark, sf, profile), _mixed_queries(spark, sf), titles=_titles(spark, sf)
    ).hits


def _hit_listing(profile: Profile) -> Query:
    titled = _hits_with_titles(profile)
    return lambda spark, sf: hit_lines(titled(spark, sf))


def _query_file(spark: SparkSession, sf: str) -> DataFrame:
    """The lines of all documents, written as one query file in parts and read."""
    lines = _documents(spark, sf).select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("position", "value")
    )
    path = Workspace(spark).path("query-file")
    lines.repartitionByRange("doc_id", "position").sortWithinPartitions("doc_id", "position").select(
        "value"
    ).write.text(path)
    return read_queries(spark, path)


def _corpus_tsv(spark: SparkSession, sf: str) -> DataFrame:
    """The documents, written as a tab-separated file and read as a corpus."""
    path = Workspace(spark).path("corpus-tsv")
    _documents(spark, sf).select(
        F.concat_ws("\t", "doc_id", F.regexp_replace("text", "[\r\n\t]", " ")).alias("value")
    ).write.text(path)
    return read_corpus_tsv(spark, path)


def _title_file(spark: SparkSession, sf: str) -> str:
    """The labels as a title file; toxic ones are short lines without a title."""
    path = Workspace(spark).path("titles-tsv")
    title = F.when(F.col("toxic") == 0, F.col("quality"))
    _table(spark, sf, "labels").select(
        F.concat_ws("\t", "doc_id", "toxic", title.cast("string")).alias("value")
    ).write.text(path)
    return path


def _search_term(profile: Profile) -> Query:
    """The public one-term route, for the word that most documents have."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        index = _index(spark, sf, profile)
        term = index.terms.orderBy(F.desc("df"), "term").first()["term"]
        return search_term(index, term)

    return run


def _loaded_index(profile: Profile) -> Query:
    """The cosine search once more, on an index opened by its path."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        index = load_index(spark, _index(spark, sf, profile).path)
        return search(index, _benchmark_queries(spark, sf)).hits.drop("mode")

    return run


def _search_custom_stops(profile: Profile) -> Query:
    """An index with a stop list of its own, loaded and searched without naming it."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        path = Workspace(spark).path("index")
        build_index(_documents(spark, sf), profile, path, stop_words=CUSTOM_STOPS)
        return search(load_index(spark, path), _mixed_queries(spark, sf)).hits

    return run


def _repeated(spark: SparkSession, sf: str) -> DataFrame:
    """Documents named by their source, which repeats; those of src0 have no name."""
    table = _table(spark, sf, "documents")
    named = table.select(F.nullif("source", F.lit("src0")).alias("doc_id"), "text")
    return named.filter(F.col("text").isNotNull()).repartition(spark.sparkContext.defaultParallelism)


def _repeated_index(spark: SparkSession, sf: str, profile: Profile) -> TextIndex:
    key = (spark.sparkContext.applicationId, sf, f"repeated {profile.name}")
    if key not in _indexes:
        path = Workspace(spark).path("index")
        _indexes[key] = build_index(_repeated(spark, sf), profile, path)
    return _indexes[key]


def _index_repeated_ids(profile: Profile) -> Query:
    return lambda spark, sf: _repeated_index(spark, sf, profile).weights().select(
        "doc_id", "term", "tf", "length", F.round("weight", DIGITS).alias("weight")
    )


def _search_repeated_ids(profile: Profile) -> Query:
    return lambda spark, sf: search(
        _repeated_index(spark, sf, profile), _benchmark_queries(spark, sf)
    ).hits


def _book_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """The documents of each source, written as one book by lines, and read."""
    path = _write_books(spark, sf)
    return read_book(spark, f"{path}/*", CHUNK_SIZE, by_folder=True).select(
        F.regexp_extract("path", "source=([^/]+)", 1).alias("source"), "chunk_id", "chunk"
    )


def _write_books(spark: SparkSession, sf: str) -> str:
    """A folder of text files for each source, in parts whose names are in the order of the ids.

    Ranges of (source, id) deal a large source to as many tasks as it needs.
    """
    path = Workspace(spark).path("books")
    table = _table(spark, sf, "documents").filter("text is not null")
    table.repartitionByRange("source", "doc_id").sortWithinPartitions("source", "doc_id").select(
        "source", F.col("text").alias("value")
    ).write.partitionBy("source").text(path)
    return path


def _book_mentions(spark: SparkSession, sf: str) -> DataFrame:
    """Names in the books of all sources, read in short chunks that are seen with their neighbours.

    Of names longer than what a chunk is seen with nothing is said.
    """
    path = _write_books(spark, sf)
    chunks = read_book(spark, f"{path}/*", SHORT_CHUNK, SHORT_OVERLAP, by_folder=True)
    return count_mentions(_short_names(extract_mentions(chunks)))


def _short_names(mentions: DataFrame) -> DataFrame:
    return mentions.filter(F.length("mention") < SHORT_OVERLAP)


def _mention_counts_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """What an extractor finds in short chunks of documents that are seen with their neighbours."""
    chunks = chunk_texts(_documents(spark, sf), SHORT_CHUNK, SHORT_OVERLAP)
    return count_mentions(_short_names(extract_mentions(chunks, _plain_names())))


def _titles_last(spark: SparkSession, sf: str) -> DataFrame:
    """One title per language from a file of all documents, the last one of each."""
    path = Workspace(spark).path("titles-lines")
    table = _table(spark, sf, "documents").select("doc_id", "lang", "source")
    # In parts whose names are in the order of the ids.
    table.repartitionByRange("doc_id").sortWithinPartitions("doc_id").select(
        F.concat_ws("\t", "lang", "doc_id", "source").alias("value")
    ).write.text(path)
    return one_title_per_id(read_titles_lines(spark, path, places=True), keep="last")


def _empty_inputs(spark: SparkSession, sf: str) -> DataFrame:
    """What a search gives for missing query and title files: rows of each."""
    missing = Workspace(spark).path("missing")
    none = read_queries(spark, missing, missing_ok=True)
    titles = read_titles_tsv(spark, missing, missing_ok=True)
    index = _index(spark, sf, NORMALIZED)
    nothing = search(index, none, titles=titles)
    untitled = search(index, _benchmark_queries(spark, sf), titles=titles).hits
    count = lambda table, name: table.agg(F.count("*").alias("n")).select(F.lit(name).alias("input"), "n")
    return (
        count(none, "queries")
        .unionByName(count(nothing.hits, "hits"))
        .unionByName(count(nothing.status, "status"))
        .unionByName(count(untitled.filter(F.col("title") == NORMALIZED.default_title), "untitled"))
    )


def _mention_counts(spark: SparkSession, sf: str) -> DataFrame:
    return count_mentions(extract_mentions(chunk_texts(_documents(spark, sf))))


def _mention_counts_custom(spark: SparkSession, sf: str) -> DataFrame:
    return count_mentions(extract_mentions(chunk_texts(_documents(spark, sf)), _plain_names()))


def _plain_names():
    import re

    names = re.compile("[A-Z][a-z]+(?: [A-Z][a-z]+)*")

    def extractor(text: str) -> list[str]:
        return names.findall(text)

    return extractor
