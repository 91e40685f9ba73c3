"""The TF-IDF index: built once as Parquet tables, then searched many times.

Tables under the index path:

``bags``      doc_id, length, n_terms, bag: one row per document row, as read
``lengths``   doc_id, length: only when document ids repeat
``counts``    doc_id, term, tf, length: likewise, rows with one id merged
``terms``     term, df, idf, bucket: in folders by bucket, sorted by term
``postings``  term, tier, doc_id, tf, length, df, share, bucket: in folders by bucket, sorted
``blocks``    term, tier, n, top_share, bucket: likewise, postings of a tier and
              the most that one of them can add to a cosine
``docs``      doc_id, length, norm: documents that have at least one token
``stats``     one row of totals, written last: an index without it is unfinished

``bucket`` is a hash of the term. A search joins on it, so Spark prunes the
folders that hold none of the searched terms before it reads a byte of them. Terms
have Bloom filters, so a search for few terms skips the files that lack them.
Postings keep the factors of a weight, which repeat and pack to almost nothing, for
single-term searches, and the share, weight / norm of the document, for cosines: a
number of its own in every row, but with it a search needs no join by document. With
df, which packs to nothing too, all weights can be read without a join by term.

A term's postings fall into tiers by share: each tier holds the shares within a factor of two. What makes a block is the share
and not the range of ids, since ids come in no order that means anything: 64 ids in
a row hold some good document for nearly every query. Terms in few documents have
one tier. `termloom.plans.pruning` searches by blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.functions.exact import SQUARES, exact_sum
from termloom.functions.stop_words import ENGLISH
from termloom.functions.weights import document_tf, idf, share_of
from termloom.operators.chunks import running_total
from termloom.operators.corpus import bag_of_words, tokenize_corpus
from termloom.operators.frequency import document_frequency
from termloom.operators.joins import Size, join_by_load, measure, with_heavy_load
from termloom.plans.workspace import Workspace
from termloom.profiles import Profile

# At 10^13 postings a task's sorted postings come to about 2 GB of Parquet, sorted with
# spilling. That is 20,000 tasks: few enough for the blocks of a shuffle, one for every
# pair of tasks.
POSTINGS_PER_TASK = 500_000_000
SMALLEST_TASK = 50_000
# Up to MANY_TASKS, tasks have no more than so many postings, which they sort in memory.
SORTED_PER_TASK = 2_000_000
MANY_TASKS = 20_000
# A term with more of a task's postings than this share is dealt to several tasks.
HOT_SHARE = 8
# Small buckets let a search read little. Beyond MANY_BUCKETS they grow with the
# index until they hold a task's postings, and from there on their number does.
POSTINGS_PER_BUCKET = 1_000_000
MANY_BUCKETS = 8192
# Terms in more documents have tiers. The last one also takes all smaller shares.
TIERED_FROM = 256
LAST_TIER = 30
# Terms of a vector block.
BLOCK_TERMS = 10_000


@dataclass(frozen=True)
class IndexStats:
    n_docs: int
    n_tokens: int
    n_postings: int
    n_terms: int
    term_bytes: int
    buckets: int
    unique_ids: bool
    profile: str
    stop_words: list[str]
    posting_df: bool | None = None


@dataclass(frozen=True)
class TextIndex:
    """Handle on a written index; every property is a lazy DataFrame."""

    spark: SparkSession
    path: str
    profile: Profile
    stats: IndexStats
    doc_id_type: T.DataType

    @property
    def bags(self) -> DataFrame:
        return self.spark.read.schema(_bags_schema(self.doc_id_type)).parquet(f"{self.path}/bags")

    @property
    def terms(self) -> DataFrame:
        return self.spark.read.schema(TERMS).parquet(f"{self.path}/terms")

    @property
    def postings(self) -> DataFrame:
        return self.spark.read.schema(_postings_schema(self.doc_id_type)).parquet(
            f"{self.path}/postings"
        )

    @property
    def blocks(self) -> DataFrame:
        return self.spark.read.schema(BLOCKS).parquet(f"{self.path}/blocks")

    @property
    def docs(self) -> DataFrame:
        return self.spark.read.schema(_docs_schema(self.doc_id_type)).parquet(f"{self.path}/docs")

    @property
    def term_size(self) -> Size:
        return Size(self.stats.n_terms, self.stats.term_bytes)

    def bucket_of(self, term: Column) -> Column:
        return _bucket(term, self.stats.buckets)

    def counts(self) -> DataFrame:
        """(doc_id, term, tf, length) in document order."""
        if self.stats.unique_ids:
            return _explode_bags(self.bags)
        return self.spark.read.schema(_counts_schema(self.doc_id_type)).parquet(
            f"{self.path}/counts"
        )

    def weights(self) -> DataFrame:
        """(doc_id, term, tf, length, df, idf, weight) for the whole corpus, from one scan.

        Postings of an index that was written before they had df are joined with the terms.
        """
        if not self.stats.posting_df:
            return _weigh(self.counts(), self.terms, self.profile, self.stats.n_postings, self.term_size)
        postings = self.spark.read.schema(_weighed_schema(self.doc_id_type)).parquet(f"{self.path}/postings")
        return _weights(postings, self.profile, self.stats.n_docs)

    def vectors(self) -> DataFrame:
        """(doc_id, vector map of term to weight): a view for one-document use.

        Each map is one value, so a document's terms must fit into one row;
        `vector_blocks` has no such bound.
        """
        entry = F.struct("term", "weight")
        return (
            self.weights()
            .groupBy("doc_id")
            .agg(F.map_from_entries(F.collect_list(entry)).alias("vector"))
        )

    def vector_blocks(self, workspace: Workspace, size: int = BLOCK_TERMS) -> DataFrame:
        """(doc_id, block, first_term, last_term, terms, weights): vectors of any length.

        Terms rise within a document; every block but its last has ``size`` of
        them. The table is sorted by document and block, so a lookup by document
        and range of terms (`vector_entries`) skips the others' row groups.

        Entries are numbered over the whole corpus by totals of short runs, so
        neither a long document nor a common term is one task's work.
        """
        weighed = self.weights().select("doc_id", "term", "weight")
        order = ["doc_id", "term"]
        placed = workspace.save(
            weighed.repartitionByRange(*order).sortWithinPartitions(*order).select(
                "*",
                F.lit("").alias("path"),
                F.spark_partition_id().cast("bigint").alias("block"),
                F.monotonically_increasing_id().alias("seq"),
            ),
            "entries",
        )
        numbered = workspace.save(
            running_total(placed, F.lit(1), "place", by_file=False).select(*order, "weight", "place"),
            "numbered",
        )
        starts = workspace.save(
            numbered.groupBy("doc_id").agg(F.min("place").alias("start"), F.count("*").alias("n")), "starts"
        )
        inside = join_by_load(
            numbered, starts, "doc_id", "n", self.stats.n_postings, measure(starts, "doc_id")
        )
        blocks = (
            inside.groupBy("doc_id", F.floor((F.col("place") - F.col("start")) / size).alias("block"))
            .agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("entries"))
            .select(
                "doc_id",
                "block",
                F.element_at("entries", 1)["term"].alias("first_term"),
                F.element_at("entries", -1)["term"].alias("last_term"),
                F.col("entries.term").alias("terms"),
                F.col("entries.weight").alias("weights"),
            )
        )
        order = ["doc_id", "block"]
        return workspace.save(blocks.repartitionByRange(*order).sortWithinPartitions(*order), "vectors")


def vector_entries(blocks: DataFrame, doc_id, first: str, last: str) -> DataFrame:
    """(term, weight) of one document's terms from ``first`` to ``last``.

    The three conditions on columns of the blocks reach the Parquet reader.
    """
    near = blocks.filter(
        F.col("doc_id").eqNullSafe(F.lit(doc_id)) & (F.col("last_term") >= first) & (F.col("first_term") <= last)
    )
    return near.select(F.inline(F.arrays_zip("terms", "weights"))).select(
        F.col("terms").alias("term"), F.col("weights").alias("weight")
    ).filter(F.col("term").between(first, last))


def build_index(
    documents: DataFrame,
    profile: Profile,
    path: str,
    buckets: int | None = None,
    stop_words: Iterable[str] = ENGLISH,
) -> TextIndex:
    """Index (doc_id, text) under ``path``, which must not exist yet.

    The text is read and tokenised once. When ids are unique, which one scan of
    the id column tells, counting needs no shuffle; when they repeat, rows with
    the same id are merged first.
    """
    spark = documents.sparkSession
    stop_words = sorted(set(stop_words))
    doc_id_type = documents.schema["doc_id"].dataType

    tokens = tokenize_corpus(documents, profile, stop_words)
    bag_of_words(tokens).write.parquet(f"{path}/bags")
    bags = spark.read.schema(_bags_schema(doc_id_type)).parquet(f"{path}/bags")

    by_id = bags.groupBy("doc_id").agg(
        F.count("*").alias("rows"),
        F.sum("length").alias("length"),
        F.sum("n_terms").alias("n_terms"),
    )
    totals = by_id.agg(
        F.sum("rows").alias("n_docs"),
        F.sum("length").alias("n_tokens"),
        F.sum("n_terms").alias("n_postings"),
        (F.max("rows") == 1).alias("unique_ids"),
    ).first()
    n_docs, n_tokens, unique_ids = totals["n_docs"], totals["n_tokens"], totals["unique_ids"]
    if not n_docs:
        raise ValueError("no documents to index")

    if unique_ids:
        counts, n_postings = _explode_bags(bags), totals["n_postings"]
    else:
        counts = _merge_bags(bags, n_tokens, path)
        n_postings = counts.count()

    if buckets is None:
        buckets = bucket_count(n_postings)
    buckets = max(1, buckets)

    # Every term stands once here, so a dictionary would only be in the way of the filter.
    document_frequency(counts).select(
        "term",
        "df",
        idf(profile, F.lit(n_docs), F.col("df")).alias("idf"),
        _bucket(F.col("term"), buckets).alias("bucket"),
    ).repartition("bucket").sortWithinPartitions("bucket", "term").write.partitionBy(
        "bucket"
    ).options(**_term_filter(n_postings // buckets, dictionary=False)).parquet(f"{path}/terms")
    terms = spark.read.schema(TERMS).parquet(f"{path}/terms")
    term_size = measure(terms, "term")

    known = _weigh(counts, terms, profile, n_postings, term_size)
    square = F.col("weight") * F.col("weight")
    exact_sum(
        known, ["doc_id"], square, "squares", SQUARES, F.max("length").alias("length"), F.count("*").alias("n_terms")
    ).select("doc_id", "length", F.sqrt("squares").alias("norm"), "n_terms").write.parquet(f"{path}/docs")
    docs = spark.read.schema(_docs_schema(doc_id_type)).parquet(f"{path}/docs")

    if unique_ids:
        # Norms meet the documents' rows, not their postings, which are many more.
        normed = _explode_bags(_with_norms(bags, docs), "norm")
    else:
        norms = docs.select("doc_id", "norm", "n_terms")
        normed = join_by_load(counts, norms, "doc_id", "n_terms", n_postings, measure(docs, "doc_id"))
    hot = with_heavy_load(normed, terms, "term", "df", _sort_tasks(spark, n_postings)[1])
    _by_term(hot, buckets, n_postings, lambda dealt: _with_tiers(dealt, profile, n_docs)).write.partitionBy(
        "bucket"
    ).options(**_term_filter(term_size.rows // buckets)).parquet(f"{path}/postings")
    _blocks(spark, path, doc_id_type)

    stats = IndexStats(
        n_docs=n_docs,
        n_tokens=n_tokens,
        n_postings=n_postings,
        n_terms=term_size.rows,
        term_bytes=term_size.key_bytes,
        buckets=buckets,
        unique_ids=unique_ids,
        profile=profile.to_json(),
        stop_words=stop_words,
        posting_df=True,
    )
    spark.range(1).select(
        *[_literal(getattr(stats, f.name)).cast(f.dataType).alias(f.name) for f in STATS]
    ).coalesce(1).write.parquet(f"{path}/stats")
    return TextIndex(spark, path, profile, stats, doc_id_type)


def load_index(spark: SparkSession, path: str) -> TextIndex:
    row = spark.read.schema(STATS).parquet(f"{path}/stats").first()
    if row is None:
        raise ValueError(f"{path} holds no finished index")
    doc_id_type = spark.read.parquet(f"{path}/bags").schema["doc_id"].dataType
    stats = IndexStats(**row.asDict())
    return TextIndex(spark, path, Profile.from_json(stats.profile), stats, doc_id_type)


def bucket_count(n_postings: int) -> int:
    """Folders for so many postings."""
    return max(
        1,
        min(MANY_BUCKETS, -(-n_postings // POSTINGS_PER_BUCKET)),
        -(-n_postings // POSTINGS_PER_TASK),
    )


def task_count(n_postings: int, cores: int) -> int:
    """Tasks for so many postings; small indexes use the cores there are."""
    return max(1, -(-n_postings // POSTINGS_PER_TASK), min(cores, n_postings // SMALLEST_TASK))


def _literal(value) -> Column:
    return F.array(*[F.lit(item) for item in value]) if isinstance(value, list) else F.lit(value)


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def _explode_bags(bags: DataFrame, *others: str) -> DataFrame:
    return bags.select("doc_id", "length", *others, F.inline("bag")).select(
        "doc_id", "term", "tf", "length", *others
    )


def _with_norms(bags: DataFrame, docs: DataFrame) -> DataFrame:
    """Bags of documents with tokens, by a shuffle of one row for each document at most.

    Shuffled rows hold the terms as one text, which packs to less than half of an array
    of structs. Profiles cut texts at white space, so no term has a space in it.
    """
    norms = docs.select(F.col("doc_id").alias("_id"), "norm")
    same = F.col("doc_id").eqNullSafe(F.col("_id"))
    if measure(docs, "doc_id").broadcastable:
        return bags.join(F.broadcast(norms), same).drop("_id")
    packed = bags.select(
        "doc_id", "length", F.array_join("bag.term", " ").alias("terms"), F.col("bag.tf").alias("tf")
    )
    return (
        packed.join(norms.hint("merge"), same)
        .select("doc_id", "length", "norm", F.split("terms", " ").alias("term"), "tf")
        .select("doc_id", "length", "norm", F.arrays_zip("term", "tf").alias("bag"))
    )


def _merge_bags(bags: DataFrame, n_tokens: int, path: str) -> DataFrame:
    """Counts over rows that share an id, written because three steps read them."""
    merged = _explode_bags(bags).groupBy("doc_id", "term").agg(F.sum("tf").alias("tf"))
    bags.groupBy("doc_id").agg(F.sum("length").alias("length")).write.parquet(f"{path}/lengths")
    lengths = bags.sparkSession.read.parquet(f"{path}/lengths")
    size = measure(lengths, "doc_id")
    lengths = lengths.withColumn("load", F.col("length"))
    join_by_load(merged, lengths, "doc_id", "load", n_tokens, size).select(
        "doc_id", "term", "tf", "length"
    ).write.parquet(f"{path}/counts")
    return bags.sparkSession.read.schema(_counts_schema(bags.schema["doc_id"].dataType)).parquet(
        f"{path}/counts"
    )


def _with_tiers(dealt: DataFrame, profile: Profile, n_docs: int) -> DataFrame:
    """Tier and share of postings that are dealt by term and have the norm of their document.

    A term without df is not hot: all its postings are in one task, and counted there.
    """
    in_task = F.count("*").over(Window.partitionBy("term", "_task"))
    counted = dealt.withColumn("df", F.coalesce("df", in_task))
    share = share_of(_weight(profile, n_docs), F.col("norm"))
    octave = F.when(F.col("share") > 0, F.least(F.floor(-F.log2("share")), F.lit(LAST_TIER)))
    tier = F.when(F.col("df") <= TIERED_FROM, 0).otherwise(F.coalesce(octave, F.lit(LAST_TIER)))
    return counted.withColumn("share", share).select(
        "term", tier.cast("int").alias("tier"), "doc_id", "tf", "length", "df", "share", "_task"
    )


def _sort_tasks(spark: SparkSession, n_postings: int) -> tuple[int, int]:
    """Tasks that sort the postings, and of how many documents a term may be that goes to one."""
    cores = spark.sparkContext.defaultParallelism
    tasks = max(task_count(n_postings, cores), min(MANY_TASKS, n_postings // SORTED_PER_TASK))
    return tasks, max(1, n_postings // tasks // HOT_SHARE)


def _by_term(
    postings: DataFrame,
    buckets: int,
    n_postings: int,
    finish: Callable[[DataFrame], DataFrame] = lambda dealt: dealt,
) -> DataFrame:
    """Postings dealt to tasks by the number of their bucket, which needs no sample of them.

    Tasks that are more than the buckets share one by the hash of the term. A term with
    many documents, whose ``df`` must be given, is dealt by these to as many tasks as it
    needs. ``finish`` is given the dealt postings, with their task, before they are sorted.
    """
    tasks, hot_from = _sort_tasks(postings.sparkSession, n_postings)
    bucket = _bucket(F.col("term"), buckets)
    pieces = -(-tasks // buckets)
    of_bucket = bucket * pieces + F.pmod(F.xxhash64("term", F.lit(pieces)), F.lit(pieces))
    cold = F.floor(of_bucket * tasks / (buckets * pieces))
    piece = F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("df") / hot_from))
    hot = F.pmod(F.xxhash64("term", piece), F.lit(tasks))
    task = F.when(F.col("df") > hot_from, hot).otherwise(cold).cast("int")
    dealt = postings.withColumn("_task", task).repartitionById(tasks, "_task")
    return (
        finish(dealt)
        .withColumn("bucket", bucket)
        .drop("_task")
        .sortWithinPartitions("bucket", "term", "tier", "doc_id")
    )


def _blocks(spark: SparkSession, path: str, doc_id_type: T.DataType) -> None:
    """Sizes and bounds of the tiers, from the written postings."""
    postings = spark.read.schema(_postings_schema(doc_id_type)).parquet(f"{path}/postings")
    postings.groupBy("bucket", "term", "tier").agg(
        F.count("*").alias("n"), F.max("share").alias("top_share")
    ).select("term", "tier", "n", "top_share", "bucket").repartition("bucket").sortWithinPartitions(
        "bucket", "term", "tier"
    ).write.partitionBy("bucket").parquet(f"{path}/blocks")


def _term_filter(terms: int, dictionary: bool = True) -> dict[str, str]:
    """Write options for a Bloom filter on the term, sized for so many terms a file.

    A column that fits its dictionary needs none, and Parquet then writes none.
    """
    return {
        "parquet.bloom.filter.enabled#term": "true",
        "parquet.bloom.filter.expected.ndv#term": str(max(1000, terms)),
        "parquet.enable.dictionary#term": str(dictionary).lower(),
    }


def _weigh(
    counts: DataFrame,
    terms: DataFrame,
    profile: Profile,
    n_postings: int,
    term_size: Size,
) -> DataFrame:
    known = terms.select("term", "df", F.col("df").alias("load"), "idf")
    return join_by_load(counts, known, "term", "load", n_postings, term_size).select(
        "doc_id",
        "term",
        "tf",
        "length",
        "df",
        "idf",
        (document_tf(profile, F.col("tf"), F.col("length")) * F.col("idf")).alias("weight"),
    )


def _weights(postings: DataFrame, profile: Profile, n_docs: int) -> DataFrame:
    """Postings with df weighed as `_weigh` weighs counts, without a join."""
    return postings.select(
        "doc_id",
        "term",
        "tf",
        "length",
        "df",
        idf(profile, F.lit(n_docs), F.col("df")).alias("idf"),
        _weight(profile, n_docs).alias("weight"),
    )


def _weight(profile: Profile, n_docs: int) -> Column:
    return document_tf(profile, F.col("tf"), F.col("length")) * idf(profile, F.lit(n_docs), F.col("df"))


def _schema(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


STATS = _schema(
    ("n_docs", T.LongType()),
    ("n_tokens", T.LongType()),
    ("n_postings", T.LongType()),
    ("n_terms", T.LongType()),
    ("term_bytes", T.LongType()),
    ("buckets", T.LongType()),
    ("unique_ids", T.BooleanType()),
    ("profile", T.StringType()),
    ("stop_words", T.ArrayType(T.StringType())),
    ("posting_df", T.BooleanType()),
)
BLOCKS = _schema(
    ("term", T.StringType()),
    ("tier", T.IntegerType()),
    ("n", T.LongType()),
    ("top_share", T.DoubleType()),
    ("bucket", T.IntegerType()),
)
TERMS = _schema(
    ("term", T.StringType()),
    ("df", T.LongType()),
    ("idf", T.DoubleType()),
    ("bucket", T.IntegerType()),
)


def _bags_schema(doc_id: T.DataType) -> T.StructType:
    entry = _schema(("term", T.StringType()), ("tf", T.LongType()))
    return _schema(
        ("doc_id", doc_id),
        ("length", T.LongType()),
        ("n_terms", T.LongType()),
        ("bag", T.ArrayType(entry)),
    )


def _counts_schema(doc_id: T.DataType) -> T.StructType:
    return _schema(
        ("doc_id", doc_id),
        ("term", T.StringType()),
        ("tf", T.LongType()),
        ("length", T.LongType()),
    )


def _postings_schema(doc_id: T.DataType) -> T.StructType:
    return _schema(
        ("term", T.StringType()),
        ("tier", T.IntegerType()),
        ("doc_id", doc_id),
        ("tf", T.LongType()),
        ("length", T.LongType()),
        ("share", T.DoubleType()),
        ("bucket", T.IntegerType()),
    )


def _weighed_schema(doc_id: T.DataType) -> T.StructType:
    """What weights are made of; searches have df from the terms."""
    return _schema(
        ("term", T.StringType()),
        ("doc_id", doc_id),
        ("tf", T.LongType()),
        ("length", T.LongType()),
        ("df", T.LongType()),
    )


def _docs_schema(doc_id: T.DataType) -> T.StructType:
    return _schema(
        ("doc_id", doc_id),
        ("length", T.LongType()),
        ("norm", T.DoubleType()),
        ("n_terms", T.LongType()),
    )
