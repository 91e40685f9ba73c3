"""What each of several filters removes, in every order they can be applied in.

Each row gets a place, a number that rises through the written table, and every
2^16 places are a block. For each part (a language, say) and block the places that
fail a filter are one sorted posting list, and so are those with a good and a
toxic label. A set of filters removes the union of their lists. Unions come from
k-way merges that gallop: of the lists' heads the smallest is taken, its list is
searched in doubling steps for the next list's head, and the run up to there is
copied at once. What is in a label's list and not removed is a difference,
searched the same way. Only sizes leave a block; they are summed per part and set
of filters, and every column is a sum or difference of these 2^n sizes.

No list is longer than a block, whatever share of the rows one part, filter or
text has. Copies are found by a hash of 128 bits of the text; the least id of a
hash meets the rows by `join_by_load`, so a text of a third of all rows is
broadcast, not shuffled. Of n filters there are n! orders and 2^n sizes a part.

A null text is an empty one, a null part is ''. Repeated rows count once each and
are no copies of each other, nor is a row without an id of any. An id with
several labels has the largest; ids without a label are neither good nor toxic.
An empty table has no parts and gives no row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import labelled, prepare_workers
from termloom.operators.joins import Size, join_by_load
from termloom.plans.workspace import Workspace

SPACES = " \t\n\x0b\f\r"
GAP = r"[\x20\x09-\x0D]+"
BLOCK_BITS = 16
GOOD, TOXIC = "good", "toxic"

Ids = list[int]

# Failure conditions over the columns of `measures`.
FILTERS: dict[str, Callable[[], Column]] = {
    "A": lambda: F.col("n_words") < 200,
    "B": lambda: 100 * F.col("n_distinct") < 50 * F.col("n_words"),
    "C": lambda: 100 * F.col("n_capitals") > 3 * F.col("n_chars"),
    "D": lambda: F.col("has_symbol"),
}
# Fails a text that a smaller id has as well.
COPIES = "E"


def filter_audit(
    documents: DataFrame,
    labels: DataFrame,
    part: str = "lang",
    filters: dict[str, Callable[[], Column]] | None = None,
    workspace: Workspace | None = None,
) -> DataFrame:
    """One row per part, order of the filters and step of it.

    (part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley). Names of filters are single characters.
    """
    workspace = workspace or Workspace(documents.sparkSession)
    filters = FILTERS if filters is None else filters
    names = [*filters, COPIES]
    verdicts = workspace.save(_verdicts(documents, part, filters), "verdicts")
    lists = workspace.save(posting_lists(verdicts, labels, names, workspace), "postings")
    sizes = union_sizes(verdicts, lists, names, workspace)
    return _steps(sizes, names)


def measures(documents: DataFrame, part: str) -> DataFrame:
    """(doc_id, part, n_words, n_distinct, n_capitals, n_chars, has_symbol, a, b)."""
    texts = documents.select(
        "doc_id",
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    split = texts.select("*", F.split(F.btrim("text", F.lit(SPACES)), GAP).alias("words"))
    # The words of a text without any are one empty string.
    has_words = F.element_at("words", 1) != ""
    return split.select(
        "doc_id",
        "part",
        F.when(has_words, F.size("words")).otherwise(0).alias("n_words"),
        F.when(has_words, F.size(F.array_distinct("words"))).otherwise(0).alias("n_distinct"),
        F.length(F.regexp_replace("text", "[^A-Z]+", "")).alias("n_capitals"),
        F.length("text").alias("n_chars"),
        F.col("text").rlike(r"[#$%&*|]").alias("has_symbol"),
        F.xxhash64("text").alias("a"),
        F.xxhash64(F.lit(1), "text").alias("b"),
    )


def posting_lists(
    verdicts: DataFrame, labels: DataFrame, names: list[str], workspace: Workspace
) -> DataFrame:
    """(part, block, one sorted array of places per filter, good, toxic)."""
    entry = ["part", "place", "list"]
    failing = verdicts.select("part", "place", F.explode("fails").alias("list"))
    copies = _copies(verdicts, workspace).withColumn("list", F.lit(COPIES)).select(entry)
    entries = failing.unionByName(copies)
    for name, label in ((GOOD, "quality"), (TOXIC, "toxic")):
        marked = labelled(labels, label).filter(F.col("label") == 1).select("doc_id")
        rows = verdicts.select("doc_id", "part", "place").join(marked, "doc_id")
        entries = entries.unionByName(rows.select("part", "place", F.lit(name).alias("list")))
    block = F.shiftright("place", BLOCK_BITS).alias("block")
    return entries.groupBy("part", block).agg(
        *[
            F.sort_array(F.collect_list(F.when(F.col("list") == name, F.col("place")))).alias(name)
            for name in (*names, GOOD, TOXIC)
        ]
    )


def union_sizes(
    verdicts: DataFrame, lists: DataFrame, names: list[str], workspace: Workspace
) -> DataFrame:
    """(part, subset, n_docs, size, good, toxic): rows that some filter of the subset fails.

    ``subset`` has bit i set for the i-th name.
    """
    prepare_workers(lists.sparkSession)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column("part")
            columns = {name: batch.column(name) for name in (*names, GOOD, TOXIC)}
            for row in range(batch.num_rows):
                held = {name: column[row].values.to_pylist() for name, column in columns.items()}
                found = subset_sizes([held[name] for name in names], held[GOOD], held[TOXIC])
                subsets, sizes, good, toxic = (pa.array(values, pa.int64()) for values in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [parts.take(pa.array([row] * len(subsets))), subsets, sizes, good, toxic],
                    names=["part", "subset", "size", "good", "toxic"],
                )

    counted = (
        lists.mapInArrow(count, "part string, subset long, size long, good long, toxic long")
        .groupBy("part", "subset")
        .agg(*[F.sum(name).alias(name) for name in ("size", "good", "toxic")])
    )
    parts = verdicts.groupBy("part").agg(F.count("*").alias("n_docs"))
    subsets = F.sequence(F.lit(0).cast("long"), F.lit(2 ** len(names) - 1).cast("long"))
    every = parts.select("part", "n_docs", F.explode(subsets).alias("subset"))
    return workspace.save(every.join(counted, ["part", "subset"], "left").fillna(0), "sizes")


def subset_sizes(lists: list[Ids], good: Ids, toxic: Ids) -> list[tuple[int, int, int, int]]:
    """(subset, size of the union, its good ones, its toxic ones) of every non-empty subset."""
    sizes = []
    for subset in range(1, 1 << len(lists)):
        removed = union([ids for i, ids in enumerate(lists) if subset >> i & 1])
        sizes.append(
            (
                subset,
                len(removed),
                len(good) - count_difference(good, removed),
                len(toxic) - count_difference(toxic, removed),
            )
        )
    return sizes


def gallop(ids: Ids, wanted: int, start: int) -> int:
    """The first place from ``start`` on with an id of at least ``wanted``.

    Steps double until one goes too far, then the last one is bisected.
    """
    step, low, end = 1, start, len(ids)
    while low < end and ids[low] < wanted:
        start, low = low + 1, low + step
        step *= 2
    high = min(low, end)
    while start < high:
        middle = (start + high) // 2
        if ids[middle] < wanted:
            start = middle + 1
        else:
            high = middle
    return start


def union(lists: list[Ids]) -> Ids:
    """The ids of sorted lists without repeats, each once, sorted."""
    open_lists = [[ids[0], ids, 0] for ids in lists if ids]
    merged: Ids = []
    while len(open_lists) > 1:
        open_lists.sort(key=lambda opened: opened[0])
        head, ids, at = first = open_lists[0]
        bound = open_lists[1][0]
        if head == bound:
            at += 1
        else:
            stop = gallop(ids, bound, at + 1)
            merged += ids[at:stop]
            at = stop
        if at == len(ids):
            open_lists.pop(0)
        else:
            first[0], first[2] = ids[at], at
    for _, ids, at in open_lists:
        merged += ids[at:]
    return merged


def count_difference(ids: Ids, others: Ids) -> int:
    """How many of the sorted ``ids`` are not in the sorted ``others``."""
    left = len(ids)
    at = there = 0
    while at < len(ids) and there < len(others):
        if ids[at] == others[there]:
            left -= 1
            at += 1
            there += 1
        elif ids[at] < others[there]:
            at = gallop(ids, others[there], at + 1)
        else:
            there = gallop(others, ids[at], there + 1)
    return left


def _verdicts(documents: DataFrame, part: str, filters: dict[str, Callable[[], Column]]) -> DataFrame:
    fails = F.array_compact(
        F.array(F.lit(None).cast("string"), *[F.when(test(), F.lit(name)) for name, test in filters.items()])
    )
    return measures(documents, part).select(
        "doc_id", "part", F.monotonically_increasing_id().alias("place"), fails.alias("fails"), "a", "b"
    )


def _copies(verdicts: DataFrame, workspace: Workspace) -> DataFrame:
    """Rows whose text a smaller id has."""
    several = workspace.save(
        verdicts.groupBy("a", "b")
        .agg(F.count("*").alias("rows"), F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .filter(F.col("least") < F.col("most"))
        .select(F.struct("a", "b").alias("text_hash"), "rows", "least"),
        "copies",
    )
    total = several.agg(F.count("*").alias("texts"), F.sum("rows").alias("rows")).first()
    return join_by_load(
        verdicts.select("part", "place", "doc_id", F.struct("a", "b").alias("text_hash")),
        several,
        "text_hash",
        "rows",
        total["rows"] or 0,
        Size(total["texts"], 64 * total["texts"]),
    ).filter(F.col("doc_id") > F.col("least"))


def _steps(sizes: DataFrame, names: list[str]) -> DataFrame:
    spark = sizes.sparkSession
    whole = 2 ** len(names) - 1
    rows = []
    for order in permutations(range(len(names))):
        before = 0
        for step, name in enumerate(order, start=1):
            rows.append(
                ("".join(names[i] for i in order), step, before, before | 1 << name, 1 << name, whole ^ 1 << name)
            )
            before |= 1 << name
    # n! * n rows, whatever the input.
    steps = F.broadcast(
        spark.createDataFrame(
            rows, "filter_order string, step int, before long, after long, alone long, others long"
        )
    )
    table = sizes.join(steps, F.col("subset") == F.col("before")).select(
        "part", "n_docs", *steps.columns, *[F.col(name).alias(f"{name}_before") for name in ("size", "good", "toxic")]
    )

    def with_sizes(table: DataFrame, subset: str, *columns: str) -> DataFrame:
        """The sizes of the subset that a column names, by equality of part and subset."""
        other = sizes.select("part", F.col("subset").alias(subset), *[F.col(c).alias(f"{c}_{subset}") for c in columns])
        return table.join(other, ["part", subset])

    table = with_sizes(table, "after", "size", "good", "toxic")
    table = with_sizes(table, "alone", "size")
    table = with_sizes(table, "others", "size")
    all_fail = sizes.filter(F.col("subset") == whole).select("part", F.col("size").alias("size_all"))
    table = table.join(all_fail, "part")
    removed = F.col("size_after") - F.col("size_before")
    shapley = (
        table.groupBy("part", "alone").agg(F.sum(removed).alias("shapley"))
    )
    return table.join(shapley, ["part", "alone"]).select(
        "part",
        "filter_order",
        "step",
        (F.col("n_docs") - F.col("size_after")).alias("kept"),
        removed.alias("removed"),
        (F.col("size_alone") - removed).alias("redundant"),
        (F.col("size_all") - F.col("size_others")).alias("unique_fails"),
        (F.col("good_after") - F.col("good_before")).alias("good_lost"),
        (F.col("toxic_after") - F.col("toxic_before")).alias("toxic_lost"),
        "shapley",
    )
