"""Repeated lines and the filter audit against plain Python."""

import hashlib
import random
from itertools import permutations

import pytest

from termloom.llm import audit
from termloom.llm.audit import count_difference, filter_audit, gallop, union
from termloom.llm.lines import drop_repeated_lines
from termloom.operators import joins

SPACES = " \t\n\x0b\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = "A line that many of the documents hold"


def line_key(line):
    return line.strip(SPACES).translate(LOWER)


def brute_lines(rows, min_chars=20, min_docs=3):
    holders = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(line_key(line)) >= min_chars:
                holders.setdefault(line_key(line), set()).add(doc_id)
    keeper = {
        key: max((i for i in ids if i is not None), default=None)
        for key, ids in holders.items()
        if len(ids) >= min_docs
    }
    result = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if line_key(x) not in keeper or keeper[line_key(x)] == doc_id]
        result.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return result


LINE_ROWS = [
    (1, f"{LONG}\nown text of the first\n{LONG}"),
    (2, f"  {LONG.upper()}\t\nshort\n\n"),
    (3, f"{LONG}\r\nshort\n{LONG}\nshort"),
    (4, "short\nsmall\nshort"),
    (5, "ÀÉ wörter in der längeren Zeile"),
    (6, "àé wörter in der längeren Zeile"),
    (7, "ÀÉ WöRTER in der längeren Zeile\n"),
    (8, None),
    (9, ""),
    (10, "\n"),
    (11, f"{LONG[:19]}\n{LONG[:20]}"),
    (12, f"{LONG[:19]}\n{LONG[:20]}"),
    (13, f"{LONG[:19]}\n{LONG[:20]}\n\x0b \n"),
    (14, "wörter 🙂🙂🙂🙂🙂🙂🙂🙂🙂🙂🙂🙂"),
    (15, "wörter 🙂🙂🙂🙂🙂🙂🙂🙂🙂🙂🙂🙂🙂"),
    (16, "wörter 🙂🙂🙂🙂🙂🙂🙂🙂🙂🙂🙂🙂🙂"),
    (17, "wörter 🙂🙂🙂🙂🙂🙂🙂🙂🙂🙂🙂🙂🙂"),
]


def lines_of(table, **options):
    rows = drop_repeated_lines(table, **options).collect()
    return sorted(
        [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in rows], key=lambda r: (r[0] is None, r)
    )


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r))


def test_repeated_lines(documents, clashing):
    assert lines_of(clashing(documents(LINE_ROWS))) == in_order(brute_lines(LINE_ROWS))
    lost = {r[0]: r[3] for r in lines_of(documents(LINE_ROWS))}
    assert (lost[1], lost[2], lost[3]) == (2, 1, 0)


def test_rows_of_one_id_and_rows_without_are_one_document(documents):
    rows = [(1, LONG), (1, LONG), (1, f"{LONG}\nother"), (2, LONG)]
    assert [r[3] for r in lines_of(documents(rows))] == [0, 0, 0, 0]
    rows += [(None, f"{LONG}\nkept"), (None, f"{LONG}\nkept"), (None, LONG)]
    assert lines_of(documents(rows)) == in_order(brute_lines(rows))
    assert [r[3] for r in lines_of(documents(rows)) if r[0] is None] == [1, 1, 1]


@pytest.mark.parametrize("head", [500_000, 2])
def test_random_lines(documents, monkeypatch, head):
    """Also with few hot hashes broadcast, and texts shuffled."""
    monkeypatch.setattr(joins, "BROADCAST_KEY_BYTES", 1 if head == 2 else 1 << 25)
    monkeypatch.setattr("termloom.llm.lines.BROADCAST_ROWS", head)
    rng = random.Random(3)
    pool = [f"line number {i:03d} of the pool {'x' * (i % 3)}" for i in range(40)]
    rows = [
        (i, "\n".join(rng.choice(pool) if rng.random() < 0.6 else f"line of its own {i} {k}" for k in range(rng.randint(0, 30))))
        for i in range(80)
    ]
    assert lines_of(documents(rows)) == in_order(brute_lines(rows))
    assert lines_of(documents(rows), min_docs=9, min_chars=25) == in_order(brute_lines(rows, 25, 9))


def test_a_long_text_of_repeated_lines(documents):
    """200,000 lines, all dropped but the last, in time that follows their number."""
    text = "\n".join(f"one of very many lines {i}" for i in range(200_000))
    rows = [(i, text if i < 4 else "x") for i in range(5)]
    found = {r[0]: r for r in lines_of(documents(rows))}
    assert [found[i][3] for i in range(4)] == [200_000] * 3 + [0]
    assert found[0][1] == "" and found[3][1] == text


def test_no_rows(documents, spark):
    assert drop_repeated_lines(documents([])).collect() == []
    assert filter_audit(documents([]), spark.createDataFrame([], LABELS)).collect() == []


def test_the_query_of_lines(spark, sf):
    from termloom.llm.queries import op12_line_dedup

    table = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()]
    expected = sorted(
        (i, n, lost, hashlib.sha256(text.encode()).hexdigest()) for i, text, n, lost in brute_lines(rows)
    )
    assert sorted(tuple(row) for row in op12_line_dedup(spark, sf).collect()) == expected


def test_no_python_in_the_plan_of_lines(spark, sf):
    from termloom.llm.queries import op12_line_dedup

    plan = op12_line_dedup(spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


# Audit

LABELS = "doc_id bigint, quality int, toxic int"


def brute_audit(rows, labels):
    best = {}
    for doc_id, quality, toxic in labels:
        if doc_id is not None:
            old = best.get(doc_id, (0, 0))
            best[doc_id] = (max(old[0], quality or 0), max(old[1], toxic or 0))
    least = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    judged = {}
    for doc_id, text, lang in rows:
        text = text or ""
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
        fails = "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words))
        fails += "C" * (100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text))
        fails += "D" * any(c in "#$%&*|" for c in text)
        fails += "E" * (doc_id is not None and doc_id > least[text])
        judged.setdefault(lang or "", []).append((set(fails), *best.get(doc_id, (0, 0))))
    result = set()
    for part, docs in judged.items():
        removed_by, lines = {}, []
        for order in permutations("ABCDE"):
            left = docs
            for step, name in enumerate(order, start=1):
                out = [d for d in left if name in d[0]]
                left = [d for d in left if name not in d[0]]
                removed_by[name] = removed_by.get(name, 0) + len(out)
                lines.append((order, step, name, left, out))
        for order, step, name, left, out in lines:
            result.add(
                (
                    part, "".join(order), step, len(left), len(out),
                    sum(name in d[0] for d in docs) - len(out),
                    sum(d[0] == {name} for d in docs),
                    sum(d[1] == 1 for d in out), sum(d[2] == 1 for d in out), removed_by[name],
                )
            )
    return result


def audit_rows(n, seed=5):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["W", "THE", "50%", "a|b"]
    rows = []
    for i in range(n):
        pool = words if rng.random() < 0.5 else words[: rng.randint(1, 400)]
        text = " ".join(rng.choice(pool) for _ in range(rng.choice([0, 1, 150, 199, 200, 201, 400])))
        if rows and rng.random() < 0.3:
            text = rng.choice(rows)[1]
        rows.append((i, text, rng.choice(["en", "de", "", None])))
    rows += [(n, None, "en"), (n + 1, "", None), (None, "", "de"), (None, rows[0][1], "de"), (3, rows[3][1], "en")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, n, 2)]
    return rows, labels + [(2, 1, 0), (2, 0, 1), (None, 1, 1), (10**9, 1, 1)]


@pytest.mark.parametrize("bits", [16, 2])
def test_audit_against_plain_counts(documents, clashing, spark, monkeypatch, bits):
    monkeypatch.setattr(audit, "BLOCK_BITS", bits)
    rows, labels = audit_rows(120)
    table = clashing(documents(rows))
    found = filter_audit(table, clashing(spark.createDataFrame(labels, LABELS)).drop("label"))
    got = [tuple(row) for row in found.collect()]
    assert found.columns == [
        "part", "filter_order", "step", "kept", "removed", "redundant",
        "unique_fails", "good_lost", "toxic_lost", "shapley",
    ]
    assert len(got) == 3 * 600 and set(got) == brute_audit(rows, labels)


def test_audit_with_copies_joined_by_shuffle(documents, spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_KEY_BYTES", 1)
    rows, labels = audit_rows(60, seed=6)
    got = filter_audit(documents(rows), spark.createDataFrame(labels, LABELS)).collect()
    assert {tuple(row) for row in got} == brute_audit(rows, labels)


def test_a_part_that_fails_nothing_has_its_rows(documents, spark):
    text = " ".join(f"word{i}" for i in range(300))
    rows = [(1, text, "en")]
    got = filter_audit(documents(rows), spark.createDataFrame([], LABELS)).collect()
    assert len(got) == 600 and all(tuple(row)[3:] == (1, 0, 0, 0, 0, 0, 0) for row in got)


def test_merges_against_sets():
    rng = random.Random(0)
    for _ in range(2000):
        lists = [sorted(rng.sample(range(60), rng.randint(0, 60))) for _ in range(rng.randint(0, 5))]
        assert union(lists) == sorted(set().union(*lists))
        if len(lists) > 1:
            assert count_difference(lists[0], lists[1]) == len(set(lists[0]) - set(lists[1]))
        for ids in lists[:1]:
            start, wanted = rng.randint(0, len(ids)), rng.randint(0, 61)
            low = gallop(ids, wanted, start)
            assert all(x < wanted for x in ids[start:low]) and all(x >= wanted for x in ids[low:])
