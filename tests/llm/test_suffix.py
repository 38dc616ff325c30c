"""Repeated passages against a table of all passages."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from lakejobs.llm.suffix_dedup import Lengths, repeated_passages

BY = Lengths(least=12, group=3, reach=7)


def brute(rows, least):
    """doc -> words covered by a passage of the least length that stands twice."""
    places = defaultdict(list)
    for k, (_, t) in enumerate(rows):
        words = (t or "").split()
        for i in range(len(words) - least + 1):
            places[tuple(words[i : i + least])].append((k, i))
    covered = defaultdict(set)
    for where in places.values():
        if len(where) > 1:
            for k, i in where:
                covered[rows[k][0]] |= set(range(i, i + least))
    return covered


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=3))
    text = lambda n: [word() for _ in range(n)]
    rows = [text(rng.randint(0, 80)) for _ in range(40)]
    shared = [text(n) for n in (11, 12, 13, 20, 30)]
    for _ in range(25):
        own = text(rng.randint(0, 40))
        at = rng.randint(0, len(own))
        part = rng.choice(shared)
        cut = part[rng.randint(0, 3) : len(part) - rng.randint(0, 3)]
        rows.append(own[:at] + cut + own[at:])
    base = text(60)
    for _ in range(10):
        near = list(base)
        for _ in range(rng.randint(0, 4)):
            near[rng.randrange(60)] = word()
        rows.append(near)
    rows += [["x"] * 40, ["x", "y"] * 20, ["x"] * 12, base, base]
    out = [(k, " ".join(r)) for k, r in enumerate(rows)]
    return out + [(900, None), (901, ""), (902, "  \n")]


@pytest.mark.parametrize("seed, partitions", [(1, 1), (2, 7), (3, 40)])
def test_against_all_passages(spark, seed, partitions):
    rows = corpus(seed)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = repeated_passages(df, by=BY).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = brute(rows, BY.least)
    have = defaultdict(set)
    for r in got:
        new = set(range(r.start_word, r.end_word))
        assert not new & have[r.doc_id] and r.n_words == len(new) >= BY.least
        have[r.doc_id] |= new
        assert r.other_id in want
    assert {k: v for k, v in have.items()} == {k: v for k, v in want.items() if v}


def test_repeated_and_null_ids(spark):
    t = " ".join(f"w{i}" for i in range(60))
    rows = [(None, t), (5, t), (5, t), (6, "short"), (6, t + " more")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.start_word, r.end_word) for r in repeated_passages(df).collect())
    assert got == [(0, 0, 60), (5, 0, 60), (6, 0, 60)]
    assert repeated_passages(df.limit(0)).count() == 0


def test_query_against_all_passages(spark):
    """The registered query over a whole given table."""
    from lakejobs.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = brute([(r.doc_id, r.text) for r in docs], 50)
    have = defaultdict(set)
    for r in QUERIES["op3_suffix_array_dedup"](spark, sf).collect():
        have[r.doc_id] |= set(range(r.start_word, r.end_word))
    assert {k: v for k, v in have.items()} == {k: v for k, v in want.items() if v}


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = [q for q in entry.queries() if q[2:3].isdigit()]
    assert [int(q[2:].split("_")[0]) for q in names] == list(range(1, 14))
    assert "pipeline" in entry.queries()
