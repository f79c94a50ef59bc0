"""Orphan references against a brute-force reading of the rules."""

import random

import pytest

from loomtable.operators.references import orphan_references, orphan_report, pack_bits, references_of, unpack_bits

SCHEMA = "rid bigint, sid string, at string, key string, period string, table_name string"


def refs(spark, rows):
    df = spark.createDataFrame([(r, s, a, "x", "y", "z") for r, s, a in rows], SCHEMA)  # clashing extra columns
    return references_of(df, "t", "rid", "sid", "at", "^(agg$|pref_)")


def parents(spark, rows):
    return spark.createDataFrame(rows, "key string, valid_from string, valid_to string")


def found(spark, r, p):
    return sorted((x.record_id, x.reason) for x in orphan_references(refs(spark, r), parents(spark, p)).collect())


@pytest.mark.parametrize("positions", [[], [0], [32767], list(range(100, 9000)), list(range(0, 32768, 2)), [1, 2, 3, 900]])
def test_containers_hold_what_was_put_in(positions):
    import numpy as np

    flags = np.zeros(32768, bool)
    flags[positions] = True
    packed = pack_bits(flags)
    assert (unpack_bits(packed) == flags).all()
    assert len(packed) <= 4097
    assert not unpack_bits(None).any()


def test_reasons_and_forms_of_ids(spark):
    p = [("A1", "2024-02-10 00:00:00", "2024-05-05 12:00:00"), (None, None, None), ("b", None, None)]
    r = [
        (1, " ａ1 ", "2024-03-01 00:00:00"),  # known
        (2, "A1", "2024-02-09 23:59:59"),  # a second too early, in the month of creation
        (3, "a1", "2024-02-10 00:00:00"),
        (4, "a1", "2024-05-05 12:00:00"),  # removed at that moment
        (5, "a1", "2024-05-05 11:59:59"),
        (6, "a1", None),  # tested on existence only
        (7, "zz", None),
        (8, None, "2024-03-01 00:00:00"),
        (9, "　 ", "2024-03-01 00:00:00"),
        (10, "AGG", "2024-03-01 00:00:00"),
        (11, "pref_9", "2024-03-01 00:00:00"),
        (12, "a1", "yesterday"),  # an irregular time compares as text
        (13, "b", "1999-01-01 00:00:00"),
        (14, "a1", "2030-01-01 00:00:00"),
        (15, "a1", "2020-01-01 00:00:00"),
    ]
    assert found(spark, r, p) == [(2, "too_early"), (4, "removed"), (7, "unknown"), (12, "removed"), (14, "removed"), (15, "too_early")]


def test_repeated_rows_and_empty_tables(spark):
    r = [(1, "q", "2024-01-01 00:00:00")] * 3
    assert found(spark, r, [("x", None, None)]) == [(1, "unknown")] * 3
    assert found(spark, r, []) == [(1, "unknown")] * 3
    assert found(spark, [], [("x", None, None)]) == []


def test_random_spans_against_brute_force(spark):
    rng = random.Random(3)
    time = lambda: f"2024-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d} 00:00:00"
    p = [(f"k{rng.randint(0, 40)}", rng.choice([None, time()]), rng.choice([None, None, time()])) for _ in range(60)]
    r = [(i, f"k{rng.randint(0, 50)}", rng.choice([None, time(), time()])) for i in range(800)]
    want = sorted(
        i
        for i, k, t in r
        if not any(k == pk and (t is None or (a is None or t >= a) and (b is None or t < b)) for pk, a, b in p)
    )
    assert [x for x, _ in found(spark, r, p)] == want


def test_spans_that_are_no_times_and_begin_anew(spark):
    p = [("k", "2024-01-05", "2024-03-02"), ("k", "2024-03-20", None), ("odd", "early", None), ("odd2", None, "soon"), ("back", "2024-05-01", "2024-02-01")]
    r = [(1, "k", "2024-02-10"), (2, "k", "2024-03-10"), (3, "k", "2024-03-25"), (4, "k", "2026-01-01"), (5, "k", "2023-12-31"), (6, "odd", "2024-01-01"), (7, "odd", "later"), (8, "odd2", "2024-01-01"), (9, "odd2", "z"), (10, "back", "2024-03-03"), (11, "back", None)]
    want = [i for i, k, t in r if not any(k == pk and (t is None or (a is None or t >= a) and (b is None or t < b)) for pk, a, b in p)]
    assert [x for x, _ in found(spark, r, p)] == want == [2, 5, 6, 9, 10]


def test_walks_go_on_across_batches(spark):
    rng = random.Random(9)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        p = [(f"k{i}", f"20{rng.randint(10, 24)}-{rng.randint(1, 12):02d}-05", None if i % 3 else f"20{rng.randint(15, 25)}-01-20") for i in range(60)]
        r = [(i, f"k{rng.randint(0, 70)}", f"20{rng.randint(9, 25):02d}-{rng.randint(1, 12):02d}-10") for i in range(500)]
        want = [i for i, k, t in r if not any(k == pk and t >= a and (b is None or t < b) for pk, a, b in p)]
        assert [x for x, _ in found(spark, r, p)] == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_report(spark):
    rr = refs(spark, [(1, "x", "2024-01-02 00:00:00"), (2, "y", "2024-01-03 00:00:00"), (3, "y", None)])
    report = {(x.period): x for x in orphan_report(rr, orphan_references(rr, parents(spark, [("x", None, None)]))).collect()}
    assert report["2024-01"].n_references == 2 and report["2024-01"].n_orphans == 1 and report["2024-01"].orphan_share == 0.5
    assert report["(none)"].n_unknown == 1
