"""Random order and batches: exact, reproducible and independent of partitioning."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradlake.operators import ordering as O


def expected_order(ids, epoch, seed=42):
    def key(i):
        text = hashlib.md5(f"{seed}:{i}".encode()).hexdigest()
        words = [divmod(int(t, 16), 2**30) for t in (text[:15], text[15:30])]
        return [(a * epoch + b) % (2**30 - 35) for a, b in words], i

    return sorted(ids, key=key)


@pytest.fixture
def ids(spark):
    return spark.range(0, 6000, 2, 5).withColumnRenamed("id", "row_id")


def placed(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_permutation_is_the_sorted_order(ids):
    found = placed(O.epoch_permutation(ids, (1, 2)), "epoch", "pos", "row_id")
    for epoch in (1, 2):
        order = [r for _, _, r in sorted(f for f in found if f[0] == epoch)]
        assert order == expected_order(range(0, 6000, 2), epoch)
    assert expected_order(range(0, 6000, 2), 1) != expected_order(range(0, 6000, 2), 2)


@pytest.mark.parametrize("cuts", [0, 2**16])
@pytest.mark.parametrize("size", [1, 3, 100, 999, 1000, 2999, 3000])
def test_batches_match_the_order(ids, monkeypatch, size, cuts):
    monkeypatch.setattr(O, "MOST_CUTS", cuts)
    found = placed(O.assign_batches(ids, size, (3,)), "batch", "row_id")
    order = expected_order(range(0, 6000, 2), 3)
    n = 3000 // size
    assert {(p // size, r) for p, r in enumerate(order) if p // size < n} == set(found)
    assert len(found) == n * size


def test_many_batches_are_ranked_where_they_lie(ids):
    """No cut keys, no interval join and one move of the rows."""
    order = O.measure_order(ids, (1, 2))
    found = O.assign_units(ids, order, 3, 3000)
    assert O.MOST_CUTS < 2**17 and O.default_bits(2**30, 2**29) == O.FEW_BITS
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(O, "MOST_CUTS", 0)
        patch.setattr(O, "_cut_keys", None)
        ranked = O.assign_units(ids, order, 3, 3000)
        text = ranked._jdf.queryExecution().explainString(ranked.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert text.count("Exchange hashpartitioning") == 1 and "low_key" not in text
    assert set(placed(ranked, "epoch", "batch", "row_id")) == set(placed(found, "epoch", "batch", "row_id"))


def test_many_epochs_are_measured_in_passes(ids, monkeypatch):
    """Only full buckets are split further, and epochs beyond one pass are no error."""
    want = O.measure_order(ids, range(1, 21), bits=9)
    monkeypatch.setattr(O, "FEW_BITS", 3)
    monkeypatch.setattr(O, "BUCKET_ROWS", 16)
    monkeypatch.setattr(O, "MAX_BUCKETS", 2**11)
    found = O.measure_order(ids, range(1, 21))
    assert found.bits == 8 and found.epochs == tuple(range(1, 21)) and O.epochs_per_pass(8) < 20
    assert np.array_equal(found.counts, want.counts.reshape(20, -1, 2).sum(2))


def test_units_may_end_inside_a_unit(ids):
    order = O.measure_order(ids, (1,))
    found = placed(O.assign_units(ids, order, 700, 2500, unit="block"), "block", "row_id")
    assert {(p // 700, r) for p, r in enumerate(expected_order(range(0, 6000, 2), 1)[:2500])} == set(found)


@pytest.mark.parametrize("bits", [2, 8, 11, 20])
def test_any_number_of_buckets_gives_the_same_batches(ids, bits):
    order = O.measure_order(ids, (1,), bits=bits)
    found = placed(O.assign_batches(ids, 450, (1,), order=order), "batch", "row_id")
    assert set(found) == set(placed(O.assign_batches(ids, 450, (1,)), "batch", "row_id"))


def test_lookup_without_broadcast(ids, monkeypatch):
    want = set(placed(O.assign_batches(ids, 450, (1,)), "batch", "row_id"))
    monkeypatch.setattr(O, "MAX_BROADCAST_ENTRIES", 0)
    assert set(placed(O.assign_batches(ids, 450, (1,)), "batch", "row_id")) == want


def test_result_does_not_depend_on_partitions(spark, ids):
    want = set(placed(O.assign_batches(ids, 450, (1,)), "batch", "row_id"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        assert set(placed(O.assign_batches(ids.repartition(11), 450, (1,)), "batch", "row_id")) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_zero_means_one_batch(ids):
    found = O.assign_batches(ids, 0, (1, 2)).groupBy("epoch", "batch").count().collect()
    assert sorted(map(tuple, found)) == [(1, 0, 3000), (2, 0, 3000)]


def test_too_large_batch(ids):
    with pytest.raises(ValueError, match="larger than"):
        O.assign_batches(ids, 3001)


def test_hot_repeated_id_is_refused(ids):
    hot = ids.withColumn("row_id", F.when(F.col("row_id") % 3 == 0, F.lit(5)).otherwise(F.col("row_id")))
    with pytest.raises(ValueError, match="row ids repeat"):
        O.measure_order(hot, (1,))


def test_single_repeated_id_is_refused(spark, ids):
    twice = ids.union(spark.createDataFrame([(10,)], "row_id bigint"))
    with pytest.raises(Exception, match="row ids repeat"):
        O.epoch_permutation(twice).collect()


def test_prefix(ids):
    assert O.prefix(ids, 100).count() == 50


def test_natural_order(spark):
    names = ["run-10-a.json", "run-9-a.json", "run-100-a.json", "run-9-b.json", "run-010-a.json", "a2", "run", "run-9-a2.json"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    found = [r["name"] for r in O.natural_order(df, "name").collect()]
    pieces = lambda n: [(len(p.lstrip("0")), int(p)) if p.isdigit() else p for p in re.findall("[0-9]+|[^0-9]+", n)]
    assert found == sorted(sorted(names), key=pieces)
    assert found[:2] == ["a2", "run"] and found[-1] == "run-100-a.json"


def test_bucket_counts_add_up(ids):
    order = O.measure_order(ids, (1, 2))
    assert order.rows == 3000
    assert np.array_equal(order.starts[:, 0], [0, 0])
    assert order.counts.sum() == 6000


@pytest.mark.parametrize("rows", [40, 500, 5000])
def test_runs_of_buckets(ids, rows):
    order = O.measure_order(ids, (1, 2), bits=8)
    found = placed(O.assign_runs(ids, order, rows, 2000), "epoch", "block", "first_pos", "order_key", "row_id")
    for epoch in (1, 2):
        mine = sorted((f[1:] for f in found if f[0] == epoch), key=lambda f: f[2])
        want = expected_order(range(0, 6000, 2), epoch)
        assert [f[3] for f in mine] == want[: len(mine)] and len(mine) >= 2000
        first = {block: min(i for i, f in enumerate(mine) if f[0] == block) for block in {f[0] for f in mine}}
        assert all(first[f[0]] == f[1] for f in mine)
        assert [f[0] for f in mine] == sorted(f[0] for f in mine)


def test_orders_of_different_epochs_are_unrelated():
    """Rank correlation of any two of several epochs stays within what chance allows."""
    place = np.array([np.argsort(expected_order(range(3000), e)) for e in range(1, 7)])
    related = np.corrcoef(place) - np.eye(6)
    assert np.abs(related).max() < 5 / np.sqrt(3000)


def test_equal_keys_fall_back_to_the_id(ids, monkeypatch):
    """With keys of only a few values, cuts fall between rows of the same key."""
    monkeypatch.setattr(O, "order_key", lambda epoch: (F.col("_low") % 5) * 2**57)
    monkeypatch.setattr(O, "_check_fill", lambda order: None)
    found = O.assign_batches(ids, 70, (1,))
    assert sorted(r["count"] for r in found.groupBy("batch").count().collect()) == [70] * 42
    ordered = O.epoch_permutation(ids).select("row_id", F.expr("pos div 70").alias("batch")).where("batch < 42")
    assert ordered.exceptAll(found.select("row_id", "batch")).count() == 0


def test_a_stored_order_reads_only_the_stretches_of_a_batch(spark, ids, tmp_path):
    order = O.epoch_permutation(ids, (1, 2))
    stored = O.store_order(order, str(tmp_path / "order"), 700)
    want = expected_order(range(0, 6000, 2), 2)
    for batch in (0, 6, 7, 29):  # the seventh goes over the edge of a stretch
        found = O.stored_batch(ids, stored, 100, batch, 2)
        assert sorted(placed(found, "slot", "row_id")) == list(enumerate(want[batch * 100 : batch * 100 + 100]))
    plan = stored.between(650, 749, 2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(epoch" in plan and "stretch" in plan.split("PartitionFilters")[1].split("]")[0]
    scanned = stored.between(650, 749, 2).select(F.input_file_name().alias("f")).distinct().collect()
    assert {r["f"].split("stretch=")[1].split("/")[0] for r in scanned} == {"0", "1"}
