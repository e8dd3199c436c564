"""Exchange between partitions: certified ones are closed, and bins of every round are gapless."""

import numpy as np
import pytest

from labwatch.llm import packing
from labwatch.llm.packing import best_fit_decreasing, pack


def packed_bins(spark, lengths, capacity, rows_per_partition, **how):
    df = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "doc_id long, length long")
    rows = pack(df.repartition(3), capacity, rows_per_partition, **how).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(lengths)))
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return bins


@pytest.mark.parametrize("rows_per_partition", [1, 3, 17])
def test_long_pieces_in_tiny_partitions_leave_no_gaps(spark, rows_per_partition):
    random = np.random.default_rng(rows_per_partition)
    for lengths in (random.choice([3000, 1000], 200), random.integers(1, 4097, 150), random.choice([1366, 2731, 4096], 90)):
        bins = packed_bins(spark, lengths, 4096, rows_per_partition, rounds=8)
        apart = sum(len(best_fit_decreasing(lengths[i : i + rows_per_partition], 4096)[2]) for i in range(0, len(lengths), rows_per_partition))
        assert -(-lengths.sum() // 4096) <= len(bins) <= apart + 3


def test_certified_partitions_are_closed_and_others_exchange(spark, monkeypatch):
    labels, write = [], packing.stored
    monkeypatch.setattr(packing, "stored", lambda df, label: labels.append(label) or write(df, label))
    # No two fit one bin, which the bound tells: nothing is left to exchange.
    assert len(packed_bins(spark, [3000] * 40, 4096, 5)) == 40
    assert [n for n in labels if n.startswith("packed")] == ["packed-0"]
    labels.clear()
    random = np.random.default_rng(4)
    lengths = [3000] * 60 + random.integers(200, 2000, 60).tolist()
    bins = packed_bins(spark, lengths, 4096, 12)
    assert "packed-1" in labels and len(bins) <= 76
