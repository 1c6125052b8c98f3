"""The lookup table by its rules, and placement."""

from collections import Counter

import pytest

from prospectra.llm import sharding
from prospectra.llm.queries import SHARD_NAMES


def test_shares_differ_by_one_slot():
    for slots in (101, sharding.SLOTS):
        shares = Counter(sharding.lookup_table(SHARD_NAMES, slots))
        assert len(shares) == 64 and max(shares.values()) - min(shares.values()) <= 1


def test_order_of_names_is_of_no_account():
    names = ["c", "a", "b"]
    first = [names[i] for i in sharding.lookup_table(names, 31)]
    other = sorted(names)
    assert first == [other[i] for i in sharding.lookup_table(other, 31)]


def test_few_slots_move_when_a_shard_goes():
    before = sharding.lookup_table(SHARD_NAMES)
    after = sharding.lookup_table(SHARD_NAMES[:-1])
    moved = sum(a != b for a, b in zip(before, after) if a != 63)
    assert moved < 0.02 * sharding.SLOTS


def test_refused():
    for names, slots in ((["a", "a"], 7), (["a"], 8), ([], 7), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            sharding.lookup_table(names, slots)


def test_placement(spark):
    rows = [(i % 40 if i else None, "x", i) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, shard string, slot int")
    placed = sharding.place(df, "doc_id", SHARD_NAMES).collect()
    table = sharding.lookup_table(SHARD_NAMES)
    assert len(placed) == 100
    assert all(table[r.slot] == r.shard and SHARD_NAMES[r.shard] == r.shard_name for r in placed)
    assert all(len({r.slot for r in placed if r.key == key}) == 1 for key in {r.key for r in placed})
    assert sharding.place(df.limit(0), "doc_id", SHARD_NAMES).count() == 0
