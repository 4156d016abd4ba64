import numpy as np
import pytest
from helpers import edges, empty
from pyspark.sql import functions as F
from wavelens.llm import sharding as sh

NAMES = [f"s{i}" for i in range(7)]


def by_turns(shards, slots):
    """The table by whole preference lists."""
    order = {}
    for name in shards:
        offset, skip = sh._number(f"offset:{name}") % slots, sh._number(f"skip:{name}") % (slots - 1) + 1
        order[name] = iter([(offset + k * skip) % slots for k in range(slots)])
    out, turn = {}, 0
    while len(out) < slots:
        name = shards[turn % len(shards)]
        slot = next(s for s in order[name] if s not in out)
        out[slot] = turn % len(shards)
        turn += 1
    return [out[s] for s in range(slots)]


def test_table_is_filled_by_turns():
    assert sh.lookup_table(NAMES, slots=101).tolist() == by_turns(NAMES, 101)


def test_even_and_weighted():
    assert np.ptp(np.bincount(sh.lookup_table(NAMES))) <= 1
    shares = np.bincount(sh.lookup_table(NAMES, [2, 1, 1, 1, 1, 1, 0], 10_007), minlength=7) / 10_007
    assert abs(shares[0] - 2 / 7) < 0.01 and shares[6] == 0


def test_a_leaving_shard_moves_little_else():
    before, after = sh.lookup_table(NAMES), sh.lookup_table(NAMES[:-1])
    stayed = before < 6
    assert (before[stayed] == after[stayed]).mean() > 0.9


@pytest.mark.parametrize("names, slots", [([], 101), (["a", "a"], 101), (["a"], 100), (list("abcde"), 5)])
def test_bad_tables(names, slots):
    with pytest.raises(ValueError):
        sh.lookup_table(names, slots=slots)


def test_placement_of_edges(spark):
    df = edges(spark).withColumn("SLOT", F.lit("old"))
    got = sh.place(df, "doc_id", NAMES, slots=101).collect()
    owner = sh.lookup_table(NAMES, slots=101)
    assert len(got) == df.count() and all(r["shard"] == NAMES[owner[r["slot"]]] for r in got)
    by_key = {}
    assert all(by_key.setdefault(r["doc_id"], r["shard"]) == r["shard"] for r in got)
    assert got[0].asDict().keys() == {"doc_id", "text", "source", "ROW", "slot", "shard"}


def test_written_shards(spark, tmp_path):
    placed = sh.place(spark.range(500), "id", NAMES)
    sh.write_shards(placed, str(tmp_path / "out"), files=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(back.select("id", "shard").collect()) == sorted(placed.select("id", "shard").collect())


def test_no_rows(spark):
    assert sh.place(empty(spark), "doc_id", NAMES).count() == 0
