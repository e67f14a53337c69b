"""Large buckets of op7: what their comparisons hold in memory, and which rows get finer keys."""

import tracemalloc

import numpy as np
import pandas as pd

from wordtide.llm import ordered_minhash as om


def test_close_pairs_take_few_mb():
    """A pair of full blocks, whose rows are all alike in length and words, is compared in parts."""
    n = 2 * om.FAMILY_BLOCK
    words = np.random.default_rng(1).integers(0, 1 << 60, 100).astype(np.uint64)
    group = {"n": np.full(n, 100), "c": np.arange(n), "rep": np.arange(n), "block": np.arange(n) % 2, "bag": np.array([om.bag(words).tobytes()] * n, dtype=object)}
    tracemalloc.start()
    pairs = sum(len(x) for x in om._close_in(group))
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    kept = pairs * 16 / 1e6
    assert pairs == (n // 2) ** 2 and peak - kept < 60


def test_finer_keys_only_where_something_is_open(spark):
    """Buckets of one component, or of members of the family only, get no finer keys; all rows of the others do."""
    rests = [(seed, 1, rep, 9, core, [seed * 100, seed * 100 + 1]) for seed, rep, core in [(1, 10, False), (1, 11, True), (2, 10, False), (2, 12, False), (3, 11, True), (3, 13, True)]]
    rests = spark.createDataFrame(rests, "seed bigint, hub bigint, rep bigint, n int, core boolean, keys array<bigint>")
    own = spark.createDataFrame([(10, 10), (11, 11), (12, 10), (13, 13)], "rep bigint, c bigint")
    assert sorted((r["key"], r["rep"]) for r in om._finer(rests, own).collect()) == [(100, 10), (100, 11), (101, 10), (101, 11)]


def test_few_finer_keys_find_pairs_at_the_threshold():
    """Texts behind one passage get at most 12 keys each, whatever their number, and nearly all pairs at similarity 0.8 share one."""
    rng = np.random.default_rng(5)
    passage = [f"p{i}" for i in range(30)]
    hub, rows = " ".join(passage), []
    for _ in range(400):
        words = [f"w{i}" for i in rng.integers(0, 3000, 100)]
        copy = list(words)
        for i in rng.choice(100, 26, replace=False):  # 26 of 130 words: similarity 0.8
            copy[i] = f"x{rng.integers(0, 1_000_000)}"
        rows += [" ".join(passage + words), " ".join(passage + copy)]
    batch = pd.DataFrame({"seed": 1, "hub": -1, "rep": range(len(rows)), "n": 130, "text": rows, "hub_text": hub})
    (found,) = om._rest_rows([batch])
    keys = [set(k.tolist()) for k in found["keys"]]
    assert not found["core"].any() and max(map(len, keys)) <= 12
    assert sum(bool(a & b) for a, b in zip(keys[::2], keys[1::2], strict=True)) >= 0.95 * 400


def test_few_texts_are_looked_up_by_all_tasks(spark, monkeypatch, tmp_path):
    """Few pairs are aligned by one task; the join with all texts before it stays with the tasks that read these."""
    vocabulary = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(vocabulary[: 30 + i % 3] + [f"own{i // 3}"] * 9)) for i in range(600)]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(16).write.parquet(f"{tmp_path}/texts")
    texts = spark.read.parquet(f"{tmp_path}/texts")
    written = om.materialise
    plans = {}

    def kept(df, name, parts=None):
        plans[name] = (df._jdf.queryExecution().optimizedPlan().toString(), parts)
        return written(df, name, parts)

    monkeypatch.setattr(om, "materialise", kept)
    close = written(spark.createDataFrame([(0, 1), (0, 2), (3, 4), (0, 3)], "a bigint, b bigint"), "close")
    found = sorted((r["a"], r["b"]) for r in om._checked(close, texts).collect())
    assert found == [(0, 1), (0, 2), (3, 4)]
    plan, parts = plans["omh-links"]
    assert "omh-held" in plans and parts is None and "LeftSemi" not in plan
    monkeypatch.setattr(om, "HELD", 0)
    close = written(spark.createDataFrame([(0, 1), (0, 2), (3, 4), (0, 3)], "a bigint, b bigint"), "close")
    assert sorted((r["a"], r["b"]) for r in om._checked(close, texts).collect()) == found
    monkeypatch.setattr(om, "LOOKED_UP", 0)
    close = written(spark.createDataFrame([(0, 1), (0, 2), (3, 4), (0, 3)], "a bigint, b bigint"), "close")
    assert sorted((r["a"], r["b"]) for r in om._checked(close, texts).collect()) == found
