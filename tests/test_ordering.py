import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.operators import ordering as o


def test_value_positions_and_quantiles(spark, both_ways):
    rng = np.random.default_rng(0)
    groups = {"hot": rng.integers(0, 40, 600).astype(float), "cold": rng.normal(size=37), "one": np.array([3.0])}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r for r in o.quantiles(df, ["g"], ["v"], [0.25, 0.5, 0.98]).collect()}
    for g, vs in groups.items():
        for p, name in ((0.25, "v__q25"), (0.5, "v__q50"), (0.98, "v__q98")):
            assert got[g][name] == pytest.approx(np.quantile(vs, p))


def test_quantiles_count_implicit_zeros(spark, both_ways):
    df = spark.createDataFrame([("a", 4.0), ("a", 8.0), ("b", 2.0)], "k string, v double")
    zeros = spark.createDataFrame([("a", 2), ("b", 0), ("c", 5)], "k string, zeros long")
    got = {r.k: r["v__q75"] for r in o.quantiles(df, ["k"], ["v"], [0.75], zeros=zeros).collect()}
    assert got == {"a": pytest.approx(np.quantile([0, 0, 4, 8], 0.75)), "b": 2.0, "c": 0.0}


def test_null_keys_and_values(spark, both_ways):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", None), ("a", 5.0)], "k string, v double")
    got = {r.k: r["v__q50"] for r in o.quantiles(df, ["k"], ["v"], [0.5]).collect()}
    assert got == {None: 2.0, "a": 5.0}


def test_number_rows_matches_window(spark, both_ways):
    rng = np.random.default_rng(1)
    rows = [("hot" if i % 3 else f"k{i % 7}", int(p)) for i, p in enumerate(rng.permutation(500))]
    df = spark.createDataFrame(rows, "k string, pos long")
    got = {(r.k, r.pos): r.n for r in o.number_rows(df, ["k"], "pos", name="n").collect()}
    for key in {k for k, _ in rows}:
        ordered = sorted(p for k, p in rows if k == key)
        assert [got[(key, p)] for p in ordered] == list(range(1, len(ordered) + 1))


def test_first_n(spark, both_ways):
    df = spark.range(300).withColumn("v", F.col("id") * 2)
    assert sorted(r.id for r in o.first_n(df, "v", 7).collect()) == list(range(7))
    assert o.first_n(df, "v", 0).count() == 0 and o.first_n(df, "v", 1000).count() == 300


ODD = [(1, 5.0), (2, None), (3, -1.0), (4, 3.0), (5, float("nan")), (6, float("inf")), (7, float("-inf")), (8, None), (9, 3.0), (10, -0.0)]


def test_odd_order_values_give_the_rows_of_a_plain_sort(spark, both_ways):
    df = spark.createDataFrame(ODD, "id long, v double")
    whole = [r.v for r in df.orderBy("v").collect()]
    for n in range(len(ODD) + 2):
        assert sorted(map(repr, (r.v for r in o.first_n(df, "v", n).collect()))) == sorted(map(repr, whole[:n]))
    numbered = {r.row_no: r.v for r in o.number_rows(df, [], "v").collect()}
    assert [repr(numbered[i]) for i in range(1, len(ODD) + 1)] == list(map(repr, whole))


def test_order_column_must_be_a_number(spark):
    with pytest.raises(TypeError):
        o.first_n(spark.createDataFrame([("a",)], "v string"), "v", 1)


def _bh(p):
    p = np.asarray(p)
    order = np.argsort(p)[::-1]
    m = len(p)
    out, low = np.empty(m), 1.0
    for rank, i in zip(range(m, 0, -1), order):
        low = min(low, p[i] * m / rank)
        out[i] = low
    return out


def test_bh_adjust(spark, both_ways):
    rng = np.random.default_rng(2)
    sets = {"a": np.round(rng.random(200) ** 2, 2), "b": np.array([0.01, 0.01, 0.5, 1.0]), "c": np.array([0.2])}
    rows = [(g, i, float(p)) for g, ps in sets.items() for i, p in enumerate(ps)]
    df = spark.createDataFrame(rows, "g string, i int, p double")
    got = {(r.g, r.i): r.p_adj for r in o.bh_adjust(df, ["g"], "p").collect()}
    for g, ps in sets.items():
        assert [got[(g, i)] for i in range(len(ps))] == pytest.approx(_bh(ps).tolist())


def test_small_and_large_keys_are_placed_alike(spark, monkeypatch, capsys):
    """Small keys are placed whole, without a join of all rows; large ones by ranges, with the same positions."""
    from cellweave.operators import ordering

    rows = [(k, float(v % 7 + 1), 1 + v % 2) for k, size in (("a", 5), ("b", 40), (None, 9)) for v in range(size)]
    counts = spark.createDataFrame(rows, "key string, value double, n long")
    ordering.value_positions(counts, ["key"], "value", "n").explain()
    assert "Join" not in capsys.readouterr().out
    whole = ordering.value_positions(counts, ["key"], "value", "n").drop(ordering.RANGE)
    monkeypatch.setattr(ordering, "WHOLE_KEY", 10)
    cut = ordering.value_positions(counts, ["key"], "value", "n").select(*whole.columns)
    assert sorted(map(str, whole.collect())) == sorted(map(str, cut.collect()))
