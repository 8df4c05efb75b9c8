"""Near-dedup of the pipeline against brute force over five-word shingles."""

import random

import pytest

import corpus_pipeline
from pyspark.sql import functions as F

from cellweave.llm import common
from cellweave.llm import components as component_steps
from cellweave.llm import simhash, similar
from cellweave.session import write_stage


def _texts():
    """Texts of 200 words with 1 to 9 words replaced, a crowd of near copies, a chain, short, empty and null texts."""
    pick = random.Random(3)
    out = [None, "", " \n", "one two", "One  two", "one three"]
    for changed in range(1, 10):
        base = [f"w{changed}x{i}" for i in range(200)]
        edited = list(base)
        for at in range(changed):
            edited[10 + 20 * at] = "other"
        out += [" ".join(base), " ".join(edited)]
    crowd = [f"c{i}" for i in range(120)]
    for i in range(60):
        out.append(" ".join([*crowd[:-2], f"end{i}", f"tail{pick.randrange(1000)}"]))
    for step in range(4):
        out.append(" ".join(f"k{i}" for i in range(12 * step, 12 * step + 150)))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(_texts())], "doc_id long, text string")


def _groups(threshold):
    sets = [similar.shingles((t or "").encode()) for t in _texts()]
    name = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a == sets[j] or len(a & sets[j]) >= threshold * len(a | sets[j]) > 0:
                x, y = sorted((name[i], name[j]))
                name = [x if n == y else n for n in name]
    return dict(enumerate(name))


@pytest.mark.parametrize("first, few", [(0, 0), (2, 2)])
def test_components_match_brute_force(docs, monkeypatch, first, few):
    monkeypatch.setattr(similar, "FEW", few)
    monkeypatch.setattr(similar, "FIRST_ROUNDS", first)
    expected = _groups(0.8)
    assert 0 < sum(i == n for i, n in expected.items()) < len(expected)
    assert {r.doc_id: r.component_id for r in similar.near_duplicates(docs).collect()} == expected


def test_simhash_pivot_tables_name_candidates_first(docs, monkeypatch):
    """What the SimHash step links holds by itself, and covers texts that differ in few bits."""
    rows = similar.signatures(docs, 5)
    order = rows.groupBy("node").agg(F.min("place").alias("at"), *(F.first(c).alias(c) for c in ("n", "simhash", "keys")))
    nodes = order.select(F.col("at").alias("node"), "n", "simhash", "keys").cache()
    asked, joined = [], simhash.linked_prints
    monkeypatch.setattr(simhash, "linked_prints", lambda prints, *a: asked.append(prints.count()) or joined(prints, *a))
    found = similar.links_of(rows, nodes, 5, 0.8).count()
    linked = similar.print_links(nodes, rows.select(F.col("place").alias("node"), "text"), 5, 0.8).collect()
    assert asked == [nodes.filter("n > 0").count()] * 2 and 0 < len(linked) <= found
    texts = {r.place: shingle_set(r.text) for r in rows.collect()}
    assert all(len(texts[a] & texts[b]) >= 0.8 * len(texts[a] | texts[b]) for a, b in linked)


def test_keys_of_one_node_are_dropped(docs):
    rows = similar.signatures(docs, 5)
    nodes = rows.groupBy("node").agg(*(F.first(c).alias(c) for c in ("n", "keys"))).cache()
    held = similar.shared_keys(nodes)
    assert 0 < held.count() < nodes.agg(F.sum(F.size("keys"))).first()[0]
    assert held.groupBy("key").count().filter("count < 2").isEmpty()


def shingle_set(text):
    return similar.shingles((text or "").encode())


def test_empty_and_missing_keys(spark, docs):
    assert similar.near_duplicates(docs.filter("false")).count() == 0
    rows = spark.createDataFrame([(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (9, "g")], "doc_id long, text string")
    assert sorted((r.doc_id or -1, r.component_id) for r in similar.near_duplicates(rows).collect()) == [(-1, 4), (4, 4), (4, 4), (9, 9)]


def test_pipeline_keeps_one_of_each(spark, docs):
    kept = {r.doc_id for r in corpus_pipeline.keep_one_of_each(spark, docs, "").collect()}
    assert kept == {i for i, n in _groups(0.8).items() if i == n}


def test_pipeline_stages_judge_rows_by_themselves(spark, tmp_path):
    """Null, empty and repeated rows, and keys that clash, through the stages that drop rows."""
    item = " ".join(f"bench{i}" for i in range(14))
    clean = [(1, "a clean text of some words"), (1, "another text under the same key"), (None, "a text without a key"), (7, None)]
    # rows 7 and 8 are wordless and so linked; the three leaked texts are near copies of each other
    copies = [(2, "b c d e f g h i"), (2, "b c d e f g h i"), (None, "B c d e f g h i"), (None, "k l m n o p"), (None, "k l m n o p"), (8, "")]
    leaked = [(None, f"x {item} y"), (1, item), (3, f"{item} z")]
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in clean + copies + leaked], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(5, item)], "item_id int, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = lambda df: sorted((str(r.doc_id), str(r.text)) for r in df.collect())
    kept = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and rows(kept) == sorted((str(k), str(t)) for k, t in clean + copies)
    kept = corpus_pipeline.keep_one_of_each(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert rows(kept) == sorted((str(k), str(t)) for k, t in [*clean, copies[0], copies[3], leaked[1]])
    assert corpus_pipeline.keep_one_of_each(spark, docs.filter("false"), "").count() == 0
    changed = corpus_pipeline.replace_pii(spark, docs, "")
    assert changed.columns == docs.columns and changed.count() == docs.count()
    assert corpus_pipeline.tokenise(spark, docs, "").count() == docs.count()


def test_stars_take_no_round(spark, monkeypatch):
    written = []
    monkeypatch.setattr(component_steps, "write_stage", lambda df, label: written.append(label) or write_stage(df, label))
    found = component_steps.components(spark.createDataFrame([(5, 1), (1, 7), (9, 2), (9, 9)], "u long, v long"))
    assert {tuple(r) for r in found.collect()} == {(1, 1), (5, 1), (7, 1), (2, 2), (9, 2)}
    assert written == ["edges"]


def test_rounds_read_only_texts_with_a_shared_key(spark, monkeypatch):
    read, kept = [], similar.verified
    monkeypatch.setattr(similar, "verified", lambda pairs, texts, *rest: read.append(texts.count()) or kept(pairs, texts, *rest))
    near = [" ".join(["same"] * 5 + [f"n{i}" for i in range(100)] + [f"end{k}"]) for k in range(2)]
    alone = [" ".join(f"a{k}x{i}" for i in range(100)) for k in range(30)]
    docs = spark.createDataFrame(list(enumerate(near + alone)), "doc_id long, text string")
    assert similar.one_of_each(docs).count() == 31
    assert all(n < 10 for n in read[1:])


def test_slow_rounds_end_and_the_rest_is_compared(docs, monkeypatch):
    monkeypatch.setattr(similar, "FEW", 0)
    monkeypatch.setattr(similar, "SLOW", 0.0)
    found = {r["doc_id"]: r["component_id"] for r in similar.near_duplicates(docs).collect()}
    assert found == _groups(0.8)


def test_pipeline_holds_arrow_batches_small(spark, docs):
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    try:
        for rows, kept in ((10000, 1000), (0, 1000), (7, 7)):
            spark.conf.set(setting, str(rows))
            corpus_pipeline.hold_batches_small(spark)
            assert int(spark.conf.get(setting)) == kept
    finally:
        spark.conf.set(setting, before)


def test_rows_are_split_by_a_bit_table(spark, monkeypatch):
    rows, keys = spark.range(500).withColumn("text", F.lit("t")), spark.range(0, 500, 7).toDF("key")
    for bits in (24, 7):  # 128 bits are shared by many keys
        monkeypatch.setattr(common, "KEY_BITS", bits)
        asked, others = common.split_by_keys(rows, keys, "id")
        asked, others = ({r.id for r in part.collect()} for part in (asked, others))
        assert asked >= set(range(0, 500, 7)) and asked | others == set(range(500)) and not asked & others
    asked, others = common.split_by_keys(rows, keys.filter("false"), "id")
    assert asked.isEmpty() and others.count() == 500 and others.columns == rows.columns


@pytest.mark.parametrize("cell, shingles_held", [(64, 200_000), (7, 100), (1, 0)])
def test_pairs_are_verified_cell_by_cell(spark, monkeypatch, cell, shingles_held):
    monkeypatch.setattr(similar, "CELL", cell)
    monkeypatch.setattr(similar, "HELD_SHINGLES", shingles_held)
    texts = [" ".join([f"w{i}" for i in range(60)] + [f"x{k % 4}y{i}" for i in range(30)]) for k in range(40)]
    rows = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    pairs = [(a, b) for a in range(40) for b in range(a)]
    found = similar.verified(spark.createDataFrame(pairs, "a long, b long"), rows, 5, 0.8)
    assert sorted(map(tuple, found.collect())) == [(a, b) for a, b in pairs if a % 4 == b % 4]
    assert similar.verified(spark.createDataFrame([], "a long, b long"), rows, 5, 0.8).isEmpty()


def test_small_graphs_shuffle_nothing(spark, monkeypatch):
    edges = [(i, i + 1) for i in range(30)] + [(50, 40), (41, 50)]
    staged = []
    monkeypatch.setattr(component_steps, "write_stage", lambda df, label: staged.append(df.rdd.getNumPartitions()) or write_stage(df, label))
    for small in (1 << 17, 0):
        monkeypatch.setattr(component_steps, "SMALL", small)
        staged.clear()
        found = component_steps.components(spark.createDataFrame(edges, "u long, v long"))
        assert {tuple(r) for r in found.collect()} == {(i, 0) for i in range(31)} | {(i, 40) for i in (40, 41, 50)}
        assert len(staged) > 1 and (not small or set(staged[1:]) == {1})
