import os

import pytest
from pyspark.sql import functions as F

from cellweave.operators import checks
from cellweave.sources import manifest, text
from cellweave.streaming import catalog as stream


@pytest.fixture
def small_splits(spark):
    """Cut files into many read blocks."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, val in before.items():
        spark.conf.set(k, val)


def _write(path, body):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(body)


def test_matrix_market_over_many_splits(spark, tmp_path, small_splits):
    entries = [(1 + i % 9, 1 + i // 9, i + 1) for i in range(300)]
    body = "%%MatrixMarket matrix coordinate integer general\n% note\n9 34 300\n"
    _write(f"{tmp_path}/s1/matrix.mtx", body + "".join(f"{a} {b} {c}\n" for a, b, c in entries))
    wrong = body.replace("9 34 300", "9 30 301")
    _write(f"{tmp_path}/s2/matrix.mtx", wrong + "".join(f"{a} {b} {c}\n" for a, b, c in reversed(entries)))
    lines = text.read_lines(spark, f"{tmp_path}/*")
    found, sizes = text.matrix_market(lines)
    got = {(r.row, r.col, int(r.value)) for r in found.where("folder = 's1'").collect()}
    assert got == set(entries)
    report = {r.folder: r for r in text.shape_report(found, sizes).collect()}
    assert report["s1"].valid and not report["s2"].valid
    bad = {r.folder for r in text.unordered_lines(found, "col").collect()}
    assert bad == {"s2"}
    numbers = [r.line for r in text.number_lines(lines).where("folder = 's1'").orderBy("line").collect()]
    assert numbers == list(range(303))
    first = text.number_lines(lines).where("folder = 's1' AND line = 3").first().value
    assert first == "1 1 1"


def test_triplet_uses_line_numbers(spark, tmp_path, small_splits):
    _write(f"{tmp_path}/b/s/barcodes.tsv", "".join(f"BC{i}\n" for i in range(100)))
    _write(f"{tmp_path}/f/s/features.tsv", "E0\tA\tGene Expression\nE1\tB\tGene Expression\n")
    _write(f"{tmp_path}/m/s/matrix.mtx", "%%MatrixMarket matrix coordinate integer general\n2 100 2\n1 100 7\n2 1 3\n")
    entries, _ = text.matrix_market(text.read_lines(spark, f"{tmp_path}/m/*"))
    got = text.triplet(text.read_lines(spark, f"{tmp_path}/b/*"), text.read_lines(spark, f"{tmp_path}/f/*"), entries).collect()
    assert {(r.barcode, r.gene_name, r.value) for r in got} == {("BC99", "A", 7.0), ("BC0", "B", 3.0)}


def test_region_profile(spark, tmp_path):
    body = (
        '<Header>\nFileVersion,0.02\n</Header>\n<Scan_Attributes>\nID,"DSP-1"\nWell,A01\n</Scan_Attributes>\n'
        "<NGS_Processing_Attributes>\nRaw,100\numiQ30,0.5\n</NGS_Processing_Attributes>\n<Code_Summary>\nRTS1,4\nRTS2,9\n</Code_Summary>\n"
    )
    _write(f"{tmp_path}/GSM7_x/a.dcc", body)
    fields = text.dcc_fields(text.read_lines(spark, f"{tmp_path}/*"))
    region = text.dcc_regions(fields).first()
    assert (region.gsm_id, region.scan_id, region.plate_id, region.well, region.raw_reads, region.aligned_reads) == ("GSM7", "DSP-1", "", "A01", 100, 0)
    assert region.umi_q30 == 0.5
    assert {(r.rts_id, r["count"]) for r in text.dcc_counts(fields).collect()} == {("RTS1", 4), ("RTS2", 9)}


def test_wide_csv(spark, tmp_path):
    _write(f"{tmp_path}/w/a.csv", "fov,cell_ID,G1,G2,G3\n1,1,0,5,\n1,2,x,0,2\n2,1,1,0,0\n")
    got = {(r.cell_key, r.gene, r.value) for r in text.wide_to_long(spark, f"{tmp_path}/w").collect()}
    assert got == {("1__1", "G2", 5.0), ("1__2", "G3", 2.0), ("2__1", "G1", 1.0)}
    assert text.wide_to_long(spark, f"{tmp_path}/w", fovs=["2"]).count() == 1


def test_input_manifest(spark):
    files = spark.createDataFrame([("a", "cells"), ("a", "matrix"), ("b", "cells")], "sample string, kind string")
    asked = spark.createDataFrame([("b",), ("z",)], "sample string")
    got = {r.sample: (r.missing, r.status) for r in manifest.validate_inputs(files, asked, ["cells", "matrix"]).collect()}
    assert got == {"a": ("", "valid"), "b": ("matrix", "requested but incomplete"), "z": ("cells, matrix", "requested but absent")}


def test_checks(spark):
    df = spark.createDataFrame([("a", "1", "True", None), ("a", "2", "false", None), ("b", "x", None, None)], "k string, n string, b string, e string")
    assert checks.duplicate_report(df, ["k"]).first().n_duplicate_keys == 1
    assert {r.column: r.inferred for r in checks.infer_types(df).collect()} == {"k": "string", "n": "string", "b": "boolean", "e": "string"}
    assert {r.field: r.n_missing for r in checks.required_fields(df, ["k", "b", "zz"]).collect()} == {"k": 0, "b": 1, "zz": 3}


SCHEMA = "event_id bigint, user_id bigint, event_type string, value double"


def test_stream_resumes_and_reports_bad_files(spark, tmp_path):
    drop, out, ckpt = f"{tmp_path}/drop", f"{tmp_path}/out", f"{tmp_path}/ckpt"
    record = '{"event_id":%d,"user_id":1,"event_type":"a","value":2.0}\n'
    _write(f"{drop}/d1/a.txt", record % 1 + record % 2)
    _write(f"{drop}/d1/._a.txt", "hidden\n")
    stream.sweep(spark, drop, SCHEMA, out, ckpt)
    _write(f"{drop}/d2/b.txt", record % 3 + '{"event_id":')
    stream.sweep(spark, drop, SCHEMA, out, ckpt)
    stream.sweep(spark, drop, SCHEMA, out, ckpt)
    # A lost checkpoint reads every file again; the catalogue still has one row per file.
    stream.sweep(spark, drop, SCHEMA, out, f"{tmp_path}/fresh")
    rows = {r.folder: r for r in stream.read_catalog(spark, out).collect()}
    assert stream.read_catalog(spark, out).count() == 2
    assert rows["d1"].n_cells == 2 and rows["d1"].error is None
    assert rows["d2"].n_cells == 1 and rows["d2"].error == "1 unreadable records"


def test_watch_stops_at_the_sentinel(spark, tmp_path):
    drop = f"{tmp_path}/drop"
    _write(f"{drop}/d1/a.txt", '{"event_id":1,"user_id":1,"event_type":"a","value":2.0}\n')
    _write(f"{tmp_path}/done", "")
    stream.watch(spark, drop, SCHEMA, f"{tmp_path}/out", f"{tmp_path}/ckpt", f"{tmp_path}/done", every="1 second")
    totals = spark.read.parquet(f"{tmp_path}/out/totals").agg(F.max("n_files").alias("n")).first()
    assert totals.n == 1


def test_scratch_lies_in_the_named_folder():
    from types import SimpleNamespace

    from cellweave import session

    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: "/other")
    named = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: "hdfs://shared/"))
    assert session.scratch_path(named, "rows").startswith("hdfs://shared/rows-")


def test_stage_is_read_back(spark):
    from cellweave import session

    staged = session.write_stage(spark.range(5), "rows")
    assert staged.count() == 5
    assert os.path.basename(session.shared_root(spark)) in staged.inputFiles()[0] and "/rows-" in staged.inputFiles()[0]


def test_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from cellweave import session

    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    fake = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(fake)


def test_every_wide_file_is_read_by_its_own_header(spark, tmp_path):
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.csv").write_text('fov,cell_ID,GA,GB\n1,1,10,20\n\n')
    (tmp_path / "w" / "b.csv").write_text('fov,cell_ID,GB,"GA, ""x""",GA\n1,2,100,3,"200"\n')
    got = {(r.cell_key, r.gene, r.value) for r in text.wide_to_long(spark, f"{tmp_path}/w").collect()}
    assert got == {("1__1", "GA", 10.0), ("1__1", "GB", 20.0), ("1__2", "GB", 100.0), ("1__2", 'GA, "x"', 3.0), ("1__2", "GA", 200.0)}


def test_a_wide_line_of_another_width_is_an_error(spark, tmp_path):
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.csv").write_text("fov,cell_ID,GA,GB\n1,1,10\n")
    with pytest.raises(Exception, match="width of its header"):
        text.wide_to_long(spark, f"{tmp_path}/w").collect()


def test_a_wide_file_of_thousands_of_genes(spark, tmp_path):
    names = [f"G{i}" for i in range(3000)]
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.csv").write_text("\n".join([",".join(["fov", "cell_ID", *names]), ",".join(["1", "1", *map(str, range(3000))])]))
    got = {r.gene: r.value for r in text.wide_to_long(spark, f"{tmp_path}/w").collect()}
    assert got == {f"G{i}": float(i) for i in range(1, 3000)}


def test_matrix_lines_are_not_dealt_by_folder(spark, tmp_path):
    """All lines of a large file would go to the one task of its folder."""
    path = str(tmp_path / "sample")
    (tmp_path / "sample").mkdir()
    (tmp_path / "sample" / "a.mtx").write_text("%%MatrixMarket matrix coordinate real general\n% made\n3 40000 40000\n")
    (tmp_path / "sample" / "b.mtx").write_text("".join(f"1 {i} 2\n" for i in range(1, 40001)))
    lines = text.read_lines(spark, path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")  # as for a file of many gigabytes
    try:
        entries, _ = text.matrix_market(lines)
        assert "SortMergeJoin" not in entries._jdf.queryExecution().sparkPlan().toString()
        assert entries.count() == 40000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_profile_lines_are_not_dealt_by_folder(spark, tmp_path):
    (tmp_path / "GSM1_A").mkdir()
    body = "".join(f"RTS{i},{i}\n" for i in range(20000))
    (tmp_path / "GSM1_A" / "a.dcc").write_text(f"<Header>\nFileVersion,0.02\n</Header>\n<Code_Summary>\n{body}</Code_Summary>\n")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")  # as for a file of many gigabytes
    try:
        fields = text.dcc_fields(text.read_lines(spark, str(tmp_path / "GSM1_A")))
        assert "SortMergeJoin" not in fields._jdf.queryExecution().sparkPlan().toString()
        assert text.dcc_counts(fields).count() == 20000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
