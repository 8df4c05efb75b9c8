"""Collection documents are made by many tasks and read once for the size report."""

from cellweave.operators import catalog
from cellweave.plans import catalogue
from cellweave.session import write_stage


def test_documents_are_dealt_out_before_they_are_made(spark):
    plan = catalogue.collections(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.index("collection_id") < plan.index("repartitionbyexpression")  # a plan is read from its end


def test_size_report_writes_the_catalogue_once(spark, monkeypatch):
    written = []
    monkeypatch.setattr(catalog, "write_stage", lambda df, label: written.append(label) or write_stage(df, label))
    rows = [("d1", "Homo sapiens", "brain", 1500.0), ("d2", "Homo sapiens", "liver", None), ("d3", "Mus musculus", "brain", 600.0)]
    entries = spark.createDataFrame(rows, "dataset_id string, organism string, tissue string, h5ad_size_mb double")
    found = {(r["section"], r["label"]): r["value"] for r in catalog.size_report(entries).collect()}
    assert found == {
        ("total", "n_datasets"): 3.0, ("total", "total_gb"): 2.1, ("organism", "Homo sapiens"): 2.0, ("organism", "Mus musculus"): 1.0,
        ("tissue", "brain"): 2.0, ("tissue", "liver"): 1.0,
    }
    assert written == ["sizes"]
