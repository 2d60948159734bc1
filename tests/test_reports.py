"""Every table that the report jobs write, against the operators that the SQL checks cover one by one."""

from collections import Counter

from pyspark.sql import functions as F

from weighlens.operators import devices, labelling, models, pairs, reports
from weighlens.plans import candidates, quality
from weighlens.operators.references import references_with_labels, references_with_model, reference_metrics
from weighlens.storage import shared_dir


def _plain(value):
    return float(f"{value:.9g}") if isinstance(value, float) else str(value)


def _bag(df):
    names = sorted(df.columns)
    return Counter(tuple(_plain(r[n]) for n in names) for r in df.select(*names).collect())


def _same(spark, written, expected):
    assert set(expected) == set(written)
    for name, df in expected.items():
        found = spark.read.parquet(written[name])
        assert sorted(found.columns) == sorted(df.columns), name
        assert _bag(found) == _bag(df), name


def test_candidate_report_writes_nine_tables(spark, fleet):
    folders = fleet.derived("fx_folders")
    written = candidates.candidate_report(
        fleet.tx, fleet.pairs, fleet.descriptions, fleet.activations, folders, shared_dir(spark, "candidates"), 2)
    rows = labelling.dedupe_transactions(fleet.tx)
    stats = models.accuracy_stats(rows, 2)
    processed = candidates.processed_transactions(rows, fleet.pairs, fleet.activations, folders, stats)
    undefined = pairs.undefined_pairs(rows, fleet.pairs)
    _same(spark, written, {
        "deduplicated": rows, "valid_pairs": fleet.pairs, "descriptions": fleet.descriptions, "activations": fleet.activations,
        "accuracy_stats": stats, "processed": processed, "candidate_pairs": pairs.candidate_pairs(rows, fleet.pairs, fleet.descriptions),
        "undefined_pairs": undefined, "run_summary": reports.run_summary(processed, undefined),
    })


def test_quality_report_writes_all_tables_of_a_fleet(spark, fleet):
    products, labels, classes = (fleet.derived(t) for t in ("fx_fleet_products", "fx_labels", "fx_fleet_classes"))
    classes = classes.withColumns({"model_code": F.lit("m"), "class_index": F.col("class_pos")})
    owners = fleet.derived("fx_fleet_models")
    written = quality.quality_report(fleet.tx, products, labels, classes, shared_dir(spark, "quality"), 2, deployments=owners)
    active = models.active_model(fleet.tx)
    known = references_with_model(references_with_labels(products, labels), classes, deployments=owners)
    table = reports.consolidated_references(products, reference_metrics(fleet.tx, known, active), 2, fleet=True)
    assert "deployment_id" in table.columns
    device_table = devices.device_decision_columns(devices.device_metrics(fleet.tx, active))
    stats = reports.summary_stats(table)
    _same(spark, written, {
        "active_model": active, "products": table, "devices": device_table, "summary_stats": stats, "labels": labels,
        "model_classes": reports.model_class_table(classes, labels),
        "summary": reports.executive_summary(fleet.tx, products, labels, active, stats, device_table),
        "consistency": reports.consistency_report(stats, device_table),
    })
