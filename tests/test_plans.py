"""Physical plans: what reaches the scan, what is shuffled, what is windowed."""

from __future__ import annotations

import re

import pytest

from curate import operators as op
from curate.operators import skew
from curate.plans import catalogue as cat
from curate.registry import entries
from curate.registry.derived import derived

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def built(spark, name) -> str:
    return plan(entries()[name].build(spark, SF_DIR))


WRITERS = {
    "csv_roundtrip", "json_records", "transform_written", "landed_to_curated", "profile_written",
    "rules_written",
}


@pytest.mark.parametrize("name", sorted(set(entries()) - WRITERS))
def test_no_python_worker_and_no_cross_join(spark, name):
    text = built(spark, name)
    assert "Python" not in text and "InPandas" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["top_orders", "songs_most_popular", "songs_longest"])
def test_top_k_sorts_only_k_rows(spark, name):
    assert "TakeOrderedAndProject" in built(spark, name)


@pytest.mark.parametrize("name", ["songs_top_artists", "top5_customers_per_year"])
def test_top_n_is_cut_before_the_shuffle(spark, name):
    text = built(spark, name)
    assert re.search(r"WindowGroupLimit.*Partial", text) and re.search(r"WindowGroupLimit.*Final", text)


@pytest.mark.parametrize("name", ["profile_columns", "stage_profile"])
def test_profile_is_one_scan(spark, name):
    text = built(spark, name)
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_row_rules_share_one_scan(spark):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    rules = [op.rule_not_null("o_custkey"), op.rule_range("o_totalprice", 0.0, 1.0)]
    text = plan(op.check_rules(orders, rules))
    assert text.count("FileScan") == 1
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in text


def test_survivors_take_one_shuffle_and_no_window(spark):
    text = built(spark, "curated_main")
    assert text.count("Exchange hashpartitioning") == 1
    assert "Window" not in text and "partial_min" in text


WINDOW = re.compile(r"\bWindow \[[^\n]*")


@pytest.mark.parametrize("name", ["curated_quarantine", "rows_repeated", "dedup_main", "curated_main"])
def test_duplicates_need_no_window(spark, name):
    assert not WINDOW.search(built(spark, name))


def test_running_max_windows_only_peaks_of_hot_partitions(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 0)
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    found = op.running_max(events, ["event_type"], "ts", "value", "m")
    windows = WINDOW.findall(plan(found))
    assert len(windows) == 3 and sum("__peak" in w for w in windows) == 2


def test_filters_and_columns_reach_the_scan(spark):
    assert "PushedFilters: [Or(LessThan(p_size,10),GreaterThan(p_size,40))]" in built(spark, "filter_or")
    assert "ReadSchema: struct<c_acctbal:double,c_mktsegment:string>" in built(spark, "segment_summary")
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    assert "ReadSchema: struct<o_custkey:bigint>" in plan(op.repeated_keys(orders, "o_custkey"))


def test_a_small_list_of_repeated_keys_leaves_unique_rows_unshuffled(spark, tmp_path, monkeypatch):
    """Whole rows are read once, by a write with a broadcast; what follows reads the copies."""
    dealt, later = [], []
    write_parts, write_parquet = cat.write_parts, cat.write_parquet
    monkeypatch.setattr(cat, "write_parts", lambda df, part, path: (dealt.append(plan(df)), write_parts(df, part, path)))
    monkeypatch.setattr(cat, "write_parquet", lambda df, *to: (later.append(plan(df)), write_parquet(df, *to)))
    raw = str(tmp_path / "raw")
    derived(spark, SF_DIR, "catalogue").write.parquet(raw)
    rows = cat.records(spark.read.parquet(raw))
    cat.write_split(rows, cat.KEY, str(tmp_path / "main"), str(tmp_path / "copies"))
    assert len(dealt) == 1 and "BroadcastHashJoin" in dealt[0]
    assert "Exchange hashpartitioning" not in dealt[0] and dealt[0].count(f"{raw}]") == 1
    copies, main = later
    assert raw + "]" not in copies + main and "Exchange hashpartitioning" not in copies
    assert main.count("Exchange hashpartitioning") == 1
    for text in later:
        assert "PartitionFilters: [isnotnull(part__" in text


@pytest.mark.parametrize(("reports", "scans"), [(False, 2), (True, 4)])
def test_the_transform_reads_its_input_as_often_as_it_says(spark, tmp_path, monkeypatch, reports, scans):
    raw = str(tmp_path / "raw")
    derived(spark, SF_DIR, "catalogue").write.parquet(raw)
    ran = []

    def watch(module, name):
        act = getattr(module, name)
        monkeypatch.setattr(module, name, lambda df, *to: (ran.append(plan(df)), act(df, *to))[1])

    watch(cat, "write_parts")
    watch(cat, "write_parquet")
    watch(cat, "stored")
    monkeypatch.setattr(cat, "log_rules", lambda results: None)
    report_path = str(tmp_path / "reports") if reports else None
    cat.transform(spark, raw, str(tmp_path / "main"), str(tmp_path / "copies"), report_path)
    assert sum(text.count(f"{raw}]") for text in ran) == scans


def test_dimension_size_decides_the_join(spark, monkeypatch):
    customers = spark.read.parquet(f"{SF_DIR}/customer.parquet").withColumnRenamed("c_nationkey", "k")
    nations = spark.read.parquet(f"{SF_DIR}/nation.parquet").withColumnRenamed("n_nationkey", "k")
    assert "rightHint=(strategy=broadcast)" in op.enrich(customers, nations, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr("curate.operators.analytics.fits_broadcast", lambda df: False)
    assert "__part" in plan(op.enrich(customers, nations, ["k"]))
