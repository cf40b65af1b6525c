"""What the plans must show at any size of the data."""

from pyspark.sql import functions as F

from conftest import FOLDER
from exposura import catalog


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_line_work_needs_no_shuffle(results):
    for name in ("drop_banner_lines", "line_clean", "strip_watermark", "redact", "pii_scan", "keyword_flag", "text_blocks",
                 "separator_position", "csv_vs_list", "ulp_shape_share", "strip_html", "extract_links", "schema_catalog"):
        assert "Exchange" not in results(name)[2], name


def test_filters_reach_the_scan(results):
    assert "GreaterThanOrEqual(o_totalprice" in results("range")[2]
    assert "EqualTo(lang,fr)" in results("term")[2]
    assert "GreaterThanOrEqual(ts" in plan(catalog.queries()["query_batch_and_live"](_spark(), FOLDER))


def _spark():
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession()


def test_scans_read_only_what_they_use(results):
    text = results("source_summary")[2]
    assert "ReadSchema: struct<lang:string,source:string>" in text
    assert "text" not in results("forum_thread_counts")[2].split("ReadSchema")[1].split(">")[0]


def test_picks_combine_before_they_shuffle(results):
    for name in ("latest_per_key", "first_per_key", "best_by_score", "unique_sparse"):
        text = results(name)[2]
        assert "partial_max_by" in text or "partial_min_by" in text, name
        assert "Window" not in text, name


def test_top_lists_are_taken_per_task_first(results):
    for name in ("top_domains_by_count", "search_limit", "recent_sample", "display_top10", "recent_page"):
        assert "TakeOrderedAndProject" in results(name)[2], name


def test_names_per_group_are_limited_before_the_shuffle(results):
    assert "WindowGroupLimit" in results("domains_alphabetical")[2]


def test_entry_runs(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["forum", "n_threads", "n_flagged", "n_hits"]
    assert df.count() > 0
    assert set(catalog.queries()) <= set(entry.queries())
    assert set(catalog.queries()) == set(catalog.oracles()) and set(entry.oracle_sql()) <= set(entry.queries())
