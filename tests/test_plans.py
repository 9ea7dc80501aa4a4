"""The plans are the wanted ones: shuffles, scans, limits."""

import re

import pytest

from demandloom.operators.features import demand_features
from demandloom.operators.split import positional_split
from demandloom.plans import queries
from demandloom.plans.queries import QUERIES
from demandloom.schema import CATEGORICAL, SERIES
from demandloom.sources.star import TIE_BREAK, sales

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df) -> list[str]:
    return re.findall(r"(?<!Broadcast)Exchange (?:hash|range|Single|RoundRobin)\w*[^\n]*", plan(df))


@pytest.fixture(scope="module")
def rows(spark):
    return sales(spark, SF, "date", *SERIES, "units_sold")


def test_all_features_share_one_shuffle(rows):
    found = shuffles(demand_features(rows, ties=TIE_BREAK))
    assert len(found) == 1 and "store_id" in found[0] and "_chunk" in found[0]


def test_marking_the_split_moves_no_row(rows):
    assert shuffles(positional_split(rows, ties=TIE_BREAK)) == []


def test_indicators_read_no_dimension(spark):
    text = plan(QUERIES["season_summary"](spark, SF))
    assert "lineitem.parquet" in text
    assert not re.search(r"(orders|part|supplier)\.parquet", text)


@pytest.mark.parametrize("name", ["season_summary", "daily_precision", "baseline_kpis", "kpi_summary"])
def test_rows_are_aggregated_before_they_move(spark, name):
    text = plan(QUERIES[name](spark, SF))
    first = text.rindex("Exchange hash") if "Exchange hash" in text else text.rindex("Exchange Single")
    assert "partial_" in text[first:]


def test_scan_reads_asked_columns_only(spark):
    text = plan(QUERIES["daily_demand_compare"](spark, SF))
    schema = re.search(r"FileScan parquet \[([^\]]*)\]", text).group(1)
    assert "l_extendedprice" not in schema and "l_discount" not in schema


def test_store_top_k_is_limited_before_the_shuffle(spark):
    text = plan(QUERIES["latest_predictions"](spark, SF))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_pages_keep_few_rows_per_task(spark):
    for name in ("detail_preview", "preview_rows"):
        assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SF))


def test_no_python_in_any_plan(spark):
    for name in ("demand_features", "clean_sales", "request_features", "default_columns"):
        text = plan(QUERIES[name](spark, SF))
        assert "Python" not in text and "MapInPandas" not in text


def test_dimensions_are_broadcast_one_by_one(spark):
    text = plan(sales(spark, SF))
    assert "SortMergeJoin" not in text and "CartesianProduct" not in text


def test_training_rows_are_chosen_before_they_meet_the_orders(spark):
    rows = queries.split(spark, SF, *CATEGORICAL).where("not is_test").select(*CATEGORICAL)
    text = rows._jdf.queryExecution().optimizedPlan().toString()
    orders = re.search(r"Join Inner, \(l_orderkey#\d+L? = o_orderkey", text)
    assert orders.start() < text.index("(struct(c0")


def test_onehot_counts_joins_its_rows_once(spark, monkeypatch):
    kept, usual = [], queries.written

    def written(df, name):
        kept.append((name, df.columns))
        return usual(df, name)

    monkeypatch.setattr(queries, "written", written)
    counts = QUERIES["onehot_counts"](spark, SF)
    assert kept == [("train", list(CATEGORICAL))]
    assert "lineitem.parquet" not in plan(counts)


@pytest.mark.parametrize("name, ending", [("records_from_json", "json.gz"), ("csv_rejects", "csv.gz")])
def test_text_of_a_query_is_packed_in_files_of_bounded_length(spark, monkeypatch, tmp_path, name, ending):
    monkeypatch.setattr(queries, "new_folder", lambda spark, folder: str(tmp_path / folder))
    monkeypatch.setattr(queries, "TEXT_FILES", queries.TEXT_FILES | {"maxRecordsPerFile": 1000})
    rows = sales(spark, SF).count()
    QUERIES[name](spark, SF).collect()
    files = [p for p in tmp_path.rglob("part-*") if p.name.endswith(ending)]
    assert len(files) >= rows / 1000 and len(files) == len([*tmp_path.rglob("part-*")])
