"""Files in and out."""

from types import SimpleNamespace

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from demandspark.sources.predictions import (
    align_by_position, read_keyed_predictions, read_predictions, read_predictions_tail, require_predictions,
    with_file_rows,
)
from demandspark.sources.tables import read_demand, read_template, write_run, write_table
from demandspark.staging import staging, spread, staged, staging_root
from tests.helpers import A, B, C, day, demand, rows

CSV = """ProductId,BranchId,CountryCode,Currency,EffectiveDate,Demand,Note
18,011,ZM,USD,2024-01-01,1.5,a
18,011,ZM,USD,2024-01-02 10:30:00,bad,b
18,011,ZM,USD,not a date,3,c
"""


def test_read_demand_types_and_bad_cells(spark, tmp_path):
    (tmp_path / "ZM.csv").write_text(CSV)
    df = read_demand(spark, str(tmp_path / "ZM.csv"))
    assert dict(df.dtypes)["BranchId"] == "string" and dict(df.dtypes)["Demand"] == "double"
    assert rows(df, "BranchId", "EffectiveDate", "Demand") == [
        ("011", day(0), 1.5), ("011", day(1), None), ("011", None, 3.0),
    ]
    (tmp_path / "bad.csv").write_text("ProductId,BranchId\n1,2\n")
    with pytest.raises(ValueError, match="Currency"):
        read_demand(spark, str(tmp_path / "bad.csv"))


def test_read_demand_of_many_files_and_parquet(spark, tmp_path):
    df = demand(spark, {A: [1, 2], C: [3]})
    for country in ("ZM", "ZA"):
        write_table(df.where(F.col("CountryCode") == country), str(tmp_path / country))
    both = read_demand(spark, [str(tmp_path / "ZM"), str(tmp_path / "ZA")])
    assert rows(both, *df.columns) == rows(df, *df.columns)
    write_table(df, str(tmp_path / "p"), fmt="parquet")
    assert rows(read_demand(spark, str(tmp_path / "p"), "parquet"), *df.columns) == rows(df, *df.columns)


def test_columns_are_matched_by_name_over_files(spark, tmp_path):
    (tmp_path / "ZM_1.csv").write_text("ProductId,BranchId,Currency,EffectiveDate,Demand\n18,011,USD,05/01/2023,5\n")
    (tmp_path / "ZA.csv").write_text("BranchId,ProductId,Demand,Currency,EffectiveDate\n012,7,6,ZAR,20230201\n")
    both = read_demand(spark, str(tmp_path), country_from_file=True, date_formats=["MM/dd/yyyy", "yyyyMMdd"])
    assert rows(both, "ProductId", "BranchId", "CountryCode", "EffectiveDate", "Demand") == [
        ("18", "011", "ZM", date(2023, 5, 1), 5.0), ("7", "012", "ZA", date(2023, 2, 1), 6.0),
    ]
    one = read_demand(spark, [str(tmp_path / "ZA.csv")], country="ZA", date_formats=["yyyyMMdd"])
    assert rows(one, "CountryCode", "EffectiveDate") == [("ZA", date(2023, 2, 1))]


def test_headers_of_many_files_are_one_job(spark, tmp_path):
    for i in range(150):
        columns = ["ProductId", "BranchId", "CountryCode", "Currency", "EffectiveDate", "Demand"]
        cells = [str(i), "011", "ZM", "USD", "2024-01-01", str(i)]
        turn = i % 3  # three different headers
        lines = [",".join(columns[turn:] + columns[:turn]), ",".join(cells[turn:] + cells[:turn])]
        (tmp_path / f"part {i}.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "empty.csv").write_text("")
    context = spark.sparkContext
    context.setJobGroup("headers", "one job for all headers")
    df = read_demand(spark, str(tmp_path))
    jobs = len(context.statusTracker().getJobIdsForGroup("headers"))
    context.setJobGroup("rest", "")
    assert jobs <= 2 + 3  # the headers' two stages, and a listing for each kind of header
    assert rows(df, "ProductId", "BranchId", "Demand") == sorted((str(i), "011", float(i)) for i in range(150))


def test_a_known_header_saves_the_pass_and_is_checked(spark, tmp_path):
    (tmp_path / "ZM.csv").write_text(CSV)
    header = CSV.split("\n")[0].split(",")
    assert read_demand(spark, str(tmp_path), columns=header).count() == 3
    with pytest.raises(Exception, match="header"):
        read_demand(spark, str(tmp_path), columns=header[::-1]).collect()


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_folder_keys_stay_text(spark, tmp_path, fmt):
    df = demand(spark, {A: [1]}).withColumn("CountryCode", F.lit("012"))
    write_run(df, str(tmp_path / "r"), "20240131-000000", fmt=fmt)
    assert rows(read_demand(spark, str(tmp_path / "r"), fmt), "CountryCode", "run_ts") == [("012", "20240131-000000")]


def test_write_policies(spark, tmp_path):
    path = str(tmp_path / "out")
    one, two = demand(spark, {A: [1]}), demand(spark, {A: [2]})
    write_table(one, path)
    with pytest.raises(Exception, match="already exists"):
        write_table(two, path)
    write_table(two, path, "skip")
    assert rows(read_demand(spark, path), "Demand") == [(1.0,)]
    write_table(two, path, "overwrite")
    assert rows(read_demand(spark, path), "Demand") == [(2.0,)]


def test_run_layout_prunes_by_country(spark, tmp_path):
    path = str(tmp_path / "runs")
    write_run(demand(spark, {A: [1, 2], C: [3]}), path, "20240101-000000")
    back = spark.read.parquet(path).where("CountryCode = 'ZA'")
    assert back.count() == 1
    assert len(back.inputFiles()) >= 1 and all("CountryCode=" in f for f in back.inputFiles())
    assert "PartitionFilters: [isnotnull(CountryCode" in back._jdf.queryExecution().toString()


def test_template(spark, tmp_path):
    (tmp_path / "t.csv").write_text("ProductId,BranchId,Currency\n018,11,USD\n")
    assert rows(read_template(spark, str(tmp_path / "t.csv")), "ProductId") == [("018",)]
    (tmp_path / "u.csv").write_text("ProductId,Currency\n018,USD\n")
    with pytest.raises(ValueError, match="BranchId"):
        read_template(spark, str(tmp_path / "u.csv"))


def test_headerless_predictions(spark, tmp_path):
    (tmp_path / "a.csv.out").write_text("1,2,3\nERROR,5,\n")
    (tmp_path / "b.csv.out").write_text("7,8,9\n")
    (tmp_path / "other.txt").write_text("x\n")
    df = read_predictions(spark, str(tmp_path), glob="*.out")
    assert rows(df, "p10", "p50", "p90") == [(1.0, 2.0, 3.0), (7.0, 8.0, 9.0), (None, 5.0, None)]
    assert require_predictions(df) is df
    with pytest.raises(FileNotFoundError):
        require_predictions(df.where("p50 > 100"))


def test_last_columns_padded_and_quoted(spark, tmp_path):
    (tmp_path / "a.out").write_text('18,11, "1.5" ,"2.5", 3.5\n18,12,"x",  "4","5"\n')
    (tmp_path / "b.out").write_text('"a,b",1,2,3\nk,0,"x,y",4,5d,6\n')
    df = read_predictions_tail(spark, str(tmp_path))
    assert rows(df, "p10", "p50", "p90") == [(1.0, 2.0, 3.0), (1.5, 2.5, 3.5), (4.0, None, 6.0), (None, 4.0, 5.0)]


def test_keyed_predictions(spark, tmp_path):
    (tmp_path / "k.csv").write_text('ProductId,p10,p50,p90\n18,1,"2",bad\n')
    df = read_keyed_predictions(spark, str(tmp_path), ["ProductId"])
    assert rows(df, "ProductId", "p10", "p50", "p90") == [("18", 1.0, 2.0, None)]
    with pytest.raises(ValueError, match="BranchId"):
        read_keyed_predictions(spark, str(tmp_path), ["BranchId"])


def test_rows_are_numbered_through_all_splits_of_a_file(spark, tmp_path):
    n = 5000
    requests, answers = tmp_path / "in", tmp_path / "out"
    requests.mkdir(), answers.mkdir()
    for part, base in (("batch_1", 0), ("batch_2", 100_000)):
        (requests / f"{part}.csv").write_text("".join(f"key-{base + i}\n" for i in range(n)))
        (answers / f"{part}.csv.out").write_text("".join(f"{base + i},{'9' * (i % 7)}1\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        left = with_file_rows(spark.read.schema("k string").csv(str(requests)))
        right = with_file_rows(spark.read.schema("v long, w long").csv(str(answers)))
        assert spark.read.schema("k string").csv(str(requests)).rdd.getNumPartitions() > 4
        joined = align_by_position(left, right)
        assert joined.count() == 2 * n
        assert joined.where("k <> concat('key-', v)").isEmpty()
        assert rows(left.groupBy("file").agg(F.min("row"), F.max("row"), F.count_distinct("row")), "*") == [
            ("batch_1", 0, n - 1, n), ("batch_2", 0, n - 1, n),
        ]
        (answers / "batch_2.csv.out").write_text("1,1\n")
        short = with_file_rows(spark.read.schema("v long, w long").csv(str(answers)))
        with pytest.raises(ValueError, match="differ in length"):
            align_by_position(left, short)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_staging_uses_the_folder_the_session_names(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert staging_root(spark) == f"{named}/demandspark/{spark.sparkContext.applicationId}"
    df = demand(spark, {A: [1], B: [2]})
    again = staged(df, "x")
    assert rows(again, *df.columns) == rows(df, *df.columns) and again.schema == df.schema
    assert all(named in f for f in again.inputFiles())


def test_staged_tables_can_be_cleared(spark):
    with staging(spark):
        (file,) = staged(demand(spark, {A: [1]}).coalesce(1), "x").inputFiles()
        assert os.path.exists(file.removeprefix("file://"))
    assert not os.path.exists(file.removeprefix("file://"))


def test_staging_without_a_named_folder():
    def session(master):
        context = SimpleNamespace(master=master, applicationId=f"test-{master}", getCheckpointDir=lambda: None)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))

    assert staging_root(session("local[2]")) == staging_root(session("local[2]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging_root(session("yarn"))


def test_small_staged_tables_are_broadcast_without_a_hint(spark):
    df = demand(spark, {A: list(range(50)), C: [1]})
    from demandspark.operators.scaling import apply_scaling, scaling_params

    plan = apply_scaling(df, scaling_params(df))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_spread_is_not_coalesced(spark):
    df = spread(spark.range(10), "id").selectExpr("id", "spark_partition_id() as p")
    assert df.rdd.getNumPartitions() == 4
