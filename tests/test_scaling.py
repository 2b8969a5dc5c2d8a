"""Scaling parameters, their use and their JSON forms."""

import json
import statistics

import pytest
from pyspark.sql import functions as F

from demandspark.operators.prepare import series_template
from demandspark.operators.scaling import (
    apply_scaling, inverse_scaling, missing_groups, require_groups, scaling_params, scaling_violations,
    unused_groups, validated_params,
)
from demandspark.sources.params import (
    metadata_rows, params_from_json, params_to_json, read_params_json, scaling_metadata, write_params_json,
)
from tests.helpers import A, B, C, demand, rows

ONE = ("18", "13", "ZM", "USD")
FLAT = ("18", "14", "ZM", "USD")


def test_params_by_group(spark):
    df = demand(spark, {A: [1, 2, 3], B: [10, 20, ..., 40], ONE: [5]})
    p = {r.BranchId: r for r in scaling_params(df).collect()}
    values = [1, 2, 3, 10, 20, 40]
    assert p["11"].mean == pytest.approx(statistics.mean(values))
    assert p["11"].std == pytest.approx(statistics.stdev(values))
    assert (p["11"].min, p["11"].max, p["11"].n_observations) == (1, 40, 6)
    assert p["11"].last_value == 40  # the latest date
    assert p["13"].std is None and p["13"].n_observations == 1


def test_last_value_tie_goes_to_the_highest_product(spark):
    df = demand(spark, {A: [1, 2], B: [3, 4]})  # products "18" and "7"
    assert scaling_params(df).first().last_value == 4


def test_scaling_round_trip_and_edges(spark):
    df = demand(spark, {A: [1, 2, 4], ONE: [5], FLAT: [7, 7], C: [9, 11]})
    params = scaling_params(df.where("CountryCode = 'ZM'"))
    scaled = apply_scaling(df, params)
    assert rows(scaled.where("BranchId = '13'"), "Demand") == [(None,)]  # no deviation known
    assert rows(scaled.where("BranchId = '14'"), "Demand") == [(0.0,), (0.0,)]  # divisor one
    assert rows(scaled.where("CountryCode = 'ZA'"), "Demand") == [(11.0,), (9.0,)]  # no parameters
    back = inverse_scaling(scaled, params, ["Demand"]).where("BranchId = '11'")
    assert [r[0] for r in rows(back, "Demand")] == pytest.approx([1, 2, 4])
    assert scaled.columns == df.columns


def test_group_differences(spark):
    df = demand(spark, {A: [1, 2], C: [1, 2]})
    only_zm = scaling_params(df.where("CountryCode = 'ZM'"))
    assert rows(missing_groups(series_template(df), only_zm), "CountryCode", "BranchId") == [("ZA", "12")]
    assert rows(unused_groups(scaling_params(df), df.where("CountryCode = 'ZA'")), "BranchId") == [("11",)]
    with pytest.raises(ValueError, match="'BranchId': '12'"):
        require_groups(series_template(df), only_zm)
    require_groups(series_template(df), scaling_params(df))


def test_violations(spark):
    p = scaling_params(demand(spark, {A: [1, 2], ONE: [3], C: [4, 5]}))
    assert validated_params(p) is p and scaling_violations(p).count() == 0
    for change, rule in [
        ({"std": F.lit(-1.0)}, "negative_std"),
        ({"max": F.col("min") - 1}, "max_below_min"),
        ({"n_observations": F.lit(0).cast("long")}, "no_observations"),
        ({"mean": F.lit(None).cast("double")}, "missing_field"),
        ({"Currency": F.lit(None).cast("string")}, "null_key"),
    ]:
        bad = p.where("BranchId = '11'").withColumns(change)
        assert [r.rule for r in scaling_violations(bad).collect()] == [rule]
        with pytest.raises(ValueError, match=rule):
            validated_params(bad)
    with pytest.raises(ValueError, match="empty"):
        validated_params(p.where("false"))


def test_json_keeps_branches_with_separators(spark, tmp_path):
    odd = ("18", "11_east_2", "ZM", "USD")
    p = scaling_params(demand(spark, {odd: [1, 2], ONE: [3]}))
    columns = ["Currency", "BranchId", "mean", "std", "min", "max", "last_value", "n_observations"]
    assert rows(params_from_json(params_to_json(p)), *columns) == rows(p, *columns)
    path = str(tmp_path / "params")
    write_params_json(p, path)
    assert rows(read_params_json(spark, path), "CountryCode", *columns) == rows(p, "CountryCode", *columns)
    with pytest.raises(Exception, match="already exists"):
        write_params_json(p, path)


def test_one_indented_object_with_many_groups(spark, tmp_path):
    entry = {"mean": 1.5, "std": 0.5, "min": 1.0, "max": 2.0, "last_value": 2.0, "n_observations": 2}
    (tmp_path / "ZM.json").write_text(json.dumps({"USD_11": entry, "ZMW_12": entry}, indent=2))
    back = read_params_json(spark, str(tmp_path), whole_files=True)
    assert rows(back, "Currency", "BranchId", "n_observations") == [("USD", "11", 2), ("ZMW", "12", 2)]


def test_metadata(spark):
    p = scaling_params(demand(spark, {A: [1, 2], ("18", "a-b", "ZM", "USD"): [3, 5]}))
    lines = scaling_metadata(p, "20240101-000000")
    document = json.loads(lines.where("value like '%USD-11%'").first().value)
    assert document["scaling_stats"]["USD-11"]["mean"] == 1.5 and document["country_code"] == "ZM"
    assert rows(metadata_rows(lines), "BranchId", "mean", "generated_at") == [
        ("11", 1.5, "20240101-000000"), ("a-b", 4.0, "20240101-000000"),
    ]
    with pytest.raises(ValueError, match="scaled_column"):
        metadata_rows(lines.withColumn("value", F.replace("value", F.lit("scaled_column"), F.lit("other"))))
