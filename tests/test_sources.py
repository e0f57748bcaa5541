"""Sources and sinks: seeds from CSV, JSON lines landing, materialisation."""

import os
import tempfile

from casewatch import schemas
from casewatch.plans.build import build_models
from casewatch.sources import load_seeds, materialise, read_landed
from casewatch.sources.adapter import raw_from_lineitem


def test_seeds_from_values_and_csv(spark):
    d = tempfile.mkdtemp(prefix="casewatch-seeds-")
    with open(os.path.join(d, "disease_list.csv"), "w") as fh:
        fh.write("disease_name\nMUMPS\n\"RABIES, HUMAN\"\n")
    with open(os.path.join(d, "us_holidays.csv"), "w") as fh:
        fh.write("year,week,holiday_name\n2024,13,Easter\n")
    built = load_seeds(spark)
    assert built["disease_list"].count() == 133 and built["us_holidays"].count() == 35
    read = load_seeds(spark, f"{d}/disease_list.csv", f"{d}/us_holidays.csv")
    assert [r[0] for r in read["disease_list"].collect()] == ["MUMPS", "RABIES, HUMAN"]
    assert tuple(read["us_holidays"].first()) == (2024, 13, "Easter")


def test_read_landed_json_lines(spark):
    d = tempfile.mkdtemp(prefix="casewatch-jl-")
    with open(os.path.join(d, "part.json"), "w") as fh:
        fh.write('{"states": "Ohio", "year": "2024", "week": "1", "label": "Mumps"}\n')
        fh.write('{"states": "Iowa", "year": "2024", "week": "2", "label": "Mumps", "extra": 1}\n')
    df = read_landed(spark, d, multi_line=False, with_position=True)
    assert df.count() == 2 and "_landed_file" in df.columns
    assert set(schemas.LANDED.fieldNames()) <= set(df.columns)


def test_materialise_namespaces(spark, sf_small):
    m = build_models(raw_from_lineitem(spark, sf_small))
    root = tempfile.mkdtemp(prefix="casewatch-mat-")
    out = materialise({
        "stg_nndss_weekly": ("staging", m["stg_nndss_weekly"]),
        "dim_location": ("dims", m["dim_location"]),
        "fact_disease_cases": ("facts", m["fact_disease_cases"]),
        "agg_top5_diseases_per_state_year_quarter": ("marts", m["agg_top5_diseases_per_state_year_quarter"]),
    }, root=root)
    assert os.path.isdir(f"{root}/cdc_dims/dim_location") and os.path.isdir(f"{root}/cdc_marts")
    assert spark.table("stg_nndss_weekly").count() == 5524  # staging is a view
    assert out["fact_disease_cases"].count() == 5524


def test_materialise_into_catalog_namespaces(spark, sf_small):
    m = build_models(raw_from_lineitem(spark, sf_small))
    root = tempfile.mkdtemp(prefix="casewatch-cat-")
    out = materialise({"dim_location": ("dims", m["dim_location"]),
                       "agg_top5_diseases_per_state_year_quarter":
                           ("marts", m["agg_top5_diseases_per_state_year_quarter"])},
                      root=root, use_catalog=True)
    assert spark.table("cdc_dims.dim_location").count() == 51
    assert out["agg_top5_diseases_per_state_year_quarter"].count() == 4271
    assert os.path.isdir(f"{root}/cdc_dims")
