from strata.plans import gold
from strata.sources.files import read_table

SF = "/root/testdata/sf0.001"


def test_gold_build_writes_every_table(spark, tmp_dir):
    paths = gold.build(spark, SF, tmp_dir)
    assert set(paths) == {"employee_versions", "dim_customer_versioned", "dim_date",
                          "fact_headcount_snapshot", "fact_lines_asof", "obt"}
    facts = read_table(spark, paths["fact_lines_asof"]).count()
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert facts == lines                                   # left as-of never multiplies
    assert read_table(spark, paths["obt"]).count() == facts
    v = read_table(spark, paths["employee_versions"])
    assert v.select("version_sk").distinct().count() == v.count()


def test_month_partitioned_facts_prune(spark, tmp_dir):
    paths = gold.build(spark, SF, tmp_dir)
    f = read_table(spark, paths["fact_lines_asof"]).filter("ship_month = '1997-03'")
    plan = f._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ship_month" in plan and "1997-03" in plan
    assert f.count() == f.filter("ship_date >= DATE'1997-03-01' AND "
                                 "ship_date <= DATE'1997-03-31'").count() > 0


def test_materialize_checkpoint_and_table(spark, tmp_dir):
    from strata.session import materialize
    df = spark.range(10).selectExpr("id", "id * 2 AS x")
    assert materialize(df).count() == 10
    assert materialize(df, "table", f"{tmp_dir}/m").count() == 10


def test_scale_settings():
    from strata.session import scale_settings
    s = scale_settings(100 * 2**40, cores=8000)
    assert int(s["spark.sql.shuffle.partitions"]) == 409600      # 100 TiB / 256 MiB
    assert scale_settings(10, cores=8)["spark.sql.shuffle.partitions"] == "16"


def test_command_line_gold(spark, tmp_dir, capsys):
    import json
    from strata.__main__ import main
    main(["gold", "--sf", SF, "--warehouse", tmp_dir])
    paths = json.loads(capsys.readouterr().out)
    assert "obt" in paths and read_table(spark, paths["obt"]).count() > 0
