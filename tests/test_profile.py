from helpers import records
from variantloom.sources.tables import read_stored_table
from variantloom.operators.profile import histogram, top_values


def test_histogram_edges(spark):
    df = spark.createDataFrame([(i, 7.0, None, "x") for i in range(101)] + [(None, None, None, "x")],
                               "a bigint, b double, c int, s string")
    got = histogram(df).collect()
    a = {r["bin"]: (r["n"], r["bin_start"]) for r in got if r["column"] == "a"}
    assert a[0] == (2, 0.0) and a[49] == (2, 98.0) and a[50] == (1, 100.0) and len(a) == 51
    assert [(r["bin"], r["n"], r["bin_start"]) for r in got if r["column"] == "b"] == [(0, 101, 7.0)]
    assert not [r for r in got if r["column"] in ("c", "s")]


def test_top_values_counts_nulls_and_breaks_ties_by_value(spark):
    rows = [(v, True, ["p", "q"]) for v in ["b", "a", None, None, "c"] for _ in range(2)] + [("z", None, None)]
    df = spark.createDataFrame(rows, "s string, f boolean, l array<string>")
    got = [(r["column"], r["rank"], r["value"], r["n"]) for r in top_values(df, k=3).orderBy("column", "rank").collect()]
    assert got == [("f", 1, "true", 10), ("f", 2, None, 1), ("l", 1, "[p, q]", 10), ("l", 2, None, 1),
                   ("s", 1, None, 4), ("s", 2, "a", 2), ("s", 3, "b", 2)]


def test_top_values_limits_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("cast(id AS string) AS s")
    plan = top_values(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_top_values_by_range_equal_one_window(spark):
    # three hot values, counts shared by many, and one count that thousands share across the limit
    df = spark.range(6000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN concat('hot', id % 9) WHEN id % 3 = 1 THEN CAST(id % 400 AS string) WHEN id % 97 = 0 THEN NULL ELSE concat('v', id) END AS s",
        "id % 2 = 0 AS f")
    wide = spark.createDataFrame([(f"w{i // 2 % 900}", None) for i in range(1000)], "s string, f boolean")
    df = df.unionByName(wide).repartition(7)
    for k in (1500, 10_000):
        by_range = top_values(df, k)
        before = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", k)
        try:
            assert records(by_range) == records(top_values(df, k))
        finally:
            spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", before)
        assert by_range.schema == top_values(df).schema


def test_tables_in_nested_folders(spark, tmp_path):
    rows = spark.createDataFrame([("chr1", 1), ("chr2", 2), ("chr2", 3)], "CHROM string, n int")
    rows.filter("n = 1").write.parquet(f"{tmp_path}/nested/a/first")
    rows.filter("n > 1").write.parquet(f"{tmp_path}/nested/b")
    rows.write.partitionBy("CHROM").parquet(f"{tmp_path}/parts")
    rows.coalesce(1).write.parquet(f"{tmp_path}/flat")
    for name in ("nested", "parts", "flat"):
        assert records(read_stored_table(spark, f"{tmp_path}/{name}"), "CHROM", "n") == [("chr1", 1), ("chr2", 2), ("chr2", 3)], name


def test_top_values_by_range_of_nothing(spark):
    df = spark.createDataFrame([], "s string, f boolean")
    assert top_values(df, 2000).collect() == []


def test_top_values_by_range_sorts_no_whole_column(spark):
    spread = spark.range(20_000).selectExpr("CAST(id AS string) AS s")
    deep = top_values(spread, 5000)
    assert deep.count() == 5000
    assert {r["value"] for r in deep.filter("rank <= 3").collect()} == {"0", "1", "10"}
    plan = deep._jdf.queryExecution().executedPlan().toString()
    # the only window over values is within a range
    assert "_range" in plan.split("row_number() windowspecdefinition(")[1].split(" DESC")[0]
