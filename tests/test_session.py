from cartloom.session import cut_lineage, ensure_checkpoint_dir, sized_for

from .conftest import plan


def test_partitions_follow_the_data():
    big = sized_for(100 << 40, cores=4000)
    assert int(big["spark.sql.shuffle.partitions"]) == 524288
    small = sized_for(1 << 20, cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"


def test_checkpoint_folder_of_the_session_is_used(spark):
    folder = ensure_checkpoint_dir(spark)
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert configured in folder


def test_cut_lineage_keeps_rows_and_forgets_the_plan(spark):
    df = spark.range(10).selectExpr("id * 2 AS x").filter("x > 4")
    cut = cut_lineage(df)
    assert cut.count() == df.count()
    assert "Range" not in plan(cut)
