from pyspark.sql import functions as F

from encore.operators.als import REFERENCE_AXES, one_at_a_time_grid
from encore.operators.prep import count_interactions
from encore.plans import binding

SF = "/root/testdata/sf0.001"


def test_one_join_equals_separate_periods(spark):
    both = binding.interactions_by_period(spark, SF)
    hist = both.where(F.col("period") == "history").drop("period")
    test = both.where(F.col("period") == "test").drop("period")
    assert sorted(hist.collect()) == sorted(count_interactions(binding.plays(spark, SF, end=binding.TEST_CUT), weight="quantity").collect())
    assert sorted(test.collect()) == sorted(count_interactions(binding.plays(spark, SF, start=binding.TEST_CUT), weight="quantity").collect())


def test_catalogue_imputes_canonical_id(spark):
    tr = binding.tracks(spark, SF)
    small = tr.join(spark.read.parquet(f"{SF}/part.parquet")
                    .select(F.col("p_partkey").cast("string").alias("recording_msid"), "p_type"),
                    "recording_msid")
    assert small.where((F.col("p_type") == "SMALL") & F.col("recording_mbid").isNotNull()).count() == 0
    assert small.where((F.col("p_type") != "SMALL") & F.col("recording_mbid").isNull()).count() == 0


def test_reference_grid_is_one_at_a_time():
    grid = one_at_a_time_grid(REFERENCE_AXES)
    assert len(grid) == 17 and all(len(g) == 1 for g in grid)


def test_study_release_deletes_its_tables(spark, tmp_path):
    import os

    from encore.plans.study import Study
    s = Study(spark, SF)
    assert s.core.count() > 0
    paths = list(s.tables)
    assert paths and all(os.path.exists(p.replace("file:", "")) for p in paths)
    assert s.release() == len(paths)
    assert not any(os.path.exists(p.replace("file:", "")) for p in paths)


def test_forget_leaves_no_table_behind(spark, tmp_path):
    """Every stage table of every query is noted and deleted: the folder is empty afterwards."""
    import os

    from encore.plans import catalog
    from encore.sources import tables
    catalog.forget(spark)
    kept = spark.sparkContext.getCheckpointDir()
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    try:
        for key in ("popular_items", "prepare_catalogue", "items_by_percent_rank", "scan_multi", "recs_unseen", "sink_roundtrip"):
            assert catalog.QUERIES[key](spark, SF).count() > 0
        folder = spark.sparkContext.getCheckpointDir().replace("file:", "") + "/tables"
        assert len(os.listdir(folder)) > 8
        assert catalog.forget(spark) > 8
        assert os.listdir(folder) == []
        assert tables.release_all(spark) == 0
    finally:
        spark.sparkContext.setCheckpointDir(kept)


def test_fractional_quantities_are_refused_not_cut(spark):
    import pytest

    from encore.functions.columns import exact_long
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "q double")
    assert [r[0] for r in df.select(exact_long("q")).collect()] == [1, None, 3]
    with pytest.raises(Exception, match="not a whole number"):
        spark.createDataFrame([(0.5,)], "q double").select(exact_long("q")).collect()
