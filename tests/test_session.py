import os

from retail_lens.session import Staging, shared_folder


def test_readers_change_no_setting(spark):
    from workload.inputs import Inputs

    before = dict(spark.conf.getAll)
    Inputs(spark, "/root/testdata/sf0.001").sales()
    assert dict(spark.conf.getAll) == before


def test_staged_frame_is_written_once_and_can_be_dropped(spark):
    stage = Staging(spark)
    assert stage.root.startswith(shared_folder(spark))
    staged = stage(spark.range(100), "numbers")
    assert staged.count() == 100
    assert "FileScan parquet" in staged._jdf.queryExecution().toString()
    folder = stage.root.removeprefix("file:")
    assert os.path.isdir(folder)
    stage.drop()
    assert not os.path.exists(folder)
