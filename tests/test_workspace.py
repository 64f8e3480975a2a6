from types import SimpleNamespace

from tallywell.sinks.workspace import ensure_checkpoint_dir, shared_folder


def session(**settings):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings.get(key.split(".")[1], default)))


def test_the_named_folder_is_used():
    assert shared_folder(session(checkpoint="hdfs://x/cp/"), "csv").startswith("hdfs://x/cp/csv-")


def test_without_a_named_folder_the_warehouse_is_used():
    one, two = (shared_folder(session(sql="hdfs://x/warehouse"), "csv") for _ in range(2))
    assert one != two and one.startswith("hdfs://x/warehouse/_between_steps/csv-")


def test_checkpoint_dir_is_set_once(spark):
    ensure_checkpoint_dir(spark)
    first = spark.sparkContext.getCheckpointDir()
    ensure_checkpoint_dir(spark)
    assert first and spark.sparkContext.getCheckpointDir() == first
