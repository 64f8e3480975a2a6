import pyarrow.parquet as pq
from pyspark.sql import functions as F

from workload.queries import _append_file


def test_a_file_of_its_own_can_be_read_by_many_tasks(spark, tmp_path):
    """A batch of one file with one row group is worked off by one task, whatever its size."""
    rows = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    for _ in range(2):
        _append_file(rows, str(tmp_path / "inbox"))
    files = list((tmp_path / "inbox").glob("*.parquet"))
    assert len(files) == 2
    assert all(pq.ParquetFile(f).num_row_groups >= 3 for f in files)
    back = spark.read.parquet(str(tmp_path / "inbox"))
    assert back.count() == 400_000 and back.distinct().count() == 200_000


def test_no_rows_are_a_file_too(spark, tmp_path):
    _append_file(spark.range(0), str(tmp_path / "inbox"))
    assert len(list((tmp_path / "inbox").glob("*.parquet"))) == 1
