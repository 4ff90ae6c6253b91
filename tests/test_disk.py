"""What a day leaves on disk, and for how long."""

import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import catalog
from conftest import rows
from millwright.schemas import RAW
from millwright.sources import files
from millwright.workspace import concurrently


def test_packed_csv_gives_the_same_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "PACKED_ROWS", 40)
    schema = RAW["production_records"]
    day = datetime(2024, 1, 1)
    made = [(f"b{i}", None if i % 7 == 0 else f'p,"{i}"', "L", "S1", i, day.date(), day, None) for i in range(100)]
    files.write_csv(spark.createDataFrame(made, schema).coalesce(1), str(tmp_path / "raw.csv"))
    written = [p for p in (tmp_path / "raw.csv").iterdir() if p.name.startswith("part-")]
    assert len(written) == 3 and all(p.name.endswith(".csv.gz") for p in written)
    assert rows(files.read_csv(spark, str(tmp_path / "raw.csv"), schema)) == rows(spark.createDataFrame(made, schema))


def test_shuffle_files_go_when_a_job_has_ended(spark, tmp_path):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        found = blocks.getAllFiles()
        return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}

    def waited_for(gone):
        for _ in range(100):
            if not (left := shuffles() & gone):
                break
            time.sleep(0.1)
        return left

    before, seen = shuffles(), set()

    def job():
        spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count().write.parquet(str(tmp_path / "t"))
        seen.update(shuffles() - before)

    concurrently(spark, [job])
    assert seen and not waited_for(seen)


@pytest.mark.parametrize("name", ["end_to_end", "catalog_tables"])
def test_a_day_leaves_nothing_but_what_is_published(spark, testdata, tmp_path, monkeypatch, name):
    monkeypatch.setattr(catalog, "run_folder", lambda _: str(tmp_path))
    assert catalog.QUERIES[name](spark, testdata).count()
    assert {p.name for p in tmp_path.iterdir()} <= {"serving", "read"}
    assert all(p.name.endswith("zstd.parquet") for p in tmp_path.rglob("*.parquet") if "/serving/versions/" in str(p) and "/order/" not in str(p) and p.is_file())
