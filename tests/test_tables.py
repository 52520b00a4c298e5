"""The given tables as deliveries: how they are dealt."""

from pathlib import Path

import pytest

from fundlake.session import work_dir
from workloads import rendered as R
from workloads import tables as T
from workloads.queries import xml_files

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="given tables are not here")
def test_parts_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(T, "ROWS_PER_TASK", 100, raising=False)
    src = T.Source(spark, FOLDER)
    rows = spark.read.parquet(f"{FOLDER}/lineitem.parquet").count()
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert -(-rows // 100) > least
    for table in (src.lines, src.orders):
        sizes = [n for n in table.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()]
        assert len(sizes) == -(-rows // 100) and max(sizes) < 400
    assert src.lines.count() == rows


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="given tables are not here")
def test_one_year_of_xml_is_on_disk(spark, monkeypatch):
    def texts():
        return set(Path(work_dir(spark).removeprefix("file:")).rglob("*.txt"))

    before, seen, write = texts(), [], R.write_files

    def spied(lines, folder):
        write(lines, folder)
        seen.append(texts() - before)

    monkeypatch.setattr(R, "write_files", spied)
    found = xml_files(spark, FOLDER)
    assert len(seen) > 1 and all(len(files) == 1 for files in seen)
    assert texts() == before and found.select("levering").distinct().count() == len(seen)
