import datetime as dt
import shutil
import tempfile

from dosewise.streaming.incremental import run_incremental_extract
from pyspark.sql import functions as F

from .conftest import SMOKE


def test_incremental_extract_is_idempotent(spark):
    out = tempfile.mkdtemp(prefix="extract-", dir="/tmp")
    name = "extract_" + out.rsplit("-", 1)[-1]
    first = run_incremental_extract(spark, SMOKE, out, name=name)
    n = spark.read.parquet(out).count()
    expected = spark.read.parquet(f"{SMOKE}/events.parquet").where("event_type = 'purchase'").select("event_id").distinct().count()
    assert n == expected == first
    second = run_incremental_extract(spark, SMOKE, out, name=name)
    assert second == 0  # nothing new: the checkpoint is the high-water mark
    assert spark.read.parquet(out).count() == n


def test_late_and_repeated_sales_are_delivered_once(spark, tmp_path):
    events = spark.read.parquet(f"{SMOKE}/events.parquet")
    late, cut = events.where(F.col("ts") < dt.datetime(2024, 1, 15)), events.where(F.col("ts") >= dt.datetime(2024, 1, 15))
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    name = f"extract_{tmp_path.name}_{dt.datetime.now().timestamp()}"
    total, wanted = 0, set()
    for i, part in enumerate((cut, late, late.union(cut.limit(50)))):  # newest first, then late rows, then copies
        folder = str(tmp_path / f"part{i}")
        part.coalesce(1).write.parquet(folder)
        shutil.copytree(folder, f"{source}/tmp{i}", ignore=lambda d, names: [n for n in names if not n.startswith("part-")])
        for f in (tmp_path / "in" / f"tmp{i}").iterdir():
            shutil.copy(f, f"{source}/events_{i}.parquet")
        wanted |= {r[0] for r in part.where("event_type = 'purchase'").select("event_id").collect()}
        total += run_incremental_extract(spark, source, out, name=name)
        got = [r[0] for r in spark.read.parquet(out).select("lineitem_id").collect()]
        assert len(got) == len(set(got)) == total and set(got) == wanted


def test_a_batch_reads_no_earlier_output(spark, tmp_path):
    events = spark.read.parquet(f"{SMOKE}/events.parquet")
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    name = f"extract_{tmp_path.name}_{dt.datetime.now().timestamp()}"
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    total = 0
    for i, part in enumerate((events.where("event_id % 2 = 0"), events)):
        part.coalesce(1).write.parquet(f"{tmp_path}/part{i}")
        for f in (tmp_path / f"part{i}").glob("part-*.parquet"):
            shutil.copy(f, source / f"events_{i}.parquet")
        total += run_incremental_extract(spark, str(source), str(out), name=name)
        (out / f"batch_id={100 + i}").mkdir()
        (out / f"batch_id={100 + i}" / "part-0.parquet").write_text("not Parquet: reading the output would fail")
    assert total == events.where("event_type = 'purchase'").select("event_id").distinct().count()
    assert spark.conf.get(provider) == before
