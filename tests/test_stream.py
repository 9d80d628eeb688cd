import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tidewater.plans import clean as pc
from tidewater.sources.bronze import bronze_tables
from tidewater.sources.io import list_folder
from tidewater.streaming import ingest
from tidewater.streaming.ingest import clean_transactions_stream, read_stream_output, retest_orphans
from tidewater.streaming.seen import ROW, SeenRows

SF = "/root/testdata/sf0.001"


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def agrees(spark, base, raw, keys):
    want = pc.clean_transactions(raw, keys, with_time=False)
    rejected = read_stream_output(spark, f"{base}/out", "quarantine").drop("fecha_proceso")
    return same(read_stream_output(spark, f"{base}/out"), want.valid) and same(rejected, want.rejected)


def inputs(spark):
    base = tempfile.mkdtemp(prefix="tw-stream-")
    b = bronze_tables(spark, SF)
    return base, b["transacciones"], pc.customer_keys(b["clientes"])


def run(spark, base, raw, **options):
    return clean_transactions_stream(spark, f"{base}/raw", raw.schema, f"{base}/clientes", f"{base}/out", f"{base}/ck",
                                     grain="yyyy", **options)


def test_stream_equals_batch(spark):
    base, raw, keys = inputs(spark)
    keys.write.parquet(f"{base}/clientes")
    raw.repartition(3).write.parquet(f"{base}/raw")  # duplicates may land in different files
    run(spark, base, raw, max_files_per_trigger=1)
    assert agrees(spark, base, raw, keys)


def test_stream_is_incremental_across_runs(spark):
    """New raw files after a run: the restart processes only them, and the total still equals the batch."""
    base, raw, keys = inputs(spark)
    keys.write.parquet(f"{base}/clientes")
    even = F.crc32("transaccion_id") % 2 == 0
    raw.filter(even).write.parquet(f"{base}/raw")
    run(spark, base, raw)
    n1 = read_stream_output(spark, f"{base}/out").count()
    raw.filter(~even).union(raw.limit(20)).write.mode("append").parquet(f"{base}/raw")
    q = run(spark, base, raw)
    assert 0 < n1 < read_stream_output(spark, f"{base}/out").count()
    assert agrees(spark, base, raw, keys)
    assert q.lastProgress is None or q.lastProgress["numInputRows"] <= raw.count()


def test_orphans_are_taken_up_when_their_customer_arrives(spark):
    base, raw, keys = inputs(spark)
    early = F.crc32("cliente_id") % 3 != 0
    keys.where(early).write.parquet(f"{base}/clientes")
    half = F.crc32("transaccion_id") % 2 == 0
    raw.filter(half).write.parquet(f"{base}/raw")
    run(spark, base, raw)
    assert agrees(spark, base, raw.filter(half), keys.where(early))
    keys.where(~early).write.mode("append").parquet(f"{base}/clientes")
    retest_orphans(spark, f"{base}/clientes", f"{base}/out")  # no new files: by itself
    assert agrees(spark, base, raw.filter(half), keys)
    retest_orphans(spark, f"{base}/clientes", f"{base}/out")
    assert agrees(spark, base, raw.filter(half), keys)
    raw.filter(~half).write.mode("append").parquet(f"{base}/raw")
    run(spark, base, raw)
    assert agrees(spark, base, raw, keys)


def test_a_replayed_micro_batch_changes_nothing(spark):
    """The run dies after a batch's rows are written but before the stream commits it: the restart replays the batch."""
    base, raw, keys = inputs(spark)
    keys.write.parquet(f"{base}/clientes")
    raw.repartition(2).write.parquet(f"{base}/raw")
    run(spark, base, raw, max_files_per_trigger=1)
    n = SeenRows(spark, f"{base}/out/seen").read().count()
    os.remove(f"{base}/ck/commits/1")
    for crc in glob.glob(f"{base}/ck/commits/.1.crc"):
        os.remove(crc)
    q = run(spark, base, raw, max_files_per_trigger=1)
    assert q.lastProgress["batchId"] == 1 and q.lastProgress["numInputRows"] > 0
    assert agrees(spark, base, raw, keys)
    assert SeenRows(spark, f"{base}/out/seen").read().count() == n == raw.distinct().count()


def test_a_step_that_dies_before_its_last_write_does_not_count(spark, monkeypatch):
    base, raw, keys = inputs(spark)
    keys.write.parquet(f"{base}/clientes")
    raw.repartition(2).write.parquet(f"{base}/raw")
    write, calls = ingest._write, []

    def dies(tagged, out_dir, step):
        if not calls:
            calls.append(step)
            tagged.where("motivo_descarte IS NULL").drop("motivo_descarte").write.parquet(f"{out_dir}/valid/batch={step}")
            raise RuntimeError("executor lost")
        write(tagged, out_dir, step)

    monkeypatch.setattr(ingest, "_write", dies)
    with pytest.raises(Exception, match="executor lost"):
        run(spark, base, raw)
    assert ingest.steps(spark, f"{base}/out") == []
    run(spark, base, raw)
    assert agrees(spark, base, raw, keys)


def test_waiting_rows_are_tested_once_per_version_of_the_customers(spark):
    base, raw, keys = inputs(spark)
    keys.write.parquet(f"{base}/clientes")
    raw.write.parquet(f"{base}/raw")
    run(spark, base, raw)
    done = ingest.steps(spark, f"{base}/out")
    assert not retest_orphans(spark, f"{base}/clientes", f"{base}/out")
    assert ingest.steps(spark, f"{base}/out") == done
    keys.limit(1).write.mode("append").parquet(f"{base}/clientes")
    assert retest_orphans(spark, f"{base}/clientes", f"{base}/out")
    assert len(ingest.steps(spark, f"{base}/out")) == len(done) + 1


def size(spark, folder):
    return sum(n for name, n, _ in list_folder(spark, folder) if name.endswith(".parquet"))


@pytest.mark.parametrize("digits, batches", [(0, 50), (1, 12)])
def test_what_a_batch_reads_of_the_index_does_not_grow(spark, digits, batches):
    """50 batches of equal size, each with the rows of a day, late rows of the days before, and rows taken before."""
    base, read = tempfile.mkdtemp(prefix="tw-seen-"), []
    for k in range(batches):
        index = SeenRows(spark, base, grain="yyyy-MM-dd", digits=digits)
        day = "date_add(DATE '2001-01-01', CAST(id DIV 40 AS INT) - CAST(id % 5 = 1 AS INT) - CAST(id % 10 = 1 AS INT)) AS day"
        again = spark.range(max(0, k * 40 - 40), k * 40).where("id % 10 = 3")  # of the last batch
        rows = index.keyed(spark.range(k * 40, k * 40 + 40).union(again).selectExpr("id", day), F.col("day")).coalesce(1)
        step = f"{k:09d}.0000"
        folders = index.folders(rows, step)
        read.append(sum(size(spark, f) for f in folders))
        new = index.unseen(rows, step)
        if k % 10 == 0:
            assert new.count() == 40
        index.add(new, step)
    assert index.read().select(ROW).distinct().count() == index.read().count() == batches * 40
    whole = sum(size(spark, p) for p in glob.glob(f"{base}/*/*"))
    assert 0 < max(read[batches // 2:]) <= 1.3 * max(read[3:batches // 2]) and max(read) < whole * 4 / batches
    with pytest.raises(ValueError, match="laid out"):
        SeenRows(spark, base, grain="yyyy-MM-dd", digits=2)


def test_compacted_cells_hold_the_same_rows(spark):
    index = SeenRows(spark, tempfile.mkdtemp(prefix="tw-seen-"))
    month = lambda a, b: index.keyed(spark.range(a, b).coalesce(1), F.lit("2001-01-01").cast("date"))
    for k in range(5):
        index.add(index.unseen(month(k * 20, k * 20 + 30), f"{k:09d}.0000"), f"{k:09d}.0000")
    before = sorted(r[0] for r in index.read().select(ROW).collect())
    assert len(before) == 110 and index.compact(["2001-01", "1999-01"], most=2) == 1 and index.compact(["2001-01"], most=2) == 0
    assert index.compact(["2001-01"], most=0) == 1 and len(index.folders(month(0, 1), "000000005.0000")) == 1
    assert sorted(r[0] for r in index.read().select(ROW).collect()) == before
    assert index.unseen(month(0, 120), "000000005.0000").count() == 10
    assert index.unseen(index.keyed(spark.range(3), F.lit(None).cast("date")), "000000005.0000").count() == 3
