"""Sources and sinks that stop and go on: zstd frames, Arrow datasets, paged streams, resumed collections, politeness."""

import io
import json
import random

import pytest
import zstandard
from pyspark.sql import functions as F

from corpusloom.sources import arrow_dataset, readers, resume, zstd_lines
from corpusloom.streaming import streams


def test_zstd_frames_are_found_and_lines_come_once(spark, tmp_path):
    """Frames of all kinds that cut lines anywhere, one byte a task: each line comes once, from many tasks."""
    rng = random.Random(1)
    lines = [json.dumps({"id": i, "t": "x" * rng.randrange(200)}) for i in range(400)] + [json.dumps({"id": 400, "t": "y" * 400_000})]
    data, at, out, cuts = ("\n".join(lines)).encode(), 0, b"", 0
    while at < len(data):
        n = rng.choice([1, 7, 300, 5000, 150_000])
        c = zstandard.ZstdCompressor(level=rng.choice([1, 3]), write_checksum=rng.random() < 0.5, write_content_size=rng.random() < 0.5)
        if rng.random() < 0.3:
            writer = c.compressobj()
            out += writer.compress(data[at : at + n]) + writer.flush()
        else:
            out += c.compress(data[at : at + n])
        if rng.random() < 0.2:
            out += (0x184D2A53).to_bytes(4, "little") + (5).to_bytes(4, "little") + b"aside"
        at, cuts = at + n, cuts + 1
    (tmp_path / "a.jsonl.zst").write_bytes(out)
    (tmp_path / "b.jsonl.zst").write_bytes(zstandard.ZstdCompressor().compress(b'{"id": -1, "t": "end"}\n\n'))
    assert len(list(zstd_lines.frames(io.BytesIO(out)))) == cuts
    for size in (1, 1000, 1 << 30):
        df = zstd_lines.read_zstd_frames(spark, str(tmp_path), "id long, t string", size)
        assert sorted(r.id for r in df.collect()) == [-1, *range(401)]
        assert (df.rdd.getNumPartitions() > 30) == (size == 1)
    with pytest.raises(ValueError, match="cut off"):
        list(zstd_lines.frames(io.BytesIO(out[:-3] if out[-5:] != b"aside" else out[:-20])))


def test_arrow_dataset_commits_whole(spark, tmp_path):
    df = spark.range(1000).select("id", F.concat(F.lit("t"), "id").alias("text"), F.when(F.col("id") % 4 == 0, "validation").otherwise("train").alias("split"))
    path = str(tmp_path / "d")
    arrow_dataset.write_arrow_splits(df.repartition(3), path)
    back = arrow_dataset.read_arrow_splits(spark, path)
    assert sorted(map(tuple, back.select(*df.columns).collect())) == sorted(map(tuple, df.collect()))
    state = arrow_dataset.state_of(f"{path}/train")
    assert state["num_rows"] == 750 and len(state["_data_files"]) == 3 and state["_split"] == "train"
    assert readers.read_arrow(spark, f"{path}/train", "id long, text string").count() == 750
    with pytest.raises(Exception, match="dataset already"):
        arrow_dataset.write_arrow_dataset(df, f"{path}/train")
    other = str(tmp_path / "e")
    arrow_dataset.write_arrow_dataset(df.where("split = 'train'").drop("split").repartition(7), other)
    assert arrow_dataset.state_of(other)["_fingerprint"] == state["_fingerprint"]
    arrow_dataset.write_arrow_dataset(df.limit(5).drop("split"), other, overwrite=True)
    assert arrow_dataset.read_arrow_dataset(spark, other).count() == 5 and arrow_dataset.state_of(other)["num_rows"] == 5


def test_aborted_write_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "d")
    bad = spark.range(100).repartition(4).select("id", F.when(F.col("id") == 99, F.raise_error(F.lit("broken row")).cast("string")).otherwise("ok").alias("text"))
    with pytest.raises(Exception, match="broken row"):
        arrow_dataset.write_arrow_dataset(bad, path)
    assert not [p for p in (tmp_path / "d").rglob("*") if p.is_file()]
    with pytest.raises(Exception, match="state.json"):
        arrow_dataset.read_arrow_dataset(spark, path)


def write_pages(folder, first, last, rows=10):
    folder.mkdir(exist_ok=True)
    for p in range(first, last):
        (folder / f"page-{p}.jsonl").write_text("".join(json.dumps({"document_id": f"{p}-{i}", "text": f"text {i}"}) + "\n" for i in range(rows)))


def test_paged_stream_goes_on_after_it_was_killed(spark, tmp_path):
    """A batch that fails midway runs again; pages that come later are read by the next run; the cap ends the scan."""
    base, out = tmp_path / "pages", str(tmp_path / "out")
    write_pages(base, 0, 4)
    failing = [True]

    def run(scan=0):
        stream = readers.stream_paged(spark, "corpusloom.sources.readers:page_file", "corpusloom.sources.readers:page_files", "document_id string, text string", base=base, **({"scan": scan, "page_rows": 10} if scan else {}))

        def write(batch, number):
            if failing.pop() if failing else False:
                batch.limit(3).collect()
                raise RuntimeError("killed")
            batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

        q = stream.writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        q.awaitTermination()

    with pytest.raises(Exception, match="killed"):
        run()
    run()
    write_pages(base, 4, 9)
    run(scan=73)
    got = sorted(r.document_id for r in spark.read.parquet(out).collect())
    assert got == sorted([f"{p}-{i}" for p in range(7) for i in range(10)] + ["7-0", "7-1", "7-2"])


def plain_collect(texts, target, max_scan):
    rows, seen, scanned = [], set(), 0
    for i, t in enumerate(texts, 1):
        if i > max_scan or len(rows) >= target:
            break
        scanned = i
        if t.startswith("ok") and t not in seen:
            seen.add(t)
            rows.append((i, t))
    return rows, scanned


def test_killed_collection_goes_on(spark, tmp_path):
    rng = random.Random(3)
    texts = [f"{rng.choice(['ok', 'ok', 'bad'])} {rng.randrange(150)}" for _ in range(400)]
    source = spark.createDataFrame(list(enumerate(texts, 1)), "seq long, text string")
    calls = []

    def collect(target, max_scan, kill=None, name="a", config=None):
        def build(df):
            calls.append(1)
            if kill and len(calls) == kill:
                raise RuntimeError("killed")
            return df.where(F.col("text").startswith("ok"))

        calls.clear()
        got = resume.collect_source(source, "seq", build, "text", str(tmp_path), name, config or {"v": 1}, target, max_scan, 50)
        return sorted(map(tuple, got.rows.select("seq", "text").collect())), got

    with pytest.raises(RuntimeError, match="killed"):
        collect(10**6, 10**6, kill=5)
    rows, got = collect(10**6, 10**6)
    assert (rows, got.scanned) == plain_collect(texts, 10**6, 10**6) and got.reason == "source_exhausted" and 3 < got.steps < 8
    assert collect(10**6, 10**6)[1].steps == 0 and collect(10**6, 10**6, config={"v": 2})[1].steps == 8
    for name, (target, most) in {"b": (40, 10**6), "c": (10**6, 120)}.items():
        rows, got = collect(target, most, name=name)
        assert (rows, got.scanned, got.accepted) == (*plain_collect(texts, target, most), len(rows))
    rows, got = collect(60, 10**6, name="b")  # more is asked: goes on behind the row that filled the first target
    assert (rows, got.scanned) == plain_collect(texts, 60, 10**6)


def test_requests_of_a_domain_keep_their_distance(spark, tmp_path):
    rng, rows = random.Random(4), []
    for b in range(3):
        part = [(f"d{rng.randrange(4)}", f"u{b}-{i}", float(b * 100 + rng.randrange(60))) for i in range(50)]
        rows += part
        spark.createDataFrame(part, "domain string, url string, at double").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = streams.polite(spark.readStream.schema("domain string, url string, at double").parquet(str(tmp_path / "in")), "domain", "url", "at", 7.0)
        streams.append_once(stream, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))
    want, free = [], {}
    for d, u, at in sorted(rows, key=lambda r: (r[2], r[1])):
        free[d], t = max(at, free.get(d, at)) + 7, max(at, free.get(d, at))
        want.append((d, u, at, t))
    assert got == sorted(want)


def test_a_host_of_many_rows_is_fetched_in_order_of_arrival(spark, tmp_path):
    """Its rows come to Python in several parts of no order, and in several batches."""
    rows = [(f"h{i % 50 == 0}", f"u{i % 7}", i) for i in reversed(range(400))]
    many = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(many)
    spark.conf.set(many, 20)
    try:
        streams.in_order(spark.createDataFrame(rows, "domain string, url string, at long").repartition(5), f"{tmp_path}/in", 150, "at")
        stream = streams.polite(streams.read_stream(spark, f"{tmp_path}/in", "domain string, url string, at long", 1), "domain", "url", "at", 3.0)
        streams.append_once(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    finally:
        spark.conf.set(many, before)
    want, free = set(), {}
    for host, url, at in sorted(rows, key=lambda r: r[2]):
        at_last = max(at, free.get(host, 0))
        free[host] = at_last + 3
        want.add((host, url, at, at_last))
    got = spark.read.schema("domain string, url string, arrived double, fetch_at double").parquet(f"{tmp_path}/out").collect()
    assert len(got) == 400 and {(*r[:2], int(r[2]), int(r[3])) for r in got} == want
