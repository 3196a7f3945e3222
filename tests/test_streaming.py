import pytest
from pyspark.sql import functions as F

from silverlode.operators import cdc
from silverlode.operators.quality import ExpectationFailed, Rule, publish_if_clean
from silverlode.streaming import cdc as stream_cdc
from silverlode.streaming import ingest

from test_cdc import EVENTS, FEED


def flow(scd_type):
    return stream_cdc.Flow(["cliente_id"], "sequencia", F.col("operacao") == "D", scd_type, ["operacao", "sequencia"])


def land(spark, path, events):
    spark.createDataFrame(events, FEED).coalesce(1).write.mode("append").parquet(path)


def test_ingest_reads_only_new_files(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    land(spark, src, EVENTS[:3])
    schema = spark.read.parquet(src).schema
    ingest.run_ingest(ingest.open_stream(spark, src, schema), out, ck)
    assert spark.read.parquet(out).count() == 3
    ingest.run_ingest(ingest.open_stream(spark, src, schema), out, ck)
    assert spark.read.parquet(out).count() == 3
    land(spark, src, EVENTS[3:])
    ingest.run_ingest(ingest.open_stream(spark, src, schema), out, ck)
    assert spark.read.parquet(out).count() == 6


def test_expectations_per_batch(spark, tmp_path, rows):
    src, out, met, ck = (str(tmp_path / n) for n in ("src", "out", "met", "ck"))
    land(spark, src, EVENTS)
    schema = spark.read.parquet(src).schema
    rules = [Rule("nome_presente", F.col("nome").isNotNull(), "drop"), Rule("recente", F.col("sequencia") > 2, "warn")]
    ingest.run_expectations(ingest.open_stream(spark, src, schema), rules, out, met, ck)
    assert spark.read.parquet(out).count() == 5
    assert rows(ingest.total_metrics(spark, met), "rule", "checked", "failed") == [("nome_presente", 6, 1), ("recente", 6, 2)]


def test_fail_rule_publishes_nothing(spark, tmp_path):
    df = spark.createDataFrame(EVENTS, FEED)
    rules = [Rule("nome_presente", F.col("nome").isNotNull(), "fail")]
    with pytest.raises(ExpectationFailed):
        publish_if_clean(df, rules, str(tmp_path / "t"))
    assert not (tmp_path / "t").exists()
    assert publish_if_clean(df.where("nome is not null"), rules, str(tmp_path / "t")) == {"rows": 5, "nome_presente": 0}


@pytest.mark.parametrize("scd_type", [1, 2])
def test_stream_equals_batch_in_any_arrival_order(spark, tmp_path, rows, scd_type):
    f = flow(scd_type)
    log, ck, src = (str(tmp_path / n) for n in ("log", "ck", "src"))
    for batch in (EVENTS[3:], EVENTS[:1], EVENTS[1:3]):  # deletes arrive before their inserts
        land(spark, src, batch)
        stream_cdc.run_cdc(ingest.open_stream(spark, src, spark.read.parquet(src).schema, 1), f, log, ck)
    build = cdc.scd1 if scd_type == 1 else cdc.scd2
    batch = build(spark.createDataFrame(EVENTS, FEED), f.keys, f.sequence_by, f.delete_when, f.drop)
    assert rows(stream_cdc.read_target(spark, f, log)) == rows(batch)


def test_batches_rewrite_only_the_buckets_they_touch(spark, tmp_path):
    target, f = str(tmp_path / "target"), flow(1)
    df = spark.createDataFrame(EVENTS, FEED)
    buckets = lambda v: {p.name for p in (tmp_path / f"target/open/rows/v={v:010d}").glob("bucket=*")}
    stream_cdc.apply_batch(df, 0, f, target, 1)
    one = df.where("cliente_id = 101").withColumn("sequencia", F.lit(9)).withColumn("cidade", F.lit("Uberaba"))
    for _ in range(2):  # a retried batch replaces its own version
        stream_cdc.apply_batch(one, 1, f, target, 1)
    assert len(buckets(1)) == 1 < len(buckets(0))
    got = {r["cliente_id"]: r["cidade"] for r in stream_cdc.read_target(spark, f, target).collect()}
    assert got[101] == "Uberaba" and 103 not in got and len(got) == 3
    stream_cdc.apply_batch(df.where("cliente_id = 101"), 2, f, target, 1)  # late: changes nothing
    assert {r["cliente_id"]: r["cidade"] for r in stream_cdc.read_target(spark, f, target).collect()} == got
    assert not buckets(1) & buckets(0)  # the version before the last two is gone
    stream_cdc.apply_batch(df.limit(0), 3, f, target, 1)
    assert not (tmp_path / "target/open/rows/v=0000000003").exists()


def test_history_with_late_events_in_any_order(spark, tmp_path, rows):
    """Random batches over few keys, ties, deletes and repeats; every batch once more as a retry."""
    import random

    rnd = random.Random(9)
    f = flow(2)
    events = []
    for seq in [*range(60), *rnd.sample(range(60), 12)]:
        op = rnd.choice("IUUD")
        events.append((rnd.choice([1, 1, 2, None]), None if op == "D" else rnd.choice("ab"), None if op == "D" else "c", op, seq))
    rnd.shuffle(events)
    target, late = str(tmp_path / "t"), 0
    for i in range(4):
        batch = spark.createDataFrame(events[i::4], FEED)
        for _ in range(2 if i % 2 else 1):
            stream_cdc.apply_batch(batch, i, f, target, most=2)
        seen = spark.createDataFrame([e for j in range(i + 1) for e in events[j::4]], FEED)
        want = cdc.scd2(seen, f.keys, f.sequence_by, f.delete_when, f.drop)
        cols = sorted(want.columns)
        assert rows(stream_cdc.read_target(spark, f, target), *cols) == rows(want, *cols)
        late += (tmp_path / "t" / "gone").exists()
    assert late


def test_batches_rewrite_open_versions_only(spark, tmp_path):
    """Whatever lies behind, a batch of new events writes its keys' open versions and closes what it ends."""
    f, target = flow(2), tmp_path / "t"
    written = []
    for i in range(4):
        events = [(k, "n", "c", "U", 10 * i + j) for k in range(20) for j in range(3)]
        stream_cdc.apply_batch(spark.createDataFrame(events, FEED), i, f, str(target), most=1000)
        size = lambda p: sum(x.stat().st_size for x in (target / p).rglob("*.parquet"))  # noqa: E731, B023
        written.append((size(f"open/rows/v={i:010d}"), spark.read.parquet(str(target / f"closed/v={i:010d}")).count()))
    assert [n for _, n in written] == [40, 60, 60, 60]
    assert max(b for b, _ in written) < 1.2 * min(b for b, _ in written)


def test_type_1_target_grows_by_splits(spark, tmp_path, rows):
    f, target = flow(1), str(tmp_path / "t")
    counts = []
    for i, keys in enumerate((range(30), range(100), range(5), range(400))):
        events = [(k, f"n{i}", "c", "U", i) for k in keys] + [(1, "hot", "c", "U", -j) for j in range(50)]
        stream_cdc.apply_batch(spark.createDataFrame(events, FEED), i, f, target, most=25)
        counts.append(stream_cdc.BucketTable(spark, f"{target}/open", f.keys).layout().buckets)
    assert counts[0] < counts[1] == counts[2] < counts[3]
    assert rows(stream_cdc.read_target(spark, f, target), "cliente_id", "nome") == [(k, "n3") for k in range(400)]


def test_merge_looks_for_ranges_in_written_events(spark, tmp_path, monkeypatch):
    """The cuts of the sequence are taken from files, not from the events reduced a second time."""
    plans, real = [], cdc.order_cuts

    def watched(df, col, parts):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, col, parts)

    monkeypatch.setattr(cdc, "order_cuts", watched)
    half = len(EVENTS) // 2
    for i, events in enumerate((EVENTS[half:], EVENTS[:half])):
        stream_cdc.apply_batch(spark.createDataFrame(events, FEED), i, flow(2), str(tmp_path / "t"))
    assert len(plans) == 2 and not any("Aggregate" in p for p in plans)
