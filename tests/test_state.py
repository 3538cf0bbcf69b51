from tallywick.operators.late_events import ReplayLedger
from tallywick.operators.state import changes_to_counts, fold_log, insert_ignore, replace_partitions
from tallywick.sources.files import read_channel_seeds, read_edges, read_parquet_set, write_edges, write_scores
from tallywick.streaming.jobs import ledger_stream, upsert_stream

CHANGE = "id bigint, s bigint, t bigint, updated_at bigint, deleted_at bigint"


def test_counts_follow_first_sight_and_deletion(spark):
    seen = spark.createDataFrame([(2,), (3,)], "id bigint")
    rows = [(1, 5, 6, 1, None), (2, 5, 7, 1, 9), (3, 5, 8, 2, None), (4, 5, 9, 1, 3)]
    delta, now = changes_to_counts(spark.createDataFrame(rows + rows, CHANGE), seen, "s", "t")
    assert {(r.s, r.t): r.delta for r in delta.collect()} == {(5, 6): 1, (5, 7): -1}
    assert {r.id for r in now.collect()} == {1, 3}
    again, _ = changes_to_counts(spark.createDataFrame(rows, CHANGE), now, "s", "t")
    assert again.count() == 0


def test_insert_ignore_and_balances(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "x"), (3, "z"), (3, "y")], "k int, v string")
    assert {tuple(r) for r in insert_ignore(old, new, ["k"], ["v"]).collect()} == {(1, "a"), (2, "b"), (3, "y")}
    b = fold_log(spark.createDataFrame([("a", 5), ("b", 1)], "f string, bal bigint"), spark.createDataFrame([("a", 2), ("a", 1), ("c", 4)], "f string, amt bigint"), ["f"], "bal", "amt")
    assert {tuple(r) for r in b.collect()} == {("a", 8, 3), ("b", 1, 0), ("c", 4, 4)}


def test_files_there_and_back(spark, tmp_path):
    e = spark.createDataFrame([(1, 2, 3.0), (2, 1, 1.5), (4, 1, 1.0)], "i bigint, j bigint, v double")
    write_edges(e, f"{tmp_path}/e")
    (tmp_path / "ids.csv").write_text("id\n1\n2\n2\n")
    assert {tuple(r) for r in read_edges(spark, f"{tmp_path}/e").collect()} == {tuple(r) for r in e.collect()}
    assert {tuple(r) for r in read_edges(spark, f"{tmp_path}/e", f"{tmp_path}/ids.csv").collect()} == {(1, 2, 3.0), (2, 1, 1.5)}
    (tmp_path / "seeds.csv").write_text('channel id,Seeds\nArt,"1, 2"\nart,"3,,4, 4,x"\n,5\n')
    assert {tuple(r) for r in read_channel_seeds(spark, f"{tmp_path}/seeds.csv").collect()} == {("art", 3), ("art", 4)}
    write_scores(e, f"{tmp_path}/s")
    assert read_parquet_set(spark, [f"{tmp_path}/s"], "i bigint, j bigint, v double").count() == 3
    replace_partitions(e, f"{tmp_path}/p", "i")
    replace_partitions(spark.createDataFrame([(1, 9, 9.0)], "i bigint, j bigint, v double"), f"{tmp_path}/p", "i")
    assert spark.read.parquet(f"{tmp_path}/p").count() == 3


def test_streams_give_the_same_in_any_chunking(spark, tmp_path):
    rows = [(i % 40, i % 3, i) for i in range(120)]
    results = []
    for chunks in (1, 5):
        src = f"{tmp_path}/in{chunks}"
        for c in range(chunks):
            spark.createDataFrame(rows[c::chunks], "k bigint, f bigint, o bigint").coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema("k bigint, f bigint, o bigint").option("maxFilesPerTrigger", 1).parquet(src)
        upsert_stream(stream, f"{tmp_path}/out{chunks}", ["k", "f"], ["o"], f"{tmp_path}/cp{chunks}").awaitTermination()
        results.append({(r.k, r.f) for r in spark.read.parquet(*map(str, (tmp_path / f"out{chunks}").glob("0*"))).collect()})
        assert spark.read.parquet(*map(str, (tmp_path / f"out{chunks}").glob("0*"))).count() == len(results[-1])
    assert results[0] == results[1] == {(k, f) for k, f, _ in rows}


def test_ledger_stream(spark, tmp_path):
    day = 86_400
    for n, rows in enumerate([[(1, 10, 20), (2, day + 5, day + 9)], [(3, 11, day + 50), (4, 12, 9 * day)]]):
        spark.createDataFrame(rows, "id bigint, t bigint, a bigint").selectExpr("id", "timestamp_seconds(t) at", "timestamp_seconds(a) came").coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
    stream = spark.readStream.schema("id bigint, at timestamp, came timestamp").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    ledger = ReplayLedger(spark, f"{tmp_path}/ledger")
    ledger_stream(stream, ledger, None, "id", "at", "came", f"{tmp_path}/cp").awaitTermination()
    assert {(r.period, r.n, r.so_far) for r in ledger.outputs().collect()} == {(0, 2, 2), (1, 1, 3)}
    assert [r.id for r in ledger.rejected().collect()] == [4]
