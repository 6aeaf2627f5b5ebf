from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from filingscope.operators.changes import filing_changes
from filingscope.operators.points import score_changes
from filingscope.schemas import RUN_LOG
from filingscope.session import shared_dir
from filingscope.sinks import tables
from filingscope.sources.csv_files import CSV_NAMES, list_files, new_files, read_filing_csv
from filingscope.sources.normalize import accepted
from filingscope.streaming import incremental

HEADER = "SEC#,5F(2)(c),5F(2)(f),5D(a)(1),Count of 11A,Chief Compliance Officer Name"


def monthly(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(HEADER + "\n" + "\n".join(rows) + "\n")


def keyed(df):
    return sorted(map(str, df.collect()))


def run(spark, tmp_path, files_per_batch=1):
    incremental.ingest_stream(
        spark, str(tmp_path / "in"), str(tmp_path / "store"), str(tmp_path / "progress"), files_per_batch
    ).awaitTermination()


@pytest.mark.parametrize("files_per_batch", [1, 10])
def test_batches_end_up_as_one_run(spark, tmp_path, files_per_batch):
    source = tmp_path / "in"
    monthly(source, "ia03012022.csv", "801-1,50,5,5,1,B", "801-2,10,1,1,0,X")
    monthly(source, "ia01032022.csv", "801-1,100,10,10,0,A")
    run(spark, tmp_path, files_per_batch)
    monthly(source, "ia020122.csv", "801-1,90,9,9,1,A")  # late: older than what is already there
    run(spark, tmp_path, files_per_batch)
    whole = score_changes(filing_changes(accepted(read_filing_csv(spark, str(source)))))
    assert keyed(incremental.current_scores(spark, str(tmp_path / "store"))) == keyed(whole)
    assert whole.count() == 4
    run(spark, tmp_path, files_per_batch)  # nothing new
    assert incremental.stored_filings(spark, str(tmp_path / "store")).count() == 4


def test_a_repeated_batch_changes_nothing_and_a_later_one_corrects(spark, tmp_path):
    store = str(tmp_path / "store")
    monthly(tmp_path / "one", "ia01032022.csv", "801-1,100,10,10,0,A", "801-2,7,1,1,0,A")
    monthly(tmp_path / "two", "ia01032022-2.csv", "801-1,60,10,10,0,A")
    first, second = (accepted(read_filing_csv(spark, str(tmp_path / d))) for d in ("one", "two"))
    for _ in range(2):
        incremental.load_batch(spark, store, first, 0)
    assert incremental.stored_filings(spark, store).count() == 2
    incremental.load_batch(spark, store, second, 1)
    raum = {r.sec_number: int(r.raum) for r in incremental.current_filings(spark, store).collect()}
    assert raum == {"801-1": 60, "801-2": 7}
    assert incremental.current_scores(spark, store).count() == 2


def test_upsert_keeps_creation_time(spark):
    schema = "k int, v string, created_at int"
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 10), (4, None, 10)], schema)
    new = spark.createDataFrame([(2, None, 20), (3, "C", 20)], schema)
    assert sorted(map(tuple, tables.upsert(old, new, ["k"], "created_at").collect())) == [
        (1, "a", 10), (2, None, 10), (3, "C", 20), (4, None, 10),
    ]
    assert sorted(map(tuple, tables.upsert(old, new, ["k"]).collect()))[1] == (2, None, 20)


def test_upsert_refuses_two_updates_of_one_key(spark):
    schema = "k int, v string"
    old = spark.createDataFrame([(1, "a")], schema)
    with pytest.raises(Exception, match="repeated key"):
        tables.upsert(old, spark.createDataFrame([(1, "b"), (1, "c")], schema), ["k"]).collect()


def test_append_replace_and_documents(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "x"), (2, None)], "n int, t string")
    tables.append(rows, path)
    tables.append(rows, path)
    assert spark.read.parquet(path).count() == 4
    tables.replace(rows, path)
    assert spark.read.parquet(path).count() == 2
    assert sorted(r.document for r in tables.as_documents(rows).collect()) == ['{"n":1,"t":"x"}', '{"n":2,"t":null}']


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "runs")
    tables.log_run(spark, path, "load", "completed", datetime(2024, 1, 1), datetime(2024, 1, 1, 1), files=3, records=9)
    tables.log_run(spark, path, "fetch", "failed", datetime(2024, 1, 2), error="timeout")
    rows = spark.read.schema(RUN_LOG).parquet(path).orderBy("started_at").collect()
    assert [(r.run_type, r.status, r.files_processed, r.error_message) for r in rows] == [
        ("load", "completed", 3, None), ("fetch", "failed", 0, "timeout"),
    ]


class Session:
    """What shared_dir asks of a session."""

    def __init__(self, master, settings):
        self.conf = settings
        self.sparkContext = self
        self.master = master

    def getCheckpointDir(self):
        return None


def test_shared_folder_follows_the_setting():
    assert shared_dir(Session("yarn", {"spark.checkpoint.dir": "hdfs:///work/"}), "x").startswith("hdfs:///work/x-")
    with pytest.raises(ValueError):
        shared_dir(Session("yarn", {}), "x")


def test_shared_folders_of_a_local_session_are_fresh(spark):
    assert shared_dir(spark, "x") != shared_dir(spark, "x")


@pytest.mark.parametrize("batches", [[["a", "b"]], [["a"], ["b"]]])
def test_a_correction_wins_however_files_are_batched(spark, tmp_path, batches):
    store = str(tmp_path / "store")
    monthly(tmp_path / "a", "ia01032022.csv", "801-1,100,10,10,0,A")
    monthly(tmp_path / "b", "ia01032022-2.csv", "801-1,60,10,10,0,A")
    for number, folders in enumerate(batches):
        rows = accepted(read_filing_csv(spark, [str(tmp_path / f) for f in folders]))
        incremental.load_batch(spark, store, rows, number)
    assert [int(r.raum) for r in incremental.current_filings(spark, store).collect()] == [60]


def test_a_correction_can_take_a_score_away(spark, tmp_path):
    store = str(tmp_path / "store")
    monthly(tmp_path / "one", "ia01032022.csv", "801-1,100,10,10,0,A", "801-2,7,1,1,0,A")
    monthly(tmp_path / "two", "ia01032022-2.csv", "801-1,0,10,10,0,A")
    for number, folder in enumerate(("one", "two")):
        incremental.load_batch(spark, store, accepted(read_filing_csv(spark, str(tmp_path / folder))), number)
    assert [r.sec_number for r in incremental.current_scores(spark, store).collect()] == ["801-2"]
    rows = accepted(read_filing_csv(spark, str(tmp_path / "two")))
    incremental.load_batch(spark, store, rows.limit(0), 1)  # the batch again, now without its file's rows
    assert incremental.stored_filings(spark, store).count() == 2


def test_an_unreadable_file_does_not_stop_the_stream(spark, tmp_path):
    source = tmp_path / "in"
    monthly(source, "ia01032022.csv", "801-1,100,10,10,0,A")
    (source / "ia02032022.csv").write_text("no header here\n1\n")
    run(spark, tmp_path, 1)
    assert incremental.current_scores(spark, str(tmp_path / "store")).count() == 1


def test_a_month_in_order_is_scored_without_the_history(spark, tmp_path):
    """Everything that was stored but the state is made unreadable."""
    store = str(tmp_path / "store")
    months = [f"ia{m:02d}012022.csv" for m in range(1, 6)]
    for i, name in enumerate(months):
        lines = [f"801-{f},{(7 * f + 13 * i * i + 5) % 90},{10 + i},{f},{i % 2},{'ABC'[(f + i) % 3]}" for f in range(1, 9) if (f + i) % 4]
        monthly(tmp_path / "in", name, *lines)
        if i == 4:
            for path in [*tmp_path.glob("store/filings/**/*.parquet"), *tmp_path.glob("store/scores/**/*.parquet")]:
                path.rename(path.with_suffix(".away"))
        incremental.load_batch(spark, store, accepted(read_filing_csv(spark, str(tmp_path / "in" / name))), i)
    for path in tmp_path.glob("store/**/*.away"):
        path.rename(path.with_suffix(".parquet"))
    whole = score_changes(filing_changes(accepted(read_filing_csv(spark, str(tmp_path / "in")))))
    assert keyed(incremental.current_scores(spark, store)) == keyed(whole)


def test_outcomes_of_a_batch_can_be_read_afterwards(spark, tmp_path):
    source, store = tmp_path / "in", str(tmp_path / "store")
    monthly(source, "ia01032022.CSV", "801-1,100,10,10,0,A", ",1,1,1,0,A")
    monthly(source, "ia02032022.Csv", "801-1,90,10,10,0,A,too,long")
    (source / "ia03032022.csv").write_text("no header here\n1\n")
    (source / "ia04032022.csv").write_text("")
    (source / "ia05032022.csv").write_text(HEADER + "\n")
    run(spark, tmp_path, 2)
    files = incremental.loaded_files(spark, store)
    told = {r.path.rsplit("/", 1)[-1]: (r.rows_loaded, r.rows_rejected, r.message) for r in files.collect()}
    assert told == {
        "ia01032022.CSV": (1, 1, "Success"),
        "ia02032022.Csv": (0, 1, "No valid records"),
        "ia03032022.csv": (0, 0, "no header line with the key column"),
        "ia05032022.csv": (0, 0, "No valid records"),
    }
    assert sorted(r.reject_reason for r in incremental.stored_rejects(spark, store).collect()) == [
        "No valid records", "missing SEC number", "no header line with the key column", "too many fields",
    ]
    assert new_files(list_files(spark, str(source), CSV_NAMES), files).count() == 0
    monthly(source, "ia06032022.csv", "801-1,100,10,10,0,A")
    waiting = {r.path.rsplit("/", 1)[-1]: r.message for r in incremental.unloaded_files(spark, str(source), store).collect()}
    assert waiting == {"ia04032022.csv": "empty file", "ia06032022.csv": "not loaded yet"}
    incremental.compact(spark, store)
    assert incremental.loaded_files(spark, store).count() == 4 and incremental.current_scores(spark, store).count() == 1


def test_a_failed_batch_leaves_the_store_as_it_was(spark, tmp_path):
    store = str(tmp_path / "store")
    monthly(tmp_path / "one", "ia01032022.csv", "801-1,100,10,10,0,A")
    first = accepted(read_filing_csv(spark, str(tmp_path / "one")))
    incremental.load_batch(spark, store, first, 0)
    bad = first.withColumn("firm_name", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        incremental.load_batch(spark, store, bad, 1)
    assert incremental.stored_filings(spark, store).count() == 1
    assert incremental.current_scores(spark, store).count() == 1


def test_a_batch_is_deduped_once_and_let_go(spark, history, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from filingscope.schemas import FILING, conform
    from filingscope.streaming import incremental

    kept, levels, state = [], [], incremental.firm_state

    def told(rows, *rest):
        kept.append(rows)
        levels.append(rows.storageLevel.useDisk)
        return state(rows, *rest)

    monkeypatch.setattr(incremental, "firm_state", told)
    batch = conform(history(("801-1", "2020-01-02", 5)), FILING).withColumn("source_file", F.lit("ia01022020.csv"))
    incremental.load_batch(spark, str(tmp_path / "store"), batch, 0, buckets=2)
    assert levels == [True] and not kept[0].storageLevel.useDisk
    assert incremental.current_scores(spark, str(tmp_path / "store")).count() == 1


def test_late_filings_are_told_apart_once(spark, tmp_path, monkeypatch):
    from filingscope.schemas import FILING

    kept, calls, state = [], spark.sparkContext.accumulator(0), incremental.firm_state

    def told(history, carried=None):
        kept.append(history.storageLevel.useDisk)
        return state(history, carried)

    def name(path):
        calls.add(1)
        return path

    monkeypatch.setattr(incremental, "firm_state", told)
    monkeypatch.setattr(incremental, "arrival_order", F.udf(name, "string"))
    store, firms = str(tmp_path / "store"), spark.range(300).select(F.format_string("801-%d", "id").alias("sec_number"))
    for number, day in enumerate(("2024-02-01", "2024-01-01")):  # the second one is late for every firm
        values = {"filing_date": F.lit(day).cast("date"), "raum": F.lit(60_000_000), "source_file": F.lit(f"ia{number}.csv")}
        rows = firms.select("sec_number", *[v.alias(n) for n, v in values.items()])
        rows = rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in FILING], "source_file")
        incremental.load_batch(spark, store, rows, number, buckets=2)
    assert incremental.current_scores(spark, store).count() == 600
    assert kept[-1] and 0 < calls.value < 300  # by names, of which there are two; the history is kept for scores and state
