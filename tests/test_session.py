"""Scratch files and their owners."""

import os
import threading

import pytest

from seqloom import session
from seqloom.llm import warc
from seqloom.sources import message_log


def test_a_job_deletes_its_scratch_files(spark):
    kept = session.materialize(spark.range(3).toDF("i"), "kept")
    with session.scratch_files(spark):
        staged = session.materialize(spark.range(5).toDF("i"), "staged")
        path = staged.inputFiles()[0].removeprefix("file:").replace("//", "/")
        assert staged.count() == 5 and os.path.exists(path)
    assert not os.path.exists(os.path.dirname(path))
    assert kept.count() == 3


def test_unfinished_writes_are_not_committed(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/part=2")
    spark.range(3).write.parquet(f"{tmp_path}/part=10")
    (tmp_path / "part=3").mkdir()
    found = session.committed(spark, f"{tmp_path}/part=*")
    assert [f.rpartition("/")[2] for f in found] == ["part=10", "part=2"]
    session.delete_path(spark, f"{tmp_path}/part=2")
    assert len(session.committed(spark, f"{tmp_path}/part=*")) == 1


@pytest.mark.parametrize("other", [True, False])
def test_formats_are_found_whichever_session_is_active(spark, tmp_path, other):
    own = spark.newSession()  # has no format registered yet
    sessions = spark._jvm.org.apache.spark.sql.classic.SparkSession
    found = []

    def work():
        if other:
            spark.newSession().createDataFrame([(1,)], "a int")  # makes that session the active one
        else:
            sessions.clearActiveSession()
        pages = own.sql("SELECT 1L AS page_id, 'u' AS url, 'x' AS html")
        warc.write_archives(warc.with_roles(pages), str(tmp_path / "archives"))
        found.append(warc.read_archives(own, str(tmp_path / "archives")).count())
        own.sql("SELECT 't' AS topic, 'k' AS key, 'v' AS value").write.parquet(str(tmp_path / "in"))
        rows = own.readStream.schema("topic string, key string, value string").parquet(str(tmp_path / "in"))
        log = str(tmp_path / "log")
        message_log.start_publishing(rows, log, str(tmp_path / "check"), "w").awaitTermination()
        found.append(message_log.read_log(own, log).count())
        found.append(message_log.stream_log(own, log).isStreaming)
        active = sessions.getActiveSession()
        found.append(active.isDefined() and not active.get().equals(own._jsparkSession) if other else not active.isDefined())

    thread = threading.Thread(target=work)
    thread.start()
    thread.join()
    assert found == [1, 1, True, True]
