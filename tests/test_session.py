import os
import subprocess
import sys
import textwrap

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(code, tmp_path):
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path)}
    return subprocess.run(
        [sys.executable, "-c", f"import sys; sys.path.insert(0, {REPO!r})\n" + textwrap.dedent(code)],
        env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300,
    )


def test_scratch_folder_without_a_setting(tmp_path):
    """No shared folder named: one temporary folder locally."""
    done = run(
        """
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
        from ampledger.session import scratch_path
        a, b = scratch_path(spark, "a"), scratch_path(spark, "b")
        print(a.rsplit("/", 1)[0] == b.rsplit("/", 1)[0], a != b)
        """,
        tmp_path,
    )
    assert "True True" in done.stdout, done.stderr[-2000:]


def test_scratch_folder_of_the_session(spark):
    from ampledger.session import scratch_path

    folder = f"{spark.conf.get('spark.checkpoint.dir')}/staged-{spark.sparkContext.applicationId}"
    assert scratch_path(spark, "x").startswith(folder + "/x-")


def staged(spark):
    """Files of all staged tables, and the names of the tables."""
    top = spark.conf.get("spark.checkpoint.dir") + f"/staged-{spark.sparkContext.applicationId}"
    return {name for name in os.listdir(top)} if os.path.isdir(top) else set()


def test_scopes_delete_what_they_own(spark):
    from ampledger.session import staging
    from ampledger.sources.sinks import stage

    before = staged(spark)
    with staging(spark):
        stage(spark.range(3))
        with staging(spark):
            stage(spark.range(4))
            kept = stage(spark.range(5), outlive=True)
            assert len(staged(spark) - before) == 3
        assert kept.count() == 5
        assert len(staged(spark) - before) == 2
    assert staged(spark) == before
    with pytest.raises(ZeroDivisionError), staging(spark):
        stage(spark.range(3))
        1 / 0
    assert staged(spark) == before


def test_store_keeps_the_result_alone(spark, tmp_path):
    from ampledger.session import store
    from ampledger.sources.sinks import stage

    before = staged(spark)
    assert store(spark, lambda: stage(spark.range(7)).filter("id > 2"), str(tmp_path / "out")).count() == 4
    assert staged(spark) == before


def test_staged_tables_go_with_the_application(tmp_path):
    done = run(
        f"""
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate()
        from ampledger.sources.sinks import stage
        print("rows", stage(spark.range(3)).count())
        spark.stop()
        """,
        tmp_path,
    )
    assert "rows 3" in done.stdout, done.stderr[-2000:]
    assert not [f for _, _, files in os.walk(tmp_path / "shared") for f in files]


def test_build_session_keeps_the_running_one(spark):
    from ampledger.session import build_session

    again = build_session("tests", {"spark.sql.shuffle.partitions": "2"})
    assert again.conf.get("spark.sql.session.timeZone") == "UTC"
    assert again.sparkContext is spark.sparkContext
