import threading
from types import SimpleNamespace

import pytest

from sievestream.session import cut_lineage, rows_within, work_dir, work_scope


def session_without_setting(master):
    context = SimpleNamespace(master=master, applicationId=f"app-{master}")
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)


def test_work_folders_are_shared_and_distinct(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first != second and first.startswith(f"{root}/x-")


def test_without_setting_only_local_mode_gets_a_folder():
    local = session_without_setting("local[2]")
    assert work_dir(local, "a").rsplit("/", 1)[0] == work_dir(local, "b").rsplit("/", 1)[0]
    with pytest.raises(ValueError):
        work_dir(session_without_setting("spark://host"), "a")


def test_bounded_read(spark):
    assert len(rows_within(spark.range(3), 24)) == 3
    assert rows_within(spark.range(4), 24) is None
    assert rows_within(spark.range(0), 24) == []


def test_scopes_of_other_threads_keep_their_tables(spark):
    """One scope opens and closes while another one is still reading what it wrote."""
    opened, closed, counted = threading.Event(), threading.Event(), []

    def other():
        with work_scope(spark):
            frame = cut_lineage(spark.range(7), "other")
            opened.set()
            assert closed.wait(60)
            counted.append(frame.count())

    thread = threading.Thread(target=other)
    with work_scope(spark):
        cut_lineage(spark.range(3), "own")
        thread.start()
        assert opened.wait(60)
    closed.set()
    thread.join()
    assert counted == [7]


def test_inner_scopes_leave_the_outer_ones_tables(spark):
    with work_scope(spark):
        outer = cut_lineage(spark.range(4), "outer")
        with work_scope(spark):
            inner = cut_lineage(spark.range(5), "inner")
            assert inner.count() == 5
        assert outer.count() == 4
