"""Tables on the way belong to the block, and the thread, that wrote them."""

import threading

from skyloom.llm.common import materialise, released


def test_a_block_leaves_other_threads_tables_alone(spark):
    kept, ready, done = [], threading.Event(), threading.Event()

    def other():
        with released(spark):
            kept.append(materialise(spark.range(7), "other"))
            ready.set()
            done.wait(60)
            kept.append(kept[0].count())

    with released(spark):
        t = threading.Thread(target=other)
        t.start()
        assert ready.wait(60)
        mine = materialise(spark.range(5), "mine")
        with released(spark):
            inner = materialise(spark.range(3), "inner")
            gone = spark._jvm.org.apache.hadoop.fs.Path(inner.inputFiles()[0])
            assert inner.count() == 3
        assert not gone.getFileSystem(spark._jsc.hadoopConfiguration()).exists(gone)
        assert mine.count() == 5
    done.set()
    t.join()
    assert kept[1] == 7


def test_without_a_block_a_table_stays(spark):
    table = materialise(spark.range(4), "stays")
    with released(spark):
        pass
    assert table.count() == 4
