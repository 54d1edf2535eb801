"""Sources and sinks (S1-S5, K1-K3; E12, E14, E15, E19).

The JDBC tests use Derby embedded in memory: a database only the test's own
JVM sees; no server is started and no port is opened.
"""

from __future__ import annotations

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyloom.plans import catalog_first_column, jdbc_round_trip, word_count_job
from tallyloom.session import shared_dir
from tallyloom.sinks import once, tap, write_jdbc, write_lines
from tallyloom.sources import (
    from_rows,
    jdbc_options,
    jdbc_ranges,
    kafka_options,
    read_jdbc,
    read_kafka,
    read_lines,
    read_stream_files,
    read_table,
    stream_path,
)

DERBY = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def test_g7_read_lines_separators_bom_empty(spark, scratch):
    os.makedirs(scratch, exist_ok=True)
    with open(f"{scratch}/t.txt", "wb") as fh:
        fh.write("\ufeffa b\r\nc\rd\n\ne".encode())
    got = sorted(r.line for r in read_lines(spark, scratch).collect())
    assert got == ["", "a b", "c", "d", "e"]


def test_write_then_read_lines(spark, scratch):
    write_lines(from_rows(spark, ["x y", "z"]), scratch)
    assert sorted(r.line for r in read_lines(spark, scratch).collect()) == ["x y", "z"]


def test_word_count_job_writes_pair_text(spark, scratch):
    write_lines(from_rows(spark, ["hello world", "hello flink", "hello flink spark"]), f"{scratch}/in")
    word_count_job(spark, f"{scratch}/in", f"{scratch}/out")
    got = sorted(r.line for r in read_lines(spark, f"{scratch}/out").collect())
    assert got == ["KV{flink, 2}", "KV{hello, 3}", "KV{spark, 1}", "KV{world, 1}"]


def test_g6_catalog_table_first_column(spark, scratch):
    from_rows(spark, [("x", 1), (None, 2)], "c0 string, c1 int").write.parquet(scratch)
    spark.catalog.createTable("g6_table", path=scratch, source="parquet")
    assert {r.first_col for r in catalog_first_column(spark, "g6_table").collect()} == {"x", None}
    assert read_table(spark, "g6_table").columns == ["c0", "c1"]


def test_jdbc_options_partitioned_query_is_wrapped():
    opts = jdbc_options("jdbc:x", query="select * from t", partition_column="id", lower_bound=0, upper_bound=9, num_partitions=3)
    assert opts["dbtable"] == "(select * from t) q" and "query" not in opts and opts["numPartitions"] == "3"
    assert jdbc_options("jdbc:x", table="t")["dbtable"] == "t"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", query="q", table="t")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", table="t", partition_column="id")


def test_kafka_options():
    opts = kafka_options("h:9092", "topic")
    assert opts["subscribe"] == "topic" and opts["startingOffsets"] == "latest"
    assert kafka_options("h:9092", "topic", "earliest")["startingOffsets"] == "earliest"


def test_stream_path_for_single_file(scratch):
    os.makedirs(scratch)
    f = f"{scratch}/events.parquet"
    open(f, "wb").close()
    assert stream_path(f).endswith("events.parque[t]")
    assert stream_path(scratch) == scratch


def test_read_stream_files_single_file(spark):
    path = "/root/testdata/sf0.001/events.parquet"
    schema = spark.read.parquet(path).schema
    assert read_stream_files(spark, path, schema).isStreaming


def test_tap_counts_rows_in_the_same_job(spark):
    df = from_rows(spark, ["a", "b", None])
    observed, obs = tap(df, "t1", {"nulls": F.count_if(F.col("line").isNull())})
    observed.write.format("noop").mode("overwrite").save()
    assert obs.get == {"rows": 3, "nulls": 1}


def _derby(spark, name):
    url = f"jdbc:derby:memory:{name};create=true"
    jvm = spark.sparkContext._jvm
    # keep Derby's log out of the working folder (read when Derby first starts)
    jvm.java.lang.System.setProperty("derby.stream.error.file", f"{shared_dir(spark)}/derby.log")
    jvm.java.lang.Class.forName(DERBY)
    conn = jvm.java.sql.DriverManager.getConnection(url)
    st = conn.createStatement()
    st.execute("create table people (id varchar(50) not null primary key, name varchar(50))")
    st.execute("create table name_counts_out (name varchar(50) not null primary key, count varchar(50))")
    for i, n in (("1", "'a'"), ("2", "'a'"), ("3", "'b'"), ("4", "null")):
        st.execute(f"insert into people values ('{i}', {n})")
    conn.close()
    return url


def test_g4_jdbc_round_trip_on_embedded_derby(spark):
    url = _derby(spark, "g4")
    obs = jdbc_round_trip(
        spark, url, "select * from people", url, "name_counts_out",
        source_options={"driver": DERBY, "single_task": True}, target_options={"driver": DERBY},
    )
    out = read_jdbc(spark, url, table="name_counts_out", driver=DERBY)
    assert rows(out, "NAME", "COUNT") == [("a", "20"), ("b", "10")]
    assert obs.get["null_names"] == 1
    # A second append hits the primary key, as a plain insert does.
    with pytest.raises(Exception):
        jdbc_round_trip(
            spark, url, "select * from people", url, "name_counts_out",
            source_options={"driver": DERBY, "single_task": True}, target_options={"driver": DERBY},
        )


def test_jdbc_round_trip_must_say_how_it_reads(spark):
    with pytest.raises(ValueError):
        jdbc_round_trip(spark, "jdbc:x", "select 1", "jdbc:x", "t")


def test_null_lines_are_left_out_and_counted(spark, scratch):
    assert write_lines(from_rows(spark, ["a", None, "", None]), scratch) == {"rows": 4, "null_lines": 2}
    assert sorted(r.line for r in read_lines(spark, scratch).collect()) == ["", "a"]


def test_jdbc_parallel_reads(spark):
    url = _derby(spark, "par")
    by_range = read_jdbc(
        spark, url, query="select cast(id as int) as nid, name from people", driver=DERBY,
        partition_column="nid", lower_bound=1, upper_bound=5, num_partitions=2,
    )
    assert by_range.rdd.getNumPartitions() == 2 and by_range.count() == 4
    by_pred = read_jdbc(spark, url, table="people", driver=DERBY, predicates=["id < '3'", "id >= '3'"])
    assert by_pred.rdd.getNumPartitions() == 2 and by_pred.count() == 4


def test_write_jdbc_overwrite_truncate(spark):
    url = _derby(spark, "ow")
    df = from_rows(spark, [("z", "1")], "NAME string, COUNT string")
    write_jdbc(df, url, "name_counts_out", mode="overwrite", driver=DERBY, extra={"truncate": "true"})
    write_jdbc(df, url, "name_counts_out", mode="overwrite", driver=DERBY, extra={"truncate": "true"})
    assert read_jdbc(spark, url, table="name_counts_out", driver=DERBY).count() == 1


def test_jdbc_pushes_filters_and_columns(spark):
    url = _derby(spark, "push")
    df = read_jdbc(spark, url, table="people", driver=DERBY).filter(F.col("NAME") == "a").select("NAME")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(NAME,a)" in plan and "ReadSchema: struct<NAME:string>" in plan
    assert df.count() == 2


def test_read_kafka_without_connector_says_what_to_add(spark):
    try:
        df = read_kafka(spark, "localhost:9092", "topic")
    except RuntimeError as exc:
        assert "--packages org.apache.spark:spark-sql-kafka" in str(exc)
    else:  # connector present: the frame has the record columns
        assert df.columns == ["key", "value", "timestamp"]


def test_jdbc_partitioned_read_finds_its_bounds(spark):
    url = _derby(spark, "bounds")
    df = read_jdbc(
        spark, url, query="select cast(id as int) as nid, name from people", driver=DERBY,
        partition_column="nid", num_partitions=3,
    )
    assert df.rdd.getNumPartitions() == 3
    assert sorted(r.NID for r in df.collect()) == [1, 2, 3, 4]


OUT_TYPES = "NAME VARCHAR(50), COUNT VARCHAR(50)"


def _out(spark, url):
    return rows(read_jdbc(spark, url, table="name_counts_out", driver=DERBY), "NAME", "COUNT")


def test_an_insert_with_a_retried_task_holds_every_row_once(spark, monkeypatch):
    url = _derby(spark, "once")
    real = once.write_jdbc

    def task_run_again(df, *args, **kwargs):
        """A task commits its rows, is lost, and runs again: the first half of the rows arrives a second time."""
        real(df, *args, **kwargs)
        real(df.filter(F.col("tl_row") < 2), *args, **{**kwargs, "mode": "append"})

    monkeypatch.setattr(once, "write_jdbc", task_run_again)
    df = from_rows(spark, [("a", "1"), ("b", "2"), ("c", "3"), ("d", "1")], "name string, count string").coalesce(1)
    assert once.write_jdbc_once(df, url, "name_counts_out", "job", column_types=OUT_TYPES, driver=DERBY)
    assert _out(spark, url) == [("a", "1"), ("b", "2"), ("c", "3"), ("d", "1")]
    # a rerun of the job inserts nothing; the primary key is not even asked
    assert not once.write_jdbc_once(df, url, "name_counts_out", "job", column_types=OUT_TYPES, driver=DERBY)
    assert len(_out(spark, url)) == 4
    with once._connection(spark, url, DERBY, None, None) as conn:
        names = conn.getMetaData().getTables(None, "APP", None, None)
        left = set()
        while names.next():
            left.add(names.getString("TABLE_NAME"))
    assert left == {"PEOPLE", "NAME_COUNTS_OUT", "TL_COMMITS"}  # no staging table stays


def test_a_failed_move_leaves_neither_rows_nor_a_ledger_entry(spark):
    url = _derby(spark, "oncefail")
    twice = from_rows(spark, [("a", "1"), ("a", "2")], "name string, count string")
    with pytest.raises(Exception):
        once.write_jdbc_once(twice, url, "name_counts_out", "job", column_types=OUT_TYPES, driver=DERBY)
    assert _out(spark, url) == []
    good = from_rows(spark, [("a", "1")], "name string, count string")
    assert once.write_jdbc_once(good, url, "name_counts_out", "job", column_types=OUT_TYPES, driver=DERBY)
    assert _out(spark, url) == [("a", "1")]
    with pytest.raises(ValueError, match="no columns"):
        once.write_jdbc_once(good.withColumn("x", F.lit(1)), url, "name_counts_out", "job2", driver=DERBY)


def test_a_replayed_micro_batch_is_inserted_once(spark, scratch):
    url = _derby(spark, "oncestream")
    for part in ([("a", "1")], [("b", "2"), ("c", "3")]):
        from_rows(spark, part, "name string, count string").coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    stream = read_stream_files(spark, f"{scratch}/in", "name string, count string", max_files_per_trigger=1)
    for checkpoint in ("one", "two"):  # a lost checkpoint replays every batch under its number
        query = once.write_jdbc_once_stream(
            stream, f"{scratch}/{checkpoint}", url, "name_counts_out", "stream", {"availableNow": True}, column_types=OUT_TYPES, driver=DERBY
        )
        query.awaitTermination()
        assert query.exception() is None
        assert _out(spark, url) == [("a", "1"), ("b", "2"), ("c", "3")]


def _skewed(spark, name):
    """Keys with a gap and a crowd: 900 of 1,000 within a thousandth of the span, 20 nulls besides."""
    url = _derby(spark, name)
    with once._connection(spark, url, DERBY, None, None) as conn:
        once._run(conn, "create table skewed (k bigint, t varchar(40), d date, v int)")
        statement = conn.prepareStatement("insert into skewed values (?, ?, ?, ?)")
        for i in range(1020):
            k = None if i >= 1000 else i if i < 900 else i * 1000
            statement.setObject(1, k, spark.sparkContext._jvm.java.sql.Types.BIGINT)
            statement.setObject(2, None if k is None else f"it's {k % 251:03d}x", spark.sparkContext._jvm.java.sql.Types.VARCHAR)
            day = None if k is None else spark.sparkContext._jvm.java.sql.Date.valueOf(f"20{10 + i % 7}-0{1 + i % 9}-1{i % 10}")
            statement.setObject(3, day, spark.sparkContext._jvm.java.sql.Types.DATE)
            statement.setObject(4, i, spark.sparkContext._jvm.java.sql.Types.INTEGER)
            statement.addBatch()
        statement.executeBatch()
        statement.close()
    return url


@pytest.mark.parametrize("column", ["k", "t", "d"])
def test_ranges_by_content_are_even_and_cover_every_row(spark, column):
    url = _skewed(spark, f"ranges{column}")
    where = jdbc_ranges(spark, url, column, 8, table="skewed", sample=300, driver=DERBY)
    df = read_jdbc(spark, url, table="skewed", predicates=where, driver=DERBY)
    assert df.rdd.getNumPartitions() == len(where) == 8
    sizes = sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
    assert sorted(r.V for r in df.collect()) == list(range(1020))
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_ranges_of_few_values_and_empty_tables(spark):
    url = _derby(spark, "fewranges")
    where = jdbc_ranges(spark, url, "name", 4, query="select * from people", driver=DERBY)
    df = read_jdbc(spark, url, query="select * from people", predicates=where, driver=DERBY)
    assert sorted(r.ID for r in df.collect()) == ["1", "2", "3", "4"]
    assert jdbc_ranges(spark, url, "name", 4, table="name_counts_out", driver=DERBY) == ["1 = 1"]
    with pytest.raises(ValueError):
        jdbc_ranges(spark, url, "name", 0, table="people", driver=DERBY)
