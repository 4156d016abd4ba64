from pyspark.sql import functions as F

from wavelens.plans.flow import PARTITION, Layout, read_silver
from wavelens.sources import writers


def test_an_empty_wave_replaces_its_rows_and_no_others(spark, tmp_path):
    path, rows = str(tmp_path / "waves"), spark.range(4)
    for wave in ("01", "02"):
        writers.write_wave(rows, path, wave)
    writers.write_wave(rows.filter("false"), path, "01")
    got = spark.read.parquet(path).groupBy("edition").count().collect()
    assert [(str(r[0]), r[1]) for r in got] == [("2", 4)]


def test_wave_names_stay_text(spark, tmp_path):
    layout = Layout(str(tmp_path))
    for wave in ("01", "02"):
        writers.write_wave(spark.range(2), layout.silver, wave, PARTITION)
    assert {r[0] for r in read_silver(spark, layout, "wave").select("wave").collect()} == {"01", "02"}


def test_a_second_registration_keeps_comment_and_takes_new_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.range(3).withColumn("p", F.lit("a b"))
    first.write.partitionBy("p").parquet(path)
    writers.register_table(first, "kept_entry", path, ["p"])
    spark.sql("COMMENT ON TABLE kept_entry IS 'reviewed'")
    more = spark.range(2).withColumn("x", F.lit(1)).withColumn("p", F.lit("c"))
    more.write.mode("append").partitionBy("p").parquet(path)
    writers.register_table(first.select("id", F.lit(1).alias("x"), "p"), "kept_entry", path, ["p"])
    facts = {r[0]: r[1] for r in spark.sql("DESCRIBE TABLE EXTENDED kept_entry").collect()}
    assert facts["Comment"] == "reviewed"
    assert spark.table("kept_entry").count() == 5 and "x" in spark.table("kept_entry").columns
    spark.sql("DROP TABLE kept_entry")


def test_one_file_under_the_asked_name(spark, tmp_path):
    path = tmp_path / "out.csv"
    frame = spark.createDataFrame([(i, f"ç{i}") for i in range(50)], "n int, t string").repartition(5).orderBy("n")
    for _ in range(2):
        writers.export_file(frame, str(path))
    data = path.read_bytes()
    assert data.startswith(b"\xef\xbb\xbfn;t\n") and data.decode("utf-8-sig").splitlines()[1:] == [f"{i};ç{i}" for i in range(50)]
