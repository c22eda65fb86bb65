"""Documents written as one file each, without a folder, check sum or rename per file."""

from clutchforge.sources import raw_io


def test_documents_are_files_without_a_folder_each(spark, tmp_path):
    rows = [("map-1", "{\n1}"), ("map-1", "other"), ("map--2", ""), (None, None), ("a/b~c", "ü")]
    folder = f"file://{tmp_path}/docs"
    raw_io.write_whole_files(spark.createDataFrame(rows, "document string, text string").repartition(2), folder, "document", "text")
    files = [f for f in tmp_path.rglob("*") if f.is_file()]
    assert len(files) == 5 and len({f.parent for f in files}) <= 2
    got = raw_io.whole_files(spark, folder, "*.txt").select(raw_io.file_name("file_path").alias("n"), "doc").collect()
    assert sorted(map(tuple, got)) == sorted(((n or raw_io.NAMELESS), (t or "") + "\n") for n, t in rows)
    raw_io.write_whole_files(spark.createDataFrame([], "document string, text string"), f"{folder}-none", "document", "text")
    assert raw_io.whole_files(spark, f"{folder}-none", "*.txt").count() == 0


def test_a_repeated_task_leaves_one_set_of_files(spark, tmp_path):
    df = spark.createDataFrame([("x", "1"), ("y", "2")], "document string, text string").coalesce(1)
    for _ in range(2):
        raw_io.write_whole_files(df, f"file://{tmp_path}/docs", "document", "text")
    assert len([f for f in tmp_path.rglob("*") if f.is_file()]) == 2
