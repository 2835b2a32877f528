from datetime import datetime, timezone

import pytest
from loomwire.plans.frequencies import frequency_tables
from loomwire.schemas import ARTICLES_CSV, CLEAN_COLUMNS, TREND_SCORES, keep_columns
from loomwire.sinks import snapshots as O
from loomwire.sources import files as I
from loomwire.sources import snapshots as S


def put(folder, name, text="title,ingested_at\na,2024-01-01\n"):
    (folder / name).write_text(text, encoding="utf-8")


def test_csv_quotes_and_line_breaks(spark, tmp_path):
    put(tmp_path, "x.csv", 'title,summary,link,matched_keywords,ingested_at,image_url\n"a ""b""","line\nbreak, x",,"k, l",2024-01-01,\n')
    row = I.read_csv(spark, str(tmp_path / "x.csv"), ARTICLES_CSV).first()
    assert (row["title"], row["summary"], row["link"], row["matched_keywords"]) == ('a "b"', "line\nbreak, x", None, "k, l")
    assert I.read_csv(spark, str(tmp_path / "x.csv")).columns == ARTICLES_CSV.names


def test_newest_raw(spark, tmp_path):
    folder = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        I.newest_raw(spark, folder, "raw")
    put(tmp_path, "raw_tagged_2.csv")
    put(tmp_path, "raw_zz.csv", "title\na\n")
    assert I.newest_raw(spark, folder, "raw").endswith("raw_tagged_2.csv")  # newest with the column
    put(tmp_path, "raw_20240101_000000.csv")
    put(tmp_path, "raw_20240102_000000.csv")
    assert I.newest_raw(spark, folder, "raw").endswith("raw_20240102_000000.csv")  # strict names win


def test_newest_with_fallback(spark, tmp_path):
    put(tmp_path, "c.csv")
    assert I.newest(spark, str(tmp_path), "c").endswith("/c.csv")
    with pytest.raises(FileNotFoundError):
        I.newest(spark, str(tmp_path), "c", fallback=False)
    put(tmp_path, "c_1.csv")
    assert I.newest(spark, str(tmp_path), "c").endswith("c_1.csv")


def test_all_history(spark, tmp_path):
    put(tmp_path, "h_1.csv", "title,n\na,1\nb,2\n")
    put(tmp_path, "h_2.csv", "title,n\nc,3\n")
    rows = I.all_history(spark, str(tmp_path), "h", "title string, n int").collect()
    assert sorted((r["title"], r["n"], r["source_file"]) for r in rows) == [("a", 1, "h_1.csv"), ("b", 2, "h_1.csv"), ("c", 3, "h_2.csv")]
    order = {r["title"]: r["row_ord"] for r in rows}
    assert order["a"] < order["b"]


def test_history_by_name(spark, tmp_path):
    put(tmp_path, "h_1.csv", 'title,link\n"T1, x",L1\n')
    put(tmp_path, "h_2.csv", "link,title\nL2,T2\n")
    put(tmp_path, "h_3.csv", "other,title\nx,T3\n")
    put(tmp_path, "h_4.csv", "title,link\n")
    (tmp_path / "old").mkdir()
    put(tmp_path / "old", "h_9.csv", "title,link\nT9,L9\n")
    rows = I.all_history(spark, str(tmp_path), "h", "title string, link string").collect()
    assert sorted((r["title"], r["link"], r["source_file"]) for r in rows) == [
        ("T1, x", "L1", "h_1.csv"), ("T2", "L2", "h_2.csv"), ("T3", None, "h_3.csv")]
    assert [r["name"] for r in I.left_out(spark, str(tmp_path), "h").collect()] == ["h_4.csv"]
    assert I.newest(spark, str(tmp_path), "h").endswith("h_4.csv")
    assert tuple(I.read_csv(spark, str(tmp_path / "h_2.csv"), "title string, link string").first()) == ("T2", "L2")


def test_guards(spark):
    with pytest.raises(ValueError, match="no rows"):
        I.non_empty(spark.range(0), "articles")
    assert I.non_empty(spark.range(1), "articles").count() == 1
    assert keep_columns(spark.range(1).selectExpr("1 AS topic", "2 AS link", "3 AS title"), CLEAN_COLUMNS).columns == ["link", "title"]


def test_snapshots(spark, tmp_path):
    root, latest = str(tmp_path / "scores"), str(tmp_path / "latest")
    assert S.read_previous(spark, root, TREND_SCORES).count() == 0
    first = spark.createDataFrame([("1", 1.0)], "topic string, trend_score double")
    second = spark.createDataFrame([("1", 3.0), ("2", 4.0)], "topic string, trend_score double")
    O.write_snapshot(first, root, "20240101_120000")
    O.write_snapshot(second, root, "20240102_090000")
    O.write_snapshot(second, root, "20240102_090000")  # a repeated job stores nothing twice
    assert sorted(tuple(r) for r in S.read_latest(spark, root).collect()) == [("1", 3.0), ("2", 4.0)]
    assert [tuple(r) for r in S.read_previous(spark, root, TREND_SCORES, before="20240102_090000").collect()] == [("1", 1.0)]
    assert S.read_previous(spark, root, TREND_SCORES, before="20230101_000000").count() == 0
    assert S.read_all(spark, root).count() == 3
    O.write_latest(spark, root, "20240101_120000", latest)
    O.write_latest(spark, root, "20240102_090000", latest)
    assert spark.read.parquet(latest).count() == 2


def test_union_and_new_since(spark):
    a, b = spark.createDataFrame([(1, "x")], "n int, s string"), spark.createDataFrame([(2,)], "n int")
    assert {tuple(r) for r in S.union_snapshots(a, b).collect()} == {(1, "x"), (2, None)}
    assert [tuple(r) for r in S.new_since(a.unionByName(b, True), b, ["n"]).collect()] == [(1, "x")]


def test_export_and_sheets(spark, tmp_path):
    df = spark.createDataFrame([('q "x"', ["a", "b"])], "title string, tags array<string>")
    O.export_csv(df, str(tmp_path / "csv"))
    assert tuple(I.read_csv(spark, str(tmp_path / "csv")).first()) == ('q "x"', "a, b")
    docs = spark.createDataFrame([(0, "red silk", "red"), (1, "silk dress", None)], "n int, title string, summary string")
    tables = frequency_tables(docs, "n", 2)
    O.write_sheets(str(tmp_path / "sheets"), words=tables["words"].toDF("entry", "Count"), bigrams=tables["bigrams"].toDF("entry", "Count"))
    got = {(r["sheet"], r["entry"], r["Count"]) for r in spark.read.parquet(str(tmp_path / "sheets")).collect()}
    assert got == {("words", "red", 2), ("words", "silk", 2), ("bigrams", "red silk", 2), ("bigrams", "silk red", 1)}


def test_archive(spark, tmp_path):
    folder, archive = str(tmp_path / "data"), str(tmp_path / "archive")
    (tmp_path / "data").mkdir()
    put(tmp_path / "data", "t_20240101_000000.csv")
    before = spark.createDataFrame(I.list_files(spark, folder).collect(), "path string, name string")
    put(tmp_path / "data", "t_20240102_000000.csv", "title,ingested_at\nb,2024-01-02\n")
    put(tmp_path / "data", "t_latest.csv")
    fresh = O.archive_new(spark, folder, before, archive, datetime(2024, 1, 2, tzinfo=timezone.utc), "t")
    assert [r["name"] for r in fresh.collect()] == ["t_20240102_000000.csv"]
    for _ in range(2):  # a repeated run stores nothing twice
        assert [tuple(r) for r in spark.read.parquet(archive).select("title", "run_day").collect()] == [("b", "02-01-2024")]
        O.archive_new(spark, folder, before, archive, datetime(2024, 1, 2, tzinfo=timezone.utc), "t")


def test_stamp():
    assert O.run_stamp(datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc)) == "20240102_030405"


def test_row_functions_work_on_streams(spark, tmp_path):
    from loomwire.functions import text as T, web as H
    from loomwire.operators.keywords import with_matches
    spark.createDataFrame([(1, "http://www.a/1", "<b>Silk</b> dress", "t")], "id int, link string, summary string, title string").write.parquet(str(tmp_path / "in"))
    seed = spark.createDataFrame([(0, "c", "silk")], "ord int, category string, keyword string")
    stream = spark.readStream.schema("id int, link string, summary string, title string").parquet(str(tmp_path / "in"))
    out = with_matches(stream, T.search_text(), seed).select(
        H.source_host().alias("source"), H.dedupe_key().alias("key"), T.html_to_text("summary").alias("text"),
        T.bigrams(T.tokens_strip("summary")).alias("pairs"), "matched_keywords", "tags")
    query = out.writeStream.format("memory").queryName("rows_out").trigger(availableNow=True).start()
    query.awaitTermination()
    row = spark.table("rows_out").first()
    assert (row["source"], row["text"], row["matched_keywords"], row["tags"]) == ("a", "Silk  dress", ["silk"], ["c"])
