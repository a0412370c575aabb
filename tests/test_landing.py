import json

from pyspark.sql import functions as F

from mentionlake.schemas import SUBMISSIONS
from mentionlake.sources import landing


def put(root, sort, subreddit, date, name, lines):
    folder = root / "reddit" / sort / f"subreddit={subreddit}" / f"date={date}"
    folder.mkdir(parents=True, exist_ok=True)
    text = [line if isinstance(line, str) else json.dumps(line) for line in lines]
    (folder / name).write_text("\n".join(text) + "\n")


def lake_files(root):
    put(root, "top", "phones", "05-01-2024", "submissions.jsonl", [{"id": "a", "score": 1, "extra": 5}, {"id": "b", "score": "many"}])
    put(root, "top", "phones", "05-01-2024", "submissions.part1.jsonl", [{"id": "c", "subreddit": "Named"}])
    put(root, "top", "phones", "05-01-2024", "comments.jsonl", [{"id": "x", "body": "hello"}])
    put(root, "controversial", "tabs", "06-01-2024", "submissions.jsonl", [
        {"id": "d", "awards": {"gold": 2}}, '{"id": "e", "title": "cut', "no json", {"title": "without id"},
    ])
    return str(root / "reddit")


def test_scan_takes_rotated_parts_and_one_kind(spark, tmp_path, rows):
    root = lake_files(tmp_path)
    good, _ = landing.split_corrupt(landing.read_landing(spark, root, "submissions"))
    assert rows(good, "id", "score", "subreddit", "source_sort_type", "partition_date") == [
        ("a", 1, "phones", "top", "05-01-2024"), ("b", None, "phones", "top", "05-01-2024"),
        ("c", None, "Named", "top", "05-01-2024"), ("d", None, "tabs", "controversial", "06-01-2024"),
    ]
    assert good.columns[: len(SUBMISSIONS)] == SUBMISSIONS.names
    assert rows(landing.read_landing(spark, root, "comments"), "id", "body") == [("x", "hello")]


def test_bad_lines_are_set_aside(spark, tmp_path, rows):
    _, bad = landing.split_corrupt(landing.read_landing(spark, lake_files(tmp_path), "submissions"))
    assert rows(bad, "reason", "line") == [
        ("malformed", "no json"), ("malformed", '{"id": "e", "title": "cut'), ("no_id", None),
    ]


def test_date_goes_into_the_path(spark, tmp_path):
    root = lake_files(tmp_path)
    day = landing.read_landing(spark, root, "submissions", "05-01-2024")
    assert day.select("source_file").distinct().count() == 2
    assert sorted(r.id for r in day.select("id").collect()) == ["a", "b", "c"]
    assert all("date=05-01-2024" in f for f in day.inputFiles())


def test_nothing_landed(spark, tmp_path):
    empty = landing.read_landing(spark, lake_files(tmp_path), "submissions", "09-09-2024")
    assert empty.count() == 0
    assert empty.columns == landing.read_landing(spark, lake_files(tmp_path), "submissions").columns


def test_writer_rotates_and_reads_back(spark, tmp_path, rows):
    data = [(str(i), "top", "a b:c", "05-01-2024", i) for i in range(25)]
    df = spark.createDataFrame(data, "id string, sort_type string, subreddit string, date string, score int")
    root = str(tmp_path / "out")
    landing.write_landing(df.coalesce(1), root, "submissions", max_lines=10)
    landing.write_landing(df.withColumn("id", F.concat(F.lit("c"), "id")), root, "comments")
    back = landing.read_landing(spark, root, "submissions")
    assert landing.read_landing(spark, root, "comments").filter("id LIKE 'c%'").count() == 25
    assert rows(back, "id", "source_sort_type", "subreddit", "partition_date", "score") == sorted(data)
    per_file = back.groupBy("source_file").count().collect()
    assert len(per_file) >= 3 and max(r["count"] for r in per_file) <= 10


def test_discovery_lists_folders_without_reading_lines(spark, tmp_path, rows):
    root = lake_files(tmp_path)
    found = landing.discover_landing(spark, root, "submissions")
    assert rows(found, "sort_type", "subreddit", "partition_date", "files") == [
        ("controversial", "tabs", "06-01-2024", 1), ("top", "phones", "05-01-2024", 2),
    ]
    assert "body" in landing.infer_landing_schema(spark, root, "comments").names
    assert "body" not in landing.infer_landing_schema(spark, root, "submissions").names
