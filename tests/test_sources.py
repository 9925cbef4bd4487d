import os

from pyspark.sql import functions as F

from tonality.session import scratch_path
from tonality.sources.review_files import drop_header, read_review_csv, unquote
from tonality.sources.reviews import project_reviews, read_reviews_json
from tonality.sources.scores import (parse_score_lines, read_score_lines, read_scores,
                                     write_score_lines, write_scores)


def test_score_lines_both_python_forms_and_garbage(spark):
    lines = spark.createDataFrame([("('abc', 0.5)",), ("(u'abc', 0.5)",), ("('abc', -1.2e-05)",),
                                   ("garbage",)], "value string")
    got = [tuple(r) for r in parse_score_lines(lines).collect()]
    assert got == [("abc", 0.5), ("abc", 0.5), ("abc", -1.2e-05), (None, None)]


def test_score_text_and_parquet_roundtrip(spark):
    scores = spark.createDataFrame([("a", 0.25), ("b", -1.5e-07)], "review_id string, vader double")
    p1, p2 = scratch_path(spark, "t-lines"), scratch_path(spark, "t-parquet")
    write_score_lines(scores, p1)
    write_scores(scores, p2)
    assert sorted(map(tuple, read_score_lines(spark, p1).collect())) == [("a", 0.25), ("b", -1.5e-07)]
    assert sorted(map(tuple, read_scores(spark, p2).collect())) == [("a", 0.25), ("b", -1.5e-07)]


def test_json_scan_explicit_schema(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "r.json")
    with open(path, "w") as f:
        f.write('{"review_id": "r1", "stars": 5, "text": "good", "extra": 1}\n')
        f.write('{"review_id": "r2", "text": null}\n')
        f.write('not json\n')
    df = read_reviews_json(spark, path, corrupt_column="_bad")
    rows = df.collect()
    assert [f.name for f in df.schema.fields][:9] == ["business_id", "cool", "date", "funny",
                                                      "review_id", "stars", "text", "useful", "user_id"]
    assert rows[0].stars == 5.0 and rows[1].text is None and rows[2]._bad == "not json"
    assert project_reviews(df).columns == ["review_id", "text", "stars"]


def test_csv_reader_quoting_and_unquote(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "demo.csv")
    with open(path, "w", newline="") as f:
        f.write('review\r\nplain text, no quotes\r\n"quoted, with ""inner"" quotes"\r\n'
                '"two\r\nlines"\r\n')
    got = [r.review for r in read_review_csv(spark, path).collect()]
    # whole records; a quoted line break comes back as "\\n"
    assert got == ["plain text, no quotes", 'quoted, with "inner" quotes', "two\nlines"]
    lines = spark.createDataFrame([('"a ""b"""',), ("plain",), ('"',), (None,)], "v string")
    assert [r.u for r in lines.select(unquote(F.col("v")).alias("u")).collect()] == \
        ['a "b"', "plain", '"', None]


def test_drop_header_removes_all_copies(spark):
    lines = spark.createDataFrame([("review",), ("x",), ("review",), (None,)], "value string")
    assert [r.value for r in drop_header(lines, "review").collect()] == ["x", None]
