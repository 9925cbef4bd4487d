import os

from tonality.sources.review_files import drop_first_lines, first_lines


def write(folder, name, data):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(data)


def test_first_line_of_every_file(spark, tmpdir_fresh):
    write(tmpdir_fresh, "a.txt", "review\none\nreview\n\ntwo\n")
    write(tmpdir_fresh, "b.txt", "text,stars\nthree\n")
    write(tmpdir_fresh, "c.txt", "only\n")
    write(tmpdir_fresh, "d.txt", "")
    write(tmpdir_fresh, "e.txt", "\nafter a blank header")
    heads = {os.path.basename(r.file_path): r.header for r in first_lines(spark, tmpdir_fresh).collect()}
    assert heads == {"a.txt": "review", "b.txt": "text,stars", "c.txt": "only", "e.txt": ""}
    rest = sorted((os.path.basename(r.file_path), r.value) for r in drop_first_lines(spark, tmpdir_fresh).collect())
    assert rest == [("a.txt", ""), ("a.txt", "one"), ("a.txt", "review"), ("a.txt", "two"), ("b.txt", "three"),
                    ("e.txt", "after a blank header")]


def test_files_of_many_blocks(spark, tmpdir_fresh):
    for name in "xyz":
        write(tmpdir_fresh, name, "".join(f"{name}{i % 50}\n" for i in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        df = drop_first_lines(spark, tmpdir_fresh)
        assert df.rdd.getNumPartitions() > 3
        got = [r.value for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(got) == sorted(f"{n}{i % 50}" for n in "xyz" for i in range(1, 5000))
