import os
from urllib.parse import urlparse

from pyspark.sql import functions as F

from ratewise import scratch_path
from ratewise.sources import (
    check_ratings_file,
    parse_stream_lines,
    rating_rejects,
    read_items_file,
    read_ratings_file,
    stream_rejects,
    to_tsv,
    typed_ratings,
)


def _write_text(spark, lines):
    # Test fixture written by hand; the checkpoint root is a file: URI locally.
    path = scratch_path(spark, "txt")
    local = urlparse(path).path
    os.makedirs(local)
    with open(os.path.join(local, "part-0.csv"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return path


def test_item_file_quotes_and_header(spark):
    path = _write_text(spark, ["movieId,title,price", '1,"Heat, the film",9.5', "2,Up", "3,Ran,7"])
    rows = sorted(read_items_file(spark, path, header=True).collect())
    assert [tuple(r) for r in rows] == [
        ("1", "Heat, the film", "9.5"),
        ("2", "Up", None),
        ("3", "Ran", "7"),
    ]


def test_rating_file_bad_lines_counted_not_fatal(spark):
    path = _write_text(
        spark, ["1,10,4.0,2001-01-01", "x,10,4.0,2001-01-02", "2,11,3.5,2001-01-03", "3,12"]
    )
    counts = check_ratings_file(spark, path).first()
    assert (counts.n_lines, counts.n_good, counts.n_bad) == (4, 2, 2)
    raw = read_ratings_file(spark, path)
    typed = sorted(tuple(r) for r in typed_ratings(raw).collect())
    assert typed == [(1, 10, 4.0, "2001-01-01"), (2, 11, 3.5, "2001-01-03")]
    assert rating_rejects(raw).count() == 2


def test_stream_lines_many_records_and_rejects(spark):
    lines = spark.createDataFrame(
        [("1\t5\t4.0 2\t6\t3.0",), ("",), ("3\t7\t5.0\textra",), ("4\tx\t1.0 5\t8",), ("6\t9\t2.5  7\t1\t1.0",)],
        "value string",
    )
    good = sorted(tuple(r) for r in parse_stream_lines(lines).collect())
    assert good == [(1, 5, 4.0), (2, 6, 3.0), (3, 7, 5.0), (6, 9, 2.5), (7, 1, 1.0)]
    bad = sorted(r.record for r in stream_rejects(lines).collect())
    assert bad == ["4\tx\t1.0", "5\t8"]


def test_to_tsv_round_trip(spark):
    df = spark.createDataFrame([(1, 2, 3.0), (4, 5, 1.5)], "user_id int, item_id int, rating double")
    lines = to_tsv(df).withColumnRenamed("line", "value")
    back = sorted(tuple(r) for r in parse_stream_lines(lines).collect())
    assert back == [(1, 2, 3.0), (4, 5, 1.5)]
    assert sorted(r.line for r in to_tsv(df).collect()) == ["1\t2\t3.0", "4\t5\t1.5"]


def test_train_and_test_files_share_one_loader(spark):
    from ratewise.sources import load_train_test

    tr = _write_text(spark, ["1,10,4.0,t1", "2,11,3.0,t2", "bad,1,1,t"])
    te = _write_text(spark, ["3,12,5.0,t3"])
    train, test = load_train_test(spark, tr, te)
    assert sorted(tuple(r) for r in train.collect()) == [(1, 10, 4.0), (2, 11, 3.0)]
    assert [tuple(r) for r in test.collect()] == [(3, 12, 5.0)]
