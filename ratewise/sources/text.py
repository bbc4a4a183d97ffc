"""Text sources and sinks: item and rating files, TAB stream records.

File layout (by position, no header unless asked):
  items    movie_id,name[,price]
  ratings  user,movie,rating,time
  stream   user<TAB>item<TAB>rating, several records per line split by one space

Unlike a plain split on ``,`` these readers honour quotes and can skip a
header; lines that do not parse go to a rejects frame instead of failing
the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewise.schemas import CORRUPT_COL, ITEM_FILE, RATING_FILE

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def write_csv(df: DataFrame, path: str, header: bool = False) -> str:
    """Write rows as comma-separated text (quotes only where needed)."""
    (
        df.write.mode("error")
        .option("header", str(header).lower())
        .option("timestampNTZFormat", TS_FORMAT)
        .option("timestampFormat", TS_FORMAT)
        .csv(path)
    )
    return path


def _read_csv(spark: SparkSession, path: str, schema, header: bool) -> DataFrame:
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COL, T.StringType())])
    return (
        spark.read.schema(with_corrupt)
        .option("header", str(header).lower())
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COL)
        .csv(path)
    )


def read_items_file(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """Item file scan: (movie_id, name, price) as strings.

    Only id and name are required; a line without a price is kept with a
    null price, and fields past the third are ignored. Lines without an id or a
    name are in ``item_rejects``.
    """
    df = _read_csv(spark, path, ITEM_FILE, header)
    return df.where(_item_line_ok()).select("movie_id", "name", "price")


def _item_line_ok() -> Column:
    return F.col("movie_id").isNotNull() & F.col("name").isNotNull()


def item_rejects(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """Lines of an item file without id or name: their fields, and the line
    itself where its number of fields is not three."""
    df = _read_csv(spark, path, ITEM_FILE, header)
    return df.where(~_item_line_ok()).select("movie_id", "name", "price", F.col(CORRUPT_COL).alias("line"))


def read_ratings_file(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """Rating file scan: (user, movie, rating, time) as strings, all lines."""
    return _read_csv(spark, path, RATING_FILE, header)


def _rating_line_ok() -> Column:
    """The one rule for rating lines: user, movie and rating parse; a line may
    have no time, or further fields."""
    return (
        F.col("user").try_cast("int").isNotNull()
        & F.col("movie").try_cast("int").isNotNull()
        & F.col("rating").try_cast("double").isNotNull()
    )


def check_ratings_file(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """Parse dry run: split every line, keep nothing, count good and bad lines.

    A line is good if the loaders take it.
    """
    raw = read_ratings_file(spark, path, header)
    ok = _rating_line_ok()
    return raw.agg(
        F.count(F.lit(1)).cast("long").alias("n_lines"),
        F.count(F.when(ok, 1)).cast("long").alias("n_good"),
        F.count(F.when(~ok, 1)).cast("long").alias("n_bad"),
    )


def typed_ratings(raw: DataFrame) -> DataFrame:
    """Cast the string layer to (user_id int, item_id int, rating double, time)."""
    return raw.where(_rating_line_ok()).select(
        F.col("user").cast("int").alias("user_id"),
        F.col("movie").cast("int").alias("item_id"),
        F.col("rating").cast("double").alias("rating"),
        F.col("time"),
    )


def load_train_test(
    spark: SparkSession, train_path: str, test_path: str, header: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Train and test rating files through the same loader:
    (user_id, item_id, rating) each.

    Only the first three fields count: a line may have no time, or further
    fields. Lines without a valid user, item or rating give no row and are in
    ``train_test_rejects``.
    """

    def load(path: str) -> DataFrame:
        return typed_ratings(read_ratings_file(spark, path, header)).select("user_id", "item_id", "rating")

    return load(train_path), load(test_path)


def train_test_rejects(
    spark: SparkSession, train_path: str, test_path: str, header: bool = False
) -> DataFrame:
    """(split, user, movie, rating, time) of the lines that ``load_train_test`` does not take."""
    frames = [
        rating_rejects(read_ratings_file(spark, path, header)).select(
            F.lit(split).alias("split"), "user", "movie", "rating", "time")
        for split, path in (("train", train_path), ("test", test_path))
    ]
    return frames[0].unionByName(frames[1])


def rating_rejects(raw: DataFrame) -> DataFrame:
    """Lines of a rating file that do not give a typed rating."""
    return raw.where(~_rating_line_ok())


def tsv_record() -> Column:
    """user_id, item_id, rating as one TAB-separated record."""
    return F.concat_ws(
        "\t",
        F.col("user_id").cast("string"),
        F.col("item_id").cast("string"),
        F.col("rating").cast("string"),
    )


def to_tsv(ratings: DataFrame) -> DataFrame:
    """Delimiter change: user, item, rating as one TAB record per row."""
    return ratings.select(tsv_record().alias("line"))


def _split_records(lines: DataFrame, col: str, keep=()) -> DataFrame:
    pieces = lines.select(*keep, F.explode(F.split(F.col(col), " ")).alias("record"))
    pieces = pieces.where(F.length("record") > 0)
    fields = F.split("record", "\t")
    return pieces.select(
        *keep,
        "record",
        F.try_element_at(fields, F.lit(1)).try_cast("int").alias("user_id"),
        F.try_element_at(fields, F.lit(2)).try_cast("int").alias("item_id"),
        F.try_element_at(fields, F.lit(3)).try_cast("double").alias("rating"),
    )


def _record_ok() -> Column:
    return (
        F.col("user_id").isNotNull()
        & F.col("item_id").isNotNull()
        & F.col("rating").isNotNull()
    )


def parse_stream_lines(lines: DataFrame, col: str = "value", keep=()) -> DataFrame:
    """Multi-record lines to typed ratings (user_id, item_id, rating, *keep).

    A line holds records split by one space; a record holds TAB fields.
    Empty pieces are skipped; bad records are left out (see
    ``stream_rejects``). ``keep`` names line columns carried to each record.
    """
    recs = _split_records(lines, col, list(keep))
    return recs.where(_record_ok()).select("user_id", "item_id", "rating", *keep)


def stream_rejects(lines: DataFrame, col: str = "value") -> DataFrame:
    """Records of stream lines that do not parse as (int, int, double)."""
    return _split_records(lines, col).where(~_record_ok()).select("record")
