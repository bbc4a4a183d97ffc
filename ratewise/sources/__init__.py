from ratewise.sources.tables import (
    items_table,
    load_table,
    ratings_b,
    ratings_s,
    users_table,
)
from ratewise.sources.text import (
    check_ratings_file,
    item_rejects,
    load_train_test,
    parse_stream_lines,
    rating_rejects,
    read_items_file,
    read_ratings_file,
    stream_rejects,
    to_tsv,
    train_test_rejects,
    typed_ratings,
    write_csv,
)

__all__ = [
    "check_ratings_file",
    "item_rejects",
    "items_table",
    "load_train_test",
    "load_table",
    "parse_stream_lines",
    "rating_rejects",
    "ratings_b",
    "ratings_s",
    "read_items_file",
    "read_ratings_file",
    "stream_rejects",
    "to_tsv",
    "train_test_rejects",
    "typed_ratings",
    "users_table",
    "write_csv",
]
