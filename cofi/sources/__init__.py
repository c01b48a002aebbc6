from cofi.sources.ratings import (
    RATINGS_SCHEMA,
    append_user,
    clean_ratings,
    dedupe,
    expect_rows,
    load_ratings,
    judge_rating_lines,
    load_ratings_text,
    load_with_rejects,
    only,
    parse_rating_lines,
    split_train_test,
)
from cofi.sources.personal import load_personal_csv, personal_ratings, titles
from cofi.sources.fixtures import (
    damaged_lines_from,
    events_ratings,
    orders_ratings,
    personal_from_parts,
    rated_pairs,
    rating_lines_from,
    read_table,
)
from cofi.sources.sinks import answers_table, nested_answers, write_answers

__all__ = [
    "RATINGS_SCHEMA", "judge_rating_lines", "load_with_rejects", "damaged_lines_from", "load_ratings", "load_ratings_text", "parse_rating_lines", "dedupe",
    "split_train_test", "append_user", "clean_ratings", "only", "expect_rows", "load_personal_csv", "personal_ratings",
    "titles", "orders_ratings", "events_ratings", "personal_from_parts", "rated_pairs", "rating_lines_from",
    "read_table", "answers_table", "nested_answers", "write_answers",
]
