"""Readers and writers: delimited text with quarantine, generic tables,
rating messages, and the sinks (overwrite, keyed documents, upsert log)."""

from recspark.sources.text import (  # noqa: F401
    parse_delimited, read_movies_text, read_ratings_csv, read_tags_csv,
    read_tab_ratings, read_item_titles, parse_rating_messages, read_table,
    recent_list_key, encode_recent_item, encode_recent_lists, parse_recent_lists,
)
from recspark.sources.sinks import (  # noqa: F401
    write_table, write_clustered, read_clustered, rows_of_keys, BUCKET_COL, write_keyed_docs,
    upsert_log_write, upsert_log_read, upsert_log_compact,
)
