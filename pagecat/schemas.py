"""The stored payload (Spark DDL), allowed states and the columns that are merged."""

PAYLOAD = (
    "ARRAY<STRUCT<label: STRING, file_size: STRING, file_url_1: STRING, "
    "file_url_2: STRING, view_url_1: STRING, view_url_2: STRING>>"
)
# The allowed states.
RUN_STATUS = ("completed", "inprogress", "failed")
REQUEST_STATUS = ("processing", "done", "failed")

# The columns a publish fills from staging unless staging is NULL.
CATALOG_MERGED = (
    "name", "year", "duration", "synopsis", "director", "cast_members", "genres",
    "type", "language", "rating", "poster_ref", "last_updated",
)
VARIANT_FIELDS = ("file_size", "file_url_1", "file_url_2", "view_url_1", "view_url_2")
