"""Fixed schemas.

The crawl metadata is read with a fixed schema instead of inference:
no extra pass over the data, missing fields become null, a file with no
parsable line gives zero rows instead of an error.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The five link fields of crawl metadata, in output order.
LINK_FIELDS = ("path", "target", "text", "title", "url")

# Nesting of the link array inside one metadata record.
ENVELOPE = "Envelope"
PAYLOAD = "Payload-Metadata"
HTTP_RESPONSE = "HTTP-Response-Metadata"
HTML_META = "HTML-Metadata"
LINKS = "Links"

LINK_STRUCT = T.StructType([T.StructField(name, T.StringType(), True) for name in LINK_FIELDS])

WAT_SCHEMA = T.StructType([
    T.StructField(ENVELOPE, T.StructType([
        T.StructField(PAYLOAD, T.StructType([
            T.StructField(HTTP_RESPONSE, T.StructType([
                T.StructField(HTML_META, T.StructType([
                    T.StructField(LINKS, T.ArrayType(LINK_STRUCT, True), True),
                ]), True),
            ]), True),
        ]), True),
    ]), True),
])

LINK_SCHEMA = LINK_STRUCT

URL_SCHEMA = T.StructType([T.StructField("url", T.StringType(), True)])

LEDGER_SCHEMA = T.StructType([T.StructField("file_name", T.StringType(), True)])

# The ingest ledger also records which run took a file; the intents record
# what a run is about to take, before it writes anything.
RUN_LEDGER_SCHEMA = T.StructType([T.StructField("file_name", T.StringType(), True),
                                  T.StructField("run_id", T.StringType(), True)])
INTENT_SCHEMA = T.StructType([T.StructField("file_name", T.StringType(), True),
                              T.StructField("path", T.StringType(), True),
                              T.StructField("run_id", T.StringType(), True)])
# A run whose data is complete, and files a run could not read.
COMMIT_SCHEMA = T.StructType([T.StructField("run_id", T.StringType(), True)])
QUARANTINE_SCHEMA = T.StructType([*INTENT_SCHEMA, T.StructField("error", T.StringType(), True)])

# Bookkeeping partition columns a raw link table may carry besides the links.
RUN_COLUMN = "ingest_run"
SUFFIX_COLUMN = "url_suffix"
JOB_COLUMN, BATCH_COLUMN = "job", "batch"  # of tables that streams write
BOOKKEEPING_COLUMNS = (RUN_COLUMN, SUFFIX_COLUMN, JOB_COLUMN, BATCH_COLUMN)

WARC_LIST_SCHEMA = T.StructType([T.StructField("warc_filename", T.StringType(), True)])

# The columns of Spark's file listing source; only the path is ever read.
FILE_SCHEMA = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
                            T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])

LINES_SCHEMA = T.StructType([T.StructField("value", T.StringType(), True)])
