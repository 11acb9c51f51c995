"""linkloom: hyperlink mining from web-crawl metadata on Spark DataFrames.

The main entry points, re-exported::

    from linkloom import build_session, read_wat_links, select_links, jp_jpg_jpeg, \\
        dedup_stable, ingest_wat_files, download_plan, export_delimited, rules
"""

from .functions import rules
from .functions.names import file_name_of_path, file_name_of_url, warc_to_wat
from .operators.dedup import dedup_stable, dedup_urls, distinct_urls, new_urls_only
from .operators.fanin import tag_rules
from .operators.filters import jp_jpg_jpeg, jp_png, link_columns, select_any, select_links
from .operators.ledger import download_plan, mark_processed, pending_files, read_ledger
from .plans.ingest import ingest_wat_files
from .session import build_session
from .sinks.tables import append_table, export_delimited, overwrite_table
from .sources.files import read_table
from .sources.wat import read_wat_links
from .tables import LinkTable

__version__ = "0.1.0"

__all__ = [
    "LinkTable", "append_table", "build_session", "dedup_stable", "dedup_urls", "distinct_urls",
    "download_plan", "export_delimited", "file_name_of_path", "file_name_of_url",
    "ingest_wat_files", "jp_jpg_jpeg", "jp_png", "link_columns", "mark_processed",
    "new_urls_only", "overwrite_table", "pending_files", "read_ledger", "read_table",
    "read_wat_links", "rules", "select_any", "select_links", "tag_rules", "warc_to_wat",
]
