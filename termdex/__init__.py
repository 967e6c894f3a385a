"""termdex: a term index on Spark DataFrames.

documents(doc, text) -> postings(term, doc, tf) -> text lines or Parquet, and
all-words search over postings. Built from Spark SQL expressions only.
"""

from termdex.functions.text import clean, doc_name, lower_query, query_terms, raw_terms, split_words, term_array
from termdex.operators.index import grouped, heavy_terms, keyed, merge_postings, partition_count, postings, spread, stats, tokens, with_block
from termdex.operators.lines import format_lines, parse_lines
from termdex.operators.search import (
    batch_terms,
    parse_query,
    resident_index,
    search_all,
    search_all_intersect,
    search_batch,
    search_stored,
)
from termdex.sources.files import from_table, read_lines, read_table, read_whole
from termdex.sources.index_io import BuildReport, inspect_parts, manifest_files, read_index, read_text_index, write_index, write_manifest, write_text_index
from termdex.streaming.ingest import compact, index_stream, read_merged, stream_table, stream_text_files
from termdex.streaming.levels import append, append_stream, compact_levels, read_live

__all__ = [
    "BuildReport", "append", "append_stream", "compact_levels", "heavy_terms", "inspect_parts", "manifest_files", "read_live", "write_manifest",
    "batch_terms", "clean", "compact", "doc_name", "format_lines", "from_table", "grouped", "index_stream", "keyed",
    "lower_query", "merge_postings", "parse_lines", "partition_count", "parse_query", "postings", "query_terms", "raw_terms",
    "read_index", "read_lines", "read_merged", "read_table", "read_text_index", "read_whole",
    "resident_index", "search_all", "search_all_intersect", "search_batch", "search_stored", "split_words",
    "spread", "stats", "stream_table", "stream_text_files", "term_array", "tokens", "with_block",
    "write_index", "write_text_index",
]
