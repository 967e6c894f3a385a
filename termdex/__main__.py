"""Command line: the reference's jobs as ``python -m termdex`` (or ``spark-submit``).

    build  IN [IN ...] OUT [--parts N] [--format text|parquet] [--sep tab|spaces] [--whole]
           [--layout hash|round|range|exact] [--input-parts N]
    search INDEX QUERY [--format parquet|text] [--clean] [--out OUT]
    batch  INDEX QUERIES OUT [--format parquet|text] [--clean]
    stats  INDEX [--format parquet|text]
    parts  INDEX

``build`` of a text index prints what it wrote. ``parts`` prints file, lines, bytes, first and last
term and order of every part of a text index, and writes its manifest if it has none.
``batch`` reads a text file with one query per line, gives each a unique id and writes
``OUT/queries`` (query_id, query) and ``OUT/answers`` (query_id, doc) as Parquet.
``search`` writes the answer to ``OUT`` as text, or streams it to stdout partition by partition
instead of collecting it at once. A session that already exists (a notebook, a test) is used and left open.
"""

from __future__ import annotations

import argparse
import os
import sys

if not __package__:  # run as a file (spark-submit termdex/__main__.py): make the package importable
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from termdex.functions.text import SPACES_SEP, TAB_SEP  # noqa: E402
from termdex.operators.index import postings, stats  # noqa: E402
from termdex.operators.search import search_batch, search_stored  # noqa: E402
from termdex.session import checkpoint_base, clear_work  # noqa: E402
from termdex.sources.files import read_lines, read_whole  # noqa: E402
from termdex.sources.index_io import LAYOUTS, inspect_parts, manifest_files, read_index, read_text_index, write_index, write_manifest, write_text_index  # noqa: E402


def _index(spark: SparkSession, path: str, fmt: str):
    return read_index(spark, path) if fmt == "parquet" else read_text_index(spark, path)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="termdex")
    sub = p.add_subparsers(dest="cmd", required=True)

    b = sub.add_parser("build", help="index text files")
    b.add_argument("paths", nargs="+", help="input folders or files, then the output folder")
    b.add_argument("--parts", type=int, default=None, help="number of output parts; -1 or none: Spark's own")
    b.add_argument("--format", choices=("text", "parquet"), default="text")
    b.add_argument("--sep", choices=("tab", "spaces"), default="tab")
    b.add_argument("--layout", choices=LAYOUTS, default="hash", help="of the text parts")
    b.add_argument("--input-parts", type=int, default=None, help="spread the input over this many tasks")
    b.add_argument("--whole", action="store_true", help="read each file as one row")

    s = sub.add_parser("search", help="documents holding every word of a query")
    s.add_argument("index")
    s.add_argument("query")
    s.add_argument("--format", choices=("parquet", "text"), default="parquet")
    s.add_argument("--clean", action="store_true", help="tokenise the query like document text")
    s.add_argument("--out", default=None, help="write the answer as text, one document a line")

    q = sub.add_parser("batch", help="answer a file of queries, one per line")
    q.add_argument("index")
    q.add_argument("queries")
    q.add_argument("out")
    q.add_argument("--format", choices=("parquet", "text"), default="parquet")
    q.add_argument("--clean", action="store_true")

    t = sub.add_parser("stats", help="distinct terms and total occurrences")
    t.add_argument("index")
    t.add_argument("--format", choices=("parquet", "text"), default="parquet")

    r = sub.add_parser("parts", help="lines and order of a text index's parts")
    r.add_argument("index")

    a = p.parse_args(argv)
    owned = SparkSession.getActiveSession() is None
    spark = SparkSession.builder.appName(f"termdex-{a.cmd}").getOrCreate()
    try:
        if a.cmd == "build":
            if len(a.paths) < 2:
                p.error("build needs at least one input and one output")
            inputs, out = a.paths[:-1], a.paths[-1]
            parts = a.parts if a.parts and a.parts > 0 else None
            docs = (read_whole if a.whole else read_lines)(spark, inputs)
            post = postings(docs, a.input_parts or "auto")
            if a.format == "parquet":
                write_index(post, out, parts)
            else:
                # documents are named by their files
                bound = len(docs.inputFiles())
                report = write_text_index(post, out, parts, TAB_SEP if a.sep == "tab" else SPACES_SEP, a.layout, max_docs=bound)
                print(" ".join(f"{k}={v}" for k, v in report._asdict().items()))
        elif a.cmd == "search":
            res = search_stored(spark, a.index, a.query, a.format, a.clean)
            if a.out:
                res.select(F.col("doc").cast("string")).write.text(a.out)
            else:
                for row in res.toLocalIterator():
                    print(row["doc"])
        elif a.cmd == "batch":
            lines = spark.read.text(a.queries).select(
                F.monotonically_increasing_id().alias("query_id"), F.col("value").alias("query")
            )
            # fix the ids once: they must not change if a partition is recomputed
            checkpoint_base(spark)
            lines = lines.checkpoint(eager=True)
            lines.write.parquet(f"{a.out}/queries")
            search_batch(_index(spark, a.index, a.format), lines, a.clean).write.parquet(f"{a.out}/answers")
        elif a.cmd == "parts":
            if manifest_files(spark, a.index, []) is None:
                write_manifest(spark, a.index)
            for row in inspect_parts(spark, a.index).orderBy("file").toLocalIterator():
                print(*row, sep="\t")
        else:
            r = stats(_index(spark, a.index, a.format)).first()
            print(f"num_terms={r['num_terms']} tot_terms={r['tot_terms']}")
    finally:
        if owned:
            # all answers are written or printed: nothing reads the work tables any more
            clear_work(spark)
            spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
