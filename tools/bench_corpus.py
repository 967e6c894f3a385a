"""Time the text build at a size of the reference's runs: a corpus of so many MB in so many files.

Usage: python tools/bench_corpus.py TABLE_DIR MB FILES [FILES ...]

Takes about MB of text from TABLE_DIR's documents (all of it if there is less), writes it with Spark
as FILES text files in a scratch folder (untimed) and builds its text index twice, first cold.
Prints one JSON line with seconds, MB a second and the bytes that the two builds shuffled,
read from the event log, which lies in the scratch folder too.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402


def main(argv: list[str]) -> int:
    table, mb, counts = argv[1], float(argv[2]), [int(x) for x in argv[3:]]
    scratch = tempfile.mkdtemp(prefix="termdex-bench-")
    conf = {"enabled": "true", "compress": "false", "rolling.enabled": "false", "dir": f"file://{scratch}"}
    os.environ["PYSPARK_SUBMIT_ARGS"] = " ".join(f"--conf spark.eventLog.{k}={v}" for k, v in conf.items()) + " pyspark-shell"
    from termdex.operators.index import postings
    from termdex.session import local_session
    from termdex.sources.files import from_table, read_lines, read_table
    from termdex.sources.index_io import write_text_index

    spark = local_session(os.environ.get("BENCH_CPUS", "8"), shuffle_partitions=int(os.environ.get("BENCH_PARTITIONS", "32")))
    docs = from_table(read_table(spark, table, "documents"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    share = min(1.0, mb * 1e6 / total)
    docs = docs.filter(F.pmod(F.xxhash64("doc"), F.lit(10_000)) < int(share * 10_000))
    out, marks = {}, []
    for n in counts:
        corpus = f"{scratch}/corpus-{n}"
        docs.select("text").repartition(n).write.text(corpus)
        size = sum(os.path.getsize(f) for f in glob.glob(f"{corpus}/part-*")) / 1e6
        for run in ("cold", "warm"):
            began = time.time()
            report = write_text_index(postings(read_lines(spark, corpus), "auto"), f"{scratch}/index-{n}-{run}", max_docs=n)
            took = time.time() - began
            marks.append((f"{n}_files_{run}", began * 1000, time.time() * 1000))
            out[f"{n}_files_{run}"] = {"mb": round(size, 1), "sec": round(took, 1), "mb_per_sec": round(size / took, 2), "terms": report.terms}
    spark.stop()
    (log,) = [f for f in glob.glob(f"{scratch}/*") if os.path.isfile(f)]
    moved = dict.fromkeys(out, 0)
    for line in open(log):
        e = json.loads(line)
        if e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            at = e["Task Info"]["Finish Time"]
            for name, a, b in marks:
                if a <= at <= b:
                    moved[name] += e["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"]
    for name, n in moved.items():
        out[name]["shuffle_mb"] = round(n / 1e6, 1)
    print(json.dumps(out))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
