"""Command line: the read-side queries over an edit table.

    python -m editsurge report   --edits PATH | --sf-dir DIR [--as-of TS] [--out PATH]
    python -m editsurge trends   ... [--period Last24Hours] [--limit 20] [--min-score 0]
    python -m editsurge clusters ... [--period Last24Hours]
    python -m editsurge topic    ... --topic-id N [--period Last24Hours]
    python -m editsurge baselines ... [--days 30]

``--edits`` reads a stored edit table (Parquet, as written by
write_edit_events); ``--sf-dir`` derives edits from the driver tables.
Results go to ``--out`` as Parquet, or the first ``--show`` rows are
printed.  On a cluster leave ``--master`` unset so spark-submit decides.
"""

from __future__ import annotations

import argparse

from editsurge.operators import serving as sv
from editsurge.operators import trends as tr
from editsurge.session import get_spark
from editsurge.sources.adapters import load_edits, max_ts


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="editsurge")
    p.add_argument("command", choices=["report", "trends", "clusters", "topic", "baselines"])
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--edits", help="stored edit table (Parquet)")
    src.add_argument("--sf-dir", help="driver tables folder (edits derived from events)")
    p.add_argument("--as-of", help="window end 'YYYY-MM-DD HH:MM:SS' (default: newest edit)")
    p.add_argument("--period", default="Last24Hours")
    p.add_argument("--limit", type=int, default=sv.API_LIMIT)
    p.add_argument("--min-score", type=float, default=0.0)
    p.add_argument("--topic-id", type=int)
    p.add_argument("--days", type=int, default=tr.BASELINE_LOOKBACK_DAYS)
    p.add_argument("--baselines", help="stored baseline table (Parquet); default: computed")
    p.add_argument("--labels", help="topic label state (Parquet); default: scan the history")
    p.add_argument("--out", help="write the result here as Parquet")
    p.add_argument("--show", type=int, default=50)
    p.add_argument("--master")
    a = p.parse_args(argv)

    from pyspark.sql import SparkSession
    owned = SparkSession.getActiveSession() is None
    spark = get_spark(a.master, app=f"editsurge-{a.command}")
    if a.edits:
        edits = spark.read.parquet(a.edits)
        as_of = a.as_of or max_ts(edits)
    else:
        edits, derived = load_edits(spark, a.sf_dir)
        as_of = a.as_of or derived
    base = spark.read.parquet(a.baselines) if a.baselines else None
    labels = spark.read.parquet(a.labels) if a.labels else None
    if a.command == "report":
        df = tr.trends_report(edits, as_of, base, lookback_days=a.days, label_state=labels)
    elif a.command == "trends":
        df = sv.trends_response(edits, as_of, a.period, a.limit, a.min_score, base, a.days, label_state=labels)
    elif a.command == "clusters":
        df = sv.clusters(edits, as_of, a.period, label_state=labels)
    elif a.command == "topic":
        if not a.topic_id:
            p.error("--topic-id is required for 'topic'")
        df = sv.topic_detail(edits, as_of, a.topic_id, a.period, base, a.days, label_state=labels)
    else:
        df = tr.recalculate_baselines(edits, as_of, a.days)
    if a.out:
        df.write.mode("overwrite").parquet(a.out)
    else:
        keys = [c for c in ("period", "cluster_rank", "topic_rank", "score_rank", "topic_id", "article_rank")
                if c in df.columns]
        df.orderBy(*keys).show(a.show, truncate=False)   # display order only
    if owned:
        spark.stop()


if __name__ == "__main__":
    main()
