"""Print the physical plans of the headline operators (after execution, so the
adaptive plans are final).  Long expression lists are shortened.

    python tools/explain_plans.py [SF_DIR] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from logweave.functions.parse import parse_lines, valid_rows  # noqa: E402
from logweave.operators.batching import batch_stats  # noqa: E402
from logweave.operators.compare import compare_all_pairs  # noqa: E402
from logweave.operators.queries import DATAFRAME_QUERIES, TWO_STAGE_QUERIES  # noqa: E402
from logweave.plans.job import parse_for_staging, run_all  # noqa: E402
from logweave.schemas import LOG_COLUMNS  # noqa: E402
from logweave.session import local_session, scratch_dir  # noqa: E402
from logweave.sinks.store import ResultStore, stage_parquet  # noqa: E402
from logweave.sources.fixtures import fixture_log_dir  # noqa: E402
from logweave.sources.text import read_log_lines  # noqa: E402


def _shorten(plan: str) -> str:
    # literal whitespace characters inside expressions (e.g. Contains(x, '\n'))
    for ch, esc in (("\n", "\\n"), ("\r", "\\r"), ("\x0b", "\\x0b"), ("\f", "\\f")):
        plan = plan.replace(f", {ch})", f", {esc})")
    out = []
    for line in plan.splitlines():
        line = re.sub(r"Location: [^,]*,", "Location: ...,", line)
        if len(line) > 200:
            line = line[:197] + "..."
        out.append(line)
    return "\n".join(out)


def show(title: str, df, note: str = "", run: bool = True) -> None:
    if run:
        df.collect()            # aggregated results are small; the plan is then final
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("+- == Initial Plan ==")[0]
    print(f"## {title}\n")
    if note:
        print(note + "\n")
    print("```\n" + _shorten(final) + "\n```\n")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    logs_dir = fixture_log_dir(spark, sf_dir)
    lines = read_log_lines(spark, [logs_dir])
    print(f"# Physical plans ({os.path.basename(sf_dir)}, local[8], AQE on)\n")
    print("Generated by `tools/explain_plans.py`.\n")
    show("Parse + stage (one pass over the text)", parse_for_staging(lines),
         "One whole-stage-codegen stage from the text scan to the Generate barrier "
         "(no exchange, so this is also the plan that runs).", run=False)
    staged_path = stage_parquet(parse_for_staging(lines), scratch_dir(spark, "plans"))
    staged = spark.read.parquet(staged_path)
    valid = staged.filter(~F.col("is_malformed")).select(*LOG_COLUMNS)
    for q, fn in DATAFRAME_QUERIES.items():
        show(f"{q} over the staged table", fn(valid),
             "Pushed filter on is_malformed, only the needed columns read, partial aggregation.")
    show("q2 two_stage", TWO_STAGE_QUERIES["q2"](valid))
    show("q1 straight from text (filter stops at the Generate)",
         DATAFRAME_QUERIES["q1"](valid_rows(parse_lines(lines))))
    show("FIXED batches (global line index, broadcast of the split table)",
         batch_stats(staged, "fixed", 500))
    show("MONTHLY batches (hash aggregate per key and split, then per key)",
         batch_stats(parse_for_staging(lines), "monthly"))
    store = ResultStore(spark, scratch_dir(spark, "plans-store"))
    runs = run_all(spark, [logs_dir], store, strategy="monthly", queries="1,2")
    show("All-pairs comparison (pivot on run id)",
         compare_all_pairs(store, [r.run_id for r in runs], ["q1", "q2"]))
    spark.stop()


if __name__ == "__main__":
    main()
