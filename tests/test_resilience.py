"""Jobs survive lost tasks: a separate application whose first task attempt
fails still produces the same results (task retry from lineage; the plans
hold no per-attempt state)."""

from __future__ import annotations

import subprocess
import sys
import textwrap

from core_helpers import ROOT, SF_SMALL

SCRIPT = textwrap.dedent(
    f"""
    import sys, tempfile, uuid
    sys.path.insert(0, {str(ROOT)!r})
    from pyspark import TaskContext
    from pyspark.sql import SparkSession
    from tierline.operators.gold import validation_report, window_totals
    from tierline.operators.silver import silver_monolith
    from tierline.operators.sinks import ensure_database, overwrite_table
    from tierline.sources.derived import participation

    spark = (SparkSession.builder.master("local[4,4]")  # up to 4 attempts per task
             .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    def flaky(batches):
        ctx = TaskContext.get()
        if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
            raise RuntimeError("lost on first attempt")
        yield from batches

    clean = participation(spark, {SF_SMALL!r}).repartition(4)
    lossy = clean.mapInPandas(flaky, clean.schema)

    def same(a, b):
        return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()

    assert same(validation_report(silver_monolith(lossy), ordered=False),
                validation_report(silver_monolith(clean), ordered=False))
    assert same(window_totals(silver_monolith(lossy)), window_totals(silver_monolith(clean)))
    db = "tl_res_" + uuid.uuid4().hex[:8]
    ensure_database(spark, db, tempfile.mkdtemp(prefix="tierline-res-"))
    overwrite_table(silver_monolith(lossy), db + ".tab_monolith_silver")
    assert same(spark.table(db + ".tab_monolith_silver"), silver_monolith(clean))
    print("RESILIENT")
    """
)


def test_flows_survive_a_lost_task():
    out = subprocess.run([sys.executable, "-c", SCRIPT], capture_output=True, text=True, timeout=600)
    assert "RESILIENT" in out.stdout, out.stdout[-2000:] + out.stderr[-4000:]
