import os
import subprocess
import sys

import pyarrow as pa
from pyspark.sql import functions as F

from recflow.llm import common

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {scratch!r}).getOrCreate())
from recflow.llm import queries
for name in ("op9_lm_score", "op8_substring_dedup", "op6_quality_rules", "op7_token_file",
             "op11_ngram_jaccard", "op12_spelling", "op13_conversation_repair"):
    assert queries.QUERIES[name](spark, {data!r}).count() > 0
print("done")
"""


def test_workers_need_no_copy_of_the_package(data, tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    script = SCRIPT.format(root=root, scratch=str(tmp_path), data=data)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert run.stdout.strip().endswith("done"), run.stderr[-2000:]


def test_batches_are_bounded_in_bytes(spark):
    texts = spark.range(0, 300, 1, 1).select(F.repeat(F.lit("0123456789"), 10_000).alias("text"))

    def sizes(batches):
        for batch in batches:
            for part in common.parts(iter([batch]), limit=1 << 20):
                row = [pa.array([x], pa.int64()) for x in (batch.nbytes, part.nbytes, part.num_rows)]
                yield pa.RecordBatch.from_arrays(row, names=["batch", "part", "n"])

    found = common.map_batches(texts, sizes, "batch long, part long, n long").collect()
    assert sum(r.n for r in found) == 300
    assert max(r.batch for r in found) < 3 * common.BATCH_BYTES and max(r.n for r in found) <= 11
