"""Python workers run the package's functions without having the package."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

JOB = """
import sys
sys.path.insert(0, {root!r})
from seqloom import build_session
spark = build_session("elsewhere", "local[2]", spark__sql__shuffle__partitions="2", spark__ui__enabled="false")
sys.path.remove({root!r})  # workers get a copy of this path
from seqloom.operators import recommend
items = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(1, 9)], "item long, vec array<double>")
users = spark.createDataFrame([(1, [1.0, 0.0])], "user_id long, vec array<double>")
pairs = spark.createDataFrame([(1, 8)], "user_id long, item long")
best = recommend.top_k_items(users, items, pairs, 2, size=2, n_items=8, n_users=1).orderBy("rank").collect()
scored = recommend.score_candidates(pairs, users, items).collect()
print("RESULT", [r.item for r in best], [r.score for r in scored])
"""


def test_worker_functions_travel(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYSPARK_PYTHON": sys.executable}
    job = tmp_path / "job.py"
    job.write_text(JOB.format(root=ROOT))
    done = subprocess.run(
        [sys.executable, str(job)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300, check=False
    )
    assert "RESULT [7, 6] [8.0]" in done.stdout, done.stderr[-2000:]
