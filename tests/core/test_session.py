import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
from offerloom.session import Scratch, local_session, shared_dir
spark = local_session(1, 1, "1g")
assert spark.conf.get("spark.checkpoint.dir", None) is None
first = shared_dir(spark)
assert first == shared_dir(spark)
box = Scratch(spark, "try")
kept = box.keep(spark.range(3))
assert kept.count() == 3
box.drop(kept)
print("kept in", first)
"""


def test_a_session_without_any_configuration_gets_its_own_folder(tmp_path):
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": str(Path(__file__).resolve().parents[2])}
    done = subprocess.run([sys.executable, "-c", SCRIPT], env=env, capture_output=True, text=True, timeout=300)
    assert "kept in" in done.stdout, done.stderr[-2000:]
