import subprocess
import sys
import zipfile

from llm.shipping import package_zip

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
from llm.secret_scan import secret_scan
docs = spark.createDataFrame([(1, "token = abcdef99")], "doc_id long, text string")
assert secret_scan(docs).first().n_assign == 1
print("found")
"""


def test_archive_holds_both_packages(tmp_path):
    names = zipfile.ZipFile(package_zip(str(tmp_path))).namelist()
    assert {"llm/byteops.py", "lakeops/sinks/staging.py"} <= set(names)
    assert all(n.endswith(".py") for n in names)


def test_workers_need_no_path_to_the_packages(tmp_path, pytestconfig):
    script = tmp_path / "elsewhere.py"
    script.write_text(SCRIPT.format(repo=str(pytestconfig.rootpath)))
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert "found" in done.stdout, done.stderr[-2000:]
