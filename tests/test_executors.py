"""Readers on executors that don't have the package: a cluster of one, started
from another folder, with nothing on its Python path."""

import importlib.util
import os
import pathlib
import subprocess
import sys

CHILD = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession

conf = {{"spark.executor.memory": "768m", "spark.driver.host": "127.0.0.1", "spark.ui.enabled": "false",
        "spark.checkpoint.dir": "file://{folder}/shared", "spark.sql.shuffle.partitions": "2"}}
spark = SparkSession.builder.master({master!r}).config(map=conf).getOrCreate()
from quillmart.sources.files import read_source

for name, text in (("a.csv", 'k,v\\n1,"x\\ny"\\n'), ("a.json", '{{"k": {{"0": 1}}, "v": {{"0": "x"}}}}'),
                   ("a.html", "<html><table><tr><th>k<th>v<tr><td>1<td>x</table></html>")):
    with open(f"{folder}/{{name}}", "w") as f:
        f.write(text)
    print("ROWS", name, [tuple(r) for r in read_source(spark, f"{folder}/{{name}}").select("k", "v").collect()])
spark.stop()
"""


ANEW = CHILD.replace("    print(", """    for m in [m for m in sys.modules if m.split(".")[0] == "quillmart"]:
        del sys.modules[m]
    from quillmart.sources.files import read_source
    print(""")


def _read(folder: pathlib.Path, master: str, code: str = CHILD) -> list[str]:
    for p in pathlib.Path(importlib.util.find_spec("pyspark").origin).parent.iterdir():
        if p.name != "work":  # where a cluster's executors have their folders
            (folder / "home").mkdir(exist_ok=True)
            (folder / "home" / p.name).symlink_to(p)
    child = code.format(repo=str(pathlib.Path(__file__).parents[1]), folder=folder, master=master)
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_HOME")}
    env |= {"SPARK_HOME": str(folder / "home"), "SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_IP": "127.0.0.1", "PYSPARK_PYTHON": sys.executable}
    run = subprocess.run([sys.executable, "-c", child], cwd=folder, env=env, capture_output=True, text=True, timeout=180)
    assert run.returncode == 0, run.stderr[-2000:]
    return [x for x in run.stdout.splitlines() if x.startswith("ROWS")]


EXPECTED = ["ROWS a.csv [('1', 'x\\ny')]", "ROWS a.json [('1', 'x')]", "ROWS a.html [('1', 'x')]"]


def test_readers_on_executors_without_the_package(tmp_path):
    assert _read(tmp_path, "local-cluster[1,1,1024]") == EXPECTED


def test_readers_from_another_folder(tmp_path):
    assert _read(tmp_path, "local[1]") == EXPECTED


def test_readers_loaded_anew_in_one_application(tmp_path):
    assert _read(tmp_path, "local-cluster[1,1,1024]", ANEW) == EXPECTED
