import os
import subprocess
import sys
import textwrap

from pyspark import SparkFiles

from opspark.operators import forest
from opspark.session import cut_lineage, drop_intermediates

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_intermediate_folders_go(spark):
    stored = cut_lineage(spark.range(5))
    path = stored.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(path)
    assert drop_intermediates(spark) >= 1
    assert not os.path.exists(path) and drop_intermediates(spark) == 0


def test_the_shipped_package_is_enough_for_a_worker(spark, tmp_path):
    """An interpreter in another folder, without this repository on its path, unpickles and runs a worker function from the package file alone."""
    from pyspark import cloudpickle

    from opspark.session import package_file

    archive = package_file(str(tmp_path))
    function = cloudpickle.dumps(forest.Forest.of([("x", 1.5, 2.0, 3.0)], ["x"]).predict)
    (tmp_path / "function").write_bytes(function)
    script = textwrap.dedent(
        f"""
        import pickle, sys
        sys.path = [{archive!r}] + [p for p in sys.path if p not in ("", {ROOT!r})]
        with open("function", "rb") as f:
            predict = pickle.load(f)
        import opspark
        assert opspark.__file__.startswith({archive!r}), opspark.__file__
        print(predict({{"x": [1, 2]}}).tolist())
        """
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONDONTWRITEBYTECODE": "1"}
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert out.stdout.strip() == "[2.0, 3.0]", out.stderr[-2000:]
    assert any(x.endswith("opspark.zip") for x in spark.sparkContext.getConf().get("spark.files", "").split(",") + os.listdir(SparkFiles.getRootDirectory()))


def test_a_missing_library_of_the_corpus_part_leaves_the_rest(tmp_path):
    script = textwrap.dedent(
        f"""
        import sys, warnings
        sys.modules["xxhash"] = None
        sys.path.insert(0, {ROOT!r})
        with warnings.catch_warnings(record=True) as said:
            warnings.simplefilter("always")
            import __spark_entry__ as entry
        names = entry.queries()
        print("zone_ranking" in names, any(n.startswith("op1_") for n in names), any("corpus queries are left out" in str(w.message) for w in said))
        """
    )
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert out.stdout.split()[0] == "True" and out.stdout.split()[1] == "False", out.stderr[-2000:]
