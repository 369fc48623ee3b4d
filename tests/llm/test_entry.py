import os
import re
import subprocess
import sys

import corpus_pipeline
from ledgerloom.llm import simhash
from pyspark import cloudpickle


def test_all_queries_and_the_pipeline_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert sorted(int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))) == list(range(1, 14))
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)


def test_stages_keep_the_columns_and_repeat_nothing(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, docs.count()
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, folder)
        assert docs.columns == columns or n == len(corpus_pipeline.STAGES) - 1
        path = corpus_pipeline.scratch_path(spark, "test")
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "mix_sources" and n < 3:
            assert 0 < docs.count() <= kept
            kept = docs.count()
    assert docs.count() > 0


def test_workers_need_no_copy_of_the_library():
    """A worker's function, unpickled in a process that cannot import the library, still works."""
    program = "import pickle, sys; f, g = pickle.load(sys.stdin.buffer); assert 'ledgerloom' not in sys.modules; print(f(g('some words of text')))"
    sent = cloudpickle.dumps((simhash.majority, simhash.shingle_hashes))
    apart = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", program], input=sent, capture_output=True, cwd="/", env=apart, timeout=120)
    assert done.returncode == 0, done.stderr.decode()
    assert int(done.stdout) == simhash.majority(simhash.shingle_hashes("some words of text"))


def test_without_the_libraries_of_the_subpackage_the_other_queries_stay():
    program = (
        "import sys; sys.modules['tiktoken'] = None; sys.path.insert(0, sys.argv[1]); import __spark_entry__ as e; "
        "print(len(e.queries()), any(n.startswith('op') for n in e.queries()))"
    )
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    done = subprocess.run([sys.executable, "-c", program, root], capture_output=True, cwd="/", timeout=120)
    assert done.returncode == 0, done.stderr.decode()
    count, some = done.stdout.decode().split()
    assert int(count) >= 58 and some == "False"
