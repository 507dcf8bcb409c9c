"""What Python workers hold beside the executor's JVM."""
import os
import subprocess
import sys

import pytest
from pyspark.sql import SparkSession

from verity.llm.toxicity import drop_toxic, score_toxicity

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# A worker lives on after its task: the megabytes it has then, less those of
# the same worker once it has nothing left to give back.
KEPT = """
import ctypes, random, re, sys
import pyarrow as pa
from verity.llm.{module} import {names}
from verity.llm.queries import tokenizer_path

def held():
    with open("/proc/self/smaps_rollup") as f:
        return int(re.search(r"Pss_Anon:\\s+(\\d+)", f.read())[1]) / 1024

def batches():
    pick = random.Random(1)
    for _ in range(4):
        texts = ["".join(pick.choices("abcdefgh ", k=4000)) for _ in range(500)]
        yield pa.RecordBatch.from_arrays([pa.array(range(500), pa.int64()), *[pa.array([0] * 500, pa.int64())] * {middle},
                                          pa.array(texts, pa.string())], names=["doc_id", *["t"] * {middle}, "text"])

for _ in ({mapper})(batches()):
    pass
after = held()
pa.default_memory_pool().release_unused()
ctypes.CDLL(None).malloc_trim(0)
print(after - held())
"""
MAPPERS = {
    "encode": ("bpe", "_leaf_mapper", 0, "_leaf_mapper(tokenizer_path(), True, True)"),
    "sign": ("minhash", "_sign", 1, "_sign"),
    "sample": ("toxicity", "_sample_terms", 1, "_sample_terms"),
}


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
@pytest.mark.parametrize("name", MAPPERS)
def test_worker_gives_memory_back_after_a_task(name):
    module, names, middle, mapper = MAPPERS[name]
    script = KEPT.format(module=module, names=names, middle=middle, mapper=mapper)
    ran = subprocess.run([sys.executable, "-c", script], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert ran.returncode == 0, ran.stderr
    assert float(ran.stdout) < 8


def test_toxicity_makes_no_table_of_local_rows(spark, monkeypatch):
    """One made of Python rows starts a second set of workers on every
    executor, which stay beside those of the scan."""
    docs = spark.createDataFrame([(i, f"w{i} x{i} y{i} z{i} {'bad' if i % 2 else 'good'} v{i}") for i in range(60)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id int, toxic int")

    def refuse(*args, **kwargs):
        raise AssertionError("a table of local rows")
    monkeypatch.setattr(SparkSession, "createDataFrame", refuse)
    monkeypatch.setattr(type(spark), "createDataFrame", refuse)
    scored = {r["doc_id"]: r["predicted"] for r in score_toxicity(docs, labels).collect()}
    assert len(scored) == 60 and set(scored.values()) == {0, 1}
    assert {r["doc_id"] for r in drop_toxic(docs, labels).collect()} == {i for i in scored if not scored[i]}
