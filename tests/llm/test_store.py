"""Code for Python workers that don't see the folder the driver has it in."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

RUN = """
import sys
sys.path.insert(0, {home!r})
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
import public_tokenizers
from rondo.llm import packing, url_filter
from rondo.llm.store import share_code

spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
share_code(spark)
share_code(spark)
assert len(spark.sparkContext._python_includes) == 1

@F.udf("string")
def place(x):
    import rondo.llm.packing
    return rondo.llm.packing.__file__ + " " + str({home!r} in sys.path)

where = spark.range(4).select(place("id")).distinct().collect()
docs = spark.createDataFrame([(1, "a few words"), (2, None)], "doc_id long, text string")
packed = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json")).collect()
print("WHERE", [r[0] for r in where], "PACKED", sorted((r.doc_id, r.length) for r in packed))
"""


def test_workers_need_not_see_the_folder(tmp_path):
    home = str(Path(__file__).resolve().parents[2])
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = [sys.executable, "-c", RUN.format(home=home)]
    said = subprocess.run(run, cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=300)
    assert said.returncode == 0, said.stderr[-2000:]
    line = next(x for x in said.stdout.splitlines() if x.startswith("WHERE"))
    assert "rondo.zip" in line and " False'" in line and home not in line.split("PACKED")[0]
    assert line.endswith("PACKED [(1, 4), (2, 1)]")
