"""Operators run on workers that cannot import the package."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from shelfcast.session import build
from shelfcast.llm import catalog
import corpus_pipeline
spark = build("shipping", "local[4]", **{
    "spark.sql.shuffle.partitions": "4",
    "spark.checkpoint.dir": f"file://{sys.argv[2]}/shared",
    "spark.sql.warehouse.dir": f"file://{sys.argv[2]}/warehouse",
})
spark.sparkContext.setLogLevel("OFF")
texts = [("the house by the river and the stone " * (1 + i % 5) + f"word{i} x{i}@a.example", "aa") for i in range(40)]
texts += [(f"della ragazza perche mattina sempre amore numero{i} " * (1 + i % 4), "bb") for i in range(40)]
rows = [(i, t, lang, "s", len(t)) for i, (t, lang) in enumerate(texts)]
save = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.parquet(f"{sys.argv[2]}/{name}.parquet")
save(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint", "documents")
save([(i, 1, int(i % 7 == 0)) for i in range(80)], "doc_id bigint, quality int, toxic int", "labels")
save([(1, texts[3][0])], "item_id bigint, text string", "benchmark")
save([(1, "http://a.example/1", "<article><p>text</p></article>")], "page_id bigint, url string, html string", "pages")
save([(i, [float(i % 5), 1.0, float(i % 3)], 0) for i in range(30)], "vec_id bigint, embedding array<float>, label int", "embeddings")
for name, query in (catalog.queries() | {"pipeline": corpus_pipeline.run}).items():
    print(name, query(spark, sys.argv[2]).count(), flush=True)
spark.stop()
"""


def test_session_started_in_another_folder(tmp_path):
    repo = str(Path(__file__).resolve().parents[2])
    settings = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = [sys.executable, "-c", SCRIPT, repo, str(tmp_path)]
    done = subprocess.run(run, cwd=tmp_path, env=settings, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-2000:]
    found = dict(line.split() for line in done.stdout.splitlines() if len(line.split()) == 2)
    assert len(found) == 14 and found["op1_pii"] == "80"
