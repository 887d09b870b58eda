"""The pipeline on a small corpus, stage by stage."""

import os
import subprocess
import sys

import pytest

import corpus_pipeline
from sensorloom.llm import queries
from sensorloom.llm.common import DOCUMENT_COLUMNS

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    bench = "the quick brown fox jumps over one lazy dog while nobody looks at it today"
    prose = [" ".join(f"w{(i * 37 + k * k) % 5000}" for k in range(120)) for i in range(30)]
    docs = [(i, p) for i, p in enumerate(prose)]
    docs += [(100, prose[3]), (101, prose[4] + " tail"), (102, bench), (103, "this idiot again"), (104, None), (105, ""),
             (106, "shared line of some length, repeated\n" + prose[7].replace("w", "v")),
             (107, "shared line of some length, repeated\n" + prose[8].replace("w", "u"))]
    docs += [(200 + i, f"an idiot writes {'zxy' * (i % 5)} q{i}") for i in range(60)]
    labels = [(d, int("idiot" in (t or ""))) for d, t in docs]
    spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in docs], "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        docs.write.parquet(f"{folder}/out-{name}")
        docs = spark.read.parquet(f"{folder}/out-{name}")
        seen[name] = {r["doc_id"]: r for r in docs.select("doc_id", *(["text"] if "text" in docs.columns else [])).collect()}
        if name != "packing":
            assert tuple(docs.columns) == DOCUMENT_COLUMNS
    first = set(seen["toxicity"])
    assert first == {*range(30), 100, 101, 102, 104, 105, 106, 107}
    assert set(seen["line_dedup"]) == first - {100} and "shared" not in seen["line_dedup"][107]["text"] and "shared" in seen["line_dedup"][106]["text"]
    assert set(seen["near_duplicates"]) == first - {100, 101}
    assert set(seen["decontamination"]) == first - {100, 101, 102} == set(seen["packing"])
    assert corpus_pipeline.run(spark, folder).select("doc_id").distinct().count() == len(seen["packing"])


def test_every_operator_is_registered():
    assert {k.split("_")[0] for k in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}


def test_rest_works_without_the_subpackage(tmp_path):
    for name in ("__spark_entry__.py", "workload.py"):
        os.symlink(f"{ROOT}/{name}", tmp_path / name)
    os.mkdir(tmp_path / "sensorloom")
    for name in os.listdir(f"{ROOT}/sensorloom"):
        if name != "llm":
            os.symlink(f"{ROOT}/sensorloom/{name}", tmp_path / "sensorloom" / name)
    code = ("import importlib.util as u, sys; sys.path[:] = [p for p in sys.path if p not in ('', %r)]; sys.path.insert(0, %r); "
            "s = u.spec_from_file_location('__spark_entry__', %r); m = u.module_from_spec(s); s.loader.exec_module(m); "
            "q = m.queries(); assert 'pipeline' not in q and not any(k.startswith('op') for k in q) and len(q) > 100")
    # a real copy of the entry, so that its own folder is the one without the subpackage
    (tmp_path / "__spark_entry__.py").unlink()
    (tmp_path / "__spark_entry__.py").write_text(open(f"{ROOT}/__spark_entry__.py").read())
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code % (ROOT, str(tmp_path), str(tmp_path / "__spark_entry__.py"))], check=True, cwd=tmp_path, env=env)
