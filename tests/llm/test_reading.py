"""Licence texts in a zipped package; captures of one url, read by many tasks."""

import random
import subprocess
import sys
import zipfile
from pathlib import Path

from pyspark.sql import functions as F

from pizarra.llm import license_scan, ngram_join, warc
from pizarra.session import scratch_path

ROOT = Path(__file__).resolve().parents[2]


def test_licence_texts_are_found_in_a_zip(tmp_path):
    path = tmp_path / "package.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted((ROOT / "pizarra").rglob("*")):
            if f.suffix in (".py", ".txt"):
                z.write(f, f.relative_to(ROOT))
    code = "import sys; sys.path.insert(0, sys.argv[1]); from pizarra.llm import license_scan as s; print(s.__file__, len(s.full_texts()))"
    out = subprocess.run([sys.executable, "-c", code, str(path)], capture_output=True, text=True, cwd=tmp_path, check=True).stdout.split()
    assert "package.zip" in out[-2] and int(out[-1]) == len(license_scan.full_texts()) >= 7


def test_pages_of_one_url_are_read_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(warc, "READ_RUN", 500)
    rows = [(i, "https://a.example/x", f"<p>{i % 40} " + "y" * 120) for i in range(300)] + [(300 + i, None, "z" * 150) for i in range(100)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    folder = scratch_path(spark, "warc-test")
    captures = warc.write_archives(pages, folder)
    directory = warc.write_index(captures, f"{folder}-index")
    found = warc.lookup(directory, f"{folder}-index", captures)
    records = warc.read_captures(found, folder).withColumn("task", F.spark_partition_id())
    got = records.collect()
    assert sorted(r.page_id for r in got) == list(range(400)) and len({r.task for r in got}) >= 6
    first = {r.page_id: r for r in got}
    assert first[45].record_type == "revisit" and first[45].refers_to == 5 and first[5].record_type == "response"
    assert first[399].refers_to == 300


def test_a_family_of_near_copies_costs_some_comparisons_each(spark, docs_of, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 32)
    counted, write = [], ngram_join.written

    def written(df, name):
        out = write(df, name)
        if name == "pairs":
            counted.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "written", written)
    rng, n = random.Random(4), 300
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(n):
        words = list(base)
        words[rng.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(words)))
    got = ngram_join.linked_documents(docs_of(rows).repartition(3)).collect()
    assert {r.component_id for r in got} == {0} and len(got) == n
    assert sum(counted) <= 12 * n                       # all pairs are 150 times as many as there are documents
