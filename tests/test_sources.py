"""Readers and sinks round trips."""

import json

from strata.operators import links
from strata.sources import read_category_links, read_doc_lines, write_result
from strata.sources import driver_tables as views

SF = "/root/testdata/sf0.001"


def test_link_lines_round_trip_through_text_files(spark, tmp_path):
    lines = views.link_lines_view(spark, SF)
    write_result(lines, str(tmp_path / "links"), fmt="text", single_file=False)
    from_files = read_category_links(spark, str(tmp_path / "links"))
    assert sorted(from_files.collect()) == sorted(views.links_view(spark, SF).collect())
    assert links.top_categories(from_files, 3).count() == 3


def test_doc_lines_from_text_files(spark, tmp_path):
    path = tmp_path / "docs.txt"
    path.write_text('<doc id="1" url="u" title="t">One two</doc>\nbroken line\n')
    assert [(r.doc_id, r.text) for r in read_doc_lines(spark, str(path)).collect()] == [("1", "One two")]


def test_write_result_formats(spark, tmp_path):
    top = links.top_categories(views.links_view(spark, SF), 5)
    for fmt in ("parquet", "csv", "json", "text"):
        for single in (False, True):
            out = str(tmp_path / f"{fmt}-{single}")
            write_result(top, out, fmt=fmt, single_file=single)
            reader = spark.read.option("header", "true") if fmt == "csv" else spark.read
            back = getattr(reader, fmt)(out)
            assert back.count() == 5
            assert not single or len(back.inputFiles()) == 1
    rows = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "text-False")).collect()]
    assert sorted((r["category"], r["count"]) for r in rows) == sorted((r["category"], r["count"]) for r in top.collect())
