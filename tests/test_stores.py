"""Files in and out: corpus scan (S4), chunk files."""

import pytest
from conftest import SF001

from tessera.operators.chunking import chunk_recursive
from tessera.plans.stores import q_chunk_files, q_source_chunks
from tessera.sources.corpus import load_documents, scan_corpus
from tessera.sources.driver import doc_corpus


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_scan_corpus_with_spaces_and_signs(spark, tmp_path, scheme):
    root = tmp_path / "my docs"
    (root / "a+b").mkdir(parents=True)
    (root / "a+b" / "one 50%.md").write_text("---\ntitle: x\n---\nbody\n")
    (root / "two.MDX").write_text("plain")
    (root / "three.txt").write_text("no document")
    d = load_documents(scan_corpus(spark, f"{scheme}{root}"))
    got = {r.source_path: (r.file_name, r.page_content, r.metadata.get("title")) for r in d.collect()}
    assert got == {"a+b/one 50%.md": ("one 50%.md", "body\n", "x"), "two.MDX": ("two.MDX", "plain", None)}


def test_scan_corpus_without_root(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        scan_corpus(spark, str(tmp_path / "none"))


def test_chunk_files_hold_the_chunks(spark):
    want = chunk_recursive(doc_corpus(spark, SF001).select("source_path", "page_content"))
    cols = ["source_path", "chunk_idx", "chunk_id", "page_content"]
    a = sorted(want.select(*cols).collect())
    got = q_chunk_files(spark, SF001)
    assert sorted(got.select(*cols).collect()) == a
    assert {r.chunk_strategy for r in got.select("chunk_strategy").distinct().collect()} == {"recursive"}
    last = max(r.source_path for r in a)
    assert {r.chunk_idx for r in q_source_chunks(spark, SF001).collect()} == {r.chunk_idx for r in a if r.source_path == last}
