"""Documents of a word processor, structured files, path lists, runs and samples."""

from __future__ import annotations

import io
import zipfile

import pytest

from corpusmill.sources import files, scratch

WORD = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def docx(*paragraphs: str) -> bytes:
    body = "".join(f"<w:p>{p}</w:p>" for p in paragraphs)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{WORD}"><w:body>{body}</w:body></w:document>')
    return out.getvalue()


def test_documents_of_a_folder(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub/a.docx").write_bytes(docx("<w:r><w:t>One </w:t></w:r><w:r><w:t>line</w:t><w:tab/><w:t>x</w:t></w:r>", "", "<w:r><w:t>Two</w:t></w:r>"))
    (tmp_path / "b.docx").write_bytes(b"no archive")
    (tmp_path / "c.txt").write_bytes(b"caf\xc3\xa9 \xff ok")
    (tmp_path / "d.pdf").write_bytes(b"%PDF")
    got = {r["doc_id"]: r["text"] for r in files.read_documents(spark, str(tmp_path)).collect()}
    assert got == {"a": "One line\tx\n\nTwo", "b": None, "c": "café  ok"}
    rows = spark.createDataFrame([("x", " a\t b\r\n\r\n\r\nc "), ("y", " \n ")], "doc_id string, text string")
    assert [tuple(r) for r in files.clean_texts(rows).collect()] == [("x", "a b\n\nc")]


@pytest.mark.parametrize("suffix", ["json", "yaml", "toml"])
def test_structured_files_round_trip(tmp_path, suffix):
    value = {"a": 1, "b": ["x", 'é"q'], "c": {"d": True, "e": {"f": 2.5}}, "g": [{"h": 1}, {"h": 2, "i": {"j": "k"}}]}
    path = str(tmp_path / f"v.{suffix}")
    files.dump_structured({"old": 1}, path)
    files.dump_structured(value, path)
    assert files.load_structured(path) == value and len(list(tmp_path.iterdir())) == 1


def test_other_suffixes(tmp_path):
    files.dump_structured("plain", str(tmp_path / "t.md"))
    assert files.load_structured(str(tmp_path / "t.md")) == "plain"
    for act in (lambda p: files.dump_structured(1, p), files.load_structured):
        (tmp_path / "x.bin").write_text("")
        with pytest.raises(ValueError):
            act(str(tmp_path / "x.bin"))


def test_paths(tmp_path):
    for name in ("a/1.json", "a/b/2.json", "a/3.txt", "4.json"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("")
    found = files.expand_paths([str(tmp_path / "a"), str(tmp_path / "*.json"), str(tmp_path / "4.json"), str(tmp_path / "none")], ".json")
    assert found == sorted(str(tmp_path / n) for n in ("a/1.json", "a/b/2.json", "4.json"))


def test_runs_are_checked(spark, tmp_path):
    (tmp_path / "ok.json").write_text('{"info": {}, "tasks": []}')
    (tmp_path / "part.json").write_text('{"info": {}}')
    (tmp_path / "bad.json").write_text('{"info": {}} x')
    got = {r["file"]: r["missing"] for r in files.checked_runs(spark, str(tmp_path), ("info", "tasks")).collect()}
    assert got == {"ok.json": [], "part.json": ["tasks"], "bad.json": ["json"]}


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Elsewhere:
        conf = type("C", (), {"get": staticmethod(lambda key, default=None: default)})

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"
            _jsc = type("J", (), {"sc": staticmethod(lambda: type("S", (), {"getCheckpointDir": staticmethod(lambda: type("O", (), {"isDefined": staticmethod(lambda: False)}))}))})

    with pytest.raises(RuntimeError):
        scratch.shared_dir(Elsewhere)
    assert scratch.shared_dir(spark)
