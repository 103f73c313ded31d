from quillstone import cli


def test_reindex_lists_all(spark, tmp_path, capsys):
    folder = tmp_path / "raw" / "us" / "speech" / "2020"
    folder.mkdir(parents=True)
    for k in range(1_005):
        (folder / f"d{k}.pdf").write_bytes(b"%PDF")
    (tmp_path / "us.jsonl").write_text('{"doc_id": "d7", "bank_code": "us"}\n')
    argv = [str(x) for x in ("reindex", tmp_path / "us.jsonl", tmp_path / "raw")]
    assert cli.run(spark, argv) == 0
    out = capsys.readouterr().out
    assert out.count(".pdf") == 1_004 and "1004 stored files" in out and "/d7.pdf" not in out
