"""The command line from a tree of articles to rankings, and its exit codes."""

import io
import json

import pytest

from folioscope import cli
from folioscope.operators import images


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    import numpy as np

    base = tmp_path_factory.mktemp("tree")
    for k, words in enumerate(("how to configure and set up a broker", "how to set up recordings on a server", "how to configure motion detection areas")):
        folder = base / f"a{k}"
        folder.mkdir()
        (folder / "index.mdx").write_text(f"---\ntitle: Article {k}\n---\n# A{k}\n\n{words}, in words enough to pass the gate.\n\n![i](i.png)\n")
        (folder / "i.png").write_bytes(images.encode_png(np.full((2, 2, 3), k, np.uint8)))
    return base


def test_stages_end_to_end(spark, tree, tmp_path, monkeypatch, capsys):
    data, embedded = str(tmp_path / "data"), str(tmp_path / "index")
    assert cli.main(["build", "--data", str(tree), "--out", data, "--strict"], spark) == 0
    report = json.loads((tmp_path / "data/REPORT.md.json").read_text())
    assert report["converted"] == 3 and report["hard_gate"] and report["histogram"] == {"1": 3}
    assert cli.main(["embed", "--dataset", data, "--embed-file", embedded, "--data", str(tree), "--modality", "text"], spark) == 0
    assert json.loads((tmp_path / "index/REPORT_index.json").read_text())["result"] == "PASS"
    monkeypatch.setattr("sys.stdin", io.StringIO("set up recordings server\nshow 1\nquit\nstats\n"))
    assert cli.main(["query", "--dataset", data, "--embed-file", embedded], spark) == 0
    said = capsys.readouterr().out
    assert "  1 " in said and "a1" in said.split("  2 ")[0]


def test_exit_codes(spark, tree, tmp_path):
    assert cli.main(["build", "--data", str(tmp_path / "none"), "--out", str(tmp_path)], spark) == 2
    (tree / "a0/extra.mdx").write_text("x")
    broken = tmp_path / "broken"
    (broken / "b").mkdir(parents=True)
    (broken / "b/index.mdx").write_text("![x](gone.png) and words enough that the content passes the gate")
    assert cli.main(["build", "--data", str(broken), "--out", str(tmp_path / "o"), "--strict"], spark) == 1
    assert cli.main(["embed", "--dataset", str(tmp_path), "--embed-file", str(tmp_path / "i"), "--limit", "0"], spark) == 2
    probes = tmp_path / "probes.json"
    probes.write_text(json.dumps([{"kind": "in-domain", "query": "zqx", "keywords": []}, {"kind": "out-of-domain", "query": "configure", "keywords": []}]))
    assert cli.main(["build", "--data", str(tree), "--out", str(tmp_path / "d")], spark) == 0
    assert cli.main(["embed", "--dataset", str(tmp_path / "d"), "--embed-file", str(tmp_path / "i"), "--modality", "text", "--probes", str(probes)], spark) == 3
