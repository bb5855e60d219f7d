"""What a build says that it did, with a model and without."""

import os

from webloom.__main__ import main
from webloom.plans import build, pages
from webloom.sources import jsonl

PAGE = "<html><head><title>{0}</title><style>.n{{display:grid}}</style></head><body><p>{1}</p></body></html>"


def sites(root, **texts):
    for name, html in texts.items():
        (root / name).mkdir(parents=True)
        (root / name / "index.html").write_text(html)
    (root / "a" / "info.html").write_text("<title>T</title><dl><dt>CATEGORY</dt><dd><a>beauty</a><a>web</a></dd></dl>")


def test_counts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(build, "LONGEST_PAGE", 5000)
    monkeypatch.setattr(pages, "LONGEST_PAGE", 5000)
    root, out = tmp_path / "sites", f"{tmp_path}/out"
    sites(root, a=PAGE.format("A", "a" * 90), b=PAGE.format("B", "b" * 90), c=PAGE.format("B", "b" * 90), d=PAGE.format("D", "d" * 6000), e=" ", f="")
    assert build.counted_build(spark, str(root), out) == build.Counts({"full": 2}, 5, 2, 3, 1, 1, 0, 0)
    assert build.counted_build(spark, str(root), out, start=2) == build.Counts({}, 4, 0, 4, 1, 2, 0, 0)
    plain = {r.output for r in jsonl.read_jsonl(spark, out).collect()}
    told = f"{tmp_path}/told"
    assert main(["build", str(root), told, "--mode", "overwrite", "--ask", "tests.list_pages:model", "--pause", "0"], spark) == {"full": 3, "sites": 5, "processed": 3, "skipped": 2, "too_long": 1, "repeated": 0, "asked": 3, "unanswered": 2}
    answers = [r.output for r in jsonl.read_jsonl(spark, told).collect()]
    assert len(answers) == 3 and sum(x.startswith("Design reasoning:\n- answered\n\nCode:\n```html\n") for x in answers) == 1 and sum(x in plain for x in answers) == 2
    assert not [x for x in os.listdir(tmp_path) if x not in ("sites", "out", "told")]
