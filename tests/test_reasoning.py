import os

from pyspark.sql import functions as F

from webloom.__main__ import main
from webloom.operators import reasoning


def test_prompts(spark):
    df = spark.createDataFrame([("Beauty", list("abcdef"), "None", "Unknown", 2, "grid"), (None, [], "Fade", "Dark", 0, "")], "industry string, category array<string>, motion string, scheme string, n_css int, keywords string")
    one, two = (r[0] for r in df.select(reasoning.prompt(df)).collect())
    assert "characteristics:\nIndustry: Beauty\nCategories: a, b, c, d, e\nCSS files: 2 file(s)\n\nDesign keywords detected: grid\n" in one and "like: grid\n" in one
    assert "characteristics:\nMotion: Fade\nColor scheme: Dark\n\nDesign keywords detected: standard web design patterns\n" in two
    assert one.startswith("You are a senior") and one.endswith('starting with "- ".')


def test_fallbacks(spark):
    df = spark.createDataFrame([("Beauty",), ("Food",), ("Art",), (None,)], "industry string")

    def ask(prompt):
        if "Food" in prompt:
            raise RuntimeError
        return None if "Art" in prompt else " told "

    got = {r.industry: r.reasoning for r in reasoning.reasoned(df, F.concat(F.lit("- "), F.coalesce("industry", F.lit("?"))), ask, pause=0).collect()}
    assert got == {"Beauty": "told", "Food": "- Food", "Art": "- Art", None: "told"}
    assert reasoning.reasoned(df, F.lit("-")).columns == ["industry", "reasoning"]


def test_command_line(spark, tmp_path):
    target = str(tmp_path / "sites")
    assert main(["gather", target, "--base", "https://l.jp", "--list", "tests.list_pages:listing", "--fetch", "tests.list_pages:web", "--most", "1", "--pause", "0"], spark) == {"processed": 1, "skipped": 2, "failed": 0}
    assert main(["build", target, f"{tmp_path}/out"], spark).get("full") == 1 and os.path.exists(f"{tmp_path}/out")
