"""Tables that a loop joins with themselves keep a guess of their size that does not grow from round to round."""

import pytest

from voxloom.operators import hierarchy, spanning


def guess(df, capsys):
    capsys.readouterr()
    df.explain(mode="cost")
    return capsys.readouterr().out


def test_choice_of_clusters(spark, capsys):
    rows = [(i, i - 1 if i else None, float(i % 7)) for i in range(40)]
    best = hierarchy.chosen(spark.createDataFrame(rows, "c long, parent long, s double"))
    assert best.count() == 40
    said = guess(best, capsys)
    assert "sizeInBytes" in said and "E+" not in said  # beyond exbibytes, the guess is printed with an exponent


@pytest.mark.parametrize("part", ["vectors", "corpus"])
def test_components_of_a_path(spark, capsys, monkeypatch, part):
    monkeypatch.setattr(spanning, "FEW", 0)
    ends = ("u", "v") if part == "vectors" else ("a", "b")
    components = spanning.components
    if part == "corpus":
        from voxloom.llm.components import components
    found = components(spark.createDataFrame([(i, i + 1) for i in range(24)], [*ends]))
    assert {(r["id"], r["component"]) for r in found.collect()} == {(i, 0) for i in range(25)}
    assert "E+" not in guess(found, capsys)
