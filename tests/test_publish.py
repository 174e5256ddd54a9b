"""Results that appear together or not at all."""

import os

import pytest

from cohortspark.sources import Publication, publish, read_manifest, recover, write_table


def stage(spark, root, **tables):
    """A publication with one-number tables that were written but not yet moved."""
    made = Publication(spark, root)
    for name, number in tables.items():
        spark.range(number, number + 1).write.parquet(f"{made.path}/{name}")
    return made


def numbers(spark, root):
    """The number in every result below a folder."""
    names = sorted(n for n in os.listdir(root) if not n.startswith((".", "_")))
    return {n: spark.read.parquet(f"{root}/{n}").first()[0] for n in names}


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def staging(root):
    return [n for n in os.listdir(root) if n.startswith(".staging")]


def broken_move(monkeypatch, after):
    """The driver's renames of results fail from a certain one on."""
    move, calls = publish.move, []

    def failing(spark, source, target, *more, **options):
        if os.path.basename(target) in ("a", "b", "c") and ".staging" not in target:
            calls.append(target)
            if len(calls) > after:
                raise OSError("gone")
        return move(spark, source, target, *more, **options)

    monkeypatch.setattr(publish, "move", failing)


def test_all_results_appear(spark, root):
    made = stage(spark, root, a=1, b=2)
    assert numbers(spark, root) == {}
    assert made.publish(["a", "b"]) == ["a", "b"]
    assert numbers(spark, root) == {"a": 1, "b": 2}
    assert read_manifest(spark, root) == {"id": made.id, "mode": "errorifexists", "results": ["a", "b"]}
    assert staging(root) == []


def test_others_results_stay(spark, root):
    made = stage(spark, root, a=1, b=2)
    stage(spark, root, b=7).publish(["b"])
    with pytest.raises(FileExistsError, match="b$"), made:
        made.publish(["a", "b"])
    assert numbers(spark, root) == {"b": 7}
    assert staging(root) == []


def test_overwrite_comes_back_when_a_move_fails(spark, root, monkeypatch):
    stage(spark, root, a=1, b=2, c=3).publish("abc")
    made, move, failed = stage(spark, root, a=4, b=5, c=6), publish.move, []

    def once(spark, source, target, *more, **options):
        if target == f"{root}/b" and not failed:
            failed.append(target)
            raise OSError("gone")
        return move(spark, source, target, *more, **options)

    with monkeypatch.context() as patched:
        patched.setattr(publish, "move", once)
        with pytest.raises(OSError, match="gone"), made:
            made.publish("abc", "overwrite")
    assert numbers(spark, root) == {"a": 1, "b": 2, "c": 3}
    stage(spark, root, a=4, b=5, c=6).publish("abc", "overwrite")
    assert numbers(spark, root) == {"a": 4, "b": 5, "c": 6}
    assert staging(root) == []


@pytest.mark.parametrize("after", [0, 1, 2])
def test_a_dead_drivers_moves_are_finished(spark, root, monkeypatch, after):
    stage(spark, root, a=1, b=2).publish("ab")
    made = stage(spark, root, a=4, b=5, c=6)
    with monkeypatch.context() as patched:
        broken_move(patched, after)
        patched.setattr(Publication, "_undo", lambda *_: None)  # a dead driver undoes nothing
        with pytest.raises(OSError, match="gone"):
            made.publish("abc", "overwrite")
    assert staging(root) == [f".staging-{made.id}"]
    unfinished = stage(spark, root, a=9)
    assert recover(spark, root) == {made.id: ["a", "b", "c"]}
    assert numbers(spark, root) == {"a": 4, "b": 5, "c": 6}
    assert staging(root) == [f".staging-{unfinished.id}"]
    assert recover(spark, root) == {}


def test_a_single_table_is_staged_too(spark, root, monkeypatch):
    write_table(spark.range(1), root, "t")
    bad = spark.range(3).selectExpr("raise_error(CAST(id AS STRING)) AS id")
    with pytest.raises(Exception, match="(?i)user_raised|0|1|2"):
        write_table(bad, root, "t", "overwrite")
    assert numbers(spark, root) == {"t": 0} and staging(root) == []
    write_table(spark.range(5, 6), root, "t", "overwrite")
    assert numbers(spark, root) == {"t": 5}
