"""Results that appear together: written beside their targets, then moved there.

A publication writes to ``<root>/.staging-<id>/``. Spark and its readers pass over folders that
begin with a dot. Once everything is there, a manifest is written and every result is moved to
``<root>/<name>`` by a rename. Results that are replaced wait in the staging folder until all
moves are done, and come back should one fail. Nothing but a publication's own folders is ever
removed: a result carries a marker file with the publication's id, and only a marked one is
taken back.

When the driver dies amid the moves, the manifest says what is left to do: ``recover`` does it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from cohortspark.sources.scratch import path_exists, remove_path

MANIFEST = "_manifest.json"
_STAGING = ".staging-"


def _paths(spark: SparkSession):
    return spark._jvm.org.apache.hadoop.fs


def move(spark: SparkSession, source: str, target: str, replace_file: bool = False) -> None:
    """Rename a folder or file. Raises ``FileExistsError`` if there is something at the target."""
    fs = _paths(spark)
    old, new = fs.Path(source), fs.Path(target)
    context = fs.FileContext.getFileContext(
        old.getFileSystem(spark._jsc.hadoopConfiguration()).getUri(),
        spark._jsc.hadoopConfiguration(),
    )
    kind = getattr(fs, "Options$Rename")
    option = spark.sparkContext._gateway.new_array(kind, 1)
    option[0] = kind.OVERWRITE if replace_file else kind.NONE
    try:
        context.rename(old, new, option)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            raise FileExistsError(f"exists already: {target}") from error
        raise


def _write_file(spark: SparkSession, path: str, text: str) -> None:
    target = _paths(spark).Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _read_file(spark: SparkSession, path: str) -> str:
    target = _paths(spark).Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


class Publication:
    """A staging folder below ``root``; as a context it is discarded if not published."""

    def __init__(self, spark: SparkSession, root: str, identifier: str | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.id = identifier or uuid.uuid4().hex
        self.path = f"{self.root}/{_STAGING}{self.id}"

    def __enter__(self) -> Publication:
        return self

    def __exit__(self, *_: object) -> None:
        self.discard()

    def discard(self) -> None:
        """Remove the staging folder, and with it what was not published."""
        remove_path(self.spark, self.path)

    def _is_own(self, name: str) -> bool:
        return path_exists(self.spark, f"{self.root}/{name}/_run-{self.id}")

    def publish(self, names: Iterable[str], mode: str = "errorifexists") -> list[str]:
        """Move the staged results to their places, all or none; returns the names moved.

        ``errorifexists`` fails if a target is there, also one that has come up meanwhile;
        ``overwrite`` replaces targets; ``ignore`` leaves out results whose target is there.
        The manifest of what was moved is at ``<root>/_manifest.json`` afterwards.
        """
        names = list(names)
        for name in names:
            _write_file(self.spark, f"{self.path}/{name}/_run-{self.id}", "")
        plan = {"id": self.id, "mode": mode, "results": names}
        _write_file(self.spark, f"{self.path}/_planned.json", json.dumps(plan))
        # From here on a dead driver's work can be finished.
        move(self.spark, f"{self.path}/_planned.json", f"{self.path}/{MANIFEST}")
        return self._move_all(names, mode)

    def _move_all(self, names: list[str], mode: str) -> list[str]:
        try:
            for name in names:
                if not self._is_own(name):
                    self._move_one(name, mode)
        except BaseException:
            self._undo(names)
            raise
        moved = [name for name in names if self._is_own(name)]
        done = json.dumps({"id": self.id, "mode": mode, "results": moved})
        _write_file(self.spark, f"{self.path}/_done.json", done)
        move(self.spark, f"{self.path}/_done.json", f"{self.root}/{MANIFEST}", replace_file=True)
        self.discard()
        return moved

    def _move_one(self, name: str, mode: str) -> None:
        target = f"{self.root}/{name}"
        if mode != "errorifexists" and path_exists(self.spark, target):
            if mode == "ignore":
                return
            move(self.spark, target, f"{self.path}/_replaced-{name}")
        move(self.spark, f"{self.path}/{name}", target)

    def _undo(self, names: list[str]) -> None:
        for name in reversed(names):
            target, replaced = f"{self.root}/{name}", f"{self.path}/_replaced-{name}"
            if self._is_own(name):
                move(self.spark, target, f"{self.path}/{name}")
            if path_exists(self.spark, replaced) and not path_exists(self.spark, target):
                move(self.spark, replaced, target)
        # Nothing is left to be done.
        remove_path(self.spark, f"{self.path}/{MANIFEST}")


def read_manifest(spark: SparkSession, root: str) -> dict | None:
    """Id, mode and result names of the last publication below ``root``."""
    path = f"{root.rstrip('/')}/{MANIFEST}"
    return json.loads(_read_file(spark, path)) if path_exists(spark, path) else None


def recover(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """Finish the publications below ``root`` whose driver died amid the moves.

    Returns the names each of them has moved in all, by id. Staging folders without a manifest
    may belong to a run that is still writing, and are left alone. Not to be called while
    another driver publishes here.
    """
    fs = _paths(spark)
    folder = fs.Path(root.rstrip("/"))
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    finished = {}
    for status in system.listStatus(folder):
        name = status.getPath().getName()
        if not name.startswith(_STAGING):
            continue
        manifest = f"{root.rstrip('/')}/{name}/{MANIFEST}"
        if not path_exists(spark, manifest):
            continue
        plan = json.loads(_read_file(spark, manifest))
        staged = Publication(spark, root, plan["id"])
        finished[plan["id"]] = staged._move_all(plan["results"], plan["mode"])
    return finished
