"""One commit for all tables that a micro-batch writes, and folds of old ones.

Writers fill folders first and commit them last, with one small file that names
the folders of every table. Readers take committed folders only, so they see
the tables of a micro-batch together or not at all. A fold names, per table and
day, the folder that holds everything up to its number; batches and folds up to
there are read no more. It may note something of a day's folder by table, such as
the column that its rows are ranked by.

    <root>/_commits/b000000000012.json   folders of micro-batch 12, by table
    <root>/_commits/f000000000012.json   folders of all up to 12, by table and day
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tickline.sinks.files import delete, names, read_text, write_text

_FOLDER = "_commits"
_NOTES = "_notes"


@dataclass(frozen=True)
class State:
    """What is committed: the newest number, the fold below and the batches since."""

    last: int
    folded: int
    base: dict[str, dict[str, str]]  # table -> day -> folder
    batches: dict[int, dict[str, list[str]]]  # number -> table -> folders
    notes: dict[str, dict[str, str]] = field(default_factory=dict)  # table -> day -> note on its folded folder

    def folders(self, table: str) -> list[str]:
        return [*self.base.get(table, {}).values(),
                *[f for n in sorted(self.batches) for f in self.batches[n].get(table, [])]]


def _file(root: str, kind: str, number: int) -> str:
    return f"{root.rstrip('/')}/{_FOLDER}/{kind}{number:012d}.json"


def state(spark: SparkSession, root: str) -> State | None:
    """The committed state, or None of a root without commits."""
    root = root.rstrip("/")
    found = [n[:-5] for n in names(spark, f"{root}/{_FOLDER}") if n.endswith(".json") and n[0] in "bf"]
    if not found:
        return None
    folded = max((int(n[1:]) for n in found if n[0] == "f"), default=-1)
    base = json.loads(read_text(spark, _file(root, "f", folded))) if folded >= 0 else {}
    since = sorted(int(n[1:]) for n in found if n[0] == "b" and int(n[1:]) > folded)
    batches = {n: json.loads(read_text(spark, _file(root, "b", n))) for n in since}
    notes = base.pop(_NOTES, {})
    return State(max([folded, *since]), folded, base, batches, notes)


def folders_by_day(spark: SparkSession, root: str, held: State, table: str) -> dict[str, tuple[str | None, list[str]]]:
    """Per day (the folder name `date=...`): the folded folder and those of batches since; from names alone."""
    days = {day: (folder, []) for day, folder in held.base.get(table, {}).items()}
    for number in sorted(held.batches):
        for folder in held.batches[number].get(table, []):
            for day in names(spark, f"{root.rstrip('/')}/{table}/{folder}"):
                if day.startswith("date="):
                    days.setdefault(day, (None, []))[1].append(f"{folder}/{day}")
    return days


def is_committed(spark: SparkSession, root: str, number: int) -> bool:
    held = state(spark, root)
    return held is not None and (number <= held.folded or number in held.batches)


def commit(spark: SparkSession, root: str, number: int, tables: Mapping[str, Sequence[str]]) -> None:
    """Make the named folders of each table visible, all at once."""
    write_text(spark, _file(root, "b", number), json.dumps({t: list(f) for t, f in tables.items()}))


def commit_fold(spark: SparkSession, root: str, number: int, base: Mapping[str, Mapping[str, str]],
                notes: Mapping[str, Mapping[str, str]] | None = None) -> None:
    named = {t: dict(f) for t, f in base.items()} | {_NOTES: {t: dict(f) for t, f in (notes or {}).items()}}
    write_text(spark, _file(root, "f", number), json.dumps(named))


def read_folders(spark: SparkSession, root: str, table: str, folders: Sequence[str]) -> DataFrame:
    """Rows of some of a table's folders, with the columns that the folders' names give."""
    path = f"{root.rstrip('/')}/{table}"
    return spark.read.option("basePath", path).parquet(*[f"{path}/{f}" for f in folders])


def read_committed(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table's committed rows; all rows of a root without commits."""
    held = state(spark, root)
    if held is None:
        return spark.read.parquet(f"{root.rstrip('/')}/{table}")
    return read_folders(spark, root, table, held.folders(table))


def drop_folded(spark: SparkSession, root: str, tables: Sequence[str]) -> list[str]:
    """Delete what a fold replaced: commit files, and folders of `tables` that the
    state names no more. Not while someone reads an older state."""
    root = root.rstrip("/")
    held = state(spark, root)
    if held is None or held.folded < 0:
        return []
    gone = []
    for table in tables:
        used = held.folders(table)
        for folder in names(spark, f"{root}/{table}"):
            number = int(folder.removeprefix("batch_id=")) if folder.startswith("batch_id=") else held.last + 1
            if number > held.folded or folder in used:
                continue
            days = [f"{folder}/{d}" for d in names(spark, f"{root}/{table}/{folder}") if "=" in d]
            unused = [d for d in days if d not in used]
            for path in [folder] if len(unused) == len(days) else unused:
                delete(spark, f"{root}/{table}/{path}")
                gone.append(f"{table}/{path}")
    for name in names(spark, f"{root}/{_FOLDER}"):
        if name.endswith(".json") and name[0] in "bf" and int(name[1:-5]) <= held.folded and name != f"f{held.folded:012d}.json":
            delete(spark, f"{root}/{_FOLDER}/{name}")
    return gone
