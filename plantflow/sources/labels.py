"""Which batches of a stored table count.

A table keeps every batch in a place named by its label. Work that replaces batches by one with the same rows (compaction
of events, folding of summaries) writes the new batch first, then publishes one small file that says what it replaces,
and only then may the old files go. Until the file is there the new batch does not count; from then on the old ones do
not. So it may end after any step and be run again, and a reader sees all rows once at any time.

Files of this log have consecutive numbers and are made under another name and renamed; where the number is taken, the
one who comes second fails and changes nothing. That needs a store whose rename refuses an existing target (HDFS, local
files) or a single writer. A repeated batch whose label has been replaced is not written again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, SparkSession

LOG = "_labels"
#: What labels of batches that replace others begin with.
MERGED = "merged-"


class _Store:
    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark.sparkContext._jvm, root.rstrip("/")
        self.files = self.at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str = "") -> list[str]:
        where = self.at(folder)
        return sorted(s.getPath().getName() for s in self.files.listStatus(where)) if self.files.exists(where) else []

    def read(self, name: str) -> str:
        opened = self.files.open(self.at(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(opened)).decode()
        finally:
            opened.close()

    def write(self, name: str, text: str) -> None:
        made = self.files.create(self.at(name), False)
        try:
            made.write(bytearray(text.encode()))
        finally:
            made.close()

    def rename(self, old: str, new: str) -> bool:
        """False where the new name is taken."""
        return not self.files.exists(self.at(new)) and bool(self.files.rename(self.at(old), self.at(new)))

    def delete(self, name: str) -> None:
        self.files.delete(self.at(name), True)


@dataclass
class Labels:
    """What the log says: per part of the table (such as a date) the merged label that counts, and those it replaced."""

    merged: dict[str, str] = field(default_factory=dict)
    replaced: dict[str, list[str]] = field(default_factory=dict)

    def counting(self, part: Column, label: Column) -> Column:
        """Rows that count. Columns a table is kept by, so that the scan leaves the other batches out."""
        kept = ~label.startswith(MERGED)
        if self.merged:
            kept |= in_batches(part, label, {name: {own} for name, own in self.merged.items()})
        gone = {name: set(own) for name, own in self.replaced.items() if own}
        return kept & ~in_batches(part, label, gone) if gone else kept

    def parts_without(self, label: str) -> list[str]:
        """Parts in which the label has been replaced."""
        return [name for name, gone in self.replaced.items() if label in gone]

    def is_replaced(self, part: str, label: str) -> bool:
        return label in self.replaced.get(part, ())


def current(spark: SparkSession, root: str) -> tuple[int, Labels]:
    """The log's last number, which `publish` asks for, and what it says."""
    return _last(_Store(spark, root))


def read(spark: SparkSession, root: str) -> Labels:
    return current(spark, root)[1]


def in_batches(part: Column, label: Column, batches: dict[str, set[str]]) -> Column:
    """Rows of the named batches of each part."""
    by_labels: dict[tuple[str, ...], list[str]] = {}
    for name, own in batches.items():
        by_labels.setdefault(tuple(sorted(own)), []).append(name)
    return reduce(or_, [part.isin(names) & label.isin(list(own)) for own, names in by_labels.items()])


def _last(store: _Store) -> tuple[int, Labels]:
    numbers = [int(n.removesuffix(".json")) for n in store.names(LOG) if n.endswith(".json") and n[:1].isdigit()]
    if not numbers:
        return 0, Labels()
    found = json.loads(store.read(f"{LOG}/{max(numbers):012d}.json"))
    return max(numbers), Labels(found["merged"], found["replaced"])


def publish(spark: SparkSession, root: str, seen: int, labels: Labels) -> None:
    """Makes `labels` what counts, if the log still ends with number `seen`."""
    store = _Store(spark, root)
    made = f"{LOG}/new-{uuid.uuid4().hex}"
    store.write(made, json.dumps({"merged": labels.merged, "replaced": labels.replaced}))
    if not store.rename(made, f"{LOG}/{seen + 1:012d}.json"):
        store.delete(made)
        raise RuntimeError("the table's labels changed meanwhile; run it again")


def new_label() -> str:
    return f"{MERGED}{uuid.uuid4().hex}"


def clean(spark: SparkSession, root: str, folders: Callable[[_Store], Iterable[tuple[str, str, str]]]) -> list[str]:
    """Deletes batches that do not count; returns their folders.

    folders(store) lists (part, label, folder) of all batches. Run it when no reader uses a state of the table from before
    the last change, no merge is under way (unpublished merged batches go, too), and no replaced batch can be repeated any
    more: the log forgets them."""
    store = _Store(spark, root)
    seen, labels = _last(store)
    gone = []
    for part, label, folder in folders(store):
        dead = label.startswith(MERGED) and labels.merged.get(part) != label
        if dead or labels.is_replaced(part, label):
            store.delete(folder)
            gone.append(folder)
    if labels.replaced:
        publish(spark, root, seen, Labels(labels.merged))
    return sorted(gone)
