"""A table in versioned parts with atomic commits (S2.A7, I1).

A table is a folder with two subfolders.  ``data/v=<version>/<part>`` holds
the rows of a part (say ``bucket=17`` or ``set_id=4``) as some version wrote
them; nothing there is ever overwritten.  ``commits/<number>.json`` names the
version of every part and how far each source was taken in; the commit with
the largest number is the table.

A writer stages its parts in a version folder of its own and then commits: the
new commit file is written under another name and renamed, which fails if that
number is there already.  So whatever stops a write before the rename leaves
the old table as it was, a replay of a batch that was committed changes
nothing, and of two writers at once one fails.  A commit lists parts, not
files or rows; it has a line for each bucket or set, as a catalogue would.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


class CommitConflict(RuntimeError):
    """Another writer committed first."""


@dataclass
class Commit:
    """The state of a table: version of each part, last batch of each source."""

    number: int = 0
    parts: dict[str, str] = field(default_factory=dict)
    taken: dict[str, int] = field(default_factory=dict)


class CommittedTable:
    def __init__(self, spark: SparkSession, path: str, schema: str):
        """``schema`` is the DDL of the rows, part column included."""
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self._folder = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self._files = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _names(self, name: str) -> list[str]:
        folder = self._at(name)
        return [f.getPath().getName() for f in self._files.listStatus(folder)] if self._files.exists(folder) else []

    # -- state

    def state(self) -> Commit:
        """The last commit; an empty one for a new table."""
        numbers = [int(n[:-5]) for n in self._names("commits") if n.endswith(".json")]
        if not numbers:
            return Commit()
        text = self.spark.read.text(f"{self.path}/commits/{max(numbers):012d}.json", wholetext=True).first()[0]
        return Commit(**json.loads(text))

    def taken(self, source: str, batch: int) -> bool:
        """Whether ``batch`` of ``source`` (numbers that grow) is in the table."""
        return batch <= self.state().taken.get(source, -1)

    # -- reading

    def read(self, parts: list[str] | None = None, state: Commit | None = None) -> DataFrame:
        """The rows of ``parts`` (all, if not given); only their folders are read."""
        state = state or self.state()
        chosen = [f"{self.path}/data/v={state.parts[p]}/{p}" for p in (state.parts if parts is None else parts) if p in state.parts]
        if not chosen:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).option("basePath", f"{self.path}/data").parquet(*sorted(chosen))
        return rows.select(*[f.name for f in self.spark.createDataFrame([], self.schema).schema.fields])

    # -- writing

    def stage(self, rows: DataFrame, part: str, version: str | None = None) -> str:
        """Write ``rows``, a folder for each value of column ``part``; returns the version to commit."""
        version = version or uuid.uuid4().hex
        rows.write.partitionBy(part).parquet(f"{self.path}/data/v={version}")
        return version

    def staged(self, version: str) -> list[str]:
        """The parts that a staged version holds."""
        return [n for n in self._names(f"data/v={version}") if "=" in n]

    def commit(self, before: Commit, version: str, replaced: list[str], source: str | None = None, batch: int | None = None) -> Commit:
        """Make ``version`` the rows of the ``replaced`` parts (none staged: the part is empty from now on)."""
        parts = {p: v for p, v in before.parts.items() if p not in set(replaced)}
        parts |= dict.fromkeys(self.staged(version), version)
        taken = before.taken if source is None else before.taken | {source: int(batch or 0)}
        after = Commit(before.number + 1, parts, taken)
        text = json.dumps(after.__dict__, sort_keys=True)
        temporary, final = self._at(f"commits/.{uuid.uuid4().hex}"), self._at(f"commits/{after.number:012d}.json")
        out = self._files.create(temporary, False)
        out.write(bytearray(text.encode()))
        out.close()
        jvm = self.spark._jvm.org.apache.hadoop.fs
        context = jvm.FileContext.getFileContext(self._files.getUri(), self.spark._jsc.hadoopConfiguration())
        no_options = self.spark.sparkContext._gateway.new_array(jvm.Options.Rename, 0)  # do not overwrite
        try:
            context.rename(self._files.makeQualified(temporary), self._files.makeQualified(final), no_options)
        except Exception as failed:
            self._files.delete(temporary, False)
            if self._files.exists(final):
                raise CommitConflict(f"commit {after.number} of {self.path} is there already") from failed
            raise
        return after

    def replace(self, rows: DataFrame, part: str, value, source: str | None = None, batch: int | None = None) -> Commit:
        """Replace one part by ``rows`` (which may be none)."""
        before = self.state()
        name = f"{part}={value}"
        version = self.stage(rows, part)
        others = [p for p in self.staged(version) if p != name]
        if others:
            raise ValueError(f"rows of {others[:3]} given for {name}")
        return self.commit(before, version, [name], source, batch)

    def vacuum(self) -> list[str]:
        """Delete the versions that the last commit does not name; only while nobody writes or reads older states."""
        used = set(self.state().parts.values())
        unused = [n for n in self._names("data") if n.startswith("v=") and n[2:] not in used]
        for name in unused:
            self._files.delete(self._at(f"data/{name}"), True)
        return unused

    def drop(self) -> None:
        """Delete the whole table."""
        self._files.delete(self._folder, True)
