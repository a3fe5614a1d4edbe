"""What a warehouse holds, generation by generation, on its own storage.

A record names the folder of every table and of every month of facts. A change
writes its folders first and then one record, renamed into place under the next
number; that rename is the change. The catalog follows: whoever finds it behind
the newest record brings it up to date, after a driver was lost half-way too, or
in a catalog that has never seen the tables. Folders that no record names belong
to changes that never were.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import SparkSession

FOLDER = "_journal"
PROPERTY = "landfall.generation"
# Records that stay for the eye; only the newest counts.
KEPT_RECORDS = 20
_RECORD = re.compile(r"^generation-(\d{12})\.json$")


class Conflict(RuntimeError):
    """Another writer has committed the generation that this one wanted."""


@dataclass(frozen=True)
class Month:
    """Where a month's facts lie, the partial files in them, and where its codes are counted."""

    folder: str
    batches: tuple[str, ...] = ()
    codes: str = ""


@dataclass(frozen=True)
class Record:
    generation: int = 0
    tables: dict[str, str] = field(default_factory=dict)
    months: dict[tuple[int, int], Month] = field(default_factory=dict)

    def folders(self) -> set[str]:
        return {*self.tables.values(), *(m.folder for m in self.months.values())}

    def to_json(self) -> str:
        months = [{"year": y, "month": m, **asdict(v)} for (y, m), v in sorted(self.months.items())]
        return json.dumps({"generation": self.generation, "tables": self.tables, "months": months}, indent=1)

    @classmethod
    def from_json(cls, text: str) -> Record:
        raw = json.loads(text)
        months = {
            (m["year"], m["month"]): Month(m["folder"], tuple(m["batches"]), m.get("codes", ""))
            for m in raw["months"]
        }
        return cls(raw["generation"], raw["tables"], months)


class Journal:
    """The records of one database, in a folder beside its tables."""

    def __init__(self, spark: SparkSession, database: str):
        self.spark, self.database = spark, database
        described = spark.sql(f"DESCRIBE DATABASE EXTENDED `{database}`").collect()
        facts = {r["info_name"]: r["info_value"] for r in described}
        self.home = facts["Location"]
        found = re.search(rf"\({re.escape(PROPERTY)},(\d+)\)", facts.get("Properties") or "")
        #: The generation that the catalog has.
        self.in_catalog = int(found[1]) if found else 0
        self.folder = f"{self.home}/{FOLDER}"
        self._jvm = spark._jvm
        self._hadoop = spark._jsc.hadoopConfiguration()
        self._files = self._path(self.home).getFileSystem(self._hadoop)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        if not self._files.exists(path):
            return []
        return [status.getPath().getName() for status in self._files.listStatus(path)]

    def newest(self) -> Record:
        """The last record; an empty one of generation 0 where there is none."""
        numbers = [m[1] for m in map(_RECORD.match, self._names(self.folder)) if m]
        return self._read(int(max(numbers))) if numbers else Record()

    def _record_name(self, generation: int) -> str:
        return f"{self.folder}/generation-{generation:012d}.json"

    def _read(self, generation: int) -> Record:
        stream = self._files.open(self._path(self._record_name(generation)))
        try:
            return Record.from_json(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, base: Record, change: Record) -> Record:
        """Make ``change`` the generation after ``base``, or raise ``Conflict``.

        The record is complete before it gets its name, and the rename refuses a
        name that is taken.
        """
        made = replace(change, generation=base.generation + 1)
        draft = self._path(f"{self.folder}/draft-{uuid.uuid4().hex}")
        stream = self._files.create(draft, False)
        try:
            stream.write(bytearray(made.to_json().encode()))
        finally:
            stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._path(self.home).toUri(), self._hadoop
        )
        none = self._spark_array(0)
        try:
            context.rename(draft, self._path(self._record_name(made.generation)), none)
        except Exception as error:
            self._files.delete(draft, False)
            if "FileAlreadyExists" in str(error):
                raise Conflict(f"generation {made.generation} of {self.database} is there") from error
            raise
        return made

    def _spark_array(self, size: int):
        gateway = self.spark.sparkContext._gateway
        return gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, size)

    def mark(self, generation: int) -> None:
        """Note in the catalog that it has a generation."""
        self.spark.sql(
            f"ALTER DATABASE `{self.database}` SET DBPROPERTIES ('{PROPERTY}' = '{generation}')"
        )
        self.in_catalog = generation

    def new_folder(self, name: str) -> str:
        return f"{self.home}/{name.lower()}-{uuid.uuid4().hex[:12]}"

    def orphans(self, record: Record, names: Iterable[str]) -> list[str]:
        """Folders made by ``new_folder`` for tables of these names that a record lacks."""
        wanted = "|".join(re.escape(n.lower()) for n in names)
        pattern = re.compile(rf"^(?:{wanted})-[0-9a-f]{{12}}$")
        used = {self._below_home(f) for f in record.folders()}
        return [f"{self.home}/{n}" for n in self._names(self.home) if pattern.match(n) and n not in used]

    def replaced(self, before: Record, after: Record) -> list[str]:
        """What can be deleted once ``after`` holds: whole folders where nothing in them counts."""
        used = {self._below_home(f) for f in after.folders()}
        gone = before.folders() - after.folders()
        tops = {f: self._below_home(f) for f in gone}
        return sorted({f if top in used else f"{self.home}/{top}" for f, top in tops.items()})

    def _below_home(self, folder: str) -> str:
        """The name beside the tables that a folder lies in."""
        home = self._path(self.home).toUri().getPath().rstrip("/")
        path = self._path(folder).toUri().getPath()
        return path.removeprefix(f"{home}/").split("/")[0]

    def tidy(self) -> None:
        """Delete drafts and all but the last records."""
        names = sorted(self._names(self.folder))
        records = [n for n in names if _RECORD.match(n)]
        for name in [n for n in names if n.startswith("draft-")] + records[:-KEPT_RECORDS]:
            self._files.delete(self._path(f"{self.folder}/{name}"), False)
