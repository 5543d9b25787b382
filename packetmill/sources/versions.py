"""Versioned tables in hash buckets: a batch reads and writes only the buckets that it touches, and one small file publishes it.

Below a folder, ``data/<table>/<part>/bucket=<b>`` holds rows, never changed once written, and ``versions/<n>.json`` says for every
table which parts make up each bucket. A version appears by one rename, so that readers see all tables of a batch or none,
and a driver that dies before that leaves parts that nothing names. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Collection, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .tables import bucket_of, touched_buckets

#: Parts of a bucket, beyond which an append writes the bucket anew.
MOST_PARTS = 16
#: Tables that are written at the same time.
AT_ONCE = 4


class Versions:
    """The tables below a folder; see the module. Buckets are hashes of one key column a table."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    @classmethod
    def create(cls, spark: SparkSession, folder: str, tables: Mapping[str, DataFrame], keys: Mapping[str, str], buckets: int = 64, gather: bool = True) -> Versions:
        """Write version -1 of the tables, each in ``buckets`` buckets of its key; a folder that has a version already is left as it is. ``gather``: see ``commit``."""
        self = cls(spark, folder)
        if self.numbers():
            return self
        made = {name: {"key": keys[name], "buckets": buckets, "schema": df.schema.jsonValue(), "parts": {}} for name, df in tables.items()}
        for name, (part, found) in self._write_all(tables, made, -1, gather).items():
            made[name]["parts"] = {b: [part] for b in found}
        self._publish(-1, {"tables": made, "notes": {}})
        return self

    # --- versions

    def _names(self, path: str) -> list[str]:
        at = self._path(path)
        return [x.getPath().getName() for x in self._files.listStatus(at)] if self._files.exists(at) else []

    def numbers(self) -> list[int]:
        return sorted(int(x.removesuffix(".json")) for x in self._names(f"{self.folder}/versions") if x.endswith(".json") and not x.startswith("."))

    def manifest(self, number: int | None = None) -> dict:
        """The contents of a version, by default the newest."""
        number = self.numbers()[-1] if number is None else number
        held = self._files.open(self._path(f"{self.folder}/versions/{number}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(held, "UTF-8"))
        finally:
            held.close()

    def _publish(self, number: int, manifest: dict) -> None:
        draft = self._path(f"{self.folder}/versions/.{number}-{uuid.uuid4().hex}")
        out = self._files.create(draft, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if not self._files.rename(draft, self._path(f"{self.folder}/versions/{number}.json")):
            raise OSError(f"version {number} of {self.folder} is there already or cannot be written")

    # --- rows

    def touched(self, name: str, keys: DataFrame) -> list[int]:
        """Buckets of a table that the one column of ``keys`` falls into; at most as many as the table has."""
        entry = self.manifest()["tables"][name]
        return sorted(r.bucket for r in touched_buckets(keys, keys.columns, entry["buckets"]).collect())

    def read(self, name: str, buckets: Iterable[int] | None = None, number: int | None = None) -> DataFrame:
        """Rows of a table, of the given buckets only: folders of other buckets are not listed or opened."""
        entry = self.manifest(number)["tables"][name]
        wanted = sorted(entry["parts"], key=int) if buckets is None else [str(b) for b in buckets]
        paths = [f"{self.folder}/data/{name}/{part}/bucket={b}" for b in wanted for part in entry["parts"].get(b, ())]
        schema = T.StructType.fromJson(entry["schema"])
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _write(self, name: str, df: DataFrame, entry: dict, number: int, gather: bool = True) -> tuple[str, list[str]]:
        """Write rows as a new part; its name and the buckets it has. Where plans adapt, a large bucket is written by several tasks.

        Rows that are not gathered are not moved again: every task writes a file for each bucket of its rows.
        """
        part = f"{number}-{uuid.uuid4().hex}"
        path = f"{self.folder}/data/{name}/{part}"
        columns = [f["name"] for f in entry["schema"]["fields"]]
        rows = df.select(*columns, bucket_of([entry["key"]], entry["buckets"]).alias("bucket"))
        (rows.hint("rebalance", "bucket") if gather else rows).write.partitionBy("bucket").parquet(path)
        return part, [x.removeprefix("bucket=") for x in self._names(path) if x.startswith("bucket=")]

    def _write_all(self, tables: Mapping[str, DataFrame], entries: Mapping[str, dict], number: int, gather: bool = True) -> dict[str, tuple[str, list[str]]]:
        """``_write`` of several tables, a few at a time: one small table leaves most of a cluster idle."""
        with ThreadPoolExecutor(AT_ONCE) as pool:
            jobs = {name: pool.submit(self._write, name, df, entries[name], number, gather) for name, df in tables.items()}
            return {name: job.result() for name, job in jobs.items()}

    def commit(self, number: int, replace: Mapping[str, tuple[DataFrame, Collection[int]]] | None = None, append: Mapping[str, DataFrame] | None = None, notes: dict | None = None, keep: int = 2, gather: bool = True) -> None:
        """Publish version ``number``: in ``replace`` the given buckets get exactly the given rows, in ``append`` rows are added.

        Versions but the last ``keep`` are retired, with the parts that only they name. ``gather`` brings the rows of a bucket
        together before they are written; a caller whose rows lie in few tasks for their size can do without.
        """
        now = self.manifest()
        tables = json.loads(json.dumps(now["tables"]))
        replace, append = replace or {}, append or {}
        written = self._write_all({**{name: df for name, (df, _) in replace.items()}, **append}, tables, number, gather) if not replace.keys() & append.keys() else None
        for name, (df, buckets) in replace.items():
            entry = tables[name]
            part, found = written[name] if written else self._write(name, df, entry, number, gather)
            if set(map(int, found)) - set(buckets):
                raise ValueError(f"rows of {name} fall into buckets that were not read")
            for b in buckets:
                entry["parts"].pop(str(b), None)
            entry["parts"] |= {b: [part] for b in found}
        for name, df in append.items():
            entry = tables[name]
            part, found = written[name] if written else self._write(name, df, entry, number, gather)
            for b in found:
                entry["parts"].setdefault(b, []).append(part)
            full = [b for b in found if len(entry["parts"][b]) > MOST_PARTS]
            if full:
                paths = [f"{self.folder}/data/{name}/{p}/bucket={b}" for b in full for p in entry["parts"][b]]
                part, _ = self._write(name, self.spark.read.schema(T.StructType.fromJson(entry["schema"])).parquet(*paths), entry, number)
                entry["parts"] |= {b: [part] for b in full}
        self._publish(number, {"tables": tables, "notes": now["notes"] | (notes or {})})
        self._retire(keep)

    # --- steps of a batch

    def scratch(self) -> Callable[..., DataFrame]:
        """A function that writes a step of a batch, parted by the given columns, and returns what is there: later steps read it in place of computing it."""

        def settle(df: DataFrame, *parted: str) -> DataFrame:
            path = f"{self.folder}/scratch/{uuid.uuid4().hex}"
            (df.write.partitionBy(*parted) if parted else df.write).parquet(path)
            return self.spark.read.schema(df.schema).parquet(path)

        return settle

    def drop_scratch(self) -> None:
        """Delete the steps, once a version is published."""
        self._files.delete(self._path(f"{self.folder}/scratch"), True)

    def _retire(self, keep: int) -> None:
        *old, = self.numbers()[:-keep]
        if not old:
            return
        kept = [self.manifest(n)["tables"] for n in self.numbers()[-keep:]]
        for n in old:
            self._files.delete(self._path(f"{self.folder}/versions/{n}.json"), False)
        for name in kept[-1]:
            held = {(part, b) for tables in kept for b, parts in tables[name]["parts"].items() for part in parts}
            for part in self._names(f"{self.folder}/data/{name}"):
                here = [x.removeprefix("bucket=") for x in self._names(f"{self.folder}/data/{name}/{part}") if x.startswith("bucket=")]
                gone = [b for b in here if (part, b) not in held]
                if len(gone) == len(here):
                    self._files.delete(self._path(f"{self.folder}/data/{name}/{part}"), True)
                for b in gone if len(gone) < len(here) else ():
                    self._files.delete(self._path(f"{self.folder}/data/{name}/{part}/bucket={b}"), True)
