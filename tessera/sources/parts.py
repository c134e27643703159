"""Tables in parts by a hash of their key, under one folder with a manifest; a commit replaces some parts and leaves the others as they are.

Each commit writes its parts under a version of its own, then the manifest, which names the version of every part, and renames it into its place: readers see the old tables or
the new ones.  A commit that was stopped before the rename left a version that no manifest names; the next one writes over it.  One writer at a time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Tasks that the rows of one part are dealt to when it is written, by their ids: a page may hold very many.
SPREAD = 4


class Parts:
    """root: a URI or path that the driver and all executors reach; n: the number of parts, fixed by the first commit."""

    def __init__(self, spark: SparkSession, root: str, n: int = 64):
        from pyarrow import fs

        self.spark, self.root = spark, root if ":/" in root else f"file://{root}"
        self.store, self.path = fs.FileSystem.from_uri(self.root)
        self.state = self._latest() or {"version": -1, "n": n, "tables": {}}

    def _latest(self) -> dict | None:
        from pyarrow import fs

        found = self.store.get_file_info(fs.FileSelector(f"{self.path}/manifests", allow_not_found=True))
        last = max((f.path for f in found if f.base_name.endswith(".json") and not f.base_name.startswith(".")), default=None)
        return json.loads(self.store.open_input_file(last).read()) if last else None

    @property
    def version(self) -> int:
        return self.state["version"]

    def part(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(self.state["n"])).cast("int")

    def read(self, name: str, empty: T.StructType | None = None, parts: list[int] | None = None) -> DataFrame:
        """A table, or only some of its parts; where it has no rows, none with the columns of ``empty``."""
        table = self.state["tables"].get(name)
        folders = [f"{self.root}/{v}/{name}/part={p}" for p, v in (table["parts"] if table else {}).items() if parts is None or int(p) in parts]
        if not folders:
            return self.spark.createDataFrame([], T.StructType.fromJson(table["schema"]) if table else empty)
        return self.spark.read.schema(T.StructType.fromJson(table["schema"])).parquet(*folders)

    def commit(self, tables: dict[str, tuple[DataFrame, Column, Column]], touched: list[int]) -> int:
        """Replaces the touched parts of each table by its (rows, key of the part, id of the row); the version's number."""
        from pyarrow import fs

        number = self.version + 1
        folder = f"v{number:08d}"
        state = {"version": number, "n": self.state["n"], "tables": dict(self.state["tables"])}
        for name, (rows, key, ident) in tables.items():
            dealt = rows.withColumn("part", self.part(key)).repartition("part", F.pmod(F.xxhash64(ident.cast("string")), F.lit(SPREAD)))
            dealt.write.mode("overwrite").partitionBy("part").parquet(f"{self.root}/{folder}/{name}")
            there = {f.base_name.split("=")[1] for f in self.store.get_file_info(fs.FileSelector(f"{self.path}/{folder}/{name}")) if f.base_name.startswith("part=")}
            if stray := there - set(map(str, touched)):
                raise ValueError(f"rows of parts {sorted(stray)}, which this commit doesn't replace")
            old = self.state["tables"].get(name, {"parts": {}})["parts"]
            state["tables"][name] = {"schema": rows.schema.jsonValue(), "parts": {p: v for p, v in old.items() if int(p) not in touched} | dict.fromkeys(sorted(there, key=int), folder)}
        self.store.create_dir(f"{self.path}/manifests", recursive=True)
        draft = f"{self.path}/manifests/.{uuid.uuid4().hex}"
        with self.store.open_output_stream(draft) as f:
            f.write(json.dumps(state).encode())
        self.store.move(draft, f"{self.path}/manifests/{number:08d}.json")
        self.state = state
        return number
