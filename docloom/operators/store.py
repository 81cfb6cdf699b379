"""The index tables as versioned snapshots: staged, checked, and published together by one pointer."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.config import Config, checked_version
from docloom.errors import InputError, SchemaMismatch, WriteError
from docloom.operators import index

_S = T.StringType()
PARENTS = T.StructType([T.StructField(c, T.IntegerType() if c == "token_count" else _S) for c in index.PARENT_COLUMNS])
CHILDREN = T.StructType([T.StructField(c, T.IntegerType() if c == "token_count" else T.ArrayType(T.FloatType()) if c == "embedding" else _S) for c in index.CHILD_COLUMNS])


def schema_faults(df: DataFrame, wanted: T.StructType) -> list[str]:
    """Columns that are missing, of another type, or not foreseen."""
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    need = {f.name: f.dataType.simpleString() for f in wanted}
    out = [f"missing {c}" for c in need if c not in have] + [f"unforeseen {c}" for c in have if c not in need]
    return out + [f"{c} is {have[c]}, not {need[c]}" for c in need if c in have and have[c] != need[c]]


class IndexStore:
    """Parents and children of every version. A version is one folder for each table; the pointer says which.

    A write stages the version's folders, checks them, and then replaces the pointer by a rename: readers see both
    tables before or after it, other versions' files aren't touched, and a failure before it changes nothing.
    """

    def __init__(self, spark: SparkSession, root: str, config: Config = Config()):
        self.spark, self.root, self.config = spark, root.rstrip("/"), config
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def pointer(self) -> dict[str, dict[str, str]]:
        p = self._path(f"{self.root}/CURRENT.json")
        if not self._fs.exists(p):
            return {"parents": {}, "children": {}}
        stream = self._fs.open(p)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _publish(self, pointer: dict) -> None:
        fresh = self._path(f"{self.root}/CURRENT-{uuid.uuid4().hex}.json")
        stream = self._fs.create(fresh)
        stream.write(bytearray(json.dumps(pointer, sort_keys=True).encode()))
        stream.close()
        final = self._path(f"{self.root}/CURRENT.json")
        context = self.spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri())
        rename = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context.rename(self._fs.makeQualified(fresh), self._fs.makeQualified(final), options)

    def _read(self, name: str, schema: T.StructType, versions: list[str] | None = None) -> DataFrame:
        paths = [f"{self.root}/{p}" for v, p in self.pointer()[name].items() if versions is None or v in versions]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def parents(self, *versions: str) -> DataFrame:
        return self._read("parents", PARENTS, [*versions] or None)

    def children(self, *versions: str) -> DataFrame:
        return self._read("children", CHILDREN, [*versions] or None)

    def write(self, parents: DataFrame, children: DataFrame, version: str, mode: str, before_publish: Callable[[], None] | None = None, chunks: DataFrame | None = None) -> DataFrame:
        """Make these the rows of ``version``; returns (table, change, n).

        ``mode`` is update, which needs the model of the whole table, or rebuild, which needs that of other versions.
        Inputs are checked before anything is staged; ``chunks``, the children before embedding, are held against their
        vector rows. An id that another version holds is refused. A pointer that another writer has replaced in the
        meantime is an error, and nothing is published.
        """
        if mode not in ("update", "rebuild"):
            raise InputError("mode must be update or rebuild")
        checked_version(version)
        for df, schema in ((parents, PARENTS), (children, CHILDREN)):
            if faults := schema_faults(df, schema):
                raise SchemaMismatch("; ".join(faults))
        parents, children = parents.select(*index.PARENT_COLUMNS), children.select(*index.CHILD_COLUMNS)
        if found := index.violations(parents, children, version, self.config, chunks).limit(20).collect():
            raise InputError("; ".join(f"{r.rule}: {r.key}" for r in found))
        if parents.isEmpty():
            raise InputError(f"no rows for {version}")
        pointer = self.pointer()
        others = [v for v in pointer["parents"] if v != version]
        index.guard(self.children(), children, version, mode)
        if others:
            for mine, theirs, key in ((parents, self.parents(*others), "parent_id"), (children, self.children(*others), "chunk_id")):
                taken = mine.select(key).join(theirs.select(key), key, "left_semi").limit(3).collect()
                if taken:
                    raise InputError(f"{taken[0][0]} belongs to another version")
        stage = uuid.uuid4().hex
        new = {"parents": f"parents/{stage}", "children": f"children/{stage}"}
        counts = []
        old = {"parents": self.parents(version) if version in pointer["parents"] else self.spark.createDataFrame([], PARENTS), "children": self.children(version) if version in pointer["children"] else self.spark.createDataFrame([], CHILDREN)}
        for name, rows, key, columns in (("parents", parents, "parent_id", index.PARENT_COLUMNS[1:]), ("children", children, "chunk_id", index.CHILD_COLUMNS[1:])):
            written = Observation()
            rows.observe(written, F.count(F.lit(1)).alias("n")).write.parquet(f"{self.root}/{new[name]}")
            staged = self.spark.read.schema(rows.schema).parquet(f"{self.root}/{new[name]}")
            changes = index.classify(old[name], staged, [key], columns).groupBy("change").count().collect()
            by = {r["change"]: r["count"] for r in changes}
            if mode == "rebuild":
                by = {"inserted": staged.count(), "deleted_before": old[name].count()}
            if staged.count() != written.get["n"]:
                raise WriteError(f"{name}: not all rows were staged")
            counts += [(name, change, int(n)) for change, n in sorted(by.items())]
        if before_publish:
            before_publish()
        if self.pointer() != pointer:
            raise WriteError("another writer has published in the meantime")
        self._publish({t: {**pointer[t], version: new[t]} for t in new})
        return self.spark.createDataFrame(counts, "table string, change string, n long")
