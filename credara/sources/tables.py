"""Catalog tables: namespaces, full refresh of one or several tables at once, append, presence check and audit."""

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, types as T

from credara.operators import integrity
from credara.operators.integrity import row_counts
from credara.schemas import TABLES
from credara.sources import footers


class BrokenConstraints(RuntimeError):
    """A load that breaks keys, references or required columns; ``rows`` says which (check, table, column, rows)."""

    def __init__(self, rows: list[tuple]):
        super().__init__("not published: " + "; ".join(f"{check} {table}.{column}: {n}" for check, table, column, n in rows))
        self.rows = rows


class Overlap(RuntimeError):
    """Another load has published since this one began."""


class Staged:
    """Tables of one load, written but not visible until ``publish``."""

    def __init__(self, catalog: "Catalog"):
        self.catalog, self.base, self.entries = catalog, catalog.version(), {}

    def save(self, table: str, df: DataFrame) -> DataFrame:
        """Write the new rows of ``table`` to a folder of their own and return them read back."""
        folder = f"{self.catalog.root}/{table.replace('.', '/')}/{uuid.uuid4().hex}"
        df.write.parquet(folder)
        self.entries[table] = {"folder": folder, "schema": df.schema.json()}
        return self.read(table)

    def read(self, table: str) -> DataFrame:
        return self.catalog.read_entry(self.entries[table])

    def check(self) -> None:
        """Audit the tables as they would be after publishing; constraints are those the model declares."""
        entries = self.catalog.manifest(self.base) | self.entries
        broken = integrity.enforced({t: self.catalog.read_entry(e) for t, e in entries.items() if t in TABLES})
        rows = [tuple(r) for r in broken.collect()]    # one row a constraint at most
        if rows:
            raise BrokenConstraints(rows)

    def publish(self, enforce: bool = False) -> None:
        """Make all tables visible at once. With ``enforce``, tables that break a constraint are not published.

        The switch is one manifest file that appears by a rename. Should another load have published since this one
        began, the rename finds its number taken and this load is refused. Table names of the session follow; a
        session that stops in between is set right by ``Catalog.recover``.
        """
        if enforce:
            self.check()
        self.catalog.write_manifest(self.base + 1, self.catalog.manifest(self.base) | self.entries)
        for table in self.entries:
            self.catalog.point(table)


class Catalog:
    """External Parquet tables below ``root``, a folder every executor shares.

    A load writes its rows to new folders; a manifest that names the folder of every table then switches all of them
    together (write, audit, publish). ``read`` goes by the manifest: it sees a load whole or not at all, and a failed
    load leaves everything in place.

    ``prefix`` goes in front of every namespace, so that several loads can live in one catalog.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        self.spark, self.root, self.prefix = spark, root.rstrip("/"), prefix

    def full_name(self, table: str) -> str:
        return f"{self.prefix}{table}"

    def create_namespace(self, name: str) -> None:
        # a folder of its own: dropping a namespace deletes its folder, and must not delete published rows
        folder = f"{self.root}/_namespaces/{self.full_name(name)}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.full_name(name)} LOCATION '{folder}'")

    def create_all(self) -> None:
        """Namespaces and empty tables of the declared schemas, where missing."""
        for table, schema in TABLES.items():
            if not self.exists(table):
                self.save(table, self.spark.createDataFrame([], schema))

    def _manifests(self):
        """Hadoop's path of the manifests' folder and its file system."""
        jvm = self.spark._jvm
        home = jvm.org.apache.hadoop.fs.Path(f"{self.root}/_manifest/{self.prefix or '-'}")
        return home, home.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def version(self) -> int:
        """Number of the last manifest, 0 if there is none."""
        home, files = self._manifests()
        if not files.exists(home):
            return 0
        names = [s.getPath().getName() for s in files.listStatus(home)]
        return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=0)

    def manifest(self, version: int | None = None) -> dict[str, dict]:
        """Folder and schema of every table, as last published or at an earlier version."""
        version = self.version() if version is None else version
        if not version:
            return {}
        home, files = self._manifests()
        stream = files.open(self.spark._jvm.org.apache.hadoop.fs.Path(home, f"{version:012d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write_manifest(self, version: int, entries: dict[str, dict]) -> None:
        jvm = self.spark._jvm
        home, files = self._manifests()
        new, target = (jvm.org.apache.hadoop.fs.Path(home, n) for n in (f"new-{uuid.uuid4().hex}", f"{version:012d}.json"))
        out = files.create(new, False)
        out.write(bytearray(json.dumps(entries, indent=1).encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(home.toUri(), self.spark._jsc.hadoopConfiguration())
        how = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(files.makeQualified(new), files.makeQualified(target), how)
        except Exception as taken:
            files.delete(new, False)
            raise Overlap(f"another load has published version {version} of {self.root}") from taken

    def read_entry(self, entry: dict) -> DataFrame:
        return self.spark.read.schema(T.StructType.fromJson(json.loads(entry["schema"]))).parquet(entry["folder"])

    def stage(self) -> Staged:
        """Begin a load of several tables."""
        return Staged(self)

    def recover(self) -> None:
        """Point the session's table names at what the manifest says."""
        for table in self.manifest():
            self.point(table)

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.full_name(table))

    def missing(self, required: list[str] | None = None) -> list[str]:
        return [t for t in (required or TABLES) if not self.exists(t)]

    def save(self, table: str, df: DataFrame) -> DataFrame:
        """Create or replace ``table`` with the rows of ``df`` and return it read back. Refreshes of single tables may
        overlap: they follow one another."""
        staged = self.stage()
        saved = staged.save(table, df)
        while True:
            try:
                staged.base = self.version()
                staged.publish()
                return saved
            except Overlap:
                continue

    def point(self, table: str) -> None:
        """Let the name of ``table`` stand for its published folder."""
        entry, name = self.manifest()[table], self.full_name(table)
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        self.create_namespace(table.split(".")[0])
        if self.exists(table) and [f.dataType for f in self.spark.table(name).schema] == [f.dataType for f in schema] \
                and self.spark.table(name).columns == schema.fieldNames():
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{entry['folder']}'")
        else:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            self.spark.catalog.createTable(name, path=entry["folder"], source="parquet", schema=schema)
        self.spark.catalog.refreshTable(name)

    def expire(self, table: str) -> None:
        """Delete the folders of earlier refreshes. Queries that still read them fail."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        rows = self.spark.sql(f"DESCRIBE FORMATTED {self.full_name(table)}").where("col_name = 'Location'").collect()
        current = rows[0].data_type.rstrip("/").rsplit("/", 1)[-1]
        home = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{table.replace('.', '/')}")
        files = home.getFileSystem(conf)
        for status in files.listStatus(home):
            if status.getPath().getName() != current:
                files.delete(status.getPath(), True)

    def append(self, table: str, df: DataFrame) -> None:
        """Insert by position."""
        df.write.insertInto(self.full_name(table))

    def read(self, table: str) -> DataFrame:
        """As published; a table made by other means goes by its name."""
        entry = self.manifest().get(table)
        return self.read_entry(entry) if entry else self.spark.table(self.full_name(table))

    def read_all(self) -> dict[str, DataFrame]:
        published = self.manifest()
        return {t: self.read(t) for t in TABLES if t in published or self.exists(t)}

    def truncate_all(self) -> None:
        """Replace every known table by an empty one."""
        for table in TABLES:
            if self.exists(table):
                self.save(table, self.read(table).limit(0))

    def drop(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.full_name(table)}")
        entries = self.manifest()
        if entries.pop(table, None):
            self.write_manifest(self.version() + 1, entries)

    def drop_namespace(self, name: str) -> None:
        """Forget the names; published rows can still be read through the manifest."""
        self.spark.sql(f"DROP DATABASE IF EXISTS {self.full_name(name)} CASCADE")

    def drop_namespaces(self) -> None:
        for name in sorted({t.split(".")[0] for t in TABLES}):
            self.drop_namespace(name)

    def audit(self) -> DataFrame:
        """(tabla, filas) of every known table: published ones by the footers of their files, others by a scan."""
        published = {t: (T.StructType.fromJson(json.loads(e["schema"])), e["folder"])
                     for t, e in self.manifest().items() if t in TABLES}
        others = {t: df for t, df in self.read_all().items() if t not in published}
        counts = footers.row_counts(self.spark, published)
        audited = self.spark.createDataFrame(list(counts.items()), "tabla string, filas bigint")
        return audited.unionByName(row_counts(others)) if others else audited
