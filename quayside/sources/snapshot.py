"""Loads of several tables as one transaction: versioned folders and one manifest that names the current ones.

Every load writes new folders next to the old ones and, when all its tables have passed, one new manifest, which is put in
place by a rename. Readers look up the newest manifest, so they see all tables of a load or none of them; a load that
fails leaves the manifest, and with it the old state of every table, and its own folders are deleted. Of two loads
that run at once, the second one to end fails, because its manifest's number is taken.

Rows are counted and the column rules (NOT NULL, lengths, CHECKs) are evaluated while the rows are stored, by an observation on the
write; only the foreign keys take another pass, over their columns alone.
"""

from __future__ import annotations

import json
import logging
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quayside.operators import constraints
from quayside.schema import TABLES, Table
from quayside.session import _file_system, drop_path, path_exists
from quayside.sources.csv_load import ConstraintError, Loaded, read_csv

log = logging.getLogger(__name__)
_ROWS, _HIGHEST = "rows", "highest key"


class ConflictError(RuntimeError):
    """Raised when another load was committed meanwhile; nothing of this one is visible."""


@dataclass(frozen=True)
class Version:
    """A stored version of a table."""

    path: str
    rows: int
    highest_key: int


def rule_counts(spec: Table) -> dict[str, Column]:
    """Rows that break each column rule of a table, by 'kind rule'."""
    counts = {f"not_null {c}": F.count_if(F.col(c).isNull()) for c in spec.required}
    counts |= {f"max_length {c} <= {n}": F.count_if(F.char_length(c) > n) for c, n in spec.lengths.items()}
    return counts | {f"check {name}": F.count_if(~F.expr(rule)) for name, rule in spec.checks.items()}


def loading_session(spark: SparkSession) -> SparkSession:
    """A session with the same settings for observed writes.

    A session that has observed anything holds a manager that cannot be serialized, and models of random forests take
    their session along to the executors.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    return own


def store_observed(rows: DataFrame, spec: Table, path: str) -> tuple[int, int, dict[str, int]]:
    """Writes the rows; returns their number, the highest key and how many break each column rule, all from that one pass."""
    seen = Observation()
    measured = {_ROWS: F.count(F.lit(1)), _HIGHEST: F.coalesce(F.max(spec.key), F.lit(0)), **rule_counts(spec)}
    observed = rows.select(*spec.schema.names).observe(seen, *(c.alias(name) for name, c in measured.items()))
    observed.write.parquet(path)
    found = dict(seen.get)
    return found.pop(_ROWS) or 0, found.pop(_HIGHEST) or 0, {rule: n for rule, n in found.items() if n}


class Snapshot:
    """The tables below ``root``: data/<table>/<version> and manifests/<number>.json."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # -- manifests -----------------------------------------------------------------------------

    def _numbers(self) -> list[int]:
        folder = f"{self.root}/manifests"
        if not path_exists(self.spark, folder):
            return []
        system, path = _file_system(self.spark, folder)
        names = (str(s.getPath().getName()) for s in system.listStatus(path))
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def _manifest(self, number: int) -> dict[str, Version]:
        path = f"{self.root}/manifests/{number:010d}.json"
        text = self.spark.read.text(path, wholetext=True).first()[0]
        return {table: Version(**v) for table, v in json.loads(text).items()}

    def state(self) -> tuple[int, dict[str, Version]]:
        """Number of the newest manifest (0 if none) and its versions."""
        numbers = self._numbers()
        return (numbers[-1], self._manifest(numbers[-1])) if numbers else (0, {})

    def _commit(self, number: int, versions: dict[str, Version]) -> None:
        """Puts a manifest in place: written beside, then renamed, which fails where the name is taken."""
        final, beside = f"{self.root}/manifests/{number:010d}.json", f"{self.root}/manifests/_{uuid.uuid4().hex}"
        system, target = _file_system(self.spark, final)
        _, source = _file_system(self.spark, beside)
        stream = system.create(source, False)
        stream.write(bytearray(json.dumps({t: vars(v) for t, v in versions.items()}).encode()))
        stream.close()
        if system.exists(target) or not system.rename(source, target):
            system.delete(source, False)
            raise ConflictError(f"{final} exists: another load was committed meanwhile")

    # -- reading -------------------------------------------------------------------------------

    def tables(self, versions: dict[str, Version] | None = None) -> dict[str, DataFrame]:
        """The tables of the newest manifest, or of given versions; those never loaded are missing."""
        versions = self.state()[1] if versions is None else versions
        return {name: self._read(name, v) for name, v in versions.items()}

    def _read(self, table: str, version: Version) -> DataFrame:
        return self.spark.read.schema(TABLES[table].schema).parquet(version.path)

    def register(self, database: str) -> None:
        """Points the catalog's tables at the newest versions, as external tables; empty ones where nothing was loaded."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        _, versions = self.state()
        for spec in TABLES.values():
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spec.schema.fields)
            place = f" LOCATION '{versions[spec.name].path}'" if spec.name in versions else ""
            self.spark.sql(f"DROP TABLE IF EXISTS {database}.{spec.name}")
            self.spark.sql(f"CREATE TABLE {database}.{spec.name} ({columns}) USING parquet{place}")

    # -- loading -------------------------------------------------------------------------------

    def load(
        self, data_dir: str, table: str | Sequence[str] = "all", mode: str = "overwrite", loaded_at: Column | None = None
    ) -> list[Loaded]:
        """Loads ``<data_dir>/<table>.csv`` of one, some or all tables, parents first; all of them or none.

        Tables without a file are skipped. ``append`` keeps the rows of before and goes on counting their keys. Foreign
        keys are checked against this load's own tables where it has them, else against the current ones.
        """
        names = list(TABLES) if table == "all" else [table] if isinstance(table, str) else list(table)
        if unknown := [n for n in names if n not in TABLES]:
            raise ValueError(f"unknown tables {unknown}; known: {', '.join(TABLES)}")
        number, versions = self.state()
        load_id, results, written, session = uuid.uuid4().hex, [], [], loading_session(self.spark)
        try:
            for spec in (TABLES[n] for n in TABLES if n in names):
                start = time.monotonic()
                before = versions.get(spec.name) if mode == "append" else None
                try:
                    rows = read_csv(session, spec.name, f"{data_dir}/{spec.name}.csv", loaded_at, (before.highest_key if before else 0) + 1)
                except AnalysisException as error:
                    if error.getCondition() != "PATH_NOT_FOUND":
                        raise
                    log.warning("no file for table %s in %s, skipped", spec.name, data_dir)
                    continue
                if before:
                    earlier = session.read.schema(spec.schema).parquet(before.path)
                    rows = earlier.unionByName(rows.select(*spec.schema.names))
                path = f"{self.root}/data/{spec.name}/{load_id}"
                written.append(path)
                n, highest, broken = store_observed(rows, spec, path)
                versions[spec.name] = Version(path, n, highest)
                self._check_parents(spec, versions, broken)
                if broken:
                    raise ConstraintError(f"{spec.name}: " + ", ".join(f"{rule} ({k} rows)" for rule, k in broken.items()))
                results.append(Loaded(spec.name, n - (before.rows if before else 0), time.monotonic() - start))
            if results:
                self._commit(number + 1, versions)
        except BaseException:
            for path in written:
                drop_path(self.spark, path)
            raise
        for x in results:
            log.info("%s: %d rows loaded in %.1f s", x.table, x.rows, x.seconds)
        return results

    def _check_parents(self, spec: Table, versions: dict[str, Version], broken: dict[str, int]) -> None:
        """Adds the foreign keys that point nowhere; a parent that was never loaded has no rows."""
        child = self._read(spec.name, versions[spec.name])
        counts = []
        for column, parent in spec.parents.items():
            key = TABLES[parent].key
            rows = self._read(parent, versions[parent]) if parent in versions else self.spark.createDataFrame([], TABLES[parent].schema)
            lost = constraints.orphans(child.select(column).filter(F.col(column).isNotNull()), column, rows, key)
            counts.append(lost.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).select(F.lit(f"foreign_key {column} -> {parent}").alias("rule"), "n"))
        if counts:
            broken |= {r.rule: r.n for r in constraints.union(counts).filter("n > 0").collect()}  # one row per key

    def expire(self, keep: int = 2) -> list[str]:
        """Deletes all manifests but the newest ``keep``, and the folders that only they name; returns those folders."""
        if keep < 1:
            raise ValueError("the newest manifest stays")
        numbers = self._numbers()
        old, kept = numbers[:-keep], numbers[-keep:]
        named = {v.path for n in kept for v in self._manifest(n).values()}
        gone = sorted({v.path for n in old for v in self._manifest(n).values()} - named)
        for path in [*gone, *(f"{self.root}/manifests/{n:010d}.json" for n in old)]:
            drop_path(self.spark, path)
        return gone
