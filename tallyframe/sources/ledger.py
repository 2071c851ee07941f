"""Tables as Parquet files named by a log of commits.

For jobs that append or change rows and may be started twice, side by side, or
die halfway. Files are written first, under names of their own; a commit then
names them in one small log entry, which is put in place by a rename that fails
if the place is taken. What no entry names is never read. A writer that finds
its place taken looks at what came in between, and only at that, before it
tries the next place.

Rows are dealt to files by a hash of their key. Each file has a Bloom filter of
its keys next to it, so a search for keys opens only files that may hold one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyframe.plans.lineage import materialize

#: Files a commit spreads its rows over; bits of a filter for each key, and places set for each.
BUCKETS = 64
BITS_A_KEY, PLACES = 10, 7

_HASH, _BUCKET = "__hash", "__bucket"


@dataclass(frozen=True)
class Commit:
    """One entry: files that came, files that went, and where the filters of the new ones are."""

    run_id: str
    added: tuple[str, ...]
    removed: tuple[str, ...]
    filters: str
    rows: int


@dataclass(frozen=True)
class Table:
    """A folder with ``files``, ``filters`` and ``log``; ``keys`` tell rows apart."""

    spark: SparkSession
    folder: str
    schema: T.StructType
    keys: tuple[str, ...]
    buckets: int = BUCKETS


class PlaceTaken(Exception):
    """Another writer has committed first."""


# ---- the log


def _path(table: Table, name: str):
    return table.spark._jvm.org.apache.hadoop.fs.Path(f"{table.folder}/{name}")


def _system(table: Table):
    conf = table.spark._jsparkSession.sessionState().newHadoopConf()
    return _path(table, "log").getFileSystem(conf)


def commits(table: Table) -> list[Commit]:
    """All entries in their order."""
    system, log = _system(table), _path(table, "log")
    if not system.exists(log):
        return []
    names = sorted(s.getPath().getName() for s in system.listStatus(log) if s.getPath().getName().endswith(".json"))
    out = []
    for name in names:
        stream = system.open(_path(table, f"log/{name}"))
        try:
            entry = json.loads(table.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        out.append(Commit(entry["run_id"], tuple(entry["added"]), tuple(entry["removed"]), entry["filters"], entry["rows"]))
    return out


def commit(table: Table, place: int, entry: Commit) -> None:
    """Put an entry at a place in the log; :class:`PlaceTaken` if there is one."""
    jvm = table.spark._jvm
    system = _system(table)
    system.mkdirs(_path(table, "log"))
    draft = _path(table, f"log/.draft-{uuid.uuid4().hex}")
    out = system.create(draft, False)
    out.write(bytearray(json.dumps(entry.__dict__).encode()))
    out.close()
    conf = table.spark._jsparkSession.sessionState().newHadoopConf()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), conf)
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = table.spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.NONE
    try:
        context.rename(system.makeQualified(draft), system.makeQualified(_path(table, f"log/{place:09d}.json")), how)
    except Exception as error:
        system.delete(draft, False)
        if "FileAlreadyExists" in str(error):
            raise PlaceTaken(place) from None
        raise


def live_files(entries: Sequence[Commit]) -> list[str]:
    gone = {name for entry in entries for name in entry.removed}
    return [name for entry in entries for name in entry.added if name not in gone]


def read(table: Table, files: Sequence[str] | None = None) -> DataFrame:
    """The rows of the table, or of some of its files."""
    names = live_files(commits(table)) if files is None else list(files)
    if not names:
        return table.spark.createDataFrame([], table.schema)
    return table.spark.read.schema(table.schema).parquet(*[f"{table.folder}/files/{name}" for name in names])


# ---- files and filters


def _hashed(rows: DataFrame, table: Table) -> DataFrame:
    key = F.xxhash64(*table.keys)
    return rows.withColumns({_HASH: key, _BUCKET: F.pmod(key, F.lit(table.buckets)).cast("int")})


def _spots(hashes: np.ndarray, size: int) -> np.ndarray:
    """Places of each key in a filter of ``size`` bits: one row for each key."""
    low, high = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    return (low[:, None] + high[:, None] * np.arange(PLACES, dtype=np.uint64)) % np.uint64(size)


def filter_bits(hashes: np.ndarray) -> bytes:
    size = max(64, -(-len(hashes) * BITS_A_KEY // 8) * 8)
    bits = np.zeros(size, np.uint8)
    bits[_spots(hashes.astype(np.int64).view(np.uint64), size).ravel()] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def may_hold(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    """For each key whether a filter may have it; never False for one it has."""
    packed = np.frombuffer(bits, np.uint8)
    spots = _spots(hashes.astype(np.int64).view(np.uint64), len(packed) * 8)
    return (packed[spots >> np.uint64(3)] >> (spots & np.uint64(7)).astype(np.uint8) & 1).all(axis=1)


def _write_files(table: Table, rows: DataFrame, run_id: str, removed: Sequence[str] = ()) -> Commit:
    """Write rows as new files with their filters; nothing is committed."""
    part = uuid.uuid4().hex
    place = f"{table.folder}/files/{part}"
    hashed = _hashed(rows.select(*table.schema.names), table)
    hashed.repartition(table.buckets, _BUCKET).drop(_HASH).write.partitionBy(_BUCKET).parquet(place)
    # From the files themselves: what the filters say is what was written.
    written = table.spark.read.schema(table.schema).parquet(place)
    named = _hashed(written.select(*table.keys, F.col("_metadata.file_path").alias("path")), table)

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        path = frame["path"].iloc[0]
        name = part + path.rpartition(part)[2]
        return pd.DataFrame({"file": [name], "bucket": frame[_BUCKET].iloc[:1].to_numpy(), "rows": [len(frame)], "bits": [filter_bits(frame[_HASH].to_numpy())]})

    schema = "file string, bucket int, rows bigint, bits binary"
    named.groupBy("path").applyInPandas(build, schema).write.parquet(f"{table.folder}/filters/{part}")
    files = table.spark.read.schema(schema).parquet(f"{table.folder}/filters/{part}").select("file", "rows").collect()  # one row a file
    return Commit(run_id, tuple(sorted(r["file"] for r in files)), tuple(removed), part, sum(r["rows"] for r in files))


def candidate_files(table: Table, keys: DataFrame, entries: Sequence[Commit], live: Sequence[str]) -> list[str]:
    """Live files of ``entries`` whose filter may hold one of ``keys``."""
    places = [f"{table.folder}/filters/{entry.filters}" for entry in entries if set(entry.added) & set(live)]
    if not places:
        return []
    schema = "file string, bucket int, rows bigint, bits binary"
    filters = table.spark.read.schema(schema).parquet(*places).select("file", F.col("bucket").alias(_BUCKET), "bits")

    def test(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        hashes = asked[_HASH].to_numpy()
        hit = [name for name, bits in zip(held["file"], held["bits"]) if len(hashes) and may_hold(bits, hashes).any()]
        return pd.DataFrame({"file": hit}, dtype=object)

    asked = _hashed(keys.select(*table.keys), table).select(_BUCKET, _HASH)
    found = asked.groupBy(_BUCKET).cogroup(filters.groupBy(_BUCKET)).applyInPandas(test, "file string")
    wanted = set(live)
    return sorted({row["file"] for row in found.collect()} & wanted)  # names of files, as many as the log has


# ---- appending


def _without_known(table: Table, rows: DataFrame, entries: Sequence[Commit], live: Sequence[str]) -> DataFrame:
    files = candidate_files(table, rows, entries, live)
    if not files:
        return rows
    known = read(table, files).select(*table.keys)
    same = [F.col(f"n.{key}").eqNullSafe(F.col(f"k.{key}")) for key in table.keys]
    return rows.alias("n").join(known.alias("k"), same, "left_anti")


def _one_per_key(table: Table, rows: DataFrame) -> DataFrame:
    """Of rows with one key the least, so that a repeated run picks the same."""
    others = [name for name in table.schema.names if name not in table.keys]
    rows = rows.select(*table.schema.names)
    if not others:
        return rows.distinct()
    least = rows.groupBy(*table.keys).agg(F.min(F.struct(*others)).alias("__row"))
    return least.select(*[F.col(name) if name in table.keys else F.col(f"__row.{name}").alias(name) for name in table.schema.names])


def append_new(table: Table, rows: DataFrame, run_id: str, pause: Callable[[], None] = lambda: None) -> int:
    """Append rows whose keys the table does not hold, once for each run; says how many.

    A run that is in the log adds nothing. ``pause`` is called between writing
    files and committing them.
    """
    entries = commits(table)
    if any(entry.run_id == run_id for entry in entries):
        return 0
    fresh = _one_per_key(table, _without_known(table, rows, entries, live_files(entries)))
    draft = _write_files(table, fresh, run_id)
    pause()
    while True:
        try:
            commit(table, len(entries), draft)
            return draft.rows
        except PlaceTaken:
            seen, entries = len(entries), commits(table)
            if any(entry.run_id == run_id for entry in entries):
                return 0
            # Only what came in since can hold a key of ours.
            later = entries[seen:]
            live = set(live_files(entries)) & {name for entry in later for name in entry.added}
            mine = read(table, draft.added)
            if candidate_files(table, mine, later, sorted(live)):
                left = _without_known(table, mine, later, sorted(live))
                draft = _write_files(table, materialize(left), run_id)


# ---- changing rows


def update(
    table: Table, hits: DataFrame, change: Callable[[DataFrame], DataFrame], run_id: str, due: str | None = None
) -> tuple[int, int]:
    """Rewrite the files that hold a row to change; says how many files went and stayed.

    ``hits`` has the keys of rows to change, ``due`` a condition that such a
    row meets as long as it is not changed yet, ``change`` gives the rows of
    the files with the change made. Files without such a row stay as they are,
    under their names.
    """
    while True:
        entries = commits(table)
        live = live_files(entries)
        if any(entry.run_id == run_id for entry in entries):
            return 0, len(live)
        wanted = hits.select(*table.keys).distinct()
        files = candidate_files(table, wanted, entries, live)
        if files:
            rows = read(table, files).withColumn("__path", F.col("_metadata.file_path"))
            rows = rows.filter(due) if due else rows
            held = rows.join(wanted, list(table.keys), "left_semi").select("__path").distinct().collect()
            files = [name for name in files if any(row["__path"].endswith(name) for row in held)]
        if not files:
            return 0, len(live)
        draft = _write_files(table, change(read(table, files)), run_id, removed=files)
        try:
            commit(table, len(entries), draft)
            return len(files), len(live) - len(files)
        except PlaceTaken:
            continue


def unlisted_files(table: Table) -> Iterator[str]:
    """Folders of files that no entry names: left by writers that died, or gave way."""
    system, named = _system(table), {name.split("/")[0] for entry in commits(table) for name in entry.added}
    if system.exists(_path(table, "files")):
        for status in system.listStatus(_path(table, "files")):
            if status.getPath().getName() not in named:
                yield status.getPath().getName()
