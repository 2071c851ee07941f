"""Repeated byte windows by depth-limited radix passes over suffixes.

A window is the first 50 bytes of a suffix. Suffixes are ordered only that far
and by most significant digits, pass by pass, and what is alone in its group
is dropped before the next digit is looked at. The digits of a window are
chosen so that neighbours share them: the first is its least 20-byte piece by
hash; windows in a row with that piece in common move as one *run*, whose
bytes are the second digit; the third is the window itself. A run that a
smaller document has too repeats whole. Only where one piece has several runs
are their windows compared one by one: equal groups are the repeated windows.

Documents never move. Each scan of the table goes through the same parts; what
the passes find is filed by part, and the next scan reads its own file.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from tallyframe.llm import vec
from tallyframe.llm.shared import new_folder, open_path

U64 = vec.U64
WINDOW, PIECE = 50, 20
#: Documents of about so many bytes are looked at together; runs they share need no pass.
HELD_BYTES = 8 << 20
NO_ID = np.iinfo(np.int64).max


class Bytes:
    """Texts side by side with hashes of any span."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.offsets, size = offsets, len(data)
        with np.errstate(over="ignore"):
            self.run = np.zeros(size + 1, U64)
            np.cumsum(vec._LETTER[data] * vec.powers(vec._BASE, size), out=self.run[1:])
        self.inverse = vec.powers(vec._INVERSE, size + 1)

    def spans(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return vec.mix((self.run[end] - self.run[begin]) * self.inverse[begin] + (end - begin).astype(U64))

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, piece hash, first and last window start and content hash of each run."""
        size, span = len(self.run) - 1, WINDOW - PIECE + 1
        none = np.zeros(0, np.int64)
        if size < WINDOW:
            return none, none.view(U64), none, none, none.view(U64)
        at = np.arange(size - PIECE + 1)
        with np.errstate(over="ignore"):
            piece = vec.mix((self.run[PIECE:] - self.run[:-PIECE]) * self.inverse[: len(at)])
        # The upper half orders pieces, the lower tells where; ties go to the
        # first. Alike for every text, so that equal windows choose equal pieces.
        low = U64(32)
        least = piece >> low << low | at.astype(U64)
        have = 1
        while have < span:
            step = min(have, span - have)
            least = np.minimum(least[:-step], least[step:])
            have += step
        text = np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))
        begin = np.arange(len(least))
        whole = text[: len(begin)] == text[WINDOW - 1 :]
        begin, least, text = begin[whole], least[whole], text[: len(begin)][whole]
        change = np.ones(len(begin), bool)
        change[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(change)
        last = np.append(first[1:], len(begin)) - 1
        where = (least[first] & ((U64(1) << low) - U64(1))).astype(np.int64)
        a, b = begin[first], begin[last[: len(first)]]
        # 48 bits of a piece are enough to bring runs together; what they hold is told apart by content.
        return text[first], piece[where] >> U64(16), a, b, self.spans(a, b + WINDOW)


class Held:
    """Some documents of a part with their runs; ``fresh`` marks runs that no smaller one of them has."""

    def __init__(self, ids: np.ndarray, data: np.ndarray, offsets: np.ndarray):
        self.ids, self.data, self.offsets = ids, data, offsets
        self.pieces = list(vec.chunks(offsets))
        parts = []
        for low, high in self.pieces:
            text, piece, a, b, content = self.bytes_of(low, high).runs()
            parts.append((text + low, piece, a + offsets[low], b + offsets[low], content))
        self.text, self.piece, self.first, self.last, self.content = (np.concatenate(x) for x in zip(*parts))
        self.doc = ids[self.text]
        order = np.lexsort((self.doc, self.content))
        head = np.ones(len(order), bool)
        head[1:] = self.content[order][1:] != self.content[order][:-1]
        least = np.empty(len(order), np.int64)
        least[order] = self.doc[order][np.flatnonzero(head)][np.cumsum(head) - 1] if len(order) else order
        self.fresh = self.doc == least

    def bytes_of(self, low: int, high: int) -> Bytes:
        at = self.offsets[low : high + 1]
        return Bytes(self.data[at[0] : at[-1]], at - at[0])

    def windows(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, hash and run number of every window of the given runs."""
        starts, hashes, owners = [np.zeros(0, np.int64)], [np.zeros(0, U64)], [np.zeros(0, np.int64)]
        texts = self.text[runs]
        for low, high in self.pieces:
            own = runs[np.searchsorted(texts, low) : np.searchsorted(texts, high)]
            if len(own):
                count = self.last[own] - self.first[own] + 1
                at = np.repeat(self.first[own] - (np.cumsum(count) - count), count) + np.arange(count.sum())
                begin = at - self.offsets[low]
                starts.append(at)
                hashes.append(self.bytes_of(low, high).spans(begin, begin + WINDOW))
                owners.append(np.repeat(own, count))
        return np.concatenate(starts), np.concatenate(hashes), np.concatenate(owners)


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Array, Held]]:
    """Documents in groups of about ``HELD_BYTES``, cut by their sizes alone, so alike in every scan."""
    ids, texts, size, part = [], [], 0, 0

    def group():
        data, offsets = vec.string_bytes(pa.concat_arrays(texts))
        own = pa.concat_arrays(ids)
        return part, own, Held(own.cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False), data, offsets)

    for batch in batches:
        _, offsets = vec.string_bytes(batch.column(1))
        part, low = batch.column(2)[0].as_py() if batch.num_rows else part, 0
        while low < batch.num_rows:
            high = int(np.searchsorted(offsets, offsets[low] + HELD_BYTES - size, side="left"))
            high = min(max(high, low + 1), batch.num_rows)
            ids.append(batch.column(0).slice(low, high - low))
            texts.append(batch.column(1).slice(low, high - low))
            size += int(offsets[high] - offsets[low])
            low = high
            if size >= HELD_BYTES:
                yield group()
                ids, texts, size = [], [], 0
    if texts:
        yield group()


def _pair_keys(docs: np.ndarray, values: np.ndarray) -> np.ndarray:
    return vec.mix(values ^ vec.mix(docs.view(U64)))


def _part_mark(ids: np.ndarray, offsets: np.ndarray) -> int:
    """What tells whether a scan saw the documents of the one before."""
    with np.errstate(over="ignore"):
        return int(vec.mix(ids.view(U64) + offsets[1:].astype(U64)).sum().view(np.int64))


def _scan_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc, part, content, piece) of fresh runs; content null: the mark of a group of documents.

    The short piece stands last, where its empty bytes and the head of the next
    row are packed as one in a shuffle.
    """
    for part, _, held in _held(batches):
        keep = np.flatnonzero(held.fresh)
        # A text may have a run twice.
        keep = keep[np.unique(_pair_keys(held.doc[keep], held.content[keep]), return_index=True)[1]]
        mark = pa.array([_part_mark(held.ids, held.offsets)], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays([pa.array(held.doc[keep]), mark]),
                pa.array(np.full(len(keep) + 1, part, np.int32)),
                pa.concat_arrays([pa.array(held.content[keep].view(np.int64)), pa.nulls(1, pa.int64())]),
                pa.concat_arrays([pa.array(held.piece[keep].view(np.int64)), mark]),
            ],
            names=["doc", "part", "content", "piece"],
        )


def _filed(folder: str, part: int, columns: list[str]) -> dict[str, np.ndarray]:
    """What is filed for a part; nothing if no file is."""
    system, root = open_path(folder)
    path = f"{root}/part={part}"
    if system.get_file_info(path).type.name == "NotFound":
        return {c: np.zeros(0, np.int64) for c in columns}
    files = [f for f in system.get_file_info(pa.fs.FileSelector(path)) if f.path.endswith(".parquet")]
    tables = [pq.ParquetFile(system.open_input_file(f.path)).read(columns=columns) for f in files]
    return {c: np.concatenate([t[c].to_numpy() for t in tables]) for c in columns}


class Filed:
    """Findings on the runs of a part: keys of repeated runs and of runs to be compared by window."""

    def __init__(self, folder: str, part: int):
        found = _filed(folder, part, ["doc", "content", "repeated", "marked"])
        self.marks = set(found["doc"][found["marked"].astype(bool)].tolist())
        real = ~found["marked"].astype(bool)
        keys = _pair_keys(found["doc"][real].astype(np.int64), found["content"][real].astype(np.int64).view(U64))
        repeated = found["repeated"][real].astype(bool)
        self.repeated, self.compare = np.sort(keys[repeated]), np.sort(keys[~repeated])

    def check(self, held: Held) -> None:
        if _part_mark(held.ids, held.offsets) not in self.marks:
            raise ValueError("the documents of a part changed between scans; write the table before")


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _scan_windows(folder: str):
    """Rows (window, doc, part) of the runs that need it."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part_now, filed = None, None
        for part, _, held in _held(batches):
            if part != part_now:
                part_now, filed = part, Filed(folder, part)
            filed.check(held)
            keys = _pair_keys(held.doc, held.content)
            _, hashes, owner = held.windows(np.flatnonzero(held.fresh & _among(keys, filed.compare)))
            # The least document of the group that has a window is enough.
            order = np.lexsort((held.doc[owner], hashes))
            head = np.ones(len(order), bool)
            head[1:] = hashes[order][1:] != hashes[order][:-1]
            keep = order[head]
            for low in range(0, len(keep), 100_000):
                own = keep[low : low + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[own].view(np.int64)), pa.array(held.doc[owner[own]]), pa.array(np.full(len(own), part, np.int32))],
                    names=["window", "doc", "part"],
                )

    return scan


def covered_bytes(held: Held, filed: Filed, repeated_windows: np.ndarray) -> np.ndarray:
    """Which bytes a repeated window covers. ``repeated_windows``: ordered pair keys of document and window."""
    keys = _pair_keys(held.doc, held.content)
    whole = ~held.fresh | _among(keys, filed.repeated)
    step = np.zeros(len(held.data) + 1, np.int32)
    np.add.at(step, held.first[whole], 1)
    np.add.at(step, held.last[whole] + WINDOW, -1)
    starts, hashes, owner = held.windows(np.flatnonzero(~whole & _among(keys, filed.compare)))
    if len(starts):
        docs = held.doc[owner]
        order = np.lexsort((docs, hashes))
        head = np.ones(len(order), bool)
        head[1:] = hashes[order][1:] != hashes[order][:-1]
        least = np.empty(len(order), np.int64)
        least[order] = docs[order][np.flatnonzero(head)][np.cumsum(head) - 1]
        hit = (docs > least) | _among(_pair_keys(docs, hashes), repeated_windows)
        np.add.at(step, starts[hit], 1)
        np.add.at(step, starts[hit] + WINDOW, -1)
    return np.cumsum(step[:-1]) > 0


def _scan_texts(folder: str, windows_folder: str, make: Callable):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part_now, filed, repeated = None, None, None
        for part, ids, held in _held(batches):
            if part != part_now:
                part_now, filed = part, Filed(folder, part)
                found = _filed(windows_folder, part, ["doc", "window"])
                repeated = np.sort(_pair_keys(found["doc"].astype(np.int64), found["window"].astype(np.int64).view(U64)))
            filed.check(held)
            gone = covered_bytes(held, filed, repeated)
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            heads = held.offsets[:-1][np.diff(held.offsets) > 0]
            begins[heads] = gone[heads]
            sums = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[held.offsets])
            kept = [held.data[a:b][~gone[a:b]].tobytes() for a, b in zip(held.offsets[:-1], held.offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.diff(held.offsets)), pa.array(sums(gone)), pa.array(sums(begins)), make(kept)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return scan


def _sha256(kept: list[bytes]) -> pa.Array:
    return pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())


def _raw(kept: list[bytes]) -> pa.Array:
    return pa.array(kept, pa.binary())


def remove_repeated(docs: DataFrame, digest: bool = False) -> DataFrame:
    """Cut from each text every byte in a 50-byte window that starts in a document of smaller id too.

    ``docs`` has ``doc_id`` (an integer) and ``text``; other columns are
    ignored. Gives ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and
    ``kept``, the remaining UTF-8 bytes, or their sha256 with ``digest``.
    Windows are judged on the input. Null texts count as empty, texts under 50
    bytes have no window. A null id counts as greater than all others; equal
    ids are no smaller than each other, so repeated rows keep what they share.

    ``docs`` is scanned three times and must give the same partitions each
    time, as a table does; else the job fails.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id"), F.col("text"), F.spark_partition_id().alias("part"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    runs = rows.mapInArrow(_scan_runs, "doc bigint, part int, content bigint, piece bigint")
    # One shuffle and one sort serve both: by piece, then content.
    least = F.min("doc").over(W.partitionBy("piece", "content"))
    piece = W.partitionBy("piece")
    ranked = runs.withColumn("least", least).withColumn("several", F.min("content").over(piece) != F.max("content").over(piece))
    marked, repeated = F.col("content").isNull(), F.col("doc") > F.col("least")
    found = ranked.filter(marked | repeated | F.col("several")).select(
        "part", "doc", F.coalesce("content", F.lit(0)).alias("content"), repeated.alias("repeated"), marked.alias("marked")
    )
    run_folder, window_folder = (f"{new_folder(spark, 'repeats')}/{name}" for name in ("runs", "windows"))
    _file(found, run_folder)
    windows = rows.mapInArrow(_scan_windows(run_folder), "window bigint, doc bigint, part int")
    lower = F.min("doc").over(W.partitionBy("window"))
    _file(windows.withColumn("least", lower).filter("doc > least").select("part", "doc", "window"), window_folder)
    last = "string" if digest else "binary"
    scan = _scan_texts(run_folder, window_folder, _sha256 if digest else _raw)
    return rows.mapInArrow(scan, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept {last}")


def _file(rows: DataFrame, folder: str) -> None:
    """Write rows under a folder of their part."""
    rows.repartition("part").write.partitionBy("part").parquet(folder)


def op8_repeated_bytes(spark: SparkSession, folder: str) -> DataFrame:
    found = remove_repeated(spark.read.parquet(f"{folder}/documents.parquet"), digest=True)
    return found.withColumnRenamed("kept", "kept_sha256")
