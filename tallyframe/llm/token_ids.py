"""Token ids in binary shards with a minimal perfect hash index over document keys.

A shard holds the ids of consecutive documents (by doc_id) as raw little-endian
unsigned integers, of 16 bits if the vocabulary fits and else of 32, every
document closed by the end id. An index file
covers one hash bucket of keys and maps each to shard, offset and length, with
a fingerprint. Reading one document takes one index look-up and one read.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tallyframe.llm.perfect_hash import PerfectHash, fingerprint
from tallyframe.llm.shared import make_folder, new_folder, open_path
from tallyframe.llm.vec import U64, lowered, mix, string_bytes, words as word_spans

END_ID = 1
KEYS_PER_INDEX = 100_000
#: Words longer than this are encoded each time; at most so many are remembered.
KEPT_CHARS, KEPT_WORDS = 40, 1_000_000
JOINED = 1000

_kept: dict[str, dict[str, bytes]] = {}
_loaded: dict[str, tuple] = {}


def _tokenizer(path: str) -> tuple:
    """The tokenizer and the type its ids are stored in."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(path)
        _loaded[path] = found, "<u2" if max(found.get_vocab().values()) < 1 << 16 else "<u4"
    return _loaded[path]


# Letters of ASCII and Latin-1: lower case is letter by letter and nothing composes.
_PLAIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")


def _byte_letters() -> dict[int, int]:
    """Which letter stands for each byte in the vocabulary: visible bytes for
    themselves, the others for the letters from U+0100 on, in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [byte for byte in range(256) if byte not in shown]
    return {byte: byte if byte in shown else 256 + hidden.index(byte) for byte in range(256)}


_LETTERS = _byte_letters()


def _encode_new(new: set[str], path: str) -> dict[str, bytes]:
    """Ids of words not met before.

    A word of plain letters is one piece to the tokenizer, so its lower case
    goes straight to the library's model; other words go through it whole.
    """
    tokenizer, kind = _tokenizer(path)
    model, code = tokenizer.model, "H" if kind == "<u2" else "I"
    made, whole = {}, []
    for word in new:
        if _PLAIN.fullmatch(word):
            low = word.lower()
            found = model.tokenize(low if low.isascii() else low.encode().decode("latin-1").translate(_LETTERS))
            made[word] = array(code, [token.id for token in found]).tobytes()
        else:
            whole.append(word)
    for low in range(0, len(whole), JOINED):
        block = whole[low : low + JOINED]
        for word, found in zip(block, tokenizer.encode_batch(block, add_special_tokens=False)):
            made[word] = array(code, found.ids).tobytes()
    return made


def _distinct_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct words of some texts, the number of each word in a row among them, and n + 1 offsets by text."""
    data, offsets = string_bytes(texts)
    starts, ends, words = word_spans(data, offsets)
    size = ends - starts
    turns = np.zeros(len(data) + 1, np.int8)
    turns[starts] += 1
    turns[ends] -= 1
    letters = data[np.cumsum(turns[:-1], dtype=np.int8).view(bool)]
    at = np.concatenate([[0], np.cumsum(size)])
    # The tokenizer lower-cases all but its special tokens ("<|..."); where that
    # is plain, it is done here and fewer words are new.
    plain = np.ones(len(size), bool)
    plain[np.searchsorted(at, np.flatnonzero((letters >= 128) | (letters == ord("<"))), side="right") - 1] = False
    letters = np.where(np.repeat(plain, size), lowered(letters), letters)
    made = pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(letters)])
    coded = made.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), words


def encode(texts: list[str] | pa.Array, path: str) -> list[bytes]:
    """Ids of each text as raw bytes, without the end id.

    The tokenizer drops white space and never joins across it, so a text's ids
    are those of its words in a row, and a word met before is not encoded
    again. Letters and one closing mark are two pieces, so they too are looked
    up apart. Python sees each distinct word once; the ids of the words in a
    row are put together as arrays.
    """
    kept, kind = _kept.setdefault(path, {}), np.dtype(_tokenizer(path)[1])
    found, nth, words = _distinct_words(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()))
    unknown = [word for word in found if word not in kept]
    parts = {w: (w[:-1], w[-1]) if w[-1] in ".,!?;:" and _PLAIN.fullmatch(w[:-1]) else (w,) for w in unknown}
    pieces = {piece for own in parts.values() for piece in own}
    local = _encode_new({piece for piece in pieces if piece not in kept}, path)
    for word, own in parts.items():
        local[word] = b"".join([local[p] if p in local else kept[p] for p in own])
    ids = [kept[word] if word in kept else local[word] for word in found]
    kept.update({word: own for word, own in local.items() if len(word) <= KEPT_CHARS})
    if len(kept) > KEPT_WORDS:
        kept.clear()
    size = np.array([len(own) for own in ids], np.int64) // kind.itemsize
    count = size[nth]
    at = np.concatenate([[0], np.cumsum(count)])
    row = np.frombuffer(b"".join(ids), kind)[np.repeat((np.cumsum(size) - size)[nth] - at[:-1], count) + np.arange(at[-1])]
    bounds = (at[words] * kind.itemsize).tolist()
    data = row.tobytes()
    return [data[low:high] for low, high in zip(bounds, bounds[1:])]


def _blocks(batch: pa.RecordBatch, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text each."""
    step = max(1, int(batch.num_rows * size / max(1, batch.nbytes)))
    for low in range(0, batch.num_rows, step):
        yield batch.slice(low, step)


def _write_shard(folder: str, path: str):
    """Write one task's documents, in order, to a new file; give a row for each."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A repeated task writes another file; only the rows of the task that
        # counts name theirs, so what a lost executor left is never read.
        kind = _tokenizer(path)[1]
        end, width = np.array([END_ID], kind).tobytes(), np.dtype(kind).itemsize
        name, out, at = f"{uuid.uuid4().hex}.{kind[1:]}", None, 0
        system, root = open_path(folder)
        try:
            for whole in batches:
                for batch in _blocks(whole):
                    made = [ids + end for ids in encode(batch.column(1), path)]
                    counts = np.array([len(ids) // width for ids in made], np.int64)
                    if made and out is None:
                        out = system.open_output_stream(f"{root}/{name}")
                    if made:
                        out.write(b"".join(made))
                    first = at + np.cumsum(counts) - counts
                    at += int(counts.sum())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0), pa.array([name] * len(made)), pa.array(first), pa.array(counts)],
                        names=["doc_id", "file", "offset", "n_tokens"],
                    )
        finally:
            if out is not None:
                out.close()

    return write


def _key(doc_id: Column, nth: Column) -> Column:
    return F.xxhash64(doc_id, nth)


def _with_nth(rows: DataFrame, *order: str) -> DataFrame:
    """Number repeats of a doc_id from 0, so that every row has a key of its own."""
    return rows.withColumn("nth", F.row_number().over(W.partitionBy("doc_id").orderBy(*order)) - 1)


def write_ids(docs: DataFrame, tokenizer: str, folder: str) -> str:
    """Write ``docs`` (``doc_id``, ``text``) as shards and index under ``folder``.

    Documents are in ascending doc_id order over all shards: null ids first,
    repeats of an id by the hash of their text. Null and empty texts have only
    the end id. An empty table makes an empty index. Other columns are ignored.
    """
    make_folder(f"{folder}/shards")
    make_folder(f"{folder}/index")
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("__text"))
    placed = rows.repartitionByRange("doc_id", "__text").sortWithinPartitions("doc_id", "__text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    placed.select("doc_id", "text").mapInArrow(
        _write_shard(f"{folder}/shards", tokenizer), f"doc_id {kind}, file string, offset bigint, n_tokens bigint"
    ).withColumn("__text", F.monotonically_increasing_id()).write.parquet(f"{folder}/rows")
    rows = docs.sparkSession.read.parquet(f"{folder}/rows")
    # Shards in order, each with the number of ids before it. Task order is doc_id order.
    shards = rows.groupBy("file").agg(F.sum("n_tokens").alias("ids"), F.min("__text").alias("turn"))
    turn = W.orderBy("turn")
    before = F.coalesce(F.sum("ids").over(turn.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    shards.select("file", "ids", (F.row_number().over(turn) - 1).alias("shard"), before.alias("base")).write.parquet(f"{folder}/shards_list")
    shards = docs.sparkSession.read.parquet(f"{folder}/shards_list")
    buckets = max(1, -(-rows.count() // KEYS_PER_INDEX))
    keyed = _with_nth(rows, "__text").join(shards.select("file", "shard"), "file")
    keyed = keyed.select(_key(F.col("doc_id"), F.col("nth")).alias("key"), "shard", "offset", "n_tokens")
    keyed = keyed.withColumn("bucket", F.pmod(F.col("key"), F.lit(buckets)).cast("int"))
    keyed.groupBy("bucket").applyInPandas(_build_index(f"{folder}/index"), "bucket int, file string").withColumn(
        "buckets", F.lit(buckets)
    ).write.parquet(f"{folder}/index_list")
    return folder


def _build_index(folder: str):
    def build(keys: pd.DataFrame) -> pd.DataFrame:
        own = keys["key"].to_numpy(np.int64).view(U64)
        table = PerfectHash.build(own)
        order = np.empty(len(own), np.int64)
        order[table.number(own)] = np.arange(len(own))
        data = table.dump(
            prints=fingerprint(own)[order],
            shard=keys["shard"].to_numpy(np.int32)[order],
            offset=keys["offset"].to_numpy(np.int64)[order],
            count=keys["n_tokens"].to_numpy(np.int64)[order],
        )
        system, root = open_path(folder)
        name = f"{uuid.uuid4().hex}.mph"
        with system.open_output_stream(f"{root}/{name}") as out:
            out.write(data)
        return pd.DataFrame({"bucket": keys["bucket"].iloc[:1].astype("int32"), "file": [name]})

    return build


def _look_up(folder: str):
    def look(keys: pd.DataFrame) -> pd.DataFrame:
        system, root = open_path(folder)
        with system.open_input_stream(f"{root}/{keys['file'].iloc[0]}") as found:
            table, columns = PerfectHash.load(found.read())
        own = keys["key"].to_numpy(np.int64).view(U64)
        at = table.number(own)
        known = at >= 0
        known[known] = columns["prints"][at[known]] == fingerprint(own[known])
        at = at[known]
        return keys.loc[known, ["doc_id", "nth"]].assign(
            shard=columns["shard"][at], offset=columns["offset"][at], n_tokens=columns["count"][at]
        )

    return look


def find(keys: DataFrame, folder: str) -> DataFrame:
    """Place of each key (``doc_id``, ``nth``) by the index; unknown keys give no row."""
    index = keys.sparkSession.read.parquet(f"{folder}/index_list")
    key = _key(F.col("doc_id"), F.col("nth"))
    count = index.select(F.max("buckets")).first()[0]
    kind = keys.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, nth int, shard int, offset bigint, n_tokens bigint"
    if count is None:
        return keys.sparkSession.createDataFrame([], schema)
    bucketed = keys.select("doc_id", "nth", key.alias("key"), F.pmod(key, F.lit(count)).cast("int").alias("bucket"))
    asked = bucketed.join(index.select("bucket", "file"), "bucket")
    return asked.groupBy("bucket").applyInPandas(_look_up(f"{folder}/index"), schema)


def _read_ids(folder: str, digest: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_path(folder)
        name, source = None, None
        try:
            for batch in batches:
                out = []
                for file, offset, count in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
                    if file != name:
                        if source is not None:
                            source.close()
                        name, source = file, system.open_input_file(f"{root}/{file}")
                    kind = np.dtype("<" + file.rpartition(".")[2])
                    data = source.read_at(kind.itemsize * count, kind.itemsize * offset)
                    if len(data) != kind.itemsize * count:
                        raise ValueError(f"{file} ends before offset {offset} plus {count} ids")
                    ids = np.frombuffer(data, kind)
                    out.append(zlib.crc32(ids.astype("<u4").tobytes()) if digest else ids.astype(np.int64).tolist())
                last = pa.int64() if digest else pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), batch.column(4), pa.array(out, last)],
                    names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"],
                )
        finally:
            if source is not None:
                source.close()

    return read


def read_ids(keys: DataFrame, folder: str, digest: bool = False) -> DataFrame:
    """Ids of each document in ``keys`` (``doc_id``), read through the index.

    Gives ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``
    and ``ids``, or with ``digest`` the crc32 of the ids as 32-bit integers as
    ``ids_crc32``. A doc_id that
    ``keys`` has k times gives the first k documents of that id.
    """
    places = find(_with_nth(keys.select("doc_id"), "doc_id"), folder)
    shards = keys.sparkSession.read.parquet(f"{folder}/shards_list").select("shard", "file", "base")
    rows = places.join(shards, "shard").select(
        "doc_id", (F.col("base") + F.col("offset")).alias("start"), "file", "offset", "n_tokens"
    )
    # Each file's documents in runs of offsets: a large file is read by several tasks.
    ordered = rows.repartition("file", F.shiftright("offset", 24)).sortWithinPartitions("file", "offset")
    kind = keys.schema["doc_id"].dataType.simpleString()
    last = "ids_crc32 bigint" if digest else "ids array<bigint>"
    return ordered.mapInArrow(_read_ids(f"{folder}/shards", digest), f"doc_id {kind}, start bigint, n_tokens bigint, {last}")


def public_tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def ids_of(docs: DataFrame) -> DataFrame:
    """Write ``docs`` in the binary format and read every document back."""
    folder = write_ids(docs, public_tokenizer(), new_folder(docs.sparkSession, "token-ids"))
    return read_ids(docs, folder, digest=True)


def op6_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    return ids_of(spark.read.parquet(f"{folder}/documents.parquet"))
