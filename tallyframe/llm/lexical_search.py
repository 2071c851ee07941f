"""Ranked lexical search over K2-treaps of terms and documents.

Documents are taken in blocks. A block is a grid with a row for each term, in
falling order of document frequency, and a column for each document, by id;
an entry is the part of the score that depends on how often the term is in the
document and how long that is. The grid is kept as a quadtree: a node has four
bits for its quarters that hold entries, and the greatest entry below it,
stored as the difference to its parent's. For an item, the paths of the rows of
its terms go down together over ranges of documents, the range with the best
sum of maxima first. A range whose sum cannot beat the tenth best document
found so far is left; nothing else is, so ranks are exact.

Index and items do not depend on each other: :func:`write_index` makes a table
with one row a block, :func:`search` asks it. Items go to all blocks in parts
of a bounded number of terms.

Null texts and texts without terms are never found and count in no statistic.
Each document row is a document, also with a repeated or null id (null last
among equal scores). Items of one id, null included, are one item with the
terms of all their texts; an item without terms, or of terms no document has,
gives no row. An empty table on either side gives none. ``doc_id`` has to be an
integer; other columns are ignored. A text is held whole in one task.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from tallyframe.llm import vec
from tallyframe.plans.lineage import materialize

#: A block has at most so many documents, and so many bytes of text unless one text has more.
BLOCK_DOCS, BLOCK_BYTES = 8192, 16 << 20
#: Terms of the items that are searched at a time.
ASKED_TERMS = 1_000_000
TOP = 10
#: Ranges of documents that are opened at a time, at first and at most.
FIRST_OPEN, MOST_OPEN = 32, 512

# Bytes of terms: digits, letters and everything beyond ASCII.
_TERM = np.zeros(256, bool)
_TERM[48:58] = _TERM[65:91] = _TERM[97:123] = _TERM[128:] = True
_BITS = np.array([bin(i).count("1") for i in range(16)], np.uint8)
_LAST = np.int64(np.iinfo(np.int64).max)


# ---- terms


def term_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which bytes are in terms, the first byte of each term, and n + 1 offsets that say which terms a text has."""
    inside = _TERM[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[heads] = inside[heads]
    starts = np.flatnonzero(first)
    return inside, starts, np.searchsorted(starts, offsets)


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """All terms in order, lower-cased, and n + 1 offsets by text."""
    inside, starts, bounds = term_bounds(data, offsets)
    place = np.cumsum(inside) - inside
    at = np.append(place[starts], inside.sum()).astype(np.int64)
    letters = vec.lowered(data[inside])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(letters)]), bounds


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    docs, terms = 0, 0
    for batch in batches:
        data, offsets = vec.string_bytes(batch.column(0))
        for low, high in vec.chunks(offsets):
            bounds = term_bounds(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])[2]
            docs, terms = docs + int((np.diff(bounds) > 0).sum()), terms + int(bounds[-1])
    yield pa.RecordBatch.from_arrays([pa.array([docs]), pa.array([terms])], names=["docs", "terms"])


def corpus_counts(docs: DataFrame) -> tuple[int, int]:
    """N and L: documents with a term, and all their terms with repeats."""
    found = docs.select("text").mapInArrow(_count, "docs bigint, terms bigint").agg(F.sum("docs"), F.sum("terms")).first()
    return found[0] or 0, found[1] or 0


def entries(tf: np.ndarray, n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """What a term that is ``tf`` times in a document of ``n`` terms counts there, before its weight."""
    wide = n.astype(object) if 90 * int(n.max(initial=0)) * docs >= 1 << 63 else n.astype(np.int64)
    m = (100 - 90 + (90 * wide * docs) // terms).astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def weight(df: np.ndarray, docs: int) -> np.ndarray:
    return np.floor(1000 * np.log((2 * docs + 2) / (2 * df + 1))).astype(np.int64)


# ---- the quadtree of one block


def _spread(x: np.ndarray) -> np.ndarray:
    """Bits of 32-bit numbers at every other place."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def _smallest(values: np.ndarray) -> np.ndarray:
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def grid_levels(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, height: int) -> dict[str, np.ndarray]:
    """Quarter bits and maxima, level by level from the root, of entries at (row, column).

    ``bits0`` .. are the nodes' quarters, ``less1`` .. how much less a node's
    maximum is than its parent's, and ``top`` the greatest entry of all.
    """
    code = (_spread(rows) << np.uint64(1)) | _spread(columns)
    order = np.argsort(code, kind="stable")
    code, most, out = code[order], values[order], {}
    for level in range(height, 0, -1):
        parent = code >> np.uint64(2)
        first = np.flatnonzero(np.append(True, parent[1:] != parent[:-1]))
        above = np.maximum.reduceat(most, first)
        out[f"less{level}"] = _smallest(np.repeat(above, np.diff(np.append(first, len(code)))) - most)
        out[f"bits{level - 1}"] = np.bitwise_or.reduceat(np.left_shift(1, (code & np.uint64(3)).astype(np.uint8)).astype(np.uint8), first)
        code, most = parent[first], above
    out["top"] = most
    return out


class Treap:
    """The levels of one block as arrays over all nodes; the last node stands for all that are empty."""

    def __init__(self, levels: dict[str, np.ndarray], height: int):
        self.height = height
        bits = [levels[f"bits{level}"] for level in range(height)]
        leaves = np.zeros(len(levels[f"less{height}"]), np.uint8)
        self.bits = np.concatenate([*bits, leaves, np.zeros(1, np.uint8)])
        self.first = np.cumsum(_BITS[self.bits], dtype=np.int64) - _BITS[self.bits] + 1
        most = [levels["top"].astype(np.int64)]
        for level in range(1, height + 1):
            most.append(np.repeat(most[-1], _BITS[bits[level - 1]]) - levels[f"less{level}"])
        self.most = np.concatenate([*most, np.zeros(1, np.int64)])
        self.empty = len(self.bits) - 1

    def step(self, nodes: np.ndarray, quarter: np.ndarray) -> np.ndarray:
        """The child of each node in the given quarter."""
        bits = self.bits[nodes]
        child = self.first[nodes] + _BITS[bits & (np.left_shift(1, quarter) - 1)]
        return np.where((bits >> quarter) & 1, child, self.empty)

    def best(self, rows: np.ndarray, weights: np.ndarray, ids: np.ndarray, found: list[tuple[int, int]], top: int) -> list[tuple[int, int]]:
        """The ``top`` best (score, doc_id) of this block and of ``found``.

        ``rows`` are the rows of an item's terms, ``ids`` the ascending ids of
        the columns. Equal scores rank by id, so a range with the score of the
        last place is opened only if it begins with a lesser id.
        """
        deep = max(1, int(len(ids) - 1).bit_length())
        level = self.height - deep
        nodes = np.zeros(len(rows), np.int64)
        for down in range(level):
            nodes = self.step(nodes, 2 * ((rows >> (self.height - 1 - down)) & 1))
        bound = np.array([int((self.most[nodes] * weights).sum())])
        start, depth, nodes = np.zeros(1, np.int64), np.full(1, level), nodes[None, :]
        many = FIRST_OPEN
        while len(bound):
            last = found[top - 1] if len(found) >= top else (0, _LAST)
            open_ = (bound > last[0]) | ((bound == last[0]) & (ids[start] < last[1]) & (bound > 0))
            bound, start, depth, nodes = bound[open_], start[open_], depth[open_], nodes[open_]
            chosen = np.lexsort((start, -bound))[:many]
            many = min(MOST_OPEN, many + FIRST_OPEN // 4)
            rest = np.ones(len(bound), bool)
            rest[chosen] = False
            under, begin, at = depth[chosen] + 1, start[chosen], nodes[chosen]
            side = 2 * ((rows[None, :] >> (self.height - under)[:, None]) & 1)
            left, right = self.step(at, side), self.step(at, side + 1)
            begin = np.concatenate([begin, begin + np.left_shift(1, self.height - under)])
            under, at = np.concatenate([under, under]), np.concatenate([left, right])
            total = (self.most[at] * weights).sum(axis=1)
            leaf = (under == self.height) & (total > 0)
            if leaf.any():
                found = _better(found, total[leaf], ids[begin[leaf]], top)
            more = (under < self.height) & (total > 0)
            bound, start = np.concatenate([bound[rest], total[more]]), np.concatenate([start[rest], begin[more]])
            depth, nodes = np.concatenate([depth[rest], under[more]]), np.concatenate([nodes[rest], at[more]])
        return found


def _better(found: list[tuple[int, int]], scores: np.ndarray, ids: np.ndarray, top: int) -> list[tuple[int, int]]:
    order = np.lexsort((ids, -scores))[:top]
    both = found + list(zip(scores[order].tolist(), ids[order].tolist()))
    return sorted(both, key=lambda pair: (-pair[0], pair[1]))[:top]


# ---- blocks as rows of a table


def _pack(arrays: dict[str, np.ndarray]) -> bytes:
    head = json.dumps([(name, a.dtype.str, len(a)) for name, a in arrays.items()]).encode()
    return zstandard.compress(len(head).to_bytes(4, "little") + head + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays.values()), 1)


def _unpack(data: bytes) -> dict[str, np.ndarray]:
    data = zstandard.decompress(data)
    at = 4 + int.from_bytes(data[:4], "little")
    out = {}
    for name, kind, size in json.loads(data[4:at]):
        out[name] = np.frombuffer(data, kind, size, at)
        at += out[name].nbytes
    return out


def _grid(ids: pa.Array, data: np.ndarray, offsets: np.ndarray, docs: int, terms: int) -> tuple[dict, dict, dict] | None:
    """(columns, rows, levels) of one block; None if no text has a term."""
    words, bounds = terms_of(data, offsets)
    n = np.diff(bounds)
    held = np.flatnonzero(n)
    if not len(held):
        return None
    known = ids.is_valid().to_numpy(zero_copy_only=False)[held]
    number = np.where(known, ids.cast(pa.int64()).fill_null(_LAST).to_numpy()[held], _LAST)
    held = held[order := np.lexsort((~known, number))]  # columns by id, null last
    column = np.empty(len(n), np.int64)
    column[held] = np.arange(len(held))
    coded = words.dictionary_encode()
    size = len(coded.dictionary)
    pair, tf = np.unique(coded.indices.to_numpy() * np.int64(len(held)) + np.repeat(column, n), return_counts=True)
    term, place = pair // len(held), pair % len(held)
    df = np.bincount(term, minlength=size)
    falling = np.argsort(-df, kind="stable")
    row = np.empty(size, np.int64)
    row[falling] = np.arange(size)
    values = entries(tf, n[held][place], docs, terms)
    height = max(1, int(max(size, len(held)) - 1).bit_length())
    levels = grid_levels(row[term], place, values, height) | {"height": np.array([height])}
    sorted_terms = coded.dictionary.take(pa.array(falling))
    at = np.frombuffer(sorted_terms.buffers()[1], np.int64)[: size + 1]
    spelled = {"ends": _smallest(np.diff(at)), "letters": np.frombuffer(sorted_terms.buffers()[2], np.uint8)[: at[-1]], "df": _smallest(df[falling])}
    return {"ids": number[order], "known": known[order]}, spelled, levels


def _spelled(packed: dict[str, np.ndarray]) -> pa.LargeBinaryArray:
    at = np.concatenate([[0], np.cumsum(packed["ends"], dtype=np.int64)])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(packed["letters"])])


_BLOCK = "columns binary, terms binary, levels binary"


def _build(docs: int, terms: int):
    def flush(held: list[tuple[pa.Array, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        ids = pa.concat_arrays([part[0] for part in held])
        lengths = np.concatenate([np.diff(part[2]) for part in held])
        grid = _grid(ids, np.concatenate([part[1] for part in held]), np.concatenate([[0], np.cumsum(lengths)]), docs, terms)
        if grid:
            yield pa.RecordBatch.from_arrays([pa.array([_pack(part)], pa.binary()) for part in grid], names=["columns", "terms", "levels"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, size = [], 0, 0
        for batch in batches:
            data, offsets = vec.string_bytes(batch.column(1))
            low = 0
            while low < batch.num_rows:
                fits = int(np.searchsorted(offsets, offsets[low] + BLOCK_BYTES - size, side="right")) - 1
                high = min(batch.num_rows, low + BLOCK_DOCS - rows, max(fits, low + (not held)))
                if high > low:
                    held.append((batch.column(0).slice(low, high - low), data[offsets[low] : offsets[high]].copy(), offsets[low : high + 1] - offsets[low]))
                    rows, size = rows + high - low, size + int(offsets[high] - offsets[low])
                if high < batch.num_rows or rows >= BLOCK_DOCS:
                    yield from flush(held)
                    held, rows, size = [], 0, 0
                low = high
        if held:
            yield from flush(held)

    return build


def write_index(docs: DataFrame) -> tuple[DataFrame, int]:
    """A table with one row for each block of documents (``doc_id``, ``text``), and N."""
    count, terms = corpus_counts(docs)
    return materialize(docs.select("doc_id", "text").mapInArrow(_build(count, terms), _BLOCK)), count


# ---- search


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = vec.string_bytes(batch.column(1))
        words, bounds = terms_of(data, offsets)
        lists = pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), words.cast(pa.large_string()))
        yield pa.RecordBatch.from_arrays([batch.column(0), lists.cast(pa.list_(pa.string()))], names=["item_id", "terms"])


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id`` and its distinct ``terms``, all texts of an id together; items without terms give no row."""
    kind = items.schema["item_id"].dataType.simpleString()
    rows = items.select("item_id", "text").mapInArrow(_asked, f"item_id {kind}, terms array<string>")
    return rows.groupBy("item_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("terms")))).alias("terms")).filter("size(terms) > 0")


def _frequencies(asked):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(asked.value, pa.large_binary())
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for block in range(batch.num_rows):
                packed = _unpack(batch.column(0)[block].as_py())
                at = pc.index_in(wanted, value_set=_spelled(packed)).fill_null(-1).to_numpy()
                total[at >= 0] += packed["df"][at[at >= 0]]
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held])], names=["term", "df"])

    return find


def _search(sent, top: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, lists, weights = sent.value
        wanted = pa.array(terms, pa.large_binary())
        # The best so far go along from block to block of a task: they only say what cannot be among them.
        best: list[list[tuple[int, int]]] = [[] for _ in lists]
        for batch in batches:
            for block in range(batch.num_rows):
                held, spelled, levels = (_unpack(batch.column(i)[block].as_py()) for i in range(3))
                tree = Treap(levels, int(levels["height"][0]))
                at = pc.index_in(wanted, value_set=_spelled(spelled)).fill_null(-1).to_numpy().astype(np.int64)
                for k, own in enumerate(lists):
                    rows, weight_ = at[own], weights[own]
                    here = (rows >= 0) & (weight_ > 0)
                    if here.any():
                        best[k] = tree.best(rows[here], weight_[here], held["ids"], best[k], top)
        flat = [(k, score, doc) for k, found in enumerate(best) for score, doc in found]
        item, score, doc = (np.array(part, np.int64) for part in (zip(*flat) if flat else ([], [], [])))
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), pa.array(doc, mask=doc == _LAST), pa.array(score)], names=["nth", "doc_id", "score"]
        )

    return search


def search(index: DataFrame, docs: int, items: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` best documents of each item: ``item_id``, ``rank``, ``doc_id``, ``score``.

    ``docs`` is N. Items come in parts of some ``ASKED_TERMS`` terms, dealt by
    hash (an item with more is a part's largest member); each part is sent to
    all blocks twice, for document frequencies and for the search.
    """
    spark = index.sparkSession
    wanted = materialize(item_terms(items))
    parts = max(1, -(-(wanted.agg(F.sum(F.size("terms"))).first()[0] or 0) // ASKED_TERMS))
    out = None
    for part in range(parts):
        rows = wanted.filter(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part).orderBy("item_id").collect()
        terms = sorted({term.encode() for row in rows for term in row["terms"]})
        place = {term: i for i, term in enumerate(terms)}
        lists = [np.array([place[term.encode()] for term in row["terms"]], np.int64) for row in rows]
        found = index.select("terms").mapInArrow(_frequencies(spark.sparkContext.broadcast(terms)), "term bigint, df bigint")
        df = np.zeros(len(terms), np.int64)
        for term, count in found.groupBy("term").agg(F.sum("df")).collect():  # at most the terms asked for
            df[term] = count
        sent = spark.sparkContext.broadcast((terms, lists, np.where(df > 0, weight(df, docs), 0)))
        best = index.mapInArrow(_search(sent, top), "nth bigint, doc_id bigint, score bigint")
        names = spark.createDataFrame([(k, row["item_id"]) for k, row in enumerate(rows)], f"nth bigint, item_id {items.schema['item_id'].dataType.simpleString()}")
        found = best.join(F.broadcast(names), "nth").select("item_id", "doc_id", "score")  # no more items than one part has
        out = found if out is None else out.union(found)
    order = W.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    index, docs = write_index(spark.read.parquet(f"{folder}/documents.parquet"))
    return search(index, docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


_TERMS = r"""regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

SQL = f"""
WITH doc AS (SELECT row_number() OVER () AS k, doc_id, {_TERMS.format("text")} AS terms FROM documents WHERE text IS NOT NULL),
corpus AS (SELECT count(*) AS docs, sum(len(terms)) AS words FROM doc WHERE len(terms) > 0),
tf AS (SELECT k, doc_id, len(terms) AS n, term, count(*) AS tf
       FROM (SELECT k, doc_id, terms, unnest(terms) AS term FROM doc) GROUP BY k, doc_id, n, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS.format("text")}) AS term FROM benchmark),
found AS (
  SELECT a.item_id, t.k, t.doc_id,
    sum(CAST(floor(1000 * ln((2 * c.docs + 2) / (2 * d.df + 1)::DOUBLE)) AS BIGINT)
        * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (100 - 90 + CAST((90 * t.n * c.docs) // c.words AS BIGINT))))) AS score
  FROM asked a JOIN tf t USING (term) JOIN df d USING (term) CROSS JOIN corpus c GROUP BY a.item_id, t.k, t.doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM found WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 10
"""
