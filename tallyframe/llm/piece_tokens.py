"""SentencePiece encoding and decoding for vocabularies whose pieces are merges.

A text is normalised and cut wherever two characters stand side by side in no
piece, since no merge joins them. Every part starts as single characters. Its
agenda holds the adjacent pairs that form a piece; the pair of the best score
is merged, of equal scores the leftmost, until none is left. A character
without a piece becomes its UTF-8 bytes. The distinct parts of a batch have
their agendas in one array, one merge of each part in a round; a long part has
a heap of its own. What was merged is compared with the sentencepiece library,
batch by batch, and a difference is an error. Parts met before are not merged again.

Null and empty texts have the end id alone. Repeated rows and ids give a row
each, other columns are ignored, an empty table gives no row. A text of any
length is held whole in one task, some 100 bytes a character, 300 if it has no cut.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe.llm.token_ids import public_tokenizer

BLANK = "▁"
#: Parts of more characters are merged one by one.
LONG = 48
BLOCK_BYTES = 4 << 20
CHECKED_AT_ONCE = 4000
#: Parts whose ids a task remembers from batch to batch.
KEPT_PARTS = 400_000

_NONE = np.int64(np.iinfo(np.int64).max)
#: Characters below this have their pairs in a table.
_NEAR = 0x300


def _ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places of all runs (start, count), one after the other."""
    ends = np.cumsum(counts)
    return np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<i4")


class PieceVocabulary:
    """Pieces with ids and ranks, the merges they allow, and the library's own processor.

    A symbol is a piece or a single character of one; 0 stands for none.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = sp = SentencePieceProcessor(model_file=path)
        count = sp.get_piece_size()
        if any(sp.is_unused(i) for i in range(count)):
            raise ValueError("a vocabulary with unused pieces needs its merges undone, which this encoder does not do")
        special = lambda i: sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)
        self.ids = {sp.id_to_piece(i): i for i in range(count) if not special(i)}
        self.bytes = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(count) if sp.is_byte(i)}
        self.unknown, self.end = sp.unk_id(), sp.eos_id()
        scores = {piece: sp.get_score(i) for piece, i in self.ids.items()}
        # Equal scores share a rank, so that place decides between them.
        turn = {score: n for n, score in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = {piece: turn[score] for piece, score in scores.items()}
        longer = [piece for piece in self.ids if len(piece) > 1]
        letters = {c for piece in longer for c in piece}
        self.apart = next(c for c in "\n\x01\x02\x03" if c not in letters)
        self._number_symbols(longer, letters)
        self._table_of_pairs(longer)
        self._forget()

    def _forget(self) -> None:
        self.kept = pa.array([], pa.large_binary())
        self.kept_ids, self.kept_counts = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def _number_symbols(self, longer: list[str], letters: set[str]) -> None:
        names = sorted(letters | set(self.ids))
        symbol = {name: k for k, name in enumerate(names, 1)}
        self.symbols = len(names) + 1
        self.first_symbol = np.zeros(0x110000, np.int32)
        self.ids_of_symbol = [[]] + [self._ids_of(name) for name in names]
        for name in names:
            if len(name) == 1:
                self.first_symbol[ord(name)] = symbol[name]
        merges = {}
        for piece in longer:
            for at in range(1, len(piece)):
                left, right = symbol.get(piece[:at]), symbol.get(piece[at:])
                if left and right:
                    merges[left * self.symbols + right] = (self.rank[piece], symbol[piece])
        self.merge_keys = np.array(sorted(merges), np.int64)
        self.merge_rank, self.merge_symbol = (np.array([merges[key][i] for key in sorted(merges)], np.int64) for i in (0, 1))

    def _table_of_pairs(self, longer: list[str]) -> None:
        """Which characters stand side by side in some piece."""
        pairs = sorted({(ord(a), ord(b)) for piece in longer for a, b in zip(piece, piece[1:])})
        self.far_pairs = np.array([a << 21 | b for a, b in pairs], np.int64)
        self.near_pairs = np.zeros((_NEAR, _NEAR), bool)
        for a, b in pairs:
            if max(a, b) < _NEAR:
                self.near_pairs[a, b] = True

    def _ids_of(self, symbol: str) -> list[int]:
        if symbol in self.ids:
            return [self.ids[symbol]]
        return [self.bytes[byte] for byte in symbol.encode()] if self.bytes else [self.unknown]

    def joined(self, points: np.ndarray) -> np.ndarray:
        """Whether each character and the next one stand side by side in some piece."""
        a, b = points[:-1], points[1:]
        near = np.maximum(a, b) < _NEAR
        out = np.zeros(len(a), bool)
        out[near] = self.near_pairs[a[near], b[near]]
        far = np.flatnonzero(~near)
        key = a[far].astype(np.int64) << 21 | b[far]
        place = np.minimum(np.searchsorted(self.far_pairs, key), len(self.far_pairs) - 1)
        out[far] = self.far_pairs[place] == key
        return out

    def merge(self, text: str) -> list[int]:
        """Ids of one part by a heap of its adjacent pairs."""
        rank, size = self.rank, len(text)
        symbols: list[str | None] = list(text)
        before, after = array("q", range(-1, size - 1)), array("q", range(1, size + 1))
        # An entry is rank and place in one number: the least is the next merge.
        agenda = [rank[a + b] * size + i for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in rank]
        heapify(agenda)
        while agenda:
            entry = heappop(agenda)
            at = entry % size
            left, right = symbols[at], after[at]
            # Out of date where the pair is gone or has become another.
            if left is None or right == size or rank.get(left + symbols[right]) != entry // size:
                continue
            symbols[at] = left = left + symbols[right]
            symbols[right] = None
            after[at] = right = after[right]
            if right < size:
                before[right] = at
                found = rank.get(left + symbols[right])
                if found is not None:
                    heappush(agenda, found * size + at)
            if at:
                found = rank.get(symbols[before[at]] + left)
                if found is not None:
                    heappush(agenda, found * size + before[at])
        return [i for symbol in symbols if symbol is not None for i in self._ids_of(symbol)]

    def merge_all(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge many parts at once; gives the symbols left and their number in each part.

        The agenda is an array with an entry for each place, its pair's rank
        and the place; a round merges the least entry of every part. One place
        without a symbol follows each part, so no pair goes beyond it.
        """
        starts = np.cumsum(lengths + 1) - lengths - 1
        held = np.zeros(len(symbols) + len(lengths) + 1, np.int64)
        held[_ragged(starts, lengths)] = symbols
        before, after = np.arange(-1, len(held) - 1), np.minimum(np.arange(1, len(held) + 1), len(held) - 1)
        agenda, becomes = np.full(len(held), _NONE), np.zeros(len(held), np.int64)

        def enter(at: np.ndarray) -> None:
            key = held[at] * self.symbols + held[after[at]]
            place = np.minimum(np.searchsorted(self.merge_keys, key), len(self.merge_keys) - 1)
            hit = (self.merge_keys[place] == key) & (held[at] > 0)
            agenda[at] = np.where(hit, self.merge_rank[place] << 40 | at, _NONE)
            becomes[at] = self.merge_symbol[place]

        enter(np.flatnonzero(held))
        while len(starts):
            least = np.minimum.reduceat(agenda, starts)
            at = least[least != _NONE] & ((1 << 40) - 1)
            if not len(at):
                break
            gone = after[at]
            held[at], held[gone], agenda[gone] = becomes[at], 0, _NONE
            after[at] = after[gone]
            before[after[at]] = at
            enter(at)
            enter(before[at][before[at] >= 0])
        kept = held > 0
        return held[kept], np.add.reduceat(kept, starts).astype(np.int64) if len(starts) else np.zeros(0, np.int64)

    def _ids_of_parts(self, points: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts, one after the other, and the number of each part."""
        starts = np.cumsum(lengths) - lengths
        # Characters of no piece are symbols of this batch.
        strange = np.unique(points[self.first_symbol[points] == 0])
        long = np.flatnonzero(lengths > LONG)
        outs = [*self.ids_of_symbol, *(self._ids_of(chr(p)) for p in strange.tolist())]
        outs += [self.merge(points[starts[k] : starts[k] + lengths[k]].tobytes().decode("utf-32-le")) for k in long.tolist()]
        first = self.first_symbol[points].astype(np.int64)
        own = first == 0
        first[own] = self.symbols + np.searchsorted(strange, points[own])
        # A long part stands as one symbol that is merged already.
        short = np.where(lengths > LONG, 1, lengths)
        symbols = first[_ragged(starts, short)]
        symbols[(np.cumsum(short) - short)[long]] = self.symbols + len(strange) + np.arange(len(long))
        symbols, left = self.merge_all(symbols, short)
        sizes = np.array([len(ids) for ids in outs], np.int64)
        flat = np.array([i for ids in outs for i in ids], np.int32)
        ids = flat[_ragged((np.cumsum(sizes) - sizes)[symbols], sizes[symbols])]
        done = np.concatenate([[0], np.cumsum(sizes[symbols])])[np.concatenate([[0], np.cumsum(left)])]
        return ids, np.diff(done)

    def _check(self, points: np.ndarray, lengths: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """The library has to give the same ids for all parts."""
        divider = np.array(self.merge(self.apart), np.int32)
        for low in range(0, len(lengths), CHECKED_AT_ONCE):
            size, count = lengths[low : low + CHECKED_AT_ONCE], counts[low : low + CHECKED_AT_ONCE]
            begin, at = lengths[:low].sum(), counts[:low].sum()
            text = np.insert(points[begin : begin + size.sum()], np.cumsum(size) - size, ord(self.apart)).tobytes().decode("utf-32-le")
            expected = np.insert(ids[at : at + count.sum()], np.repeat(np.cumsum(count) - count, len(divider)), np.tile(divider, len(count)))
            found = np.array(self.library.encode(text), np.int32)
            if not np.array_equal(found[max(0, len(found) - len(expected)) :], expected):
                raise ValueError("the library merges otherwise; the vocabulary is not one of merges")

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, each closed by the end id, and n + 1 offsets."""
        whole = [self.library.normalize(text) if text else "" for text in texts]
        points = _code_points("".join(whole))
        bounds = np.concatenate([[0], np.cumsum([len(text) for text in whole])])
        cut = np.ones(len(points) + 1, bool)
        if len(points):
            cut[1:-1] = ~self.joined(points)
            cut[bounds] = True
        edges = np.flatnonzero(cut) if len(points) else np.zeros(1, np.int64)
        parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges * 4), pa.py_buffer(points)])
        coded = parts.dictionary_encode()
        place = self._places(coded.dictionary)
        # The end id is one more part, put after the last of each text.
        counts = np.append(self.kept_counts, 1)
        starts = np.cumsum(counts) - counts
        last = np.searchsorted(edges, bounds[1:])
        order = np.insert(place[coded.indices.to_numpy()], last, len(counts) - 1)
        sizes = np.concatenate([[0], np.cumsum(counts[order])])
        ends = sizes[last + np.arange(1, len(texts) + 1)]
        ids = np.append(self.kept_ids, np.int32(self.end))[_ragged(starts[order], counts[order])]
        if len(self.kept) > KEPT_PARTS:
            self._forget()
        return ids, np.concatenate([[0], ends])

    def _places(self, parts: pa.LargeBinaryArray) -> np.ndarray:
        """Where the ids of distinct parts are kept; those not met before are merged and checked first."""
        found = pc.index_in(parts, value_set=self.kept)
        new = parts.filter(found.is_null())
        place = found.fill_null(-1).to_numpy().astype(np.int64)
        place[place < 0] = len(self.kept) + np.arange(len(new))
        if len(new):
            at = np.frombuffer(new.buffers()[1], np.int64)[new.offset : new.offset + len(new) + 1]
            points = np.frombuffer(new.buffers()[2], "<i4")[at[0] // 4 : at[-1] // 4]
            lengths = np.diff(at) // 4
            ids, counts = self._ids_of_parts(points, lengths)
            self._check(points, lengths, ids, counts)
            self.kept = pa.concat_arrays([self.kept, new])
            self.kept_ids, self.kept_counts = np.append(self.kept_ids, ids), np.append(self.kept_counts, counts)
        return place


_loaded: dict[str, PieceVocabulary] = {}


def vocabulary(path: str) -> PieceVocabulary:
    if path not in _loaded:
        _loaded[path] = PieceVocabulary(path)
    return _loaded[path]


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about 4 MB each, so that few texts are Python strings at a time."""
    step = max(1, int(batch.num_rows * BLOCK_BYTES / max(1, batch.nbytes)))
    for low in range(0, batch.num_rows, step):
        yield batch.slice(low, step)


def _encode(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for whole in batches:
            for batch in _blocks(whole):
                ids, offsets = words.encode([t or "" for t in batch.column(1).to_pylist()])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "ids"])

    return encode


def encode_texts(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id`` and ``ids`` of every whole text, closed by the end id."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_encode(model), f"doc_id {kind}, ids array<int>")


def _decode(path: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = vocabulary(path).library
        for whole in batches:
            for batch in _blocks(whole):
                texts = library.decode([ids or [] for ids in batch.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])

    return decode


def decode_ids(rows: DataFrame, model: str) -> DataFrame:
    """``rows`` (``doc_id``, ``ids``) with the text ``decoded`` that the library makes of the ids.

    Null and empty lists give an empty text.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "ids").mapInArrow(_decode(model), f"doc_id {kind}, ids array<int>, decoded string")


def op13_piece_tokens(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizer("piece_bpe_32k.model")
    rows = decode_ids(encode_texts(spark.read.parquet(f"{folder}/documents.parquet"), model), model)
    return rows.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
