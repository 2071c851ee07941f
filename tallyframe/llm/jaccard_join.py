"""N-gram Jaccard join with prefixes of token combinations.

Tokens are hashed word shingles in one global order: rare ones first, then
frequent classes. A set's prefix is extended until its signatures cannot all be
missed by a set that is similar enough: a rare token is a signature by itself,
tokens of a frequent class count in combinations of k, of which c tokens make
c - k + 1 that differ. Two similar sets then share a signature. Equal sets are
one class before anything else, and only components are sought, so a group of
a signature is checked against one of its sets first and pair by pair only
where its sets are not yet connected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window as W

from tallyframe.llm import vec
from tallyframe.llm.components import components
from tallyframe.plans.lineage import materialize

U64 = vec.U64
#: Tokens are counted in runs of so many; those seen thrice in one may be frequent.
RUN_TOKENS, LEAST_IN_RUN = 4 << 20, 3
#: At most this many tokens are frequent: the least count is the sum of counts over it.
MOST_FREQUENT, LEAST_COUNT, NEXT_CLASS = 1_000_000, 8, 16
#: Tokens of a frequent class are dealt into parts, about one for each 16 tokens of a set.
PART_TOKENS = 16
BITMAP_LONGS = 32
#: So many ids (8 bytes each) may be sent to every task.
BROADCAST_IDS = 1_000_000
#: Steps to the partners of a class in a group that is not connected yet.
PARTNERS = (1, 2, 4, 8)
#: A task writes about so many rows, or of rows with texts and bitmaps so many.
ROWS_IN_TASK, WIDE_ROWS_IN_TASK = 500_000, 2_000
BITS = [f"b{k}" for k in range(BITMAP_LONGS)]
#: The bitmap folded to 256 bits, for rows of which there are many.
FOLDS = [f"f{k}" for k in range(4)]


def _dealt(df: DataFrame, rows: int, each: int) -> DataFrame:
    """``df`` in tasks by its measured size: for small tables a file for each shuffle partition costs more than the rows."""
    least = 2 * df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(least, -(-rows // each)))


# -- sets -----------------------------------------------------------------


def sets_of(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in ascending order, and n + 1 offsets."""
    low = vec.lowered(data)
    starts, ends, words = vec.words(low, offsets)
    made, at = vec.shingles(vec.span_hashes(low, starts, ends), words, size)
    text = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(at))
    order = np.argsort(made, kind="stable")
    order = order[np.argsort(text[order], kind="stable")]
    made, text = made[order], text[order]
    fresh = np.ones(len(made), bool)
    fresh[1:] = (made[1:] != made[:-1]) | (text[1:] != text[:-1])
    made, text = made[fresh], text[fresh]
    return made, np.searchsorted(text, np.arange(len(offsets)))


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.zeros(len(at) - 1, U64)
    full = np.flatnonzero(np.diff(at))
    if len(full):
        out[full] = np.add.reduceat(values, at[:-1][full])
    return out


def digests(made: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set."""
    with np.errstate(over="ignore"):
        size = np.diff(at).astype(U64)
        return vec.mix(_sums(vec.mix(made ^ U64(0x1234567)), at) + size), vec.mix(_sums(vec.mix(made + U64(0x89ABCDEF)), at) ^ size)


def _parts(batch: pa.RecordBatch, index: int, size: int):
    data, offsets = vec.string_bytes(batch.column(index))
    for low, high in vec.chunks(offsets):
        made, at = sets_of(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], size)
        yield low, high, made, at


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def bitmaps(made: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A row of longs for each set: the parity of its tokens by place."""
    places, rows = 64 * BITMAP_LONGS, len(at) - 1
    text = np.repeat(np.arange(rows), np.diff(at))
    odd = np.bincount(text * places + ((made >> U64(7)) % U64(places)).astype(np.int64), minlength=rows * places) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.int64).reshape(rows, BITMAP_LONGS)


def _scan(size: int):
    """Rows of documents (kind 0: size, digests and bitmap) and of tokens that are often met (kind 1: token and count)."""

    def often(tokens: list[np.ndarray], like: pa.DataType) -> pa.RecordBatch:
        found, count = np.unique(np.concatenate(tokens), return_counts=True)
        found, count = found[count >= LEAST_IN_RUN], count[count >= LEAST_IN_RUN]
        none = pa.nulls(len(found), like)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ones(len(found), np.int32)), none, pa.nulls(len(found), pa.int64()), pa.array(count.astype(np.int64)), _signed(found), *[pa.nulls(len(found), pa.int64())] * (1 + BITMAP_LONGS)],
            names=["kind", "doc_id", "text_hash", "n", "cls", "check", *BITS],
        )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, tokens, held, like = set(), [], 0, pa.int64()
        for batch in batches:
            like = batch.column(0).type
            for low, high, made, at in _parts(batch, 1, size):
                one, two = digests(made, at)
                bits = np.ascontiguousarray(bitmaps(made, at).T)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(high - low, np.int32)), *(batch.column(i).slice(low, high - low) for i in (0, 2)), pa.array(np.diff(at)), _signed(one), _signed(two), *map(pa.array, bits)],
                    names=["kind", "doc_id", "text_hash", "n", "cls", "check", *BITS],
                )
                new = [i for i, d in enumerate(one.tolist()) if not (d in seen or seen.add(d))]
                tokens += [made[at[i] : at[i + 1]] for i in new]
                held += int(sum(at[i + 1] - at[i] for i in new))
                if held >= RUN_TOKENS:
                    yield often(tokens, like)
                    seen, tokens, held = set(), [], 0
        if tokens:
            yield often(tokens, like)

    return scan


# -- signatures -----------------------------------------------------------


def missing(n, percent: int):
    """Tokens of a set of ``n`` that a similar one may lack."""
    return n * (100 - percent) // 100


def links_apart(n, percent: int):
    """Whether a set of ``n`` can link with an unequal one: it lacks a token of that, or that one of it."""
    return n * 100 // percent > n


def combined(parts: list[list[int]], k: int, salt: int) -> list[int]:
    """A value for each combination of k tokens of one part."""
    return [(sum(c) + salt) & 0xFFFFFFFFFFFFFFFF for part in parts for c in combinations(part, k)]


def frequent_signatures(tokens: list[tuple[int, int]], need: int, scale: int) -> list[int]:
    """Signatures from frequent tokens ((class k, hash) in order) that cover ``need`` misses.

    Parts are dealt by hash, their number by the scale of the larger set of a pair.
    """
    count = max(1, (1 << scale) // PART_TOKENS)
    parts: dict[int, list[list[int]]] = {}
    for k, token in tokens:
        if need <= 0:
            break
        own = parts.setdefault(k, [[] for _ in range(count)])[(token >> 20) % count]
        own.append(token)
        need -= len(own) >= k
    if need > 0:
        raise ValueError("a set has too few tokens for its signatures")
    return [s for k, own in sorted(parts.items()) for s in combined(own, k, (k << 32) + scale + 1)]


def _index(size: int, percent: int, sent):
    """Rows (sig, cls, n): the signatures of each set; equal sets of a run give them once."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, level = sent.value
        # Most tokens are told apart from frequent ones by their first bits.
        hint = np.zeros(1 << 20, bool)
        hint[(frequent >> U64(44)).astype(np.int64)] = True
        seen: set[int] = set()
        for batch in batches:
            for low, high, made, at in _parts(batch, 0, size):
                one, _ = digests(made, at)
                n = np.diff(at)
                fresh = np.array([not (d in seen or seen.add(d)) for d in one.tolist()], bool) & links_apart(n, percent)
                if len(seen) > 1_000_000:
                    seen.clear()
                need = np.where(fresh, missing(n, percent) + 1, 0)
                text = np.repeat(np.arange(high - low), n)
                klass = np.ones(len(made), np.int64)
                maybe = np.flatnonzero(hint[(made >> U64(44)).astype(np.int64)])
                if len(maybe):
                    place = np.minimum(np.searchsorted(frequent, made[maybe]), len(frequent) - 1)
                    klass[maybe] = np.where(frequent[place] == made[maybe], level[place], 1)
                rare = klass == 1
                rank = np.concatenate([[0], np.cumsum(rare)])
                rank = rank[:-1] - rank[at[:-1]][text]
                taken = rare & (rank < need[text])
                sigs, owner = [made[taken]], [text[taken]]
                have = np.bincount(text[taken], minlength=high - low)
                for i in np.flatnonzero(have < need):
                    own, kinds = made[at[i] : at[i + 1]], klass[at[i] : at[i + 1]]
                    tokens = [(k, t) for k in (2, 3) for t in own[kinds == k].tolist()]
                    scale, last = int(n[i]).bit_length() - 1, (int(n[i]) * 100 // percent).bit_length() - 1
                    for s in range(scale, last + 1):
                        found = vec.mix(np.array(frequent_signatures(tokens, int(need[i] - have[i]), s), U64))
                        sigs.append(found)
                        owner.append(np.full(len(found), i))
                owner = np.concatenate(owner)
                yield pa.RecordBatch.from_arrays(
                    [_signed(np.concatenate(sigs)), _signed(one[owner]), pa.array(n[owner].astype(np.int32))], names=["sig", "cls", "n"]
                )

    return index


def _packed_texts(size: int):
    """Rows (cls, text): the class of each text and the text compressed, which is shorter than its tokens."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(3)
        for batch in batches:
            for low, high, made, at in _parts(batch, 0, size):
                texts = batch.column(0).slice(low, high - low).cast(pa.large_binary())
                raw = [press.compress(text.as_buffer() if text.is_valid else b"") for text in texts]
                yield pa.RecordBatch.from_arrays([_signed(digests(made, at)[0]), pa.array(raw, pa.binary())], names=["cls", "text"])

    return pack


# -- pairs ----------------------------------------------------------------


def _near(n: str, m: str, percent: int) -> Column:
    """Whether two sizes allow the similarity."""
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent)


def _folded() -> list[Column]:
    """Parities of 256 places from those of 2048: no more bits differ than tokens do."""
    return [reduce(Column.bitwiseXOR, [F.col(b) for b in BITS[k :: len(FOLDS)]]).alias(f) for k, f in enumerate(FOLDS)]


def _may_link(left: str, right: str, percent: int, names: list[str] = BITS) -> Column:
    """Whether the bitmaps allow it: tokens that only one has number at least the bits that differ.

    With u the union and d the tokens of only one, u - d >= u * percent / 100
    and u <= (n + m + d) / 2, so d is at most (n + m) * (100 - p) / (100 + p).
    """
    of = lambda side, name: F.col(f"{side}.{name}" if side else name)
    differ = sum((F.bit_count(of(left, b).bitwiseXOR(of(right, b))) for b in names), F.lit(0))
    return differ * (100 + percent) <= (of(left, "n") + of(right, "n")) * (100 - percent)


def _verify(size: int, percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress

        def similar(texts: list[bytes]) -> list[bool]:
            made, at = sets_of(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]), size)
            out = []
            for i in range(0, len(texts), 2):
                both = np.sort(made[at[i] : at[i + 2]], kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                out.append(100 * shared >= percent * (len(both) - shared))
            return out

        for batch in batches:
            same, texts, held = [], [], 0
            for left, right in zip(batch.column(2), batch.column(3)):
                texts += [unpack(left.as_buffer()), unpack(right.as_buffer())]
                held += len(texts[-2]) + len(texts[-1])
                if held >= vec.CHUNK_BYTES:
                    same += similar(texts)
                    texts, held = [], 0
            same += similar(texts) if texts else []
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(same, pa.bool_()))

    return verify


def _possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b) those that sizes and bitmaps allow."""
    bits = classes.select("cls", "n", *BITS)
    l, r = bits.withColumnRenamed("cls", "a").alias("l"), bits.withColumnRenamed("cls", "b").alias("r")
    joined = pairs.join(l, "a").join(r, "b")
    return joined.filter(_may_link("l", "r", percent)).select("a", "b")


def _links(docs: DataFrame, classes: DataFrame, pairs: DataFrame, most: int, size: int, percent: int) -> DataFrame:
    """Of candidate pairs (a, b), about ``most``, those that are similar by their whole sets."""
    pairs = materialize(_dealt(pairs, most, ROWS_IN_TASK))
    count = pairs.count()
    named = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    # The sets are made again where pairs meet, from the text of one document of each class that is asked for.
    wanted = classes.join(named, "cls", "left_semi").select(F.col("least").alias("doc_id"), "cls")
    wanted = materialize(_dealt(wanted, 2 * count, ROWS_IN_TASK))
    some_id = docs.filter("doc_id is null").select("doc_id", "text") if wanted.filter("doc_id is null").limit(1).count() else None
    ids = wanted.select("doc_id")
    # Ids that were counted and are few go to the texts; else the texts go to them.
    asked = ids.count()
    ids = F.broadcast(ids) if asked <= BROADCAST_IDS else ids
    texts = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")
    texts = texts.union(some_id) if some_id is not None else texts
    made = texts.select("text").mapInArrow(_packed_texts(size), "cls bigint, text binary")
    packed = made.join(wanted.select("cls"), "cls", "left_semi").dropDuplicates(["cls"])
    packed = materialize(_dealt(packed, asked, WIDE_ROWS_IN_TASK))
    full = pairs.join(packed.withColumnsRenamed({"cls": "a", "text": "ta"}), "a").join(packed.withColumnsRenamed({"cls": "b", "text": "tb"}), "b")
    full = _dealt(full.select("a", "b", "ta", "tb"), count, WIDE_ROWS_IN_TASK)
    return materialize(full.mapInArrow(_verify(size, percent), "a bigint, b bigint"))


def link_components(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """Components of documents whose shingle sets have a Jaccard similarity of ``percent`` or more.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. Gives
    ``doc_id``, ``text_hash`` (xxhash64 of the text), ``n_shingles``,
    ``class_id`` (digest of the set; equal sets share it), ``root`` (the least
    class of the component; null without a shingle) and ``component_id`` (the
    least doc_id of the component).

    Null, empty and blank texts have no shingle and are linked with nothing.
    Rows that share an id are documents of their own, with one id. A null id
    takes the least id of its component, or null if there is none.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    scanned = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        _scan(size), f"kind int, doc_id {kind}, text_hash bigint, n bigint, cls bigint, check bigint, " + ", ".join(f"{b} bigint" for b in BITS)
    )
    scanned = materialize(scanned)
    rows = scanned.filter("kind = 0").drop("kind", *BITS)
    sets = scanned.filter("kind = 0 and n > 0")
    classes = sets.groupBy("cls").agg(
        F.min("doc_id").alias("least"), F.min("n").alias("n"), F.min("check").alias("check"), F.max("check").alias("last"),
        *(F.min(b).alias(b) for b in BITS),
    )
    one = F.when(F.col("check") == F.col("last"), F.col("cls")).otherwise(F.raise_error(F.lit("two sets with one digest")))
    classes = classes.select(one.alias("cls"), "least", "n", *BITS)
    count = rows.count()
    classes = materialize(_dealt(classes, count, WIDE_ROWS_IN_TASK))
    linked = _linked_classes(docs, scanned, classes, size, percent)
    named = classes.join(linked.withColumnRenamed("node", "cls"), "cls", "left").select("cls", "least", F.coalesce("root", "cls").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = materialize(_dealt(named.join(least, "root").select("cls", "root", "component_id"), count, ROWS_IN_TASK))
    joined = rows.join(by_class, "cls", "left")
    alone = F.col("n") == 0
    return joined.select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), F.col("cls").alias("class_id"), "root",
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def _frequent(scanned: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Frequent tokens in order and their classes; the least count bounds how many there are."""
    counted = scanned.filter("kind = 1").groupBy("cls").agg(F.sum("n").alias("count"))
    total = scanned.filter("kind = 1").agg(F.sum("n")).first()[0] or 0
    least = max(LEAST_COUNT, -(-total // MOST_FREQUENT))
    found = counted.filter(F.col("count") >= least).select("cls", (F.when(F.col("count") >= least * NEXT_CLASS, 3).otherwise(2)).alias("k"))
    table = found.toArrow()  # at most MOST_FREQUENT rows
    tokens = table["cls"].to_numpy().astype(np.int64).view(U64)
    order = np.argsort(tokens)
    return tokens[order], table["k"].to_numpy().astype(np.int64)[order]


def _stars(grouped: DataFrame, shift: float, order: Column, percent: int) -> DataFrame:
    """Pairs (a, b) of each class with one of its group and size step; similar sets are at most a step apart."""
    step = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent) + shift)
    first = F.min(F.struct(order.alias("o"), "cls", "n")).over(W.partitionBy("sig", step))
    paired = grouped.withColumn("pivot", first).filter(F.col("cls") != F.col("pivot.cls"))
    paired = paired.withColumn("pivot_n", F.col("pivot.n")).filter(_near("n", "pivot_n", percent))
    return paired.select(F.least("cls", "pivot.cls").alias("a"), F.greatest("cls", "pivot.cls").alias("b"))


def _open_groups(grouped: DataFrame, roots: DataFrame, classes: DataFrame, bits: list) -> DataFrame:
    """Rows (sig, cls, root, n, bitmap) of groups in more than one component; groups of the same classes once."""
    rooted = grouped.join(roots.withColumnRenamed("node", "cls"), "cls", "left").select("sig", "cls", F.coalesce("root", "cls").alias("root"))
    members = F.struct(F.count("*"), F.bit_xor(F.xxhash64("cls")), F.bit_xor(F.xxhash64("cls", F.lit(1))))
    summed = rooted.groupBy("sig").agg(F.min("root").alias("low"), F.max("root").alias("high"), members.alias("members"))
    open_sigs = summed.filter("low <> high").groupBy("members").agg(F.min("sig").alias("sig")).select("sig")
    return rooted.join(open_sigs, "sig", "left_semi").join(classes.select("cls", "n", *bits), "cls")


def _partners(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of each class with those some steps after it that sizes and bitmaps allow."""
    order = W.partitionBy("sig").orderBy(F.xxhash64("cls", "sig"))
    own = F.struct("cls", "root", "n", *FOLDS)
    rows = rows.withColumns({f"p{k}": F.lead(own, k).over(order) for k in PARTNERS})
    found = []
    for k in PARTNERS:
        fits = (F.col("root") != F.col(f"p{k}.root")) & _near("n", f"p{k}.n", percent) & _may_link("", f"p{k}", percent, FOLDS)
        pair = F.struct(F.least("cls", f"p{k}.cls").alias("a"), F.greatest("cls", f"p{k}.cls").alias("b"))
        found.append(F.when(fits, pair))
    pairs = rows.select(F.explode(F.array_compact(F.array(*found))).alias("p"))
    return pairs.select("p.a", "p.b").distinct()


def _linked_classes(docs: DataFrame, scanned: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """(node, root) of the classes that are linked with another."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(_frequent(scanned))
    index = docs.select("text").mapInArrow(_index(size, percent, sent), "sig bigint, cls bigint, n int")
    group = W.partitionBy("sig")
    several = F.min("cls").over(group) != F.max("cls").over(group)
    grouped = index.withColumn("several", several).filter("several").select("sig", "cls", "n").distinct()
    # About as many signatures as the sets need; what a group shares is less.
    needed = classes.agg(F.sum(F.col("n") * (100 - percent) / 100 + 1)).first()[0] or 0
    grouped = materialize(_dealt(grouped, int(needed), ROWS_IN_TASK))
    met = grouped.count()
    star = _stars(grouped, 0.0, F.col("cls"), percent).union(_stars(grouped, 0.5, F.xxhash64("cls"), percent)).distinct()
    links = _links(docs, classes, _possible(star, classes, percent), met, size, percent)
    roots = components(links)
    # In groups that are not yet in one component each class meets a few others
    # in an order of the group's own, which connects most that belong together.
    near = _partners(_open_groups(grouped, roots, classes, _folded()), percent)
    links = links.union(_links(docs, classes, _possible(near, classes, percent), met, size, percent))
    roots = components(links)
    # What is still apart is checked pair by pair.
    left_open = materialize(_dealt(_open_groups(grouped, roots, classes, BITS), met, ROWS_IN_TASK))
    l, r = left_open.alias("l"), left_open.alias("r")
    on = (
        (F.col("l.sig") == F.col("r.sig")) & (F.col("l.cls") < F.col("r.cls")) & (F.col("l.root") != F.col("r.root"))
        & _near("l.n", "r.n", percent) & _may_link("l", "r", percent)
    )
    cross = l.join(r, on).select(F.col("l.cls").alias("a"), F.col("r.cls").alias("b")).distinct()
    more = _links(docs, classes, cross, met, size, percent)
    every = more.union(roots.filter("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b")))
    return components(every) if more.limit(1).count() else roots


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component: the least id, then the least text hash.

    All columns are kept. Texts without a shingle are linked with nothing and
    all stay.
    """
    found = link_components(docs, size, percent)
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    # Null ids come last.
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    first = found.filter("root is not null").groupBy("root").agg(F.min(order).alias("f")).select("f.doc_id", "f.text_hash")
    first = first.select(id_text.alias("__id"), F.col("text_hash").alias("__text"), F.lit(True).alias("__first"))
    alone = found.filter("root is null").select(id_text.alias("__id"), F.col("text_hash").alias("__text"), F.lit(False).alias("__first")).distinct()
    keyed = docs.withColumns({"__id": id_text, "__text": F.xxhash64("text")})
    same = W.partitionBy("__id", "__text").orderBy(F.lit(0))
    kept = keyed.join(first.union(alone), ["__id", "__text"]).withColumn("__nth", F.row_number().over(same))
    # Of equal rows one stays, as they are in one component.
    return kept.filter("not __first or __nth = 1").select(*docs.columns)


def op1_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    found = link_components(spark.read.parquet(f"{folder}/documents.parquet"))
    return found.select("doc_id", "n_shingles", "component_id", "class_id")
