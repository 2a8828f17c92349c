"""N-gram Jaccard join by vertical partitioning.

The n-grams of all documents have one global order: rare before frequent, then by hash. It is cut into
cells, so a document's set falls into small fragments that line up with those of every other document. Two
sets that are similar enough differ in at most D elements, hence in at most D cells: among the first D + 1
cells that hold anything, in the global order, each such pair has one in common whose content is equal.
These cells come from the rare end of the order, where only similar documents agree.

Documents with equal sets are one representative. A pair of representatives is first judged by the sizes
of its fragments: the smaller of two fragments bounds their overlap, and the sum of the bounds rules out most
pairs. The others are counted: each of ``FRAGMENTS`` parts of the order gives a partial overlap, and the
parts are summed per pair.

No group is expanded into all its pairs. Where a cell joins two representatives, that pair is counted;
where it joins more, each is paired with the smallest. Only if that leaves the members of such a cell in
several components are they compared with each other. Up to ``FEW`` members give the pairs that cross components,
once for all cells that have them. More are compared by sizes in blocks of bounded size; a block gives the
pairs that are left if these are few for its members, else its members, which are then compared in full,
fragment after fragment, for no more links than it takes to join them. So every component is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_schema, by_batch, cut, slices, small, table, to_batch
from tidemark.llm.simhash import components

SHINGLE_WORDS = 3
#: Linked if 100 * intersection >= PERCENT * union.
PERCENT = 90
#: N-grams are counted in so many slots by their hash; the order needs no more than a rough frequency.
SLOT_BITS = 20
#: The order has at least so many cells for each element in which a linked set may differ: larger cells agree by chance less often.
CELLS_PER_DIFFERENCE, LEAST_CELL_BITS = 2, 4
#: Parts of the order in which overlaps are counted separately.
FRAGMENTS = 8
#: A set has about one part for every so many elements whose sizes are noted, and at least 2 ^ LEAST_SIZE_BITS parts.
ELEMENTS_PER_SIZE, LEAST_SIZE_BITS = 2, 6
#: Blocks of a group that is compared in full: n-grams and members that one holds about.
BLOCK_GRAMS, BLOCK_MEMBERS = 1 << 20, 1024
#: Members of a cell that are paired one by one, and pairs for each member that a block gives at most.
FEW, PAIRS_PER_MEMBER = 16, 8
#: Ids of rows whose n-grams are wanted again, as far as they are sent to the tasks that read the texts.
WANTED_ROWS = 2_000_000

MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))
DIGESTS = "doc_id long, n long, set_key binary, sizes binary, cells array<long>"
LINK = "a long, b long"


def scramble(x: np.ndarray, by: np.uint64) -> np.ndarray:
    x = x * by
    x ^= x >> np.uint64(29)
    return x


def gram_set(text: str | None) -> np.ndarray:
    """The distinct n-grams as sorted 64-bit hashes."""
    words = (text or "").encode().lower().split()  # of bytes: ASCII case and white space only
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    k = min(SHINGLE_WORDS, len(words))
    # A sequence shorter than a shingle differs from every shingle by its length.
    grams = np.full(len(words) - k + 1, k, dtype=np.uint64)
    for at in range(k):
        grams = scramble(grams + hashes[at : at + len(grams)], MIX[at % 3])
    grams = np.sort(scramble(grams, MIX[3]))
    return grams[np.concatenate(([True], grams[1:] != grams[:-1]))]


def slot(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def slot_counts(docs: DataFrame) -> DataFrame:
    """(slot, n): how many n-grams of all rows fall into each slot, counted in every task before the shuffle."""
    schema = arrow_schema("slot long, n long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SLOT_BITS, dtype=np.int64)
        for batch in batches:
            for part in slices(batch):
                found = [slot(gram_set(t)) for t in part.column("text").to_pylist()]
                counts += np.bincount(np.concatenate(found), minlength=len(counts))
        used = np.flatnonzero(counts)
        for at in range(0, len(used), 1 << 16):
            some = used[at : at + (1 << 16)]
            yield to_batch({"slot": pa.array(some), "n": pa.array(counts[some])}, schema)

    return docs.select("text").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))


def bands(docs: DataFrame) -> bytes:
    """One byte per slot, a megabyte in all: the frequency of its n-grams in steps of four, from the mean on."""
    rows = slot_counts(docs).toArrow()  # 2^SLOT_BITS rows at most
    counts = np.zeros(1 << SLOT_BITS)
    counts[rows.column("slot").to_numpy()] = rows.column("n").to_numpy()
    mean = max(1.0, counts.mean())
    return np.floor(np.log2(np.maximum(counts / mean, 1.0)) / 2).astype(np.uint8).tobytes()


def most_differing(n: int) -> int:
    """In how many elements a set of n and one linked to it can differ; the larger one has n * 100 / PERCENT at most."""
    larger = n * 100 // PERCENT
    return (n + larger) * (100 - PERCENT) // (100 + PERCENT)


def cell_bits(n: int) -> int:
    return max(LEAST_CELL_BITS, (CELLS_PER_DIFFERENCE * (most_differing(n) + 1) - 1).bit_length())


def cells(grams: np.ndarray, band: np.ndarray) -> np.ndarray:
    """Hashes of the first cells of a set with their content, as many as may differ and one more.

    The fineness of the cells follows from the size; next to a bound between two of them a set has both,
    as a smaller partner may have the coarser one. If fewer cells hold anything than may differ, they all
    are given, with a mark that all such sets share.
    """
    n, differing = len(grams), most_differing(len(grams))
    if not differing:
        return np.empty(0, dtype=np.int64)  # linked with equal sets only
    mixed, own = scramble(grams, MIX[1]), scramble(grams, MIX[2])
    high = band[slot(grams)].astype(np.uint64) << np.uint64(48)
    out = []
    for bits in range(cell_bits(-(-n * PERCENT // 100)), cell_bits(n) + 1):
        cell = high | (mixed >> np.uint64(64 - bits))
        order = np.argsort(cell, kind="stable")
        cell = cell[order]
        starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
        content = np.add.reduceat(own[order], starts)
        head = starts[: differing + 1]
        out.append(scramble(content[: len(head)] ^ scramble(cell[head] + np.uint64(bits), MIX[0]), MIX[3]))
        if len(starts) <= differing:
            out.append(np.array([bits], dtype=np.uint64))
    return np.concatenate(out).view(np.int64)


def part_sizes(grams: np.ndarray) -> bytes:
    """How many elements fall into each of a power of two of parts, up to 255; twice as many parts are these cut in two."""
    bits = max(LEAST_SIZE_BITS, (len(grams) // ELEMENTS_PER_SIZE).bit_length())
    part = (scramble(grams, MIX[0]) >> np.uint64(64 - bits)).astype(np.int64)
    return np.minimum(np.bincount(part, minlength=1 << bits), 255).astype(np.uint8).tobytes()


def folded(sizes: bytes, parts: int) -> np.ndarray:
    """Sizes as if there were only so many parts."""
    found = np.frombuffer(sizes, dtype=np.uint8).astype(np.int16)
    return np.minimum(found.reshape(parts, -1).sum(axis=1), 255).astype(np.int16)


def may_link(difference: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Sets that differ in at least so many elements can't be linked where this is false."""
    return difference * (100 + PERCENT) <= (n_a + n_b) * (100 - PERCENT)


def digests(docs: DataFrame, band_bytes: bytes) -> DataFrame:
    """Per row the size of its set, a digest of the set and the sizes of its parts (null if empty), and its cells."""
    shared = docs.sparkSession.sparkContext.broadcast(band_bytes)
    state: list[np.ndarray] = []

    def run(batch: pa.RecordBatch) -> dict:
        if not state:
            state.append(np.frombuffer(shared.value, dtype=np.uint8))
        sets = [gram_set(t) for t in batch.column("text").to_pylist()]
        found = [cells(s, state[0]) for s in sets]
        offsets = np.cumsum([0, *map(len, found)], dtype=np.int32)
        return {
            "doc_id": batch.column("doc_id"),
            "n": [len(s) for s in sets],
            "set_key": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
            "sizes": [part_sizes(s) if len(s) else None for s in sets],
            "cells": pa.ListArray.from_arrays(offsets, np.concatenate([*found, np.empty(0, dtype=np.int64)])),
        }

    return by_batch(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, DIGESTS, 200)


def fragments(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(rep, fragment, n, grams) of the representatives ``wanted`` (rep, set_key, low), from one of their rows each."""
    schema = "set_key binary, fragment int, n long, grams array<long>"
    ids = wanted.select(F.col("low").alias("wanted_id")).distinct()
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = found.join(small(cut(ids), WANTED_ROWS), F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi")

    def run(batch: pa.RecordBatch) -> dict:
        keys, numbers, sizes, parts = [], [], [], []
        for text in batch.column("text").to_pylist():
            grams = gram_set(text)
            if not len(grams):
                continue
            key = hashlib.blake2b(grams.tobytes(), digest_size=16).digest()
            bounds = np.searchsorted(grams >> np.uint64(32), np.arange(FRAGMENTS + 1) * ((1 << 32) // FRAGMENTS))
            for k in range(FRAGMENTS):
                keys.append(key)
                numbers.append(k)
                sizes.append(len(grams))
                parts.append(grams[bounds[k] : bounds[k + 1]].view(np.int64))
        offsets = np.cumsum([0, *map(len, parts)], dtype=np.int32)
        flat = np.concatenate([*parts, np.empty(0, dtype=np.int64)])
        return {"set_key": keys, "fragment": numbers, "n": sizes, "grams": pa.ListArray.from_arrays(offsets, flat)}

    rows = by_batch(found.select("text"), run, schema, 200)
    keys = small(cut(wanted.select("rep", "set_key")), WANTED_ROWS)
    # Rows that repeat an id may give a set twice. The joins that follow are by the same key.
    return cut(rows.join(keys, "set_key").drop("set_key").repartition("rep").dropDuplicates(["rep", "fragment"]))


def possible_pairs(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs (a, b) that the sizes of their parts don't rule out."""
    ids = pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))).distinct()
    known = reps.select("rep", "n", "sizes").join(small(cut(ids), WANTED_ROWS), "rep", "left_semi")
    left, right = (known.select(F.col("rep").alias(x), F.col("n").alias(f"n_{x}"), F.col("sizes").alias(f"sizes_{x}")) for x in "ab")
    sized = pairs.join(left, "a").join(right, "b").where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * PERCENT)

    def run(batch: pa.RecordBatch) -> dict:
        n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
        difference = np.empty(batch.num_rows, dtype=np.int64)
        for i, (x, y) in enumerate(zip(batch.column("sizes_a").to_pylist(), batch.column("sizes_b").to_pylist())):
            parts = min(len(x), len(y))
            difference[i] = np.abs(folded(x, parts) - folded(y, parts)).sum(dtype=np.int64)
        near = may_link(difference, n_a, n_b)
        return {c: pa.array(batch.column(c).to_numpy()[near]) for c in ("a", "b")}

    return by_batch(sized.select("a", "b", "n_a", "n_b", "sizes_a", "sizes_b"), run, LINK)


def linked(overlap: Column, n_a: Column, n_b: Column) -> Column:
    return overlap * 100 >= (n_a + n_b - overlap) * PERCENT


def count_pairs(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """The pairs (a, b) that are linked: partial overlaps per fragment, summed per pair."""
    left = parts.select(F.col("rep").alias("a"), "fragment", F.col("n").alias("n_a"), F.col("grams").alias("grams_a"))
    right = parts.select(F.col("rep").alias("b"), "fragment", F.col("n").alias("n_b"), F.col("grams").alias("grams_b"))
    partial = pairs.join(left, "a").join(right, ["b", "fragment"])
    partial = partial.select("a", "b", "n_a", "n_b", F.size(F.array_intersect("grams_a", "grams_b")).alias("overlap"))
    summed = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("overlap").alias("overlap"))
    return summed.where(linked(F.col("overlap"), F.col("n_a"), F.col("n_b"))).select("a", "b")


def compare_block(reps: np.ndarray, roots: np.ndarray, sets: list[list[np.ndarray]]) -> list[tuple[int, int]]:
    """Links that join the members of a block as all its linked pairs do, given each member's component so far.

    Fragment after fragment, the n-grams that at least two members have become columns of a matrix; its
    product with itself gives the partial overlaps, which are added up.
    """
    k = len(reps)
    total = np.zeros((k, k), dtype=np.float32)
    for fragment in zip(*sets):
        owner = np.repeat(np.arange(k), [len(s) for s in fragment])
        values, column, times = np.unique(np.concatenate(fragment), return_inverse=True, return_counts=True)
        number = np.cumsum(times > 1) - 1
        many = times[column] > 1
        owner, column = owner[many], number[column[many]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        width = 2048
        for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            a, b = np.searchsorted(column, (first, first + width))
            block = np.zeros((k, width), dtype=np.float32)
            block[owner[a:b], column[a:b] - first] = 1
            total += block @ block.T
    n = np.array([sum(map(len, s)) for s in sets], dtype=np.float32)
    near = total * (100 + PERCENT) >= (n[:, None] + n[None, :]) * PERCENT
    near &= roots[:, None] != roots[None, :]
    group = {r: r for r in roots.tolist()}

    def top(r: int) -> int:
        while group[r] != r:
            group[r] = group[group[r]]
            r = group[r]
        return r

    found = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(np.triu(near, 1)))):
        a, b = top(int(roots[i])), top(int(roots[j]))
        if a != b:
            group[max(a, b)] = min(a, b)
            x, y = int(reps[i]), int(reps[j])
            found.append((min(x, y), max(x, y)))
    return found


def near_pairs(sizes: list[bytes], n: np.ndarray, roots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which members of a block may be linked with a member of another component, by the sizes of their parts."""
    parts = min(map(len, sizes))
    table = np.stack([folded(s, parts) for s in sizes])
    first, second = [], []
    for i in range(len(sizes) - 1):
        difference = np.abs(table[i + 1 :] - table[i]).sum(axis=1, dtype=np.int64)
        near = i + 1 + np.flatnonzero(may_link(difference, n[i], n[i + 1 :]) & (roots[i + 1 :] != roots[i]))
        first.append(np.full(len(near), i))
        second.append(near)
    none = np.empty(0, dtype=np.int64)
    return np.concatenate([none, *first]), np.concatenate([none, *second])


def open_cells(members: DataFrame) -> DataFrame:
    """(cell, rep, root, k) of the members (cell, rep, root) of cells that are in several components.

    Cells with the same members are one.
    """
    groups = members.groupBy("cell").agg(
        F.count(F.lit(1)).alias("k"),
        F.min("root").alias("low"),
        F.max("root").alias("high"),
        F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("members"),
        F.sum(F.xxhash64("rep", F.lit(1)).cast("decimal(38,0)")).alias("members_again"),
    )
    chosen = groups.where("low <> high").groupBy("k", "members", "members_again").agg(F.min("cell").alias("cell"))
    return cut(members.join(chosen.select("cell", "k"), "cell"))


def few_pairs(members: DataFrame) -> DataFrame:
    """The pairs (a, b) of members of small cells that are in different components."""
    cells = members.where(F.col("k") <= FEW).groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("rep", "root"))).alias("m"))
    crossing = F.expr(
        "flatten(transform(m, (x, i) -> transform(filter(m, y -> y.rep > x.rep AND y.root <> x.root), "
        "y -> named_struct('a', x.rep, 'b', y.rep))))"
    )
    return cells.select(F.inline(crossing)).distinct()


def open_blocks(members: DataFrame, reps: DataFrame) -> DataFrame:
    """(cell, i, j, rep, root, other) of larger cells: of a block (i, j) the members that may have a partner in
    another component, or if there are few the pairs (rep, other).

    A cell's members are dealt to blocks by hash, so many that one block is small, and every two blocks of
    a cell meet once.
    """
    members = cut(members.where(F.col("k") > FEW).join(reps.select("rep", "n"), "rep"))
    blocks = F.greatest(F.ceil(F.sum("n") / BLOCK_GRAMS), F.ceil(F.count(F.lit(1)) / BLOCK_MEMBERS)).alias("blocks")
    dealt = members.join(members.groupBy("cell").agg(blocks), "cell").withColumn(
        "block", F.pmod(F.xxhash64("rep", F.lit(2)), F.col("blocks"))
    )
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    rows = dealt.select("cell", "rep", "root", "block", other).select(
        "cell", "rep", "root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )
    known = reps.select("rep", "n", "sizes").join(small(cut(members.select("rep").distinct()), WANTED_ROWS), "rep", "left_semi")
    schema = "cell long, i long, j long, rep long, root long, other long"

    def compare(group: pa.Table) -> pa.Table:
        n, roots, reps = (group.column(c).to_numpy() for c in ("n", "root", "rep"))
        first, second = near_pairs(group.column("sizes").to_pylist(), n, roots)
        if len(first) > PAIRS_PER_MEMBER * len(reps):
            chosen, others = np.unique(np.concatenate((first, second))), None
        else:
            chosen, others = first, pa.array(reps[second])
        out = group.select(["cell", "i", "j", "rep", "root"]).take(pa.array(chosen))
        return out.append_column("other", pa.nulls(len(chosen), pa.int64()) if others is None else others)

    return cut(rows.join(known, "rep").groupBy("cell", "i", "j").applyInArrow(compare, schema))


def compare_blocks(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """Links between members of a block (cell, i, j) that are in different components."""
    whole = parts.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("fragment", "grams"))).alias("sets"))
    rows = rows.join(whole.select("rep", F.col("sets.grams").alias("sets")), "rep")

    def compare(group: pa.Table) -> pa.Table:
        reps, roots = (group.column(c).to_numpy() for c in ("rep", "root"))
        sets = [[np.array(part, dtype=np.int64) for part in s] for s in group.column("sets").to_pylist()]
        found = compare_block(reps, roots, sets)
        return pa.table({"a": [a for a, _ in found], "b": [b for _, b in found]}, schema=arrow_schema(LINK))

    return rows.groupBy("cell", "i", "j").applyInArrow(compare, LINK).distinct()


def rooted(reps: DataFrame, edges: DataFrame) -> DataFrame:
    """(rep, root) of every representative."""
    found = components(edges).select(F.col("fp").alias("linked"), "root")
    return reps.join(found, F.col("rep") == F.col("linked"), "left").select("rep", F.coalesce("root", "rep").alias("root"))


def jaccard_classes(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id, text).

    A text without words, or null, has an empty set, is linked with nothing and is its own component, also
    if its id is repeated. A component whose rows all lack an id has none. Texts are read whole, of any
    length. Rows repeated are repeated in the result. An empty table gives no rows; further columns are ignored.
    """
    rows = cut(digests(docs, bands(docs)))
    sets = rows.where("n > 0").groupBy("set_key").agg(
        F.min("doc_id").alias("low"), *(F.any_value(c).alias(c) for c in ("n", "sizes", "cells"))
    )
    reps = cut(sets.withColumn("rep", F.monotonically_increasing_id()))
    found = reps.select(F.explode("cells").alias("cell"), "rep")
    groups = cut(
        found.groupBy("cell")
        .agg(F.count(F.lit(1)).alias("k"), F.min("rep").alias("first"), F.max("rep").alias("last"))
        .where("k > 1")
    )
    larger = groups.where("k > 2").select("cell", "first")
    members = cut(found.join(small(larger, WANTED_ROWS), "cell"))
    pairs = (
        groups.where("k = 2").select(F.col("first").alias("a"), F.col("last").alias("b"))
        .unionByName(members.where("rep <> first").select(F.col("first").alias("a"), F.col("rep").alias("b")))
        .distinct()
    )
    judged = cut(pairs)
    pairs = cut(possible_pairs(judged, reps))
    wanted = pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))).distinct()

    def fragments_of(wanted: DataFrame) -> DataFrame:
        return fragments(docs, cut(reps.select("rep", "set_key", "low").join(wanted, "rep", "left_semi")))

    edges = cut(count_pairs(pairs, fragments_of(wanted)))
    roots = cut(rooted(reps.select("rep"), edges))
    members = open_cells(members.select("cell", "rep").join(roots, "rep"))
    blocks = open_blocks(members, reps)
    again = possible_pairs(cut(few_pairs(members).join(judged, ["a", "b"], "left_anti")), reps)
    again = again.unionByName(
        blocks.where("other IS NOT NULL").select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b")).distinct()
    )
    again, dense = cut(again.distinct()), blocks.where("other IS NULL")
    ids = [again.select(F.col(c).alias("rep")) for c in "ab"]
    parts = fragments_of(dense.select("rep").unionByName(ids[0]).unionByName(ids[1]).distinct())
    more = count_pairs(again, parts).unionByName(compare_blocks(dense.drop("other"), parts))
    roots = rooted(reps.select("rep"), edges.unionByName(cut(more)))
    named = cut(reps.select("rep", "set_key", "low").join(roots, "rep"))
    lows = named.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = named.join(lows, "root").select(F.col("set_key").alias("key"), "component_id")
    return rows.join(classes, F.col("set_key") == F.col("key"), "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"))
