"""Near-duplicate groups: SuperMinHash signatures, banding, verification on full sets, connected components.

SuperMinHash gives every element of a set a random permutation of the signature's slots; in round ``j`` the element
offers ``j`` plus a random fraction to the slot at place ``j`` of its permutation, and a slot keeps the least offer.
As the slots of one element are a permutation, slots are negatively correlated and the estimate of similarity varies
less than MinHash. A round can only improve slots that hold an offer of that round or later, so a set stops as soon
as all its slots are filled by earlier rounds: one to three rounds for all but the shortest texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import bind, lower_ascii, split_words
from landfall.llm.components import connected_components
from landfall.sources.staging import stage

#: Rows of a band and bands: at a similarity of 0.8 a link is missed with a probability of (1 - 0.8**4)**28 < 5e-7.
BAND_ROWS, BANDS = 4, 28
#: Elements that are hashed at a time.
BLOCK = 400_000
#: Rounds in which members of a bucket are compared with hubs, hubs of a bucket in rounds after the first, and open
#: pairs per bucket entry that are few enough to skip the rounds that are left.
HUB_ROUNDS, HUBS, FEW_PAIRS = 2, 8, 2
#: Bits for an element in the bitmap of a set, from which a bound of its similarity to another set follows, and 64-bit
#: words of a bitmap, at least and at most. All three are powers of two.
ELEMENT_BITS, LEAST_WORDS, MOST_WORDS = 16, 32, 1024
#: Members of a bucket on each side of a cell, which one task compares; pairs of a cell or less that are listed instead of
#: compared side by side; rows, pairs and words that are taken at a time.
CELL, FEW_IN_CELL, ROWS_AT_A_TIME, PAIRS_AT_A_TIME, WORDS_AT_A_TIME = 4096, 4096, 1024, 65_536, 1 << 18


def shingle_set(text: Column, size: int) -> Column:
    """Sorted distinct 64-bit hashes of the runs of ``size`` words; a shorter text is one shingle, none without words."""
    def of(words: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.size(words) - size), lambda i: F.xxhash64(
            *[F.get(words, i + k) for k in range(size)]))
        return F.when(F.size(words) == 0, F.array().cast("array<bigint>")).when(
            F.size(words) < size, F.array(F.xxhash64(F.size(words), words))).otherwise(F.sort_array(F.array_distinct(runs)))

    return bind(split_words(lower_ascii(text)), of)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signatures(values: np.ndarray, offsets: np.ndarray, slots: int) -> np.ndarray:
    """SuperMinHash signatures of sets that lie one after another in ``values``; a row per set, of uint64.

    A slot holds the round in its upper 8 bits and the fraction in the lower 56. Empty sets keep the largest value.
    """
    counts = np.diff(offsets)
    owner = np.repeat(np.arange(len(counts)), counts)
    element = values.astype(np.int64).view(np.uint64)
    table = np.full(len(counts) * slots, np.iinfo(np.uint64).max, dtype=np.uint64)
    swaps: list[np.ndarray] = []
    for level in range(slots):
        if level:
            worst = table.reshape(-1, slots).max(axis=1)
            going = (worst >= np.uint64(level << 56))[owner]
            if not going.all():
                owner, element, swaps = owner[going], element[going], [s[going] for s in swaps]
        if not len(owner):
            break
        random = _mix(element + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        pick = level + (_mix(random ^ np.uint64(0xD6E8FEB86659FD93)) % np.uint64(slots - level)).astype(np.int64)
        slot = pick.copy()  # what stands at place ``pick`` after the earlier swaps, traced back through them
        for earlier in range(level - 1, -1, -1):
            at = swaps[earlier]
            slot = np.where(slot == earlier, at, np.where(slot == at, earlier, slot))
        np.minimum.at(table, owner * slots + slot, np.uint64(level << 56) | (random >> np.uint64(8)))
        swaps.append(pick)
    return table.reshape(-1, slots)


def band_keys(table: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per set and band; keys of different bands differ."""
    bands = table.shape[1] // rows
    keys = np.empty((table.shape[0], bands), dtype=np.uint64)
    for band in range(bands):
        key = np.full(table.shape[0], (band + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
        for row in range(rows):
            key = _mix(key ^ table[:, band * rows + row]) + np.uint64(0x632BE59BD9B4E019)
        keys[:, band] = key
    return keys.view(np.int64)


def _banding(rows: int, bands: int, block: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shingles = batch.column(batch.num_columns - 1)
            offsets = shingles.offsets.to_numpy().astype(np.int64)
            values, offsets = shingles.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]], offsets - offsets[0]
            first = 0
            while first < batch.num_rows:
                last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + block, side="right")) - 1)
                last = min(last, batch.num_rows)
                keys = band_keys(signatures(values[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first],
                                            rows * bands), rows)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, keys.size + 1, bands, dtype=np.int32)), pa.array(keys.ravel()))
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], lists], names=[*batch.schema.names[:-1], "bands"])
                first = last

    return run


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, band_rows: int = BAND_ROWS,
                    bands: int = BANDS) -> DataFrame:
    """Every row's group: ``doc_id, text_key, n_shingles, component_id, kept``.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. Two rows are linked if the intersection of
    their shingle sets is at least ``percent`` % of the union; ``component_id`` is the smallest ``doc_id`` reachable.
    ``text_key`` is a hash of the text, to join the rows back. Null texts and texts without words have an empty set and
    are linked with nothing. A row with a null ``doc_id`` takes part; its ``component_id`` is null only if no row of
    its group has an id. Repeated rows are one group. An empty table gives no rows.

    Rows with equal sets form one class before any pair is made, so copies cost nothing. Within a bucket, members are
    compared with hubs, not with each other; only members that are still in different components afterwards are paired, in
    cells of bounded size, and of these only pairs that bitmaps of their sets cannot rule out.
    """
    slim = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), F.xxhash64("text").alias("text_key"),
                       shingle_set(F.col("text"), size).alias("shingles"))
    keyed = slim.select("doc_id", "row_key", "text_key", F.size("shingles").cast("bigint").alias("n_shingles"),
                        F.xxhash64("shingles").alias("k1"), F.xxhash64(F.lit(1), "shingles").alias("k2"), "shingles")
    signed = stage(keyed.mapInArrow(
        _banding(band_rows, bands, BLOCK),
        "doc_id bigint, row_key bigint, text_key bigint, n_shingles bigint, k1 bigint, k2 bigint, bands array<bigint>"),
        "near-signed")
    classes = stage(signed.where("n_shingles > 0").groupBy("k1", "k2").agg(
        F.min("doc_id").alias("first_id"), F.min("row_key").alias("row_key"), F.max("n_shingles").alias("n"))
        .withColumn("node", F.monotonically_increasing_id()), "near-classes")
    members = stage(signed.join(classes.select("k1", "k2", "row_key", "node", "n"), ["k1", "k2", "row_key"]).select(
        "node", "n", F.explode("bands").alias("bucket")), "near-members")
    shared = members.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    open_members = stage(members.join(shared.select("bucket"), "bucket").select("bucket", "node", "n"), "near-shared")
    sets = _sets_of(docs, size, classes.join(open_members.select("node").distinct(), "node", "left_semi"))
    roots = _linked(open_members, sets, percent)

    grouped = classes.join(roots, "node", "left").select(
        "k1", "k2", "first_id", F.coalesce("root", "node").alias("root"))
    ids = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    # Only classes that were joined with others, or hold several rows, need more than their own id.
    of_class = stage(grouped.join(ids, "root").select("k1", "k2", "component_id"), "near-groups")
    named = signed.where("n_shingles > 0").join(of_class, ["k1", "k2"]).select(
        "doc_id", "text_key", "n_shingles", "component_id")
    alone = signed.where("n_shingles = 0").select("doc_id", "text_key", "n_shingles", F.col("doc_id").alias("component_id"))
    return named.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _sets_of(docs: DataFrame, size: int, wanted: DataFrame) -> DataFrame:
    """``node, n, shingles, bitmap`` of the wanted classes, from one row of each."""
    rows = docs.select(F.xxhash64("doc_id", "text").alias("row_key"), F.col("text").alias("_text"))
    # A hash join builds on the short rows and leaves the texts unsorted. The generator keeps the filter from repeating
    # the work on the text.
    found = rows.join(wanted.select("row_key", "node", "n", "k1", "k2").hint("shuffle_hash"), "row_key").select(
        "node", "n", "k1", "k2", F.explode(F.array(shingle_set(F.col("_text"), size))).alias("shingles"))
    exact = found.where((F.xxhash64("shingles") == F.col("k1")) & (F.xxhash64(F.lit(1), "shingles") == F.col("k2")))
    mapped = exact.select("node", "n", "shingles").mapInArrow(
        _bitmaps, "node bigint, n bigint, shingles array<bigint>, bitmap array<bigint>")
    sets = stage(mapped, "near-sets")
    rows_of, nodes = sets.agg(F.count("*"), F.countDistinct("node")).first()
    return sets if rows_of == nodes else stage(sets.dropDuplicates(["node"]), "near-sets-once")  # repeated rows


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches that take little memory."""
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS_AT_A_TIME):
            yield batch.slice(first, ROWS_AT_A_TIME)


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _parts(batches):
        shingles = batch.column(2)
        offsets = shingles.offsets.to_numpy().astype(np.int64)
        values = _mix(shingles.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]].astype(np.int64).view(np.uint64))
        counts = np.diff(offsets)
        width = np.full(batch.num_rows, LEAST_WORDS, dtype=np.int64)
        while (narrow := (width * 64 < counts * ELEMENT_BITS) & (width < MOST_WORDS)).any():
            width[narrow] *= 2
        starts = np.concatenate([[0], np.cumsum(width)])
        word = np.repeat(starts[:-1], counts) + (values & np.repeat(width - 1, counts).astype(np.uint64)).astype(np.int64)
        table = np.zeros(starts[-1], dtype=np.uint64)
        np.bitwise_or.at(table, word, np.uint64(1) << (values >> np.uint64(58)))
        lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(table.view(np.int64)))
        yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["node", "n", "shingles", "bitmap"])


def _linked(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``node, root`` of all nodes with a link, from ``(bucket, node, n)``."""
    links, roots, pending = None, None, members.withColumn("root", F.col("node"))
    for turn in range(HUB_ROUNDS + 1):
        if turn:
            # What is left: buckets that hold more than one component.
            labelled = pending.drop("root").join(roots, "node", "left").select(
                "bucket", "node", "n", F.coalesce("root", "node").alias("root"))
            split = labelled.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
            pending = stage(labelled.join(split.select("bucket"), "bucket").select("bucket", "node", "n", "root"), "near-open")
            count = F.col("c")
            sizes = pending.groupBy("bucket", "root").agg(F.count("*").cast("double").alias("c")).groupBy("bucket").agg(
                ((F.sum(count) * F.sum(count) - F.sum(count * count)) / 2).alias("pairs"), F.sum(count).alias("entries"))
            pairs, entries = sizes.agg(F.sum("pairs"), F.sum("entries")).first()
            if not pairs:
                return roots
            if turn == HUB_ROUNDS or pairs <= FEW_PAIRS * entries:
                last = _verified(_all_pairs(pending, sets, percent), sets, percent)
                return stage(connected_components(links.unionByName(last)), "near-roots")
        fresh = _verified(_hub_pairs(pending, percent, HUBS if turn else 1, turn), sets, percent)
        links = fresh if links is None else links.unionByName(fresh)
        roots = stage(connected_components(links), "near-roots")
    raise AssertionError("the last turn returns")


def _near_in_size(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _hub_pairs(members: DataFrame, percent: int, hubs: int, turn: int) -> DataFrame:
    """Each member with the hubs of its bucket that it isn't linked with yet: one hub for each of ``hubs`` parts."""
    salt = 0x2545F4914F6CDD1D * turn % 2**62  # another order of the numbers in each turn
    least = members.groupBy("bucket", F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(hubs)).alias("part")).agg(
        F.min(F.col("node").bitwiseXOR(F.lit(salt))).alias("least"))
    chosen = least.select("bucket", F.col("least").bitwiseXOR(F.lit(salt)).alias("node")).join(
        members, ["bucket", "node"]).select(
        "bucket", F.col("node").alias("hub"), F.col("n").alias("hub_n"), F.col("root").alias("hub_root")).distinct()
    near = _near_in_size(F.col("n"), F.col("hub_n"), percent)
    return members.join(stage(chosen, "near-hubs"), "bucket").where((F.col("root") != F.col("hub_root")) & near).select(
        F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def _all_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs of a bucket that lie in different components and may be similar, by their sizes and bitmaps.

    Bits in which two bitmaps differ stand for at least as many elements in which the sets differ; so a pair with too
    many of them is not similar, and never leaves its task. One side has no members of the bucket's largest component,
    which is never paired with itself. Both sides of a bucket are dealt out over parts of about ``CELL`` members, and each
    pair of parts is a cell of its own.
    """
    counts = members.groupBy("bucket", "root").agg(F.count("*").alias("c"))
    sizes = counts.groupBy("bucket").agg(F.max_by("root", F.struct("c", "root")).alias("main"),
                                         F.sum("c").alias("entries"), F.max("c").alias("of_main")).where("of_main < entries")
    dealt = members.join(sizes, "bucket").select(
        "bucket", "node", "n", "root", (F.col("root") == F.col("main")).alias("in_main"),
        F.ceil((F.col("entries") - F.col("of_main")) / CELL).alias("lefts"), F.ceil(F.col("entries") / CELL).alias("rights")).select(
        "*", F.pmod(F.xxhash64("node"), "lefts").alias("own_left"), F.pmod(F.xxhash64("node"), "rights").alias("own_right"))
    places = F.concat(
        F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("lefts") - 1), lambda i: F.struct(
            i.alias("l"), F.col("own_right").alias("r"), (~F.col("in_main") & (i == F.col("own_left"))).alias("left"), F.lit(True).alias("right"))),
        F.transform(F.filter(F.sequence(F.lit(0).cast("bigint"), F.col("rights") - 1), lambda i: ~F.col("in_main") & (i != F.col("own_right"))), lambda i: F.struct(
            F.col("own_left").alias("l"), i.alias("r"), F.lit(True).alias("left"), F.lit(False).alias("right"))))
    placed = dealt.select("bucket", "node", "n", "root", "in_main", F.explode(places).alias("place")).select("place.*", "*").drop("place")
    cells = placed.join(sets.select("node", "bitmap"), "node").repartition("bucket", "l", "r").sortWithinPartitions("bucket", "l", "r")
    return cells.mapInArrow(_compared(percent), "a bigint, b bigint").distinct()


def _compared(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pairs of the cells, which come one after another."""
    def found(table: pa.Table) -> pa.RecordBatch:
        a, b = _cell_pairs(table.combine_chunks(), percent)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of the last cell so far
        for batch in _parts(batches):
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            last = int(_new_cells(held).nonzero()[0][-1])
            if last:
                yield found(held.slice(0, last))
                held = held.slice(last)
        if held is not None:
            yield found(held)

    return run


def _new_cells(table: pa.Table) -> np.ndarray:
    new = np.ones(table.num_rows, dtype=bool)
    new[1:] = False
    for name in ("bucket", "l", "r"):
        values = table.column(name).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return new


def _cell_pairs(table: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes ``(a, b)`` of the pairs of all cells that sizes and bitmaps cannot rule out."""
    node, n, root, in_main = (table.column(name).to_numpy() for name in ("node", "n", "root", "in_main"))
    lists = table.column("bitmap").chunk(0)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    words = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
    width, place, of_width = np.diff(offsets), np.empty(table.num_rows, dtype=np.int64), {}
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        place[rows] = np.arange(len(rows))
        of_width[w] = words[offsets[rows][:, None] + np.arange(w)]

    def folded(rows: np.ndarray, to: int) -> np.ndarray:
        """The bitmaps of the rows as narrower ones."""
        out = np.empty((len(rows), to), dtype=np.uint64)
        for w in np.unique(width[rows]).tolist():
            at = np.flatnonzero(width[rows] == w)
            maps = of_width[w][place[rows[at]]]
            out[at] = maps if w == to else np.bitwise_or.reduce(maps.reshape(len(at), w // to, to), axis=1)
        return out

    def possible(total: np.ndarray, differing: np.ndarray) -> np.ndarray:
        return (total - differing) * (100 + percent) >= total * (2 * percent)

    def kept(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        near = np.minimum(n[i], n[j]) * 100 >= np.maximum(n[i], n[j]) * percent
        keep = near & (root[i] != root[j]) & (in_main[j] | (node[i] < node[j]))
        i, j = i[keep], j[keep]
        narrower, keep = np.minimum(width[i], width[j]), np.zeros(len(i), dtype=bool)
        for w in np.unique(narrower).tolist():
            of = np.flatnonzero(narrower == w)
            for first in range(0, len(of), WORDS_AT_A_TIME // w):
                at = of[first:first + WORDS_AT_A_TIME // w]
                differing = np.bitwise_count(folded(i[at], w) ^ folded(j[at], w)).sum(axis=1, dtype=np.int64)
                keep[at] = possible(n[i[at]] + n[j[at]], differing)
        a, b = node[i[keep]], node[j[keep]]
        return np.minimum(a, b), np.maximum(a, b)

    cell = np.cumsum(_new_cells(table)) - 1
    left, right = (np.flatnonzero(table.column(name).to_numpy()) for name in ("left", "right"))
    n_cells = int(cell[-1]) + 1
    lefts, rights = np.bincount(cell[left], minlength=n_cells), np.bincount(cell[right], minlength=n_cells)
    left_starts, right_starts = np.cumsum(lefts) - lefts, np.cumsum(rights) - rights
    few = lefts * rights <= FEW_IN_CELL
    out = []

    listed = left[few[cell[left]]]
    times = rights[cell[listed]]
    ends = np.cumsum(times)
    first = 0
    while first < len(listed):
        done = int(ends[first] - times[first])
        last = max(first + 1, int(np.searchsorted(ends, done + PAIRS_AT_A_TIME, side="right")))
        i, many = np.repeat(listed[first:last], times[first:last]), times[first:last]
        within = np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many)
        out.append(kept(i, right[right_starts[cell[i]] + within]))
        first = last

    for number in np.flatnonzero(~few).tolist():
        mine = left[left_starts[number]:left_starts[number] + lefts[number]]
        others = right[right_starts[number]:right_starts[number] + rights[number]]
        least = int(min(width[mine].min(), width[others].min()))
        narrow = max(LEAST_WORDS, least // 4)  # rules out most pairs
        planes = np.ascontiguousarray(folded(others, narrow).T)
        step = max(1, PAIRS_AT_A_TIME // len(others))
        for first in range(0, len(mine), step):
            rows = mine[first:first + step]
            maps = folded(rows, narrow)
            differing = np.zeros((len(rows), len(others)), dtype=np.uint16)
            for k in range(narrow):
                differing += np.bitwise_count(planes[k][None, :] ^ maps[:, k][:, None])
            i, j = np.nonzero(possible(n[rows][:, None] + n[others][None, :], differing))
            out.append(kept(rows[i], others[j]))
    return tuple(np.concatenate([pair[side] for pair in out]) if out else np.empty(0, dtype=np.int64) for side in (0, 1))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    compared = stage(pairs, "near-pairs").join(left, "a").join(right, "b").select(
        "a", "b", (F.col("na") + F.col("nb")).alias("total"), F.size(F.array_intersect("sa", "sb")).alias("common"))
    return stage(compared.where(F.col("common") * 100 >= (F.col("total") - F.col("common")) * percent).select("a", "b"),
                 "near-verified")
