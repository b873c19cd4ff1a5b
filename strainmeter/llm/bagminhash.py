"""MinHash near-duplicates by BagMinHash.

A document is the multiset of its five-word shingles (words: runs between
white space, ASCII letters lowered; a text of one to four words is a single
shingle). Two documents are linked if their weighted Jaccard similarity,
sum of minimum over sum of maximum counts, is at least ``threshold``.

Signature (Ertl, 2018, for integer weights): the weight axis of a shingle is
cut into the dyadic levels [0,1), [1,2), [2,4), [4,8) ...; each level has a
Poisson process whose rate is its width, seeded by shingle and level. Its
points fall on a register and on a height; a point over the shingle's weight
is refused. A register keeps the earliest point. So a shingle of weight w
costs log2(w) processes, and all processes stop at the first point later than
every register. Two registers agree with a probability equal to the weighted
Jaccard similarity.

Plan:
1. Every document gets its signature bands and a 128-bit fingerprint of its
   multiset; equal multisets are one *bag* from here on, whatever the number
   of copies.
2. Bags sharing a band are candidates. Each is verified (exact multiset
   overlap) against the band's smallest bag: linear in the band, also when
   thousands of near copies share it.
3. Links give components. Bands that still hold several components are
   compared across components, in pairs of blocks: estimate by signature,
   then exact overlap. A block pair returns a spanning forest, so its rows
   grow with the block, not with its square. Nothing is capped.
4. Components over all links are the classes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strainmeter.llm import textvec as tv
from strainmeter.llm.tables import components, ship, small_or_shuffled, written

THRESHOLD = 0.8
BANDS, ROWS = 20, 4
BLOCK = 256
#: a pair is verified if so many registers agree; at similarity 0.8 fewer
#: agree with a probability under 1e-8
SLACK = 0.3
_U = np.uint64

SIGNED = "hi long, lo long, n_shingles long, registers array<int>"


def bags(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles text by text: (hash, count, n + 1 offsets, sorted
    shingles with repeats)."""
    ordered = hashes.copy()
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        ordered[a:b].sort()
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    new[first[:-1][first[:-1] < len(ordered)]] = True
    at = np.flatnonzero(new)
    return ordered[at], np.diff(at, append=len(ordered)), np.searchsorted(at, first), ordered


def registers(shingle: np.ndarray, count: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """BagMinHash registers (texts x size, uint32) of the given multisets; a
    text without shingles has zeros."""
    texts = len(first) - 1
    earliest = np.full(texts * size, np.inf)
    winner = np.zeros(texts * size, np.uint64)
    levels = np.where(count > 1, np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64), 0) + 1
    which = np.repeat(np.arange(len(shingle)), levels)
    level = np.arange(len(which)) - np.repeat(np.cumsum(levels) - levels, levels)
    text = np.repeat(np.arange(texts), np.diff(first))[which]
    low = np.where(level > 0, 2.0 ** (level - 1), 0.0)
    width = np.where(level > 0, low, 1.0)
    weight = count[which].astype(np.float64)
    state = tv.seeded(shingle[which] + level.astype(np.uint64) * _U(0xA24BAED4963EE407), 7)
    time = np.zeros(len(which))
    step = 0
    while len(state):
        step += 1
        draw = tv.seeded(state, 3 * step)
        time = time - np.log(tv.unit(draw)) / width
        place = tv.seeded(state, 3 * step + 1)
        slot = text * size + (place % _U(size)).astype(np.int64)
        height = low + width * tv.unit(tv.seeded(state, 3 * step + 2))
        taken = (height <= weight) & (time < earliest[slot])
        np.minimum.at(earliest, slot[taken], time[taken])
        won = taken & (time == earliest[slot])
        winner[slot[won]] = place[won]
        latest = earliest.reshape(texts, size).max(axis=1)
        on = time < latest[text]
        state, time, text, low, width, weight = (x[on] for x in (state, time, text, low, width, weight))
    return (tv.mix(winner) >> _U(32)).astype(np.uint32).reshape(texts, size) * (np.diff(first) > 0)[:, None].astype(np.uint32)


def fingerprints(ordered: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each multiset (order of words apart)."""
    return (tv.mix(tv.segment_sums(tv.seeded(ordered, s), first)).view(np.int64) for s in (11, 12))


def _signer(size: int):
    def sign(column: pa.Array) -> pa.Array:
        out = []
        for _, piece in tv.slices(column):
            hashes, _, _, first = tv.words(piece)
            hashes, first = tv.shingles(hashes, first)
            distinct, count, at, ordered = bags(hashes, first)
            hi, lo = fingerprints(ordered, first)
            regs = registers(distinct, count, at, size).view(np.int32)
            out.append(pa.StructArray.from_arrays([pa.array(hi), pa.array(lo), pa.array(np.diff(first).astype(np.int64)), tv.lists(regs.ravel(), np.arange(len(regs) + 1) * size, pa.int32())], ["hi", "lo", "n_shingles", "registers"]))
        return pa.concat_arrays(out) if out else pa.array([], pa.struct([("hi", pa.int64()), ("lo", pa.int64()), ("n_shingles", pa.int64()), ("registers", pa.list_(pa.int32()))]))

    return F.arrow_udf(sign, SIGNED)


def _itemiser():
    """Fingerprint and distinct (shingle, occurrence) hashes of a text: two
    multisets overlap in as many items as these sets share."""

    def items(column: pa.Array) -> pa.Array:
        out = []
        for _, piece in tv.slices(column):
            hashes, _, _, first = tv.words(piece)
            hashes, first = tv.shingles(hashes, first)
            _, count, _, ordered = bags(hashes, first)
            nth = np.arange(len(ordered)) - np.repeat(np.cumsum(count) - count, count)
            hi, lo = fingerprints(ordered, first)
            out.append(pa.StructArray.from_arrays([pa.array(hi), pa.array(lo), tv.lists(tv.seeded(ordered + nth.astype(np.uint64) * _U(0x9FB21C651E98DF25), 13).view(np.int64), first, pa.int64())], ["hi", "lo", "items"]))
        return pa.concat_arrays(out) if out else pa.array([], pa.struct([("hi", pa.int64()), ("lo", pa.int64()), ("items", pa.list_(pa.int64()))]))

    return F.arrow_udf(items, "hi long, lo long, items array<long>")


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity from two sets of items."""
    if not len(a) or not len(b):
        return 0.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def _verifier(threshold: float):
    def similar(a: pa.Array, b: pa.Array) -> pa.Array:
        out = [similarity(x.values.to_numpy(), y.values.to_numpy()) >= threshold for x, y in zip(a, b, strict=True)]
        return pa.array(out, pa.bool_())

    return F.arrow_udf(similar, "boolean")


def _forest(threshold: float, size: int, least: int):
    """Links across components within a block pair, as a spanning forest."""

    def links(group: pa.Table) -> pa.Table:
        node = group["node"].to_numpy()
        comp = group["comp"].to_numpy()
        side = group["side"].to_numpy()
        regs = group["registers"].combine_chunks().flatten().to_numpy().reshape(-1, size)
        items = [x.values.to_numpy() for x in group["items"]]
        root = {int(c): int(c) for c in comp}

        def find(c: int) -> int:
            while root[c] != c:
                c = root[c] = root[root[c]]
            return c

        found = []
        for i in np.flatnonzero(side <= 1):
            agree = (regs == regs[i]).sum(axis=1)
            far = np.flatnonzero((agree >= least) & (comp != comp[i]) & ((side == 2) | (side[i] == 1) & (node > node[i])))
            for j in far[np.argsort(-agree[far], kind="stable")]:
                x, y = find(int(comp[i])), find(int(comp[j]))
                if x != y and similarity(items[i], items[j]) >= threshold:
                    root[x] = y
                    found.append((int(node[i]), int(node[j])))
        return pa.table({"u": pa.array([a for a, _ in found], pa.int64()), "v": pa.array([b for _, b in found], pa.int64())})

    return links


def classes(docs: DataFrame, carry: list[str], id_col: str, text_col: str, threshold: float = THRESHOLD) -> DataFrame:
    """The ``carry`` columns of every row of ``docs`` with the new columns
    _row (long, distinct), _n (number of shingles) and _class (the smallest
    _row of its group). Written tables in the shared folder stand between the
    steps."""
    spark = docs.sparkSession
    ship(spark)
    size = BANDS * ROWS
    signed = written(docs.select(*carry, F.monotonically_increasing_id().alias("_row"), _signer(size)(F.col(text_col)).alias("_s")).select(*carry, "_row", "_s.*"), "bag-signed")
    rows = signed.where("n_shingles > 0").select("_row", "hi", "lo", "registers")
    bag = written(rows.groupBy("hi", "lo").agg(F.min("_row").alias("node"), F.min("registers").alias("registers")), "bags")

    band = F.posexplode(F.array(*[F.xxhash64(*[F.col("registers")[b * ROWS + r] for r in range(ROWS)]) for b in range(BANDS)]))
    entries = bag.select("node", band.alias("band", "key"))
    buckets = entries.groupBy("band", "key").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = written(entries.join(buckets.select("band", "key", "head"), ["band", "key"]), "bag-bands")

    pairs = written(shared.where("node <> head").select(F.col("node").alias("u"), F.col("head").alias("v")).distinct(), "bag-pairs")
    needed = shared.select("node").distinct()
    n_needed = needed.count()
    if n_needed == 0:
        links = pairs
    else:
        wanted = bag.join(small_or_shuffled(needed, n_needed), "node", "left_semi").select("hi", "lo", "node", "registers")
        source = docs.select(_itemiser()(F.col(text_col)).alias("_s")).select("_s.*")
        source = source.join(small_or_shuffled(wanted.select("hi", "lo", "node"), n_needed), ["hi", "lo"]).select("node", "items")
        contents = written(source.groupBy("node").agg(F.min("items").alias("items")), "bag-items")
        left = pairs.join(contents.select(F.col("node").alias("u"), F.col("items").alias("a")), "u")
        both = left.join(contents.select(F.col("node").alias("v"), F.col("items").alias("b")), "v")
        links = written(both.where(_verifier(threshold)("a", "b")).select("u", "v"), "bag-links")
        comps = components(links)
        links = links.unionByName(_across(shared, bag, contents, comps, threshold))
    comps = components(links)

    named = bag.select("hi", "lo", "node").join(comps, "node", "left").select("hi", "lo", F.coalesce("comp", "node").alias("_class"))
    out = signed.drop("registers").join(named, ["hi", "lo"], "left")
    return out.select(*carry, "_row", F.col("n_shingles").alias("_n"), F.when(F.col("n_shingles") > 0, F.col("_class")).otherwise(F.col("_row")).alias("_class"))


def _across(shared: DataFrame, bag: DataFrame, contents: DataFrame, comps: DataFrame, threshold: float) -> DataFrame:
    """Links between different components that share a band."""
    size = BANDS * ROWS
    placed = shared.join(comps, "node", "left").select("band", "key", "node", F.coalesce("comp", "node").alias("comp"))
    sizes = placed.groupBy("band", "key", "comp").agg(F.count(F.lit(1)).alias("n"))
    mixed = sizes.groupBy("band", "key").agg(F.max_by("comp", "n").alias("main"), F.count(F.lit(1)).alias("n_comps"), F.sum("n").alias("n"), F.max("n").alias("n_main")).where("n_comps > 1")
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    mixed = written(mixed.select("band", "key", "main", blocks("n_main").alias("b_main"), F.ceil((F.col("n") - F.col("n_main")) / BLOCK).cast("int").alias("b_rest")), "bag-mixed")
    member = placed.join(mixed, ["band", "key"])
    rest = F.col("comp") != F.col("main")
    # the main component's blocks are numbered from b_rest; a block of the rest
    # meets every block, one of the main component only those of the rest
    own = F.when(rest, F.pmod(F.xxhash64("node"), F.col("b_rest"))).otherwise(F.col("b_rest") + F.pmod(F.xxhash64("node"), F.col("b_main"))).cast("int")
    member = member.withColumn("own", own)
    other = F.explode(F.when(rest, F.sequence(F.lit(0), F.col("b_rest") + F.col("b_main") - 1)).otherwise(F.sequence(F.lit(0), F.col("b_rest") - 1)))
    member = member.select("band", "key", "node", "comp", "own", other.alias("other"))
    member = member.select("band", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "comp", F.when(F.col("own") == F.col("other"), 1).when(F.col("own") < F.col("other"), 0).otherwise(2).alias("side"))
    full = member.join(bag.select("node", "registers"), "node").join(contents, "node")
    least = int(size * (threshold - SLACK))
    return written(full.groupBy("band", "key", "i", "j").applyInArrow(_forest(threshold, size, least), "u long, v long").distinct(), "bag-across")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: id, class_id (smallest id of its group),
    class_size (rows), n_shingles and kept (one row of each group).

    A null, empty or blank text has no shingle and links with nothing. Rows
    with a null id take part; a group of null ids only has a null class_id.
    The kept row has the smallest id (nulls last), then the earliest place.
    Other columns, whatever their names, are neither read nor returned."""
    placed = classes(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), ["_id"], "_id", "_text", threshold)
    heads = _heads(placed)
    out = placed.join(heads, "_class")
    return out.select(F.col("_id").alias(id_col), F.col("class_id"), F.col("class_size"), F.col("_n").alias("n_shingles"), (F.col("_row") == F.col("_keep")).alias("kept"))


def _heads(placed: DataFrame) -> DataFrame:
    first = F.min(F.struct(F.col("_id").isNull().alias("a"), F.col("_id").alias("b"), F.col("_row").alias("c")))
    return placed.groupBy("_class").agg(first.alias("h"), F.count(F.lit(1)).alias("class_size")).select("_class", F.col("h.b").alias("class_id"), F.col("h.c").alias("_keep"), "class_size")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that ``near_duplicates`` keeps."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.toDF(*names.values())
    key, text = names[id_col], names[text_col]
    placed = classes(renamed, list(names.values()), key, text, threshold)
    heads = _heads(placed.select("_class", F.col(key).alias("_id"), "_row"))
    kept = placed.join(heads.select(F.col("_keep").alias("_row")), "_row", "left_semi")
    return kept.select(*[F.col(v).alias(k) for k, v in names.items()])


