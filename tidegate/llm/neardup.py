"""Near-duplicates by MinHash with tensored banding.

A text is the set of its five-word shingles. Instead of one hash collection per table, GROUPS small collections of HASHES
minhashes each are computed, and a table's key is a pair of them: 12 collections of 3 give 66 tables of 6 minhashes from 36
instead of 396 minhashes. Two texts meet when at least two collections agree; at a similarity of 0.85 that fails for 2 pairs
in 10,000. Lower thresholds need more collections: at 0.80, 12 would miss 25 pairs in 10,000 and 16 miss 2.

1. Texts with the same set form a class; from here on only its smallest document takes part.
2. Each key's smallest document is its leader; all others are tied to it (never to each other). The connected parts of
   these ties are the candidate groups: whatever shares a key is in the same group.
3. The texts of a group meet in one task, which compares all full sets by products of incidence matrices over the
   shingles they share, and reports no more links than join what belongs together. A group beyond BLOCK_BYTES is cut by
   set size (texts whose sizes differ too much cannot link) and hash, and its blocks meet in pairs.
4. Components of the confirmed links.

Defined cases: a null or wordless text has an empty set and links with nothing; with one to four words the whole sequence
is the only shingle; rows with the same id are one document, linked by whatever any of its rows links; rows without id link
with nothing and are kept. Shingles are 64-bit fingerprints.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.components import components
from tidegate.llm.frames import arrow_batch, map_arrow, stored, texts
from tidegate.llm.words import NOT_BLANK, Words, mix, pieces, shingles, words_of

SHINGLE = 5
SIMILAR = 85  # percent
GROUPS, HASHES = 12, 3
CHUNK_BYTES = 1 << 20
BLOCK_BYTES = 4 << 20
TILE_ROWS, TILE_SHINGLES, TILE_COLUMNS = 256, 200_000, 4096


def shingle_sets(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(shingles of all texts one after another, where each text's begin); repeated shingles are still there."""
    hashes, first = words.hashes(), words.first
    count = np.diff(first)
    full = shingles(hashes, size)
    amount = np.where(count >= size, count - size + 1, (count > 0).astype(np.int64))
    begin = np.concatenate([[0], np.cumsum(amount)])
    owner = np.repeat(np.arange(len(count)), amount)
    at = first[owner] + np.arange(begin[-1]) - begin[owner]
    short = count[owner] < size
    out = np.zeros(begin[-1], dtype=np.uint64)
    out[~short] = full[at[~short]]
    for i in np.flatnonzero(short):
        a, b = first[owner[i]], first[owner[i] + 1]
        out[i] = mix(shingles(hashes[a:b], b - a) + np.uint64(b - a))[0]
    return out, begin


def signatures(docs: DataFrame, groups: int = GROUPS) -> DataFrame:
    """doc_id, n_shingles, size (bytes of text), print_1, print_2 (fingerprint of the set), bands (one hash per collection)."""
    random = np.random.default_rng(5)
    factors = (random.integers(0, 1 << 63, (groups * HASHES, 2), dtype=np.uint64) << np.uint64(1)) | np.uint64(1)

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, limit=CHUNK_BYTES):
                found, begin = shingle_sets(words_of(piece.column(1), NOT_BLANK, True))
                rows = np.flatnonzero(np.diff(begin))
                low = np.array([np.minimum.reduceat(found * a + b, begin[rows]) for a, b in factors]) if len(rows) else np.zeros((len(factors), 0), np.uint64)
                bands = []
                for g in range(groups):
                    value = np.full(len(rows), g, np.uint64)
                    for h in range(HASHES):
                        value = mix(value + low[g * HASHES + h])
                    bands.append(value.astype(np.int64))
                n = np.zeros(piece.num_rows, np.int64)
                prints = np.zeros((2, piece.num_rows), np.uint64)
                for i in rows:
                    distinct = np.unique(found[begin[i]:begin[i + 1]])
                    n[i] = len(distinct)
                    prints[0, i], prints[1, i] = mix(distinct).sum(), mix(distinct ^ factors[0, 0]).sum()
                listed = np.zeros(piece.num_rows + 1, np.int32)
                listed[1:][rows] = groups
                flat = np.array(bands).T.ravel() if len(rows) else np.zeros(0, np.int64)
                sizes = pa.compute.fill_null(pa.compute.binary_length(piece.column(1)), 0).cast(pa.int64())
                yield arrow_batch(doc_id=piece.column(0), n_shingles=n, size=sizes, print_1=prints[0].astype(np.int64),
                                  print_2=prints[1].astype(np.int64),
                                  bands=pa.ListArray.from_arrays(pa.array(np.cumsum(listed), pa.int32()), pa.array(flat)))

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(texts(docs), run, f"doc_id {id_type}, n_shingles long, size long, print_1 long, print_2 long, bands array<long>")


def candidate_groups(classes: DataFrame, groups: int = GROUPS) -> DataFrame:
    """doc, candidate group of every class representative that shares a table key with another."""
    keys = F.array(*[F.xxhash64(F.lit(i * groups + j), F.col("bands")[i], F.col("bands")[j])
                     for i in range(groups) for j in range(i + 1, groups)])
    keyed = classes.select("doc", F.explode(keys).alias("key"))
    leaders = keyed.groupBy("key").agg(F.min("doc").alias("leader"), F.max("doc").alias("other")).where("leader != other")
    ties = keyed.join(leaders.select("key", "leader"), "key").where("doc != leader").select(F.col("doc").alias("a"), F.col("leader").alias("b")).distinct()
    return components(ties).select(F.col("node").alias("doc"), F.col("component").alias("part"))


def comparison_units(members: DataFrame, percent: int = SIMILAR) -> DataFrame:
    """(doc, unit, side): the tasks in which each member of a group is compared. Input: doc, part, n_shingles, size.

    A small group is one unit. A large one is cut into size classes; neighbouring classes and the blocks of a class meet in
    pairs, each pair a unit whose two sides are compared with each other.
    """
    step = math.log(100 / percent)
    whole = members.groupBy("part").agg(F.sum("size").alias("total"))
    small = members.join(whole.where(F.col("total") <= BLOCK_BYTES).select("part"), "part").select(
        "doc", F.concat_ws(":", F.col("part").cast("string")).alias("unit"), F.lit(0).alias("side"))
    cut = (members.join(whole.where(F.col("total") > BLOCK_BYTES).select("part"), "part")
           .withColumn("class", F.floor(F.log(F.col("n_shingles").cast("double")) / step).cast("int")))
    blocks = cut.groupBy("part", "class").agg(F.greatest(F.ceil(F.sum("size") / BLOCK_BYTES), F.lit(1)).cast("int").alias("blocks"))
    beside = blocks.select("part", (F.col("class") + 1).alias("class"), F.col("blocks").alias("below"))
    above = blocks.select("part", (F.col("class") - 1).alias("class"), F.col("blocks").alias("above"))
    placed = (cut.join(blocks.join(beside, ["part", "class"], "left").join(above, ["part", "class"], "left"), ["part", "class"])
              .withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int")))

    def name(low_class, low, high_class, high):
        return F.concat_ws(":", F.col("part").cast("string"), low_class.cast("string"), low.cast("string"), high_class.cast("string"), high.cast("string"))

    def listed(count, build):
        return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), build)).otherwise(F.array())

    c, b = F.col("class"), F.col("block")
    own = listed(F.col("blocks"), lambda o: F.struct(name(c, F.least(b, o), c, F.greatest(b, o)).alias("unit"), F.when(b <= o, 0).otherwise(1).alias("side")))
    down = listed(F.coalesce("below", F.lit(0)), lambda o: F.struct(name(c - 1, o, c, b).alias("unit"), F.lit(1).alias("side")))
    up = listed(F.coalesce("above", F.lit(0)), lambda o: F.struct(name(c, b, c + 1, o).alias("unit"), F.lit(0).alias("side")))
    large = placed.select("doc", F.explode(F.concat(own, down, up)).alias("u")).select("doc", "u.unit", "u.side")
    return small.unionByName(large)


def _tiles(order: list[int], sets: list[np.ndarray]):
    tile, held = [], 0
    for i in order:
        if tile and (len(tile) == TILE_ROWS or held + len(sets[i]) > TILE_SHINGLES):
            yield tile
            tile, held = [], 0
        tile.append(i)
        held += len(sets[i])
    if tile:
        yield tile


def _common(a: list[int], b: list[int], sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections between the sets of two tiles."""
    def stacked(tile):
        return np.concatenate([sets[i] for i in tile]), np.repeat(np.arange(len(tile)), [len(sets[i]) for i in tile])

    (values_a, row_a), (values_b, row_b) = stacked(a), stacked(b)
    if a is b:
        found, counts = np.unique(values_a, return_counts=True)
        shared = found[counts > 1]
    else:
        shared = np.intersect1d(values_a, values_b)
    out = np.zeros((len(a), len(b)), dtype=np.int64)

    def places(values, row):
        at = np.searchsorted(shared, values)
        hit = at < len(shared)
        hit[hit] = shared[at[hit]] == values[hit]
        return at[hit], row[hit]

    at_a, row_a = places(values_a, row_a)
    at_b, row_b = places(values_b, row_b)
    for low in range(0, len(shared), TILE_COLUMNS):
        def matrix(at, row, n):
            m = np.zeros((n, min(TILE_COLUMNS, len(shared) - low)), dtype=np.float32)
            inside = (at >= low) & (at < low + TILE_COLUMNS)
            m[row[inside], at[inside] - low] = 1
            return m
        left = matrix(at_a, row_a, len(a))
        right = left if a is b else matrix(at_b, row_b, len(b))
        out += (left @ right.T).astype(np.int64)
    if a is b:
        np.fill_diagonal(out, [len(sets[i]) for i in a])
    return out


def confirmed(sets: list[np.ndarray], sides: list[int], percent: int = SIMILAR) -> np.ndarray:
    """A label for each set: equal labels are joined by links of at least `percent` similarity. With two sides only links
    between them count."""
    label = np.arange(len(sets))
    tiles = []
    for side in sorted(set(sides)):
        order = sorted((i for i in range(len(sets)) if sides[i] == side), key=lambda i: len(sets[i]))
        tiles.append(list(_tiles(order, sets)))
    pairs = [(a, b) for i, a in enumerate(tiles[0]) for b in tiles[0][i:]] if len(tiles) == 1 else [(a, b) for a in tiles[0] for b in tiles[1]]
    for a, b in pairs:
        size_a, size_b = (np.array([len(sets[i]) for i in t]) for t in (a, b))
        if 100 * min(size_a.max(), size_b.max()) < percent * max(size_a.min(), size_b.min()):
            continue
        both = _common(a, b, sets)
        linked = 100 * both >= percent * (size_a[:, None] + size_b[None, :] - both)
        rows, columns = np.array(a), np.array(b)
        for i in range(len(a)):
            met = label[columns[linked[i]]]
            if len(met) and (met != label[rows[i]]).any():
                met = np.unique(np.append(met, label[rows[i]]))
                label[np.isin(label, met)] = met[0]
    return label


def _consecutive(batches):
    """Rows of equal unit, which follow each other: lists of (doc, side, text). Repeated rows follow each other, too, and count once."""
    unit, held = None, []
    for batch in batches:
        for name, doc, side, text in zip(*(c.to_pylist() for c in batch.columns)):
            if name != unit and held:
                yield held
                held = []
            unit = name
            if not held or held[-1] != (doc, side, text):
                held.append((doc, side, text))
    if held:
        yield held


def confirmed_links(docs: DataFrame, units: DataFrame, percent: int = SIMILAR) -> DataFrame:
    """(a, b): links that join whatever is similar within each unit."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    dealt = (units.join(docs.select(F.col("doc_id").alias("doc"), "text"), "doc").select("unit", "doc", "side", "text")
             .repartition("unit").sortWithinPartitions("unit", "doc", "side", F.xxhash64("text")))
    kind = docs.schema["doc_id"].dataType

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        arrow_type = to_arrow_type(kind)
        for rows in _consecutive(batches):
            if len(rows) < 2:
                continue
            found, begin = shingle_sets(words_of(pa.array([r[2] for r in rows], pa.large_string()), NOT_BLANK, True))
            sets = [np.unique(found[x:y]) for x, y in zip(begin, begin[1:])]
            label = confirmed(sets, [r[1] for r in rows], percent)
            moved = np.flatnonzero(label != np.arange(len(rows)))
            if len(moved):
                yield arrow_batch(a=pa.array([rows[i][0] for i in moved], arrow_type), b=pa.array([rows[label[i]][0] for i in moved], arrow_type))

    return map_arrow(dealt, run, f"a {id_type}, b {id_type}")


def near_duplicates(docs: DataFrame, percent: int = SIMILAR, groups: int = GROUPS) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest document reachable over links), kept; one row per input row. Pairs of
    `percent` similarity or more link."""
    docs = texts(docs)
    signed = stored(signatures(docs, groups), "signatures")
    same = ["n_shingles", "print_1", "print_2"]
    classes = stored(signed.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*same)
                     .agg(F.min("doc_id").alias("doc"), F.first("bands").alias("bands"), F.first("size").alias("size")), "classes")
    copies = (signed.join(classes.select(*same, "doc"), same).where("doc_id != doc")
              .select(F.col("doc_id").alias("a"), F.col("doc").alias("b")))
    # A document whose rows have different texts may stand for several classes; its largest text is what is measured.
    sizes = classes.groupBy("doc").agg(F.max("n_shingles").alias("n_shingles"), F.sum("size").alias("size"))
    members = stored(candidate_groups(classes, groups).join(sizes, "doc"), "members")
    links = confirmed_links(docs, comparison_units(members, percent), percent).unionByName(copies)
    found = components(links)
    component = F.coalesce("component", "doc_id")
    return (signed.join(found, signed["doc_id"] == found["node"], "left")
            .select("doc_id", "n_shingles", component.alias("component_id"),
                    F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")))
