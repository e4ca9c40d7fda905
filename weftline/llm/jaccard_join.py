"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures.

1. Each text becomes its set of distinct word shingles (64-bit hashes, sorted). Texts with one set form a class.
2. A class of size n belongs to a size band (bands grow by 1/threshold, so linked sets lie in one band or in neighbours).
   For the two bands it can meet, its sorted hashes are cut by value into D + 1 parts, D being the largest symmetric
   difference that a linked pair of these bands can have: linked sets then agree in one whole part (pigeonhole). Half as
   many spare parts more are made and each set leaves out as many, its smallest: of the spare + 1 or more parts that agree,
   the largest is left out by neither set, and empty parts and those of one shingle don't tie strangers.
3. Classes that agree in a part are tied by a star; the connected components of the stars hold all links.
4. Passages that many texts hold tie strangers, and with the corpus these grow into one component. Classes of components that are
   too large for a tile are tied anew: each one's shingles are ordered by how many classes of the component hold them, the
   rarest first, and linked sets have a shingle in common among the first n - ceil(t * n) + 1. So texts with enough
   shingles of their own fall out.
5. Each component is cut into blocks by size band and hash, and each pair of blocks is a tile. In a tile bit counts of
   hashed bitmaps bound the overlap from above; what passes is counted exactly on the sorted hashes.

No pair leaves a task: a tile returns a row per class with its count of links and the least class it is linked to.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions.parts import mix, part_keys
from weftline.operators.graph import components
from weftline.operators.relational import looked_up
from weftline.plans.storage import discard

from .common import as_long, chunks, dealt, grouped, partitions, record, shingle_sets, stored, text_bytes

_SETS = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n", pa.int64()), ("class", pa.int64())])
_BLOBS = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("classes", pa.binary()), ("which", pa.binary())])
_OWNED = pa.schema([("bucket", pa.int32()), ("entries", pa.binary())])
_ENTRY = np.dtype([("class", "<i8"), ("key", "<u8"), ("owners", "<u4"), ("n", "<u4")])
_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_LINKS = pa.schema([("class", pa.int64()), ("root", pa.int64()), ("links", pa.int64())])


def _class(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = record(_SETS)
        for rows, data, bounds in chunks(batches):
            sets = shingle_sets(data, bounds, width)
            yield make(rows.column("doc_id"), rows.column("text_hash"), [len(s) for s in sets], [_class(s) for s in sets])

    return run


def _blobs(width: int, num: int, den: int, n: int):
    """(key, class) entries of a task, each class once, grouped by the bucket of the key; classes as numbers of a table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = record(_BLOBS)
        seen, held, size = set(), [], 0

        def flush():
            keys, nodes = (np.concatenate(x) for x in zip(*held))
            bucket = ((keys >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(n + 1, dtype=np.uint64))
            for b in np.flatnonzero(cuts[1:] > cuts[:-1]):
                own = order[cuts[b] : cuts[b + 1]]
                table, which = np.unique(nodes[own], return_inverse=True)
                yield make([b], [keys[own].tobytes()], [table.tobytes()], [which.astype(np.uint32).tobytes()])

        for _, data, bounds in chunks(batches):
            for s in shingle_sets(data, bounds, width):
                if len(s) and (node := _class(s)) not in seen:
                    seen.add(node)
                    k = part_keys(s, num, den)
                    held.append((k, np.full(len(k), node, np.int64)))
                    size += len(k)
            if size > 2_000_000:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    return run


def _bucket(h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """An order by n buckets of scrambled words, and the buckets' bounds in it."""
    bucket = ((h >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(n + 1, dtype=np.uint64))


def _dealt_entries(held: list[np.ndarray], h: np.ndarray, n: int) -> Iterator[pa.RecordBatch]:
    entries = np.concatenate(held)
    order, cuts = _bucket(h, n)
    for b in np.flatnonzero(cuts[1:] > cuts[:-1]):
        yield record(_OWNED)([b], [entries[order[cuts[b] : cuts[b + 1]]].tobytes()])


def _entries(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
    held = [np.frombuffer(x.as_buffer(), _ENTRY) for batch in batches for x in batch.column("entries")]
    return np.concatenate(held) if held else np.zeros(0, _ENTRY)


def _shingles(width: int, n: int):
    """An entry per class and shingle, by the bucket of the key: the shingle within the class's component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for rows, data, bounds in chunks(batches):
            scope = mix(rows.column("component").to_numpy().view(np.uint64))
            for node, of, s in zip(rows.column("class").to_pylist(), scope, shingle_sets(data, bounds, width)):
                own = np.zeros(len(s), _ENTRY)
                own["class"], own["key"], own["n"] = node, mix(s ^ of), len(s)
                held.append(own)
                size += len(s)
            if size > 1_000_000:
                yield from _dealt_entries(held, np.concatenate([x["key"] for x in held]), n)
                held, size = [], 0
        if size:
            yield from _dealt_entries(held, np.concatenate([x["key"] for x in held]), n)

    return run


def _owners(n: int):
    """The entries of keys that more than one class owns, with the count of owners, by the bucket of the class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = _entries(batches)
        if not len(e):
            return
        e = e[np.lexsort((e["class"], e["key"]))]
        k, v = e["key"], e["class"]
        e = e[np.concatenate([[True], (k[1:] != k[:-1]) | (v[1:] != v[:-1])])]  # repeated rows bring a class's text twice
        first = np.flatnonzero(np.concatenate([[True], e["key"][1:] != e["key"][:-1]]))
        size = np.diff(np.append(first, len(e)))
        e["owners"] = np.repeat(size, size)
        e = e[e["owners"] > 1]
        for at in range(0, len(e), 1_000_000):
            own = e[at : at + 1_000_000]
            yield from _dealt_entries([own], mix(own["class"].view(np.uint64)), n)

    return run


def _rarest(num: int, den: int, n: int):
    """Of each class the shared keys among its n - ceil(t * n) + 1 rarest, by the bucket of the key, as _blobs gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = _entries(batches)
        if not len(e):
            return
        e = e[np.lexsort((e["key"], e["owners"], e["class"]))]
        first = np.flatnonzero(np.concatenate([[True], e["class"][1:] != e["class"][:-1]]))
        shared = np.diff(np.append(first, len(e)))
        size = e["n"][first].astype(np.int64)
        most = size + num * size // -den + 1 - (size - shared)  # shingles of its own come before the shared ones
        e = e[np.arange(len(e)) - np.repeat(first, shared) < np.repeat(most, shared)]
        order, cuts = _bucket(e["key"], n)
        for b in np.flatnonzero(cuts[1:] > cuts[:-1]):
            own = e[order[cuts[b] : cuts[b + 1]]]
            table, which = np.unique(own["class"], return_inverse=True)
            yield record(_BLOBS)([b], [own["key"].tobytes()], [table.tobytes()], [which.astype(np.uint32).tobytes()])

    return run


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ties the classes that share a key to the least of them."""
    keys, nodes = [], []
    for batch in batches:
        keys += [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("keys")]
        nodes += [np.frombuffer(x.as_buffer(), np.int64)[np.frombuffer(y.as_buffer(), np.uint32)] for x, y in zip(batch.column("classes"), batch.column("which"))]
    if not keys:
        return
    k, v = np.concatenate(keys), np.concatenate(nodes)
    del keys, nodes
    order = np.argsort(k)
    k, v = k[order], v[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    size = np.diff(np.append(first, len(k)))
    least = np.repeat(np.minimum.reduceat(v, first), size)
    pairs = np.stack([v, least])[:, v != least]
    pairs = np.unique(pairs, axis=1)
    for at in range(0, pairs.shape[1], 100_000):
        yield record(_EDGES)(pairs[0, at : at + 100_000], pairs[1, at : at + 100_000])


def tile_links(sets: list[np.ndarray], ids: np.ndarray, weight: np.ndarray, block: np.ndarray, within: bool, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """For each set the least id it is connected to here, and the weight of the sets it is linked to.

    within: all pairs count; else those of sets in different blocks.
    """
    order = np.argsort([len(s) for s in sets], kind="stable")
    size = np.array([len(sets[i]) for i in order], np.int64)
    bits = max(256, 1 << int(4 * size[-1]).bit_length())
    bits = min(bits, 1 << 15)
    maps = np.zeros((len(sets), bits // 64), np.uint64)
    for r, i in enumerate(order):
        at = (sets[i] & np.uint64(bits - 1)).astype(np.int64)
        np.bitwise_or.at(maps[r], at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
    root = list(range(len(sets)))
    links = np.zeros(len(sets), np.int64)
    w, b = weight[order], block[order]

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for r in range(len(sets)):
        to = int(np.searchsorted(size, size[r] * den // num, "right"))
        if to <= r + 1:
            continue
        mine = sets[order[r]]
        only = np.bitwise_count(maps[r] & ~maps[r + 1 : to]).sum(axis=1, dtype=np.int64)
        theirs = np.bitwise_count(maps[r + 1 : to] & ~maps[r]).sum(axis=1, dtype=np.int64)
        bound = np.minimum(size[r] - only, size[r + 1 : to] - theirs)
        ok = den * bound >= num * (size[r] + size[r + 1 : to] - bound)
        if not within:
            ok &= b[r + 1 : to] != b[r]
        js = np.flatnonzero(ok) + r + 1
        for part in np.array_split(js, max(1, math.ceil(size[js].sum() / 4_000_000))) if len(js) else ():
            every = np.concatenate([sets[order[j]] for j in part])
            at = np.searchsorted(mine, every)
            at[at == len(mine)] = 0
            same = np.add.reduceat((mine[at] == every).astype(np.int64), np.concatenate([[0], np.cumsum(size[part])[:-1]]))
            for j in part[den * same >= num * (size[r] + size[part] - same)].tolist():
                links[r] += w[j]
                links[j] += w[r]
                x, y = find(r), find(j)
                if x != y:
                    root[y] = x
    least: dict[int, int] = {}
    for r in range(len(sets)):
        f = find(r)
        least[f] = min(least.get(f, 1 << 63), int(ids[order[r]]))
    out_root, out_links = np.empty(len(sets), np.int64), np.empty(len(sets), np.int64)
    for r, i in enumerate(order):
        out_root[i], out_links[i] = least[find(r)], links[r]
    return out_root, out_links


def _tiles(width: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = record(_LINKS)
        held: list[np.ndarray] = [[], [], []]
        for tile in grouped(batches, "tile"):
            ids = tile.column("class").to_numpy()
            _, one = np.unique(ids, return_index=True)  # repeated rows bring a class's text twice
            tile = tile.take(one)
            ids = ids[one]
            data, bounds = text_bytes(tile.column("text").combine_chunks())
            found = tile_links(shingle_sets(data, bounds, width), ids, tile.column("copies").to_numpy(), tile.column("block").to_numpy(), tile.column("within")[0].as_py(), num, den)
            for x, y in zip(held, (ids, *found)):
                x.append(y)
            if sum(map(len, held[0])) > 20_000:
                yield make(*map(np.concatenate, held))
                held = [[], [], []]
        if held[0]:
            yield make(*map(np.concatenate, held))

    return run


def jaccard_join(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, tile_docs: int = 1024, tile_shingles: int = 500_000) -> DataFrame:
    """Near-duplicate classes and links of the whole texts of docs (doc_id, text; other columns are ignored).

    Returns a row per input row: doc_id, n_shingles, component_id (least doc_id reachable by links; null if all ids of the
    component are null; the own doc_id without words), n_links (other rows linked to it, copies of its set included).
    Two texts link when den * |intersection| >= num * |union| of their sets of distinct width-word shingles.
    Null and empty texts have no shingles and no links; repeated rows are copies; an empty table gives an empty result.
    tile_docs and tile_shingles bound what one tile side holds; larger components are cut into more tiles, none is dropped.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    sets = stored(keyed.mapInArrow(_sets(width), "doc_id long, text_hash long, n long, class long"), "sets")
    classes = stored(sets.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"), F.min(F.struct("doc_id", "text_hash")).alias("holder"), F.first("n").alias("n")), "classes")
    # The texts are read again: signatures of all sets are larger than what else is kept.
    blobs = keyed.select("text").mapInArrow(_blobs(width, num, den, n), "bucket int, keys binary, classes binary, which binary")
    stars = dealt(blobs, "bucket", n).mapInArrow(_stars, "a long, b long")
    near = components(stars, "stars").join(classes, F.col("node") == F.col("class")).drop("node")
    # Only these texts are dealt out again from here on.
    holds = (F.col("holder.text_hash") == F.col("text_hash")) & F.col("holder.doc_id").eqNullSafe(F.col("doc_id"))
    near = stored(near.join(keyed, holds).select("class", "component", "copies", "n", "text"), "near")

    def fit(near: DataFrame) -> tuple[DataFrame, DataFrame]:
        """component of those that one tile holds, and of the others."""
        whole = near.groupBy("component").agg(F.count("*").alias("k"), F.sum("n").alias("shingles")).withColumn("fits", (F.col("k") <= tile_docs) & (F.col("shingles") <= tile_shingles))
        return whole.where("fits").select("component"), whole.where("not fits").select("component")

    _, large = fit(near)
    wide = stored(near.join(large, "component", "left_semi").select(near.columns), "near-wide")
    if not wide.isEmpty():
        owned = dealt(wide.select("class", "component", "text").mapInArrow(_shingles(width, n), "bucket int, entries binary"), "bucket", n).mapInArrow(_owners(n), "bucket int, entries binary")
        rarest = dealt(owned, "bucket", n).mapInArrow(_rarest(num, den, n), "bucket int, keys binary, classes binary, which binary")
        anew = components(dealt(rarest, "bucket", n).mapInArrow(_stars, "a long, b long"), "stars-anew").withColumnsRenamed({"node": "class", "component": "_anew"})
        tied = wide.join(anew, "class").select("class", F.col("_anew").alias("component"), "copies", "n", "text")
        first, near = near, stored(near.join(large, "component", "left_anti").select(near.columns).union(tied), "near-anew")
        discard(first)
    discard(wide)

    band = F.floor(F.log(F.col("n")) / math.log(den / num) + 1e-9).cast("int")
    near = near.withColumn("band", band)
    per = near.groupBy("component", "band").agg(F.count("*").alias("k"), F.sum("n").alias("shingles"))
    small, large = fit(near)
    blocks = per.join(large, "component").select("component", F.col("band").alias("other"), F.greatest(F.ceil(F.col("k") / (tile_docs // 2)), F.ceil(F.col("shingles") / (tile_shingles // 2))).alias("cuts"))
    one = near.join(small, "component", "left_semi").select("class", "copies", F.xxhash64("component").alias("tile"), F.lit(0).cast("long").alias("block"), F.lit(True).alias("within"), "text")
    in_block = near.join(blocks.select("component", F.col("other").alias("band"), "cuts"), ["component", "band"]).select("component", "band", "class", "copies", "text", (F.col("band") * 1_000_000 + F.pmod(F.xxhash64("class"), "cuts")).alias("block"))
    met = in_block.join(blocks, "component").where("abs(band - other) <= 1").select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)).alias("cut"))
    met = met.withColumn("partner", F.col("other") * 1_000_000 + F.col("cut"))
    many = met.select("class", "copies", F.xxhash64("component", F.least("block", "partner"), F.greatest("block", "partner")).alias("tile"), "block", (F.col("block") == F.col("partner")).alias("within"), "text")
    tiled = one.union(many).repartition(n, "tile").sortWithinPartitions("tile")
    links = stored(tiled.mapInArrow(_tiles(width, num, den), "class long, root long, links long"), "links")
    joined = components(links.select(F.col("class").alias("a"), F.col("root").alias("b")), "joined")
    count = links.groupBy("class").agg(F.sum("links").alias("links"))
    known = classes.join(joined.select(F.col("node").alias("class"), "component"), "class", "left").join(count, "class", "left").select("class", "copies", "least", F.coalesce("component", "class").alias("component"), F.coalesce("links", F.lit(0)).alias("links"))
    head = known.groupBy("component").agg(F.min("least").alias("component_id"))
    named = known.join(head, "component").select("class", "component_id", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    out = sets.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("class")).alias("class"))
    out = looked_up(out, named, ["class"], ["doc_id"])
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def keep_representatives(docs: DataFrame, **options) -> DataFrame:
    """docs without all but one row of each component: the row with the least doc_id stays; rows without words or doc_id all stay; among equal doc_ids all stay."""
    found = jaccard_join(docs.select("doc_id", "text"), **options)
    drop = found.where("component_id is not null and doc_id is not null and component_id <> doc_id").select("doc_id").distinct()
    return docs.join(drop, "doc_id", "left_anti")
