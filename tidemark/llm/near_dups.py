"""Near-duplicates by an LSH forest over MinHash signatures, with links confirmed on whole shingle sets.

Texts with equal sets are one node. Each of TREES sorted orders is by a signature of its own: nodes that share its first
DEPTH values are a region, and the values after them order the region. Candidates are

1. neighbours with the longest common prefixes in a region's order; a crowded region is ordered and dealt by more values,
   the deeper the more crowded it is, so no order is sorted in one task;
2. each node with the hub of its region, the node that shares most regions with others; this takes one pair a node where
   thousands of copies resemble one original;
3. where a region still holds more than one component, each node with the likeliest node of another component;
4. what is left: in regions that even then hold more than one component, each node of a smaller one against the whole of a
   larger one, if the signatures of any pair agree enough. Components are dealt in tiles that hold their nodes' sets, and
   a node gives one link a tile at most. So no link of a region is lost however crowded it is, and no pairs are written.

A screen by signatures comes before each exact confirmation; it has four standard deviations of room.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import release, stored, tune
from tidemark.operators.graph import connected_components

WORDS = 5
#: Links have 100 * intersection >= SIMILARITY * union.
SIMILARITY = 75
#: A pair at the threshold shares the first DEPTH values of at least one of TREES orders with a chance of 99.998 %.
TREES, DEPTH = 28, 4
VALUES = TREES * DEPTH
#: Pairs whose signatures agree less than this aren't confirmed: 0.75 less four standard deviations.
SCREEN = 0.75 - 4 * (0.75 * 0.25 / VALUES) ** 0.5
#: Regions with more nodes than this are ordered by more values.
CROWDED = 64
NEIGHBOURS = 2
TILE = 256
#: Nodes that are held against a tile in one group.
ASKING = 2048
#: Nodes whose sets are needed are broadcast up to this many rows (16 bytes each); beyond it they are joined by a shuffle.
BROADCAST_ROWS = 400_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: bytes, hashes: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct hashes of all runs of WORDS words; of the whole text if it has fewer words."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    span = min(WORDS, len(h))
    out = np.full(len(h) - span + 1, span, np.uint64)
    for k in range(span):
        out = (out ^ h[k : k + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique((out ^ (out >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9))


_FACTORS = np.random.default_rng(20240501).integers(1, 1 << 32, size=(2, VALUES, 1), dtype=np.uint32)
_MULTIPLY, _ADD = _FACTORS[0] | np.uint32(1), _FACTORS[1]


def signature(found: np.ndarray) -> np.ndarray:
    """The least value of each of VALUES hash functions."""
    x = (found >> np.uint64(32)).astype(np.uint32)
    out = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 4096):
        out = np.minimum(out, (x[None, at : at + 4096] * _MULTIPLY + _ADD).min(1))
    return out


def _fold(values: np.ndarray) -> np.ndarray:
    """One 64-bit hash of each row."""
    h = np.zeros(len(values), np.uint64)
    for k in range(values.shape[1]):
        h = (h ^ values[:, k]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def orders(sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each tree the region, and the values after it as one number that sorts like a list of two."""
    wide = sig.astype(np.uint64)
    tree = np.arange(TREES, dtype=np.uint64)[:, None]
    region = _fold(np.concatenate([tree, wide.reshape(TREES, DEPTH)], 1))
    later = np.roll(wide, -DEPTH).reshape(TREES, DEPTH)
    label = (_fold(later[:, :2]) >> np.uint64(32) << np.uint64(32)) | (_fold(later) >> np.uint64(32))
    return region.view(np.int64), label.view(np.int64)


SKETCH_SCHEMA = "row long, doc_id long, text_hash long, n_shingles long, set_key binary, sketch binary, regions array<long>, labels array<long>"
SKETCHES = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("sketch", pa.binary()),
     ("regions", pa.list_(pa.int64())), ("labels", pa.list_(pa.int64()))]
)


def sketches(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, hashes = TaskContext.get().partitionId() << 36, _Hashes()
        for batch in batches:
            out = []
            for doc_id, text_hash, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                found = shingles(text.as_buffer().to_pybytes(), hashes) if text.is_valid else np.zeros(0, np.uint64)
                if len(found):
                    sig = signature(found)
                    region, label = orders(sig)
                    out.append((row, doc_id, text_hash, len(found), xxhash.xxh3_128_digest(found.tobytes()), sig.astype(np.uint8).tobytes(), region, label))
                else:
                    out.append((row, doc_id, text_hash, 0, None, None, None, None))
                row += 1
            if len(hashes) > 500_000:
                hashes.clear()
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), SKETCHES.types, strict=True)], schema=SKETCHES)

    return _texts(docs).mapInArrow(run, SKETCH_SCHEMA)


def _texts(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text"))


def agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity from rows of low bytes; two values differ but have the same byte with a chance of 1 in 256."""
    return ((a == b).mean(1) - 1 / 256) / (1 - 1 / 256)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, VALUES)


def screened(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b, star, likeness) of the pairs whose signatures agree enough."""
    ends = nodes.select("node", "sketch")
    both = pairs.join(ends.select(F.col("node").alias("a"), F.col("sketch").alias("s")), "a").join(ends.select(F.col("node").alias("b"), F.col("sketch").alias("t")), "b")
    out = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("star", pa.bool_()), ("likeness", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                like = agreement(_matrix(batch.column(3)), _matrix(batch.column(4)))
                yield pa.record_batch([batch.column(0), batch.column(1), batch.column(2), pa.array(like)], schema=out).filter(pa.array(like >= SCREEN))

    return both.select("a", "b", "star", "s", "t").mapInArrow(run, "a long, b long, star boolean, likeness double")


def node_sets(members: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, shingles) of the nodes that share a region with another. Their texts are read again, no others' sets kept."""
    needed = stored(nodes.select("node", "doc_id", "text_hash").join(members.select("node").distinct(), "node", "left_semi"))
    asked = needed.select("node", F.col("doc_id").alias("n_id"), F.col("text_hash").alias("n_hash"))
    if needed.count() <= BROADCAST_ROWS:
        asked = F.broadcast(asked)
    texts = _texts(docs)
    found = texts.join(asked, (texts.text_hash == asked.n_hash) & texts.doc_id.eqNullSafe(asked.n_id)).select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            sets = [shingles(t.as_buffer().to_pybytes(), hashes).tobytes() for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(sets, pa.binary())], names=["node", "shingles"])
            if len(hashes) > 500_000:
                hashes.clear()

    return stored(found.mapInArrow(run, "node long, shingles binary"))


def _linked(s: np.ndarray, t: np.ndarray) -> bool:
    common = len(np.intersect1d(s, t, assume_unique=True))
    return 100 * common >= SIMILARITY * (len(s) + len(t) - common)


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are links by their whole sets."""
    both = pairs.select("a", "b").join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("s")), "a").join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("t")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = [_linked(np.frombuffer(s.as_buffer(), np.uint64), np.frombuffer(t.as_buffer(), np.uint64)) for s, t in zip(batch.column(2), batch.column(3), strict=True)]
            yield pa.record_batch([batch.column(0), batch.column(1)], schema=LINKS).filter(pa.array(links, pa.bool_()))

    # a row that repeats has its set twice
    return stored(both.select("a", "b", "s", "t").mapInArrow(run, "a long, b long").distinct())


def _pair(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def first_candidates(members: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of neighbours in the orders, and (star) of nodes with their regions' hubs."""
    shared = members.groupBy("node").agg(F.sum("n").alias("shared"))
    hubs = members.join(shared, "node").groupBy("region").agg(F.max(F.struct("shared", F.negate("node").alias("least"))).alias("hub"))
    hubs = hubs.select("region", F.negate("hub.least").alias("hub"))
    stars = members.join(hubs, "region").filter("node <> hub").select(*_pair("node", "hub"), F.lit(True).alias("star"))
    deeper = (
        F.when(F.col("n") <= CROWDED, F.lit(0))
        .when(F.col("n") <= CROWDED * CROWDED, F.shiftright("label", 32))
        # nodes whose further values are equal too are dealt by chance: enough of their pairs come from other trees
        .otherwise(F.xxhash64("label", F.pmod(F.xxhash64("node"), F.greatest(F.lit(1), F.floor(F.col("n") / (CROWDED * CROWDED))))))
    )
    order = W.partitionBy("region", "deeper").orderBy("label", "node")
    near = members.withColumn("deeper", deeper).select("node", *[F.lead("node", k).over(order).alias(f"next{k}") for k in range(1, NEIGHBOURS + 1)])
    pairs = stars
    for k in range(1, NEIGHBOURS + 1):
        pairs = pairs.unionByName(near.filter(F.col(f"next{k}").isNotNull() & (F.col("node") != F.col(f"next{k}"))).select(*_pair("node", f"next{k}"), F.lit(False).alias("star")))
    return pairs.groupBy("a", "b").agg(F.bool_or("star").alias("star"))


def best_of(pairs: DataFrame) -> DataFrame:
    """For each node its likeliest pair."""
    ends = pairs.select(F.col("a").alias("node"), "a", "b", "likeness").unionByName(pairs.select(F.col("b").alias("node"), "a", "b", "likeness"))
    best = ends.groupBy("node").agg(F.max_by(F.struct("a", "b"), F.struct("likeness", F.negate("a"), F.negate("b"))).alias("best"))
    return best.select("best.a", "best.b").distinct()


def tiles_of(members: DataFrame, roots: DataFrame) -> DataFrame:
    """members of regions with more than one component, each in the tiles (i, j) of its region that it takes part in.

    A region of up to TILE nodes is one tile; a larger one is dealt to tiles of about that size, and a group is two of
    them at most.
    """
    sizes = roots.groupBy("root").agg(F.count("*").alias("size"))
    known = roots.join(sizes, "root").withColumnRenamed("root", "r")
    placed = members.join(known, "node", "left").withColumns({"root": F.coalesce("r", "node"), "size": F.coalesce("size", F.lit(1))}).drop("r")
    mixed = placed.groupBy("region").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("region")
    tiles = F.ceil(F.col("n") / TILE).cast("long")
    rest = placed.join(mixed, "region").withColumn("tile", F.pmod(F.xxhash64("node"), tiles)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1)))
    return rest.select("region", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "node", "root", "size")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of equal first three columns, which stand next to each other."""
    now, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy() for k in range(3)], 1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
        for i, j in zip(cuts, cuts[1:], strict=False):
            key = tuple(keys[i].tolist())
            if key != now and held:
                yield pa.Table.from_batches(held)
                held = []
            now = key
            held.append(batch.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held)


def _by_group(rows: DataFrame) -> DataFrame:
    return rows.repartition("region", "i", "j").sortWithinPartitions("region", "i", "j")


def candidates_elsewhere(rest: DataFrame, nodes: DataFrame) -> DataFrame:
    """Distinct screened pairs (a, b): each node with the likeliest node of its region in another component."""

    def compare(t: pa.Table) -> Iterator[tuple]:
        node, root, sketch = t["node"].to_numpy(), t["root"].to_numpy(), _matrix(t["sketch"])
        for k in range(len(node)):
            other = np.flatnonzero(root != root[k])
            if len(other):
                like = agreement(sketch[other], sketch[k : k + 1])
                best = int(like.argmax())
                if like[best] >= SCREEN:
                    b = int(node[other[best]])
                    yield min(b, int(node[k])), max(b, int(node[k]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches):
            if found := list(compare(t)):
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], schema=LINKS)

    with_sketch = rest.select("region", "i", "j", "node", "root").join(nodes.select("node", "sketch"), "node")
    return _by_group(with_sketch).select("region", "i", "j", "node", "root", "sketch").mapInArrow(run, "a long, b long").distinct()


ASKS = pa.schema([("node", pa.int64()), ("root", pa.int64())])


def asks_of(rest: DataFrame, nodes: DataFrame) -> DataFrame:
    """Distinct (node, root): nodes of a smaller component and a larger one that they may link with."""

    def compare(t: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        node, root, size, sketch = t["node"].to_numpy(), t["root"].to_numpy(), t["size"].to_numpy(), _matrix(t["sketch"])
        for k in range(len(node)):
            other = np.flatnonzero((size > size[k]) | ((size == size[k]) & (root < root[k])))
            if len(other):
                found = np.unique(root[other[agreement(sketch[other], sketch[k : k + 1]) >= SCREEN]])
                if len(found):
                    yield np.full(len(found), node[k]), found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches):
            if found := list(compare(t)):
                yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], schema=ASKS)

    with_sketch = rest.select("region", "i", "j", "node", "root", "size").join(nodes.select("node", "sketch"), "node")
    return _by_group(with_sketch).select("region", "i", "j", "node", "root", "size", "sketch").mapInArrow(run, "node long, root long").distinct()


def links_between(asks: DataFrame, members: DataFrame, roots: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) of each asking node with the component it asks, one a tile of the component at most."""
    wanted = asks.groupBy("root").agg(F.ceil(F.count("*") / ASKING).cast("long").alias("rounds"))
    placed = members.select("node").distinct().join(roots.withColumnRenamed("root", "r"), "node", "left").select("node", F.coalesce("r", "node").alias("root")).join(wanted, "root")
    tiles = placed.groupBy("root").agg(F.ceil(F.count("*") / TILE).cast("long").alias("tiles"))
    zero = F.lit(0).cast("long")
    held = placed.join(tiles, "root").select("root", F.pmod(F.xxhash64("node"), "tiles").alias("i"), F.explode(F.sequence(zero, F.col("rounds") - 1)).alias("j"), F.lit(0).alias("asks"), "node")
    asking = asks.join(wanted, "root").join(tiles, "root").select("root", F.explode(F.sequence(zero, F.col("tiles") - 1)).alias("i"), F.pmod(F.xxhash64("node"), "rounds").alias("j"), F.lit(1).alias("asks"), "node")
    whole = nodes.select("node", "sketch").join(sets.dropDuplicates(["node"]), "node")
    rows = held.unionByName(asking).join(whole, "node").repartition("root", "i", "j").sortWithinPartitions("root", "i", "j", "asks")

    def compare(t: pa.Table) -> Iterator[tuple[int, int]]:
        node, first = t["node"].to_numpy(), int((t["asks"].to_numpy() == 0).sum())
        sketch = _matrix(t["sketch"])
        own = [np.frombuffer(x.as_buffer(), np.uint64) for x in t["shingles"].combine_chunks()]
        for k in range(first, len(node)):
            like = agreement(sketch[:first], sketch[k : k + 1])
            order = np.argsort(-like, kind="stable")
            hit = next((m for m in order[like[order] >= SCREEN].tolist() if _linked(own[k], own[m])), None)
            if hit is not None:
                yield min(int(node[k]), int(node[hit])), max(int(node[k]), int(node[hit]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches):
            if found := list(compare(t)):
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], schema=LINKS)

    return rows.select("root", "i", "j", "asks", "node", "sketch", "shingles").mapInArrow(run, "a long, b long").distinct()


def _labelled(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored rows (row, doc_id, text_hash, n_shingles, set_key), and for each set_key its root and the least of its rows.

    first is struct(no_id, doc_id, row) of the smallest identifier, nulls last. No links, components or sets are brought
    to the driver.
    """
    tune(docs.sparkSession)
    rows = stored(sketches(docs))
    sets = rows.filter("n_shingles > 0")
    # texts with equal sets: their smallest row stands for them
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first")
    classes = sets.groupBy("set_key").agg(F.min("row").alias("node"), least)
    nodes = stored(sets.join(classes.select("node"), sets.row == F.col("node"), "left_semi").select(F.col("row").alias("node"), "doc_id", "text_hash", "set_key", "sketch", "regions", "labels"))
    keys = nodes.select("node", F.inline(F.arrays_zip("regions", "labels"))).select("node", F.col("regions").alias("region"), F.col("labels").alias("label"))
    crowds = keys.groupBy("region").agg(F.count("*").alias("n")).filter("n > 1")
    # each step's shuffle files go once its result is stored
    def kept(df: DataFrame) -> DataFrame:
        out = stored(df)
        del df
        release(docs.sparkSession)
        return out

    def ties(roots: DataFrame) -> DataFrame:
        return roots.select(F.col("node").alias("a"), F.col("root").alias("b"))

    members = kept(keys.join(crowds, "region"))
    own_sets = node_sets(members, nodes, docs)
    first = kept(screened(first_candidates(members), nodes))
    roots = kept(connected_components(confirmed(best_of(first).unionByName(best_of(first.filter("star"))).distinct(), own_sets)))
    more = confirmed(candidates_elsewhere(tiles_of(members, roots), nodes), own_sets)
    roots = kept(connected_components(ties(roots).unionByName(more)))
    asks = kept(asks_of(tiles_of(members, roots), nodes))
    last = kept(links_between(asks, members, roots, nodes, own_sets))
    roots = kept(connected_components(ties(roots).unionByName(last)))
    named = classes.join(roots, "node", "left").select("set_key", "first", F.coalesce("root", "node").alias("root"))
    return rows.select("row", "doc_id", "text_hash", "n_shingles", "set_key"), named


def near_duplicates(docs: DataFrame) -> DataFrame:
    """For each row of docs (doc_id, text): n_shingles, component_id (smallest identifier that links reach), kept.

    Words are runs of anything but white space in the A-Z-lowered text. Null texts and texts without words have no
    shingles and are linked with nothing. Each row is linked by its own text, also if its doc_id repeats; a null doc_id is
    never a component's name, unless all its rows have none (then they are kept). Other columns are ignored.
    """
    rows, named = _labelled(docs)
    least = named.groupBy("root").agg(F.min("first").alias("first"))
    named = named.select("set_key", "root").join(least, "root").select("set_key", F.col("first.doc_id").alias("component"))
    out = rows.select("doc_id", "n_shingles", "set_key").join(named, "set_key", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs (doc_id, text, and any other columns), one of each group of near-duplicates, and all without words.

    The row with the smallest doc_id stays, nulls last; of several with that doc_id one, so exact copies that share an
    identifier are a group like others. An empty table gives no rows. Rejected rows are told by doc_id and a hash of the
    text; texts are shuffled only if there are more than BROADCAST_ROWS of those.
    """
    rows, named = _labelled(docs)
    stays = named.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias("row"), F.lit(True).alias("stays"))
    texts = rows.filter("n_shingles > 0").select("row", "doc_id", "text_hash").join(stays, "row", "left")
    judged = texts.groupBy("doc_id", "text_hash").agg(F.coalesce(F.bool_or("stays"), F.lit(False)).alias("stays"), F.count("*").alias("n"))
    judged = stored(judged.filter("not stays or n > 1"))
    repeats = judged.filter("stays")
    counted = judged.agg(F.count("*"), F.count_if("stays")).first()

    def small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if counted[0] <= BROADCAST_ROWS else df

    # a row as one value, so that no column of it meets a name that is used here
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"))
    own_id, own_hash = F.col("doc")["doc_id"].cast("long"), F.xxhash64(F.col("doc")["text"].cast("string"))
    same = own_id.eqNullSafe(F.col("doc_id")) & (own_hash == F.col("text_hash")) & F.col("doc")["text"].isNotNull()
    out = whole.join(small(judged), same, "left_anti")
    if counted[1]:
        # of rows with the same identifier and text the first by all their columns, whatever the order of tasks
        again = whole.join(small(repeats), same, "left_semi")
        held = again.groupBy(own_id.alias("doc_id"), own_hash.alias("text_hash")).agg(F.min_by("doc", F.to_json("doc")).alias("doc"))
        out = out.unionByName(held.select("doc"))
    return out.select("doc.*")
