"""MinHash near-duplicates by bottom-k sketches of one hash function.

A document is the set of hashes of its word shingles; its sketch is the SKETCH smallest of
them. Documents of equal sets are one node. Inverted lists of the retained values say which
nodes overlap; since two sketches of a near pair share at least a share FLOOR of their
values, a node needs listing only under its rarest ones (of `size` values kept, in order of
how many nodes hold them, the first size - needed + 1), so a value that very many nodes
hold matters only to nodes that hold little else.

Of an overlapping pair the smallest SKETCH values of the union, of which the sketches tell
how many both hold, estimate the similarity. Pairs below FLOOR go, and the whole sets of the
others are compared. At FLOOR, a pair of similarity 0.8 is lost once in 10^12 times.

Lists are worked off in rounds, and a pair of nodes that are connected already is not
compared again: each list's first node with the others, then its node of most links, the
hub, with those of other components. Pairs that the hub does not connect are found by what
tells them from the hub, of which near nodes share a part (`_differences`); so a large group
of copies that are not quite near each other does not come to all of its pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladewerk.llm import common
from ladewerk.llm.common import cut, drop_folder, lean_batches, released, small_batches, stored, texts
from ladewerk.llm.components import components
from ladewerk.llm.simhash import shingle_set, words_of

SKETCH, FLOOR = 96, 0.45
#: Nodes that share a change and are met with others at once; classes of how many changes.
BLOCK, CLASSES = 512, 32
#: Lists of so few nodes are compared pair by pair.
FEW_NODES = 16
#: How many sets a task remembers to have given.
REMEMBERED = 100_000


def new_folder(spark: SparkSession) -> str:
    return common.new_folder(spark, "minhash")


def merge_join(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """A join that is the same at every size of its sides."""
    return left.join(right.hint("merge"), on, how)


def set_digest(values: np.ndarray) -> bytes | None:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n, digest (null for an empty set) and sketch of each row's set of shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.sort(shingle_set(words_of(t), size).view(np.int64)) for t in texts(batch.column("text"))]
            columns = [
                batch.column("doc_id"), pa.array(map(len, sets), pa.int64()), pa.array(map(set_digest, sets), pa.binary()),
                pa.array([s[:SKETCH] for s in sets], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "digest", "sketch"])

    return small_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(lean_batches(run), "doc_id long, n long, digest binary, sketch array<long>")


def _needed(n: Column, similarity: float) -> Column:
    """How many values of its sketch a node shares with any near one, at least: of a whole
    set its share of similarity, of a cut one the share that the estimate asks for."""
    cut_short = F.ceil(F.lit(FLOOR * SKETCH))
    return F.when(n > SKETCH, cut_short).otherwise(F.least(cut_short, F.ceil(n * similarity - 1e-9)))


def inverted_lists(kept: DataFrame, similarity: float) -> DataFrame:
    """(value, node, n) of the values that decide whether nodes (node, n, sketch) are near,
    where more than one node holds the value."""
    held = kept.select("node", "n", F.explode("sketch").alias("value"))
    shared = held.groupBy("value").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1")
    rows = merge_join(held, shared, "value")
    # A node's other values are its own alone: they come first, and need no list.
    found = rows.groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("holders", "value"))).alias("values"))
    own = F.least("n", F.lit(SKETCH)) - F.size("values")
    take = F.least("n", F.lit(SKETCH)) - _needed(F.col("n"), similarity) + 1 - own
    return found.where(take > 0).select("node", "n", F.explode(F.slice("values", F.lit(1), take.cast("int"))).alias("one")).select(F.col("one.value").alias("value"), "node", "n")


def _sizes_fit(a: str, b: str, similarity: float) -> Column:
    """Whether sets of so many can be similar at all."""
    return F.least(a, b) >= F.greatest(a, b) * similarity - 1e-6


def whole_sets(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(node, whole) of nodes (node, digest): the sorted set of each, read from the documents
    again. A bitmap of fixed size keeps most other documents from being dealt out."""
    place = F.conv(F.hex(F.substring("digest", 1, 3)), 16, 10).cast("long") + 1
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    with released(docs.sparkSession):
        pieces = {r["piece"]: bytes(r["bits"]) for r in nodes.groupBy(F.bitmap_bucket_number(place).alias("piece")).agg(bits).collect()}
    table = docs.sparkSession.sparkContext.broadcast(b"".join(pieces.get(i + 1, b"").ljust(4096, b"\0") for i in range(1 << 9)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, given = table.value, set()
        for batch in batches:
            digests, sets = [], []
            for text in texts(batch.column("text")):
                values = np.sort(shingle_set(words_of(text), size).view(np.int64))
                digest = set_digest(values)
                if digest is None or digest in given:
                    continue
                at = int.from_bytes(digest[:3], "big")
                if wanted[at >> 3] >> (at & 7) & 1:
                    given.add(digest)
                    digests.append(digest)
                    sets.append(values)
            if len(given) > REMEMBERED:
                given.clear()
            if digests:
                yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], ["digest", "whole"])

    read = small_batches(docs).select("text").mapInArrow(lean_batches(run), "digest binary, whole array<long>")
    # Copies in different tasks give the same set.
    return merge_join(read, nodes.select("digest", "node"), "digest").groupBy("node").agg(F.first("whole").alias("whole"))


def _alike(both: Column, a: Column, b: Column, similarity: float) -> Column:
    percent = round(similarity * 100)
    return 100 * both >= percent * (a + b - both)


def _near(pairs: DataFrame, held: DataFrame, whole: DataFrame, similarity: float, folder: str) -> DataFrame:
    """The pairs (a, b) whose sets are similar, judged by their sketches and, where a sketch
    is not the whole set, by the whole sets."""
    for side in ("a", "b"):
        pairs = merge_join(pairs, held.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"s_{side}")), side)
    union = F.slice(F.array_sort(F.array_union("s_a", "s_b")), 1, SKETCH)
    judged = pairs.select(
        "a", "b", "n_a", "n_b", F.size(F.array_intersect("s_a", "s_b")).alias("both"),
        F.size(F.array_intersect(F.array_intersect("s_a", "s_b"), union)).alias("seen"), (F.greatest("n_a", "n_b") <= SKETCH).alias("known"),
    )
    judged = stored(judged.where((F.col("known") & _alike(F.col("both"), F.col("n_a"), F.col("n_b"), similarity)) | (~F.col("known") & (F.col("seen") >= FLOOR * SKETCH))), f"{folder}/judged")
    rest = judged.where("NOT known").select("a", "b", "n_a", "n_b")
    for side in ("a", "b"):
        rest = merge_join(rest, whole.select(F.col("node").alias(side), F.col("whole").alias(f"w_{side}")), side)
    both = F.size(F.array_intersect("w_a", "w_b"))
    confirmed = rest.where(_alike(both, F.col("n_a"), F.col("n_b"), similarity)).select("a", "b")
    return judged.where("known").select("a", "b").unionByName(confirmed)


def _pairs(rows: DataFrame, similarity: float) -> DataFrame:
    """Distinct pairs (a, b), a < b, of rows (x, y, n_x, n_y) whose sizes fit."""
    return rows.where((F.col("x") != F.col("y")) & _sizes_fit("n_x", "n_y", similarity)).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _open_lists(lists: DataFrame, of: DataFrame) -> DataFrame:
    """lists with each node's component and how many members a list has, without lists that
    lie in one component."""
    rows = merge_join(lists, of, "node", "left").select("value", "node", "n", F.coalesce("component", "node").alias("component"))
    many = rows.groupBy("value").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("members"))
    return merge_join(rows, many.where("low < high").select("value", "members"), "value")


def _spokes(rows: DataFrame, weight: DataFrame, similarity: float) -> DataFrame:
    """Pairs of each list's hub with the list's nodes of other components."""
    met = merge_join(rows, _hubs(rows, weight), "value").where("component <> c_hub")
    return _pairs(met.select(F.col("hub").alias("x"), F.col("n_hub").alias("n_x"), F.col("node").alias("y"), F.col("n").alias("n_y")), similarity)


def _hubs(rows: DataFrame, weight: DataFrame) -> DataFrame:
    """(value, hub, n_hub, c_hub): each list's node of most weight, of equal ones the smallest."""
    weighted = merge_join(rows, weight, "node", "left")
    heavy = F.struct((-F.coalesce("weight", F.lit(0))).alias("less"), F.col("node").alias("hub"), F.col("n").alias("n_hub"), F.col("component").alias("c_hub"))
    return weighted.groupBy("value").agg(F.min(heavy).alias("first")).select("value", "first.hub", "first.n_hub", "first.c_hub")


def _differences(rows: DataFrame, hubs: DataFrame, whole: DataFrame, similarity: float, folder: str) -> DataFrame:
    """Rows that decide which nodes of a list can be near though neither is near its hub.

    Let X and Y be what tells nodes x and y from the hub (shingles that one has and the other
    lacks). What tells x from y is then X without Y and Y without X, so near nodes share at
    least (|X| + |Y| - far * (n_x + n_y)) / 2 of it, where far = (1 - s) / (1 + s): nothing
    only if both are near the hub. And these differences are rare where the lists are long:
    copies of one text share its shingles, but not their changes. So the nodes are listed
    again under the rarest of their differences, for each class of |Y| as many as decide.
    """
    far = (1 - similarity) / (1 + similarity)
    met = merge_join(rows, hubs, "value").where("node <> hub").select("hub", "n_hub", "c_hub", "node", "n", "component").distinct()
    for side in ("hub", "node"):
        met = merge_join(met, whole.select(F.col("node").alias(side), F.col("whole").alias(f"w_{side}")), side)
    base = ["hub", "node", "n", "n_hub", "component", "near_hub", "size"]
    apart = F.concat(F.array_except("w_node", "w_hub"), F.array_except("w_hub", "w_node"))
    # The differences are kept as they are found, so that they are found once.
    pairs = stored(met.select("hub", "node", "n", "n_hub", "component", (F.col("component") == F.col("c_hub")).alias("near_hub"), apart.alias("changes")), f"{folder}/changes")
    single = pairs.select(*base[:-1], F.size("changes").alias("size"), F.explode("changes").alias("change"))
    shared = single.groupBy("hub", "change").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1")
    # The changes that no other node of the hub has come first, and need no list.
    found = merge_join(single, shared, ["hub", "change"]).groupBy(*base).agg(F.sort_array(F.collect_list(F.struct("holders", "change"))).alias("changes"))
    step = F.greatest(F.lit(1), F.ceil(F.col("n_hub") / CLASSES)).cast("int")
    widest = F.col("n") / similarity
    slack = F.ceil(far * (F.col("n") + widest) + 1e-6)
    own = F.floor(F.col("size") / step).cast("int")
    low = F.floor(F.greatest(F.lit(0), F.col("size") - slack) / step).cast("int")
    high = F.floor((F.col("size") + slack) / step).cast("int")
    dealt = found.select("*", step.alias("step"), own.alias("own"), F.explode(F.sequence(low, high)).alias("other"))
    least, most = F.col("other") * F.col("step"), (F.col("other") + 1) * F.col("step") - 1
    n_other = F.least(widest, F.col("n_hub") + most)
    needed = F.ceil((F.col("size") + least - far * (F.col("n") + n_other)) / 2 - 1e-6)
    take = F.least(F.col("size"), F.col("size") - needed + 1) - (F.col("size") - F.size("changes"))
    # Two nodes of the hub's own component need no comparison.
    useful = ~F.col("near_hub") | (most > far * (F.col("n") * similarity + F.col("n_hub")) - 1)
    chosen = dealt.where((take > 0) & useful).select(
        "hub", "node", "n", "component", "own", "other", F.explode(F.slice("changes", F.lit(1), take.cast("int"))).alias("one")
    )
    return chosen.select("hub", F.col("one.change").alias("change"), "own", "other", "node", "n", "component")


def _crossings(rows: DataFrame, weight: DataFrame, whole: DataFrame, similarity: float, folder: str) -> DataFrame:
    """Pairs of nodes of a list, of different components, that can be near though the list's
    hub did not connect them: of a list of few nodes all such pairs, of a longer one those
    that share a change. Both sides of a change that many nodes share are dealt to blocks,
    so that no task holds it whole."""
    few = rows.where(F.col("members") <= FEW_NODES)
    left, right = (few.select("value", F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("component").alias(f"c_{s}")) for s in "xy")
    direct = _pairs(merge_join(left, right, "value").where("x < y AND c_x <> c_y"), similarity)
    rows = rows.where(F.col("members") > FEW_NODES)
    listed = stored(_differences(rows, _hubs(rows, weight), whole, similarity, folder), f"{folder}/listed")
    key = ["hub", "change", "low", "high"]
    listed = listed.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
    shape = listed.groupBy(*key).agg(F.count(F.lit(1)).alias("all"), F.min("component").alias("c_low"), F.max("component").alias("c_high"))
    shape = shape.where("c_low < c_high").select(*key, F.ceil(F.col("all") / BLOCK).alias("parts"))
    shaped = merge_join(listed, shape, key)
    block = F.pmod(F.xxhash64("node"), F.col("parts"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    names = {"x": ("part", "turn"), "y": ("turn", "part")}
    sides = [
        shaped.select(*key, F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("component").alias(f"c_{s}"), F.col("own").alias(f"own_{s}"), F.col("other").alias(f"other_{s}"), block.alias(mine), every.alias(others))
        for s, (mine, others) in names.items()
    ]
    met = merge_join(*sides, [*key, "part", "turn"])
    shared = _pairs(met.where("x < y AND c_x <> c_y AND own_x = other_y AND own_y = other_x"), similarity)
    return direct.unionByName(shared).distinct()


def near_groups(docs: DataFrame, kept: DataFrame, size: int, similarity: float, first: DataFrame | None = None) -> DataFrame:
    """(node, component) of nodes (node, n, digest, sketch) that have similar ones; `first`
    may hold pairs (a, b) of nodes that are likely near, which are compared before all."""
    spark = docs.sparkSession
    folder = new_folder(spark)
    lists = stored(inverted_lists(kept, similarity), f"{folder}/lists")
    some = lists.select("node").distinct()
    held = stored(merge_join(kept, some, "node", "left_semi"), f"{folder}/held")
    # Sets no larger than a sketch are held whole by it.
    small = held.where(F.col("n") <= SKETCH).select("node", F.col("sketch").alias("whole"))
    whole = stored(whole_sets(docs, held.where(F.col("n") > SKETCH).select("digest", "node"), size).unionByName(small), f"{folder}/whole")
    if first is None:
        links = spark.createDataFrame([], "a long, b long")
        of = spark.createDataFrame([], "node long, component long")
    else:
        links = stored(_near(first, held, whole, similarity, f"{folder}/first"), f"{folder}/links")
        of = components(links)
    for turn in range(3):
        # What a turn makes on its way goes with it; its links hold those before.
        now = f"{folder}/{turn}"
        rows = stored(_open_lists(lists, of), f"{now}/rows")
        if not turn:
            weight = spark.createDataFrame([], "node long, weight long")
        else:
            ends = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node")))
            weight = cut(ends.groupBy("node").agg(F.count(F.lit(1)).alias("weight")))
        pairs = _spokes(rows, weight, similarity) if turn < 2 else _crossings(rows, last, whole, similarity, now)
        links = stored(links.unionByName(_near(pairs, held, whole, similarity, now)), f"{folder}/links{turn}")
        drop_folder(spark, now)
        of, last = components(links), weight
    # What is left to do reads the components alone, which are saved.
    drop_folder(spark, folder)
    return of


def near_duplicates(docs: DataFrame, size: int = 4, similarity: float = 0.8) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each document.

    Documents are linked if the distinct runs of `size` words (all words, if they are fewer)
    that they share are at least `similarity`, a whole percentage, of all those that either
    has. component_id is the smallest doc_id reachable, and kept marks the document that
    bears it. A null text is empty, and a text without words is linked with nothing. Rows
    that repeat a doc_id each get a result, by their own texts; a null doc_id names no
    component unless all its members' are null, whose component_id is null and which are
    all kept. An empty table gives no rows; other columns are not read.
    """
    rows = sketches(docs, size).withColumn("row", F.monotonically_increasing_id())
    found = stored(rows, f"{new_folder(docs.sparkSession)}/sketches")
    first = found.where("digest IS NOT NULL").groupBy("digest").agg(F.min("row").alias("node"), F.min("doc_id").alias("doc_id"))
    nodes = cut(first)
    kept = merge_join(found.select(F.col("row").alias("node"), "n", "digest", "sketch"), nodes.select("node"), "node", "left_semi")
    of = near_groups(docs, kept, size, similarity)
    named = merge_join(nodes, of, "node", "left").select("digest", "doc_id", F.coalesce("component", "node").alias("component"))
    ids = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    known = merge_join(named, ids, "component").select("digest", "component_id")
    out = merge_join(found.select("doc_id", "n", "digest"), known, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
