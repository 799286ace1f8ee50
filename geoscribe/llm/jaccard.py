"""Exact Jaccard join of 5-word shingle sets by pivots, windows and recursion.

Two texts link when the Jaccard similarity of their sets is at least 0.8, a
distance of at most ``r = 0.2``.  Result: per document the size of its set and
the smallest document id that is reachable by links.

1. *Copies.*  Documents with equal sets are one node, named by a 64-bit digest.  Sets
   that share it and differ in a second one are named by that instead, so it takes
   128 equal bits to take one set for another.
2. *First regions.*  Unrelated texts are at distance 1 from each other, so no
   text can serve as a pivot that tells them apart.  The first pivots are single
   shingles: the nearest pivots of a text are the shingles it holds, ties broken
   by one global order of shingles.  A partner within ``r`` misses at most a
   fifth of the ``n`` shingles, so a text placed with its first ``n // 5 + 1``
   pivots meets each partner in some region.  The order takes the hash, but puts
   shingles that are common in one of ``SAMPLE`` texts last, so that a passage
   which many texts share makes no region of unrelated texts.  (Any order is
   exact; the sample, kept as a bitmap of fixed size, only saves work.)
3. *Recursion.*  In each region some members of smaller components become pivots
   and their distances to the members of other components are taken.  Members
   within ``r`` join the pivot's component.  A member's distance to the region's
   first pivot is its ring: by the triangle inequality texts whose rings are more
   than ``r`` apart cannot link, so later pivots are only paired with the window
   of rings around their own.  Pivots leave, and the region goes on with its
   other members until all are in one component.  Sizes and a parity sketch of the
   sets, carried by the members, prove most distances too large before a pair
   becomes a row.
4. Components are merged after each round by contracting the new links.

A group of copies becomes one component within a few pivots and costs work in
proportion to its members.  Texts that share a region and link with none of its
pivots are compared with each (sizes, rings and 256-bit sketches, inside one
expression), but only pairs that these bounds leave open become rows and
fetch texts; nothing is capped and the join is exact.  All state lives in DataFrames; links and components are never
collected.

Words are runs of non-white space with A-Z in lower case.  A text with fewer
than five words is one shingle; a null or empty text has an empty set and links
with nothing.  A row with a null id gets its set size and, as it cannot be
named, no component.  Repeated rows are alike.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoscribe.llm.common import documents, materialize
from geoscribe.operators.joins import within_bounds

SHINGLE = 5
#: Rings that are further apart than a link (with room for rounding) cannot hold linked texts.
RING = 0.2 + 1e-9
SAMPLE, COMMON = 16, 4
BITMAP_BITS = 1 << 26
#: Pivots of a region in each round; the last number holds for all further ones.
PIVOTS = (1, 8, 64, 512)
#: Parity sketches: a small one for all texts, a large one for texts of more than LARGE_FROM shingles.
#: The large one has LARGE_SHARE to twice as many bits per shingle, so that it does not saturate.
SMALL_BITS, LARGE_SHARE, LARGE_FROM = 256, 1, 400
SKETCH = ("k0", "k1", "k2", "k3")
#: What a text takes along into its regions.
MEMBER = ("u", "id", "n", *SKETCH)
SALT_ROWS = 500
MEMO = 300_000
MAX_BROADCAST_ROWS = 1_000_000


# --- sets ------------------------------------------------------------------------

class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _utf8(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def shingle_set(text: bytes | None, memo: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a UTF-8 text.

    On bytes, ``lower`` touches A-Z only and ``split`` cuts at the six ASCII
    white-space characters only.
    """
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    if len(memo) > MEMO:
        memo.clear()
    codes = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    width = min(SHINGLE, len(words))
    n = len(words) - width + 1
    h = np.full(n, width, np.uint64)
    for k in range(width):
        h = (h ^ codes[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return np.unique(h)


class Naming:
    """Names of sets: the first digest, or the second where the first is one of ``shared``.

    ``bits``: length of the first digest.  ``shared`` holds about ``nodes ** 2 / 2 ** 65`` digests: a few at 10^10 nodes.
    """

    def __init__(self, bits: int = 64, shared: frozenset[int] = frozenset()):
        self.bits, self.shared = bits, shared

    def digests(self, shingles: np.ndarray) -> tuple[int, int]:
        both = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
        return (int.from_bytes(both[:8], "little", signed=True) >> (64 - self.bits),
                int.from_bytes(both[8:], "little", signed=True))

    def __call__(self, shingles: np.ndarray) -> int:
        first, second = self.digests(shingles)
        return second if first in self.shared else first


_NAMES = ("id", "n", "u", "v", "k0", "k1", "k2", "k3", "large", "sample")


def _arrays(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(f) for f in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def _parity(shingles: np.ndarray, bits: int) -> np.ndarray:
    """Parity of the number of shingles in each of ``bits`` classes, packed into longs."""
    odd = np.bincount((shingles >> np.uint64(8)) & np.uint64(bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sets(naming: Naming):
    """Rows of ``_NAMES``; ``u`` and ``v`` are the two digests."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, none = _WordHashes(), np.zeros(0, np.uint64)       # an empty slice would hold its set
        for b in batches:
            n, u, v, sketch, large, sample = [], [], [], [], [], []
            for t in _utf8(b.column("text")):
                s = shingle_set(t, memo)
                first, second = naming.digests(s)
                n.append(len(s))
                u.append(first)
                v.append(second)
                sketch.append(_parity(s, SMALL_BITS))
                large.append(_parity(s, 1 << (LARGE_SHARE * len(s)).bit_length()).view(np.uint64) if len(s) > LARGE_FROM else none)
                sample.append(s if first % SAMPLE == 0 else none)
            parts = np.stack(sketch) if sketch else np.zeros((0, 4), np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), *(pa.array(x, pa.int64()) for x in (n, u, v)),
                 *(pa.array(np.ascontiguousarray(parts[:, i])) for i in range(4)), _arrays(large), _arrays(sample)],
                names=list(_NAMES))

    return run


def _prefixes(bitmap: np.ndarray, naming: Naming):
    """``(reg, u)``: the first ``n // 5 + 1`` shingles of each text, common ones last.

    A task passes over sets it has met (it forgets them at ``MEMO``), so copies add a row a task, not one each.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, met = _WordHashes(), set()
        for b in batches:
            u, prefix = [], []
            for t in _utf8(b.column("text")):
                s = shingle_set(t, memo)
                d = naming(s)
                if d in met:
                    continue
                if len(met) > MEMO:
                    met.clear()
                met.add(d)
                bit = s & np.uint64(BITMAP_BITS - 1)
                common = (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
                k = len(s) // 5 + 1
                first = s[~common][:k]
                prefix.append(first if len(first) == k else np.concatenate([first, s[common][:k - len(first)]]))
                u.append(d)
            flat = np.concatenate(prefix) if prefix else np.zeros(0, np.uint64)
            owner = np.repeat(np.array(u, np.int64), [len(f) for f in prefix])
            yield pa.RecordBatch.from_arrays([pa.array(flat.view(np.int64)), pa.array(owner)], names=["reg", "u"])

    return run


def common_bitmap(nodes: DataFrame) -> np.ndarray:
    """Bits of shingles that several sampled texts hold; at most ``BITMAP_BITS / 32`` rows reach the driver."""
    common = (nodes.select(F.explode("sample").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("c"))
              .where(F.col("c") >= COMMON))
    bit = F.col("s").bitwiseAND(F.lit(BITMAP_BITS - 1))
    words = (common.select(F.shiftright(bit, 5).alias("word"), F.expr("shiftleft(1L, cast(s & 31 as int))").alias("bits"))
             .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow())
    out = np.zeros(BITMAP_BITS // 32, np.uint32)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype(np.uint32)
    return out.view(np.uint8)


def _overlaps(naming: Naming):
    """Rows sorted by group, pivot first, then by member: sizes of the pivot's set, each member's and their intersection."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _WordHashes()
        pivot, held, last = None, None, None
        for b in batches:
            out, take = [], []
            for k, (p, u, t) in enumerate(zip(b.column("p").to_pylist(), b.column("u").to_pylist(), _utf8(b.column("text")))):
                if (p, u) == last:
                    continue                               # known from another row of its id
                s = shingle_set(t, memo)
                if naming(s) != u:
                    continue                               # another text under the same id
                if u == p:
                    pivot, held = p, s
                elif pivot == p:
                    out.append((len(held), len(s), len(np.intersect1d(held, s, assume_unique=True))))
                    take.append(k)
                else:
                    continue
                last = (p, u)
            rows = pa.array(take, pa.int64())
            cols = list(zip(*out)) if out else [(), (), ()]
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(rows) for c in ("p", "u", "a", "b")), *(pa.array(c, pa.int64()) for c in cols)],
                                             names=["p", "u", "a", "b", "pn", "n", "both"])

    return run


# --- components --------------------------------------------------------------------

def contract(edges: DataFrame) -> DataFrame:
    """``(v, root)`` for every vertex of ``(a, b)``, which should be cheap to read: the smallest vertex it reaches.

    Every round hooks each vertex to its smallest neighbour, follows the hooks
    four times, and keeps the edges between different roots.  Only the choice of the
    neighbour needs the rows dealt out: repeated edges combine in it, and the joins
    with the written hooks are broadcasts while these are small.
    """
    maps = None
    left = edges.select("a", "b")
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = materialize(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("m")), "hooks")
        hook, nxt = first, first.select(F.col("v").alias("m"), F.col("m").alias("m2"))
        for _ in range(3):
            hook = hook.join(nxt, "m").select("v", F.col("m2").alias("m"))
        hook = materialize(hook, "hooks")
        if maps is None:
            maps = hook
        else:
            step = hook.select(F.col("v").alias("m"), F.col("m").alias("m2"))
            maps = materialize(maps.join(step, "m", "left").select("v", F.coalesce("m2", "m").alias("m")), "roots")
        ra, rb = hook.select(F.col("v").alias("a"), F.col("m").alias("x")), hook.select(
            F.col("v").alias("b"), F.col("m").alias("y"))
        left = left.join(ra, "a").join(rb, "b").where(F.col("x") != F.col("y")).select(
            F.col("x").alias("a"), F.col("y").alias("b"))
        left = materialize(left, "edges")
    if maps is None:
        return left.select(F.col("a").alias("v"), F.col("b").alias("root"))
    return maps.withColumnRenamed("m", "root")


# --- regions -----------------------------------------------------------------------

def first_regions(nodes: DataFrame, texts: DataFrame, naming: Naming) -> DataFrame:
    """``(reg, u, id, n, c, ring_lo, ring_hi)``: texts placed with their first pivots, regions of one text left out."""
    rows = texts.select("text").mapInArrow(_prefixes(common_bitmap(nodes), naming), "reg bigint, u bigint")
    # One exchange, by region: most shingles are one text's own.  Equal rows come from copies in several tasks.
    region = Window.partitionBy("reg")
    shared = (rows.withColumn("lo", F.min("u").over(region)).withColumn("hi", F.max("u").over(region))
              .where(F.col("lo") < F.col("hi")).dropDuplicates(["reg", "u"])
              .withColumn("members", F.count(F.lit(1)).over(region)).withColumn("mixed", F.bit_xor("u").over(region)))
    shared = materialize(shared, "shared_shingles")
    # Neighbouring shingles make regions with the same members; one of each kind stays.
    chosen = shared.groupBy("members", "mixed", "lo", "hi").agg(F.min("reg").alias("reg")).select("reg")
    kept = shared.select("reg", "u").join(chosen, "reg", "left_semi")
    return kept.join(nodes.select("u", "id", "n", *SKETCH), "u").select(
        "reg", *MEMBER, F.col("u").alias("c"), F.lit(0.0).alias("ring_lo"), F.lit(1.0).alias("ring_hi"))


def _distance(both: Column, a: Column, b: Column) -> Column:
    return 1 - both / (a + b - both)


def verify(pairs: DataFrame, texts: DataFrame, naming: Naming) -> DataFrame:
    """``(p, u, a, b, pn, n, both)``: exact sizes of sets and intersections of ``(p, u)`` pairs.

    ``pairs``: ``(p, pid, u, id, a, b)``, texts and ids of both, and what goes along.  A pivot's text is sent to each
    slice of about ``SALT_ROWS`` of its members; a task holds one pivot's set and one member's at a time.
    """
    slices = pairs.groupBy("p").agg(F.first("pid").alias("pid"), F.ceil(F.count(F.lit(1)) / F.lit(SALT_ROWS)).alias("k"))
    members = pairs.join(slices.select("p", "k"), "p").select("p", "u", "id", "a", "b", F.pmod(F.xxhash64("u"), F.col("k")).alias("salt"))
    none = F.lit(None).cast("long")
    heads = slices.select("p", F.col("p").alias("u"), F.col("pid").alias("id"), none.alias("a"), none.alias("b"),
                          F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("salt"))
    need = members.unionByName(heads)
    # At most one head for each pair: counting the written pairs, twice, tells whether their rows can be sent.
    if within_bounds(pairs.unionByName(pairs), MAX_BROADCAST_ROWS):
        need = F.broadcast(need)
    with_text = texts.join(need, "id").select("p", "u", "a", "b", "salt", "text")
    grouped = with_text.repartition("p", "salt").sortWithinPartitions("p", "salt", F.col("u") != F.col("p"), "u")
    return grouped.select("p", "u", "a", "b", "text").mapInArrow(
        _overlaps(naming), "p bigint, u bigint, a bigint, b bigint, pn bigint, n bigint, both bigint")


def _large_bound(pairs: DataFrame, nodes: DataFrame, total: Column) -> DataFrame:
    """Drop pairs of long texts whose large sketches differ in too many bits.

    Sketch sizes are powers of two, so of a pair that may link one has at most
    twice the bits of the other; the halves of the larger are merged first.
    """
    wanted = pairs.where((F.col("n") > LARGE_FROM) & (F.col("pn") > LARGE_FROM)).select(F.explode(F.array("u", "p")).alias("u"))
    # Written, so that the few sketches in question are sent to the pairs.
    large = materialize(nodes.where(F.col("n") > LARGE_FROM).join(wanted, "u", "left_semi").select("u", "large"), "wanted_sketches")
    other = large.select(F.col("u").alias("p"), F.col("large").alias("other"))
    both = pairs.join(large, "u", "left").join(other, "p", "left")
    width = F.least(F.size("large"), F.size("other"))

    def halved(sketch: str) -> Column:
        halves = F.zip_with(F.slice(sketch, F.lit(1), width), F.slice(sketch, width + 1, width), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(sketch) > width, halves).otherwise(F.col(sketch))

    bits = F.aggregate(F.zip_with(halved("large"), halved("other"), lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("long")),
                       F.lit(0).cast("long"), lambda a, x: a + x)
    return both.where(F.coalesce(9 * bits <= total, F.lit(True))).select(*pairs.columns)


def _pivots(members: DataFrame, count: int) -> DataFrame:
    """``(reg, pivots)`` of regions that still have members of different components.

    The region's largest component needs no pivots; at most ``count`` of the rest
    are taken, by hash.
    """
    parts = members.groupBy("reg", "c").agg(F.count(F.lit(1)).alias("k"))
    largest = parts.groupBy("reg").agg(F.max(F.struct("k", "c"))["c"].alias("largest"), F.count(F.lit(1)).alias("parts"))
    largest = largest.where(F.col("parts") > 1).select("reg", "largest")
    order = Window.partitionBy("reg").orderBy(F.xxhash64("u"), "u")       # limited per task before the exchange
    rest = (members.join(largest, "reg").where(F.col("c") != F.col("largest"))
            .withColumn("r", F.row_number().over(order)).where(F.col("r") <= count))
    return rest.groupBy("reg").agg(F.collect_list(F.struct(*MEMBER, "c", "ring_lo", "ring_hi")).alias("pivots"))


def _may_link(q: Column) -> Column:
    """Whether a member may link with the pivot ``q`` of its region, by component, ring, size and small sketch."""
    small, large = F.least(F.col("n"), q["n"]), F.greatest(F.col("n"), q["n"])
    differing = sum((F.bit_count(F.col(k).bitwiseXOR(q[k])) for k in SKETCH), F.lit(0))
    return ((F.col("c") != q["c"]) & (5 * small >= 4 * large)
            & (F.col("ring_lo") <= q["ring_hi"] + RING) & (q["ring_lo"] <= F.col("ring_hi") + RING)
            & (9 * differing <= F.col("n") + q["n"]))


def link_components(nodes: DataFrame, texts: DataFrame, naming: Naming) -> DataFrame:
    """``(u, c)`` for the nodes that link with another one.

    ``nodes``: ``(u, id, n, k0..k3, large, sample)``; ``texts``: ``(id, text)``; ``naming``: names the sets of texts ``u``.
    """
    regions = materialize(first_regions(nodes, texts, naming), "regions")
    comps = regions.select("u", "c").where(F.lit(False))         # others are components by themselves
    level = 0
    while True:
        picked = materialize(_pivots(regions, PIVOTS[min(level, len(PIVOTS) - 1)]), "pivots")
        if picked.isEmpty():
            return comps
        small, large = F.least("n", "pn"), F.greatest("n", "pn")
        # Pivots that a member cannot link with leave the array before it is unfolded: only pairs that pass
        # the bounds of component, ring, size and small sketch become rows.  They take ids and components along.
        pairs = (regions.join(picked, "reg").select("u", "id", "n", F.col("c").alias("b"), F.explode(F.filter("pivots", _may_link)).alias("q"))
                 .select(F.col("q.u").alias("p"), F.col("q.id").alias("pid"), "u", "id", F.col("q.c").alias("a"), "b",
                         F.col("q.n").alias("pn"), "n"))
        # One pair may share several regions.
        bounded = materialize(pairs.dropDuplicates(["p", "u"]), "sketched_pairs")
        bounded = _large_bound(bounded, nodes, F.col("n") + F.col("pn"))
        bounded = materialize(bounded, "bounded_pairs")
        known = verify(bounded.select("p", "pid", "u", "id", "a", "b"), texts, naming).select(
            "p", "u", "a", "b", _distance(F.col("both"), F.col("n"), F.col("pn")).alias("d"),
            (5 * F.col("both") >= 4 * (F.col("n") + F.col("pn") - F.col("both"))).alias("linked"))
        known = materialize(known, "pair_distances")

        roots = contract(known.where("linked").select("a", "b")).withColumnRenamed("v", "c")
        now = F.coalesce("root", "c").alias("c")
        joined = roots.select(F.col("c").alias("u"), F.col("root").alias("c")).join(comps.select("u"), "u", "left_anti")
        comps = materialize(comps.join(roots, "c", "left").select("u", now).unionByName(joined), "components")

        # Pivots leave; the first one sets the rings of its region.  Regions of one component got no pivots and end.
        following = regions.join(picked, "reg").where(~F.array_contains("pivots.u", F.col("u")))
        if level == 0:
            head = F.element_at("pivots", 1)
            following = following.select("reg", *MEMBER, "c", head["u"].alias("p"), head["n"].alias("pn")).join(
                known.select("p", "u", "d"), ["p", "u"], "left").select(
                "reg", *MEMBER, "c", F.coalesce("d", 1 - small / large).alias("ring_lo"), F.coalesce("d", F.lit(1.0)).alias("ring_hi"))
        regions = materialize(following.join(roots, "c", "left").select("reg", *MEMBER, now, "ring_lo", "ring_hi"), "regions")
        level += 1


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_bits: int = 64) -> DataFrame:
    """``(id, n_shingles, component_id)`` per row of ``docs``; any ``digest_bits`` (1 to 64) gives the same."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    naming = Naming(digest_bits)
    sets = materialize(texts.mapInArrow(
        _sets(naming), f"id {kind}, n bigint, u bigint, v bigint, k0 bigint, k1 bigint, k2 bigint, k3 bigint, "
        "large array<bigint>, sample array<bigint>"), "shingle_sets")

    def distinct_sets(named: DataFrame) -> DataFrame:
        # Copies of a text leave one row per map task; the smallest id decides.
        first = F.min(F.struct(*[c for c in _NAMES if c != "u"])).alias("first")
        nodes = named.where((F.col("n") > 0) & F.col("id").isNotNull()).groupBy("u").agg(
            first, (F.min("v") < F.max("v")).alias("differ"))
        return materialize(nodes.select("u", "first.*", "differ"), "nodes")

    nodes = distinct_sets(sets)
    shared = frozenset(r.u for r in nodes.where("differ").select("u").collect())
    if shared:
        naming = Naming(digest_bits, shared)
        sets = sets.withColumn("u", F.when(F.col("u").isin(*shared), F.col("v")).otherwise(F.col("u")))
        nodes = distinct_sets(sets)
    comps = link_components(nodes.drop("v", "differ"), texts.where(F.col("id").isNotNull()), naming)
    placed = sets.select("id", "n", "u").join(comps, "u", "left").withColumn(
        "c", F.when(F.col("n") > 0, F.coalesce("c", "u")))
    smallest = placed.where(F.col("c").isNotNull()).groupBy("c").agg(F.min("id").alias("component_id"))
    joined = placed.join(smallest, "c", "left")
    return joined.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))


def op3_pivot_jaccard(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))
