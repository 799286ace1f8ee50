"""Substring deduplication by content-defined chunks.

A gear hash rolls over the UTF-8 bytes of a text and sees the last ``SEEN``
bytes only; a chunk ends at the smallest hash of every ``REACH`` neighbouring
positions.  Equal passages are cut alike wherever they stand, and each of at
least ``SEEN + REACH - 1`` = 101 bytes (51 words of one letter) holds a cut whose hash
saw nothing but the passage.

The bytes seen at a cut are its anchor; anchors are compared over the whole
corpus.  Each repeated one is aligned with its first occurrence, by id and
position.  Neighbouring anchors with one alignment and equal chunks between
them form a segment, which is extended character by character on both sides
against the text of the first occurrence, at most ``CONTEXT`` characters (more
than an end can be away from the passage's last anchor), and back to whole
words.  Segments that touch or overlap make a run, in the copy and in the
original; runs of at least ``MIN_RUN`` characters or over ``MIN_WORDS`` words
are repeats.  ``remove_repeats`` cuts out what also stands earlier.

The gear hash of all positions takes five vector additions per text: the hash
over ``2k`` bytes is that over ``k`` bytes plus the one ``k`` bytes earlier,
shifted.  A first pass sends bare anchor digests, counted per batch and task, and
leaves a bitmap of fixed size of those that repeat; the second sends only cuts
whose anchor may repeat (at a corpus so large that the bitmap fills up, all of
them).  An anchor of more than a thousandth of these rows is joined with its
first occurrence by broadcast, so a passage in a third of all documents is never
a group in a task.  Only the ends of segments fetch text; extents on an original
are combined by start before they meet.

Positions are code points, ends exclusive.  Null and empty texts have no
chunks; rows that repeat an id and a text count as one document more, and their
repeats are reported once; a null id is an id.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoscribe.llm.common import documents, free_name, materialize, null_safe
from geoscribe.operators.joins import hot_key_join

SEEN, REACH = 32, 70
CONTEXT = 128
CONTEXT_ROWS = 4096
MIN_RUN = 120
MIN_WORDS = 50
BITMAP_BITS = 1 << 26
GEAR_KEY = b"gear"


def gear_table(key: bytes = GEAR_KEY) -> np.ndarray:
    """256 pseudo-random 32-bit numbers, by rule."""
    return np.array([int.from_bytes(hashlib.blake2b(bytes([i]), digest_size=4, key=key).digest(), "little")
                     for i in range(256)], np.uint32)


def _cuts(data: bytes, gear: np.ndarray) -> np.ndarray:
    """Byte offsets of the cuts, always between characters."""
    raw = np.frombuffer(data, np.uint8)
    if len(raw) < SEEN + REACH - 1:
        return np.zeros(0, np.int64)
    h = gear[raw]
    width = 1
    while width < SEEN:
        h[width:] += h[:-width] << np.uint32(width)
        width *= 2
    low = h.astype(np.uint64)
    low <<= np.uint64(31)
    low |= np.arange(len(raw), dtype=np.uint64)
    inside = np.zeros(len(raw), bool)                            # would a cut after byte i split a character?
    if not data.isascii():
        inside[:-1] = (raw[1:] & 0xC0) == 0x80
    inside[1:] |= h[1:] == h[:-1]                                # one cut for a run of one byte
    low[inside] |= np.uint64(1 << 63)
    low = low[SEEN - 1:]
    width = 1
    while 2 * width <= REACH:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < REACH:
        low = np.minimum(low[:width - REACH], low[REACH - width:])
    new = np.ones(len(low), bool)                                # the place of the smallest never moves back
    np.not_equal(low[1:], low[:-1], out=new[1:])
    low = low[new]
    low = low[low < np.uint64(1 << 63)]
    return (low & np.uint64((1 << 31) - 1)).astype(np.int64) + 1


def chunk_ends(data: bytes, gear: np.ndarray) -> list[int]:
    """Byte offsets after each chunk, always between characters."""
    ends = _cuts(data, gear).tolist()
    return ends if not data or ends and ends[-1] == len(data) else [*ends, len(data)]


def _anchor(data: bytes, end: int) -> int:
    return xxhash.xxh3_64_intdigest(data[end - SEEN:end])


def _utf8(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(d, n)``: anchors of each batch with their number."""
    gear = gear_table()
    for b in batches:
        found = [_anchor(data, e) for data in _utf8(b.column("text")) for e in _cuts(data, gear).tolist()]
        d, n = np.unique(np.array(found, np.uint64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(d.view(np.int64)), pa.array(n, pa.int64())], names=["d", "n"])


def repeated_bitmap(rows: DataFrame) -> np.ndarray:
    """Fixed-size bitmap of the anchors that occur twice or more; at most ``BITMAP_BITS / 32`` rows reach the driver.

    A bit may also stand for an anchor that does not repeat; such rows fall out in the join.
    """
    repeated = rows.select("text").mapInArrow(_anchors, "d bigint, n bigint").groupBy("d").agg(F.sum("n").alias("n")).where(F.col("n") > 1)
    bit = F.col("d").bitwiseAND(F.lit(BITMAP_BITS - 1))
    words = (repeated.select(F.shiftright(bit, 5).alias("word"), F.expr("shiftleft(1L, cast(d & 31 as int))").alias("bits"))
             .groupBy("word").agg(F.bit_or("bits").alias("bits")))
    words = materialize(words, "repeated_anchors").toArrow()
    out = np.zeros(BITMAP_BITS // 32, np.uint32)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype(np.uint32)
    return out.view(np.uint8)


_CHUNK = "d bigint, c bigint, row bigint, idx int, end int"


def _chunks(bitmap: np.ndarray):
    """Cuts whose anchor may repeat: digests of anchor and chunk, number of the cut, end in characters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gear = gear_table()
        for b in batches:
            take, d, c, rows, idx, ends = [], [], [], [], [], []
            for k, (data, row) in enumerate(zip(_utf8(b.column("text")), b.column("row").to_pylist())):
                cuts = _cuts(data, gear)
                if not len(cuts):
                    continue
                cut = cuts.tolist()
                anchors = np.array([_anchor(data, e) for e in cut], np.uint64)
                bit = anchors & np.uint64(BITMAP_BITS - 1)
                kept = np.flatnonzero((bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1)
                if not len(kept):
                    continue
                starts = [0, *cut]
                c += [xxhash.xxh3_64_intdigest(data[starts[i]:cut[i]]) for i in kept.tolist()]
                d.append(anchors[kept])
                if data.isascii():
                    ends.append(cuts[kept].astype(np.int32))
                else:
                    chars = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80, dtype=np.int32)
                    ends.append(chars[cuts[kept] - 1])
                take += [k] * len(kept)
                rows += [row] * len(kept)
                idx.append(kept.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(d or [np.zeros(0, np.uint64)]).view(np.int64)), pa.array(np.array(c, np.uint64).view(np.int64)),
                 pa.array(rows, pa.int64()), pa.array(np.concatenate(idx or [np.zeros(0, np.int32)])),
                 pa.array(np.concatenate(ends or [np.zeros(0, np.int32)])), b.column("id").take(pa.array(take, pa.int64()))],
                names=["d", "c", "row", "idx", "end", "id"])

    return run


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("row"))


def chunk_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(d, c, row, idx, end, id)`` per cut whose anchor may repeat: digests of its anchor and chunk; ``row``
    tells texts of one id apart."""
    rows = _rows(docs, id_col, text_col)
    return rows.mapInArrow(_chunks(repeated_bitmap(rows)), f"{_CHUNK}, id {rows.schema['id'].dataType.simpleString()}")


def _cut_contexts(carried: list[str]):
    """The text before and after each wanted position, in batches of at most ``CONTEXT_ROWS``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, asked = b.column("text").to_pylist(), b.column("asked")
            owner, flat = np.repeat(np.arange(len(texts)), asked.value_lengths().to_numpy()), asked.flatten()
            for lo in range(0, len(flat), CONTEXT_ROWS):
                part = flat.slice(lo, CONTEXT_ROWS)
                mine, at = owner[lo:lo + CONTEXT_ROWS], part.field("at")
                places = [(texts[k], i) for k, i in zip(mine.tolist(), at.to_pylist())]
                one = pa.array(mine)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(one), b.column("row").take(one), *(part.field(c) for c in carried), at,
                     pa.array([t[max(0, i - CONTEXT):i] for t, i in places], pa.string()),
                     pa.array([t[i:i + CONTEXT] for t, i in places], pa.string())],
                    names=["id", "row", *carried, "at", "before", "after"])

    return run


def _contexts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(id, row, .., at, before, after)``: the text around the positions ``wanted`` (id, row, at), once for each,
    with its other columns carried along."""
    # One key of both (a struct is never null, and null ids in it are equal), so that the join's exchange
    # also serves to drop repeated rows, before their contexts are cut.
    key = F.struct("id", "row").alias("key")
    carried = [c for c in wanted.columns if c not in ("id", "row", "at")]
    lists = wanted.groupBy(key).agg(F.collect_set(F.struct("at", *carried)).alias("asked"))
    found = rows.select(key, "text").join(lists, "key").dropDuplicates(["key"]).select("key.id", "key.row", "text", "asked")
    kinds = "".join(f"{c} {wanted.schema[c].dataType.simpleString()}, " for c in carried)
    kind = rows.schema["id"].dataType.simpleString()
    return found.mapInArrow(_cut_contexts(carried), f"id {kind}, row bigint, {kinds}at int, before string, after string")


def _shared(a: str, b: str) -> int:
    """Length of the common beginning."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo = 0                                                       # shared up to lo, not up to n
    while n - lo > 1:
        mid = (lo + n) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            n = mid
    return lo


def _common(a: str, b: str) -> int:
    """Length of the common beginning, back to a whole word."""
    n = _shared(a, b)
    if n and not a[n - 1].isspace() and any(n < len(x) and not x[n].isspace() or n == len(x) == CONTEXT for x in (a, b)):
        part = len(a[:n].rsplit(None, 1)[-1])
        if part <= SEEN:                                         # text without spaces has no words to go back to
            n -= part
    return n


def extent(before: str, after: str, first_before: str, first_after: str) -> tuple[int, int, int]:
    """Characters shared before and after an anchor, and their number of words; zeros if the anchor differs."""
    if not before or before[-1] != first_before[-1:]:
        return 0, 0, 0
    at_left = _common(before[::-1], first_before[::-1])
    at_right = _common(after, first_after)
    # A word across the anchor's end is no cut word: the shared part goes on at the other side.
    if at_right == 0 and after and first_after and not before[-1].isspace() and not after[0].isspace():
        whole = before + after
        tail = len(whole[:len(before)].split()[-1])
        at_right = -min(tail, at_left) if tail <= SEEN else 0
    shared = before[len(before) - at_left:] + after[:max(at_right, 0)]
    return at_left, at_right, len(shared.encode().split())       # of bytes, split() cuts at the six white-space characters


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [extent(*x) for x in zip(*(b.column(c).to_pylist() for c in ("before", "after", "first_before", "first_after")))]
        left, right, words = zip(*got) if got else ((), (), ())
        keep = [c for c in b.schema.names if c not in ("before", "after", "first_before", "first_after")]
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in keep), *(pa.array(x, pa.int32()) for x in (left, right, words))],
            names=[*keep, "left", "right", "words"])


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_run: int = MIN_RUN) -> DataFrame:
    """Repeated passages: ``(id, start, end, n_chunks, copies, first_id, n_cut_chars)``.

    ``n_chunks`` is the number of repeated cuts in the run, ``copies`` the
    largest number of occurrences of one of its anchors, ``first_id`` the
    document with the original of its beginning, and ``n_cut_chars`` the
    characters that also stand earlier.
    """
    chunks = materialize(chunk_texts(docs, id_col, text_col), "anchors")
    origins = (chunks.groupBy("d").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("id", "row", "end", "c")).alias("o"))
               .where(F.col("copies") > 1).withColumnRenamed("d", "od"))
    # Anchors of a passage that very many documents share are joined where they are read.
    found = hot_key_join(chunks, origins, [("d", "od")]).select(
        "id", "row", "idx", "end", "copies", F.col("o.id").alias("oid"), F.col("o.row").alias("orow"),
        F.col("o.end").alias("oend"), (F.col("c") == F.col("o.c")).alias("whole"))
    # One exchange, by text, for repeated rows and the segments.
    found = found.repartition("id", "row").dropDuplicates(["id", "row", "idx"])
    # Segments: neighbouring anchors with one original, one shift and equal chunks between them.  An original's
    # own anchors are between no two of them, as their shift is 0.
    order = Window.partitionBy("id", "row").orderBy("idx")
    place = F.struct("oid", "orow", (F.col("end") - F.col("oend")).alias("shift"), F.col("idx"))
    before = F.lag(place).over(order)
    joined = (F.col("whole") & before["oid"].eqNullSafe(F.col("oid")) & (before["orow"] == F.col("orow"))
              & (before["shift"] == F.col("end") - F.col("oend")) & (before["idx"] == F.col("idx") - 1))
    marked = found.withColumn("opens", ~F.coalesce(joined, F.lit(False)))
    marked = marked.withColumn("closes", F.coalesce(F.lead("opens").over(order), F.lit(True)))
    marked = marked.withColumn("segment", F.sum(F.col("opens").cast("int")).over(order)).drop("idx", "whole")
    marked = materialize(marked, "marked_anchors")
    copied = ~F.struct("id", "row", "end").eqNullSafe(F.struct("oid", "orow", "oend"))
    edges = marked.where(copied & (F.col("opens") | F.col("closes")))
    # An edge travels to its text with all it carries and leaves with its own context; the originals' positions go
    # the same way, once each and without a segment.  So every text moves once, and its contexts once more.
    carried = ["segment", "copies", "oid", "orow", "oend", "opens", "closes"]
    originals = edges.select(F.col("oid").alias("id"), F.col("orow").alias("row"), F.col("oend").alias("at"),
                             *[F.lit(None).cast(edges.schema[c].dataType).alias(c) for c in carried])
    wanted = edges.select("id", "row", F.col("end").alias("at"), *carried).unionByName(originals)
    around = materialize(_contexts(_rows(docs, id_col, text_col), wanted), "own_contexts")
    own = around.where(F.col("segment").isNotNull()).withColumnRenamed("at", "end")
    theirs = around.where(F.col("segment").isNull()).select(
        F.col("id").alias("oid"), F.col("row").alias("orow"), F.col("at").alias("oend"),
        F.col("before").alias("first_before"), F.col("after").alias("first_after"))
    both = null_safe(own, theirs, ["oid", "orow", "oend"], "inner")
    keep = ["id", "row", "segment", "end", "copies", "oid", "orow", "oend", "opens", "closes"]
    both = both.select(*keep, "before", "after", "first_before", "first_after")
    plain = ", ".join(f"{c} {both.schema[c].dataType.simpleString()}" for c in keep)
    segments = both.mapInArrow(_extend, f"{plain}, left int, right int, words int").groupBy("id", "row", "segment").agg(
        F.min(F.when(F.col("opens"), F.col("end") - F.col("left"))).alias("start"),
        F.max(F.when(F.col("closes"), F.col("end") + F.col("right"))).alias("stop"), F.max("words").alias("words"),
        F.max("copies").alias("copies"), F.min(F.struct("oid", "orow")).alias("o"),
        F.min(F.col("end") - F.col("oend")).alias("shift")).where(F.col("stop") > F.col("start"))
    segments = materialize(segments, "segments")
    first = F.struct(F.col("o.oid").alias("id"))
    extents = segments.select("id", "row", "start", "stop", "words", "copies", first.alias("first"), F.col("stop").alias("cut")).unionByName(
        segments.select(F.col("o.oid").alias("id"), F.col("o.orow").alias("row"), (F.col("start") - F.col("shift")).alias("start"),
                        (F.col("stop") - F.col("shift")).alias("stop"), "words", "copies", first.alias("first"),
                        F.lit(None).cast("int").alias("cut")))
    # One row per start: an original of very many copies has as many rows as characters at most.
    extents = extents.groupBy("id", "row", "start").agg(
        F.max("stop").alias("stop"), F.max("words").alias("words"), F.max("copies").alias("copies"),
        F.min("first").alias("first"), F.max("cut").alias("cut"))
    by_start = Window.partitionBy("id", "row").orderBy("start")
    earlier = by_start.rowsBetween(Window.unboundedPreceding, -1)
    cut_from = F.greatest(F.col("start"), F.coalesce(F.max("cut").over(earlier), F.lit(0)))
    extents = extents.withColumn("new", F.col("start") > F.coalesce(F.max("stop").over(earlier), F.lit(-1))).withColumn(
        "n_cut", F.when(F.col("cut") > cut_from, F.col("cut") - cut_from).otherwise(0))
    extents = extents.withColumn("run", F.sum(F.col("new").cast("int")).over(by_start))
    runs = extents.groupBy("id", "row", "run").agg(
        F.min("start").alias("start"), F.max("stop").alias("end"), F.max("words").alias("words"),
        F.max("copies").alias("copies"), F.min_by("first", "start").alias("first"),
        F.sum("n_cut").cast("long").alias("n_cut_chars"))
    runs = runs.where((F.col("end") - F.col("start") >= min_run) | (F.col("words") > MIN_WORDS))
    ends = marked.groupBy("id", "row").agg(F.collect_list("end").alias("ends"))
    out = null_safe(runs, ends, ["id", "row"], "inner")
    inside = F.size(F.filter("ends", lambda e: (e > F.col("start")) & (e <= F.col("end")))).cast("long")
    return out.select(F.col("id").alias(id_col), "start", "end", inside.alias("n_chunks"), "copies",
                      F.col("first.id").alias("first_id"), "n_cut_chars", "row")


def remove_repeats(docs: DataFrame, repeats: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the copied passages cut out of the text; a run that holds an original stays whole."""
    row, cuts = free_name(docs, "_row"), free_name(docs, "_cut")
    cut = (repeats.where(F.col("n_cut_chars") == F.col("end") - F.col("start")).groupBy(id_col, F.col("row").alias(row))
           .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias(cuts)))
    keyed = docs.withColumn(row, F.xxhash64(text_col))
    joined = null_safe(keyed, cut, [id_col, row], "left")
    text = F.col(text_col)
    edges = F.concat(F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"))), F.col(cuts),
                     F.array(F.struct(F.length(text).alias("start"), F.length(text).alias("end"))))
    pieces = F.transform(F.sequence(F.lit(1), F.size(edges) - 1), lambda i: F.substring(
        text, F.get(edges, i - 1)["end"] + 1, F.get(edges, i)["start"] - F.get(edges, i - 1)["end"]))
    left = F.when(F.col(cuts).isNull(), text).otherwise(F.array_join(pieces, ""))
    return joined.withColumn(text_col, left).select(*docs.columns)


def op6_gear_chunks(spark, sf_dir: str) -> DataFrame:
    return find_repeats(documents(spark, sf_dir)).drop("row")
