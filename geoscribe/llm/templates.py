"""Benchmark decontamination by template windows with slot consistency.

Texts become sequences of words in lower case in which numbers, names and
units are replaced by typed placeholders.  Windows of ``WINDOW`` tokens of
the benchmark items are joined by hash (and then by their text) with those of
all documents.  A shared window only makes a candidate: the item's tokens are
then matched in order with the document's tokens around that alignment, blocks
of at least ``MIN_BLOCK`` equal tokens, so changed, added and dropped words cost
what they cover and no more.  Every slot value of the item must always map to
the same document value.  A document is contaminated by an item when blocks
cover at least ``MIN_COVERAGE`` of the item's tokens, so verbatim copies are
caught as well as questions with other numbers and names.

Only document windows that may match leave their task: the benchmark's window
hashes set a bitmap of fixed size, built by an aggregation (``bit_or``), and
windows that miss it are dropped.  False hits fall out in the join.  The bitmap
has the same size for any benchmark; the benchmark itself is never broadcast.

Windows need ``MIN_PLAIN`` tokens that are no placeholders; poorer ones are
joined on their literal words instead.  Items shorter than a window are one
window of their own length; items of fewer than ``MIN_TOKENS`` tokens identify
nothing.  A capitalised word that opens an item is read both as a word and as a
name.  An item without any unedited window of ``WINDOW`` tokens is not found.

A window row is a hash and a position, whatever the length of its text: the
documents found to be aligned with items are read once more, and each alignment's
slice of the document (the item's length and a quarter) is cut out then, once per
group of alignments that lie no further apart than a copy may drift.  A very long
item or text therefore costs its own length per alignment, not per window.

Null and empty texts and items match nothing; rows that share an id count as
one document; a null id is an id.  Empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoscribe.llm.common import benchmark, documents, materialize, null_safe
from geoscribe.operators.joins import checked_broadcast

WINDOW = 8
MIN_PLAIN = 4
MIN_TOKENS = 4
MIN_BLOCK = 2
MIN_COVERAGE = 0.5
BITMAP_BITS = 1 << 26
MEMO = 600_000
BLOCK_CHARS = 1 << 18

# Fixed values.
UNITS = ("mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces "
         "pound pounds ton tons ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours "
         "day days week weeks month months year years cent cents dollar dollars euro euros percent degrees mph").split()
NUMBER_WORDS = ("two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty sixty seventy "
                "eighty ninety hundred thousand million").split()

_TOKEN = re.compile(r"[^\W\d_]+|[.!?\n]|\d+(?:[.,]\d+)*")         # letters are most of a text: tried first
_WORD, _CAPITAL, _NUMBER, _UNIT, _STOP = range(5)
_SLOTS = {_CAPITAL: "<name>", _NUMBER: "<num>", _UNIT: "<unit>"}
_FIXED = dict.fromkeys(UNITS, _UNIT) | dict.fromkeys(NUMBER_WORDS, _NUMBER) | dict.fromkeys(".!?\n", _STOP)


class _Tokens(dict):
    """Token -> number of its row in ``kinds`` and ``codes``; a cache that starts anew when full."""

    def __init__(self):
        super().__init__()
        self.kinds: list[int] = []
        self.codes: list[int] = []
        self._arrays = np.zeros(0, np.int8), np.zeros(0, np.uint64)

    def __missing__(self, token: str) -> int:
        row = self[token] = len(self.kinds)
        low = token.lower()
        first = token[0]
        if low in _FIXED:
            kind = _FIXED[low]
        elif first.isdigit():
            kind = _NUMBER
        else:
            kind = _CAPITAL if first != low[0] and len(token) > 1 and first.isupper() and token[1:].islower() else _WORD
        self.kinds.append(kind)
        self.codes.append(xxhash.xxh3_64_intdigest(low))
        return row

    def rows(self, tokens: list[str]) -> np.ndarray:
        if len(self) > MEMO:
            self.clear()
            self.kinds.clear()
            self.codes.clear()
            self._arrays = self._arrays[0][:0], self._arrays[1][:0]
        if len(tokens) < 2:
            return np.array([self[t] for t in tokens], np.int64)
        return np.array(itemgetter(*tokens)(self), np.int64)          # one call for the whole block

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        """Kinds and codes of all rows; only the new ones are converted."""
        done = len(self._arrays[0])
        if done < len(self.kinds):
            self._arrays = (np.concatenate([self._arrays[0], np.array(self.kinds[done:], np.int8)]),
                            np.concatenate([self._arrays[1], np.array(self.codes[done:], np.uint64)]))
        return self._arrays


_SLOT_CODE = {k: np.uint64(xxhash.xxh3_64_intdigest(v.encode())) for k, v in _SLOTS.items()}


class Canonical:
    """Texts in canonical form: tokens without stops, their slot kinds (0: none), codes and literal
    codes, one text behind the other, with the place where each begins in ``starts``."""

    def __init__(self, texts: list[str], memo: _Tokens):
        split = [_TOKEN.findall(t) for t in texts]
        tokens = list(chain.from_iterable(split))
        rows = memo.rows(tokens)
        kinds, codes = memo.arrays()
        kind, code = kinds[rows], codes[rows]
        ends = np.cumsum([len(part) for part in split], dtype=np.int64)
        begins = (ends - [len(part) for part in split])[[len(part) > 0 for part in split]]
        stop = kind == _STOP
        opens = np.ones(len(tokens), bool)                  # first token of a sentence or text: no name
        opens[1:] = stop[:-1]
        opens[begins] = True
        after_number = np.zeros(len(tokens), bool)
        after_number[1:] = kind[:-1] == _NUMBER
        after_number[begins] = False
        slot = np.where((kind == _CAPITAL) & ~opens | (kind == _NUMBER) | (kind == _UNIT) & after_number, kind, 0)
        keep = np.flatnonzero(~stop)
        self._tokens, self._at = tokens, keep
        self.slot, self.literal = slot[keep], code[keep]
        self.code = self.literal.copy()
        for k, c in _SLOT_CODE.items():
            self.code[self.slot == k] = c
        self.starts = np.concatenate([[0], np.searchsorted(keep, ends)]).astype(np.int64)

    def tokens(self, start: int, end: int) -> list[str]:
        return [self._tokens[i] for i in self._at[start:end].tolist()]

    def window(self, at: int, width: int) -> str:
        """Canonical text."""
        kinds = self.slot[at:at + width].tolist()
        return " ".join(_SLOTS.get(k) or t.lower() for t, k in zip(self.tokens(at, at + width), kinds))

    def literal_window(self, at: int, width: int) -> str:
        return "=" + " ".join(t.lower() for t in self.tokens(at, at + width))

    def kinds(self, start: int, end: int) -> list[str]:
        """Tokens in lower case behind the digit of their slot kind."""
        return [f"{k}{t.lower()}" for t, k in zip(self.tokens(start, end), self.slot[start:end].tolist())]


def window_hashes(slot: np.ndarray, code: np.ndarray, literal: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each window, 0 where it has too few plain tokens; starts and literal hashes of the windows that are poor
    or would be if their first token were a name."""
    n = len(code) - width + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def mixed(start: int, parts: list[np.ndarray]) -> np.ndarray:
        h = np.full(len(parts[0]), start, np.uint64)
        for x in parts:
            h = (h ^ x) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return h

    h = mixed(width, [code[k:k + n] for k in range(width)])
    plain = np.concatenate([[0], np.cumsum(slot == 0)])
    plain = plain[width:] - plain[:-width]
    least = min(MIN_PLAIN, width)
    h[plain < least] = 0
    poor = np.flatnonzero(plain <= least)
    return h, poor, mixed(width + (1 << 32), [literal[poor + k] for k in range(width)])


_WINDOW = "h bigint, pos int, win string, n int"


def _emit(b: pa.RecordBatch, take: list[int], found: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*found)) if found else [()] * 4
    arrays = [pa.array(np.array(cols[0], np.uint64).view(np.int64)), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.string()),
              pa.array(cols[3], pa.int32())]
    at = pa.array(take, pa.int64())
    return pa.RecordBatch.from_arrays([*arrays, b.column("id").take(at), b.column("row").take(at)],
                                      names=["h", "pos", "win", "n", "id", "row"])


def _item_windows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Tokens()
        for b in batches:
            take, found = [], []
            for k, t in enumerate(b.column("text").to_pylist()):
                c = Canonical([t or ""], memo)
                n = len(c.slot)
                w = min(width, n)
                if w < MIN_TOKENS:
                    continue
                first = c.tokens(0, 1)[0]
                slot, code = c.slot.copy(), c.code.copy()
                h, poor, lit = window_hashes(slot, code, c.literal, w)
                rows = [(h[i], i, c.window(i, w)) for i in np.flatnonzero(h).tolist()]
                rows += [(x, i, c.literal_window(i, w)) for i, x in zip(poor.tolist(), lit)]
                if slot[0] == 0 and len(first) > 1 and first[0].isupper() and first[1:].islower():
                    c.slot[0], code[0] = _CAPITAL, _SLOT_CODE[_CAPITAL]      # the opening word read as a name
                    h = window_hashes(c.slot, code, c.literal, w)[0][:1]
                    rows += [(h[0], 0, c.window(0, w))] if h[0] else []
                found += [(*x, n) for x in rows]
                take += [k] * len(rows)
            yield _emit(b, take, found)

    return run


def _item_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each item's tokens, once."""
    memo = _Tokens()
    for b in batches:
        toks = []
        for t in b.column("text").to_pylist():
            c = Canonical([t or ""], memo)
            toks.append(c.kinds(0, len(c.slot)))
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("row"), pa.array(toks, pa.list_(pa.string()))],
                                         names=["id", "row", "toks"])


def _pieces(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``BLOCK_CHARS`` characters together (a longer text is a range of its own)."""
    start = chars = 0
    for i, t in enumerate(texts):
        chars += len(t)
        if chars >= BLOCK_CHARS or i + 1 == len(texts):
            yield start, i + 1
            start, chars = i + 1, 0


def _document_windows(widths: list[int], bitmap: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Tokens()
        mask = np.uint64(BITMAP_BITS - 1)

        def hits(h: np.ndarray) -> np.ndarray:
            bit = h & mask
            hit = (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1
            return np.flatnonzero((hit == 1) & (h != 0))

        for b in batches:
            take, found = [], []
            texts = [t or "" for t in b.column("text").to_pylist()]
            for first, last in _pieces(texts):
                c = Canonical(texts[first:last], memo)
                for w in widths:
                    h, poor, lit = window_hashes(c.slot, c.code, c.literal, w)
                    rows = [(h[i], i, False) for i in hits(h).tolist()]
                    rows += [(lit[i], int(poor[i]), True) for i in hits(lit).tolist()]
                    for x, at, is_literal in rows:
                        text = int(np.searchsorted(c.starts, at, "right")) - 1
                        if at + w <= c.starts[text + 1]:                    # not across two texts
                            win = c.literal_window(at, w) if is_literal else c.window(at, w)
                            found.append((x, at - int(c.starts[text]), win, 0))
                            take.append(first + text)
            yield _emit(b, take, found)

    return run


def _slack(n: int) -> int:
    """Tokens by which a copy may drift from an alignment of an item of ``n`` tokens."""
    return 4 + n // 4


def representatives(shifts: list[int], n: int) -> list[int]:
    """Middles of groups of shifts no further apart than the slack: each stands for its group's copies."""
    out: list[int] = []
    group: list[int] = []
    for s in sorted(set(shifts)):
        if group and s - group[0] > _slack(n):
            out.append((group[0] + group[-1]) // 2)
            group = []
        group.append(s)
    return [*out, (group[0] + group[-1]) // 2] if group else out


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each document and item it is aligned with, the document's tokens around every alignment."""
    memo = _Tokens()
    for b in batches:
        for k, (text, aligned_with) in enumerate(zip(b.column("text").to_pylist(), b.column("found").to_pylist())):
            c = Canonical([text], memo)
            rows = []
            for f in aligned_with:
                for at in representatives(f["shifts"], f["n"]):
                    rows.append((f["item"], f["item_row"], c.kinds(max(0, at - _slack(f["n"])), max(0, at + f["n"] + _slack(f["n"])))))
            item, item_row, part = zip(*rows)
            kind = b.column("found").type.value_type.field("item").type
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array([k] * len(rows))), pa.array(item, kind), pa.array(item_row, pa.int64()),
                 pa.array(part, pa.list_(pa.string()))], names=["id", "item", "item_row", "part"])


def aligned(item: list[str], part: list[str]) -> tuple[int, bool]:
    """Tokens of the item in blocks that also stand, in order, in the document's part, and whether a slot changed.

    No token counts when blocks of ``MIN_PLAIN`` tokens or more disagree on a slot; shorter ones are left out then.
    """
    def shapes(toks: list[str]) -> list[str]:
        return [_SLOTS.get(int(t[0]), t[1:]) for t in toks]

    a, b = shapes(item), shapes(part)
    blocks = SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks()
    values: dict[str, str] = {}
    covered = 0
    for i, j, size in sorted(blocks, key=lambda x: -x[2]):
        if size < MIN_BLOCK:
            break
        pairs = [(x, y) for x, y in zip(item[i:i + size], part[j:j + size]) if x[0] != "0"]
        new = dict(values)
        if all(new.setdefault(x, y) == y for x, y in pairs):
            values, covered = new, covered + size
        elif size >= MIN_PLAIN:
            return 0, False
    return covered, any(x != y for x, y in values.items())


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got, sizes = [], []
        for item, part in zip(*(b.column(c).to_pylist() for c in ("toks", "part"))):
            best = aligned(item, part)
            if best[0] < len(item) and item[0][0] == "0" and f"{_CAPITAL}{item[0][1:]}" in part:
                best = max(best, aligned([f"{_CAPITAL}{item[0][1:]}", *item[1:]], part))
            got.append(best)
            sizes.append(len(item))
        k, changed = zip(*got) if got else ((), ())
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("item"), pa.array(sizes, pa.int32()), pa.array(k, pa.int64()),
                                          pa.array(changed, pa.bool_())], names=["id", "item", "n", "k", "changed"])


def _bitmap(items: DataFrame) -> np.ndarray:
    """Fixed-size bitmap of window hashes: at most ``BITMAP_BITS / 32`` rows reach the driver."""
    bit = F.col("h").bitwiseAND(F.lit(BITMAP_BITS - 1))
    words = (items.select(F.shiftright(bit, 5).alias("word"), F.expr("shiftleft(1L, cast(h & 31 as int))").alias("bits"))
             .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow())
    out = np.zeros(BITMAP_BITS // 32, np.uint32)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype(np.uint32)
    return out.view(np.uint8)


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                 min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """``(id, item, matched_tokens, item_tokens, coverage, slots_changed)`` per contaminated document and item."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("row"))
    bench = items.select(F.col(item_col).alias("id"), F.col(item_text_col).alias("text"), F.xxhash64(item_text_col).alias("row"))
    doc_id, item_id = (df.schema["id"].dataType.simpleString() for df in (rows, bench))

    wanted = materialize(bench.mapInArrow(_item_windows(window), f"{_WINDOW}, id {item_id}, row bigint"), "item_windows")
    bitmap = _bitmap(wanted)
    widths = sorted({window, *(r.w for r in wanted.select(F.least("n", F.lit(window)).alias("w")).distinct().collect())})  # at most WINDOW
    have = rows.mapInArrow(_document_windows(widths, bitmap), f"{_WINDOW}, id {doc_id}, row bigint")
    # Which documents are aligned with which items, and where; one list per document and item.
    shifts = have.alias("d").join(wanted.alias("i"), ["h", "win"]).select(
        F.col("d.id").alias("id"), F.col("d.row").alias("row"), F.col("i.id").alias("item"), F.col("i.row").alias("item_row"),
        F.col("i.n").alias("n"), (F.col("d.pos") - F.col("i.pos")).alias("shift"))
    per_item = shifts.groupBy("id", "row", "item", "item_row", "n").agg(F.collect_set("shift").alias("shifts"))
    per_document = materialize(per_item.groupBy("id", "row").agg(
        F.collect_list(F.struct("item", "item_row", "n", "shifts")).alias("found")), "aligned_documents")
    # Only these documents are read again, each once; their keys are broadcast behind a check of their size.
    keys = checked_broadcast(per_document.select("id", "row"))
    again = null_safe(rows.where(F.col("text").isNotNull()), keys, ["id", "row"], "left_semi").dropDuplicates(["id", "row"])
    sliced = null_safe(again, per_document, ["id", "row"], "inner").select("id", "text", "found").mapInArrow(
        _slices, f"id {doc_id}, item {item_id}, item_row bigint, part array<string>")
    tokens = bench.dropDuplicates(["id", "row"]).mapInArrow(_item_tokens, f"id {item_id}, row bigint, toks array<string>")
    paired = null_safe(sliced, tokens.select(F.col("id").alias("item"), F.col("row").alias("item_row"), "toks"),
                       ["item", "item_row"], "inner").select("id", "item", "toks", "part")
    checked = paired.mapInArrow(_verify, f"id {doc_id}, item {item_id}, n int, k bigint, changed boolean")
    out = checked.where(F.col("k") / F.col("n") >= min_coverage).groupBy("id", "item", "n").agg(
        F.max(F.struct("k", (~F.col("changed")).alias("same"))).alias("best"))
    return out.select(
        F.col("id").alias(id_col), F.col("item").alias(item_col), F.col("best.k").alias("matched_tokens"),
        F.col("n").cast("long").alias("item_tokens"), (F.col("best.k") / F.col("n")).alias("coverage"),
        (~F.col("best.same")).alias("slots_changed"))


def op5_template_decontamination(spark, sf_dir: str) -> DataFrame:
    return contaminated(documents(spark, sf_dir), benchmark(spark, sf_dir))
