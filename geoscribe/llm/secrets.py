"""Secret scan: three fixed patterns, and a dictionary-primed zstandard novelty test.

The patterns yield the base spans.  Further candidates are long tokens
near a sensitive word, before or after it.  Each is compressed by zstandard with a raw dictionary
made of the corpus's common identifiers and the text around the candidate
(without copies of the candidate itself); the bytes it adds, over its length,
are its novelty.  Ordinary identifiers and repeated names cost next to nothing;
random key material stays incompressible and is reported as ``novel``.

The identifier dictionary counts every identifier-like token and long word of
every text (partial counts per task, then by token) and keeps the
``TOP_IDENTIFIERS`` of each that most texts use, so it is a few dozen KB for any corpus.

Nulls: a null or empty text has no span; its base digest is that of the empty
string.  Null ids are returned as they are, repeated rows are scanned alike, an
empty table gives no rows.  Positions are code points, ends are exclusive.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoscribe.llm.common import documents

KINDS = ("assign", "access", "hex", "novel")
MIN_ASSIGN, MIN_ACCESS = 12, 18
TOP_IDENTIFIERS = 2_000
MIN_CANDIDATE = 16
CONTEXT = 48
SURROUNDING = 1_024
MIN_NOVELTY = 0.7
DICTIONARY_BYTES = 24_000
SLICE = 63

# Fixed patterns of the contract.
_ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")          # a run is maximal, so the length can be part of the pattern

_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_SENSITIVE_WORDS = ("pass", "secret", "token", "key", "auth", "credential", "bearer", "private", "pwd", "cert", "sign")
_SENSITIVE = re.compile(r"(?ai:(?:" + "|".join(_SENSITIVE_WORDS) + r")[a-z]*)")
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_.=-]{{{MIN_CANDIDATE},}}")
_NAME = re.compile(r"[A-Za-z_.-][A-Za-z0-9_.-]*=+(?=[^=])")
_IDENTIFIER = re.compile(r"[A-Za-z]*[0-9_][A-Za-z0-9_]*|[A-Za-z]{8,}")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind index, end)`` of the contract's patterns, sorted."""
    spans = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        spans += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(spans)


def _candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Long tokens within ``CONTEXT`` characters of a sensitive word on either side, outside the spans taken.

    Sensitive words count inside joined names (``accessKey``, ``AccountKey``).  ``name=value`` is split at its first
    ``=``, so the name is a cue and the value a candidate.
    """
    low = text.lower()
    if not any(w in low for w in _SENSITIVE_WORDS):
        return []
    out = []
    cues = [(m.start(), m.end()) for m in _SENSITIVE.finditer(text)]
    starts, ends = [c[0] for c in cues], [c[1] for c in cues]
    for m in _CANDIDATE.finditer(text):
        start, end = m.span()
        name = _NAME.match(text, start, end)
        if name and end - name.end() >= MIN_CANDIDATE:
            start = name.end()
        before, after = bisect_right(ends, start) - 1, bisect_left(starts, end)
        if before >= 0 and start - ends[before] <= CONTEXT or after < len(cues) and starts[after] - end <= CONTEXT:
            out.append((start, end))
    if not taken:
        return out
    return [(a, b) for a, b in out if not any(s < b and a < e for s, _, e in taken)]


def novelty(candidate: bytes, around: bytes, dictionary: bytes) -> float:
    """Bytes that the candidate adds to what the dictionaries explain, over its length.

    Slices of at most ``SLICE`` bytes, each after the slices before it, are compressed on their own: from 64 bytes on
    zstandard codes literals by frequency, and random keys over small alphabets would score the less the longer they are.
    """
    known = dictionary + b"\n" + around.replace(candidate, b"")
    n = max(1, -(-len(candidate) // SLICE))
    edges = [len(candidate) * k // n for k in range(n + 1)]
    added = 0
    for start, end in zip(edges, edges[1:]):
        primer = known + candidate[max(0, start - SURROUNDING):start]
        c = zstandard.ZstdCompressor(
            level=9, dict_data=zstandard.ZstdCompressionDict(primer, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            write_content_size=False, write_checksum=False, write_dict_id=False)
        added += len(c.compress(candidate[start:end])) - len(c.compress(b""))
    return added / max(len(candidate), 1)


def scan_text(text: str | None, dictionary: bytes, min_novelty: float = MIN_NOVELTY) -> list[tuple[int, int, int]]:
    """All spans ``(start, kind index, end)``, sorted."""
    if not text:
        return []
    spans = base_spans(text)
    for start, end in _candidates(text, spans):
        around = text[max(0, start - SURROUNDING):start] + text[end:end + SURROUNDING]
        if novelty(text[start:end].encode(), around.encode("utf-8", "replace"), dictionary) >= min_novelty:
            spans.append((start, 3, end))
    return sorted(spans)


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _identifiers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        seen: Counter = Counter()
        for t in b.column("text"):
            text = t.as_py()
            if not text:
                continue
            # Values after a sensitive word or of a base pattern must not become "known identifiers".
            names = {m.group() for m in _IDENTIFIER.finditer(text) if 6 <= m.end() - m.start() <= 32}
            names = {x for x in names if any(c.isalpha() for c in x)}
            if names:
                spans = base_spans(text)
                values = " ".join(text[a:e] for a, _, e in spans)
                values += " " + " ".join(text[a:e] for a, e in _candidates(text, spans))
                seen.update(x for x in names if x not in values)
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                                         names=["item", "n"])


def identifier_dictionary(texts: DataFrame, top: int = TOP_IDENTIFIERS) -> bytes:
    """The commonest long words, then identifiers, of all texts, the commonest last (nearest to the candidate)."""
    counts = texts.mapInArrow(_identifiers, "item string, n bigint").groupBy("item").agg(F.sum("n").alias("n"))
    # One pass over the counts: each task forwards at most ``top`` of either kind.
    first = Window.partitionBy("plain").orderBy(F.col("n").desc(), "item")
    best = (counts.where(F.col("n") > 1).withColumn("plain", F.col("item").rlike("^[A-Za-z]+$"))
            .withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= top).drop("_r").collect())
    best.sort(key=lambda r: (r.n, r.item), reverse=True)
    parts = [b" ".join(r.item.encode() for r in reversed(best) if r.plain == kind)[-DICTIONARY_BYTES:] for kind in (True, False)]
    return b" ".join(x for x in parts if x)


def _scanner(dictionary: bytes, min_novelty: float) -> Callable:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [scan_text(t.as_py(), dictionary, min_novelty) for t in b.column("text")]
            base = [spans_text([s for s in f if s[1] < 3]) for f in found]
            counts = [pa.array([sum(s[1] == k for s in f) for f in found], pa.int64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), *counts[:3], pa.array([hashlib.sha256(x.encode()).hexdigest() for x in base], pa.string()),
                 pa.array([spans_text(f) for f in found], pa.string()), counts[3]],
                names=["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel"])

    return scan


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_novelty: float = MIN_NOVELTY) -> DataFrame:
    """Counts, digest of the base spans and all spans per row of ``docs``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    dictionary = identifier_dictionary(rows.select("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(_scanner(dictionary, min_novelty),
                          f"id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, "
                          "spans string, n_novel bigint")
    return out.withColumnRenamed("id", id_col)


def op7_novelty_secrets(spark, sf_dir: str) -> DataFrame:
    return find_secrets(documents(spark, sf_dir))
