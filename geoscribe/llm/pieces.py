"""SentencePiece encoding and decoding by a table of distinct chunks.

The model must not have a piece that crosses a white-space marker (U+2581
after any other character) and must leave texts as they are but for the marker
(no character map); ``Model`` checks both.  Then no merge ever joins the end of
one marked word to the marker of the next, so a text is the concatenation of
its chunks: a run of markers with the word behind it.  Every distinct chunk is
segmented and decoded once per table; ids come back to the texts by position (a
gather over the table's flat list of ids), decoded chunks by joining.

The table lives in the task: the vocabulary of a large corpus has no bound, so
it is not broadcast, and joining it back by a shuffle would move every distinct
word of every partition twice.  A table beyond ``TABLE_CHARS`` characters or
``TABLE_CHUNKS`` chunks is started anew, which bounds memory and changes no
result.  Nothing is shuffled; texts are cut into output batches of about
``BATCH_CHARS`` characters, so memory follows the longest single text.

Null and empty texts yield the end id alone and an empty decoded text; repeated
rows and null ids are rows like any other; an empty table yields none.  Extra
columns are not read.  A text without a space is one chunk, however long.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoscribe.llm import common

MARK = "▁"
MODEL = "piece_bpe_32k.model"

#: Bounds of one table of distinct chunks, and of the texts handled at once.
TABLE_CHARS = 32 << 20
TABLE_CHUNKS = 500_000
BATCH_CHARS = 8 << 20

#: A run of spaces with the word behind it, or trailing spaces.
CHUNK = re.compile(r" +[^ ]+| +")


class Model:
    """A SentencePiece model whose chunks can be segmented one by one."""

    def __init__(self, proto: bytes):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=proto)

    def check(self) -> Model:
        sp = self.sp
        crossing = [p for p in map(sp.id_to_piece, range(sp.get_piece_size())) if MARK in p.lstrip(MARK)]
        probe = "ﬁ  Ａ\téé "
        if crossing or sp.normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError("pieces cross white-space markers, or texts are normalised: chunks do not stand alone")
        return self

    @property
    def end_id(self) -> int:
        return self.sp.eos_id()

    def segment(self, chunks: list[str]) -> tuple[list[list[int]], list[str]]:
        """Ids and decoded text of each chunk.  A marker with no word behind it (a single
        space at the end of a text) is no text of its own: its ids are those it adds to another."""
        ids = self.sp.encode(chunks, num_threads=1)
        if "" in chunks:
            word = "a"
            ids[chunks.index("")] = self.sp.encode(word + " ")[len(self.sp.encode(word)):]
        return ids, self.sp.decode(ids, num_threads=1)


def chunks(text: str) -> list[str]:
    """Chunks of a text without their first marker; each is what the model takes as a text of its own."""
    plain = text.replace(MARK, " ")
    if not plain:
        return []
    if "  " not in plain and plain[0] != " " and plain[-1] != " ":
        return plain.split(" ")
    return [c[1:] for c in CHUNK.findall(" " + plain)]


class ChunkTable:
    """Distinct chunks with their ids (one flat list with starts) and decoded texts."""

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.code: dict[str, int] = {}
        self.chars = 0
        self.flat = np.zeros(0, np.int32)
        self.start = np.zeros(1, np.int64)
        self.decoded: list[str] = []
        self.differs: set[int] = set()

    def add(self, new: list[str]) -> None:
        if len(self.code) + len(new) > TABLE_CHUNKS or self.chars + sum(map(len, new)) > TABLE_CHARS:
            raise OverflowError
        ids, texts = self.model.segment(new)
        for chunk, text in zip(new, texts):
            code = self.code[chunk] = len(self.code)
            if text != chunk:
                self.differs.add(code)
            self.decoded.append(text)
        self.chars += sum(map(len, new))
        self.flat = np.concatenate([self.flat, np.array([i for one in ids for i in one], np.int32)])
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum([len(one) for one in ids])])

    def encode(self, texts: list[str]) -> tuple[pa.ListArray, pa.Array]:
        """Ids with the end id, and decoded texts."""
        split = [chunks(t) for t in texts]
        distinct = set().union(*split) if split else set()
        new = sorted(distinct.difference(self.code))
        if new:
            try:
                self.add(new)
            except OverflowError:
                self.clear()
                every = sorted(distinct)
                # One batch may be beyond the bounds by itself (a very long text): it is taken whole.
                bounds = TABLE_CHUNKS, TABLE_CHARS
                if len(every) > bounds[0] or sum(map(len, every)) > bounds[1]:
                    return self._alone(split, texts)
                self.add(every)
        get = self.code.__getitem__
        counts = np.fromiter(map(len, split), np.int64, len(split))
        codes = np.fromiter((get(c) for cs in split for c in cs), np.int64, int(counts.sum()))
        lengths = self.start[codes + 1] - self.start[codes]
        ends = np.cumsum(lengths)
        # Position of every id in the flat list: its chunk's start plus its place in the chunk.
        take = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.start[codes] - (ends - lengths), lengths)
        ids = self.flat[take]
        # The end id goes behind the last chunk of every text.
        text_ends = np.concatenate([[0], ends])[np.cumsum(counts)]
        ids = np.insert(ids, text_ends, self.model.end_id).astype(np.int32)
        offsets = np.concatenate([[0], text_ends + np.arange(1, len(split) + 1)])
        if self.differs:
            decoded = [" ".join(self.decoded[get(c)] for c in cs) for cs in split]
        else:
            decoded = [t.replace(MARK, " ") for t in texts]
        return _lists(offsets, ids), pa.array(decoded, pa.string())

    def _alone(self, split: list[list[str]], texts: list[str]) -> tuple[pa.ListArray, pa.Array]:
        """Texts that together pass the table's bounds: one at a time, each with a table of its own."""
        if len(texts) > 1:
            parts = [self.encode([t]) for t in texts]
            return pa.concat_arrays([p[0] for p in parts]), pa.concat_arrays([p[1] for p in parts])
        ids: list[int] = []
        decoded: list[str] = []
        step = max(1, TABLE_CHUNKS // 2)
        for i in range(0, len(split[0]), step):
            part = split[0][i:i + step]
            distinct = list(dict.fromkeys(part))
            own = dict(zip(distinct, zip(*self.model.segment(distinct))))
            for c in part:
                ids.extend(own[c][0])
                decoded.append(own[c][1])
        ids.append(self.model.end_id)
        return (_lists(np.array([0, len(ids)]), np.array(ids, np.int32)), pa.array([" ".join(decoded)], pa.string()))


def _lists(offsets: np.ndarray, ids: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))


def encode_texts(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids, decoded)`` of every row: the model's ids with its end id, and the text they decode to.

    ``model_path`` is read by the driver; its bytes (half a megabyte) travel with the tasks.
    """
    with open(model_path, "rb") as f:
        proto = f.read()
    Model(proto).check()
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = T.StructType([rows.schema["id"], T.StructField("ids", T.ArrayType(T.IntegerType(), True)),
                           T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(Model(proto))
        for batch in batches:
            texts = batch.column("text").to_pylist()
            start = chars = 0
            for i, text in enumerate(texts):
                chars += len(text)
                if chars >= BATCH_CHARS or i + 1 == len(texts):
                    ids, decoded = table.encode(texts[start:i + 1])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id").slice(start, i + 1 - start), ids, decoded], ["id", "ids", "decoded"])
                    start, chars = i + 1, 0

    return rows.mapInArrow(run, schema)


def op13_distinct_chunk_pieces(spark: SparkSession, sf_dir: str, model_path: str | None = None) -> DataFrame:
    """Ids and decoded text of every document, as counts and digests."""
    if model_path is None:
        import public_tokenizers

        model_path = public_tokenizers.path(MODEL)
    coded = encode_texts(common.documents(spark, sf_dir), model_path)
    return coded.select(
        F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
