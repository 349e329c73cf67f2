"""Token ids in binary files: a concatenated id array with Elias-Fano boundaries.

A file holds one range of document ids, in ascending order (nulls first):

    ids          n_ids numbers of ``width`` bytes, little-endian
    boundaries   Elias-Fano code of the n_docs + 1 offsets into the ids
    documents    Elias-Fano code of the document ids less the smallest
    footer       8 numbers of 8 bytes: magic, n_docs, n_ids, width, bytes of boundaries,
                 bytes of documents, smallest document id, documents without an id

Every attempt of a task writes a file with a name of its own; the manifest, which lists
the files of the tasks that succeeded, says which ones count.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow.session import new_dir
from llm.bpe import encoder
from llm.elias_fano import EliasFano
from llm.storage import land

MAGIC = 0x31534449464C45
FOOTER = 64
#: Ids read at once when a file is read in order.
SPAN = 1 << 20
MANIFEST = "shard int, path string, n_docs long, n_ids long"


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = 0, width: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text, in ascending order of id, and write the files; returns the
    manifest ``shard, path, n_docs, n_ids``, one row per file, in the order of the ids.

    ``width`` is 2 or 4 bytes an id, 2 for vocabularies of up to 65,536 ids; a larger id
    fails the job.
    ``end_id`` follows each document (None: nothing does). Null and empty texts have no
    other id. Rows with equal ids stand in order of text, repeated ones side by side.
    Rows with a null id come first. No rows give no files. Other columns do not matter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        path = f"{folder}/{shard:06d}-{uuid.uuid4().hex}.ids"
        out, sizes, documents, no_id = None, [], [], 0
        kind = "<u2" if width == 2 else "<u4"
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                store, place = _store(path)
                store.create_dir(place.rpartition("/")[0], recursive=True)
                out = store.open_output_stream(place)
            no_id += batch.column(0).null_count
            documents.append(batch.column(0).drop_null().to_numpy())
            for _, ids, count in encoder(tokenizer).encode(batch.column(1)):
                if end_id is not None:
                    ids = np.insert(ids, np.cumsum(count), end_id)
                    count = count + 1
                if len(ids) and int(ids.max()) >= 256**width:
                    raise ValueError(f"an id needs more than {width} bytes")
                out.write(ids.astype(kind).tobytes())
                sizes.append(count)
        if out is None:
            return
        edges = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
        named = np.concatenate(documents)
        least = int(named[0]) if len(named) else 0
        marks = EliasFano.of(edges).dump()
        keys = EliasFano.of((named - least).astype(np.uint64)).dump()
        head = [MAGIC, len(edges) - 1, int(edges[-1]), width, len(marks), len(keys), least, no_id]
        out.write(marks + keys + np.array(head, dtype="<i8").tobytes())
        out.close()
        row = {"shard": [shard], "path": [path], "n_docs": [len(edges) - 1], "n_ids": [int(edges[-1])]}
        types = [pa.int32(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row.values(), types, strict=True)], names=list(row))

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ordered = given.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return land(ordered.mapInArrow(run, MANIFEST), "manifest")


def _store(path: str):
    return fs.FileSystem.from_uri(path if "://" in path else path.removeprefix("file:"))


class TokenFile:
    """One file, read by parts."""

    def __init__(self, path: str):
        store, place = _store(path)
        self.file = store.open_input_file(place)
        size = self.file.size()
        foot = np.frombuffer(self.file.read_at(FOOTER, size - FOOTER), dtype="<i8")
        if foot[0] != MAGIC:
            raise ValueError(f"{path} is not a token file")
        self.n_docs, self.n_ids, self.width, a, b, self.least, self.no_id = (int(x) for x in foot[1:])
        at = size - FOOTER - a - b
        self.boundaries = EliasFano.load(self.file.read_at(a, at))
        self.documents = EliasFano.load(self.file.read_at(b, at + a))

    def ids(self, start: int, end: int) -> np.ndarray:
        raw = self.file.read_at((end - start) * self.width, start * self.width)
        return np.frombuffer(raw, dtype=f"<u{self.width}")

    def document(self, i: int) -> np.ndarray:
        """The ids of document ``i``, found by two selects."""
        return self.ids(self.boundaries.select(i), self.boundaries.select(i + 1))

    def doc_ids(self) -> list[int | None]:
        named = self.documents.all().astype(np.int64) + self.least
        return [None] * self.no_id + named.tolist()


def read_token_files(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files alone.

    ``start`` counts the ids of all documents before it, over all files. Files are read
    in spans, so a task holds the boundaries of one file and a span or one document.
    """
    shards = manifest.orderBy("shard").collect()  # one row per file
    before, rows = 0, []
    for x in shards:
        rows.append((x["path"], before))
        before += x["n_ids"]
    kind = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not rows:
        return spark.createDataFrame([], kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield from _documents(TokenFile(path), base)

    return spark.createDataFrame(rows, "path string, base long").repartition(len(rows), "base").mapInArrow(run, kind)


def _documents(file: TokenFile, base: int) -> Iterator[pa.RecordBatch]:
    edges = file.boundaries.all().astype(np.int64)
    doc_ids = pa.array(file.doc_ids(), pa.int64())
    first = 0
    while first < file.n_docs:
        last = int(np.searchsorted(edges, edges[first] + SPAN, side="right")) - 1
        last = min(max(last, first + 1), file.n_docs)
        ids = file.ids(int(edges[first]), int(edges[last])).astype("<u4").tobytes()
        cut = (edges[first : last + 1] - edges[first]) * 4
        crc = [zlib.crc32(ids[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                doc_ids.slice(first, last - first),
                pa.array(edges[first:last] + base),
                pa.array(np.diff(edges[first : last + 1])),
                pa.array(crc, pa.int64()),
            ],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )
        first = last


def token_output(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write all documents below the shared folder and read their digests back."""
    spark = docs.sparkSession
    manifest = write_token_files(docs, new_dir(spark, "token-files"), tokenizer)
    return read_token_files(spark, manifest)
