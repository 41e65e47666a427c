"""Corpora as token-id files: documents out in ascending ``doc_id`` order, and back.

Documents are range partitioned and sorted by ``doc_id``; every task encodes its range and writes
one file after another of about ``FILE_IDS`` ids (format: ``tokenfile``), so file names sort as the
documents do. A file is written under a temporary name and then moved, and its content depends on
its documents only, so a task that runs twice leaves the same file. The folder must be one that all
executors share; files are opened by ``pyarrow.fs`` and so may lie on any store it knows.

Defined results: null text counts as empty, such a document holds the end id alone; a null
``doc_id`` sorts first; rows of one ``doc_id`` are written in the order of their texts; an empty table
gives no file and an empty result; other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.llm.common import gathered, materialize, scratch_dir, ship, text_or_empty
from grainmill.llm.tokenfile import read_file, write_file
from grainmill.llm.tokens import BATCH, default_tokenizer, encoder
from grainmill.operators.windows import running_total

END, FILE_IDS, ROOM = 2, 8 << 20, 3
_MANIFEST = "path string, part int, file int, n_docs long, n_ids long, n_bytes long"


def write_tokens(docs: DataFrame, folder: str, tokenizer: str | None = None, end: int = END) -> DataFrame:
    """Write every document's ids and the end id; returns the manifest, one row per file."""
    spark = docs.sparkSession
    ship(spark)
    path = tokenizer or default_tokenizer()

    def write(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(path, ROOM), TaskContext.get().partitionId()
        store, root = pafs.FileSystem.from_uri(folder)
        tail = np.array([end], "<u2").tobytes()
        docs_, sizes, held, n, k = [], [], [], 0, 0
        made = []

        def put() -> None:
            data = write_file(docs_, sizes, np.frombuffer(b"".join(held), "<u2"))
            name, temp = f"{root}/ids-{part:08d}-{k:05d}.tok", f"{root}/.{uuid.uuid4().hex}"
            with store.open_output_stream(temp) as f:
                f.write(data)
            store.move(temp, name)
            made.append((name, part, k, len(docs_), n, len(data)))

        for b in gathered(it, BATCH):
            for doc, ids in zip(b.column(0).to_pylist(), enc.encode(b.column(1).cast(pa.binary()).to_pylist())):
                if docs_ and n + len(ids) // 2 > FILE_IDS:
                    put()
                    docs_, sizes, held, n, k = [], [], [], 0, k + 1
                docs_.append(doc)
                held += [ids, tail]
                sizes.append(len(ids) // 2 + 1)
                n += sizes[-1]
        if docs_:
            put()
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], [x.split()[0] for x in _MANIFEST.split(", ")])

    pafs_store, pafs_root = pafs.FileSystem.from_uri(folder)
    pafs_store.create_dir(pafs_root, recursive=True)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    return materialize(rows.mapInArrow(write, _MANIFEST), "manifest")


def read_tokens(manifest: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, read from the files.

    ``start`` counts the ids before a document; files know their own, a running total over the
    manifest adds what the files before them hold. ``with_ids`` adds the ids.
    """
    spark = manifest.sparkSession
    order = (F.col("part").cast("long") * (1 << 24) + F.col("file")).alias("place")
    files = running_total(manifest.select("path", "n_ids", order), F.col("n_ids"), [], "place", "upto")
    files = materialize(files.select("path", (F.col("upto") - F.col("n_ids")).alias("first")), "files")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = pafs.FileSystem.from_uri(folder)
        for b in it:
            for name, first in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with store.open_input_stream(name) as f:
                    docs, sizes, ids = read_file(f.read())
                sizes = sizes.astype(np.int64)
                ends = np.cumsum(sizes)
                for i in range(0, len(docs), 20_000):
                    s, e = sizes[i : i + 20_000], ends[i : i + 20_000]
                    parts = [ids[y - x : y] for x, y in zip(s.tolist(), e.tolist())]
                    crc = [zlib.crc32(p.astype("<u4").tobytes()) for p in parts]
                    cols = [pa.array(docs[i : i + 20_000], pa.int64()), pa.array(first + e - s), pa.array(s), pa.array(crc, pa.int64())]
                    if with_ids:
                        cols.append(pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32())))
                    yield pa.RecordBatch.from_arrays(cols, [x.split()[0] for x in schema.split(", ")])

    # some files a task; round robin over a written table, whose rows are a file each
    return files.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).mapInArrow(read, schema)


def token_round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write a corpus to the shared scratch folder and return what the files say of each document."""
    folder = f"{scratch_dir(docs.sparkSession)}/tokens-{uuid.uuid4().hex[:12]}"
    return read_tokens(write_tokens(docs, folder, tokenizer), folder)
