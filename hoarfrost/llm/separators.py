"""Token counts of documents in flat token files: a scan for the end-of-document id, block by block."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hoarfrost.llm.common import SharedFile, map_arrow, new_folder, pieces, read_file, stored, text_buffers
from hoarfrost.llm.tokens import encoder, with_end

#: Bytes of a file that one step of the scan reads.
BLOCK_BYTES = 1 << 22
#: Blocks of one file that the inner level of the prefix scan takes together.
BLOCKS_A_GROUP = 1024


def write_flat(docs: DataFrame, tokenizer: str, end: int, folder: str, key: str = "doc_id", text: str = "text", lower: bool = False) -> DataFrame:
    """Write each partition's texts as one flat file of ids without any index, `end` after each text.

    Ids are little-endian, two bytes each if every id of the tokenizer fits, else four. Returns a
    stored table of documents: file, ordinal (place among the file's documents), width and the key.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer, lower)
        kind = "<u2" if max(tool.library.get_vocab_size(), end + 1) <= 1 << 16 else "<u4"
        name, file, at = f"part-{TaskContext.get().partitionId():07d}.ids", None, 0
        for batch in pieces(batches, text):
            file = file or SharedFile(folder, name)
            ids, _ = with_end(*tool.encode(*text_buffers(batch.column(text))), end)
            file.write(ids.astype(kind).tobytes())
            n = batch.num_rows
            arrays = [pa.array([name] * n, pa.string()), pa.array(np.arange(at, at + n)), pa.array([int(kind[-1])] * n, pa.int32())]
            at += n
            yield pa.RecordBatch.from_arrays([*arrays, batch.column(key)], ["file", "ordinal", "width", key])
        if file:
            file.close()

    schema = f"file string, ordinal long, width int, {key} long"
    return stored(map_arrow(docs.select(F.col(key).cast("long").alias(key), text), write, schema, keeps=True), "flat-order")


def scan_flat(files: DataFrame, folder: str, end: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents of flat token files, found by their end ids alone.

    `files` has file, width (bytes of an id) and bytes. Each block of a file is read by itself and
    searched for the end id in one vectorised step. A prefix scan over the blocks then gives each
    block the number of documents that ended before it and the place where the last of them ended, so
    a document that spans blocks, or fills many, is stitched together. Ids after the last end id make
    a document of their own, with `closed` false.

    Returns file, ordinal, start (ids of the file before the document), n_tokens (with the end id)
    and closed. A file without ids has no documents.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                kind = f"<u{row['width']}"
                ids = np.frombuffer(read_file(folder, row["file"], row["at"], row["length"]), kind)
                hits = np.flatnonzero(ids == end) + 1 + row["at"] // row["width"]
                arrays = [[row["file"]], [row["block"]], [row["last"]], [(row["at"] + row["length"]) // row["width"]], [hits.tolist()]]
                types = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(a, t) for a, t in zip(arrays, types, strict=True)], ["file", "block", "last", "until", "ends"])

    step = F.floor(F.lit(block_bytes) / F.col("width")) * F.col("width")
    blocks = files.where("bytes > 0").withColumn("step", step)
    blocks = blocks.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("bytes") / F.col("step")) - 1)))
    blocks = blocks.select(
        "file", "width", "block", (F.col("block") * F.col("step")).alias("at"),
        F.least(F.col("step"), F.col("bytes") - F.col("block") * F.col("step")).alias("length"),
        ((F.col("block") + 1) * F.col("step") >= F.col("bytes")).alias("last"),
    )
    blocks = stored(blocks, "flat-blocks")
    parts = max(1, min(blocks.count(), 100_000))
    found = map_arrow(blocks.repartition(parts, "file", "block"), search, "file string, block long, last boolean, until long, ends array<long>")
    found = stored(found, "flat-ends")
    # Two levels of the prefix scan: blocks in their group, then groups in their file.
    sums = found.select("file", "block", F.floor(F.col("block") / BLOCKS_A_GROUP).alias("part"), F.size("ends").cast("long").alias("n"), F.array_max("ends").alias("latest"))
    groups = sums.groupBy("file", "part").agg(F.sum("n").alias("n"), F.max("latest").alias("latest"))
    over_groups = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("file", "part", F.sum("n").over(over_groups).alias("docs0"), F.max("latest").over(over_groups).alias("end0"))
    over_blocks = Window.partitionBy("file", "part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inner = sums.select("file", "part", "block", F.sum("n").over(over_blocks).alias("docs1"), F.max("latest").over(over_blocks).alias("end1"))
    before = inner.join(groups, ["file", "part"]).select(
        "file", "block",
        (F.coalesce("docs0", F.lit(0)) + F.coalesce("docs1", F.lit(0))).alias("docs"),
        F.coalesce("end1", "end0", F.lit(0)).alias("open"),
    )
    placed = found.join(before, ["file", "block"])
    # What follows the last end id of the last block is a document that nothing closes.
    tail = F.col("last") & (F.col("until") > F.coalesce(F.array_max("ends"), F.col("open")))
    stops = F.when(tail, F.concat("ends", F.array("until"))).otherwise(F.col("ends"))
    docs = placed.select("file", "docs", "open", "ends", stops.alias("stops")).select("file", "docs", "open", "ends", "stops", F.posexplode("stops").alias("i", "stop"))
    start = F.when(F.col("i") == 0, F.col("open")).otherwise(F.element_at("stops", F.greatest(F.col("i"), F.lit(1))))
    return docs.select("file", (F.col("docs") + F.col("i")).alias("ordinal"), start.alias("start"), (F.col("stop") - start).alias("n_tokens"), (F.col("i") < F.size("ends")).alias("closed"))


def flat_files(spark: SparkSession, order: DataFrame, folder: str) -> DataFrame:
    """Name, width and size of the files that a written table of documents names."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hoarfrost.llm.common import file_system

        for batch in batches:
            fs, path = file_system(folder)
            sizes = [fs.get_file_info(f"{path}/{x}").size for x in batch.column("file").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("width"), pa.array(sizes, pa.int64())], ["file", "width", "bytes"])

    return map_arrow(order.select("file", "width").distinct(), look, "file string, width int, bytes long")


def count_tokens(docs: DataFrame, tokenizer: str, end: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokens of every document, counted by scanning flat files that were written without an index.

    Returns the key, file, ordinal, start (ids of the file before the document) and n_tokens (with the
    end id). A null or empty text has one token, its end id; repeated rows and null keys are documents
    like any other. The end id never occurs inside a text: special strings are ordinary text.
    """
    folder = new_folder(docs.sparkSession, "flat")
    order = write_flat(docs, tokenizer, end, folder, key, text)
    found = scan_flat(flat_files(docs.sparkSession, order, folder), folder, end)
    return order.select("file", "ordinal", key).join(found, ["file", "ordinal"]).select(key, "file", "ordinal", "start", "n_tokens")
