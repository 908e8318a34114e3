"""Token counts from flat token files, by scanning for the end-of-document identifier.

A flat file is one run of token ids; documents end with a separator id and nothing says where. Files are stored as
numbered blocks of a fixed number of ids. Blocks are searched on their own, each as one vector comparison; what a block
passes on is the position of its last separator. A prefix scan over the blocks of a file then gives every block the last
separator before it, and with it the length of the document that its first separator ends.

Defined cases: null and empty texts are documents of 0 tokens; repeated rows are documents of their own; ids after the
last separator of a file belong to no document; an empty table gives no files and no rows.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitlens.llm.common import BINARY, LONG
from remitlens.storage import stored

BLOCK_IDS = 1 << 18
#: Texts that a tokenizer call takes at a time, in characters; bounds what a task holds besides a block.
BATCH_CHARS, BATCH_ROWS = 1 << 18, 256
Encoder = Callable[[list[str]], list[list[int]]]


@functools.lru_cache(maxsize=2)
def rank_encoder(path: str, pattern: str) -> Encoder:
    """Byte-pair encoder from a file of ranks (a base64 token and its rank in each line). Special strings are ordinary text."""
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
    encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return lambda texts: [encoding.encode_ordinary(t) for t in texts]


def token_files(docs: DataFrame, encoder: Callable[[], Encoder], separator: int, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Documents as flat files: (file, block, ids, doc_ids), one file for each input partition.

    ``ids`` are unsigned 32-bit numbers; ``doc_ids`` names the documents whose separator lies in the block, in order, so
    that counts can be handed back. ``encoder`` is called inside tasks.
    """
    key = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("file", LONG), T.StructField("block", LONG), T.StructField("ids", BINARY), T.StructField("doc_ids", T.ArrayType(key))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, number = encoder(), TaskContext.get().partitionId()
        state = {"block": 0, "parts": [], "size": 0, "names": []}

        def blocks(kind: pa.DataType, last: bool = False) -> Iterator[pa.RecordBatch]:
            """Whole blocks of what has been gathered; at the end the rest too. ``names`` holds (end, id)."""
            while state["size"] >= block_ids or (last and state["size"]):
                ids = np.concatenate(state["parts"])
                cut = min(block_ids, len(ids))
                here = [name for end, name in state["names"] if end <= cut]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), pa.array([state["block"]], pa.int64()), pa.array([ids[:cut].tobytes()], pa.binary()), pa.array([here], pa.list_(kind))],
                    names=schema.names,
                )
                state.update(block=state["block"] + 1, parts=[ids[cut:]], size=len(ids) - cut, names=[(end - cut, name) for end, name in state["names"] if end > cut])

        kind = pa.int64()
        # Few rows at a time become Python objects.
        for batch in (b.slice(at, BATCH_ROWS) for b in batches for at in range(0, b.num_rows, BATCH_ROWS)):
            kind = batch.schema.field("doc_id").type
            texts, names = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
            at = 0
            while at < len(texts):
                end, chars = at, 0
                while end < len(texts) and (end == at or chars < BATCH_CHARS):
                    chars += len(texts[end] or "")
                    end += 1
                for name, ids in zip(names[at:end], encode([t or "" for t in texts[at:end]]), strict=True):
                    state["parts"].append(np.array([*ids, separator], np.uint32))
                    state["size"] += len(ids) + 1
                    state["names"].append((state["size"], name))
                    yield from blocks(kind)
                at = end
        yield from blocks(kind, last=True)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def flat_blocks(files: DataFrame, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Blocks of existing flat files of unsigned 32-bit ids: rows of Spark's ``binaryFile`` source as (file, block, ids).

    That source brings a file as one value, so files must stay under its 2 GB.
    """
    size = 4 * block_ids
    blocks = F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("length") / size) - 1, F.lit(0)))
    rows = files.select(F.col("path").alias("file"), "content", F.explode(blocks).alias("block"))
    return rows.select("file", "block", F.substring("content", (F.col("block") * size + 1).cast("int"), F.lit(size)).alias("ids"))


def separators(blocks: DataFrame, separator: int, block_ids: int = BLOCK_IDS) -> DataFrame:
    """``blocks`` without ids, but with ``ends``: places of separators, counted from the start of the file."""
    rest = [f for f in blocks.schema if f.name not in ("ids", "ends")]
    schema = T.StructType([*rest, T.StructField("ends", T.ArrayType(LONG))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = [
                np.flatnonzero(np.frombuffer(ids or b"", np.uint32) == separator) + block * block_ids
                for ids, block in zip(batch.column("ids").to_pylist(), batch.column("block").to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in rest), pa.array(ends, pa.list_(pa.int64()))], names=schema.names)

    return blocks.mapInArrow(run, schema)


def counts(found: DataFrame) -> DataFrame:
    """(file, first_token, n_tokens) and the other columns of ``found``: a row for each document, stitched over blocks."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.coalesce(F.max(F.element_at("ends", -1)).over(before), F.lit(-1).cast("long"))
    slim = found.where(F.size("ends") > 0).withColumn("_carried", carried)
    rest = [c for c in slim.columns if c not in ("ends", "_carried", "doc_ids", "block")]
    named = "doc_ids" in found.columns
    each = F.posexplode(F.arrays_zip("ends", "doc_ids") if named else F.arrays_zip("ends")).alias("_i", "_x")
    rows = slim.select(*rest, "ends", "_carried", each)
    first = F.coalesce(F.get("ends", F.col("_i") - 1), F.col("_carried")) + 1
    names = [F.col("_x")["doc_ids"].alias("doc_id")] if named else []
    return rows.select(*names, *rest, first.alias("first_token"), (F.col("_x")["ends"] - first).alias("n_tokens"))


def document_tokens(docs: DataFrame, encoder: Callable[[], Encoder], separator: int, block_ids: int = BLOCK_IDS) -> DataFrame:
    """(doc_id, file, first_token, n_tokens) of documents, by way of stored flat files."""
    files = stored(token_files(docs, encoder, separator, block_ids), "tokens")
    return counts(stored(separators(files, separator, block_ids), "separators"))


