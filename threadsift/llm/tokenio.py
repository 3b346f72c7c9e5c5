"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding (operator 7).

The documents are range-partitioned and sorted by doc_id, encoded, and cut into blocks of about
``BLOCK_IDS`` ids (whole documents).  A block is self-describing: its ids by falling frequency (the
table), two control bits per id (1 to 4 bytes; four ids to a control byte) apart from the data
bytes, and the doc_ids with their lengths.  Blocks are rows of a Parquet folder, written by Spark's
commit protocol, so a lost executor or a repeated task never leaves half a file, on any store.

Reading back decodes a block with numpy alone: a table gives the byte mask of each control byte,
the mask spreads the data bytes over 32-bit words, the frequency table turns ranks into ids.

Defined cases: a null text is empty and gives the end id alone; rows tie on doc_id in the order of
their text's hash; a row without doc_id comes first; an empty table gives files without blocks; a very
long text stays whole in one block, which may then hold more ids; extra columns are left out by name.
"""

from __future__ import annotations

import os
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadsift.llm.bpe import LETTER, PieceMemory, kept, observed_classes
from threadsift.llm.text import column_bytes, lean, slices

BLOCK_IDS = 1 << 20
END_ID = 0
BUNDLE = 500
_SIZES = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1
_MASK = np.arange(4) < _SIZES[:, :, None]
BLOCK_SCHEMA = ("pid int, block int, before long, n_ids long, doc_ids array<long>, lens array<long>, "
                "table binary, control binary, data binary")


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit values."""
    v = values.astype("<u4")
    code = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    padded = np.zeros(-(-v.size // 4) * 4, np.uint8)
    padded[:v.size] = code
    q = padded.reshape(-1, 4)
    control = q[:, 0] | q[:, 1] << 2 | q[:, 2] << 4 | q[:, 3] << 6
    data = v.view(np.uint8).reshape(-1, 4)[np.arange(4) <= code[:, None]]
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    mask = _MASK[np.frombuffer(control, np.uint8)].reshape(-1, 4)[:n]
    out = np.zeros((n, 4), np.uint8)
    out[mask] = np.frombuffer(data, np.uint8)
    return out.view("<u4").ravel()


def pack_ids(ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """(table, control, data): ids replaced by their frequency rank (ties: the smaller id first)."""
    count = np.bincount(ids)
    used = np.flatnonzero(count)
    order = used[np.argsort(-count[used], kind="stable")]
    rank = np.zeros(count.size, np.uint32)
    rank[order] = np.arange(order.size, dtype=np.uint32)
    return (order.astype("<u4").tobytes(), *pack(rank[ids]))


def unpack_ids(table: bytes, control: bytes, data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(table, "<u4")[unpack(control, data, n)]


def _tokenizer(spec: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tok = Tokenizer.from_str(spec)
    tok.encode_special_tokens = True
    return tok


@lru_cache(1)
def _tables(spec: str) -> tuple[np.ndarray, np.ndarray]:
    """(class of every code point as the library sees it, bytes of every token): made on the driver."""
    tok = _tokenizer(spec)
    split = tok.pre_tokenizer.pre_tokenize_str
    size = np.zeros(tok.get_vocab_size(), np.int32)
    for t, i in tok.get_vocab().items():
        size[i] = len(t)  # a byte-level token has a character for each byte
    return observed_classes(lambda t: [at for _, at in split(t)]), size


def _memory(spec: str, pattern: str, classes: np.ndarray, size: np.ndarray) -> PieceMemory:
    """The library's encoder behind a memory of distinct pieces."""
    tok = _tokenizer(spec)

    def pieces(new):
        # words with their blank keep apart in one text: many go to the library at a time, and the
        # ids fall back into words by their bytes
        texts = [p.decode() for p in new]
        word = np.array([len(t) > 1 and t[0] == " " and classes[ord(t[1])] == LETTER for t in texts], bool)
        bundles = [np.array([i]) for i in np.flatnonzero(~word)]
        words = np.flatnonzero(word)
        bundles += [words[i:i + BUNDLE] for i in range(0, words.size, BUNDLE)]
        got = [e.ids for e in tok.encode_batch_fast(["".join([texts[i] for i in b]) for b in bundles], add_special_tokens=False)]
        lens = np.fromiter(map(len, got), np.int64, len(got))
        ids = np.fromiter(chain.from_iterable(got), np.int32, int(lens.sum()))
        order = np.concatenate(bundles)
        ends = np.cumsum(np.fromiter(map(len, new), np.int64, len(new))[order])
        cut = np.r_[0, np.searchsorted(np.cumsum(size[ids]), ends) + 1]
        count = np.empty(len(new), np.int64)
        count[order] = np.diff(cut)
        begin = np.empty(len(new), np.int64)
        begin[order] = cut[:-1]
        at = np.arange(ids.size) - np.repeat(np.cumsum(count) - count, count)
        return ids[at + np.repeat(begin, count)], count
    return PieceMemory(pattern, pieces, classes)


def write_blocks(docs: DataFrame, model: str, pattern: str, path: str) -> None:
    """Encode ``docs`` (doc_id, text) with the tokenizers library and write the id files to ``path``."""
    with open(model, encoding="utf-8") as f:
        spec = f.read()  # one vocabulary: bounded
    classes, size = _tables(spec)

    def run(batches):
        memory = kept((hash(spec), pattern), lambda: _memory(spec, pattern, classes, size))
        held, doc_ids, lens, total, before, block, pid = [], [], [], 0, 0, 0, 0

        def flush():
            t, c, d = pack_ids(np.concatenate(held))
            return pa.RecordBatch.from_pylist([dict(pid=pid, block=block, before=before, n_ids=total, doc_ids=doc_ids, lens=lens, table=t, control=c, data=d)],
                                              schema=pa.schema([("pid", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()),
                                                                ("doc_ids", pa.list_(pa.int64())), ("lens", pa.list_(pa.int64())),
                                                                ("table", pa.binary()), ("control", pa.binary()), ("data", pa.binary())]))
        for b in batches:
            data, offs = column_bytes(b.column(1))
            for i, j, d, o in slices(data, offs):
                ids, each = memory.ids(d, o)
                pid = b.column(2)[i].as_py()
                end = np.cumsum(each)
                ids = np.insert(ids, end, END_ID)  # the end id after each document
                held.append(ids)
                doc_ids += b.column(0).slice(i, j - i).to_pylist()
                lens += (each + 1).tolist()
                total += ids.size
                if total >= BLOCK_IDS:
                    yield flush()
                    before, block = before + total, block + 1
                    held, doc_ids, lens, total = [], [], [], 0
        if held:
            yield flush()

    n = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    key = F.col("doc_id").cast("long").asc_nulls_first()
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
     .repartitionByRange(n, key).sortWithinPartitions(key, F.xxhash64("text"))
     .withColumn("pid", F.spark_partition_id()).mapInArrow(lean(run), BLOCK_SCHEMA).write.parquet(path))


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the files at ``path``."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                ids = unpack_ids(r["table"], r["control"], r["data"], r["n_ids"])
                lens = np.array(r["lens"], np.int64)
                begin = np.cumsum(lens) - lens
                crc = [zlib.crc32(ids[s:s + k].astype("<u4").tobytes()) for s, k in zip(begin, lens)]
                yield pa.RecordBatch.from_arrays([pa.array(r["doc_ids"], pa.int64()), pa.array([r["pid"]] * lens.size, pa.int32()), pa.array(begin + r["before"]),
                                                  pa.array(lens), pa.array(crc, pa.int64())], ["doc_id", "pid", "start", "n_tokens", "ids_crc32"])
    docs = blocks.mapInArrow(lean(run), "doc_id long, pid int, start long, n_tokens long, ids_crc32 long")
    # one row per written partition, so the broadcast is bounded by their number
    offs = (blocks.groupBy("pid").agg(F.sum("n_ids").alias("t"))
            .select("pid", F.coalesce(F.sum("t").over(Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("off")))
    return (docs.join(F.broadcast(offs), "pid")
            .select("doc_id", (F.col("start") + F.col("off")).alias("start"), "n_tokens", "ids_crc32"))


def texts_of(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, ids (array) of every document in the files at ``path``: the general reader."""
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                ids = unpack_ids(r["table"], r["control"], r["data"], r["n_ids"]).astype(np.int32)
                cut = np.r_[0, np.cumsum(r["lens"])].astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(r["doc_ids"], pa.int64()), pa.ListArray.from_arrays(pa.array(cut), pa.array(ids))], ["doc_id", "ids"])
    return spark.read.schema(BLOCK_SCHEMA).parquet(path).mapInArrow(lean(run), "doc_id long, ids array<int>")
