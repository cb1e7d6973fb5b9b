"""Token ids in files of range asymmetric numeral system blocks.

Method. Rows are dealt to partitions by ranges of their id and encoded in ascending
order. A partition cuts its ids into segments of about ``SEGMENT`` tokens, each one file.
A segment has one static frequency table, shared by all its blocks: counts scaled to
2^bits. A block is ``BLOCK`` tokens, dealt in turn to ``LANES`` interleaved states from
2^28 to 2^52, which share one stream of 24-bit words (so that a double divides a state
exactly, and one word at most leaves it a step). Blocks are independent: each has a checkpoint
(its place in the stream, first token and final states) and a CRC-32 of its ids, so any
block can be decoded alone, or all in parallel; here numpy handles all lanes of all blocks
of a segment at once. A file holds, in little-endian order:

    magic "TRNS", version, bits, lanes, block size, tokens of the partition before it, own
    tokens, documents, blocks, table size
    ids and frequencies of the table; document ids and their token counts
    per block: words before it, CRC-32, final states; then the words

Files are named by partition and segment and written whole under a temporary name, then
renamed, so a task that runs again leaves the same file. ``manifest`` has a row a file.
The global place of a document needs only the token count of each partition, one number
for each, summed on the driver.

Bounds. Memory holds one segment and one slice of text, or one document where that is longer. A range of ids is
one partition; repeated ids are dealt further by their text, so that no id is one task.

Cases. Null and empty texts hold the end id only. Null ids come first. Rows of one id are
ordered by their text. Extra columns are ignored; an empty table gives no files and an
empty result. A damaged block raises ValueError.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capturelake.llm import bpe
from capturelake.llm import text as tx
from capturelake.scratch import Scratch

SEGMENT = 1 << 21
BLOCK = 1 << 15
LANES = 32
_LOW = np.int64(1 << 28)
_WORD = np.int64(24)
_MAGIC = b"TRNS"
_HEAD = np.dtype([("magic", "S4"), ("version", "<u4"), ("bits", "<u4"), ("lanes", "<u4"), ("block", "<u4"), ("first", "<u8"), ("tokens", "<u8"), ("docs", "<u8"), ("blocks", "<u4"), ("table", "<u4")])


def frequencies(counts: np.ndarray, bits: int) -> np.ndarray:
    """Counts scaled to sum to 2^bits, at least 1 where a count is."""
    total, size = int(counts.sum()), 1 << bits
    f = np.maximum(counts.astype(np.float64) * size / total, 1).astype(np.int64)
    f[counts == 0] = 0
    rest = size - int(f.sum())
    order = np.argsort(-f, kind="stable")
    while rest:
        if rest > 0:
            f[order[0]] += rest
            rest = 0
        else:
            take = np.minimum(f[order] - 1, np.maximum(1, (f[order] * -rest) // size))
            take = np.minimum(take, np.maximum(0, -rest - (np.cumsum(take) - take)))
            f[order] -= take
            rest += int(take.sum())
    return f


def _encode_blocks(slots: np.ndarray, freq: np.ndarray, start: np.ndarray, bits: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Final states (blocks, lanes) and word streams of slots (blocks, steps, lanes)."""
    blocks, steps, lanes = slots.shape
    x = np.full((blocks, lanes), _LOW, np.int64)
    words = np.empty((steps, blocks, lanes), np.uint32)
    out = np.empty((steps, blocks, lanes), bool)
    shift, bits = np.int64(52 - bits), np.int64(bits)
    for t in range(steps - 1, -1, -1):
        s = slots[:, t]
        f = freq[s]
        full = x >= (f << shift)
        words[t] = x & 0xFFFFFF
        out[t] = full
        np.right_shift(x, _WORD, out=x, where=full)
        q = (x / f).astype(np.int64)
        x = (q << bits) + (x - q * f) + start[s]
    return x, [words[:, b][out[:, b]] for b in range(blocks)]


def _decode_blocks(x: np.ndarray, words: np.ndarray, at: np.ndarray, steps: int, freq, start, slot_of, bits: int) -> np.ndarray:
    """Slots (blocks, steps, lanes) from final states, the joined words and each block's place in them."""
    x, at = x.copy(), at.astype(np.int64).copy()
    out = np.empty((len(x), steps, x.shape[1]), slot_of.dtype)
    mask, bits = np.int64((1 << bits) - 1), np.int64(bits)
    words = np.append(words, 0).astype(np.int64)
    last = len(words) - 1
    for t in range(steps):
        low = x & mask
        s = slot_of[low]
        out[:, t] = s
        x = freq[s] * (x >> bits) + low - start[s]
        need = x < _LOW
        rank = np.cumsum(need, 1)
        got = words[np.minimum(at[:, None] + rank - 1, last)]
        x = np.where(need, (x << _WORD) | got, x)
        at += rank[:, -1]
    # the coder began there, so anything else shows damage
    if (x != _LOW).any():
        raise ValueError("a block is damaged")
    return out


def _three_bytes(words: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(words.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3])


def _from_three(raw: np.ndarray) -> np.ndarray:
    out = np.zeros((len(raw) // 3, 4), np.uint8)
    out[:, :3] = raw.reshape(-1, 3)
    return out.view("<u4")[:, 0]


def pack(doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray, first: int = 0) -> bytes:
    """A segment's file; first: the partition's tokens before it."""
    n = np.bincount(ids)
    used = np.flatnonzero(n)
    place = np.zeros(len(n), np.int64)
    place[used] = np.arange(len(used))
    slots, n = place[ids], n[used]
    bits = min(20, max(12, int(len(used) - 1).bit_length() + 3))
    freq = frequencies(n, bits)
    start = np.cumsum(freq) - freq
    blocks = -(-len(ids) // BLOCK)
    # unused places of the last block repeat the likeliest id; its steps end with its tokens
    steps_all, tail = BLOCK // LANES, len(ids) - (blocks - 1) * BLOCK
    steps_last = -(-tail // LANES)
    padded = np.full(((blocks - 1) * BLOCK + steps_last * LANES), int(np.argmax(n)), np.int64)
    padded[: len(ids)] = slots
    states, streams = [], []
    for lo, hi, steps in ((0, blocks - 1, steps_all), (blocks - 1, blocks, steps_last)):
        if hi > lo:
            part = padded[lo * BLOCK : lo * BLOCK + (hi - lo) * steps * LANES].reshape(hi - lo, steps, LANES)
            x, w = _encode_blocks(part, freq, start, bits)
            states.append(x)
            streams += w
    raw = np.ascontiguousarray(ids, "<u4")
    marks = np.array([zlib.crc32(raw[b * BLOCK : (b + 1) * BLOCK]) for b in range(blocks)], "<u4")
    before = np.cumsum([0, *map(len, streams)])[:-1].astype("<u8")
    head = np.zeros(1, _HEAD)
    head[0] = (_MAGIC, 1, bits, LANES, BLOCK, first, len(ids), len(doc_ids), blocks, len(used))
    parts = [head, used.astype("<u4"), freq.astype("<u4"), doc_ids.astype("<i8"), counts.astype("<u4"), before, marks, np.concatenate(states).astype("<u8"), *map(_three_bytes, streams)]
    return b"".join(p.tobytes() for p in parts)


class Segment:
    """A file's content; blocks(a, b) decodes some blocks alone."""

    def __init__(self, raw: bytes):
        if len(raw) < _HEAD.itemsize or raw[:4] != _MAGIC:
            raise ValueError("not a token file")
        self.head = np.frombuffer(raw, _HEAD, 1)[0]
        at = _HEAD.itemsize

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, n, at)
            at += out.nbytes
            return out

        h = self.head
        self.used, self.freq = take("<u4", h["table"]), take("<u4", h["table"]).astype(np.int64)
        self.doc_ids, self.counts = take("<i8", h["docs"]), take("<u4", h["docs"])
        self.before, self.marks = take("<u8", h["blocks"]), take("<u4", h["blocks"])
        self.states = take("<u8", int(h["blocks"]) * int(h["lanes"])).astype(np.int64).reshape(-1, h["lanes"])
        self.words = _from_three(np.frombuffer(raw, np.uint8, -1, at))
        self.start = np.cumsum(self.freq) - self.freq
        self.slot_of = np.repeat(np.arange(len(self.used), dtype=np.uint16 if len(self.used) <= 1 << 16 else np.uint32), self.freq)

    def blocks(self, lo: int, hi: int) -> np.ndarray:
        """The ids of blocks lo to hi, checked."""
        h, out = self.head, []
        lanes, block, last = int(h["lanes"]), int(h["block"]), int(h["blocks"]) - 1
        tail = int(h["tokens"]) - last * block
        for a, b, steps, n in ((lo, min(hi, last), block // lanes, block), (max(lo, last), hi, -(-tail // lanes), tail)):
            if b > a:
                got = _decode_blocks(self.states[a:b], self.words, self.before[a:b], steps, self.freq, self.start, self.slot_of, int(h["bits"]))
                ids = self.used[got.reshape(b - a, -1)[:, :n]]
                for i, row in enumerate(ids):
                    if zlib.crc32(np.ascontiguousarray(row, "<u4")) != self.marks[a + i]:
                        raise ValueError(f"block {a + i} is damaged")
                out.append(ids.ravel())
        return np.concatenate(out) if out else np.zeros(0, np.uint32)


def _write(source, pattern: str, end_id: int, folder: str):
    def run(batches):
        own = bpe.codec(source.value, pattern)
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        partition = TaskContext.get().partitionId()
        doc_ids, counts, ids, held, segment, offset = [], [], [], 0, 0, 0

        def flush():
            nonlocal doc_ids, counts, ids, held, segment, offset
            n = np.concatenate(counts)
            raw = pack(np.concatenate(doc_ids), n, np.concatenate(ids), offset)
            name = f"{root}/part-{partition:06d}-{segment:06d}.rans"
            with fs.open_output_stream(own_name := f"{root}/.{uuid.uuid4().hex}") as f:
                f.write(raw)
            # a task that runs again finds its file there, and not every store replaces it
            if fs.get_file_info(name).type != pafs.FileType.NotFound:
                fs.delete_file(name)
            fs.move(own_name, name)
            row = (partition, segment, offset, len(n), held, len(raw))
            doc_ids, counts, ids, segment, offset, held = [], [], [], segment + 1, offset + held, 0
            return pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in row], ["partition", "segment", "first", "docs", "tokens", "bytes"])

        for batch in batches:
            for part in tx.slices(batch, "text", bpe.SLICE):
                found, bounds = own.encode_column(part.column(1))
                doc_ids.append(pc.fill_null(part.column(0), NO_ID).to_numpy())
                counts.append(np.diff(bounds) + 1)
                ids.append(np.insert(found, bounds[1:], np.uint32(end_id)))
                held += len(ids[-1])
                if held >= SEGMENT:
                    yield flush()
        if held:
            yield flush()

    return tx.released(run)


NO_ID = -(1 << 63)


def write_tokens(docs: DataFrame, work: Scratch, tokenizer_path: str, pattern: str, end_id: int = 0, id_col="doc_id", text_col="text") -> DataFrame:
    """Writes the files under work's folder; gives the manifest, a row for each file."""
    spark = docs.sparkSession
    source = bpe.file_source(spark, tokenizer_path, pattern)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order, "text")
    kind = "partition long, segment long, first long, docs long, tokens long, bytes long"
    return work.save(dealt.mapInArrow(_write(source, pattern, end_id, work.path("tokens")), kind), "manifest")


def read_tokens(spark: SparkSession, work: Scratch, handle, kind: str) -> DataFrame:
    """handle(ids, segment) of every file, as rows of partition and its columns; a file is decoded at once."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.rans").load(work.path("tokens")).select("path", "content")

    def run(batches):
        for batch in batches:
            for path, raw in zip(batch.column(0), batch.column(1), strict=True):
                part = str(path).rpartition("/")[2].split("-")[1]
                s = Segment(raw.as_py())
                got = handle(s.blocks(0, int(s.head["blocks"])), s)
                n = len(s.doc_ids)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, int(part))), *got.values()], ["partition", *got])

    return files.mapInArrow(tx.released(run), f"partition long, {kind}")


def _digest(ids, segment):
    doc_ids, counts = segment.doc_ids, segment.counts
    ends = np.cumsum(counts, dtype=np.int64)
    starts = ends - counts
    raw = np.ascontiguousarray(ids, "<u4")
    return {
        "id": pa.array(doc_ids, mask=doc_ids == NO_ID),
        "within": pa.array(starts + int(segment.head["first"])),
        "n_tokens": pa.array(counts.astype(np.int64)),
        "crc": pa.array([zlib.crc32(raw[a:b]) for a, b in zip(starts, ends, strict=True)], pa.int64()),
    }


def token_index(docs: DataFrame, tokenizer_path: str, pattern: str, end_id: int = 0, id_col="doc_id", text_col="text") -> DataFrame:
    """Writes docs as token files, reads them back: (id, start, n_tokens, crc)."""
    spark = docs.sparkSession
    work = Scratch(spark, "tokens")
    manifest = write_tokens(docs, work, tokenizer_path, pattern, end_id, id_col, text_col)
    kind = "id long, within long, n_tokens long, crc long"
    # one number for each partition
    totals = {r["partition"]: r["n"] for r in manifest.groupBy("partition").agg(F.sum("tokens").alias("n")).collect()}
    if not totals:
        return spark.createDataFrame([], "id long, start long, n_tokens long, crc long")
    bases, base = [], 0
    for p in sorted(totals):
        bases.append((p, base))
        base += totals[p]
    places = spark.createDataFrame(bases, "partition long, base long")
    found = read_tokens(spark, work, _digest, kind)
    # a row for each shuffle partition on the side that is sent
    return found.join(F.broadcast(places), "partition").select("id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "crc")


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = token_index(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return out.select(F.col("id").alias("doc_id"), "start", "n_tokens", F.col("crc").alias("ids_crc32"))
