"""Byte-level BPE with the tokenizers library over Arrow batches.

Method. A file of ranks (base64 token, rank on each line) becomes a tokenizers model:
bytes are written as the 256 printable characters of the byte table, each token is the
merge of the two tokens that lower ranks make of its bytes, and texts are first split by
the pattern. Encoding gives ids, and each token's span in bytes and in characters,
from the lengths of the tokens and a byte-to-character map of the text. A token may
end inside a character; its span in characters then covers that character. Decoding
joins the bytes of the tokens by the reversed byte table; ids may be decoded in pieces,
with an incremental decoder that keeps the bytes of a split character for the next.

The model gives the ids of a pattern match by itself, so a slice of texts is cut into its
matches at once (split.py for the usual pattern, the regex module for others), Arrow's
dictionary encoding gives the different ones, the library is asked together for those that
the worker has not met, and ids are gathered by match. What a worker keeps is bounded by
``KEPT`` matches. The vocabulary is bounded by its file and sent to each worker once.
Everything runs on one thread, so tasks keep to their cores.

Cases. Null and empty texts have no tokens and decode to nothing. Files of ranks have no
special tokens, so their strings are ordinary text; a tokenizers file's added tokens are
found in texts as the library finds them. Repeated rows are encoded again; extra columns are
ignored; an empty table gives an empty result. Ids outside the vocabulary raise.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capturelake.llm import split
from capturelake.llm import text as tx
from capturelake.scratch import ship


def byte_table() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next free one from 256 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table, free = {}, 256
    for b in range(256):
        if b in own:
            table[b] = chr(b)
        else:
            table[b], free = chr(free), free + 1
    return [table[b] for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def last_merge(ranks: dict[bytes, int], token: bytes, rank: int) -> tuple[bytes, bytes]:
    """The two tokens that make a token: what merging its bytes by lower ranks leaves.

    Merges within a token's span don't depend on what stands beside it, so this is the only way it comes about.
    """
    splits = [i for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
    if len(splits) == 1:
        return token[: splits[0]], token[splits[0] :]
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        each = [ranks.get(a + b, rank) for a, b in zip(parts, parts[1:], strict=False)]
        least = min(each)
        if least >= rank:
            raise ValueError(f"no two tokens make {token!r}")
        i = each.index(least)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts[0], parts[1]


def model_json(ranks: dict[bytes, int], pattern: str) -> str:
    """The tokenizers file of a BPE that gives the ids of these ranks."""
    table = byte_table()

    def shown(token: bytes) -> str:
        return "".join(table[b] for b in token)

    merges = [(rank, *map(shown, last_merge(ranks, token, rank))) for token, rank in sorted(ranks.items(), key=lambda x: x[1]) if len(token) > 1]
    return json.dumps(
        {
            "version": "1.0",
            "added_tokens": [],
            "pre_tokenizer": {
                "type": "Sequence",
                "pretokenizers": [
                    {"type": "Split", "pattern": {"Regex": pattern}, "behavior": "Isolated", "invert": False},
                    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False},
                ],
            },
            "decoder": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False},
            "model": {"type": "BPE", "vocab": {shown(t): r for t, r in ranks.items()}, "merges": [[a, b] for _, a, b in merges], "ignore_merges": True, "byte_fallback": False},
        }
    )


KEPT = 300_000
#: between matches that are encoded together; no character of the byte table
_BETWEEN = 0xE000


class Codec:
    """Ids of whole columns: the library encodes every different match once, and its ids are kept."""

    def __init__(self, source: str, pattern: str, classes: bytes | None = None):
        """source: a tokenizers file; classes: those of split.py for its pattern, the library's own if None."""
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(source)
        self.classes = None
        if pattern == split.PATTERN:
            self.classes = split.library_classes() if classes is None else np.frombuffer(classes, np.uint8)
        else:
            import regex

            # White_Space is what the pattern's \s means to the library
            self.find = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).finditer
        self.apart = Tokenizer(self.tokenizer.model)
        self.apart.pre_tokenizer = pre_tokenizers.Split(chr(_BETWEEN), "removed")
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        table = byte_table()
        self.shown = np.array([ord(c) for c in table], np.uint32)
        back = {c: b for b, c in enumerate(table)}
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes: list[bytes] = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes[i] = bytes(back[c] for c in token) if all(c in back for c in token) and token not in self.added else token.encode()
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        self.first = np.cumsum(self.lengths) - self.lengths
        self.joined = np.frombuffer(b"".join(self.bytes), np.uint8)
        names = [f"{i},".encode() for i in range(len(self.bytes))]
        self.name_lengths = np.array([len(n) for n in names], np.int64)
        self.name_first = np.cumsum(self.name_lengths) - self.name_lengths
        self.names = np.frombuffer(b"".join(names), np.uint8)
        self._forget()
        del back, vocab, names
        tx.release()

    def _forget(self) -> None:
        # of the kept matches: hashes, bytes, ids, and whether one was used since the last clearing
        self.table = tx.Table(np.zeros(0, np.uint64))
        self.raw, self.raw_at, self.raw_sizes = np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.at, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.used = np.zeros(0, bool)

    def _room(self) -> None:
        """Matches that were not used since the last time go when many are kept."""
        if len(self.used) > KEPT:
            old = np.flatnonzero(self.used)
            if len(old) > KEPT // 2:
                self._forget()
                return
            self.table = tx.Table(self.table.keys[old])
            for text, at, sizes in (("raw", "raw_at", "raw_sizes"), ("flat", "at", "sizes")):
                joined, ends = split.gather(getattr(self, text), getattr(self, at)[old], getattr(self, sizes)[old])
                setattr(self, text, joined)
                setattr(self, sizes, getattr(self, sizes)[old])
                setattr(self, at, ends - getattr(self, sizes))
            self.used = np.zeros(len(old), bool)

    def _known(self, raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """The places of different matches among the kept ones, after the library has been asked for those that are new."""
        sizes, keys = np.diff(offs), tx.byte_hashes(raw, offs)
        place = self.table.find(keys).astype(np.int64)
        here = np.flatnonzero(place >= 0)
        # a hash finds a match, its bytes decide
        here = here[self.raw_sizes[place[here]] == sizes[here]]
        if len(here):
            mine, ends = split.gather(raw, offs[here], sizes[here])
            kept, _ = split.gather(self.raw, self.raw_at[place[here]], sizes[here])
            here = here[~np.logical_or.reduceat(mine != kept, ends - sizes[here])]
        new = np.ones(len(sizes), bool)
        new[here] = False
        new = np.flatnonzero(new)
        if len(new):
            place[new] = len(self.used) + np.arange(len(new))
            some, ends = split.gather(raw, offs[new], sizes[new])
            self._learn(some, sizes[new], keys[new])
        return place

    def _learn(self, raw: np.ndarray, sizes: np.ndarray, keys: np.ndarray) -> None:
        """Asks the library for matches, all in one call, and keeps them."""
        ends = np.cumsum(sizes)
        points = np.full(len(raw) + len(sizes), _BETWEEN, np.uint32)
        here = np.ones(len(points), bool)
        here[np.cumsum(sizes + 1) - 1] = False
        points[here] = self.shown[raw]
        encoding = self.apart.encode_batch_fast([points.tobytes().decode("utf-32-le")], add_special_tokens=False)[0]
        ids = np.array(encoding.ids, np.uint32)
        reach = np.concatenate([[0], np.cumsum(self.lengths[ids])])
        cuts = np.searchsorted(reach, np.concatenate([[0], ends]))
        if reach[-1] != len(raw) or not np.array_equal(reach[cuts[1:]], ends):
            raise ValueError("the model does not give back the bytes of its matches")
        self.table.add(keys)
        self.raw_at, self.raw_sizes = np.concatenate([self.raw_at, ends - sizes + len(self.raw)]), np.concatenate([self.raw_sizes, sizes])
        self.raw = np.concatenate([self.raw, raw])
        self.at, self.sizes = np.concatenate([self.at, cuts[:-1] + len(self.flat)]), np.concatenate([self.sizes, np.diff(cuts)])
        self.flat = np.concatenate([self.flat, ids])
        self.used = np.concatenate([self.used, np.zeros(len(sizes), bool)])

    def _cut(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First byte and end of every match."""
        if self.classes is not None:
            start = split.matches(buf, offs, self.classes)
            return start, np.append(start[1:], len(buf))
        starts, ends = [], []
        raw = buf.tobytes()
        for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
            text = raw[a:b].decode()
            byte = np.concatenate([[0], np.cumsum([len(c.encode()) for c in text])]) + a if text else []
            for m in self.find(text):
                if m.end() > m.start():
                    starts.append(byte[m.start()])
                    ends.append(byte[m.end()])
        return np.array(starts, np.int64), np.array(ends, np.int64)

    def encode_column(self, column) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows joined, and the bounds of the rows; null counts as empty."""
        special = self._special(column)
        if special is not None:
            column = pc.if_else(special, pa.scalar("", column.type), column)
        buf, offs = tx.string_bytes(column)
        start, end = self._cut(buf, offs)
        if not len(start):
            ids, bounds = np.zeros(0, np.uint32), np.zeros(len(offs), np.int64)
        else:
            if len(start) > 1 and (start[1:] != end[:-1]).any():
                buf, ends = split.gather(buf, start, end - start)
                edges = np.append(0, ends)
            else:
                edges = np.append(start, end[-1])
            pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(buf))])
            coded = pieces.dictionary_encode()
            self._room()
            slot = self._known(*tx.string_bytes(coded.dictionary))
            self.used[slot] = True
            code = coded.indices.to_numpy()
            ids, ends = split.gather(self.flat, self.at[slot][code], self.sizes[slot][code])
            bounds = np.append(0, ends)[np.searchsorted(start, offs)]
        if special is None:
            return ids, bounds
        # texts with strings of added tokens go to the library whole
        rows = np.flatnonzero(special.to_numpy(zero_copy_only=False))
        own = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(self._whole.take(pa.array(rows)).to_pylist(), add_special_tokens=False)]
        sizes, first = np.diff(bounds), bounds[:-1].copy()
        sizes[rows] = [len(x) for x in own]
        first[rows] = len(ids) + np.concatenate([[0], np.cumsum([len(x) for x in own])])[:-1]
        out, ends = split.gather(np.concatenate([ids, *own]), first, sizes)
        return out, np.append(0, ends)

    def _special(self, column):
        """Whether a row holds the string of an added token; None if no row does."""
        found = None
        for content in self.added:
            here = pc.fill_null(pc.match_substring(column, content), False)
            found = here if found is None else pc.or_(found, here)
        if found is None or not pc.any(found).as_py():
            return None
        self._whole = column
        return found

    def encode(self, text: str) -> np.ndarray:
        return self.encode_column(pa.array([text], pa.large_string()))[0]

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte ends, and first and last-plus-one characters of the tokens of a text."""
        ends = np.cumsum(self.lengths[ids])
        if not len(ends):
            return ends, ends, ends
        raw = np.frombuffer(text.encode(), np.uint8)
        character = np.cumsum((raw & 0xC0) != 0x80) - 1
        return ends, character[np.concatenate([[0], ends[:-1]])], character[ends - 1] + 1

    def decode_all(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of joined rows of ids, and the bounds of the rows."""
        out, ends = split.gather(self.joined, self.first[ids], self.lengths[ids])
        return out, np.append(0, ends)[bounds]

    def named(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The decimal ids of joined rows, each with a comma after it, and the bounds of the rows."""
        out, ends = split.gather(self.names, self.name_first[ids], self.name_lengths[ids])
        return out, np.append(0, ends)[bounds]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def decode_pieces(self, pieces) -> list[str]:
        """The text of consecutive pieces of ids; a character split over pieces comes with the later one."""
        step = codecs.getincrementaldecoder("utf-8")("replace")
        out = [step.decode(self.decode(ids)) for ids in pieces]
        return [*out[:-1], out[-1] + step.decode(b"", True)] if out else []


_LOADED: dict[tuple[int, str], Codec] = {}


def codec(source: tuple[str, bytes | None], pattern: str) -> Codec:
    """The codec of a tokenizers file's content and its classes, one per worker process."""
    key = hash(source), pattern
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Codec(source[0], pattern, source[1])
    return _LOADED[key]


#: bytes of text that are encoded together
SLICE = tx.PIECE


def _lists(values: np.ndarray, bounds: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, kind))


def _encode(source, pattern: str, offsets: bool):
    def run(batches):
        own = codec(source.value, pattern)
        for batch in batches:
            for part in tx.slices(batch, "text", SLICE):
                ids, bounds = own.encode_column(part.column(1))
                fields, names = [part.column(0), _lists(ids.astype(np.int32), bounds, pa.int32())], ["id", "ids"]
                if offsets:
                    spans = [own.spans(t or "", ids[a:b]) for t, a, b in zip(part.column(1).to_pylist(), bounds[:-1], bounds[1:], strict=True)]
                    for k, name in enumerate(("byte_end", "char_start", "char_end")):
                        fields.append(pa.array([s[k] for s in spans], pa.list_(pa.int64())))
                        names.append(name)
                yield pa.RecordBatch.from_arrays(fields, names)

    return tx.released(run)


def _decode(source, pattern: str):
    def run(batches):
        own = codec(source.value, pattern)
        for batch in batches:
            raw = [own.decode(i or ()) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(raw, pa.binary()), pa.array([r.decode("utf-8", "replace") for r in raw], pa.string())], ["id", "bytes", "text"]
            )

    return tx.released(run)


def sources(spark: SparkSession, ranks_path: str, pattern: str):
    """The model of a file of ranks, with the classes of the library that such files are made for."""
    ship(spark)
    classes = split.tiktoken_classes().tobytes() if pattern == split.PATTERN else None
    out = spark.sparkContext.broadcast((model_json(read_ranks(ranks_path), pattern), classes))
    tx.release()
    return out


def file_source(spark: SparkSession, tokenizer_path: str, pattern: str):
    """The model of a tokenizers file, with the classes of the tokenizers library."""
    ship(spark)
    classes = split.library_classes().tobytes() if pattern == split.PATTERN else None
    with open(tokenizer_path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast((f.read(), classes))


def encode(docs: DataFrame, ranks_path: str, pattern: str, offsets: bool = False, id_col="doc_id", text_col="text") -> DataFrame:
    """(id, ids array<int>), with offsets also byte_end, char_start and char_end arrays."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    more = ", byte_end array<long>, char_start array<long>, char_end array<long>" if offsets else ""
    return rows.mapInArrow(_encode(sources(docs.sparkSession, ranks_path, pattern), pattern, offsets), "id long, ids array<int>" + more)


def decode(tokens: DataFrame, ranks_path: str, pattern: str, id_col="id", ids_col="ids") -> DataFrame:
    """(id, bytes, text) of arrays of ids; text has U+FFFD where the bytes are no UTF-8."""
    rows = tokens.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(_decode(sources(tokens.sparkSession, ranks_path, pattern), pattern), "id long, bytes binary, text string")


def _digests(source, pattern: str, with_ids: bool):
    """Encodes and decodes; without ids only counts and digests leave the worker."""

    def run(batches):
        own = codec(source.value, pattern)
        for batch in batches:
            for part in tx.slices(batch, "text", SLICE):
                ids, bounds = own.encode_column(part.column(1))
                shown, at = own.named(ids, bounds)
                # without the comma after the last one
                ids_sha = [hashlib.sha256(shown[a : max(a, b - 1)]).hexdigest() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                raw, at = own.decode_all(ids, bounds)
                text_sha = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                fields = [part.column(0), pa.array(np.diff(bounds)), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    fields.append(_lists(ids.astype(np.int32), bounds, pa.int32()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(fields, names)

    return tx.released(run)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col="doc_id", text_col="text", ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row, and its ids if asked for."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_digests(sources(docs.sparkSession, ranks_path, pattern), pattern, ids), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
