"""Token ids in shard files, every document its own zstandard frame.

One dictionary is trained on the serialized id arrays of a bounded sample of
short documents and shared by all files: a short document then compresses
nearly as well as in a long stream, and is still read alone.  A file holds the
frames of consecutive documents (ascending doc_id), an index of frame offsets
and token counts, and a footer with the dictionary's SHA-256, so that a reader
finds one document without touching the others and never decodes with another
dictionary.

The texts are read once and not shuffled; only their frames are, by ranges of
(doc_id, place in the input), so a doc_id shared by very many rows is cut as
well.  A file ends at ``FILE_BYTES``: a task holds one file and one document,
whatever the table holds.  Files are written by Spark's text writer, so any
file system and a lost executor's retry are covered by its commit protocol.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import struct
import sys
import zlib
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import common
from tallyspark.operators.ordered import running_total
from tallyspark.operators.sizing import lookup_join
from tallyspark.session import scratch_path

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
#: The dictionary's size, and the documents it is trained on: that many, of
#: that many text bytes at most.
DICTIONARY_BYTES, TRAIN_DOCS, TRAIN_TEXT_BYTES = 112_640, 1000, 16_384
LEVEL = 3
#: Compressed bytes at which a file ends, and of a range of the shuffle.
FILE_BYTES, RANGE_BYTES = 8 << 20, 32 << 20
#: Text bytes tokenized together, pieces a worker remembers the ids of (in two
#: halves), and the longest piece it remembers, in bytes.
LEARN_BYTES, CACHE_PIECES, PIECE_BYTES = 4 << 20, 800_000, 32
#: The only tokenizers whose texts are cut; those of others stay whole.
BYTE_LEVEL = {"normalizer": None, "post_processor": None, "pre_tokenizer": {
    "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}}
#: What a byte of UTF-8 belongs to: an unknown character that is no white space;
#: letters, digits, signs; a space, other white space of one byte; the first and
#: other bytes of longer white space; a byte that goes by the one before it.
UNKNOWN, LETTER, DIGIT, SIGN, QUOTE, SPACE, BLANK, WIDE, WIDE_REST, REST = range(10)
KINDS = np.full(256, UNKNOWN, np.uint8)
KINDS[:128] = [DIGIT if 48 <= c <= 57 else LETTER if chr(c).isalpha() else SPACE if c == 32 else
               BLANK if 9 <= c <= 13 else QUOTE if c == 39 else SIGN for c in range(128)]
KINDS[0x80:0xC0] = REST
KINDS[[*range(0xC3, 0xCA), 0xD0, 0xD1]] = LETTER  # U+00C0 to U+027F and U+0400 to U+047F, but TIMES
TIMES = ("\u00d7".encode(), "\u00f7".encode())
#: White space beyond ASCII, by its first byte.
WIDE_SPACES = {first: [s.encode() for s in some] for first, some in (
    (0xC2, "\u0085\u00a0"), (0xE1, "\u1680"), (0xE3, "\u3000"),
    (0xE2, [*map(chr, range(0x2000, 0x200B)), *"\u2028\u2029\u202f\u205f"]))}


def _cut_table() -> np.ndarray:
    """Of a byte's kind and the next one's (10 x kind + kind): 1 where the
    tokenizer never joins, 2 where it does not if no white space follows."""
    out = np.zeros(100, np.uint8)
    for a in (UNKNOWN, LETTER, DIGIT, SIGN, QUOTE, REST):
        out[[10 * a + b for b in (SPACE, BLANK, WIDE)]] = 1
    for a in (SPACE, BLANK, WIDE_REST):
        out[[10 * a + b for b in (SPACE, BLANK)]] = 2
    out[[10 * BLANK + b for b in (UNKNOWN, LETTER, DIGIT, SIGN, QUOTE)]] = 1
    for a, some in ((LETTER, (DIGIT, SIGN, QUOTE)), (DIGIT, (LETTER, SIGN, QUOTE)), (SIGN, (LETTER, DIGIT)),
                    (QUOTE, (DIGIT,))):  # a quote may join the letters after it
        out[[10 * a + b for b in some]] = 1
    return out


CUTS = _cut_table()
#: Pieces the tokenizer does not cut: known letters, digits or ASCII signs, after
#: one space or none.
ALONE = re.compile(rb" ?(?:[A-Za-z]*(?:(?:\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|[\xc4-\xc9\xd0\xd1][\x80-\xbf])"
                   rb"[A-Za-z]*)*|[0-9]+|[!-&(-/:-@\[-`{-~]+)(?<! )")
#: How byte-level vocabularies write each byte, those that are not printed by
#: letters from U+0100 on; a line break stays, as it ends a piece here.
HIDDEN = [*range(33), *range(127, 161), 173]
WRITTEN = "".join(chr(b if b == 10 or b not in HIDDEN else 256 + HIDDEN.index(b)) for b in range(256))

MAGIC = b"TALLYIDS"
#: First row's (doc_id is null, doc_id, file, row), dictionary SHA-256, bytes
#: an id, rows, index offset, CRC-32 of the index, magic.
FOOTER = struct.Struct("<4q32sIQQI8s")
#: The text writer ends every file with it.
FILE_END = b"\n"
SHARD = ("s_none", "s_doc", "s_f", "s_r")
FRAMES = "doc_id long, __f long, __r long, tokens long, size long, frame binary"


def cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where pieces of the texts that begin at ``starts`` of ``data`` (UTF-8)
    begin: at places where the tokenizer joins nothing, whatever else the text
    holds.  These are the ends of letters, of digits and of signs that known
    characters follow, the start of white space, and its last character."""
    kind = KINDS[data]
    rest = np.flatnonzero(kind == REST)
    if len(rest):
        kind[rest] = kind[rest - 1]  # right after the first byte; later ones stay REST or get UNKNOWN
        for char in TIMES:
            at = rest[(data[rest] == char[1]) & (data[rest - 1] == char[0])]
            kind[at - 1] = kind[at] = UNKNOWN
        for first, chars in WIDE_SPACES.items():
            at = np.flatnonzero(data == first)
            for char in chars if len(at) else ():
                found = at[at + len(char) <= len(data)]
                for i in range(1, len(char)):
                    found = found[data[found + i] == char[i]]
                kind[found] = WIDE
                for i in range(1, len(char)):
                    kind[found + i] = WIDE_REST
    first = np.zeros(len(data) + 1, bool)
    first[starts] = True
    first[-1] = True
    rule, begins = CUTS[kind[:-1] * 10 + kind[1:]], first[:-1].copy()
    begins[1:] |= rule == 1
    last = np.flatnonzero(rule == 2) + 1  # white space after white space
    last = last[~first[last + 1]]
    begins[last[kind[last + 1] < SPACE]] = True
    return np.flatnonzero(begins)


class PieceEncoder:
    """Ids of whole texts with a byte-level tokenizer.  Ids of a text are those
    of its pieces one after another.  Texts are cut some at a time, and each
    distinct piece is looked up once: those seen before come from a bounded
    cache of two halves: when the newer one is full it becomes the older one,
    out of which pieces that come up again are taken over.  Texts with a special
    token's string, and all texts of a tokenizer of another kind, go to the
    tokenizer whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.type = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.marks = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        parts = json.loads(self.tokenizer.to_str())
        self.cut = {k: parts[k] for k in BYTE_LEVEL} == BYTE_LEVEL
        self.model = self.tokenizer.model
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _bytes(self, ids: list[int]) -> bytes:
        out = array(self.type.char, ids)  # quicker than an ndarray for a few ids
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _ids(self, text: str) -> bytes:
        return self._bytes(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids)

    def _learn(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of new pieces.  Those that the tokenizer does not cut go right to
        its model, others to the whole tokenizer."""
        alone = list(filter(ALONE.fullmatch, pieces)) if self.cut else []
        texts = codecs.charmap_decode(b"\n".join(alone), "strict", WRITTEN)[0].split("\n")
        found = {p: self._bytes([t.id for t in self.model.tokenize(text)])
                 for p, text in zip(alone, texts, strict=False)}  # no piece leaves one empty text
        return [self._ids(p.decode()) if (ids := found.get(p)) is None else ids for p in pieces]

    def _look_up(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of distinct pieces."""
        known, older, new = self.known, self.older, []
        out = list(map(known.get, pieces))
        for i in [i for i, ids in enumerate(out) if ids is None]:
            if (ids := older.get(p := pieces[i])) is None:
                new.append(i)
            else:
                known[p] = out[i] = ids
        made = [pieces[i] for i in new]
        for i, p, ids in zip(new, made, self._learn(made), strict=True):
            out[i] = ids
            if len(p) <= PIECE_BYTES:
                known[p] = ids
        if 2 * len(known) > CACHE_PIECES:
            self.known, self.older = {}, known
        return out

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Little-endian ids of each text as ``self.type``, END_ID included."""
        texts = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).cast(pa.large_binary())
        end = np.array([END_ID], self.type).tobytes()
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        if not len(texts) or offsets[0] == offsets[-1]:
            return [end] * len(texts)
        held = texts.buffers()[2].slice(offsets[0], offsets[-1] - offsets[0])
        data, offsets = np.frombuffer(held, np.uint8), offsets - offsets[0]
        begins = cuts(data, offsets[:-1]) if self.cut else np.unique(offsets[:-1][offsets[:-1] < len(data)])
        for a, b in self._marked(held, offsets):
            begins = begins[(begins <= a) | (begins >= b)]
        found = pa.Array.from_buffers(pa.large_binary(), len(begins), [
            None, pa.py_buffer(np.append(begins, len(data)).astype(np.int64)), held]).dictionary_encode()
        ids = self._look_up(found.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = pa.array(ids, pa.large_binary()).take(found.indices)
        upto = np.frombuffer(ids.buffers()[1], np.int64)[np.searchsorted(begins, offsets)].tolist()
        line = memoryview(ids.buffers()[2])
        return [b"".join((line[a:b], end)) for a, b in zip(upto[:-1], upto[1:], strict=True)]

    def _marked(self, held: pa.Buffer, offsets: np.ndarray) -> list[tuple[int, int]]:
        """Start and end of each text with a special token's string."""
        data = held.to_pybytes()
        return [(a, b) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
                if any(data.find(m, a, b) >= 0 for m in self.marks)] if any(m in data for m in self.marks) else []


def encoder(path: str) -> PieceEncoder:
    """This worker's encoder: kept between tasks, so its pieces are too."""
    kept = sys.modules.setdefault("tallyspark.llm._piece_encoders", type(sys)("tallyspark.llm._piece_encoders"))
    if not hasattr(kept, "by_path"):
        kept.by_path = {}
    if path not in kept.by_path:
        kept.by_path[path] = PieceEncoder(path)
    return kept.by_path[path]


def in_slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """``batch`` cut where the strings of ``column`` pass ``limit`` bytes."""
    sizes = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = sizes[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(sizes, before + limit)))
        yield batch.slice(at, stop - at)
        at = stop


@dataclass(frozen=True)
class Dictionary:
    """What all files of an archive share; empty when there was no sample."""
    content: bytes

    @property
    def digest(self) -> bytes:
        return hashlib.sha256(self.content).digest()

    def _data(self):
        return zstandard.ZstdCompressionDict(self.content) if self.content else None

    def compressor(self, level: int = LEVEL):
        return zstandard.ZstdCompressor(level=level, dict_data=self._data(), write_content_size=True)

    def decompressor(self):
        return zstandard.ZstdDecompressor(dict_data=self._data())


def train_on(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary of at most ``size`` bytes for serialized id arrays; too few
    samples to train on are taken as its content; none: no dictionary."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def train(rows: DataFrame, tokenizer: str, size: int = DICTIONARY_BYTES, docs: int = TRAIN_DOCS,
          text_bytes: int = TRAIN_TEXT_BYTES, seed: int = 1) -> Dictionary:
    """The dictionary of ``rows`` (text, __f, __r): trained by one task on at
    most ``docs`` documents of at most ``text_bytes`` each."""
    short = rows.where(F.octet_length("text") <= text_bytes).select(
        F.xxhash64(F.lit(seed), "__f", "__r").alias("h"), "__f", "__r", "text")
    sample = common.smallest(short, docs, "h", "__f", "__r").select("text").coalesce(1)

    def run(batches):
        samples = [x for b in batches for x in encoder(tokenizer).encode(b.column(0))]
        if samples:
            yield pa.RecordBatch.from_pydict({"content": [train_on(samples, size)]})

    got = sample.mapInArrow(run, "content binary").collect()
    return Dictionary(bytes(got[0].content) if got else b"")


def frames(rows: DataFrame, tokenizer: str, dictionary: Dictionary) -> DataFrame:
    """``FRAMES`` of ``rows`` (doc_id, __f, __r, text): every document encoded
    and compressed by itself."""
    def run(batches):
        encode, pack = encoder(tokenizer), dictionary.compressor()
        for batch in batches:
            for part in in_slices(batch, "text", LEARN_BYTES):
                ids = encode.encode(part.column("text"))
                packed = [pack.compress(x) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("doc_id", "__f", "__r")),
                     pa.array([len(x) // encode.type.itemsize for x in ids], pa.int64()),
                     pa.array([len(x) for x in packed], pa.int64()), pa.array(packed, pa.binary())],
                    ["doc_id", "__f", "__r", "tokens", "size", "frame"])

    return rows.select("doc_id", "__f", "__r", "text").mapInArrow(run, FRAMES)


def file_bytes(rows: list[tuple], digest: bytes, width: int) -> bytes:
    """One file: the frames of ``rows`` (doc_id, f, r, tokens, frame), the index
    (ids, which of them are not null, frame offsets, token counts), the footer."""
    ids = [r[0] for r in rows]
    body = b"".join(r[4] for r in rows)
    index = b"".join([np.array([i or 0 for i in ids], "<i8").tobytes(),
                      np.array([i is not None for i in ids], "u1").tobytes(),
                      np.cumsum([0, *(len(r[4]) for r in rows)]).astype("<u8").tobytes(),
                      np.array([r[3] for r in rows], "<u8").tobytes()])
    first = (int(ids[0] is None), ids[0] or 0, rows[0][1], rows[0][2])
    return body + index + FOOTER.pack(*first, digest, width, len(rows), len(body), zlib.crc32(index), MAGIC)


def open_file(data: memoryview, digest: bytes):
    """(shard key, id type, ids, known, offsets, token counts) of one file."""
    *first, made_with, width, n, at, crc, magic = FOOTER.unpack(data[-FOOTER.size:])
    if magic != MAGIC:
        raise ValueError("not a file of token ids")
    if made_with != digest:
        raise ValueError(f"dictionary {digest.hex()} given, {made_with.hex()} needed")
    index = data[at:len(data) - FOOTER.size]
    if zlib.crc32(index) != crc:
        raise ValueError("the index does not match its checksum")
    cut = np.cumsum([0, 8 * n, n, 8 * (n + 1), 8 * n])
    ids, known, offsets, counts = (np.frombuffer(index[a:b], t) for a, b, t in
                                   zip(cut[:-1], cut[1:], ("<i8", "u1", "<u8", "<u8"), strict=True))
    return tuple(first), np.dtype(f"<u{width}"), ids, known.astype(bool), offsets, counts


def write(docs: DataFrame, path: str, tokenizer: str | None = None, file_limit: int = FILE_BYTES,
          range_bytes: int = RANGE_BYTES) -> Dictionary:
    """Writes the token ids of all ``docs`` (doc_id, text) below ``path``:
    ``dictionary`` (one row: sha256, content) and ``shards`` (the files).

    Documents lie in ascending doc_id order, null ids last, repeated ids in
    input order.  A null or empty text is the single id END_ID; a very long one
    makes its file longer than ``file_limit``.  Other columns are ignored; an
    empty table has a dictionary row and no file.  ``tokenizer`` is the path of
    a vocabulary file (default: the public one)."""
    if tokenizer is None:
        import public_tokenizers
        tokenizer = public_tokenizers.path(TOKENIZER)
    spark = common.ready(docs.sparkSession)
    rows = common.with_identity(docs, F.col("doc_id").cast("long").alias("doc_id"),
                                common.text_or_empty(F.col("text").cast("string")).alias("text"))
    dictionary = train(rows, tokenizer)
    (spark.createDataFrame([(dictionary.digest.hex(), dictionary.content)], "sha256 string, content binary")
     .coalesce(1).write.parquet(f"{path}/dictionary"))
    made = common.stored(frames(rows, tokenizer, dictionary), "token-frames")
    total = made.agg(F.sum("size")).first()[0] or 0
    ranges = max(1, -(-total // range_bytes))
    order = [F.col("doc_id").isNull(), "doc_id", "__f", "__r"]
    digest = dictionary.digest

    def pack(batches):
        width, held, size = encoder(tokenizer).type.itemsize, [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "__f", "__r", "tokens", "frame")),
                           strict=True):
                held.append(row)
                size += len(row[4])
                if size >= file_limit:
                    yield pa.RecordBatch.from_pydict({"value": [file_bytes(held, digest, width)]})
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pydict({"value": [file_bytes(held, digest, width)]})

    files = made.repartitionByRange(ranges, *order).sortWithinPartitions(*order).mapInArrow(pack, "value binary")
    (files.select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 1)
     .option("lineSep", FILE_END.decode()).text(f"{path}/shards"))
    return dictionary


def stored_dictionary(spark: SparkSession, path: str) -> Dictionary:
    row = spark.read.schema("sha256 string, content binary").parquet(f"{path}/dictionary").first()
    found = Dictionary(bytes(row.content))
    if found.digest.hex() != row.sha256:
        raise ValueError("the dictionary does not match its SHA-256")
    return found


def read(spark: SparkSession, path: str, doc_ids: Sequence[int] | None = None, with_ids: bool = True) -> DataFrame:
    """One row per document of the files below ``path``: its shard's key, its
    place there (``slot``), doc_id, ``before`` (ids before it in its shard),
    ``tokens``, ``ids_crc32`` and, ``with_ids``, ``ids`` (little-endian unsigned
    32-bit).  With ``doc_ids`` only their frames are decompressed."""
    common.ready(spark)
    dictionary = stored_dictionary(spark, path)
    wanted = None if doc_ids is None else np.unique(np.array(list(doc_ids), np.int64))
    out = [*SHARD, "slot", "doc_id", "before", "tokens", "ids_crc32"]
    schema = ", ".join(f"{c} long" for c in out) + (", ids binary" if with_ids else "")

    def run(batches):
        unpack = dictionary.decompressor()
        for batch in batches:
            for content in batch.column(0):
                data = memoryview(content.as_buffer())[:-len(FILE_END)]
                key, kind, ids, known, offsets, counts = open_file(data, dictionary.digest)
                before = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
                take = np.arange(len(ids)) if wanted is None else np.flatnonzero(known & np.isin(ids, wanted))
                for at in range(0, len(take), 256):
                    part = take[at:at + 256]
                    whole = [np.frombuffer(unpack.decompress(data[offsets[i]:offsets[i + 1]]), kind)
                             .astype("<u4").tobytes() for i in part]
                    if any(len(w) != 4 * counts[i] for i, w in zip(part, whole, strict=True)):
                        raise ValueError("a document has another length than its index states")
                    columns = [*(np.full(len(part), k) for k in key), part, pa.array(ids[part], mask=~known[part]),
                               before[part], counts[part].astype(np.int64), [zlib.crc32(w) for w in whole]]
                    arrays = [pa.array(c, pa.int64()) if not isinstance(c, pa.Array) else c for c in columns]
                    yield pa.RecordBatch.from_arrays(arrays + ([pa.array(whole, pa.binary())] if with_ids else []),
                                                     out + (["ids"] if with_ids else []))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/shards")
    return files.select("content").mapInArrow(run, schema)


def with_starts(records: DataFrame) -> DataFrame:
    """``records`` (all rows of ``read``) plus ``start``: the ids of all
    documents before it in the archive.  Only one row per file is ordered, by a
    distributed running sum."""
    shards = records.groupBy(*SHARD).agg(F.sum("tokens").cast("long").alias("own"))
    upto = running_total(shards, list(SHARD), "own", "upto").select(
        *[F.col(c).alias(f"_{c}") for c in SHARD], (F.col("upto") - F.col("own")).alias("first"))
    on = [F.col(c) == F.col(f"_{c}") for c in SHARD]
    joined = lookup_join(records, upto, on, max_rows=200_000)
    return joined.select(*records.columns, (F.col("first") + F.col("before")).alias("start"))


def archive_digest(docs: DataFrame) -> DataFrame:
    """The contract's row per document, from files written and read back."""
    spark = common.ready(docs.sparkSession)
    path = scratch_path(spark, "token-ids")
    write(docs, path)
    records = common.stored(read(spark, path, with_ids=False), "token-records")
    return with_starts(records).select("doc_id", "start", F.col("tokens").alias("n_tokens"), "ids_crc32")
