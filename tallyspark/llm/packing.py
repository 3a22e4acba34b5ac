"""Cost-balanced packing of tokenized documents into sequences.

Documents are dealt evenly into blocks of bounded text by a hash; one task
tokenizes a block and packs it.  Full sequences are cut off long documents;
the rest is assigned in descending length to the sequence of lowest estimated
cost (linear plus quadratic attention cost of each piece) that has room.  The
number of sequences is the least that can hold the block, so a document that
fits nowhere whole is cut to fill the roomiest sequence, and at most one
sequence's worth of padding is left per block.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
from array import array
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm import common

SEQUENCE = 4096
TOKENIZER = "word_bpe_49k.json"
END_ID = 2
#: Target UTF-8 bytes of a block's texts.
BLOCK_BYTES = 8 << 20
ROW_BYTES = 64
#: cost(n) = LINEAR * n + QUADRATIC * n * n
LINEAR, QUADRATIC = 1.0, 1.0 / 1024
#: How many words of up to WORD_BYTES a worker remembers the ids of, how many
#: bytes of whole texts it splits at a time, and how many words' ids it lines up.
CACHE_WORDS, WORD_BYTES, LEARN_BYTES, LINE_WORDS = 600_000, 48, 4 << 20, 1 << 16
#: Words that the tokenizer is given as one text; both shorter and longer texts
#: cost it more a word.
JOINED = 128
#: With these parts a tokenizer does not tell case apart, and takes letters and
#: the signs after them each by themselves.
CASELESS = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    "post_processor": None}
#: Lower-case ASCII and Latin-1 letters, then ASCII signs up to the end.
LETTERS_SIGNS = re.compile(rb"((?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+)([!-/:-@\[-`{-~]*)")

PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


class WordEncoder:
    """Ids of whole texts.  The tokenizer drops white space and never joins
    what it separates, so a text's ids are its words' ids one after another.
    Texts are split into words some at a time, and each distinct word is looked
    up once: ids of words seen before come from a bounded cache, new words are
    encoded many in a text and told apart by offset.  The cache has two halves:
    when the younger is full it becomes the older, whose words are forgotten
    unless they are met again.

    Where the tokenizer allows it (``CASELESS``), A-Z are lowered first and
    letters are encoded without the signs after them, so fewer words are new;
    letters are told apart by the ids that end a word, without offsets."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        parts = json.loads(self.tokenizer.to_str())
        suffix = parts["model"].get("end_of_word_suffix")
        self.caseless = (bool(suffix) and {k: parts[k] for k in CASELESS} == CASELESS
                         and all(t["content"].startswith("<|") for t in parts["added_tokens"]))
        if self.caseless:
            vocabulary = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _lower(self, text: bytes) -> bytes:
        """``text`` with A-Z lowered, unless that might change its ids: an added
        token is told from its upper case, and some marks (U+0300 to U+037F)
        combine with small letters only."""
        if not self.caseless or b"<|" in text or b"\xcc" in text or b"\xcd" in text:
            return text
        return text.lower()

    def _ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words."""
        known, older, passing = self.known, self.older, {}
        letters, other, cut = set(), set(), []
        for word in words:
            if word in known:
                continue
            if (ids := older.get(word)) is not None:
                known[word] = ids
            elif not self.caseless or len(word) > WORD_BYTES or not (m := LETTERS_SIGNS.fullmatch(word)):
                other.add(word)
            elif m[2]:
                cut.append((word, m[1], m[2]))
            else:
                letters.add(word)
        for _, stem, signs in cut:
            for part, new in (stem, letters), (signs, other):
                if part not in known:
                    if (ids := older.get(part)) is not None:
                        known[part] = ids
                    else:
                        new.add(part)
        self._encode_letters(list(letters))
        self._encode([w for w in other if len(w) <= WORD_BYTES], known)
        self._encode([w for w in other if len(w) > WORD_BYTES], passing)
        for word, stem, signs in cut:
            passing[word] = known[stem] + known[signs]
        out = [passing[w] if (ids := known.get(w)) is None else ids for w in words]
        if 2 * len(known) > CACHE_WORDS:
            self.known, self.older = {}, known
        return out

    def _encode_letters(self, words: list[bytes]) -> None:
        for at in range(0, len(words), JOINED):
            part = words[at:at + JOINED]
            got = self.tokenizer.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)
            ids, first = np.array(got[0].ids, "<u4"), 0
            ends = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            if len(ends) != len(part):  # the vocabulary lacks a letter at a word's end
                self._encode(part, self.known)
                continue
            ids = ids.tobytes()
            for word, last in zip(part, ends, strict=True):
                self.known[word] = ids[first:last]
                first = last

    def _encode(self, words: list[bytes], into: dict[bytes, bytes]) -> None:
        for at in range(0, len(words), JOINED):
            part = words[at:at + JOINED]
            texts = [w.decode() for w in part]
            got = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            starts, ids = [o[0] for o in got.offsets], array("I", got.ids)  # quicker than an ndarray for a few ids
            if sys.byteorder == "big":
                ids.byteswap()
            ids, first, end = ids.tobytes(), 0, 0
            for word, text in zip(part, texts, strict=True):
                end += len(text) + 1
                last = bisect_left(starts, end, first)
                into[word] = ids[4 * first:4 * last]
                first = last

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, without END_ID."""
        out, at = [], 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and size < LEARN_BYTES:  # whole texts, some at a time
                size += len(texts[stop])
                stop += 1
            split = pc.ascii_split_whitespace(
                pa.array([self._lower(t) for t in texts[at:stop]], pa.binary()).view(pa.string()))
            words = split.flatten().view(pa.binary()).dictionary_encode()
            ids = self._ids(words.dictionary.to_pylist())
            flat = np.frombuffer(b"".join(ids), "<u4")
            n = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            first, kind = np.cumsum(n) - n, words.indices.to_numpy()
            end = np.r_[0, np.cumsum(n[kind])]  # of each word, in the ids of all texts
            line = np.empty(end[-1], "<u4")
            for a in range(0, len(kind), LINE_WORDS):
                k = kind[a:a + LINE_WORDS]
                start, stop_at = end[a], end[a + len(k)]
                line[start:stop_at] = flat[np.repeat(first[k] - end[a:a + len(k)], n[k]) + np.arange(start, stop_at)]
            ends = end[split.offsets.to_numpy()].tolist()
            out += [line[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            at = stop
        return out


def encoder(path: str) -> WordEncoder:
    """This worker's encoder: kept between tasks, so its words are too."""
    kept = sys.modules.setdefault("tallyspark.llm._encoders", type(sys)("tallyspark.llm._encoders"))
    if not hasattr(kept, "by_path"):
        kept.by_path = {}
    if path not in kept.by_path:
        kept.by_path[path] = WordEncoder(path)
    return kept.by_path[path]


def cost(n: int) -> float:
    return LINEAR * n + QUADRATIC * n * n


def pack(lengths: list[int], size: int) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece."""
    out, rest, used = [], [], 0
    for doc, n in enumerate(lengths):
        for start in range(0, n - n % size, size):
            out.append((doc, start, size, used, 0))
            used += 1
        if n % size:
            rest.append((-(n % size), doc, n - n % size))
    k = -(-sum(-r[0] for r in rest) // size)
    room, load = np.full(k, size), np.zeros(k)
    heapq.heapify(rest)
    while rest:
        n, doc, start = heapq.heappop(rest)
        n = -n
        fits = room >= n
        if fits.any():
            s, take = int(np.where(fits, load, np.inf).argmin()), n
        else:
            s = int(room.argmax())
            take = int(room[s])
            heapq.heappush(rest, (take - n, doc, start + take))
        out.append((doc, start, take, used + s, int(size - room[s])))
        room[s] -= take
        load[s] += cost(take)
    return out


def pack_documents(docs: DataFrame, size: int = SEQUENCE, tokenizer: str | None = None,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The pieces (see ``PIECES``) of all ``docs`` (doc_id, text); ``ids`` are
    the piece's token ids, little-endian unsigned 32-bit.

    A null or empty text is the single id END_ID.  Repeated rows are packed
    each; a null doc_id stays null.  Sequence ids are unique, not gapless.
    ``tokenizer`` is the path of a vocabulary file (default: the public one)."""
    if tokenizer is None:
        import public_tokenizers
        tokenizer = public_tokenizers.path(TOKENIZER)
    common.ready(docs.sparkSession)
    rows = common.with_identity(
        docs, F.col("doc_id").cast("long").alias("doc_id"),
        common.text_or_empty(F.col("text").cast("string")).cast("binary").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text").cast("long") + ROW_BYTES)).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    rows = rows.withColumn("block", common.spread(blocks, "__f", "__r"))

    def pack_block(key, table):
        table = table.sort_by([("__f", "ascending"), ("__r", "ascending")])
        end = np.array([END_ID], "<u4").tobytes()
        doc_ids = table.column("doc_id").to_pylist()
        ids = encoder(tokenizer).encode(table.column("text").to_pylist())
        ids = [x + end for x in ids]
        first = key[0].as_py() << 32
        pieces = pack([len(x) // 4 for x in ids], size)
        long = pa.int64()
        return pa.table({
            "doc_id": pa.array([doc_ids[p[0]] for p in pieces], long),
            "start": pa.array([p[1] for p in pieces], long), "length": pa.array([p[2] for p in pieces], long),
            "ids": pa.array([ids[p[0]][4 * p[1]:4 * (p[1] + p[2])] for p in pieces], pa.binary()),
            "doc_tokens": pa.array([len(ids[p[0]]) // 4 for p in pieces], long),
            "sequence_id": pa.array([first + p[3] for p in pieces], long),
            "offset": pa.array([p[4] for p in pieces], long)})

    return rows.groupBy("block").applyInArrow(pack_block, PIECES)


def piece_digest(docs: DataFrame) -> DataFrame:
    """The contract's row per piece."""
    return pack_documents(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                                       "doc_tokens", "sequence_id", "offset")
