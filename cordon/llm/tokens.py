"""Token ids in binary files, Simple-8b coded (operator 7).

Documents are range-partitioned by id and sorted, so every task holds one run of the global order (a
shard).  A task encodes its texts and writes chunks of whole documents: Simple-8b words, words per block,
escapes, document ids and lengths, and how many ids of the shard come before.  The files are Parquet with
binary columns, written by Spark, so they go wherever Spark writes and a lost executor only costs a retry.
``read_documents`` decodes chunks in parallel; where a document starts in the whole stream follows from
the shards' totals, one row per shard.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cordon.llm import simple8b
from cordon.llm.idcache import KnownIds, Recent, gather, worker_cache
from cordon.llm.wordhash import pieces, prefix_hash, span_hash, word_spans

CHUNK_IDS = 1 << 16
KEPT = 150_000  # parts of words in the younger half of a cache

FILE_SCHEMA = ("shard int, chunk int, first_id bigint, n_ids bigint, words binary, block_words binary, escape_at binary, "
               "escape_value binary, doc_ids array<bigint>, doc_sizes array<bigint>")

#: characters whose lower case and class no Unicode version disputes and that NFC leaves alone
_PLAIN = "a-zß-öø-ň"
_SAFE = re.compile("[\x21-\x7eÀ-ÖØ-öø-įĲ-ň]*")


class Encoder:
    """Encodes many texts with a public tokenizer's file.

    If its pre-tokenizer drops white space, what stands between two spaces encodes alike everywhere, so
    each distinct string is encoded once and its ids are looked up.  Strings are known by two 64-bit
    hashes; should two of a piece share the first, the piece is encoded text by text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        norm = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        split = (pre[0].get("pattern") or {}).get("Regex", "")
        known = split == r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+" and pre[0].get("invert") is True
        self.by_word = bool(known and norm == ["NFC", "Replace", "Lowercase"] and not spec.get("post_processor"))
        self.parts = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_PLAIN}]+|[0-9]|[^\s0-9{_PLAIN}]+")
        # the byte-level alphabet: printable bytes stand for themselves, the others for 256 and up
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in set(plain)]
        self.alphabet = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.words, self.of_part = KnownIds(1_000_000), Recent(KEPT)

    def _part(self, part: str) -> bytes:
        found = self.of_part.get(part)
        if found is None:
            raw = part if part.isascii() else part.encode().decode("latin-1").translate(self.alphabet)
            found = np.array([t.id for t in self.tokenizer.model.tokenize(raw)], "<u4").tobytes()
            self.of_part.put(part, found)
        return found

    def _word(self, raw: bytes) -> bytes:
        word = raw.decode()
        if _SAFE.fullmatch(word) and "<|" not in word:
            return b"".join(map(self._part, self.parts.findall(word.lower())))
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(ids, ids per text)`` of consecutive pieces of the batch."""
        for lo, hi, data, offsets in pieces(texts):
            out = self._by_word(data, offsets) if self.by_word else None
            if out is None:
                plain = [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:])]
                encoded = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(plain, add_special_tokens=False)]
                out = np.concatenate(encoded), np.array([len(e) for e in encoded], np.int64)
            yield out

    def _by_word(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        doc, start, stop = word_spans(data, offsets)
        n_docs = len(offsets) - 1
        if len(start) == 0:
            return np.zeros(0, np.uint32), np.zeros(n_docs, np.int64)
        code, distinct = pd.factorize(span_hash(prefix_hash(data), start, stop))
        where = np.empty(len(distinct), np.int64)
        where[code[::-1]] = np.arange(len(code) - 1, -1, -1)
        other = span_hash(prefix_hash(data, 1), start, stop, 1)
        if not np.array_equal(other, other[where][code]):
            return None
        raw, a, b = data.tobytes(), start[where].tolist(), stop[where].tolist()
        pool, begin, sizes = self.words.ids_of(distinct, other[where], lambda new: [self._word(raw[a[i]:b[i]]) for i in new.tolist()])
        size = sizes[code]
        ids = gather(pool, begin[code], size)
        per_doc = np.bincount(doc, weights=size, minlength=n_docs).astype(np.int64)
        return ids, per_doc


_ENCODERS: dict[str, Encoder] = worker_cache()


def encoder(path: str) -> Encoder:
    """One per Python worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _chunk(shard: int, number: int, first: int, ids: list[np.ndarray], doc_ids: list, sizes: list[int]) -> dict:
    every = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    words, per_block, at, value = simple8b.encode(every)
    return {"shard": shard, "chunk": number, "first_id": first, "n_ids": len(every), "words": words.astype("<u8").tobytes(),
            "block_words": per_block.astype("<u2").tobytes(), "escape_at": at.astype("<u4").tobytes(),
            "escape_value": value.astype("<u8").tobytes(), "doc_ids": doc_ids, "doc_sizes": sizes}


_ARROW = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("first_id", pa.int64()), ("n_ids", pa.int64()), ("words", pa.binary()),
                    ("block_words", pa.binary()), ("escape_at", pa.binary()), ("escape_value", pa.binary()),
                    ("doc_ids", pa.list_(pa.int64())), ("doc_sizes", pa.list_(pa.int64()))])


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                 chunk_ids: int = CHUNK_IDS) -> None:
    """Encode every text, append ``end_id`` to each, and write the files to ``path`` in ascending id order.

    Null text: only the end id.  Null ids come first.  Rows with the same id stay apart, in the order of a
    hash of their text.  An empty table writes no chunk.  Other columns are not read.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    # equal ids may be many, so the text's hash takes part in the ranges
    rows = rows.withColumn("tie", F.coalesce(F.xxhash64("text"), F.lit(0)))
    ordered = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text")

    def encode(batches):
        from pyspark import TaskContext

        code = encoder(tokenizer_path)
        shard, number, first = TaskContext.get().partitionId(), 0, 0
        ids, doc_ids, sizes, held = [], [], [], 0
        for batch in batches:
            names = batch.column(0).to_pylist()
            row = 0
            for flat, per_text in code.encode(batch.column(1)):
                upto = np.concatenate([[0], np.cumsum(per_text)])
                # the end id goes in after each text
                with_end = np.insert(flat, upto[1:], np.uint32(end_id))
                upto = upto + np.arange(len(upto))
                lo = 0
                while lo < len(per_text):  # close a chunk as soon as it holds enough
                    hi = int(np.searchsorted(upto, upto[lo] + chunk_ids - held, "left"))
                    hi = min(max(hi, lo + 1), len(per_text))
                    ids.append(with_end[upto[lo]:upto[hi]])
                    doc_ids += names[row + lo:row + hi]
                    sizes += (per_text[lo:hi] + 1).tolist()
                    held += int(upto[hi] - upto[lo])
                    lo = hi
                    if held >= chunk_ids:
                        yield pa.RecordBatch.from_pylist([_chunk(shard, number, first, ids, doc_ids, sizes)], schema=_ARROW)
                        number, first = number + 1, first + held
                        ids, doc_ids, sizes, held = [], [], [], 0
                row += len(per_text)
        if doc_ids:
            yield pa.RecordBatch.from_pylist([_chunk(shard, number, first, ids, doc_ids, sizes)], schema=_ARROW)

    ordered.mapInArrow(encode, FILE_SCHEMA).write.mode("errorifexists").option("compression", "zstd").parquet(path)


def read_chunks(spark, path: str) -> DataFrame:
    return spark.read.schema(FILE_SCHEMA).parquet(path)


def decode_chunk(words: bytes, block_words: bytes, escape_at: bytes, escape_value: bytes, n: int) -> np.ndarray:
    return simple8b.decode(np.frombuffer(words, "<u8"), np.frombuffer(block_words, "<u2"), np.frombuffer(escape_at, "<u4"),
                           np.frombuffer(escape_value, "<u8"), n)


def read_documents(spark, path: str, with_ids: bool = False) -> DataFrame:
    """From the files: ``doc_id, start, n_tokens, ids_crc32`` and, if asked, ``ids`` (array of int)."""
    schema = "shard int, doc_id bigint, in_shard bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids

    def decode(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids = decode_chunk(r["words"], r["block_words"], r["escape_at"], r["escape_value"], r["n_ids"]).astype("<u4")
                sizes = np.array(r["doc_sizes"], np.int64)
                upto = np.concatenate([[0], np.cumsum(sizes)])
                raw = memoryview(ids.tobytes())
                out = [pa.array(np.full(len(sizes), r["shard"], np.int32)), pa.array(r["doc_ids"], pa.int64()),
                       pa.array(r["first_id"] + upto[:-1]), pa.array(sizes),
                       pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(upto[:-1].tolist(), upto[1:].tolist())], pa.int64())]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(out, ["shard", "doc_id", "in_shard", "n_tokens", "ids_crc32", "ids"][:len(out)])

    chunks = read_chunks(spark, path)
    docs = chunks.mapInArrow(decode, schema)
    totals = chunks.groupBy("shard").agg(F.max(F.col("first_id") + F.col("n_ids")).alias("total"))
    before = Window.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    bases = totals.select(F.col("shard").alias("b_shard"), F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    joined = docs.join(bases, F.col("shard") == F.col("b_shard"))
    return joined.select("doc_id", (F.col("base") + F.col("in_shard")).alias("start"), "n_tokens", "ids_crc32",
                         *(["ids"] if with_ids else []))
