"""Packing documents into sequences by power-of-two decomposition.

A document's token count is a sum of powers of two: it is cut into one piece
for each (the longest as often as needed), longest first. A piece is a sequence
of its own, so that no sequence crosses documents and none needs padding;
sequences of one length form a bucket, from which batches of equal length are
drawn.

Tokens are those of the ``tokenizers`` library. Its lower-casing vocabulary
drops white space and never joins what stands on both sides of it, so that a
document's ids are its words' ids in a row: a worker keeps the ids of words
that it has met, merges new ones by the vocabulary's exact rule, and leaves what
needs more than lower-casing to the library.

Rows: a null text is an empty one and has the end-of-text id only; a row that
occurs twice, or a doc_id that does, is packed once for each row; a null doc_id
stays null; other columns are ignored; an empty table packs to nothing. A text
of any length is packed whole: it is cut at white space and encoded bit by bit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import Vocabulary, ship_file
from .common import small_batches, stored, text_of, worker_cache

#: Tokens of the longest sequence, and the id that ends each document.
LONGEST, END_ID = 4096, 2
#: Bounds of a worker's memory: words that it keeps, the longest of them, bytes of text split at once, ids in one batch of rows.
CACHE_WORDS, LONGEST_WORD, SPLIT_BYTES, BATCH_IDS = 500_000, 48, 4 << 20, 1 << 20
#: Bits of a sequence id: 4 for the bucket, 26 for the task, 33 for the place among the task's sequences of that length.
TASK_BITS, RANK_BITS = 26, 33
SCHEMA = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, task int, rank bigint"
#: How the vocabulary cuts a word (a fixed value of its format), with a line's end, which stands between words here.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+|\n"
#: Words of characters that no normal form changes and whose small letters are one character each.
PLAIN = re.compile("[\n!-~\xa1-\u012f\u0131-\u02ff]*")
#: Stands between words' ids; no id has these bytes.
MARK = b"\xff" * 4
#: What the vocabulary treats as white space and UTF-8 writes as one byte.
SPACE = re.compile(rb"[ \t\n\r\x0b\x0c]")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """The ids of texts, word by word; lives in a Python worker.

    A word is what stands between white space of one byte. Words of plain
    characters, which the vocabulary only lower-cases and cuts, are merged here,
    all new ones of a text together; the library takes words with other
    characters or a special token's marks.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.vocabulary = Vocabulary(path)
        self.cut = regex.compile(PIECES)
        self.known: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def encode_all(self, texts: list[bytes]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text in UTF-8; new words of some texts are learnt together."""
        at = 0
        while at < len(texts):
            split, size = [], 0
            while at < len(texts) and (not split or size + len(texts[at]) <= SPLIT_BYTES):
                size += len(texts[at])
                split.append(texts[at].split() if len(texts[at]) <= SPLIT_BYTES else None)
                at += 1
            if split[0] is None:  # a long text, alone
                yield b"".join(ids for words in self._parts(texts[at - 1]) for ids in self._ids([words]))
            else:
                yield from self._ids(split)

    def _parts(self, text: bytes) -> Iterator[list[bytes]]:
        at = 0
        while at < len(text):
            end = at + SPLIT_BYTES
            cut = SPACE.search(text, end) if end < len(text) else None
            end = cut.start() if cut else len(text)
            yield text[at:end].split()
            at = end

    def _ids(self, split: list[list[bytes]]) -> list[bytes]:
        known = self.known
        new = set().union(*split).difference(known)
        if len(known) + len(new) > CACHE_WORDS:
            known.clear()
            new = set().union(*split)
        self.learn(new)
        ids = [b"".join(map(known.__getitem__, words)) for words in split]
        for w in new:
            if len(w) > LONGEST_WORD:
                del known[w]
        return ids

    def learn(self, words: set[bytes]) -> None:
        """Have the ids of ``words``, a bounded number of them, at hand."""
        known, plain = self.known, list(words)
        text = b"\n".join(plain).decode()
        if not PLAIN.fullmatch(text) or "<|" in text:
            other = [(w, t) for w in plain if "<|" in (t := w.decode()) or not PLAIN.fullmatch(t)]
            found = self.tokenizer.encode_batch_fast([t for _, t in other], add_special_tokens=False)
            known.update((w, np.array(x.ids, dtype="<u4").tobytes()) for (w, _), x in zip(other, found, strict=True))
            plain = list(words.difference([w for w, _ in other]))
            text = b"\n".join(plain).decode()
        if not plain:
            return
        cut, pieces = self.cut.findall(text.lower()), self.pieces
        if len(pieces) + len(plain) > CACHE_WORDS:
            pieces.clear()
        pieces["\n"] = MARK
        new = [p for p in set(cut) if p not in pieces]
        pieces.update(zip(new, self.vocabulary.merge_all([p.encode() for p in new]), strict=True))
        known.update(zip(plain, b"".join(map(pieces.__getitem__, cut)).split(MARK), strict=True))
        for p in new:
            if len(p) > LONGEST_WORD:
                del pieces[p]


def _word_ids(name: str) -> WordIds:
    from pyspark import SparkFiles

    cache = worker_cache()
    if cache.get("word_vocabulary") != name:
        cache.clear()
        cache.update(word_vocabulary=name, word_ids=WordIds(SparkFiles.get(name)))
    return cache["word_ids"]


def lengths(tokens: int, longest: int = LONGEST) -> list[int]:
    """The pieces of a document: the longest as often as it fits, then the binary digits of the rest, falling."""
    rest = tokens % longest
    return [longest] * (tokens // longest) + [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]


def packed(docs: DataFrame, vocabulary: str | None = None, longest: int = LONGEST, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset), a row for each piece.

    ``ids`` are little-endian unsigned 32-bit integers. ``sequence_id`` names the
    bucket in its top bits (log2 of the length), so that ordered ids go bucket by
    bucket; ``offset`` is 0, as each piece is a whole sequence. Pieces are written
    once, numbered in the task that made them: no sort, no shuffle, and a lost
    task is written anew as a whole.
    """
    if longest & (longest - 1) or not 0 < longest < 1 << 16:
        raise ValueError("longest must be a power of two below 65,536")
    spark = docs.sparkSession
    small_batches(spark)
    name = ship_file(spark, vocabulary or default_vocabulary())

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, task = _word_ids(name), TaskContext.get().partitionId()
        if task >> TASK_BITS:
            raise ValueError(f"more than {1 << TASK_BITS} tasks")
        ranks: dict[int, int] = {}
        rows: list[tuple] = []
        held, end = 0, np.array([end_id], dtype="<u4").tobytes()

        def batch() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64())
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in SCHEMA.split(", ")])
            rows.clear()
            return made

        for got in batches:
            for doc_id, ids in zip(got.column(0).to_pylist(), words.encode_all(got.column(1).to_pylist()), strict=True):
                ids += end
                total, start = len(ids) // 4, 0
                for length in lengths(total, longest):
                    rank = ranks.get(length, 0)
                    ranks[length] = rank + 1
                    rows.append((doc_id, start, length, ids[4 * start : 4 * (start + length)], total, task, rank))
                    start += length
                    held += length
                    if held >= BATCH_IDS:
                        yield batch()
                        held = 0
        if rows:
            yield batch()

    made = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().cast("binary").alias("text")).mapInArrow(pieces, SCHEMA))
    bucket = F.log2("length").cast("long")
    number = F.shiftleft(bucket, TASK_BITS + RANK_BITS) + F.shiftleft(F.col("task").cast("long"), RANK_BITS) + F.col("rank")
    return made.select("doc_id", "start", "length", "ids", "doc_tokens", number.alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Sequences of equal length in a folder each (length=...), as Parquet: a training job reads one bucket's for a batch."""
    pieces.write.partitionBy("length").mode("overwrite").parquet(path)


def batches(pieces: DataFrame, tokens: int, seed: int = 0) -> DataFrame:
    """``pieces`` with batch_id: sequences of one length, about ``tokens`` tokens of them, dealt by hash.

    Every sequence is in one batch; a bucket of n tokens makes max(1, round(n / tokens)) batches.
    """
    sizes = pieces.groupBy("length").agg(F.greatest(F.lit(1), F.round(F.sum("length") / tokens)).cast("long").alias("__batches"))  # a row for each power of two
    dealt = pieces.join(F.broadcast(sizes), "length")
    number = F.pmod(F.xxhash64(F.lit(seed), "sequence_id"), F.col("__batches"))
    return dealt.withColumn("batch_id", F.concat_ws("-", "length", number)).drop("__batches")


def digest(ids: Column | str) -> Column:
    """CRC-32 of the ids, unsigned."""
    return F.crc32(ids)
