"""Byte-level BPE encoding and decoding with a minimal acyclic transducer as lexicon.

Spark counts the pieces of the whole corpus; the most frequent ones are encoded
once and compiled into a minimal acyclic automaton. Words share prefixes and
suffixes; the sum of the counts along a word's path is its rank among the words,
which leads to its ids. The automaton is one file of fixed-size arrays that
executors memory-map. Pieces that are not in it are merged by the exact BPE rule.
The lexicon changes speed, never results.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import tempfile
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from .common import handing_back, small_batches, stored, text_of, worker_cache

LEXICON_WORDS = 100_000
LONGEST_WORD = 48
#: Stands for the rank of a pair that does not merge.
NO_RANK = 1 << 40
#: Entries of a worker's cache and of a task's counter, which bound their memory.
CACHE_WORDS, COUNTER_WORDS = 500_000, 400_000
#: How the byte-level pre-tokenizer cuts a text (a fixed value of the public format).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens, merges and special tokens of a vocabulary file in the tokenizers library's format."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            own = json.load(f)
        alphabet = byte_alphabet()
        raw = lambda token: bytes(alphabet[ch] for ch in token)
        ids = own["model"]["vocab"]
        self.id_of = {raw(t): i for t, i in ids.items()}
        self.special = {a["content"]: a["id"] for a in own["added_tokens"]}
        self.bytes_of = [b""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, i in self.id_of.items():
            self.bytes_of[i] = token
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for r, merge in enumerate(own["model"]["merges"]):
            a, b = map(raw, merge if isinstance(merge, list) else merge.split(" "))
            self.rank[self.id_of[a], self.id_of[b]] = (r, self.id_of[a + b])
        self.singles = np.array([self.id_of[bytes([b])] for b in range(256)], dtype=np.int64)
        end = (own["model"].get("end_of_word_suffix") or "").encode()
        self.ends = np.array([self.id_of[bytes([b]) + end] for b in range(256)], dtype=np.int64)  # of a piece's last byte
        self.merged = np.array([new for _, new in self.rank.values()], dtype=np.int64)  # by rank
        pairs = np.array([a << 32 | b for a, b in self.rank], dtype=np.int64)
        at = np.argsort(pairs)
        self.pairs, self.pair_rank = pairs[at], np.array([r for r, _ in self.rank.values()], dtype=np.int64)[at]
        self.cut = regex.compile(PIECES)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        return np.frombuffer(self.merge_all([piece])[0], dtype="<u4").tolist()

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece as little-endian 32-bit integers: the lowest-ranked pair, leftmost first, until none is left.

        Pieces of one length are the rows of a matrix; each step merges one pair in
        every row, so that all rows stay of one length, and rows that are done leave.
        """
        out: list[bytes] = [b""] * len(pieces)
        by_length: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            by_length.setdefault(len(p), []).append(i)
        for n, members in by_length.items():
            if n > 64:
                for i in members:
                    out[i] = np.array(self._merge_long(self._start([pieces[i]], n)[0].tolist()), dtype="<u4").tobytes()
                continue
            if not n:
                continue
            rows = np.array(members)
            ids = self._start([pieces[i] for i in members], n)
            ranks = self._ranks(ids[:, :-1], ids[:, 1:])
            while True:
                at = ranks.argmin(axis=1) if ids.shape[1] > 1 else np.zeros(len(rows), dtype=np.int64)
                line = np.arange(len(rows))
                live = ranks[line, at] < NO_RANK if ids.shape[1] > 1 else np.zeros(len(rows), dtype=bool)
                for i, own in zip(rows[~live].tolist(), ids[~live].astype("<u4"), strict=True):
                    out[i] = own.tobytes()
                if not live.any():
                    break
                rows, ids, ranks, at = rows[live], ids[live], ranks[live], at[live]
                line, width = np.arange(len(rows)), ids.shape[1]
                ids[line, at] = self.merged[ranks[line, at]]
                keep = np.arange(width) != (at + 1)[:, None]
                ids = ids[keep].reshape(len(rows), width - 1)
                ranks = ranks[keep[:, 1:]].reshape(len(rows), width - 2)
                if width > 2:
                    for side in (at - 1, at):  # the pairs to either side of what was merged
                        ok = (side >= 0) & (side < width - 2)
                        ranks[line[ok], side[ok]] = self._ranks(ids[line[ok], side[ok]], ids[line[ok], side[ok] + 1])
        return out

    def _start(self, pieces: list[bytes], n: int) -> np.ndarray:
        """The ids of the bytes of pieces of length n, a row for each."""
        raw = np.frombuffer(b"".join(pieces), dtype=np.uint8).reshape(-1, n)
        return np.concatenate([self.singles[raw[:, :-1]], self.ends[raw[:, -1:]]], axis=1)

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pair = a.astype(np.int64) << 32 | b
        i = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[i] == pair, self.pair_rank[i], NO_RANK)

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over a linked list, for long pieces."""
        n, rank = len(ids), self.rank
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank.get((ids[i], ids[i + 1])))]
        heap = [(r, i, new, a, b) for r, new, i, a, b in heap]
        heapq.heapify(heap)
        while heap:
            _, i, new, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = new, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (r := rank.get((ids[left], ids[right]))):
                    heapq.heappush(heap, (r[0], left, r[1], ids[left], ids[right]))
        return [x for x in ids if x >= 0]


def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """A minimal acyclic automaton of ``words`` with their ids, as the bytes of one file.

    Words are added in order; what can't change any more is replaced by an equal
    state that is there already, so states are unique by their future.
    """
    edges: list[dict[int, int]] = [{}]
    final = [False]
    register: dict[tuple, int] = {}
    path: list[tuple[int, int]] = []  # (state, byte) of the last word's unregistered part

    def settle(keep: int) -> None:
        while len(path) > keep:
            state, byte = path.pop()
            child = edges[state][byte]
            key = (final[child], tuple(edges[child].items()))
            edges[state][byte] = register.setdefault(key, child)

    last = b""
    order = sorted(w for w in words if w)
    for word in order:
        same = len(os.path.commonprefix([last, word]))
        settle(same)
        state = edges[path[-1][0]][path[-1][1]] if path else 0
        for byte in word[same:]:
            edges.append({})
            final.append(False)
            edges[state][byte] = len(edges) - 1
            path.append((state, byte))
            state = len(edges) - 1
        final[state] = True
        last = word
    settle(0)

    number, count = {0: 0}, {}
    stack, rank = [(0, False)], []
    while stack:  # children before parents
        state, done = stack.pop()
        if done:
            count[state] = final[state] + sum(count[c] for c in edges[state].values())
        elif state not in count:
            stack.append((state, True))
            stack += [(c, False) for c in edges[state].values() if c not in count]
            rank.append(state)
    for state in rank:
        number.setdefault(state, len(number))
    keys, targets, skips = [], [], []
    for state, n in number.items():
        skip = int(final[state])
        for byte, child in sorted(edges[state].items()):
            keys.append(n << 8 | byte)
            targets.append(number[child])
            skips.append(skip)
            skip += count[child]
    at = np.argsort(np.array(keys, dtype="<i4"), kind="stable")
    ids = [words[w] for w in order]
    parts = [np.array(keys, dtype="<i4")[at], np.array(targets, dtype="<i4")[at], np.array(skips, dtype="<i4")[at]]
    parts += [np.array([final[s] for s in number], dtype="<i4"), np.cumsum([0, *map(len, ids)]).astype("<i4"), np.array([i for x in ids for i in x], dtype="<i4")]
    return np.concatenate([np.array([len(p) for p in parts], dtype="<i4"), *parts]).tobytes()


class Lexicon:
    """A compiled lexicon, memory-mapped."""

    def __init__(self, path: str):
        own = np.memmap(path, dtype="<i4", mode="r")
        ends = 6 + np.cumsum([0, *own[:6]], dtype=np.int64)
        self.keys, self.targets, self.skips, self.final, self.starts, self.ids = (own[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True))

    def look_up(self, words: list[bytes]) -> list[bytes | None]:
        """For each word its ids as little-endian 32-bit integers, or None; all words step through the automaton together."""
        out: list[bytes | None] = [None] * len(words)
        if not len(self.keys):
            return out
        live = np.array([i for i, w in enumerate(words) if 0 < len(w) <= LONGEST_WORD], dtype=np.int64)
        if not len(live):
            return out
        size = np.array([len(words[i]) for i in live])
        start = np.cumsum(size) - size
        data = np.frombuffer(b"".join(words[i] for i in live), dtype=np.uint8)
        state, place = np.zeros(len(live), dtype=np.int64), np.zeros(len(live), dtype=np.int64)
        for step in range(int(size.max())):
            going = np.nonzero((size > step) & (state >= 0))[0]
            key = (state[going] << 8 | data[start[going] + step]).astype(self.keys.dtype)
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[edge] == key
            place[going] += np.where(hit, self.skips[edge], 0)
            state[going] = np.where(hit, self.targets[edge], -1)
        for i in np.nonzero((state >= 0) & (self.final[state] == 1))[0]:
            a, b = self.starts[place[i]], self.starts[place[i] + 1]
            out[live[i]] = self.ids[a:b].astype("<u4").tobytes()
        return out


class Encoder:
    """Encodes texts with a vocabulary and a lexicon; lives in a Python worker."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon | None):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.cache: dict[str, bytes] = {}

    def learn(self, pieces: set[str]) -> None:
        new = [p for p in pieces if p not in self.cache]
        if len(self.cache) + len(new) > CACHE_WORDS:
            self.cache.clear()
            new = list(pieces)
        raw = [p.encode() for p in new]
        own = self.lexicon.look_up(raw) if self.lexicon else [None] * len(raw)
        unseen = [i for i, x in enumerate(own) if x is None]
        for i, ids in zip(unseen, self.vocabulary.merge_all([raw[i] for i in unseen]), strict=True):
            own[i] = ids
        self.cache.update(zip(new, own, strict=True))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        v, out = self.vocabulary, []
        for at in range(0, len(texts), 200):  # so many texts' pieces at once
            cut = []
            for text in texts[at : at + 200]:
                parts = v.specials.split(text) if v.specials and any(s in text for s in v.special) else [text]
                cut.append([part if i % 2 else v.cut.findall(part) for i, part in enumerate(parts)])
            self.learn({p for parts in cut for part in parts[::2] for p in part})
            known = self.cache.__getitem__
            for parts in cut:
                ids = [np.array([v.special[x]], dtype="<u4").tobytes() if isinstance(x, str) else b"".join(map(known, x)) for x in parts]
                out.append(b"".join(ids))
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> str:
        """The text of ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())).decode("utf-8", "replace")


def piece_counts(docs: DataFrame) -> DataFrame:
    """(piece, n) over all texts; each task pre-aggregates in a counter of bounded size."""
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, seen = regex.compile(PIECES), Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["piece", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(cut.findall(text))
                if len(seen) > COUNTER_WORDS:
                    yield rows()
                    seen.clear()
        if seen:
            yield rows()

    return docs.select(text_of().alias("text")).mapInArrow(handing_back(count), "piece string, n bigint").groupBy("piece").agg(F.sum("n").alias("n"))


def _ship(spark: SparkSession, data: bytes, suffix: str) -> str:
    """Give every executor a copy of a small file; returns its name for SparkFiles."""
    name = f"{hashlib.sha256(data).hexdigest()[:24]}{suffix}"
    folder = os.path.realpath(tempfile.mkdtemp(prefix="shipped-"))
    path = os.path.join(folder, name)
    with open(path, "wb") as f:
        f.write(data)
    if not any(str(x).endswith("/" + name) for x in spark.sparkContext.listFiles):
        spark.sparkContext.addFile(path)
    return name


def ship_file(spark: SparkSession, path: str) -> str:
    """Give every executor a copy of the file at ``path``; returns its name for SparkFiles."""
    with open(path, "rb") as f:
        return _ship(spark, f.read(), os.path.splitext(path)[1])


def build_lexicon(docs: DataFrame, vocabulary: str | None = None, words: int = LEXICON_WORDS) -> tuple[str, str]:
    """Ship the vocabulary and the automaton of the ``words`` most frequent pieces; returns their file names.

    The driver gets at most ``words`` short pieces, whatever the size of the corpus.
    """
    spark, path = docs.sparkSession, vocabulary or default_vocabulary()
    v = Vocabulary(path)
    counted = stored(piece_counts(docs).filter((F.octet_length("piece") <= LONGEST_WORD) & (F.col("n") > 1)))
    step = F.floor(F.log2("n") * 16).cast("int").alias("step")
    sizes = counted.groupBy(step).agg(F.count("*").alias("many"), F.min("n").alias("least")).orderBy(F.desc("step")).collect()  # at most 16 * 63 rows
    room, least = words, None
    for row in sizes:  # the most frequent steps that fit
        room -= row["many"]
        if room < 0:
            break
        least = row["least"]
    top = [r[0].encode() for r in counted.filter(F.col("n") >= least).select("piece").collect()] if least else []
    compiled = compile_lexicon({p: np.frombuffer(i, dtype="<u4").tolist() for p, i in zip(top, v.merge_all(top), strict=True)})
    return ship_file(spark, path), _ship(spark, compiled, ".lexicon")


def _encoder(files: tuple[str, str]) -> Encoder:
    cache = worker_cache()
    if cache.get("files") != files:
        cache.clear()  # a worker holds one lexicon: those of earlier corpora go
        cache.update(files=files, encoder=Encoder(Vocabulary(SparkFiles.get(files[0])), Lexicon(SparkFiles.get(files[1]))))
    return cache["encoder"]


def encoded(text: Column, files: tuple[str, str]) -> Column:
    """The ids of a text as an array of integers."""

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = _encoder(files)
        for texts in batches:
            ids = own.encode_all([x or "" for x in texts.to_pylist()])
            flat = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
            yield pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(x) // 4 for x in ids)]).astype("i4")), flat)

    return arrow_udf(handing_back(encode), T.ArrayType(T.IntegerType()))(text)


def decoded(ids: Column, files: tuple[str, str]) -> Column:
    """The text of an array of ids; null ids decode to the empty text."""

    @arrow_udf(T.StringType())
    def decode(rows: pa.Array) -> pa.Array:
        own = _encoder(files)
        return pa.array([own.decode(np.array(x or [], dtype="<u4").tobytes()) for x in rows.to_pylist()], pa.string())

    return decode(ids)


DIGEST = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])


def round_trip(docs: DataFrame, vocabulary: str | None = None, words: int = LEXICON_WORDS) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for each row: encoded, then decoded again, in one pass."""
    files = build_lexicon(docs, vocabulary, words)

    @arrow_udf(DIGEST)
    def both_ways(texts: pa.Array) -> pa.Array:
        own, sha = _encoder(files), lambda raw: hashlib.sha256(raw).hexdigest()
        ids = own.encode_all([x or "" for x in texts.to_pylist()])
        columns = [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(map(sha, ids), pa.string()), pa.array([sha(own.decode(x).encode()) for x in ids], pa.string())]
        return pa.StructArray.from_arrays(columns, names=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", both_ways(text_of()).alias("d")).select("doc_id", "d.*")


def tokenized(docs: DataFrame, vocabulary: str | None = None, words: int = LEXICON_WORDS) -> DataFrame:
    """``docs`` with the ids of the text in place of it: the column token_ids, or token_ids_ where there is such a column, and so on.

    A null text has no ids; repeated rows are encoded each; texts of any length are encoded whole.
    """
    files = build_lexicon(docs, vocabulary, words)
    name = "token_ids"
    while name in docs.columns:
        name += "_"
    return docs.select(*[c for c in docs.columns if c != "text"], encoded(text_of(), files).alias(name))
