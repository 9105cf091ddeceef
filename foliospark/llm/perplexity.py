"""Quality classifier: an interpolated modified Kneser-Ney model of word trigrams.

Each language has a model of its trusted text. Words are told by 64-bit hashes.

1. Counts. Batches of trusted text count their trigrams (a, b, c), which are dealt
   to shards by the pair (b, c): a shard knows how often a pair comes and after
   how many different words. Trigrams and pairs that come once are pruned, as is
   usual; their mass goes to the back-off.
2. Model. An interpolated model can be written as a sum. Whatever n-grams a text
   has, its log-probability is the sum of one weight for each word, pair and
   trigram in it, 0 for those that the model lacks. So the model is a table of
   (key of an n-gram, weight), made by joins and group-bys.
3. Scores. The most frequent n-grams, a bounded number, are looked up where the
   text is read. All others travel to the shard of their key, where they meet
   the model's part, and sums go back to the documents. A word that the model
   lacks is spelled by a model of byte pairs. Documents go in SLICES, one after
   the other, which bounds the disk that travelling n-grams take.
4. Thresholds. A fold of the trusted texts is held out of the counts; thresholds
   are quantiles of its perplexities in each language.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from .common import dropped, handing_back, small_batches, stored, text_of

#: The quantile of held-out trusted perplexities that a document may reach.
QUANTILE = 0.99
#: One in so many trusted texts, by hash, is held out of the counts.
FOLDS = 10
#: Words of average trusted text that every document is taken to have besides its own, so that a few words prove little.
PRIOR_WORDS = 10
#: Pairs and trigrams that come less often are left to the back-off.
LEAST = 2
#: Documents are scored in so many parts, one after the other.
SLICES = 6
#: Trusted texts are picked, and trigrams are counted, in so many parts, one after the other.
COUNTS = 2
#: N-grams that every task gets, trusted trigrams of a shard, and keys of a shard: all bound what a task holds.
HOT, SHARD_TRIGRAMS, SHARD_KEYS = 1 << 17, 1 << 20, 1 << 21
NO_ID, NO_LANG = -(1 << 63), "(none)"
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
MARKS = tuple(bytes([c]) for c in b".,;:!?|()\"")
START, END = 0, 1


def mixed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit hashes of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def key_of(*words: np.ndarray) -> np.ndarray:
    """The key of an n-gram of word hashes."""
    out = mixed(words[0] + np.uint64(len(words)))
    for w in words[1:]:
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + w)
    return out


def tokens(text: bytes) -> list[bytes]:
    """Words in lower case; punctuation marks are words of their own."""
    text = text.translate(LOWER)
    for m in MARKS:
        text = text.replace(m, b" " + m + b" ")
    return text.split()


class _Numbers(dict):
    """Words by number, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Read:
    """The words of a batch: ``seq`` of all documents, each <s> words </s>, as numbers of ``names``; ``first`` and ``size`` by document."""

    def __init__(self, texts: list[bytes], langs: list[str]):
        spaces: dict[str, _Numbers] = {}
        parts, self.size, own = [], [], []
        for x, lang in zip(texts, langs, strict=True):
            numbers = spaces.setdefault(lang, _Numbers({b"": START, b" ": END}))
            words = tokens(x)
            parts.append(np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words)))
            self.size.append(len(words) + 2)
            own.append(lang)
        base, shift = {}, 0
        self.names: list[bytes] = []
        hashes = []
        for lang, numbers in spaces.items():
            base[lang], shift = shift, shift + len(numbers)
            self.names += numbers
            h = np.array([xxhash.xxh64_intdigest(w, 7) for w in numbers], dtype=np.uint64)
            hashes.append(mixed(h ^ np.uint64(xxhash.xxh64_intdigest(lang.encode(), 11))))
        self.size = np.array(self.size, dtype=np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.seq = np.empty(int(self.size.sum()), dtype=np.int64)
        for at, x, lang in zip(self.first, parts, own, strict=True):
            self.seq[at] = base[lang] + START
            self.seq[at + 1 : at + 1 + len(x)] = x + base[lang]
            self.seq[at + 1 + len(x)] = base[lang] + END
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.words = self.hashes[self.seq]
        self.starts = np.zeros(len(self.seq), dtype=bool)
        self.starts[self.first] = True

    def spelled(self, spelling: np.ndarray) -> np.ndarray:
        """Log-probability of each name under ``spelling`` (256, 256), a space at either end; 0 for <s> and </s>."""
        names = [b"" if w == b" " else w for w in self.names]
        raw = np.frombuffer(b" " + b" ".join(names) + b" ", dtype=np.uint8).astype(np.int64)
        steps = np.concatenate([[0.0], np.cumsum(spelling[raw[:-1], raw[1:]])])
        size = np.array([len(w) for w in names], dtype=np.int64)
        at = np.cumsum(size + 1) - size - 1
        return np.where(size > 0, steps[at + size + 1] - steps[at], 0.0)


def _packed(hashes: np.ndarray, names: list[np.ndarray], n: np.ndarray) -> bytes:
    """Trigrams of a batch's names with their counts: a table of the hashes that occur, then places in it."""
    used, at = np.unique(np.concatenate(names), return_inverse=True)
    kind = np.uint16 if len(used) <= 1 << 16 else np.uint32
    head = np.array([len(used), len(n)], dtype=np.uint32)
    return b"".join([head.tobytes(), hashes[used].tobytes(), n.astype(np.uint32).tobytes(), at.astype(kind).tobytes()])


def _unpacked(blob: bytes) -> tuple[np.ndarray, ...]:
    """(a, b, c, n) of ``_packed`` trigrams, word hashes and counts."""
    used, k = (int(x) for x in np.frombuffer(blob, dtype=np.uint32, count=2))
    hashes = np.frombuffer(blob, dtype=np.uint64, count=used, offset=8)
    n = np.frombuffer(blob, dtype=np.uint32, count=k, offset=8 + 8 * used).astype(np.int64)
    at = np.frombuffer(blob, dtype=np.uint16 if used <= 1 << 16 else np.uint32, offset=8 + 8 * used + 4 * k)
    return *hashes[at].reshape(3, k), n


def _once(a: np.ndarray, b: np.ndarray, c: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct trigrams with their counts, sorted by the pair (b, c)."""
    pair, three = key_of(b, c), key_of(a, b, c)
    order = np.lexsort((three, pair))
    pair, three = pair[order], three[order]
    new = np.flatnonzero(np.concatenate([[True], (three[1:] != three[:-1]) | (pair[1:] != pair[:-1])])) if len(order) else order
    at = order[new]
    return a[at], b[at], c[at], np.add.reduceat(n[order], new) if len(new) else n[:0]


def trigrams(texts: DataFrame, shards: int, part: int = 0, of: int = 1) -> DataFrame:
    """(shard, lang, blob) of distinct trigrams of a batch in every ``of``-th shard from ``part`` on, and blobs of byte-pair counts with part 0, lang null. texts: lang, text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for nth, batch in enumerate(batches):
                langs = np.array(batch.column("lang").to_pylist(), dtype=object)
                raw = batch.column("text").cast(pa.binary()).to_pylist()
                out: list[tuple[int, str | None, bytes]] = []
                spelling = np.zeros(1 << 16, dtype=np.int64)
                for lang in sorted(set(langs)):
                    own = Read([raw[i] for i in np.flatnonzero(langs == lang)], [lang] * int((langs == lang).sum()))
                    letters = np.frombuffer(b" " + b" ".join(own.names[2:]) + b" ", dtype=np.uint8).astype(np.int64)
                    once = np.unique(np.repeat(np.arange(len(own.size)), own.size) << 32 | own.seq) & 0xFFFFFFFF  # each word once a text
                    times = np.bincount(once, minlength=len(own.names))[2:]
                    each = np.repeat(times, [len(w) + 1 for w in own.names[2:]]) if len(times) else np.zeros(1)
                    spelling += np.bincount(letters[:-1] << 8 | letters[1:], weights=each, minlength=1 << 16).astype(np.int64)
                    at = np.flatnonzero(~own.starts)
                    before = np.where(own.starts[at - 1], at - 1, at - 2)
                    places = np.stack([before, at - 1, at])
                    _, some, n = np.unique(key_of(*own.words[places]), return_index=True, return_counts=True)
                    places = places[:, some]
                    shard = (key_of(own.words[places[1]], own.words[places[2]]) % np.uint64(shards)).astype(np.uint16 if shards < 1 << 16 else np.int64)
                    order = np.argsort(shard, kind="stable")
                    ends = np.searchsorted(shard[order], np.arange(shards + 1))
                    for s in np.flatnonzero(np.diff(ends)):
                        if s % of != part:
                            continue
                        k = order[ends[s] : ends[s + 1]]
                        out.append((int(s), lang, _packed(own.hashes, list(own.seq[places[:, k]]), n[k])))
                if part == 0:
                    out.append((nth % shards, None, spelling.tobytes()))
                for i in range(0, len(out), 64):
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out[i : i + 64], strict=True), (pa.int32(), pa.string(), pa.binary()), strict=True)], names=["shard", "lang", "blob"])

    return texts.select("lang", "text").mapInArrow(handing_back(rows), "shard int, lang string, blob binary")


STATS = "lang string, kind int, x bigint, y bigint, z bigint, n bigint, m bigint"
#: Kinds of rows in STATS: n-grams that were seen n times, of order n (x counts); words as last of pairs, as first of pairs; trigrams, pairs; byte pairs.
OFTEN, LAST, FIRST, TRIGRAM, PAIR, LETTERS = range(6)


def statistics(texts: DataFrame, shards: int, part: int = 0, of: int = 1) -> DataFrame:
    """A part of the STATS of trusted texts (lang, text); rows of kinds OFTEN, LAST, FIRST and LETTERS are still to be summed."""

    def row(lang: str | None, kind: int, x: np.ndarray, y=None, z=None, n=None, m=None) -> pa.RecordBatch:
        none = np.zeros(len(x), dtype=np.int64)
        columns = [none if c is None else np.ascontiguousarray(c).view(np.int64) if c.dtype == np.uint64 else c.astype(np.int64) for c in (x, y, z, n, m)]
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(x), pa.string()), pa.array(np.full(len(x), kind, np.int32)), *map(pa.array, columns)], names=["lang", "kind", "x", "y", "z", "n", "m"])

    def counted(word: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own, where = np.unique(word, return_inverse=True)
        return own, np.bincount(where, weights=n).astype(np.int64)

    def summed(lang: str, a: np.ndarray, b: np.ndarray, c: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        pair = key_of(b, c)
        new = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        seen, after = np.add.reduceat(n, new), np.diff(np.concatenate([new, [len(pair)]]))
        b2, c2 = b[new], c[new]
        for order, own in ((3, n), (2, after)):
            k = np.arange(1, 5)
            yield row(lang, OFTEN, np.full(4, order), k, n=np.array([(own == i).sum() for i in k]))
        ends, many = counted(c2, np.ones(len(c2)))
        yield row(lang, LAST, ends, n=many)
        begins, many = counted(b2, after)
        yield row(lang, FIRST, begins, n=many)
        start = mixed(np.array([xxhash.xxh64_intdigest(b"", 7) ^ xxhash.xxh64_intdigest(lang.encode(), 11)], dtype=np.uint64))[0]
        keep = (n >= LEAST) & (b != start)  # the first word of a text has a pair only
        yield row(lang, TRIGRAM, a[keep], b[keep], c[keep], n[keep])
        keep = seen >= LEAST
        yield row(lang, PAIR, b2[keep], c2[keep], n=seen[keep], m=after[keep])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, ...]]] = {}
        spelling = np.zeros(1 << 16, dtype=np.int64)
        join = lambda parts: _once(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        with np.errstate(over="ignore"):
            for batch in batches:
                for lang, blob in zip(batch.column("lang").to_pylist(), batch.column("blob").to_pylist(), strict=True):
                    if lang is None:
                        spelling += np.frombuffer(blob, dtype=np.int64)
                        continue
                    own = held.setdefault(lang, [])
                    own.append(_unpacked(blob))
                    if sum(len(x[0]) for x in own[1:]) > max(SHARD_TRIGRAMS, len(own[0][0])):
                        held[lang] = [join(own)]
            for lang in sorted(held):
                yield from summed(lang, *join(held.pop(lang)))
            seen = np.flatnonzero(spelling)
            yield row(None, LETTERS, seen, n=spelling[seen])

    return trigrams(texts, shards, part, of).repartition(shards, "shard").select("lang", "blob").mapInArrow(handing_back(rows), STATS)


def discount(n: Column, often: list[Column]) -> Column:
    """Modified Kneser-Ney's discount of a count, from how many n-grams were seen 1 to 4 times."""
    n1, n2, n3, n4 = (x.cast("double") for x in often)
    y = n1 / (n1 + 2 * n2)
    within = lambda d, k: F.least(F.greatest(d, F.lit(0.05)), F.lit(k - 0.05))
    plain = (n1 == 0) | (n2 == 0)
    one = F.when(plain, 0.5).otherwise(within(1 - 2 * y * F.try_divide(n2, n1), 1))
    two = F.when(plain, 0.75).otherwise(within(2 - 3 * y * F.try_divide(n3, n2), 2))
    three = F.when(plain, 1.0).when(n3 == 0, 1.5).otherwise(within(3 - 4 * y * F.try_divide(n4, n3), 3))
    return F.when(n == 1, one).when(n == 2, two).otherwise(three)


@arrow_udf(T.LongType())
def _key(x: pa.Array, y: pa.Array, z: pa.Array, n: pa.Array) -> pa.Array:
    words = [np.asarray(c).view(np.uint64) for c in (x, y, z)]
    with np.errstate(over="ignore"):
        keys = [key_of(words[0]), key_of(*words[:2]), key_of(*words)]
    return pa.array(np.choose(np.asarray(n) - 1, keys).view(np.int64))


def model_of(stats: DataFrame, read: Callable[[], None] = lambda: None) -> tuple[list[DataFrame], DataFrame]:
    """Tables (key, weight, n) of the words, pairs and trigrams that the model has, and (lang, unknown): log of the mass that unknown words share.

    ``read`` is called when ``stats`` is needed no more. The tables are written one
    after the other, so that each one's shuffle files go before the next one's come.

    With p1, p2, p3 the interpolated probabilities and g2, g3 the back-off masses
    of contexts, the weight of a word is log p1 + log g2, that of a pair (b, c)
    log p2(c|b) - log g2(b) - log p1(c) + log g3(b, c), that of a trigram
    log p3(c|ab) - log g3(ab) - log p2(c|b).
    """
    kind = lambda k: stats.filter(F.col("kind") == k)
    mass = lambda part: F.log(F.greatest(1 - F.sum(part), F.lit(1e-9)))
    last = stored(kind(LAST).groupBy("lang", F.col("x").alias("c")).agg(F.sum("n").alias("n")))
    often = kind(OFTEN).select("lang", F.col("x").alias("o"), F.col("y").alias("k"), "n")
    often = often.unionByName(last.filter("n <= 4").select("lang", F.lit(1).cast("long").alias("o"), F.col("n").alias("k"), F.lit(1).cast("long").alias("n")))
    count = lambda o, k: F.coalesce(F.sum(F.when((F.col("o") == o) & (F.col("k") == k), F.col("n"))), F.lit(0)).alias(f"t{o}{k}")
    lengths = last.groupBy("lang").agg(F.sum("n").alias("pairs"))
    facts = stored(often.groupBy("lang").agg(*[count(o, k) for o in (1, 2, 3) for k in (1, 2, 3, 4)]).join(lengths, "lang"))  # a row a language
    cut = lambda o, n: F.col(n) - discount(F.col(n), [F.col(f"t{o}{k}") for k in (1, 2, 3, 4)])

    words = last.join(facts, "lang").select("lang", "c", "n", (cut(1, "n") / F.col("pairs")).alias("p1"))
    unknown = stored(words.groupBy("lang").agg(mass(F.col("p1")).alias("unknown")))
    totals = kind(FIRST).groupBy(F.col("x").alias("b")).agg(F.sum("n").alias("total"))
    pairs = kind(PAIR).join(facts, "lang").select(F.col("x").alias("b"), F.col("y").alias("c"), "n", cut(2, "m").alias("cut")).join(totals, "b").withColumn("part", F.col("cut") / F.col("total"))
    pairs = stored(pairs.select("b", "c", "n", "part"))
    masses = stored(pairs.groupBy("b").agg(mass(F.col("part")).alias("g2")))
    whole = pairs.join(masses, "b").join(words.select("c", "p1"), "c").withColumn("p2", F.col("part") + F.exp("g2") * F.col("p1"))
    whole = stored(whole.select("b", "c", "n", "p2", (F.log("p2") - F.col("g2") - F.log("p1")).alias("e2")), large=True)
    dropped(pairs)

    three = kind(TRIGRAM).join(facts, "lang").select(F.col("x").alias("a"), F.col("y").alias("b"), F.col("z").alias("c"), "n", cut(3, "n").alias("cut"))
    three = three.join(whole.select(F.col("b").alias("a"), F.col("c").alias("b"), F.col("n").alias("total")), ["a", "b"])
    three = stored(three.select("a", "b", "c", "n", (F.col("cut") / F.col("total")).alias("part")), large=True)
    back = stored(three.groupBy("a", "b").agg(mass(F.col("part")).alias("g3")))
    read()
    partly = stored(three.join(back, ["a", "b"]), large=True)
    dropped(three)

    zero = F.lit(0).cast("long")
    one = words.join(masses.withColumnRenamed("b", "c"), "c", "full")
    one = one.select(F.col("c"), zero, zero, F.lit(1), F.coalesce(F.log("p1"), F.lit(0.0)) + F.coalesce("g2", F.lit(0.0)), F.coalesce("n", F.lit(1 << 40)))
    two = whole.join(back.select(F.col("a").alias("b"), F.col("b").alias("c"), "g3"), ["b", "c"], "left")
    two = two.select("b", "c", zero, F.lit(2), F.col("e2") + F.coalesce("g3", F.lit(0.0)), "n")
    top = partly.join(whole.select("b", "c", "p2"), ["b", "c"])
    e3 = F.log(F.col("part") + F.exp("g3") * F.col("p2")) - F.col("g3") - F.log("p2")
    top = top.select("a", "b", "c", F.lit(3), e3, "n")
    out = [stored(rows.toDF("x", "y", "z", "o", "weight", "n").select(_key("x", "y", "z", "o").alias("key"), "weight", "n"), large=True) for rows in (one, two, top)]
    for table in (last, facts, masses, whole, back, partly):
        dropped(table)
    return out, unknown


def most_frequent(model: DataFrame, most: int = HOT) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and weights of at most ``most`` n-grams, the most frequent ones."""
    step = F.floor(F.log2("n") * 16).cast("int").alias("step")
    room, least = most, None
    for row in model.groupBy(step).agg(F.count("*").alias("many"), F.min("n").alias("least")).orderBy(F.desc("step")).collect():  # at most 16 * 63 rows
        room -= row["many"]
        if room < 0:
            break
        least = row["least"]
    own = model.filter(F.col("n") >= least).select("key", "weight").toPandas() if least else None
    keys, weights = (own["key"].to_numpy().view(np.uint64), own["weight"].to_numpy()) if own is not None else (np.zeros(0, np.uint64), np.zeros(0))
    order = np.argsort(keys)
    return keys[order], weights[order]


def spelling_of(stats: DataFrame) -> np.ndarray:
    """Log-probabilities of a byte after another one: at most 65,536 numbers."""
    n = np.zeros((256, 256))
    for code, count in stats.filter(F.col("kind") == LETTERS).groupBy("x").agg(F.sum("n")).collect():
        n[code >> 8, code & 255] = count
    base = (n.sum(axis=0) + 1) / (n.sum() + 256)
    kinds = (n > 0).sum(axis=1, keepdims=True) + 1
    return np.log((n + kinds * base) / (n.sum(axis=1, keepdims=True) + kinds))


class Table:
    """Weights by key; a bitmap of the keys' upper bits tells most others apart at once."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.weights = keys[order], weights[order]
        bits = max(8, (16 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.maybe = np.zeros(1 << bits, dtype=bool)
        self.maybe[(keys >> self.shift).astype(np.int64)] = True

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in ``wanted`` of keys that are there, their weights)."""
        at = np.flatnonzero(self.maybe[(wanted >> self.shift).astype(np.int64)])
        if not len(at):
            return at, np.zeros(0)
        own = wanted[at]
        i = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
        same = self.keys[i] == own
        return at[same], self.weights[i[same]]


TRAVEL = "shard int, kind int, refs binary, sizes binary, keys binary, less binary, base binary"
#: Keys of the model that travel in one row.
TOGETHER = 1 << 16
NAMES = [f.split()[0] for f in TRAVEL.split(", ")]


def packed(model: DataFrame, shards: int) -> DataFrame:
    """The model (key, weight) as TRAVEL rows of kind 0: keys, and weights in ``less``, of one shard."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def out() -> Iterator[pa.RecordBatch]:
            keys, weights = (np.concatenate(x) for x in zip(*held, strict=True))
            shard = (keys % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            ends = np.searchsorted(shard[order], np.arange(shards + 1))
            cuts = [(int(s), order[i : min(i + TOGETHER, ends[s + 1])]) for s in np.flatnonzero(np.diff(ends)) for i in range(ends[s], ends[s + 1], TOGETHER)]
            none = pa.nulls(len(cuts), pa.binary())
            own = [pa.array([x[k].tobytes() for _, k in cuts], pa.binary()) for x in (keys, weights)]
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in cuts], pa.int32()), pa.array([0] * len(cuts), pa.int32()), none, none, *own, none], names=NAMES)
            held.clear()

        for batch in batches:
            held.append((np.asarray(batch.column("key")).view(np.uint64), np.asarray(batch.column("weight")).astype(np.float32)))
            if sum(len(x[0]) for x in held) >= 16 * TOGETHER:
                yield from out()
        if sum(len(x[0]) for x in held):
            yield from out()

    return model.select("key", "weight").mapInArrow(handing_back(rows), TRAVEL)


def travelling(texts: DataFrame, hot: tuple[np.ndarray, np.ndarray], spelling: np.ndarray, shards: int) -> DataFrame:
    """TRAVEL rows of documents: for each batch and shard the n-grams that aren't ``hot``, document by document. texts: ref, lang, text, unknown.

    base holds what is known at once: log-probabilities, tokens and one row for
    each document; less what a known word will replace.
    """
    shared = texts.sparkSession.sparkContext.broadcast((*hot, spelling))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, weights, letters = shared.value
        hot = Table(keys, weights)
        with np.errstate(over="ignore"):
            for nth, batch in enumerate(batches):
                refs = np.asarray(batch.column("ref"))
                own = Read(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("lang").to_pylist())
                doc = np.repeat(np.arange(len(refs)), own.size)
                plain = own.spelled(letters)[own.seq] + np.asarray(batch.column("unknown"))[doc]
                plain[own.starts] = 0.0
                w = own.words
                wanted, less = np.empty((len(w), 3), dtype=np.uint64), np.zeros((len(w), 3), dtype=np.float32)
                wanted[:, 0], wanted[1:, 1], wanted[2:, 2], less[:, 0] = key_of(w), key_of(w[:-1], w[1:]), key_of(w[:-2], w[1:-1], w[2:]), plain
                within = np.ones((len(w), 3), dtype=bool)
                within[own.starts, 1:] = False
                within[1:][own.starts[:-1], 2] = False
                wanted, less, of = wanted[within], less[within], np.repeat(doc, 3)[within.ravel()]
                there, weight = hot.find(wanted)
                known = np.bincount(doc, weights=plain, minlength=len(refs)) + np.bincount(of[there], weights=weight - less[there], minlength=len(refs))
                rest = np.ones(len(wanted), dtype=bool)
                rest[there] = False
                wanted, of, less = wanted[rest], of[rest], less[rest]
                shard = (wanted % np.uint64(shards)).astype(np.uint16 if shards < 1 << 16 else np.int64)
                order = np.argsort(shard, kind="stable")  # by shard, then by document
                wanted, of, less, shard = wanted[order], of[order], less[order], shard[order]
                ends = np.searchsorted(shard, np.arange(shards + 1))
                base = np.stack([known, own.size - 1.0, np.ones(len(refs))])
                first = nth % shards
                out = []
                for s in np.flatnonzero((np.diff(ends) > 0) | (np.arange(shards) == first)):
                    k = slice(ends[s], ends[s + 1])
                    size = np.bincount(of[k], minlength=len(refs))
                    some = size > 0 if s != first else np.ones(len(refs), dtype=bool)
                    out.append((int(s), 1, refs[some].tobytes(), size[some].astype(np.uint32).tobytes(), wanted[k].tobytes(), less[k].tobytes(), base.tobytes() if s == first else None))
                types = (pa.int32(), pa.int32(), *[pa.binary()] * 5)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names=NAMES)

    return texts.select("ref", "lang", "text", "unknown").mapInArrow(handing_back(rows), TRAVEL)


def met(rows: DataFrame, shards: int) -> DataFrame:
    """(ref, log_p, n_tokens, n_rows) from TRAVEL rows of documents and of the model, shard by shard; still to be summed by ref."""

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        table, stale = Table(np.zeros(0, np.uint64), np.zeros(0)), False
        for batch in batches:
            kind = np.asarray(batch.column("kind"))
            for i, j in zip(*(lambda cuts: (cuts[:-1], cuts[1:]))(np.concatenate([[0], np.flatnonzero(np.diff(kind)) + 1, [len(kind)]])), strict=True):
                if i == j:
                    continue
                if kind[i] == 0:
                    if not stale:  # a new shard begins: the one before is done with
                        held, stale = [], True
                    both = (batch.column(c).slice(i, j - i).to_pylist() for c in ("keys", "less"))
                    held += [(np.frombuffer(k, dtype=np.uint64), np.frombuffer(w, dtype=np.float32)) for k, w in zip(*both, strict=True)]
                    continue
                if stale:
                    table, held, stale = Table(*(np.concatenate(x) for x in zip(*held, strict=True))), [], False
                columns = [batch.column(c).slice(i, j - i).to_pylist() for c in ("refs", "sizes", "keys", "less", "base")]
                out = []
                for refs, sizes, wanted, less, base in zip(*columns, strict=True):
                    refs, sizes = np.frombuffer(refs, dtype=np.int64), np.frombuffer(sizes, dtype=np.uint32)
                    there, weight = table.find(np.frombuffer(wanted, dtype=np.uint64))
                    of = np.searchsorted(np.cumsum(sizes), there, side="right")
                    own = np.zeros((3, len(refs))) if base is None else np.frombuffer(base).reshape(3, -1).copy()
                    own[0] += np.bincount(of, weights=weight - np.frombuffer(less, dtype=np.float32)[there], minlength=len(refs))
                    some = own.any(axis=0)
                    out.append((refs[some], *own[:, some]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["ref", "log_p", "n_tokens", "n_rows"])

    dealt = rows.repartition(shards, "shard").sortWithinPartitions("shard", "kind")
    return dealt.mapInArrow(handing_back(match), "ref bigint, log_p double, n_tokens double, n_rows double")


def scored(texts: DataFrame, tables: list[DataFrame], unknown: DataFrame, spelling: np.ndarray) -> DataFrame:
    """(ref, log_p, n_tokens) of each ref in texts (ref, lang, text); rows that share a ref are one. The model's tables are removed."""
    spark = texts.sparkSession
    model = reduce(DataFrame.unionByName, tables)
    hot = most_frequent(model)
    shards = max(2 * spark.sparkContext.defaultParallelism, -(-model.count() // SHARD_KEYS))
    own = stored(packed(model, shards), large=True)
    for table in tables:
        dropped(table)
    known = texts.join(unknown, "lang", "left").withColumn("unknown", F.coalesce("unknown", F.lit(0.0)))
    done = None
    for nth in range(SLICES):
        slice_ = travelling(known.filter(F.pmod("ref", F.lit(SLICES)) == nth), hot, spelling, shards)
        sums = met(own.unionByName(slice_), shards).groupBy("ref").agg(F.sum("log_p").alias("log_p"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_rows").alias("n"))
        table = stored(sums.select("ref", (F.col("log_p") / F.col("n")).alias("log_p"), (F.col("n_tokens") / F.col("n")).alias("n_tokens")), large=True)
        done = table if done is None else done.unionByName(table)
    dropped(own)
    return done


def held_out(known: DataFrame) -> DataFrame:
    """``known`` (mark, lang, ...) with held: whether a text is in the fold that is measured and not counted.

    The text with the smallest mark of a language is held out and the one with
    the largest is counted, so that any language with two texts has both.
    """
    ends = stored(known.groupBy("lang").agg(F.min("mark").alias("first"), F.max("mark").alias("last")))  # a row a language
    held = ((F.pmod("mark", F.lit(FOLDS)) == 0) | (F.col("mark") == F.col("first"))) & (F.col("mark") != F.col("last"))
    return known.join(ends, "lang").withColumn("held", held).drop("first", "last")


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, id, mark, lang, ref, text): mark is a hash of the text, ref one of doc_id, language and text."""
    own = docs.select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64(text_of()).alias("mark"), F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), text_of().alias("text"))
    return own.withColumn("ref", F.xxhash64("id", "mark", "lang"))


def trained(full: DataFrame, known: DataFrame) -> tuple[list[DataFrame], DataFrame, np.ndarray]:
    """model_of and spelling_of the trusted texts that aren't held out. full: keyed texts, known: (ref, n_bytes, held) of the trusted ones."""
    counted = stored(known.filter("NOT held").select("ref", "n_bytes"))
    n_bytes = counted.agg(F.sum("n_bytes")).first()[0] or 0
    shards = max(full.sparkSession.sparkContext.defaultParallelism, -(-n_bytes // (6 * SHARD_TRIGRAMS)))
    some = lambda n: full.filter(F.pmod("ref", F.lit(COUNTS)) == n).join(counted.select("ref").distinct(), "ref", "left_semi")
    texts = [stored(some(n).select("lang", "text"), large=True) for n in range(COUNTS)]
    parts = [stored(statistics(reduce(DataFrame.unionByName, texts), shards, n, COUNTS), large=True) for n in range(COUNTS)]
    for table in (counted, *texts):
        dropped(table)
    stats = reduce(DataFrame.unionByName, parts)
    spelling = spelling_of(stats)
    model, unknown = model_of(stats, lambda: [dropped(table) for table in parts])
    return model, unknown, spelling


def classify(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """(doc_id, lang, n_bytes, n_tokens, perplexity, score, threshold, kept) for each row of ``docs``.

    trusted: doc_ids of trusted documents. perplexity is per token (words,
    punctuation and the end) of the text, score the same with PRIOR_WORDS tokens of
    average trusted text. The average and the threshold are those of held-out
    trusted text; a language with a single trusted text is measured on that one.
    Where a language has no trusted text there is no threshold and everything is
    kept; null texts and texts without bytes have no perplexity and are not kept.
    A missing language is one. Equal texts of a language score equally but for
    rounding, repeated rows as one.
    """
    small_batches(docs.sparkSession, 3000, 3 << 20)  # n-grams of many documents travel together
    own = keyed(docs)
    full = own.filter("text <> ''")
    facts = stored(own.select("doc_id", "id", "mark", "lang", "ref", F.octet_length("text").cast("long").alias("n_bytes")))
    good = trusted.select(F.col("doc_id").alias("id")).filter("id IS NOT NULL").distinct()
    known = stored(held_out(facts.filter("n_bytes > 0").join(good, "id", "left_semi")))
    model, unknown, spelling = trained(full, known)
    sums = scored(full.select("ref", "lang", "text"), model, unknown, spelling).withColumn("log_p", F.round("log_p", 6))

    measured = lambda own, c: F.coalesce(own(F.when(F.col("held"), F.col(c))), own(c))
    known = stored(known.select("lang", "ref", "held").join(sums, "ref"))
    average = known.groupBy("lang").agg((measured(F.sum, "log_p") / measured(F.sum, "n_tokens")).alias("mean"))  # a row a language
    prior = F.when(F.col("mean").isNull(), 0).otherwise(PRIOR_WORDS)
    score = F.exp(-(F.col("log_p") + F.coalesce("mean", F.lit(0.0)) * prior) / (F.col("n_tokens") + prior))
    quantile = lambda c: F.percentile_approx(c, F.lit(QUANTILE), F.lit(10_000))
    limits = known.join(average, "lang").withColumn("score", score).groupBy("lang").agg(measured(quantile, "score").alias("threshold"), F.first("mean").alias("mean"))
    limits = stored(limits)
    judged = facts.join(sums, "ref", "left").join(limits, "lang", "left").withColumn("score", score)
    kept = F.col("score").isNotNull() & (F.col("threshold").isNull() | (F.col("score") <= F.col("threshold")))
    perplexity = F.exp(-F.col("log_p") / F.col("n_tokens"))
    return judged.select("doc_id", "lang", "n_bytes", F.col("n_tokens").cast("long").alias("n_tokens"), perplexity.alias("perplexity"), "score", "threshold", kept.alias("kept"))
