"""Phrase collocations by best-first branch-and-bound growth.

A phrase of three words grows from its first two. Whatever word follows, a cut after the first
word scores at most f(first two) / f(first): a bound that the counts of the prefix give alone.
So prefixes wait in a frontier, ordered by bound. A round expands all prefixes of a language
whose bound reaches a threshold - their continuations are counted over all documents, and
those that end in a pair that scores so high itself, which decides whether the pair survives.
Then every phrase that can reach the threshold is known exactly; if a language has enough
survivors there, its list is settled with all ties, else its threshold falls.
"""

from __future__ import annotations

import sys
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cohortwise.llm.common import bit_map, in_map, kept, quoted

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Separators of pieces, the score's scale, the share that makes a phrase a part.
SEPARATORS = b".,;:!?\x0a\x0b\x0c\x0d"
SCALE, PART_OF = 1_000_000, 50
UNKNOWN = "und"
#: Words read before they are counted, and distinct phrases and words held by a task.
CHUNK, HELD, VOCABULARY = 250_000, 1_000_000, 400_000
#: A phrase of up to three words is one number: so many bits a word.
BITS = 21
#: Bits of the maps of expanded prefixes and of open pairs; a map is a quarter of a megabyte.
MAP_BITS = 21
#: A round's threshold lets this many times the wanted pairs score; the factor grows by itself.
WIDTH = 4
#: Scores are counted in steps of this size to place thresholds.
STEP = 500
COUNTS = "lang string, words int, phrase string, n long"
#: Pieces and space: tabs are spaces, every separator becomes a word of its own.
PIECES = bytes(10 if b in SEPARATORS else 32 if b == 9 else b for b in range(256))
BREAK = b"\n"


class Held:
    """Counts of phrases of one language and length: sorted numbers, and runs to be merged."""

    def __init__(self) -> None:
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []
        self.fresh = 0

    def add(self, codes: np.ndarray) -> None:
        found = np.unique(codes, return_counts=True)
        self.runs.append(found)
        self.fresh += len(found[0])
        if self.fresh > max(100_000, len(self.runs[0][0]) // 2):
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.runs) > 1:
            codes, n = (np.concatenate(x) for x in zip(*self.runs))
            order = np.argsort(codes, kind="stable")
            codes, n = codes[order], n[order]
            first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
            self.runs = [(codes[first], np.add.reduceat(n, first))]
        self.fresh = 0
        return self.runs[0]

    def size(self) -> int:
        return sum(len(codes) for codes, _ in self.runs)


class Task:
    """Words of documents as numbers, by language, and the counts of their phrases.

    ``phrases`` gives the phrases of a stream of numbers, in which 0 stands between pieces, as
    (number of words, their numbers packed into one). Counts leave when too many are held.
    """

    def __init__(self, phrases: Callable[["Task", str, np.ndarray], Iterator[tuple[int, np.ndarray]]]) -> None:
        self.phrases = phrases
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[bytes, int] = defaultdict(count().__next__)
        self.numbers[BREAK]
        self.parts: dict[str, list[np.ndarray]] = {}
        self.size = 0
        self.held: dict[tuple[str, int], Held] = defaultdict(Held)
        self.hashes = np.zeros(0, dtype=np.uint64)

    def add(self, lang: str, text: str) -> None:
        # A break on both sides parts documents.
        data = (b"\n" + text.encode().lower().translate(PIECES) + b"\n").replace(BREAK, b" \n ")
        words = [self.numbers[w] for w in data.split(b" ") if w]
        self.parts.setdefault(lang, []).append(np.array(words, dtype=np.int64))
        self.size += len(words)

    def hashed(self) -> np.ndarray:
        """A 64-bit hash of every word met so far, as Spark's ``xxhash64`` gives it."""
        if len(self.hashes) < len(self.numbers):
            new = list(self.numbers)[len(self.hashes):]
            more = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in new), dtype=np.uint64, count=len(new))
            self.hashes = np.concatenate([self.hashes, more])
        return self.hashes

    def tally(self) -> None:
        for lang, parts in self.parts.items():
            for words, codes in self.phrases(self, lang, np.concatenate(parts)):
                if len(codes):
                    self.held[lang, words].add(codes)
        self.parts, self.size = {}, 0

    def full(self) -> bool:
        return len(self.numbers) > VOCABULARY or sum(h.size() for h in self.held.values()) > HELD

    def rows(self) -> Iterator[pa.RecordBatch]:
        vocabulary = pa.array(list(self.numbers), pa.binary())
        for (lang, words), held in self.held.items():
            codes, n = held.merge()
            for at in range(0, len(codes), 50_000):
                part = codes[at:at + 50_000]
                numbers = [part >> (BITS * k) & (2**BITS - 1) for k in reversed(range(words))]
                phrase = pc.binary_join_element_wise(*[vocabulary.take(pa.array(x)) for x in numbers], b" ")
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(part), pa.string()), pa.array(np.full(len(part), words, np.int32)),
                    phrase.cast(pa.string()), pa.array(n[at:at + 50_000].astype(np.int64)),
                ], ["lang", "words", "phrase", "n"])
        self.clear()

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of the columns lang and text."""
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                self.add(lang.as_py(), text.as_py())
                if self.size >= CHUNK or len(self.numbers) > VOCABULARY:
                    self.tally()
                    if self.full():
                        yield from self.rows()
        self.tally()
        yield from self.rows()


def short_phrases(task: Task, lang: str, stream: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Words and pairs."""
    yield 1, stream[stream > 0]
    first, second = stream[:-1], stream[1:]
    inside = (first > 0) & (second > 0)
    yield 2, first[inside] << BITS | second[inside]


def key_of(lang: Column, first: Column, second: Column) -> Column:
    """The number by which a pair is found in a bit map; :func:`grown_phrases` has the same."""
    return F.xxhash64(lang).bitwiseXOR(F.xxhash64(first)).bitwiseXOR(F.shiftrightunsigned(F.xxhash64(second), 1))


def grown_phrases(prefixes: bytes, ends: bytes) -> Callable:
    """Triples that start with an expanded prefix or end in an open pair."""
    def phrases(task: Task, lang: str, stream: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        first, second = stream[:-1], stream[1:]
        inside = (first > 0) & (second > 0)
        hashes = task.hashed()
        keys = hashes[first] ^ (hashes[second] >> np.uint64(1)) ^ np.uint64(xxhash.xxh64_intdigest(lang.encode(), 42))
        wanted = in_map(keys[:-1], prefixes) | in_map(keys[1:], ends)
        at = np.flatnonzero(inside[:-1] & inside[1:] & wanted)
        yield 3, stream[at] << (2 * BITS) | stream[at + 1] << BITS | stream[at + 2]

    return phrases


def count_phrases(phrases: Callable) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    return lambda batches: Task(phrases).run(batches)


def summed(rows: DataFrame, least: int | None = None) -> DataFrame:
    out = rows.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
    return out if least is None else out.where(F.col("n") >= least)


def score(a: str, left: str, right: str) -> Column:
    """floor(SCALE * a * a / (left * right)), exactly: decimals of 38 digits and whole division."""
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    top = (wide(a) * wide(a)).cast("decimal(31,0)") * F.lit(SCALE).cast("decimal(7,0)")
    low = wide(left) * wide(right)
    names = {"top": top.alias("top"), "low": low.alias("low")}
    return F.struct(*names.values())


def floored(pair: Column) -> Column:
    top, low = pair["top"].cast("decimal(38,0)"), pair["low"].cast("decimal(38,0)")
    return F.call_function("div", top, low)


def thresholds(pairs: DataFrame, wanted: int) -> DataFrame:
    """lang and the score that about ``wanted`` of its pairs reach; 0 where it has fewer.

    Scores are counted in ``SCALE / STEP`` steps, so a language's window holds no more rows.
    """
    steps = pairs.groupBy("lang", F.floor(F.col("score") / STEP).alias("step")).agg(F.count("*").alias("m"))
    down = W.partitionBy("lang").orderBy(F.desc("step"))
    reached = steps.withColumn("reached", F.sum("m").over(down))
    enough = F.max(F.when(F.col("reached") >= wanted, F.col("step") * STEP))
    return reached.groupBy("lang").agg(F.coalesce(enough, F.lit(0)).alias("threshold"))


def collocations(
    docs: DataFrame, limit: int = 2000, least: int = 10, lang: str = "lang", text: str = "text",
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``limit`` best phrases.

    Words are runs without space and tab inside pieces, which end at ``.,;:!?`` and at line
    breaks; A-Z are lower-cased, null text is empty, null lang is ``und``. A candidate has two
    or three words and at least ``least`` occurrences ``a``; its score is that of its worst cut
    into parts of ``l`` and ``r`` occurrences. A pair goes if half of its occurrences lie in
    one longer candidate. Ranks go by score, then ``a``, then the phrase, so they have no ties.
    Repeated rows count again. An empty table, or one without candidates, gives no rows; other
    columns are dropped.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.coalesce(F.col(quoted(lang)).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.col(quoted(text)).alias("text"),
    ).where(F.col("text") != "")
    short = kept(summed(texts.mapInArrow(count_phrases(short_phrases), COUNTS)))
    totals = short.where("words = 1").groupBy("lang").agg(F.sum("n").alias("n"))
    single = short.where(f"words = 1 AND n >= {least}").select("lang", "phrase", "n")
    double = short.where(f"words = 2 AND n >= {least}").select("lang", "phrase", F.col("n").alias("a"))
    of = lambda word, n: single.select("lang", F.col("phrase").alias(word), F.col("n").alias(n))
    part = lambda k: F.split_part("phrase", F.lit(" "), F.lit(k))
    pairs = double.withColumn("first", part(1)).withColumn("last", part(2)).join(
        of("first", "l"), ["lang", "first"]
    ).join(of("last", "r"), ["lang", "last"])
    # A prefix can reach no more than a / l, whatever follows.
    pairs = kept(pairs.select(
        "lang", "phrase", "a", "l", "r", floored(score("a", "l", "r")).alias("score"),
        floored(F.struct((F.col("a").cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(7,0)")).alias("top"),
                         F.col("l").cast("decimal(19,0)").alias("low"))).alias("bound"),
        key_of(F.col("lang"), F.col("first"), F.col("last")).alias("key"),
    ))
    count_of = pairs.select("lang", F.col("phrase").alias("two"), F.col("a").alias("n"))
    wide, done, open_ = WIDTH, None, pairs
    while True:
        cuts = kept(thresholds(open_, wide * limit))
        frontier = open_.join(cuts, "lang")
        prefixes = bit_map(frontier.where("bound >= threshold"), "key", MAP_BITS)
        ends = bit_map(frontier.where("score >= threshold"), "key", MAP_BITS)
        grown = texts.join(cuts.select("lang"), "lang", "left_semi") if done is not None else texts
        triples = kept(summed(grown.select("lang", "text").mapInArrow(
            count_phrases(grown_phrases(prefixes, ends)), COUNTS
        ), least))
        split = triples.select(
            "lang", "phrase", F.col("n").alias("a"), part(1).alias("first"), part(3).alias("last"),
            F.concat_ws(" ", part(1), part(2)).alias("head"), F.concat_ws(" ", part(2), part(3)).alias("tail"),
        )
        long = split.join(of("first", "l1"), ["lang", "first"]).join(of("last", "r2"), ["lang", "last"])
        long = long.join(count_of.toDF("lang", "tail", "r1"), ["lang", "tail"]).join(
            count_of.toDF("lang", "head", "l2"), ["lang", "head"]
        )
        cut = lambda k: F.struct(
            floored(score("a", f"l{k}", f"r{k}")).alias("score"), F.lit(k).alias("k"),
            F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"),
        )
        worst = long.select("lang", "phrase", "a", F.least(cut(1), cut(2)).alias("c")).select(
            "lang", "phrase", "a", "c.l", "c.r", "c.score"
        )
        around = split.select("lang", F.explode(F.array("head", "tail")).alias("phrase"), F.col("a").alias("longer"))
        around = around.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
        alive = open_.join(around, ["lang", "phrase"], "left").where(
            F.col("longer").isNull() | (100 * F.col("longer") < PART_OF * F.col("a"))
        ).select(*worst.columns)
        known = kept(alive.union(worst).join(cuts, "lang").where("score >= threshold"))
        settled = cuts.join(known.groupBy("lang").agg(F.count("*").alias("m")), "lang", "left").where(
            (F.col("threshold") == 0) | (F.col("m") >= limit)
        ).select("lang")
        settled = kept(settled)
        found = known.join(settled, "lang", "left_semi").select(*worst.columns)
        done = found if done is None else done.union(found)
        rest = open_.join(settled, "lang", "left_anti")
        if rest.isEmpty():
            break
        open_, wide = kept(rest), wide * 8
    best = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = done.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= limit)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
