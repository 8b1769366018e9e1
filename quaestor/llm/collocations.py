"""Phrases whose words occur together more often than apart, from count streams in prefix and in suffix order.

Counts come first. A phrase can only be frequent if both phrases of one word
less are, so lengths are counted one after the other, and a bit filter of the
frequent hashes of one length (fixed size, may let too much through, never too
little) keeps most of the next length out of the shuffle. A last pass counts
what has passed by its words, so no result rests on a hash of 64 bits.

The frequent phrases are then laid out as two streams. In prefix order each
phrase follows its own beginnings, in the order of the words read backwards it
follows its own endings; one walk along each stream has all counts of first
parts, of rests and of extensions by a word at hand without looking anything
up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from quaestor.llm.tables import pin, read_table
from quaestor.llm.words import BLOCK, FOLD, Piece, find_words, hash_spans, mix
from quaestor.operators.ordinals import with_ordinal
from quaestor.session import use_checkpoints

LONGEST, LEAST, BEST = 5, 100, 2000
UNKNOWN_LANG = "und"
FILTER_BITS = 1 << 25  # size of the bit filter of one length
HELD = 1 << 20  # hashes that a task gathers before it sums them up
PHRASES = 1 << 18  # phrases that a task gathers with their words
ROWS_OUT = 1 << 15  # rows of a batch with words
SPLITS = 8  # splits of the texts that one task counts together at most

BREAK = np.zeros(256, bool)
BREAK[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
IN_WORD = ~BREAK
IN_WORD[[0x20, 0x09]] = False
OTHER_BYTES = np.random.default_rng(1).permutation(256).astype(np.uint8)  # for a second hash of the same word
STEP = np.uint64(0x9FB21C651E98DF25)
FREQUENT = "lang string, words array<string>, a bigint"


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[list[str], Piece]]:
    """Languages and bytes of the texts in runs of about a megabyte. A longer text is cut where no phrase can cross."""
    langs, parts, size = [], [], 0

    def run() -> tuple[list[str], Piece]:
        data = FOLD[np.frombuffer(b"".join(parts), np.uint8)]
        return langs, Piece(0, data, np.cumsum([0, *map(len, parts)]))

    texts = batch.column(1).cast(pa.large_binary())
    for lang, value in zip(batch.column(0).to_pylist(), texts, strict=True):
        text = value.as_py() or b""
        at = 0
        while at < len(text):
            end = len(text)
            if end - at > BLOCK:
                breaks = np.flatnonzero(BREAK[np.frombuffer(text, np.uint8, BLOCK, at)])
                if len(breaks):
                    end = at + int(breaks[-1]) + 1
                else:
                    far = np.flatnonzero(BREAK[np.frombuffer(text, np.uint8, -1, at)])
                    end = at + int(far[0]) + 1 if len(far) else len(text)
            langs.append(UNKNOWN_LANG if lang is None else lang)
            parts.append(text[at:end])
            size += end - at
            at = end
            if size >= BLOCK:
                yield run()
                langs, parts, size = [], [], 0
    if parts:
        yield run()


class _Grams:
    """Hashes of all phrases of a run, one length after the other."""

    def __init__(self, langs: list[str], piece: Piece, second: bool = False):
        self.words = find_words(piece, IN_WORD[piece.data])
        self.piece = piece
        start = self.words.start
        breaks = np.cumsum(BREAK[piece.data])[start] if len(start) else start
        self.linked = (breaks[1:] == breaks[:-1]) & (self.words.doc[1:] == self.words.doc[:-1])
        data = OTHER_BYTES[piece.data] if second else piece.data
        own = np.array([xxhash.xxh3_64_intdigest(x.encode(), 7 + second) for x in langs], np.uint64)
        self.word = mix(hash_spans(data, start, self.words.end) + own[self.words.doc])

    def levels(self, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Hash by first word, and the first words that have such a phrase."""
        n = len(self.word)
        hashes, fits = self.word, np.ones(n, bool)
        yield hashes, fits
        for size in range(2, longest + 1):
            hashes, fits = hashes.copy(), fits.copy()
            fits[max(0, n - size + 1):] = False
            if n >= size:
                fits[:n - size + 1] &= self.linked[size - 2:]
                hashes[:n - size + 1] = mix(hashes[:n - size + 1] * STEP + self.word[size - 1:])
            yield hashes, fits


def _passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.uint64(64 * len(bits) - 1)
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def _eligible(grams: _Grams, filters: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all phrases of ``size`` words, and the first words of those both of whose shorter phrases pass."""
    before = None
    for k, (hashes, fits) in enumerate(grams.levels(size), 1):
        if k == size:
            if before is not None:
                fits = fits & before & np.r_[before[1:], False]
            return hashes, np.flatnonzero(fits)
        before = fits & _passes(filters[k - 1], hashes) if k == size - 1 else None
    raise ValueError(size)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(inverse, np.concatenate(counts), len(key)).astype(np.int64)


def _count_hashes(batches: Iterator[pa.RecordBatch], filters: list[np.ndarray], size: int) -> Iterator[pa.RecordBatch]:
    keys, counts, held = [], [], 0

    def out() -> pa.RecordBatch:
        key, n = _summed(keys, counts)
        return pa.record_batch({"key": pa.array(key.view(np.int64)), "n": pa.array(n)})

    for batch in batches:
        for langs, piece in _runs(batch):
            hashes, at = _eligible(_Grams(langs, piece), filters, size)
            key, n = np.unique(hashes[at], return_counts=True)
            keys.append(key)
            counts.append(n)
            held += len(key)
            if held > HELD:
                key, n = _summed(keys, counts)
                keys, counts, held = [key], [n], len(key)
                if held > HELD // 2:
                    yield out()
                    keys, counts, held = [], [], 0
    if keys:
        yield out()


def _count_phrases(batches: Iterator[pa.RecordBatch], filters: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Phrases that pass the filter of their length, and as a phrase of no words the number of words."""
    counts: dict[int, int] = {}  # by both hashes, which depend on the language and on the number of words
    phrases: dict[int, tuple[str, str]] = {}
    totals: dict[str, int] = {}

    def batch_of(langs: list[str], words: list[list[str]], n: list[int]) -> pa.RecordBatch:
        return pa.record_batch({"lang": pa.array(langs, pa.string()), "words": pa.array(words, pa.list_(pa.string())), "a": pa.array(n, pa.int64())})

    def out() -> Iterator[pa.RecordBatch]:
        while counts:
            part = [(*phrases.pop(key), n) for key, n in (counts.popitem() for _ in range(min(ROWS_OUT, len(counts))))]
            yield batch_of([r[0] for r in part], [r[1].split(" ") for r in part], [r[2] for r in part])
        yield batch_of(list(totals), [[] for _ in totals], list(totals.values()))
        totals.clear()

    for batch in batches:
        for langs, piece in _runs(batch):
            first, second = _Grams(langs, piece), _Grams(langs, piece, True)
            start, end, doc = first.words.start, first.words.end, first.words.doc
            for lang_of, n in enumerate(np.bincount(doc, minlength=len(langs)).tolist()):
                if n:
                    totals[langs[lang_of]] = totals.get(langs[lang_of], 0) + n
            raw = piece.data.tobytes()
            for size, ((hashes, fits), (others, _)) in enumerate(zip(first.levels(len(filters)), second.levels(len(filters)), strict=True), 1):
                at = np.flatnonzero(fits)
                at = at[_passes(filters[size - 1], hashes[at])]
                at = at[np.lexsort((others[at], hashes[at]))]
                new = np.r_[True, (hashes[at[1:]] != hashes[at[:-1]]) | (others[at[1:]] != others[at[:-1]])][:len(at)]
                begin = np.flatnonzero(new)
                for i, n in zip(at[begin].tolist(), np.diff(np.r_[begin, len(at)]).tolist(), strict=True):
                    key = int(hashes[i]) << 64 | int(others[i])
                    if key not in counts:
                        phrases[key] = langs[doc[i]], " ".join([raw[start[w]:end[w]].decode() for w in range(i, i + size)])
                    counts[key] = counts.get(key, 0) + n
            if len(counts) > PHRASES:
                yield from out()
    yield from out()


def _filter(counts: DataFrame, least: int, bits: int) -> np.ndarray:
    """A bit for each key with enough occurrences; at most ``bits / 64`` rows reach the driver."""
    rows = (counts.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
            .select(F.shiftright(F.col("key").bitwiseAND(F.lit(bits - 1)), 6).alias("at"), F.expr("shiftleft(1L, cast(key & 63L as int))").alias("bit"))
            .groupBy("at").agg(F.bit_or("bit").alias("bits"))).toArrow()
    filled = np.zeros(bits // 64, np.uint64)
    filled[rows["at"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return filled


def _gathered(texts: DataFrame) -> DataFrame:
    """Up to ``SPLITS`` splits of the texts in one task, as long as all cores have one.

    Every task puts out each of its phrases once, so what is counted together
    is shuffled once. Nothing moves: splits are read one after the other.
    """
    splits = texts.rdd.getNumPartitions()
    tasks = max(texts.sparkSession.sparkContext.defaultParallelism, -(-splits // SPLITS))
    return texts.coalesce(tasks) if tasks < splits else texts


def frequent_phrases(docs: DataFrame, lang: str = "lang", text: str = "text", longest: int = LONGEST, least: int = LEAST,
                     bits: int = FILTER_BITS) -> DataFrame:
    """``lang, words, a``, pinned: all phrases of up to ``longest`` words with ``a >= least`` occurrences, and per language
    a row without words for the number of all words."""
    given = _gathered(docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")))
    filters: list[np.ndarray] = []
    for size in range(1, longest + 1):
        known = list(filters)
        counts = given.mapInArrow(lambda batches, known=known, size=size: _count_hashes(batches, known, size), "key bigint, n bigint")
        filters.append(_filter(counts, least, bits))
        if not filters[-1].any():
            break
    counted = given.mapInArrow(lambda batches: _count_phrases(batches, filters), FREQUENT)
    return pin(counted.groupBy("lang", "words").agg(F.sum("a").alias("a")).where((F.col("a") >= least) | (F.size("words") == 0)), "phrases")


def _walk(batches: Iterator[pa.RecordBatch], ahead: dict[int, list[int]]) -> Iterator[pa.RecordBatch]:
    """Counts of all shorter beginnings of each phrase of a sorted stream.

    ``ahead`` has those of the first phrase of each partition, which end in
    earlier ones. ``whole`` says that the next shorter beginning never occurs
    without this phrase.
    """
    opened: list[tuple[str, list[str], int]] | None = None
    for batch in batches:
        rows = []
        for lang, words, a in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if opened is None:
                counts = ahead.get(TaskContext.get().partitionId(), [])
                opened = [(lang, words[:k], n) for k, n in enumerate(counts, 1)]
            while opened and (opened[-1][0] != lang or opened[-1][1] != words[:len(opened[-1][1])]):
                opened.pop()
            if len(words) > 1:
                counts = [n for _, _, n in opened]
                rows.append((lang, words, a, counts, counts[-1] == a))
            opened.append((lang, words, a))
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = (pa.string(), pa.list_(pa.string()), pa.int64(), pa.list_(pa.int64()), pa.bool_())
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["lang", "words", "a", "counts", "whole"])


def _stream(phrases: DataFrame, label: str) -> DataFrame:
    """``lang, words, a, counts, whole`` of all phrases of two words or more, by one walk in the order of ``words``.

    The stream is cut into ranges by the whole phrase, so a word that begins
    a third of all phrases spreads over as many partitions. What is open at
    the beginning of a partition is found from its first phrase.
    """
    use_checkpoints(phrases.sparkSession)
    stream = phrases.repartitionByRange("lang", "words").sortWithinPartitions("lang", "words").checkpoint()
    firsts = stream.withColumn("pid", F.spark_partition_id()).groupBy("pid").agg(F.min(F.struct("lang", "words")).alias("f"))
    begun = (firsts.where(F.size("f.words") > 1)
             .select("pid", F.col("f.lang").alias("lang"), F.explode(F.expr("transform(sequence(1, size(f.words) - 1), k -> slice(f.words, 1, k))")).alias("words"))
             .join(phrases, ["lang", "words"]).groupBy("pid").agg(F.sort_array(F.collect_list(F.struct(F.size("words").alias("k"), "a"))).alias("open")))
    ahead = {r["pid"]: [x["a"] for x in r["open"]] for r in begun.collect()}  # at most one row per partition
    return pin(stream.mapInArrow(lambda batches: _walk(batches, ahead), f"{FREQUENT}, counts array<bigint>, whole boolean"), label)


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", longest: int = LONGEST, least: int = LEAST,
                 best: int = BEST, bits: int = FILTER_BITS) -> DataFrame:
    """The ``best`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Words are separated by spaces and tabs, and phrases don't cross
    ``.,;:!?`` or line ends. A phrase is scored at its weakest cut into a
    first part (``l``) and a rest (``r``): ``floor(1000 * a * n / (l * r))``.
    Phrases that never occur outside of one longer phrase are left out. Ties
    go by ``a``, then by the phrase in byte order.

    A null language is ``und``; null and empty texts have no words. Texts of
    any length are read in blocks, repeated rows count each, no rows give no
    rows, and other columns don't matter. ``1000 * a * n`` has to stay below
    10 to the power 38.
    """
    every = frequent_phrases(docs, lang, text, longest, least, bits)
    totals = every.where(F.size("words") == 0).select("lang", F.col("a").alias("n"))
    phrases = every.where(F.size("words") > 0)
    heads = _stream(phrases, "prefix-order")
    tails = _stream(phrases.withColumn("words", F.reverse("words")), "suffix-order").withColumn("words", F.reverse("words"))
    inside = (heads.where("whole").select("lang", F.expr("slice(words, 1, size(words) - 1)").alias("words"))
              .unionByName(tails.where("whole").select("lang", F.expr("slice(words, 2, size(words) - 1)").alias("words"))).distinct())
    scored = (heads.select("lang", "words", "a", F.col("counts").alias("firsts"))
              .join(tails.select("lang", "words", F.reverse("counts").alias("rests")), ["lang", "words"])
              .join(inside, ["lang", "words"], "left_anti").join(totals, "lang"))
    product = F.lit(1000).cast("decimal(38,0)") * F.col("a").cast("decimal(19,0)") * F.col("n").cast("decimal(19,0)")
    scored = scored.withColumn("product", product.cast("decimal(38,0)"))
    cuts = F.expr("""transform(sequence(1, size(words) - 1), k -> named_struct(
        'score', product div (cast(firsts[k - 1] as decimal(19,0)) * cast(rests[k - 1] as decimal(19,0))), 'k', k, 'l', firsts[k - 1], 'r', rests[k - 1]))""")
    rows = pin(scored.withColumn("cut", F.array_min(cuts))
               .select("lang", F.array_join("words", " ").alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score",
                       (-F.col("cut.score")).alias("_down"), (-F.col("a")).alias("_rarer")), "phrases-scored")
    ranked = with_ordinal(rows, ["_down", "_rarer", "phrase"], ["lang"], "_place")
    return ranked.where(F.col("_place") < best).select(
        "lang", (F.col("_place") + 1).cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


QUERIES = {"op13_collocations": op13_collocations}
ORACLE = {"op13_collocations": r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \x09]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
places AS (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w CROSS JOIN range(1, 6) t(m)),
f AS MATERIALIZED (SELECT lang, w[i:i + m - 1] AS w, count(*) AS a FROM places GROUP BY ALL HAVING count(*) >= 100),
c AS MATERIALIZED (SELECT *, len(w) AS m FROM f WHERE len(w) > 1),
cuts AS (SELECT c.lang, c.w, c.a, c.m, k, x.a AS l, y.a AS r, n, (1000 * c.a::HUGEINT * n::HUGEINT) // (x.a::HUGEINT * y.a::HUGEINT) AS score
         FROM (SELECT *, unnest(range(1, m)) AS k FROM c) c JOIN f x ON x.lang = c.lang AND x.w = c.w[1:k]
         JOIN f y ON y.lang = c.lang AND y.w = c.w[k + 1:m] JOIN totals ON totals.lang = c.lang),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, k) = 1),
inside AS (SELECT DISTINCT lang, w[i:i + s - 1] AS w, a FROM (SELECT *, unnest(range(1, m - s + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS s FROM c))),
ranked AS (SELECT lang, array_to_string(w, ' ') AS phrase, a, l, r, n, score FROM lowest x
           WHERE NOT EXISTS (FROM inside y WHERE y.lang = x.lang AND y.w = x.w AND y.a >= x.a))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l,
       r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM ranked
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) <= 2000
"""}
