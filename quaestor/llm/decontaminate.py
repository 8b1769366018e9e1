"""Benchmark decontamination by winnowed fingerprints, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quaestor.functions.binding import bind
from quaestor.llm.tables import pin, read_table, with_row_id

WINDOW = 13
GRAM = 8
SHARE = 20
FILTER_BITS = (1 << 14, 1 << 22)  # the bit filter's least and largest size: at most 512 KiB, whatever the benchmark's size

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-cased (A-Z only) runs of digits, a-z and non-ASCII characters; empty for null."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), NO_WORD)
    return F.filter(parts, lambda w: w != "")


def _at(values: Column, start: Column, length: int) -> list[Column]:
    return [F.get(values, start + k) for k in range(length)]


def _gram_length(window: int) -> int:
    """Whole short items are their own gram; others use ``GRAM`` words."""
    return GRAM if window == WINDOW else window


def _starts(count: Column, length: int) -> Column:
    """0 to count - length; empty where nothing fits."""
    return F.when(count >= length, F.sequence(F.lit(0), count - length)).otherwise(F.array().cast("array<int>"))


def _grams(hashes: Column, window: int) -> Column:
    """Hash of the gram at each place."""
    size = _gram_length(window)
    return F.transform(_starts(F.size(hashes), size), lambda i: F.xxhash64(F.lit(window), *_at(hashes, i, size)))


def _chosen(grams: Column, start: Column, window: int) -> Column:
    """Offset, inside the window at ``start``, of its least gram; the last one among equals."""
    places = window - _gram_length(window) + 1
    ranked = [F.struct(F.get(grams, start + k).alias("h"), F.lit(-k).alias("k")) for k in range(places)]
    return -(F.least(*ranked) if places > 1 else ranked[0]).getField("k")


def _windows(hashes: Column, grams: Column, starts: Column, window: int) -> Column:
    """(window, start, fingerprint, two hashes of all words) of the windows at ``starts``."""
    def one(s: Column) -> Column:
        words = _at(hashes, s, window)
        return F.struct(F.lit(window).alias("win"), s.alias("start"),
                        F.get(grams, s + _chosen(grams, s, window)).alias("print"),
                        F.xxhash64(F.lit(1), *words).alias("w1"), F.xxhash64(F.lit(2), *words).alias("w2"))
    return F.transform(starts, one)


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """One row per item and window, pinned: ``item_id, win, print, w1, w2``.

    ``win`` is 13, or the item's number of words if that is smaller; items
    without words have no window.
    """
    items = benchmark.select("item_id", _hashes(words_of(F.col("text"))).alias("hashes"))
    items = items.withColumn("win", F.least(F.size("hashes"), F.lit(WINDOW)))

    def all_windows(win: int) -> Column:
        return bind(F.col("hashes"), lambda h: bind(_grams(h, win), lambda g: _windows(h, g, _starts(F.size(h), win), win)))
    rows = F.coalesce(*[F.when(F.col("win") == win, all_windows(win)) for win in range(1, WINDOW + 1)])
    return pin(items.where(F.col("win") > 0).select("item_id", F.explode(rows).alias("w"))
               .select("item_id", "w.win", "w.print", "w.w1", "w.w2").distinct(), "decontaminate-benchmark")


def _filter_words(prints: DataFrame) -> list[int]:
    """A bit for each fingerprint, 16 bits for one if the largest size allows; a fuller filter only lets more through to the join."""
    count = prints.count()
    size = FILTER_BITS[0]
    while size < min(16 * count, FILTER_BITS[1]):
        size *= 2
    place = F.col("print").bitwiseAND(F.lit(size - 1))
    rows = (prints.select(F.shiftright(place, 6).alias("at"), F.expr("shiftleft(1L, cast(print & 63L as int))").alias("bit"))
            .groupBy("at").agg(F.bit_or("bit").alias("bits")).collect())
    filled = [0] * (size // 64)
    for r in rows:
        filled[r["at"]] = r["bits"]
    return filled


def _literal(longs: list[int]) -> Column:
    """An array constant, parsed once when the plan is made."""
    return F.split(F.lit(",".join(map(str, longs))), ",").cast("array<bigint>")


def _maybe(print_: Column, bits: Column, size: int) -> Column:
    word = F.get(bits, F.shiftright(print_.bitwiseAND(F.lit(size - 1)), 6).cast("int"))
    return F.getbit(word, print_.bitwiseAND(F.lit(63))) == 1


def _candidates(hashes: Column, window: int, bits: Column, size: int) -> Column:
    """Windows whose fingerprint may be one of the benchmark's.

    Places whose gram passes the filter come first; only the windows around
    them are looked at, and of those the ones that choose such a gram.
    """
    places = window - _gram_length(window)

    def near(grams: Column) -> Column:
        hit = F.filter(F.sequence(F.lit(0), F.size(grams) - 1), lambda i: _maybe(F.get(grams, i), bits, size))
        last = F.size(hashes) - window
        around = F.flatten(F.transform(hit, lambda i: F.sequence(F.greatest(i - places, F.lit(0)), i)))
        starts = F.filter(F.array_distinct(around), lambda s: s <= last)
        return F.filter(_windows(hashes, grams, starts, window), lambda w: _maybe(w["print"], bits, size))
    none = F.array().cast("array<struct<win:int,start:int,print:bigint,w1:bigint,w2:bigint>>")
    return F.when(F.size(hashes) >= window, bind(_grams(hashes, window), near)).otherwise(none)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``row_id, doc_id, n_words, n_hit, n_items, items, contaminated`` of each row of ``docs(row_id, doc_id, text)``.

    A window is 13 consecutive words of a benchmark item, or all words of a
    shorter one. Its fingerprint is the least hash of its 8-word grams (of the
    whole, for a short item). As a document's window with the same words
    chooses the same gram, every shared span of 13 words meets in the join of
    fingerprints; each hit is then extended to the whole window and compared
    by two hashes of its words. A word inside any such window is hit.
    ``items`` holds the ids of the items with such windows as sorted strings.

    Null and empty texts have no words and are clean. Items without words
    match nothing; an item without id marks words, but is in no list. Repeated
    items count once per id, repeated documents each for themselves.
    """
    windows = benchmark_windows(benchmark)
    known = [r["win"] for r in windows.select("win").distinct().collect()]  # 13 values at most
    filled = _filter_words(windows.select("print").distinct()) if known else []

    def row(words: Column) -> Column:
        def one(hashes: Column) -> Column:
            found = bind(_literal(filled), lambda bits: F.concat(*[
                _candidates(hashes, win, bits, 64 * len(filled)) for win in sorted(known)]))
            return F.struct(F.size(hashes).cast("long").alias("n_words"), found.alias("found"))
        return bind(_hashes(words), one)
    if known:
        scanned = docs.select("row_id", "doc_id", row(words_of(F.col("text"))).alias("r"))
        scanned = pin(scanned.select("row_id", "doc_id", "r.n_words", "r.found"), "decontaminate-scanned")
    else:
        scanned = docs.select("row_id", "doc_id", F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
        return _with_verdict(scanned, None, None)
    hits = scanned.where(F.size("found") > 0).select("row_id", F.explode("found").alias("f")).select("row_id", "f.*")
    distinct = windows.select("win", "print", "w1", "w2").distinct()
    hits = pin(hits.join(distinct, ["win", "print", "w1", "w2"]), "decontaminate-hits")
    spans = hits.groupBy("row_id").agg(F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("win")).alias("end")))).alias("spans"))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("reach")),
        lambda a, s: F.struct((a["n"] + F.greatest(s["end"] - F.greatest(s["start"], a["reach"]), F.lit(0))).cast("long").alias("n"),
                              F.greatest(a["reach"], s["end"]).alias("reach")), lambda a: a["n"])
    owners = windows.where(F.col("item_id").isNotNull())
    items = (hits.select("row_id", "win", "w1", "w2").distinct().join(owners, ["win", "w1", "w2"])
             .select("row_id", F.col("item_id").cast("string").alias("item")).distinct()
             .groupBy("row_id").agg(F.sort_array(F.collect_list("item")).alias("items")))
    return _with_verdict(scanned, spans.select("row_id", covered.alias("n_hit")), items)


def _with_verdict(scanned: DataFrame, hit: DataFrame | None, items: DataFrame | None) -> DataFrame:
    rows = scanned.select("row_id", "doc_id", "n_words")
    if hit is None:
        rows = rows.withColumn("n_hit", F.lit(None).cast("long")).withColumn("items", F.lit(None).cast("array<string>"))
    else:
        rows = rows.join(hit.join(items, "row_id", "left"), "row_id", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return rows.select("row_id", "doc_id", "n_words", n_hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
                       listed.alias("items"), ((n_hit > 0) & (SHARE * n_hit >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated rows; columns and their order stay."""
    rows, row_id = with_row_id(docs, "decontaminate-rows")
    found = contamination(rows.select(F.col(row_id).alias("row_id"), "doc_id", "text"), benchmark)
    bad = found.where("contaminated").select(F.col("row_id").alias(row_id))
    return rows.join(pin(bad, "decontaminate-bad").hint("merge"), row_id, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "text")
    found = contamination(docs, read_table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), "contaminated")


_WORDS = ("list_filter(regexp_extract_all(translate(coalesce(text, ''), '" + UPPER + "', '" + LOWER
          + r"'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')")

QUERIES = {"op5_decontamination": op5_decontamination}
ORACLE = {"op5_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS win, array_to_string(w[s:s + least(len(w), 13) - 1], ' ') AS t
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
wins AS (SELECT DISTINCT win FROM bw),
dw AS (SELECT doc_id, win, s, array_to_string(w[s:s + win - 1], ' ') AS t
       FROM (SELECT doc_id, w, win, unnest(range(1, len(w) - win + 2)) AS s FROM d CROSS JOIN wins WHERE len(w) >= win)),
hits AS (SELECT dw.doc_id, dw.s, dw.win, bw.item_id FROM dw JOIN bw USING (win, t)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
              FROM (SELECT doc_id, unnest(range(s, s + win)) AS p FROM (SELECT DISTINCT doc_id, s, win FROM hits)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)"""}
