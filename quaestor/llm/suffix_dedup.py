"""Removal of byte strings that occur more than once, by sorted suffixes.

Not every suffix has to be sorted. In each 200-byte window the least hash of
its 100-byte grams marks an anchor, so equal windows have an anchor at the
same place. Only suffixes that start at anchors with a repeated gram are
ordered, together with what stands before them read backwards: two windows
around such anchors are equal exactly if both orders keep them together for
long enough. Windows with less than 200 bytes have no part in anything.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import arrow_udf

from quaestor.llm.suffix_sort import deep_shallow
from quaestor.llm.tables import free_name, pin, read_table, with_row_id
from quaestor.llm.words import BLOCK, _tables, mix

WINDOW = 200  # bytes of the shortest string that goes
GRAM = WINDOW // 2
GROUP = 4096  # different contexts of a gram that one task orders at once; larger groups are divided, see _divided
BATCH = 20_000  # strings that are sorted together, about

_SPAN = pa.struct([("from", pa.int64()), ("to", pa.int64())])
KEPT_TYPE = "struct<spans:array<struct<from:bigint,to:bigint>>,kept:binary>"


def _sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """Least value of each run of ``size`` values."""
    n = len(values)
    padded = np.full((-(-n // size) + 1) * size, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    rows = padded.reshape(-1, size)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - size + 1], ahead[size - 1:n])


def anchors_of(data: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor places and gram hashes of several texts that lie one after the other; windows never cross texts."""
    n, width = len(data), window - gram + 1
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    up, down = _tables(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    hashes = mix((sums[gram:] - sums[:-gram]) * down[:n - gram + 1]) >> np.uint64(1)
    least = _sliding_min(hashes, width)  # by start of window
    inside = np.zeros(n + 1, np.int8)
    for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if end - begin >= window:
            inside[begin:end - window + 1] = 1
    least[inside[:len(least)] == 0] = 0
    # A place is an anchor if one of the windows around it has its hash as the least one.
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    most = np.iinfo(np.uint64).max - _sliding_min(np.iinfo(np.uint64).max - padded, width)
    places = np.flatnonzero(most == hashes)
    return places, hashes[places]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def _texts(batch: pa.Array) -> list[bytes]:
    return [t or b"" for t in batch.cast(pa.large_binary()).to_pylist()]


def _text_anchors(text: bytes, places: list[int], hashes: list[int], window: int, gram: int) -> Iterator[tuple[int, int | None, int]]:
    """Place, gram and context of each anchor. Of a context that the text holds several times the first two places are
    enough; what it covers is known and follows as begin, null and end."""
    before = window - gram
    contexts = [xxhash.xxh3_64_intdigest(text[max(0, p - before):p + window], min(p, before)) - (1 << 63) for p in places]
    if len(set(hashes)) == len(hashes):
        yield from zip(places, hashes, contexts, strict=True)
        return
    found: dict[tuple[int, int], list[int]] = {}
    for place, value, context in zip(places, hashes, contexts, strict=True):
        found.setdefault((value, context), []).append(place)
    for (value, context), at in found.items():
        yield from ((p, value, context) for p in at[:2])
    covered = [(max(0, p - before), min(len(text), p + window)) for at in found.values() if len(at) > 1 for p in at]
    yield from ((begin, None, end) for begin, end in _merged(covered))


def _anchor_rows(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Anchors of texts, in runs of about a megabyte; longer texts in blocks that overlap by a window."""
    for batch in batches:
        owners, found, run, size = [], [], [], 0

        def flush() -> None:
            data = np.frombuffer(b"".join(t for _, t in run), np.uint8)
            offsets = np.cumsum([0, *(len(t) for _, t in run)])
            places, hashes = anchors_of(data, offsets, window, gram)
            bounds = np.searchsorted(places, offsets).tolist()
            for (i, text), first, last, offset in zip(run, bounds, bounds[1:], offsets.tolist()):
                rows = list(_text_anchors(text, (places[first:last] - offset).tolist(), hashes[first:last].tolist(), window, gram))
                owners.extend([i] * len(rows))
                found.extend(rows)
            run.clear()

        def out() -> pa.RecordBatch:
            pos, grams, contexts = zip(*found, strict=True) if found else ((), (), ())
            made = pa.record_batch({"row_id": batch.column(0).take(pa.array(owners, pa.int64())), "pos": pa.array(pos, pa.int64()),
                                    "gram": pa.array(grams, pa.int64()), "context": pa.array(contexts, pa.int64())})
            owners.clear()
            found.clear()
            return made

        for i, value in enumerate(batch.column(1).cast(pa.large_binary())):
            text = value.as_py() or b""
            if len(text) > BLOCK:
                chosen: dict[int, int] = {}
                for start in range(0, len(text), BLOCK):
                    block = np.frombuffer(text[start:start + BLOCK + window - 1], np.uint8)
                    places, hashes = anchors_of(block, np.array([0, len(block)]), window, gram)
                    chosen |= zip((places + start).tolist(), hashes.tolist(), strict=True)
                rows = list(_text_anchors(text, list(chosen), list(chosen.values()), window, gram))
                owners.extend([i] * len(rows))
                found.extend(rows)
            elif len(text) >= window:
                run.append((i, text))
                size += len(text)
                if size > BLOCK:
                    flush()
                    size = 0
                    yield out()
        flush()
        yield out()


def _around_rows(batches: Iterator[pa.RecordBatch], window: int, before: int) -> Iterator[pa.RecordBatch]:
    """What stands before and behind each wanted place."""
    for batch in batches:
        texts, places = _texts(batch.column(1)), batch.column(2).to_pylist()
        for start in range(0, len(texts), 256):
            rows = [(i, p, texts[i]) for i in range(start, min(start + 256, len(texts))) for p in places[i]]
            yield pa.record_batch({
                "row_id": batch.column(0).take(pa.array([i for i, _, _ in rows], pa.int64())),
                "pos": pa.array([p["pos"] for _, p, _ in rows], pa.int64()), "hot": pa.array([p["hot"] for _, p, _ in rows], pa.bool_()),
                "key": pa.array([str(p["gram"]) for _, p, _ in rows], pa.string()),
                "before": pa.array([t[max(0, p["pos"] - before):p["pos"]] for _, p, t in rows], pa.binary()),
                "after": pa.array([t[p["pos"]:p["pos"] + window] for _, p, t in rows], pa.binary())})


def _repeats(keys: np.ndarray, before: list[bytes], after: list[bytes], low: np.ndarray, high: np.ndarray,
             window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries with repeated windows, and where the first of these begins and the last ends, counted from the anchor.

    A window ``d`` bytes ahead of its anchor is repeated if another entry of
    the key shares these ``d`` bytes and the ``window - d`` bytes behind. Both
    are classes of the two suffix orders, cut where neighbours share less.
    """
    n = len(keys)
    backwards, ahead_shared = deep_shallow([b[::-1] for b in before], keys)
    forwards, behind_shared = deep_shallow(after, keys)
    ahead = np.fromiter(map(len, before), np.int64, n)
    behind = np.fromiter(map(len, after), np.int64, n)
    first, last = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    classes = np.zeros((2, n), np.int64)
    for d in range(int(low.min()), int(high.max())):
        classes[0, backwards] = np.cumsum(ahead_shared < d)
        classes[1, forwards] = np.cumsum(behind_shared < window - d)
        fits = np.flatnonzero((ahead >= d) & (behind >= window - d) & (low <= d) & (d < high))
        pair = classes[0, fits] * (n + 1) + classes[1, fits]
        order = np.argsort(pair, kind="stable")
        same = pair[order][1:] == pair[order][:-1]
        hit = fits[order[np.r_[same, False] | np.r_[False, same]]] if len(order) else fits
        last[hit] = d
        first[hit[first[hit] < 0]] = d
    found = np.flatnonzero(first >= 0)
    return found, -last[found], window - first[found]


def _sorted_groups(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Spans from entries that come sorted by key; a batch is cut where the key changes, so memory is bounded."""
    def settle(table: pa.Table) -> pa.RecordBatch:
        keys = table["key"].combine_chunks().dictionary_encode().indices.to_numpy()
        found, begin, end = _repeats(keys, table["before"].to_pylist(), table["after"].to_pylist(),
                                     table["low"].to_numpy(), table["high"].to_numpy(), window)
        at = table["pos"].to_numpy()[found]
        return pa.record_batch({"row_id": table["row_id"].combine_chunks().take(pa.array(found)),
                                "from": pa.array(at + begin), "to": pa.array(at + end)})

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += len(batch)
        if rows >= BATCH:
            table = pa.Table.from_batches(held)
            keys = table["key"].to_numpy()
            cut = int(np.flatnonzero(keys == keys[-1])[0])
            if cut:
                yield settle(table[:cut])
            held, rows = table[cut:].to_batches(), len(table) - cut
    if rows:
        yield settle(pa.Table.from_batches(held))


def _settled(entries: DataFrame, window: int) -> DataFrame:
    kind = entries.schema["row_id"].dataType.simpleString()
    return (entries.select("row_id", "pos", "key", "before", "after", "low", "high").repartition("key").sortWithinPartitions("key")
            .mapInArrow(lambda batches: _sorted_groups(batches, window), f"row_id {kind}, from bigint, to bigint"))


def _divided(entries: DataFrame, window: int, group: int) -> Iterator[DataFrame]:
    """Spans from entries whose groups are too large for one task.

    A key stands for windows that begin ``low`` to ``high - 1`` bytes ahead of
    the anchor. Each half of that range has a longer text in common, which is
    the next key, and needs less around it, so more contexts are equal. Equal
    contexts are settled by counting, small groups by sorting, the rest is
    halved again; with one place left the key is the whole window.
    """
    while True:
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        halves = F.array(F.struct(F.col("low").alias("low"), middle.alias("high")), F.struct(middle.alias("low"), F.col("high").alias("high")))
        half = (entries.withColumn("_half", F.explode(halves)).withColumns({"low": F.col("_half.low"), "high": F.col("_half.high")})
                .where((F.col("low") < F.col("high")) & (F.length("before") >= F.col("low"))
                       & (F.length("after") >= window - F.col("high") + 1)).drop("_half"))

        def ending(size: Column) -> Column:
            return F.when(size > 0, F.substring(F.col("before"), F.greatest(F.length("before") - size, F.lit(0)) + 1, size)).otherwise(F.lit(b""))

        cut = half.withColumns({
            "key": F.md5(F.concat(F.col("key").cast("binary"), F.col("low").cast("string").cast("binary"), F.lit(b":"), ending(F.col("low")),
                                  F.substring(F.col("after"), F.lit(1), window - F.col("high") + 1))),
            "before": ending(F.col("high") - 1), "after": F.substring(F.col("after"), F.lit(1), window - F.col("low"))})
        cut = pin(cut.withColumn("context", F.md5(F.concat(F.length("before").cast("string").cast("binary"), F.lit(b":"), "before", "after"))),
                  "suffix-halves")
        contexts = pin(cut.groupBy("key", "context").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row_id", "pos")).alias("at")),
                       "suffix-contexts")
        repeated = contexts.where("n > 1").select("key", "context")
        yield (cut.join(repeated, ["key", "context"])
               .select("row_id", (F.col("pos") - F.length("before")).alias("from"), (F.col("pos") + F.length("after")).alias("to")))
        sizes = contexts.groupBy("key").agg(F.count(F.lit(1)).alias("_size")).where("_size > 1")
        chosen = contexts.join(sizes, "key").select("key", "context", "_size", "at.*")
        entries = pin(cut.join(chosen, ["key", "context", "row_id", "pos"]).drop("context"), "suffix-entries")
        yield _settled(entries.where(F.col("_size") <= group), window)
        entries = entries.where(F.col("_size") > group).drop("_size")
        if entries.isEmpty():
            return


def repeated_spans(docs: DataFrame, text: str = "text", window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """``docs`` with ``spans`` (byte ranges that repeated strings of ``window`` bytes cover, in order and apart) and ``kept`` (the other bytes).

    Each repeat counts wherever it starts, also in the same text; overlapping
    ones too. Null counts as an empty text; texts shorter than the window stay
    whole; equal rows are different texts that hold the same strings, so both
    lose them. Texts of any length are read in blocks. Columns of ``docs``
    called ``spans`` or ``kept`` keep their names, the new ones get longer ones.
    """
    gram, before = window // 2, window - window // 2
    given = docs
    docs, key = with_row_id(given, "suffix-docs")
    kind = docs.schema[key].dataType.simpleString()
    texts = docs.select(F.col(key).alias("row_id"), F.col(text).alias("text"))

    @arrow_udf(KEPT_TYPE)
    def cut(values: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for value, found in zip(values.cast(pa.large_binary()), spans.to_pylist(), strict=True):
            body = value.as_py() or b""
            merged = _merged([(max(0, s["from"]), min(len(body), s["to"])) for s in found or ()])
            edges = [0, *(e for s in merged for e in s), len(body)]
            out.append({"spans": [{"from": f, "to": t} for f, t in merged],
                        "kept": b"".join(body[f:t] for f, t in zip(edges[::2], edges[1::2], strict=True))})
        return pa.array(out, pa.struct([("spans", pa.list_(_SPAN)), ("kept", pa.binary())]))

    found = pin(texts.where(F.octet_length("text") >= window).mapInArrow(
        lambda b: _anchor_rows(b, window, gram), f"row_id {kind}, pos bigint, gram bigint, context bigint"), "suffix-anchors")
    anchors = found.where(F.col("gram").isNotNull())
    grams = anchors.groupBy("gram").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("gram")
    shared = pin(anchors.join(grams, "gram", "left_semi"), "suffix-shared")
    contexts = pin(shared.groupBy("gram", "context").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row_id", "pos")).alias("at")),
                   "suffix-contexts")
    spans = [found.where(F.col("gram").isNull()).select("row_id", F.col("pos").alias("from"), F.col("context").alias("to")),
             shared.join(contexts.where("n > 1").select("gram", "context"), ["gram", "context"])
             .select("row_id", (F.col("pos") - before).alias("from"), (F.col("pos") + window).alias("to"))]
    sizes = contexts.groupBy("gram").agg(F.count(F.lit(1)).alias("_size")).where("_size > 1")
    wanted = (contexts.join(sizes, "gram").select("at.row_id", F.struct("at.pos", "gram", (F.col("_size") > group).alias("hot")).alias("_place"))
              .groupBy("row_id").agg(F.collect_list("_place").alias("places")))
    entries = pin(texts.join(wanted, "row_id").select("row_id", "text", "places").mapInArrow(
        lambda b: _around_rows(b, window, before), f"row_id {kind}, pos bigint, hot boolean, key string, before binary, after binary")
                  .withColumns({"low": F.lit(0), "high": F.lit(before + 1)}), "suffix-entries")
    spans.append(_settled(entries.where("NOT hot"), window))
    large = entries.where("hot").drop("hot")
    if not large.isEmpty():
        spans += _divided(large, window, group)
    every = spans[0]
    for more in spans[1:]:
        every = every.unionByName(more)
    by_row = every.groupBy("row_id").agg(F.collect_set(F.struct("from", "to")).alias("_found")).withColumnRenamed("row_id", "_span_row")
    cut_name, spans_name, kept_name = free_name(docs, "_cut"), free_name(given, "spans"), free_name(given, "kept")
    joined = docs.alias("d").join(by_row, F.col(f"d.{key}") == F.col("_span_row"), "left")
    return (joined.select(*[F.col(f"d.{c}") for c in given.columns], cut(F.col(f"d.{text}"), F.col("_found")).alias(cut_name))
            .select(*given.columns, F.col(f"{cut_name}.spans").alias(spans_name), F.col(f"{cut_name}.kept").alias(kept_name)))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return repeated_spans(docs).select(
        "doc_id", n_bytes.alias("n_bytes"), (n_bytes - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op11_suffix_dedup": op11_suffix_dedup}
ORACLE = {"op11_suffix_dedup": """
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b, strlen(coalesce(text, '')) AS n FROM documents),
w AS MATERIALIZED (SELECT r, p, md5(b[p + 1:p + 200]) AS s FROM (SELECT r, b, unnest(range(0, n - 199)) AS p FROM d)),
hit AS (SELECT r, p FROM w JOIN (SELECT s FROM w GROUP BY s HAVING count(*) > 1) USING (s)),
runs AS (SELECT r, p, sum(CASE WHEN p <= before + 200 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY p) AS run
         FROM (SELECT r, p, lag(p, 1, -1000) OVER (PARTITION BY r ORDER BY p) AS before FROM hit)),
spans AS MATERIALIZED (SELECT r, min(p) AS f, max(p) + 200 AS t FROM runs GROUP BY r, run),
gaps AS (SELECT r, coalesce(lag(t) OVER (PARTITION BY r ORDER BY f), 0) AS a, f AS b FROM spans
         UNION ALL SELECT r, max(t), any_value(n) FROM spans JOIN d USING (r) GROUP BY r),
kept AS (SELECT r, string_agg(hex(d.b[a + 1:gaps.b]), '' ORDER BY a) AS h FROM gaps JOIN d USING (r) GROUP BY r),
counted AS (SELECT r, sum(t - f) AS n_removed, count(*) AS n_spans FROM spans GROUP BY r)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(coalesce(unhex(kept.h), d.b)) AS kept_sha256
FROM d LEFT JOIN counted USING (r) LEFT JOIN kept USING (r)
"""}
