"""TF-IDF weights over the distinct texts of every scope.

A scope is the set of rows that are compared with each other, by default one
filing. All keys start with it, and every count is weighted by the number of
copies a text stands for, so copies cost one row from the start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quaestor.functions import text as tx
from quaestor.functions.binding import bind
from quaestor.session import pin

BLOCKS = 64  # blocks of the vocabulary that a text's norms are kept for
BROADCAST_WORDS = 200_000  # words that go to all tasks at most

# English stop words, dropped ahead of the two-word terms.
STOP_WORDS = tuple("""
a about above across after afterwards again against all almost alone along already also although always am among
amongst amoungst amount an and another any anyhow anyone anything anyway anywhere are around as at back be became
because become becomes becoming been before beforehand behind being below beside besides between beyond bill both
bottom but by call can cannot cant co con could couldnt cry de describe detail do done down due during each eg eight
either eleven else elsewhere empty enough etc even ever every everyone everything everywhere except few fifteen fifty
fill find fire first five for former formerly forty found four from front full further get give go had has hasnt have
he hence her here hereafter hereby herein hereupon hers herself him himself his how however hundred i ie if in inc
indeed interest into is it its itself keep last latter latterly least less ltd made many may me meanwhile might mill
mine more moreover most mostly move much must my myself name namely neither never nevertheless next nine no nobody
none noone nor not nothing now nowhere of off often on once one only onto or other others otherwise our ours ourselves
out over own part per perhaps please put rather re same see seem seemed seeming seems serious several she should show
side since sincere six sixty so some somehow someone something sometime sometimes somewhere still such system take ten
than that the their them themselves then thence there thereafter thereby therefore therein thereupon these they thick
thin third this those though three through throughout thru thus to together too top toward towards twelve twenty two un
under until up upon us very via was we well were what whatever when whence whenever where whereafter whereas whereby
wherein whereupon wherever whether which while whither who whoever whole whom whose why will with within without would
yet you your yours yourself yourselves
""".split())


def terms(text: Column) -> Column:
    """Words of two or more characters without stop words."""
    words = F.regexp_extract_all(F.lower(text), F.lit(f"[{tx.WORD}]{{2,}}"), F.lit(0))
    return F.filter(words, lambda w: ~w.isin(*STOP_WORDS))


def _with_pairs(words: Column) -> Column:
    """The words and each two neighbours among them."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(words, pairs)


def _counted(found: Column) -> Column:
    """``term, tf`` of each different term of an array."""
    def runs(ordered: Column) -> Column:
        n = F.size(ordered)
        ends = F.filter(F.sequence(F.lit(1), n), lambda i: (i == n) | (F.get(ordered, i) != F.get(ordered, i - 1)))
        return F.when(n > 0, bind(ends, lambda e: F.transform(e, lambda end, k: F.struct(
            F.get(ordered, end - 1).alias("term"), (end - F.coalesce(F.get(e, k - 1), F.lit(0))).cast("long").alias("tf"))))
        ).otherwise(F.array().cast("array<struct<term:string,tf:bigint>>"))
    return bind(F.sort_array(found), runs)


def term_arrays(texts: DataFrame) -> DataFrame:
    """``texts`` with ``counts``, an array of ``term, tf``. Terms are counted inside their row, without a shuffle or a hash table."""
    return texts.withColumn("counts", bind(terms(F.col("text")), lambda words: _counted(_with_pairs(words))))


def exploded(arrays: DataFrame) -> DataFrame:
    """``(scope, text_id, copies, term, tf)`` from rows with ``counts``."""
    return arrays.select("scope", "text_id", "copies", F.inline("counts"))


def term_counts(texts: DataFrame) -> DataFrame:
    """``(scope, text_id, copies, term, tf)`` from ``(scope, text_id, copies, text)``."""
    return exploded(term_arrays(texts))


def _totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("scope", "term").agg(F.sum(F.col("tf") * F.col("copies")).alias("corpus_tf"), F.sum("copies").alias("df"))


def _cuts(stats: DataFrame, max_features: int, full: bool = False) -> DataFrame:
    """``scope, _cut``, pinned: the count from which on a scope's terms are enough, from a histogram of the counts.

    With ``full`` only of scopes that have so many terms.
    """
    from_top = Window.partitionBy("scope").orderBy(F.desc("corpus_tf"))
    histogram = stats.groupBy("scope", "corpus_tf").agg(F.count(F.lit(1)).alias("_terms"))
    cuts = (histogram.withColumn("_before", F.sum("_terms").over(from_top) - F.col("_terms"))
            .groupBy("scope").agg(F.min(F.when(F.col("_before") < max_features, F.col("corpus_tf"))).alias("_cut"), F.sum("_terms").alias("_all")))
    return pin((cuts.where(F.col("_all") >= max_features) if full else cuts).drop("_all"), "term-cuts")


def _frequent_pairs(pairs: DataFrame, words: DataFrame, cuts: DataFrame) -> DataFrame:
    """Counts of pairs without those that hold a word below its scope's cut: a pair is no more frequent than its words.

    The words from the cut on go to all tasks if they are few enough; else
    all pairs are counted.
    """
    found = pin(words.join(cuts, "scope").where(F.col("corpus_tf") >= F.col("_cut")).select("scope", F.col("term").alias("_word")), "frequent-words")
    if found.count() > BROADCAST_WORDS:
        return pairs
    for name, place in (("_first", 1), ("_second", -1)):
        own = F.broadcast(found.select("scope", F.col("_word").alias(name), F.lit(True).alias(f"_has{name}")))
        pairs = pairs.withColumn(name, F.substring_index("term", " ", place)).join(own, ["scope", name], "left")
    pairs = pairs.join(F.broadcast(cuts), "scope", "left").where(F.col("_cut").isNull() | (F.col("_has_first") & F.col("_has_second")))
    return pairs.select("scope", "text_id", "copies", "term", "tf")


def vocabulary(counts: DataFrame, max_features: int = 5000) -> DataFrame:
    """The most frequent terms of every scope with their document counts; ties go by the term.

    Words are counted first. Where a scope has enough of them, the count of
    the last one is a bound that pairs and the words of pairs have to reach, so most pairs aren't
    moved or stored. A histogram of the counts then tells from which
    count on the terms are enough; only those are sorted. ``term_id`` is the
    rank.
    """
    is_pair = F.contains(F.col("term"), F.lit(" "))
    words = pin(_totals(counts.where(~is_pair)), "word-stats")
    cuts = _cuts(words, max_features, full=True)
    return most_frequent(words, _totals(_frequent_pairs(counts.where(is_pair), words, cuts)), cuts, max_features)


def most_frequent(words: DataFrame, pairs: DataFrame, cuts: DataFrame, max_features: int) -> DataFrame:
    """The vocabulary from counts of words and of pairs; ``cuts`` are those of scopes with enough words."""
    stats = pin(words.unionByName(pairs).join(F.broadcast(cuts), "scope", "left").where(F.col("_cut").isNull() | (F.col("corpus_tf") >= F.col("_cut")))
                .drop("_cut"), "term-stats")
    best = [F.desc("corpus_tf"), F.asc("term")]
    enough = stats.join(_cuts(stats, max_features), "scope").where(F.col("corpus_tf") >= F.col("_cut")).drop("_cut")
    return (enough.withColumn("term_id", F.row_number().over(Window.partitionBy("scope").orderBy(*best)))
            .where(F.col("term_id") <= max_features))


def idf(n_rows: Column, df: Column) -> Column:
    return F.ln((n_rows + 1) / (df + 1)) + 1


def _with_idf(texts: DataFrame, vocab: DataFrame, *columns: str) -> DataFrame:
    """``scope, term, columns, _idf``, pinned: its true size lets a small vocabulary go to the entries, which then stay where they are."""
    sizes = texts.groupBy("scope").agg(F.sum("copies").alias("_rows"))
    return pin(vocab.join(sizes, "scope").select("scope", "term", *columns, idf(F.col("_rows"), F.col("df")).alias("_idf")), "term-idf")


def placed(vocab: DataFrame) -> DataFrame:
    """The vocabulary with ``place``, the number of a term in its scope from the rarest on."""
    return vocab.withColumn("place", (F.row_number().over(Window.partitionBy("scope").orderBy("df", "term_id")) - 1).cast("int"))


def place_vectors(texts: DataFrame, counts: DataFrame, vocab: DataFrame) -> DataFrame:
    """``scope, text_id, terms, xs``: places and weights (not yet of unit length) of each text's terms, from the rarest on."""
    entries = counts.join(_with_idf(texts, vocab, "place"), ["scope", "term"]).select("scope", "text_id", F.struct("place", (F.col("tf") * F.col("_idf")).alias("x")).alias("e"))
    sorted_ = entries.groupBy("scope", "text_id").agg(F.sort_array(F.collect_list("e")).alias("_e"))
    return sorted_.select("scope", "text_id", F.col("_e.place").alias("terms"), F.col("_e.x").alias("xs"))


def weights(texts: DataFrame, counts: DataFrame, vocab: DataFrame) -> DataFrame:
    """Entries ``(scope, text_id, term_id, df, w, mass)`` of unit vectors.

    ``mass`` is the squared weight of an entry and of all rarer terms of its
    text. Texts without any term of the vocabulary have no entries. A window
    holds the terms of one text.
    """
    raw = (counts.join(_with_idf(texts, vocab, "term_id", "df"), ["scope", "term"])
           .select("scope", "text_id", "term_id", "df", (F.col("tf") * F.col("_idf")).alias("_x")))
    own = Window.partitionBy("scope", "text_id").orderBy("df", "term_id")
    upto = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    square = F.col("_x") * F.col("_x")
    return (raw.withColumn("_total", F.sum(square).over(whole)).withColumn("_mass", F.sum(square).over(upto))
            .select("scope", "text_id", "term_id", "df", (F.col("_x") / F.sqrt("_total")).alias("w"),
                    (F.col("_mass") / F.col("_total")).alias("mass")))


def vectors(entries: DataFrame) -> DataFrame:
    """One map from term to weight per text."""
    pairs = F.collect_list(F.struct("term_id", "w"))
    return entries.groupBy("scope", "text_id").agg(F.map_from_entries(pairs).alias("vec"))


def dot(left: Column, right: Column) -> Column:
    """Inner product of two sparse vectors held as maps, in one pass over both."""
    products = F.map_zip_with(left, right, lambda k, x, y: x * y)
    return F.aggregate(F.map_values(products), F.lit(0.0), lambda acc, v: acc + F.coalesce(v, F.lit(0.0)))


def _in_prefix(threshold: float) -> Column:
    return F.col("mass") - F.col("w") * F.col("w") < 1.0 - threshold * threshold + 1e-9


def sketches(entries: DataFrame, threshold: float, blocks: int = BLOCKS) -> DataFrame:
    """``scope, text_id, end, full, rest`` of every text, for bounds on inner products.

    The vocabulary is dealt out to ``blocks``. ``full`` has the norm of the
    text in each block, ``rest`` that of its terms behind its prefix, and
    ``end`` is the place of the prefix's last term in the common order.
    """
    prefix, square = _in_prefix(threshold), F.col("w") * F.col("w")
    parts = entries.groupBy("scope", "text_id", F.pmod("term_id", F.lit(blocks)).cast("int").alias("_b")).agg(
        F.sum(square).alias("_full"), F.sum(F.when(~prefix, square).otherwise(0.0)).alias("_rest"),
        F.max(F.when(prefix, F.struct("df", "term_id"))).alias("_end"))
    found = parts.groupBy("scope", "text_id").agg(
        F.max("_end").alias("end"), F.map_from_entries(F.collect_list(F.struct("_b", F.struct("_full", "_rest")))).alias("_m"))

    def norms(name: str) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda b: F.sqrt(F.coalesce(F.try_element_at("_m", b)[name], F.lit(0.0))))
    return found.select("scope", "text_id", "end", norms("_full").cast("array<float>").alias("full"), norms("_rest").cast("array<float>").alias("rest"))


def prefix_entries(entries: DataFrame, threshold: float) -> DataFrame:
    """Index entries ``(scope, term_id, text_id, w, tail)`` of every vector's rarest terms.

    Two unit vectors with an inner product above the threshold share a term
    within both prefixes when each prefix holds more than ``1 - threshold²``
    of its vector's mass (with the same term order everywhere). ``tail`` is
    the norm of what follows an entry.
    """
    tail = F.sqrt(F.greatest(F.lit(0.0), 1 - F.col("mass")))
    return (entries.where(_in_prefix(threshold))
            .select("scope", "term_id", "text_id", "w", tail.alias("tail")))
