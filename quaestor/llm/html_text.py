"""Main text of web pages: structure first, then runs that repeat across pages of a host."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import StringType

from quaestor.llm.tables import pin, read_table
from quaestor.llm.url_rules import split_url
from quaestor.llm.words import MULTIPLIER, mix

SHARD_PAGES = 256  # pages of a host that one task reads, about
RUN_TOKENS = 6  # shortest repeated run that counts
COVERED = 0.8  # share of a block's tokens in such runs that makes it boilerplate
COMMON_SHARE, COMMON_PAGES = 0.5, 4  # inside an article a run has to be on that many pages

SKIPPED = frozenset("script style noscript template svg math iframe object canvas audio video select head title".split())
RAW = frozenset("script style noscript iframe title textarea".split())
NOISE = frozenset("nav header footer aside form button dialog menu fieldset".split())
MAIN = frozenset(("article", "main"))
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
                  "form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td "
                  "tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NOISE_NAME = re.compile(
    r"(?:^|[^a-z])(?:ads?|advert\w*|advertisement|sponsor\w*|promo\w*|banner|sidebar|side-bar|cookies?|consent|gdpr|notice|popup|modal|"
    r"newsletter|subscribe|comments?|disqus|replies|respond|share|sharing|social|related|recommended|breadcrumbs?|nav|navbar|navigation|"
    r"menu|footer|masthead|site-header|page-header|widget|pagination|pager|skip-link|toolbar|login|signup)(?:$|[^a-z])")
NOISE_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())

# A tag is read as browsers read it: quotes count only where a value begins, and one that never closes is part of a name.
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)"""
_OTHER = r"<!--.*?(?:-->|\Z)|<[!?/][^>]*+>"
START = re.compile(r"<[a-zA-Z/!?]")
TAG = re.compile(rf"<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|=|[^\s/>=]++(?:\s*+=\s*+{_VALUE})?)*+)>|{_OTHER}", re.S)
LOOSE_TAG = re.compile(rf"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|{_OTHER}", re.S)
ATTRIBUTE = re.compile(r"""([^\s/>=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+)))?""")
TOLD = frozenset(("class", "id", "role", "hidden", "aria-hidden"))
SPACE = re.compile(r"\s+")
LONG_NUMBER = re.compile(r"&#[0-9]{9,};?")

KEPT, ARTICLE, DROPPED = "k", "a", "d"
RUNS = "host string, shard long, run long, n_pages long"


def _noise(name: str, attributes: str, in_main: bool) -> bool:
    if name in NOISE and not (in_main and name == "header"):
        return True
    for key, *values in ATTRIBUTE.findall(attributes) if attributes else ():
        key = key.lower()
        if key not in TOLD:
            continue
        value = next(filter(None, values), "").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "role" and value in NOISE_ROLE:
            return True
        if key in ("class", "id") and name not in ("html", "body", "article", "main") and NOISE_NAME.search(value):
            return True
    return False


def blocks_of(html: str | None) -> list[str]:
    """Blocks of a page in order, each with a letter before it: in the article, elsewhere, or in a part that is dropped.

    Text between block tags is one block; inline tags leave no mark. Unclosed
    elements end with the page, stray end tags are ignored, and an end tag
    closes what is open inside. If a page ends in the middle of quotes, tags
    end at the next ``>`` from there on; a tag without any is cut off with the
    page. The time taken is linear in the page. Character references are decoded, lone
    surrogates and nulls become U+FFFD, white space becomes one space.
    """
    html = html or ""
    out: list[str] = []
    text: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # name, noise, main
    open_names: dict[str, int] = {}
    noise = main = 0
    at, end = 0, len(html)
    tag, unclosed = TAG, set()

    def flush() -> None:
        if text:
            raw = LONG_NUMBER.sub("\ufffd", "".join(text))
            joined = SPACE.sub(" ", unescape(raw).replace("\x00", "\ufffd")).strip()
            text.clear()
            if joined:
                out.append((DROPPED if noise else ARTICLE if main else KEPT) + joined)

    while at < end:
        begin = START.search(html, at)
        text.append(html[at:begin.start()] if begin else html[at:])
        if not begin:
            break
        m = tag.match(html, begin.start())
        if not m and tag is TAG:
            tag = LOOSE_TAG
            m = tag.match(html, begin.start())
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if m[1]:
            if name in BLOCK:
                flush()
            if open_names.get(name):
                if name not in BLOCK and not any(n == name for n, *_ in stack[-8:]):
                    continue  # an inline end tag doesn't close the blocks around it
                while True:
                    top, was_noise, was_main = stack.pop()
                    if top in BLOCK or was_noise:
                        flush()
                    open_names[top] -= 1
                    noise -= was_noise
                    main -= was_main
                    if top == name:
                        break
            continue
        if name in SKIPPED and name != "head":
            if not m[3].endswith("/"):
                close = None if name in unclosed else re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
                if not close:
                    unclosed.add(name)
                at = close.end() if close else end if name in RAW else at
            continue
        if name in BLOCK:
            flush()
        if name in VOID or m[3].endswith("/") and name not in BLOCK:
            continue
        if name in ("p", "li", "td", "th", "tr", "dd", "dt", "option") and stack and stack[-1][0] == name:
            top, was_noise, was_main = stack.pop()
            open_names[top] -= 1
            noise -= was_noise
            main -= was_main
        is_noise, is_main = _noise(name, m[3], main > 0), name in MAIN
        if is_noise:
            flush()
        stack.append((name, is_noise, is_main))
        open_names[name] = open_names.get(name, 0) + 1
        noise += is_noise
        main += is_main
    flush()
    return out


def repeated_runs(tokens: np.ndarray, page: np.ndarray, length: int = RUN_TOKENS) -> np.ndarray:
    """For each token the number of distinct pages that hold a run of ``length`` tokens covering it; 0 if no other page does.

    A suffix array of the concatenated pages, by prefix doubling up to the
    run's length: neighbours of equal rank share that many tokens, and every
    longer repeated substring is a chain of such runs.
    """
    n = len(tokens)
    pages = np.zeros(n, np.int64)
    if n < length:
        return pages
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    known = 1
    while known < length:
        step = min(known, length - known)
        second = np.full(n, -1, np.int64)
        second[:n - step] = rank[step:]
        rank = np.unique(rank * (rank.max() + 2) + second + 1, return_inverse=True)[1].astype(np.int64)
        known += step
    starts = np.flatnonzero(page[:n - length + 1] == page[length - 1:])
    suffix = starts[np.lexsort((page[starts], rank[starts]))]
    new_rank = np.ones(len(suffix), bool)
    new_rank[1:] = rank[suffix][1:] != rank[suffix][:-1]
    new_page = new_rank.copy()
    new_page[1:] |= page[suffix][1:] != page[suffix][:-1]
    group = np.cumsum(new_rank) - 1
    held = np.bincount(group, new_page).astype(np.int64)[group] if len(suffix) else np.zeros(0, np.int64)
    for k in range(length):
        np.maximum.at(pages, suffix + k, np.where(held > 1, held, 0))
    return pages


def _stream(pages: list[list[str]]) -> tuple[list[str], np.ndarray, np.ndarray, list[list[int]]]:
    """The different tokens of the pages, the number of each token in order, its page, and the bounds of each page's blocks."""
    ids: dict[str, int] = {}
    tokens: list[int] = []
    owner: list[int] = []
    bounds: list[list[int]] = []
    for k, blocks in enumerate(pages):
        marks = [len(tokens)]
        for block in blocks:
            tokens += [ids.setdefault(w, len(ids)) for w in block[1:].split(" ")]
            marks.append(len(tokens))
        owner += [k] * (len(tokens) - len(owner))
        bounds.append(marks)
    return list(ids), np.array(tokens, np.int64), np.array(owner, np.int64), bounds


def hashed_runs(words: list[str], tokens: np.ndarray, page: np.ndarray, length: int = RUN_TOKENS) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the runs of ``length`` tokens that lie in one page, and a hash of each that all tasks agree on."""
    if len(tokens) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    known = np.array([xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words], np.uint64)
    starts = np.flatnonzero(page[:len(tokens) - length + 1] == page[length - 1:])
    hashes = np.zeros(len(starts), np.uint64)
    for k in range(length):
        hashes = mix(hashes * np.uint64(MULTIPLIER) + known[tokens[starts + k]])
    return starts, hashes.view(np.int64)


def main_texts(pages: list[list[str]], repeated: tuple[np.ndarray, np.ndarray] | None = None, size: int | None = None) -> list[str]:
    """Main text of each page, from its marked blocks.

    The pages are those of a host, or some of its ``size`` pages; then
    ``repeated`` has the hashes, in order, of the runs that distinct pages of
    the whole host share, and the numbers of these pages.
    """
    words, tokens, owner, bounds = _stream(pages)
    if repeated is None:
        held = repeated_runs(tokens, owner)
    else:
        held = np.zeros(len(tokens), np.int64)
        runs, numbers = repeated
        starts, hashes = hashed_runs(words, tokens, owner)
        if len(runs) and len(starts):
            at = np.minimum(np.searchsorted(runs, hashes), len(runs) - 1)
            on = np.where(runs[at] == hashes, numbers[at], 0)
            for k in range(RUN_TOKENS):
                np.maximum.at(held, starts + k, on)
    size = len(pages) if size is None else size
    anywhere = np.concatenate(([0], np.cumsum(held > 1)))
    common = np.concatenate(([0], np.cumsum((held >= COMMON_PAGES) & (held >= COMMON_SHARE * size))))
    out = []
    for blocks, marks in zip(pages, bounds, strict=True):
        has_article = any(b[0] == ARTICLE for b in blocks)
        share = [((anywhere[e] - anywhere[s]) / (e - s), (common[e] - common[s]) / (e - s)) for s, e in zip(marks, marks[1:], strict=False)]
        if has_article:
            own = [k for k, b in enumerate(blocks) if b[0] == ARTICLE]
            kept = [k for k in own if share[k][1] < COVERED]
            if 2 * sum(len(blocks[k]) for k in kept) < sum(len(blocks[k]) for k in own):
                kept = own  # a copied article isn't boilerplate
        else:
            own = [k for k, b in enumerate(blocks) if b[0] == KEPT]
            kept = [k for k in own if share[k][0] < COVERED] or own
        out.append("\n".join(blocks[k][1:] for k in kept))
    return out


def _marked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array(["\n".join(blocks_of(x.as_py())) for x in batch], pa.string())


def _blocks(pages: pa.Table) -> list[list[str]]:
    return [x.split("\n") if x else [] for x in pages["marked"].to_pylist()]


def _own_texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Main texts of pages of hosts without any run that matters."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        yield pa.array([main_texts([x.split("\n") if x else []], none)[0] for x in batch.to_pylist()], pa.string())


def _host_texts(pages: pa.Table) -> pa.Table:
    return pages.select(["page_id", "url"]).append_column("text", pa.array(main_texts(_blocks(pages)), pa.string()))


def _counted_runs(pages: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the different runs of a shard's pages, and the number of pages that hold each."""
    words, tokens, owner, _ = _stream(_blocks(pages))
    starts, hashes = hashed_runs(words, tokens, owner)
    order = np.lexsort((owner[starts], hashes))
    hashes, page = hashes[order], owner[starts][order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (page[1:] != page[:-1])
    return np.unique(hashes[new], return_counts=True)


def _run_table(pages: pa.Table, runs: np.ndarray, numbers: np.ndarray, plain: bool = False) -> pa.Table:
    """Rows of runs, and one without a run if ``plain``."""
    host, shard, n = pages["host"][0].as_py(), pages["shard"][0].as_py(), len(runs) + plain
    return pa.table({"host": pa.array([host] * n, pa.string()), "shard": pa.array(np.full(n, shard, np.int64)),
                     "run": pa.array([*runs.tolist(), *[None] * plain], pa.int64()), "n_pages": pa.array([*numbers.tolist(), *[0] * plain], pa.int64())})


def _all_runs(pages: pa.Table) -> pa.Table:
    return _run_table(pages, *_counted_runs(pages))


def _shard_runs(pages: pa.Table) -> pa.Table:
    """The runs on ``COMMON_SHARE`` of the shard's pages, and whether some page has text but no article."""
    runs, numbers = _counted_runs(pages)
    common = numbers >= COMMON_SHARE * len(pages)
    plain = any(any(b[0] == KEPT for b in page) and not any(b[0] == ARTICLE for b in page) for page in _blocks(pages))
    return _run_table(pages, runs[common], numbers[common], plain)


def _asked_runs(pages: pa.Table, asked: pa.Table) -> pa.Table:
    """Those of the asked runs that a shard has."""
    if not pages.num_rows:
        return _run_table(pa.table({"host": [None], "shard": [0]}), np.zeros(0, np.int64), np.zeros(0, np.int64))
    runs, numbers = _counted_runs(pages)
    wanted = np.isin(runs, asked["run"].to_numpy())
    return _run_table(pages, runs[wanted], numbers[wanted])


def _shard_texts(pages: pa.Table, found: pa.Table) -> pa.Table:
    if not pages.num_rows:
        return pages.select(["page_id", "url"]).append_column("text", pa.array([], pa.string()))
    runs, numbers = found["run"].to_numpy(), found["held"].to_numpy()
    order = np.argsort(runs)
    texts = main_texts(_blocks(pages), (runs[order], numbers[order]), pages["n"][0].as_py())
    return pages.select(["page_id", "url"]).append_column("text", pa.array(texts, pa.string()))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text`` of each row of ``pages(page_id, url, html)``.

    Tags give the blocks and the parts that are no content (menus, headers,
    footers, sidebars, notices, adverts, forms, comments). Then the pages of a
    host are joined to one stream of tokens, and a suffix array finds runs of
    six or more tokens that distinct pages share: a block outside an article
    that lies in such runs goes; one inside goes if at least half of the
    host's pages have its runs, unless little else would be left, as in
    copies. A page with an article consists of its blocks only.

    A host of many pages is dealt out to shards of about 256 by a hash of the
    page, so no task grows with the host. Its runs are counted over all
    shards. A run on half of the host's pages is on half of the pages of some
    shard, so shards name those runs, and all shards count the named ones. Only
    in a host with pages that have no article every run is counted. The sums
    go back to the shards that hold the runs; pages of hosts without such runs
    don't move again. Null pages have an empty text;
    null urls form a host of their own; repeated rows stay, each counting as a
    page.
    """
    rows = pages.select("page_id", "url", "html").withColumn("host", split_url(F.col("url"))[0])
    sizes = pin(rows.groupBy("host").agg(F.count(F.lit(1)).alias("n")), "html-hosts")
    shard = F.pmod(F.xxhash64("page_id", "url"), F.ceil(F.col("n") / SHARD_PAGES).cast("long"))
    marked = rows.join(sizes, "host").select("page_id", "url", "host", "n", shard.alias("shard"), arrow_udf(_marked, StringType())("html").alias("marked"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in marked.select("page_id", "url").schema) + ", text string"
    small = marked.where(F.col("n") <= SHARD_PAGES).groupBy("host").applyInArrow(_host_texts, kinds)
    if sizes.where(F.col("n") > SHARD_PAGES).isEmpty():
        return small
    large, same = marked.where(F.col("n") > SHARD_PAGES), F.col("host").eqNullSafe(F.col("_host"))
    first = pin(large.groupBy("host", "shard").applyInArrow(_shard_runs, RUNS), "html-runs").withColumnRenamed("host", "_host")
    plain = pin(first.where(F.col("run").isNull()).select("_host").distinct(), "html-plain")
    named = pin(first.where(F.col("run").isNotNull()).select("_host", "run").distinct(), "html-named")
    hosts = pin(named.select("_host").unionByName(plain).distinct(), "html-touched")
    touched = pin(large.join(hosts, same, "left_semi"), "html-pages")
    partly = touched.join(plain, same, "left_anti")
    shards = partly.select("host", "shard").distinct()
    asked = pin(shards.join(named, same).select("host", "shard", "run"), "html-asked")
    answers = pin(partly.groupBy("host", "shard").cogroup(asked.groupBy("host", "shard")).applyInArrow(_asked_runs, RUNS), "html-answers")
    every = pin(touched.join(plain, same, "left_semi").groupBy("host", "shard").applyInArrow(_all_runs, RUNS), "html-every")
    counted = every.unionByName(answers)
    held = (counted.groupBy("host", "run").agg(F.sum("n_pages").alias("held")).where("held > 1")
            .withColumnsRenamed({"host": "_host", "run": "_run"}))
    found = (counted.select("host", "shard", "run").join(held, F.col("host").eqNullSafe(F.col("_host")) & (F.col("run") == F.col("_run")))
             .select("host", "shard", "run", "held"))
    parts = touched.groupBy("host", "shard").cogroup(found.groupBy("host", "shard")).applyInArrow(_shard_texts, kinds)
    alone = large.join(hosts, same, "left_anti")
    plain_texts = alone.select("page_id", "url", arrow_udf(_own_texts, StringType())("marked").alias("text"))
    return small.unionByName(plain_texts).unionByName(parts)


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


QUERIES = {"op10_html_text": op10_html_text}
ORACLE: dict[str, str] = {}
